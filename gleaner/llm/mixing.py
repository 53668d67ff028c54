"""Mix sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import saved

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_ROWS = 4096
MAX_SOURCES = 100_000
EPSILON = 1e-9


def word_count(text: str) -> Column:
    """Number of words between ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: list[float]) -> DataFrame:
    """Weights dealt to the sources in code-point order, null last, repeating.

    One row a source: the table is the list of the mixture's components, so its numbering may run in one task;
    ``targets`` checks that it stays within ``MAX_SOURCES``.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1)))


def targets(sources: DataFrame, share: float, most: float) -> list[tuple[str | None, int, float]]:
    """Source, its size and its target for every source: share out ``share`` times all sizes by weight; a source gets at most ``most`` times its own size.

    ``sources``: source, source_size, weight.  What is above a source's limit is dealt to the others by weight,
    again and again until none is above it.  With all sources at their limits the rest stays undealt.
    """
    rows = sources.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    total = sum(r["source_size"] for r in rows)
    limit = {r["source"]: most * r["source_size"] for r in rows}
    weight = {r["source"]: float(r["weight"]) for r in rows}
    open_, target, left = set(limit), {}, share * total
    while open_:
        by_weight = sum(weight[s] for s in sorted(open_, key=lambda s: (s is None, s or "")))
        dealt = {s: left * weight[s] / by_weight if by_weight else 0.0 for s in open_}
        above = [s for s in open_ if dealt[s] > limit[s]]
        if not above:
            target |= dealt
            break
        for s in sorted(above, key=lambda s: (s is None, s or "")):
            target[s] = limit[s]
            left -= limit[s]
            open_.remove(s)
    return [(r["source"], r["source_size"], float(target[r["source"]])) for r in rows]


def fly(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase: move probabilities until at most two lie strictly between 0 and 1.

    Three open units at a time move along the direction that changes neither the sum of probabilities (the
    document total) nor the sum of probability times size (the token total), as a martingale, until one of
    them reaches 0 or 1.
    """
    pi = pi.copy()
    waiting = [i for i in range(len(pi)) if EPSILON < pi[i] < 1 - EPSILON]
    waiting.reverse()
    window: list[int] = []
    draws = iter(())
    while True:
        while len(window) < 3 and waiting:
            window.append(waiting.pop())
        if len(window) < 3:
            return pi
        a, b, c = window
        ahead = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
        if ahead == (0, 0, 0):
            ahead = (1, -1, 0)
        up = down = np.inf
        for i, u in zip(window, ahead):
            if u > 0:
                up, down = min(up, (1 - pi[i]) / u), min(down, pi[i] / u)
            elif u < 0:
                up, down = min(up, pi[i] / -u), min(down, (1 - pi[i]) / -u)
        draw = next(draws, None)
        if draw is None:
            draws = iter(rng.random(1024).tolist())
            draw = next(draws)
        step = up if draw * (up + down) < down else -down
        for i, u in zip(window, ahead):
            pi[i] += step * u
        window = [i for i in window if EPSILON < pi[i] < 1 - EPSILON]


def land(pi: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the at most two open units the way that keeps the token total nearest, then the document total.

    A large unit may be the one left open, and its rounding far off.  What is then missing or too much is made up
    by units of the block that were closed before, in falling size, each turned over if that brings the token total
    nearer: at the end it is off by less than the smallest unit that could still be turned.
    """
    open_ = np.flatnonzero((pi > EPSILON) & (pi < 1 - EPSILON))
    best = None
    for code in range(1 << len(open_)):
        bits = np.array([(code >> k) & 1 for k in range(len(open_))], float)
        off = (abs(((bits - pi[open_]) * size[open_]).sum()), abs((bits - pi[open_]).sum()), code)
        if best is None or off < best[0]:
            best = (off, bits)
    out = pi.copy()
    out[open_] = best[1]
    off = float(((out - pi) * size).sum())
    out = np.round(out)
    for i in np.argsort(-size, kind="stable"):
        change = size[i] if out[i] == 0 else -size[i]
        if abs(off + change) < abs(off):
            off += change
            out[i] = 1 - out[i]
    return out


def _flight(last: bool):
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["seed", "row_id"], kind="stable")
        size = [int(s) for s in batch["size"]]
        seed = int(batch["seed"].to_numpy().astype(np.uint64).sum(dtype=np.uint64))
        pi = fly(batch["pi"].to_numpy(float), size, np.random.default_rng(seed))
        batch["pi"] = land(pi, np.array(size, float)) if last else pi
        return batch[["row_id", "source_id", "size", "seed", "pi"]]

    return run


def cube_sample(units: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Choose units so that per source their number and their summed size stay near the expected ones.

    ``units``: row_id (unique), source_id, size, seed, pi (the inclusion probability).  Returns row_id and
    ``chosen`` (0 or 1).  Every source is cut by hash into blocks of about ``block_rows`` units; each block
    flies on its own and leaves at most two units open.  Those of many blocks meet in the next round, again in
    bounded blocks, until one block a source is left, which also lands.
    """
    done: list[DataFrame] = []
    schema = "row_id long, source_id int, size long, seed long, pi double"
    units = units.select("row_id", "source_id", "size", "seed", "pi")
    is_open = (F.col("pi") > EPSILON) & (F.col("pi") < 1 - EPSILON)
    done.append(units.where(~is_open))
    units = units.where(is_open)
    while True:
        counts = units.groupBy("source_id").agg(F.count(F.lit(1)).alias("units")).limit(MAX_SOURCES).collect()
        blocks = {r["source_id"]: -(-r["units"] // block_rows) for r in counts}
        last = all(n <= 1 for n in blocks.values())
        of_source = units.sparkSession.createDataFrame(list(blocks.items()) or [(0, 1)], "source_id int, blocks int")
        cut = units.join(of_source, "source_id").withColumn(
            "block", F.pmod(F.xxhash64("seed", F.lit(len(done))), F.col("blocks"))
        )
        flown = saved(cut.groupBy("source_id", "block").applyInPandas(_flight(last), schema))
        done.append(flown.where(~is_open))
        if last:
            break
        units = flown.where(is_open)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("row_id", F.round("pi").cast("int").alias("chosen"))


def mix(sized: DataFrame, weights: list[float], share: float, most: float, id_column: str = "doc_id") -> DataFrame:
    """Copies of each document such that sources meet their targets: sized's columns, source_size, target, copies.

    ``sized`` has doc_id, source and size (>= 0), and may have more columns, which are kept; source_size, target
    and copies are replaced.  Every document of a source has the same expected number of copies, target /
    source_size; its whole part is given to all, the fraction is sampled by the cube method.  So no document
    exceeds ``most`` copies, rounded up, null ids and repeated rows are documents like any others, a null source
    is a source, and documents without words are copied like the rest of their source (0 times in a source
    without any words).  The choice depends on source, id and size alone, so reruns agree; which of several rows
    equal in these three is copied does not matter for the mix.
    """
    spark = sized.sparkSession
    sized = sized.drop("source_size", "target", "copies")
    names = [f"c{i}" for i in range(len(sized.columns))]
    of = dict(zip(sized.columns, names))
    rows = saved(sized.toDF(*names).withColumn("row_id", F.monotonically_increasing_id()))
    source, size = F.col(of["source"]), F.col(of["size"]).cast("long")
    sources = rows.groupBy(source.alias("source")).agg(F.sum(size).alias("source_size"))
    goal = sorted(targets(cycled_weights(sources, weights), share, most), key=lambda r: (r[0] is None, r[0] or ""))
    table = [(i, s, n, target, target / n if n else 0.0) for i, (s, n, target) in enumerate(goal)]
    known = spark.createDataFrame(
        table, "source_id int, source string, source_size long, target double, expected double"
    )
    known = F.broadcast(known)  # one row a source, at most MAX_SOURCES
    at = rows.join(known, source.eqNullSafe(F.col("source"))).drop("source")
    whole = F.floor(F.col("expected") + EPSILON).cast("int")
    units = at.select(
        "row_id",
        "source_id",
        size.alias("size"),
        F.xxhash64("source_id", of[id_column], size).alias("seed"),
        F.greatest(F.lit(0.0), F.col("expected") - whole).alias("pi"),
    )
    chosen = cube_sample(units)
    copied = at.join(chosen, "row_id").withColumn("copies", whole + F.col("chosen"))
    return copied.select(*names, "source_size", "target", "copies").toDF(
        *sized.columns, "source_size", "target", "copies"
    )
