"""Secrets in texts: fixed patterns, and a linear-chain conditional random field over tokens that adds to them."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from gleaner.llm.common import lean, mix64, powers, saved, slices

# The patterns of the base kinds, and the least length of what counts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api")
HEX_MAP = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
HEX_RUN = b"x" * 16
KINDS = ("assign", "access", "hex", "crf")

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
TAGS = 3
NEVER = -1e4
LANE = 64
BUCKETS = 1 << 12
ROUNDS = 40
RATE = 0.15
DECAY = 1e-3
# Documents of the training sample, and tokens of a training window.
SAMPLE = 2000
WINDOW = 64
CAUTION = 3.0
# Characters that the field reads at once.
PIECE = 1 << 20

# Names that precede a secret or an ordinary value, and how they are written, in the planted windows.
SECRET_NAMES = (
    "password passwd pwd pass secret client_secret secret_key token auth_token access_token refresh_token api_key apikey "
    "access_key private_key signing_key credential credentials bearer authorization connection_key webhook_secret"
).split()
PLAIN_NAMES = (
    "name title path version color size count page author date status type format language category label width "
    "height order number total price user host port mode level build"
).split()
FORMS = (
    '{n} = "{v}"', "{n}={v}", "{n}: {v}", '"{n}": "{v}"', "'{n}': '{v}'", "export {n}={v}", "--{n} {v}", "{n} is {v}",
    "<{n}>{v}</{n}>", "{n} {v}", "{n} -> {v}", "set {n} '{v}'",
)
SECRET_FORMS = ("Authorization: Bearer {v}", "https://user:{v}@host.example/", "curl -u admin:{v}", "x-api-key: {v}")
PREFIXES = ("", "", "", "sk_live_", "ghp_", "xoxb-", "pat-", "eyJ")
ALPHABETS = (
    "0123456789abcdef",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
)
PLAIN_VALUES = ("2024-05-17", "1.12.3", "true", "0", "128", "README.md", "src/main/index.html", "example.com", "en-US",
                "john.smith@example.com", "2024-05-17T10:15:00", "10.0.0.1", "changeme", "<value>", "null", "+1-555-0100")

Span = tuple[int, str, int]
SPAN_FIELDS = (("kind", StringType), ("start", IntegerType), ("end", IntegerType))


def base_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` of the base kinds in code points, by start and kind."""
    found: list[Span] = []
    low = text.lower()
    if any(name in low for name in ASSIGN_HINTS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    # A run shorter than its least length holds no longer one, so the length may stand in the pattern.
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    if HEX_RUN in text.encode().translate(HEX_MAP):
        found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def values(text: str) -> list[tuple[int, int]]:
    """Start and end of what the base kinds hold to be secret: the assigned value, the key, hex with letters and digits."""
    found = [m.span(2) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    found += [m.span() for m in ACCESS.finditer(text)]
    found += [m.span() for m in HEX.finditer(text) if not m.group().isdigit() and not m.group().isalpha()]
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def _classes() -> np.ndarray:
    """Class of each byte: 0 white space, 1 mark, 2 joining mark, 3 a-z, 4 A-Z, 5 digit, 6 of a letter beyond ASCII."""
    out = np.ones(256, np.uint8)
    out[[*range(9, 14), 32]] = 0
    out[[ord(c) for c in "+/._-~"]] = 2
    out[ord("a") : ord("z") + 1], out[ord("A") : ord("Z") + 1], out[ord("0") : ord("9") + 1] = 3, 4, 5
    out[128:] = 6
    return out


CLASS = _classes()
LOWER = np.arange(256, dtype=np.uint64)
LOWER[ord("A") : ord("Z") + 1] += 32
VOWEL, HEXDIGIT = np.zeros(256, bool), np.zeros(256, bool)
VOWEL[[ord(c) for c in "aeiouyAEIOUY"]] = True
HEXDIGIT[[ord(c) for c in "0123456789abcdefABCDEF"]] = True
LENGTHS = np.array([2, 4, 8, 12, 16, 20, 28, 40, 64])
OWN = len(LENGTHS) + 1 + 14
FILE = 4
DENSE = OWN + 2 * 6 + FILE + 1
HASHED = 5  # own shape, three words before, one after


class Tokens:
    """Tokens of a batch of texts.

    A token is a run of letters, digits and the marks that join them in keys (``+/._-~``), or one other mark.
    ``start`` and ``end`` are byte offsets in ``data``; ``owner`` is the text's number.
    """

    def __init__(self, texts: list[str]):
        parts = [t.encode() for t in texts]
        size = np.array([len(p) for p in parts], np.int64)
        self.n = len(texts)
        self.text_start = np.cumsum(size) - size
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        kind = CLASS[self.data]
        word = kind >= 2
        edge = np.zeros(len(kind), bool)
        edge[self.text_start[size > 0]] = True
        opens = (kind == 1) | (word & edge)
        opens[1:] |= word[1:] & ~word[:-1]
        self.start = np.flatnonzero(opens)
        shuts = kind == 1
        shuts[:-1] |= word[:-1] & (~word[1:] | edge[1:])
        shuts[-1:] |= word[-1:]
        self.end = np.flatnonzero(shuts) + 1
        self.owner = np.searchsorted(self.text_start, self.start, side="right") - 1
        self.count = np.bincount(self.owner, minlength=self.n)
        self.size = size
        self._kind = kind

    def code_points(self) -> np.ndarray:
        """Code points before each byte offset, from the start of its own text; one place more than bytes."""
        first = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        return first

    def _sum(self, flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int32)])
        return total[self.end] - total[self.start]

    def _words(self) -> tuple[np.ndarray, np.ndarray]:
        """Start of each run of letters and digits, and a hash of the run in lower case."""
        solid = self._kind >= 3
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        first[self.text_start[self.size > 0]] |= solid[self.text_start[self.size > 0]]
        start = np.flatnonzero(first)
        if not len(start):
            return start, np.zeros(0, np.uint64)
        run = np.cumsum(first) - 1
        place = np.arange(len(solid)) - start[np.maximum(run, 0)]
        power = powers(0x9E3779B97F4A7C15, 256)
        value = np.where(solid, (LOWER[self.data] + np.uint64(1)) * power[place & 255], np.uint64(0))
        return start, mix64(np.add.reduceat(value, start))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Real-valued features and the buckets of the hashed ones, a row a token."""
        length = self.end - self.start
        some = np.maximum(length, 1)
        kind = self._kind
        counts = [self._sum(kind == k) for k in range(2, 7)]
        joins, lower, upper, digit, beyond = counts
        change = np.zeros(len(kind), bool)
        change[1:] = kind[1:] != kind[:-1]
        changes = self._sum(change) - change[self.start]  # inside the token
        if len(length):
            bit = (kind > 0).astype(np.uint64) << (self.data & 63).astype(np.uint64)
            bits = np.bitwise_or.reduceat(bit, self.start)
        else:
            bits = np.zeros(0, np.uint64)
        distinct = np.bitwise_count(bits)
        first = self.data[self.start]
        letters = np.maximum(lower + upper, 1)
        band = np.searchsorted(LENGTHS, length)
        mark = kind[self.start] == 1
        own = np.hstack(
            [
                band[:, None] == np.arange(len(LENGTHS) + 1),
                np.stack(
                    [
                        lower / some,
                        upper / some,
                        digit / some,
                        joins / some,
                        beyond / some,
                        changes / some,
                        distinct / np.minimum(some, 40),
                        self._sum(VOWEL[self.data]) / letters,
                        self._sum(HEXDIGIT[self.data]) == length,
                        (digit > 0) & (lower + upper > 0) & (length >= 12),
                        (upper > 0) & (lower > 0) & (digit > 0) & (length >= 12),
                        np.log1p(length) / 5,
                        mark,
                        (digit == length),
                    ],
                    axis=1,
                ),
            ]
        ).astype(np.float32)
        signs = np.stack([first == ord(c) for c in "=:\"'"] + [mark, np.ones(len(first), bool)], axis=1).astype(np.float32)
        before, after = np.zeros_like(signs), np.zeros_like(signs)
        before[1:], after[:-1] = signs[:-1], signs[1:]
        opens = np.ones(len(first), bool)
        opens[1:] = self.owner[1:] != self.owner[:-1]
        before[opens], after[np.append(opens[1:], True)[: len(first)]] = 0, 0
        file = self._file()[self.owner]
        dense = np.hstack([own, before, after, file, np.ones((len(first), 1), np.float32)])
        return dense, self._hashed(band, lower, upper, digit, joins)

    def _file(self) -> np.ndarray:
        """Per text: shares of marks, digits and joining marks in its bytes, and of lines with an equals sign or colon."""
        total = lambda flag: np.add.reduceat(np.append(flag, False).astype(np.int64), self.text_start) * (self.size > 0)
        if not self.n:
            return np.zeros((0, FILE), np.float32)
        some = np.maximum(self.size, 1)
        lines = total(self.data == 10) + 1
        pairs = total((self.data == ord("=")) | (self.data == ord(":")))
        marks, digits, joins = (total(self._kind == k) / some for k in (1, 5, 2))
        return np.stack([marks, digits, joins, np.minimum(pairs / lines, 1)], axis=1).astype(np.float32)

    def _hashed(self, band, lower, upper, digit, joins) -> np.ndarray:
        shape = band * 16 + (lower > 0) * 1 + (upper > 0) * 2 + (digit > 0) * 4 + (joins > 0) * 8
        start, value = self._words()
        owner = np.searchsorted(self.text_start, start, side="right") - 1
        here = np.searchsorted(start, self.start)  # the first run at or after the token
        beyond = np.searchsorted(start, self.end)
        columns = [shape.astype(np.uint64)]
        for salt, at in enumerate((here - 1, here - 2, here - 3, beyond), start=1):
            inside = (at >= 0) & (at < len(start))
            at = np.clip(at, 0, max(len(start) - 1, 0))
            inside &= owner[at] == self.owner if len(start) else False
            word = np.where(inside, value[at] if len(start) else np.uint64(0), np.uint64(0))
            columns.append(word + np.uint64(salt))
        return np.stack([(mix64(c) % np.uint64(BUCKETS)).astype(np.int64) + k * BUCKETS for k, c in enumerate(columns)], axis=1)


def emissions(dense: np.ndarray, hashed: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    out = dense @ model["dense"].astype(np.float32)
    table = model["hashed"].astype(np.float32)
    for k in range(HASHED):
        out += table.take(hashed[:, k], axis=0)
    return out.astype(np.float64)


def viterbi(emission: np.ndarray, count: np.ndarray, transition: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best tag of every token; ``count`` tokens belong to each text in turn.

    Texts are cut into lanes of 64 tokens.  All lanes advance together: each first finds what every tag before it
    leads to, then the lanes of a text are chained, and the best path is read back.  A long text costs its lanes, not
    one step a token.
    """
    if not len(emission):
        return np.zeros(0, np.int8)
    lanes = -(-count // LANE)
    head = np.cumsum(lanes) - lanes
    n = int(lanes.sum())
    owner = np.repeat(np.arange(len(count)), lanes)
    nth = np.arange(n) - head[owner]
    length = np.minimum(count[owner] - nth * LANE, LANE)
    token = (np.cumsum(count) - count)[owner] + nth * LANE
    # longest lanes first: at each step those still going on are the first ones
    order = np.argsort(-length, kind="stable")
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    going = np.searchsorted(-length[order], -np.arange(LANE), side="left")
    at = token[order]
    reach = np.empty((TAGS, TAGS, n))  # tag now, tag before the lane
    opening = nth[order] == 0
    for j in range(TAGS):
        for i in range(TAGS):
            reach[j, i] = np.where(opening, start[j], transition[i, j]) + emission[at, j]
    came = np.zeros((LANE, TAGS, TAGS, n), np.int8)
    for t in range(1, LANE):
        m = going[t]
        now = []
        for j in range(TAGS):
            best, tag = reach[0, :, :m] + transition[0, j], came[t, j, :, :m]
            for k in range(1, TAGS):
                through = reach[k, :, :m] + transition[k, j]
                tag[through > best] = k
                best = np.maximum(best, through)
            now.append(best + emission[at[:m] + t, j])
        for j in range(TAGS):
            reach[j, :, :m] = now[j]
    # chain the lanes of each text; the k-th lanes of all texts go together
    by_length = np.argsort(-lanes, kind="stable")
    live = np.searchsorted(-lanes[by_length], -np.arange(int(lanes.max())), side="left")
    value, entered = np.zeros((len(lanes), TAGS)), np.zeros((n, TAGS), np.int8)
    for k, m in enumerate(live):
        texts = by_length[:m]
        lane = slot[head[texts] + k]
        through = value[texts][:, :, None] + reach[:, :, lane].transpose(2, 1, 0)
        entered[lane] = through.argmax(axis=1)
        value[texts] = through.max(axis=1)
    tag = value.argmax(axis=1).astype(np.int8)
    now, enters = np.zeros(n, np.int8), np.zeros(n, np.int8)
    for k in range(len(live) - 1, -1, -1):
        texts = by_length[: live[k]]
        lane = slot[head[texts] + k]
        now[lane] = tag[texts]
        enters[lane] = entered[lane, tag[texts]]
        tag[texts] = enters[lane]
    out, every = np.zeros(len(emission), np.int8), np.arange(n)
    for t in range(LANE - 1, -1, -1):
        m = going[t]
        out[at[:m] + t] = now[:m]
        if t:
            now[:m] = came[t, now[:m], enters[:m], every[:m]]
    return out


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)


def marginals(
    emission: np.ndarray, transition: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Tag probabilities of windows (window, place, tag) and the expected number of each transition."""
    n, size, _ = emission.shape
    ahead, back = np.zeros_like(emission), np.zeros_like(emission)
    ahead[:, 0] = start + emission[:, 0]
    for t in range(1, size):
        ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + transition, 1) + emission[:, t]
    for t in range(size - 2, -1, -1):
        back[:, t] = _log_sum(transition + (emission[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    total = _log_sum(ahead[:, -1], 1)
    both = np.exp(np.minimum(ahead + back - total[:, None, None], 0))
    pair = ahead[:, :-1, :, None] + transition + (emission + back)[:, 1:, None, :] - total[:, None, None, None]
    return both, np.exp(np.minimum(pair, 0)).sum(axis=(0, 1))


def planted(text: str, dice: random.Random) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """A text with an invented secret put between two words, and one with an ordinary value, and where the secrets are."""
    known = values(text)
    breaks = [m.start() for m in re.finditer(r"\x20", text)] or [len(text)]
    common = [w for w in text.split()[:200] if w.isalpha()] or ["word"]
    for secret in (True, False):
        at = dice.choice(breaks)
        if any(a < at < b for a, b in known):
            continue
        if secret:
            alphabet, prefix = dice.choice(ALPHABETS), dice.choice(PREFIXES)
            value = prefix + "".join(dice.choices(alphabet, k=dice.randint(16, 48)))
            form = dice.choice(FORMS + SECRET_FORMS)
            name = dice.choice(SECRET_NAMES)
        else:
            value = dice.choice(PLAIN_VALUES) if dice.random() < 0.5 else dice.choice(common)
            form = dice.choice(FORMS)
            name = dice.choice(PLAIN_NAMES if dice.random() < 0.5 else SECRET_NAMES)
        name = dice.choice((str.lower, str.upper, str.title))(name)
        piece = f" {form.format(n=name, v=value)}"
        new = text[:at] + piece + text[at:]
        moved = [(a + len(piece) * (a >= at), b + len(piece) * (a >= at)) for a, b in known]
        begin = at + piece.index(value)
        yield new, moved + ([(begin, begin + len(value))] if secret else [])


def tags(tokens: Tokens, spans: list[list[tuple[int, int]]]) -> np.ndarray:
    """Begin and inside for the tokens of each text's spans (code points), outside for all others."""
    out = np.zeros(len(tokens.start), np.int8)
    points = tokens.code_points()
    base = points[tokens.text_start]
    begin, end = points[tokens.start] - base[tokens.owner], points[tokens.end] - base[tokens.owner]
    first = np.cumsum(tokens.count) - tokens.count
    for k, places in enumerate(spans):
        mine = slice(first[k], first[k] + tokens.count[k])
        for a, b in places:
            inside = np.flatnonzero((begin[mine] < b) & (end[mine] > a)) + first[k]
            out[inside] = INSIDE
            out[inside[:1]] = BEGIN
    return out


def _windows(text: str, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Training windows of one document, 64 tokens each: as it is, with a planted secret, and with a planted decoy."""
    dice = random.Random(seed)
    for version, spans in [(text, values(text)), *planted(text, dice)]:
        tokens = Tokens([version])
        y = tags(tokens, [spans])
        dense, hashed = tokens.features()
        if len(y) < WINDOW:
            continue
        marked = np.flatnonzero(y != OUTSIDE)
        middle = int(dice.choice(marked)) if len(marked) else dice.randrange(len(y))
        at = min(max(middle - dice.randrange(WINDOW), 0), len(y) - WINDOW)
        yield dense[at : at + WINDOW], hashed[at : at + WINDOW], y[at : at + WINDOW]


def sample(documents: DataFrame, most: int = SAMPLE) -> DataFrame:
    """At most ``most`` different texts, those of the least hashes.

    Null texts are left out.  Copies of a text, of whatever id, are one.
    """
    hashed = documents.where("text is not null").select("text", F.xxhash64("text").alias("h"))
    wanted = hashed.select("h").distinct().orderBy("h").limit(most)  # bounded, so no other text is shuffled
    return hashed.join(F.broadcast(wanted), "h", "left_semi").groupBy("h").agg(F.min("text").alias("text"))


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            rows = [w for h, t in zip(piece.column("h").to_pylist(), piece.column("text").to_pylist()) for w in _windows(t, h)]
            columns = [
                [d.astype(np.float32).tobytes() for d, _, _ in rows],
                [h.astype(np.int32).tobytes() for _, h, _ in rows],
                [y.astype(np.int8).tobytes() for _, _, y in rows],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["dense", "hashed", "y"])


def blank() -> dict[str, np.ndarray]:
    """A model that tags nothing: no weights, and no step into inside but from begin and inside."""
    transition, start = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
    transition[OUTSIDE, INSIDE], start[INSIDE] = NEVER, NEVER
    return {"dense": np.zeros((DENSE, TAGS)), "hashed": np.zeros((HASHED * BUCKETS, TAGS)), "transition": transition, "start": start}


def train(documents: DataFrame, most: int = SAMPLE, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Fit the field by maximum likelihood on windows of a bounded sample of ``documents`` (a column text).

    What the base kinds hold to be secret is tagged in each sampled text; two more versions of it carry an invented
    secret in one of many forms, and an ordinary value in the same forms.  Numbers without letters are outside: they
    are left to the base kinds.  Gradients are summed by task; a round moves all weights once.  Without texts of at
    least 64 tokens the blank model comes out.
    """
    stored = saved(sample(documents, most).mapInArrow(_prepared, "dense binary, hashed binary, y binary").repartition(8))
    model = blank()
    shapes = {k: model[k].shape for k in ("dense", "hashed", "transition", "start")}
    sizes = [int(np.prod(s)) for s in shapes.values()]
    free = np.concatenate([(model[k] > NEVER / 2).ravel() for k in shapes])
    weights = np.concatenate([model[k].ravel() for k in shapes])
    first, second = np.zeros_like(weights), np.zeros_like(weights)

    def unfold(flat: np.ndarray) -> dict[str, np.ndarray]:
        cuts = np.split(flat, np.cumsum(sizes)[:-1])
        return {k: c.reshape(s) for (k, s), c in zip(shapes.items(), cuts)}

    def gradient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = unfold(weights)
        total, seen = np.zeros(len(weights)), 0
        for batch in batches:
            m = batch.num_rows
            dense = np.frombuffer(b"".join(batch.column("dense").to_pylist()), np.float32).reshape(-1, DENSE)
            hashed = np.frombuffer(b"".join(batch.column("hashed").to_pylist()), np.int32).reshape(-1, HASHED)
            y = np.frombuffer(b"".join(batch.column("y").to_pylist()), np.int8).reshape(m, WINDOW)
            score = emissions(dense, hashed, now).reshape(m, WINDOW, TAGS)
            found, steps = marginals(score, now["transition"], now["start"])
            wrong = (np.eye(TAGS)[y] - found).reshape(-1, TAGS)
            parts = unfold(total)
            parts["dense"] += dense.T @ wrong
            for tag in range(TAGS):
                flat = np.repeat(wrong[:, tag], HASHED)
                parts["hashed"][:, tag] += np.bincount(hashed.ravel(), flat, minlength=HASHED * BUCKETS)
            pairs = np.zeros((TAGS, TAGS))
            np.add.at(pairs, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            parts["transition"] += pairs - steps
            parts["start"] += (np.eye(TAGS)[y[:, 0]] - found[:, 0]).sum(axis=0)
            seen += m
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([seen])], ["g", "n"])

    for step in range(1, rounds + 1):
        parts = sorted((bytes(r["g"]), r["n"]) for r in stored.mapInArrow(gradient, "g binary, n long").collect())
        if not parts:
            break
        g = sum(np.frombuffer(b) for b, _ in parts) / sum(n for _, n in parts) - DECAY * np.where(free, weights, 0)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights = weights + np.where(free, move, 0)
    return unfold(weights)


def field_spans(texts: list[str], model: dict[str, np.ndarray], caution: float = CAUTION) -> list[list[tuple[int, int]]]:
    """Start and end (code points) of the spans that the field tags in each text.

    ``caution`` is added to the score of outside, so that a span must be that much better than none.
    """
    tokens = Tokens(texts)
    if not len(tokens.start):
        return [[] for _ in texts]
    score = emissions(*tokens.features(), model)
    score[:, OUTSIDE] += caution
    tag = viterbi(score, tokens.count, model["transition"], model["start"])
    begin = np.flatnonzero(tag == BEGIN)
    goes_on = np.append(tag[1:] == INSIDE, False)
    last = np.flatnonzero((tag != OUTSIDE) & ~goes_on)
    points = tokens.code_points()
    base = points[tokens.text_start]
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for b, e in zip(begin, last):
        owner = tokens.owner[b]
        out[owner].append((int(points[tokens.start[b]] - base[owner]), int(points[tokens.end[e]] - base[owner])))
    return out


def cut(text: str, most: int) -> Iterator[tuple[int, str]]:
    """Pieces of at most ``most`` characters with their offsets, cut after a line break or a blank where there is one."""
    at = 0
    while len(text) - at > most:
        end = max(text.rfind("\n", at, at + most), text.rfind(" ", at + most // 2, at + most)) + 1 or at + most
        yield at, text[at:end]
        at = end
    yield at, text[at:]


def all_spans(
    texts: list[str], model: dict[str, np.ndarray], caution: float = CAUTION, most: int = PIECE
) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and all spans: the field's join the base ones wherever they touch none of them.

    The field reads a text of more than ``most`` characters in pieces, one after the other, so that memory stays
    bounded; the base kinds always see the whole text.
    """
    pieces = [(k, at, piece) for k, text in enumerate(texts) for at, piece in cut(text, most)]
    field: list[list[tuple[int, int]]] = [[] for _ in texts]
    while pieces:
        size = np.cumsum([len(piece) for _, _, piece in pieces])
        n = max(1, int(np.searchsorted(size, most, side="right")))
        now, pieces = pieces[:n], pieces[n:]
        for (k, at, _), found in zip(now, field_spans([p for _, _, p in now], model, caution)):
            field[k] += [(at + a, at + b) for a, b in found]
    out = []
    for text, more in zip(texts, field):
        base = base_spans(text)
        apart = [(a, "crf", b) for a, b in more if not any(a < end and start < b for start, _, end in base)]
        out.append((base, sorted(base + apart, key=lambda s: (s[0], KINDS.index(s[1])))))
    return out


def scan(df: DataFrame, model: dict[str, np.ndarray], text: str = "text", caution: float = CAUTION) -> DataFrame:
    """Add ``base_spans`` and ``spans``, arrays of (kind, start, end) in code points, end exclusive, by start and kind.

    Whole texts are read, the field's part of very long ones in pieces of a million characters; a null text is empty
    and has no spans.  All columns and rows stay, repeated ones too; columns of the two names are replaced.  An empty
    table stays empty.
    """
    df = df.drop("base_spans", "spans")
    at = df.columns.index(text)
    names = [f"c{i}" for i in range(len(df.columns))]
    span = ArrayType(StructType([StructField(n, t()) for n, t in SPAN_FIELDS]))
    schema = df.toDF(*names).schema.add("b", span).add("s", span)
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(spans: list[Span]) -> list[dict]:
        return [{"kind": kind, "start": start, "end": end} for start, kind, end in spans]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, names[at], 1 << 20):
                found = all_spans([t or "" for t in piece.column(at).to_pylist()], model, caution)
                extra = [pa.array([rows(f[k]) for f in found], arrow) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*piece.columns, *extra], schema.fieldNames())

    return df.toDF(*names).mapInArrow(lean(find), schema).toDF(*df.columns, "base_spans", "spans")


def digest(spans: str) -> Column:
    """Column of the spans written as ``kind:start:end``, joined by commas."""
    piece = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(piece, ",")
