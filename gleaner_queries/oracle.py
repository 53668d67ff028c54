"""SQL counterparts of the registered queries."""

from __future__ import annotations

from gleaner.operators import answers
from gleaner_queries.queries import REFUSED, STOP_WORDS, WEIGHTS

REVIEWS = """reviews AS (
  SELECT l_partkey AS parent_asin, concat_ws('-', l_returnflag, l_linestatus, l_linenumber) AS title,
         l_quantity AS helpful_vote, l_orderkey, l_linenumber FROM lineitem)"""

RANKED = """ranked AS (
  SELECT parent_asin, title, helpful_vote, row_number() OVER (
    PARTITION BY parent_asin ORDER BY helpful_vote DESC, l_orderkey, l_linenumber) AS rn FROM reviews)"""

COMBINED = f"""{REVIEWS}, {RANKED}, combined AS (
  SELECT parent_asin, string_agg(title, ' | ' ORDER BY rn) AS combined_reviews
  FROM ranked WHERE rn <= 10 GROUP BY parent_asin)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS parent_asin, p_type AS main_category, p_name AS title,
         [p_brand, CASE WHEN p_size > 25 THEN p_size::VARCHAR END] AS features,
         string_split(p_name, ' ') AS description,
         CASE WHEN p_type <> 'PROMO' THEN 'brand size ' || p_brand || ' ' || p_size END AS details_text,
         p_retailprice AS average_rating FROM part)"""

DOCUMENTS = f"""WITH {COMBINED}, {PRODUCTS}
SELECT parent_asin, left(title, 100) AS product_title, average_rating,
       concat_ws(' ', main_category, title, array_to_string(features, ' '),
                 array_to_string(description, ' '), details_text, combined_reviews) AS document
FROM products LEFT JOIN combined USING (parent_asin)"""


def tokens(text: str) -> str:
    return rf"list_filter(string_split_regex({text}, '\s+'), lambda x: x <> '')"


def stop_tokens(text: str) -> str:
    words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    plain = f"regexp_replace(lower({text}), '[[:punct:]]', '', 'g')"
    return f"list_filter({tokens(plain)}, lambda x: x NOT IN ({words}))"


CORPUS = "rows AS (SELECT doc_id AS chunk_id, text FROM documents)"
QUERIES = "asked AS (SELECT item_id AS query_id, text AS query FROM benchmark)"

LONGEST = """asked AS (SELECT 0::BIGINT AS query_id, text AS query FROM benchmark
          ORDER BY length(text) DESC, item_id DESC LIMIT 1)"""


def chunks_fixed(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""chunks AS (
  SELECT doc_id, source, i::INTEGER AS chunk_pos, doc_id || '#' || printf('%06d', i) AS chunk_id,
         substr(text, i * {step} + 1, {size}) AS text
  FROM (SELECT doc_id, source, text, unnest(range(greatest(ceil((length(text) - {overlap}) / {step}.0), 1)::BIGINT))
        AS i FROM documents WHERE length(text) > 0))"""


# Blank lines, lines, words, characters: the break that a text of a level is cut at.
LEVEL = """CASE WHEN level <= 1 AND contains(text, chr(10) || chr(10)) THEN 1
  WHEN level <= 2 AND contains(text, chr(10)) THEN 2 WHEN level <= 3 AND contains(text, ' ') THEN 3 ELSE 4 END"""
MARK = "CASE lvl WHEN 1 THEN chr(10) || chr(10) WHEN 2 THEN chr(10) WHEN 3 THEN ' ' ELSE '' END"
CUT = f"""list_filter(list_transform(string_split(text, {MARK}),
  lambda p, n: CASE WHEN n = 1 THEN p ELSE {MARK} || p END), lambda p: p <> '')"""
PARAGRAPHS = """paragraphs AS (
  SELECT doc_id AS id, source, replace(text, 'e.' || chr(10), 'e.' || chr(10) || chr(10)) AS text FROM documents)"""


def chunks_recursive(size: int, overlap: int, name: str = "chunks", rows: str = "paragraphs") -> str:
    """Texts ``(id, source, text)`` cut level by level; short pieces between long ones are packed by a fold."""
    kept = f"""list_filter(a.win, lambda w, n:
      list_sum(list_transform(a.win[n:], lambda q: length(q))) <= least({overlap}, {size} - x.total))"""
    cut = f"""SELECT id, source, path, lvl, unnest(cut) AS piece, generate_subscripts(cut, 1) AS i
    FROM (SELECT id, source, path, lvl, {CUT} AS cut FROM (SELECT *, {LEVEL} AS lvl FROM {name}_texts))"""
    return f"""{name}_texts AS (
  SELECT id, source, [0]::BIGINT[] AS path, text, 1 AS level FROM {rows}
  UNION ALL
  SELECT id, source, list_append(path, i), piece, lvl + 1 FROM ({cut}) WHERE length(piece) >= {size} AND lvl < 4),
{name}_runs AS (
  SELECT id, source, list_append(path, min(i)) AS place,
         list(struct_pack(done := []::VARCHAR[], win := [piece], total := length(piece)) ORDER BY i) AS steps
  FROM (SELECT *, count(*) FILTER (length(piece) >= {size}) OVER (PARTITION BY id, path ORDER BY i) AS run FROM ({cut}))
  WHERE length(piece) < {size} GROUP BY id, source, path, run),
{name}_packed AS (
  SELECT id, source, place, list_append(f.done, array_to_string(f.win, '')) AS texts FROM (
    SELECT id, source, place, list_reduce(steps, lambda a, x: CASE WHEN a.total + x.total > {size}
      THEN struct_pack(done := list_append(a.done, array_to_string(a.win, '')), win := list_append({kept}, x.win[1]),
                       total := (coalesce(list_sum(list_transform({kept}, lambda q: length(q))), 0) + x.total)::BIGINT)
      ELSE struct_pack(done := a.done, win := list_append(a.win, x.win[1]), total := a.total + x.total) END) AS f
    FROM {name}_runs)),
{name} AS (
  SELECT id AS doc_id, source, chunk_pos, id || '#' || printf('%06d', chunk_pos) AS chunk_id, text FROM (
    SELECT id, source, (row_number() OVER (PARTITION BY id ORDER BY place, j) - 1)::INTEGER AS chunk_pos, text FROM (
      SELECT id, source, place, regexp_replace(unnest(texts), '^\\s+|\\s+$', '', 'g') AS text,
             generate_subscripts(texts, 1) AS j FROM {name}_packed) WHERE text <> ''))"""


def index(rows: str = "rows", cut=tokens) -> str:
    """Postings, term weights and corpus statistics of a ``rows(chunk_id, text)`` table."""
    return f"""words AS (SELECT chunk_id, unnest({cut('text')}) AS term FROM {rows}),
post AS MATERIALIZED (SELECT chunk_id, term, count(*) AS tf FROM words GROUP BY ALL),
lens AS (SELECT chunk_id, len({cut('text')}) AS dl FROM {rows}),
stat AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM lens),
freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
raw AS MATERIALIZED (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS idf0 FROM freq, stat),
weights AS (SELECT term, df, CASE WHEN idf0 < 0 THEN 0.25 * (SELECT avg(idf0) FROM raw) ELSE idf0 END AS idf
            FROM raw)"""


def scores(cut=tokens) -> str:
    return f"""needle AS (SELECT query_id, unnest({cut('query')}) AS term FROM asked),
scored AS (SELECT query_id, chunk_id,
                  sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
           FROM needle JOIN post USING (term) JOIN weights USING (term) JOIN lens USING (chunk_id), stat
           GROUP BY ALL)"""


def top(name: str, source: str, value: str, direction: str, k: int) -> str:
    return f"""{name} AS (
  SELECT query_id, row_number() OVER (
    PARTITION BY query_id ORDER BY round({value}, 9) {direction}, chunk_id)::INTEGER AS rank, chunk_id, {value}
  FROM {source} QUALIFY rank <= {k})"""


BM25_HITS = top("bm25", "scored", "score", "DESC", 5)
BM25 = f"{CORPUS}, {QUERIES}, {index()}, {scores()}, {BM25_HITS}"
ROUNDED = "SELECT query_id, rank, chunk_id, round(score, 6) AS score FROM"


def embedded(name: str, id_col: str, text: str, source: str) -> str:
    """Dense vectors of hashed token counts, unit length, in single precision."""
    return f"""{name}_count AS (
  SELECT {id_col}, ('0x' || left(md5(term), 8))::BIGINT % 64 AS b, count(*) AS c
  FROM (SELECT {id_col}, unnest({tokens(text)}) AS term FROM {source}) GROUP BY ALL),
{name}_norm AS (SELECT {id_col}, sqrt(sum(c * c)) AS norm FROM {name}_count GROUP BY ALL),
{name} AS (
  SELECT g.{id_col}, list((coalesce(c / norm, 0))::FLOAT::DOUBLE ORDER BY g.b) AS v
  FROM (SELECT {id_col}, unnest(range(64)) AS b FROM {source}) g
  LEFT JOIN {name}_count c ON g.{id_col} = c.{id_col} AND g.b = c.b
  LEFT JOIN {name}_norm m ON g.{id_col} = m.{id_col} GROUP BY ALL)"""


SEMANTIC = f"""{embedded('qv', 'query_id', 'query', 'asked')}, {embedded('dv', 'chunk_id', 'text', 'rows')},
near AS (SELECT query_id, chunk_id, list_distance(qv.v, dv.v) ** 2 AS distance FROM qv, dv),
{top('sem', 'near', 'distance', 'ASC', 5)}"""
BOTH = f"{BM25}, {SEMANTIC}"


def knn(expression: str) -> str:
    return f"""WITH near AS (
  SELECT a.vec_id AS query_id, b.vec_id AS chunk_id, {expression} AS distance
  FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) a,
       (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) b),
{top('hits', 'near', 'distance', 'ASC', 5)}"""


KNN_L2 = knn("list_distance(a.v, b.v) ** 2")
KNN_ROUNDED = "SELECT query_id, rank, chunk_id, round(distance, 6) AS distance FROM hits"

FUSED = """lists AS (SELECT query_id, rank, chunk_id, 0 AS list, 0.4::DOUBLE AS weight FROM bm25
          UNION ALL SELECT query_id, rank, chunk_id, 1, 0.6::DOUBLE FROM sem),
merged AS (SELECT query_id, chunk_id, sum(weight / (rank + 60)) AS rrf, min((list, rank)) AS seen
           FROM lists GROUP BY ALL),
fused AS (SELECT query_id, row_number() OVER (
            PARTITION BY query_id ORDER BY round(rrf, 12) DESC, seen)::INTEGER AS rank, chunk_id, rrf FROM merged)"""
FUSED_ROWS = "SELECT query_id, rank, chunk_id, round(rrf, 9) AS rrf FROM fused"

BY_TEXT = """lists AS (
          SELECT query_id, rank, chunk_id, text, 0 AS list, 0.4::DOUBLE AS weight FROM bm25 JOIN {bm25} USING (chunk_id)
          UNION ALL SELECT query_id, rank, chunk_id, text, 1, 0.6::DOUBLE FROM sem JOIN {sem} USING (chunk_id)),
        keyed AS (SELECT *, md5(text) AS content_key FROM lists),
        merged AS (SELECT query_id, content_key, sum(weight / (rank + 60)) AS rrf, min((list, rank)) AS seen,
                          arg_min(chunk_id, (list, rank)) AS chunk_id FROM keyed GROUP BY query_id, content_key)
        SELECT query_id, row_number() OVER (
                 PARTITION BY query_id ORDER BY round(rrf, 12) DESC, seen)::INTEGER AS rank,
               content_key, chunk_id, round(rrf, 9) AS rrf FROM merged"""

DESCRIBED = """described AS (
  SELECT doc_id AS chunk_id, doc_id AS parent_asin, concat_ws('/', source, lang) AS product_title,
         quality::DOUBLE AS average_rating, text FROM documents LEFT JOIN labels USING (doc_id))"""
CONTEXT = f"""{BOTH}, {FUSED}, {DESCRIBED}, contexts AS (
  SELECT query_id, string_agg('Product ASIN: ' || parent_asin || chr(10) || 'Title: ' || product_title || chr(10)
    || 'Average Rating: ' || coalesce(average_rating::VARCHAR, 'N/A') || chr(10)
    || 'Content: ' || text || chr(10), chr(10) || chr(10) ORDER BY rank) AS context
  FROM fused JOIN described USING (chunk_id) GROUP BY query_id)"""

POSITIVES = r"""sentences AS (
  SELECT DISTINCT chunk_id, s FROM (
    SELECT chunk_id, unnest(string_split_regex(regexp_replace(text, '\s+', ' ', 'g'), '\. ?')) AS s FROM rows)
  WHERE s <> ''),
wanted AS (
  SELECT DISTINCT query_id, s FROM (
    SELECT query_id, unnest(string_split_regex(regexp_replace(query, '\s+', ' ', 'g'), '\. ?')) AS s FROM asked)
  WHERE s <> ''),
positives AS (SELECT DISTINCT query_id, chunk_id FROM wanted JOIN sentences USING (s))"""

GRID = ", ".join(str(w) for w in WEIGHTS)
SWEPT = f"""grid AS (SELECT unnest([{GRID}])::DOUBLE AS bm25_weight),
both_lists AS (SELECT query_id, rank, chunk_id, 0 AS list FROM bm25
               UNION ALL SELECT query_id, rank, chunk_id, 1 FROM sem),
swept_scores AS (
  SELECT bm25_weight, query_id, chunk_id, min((list, rank)) AS seen,
         sum(CASE WHEN list = 0 THEN bm25_weight ELSE 1 - bm25_weight END / (rank + 60)) AS rrf
  FROM both_lists, grid GROUP BY ALL),
swept AS (SELECT bm25_weight, query_id, chunk_id, rrf, row_number() OVER (
            PARTITION BY bm25_weight, query_id ORDER BY round(rrf, 12) DESC, seen)::INTEGER AS rank
          FROM swept_scores)"""

THINK = "'<think>plan' || chr(10) || text || '</think>' || chr(10) || '  ' || text"
MARKED = f"""marked AS (
  SELECT conv_id, turn,
         CASE role WHEN 'assistant' THEN {THINK} WHEN 'user' THEN {THINK} || ' <think>again</think> end '
                   ELSE text END AS reasoned,
         CASE WHEN role = 'assistant' THEN 'Human: hi' || chr(10) || 'Assistant: ' || text || ' Assistant: bye' || chr(9)
              ELSE text END AS replied
  FROM conversations)"""


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def after(text: str, marker: str) -> str:
    return strip(
        f"CASE WHEN instr({text}, '{marker}') > 0 "
        f"THEN substr({text}, instr({text}, '{marker}') + {len(marker)}) ELSE {text} END"
    )


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


BREAK = "chr(10) || chr(10)"
RAG_PROMPT = f"""{quoted(answers.SYSTEM_TEXT)} || {BREAK} || 'context:' || chr(10)
          || coalesce(context, '') || {BREAK} || 'question:' || chr(10) || query"""
GENERATED = f"""{CONTEXT}, generated AS (
  SELECT query_id, query, model, coalesce('Error: ' || error,
         '<think>' || model || chr(10) || '</think> ' || length(prompt) || ' characters, ' || model) AS answer, error
  FROM (SELECT *, CASE WHEN model IS NULL OR model = 'broken' THEN 'cannot make ' || coalesce(model, 'None')
                       WHEN contains(query, {quoted(REFUSED)}) THEN 'refused'
                       WHEN model = 'short' THEN '0 answers for 1 prompts' END AS error
        FROM (SELECT query_id, query, {RAG_PROMPT} AS prompt, unnest(['plain', 'loud', 'short', 'broken', NULL]) AS model
              FROM asked LEFT JOIN contexts USING (query_id))))"""

DOC_CHUNKS_1000 = f"{chunks_fixed(1000, 100)}, {QUERIES}, {index('chunks')}, {scores()}"

SHORT_QUERIES = """asked AS (
  SELECT item_id AS query_id, array_to_string(string_split(text, ' ')[3:5], ' ') AS query FROM benchmark)"""
LIVE_CHUNKS = chunks_fixed(1000, 100).replace("FROM documents WHERE", "FROM documents WHERE doc_id % 50 <> 7 AND")
REFRESHED = f"{LIVE_CHUNKS}, {QUERIES}, {index('chunks')}"

ORACLE = {
    "bm25_pruned": f"WITH {BM25} {ROUNDED} bm25",
    "bm25_pruned_short": f"WITH {CORPUS}, {SHORT_QUERIES}, {index()}, {scores()}, {BM25_HITS} {ROUNDED} bm25",
    "refresh_index_bm25": f"WITH {REFRESHED}, {scores()}, {BM25_HITS} {ROUNDED} bm25",
    "refresh_index_compacted": f"WITH {REFRESHED}, {scores()}, {BM25_HITS} {ROUNDED} bm25",
    "refresh_index_stats": f"""WITH {REFRESHED}
        SELECT term, df, sum(tf)::BIGINT AS ctf, round(idf, 9) AS idf FROM weights JOIN post USING (term) GROUP BY ALL""",
    "refresh_index_semantic": f"""WITH {LIVE_CHUNKS}, {QUERIES}, {SEMANTIC.replace('FROM rows', 'FROM chunks')}
        SELECT query_id, rank, chunk_id, round(distance, 6) AS distance FROM sem""",
    "top_k_reviews": f"WITH {COMBINED} SELECT parent_asin, combined_reviews FROM combined",
    "ranked_reviews": f"""WITH {REVIEWS}, {RANKED}
        SELECT parent_asin, title, helpful_vote, rn::INTEGER AS rn FROM ranked WHERE rn <= 10""",
    "merge_left": f"""WITH {COMBINED}, {PRODUCTS}
        SELECT parent_asin, main_category, title, average_rating, combined_reviews
        FROM products LEFT JOIN combined USING (parent_asin)""",
    "left_unmatched": """SELECT doc_id, lang, n_chars, quality AS combined_reviews
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "build_documents": DOCUMENTS,
    "documents_from_sources": DOCUMENTS,
    "first_non_null": """SELECT source, arg_min(quality, doc_id) FILTER (quality IS NOT NULL) AS quality,
        arg_min(toxic, doc_id) FILTER (toxic IS NOT NULL) AS toxic
        FROM documents LEFT JOIN labels USING (doc_id) WHERE source IS NOT NULL GROUP BY source""",
    "details_flatten": """SELECT event_id, array_to_string(json_keys(props), ' ') || ' ' || array_to_string(
        list_transform(json_keys(props), lambda k: json_extract_string(props, '$.' || k)), ' ') AS details_text
        FROM events""",
    "array_flatten": """SELECT p_partkey AS parent_asin,
        array_to_string([p_brand, CASE WHEN p_size > 25 THEN p_size::VARCHAR END], ' ') AS features_text,
        concat_ws(' ', p_type, '', CASE WHEN p_type <> 'PROMO' THEN p_size::VARCHAR END, p_name) AS joined
        FROM part""",
    "short_titles": "SELECT doc_id, left(text, 100) AS title FROM documents",
    "subset_first_n": "SELECT * FROM part ORDER BY p_partkey LIMIT 1000",
    "text_metadata_split": "SELECT doc_id, lang, source, n_chars, md5(text) AS text_hash FROM documents",
    "text_reduced_metadata": "SELECT doc_id, source, length(text)::INTEGER AS chars FROM documents",
    "vote_boost": """SELECT l_partkey AS parent_asin, round(ln(1 + sum(l_quantity)), 6) AS boost
        FROM lineitem GROUP BY l_partkey""",
    "refresh_changed": f"""WITH {REVIEWS},
        touched AS (SELECT DISTINCT parent_asin FROM reviews WHERE title LIKE 'R%' AND parent_asin % 4 = 0),
        known AS (SELECT * FROM reviews WHERE title NOT LIKE 'R%' OR parent_asin IN (FROM touched)),
        ranked AS (SELECT parent_asin, title, row_number() OVER (
            PARTITION BY parent_asin ORDER BY helpful_vote DESC, l_orderkey, l_linenumber) AS rn FROM known),
        combined AS (SELECT parent_asin, string_agg(title, ' | ' ORDER BY rn) AS combined_reviews
            FROM ranked WHERE rn <= 10 GROUP BY parent_asin)
        SELECT p_partkey AS parent_asin, left(p_name, 100) AS product_title, p_retailprice AS average_rating,
               concat_ws(' ', p_type, p_name, combined_reviews) AS document
        FROM part LEFT JOIN combined ON p_partkey = parent_asin""",
    "stateful_top_k": f"WITH {COMBINED} SELECT parent_asin, combined_reviews FROM combined",
    "stateful_documents": f"""WITH {COMBINED}
        SELECT p_partkey AS parent_asin, left(p_name, 100) AS product_title, p_retailprice AS average_rating,
               concat_ws(' ', p_type, p_name, combined_reviews) AS document
        FROM part JOIN combined ON p_partkey = parent_asin""",
    "profile_table": """WITH joined AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
        SELECT (SELECT count(*) FROM joined) AS row_count, * FROM (
          SELECT 'doc_id' AS column_name, 'bigint' AS column_type, count(doc_id) AS non_null FROM joined
          UNION ALL SELECT 'text', 'string', count(text) FROM joined
          UNION ALL SELECT 'lang', 'string', count(lang) FROM joined
          UNION ALL SELECT 'source', 'string', count(source) FROM joined
          UNION ALL SELECT 'n_chars', 'bigint', count(n_chars) FROM joined
          UNION ALL SELECT 'quality', 'int', count(quality) FROM joined
          UNION ALL SELECT 'toxic', 'int', count(toxic) FROM joined)""",
    "count_by_category": "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source",
    "count_by_rating": "SELECT quality, count(*) AS n FROM labels GROUP BY quality ORDER BY n DESC, quality",
    "distinct_values": "SELECT DISTINCT lang FROM documents",
    "documents_loaded": "SELECT count(text) AS documents FROM documents",
    "nan_to_null": """SELECT l_returnflag, count(*) FILTER (l_discount <> 0) AS present, count(*) AS total
        FROM lineitem GROUP BY l_returnflag""",
    "null_key_filter": """SELECT doc_id, lang, labels.doc_id AS label_key, quality
        FROM documents JOIN labels USING (doc_id)""",
    "empty_query_guard": f"""SELECT conv_id, turn, {strip('text')} AS query FROM conversations
        WHERE role <> 'system' AND {strip('text')} <> ''""",
    "empty_result_guard": """SELECT doc_id AS query_id, coalesce('quality ' || quality, 'No results found.') AS answer
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "field_defaults": """SELECT doc_id AS chunk_id, coalesce(quality::DOUBLE::VARCHAR, 'N/A') AS rating
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "hit_labels": """SELECT p_partkey, 'Rating: ' || printf('%.1f', p_retailprice / 4) AS rating_label,
        printf('%.4f', p_retailprice / 7) AS score_label, '#' || p_size AS rank_label,
        p_name || p_retailprice::VARCHAR AS title_rating FROM part""",
    "type_names": """SELECT CASE json_type(props, '$.k') WHEN 'VARCHAR' THEN 'STRING' WHEN 'DOUBLE' THEN 'DOUBLE'
        WHEN 'BOOLEAN' THEN 'BOOLEAN' ELSE 'BIGINT' END AS type, count(*) AS n FROM events GROUP BY 1""",
    "array_elements": """SELECT p_partkey AS parent_asin, string_split(p_name, ' ')[1] AS first_word,
        string_split(p_name, ' ')[6] AS sixth_word FROM part""",
    "tokenise_terms": f"""SELECT doc_id, len({tokens('text')})::INTEGER AS tokens,
        md5(array_to_string({tokens('text')}, ' ')) AS tokens_hash FROM documents""",
    "tokenise_lowercase": f"""SELECT term, count(*) AS n FROM (
        SELECT unnest({tokens('lower(text)')}) AS term FROM documents) GROUP BY term""",
    "tokenise_without_stop_words": f"""SELECT item_id, len({stop_tokens('text')})::INTEGER AS tokens,
        array_to_string({stop_tokens('text')}, ' ') AS joined FROM benchmark""",
    "strip_reasoning": f"""WITH {MARKED} SELECT conv_id, turn,
        {strip("regexp_replace(reasoned, '(?s)<think>.*?</think>', '', 'g')")} AS answer FROM marked""",
    "after_reasoning": f"WITH {MARKED} SELECT conv_id, turn, {after('reasoned', '</think>')} AS answer FROM marked",
    "after_assistant": f"WITH {MARKED} SELECT conv_id, turn, {after('replied', 'Assistant:')} AS answer FROM marked",
    "chunk_fixed": f"WITH {chunks_fixed(500, 100)} SELECT doc_id, source, chunk_pos, chunk_id, text FROM chunks",
    "chunk_recursive": f"""WITH RECURSIVE {PARAGRAPHS}, {chunks_recursive(500, 100)}
        SELECT doc_id, source, chunk_pos, chunk_id, text FROM chunks""",
    "chunk_recursive_sweep": " UNION ALL ".join(
        f"""SELECT {size}::INTEGER AS chunk_size, {overlap}::INTEGER AS chunk_overlap, count(*) AS chunks,
            round(avg(length(text)), 6) AS mean_chars
            FROM (WITH RECURSIVE {PARAGRAPHS}, {chunks_recursive(size, overlap)} SELECT * FROM chunks)"""
        for size, overlap in [(300, 50), (500, 100), (1000, 100)]
    ),
    "chunk_size_sweep": " UNION ALL ".join(
        f"""SELECT {size}::INTEGER AS chunk_size, {overlap}::INTEGER AS chunk_overlap, count(*) AS chunks,
            round(avg(length(text)), 6) AS mean_chars
            FROM (WITH {chunks_fixed(size, overlap)} SELECT * FROM chunks)"""
        for size, overlap in [(300, 50), (500, 100), (1000, 100)]
    ),
    "bm25_postings": f"""WITH {CORPUS}, {index()}
        SELECT chunk_id, dl::INTEGER AS dl, term, tf::INTEGER AS tf FROM post JOIN lens USING (chunk_id)""",
    "bm25_term_stats": f"WITH {CORPUS}, {index()} SELECT term, df, round(idf, 9) AS idf FROM weights",
    "bm25_corpus_stats": f"""WITH {CORPUS}, {index()}
        SELECT n, round(avgdl, 9) AS avgdl, (SELECT round(avg(idf0), 9) FROM raw) AS avg_idf FROM stat""",
    "bm25_search": f"WITH {BM25} {ROUNDED} bm25",
    "bm25_stored_index": f"WITH {BM25} {ROUNDED} bm25",
    "bm25_search_padded": f"""WITH {CORPUS},
        asked AS (SELECT item_id AS query_id, text AS query FROM benchmark
                  UNION ALL SELECT item_id + 1000000, string_split(text, ' ')[-1] FROM benchmark
                  UNION ALL SELECT item_id + 2000000, md5(text) FROM benchmark),
        {index()}, {scores()},
        padded AS (SELECT query_id, chunk_id, coalesce(score, 0) AS score
                   FROM (SELECT query_id, chunk_id FROM asked, rows) LEFT JOIN scored USING (query_id, chunk_id)),
        {top('hits', 'padded', 'score', 'DESC', 5)} {ROUNDED} hits""",
    "bm25_search_lowercase": f"""WITH {CORPUS}, {QUERIES}, {index(cut=stop_tokens)}, {scores(stop_tokens)},
        {BM25_HITS} {ROUNDED} bm25""",
    "bm25_chunks": f"WITH {DOC_CHUNKS_1000}, {BM25_HITS} {ROUNDED} bm25",
    "bm25_recursive_chunks": f"""WITH RECURSIVE {PARAGRAPHS}, {chunks_recursive(1000, 100)}, {QUERIES}, {index('chunks')},
        {scores()}, {BM25_HITS} {ROUNDED} bm25""",
    "bm25_collapsed": f"""WITH {DOC_CHUNKS_1000}, {top('hits', 'scored', 'score', 'DESC', 10)},
        best AS (SELECT *, string_split(chunk_id, '#')[1]::BIGINT AS parent_asin FROM hits
                 QUALIFY row_number() OVER (PARTITION BY query_id, parent_asin ORDER BY rank) = 1)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY rank)::INTEGER AS rank,
               parent_asin, chunk_id, round(score, 6) AS score FROM best""",
    "hit_fields": f"""WITH {BM25}, {DESCRIBED}
        SELECT query_id, rank, parent_asin, product_title, average_rating, round(score, 6) AS score
        FROM bm25 JOIN described USING (chunk_id)""",
    "hits_per_query": f"""WITH {BM25} SELECT query_id, 'BM25' AS mode, count(*) AS hits,
        'Top ' || count(*) || ' results — BM25 mode' AS label FROM bm25 GROUP BY query_id""",
    "knn_l2": f"{KNN_L2} {KNN_ROUNDED}",
    "knn_blocks": f"{KNN_L2} {KNN_ROUNDED}",
    "knn_stored_cells": f"{KNN_L2} {KNN_ROUNDED}",
    "knn_stored_index": f"{KNN_L2} {KNN_ROUNDED}",
    "knn_cosine": f"{knn('1 - list_cosine_similarity(a.v, b.v)')} {KNN_ROUNDED}",
    "knn_label_precision": f"""{KNN_L2}
        SELECT query_id, avg((a.label = b.label)::INTEGER::DOUBLE) AS precision FROM hits
        JOIN embeddings a ON a.vec_id = query_id JOIN embeddings b ON b.vec_id = chunk_id GROUP BY query_id""",
    "hash_embed": f"""WITH {CORPUS}, {embedded('dv', 'chunk_id', 'text', 'rows')}
        SELECT chunk_id, (i - 1)::INTEGER AS position, round(v[i], 6) AS value
        FROM (SELECT chunk_id, v, unnest(range(1, 65)) AS i FROM dv)""",
    "semantic_search": f"""WITH {CORPUS}, {QUERIES}, {SEMANTIC}
        SELECT query_id, rank, chunk_id, round(distance, 6) AS distance FROM sem""",
    "hybrid_rrf": f"WITH {BOTH}, {FUSED} {FUSED_ROWS}",
    "hybrid_top_k": f"WITH {BOTH}, {FUSED} {FUSED_ROWS} WHERE rank <= 5",
    "hybrid_by_text": f"WITH {BOTH}, {BY_TEXT.format(bm25='rows', sem='rows')}",
    "hybrid_two_chunkings": f"""WITH RECURSIVE {PARAGRAPHS}, {chunks_recursive(1000, 100, 'long')},
        {chunks_recursive(500, 100, 'short')}, {QUERIES}, {index('long')}, {scores()}, {BM25_HITS},
        {SEMANTIC.replace('FROM rows', 'FROM short')}, {BY_TEXT.format(bm25='long', sem='short')}""",
    "raw_to_search": f"""WITH RECURSIVE product_documents AS ({DOCUMENTS}),
        paragraphs AS (SELECT parent_asin AS id, 0 AS source, document AS text FROM product_documents),
        {chunks_recursive(500, 100, 'rows')},
        asked AS (SELECT p_partkey AS query_id, concat_ws(' ', p_name, p_type) AS query FROM part WHERE p_partkey % 50 = 0),
        {index()}, {scores()}, {BM25_HITS}, {SEMANTIC}, {FUSED} {FUSED_ROWS}""",
    "side_by_side": f"""WITH {BOTH}, {DESCRIBED},
        l AS (SELECT query_id, rank, product_title FROM sem JOIN described USING (chunk_id)),
        r AS (SELECT query_id, rank, product_title FROM bm25 JOIN described USING (chunk_id))
        SELECT query_id, rank, query, l.product_title AS semantic_search_results,
               r.product_title AS bm25_search_results
        FROM l FULL JOIN r USING (query_id, rank) JOIN asked USING (query_id)""",
    "mode_search": f"""WITH {BOTH} SELECT query_id, rank, chunk_id, 'BM25' AS mode FROM bm25
        UNION ALL SELECT query_id, rank, chunk_id, 'Semantic' FROM sem""",
    "overlap_at_k": f"""WITH {BOTH}, items AS (
          SELECT query_id, chunk_id, max(a) AS a, max(b) AS b FROM (
            SELECT query_id, chunk_id, 1 AS a, 0 AS b FROM bm25
            UNION ALL SELECT query_id, chunk_id, 0, 1 FROM sem) GROUP BY ALL)
        SELECT query_id, sum(a * b)::BIGINT AS shared, sum(a * b) / 5 AS overlap FROM items GROUP BY query_id""",
    "recall_at_k": f"""WITH {BM25}, {POSITIVES}
        SELECT query_id, count(*) AS relevant, count(bm25.chunk_id) AS found,
               count(bm25.chunk_id) / count(*) AS recall
        FROM positives LEFT JOIN bm25 USING (query_id, chunk_id) GROUP BY query_id""",
    "weight_sweep": f"""WITH {BOTH}, {SWEPT}
        SELECT bm25_weight, query_id, chunk_id, round(rrf, 9) AS rrf, rank FROM swept""",
    "weight_sweep_recall": f"""WITH {BOTH}, {SWEPT}, {POSITIVES},
        total AS (SELECT query_id, count(*) AS relevant FROM positives GROUP BY query_id),
        hit AS (SELECT bm25_weight, query_id, count(*) AS found FROM swept
                JOIN positives USING (query_id, chunk_id) WHERE rank <= 5 GROUP BY ALL)
        SELECT bm25_weight, round(avg(coalesce(found, 0) / relevant), 9) AS recall
        FROM (SELECT DISTINCT bm25_weight, query_id FROM swept) JOIN total USING (query_id)
        LEFT JOIN hit USING (bm25_weight, query_id) GROUP BY bm25_weight""",
    "rerank_pool": f"""WITH {BOTH}, {FUSED}, again AS (
          SELECT query_id, rank AS first_rank, chunk_id, rrf / ln(1 + length(text)) AS rerank_score
          FROM fused JOIN rows USING (chunk_id))
        SELECT query_id, row_number() OVER (
                 PARTITION BY query_id ORDER BY round(rerank_score, 9) DESC, chunk_id)::INTEGER AS rank,
               first_rank, chunk_id, round(rerank_score, 9) AS rerank_score FROM again QUALIFY rank <= 5""",
    "rerank_proximity": f"""WITH {BOTH}, {FUSED},
        query_words AS (SELECT query_id, unnest({tokens('query')}) AS w,
                               generate_subscripts({tokens('query')}, 1) AS i FROM asked),
        pairs AS (SELECT x.query_id, x.w AS a, y.w AS b, count(*) AS times FROM query_words x
                  JOIN query_words y ON x.query_id = y.query_id AND y.i = x.i + 1 AND x.w <> y.w GROUP BY ALL),
        totals AS (SELECT query_id, sum(times) AS pairs FROM pairs GROUP BY query_id),
        spots AS MATERIALIZED (SELECT chunk_id, unnest({tokens('text')}) AS w,
                  generate_subscripts({tokens('text')}, 1) AS i
                  FROM rows WHERE chunk_id IN (SELECT chunk_id FROM fused)),
        gaps AS (SELECT f.query_id, f.chunk_id, a, b, times, min(abs(y.i - x.i)) AS gap,
                        max((y.i = x.i + 1)::INTEGER) AS in_order
                 FROM fused f JOIN pairs p ON f.query_id = p.query_id
                 JOIN spots x ON x.chunk_id = f.chunk_id AND x.w = a
                 JOIN spots y ON y.chunk_id = f.chunk_id AND y.w = b GROUP BY ALL),
        sums AS (SELECT query_id, chunk_id, sum(times / (gap * gap)) AS near, sum(times * in_order) AS side
                 FROM gaps GROUP BY ALL),
        again AS (SELECT f.query_id, f.rank AS first_rank, f.chunk_id, rrf,
                         coalesce(near / pairs, 0) AS proximity, coalesce(side / pairs, 0) AS phrases
                  FROM fused f LEFT JOIN sums USING (query_id, chunk_id) LEFT JOIN totals USING (query_id)),
        scored_again AS (SELECT *, rrf * (1 + proximity + phrases) AS rerank_score FROM again)
        SELECT query_id, row_number() OVER (
                 PARTITION BY query_id ORDER BY round(rerank_score, 9) DESC, chunk_id)::INTEGER AS rank,
               first_rank, chunk_id, round(proximity, 9) AS proximity, round(phrases, 9) AS phrases,
               round(rerank_score, 9) AS rerank_score FROM scored_again QUALIFY rank <= 5""",
    "order_by_rating": f"""WITH {BM25}, {DESCRIBED}
        SELECT query_id, row_number() OVER (
                 PARTITION BY query_id ORDER BY average_rating DESC NULLS LAST, chunk_id)::INTEGER AS rank,
               chunk_id, average_rating FROM bm25 JOIN described USING (chunk_id)""",
    "rubric_scores": """SELECT 'quality' AS dimension, count(quality) AS judged, avg(quality) AS share FROM labels
        UNION ALL SELECT 'toxic', count(toxic), avg(toxic) FROM labels""",
    "rag_context": f"WITH {CONTEXT} SELECT query_id, context FROM contexts",
    "rag_titles_context": f"""WITH {BOTH}, {FUSED}, {DESCRIBED}
        SELECT query_id, string_agg('Product ASIN: ' || parent_asin || chr(10) || 'Title: ' || product_title
          || chr(10), chr(10) || chr(10) ORDER BY rank) AS context
        FROM fused JOIN described USING (chunk_id) GROUP BY query_id""",
    "rag_prompt": f"""WITH {CONTEXT}
        SELECT query_id, {RAG_PROMPT} AS prompt FROM asked LEFT JOIN contexts USING (query_id)""",
    "prompt_variants": f"""SELECT item_id AS query_id, r_name AS prompt_id, 'Answer for ' || r_name || '.' || {BREAK}
          || 'context:' || chr(10) || 'none' || {BREAK} || 'question:' || chr(10) || text || {BREAK} || 'Reply:' AS prompt
        FROM benchmark, region""",
    "generate_answers": f"WITH {GENERATED} SELECT query_id, model, answer, error FROM generated",
    "generate_resumed": f"""WITH {GENERATED}
        SELECT query_id, model, CASE WHEN error IS NULL THEN answer ELSE 'again ' || length({RAG_PROMPT}) END AS answer,
               NULL::VARCHAR AS error FROM generated LEFT JOIN contexts USING (query_id)""",
    "embed_stored": f"""WITH {CORPUS}, {embedded('dv', 'chunk_id', 'text', 'rows')}
        SELECT chunk_id, round(v[7], 6) AS value FROM dv UNION ALL SELECT -chunk_id - 1, round(v[7], 6) FROM dv""",
    "model_compare": f"""WITH {GENERATED}, cleaned AS (
          SELECT query_id, query, model, {after('answer', '</think>')} AS answer FROM generated)
        SELECT query_id, query, max(answer) FILTER (model = 'plain') AS "plain's response",
               max(answer) FILTER (model = 'loud') AS "loud's response" FROM cleaned
        WHERE model IN ('plain', 'loud') GROUP BY ALL""",
    "answer_table": f"""WITH {GENERATED}
        SELECT query, {after('answer', '</think>')} AS "Output Response" FROM generated WHERE model = 'plain'""",
    "json_reviews": """SELECT l_partkey::VARCHAR AS parent_asin,
        concat_ws('-', l_returnflag, l_linestatus, l_linenumber) AS title, l_quantity::BIGINT AS helpful_vote
        FROM lineitem""",
    "json_meta": f"""WITH {PRODUCTS} SELECT parent_asin::VARCHAR AS parent_asin, title,
          array_to_string(features, ' ') AS features_text, details_text, average_rating FROM products
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL FROM region""",
    "json_bad_lines": """SELECT CASE WHEN c_acctbal >= 0 THEN c_name END AS parent_asin,
        CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS title,
        CASE WHEN c_acctbal < 0 THEN '{bad ' || c_name END AS bad, 'keep' AS mode FROM customer
        UNION ALL SELECT c_name, c_mktsegment, NULL, 'drop' FROM customer WHERE c_acctbal >= 0""",
    "category_files": """SELECT c_custkey::VARCHAR AS parent_asin, c_name AS title, c_mktsegment AS subset,
          'reviews' AS side FROM customer
        UNION ALL SELECT c_custkey::VARCHAR, CASE WHEN c_custkey % 3 > 0 THEN c_name ELSE 'Unknown Product' END,
          c_mktsegment, 'meta' FROM customer""",
    "csv_queries": "SELECT row_number() OVER (ORDER BY item_id) - 1 AS query_id, text AS query FROM benchmark",
    "csv_answers": f"""WITH {MARKED} SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS index, conv_id, turn,
        'say "' || reasoned || '",' || chr(10) || 'then' AS answer FROM marked""",
    "column_list": "SELECT o_orderkey, o_totalprice FROM orders",
    "parquet_sink": "SELECT doc_id, lang, n_chars FROM documents",
    "single_query_search": f"""WITH {CORPUS}, {LONGEST}, {index()}, {scores()}, {BM25_HITS} {ROUNDED} bm25""",
    "single_query_prompt": f"""WITH {CONTEXT.replace(QUERIES, LONGEST)}
        SELECT query_id, coalesce(context, '') AS context, {RAG_PROMPT} AS prompt
        FROM asked LEFT JOIN contexts USING (query_id)""",
}
