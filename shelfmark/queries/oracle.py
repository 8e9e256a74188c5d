"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from shelfmark.functions.labels import CATEGORIES
from shelfmark.queries.views import MERGES

PRODUCTS = """
raw_lines AS (SELECT *, string_split(text, chr(10)) AS l FROM documents),
products AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS asin, l[1] AS title,
    CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN CAST([] AS VARCHAR[]) ELSE l END AS description,
    CASE WHEN doc_id % 3 = 0 THEN NULL ELSE l[2:3] END AS feature,
    CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN '' ELSE source END AS brand,
    lang AS main_cat, l[1:1] AS image,
    CASE WHEN doc_id % 17 = 0 THEN NULL ELSE '$' || CAST(n_chars AS VARCHAR) END AS price
  FROM raw_lines)
"""


def _list_repr(column: str) -> str:
    body = "replace(replace(replace(replace(e, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    element = (
        f"CASE WHEN e IS NULL THEN 'None' "
        f"WHEN contains(e, '''') AND NOT contains(e, '\"') THEN '\"' || {body} || '\"' "
        f"ELSE '''' || replace({body}, '''', '\\''') || '''' END"
    )
    return (
        f"CASE WHEN {column} IS NULL THEN NULL ELSE '[' || "
        f"array_to_string(list_transform({column}, lambda e: {element}), ', ') || ']' END"
    )


COMBINED = f"""
{PRODUCTS},
combined AS (
  SELECT doc_id, asin, main_cat, concat_ws(' | ', asin, title, {_list_repr('description')}, {_list_repr('feature')}, brand) AS combined_text
  FROM products)
"""


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '\\s+'), lambda w: w <> '')"


def _num_words(column: str) -> str:
    count = "len(list_filter(string_split_regex(e, '\\s+'), lambda w: w <> ''))"
    counts = f"list_sum(list_transform({column}, lambda e: {count}))"
    return f"CAST(coalesce({counts}, 0) AS INTEGER)"


COUNTED = f"{PRODUCTS}, counted AS (SELECT *, {_num_words('description')} AS num_words FROM products)"


def _vocab(words: str, size: int) -> str:
    """CTEs from a relation ``words(token, n)`` to ``vocab(token, id, n)``."""
    return f"""
best AS (SELECT token, n FROM {words} WHERE token NOT IN ('[PAD]', '[UNK]', '[CLS]', '[SEP]') ORDER BY n DESC, token LIMIT {size - 4}),
vocab AS (
  SELECT token, CAST(3 + row_number() OVER (ORDER BY n DESC, token) AS INTEGER) AS id, n FROM best
  UNION ALL SELECT * FROM (VALUES ('[PAD]', 0, 0), ('[UNK]', 1, 0), ('[CLS]', 2, 0), ('[SEP]', 3, 0)))
"""


CORPUS_VOCAB = f"""
{COMBINED},
occurrences AS (SELECT asin, unnest(ws) AS token, generate_subscripts(ws, 1) AS ord FROM (SELECT asin, {_words('combined_text')} AS ws FROM combined)),
word_counts AS (SELECT token, count(*) AS n FROM occurrences GROUP BY token),
{_vocab('word_counts', 30000)}
"""


def _encoded(key: str, ids: str, rows: str) -> str:
    """Framed and padded arrays as text, from ``ids(key, ord, id)``, ord from 1."""
    return f"""
kept AS (SELECT {key}, ord, id FROM {ids} WHERE ord <= 510),
sizes AS (SELECT r.{key}, count(k.ord) AS n FROM {rows} r LEFT JOIN kept k ON r.{key} = k.{key} GROUP BY r.{key}),
grid AS (SELECT {key}, n, unnest(range(512)) AS p FROM sizes)
SELECT g.{key},
  string_agg(CAST(CASE WHEN g.p = 0 THEN 2 WHEN g.p <= g.n THEN k.id WHEN g.p = g.n + 1 THEN 3 ELSE 0 END AS VARCHAR), ' ' ORDER BY g.p) AS input_ids,
  string_agg(CASE WHEN g.p <= g.n + 1 THEN '1' ELSE '0' END, ' ' ORDER BY g.p) AS attention_mask
FROM grid g LEFT JOIN kept k ON g.{key} = k.{key} AND g.p = k.ord GROUP BY g.{key}
"""


ENCODE = f"""WITH {CORPUS_VOCAB},
word_ids AS (SELECT o.asin, o.ord, coalesce(v.id, 1) AS id FROM occurrences o LEFT JOIN vocab v USING (token)),
{_encoded('asin', 'word_ids', 'combined')}"""

PIECE_VOCAB = f"""
doc_words AS (SELECT doc_id, unnest(ws) AS token, generate_subscripts(ws, 1) AS ord FROM (SELECT doc_id, {_words('text')} AS ws FROM documents)),
word_counts AS (SELECT token, count(*) AS n FROM doc_words GROUP BY token),
piece_lists AS (
  SELECT n, list_distinct(list_concat(
    list_transform(range(1, length(token) + 1), lambda i: substr(token, 1, i)),
    list_concat(
      list_transform(range(2, length(token) + 1), lambda i: '##' || substr(token, i)),
      list_transform(range(2, length(token) + 1), lambda i: '##' || substr(token, i, 1))))) AS pieces
  FROM word_counts WHERE length(token) <= 100),
piece_counts AS (SELECT token, CAST(sum(n) AS BIGINT) AS n FROM (SELECT unnest(pieces) AS token, n FROM piece_lists) GROUP BY token),
{_vocab('piece_counts', 30000)}
"""

# Greedy longest match: the longest known piece at each start, followed from the first one.
PIECES = f"""
{PIECE_VOCAB},
starts AS (SELECT token, unnest(range(1, length(token) + 1)) AS s FROM word_counts WHERE length(token) <= 100),
cuts AS (SELECT token, s, unnest(range(1, length(token) - s + 2)) AS len FROM starts),
steps AS (
  SELECT c.token, c.s, max(c.len) AS len
  FROM cuts c JOIN vocab v ON v.token = CASE WHEN c.s > 1 THEN '##' ELSE '' END || substr(c.token, c.s, c.len)
  GROUP BY c.token, c.s),
walk AS (
  SELECT token, s, len, 1 AS pos FROM steps WHERE s = 1
  UNION ALL
  SELECT n.token, n.s, n.len, w.pos + 1 FROM walk w JOIN steps n ON n.token = w.token AND n.s = w.s + w.len),
covered AS (SELECT token FROM walk GROUP BY token HAVING sum(len) = length(token)),
pieces AS (
  SELECT w.token, w.pos, CASE WHEN w.s > 1 THEN '##' ELSE '' END || substr(w.token, w.s, w.len) AS piece
  FROM walk w WHERE w.token IN (SELECT token FROM covered)
  UNION ALL
  SELECT token, 1, '[UNK]' FROM word_counts WHERE token NOT IN (SELECT token FROM covered))
"""

ENCODE_SUBWORDS = f"""WITH RECURSIVE {PIECES},
ordered AS (
  SELECT d.doc_id, row_number() OVER (PARTITION BY d.doc_id ORDER BY d.ord, p.pos) AS ord, v.id
  FROM doc_words d JOIN pieces p USING (token) JOIN vocab v ON v.token = p.piece),
{_encoded('doc_id', 'ordered', 'documents')}"""


def _draw(salt: str, key: str = "doc_id") -> str:
    digest = f"md5('{salt}:' || CAST({key} AS VARCHAR))"
    return f"(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) / 4294967296.0)"


SPLIT = f"CASE WHEN {_draw('42:1')} >= 0.8 THEN 'test' WHEN {_draw('42:2')} >= 0.8 THEN 'val' ELSE 'train' END"

CLASS_LIST = "[" + ", ".join("'" + c + "'" for c in CATEGORIES) + "]"
CLASSES = f"categories AS (SELECT doc_id, {CLASS_LIST}[CAST(doc_id % 22 AS INTEGER) + 1] AS category FROM documents)"

_WEIGHTS = [f"((doc_id * {3 + 2 * i} + {7 * i}) % 11 + 1)" for i in range(4)]
_SCORES = "[" + ", ".join(f"{w} / CAST({' + '.join(_WEIGHTS)} AS DOUBLE)" for w in _WEIGHTS) + "]"
PREDICTIONS = f"""
scored AS (
  SELECT doc_id, list_position(['de', 'en', 'es', 'fr'], lang) - 1 AS label, {_SCORES} AS scores, {SPLIT} AS split
  FROM documents),
predictions AS (
  SELECT *, CASE WHEN doc_id % 3 = 0 THEN label ELSE list_position(scores, list_max(scores)) - 1 END AS prediction
  FROM scored)
"""


def _metrics(by: str = "") -> str:
    """CTE ``weighted`` with accuracy and weighted precision, recall and F1."""
    sep = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    same = f"c.{by} = a.{by} AND " if by else ""
    return f"""
classes AS (SELECT {sep}label AS class FROM predictions UNION SELECT {sep}prediction FROM predictions),
per_class AS (
  SELECT {('c.' + by + ', ') if by else ''}c.class,
    count(*) FILTER (WHERE a.label = c.class) AS support,
    count(*) FILTER (WHERE a.prediction = c.class) AS predicted,
    count(*) FILTER (WHERE a.label = c.class AND a.prediction = c.class) AS hits
  FROM classes c JOIN predictions a ON {same}(a.label = c.class OR a.prediction = c.class)
  GROUP BY ALL),
ratios AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE hits / CAST(predicted AS DOUBLE) END AS p,
    CASE WHEN support = 0 THEN 0.0 ELSE hits / CAST(support AS DOUBLE) END AS r,
    2.0 * hits / CAST(support + predicted AS DOUBLE) AS f
  FROM per_class),
weighted AS (
  SELECT {sep}CAST(sum(support) AS BIGINT) AS n_rows, round(sum(hits) / CAST(sum(support) AS DOUBLE), 6) AS accuracy,
    round(sum(CAST(f AS DOUBLE) * support) / sum(support), 6) AS f1_score,
    round(sum(CAST(p AS DOUBLE) * support) / sum(support), 6) AS "precision",
    round(sum(CAST(r AS DOUBLE) * support) / sum(support), 6) AS recall
  FROM ratios {group})
"""


LOSS = "round(avg(-ln(greatest(scores[label + 1], 1e-15))), 6) AS avg_loss"


def _box(by: str) -> str:
    same = f"c.{by} IS NOT DISTINCT FROM q.{by}"
    return f"""WITH {COUNTED},
quartiles AS (
  SELECT {by}, quantile_cont(num_words, 0.25) AS q1, quantile_cont(num_words, 0.5) AS median, quantile_cont(num_words, 0.75) AS q3
  FROM counted GROUP BY {by}),
whiskers AS (
  SELECT q.{by}, q1, median, q3,
    least(min(num_words) FILTER (WHERE num_words BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), q1) AS whisker_low,
    greatest(max(num_words) FILTER (WHERE num_words BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), q3) AS whisker_high
  FROM counted c JOIN quartiles q ON {same} GROUP BY q.{by}, q1, median, q3)
SELECT q.{by}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(CAST(whisker_low AS DOUBLE), 6) AS whisker_low, round(CAST(whisker_high AS DOUBLE), 6) AS whisker_high,
  count(*) AS n_rows, count(*) FILTER (WHERE num_words < whisker_low OR num_words > whisker_high) AS n_outliers,
  min(num_words) AS min_words, max(num_words) AS max_words, round(avg(num_words), 6) AS mean_words
FROM counted c JOIN whiskers q ON {same} GROUP BY q.{by}, q1, median, q3, whisker_low, whisker_high"""


def _reason(field: str) -> str:
    return f"CASE WHEN {field} IS NULL THEN '{field}: null' END"


REASON = "concat_ws('; ', " + ", ".join(
    _reason(f) for f in ("asin", "brand", "description", "feature", "image", "price", "title")
) + ")"


def _falsy(column: str, rendered: str | None = None) -> str:
    test = f"len({column}) > 0" if rendered else f"{column} <> ''"
    return f"CASE WHEN {test} THEN {rendered or column} END"


CONFUSION = "SELECT label, prediction, count(*) AS n FROM predictions GROUP BY label, prediction"
CELLS = [f"CAST(count(*) FILTER (WHERE a.prediction = {i}) AS BIGINT)" for i in range(5)]
BOOL_TEXT = "CASE WHEN l_quantity > 25 THEN 'True' ELSE 'False' END"

def _encoded_bytes(source: str, key: str, text: str) -> str:
    """Arrays by the merge list of the queries: bytes in hexadecimal digits, merge after merge."""
    symbols = "regexp_replace(hex(encode(p)), '(..)', '|\\1|', 'g')"
    for left, right in MERGES:
        l, r = left.hex().upper(), right.hex().upper()
        symbols = f"replace({symbols}, '|{l}||{r}|', '|{l}{r}|')"
    merged = ", ".join(f"'{(l + r).hex().upper()}'" for l, r in MERGES)
    pattern = "''(?:s|t|re|ve|m|ll|d)| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+"
    # The last of several blanks before a word belongs to the word.
    marked = f"regexp_replace({text}, '(\\s)(\\s\\S)', '\\1' || chr(57344) || '\\2', 'g')"
    return f"""
pieces AS (SELECT {key}, flatten(list_transform(string_split({marked}, chr(57344)),
    lambda s: regexp_extract_all(s, '{pattern}'))) AS pieces FROM {source}),
symbols AS (SELECT {key}, flatten(list_transform(pieces,
    lambda p: string_split(trim({symbols}, '|'), '||')))[1:510] AS symbols FROM pieces),
ids AS (SELECT {key}, list_concat(list_concat([2], list_transform(symbols, lambda s: CASE
    WHEN length(s) = 2 THEN 4 + ('0x' || s)::INTEGER ELSE 259 + list_position([{merged}], s) END)), [3]) AS ids
    FROM symbols)
SELECT {key}, array_to_string(list_resize(ids, 512, 0), ' ') AS input_ids,
    array_to_string(list_resize(list_transform(ids, lambda i: 1), 512, 0), ' ') AS attention_mask FROM ids"""


def _trained(n_merges: int) -> str:
    """The merges of a training on the documents' words: symbols are numbers between bars."""
    return f"""
WITH RECURSIVE counts AS MATERIALIZED (
  SELECT token, count(*) AS n FROM (SELECT unnest({_words('text')}) AS token FROM documents) GROUP BY token),
letters AS (SELECT token, n, unnest(string_split(token, '')) AS c,
  generate_subscripts(string_split(token, ''), 1) AS place FROM counts),
symbols AS MATERIALIZED (SELECT c, row_number() OVER (ORDER BY c) AS i FROM (SELECT DISTINCT c FROM letters)),
size AS (SELECT count(*) AS k FROM symbols),
numbered AS MATERIALIZED (SELECT any_value(n) AS n, '|' || string_agg(i::VARCHAR, '||' ORDER BY place) || '|' AS w
  FROM letters JOIN symbols USING (c) GROUP BY token),
rounds AS (
  SELECT 0 AS step, w, n, NULL::BIGINT AS a, NULL::BIGINT AS b, NULL::BIGINT AS m FROM numbered
  UNION ALL
  SELECT step + 1, replace(w, '|' || best.a || '||' || best.b || '|', '|' || (k + step + 1) || '|'), n, best.a, best.b, best.m
  FROM rounds, size, (
    SELECT s[i]::BIGINT AS a, s[i + 1]::BIGINT AS b, sum(n)::BIGINT AS m
    FROM (SELECT s, n, unnest(range(1, len(s))) AS i FROM (SELECT string_split(trim(w, '|'), '||') AS s, n FROM rounds))
    GROUP BY a, b ORDER BY m DESC, greatest(a, b), a, b LIMIT 1) best
  WHERE step < {n_merges}),
picked AS MATERIALIZED (SELECT DISTINCT step, a, b, m FROM rounds WHERE step > 0),
texts AS (
  SELECT 0 AS step, list(c ORDER BY i) AS t FROM symbols
  UNION ALL SELECT picked.step, list_append(t, t[a] || t[b]) FROM texts JOIN picked ON picked.step = texts.step + 1)
SELECT CAST(p.step - 1 AS INTEGER) AS rank, t[a] AS "left", t[b] AS "right", m AS n
FROM picked p, (SELECT t FROM texts ORDER BY step DESC LIMIT 1)"""


EPOCHS = f"""
WITH RECURSIVE docs AS (SELECT doc_id, CAST(list_position(['de', 'en', 'es', 'fr'], lang) - 1 AS INTEGER) AS y,
    doc_id % 5 = 0 AS held_out, {_words('text')} AS words FROM documents WHERE lang IS NOT NULL),
terms AS (SELECT doc_id, f, 1 + ln(count(*)) AS v
    FROM (SELECT doc_id, length(t) % 8 AS f FROM (SELECT doc_id, unnest(words) AS t FROM docs)) GROUP BY doc_id, f),
x AS MATERIALIZED (
  SELECT doc_id, f, v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS v FROM terms
  UNION ALL SELECT doc_id, 8, 1.0::DOUBLE FROM docs),
size AS (SELECT count(*) AS k FROM docs WHERE NOT held_out),
weights AS (
  SELECT 0 AS step, f, c, 0.0::DOUBLE AS w FROM range(9) a(f), range(4) b(c)
  UNION ALL
  SELECT step + 1, f, c, w - 2.0::DOUBLE * CASE WHEN step = 0 THEN 0 ELSE (1 - step / 4.0::DOUBLE) / 0.9::DOUBLE END
    * coalesce(d, 0) / k
  FROM weights CROSS JOIN size LEFT JOIN (
    SELECT x.f, p.c, sum(x.v * (p.p - CASE WHEN y = p.c THEN 1 ELSE 0 END)) AS d
    FROM x JOIN docs USING (doc_id) JOIN (
      SELECT doc_id, c, exp(z) / sum(exp(z)) OVER (PARTITION BY doc_id) AS p
      FROM (SELECT doc_id, c, sum(v * w) AS z FROM x JOIN weights USING (f) GROUP BY doc_id, c)) p USING (doc_id)
    WHERE NOT held_out GROUP BY x.f, p.c) g USING (f, c)
  WHERE step < 4),
scores AS (SELECT step, doc_id, y, c, exp(z) / sum(exp(z)) OVER (PARTITION BY step, doc_id) AS p FROM (
  SELECT step, doc_id, y, c, sum(v * w) AS z FROM docs JOIN x USING (doc_id) JOIN weights USING (f)
  WHERE held_out GROUP BY step, doc_id, y, c)),
best AS (SELECT step, doc_id, y, max(p) FILTER (y = c) AS p,
  list(c ORDER BY p DESC, c)[1] AS prediction FROM scores GROUP BY step, doc_id, y)
SELECT step AS epoch, (SELECT k FROM size) AS train_rows, round(avg(-ln(p)), 6) AS val_loss,
  round(avg(CASE WHEN prediction = y THEN 1.0::DOUBLE ELSE 0 END), 6) AS val_accuracy
FROM best WHERE step > 0 GROUP BY step"""


ORACLE: dict[str, str] = {
    "scan_documents": "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'de'",
    "jsonl_read": f"WITH {PRODUCTS} SELECT asin, title, brand, price, main_cat, CAST(len(description) AS INTEGER) AS n_lines FROM products",
    "jsonl_sample": f"WITH {PRODUCTS} SELECT asin, main_cat FROM products WHERE {_draw('7', 'asin')} < 0.25",
    "parquet_roundtrip": f"WITH {COMBINED} SELECT combined_text, main_cat, asin FROM combined",
    "take_rows": f"WITH {PRODUCTS} SELECT asin, title, brand, price FROM products ORDER BY doc_id LIMIT 100",
    "validated_projection": f"WITH {PRODUCTS} SELECT asin, title, brand, main_cat FROM products",
    "combine_repr": f"WITH {COMBINED} SELECT combined_text, main_cat, asin FROM combined",
    "combine_join": f"WITH {PRODUCTS} SELECT concat_ws(' | ', asin, title, array_to_string(description, ' '), array_to_string(feature, ' '), brand) AS combined_text, main_cat, asin FROM products",
    "combine_flatten": f"""WITH {PRODUCTS} SELECT asin, array_to_string(list_filter(
        list_concat(list_concat(list_concat([asin, title], coalesce(description, [])), coalesce(feature, [])), [brand]),
        lambda e: e IS NOT NULL), ' | ') AS combined_text FROM products""",
    "combine_falsy": f"""WITH {PRODUCTS} SELECT asin, concat_ws(' | ', {_falsy('asin')}, {_falsy('brand')},
        {_falsy('description', _list_repr('description'))}, {_falsy('feature', _list_repr('feature'))},
        {_falsy('price')}, {_falsy('title')}) AS combined_text FROM products""",
    "render_scalars": f"""SELECT l_orderkey, l_linenumber, concat_ws(' | ', CAST(l_orderkey AS VARCHAR),
        CAST(l_extendedprice AS VARCHAR), CAST(l_extendedprice * 1000000.0::DOUBLE AS VARCHAR),
        CAST(l_extendedprice * 1152921504606846976.0::DOUBLE AS VARCHAR), CAST(l_discount / 512.0::DOUBLE AS VARCHAR),
        CAST(l_tax / -65536.0::DOUBLE AS VARCHAR), {BOOL_TEXT},
        '[' || l_orderkey || ', ' || l_linenumber || ', None]') AS rendered,
        '[' || l_orderkey || ', ' || l_linenumber || ', None]' AS keys_text FROM lineitem""",
    "conform_valid": f"""WITH {PRODUCTS} SELECT asin, brand, price, title, CAST(len(description) AS INTEGER) AS n_description,
        CAST(len(feature) AS INTEGER) AS n_feature, CAST(len(image) AS INTEGER) AS n_image
        FROM products WHERE {REASON} = ''""",
    "conform_lines": """WITH judged AS (SELECT *, CASE WHEN doc_id % 6 = 4 THEN 'malformed line' ELSE concat_ws('; ',
        CASE WHEN doc_id % 6 = 2 THEN 'id: not int' END,
        CASE WHEN doc_id % 6 = 1 THEN 'title: not str' WHEN text IS NULL THEN 'title: missing' END,
        CASE WHEN doc_id % 6 = 3 OR lang IS NULL THEN 'tags: not List[str]' END) END AS reject_reason FROM documents)
        SELECT doc_id AS id, CASE WHEN reject_reason = '' THEN md5(text) END AS title_md5,
        CASE WHEN reject_reason = '' THEN lang END AS tag, reject_reason FROM judged""",
    "conform_rejected": f"WITH {PRODUCTS} SELECT asin, main_cat, {REASON} AS reject_reason FROM products WHERE {REASON} <> ''",
    "label_encode": f"WITH {CLASSES} SELECT doc_id, CAST(list_position({CLASS_LIST}, category) - 1 AS INTEGER) AS label_id FROM categories",
    "label_encode_partial": f"""WITH {CLASSES}, shorter AS (SELECT [c FOR c, i IN {CLASS_LIST} IF i % 2 = 1] AS names)
        SELECT doc_id, CASE WHEN list_contains(names, category) THEN CAST(list_position(names, category) - 1 AS INTEGER) END AS label_id
        FROM categories, shorter""",
    "label_decode": f"WITH {PREDICTIONS} SELECT doc_id, CAST(prediction AS INTEGER) AS prediction, ['de', 'en', 'es', 'fr'][CAST(prediction AS INTEGER) + 1] AS predicted FROM predictions",
    "category_slug": f"WITH {CLASSES} SELECT category, replace(replace(replace(category, '&', 'and'), ', ', '_'), ' ', '_') AS slug, count(*) AS n_rows FROM categories GROUP BY category",
    "best_class": f"WITH {PREDICTIONS} SELECT doc_id, CAST(list_position(scores, list_max(scores)) - 1 AS INTEGER) AS best FROM predictions",
    "summary": f"WITH {PRODUCTS} SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT main_cat FROM products)) AS distinct_categories FROM products",
    "brand_summary": f"WITH {PRODUCTS} SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT brand FROM products)) AS distinct_categories FROM products",
    "category_counts": f"WITH {PRODUCTS} SELECT main_cat, count(*) AS count FROM products GROUP BY main_cat ORDER BY main_cat",
    "word_counts": f"WITH {COUNTED} SELECT asin, num_words FROM counted",
    "words_per_category": f"WITH {COUNTED} SELECT main_cat, num_words, count(*) AS n_rows FROM counted GROUP BY ALL",
    "avg_words": f"WITH {COUNTED} SELECT main_cat, round(avg(num_words), 6) AS average_num_words FROM counted GROUP BY main_cat",
    "box_stats": _box("main_cat"),
    "box_stats_by_brand": _box("brand"),
    "hash_sample": f"SELECT doc_id, lang FROM documents WHERE {_draw('42')} < 0.3",
    "hash_split": f"SELECT doc_id, {SPLIT} AS split FROM documents",
    "hash_three_way": f"SELECT split, lang, count(*) AS n_rows FROM (SELECT lang, {SPLIT} AS split FROM documents) GROUP BY ALL",
    "plan_steps": f"""WITH counts AS (SELECT {SPLIT} AS split, count(*) AS n_rows FROM documents GROUP BY 1),
        batches AS (SELECT *, CAST(ceil(n_rows / CASE WHEN split = 'test' THEN 64.0::DOUBLE ELSE 16.0::DOUBLE END) AS BIGINT) AS n_batches FROM counts)
        SELECT split, n_rows, n_batches, n_batches * 3 AS total_steps, CAST(floor(n_batches * 3 * 0.1::DOUBLE) AS BIGINT) AS warmup_steps FROM batches""",
    "shuffle_rows": "SELECT doc_id, lang FROM documents",
    "reshuffle_rows": "SELECT doc_id, lang FROM documents",
    "scatter_rows": "SELECT doc_id, lang FROM documents",
    "export_shards": f"SELECT doc_id, lang, {SPLIT} AS split FROM documents",
    "vocab": f"WITH {CORPUS_VOCAB} SELECT token, id, n FROM vocab",
    "encode": ENCODE,
    "encode_joined": ENCODE,
    "trained_merges": _trained(24),
    "encode_byte_level": f"WITH {_encoded_bytes('documents', 'doc_id', 'text')}",
    "etl_byte_level": f"WITH {COMBINED}, {_encoded_bytes('combined', 'asin', 'combined_text')}",
    "reuse_encoded": ENCODE,
    "encode_lengths": f"WITH {COMBINED} SELECT asin, CAST(least(len({_words('combined_text')}), 510) + 2 AS INTEGER) AS n_tokens, 512 AS length FROM combined",
    "piece_vocab": f"WITH {PIECE_VOCAB} SELECT token, id, n FROM vocab",
    "subword_table": f"""WITH RECURSIVE {PIECES}
        SELECT p.token, string_agg(p.piece, ' ' ORDER BY p.pos) AS pieces, CAST(count(*) AS INTEGER) AS n_pieces FROM pieces p GROUP BY p.token""",
    "encode_subwords": ENCODE_SUBWORDS,
    "metrics": f"WITH {PREDICTIONS}, {_metrics()} SELECT * FROM weighted",
    "metrics_by_split": f"WITH {PREDICTIONS}, {_metrics('split')} SELECT w.*, l.avg_loss FROM weighted w JOIN (SELECT split, {LOSS} FROM predictions GROUP BY split) l USING (split)",
    "confusion_long": f"""WITH {PREDICTIONS}, counts AS ({CONFUSION})
        SELECT CAST(label AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction, n,
        round(n / CAST(sum(n) OVER (PARTITION BY label) AS DOUBLE), 6) AS share FROM counts""",
    "confusion_wide": f"""WITH {PREDICTIONS} SELECT CAST(c.class AS INTEGER) AS label, {', '.join(f'{cell} AS p{i}' for i, cell in enumerate(CELLS[:4]))}
        FROM range(4) AS c(class) LEFT JOIN predictions a ON a.label = c.class GROUP BY c.class""",
    "confusion_percent": f"""WITH {PREDICTIONS} SELECT CAST(c.class AS INTEGER) AS label,
        {', '.join(f'coalesce(round({cell} * 100.0::DOUBLE / nullif(count(a.prediction), 0), 6), 0.0::DOUBLE) AS p{i}' for i, cell in enumerate(CELLS))}
        FROM range(5) AS c(class) LEFT JOIN predictions a ON a.label = c.class GROUP BY c.class""",
    "log_loss": f"WITH {PREDICTIONS} SELECT split, {LOSS} FROM predictions GROUP BY split",
    "etl_text": f"WITH {COMBINED} SELECT combined_text, main_cat, asin FROM combined",
    "etl_encoded": ENCODE,
    "profile_job": f"""WITH box AS ({_box('main_cat')}), {COUNTED},
        means AS (SELECT main_cat, count(*) AS count, round(avg(num_words), 6) AS average_num_words FROM counted GROUP BY main_cat),
        words AS (SELECT main_cat, num_words, count(*) AS n_rows FROM counted GROUP BY ALL)
        SELECT w.*, b.* EXCLUDE (main_cat, n_rows), m.count, m.average_num_words,
        (SELECT count(*) FROM products) AS total_rows, (SELECT count(*) FROM means) AS distinct_categories
        FROM words w JOIN box b USING (main_cat) JOIN means m USING (main_cat)""",
    "encode_subwords_joined": ENCODE_SUBWORDS,
    "take_any_rows": "SELECT least(count(*), 100) AS n_rows, least(count(*), 100) AS n_known, least(count(*), 100) AS n_keys FROM documents",
    "bernoulli_sample": "SELECT lang, count(*) AS n_documents, count(*) AS n_joined, true AS is_part, true AS size_is_near FROM documents GROUP BY lang",
    "random_three_way": "SELECT lang, count(*) AS n_rows, count(*) AS n_documents, true AS shares_are_near FROM documents GROUP BY lang",
    "train_text": f"SELECT {SPLIT} AS split, count(*) AS n_rows, true AS loss_is_the_lowest, true AS beats_guessing, true AS mostly_right FROM documents GROUP BY 1",
    "train_epochs": EPOCHS,
    "train_encoded": f"""SELECT CAST(list_position(['de', 'en', 'es', 'fr'], lang) - 1 AS INTEGER) AS label, count(*) AS n_rows,
        1.0::DOUBLE AS share, true AS mostly_right FROM documents WHERE {SPLIT} = 'test' GROUP BY 1""",
    "predict_records": f"WITH {PRODUCTS} SELECT asin, main_cat, true AS is_best, true AS is_named, true AS sums_to_one FROM products",
    "predict_stream": f"WITH {PRODUCTS} SELECT asin, main_cat, true AS same FROM products",
    "predict_joined": f"WITH {PRODUCTS} SELECT asin, main_cat, true AS same FROM products",
    "predict_rejected": f"WITH {PRODUCTS} SELECT asin, main_cat, {REASON} AS reject_reason FROM products",
    "encoding_contract": f"WITH {PRODUCTS} SELECT asin, main_cat, true AS same FROM products",
}
