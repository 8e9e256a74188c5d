"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

from shelfmark.llm import license_scan

_MEASURES = r"""
docs AS (
    SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS text FROM documents
),
split AS (
    SELECT doc_id, k, text,
        regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM docs
),
windows AS (
    SELECT k, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
    FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM split)
),
repeated AS (
    SELECT k, i FROM windows QUALIFY count(*) OVER (PARTITION BY k, a, b, c) > 1
),
covered AS (
    SELECT k, count(DISTINCT i + j) AS n
    FROM repeated, (SELECT unnest([0, 1, 2]) AS j) GROUP BY k
),
measures AS (
    SELECT s.doc_id, len(words) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(c.n, 0) AS n_repeat_words
    FROM split s LEFT JOIN covered c USING (k)
),
ledger AS (
    SELECT *,
        (n_words < 50)::BIGINT
        | ((100 * n_repeat_words > 50 * n_words)::BIGINT << 1)
        | ((10 * n_symbols > 3 * n_words)::BIGINT << 2)
        | ((2 * n_dup_lines > n_lines)::BIGINT << 3)
        | ((word_chars < 2 * n_words)::BIGINT << 4)
        | ((word_chars > 15 * n_words)::BIGINT << 5) AS failures
    FROM measures
)"""

_RULES = """(VALUES
    ('base-1', 'few_words', 3, 1), ('base-1', 'repeated_words', 3, 2),
    ('full-1', 'few_words', 63, 1), ('full-1', 'repeated_words', 63, 2),
    ('full-1', 'many_symbols', 63, 4), ('full-1', 'repeated_lines', 63, 8),
    ('full-1', 'short_words', 63, 16), ('full-1', 'long_words', 63, 32)
) r(policy, rule, mask, bit)"""


def _templates() -> tuple[str, str]:
    """Rows ``(template, at, gram)`` and ``(template, label, length, phrase, base)``."""
    grams, facts = [], []
    for number, t in enumerate([*license_scan.PHRASES, *license_scan.NOTICES]):
        words = t.words
        base = number < len(license_scan.PHRASES)
        facts.append(f"({number}, '{t.label}', {len(words)}, {t.phrase}, {base})")
        for at in range(len(words) - 2):
            grams.append(f"({number}, {at}, '{' '.join(words[at : at + 3])}')")
    return ", ".join(grams), ", ".join(facts)


_GRAMS, _FACTS = _templates()

_LICENCES = rf"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS k,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
),
grams AS (
    SELECT k, i - 1 AS position, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
    FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM docs)
),
facts AS (SELECT * FROM (VALUES {_FACTS}) t(template, label, length, phrase, base)),
hits AS (
    SELECT k, t.template, t.place, position, position - t.place AS diagonal
    FROM grams JOIN (SELECT * FROM (VALUES {_GRAMS}) v(template, place, gram)) t USING (gram)
),
diagonals AS (
    SELECT k, template, diagonal, phrase,
        sum(CASE WHEN phrase OR before IS NULL OR diagonal - before > 4 THEN 1 ELSE 0 END)
            OVER (PARTITION BY k, template ORDER BY diagonal) AS cluster
    FROM (
        SELECT k, template, diagonal, phrase,
            lag(diagonal) OVER (PARTITION BY k, template ORDER BY diagonal) AS before
        FROM (SELECT DISTINCT k, template, diagonal FROM hits) JOIN facts USING (template)
    )
),
spans AS (
    SELECT k, template, label, f.phrase, base, length,
        count(DISTINCT h.place + j) / length::DOUBLE AS coverage,
        min(h.position) AS first_word, max(h.position) + 2 AS last_word
    FROM hits h JOIN diagonals d USING (k, template, diagonal) JOIN facts f USING (template),
        (SELECT unnest([0, 1, 2]) AS j)
    GROUP BY k, template, label, f.phrase, base, length, cluster
),
verified AS (
    SELECT * FROM spans WHERE CASE WHEN phrase THEN coverage >= 1
        ELSE coverage >= 0.8 AND last_word - first_word + 1 <= 2 * length END
),
found AS (
    SELECT k, count(*) FILTER (base) AS n_base, min(first_word) FILTER (base) AS first_word,
        max(first_word) FILTER (base) AS last_word,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
        count(*) AS n_spans, max(coverage) AS score
    FROM verified GROUP BY k
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, f.first_word, f.last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(n_spans, 0) AS n_spans, coalesce(score, 0.0::DOUBLE) AS score
FROM docs LEFT JOIN found f USING (k)"""

_REPEATS = """
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
windows AS (
    SELECT doc_id, p, array_slice(b, p + 1, p + 100) AS w
    FROM (SELECT doc_id, b, unnest(range(octet_length(b) - 99)) AS p FROM docs)
),
repeated AS (
    SELECT doc_id, p FROM windows
    QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, p) > 1
),
runs AS (
    SELECT doc_id, min(p) AS a, max(p) + 100 AS z
    FROM (
        SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
        FROM (
            SELECT doc_id, p, CASE WHEN p <= before + 100 THEN 0 ELSE 1 END AS fresh
            FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM repeated)
        )
    )
    GROUP BY doc_id, run
),
removed AS (
    SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS last,
        string_agg(hex(array_slice(b, start + 1, a)), '' ORDER BY a) AS kept
    FROM (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS start FROM runs)
    JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
    coalesce(n_spans, 0) AS n_spans,
    sha256(CASE WHEN n_spans IS NULL THEN b
        ELSE unhex(kept || hex(array_slice(b, last + 1, octet_length(b)))) END) AS kept_sha256
FROM docs LEFT JOIN removed USING (doc_id)"""

_RANKED = r"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
),
held AS (SELECT doc_id, d, w, len(w)::HUGEINT AS n FROM docs WHERE len(w) > 0),
total AS (SELECT count(*)::HUGEINT AS docs, sum(n) AS terms FROM held),
postings AS (
    SELECT d, t, count(*)::HUGEINT AS tf FROM (SELECT d, unnest(w) AS t FROM held) GROUP BY d, t
),
items AS (
    SELECT item_id, i, unnest(list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t
    FROM (SELECT item_id, text, row_number() OVER () AS i FROM benchmark)
),
weights AS (
    SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::HUGEINT AS w
    FROM postings, total WHERE t IN (SELECT t FROM items) GROUP BY t, docs
),
scored AS (
    SELECT item_id, i, doc_id,
        sum(weights.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS score
    FROM items JOIN weights USING (t) JOIN postings USING (t) JOIN held USING (d), total
    GROUP BY item_id, i, doc_id, d
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score::BIGINT AS score FROM ranked WHERE rank <= 10"""

_NEGATIVES = """
WITH taken AS (
    SELECT vec_id, row_number() OVER () AS r,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id AS other, b.r AS b, a.label = b.label AS same,
        list_inner_product(a.v, b.v)::BIGINT AS score
    FROM taken a, taken b
    WHERE a.vec_id % 100 = 0 AND b.vec_id IS DISTINCT FROM a.vec_id
),
positives AS (
    SELECT a, anchor_id, other AS positive_id, score AS positive_score, place FROM (
        SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, other NULLS LAST) AS place
        FROM pairs WHERE same
    ) WHERE place <= 5
),
negatives AS (
    SELECT p.anchor_id, positive_id, positive_score, n.other AS negative_id, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.a, place ORDER BY n.score DESC, n.other NULLS LAST)::INT AS rank
    FROM positives p JOIN pairs n USING (a)
    WHERE NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 10"""

ORACLE = {
    "op1_quality_rules": f"""
WITH {_MEASURES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (failures & 3) <> 0 AS base_failed, (failures & 63) = 0 AS kept, failures, 'full-1' AS policy
FROM ledger""",
    "quality_ablations": f"""
WITH {_MEASURES}
SELECT policy, rule,
    count(*) FILTER ((failures & bit) <> 0) AS n_failing,
    count(*) FILTER ((failures & mask) = bit) AS n_only_this_rule,
    count(*) FILTER ((failures & mask) = 0) AS n_kept,
    count(*) FILTER ((failures & mask & ~bit) = 0) AS n_kept_without_it
FROM ledger, {_RULES} GROUP BY policy, rule""",
    "op3_license_scan": _LICENCES,
    "op6_suffix_dedup": _REPEATS,
    "op11_lexical_search": _RANKED,
    "op12_hard_negatives": _NEGATIVES,
}
