"""DuckDB counterparts of the operators that SQL can express."""

from __future__ import annotations

from sensorloom.llm.quality_rules import STOP_WORDS

# Windows of 8 words are found by joining the word list with itself seven times shifted;
# the verdict repeats the production table of quality_rules.RULES.
QUALITY = """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce("text", '') AS t FROM documents
),
split AS (
    SELECT r, doc_id, t,
        list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
    FROM docs
),
windows AS (
    SELECT r, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s
    FROM (SELECT r, w, unnest(generate_series(1, len(w) - 7)) AS i FROM split WHERE len(w) >= 8)
),
twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n > 1
),
steps AS (
    SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS n FROM twice
),
repeats AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_repeat_words FROM steps GROUP BY r),
counted AS (
    SELECT doc_id, len(w) AS n_words,
        length(t) - length(regexp_replace(t, '[^\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
        length(t) - length(regexp_replace(t, '\\p{Lu}+', '', 'g')) AS n_capitals,
        length(t) - length(regexp_replace(t, '!+', '', 'g')) AS n_bangs,
        len(list_filter(w, lambda x: list_contains([STOP_LIST], x))) AS n_stop,
        len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM split LEFT JOIN repeats USING (r)
),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT base_failed AND n_words <= 1000000
        AND word_chars / n_words BETWEEN 2.0 AND 14.0
        AND n_symbols / word_chars <= 0.10
        AND n_stop / n_words >= 0.03
        AND n_capitals / word_chars <= 0.50
        AND n_dup_lines / n_lines <= 0.50
        AND n_bangs / n_words <= 0.30 AS kept
FROM judged
"""


NEGATIVES = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

# The checksum of a conversation's number is taken bit by bit, as there is no function for it.
# Turns are told apart by role and text themselves, prefixes by their lists of turns.
TRIE = """
WITH turns AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce("text", '') AS x
    FROM conversations WHERE conv_id IS NOT NULL
),
seqs AS (
    SELECT c, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || x)) AS s
    FROM turns GROUP BY c
),
sums AS (
    SELECT c, s, xor(list_reduce(list_concat([4294967295], flatten(list_transform(
        range(1, length(c::VARCHAR) + 1), lambda i: [ascii((c::VARCHAR)[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
    ))), lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h
    FROM seqs
),
rebuilt AS (
    SELECT a.c, list_concat(coalesce(list_slice(b.s, 1, h), []), list_slice(a.s, h + 1, len(a.s))) AS s
    FROM sums a LEFT JOIN seqs b ON b.c = a.c - a.c % 20
),
prefixes AS (
    SELECT c, d, list_slice(s, 1, d) AS p, len(s) = d AS ended
    FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)
),
nodes AS (
    SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, string_agg(c, ',' ORDER BY c) FILTER (ended) AS ends,
        CASE WHEN d = 0 THEN 0 ELSE len(list_filter(
            string_split_regex(p[d].x, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) END AS words
    FROM prefixes GROUP BY d, p
),
numbered AS (SELECT *, row_number() OVER () AS k FROM nodes),
kids AS (
    SELECT a.k, count(b.k) AS n_children, any_value(up.conv_id) AS parent_conv_id
    FROM numbered a LEFT JOIN numbered b ON b.d = a.d + 1 AND list_slice(b.p, 1, b.d - 1) = a.p
    LEFT JOIN numbered up ON up.d = a.d - 1 AND up.p = list_slice(a.p, 1, a.d - 1)
    GROUP BY a.k
),
below AS (
    SELECT d, p, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM (
        SELECT unnest(range(0, d + 1)) AS d, list_slice(p, 1, unnest(range(0, d + 1))) AS p,
            CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * words AS saved
        FROM numbered JOIN kids USING (k)
    ) GROUP BY d, p
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM numbered JOIN kids USING (k) JOIN below USING (d, p)
"""


def oracle_sql() -> dict[str, str]:
    forms = dict.fromkeys(form for w in STOP_WORDS for form in (w, w.capitalize()))
    return {
        "op10_quality_rules": QUALITY.replace("STOP_LIST", ", ".join(f"'{w}'" for w in forms)),
        "op12_hard_negatives": NEGATIVES,
        "op13_prefix_trie": TRIE,
    }
