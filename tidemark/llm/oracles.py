"""The same results in DuckDB's SQL, for the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import fill_in_middle as fim
from tidemark.llm import quality_rules as rules

TOPK = r"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.r <> c.r
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

MIXING = r"""
WITH d AS (
    SELECT CAST(doc_id AS BIGINT) AS doc_id, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
        source_size * 2 AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total
    FROM s
), f AS (
    SELECT *,
        (total - CAST(sum(cap) OVER o - cap AS DOUBLE)) / CAST(sum(weight) OVER () - sum(weight) OVER o + weight AS DOUBLE) AS level
    FROM w
    WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE), source NULLS LAST)
), g AS (
    SELECT source, source_size,
        CASE WHEN cap <= weight * level THEN CAST(cap AS DOUBLE)
            ELSE weight * first_value(level) OVER (ORDER BY cap <= weight * level, CAST(cap AS DOUBLE) / weight, source NULLS LAST)
        END AS target
    FROM f
), p AS (
    SELECT d.doc_id, d.size, g.source_size, g.target,
        CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS whole,
        CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id NULLS FIRST, d.size
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ends
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
    whole * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - whole * source_size - (ends - size))) AS taken
FROM p
"""

_STATISTICS = r"""
WITH d AS (
    SELECT row_number() OVER () AS id, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), windows AS (
    SELECT id, i, array_to_string(w[i : i + 7], ' ') AS words
    FROM (SELECT id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), repeated AS (
    SELECT id, unnest(range(i, i + 8)) AS place
    FROM (SELECT id, i, count(*) OVER (PARTITION BY id, words) AS n FROM windows)
    WHERE n > 1
), covered AS (
    SELECT id, count(DISTINCT place) AS n FROM repeated GROUP BY id
), lines AS (
    SELECT id, count(*) AS n, count(DISTINCT line) AS distinct_lines
    FROM (SELECT id, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY id
), s AS MATERIALIZED (
    SELECT id, doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(l.n - l.distinct_lines, 0) AS BIGINT) AS n_dup_lines, coalesce(l.n, 0) AS n_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
        length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_capitals,
        length(t) - length(replace(t, '!', '')) AS n_shouts
    FROM d LEFT JOIN covered c USING (id) LEFT JOIN lines l USING (id)
), j AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s
)"""


def _rules() -> str:
    """Expectation-maximisation over the documents' votes, one step of the model after the other."""
    votes = " UNION ALL ".join(
        f"SELECT id, base_failed, '{name}' AS rule, CASE WHEN {value} <= {keep} THEN 1 WHEN {value} > {reject} "
        "THEN -1 ELSE 0 END AS vote FROM j"
        for name, (value, keep, reject) in rules.RULES.items()
    )
    model = ", ".join(
        f"('{name}', {vote}, {rules.GOOD[vote]}::DOUBLE, {rules.BAD[vote]}::DOUBLE, {rules.PRIOR}::DOUBLE)"
        for name in rules.RULES for vote in (1, -1, 0)
    )
    first = "start(rule, vote, good, bad, prior)"
    parts = [
        _STATISTICS, f"v AS MATERIALIZED ({votes})", f"{first} AS MATERIALIZED (VALUES {model})",
        "m0 AS MATERIALIZED (SELECT * FROM start)",
        # documents that vote alike are one pattern
        "p AS MATERIALIZED (SELECT id, base_failed, string_agg(vote, ',' ORDER BY rule) AS pattern FROM v GROUP BY ALL)",
        "c AS MATERIALIZED (SELECT pattern, count(*) AS n FROM p WHERE NOT base_failed GROUP BY ALL)",
        "u AS MATERIALIZED (SELECT DISTINCT pattern, rule, vote FROM v JOIN p USING (id))",
    ]
    odds = "ln(any_value(m.prior) / (1 - any_value(m.prior))) + sum(ln(m.good / m.bad))"
    for k in range(1, rules.ROUNDS + 1):
        parts.append(
            f"e{k} AS MATERIALIZED (SELECT pattern, any_value(n) AS n, any_value(n) / (1 + exp(-({odds}))) AS good "
            f"FROM c JOIN u USING (pattern) JOIN m{k - 1} m USING (rule, vote) GROUP BY pattern)"
        )
        s = rules.SMOOTH
        parts.append(
            f"m{k} AS MATERIALIZED (SELECT b.rule, b.vote, (coalesce(x.good, 0) + {s} * b.good) / (t.good + {s}) AS good, "
            f"(coalesce(x.n - x.good, 0) + {s} * b.bad) / (t.n - t.good + {s}) AS bad, "
            f"(t.good + {s} * b.prior) / (t.n + {s}) AS prior FROM start b "
            f"LEFT JOIN (SELECT rule, vote, sum(n) AS n, sum(e.good) AS good FROM e{k} e JOIN u USING (pattern) GROUP BY ALL) x "
            f"USING (rule, vote) CROSS JOIN (SELECT coalesce(sum(n), 0) AS n, coalesce(sum(good), 0) AS good FROM e{k}) t)"
        )
    return ",\n".join(parts) + f"""
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, j.base_failed,
        NOT j.base_failed AND q.posterior >= {rules.KEEP} AS kept
    FROM j JOIN p USING (id) JOIN (
        SELECT pattern, 1 / (1 + exp(-({odds}))) AS posterior FROM u JOIN m{rules.ROUNDS} m USING (rule, vote) GROUP BY pattern
    ) q USING (pattern)"""


FILL_IN_MIDDLE = f"""
WITH d AS (
    SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s
    FROM documents
), h AS (
    SELECT doc_id, t, n,
        CAST(CAST('0x' || s[1:8] AS UINTEGER) AS BIGINT) % (n + 1) AS x, CAST(CAST('0x' || s[9:16] AS UINTEGER) AS BIGINT) % (n + 1) AS y,
        CASE WHEN t = '' OR contains(t, '{fim.PREFIX}') OR contains(t, '{fim.SUFFIX}') OR contains(t, '{fim.MIDDLE}')
                OR CAST('0x' || s[17:24] AS UINTEGER) % 100 >= {fim.RATE} THEN 'plain'
            WHEN CAST('0x' || s[25:32] AS UINTEGER) % 100 < {fim.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
    FROM d
), c AS (SELECT *, least(x, y) AS a, greatest(x, y) AS b FROM h),
p AS (
    SELECT *, '{fim.PREFIX}' || substring(t, 1, a) AS prefix, '{fim.SUFFIX}' || substring(t, b + 1) AS suffix,
        '{fim.MIDDLE}' || substring(t, a + 1, b - a) AS middle
    FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN prefix || suffix || middle WHEN 'spm' THEN suffix || prefix || middle ELSE t END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""

ORACLES = {
    "op5_quality_rules": _rules(), "op6_exact_topk": TOPK, "op9_mixing": MIXING, "op12_fill_in_middle": FILL_IN_MIDDLE,
}
