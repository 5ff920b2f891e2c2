"""SQL for the operators that SQL can express, for an independent engine."""

from __future__ import annotations

from matchlake.llm import quality

SPACE = r"[\x20\x09-\x0D]+"
WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '" + SPACE + r"'), lambda w: w <> '')"


def _quality() -> str:
    rules, (yes, no, good) = range(len(quality.RULES)), quality.START
    lo, hi = quality.LEAST, quality.MOST
    sums = ", ".join(f"(sum(CASE v{i} WHEN 1 THEN n * p ELSE 0 END) + 1) / (sum(n * p * abs(v{i})) + 2) AS r{i}, "
                     f"(sum(CASE v{i} WHEN -1 THEN n * (1 - p) ELSE 0 END) + 1) / (sum(n * (1 - p) * abs(v{i})) + 2) AS s{i}"
                     for i in rules)
    first = ", ".join([f"{good}::DOUBLE AS good"] + [f"{yes}::DOUBLE AS a{i}, {no}::DOUBLE AS b{i}" for i in rules])
    post = "1 / (1 + exp(-(ln(good / (1 - good))" + "".join(
        f" + CASE v{i} WHEN 1 THEN ln(a{i} / (1 - b{i})) WHEN -1 THEN ln((1 - a{i}) / b{i}) ELSE 0 END" for i in rules) + ")))"
    clip = lambda x: f"least(greatest({x}, {lo}), {hi})"
    new = ", ".join(f"{clip(f'r{i}')} AS a{i}, {clip(f's{i}')} AS b{i}" for i in rules)
    steps, last = [f"e0 AS (SELECT {first})"], "e0"
    for k in range(1, quality.ITERATIONS + 1):
        steps.append(f"e{k} AS MATERIALIZED (SELECT {clip('g')} AS good, {new} FROM (SELECT sum(n * p) / sum(n) AS g, "
                     f"{sums} FROM (SELECT pat.*, {post} AS p FROM pat, {last})))")
        last = f"e{k}"
    votes = ", ".join(f"{quality.vote(r)} AS v{i}" for i, r in enumerate(quality.RULES))
    vs = ", ".join(f"v{i}" for i in rules)
    failed = (f"(n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words)")
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
w AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
tri AS (SELECT r, i, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, word AS a FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
twin AS (SELECT r, i FROM tri WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twin) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
c AS MATERIALIZED (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
 length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
 length(regexp_replace(text, '[^0-9]+', '', 'g'))::BIGINT AS n_digits,
 length(regexp_replace(text, '[^A-Z]+', '', 'g'))::BIGINT AS n_capitals,
 length(regexp_replace(text, '[^!|]+', '', 'g'))::BIGINT AS n_marks,
 length(regexp_replace(text, '{quality.ORDINARY.replace("'", "''")}', '', 'g'))::BIGINT AS n_odd,
 len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
 FROM d JOIN lines USING (r) LEFT JOIN rep USING (r)),
v AS MATERIALIZED (SELECT *, {votes} FROM c),
pat AS MATERIALIZED (SELECT {vs}, count(*) AS n FROM v GROUP BY ALL),
{", ".join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed,
 round({post}, 6) AS quality, NOT {failed} AND round({post}, 6) >= {quality.THRESHOLD} AS kept FROM v, {last}"""


MIXING = f"""WITH d AS MATERIALIZED (SELECT doc_id, source, len({WORDS}) AS size,
 md5('11:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
l AS (SELECT *, source_size * 3.0::DOUBLE AS lim, source_size * 3.0::DOUBLE / weight AS ratio FROM w),
h AS (SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(lim) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
 / sum(weight) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM l),
t AS (SELECT *, CASE WHEN ratio < share THEN lim ELSE weight * (SELECT first(share ORDER BY ratio, source) FROM h WHERE ratio >= share) END AS target FROM h),
b AS (SELECT *, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.*, b.source_size, b.target, b.epochs, round(b.target)::BIGINT - b.epochs * b.source_size AS rest,
 coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
 FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM p"""


TOP_K = """WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
 FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""

HARD_NEGATIVES = """WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL
 AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT q.vec_id AS anchor_id, c.vec_id AS vec_id, q.label = c.label AS same, list_inner_product(q.v, c.v)::BIGINT AS score
 FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
 QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
 vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""

ORACLE = {"op1_quality_rules": _quality(), "op5_source_mixing": MIXING, "op10_exact_topk": TOP_K, "op11_hard_negatives": HARD_NEGATIVES}
