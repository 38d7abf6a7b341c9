"""DuckDB statements for the corpus queries that SQL can express."""

from __future__ import annotations

from martlet.llm.chat import CONTROLS, END, MESSAGE, START

SQL: dict[str, str] = {}

SQL["op6_fair_queue_mix"] = r"""
WITH d AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk
    FROM d GROUP BY source),
w AS (
    SELECT *, CAST([3, 1, 2][rnk % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap,
           1.5::DOUBLE * sum(source_size) OVER () AS budget
    FROM s),
lines AS (
    SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, rnk
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY cap / weight, rnk
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
    FROM w),
t AS (
    SELECT source, rnk, weight, source_size,
           least(cap, weight * (SELECT max(open) FROM lines)) AS target
    FROM lines),
queue AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.rnk, t.weight,
           sum(d.size) OVER (PARTITION BY t.rnk ORDER BY d.draw, d.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reach,
           row_number() OVER (ORDER BY t.rnk, d.draw, d.size) AS place
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
entries AS (
    SELECT place, size, sum(size) OVER (
               ORDER BY CAST(epoch * source_size + reach AS DOUBLE) / weight, rnk, epoch, place
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM queue, (SELECT unnest([0, 1]) AS epoch)),
took AS (
    SELECT place, CAST(sum(size) AS BIGINT) AS taken FROM entries
    WHERE upto <= (SELECT sum(target) FROM t) GROUP BY place)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(k.taken, 0) AS taken
FROM queue q LEFT JOIN took k USING (place)
"""


def _escaped(text: str) -> str:
    """``text`` with control strings broken by backslashes; see martlet.llm.chat."""
    out = f"replace({text}, '\\', '\\\\')"
    for control in CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


SQL["op11_event_sourced_chat"] = rf"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]'
    FROM range(2) AS t(i)),
e AS (
    SELECT *, {len(START + MESSAGE + END)} + length({_escaped("role")}) + length({_escaped("text")}) AS shown
    FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

SQL["op12_coordinate_pruned_negatives"] = r"""
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.row, b.vec_id AS id,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM v a JOIN v b ON a.row <> b.row AND len(a.v) = len(b.v)
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, row) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
 AND 80 * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.id, n.row)
QUALIFY row_number() OVER w <= 5
"""


def _rounds(k: int, rounds: int) -> str:
    """Centroids k0, k1, ... and assignments a0, a1, ... of every round."""
    apart = "list_sum(list_transform(list_zip(e.v, k.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    out = f"""
e AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
k0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM e
    QUALIFY c < {k})"""
    for r in range(rounds + 1):
        out += f""",
a{r} AS MATERIALIZED (
    SELECT e.row, e.vec_id, e.v, k.c, {apart} AS d FROM e CROSS JOIN k{r} k
    QUALIFY row_number() OVER (PARTITION BY e.row ORDER BY d, k.c) = 1)"""
        if r < rounds:
            out += f""",
k{r + 1} AS MATERIALIZED (
    SELECT k.c, coalesce(m.v, k.v) AS v FROM k{r} k LEFT JOIN (
        SELECT c, list(x ORDER BY i) AS v FROM (
            SELECT c, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x
            FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i)
        GROUP BY c) m USING (c))"""
    return out


SQL["op13_heap_ordered_bounds"] = f"""
WITH {_rounds(8, 10)}
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM a10 a JOIN k10 k USING (c)
"""
