"""op11: all documents mixed by source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epiloom.llm import mixing as M
from epiloom.llm.common import table
from epiloom.llm.registry import query

WEIGHTS, PERCENT, MOST = (3, 1, 2), 150, 2


def _hash_sql(text: str, digits: int = 15) -> str:
    return f"('0x' || substr(md5({text}), 1, {digits}))::BIGINT"


SQL = f"""
WITH RECURSIVE found AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{M.WORD}'))::BIGINT AS size, md5(coalesce(text, '')) AS tie,
           {_hash_sql("'bucket:' || coalesce(doc_id::VARCHAR, '')", 8)} % greatest(1, ceil((SELECT count(*) FROM documents) / {M.BUCKET_ROWS})::BIGINT) AS bucket
    FROM documents
), placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY bucket, doc_id NULLS FIRST, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM found
), weighed AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM found GROUP BY source
), capped AS (
    SELECT *, {MOST} * source_size AS cap, [{", ".join(map(str, WEIGHTS))}][rank % {len(WEIGHTS)} + 1] AS weight FROM weighed
), ordered AS (
    SELECT *, coalesce(sum(cap) OVER w, 0) AS cap_before, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left, sum(source_size) OVER () * {PERCENT / 100} AS share
    FROM capped WINDOW w AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT (share - cap_before) / weight_left AS level FROM ordered WHERE cap_before * weight + cap * weight_left > share * weight
    ORDER BY cap / weight, rank LIMIT 1
), sources AS (
    SELECT source, rank, source_size, least(cap::DOUBLE, coalesce((SELECT level FROM level) * weight, cap::DOUBLE)) AS target,
           ceil(source_size / {M.BLOCK})::BIGINT AS blocks
    FROM capped
), planned AS (
    SELECT *, CASE WHEN source_size > 0 THEN least({MOST} * blocks, floor(target * blocks / source_size + 0.5)::BIGINT) ELSE 0 END AS slots FROM sources
), drawn AS (
    SELECT rank, blocks, k, {_hash_sql("'mix:' || rank || ':' || k")} % greatest(1, ceil((SELECT sum(slots) FROM planned) / {M.SHARD_BLOCKS})::BIGINT) AS shard
    FROM (SELECT rank, blocks, unnest(range(slots)) AS k FROM planned)
), slots AS (
    SELECT rank, blocks, shard, row_number() OVER (PARTITION BY rank ORDER BY shard, k) - 1 AS slot FROM drawn
), based AS (
    SELECT rank, blocks, slot, {_hash_sql("'mix-order:' || rank || ':' || slot // blocks", 7)} AS base FROM slots
), walk AS (
    SELECT rank, blocks, slot, base, slot % blocks AS x, 1::BIGINT AS r FROM based
    UNION ALL
    SELECT rank, blocks, slot, base,
           CASE WHEN ((greatest(x, other) + key) % {M.PRIME}) * ((greatest(x, other) + key) % {M.PRIME}) % {M.PRIME} % 2 = 1 THEN other ELSE x END, r + 1
    FROM (SELECT *, ((key - x) % blocks + blocks) % blocks AS other FROM (SELECT *, (base * (2 * r + 1) * 1000003 + r * 7919) % {M.PRIME} AS key FROM walk WHERE r <= {M.ROUNDS}))
), used AS (
    SELECT rank, x AS block, count(*) AS times FROM walk WHERE r = {M.ROUNDS + 1} GROUP BY rank, x
), parts AS (
    SELECT rank, start, unnest(range(start // {M.BLOCK}, (start + size - 1) // {M.BLOCK} + 1)) AS block, size
    FROM placed p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source WHERE size > 0
), sums AS (
    SELECT p.rank, p.start, sum((least(start + size, (p.block + 1) * {M.BLOCK}) - greatest(start, p.block * {M.BLOCK})) * times)::BIGINT AS taken
    FROM parts p JOIN used u ON p.rank = u.rank AND p.block = u.block GROUP BY ALL
)
SELECT p.doc_id, p.source, p.size, s.source_size, s.target, CASE WHEN p.size > 0 THEN coalesce(t.taken, 0) ELSE 0 END AS taken
FROM placed p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source LEFT JOIN sums t ON s.rank = t.rank AND p.start = t.start
"""


@query("op11_source_mix", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.mix(table(spark, sf_dir, "documents"), WEIGHTS, PERCENT, MOST)
