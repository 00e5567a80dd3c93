"""op1: every page written as a WARC record and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epiloom.llm import warc
from epiloom.llm.common import stored, table
from epiloom.llm.registry import query
from epiloom.session import scratch_path

SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= {warc.LEAST_REVISIT_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest
"""


@query("op1_warc_segments", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = stored(warc.read_archives(spark, path, with_payload=False).drop("payload"), "warc-records")
    return warc.resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
