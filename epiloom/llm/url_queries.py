"""op9: verdicts on the URLs of all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.llm import reputation as R
from epiloom.llm.common import LOWER, UPPER, table
from epiloom.llm.registry import query

RULES = [
    R.Rule("allow", "com", "/"),
    R.Rule("block", "example.com", "/en/"),
    R.Rule("allow", "www.example.com", "/en/"),
    R.Rule("block", "net", "/es/"),
    R.Rule("block", "net", "/fr/"),
]
SHOWN = r"/(\d{1,18})(?:[./]|$)"

_CHAIN = sorted(RULES, key=lambda r: -len(r.host + r.path))


def _rules_sql(of) -> str:
    cases = " ".join(
        f"WHEN (p.host = '{r.host}' OR ends_with(p.host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{of(r)}'"
        for r in _CHAIN
    )
    return f"CASE {cases} END"


def _strength_sql(children: str, parent: str) -> str:
    return f"""(SELECT 1 / greatest({R.LEAST_RHO}, least({R.MOST_RHO}, coalesce(CASE WHEN room > 0 THEN over_ / room ELSE {R.LEAST_RHO} END, {R.LEAST_RHO}))) - 1 FROM (
        SELECT sum(xx - x * x / n - x / n * (1 - x / n) * (k - 1)) AS over_, sum(x / n * (1 - x / n) * (n - nn / n - (k - 1))) AS room
        FROM (SELECT {parent}, sum(n) AS n, sum(x) AS x, count(*) AS k, sum(x * x / n) AS xx, sum(n * n) AS nn
              FROM {children} WHERE n > 0 GROUP BY {parent})))"""


SQL = f"""
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '{R.URL}', 1), ''), '{UPPER}', '{LOWER}') AS host,
           coalesce(regexp_extract(url, '{R.URL}', 2), '') AS path
    FROM pages
), shown AS (
    SELECT page_id, TRY_CAST(NULLIF(regexp_extract(path, '{SHOWN}', 1), '') AS BIGINT) AS doc_id FROM parts
), outcomes AS (
    SELECT s.page_id, max(CASE WHEN l.quality = 0 OR l.toxic = 1 THEN 1 ELSE 0 END) AS bad
    FROM shown s JOIN labels l ON s.doc_id = l.doc_id GROUP BY s.page_id
), counts AS (
    SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS x
    FROM parts p LEFT JOIN outcomes o ON p.page_id = o.page_id GROUP BY host
), labelled AS (
    SELECT host, n, x, string_split(regexp_replace(host, ':\\d*$', ''), '.') AS l FROM counts
), hosts AS (
    SELECT host, n, x, 1 AS all_,
           CASE WHEN array_to_string(l[-2:], '.') IN {R.TWO_LABEL_SUFFIXES} THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain,
           CASE WHEN array_to_string(l[-2:], '.') IN {R.TWO_LABEL_SUFFIXES} THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix
    FROM labelled
), domains AS (SELECT suffix, domain, sum(n) AS n, sum(x) AS x FROM hosts GROUP BY ALL
), suffixes AS (SELECT suffix, 1 AS all_, sum(n) AS n, sum(x) AS x FROM domains GROUP BY ALL
), s0 AS (SELECT {_strength_sql("suffixes", "all_")} AS s), s1 AS (SELECT {_strength_sql("domains", "suffix")} AS s), s2 AS (SELECT {_strength_sql("hosts", "domain")} AS s
), overall AS (SELECT sum(x) / greatest(sum(n), 1) AS p FROM counts
), top AS (SELECT suffix, (x + (SELECT s FROM s0) * (SELECT p FROM overall)) / (n + (SELECT s FROM s0)) AS m FROM suffixes
), middle AS (SELECT domain, (x + (SELECT s FROM s1) * m) / (n + (SELECT s FROM s1)) AS m FROM domains JOIN top USING (suffix)
), low AS (
    SELECT host, (x + (SELECT s FROM s2) * m) / (n + (SELECT s FROM s2)) AS mean, n + (SELECT s FROM s2) + 1 AS weight
    FROM hosts JOIN middle USING (domain)
)
SELECT page_id, p.host, path, {_rules_sql(lambda r: r.host + r.path)} AS rule,
       coalesce({_rules_sql(lambda r: r.verdict)}, CASE WHEN mean - 1.645 * sqrt(mean * (1 - mean) / weight) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN low ON p.host = low.host
"""


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, bad: a page shows the document whose number its path holds; it is bad if that is of low quality or toxic."""
    number = F.regexp_extract(R.path_of(F.col("url")), SHOWN, 1)
    shown = pages.select("page_id", number.try_cast("bigint").alias("doc_id"))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    return shown.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("page_id", "bad")


@query("op9_host_reputation", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return R.judge_pages(pages, page_outcomes(pages, table(spark, sf_dir, "labels")), RULES)
