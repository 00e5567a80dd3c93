"""URL rules and shrunk host reputations."""

import math
from urllib.parse import quote

import pytest

from epiloom.llm import reputation as R
from epiloom.llm.url_queries import RULES, SQL, page_outcomes
from check_oracles import rows_of

URLS = {
    "http://a.example.com/x": ("a.example.com", "/x", "com/", "allow"),
    "HTTPS://A.EXAMPLE.com/en/1?q=/fr/#z": ("a.example.com", "/en/1", "example.com/en/", "block"),
    "x://b.www.example.com/en/": ("b.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://wwwexample.com/en/": ("wwwexample.com", "/en/", "com/", "allow"),
    "http://notcom/": ("notcom", "/", None, "allow"),
    "http://com": ("com", "", None, "allow"),
    "http://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
    "http://a.net?x://b.net/es/": ("a.net", "", None, "allow"),
    "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), "a\nb://ÄB.net/fr/": ("Äb.net", "/fr/", "net/fr/", "block"),
}


def test_rules(spark):
    rows = [(i, u, "clash") for i, u in enumerate([*URLS, None])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    none = spark.createDataFrame([], "page_id bigint, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in R.judge_pages(pages, none, RULES).collect()}
    assert got == {i: want for i, want in enumerate([*URLS.values(), ("", "", None, "allow")])}
    assert R.judge_pages(pages.limit(0), none, RULES).count() == 0


def posterior(x, n, mean, strength):
    m = (x + strength * mean) / (n + strength)
    return m, m - 1.645 * math.sqrt(m * (1 - m) / (n + strength + 1))


def test_shrinking(spark):
    counts = [("a.x.org", 50.0, 48.0), ("b.x.org", 0.0, 0.0), ("c.y.org", 60.0, 2.0), ("d.z.co.uk", 1.0, 1.0), ("e.z.co.uk:80", 5.0, 0.0)]
    df = spark.createDataFrame(counts, "host string, n double, x double")
    got = {r.host: r for r in R.host_posteriors(df).collect()}
    assert set(got) == {h for h, _, _ in counts}
    assert got["a.x.org"].mean > got["b.x.org"].mean > got["c.y.org"].mean  # no labels: the domain's share
    assert got["a.x.org"].lower > got["b.x.org"].lower and got["a.x.org"].lower > 0.5 > got["c.y.org"].lower and got["d.z.co.uk"].mean < 0.9
    assert all(0 <= r.mean <= 1 and r.lower <= r.mean for r in got.values())
    assert got["b.x.org"].lower == pytest.approx(posterior(0, 0, got["b.x.org"].mean, _strength(got))[1])


def _strength(got):
    """From a host without labels: its spread tells how much its domain's mean weighs."""
    r = got["b.x.org"]
    return r.mean * (1 - r.mean) / ((r.mean - r.lower) / 1.645) ** 2 - 1


def test_learned_verdicts_and_sql(spark, tmp_path):
    import duckdb

    hosts = ["good.a.org", "bad.a.org", "new.b.net", "bad.c.net:8080", "x.d.co.uk"]
    pages = [(i, f"http://{hosts[i % 5]}/de/{i}{quote('ü')}/{i}.html") for i in range(300)] + [(300, None), (301, "http://bad.a.org/nothing"), (None, "http://bad.a.org/7")]
    labels = [(i, int(i % 5 not in (1, 3)), 0) for i in range(300) if i % 5 != 2] + [(5, None, None), (None, 0, 1)]
    p = spark.createDataFrame(pages, "page_id bigint, url string")
    l = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")  # noqa: E741
    got = R.judge_pages(p, page_outcomes(p, l), RULES)
    verdicts = {(r.host, r.verdict) for r in got.collect() if r.rule is None}
    assert ("bad.a.org", "block") in verdicts and ("good.a.org", "allow") in verdicts and ("bad.c.net:8080", "block") in verdicts
    db = duckdb.connect()
    p.toPandas().to_parquet(tmp_path / "p.parquet")
    l.toPandas().astype("Int64").to_parquet(tmp_path / "l.parquet")
    db.execute(f"CREATE VIEW pages AS SELECT CAST(page_id AS BIGINT) AS page_id, url FROM read_parquet('{tmp_path}/p.parquet')")
    db.execute(f"CREATE VIEW labels AS SELECT * FROM read_parquet('{tmp_path}/l.parquet')")
    found = db.execute(SQL)
    names = [d[0] for d in found.description]
    assert rows_of(names, found.fetchall()) == rows_of(got.columns, got.collect())
