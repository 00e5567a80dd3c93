"""op12: the collocations of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epiloom.llm.collocations import LONGEST, collocations
from epiloom.llm.common import LOWER, UPPER, table
from epiloom.llm.registry import query

LEAST, TOP, DOMINANCE = 100, 2000, 100

_LEADS = ", ".join(f"lead(x, {i}) OVER w AS w{i + 1}" for i in range(1, LONGEST))
_GRAMS = " UNION ALL ".join(
    f"SELECT lang, {m} AS m, concat_ws(' ', {', '.join(f'w{i + 1}' for i in range(m))}) AS phrase FROM leads WHERE w{m} IS NOT NULL"
    for m in range(1, LONGEST + 1)
)
_PARTS = f"""
    SELECT lang, a, unnest(flatten(list_transform(range(2, len(w)), lambda m: list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS phrase
    FROM found WHERE len(w) > 2"""
SQL = f"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
), words AS (SELECT lang, id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM pieces WHERE len(w) > 0
), leads AS MATERIALIZED (SELECT lang, x AS w1, {_LEADS} FROM words WINDOW w AS (PARTITION BY id ORDER BY i)
), counts AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM ({_GRAMS}) GROUP BY ALL HAVING count(*) >= {LEAST} OR m = 1
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang
), found AS (SELECT lang, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE m > 1 AND f >= {LEAST}
), cuts AS (SELECT lang, phrase, w, a, unnest(range(1, len(w))) AS k FROM found
), scored AS (
    SELECT c.lang, c.phrase, a, n, k, h.f AS l, r.f AS r, 1000::HUGEINT * a * n // (h.f::HUGEINT * r.f) AS score
    FROM cuts c JOIN totals t ON c.lang = t.lang
    JOIN counts h ON h.lang = c.lang AND h.phrase = array_to_string(w[:k], ' ') JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (SELECT lang, phrase, max(a) AS f FROM ({_PARTS}) GROUP BY ALL
), ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
    FROM lowest s LEFT JOIN longer o ON s.lang = o.lang AND s.phrase = o.phrase WHERE o.f IS NULL OR 100 * o.f < {DOMINANCE} * a
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= {TOP}
"""


@query("op12_phrase_collocations", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), LEAST, TOP, DOMINANCE)
