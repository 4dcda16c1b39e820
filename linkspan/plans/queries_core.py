"""Queries of the general operators, with their SQL."""

from __future__ import annotations

from linkspan.operators.selection import key_statistics, select_by_rank
from linkspan.sources.tables import table


def p6_found(spark, d):
    return select_by_rank(table(spark, d, "test_source1"), "country", "entity_id").select("country", "entity_id")


def p6_country_statistics(spark, d):
    return key_statistics(table(spark, d, "test_source1"), "country", "entity_id", "business_name")


QUERIES = {"p6_found": p6_found, "p6_country_statistics": p6_country_statistics}

_MIDDLE = """
  SELECT country, entity_id, n FROM (
    SELECT country, entity_id, row_number() OVER (PARTITION BY country ORDER BY entity_id) AS rn, count(*) OVER (PARTITION BY country) AS n
    FROM (SELECT DISTINCT country, entity_id FROM test_source1 WHERE country IS NOT NULL AND entity_id IS NOT NULL))
  WHERE rn = (n + 1) // 2"""

SQL = {
    "p6_found": f"SELECT country, entity_id FROM ({_MIDDLE})",
    "p6_country_statistics": f"""
SELECT m.country, m.n AS records, count(DISTINCT s.business_name) AS distinct_names, m.entity_id AS middle_entity_id
FROM ({_MIDDLE}) m JOIN test_source1 s ON s.country = m.country GROUP BY ALL""",
}
