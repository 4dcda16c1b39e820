"""SQL of the resolver."""

from __future__ import annotations

from linkspan.operators.resolve import LEAST_AFFINITY, MOST_PER_RECORD, REGIONS, STOPWORDS, STREET_TYPES
from linkspan.plans.feature_sql import _STORED, _long, _q, in_one_byte, low, nfkc

_ASCII = f"regexp_replace(strip_accents({nfkc(_long('business_address'))}), '[^\\x00-\\x7F]', '', 'g')"
_SKIP = "[" + ", ".join(map(_q, STREET_TYPES + REGIONS + STOPWORDS)) + "]"


def _side(t: str, tables: str) -> str:
    return f"""{t}0 AS ({tables}),
{t}1 AS (SELECT entity_id, {low("coalesce(business_name, 'None')")} AS name, regexp_extract_all(lower(coalesce({_ASCII}, '')), '[a-z0-9]+') AS w FROM {t}0),
{t} AS (SELECT entity_id, name, list_filter(w, lambda x: regexp_full_match(x, '[0-9]{{1,5}}'))[1] AS num, list_distinct(list_filter(w, lambda x: NOT regexp_full_match(x, '[0-9]+') AND NOT list_contains({_SKIP}, x))) AS street FROM {t}1)"""


_SOURCE = "SELECT DISTINCT entity_id, business_name, business_address, country FROM test_source{}"
_BOTH = _SOURCE.format(2) + " UNION ALL " + _SOURCE.format(3)
_ZERO = "regexp_replace({}, '^0+(.)', '\\1')"
_DISTANCE = f"levenshtein({in_one_byte('ln', 'letters')}, {in_one_byte('rn', 'letters')})"
_LONGER = "greatest(length(ln), length(rn))"


_CTES = f"""WITH p AS ({_STORED}), {_side('l', _SOURCE.format(1))}, {_side('r', _BOTH)},
j AS (SELECT p.*, coalesce(l.name, '') AS ln, coalesce(r.name, '') AS rn, {_ZERO.format('l.num')} AS lu, {_ZERO.format('r.num')} AS ru, coalesce(l.street, []) AS ls, coalesce(r.street, []) AS rs
  FROM p LEFT JOIN l ON l.entity_id = p.source1_entity_id LEFT JOIN r ON r.entity_id = p.candidate_entity_id),
k AS (SELECT *, list_distinct(string_split(ln || rn, '')) AS letters, len(list_intersect(ls, rs)) AS shared FROM j),
a AS (SELECT source1_entity_id, candidate_entity_id, CASE WHEN {_LONGER} = 0 THEN 1.0 ELSE 1 - {_DISTANCE} / CAST({_LONGER} AS DOUBLE) END
  + CASE WHEN lu = ru THEN 1.0 WHEN lu <> ru THEN -1.0 ELSE 0.0 END + CASE WHEN shared > 0 THEN 0.5 * shared WHEN len(ls) > 0 AND len(rs) > 0 THEN -0.5 ELSE 0.0 END AS affinity FROM k),
c AS (SELECT *, count(*) OVER (PARTITION BY candidate_entity_id) AS n, row_number() OVER (PARTITION BY candidate_entity_id ORDER BY affinity DESC, source1_entity_id) AS best FROM a),
w AS (SELECT source1_entity_id, candidate_entity_id, CASE WHEN n = 1 THEN 0 ELSE 1 END AS late FROM c WHERE n = 1 OR (best = 1 AND affinity >= {LEAST_AFFINITY}))"""

AFFINITY = f"{_CTES} SELECT source1_entity_id, candidate_entity_id, affinity FROM a"
EXCLUSIVE = f"{_CTES} SELECT source1_entity_id, candidate_entity_id FROM w"
CAPPED = f"{_CTES} SELECT source1_entity_id, candidate_entity_id FROM w QUALIFY row_number() OVER (PARTITION BY source1_entity_id ORDER BY late, candidate_entity_id) <= {MOST_PER_RECORD}"
