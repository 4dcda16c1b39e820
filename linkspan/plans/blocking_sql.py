"""SQL of the blocking queries, for an engine with RE2 patterns."""

from __future__ import annotations

from linkspan.functions.regexes import LEGAL_RE2, PREFIX_RE2
from linkspan.operators.blocking import ADDRESS_STOPWORDS, CAP, CHANNELS, PRIORITY


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {_q(pattern)}, {_q(to)}, 'g')"


_LOW = "lower(trim(business_name))"
_ALNUM = lambda x: _sub(x, "[^a-z0-9]")
_PLAIN = _ALNUM("lower(business_name)")
_DOTLESS = f"replace({_LOW}, '.', '')"
_ENDS = _sub(_LOW, LEGAL_RE2)
_TOKENS = lambda c: f"string_split({_sub(f'lower(trim({c}))', '[^a-z0-9 ]', ' ')}, ' ')"
_SOURCES = """
s1 AS (SELECT DISTINCT entity_id AS id, business_name, business_address, country FROM test_source1 WHERE country IS NOT NULL),
cand AS (SELECT DISTINCT entity_id AS id, business_name, business_address, country FROM test_source2 WHERE country IS NOT NULL
  UNION ALL SELECT DISTINCT entity_id, business_name, business_address, country FROM test_source3 WHERE country IS NOT NULL)"""


def _side(t: str) -> str:
    named, placed = "trim(business_name) <> ''", "trim(business_address) <> ''"
    stop = ", ".join(map(_q, ADDRESS_STOPWORDS))
    return f"""
{t}_k AS (SELECT id, country,
    CASE WHEN {named} THEN {_ALNUM(_sub(_DOTLESS, LEGAL_RE2))} END AS a,
    CASE WHEN {named} THEN {_ALNUM(_sub(_sub(_DOTLESS, PREFIX_RE2), LEGAL_RE2))} END AS a2,
    ltrim(nullif(regexp_extract(business_address, '[0-9]{{1,6}}'), ''), '0') AS num,
    CASE WHEN length({_PLAIN}) >= 3 THEN substring({_PLAIN}, 1, 3) END AS p3,
    CASE WHEN length({_PLAIN}) >= 7 THEN substring({_PLAIN}, 2, 7) END AS del_key,
    CASE WHEN length({_ENDS}) >= 5 THEN substring({_ENDS}, 1, 4) END AS p4,
    CASE WHEN length({_ENDS}) >= 5 THEN right({_ENDS}, 4) END AS s4 FROM {t}),
{t}_nt AS (SELECT id, country, unnest({_TOKENS('business_name')}) AS tok FROM {t} WHERE {named}),
{t}_at AS (SELECT id, country, num, tok FROM (SELECT k.id, k.country, k.num, unnest({_TOKENS('business_address')}) AS tok FROM {t} JOIN {t}_k k USING (id) WHERE {placed})),
{t}_nt4 AS (SELECT * FROM {t}_nt WHERE length(tok) >= 4),
{t}_at5 AS (SELECT * FROM {t}_at WHERE length(tok) >= 5 AND tok NOT IN ({stop}))"""


_RARE = """
rare_n AS (SELECT country, tok, count(*) AS n FROM cand_nt4 GROUP BY ALL HAVING count(*) BETWEEN 2 AND 100),
rare_a AS (SELECT country, tok, count(*) AS n FROM cand_at5 GROUP BY ALL HAVING count(*) BETWEEN 2 AND 100),
rare_g AS (SELECT country, del_key, count(*) AS n FROM cand_k WHERE del_key IS NOT NULL GROUP BY ALL HAVING count(*) BETWEEN 2 AND 100),
rare_c AS (SELECT country, p4, s4, count(*) AS n FROM cand_k WHERE p4 IS NOT NULL GROUP BY ALL HAVING count(*) BETWEEN 2 AND 50)"""

_JOINS = {
    "a": "s1_k s JOIN cand_k c USING (country, a) WHERE length(a) >= 3",
    "a2": "s1_k s JOIN cand_k c USING (country, a2) WHERE length(a2) >= 3",
    "b": "s1_nt s JOIN rare_n USING (country, tok) JOIN cand_nt4 c USING (country, tok)",
    "c": "s1_k s JOIN rare_c USING (country, p4, s4) JOIN cand_k c USING (country, p4, s4)",
    "d": "s1_at s JOIN rare_a USING (country, tok) JOIN cand_at5 c USING (country, tok)",
    "e": "s1_k s JOIN cand_k c USING (country, num, p3) WHERE length(num) > 0",
    "e2": "s1_at s JOIN rare_a USING (country, tok) JOIN cand_at5 c USING (country, tok, num) WHERE length(num) > 0",
    "g": "s1_k s JOIN rare_g USING (country, del_key) JOIN cand_k c USING (country, del_key)",
}
BASE = f"WITH {_SOURCES}, {_side('s1')}, {_side('cand')}, {_RARE}"


def channel(c: str, cap: int) -> str:
    return f"""SELECT s.id AS s1_id, c.id AS candidate_id, {PRIORITY[c]} AS priority_score FROM {_JOINS[c]}
  QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY c.id) <= {CAP[c] or cap}"""


def candidates(cap: int) -> str:
    parts = " UNION ALL ".join(f"(SELECT *, '{c}' AS chan FROM ({channel(c, cap)}))" for c in CHANNELS)
    flags = ", ".join(f"CAST(max(CASE WHEN chan = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS fired_chan_{c}" for c in CHANNELS)
    return f"""{BASE}, u AS ({parts}),
  g AS (SELECT s1_id AS source1_entity_id, candidate_id AS candidate_entity_id, CAST(sum(priority_score) AS DOUBLE) AS total_priority,
    count(DISTINCT chan) AS channels_fired, {flags} FROM u GROUP BY 1, 2)
  SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY total_priority DESC, channels_fired DESC, candidate_entity_id) AS rank_order FROM g
  QUALIFY rank_order <= {cap}"""
