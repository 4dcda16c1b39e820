"""SQL of the normal forms, for an engine with RE2 patterns and without NFKC."""

from __future__ import annotations

import re

from linkspan.functions import normalise as N
from linkspan.functions import regexes as R
from linkspan.plans.feature_sql import BLANK, _B, _W, _long, _q, _strip, low, nfkc

_SOURCES = " UNION ALL ".join(f"SELECT DISTINCT entity_id, business_name, business_address, country FROM test_source{i}" for i in (2, 3, 1))
_IS_WORD, _IS_BLANK = f"'[{_W}]'", f"'[{_B}]'"
#: Dots of acronyms, told by the characters around them.
_DOT = f"""(ch = '.' AND i > 1 AND regexp_full_match(c[i - 1], '[a-zA-Z]') AND (i = 2 OR NOT regexp_full_match(c[i - 2], {_IS_WORD})) AND
  (i = len(c) OR regexp_full_match(c[i + 1], {_IS_BLANK}) OR (regexp_full_match(c[i + 1], '[a-zA-Z]') AND (i + 1 = len(c) OR NOT regexp_full_match(c[i + 2], {_IS_WORD})))))"""


def _repaired(x: str) -> str:
    for bad, good in N.REPAIRS:
        x = f"replace({x}, {_q(bad)}, {_q(good)})"
    return f"nfc_normalize({nfkc(_long(x))})"


_ANY = "(?:" + "|".join(map(re.escape, N.FORMS)) + ")"
_WORDY, _OTHER = ("(?:" + "|".join(re.escape(f) for f in N.FORMS if f[0].isalnum() == told) + ")" for told in (True, False))
_SEP, _TAIL = rf",{_B}\-(\[#", rf"[,{_B}.)\]]*$"
_FORM = rf"(?i)(?:(^|[^{_SEP}])[{_SEP}]+{_ANY}{_TAIL}|(^|[^{_W}{_SEP}]){_WORDY}{_TAIL}|([{_W}]){_OTHER}{_TAIL}|[(\[{{]{_ANY}[)\]}}]$)"


def _cut(x: str) -> str:
    return _strip(f"regexp_replace({_strip(f'regexp_replace({x}, {_q(_FORM)}, {_q(chr(92) + "1" + chr(92) + "2" + chr(92) + "3")})')}, '[,\\-.#]+$', '')")


def _tokens(x: str) -> str:
    return f"list_filter(regexp_extract_all({low(x)}, '[{_W}]+'), lambda w: w <> '_')"


def _joined(x: str) -> str:
    return f"array_to_string({x}, '|')"


def _set(x: str) -> str:
    return _joined(f"list_sort(list_distinct({x}))")


def _clean(column: str) -> str:
    """CTEs that end in b: id, raw and the clean text."""
    return f"""x AS ({_SOURCES}), r AS (SELECT entity_id, coalesce({column}, '') AS raw, string_split({_repaired(f"coalesce({column}, '')")}, '') AS c FROM x),
d AS (SELECT entity_id, raw, array_to_string(list_filter(c, lambda ch, i: NOT {_DOT}), '') AS t FROM r),
b AS (SELECT entity_id, raw, trim(regexp_replace(t, {_q(BLANK)}, ' ', 'g'), ' ') AS unicode_clean FROM d)"""


_FOLD = lambda x: f"translate({x}, {_q(''.join(N.ACCENTED))}, {_q(''.join(N.ACCENTED.values()))})"
_ALNUM = lambda x: rf"regexp_replace({low(x)}, '[^\p{{L}}\p{{N}}]+', '', 'g')"
_RANGES = {"devanagari": r"\x{0900}-\x{097F}", "tamil": r"\x{0B80}-\x{0BFF}", "gujarati": r"\x{0A80}-\x{0AFF}", "bengali": r"\x{0980}-\x{09FF}", "latin": r"A-Za-z\x{00C0}-\x{024F}"}
_COUNTS = ", ".join(f"length(regexp_replace(unicode_clean, '[^{r}]', '', 'g')) AS {n}" for n, r in _RANGES.items())
_MOST = f"greatest({', '.join(_RANGES)})"
_GRAMS = "CASE WHEN g = '' THEN '' ELSE array_to_string(list_sort(list_distinct(list_transform(range(1, length(g) + 1), lambda i: substring('^' || g || '$', i, 3)))), '|') END"
_MISSING = f"{_strip('raw')} = ''"

NAMES = f"""WITH {_clean('business_name')},
l AS (SELECT *, {low('unicode_clean')} AS lowercased, {_COUNTS} FROM b),
s AS (SELECT *, {_strip(f"regexp_replace(regexp_replace(lowercased, {_q(N.SITE_START)}, ''), {_q(chr(92) + '.(?:' + '|'.join(map(re.escape, N.SITE_ENDS)) + ')(?:/[^ ]*)?$')}, '')")} AS domain_stripped FROM l),
f1 AS (SELECT *, {_cut('domain_stripped')} AS once FROM s),
f2 AS (SELECT *, CASE WHEN length(once) > 2 THEN {_cut('once')} ELSE once END AS twice FROM f1),
f AS (SELECT *, CASE WHEN twice = '' THEN domain_stripped ELSE twice END AS legal_stripped FROM f2),
a AS (SELECT *, {_ALNUM('domain_stripped')} AS alphanumeric_clean, {_ALNUM('legal_stripped')} AS alphanumeric_no_legal, {_tokens('domain_stripped')} AS t, {_tokens('legal_stripped')} AS u FROM f),
k AS (SELECT *, CASE WHEN alphanumeric_no_legal <> '' THEN alphanumeric_no_legal ELSE alphanumeric_clean END AS g FROM a)
SELECT entity_id, raw, {_MISSING} AS is_missing, regexp_matches(unicode_clean, '[^\\x00-\\x7F]') AS is_non_ascii,
  CASE WHEN unicode_clean = '' THEN 'empty' WHEN {_MOST} = 0 THEN 'latin' {' '.join(f"WHEN {n} = {_MOST} THEN '{n}'" for n in _RANGES)} END AS detected_script,
  unicode_clean, lowercased, domain_stripped, legal_stripped, alphanumeric_clean, alphanumeric_no_legal, {_ALNUM(_FOLD("CASE WHEN legal_stripped <> '' THEN legal_stripped ELSE domain_stripped END"))} AS alphanumeric_ascii_folded,
  {_joined('t')} AS tokens, {_set('t')} AS tokens_set, {_joined('u')} AS tokens_no_legal, {_set('u')} AS tokens_no_legal_set, {_GRAMS} AS char_3grams FROM k"""

_FORMS_MAP = f"map([{', '.join(map(_q, N.ADDRESS_FORMS))}], [{', '.join(map(_q, N.ADDRESS_FORMS.values()))}])"
_FULL = f"array_to_string(list_transform(regexp_extract_all(lowercased, '[{_W}]+|[^{_W}]+'), lambda w: coalesce({_FORMS_MAP}[w], w)), '')"
_DIGITS = f"translate(w, {_q(N.DIGITS)}, {_q(N.VALUES)})"
_BARE = rf"CASE WHEN NOT regexp_full_match(w, '\p{{Nd}}+') THEN regexp_replace(w, '^0+(\p{{Nd}})', '\1') WHEN ltrim({_DIGITS}, '0') = '' THEN '0' ELSE ltrim({_DIGITS}, '0') END"
ADDRESSES = f"""WITH {_clean('business_address')},
l AS (SELECT *, {low('unicode_clean')} AS lowercased FROM b),
s AS (SELECT *, {_FULL} AS standardized, list_filter(regexp_extract_all(unicode_clean, '[{_W}]+'), lambda w: regexp_full_match(w, '\\p{{Nd}}{{5,6}}')) AS p FROM l),
n AS (SELECT *, {_tokens('standardized')} AS t, list_transform(list_filter(regexp_extract_all(standardized, '[{_W}]+'), lambda w: regexp_full_match(w, '\\p{{Nd}}+[a-zA-Z]?')), lambda w: lower(w)) AS found FROM s),
k AS (SELECT *, list_concat(list_transform(found, lambda w: {_BARE}), found) AS every FROM n)
SELECT entity_id, raw, {_MISSING} AS is_missing, unicode_clean, lowercased, standardized, {_FOLD('standardized')} AS standardized_ascii_folded, {_joined('t')} AS tokens, {_set('t')} AS tokens_set,
  {_joined('list_transform(list_filter(every, lambda w, i: list_position(every, w) = i), lambda w: w)')} AS numeric_tokens, {_set('every')} AS numeric_tokens_set, {_set('p')} AS postal_codes, len(p) > 0 AS has_postal_code FROM k"""
