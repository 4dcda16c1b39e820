"""SQL of the feature queries, for an engine without NFKC, look-around or context-sensitive case."""

from __future__ import annotations

import unicodedata

from linkspan.functions import regexes as R
from linkspan.operators.features import ADDRESS_STOPWORDS, BUSINESS_WORDS, CHANNEL_FLAGS, FEATURE_NAMES

_RANGES = [(0xA0, 0x2200), (0x2460, 0x2500), (0x3000, 0x3400), (0xF900, 0xFB00), (0xFB00, 0xFB50), (0xFF00, 0xFFF0)]


def _compatible() -> tuple[str, str, list[tuple[str, str]]]:
    """(characters, their one-character NFKC) and the (character, longer NFKC) pairs of _RANGES."""
    one, to, more = [], [], []
    for lo, hi in _RANGES:
        for c in map(chr, range(lo, hi)):
            k = unicodedata.normalize("NFKC", c)
            if k == c or k == unicodedata.normalize("NFC", c):
                continue
            if len(k) == 1 and c not in "'" and k not in "'":
                one.append(c)
                to.append(k)
            else:
                more.append((c, k))
    return "".join(one), "".join(to), more


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def nfkc(x: str) -> str:
    one, to, _ = _compatible()
    return f"translate({x}, {_q(one)}, {_q(to)})"


def _long(x: str) -> str:
    """Characters with a longer NFKC, put in by one pass over the text's characters."""
    rows = _compatible()[2]
    keys, values = "[" + ", ".join(_q(c) for c, _ in rows) + "]", "[" + ", ".join(_q(k) for _, k in rows) + "]"
    return f"array_to_string(list_transform(CASE WHEN {x} = '' THEN [] ELSE string_split({x}, '') END, lambda ch: CASE WHEN ascii(ch) < 128 THEN ch ELSE coalesce(({values})[list_position({keys}, ch)], ch) END), '')"


BLANK = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+"


def clean(x: str) -> str:
    return f"coalesce(nfc_normalize({nfkc(_long(f'regexp_replace({x}, {_q("^" + BLANK + "|" + BLANK + "$")}, {_q("")}, {_q("g")})'))}), '')"


def low(x: str) -> str:
    """Lower case with a final sigma at the end of a word."""
    return rf"regexp_replace(lower({x}), '([\p{{L}}\p{{M}}])σ($|[^\p{{L}}\p{{M}}])', '\1ς\2', 'g')"


def words(x: str, least: int, stop: list[str] | None = None) -> str:
    skip = f" AND NOT list_contains([{', '.join(map(_q, stop))}], w)" if stop else ""
    return rf"list_filter(regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= {least}{skip})"


def _numbers(x: str, test: str = r"\p{Nd}+") -> str:
    return rf"list_filter(regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '{test}'))"


_DIGITS = "".join(chr(base + i) for base in (0x0966, 0x09E6, 0x0A66, 0x0AE6, 0x0BE6, 0x0C66, 0x0660, 0x06F0) for i in range(10))
_PLAIN = f"translate(a, {_q(_DIGITS)}, {_q('0123456789' * 8)})"
_ZERO = "CASE WHEN ltrim(w, '0') = '' THEN '0' ELSE ltrim(w, '0') END"


_W = r"\p{L}\p{N}_"
_B = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}"
_SEPARATORS = rf",{_B}\-\(\[\#"
_FORMS = R._phrases(f"[{_B}]")
#: The legal form at the end after a run of separators, or after a character that is neither one nor part of a word.
_LEGAL = rf"(?i)(?:(^|[^{_SEPARATORS}])[{_SEPARATORS}]+|(^|[^{_W}{_SEPARATORS}]))({_FORMS})[,{_B}\.\)\]]*$"
_DOMAIN = rf"(?i)\.(?:{'|'.join(R.DOMAINS)})([^{_W}]|$)"
_START = r"|^www\."
_NOISE = "(?i)" + R._prefix(f"[{_B}]")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {_q('^' + BLANK + '|' + BLANK + '$')}, '', 'g')"


def _without_domain(x: str) -> str:
    """Twice, as a match takes the character after it along, at which the next may begin."""
    once = f"regexp_replace({x}, {_q(_DOMAIN)}, '\\1', 'g')"
    return _strip(rf"regexp_replace(regexp_replace({once}, {_q(_DOMAIN)}, '\1', 'g'), '(?i)^www\.', '')")


def in_one_byte(x: str, alphabet: str) -> str:
    """x with each character as the one-byte character of its place in the alphabet, so that distances by bytes count characters."""
    return f"array_to_string(list_transform(CASE WHEN {x} = '' THEN [] ELSE string_split({x}, '') END, lambda ch: chr(CAST(list_position({alphabet}, ch) AS INT))), '')"


def _described(t: str) -> str:
    return rf"""{t}0 AS (SELECT entity_id AS id, coalesce(country, '') AS country, {clean('business_name')} AS n, {clean('business_address')} AS a FROM {t}),
{t}1 AS (SELECT id, country, n, a, {low('n')} AS n_low, {low('a')} AS a_low FROM {t}0),
{t}2 AS (SELECT id, country, n, a, n_low, a_low, regexp_replace(n_low, '[^\p{{L}}\p{{N}}]+', '', 'g') AS n_alnum, {words('n_low', 2)} AS n_words, {words('a_low', 3, ADDRESS_STOPWORDS)} AS a_words, {words('a_low', 2)} AS a_all,
  list_transform({_numbers(_PLAIN)}, lambda w: {_ZERO}) AS a_numbers, list_distinct({_numbers('a', '[0-9]{5,6}')}) AS a_postal,
  regexp_matches(n, '[\x{{0600}}-\x{{10FFFF}}]') AS native, regexp_matches(n, '[^\x00-\x7F]') AS beyond,
  {low(_strip(f"regexp_replace(n, {_q(_LEGAL)}, '\\1\\2')"))} AS n_legal, {low(_without_domain('n'))} AS n_domain, regexp_matches(n, {_q(_LEGAL)}) AS has_form, {low(f"regexp_extract(n, {_q(_LEGAL)}, 3)")} AS form,
  regexp_matches(n, {_q(_DOMAIN + _START)}) AS url, regexp_matches(n, {_q(_NOISE)}) AS noise FROM {t}1),
{t}3 AS (SELECT *, CASE WHEN length(n_alnum) < 3 THEN [n_alnum] ELSE list_distinct(list_transform(range(1, length(n_alnum) + 1), lambda i: substring('^' || n_alnum || '$', i, 3))) END AS grams FROM {t}2)"""


_COLUMNS = "n_low a_low n_alnum n_words a_words a_all a_numbers a_postal native beyond n_legal n_domain has_form form url noise grams"


def _sides(x: str) -> str:
    return ", ".join(f"l.{c} AS l_{c}, r.{c} AS r_{c}" for c in x.split())


_STORED = "SELECT DISTINCT source1_entity_id, candidate_entity_id FROM candidate_pairs WHERE source1_entity_id IS NOT NULL AND candidate_entity_id IS NOT NULL"


def base(pairs: str = _STORED) -> str:
    """CTEs that end in k, the pairs with everything that the features compare."""
    return f"""WITH p AS ({pairs}), s1 AS (SELECT DISTINCT entity_id, business_name, business_address, country FROM test_source1),
pool AS (SELECT DISTINCT entity_id, business_name, business_address, country FROM test_source2 UNION ALL SELECT DISTINCT entity_id, business_name, business_address, country FROM test_source3),
{_described('s1')}, {_described('pool')},
j AS (SELECT p.*, coalesce(l.n, '') AS l_n, coalesce(r.n, '') AS r_n, coalesce(l.a, '') AS l_a, coalesce(r.a, '') AS r_a, coalesce(l.country, '') AS l_country, coalesce(r.country, '') AS r_country, {_sides(_COLUMNS)}
  FROM p LEFT JOIN s13 l ON l.id = p.source1_entity_id LEFT JOIN pool3 r ON r.id = p.candidate_entity_id),
k AS (SELECT *, l_n <> '' AND r_n <> '' AS named, l_a <> '' AND r_a <> '' AS placed, list_intersect(l_n_words, r_n_words) AS nw, list_distinct(list_concat(l_n_words, r_n_words)) AS nu,
  list_intersect(l_a_words, r_a_words) AS aw, list_distinct(list_concat(l_a_words, r_a_words)) AS au, list_intersect(l_a_numbers, r_a_numbers) AS an, len(l_a_postal) > 0 AND len(r_a_postal) > 0 AS both_postal,
  len(list_intersect(l_a_postal, r_a_postal)) > 0 AS shared_postal, len(list_intersect(l_grams, r_grams)) AS gw, list_distinct(string_split(l_n_alnum || r_n_alnum, '')) AS letters FROM j)"""


def _when(cond: str, value: str, name: str) -> str:
    return f"CASE WHEN {cond} THEN CAST({value} AS FLOAT) ELSE 0::FLOAT END AS {name}"


_NAMED, _PLACED = "named AND len(l_n_words) > 0 AND len(r_n_words) > 0", "placed AND len(l_a_words) > 0 AND len(r_a_words) > 0"
_SPELLED = "named AND l_n_alnum <> '' AND r_n_alnum <> ''"
_LONGER, _SHORTER = (f"CAST({f}(length(l_n_alnum), length(r_n_alnum)) AS DOUBLE)" for f in ("greatest", "least"))
_BYTES = in_one_byte("l_n_alnum", "letters"), in_one_byte("r_n_alnum", "letters")
_BUSINESS = "[" + ", ".join(map(_q, BUSINESS_WORDS)) + "]"
_NAME_TOKENS = [
    _when("named", "l_n_low = r_n_low", "name_raw_exact"), _when("named AND l_n_alnum <> ''", "l_n_alnum = r_n_alnum", "name_alphanumeric_exact"),
    _when(_SPELLED, "abs(length(l_n_alnum) - length(r_n_alnum))", "name_length_diff"),
    _when(_NAMED, "len(nw) / CAST(len(nu) AS DOUBLE)", "name_token_jaccard"), _when(_NAMED, "len(nw) / CAST(least(len(list_distinct(l_n_words)), len(list_distinct(r_n_words))) AS DOUBLE)", "name_token_overlap_coef"),
    _when(_NAMED, "len(nw) = len(list_distinct(l_n_words))", "name_token_containment_s1"), _when(_NAMED, "len(nw) = len(list_distinct(r_n_words))", "name_token_containment_cand"),
    _when(_NAMED, "len(nw)", "name_shared_token_count"), _when("named", "abs(len(l_n_words) - len(r_n_words))", "name_token_count_diff"),
    _when(_NAMED, "l_n_words[1] = r_n_words[1]", "name_first_token_match"), _when(_NAMED, "l_n_words[-1] = r_n_words[-1]", "name_last_token_match"),
    _when("named", f"len(list_intersect(nw, {_BUSINESS}))", "business_word_overlap_count"),
    _when("named", "NOT l_native AND NOT r_native", "name_both_latin"), _when("named", "l_native <> r_native", "name_cross_script"), _when("named", "l_beyond OR r_beyond", "name_has_non_ascii"), _when("NOT named", "1", "name_missing_either"),
]
_NAME_MORE = [
    _when("named AND l_n_legal <> ''", "l_n_legal = r_n_legal", "name_legal_stripped_exact"), _when("named AND l_n_domain <> ''", "l_n_domain = r_n_domain", "name_domain_stripped_exact"),
    _when(_SPELLED, f"1 - levenshtein({_BYTES[0]}, {_BYTES[1]}) / {_LONGER}", "name_levenshtein_sim"), _when(_SPELLED, f"jaro_winkler_similarity({_BYTES[0]}, {_BYTES[1]})", "name_jaro_winkler_sim"),
    _when(_SPELLED, "gw / CAST(len(l_grams) + len(r_grams) - gw AS DOUBLE)", "name_char_3gram_jaccard"), _when(_SPELLED, f"{_SHORTER} / {_LONGER}", "name_length_ratio"),
    _when("named", "(NOT l_has_form AND NOT r_has_form) OR (l_has_form AND r_has_form AND l_form = r_form)", "legal_suffix_agreement"), _when("named", "l_has_form AND r_has_form AND l_form <> r_form", "legal_suffix_mismatch"),
]
_ADDRESS = [
    _when("placed", "l_a_low = r_a_low", "address_raw_exact"), _when(_PLACED, "len(aw) / CAST(len(au) AS DOUBLE)", "address_token_jaccard"),
    _when(_PLACED, "len(aw) / CAST(least(len(list_distinct(l_a_words)), len(list_distinct(r_a_words))) AS DOUBLE)", "address_token_overlap_coef"), _when(_PLACED, "len(aw)", "address_shared_token_count"),
    _when(_PLACED, "len(aw) = len(list_distinct(l_a_words)) OR len(aw) = len(list_distinct(r_a_words))", "address_token_containment"), _when("placed", "abs(len(l_a_words) - len(r_a_words))", "address_token_count_diff"),
    _when("placed AND len(l_a_all) > 0 AND len(r_a_all) > 0", "l_a_all[1] = r_a_all[1]", "address_first_token_match"), _when("placed AND len(l_a_all) > 0 AND len(r_a_all) > 0", "l_a_all[-1] = r_a_all[-1]", "address_last_token_match"),
    _when("placed AND len(l_a_numbers) > 0 AND len(r_a_numbers) > 0", "l_a_numbers[1] = r_a_numbers[1]", "address_building_num_match"), _when("placed", "len(an)", "address_shared_numeric_count"),
    _when("placed AND len(an) > 0", "len(an) / CAST(len(list_distinct(list_concat(l_a_numbers, r_a_numbers))) AS DOUBLE)", "address_numeric_token_jaccard"), _when("placed", "len(an) > 0", "address_has_shared_numeric"),
    _when("placed AND both_postal", "shared_postal", "address_postal_exact_match"), _when("placed", "both_postal", "address_postal_both_present"), _when("placed AND both_postal", "NOT shared_postal", "address_postal_mismatch"),
    _when("l_a = ''", "1", "address_missing_s1"), _when("r_a = ''", "1", "address_missing_cand"),
]
_OTHERS = [
    _when("l_country <> ''", "l_country = r_country", "country_exact_match"), _when("true", "l_country = '' OR r_country = ''", "country_missing_either"),
    _when("true", "candidate_entity_id LIKE 'S2-%'", "candidate_is_source2"), _when("true", "candidate_entity_id LIKE 'S3-%'", "candidate_is_source3"),
    _when("true", "coalesce(r_url, false)", "cand_name_has_url"), _when("true", "coalesce(r_noise, false)", "cand_name_has_noise_prefix"),
]
_STRONG = "address_token_jaccard >= {}::FLOAT"
_BOTH = [
    _when("true", "name_alphanumeric_exact = 1 AND address_building_num_match = 1", "exact_name_and_address_number_match"),
    _when("true", f"name_levenshtein_sim >= 0.85::FLOAT AND {_STRONG.format(0.3)}", "high_name_sim_and_address_overlap"),
    _when("true", "name_shared_token_count >= 1 AND address_has_shared_numeric = 1", "shared_name_and_shared_number"),
    _when("true", "address_postal_exact_match = 1 AND name_token_jaccard >= 0.5::FLOAT", "exact_postal_and_strong_name"),
    _when("true", f"name_cross_script = 1 AND (address_building_num_match = 1 OR {_STRONG.format(0.35)})", "cross_script_and_strong_address"),
    _when("true", "name_token_jaccard < 0.2::FLOAT AND address_building_num_match = 1 AND address_shared_token_count >= 2", "weak_name_and_strong_address"),
    _when("true", f"name_missing_either = 1 AND {_STRONG.format(0.5)}", "name_missing_and_strong_address"),
]
_IDS = "source1_entity_id, candidate_entity_id"


def of(expressions: list[str], pairs: str = _STORED) -> str:
    return f"{base(pairs)} SELECT {_IDS}, {', '.join(expressions)} FROM k"


NAME_TOKENS, NAME, ADDRESS = of(_NAME_TOKENS), of(_NAME_TOKENS + _NAME_MORE), of(_ADDRESS)
SOURCE = of([x for x in _OTHERS if "cand" in x.split(" AS ")[-1]])
INTERACTIONS = f"SELECT {_IDS}, {', '.join(_BOTH)} FROM ({of(_NAME_TOKENS + _NAME_MORE + _ADDRESS)})"


def every(pairs: str) -> str:
    """All features of candidates with provenance."""
    carried = [f"{c}::FLOAT AS {c}" for c in CHANNEL_FLAGS] + ["channels_fired::FLOAT AS channels_fired_count", "total_priority::FLOAT AS blocking_priority_score", "rank_order::FLOAT AS blocking_rank_order"]
    return f"SELECT {_IDS}, {', '.join(FEATURE_NAMES)} FROM (SELECT *, {', '.join(_BOTH)} FROM ({of(_OTHERS + _NAME_TOKENS + _NAME_MORE + _ADDRESS + carried, pairs)}))"
