"""Sixty-five pairwise features.

What depends on one record is computed once per record; a pair only compares. Features are floats and 0
where a side is missing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspan.functions import regexes as R
from linkspan.functions import text as T
from linkspan.functions.udfs import jaro_winkler, nfkc
from linkspan.plans.durable import durable, release

# Address words that don't count as tokens, and words that many business names share.
ADDRESS_STOPWORDS = (
    "street road avenue drive lane boulevard floor suite apartment building sector district nagar north south east west "
    "house block first second third opposite near st rd ave dr ln blvd fl ste apt bldg sec"
).split()
BUSINESS_WORDS = (
    "enterprises services solutions holdings group industries products international technologies consultancy trading ventures "
    "associates consultants agency management global systems energy logistics development financial properties"
).split()
CHANNEL_FLAGS = [f"fired_chan_{c}" for c in ("a", "a2", "b", "c", "d", "e", "e2", "g")]

GROUPS = {
    "country": ["country_exact_match", "country_missing_either"],
    "name": [
        "name_raw_exact", "name_legal_stripped_exact", "name_domain_stripped_exact", "name_alphanumeric_exact",
        "name_levenshtein_sim", "name_jaro_winkler_sim", "name_char_3gram_jaccard", "name_length_diff", "name_length_ratio",
        "name_token_jaccard", "name_token_overlap_coef", "name_token_containment_s1", "name_token_containment_cand",
        "name_shared_token_count", "name_token_count_diff", "name_first_token_match", "name_last_token_match",
        "legal_suffix_agreement", "legal_suffix_mismatch", "business_word_overlap_count",
        "name_both_latin", "name_cross_script", "name_has_non_ascii", "name_missing_either",
    ],
    "address": [
        "address_raw_exact", "address_token_jaccard", "address_token_overlap_coef", "address_shared_token_count", "address_token_containment",
        "address_token_count_diff", "address_first_token_match", "address_last_token_match", "address_building_num_match",
        "address_shared_numeric_count", "address_numeric_token_jaccard", "address_has_shared_numeric",
        "address_postal_exact_match", "address_postal_both_present", "address_postal_mismatch", "address_missing_s1", "address_missing_cand",
    ],
    "interaction": [
        "exact_name_and_address_number_match", "high_name_sim_and_address_overlap", "shared_name_and_shared_number",
        "exact_postal_and_strong_name", "cross_script_and_strong_address", "weak_name_and_strong_address", "name_missing_and_strong_address",
    ],
    "source": ["candidate_is_source2", "candidate_is_source3", "cand_name_has_url", "cand_name_has_noise_prefix"],
    "provenance": [*CHANNEL_FLAGS, "channels_fired_count", "blocking_priority_score", "blocking_rank_order"],
}
FEATURE_NAMES = [n for names in GROUPS.values() for n in names]


@dataclass(frozen=True)
class Feature:
    position: int
    name: str
    group: str
    dtype: str = "float"
    missing: float = 0.0


FEATURES = [Feature(i + 1, n, g) for i, (g, n) in enumerate((g, n) for g, names in GROUPS.items() for n in names)]
FEATURE_MAP = {f.name: f for f in FEATURES}


def feature_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f.position, f.name, f.group, f.dtype, f.missing) for f in FEATURES], "position int, name string, group string, dtype string, missing double")


_DIGITS = "".join(chr(base + i) for base in (0x0966, 0x09E6, 0x0A66, 0x0AE6, 0x0BE6, 0x0C66, 0x0660, 0x06F0) for i in range(10))


def _clean(c: Column) -> Column:
    return F.coalesce(nfkc(F.regexp_replace(c, R.STRIP, "")), F.lit(""))


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def described(df: DataFrame) -> DataFrame:
    """(id, ...): everything about a record that its pairs compare, in narrow form; null texts count as empty ones.

    Only equality of texts and of their parts is ever asked for, except of the plain name, so pairs carry 64-bit
    hashes (null for an empty text) and arrays of them in place of the texts.
    """
    base = df.select(F.col("entity_id").alias("id"), "country", _clean(F.col("business_name")).alias("n"), _clean(F.col("business_address")).alias("a"))
    n, a = F.col("n"), F.translate(F.col("a"), _DIGITS, "0123456789" * (len(_DIGITS) // 10))
    stop, business = (F.array(*[F.lit(w) for w in words]) for words in (ADDRESS_STOPWORDS, BUSINESS_WORDS))
    parts = base.select(
        "*", T.alnum(n).alias("n_alnum"), T.words(n, 2).alias("n_words"), F.lower(F.regexp_extract(n, R.LEGAL_UNICODE, 1)).alias("n_form"),
        F.filter(T.words(F.col("a"), 3), lambda w: ~F.array_contains(stop, w)).alias("a_words"), T.words(F.col("a"), 2).alias("a_all"),
    )
    known = lambda c: F.when(c != "", F.xxhash64(c))
    first, last = (lambda c: F.xxhash64(F.get(c, F.lit(0)))), (lambda c: F.xxhash64(F.try_element_at(c, F.lit(-1))))
    some = lambda c, v: F.when(F.size(c) > 0, v(F.col(c)))
    return parts.select(
        "id", known(F.col("country")).alias("country"), (n != "").alias("n_has"), (F.col("a") != "").alias("a_has"), "n_alnum",
        known(F.lower(n)).alias("n_low"), known(F.lower(T.stripped_legal(n))).alias("n_legal"), known(F.lower(T.stripped_domain(n))).alias("n_domain"),
        _hashed(T.trigrams(F.col("n_alnum"))).alias("n_grams"), _hashed(F.array_distinct("n_words")).alias("n_set"), F.size("n_words").alias("n_count"),
        some("n_words", first).alias("n_first"), some("n_words", last).alias("n_last"), _hashed(F.array_intersect("n_words", business)).alias("n_business"),
        n.rlike(R.LEGAL_UNICODE).alias("n_has_form"), known(F.col("n_form")).alias("n_form"), T.has_native(n).alias("n_native"), n.rlike(r"[^\x00-\x7F]").alias("n_beyond_ascii"),
        n.rlike(R.DOMAIN_UNICODE).alias("n_url"), n.rlike(R.PREFIX_UNICODE).alias("n_noise"),
        known(F.lower("a")).alias("a_low"), _hashed(F.array_distinct("a_words")).alias("a_set"), F.size("a_words").alias("a_count"),
        some("a_all", first).alias("a_first"), some("a_all", last).alias("a_last"), F.xxhash64(T.first_number(a)).alias("_number"), T.first_number(a).isNotNull().alias("_numbered"),
        _hashed(T.numbers(a)).alias("a_numbers"), _hashed(T.postal_codes(F.col("a"))).alias("a_postal"),
    ).withColumn("a_number", F.when(F.col("_numbered"), F.col("_number"))).drop("_number", "_numbered")


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("float")


def _sets(nx: Column, ny: Column, shared: Column) -> dict[str, Column]:
    """Comparisons of two sets of words by their sizes and what they share; 0 where one is empty."""
    held = lambda v: F.when((nx > 0) & (ny > 0), v).otherwise(F.lit(0.0)).cast("float")
    return {
        "jaccard": held(shared / (nx + ny - shared)), "overlap": held(shared / F.least(nx, ny)), "shared": held(shared),
        "left_in": held((shared == nx).cast("double")), "right_in": held((shared == ny).cast("double")),
    }


def pair_features(pairs: DataFrame, s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, 65 features) of pairs.

    An id that its table lacks has empty fields. Provenance columns of pairs are passed on where pairs has
    them (fired_chan_a tells) and are 0 otherwise.
    """
    left, right = (d.select(*[F.col(c).alias(f"{s}_{c}") for c in d.columns]) for s, d in (("l", described(s1)), ("r", described(candidates))))
    x = pairs.join(left, pairs["source1_entity_id"] == left["l_id"], "left").join(right, pairs["candidate_entity_id"] == right["r_id"], "left")
    defaults = {"boolean": F.lit(False), "array<bigint>": F.array().cast("array<bigint>"), "int": F.lit(0), "string": F.lit("")}
    x = x.withColumns({c: F.coalesce(c, defaults[k]) for c, k in x.dtypes if c[:2] in ("l_", "r_") and k in defaults})
    # What several features need is worked out once, in a step of its own.
    common = lambda c: F.size(F.array_intersect(f"l_{c}", f"r_{c}")).alias(f"both_{c}")
    x = x.select("*", *[common(c) for c in ("n_set", "a_set", "n_grams", "n_business", "a_numbers", "a_postal")])
    l, r = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))
    named, placed = l("n_has") & r("n_has"), l("a_has") & r("a_has")
    spelled = named & (l("n_alnum") != "") & (r("n_alnum") != "")
    when = lambda cond, v: F.when(cond, v).otherwise(F.lit(0.0)).cast("float")
    same = lambda c: l(c) == r(c)
    words, address = (_sets(F.size(l(c)), F.size(r(c)), F.col(f"both_{c}")) for c in ("n_set", "a_set"))
    shared_grams = F.col("both_n_grams")
    grams = shared_grams / (F.size(l("n_grams")) + F.size(r("n_grams")) - shared_grams)
    differ = spelled & (l("n_alnum") != r("n_alnum"))
    winkler = F.coalesce(jaro_winkler(F.when(differ, l("n_alnum")), F.when(differ, r("n_alnum"))), F.lit(1.0))
    lengths = F.length(l("n_alnum")), F.length(r("n_alnum"))
    form_l, form_r, native_l, native_r = l("n_has_form"), r("n_has_form"), l("n_native"), r("n_native")
    shared_numbers = F.col("both_a_numbers")
    both_postal = (F.size(l("a_postal")) > 0) & (F.size(r("a_postal")) > 0)
    shared_postal = F.col("both_a_postal") > 0
    out = {
        "country_exact_match": _flag(same("country")),
        "country_missing_either": _flag(l("country").isNull() | r("country").isNull()),
        "name_raw_exact": when(named, _flag(same("n_low"))),
        "name_legal_stripped_exact": when(named, _flag(same("n_legal"))),
        "name_domain_stripped_exact": when(named, _flag(same("n_domain"))),
        "name_alphanumeric_exact": when(spelled, _flag(same("n_alnum"))),
        "name_levenshtein_sim": when(spelled, F.when(~differ, 1.0).otherwise(T.similarity(l("n_alnum"), r("n_alnum")))),
        "name_jaro_winkler_sim": when(spelled, winkler),
        "name_char_3gram_jaccard": when(spelled, grams),
        "name_length_diff": when(spelled, F.abs(lengths[0] - lengths[1])),
        "name_length_ratio": when(spelled, F.least(*lengths) / F.greatest(*lengths)),
        "name_token_jaccard": when(named, words["jaccard"]),
        "name_token_overlap_coef": when(named, words["overlap"]),
        "name_token_containment_s1": when(named, words["left_in"]),
        "name_token_containment_cand": when(named, words["right_in"]),
        "name_shared_token_count": when(named, words["shared"]),
        "name_token_count_diff": when(named, F.abs(l("n_count") - r("n_count"))),
        "name_first_token_match": when(named, _flag(same("n_first"))),
        "name_last_token_match": when(named, _flag(same("n_last"))),
        "legal_suffix_agreement": when(named, _flag((~form_l & ~form_r) | (form_l & form_r & same("n_form")))),
        "legal_suffix_mismatch": when(named, _flag(form_l & form_r & ~same("n_form"))),
        "business_word_overlap_count": when(named, F.col("both_n_business")),
        "name_both_latin": when(named, _flag(~native_l & ~native_r)),
        "name_cross_script": when(named, _flag(native_l != native_r)),
        "name_has_non_ascii": when(named, _flag(l("n_beyond_ascii") | r("n_beyond_ascii"))),
        "name_missing_either": _flag(~named),
        "address_raw_exact": when(placed, _flag(same("a_low"))),
        "address_token_jaccard": when(placed, address["jaccard"]),
        "address_token_overlap_coef": when(placed, address["overlap"]),
        "address_shared_token_count": when(placed, address["shared"]),
        "address_token_containment": when(placed, F.greatest(address["left_in"], address["right_in"])),
        "address_token_count_diff": when(placed, F.abs(l("a_count") - r("a_count"))),
        "address_first_token_match": when(placed, _flag(same("a_first"))),
        "address_last_token_match": when(placed, _flag(same("a_last"))),
        "address_building_num_match": when(placed, _flag(same("a_number"))),
        "address_shared_numeric_count": when(placed, shared_numbers),
        "address_numeric_token_jaccard": when(placed & (shared_numbers > 0), shared_numbers / (F.size(l("a_numbers")) + F.size(r("a_numbers")) - shared_numbers)),
        "address_has_shared_numeric": when(placed, _flag(shared_numbers > 0)),
        "address_postal_exact_match": when(placed & both_postal, _flag(shared_postal)),
        "address_postal_both_present": when(placed, _flag(both_postal)),
        "address_postal_mismatch": when(placed & both_postal, _flag(~shared_postal)),
        "address_missing_s1": _flag(~l("a_has")),
        "address_missing_cand": _flag(~r("a_has")),
        "candidate_is_source2": _flag(F.col("candidate_entity_id").startswith("S2-")),
        "candidate_is_source3": _flag(F.col("candidate_entity_id").startswith("S3-")),
        "cand_name_has_url": _flag(r("n_url")),
        "cand_name_has_noise_prefix": _flag(r("n_noise")),
    } | provenance(pairs.columns)
    first = x.select("source1_entity_id", "candidate_entity_id", *[c.alias(n) for n, c in out.items()])
    return first.select("*", *[c.alias(n) for n, c in _interactions().items()]).select("source1_entity_id", "candidate_entity_id", *FEATURE_NAMES)


def provenance(columns: list[str]) -> dict[str, Column]:
    """Blocking provenance as features; 0 if the pairs carry none. A null or NaN takes the default."""
    if "fired_chan_a" not in columns:
        return {n: F.lit(0.0).cast("float") for n in GROUPS["provenance"]}
    take = lambda c, d: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(float(d))), F.lit(float(d))).cast("float") if c in columns else F.lit(0.0).cast("float")
    return {c: take(c, 0) for c in CHANNEL_FLAGS} | {"channels_fired_count": take("channels_fired", 1), "blocking_priority_score": take("total_priority", 0), "blocking_rank_order": take("rank_order", 1)}


def _interactions() -> dict[str, Column]:
    """Features that combine others, compared as floats."""
    c, f = F.col, lambda v: F.lit(v).cast("float")
    number, jaccard = c("address_building_num_match") == 1, c("address_token_jaccard")
    return {
        "exact_name_and_address_number_match": _flag((c("name_alphanumeric_exact") == 1) & number),
        "high_name_sim_and_address_overlap": _flag((c("name_levenshtein_sim") >= f(0.85)) & (jaccard >= f(0.30))),
        "shared_name_and_shared_number": _flag((c("name_shared_token_count") >= 1) & (c("address_has_shared_numeric") == 1)),
        "exact_postal_and_strong_name": _flag((c("address_postal_exact_match") == 1) & (c("name_token_jaccard") >= f(0.50))),
        "cross_script_and_strong_address": _flag((c("name_cross_script") == 1) & (number | (jaccard >= f(0.35)))),
        "weak_name_and_strong_address": _flag((c("name_token_jaccard") < f(0.20)) & number & (c("address_shared_token_count") >= 2)),
        "name_missing_and_strong_address": _flag((c("name_missing_either") == 1) & (jaccard >= f(0.50))),
    }


def attach_labels(df: DataFrame, truth: DataFrame) -> DataFrame:
    """df with match_label: 1 if its pair is among the true ones, else 0."""
    keys = ["source1_entity_id", "candidate_entity_id"]
    return df.join(truth.select(*keys, F.lit(1).alias("match_label")).distinct(), keys, "left").fillna(0, ["match_label"])


#: Hashes that may be ordered in one task; more are narrowed further by their next bits.
FEW = 10_000


def _last_of_first(hashes: DataFrame, k: int) -> tuple[int, str] | None:
    """(h, id) at position k (from 1) of the rows (h, id), h by its bits and then id in order; null if there are none.

    Each round counts the rows by the next 12 bits of h, so the driver sees 4,096 counts whatever the data, and
    keeps those that share the bits in which the position falls, until few are left.
    """
    if k < 1:
        return None
    bits, at = 64, hashes
    while bits > 0:
        step = min(12, bits)
        bits -= step
        cell = F.shiftrightunsigned("h", bits).bitwiseAND((1 << step) - 1)
        for c, n in sorted(tuple(r) for r in at.groupBy(cell.alias("c")).count().collect()):
            if k <= n:
                break
            k -= n
        at = at.where(cell == c)
        if n <= FEW:
            break
    unsigned = F.shiftrightunsigned("h", 1)
    return tuple(at.orderBy(unsigned, F.col("h").bitwiseAND(1), "id").limit(k).collect()[-1])


def split_groups(df: DataFrame, share: float = 0.2, seed: int = 42) -> DataFrame:
    """df with split_group: floor(n * share) of its n S1 records are `val`, all others `train`, whole records at a time.

    The records of smallest hash are `val`; the last of them is found from counts, and each row is then told by
    its own hash, without a join. A null id is a record as any other.
    """
    key = F.coalesce(F.col("source1_entity_id").cast("string"), F.lit(""))
    hash_of = F.xxhash64(key, F.lit(seed))
    ids = durable(df.select(key.alias("id")).distinct().select(F.xxhash64("id", F.lit(seed)).alias("h"), "id"))
    last = _last_of_first(ids, int(ids.count() * share))
    release(ids)
    if last is None:
        return df.withColumn("split_group", F.lit("train"))
    halves = lambda h: (F.shiftrightunsigned(h, 1), h.bitwiseAND(1))
    mine, bound = F.struct(*halves(hash_of), key), F.struct(*halves(F.lit(last[0])), F.lit(last[1]))
    return df.withColumn("split_group", F.when(mine <= bound, "val").otherwise("train"))
