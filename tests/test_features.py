import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from linkspan.functions.udfs import jaro_winkler_pair
from linkspan.operators.features import ADDRESS_STOPWORDS, BUSINESS_WORDS, FEATURE_NAMES, attach_labels, feature_catalog, pair_features, split_groups
from linkspan.operators.features import FEATURES, GROUPS

KIND = "entity_id string, business_name string, business_address string, country string"
NAMES = ["Foo Bar Pvt Ltd", "FOO BAR", None, " ", "फू बार लिमिटेड", "Café Services LLC", "cafe services llc", "The Global Energy Group", "www.foo.com", "a", "Ａcme Inc", "foo_bar co", "Foo Bar Limited"]
ADDRESSES = ["12 Main Street, Foo 560001", "012 main st foo 560001", None, "", "308C Main Rd 12345", "१२ मार्ग", "Near Block 7, Nagar 560002", "12 Main Street, Foo 560001, 77"]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, prev = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
    return row[-1]


def expected(s, c):
    """A few features of a pair, spelled out one by one."""
    clean = lambda x: unicodedata.normalize("NFKC", x.strip()) if x else ""
    alnum = lambda x: re.sub(r"[\W_]+", "", x.lower())
    toks = lambda x, n, stop=(): [t for t in re.split(r"\W+", x.lower()) if len(t) >= n and t not in stop]
    grams = lambda x: {x} - {""} if len(x) < 3 else {f"^{x}$"[i : i + 3] for i in range(len(x))}
    out = dict.fromkeys(FEATURE_NAMES, 0.0)
    a, b = clean(s[1]), clean(c[1])
    x, y = alnum(a), alnum(b)
    out["name_missing_either"] = float(not a or not b)
    if a and b:
        out["name_raw_exact"] = float(a.lower() == b.lower())
        out["name_alphanumeric_exact"] = float(bool(x) and x == y)
        if x and y:
            out["name_levenshtein_sim"] = 1 - levenshtein(x, y) / max(len(x), len(y))
            out["name_jaro_winkler_sim"] = jaro_winkler_pair(x, y)
            out["name_char_3gram_jaccard"] = len(grams(x) & grams(y)) / len(grams(x) | grams(y))
            out["name_length_diff"] = abs(len(x) - len(y))
            out["name_length_ratio"] = min(len(x), len(y)) / max(len(x), len(y))
        t, u = toks(a, 2), toks(b, 2)
        if t and u:
            st, su = set(t), set(u)
            out["name_token_jaccard"] = len(st & su) / len(st | su)
            out["name_token_overlap_coef"] = len(st & su) / min(len(st), len(su))
            out["name_shared_token_count"] = len(st & su)
            out["name_token_containment_s1"], out["name_token_containment_cand"] = float(st <= su), float(su <= st)
            out["name_first_token_match"], out["name_last_token_match"] = float(t[0] == u[0]), float(t[-1] == u[-1])
        out["name_token_count_diff"] = abs(len(t) - len(u))
        out["business_word_overlap_count"] = len(set(t) & set(u) & set(BUSINESS_WORDS))
        nat = [any(ord(z) >= 0x600 for z in w) for w in (a, b)]
        out["name_both_latin"], out["name_cross_script"] = float(not any(nat)), float(nat[0] != nat[1])
        out["name_has_non_ascii"] = float(not a.isascii() or not b.isascii())
    p, q = clean(s[2]), clean(c[2])
    out["address_missing_s1"], out["address_missing_cand"] = float(not p), float(not q)
    if p and q:
        t, u = set(toks(p, 3, ADDRESS_STOPWORDS)), set(toks(q, 3, ADDRESS_STOPWORDS))
        if t and u:
            out["address_token_jaccard"], out["address_shared_token_count"] = len(t & u) / len(t | u), len(t & u)
            out["address_token_containment"] = float(t <= u or u <= t)
        m, n = ([str(int(v)) for v in re.findall(r"\b\d+\b", w)] for w in (p, q))
        out["address_building_num_match"] = float(bool(m) and bool(n) and m[0] == n[0])
        out["address_shared_numeric_count"] = len(set(m) & set(n))
        out["address_numeric_token_jaccard"] = len(set(m) & set(n)) / len(set(m) | set(n)) if m or n else 0.0
        m, n = (set(re.findall(r"\b\d{5,6}\b", w)) for w in (p, q))
        out["address_postal_both_present"] = float(bool(m and n))
        out["address_postal_exact_match"], out["address_postal_mismatch"] = float(bool(m & n)), float(bool(m and n and not m & n))
    return out


CHECKED = [k for k in FEATURE_NAMES if k.startswith(("name_", "address_", "business_")) and k not in ("name_legal_stripped_exact", "name_domain_stripped_exact", "address_raw_exact", "address_token_overlap_coef", "address_token_count_diff", "address_first_token_match", "address_last_token_match", "address_has_shared_numeric", "name_missing_and_strong_address")]


def test_against_spelled_out(spark):
    s1 = [(f"S1-{i}", n, ADDRESSES[i % len(ADDRESSES)], "X") for i, n in enumerate(NAMES)]
    cand = [(f"S2-{i}", n, ADDRESSES[(i * 3 + 1) % len(ADDRESSES)], "Y") for i, n in enumerate(NAMES)]
    pairs = [(a[0], b[0]) for a in s1 for b in cand]
    got = pair_features(spark.createDataFrame(pairs, "source1_entity_id string, candidate_entity_id string"), spark.createDataFrame(s1, KIND), spark.createDataFrame(cand, KIND)).collect()
    left, right = {r[0]: r for r in s1}, {r[0]: r for r in cand}
    assert len(got) == len(pairs)
    for r in got:
        want = expected(left[r["source1_entity_id"]], right[r["candidate_entity_id"]])
        for k in CHECKED:
            assert r[k] == pytest.approx(want[k], abs=1e-6), (k, left[r["source1_entity_id"]], right[r["candidate_entity_id"]])


def test_legal_forms_sources_and_interactions(spark):
    s1 = spark.createDataFrame([("S1-1", "Foo Ltd", "12 Harrow Way", "X")], KIND)
    cand = spark.createDataFrame([("S2-1", "foo LTD", "12 Harrow Way", "X"), ("S3-1", "The Foo.com Inc", None, None), ("S3-2", "फू", "12 Harrow Way", "X")], KIND)
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-1", "S3-2"), ("S1-1", "S9-9")], "source1_entity_id string, candidate_entity_id string")
    got = {r["candidate_entity_id"]: r for r in pair_features(pairs, s1, cand).collect()}
    assert got["S2-1"]["legal_suffix_agreement"] == 1 and got["S2-1"]["name_legal_stripped_exact"] == 1 and got["S2-1"]["exact_name_and_address_number_match"] == 1
    assert got["S3-1"]["legal_suffix_mismatch"] == 1 and got["S3-1"]["cand_name_has_url"] == 1 and got["S3-1"]["cand_name_has_noise_prefix"] == 1 and got["S3-1"]["country_missing_either"] == 1
    assert got["S3-2"]["cross_script_and_strong_address"] == 1 and got["S3-2"]["candidate_is_source3"] == 1
    assert got["S9-9"]["name_missing_either"] == 1 and got["S9-9"]["fired_chan_a"] == 0


def test_catalog():
    assert len(FEATURE_NAMES) == len(set(FEATURE_NAMES)) == 65 and [len(v) for v in GROUPS.values()] == [2, 24, 17, 7, 4, 11] and FEATURES[64].name == "blocking_rank_order"


def test_provenance_labels_and_split(spark):
    e = spark.createDataFrame([], KIND)
    pairs = spark.createDataFrame([("S1-1", "S2-1", None, 3.0)], "source1_entity_id string, candidate_entity_id string, fired_chan_a long, total_priority double")
    r = pair_features(pairs, e, e).first()
    assert (r["fired_chan_a"], r["blocking_priority_score"], r["channels_fired_count"]) == (0, 3, 0)
    truth = spark.createDataFrame([("S1-1", "S2-1")] * 2, "source1_entity_id string, candidate_entity_id string")
    assert attach_labels(pairs, truth).first()["match_label"] == 1
    many = spark.createDataFrame([(f"S1-{i % 11}", f"S2-{i}") for i in range(50)], "source1_entity_id string, candidate_entity_id string")
    s = split_groups(many).collect()
    groups = {}
    for r in s:
        groups.setdefault(r["source1_entity_id"], set()).add(r["split_group"])
    assert all(len(g) == 1 for g in groups.values()) and sum(g == {"val"} for g in groups.values()) == 2
    assert feature_catalog(spark).count() == 65


def test_split_groups_finds_the_exact_count(spark, monkeypatch):
    from linkspan.operators import features

    monkeypatch.setattr(features, "FEW", 3)  # narrow by bits down to three
    df = spark.range(5000).selectExpr("concat('S1-', pmod(id, 1234)) as source1_entity_id")
    for share, n in ((0.0, 0), (0.2, 246), (0.5, 617), (1.0, 1234)):
        got = split_groups(df, share).groupBy("split_group").agg(F.countDistinct("source1_entity_id").alias("n"), F.count("*").alias("rows")).collect()
        assert {r["split_group"]: r["n"] for r in got}.get("val", 0) == n and sum(r["rows"] for r in got) == 5000


def test_jaro_winkler_side_by_side():
    import random

    import pandas as pd

    from linkspan.functions.udfs import jaro_winkler

    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdé𝒳") for _ in range(n))
    pairs = [(word(rng.randrange(40)), word(rng.randrange(40))) for _ in range(500)]
    pairs += [(a, a[: len(a) // 2] + "x" + a[len(a) // 2 :]) for a, _ in pairs] + [(None, "a"), ("", ""), ("", "a"), ("a" * 300, "a" * 200 + "b"), ("same", "same")]
    got = jaro_winkler.func(pd.Series([a for a, _ in pairs], dtype=object), pd.Series([b for _, b in pairs], dtype=object))
    want = [None if a is None else jaro_winkler_pair(a, b) for a, b in pairs]
    assert [None if g is None or g != g else round(g, 12) for g in got] == [None if w is None else round(w, 12) for w in want]
