import pytest

from linkspan.operators.blocking import Blocking, channel_pairs, combine, generate_candidates

KIND = "entity_id string, business_name string, business_address string, country string"


def pairs(spark, channel, s1, cand, **kw):
    a, b = spark.createDataFrame(s1, KIND), spark.createDataFrame(cand, KIND)
    got = channel_pairs(a, b, Blocking(channels=[channel], **kw))[channel]
    return sorted((r["s1_id"], r["candidate_id"], r["priority_score"]) for r in got.collect())


def test_core_name(spark):
    s1 = [("S1-1", "Foo Bar Pvt. Ltd.", None, "X"), ("S1-2", "caféco", None, "X"), ("S1-3", None, None, "X"), ("S1-4", "  ", None, "X")]
    cand = [("S2-1", "FOO-BAR", "a", "X"), ("S2-2", "foobar", "a", "Y"), ("S2-3", "caf", "a", "X"), ("S2-4", "foo bar llc", None, None)]
    assert pairs(spark, "a", s1, cand) == [("S1-1", "S2-1", 100), ("S1-2", "S2-3", 100)]


def test_prefix_and_short_keys(spark):
    s1 = [("S1-1", "M/s Foobar", None, "X"), ("S1-2", "ab", None, "X")]
    cand = [("S2-1", "The Foobar Ltd", None, "X"), ("S2-2", "ab", None, "X")]
    assert pairs(spark, "a", s1, cand) == []
    assert pairs(spark, "a2", s1, cand) == [("S1-1", "S2-1", 95)]


def test_shared_tokens_multiply(spark):
    s1 = [("S1-1", "alpha bravo charlie", None, "X")]
    cand = [("S2-1", "alpha bravo charlie", None, "X"), ("S2-2", "alpha bravo charlie", None, "X")]
    got = pairs(spark, "b", s1, cand)
    assert got == [("S1-1", "S2-1", 80)] * 3 + [("S1-1", "S2-2", 80)] * 3
    table = generate_candidates(spark.createDataFrame(s1, KIND), spark.createDataFrame(cand, KIND), Blocking(channels=["b"])).collect()
    assert [(r["total_priority"], r["channels_fired"], r["rank_order"]) for r in table] == [(240.0, 1, 1), (240.0, 1, 2)]


@pytest.mark.parametrize("n,found", [(1, 0), (2, 2), (100, 50), (101, 0)])
def test_rare_bounds_and_cap(spark, n, found):
    cand = [(f"S2-{i:03d}", "unusual", None, "X") for i in range(n)]
    assert len(pairs(spark, "b", [("S1-1", "unusual thing", None, "X")], cand)) == found


def test_numbers(spark):
    s1 = [("S1-1", "Gnni foods", "0012345678 Main", "X"), ("S1-2", "zzz", "000 Main", "X")]
    cand = [("S2-1", "GNN", "1234", "X"), ("S2-2", "gnn", "12 Main", "X"), ("S2-3", "zzz", "0", "X")]
    assert pairs(spark, "e", s1, cand) == [("S1-1", "S2-1", 75)]


def test_typo_in_first_letter_and_ends(spark):
    s1 = [("S1-1", "6nnifoods", None, "X")]
    cand = [("S2-1", "Gnnifoods", None, "X"), ("S2-2", "Xnnifoods", None, "X")]
    assert [p[1] for p in pairs(spark, "g", s1, cand)] == ["S2-1", "S2-2"]
    assert pairs(spark, "c", [("S1-1", "alphabet soup", None, "X")], [("S2-1", "alpha group soup", None, "X")]) == []
    assert [p[1] for p in pairs(spark, "c", [("S1-1", "alphabet soup", None, "X")], [("S2-1", "alpha group soup", None, "X"), ("S2-2", "alpha big soup", None, "X")])] == ["S2-1", "S2-2"]


def test_anchor(spark):
    s1 = [("S1-1", None, "12 Harrowgate Street", "O'Land")]
    cand = [("S3-1", None, "No 012 harrowgate", "O'Land"), ("S3-2", None, "13 Harrowgate", "O'Land")]
    assert pairs(spark, "e2", s1, cand) == [("S1-1", "S3-1", 85)]
    assert len(pairs(spark, "d", s1, cand)) == 2


def test_no_country_at_all(spark):
    s1, cand = [("S1-1", "foobar", None, None)], [("S2-1", "Foobar", None, "X"), ("S2-2", "foobar", None, None)]
    assert len(pairs(spark, "a", s1, cand)) == 2


def test_cap_and_order(spark):
    a = spark.createDataFrame([("S1-1", "S2-2", 100), ("S1-1", "S2-1", 100), ("S1-1", "S2-3", 100)], "s1_id string, candidate_id string, priority_score int")
    b = spark.createDataFrame([("S1-1", "S2-3", 40)], "s1_id string, candidate_id string, priority_score int")
    got = combine({"a": a, "c": b}, 2).orderBy("rank_order").collect()
    assert [(r["candidate_entity_id"], r["total_priority"], r["fired_chan_c"]) for r in got] == [("S2-3", 140.0, 1), ("S2-1", 100.0, 0)]


def test_empty(spark):
    e = spark.createDataFrame([], KIND)
    assert generate_candidates(e, e).count() == 0
