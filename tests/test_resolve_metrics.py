import math

import pytest

from linkspan.operators.metrics import confusion, entity_metrics, evaluate, macro, macro_by_group, ranking
from linkspan.operators.resolve import affinity, resolve

KIND = "entity_id string, business_name string, business_address string, country string"
PAIR = "source1_entity_id string, candidate_entity_id string"


def test_affinity(spark):
    s1 = spark.createDataFrame([("S1-1", "Foo", "12 Rue Vert Bleu", "X"), ("S1-2", None, None, "X")], KIND)
    cand = spark.createDataFrame([("S2-1", "foo", "0012 vert", "X"), ("S2-2", None, "13 rouge", "X")], KIND)
    got = {(r[0], r[1]): r["affinity"] for r in affinity(spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S2-2"), ("S1-9", "S2-2")], PAIR), s1, cand).collect()}
    assert got[("S1-1", "S2-1")] == pytest.approx(1 + 1 + 0.5)
    assert got[("S1-1", "S2-2")] == pytest.approx((1 - 3 / 4) - 1 - 0.5)
    assert got[("S1-2", "S2-2")] == 1.0  # two stored nulls read alike
    assert got[("S1-9", "S2-2")] == 0.0


def test_contest(spark):
    s1 = spark.createDataFrame([("S1-1", "Foo", "1 Elm", "X"), ("S1-2", "Foo", "1 Elm", "X"), ("S1-3", "Zzz", "9 Oak", "X")], KIND)
    cand = spark.createDataFrame([("S2-1", "Foo", "1 Elm", "X"), ("S2-2", "Qqqq", "5 Ash", "X"), ("S2-3", "a", "b", "X")], KIND)
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-1"), ("S1-1", "S2-2"), ("S1-3", "S2-2"), ("S1-3", "S2-3")], PAIR)
    assert sorted(map(tuple, resolve(pairs, s1, cand).collect())) == [("S1-1", "S2-1"), ("S1-3", "S2-3")]


def test_cap_only_with_contest(spark):
    e = spark.createDataFrame([], KIND)
    pairs = spark.createDataFrame([("S1-1", f"S2-{i:02d}") for i in range(10)], PAIR)
    assert resolve(pairs, e, e).count() == 10
    assert resolve(pairs, e, e, strict_cap=True).count() == 8
    assert resolve(pairs.limit(0), e, e).count() == 0


def test_entity_metrics(spark):
    spine = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",), ("a",)], "source1_entity_id string")
    pred = spark.createDataFrame([("b", "1"), ("d", "1"), ("d", "2"), ("e", "9"), ("zz", "1"), ("d", "1")], PAIR)
    true = spark.createDataFrame([("c", "1"), ("d", "1"), ("d", "3"), ("e", "8")], PAIR)
    m = entity_metrics(spine, pred, true)
    got = {r["source1_entity_id"]: (r["precision"], r["recall"], round(r["f05"], 6)) for r in m.collect()}
    assert got == {"a": (1, 1, 1), "b": (0, 0, 0), "c": (0, 0, 0), "d": (0.5, 0.5, 0.5), "e": (0, 0, 0)}
    one = macro(m).first()
    assert one["total_s1"] == 5 and one["macro_f05"] == pytest.approx(0.3) and one["empty_pred_pct"] == 40 and one["total_pred_matches"] == 4
    groups = {r["bucket"]: r for r in macro_by_group(m).collect()}
    assert groups["group2_zero_match"]["false_positive_rate"] == 50 and groups["group1_singleton"]["count"] == 2 and groups["group3_multi_match"]["false_positive_rate"] == 50
    assert macro(m.limit(0)).first()["macro_f05"] == 0
    scored = spark.createDataFrame([("d", "1", 0.9), ("d", "2", 0.1)], PAIR + ", score double")
    assert evaluate(scored, true, 0.5).first()["total_pred_matches"] == 1


def test_pair_metrics(spark):
    data = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.2), (0, 0.0)]
    df = spark.createDataFrame(data, "label int, score double")
    c = confusion(df, 0.5).first()
    assert (c["tp"], c["fp"], c["fn"], c["tn"]) == (2, 1, 1, 2)
    q = [min(max(s, 1e-7), 1 - 1e-7) for _, s in data]
    assert c["log_loss"] == pytest.approx(sum(-math.log(x if y else 1 - x) for (y, _), x in zip(data, q)) / 6)
    wins = sum((p > n) + 0.5 * (p == n) for y, p in data if y for z, n in data if not z)
    r = ranking(df).first()
    assert r["roc_auc"] == pytest.approx(wins / 9) and r["pr_auc"] == pytest.approx((1 + 2 / 3 + 3 / 4) / 3)
    assert tuple(ranking(df.where("label = 1")).first()) == (0.0, 0.0)


@pytest.mark.parametrize("partitions", [2, 7, 40])
def test_ranking_of_many_scores(spark, partitions):
    """The ranges of scores are the same for totals and rows, however adaptive execution merges them."""
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(60_000).selectExpr("pmod(xxhash64(id), 50000) / 50000.0 as score", "cast(pmod(xxhash64(id, 1), 3) = 0 as int) as label")
        rows = sorted(((float(r["score"]), r["label"]) for r in df.collect()), reverse=True)
        got = ranking(df).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    by: dict = {}
    for s, y in rows:
        p, n = by.get(s, (0, 0))
        by[s] = (p + y, n + 1 - y)
    tp = fp = wins = ap = 0
    for p, n in by.values():
        tp, fp = tp + p, fp + n
        wins += n * (tp - p / 2)
        ap += p * tp / (tp + fp)
    assert got["roc_auc"] == pytest.approx(wins / (tp * fp), abs=1e-9) and got["pr_auc"] == pytest.approx(ap / tp, abs=1e-9)
