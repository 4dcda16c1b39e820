import pytest

from linkspan.operators.features import FEATURE_NAMES
from linkspan.operators.model import MatchModel
from linkspan.plans.pipeline import Settings, match, run
from linkspan.plans.queries_linkage import _training, pool
from linkspan.sources import tsv
from linkspan.sources.tables import records


@pytest.fixture(scope="module")
def training(spark):
    return _training(spark, "/root/testdata/sf0.01").cache()


@pytest.mark.parametrize("kind,params", [("logistic_regression", {"maxIter": 50}), ("xgboost", {"maxIter": 5}), ("xgboost_weighted", {"maxIter": 5, "positive_weight": 3}), ("random_forest", {"numTrees": 10, "maxDepth": 4})])
def test_models(spark, training, kind, params, tmp_path):
    model = MatchModel(kind, params)
    with pytest.raises(RuntimeError):
        model.predict(training)
    got = model.fit(training, training if kind == "xgboost" else None).predict(training).select("match_label", "score", "is_match").collect()
    assert sum(r["match_label"] == r["is_match"] for r in got) > 0.8 * len(got) and all(0 <= r["score"] <= 1 for r in got)
    assert model.importances(spark).count() == 65
    model.save(spark, str(tmp_path / "m"))
    again = MatchModel.load(spark, str(tmp_path / "m")).predict(training).select("score").collect()
    assert sorted(r["score"] for r in again) == pytest.approx(sorted(r["score"] for r in got))


def test_model_errors(training):
    with pytest.raises(ValueError):
        MatchModel("svm")
    with pytest.raises(ValueError):
        MatchModel("logistic_regression").fit(training.drop(FEATURE_NAMES[0]))
    with pytest.raises(ValueError):
        MatchModel("logistic_regression").calibrate(training, "other")


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibration(training, method):
    model = MatchModel("logistic_regression", {"maxIter": 20}).fit(training).calibrate(training, method)
    assert all(0 <= r["score"] <= 1 for r in model.predict_proba(training).select("score").collect())


def test_end_to_end(spark, training, tmp_path):
    d = "/root/testdata/sf0.001"
    model = MatchModel("logistic_regression", {"maxIter": 50}).fit(training)
    s1, cand = records(spark, d, "test_source1"), pool(spark, d)
    conf = Settings(threshold=0.5, cap=20)
    matches, pairs = match(s1, cand, model, conf)
    assert conf.statistics["total_candidates"] == pairs.count() and conf.statistics["most_per_record"] <= 20
    got = matches.collect()
    assert got and len({r["candidate_entity_id"] for r in got}) == len(got)
    known = {tuple(r) for r in pairs.select("source1_entity_id", "candidate_entity_id").collect()}
    assert all((r["source1_entity_id"], r["candidate_entity_id"]) in known for r in got)
    assert pairs.groupBy("source1_entity_id").count().agg({"count": "max"}).first()[0] <= 20
    data = tmp_path / "data"
    flat = lambda df: df.selectExpr("entity_id", *[f"regexp_replace({c}, '[\\\\t\\\\n\\\\r]', ' ') as {c}" for c in ("business_name", "business_address", "country")])
    for name in ("test_source1", "test_source2", "test_source3"):
        tsv.write_tsv(flat(records(spark, d, name)), str(data / f"{name}.tsv"))
    model.save(spark, str(tmp_path / "m"))
    run(spark, str(data), str(tmp_path / "out"), str(tmp_path / "m"), Settings(threshold=0.5, cap=20, limit=30))
    lists = spark.read.csv(str(tmp_path / "out" / "matching_results.tsv"), sep="\t", header=True)
    assert lists.count() == 30 and lists.columns == ["source1_entity_id", "matched_entity_ids"]
    reloaded, _ = match(s1, cand, model, Settings(threshold=0.5, candidate_file=str(tmp_path / "out" / "candidate_pairs.tsv")))
    assert reloaded.count() > 0


def test_isotonic_curve_keeps_every_boundary(spark):
    df = spark.range(1, 1001).selectExpr("id / 1000 as s", "pow(id / 1000, 2) as match_label")
    model = MatchModel()
    model._scored = lambda df: df.withColumn("score", df["s"])
    model.calibrate(df, "isotonic")
    assert len(model.calibration["x"]) == 1000
    got = {r["s"]: r["score"] for r in model.predict_proba(df).collect()}
    assert got == pytest.approx({s: s * s for s in got}, abs=1e-9) and got[1.0] == 1.0
    beyond = spark.createDataFrame([(0.0, 0.0), (2.0, 0.0), (0.9995, 0.0)], "s double, match_label double")
    assert sorted(r["score"] for r in model.predict_proba(beyond).collect()) == pytest.approx([1e-6, (0.998001 + 1) / 2, 1.0])
