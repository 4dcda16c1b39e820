import pytest

from linkspan.operators.validate import CANDIDATE_HEADER, check_file, findings, outside
from linkspan.plans.durable import durable, shared_dir
from linkspan.plans.skew import n_salts, salts_by_slot
from linkspan.sources import tsv

KIND = "entity_id string, business_name string, business_address string, country string"


def test_tsv_keeps_quotes_and_blanks(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"Foo" \\ Bar\t\tX\nS1-2\tNULL\ta "b"\t\n')
    got = sorted(map(tuple, tsv.read_source(spark, str(p)).collect()))
    assert got == [("S1-1", '"Foo" \\ Bar', None, "X"), ("S1-2", "NULL", 'a "b"', None)]
    spark.createDataFrame(got, KIND).createOrReplaceTempView("src")
    assert tsv.read_source(spark, "src").count() == 2 and tsv.limited(tsv.read_source(spark, "src"), 1).first()["entity_id"] == "S1-1"
    assert tsv.first_existing(spark, [str(tmp_path / "no"), str(p)]) == str(p) and tsv.first_existing(spark, ["no", "none"]) == "no"


def test_lists_round_trip(spark, tmp_path):
    s1 = spark.createDataFrame([("S1-1", "", "", ""), ("S1-2", "", "", "")], KIND)
    pairs = spark.createDataFrame([("S1-1", "S2-2"), ("S1-1", "S2-1"), ("S1-1", "S2-1"), ("S1-9", "S2-3")], "source1_entity_id string, candidate_entity_id string")
    lists = tsv.as_lists(pairs, s1, "candidate_entity_ids")
    assert sorted(map(tuple, lists.collect())) == [("S1-1", "S2-1,S2-2"), ("S1-2", "")]
    out = str(tmp_path / "o")
    tsv.write_tsv(lists, out)
    back = tsv.read_lists(spark, out, s1)
    assert sorted((r[0], r[1], r["total_priority"], r["fired_chan_a"], r["fired_chan_g"]) for r in back.collect()) == [("S1-1", "S2-1", 100.0, 1, 0), ("S1-1", "S2-2", 100.0, 1, 0)]


def test_valid_pairs(spark):
    s1 = spark.createDataFrame([("S1-1", None, None, "X"), ("S1-2", None, None, None)], KIND)
    cand = spark.createDataFrame([("S2-1", None, None, "X"), ("S3-1", None, None, "Y"), ("S1-1", None, None, "X")], KIND)
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-1"), ("S1-1", "S1-1"), ("S1-1", "S2-7")], "source1_entity_id string, candidate_entity_id string")
    assert [tuple(r) for r in tsv.valid_pairs(pairs, s1, cand).collect()] == [("S1-1", "S2-1")]
    assert tsv.pruned(cand, pairs).count() == 3


def test_findings(spark):
    lists = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", ""), ("S1-2", "S1-5,X,S2-8"), ("S1-7", None)], "source1_entity_id string, ids string")
    need, known = (spark.createDataFrame([(x,) for x in v], "entity_id string") for v in (["S1-1", "S1-2", "S1-3"], ["S2-1"]))
    got = sorted((r["rule"], r["source1_entity_id"], r["value"]) for r in findings(lists, need, known).collect())
    assert got == [("duplicate_row", "S1-1", None), ("missing_record", "S1-3", None), ("repeated_id", "S1-1", None), ("self_match", "S1-2", "S1-5"), ("unexpected_record", "S1-7", None), ("unknown_id", "S1-2", "S2-8"), ("wrong_prefix", "S1-2", "X")]
    pairs = lambda v: spark.createDataFrame(v, "source1_entity_id string, candidate_entity_id string")
    assert [tuple(r) for r in outside(pairs([("a", "1"), ("a", "2")]), pairs([("a", "1")])).collect()] == [("a", "2")]


@pytest.mark.parametrize("text,said", [("", "is empty"), ("a,b\n", "tab-separated"), ("a\tb\n", "unexpected header"), ("source1_entity_id\tcandidate_entity_ids\nS1-1\t\n", None), ("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nrubbish\n", "malformed"), ("source1_entity_id\tcandidate_entity_ids\nS1-1\tS1-1\n", "reference source")])
def test_check_file(spark, tmp_path, text, said):
    p = tmp_path / "f.tsv"
    p.write_text(text)
    got = check_file(spark, str(p), CANDIDATE_HEADER, spark.createDataFrame([("S1-1",)], "entity_id string"))
    assert (got == []) if said is None else any(said in x for x in got)
    assert "not found" in check_file(spark, str(tmp_path / "none"), CANDIDATE_HEADER, spark.createDataFrame([("S1-1",)], "entity_id string"))[0]


def test_durable_and_salts(spark):
    df = durable(spark.range(100).selectExpr("id % 2 = 0 as k", "id"))
    assert df.count() == 100 and shared_dir(spark)
    hot = spark.range(1000).selectExpr("if(id < 900, 'hot', cast(id as string)) as k")
    from pyspark.sql import functions as F

    salts = salts_by_slot(hot, F.col("k"), min_rows=100)
    assert list(salts.values()) == [9]
    assert hot.select(n_salts(F.col("k"), salts).alias("n")).distinct().count() == 2


def test_validator_command(spark, tmp_path, capsys):
    from linkspan.operators.validate import main

    data = tmp_path / "d"
    data.mkdir()
    for i in (1, 2, 3):
        (data / f"test_source{i}.tsv").write_text(f"entity_id\tbusiness_name\tbusiness_address\tcountry\nS{i}-1\ta\tb\tc\n")
    good = tmp_path / "m.tsv"
    good.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\n")
    args = ["--matching", str(good), "--candidates", str(tmp_path / "none"), "--test-dir", str(data)]
    assert main(args) == 0 and main([*args, "--check-ids"]) == 0
    good.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-9\n")
    assert main(args) == 0 and main([*args, "--check-ids"]) == 1
    assert "neither candidate source" in capsys.readouterr().out


def test_ids_of_both_candidate_sources_are_known(spark, tmp_path):
    from linkspan.plans.queries_linkage import QUERIES

    for i, ids in ((1, ["S1-1", "S1-2"]), (2, ["S2-1"]), (3, ["S3-1"])):
        spark.createDataFrame([(x, "a", "b", "c") for x in ids], KIND).write.parquet(str(tmp_path / f"test_source{i}.parquet"))
    pairs = [("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S3-1"), ("S1-2", "S2-9"), ("S1-2", "S3-9")]
    spark.createDataFrame(pairs, "source1_entity_id string, candidate_entity_id string").write.parquet(str(tmp_path / "candidate_pairs.parquet"))
    got = sorted(map(tuple, QUERIES["validate_findings"](spark, str(tmp_path)).collect()))
    assert got == [("unknown_id", "S1-2", "S2-9"), ("unknown_id", "S1-2", "S3-9")]


def test_tsv_keeps_blanks_at_the_ends(spark, tmp_path):
    tsv.write_tsv(spark.createDataFrame([("S1-1", " a ", None, "X")], KIND), str(tmp_path / "t"))
    assert tuple(tsv.read_source(spark, str(tmp_path / "t") + "/*.csv").first()) == ("S1-1", " a ", None, "X")


def test_check_file_reports(spark, tmp_path):
    from linkspan.operators.validate import MATCHING_HEADER, subset_warning

    need = spark.createDataFrame([(f"S1-{i}",) for i in range(9)], "entity_id string")
    p = tmp_path / "m.tsv"
    p.write_text("source1_entity_id\tmatched_entity_ids\nS1-0\tS2-1,S2-2\n")
    assert check_file(spark, str(p), MATCHING_HEADER, need) == [f"{p}: required record without a row: 8 total, e.g. S1-1, S1-2, S1-3, S1-4, S1-5"]
    c = tmp_path / "c.tsv"
    c.write_text("source1_entity_id\tcandidate_entity_ids\nS1-0\tS2-1\n")
    assert subset_warning(spark, str(p), str(c)) == "1 records have matched ids that are no candidates, e.g. S1-0" and subset_warning(spark, str(c), str(p)) is None
    p.write_bytes("source1_entity_id\tmatched_entity_ids\nS1-0\tS2-é\n".encode("latin-1"))
    assert "UTF-8" in check_file(spark, str(p), MATCHING_HEADER, need)[0]


def test_package(tmp_path):
    import zipfile

    from linkspan.sources.package import package

    (tmp_path / "out" / "__pycache__").mkdir(parents=True)
    for f in ("a.tsv", ".hidden", "__pycache__/x.pyc"):
        (tmp_path / "out" / f).write_text("x")
    z = str(tmp_path / "z.zip")
    assert package(z, {str(tmp_path / "out"): "output"}) == ["output/a.tsv"] == zipfile.ZipFile(z).namelist()
    with pytest.raises(FileNotFoundError):
        package(z, {str(tmp_path / "no"): "x"})


def test_shared_folder_is_asked_for_on_a_cluster():
    class Fake:
        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(dict)
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda k, d: d)

    with pytest.raises(ValueError):
        shared_dir(Fake)
