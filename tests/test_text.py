import pytest
from pyspark.sql import functions as F

from linkspan.functions import normalise as N
from linkspan.functions import regexes as R
from linkspan.functions import text as T
from linkspan.functions.udfs import ascii_only, jaro_winkler_pair, nfkc


def col(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text,left", [("foo co", "foo"), ("foo co\n", "foo"), ("caféco", "café"), ("foo, (pvt ltd)", "foo"), ("acme", "acme"), ("x प्रा. लि.", "x")])
def test_legal_as_re2(spark, text, left):
    assert col(spark, text, lambda c: F.regexp_replace(c, R.LEGAL_ASCII, "")) == left


@pytest.mark.parametrize("text,left", [("Foo CO\n", "Foo"), ("caféco", "caféco"), ("Foo Limited Liability Company", "Foo"), ("Foo Co Ltd", "Foo Co"), ("लिमिटेड", "")])
def test_legal_as_python(spark, text, left):
    assert col(spark, text, T.stripped_legal) == left


def test_words_split_combining_marks(spark):
    assert col(spark, "लिमिटेड", T.words) == ["ल", "म", "ट", "ड"]
    assert col(spark, "a_b C-d", T.words) == ["a_b", "c", "d"]


def test_numbers(spark):
    assert col(spark, "007 0 12 12 308C", T.numbers) == ["7", "0", "12"]
    assert col(spark, "308C Main", T.first_number) is None
    assert col(spark, "12345 1234567 123456", T.postal_codes) == ["12345", "123456"]


@pytest.mark.parametrize("text,grams", [("", []), ("a", ["a"]), ("ab", ["ab"]), ("abc", ["^ab", "abc", "bc$"])])
def test_trigrams(spark, text, grams):
    assert col(spark, text, T.trigrams) == grams


@pytest.mark.parametrize("text,script", [(None, "empty"), ("", "empty"), ("123", "latin"), ("abc", "latin"), ("अआabc", "latin"), ("अआइab", "devanagari"), ("அab", "latin"), ("அஆ", "tamil"), ("అ", "latin")])
def test_script(spark, text, script):
    assert col(spark, text, T.script) == script


def test_similarity(spark):
    assert spark.range(1).select(T.similarity(F.lit(""), F.lit("")), T.similarity(F.lit("é"), F.lit("e"))).first()[:] == (1.0, 0.0)
    assert round(jaro_winkler_pair("martha", "marhta"), 4) == 0.9611
    assert jaro_winkler_pair("", "") == 1.0 and jaro_winkler_pair("", "a") == 0.0 and jaro_winkler_pair("abc", "xyz") == 0.0


def test_unicode_udfs(spark):
    got = spark.createDataFrame([("ﬁ é",), (None,), ("abc",)], "x string").select(nfkc("x"), ascii_only("x")).collect()
    assert [tuple(r) for r in got] == [("fi é", "fi e"), (None, None), ("abc", "abc")]


def test_normal_forms(spark):
    def name(text):
        return N.name_columns(spark.createDataFrame([(text,)], "x string"), "x", []).first()

    n = name("  CafÃ© Foo Pvt. Ltd. ")
    assert n["unicode_clean"] == "Café Foo Pvt. Ltd." and n["legal_stripped"] == "café foo" and n["alphanumeric_ascii_folded"] == "cafefoo"
    assert name("www.foo.co.in")["domain_stripped"] == "foo" and name("L.L.P.")["unicode_clean"] == "LLP"
    assert name(None)["is_missing"] and name(" ")["raw"] == " " and name("")["detected_script"] == "empty"
    assert col(spark, "Services Co LLC", N.without_form) == "Services" and col(spark, "Ltd", N.without_form) == "Ltd"
    a = N.address_columns(spark.createDataFrame([("0012 N Main St Pl 00145b, 560001",)], "x string"), "x", []).first()
    assert a["standardized"] == "0012 north main street plot 00145b, 560001"
    assert a["numeric_tokens"] == ["12", "145b", "560001", "0012", "00145b"] and a["postal_codes"] == ["560001"] and a["has_postal_code"]
    assert [col(spark, x, N.grams) for x in ("berry", "", "a")] == [sorted(["^be", "ber", "err", "rry", "ry$"]), [], ["^a$"]]
    assert col(spark, "০0१२ 007b", N.number_tokens) == ["12", "7b", "০0१२", "007b"]


def test_normalise_records(spark):
    got = N.normalise_records(spark.createDataFrame([("S1-1", None, None, None), ("x", "Foo", "1 Rd", " X ")], "entity_id string, business_name string, business_address string, country string")).orderBy("entity_id").collect()
    assert [(r["source_prefix"], r["country"], r["name"]["is_missing"], r["address"]["standardized"]) for r in got] == [("S1", "", True, ""), ("UNKNOWN", "X", False, "1 road")]


def test_normal_forms_are_worked_out_once(spark):
    rows = spark.createDataFrame([("S1-1", "Foo Pvt Ltd", "1 Rd", "X")], "entity_id string, business_name string, business_address string, country string")
    plan = N.normalise_records(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 80 and plan.count("pythonUDF") < 10  # 471 and 74 where each step is inlined into all later ones


def test_script_counts_letters_in_the_first_of_equals(spark):
    texts = {"शर": "devanagari", "शab": "latin", "தश": "devanagari", "தa": "tamil", "ગ ગa": "gujarati", "ব1": "bengali", "12": "latin", "東": "latin", "": "empty"}
    assert {x: col(spark, x, T.script) for x in texts} == texts and col(spark, None, T.script) == "empty"
