import pytest

from linkspan.llm.encoding import CHAINS, DEPTH, SINGLE, repairs, restorations, shortest, unread

WORDS = ["Café de la Forêt", "Société d’Épicerie", "Señor Niño – Möbel", "Коммерц Строй", "Κήπος Αρτοποιείο", "हेदियामिक्स मोटर्स"]


def misread(text, charset):
    """UTF-8 bytes read in `charset`; bytes it lacks read as controls."""
    out = []
    for b in text.encode("utf-8"):
        try:
            out.append(bytes([b]).decode(charset))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


@pytest.mark.parametrize("charset", SINGLE)
@pytest.mark.parametrize("text", WORDS)
def test_round_trip(charset, text):
    x = text
    for _ in range(2):
        x = misread(x, charset)
        assert text in [t for _, t in restorations(x)], x


def test_parts_and_case():
    assert unread("Bâtiment CÃ´te Ã©", "cp1252") == "Bâtiment Côte é"
    assert unread("mã©canique", "cp1252") == "mécanique"
    assert unread("CAFÉ", "cp1252") == "CAFÉ" and unread("plain", "cp1252") == "plain"
    assert shortest("CafÃ©") == "Café" and shortest("CAFÉ’S") == "CAFÉ’S" and shortest("हेदि") == "हेदि"
    assert len(CHAINS) == len(set(CHAINS)) and DEPTH == 3


def test_pooled_evidence(spark):
    good = [(f"g{i}", w, None, 1, "x") for i, w in enumerate(WORDS * 30)]
    bad = [("b1", "CafÃ© de la ForÃªt", "plain", 1, "x"), ("b2", "ok", "Caf�", 1, "x"), ("b3", misread("Κήπος", "cp1251"), "", 1, "x"), ("b4", "Société", "prÈs et Caf├⌐", 1, "x"), ("b5", None, None, 1, "x")]
    df = spark.createDataFrame(good + bad, "entity_id string, business_name string, business_address string, n int, value string")
    got = {(r["entity_id"], r["field"]): r["repaired"] for r in repairs(df, "entity_id", ["business_name", "business_address"]).collect()}
    assert set(got) == {("b1", "business_name"), ("b2", "business_address"), ("b3", "business_name"), ("b4", "business_address")}
    assert got[("b1", "business_name")] == "Café de la Forêt" and got[("b2", "business_address")] is None and got[("b3", "business_name")] == "Κήπος"


def test_empty_and_long(spark):
    kind = "entity_id string, business_name string"
    assert repairs(spark.createDataFrame([], kind), "entity_id", ["business_name"]).count() == 0
    assert repairs(spark.createDataFrame([("a", "plain")], kind), "entity_id", ["business_name"]).count() == 0
    got = repairs(spark.createDataFrame([("a", "CafÃ© " * 20000), ("b", "Café")], kind), "entity_id", ["business_name"]).collect()
    assert [(r["entity_id"], r["repaired"]) for r in got] == [("a", "Café " * 20000)]


@pytest.mark.parametrize("charset", ["cp1252", "mac_roman"])
def test_any_depth(spark, charset):
    """Text misread four and six times comes back, and nothing is left garbled without notice."""
    rows = [(f"g{i}", w) for i, w in enumerate(WORDS * 20)]
    for k in (4, 6):
        x = "Café de la Forêt"
        for _ in range(k):
            x = misread(x, charset)
        rows.append((f"b{k}", x))
        assert "Café de la Forêt" in [t for _, t in restorations(x)] and (charset != "cp1252" or shortest(x) == "Café de la Forêt")
    got = {r["entity_id"]: (r["repaired"], r["chain"]) for r in repairs(spark.createDataFrame(rows, "entity_id string, business_name string"), "entity_id", ["business_name"]).collect()}
    assert got == {k: ("Café de la Forêt", f"utf8>{charset} x3+") for k in ("b4", "b6")}


def test_sources_have_priors_of_their_own(spark):
    good = [(f"g{i}", w, s) for i, w in enumerate(WORDS * 10) for s in ("a", None)]
    got = repairs(spark.createDataFrame([*good, ("b", "CafÃ© Ã", "a")], "entity_id string, business_name string, src string"), "entity_id", ["business_name"], "src").collect()
    assert [r["entity_id"] for r in got] == ["b"]


def test_unread_looks_only_where_a_run_can_begin():
    from linkspan.llm.encoding import _choices

    looked = lambda: sum(_choices.cache_info()[:2])
    before = looked()
    assert unread("Générale Île", "cp1252") == "Générale Île" and looked() == before
    assert unread("Café Ã©té Ã\u00a0 é", "cp1252") == "Café été à é" and looked() > before
