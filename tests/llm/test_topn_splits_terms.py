import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from linkspan.llm import topn
from linkspan.llm.ids import canonical_id
from linkspan.llm.topn import top_n
from linkspan.llm.splits import anneal, assign_rows, assigned, components, kept_together, members, report, split_components
from linkspan.llm.terms import marked, term_frequencies
from linkspan.plans import skew

SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


@pytest.mark.parametrize("stored,canonical", [("S1-000000012", "S1-000000012"), (" s1:12 ", "S1-000000012"), ("S1000000012", "S1-000000012"), ("S1_7", "S1-000000007"), ("S1-0", "S1-000000000"), ("S1-1234567890", "S1-1234567890"), ("abc", None), ("", None), (None, None), ("S1-", None)])
def test_canonical(spark, stored, canonical):
    assert spark.createDataFrame([(stored,)], "x string").select(canonical_id(F.col("x")).alias("y")).first()["y"] == canonical


def best(data, n):
    seen = {}
    for g, i, s in data:
        if g is not None and i is not None and s is not None and s == s:
            seen[(g, i)] = max(s, seen.get((g, i), -float("inf")))
    groups = defaultdict(list)
    for (g, i), s in seen.items():
        groups[g].append((-s, i))
    return sorted((g, i, k + 1) for g, v in groups.items() for k, (_, i) in enumerate(sorted(v)[:n]))


@pytest.mark.parametrize("salted", [False, True])
def test_top_n(spark, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(topn, "salts_by_slot", lambda df, key: skew.salts_by_slot(df, key, 20))
    rng = random.Random(3)
    data = [("hot", f"i{rng.randrange(400)}", rng.choice([1.0, 2.0, 2.0, 3.5, 1e6, -5.0])) for _ in range(1500)]
    data += [(rng.choice("abcde"), f"i{rng.randrange(9)}", rng.choice([None, float("nan"), float("inf"), float("-inf"), 1.0])) for _ in range(100)]
    data += [(None, "x", 1.0), ("a", None, 1.0)]
    df = spark.createDataFrame([(*d, 0, "z") for d in data], "grp string, item string, score double, g int, s string")
    for n in (1, 10):
        got = sorted((r["grp"], r["item"], r["rank"]) for r in topn.top_n(df, "grp", "item", "score", n).collect())
        assert got == best(data, n)


def test_top_n_equal_and_empty(spark):
    kind = "g string, i string, s double"
    df = spark.createDataFrame([("a", f"{i:03d}", 1.0) for i in range(300)], kind)
    assert [r["i"] for r in topn.top_n(df, "g", "i", "s", 3).orderBy("i").collect()] == ["000", "001", "002"]
    assert topn.top_n(df.limit(0), "g", "i", "s").count() == 0


def test_components_and_splits(spark):
    rng = random.Random(1)
    data = [(f"S1-{i:09d}" if rng.random() < 0.8 else f"s1:{i}", j, i % 3 == 0) for i in range(400) for j in range(rng.randrange(1, 9))]
    data += [("S1-000000000", j, True) for j in range(300)] + [(None, 1, True), ("S1-5", 1, None)]
    df = spark.createDataFrame(data, "sid string, item int, y boolean")
    stored = members(df, canonical_id(F.col("sid")), "sid", F.col("y"))
    comps = components(stored)
    got = {r["id"]: r for r in comps.collect()}
    count, forms = Counter(), defaultdict(set)
    for sid, _, _ in data:
        if sid is not None:
            k = int(re.sub("^[sS]1", "", sid).strip("-:") or 0)
            count[k] += 1
            forms[k].add(sid)
    assert {int(k[3:]): (r["rows"], r["forms"]) for k, r in got.items()} == {k: (count[k], len(forms[k])) for k in count}
    splits = split_components(comps, SHARES)
    placed = assigned(stored, splits)
    assert {r["id"] for r in kept_together(placed).collect()} == {r["id"] for r in comps.where("forms > 1").collect()}
    assert sum(r["rows"] for r in report(placed, SHARES).collect()) == comps.agg(F.sum("rows")).first()[0]
    torn = placed.withColumn("split", F.when(F.col("form") == F.lit("S1-1"), "nowhere").otherwise(F.col("split")))
    assert {r["id"] for r in kept_together(placed).collect()} - {r["id"] for r in kept_together(torn).collect()} <= {"S1-000000001"}
    size = Counter()
    for r in splits.collect():
        size[r["split"]] += r["rows"]
    total = sum(size.values())
    assert all(abs(size[s] / total - w) < 0.02 for s, w in SHARES.items())
    assert sorted(splits.select("id", "split").collect()) == sorted(split_components(comps, SHARES).select("id", "split").collect())
    rows = assign_rows(df.withColumn("id", F.lit(1)), canonical_id(F.col("sid")), splits, SHARES, "item")
    per = defaultdict(set)
    for r in rows.collect():
        assert r["split"] in SHARES and r["id"] == 1
        if r["sid"]:
            per[int(re.sub("^[sS]1", "", r["sid"]).strip("-:"))].add(r["split"])
    assert rows.count() == len(data) and all(len(v) == 1 for v in per.values())


def test_splits_of_little(spark):
    kind = "id string, rows long, positives long, forms long"
    assert split_components(spark.createDataFrame([], kind), SHARES).count() == 0
    assert split_components(spark.createDataFrame([("a", 5, 0, 1)], kind), SHARES).count() == 1


def test_annealing_never_worsens():
    cells = [(str(i), 1 + i % 7, i % 2) for i in range(60)]
    start, _ = anneal(cells, [0.8, 0.1, 0.1], 5, steps=0)
    end, at = anneal(cells, [0.8, 0.1, 0.1], 5)
    assert end <= start and end < 0.05 and len(at) == 60
    assert anneal([], [1.0], 1)[0] == 0.0 and anneal(cells, [1.0], 1)[1] == [0] * 60


def test_terms_against_brute_force(spark):
    rng = random.Random(9)
    texts = [None, "", "!!", "a b a b a b a", "Ä a-b_c 12K", "the the the", "x" * 50000 + " a"] + [" ".join(rng.choice("abcdAB") for _ in range(rng.randrange(0, 9))) for _ in range(60)]
    data = [(f"r{i}", t, texts[-i - 1], 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "rec string, f1 string, f2 string, occ int")
    want = {}
    for rec, a, b, _ in data:
        for f, t in (("f1", a), ("f2", b)):
            terms = [x.lower() for x in re.findall("[A-Za-z0-9]+", t or "")]
            for n in (1, 2, 3):
                for i in range(len(terms) - n + 1):
                    k = (f, n, " ".join(terms[i : i + n]))
                    o, r = want.setdefault(k, [0, set()])
                    want[k][0] = o + 1
                    r.add(rec)
    got = {(r["field"], r["n"], r["term"]): (r["occurrences"], r["records"]) for r in term_frequencies(df, "rec", ["f1", "f2"], 3).collect()}
    assert got == {k: (o, len(r)) for k, (o, r) in want.items()}
    assert term_frequencies(df.limit(0), "rec", ["f1"], 2).count() == 0


def test_marks(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (51,)], "records long")
    assert [r["mark"] for r in marked(df, 100).orderBy("records").collect()] == ["rare", None, "common", "common"]


def test_terms_of_every_length(spark):
    rng = random.Random(5)
    texts = [None, "", "a b a b a b a", "the " * 30, "a-b_c d e f g h i j", "x" * 50000 + " a b c d"] + [" ".join(rng.choice("ab1") for _ in range(rng.randrange(0, 12))) for _ in range(80)]
    df = spark.createDataFrame([(f"r{i}", t, texts[-i - 1]) for i, t in enumerate(texts)], "rec string, f1 string, f2 string")
    want = {}
    for r in df.collect():
        for f in ("f1", "f2"):
            terms = [x.lower() for x in re.findall("[A-Za-z0-9]+", r[f] or "")]
            for i in range(len(terms)):
                for j in range(i + 1, len(terms) + 1):
                    o = want.setdefault((f, j - i, " ".join(terms[i:j])), [0, set()])
                    o[0] += 1
                    o[1].add(r["rec"])
    rows = term_frequencies(df, "rec", ["f1", "f2"], None).collect()
    got = {(r["field"], r["n"], r["term"]): (r["occurrences"], r["records"]) for r in rows}
    assert len(rows) == len(got) and got == {k: (o, len(s)) for k, (o, s) in want.items()} and max(k[1] for k in got) == 30


def test_ngrams_have_no_bound(spark, small):
    from linkspan.llm.queries import QUERIES

    longest = QUERIES["p3_ngrams"](spark, small).agg(F.max("n")).first()[0]
    values = spark.read.parquet(f"{small}/test_source2.parquet").select("business_name", "business_address").collect()
    assert longest == max(len(re.findall("[A-Za-z0-9]+", v or "")) for r in values for v in r) > 3


def test_steps_go_with_the_units():
    rng = random.Random(4)
    cells = [(str(i), rng.randrange(1, 60), rng.randrange(0, 9)) for i in range(3000)]
    cost, at = anneal(cells, [0.8, 0.1, 0.1], 7)
    assert cost < 0.001 and set(at) == {0, 1, 2}


def test_one_wild_score_leaves_the_filter_sharp(spark):
    rows = [("g", f"i{i:04d}", float(i % 997)) for i in range(2000)] + [("g", "wild", 1e300), ("g", "low", -1e300), ("h", "a", float("inf"))]
    got = top_n(spark.createDataFrame(rows, "g string, i string, s double"), "g", "i", "s", 5)
    assert [(r["g"], r["i"]) for r in got.orderBy("g", "rank").collect()] == [("g", "wild"), ("g", "i0996"), ("g", "i1993"), ("g", "i0995"), ("g", "i1992"), ("h", "a")]
