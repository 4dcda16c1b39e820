import os
import random
from collections import Counter

import pytest

from linkspan.llm.bpe import TOKENIZERS, Encoder, encode_corpus, token_counts
from linkspan.llm.mixing import BINS, mix_sources, solve_rate, thresholds

FILE = f"{TOKENIZERS}/byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not os.path.exists(FILE), reason="no vocabulary files")
TEXTS = ["", "   ", "\n\n  x", "Hello, world! It's 2024.", "<|endoftext|> is text", "aaaaaaaaaaaaaaaaaaaaa", "Привет мир 日本語 हिन्दी 🙂👍🏽", "x" * 100_000, "the the the", "�\x00\t", "don't I'LL we've"]


def reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_equals_the_library():
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("ab cé日\n'st1🙂") for _ in range(rng.randrange(200))) for _ in range(200)]
    assert Encoder(FILE).encode(texts) == reference(texts)


def test_corpus(spark):
    data = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(100, None, "x"), (0, "", "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, ids string")
    got = sorted((r["doc_id"], r["ids"]) for r in encode_corpus(df).collect())
    assert got == sorted([(i, ids) for i, ids in enumerate(reference(TEXTS))] + [(100, []), (0, [])])
    counts = sorted((r["doc_id"], r["n_tokens"]) for r in token_counts(df).collect())
    assert counts == [(i, len(x)) for i, x in got]
    assert encode_corpus(df.limit(0)).count() == 0


def test_poisson_inversion():
    import math

    for rate in (0.1, 1.0, 3.0):
        t = thresholds(rate, 5)
        counts = Counter(sum(b >= x for x in t) for b in range(BINS))
        for k in range(5):
            assert abs(counts[k] / BINS - math.exp(-rate) * rate**k / math.factorial(k)) < 2 / BINS
    assert thresholds(math.inf, 3) == [0, 0, 0] and thresholds(0, 2) == [BINS] * 2 and thresholds(1, 0) == []
    sizes = [10.0] * BINS
    r = solve_rate(sizes, 15_000.0, 4)
    assert abs(sum(sum(sizes[t:]) for t in thresholds(r, 4)) - 15_000) <= 10
    assert solve_rate(sizes, 1e12, 4) == math.inf and solve_rate(sizes, 0, 4) == 0


def test_mixture(spark):
    rng = random.Random(2)
    docs = [(i, rng.choice(["a", "a", "a", "b", None, "z"]), "word " * rng.randrange(1, 30), 7) for i in range(3000)]
    docs += [(9000 + i, "c", t, 7) for i, t in enumerate([None, "", *["some words of a small source"] * 60])]
    targets = [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.1, 2), ("none", 0.1, 5)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string, copies int")
    tg = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    mix = mix_sources(df, tg, total=1e9)
    got = mix.records().collect()
    copies = Counter(r["doc_id"] for r in got)
    cap = {"a": 1, "b": 3, "c": 2}
    assert all(r["source"] in cap and 1 <= r["copy"] <= cap[r["source"]] for r in got) and len({(r["doc_id"], r["copy"]) for r in got}) == len(got)
    report = {r["source"]: r for r in mix.report().collect()}
    assert report["none"]["tokens"] == 0 and report["c"]["actual_share"] == pytest.approx(0.1 / 0.9, abs=0.02)
    assert sum(r["actual_share"] for r in report.values()) == pytest.approx(1)
    tokens = Counter()
    for r in got:
        tokens[r["source"]] += len(reference([r["text"] or ""])[0])
    assert {s: report[s]["tokens"] for s in cap} == {s: tokens[s] for s in cap} and max(copies.values()) <= 3
    assert sorted(map(tuple, mix_sources(df, tg, total=1e9).records().collect())) == sorted(map(tuple, got))
    smaller = mix_sources(df, tg.where("source in ('a', 'b')")).report()
    assert all(abs(r["actual_share"] - r["attainable_share"]) < 0.01 for r in smaller.collect())


def test_empty_mixtures(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    tg = spark.createDataFrame([("a", 1.0, None), (None, 0.5, 1), ("b", None, 2)], "source string, target_share double, max_repeats int")
    m = mix_sources(df, tg)
    assert m.records().count() == 0 and m.report().count() == 2
    assert mix_sources(df, tg.limit(0)).records().count() == 0
