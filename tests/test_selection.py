import random

import pytest

from linkspan.operators.selection import key_statistics, select_by_rank

KIND = "k string, v string, name string"


def brute(data, num=1, den=2):
    out = {}
    for k in {r[0] for r in data if r[0] is not None}:
        vals = sorted({r[1] for r in data if r[0] == k and r[1] is not None}, key=lambda s: [ord(c) for c in s])
        if vals:
            out[k] = (vals[-(-len(vals) * num // den) - 1], len(vals))
    return out


def run(df, **kw):
    return {r["k"]: (r["v"], r["n"]) for r in select_by_rank(df, "k", "v", **kw).collect()}


@pytest.mark.parametrize("num,den", [(1, 2), (1, 1), (9, 10), (1, 100)])
def test_matches_brute_force(spark, num, den):
    rng = random.Random(7)
    data = [("hot", f"S1-{rng.randrange(5000):09d}", None) for _ in range(1500)]
    data += [(rng.choice("abc"), rng.choice(["", "x", "xy", "xyz", "é", "日本", "z" * 80, "z" * 80 + "a"]), "n") for _ in range(60)]
    data += [(None, "v", "n"), ("a", None, "n"), ("only", "one", "n"), ("only", "one", "n")]
    df = spark.createDataFrame(data, KIND)
    assert run(df, num=num, den=den) == brute(data, num, den)


def test_state_in_a_salted_shuffle(spark):
    data = [(str(i % 3), f"{i * 37 % 101:03d}", None) for i in range(101)]
    assert run(spark.createDataFrame(data, KIND), most_broadcast=0) == brute(data)


def test_empty_and_clashing_names(spark):
    assert run(spark.createDataFrame([], KIND)) == {}
    df = spark.createDataFrame([("a", "1", 5, 6)], "k string, v string, n int, rank int")
    assert run(df) == {"a": ("1", 1)}
    with pytest.raises(ValueError):
        select_by_rank(df, "k", "v", 2, 1)


def test_statistics(spark, rows):
    data = [("a", "1", "x"), ("a", "1", "x"), ("a", "2", "y"), ("a", "3", None), ("b", "9", None), (None, "1", "x")]
    got = rows(key_statistics(spark.createDataFrame(data, KIND), "k", "v", "name"))
    assert got == [("a", 3, 2, "2"), ("b", 1, 0, "9")]


def test_many_cells_and_salted_hot_keys(spark):
    """Keys beyond the broadcast, one of them hot, and more cells than are ordered in one task."""
    rows = [("hot", f"{i:05d}") for i in range(3000)] + [(f"k{i % 40}", f"v{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "k string, v string")
    got = {r["k"]: (r["v"], r["n"]) for r in select_by_rank(df, "k", "v", most_broadcast=5, most_cells=50).collect()}
    want: dict = {}
    for k, v in rows:
        want.setdefault(k, []).append(v)
    assert got == {k: (sorted(v)[(len(v) + 1) // 2 - 1], len(v)) for k, v in want.items()}
