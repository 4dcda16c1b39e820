"""Train, validation and test splits that keep related records together."""

from __future__ import annotations

import math
import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkspan.plans.durable import durable
from linkspan.plans.skew import all_salts, salt, salts_by_slot

CELLS = 4096
#: A component of more than 1/LARGE of all rows is a cell by itself; there are fewer than LARGE of them.
LARGE = 2000
#: Annealing steps for each unit, and at least.
STEPS, LEAST_STEPS = 50, 20_000


def members(df: DataFrame, canonical: Column, stored: str, label: Column | None = None) -> DataFrame:
    """One row per member (stored form) of a component: id, form, its rows and the rows with the label; written once.

    Rows are counted where they lie before they move, so a component with a third of all rows is only counts by then.
    """
    label = F.lit(False) if label is None else F.coalesce(label, F.lit(False))
    rows = df.select(canonical.alias("id"), F.col(stored).alias("form"), label.cast("long").alias("y")).where("id is not null")
    return durable(rows.groupBy("id", "form").agg(F.count("*").alias("rows"), F.sum("y").alias("positives")))


def components(members: DataFrame) -> DataFrame:
    """One row per component: id, its rows, the rows with the label, and how many stored forms its id has."""
    return members.groupBy("id").agg(F.sum("rows").alias("rows"), F.sum("positives").alias("positives"), F.count("*").alias("forms"))


def assigned(members: DataFrame, splits: DataFrame) -> DataFrame:
    """The members, each with the split of its component."""
    return members.join(splits.select("id", "split"), "id")


def kept_together(placed: DataFrame) -> DataFrame:
    """(id, forms, split): components of several stored forms all of whose members were assigned to one split."""
    found = placed.groupBy("id").agg(F.count("*").alias("forms"), F.min("split").alias("split"), F.max("split").alias("_last"))
    return found.where("forms > 1 and split = _last").drop("_last")


def report(placed: DataFrame, shares: dict[str, float]) -> DataFrame:
    """(split, target, rows, positives, row_share, label_share) of the assigned members, a row for each split that has any."""
    total = sum(shares.values())
    target = F.create_map(*[F.lit(x) for s, v in shares.items() for x in (s, v / total)])
    sums = placed.groupBy("split").agg(F.sum("rows").alias("rows"), F.sum("positives").alias("positives"))
    every = placed.agg(F.sum("rows").alias("_rows"), F.sum("positives").alias("_positives"))
    share = lambda c: F.when(F.col(f"_{c}") > 0, F.col(c) / F.col(f"_{c}")).otherwise(0.0)
    return sums.join(F.broadcast(every)).select("split", target[F.col("split")].alias("target"), "rows", "positives", share("rows").alias("row_share"), share("positives").alias("label_share"))


def anneal(cells: list[tuple[str, int, int]], shares: list[float], seed: int, steps: int | None = None) -> tuple[float, list[int]]:
    """Assign cells (key, rows, positives) to len(shares) splits; returns (cost, split of each cell).

    Starts from an assignment by hash and proposes moving one cell or exchanging two, at falling temperature.
    The cost adds up the splits' deviations in rows and in positives, each as a share of the total. The best
    assignment met is returned, so the result is never worse than the start. Steps go with the number of cells.
    """
    steps = max(LEAST_STEPS, STEPS * len(cells)) if steps is None else steps
    rng = random.Random(seed)
    k, total, positives = len(shares), max(1, sum(c[1] for c in cells)), max(1, sum(c[2] for c in cells))
    bounds = [sum(shares[: i + 1]) for i in range(k)]
    at = [min(k - 1, sum(rng.random() * bounds[-1] > b for b in bounds)) for _ in cells]
    if not cells:
        return 0.0, at
    size, pos = [0] * k, [0] * k
    for c, s in zip(cells, at):
        size[s] += c[1]
        pos[s] += c[2]

    def cost() -> float:
        return sum(abs(size[i] / total - shares[i]) for i in range(k)) + 0.5 * sum(abs(pos[i] / positives - shares[i]) for i in range(k))

    def put(i: int, s: int) -> None:
        for t, sign in ((at[i], -1), (s, 1)):
            size[t] += sign * cells[i][1]
            pos[t] += sign * cells[i][2]
        at[i] = s

    now = cost()
    best, kept = now, list(at)
    for step in range(steps):
        heat = 0.02 * math.exp(-8 * step / steps)
        i = rng.randrange(len(cells))
        old_i = at[i]
        if rng.random() < 0.5:
            j, old_j = i, old_i
            put(i, (old_i + rng.randrange(1, k)) % k if k > 1 else 0)
        else:
            j = rng.randrange(len(cells))
            old_j = at[j]
            put(i, old_j)
            put(j, old_i)
        new = cost()
        if new <= now or rng.random() < math.exp((now - new) / heat):
            now = new
            if now < best - 1e-12:
                best, kept = now, list(at)
        else:
            if j != i:
                put(j, old_j)
            put(i, old_i)
    return best, kept


def split_components(comps: DataFrame, shares: dict[str, float], seed: int = 42, chains: int = 8) -> DataFrame:
    """The components with the split each goes to, all rows of a component to the same one.

    Components of more than 1/LARGE of all rows are units by themselves, fewer than LARGE by that bound; the
    others are hashed into CELLS bundles of whole components. On these at most LARGE + CELLS units, whatever
    the data, `chains` annealing chains search in parallel tasks from differently seeded hashed assignments,
    and the assignment of least deviation is kept. The same input and seed give the same splits.

    An empty input gives no rows. With one component everything lands in one split. Shares need not add up
    to 1; they are taken in proportion.
    """
    spark = comps.sparkSession
    names, weights = list(shares), [shares[s] / sum(shares.values()) for s in shares]
    comps = durable(comps)
    total = comps.agg(F.sum("rows")).first()[0] or 0
    unit = F.when(F.col("rows") > total / LARGE, F.concat(F.lit("c"), F.col("id"))).otherwise(F.concat(F.lit("h"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(CELLS)).cast("string")))
    comps = comps.withColumn("unit", unit)
    cells = sorted(tuple(r) for r in comps.groupBy("unit").agg(F.sum("rows"), F.sum("positives")).collect())

    def search(batches):
        for pdf in batches:
            for chain in pdf["id"]:
                found, kept = anneal(cells, weights, seed * 1000 + int(chain))
                yield pd.DataFrame({"cost": [found], "chain": [int(chain)], "kept": [",".join(map(str, kept))]})

    best = spark.range(0, chains, 1, chains).mapInPandas(search, "cost double, chain long, kept string").orderBy("cost", "chain").first()
    kept = [int(x) for x in best["kept"].split(",")] if cells else []
    units = pd.DataFrame({"unit": [c[0] for c in cells], "split": [names[s] for s in kept]}).astype(object)
    table = spark.createDataFrame(units, "unit string, split string") if cells else spark.createDataFrame([], "unit string, split string")
    return comps.join(F.broadcast(table), "unit").drop("unit")


def assign_rows(df: DataFrame, canonical: Column, splits: DataFrame, shares: dict[str, float], salt_by: str) -> DataFrame:
    """df with its split. Rows without an id are spread by hash in proportion to the shares.

    The splits meet the rows on (id, salt), with as many salts as the id's slot of rows needs.
    """
    names, bounds, upto = list(shares), [], 0.0
    for s in names:
        bounds.append(upto := upto + shares[s] / sum(shares.values()))
    u = (F.pmod(F.xxhash64(salt_by), F.lit(1_000_000)) + 0.5) / 1_000_000
    loose = F.lit(names[-1])
    for s, b in reversed(list(zip(names[:-1], bounds[:-1]))):
        loose = F.when(u < b, F.lit(s)).otherwise(loose)
    rows = df.withColumn("_id", canonical)
    salts = salts_by_slot(rows.where("_id is not null"), F.col("_id"))
    rows = rows.withColumn("_salt", salt(F.col("_id"), F.col(salt_by), salts))
    keys = splits.select(F.col("id").alias("_id"), F.col("split").alias("_split"))
    keys = keys.withColumn("_salt", all_salts(F.col("_id"), salts) if salts else F.lit(0))
    return rows.join(keys, ["_id", "_salt"], "left").withColumn("split", F.coalesce("_split", loose)).drop("_id", "_salt", "_split")


