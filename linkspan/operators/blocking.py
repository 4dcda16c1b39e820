"""Candidate generation in eight channels."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkspan.functions import regexes as R
from linkspan.functions.text import ascii_alnum, lowered, present, split_on_blank, trimmed
from linkspan.plans.durable import durable

# Address words that are no anchors.
ADDRESS_STOPWORDS = (
    "street road avenue drive lane boulevard floor suite apartment building sector district nagar "
    "north south east west house block first second third opposite near"
).split()
# Weight of a channel, and how many candidates it gives a record at most (None: the final cap).
PRIORITY = {"a": 100, "a2": 95, "b": 80, "c": 40, "d": 50, "e": 75, "e2": 85, "g": 60}
CAP = {"a": None, "a2": None, "b": 50, "c": 30, "d": 30, "e": 50, "e2": 50, "g": 30}
CHANNELS = list(PRIORITY)


@dataclass
class Blocking:
    """Parameters. rare: how often a rare token occurs among a country's candidates, and rare_ends for channel c."""

    cap: int = 100
    legal: str = R.LEGAL_ASCII
    prefix: str = R.PREFIX_ASCII
    rare: tuple[int, int] = (2, 100)
    rare_ends: tuple[int, int] = (2, 50)
    channels: list[str] = field(default_factory=lambda: list(CHANNELS))

    def limit(self, channel: str) -> int:
        return CAP[channel] or self.cap


def keyed(df: DataFrame, side: str, conf: Blocking) -> DataFrame:
    """Every key of a record, computed once: (side_id, country, a, a2, name_tokens, address_tokens, number, lead, tail, ends)."""
    name, address = F.col("business_name"), F.col("business_address")
    named, placed = present(name), present(address)
    low = lowered(trimmed(name))
    dotless = F.replace(low, F.lit("."), F.lit(""))
    core = lambda c: ascii_alnum(F.regexp_replace(c, conf.legal, ""))
    plain = ascii_alnum(lowered(name))
    number = F.regexp_replace(F.regexp_extract(address, "[0-9]{1,6}", 0), "^0+", "")
    ends = F.regexp_replace(low, conf.legal, "")
    return df.select(
        F.col("entity_id").alias(side), "country",
        F.when(named, core(dotless)).alias("a"),
        F.when(named, core(F.regexp_replace(dotless, conf.prefix, ""))).alias("a2"),
        F.when(named, split_on_blank(name)).alias("name_tokens"),
        F.when(placed, split_on_blank(address)).alias("address_tokens"),
        F.when(number != "", number).alias("number"),
        F.when(F.length(plain) >= 3, F.substring(plain, 1, 3)).alias("lead"),
        F.when(F.length(plain) >= 7, F.substring(plain, 2, 7)).alias("tail"),
        F.when(F.length(ends) >= 5, F.struct(F.substring(ends, 1, 4).alias("first"), F.right(ends, F.lit(4)).alias("last"))).alias("ends"),
    )


def _shared_country(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a country to join on. If no left record has one, all records are in one place."""
    if left.where("country is not null").take(1):
        return left.where("country is not null"), right.where("country is not null")
    everywhere = F.lit("")
    return left.withColumn("country", everywhere), right.withColumn("country", everywhere)


def _capped(pairs: DataFrame, channel: str, conf: Blocking) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("s1_id").orderBy("candidate_id"))
    return pairs.withColumn("rn", rank).where(F.col("rn") <= conf.limit(channel)).select("s1_id", "candidate_id", F.lit(PRIORITY[channel]).alias("priority_score"))


def _by_one_key(left: DataFrame, right: DataFrame, key: list[Column], channel: str, conf: Blocking, rare: tuple[int, int] | None = None) -> DataFrame:
    """A channel whose records have one key each.

    Candidates are capped per key before the join: the cap keeps the smallest candidate ids either way, and no
    key, however common, joins more than the cap. The rare rule counts before that.
    """
    keys = [f"k{i}" for i in range(len(key))]
    filled = " and ".join(f"{k} is not null" for k in keys)
    lk = left.select("s1_id", "country", *[k.alias(n) for k, n in zip(key, keys)]).where(filled)
    rk = right.select("candidate_id", "country", *[k.alias(n) for k, n in zip(key, keys)]).where(filled)
    by = Window.partitionBy("country", *keys)
    if rare:
        counts = rk.groupBy("country", *keys).count().where(F.col("count").between(*rare)).drop("count")
        rk = rk.join(counts, ["country", *keys], "left_semi")
    rk = rk.withColumn("n", F.row_number().over(by.orderBy("candidate_id"))).where(F.col("n") <= conf.limit(channel)).drop("n")
    return _capped(lk.join(rk, ["country", *keys]), channel, conf)


def candidate_tokens(right: DataFrame, column: str, least: int, stopwords: list[str] = []) -> DataFrame:  # noqa: B006
    """(candidate_id, country, number, tok) of the candidates, one row for each occurrence."""
    out = right.select("candidate_id", "country", "number", F.explode(column).alias("tok")).where(F.length("tok") >= least)
    return out.where(~F.col("tok").isin(stopwords)) if stopwords else out


def rare_tokens(tokens: DataFrame, bounds: tuple[int, int]) -> DataFrame:
    """Tokens by how often they occur in the candidates of a country."""
    return tokens.groupBy("country", "tok").count().where(F.col("count").between(*bounds)).select("country", "tok", F.col("count").alias("n"))


def _by_tokens(left: DataFrame, tokens: DataFrame, column: str, channel: str, conf: Blocking, number: bool = False) -> DataFrame:
    """A channel over an inverted index of rare tokens. A pair that shares several tokens comes as often."""
    rare = rare_tokens(tokens, conf.rare).select("country", "tok")
    on = ["country", "tok"] + (["number"] if number else [])
    lt = left.select("s1_id", "country", "number", F.explode(column).alias("tok"))
    lt, rt = (x.where("number <> ''") if number else x.drop("number") for x in (lt, tokens))
    index = rt.join(rare, ["country", "tok"], "left_semi")
    return _capped(lt.join(index, on).select("s1_id", "candidate_id"), channel, conf)


def channel_pairs(s1: DataFrame, candidates: DataFrame, conf: Blocking | None = None) -> dict[str, DataFrame]:
    """(s1_id, candidate_id, priority_score) by channel, before they are put together.

    Both tables need entity_id (unique), business_name, business_address and country. Pairs share a country.
    """
    conf = conf or Blocking()
    keys = keyed(s1, "s1_id", conf), keyed(candidates, "candidate_id", conf)
    if len(conf.channels) > 1:  # every channel reads them
        keys = tuple(durable(k) for k in keys)
    left, right = _shared_country(*keys)
    long = lambda c, n: F.when(F.length(c) >= n, F.col(c))
    name_tokens = candidate_tokens(right, "name_tokens", 4)
    address_tokens = candidate_tokens(right, "address_tokens", 5, ADDRESS_STOPWORDS)
    number = F.when(F.length("number") > 0, F.col("number"))
    makers = {
        "a": lambda: _by_one_key(left, right, [long("a", 3)], "a", conf),
        "a2": lambda: _by_one_key(left, right, [long("a2", 3)], "a2", conf),
        "b": lambda: _by_tokens(left, name_tokens, "name_tokens", "b", conf),
        "c": lambda: _by_one_key(left, right, [F.col("ends.first"), F.col("ends.last")], "c", conf, conf.rare_ends),
        "d": lambda: _by_tokens(left, address_tokens, "address_tokens", "d", conf),
        "e": lambda: _by_one_key(left, right, [number, F.col("lead")], "e", conf),
        "e2": lambda: _by_tokens(left, address_tokens, "address_tokens", "e2", conf, number=True),
        "g": lambda: _by_one_key(left, right, [F.col("tail")], "g", conf, conf.rare),
    }
    return {c: makers[c]() for c in conf.channels}


def combine(channels: dict[str, DataFrame], cap: int) -> DataFrame:
    """The candidate table: one row per pair with its summed priority, fired channels and rank, `cap` per record.

    Ranks go by priority, then by number of channels, then by candidate id.
    """
    parts = [df.withColumn("chan", F.lit(c)) for c, df in channels.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    flags = [F.max(F.when(F.col("chan") == c, 1).otherwise(0)).cast("long").alias(f"fired_chan_{c}") for c in CHANNELS]
    pairs = union.groupBy(F.col("s1_id").alias("source1_entity_id"), F.col("candidate_id").alias("candidate_entity_id")).agg(F.sum("priority_score").cast("double").alias("total_priority"), *flags)
    pairs = pairs.withColumn("channels_fired", sum((F.col(f"fired_chan_{c}") for c in CHANNELS), F.lit(0)).cast("long"))
    order = Window.partitionBy("source1_entity_id").orderBy(F.desc("total_priority"), F.desc("channels_fired"), "candidate_entity_id")
    ranked = pairs.withColumn("rank_order", F.row_number().over(order).cast("long")).where(F.col("rank_order") <= cap)
    return ranked.select("source1_entity_id", "candidate_entity_id", "total_priority", "channels_fired", "rank_order", *[f"fired_chan_{c}" for c in CHANNELS])


def generate_candidates(s1: DataFrame, candidates: DataFrame, conf: Blocking | None = None) -> DataFrame:
    """All channels of conf put together, ranked and capped."""
    conf = conf or Blocking()
    return combine(channel_pairs(s1, candidates, conf), conf.cap)
