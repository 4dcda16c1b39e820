"""Each candidate to one record at most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkspan.functions.text import similarity, without_zeros
from linkspan.functions.udfs import ascii_only

# Words of an address that don't name the street. (Words with blanks, hyphens or apostrophes
# never equal a token, so they are left out.)
STREET_TYPES = (
    "rue r avenue av ave boulevard bd blvd bvd chemin che chem allee all impasse imp route rte place pl quai cours cour square sq passage pass "
    "esplanade voie street st road rd drive dr lane ln court ct circle cir highway hwy parkway pkwy"
).split()
REGIONS = "aquitaine loire bordeaux nantes lille dunkerque calais tourcoing roubaix merignac pessac talence reze gironde nord".split()
STOPWORDS = "bis ter de du des la le l d les au aux et france n".split()
LEAST_AFFINITY = 0.5
MOST_PER_RECORD = 8


def street_parts(address: Column) -> tuple[Column, Column]:
    """(house number or null, distinct street words) of an address: the first number of up to five digits; words that aren't."""
    tokens = F.regexp_extract_all(F.lower(address), F.lit("[a-z0-9]+"), F.lit(0))
    number = without_zeros(F.get(F.filter(tokens, lambda t: t.rlike("^[0-9]{1,5}$")), F.lit(0)))
    skip = F.array(*[F.lit(w) for w in STREET_TYPES + REGIONS + STOPWORDS])
    return number, F.array_distinct(F.filter(tokens, lambda t: ~t.rlike("^[0-9]+$") & ~F.array_contains(skip, t)))


def _side(df: DataFrame, side: str) -> DataFrame:
    """Parts of a record. A stored null is the text None, as it is for the scoring this reproduces."""
    base = df.select(F.col("entity_id").alias(f"{side}_id"), F.lower(F.coalesce("business_name", F.lit("None"))).alias(f"{side}_name"), F.coalesce(ascii_only(F.col("business_address")), F.lit("")).alias("a"))
    number, street = street_parts(F.col("a"))
    return base.select(f"{side}_id", f"{side}_name", number.alias(f"{side}_number"), street.alias(f"{side}_street"))


def affinity(pairs: DataFrame, s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """pairs with affinity: name similarity, +-1 for equal or different numbers, and half a point for each shared street word (or half off for none)."""
    x = pairs.join(_side(s1, "l"), F.col("source1_entity_id") == F.col("l_id"), "left").join(_side(candidates, "r"), F.col("candidate_entity_id") == F.col("r_id"), "left")
    x = x.fillna("", ["l_name", "r_name"])
    empty = F.array().cast("array<string>")
    ls, rs = F.coalesce("l_street", empty), F.coalesce("r_street", empty)
    number = F.when(F.col("l_number") == F.col("r_number"), 1.0).when(F.col("l_number") != F.col("r_number"), -1.0).otherwise(0.0)
    shared = F.size(F.array_intersect(ls, rs))
    street = F.when(shared > 0, 0.5 * shared).when((F.size(ls) > 0) & (F.size(rs) > 0), -0.5).otherwise(0.0)
    return x.select(*pairs.columns, (similarity(F.col("l_name"), F.col("r_name")) + number + street).alias("affinity"))


def resolve(pairs: DataFrame, s1: DataFrame, candidates: DataFrame, most: int | None = MOST_PER_RECORD, strict_cap: bool = False) -> DataFrame:
    """(source1_entity_id, candidate_entity_id) in which no candidate belongs to two records.

    A candidate of one record passes. One of several goes to the record of highest affinity (the smallest id
    of equals) if that is 0.5 or more, and is dropped otherwise. A record keeps `most` candidates: those that
    only it had first, then by id. If no candidate was contested, nothing is capped unless strict_cap is set.
    """
    keys = ["source1_entity_id", "candidate_entity_id"]
    counted = pairs.select(*keys).withColumn("n", F.count("*").over(Window.partitionBy("candidate_entity_id")))
    single = counted.where("n = 1").select(*keys, F.lit(0).alias("late"))
    contested = counted.where("n > 1").select(*keys)
    best = Window.partitionBy("candidate_entity_id").orderBy(F.desc("affinity"), "source1_entity_id")
    won = affinity(contested, s1, candidates).withColumn("k", F.row_number().over(best)).where((F.col("k") == 1) & (F.col("affinity") >= LEAST_AFFINITY))
    out = single.unionByName(won.select(*keys, F.lit(1).alias("late")))
    if most and (strict_cap or contested.take(1)):
        rank = F.row_number().over(Window.partitionBy("source1_entity_id").orderBy("late", "candidate_entity_id"))
        out = out.withColumn("k", rank).where(F.col("k") <= most)
    return out.select(*keys)
