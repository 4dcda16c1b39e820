"""Which address records denote the same place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkspan.llm.places import parsed, streets
from linkspan.llm.rewrites import in_lines, mined, worded
from linkspan.plans.durable import durable, release

#: Words of an address that enter its keys; the rest of a longer one still takes part in the comparison.
_LONG = "filter(array_distinct(concat(name, rest)), w -> length(w) >= 3)"


#: Letters of a word's start or end that enter a key.
PART = 3


def _crossed(x: str, y: str) -> str:
    """SQL for the keys of each word of x with each other word of y: number with the starts, and with the ends, of both."""
    return f"flatten(transform({x}, a -> flatten(transform(filter({y}, b -> b <> a), b -> array(concat(num, '/', left(a, {PART}), '/', left(b, {PART})), concat(num, '|', right(a, {PART}), '|', right(b, {PART})))))))"


def _worded(column: str) -> str:
    return f"filter({column}, w -> length(w) >= 3)"


def left_keys(df: DataFrame) -> DataFrame:
    """(rid, k): keys of the reference side: number with code, and number with the starts or ends of a street and a town word.

    A slip in either word leaves its start or its end as it is.
    """
    return _exploded(df, F.concat(F.array(F.concat("num", F.lit("#"), "code")), F.expr(_crossed(_worded("name"), _worded("town")))))


def right_keys(df: DataFrame) -> DataFrame:
    """(rid, k): the same keys; every ordered pair of words, unless a type word tells the street name from the rest."""
    told = F.expr(_crossed(_worded("name"), _worded("rest")))
    pairs = F.when(F.col("type").isNotNull() & (F.size("name") == 1) & (F.size("rest") > 0), told).otherwise(F.expr(_crossed(_LONG, _LONG)))
    return _exploded(df, F.concat(F.array(F.concat("num", F.lit("#"), "code")), pairs))


def _exploded(df: DataFrame, keys: Column) -> DataFrame:
    keys = F.filter(keys, lambda k: k.isNotNull())
    return df.where("num is not null").select("rid", F.explode(F.array_distinct(F.transform(keys, lambda k: F.xxhash64(k)))).alias("k"))


def alike(a: str, b: str) -> str:
    """SQL: words a and b are equal or differ by a slip of the pen: one edit from four letters, two from seven, or two letters swapped."""
    return (
        f"({a} = {b} or (length({a}) >= 4 and levenshtein({a}, {b}, 1) between 0 and 1) or (length({a}) >= 7 and levenshtein({a}, {b}, 2) between 0 and 2)"
        f" or (length({a}) >= 4 and length({a}) = length({b}) and levenshtein({a}, {b}, 2) = 2 and array_sort(split({a}, '')) = array_sort(split({b}, ''))))"
    )


def compared(pairs: DataFrame) -> DataFrame:
    """pairs of columns l_... and r_... with street, type, direction, town and code agreement (true, false, null if missing)."""
    found = "exists(r_words, w -> " + alike("n", "w") + ")"
    native = "(size(r_native) > 0 and forall(l_skeletons, s -> exists(r_native, w -> w = s or (length(s) >= 4 and levenshtein(s, w, 1) between 0 and 1))))"
    street = f"case when size(l_name) = 0 or size(r_words) = 0 then null else forall(l_name, n -> {found}) or {native} end"
    town = f"case when size(l_town) = 0 or size(r_words) = 0 then null else exists(slice(filter(l_town, n -> length(n) >= 4), 1, 1), n -> {found}) end"
    return (
        pairs.withColumn("street_ok", F.expr(street))
        .withColumn("town_ok", F.expr(town))
        .withColumn("code_ok", F.expr("l_code = r_code"))
        .withColumn("type_ok", F.expr("case when l_type is null or size(r_types) = 0 then null else coalesce(l_type = r_type, false) or (r_type is null and array_contains(r_types, l_type)) end"))
        .withColumn("dir_ok", F.expr("case when l_dir is null then nullif(r_dir is null, true) else array_contains(r_dirs, l_dir) end"))
    )


def sided(df: DataFrame, side: str, extra: list[str] = []) -> DataFrame:  # noqa: B006
    """df with the columns of a comparison, named for its side."""
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in (*extra, "rid", "num", "code", "words", "type", "dir", "dirs", "name", "rest", "town", "types", "native", "skeletons")])


def candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """(l_rid, r_rid): pairs that share a key, once for each."""
    lk, rk = left_keys(left).withColumnRenamed("rid", "l_rid"), right_keys(right).withColumnRenamed("rid", "r_rid")
    return lk.join(rk, "k").select("l_rid", "r_rid")


def prepared(left: DataFrame, right: DataFrame, address: str = "business_address") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Streets of both tables (columns id and address) after all rewrites, and the rewrites. rid numbers the rows of a side."""
    read = [durable(parsed(x, "id", address)) for x in (left, right)]
    rules = mined(*(worded(x) for x in read))
    out = tuple(durable(streets(*in_lines(x, "id", rules), x is read[0]).withColumn("rid", F.monotonically_increasing_id())) for x in read)
    release(*read)
    return (*out, rules)


def same_places(left: DataFrame, right: DataFrame, address: str = "business_address") -> DataFrame:
    """(l_id, r_id) of the records whose addresses denote the same place: house number and street in the same town.

    left and right have the columns id and `address`; left is the side with the more regular writing. Words
    come into full form by rewrites mined from the data (rewrites.py). Two addresses are the same place if
    the numbers are equal, every street-name word of the left one stands in the right one (slips of the pen allowed), type and
    direction don't differ, and postal code or town agree. A missing type, code or town is no difference as long as
    one of code and town agrees.

    Addresses that are null, blank or lack a number or street match nothing. Repeated ids must have been
    removed. Empty tables give no rows.
    """
    l, r, _ = prepared(left, right, address)
    l = l.where("num is not null and size(name) > 0")  # noqa: E741
    pairs = candidates(l, r).distinct().join(sided(l, "l"), "l_rid").join(sided(r, "r"), "r_rid").where("l_num = r_num")
    met = compared(pairs).where("street_ok and coalesce(type_ok, true) and coalesce(dir_ok, true)")
    met = met.where("coalesce(code_ok, town_ok, false) and (code_ok is null or code_ok)").select("l_rid", "r_rid")
    return named(met, l, r)


def named(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """pairs with the ids of their rows in place of the numbers."""
    l, r = (x.select(F.col("rid").alias(f"{s}_rid"), F.col("id").alias(f"{s}_id")) for x, s in ((left, "l"), (right, "r")))  # noqa: E741
    return pairs.join(l, "l_rid").join(r, "r_rid").drop("l_rid", "r_rid")
