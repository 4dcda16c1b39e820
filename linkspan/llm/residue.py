"""Template residue, filler, error messages and notices that scripts are required."""

from __future__ import annotations

import hashlib
import re
from http import HTTPStatus

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkspan.plans.durable import durable

# How template languages write a slot.
SLOTS = {
    "double_brace": r"\{\{[^{}\n]{1,60}\}\}",
    "brace_percent": r"\{%[^%\n]{1,60}%\}",
    "percent": r"%%[^%\s]{1,40}%%",
    "dollar": r"\$\{[^}\n]{1,40}\}",
    "double_bracket": r"\[\[[^\]\n]{1,40}\]\]",
    "angle": r"<%=?[^%\n]{1,60}%>",
    "at": r"@@[^@\s]{1,40}@@",
    "hash": r"#[A-Z][A-Z_.]{2,40}#",
    "underscore": r"__[A-Z][A-Z_.]+?__",
    "prompt": r"\[(?i:your|insert)\b[^\]\n]{0,40}\]",
    "x_marks": r"\bXX_[A-Z_.]+_XX\b",
    "brace": r"\{[a-z][a-z_.]{1,30}\}|\{[A-Z][A-Z_.]{2,30}\}",
    "star_bar": r"\*\|[^|\s]{1,40}\|\*",
    "double_angle": r"<<[A-Za-z][\w. ]{1,40}>>",
    "one_percent": r"%[A-Z][A-Z_.]{2,30}%",
    "bracket_percent": r"\[%[^%\n]{1,40}%\]",
    "capitals": r"\[[A-Z][A-Z_]{2,30}\]|<[A-Z][A-Z_]{2,30}>|~[A-Z][A-Z_]{2,30}~",
    "empty_value": r"\[object Object\]|\bundefined\b(?! function)|\bNaN\b|\bnull\b",
}
# Words of the usual filler text, and keyboard or marker filler.
LOREM = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis "
    "nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur "
    "excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
MARKERS = frozenset("tbd todo test asdf qwer qwerty foo bar baz xxx lorem ipsum".split())
#: Words of a line outside its slots from which it may be a sentence about slots.
PROSE_WORDS = 8
#: A line of its own longer than this is content by itself; its key is a digest.
LONG = 200
#: A line is a message if it occurs in this many hosts and texts, and this share of them has no content of its own.
HOSTS, TEXTS, SHARE = 3, 4, 0.6
#: A line is a page's own content if it occurs in this many distinct texts at most (mirrors, second fetches).
OWN = 3
#: A line that has fewer different lines before it or after it belongs to one story, however many mirrors tell it.
COMPANY = 3
#: Pages whose three longest lines agree, of this length at least, are mirrors of one another.
MIRRORED = 35
#: Most message keys that are broadcast; beyond it they meet the lines in a join.
MOST_BROADCAST = 100_000
#: What a server itself says: the reason phrases of HTTP errors, and the name of the scripts that a notice asks for.
SIGNS = re.compile("|".join(re.escape(x) for x in sorted({x.phrase.lower() for x in HTTPStatus if x >= 400 and " " in x.phrase} | {"javascript"})))

_SLOTS = [(name, re.compile(p)) for name, p in SLOTS.items()]
_LETTERS = re.compile(r"[^\W\d_]+")
_SLUG = re.compile(r"(?:\w+:)?(?://[^/?#]*)?(?:[^?#]*/)?([^/?#]*)")
_NUMBERS = re.compile(r"\d+")
_LATIN = re.compile(r"[^a-z0□]+")


def key_of(line: str) -> str:
    """What stays of a line when case, numbers, punctuation and (in Latin lines) letters beyond ASCII are left out."""
    low = _NUMBERS.sub("0", line.lower())
    latin = _LATIN.sub(" ", low).strip()
    key = latin if len(latin) * 2 > len(low) else low.strip()
    words = key.split(" ")
    for n in (1, 2, 3, 4, 5, 6, 7):  # a phrase said over and over counts once
        if len(words) > n and len(words) % n == 0 and words == words[:n] * (len(words) // n):
            return " ".join(words[:n])
    return key


def digest(text: str) -> bytes:
    """128 bits that stand for a text."""
    return hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=16).digest()


def is_filler(words: list[str]) -> bool:
    """Nearly all words are of the filler text, or all are markers."""
    if not words:
        return False
    if all(w in MARKERS for w in words):
        return True
    return len(words) >= 4 and sum(w in LOREM for w in words) >= 0.8 * len(words)


def slots_of(line: str) -> tuple[str, list[str]]:
    """(line with each slot as a mark, slot styles in it)."""
    if not any(c in line for c in "{}%$[]<@#_X*~uNn"):
        return line, []
    styles = []
    for name, p in _SLOTS:
        new = p.sub("□", line)
        if new != line:
            styles.append(name)
            line = new
    return line, styles


def examine(url: str | None, text: str | None) -> dict:
    """Lines of a page: their keys in order and what they may be, slot lines, filler, and which lines name the address slug."""
    out = {"keys": [], "spoken": [], "longs": [], "skeletons": [], "styles": [], "outside": [], "filler": False, "sign": False, "long": False, "echoes": []}
    lines = [x.strip() for x in (text or "").split("\n")]
    lines = [x for x in lines if x]
    slug = set(w for w in _LETTERS.findall(_SLUG.match(url or "")[1].lower()) if len(w) >= 4)
    foot = len(lines)
    while foot > max(1, len(lines) - 2) and lines[foot - 1][-1] not in ".!?。।…":
        foot -= 1
    for i, line in enumerate(lines):
        masked, styles = slots_of(line)
        if styles:
            rest = masked.replace("□", " ")
            words = _LETTERS.findall(rest)
            if styles == ["empty_value"] and (masked.count("□") < 2 or len(words) >= PROSE_WORDS):
                styles = []
            else:
                out["skeletons"].append(digest(" ".join(_LETTERS.findall(re.sub(r"\b[A-Z][a-z]+\b", "", masked)) + [str(masked.count("□"))]).lower()))
                out["styles"].append(",".join(styles))
                out["outside"].append(len(words))
                if len(words) < PROSE_WORDS:
                    continue
        low = line.lower()
        words = _LETTERS.findall(low)
        if is_filler(words):
            out["filler"] = True
            continue
        key = key_of(line)
        if not key:
            continue
        long = len(line) > LONG
        if long:
            if len(set(line)) <= 5:
                continue
            key = "\x02" + digest(key).hex()
            out["long"] = True
        sign = not long and SIGNS.search(low) is not None
        out["sign"] |= sign
        footer = i >= len(lines) - 2 and line[-1] not in ".!?。।…"
        out["keys"].append(key)
        out["longs"].append(long)
        out["spoken"].append(long or not footer and not sign and (len(words) >= 3 or not line.isascii() and len(line) >= 8))
        if i < foot and not sign and not slug.isdisjoint(words):
            out["echoes"].append(key)
    longest = sorted((k for k in set(out["keys"]) if len(k) >= MIRRORED or k[0] == "\x02"), key=lambda k: (k[0] != "\x02", -len(k), k))[:3]
    out["copy"] = digest("\n".join(longest) if len(longest) == 3 else text or "")
    return out


_FIELDS = [("keys", pa.list_(pa.string())), ("spoken", pa.list_(pa.bool_())), ("longs", pa.list_(pa.bool_())), ("skeletons", pa.list_(pa.binary())), ("styles", pa.list_(pa.string())), ("outside", pa.list_(pa.int32())), ("filler", pa.bool_()), ("sign", pa.bool_()), ("echoes", pa.list_(pa.string()))]
_SCHEMA = "keys array<string>, spoken array<boolean>, longs array<boolean>, skeletons array<binary>, styles array<string>, outside array<int>, filler boolean, sign boolean, echoes array<string>"


def residue(df: DataFrame, key: str = "doc_id", text: str = "text", url: str = "url", host: str = "host") -> DataFrame:
    """(key, reason) of the texts that are template residue (`slots`) or nothing but filler, errors or notices (`empty`).

    Slots: a line with unfilled slots counts unless it is a sentence about slots. Lines that differ in their
    slots only are one skeleton; a skeleton met with several slot styles is a template's, and so is one of few
    words; a long one that always carries the same style is prose.

    Empty responses: title, address slug and body are set against what other hosts say. A line is a page's own
    if it stands in a few distinct texts at most, or always between the same lines (mirrors of one story); the
    first of a page's own lines is its title. A page has content if it has
    more than a title of its own, a line of its own after a message, a long line of its own, or names its address slug (without
    query and fragment) in a line of its own that is no filler, menu or footer. Where slug and title don't fit the body, a line that many
    hosts share is a message if most pages with it have no content. So is a line that a few pages of several hosts share,
    whose titles and own lines beside it all differ, if none of these has content. Filler is told by its words, and a line too rare for
    all this by a server's own reason phrase. A page without content that says a message or filler is empty.

    Copies count once: equal texts, and pages that agree in their three longest lines. Null and blank texts are no case; a null host
    or url is a host or url of its own. Keys that occur twice come out once. An empty input gives no rows.
    """
    rows = df.select(F.col(key).alias("id"), F.coalesce(F.col(host), F.lit("")).alias("host"), F.col(url).alias("url"), F.col(text).alias("text")).where(r"text is not null and text rlike '\\S'")

    def run(batches):
        for b in batches:
            got = [examine(u, t) for u, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            arrays = [pa.array([g[n] for g in got], k) for n, k in _FIELDS]
            copy = pa.array([g["copy"] for g in got], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), copy, *arrays], names=["id", "host", "copy", *[n for n, _ in _FIELDS]])

    kind = df.schema[key].dataType.simpleString()
    pages = durable(rows.mapInArrow(run, f"id {kind}, host string, copy binary, {_SCHEMA}").withColumn("page", F.monotonically_increasing_id()))

    skeletons = pages.select("id", F.explode(F.arrays_zip("skeletons", "styles", "outside")).alias("s")).select("id", "s.*")
    template = skeletons.groupBy("skeletons").agg(F.size(F.collect_set("styles")).alias("n_styles"))
    short = skeletons.where(F.col("outside") < PROSE_WORDS).select("id")
    varied = skeletons.where(F.col("outside") >= PROSE_WORDS).join(template.where("n_styles >= 3").select("skeletons"), "skeletons", "left_semi").select("id")
    slots = short.unionAll(varied).distinct().withColumn("reason", F.lit("slots"))

    one = pages.where("size(keys) > 0").groupBy("copy", "host").agg(F.first(F.struct("keys", "spoken", "longs")).alias("p"))
    around = [F.xxhash64(F.coalesce(F.expr(f"get(p.keys, pos {step} 1)"), F.lit(""))).alias(name) for step, name in (("-", "before"), ("+", "after"))]
    lines = one.select("copy", "host", "p", F.posexplode(F.arrays_zip("p.keys", "p.spoken", "p.longs")).alias("pos", "x")).select("copy", "host", F.xxhash64("x.keys").alias("k"), "pos", F.col("x.spoken").alias("spoken"), F.col("x.longs").alias("long"), *around)
    lines = durable(lines.groupBy("copy", "host", "k").agg(F.min(F.struct("pos", "before", "after")).alias("at"), F.max("spoken").alias("spoken"), F.max("long").alias("long")).select("copy", "host", "k", "at.*", "spoken", "long"))
    texts = lines.groupBy("k", "copy").agg(F.max("spoken").alias("spoken"), F.min("pos").alias("pos"))
    distinct = lambda c, name: lines.select("k", c).distinct().groupBy("k").agg(F.count("*").alias(name))
    edge = F.xxhash64(F.lit(""))
    edges = lines.groupBy("k").agg(F.bool_or(F.col("before") == edge).alias("first"), F.bool_or(F.col("after") == edge).alias("last"))
    by_key = texts.groupBy("k").agg(F.count("*").alias("texts")).join(edges, "k")
    by_key = durable(by_key.join(distinct("before", "befores"), "k").join(distinct("after", "afters"), "k").join(distinct("host", "hosts"), "k"))
    # At the edge of a page nothing is told by a missing neighbour; a line of one or two hosts is their menu, not a mirrored story.
    story = (~F.col("first") & (F.col("befores") < COMPANY)) | (~F.col("last") & (F.col("afters") < COMPANY))
    theirs = (F.col("texts") <= OWN) | (story & (F.col("hosts") >= HOSTS))
    seldom = durable(by_key.where(theirs & ~story & (F.col("texts") > 1) & (F.col("hosts") > 1)).select("k"))
    mirrored = None
    for side in ("before", "after"):  # copies of a story agree in a line of its own beside it, too
        beside = lines.join(seldom, "k", "left_semi").select("copy", "k", side).distinct().groupBy("k", side).count().where("count > 1")
        beside = beside.join(by_key.where(theirs).select(F.col("k").alias(side)), side, "left_semi").select("k")
        mirrored = beside if mirrored is None else mirrored.unionByName(beside)
    roaming = durable(seldom.join(mirrored, "k", "left_anti"))
    theirs_keys = durable(by_key.where(theirs).select("k").join(roaming, "k", "left_anti"))
    common = by_key.where(~theirs & (F.col("hosts") >= HOSTS) & (F.col("texts") >= TEXTS)).select("k", F.lit(SHARE).alias("least")).unionByName(roaming.withColumn("least", F.lit(1.0)))

    # A long line counts as two. The slug counts for the page that bears it, not for its copies, and only in lines of its own.
    own_lines = durable(lines.where("spoken").join(theirs_keys, "k", "left_semi").groupBy("copy", "k").agg(F.min("pos").alias("pos"), F.max("long").alias("long")))
    own = own_lines.groupBy("copy").agg(F.sum(F.when(F.col("long"), 2).otherwise(1)).alias("own"))
    thin = pages.join(own, "copy", "left").where("coalesce(own, 0) < 2")
    echo = thin.select("page", F.explode(F.array_distinct("echoes")).alias("k")).select("page", F.xxhash64("k").alias("k")).join(theirs_keys, "k", "left_semi")
    bare = durable(thin.select("page", "id", "copy", "filler", "sign").join(echo.select("page").distinct(), "page", "left_anti"))
    counts = bare.groupBy("copy").agg(F.count("*").alias("bare"))
    share = pages.groupBy("copy").agg(F.count("*").alias("pages")).join(counts, "copy").select("copy", (F.col("bare") / F.col("pages")).alias("bare"))
    told = texts.join(share, "copy", "left").groupBy("k").agg(F.count("*").alias("n"), F.sum(F.coalesce("bare", F.lit(0.0))).alias("bare"))
    message = durable(told.join(common, "k").where("bare >= least * n").select("k"))
    if message.count() <= MOST_BROADCAST:
        message = F.broadcast(message)
    bare_copies = bare.select("copy").distinct()
    says = durable(lines.join(message, "k", "left_semi").join(bare_copies, "copy", "left_semi").groupBy("copy").agg(F.min("pos").alias("first")))
    goes_on = own_lines.join(says, "copy").where("pos > first").select("copy").distinct()
    state = bare_copies.join(goes_on, "copy", "left_anti").join(says.select("copy", F.lit(True).alias("says")), "copy", "left")
    empty = bare.join(state, "copy").where("says or filler or sign").select("id").distinct().withColumn("reason", F.lit("empty"))
    both = slots.unionByName(empty.join(slots.select("id"), "id", "left_anti"))
    return both.select(F.col("id").alias(key), "reason")
