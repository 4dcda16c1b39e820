"""Text that was decoded with the wrong character encoding."""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkspan.plans.durable import durable

#: Single-byte charsets with which UTF-8 may have been read; undefined bytes stand for the control of the same number.
SINGLE = ["cp1252", "cp1250", "cp1251", "cp1253", "mac_roman", "cp437", "cp850", "koi8_r"]
#: Multi-byte charsets with which UTF-8 may have been read.
MULTI = ["gbk", "big5", "cp932", "cp949"]
#: (true, wrong) charsets of one byte a character each.
CROSS = [("cp1252", w) for w in ("mac_roman", "cp850", "cp437", "cp1251", "cp1250", "koi8_r", "cp1253")] + [(t, "cp1252") for t in ("mac_roman", "cp850", "cp437", "cp1251", "koi8_r", "cp1253")]
#: Deepest misreading (UTF-8 read as single bytes, again and again) with a prior of its own; deeper ones share it.
DEPTH = 3


def _repeated(charset: str, k: int) -> str:
    """Name of the chain in which UTF-8 was read as charset k times."""
    return f"utf8>{charset}" + ("" if k == 1 else f" x{k}" if k < DEPTH else f" x{DEPTH}+")


#: Chains by number. 0: correct text; 1: damaged beyond repair.
CHAINS = ["none", "lost", *[_repeated(w, k) for w in SINGLE for k in range(1, DEPTH + 1)], *[f"utf8>{w}" for w in MULTI], *[f"{t}>{w}" for t, w in CROSS]]
NUMBER = {c: i for i, c in enumerate(CHAINS)}
BUCKETS = 1 << 16
#: EM ends when a round raises the log likelihood by less than this share, or at last after so many rounds.
GAIN = 1e-3
MOST_ROUNDS = 50
ALPHA = 0.02
EXPECTED = 2.0


@lru_cache(maxsize=None)
def _to_byte(charset: str) -> dict[str, int]:
    table = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(charset)
        except UnicodeDecodeError:
            c = chr(b)
        table[c] = b
    if charset == "cp1252":
        table |= {chr(b): b for b in range(128, 160) if chr(b) not in table}
    return table


@lru_cache(maxsize=200_000)
def _choices(ch: str, charset: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(lead bytes, continuation bytes) that ch may stand for, also after a change of case.

    A blank may have been a no-break space within a sequence; a no-break space begins none.
    """
    table = _to_byte(charset)
    forms = [ch, ch.upper(), ch.lower()] if len(ch.upper()) == 1 == len(ch.lower()) else [ch]
    found = list(dict.fromkeys(table[f] for f in forms if f in table))
    if ch == " " and "\xa0" in table:
        found.append(table["\xa0"])
    return tuple(b for b in found if 0xC2 <= b <= 0xF4 and ch != "\xa0"), tuple(b for b in found if 0x80 <= b <= 0xBF)


#: Where a run can begin: only characters beyond ASCII and blanks stand for continuation bytes.
_RUN = re.compile(r"[^\x00-\x7f][^\x00-\x1f!-\x7f]")


@lru_cache(maxsize=None)
def _cased() -> list[tuple[str, str, str]]:
    return [(c, c.upper(), c.lower()) for c in map(chr, range(0x80, 0x10000)) if c.upper() != c or c.lower() != c]


@lru_cache(maxsize=None)
def _readable(charset: str) -> re.Pattern:
    """Finds a lead and a continuation side by side, without which unread() changes nothing."""
    table = _to_byte(charset)
    chars = [" ", *table, *(c for c, u, l in _cased() if u in table or l in table)]  # noqa: E741
    leads, rest = ("".join(c for c in chars if _choices(c, charset)[k]) for k in (0, 1))
    return re.compile(f"[{re.escape(leads)}][{re.escape(rest)}]")


def unread(text: str, charset: str) -> str:
    """text with every run that is UTF-8 read as `charset` decoded; the rest as it is."""
    out, i, n = [], 0, len(text)
    while m := _RUN.search(text, i):
        out.append(text[i : m.start()])
        i = m.start()
        done = False
        for lead in _choices(text[i], charset)[0]:
            size = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            if i + size > n:
                continue
            rest = [_choices(text[j], charset)[1] for j in range(i + 1, i + size)]
            if not all(rest):
                continue
            try:
                ch = bytes([lead, *[r[0] for r in rest]]).decode("utf-8")
            except UnicodeDecodeError:
                continue
            if " " in text[i + 1 : i + size] and (ch == "\xa0" or lead != _to_byte(charset).get(text[i])):
                continue
            out.append(ch)
            i += size
            done = True
            break
        if not done:
            out.append(text[i])
            i += 1
    return "".join([*out, text[i:]])


def _plausible(text: str) -> bool:
    """No character that text of any script would not hold."""
    return not any(0x80 <= ord(c) < 0xA0 or unicodedata.category(c) in ("Co", "Cn", "Cs") for c in text if c > "\x7f")


def restorations(text: str) -> list[tuple[int, str]]:
    """(chain, text before it) for every chain that could have led to the text and undoes something."""
    out: dict[str, int] = {}
    for w in SINGLE:
        x, k = text, 0
        while (y := unread(x, w)) != x:  # each step leaves fewer characters, so it ends
            k += 1
            out.setdefault(y, NUMBER[_repeated(w, min(k, DEPTH))])
            x = y
    for w in MULTI:
        try:
            y = text.encode(w).decode("utf-8")
        except UnicodeError:
            continue
        if y != text:
            out.setdefault(y, NUMBER[f"utf8>{w}"])
    for t, w in CROSS:
        there = _to_byte(w)
        # Words of two letters or more of the charset's own script are that script.
        if w in ("cp1251", "koi8_r", "cp1253") and any(a > "\u036f" and b > "\u036f" and a in there and b in there and a.isalpha() and b.isalpha() for a, b in zip(text, text[1:])):
            continue
        y = "".join(bytes([there[c]]).decode(t, "replace") if c in there and c > "\xa0" else c for c in text)
        if y != text and "�" not in y and y.count("\xa0") == text.count("\xa0"):
            out.setdefault(y, NUMBER[f"{t}>{w}"])
    return [(k, y) for y, k in out.items() if _plausible(y) or CHAINS[k].startswith("utf8>")]


def shortest(text: str) -> str:
    """The shortest plausible text that comes of undoing UTF-8 read as one of SINGLE; the text itself if none is shorter.

    A quick guess for operators that normalise values one by one; repairs() weighs the evidence of all records.
    """
    if text.isascii() or not _RUN.search(text) or not any("\x80" <= c < "\u2600" and not "\u0370" <= c < "\u1e00" or "\u0400" <= c < "\u0460" for c in text):
        return text
    best = text
    for w in SINGLE:
        x = text
        while _readable(w).search(x) and (y := unread(x, w)) != x:
            if len(y) < len(best) and _plausible(y) and not any("\u0180" <= c < "\u0300" for c in y):
                best = y
            x = y
    return best


@lru_cache(maxsize=100_000)
def _class(ch: str) -> str:
    if ch < "\x80":
        return "l" if ch.islower() else "u" if ch.isupper() else "d" if ch.isdigit() else "^" if ch.isspace() else "p"
    kind = unicodedata.category(ch)
    if kind[0] in "ZPSC":
        return "^" if kind[0] == "Z" else "s"
    script = unicodedata.name(ch, "?").split(" ")[0]
    if script == "LATIN":
        return "l" if ch.islower() else "u"
    return {"COMBINING": "m", "GREEK": "g", "CYRILLIC": "c"}.get(script, script[:4])


def evidence(text: str) -> list[int]:
    """Two buckets for each character beyond ASCII: the character, and its class, each with its neighbours' classes. Each once."""
    classes = ["^", *[_class(c) for c in text], "^"]
    out = []
    for i, c in enumerate(text):
        if c > "\x7f":
            around = f"{classes[i]}{{}}{classes[i + 2]}"
            out += [_bucket(around.format(x)) for x in (c, f"<{classes[i + 1]}>")]
    return list(dict.fromkeys(out))


def _bucket(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "replace")) % BUCKETS


def _expected() -> dict[int, float]:
    """Counts to start from: letters stand beside letters of their kind, or at the end of a word."""
    kinds = ["l", "u", "g", "c", "m", "DEVA", "BENG", "GUJA", "GURM", "TAMI", "TELU", "KANN", "MALA", "ARAB", "CJK", "HIRA", "KATA", "HANG", "THAI", "HEBR"]
    near = {"l": "lu", "u": "ul"}
    out = {}
    for k in kinds:
        beside = [k, *near.get(k, "")]
        for a, b in [*((x, y) for x in beside for y in beside), *((x, e) for x in beside for e in "^p"), *((e, y) for e in "^p" for y in beside)]:
            out[_bucket(f"{a}<{k}>{b}")] = EXPECTED
    return out


def hopeless(text: str) -> bool:
    """Whether the text can't be correct: it holds the replacement character or a control of 0x80 to 0x9F."""
    return any(c == "�" or "\x80" <= c < "\xa0" for c in text)


_TABLE = "grp string, field string, value string, n long, chains array<int>, texts array<string>, evidence array<array<int>>"


def _candidates(batches):
    for b in batches:
        rows = {"grp": b.column(0), "field": b.column(1), "value": b.column(2), "n": b.column(3), "chains": [], "texts": [], "evidence": []}
        for value in b.column(2).to_pylist():
            found = [(1, None) if hopeless(value) else (0, value), *restorations(value)]
            rows["chains"].append([k for k, _ in found])
            rows["texts"].append([t for _, t in found])
            rows["evidence"].append([evidence(value if t is None else t) for _, t in found])
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("grp", pa.string()), ("field", pa.string()), ("value", pa.string()), ("n", pa.int64()), ("chains", pa.list_(pa.int32())), ("texts", pa.list_(pa.string())), ("evidence", pa.list_(pa.list_(pa.int32())))]))


def _starts(lists: pa.ListArray) -> np.ndarray:
    """Where each list begins among all items, and the end."""
    return np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])


class Model:
    """Log priors of the chains per group of values, and the log distribution of evidence in correct text."""

    def __init__(self, groups: dict[str, int], priors: np.ndarray, theta: np.ndarray | None) -> None:
        self.groups, self.priors, self.theta = groups, priors, theta

    def weigh(self, b: pa.RecordBatch):
        """(chain, posterior, value) of each candidate of a batch, its evidence and starts, and each value's log likelihood.

        Without theta, evidence is not weighed yet. A value beyond repair stays so only if no chain explains it.
        """
        column = lambda name: b.column(b.schema.get_field_index(name))
        chains, ev = column("chains"), column("evidence")
        begin, k = _starts(chains), chains.flatten().to_numpy()
        each = ev.flatten()
        at, items = _starts(each), each.flatten().to_numpy()
        value = np.repeat(np.arange(len(chains)), np.diff(begin))
        group = np.array([self.groups[g] for g in column("grp").to_pylist()], int)
        logs = self.priors[group[value], k]
        if self.theta is not None:
            upto = np.concatenate([[0.0], np.cumsum(self.theta[items])])
            logs = np.where(k == 1, -1e6, logs + upto[at[1:]] - upto[at[:-1]])
        top = np.maximum.reduceat(logs, begin[:-1])
        raw = np.exp(logs - top[value])
        total = np.add.reduceat(raw, begin[:-1])
        return k, raw / total[value], value, group, items, at, begin, top + np.log(total)


def _fit(table: DataFrame) -> Model:
    """EM over the candidates: which chain each value went through, and what correct text looks like.

    A round adds up expected counts by chain and by evidence bucket, at most groups x chains + BUCKETS sums, and the
    log likelihood; the rounds end when it hardly rises.
    """
    groups = {r["grp"]: i for i, r in enumerate(table.select("grp").distinct().orderBy("grp").collect())}
    chains = len(CHAINS)
    start = np.array([0.7 if k == 0 else 0.3 / chains for k in range(chains)])
    expected = np.zeros(BUCKETS)
    for v, x in _expected().items():
        expected[v] = x
    model, before = Model(groups, np.tile(np.log(start), (len(groups), 1)), None), -math.inf
    for _ in range(MOST_ROUNDS if groups else 0):

        def expect(batches, model=model):
            by_chain, by_bucket, likelihood = np.zeros(len(model.groups) * chains), np.zeros(BUCKETS), 0.0
            for b in batches:
                if not b.num_rows:
                    continue
                k, w, value, group, items, at, _, logs = model.weigh(b)
                n = b.column(b.schema.get_field_index("n")).to_numpy()
                w = w * n[value]
                by_chain += np.bincount(group[value] * chains + k, w, len(by_chain))
                by_bucket += np.bincount(items, np.repeat(np.where(k == 1, 0.0, w), np.diff(at)), BUCKETS)
                likelihood += float((logs * n)[logs > -1e5].sum())
            kinds = [(name, np.flatnonzero(sums), sums) for name, sums in (("chain", by_chain), ("bucket", by_bucket))]
            yield pa.RecordBatch.from_pydict(
                {"f": [name for name, some, _ in kinds for _ in some] + ["likelihood"], "v": [int(v) for _, some, _ in kinds for v in some] + [0], "s": [float(sums[v]) for _, some, sums in kinds for v in some] + [likelihood]},
                schema=pa.schema([("f", pa.string()), ("v", pa.int32()), ("s", pa.float64())]),
            )

        got = table.select("grp", "n", "chains", "evidence").mapInArrow(expect, "f string, v int, s double").groupBy("f", "v").agg(F.sum("s").alias("s")).collect()
        counts, own, likelihood = expected.copy(), np.zeros(len(groups) * chains), 0.0
        for f, v, x in got:
            if f == "bucket":
                counts[v] += x
            elif f == "chain":
                own[v] = x
            else:
                likelihood = x
        own = own.reshape(len(groups), chains)
        priors = (own + start) / (own.sum(axis=1, keepdims=True) + 1.0)
        weighed = model.theta is not None
        model = Model(groups, np.log(priors), np.log((counts + ALPHA) / (counts.sum() + ALPHA * BUCKETS)))
        if weighed:
            if likelihood - before <= GAIN * abs(likelihood):
                break
            before = likelihood
    return model


def repairs(df: DataFrame, key: str, fields: list[str], source: str | None = None) -> DataFrame:
    """(key, field, value, repaired, chain, posterior) of the values that were decoded with a wrong encoding.

    Every value beyond ASCII is a mixture: it is correct, or went through one of CHAINS (a charset read as
    another, or the same one time after time, in the whole value or in parts of it). For each chain that could have led to the
    value its former text is worked out. EM pools the evidence of all records: how common each chain is in
    each field of each source (the column `source`, a handful of values; without it df is one source), and which
    characters stand in which surroundings in correct text; a value is
    damaged if correct text is the less likely explanation, and its repair is the former text of the likeliest chain.

    Values that hold the replacement character or stray controls are damaged in any case; repaired is null if
    no chain explains them, and holds what can be had if parts are lost. Correct text of any script is
    kept by its own frequency. Null and ASCII values are correct; a null source is a source. Distinct values are weighed once, with the
    number of rows that have them. df holds one row per record; an empty input gives no rows.
    """
    field = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")
    origin = F.coalesce(F.col(source).cast("string"), F.lit("")) if source else F.lit("")
    values = df.select(F.col(key), origin.alias("_source"), field).select(key, F.concat_ws("\x1f", "_source", "x.field").alias("grp"), "x.field", "x.value").where(r"value rlike '[^\\x00-\\x7f]'")
    distinct = values.groupBy("grp", "field", "value").agg(F.count("*").alias("n"))
    distinct = distinct.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "field", "value")  # Python work: as many tasks, however few bytes
    table = durable(distinct.mapInArrow(_candidates, _TABLE))
    model = _fit(table)

    def decide(batches):
        for b in batches:
            rows = {"grp": [], "value": [], "repaired": [], "chain": [], "posterior": []}
            if b.num_rows:
                k, w, _, _, _, _, begin, _ = model.weigh(b)
                fine = np.where(k[begin[:-1]] == 0, w[begin[:-1]], 0.0)
                grp, value, texts = (b.column(b.schema.get_field_index(c)) for c in ("grp", "value", "texts"))
                for i in np.flatnonzero(fine < 0.5):
                    cands = range(begin[i], begin[i + 1])
                    best = max((j for j in cands if k[j] != 0), key=lambda j: w[j])
                    rows["grp"].append(grp[i].as_py())
                    rows["value"].append(value[i].as_py())
                    rows["repaired"].append(texts[i].as_py()[best - begin[i]])
                    rows["chain"].append(CHAINS[k[best]])
                    rows["posterior"].append(float(1 - fine[i]))
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("grp", pa.string()), ("value", pa.string()), ("repaired", pa.string()), ("chain", pa.string()), ("posterior", pa.float64())]))

    found = table.select("grp", "value", "chains", "texts", "evidence").mapInArrow(decide, "grp string, value string, repaired string, chain string, posterior double")
    return values.join(found, ["grp", "value"]).select(key, "field", "value", "repaired", "chain", "posterior")
