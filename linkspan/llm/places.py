"""Postal addresses as number, street, town and code."""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from linkspan.llm.encoding import shortest
from linkspan.llm.romanize import fold, skeleton

# Words that address lines use around the street name, in their full forms. Abbreviations are
# mined from the data (see rewrites.py).
TYPES = "road street lane drive boulevard avenue court parkway terrace chowk cross marg rue place impasse quai allee chemin".split()
DIRECTIONS = "north south east west".split()
LANDMARKS = r"\b(?:opposite|opp|near|nr|next to|behind|beside)\b\.?\s+(?:[^\W\d_]+)\s+(?:[^\W\d_]+)"
UNITS = (
    r"\b(?:shop|office|flat|gala|unit|apartment|apt|suite|ste|room|rm|building|bldg|block|local|appartement|appt|batiment|bat|escalier|esc)\b\.?"
    r"(?:\s*(?:\bno\b|\bn|#)[.°º]*)?\s*#?\s*(?:[0-9]{1,4}(?![0-9])(?:-[a-z]\b|[a-z]\b)?|[a-z]\b)"
)
FLOORS = r"\b[0-9]+\s*(?:st|nd|rd|th|er|eme|e)?\s+(?:floor|etage)\b|\brdc\b|\bground floor\b|\brez-de-chaussee\b"
BOX = r"\b(?:po|p\.?\s?o\.?)\s+box\s+[0-9]+|\bbp\s+[0-9]+"
PARTICLES = frozenset("de du des la le les l d of the en sur".split())
COUNTRIES = frozenset("india us france usa cedex bharat".split())

_LANDMARKS, _UNITS, _FLOORS, _BOX = (re.compile(x) for x in (LANDMARKS, UNITS, FLOORS, BOX))
#: What is taken out of an address in this order, and parts of which each match has one: a quick look spares most searches.
_TAKEN_OUT = [
    (_BOX, ("box", "bp")), (_FLOORS, ("floor", "etage", "rdc", "chaussee")), (_LANDMARKS, ("opp", "near", "nr", "next", "behind", "beside")),
    (_UNITS, ("shop", "office", "flat", "gala", "unit", "ap", "suite", "ste", "room", "rm", "building", "bldg", "block", "local", "bat", "esc")),
]
_KIND = dict.fromkeys(PARTICLES, "p") | dict.fromkeys(DIRECTIONS, "d") | dict.fromkeys(TYPES, "t")
_BREAKS = re.compile(r"[,;|\n\r\t/()]+|\s[-–—]+\s")
_MARKED = re.compile(r"(?:\b(?:plot|d|door|house)\b[.\s]*)?(?:\bno(?![^\W\d_])|\bn[°º]|\bn(?=\s?[0-9]{1,4}\b)|[°º])[.°º\s]*#?\s*([0-9]{1,4}[a-z]?|[0-9]{5}(?=,?\s+[a-z]))\b(?!\s*-?[0-9])")
#: A look that is quicker than _MARKED and finds all of it but bare signs.
_MARK = re.compile(r"no?[.°º\s]*#?\s*[0-9]")
_HASH = re.compile(r"#\s*([0-9]{1,4}[a-z]?)\b")
_HASH_STREET = re.compile(r"#\s*([0-9]{1,4}[a-z]?)\b(?=,?\s*[^\W\d_]+\b\.?\s+[^\W\d_])")
_PLAIN = re.compile(r"(?<![0-9a-z])([0-9]{1,5}[a-z]?)(?![0-9a-z])")
_DIGITS = re.compile(r"[0-9]{5,}")
#: Right of a number of five digits, words of the same piece: a house number, if another number can be the code.
_BEFORE_WORDS = re.compile(r"[a-z]?\s+[^\W\d_]{2}")
_WORD = re.compile(r"[^\W\d_]+")
# The same looks for RE2 over a batch of ASCII texts: each finds at least what its pattern does.
_BLANK = r"[\t-\r\x1c-\x20]"
_LOOKS = [r"box|bp", r"floor|etage|rdc|chaussee", r"\b(?:opposite|opp|near|nr|next|behind|beside)\b", r"\b" + UNITS[UNITS.index("(") : UNITS.index(")") + 1] + r"\b"]
_MARK_LOOK = rf"no?[.\t-\r\x1c-\x20]*#?{_BLANK}*[0-9]"
#: What stands between segments after parsed_texts has put | for every break, and what a row begins or ends with.
_EMPTY = re.compile(r"\|(?:\s*\|)+")
_EDGES = "".join(map(chr, [*range(9, 14), *range(28, 33)])) + "|"
_LETTERS = str.maketrans({chr(i): " " for i in range(1, 128) if not chr(i).isalpha() and chr(i) != "|"})
_INDIC = re.compile(r"[\u0900-\u0dff\u200c\u200d]+")
#: Street types by the skeleton that their spelling in an Indic script leaves.
_TYPE_SKELETONS = {skeleton(w): w for w in ("road", "street", "lane", "chowk", "cross", "marg", "main")}


def parse(text: str | None) -> dict | None:
    """Number, code and words of an address in order, each word with its segment; null if there's no text.

    num is the house number without leading zeros, with its letter if it has one (null if none), code the postal code (null if none), words
    the folded words after units, floors, landmarks and country names are taken out, segs their segments,
    at the segment in which the number stands (-1 if none) and native the skeletons of words that were
    written in an Indic script.
    """
    if text is None or not text.strip():
        return None
    text = shortest(text)
    native = {fold(w) for w in _INDIC.findall(text)} if not text.isascii() else set()
    t = fold(text).replace("’", "'").replace("\xa0", " ")
    box = ("box" in t or "bp" in t) and _BOX.search(t)
    for pattern, parts in _TAKEN_OUT:
        for x in parts:
            if x in t:
                t = pattern.sub(" , ", t)
                break
    code = None
    codes = [m for m in _DIGITS.finditer(t) if len(m.group()) <= 6]
    if len(codes) > 1:
        codes = [m for m in codes if len(m.group()) == 6 or not _BEFORE_WORDS.match(t, m.end())] or codes[-1:]
    if codes:
        m = codes[0]
        code = m.group()
        t = t[: m.start()] + " \x01 " + t[m.end() :]
    num = None
    m = _MARKED.search(t) if _MARK.search(t) or "°" in t or "º" in t else None
    if m is None:
        m = _PLAIN.search(_HASH.sub(lambda h: " " * len(h.group(0)), t))
        if m is None:
            m = _HASH_STREET.search(t) or _HASH.search(t)
    if m:
        num = m.group(1).lstrip("0") or None
        t = t[: m.start()] + " \x02 " + t[m.end() :]
    words, segs, at = [], [], -1
    for s, seg in enumerate(x for x in _BREAKS.split(t) if x.strip()):
        if "\x02" in seg:
            at = s
        for w in _WORD.findall(seg.replace("'s", "s")):
            if w in COUNTRIES:
                continue
            if w in native:
                w = _TYPE_SKELETONS.get(skeleton(w), w)
            words.append(w)
            segs.append(s)
    return {"num": None if box and num is None else num, "code": code, "words": words, "segs": segs, "at": at, "native": sorted({skeleton(w) for w in native} - {""})}


def _numbered(t: str, marked: bool) -> tuple[str | None, str | None, str]:
    """Number and code of a folded ASCII text as parse() finds them, and the text with signs in their places."""
    code = None
    m = _DIGITS.search(t)
    if m:
        if len(m.group()) > 6 or _DIGITS.search(t, m.end()):
            codes = [m for m in _DIGITS.finditer(t) if len(m.group()) <= 6]
            if len(codes) > 1:
                codes = [m for m in codes if len(m.group()) == 6 or not _BEFORE_WORDS.match(t, m.end())] or codes[-1:]
            m = codes[0] if codes else None
        if m:
            code = m.group()
            t = t[: m.start()] + " \x01 " + t[m.end() :]
    m = _MARKED.search(t) if marked else None
    if m is None:
        if "#" in t:
            m = _PLAIN.search(_HASH.sub(lambda h: " " * len(h.group(0)), t)) or _HASH_STREET.search(t) or _HASH.search(t)
        else:
            m = _PLAIN.search(t)
    if m is None:
        return None, code, t
    return m.group(1).lstrip("0") or None, code, t[: m.start()] + " \x02 " + t[m.end() :]


def parsed_texts(texts: list[str | None]) -> list[tuple]:
    """The fields of PARSED of each text: those of parse(), for which all texts that fold to ASCII are searched together."""
    got, at, rows = [(None, None, "", -1, "")] * len(texts), [], []
    for i, text in enumerate(texts):
        if text is None or not text.strip():
            continue
        t = text
        if not text.isascii():
            t = shortest(text)
            t = text if _INDIC.search(t) else fold(t).replace("’", "'").replace("\xa0", " ")
        if t.isascii() and not ("\0" in t or "\x01" in t or "\x02" in t):
            at.append(i)
            rows.append(t.lower())
        else:
            g = parse(text)
            got[i] = (g["num"], g["code"], line_of(g["words"], g["segs"]), g["at"], " ".join(g["native"]))
    if not rows:
        return got
    folded = pa.array(rows)
    for (pattern, _), look in zip(_TAKEN_OUT, _LOOKS):
        for k in pc.indices_nonzero(pc.match_substring_regex(folded, look)).to_pylist():
            rows[k] = pattern.sub(" , ", rows[k])
    numbered = [_numbered(t, m) for t, m in zip(rows, pc.match_substring_regex(folded, _MARK_LOOK).to_pylist())]
    whole = _EMPTY.sub("|", _BREAKS.sub("|", "\0".join([x[2] for x in numbered])))
    rows = [t.strip(_EDGES) for t in whole.split("\0")]
    lines = "\0".join(rows).replace("'s", "s").replace("|", " | ").translate(_LETTERS).split("\0")
    for i, t, line, (num, code, _) in zip(at, rows, lines, numbered):
        here = t.find("\x02")
        words = [w for w in line.split() if w not in COUNTRIES]
        while words and words[-1] == "|":
            words.pop()
        got[i] = (num, code, " ".join(words), t.count("|", 0, here) if here >= 0 else -1, "")
    return got


def classify(words: list[str], segs: list[int], at: int, skeletons: bool = True) -> dict:
    """Street type, compass direction, street name and other words of an address whose words are in full form.

    The street is the run of words around a type word; without a type word, the words of the segment with
    the number, or of the one after it if the number stands alone. A type word counts only with a name word
    beside it in its segment. `main` before a type belongs to the type if a name word precedes it.
    """
    n = len(words)
    kind = [_KIND.get(w, "w") for w in words]
    best = None
    typed = [i for i, k in enumerate(kind) if k == "t"]
    for i in typed:
        first, end = i, i + 1
        while first and segs[first - 1] == segs[i]:
            first -= 1
        while end < n and segs[end] == segs[i]:
            end += 1
        before = "w" in kind[first:i]
        after = [j for j in range(i + 1, end) if kind[j] == "w"]
        french = i + 1 < end and kind[i + 1] == "p"
        score = (abs(segs[i] - at) if at >= 0 else 0, not (before or after), -i if before else i)
        if best is None or score < best[0]:
            best = (score, i, before, after, french)
    name: list[int] = []
    street_type = None
    if best is not None:
        _, i, before, after, french = best
        street_type = words[i]
        if french or not before:
            name = [j for j in after]
            if not name:
                name = [j for j in range(i + 1, n) if segs[j] == segs[i] + 1 and kind[j] == "w"][:2]
        else:
            j = i
            while j and segs[j - 1] == segs[i] and kind[j - 1] == "w":
                j -= 1
            name = [*range(j, i)]
            if len(name) >= 2 and words[name[-1]] == "main":
                street_type = "main " + street_type
                name.pop()
    elif at >= 0:
        name = [j for j in range(n) if segs[j] == at and kind[j] == "w"]
        if not name:
            name = [j for j in range(n) if segs[j] == at + 1 and kind[j] == "w"]
    every = [j for j in range(n) if kind[j] == "d"] if "d" in kind else []
    strict = []
    if every:
        run = set(name) | ({best[1]} if best is not None else set())
        beside = [j for j in every if run and (j + 1 in run or j - 1 in run) and (segs[j] in {segs[k] for k in run})]
        # After the street, a direction that more words follow may begin the name of a region.
        strict = [j for j in beside if j < max(run) or j + 1 >= n or segs[j + 1] != segs[j]]
    types = [words[j] for j in typed]
    others = [j for j in range(n) if kind[j] == "w" and j not in name]
    if street_type is not None and street_type.startswith("main "):
        others = [j for j in others if words[j] != "main"]
    rest = [words[j] for j in others]
    return {
        "type": street_type,
        "dir": words[strict[0]] if strict else None,
        "dirs": [words[j] for j in every],
        "name": [words[j] for j in name],
        "rest": rest,
        "town": [words[j] for j in others if segs[j] == segs[others[0]]],
        "types": types,
        "skeletons": [skeleton(words[j]) for j in name] if skeletons else [],
    }


_KINDS = {"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
#: words in order in a line, | between their segments, and the skeletons of native words: texts, since lists cost far more to move.
PARSED = "num string, code string, line string, at int, native string"
STREET = "words array<string>, native array<string>, type string, dir string, dirs array<string>, name array<string>, rest array<string>, town array<string>, types array<string>, skeletons array<string>"


def line_of(words: list[str], segs: list[int]) -> str:
    out, at = [], 0
    for w, s in zip(words, segs):
        while at < s:
            out.append("|")
            at += 1
        out.append(w)
    return " ".join(out)


def of_line(line: str, table: dict[str, str]) -> tuple[list[str], list[int]]:
    """The words of a line, rewritten by the table, and the segment of each."""
    words, segs, at = [], [], 0
    for w in line.split(" ") if line else ():
        if w == "|":
            at += 1
        else:
            words.append(table.get(w, w))
            segs.append(at)
    return words, segs


def parsed(df: DataFrame, key: str, text: str, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """(key, num, code, line, at, native) of each row's address, and the columns of `keep`; no words without an address."""
    kinds = [_KINDS[x.split(" ")[1]] for x in PARSED.split(", ")]
    names = [x.split(" ")[0] for x in PARSED.split(", ")]

    def run(batches):
        for b in batches:
            got = parsed_texts(b.column(1).to_pylist())
            arrays = [pa.array(c, k) for c, k in zip(zip(*got) if got else [()] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], *arrays], names=[key, *keep, *names])

    kept = "".join(f"`{c}` string, " for c in keep)
    return df.select(key, text, *keep).mapInArrow(run, f"`{key}` string, {kept}{PARSED}")


def streets(df: DataFrame, key: str, table: dict[str, str], skeletons: bool = True) -> DataFrame:
    """(key, num, code) and the fields of STREET from parsed rows, with words rewritten by the table.

    Only the side that is compared with Indic words needs skeletons.
    """
    fields = [(x.split(" ")[0], _KINDS[x.split(" ")[1]]) for x in STREET.split(", ")]

    def run(batches):
        for b in batches:
            got = []
            for line, at, native in zip(*(b.column(c).to_pylist() for c in ("line", "at", "native"))):
                words, segs = of_line(line, table)
                got.append(classify(words, segs, at, skeletons) | {"words": words, "native": native.split(" ") if native else []})
            arrays = [pa.array([g[n] for g in got], k) for n, k in fields]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in (key, "num", "code")] + arrays, names=[key, "num", "code", *[n for n, _ in fields]])

    return df.select(key, "num", "code", "line", "at", "native").mapInArrow(run, f"`{key}` string, num string, code string, {STREET}")
