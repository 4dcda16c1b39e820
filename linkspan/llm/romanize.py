"""Latin skeletons of words in any script, from the names of their characters."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

_NAME = re.compile(r"^[A-Z ]*?(LETTER|VOWEL SIGN|SIGN) (.+)$")
_INDIC = re.compile("[\u0900-\u0dff]")
_FIXED = {"VIRAMA": "", "ANUSVARA": "n", "CANDRABINDU": "n", "VISARGA": "", "NUKTA": "", "BINDI": "n", "TIPPI": "n", "ADDAK": ""}


@lru_cache(maxsize=20_000)
def _sound(ch: str) -> tuple[str, str]:
    """(kind, sound): kind is c for a consonant letter, v for a vowel letter or sign, x for anything else."""
    m = _NAME.match(unicodedata.name(ch, ""))
    if not m:
        return "x", ""
    kind, name = m.groups()
    if kind == "SIGN" or name in _FIXED:
        return "x", _FIXED.get(name, "")
    name = name.split(" ")[-1].lower()
    if kind == "VOWEL SIGN" or name[:1] in "aeiou":
        return "v", "ri" if name == "r" else name
    name = name[:-1] if name.endswith("a") and len(name) > 1 else name
    name = re.sub(r"^(t|d|n|l|r)\1", r"\1", "sh" if name == "ss" else name)
    return "c", "ch" if name == "c" else name


def romanize(text: str) -> str:
    """text with Indic letters spelled in Latin: consonants by name, an `a` where no vowel sign or virama follows.

    Characters of other scripts stay as they are.
    """
    if text.isascii():
        return text
    out, pending = [], False
    for ch in text:
        if not 0x0900 <= ord(ch) < 0x0E00:
            if pending:
                pending = False
            out.append(ch)
            continue
        kind, sound = _sound(ch)
        if kind == "v":
            pending = False
            out.append(sound)
        elif kind == "c":
            if pending:
                out.append("a")
            out.append(sound)
            pending = True
        else:
            pending = pending and bool(sound)
            if pending:
                out.append("a")
                pending = False
            out.append(sound)
    return "".join(out)


def fold(text: str) -> str:
    """Lower-case letters without accents, Indic scripts romanized; other scripts keep their letters."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if _INDIC.search(text):
            text = romanize(text)
        text = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("ø", "o").replace("Ø", "o").replace("æ", "ae").replace("Æ", "ae").replace("œ", "oe"))
        if not text.isascii():
            text = "".join([c for c in text if c < "\u0300" or (not unicodedata.combining(c) and c not in "\u200b\u200c\u200d\ufeff")])
    return text.lower()


_GROUPS = [("ph", "f"), ("sh", "s"), ("ch", "1"), ("c", "k"), ("1", "c"), ("th", "t"), ("dh", "d"), ("kh", "k"), ("gh", "g"), ("bh", "b"), ("jh", "j"), ("zh", "j"), ("z", "j"), ("x", "ks"), ("w", "v"), ("q", "k"), ("ck", "k")]


@lru_cache(maxsize=200_000)
def skeleton(word: str) -> str:
    """Consonants of a folded word in one spelling: what stays the same between a name and its transliteration."""
    for a, b in _GROUPS:
        word = word.replace(a, b)
    word = re.sub(r"[aeiouyh]", "", word)
    return re.sub(r"(.)\1+", r"\1", word)
