"""Patterns in the dialects that the engine needs.

Blocking keys follow RE2 (ASCII classes, `$` is the end of text); features follow Python's `re` (Unicode
classes). Spark's patterns are Java's, so each pattern is built here for the dialect whose results it must give.
"""

from __future__ import annotations

import re

# Legal forms at the end of a business name.
LEGAL_FORMS = [
    "private limited company", "limited liability company", "limited liability partnership", "public limited company",
    "private limited", "public limited", "pvt ltd", "pvt limited", "private ltd", "pub ltd", "pub limited",
    "corporation", "incorporated", "limited", "company", "corp", "inc", "llc", "llp", "plc", "ltd", "co", "pvt",
    "societe a responsabilite limitee", "societe par actions simplifiee unipersonnelle", "societe par actions simplifiee",
    "entreprise unipersonnelle a responsabilite limitee", "societe anonyme", "societe civile",
    "sarlu", "sasu", "sarl", "sas", "eurl", "sci", "snc", "sa", "ei", "et fils", "fils",
    "प्राइवेट लिमिटेड", "प्रा. लि.", "लिमिटेड", "एलएलपी",
]
# What may stand before a business name without telling it apart (each with the blanks after it).
PREFIX_WORDS = ["the", "dr", "smt", "m/s", "mr", "co", ">>"]
# Domains that mark a web address.
DOMAINS = "com org net in co io biz info gov edu ai us fr".split()

_ASCII_EDGE = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"
_WORD = r"\p{L}\p{N}_"
_UNICODE_EDGE = rf"(?:(?<![{_WORD}])(?=[{_WORD}])|(?<=[{_WORD}])(?![{_WORD}]))"
_UNICODE_BLANK = r"\s\x0B\x1C-\x1F\x85\p{Z}"


def _phrases(blank: str) -> str:
    """The legal forms as alternatives; a blank within one is any run of blanks, and none need follow a dot."""
    return "|".join(re.escape(p).replace(r"\.\ ", rf"\.{blank}*").replace(r"\ ", f"{blank}+") for p in LEGAL_FORMS)


def _legal(blank: str, inner: str, edge: str, end: str) -> str:
    return rf"(?:[,{inner}\-\(\[\#]+|{edge})({_phrases(blank)})(?:[,{inner}\.\)\]]*){end}"


def _prefix(blank: str) -> str:
    return "^(?:" + "|".join(re.escape(w) + f"{blank}+" for w in PREFIX_WORDS) + rf"|#{blank}*)"


#: For SQL engines that use RE2.
LEGAL_RE2 = _legal(r"\s", r"\s", r"\b", "$")
PREFIX_RE2 = _prefix(r"\s")
#: Java patterns that give RE2's results on lower-case text.
LEGAL_ASCII = _legal(r"[\t\n\f\r ]", r"\t\n\f\r ", _ASCII_EDGE, r"\z")
PREFIX_ASCII = _prefix(r"[\t\n\f\r ]")
#: Java patterns that give the results of Python's `re` with IGNORECASE.
LEGAL_UNICODE = "(?iu)" + _legal(f"[{_UNICODE_BLANK}]", _UNICODE_BLANK, _UNICODE_EDGE, "$")
PREFIX_UNICODE = "(?iu)" + _prefix(f"[{_UNICODE_BLANK}]")
DOMAIN_UNICODE = rf"(?iu)\.(?:{'|'.join(DOMAINS)}){_UNICODE_EDGE}|^www\."
NOT_WORD = rf"[^{_WORD}]+"
#: Whole words of digits only.
DIGITS = rf"(?<![{_WORD}])\p{{Nd}}+(?![{_WORD}])"
POSTAL = rf"(?<![{_WORD}])\p{{Nd}}{{5,6}}(?![{_WORD}])"
#: Unicode blanks that Python's str.strip takes off.
STRIP = rf"^[{_UNICODE_BLANK}]+|[{_UNICODE_BLANK}]+$"
