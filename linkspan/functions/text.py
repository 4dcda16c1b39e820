"""Text scalars as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkspan.functions import regexes as R


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, which is worked out once however often f mentions it."""
    return F.element_at(F.transform(F.array(c), f), 1)


def trimmed(c: Column) -> Column:
    """Without space separators at either end (tabs and line ends stay)."""
    return F.regexp_replace(c, r"^\p{Zs}+|\p{Zs}+$", "")


def ascii_alnum(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-z0-9]", "")


def lowered(c: Column) -> Column:
    """Lower case letter by letter (a final sigma stays an ordinary one, a dotted capital I becomes i)."""
    return F.translate(F.lower(F.translate(c, "İ", "I")), "ς", "σ")


def present(c: Column) -> Column:
    return c.isNotNull() & (trimmed(c) != "")


def split_on_blank(c: Column) -> Column:
    """Pieces between single blanks after everything but a-z, 0-9 and blank became one."""
    return F.split(F.regexp_replace(lowered(trimmed(c)), "[^a-z0-9 ]", " "), " ", -1)


def words(c: Column, least: int = 1) -> Column:
    """Lower-case words (letters, digits, underscore) of `least` characters or more, in order and with repeats."""
    return F.filter(F.split(F.lower(c), R.NOT_WORD, -1), lambda w: F.length(w) >= least)


def alnum(c: Column) -> Column:
    """Lower-case letters and digits of any script."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def trigrams(c: Column, padded_short: bool = False) -> Column:
    """Distinct trigrams of ^text$; a text of under three characters is its own (only) gram unless padded_short."""
    padded = F.concat(F.lit("^"), c, F.lit("$"))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - 2, F.lit(1))), lambda i: F.substring(padded, i, F.lit(3))))
    short = F.length(padded) < 3 if padded_short else F.length(c) < 3
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).when(short, F.array(c)).otherwise(grams)


def without_zeros(c: Column) -> Column:
    """A string of digits without leading zeros; all zeros become one."""
    return F.regexp_replace(c, "^0+(?=.)", "")


def numbers(c: Column) -> Column:
    """Distinct whole-word numbers without leading zeros."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(R.DIGITS), F.lit(0)), without_zeros))


def first_number(c: Column) -> Column:
    """The first whole-word number without leading zeros, or null."""
    return without_zeros(F.nullif(F.regexp_extract(c, R.DIGITS, 0), F.lit("")))


def postal_codes(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(R.POSTAL), F.lit(0)))


def has_native(c: Column) -> Column:
    """Any character from U+0600 on."""
    return c.rlike(r"[\x{0600}-\x{10FFFF}]")


def script(c: Column) -> Column:
    """The script with the most letters: devanagari, tamil, gujarati, bengali or latin; the first of equals; `empty` for no text."""
    ranges = {"devanagari": r"\x{0900}-\x{097F}", "tamil": r"\x{0B80}-\x{0BFF}", "gujarati": r"\x{0A80}-\x{0AFF}", "bengali": r"\x{0980}-\x{09FF}", "latin": r"A-Za-z\x{00C0}-\x{024F}"}
    other = "[" + "".join(r for k, r in ranges.items() if k != "latin") + "]"
    counts = F.array(*[F.length(F.regexp_replace(c, f"[^{r}]+", "")) for r in ranges.values()])
    first = lambda n: F.when(F.array_max(n) == 0, "latin").otherwise(F.element_at(F.array(*map(F.lit, ranges)), F.array_position(n, F.array_max(n)).cast("int")))
    return F.when(c.isNull() | (F.length(c) == 0), "empty").when(~c.rlike(other), "latin").otherwise(once(counts, first))


def similarity(a: Column, b: Column) -> Column:
    """1 - Levenshtein distance / longer length; 1 for two empty strings."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def stripped_legal(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, R.LEGAL_UNICODE, ""), R.STRIP, "")


def stripped_domain(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, R.DOMAIN_UNICODE, ""), R.STRIP, "")


def stripped_prefix(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, R.PREFIX_UNICODE, ""), R.STRIP, "")
