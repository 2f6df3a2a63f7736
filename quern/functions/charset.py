"""Alphabets, the ordered character set, and the scripts of a token."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ordered character set.  The place of a character is its class.
ARMENIAN_UPPER = "".join(map(chr, range(0x0531, 0x0557)))
ARMENIAN_LOWER = "".join(map(chr, range(0x0561, 0x0587)))
LIGATURE = "և"
ARMENIAN_MARKS = "՝՛՞՜։֊«»"
DIGITS = "0123456789"
LATIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
COMMON_MARKS = ".,:;!?'\"()-–—/%&+=*"
LATER_MARKS = "․°…[]№²<>³±"
APOSTROPHE = "՚"
CYRILLIC_UPPER = "".join(map(chr, range(0x0410, 0x0430))) + "Ё"
CYRILLIC_LOWER = "".join(map(chr, range(0x0430, 0x0450))) + "ё"

#: Regular-expression classes of the alphabets' letters.
LETTERS = {"armenian": "Ա-Ֆա-և", "cyrillic": "А-Яа-яЁё", "latin": "A-Za-z"}


def charset(space: bool = True) -> str:
    """Every class in order; class 0, the blank, is not among them."""
    return ARMENIAN_UPPER + ARMENIAN_LOWER + LIGATURE + ARMENIAN_MARKS + DIGITS + LATIN + COMMON_MARKS + LATER_MARKS + APOSTROPHE + CYRILLIC_UPPER + CYRILLIC_LOWER + (" " if space else "")


def in_class(chars: str) -> str:
    """The inside of a regular-expression class of exactly these characters, valid in Java and RE2."""
    return "".join(rf"\x{{{ord(c):x}}}" for c in chars)


def ranges(chars: str) -> str:
    """``in_class`` of the characters with neighbours as ranges: Java tries each member of a class in turn."""
    found: list[list[int]] = []
    for c in sorted(set(map(ord, chars))):
        if found and found[-1][1] == c - 1:
            found[-1][1] = c
        else:
            found.append([c, c])
    return "".join(rf"\x{{{a:x}}}" if a == b else rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in found)


def characters(text: Column) -> Column:
    """The code points of text, in order."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def scripts_of(token: Column) -> Column:
    """The alphabets that token has letters of, by name."""
    return F.filter(F.array(*(F.when(token.rlike(f"[{c}]"), F.lit(n)) for n, c in sorted(LETTERS.items()))), lambda x: x.isNotNull())


def mixes_cyrillic(token: Column) -> Column:
    """Whether token has Cyrillic letters and letters of another alphabet."""
    others = "".join(c for n, c in LETTERS.items() if n != "cyrillic")
    return token.rlike(f"[{LETTERS['cyrillic']}]") & token.rlike(f"[{others}]")


def is_mixed_line(line: Column) -> Column:
    """Whether a line has both Armenian and Cyrillic letters, in whichever tokens."""
    return line.rlike(f"[{LETTERS['armenian']}]") & line.rlike(f"[{LETTERS['cyrillic']}]")


def strays(text: Column, allowed: str) -> Column:
    """The characters of text outside allowed, white space aside."""
    return F.regexp_extract_all(text, F.lit(rf"(?U)[^\s{ranges(allowed)}]"), F.lit(0))


def is_covered(label: Column, allowed: str) -> Column:
    """Whether label has only characters of allowed (set membership)."""
    return ~label.rlike(f"[^{ranges(allowed)}]")


def stamp(allowed: str) -> Column:
    return F.sha2(F.lit(allowed), 256)


def describe_gaps(gaps: Column) -> Column:
    """Missing characters as text; a whole Cyrillic alphabet is told by a phrase."""
    letters = CYRILLIC_UPPER + CYRILLIC_LOWER
    whole = F.array(*map(F.lit, letters))
    rest = F.array_join(F.array_sort(F.array_except(gaps, whole)), "")
    return F.when(F.size(F.array_intersect(gaps, whole)) == len(letters), F.trim(F.concat(rest, F.lit(" and all of Cyrillic")))).otherwise(F.array_join(F.array_sort(gaps), ""))


def any_token(words: Column, holds) -> Column:
    """Whether holds is true of any of an array's tokens; false of none."""
    return F.exists(words, lambda t: F.coalesce(holds(t), F.lit(False)))
