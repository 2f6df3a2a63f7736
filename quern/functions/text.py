"""Scalar operators on text: cleaning, normalising, tokens, names.  Each maps columns to columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .arrays import let
from .charset import LETTERS

A = LETTERS["armenian"]
#: A word character: a letter, a digit of any kind, or the underscore.
W = r"[\p{L}\p{N}_]"

# Marks that stand for others in transcripts.
SUBSTITUTIONS = (("−", "–"), ("―", "—"), ("\ufeff", ""), ("\xad", ""), ("¬", "-"), ("ﬓ", "մն"))
MARKS = ("’ˈ`′´", "՚՚՝՛՛")

# The markup that cleaning takes out, in order, with what takes its place.
MARKUP = (
    (r"(?s)<noinclude>.*?</noinclude>", ""),
    (r"<section[^>]*/>", ""),
    (r"(?s)<ref[^>]*>.*?</ref>|<ref[^>]*/>", ""),
    (r"(?s)\{\{[^{}<]*<poem>(.*?)</poem>[^{}]*\}\}", "$1"),
)
TEMPLATE = r"\{\{[^{}]*\}\}"
AFTER_TEMPLATES = ((r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", "$1"), (r"</?[a-zA-Z][^>]*>", ""), (r"'{2,}", ""))
TABLES = ((r"(?m)^[ \t]*(\{\||\|\}|\|-|\|\+).*$", ""), (r"(?m)^[ \t]*[|!][ \t]*", ""), (r"[ \t]*(\|\||!!)[ \t]*", " "))
OPENING = rf"<(?=(?U:\S))(?!(?<=(?U:\S)<)[{A}]+[․.,])(?!(?<=[{A}]<)[{A}]+(?!{W}|>))"
CLOSING = rf"(?<=(?U:\S))>(?!{W})"


def _replaced(text: Column, rules) -> Column:
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def strip_templates(text: Column) -> Column:
    """Innermost templates taken out until none is left, however deep they are nested.

    As many passes are made as braces are nested.  Braces that only meet when a template
    between them goes can need more; such a text gets a pass for each closing pair it has.
    """

    def step(t: Column, _: Column) -> Column:
        return F.when(t.contains("}}"), F.regexp_replace(t, TEMPLATE, "")).otherwise(t)

    def passes(count: Column) -> Column:
        return F.slice(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), F.lit(1), count)

    level = F.aggregate(
        F.regexp_extract_all(text, F.lit(r"\{\{|\}\}"), F.lit(0)),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda acc, x: let(F.when(x == "{{", acc["now"] + 1).otherwise(F.greatest(acc["now"] - 1, F.lit(0))), lambda now: F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))),
        lambda acc: acc["most"],
    )
    stripped = F.when(text.rlike(TEMPLATE), F.aggregate(passes(level), text, step)).otherwise(text)

    def rest(t: Column) -> Column:
        pairs = F.floor(F.length(F.regexp_replace(t, r"[^}]", "")) / 2).cast("int")
        return F.when(t.rlike(TEMPLATE), F.aggregate(passes(pairs), t, step)).otherwise(t)

    return let(stripped, rest)


def strip_tables(text: Column) -> Column:
    return _replaced(text, TABLES)


def substitute(text: Column) -> Column:
    for mark, by in SUBSTITUTIONS:
        text = F.replace(text, F.lit(mark), F.lit(by))
    return text


def fold_guillemets(text: Column) -> Column:
    """Angle brackets typed for guillemets become those; printed ones stay."""
    return F.regexp_replace(F.regexp_replace(text, OPENING, "«"), CLOSING, "»")


def fold_tokens(text: Column) -> Column:
    """In tokens with an Armenian letter: look-alike marks, and a colon at the end, to the Armenian ones."""

    def one(t: Column) -> Column:
        return F.when(t.rlike(f"[{A}]"), F.regexp_replace(F.translate(t, *MARKS), rf":(?=[^\p{{L}}\p{{N}}_]*$)", "։")).otherwise(t)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"(?U)(\s+|\S+)"), F.lit(1)), one), "")


def normalise_transcript(text: Column, printed_brackets: Column | None = None) -> Column:
    """Tables, substitutions, guillemets (but where brackets are printed), marks.  Applying it twice changes nothing."""
    text = substitute(strip_tables(text))
    folded = fold_guillemets(text)
    return fold_tokens(folded if printed_brackets is None else F.when(printed_brackets, text).otherwise(folded))


def clean_markup(text: Column, printed_brackets: Column | None = None) -> Column:
    """Running text of wiki markup: markup out, transcript normalised, spaces and blank lines tidied."""
    text = _replaced(strip_templates(_replaced(text, MARKUP)), AFTER_TEMPLATES)
    text = normalise_transcript(text, printed_brackets)
    lines = F.transform(F.split(text, r"\r\n|[\n\r\x0B\f\x1c-\x1e\x85\u2028\u2029]"), lambda x: F.regexp_replace(F.regexp_replace(x, r"[ \t]+", " "), r"(?U)^\s+|\s+$", ""))
    return F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"), r"(?U)^\s+|\s+$", "")


def tokens(text: Column) -> Column:
    """The runs of text between white space of any kind."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda x: x != "")


def fold_metric(text: Column) -> Column:
    """The form in which readings are compared: lower case, full stops and ligature as one, single spaces."""
    text = F.replace(F.translate(F.lower(text), "։․", ":."), F.lit("եւ"), F.lit("և"))
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def fold_punctuation(text: Column) -> Column:
    return F.translate(text, "․", ".")


def is_word(token: Column) -> Column:
    return token.rlike(r"[\p{L}\p{N}]")


def lexicon_key(token: Column) -> Column:
    """token without signs at its ends, in lower case."""
    return F.lower(F.regexp_replace(token, r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$", ""))


def edges(token: Column) -> tuple[Column, Column]:
    """The signs before and after a token's key."""
    return F.regexp_extract(token, r"^[^\p{L}\p{N}_]*", 0), F.regexp_extract(token, r"[^\p{L}\p{N}_]*$", 0)


def upper_case_line(text: Column) -> Column:
    return F.upper(F.replace(text, F.lit("և"), F.lit("եվ")))


def volume_of(title: Column) -> Column:
    """The number before ``.djvu`` at the end, else null."""
    return F.nullif(F.regexp_extract(F.trim(title), r"(\d+)\.djvu$", 1), F.lit("")).try_cast("int")


def page_number(title: Column) -> Column:
    """The number after the last slash, else null."""
    return F.substring_index(title, "/", -1).try_cast("int")


def source_slug(title: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(title, r"[^\p{L}\p{N}]+", "-"), r"^-+|-+$", "")


def crop_name(slug: Column, page: Column, place: Column) -> Column:
    return F.format_string("%s_%04d_%04d.png", slug, page, place)


def crop_parts(name: Column) -> Column:
    """struct<slug,page,place> of a crop's name, split at its last two underscores."""
    pattern = r"^(.*)_(\d+)_(\d+)(?:\.\w+)?$"
    return F.struct(*(F.regexp_extract(name, pattern, i + 1).alias(n) if n == "slug" else F.regexp_extract(name, pattern, i + 1).try_cast("int").alias(n) for i, n in enumerate(("slug", "page", "place"))))


def page_spec(spec: Column) -> Column:
    """The sorted page numbers of a list like ``20-80,100``.  Empty and backward ranges are errors."""

    def one(part: Column) -> Column:
        first = F.regexp_extract(part, r"^\s*(\d+)", 1).try_cast("int")
        last = F.coalesce(F.regexp_extract(part, r"-\s*(\d+)\s*$", 1).try_cast("int"), first)
        return F.when(first.isNull() | (last < first), F.raise_error(F.concat(F.lit("bad page range: "), part)).cast("array<int>")).otherwise(F.sequence(first, last))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(spec, ","), one))))


def dehyphenate(parts: Column) -> Column:
    """An array of fragments with those that end in a dash joined to the next."""
    joined = F.regexp_replace(F.array_join(parts, "\x01"), "[-–—֊]\\s*\x01\\s*", "")
    return F.split(joined, "\x01")


def ends_in_break(reading: Column, label: Column) -> Column:
    """Whether a reading, quotes aside, ends in a dash and its label does not."""
    return F.regexp_replace(reading, "[\"'`«»“”]+$", "").rlike("[-–—֊]$") & ~label.rlike("[-–—֊]$")


def file_title(index_title: Column, prefix: str, by: str) -> Column:
    """index_title with its prefix swapped; a title without it is an error."""
    swapped = F.concat(F.lit(by), F.substring(index_title, len(prefix) + 1, 1_000_000))
    return F.when(index_title.startswith(prefix), swapped).otherwise(F.raise_error(F.concat(F.lit("not an index title: "), index_title)).cast("string"))


def needle(title: Column, prefix: str) -> Column:
    return F.regexp_replace(title, rf"^{prefix}|\.djvu$|\.pdf$", "")


def code_point_name(char: Column) -> Column:
    return F.format_string("U+%04X", F.ascii(char))


@F.pandas_udf(StringType())
def unicode_name(char: pd.Series) -> pd.Series:
    """The character's name in the Unicode tables, which the JVM's functions do not reach; ``?`` if it has none, null for null."""
    return char.map(lambda c: None if c is None else unicodedata.name(c, "?"))


def joined_lines(lines: Column) -> Column:
    """An array of lines as one text; nulls are left out."""
    return F.array_join(lines, "\n")


def index_line(key: Column, picks: int = 4) -> Column:
    """An invented index line of page numbers, drawn from a hash of key; a number that begins with 2 doubles that digit."""

    def page(i: Column) -> Column:
        return (F.conv(F.substring(F.md5(F.concat(key, F.lit("|"), i.cast("string"))), 1, 6), 16, 10).cast("int") % 499) + 1

    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(picks)), lambda i: F.regexp_replace(page(i).cast("string"), "^2", "22")), ", ")
