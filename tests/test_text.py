"""Scalar text operators on captured and hand-made cases."""

import pytest
from pyspark.sql import functions as F

from quern.functions import charset, text


def applied(spark, f, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r.y for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


CLEAN = [
    ("ա {{կաղապար|{{ներդիր}}}} բ", "ա բ"),
    ("[[Թիրախ|ցուցադրվող]] տեքստ", "ցուցադրվող տեքստ"),
    ("առաջին  տող\n\n\n\nերկրորդ   տող", "առաջին տող\n\nերկրորդ տող"),
    ("<noinclude>գլուխ\nտող</noinclude>մարմին<section begin=a/>", "մարմին"),
    ("ա<ref>ծան</ref>բ<ref name=x/>գ", "աբգ"),
    ("''շեղ'' '''թավ'''", "շեղ թավ"),
    ("{{Poem|<poem>տող մեկ\nտող երկու</poem>}}", "տող մեկ\nտող երկու"),
    ("", ""),
]


def test_clean_markup(spark):
    assert applied(spark, text.clean_markup, [a for a, _ in CLEAN]) == [b for _, b in CLEAN]
    assert applied(spark, text.clean_markup, [None]) == [None]


NORMAL = [
    ("<Ազգ> և <Պահակ>", "«Ազգ» և «Պահակ»"),
    ("արջ<արչ ու", "արջ<արչ ու"),
    ("ասաց<Ազգ> և", "ասաց«Ազգ» և"),
    ("բժշկի: Հ.:", "բժշկի։ Հ.։"),
    ("10:30-ին բժշկի:»", "10:30-ին բժշկի։»"),
    ("կ’ուզէր", "կ՚ուզէր"),
    ("l’étude 5′", "l’étude 5′"),
    ("մշա­կոյթին", "մշակոյթին"),
    ("a − b", "a – b"),
]


def test_normalise_transcript_and_again(spark):
    once = applied(spark, text.normalise_transcript, [a for a, _ in NORMAL])
    assert once == [b for _, b in NORMAL]
    assert applied(spark, text.normalise_transcript, once) == once


def test_printed_brackets_stay(spark):
    rows = spark.createDataFrame([("<Ազգ> և", True), ("<Ազգ> և", False)], "x string, printed boolean")
    assert [r.y for r in rows.select(text.normalise_transcript(F.col("x"), F.col("printed")).alias("y")).collect()] == ["<Ազգ> և", "«Ազգ» և"]


def test_tokens_split_as_python_does(spark):
    values = ["", " a b  c\n", " x\t", "one", None]
    assert applied(spark, text.tokens, values) == [v.split() if v is not None else None for v in values]


def test_keys_and_words(spark):
    assert applied(spark, text.lexicon_key, ["«Բառ,»", "--", "A_b.", "x²"]) == ["բառ", "", "a_b", "x²"]
    assert applied(spark, text.is_word, ["--", "a", "²", "_"]) == [False, True, True, False]
    assert applied(spark, text.fold_metric, ["  Ա։  ԲԵՒ․ ", "եւ"]) == ["ա: բև.", "և"]


def test_titles(spark):
    assert applied(spark, text.volume_of, ["x 2.djvu", "x 12.djvu ", "x.pdf"]) == [2, 12, None]
    assert applied(spark, text.page_number, ["a/b/17", "a/x"]) == [17, None]
    assert applied(spark, text.source_slug, ["--Ա բ: 2.djvu"]) == ["Ա-բ-2-djvu"]
    assert applied(spark, lambda c: text.crop_parts(c)["slug"], ["a_b_0001_0002.png"]) == ["a_b"]
    with pytest.raises(Exception, match="not an index title"):
        applied(spark, lambda c: text.file_title(c, "Index:", "File:"), ["Page:x"])


def test_page_spec(spark):
    assert applied(spark, text.page_spec, ["20-23,100", "3, 1-2"]) == [[20, 21, 22, 23, 100], [1, 2, 3]]
    for bad in ("9-3", "", "a"):
        with pytest.raises(Exception, match="bad page range"):
            applied(spark, text.page_spec, [bad])


def test_dehyphenate(spark):
    rows = spark.createDataFrame([(["մշա-", "կույթ", "ա"],), ([],), (["x"],)], "p array<string>")
    assert [r.y for r in rows.select(text.dehyphenate(F.col("p")).alias("y")).collect()] == [["մշակույթ", "ա"], [""], ["x"]]


def test_charset():
    chars = charset.charset()
    assert len(set(chars)) == len(chars) and chars.endswith(" ") and chars.index("Ա") == 0
    assert not set("ѣіѳѵ") & set(chars) and "Ё" in chars


def test_scripts(spark):
    assert applied(spark, charset.scripts_of, ["Աa", "яz1", "12"]) == [["armenian", "latin"], ["cyrillic", "latin"], []]
    assert applied(spark, charset.mixes_cyrillic, ["яz", "я", "z"]) == [True, False, False]
    assert applied(spark, charset.is_mixed_line, ["Ա я", "Աa", "я"]) == [True, False, False]
    assert applied(spark, lambda c: charset.is_covered(c, charset.charset()), ["Ա(b)-]", "α", "|"]) == [True, False, False]
