"""Queries on small tables of odd rows, against their SQL."""

import difflib
import gzip
import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quern.functions import charset, sequences
from quern.operators import paged
from quern.plans import derived
from quern.sources import archive
from tests.test_entry import plain


@pytest.fixture
def against_sql(spark, tmp_path):
    """Checks a query on tables of the given rows against its SQL."""

    def check(name, **tables):
        for table, df in tables.items():
            df.write.mode("overwrite").parquet(str(tmp_path / f"{table}.parquet"))
        con = duckdb.connect()
        for table in tables:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        found = entry.queries()[name](spark, str(tmp_path))
        columns = sorted(found.columns)
        con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in con.description]
        want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in con.fetchall()), key=repr)
        assert sorted((tuple(plain(r[c]) for c in columns) for r in found.collect()), key=repr) == want
        return want

    return check


def documents(spark, texts, first=0):
    """documents of these texts; ids count from first."""
    df = spark.createDataFrame([(first + i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    return df.repartition(2, F.col("doc_id"))


@pytest.mark.parametrize("name", ["confusion_counts", "confusion_split", "watched_pairs"])
def test_digits_beside_letters_that_are_read_as_digits(against_sql, spark, name):
    against_sql(name, documents=documents(spark, ["x y z a1 x y z w 3o 2e1a2", "x y z a1e2", "x y z o3o", "", None]))


WORDS = "the of and thing ße éa Наука ab ab naïve x1 3o hyphen- «quoted» ,, a\u0301 日本".split()


def prose(seed, n):
    """n tokens, some repeated, some long."""
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s" * r.randrange(12)]) for _ in range(n))


ON_PAGES = ["gutter_candidates", "gutter_choice", "columns3", "reading_order", "box_dedupe", "blob_filter", "whole_word_crops", "yield_by_source"]


@pytest.mark.parametrize("name", ON_PAGES)
def test_pages_of_one_row_are_not_dealt_out(against_sql, spark, tmp_path, name, monkeypatch):
    monkeypatch.setattr(paged, "CHUNK", 700)  # so that pages end within, at and beyond a chunk
    docs = documents(spark, [prose(i, n) for i, n in enumerate([5, 479, 480, 481, 1300, 3, 1, 250, 250, 700])] + ["", None])
    assert against_sql(name, documents=docs)
    plan = entry.queries()[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    boxes = [x for x in plan.split("\n") if "Exchange hashpartitioning(page" in x or "Window" in x]
    assert len(boxes) <= {"columns3": 1, "yield_by_source": 3}.get(name, 0), plan  # only counts


@pytest.mark.parametrize("name", [x for x in ON_PAGES if x != "reading_order"])  # whose SQL leaves the order of equal places open
def test_rows_that_share_a_page_meet(against_sql, spark, name):
    docs = documents(spark, [prose(1, 300), prose(2, 500)]).union(documents(spark, [" ".join(f"w{i}" * (i % 4 + 1) for i in range(400))]))
    against_sql(name, documents=docs.repartition(3))


def test_texts_that_reach_the_next_pages(spark):
    held = documents(spark, ["a b", "c"])
    assert derived.laid_apart(held) and derived.laid_apart(held.where("false"))
    assert not derived.laid_apart(held.union(held)) and not derived.laid_apart(held.union(documents(spark, ["a " * 480_001], 7)))


def test_ranges_are_the_same_characters():
    for chars in (charset.charset(), "", "a", "-]^\\", "abcd,"):
        pattern = re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))), charset.ranges(chars))
        assert not chars or "".join(sorted(set(chars))) == "".join(c for c in map(chr, range(0x3000)) if re.fullmatch(f"[{pattern}]", c))
    assert charset.ranges(charset.charset()).count("x") < 40


@pytest.mark.parametrize("name", ["stray_chars", "charset_diff_raw_residual", "usable_runs"])
def test_characters_outside_the_set(against_sql, spark, name):
    against_sql(name, documents=documents(spark, ["aé b\tß\n日本 ☃☃", "[a]-^\\ {}|~_`@#$", "Ա՚և ք Ёё я" * 5, prose(3, 200), "", "\U0001f600é"]))


def odd_bytes(n):
    """Text that gzip cannot make small."""
    r = random.Random(n)
    return "".join(r.choice("abcdefghijklmnop qrstuvwxyzé\n日") for _ in range(n))


@pytest.mark.parametrize("name", ["archive_texts", "archive_detections", "gzip_by_magic"])
def test_contents_of_any_size_go_through(against_sql, spark, name, monkeypatch):
    monkeypatch.setattr(archive, "HELD", 3000)
    texts = [odd_bytes(n) for n in (0, 1, 4095, 4096, 4097, 9000, 70_000)] + [prose(i, 30) for i in range(40)]
    against_sql(name, documents=documents(spark, texts))


def test_archives_do_not_grow_with_the_table(spark):
    files = spark.range(400).repartition(3).select(F.lit("p").alias("path"), F.format_string("text/%d.txt", "id").alias("member"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 40).alias("body"))
    tars = archive.packed(files, "path", most=50_000)
    held = tars.select("path", F.octet_length("content").alias("n")).collect()
    assert len(held) >= 20 and {r.path for r in held} == {"p"}
    found = archive.members(tars)
    assert found.count() == 400 and found.select("member", F.col("data").cast("string").alias("body")).exceptAll(files.select("member", "body")).isEmpty()
    plan = archive.texts(tars)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "ArrowEvalPython" not in plan  # no list of a key's files, and no batch of many contents


def test_a_batch_of_large_contents_comes_in_pieces(spark):
    held = spark.range(3).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1_000_000).cast("binary").alias("content"))
    longest = archive._pieces(held, "content").agg(F.max(F.octet_length("piece")), F.count("*")).first()
    assert tuple(longest) == (archive.PIECE, 3 * -(-1_000_000 // archive.PIECE))
    packed = archive.rewritten(held.union(spark.createDataFrame([(7, None), (8, bytearray())], "doc_id long, content binary")), lambda i, x: gzip.compress(x) if i != 1 else x)
    assert sorted((r.doc_id, r.content and len(r.content)) for r in archive.unpacked(packed).collect()) == [(0, 1_000_000), (1, 1_000_000), (2, 1_000_000), (7, None), (8, bytearray())]


@pytest.mark.parametrize("name", ["word_recall_doc", "macro_word_recall"])
def test_words_of_a_text_stay_in_its_row(against_sql, spark, tmp_path, name):
    texts = [prose(i, 40 + 30 * i) for i in range(12)] + ["", None, "-- ,, ·", "a a b e1 e1 a o", "ԵՒ եւ և a․b a:b " * 5, "x y\ty\n\n z " * 9]
    assert against_sql(name, documents=documents(spark, texts))
    plan = entry.queries()[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan.replace("explode(transform(sequence", "") and "collect_list" not in plan
    against_sql(name, documents=documents(spark, texts[:9]).union(documents(spark, [prose(7, 50), "a", "e o"])))


def test_costly_lines_are_dealt_out(spark, tmp_path):
    said = spark.createDataFrame([(1, i, "user", f"line {i} of a text\nand more of it") for i in range(40)], "conv_id long, turn int, role string, text string")
    said.coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    for name in ("char_similarity", "stage_means"):
        plan = entry.queries()[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert plan.index("ArrowEvalPython") < plan.index("Exchange RoundRobinPartitioning") < plan.index("FileScan"), plan


def test_blocks_by_runs_are_the_plain_ones(monkeypatch):
    r = random.Random(9)
    for cells, few in ((0, 0), (0, 5), (0, 10_000), (sequences.CELLS[0], sequences.FEW)):
        monkeypatch.setattr(sequences, "CELLS", (cells, 4_000_000))
        monkeypatch.setattr(sequences, "FEW", few)
        for _ in range(150):
            letters = r.choice(["ab", "abcdé", "abcdefghijklmnop 日"])
            a = "".join(r.choice(letters) for _ in range(r.randint(0, 90)))
            b = "".join(r.choice(letters) if r.random() < 0.3 else c for c in a if r.random() > 0.1) + r.choice(["", a[:20]])
            for x, y in ((a, b), (list(a), list(b))):
                plain_one, mine = difflib.SequenceMatcher(None, x, y, autojunk=False), sequences._matcher(x, y)
                assert plain_one.get_opcodes() == mine.get_opcodes() and plain_one.ratio() == mine.ratio(), (x, y)


def test_a_long_line_is_compared_in_time():
    line = prose(4, 700)[:1900]
    read = line.translate(str.maketrans("aeo", "eoa"))
    began = time.process_time()
    slow = difflib.SequenceMatcher(None, read, line, autojunk=False).ratio()
    between = time.process_time()
    assert sequences.similarity(read, line) == slow and time.process_time() - between < between - began


@pytest.mark.parametrize("name", ["tau_sweep", "tau_by_verdict"])
def test_tokens_read_as_they_are_do_not_meet_the_lexicon(against_sql, spark, tmp_path, name):
    against_sql(name, documents=documents(spark, [prose(i, 200) + " aa ea, «naïve» a x" * 4 for i in range(8)] + ["", None]))
