"""Corpus, alignment and metric operators on literal rows."""

import difflib
import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import sequences, text
from quern.functions.charset import charset
from quern.operators import align, checks, confusion, ctc, holdout, lexicon, metrics, overlap, profile, runs, sampling
from quern.plans import queries
from quern.sources import files, labels, manifest
from quern.streaming import manifest as streaming


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


# Overlap and held-out pages


def test_shared_runs(spark, monkeypatch):
    words = [f"w{i}" for i in range(30)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:12])), (3, "short"), (4, None)], "doc_id long, text string")
    held = spark.createDataFrame([(7, " ".join(words).upper()), (8, " ".join(words[:9]))], "item_id long, text string")
    want = [(1, 7, 23), (2, 7, 5)]
    assert rows(overlap.shared_runs(docs, held, "doc_id", "item_id")) == want
    monkeypatch.setattr(overlap, "BROADCAST_ROWS", 0)
    assert rows(overlap.shared_runs(docs, held, "doc_id", "item_id")) == want
    with pytest.raises(ValueError, match="no runs"):
        overlap.shared_runs(docs, held.where("false"), "doc_id", "item_id")


def test_first_needle_and_numeric_volume(spark):
    pages = spark.createDataFrame([("Work A 2.djvu", 5), ("Work A 12.djvu", 5), ("Work AB", 1), ("Other", 1), (None, 1)], "title string, page int")
    got = holdout.held_out(pages, [("Work AB", [2]), ("Work A", [1])], volume=("Work A", 2))
    assert [(r.title, r.held) for r in got.collect()] == [("Work A 2.djvu", True), ("Work A 12.djvu", False), ("Work AB", False), ("Other", False), (None, False)]
    assert holdout.held_out(pages, [], [("Work", [5])]).where("held").count() == 2
    with pytest.raises(Exception, match="held-out page"):
        holdout.refuse_held(pages, [("Other", [1])]).count()


def test_proposals_take_the_upper_median(spark):
    pages = spark.createDataFrame([("s", i, "x" * n) for i, n in enumerate([1, 2, 3, 10])], "source string, page int, text string")
    assert rows(holdout.propose(pages, 1), "page", "density") == [(2, 3)]
    assert holdout.propose(pages, 3).count() == 0


def test_even_spread(spark):
    pages = spark.createDataFrame([("s", i) for i in range(20)], "source string, page int")
    assert rows(holdout.even_spread(pages, 4), "page") == [(2,), (6,), (10,), (14,)]


# Runs and samples


def test_runs_break_at_bad_tokens(spark):
    docs = spark.createDataFrame([(1, "a b 1 c"), (2, "1 2"), (3, ""), (4, None), (5, "x")], "doc_id long, text string")
    assert rows(runs.token_runs(docs, lambda t: t.rlike("^[a-z]+$"))) == [(1, 0, ["a", "b"]), (1, 3, ["c"]), (5, 0, ["x"])]


def test_candidates_stay_within_runs(spark):
    docs = spark.createDataFrame([(i, "aa bb cc 1 dd ee") for i in range(50)], "doc_id long, text string")
    got = runs.line_candidates(runs.token_runs(docs, lambda t: t.rlike("^[a-z]+$"))).collect()
    assert len(got) == 250 and all("1" not in r.line and 1 <= len(r.line.split()) <= 3 for r in got)


def test_quota_is_exact(spark):
    items = [(f"m{i}", "mixed") for i in range(50)] + [(f"c{i}", "classical") for i in range(60)] + [(f"p{i}", "other") for i in range(890)]
    df = spark.createDataFrame(items, "text string, stratum string")

    def taken(shares):
        return {r.stratum: r["count"] for r in sampling.quota_sample(df, 100, shares, F.col("text")).groupBy("stratum").count().collect()}

    assert taken([("mixed", 0.2), ("classical", 0.3)]) == {"mixed": 20, "classical": 30, "other": 50}
    assert taken([("mixed", 0.9)])["mixed"] == 50
    one, two = (rows(sampling.quota_sample(df.repartition(n), 100, [("mixed", 0.2)], F.col("text")), "text") for n in (1, 7))
    assert one == two
    assert rows(sampling.quota_shortfall(df, 100, [("mixed", 0.9)])) == [("mixed", 90, 50, 40)]


def test_batches_wrap(spark):
    got = sampling.batch_mix(spark.createDataFrame([("a", 3), ("b", 0)], "name string, n long"), [("a", 0.5), ("b", 0.5)], 4, 3)
    assert rows(got, "step", "slot", "item") == [(0, 0, 0), (0, 1, 1), (1, 0, 2), (1, 1, 0), (2, 0, 1), (2, 1, 2)]


# Profiles and lexicons


def test_orthography_markers(spark):
    docs = spark.createDataFrame([("s", "ւ ու Ու եւ էէ այ այ."), ("t", "")], "source string, text string")
    got = {r.source: r.asDict() for r in profile.marker_counts(docs, "source", profile.ORTHOGRAPHY).collect()}
    assert got["s"]["free_yiwn"] == 2 and got["s"]["two_letter_ew"] == 1 and got["s"]["final_y"] == 2 and got["s"]["inner_e"] == 1
    assert got["t"]["letters"] == 0
    verdicts = spark.createDataFrame([(499, 9.0), (500, 8.0), (500, 2.0), (500, 5.0)], "l int, r double")
    assert [r.v for r in verdicts.select(profile.verdict(F.col("l"), F.col("r")).alias("v")).collect()] == ["unknown", "classical", "reformed", "mixed"]


def test_first_listed_candidate_decides(spark):
    words = [
        ("a", "vord", [("vord", -0.1), ("word", -0.5), ("ford", -0.6)]),
        ("b", "vord", [("vord", -0.1), ("ford", -3.0), ("word", -3.1)]),
        ("c", "word", [("word", -0.1), ("ford", -0.2)]),
        ("d", "v", [("v", -0.1), ("word", -0.2)]),
        ("e", "vord,", [("vord,", -0.1), ("word", -0.2), ("word,", -0.3)]),
    ]
    df = spark.createDataFrame(words, "k string, greedy string, cands array<struct<text:string,logp:double>>")
    lex, taus = spark.createDataFrame([("word",), ("ford",)], "word string"), spark.createDataFrame([(1.0,)], "tau double")
    assert rows(lexicon.corrected(df, lex, taus, "a-z", ["k"]), "k", "chosen") == [("a", "word"), ("b", "vord"), ("c", "word"), ("d", "v"), ("e", "word,")]


# Alignment

BOX = "page long, place int, text string, l double, t double, r double, b double"


def placed(boxes):
    return [(1, i, text_, float(x), float(y), float(x + w), float(y + h)) for i, (text_, x, y, w, h) in enumerate(boxes)]


def test_two_columns_and_one(spark):
    two = spark.createDataFrame(placed([("x", x, 30 * i, 60, 20) for x in (100, 500) for i in range(5)]), BOX)
    assert 160 < align.gutters(two, ["page"]).first().gutter < 500
    one = spark.createDataFrame(placed([("x", 100, 30 * i, 500, 20) for i in range(10)]), BOX)
    assert align.gutters(one, ["page"]).count() == 0
    lopsided = spark.createDataFrame(placed([("x", 100, 30 * i, 60, 20) for i in range(20)] + [("y", 500, 0, 60, 20)]), BOX)
    assert align.gutters(lopsided, ["page"]).count() == 0


def test_three_columns_with_a_header(spark):
    boxes = [(c, 100 + 203 * k - 3, 40 + 30 * i, 206, 20) for k, c in enumerate("ABC") for i in range(10)] + [("header", 100, 0, 612, 20)]
    got = align.columns(spark.createDataFrame(placed(boxes), BOX), ["page"])
    ordered = [r.box.text for r in align.reading_order(got, ["page"]).orderBy("place").collect()]
    assert ordered == ["A"] * 10 + ["B"] * 10 + ["C"] * 10


def test_label_column_is_no_column(spark):
    boxes = [("n", 0, 30 * i, 100, 20) for i in range(6)] + [("t", 560, 30 * i, 2000, 20) for i in range(6)]
    assert align.gutters(spark.createDataFrame(placed(boxes), BOX), ["page"]).count() == 0


def test_lines_anchor_on_their_first_box(spark):
    boxes = [("c", 300, 6, 50, 20), ("a", 100, 0, 50, 20), ("b", 200, 3, 50, 20), ("e", 50, 12, 50, 20)]
    got = align.reading_order(spark.createDataFrame(placed(boxes), BOX), ["page"]).orderBy("place").collect()
    assert [r.box.text for r in got] == ["a", "b", "c", "e"]


def test_pair_tokens(spark):
    cases = [
        (["a", "b"], ["a", "b"], [(0, 0, "exact"), (1, 1, "exact")]),
        (["x", "hայ", "y"], ["x", "հայ", "y"], [(0, 0, "exact"), (1, 1, "near"), (2, 2, "exact")]),
        (["x", "??", "y"], ["x", "հայ", "y"], [(0, 0, "exact"), (1, 1, "bracketed"), (2, 2, "exact")]),
        (["x", "??", "??", "??", "y"], ["x", "հայ", "բառ", "գիր", "y"], [(0, 0, "exact"), (4, 4, "exact")]),
        (["??", "y"], ["հայ", "y"], [(1, 1, "exact")]),
        (["x", "q", "y"], ["x", "հայ", "բառ", "y"], [(0, 0, "exact"), (2, 3, "exact")]),
        (["x", "q", "r", "y"], ["x", "y"], [(0, 0, "exact"), (3, 1, "exact")]),
        ([], ["a"], []),
        (["a"] * 300, ["a"] * 300, [(i, i, "exact") for i in range(300)]),
    ]
    df = spark.createDataFrame([(i, w, t) for i, (w, t, _) in enumerate(cases)], "page long, words array<string>, tokens array<string>")
    got = align.pair_tokens(df, "page").collect()
    assert len(got) == sum(len(w) for w, _, _ in cases)
    for i, (words, truth, want) in enumerate(cases):
        mine = sorted((r["at"], r.truth_at, r.tier) for r in got if r.page == i and r.tier)
        assert mine == want
        assert all(words[r["at"]] == r.word and (r.truth is None or truth[r.truth_at] == r.truth) for r in got if r.page == i)


def test_gutters_equal_a_count_over_all_boxes(spark):
    r, boxes = random.Random(5), []
    for page in range(30):
        n = r.randint(1, 40)
        for k in range(n):
            left = r.choice([0, 0, 400, 400, 800, r.randrange(900)])
            boxes.append((page, k, "x", float(left), float(30 * k), float(left + r.choice([5, 100, 250, 330])), float(30 * k + r.choice([0, 15, 20]))))

    def plain(page):
        mine = [b for b in boxes if b[0] == page]
        heights = sorted(b[6] - b[4] for b in mine if b[6] > b[4])
        px = (0 if not heights else (heights[(len(heights) - 1) // 2] + heights[len(heights) // 2]) / 2) * 0.25
        ext = [(b[3] + px, b[5] - px) if b[3] + px < b[5] - px else ((b[3] + b[5]) / 2,) * 2 for b in mine]
        lo, hi = min(b[3] for b in mine), max(b[5] for b in mine)
        if len(mine) < 4 or hi <= lo:
            return [], None
        low, high = lo + 0.15 * (hi - lo), lo + 0.85 * (hi - lo)
        xs = sorted({x for x in [low, high, *itertools.chain(*ext)] if low <= x <= high})
        found, best = [], []
        for a, b in itertools.pairwise(xs):
            mid = (a + b) / 2
            crossings = sum(x0 < mid < x1 for x0, x1 in ext)
            if crossings > max(3, 0.05 * len(mine)):
                continue
            found.append((mid, crossings, b - a))
            left, right = [e for e in ext if e[1] <= mid], [e for e in ext if e[0] >= mid]
            if min(len(left), len(right)) >= 0.15 * len(mine):
                widths = sorted(max(e[1] for e in s) - min(e[0] for e in s) for s in (left, right))
                if widths[0] >= 0.2 * (hi - lo) or widths[0] >= 0.5 * widths[1]:
                    best.append((crossings, -(b - a), mid))
        return found, min(best)[2] if best else None

    df = spark.createDataFrame(boxes, BOX)
    got, chosen = {}, {x.page: x.gutter for x in align.gutters(df, ["page"]).collect()}
    for x in align.gutter_candidates(df, ["page"]).collect():
        got.setdefault(x.page, []).append((x.x, x.crossings, x.gap))
    for page in range(30):
        found, best = plain(page)
        assert np.allclose(sorted(got.get(page, [])), sorted(found)) and (best is None) == (page not in chosen)
        assert best is None or abs(chosen[page] - best) < 1e-9


def test_columns_read_their_boxes_once(spark, tmp_path):
    spark.createDataFrame(placed([("x", x, 30 * i, 60, 20) for x in (100, 500) for i in range(5)]), BOX).write.parquet(str(tmp_path / "b"))
    df = align.columns(spark.read.parquet(str(tmp_path / "b")), ["page"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans, exchanges = plan.count("FileScan parquet"), plan.count("Exchange hashpartitioning") - plan.count("], Exchange hashpartitioning")
    assert scans <= 3 and exchanges <= 5, (scans, exchanges)


def test_boxes_align_whole_or_not(spark):
    boxes = spark.createDataFrame([(1, 0, "one two"), (1, 1, "thrxx four"), (1, 2, ""), (1, 3, "lost words")], "page long, place int, text string")
    truth = spark.createDataFrame([(1, "one two three four five".split())], "page long, tokens array<string>")
    got = rows(align.align_pages(boxes, truth), "place", "label", "tier")
    assert got == [(0, "one two", "exact"), (1, "three four", "near")]
    assert dict(rows(align.tier_counts(align.align_pages(boxes, truth)))) == {"exact": 1, "near": 1, "bracketed": 0}


def test_dedupe_is_greedy(spark):
    boxes = spark.createDataFrame(placed([("x", 0, 0, 100, 20), ("x", 30, 0, 100, 20), ("x", 60, 0, 100, 20), ("y", 0, 0, 100, 20)]), BOX)
    assert rows(align.dedupe(boxes, "page"), "text", "place") == [("x", 0), ("x", 2), ("y", 3)]
    assert rows(align.duplicate_pairs(boxes, "page"), "first", "second") == [(0, 1), (1, 2)]


# Metrics, confusion, decoding


def test_word_recall(spark):
    cases = [("b a", "a b", 1.0), ("a", "a b", 0.5), ("x", "", 1.0), ("", "-- ,", 1.0), ("a", "a a b", 2 / 3), ("Ա։", "ա:", 1.0), ("եւ", "և", 1.0)]
    df = spark.createDataFrame(cases, "a string, e string, want double")
    assert all(abs(r.got - r.want) < 1e-12 for r in df.select("want", metrics.word_recall(F.col("a"), F.col("e")).alias("got")).collect())


def test_ratio_is_the_library_s(spark):
    r = random.Random(2)
    pairs = [("".join(r.choice("abcd ") for _ in range(r.randint(0, 40))), "".join(r.choice("abcd ") for _ in range(r.randint(0, 40)))) for _ in range(60)]
    df = spark.createDataFrame([(a, b) for a, b in pairs], "a string, b string")
    got = [x.r for x in df.select(sequences.ratio("a", "b").alias("r")).collect()]
    assert got == [difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() for a, b in pairs]


def test_confusions(spark):
    cases = [("aիրb", "axb", [("իր", "x")]), ("ab", "a", [("b", "∅")]), ("a", "ab", [("∅", "b")]), ("xaby", "xcdy", [("a", "c"), ("b", "d")]), ("a", "a", []), (None, "a", [("∅", "a")])]
    found = spark.createDataFrame([c[:2] for c in cases], "t string, p string").select(sequences.confusions(F.col("t"), F.col("p")).alias("c")).collect()
    assert [[tuple(x) for x in r.c] for r in found] == [c[2] for c in cases]
    df = spark.createDataFrame([("oa", "0a"), ("oa", "0a"), ("a", "a"), ("a", "e")], "truth string, predicted string")
    counts = confusion.confusion_counts(df)
    assert rows(counts) == [("a", "e", 1), ("o", "0", 2)]
    assert rows(confusion.split_counts(counts, [("0", "o")])) == [(2, 1)]
    assert rows(confusion.watched(counts, [("o", "0"), ("q", "p")])) == [("o", "0", 2), ("q", "p", 0)]


def test_norm_edit(spark):
    df = spark.createDataFrame([("", "a"), ("ab", "ab"), ("ab", "a")], "t string, p string")
    assert [r.x for r in df.select(metrics.norm_edit(F.col("t"), F.col("p")).alias("x")).collect()] == [0.0, 1.0, 0.5]


def test_missing_is_not_zero(spark):
    scores = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("b", None), ("c", 1.0)], "g string, v double")
    assert metrics.macro_mean(scores, "g", "v").first().macro_mean == 0.75


def test_ctc(spark):
    df = spark.createDataFrame([([0, 1, 1, 0, 1, 2, 2],), ([],)], "p array<int>")
    assert [r.x for r in df.select(ctc.greedy(F.col("p")).alias("x")).collect()] == [[1, 1, 2], []]
    one = spark.createDataFrame([("ԱԲ☃",)], "t string").select(ctc.encode(F.col("t"), charset()).alias("x")).first().x
    assert one == [1, 2, None]


def test_beam_is_exhaustive_when_wide():
    rng = np.random.default_rng(0)
    for _ in range(20):
        m = rng.random((4, 3))
        m /= m.sum(axis=1, keepdims=True)
        total = {}
        for path in itertools.product(range(3), repeat=4):
            label = tuple(c for i, c in enumerate(path) if c and (i == 0 or path[i - 1] != c))
            total[label] = total.get(label, 0) + np.prod([m[t, c] for t, c in enumerate(path)])
        assert tuple(ctc.beam_search(m, 1000)) == max(total, key=total.get)
    assert 2 not in ctc.beam_search(np.array([[0.1, 0.2, 0.7]] * 3), 25, literal=True)


# Files, manifests, streams


def test_labels_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a.png", 'x, "y", z'), ("b.png", ","), ("c.png", "")], "filename string, words string")
    labels.write_labels(df, str(tmp_path / "l"))
    assert rows(labels.read_labels(spark, str(tmp_path / "l"))) == rows(df)
    with pytest.raises(Exception, match="spans lines"):
        labels.write_labels(spark.createDataFrame([("a.png", "x\ny")], df.schema), str(tmp_path / "m"))


def test_manifest_upsert_and_guards(spark, tmp_path):
    page = {"title": "T/1", "pageid": 1, "quality": 3, "page_number": 1, "text": "text/1.txt"}
    for work in ("a", "b"):
        (tmp_path / "in" / work).mkdir(parents=True)
        (tmp_path / "in" / work / "manifest.json").write_text(json.dumps({"index": work, "min_quality": 3, "pages": [page, page | {"page_number": 2, "cleaning": 4}]}, indent=1))
    got = manifest.read_manifests(spark, str(tmp_path / "in"))
    assert rows(got, "index", "page_number", "cleaning") == [("a", 1, 1), ("a", 2, 4), ("b", 1, 1), ("b", 2, 4)]
    old = got.where("index = 'a'")
    fresh = old.where("page_number = 1").withColumns({"cleaning": F.lit(5), "page_number": F.lit(3)}).unionByName(old.where("page_number = 2").withColumn("cleaning", F.lit(9)))
    manifest.write_manifest(fresh, "a", 3, str(tmp_path / "out"), old)
    out = spark.read.json(str(tmp_path / "out")).select(F.inline("pages"))
    assert [(r.page_number, r.cleaning) for r in out.collect()] == [(1, 1), (2, 9), (3, 5)]
    with pytest.raises(ValueError, match="cannot change"):
        manifest.write_manifest(fresh, "other", 3, str(tmp_path / "no"), old)
    with pytest.raises(ValueError, match="without pages"):
        manifest.write_manifest(fresh.where("false"), "a", 3, str(tmp_path / "no"))
    assert rows(manifest.to_fetch(spark.range(1, 4).withColumnRenamed("id", "page_number"), old, 2), "page_number") == [(1,), (3,)]
    with pytest.raises(ValueError, match="older"):
        checks.refuse_stale(old, 4)


def test_scans(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "12.txt").write_text("a\nb")
    assert rows(files.read_page_texts(spark, str(tmp_path / "t")), "page", "text") == [(12, "a\nb")]
    files.write_wordlist(spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "word string, n long"), str(tmp_path / "w"), 2)
    assert rows(files.read_wordlist(spark, str(tmp_path / "w"))) == [("a", 2), ("b", 2)]
    (tmp_path / "n.jsonl").write_text(json.dumps({"file": "f", "label": "l", "greedy": "g", "words": [["g", [["g", -0.1], ["h", -2.5]]]]}) + "\n")
    word = files.read_nbest(spark, str(tmp_path / "n.jsonl")).first().words[0]
    assert word.greedy == "g" and [(c.text, c.logp) for c in word.cands] == [("g", -0.1), ("h", -2.5)]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "3.json").write_text(json.dumps([{"box": [[1, 2], [9, 2], [9, 8], [1, 8]], "text": "x", "conf": 0.5}]))
    assert rows(files.read_detections(spark, str(tmp_path / "d"))) == [(3, "x", 1.0, 2.0, 9.0, 8.0, 0.5)]


def test_every_line_gets_a_similarity(spark, tmp_path):
    said = [(1, 0, "one\n" + "a long line of words " * 40), (1, 1, "one\none"), (2, 0, None), (2, 1, "")]
    spark.createDataFrame(said, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.conv_id, r.turn, r["at"]): (r.line, r.similarity) for r in queries.char_similarity(spark, str(tmp_path)).collect()}
    lines = [(c, t, k, line) for c, t, x in said for k, line in (enumerate(x.split("\n")) if x is not None else [(None, None)])]
    assert {k: v[0] for k, v in got.items()} == {(c, t, k): line for c, t, k, line in lines}
    for line, found in got.values():
        if line is None:
            assert found is None
        else:
            folded = " ".join(line.split())
            assert found == round(difflib.SequenceMatcher(None, folded.translate(str.maketrans("aeo", "eoa")), folded, autojunk=False).ratio(), 6)


def test_stream_upserts_once(spark, tmp_path):
    source, target, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    schema = "page_number long, text string"
    spark.createDataFrame([(1, " ա  բ"), (2, "")], schema).write.json(source)

    def run():
        pages = streaming.cleaned(streaming.read_pages(spark, source, schema), text.clean_markup, 2)
        streaming.upsert_available(pages, target, ckpt).awaitTermination()
        return rows(streaming.current(spark, target, ["page_number"]), "page_number", "text")

    assert run() == [(1, "ա բ")]
    assert run() == [(1, "ա բ")]
    spark.createDataFrame([(1, "նոր"), (3, "գ")], schema).write.mode("append").json(source)
    assert run() == [(1, "նոր"), (3, "գ")]


# Archives, APIs, paths


def test_archives_and_gzip(spark, tmp_path):
    import gzip
    import io
    import tarfile

    from quern.sources import archive

    def tarred(members, mode):
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode=mode) as tar:
            for name, data in members:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        return out.getvalue()

    quad = json.dumps([{"box": [[1, 2], [9, 2], [9, 8], [1, 8]], "text": "x é", "conf": None}]).encode()
    (tmp_path / "a.tar.gz").write_bytes(tarred([("pred/7.json", quad), ("pred/7.txt", "x é\ny".encode()), ("readme", b"no")], "w:gz"))
    (tmp_path / "b.tar").write_bytes(tarred([("8.txt", b"")], "w"))
    held = archive.read_archives(spark, str(tmp_path))
    assert rows(archive.texts(held), "page", "text") == [(7, "x é\ny"), (8, "")]
    assert rows(archive.detections(held), "page", "place", "text", "l", "t", "r", "b") == [(7, 0, "x é", 1.0, 2.0, 9.0, 8.0)]
    assert archive.members(held).count() == 4 and archive.members(held.where("false")).count() == 0
    odd = spark.createDataFrame([("n", None), ("e", bytearray())], "path string, content binary")
    assert archive.members(odd).count() == 0
    raw = spark.createDataFrame([(1, bytearray(gzip.compress(b"abc"))), (2, bytearray(b"abc")), (3, None)], "k int, content binary")
    assert [r.p for r in raw.orderBy("k").select(archive.plain("content").alias("p")).collect()] == [b"abc", b"abc", None]
    boxes = spark.createDataFrame([(5, 1, "b", 0.0, 1.0, 2.0, 3.0, 0.5), (5, 0, None, 0.0, 1.0, 2.0, 3.0, None)], f"{BOX}, conf double")
    tars = archive.packed(archive.prediction_files(boxes).withColumn("path", F.lit("p")), "path")
    assert [(r.place, r.text, r.conf) for r in archive.detections(tars).orderBy("place").collect()] == [(0, None, None), (1, "b", 0.5)]
    assert rows(archive.texts(tars), "page", "text") == [(5, "\nb")]


def test_folders_are_discovered(spark, tmp_path):
    for name, images in (("a", True), ("b", False), ("c", True)):
        (tmp_path / name / "images").mkdir(parents=True)
        if name != "c":
            (tmp_path / name / "manifest.json").write_text("{}")
        if images:
            (tmp_path / name / "images" / "1.png").write_bytes(b"x")
    assert [r.folder[-1] for r in files.discover(spark, str(tmp_path)).orderBy("folder").collect()] == ["a", "b"]
    assert [r.folder[-1] for r in files.evaluation_sets(spark, str(tmp_path)).collect()] == ["a"]


def test_index_stream_follows_the_api_s_tokens(spark, tmp_path):
    from quern.sources import api

    spark.dataSource.register(api.PageIndex)
    options = {"indexes": json.dumps(["Work 0", "Work 9", "Work 20"]), "transport": "quern.plans.derived:rehearsal"}
    whole = rows(spark.read.format("page_index").options(**options).load())
    assert whole == rows(spark.read.format("page_index").options(**options, min_quality="4").load().unionByName(spark.read.format("page_index").options(**options).load().where("quality = 3")))
    for _ in range(2):  # a restart takes nothing twice
        query = spark.readStream.format("page_index").options(**options).load().writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).start(str(tmp_path / "o"))
        query.processAllAvailable()
        query.stop()
    assert rows(spark.read.parquet(str(tmp_path / "o"))) == whole and len(whole) == 11
    with pytest.raises(RuntimeError, match="API says"):
        api.answered(lambda _: {"error": "x"}, {})


def test_crawl_keeps_errors_as_rows(spark):
    from quern.sources import api

    titles = spark.createDataFrame([("a/1",), ("a/1",), ("a/13",), ("b/2",), (None,)], "title string")
    got = rows(api.crawl(titles, "quern.plans.derived:rehearsal", done=titles.where("title = 'b/2'")).fillna("-"), "title", "text", "error")
    assert got == [("a/1", "text of a/1", "-"), ("a/13", "-", "RuntimeError: the API says: no such page")]


def segmented(path, separators):
    """The parts of a path, mark by mark."""
    marks = []
    for name, (a, b) in separators.items():
        for c, last in ((a, True), (b, False)):
            at = [i for i, x in enumerate(path) if x == c]
            marks += [(i, name, c == a) for k, i in enumerate(at) if (at[k + 1 : k + 2] != [i + 1] if last else at[k - 1] != i - 1 or k == 0)]
    out, start, open_, at = [], 0, None, 0
    for i, name, opens in sorted(marks):
        if opens:
            open_, at = name, i
        elif open_ == name:
            out += [("", start, at - 1)] * (at > start) + [(name, at + 1, i - 1)]
            start = i + 1
        else:
            open_ = None
    return out + [("", start, len(path) - 1)] * (start < len(path))


def test_word_segments_and_word_beam(spark):
    r, seps = random.Random(3), {"th": (1, 2), "en": (3, 4)}
    paths = [[r.randrange(7) for _ in range(r.randint(0, 25))] for _ in range(200)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "k int, p array<int>")
    got = {x.k: [tuple(s) for s in x.s] for x in df.select("k", ctc.segments(F.col("p"), seps).alias("s")).collect()}
    assert got == {i: segmented(p, seps) for i, p in enumerate(paths)}
    from quern.functions import arrays

    runs_ = spark.createDataFrame([([1, 2, 3, 7, 9, 10],), ([],)], "v array<int>").select(arrays.consecutive(F.col("v")).alias("a"), arrays.consecutive(F.col("v"), last=True).alias("b")).collect()
    assert [tuple(x) for x in runs_] == [([1, 7, 9], [3, 7, 10]), ([], [])]
    matrix = np.full((4, 7), 0.01)
    for t, (c, p) in enumerate([(1, 0.9), (5, 0.5), (6, 0.4), (2, 0.9)]):
        matrix[t, c] = p
    matrix[1, 6], matrix[2, 5] = 0.45, 0.35
    free = ctc.word_search(matrix, {}, [("th", 1, 2)])
    assert free == ctc.beam_search(matrix[1:3], 5) and ctc.word_search(matrix, {"th": {(6,)}}, [("th", 1, 2)]) == [6]
    one = spark.createDataFrame([(matrix.tolist(),)], "m array<array<double>>").select(ctc.word_beam({"th": [[6]]}, seps)(F.col("m")).alias("x")).first().x
    assert one == [6]


def test_names_templates_and_levels(spark):
    assert [r.n for r in spark.createDataFrame([("a",), ("\x01",), (None,)], "c string").select(text.unicode_name("c").alias("n")).collect()] == ["LATIN SMALL LETTER A", "?", None]
    deep = "x" + "{{a|" * 30 + "b" + "}}" * 30 + "y {{{c}}{d}} z {{open {{e}} " + "{{f}}" * 50
    assert spark.createDataFrame([(deep,)], "t string").select(text.strip_templates(F.col("t")).alias("t")).first().t == "xy  z {{open  "
    with pytest.raises(ValueError, match="none of"):
        profile.at_quality(spark.range(1).withColumn("quality", F.lit(3)), 2)
