"""Every registered query on the smallest tables, with its SQL where it has some; the pipeline against plain loops."""

import base64
import hashlib
import random
from pathlib import Path

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quern.llm import common, decontam, langid, neardup, quality, queries, secret_scan, stages
from tests.llm.test_operators import WORDS, prose

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not Path(SF).is_dir(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@given
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.collect()
    columns = sorted(df.columns)
    if name in queries.ORACLE_SQL:
        duck.execute(queries.ORACLE_SQL[name])
        names = [d[0] for d in duck.description]
        want = sorted((tuple(dict(zip(names, r, strict=True))[c] for c in columns) for r in duck.fetchall()), key=repr)
        assert sorted(names) == columns and sorted((tuple(r[c] for c in columns) for r in rows), key=repr) == want
    of = "pages" if "page_id" in columns else "documents"
    if name != "op8_decontamination":
        assert len(rows) == duck.execute(f"SELECT count(*) FROM {of}").fetchone()[0]
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@given
def test_languages_that_were_held_out(spark):
    docs = {r.doc_id: r for r in common.table(spark, SF, "documents").collect()}
    got = [r for r in queries.op2_language_id(spark, SF).collect() if docs[r.doc_id].lang and r.lang_pred != "und"]
    held = [r for r in got if r.held_out]
    assert len(held) > 20 and sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


@given
def test_quality_against_labels(spark):
    """The labels took no part in training."""
    labels = {r.doc_id: r.quality for r in common.table(spark, SF, "labels").collect() if r.quality is not None}
    got = {r.doc_id: r.quality for r in queries.op3_quality(spark, SF).collect()}
    right = [got[i] == q for i, q in labels.items() if i in got]
    assert len(right) > 20 and sum(right) >= 0.9 * len(right)


# Samples


def test_samples_are_bounded_and_never_empty(spark):
    texts = [f"text {i} {w}" for i, w in enumerate(WORDS * 20)] + ["the same text"] * 400
    rows = spark.createDataFrame([(0, t) for t in texts], "all int, text string").selectExpr("all", "text", "xxhash64(text) as h").repartition(5)
    for there in (len(texts), 10**10, 10**18):
        bounds = common.least_hashes(rows, "all", "h", 50, {0: there})
        got = [r.text for r in common.chosen(rows, "all", "h", bounds).collect()]
        assert len(got) == len(set(got)) == 50
        ranked = sorted({r.h: r.text for r in rows.collect()}.items())
        assert set(got) == {t for _, t in ranked[:50]}
    only = rows.where("text = 'the same text'")
    assert common.chosen(only, "all", "h", common.least_hashes(only, "all", "h", 50, {0: 10**10})).count() == 1
    assert common.chosen(rows, "all", "h", {}).count() == 0


def test_small_languages_are_learned_beside_large_ones(spark):
    few = "der die und nicht schön über ich auch kein wieder".split()
    rows = [(prose(20, i), "en") for i in range(600)] + [("it is the same text", "en")] * 600 + [(prose(20, i, few), "de") for i in range(12)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), settings=langid.Settings(rows=60))
    assert model.langs == ["de", "en"] and langid.Predictor(model).predict("nicht schön")[0] == "de"


def scored_plainly(model, text):
    """The mean over words of a known word's scores, else of its n-grams' means."""
    import math

    words = [w for w in langid.WORD.findall(text.lower())]
    total = [0.0] * len(model.langs)
    for w in words:
        if w in model.words:
            row = [float(x) for x in model.word_scores[model.words[w]]]
        else:
            marked, grams = f"<{w}>", []
            for end in range(2, len(marked) + 1):
                known = [marked[start:end] for start in range(max(0, end - model.longest), end) if marked[start:end] in model.grams]
                grams.append(model.gram_scores[model.grams[max(known, key=len)] if known else -1])
            row = [sum(float(g[k]) for g in grams) / len(grams) for k in range(len(model.langs))]
        total = [a + b for a, b in zip(total, row, strict=True)]
    mean = [x / len(words) for x in total]
    shares = [math.exp(x - max(mean)) for x in mean]
    return model.langs[mean.index(max(mean))], max(shares) / sum(shares)


def test_scores_equal_plain_loops(spark):
    langs = {"en": WORDS, "de": "der die und nicht schön über ich auch kein wieder".split(), "fr": "le la et où être déjà très pas vous même".split()}
    rows = [(prose(30, i, langs[x]), x) for i, x in enumerate(list(langs) * 20)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    predictor, r = langid.Predictor(model), random.Random(3)
    for _ in range(200):
        text = " ".join(r.choice([*sum(langs.values(), []), "unseen", "schöner", "vousx", "q"]) for _ in range(r.randint(1, 20)))
        lang, score = predictor.predict(text)
        want = scored_plainly(model, text)
        assert lang == want[0] and abs(score - want[1]) < 1e-5


def test_linear_scores_equal_plain_loops():
    r = random.Random(4)
    texts = [prose(r.randint(1, 60), i) + r.choice(["", ".", "\nthe\nthe", " !!!"]) for i in range(60)]
    samples = [(list(f := quality.features(t, 13)), list(f.values()), float(i % 2)) for i, t in enumerate(texts)]
    scorer = quality.train(samples, quality.Settings(steps=50))
    import math

    for t in texts:
        z = sum(x * float(scorer.weights[k]) for k, x in quality.features(t, 13).items()) + scorer.bias
        assert abs(scorer.score(t, {}) - 1 / (1 + math.exp(-z))) < 1e-9


# The pipeline


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path_factory.mktemp("sf")
    german = "der die und nicht schön über ich auch kein wieder haben werden durch".split()
    items = [(k, prose(30, 700 + k, [f"{a}{b}" for a in "bcdfg" for b in ("an", "el", "ir", "os", "um", "ay", "en")])) for k in range(3)]
    rows = [(i, prose(60, i), "en") for i in range(40)] + [(100 + i, prose(60, i, german), "de") for i in range(40)]
    base = prose(200, 5000, WORDS + german[:3])
    rows += [(200 + k, base.replace(WORDS[k], "word", 1) if k else base, "en") for k in range(4)] + [(210, base, "en"), (211, rows[3][1], None)]
    rows += [(300 + k, f"{prose(30, 800 + k)} {items[k][1]} {prose(10, 900 + k)}", "en") for k in range(3)]
    rows += [(400, f'{prose(30, 1)} token = "abcdef0123456789" {prose(9, 2)}', "en"), (401, f"{prose(20, 77)} Zx9qLr2VbT7wKp4mNc8YsD1f {prose(9, 3)}", None)]
    rows += [(500, None, None), (501, "", "en"), (502, "Это обычный русский текст, который мы написали", None), (None, prose(50, 999), "en"), (503, "12 34", None)]
    n = [None if t is None else len(t) for _, t, _ in rows]
    pq.write_table(pa.table({"doc_id": pa.array([i for i, _, _ in rows], pa.int64()), "text": pa.array([t for _, t, _ in rows], pa.string()), "lang": pa.array([x for _, _, x in rows], pa.string()), "source": pa.array(["s"] * len(rows)), "n_chars": pa.array(n, pa.int64())}), folder / "documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([k for k, _ in items], pa.int64()), "text": pa.array([t for _, t in items])}), folder / "benchmark.parquet")
    return str(folder), rows, items


def one_of_each_plainly(rows):
    """The ids that stay: the least of each group linked by five-word shingles at least 0.8 alike; null ids after others."""
    sets = [set(neardup.shingle_set(t).tolist()) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for g, (i, _) in zip(group, rows, strict=True):
        best.setdefault(g, []).append(i)
    return {min((i for i in ids if i is not None), default=None) for ids in best.values()}


def test_pipeline_equals_plain_stages(spark, corpus):
    import tiktoken

    folder, rows, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.fit(docs)
    predictor = langid.Predictor(model)
    kept = []
    for i, t, _ in rows:
        lang, share, fit = predictor.judge(t)
        if lang != "und" and share >= stages.LEAST_LANGUAGE_SHARE and fit >= stages.LEAST_LANGUAGE_FIT:
            kept.append((i, t))
    assert {i for i, _ in kept} == {i for i, _, _ in rows} - {500, 501, 502, 503}
    stay = one_of_each_plainly(kept)
    kept = [(i, t) for i, t in kept if i in stay]
    assert {200, 201, 202, 203, 210, 211} - stay == {201, 202, 203, 210, 211}
    kept = [(i, t) for i, t in kept if not any(" ".join(decontam.tokens_of(p)) in " ".join(decontam.tokens_of(t)) for _, p in items)]
    tokenizer = secret_scan._tokenizer(*secret_scan._vocabulary(None))
    kept = [(i, secret_scan.redacted(t, secret_scan.spans(t, tokenizer, 2.0)[1])) for i, t in kept]
    assert sum("[SECRET]" in t for _, t in kept) == 2
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("m", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted(((i, len(ids := enc.encode_ordinary(t)), ids, hashlib.sha256(t.encode()).hexdigest()) for i, t in kept), key=repr)
    got = corpus_pipeline.run(spark, folder)
    assert sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded_sha256) for r in got.collect()), key=repr) == want


def test_stages_keep_the_columns_of_documents(spark, corpus):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    more = docs.selectExpr("*", "1 as fp", "'x' as node", "2 as component", "3 as h")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
        assert stage(spark, more, folder).columns == more.columns, name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), folder).count() == 0, name


@given
def test_pipeline_on_the_given_tables(spark):
    got = corpus_pipeline.run(spark, SF)
    assert 0 < got.count() < common.table(spark, SF, "documents").count()
