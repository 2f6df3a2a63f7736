"""Queries of single predicates, joins and roll-ups, on the tables at hand or on texts put in other letters."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import arrays, charset, text
from quern.operators import align, checks, ctc, holdout, metrics, profile, runs, sampling

from .derived import BOXES, PREDICTIONS, SCRIPTED, SCRIPTED_TOKENS, TOKENS, boxes, laid_apart, predictions, scripted, table, tokens_of
from .registry import query

_CLASS = charset.in_class(charset.charset())

# Text


@query("SELECT doc_id, upper(replace(replace(text, 'ß', 's'), 'և', 'եվ')) AS line FROM (SELECT doc_id, text FROM scripted_ WHERE doc_id % 8 = 0)".replace("scripted_", f"(WITH {SCRIPTED} SELECT * FROM scripted)"))
def upper_lines(spark, sf):
    return scripted(table(spark, sf, "documents")).where("doc_id % 8 = 0").select("doc_id", text.upper_case_line(F.translate("text", "ß", "s")).alias("line"))


@query("SELECT doc_id, replace(replace(text, '.', '․'), '․', '.') AS folded FROM documents")
def punctuation_folded(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.fold_punctuation(F.replace("text", F.lit("."), F.lit("․"))).alias("folded"))


_ODD = "replace(replace(replace(replace(replace(replace(text, ',', '−'), ';', '―'), ' a', chr(65279) || ' a'), 'th', chr(173) || 'th'), 'qu', '¬'), 'es', 'ﬓ')"


@query(f"SELECT doc_id, replace(replace(replace(replace(replace(replace({_ODD}, '−', '–'), '―', '—'), chr(65279), ''), chr(173), ''), '¬', '-'), 'ﬓ', 'մն') AS clean FROM documents")
def substituted_marks(spark, sf):
    odd = F.expr(_ODD.replace("chr(65279)", "'﻿'").replace("chr(173)", "'\xad'"))
    return table(spark, sf, "documents").select("doc_id", text.substitute(odd).alias("clean"))


_WIKI = "'{| class=x' || chr(10) || '|-' || chr(10) || '! ' || url || chr(10) || '| a || b' || chr(10) || '|}' || chr(10) || 'after !! all'"


@query(rf"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace({_WIKI}, '(?m)^[ \t]*(\{{\||\|\}}|\|-|\|\+).*$', '', 'g'), '(?m)^[ \t]*[|!][ \t]*', '', 'g'), '[ \t]*(\|\||!!)[ \t]*', ' ', 'g') AS stripped FROM pages""")
def tables_stripped(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_tables(F.expr(_WIKI.replace("chr(10)", "'\n'"))).alias("stripped"))


@query(rf"""WITH {SCRIPTED}, t AS (SELECT doc_id, regexp_extract_all(replace(replace(text, 'e', ''''), '.', ':'), '(\s+|\S+)') AS parts FROM scripted)
    SELECT doc_id, array_to_string(list_transform(parts, lambda t: CASE WHEN regexp_matches(t, '[Ա-Ֆա-և]') THEN regexp_replace(translate(t, '’ˈ`′´', '՚՚՝՛՛'), ':([^\p{{L}}\p{{N}}_]*)$', '։\1') ELSE t END), '') AS folded FROM t""")
def tokens_folded(spark, sf):
    marked = F.replace(F.replace("text", F.lit("e"), F.lit("'")), F.lit("."), F.lit(":"))
    return scripted(table(spark, sf, "documents")).select("doc_id", text.fold_tokens(marked).alias("folded"))


@query("SELECT doc_id, array_to_string(list_transform(range(1, 5), lambda i: regexp_replace(CAST(CAST('0x' || substr(md5(doc_id || '|' || i), 1, 6) AS INT) % 499 + 1 AS VARCHAR), '^2', '22')), ', ') AS line FROM documents")
def index_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.index_line(F.col("doc_id").cast("string")).alias("line"))


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS said FROM conversations GROUP BY conv_id")
def lines_joined(spark, sf):
    said = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("s"))
    return said.select("conv_id", text.joined_lines(F.transform("s", lambda x: x["text"])).alias("said"))


@query("SELECT DISTINCT source, regexp_replace(source, '^src', '') AS needle FROM documents")
def title_needles(spark, sf):
    titled = table(spark, sf, "documents").select("source", F.concat("source", F.when(F.length("source") > 4, ".djvu").otherwise(".pdf")).alias("title")).distinct()
    return titled.select("source", text.needle(F.col("title"), "src").alias("needle"))


@query(f"SELECT sha256('{charset.charset().replace(chr(39), chr(39) * 2)}') AS stamp, CAST({len(charset.charset())} AS BIGINT) AS classes")
def charset_stamp(spark, sf):
    checks.same_width(charset.charset(), len(charset.charset()) + 1)
    return spark.range(1).select(charset.stamp(charset.charset()).alias("stamp"), F.lit(len(charset.charset())).cast("bigint").alias("classes"))


_CYRILLIC = charset.CYRILLIC_UPPER + charset.CYRILLIC_LOWER


@query(f"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN ltrim(CASE WHEN contains(text, 'é') THEN 'é' ELSE '' END || ' and all of Cyrillic') ELSE CASE WHEN contains(text, 'é') THEN 'é' ELSE '' END || 'я' END AS phrase FROM documents""")
def gap_phrases(spark, sf):
    more = F.when(F.col("text").contains("é"), F.array(F.lit("é"))).otherwise(F.array().cast("array<string>"))
    gaps = F.when(F.col("doc_id") % 2 == 0, F.concat(F.array(*map(F.lit, _CYRILLIC)), more)).otherwise(F.concat(F.array(F.lit("я")), more))
    return table(spark, sf, "documents").select("doc_id", charset.describe_gaps(gaps).alias("phrase"))


@query("SELECT doc_id, list_sort(list_filter(['a', 'q', 'z', 'é', 'ß'], lambda c: NOT contains(text, c))) AS missing FROM documents")
def missing_characters(spark, sf):
    wanted = F.array(*map(F.lit, "aqzéß"))
    return table(spark, sf, "documents").select("doc_id", F.array_sort(F.array_except(wanted, charset.characters(F.col("text")))).alias("missing"))


# Predicates


@query(f"""WITH {SCRIPTED_TOKENS}, marked AS (SELECT doc_id, pos, tok, length(tok) <= 24 AND NOT regexp_matches(tok, '[^{_CLASS}]') AND NOT (regexp_matches(tok, '[А-Яа-яЁё]') AND regexp_matches(tok, '[Ա-Ֆա-ևA-Za-z]')) AS ok FROM tokens),
    islands AS (SELECT doc_id, pos, tok, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM marked WHERE ok)
    SELECT doc_id, CAST(min(pos) AS INT) AS start, array_to_string(list(tok ORDER BY pos), ' ') AS run FROM islands GROUP BY doc_id, island""")
def usable_runs(spark, sf):
    usable = lambda t: (F.length(t) <= 24) & charset.is_covered(t, charset.charset()) & ~charset.mixes_cyrillic(t)
    return runs.token_runs(scripted(table(spark, sf, "documents")), usable).withColumn("run", F.array_join("run", " "))


@query(f"""WITH {SCRIPTED_TOKENS}, t AS (SELECT doc_id, bool_or(regexp_matches(tok, '[А-Яа-яЁё]')) AS cyrillic, bool_or(regexp_matches(tok, '[А-Яа-яЁё]') AND regexp_matches(tok, '[Ա-Ֆա-ևA-Za-z]')) AS mixed FROM tokens GROUP BY doc_id)
    SELECT documents.doc_id, COALESCE(cyrillic, FALSE) AS cyrillic, COALESCE(mixed, FALSE) AS mixed FROM documents LEFT JOIN t ON documents.doc_id = t.doc_id""")
def any_token_flags(spark, sf):
    held = scripted(table(spark, sf, "documents")).select("doc_id", text.tokens(F.coalesce("text", F.lit(""))).alias("t"))
    return held.select("doc_id", charset.any_token("t", lambda x: x.rlike("[А-Яа-яЁё]")).alias("cyrillic"), charset.any_token("t", charset.mixes_cyrillic).alias("mixed"))


@query(f"""WITH {PREDICTIONS}, c AS (SELECT doc_id, pos, tok, CASE WHEN pos % 7 = 2 THEN read || '-' WHEN pos % 7 = 4 THEN read || '-"' ELSE read END AS read, CASE WHEN pos % 14 = 2 THEN tok || '-' ELSE tok END AS label FROM pred WHERE read IS NOT NULL)
    SELECT doc_id, pos FROM c WHERE regexp_matches(regexp_replace(read, '["''`«»“”]+$', ''), '[-–—֊]$') AND NOT regexp_matches(label, '[-–—֊]$')""")
def broken_words(spark, sf):
    read = predictions(tokens_of(table(spark, sf, "documents"))).where("read is not null")
    seen = F.when(F.col("pos") % 7 == 2, F.concat("read", F.lit("-"))).when(F.col("pos") % 7 == 4, F.concat("read", F.lit('-"'))).otherwise(F.col("read"))
    label = F.when(F.col("pos") % 14 == 2, F.concat("tok", F.lit("-"))).otherwise(F.col("tok"))
    return read.where(text.ends_in_break(seen, label)).select("doc_id", "pos")


@query(f"""WITH {BOXES}, m AS (SELECT page, place, text, l, t, r, b, median(b - t) OVER (PARTITION BY page) AS m, CASE WHEN place % 6 = 1 THEN text || '-' ELSE text END AS predicted FROM boxes)
    SELECT page, place FROM m WHERE length(text) BETWEEN 1 AND 60 AND NOT regexp_matches(text, '[^{_CLASS}]') AND b - t >= 12 AND r > l AND b - t <= 2 * m AND NOT (regexp_matches(predicted, '[-–—֊]$') AND NOT regexp_matches(text, '[-–—֊]$')
        OR regexp_matches(regexp_replace(predicted, '["''`«»“”]+$', ''), '[-–—֊]$') AND NOT regexp_matches(text, '[-–—֊]$'))""")
def whole_word_crops(spark, sf):
    docs = table(spark, sf, "documents")
    crops = boxes(tokens_of(docs)).drop("conf").withColumnRenamed("text", "label")
    crops = crops.withColumn("predicted", F.when(F.col("place") % 6 == 1, F.concat("label", F.lit("-"))).otherwise(F.col("label")))
    return align.usable_crops(crops, charset.ranges(charset.charset()), ["page"], together=laid_apart(docs)).select("page", "place")


@query("SELECT doc_id, quality FROM labels WHERE quality >= 1")
def quality_floor(spark, sf):
    return profile.at_quality(table(spark, sf, "labels"), 1, floors=(0, 1)).select("doc_id", "quality")


@query("SELECT source, doc_id AS page FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents WHERE doc_id BETWEEN 10 AND 500) WHERE i <= 4")
def first_pages(spark, sf):
    return holdout.first_pages(table(spark, sf, "documents").select("source", F.col("doc_id").alias("page")), 4, spec=list(range(10, 501)))


@query(f"WITH {PREDICTIONS} SELECT doc_id, pos, CASE WHEN read = tok THEN 'exact' ELSE 'near' END AS tier FROM pred WHERE read IS NOT NULL AND read <> tok")
def tier_filter(spark, sf):
    read = predictions(tokens_of(table(spark, sf, "documents"))).where("read is not null")
    return read.select("doc_id", "pos", F.when(F.col("read") == F.col("tok"), "exact").otherwise("near").alias("tier")).where(F.col("tier").isin("near", "bracketed"))


@query("SELECT doc_id, length(trim(translate(text, 'abcdefghijklm', ''))) AS kept FROM documents WHERE length(trim(translate(text, 'abcdefghijklm', ''))) > 0")
def blank_dropped(spark, sf):
    from quern.streaming.manifest import cleaned

    held = cleaned(table(spark, sf, "documents").select("doc_id", "text"), lambda c: F.trim(F.translate(c, "abcdefghijklm", "")), 3)
    return held.select("doc_id", F.length("text").cast("bigint").alias("kept"))


@query("SELECT source, count(*) AS pages FROM documents WHERE doc_id % 3 <> 0 GROUP BY source")
def current_only(spark, sf):
    """Refused if a page of an older cleaning, or of another work, were among them."""
    pages = table(spark, sf, "documents").withColumns({"cleaning": F.when(F.col("doc_id") % 3 != 0, 4), "index": F.lit("Work")}).where("cleaning is not null")
    checks.refuse_stale(pages, 4)
    checks.refuse_change(pages, "index", "Work")
    checks.refuse_duplicates(pages, "doc_id", "text")
    return pages.groupBy("source").agg(F.count("*").alias("pages"))


@query("SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '[^A-Za-z .,\\n]')")
def known_letters_only(spark, sf):
    return table(spark, sf, "documents").where(charset.is_covered(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz .,\n")).select("doc_id")


# Joins


@query("""WITH c AS (SELECT source, count(*) AS pages FROM documents GROUP BY source), t AS (SELECT source, max(n_chars) AS longest, min(doc_id) AS first FROM documents WHERE lang = 'en' GROUP BY source)
    SELECT c.source, pages, CASE WHEN pages >= 8 THEN longest END AS longest FROM c LEFT JOIN t ON c.source = t.source""")
def conditional_lookup(spark, sf):
    docs = table(spark, sf, "documents")
    costly = docs.where("lang = 'en'").groupBy("source").agg(F.max("n_chars").alias("longest"))
    return profile.looked_up(docs.groupBy("source").agg(F.count("*").alias("pages")), costly, "source", F.col("pages") >= 8).select("source", "pages", "longest")


_MARKED = r"""m AS (SELECT source, CAST(sum(len(regexp_extract_all(text, '\p{L}'))) AS BIGINT) AS letters, CAST(sum(len(regexp_extract_all(text, '[éèêàâçñóíáúü]'))) AS BIGINT) AS accents FROM documents GROUP BY source),
    verdicts AS (SELECT source, CASE WHEN letters < 500 THEN 'unknown' WHEN accents * 1000.0 / letters >= 40 THEN 'classical' WHEN accents * 1000.0 / letters <= 25 THEN 'reformed' ELSE 'mixed' END AS verdict FROM m)"""


@query(f"""WITH {_MARKED}, census AS (SELECT source, count(quality) AS proofread FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)
    SELECT verdict, count(*) AS works, CAST(sum(proofread) AS BIGINT) AS proofread FROM census JOIN verdicts USING (source) GROUP BY verdict""")
def census_by_verdict(spark, sf):
    docs = table(spark, sf, "documents")
    counted = profile.marker_counts(docs, "source", {"letters": r"\p{L}", "accents": "[éèêàâçñóíáúü]"})
    verdicts = counted.select("source", profile.verdict(F.col("letters"), profile.rate(F.col("accents"), F.col("letters")), 40, 25).alias("verdict"))
    census = docs.join(table(spark, sf, "labels"), "doc_id", "left").groupBy("source").agg(F.count("quality").alias("proofread"))
    return census.join(verdicts, "source").groupBy("verdict").agg(F.count("*").alias("works"), F.sum("proofread").alias("proofread"))


_FACES = """faces AS (SELECT doc_id AS file, CASE doc_id % 3 WHEN 0 THEN 'arnamu' WHEN 1 THEN 'noto' ELSE 'sylfaen' END AS family FROM documents WHERE doc_id % 11 <> 5),
    lines AS (SELECT doc_id AS file, CASE WHEN doc_id % 2 = 0 THEN 'display' ELSE 'control' END AS half, substr(text, 1, 60) AS label, CASE WHEN doc_id % 4 = 1 THEN translate(substr(text, 1, 60), 'aeo', '123') ELSE substr(text, 1, 60) END AS read FROM documents)"""


def _faced(spark, sf):
    docs, d = table(spark, sf, "documents"), F.col("doc_id")
    faces = docs.where(d % 11 != 5).select(d.alias("file"), F.when(d % 3 == 0, "arnamu").when(d % 3 == 1, "noto").otherwise("sylfaen").alias("family"))
    label = F.substring("text", 1, 60)
    lines = docs.select(d.alias("file"), F.when(d % 2 == 0, "display").otherwise("control").alias("half"), label.alias("label"), F.when(d % 4 == 1, F.translate(label, "aeo", "123")).otherwise(label).alias("read"))
    return lines.join(faces, "file")


@query(f"WITH {_FACES} SELECT file, half, family, label FROM lines JOIN faces USING (file)")
def labels_with_faces(spark, sf):
    return _faced(spark, sf).select("file", "half", "family", "label")


@query(f"""WITH {_FACES} SELECT half, family, count(*) AS lines, round(avg(CASE WHEN read = label THEN 1.0 ELSE 0.0 END), 6) AS exact,
    round(avg(CASE WHEN length(label) = 0 OR length(read) = 0 THEN 0.0 ELSE 1 - levenshtein(label, read) / greatest(length(label), length(read)) END), 6) AS similarity FROM lines JOIN faces USING (file) GROUP BY half, family""")
def family_by_half(spark, sf):
    return metrics.exact_by(_faced(spark, sf), ["half", "family"])


_CELLS = "backends(backend) AS (VALUES ('a'), ('b')), cells AS (SELECT backend, doc_id AS page, source, CASE WHEN (doc_id % 9 = 0 AND backend = 'b') OR source LIKE '%3' THEN NULL ELSE n_chars % 100 / 100.0 END AS score FROM documents, backends)"


def _cells(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("page"), "source", (F.col("n_chars") % 100 / 100.0).alias("score"))
    backends = spark.createDataFrame([("a",), ("b",)], "backend string")
    read = docs.crossJoin(F.broadcast(backends)).where("not (page % 9 = 0 and backend = 'b') and source not like '%3'").select("backend", "page", "score")
    return metrics.cells(backends, docs.select("page", "source"), read, ["backend", "page"])


@query(f"WITH {_CELLS} SELECT backend, page, source, round(score, 6) AS score FROM cells")
def cells_with_failures(spark, sf):
    return _cells(spark, sf).select("backend", "page", "source", F.round("score", 6).alias("score"))


@query(f"WITH {_CELLS}, r AS (SELECT backend, source, avg(score) AS score FROM cells GROUP BY backend, source HAVING count(score) > 0) SELECT backend, count(*) AS registers, round(avg(score), 6) AS score FROM r GROUP BY backend")
def bundles_by_register(spark, sf):
    return metrics.by_register(_cells(spark, sf), "backend", "source", ["score"])


@query("""SELECT o_orderkey, c_name, COALESCE(c_mktsegment, '') AS segment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) c ON o_custkey = c_custkey""")
def edition_metadata(spark, sf):
    known = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(known, "o_custkey", "left").select("o_orderkey", "c_name", F.coalesce("c_mktsegment", F.lit("")).alias("segment"))


@query(f"WITH {PREDICTIONS}, p AS (SELECT doc_id, count(read) AS n FROM pred WHERE doc_id % 3 <> 1 GROUP BY doc_id), t AS (SELECT doc_id, n_chars FROM documents WHERE doc_id % 4 <> 2) SELECT doc_id, n, n_chars FROM p JOIN t USING (doc_id)")
def predictions_with_truth(spark, sf):
    """Pages that either side lacks are skipped; they are no zeros."""
    read = predictions(tokens_of(table(spark, sf, "documents").where("doc_id % 3 <> 1"))).groupBy("doc_id").agg(F.count("read").alias("n"))
    return read.join(table(spark, sf, "documents").where("doc_id % 4 <> 2").select("doc_id", "n_chars"), "doc_id")


@query(f"""WITH {BOXES}, paired AS (SELECT page, place, CASE WHEN place % 5 = 4 THEN NULL ELSE (place * 7) % 480 END AS truth_at FROM boxes WHERE page % 1000 = 0)
    SELECT page, place, row_number() OVER (PARTITION BY page ORDER BY truth_at NULLS LAST, place) - 1 AS ideal FROM paired""")
def oracle_positions(spark, sf):
    held = boxes(tokens_of(table(spark, sf, "documents"))).where("page % 1000 = 0").select("page", F.col("place").cast("int").alias("place"))
    paired = held.where("place % 5 <> 4").select("page", "place", F.explode(F.array((F.col("place") * 7) % 480, (F.col("place") * 7) % 480 + 480)).alias("truth_at"))
    return align.oracle_order(held, paired, "page").select("page", "place", F.col("ideal").cast("bigint").alias("ideal"))


@query(f"WITH {BOXES} SELECT page, place, greatest(0, l - (b - t) * 0.1) AS l, greatest(0, t - (b - t) * 0.1) AS t, least(1500, r + (b - t) * 0.1) AS r, least(800, b + (b - t) * 0.1) AS b FROM boxes WHERE page % 1000 = 0")
def crop_margins(spark, sf):
    held = boxes(tokens_of(table(spark, sf, "documents"))).where("page % 1000 = 0")
    grown = align.margin(*(F.col(c) for c in "ltrb"), 1500, 800)
    return held.select("page", F.col("place").cast("int").alias("place"), *(c.alias(n) for c, n in zip(grown, "ltrb", strict=True)))


# Roll-ups


@query(f"""WITH {SCRIPTED_TOKENS}, f AS (SELECT doc_id, regexp_matches(tok, '[А-Яа-яЁё]') AS cyrillic, regexp_matches(tok, '[А-Яа-яЁё]') AND regexp_matches(tok, '[Ա-Ֆա-ևA-Za-z]') AS mixed FROM tokens)
    SELECT source, count(*) AS n, count(*) FILTER (WHERE cyrillic) AS cyrillic, count(*) FILTER (WHERE mixed) AS mixed, round(count(*) FILTER (WHERE cyrillic) / count(*), 6) AS cyrillic_share, round(count(*) FILTER (WHERE mixed) / count(*), 6) AS mixed_share
    FROM f JOIN documents USING (doc_id) GROUP BY source""")
def script_shares(spark, sf):
    toks = scripted(table(spark, sf, "documents")).select("source", F.explode(text.tokens(F.col("text"))).alias("tok"))
    return profile.shares(toks, ["source"], {"cyrillic": F.col("tok").rlike("[А-Яа-яЁё]"), "mixed": charset.mixes_cyrillic(F.col("tok"))})


@query(f"""WITH {PREDICTIONS} SELECT source, doc_id AS page, count(*) AS boxes, count(read) AS crops, round(count(read) / count(*), 6) AS share FROM pred JOIN documents USING (doc_id) GROUP BY source, doc_id""")
def page_statistics(spark, sf):
    docs = table(spark, sf, "documents")
    each = docs.select("source", "doc_id", text.tokens(F.col("text")).alias("t")).where("size(t) > 0")
    lost = F.floor((F.size("t") + 0) / 17)
    return each.select("source", F.col("doc_id").alias("page"), F.size("t").cast("bigint").alias("boxes"), (F.size("t") - lost).cast("bigint").alias("crops"), F.round((F.size("t") - lost) / F.size("t"), 6).alias("share"))


@query(f"""WITH {PREDICTIONS} SELECT source, CASE WHEN read = tok THEN 'exact' ELSE 'near' END AS tier, CASE WHEN doc_id % 40 = 0 THEN 'val' ELSE 'train' END AS split, count(*) AS crops FROM pred JOIN documents USING (doc_id) WHERE read IS NOT NULL GROUP BY ALL""")
def crop_summary(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", F.posexplode(text.tokens(F.col("text"))).alias("pos", "tok"))
    read = predictions(docs).where("read is not null")
    tier, split = F.when(F.col("read") == F.col("tok"), "exact").otherwise("near"), F.when(F.col("doc_id") % 40 == 0, "val").otherwise("train")
    return read.groupBy("source", tier.alias("tier"), split.alias("split")).agg(F.count("*").alias("crops"))


@query()
def stage_means(spark, sf):
    said = table(spark, sf, "conversations").select("text", F.substring("text", 1, 400).alias("line")).where("line <> ''")
    stages = {"misread": F.translate("line", "aeo", "123"), "folded": F.translate("line", "a", "1"), "lost": F.when(F.length("line") % 3 > 0, F.col("line"))}
    return metrics.stage_means(said, stages, F.col("line"))


@query("SELECT o_orderkey, round(avg(CAST(o_orderkey % 1000 AS DOUBLE)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS running_mean FROM orders")
def running_means(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 1000).cast("double").alias("q"))
    return metrics.running_mean(rows, "q", "o_orderkey", ["o_custkey"]).select("o_orderkey", F.round("running_mean", 6).alias("running_mean"))


@query("""WITH l AS (SELECT doc_id, row_number() OVER (ORDER BY md5('fam|' || doc_id), doc_id) - 1 AS i FROM documents) SELECT doc_id, ['arnamu', 'noto', 'sylfaen'][i // 40 + 1] AS family, CAST(i % 40 AS INT) AS slot FROM l WHERE i < 120""")
def family_allocation(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.md5(F.concat(F.lit("fam|"), F.col("doc_id").cast("string"))).alias("h"))
    return sampling.family_allocation(lines, ["noto", "arnamu", "sylfaen"], 40, ["h", "doc_id"]).select("doc_id", "family", "slot")


@query("""SELECT CAST(row_number() OVER (ORDER BY source, doc_id) AS BIGINT) AS place, source, doc_id FROM (SELECT source, doc_id FROM documents WHERE lang = 'es')""")
def in_page_order(spark, sf):
    """Sorted by (source, page); the place of a row in the report is what the order gives it."""
    rows = table(spark, sf, "documents").where("lang = 'es'").select("source", "doc_id")
    return sampling.numbered(rows, "source", ["doc_id"]).select("place", "source", "doc_id")


# Paths and images


@query("""WITH p AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings), on_ AS (SELECT vec_id, i, lag(i) OVER (PARTITION BY vec_id ORDER BY i) AS before, lead(i) OVER (PARTITION BY vec_id ORDER BY i) AS after FROM p WHERE x > 0)
    SELECT vec_id, list(CAST(i AS INT) ORDER BY i) FILTER (WHERE before IS NULL OR before <> i - 1) AS firsts, list(CAST(i AS INT) ORDER BY i) FILTER (WHERE after IS NULL OR after <> i + 1) AS lasts FROM on_ GROUP BY vec_id""")
def consecutive_runs(spark, sf):
    at = F.filter(F.transform("embedding", lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull())
    held = table(spark, sf, "embeddings").select("vec_id", at.alias("at")).where("size(at) > 0")
    return held.select("vec_id", arrays.consecutive(F.col("at")).alias("firsts"), arrays.consecutive(F.col("at"), last=True).alias("lasts"))


@query("""WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(abs(x) * 20) % 7 AS INT)) AS path FROM embeddings),
    e AS (SELECT vec_id, len(path) AS n, unnest(path) AS c, CAST(unnest(range(len(path))) AS INT) AS i FROM p), near AS (SELECT *, lag(c) OVER w AS b, lead(c) OVER w AS a FROM e WINDOW w AS (PARTITION BY vec_id ORDER BY i)),
    marks AS (SELECT vec_id, n, i, CASE WHEN c <= 2 THEN 'th' ELSE 'en' END AS name, c IN (1, 3) AS opens FROM near WHERE (c IN (1, 3) AND a IS DISTINCT FROM c) OR (c IN (2, 4) AND b IS DISTINCT FROM c)),
    opened AS (SELECT *, max(CASE WHEN opens THEN i END) OVER w AS since, arg_max(CASE WHEN opens THEN name END, CASE WHEN opens THEN i END) OVER w AS held FROM marks WINDOW w AS (PARTITION BY vec_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    closed AS (SELECT *, bool_and(name = held) OVER (PARTITION BY vec_id, since ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fits FROM opened WHERE NOT opens AND since IS NOT NULL),
    parts AS (SELECT vec_id, n, i, name, since, COALESCE(lag(i) OVER (PARTITION BY vec_id ORDER BY i) + 1, 0) AS start FROM closed WHERE fits)
    SELECT vec_id, '' AS name, start AS first, since - 1 AS last FROM parts WHERE since > start UNION ALL SELECT vec_id, name, since + 1, i - 1 FROM parts
    UNION ALL SELECT p.vec_id, '', COALESCE(d.done, 0), CAST(len(path) - 1 AS INT) FROM p LEFT JOIN (SELECT vec_id, max(i) + 1 AS done FROM parts GROUP BY vec_id) d ON p.vec_id = d.vec_id WHERE COALESCE(d.done, 0) < len(path)""")
def word_segments(spark, sf):
    path = F.transform("embedding", lambda x: (F.floor(F.abs(x) * 20) % 7).cast("int"))
    held = table(spark, sf, "embeddings").select("vec_id", path.alias("path"))
    return held.select("vec_id", F.explode(ctc.segments(F.col("path"), {"th": (1, 2), "en": (3, 4)})).alias("s")).select("vec_id", "s.*")


@query("SELECT vec_id, list_concat(embedding, list_transform(range(80 - len(embedding)), lambda i: embedding[len(embedding)])) AS pixels, CAST(least(ceil(len(embedding) * 32 / 20), 100) AS INT) AS width FROM embeddings")
def padded_right(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", arrays.padded(F.col("embedding"), 80).alias("pixels"), arrays.scaled_width(F.size("embedding"), F.lit(20), 32, 100).alias("width"))


@query("""SELECT vec_id, list_transform(embedding, lambda x: round(least(255.0, greatest(0.0, (abs(CAST(x AS DOUBLE)) * 255 - 12.5 + 25) * 200.0 / greatest(10.0, 90.0 - 12.5))), 5)) AS pixels FROM embeddings""")
def contrast_stretched(spark, sf):
    pixels = F.transform("embedding", lambda x: F.abs(x.cast("double")) * 255)
    return table(spark, sf, "embeddings").select("vec_id", F.transform(metrics.stretched(pixels, F.lit(12.5), F.lit(90.0)), lambda x: F.round(x, 5)).alias("pixels"))
