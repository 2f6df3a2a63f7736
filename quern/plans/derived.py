"""Relations derived from the tables at hand, each by an expression that SQL can say as well."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import tokens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokens_of(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, tok)"""
    return docs.select("doc_id", F.posexplode(tokens(F.col("text"))).alias("pos", "tok"))


def misread(pos: Column, tok: Column) -> Column:
    """A token as it is read: every 17th is lost (null), every 5th misread."""
    return F.when(pos % 17 == 16, F.lit(None)).when(pos % 5 == 3, F.translate(tok, "aeo", "123")).otherwise(tok)


def predictions(toks: DataFrame) -> DataFrame:
    """(doc_id, pos, tok, read): every 17th token is lost (null), every 5th misread."""
    return toks.withColumn("read", misread(F.col("pos"), F.col("tok")))


def boxes(toks: DataFrame) -> DataFrame:
    """(page, place, text, l, t, r, b, conf): tokens laid out 8 to a line, 30 lines to a column, two columns to a page."""
    at = F.col("pos") % 480
    line, column = F.floor(at / 8) % 30, F.floor(at / 240)
    left = column * 1000 + (F.col("pos") % 8) * 110
    bottom = line * 30 + 20 + F.col("pos") % 3
    return toks.select(
        (F.col("doc_id") * 1000 + F.floor(F.col("pos") / 480)).alias("page"), at.alias("place"), F.col("tok").alias("text"),
        left.cast("double").alias("l"), (bottom - 20).cast("double").alias("t"), (left + F.least(F.lit(100), 10 * F.length("tok"))).cast("double").alias("r"), bottom.cast("double").alias("b"),
        F.lit(0.9).alias("conf"),
    )


def laid_apart(docs: DataFrame) -> bool:
    """Whether each page's boxes come from one row of docs, so that they lie together: no id is there twice, and no text reaches the pages of the next id."""
    held = docs.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("most"))
    return held.where((F.col("n") > 1) | (F.col("most") >= 2 * 480 * 1000 - 1)).isEmpty()


TOKENS = r"""tokens AS (SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS tok
    FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS a FROM documents))"""
PREDICTIONS = TOKENS + """, pred AS (SELECT doc_id, pos, tok, CASE WHEN pos % 17 = 16 THEN NULL WHEN pos % 5 = 3 THEN translate(tok, 'aeo', '123') ELSE tok END AS read FROM tokens)"""
BOXES = TOKENS + """, boxes AS (SELECT doc_id * 1000 + pos // 480 AS page, CAST(pos % 480 AS INT) AS place, tok AS text,
    CAST(((pos % 480) // 240) * 1000 + (pos % 8) * 110 AS DOUBLE) AS l, CAST(((pos % 480) // 8 % 30) * 30 + pos % 3 AS DOUBLE) AS t,
    CAST(((pos % 480) // 240) * 1000 + (pos % 8) * 110 + least(100, 10 * length(tok)) AS DOUBLE) AS r, CAST(((pos % 480) // 8 % 30) * 30 + pos % 3 + 20 AS DOUBLE) AS b FROM tokens)"""

#: Latin letters put as Armenian and as Cyrillic ones, so that the texts at hand say something about scripts.
TO_ARMENIAN = ("abdeghijklmnoprstuvyz", "աբդեգհիջկլմնոպրստւվյզ")
TO_CYRILLIC = ("abdegiklmnoprstuvz", "абдегиклмнопрстувз")
TO_BOTH = ("aeort", "аեօрտ")


def scripted(docs: DataFrame) -> DataFrame:
    """docs with three texts of four in other letters: Armenian (with its ligature in some), Cyrillic, and mixed within words."""
    armenian = F.translate("text", *TO_ARMENIAN)
    armenian = F.when(F.col("doc_id") % 8 == 0, F.replace(armenian, F.lit("եւ"), F.lit("և"))).otherwise(armenian)
    kind = F.col("doc_id") % 4
    return docs.withColumn("text", F.when(kind == 0, armenian).when(kind == 1, F.translate("text", *TO_CYRILLIC)).when(kind == 2, F.translate("text", *TO_BOTH)).otherwise(F.col("text")))


SCRIPTED = f"""scripted AS (SELECT * REPLACE (CASE doc_id % 4 WHEN 0 THEN CASE WHEN doc_id % 8 = 0 THEN replace(translate(text, '{TO_ARMENIAN[0]}', '{TO_ARMENIAN[1]}'), 'եւ', 'և') ELSE translate(text, '{TO_ARMENIAN[0]}', '{TO_ARMENIAN[1]}') END
    WHEN 1 THEN translate(text, '{TO_CYRILLIC[0]}', '{TO_CYRILLIC[1]}') WHEN 2 THEN translate(text, '{TO_BOTH[0]}', '{TO_BOTH[1]}') ELSE text END AS text) FROM documents)"""
SCRIPTED_TOKENS = SCRIPTED + r""", tokens AS (SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS tok FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS a FROM scripted))"""


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the folder that the cluster shares, as ``spark.checkpoint.dir`` names it; it goes when the application ends.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='quern-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    path = f"{found.rstrip('/')}/quern-{uuid.uuid4().hex[:12]}-{name}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def rehearsal(params: dict) -> dict:
    """What an API of page indexes would say: an index ``Work <n>`` has n pages, told 7 at a time; page texts by title, some of which fail."""
    if "titles" in params:
        number = int(params["titles"].rsplit("/", 1)[1])
        if number % 10 == 3:
            return {"error": "no such page"}
        return {"query": {"pages": {str(number): {"revisions": [{"slots": {"main": {"*": f"text of {params['titles']}"}}, "revid": 7 * number}]}}}}
    index, first = params["gprppiititle"], int(params.get("gprppiicontinue", 0))
    count = int(index.rsplit(" ", 1)[1])
    pages = {str(i): {"title": f"{index}/{i}", "pageid": 1000 * count + i, "proofread": {} if i % 6 == 5 else {"quality": i % 5}} for i in range(first, min(first + 7, count))}
    return {"query": {"pages": pages}} | ({"continue": {"gprppiicontinue": first + 7}} if first + 7 < count else {})
