"""What the operators share: inputs, tables in the cluster's shared folder, let-bindings."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    made = f"file://{tempfile.mkdtemp(prefix='quern-')}"
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def _filesystem(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


#: Rows of a few numbers that one task writes.
ROWS_A_FILE = 250_000


def materialise(df: DataFrame, name: str, rows: int | None = None) -> tuple[DataFrame, str]:
    """Write df as a table in the shared folder and read it again; this cuts the lineage.

    Another executor can read every file of it, so a lost executor costs no more than
    its running tasks.  The table goes when the application ends, or with ``discard``.
    rows, where it is known, bounds those of df: narrow rows that fit few files are not
    spread over as many as there are shuffle partitions.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quern-{uuid.uuid4().hex[:12]}-{name}"
    if rows is not None:
        df = df.coalesce(min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + rows // ROWS_A_FILE))
    df.write.parquet(path)
    fs, where = _filesystem(spark, path)
    fs.deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, where = _filesystem(spark, path)
        fs.delete(where, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for the row, also where body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(lengths: Column, block: int = 256) -> Column:
    """Exclusive running sums of an array of integers, in blocks so that long arrays stay cheap."""
    none = F.array().cast("array<bigint>")

    def sums(x: Column) -> Column:
        return F.transform(x, lambda _, i: F.aggregate(F.slice(x, 1, i), F.lit(0).cast("bigint"), lambda a, v: a + v))

    def blocks(x: Column) -> Column:
        count = F.floor((F.size(x) - 1) / block).cast("int")
        return F.transform(F.sequence(F.lit(0), count), lambda b: F.slice(x, b * block + 1, F.lit(block)))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("bigint"), lambda a, v: a + v))
        return let(let(totals, sums), lambda before: F.flatten(F.transform(parts, lambda p, b: let(p, lambda q: F.transform(sums(q), lambda v: v + F.get(before, b))))))

    return F.when(F.size(lengths) > 0, let(lengths.cast("array<bigint>"), lambda x: let(blocks(x), joined))).otherwise(none)


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as array<struct<s,e,v>>, by code point, e exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(v: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
        steps = let(gaps, lambda g: F.transform(v, lambda m, i: F.get(g, i) + F.length(m)))
        return let(
            F.struct(gaps.alias("g"), running_sums(steps).alias("b")),
            lambda x: F.transform(
                v,
                lambda m, i: F.struct(
                    (F.get(x["b"], i) + F.get(x["g"], i)).cast("bigint").alias("s"),
                    (F.get(x["b"], i) + F.get(x["g"], i) + F.length(m)).cast("bigint").alias("e"),
                    m.alias("v"),
                ),
            ),
        )

    nothing = F.array().cast("array<struct<s:bigint,e:bigint,v:string>>")
    return let(found, lambda v: F.when(F.size(v) > 0, placed(v)).otherwise(nothing))


def map_rows(df: DataFrame, inputs: Iterable[str], make: Callable[[], Callable[..., tuple]], schema: str) -> DataFrame:
    """One output row for each input row, by Python over Arrow batches.

    make() runs once for each task and gives a function from the input columns' values
    (Python objects, null as None) to a tuple in the order of schema.
    """
    inputs = list(inputs)
    out = arrow_schema(schema)
    names = out.names

    def told(f: Callable[..., tuple], part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [f(*values) for values in zip(*(part.column(i).to_pylist() for i in range(len(inputs))), strict=True)]
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(columns, out, strict=True)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for part in slices(batches):
            yield told(f, part)  # a slice's Python objects go before the next one's are made

    return df.select(*inputs).mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about most bytes, so that Python objects of few rows exist at a time.

    Workers live on between tasks; Arrow's memory comes from the system's pool, which gives
    large blocks back at once, and what the task before held is given back first, with what
    is ``kept`` if this task has not asked for it by now.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    if not _Kept.asked:
        _Kept.by_key.clear()
    _Kept.asked = False
    give_back()
    for batch in batches:
        rows = max(1, batch.num_rows * most // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


class _Kept:
    """What this process keeps, by key, and whether the task at hand has asked for it."""

    by_key: dict = {}
    asked = False


def kept(key: Hashable, make: Callable[[], object]):
    """make(), which the worker keeps as long as its tasks ask for the same key before they read their rows.

    A worker serves the tasks of all stages, so it keeps one thing at most: the tables of one
    operator do not stay beside those of the next.
    """
    if key not in _Kept.by_key:
        let_go()
        _Kept.by_key[key] = make()
    _Kept.asked = True
    return _Kept.by_key[key]


def let_go() -> None:
    """Nothing is kept any more; for tasks that load something large of their own."""
    _Kept.by_key.clear()
    _Kept.asked = False
    give_back()


def give_back() -> None:
    """Freed memory goes from the C library to the system, where there is a way to say so."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def arrow_schema(schema: str) -> pa.Schema:
    """Of a schema as Spark writes it, such as ``id bigint,places array<int>``."""
    return to_arrow_schema(StructType.fromDDL(schema))


def typed(df: DataFrame, column: str) -> str:
    """The column with its type, as a schema lists it: ids keep whatever type they have."""
    return f"`{column}` {df.schema[column].dataType.simpleString()}"


def least_hashes(rows: DataFrame, stratum: str, digest: str, quota: int, counts: dict) -> dict:
    """Of each stratum in counts the quota-th least distinct hash, or the greatest if it has fewer: a bound that chooses a sample.

    counts has the rows of each stratum.  Only hashes under a limit, found from the counts,
    are ranked; a stratum of many repeated rows gets a higher limit until it has enough or all.
    The bounds depend on neither the partitions nor the order of the rows.
    """
    lowest, highest = -(2**63), 2**63 - 1
    share, found = {k: min(1.0, 2 * quota / max(n, 1)) for k, n in counts.items()}, {}
    while share:
        limits = F.create_map(*(F.lit(x) for k, p in share.items() for x in (k, highest if p >= 1 else min(highest, lowest + max(1, int(p * 2**64))))))
        few = rows.select(stratum, digest).where(F.col(digest) <= F.try_element_at(limits, F.col(stratum))).distinct()
        ranked = few.withColumn("_k", F.row_number().over(Window.partitionBy(stratum).orderBy(digest))).where(F.col("_k") <= quota)
        got = {r[0]: (r["n"], r["most"]) for r in ranked.groupBy(stratum).agg(F.count("*").alias("n"), F.max(digest).alias("most")).collect()}
        for k, p in list(share.items()):
            n, most = got.get(k, (0, lowest))
            if n >= quota or p >= 1:
                found[k] = most
                del share[k]
            else:
                share[k] = min(1.0, p * 16)
    return found


def chosen(rows: DataFrame, stratum: str, digest: str, bounds: dict) -> DataFrame:
    """The rows that ``least_hashes`` bounds, each text once: digest must be a hash of all the other columns."""
    if not bounds:
        return rows.where("false")
    limits = F.create_map(*(F.lit(x) for k, v in bounds.items() for x in (k, v)))
    return rows.where(F.col(digest) <= F.try_element_at(limits, F.col(stratum))).dropDuplicates()
