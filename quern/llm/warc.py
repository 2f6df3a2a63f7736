"""WARC records and the fixity of their replicas.

Every record is hashed.  A file's byte offsets are cut into ranges of ``LEAF`` bytes, those
into ranges of ``FAN`` of them, and so on; a range's hash is that of what it holds, in
order.  Two replicas whose roots agree are equal.  Where roots differ, only the ranges below
differing ones are compared, down to the records.

Both replicas' trees grow in the same aggregations, side by side in the columns ``one`` and
``two``, so an audit writes one table of each level and what it found.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, map_rows, materialise

LEAF, FAN = 1 << 16, 16


# Records as bytes.

def write_record(uri: str, body: bytes, record_id: str, kind: str = "response", date: str = "1970-01-01T00:00:00Z", compress: bool = False) -> bytes:
    """One WARC/1.1 record; with compress, as a gzip member of its own."""
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nWARC-Record-ID: <{record_id}>\r\nWARC-Date: {date}\r\nContent-Length: {len(body)}\r\n\r\n"
    record = head.encode() + body + b"\r\n\r\n"
    return gzip.compress(record, mtime=0) if compress else record


def _members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, plain bytes) of each gzip member; bytes that begin none, or one that is damaged, are passed over."""
    at = content.find(b"\x1f\x8b\x08")
    while at >= 0:
        unpack = zlib.decompressobj(wbits=31)
        try:
            plain = unpack.decompress(content[at:])
            stop = len(content) - len(unpack.unused_data)
        except zlib.error:
            plain, stop = b"", at + 1
        if plain:
            yield at, stop - at, plain
        at = content.find(b"\x1f\x8b\x08", stop)


def read_records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, body) of each record of a file of plain records or of gzip members.

    Bytes that begin no record are passed over up to the next that does; a record cut by
    the end of the file is given as far as it goes.  Of a member, which holds one record,
    offset and length are those of its compressed bytes.
    """
    if content.startswith(b"\x1f\x8b"):
        for at, length, plain in _members(content):
            for _, _, headers, body in read_records(plain):
                yield at, length, headers, body
        return
    at = content.find(b"WARC/1.")
    while at >= 0:
        end = content.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = headers.get("content-length", "")
        stop = end + 4 + (int(size) if size.isdigit() else 0)
        yield at, min(stop + 4, len(content)) - at, headers, content[end + 4 : stop]
        at = content.find(b"WARC/1.", stop)


def records_of(files: DataFrame, file: str = "path", content: str = "content") -> DataFrame:
    """(file, record_offset, record_length, digest, uri) of every record of binary files (columns path and content).

    The digest is that of the bytes as stored.  Null and empty files have no records.  A file
    must fit a row, as Spark's binaryFile source gives it.
    """

    def row(name, data):
        found = ((a, n, hashlib.sha256(data[a : a + n]).hexdigest(), h.get("warc-target-uri", "")) for a, n, h, _ in read_records(data or b""))
        return name, "\n".join("\t".join(map(str, x)) for x in found)

    lines = map_rows(files, [file, content], lambda: row, f"{file} string,lines string")
    parts = lines.where("lines <> ''").select(file, F.explode(F.split("lines", "\n")).alias("line")).select(file, F.split("line", "\t", 4).alias("f"))
    return parts.select(F.col(file).alias("file"), F.get("f", 0).cast("bigint").alias("record_offset"), F.get("f", 1).cast("bigint").alias("record_length"), F.get("f", 2).alias("digest"), F.get("f", 3).alias("uri"))


# Records as columns.

def record(uri: Column, body: Column, record_id: Column) -> Column:
    """The text of the record that ``write_record`` writes; nulls are empty."""
    uri, body = F.coalesce(uri, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), uri, F.lit("\r\nWARC-Record-ID: <"), record_id,
        F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


#: Records of one file that are summed up in one window; a larger file's are dealt by ranges.
WINDOW = 1_000_000


def laid_out(records: DataFrame, file: str, order: list[str], length: str = "record_length") -> DataFrame:
    """records and each one's record_offset: the sum of the lengths before it in its file.

    Files of more than ``WINDOW`` records are dealt by ranges of file and order and summed up
    range by range; the ranges' totals carry the sums on.  So a file may hold any share of
    all rows.  Rows that are equal in order lie one after the other in any order; null
    lengths count as zero, a null file is a file.
    """
    spark = records.sparkSession
    told, _ = materialise(records.withColumn("_tie", F.monotonically_increasing_id()), "told")
    many, many_path = materialise(told.groupBy(F.col(file).alias("_file")).agg(F.count("*").alias("_n")).where(F.col("_n") > WINDOW).select("_file"), "many")
    size = F.coalesce(F.col(length), F.lit(0))

    def before(*by: str) -> Column:
        rows = Window.partitionBy(*by).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(rows), F.lit(0)).cast("bigint")

    if not many.limit(1).count():
        discard(spark, many_path)
        return told.withColumn("record_offset", before(file)).drop("_tie")
    held = F.col(file).eqNullSafe(F.col("_file"))
    few = told.join(many, held, "left_anti").withColumn("record_offset", before(file))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt, _ = materialise(told.join(many, held, "left_semi").repartitionByRange(ranges, file, *order, "_tie").withColumn("_range", F.spark_partition_id()), "dealt")
    totals = dealt.groupBy(F.col(file).alias("_file"), F.col("_range").alias("_of")).agg(F.sum(size).alias("_size"))
    so_far = Window.partitionBy("_file").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("_file", "_of", F.coalesce(F.sum("_size").over(so_far), F.lit(0)).alias("_carried"))
    joined = dealt.withColumn("record_offset", before(file, "_range")).join(carried, held & (F.col("_range") == F.col("_of")))
    ranged = joined.withColumn("record_offset", (F.col("record_offset") + F.col("_carried")).cast("bigint")).drop("_range", "_file", "_of", "_carried")
    return few.unionByName(ranged).drop("_tie")


# Trees.

#: The replicas' columns.
SIDES = ("one", "two")


def _within(rows: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are in held; nulls are keys like others."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"rows.{k}").eqNullSafe(F.col(f"held.{k}"))
    return rows.alias("rows").join(held.alias("held"), same, "left_semi")


def _differs() -> Column:
    return ~F.col("one").eqNullSafe(F.col("two"))


def places(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """(file, record_offset, node, one, two): what each replica (file, record_offset, record_length, digest) has at each place.

    one and two are struct<length,digest>, null where the replica has nothing.  Records
    repeated at one place are told by their number, least length and a digest of them all that
    does not depend on their order, so no place is gathered in memory.
    """

    def one_side(side: int, name: str) -> list[Column]:
        mine = F.col("side") == side
        parts = [F.sum(F.when(mine, F.hash(F.lit(k), "record_length", "digest").cast("bigint"))) for k in range(4)]
        return [F.count_if(mine).alias(f"{name}_n"), F.min(F.when(mine, F.col("record_length"))).alias(f"{name}_length"), F.min(F.when(mine, F.col("digest"))).alias(f"{name}_digest"), F.concat_ws(",", *parts).alias(f"{name}_all")]

    def told(name: str) -> Column:
        many = F.sha2(F.concat_ws(":", F.col(f"{name}_n").cast("string"), f"{name}_all"), 256)
        digest = F.when(F.col(f"{name}_n") > 1, many).otherwise(F.coalesce(f"{name}_digest", F.lit("")))
        return F.when(F.col(f"{name}_n") > 0, F.struct(F.col(f"{name}_length").alias("length"), digest.alias("digest"))).alias(name)

    keep = ["file", "record_offset", "record_length", "digest"]
    both = primary.select(*keep, F.lit(0).alias("side")).unionByName(replica.select(*keep, F.lit(1).alias("side")))
    met = both.groupBy("file", "record_offset").agg(*one_side(0, "one"), *one_side(1, "two"))
    return met.select("file", "record_offset", F.expr(f"record_offset div {LEAF}").alias("node"), told("one"), told("two"))


def _range_hash(items: Column) -> Column:
    """Of a range's parts in the order of their places; null for none."""
    return F.when(F.size(items) > 0, F.sha2(F.array_join(F.transform(F.array_sort(items), lambda x: F.concat_ws(":", x["at"].cast("string"), x["what"])), "\n"), 256))


def leaves(held: DataFrame) -> DataFrame:
    """(file, node, one, two): each replica's hash of the lowest ranges, which hold at most ``LEAF`` places of ``places``."""

    def hashed(side: str) -> Column:
        what = F.concat_ws(":", F.col(side)["length"].cast("string"), F.col(side)["digest"])
        return _range_hash(F.collect_list(F.when(F.col(side).isNotNull(), F.struct(F.col("record_offset").alias("at"), what.alias("what"))))).alias(side)

    return held.groupBy("file", "node").agg(*map(hashed, SIDES))


def above(nodes: DataFrame) -> DataFrame:
    """The ranges that hold ``FAN`` of nodes each."""

    def hashed(side: str) -> Column:
        return _range_hash(F.collect_list(F.when(F.col(side).isNotNull(), F.struct(F.col("node").alias("at"), F.col(side).alias("what"))))).alias(side)

    return nodes.groupBy("file", F.expr(f"node div {FAN}").alias("above")).agg(*map(hashed, SIDES)).withColumnRenamed("above", "node")


def levels_for(last: int | None) -> int:
    """Levels above the lowest after which one range holds all offsets up to last."""
    nodes, levels = (last or 0) // LEAF, 0
    while nodes:
        nodes, levels = nodes // FAN, levels + 1
    return levels


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records in which replica differs: (file, record_offset, status, record_length, digest, replica_length, replica_digest).

    Both have (file, record_offset, record_length, digest), a row for each record; other
    columns are left out.  status: ``changed``, ``missing`` (not in replica) or ``extra``.
    Files missing as a whole are told record by record.  Rows that are repeated at one place
    count as one record with a digest of them all, so a copy too many tells the place as
    changed.  A null file or offset is a place of its own, a null digest counts as empty.
    Empty tables on either side are files without records.
    """
    spark = primary.sparkSession
    paths, levels = [], []
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = primary.select("record_offset").unionByName(replica.select("record_offset")).agg(F.max("record_offset")).first()[0]
    for level in range(levels_for(last) + 1):
        # a level has a sixteenth of the rows below it, and so of the files
        nodes = leaves(places(primary, replica)) if level == 0 else above(levels[-1]).coalesce(max(1, parts // FAN**level))
        nodes, path = materialise(nodes, f"level-{level}")
        levels.append(nodes)
        paths.append(path)
    # the roots first; then, below each range that differs, its parts
    differ = levels[-1].where(_differs()).select("file", "node")
    for nodes in levels[-2::-1]:
        ranges = nodes.where(_differs()).withColumn("part", F.col("node")).withColumn("node", F.expr(f"node div {FAN}"))
        differ = _within(ranges, differ, ["file", "node"]).select("file", F.col("part").alias("node"))
    differ, path = materialise(differ, "differ")
    paths.append(path)
    below = (_within(side.withColumn("node", F.expr(f"record_offset div {LEAF}")), differ, ["file", "node"]) for side in (primary, replica))
    status = F.when(F.col("two").isNull(), "missing").when(F.col("one").isNull(), "extra").otherwise("changed")
    told = places(*below).where(_differs()).select(
        "file", "record_offset", status.alias("status"), F.col("one.length").alias("record_length"), F.col("one.digest").alias("digest"), F.col("two.length").alias("replica_length"), F.col("two.digest").alias("replica_digest")
    )
    found, _ = materialise(told, "audit")
    discard(spark, *paths)
    return found
