"""Label files: ``name,text`` lines that are no CSV: split at the first comma, quotes literal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.checks import refuse_any

HEADER = "filename,words"


def split_label(line: Column) -> list[Column]:
    return [F.regexp_extract(line, r"(?s)^([^,]*),(.*)$", 1).alias("filename"), F.regexp_extract(line, r"(?s)^([^,]*),(.*)$", 2).alias("words")]


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(filename, words) of label files; headers and lines without a comma are left out."""
    lines = spark.read.text(path)
    return lines.where((F.col("value") != HEADER) & F.col("value").contains(",")).select(*split_label(F.col("value")))


def write_labels(labels: DataFrame, path: str) -> None:
    """Lines of (filename, words); a line break in either is an error."""
    broken = F.col("filename").rlike(r"[\r\n,]") | F.col("words").rlike(r"[\r\n]")
    refuse_any(labels, broken, "a label spans lines").select(F.concat_ws(",", "filename", "words").alias("value")).write.text(path)


def loadable(labels: DataFrame, allowed_class: str, longest: int) -> DataFrame:
    """Labels short enough whose lower-case form has only characters of the set, by membership."""
    return labels.where((F.length("words") <= longest) & ~F.lower("words").rlike(f"[^{allowed_class}]"))


def stripped(label: Column, allowed_class: str) -> Column:
    """label without the characters that the set lacks, as it is taken in when an item is read: by its own case, not in lower case."""
    return F.regexp_replace(label, f"[^{allowed_class}]", "")


def label_counts(lines: DataFrame, name: str = "name") -> DataFrame:
    """(name, labels): of each label file (name, value) its lines but the header."""
    return lines.groupBy(name).agg((F.count_if(F.col("value") != HEADER)).alias("labels"))
