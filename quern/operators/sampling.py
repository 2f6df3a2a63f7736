"""Samples that every engine draws alike: order by a keyed hash, quotas by exact counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keyed(key: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key))


def quota_sample(rows: DataFrame, n: int, shares: list[tuple[str, float]], key: Column, seed: str = "0", stratum: str = "stratum", other: str = "other") -> DataFrame:
    """n rows: of each stratum in shares ``bround(n * share)`` at most, the rest from other.

    Within a stratum rows are taken in the order of a hash of key.  A stratum whose share is
    zero belongs to other.  Each stratum's first rows are found without putting a stratum
    into one task: a bound on the hash is chosen from a count by hash prefix, and only rows
    under it are ranked.
    """
    wanted = {name: int(round(n * share)) for name, share in shares if share > 0}
    held = rows.withColumns({"_s": F.when(F.col(stratum).isin(*wanted), F.col(stratum)).otherwise(other) if wanted else F.lit(other), "_h": keyed(key, seed)})
    supply = {r["_s"]: r["n"] for r in held.groupBy("_s").agg(F.count("*").alias("n")).collect()}
    take = {s: min(w, supply.get(s, 0)) for s, w in wanted.items()}
    take[other] = min(n - sum(take.values()), supply.get(other, 0))
    return first_of_each(held, take, "_s", "_h").withColumn("taken_as", F.col("_s")).drop("_s", "_h")


def first_of_each(rows: DataFrame, take: dict[str, int], group: str, order: str) -> DataFrame:
    """Of each group its first take[group] rows by a hex hash, which is uniform: a prefix bounds what is ranked."""
    counted = rows.groupBy(group, F.substring(order, 1, 3).alias("_p")).agg(F.count("*").alias("n")).collect()
    bounds: dict[str, str] = {}
    for g, most in take.items():
        total = 0
        for prefix, n in sorted((r["_p"], r["n"]) for r in counted if r[group] == g):
            if total >= most:
                break
            total, bounds[g] = total + n, prefix
    keep = F.lit(False)
    for g, bound in bounds.items():
        keep = keep | ((F.col(group) == g) & (F.substring(order, 1, 3) <= bound))
    ranked = rows.where(keep).withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(order)))
    most = F.lit(0)
    for g, m in take.items():
        most = F.when(F.col(group) == g, m).otherwise(most)
    return ranked.where(F.col("_rank") <= most).drop("_rank")


def quota_shortfall(rows: DataFrame, n: int, shares: list[tuple[str, float]], stratum: str = "stratum") -> DataFrame:
    """(stratum, wanted, supply, shortfall) of each stratum with a share."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(name, int(round(n * share))) for name, share in shares if share > 0], "stratum string, wanted bigint")
    supply = rows.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("supply"))
    return wanted.join(supply, "stratum", "left").select("stratum", "wanted", F.coalesce("supply", F.lit(0)).alias("supply"), F.greatest(F.lit(0), F.col("wanted") - F.coalesce("supply", F.lit(0))).alias("shortfall"))


def every_nth_split(rows: DataFrame, n: int, group: str, order: list[str]) -> DataFrame:
    """rows and ``split``: of each group every n-th in order is val, the others train."""
    at = F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1
    return rows.withColumn("split", F.when(at % n == 0, "val").otherwise("train"))


def repeated(rows: DataFrame, times: int) -> DataFrame:
    """rows times over (copy 1 to times) where split is train, once elsewhere."""
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("split") == "val", 1).otherwise(times))))


def chance(key: Column, share: float, seed: str = "0") -> Column:
    """Whether a row's hash falls under share."""
    return F.conv(F.substring(keyed(key, seed), 1, 8), 16, 10).cast("double") / float(1 << 32) < share


def batch_mix(sizes: DataFrame, ratios: list[tuple[str, float]], batch: int, steps: int) -> DataFrame:
    """(name, step, slot, item): which row of each dataset stands in each batch; an exhausted dataset begins again.

    sizes: (name, n).  A dataset gives ``max(bround(batch * ratio), 1)`` rows a step.
    """
    spark = sizes.sparkSession
    each = spark.createDataFrame([(name, max(int(round(batch * r)), 1)) for name, r in ratios], "name string, rows int")
    grid = sizes.join(F.broadcast(each), "name").where("n > 0")
    grid = grid.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))).withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    return grid.select("name", "step", "slot", F.pmod(F.col("step") * F.col("rows") + F.col("slot"), F.col("n")).cast("bigint").alias("item"))


def family_face(rows: DataFrame, faces: list[tuple[str, str]], key: Column, seed: str = "0") -> DataFrame:
    """rows with a family drawn evenly, and one of its faces drawn evenly, by hashes of key."""
    families = sorted({f for f, _ in faces})
    by = {f: sorted(x for g, x in faces if g == f) for f in families}

    def pick(salt: str, count: Column) -> Column:
        return (F.conv(F.substring(keyed(key, seed + salt), 1, 6), 16, 10).cast("int") % count).cast("int")

    drawn = rows.withColumn("family", F.get(F.array(*map(F.lit, families)), pick("family", F.lit(len(families)))))
    face = F.lit(None).cast("string")
    for f in families:
        face = F.when(F.col("family") == f, F.get(F.array(*map(F.lit, by[f])), pick("face", F.lit(len(by[f]))))).otherwise(face)
    return drawn.withColumn("face", face)


def prefix_share(rows: DataFrame, share: float, group: str, order: list[str]) -> DataFrame:
    """Of each group its first ``int(n * share)`` rows."""
    w = Window.partitionBy(group)
    ranked = rows.withColumns({"_i": F.row_number().over(w.orderBy(*order)), "_n": F.count("*").over(w)})
    return ranked.where(F.col("_i") <= F.floor(F.col("_n") * share)).drop("_i", "_n")


def family_allocation(lines: DataFrame, families: list[str], each: int, order: list[str]) -> DataFrame:
    """(family, slot, ...): the lines dealt out in order, ``each`` to every family, one family after the other; what is left over goes.

    Only the first ``each * len(families)`` lines are ranked, so no task sorts all of them.
    """
    first = lines.orderBy(*order).limit(each * len(families))
    at = F.row_number().over(Window.orderBy(*order)) - 1
    names = F.array(*map(F.lit, sorted(families)))
    return first.withColumn("_i", at).withColumns({"family": F.get(names, F.floor(F.col("_i") / each).cast("int")), "slot": (F.col("_i") % each).cast("int")}).drop("_i")


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows and ``place``, from 1: their number in the order of (group, order).

    Each group is numbered by itself, and begins where the groups before it end; one task
    sees no more than a row for each group.
    """
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(group).agg(F.count("*").alias("_n")).select(F.col(group).alias("_g"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = rows.withColumn("_i", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return own.join(starts, F.col(group).eqNullSafe(F.col("_g"))).withColumn("place", (F.col("_start") + F.col("_i")).cast("bigint")).drop("_g", "_start", "_i")
