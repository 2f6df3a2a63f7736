"""Held-out pages: a registry of needles in titles, guards, and proposals of new ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import volume_of

from .checks import refuse_any


def whole_volume(title: Column, work: str, volume: int) -> Column:
    """Whether title is that volume of the work; the volume is compared as a number."""
    return F.coalesce((volume_of(title) == volume) & title.contains(work), F.lit(False))


def held_out(pages: DataFrame, works: list[tuple[str, list[int]]], overlaps: list[tuple[str, list[int]]] = (), volume: tuple[str, int] | None = None, title: str = "title", page: str = "page") -> DataFrame:
    """pages and ``held``.

    Of works, the first needle that the title contains decides by its pages; of overlaps, any
    needle does; a whole volume is held with all its pages.  The registry is a short list and
    becomes an expression, so that nothing is joined.
    """
    t, p = F.col(title), F.col(page)
    first = F.lit(False)
    for needle, ids in reversed(works):
        first = F.when(t.contains(needle), p.isin(*ids) if ids else F.lit(False)).otherwise(first)
    held = first
    for needle, ids in overlaps:
        held = held | (t.contains(needle) & (p.isin(*ids) if ids else F.lit(False)))
    if volume:
        held = held | whole_volume(t, *volume)
    return pages.withColumn("held", F.coalesce(held, F.lit(False)))


def trainable(pages: DataFrame, *args, **kwargs) -> DataFrame:
    return held_out(pages, *args, **kwargs).where(~F.col("held")).drop("held")


def refuse_held(pages: DataFrame, *args, **kwargs) -> DataFrame:
    """pages; evaluating it fails if one of them is held out."""
    return refuse_any(held_out(pages, *args, **kwargs), F.col("held"), "a held-out page is among the pages").drop("held")


def propose(pages: DataFrame, count: int, group: str = "source", order: str = "page", density: Column | None = None, usable: Column | None = None) -> DataFrame:
    """Of each group ``count`` evenly spread pages of at least its upper median density.

    Unusable pages are left out; groups of fewer than twice count are refused (no rows); a
    tenth is cut at either end (if anything stays); then every so many of the dense enough
    pages is taken.
    """
    density = F.length("text") if density is None else density
    rows = (pages if usable is None else pages.where(usable)).withColumn("_d", density)
    in_order = Window.partitionBy(group).orderBy(order)
    whole = Window.partitionBy(group)
    ranked = rows.withColumns({"_i": F.row_number().over(in_order) - 1, "_n": F.count("*").over(whole)}).where(F.col("_n") >= 2 * count)
    cut = F.floor(F.col("_n") / 10)
    body = ranked.where((F.col("_i") >= cut) & (F.col("_i") < F.col("_n") - cut) | (F.col("_n") <= 2 * cut))
    by_density = Window.partitionBy(group).orderBy("_d", order)
    placed = body.withColumns({"_k": F.row_number().over(by_density) - 1, "_m": F.count("*").over(whole)})
    dense = placed.withColumn("_t", F.max(F.when(F.col("_k") == F.floor(F.col("_m") / 2), F.col("_d"))).over(whole)).where("_d >= _t")
    again = dense.withColumns({"_i": F.row_number().over(in_order) - 1, "_n": F.count("*").over(whole)})
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / count))
    return again.where((F.col("_i") % step == 0) & (F.floor(F.col("_i") / step) < count)).select(group, order, F.col("_d").alias("density"))


def even_spread(pages: DataFrame, count: int, group: str = "source", order: str = "page") -> DataFrame:
    """Of each group up to count pages at even steps, after its first tenth."""
    w = Window.partitionBy(group)
    ranked = pages.withColumns({"_i": F.row_number().over(w.orderBy(order)) - 1, "_n": F.count("*").over(w)})
    start = F.floor(F.col("_n") / 10)
    step = F.greatest(F.lit(1), F.floor((F.col("_n") - start) / count))
    at = F.col("_i") - start
    return ranked.where((at >= 0) & (at % step == 0) & (F.floor(at / step) < count)).select(group, order)


def planned_sets(registry: DataFrame, harvested: DataFrame, protected: DataFrame, keys: tuple[str, str] = ("source", "page")) -> DataFrame:
    """Registered pages that were harvested and are not protected."""
    return registry.join(harvested.select(*keys), list(keys), "left_semi").join(protected.select(*keys), list(keys), "left_anti").distinct()


def first_pages(pages: DataFrame, n: int, group: str = "source", order: str = "page", spec: list[int] | None = None) -> DataFrame:
    """Of each group the first n pages in order, of those that spec lists, if it is given."""
    listed = pages if spec is None else pages.where(F.col(order).isin(*spec))
    return listed.withColumn("_i", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("_i") <= n).drop("_i")
