"""Work on whole pages of flat rows, over Arrow batches, with sorts and running sums of NumPy.

Rows of a page must lie together.  Those that come from one row of a table do so by themselves
(``together``), and cost no shuffle; others are dealt out and sorted by page first.  A task holds
about ``CHUNK`` rows, or one page if that is longer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows that are worked on at once.
CHUNK = 60_000


def codes(column: pa.Array) -> np.ndarray:
    """Numbers that are equal where the values are; they say nothing of order."""
    if pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy()
    return pc.fill_null(pc.dictionary_encode(column, null_encoding="encode").indices, -1).to_numpy()


def _starts(held: pa.RecordBatch, page: list[str]) -> np.ndarray:
    """The place of the first row of each page."""
    new = np.zeros(held.num_rows, dtype=bool)
    new[0] = True
    for name in page:
        x = codes(held.column(name))
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def mapped(rows: DataFrame, page: list[str], run: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch], schema: StructType | str, together: bool = False, order: list[str] = ()) -> DataFrame:
    """run over whole pages: it gets rows and the number of each row's page, counted from 0, and returns rows of schema.

    order: how rows are sorted within a page if they do not lie together yet.
    """
    held = rows if together else rows.repartition(*page).sortWithinPartitions(*page, *order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        kept, n, least = [], 0, CHUNK

        def told(part: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
            return run(part, np.repeat(np.arange(len(starts)), np.diff(np.append(starts, part.num_rows))))

        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
                n += batch.num_rows
            if n >= least:
                held = pa.concat_batches(kept)
                starts = _starts(held, page)
                last = int(starts[-1])
                if last:
                    yield told(held.slice(0, last), starts[:-1])
                rest = held.slice(last)
                kept, n, least = [rest], rest.num_rows, max(CHUNK, 2 * rest.num_rows)
        if n:
            held = pa.concat_batches(kept)
            yield told(held, _starts(held, page))

    return held.mapInArrow(work, schema)


def batch(columns: list, schema: StructType) -> pa.RecordBatch:
    """Columns as a batch of a Spark schema."""
    out = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(f.type) for c, f in zip(columns, out, strict=True)], schema=out)


def numbers(held: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [held.column(n).cast(pa.float64()).to_numpy(zero_copy_only=False) for n in names]


def medians(seg: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """The median of each group's values, the mean of two middle ones; NaN of none.  seg is sorted, values have no NaN."""
    n = np.bincount(seg, minlength=count)
    at = np.cumsum(n) - n
    ordered = values[np.lexsort((values, seg))] if len(values) else np.zeros(1)
    top = len(ordered) - 1
    low, high = ordered[np.minimum(at + np.maximum(n - 1, 0) // 2, top)], ordered[np.minimum(at + n // 2, top)]
    return np.where(n > 0, 0.5 * low + 0.5 * high, np.nan)


class Trimmed:
    """Boxes' extents less a share of their group's median height at each end, and each group's size and bounds; seg is sorted."""

    def __init__(self, seg, l, t, r, b, trim):  # noqa: E741
        self.count = int(seg[-1]) + 1 if len(seg) else 0
        self.n = np.bincount(seg, minlength=self.count)
        first = np.cumsum(self.n) - self.n
        height = b - t
        px = (np.nan_to_num(medians(seg[height > 0], height[height > 0], self.count)) * trim)[seg]
        inverted, middle = l + px >= r - px, (l + r) / 2
        self.seg, self.x0, self.x1 = seg, np.where(inverted, middle, l + px), np.where(inverted, middle, r - px)
        self.lo, self.hi = (np.minimum.reduceat(l, first), np.maximum.reduceat(r, first)) if self.count else (l, r)


class Gaps:
    """Of each group the gaps between neighbouring edges, within the inner part and crossed by few enough boxes.

    A sweep: begins and ends are summed up in the order of x, so that a group costs its sorted edges and
    no pair of boxes.  group, x, next, crossings, mid, gap are arrays of the gaps; ``real`` adds what
    lies at both sides.
    """

    def __init__(self, boxes: Trimmed, low_share: float, high_share: float, straddle_share: float, straddles: int):
        k, m = boxes.count, len(boxes.seg)
        low, high = boxes.lo + low_share * (boxes.hi - boxes.lo), boxes.lo + high_share * (boxes.hi - boxes.lo)
        seg = np.concatenate((boxes.seg, boxes.seg, np.arange(k), np.arange(k)))
        x = np.concatenate((boxes.x0, boxes.x1, low, high))
        order = np.lexsort((x, seg))
        seg, x = seg[order], x[order]
        wide = (boxes.x0 < boxes.x1).astype(np.int64)
        none = np.zeros(2 * k, dtype=np.int64)
        new = np.ones(len(x), dtype=bool)
        new[1:] = (seg[1:] != seg[:-1]) | (x[1:] != x[:-1])
        at = np.flatnonzero(new)
        added = (np.add.reduceat(v[order], at) if len(at) else v for v in (np.concatenate((wide, -wide, none)), np.concatenate((np.zeros(m, dtype=np.int64), np.ones(m, dtype=np.int64), none)), np.concatenate((np.ones(m, dtype=np.int64), np.zeros(m, dtype=np.int64), none))))
        d, self._ends, self._begins = added
        self.boxes, self._order, self._at, self.group, self.x = boxes, order, at, seg[at], x[at]
        crossings = np.cumsum(d)  # each group's add up to nothing
        fits = np.zeros(len(at), dtype=bool)
        g, n = self.group[:-1], boxes.n[self.group[:-1]]
        fits[:-1] = (g == self.group[1:]) & (n >= 4) & (boxes.hi[g] > boxes.lo[g]) & (self.x[:-1] >= low[g]) & (self.x[1:] <= high[g]) & (crossings[:-1] <= np.maximum(float(straddles), straddle_share * n))
        self._fits = np.flatnonzero(fits)
        self.crossings = crossings

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(group, mid, crossings, gap)"""
        i = self._fits
        return self.group[i], (self.x[i] + self.x[i + 1]) / 2, self.crossings[i], self.x[i + 1] - self.x[i]

    def chosen(self, column_share: float, width_share: float, width_ratio: float) -> np.ndarray:
        """Of each group the first gap, by crossings, width and place, with real columns at both sides; NaN if there is none."""
        boxes, i, m = self.boxes, self._fits, len(self.boxes.seg)
        found = np.full(boxes.count, np.nan)
        if not len(i):
            return found
        g, first = self.group[i], np.cumsum(boxes.n) - boxes.n  # as many begin as end in each group
        nl, nr = np.cumsum(self._ends)[i] - first[g], first[g] + boxes.n[g] - np.cumsum(self._begins)[i]
        enough = (nl >= column_share * boxes.n[g]) & (nr >= column_share * boxes.n[g])
        i, g = i[enough], g[enough]
        if not len(i):
            return found
        # the least left of what has ended, and the greatest right of what has yet to begin: running
        # extremes of ranks, which start anew with each group
        least, most = self._running(boxes.x0, slice(m, 2 * m), ends=True)[i], self._running(boxes.x1, slice(0, m), ends=False)[i]
        places = np.arange(len(self.x))
        ended = np.maximum.accumulate(np.where(self._ends > 0, places, 0))[i]
        begun = np.minimum.accumulate(np.where(self._begins > 0, places, len(self.x) - 1)[::-1])[::-1][i + 1]
        left, right = self.x[ended] - least, most - self.x[begun]
        narrow, wide, width = np.minimum(left, right), np.maximum(left, right), boxes.hi[g] - boxes.lo[g]
        real = (narrow >= width_share * width) | (narrow >= width_ratio * wide)
        i, g = i[real], g[real]
        mid, gap = (self.x[i] + self.x[i + 1]) / 2, self.x[i + 1] - self.x[i]
        order = np.lexsort((mid, -gap, self.crossings[i], g))
        i, g, mid = i[order], g[order], mid[order]
        best = np.ones(len(g), dtype=bool)
        best[1:] = g[1:] != g[:-1]
        found[g[best]] = mid[best]
        return found

    def _running(self, values: np.ndarray, where: slice, ends: bool) -> np.ndarray:
        """At each edge the least of values that have ended there or before, or the greatest of those that begin after it."""
        sign = 1 if ends else -1
        distinct, rank = np.unique(sign * values, return_inverse=True)
        size = len(distinct) + 1
        points = np.full(len(self._order), size - 1, dtype=np.int64)
        points[where] = rank
        ranks = np.minimum.reduceat(points[self._order], self._at)
        offset = self.group * size if ends else (self.boxes.count - 1 - self.group) * size
        if ends:
            told = np.minimum.accumulate(ranks - offset) + offset
        else:
            told = np.minimum.accumulate((ranks - offset)[::-1])[::-1] + offset
            told = np.append(told[1:], size - 1)
            told[:-1][self.group[1:] != self.group[:-1]] = size - 1
        return sign * np.append(distinct, np.nan)[told]


def regions(page: np.ndarray, l, t, r, b, trim: float, cut: Callable[[Trimmed], np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:  # noqa: E741
    """(places, code) of the boxes that no gutter crosses: a code is the region's splits as digits of base 3, 1 for left and 2 for right."""
    at, code = np.arange(len(page)), np.zeros(len(page), dtype=np.int64)
    for _ in range(depth):
        order = np.lexsort((code, page[at]))
        at, code = at[order], code[order]
        if not len(at):
            break
        new = np.ones(len(at), dtype=bool)
        new[1:] = (page[at][1:] != page[at][:-1]) | (code[1:] != code[:-1])
        seg = np.cumsum(new) - 1
        boxes = Trimmed(seg, l[at], t[at], r[at], b[at], trim)
        gutter = cut(boxes)[seg]
        whole, left, right = np.isnan(gutter), boxes.x1 <= gutter, boxes.x0 >= gutter
        code = np.where(whole, code, code * 3 + np.where(left, 1, 2))
        stays = whole | left | right
        at, code = at[stays], code[stays]
    order = np.argsort(at, kind="stable")
    return at[order], code[order]


def region_names(code: np.ndarray) -> pa.Array:
    def name(c: int) -> str:
        return "" if not c else name(c // 3) + "012"[c % 3 - 1]

    distinct, at = np.unique(code, return_inverse=True)
    return pa.array([name(int(c)) for c in distinct], pa.string()).take(pa.array(at))


def line_numbers(new: np.ndarray, bottom: np.ndarray, half: np.ndarray) -> np.ndarray:
    """The number of each box's line in its group, from 1: a line takes the boxes whose bottom is within half of its first box's.  Boxes are sorted by group and bottom."""
    out, anchor, line = [], 0.0, 0
    for first, x, h in zip(new.tolist(), bottom.tolist(), half.tolist(), strict=True):
        if first:
            anchor, line = x, 1
        elif x - anchor > h:
            anchor, line = x, line + 1
        out.append(line)
    return np.asarray(out, dtype=np.int32)


def uncovered(group: np.ndarray, l, t, r, b, share: float) -> np.ndarray:  # noqa: E741
    """Whether no earlier kept box of its group covers more than share of a box or is so covered; group is sorted.

    A round keeps the first box of each group that is left, and drops what it covers.
    """
    kept, at = np.zeros(len(group), dtype=bool), np.arange(len(group))
    with np.errstate(divide="ignore", invalid="ignore"):
        while len(at):
            g = group[at]
            new = np.ones(len(at), dtype=bool)
            new[1:] = g[1:] != g[:-1]
            kept[at[new]] = True
            of = at[new][np.cumsum(new) - 1]
            rest, of = at[~new], of[~new]
            width, height = np.minimum(r[of], r[rest]) - np.maximum(l[of], l[rest]), np.minimum(b[of], b[rest]) - np.maximum(t[of], t[rest])
            area = np.minimum((r[of] - l[of]) * (b[of] - t[of]), (r[rest] - l[rest]) * (b[rest] - t[rest]))
            at = rest[~((width > 0) & (height > 0) & (area > 0) & (width * height / area > share))]
    return kept
