"""Approximate nearest neighbours: stable projections in a kd-tree, chi-square stop.

Unit vectors are projected to ``PROJECTED`` dimensions by a seeded Gaussian
(2-stable) matrix; the squared projected distance of two points is their squared
distance times a chi-square variable. A kd-tree over a bounded sample of
projected points cuts the projected space into cells; every point is put into
its cell. A query walks outward: it first searches the cells nearest to it,
which bounds the distance of its k-th neighbour, then visits exactly those other
cells whose projected box is near enough that the chi-square test (``STOP``)
has not yet stopped; cells grow in number with the table. Within the first cells points are
verified in order of projected distance, in steps, until the same test stops the search; in
the others, those that the bound and the test leave. Found scores are exact
cosines of the original vectors in double precision, whatever the vectors' size.

Cells that follow each other share a bin, which one task holds in memory (``BIN_BYTES``). A
query is sent to a bin once, however many of its cells it visits, and queries stream past the
bin in batches; so neither the pairs of queries and cells nor all queries of a cell are ever
held at once. A cell too large for a bin is dealt to several.

Identical vectors are searched as one: a distinct vector keeps the k + 1
smallest ids (no k nearest need more), and each distinct query vector is searched
once, so large groups of copies cost nothing and ties resolve exactly.

Defined results: vectors that are null, zero or hold a null or non-finite
component take no part, nor do null ids; vectors of other lengths than the
commonest are another space and are only compared with their like; ties go to
the smaller id; fewer candidates than k give fewer rows; repeated rows of one id
count once; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import written

PROJECTED = 8
#: Sampled points for the tree's cuts, the points meant for a cell, and most cells.
TREE_SAMPLE, CELL, CELLS = 65_536, 1024, 32_768
#: Chance that a true neighbour lies within the searched projected radius.
STOP = 0.98
#: Cells searched first by every query.
FIRST_CELLS = 2
STEP = 64
#: Numbers that a batch of queries may hold at once within a cell.
BATCH = 4 << 20
#: Cells share a bin up to 1 / ``BINS`` of the points (one cell at least), as long as its vectors fit in ``BIN_BYTES``.
BINS, BIN_BYTES = 48, 64 << 20
#: Most points of a cell verified at once; a larger cell that is also larger than a bin's share is dealt to several bins.
PART = 8 * CELL
#: Distances to boxes that are summed at once, while a processor's cache holds them.
TILE = 1 << 15
#: Numbers, or bytes of vectors, that a batch of queries may hold at once while it is sent to bins.
ROUTED = 1 << 20
#: Queries and points of a bin that meet in one product, and queries for which a block of points is made ready once.
PRODUCT, BLOCK, STREAM = 512, 2048, 8192


def chi_square_quantile(p: float, k: int) -> float:
    """By bisection on the distribution function of an even number of degrees."""
    low, high = 0.0, 200.0
    for _ in range(80):
        x = (low + high) / 2
        term, total = np.exp(-x / 2), 0.0
        for i in range(k // 2):
            total += term
            term *= x / 2 / (i + 1)
        low, high = (x, high) if 1 - total < p else (low, x)
    return high


RADIUS = chi_square_quantile(STOP, PROJECTED)


def projection(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, PROJECTED))


class Tree:
    """Cuts of the projected space; leaves are cells numbered from 0."""

    def __init__(self, points: np.ndarray, cells: int):
        cuts: list[tuple[int, float, int, int]] = []  # axis, value, low child, high child; a child < 0 is leaf ~child
        low: list[np.ndarray] = []
        high: list[np.ndarray] = []
        self._grow(points, cells, np.full(PROJECTED, -np.inf), np.full(PROJECTED, np.inf), cuts, low, high)
        self.axis, self.value = np.array([c[0] for c in cuts], np.int64), np.array([c[1] for c in cuts], float)
        self.child = np.array([c[2:] for c in cuts], np.int64).reshape(-1, 2)
        self.low, self.high = np.stack(low), np.stack(high)

    def _grow(self, points: np.ndarray, cells: int, low: np.ndarray, high: np.ndarray, cuts: list, lows: list, highs: list) -> int:
        if cells > 1 and len(points) > 1:
            axis = int((points.max(axis=0) - points.min(axis=0)).argmax())
            value = float(np.median(points[:, axis]))
            left = points[:, axis] < value
            if left.any() and not left.all():
                at = len(cuts)
                cuts.append((axis, value, 0, 0))
                upper, lower = high.copy(), low.copy()
                upper[axis] = lower[axis] = value
                a = self._grow(points[left], cells // 2, low, upper, cuts, lows, highs)
                b = self._grow(points[~left], cells - cells // 2, lower, high, cuts, lows, highs)
                cuts[at] = (axis, value, a, b)
                return at
        lows.append(low)
        highs.append(high)
        return ~(len(lows) - 1)

    def cells(self, points: np.ndarray) -> np.ndarray:
        at = np.full(len(points), 0 if len(self.axis) else ~0, np.int64)
        while len(some := np.flatnonzero(at >= 0)):
            cut = at[some]
            right = points[some, self.axis[cut]] >= self.value[cut]
            at[some] = self.child[cut, right.astype(np.int64)]
        return ~at

    def gaps(self, points: np.ndarray, cells: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Squared distance of each point to each cell's box (of the points in it, once ``shrunk``)."""
        low, high = np.ascontiguousarray(self.low[cells].T), np.ascontiguousarray(self.high[cells].T)
        out = np.zeros((len(points), low.shape[1]))
        few = max(1, TILE // max(1, low.shape[1]))
        for start in range(0, len(points), few):
            tile = out[start : start + few]
            gap, other = np.empty_like(tile), np.empty_like(tile)
            for axis in range(PROJECTED):
                p = points[start : start + few, axis, None]
                np.maximum(np.subtract(low[axis], p, out=gap), np.subtract(p, high[axis], out=other), out=gap)
                np.maximum(gap, 0, out=gap)
                tile += np.multiply(gap, gap, out=gap)
        return out

    def shrunk(self, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Cells as small as the points in them; cells without points are infinitely far."""
        self.low, self.high = np.full_like(self.low, np.inf), np.full_like(self.high, np.inf)
        self.low[cells], self.high[cells] = low, high


def nearest_cells(gaps: np.ndarray) -> np.ndarray:
    """The ``FIRST_CELLS`` nearest cells of each row, of equally near ones the first; -1 where no cell with points is left."""
    left, out = gaps.copy(), np.full((len(gaps), min(FIRST_CELLS, gaps.shape[1])), -1, np.int64)
    for i in range(out.shape[1]):
        best = left.argmin(axis=1)
        some = np.flatnonzero(np.isfinite(left[np.arange(len(left)), best]))
        out[some, i] = best[some]
        left[some, best[some]] = np.inf
    return out


class Bins:
    """Consecutive cells share a bin of at most ``share`` points; a cell has a bin of its own beyond
    that, and ``parts`` bins beyond ``most`` points."""

    def __init__(self, counts: np.ndarray, share: int, most: int):
        self.first, self.parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
        sizes, full = [], True
        for cell, count in enumerate(counts.tolist()):
            if count > most:
                self.first[cell], self.parts[cell], full = len(sizes), -(-count // most), True
                sizes += [-(-count // self.parts[cell])] * int(self.parts[cell])
                continue
            if full or sizes[-1] + count > share:
                sizes.append(0)
            self.first[cell], full = len(sizes) - 1, False
            sizes[-1] += count
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.flatnonzero(np.diff(self.first, prepend=-1))  # the first cell of each bin, or of the bins of a large cell

    def dealt(self, rows: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row and cell once for each bin of the cell: rows, cells, bins."""
        parts = self.parts[cells]
        at = np.repeat(np.arange(len(rows)), parts)
        return rows[at], cells[at], self.first[cells][at] + np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """The vectors, each times the power of two that brings its largest component to between
    1/2 and 1: cosines stay the same to the last bit, and no square over- or underflows."""
    rows = rows.astype(np.float64)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


def _matrix(vectors: pd.Series) -> np.ndarray:
    return _scaled(np.stack([np.asarray(v, np.float64) for v in vectors])) if len(vectors) else np.zeros((0, 0))


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]


def _projected(unit: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Summed component by component, so that a point's cell never depends on the rows beside it."""
    out = np.zeros((len(unit), PROJECTED))
    for j in range(len(matrix)):
        out += unit[:, j, None] * matrix[j]
    return out


def _rows(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    """Vectors of one length from their bytes."""
    if not len(column):
        return np.zeros((0, dim), kind)
    at = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], kind, len(column) * dim, int(at)).reshape(-1, dim)


def cut(batches: Iterable[pa.RecordBatch], numbers: Callable[[pa.RecordBatch], int]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``ROUTED`` numbers, of which a row has so many."""
    for batch in batches:
        if batch.num_rows:
            few = max(1, ROUTED // numbers(batch))
            yield from (batch.slice(start, few) for start in range(0, batch.num_rows, few))


def packed(batches: Iterable[pa.RecordBatch], kind: str, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The usable vectors as bytes, with their ids; with ``most``, a vector keeps its smallest ids of each batch."""
    for batch in cut(batches, lambda batch: max(1, len(batch.column(1).flatten()) // batch.num_rows)):
        ids, column = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        bounds = np.asarray(column.offsets).astype(np.int64)
        values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), kind)  # a null becomes NaN
        bounds, lengths = bounds - bounds[0], np.diff(bounds)
        for dim in np.unique(lengths[lengths > 0]).tolist():
            some = np.flatnonzero(lengths == dim)
            rows = values.reshape(-1, dim) if len(some) == len(ids) else values[bounds[some][:, None] + np.arange(dim)]
            ok = np.isfinite(rows).all(axis=1) & (rows != 0).any(axis=1)
            rows, own = rows[ok] + np.zeros(1, kind), ids[some[ok]].astype(np.int64)  # -0.0 and 0.0 are one
            if most and len(rows):
                whole = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.itemsize * dim)))[:, 0]
                _, same = np.unique(whole, return_inverse=True)
                order = np.lexsort((own, same))
                order = order[np.concatenate([[True], (np.diff(same[order]) != 0) | (np.diff(own[order]) != 0)])]
                group = same[order]
                kept = order[np.arange(len(order)) - np.searchsorted(group, group) < most]
                rows, own = rows[kept], own[kept]
            if len(rows):
                vectors = pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.itemsize * dim), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))])
                yield pa.RecordBatch.from_arrays([pa.array(own), vectors.cast(pa.binary())], ["vec_id", "v"])


def gathered(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """From rows in order of vector and id, each distinct vector with its ``most`` smallest ids."""

    def given(ids: np.ndarray, vectors: pa.Array) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], ~same(vectors)]))
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(ids)).astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays([vectors.take(pa.array(starts)), lists], ["v", "ids"])

    def same(vectors: pa.Array) -> np.ndarray:
        return np.asarray(pc.equal(vectors.slice(1), vectors.slice(0, len(vectors) - 1)).to_numpy(zero_copy_only=False), bool)

    held: tuple[np.ndarray, pa.Array] | None = None  # the last vector, which may go on in the next batch
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, vectors = batch.column(0).to_numpy(), batch.column(1)
        if held:
            ids, vectors = np.concatenate([held[0], ids]), pa.concat_arrays([held[1], vectors])
        equal = same(vectors)
        once = np.flatnonzero(np.concatenate([[True], ~(equal & (np.diff(ids) == 0))]))
        run = np.concatenate([[0], np.cumsum(~equal)])[once]
        place = np.arange(len(run)) - np.searchsorted(run, run)
        kept = once[place < most]
        last = int(np.searchsorted(run[place < most], run[-1]))
        ids, vectors = ids[kept], vectors.take(pa.array(kept))
        if last:
            yield given(ids[:last], vectors.slice(0, last))
        held = ids[last:], pa.concat_arrays([vectors.slice(last)])
    if held:
        yield given(*held)


def search_cell(queries: pd.DataFrame, points: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best of one cell for each query: projected neighbours are verified
    nearest first until the chi-square test holds against the k-th best so far.

    A query without a bound first verifies its ``STEP`` nearest projected points, which bounds the
    distance of its k-th neighbour; what then passes the test is verified together with that of
    the other queries, by one matrix product. The product only selects: of what comes within
    rounding of the k-th best, each score is summed over its own row, so that it doesn't
    depend on which rows stand beside it.
    """
    vectors = _matrix(points["vector"])
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    unit = vectors / norms[:, None]
    # the ids of a distinct vector share one score; the test needs whole vectors' ids
    ids = [list(x) for x in points["ids"]]
    sizes = np.array([len(x) for x in ids])
    smallest = np.array([min(x) for x in ids], np.int64)
    flat_projection = projection(vectors.shape[1])
    projected = unit @ flat_projection
    squares = (projected * projected).sum(axis=1)
    asked, names = _matrix(queries["vector"]), queries["query"].to_numpy()
    bounds = queries["bound"].to_numpy(float)
    limits = np.where(np.isfinite(bounds), bounds, np.inf)
    out = []
    width = max(1, BATCH // max(len(vectors), STEP * vectors.shape[1]))
    for start in range(0, len(asked), width):
        q, limit = asked[start : start + width], limits[start : start + width].copy()
        length = np.sqrt((q * q).sum(axis=1))
        own = (q / length[:, None]) @ flat_projection
        near = np.maximum(0, squares + (own * own).sum(axis=1)[:, None] - 2 * own @ projected.T)
        fresh = np.flatnonzero(np.isinf(limit))
        if len(fresh) and len(vectors) > STEP:
            some = np.argpartition(near[fresh], STEP, axis=1)[:, :STEP]
            score = (vectors[some] * q[fresh][:, None, :]).sum(axis=2) / (norms[some] * length[fresh][:, None])
            rank = np.argsort(-score, axis=1)
            held = np.cumsum(sizes[np.take_along_axis(some, rank, 1)], axis=1)
            enough = held[:, -1] >= k + 1
            reach = (held < k + 1).sum(axis=1)[enough]
            kth = np.take_along_axis(score, rank, 1)[enough, reach]
            limit[fresh[enough]] = np.maximum(0.0, 2 - 2 * kth) + 1e-12
        close = (q / length[:, None]) @ unit.T
        close[near > RADIUS * limit[:, None] + 1e-9] = -np.inf
        at_most = min(k + 1, len(vectors))
        least = -np.partition(-close, at_most - 1, axis=1)[:, at_most - 1] - 1e-9
        rows, at = np.nonzero((close >= least[:, None]) & (close > -np.inf))
        score = (vectors[at] * q[rows]).sum(axis=1) / (norms[at] * length[rows])
        order = np.lexsort((smallest[at], -score, rows))  # of equal scores the smallest ids
        rows, at, score = rows[order], at[order], score[order]
        kept = np.arange(len(rows)) - np.searchsorted(rows, rows) <= k
        for row, place, value in zip(rows[kept].tolist(), at[kept].tolist(), score[kept].tolist(), strict=True):
            out.extend((names[start + row], i, value) for i in ids[place])
    return pd.DataFrame(out, columns=["query", "vec_id", "score"])


ROUTE = "bin int, kind int, cell int, v binary, ids array<bigint>, hash bigint, bound double, done array<int>"
_LISTS = {"ids": pa.list_(pa.int64()), "done": pa.list_(pa.int32())}


def _routed(n: int, **columns) -> pa.RecordBatch:
    """Rows of ``ROUTE``; what isn't given is null."""
    kinds = {"bin": pa.int32(), "kind": pa.int32(), "cell": pa.int32(), "v": pa.binary(), "ids": _LISTS["ids"], "hash": pa.int64(), "bound": pa.float64(), "done": _LISTS["done"]}
    arrays = [pa.nulls(n, kind) if columns.get(name) is None else x if isinstance(x := columns[name], pa.Array) else pa.array(x, kind) for name, kind in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


class Space:
    """All that a task needs to know of one vector length: its tree, and the bins of its cells."""

    tree: Tree
    bins: Bins

    def __init__(self, dim: int, kind: str):
        self.dim, self.kind, self.matrix = dim, kind, projection(dim)

    def project(self, column: pa.Array) -> np.ndarray:
        return _projected(_unit(_scaled(_rows(column, self.kind, self.dim))), self.matrix)

    def cut(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut(batches, lambda _: self.dim)

    def boxed(self, batches: Iterable[pa.RecordBatch], cells: bool) -> Iterator[pa.RecordBatch]:
        """Each point's place, and its cell."""
        for batch in self.cut(batches):
            p = self.project(batch.column("v"))
            cell = self.tree.cells(p) if cells else np.zeros(len(p), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *(pa.array(np.ascontiguousarray(x)) for x in p.T)], ["cell", *(f"p{a}" for a in range(PROJECTED))])

    def placed(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Points on their way to their bins; a large cell's are dealt by their hash."""
        for batch in self.cut(batches):
            cells = self.tree.cells(self.project(batch.column("v")))
            bins = self.bins.first[cells] + batch.column("hash").to_numpy() % self.bins.parts[cells]
            yield _routed(batch.num_rows, bin=bins, kind=np.zeros(batch.num_rows, np.int32), cell=cells, v=batch.column("v"), ids=batch.column("ids"), hash=batch.column("hash"))

    def routed(self, batches: Iterable[pa.RecordBatch], rest: bool) -> Iterator[pa.RecordBatch]:
        """Queries on their way to the bins of their nearest cells, or (``rest``) of those others that
        the chi-square test leaves: one row for each bin."""
        groups = self.bins.starts
        few = max(1, min(ROUTED // len(self.bins.first), 16 * ROUTED // (len(self.bins.sizes) * self.dim * np.dtype(self.kind).itemsize)))
        for batch in batches:
            for start in range(0, batch.num_rows, few):
                some = batch.slice(start, few)
                gaps = self.tree.gaps(self.project(some.column("v")))
                done = nearest_cells(gaps)
                if rest:
                    near = self._left(gaps, some.column("bound").to_numpy(), done, np.arange(gaps.shape[1]))
                    rows, group = np.nonzero(np.logical_or.reduceat(near, groups, axis=1))
                    rows, _, bins = self.bins.dealt(rows, groups[group])
                    cells = np.maximum(done[rows, 0], 0)  # queries of one cell follow each other
                else:
                    rows, at = np.nonzero(done >= 0)
                    rows, cells, bins = self.bins.dealt(rows, done[rows, at])
                if len(rows):
                    take = pa.array(rows)
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(done[rows].ravel().astype(np.int32)), done.shape[1]).cast(_LISTS["done"])
                    yield _routed(len(rows), bin=bins, kind=np.ones(len(rows), np.int32), cell=cells, v=some.column("v").take(take), hash=some.column("query").take(take), bound=some.column("bound").take(take), done=lists)

    @staticmethod
    def _left(gaps: np.ndarray, bounds: np.ndarray, done: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether each row must still visit each cell: near enough, with points, and not among the first ones."""
        left = (gaps <= RADIUS * bounds[:, None]) & np.isfinite(gaps)
        for i in range(done.shape[1]):
            at = np.minimum(np.searchsorted(cells, done[:, i]), len(cells) - 1)
            found = np.flatnonzero(cells[at] == done[:, i])
            left[found, at[found]] = False
        return left

    def searched(self, batches: Iterable[pa.RecordBatch], rest: bool, k: int) -> Iterator[pa.RecordBatch]:
        """Rows come by bin, the points of each by cell before its queries by cell."""
        at, held = None, None
        for batch in batches:
            bins, kinds = batch.column("bin").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(bins) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in pairwise([0, *cuts.tolist(), batch.num_rows] if batch.num_rows else []):
                some = batch.slice(a, b - a)
                if bins[a] != at:
                    at, held = bins[a], Held(self, int(self.bins.sizes[bins[a]]))
                if kinds[a] == 0:
                    held.add(some)
                elif held.n:
                    yield from held.others(some, k) if rest else held.first(some, k)


class Held:
    """The points of one bin."""

    def __init__(self, space: Space, size: int):
        self.space, self.n, self.vectors = space, 0, np.empty((size, space.dim), space.kind)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.few = max(1, min(STREAM, 4 * ROUTED // space.dim))

    def add(self, batch: pa.RecordBatch) -> None:
        rows = _rows(batch.column("v"), self.space.kind, self.space.dim)
        if self.n + len(rows) > len(self.vectors):
            self.vectors = np.concatenate([self.vectors[: self.n], np.empty((max(len(rows), self.n // 8), self.space.dim), self.space.kind)])
        self.vectors[self.n : self.n + len(rows)] = rows
        self.n += len(rows)
        ids = batch.column("ids")
        self.parts.append((batch.column("cell").to_numpy().copy(), np.diff(np.asarray(ids.offsets)), ids.flatten().to_numpy().copy()))

    def ready(self) -> None:
        if self.parts:
            cells, counts, self.ids = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            self.at = np.concatenate([[0], np.cumsum(counts)])  # a point's ids, the smallest first
            self.cells, starts, self.place = np.unique(cells, return_index=True, return_inverse=True)
            self.edges, self.parts = np.append(starts, self.n), []

    def given(self, queries: np.ndarray, points: np.ndarray, scores: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A row for each id of the found vectors."""
        if len(points):
            counts = self.at[points + 1] - self.at[points]
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            ids = self.ids[np.repeat(self.at[points], counts) + place]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(queries, counts)), pa.array(ids), pa.array(np.repeat(scores, counts))], ["query", "vec_id", "score"])

    def _cell(self, queries: pd.DataFrame, cell: int, k: int) -> Iterator[pa.RecordBatch]:
        for low in range(self.edges[cell], self.edges[cell + 1], PART):
            high = min(low + PART, self.edges[cell + 1])
            points = pd.DataFrame({"vector": list(self.vectors[low:high]), "ids": [self.ids[a:b].tolist() for a, b in pairwise(self.at[low : high + 1])]})
            for start in range(0, len(queries), self.few):
                found = search_cell(queries.iloc[start : start + self.few], points, k).astype({"query": np.int64, "vec_id": np.int64, "score": float})
                if len(found):
                    yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    def _frame(self, batch: pa.RecordBatch) -> pd.DataFrame:
        q = _rows(batch.column("v"), self.space.kind, self.space.dim)
        return pd.DataFrame({"vector": list(q), "query": batch.column("hash").to_numpy(), "bound": batch.column("bound").to_numpy()})

    def first(self, batch: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
        """Queries within the cell that each row names."""
        self.ready()
        queries, cells = self._frame(batch), batch.column("cell").to_numpy()
        for cell in np.unique(cells):
            at = int(np.searchsorted(self.cells, cell))
            if at < len(self.cells) and self.cells[at] == cell:
                yield from self._cell(queries[cells == cell], at, k)

    def others(self, batch: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
        """Queries within all other cells of the bin that the chi-square test leaves."""
        self.ready()
        few = max(1, min(self.few, ROUTED // len(self.cells)))
        for start in range(0, batch.num_rows, few):
            some = batch.slice(start, few)
            p, bounds = self.space.project(some.column("v")), some.column("bound").to_numpy()
            done = some.column("done").flatten().to_numpy().reshape(len(p), -1)
            left = self.space._left(self.space.tree.gaps(p, self.cells), bounds, done, self.cells)
            open_ended = np.isinf(bounds)
            if open_ended.any():  # fewer than k + 1 ids in its first cells
                queries = self._frame(some)
                for cell in np.flatnonzero(left[open_ended].any(axis=0)).tolist():
                    yield from self._cell(queries[open_ended & left[:, cell]], cell, k)
            yield from self._bounded(some, p, bounds, left & ~open_ended[:, None], k)

    def _bounded(self, batch: pa.RecordBatch, p: np.ndarray, bounds: np.ndarray, left: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
        """Points that come within rounding of a query's k-th best, by products in single precision;
        those that the chi-square test leaves are summed over their own row, as in ``search_cell``."""
        q = _scaled(_rows(batch.column("v"), self.space.kind, self.space.dim))
        length = np.sqrt((q * q).sum(axis=1))
        short = (q / length[:, None]).astype(np.float32)
        slack = 4 * (self.space.dim + 4) * 2.0**-24 + 1e-9  # above the rounding error of a product of two unit vectors
        least = 1 - bounds / 2 - slack
        product, above = np.empty(PRODUCT * BLOCK, np.float32), np.empty(PRODUCT * BLOCK, bool)
        rows, points, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

        def best() -> None:
            nonlocal rows, points, scores
            order = np.lexsort((self.ids[self.at[points]], -scores, rows))  # of equal scores the smallest ids
            rows, points, scores = rows[order], points[order], scores[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            least[rows[place == k]] = np.maximum(least[rows[place == k]], scores[place == k] - slack)
            rows, points, scores = rows[place <= k], points[place <= k], scores[place <= k]

        for low in range(0, self.n, BLOCK):
            high = min(low + BLOCK, self.n)
            asking = np.flatnonzero(left[:, self.place[low] : self.place[high - 1] + 1].any(axis=1))
            if not len(asking):
                continue
            unit = _unit(_scaled(self.vectors[low:high])).astype(np.float32).T
            for start in range(0, len(asking), PRODUCT):
                some = asking[start : start + PRODUCT]
                n = len(some) * (high - low)
                dots = np.matmul(short[some], unit, out=product[:n].reshape(len(some), -1))
                np.greater_equal(dots, least[some].astype(np.float32)[:, None], out=above[:n].reshape(len(some), -1))
                above[n : -(-n // 8) * 8] = False
                eights = np.flatnonzero(above[: -(-n // 8) * 8].view(np.uint64))  # few are above: eight at once
                hits = (eights[:, None] * 8 + np.arange(8))[above.reshape(-1, 8)[eights]]
                for at in range(0, len(hits), max(1, ROUTED // self.space.dim)):
                    r, c = np.divmod(hits[at : at + max(1, ROUTED // self.space.dim)], high - low)
                    r, c = some[r], c + low
                    visited = left[r, self.place[c]]
                    r, c = r[visited], c[visited]
                    v = _scaled(self.vectors[c])
                    norm = np.sqrt((v * v).sum(axis=1))
                    near = ((_projected(v / norm[:, None], self.space.matrix) - p[r]) ** 2).sum(axis=1)
                    score = (v * q[r]).sum(axis=1) / (norm * length[r])
                    kept = (near <= RADIUS * bounds[r] + 1e-9) & (score >= least[r])
                    rows, points, scores = np.concatenate([rows, r[kept]]), np.concatenate([points, c[kept]]), np.concatenate([scores, score[kept]])
                    if len(rows) > 4 * (k + 1) * len(q):
                        best()
            best()
        yield from self.given(batch.column("hash").to_numpy()[rows], points, scores)


def nearest(embeddings: DataFrame, query_filter: str, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest others of every row that
    meets ``query_filter``, by largest cosine."""
    spark = embeddings.sparkSession
    of = embeddings.schema["embedding"].dataType
    sql, kind = ("float", "f4") if isinstance(of, ArrayType) and isinstance(of.elementType, FloatType) else ("double", "f8")
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(f"array<{sql}>").alias("vector"))
    rows = rows.where("vec_id IS NOT NULL AND vector IS NOT NULL")
    # a hot vector is cut to its smallest ids in the tasks, before the shuffle
    few = rows.mapInArrow(lambda batches: packed(batches, kind, k + 1), "vec_id bigint, v binary")
    few = few.repartition("v").sortWithinPartitions("v", "vec_id")
    distinct = written(few.mapInArrow(lambda batches: gathered(batches, k + 1), "v binary, ids array<bigint>"), "vectors")
    asked = rows.where(query_filter).mapInArrow(lambda batches: packed(batches, kind), "vec_id bigint, v binary")
    asked = written(asked.withColumnRenamed("vec_id", "query_id"), "asked")
    parts = []
    for size, n in sorted((r["size"], r["n"]) for r in distinct.groupBy(F.length("v").alias("size")).agg(F.count("*").alias("n")).collect()):
        dim = size // np.dtype(kind).itemsize
        parts.append(_search(distinct.where(F.length("v") == size), asked.where(F.length("v") == size), dim, kind, n, k))
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _search(points: DataFrame, asked: DataFrame, dim: int, kind: str, n: int, k: int) -> DataFrame:
    share = min(1.0, TREE_SAMPLE / n)
    space, axes = Space(dim, kind), range(PROJECTED)
    places = "cell bigint, " + ", ".join(f"p{a} double" for a in axes)
    sample = points.where(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("v")
    sample = sample.mapInArrow(lambda batches: space.boxed(batches, False), places).toArrow()
    space.tree = Tree(np.stack([sample[f"p{a}"].to_numpy() for a in axes], axis=1), min(CELLS, max(1, n // CELL)))
    placed = points.select("v").mapInArrow(lambda batches: space.boxed(batches, True), places)
    ends = [of(f"p{a}").alias(f"{name}{a}") for name, of in (("low", F.min), ("high", F.max)) for a in axes]
    boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), *ends).toArrow()  # a row per cell
    cells, counts = boxes["cell"].to_numpy(), np.zeros(len(space.tree.low), np.int64)
    counts[cells] = boxes["n"].to_numpy()
    space.tree.shrunk(cells, *(np.stack([boxes[f"{name}{a}"].to_numpy() for a in axes], axis=1) for name in ("low", "high")))
    most = max(1, BIN_BYTES // (dim * np.dtype(kind).itemsize))
    space.bins = Bins(counts, min(most, max(CELL, n // BINS)), min(most, max(PART, n // BINS)))
    placed = points.withColumn("hash", F.xxhash64("v")).mapInArrow(space.placed, ROUTE)
    queries = written(asked.select("v").distinct().withColumn("query", F.xxhash64("v")), "queries")

    def search(bounded: DataFrame, rest: bool) -> DataFrame:
        routed = bounded.select("v", "query", "bound").mapInArrow(lambda batches: space.routed(batches, rest), ROUTE)
        together = placed.unionByName(routed).repartition("bin").sortWithinPartitions("bin", "kind", "cell", "hash")
        return together.mapInArrow(lambda batches: space.searched(batches, rest, k), "query bigint, vec_id bigint, score double")

    endless = F.lit(float("inf"))
    near = written(search(queries.withColumn("bound", endless), False), "first-neighbours")
    top = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    kth = near.withColumn("at", F.row_number().over(top)).where(F.col("at") == k + 1).select("query", (2 - 2 * F.col("score") + 1e-12).alias("kth"))
    bounded = queries.join(kth, "query", "left").withColumn("bound", F.coalesce("kth", endless))
    found = near.unionByName(search(bounded, True))
    found = found.withColumn("at", F.row_number().over(top)).where(F.col("at") <= k + 1).select("query", "vec_id", "score")
    expanded = asked.withColumn("query", F.xxhash64("v")).select("query_id", "query").distinct()
    expanded = expanded.join(found, "query").where("vec_id != query_id")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return expanded.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
