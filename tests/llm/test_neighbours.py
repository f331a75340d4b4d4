from __future__ import annotations

import numpy as np
import pytest

from tidewater.llm import neighbours as N

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, score string, cell string"


def plain(rows, k, step=1):
    """Each query's k nearest by cosine over all usable rows."""
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = np.array(v, np.float32).astype(np.float64)
    out = {}
    for q in usable:
        if q % step == 0:
            a = usable[q]
            s = [(-round((a @ b) / np.sqrt((a @ a) * (b @ b)), 13), i) for i, b in usable.items() if i != q and len(b) == len(a)]
            out[q] = sorted(s)[:k]
    return out


def make(spark, rows):
    return spark.createDataFrame([(i, v, 1, "r", "s", "c") for i, v in rows], SCHEMA)


def by_query(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((-round(r.score, 13), r.vec_id))
    return out


@pytest.mark.parametrize("cell", [2048, 40])
def test_recall_and_scores_against_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(N, "CELL", cell)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 32))
    rows = [(i, (centres[i % 12] + 0.7 * rng.standard_normal(32)).tolist()) for i in range(600)]
    want, got = plain(rows, 5, 10), by_query(N.nearest(make(spark, rows), "vec_id % 10 = 0", 5))
    assert want.keys() == got.keys()
    assert np.mean([len(set(want[q]) & set(got[q])) / 5 for q in want]) >= 0.9


def test_copies_ties_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 0.0]) for i in range(40)]
    rows += [(50, [1.0, 2.0, 0.5]), (51, [-1.0, 0.0, 0.0]), (52, None), (53, [0.0, 0.0, 0.0]), (54, [nan, 1.0, 1.0]), (55, [inf, 1.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (56, [1.0, None, 1.0]), (57, []), (50, [1.0, 2.0, 0.5]), (60, [1.0, 2.0]), (61, [2.0, 1.0])]
    got = by_query(N.nearest(make(spark, rows), "true", 5))
    assert got == plain(rows, 5)
    assert [i for _, i in got[3]] == [0, 1, 2, 4, 5]


def test_fewer_candidates_and_empty(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0])]
    assert {q: [i for _, i in v] for q, v in by_query(N.nearest(make(spark, rows), "true", 5)).items()} == {1: [2], 2: [1]}
    assert N.nearest(make(spark, rows[:1]), "true", 5).collect() == []
    assert N.nearest(make(spark, []), "true", 5).collect() == []


def test_quantile():
    assert abs(N.chi_square_quantile(0.95, 8) - 15.507) < 1e-3


def test_equal_scores_of_different_vectors_go_by_id(spark):
    """v, 2v, 4v, ... all at cosine 1: more than k + 1 tied vectors, the smallest ids count."""
    import pandas as pd

    v = np.random.default_rng(8).normal(size=16).astype(np.float32)
    scaled = [(v * np.float32(2.0**j)).tolist() for j in range(30)]
    points = pd.DataFrame({"vector": scaled, "ids": [[100 - j] for j in range(30)]})
    got = N.search_cell(pd.DataFrame({"query": [1], "vector": [scaled[0]], "bound": [np.inf]}), points, 5)
    assert got["vec_id"].tolist() == [71, 72, 73, 74, 75, 76]
    rows = [(int(i), x) for i, x in zip(np.random.default_rng(9).permutation(30), scaled, strict=True)]
    assert by_query(N.nearest(make(spark, rows), "vec_id % 1 = 0", k=5)) == plain(rows, 5)


@pytest.mark.parametrize("n", [300, 1500, 4000])
def test_recall_at_three_sizes(spark, monkeypatch, n):
    monkeypatch.setattr(N, "CELL", 100)
    rng = np.random.default_rng(n)
    centres = rng.standard_normal((n // 50, 24))
    rows = [(i, (centres[i % len(centres)] + 0.5 * rng.standard_normal(24)).tolist()) for i in range(n)]
    want, got = plain(rows, 5, n // 20), by_query(N.nearest(make(spark, rows), f"vec_id % {n // 20} = 0", 5))
    assert want.keys() == got.keys() and np.mean([len(set(want[q]) & set(got[q])) / 5 for q in want]) >= 0.9


def test_vectors_of_extreme_size(spark):
    """Finite vectors whose squares over- or underflow are as near as their directions are."""
    base = [[1.0, 2.0, 0.0, 1.0], [0.0, 1.0, 1.0, 0.0], [1.0, 0.0, 0.0, 0.0], [3.0, -1.0, 2.0, 5.0]]
    rows = [(4 * j + i, [x * scale for x in v]) for i, v in enumerate(base) for j, scale in enumerate([1.0, 2.0**-560, 2.0**600, 2.0**-1000, 2.0**900])]
    rows += [(100, [1e-170, 2e-170, 0.0, 1e-170]), (101, [1e200, 1e200, 0.0, 1e200]), (102, [1e200, 1e-200, 5e-324, 0.0]), (103, [5e-324, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v) for i, v in rows], "vec_id bigint, embedding array<double>")
    got = by_query(N.nearest(frame, "true", 4))

    def exact(a, b):
        from fractions import Fraction
        from math import sqrt

        fa, fb = [Fraction(x) for x in a], [Fraction(x) for x in b]
        dot, aa, bb = sum(x * y for x, y in zip(fa, fb)), sum(x * x for x in fa), sum(y * y for y in fb)
        squared = dot * dot / (aa * bb)
        return sqrt(float(squared)) * (1 if dot >= 0 else -1)

    for q, v in rows:
        want = sorted((-round(exact(v, w), 9), i) for i, w in rows if i != q)[:4]
        assert [(round(s, 9), i) for s, i in got[q]] == want


def spread(n, dim=16, seed=3):
    return np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32)


def most_shuffled(frame):
    """Rows of the largest exchange of a collected frame's last plan."""
    frame.collect()
    most, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name, children = node.getClass().getSimpleName(), node.children()
        todo += [children.apply(i) for i in range(children.size())]
        todo += [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else []
        if node.metrics().contains("shuffleRecordsWritten"):
            most = max(most, node.metrics().apply("shuffleRecordsWritten").value())
    return most


def test_a_query_goes_to_a_bin_once(spark, monkeypatch):
    """However many of its cells it visits: on evenly spread vectors that is nearly every cell."""
    monkeypatch.setattr(N, "CELL", 10)
    monkeypatch.setattr(N, "BINS", 8, raising=False)
    rows = list(enumerate(spread(2000).tolist()))
    assert most_shuffled(N.nearest(make(spark, rows), "true", 5)) <= 2000 * 16 + 2000


def test_routing_holds_few_numbers_at_once():
    """10,000 queries and 4,096 cells, of which nearly all are visited: a table of both, or a row for each pair, is never held."""
    import tracemalloc

    import pyarrow as pa

    space = N.Space(16, "f4")
    vectors = spread(10_000)
    places = N._projected(N._unit(N._scaled(vectors)), space.matrix)
    space.tree = N.Tree(places, 4096)
    cells = space.tree.cells(places)
    assert cells.max() == len(space.tree.low) - 1 == 4095
    space.bins = N.Bins(np.bincount(cells, minlength=4096), 208, 8192)
    column = pa.array([v.tobytes() for v in vectors])
    batch = pa.RecordBatch.from_arrays([column, pa.array(np.arange(10_000)), pa.array(np.full(10_000, 1.0))], ["v", "query", "bound"])
    sent = 0
    tracemalloc.start()
    for out in space.routed([batch], True):
        sent += out.num_rows
        assert out.nbytes < 32 << 20
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 10_000 < sent <= 10_000 * len(space.bins.sizes) and peak < 96 << 20  # the gaps alone would take 328 MB


def test_bins_share_and_split():
    bins = N.Bins(np.array([5, 3, 50, 0, 4, 9]), 8, 20)
    assert bins.first.tolist() == [0, 0, 1, 4, 4, 5] and bins.parts.tolist() == [1, 1, 3, 1, 1, 1]
    assert bins.sizes.tolist() == [8, 17, 17, 17, 4, 9] and bins.starts.tolist() == [0, 2, 3, 5]
    rows, cells, to = bins.dealt(np.array([7, 8, 9]), np.array([0, 2, 5]))
    assert rows.tolist() == [7, 8, 8, 8, 9] and cells.tolist() == [0, 2, 2, 2, 5] and to.tolist() == [0, 1, 2, 3, 5]


@pytest.mark.parametrize("cell", [64, 1024])
def test_cells_larger_than_a_bin(spark, monkeypatch, cell):
    """Bins of 32 vectors: every cell is dealt to several; parallel vectors, which no cut separates, too."""
    monkeypatch.setattr(N, "CELL", cell)
    monkeypatch.setattr(N, "BIN_BYTES", 32 * 24 * 4, raising=False)
    v = spread(800, 24)
    rows = list(enumerate(v.tolist())) + [(800 + j, (v[0] * np.float32(2.0 ** (j - 60))).tolist()) for j in range(100)]
    want, got = plain(rows, 5, 20), by_query(N.nearest(make(spark, rows), "vec_id % 20 = 0", 5))
    assert want.keys() == got.keys() and np.mean([len(set(want[q]) & set(got[q])) / 5 for q in want]) >= 0.9
    assert got[0] == want[0]


def test_small_batches_give_the_same_rows(spark, monkeypatch):
    """Runs of copies, bins and queries go on across batches."""
    monkeypatch.setattr(N, "CELL", 40)
    v = spread(60, 12)
    v = v[np.random.default_rng(4).integers(0, 60, 500)] + np.where(np.arange(500) % 3 == 0, 0.3, 0)[:, None] * spread(500, 12, 5)
    frame = make(spark, [(i // 2 if i > 450 else i, x) for i, x in enumerate(v.astype(np.float32).tolist())] * 2)
    want = sorted(map(tuple, N.nearest(frame, "vec_id % 7 = 0", 5).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(map(tuple, N.nearest(frame, "vec_id % 7 = 0", 5).collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_smallest_ids_of_each_vector():
    import pyarrow as pa

    kinds = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.float32()))])
    rows = [(9, [1, 2]), (3, [1, 2]), (3, [1, 2]), (7, [1, 2]), (1, [-0.0, 1]), (2, [0.0, 1]), (4, [1]), (5, []), (6, [0, 0]), (8, [None, 1])]
    batch = pa.RecordBatch.from_pylist([{"vec_id": i, "vector": v} for i, v in rows], kinds)
    out = [(i, np.frombuffer(v, np.float32).tolist()) for part in N.packed([batch.slice(0, 4), batch.slice(4)], "f4", 2) for i, v in zip(*(x.to_pylist() for x in part.columns), strict=True)]
    assert sorted(out) == [(1, [0, 1]), (2, [0, 1]), (3, [1, 2]), (4, [1]), (7, [1, 2])]
    ordered = sorted((v, i) for i, v in [(i, bytes([v])) for v, ids in ((1, [5, 5, 6, 8, 9, 9]), (2, [4]), (3, [1, 1, 1])) for i in ids])
    for size in (1, 2, 4, 20):
        parts = [pa.RecordBatch.from_pydict({"vec_id": [i for _, i in ordered[a : a + size]], "v": [v for v, _ in ordered[a : a + size]]}) for a in range(0, 10, size)]
        found = [(v, ids) for part in N.gathered(parts, 3) for v, ids in zip(*(x.to_pylist() for x in part.columns), strict=True)]
        assert found == [(b"\x01", [5, 6, 8]), (b"\x02", [4]), (b"\x03", [1])]
