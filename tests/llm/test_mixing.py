from __future__ import annotations

import numpy as np
import pytest

from tidewater.llm import mixing as M
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_rates(p, tokens, target):
    """Rates that meet the targets, by many small steps on multipliers over arrays (the nearest to 1)."""
    w = np.array([target[d] for d in M.DOMAINS]) / sum(target.values())
    share = tokens / tokens.sum()
    lam = np.zeros(p.shape[1])
    for _ in range(200_000):
        r = np.maximum(0, 1 - p @ lam)
        residual = (p * (share * r)[:, None]).sum(axis=0) - w
        if np.abs(residual).max() < 1e-7:
            break
        lam = lam + 0.5 * residual
    return r, w


def test_rates_against_arrays_and_targets(spark):
    rows = QUERIES["op2_source_mixing"](spark, SF).collect()
    assert len(rows) == 1000
    p = np.array([[r[f"p_{d}"] for d in M.DOMAINS] for r in rows])
    tokens = np.array([r.n_tokens for r in rows], float)
    got = np.array([r.rate for r in rows])
    want, w = plain_rates(p, tokens, M.TARGET)
    assert got.min() >= 0 and np.allclose(p.sum(axis=1), 1)
    assert np.allclose(got, want, atol=1e-3)
    assert np.abs((p * (tokens * got)[:, None]).sum(axis=0) / tokens.sum() - w).max() < 1e-5 and {r.target_gap < 1e-5 for r in rows} == {True}
    assert all(r.copies in (np.floor(r.rate), np.floor(r.rate) + 1) for r in rows)
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = [(r.p_good + r.p_good_toxic >= 0.5) == bool(labels[r.doc_id][0]) for r in rows if r.doc_id in labels]
    assert np.mean(right) > 0.95


def solved(spark, p, tokens, target):
    frame = spark.createDataFrame([(1, int(t), x.tolist()) for t, x in zip(tokens, p, strict=True)], "mix_rows bigint, mix_tokens int, mix_p array<double>")
    multipliers, gap = M.solve(frame, target)
    return np.array([r.r for r in frame.select(M.rate(multipliers, frame["mix_p"]).alias("r")).collect()]), gap


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_hard_targets_clip_at_zero_and_are_met(spark, seed):
    rng = np.random.default_rng(seed)
    p, tokens = rng.dirichlet([0.3] * 4, 200), rng.integers(1, 500, 200)
    target = {"good": 0.91, "good_toxic": 0.03, "poor": 0.03, "poor_toxic": 0.03}
    got, gap = solved(spark, p, tokens, target)
    w = np.array([target[d] for d in M.DOMAINS])
    met = np.abs((p * (tokens * got)[:, None]).sum(axis=0) / tokens.sum() - w).max()
    assert min(got) == 0 < max(got) and met < 1e-5 and abs(met - gap) < 1e-9


def test_targets_out_of_reach_are_reported(spark):
    p = np.array([[0.5, 0.5, 0.0, 0.0], [0.9, 0.1, 0.0, 0.0]])
    with pytest.warns(UserWarning, match="from its target"):
        got, gap = solved(spark, p, np.array([10, 20]), M.TARGET)
    assert gap > 0.1 and got.min() >= 0


def test_the_plan_holds_no_ratios(spark, frame, labels):
    """A fixed, small plan: the ratios are a table, and the posteriors are read, not computed again."""
    docs = frame([(k, f"word{k} and more", None, None) for k in range(30)])
    for out in (M.mixed(docs, labels), M.document_rates(docs, labels)):
        text = out._jdf.queryExecution().toString()
        assert len(text) < 100_000 and text.count("aggregate(") == 0


@pytest.fixture
def labels(spark):
    rows = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, 1, 1), (4, 0, 0), (None, 1, 1), (5, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_defined_cases(spark, frame, labels):
    rows = [(1, "good fine words", "en", "a"), (2, "BAD! bad", "en", "a"), (3, "fine bad", "en", "b"), (4, "MEH! meh", None, None), (7, None, None, None), (7, "", None, None), (None, "x " * 60_000, None, None), (1, "good fine words", "en", "a")]
    docs = frame(rows, mix_p="clash", mix_rate="clash", mix_copies="clash")
    out = M.document_rates(docs, labels).collect()
    assert len(out) == len(rows) and {r.n_tokens for r in out if r.doc_id == 7} == {0}
    assert len({(r.rate, r.copies) for r in out if r.doc_id == 1}) == 1
    mixed = M.mixed(docs, labels)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out)
    assert {r.mix_p for r in mixed.collect()} == {"clash"}
    assert M.document_rates(docs.limit(0), labels).collect() == [] and M.mixed(docs.limit(0), labels).count() == 0
    even = M.document_rates(docs, labels.limit(0)).collect()
    assert len({round(r.rate, 9) for r in even}) == 1


def test_no_python_in_the_plan(spark, frame, labels):
    plan = M.document_rates(frame([(1, "a", None, None)]), labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
