from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidewater.llm import quality as Q
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op7_quality_classifier"](spark, SF).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and np.mean([r.quality == r.predicted for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_features_against_a_plain_count():
    texts = ["one two two", None, "", " \n ", "X! y2"]
    rows, bucket, n = Q.features(pa.array(texts))
    assert n.tolist() == [3, 0, 0, 0, 2]
    # words, shapes, word pairs, shape pairs, shape triples
    assert np.bincount(rows, minlength=5).tolist() == [3 + 3 + 2 + 2 + 1, 0, 0, 0, 2 + 2 + 1 + 1]
    assert bucket.min() >= 1 and bucket.max() < Q.DIMENSIONS
    alone = Q.features(pa.array(["X! y2"]))[1]
    assert sorted(alone) == sorted(bucket[rows == 4])


def test_updates_match_the_plain_rule():
    rng = np.random.default_rng(1)
    z, n = np.zeros(4), np.zeros(4)
    plain_z, plain_n = [0.0] * 4, [0.0] * 4
    for _ in range(30):
        index = rng.choice(4, 2, replace=False)
        value, label = rng.random(2), float(rng.integers(2))
        Q.ftrl([(index, value, label)], z, n)
        w = {}
        for i in index:
            sign = 1 if plain_z[i] > 0 else -1
            w[i] = 0.0 if abs(plain_z[i]) <= Q.L1 else -(plain_z[i] - sign * Q.L1) / ((Q.BETA + plain_n[i] ** 0.5) / Q.ALPHA + Q.L2)
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(index, value, strict=True))))
        for i, v in zip(index, value, strict=True):
            g = (p - label) * v
            sigma = ((plain_n[i] + g * g) ** 0.5 - plain_n[i] ** 0.5) / Q.ALPHA
            plain_z[i] += g - sigma * w[i]
            plain_n[i] += g * g
    assert np.allclose(z, plain_z) and np.allclose(n, plain_n)


def test_defined_cases(spark, frame):
    labels = spark.createDataFrame([(1, 1, 0, "c"), (1, 1, 0, "c"), (2, 0, 0, "c"), (None, 0, 0, "c"), (3, None, 0, "c")], "doc_id bigint, quality int, toxic int, text string")
    docs = frame([(1, "good words", "en", "s"), (2, "BAD!!", "en", "s"), (None, "x", None, None), (9, None, None, None), (9, "", None, None)])
    got = Q.classify(docs, labels).collect()
    assert len(got) == 5 and len({r.score for r in got if r.doc_id == 9}) == 1
    assert Q.classify(frame([]), labels).collect() == []
    assert {r.score for r in Q.classify(docs, labels.limit(0)).collect()} == {0.5}
