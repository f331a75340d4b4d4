from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidewater.llm import near_dedup as D
from tidewater.llm.graph import components

from .test_decontamination import plain_words


def plain_set(text):
    words = plain_words(text)
    if not words:
        return None
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)])


def plain_classes(rows):
    """Smallest id of each row's class, from all pairs."""
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    ids = {}
    for (d, _), k in zip(rows, label, strict=True):
        ids[k] = min(ids.get(k, d), d)
    return {d: ids[k] for (d, _), k in zip(rows, label, strict=True)}


def corpus(seed):
    r = random.Random(seed)
    rows = []
    for d in range(160):
        if d % 3 == 0 or not rows:
            text = " ".join(r.choice("abcdefghij") + str(r.randrange(60)) for _ in range(r.choice([1, 3, 5, 30, 120])))
        else:  # chains of edits: far ends of a class are no longer similar to each other
            words = r.choice(rows)[1].split()
            for _ in range(r.choice([0, 1, 1, 2])):
                words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
            text = " ".join(words)
        rows.append((d, text))
    return rows


def test_classes_against_all_pairs(frame):
    rows = corpus(1)
    got = {r.doc_id: r.class_id for r in D.near_duplicates(frame([(d, t, None, None) for d, t in rows])).collect()}
    assert got == plain_classes(rows)
    assert len(set(got.values())) < len(rows)


def test_defined_cases_and_kept_rows(frame):
    rows = [(5, "Same, text here now please ok"), (3, "same text HERE now please ok"), (7, None), (8, None), (9, ""), (9, ""), (10, "a b"), (11, "b a"), (12, "A b")]
    rows += [(None, "same text here now please ok"), (20, "twice"), (20, "twice"), (20, "other words"), (21, "long " * 40_000), (22, "long " * 39_000)]
    docs = frame([(d, t, "en", "s") for d, t in rows])
    got = D.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.class_id, r.class_size))
    assert by[5] == by[3] == by[None] == [(3, 3)]
    assert by[7] == [(7, 1)] and by[9] == [(9, 1)] * 2 and by[11] == [(11, 1)] and by[12] == by[10] == [(10, 2)]
    assert sorted(by[20]) == [(20, 1), (20, 2), (20, 2)] and by[21] == by[22] == [(21, 2)]
    kept = D.first_of_class(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()))
    assert ids == [3, 7, 8, 9, 9, 10, 11, 20, 20, 21]
    assert D.near_duplicates(docs.limit(0)).collect() == [] and D.first_of_class(docs.limit(0)).collect() == []


def test_signature_estimates_weighted_similarity():
    rng = np.random.default_rng(5)
    shingle = rng.integers(0, 1 << 54, 90).astype(np.uint64)
    a, b = np.arange(0, 60), np.arange(20, 90)
    wa, wb = rng.integers(1, 4, 90).astype(float), rng.integers(1, 4, 90).astype(float)
    row = np.concatenate([np.zeros(60, int), np.ones(70, int)])
    total = []
    for salt in range(40):
        h = np.concatenate([shingle[a], shingle[b]]) ^ np.uint64(salt << 20)
        s = D.prob_minhash(row, h, np.concatenate([wa[a], wb[b]]), 2)
        total.append((s[0] == s[1]).mean())
    want = sum(1 / sum(max(wa[j] / wa[i] if j in a else 0, wb[j] / wb[i] if j in b else 0) for j in range(90)) for i in range(20, 60))
    assert abs(np.mean(total) - want) < 0.02


def test_signature_depends_on_the_set_alone():
    texts = ["x y z a b c d e", None, "x y z a b c d e", "one"]
    row, shingle, count = D.shingle_sets(pa.array(texts))
    together = D.prob_minhash(row, shingle, 1 + np.log(count), 4)
    assert (together[0] == together[2]).all() and (together[3] == together[3, 0]).all()
    row, shingle, count = D.shingle_sets(pa.array(texts[:1]))
    assert (D.prob_minhash(row, shingle, 1 + np.log(count), 1)[0] == together[0]).all()


def test_bands_of_a_node_do_not_depend_on_the_order_of_its_rows(spark):
    """Rows of one node with other bands: each plan and each run takes the row of smallest key."""
    rows = [(d, key, 5, 9, [key * 10 + k for k in range(3)]) for d, key in enumerate([4, 2, 7, 3, 2])] + [(9, 1, None, 0, [])]
    schema = "doc_id bigint, text_key bigint, node bigint, n bigint, bands array<bigint>"
    for some in (rows, rows[::-1]):
        table = D.node_table(spark.createDataFrame(some, schema).coalesce(1))
        assert [tuple(r) for r in table.collect()] == [(5, 2, 9, [20, 21, 22])]
        assert sorted(r[0] for r in table.select(F.explode("bands")).collect()) == [20, 21, 22]


def test_equal_sets_with_unequal_counts(frame):
    """A paragraph repeated 2, 3 and more times is one set, and stays with its near copies."""
    r = random.Random(23)
    rows = []
    for k in range(12):
        words = [f"p{k}w{r.randrange(10**6)}" for _ in range(60)]
        near = [*words[:30], f"edit{k}", *words[31:]]
        rows += [(len(rows) + j, " ".join(w * n)) for j, (w, n) in enumerate([(words, 2), (words, 3), (words, 9), (near, 2), (near, 5)])]
    got = {r.doc_id: r.class_id for r in D.near_duplicates(frame([(d, t, None, None) for d, t in rows]).repartition(5)).collect()}
    assert got == plain_classes(rows)


def test_much_repeated_lines_against_all_pairs(frame):
    """Short texts and their copies with a line of six words appended 300 times."""
    r = random.Random(31)
    rows = []
    for k in range(24):
        text = " ".join(f"t{k}w{r.randrange(10**6)}" for _ in range(54))
        line = " ".join(f"l{k}w{j}" for j in range(6))
        rows += [(2 * k, text), (2 * k + 1, " ".join([text, *[line] * 300]))]
    want = plain_classes(rows)
    assert len(set(want.values())) == 24
    got = {r.doc_id: r.class_id for r in D.near_duplicates(frame([(d, t, None, None) for d, t in rows])).collect()}
    assert got == want


def test_equal_sets_have_equal_bands(frame):
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(n, " ".join([words] * n), None, None) for n in (2, 3, 50)]
    signed = D.signed(frame(rows)).collect()
    assert len({r.node for r in signed}) == 1 and len({tuple(r.bands) for r in signed}) == 1


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 3), (7, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
