from __future__ import annotations

import hashlib
import random

import pytest

from tidewater.llm import exact_dedup as E

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """Multiset of (doc_id, keep_id, group_size, sha) and the kept (doc_id, sha) of plain groups."""
    groups: dict[str, list] = {}
    for i, text, *_ in rows:
        groups.setdefault((text or "").translate(CAPITALS), []).append(i)
    out, kept = [], []
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
        kept.append((keep, sha))
    return sorted(map(repr, out)), sorted(map(repr, kept))


def check(frame, rows, partitions=3):
    got = E.duplicates(frame(rows).repartition(partitions)).collect()
    out, kept = brute(rows)
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == out
    assert sorted(repr((r.doc_id, r.text_sha256)) for r in got if r.kept) == kept


def rows_of(texts, first=0):
    return [(first + k, t, None, None) for k, t in enumerate(texts)]


def test_groups_against_a_plain_dictionary(frame):
    r = random.Random(1)
    heads = ["", "shared opening " * 40, "Other ", "É"]
    texts = [r.choice(heads) + r.choice(["a", "A", "é", "É", "İ", " ", "x" * 3000, ""]) * r.randrange(3) for _ in range(600)]
    check(frame, rows_of(texts))


@pytest.mark.parametrize("copies", [400, 1200])
def test_one_group_over_many_partitions(frame, spark, copies):
    """A text that a third (or nearly all) of the rows hold is cut at ids and put together again."""
    r = random.Random(2)
    others = [f"text {r.randrange(300)}" for _ in range(800)]
    texts = ["The Same Text"] * copies + others
    r.shuffle(texts)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert len(E.splitters(E.id_text(frame(rows_of(texts))))) == 15
        check(frame, rows_of(texts))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_single_group_and_a_single_row(frame):
    check(frame, rows_of(["x"] * 50))
    check(frame, rows_of(["x"]))


def test_equal_heads_differ_behind_them(frame):
    head = "h" * E.HEAD
    check(frame, rows_of([head + str(k % 7) * 400 for k in range(200)] + [head, head, head[:-1]]))


def test_nulls_empty_texts_and_repeated_rows(frame):
    rows = [(None, None, None, None), (None, "", None, None), (3, "", None, None), (5, "b", None, None), (5, "B", None, None), (5, "b", None, None), (None, "c", None, None), (None, "C", None, None), (-4, "d", None, None), (-9, "d", None, None), (6, "w" * 200_000, None, None), (7, "W" * 200_000, None, None)]
    check(frame, rows)


def test_empty_table_and_kept_texts(frame):
    assert E.duplicates(frame([])).collect() == []
    rows = [(1, "Ab", None, None), (2, "aB", None, None), (2, "ab", None, None), (None, None, None, None), (4, "Z", None, None)]
    got = {(r.doc_id, r.text) for r in E.without_duplicates(frame(rows)).collect()}
    assert got == {(2, "aB"), (None, None), (4, "Z")}


def test_a_sample_of_one_key_only_moves_the_cuts(frame, monkeypatch):
    monkeypatch.setattr(E, "SAMPLED", 1)
    check(frame, rows_of([f"t{k % 40}" for k in range(300)]))
