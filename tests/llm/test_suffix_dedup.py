from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidewater.llm import suffix_dedup as S


def plain(rows):
    """Removal by a set of all strings seen, row after row in the order of ids."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - S.LENGTH + 1):
            string = data[i : i + S.LENGTH]
            if string in seen:
                gone[i : i + S.LENGTH] = b"\1" * S.LENGTH
            seen.add(string)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(frame, rows, **kw):
    got = S.remove_repeats(frame([(d, t, None, None) for d, t in rows]).repartition(3), **kw).collect()
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]


def corpus(seed, n=70):
    r = random.Random(seed)
    line = lambda k: "".join(r.choice("abcdé ß\n") for _ in range(k))
    shared = [line(r.choice([60, 99, 100, 101, 150, 400])) for _ in range(12)]
    rows = []
    for d in range(n):
        kind = r.randrange(6)
        if kind == 0:
            text = line(r.randrange(300))
        elif kind == 1:
            text = line(30) + r.choice(shared) + line(40) + r.choice(shared) + r.choice(shared)
        elif kind == 2 and rows:
            text = r.choice(rows)[1] or ""  # exact copy
        elif kind == 3 and rows:
            text = r.choice(rows)[1] or ""
            at = r.randrange(len(text) + 1)
            text = text[:at] + "X" + text[at + 1 :]  # near copy
        elif kind == 4:
            text = "ab" * r.randrange(200) + line(20) + "z" * r.randrange(350)  # periods
        else:
            text = r.choice([None, "", "q" * 99, "q" * 100, line(100)])
        rows.append((d * 3, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_strings(frame, seed):
    rows = corpus(seed)
    assert sorted(result(frame, rows)) == plain(rows)


def test_small_stretches_and_packs(frame, monkeypatch):
    # module values are read in the tasks, so the texts themselves are made long
    r = random.Random(9)
    long = "".join(r.choice("abcdefgh") for _ in range(40_000))
    rows = [(1, long), (2, long[10_000:30_000] + "!" + long), (3, "x" * 50_000)]
    assert sorted(result(frame, rows)) == plain(rows)


def test_stretches_cover_every_string_once():
    import pyarrow as pa

    part = pa.RecordBatch.from_arrays([pa.array(["ab" * 500, "c" * 730, "x"]), pa.array([5, 6, 7], pa.int64())], ["text", "place"])
    old, S.STRETCH = S.STRETCH, 300
    try:
        seen = {}
        for data, bounds, places, offset in S._stretches(part):
            row, first, last, *_ = S.sampled(data, bounds)
            for k, a, b in zip(row, first, last, strict=True):
                for i in range(a, b + 1):
                    seen.setdefault(int(places[k]), []).append(int(i - bounds[k] + offset))
    finally:
        S.STRETCH = old
    assert sorted(seen[5]) == list(range(901)) and sorted(seen[6]) == list(range(631)) and 7 not in seen


def test_equal_strings_are_sampled_at_one_offset():
    rng = np.random.default_rng(4)
    shared = rng.integers(97, 100, 260).astype(np.uint8)
    found = []
    for _ in range(3):
        left = rng.integers(97, 122, rng.integers(0, 90)).astype(np.uint8)
        data = np.concatenate([left, shared, rng.integers(97, 122, 50).astype(np.uint8)])
        _, first, last, g, _, string = S.sampled(data, np.array([0, len(data)]))
        names = {}
        for a, b, name in zip(first, last, g, strict=True):
            for i in range(a, b + 1):
                names[i - len(left)] = (int(name), int(string[i]))
        found.append([names[i] for i in range(260 - S.LENGTH + 1)])
    assert found[0] == found[1] == found[2]


def test_defined_cases(frame):
    r = random.Random(7)
    text = "".join(r.choice("abcdefghij") for _ in range(300))
    rows = [(None, text + "n"), (None, None), (4, text), (4, text), (4, text + "other"), (9, text[50:]), (2, "")]
    got = result(frame, rows)
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r[2])
    assert sorted(by[None]) == [0, 300]  # null ids come last, and an empty text loses nothing
    assert sorted(by[4]) in ([0, 0, 300], [0, 300, 300])  # equal rows are one document; the third row's hash says which is first
    assert by[9] == [250] and by[2] == [0]
    assert result(frame, []) == []
    kept = S.remove_repeats(frame([(1, text, None, None), (2, "ab" + text + "c", None, None)]), with_text=True).collect()
    assert {r.doc_id: bytes(r.kept) for r in kept} == {1: text.encode(), 2: b"abc"}


def test_repeats_across_a_stretch_boundary(frame):
    """One document longer than a stretch: a passage in both stretches, and another across their boundary."""
    rng = np.random.default_rng(3)
    data = rng.integers(97, 105, S.STRETCH + 300_000).astype(np.uint8)
    first, second = rng.integers(105, 113, 300).astype(np.uint8), rng.integers(113, 121, 400).astype(np.uint8)
    far, edge = S.STRETCH + 200_000, S.STRETCH - 150
    for k, (at, passage) in enumerate([(5_000, first), (far, first), (far + 50_000, first), (9_000, second), (edge, second)]):
        data[at - 1], data[at + len(passage)] = 48 + 2 * k, 49 + 2 * k  # other neighbours each time
        data[at : at + len(passage)] = passage
    rows = [(7, data.tobytes().decode(), None, None), (8, "Z" + first.tobytes().decode() + "Z", None, None)]
    got = {r.doc_id: r.spans for r in S.remove_repeats(frame(rows)).collect()}
    assert got == {7: [edge, edge + 400, far, far + 300, far + 50_000, far + 50_300], 8: [1, 301]}
