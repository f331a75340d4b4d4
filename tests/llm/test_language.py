from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import language as L
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_counts_against_a_plain_loop():
    texts = ["Abc dé!", None, "", "zz top 12"]
    got = L.ngram_counts(pa.array(texts))
    for row, text in zip(got, texts, strict=True):
        code = [b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").lower().encode()]
        pairs = sum(code[i + 1] != 32 for i in range(len(code) - 1))
        triples = sum(code[i + 1] != 32 for i in range(len(code) - 2))
        assert (row[: L.PAIRS].sum(), row[L.PAIRS :].sum()) == (pairs, triples)


@pytest.mark.parametrize("n", [1, 2, 4, 6, 9, 30])
def test_codewords_are_apart(n):
    words = L.codewords(n)
    apart = [(a != b).sum() for i, a in enumerate(words) for b in words[:i]]
    assert not apart or min(apart) >= max(1, words.shape[1] // 4)


def test_held_out_accuracy(spark):
    rows = QUERIES["op3_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    held = rows.where("held_out").select("lang", "lang_pred", "score").collect()
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert rows.count() == 1000 and all(0 <= r.score <= 1 for r in held)


def test_defined_cases(frame):
    base = [(i, t, l, None) for i, (t, l) in enumerate([("the cat sat on the mat", "en"), ("der hund und die katze", "de")] * 12)]
    odd = [(90, None, "en", None), (91, "", "de", None), (92, "123 !!", None, None), (None, "the the", None, None), (None, "the the", "xx", None)]
    got = L.identify(frame(base + odd)).collect()
    assert len(got) == len(base) + len(odd)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (90, 91, 92)] == ["und"] * 3 and by[90].score == 0
    assert all(r.lang_pred == "en" and not r.held_out for r in got if r.doc_id is None)  # a null id teaches nothing
    assert L.identify(frame([])).collect() == []
    assert {r.lang_pred for r in L.identify(frame([(1, "abc", None, None)])).collect()} == {"und"}


def test_balanced_mixture_is_flagged(frame):
    base = [(i, t, l, None) for i, (t, l) in enumerate([("abab baba abba", "a"), ("cdcd dcdc cddc", "c")] * 12)]
    got = {r.doc_id: r for r in L.identify(frame([*base, (500, "xyzz yzxy", None, None)])).collect()}
    assert got[500].ambiguous and not got[0].ambiguous
