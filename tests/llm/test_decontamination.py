from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import regex

from tidewater.llm import decontamination as D


UNSEGMENTED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af"


def plain_words(text):
    """Words by a regular expression over Unicode classes (not the operator's tables)."""
    found = regex.findall(rf"[[{UNSEGMENTED}]&&[\p{{L}}\p{{M}}\p{{N}}]]|[[\p{{L}}\p{{M}}\p{{N}}]--[{UNSEGMENTED}]]+", (text or "").lower(), regex.V1)
    return found


def plain(docs, items):
    """Every document and item by all windows against all windows, along the diagonals of equal words."""
    number = {}
    coded = lambda text: np.array([number.setdefault(w, len(number)) for w in plain_words(text)], np.int64)
    cut_items, out = [(i, coded(text)) for i, text in items], set()
    for d, text in docs:
        dw = coded(text)
        for i, iw in cut_items:
            m = min(D.WINDOW, len(iw))
            if m < D.SHORTEST or len(dw) < m:
                continue
            total = np.zeros((len(dw) + 1, len(iw) + 1), np.int16)  # equal words up to here along the diagonal
            for k, w in enumerate(iw):
                total[1:, k + 1] = total[:-1, k] + (dw == w)
            if (total[m:, m:] - total[:-m, :-m] >= D.SIMILARITY * m - 1e-9).any():
                out.add((d, i))
    return out


@pytest.mark.parametrize("m", range(D.SHORTEST, D.WINDOW + 1))
def test_masks_survive_every_tolerated_pattern(m):
    for holes in combinations(range(m), D.tolerated(m)):
        assert any(not set(mask) & set(holes) for mask in D.masks(m))


def corpus(seed=3):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)]
    items = [(i, " ".join(r.choices(vocab, k=r.choice([2, 4, 5, 7, 9, 12, 13, 14, 25, 40])))) for i in range(24)]
    docs = []
    for d in range(60):
        body = r.choices(vocab, k=r.randint(0, 60))
        if d % 2:
            words = r.choice(items)[1].split()
            for _ in range(r.randint(0, 4)):
                words[r.randrange(len(words))] = "ZZ"
            at = r.randint(0, len(body))
            body[at:at] = words
        docs.append((d, ", ".join(body).title()))
    return docs, items


def frames(spark, frame, docs, items):
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    return frame([(d, t, None, None) for d, t in docs]), table


@pytest.mark.parametrize("bound", [D.BROADCAST_SEEDS, 0])
def test_against_brute_force(spark, frame, bound):
    docs, items = corpus()
    got = D.leaks(*frames(spark, frame, docs, items), broadcast_seeds=bound).collect()
    assert {(r.doc_id, r.item_id) for r in got} == plain(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    assert all(r.n_equal >= 0.8 * min(D.WINDOW, r.n_words) for r in got)


def test_clean_keeps_the_rest(spark, frame):
    docs, items = corpus(5)
    left, right = frames(spark, frame, docs, items)
    bad = {d for d, _ in plain(docs, items)}
    kept = D.clean(left, right)
    assert kept.columns == left.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - bad and 0 < len(bad) < len(docs)


@pytest.mark.parametrize("bound", [D.BROADCAST_SEEDS, 0])
def test_defined_cases(spark, frame, bound):
    passage = " ".join(f"p{k}" for k in range(20))
    docs = [(None, passage), (1, None), (2, ""), (3, passage + " x"), (3, passage + " x"), (4, "q " * 30_000 + passage)]
    items = [(7, passage), (7, passage), (8, None), (9, ""), (None, passage.upper())]
    left, right = frames(spark, frame, docs, items)
    got = D.leaks(left, right, broadcast_seeds=bound).collect()
    assert sorted(((r.doc_id or -1), (r.item_id or -1)) for r in got) == sorted((d, i) for d in (-1, 3, 4) for i in (-1, 7))
    assert D.leaks(left.limit(0), right, broadcast_seeds=bound).collect() == []
    assert D.leaks(left, right.limit(0), broadcast_seeds=bound).collect() == []
    assert D.clean(left, right).count() == 2


def test_longer_agreement_is_reported(spark, frame):
    words = [f"p{k}" for k in range(40)]
    changed = words[:]
    changed[9] = changed[30] = "zz"
    left, right = frames(spark, frame, [(1, "a b c " + " ".join(changed))], [(2, " ".join(words))])
    (r,) = D.leaks(left, right).collect()
    assert (r.start, r.n_words, r.n_equal) == (3, 40, 38)
    assert np.isclose(r.n_equal / r.n_words, 0.95)


TYPOGRAPHY = [
    ("the cat’s “big” house — with a red door – stands on a hill near town today", "the cat's \"big\" house - with a red door - stands on a hill near town today", True),
    ("今天天气很好我们去公园散步吧", "他说：今天天气很好，我们去公园散步吧。然后走了", True),
    ("ภาษาไทยไม่มีช่องว่าง", "ข้อความ ภาษาไทยไม่มีช่องว่าง จบ", True),
    ("東京は日本の首都です", "大阪は日本の都市でした", False),
    ("naïve café über straße niño piñata façade", "Naïve\u00a0café\u2003über\u3000straße… niño, piñata¿ façade!", True),
    ("one two three four five six seven", "one·two•three→four×five¶six§seven", True),
    ("क्षि त्र हिन्दी में लिखा हुआ पाठ", "… क्षि त्र हिन्दी में लिखा हुआ पाठ ।", True),
]


@pytest.mark.parametrize("bound", [D.BROADCAST_SEEDS, 0])
def test_typography_and_scripts_without_spaces(spark, frame, bound):
    items = [(i, item) for i, (item, _, _) in enumerate(TYPOGRAPHY)]
    docs = [(i, f"Before it: {text} and after") for i, (_, text, _) in enumerate(TYPOGRAPHY)]
    left, right = frames(spark, frame, docs, items)
    got = {(r.doc_id, r.item_id) for r in D.leaks(left, right, broadcast_seeds=bound).collect()}
    assert got == plain(docs, items) == {(i, i) for i, (_, _, leak) in enumerate(TYPOGRAPHY) if leak}


def test_words_against_unicode_classes():
    r = random.Random(8)
    marks = "aZ9_ -'’“”—…\u00a0\u3000éßñİŉ½²٣中文の𠀀กิ่क्षि\u0301\u200d😀ꙮ·_\n\t"
    texts = ["".join(r.choice(marks) for _ in range(r.randrange(40))) for _ in range(500)] + ["plain ascii only", "", None]
    for at in range(0, len(texts), 50):
        some = texts[at : at + 50]
        hashes, bounds = D.word_hashes(pa.array(some, pa.string()))
        name = {}
        for text, low, high in zip(some, bounds, bounds[1:]):
            cut = plain_words(text)
            assert len(cut) == high - low
            for w, h in zip(cut, hashes[low:high]):
                assert name.setdefault(w, h) == h
        assert len(set(name.values())) == len(name)


def test_the_join_path_moves_few_windows(spark, frame):
    """Windows that no item can meet stay in their task: a small part of a row per word."""
    docs, items = corpus(7)
    r = random.Random(9)
    docs += [(1000 + k, " ".join(f"other{r.randrange(5000)}" for _ in range(300))) for k in range(200)]
    left, right = frames(spark, frame, docs, items)
    own = right.select("item_id", "text").withColumn("item_key", D.F.xxhash64("text"))
    lengths = D._lengths(own)
    assert lengths == tuple(sorted({min(13, len(t.split())) for _, t in items if len(t.split()) >= 5}))
    seeds = D._seed_rows(own, "item_key", lengths, True)
    sent = spark.sparkContext.broadcast(D.seed_filter(seeds))
    keyed = D.id_text(left).withColumn("doc_key", D.F.xxhash64("text"))
    words = sum(len(plain_words(t)) for _, t in docs)
    assert D._seed_rows(keyed, "doc_key", lengths, False, sent).count() < 2 * words < D._seed_rows(keyed, "doc_key", lengths, False).count()
    got = {(x.doc_id, x.item_id) for x in D.leaks(left, right, broadcast_seeds=0).collect()}
    assert got == plain(docs, items)
