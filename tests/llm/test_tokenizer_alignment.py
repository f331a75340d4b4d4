from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

import pytest

from tidewater.llm import tokenizer_alignment as A
from tidewater.llm.queries import piece_model_path, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    """{(a ids, a ends), (b ids, b ends)} of a whole text, token bytes from the rank file and the piece names."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(tokenizer_path()), sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    a.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {int(n): base64.b64decode(t) for t, n in map(bytes.split, file)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    def of(text):
        a_ids = a.encode(" " + text, add_special_tokens=False).ids
        b_ids = b.encode(text)
        one, two = [ranks.get(i, b"?") for i in a_ids], [piece(i) for i in b_ids]
        if not text or b"".join(one) != (" " + text).encode() or b"".join(two) != (" " + text).encode():
            return [], []
        out = []
        for ids, tokens in ((a_ids, one), (b_ids, two)):
            at, spans = 0, []
            for i, t in zip(ids, tokens):
                spans.append((i, at, at + len(t)))
                at += len(t)
            out.append(spans)
        return out

    return of


def brute(texts, plain):
    aligned, holders = [], Counter()
    for text in texts:
        a, b = plain(text or "")
        links, j = [], 0
        for i, s, e in a:
            while j and b[j - 1][2] > s:
                j -= 1
            while j < len(b) and b[j][1] < e:
                if b[j][2] > s:
                    links.append((i, b[j][0]))
                j += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for end in ends:
            groups.append(",".join(str(i) for i, s, e in a if low <= s and e <= end) + "|" + ",".join(str(i) for i, s, e in b if low <= s and e <= end))
            low = end
        aligned.append((len(a), len(b), links, groups))
        holders.update(set(links))
    best: dict[int, int] = {}
    for (i, _), n in holders.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for n_a, n_b, links, groups in aligned:
        text = ";".join(groups)
        out.append((n_a, n_b, len(groups), len(links), sum(holders[x] == best[x[0]] for x in links), sum(holders[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n x\n", "tab\there", "Hé 中文 😀 a  b\n c", "<|endoftext|> <s> </s> <0x0A> <unk>", "a ▁ b", "▁", "x▁y", "日本語のテキスト。", "👩‍👩‍👧 family", "é" * 50,
    "　ideographic　space", "nb space", "\x00nul", "it's don't WE'LL", "w" * 3000, "end. \r\n next", "\x1c sep", "ß!\n\n", "  lead", "many    spaces   here ", "ﬁ ligature ½ ²", "é combining", "𝔘𝔫𝔦", "क्षि त्र", "a​b", "1234567 8.90%",
]


def check(frame, texts, plain):
    got = A.link_strengths(frame([(k, t, None, None) for k, t in enumerate(texts)]).repartition(3), tokenizer_path(), piece_model_path()).collect()
    assert [tuple(r[f] for f in FIELDS) for r in sorted(got, key=lambda r: r.doc_id)] == brute(texts, plain)


def test_odd_texts_against_whole_encodings(frame, plain):
    check(frame, ODD, plain)


def test_random_mixtures_against_whole_encodings(frame, plain):
    r = random.Random(3)
    bits = [t for t in ODD if t] + ["word", "the", "and", "Straße", "niño", ".", ",", "\n"]
    texts = ["".join(r.choice(bits) + r.choice(["", " ", " ", "  "]) for _ in range(r.randrange(12))) for _ in range(400)]
    check(frame, [*texts, *texts[:20]], plain)


def test_the_test_table_against_whole_encodings(spark, frame, plain):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120).collect()]
    check(frame, texts, plain)


def test_joined_counts_equal_sent_ones(frame, plain, monkeypatch):
    monkeypatch.setattr(A, "BROADCAST_PAIRS", 0)
    check(frame, [*ODD, "the cat and the hat", "the cat"], plain)


def test_words_are_forgotten_and_learned_again(monkeypatch, plain):
    monkeypatch.setattr(A, "CACHE_WORDS", 20)
    monkeypatch.setattr(A, "TOGETHER", 7)
    aligner = A.Aligner(tokenizer_path(), piece_model_path())
    r = random.Random(5)
    for _ in range(30):
        texts = [" ".join(r.choice(["alpha", "béta", "gamma.", "d", "x" * 100, "▁"]) + str(r.randrange(40)) for _ in range(r.randrange(9))) for _ in range(5)]
        for text, found in zip(texts, aligner.align(texts, [False] * len(texts))):
            a, b = plain(text)
            assert (found is None) == (not a) and sum(w[2] for w in found or []) == len(a)
            if found:
                groups = ";".join(w[0] for w in found)
                assert sum(len(g.split("|")[1].split(",")) for g in groups.split(";")) == len(b)


def test_empty_table_repeats_and_null_ids(frame, plain):
    assert A.link_strengths(frame([]), tokenizer_path(), piece_model_path()).collect() == []
    got = A.link_strengths(frame([(None, "a b", None, None), (None, "a b", None, None), (1, None, None, None)]), tokenizer_path(), piece_model_path()).collect()
    assert sorted((r.n_links, r.count_sum) for r in got) == [(0, 0), (2, 4), (2, 4)]


def test_groups_are_the_text_behind_the_digest(frame):
    row = A.alignments(frame([(1, "Hello 中", None, None)]), tokenizer_path(), piece_model_path(), with_groups=True).first()
    assert row.groups_sha256 == hashlib.sha256(row.groups.encode()).hexdigest() and row.groups.count(";") == row.n_groups - 1


def test_counts_survive_a_full_buffer(spark, monkeypatch):
    monkeypatch.setattr(A, "COUNT_BUFFER", 3)
    import numpy as np

    docs = [np.array(x, "<u4").tobytes() for x in ([1, 2, 3], [2, 3, 4], [3], [], [1 << 20, 3])]
    frame = spark.createDataFrame([(d,) for d in docs], "pairs binary").coalesce(1)
    got = {r.pair: (r.n, r.best) for r in A.pair_counts(frame).collect()}
    assert got == {1: (1, False), 2: (2, False), 3: (4, True), 4: (1, False), 1 << 20: (1, True)}
