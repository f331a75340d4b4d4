from __future__ import annotations

import zlib

import numpy as np
import pytest

from tidewater.llm import token_output as T
from tidewater.llm.queries import tokenizer_path

TEXTS = ["a b", "", None, "  two  spaces\n\n and lines \t tab", "x's 's don't <|endoftext|> é　ü 中文 " * 5, "same", "same", "w" * 5000, "ok " * 3000, "  nb \x1c sep"]


def unmodified(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path())
    return [[*model.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def test_whole_corpus_against_the_plain_tokenizer(spark, frame, tmp_path):
    rows = [(i, t, None, None) for i, t in enumerate(TEXTS)]
    T.write_corpus(frame(rows).repartition(3), str(tmp_path / "c"), tokenizer_path())
    got = sorted(T.read_corpus(spark, str(tmp_path / "c")).collect(), key=lambda r: r.start)
    want, start = unmodified(TEXTS), 0
    assert [r.doc_id for r in got] == list(range(len(TEXTS)))
    for r, ids in zip(got, want, strict=True):
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_null_and_repeated_ids_are_kept(spark, frame):
    got = T.coded_corpus(frame([(None, "n", None, None), (5, "b", None, None), (5, "b", None, None), (1, "a", None, None)]), tokenizer_path()).collect()
    got = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 5, 5]


def test_empty_table(spark, frame):
    assert T.coded_corpus(frame([]), tokenizer_path()).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 1000, 40_000])
def test_code_lengths_are_complete_and_limited(n):
    counts = (1.7 ** np.arange(min(n, 60))).astype(np.int64).tolist() + [1] * max(0, n - 60)
    lengths = T.code_lengths(np.array(counts), 20)
    assert lengths.max() <= 20 and lengths.min() >= 1
    if n > 1:
        assert (2.0 ** -lengths).sum() == 1.0


@pytest.mark.parametrize("n", [1, 127, 128, 129, 5000])
def test_block_round_trip_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.2, n), 50_000)
    used, counts = np.unique(ids, return_counts=True)
    code = T.CanonicalCode(used, T.code_lengths(counts))
    payload, checkpoints = code.encode(ids)
    assert code.decode(payload, checkpoints, n).tolist() == ids.tolist()
    assert len(checkpoints) == -(-n // T.STRIDE)


def test_pieces_against_the_plain_tokenizer():
    """Odd spacing, punctuation and line ends, many times over so that every cache is used."""
    import random

    import pyarrow as pa
    import pyarrow.compute as pc

    r = random.Random(11)
    bits = ["word", "Ünï", "x,", "end.\n", "\nNext", "a.\nB", "it's", "'s", " ", "  ", "\t", "　", " ", "\x1c", "...", "9.5", "é;", "²3", "ß!\n\n", "中文。", "<|endoftext|>", "a\n\nb", "-\n-", "A.", ":", ",\n.", "\r\n", "é.", "ǅ?", "q​."]
    texts = ["".join(r.choice(bits) + r.choice(["", " ", " ", " "]) for _ in range(r.randrange(30))) for _ in range(1500)]
    encoder = T.PieceEncoder(tokenizer_path())
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        regular = pc.invert(pc.match_substring_regex(pa.array(some), T._IRREGULAR)).to_pylist()
        got = [np.frombuffer(x, encoder.type).tolist() for x in encoder.encode(some, regular)]
        assert got == unmodified(some)
        if at == 500:
            encoder.older, encoder.spaced = encoder.spaced, {}


def test_added_tokens_against_the_unmodified_tokenizer(spark, frame):
    """A spelled-out added token has its own id, and the starts of later documents follow."""
    t = "<|endoftext|>"
    texts = ["hello <|endoftext|> x", t, t + t + "b", f" {t}  y", f"end.\n{t}\nNext, a{t}.", "<|endoftext |> <|endoftext|", f"a  {t}" * 50, None, "plain words"]
    got = sorted(T.coded_corpus(frame([(i, x, None, None) for i, x in enumerate(texts)]).repartition(3), tokenizer_path()).collect(), key=lambda r: r.start)
    start = 0
    for r, ids in zip(got, unmodified(texts), strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert unmodified(texts[:1]) == [[31373, 220, 50256, 2124, 0]]


def test_pieces_around_added_tokens():
    import random

    import pyarrow as pa
    import pyarrow.compute as pc

    r = random.Random(12)
    bits = ["word", "Ünï", "x,", "end.\n", "a.\nB", "it's", " ", "  ", "\t", "　", "...", "é;", "<|endoftext|>", "<|endoftext|>", "<|", "|>", "A.", ",\n.", "\r\n"]
    texts = ["".join(r.choice(bits) + r.choice(["", " ", " "]) for _ in range(r.randrange(30))) for _ in range(1500)]
    encoder = T.PieceEncoder(tokenizer_path())
    regular = pc.invert(pc.match_substring_regex(pa.array(texts), T._IRREGULAR)).to_pylist()
    got = [np.frombuffer(x, encoder.type).tolist() for x in encoder.encode(texts, regular)]
    assert got == unmodified(texts)


def test_pre_tokens_are_cut_as_the_library_cuts_them():
    import random

    r = random.Random(13)
    encoder = T.PieceEncoder(tokenizer_path())
    signs = "aZs'trevlmd  \t\n\r\x0b\x1c\x85\xa0\u3000\u2028.,-9\xb2\u0660\xe9\xdf\u0301\u4e2d\U0001f600\U00010400\u200b_"
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(25))) for _ in range(4000)]
    data, bounds = T.joined_bytes(T.pa.array(texts))
    got = encoder._cuts(data, bounds).tolist()
    want = {0, len(data)}
    for text, base in zip(texts, bounds.tolist(), strict=False):
        want |= {base + len(text[:a].encode()) for _, (a, _) in encoder.cutter.pre_tokenize_str(text)}
    assert got == sorted(want | set(bounds.tolist()))


def test_each_distinct_pre_token_is_encoded_once():
    """Not once for each mark behind it, nor for each line end beside it."""

    class Counted:
        def __init__(self, model):
            self.model, self.seen = model, []

        def tokenize(self, name):
            self.seen.append(name)
            return self.model.tokenize(name)

    encoder = T.PieceEncoder(tokenizer_path())
    encoder.model = Counted(encoder.model)
    texts = [f"x word{a} word{b} Xyqz{a}" for a in (",", ".", "!", "\n", "?\n") for b in (";", ":", "\nx", "")]
    got = [np.frombuffer(x, encoder.type).tolist() for x in encoder.encode(texts, [True] * len(texts))]
    assert got == unmodified(texts)
    distinct = {name for text in texts for name, _ in encoder.cutter.pre_tokenize_str(text)}
    assert sorted(encoder.model.seen) == sorted(distinct)


def test_blocks_are_decoded_side_by_side(monkeypatch):
    """Blocks whose last runs are short, beside others, and ids beyond one packing step."""
    monkeypatch.setattr(T, "_CODED_AT_ONCE", 256)
    rng = np.random.default_rng(3)
    blocks = [np.minimum(rng.zipf(1.3, n), 50_000) for n in (1, 255, 256, 257, 1000, 127)]
    used, counts = np.unique(np.concatenate(blocks), return_counts=True)
    code = T.CanonicalCode(used, T.code_lengths(counts))
    coded = [code.encode(b) for b in blocks]
    got = code.decode_blocks([p for p, _ in coded], [c for _, c in coded], [len(b) for b in blocks])
    assert [x.tolist() for x in got] == [b.tolist() for b in blocks]
