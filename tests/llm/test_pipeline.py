from __future__ import annotations

import zlib

import numpy as np

import corpus_pipeline as P
from tidewater.llm import language, mixing
from tidewater.llm.queries import tokenizer_path

from .test_decontamination import plain as plain_leaks
from .test_near_dedup import plain_classes

SF = "/root/testdata/sf0.001"


def test_each_stage_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, "en", "src1", 0), (9002, "123 456 !!", "en", "src1", 10), (9003, "", None, None, 0), (None, None, None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("score", docs["lang"])
    columns, tables = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs, before = spark.read.parquet(str(tmp_path / name)), docs
        assert docs.columns == columns
        tables[name] = before.collect(), docs.collect()

    before, after = tables["language_id"]
    told = {r.doc_id: r for r in language.identify(spark.createDataFrame(before, docs.schema)).collect()}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone >= {9001, 9002, 9003, None} and all(told[d].lang_pred == "und" or told[d].ambiguous for d in gone)

    before, after = tables["near_duplicates"]
    classes = plain_classes([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({classes[r.doc_id] for r in before})

    before, after = tables["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in plain_leaks([(r.doc_id, r.text) for r in before], items)}
    assert bad and sorted(r.doc_id for r in after) == sorted({r.doc_id for r in before} - bad)

    before, after = tables["source_mixing"]
    rates = mixing.document_rates(spark.createDataFrame(before, docs.schema), spark.read.parquet(f"{SF}/labels.parquet")).collect()
    want = {r.doc_id: r.copies for r in rates if r.copies}
    got = {}
    for r in after:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want

    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path())
    tokens = sorted(P.STAGES[-1][1](spark, docs, SF).collect(), key=lambda r: r.start)
    start = 0
    for row, r in zip(sorted(after, key=lambda r: r.doc_id), tokens, strict=True):
        ids = [*model.encode(row.text, add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (row.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_run_chains_the_stages(spark, monkeypatch):
    """``run`` applies the stages in order, each to what the one before has written."""
    assert [n for n, _ in P.STAGES] == ["language_id", "near_duplicates", "decontamination", "source_mixing", "token_output"]
    seen = []

    def cut(name):
        def stage(spark, docs, sf_dir):
            seen.append((name, len(docs.inputFiles()) > 0, docs.count(), sf_dir))
            return docs.where(docs["doc_id"] % (len(seen) + 1) != 0)

        return stage

    monkeypatch.setattr(P, "STAGES", [(n, cut(n)) for n, _ in P.STAGES])
    rows = P.run(spark, SF)
    counts = [n for _, _, n, _ in seen]
    assert [n for n, *_ in seen] == [n for n, _ in P.STAGES] and all(read and where == SF for _, read, _, where in seen)
    assert counts == sorted(counts, reverse=True) and rows.count() <= counts[-1]
