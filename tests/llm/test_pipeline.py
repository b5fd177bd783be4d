"""The corpus pipeline as a whole, on a small corpus with planted copies and odd rows."""

import os
import re

import numpy as np
import pytest

pytest.importorskip("riftspan.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from pyspark.sql import functions as F  # noqa: E402

from riftspan.llm import pieces, simhash  # noqa: E402

GIVEN = "/root/testdata/sf0.001"


def corpus(spark, folder):
    """Tables of the smallest scale with rows that no table there has; their ids start at a million."""
    given = spark.read.parquet(f"{GIVEN}/documents.parquet")
    columns = dict(given.dtypes)
    words = [f"plain{i}" for i in range(120)]
    near = [*words[:100], *words[101:]]  # 5 of 120 shingles differ
    rows = [
        (1_000_000, " ".join(words)), (1_000_001, "  ".join(words)), (1_000_002, " ".join(words) + "\n"),
        (1_000_003, " ".join(near)), (1_000_004, " ".join(reversed(words))),
        (1_000_005, None), (1_000_006, ""), (1_000_007, " \t"), (None, "a row without an id, like no other"), (1_000_008, "long " * 20_000),
        (1_000_009, "twice the same row"), (1_000_009, "twice the same row"),
    ]
    planted = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name, kind in columns.items():
        if name not in ("doc_id", "text"):
            planted = planted.withColumn(name, F.lit("en" if name == "lang" else None).cast(kind))
    given.unionByName(planted).write.parquet(f"{folder}/documents.parquet")
    os.symlink(f"{GIVEN}/labels.parquet", f"{folder}/labels.parquet")
    return given, rows


def test_pipeline(spark, tmp_path):
    import sentencepiece

    given, planted = corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == given.columns, name
        kept[name] = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    for before, after in zip(list(kept)[:3], list(kept)[1:]):
        assert set(kept[after]) <= set(kept[before])
    clean = {i for i, _ in planted}
    assert clean <= {i for i, _ in kept["toxicity"]}
    norms = [re.sub(r"[\x20\x09-\x0d]", "", t or "") for _, t in kept["exact_dedup"]]
    assert len(norms) == len(set(norms))
    assert {i for i, _ in kept["exact_dedup"] if i in clean} == {1_000_001, 1_000_003, 1_000_004, 1_000_007, 1_000_008, 1_000_009, None}
    near = {i for i, _ in kept["simhash"]} & clean
    assert near == {1_000_001, 1_000_004, 1_000_007, 1_000_008, 1_000_009, None}
    sets = [simhash.shingle_set(t or "") for _, t in kept["simhash"]]
    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a]) and len(sets[b]):
                common = len(np.intersect1d(sets[a], sets[b]))
                assert common < 0.8 * (len(sets[a]) + len(sets[b]) - common)
    assert set(kept["mixing"]) == set(kept["simhash"])

    model = sentencepiece.SentencePieceProcessor(model_proto=pieces.default_model())
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or -1) for r in result) == sorted((i or -1) for i, _ in kept["mixing"])
    texts = dict(kept["mixing"])
    for r in result:
        ids = [model.bos_id(), *model.encode(texts[r["doc_id"]] or ""), model.eos_id()]
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == model.decode(ids)
