import zlib

import numpy as np
from helpers import SF, near_groups
from test_quality import brute

import corpus_pipeline
from starflow.llm import decontaminate, lines, minhash, quality
from starflow.llm.tokens import encoder


def test_stages_on_their_own_input(spark):
    """Each stage against a plain version, on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "decontaminate", "pack"]
    good = quality.stage(spark, docs, SF)
    assert good.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    assert all(not brute(t)[-1] for t in kept.values())
    cut = lines.stage(spark, good, SF)
    assert cut.columns == docs.columns and {r["doc_id"] for r in cut.select("doc_id").collect()} == set(kept)
    rows = [(r["doc_id"], r["text"]) for r in cut.collect()]
    group = near_groups(rows, 5)
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min(least.get(g, i), i)
    one = minhash.stage(spark, cut, SF)
    assert {r["doc_id"] for r in one.collect()} == set(least.values())
    clean = decontaminate.stage(spark, one, SF)
    bad = {r["doc_id"] for r in decontaminate.overlaps(one, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(texts) == set(least.values()) - bad and bad
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(texts)
    for i, t in texts.items():
        ids = np.frombuffer(encoder("byte_bpe_50k.json").encode(t), "<u4").tolist() + [0]
        mine = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        assert sum(r["length"] for r in mine) == len(ids)
        assert all(r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) for r in mine)


def test_every_stage_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
