import hashlib
import random

import numpy as np
import pytest
from helpers import SF, duck
from pyspark.sql import functions as F

from starflow.llm import repeats
from starflow.llm.common import Scratch


def brute(rows):
    first = {}
    for i, t in rows:
        for k in range(len(t) - 49) if i is not None else ():
            first[t[k:k + 50]] = min(first.get(t[k:k + 50], i), i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - 49) if i is not None else ():
            if first[t[k:k + 50]] < i:
                gone[k:k + 50] = b"\x01" * 50
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((str(i), len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    out = repeats.remove_repeats(df, Scratch(df.sparkSession, "t")).withColumn("sha", F.sha2("kept", 256))
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in out.collect())


def test_query_on_all_documents(spark):
    rows = [(i, (t or "").encode()) for i, t in duck("SELECT doc_id, text FROM documents").fetchall()]
    got = repeats.op7_repeats(spark, SF)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("hot", [10**6, 3])
def test_overlaps_edges_and_frequent_triggers(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_TRIGGER", hot)
    rng = random.Random(4)
    base = ["".join(rng.choice("ab ") for _ in range(rng.choice([49, 50, 51, 120, 400]))) for _ in range(12)]
    rows = []
    for i in range(150):
        text = "".join(rng.choice(base)[rng.randrange(40):][:rng.randrange(30, 200)] for _ in range(rng.randrange(6)))
        rows.append((rng.choice([i, i, i, None, 5]), text if rng.random() < 0.95 else None))
    rows += [(1000 + k, "é" * 60) for k in range(3)] + [(2000, ""), (2001, "x" * 900), (2002, "x" * 50), (2003, "x" * 49)]
    rows += [(3000, "start " + base[3] * 3), (3000, "start " + base[3] * 3)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int").repartition(4)
    assert found(df) == brute([(i, (t or "").encode()) for i, t in rows])
    if hot == 3:
        monkeypatch.setattr(repeats, "MAX_SENT_IDS", 0)
        assert found(df) == brute([(i, (t or "").encode()) for i, t in rows])


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), Scratch(spark, "t")).count() == 0


@pytest.mark.parametrize("stretch", [64, 1 << 17])
def test_phrases_hold_every_window_once_with_its_trigger(monkeypatch, stretch):
    monkeypatch.setattr(repeats, "STRETCH", stretch)
    monkeypatch.setattr(repeats, "_TABLES", [])
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abcd \xc3") for _ in range(rng.choice([0, 10, 49, 50, 51, 300, 700]))) for _ in range(40)]
    seen, trigger_of = set(), {}
    for raw, trigger, text, (first, last), base in repeats.phrases(texts):
        for g, k, f, t, b in zip(trigger, text, first, last, base, strict=True):
            for s in range(f, t + 1):
                window = texts[k][s + b:s + b + 50]
                assert raw[s:s + 50].tobytes() == window and (k, s + b) not in seen
                seen.add((k, s + b))
                assert trigger_of.setdefault(window, g) == g
    assert seen == {(k, s) for k, t in enumerate(texts) for s in range(len(t) - 49)}


def test_sliding_least():
    x = np.random.default_rng(0).integers(0, 1000, 333).astype(np.uint64)
    for w in (1, 2, 31, 333):
        assert (repeats.sliding_least(x, w) == [x[k:k + w].min() for k in range(len(x) - w + 1)]).all()
