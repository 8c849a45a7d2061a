import random
import zlib

import numpy as np
import pytest
from helpers import SF, duck

from starflow.llm import huffman, packing
from starflow.llm.common import Scratch
from starflow.llm.tokens import encoder

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
ODD = [None, "", " ", "\n\n x  y ", "it's\ta <|endoftext|> test", "日本 \U0001f600 İß ﬁ", "w" * 50_000, "word " * 3000, "a\0b \0"]


def whole(name, texts, end):
    return [encoder(name).tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_cached_words_give_the_same_ids(name):
    rng = random.Random(1)
    parts = ["foo", "it's", " ", "  ", "\n", "\t", " ", "é", "é", "İ", "ß", "12", "...", "!?", "<|endoftext|>", "日本",
             "\U0001f600", "'ll", "\x85", "᠎", "a", "K", "\0", "\r\n", "Σας", "Foo,", "bar."]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.6 else rng.choice(" \n") for _ in range(rng.randrange(1, 12)))
             for _ in range(4000)]
    for t, ids in zip([*texts, *ODD], whole(name, [*texts, *ODD], 0), strict=True):
        assert np.frombuffer(encoder(name).encode(t), "<u4").tolist() == ids[:-1], repr(t)


def check_pieces(rows, docs, window=1024):
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == docs.keys()
    for i, ids in docs.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    return len(sequences)


def test_packing_all_documents(spark):
    docs = duck("SELECT doc_id, text FROM documents").fetchall()
    ids = dict(zip([i for i, _ in docs], whole(BYTES, [t for _, t in docs], 0), strict=True))
    n = check_pieces(packing.op8_packing(spark, SF).collect(), ids)
    assert 1 - sum(map(len, ids.values())) / (1024 * n) < 0.05


def test_packing_odd_rows_few_open_windows_and_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "MERGED_PARTITIONS", 2)
    rows = [(k, ODD[k] if k < len(ODD) else "word " * (k * 37 % 400)) for k in range(120)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, length int").repartition(5)
    ids = dict(zip(range(120), whole(BYTES, [t for _, t in rows], 0), strict=True))
    check_pieces(packing.pack(df, Scratch(spark, "t"), BYTES, 0, 256, 2).collect(), ids, 256)
    same = spark.createDataFrame([(None, "a b"), (None, "a b"), (2**60 + 1, "c")], "doc_id long, text string")
    got = packing.pack(same, Scratch(spark, "t"), BYTES, 0).collect()
    assert sorted(str(r["doc_id"]) for r in got) == [str(2**60 + 1), "None", "None"]
    assert packing.pack(df.limit(0), Scratch(spark, "t"), BYTES, 0).count() == 0


def check_ids(rows, docs, end=1):
    ids = whole(WORDS, [t for _, t in docs], end)
    n = np.array([len(x) for x in ids])
    want = sorted((str(i), int(s), len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
                  for (i, _), x, s in zip(docs, ids, np.cumsum(n) - n, strict=True))
    assert sorted((str(r["doc_id"]), r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want


def test_token_files_round_trip(spark):
    docs = duck("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    check_ids(huffman.op10_token_ids(spark, SF).collect(), docs)


def test_token_files_odd_rows(spark):
    docs = [(-2**60, "b"), *((k, t) for k, t in enumerate(ODD)), *((100 + k, "common words " * (k % 50)) for k in range(300))]
    df = spark.createDataFrame([(*d, 1) for d in reversed(docs)], "doc_id long, text string, n_ids int").repartition(4)
    scratch = Scratch(spark, "t")
    huffman.write_ids(df, scratch, scratch.path("f"), WORDS, 1)
    check_ids(huffman.read_ids(spark, scratch.path("f")).collect(), docs)
    for k, df in enumerate([df.limit(0), spark.createDataFrame([(None, None), (None, "x"), (1, "x"), (1, "x")], "doc_id long, text string")]):
        huffman.write_ids(df, scratch, scratch.path(f"g{k}"), WORDS, 1)
        got = sorted(huffman.read_ids(spark, scratch.path(f"g{k}")).collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in got] == [[], [None, None, 1, 1]][k]
        assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()


def test_codes_are_optimal_complete_and_decodable(monkeypatch):
    import heapq
    rng = np.random.default_rng(0)
    for trial in range(120):
        v = int(rng.integers(1, 400))
        counts = rng.integers(0, 5, v) ** rng.integers(1, 9)
        counts[0] = max(counts[0], 1)
        lengths = huffman.code_lengths(counts, int(rng.integers(3, 19)))
        used = np.flatnonzero(lengths)
        assert (used == np.flatnonzero(counts)).all()
        assert len(used) == 1 or (2.0 ** -lengths[used]).sum() == 1
        if len(used) > 1:
            heap, cost = [int(c) for c in counts[used]], 0
            heapq.heapify(heap)
            while len(heap) > 1:
                both = heapq.heappop(heap) + heapq.heappop(heap)
                cost += both
                heapq.heappush(heap, both)
            assert (huffman.code_lengths(counts, 60) * counts).sum() == cost
        order, length, code = huffman.canonical(used, lengths[used])
        codes = np.zeros(v, np.uint32)
        codes[order] = code
        n = rng.integers(1, 900, int(rng.integers(1, 7)))
        ids = rng.choice(used, int(n.sum()))
        data, _, at = huffman.pack_bits(codes[ids], lengths[ids], n)
        first = np.concatenate([[0], np.cumsum(n)])
        marks = np.concatenate([at[a:b:huffman.MARK_EVERY] for a, b in zip(first, first[1:], strict=False)]).astype("<u8")
        bits = int(length[-1])
        span = np.left_shift(1, bits - length)
        symbols, sizes = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.int64)
        symbols[:span.sum()], sizes[:span.sum()] = np.repeat(order, span), np.repeat(length, span)
        monkeypatch.setattr(huffman, "LANES", [3, 4096][trial % 2])
        assert (huffman.decode(data.tobytes(), marks, n, symbols, sizes, bits) == ids).all()
