"""Token ids in files: canonical length-limited Huffman codes, read back block by block.

The file format, a folder with three tables: ``codebook`` (id, length in bits;
codes follow in order of length, then id), ``blocks`` and ``index`` (ids ahead
of each part). Parts hold ascending ranges of document ids. A block holds whole
documents, each from a byte boundary on, and can be decoded alone; ``marks``
give the bit offset of every 256th id of each document, so a decoder works on
many places of a block at once, with one table lookup per id.

Defined results. A null or empty text has the end id only. Repeated rows are
documents of their own; documents with equal ids (null ids first) are ordered
by their coded bytes. An empty table gives empty tables. Other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, table
from starflow.llm.tokens import encoder

MAX_BITS = 18
MARK_EVERY = 256
#: A block is closed at so many ids; a longer document has a block of its own.
BLOCK_IDS = 1 << 18
#: So many marked places are decoded at once.
LANES = 4096
#: Words that the encoding tasks keep: more than elsewhere, as little else is in their memory.
CACHE_WORDS = 1_200_000

_BLOCKS = ("part long, first long, doc_ids array<long>, n_ids array<long>, begins array<long>, marks binary, "
           "payload binary")


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits by package-merge; ids without a count have 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    most = max(most, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels, items = [], leaves
    for _ in range(most - 1):
        packages = items[:len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < len(leaves))
        items = both[rank]
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    lengths[order[:take]] += 1
    return lengths


def canonical(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids in code order, their lengths, and their codes."""
    rank = np.lexsort((ids, lengths))
    ids, lengths = ids[rank], lengths[rank]
    top = int(lengths[-1]) if len(lengths) else 0
    steps = np.left_shift(1, top - lengths)
    return ids, lengths, np.right_shift(np.concatenate([[0], np.cumsum(steps)[:-1]]), top - lengths) if top else lengths


def _encode_ids(tokenizer: str, end_id: int):
    """Each document's ids, and in a last row of its own how often the partition has each id."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])
    end = end_id.to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, CACHE_WORDS)
        size = max(enc.tokenizer.get_vocab_size(), end_id + 1)
        kind = "<u2" if size <= 1 << 16 else "<u4"
        total = np.zeros(size, np.int64)
        for whole in batches:
            for b in _small(whole, 1000):
                ids = [np.frombuffer(enc.encode(t.as_py()) + end, "<u4") for t in b.column(1)]
                total += np.bincount(np.concatenate(ids), minlength=size)
                ids = [x.astype(kind).tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()),
                                                  pa.nulls(len(ids), pa.binary())], schema=schema)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                              pa.array([total.astype("<i8").tobytes()], pa.binary())], schema=schema)

    return encode


def _flat(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of binary values, and how many each value has, as views of the batch."""
    column = column.cast(pa.large_binary())
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(dtype), np.diff(at) // np.dtype(dtype).itemsize


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partitions' counts as rows."""
    for b in batches:
        for v in b.column(0):
            counts = np.frombuffer(v.as_py(), "<i8")
            ids = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts[ids])], names=["id", "n"])


def pack_bits(codes: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of several documents one after the other, each document from a byte boundary on.

    Returns the bytes, the documents' first bytes (and the end), and each code's bit offset.
    """
    ends = np.concatenate([[0], np.cumsum(lengths)])
    firsts = np.concatenate([[0], np.cumsum(counts)])
    bits = ends[firsts[1:]] - ends[firsts[:-1]]
    begin = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
    at = ends[:-1] + np.repeat(begin[:-1] * 8 - ends[firsts[:-1]], counts)
    words = np.zeros(int(begin[-1]) // 4 + 3, np.uint64)
    if len(codes):
        place = codes.astype(np.uint64) << (64 - lengths - (at & 31)).astype(np.uint64)
        word = at >> 5
        new = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        words[word[new]] |= np.bitwise_or.reduceat(place >> np.uint64(32), new)
        words[word[new] + 1] |= np.bitwise_or.reduceat(place & np.uint64(0xFFFFFFFF), new)
    return words.astype(">u4").view(np.uint8)[:begin[-1]], begin, at


def _encode_docs(codes, lengths, bounds: np.ndarray, dtype: str):
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("marks", pa.binary()),
                        ("payload", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, length = codes.value, lengths.value
        for whole in batches:
            for b in _small(whole):
                ids, counts = _flat(b.column(1), dtype)
                data, begin, at = pack_bits(code[ids], length[ids], counts)
                firsts = np.concatenate([[0], np.cumsum(counts)])
                marks = [(at[f:t:MARK_EVERY] - 8 * g).astype("<u4").tobytes()
                         for f, t, g in zip(firsts, firsts[1:], begin, strict=False)]
                payload = [data[f:t].tobytes() for f, t in zip(begin, begin[1:], strict=False)]
                doc_ids = b.column(0)
                part = np.searchsorted(bounds, doc_ids.fill_null(0).to_numpy(zero_copy_only=False), side="left")
                part[doc_ids.is_null().to_numpy(zero_copy_only=False)] = 0
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), doc_ids, pa.array(counts),
                                                  pa.array(marks, pa.binary()), pa.array(payload, pa.binary())],
                                                 schema=schema)

    return encode


def _small(batch: pa.RecordBatch, rows: int = 100) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _make_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents of one part in blocks of whole documents; ``first`` counts the ids ahead in the part."""
    schema = pa.schema([("part", pa.int64()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("n_ids", pa.list_(pa.int64())), ("begins", pa.list_(pa.int64())), ("marks", pa.binary()),
                        ("payload", pa.binary())])
    docs: list[tuple] = []
    part = first = held = 0

    def block() -> pa.RecordBatch:
        begins = np.concatenate([[0], np.cumsum([len(d[3]) for d in docs])])
        marks = np.concatenate([np.frombuffer(d[2], "<u4").astype("<u8") + 8 * int(g)
                                for d, g in zip(docs, begins, strict=False)]).astype("<u8")
        row = {"part": part, "first": first, "doc_ids": [d[0] for d in docs], "n_ids": [d[1] for d in docs],
               "begins": begins[:-1].tolist(), "marks": marks.tobytes(), "payload": b"".join(d[3] for d in docs)}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for b in batches:
        for p, *doc in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if docs and (p != part or held + doc[1] > BLOCK_IDS):
                yield block()
                first, held, docs = first + held, 0, []
            if p != part:
                part, first = p, 0
            docs.append(tuple(doc))
            held += doc[1]
    if docs:
        yield block()


def write_ids(docs: DataFrame, scratch: Scratch, path: str, tokenizer: str, end_id: int) -> None:
    """Ids of ``docs`` (doc_id, text) with an end id each, in ascending doc_id order, in this module's format."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ids = scratch.store(docs.mapInArrow(_encode_ids(tokenizer, end_id), "doc_id long, ids binary, counts binary"), "ids")
    vocabulary = encoder(tokenizer).tokenizer.get_vocab_size()
    dtype = "<u2" if vocabulary <= 1 << 16 and end_id < 1 << 16 else "<u4"
    # At most one row per id of the vocabulary.
    found = (ids.select("counts").filter("counts IS NOT NULL").mapInArrow(_count, "id long, n long")
             .groupBy("id").agg(F.sum("n").alias("n")).toPandas())
    ids = ids.filter("counts IS NULL").drop("counts")
    counts = np.zeros(max(vocabulary, end_id + 1), np.int64)
    counts[found["id"]] = found["n"]
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    order, length, code = canonical(used, lengths[used])
    codes = np.zeros(len(counts), np.uint32)
    codes[order] = code
    spark.createDataFrame([(int(i), int(n)) for i, n in zip(order, length, strict=True)], "id long, bits int") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/codebook")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    cuts = ids.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], 100 * parts)).first()[0]
    sent = [spark.sparkContext.broadcast(x) for x in (codes, lengths.astype(np.int64))]
    coded = ids.mapInArrow(_encode_docs(*sent, np.array(cuts or [], np.int64), dtype),
                           "part int, doc_id long, n long, marks binary, payload binary")
    blocks = (coded.repartitionById(parts, "part").sortWithinPartitions("part", "doc_id", "payload")
              .mapInArrow(_make_blocks, _BLOCKS))
    blocks.write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks")
    scratch.drop("ids")
    total = F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, n: a + n)
    sizes = (spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum(total).alias("n")).collect())
    ahead, rows = 0, []  # one row per part
    for r in sorted(sizes, key=lambda r: r["part"]):
        rows.append((r["part"], ahead))
        ahead += r["n"]
    spark.createDataFrame(rows, "part long, ahead long").coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def decode(payload: bytes, marks: np.ndarray, counts: np.ndarray, symbols: np.ndarray, sizes: np.ndarray,
           bits: int) -> np.ndarray:
    """Ids of one block. Up to ``LANES`` marked places advance together, one table lookup per id."""
    per_doc = -(-counts // MARK_EVERY)
    lane = np.full(int(per_doc.sum()), MARK_EVERY, np.int64)
    lane[np.cumsum(per_doc) - 1] = counts - (per_doc - 1) * MARK_EVERY
    starts = marks.astype(np.int64)
    found = []
    for f in range(0, len(lane), LANES):
        first, until = starts[f] >> 3, starts[f + LANES] // 8 + 8 if f + LANES < len(lane) else len(payload)
        found.append(_advance(payload[first:until], starts[f:f + LANES] - 8 * first, lane[f:f + LANES], symbols, sizes,
                              bits))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def _advance(payload: bytes, starts: np.ndarray, lane: np.ndarray, symbols: np.ndarray, sizes: np.ndarray,
             bits: int) -> np.ndarray:
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    # Four bytes hold any code of up to 25 bits, wherever it begins in the first.
    windows = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
    rank = np.argsort(-lane, kind="stable")
    at, left = starts[rank], lane[rank]
    out = np.empty((MARK_EVERY, len(lane)), np.uint32)
    active = np.searchsorted(-left, -np.arange(MARK_EVERY), side="left")
    mask = np.uint32((1 << bits) - 1)
    for k in range(MARK_EVERY):
        n = active[k]
        if not n:
            break
        now = at[:n]
        key = (windows[now >> 3] >> (32 - bits - (now & 7)).astype(np.uint32)) & mask
        out[k, :n] = symbols[key]
        now += sizes[key]
    ids = np.empty((len(lane), MARK_EVERY), np.uint32)
    ids[rank] = out.T
    return ids[np.arange(MARK_EVERY) < lane[:, None]]


def _decode_blocks(book, with_ids: bool):
    schema = pa.schema([("part", pa.int64()), ("first", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, length = book.value
        bits = int(length[-1])
        symbols = np.zeros(1 << bits, np.uint32)
        sizes = np.zeros(1 << bits, np.int64)
        span = np.left_shift(1, bits - length)
        symbols[:span.sum()], sizes[:span.sum()] = np.repeat(order, span), np.repeat(length, span)
        for b in batches:
            for r in range(b.num_rows):
                row = {n: b.column(i)[r].as_py() for i, n in enumerate(b.schema.names)}
                counts = np.array(row["n_ids"], np.int64)
                ids = decode(row["payload"], np.frombuffer(row["marks"], "<u8"), counts, symbols, sizes, bits)
                ends = np.cumsum(counts)
                own = [ids[e - n:e] for e, n in zip(ends, counts, strict=True)]
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int64()), pa.array(row["first"] + ends - counts),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(counts), pa.array([zlib.crc32(x) for x in own]),
                     *[pa.array([x.tobytes() for x in own], pa.binary()) for _ in range(with_ids)]], schema=schema)

    return read


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a folder written by ``write_ids``: doc_id, start, n_tokens, ids_crc32, ids (32-bit values)."""
    fields = "doc_id long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    book = spark.read.schema("id long, bits int").parquet(f"{path}/codebook").toPandas()  # the vocabulary at most
    if book.empty:
        return spark.createDataFrame([], f"start long, {fields}")
    order, length, _ = canonical(book["id"].to_numpy(), book["bits"].to_numpy().astype(np.int64))
    sent = spark.sparkContext.broadcast((order.astype(np.uint32), length))
    docs = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").mapInArrow(
        _decode_blocks(sent, with_ids), f"part long, first long, {fields}")
    index = F.broadcast(spark.read.schema("part long, ahead long").parquet(f"{path}/index"))  # a row per part
    return docs.join(index, "part").select("doc_id", (F.col("ahead") + F.col("first")).alias("start"), "n_tokens",
                                           "ids_crc32", *["ids"] * with_ids)


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written and read back; end id 1."""
    scratch = Scratch(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), scratch, scratch.path("files"), "word_bpe_49k.json", 1)
    return read_ids(spark, scratch.path("files"), with_ids=False)
