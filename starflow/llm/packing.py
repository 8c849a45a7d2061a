"""Packing token ids into windows: bounded-space best-fit per partition, then a merge of what is left.

A document's ids fill whole windows first; the rest goes, uncut, to the open
window with the least room that still fits. Each partition keeps a fixed number
of windows open and closes the fullest when none fits and no more may be
opened. What is still open at the end of a partition is merged with the leftovers
of neighbouring partitions, largest pieces first.

Defined results. A null or empty text has the end id only. Repeated rows are
packed as rows of their own; a null id is kept. An empty table gives no pieces.
Other columns are not read. A text of any length is encoded whole, one text at
a time.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, small, table
from starflow.llm.tokens import encoder

WINDOW = 1024
OPEN_WINDOWS = 64
#: So many partitions' leftovers are merged in one group.
MERGED_PARTITIONS = 64

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PLACED = f"{_PIECE}, sequence_id long, `offset` long"


class Windows:
    """Open windows of one partition, sorted by room; ``place`` returns a piece's window and offset there."""

    def __init__(self, window: int, limit: int | None):
        self.window, self.limit, self.count = window, limit, 0
        self.open: list[tuple[int, int]] = []  # (room, number)

    def new(self) -> int:
        self.count += 1
        return self.count - 1

    def place(self, length: int) -> tuple[int, int]:
        at = bisect_left(self.open, (length, -1))
        if at < len(self.open):
            room, number = self.open.pop(at)
        else:
            if self.limit is not None and len(self.open) >= self.limit:
                self.open.pop(0)  # the fullest
            room, number = self.window, self.new()
        if room > length:
            insort(self.open, (room - length, number))
        return number, self.window - room


def _pack_partition(tokenizer: str, end_id: int, window: int, limit: int):
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                  "sequence_id", "offset", "part")] + [("open", pa.bool_())])
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, enc, windows = TaskContext.get().partitionId(), encoder(tokenizer), Windows(window, limit)
        held: dict[int, list[tuple]] = {}  # pieces of open windows

        def rows(found: list[tuple], is_open: bool) -> pa.RecordBatch:
            cols = list(zip(*found, strict=True)) if found else [()] * 7
            arrays = [pa.array(c, pa.int64()) for c in cols]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(found), pa.int64()),
                                               pa.array([is_open] * len(found), pa.bool_())], schema=schema)

        for b in small(batches, 1000):
            done: list[tuple] = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = enc.encode(text.as_py()) + end
                n = len(ids) // 4
                for at in range(0, n, window):
                    piece = ids[4 * at:4 * (at + window)]
                    size = len(piece) // 4
                    if size == window:
                        number, offset = windows.new(), 0
                    else:
                        number, offset = windows.place(size)
                    row = (doc_id, at, size, zlib.crc32(piece), n, (part << 32) | number, offset)
                    if size == window:
                        done.append(row)
                    else:
                        held.setdefault(number, []).append(row)
            still = {number for _, number in windows.open}
            for number in [k for k in held if k not in still]:
                done += held.pop(number)
            if done:
                yield rows(done, False)
        if held:
            yield rows([r for found in held.values() for r in found], True)

    return pack


def _merge(window: int):
    def merge(found: pa.Table) -> pa.Table:
        """Best-fit, largest first, over the leftovers of a group of partitions."""
        order = [(n, "descending") for n in ("length", "doc_tokens", "doc_id", "start", "ids_crc32")]
        found = found.sort_by(order)
        windows = Windows(window, None)
        placed = [windows.place(n) for n in found["length"].to_pylist()]
        first = (1 << 62) | (found["group"][0].as_py() << 32)
        return (found.drop_columns("group")
                .append_column("sequence_id", pa.array([first | number for number, _ in placed], pa.int64()))
                .append_column("offset", pa.array([offset for _, offset in placed], pa.int64())))

    return merge


def pack(docs: DataFrame, scratch: Scratch, tokenizer: str, end_id: int, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """Pieces of the ids of ``docs`` (doc_id, text) in windows; see the module's text for the order of filling."""
    placed = scratch.store(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(_pack_partition(tokenizer, end_id, window, open_windows), f"{_PLACED}, part long, open boolean"),
        "placed")
    left = (placed.filter("open").drop("open", "sequence_id", "offset")
            .withColumn("group", F.floor(F.col("part") / MERGED_PARTITIONS)).drop("part"))
    merged = left.groupBy("group").applyInArrow(_merge(window), _PLACED)
    return placed.filter("NOT open").drop("part", "open").unionByName(merged)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 1024 ids."""
    return pack(table(spark, sf_dir, "documents"), Scratch(spark, "packing"), "byte_bpe_50k.json", 0)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents in windows; the pipeline's last stage."""
    return pack(docs, Scratch(spark, "packing-stage"), "byte_bpe_50k.json", 0)
