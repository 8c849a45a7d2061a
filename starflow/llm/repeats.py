"""Repeated byte strings across documents, by phrases of a prefix-free parse.

A rolling hash marks triggers: in every window of LENGTH bytes the GRAM-byte
string of least hash. Triggers depend on the bytes alone, so equal windows have
the same trigger at the same place, and cut a text into phrases: each trigger's
phrase is the bytes of all windows whose trigger it is. Neighbouring phrases
overlap by LENGTH - 1 bytes, so no window is lost between them.

Texts that are whole copies are set aside first, by digest. Then:

1. Every trigger's hash goes, with its document, to one aggregate. A trigger
   that only one document has cannot lie in a repeated window; the others are
   the dictionary's. They are also kept in a bitmap of fixed size.
2. Phrases whose trigger is in the bitmap (few, in most corpora) meet those with
   the same trigger. There, the windows of all phrases are brought into one order
   by hash, in which equal windows are neighbours, and the least document of
   each is found. A trigger with very many phrases has its windows grouped by
   Spark instead, window by window.
3. Windows whose least document is smaller than their own give byte ranges, which
   are put together per document and cut out of its text.

A full order of all suffixes of dictionary and parse is not made: only windows
that agree on all LENGTH bytes matter, and phrases without a partner need no
place in it. Full orders of the suffixes would move many times the corpus.

Defined results. A null or empty text has no bytes. Rows with equal ids do not
remove bytes from each other. A row with a null id keeps all its bytes and
removes none elsewhere. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, table
from starflow.llm.words import mix

LENGTH = 50
GRAM = 20
#: Window starts handled at a time; a longer text is taken in stretches that overlap by LENGTH - 1 bytes.
STRETCH = 1 << 17
BITMAP_BITS = 27
#: A trigger in more documents than this has its windows grouped one by one.
HOT_TRIGGER = 100_000
#: Ids sent to all tasks, where a join would otherwise shuffle every text; checked by a count.
MAX_SENT_IDS = 200_000
_BASE = 0xD6E8FEB86659FD93


class _Tables:
    def __init__(self):
        self.value = np.random.default_rng(20240613).integers(1, 1 << 63, 256, np.uint64)
        self.power, self.inverse = self._powers(_BASE), self._powers(pow(_BASE, -1, 1 << 64))

    @staticmethod
    def _powers(base: int) -> np.ndarray:
        out = np.full(2 * STRETCH + 4 * LENGTH, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)


_TABLES: list[_Tables] = []


def _tables() -> _Tables:
    if not _TABLES:
        _TABLES.append(_Tables())
    return _TABLES[0]


def string_hashes(raw: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of all strings of ``length`` bytes of an array of bytes."""
    t = _tables()
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(t.value[raw] * t.power[:len(raw)], dtype=np.uint64)])
    return mix((sums[length:] - sums[:-length]) * t.inverse[:len(sums) - length])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, from running minima of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def phrases(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For stretches of the texts laid end to end: their bytes, and per phrase the trigger's hash, text, first and last window.

    Windows are given by where they start in the stretch; ``base`` of a text's stretch is its place in the text.
    """
    parts: list[tuple[int, int, bytes]] = []
    size = 0
    for k, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, STRETCH):
            part = text[at:at + STRETCH + LENGTH - 1]
            if parts and size + len(part) > STRETCH + LENGTH:
                yield _phrases_of(parts)
                parts, size = [], 0
            parts.append((k, at, part))
            size += len(part)
    if parts:
        yield _phrases_of(parts)


def _phrases_of(parts: list[tuple[int, int, bytes]]):
    raw = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    sizes = np.array([len(p) for _, _, p in parts])
    grams = string_hashes(raw, GRAM)
    place = np.arange(len(grams), dtype=np.uint64)
    least = sliding_least((grams & np.uint64(0xFFFFFFFFFF000000)) | place, LENGTH - GRAM + 1)
    trigger = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    inside = np.ones(len(trigger) + 1, bool)
    for e in ends:
        inside[e - LENGTH + 1:e] = False  # windows that would cross into the next text
    inside[len(trigger):] = False
    change = np.concatenate([[True], (trigger[1:] != trigger[:-1]) | ~inside[:len(trigger) - 1]])
    first = np.flatnonzero(change & inside[:len(trigger)])
    stop = np.flatnonzero(np.concatenate([(change[1:] | ~inside[1:len(trigger)]), [True]]) & inside[:len(trigger)])
    part = np.searchsorted(ends, first, "right")
    text = np.array([k for k, _, _ in parts])[part]
    base = np.array([at for _, at, _ in parts])[part] - begins[part]
    return raw, grams[trigger[first]], text, np.stack([first, stop]), base


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in batch.column(1).cast(pa.large_binary())]


def _triggers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, found, of = b.column(0).to_numpy(zero_copy_only=False), [], []
        for _, trigger, text, _, _ in phrases(_texts(b)):
            found.append(trigger)
            of.append(ids[text])
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)),
                                              pa.array(np.concatenate(of), pa.int64())], names=["trigger", "doc_id"])


def _slot(trigger: np.ndarray) -> np.ndarray:
    return (mix(trigger.view(np.uint64)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_slot(b.column(0).to_numpy(zero_copy_only=False)))], names=["slot"])


def _row_key(text: bytes) -> int:
    """Names a row among those with its id; 0 stands for the only one."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


_PHRASE = "trigger long, doc_id long, row_key long, first long, n long, bytes binary"


def _shared_phrases(bitmap, repeated_ids: bool):
    names = [f.split()[0] for f in _PHRASE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        for b in batches:
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), _texts(b)
            keys: dict[int, int] = {}
            for raw, trigger, text, windows, base in phrases(texts):
                slot = _slot(trigger)
                hit = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                if not len(hit):
                    continue
                text, (first, last), data = text[hit], windows[:, hit], raw.tobytes()
                for k in np.unique(text).tolist() if repeated_ids else ():
                    keys.setdefault(k, _row_key(texts[k]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(trigger[hit].view(np.int64)), pa.array(ids[text], pa.int64()),
                    pa.array([keys.get(k, 0) for k in text.tolist()], pa.int64()), pa.array(first + base[hit]),
                    pa.array(last - first + 1),
                    pa.array([data[f:t + LENGTH] for f, t in zip(first.tolist(), last.tolist(), strict=True)], pa.binary()),
                ], names=names)

    return run


def _windows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each phrase's windows as hashes, and the phrase's number and the window's place in it."""
    n = table["n"].to_numpy()
    hashes = np.empty(int(n.sum()), np.uint64)
    values, at, begin = table["bytes"], 0, 0
    sizes = n + LENGTH - 1
    ends = np.cumsum(sizes)
    flat = b"".join(values.to_pylist())
    while begin < len(n):
        until = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + STRETCH, "right")))
        low = int(ends[begin - 1]) if begin else 0
        found = string_hashes(np.frombuffer(flat, np.uint8, int(ends[until - 1]) - low, low), LENGTH)
        k = n[begin:until]
        offset = np.repeat(ends[begin:until] - sizes[begin:until] - low - (np.cumsum(k) - k), k)
        hashes[at:at + int(k.sum())] = found[offset + np.arange(int(k.sum()))]
        at, begin = at + int(k.sum()), until
    return hashes, np.repeat(np.arange(len(n)), n), np.arange(len(hashes)) - np.repeat(np.cumsum(n) - n, n)


_RANGE = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _ranges(table: pa.Table, of: np.ndarray, at: np.ndarray, repeated: np.ndarray) -> pa.RecordBatch:
    """Runs of repeated windows of a phrase as byte ranges."""
    of, at = of[repeated], at[repeated]
    new = np.concatenate([[True], (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)])[:len(of)]
    first, last = np.flatnonzero(new), np.concatenate([np.flatnonzero(new)[1:] - 1, [len(of) - 1]])[:new.sum()]
    base = table["first"].to_numpy()[of[first]]
    row = table.select(["doc_id", "row_key"]).take(pa.array(of[first]))
    return pa.RecordBatch.from_arrays([row["doc_id"].combine_chunks(), row["row_key"].combine_chunks(),
                                       pa.array(base + at[first]), pa.array(base + at[last] + LENGTH)], schema=_RANGE)


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases in order of their triggers; those of a few triggers are held at a time."""
    held: list[pa.RecordBatch] = []  # of one trigger, whose other phrases may follow
    for b in batches:
        if not b.num_rows:
            continue
        trigger = b.column(0).to_numpy()
        if held and held[0].column(0)[0].as_py() != trigger[0]:
            yield from _match_some(pa.Table.from_batches(held))
            held = []
        if cut := int(np.searchsorted(trigger, trigger[-1], "left")):
            yield from _match_some(pa.Table.from_batches([*held, b.slice(0, cut)]))
            held = []
        held.append(b.slice(cut))
    if held:
        yield from _match_some(pa.Table.from_batches(held))


def _match_some(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """All phrases of some triggers: windows in order of hash, least document of equal ones."""
    table = table.combine_chunks()
    hashes, of, at = _windows(table)
    doc, trigger = table["doc_id"].to_numpy()[of], table["trigger"].to_numpy().view(np.uint64)[of]
    hashes = mix(hashes + trigger)  # equal windows have equal triggers
    order = np.lexsort((doc, hashes))
    new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
    least = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    repeated = np.zeros(len(order), bool)
    repeated[order] = least < doc[order]
    if repeated.any():
        yield _ranges(table, of, at, repeated)


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of very frequent triggers, a row for each window."""
    for b in batches:
        table = pa.Table.from_batches([b])
        hashes, of, at = _windows(table)
        row = table.select(["doc_id", "row_key"]).take(pa.array(of))
        yield pa.RecordBatch.from_arrays([
            pa.array(mix(hashes + table["trigger"].to_numpy().view(np.uint64)[of]).view(np.int64)),
            row["doc_id"].combine_chunks(), row["row_key"].combine_chunks(),
            pa.array(table["first"].to_numpy()[of] + at)], names=["window", "doc_id", "row_key", "start"])


def _by_trigger(found: DataFrame) -> DataFrame:
    return found.repartition("trigger").sortWithinPartitions("trigger")


def repeated_ranges(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, row_key, start, stop): byte ranges of ``docs`` (doc_id, text) that a smaller doc_id has too."""
    spark = docs.sparkSession
    docs = docs.filter("doc_id IS NOT NULL")
    triggers = (docs.mapInArrow(_triggers, "trigger long, doc_id long").groupBy("trigger")
                .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"))
                .filter("least < most").select("trigger", "n"))
    triggers = scratch.store(triggers, "triggers")
    slots = triggers.select("trigger").mapInArrow(_slots, "slot long")
    blobs = (slots.withColumn("slot", F.col("slot") + 1)  # these functions count from 1
             .groupBy(F.bitmap_bucket_number("slot").alias("k"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)  # of fixed size, whatever the corpus
    for r in blobs:
        at = (r["k"] - 1) * len(r["bits"])
        bitmap[at:at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)[:len(bitmap) - at]
    again = not docs.groupBy("doc_id").count().filter("count > 1").isEmpty()
    found = docs.mapInArrow(_shared_phrases(spark.sparkContext.broadcast(bitmap.tobytes()), again), _PHRASE)
    hot = scratch.store(triggers.filter(F.col("n") > HOT_TRIGGER).select("trigger"), "hot")
    schema = "doc_id long, row_key long, start long, stop long"
    if hot.isEmpty():
        return _by_trigger(found).mapInArrow(_match, schema)
    found = scratch.store(found, "phrases")
    cold = found.join(hot, "trigger", "left_anti").select(*found.columns)
    windows = found.join(hot, "trigger", "left_semi").select(*found.columns).mapInArrow(
        _explode, "window long, doc_id long, row_key long, start long")
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"))
    many = (windows.join(least, "window").filter(F.col("least") < F.col("doc_id"))
            .select("doc_id", "row_key", "start", (F.col("start") + LENGTH).alias("stop")))
    return _by_trigger(cold).mapInArrow(_match, schema).unionAll(many)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their ranges (sorted lists of starts and stops; null or another row's: none)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept", pa.binary())])
    for b in batches:
        rows = []
        for doc_id, text, spans in zip(b.column(0).to_pylist(), _texts(b), b.column(2), strict=True):
            kept, at, removed, n = [], 0, 0, 0
            if spans.is_valid:
                key, until = _row_key(text), -1
                for s in spans.as_py():
                    if s["row_key"] not in (0, key):
                        continue
                    if s["start"] > until:
                        n += 1
                        kept.append(text[max(at, 0):s["start"]])
                        removed += s["stop"] - s["start"]
                    elif s["stop"] > until:
                        removed += s["stop"] - until
                    at = until = max(until, s["stop"])
            kept.append(text[at:])
            rows.append((doc_id, len(text), removed, n, b"".join(kept)))
        for k in range(0, len(rows), 1000):
            cols = zip(*rows[k:k + 1000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(copy_id, copy_key) of texts of LENGTH bytes or more that a smaller doc_id has as a whole."""
    digest = F.unhex(F.md5(F.col("text").cast("binary")))
    ids = scratch.store(docs.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
                        .select("doc_id", digest.alias("digest")), "digests")
    shared = ids.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    copies = (ids.join(shared.drop("most"), "digest").filter("doc_id > least")
              .select(F.col("doc_id").alias("copy_id"), F.col("digest").alias("copy_key")).distinct())
    return scratch.store(copies, "copies")


def _sent(ids: DataFrame) -> DataFrame:
    """A written table of ids for broadcasting, if its count allows; else as it is."""
    return F.broadcast(ids) if ids.count() <= MAX_SENT_IDS else ids


def remove_repeats(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each row of ``docs`` (doc_id, text); ``kept`` is what is left.

    Texts that a smaller id has as a whole lose all bytes and need no parse. Of the others, only those that lose
    bytes are joined with their ranges; the rest is passed on where it is.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    copies = _sent(_copies(docs, scratch))
    copied = (F.col("doc_id") == F.col("copy_id")) & (F.unhex(F.md5(F.col("text").cast("binary"))) == F.col("copy_key"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    none = F.lit(0).cast("long")
    gone = docs.join(copies, copied, "left_semi").select(
        "doc_id", size.alias("n_bytes"), size.alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept"))
    docs = docs.join(copies, copied, "left_anti")
    spans = scratch.store(
        repeated_ranges(docs, scratch).groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("start", "stop", "row_key"))).alias("spans")), "spans")
    scratch.drop("phrases", "triggers")
    hit = _sent(spans.select(F.col("doc_id").alias("span_id")))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    same = F.col("doc_id") == F.col("span_id")
    cut = docs.join(hit, same, "left_semi").join(spans, "doc_id").select("doc_id", "text", "spans").mapInArrow(_cut, schema)
    whole = docs.join(hit, same, "left_anti").select(
        "doc_id", size.alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("kept"))
    return cut.unionAll(whole).unionAll(gone)


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 50 bytes that a document of a smaller id has too."""
    found = remove_repeats(table(spark, sf_dir, "documents"), Scratch(spark, "repeats"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
