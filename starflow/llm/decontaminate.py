"""Benchmark decontamination by spaced-seed hashing.

Fixed masks pick some of the words at neighbouring positions and ignore the
others, so a hash still agrees where ignored words differ. Hashes of the test
items are joined to those of all positions of the training texts; each hit names
an alignment of an item with a text, along which words are then compared. A text
is contaminated where 13 words in a row (all words of a shorter item) agree in at
least four of five positions. The masks find every such place: any two of 13
positions may differ (one in five of 6 to 12).

The items are a stated query set: they are taken in blocks of bounded size, and
every text meets every block. Within a block the hash table goes to all tasks.

Defined results. Words are runs of other characters than ASCII white space, in
lower case. A null or empty text has no hits. Items with fewer than six words say too
little inside other words: with ``short_items`` (as the query and the pipeline have it) they
match where a whole line or the whole text has exactly their words, else nothing. Items
without words match nothing. Repeated rows and items are reported each on their own.
Empty tables on either side give no hits. Other columns pass through the filter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm.common import ship, small, table
from starflow.llm.words import batches_of, mix, word_hashes

WINDOW = 13
#: A place counts if at most one word in so many differs.
ONE_IN = 5
MIN_WORDS = 6
#: For items of WINDOW words or more, and for shorter ones: together they find every place that counts.
MASKS = ((0, 1, 3, 4, 5, 6), (0, 1, 2, 5, 7, 9), (0, 1, 2, 3, 4, 5))
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 3, 4))
#: Bytes of item texts in a block.
BLOCK_BYTES = 4 << 20
#: The filter in front of the hash table: bits, as a power of two.
FILTER_BITS = 24


def seeds(words: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    """The hash under ``mask`` at each position where the mask fits."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, salt, np.uint64)
    for k in mask:
        out *= np.uint64(0x9FB21C651E98DF25)
        out += words[k:k + n]
    return mix(out)


class Index:
    """A block of items: their words, and a sorted table of seed hashes."""

    def __init__(self, items: list[tuple[object, str]], short_items: bool = False):
        self.ids, self.words = [], []
        self.short: dict[tuple[bytes, ...], list[object]] = {}
        found: list[tuple[np.ndarray, int, np.ndarray]] = []
        for ident, text in items:
            lower = (text or "").lower().encode("utf-8", "surrogatepass")
            words = word_hashes(lower)[0]
            if len(words) < MIN_WORDS:
                if short_items and len(words):
                    self.short.setdefault(tuple(lower.split()), []).append(ident)
                continue
            for salt, mask in self.masks(len(words)):
                hashes = seeds(words, mask, salt)
                found.append((hashes, len(self.ids), np.arange(len(hashes))))
            self.ids.append(ident)
            self.words.append(words)
        self.used = [m for m in self.masks(WINDOW) + self.masks(MIN_WORDS)
                     if any(m in self.masks(len(w)) for w in self.words)]
        hashes = np.concatenate([h for h, _, _ in found]) if found else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.concatenate([np.full(len(h), i) for h, i, _ in found])[order] if found else order
        self.at = np.concatenate([a for _, _, a in found])[order] if found else order
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - FILTER_BITS)] = True

    @staticmethod
    def masks(n_words: int) -> list[tuple[int, tuple[int, ...]]]:
        return list(enumerate(MASKS)) if n_words >= WINDOW else [(8 + k, m) for k, m in enumerate(SHORT_MASKS)]

    def hits(self, words: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first word, words compared, words that agree) of the best place of each text and item."""
        where, entry = [], []
        for salt, mask in self.used:
            hashes = seeds(words, mask, salt)
            maybe = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
            low = np.searchsorted(self.hashes, hashes[maybe], "left")
            n = np.searchsorted(self.hashes, hashes[maybe], "right") - low
            maybe, low, n = maybe[n > 0], low[n > 0], n[n > 0]
            where.append(np.repeat(maybe, n))
            entry.append(np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum()))
        if not where:
            return
        where, entry = np.concatenate(where), np.concatenate(entry)
        text = np.searchsorted(begins, where, "right") - 1
        lines = np.unique(np.stack([text, self.item[entry], where - self.at[entry]]), axis=1)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for t, i, start in lines.T.tolist():
            if place := self.compare(i, words, start, int(begins[t]), int(begins[t + 1])):
                now = best.get((t, i))
                if now is None or (place[2], -place[0]) > (now[2], -now[0]):
                    best[(t, i)] = place
        for (t, i), (start, compared, agree) in sorted(best.items()):
            yield t, i, start - int(begins[t]), compared, agree

    def whole(self, text: bytes) -> Iterator[tuple[object, int, int]]:
        """(item, first word, words) of the short items that are the whole of ``text`` or of a line; the first place of each."""
        if not self.short:
            return
        seen, at = set(), 0
        for part in [text, *text.split(b"\n")]:
            words = tuple(part.split(None, MIN_WORDS - 1))
            if words in self.short and words not in seen:
                seen.add(words)
                for ident in self.short[words]:
                    yield ident, len(text[:at].split()), len(words)
            at += 0 if part is text else len(part) + 1

    def compare(self, item: int, words: np.ndarray, start: int, low: int, high: int) -> tuple[int, int, int] | None:
        """The best window of an alignment that counts: its first word, its length and how many words agree."""
        own = self.words[item]
        first, last = max(start, low), min(start + len(own), high)
        size = min(len(own), WINDOW)
        if last - first < size:
            return None
        same = np.concatenate([[0], np.cumsum(words[first:last] == own[first - start:last - start])])
        agree = same[size:] - same[:-size]
        k = int(np.argmax(agree))
        return (first + k, size, int(agree[k])) if size - int(agree[k]) <= size // ONE_IN else None


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The items, a bounded block at a time."""
    ship(items.sparkSession)
    text = F.coalesce("text", F.lit(""))
    total = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for k in range(n):
        block = items.filter(F.pmod(F.xxhash64("item_id", text), F.lit(n)) == k) if n > 1 else items
        yield [(r["item_id"], r["text"]) for r in block.select("item_id", "text").collect()]


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """Texts in lower case."""
    return [v.as_buffer().to_pybytes().decode("utf-8", "replace").lower().encode() if v.is_valid else b""
            for v in batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())]


def overlaps(docs: DataFrame, items: DataFrame, text: str = "text", short_items: bool = False) -> DataFrame:
    """One row per text and item that overlap: doc_id, item_id, first_word, n_words, n_same."""
    schema = "doc_id long, item_id long, first_word long, n_words long, n_same long"
    docs, items = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")), items.withColumn("item_id", F.col("item_id").cast("long"))

    def find(index) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["doc_id", "item_id", "first_word", "n_words", "n_same"]
            for b in small(batches):
                ids, texts = b.column(0).to_pylist(), _texts(b, "text")
                rows = [(i, item, at, n, n) for i, t in zip(ids, texts, strict=True) for item, at, n in index.value.whole(t)]
                for first, _, words, begins in batches_of(texts):
                    rows += [(ids[first + t], index.value.ids[i], *place)
                             for t, i, *place in index.value.hits(words, begins)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(items):
        index = docs.sparkSession.sparkContext.broadcast(Index(block, short_items))
        out = out.unionAll(docs.mapInArrow(find(index), schema))
    return out


def clean(docs: DataFrame, items: DataFrame, text: str = "text", short_items: bool = False) -> DataFrame:
    """The rows of ``docs`` whose text overlaps no item, unchanged."""

    def without(index) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in small(batches):
                texts = _texts(b, text)
                keep = np.array([next(index.value.whole(t), None) is None for t in texts], bool)
                for first, _, words, begins in batches_of(texts):
                    for t, *_ in index.value.hits(words, begins):
                        keep[first + t] = False
                yield b.filter(pa.array(keep))

        return run

    for block in _blocks(items):
        index = docs.sparkSession.sparkContext.broadcast(Index(block, short_items))
        docs = docs.mapInArrow(without(index), docs.schema)
    return docs


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that overlap."""
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that overlap no benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"), short_items=True)
