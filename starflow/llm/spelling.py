"""Spelling variants: words one edit apart, each tied to a far more frequent one.

Method. The vocabulary is written with a 64-bit hash of each word's code points and put into blocked Bloom
filters, one shard for each word length, laid side by side in one array of 64-bit blocks. With the array
broadcast, tasks generate the edits of their words straight as hashes (deleting or replacing a code point
changes a polynomial hash in one term) and probe the shard of the edit's length. Only positives, as a hash
and a word's number, are shuffled to a join with the vocabulary; what the filter let through by chance
finds no partner there, and what shares a hash by chance fails the comparison of the words themselves.

Inserts need no edits of their own, as a pair that differs by one is found from its longer word; a pair that
differs by a replaced code point is found from the word with the smaller one. So each pair is found once.

Scale. A filter is at most ``BLOCKS`` blocks (16 MB), whatever the vocabulary: a larger vocabulary is dealt
by hash into as many filters as it needs, each probed in a pass of its own, in which tasks generate all edits
and look up those of that filter. Words of ``LONG`` or more code points share a shard, so the layout is of
bounded size too. Edits are generated a bounded number at a time, also within one very long word.

Defined results. Words are compared by code points as they are; null words are left out, an empty word is one
edit from every word of one code point. Equal words must have been counted into one row. ``letters``, what may
replace a code point, are the code points that the vocabulary holds. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, small, table
from starflow.llm.crc import CRC_SQL, bytes_sql, crc_sql
from starflow.llm.words import mix

#: Blocks of 64 bits in a filter at most, words a block, and the length from which words share a shard.
BLOCKS = 1 << 21
WORDS_A_BLOCK = 4
LONG = 256
#: Edits generated at a time.
EDITS = 1 << 20
#: Words that a task generates edits for: some hundreds of probes a word make a small table much work.
WORDS_A_TASK = 20_000
#: A word's form occurs at least so many times as often.
RATIO = 10
_BITS = 5
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def _value(code_points: np.ndarray) -> np.ndarray:
    return mix(code_points.astype(_U) + _U(0x632BE59BD9B4E019))


def _final(sums: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """The hash of a word from its polynomial and its length."""
    return mix(sums + np.asarray(length).astype(_U) * _U(0xD6E8FEB86659FD93))


class Places:
    """The places of code points in a list of words, with what edits at each of them need."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        begin = np.concatenate([[0], np.cumsum(self.size)])
        self.code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.word = np.repeat(np.arange(len(words)), self.size)
        at = np.arange(len(self.code)) - begin[self.word]
        power = np.full(int(self.size.max(initial=0)) + 1, _BASE, _U)
        power[0] = 1
        self.power = np.cumprod(power)[at]
        self.term = _value(self.code) * self.power
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(self.term, dtype=_U)])
        self.total = sums[begin[1:]] - sums[begin[:-1]]
        self.ahead = sums[:-1] - sums[begin[:-1]][self.word]
        # Of equal code points in a row only the last is deleted: each edit once.
        self.last = np.ones(len(self.code), bool)
        self.last[:-1] = (self.code[1:] != self.code[:-1]) | (self.word[1:] != self.word[:-1])

    def hashes(self) -> np.ndarray:
        return _final(self.total, self.size)

    def deletes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word number, hash and length of each word with one code point less."""
        at = np.flatnonzero(self.last)
        word = self.word[at]
        rest = self.total[word] - self.ahead[at] - self.term[at]
        return word, _final(self.ahead[at] + rest * _U(_INVERSE), self.size[word] - 1), self.size[word] - 1

    def replaces(self, letters: np.ndarray, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The same for each code point replaced by each larger one of ``letters`` (sorted)."""
        value, first = _value(letters), np.searchsorted(letters, self.code, "right")
        many = len(letters) - first
        ends = np.cumsum(many)
        at = 0
        while at < len(many):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + edits, "right")))
            place = np.repeat(np.arange(at, to), many[at:to])
            letter = np.arange(len(place)) - np.repeat(ends[at:to] - many[at:to] - (ends[at - 1] if at else 0), many[at:to])
            letter += first[place]
            word = self.word[place]
            sums = self.total[word] - self.term[place] + value[letter] * self.power[place]
            yield word, _final(sums, self.size[word]), self.size[word]
            at = to

    def edits(self, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        yield self.deletes()
        yield from self.replaces(letters, EDITS)


class Layout:
    """Where each length's shard lies in a filter, and which of the filters a hash belongs to."""

    def __init__(self, counts: dict[int, int], blocks: int = BLOCKS):
        """``counts``: words of each length (``LONG`` for that and more)."""
        need = {length: -(-n // WORDS_A_BLOCK) for length, n in counts.items()}
        self.filters = max(1, -(-sum(need.values()) // max(1, blocks - LONG - 1)))
        self.size, self.begin = np.zeros(LONG + 1, np.int64), np.zeros(LONG + 1, np.int64)
        for length, n in need.items():
            self.size[length] = -(-n // self.filters)
        self.begin[1:] = np.cumsum(self.size)[:-1]
        self.blocks = int(self.size.sum())

    def find(self, hashes: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Filter, block and bits of hashes; last, whether their length has a shard at all."""
        shard = np.minimum(length, LONG)
        block = self.begin[shard] + (((hashes >> _U(32)) * self.size[shard].astype(_U)) >> _U(32)).astype(np.int64)
        bits = np.zeros(len(hashes), _U)
        for k in range(_BITS):
            bits |= _U(1) << ((hashes >> _U(6 * k)) & _U(63))
        which = (mix(hashes) % _U(self.filters)).astype(np.int64) if self.filters > 1 else np.zeros(len(hashes), np.int64)
        return which, block, bits, self.size[shard] > 0


def _with_hashes(vocabulary: DataFrame, scratch: Scratch) -> DataFrame:
    """The vocabulary with a number, a length and a hash for each word, written."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 2000):
            places = Places(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(places.size), pa.array(places.hashes().view(np.int64))],
                names=[*b.schema.names, "length", "hash"])

    rows = vocabulary.where("word IS NOT NULL").select(F.monotonically_increasing_id().alias("number"), "word", F.col("n").cast("long"))
    return scratch.store(rows.mapInArrow(work, "number long, word string, n long, length long, hash long"), "words")


def _filled(words: DataFrame, layout: Layout, which: int) -> np.ndarray:
    """One of the filters: its blocks are filled by tasks and aggregated by Spark; at most ``BLOCKS`` rows come back."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, block, bits, _ = layout.find(b.column(1).to_numpy().view(_U), b.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(block[of == which]), pa.array(bits[of == which].view(np.int64))], names=["block", "bits"])

    rows = words.select("length", "hash").mapInArrow(work, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits"))
    got, out = rows.toArrow(), np.zeros(max(1, layout.blocks), _U)
    out[got.column("block").to_numpy()] = got.column("bits").to_numpy().view(_U)
    return out


def _positives(words: DataFrame, layout: Layout, which: int, letters: np.ndarray) -> DataFrame:
    """(number, hash) of every edit of a word that one of the filters may hold."""
    bloom = words.sparkSession.sparkContext.broadcast(_filled(words, layout, which))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bloom.value
        for b in small(batches, 2000):
            number = b.column(0).to_numpy()
            places = Places(b.column(1).to_pylist())
            for word, hashes, length in places.edits(letters):
                of, block, bits, known = layout.find(hashes, length)
                hit = np.flatnonzero(known & (of == which))
                hit = hit[(held[block[hit]] & bits[hit]) == bits[hit]]
                if len(hit):
                    yield pa.RecordBatch.from_arrays([pa.array(number[word[hit]]), pa.array(hashes[hit].view(np.int64))], names=["number", "hash"])

    return words.select("number", "word").mapInArrow(work, "number long, hash long")


def near_pairs(words: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(a, b) numbers of any two words one edit apart, each pair once; ``words`` as ``_with_hashes`` writes them."""
    shard = F.least("length", F.lit(LONG)).alias("shard")
    counts = {r["shard"]: r["n"] for r in words.groupBy(shard).agg(F.count("*").alias("n")).collect()}
    # As many rows as there are different code points.
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    letters = np.array(sorted(ord(r["c"]) for r in letters.collect()), np.uint32)
    layout = Layout(counts, blocks)
    dealt = words.repartition(-(-max(1, sum(counts.values())) // WORDS_A_TASK), "number")
    found = _positives(dealt, layout, 0, letters)
    for which in range(1, layout.filters):
        found = found.unionAll(_positives(dealt, layout, which, letters))
    right = words.select(F.col("number").alias("b"), F.col("word").alias("word_b"), "hash")
    left = words.select(F.col("number").alias("a"), F.col("word").alias("word_a"))
    hits = found.join(right, "hash").where("number <> b")   # the filter's false positives end here
    # Equal hashes of different words end here.
    same = hits.withColumnRenamed("number", "a").join(left, "a").where(F.levenshtein("word_a", "word_b", 1) == 1)
    return same.select("a", "b")


def group_variants(vocabulary: DataFrame, scratch: Scratch, ratio: int = RATIO, blocks: int = BLOCKS) -> DataFrame:
    """``vocabulary`` (word, n) with n_near, form, form_n and root.

    A word's form is its near word with the largest n (ties: the smallest in code-point order), if that is at
    least ``ratio`` (2 or more) times its own; its root is the last of its form, that one's form, and so on.
    """
    words = _with_hashes(vocabulary, scratch)
    pairs = scratch.store(near_pairs(words, blocks), "pairs")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("number").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = both.join(other, "b").groupBy(F.col("a").alias("number")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near", "b")).alias("top"))
    tied = scratch.store(words.join(best, "number", "left").select(
        "number", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.less") >= F.col("n") * ratio, F.col("top")).alias("top")), "tied")
    # Counts grow by the ratio from form to form, so the ways are short, and each round halves what is left of them.
    now, k = scratch.store(tied.where("top IS NOT NULL").select("number", F.col("top.b").alias("root")), "roots-0"), 0
    while True:
        on = now.select(F.col("number").alias("root"), F.col("root").alias("further"))
        step = now.join(on, "root", "left").select("number", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        k += 1
        step = scratch.store(step, f"roots-{k}")
        scratch.drop(f"roots-{k - 1}")
        now = step.select("number", "root")
        if step.where("moved").isEmpty():
            break
    roots = now.join(words.select(F.col("number").alias("root"), F.col("word").alias("root_word")), "root").select("number", "root_word")
    return tied.join(roots, "number", "left").select(
        "word", "n", "n_near", F.col("top.near").alias("form"), (-F.col("top.less")).alias("form_n"),
        F.coalesce("root_word", "word").alias("root"))


#: Fixed by the data contract: runs of letters, what is lower-cased, the least length and count of a word.
LETTER = "[A-Za-z\u00C0-\u00FF]"
LEAST_LENGTH, LEAST_COUNT = 7, 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _vocabulary(docs: DataFrame) -> DataFrame:
    """The query's words and their counts: some runs lose a code point, by document and run.

    Runs too short to give a word are left out by the pattern: it can match within a maximal run only from
    its start, and whole.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{LETTER}{{{LEAST_LENGTH},}}"), 0)).alias("run"))
    runs = runs.select("doc_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.left("run", at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(h % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LENGTH))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its count, its near words' number, its form and its root."""
    return group_variants(_vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text")), Scratch(spark, "spelling"))


OP13_SQL = f"""
WITH RECURSIVE {CRC_SQL},
  runs AS (SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS n
           FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{LETTER}{{{LEAST_LENGTH},}}')) AS run FROM documents)
           GROUP BY ALL),
  hashed AS (SELECT run, n, {crc_sql(bytes_sql("doc_id || ':' || run"))} AS h FROM runs, bits),
  words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                   CAST(sum(n) AS BIGINT) AS n
            FROM hashed GROUP BY 1 HAVING sum(n) >= {LEAST_COUNT} AND length(word) >= {LEAST_LENGTH}),
  cuts AS (SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS cut
           FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)),
  near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.k = b.k AND a.cut = b.cut AND a.word <> b.word
                  AND length(a.word) = length(b.word)
           UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
           UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
  top AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n
          FROM near GROUP BY word),
  tied AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {RATIO} * n THEN form END AS form,
                  CASE WHEN form_n >= {RATIO} * n THEN form_n END AS form_n
           FROM words w LEFT JOIN top t ON w.word = t.word),
  ways AS (SELECT word, word AS reached, 0 AS steps FROM tied
           UNION ALL SELECT ways.word, tied.form, steps + 1 FROM ways JOIN tied ON tied.word = ways.reached AND tied.form IS NOT NULL),
  roots AS (SELECT word, arg_max(reached, steps) AS root FROM ways GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM tied JOIN roots USING (word)
"""
