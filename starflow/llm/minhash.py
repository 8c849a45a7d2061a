"""Near duplicates: MinHash with banding, signatures, exact sets, connected components.

1. Each text's set of distinct word shingles (as 64-bit hashes) gives a class key
   (a digest of the whole set), 128 universal hash minima and 32 band keys. Texts
   with equal sets are one class from here on, and classes go by a number.
2. In each bucket of a band every class is tied to the least class there, so a
   bucket of n classes gives n - 1 ties and no pairs. Components of these ties are
   candidate clusters: two classes that share any bucket are in one cluster.
3. Within a cluster every pair of classes is compared by signature, and those that
   may reach the similarity on the full sets, in a task that holds this cluster's
   sets only. Pairs that are already connected are passed over, so the task gives
   at most one link per class. A cluster with more shingles than a task should
   hold is cut into blocks, and each pair of blocks is a task.
4. Components of the links are the groups; a group's id is its least doc_id.

A pair of similarity 0.8 shares no band with a probability below 1e-7.

Texts are found again by their ids; those of ids that name no single text (null
or repeated) by their class.

Defined results. A null, empty or blank text has an empty set, and is a group of
its own. Repeated rows are members of one group. Null ids belong to groups but
give no group id; ``kept`` is false for them unless the whole group has no id. An
empty table gives an empty result. Other columns are not read (the stage passes
them on).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.llm.common import Scratch, fresh, small, table
from starflow.llm.components import components
from starflow.llm.words import batches_of, mix

BANDS, ROWS = 32, 4
PERCENT = 80
#: Signatures that agree on fewer hashes than this share belong to no pair that could reach PERCENT: eight
#: standard deviations of the estimate lie between.
SIGNATURE_SHARE = 0.5
#: Shingles of a block of a cluster.
BLOCK_SHINGLES = 1_500_000
#: Ids sent to all tasks, where a join would otherwise shuffle every text; checked by a count.
MAX_SENT_IDS = 200_000


class _Family:
    """Parameters of the universal hash functions; the same in every worker."""

    def __init__(self):
        rng = np.random.default_rng(20240611)
        self.a = rng.integers(1, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64)


_FAMILY: list[_Family] = []


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's word hashes; all words are one where there are fewer."""
    size = min(size, len(words))
    if not size:
        return words[:0]
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += words[k:k + n]
    return np.unique(mix(out))


def signature(found: np.ndarray) -> np.ndarray:
    """The least value of each hash function (multiply-shift, 32 bits) over a set, a few thousand at a time."""
    if not _FAMILY:
        _FAMILY.append(_Family())
    f, x = _FAMILY[0], found >> np.uint64(32)
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(x), 4096):
        np.minimum(least, (f.a * x[at:at + 4096] + f.b).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def class_key(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _sets(batch: pa.RecordBatch, column: str, size: int) -> Iterator[np.ndarray]:
    texts = [v.as_buffer().to_pybytes() if v.is_valid else b""
             for v in batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())]
    for first, last, words, begins in batches_of(texts):
        for k in range(last - first):
            yield shingles(words[begins[k]:begins[k + 1]], size)


def _sketch(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("cls", pa.binary()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            keys, sizes, bands = [], [], []
            for found in _sets(b, "text", size):
                sig = signature(found).astype(np.uint64)
                key = np.arange(1, BANDS + 1, dtype=np.uint64)
                for k in range(ROWS):
                    key = mix(key * np.uint64(0x9FB21C651E98DF25) + sig[k::ROWS])
                keys.append(class_key(found))
                sizes.append(len(found))
                bands.append(key.view(np.int64))
            flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), pa.array(flat))],
                schema=schema)

    return run


def _with_sets(size: int):
    """(root, block, blocks, num, sig, members) of rows whose text has the class looked for."""
    schema = pa.schema([("root", pa.int64()), ("block", pa.int64()), ("blocks", pa.int64()), ("num", pa.int64()),
                        ("sig", pa.binary()), ("members", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            wanted, rows = b.column(b.schema.get_field_index("cls")), []
            for k, found in enumerate(_sets(b, "text", size)):
                if class_key(found) == wanted[k].as_py():
                    rows.append((k, signature(found).astype(np.uint8).tobytes(), found.tobytes()))
            if rows:
                own = b.select(["root", "block", "blocks", "num"]).take(pa.array([k for k, _, _ in rows]))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array([x for _, x, _ in rows], pa.binary()),
                                                  pa.array([x for _, _, x in rows], pa.binary())], schema=schema)

    return run


def _link(percent: int):
    """Links of one cluster, or of one pair of its blocks: a row (u, v) for each class but one of a group."""
    def run(found: pa.Table) -> pa.Table:
        rows = dict(zip(found["num"].to_pylist(), zip(found["sig"].to_pylist(), found["members"].to_pylist(),
                                                      strict=True), strict=True))
        order = sorted(rows, key=lambda c: (len(rows[c][1]), c))
        sets = [np.frombuffer(rows[c][1], np.uint64) for c in order]
        sig = np.frombuffer(b"".join(rows[c][0] for c in order), np.uint8).reshape(len(order), -1)
        size = np.array([len(s) for s in sets])
        begin, flat = np.concatenate([[0], np.cumsum(size)]), np.concatenate(sets)
        group = np.arange(len(order))
        links = []
        for i, own in enumerate(sets):
            # By size first: a set of more than 100 / percent times as many members is too large.
            stop = np.searchsorted(size, size[i] * 100 // percent, "right")
            other = np.arange(i + 1, stop)
            other = other[group[other] != group[i]]
            if not len(other):
                continue
            other = other[(sig[other] == sig[i]).mean(axis=1) >= SIGNATURE_SHARE]
            for at in range(0, len(other), 512):
                some = other[at:at + 512]
                some = some[group[some] != group[i]]
                if not len(some):
                    continue
                n = size[some]
                ends = np.cumsum(n)
                values = flat[np.repeat(begin[some] - (ends - n), n) + np.arange(ends[-1])]
                at_own = np.minimum(np.searchsorted(own, values), len(own) - 1)
                both = np.add.reduceat((own[at_own] == values).astype(np.int64), ends - n)
                for j in some[100 * both >= percent * (n + size[i] - both)]:
                    if group[j] != group[i]:
                        links.append((order[i], order[j]))
                        group[group == group[j]] = group[i]
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()),
                         "v": pa.array([v for _, v in links], pa.int64())})

    return run


def _sent(ids: DataFrame) -> DataFrame:
    """A written table of ids for broadcasting, if its count allows; else as it is."""
    return F.broadcast(ids) if ids.count() <= MAX_SENT_IDS else ids


def _texts(docs: DataFrame, sketch: DataFrame, wanted: DataFrame, scratch: Scratch, words: int) -> DataFrame:
    """``docs``' texts with the rows of ``wanted`` (written) that they stand for, one text a class.

    By id, but for ids that are null or on several rows: a join by such an id would be a product, so those rows'
    classes are made again and joined.
    """
    vague = scratch.store(sketch.filter("n > 0").groupBy("doc_id").agg(F.count("*").alias("rows"))
                          .filter("doc_id IS NULL OR rows > 1").select(F.col("doc_id").alias("vague_id")), "vague")
    if vague.isEmpty():
        return docs.join(_sent(wanted), F.col("doc_id") == F.col("first_id"))
    is_vague = F.col("first_id").eqNullSafe(F.col("vague_id"))
    by_id = scratch.store(wanted.join(vague, is_vague, "left_anti"), "by-id")
    by_class = scratch.store(wanted.join(vague, is_vague, "left_semi"), "by-class")
    again = (docs.join(vague, F.col("doc_id").eqNullSafe(F.col("vague_id")), "left_semi")
             .mapInArrow(_with_class(words, "cls"), "doc_id long, text string, cls binary"))
    return docs.join(_sent(by_id), F.col("doc_id") == F.col("first_id")).unionByName(
        again.join(by_class, "cls").dropDuplicates(["cls"]))


def groups(docs: DataFrame, scratch: Scratch, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, cls, root, component_id) of each row of ``docs`` (doc_id, text).

    ``root`` names the group (null for empty sets), ``component_id`` is its least doc_id.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketch = scratch.store(docs.mapInArrow(_sketch(words), "doc_id long, cls binary, n long, bands array<long>"), "sketch")
    classes = scratch.store(sketch.filter("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .withColumn("num", F.monotonically_increasing_id()), "classes")
    keys = classes.select("num", F.explode("bands").alias("key"))
    # Written, so that the join below may split a bucket of very many classes.
    least = scratch.store(keys.groupBy("key").agg(F.min("num").alias("v"), F.count("*").alias("many"))
                          .filter("many > 1").drop("many"), "least")
    ties = keys.join(least, "key").select(F.col("num").alias("u"), "v").filter("u <> v")
    clusters = components(ties, scratch, "clusters")
    scratch.drop("least")
    members = scratch.store(clusters.join(classes.drop("bands"), F.col("node") == F.col("num")).drop("node"), "members")
    blocks = members.groupBy("root").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    wanted = scratch.store(members.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("num"), F.col("blocks")))
                           .drop("n"), "wanted")
    sets = _texts(docs, sketch, wanted, scratch, words).mapInArrow(
        _with_sets(words), "root long, block long, blocks long, num long, sig binary, members binary")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: F.struct(
        F.least(k, F.col("block")).alias("a"), F.greatest(k, F.col("block")).alias("b")))
    links = scratch.store(
        sets.withColumn("pair", F.explode(pairs)).select("root", "pair", "num", "sig", "members")
        .groupBy("root", "pair").applyInArrow(_link(percent), "u long, v long"), "links")
    grouped = components(links, scratch, "groups")
    rooted = classes.select("num", "cls", "first_id").join(grouped, F.col("num") == F.col("node"), "left")
    rooted = scratch.store(rooted.select("cls", "first_id", F.coalesce("root", "num").alias("root")), "rooted")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = scratch.store(rooted.drop("first_id").join(ids, "root"), "labels")
    joined = sketch.select("doc_id", F.col("n").alias("n_shingles"), "cls").join(labels, "cls", "left")
    return joined.select("doc_id", "n_shingles", "cls", "root", F.when(
        F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _kept():
    """Whether a row stands for its group."""
    return F.col("doc_id").eqNullSafe(F.col("component_id"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and group, on shingles of four words."""
    found = groups(table(spark, sf_dir, "documents"), Scratch(spark, "minhash"), words=4)
    return found.select("doc_id", "n_shingles", "component_id", _kept().alias("kept"))


def _with_class(size: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            keys = [class_key(s) if len(s) else None for s in _sets(b, "text", size)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())],
                                             names=[*b.schema.names, name])

    return run


def one_of_each(docs: DataFrame, scratch: Scratch, words: int = 5) -> DataFrame:
    """The rows of ``docs`` that stand for their group, unchanged; texts without words all stay.

    Where every id is there once, the other rows go by their ids. Repeated or null ids don't name a row,
    so rows then go by the class of their text, and one row of each group stays.
    """
    found = scratch.store(groups(docs, scratch, words), "found")
    cls, root, ident = (fresh(docs, f"_minhash_{n}") for n in ("cls", "root", "id"))
    if found.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1").isEmpty():
        goes = scratch.store(found.filter(~_kept()).select(F.col("doc_id").alias(ident)), "goes")
        return docs.join(_sent(goes), F.col("doc_id") == F.col(ident), "left_anti")
    named = docs.mapInArrow(_with_class(words, cls), T.StructType([*docs.schema.fields]).add(cls, "binary"))
    group = found.filter("n_shingles > 0").select(F.col("cls").alias(cls), F.col("root").alias(root), F.col("component_id").alias(ident)).distinct()
    rows = named.join(scratch.store(group, "named"), cls, "left")
    empty = rows.filter(F.col(cls).isNull())
    first = rows.filter(F.col(cls).isNotNull() & F.col("doc_id").eqNullSafe(F.col(ident))).dropDuplicates([root])
    return empty.unionAll(first).select(*docs.columns)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, on shingles of five words."""
    return one_of_each(docs, Scratch(spark, "minhash-stage"))
