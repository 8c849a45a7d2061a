import random

import numpy as np
from helpers import SF, duck, near_groups, shingle_set
from pyspark.sql import functions as F

from starflow.llm import minhash
from starflow.llm.common import Scratch
from starflow.llm.components import _large_star, _small_star, components


def expected(rows, size):
    group = near_groups(rows, size)
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = i if g not in least else min(least[g], i)
    return sorted((i, len(shingle_set(t, size)), least[g]) for (i, t), g in zip(rows, group, strict=True))


def test_query_on_all_documents(spark):
    rows = duck("SELECT doc_id, text FROM documents").fetchall()
    got = minhash.op6_minhash(spark, SF).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == expected(rows, 4)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def family(rng, n, length, changes):
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        yield " ".join(own)


def test_large_families_chains_and_blocks(spark, monkeypatch):
    rng = random.Random(5)
    texts = [*family(rng, 60, 120, 9), *family(rng, 40, 40, 3)]
    chain = [f"c{k}" for k in range(120)]
    texts += [" ".join(chain[3 * k:3 * k + 90]) for k in range(10)]  # neighbours are alike, the ends are not
    texts += [None, "", " \n", "one", "ONE", "one two", "one two three", "l" * 100_000, "A b C d", "a B c D"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, b"x") for r in rows], "doc_id long, text string, cls binary").repartition(5)
    for shingles in (minhash.BLOCK_SHINGLES, 900):
        monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
        got = minhash.groups(df, Scratch(spark, "t"), 4).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == expected(rows, 4)
    monkeypatch.setattr(minhash, "MAX_SENT_IDS", 0)  # the way without a broadcast
    got = minhash.groups(df, Scratch(spark, "t"), 4).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == expected(rows, 4)


def test_stage_keeps_one_of_each_group(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    rows = [(1, a, "u"), (2, a, "v"), (3, b, "w"), (4, None, "n"), (5, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, root string")
    assert sorted(r["doc_id"] for r in minhash.stage(spark, df, SF).collect()) == [1, 3, 4, 5]
    odd = spark.createDataFrame([*rows, rows[0], (3, a, "w2"), (None, b, "x"), (None, "p q r s t u", "y"), (None, "p q r s t u", "z")],
                                df.schema)
    out = minhash.stage(spark, odd, SF)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in out.collect())
    assert out.columns == df.columns and got == sorted([(-1, "p q r s t u"), (1, a), (3, b), (4, ""), (5, "")])
    assert minhash.stage(spark, df.limit(0), SF).count() == 0
    assert minhash.groups(df.limit(0), Scratch(spark, "t")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 90)] + [(5000, 5000)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["root"] for r in components(df, Scratch(spark, "t"), "c").collect()}
    assert got == {k: 0 for k in range(61)} | {1000 + k: 1000 for k in range(90)}


def test_a_node_with_many_neighbours_is_split(spark):
    """With the sizes that count as skewed set low, both joins are split."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "40",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB"}
    before = {k: spark.conf.get(k, None) for k in conf}
    scratch = Scratch(spark, "t")
    def star(centre):
        return scratch.store(spark.range(1, 40_000, 1, 16).select(
            F.when(F.col("id") % 3 > 0, centre).otherwise(F.col("id") * 100_000 + 7).alias("u"), F.col("id").alias("v")), f"star{centre}")

    # The steps' joins are on nodes with larger and with smaller neighbours.
    stars = [(_large_star, star(0)), (_small_star, star(50_000))]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for step, edges in stars:
            out = step(edges, scratch, step.__name__)
            assert len(out.collect()) == 39_999
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_null_and_repeated_ids(spark):
    """Ids that name no single text: groups are still those of the texts, and no join by id is a product."""
    rng = random.Random(9)
    near = list(family(rng, 30, 60, 2))
    rows = [(None, t) for t in near[:20]] + [(7, t) for t in near[20:]] + [(8, "a b c d e")] * 50
    rows += [(7, "p q r s t u v w"), (9, "p q r s t u v w"), (None, None), (10, near[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = minhash.groups(df, Scratch(spark, "t"), 4).collect()
    group = near_groups(rows, 4)
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min((x for x in (i, least.get(g)) if x is not None), default=None)
    want = [(i, len(shingle_set(t, 4)), least[g] if t else i) for (i, t), g in zip(rows, group, strict=True)]
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got)


def test_signature_share_estimates_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 3000, np.uint64)
    a, b = minhash.signature(x[:2700]), minhash.signature(x[300:])
    assert abs((a == b).mean() - 0.8) < 0.15


def test_stage_with_clashing_names(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text, "a", "b", "c"), (2, text, "a", "b", "c"), (3, "other words", "a", "b", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _minhash_id string, _minhash_cls string, _minhash_root string")
    for docs, ids in ((df, [1, 3]), (df.unionAll(df), [1, 3])):
        out = minhash.stage(spark, docs, "")
        assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == ids
        assert all(r["_minhash_id"] == "a" for r in out.collect())
