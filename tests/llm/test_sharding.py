import random
import zlib

import pytest
from helpers import SF, duck

from starflow.llm import sharding
from starflow.llm.common import Scratch


def least_capacity(sizes, shards):
    def fits(capacity):
        used, held = 1, 0
        for x in sizes:
            if held + x > capacity:
                used, held = used + 1, 0
            held += x
        return used <= shards
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def check(rows, got, shards):
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    first = lambda ids: (min((i for i in ids if i is not None), default=-1))
    size = {t: len(t.encode()) + 16 for t in groups}
    order = sorted(groups, key=lambda t: first(groups[t]))
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r)
    assert max(sum(r["size"] for r in v) for v in by_shard.values()) == least_capacity(
        [size[t] * len(groups[t]) for t in order], shards)
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by_shard.values())
    home = {}
    for r in got:
        assert home.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]
    crcs = sorted((i if i is not None else -1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text_crc32"]) for r in got) == crcs


def test_query(spark):
    rows = duck("SELECT doc_id, text FROM documents").fetchall()
    got = sharding.op5_sharding(spark, SF).collect()
    check(rows, got, 40)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_odd_rows_and_a_hot_group(spark):
    rows = [(i, "copy " * 40) for i in range(300)] + [(1000 + i, f"text {i} " * (i % 9)) for i in range(300)]
    rows += [(None, None), (None, "x"), (7000, ""), (7000, ""), (8000, "l" * 400_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, size int")
    check(rows, sharding.shard(df, Scratch(spark, "t"), 6).collect(), 6)
    assert sharding.shard(df.limit(0), Scratch(spark, "t"), 6).count() == 0


def test_search_against_brute_force(monkeypatch):
    def ask(until, stretches, pieces):
        out = []
        for a, b in stretches:
            parts = {}
            inside = [u for u in until if a < u <= b]
            for u in inside:
                parts.setdefault(int((u - a - 1) / (b - a) * pieces), []).append(u)
            ends = sorted({x for v in parts.values() for x in (v[0], v[-1])})
            out.append((a, ends, len(ends) == len(inside)))
        return out

    monkeypatch.setattr(sharding, "_ask", ask)
    rng = random.Random(3)
    for trial in range(150):
        monkeypatch.setattr(sharding, "FIRST_ENDS", 64 if trial % 2 else 8)
        monkeypatch.setattr(sharding, "MORE_ENDS", 16 if trial % 2 else 2)
        sizes = [rng.choice([1, 3, rng.randrange(1, 500), rng.randrange(1, 10 ** rng.randrange(1, 7))])
                 for _ in range(rng.choice([1, 2, 5, 50, 400, 1500]))]
        shards, until = rng.choice([1, 2, 7, 40]), []
        for x in sizes:
            until.append(x + (until[-1] if until else 0))
        capacity, cuts = sharding.minimax_cuts(until, until[-1], max(sizes), shards)
        parts = [b - a for a, b in zip([0, *cuts], cuts, strict=False)]
        assert capacity == least_capacity(sizes, shards) == max(parts)
        assert len(cuts) == shards and set(cuts) <= {0, *until} and min(parts) >= 0


@pytest.mark.parametrize("sizes", [[1] * 64 + [10**6], [10**6] + [1] * 64, [5] * 7])
def test_search_on_spark(spark, monkeypatch, sizes):
    monkeypatch.setattr(sharding, "FIRST_ENDS", 8)
    until = [sum(sizes[:k + 1]) for k in range(len(sizes))]
    totals = spark.createDataFrame([(u,) for u in until], "until long")
    assert sharding.minimax_cuts(totals, until[-1], max(sizes), 3)[0] == least_capacity(sizes, 3)
