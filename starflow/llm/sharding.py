"""Minimax contiguous sharding of atomic groups.

Groups (documents with equal texts) stand in the order of their smallest id.
The smallest shard capacity for which the groups, cut greedily, fit the shards
is found by binary search, and the groups are cut there. Sizes stay with Spark:
the search looks at group ends only, and of those only at the ones that can
decide it. It starts from a few thousand of them; each greedy check runs with
the least and the most that unknown group ends allow, and only stretches in
which these differ are asked for in more detail.

Defined results. A null text counts as an empty one, of its own size only.
Null ids come first. Repeated rows are rows of their own in their text's group.
Empty shards appear where there are fewer groups than shards. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, running_totals, table

SHARDS = 40
ROW_BYTES = 16
#: Group ends asked for at the start, and for each stretch that is looked at again.
FIRST_ENDS = 4096
MORE_ENDS = 128


class Ends:
    """Known group ends (sums of sizes up to a group), and between which of them others may lie."""

    def __init__(self, ends: list[int], open_after: set[int]):
        self.ends, self.open_after = ends, open_after  # a stretch is named by the known end before it

    def cut(self, low: int, high: int, capacity: int) -> tuple[int, int, set[int]]:
        """Bounds of the last group end within ``capacity`` of a start in [low, high]; stretches that decide it."""
        asked = set()
        below = self.ends[bisect_right(self.ends, low + capacity) - 1]
        above = self.ends[bisect_right(self.ends, high + capacity) - 1]
        if below in self.open_after and below < low + capacity:
            asked.add(below)
        if above in self.open_after and above < high + capacity:
            asked.add(above)
            above = high + capacity
        return below, above, asked

    def check(self, capacity: int, shards: int) -> tuple[bool | None, set[int]]:
        """Whether ``shards`` of at most ``capacity`` hold everything; None where it isn't known yet."""
        low = high = 0
        asked: set[int] = set()
        for _ in range(shards):
            low, high, more = self.cut(low, high, capacity)
            asked |= more
        total = self.ends[-1]
        if low >= total:
            return True, set()
        if high < total:
            return False, set()
        return None, asked

    def add(self, found: list[tuple[int, list[int], bool]]) -> None:
        for name, ends, all_of_them in found:
            self.open_after.discard(name)
            if not all_of_them:
                self.open_after |= {name, *ends[:-1]}
            self.ends += ends
        self.ends = sorted(set(self.ends))


def _ask(totals: DataFrame, stretches: list[tuple[int, int]], pieces: int) -> list[tuple[int, list[int], bool]]:
    """The first and last group end in each of ``pieces`` equal parts of each stretch, and whether these are all.

    ``totals`` is a written table in order of ``until``, so the ranges reach its Parquet statistics.
    """
    stretches = sorted(stretches)  # apart from each other, and two for each shard at most
    after, upto = (F.array(*map(F.lit, ends)).cast("array<bigint>") for ends in zip(*stretches, strict=True))
    until = F.col("until")
    share = (until - F.col("after") - 1) / (F.col("upto") - F.col("after"))
    rows = (totals.select("until").filter((until > stretches[0][0]) & (until <= max(b for _, b in stretches)))
            .withColumn("k", F.size(F.filter(after, lambda a: a < until)) - 1)
            .select("until", F.get(after, F.col("k")).alias("after"), F.get(upto, F.col("k")).alias("upto"))
            .filter(until <= F.col("upto")).withColumn("piece", (share * pieces).cast("long"))
            .groupBy("after", "piece")
            .agg(F.array_distinct(F.array(F.min("until"), F.max("until"))).alias("ends"), F.count("*").alias("n")).collect())
    found: dict[int, tuple[list[int], int]] = {a: ([], 0) for a, _ in stretches}
    for r in rows:
        ends, n = found[r["after"]]
        found[r["after"]] = (ends + r["ends"], n + r["n"])
    return [(a, sorted(ends), n == len(ends)) for a, (ends, n) in found.items()]


def minimax_cuts(totals: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and the shards' ends as sums of sizes.

    ``totals`` holds each group's ``until``: the sum of sizes up to and including it. Among the cuts that keep
    to the capacity, each shard ends as near to its even share as it can.
    """
    ends = Ends([0], {0})
    ends.add(_ask(totals, [(0, total)], FIRST_ENDS))
    least, most = max(-(-total // shards), largest), -(-total // shards) + largest
    while least < most:
        middle = (least + most) // 2
        fits, asked = ends.check(middle, shards)
        if fits is None:
            stops = [ends.ends[bisect_right(ends.ends, a)] for a in asked]
            ends.add(_ask(totals, list(zip(asked, stops, strict=True)), MORE_ENDS))
        elif fits:
            most = middle
        else:
            least = middle + 1
    while ends.check(least, shards)[0] is None:
        _, asked = ends.check(least, shards)
        stops = [ends.ends[bisect_right(ends.ends, a)] for a in asked]
        ends.add(_ask(totals, list(zip(asked, stops, strict=True)), MORE_ENDS))
    known = ends.ends
    latest = [total]  # from the last shard back: the earliest end that leaves enough room behind it
    for _ in range(shards - 1):
        latest.append(known[bisect_left(known, latest[-1] - least)] if latest[-1] > least else 0)
    cuts, start = [], 0
    for k, earliest in zip(range(1, shards), reversed(latest[:-1] if shards == 1 else latest[1:]), strict=False):
        share = total * k // shards
        at = bisect_left(known, share)
        near = min(known[max(at - 1, 0):at + 1], key=lambda e: abs(e - share))
        last = known[bisect_right(known, start + least) - 1]
        start = min(max(near, earliest, start), last)
        cuts.append(start)
    return least, [*cuts, total]


def shard(docs: DataFrame, scratch: Scratch, shards: int = SHARDS) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with size, text_crc32, shard and slot (its place there).

    Texts are read once and never shuffled: only ids, sizes and digests move.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = scratch.store(docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                                      F.crc32(text.cast("binary")).alias("text_crc32"),
                                      F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")), "sized")
    groups = sized.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("group_size"))
    groups = scratch.store(groups, "groups")
    totals = scratch.store(
        running_totals(groups, [F.col("first_id"), F.col("digest")], "group_size", scratch, "ordered")
        .select("digest", F.col("before").alias("after"), (F.col("before") + F.col("group_size")).alias("until")),
        "totals")
    scratch.drop("groups", "ordered")
    whole = totals.agg(F.max("until").alias("total"), F.max(F.col("until") - F.col("after")).alias("largest")).first()
    cuts = minimax_cuts(totals, whole["total"], whole["largest"], shards)[1] if whole["total"] else []
    number = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda c: c < F.col("until")))
    placed = scratch.store(sized.join(totals, "digest").withColumn("shard", number)
                           .select("doc_id", "size", "text_crc32", "shard", "after"), "placed")
    ranked = running_totals(placed, [F.col("after"), F.col("doc_id")], "size", scratch, "ranked")
    firsts = placed.groupBy("shard").count().collect()  # a row per shard
    ahead, n = {}, 0
    for r in sorted(firsts, key=lambda r: r["shard"]):
        ahead[r["shard"]], n = n, n + r["count"]
    first = F.element_at(F.array(*(F.lit(ahead.get(k, 0)).cast("long") for k in range(shards))), F.col("shard") + 1)
    return ranked.select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - first).alias("slot"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes; equal texts share a shard."""
    found = shard(table(spark, sf_dir, "documents"), Scratch(spark, "sharding"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
