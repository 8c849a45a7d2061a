import base64
import hashlib

import pytest
from helpers import SF, collected, rows_of

from starflow.llm import warc
from starflow.llm.common import Scratch

INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
OPEN = "WARC/1.1\r\nWARC-Type: a\r\nContent-Length: 99999\r\n\r\n"
PAGES = [(i, f"http://h/{i}\r\nx", "x" * (i * 7 % 300) + INNER * (i % 4) + "y" * (i * 13 % 50)
          + ("WARC/1.1\r\n" if i % 5 == 0 else "") + (OPEN if i % 7 == 0 else "") if i % 11 else None) for i in range(120)]
PAGES += [(None, None, None), (5, None, "dup"), (5, None, "dup"), (9, "u", "dup"), (None, "u", "only null ids"),
          (200, "u", "ü" * 300_000)]


def expected(rows):
    top = {}
    for i, _, p in rows:
        top[p or ""] = max(top.get(p or "", -1), -1 if i is None else i)
    out = []
    for i, _, p in rows:
        raw, best = (p or "").encode(), top[p or ""]
        kind = "response" if best == -1 or i == best else "revisit"
        out.append((base64.b32encode(hashlib.sha1(raw).digest()).decode(), "" if i is None else str(i), kind, len(raw),
                    None if kind == "response" else str(best)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", ["128m", "1k", "333"])
def test_only_reachable_records_are_read(spark, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    scratch = Scratch(spark, "t")
    df = spark.createDataFrame(PAGES, "id long, url string, payload string").repartition(3)
    warc.write_warc(warc.with_revisits(df, scratch), scratch.path("a"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split if split != "333" else "4k")
    try:
        got = warc.read_warc(spark, scratch.path("a"), scratch).select("digest", "id", "kind", "payload_bytes", "refers_to")
        assert collected(got) == expected(PAGES)
        full = warc.read_warc(spark, scratch.path("a"), Scratch(spark, "t"), payload=True)
        found = {r["id"]: bytes(r["payload"]).decode() for r in full.collect() if r["kind"] == "response"}
        assert all(found[str(i)] == (p or "") for i, _, p in PAGES if str(i) in found and i not in (5, 9))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_empty_table(spark):
    scratch = Scratch(spark, "t")
    df = spark.createDataFrame([], "id long, url string, payload string")
    warc.write_warc(warc.with_revisits(df, scratch), scratch.path("a"))
    assert warc.read_warc(spark, scratch.path("a"), scratch).count() == 0


def test_query_matches_sql(spark):
    assert collected(warc.op1_warc(spark, SF)) == rows_of(warc.OP1_SQL)


class _OtherSplits(Scratch):
    """Changes the size of splits after the first reading."""

    def store(self, df, name):
        out = super().store(df, name)
        if name == "parts":
            self.spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        return out


def test_second_reading_in_other_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    scratch = _OtherSplits(spark, "t")
    df = spark.createDataFrame(PAGES, "id long, url string, payload string").repartition(2)
    warc.write_warc(warc.with_revisits(df, Scratch(spark, "t")), scratch.path("a"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
    try:
        got = warc.read_warc(spark, scratch.path("a"), scratch).select("digest", "id", "kind", "payload_bytes", "refers_to").collect()
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "700"
        assert sorted((tuple(r) for r in got), key=repr) == expected(PAGES)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_clashing_columns_have_no_place_in_a_record(spark):
    df = spark.createDataFrame([(1, "u", "p", "x", "y", "z")], "id long, url string, payload string, digest string, refers_to string, r_id string")
    out = warc.with_revisits(df, Scratch(spark, "t"))
    assert sorted(out.columns) == ["digest", "id", "payload", "payload_bytes", "refers_to", "url"] and out.first()["refers_to"] is None
