"""WARC archives: writing, and reading by boundary-chain verification.

A record starts with a magic line, but a payload may hold the same bytes, so a
match alone proves nothing. The reader lets Spark cut the archives at every
magic line (split by split), each task turns its candidates into
record-to-successor links (from Content-Length) and shortens them to the place
where the chain leaves the split. Pointer jumping over those few links, from
each file's start, finds where the true chain enters each split; a last pass
follows it there. Candidates that the chain does not reach are payload bytes
and go back to the record they belong to.

Defined results. A null payload is written as an empty one. A null url writes
no target header; control characters in urls are percent-encoded. Rows with
the same id and payload are records of their own and share a type. A row with
a null id among equal payloads revisits the largest id; if all ids there are
null, all are responses. An empty table gives an archive without records and
an empty result. Other columns are not read. A file that does not begin with
the magic line has no record.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, table

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_M = len(MAGIC)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a column, from the hex digits 15, 15 and 10 at a time."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, n), 16, 32), n * 4 // 5, "0")
             for at, n in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, scratch: Scratch, min_bytes: int = 0) -> DataFrame:
    """id, url and payload of ``pages``, with payload_bytes, digest and, for revisits, refers_to (the largest equal id).

    Other columns, of whatever name, have no place in a record and are left out.

    Equal payloads are counted before any join, and only ids that revisit another are joined back.
    """
    pages = pages.select("id", "url", F.coalesce("payload", F.lit("")).alias("payload"))
    sized = pages.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                               "digest": base32_sha1(F.col("payload").cast("binary"))})
    ids = scratch.store(sized.filter(F.col("payload_bytes") >= min_bytes).select("id", "digest"), "digests")
    shared = (ids.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("n"))
              .filter((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n"))
    revisits = scratch.store(
        ids.join(shared, "digest").filter(F.col("id").isNull() | (F.col("id") < F.col("refers_to")))
        .distinct().withColumnsRenamed({"id": "r_id", "digest": "r_digest"}), "revisits")
    scratch.drop("digests")
    return sized.join(revisits, sized["id"].eqNullSafe(revisits["r_id"]) & (sized["digest"] == revisits["r_digest"]),
                      "left").drop("r_id", "r_digest")


def write_warc(records: DataFrame, path: str) -> None:
    """One record per row of ``with_revisits``; a revisit has headers only, as its payload is at its response."""
    revisit = F.col("refers_to").isNotNull()
    ident = F.coalesce(F.col("id").cast("string"), F.lit(""))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    header = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), ident, F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), uri, F.lit("\r\n")), F.lit("")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"),
                                 F.col("refers_to").cast("string"), F.lit(">\r\nX-Payload-Length: "),
                                 F.col("payload_bytes").cast("string"), F.lit("\r\n"))).otherwise(""),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, "0").otherwise(F.col("payload_bytes").cast("string")), F.lit(END))
    record = F.concat(header, F.when(revisit, "").otherwise(F.col("payload")))
    # The line separator is the two line ends that close a record.
    records.select(record.alias("value")).write.option("lineSep", END).text(path)


_LINKS = ("file string, block long, seg long, at long, next long, leave long, total long, kind string, id string, "
          "uri string, refers_to string, payload_bytes long, digest string")


def _headers(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields


def _urn(value: str | None) -> str | None:
    return value[10:-1] if value and value.startswith("<urn:page:") else value


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _candidate(value: bytes) -> dict | None:
    """What a piece after a magic line says, with ``size`` from there to where the next such piece must start."""
    cut = value.find(END.encode())
    if cut < 0:
        return None
    fields = _headers(value[:cut])
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or "warc-type" not in fields:
        return None
    first, n = cut + len(END), int(length)
    whole = len(value) >= first + n
    full = fields.get("x-payload-length", "")
    return {"size": first + n + len(END) + _M, "kind": fields["warc-type"], "id": _urn(fields.get("warc-record-id")),
            "uri": fields.get("warc-target-uri"), "refers_to": _urn(fields.get("warc-refers-to")),
            "payload_bytes": int(full) if full.isdigit() else n,
            "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") if fields["warc-type"] == "revisit"
            else _digest(value[first:first + n]) if whole else None}


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each split's candidates, placed from the split's first piece, with ``leave`` where their chain leaves it.

    Holds the headers of one split, never its payloads. A row without ``at`` gives a split's length.
    """
    names = [f.split()[0] for f in _LINKS.split(", ")]
    types = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in _LINKS.split(", ")])

    def close(key, rows: list[dict], total: int) -> pa.RecordBatch:
        leave: dict[int, int] = {}
        for r in reversed(rows):
            leave[r["at"]] = r["leave"] = leave.get(r["next"], r["next"])
        rows = [*rows, {"total": total}]
        return pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} | {"file": key[0], "block": key[1]}
                                           for r in rows], schema=schema)

    key, rows, at = None, [], 0
    for b in batches:
        for file, block, seg, value in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (file, block) != key:
                if key is not None:
                    yield close(key, rows, at)
                key, rows, at = (file, block), [], 0
            if (block or at) and (found := _candidate(value)):
                rows.append(found | {"at": at, "next": at + found["size"], "seg": seg})
            elif block or at:
                rows.append({"at": at, "next": -1, "seg": seg})  # a magic line without a record
            at += len(value) + _M
    if key is not None:
        yield close(key, rows, at)


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of splits with their places from the split's first piece; a row without ``at`` gives a split's length."""
    def row(key, at, total, value) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"file": key[0], "block": key[1], "at": at, "total": total, "value": value}], schema=schema)

    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("total", pa.int64()), ("value", pa.binary())])
    key, at = None, 0
    for b in batches:
        for file, block, value in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (file, block) != key:
                if key is not None:
                    yield row(key, None, at, None)
                key, at = (file, block), 0
            yield row(key, at, None, value)
            at += len(value) + _M
    if key is not None:
        yield row(key, None, at, None)


def _based(totals: DataFrame) -> DataFrame:
    """file, block, and the length of all the file's splits before it."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """Follow the chain from where it enters a split; ``true`` marks its records."""
    pdf = pdf.sort_values("at")
    following = dict(zip(pdf["at"], pdf["next"], strict=True))
    entry, reached = pdf["entry"].iloc[0], set()
    while entry in following and entry not in reached:
        reached.add(entry)
        entry = following[entry]
    pdf["true"] = pdf["at"].isin(reached)
    return pdf.drop(columns=["entry", "leave"])


def _assemble(pdf: pd.DataFrame) -> pd.DataFrame:
    """One record from its pieces, which must follow one another without a gap."""
    pdf = pdf.sort_values("at")
    value = MAGIC.encode().join(bytes(v) for v in pdf["value"])
    if len(value) + _M != int(pdf["until"].iloc[0] - pdf["owner"].iloc[0]):
        raise RuntimeError(f"{pdf['file'].iloc[0]} was read in other splits while its records were put together; read it again")
    first = value.find(END.encode()) + len(END)
    payload = value[first:first + int(pdf["length"].iloc[0])]
    return pd.DataFrame({"file": pdf["file"].iloc[:1], "owner": pdf["owner"].iloc[:1], "payload": [payload],
                         "p_digest": [_digest(payload)]})


def read_warc(spark: SparkSession, path: str, scratch: Scratch, payload: bool = False) -> DataFrame:
    """True records of all archives under ``path``: file, offset, kind, id, uri, refers_to, payload_bytes, digest.

    The digest of a response is computed from the payload that was read. ``payload=True`` adds the payload.
    """
    seg = (spark.read.option("lineSep", MAGIC).text(path)
           .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("seg"), F.col("value").cast("binary").alias("value")))
    links = scratch.store(seg.mapInArrow(_links, _LINKS), "links")
    blocks = scratch.store(_based(links.filter(F.col("at").isNull())), "blocks")  # a row per split
    placed = (links.filter(F.col("at").isNotNull()).drop("total").join(blocks, ["file", "block"])
              .withColumns({c: F.when(F.col(c) >= 0, F.col(c) + F.col("base")) for c in ("at", "next", "leave")})
              .drop("base"))
    reached = _entries(blocks, placed, scratch)
    entries = (placed.select("file", "block", "at").join(reached, ["file", "at"])
               .withColumnRenamed("at", "entry"))
    joined = placed.join(entries, ["file", "block"], "left").withColumn("entry", F.coalesce("entry", F.lit(-1)))
    joined = joined.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("next", "leave")})
    walked = scratch.store(joined.groupBy("file", "block").applyInPandas(
        _walk, "file string, block long, seg long, at long, next long, kind string, id string, uri string, "
               "refers_to string, payload_bytes long, digest string, `true` boolean"), "walked")
    scratch.drop("links")
    records = walked.filter("`true`").withColumn("offset", F.col("at") - _M)
    keep = ["file", "offset", "kind", "id", "uri", "refers_to", "payload_bytes", "digest"]
    cut = F.col("digest").isNull() | F.lit(payload)
    # Pieces of records whose payload holds a magic line; only those (all records, to return payloads) are read again.
    last = Window.partitionBy("file").orderBy("at")
    parts = scratch.store(
        walked.filter(~F.col("true") | cut)
        .withColumns({"owner": F.last(F.when(F.col("true"), F.col("at")), True).over(last),
                      "length": F.last(F.when(F.col("true"), F.col("payload_bytes")), True).over(last),
                      "until": F.last(F.when(F.col("true"), F.col("next")), True).over(last)})
        .filter(F.col("at") < F.col("until")).select("file", "at", "owner", "length", "until"), "parts")
    if not payload and parts.isEmpty():
        return records.select(*keep)
    # Pieces go by file and byte: the second reading may be in other splits than the first.
    pieces = seg.select("file", "block", "value").mapInArrow(_offsets, "file string, block long, at long, total long, value binary")
    based = _based(pieces.filter(F.col("at").isNull()))
    pieces = pieces.filter(F.col("at").isNotNull()).join(based, ["file", "block"]).select("file", (F.col("at") + F.col("base")).alias("at"), "value")
    again = (pieces.join(parts, ["file", "at"]).select("file", "owner", "at", "length", "until", "value")
             .groupBy("file", "owner").applyInPandas(_assemble, "file string, owner long, payload binary, "
                                                                "p_digest string"))
    whole = (records.join(again, (records["file"] == again["file"]) & (records["at"] == again["owner"]), "left")
             .drop(again["file"]).withColumn("digest", F.coalesce("digest", "p_digest")))
    return whole.select(*keep, *["payload"] * payload)


def _entries(blocks: DataFrame, placed: DataFrame, scratch: Scratch) -> DataFrame:
    """Where the chain from each file's start enters its splits, by pointer jumping: links double in each round."""
    most = blocks.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    start = blocks.filter("block = 0").select("file", F.lit(_M).cast("long").alias("at"))
    ends = placed.select("file", F.col("leave").alias("at")).filter("at is not null").union(start).distinct()
    jump = scratch.store(placed.select("file", "at", "leave").join(ends, ["file", "at"], "left_semi"), "jump0")
    reached = start
    for k in range(math.ceil(math.log2(most)) if most > 1 else 0):
        ahead = reached.join(jump, ["file", "at"]).select("file", F.col("leave").alias("at"))
        reached = scratch.store(reached.union(ahead).distinct(), f"reached{k}")
        then = jump.select("file", F.col("at").alias("leave"), F.col("leave").alias("later"))
        jump = scratch.store(jump.join(then, ["file", "leave"]).select("file", "at", F.col("later").alias("leave")),
                             f"jump{k + 1}")
    return reached


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as archives with revisits for equal payloads, read back by boundary-chain verification."""
    scratch = Scratch(spark, "warc")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", F.col("html").alias("payload"))
    write_warc(with_revisits(pages, scratch), scratch.path("archive"))
    found = read_warc(spark, scratch.path("archive"), scratch)
    return found.select(F.col("id").try_cast("long").alias("page_id"), "payload_bytes",
                        F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"),
                        F.col("refers_to").try_cast("long").alias("refers_to"))


OP1_SQL = """
WITH sized AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform(range(4),
    lambda c: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(hex, CAST(5 * g + 1 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * c)) & 31) AS INTEGER), 1)), '')), '')
    AS payload_digest FROM sized
), tops AS (SELECT payload_digest, max(page_id) AS top FROM coded GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM coded JOIN tops USING (payload_digest)
"""
