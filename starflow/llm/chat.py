"""Conversations from mail-style messages by quotation linking.

Quote levels are the leading ``>`` marks of lines. Neighbouring lines of a level
are a passage; lines that announce one ("On ... wrote:") go with it. The
normalised text of a passage (lower case, single spaces) is hashed, as a whole
and by paragraph, line and sentence (the latter two from three words on), and
joined to the hashes of all messages' own texts; the longest part that is found
decides, so a passage cut down to a line or rewrapped is linked too. A message
answers the message its outermost linked passage comes from. Answers are
followed to the first message of their thread by pointer jumping, and threads
come out in reply order without quotes.

A passage belongs to the earliest message of its own conversation that has it,
if that is earlier than the quoting one; else to the earliest of all messages
that have it, in order of conversation and turn, if that is earlier. So every
hash names one message per conversation and one overall, however many messages
share it, and links never form a circle.

Defined results. A null text is an empty message. Messages and passages without
words are linked to nothing. Repeated rows are messages of their own; what links
to them links to the first. Messages with a null conversation or turn keep their
texts and have no links. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, running_totals, table

_MARK = re.compile(r"(?:>[ \t]?)+")
_ANNOUNCES = re.compile(r"On .* wrote:\s*")
_SENTENCE = re.compile(r"[^.!?]+[.!?]*")
#: Lines and sentences of fewer words say too little to tell where they come from.
PART_WORDS = 3
_PARSED = ("conv_id long, turn long, role string, body string, keys array<binary>, "
           "passages array<struct<level:int,keys:array<binary>>>, row long")


def split_levels(text: str) -> list[tuple[int, str]]:
    """Each line's quote level and what stands after its marks."""
    lines = []
    for line in text.split("\n"):
        mark = _MARK.match(line)
        lines.append((mark.group().count(">"), line[mark.end():]) if mark else (0, line))
    return lines


def passages(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The message's own text, and its quoted passages with their levels, in order."""
    lines = split_levels(text)
    found: list[tuple[int, list[str]]] = []
    for k, (level, line) in enumerate(lines):
        if k + 1 < len(lines) and lines[k + 1][0] == level + 1 and _ANNOUNCES.fullmatch(line):
            continue
        if found and found[-1][0] == level:
            found[-1][1].append(line)
        else:
            found.append((level, [line]))
    own = "\n".join("\n".join(part) for level, part in found if not level).strip("\n")
    return own, [(level, "\n".join(part)) for level, part in found if level]


def keys(text: str) -> list[bytes]:
    """Hashes of a text as a whole and of its paragraphs, lines and sentences, longest first; none without words."""
    def plain(part: str) -> str:
        return " ".join(part.lower().split())

    whole = plain(text)
    small = [*map(plain, text.split("\n")), *(x.strip() for x in _SENTENCE.findall(whole))]
    parts = [whole, *map(plain, re.split(r"\n\s*\n", text)), *(p for p in small if p.count(" ") >= PART_WORDS - 1)]
    parts = sorted(filter(None, dict.fromkeys(parts)), key=len, reverse=True)
    return [hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=16).digest() for p in parts]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        bodies, own_keys, quoted = [], [], []
        for text in b.column(3).to_pylist():
            body, found = passages(text or "")
            bodies.append(body)
            own_keys.append(keys(body))
            quoted.append([{"level": level, "keys": keys(part)} for level, part in found])
        kind = pa.list_(pa.struct([("level", pa.int32()), ("keys", pa.list_(pa.binary()))]))
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:3], pa.array(bodies, pa.string()), pa.array(own_keys, pa.list_(pa.binary())),
             pa.array(quoted, kind), b.column(4)],
            names=["conv_id", "turn", "role", "body", "keys", "passages", "row"])


def link_quotes(messages: DataFrame, scratch: Scratch) -> DataFrame:
    """Each message without quotes: body, n_quotes, n_linked, max_level, reply_conv, reply_turn, and its row."""
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
                           F.col("text").cast("string"), F.monotonically_increasing_id().alias("row"))
    parsed = scratch.store(rows.mapInArrow(_parse, _PARSED), "parsed")
    known = parsed.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    originals = (known.select(F.explode("keys").alias("key"), "conv_id", "turn").groupBy("key", "conv_id")
                 .agg(F.min("turn").alias("own_turn")))
    originals = scratch.store(originals, "originals")
    # What joins read is written, so that a passage quoted very often may be split over tasks.
    first = scratch.store(originals.groupBy("key").agg(
        F.min(F.struct("conv_id", F.col("own_turn").alias("turn"))).alias("first")), "first")
    asked = (known.select("row", "conv_id", "turn", F.posexplode("passages").alias("passage", "p"))
             .select("row", "conv_id", "turn", "passage", "p.level", F.posexplode("p.keys").alias("part", "key")))
    here = F.col("own_turn") < F.col("turn")
    earlier = F.col("first") < F.struct("conv_id", "turn")
    target = F.when(here, F.struct("conv_id", F.col("own_turn").alias("turn"))).when(earlier, F.col("first"))
    links = (asked.join(originals, ["key", "conv_id"], "left").join(first, "key", "left")
             .withColumn("target", target).filter("target IS NOT NULL")
             .groupBy("row", "passage").agg(F.min(F.struct("level", "passage", "part", "target")).alias("best"))
             .groupBy("row").agg(F.min("best").alias("best"), F.count("*").alias("n_linked")))
    return (parsed.join(links, "row", "left").select(
        "row", "conv_id", "turn", "role", "body", F.size("passages").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.coalesce(F.array_max(F.col("passages.level")), F.lit(0)).cast("long").alias("max_level"),
        F.col("best.target.conv_id").alias("reply_conv"), F.col("best.target.turn").alias("reply_turn")))


def threads(linked: DataFrame, scratch: Scratch) -> DataFrame:
    """``link_quotes``' rows with thread (the first message's row), depth, and position in reply order.

    Pointer jumping: in each round every message that has not reached its first message looks up what its pointer
    points to, and adds the distances.
    """
    linked = scratch.store(linked, "linked")
    firsts = scratch.store(
        linked.filter("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min("row").alias("to"))
        .withColumnsRenamed({"conv_id": "reply_conv", "turn": "reply_turn"}), "firsts")
    answers = F.col("reply_conv").isNotNull()
    one, none = (F.lit(k).cast("long").alias("depth") for k in (1, 0))
    # Messages that answer nothing share the null key; they are not joined. Every target is a row of ``firsts``.
    pointer = scratch.store(
        linked.filter(answers).join(firsts, ["reply_conv", "reply_turn"]).select("row", "to", one, F.lit(False).alias("done"))
        .unionAll(linked.filter(~answers).select("row", F.col("row").alias("to"), none, F.lit(True).alias("done"))), "pointer0")
    scratch.drop("firsts")
    k = 0
    while not (active := pointer.filter("NOT done")).isEmpty():  # only these look further
        ahead = pointer.select(F.col("row").alias("to"), F.col("to").alias("then"), F.col("depth").alias("more"),
                               F.col("done").alias("there"))
        moved = active.join(ahead, "to").select("row", F.col("then").alias("to"), (F.col("depth") + F.col("more")).alias("depth"),
                                                F.col("there").alias("done"))
        k += 1
        pointer = scratch.store(pointer.filter("done").unionAll(moved), f"pointer{k}")
        scratch.drop(f"pointer{k - 1}")
    pointer = pointer.drop("done")
    placed = scratch.store(linked.join(pointer.withColumnRenamed("to", "thread"), "row"), "placed")
    order = [F.col(c) for c in ("thread", "depth", "conv_id", "turn", "row")]
    ranked = scratch.store(running_totals(placed.withColumn("one", F.lit(1).cast("long")), order, "one", scratch, "ranked")
                           .drop("one", "before"), "in-order")
    starts = scratch.store(ranked.groupBy("thread").agg(F.min("rank").alias("start")), "starts")
    return (ranked.join(starts, "thread").withColumn("position", F.col("rank") - F.col("start"))
            .drop("rank", "start", "row"))


def as_mail(messages: DataFrame) -> DataFrame:
    """``messages`` as mail: each quotes the message before it, and that one's own quotes, up to three levels deep.

    In every third turn the first level is cut to the first line that has PART_WORDS words (all of it, if none has).
    """
    def before(k: int) -> DataFrame:
        return messages.groupBy("conv_id", (F.col("turn") + k).alias("turn")).agg(
            F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias(f"m{k}"))

    def quoted(k: int):
        mark, lines = ">" * k, F.split(F.col(f"m{k}.text"), "\n")
        said = F.concat(F.lit(mark[:-1] + " " if k > 1 else ""), F.lit("On turn "), (F.col("turn") - k).cast("string"),
                        F.lit(", "), F.col(f"m{k}.role"), F.lit(" wrote:"))
        if k == 1:
            line = F.get(F.filter(lines, lambda x: F.size(F.split(F.trim(x), r"\s+")) >= PART_WORDS), F.lit(0))
            lines = F.when((F.col("turn") % 3 == 2) & line.isNotNull(), F.array(line)).otherwise(lines)
        return said, F.array_join(F.transform(lines, lambda x: F.concat(F.lit(mark + " "), x)), "\n")

    joined = messages
    for k in (1, 2, 3):
        joined = joined.join(before(k), ["conv_id", "turn"], "left")
    said, text = zip(*(quoted(k) for k in (1, 2, 3)), strict=True)
    return joined.withColumn("text", F.concat_ws("\n", *said, *reversed(text), "text")).drop("m1", "m2", "m3")


def op3_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations written as mail, then their threads rebuilt from the quotes alone; -1 where nothing is answered."""
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    scratch = Scratch(spark, "quotes")
    out = threads(link_quotes(as_mail(messages), scratch), scratch)
    none = F.lit(-1).cast("long")
    return out.select("conv_id", "turn", "role", "body", "n_quotes", "n_linked", "max_level",
                      F.coalesce("reply_conv", none).alias("reply_conv"), F.coalesce("reply_turn", none).alias("reply_turn"),
                      "depth", "position")


#: Over tables whose (conv_id, turn) are unique and whose texts have words and no quotes or blank lines of their own.
OP3_SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, trim(text, chr(10)) AS body, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS norm,
         list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))),
                     lambda x: len(string_split(x, ' ')) >= 3) AS lines FROM conversations
), parts AS (
  SELECT conv_id, turn, norm FROM m UNION ALL SELECT conv_id, turn, unnest(lines) FROM m UNION ALL
  SELECT conv_id, turn, s FROM (SELECT conv_id, turn, unnest(list_transform(regexp_extract_all(norm, '[^.!?]+[.!?]*'), lambda x: trim(x))) AS s FROM m)
  WHERE len(string_split(s, ' ')) >= 3
), own AS (SELECT conv_id, norm, min(turn) AS turn FROM parts GROUP BY ALL
), firsts AS (SELECT norm, min((conv_id, turn)) AS first FROM own GROUP BY norm
), q AS (
  SELECT a.conv_id, a.turn, k AS level, coalesce(
      CASE WHEN o.turn < a.turn THEN (a.conv_id, o.turn) END, CASE WHEN f.first < (a.conv_id, a.turn) THEN f.first END) AS target
  FROM (SELECT a.conv_id, a.turn, k, CASE WHEN k = 1 AND a.turn % 3 = 2 AND len(b.lines) > 0 THEN b.lines[1] ELSE b.norm END AS norm
        FROM m a JOIN (SELECT unnest([1, 2, 3]) AS k) ON true JOIN m b ON b.conv_id = a.conv_id AND b.turn = a.turn - k) a
  LEFT JOIN own o ON o.conv_id = a.conv_id AND o.norm = a.norm LEFT JOIN firsts f ON f.norm = a.norm
), l AS (
  SELECT conv_id, turn, count(*) AS n_quotes, count(target) AS n_linked, max(level) AS max_level,
         arg_min(target, level) FILTER (target IS NOT NULL) AS target FROM q GROUP BY conv_id, turn
), linked AS (
  SELECT m.*, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, coalesce(max_level, 0) AS max_level,
         target[1] AS reply_conv, target[2] AS reply_turn FROM m LEFT JOIN l USING (conv_id, turn)
), t AS (
  SELECT conv_id, turn, conv_id AS root_conv, turn AS root_turn, CAST(0 AS BIGINT) AS depth FROM linked WHERE reply_conv IS NULL
  UNION ALL
  SELECT c.conv_id, c.turn, t.root_conv, t.root_turn, t.depth + 1 FROM linked c JOIN t ON c.reply_conv = t.conv_id AND c.reply_turn = t.turn
)
SELECT conv_id, turn, role, body, n_quotes, n_linked, CAST(max_level AS BIGINT) AS max_level,
       coalesce(reply_conv, -1) AS reply_conv, coalesce(reply_turn, -1) AS reply_turn, depth,
       row_number() OVER (PARTITION BY root_conv, root_turn ORDER BY depth, conv_id, turn) - 1 AS position
FROM linked JOIN t USING (conv_id, turn)
"""
