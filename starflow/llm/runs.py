"""Runs of words: every maximal stretch of a text that repeats itself with a smallest period.

Method, per text. (1) Baier grouping, the first phase of his suffix sorter, run under an order of the
words and under its reverse: groups of positions with the same longest Lyndon word, highest first, each
of which lengthens the words just before it. When a group's turn comes, the length of its word is the
entry of the Lyndon array for all its positions, and equal words side by side are already known. (2) Each
Lyndon word, or chain of equal ones, is extended to both sides by longest common extension; what reaches
twice its period is a run, and every run holds such a word under one of the two orders.

A run of at least ``min_length`` words and two periods repeats each of its windows of ``min_length // 2``
words, so only words inside windows that the text holds twice can lie in one: the grouping works on the
stretches of such words, which by this hold every run whole, with all their words. Windows are compared by
a 64-bit sum, which can let a needless stretch in but leave none out; runs themselves are found on exact
words.

Spark deals the texts out and nothing is shuffled; a text is one task's work, in time in proportion to its
words but for the extensions, and in memory about 100 bytes a word, 300 inside repeated stretches.

Defined results. A null, empty or blank text has no runs, and its collapsed text is empty. Repeated rows
are texts of their own, words may be of any length, an empty table gives an empty result. Other columns go
through unchanged; the operator's own are in one struct (``RESULT``), so that names don't clash; a column
of that very name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.llm.common import ship, small, table
from starflow.llm.crc import CRC_SQL, bytes_sql, crc_sql
from starflow.llm.words import mix

#: Fixed by the data contract: words, and the least length of a run.
WORD = r"[^\x20\x09-\x0D]+"
MIN_LENGTH = 12
RESULT = "_runs"
_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)),
                       T.StructField("collapsed", T.StringType())])
#: So many words of an extension are compared for all candidates at once, the rest slice by slice.
_STEPS = 8


def lyndon_chains(ranks: list[int]) -> list[tuple[int, int, int]]:
    """(start, word length, number) of every chain of equal longest Lyndon words side by side, by Baier grouping.

    ``left`` and ``right`` link the positions whose group's turn is still to come. A position's word ends
    where the next such position begins. So when the highest group leaves, each chain of its members is
    appended to the word of the position before it; positions of one group that gained equally many words
    form a new group above the rest of theirs, the higher the more words they gained.
    """
    n = len(ranks)
    number = {v: k for k, v in enumerate(sorted(set(ranks)))}
    group = [number[r] for r in ranks] + [-1]     # the end of the text is in no group
    top = len(number)
    members: list[list[int]] = [[] for _ in range(top)]
    for i in range(n):
        members[group[i]].append(i)
    size, lower, upper = [1] * top, list(range(-1, top - 1)), list(range(1, top + 1))
    left, right = list(range(-1, n)), list(range(1, n + 2))
    found, now = [], top - 1
    while now >= 0:
        gained: dict[tuple[int, int], list[int]] = {}
        length = size[now]
        for first in members[now]:
            if group[first] != now:               # it has moved to a higher group
                continue
            before = left[first]
            if before >= 0 and group[before] == now:
                continue                          # counted with the first of its chain
            after, count = right[first], 1
            while group[after] == now:
                after, count = right[after], count + 1
            found.append((first, length, count))
            left[after] = before
            if before >= 0:
                right[before] = after
                gained.setdefault((group[before], count), []).append(before)
        highest: dict[int, int] = {}
        for old, count in sorted(gained):
            below, new = highest.get(old, old), len(members)
            moved = gained[old, count]
            members.append(moved)
            size.append(size[old] + count * length)
            lower.append(below)
            upper.append(upper[below])
            lower[upper[below]], upper[below], highest[old] = new, new, new
            for i in moved:
                group[i] = new
        now = lower[now]
    return found


def _extension(words: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How far the words at ``a`` and ``b`` (a < b) agree, going right (step 1) or left (-1)."""
    n, same = len(words), np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for k in range(_STEPS):
        x, y = a[live] + step * k, b[live] + step * k
        inside = (x >= 0) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        live = live[words[x] == words[y]]
        same[live] += 1
    for i in live:
        x, y, width = int(a[i]) + step * _STEPS, int(b[i]) + step * _STEPS, 64
        while x >= 0 and y < n:
            if step > 0:
                w = min(width, n - y)
                differ = words[x:x + w] != words[y:y + w]
            else:
                w = min(width, x + 1)
                differ = (words[x - w + 1:x + 1] != words[y - w + 1:y + 1])[::-1]
            at = int(differ.argmax())
            if differ[at]:
                same[i] += at
                break
            same[i], x, y, width = same[i] + w, x + step * w, y + step * w, 2 * width
    return same


def runs_of(words: np.ndarray, min_length: int = MIN_LENGTH) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of word numbers."""
    found: set[tuple[int, int, int]] = set()
    ranks = words.tolist()
    for order in (ranks, [-r for r in ranks]):
        start, period, count = np.array(lyndon_chains(order), np.int64).reshape(-1, 3).T
        end = start + period * count
        more = _extension(words, end - period, end, 1)
        less = _extension(words, start - 1, start - 1 + period, -1)
        length = less + period * count + more
        run = (length >= 2 * period) & (length >= min_length)
        found.update(zip((start - less)[run].tolist(), length[run].tolist(), period[run].tolist()))
    return found


def _stretches(words: np.ndarray, text: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Bounds of the stretches covered by windows of ``size`` words that their text holds twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return
    spread = mix(words.astype(np.uint64) + np.uint64(1))
    key = mix(text[:n].astype(np.uint64))
    for k in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + spread[k:k + n]
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = (times[which] > 1) & (text[:n] == text[size - 1:])
    sums = np.concatenate([[0], np.cumsum(twice), np.full(size, int(twice.sum()))])
    at = np.arange(len(words))
    covered = sums[at + 1] > sums[np.maximum(at - size + 1, 0)]
    label = np.where(covered, text, -1)
    edges = np.concatenate([[0], np.flatnonzero(label[1:] != label[:-1]) + 1, [len(label)]])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if covered[a]:
            yield a, b


def _of_texts(texts: list[bytes | None], min_length: int) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """For each text its number of words, its runs by start and period, and the text without their repetitions."""
    numbers: dict[bytes, int] = {}
    split = [(t or b"").split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    words = np.array([numbers.setdefault(w, len(numbers)) for ws in split for w in ws], np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for a, b in _stretches(words, text, min_length // 2):
        k = int(text[a])
        found.setdefault(k, []).extend((a + s - int(begin[k]), n, q) for s, n, q in runs_of(words[a:b], min_length))
    for k, ws in enumerate(split):
        runs = sorted(found.get(k, ()), key=lambda r: (r[0], r[2]))
        if runs:
            edge = np.zeros(len(ws) + 1, np.int64)
            for s, n, q in runs:
                edge[s + q] += 1
                edge[s + n] -= 1
            ws = [w for w, over in zip(ws, np.cumsum(edge[:-1]).tolist()) if not over]
        yield int(sizes[k]), runs, b" ".join(ws)


def find_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with the struct ``RESULT``: n_words, runs (by start, then period) and the collapsed text.

    A run is a stretch of at least ``min_length`` (2 or more) words and two of its smallest periods that no
    neighbouring word extends. The collapsed text is the words, joined by single spaces, but for those that a
    run holds after its first period.
    """
    if min_length < 2:
        raise ValueError("min_length must be 2 or more")
    ship(docs.sparkSession)
    docs = docs.drop(RESULT)
    schema = T.StructType(docs.schema.fields + [T.StructField(RESULT, _FOUND)])
    run_type = pa.struct([(f.name, pa.int64()) for f in _RUN])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts = b.column(b.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            n, runs, collapsed = zip(*_of_texts(texts, min_length)) if texts else ((), (), ())
            flat = [r for of_text in runs for r in of_text]
            parts = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
            ends = np.concatenate([[0], np.cumsum([len(r) for r in runs], dtype=np.int64)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, fields=list(run_type)))
            made = pa.StructArray.from_arrays([pa.array(n, pa.int64()), lists, pa.array(collapsed, pa.binary()).cast(pa.string())],
                                              names=["n_words", "runs", "collapsed"])
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, RESULT])

    return docs.mapInArrow(work, schema)


def _planted(doc_id: Column, text: Column) -> Column:
    """The query's own texts: in a tenth of them, by id, a period takes the place of the rest of the words."""
    h = F.crc32(doc_id.cast("string"))
    g, words = F.floor(h / 10), F.regexp_extract_all(text, F.lit(WORD), 0)
    n = F.size(words).cast("long")
    a = F.when(n > 0, g % n).otherwise(0)
    p = 1 + F.floor((n - a) / (3 + g % 8))
    again = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    made = F.concat(F.slice(words, 1, a.cast("int")), F.slice(again, 1, (n - a).cast("int")))
    return F.when(h % 10 == 0, F.array_join(made, " ")).otherwise(text)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs and collapsed text, as digests; the longest run in full."""
    docs = table(spark, sf_dir, "documents").select("doc_id", _planted(F.col("doc_id"), F.col("text")).alias("text"))
    runs = F.col(f"{RESULT}.runs")
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    top = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    listed = F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
    return find_runs(docs).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), top.alias("_top"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col(f"{RESULT}.collapsed"), 256).alias("collapsed_sha256")
    ).select("doc_id", "n_runs", (-F.col("_top.s")).alias("start"), F.col("_top.n").alias("length"),
             (-F.col("_top.q")).alias("period"), F.expr("1000 * _top.n div -_top.q").alias("exponent_milli"),
             "runs_sha256", "collapsed_sha256")


#: Every pair of equal windows of half the least length, joined into stretches by distance: what the runs are by definition.
_HALF = MIN_LENGTH // 2
OP11_SQL = f"""
WITH {CRC_SQL},
  base AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
                  {crc_sql(bytes_sql("CAST(doc_id AS VARCHAR)"))} AS h FROM documents, bits),
  sized AS (SELECT *, len(ws) AS n, h // 10 AS g, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) ELSE 0 END AS a FROM base),
  texts AS (SELECT r, doc_id, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i:
                   CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE ws END AS ws FROM sized),
  words AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM texts),
  grams AS (SELECT r, i, {" || ' ' || ".join(["word"] + [f"lead(word, {k}) OVER w" for k in range(1, _HALF)])} AS gram
            FROM words WINDOW w AS (PARTITION BY r ORDER BY i)),
  pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram AND x.i < y.i),
  parts AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS part FROM pairs),
  found AS (SELECT r, q, min(i) AS start, max(i) - min(i) + {_HALF} + q AS length FROM parts GROUP BY r, q, part
            HAVING max(i) - min(i) + {_HALF} + q >= greatest({MIN_LENGTH}, 2 * q)),
  runs AS (SELECT r, start, length, min(q) AS period FROM found GROUP BY r, start, length),
  again AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
  kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN again USING (r, i) GROUP BY r),
  listed AS (SELECT r, count(*) AS n_runs, first({{'s': start, 'n': length, 'q': period}} ORDER BY length DESC, start, period) AS top,
                    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
             FROM runs GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.n AS length, top.q AS period,
       1000 * top.n // top.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""
