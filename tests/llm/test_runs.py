from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import SF, WORD, collected, rows_of
from pyspark.sql import functions as F

from starflow.llm import runs


def brute_lyndon(s):
    """Longest Lyndon word from each place: the shortest way to a smaller suffix."""
    return [next((j - i for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s) - i) for i in range(len(s))]


def brute_runs(s, least):
    """Every maximal stretch with period q, kept where no smaller period fits the same stretch."""
    found, n = {}, len(s)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 2 * q):
                found.setdefault((i, length), q)
            i = j + 1
    return {(i, length, q) for (i, length), q in found.items()}


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_grouping_gives_the_lyndon_array(letters):
    pick = random.Random(letters)
    for _ in range(150):
        s = [pick.randrange(letters) for _ in range(pick.randrange(1, 40))]
        got = {}
        for start, size, count in runs.lyndon_chains(s):
            for k in range(count):
                assert got.setdefault(start + k * size, size) == size
        assert [got[i] for i in range(len(s))] == brute_lyndon(s)


def test_runs_equal_brute_force():
    pick = random.Random(7)
    for least in (2, 5, 12):
        for k in range(200):
            s = [pick.randrange(1 + k % 4) for _ in range(pick.randrange(0, 60))]
            if k % 3 == 0:
                root = [pick.randrange(30) for _ in range(pick.randrange(1, 25))]
                s = s[:9] + root * pick.randrange(2, 5) + root[:pick.randrange(len(root) + 1)] + s[9:20]
            assert runs.runs_of(np.array(s, np.int64), least) == brute_runs(s, least), (s, least)
    fib = [0], [0, 1]
    while len(fib[1]) < 400:
        fib = fib[1], fib[1] + fib[0]
    assert runs.runs_of(np.array(fib[1], np.int64), 12) == brute_runs(fib[1], 12)


def expected(doc_id, text, plant):
    ws = WORD.findall(text or "")
    n, h = len(ws), zlib.crc32(str(doc_id).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    number = {}
    found = brute_runs([number.setdefault(w, len(number)) for w in ws], 12) if len(ws) < 1500 else None
    if found is None:
        found = runs.runs_of(np.array([number.setdefault(w, len(number)) for w in ws], np.int64), 12)  # tested above
    out = {i for s, length, q in found for i in range(s + q, s + length)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda r: (r[0], r[2])))
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(found), *top, 1000 * top[1] // top[2] if found else None, sha(listed),
            sha(" ".join(w for i, w in enumerate(ws) if i not in out)))


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    df = runs.op11_runs(spark, SF)
    got = {r["doc_id"]: tuple(r)[1:] for r in df.collect()}
    assert collected(df) == rows_of(runs.OP11_SQL)
    assert got == {d: expected(d, t, True) for d, t in texts.items()}
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_odd_rows_and_extra_columns(spark):
    period = "a  b\tc\n" * 5 + "a end"
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t ", "x"), (4, period, "x"), (4, period, "x"),
            (5, " ".join("w" * 30), "x"), (6, "w " * 50_000, "x"), (7, "one two", None),
            (8, "É 漢 😀 " * 4, "x"), (9, "x" * 300_000 + " y", "x"), (10, period.upper() + " " + period, "x")]
    df = spark.createDataFrame([(*r, "keep") for r in rows], "doc_id long, text string, n_words string, start string")
    out = runs.find_runs(df).orderBy("doc_id").collect()
    got = {r["doc_id"]: (r[runs.RESULT]["n_words"], [tuple(x) for x in r[runs.RESULT]["runs"]], r[runs.RESULT]["collapsed"]) for r in out}
    assert len(out) == len(rows) and all(r["start"] == "keep" for r in out)
    assert got[1] == got[2] == got[3] == (0, [], "")
    assert got[4] == (17, [(0, 16, 3)], "a b c end")
    assert got[5][1] == [] and got[6][1:] == ([(0, 50_000, 1)], "w") and got[7] == (2, [], "one two")
    assert got[8] == (12, [(0, 12, 3)], "É 漢 😀")
    assert got[9][1] == [] and got[10][1] == [(0, 16, 3), (17, 16, 3)]
    assert runs.find_runs(df.limit(0)).count() == 0
    assert runs.find_runs(df.filter("doc_id = 4"), min_length=17).select(F.max(F.size(f"{runs.RESULT}.runs"))).first()[0] == 0
    again = runs.find_runs(runs.find_runs(df.filter("doc_id = 4")))
    assert again.columns.count(runs.RESULT) == 1
