from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
from helpers import SF, collected, rows_of

from starflow.llm import spelling
from starflow.llm.common import Scratch


def edits(word, letters):
    """Every string one edit away."""
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out - {word}


def expected(counts, ratio=10):
    letters, form, near = set("".join(counts)), {}, {}
    for w in counts:
        near[w] = [x for x in edits(w, letters) if x in counts]
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (counts[w], len(near[w]), form[w], counts[form[w]] if form[w] is not None else None, root)
    return rows


def test_hashes_of_edits_are_those_of_the_edited_words():
    pick = random.Random(3)
    words = ["".join(pick.choice("abcé漢😀") for _ in range(pick.randrange(0, 9))) for _ in range(200)] + ["aab" * 400]
    letters = np.array(sorted({ord(c) for w in words for c in w}), np.uint32)
    places = spelling.Places(words)
    of = lambda w: int(spelling.Places([w]).hashes()[0])
    assert [int(h) for h in places.hashes()] == [of(w) for w in words]
    dropped = Counter()
    for word, h, length in zip(*places.deletes()):
        dropped[int(word), int(h)] += 1
        assert length == len(words[word]) - 1
    assert dropped == Counter((k, of(x)) for k, w in enumerate(words) for x in {w[:i] + w[i + 1:] for i in range(len(w))})
    short = spelling.Places(words[:200])
    got = Counter((int(k), int(h)) for part in short.replaces(letters, 37) for k, h, _ in zip(*part))
    assert got == Counter((k, of(w[:i] + chr(c) + w[i + 1:])) for k, w in enumerate(words[:200]) for i in range(len(w))
                          for c in letters if c > ord(w[i]))


def test_filters_hold_every_word_and_little_else():
    pick = np.random.default_rng(1)
    h, length = pick.integers(0, 1 << 63, 50_000).astype(np.uint64) * np.uint64(2) + np.uint64(1), pick.integers(0, 400, 50_000)
    counts = Counter(np.minimum(length, spelling.LONG).tolist())
    for blocks in (1 << 21, 3000):
        layout = spelling.Layout(counts, blocks)
        assert layout.blocks <= blocks and (layout.filters > 1) == (blocks == 3000)
        held = np.zeros((layout.filters, layout.blocks), np.uint64)
        which, block, bits, known = layout.find(h, length)
        assert known.all()
        np.bitwise_or.at(held, (which, block), bits)
        assert ((held[which, block] & bits) == bits).all()
        which, block, bits, known = layout.find(spelling.mix(h), length)
        assert ((held[which, block] & bits) == bits).mean() < 0.03


def test_groups_equal_brute_force_with_one_or_many_filters(spark):
    pick = random.Random(5)
    counts = Counter()
    for _ in range(600):
        counts["".join(pick.choice("abcd") for _ in range(pick.randrange(1, 7)))] += pick.choice((1, 2, 30, 400))
    counts[""] = 3
    counts["é" * 700], counts["é" * 699], counts["é" * 350 + "è" + "é" * 349] = 1, 500, 40
    counts["漢字😀"], counts["漢😀"] = 1, 10
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()] + [(None, 7, "x")], "word string, n int, form string")
    want = expected(counts)
    for blocks in (spelling.BLOCKS, 300):
        out = spelling.group_variants(df, Scratch(spark, "t"), blocks=blocks).collect()
        assert len(out) == len(counts)
        assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in out} == want
    assert any(f and want[f][2] for _, _, f, _, _ in want.values())   # ways of two steps and more
    assert spelling.group_variants(df.limit(0), Scratch(spark, "t")).count() == 0


def test_query_equals_brute_force_and_sql(spark):
    got = spelling.op13_spelling(spark, SF)
    counts = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{r['doc_id']}:{w}".encode())
            counts[w if h % 31 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    rows = collected(got)
    names = sorted(got.columns)
    assert {dict(zip(names, r))["word"]: tuple(dict(zip(names, r))[c] for c in ("n", "n_near", "form", "form_n", "root")) for r in rows} == expected(counts)
    assert rows == rows_of(spelling.OP13_SQL)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "short words only"), (4, "Élégante élégante ÉLÉGANTE " * 3), (4, "naïvement×÷" * 2),
            (5, "longword" * 30_000), (6, "longword" * 30_000), (None, "nothing nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["word"]: r["n"] for r in spelling._vocabulary(df).collect()}
    assert got["longword" * 30_000] == 2 and got["nothing"] == 2 and "short" not in got
    assert {w for w in got if w.startswith(("É", "é"))} <= {"Élégante", "élégante", "ÉlÉgante"} and len(got) >= 5
