import itertools
import random

import numpy as np
from helpers import SF, duck, words
from starflow.llm import decontaminate as dc
from starflow.llm import words as hashing


def brute(docs, items):
    found = set()
    for (i, text), (item, wanted) in itertools.product(docs, items):
        w, own = words((text or "").lower()), words((wanted or "").lower())
        size = min(13, len(own))
        if len(own) < 6:
            continue
        for start in range(size - len(own), len(w) - size + 1):
            same = [0 <= start + k < len(w) and w[start + k] == own[k] for k in range(len(own))]
            inside = [k for k in range(len(own) - size + 1) if start + k >= 0 and start + k + size <= len(w)]
            if any(size - sum(same[k:k + size]) <= size // 5 for k in inside):
                found.add((i, item))
                break
    return found


def test_masks_find_every_place_that_counts():
    def covered(n, masks):
        for wrong in itertools.combinations(range(n), n // dc.ONE_IN):
            if not any(all(o + k not in wrong for k in m) for m in masks for o in range(n - m[-1])):
                return False
        return True
    assert covered(dc.WINDOW, dc.MASKS)
    assert all(covered(n, dc.SHORT_MASKS) for n in range(dc.MIN_WORDS, dc.WINDOW))


def test_substitutions_edges_and_odd_rows(spark):
    rng = random.Random(2)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(n))) for k, n in enumerate([3, 5, 6, 9, 12, 13, 14, 40, 120])]
    items += [(50, None), (51, ""), (7, items[7][1]), (None, items[8][1])]
    docs = []
    for k in range(250):
        own = rng.choice(items)[1]
        own = (own or "").split()
        a = rng.randrange(len(own) + 1)
        part = own[a // 2:a // 2 + rng.randrange(1, 60)]
        part = [f"X{rng.randrange(99)}" if rng.random() < rng.choice([0, 0.1, 0.3]) else x.upper() for x in part]
        noise = [f"n{rng.randrange(999)}" for _ in range(rng.randrange(30))]
        docs.append((k, " ".join(noise + part + noise[::-1])))
    docs += [(899, "É " + items[7][1].upper().replace("I", "É"))]
    items += [(52, items[7][1].replace("i", "é"))]
    docs += [(900, None), (901, ""), (3, docs[3][1]), (902, "z " * 70_000 + items[7][1]), (None, items[6][1])]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = dc.overlaps(d, b).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute(docs, items)
    hit = {i for i, _ in brute(docs, items)}
    out = dc.clean(d, b)
    assert out.columns == d.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(i) for i, _ in docs if i not in hit)


def test_blocks_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 600)
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in dc.overlaps(docs, items.limit(12)).collect()}
    monkeypatch.undo()
    assert got == {(r["doc_id"], r["item_id"]) for r in dc.overlaps(docs, items.limit(12)).collect()}
    assert dc.overlaps(docs.limit(0), items).count() == 0 and dc.overlaps(docs, items.limit(0)).count() == 0
    assert dc.clean(docs, items.limit(0)).count() == docs.count() and dc.clean(docs.limit(0), items).count() == 0


def test_query_matches_brute_force_on_all_documents(spark):
    got = {(r["doc_id"], r["item_id"]) for r in dc.op9_decontaminate(spark, SF).collect()}
    docs = duck("SELECT doc_id, text FROM documents").fetchall()
    voc: dict[str, int] = {}
    number = lambda t: np.array([voc.setdefault(x, len(voc)) for x in words((t or "").lower())])
    items = [(i, number(t)) for i, t in duck("SELECT item_id, text FROM benchmark").fetchall()]
    want = set()
    for i, text in docs:
        w = number(text)
        for item, own in items:
            size = min(13, len(own))
            if len(own) < 6 or len(w) < size or len(np.intersect1d(w, own)) < 4:
                continue
            for start in range(size - len(own), len(w) - size + 1):
                f, t = max(start, 0), min(start + len(own), len(w))
                if t - f >= size:
                    same = np.concatenate([[0], np.cumsum(w[f:t] == own[f - start:t - start])])
                    if size - (same[size:] - same[:-size]).max() <= size // 5:
                        want.add((i, item))
                        break
    assert got == want


def test_word_hashes_over_stretches():
    for text in ("a A b  ü\tÜ foo Foo " * 1000 + "x" * 70_000 + " " + "X" * 70_000 + " y",
                 " ".join(f"w{k}" for k in range(200_000)) + "z" * 3_000_000 + " end w5 " + "Z" * 3_000_000, "", " \n"):
        found = hashing.word_hashes(text.encode())[0]
        own, seen = words(text), {}
        assert len(found) == len(own) and all(seen.setdefault(w, h) == h for w, h in zip(own, found, strict=True))
        assert len(set(seen.values())) == len(seen)


def test_short_items_match_a_whole_line_or_text(spark):
    items = spark.createDataFrame([(1, "Who  won?"), (2, "Yes"), (3, " who WON?"), (4, " \n"), (5, "a b c d e")], "item_id long, text string")
    docs = [(1, "so\twe ask\n WHO won? \nyes, it is"), (2, "who won? nobody"), (3, "Yes"), (4, "who\nwon?"), (5, "a b c d e f"),
            (6, None), (7, ""), (8, "x\n\na b\tc d e\r\nyes\nyes")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r) for r in dc.overlaps(d, items, short_items=True).collect())
    assert got == [(1, 1, 3, 2, 2), (1, 3, 3, 2, 2), (3, 2, 0, 1, 1), (4, 1, 0, 2, 2), (4, 3, 0, 2, 2), (8, 2, 6, 1, 1), (8, 5, 1, 5, 5)]
    assert sorted(r["doc_id"] for r in dc.clean(d, items, short_items=True).collect()) == [2, 5, 6, 7]
