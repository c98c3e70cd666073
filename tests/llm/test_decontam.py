"""Decontamination against a brute-force comparison of every text and item at every shift."""

import random
import re

import numpy as np
import pytest

from wakeline.llm import decontam

WORD = re.compile(r"[^\x20\x09-\x0D]+")
POOL = ["".join(random.Random(i).choices("abcdefghij", k=5)) for i in range(3000)]


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    """(text, item) pairs by the three rules, tried at every shift."""
    ids: dict[str, int] = {}
    number = lambda text: np.array([ids.setdefault(w, len(ids)) for w in tokens(text)], np.uint64)
    out = set()
    for i, text in enumerate(texts):
        a = number(text)
        for j, item in enumerate(items):
            b = number(item)
            if not len(a) or not len(b):
                continue
            for shift in range(1 - len(b), len(a)):
                if decontam.verified(a, b, shift):
                    out.add((i, j))
    return out


def substituted(rng, words, many):
    words = list(words)
    for at in rng.sample(range(len(words)), many):
        words[at] = f"sub{rng.randint(0, 10**6)}"
    return words


@pytest.mark.parametrize(
    ("size", "changes", "least"),
    [(15, 2, 0.9), (20, 3, 0.9), (12, 1, 1.0), (8, 1, 1.0), (6, 0, 1.0), (30, 0, 1.0), (59, 4, 0.95), (15, 0, 1.0)],
)
def test_substitutions_are_tolerated(spark, size, changes, least):
    rng = random.Random(size * 10 + changes)
    items = [rng.choices(POOL, k=size) for _ in range(200)]
    texts = [
        " ".join([*rng.choices(POOL, k=30), *substituted(rng, item, changes), *rng.choices(POOL, k=30)]) for item in items
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()}
    assert all(a == b for a, b in got)
    assert len(got) >= least * len(items)


def test_leaks_equal_brute_force(spark):
    rng = random.Random(3)
    items = [" ".join(rng.choices(POOL, k=n)) for n in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 20, 31, 33, 60)]
    items += [items[-1], None, "", "the the the the the the the the the the the the the"]
    texts = [None, "", "the " * 50, items[3].upper(), f"{items[3]} more", items[0], f"{items[5]} {items[7]}"]
    for item in items:
        own = tokens(item)
        for changes in range(0, len(own) // 4 + 1):
            body = substituted(rng, own, changes) if own else []
            texts.append(" ".join([*rng.choices(POOL, k=rng.randint(0, 9)), *body, *rng.choices(POOL, k=9)]))
        texts.append(" ".join(own[len(own) // 3 :]))
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, key string")
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, item int")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs.repartition(4), bench).collect()}
    want = brute(texts, items)
    assert got <= want
    assert len(got) >= 0.97 * len(want)
    exact = {(i, j) for i, t in enumerate(texts) for j, x in enumerate(items) if len(tokens(x)) >= 5 and f" {' '.join(tokens(x))} " in f" {' '.join(tokens(t))} "}
    assert exact <= got


def test_rows_are_judged_by_their_text(spark):
    rng = random.Random(6)
    item = " ".join(rng.choices(POOL, k=20))
    good, bad = " ".join(rng.choices(POOL, k=40)), f"{item} {' '.join(rng.choices(POOL, k=9))}"
    rows = [(1, good, "a"), (1, bad, "b"), (None, good, "c"), (None, bad, "d"), (None, None, "e"), (2, "", "f")]
    rows += [(7, good, "g")] * 3 + [(7, bad, "h")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key string")
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    kept = sorted((r.doc_id or 0, r.text or "", r.text_key) for r in decontam.clean(docs, bench).collect())
    assert kept == sorted((i or 0, t or "", s) for i, t, s in rows if t != bad)
    assert decontam.leaks(docs, bench).count() == 32
    assert decontam.clean(docs, bench.filter("false")).count() == len(rows)
    assert decontam.clean(docs.filter("false"), bench).count() == 0


def test_very_long_texts_are_looked_at_whole(spark):
    rng = random.Random(9)
    item = " ".join(rng.choices(POOL, k=18))
    long = " ".join(rng.choices(POOL, k=200_000))
    docs = spark.createDataFrame([(1, f"{long} {item}"), (2, long)], "doc_id long, text string")
    (row,) = decontam.leaks(docs, spark.createDataFrame([(3, item)], "item_id long, text string")).collect()
    assert (row.doc_id, row.doc_first, row.doc_end) == (1, 200_000, 200_018)
