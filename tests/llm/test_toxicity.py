"""Toxicity: how words are read, features against plain Python, held-out accuracy, odd tables."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wakeline.llm import toxicity

LABELS = "doc_id long, toxic int, text string"


def words_read(text):
    found = list(toxicity.read(pa.array([text])))
    return [r.letters[s:e].tobytes().decode() for r in found for s, e in zip(r.starts, r.ends, strict=True)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Stupid, YOU fool!!", ["stupid", "you", "fol"]),
        ("st00pid 1diot $tupid m0r0n", ["stopid", "idiot", "stupid", "moron"]),
        ("thent$$$ erer### 12 $5", ["thent", "erer"]),
        ("i d i o t and a b c", ["idiot", "and", "a", "b", "c"]),
        ("s.t.u.p.i.d stuuupid", ["stupid", "stupid"]),
        ("ÉTÉ réeuxÊ Straße", ["été", "réeuxê", "straße"]),
        ("aééé 中文", ["aééé", "中文"]),
        ("", []),
        (None, []),
    ],
)
def test_words_are_read_as_a_reader_would(text, want):
    assert words_read(text) == want


def test_rows_are_read_apart():
    texts = ["abc", "def", None, "", "i", "d", "i", "o", "t", "x" * 5, "5", "a"] * 3
    together = [
        (r.first + i, r.letters[r.starts[k] : r.ends[k]].tobytes().decode())
        for r in toxicity.read(pa.array(texts))
        for i in range(r.last - r.first)
        for k in range(r.bounds[i], r.bounds[i + 1])
    ]
    assert together == [(i, w) for i, t in enumerate(texts) for w in words_read(t)]


def test_features_equal_plain_python():
    rng = random.Random(5)
    pool = ["you", "idiot", "idi0t", "DU", "calm", "stormy", "ÉTÉ", "yes!!", "soooo", "i d i o t,", "badger"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(60)] + [None, "", "you"]
    bad = {"idiot": 5.0, "storm": 2.5, "badg": 3.6}
    hashes = {}
    for text, weight in bad.items():
        (one,) = toxicity.read(pa.array([text + ("" if text == "idiot" else "zzzz")]))
        column = 0 if text == "idiot" else 1 + toxicity.PREFIXES.index(len(text))
        hashes[int(toxicity.terms(one)[0, column])] = weight
    order = sorted(hashes)
    lexicon = toxicity.Lexicon(
        np.array(order, np.uint64), np.array([[hashes[h]] for h in order]), toxicity._second_persons()
    )
    got = np.concatenate(
        [toxicity.features(r, lexicon, np.zeros(r.last - r.first, int)) for r in toxicity.read(pa.array(texts))]
    )
    for text, row in zip(texts, got, strict=True):
        words = words_read(text)
        weight = [
            max([bad.get(w, 0) if w == "idiot" else 0] + [v for b, v in bad.items() if b != "idiot" and w.startswith(b) and len(w.encode()) > len(b)])
            for w in words
        ]
        you = [w in ("you", "du") for w in words]
        strong = [x >= toxicity.STRONG for x in weight]
        near = [any(you[max(k - toxicity.NEAR, 0) : k + toxicity.NEAR + 1]) for k in range(len(words))]
        many, raw = max(len(words), 1), text or ""
        letters = sum(c.isalpha() if c.isascii() else len(c.encode()) for c in raw)
        size = max(len(raw.encode()), 1)
        want = [
            sum(strong) / many,
            sum(toxicity.WEAK <= x < toxicity.STRONG for x in weight) / many,
            np.log1p(sum(strong)),
            max(weight, default=0),
            sum(weight) / many,
            sum(s and n for s, n in zip(strong, near, strict=True)) / max(sum(strong), 1),
            sum(you) / many,
            sum(c.isupper() for c in raw) / max(letters, 1),
            raw.split().count("DU") / many + raw.split().count("ÉTÉ") / many,
            sum(c.isascii() and not c.isalnum() and c.isprintable() and c != " " for c in raw) / size,
            raw.count("!") / size,
            (raw.count("idi0t") + raw.count("i d i o t")) / many,
            raw.count("soooo") / many,
            np.log1p(len(words)),
        ]
        assert np.allclose(row, want), (text, dict(zip(toxicity.FEATURES, zip(row, want, strict=True), strict=True)))


def corpus(rng, many):
    calm = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    rude = ["wretch", "vermin", "dolt"]
    rows = []
    for i in range(many):
        toxic = rng.random() < 0.25
        words = rng.choices(calm, k=rng.randint(5, 60))
        for _ in range(rng.randint(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice([*rude, "sudd" + rng.choice(calm)]))
        rows.append((i, int(toxic), " ".join(words)))
    return rows


def test_held_out_documents_are_told_apart(spark):
    rng = random.Random(8)
    rows = corpus(rng, 900)
    rows += [(None, 0, "no id"), (5000, None, None), (5001, None, ""), (5002, None, "wretch vermin dolt " * 40_000)]
    rows += [(rows[0][0], rows[0][1], rows[0][2])] * 30
    df = spark.createDataFrame(rows, LABELS)
    labels = df.select("doc_id", "toxic", F.lit("x").alias("text"), F.lit(0.5).alias("score"))
    docs = df.select("doc_id", "text", F.lit(1).alias("toxic"), F.lit("p").alias("features")).repartition(5)
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, t, _ in rows}
    wrong = 0
    for row in got:
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
        assert row.held_out == (zlib.crc32(str(row.doc_id if row.doc_id is not None else "").encode()) % 5 == 0)
        if truth[row.doc_id] is not None and row.held_out:
            wrong += row.predicted != truth[row.doc_id]
    assert wrong <= 0.03 * sum(r.held_out for r in got)
    by = {r.doc_id: r for r in got}
    assert by[5002].predicted == 1 and by[5000].predicted == by[5001].predicted == 0
    again = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in got)


def test_labels_too_few_give_their_share(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)] + [(None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    odd = spark.createDataFrame([(None, 1), (2, None), (3, 7)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, odd).collect()} == {0.0}
    all_toxic = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, all_toxic).collect()} == {1.0}
    assert toxicity.score(docs.limit(0), all_toxic).count() == 0


def test_fit_rows_bound_the_sample(spark):
    rows = corpus(random.Random(2), 2000)
    df = spark.createDataFrame(rows, LABELS)
    fit = toxicity.labelled(df.select("doc_id", "text"), df.select("doc_id", "toxic"), fit_rows=400)
    assert 300 < fit.count() < 500
    twice = df.select("doc_id", F.lit(1).alias("toxic")).unionAll(df.select("doc_id", F.lit(0).alias("toxic")))
    assert {r.toxic for r in toxicity.labelled(df.select("doc_id", "text"), twice).select("toxic").collect()} == {0}
