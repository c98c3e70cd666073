"""Cross-tokenizer alignment against plain Python over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from wakeline.llm import align
from wakeline.llm.queries import alignment_paths

RNG = random.Random(12)
ODD = [
    None,
    "",
    " ",
    "  two  spaces ",
    "a \n b\n\nc\t d",
    "\nlead and trail\n",
    "end of text <|endoftext|> <s> </s> <0x41> here",
    "café naïve ▁ mark",
    "▁",
    "漢字かな \U0001f600\U0001f600 ok",
    "no break　wide  x",
    "don't we'll I'M '' ''s",
    "1234567890 12,345.67 !!!??? ***$$$ ###&&&",
    "\x00\x01 control\r\nline",
    "word " * 3 + "word",
]


def plain(texts, paths):
    """Groups and links of every text, one token at a time."""
    tools = align.Pair(*paths)
    out, counts = [], Counter()
    for text in texts:
        data = f" {text}".encode() if text else b""
        a = tools.a.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = tools.b.encode(text) if text else []
        spans = []
        for ids, known in ((a, tools.bytes_a), (b, tools.bytes_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(known[i])))
                at = own[-1][1]
            if b"".join(known[i] for i in ids) != data:
                own = None
            spans.append(own)
        if not text or None in spans:
            out.append((0, 0, [], []))
            continue
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, last = [], 0
        for end in ends:
            sides = [
                ",".join(str(i) for i, (s, e) in zip(ids, own, strict=True) if last <= s and e <= end)
                for ids, own in ((a, spans[0]), (b, spans[1]))
            ]
            groups.append("|".join(sides))
            last = end
        links = [
            (x, y)
            for x, (s, e) in zip(a, spans[0], strict=True)
            for y, (u, v) in zip(b, spans[1], strict=True)
            if s < v and u < e
        ]
        counts.update(links)
        out.append((len(a), len(b), groups, links))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (
            n_a,
            n_b,
            len(groups),
            len(links),
            sum(counts[link] == most[link[1]] for link in links),
            sum(counts[link] for link in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            ";".join(groups),
        )
        for n_a, n_b, groups, links in out
    ]


def texts_of(seed, many):
    rng = random.Random(seed)
    parts = ["the", "tion", "é", "sch", "ing", "中", "!", "$$", "12", "'s", "x", "-", "\n", "Qu"]
    return [
        " ".join("".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 60)))
        for _ in range(many)
    ]


@pytest.mark.parametrize(("block", "cached"), [(align.BLOCK_LINKS, align.CACHED), (200, 10)])
def test_align_equals_plain_python(spark, block, cached):
    paths = alignment_paths()
    texts = ODD + texts_of(3, 120) + ["same words again"] * 40 + [" ".join(texts_of(5, 20))]
    rows = [(i if i % 9 else None, t, "z", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, pair int").repartition(3)
    got = align.align(docs, *paths, texts=True, block_links=block, cached=cached).drop("doc_id").collect()
    names = "n_a n_b n_groups n_links n_best count_sum groups_sha256 groups".split()
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(plain(texts, paths))
    ids = Counter(r.doc_id for r in align.counted(docs, *paths).select("doc_id").collect())
    assert ids == Counter(r[0] for r in rows)


def test_align_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(docs, *alignment_paths()).count() == 0
    nulls = spark.createDataFrame([(None, None), (1, ""), (1, None)], "doc_id long, text string")
    got = align.align(nulls, *alignment_paths()).collect()
    assert [tuple(r)[1:8] for r in got] == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_gallop_finds_what_bisection_finds():
    rng = np.random.default_rng(2)
    for _ in range(50):
        sizes = rng.integers(1, 300, 5)
        long = [np.unique(np.append(rng.integers(1, 5000, n), 5000)) for n in sizes]
        short = [np.unique(np.append(rng.integers(1, 5000, rng.integers(1, len(x) + 1)), 5000)) for x in long]
        base = np.arange(5) * 10_000
        long_at = np.concatenate(([0], np.cumsum([len(x) for x in long])))
        short_at = np.concatenate(([0], np.cumsum([len(x) for x in short])))
        flat_long = np.concatenate([x + b for x, b in zip(long, base, strict=True)])
        flat_short = np.concatenate([x + b for x, b in zip(short, base, strict=True)])
        got = align.align_ends(flat_short, short_at, flat_long, long_at)
        assert np.array_equal(flat_short[got.common_short], flat_long[got.common_long])
        assert len(got.common_short) == len(np.intersect1d(flat_short, flat_long))
        assert got.links.sum() == len(got.link_short)
