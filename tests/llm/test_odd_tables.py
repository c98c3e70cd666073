"""Very long texts, clashing extra columns, and the keyed permutation against plain Python."""

import hashlib
import math
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from wakeline.llm import ann, chat, langid, mixing, secrets, sharding, warc, whitening
from wakeline.llm.tables import ROUNDS, permuted

LONG = " ".join("".join(random.Random(7).choices("abcdefgh", k=6)) for _ in range(5000)) + " "
HUGE = LONG * 60 + "é token: abcdefgh123"


def hashed(*values):
    """Spark's xxhash64 of long and int columns, one after another."""
    seed = 42
    for value, kind in values:
        seed = xxhash.xxh64(struct.pack(kind, value), seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def plain_permuted(number, size, key):
    rows = math.ceil(math.sqrt(size))
    columns = math.ceil(size / rows)
    while True:
        row, column = divmod(number, columns)
        for k in range(ROUNDS):
            row = (row + hashed((column, "<q"), (k, "<i"), (key, "<q")) % rows) % rows
            column = (column + hashed((row, "<q"), (key, "<q"), (k, "<i")) % columns) % columns
        number = row * columns + column
        if number < size:
            return number


@pytest.mark.parametrize("size", [1, 2, 5, 30, 997, 4096])
def test_permutation_equals_plain_python(spark, size):
    df = spark.range(size).select(permuted(F.col("id"), F.lit(size).cast("long"), F.lit(23).cast("long")).alias("p"))
    got = [r.p for r in df.collect()]
    assert got == [plain_permuted(i, size, 23) for i in range(size)]
    assert sorted(got) == list(range(size))


def clashing(df):
    """``df`` with columns named as operators name their own."""
    for name in ("_order", "block", "shard", "slot", "size", "n", "place", "letters", "_same", "_key", "keeper", "entry", "list", "part", "x", "_chunk"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def test_long_texts_and_clashing_columns(spark, tmp_path):
    rows = [(i, LONG[i : i + 600], f"s{i % 2}", "aa") for i in range(60)] + [(99, HUGE, "s0", None), (None, None, None, None)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"))
    words = {i: len((t or "").split()) for i, t, _, _ in rows}

    sizes = {r.doc_id: (r.size, r.taken) for r in mixing.taken(mixing.mix(docs)).collect()}
    assert {i: s for i, (s, _) in sizes.items()} == words
    assert all(taken <= 3 * size for size, taken in sizes.values())

    langs = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert langs[99] == "aa" and langs[None] == "und"

    found = {r.doc_id: r for r in secrets.digest(secrets.scan(docs)).collect()}
    start = len(HUGE) - len("token: abcdefgh123")
    assert found[99].n_assign == 1
    assert found[99].base_sha256 == hashlib.sha256(f"assign:{start}:{len(HUGE)}".encode()).hexdigest()

    shards = {r.doc_id: r["size"] for r in sharding.shard_documents(docs).collect()}
    assert shards[99] == len(HUGE.encode()) + 1 and len(shards) == len(rows)

    pages = clashing(
        spark.createDataFrame([(i, None, t) for i, t, _, _ in rows] + [(100, "u", HUGE)], "page_id long, url string, html string")
    )
    warc.write_archives(pages, str(tmp_path / "warc"))
    read = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path / "warc")).collect()}
    assert read[99].payload_bytes == len(HUGE.encode()) and read[99].refers_to == 100
    assert read[99].record_type == "revisit" and read[100].record_type == "response"

    turns = clashing(
        spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", HUGE), (2, 0, "user", None)],
            "conv_id long, turn long, role string, text string")
    )
    chats = {r.conv_id: r for r in chat.digests(chat.format_chats(turns)).collect()}
    assert chats[1].loss_chars == len(HUGE)
    assert chats[1].loss_sha256 == hashlib.sha256(HUGE.encode()).hexdigest()


def test_vectors_with_clashing_columns(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    vectors = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = ann.neighbours(vectors, F.col("vec_id") % 20 == 0, k=5).collect()
    assert len(got) == 6 * 5
    assert whitening.whiten(vectors).count() == 120 * 6
