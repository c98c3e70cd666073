"""Language identification as a mixture of languages in each document.

A language is a distribution over letter n-grams (bytes, of GRAM, hashed into BUCKETS),
counted over every labelled training text. A document's n-grams are taken to be drawn
from several languages: expectation-maximisation estimates their shares, first with all
languages, then with only its 1, 2, .. leading ones, as far as the next one's share is at
least LEAST_SHARE, and the set with the largest penalised likelihood stays, each further
language costing PENALTY * log(n-grams). The
prediction is the language with the largest share, its share is the score.

Counts go through one shuffle, combined in the tasks first; the model is a table of
BUCKETS values for each language and is all that tasks receive. Texts are never shuffled.

Texts that are null or hold no letter get ``und`` and score 0. Labels that are null train
nothing; without any training text everything is ``und``. Ties go to the label first in
code-point order. A null id counts as an empty one when documents are held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.memory import releasing
from wakeline.llm.words import row_chunks

GRAM = 3
BUCKETS = 1 << 16
SMOOTHING = 0.1
PENALTY = 6.0
ROUNDS = 12
# Shares below this are no language's; a leading set stops growing there.
LEAST_SHARE = 0.02
# More labels than this would make the model larger than a task should hold.
MOST_LANGUAGES = 500

# Bytes of n-grams: letters in lower case, everything else in ASCII as one blank.
_BYTES = np.arange(256, dtype=np.uint32)
_BYTES[:128] = [ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(128)]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 4, is 2."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def _grams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For consecutive rows: the first row, and each n-gram's row and bucket.

    N-grams of blanks only, and those across rows, are left out.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    for first, last in row_chunks(offsets):
        base, size = offsets[first], int(offsets[last] - offsets[first])
        code = _BYTES[data[base : base + size]]
        count = max(size - GRAM + 1, 0)
        value = np.zeros(count, np.uint32)
        letters = np.zeros(count, np.uint8)
        for k in range(GRAM):
            value = value << np.uint32(8) | code[k : k + count]
            letters += code[k : k + count] != 32
        rows = np.repeat(np.arange(last - first), np.diff(offsets[first : last + 1]))
        good = (letters >= GRAM - 1) & (rows[:count] == rows[GRAM - 1 :][:count]) if count else letters > 0
        bucket = (value * np.uint32(2654435761)) >> np.uint32(16)
        yield first, rows[:count][good], bucket[good]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of one task, by label."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        labels = batch.column(1)
        names = labels.unique().to_pylist()
        place = {name: i for i, name in enumerate(names)}
        of = np.array([place[x] for x in labels.to_pylist()], np.int64)
        for first, rows, buckets in _grams(batch.column(0)):
            own = of[first + rows]
            for i in np.unique(own):
                total = totals.setdefault(names[i], np.zeros(BUCKETS, np.int64))
                total += np.bincount(buckets[own == i], minlength=BUCKETS)
    for name, total in totals.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(total[used])],
            ["lang", "bucket", "n"],
        )


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Labels in code-point order, and the probability of each n-gram by label.

    ``labelled`` has text and lang. At most BUCKETS rows a label reach the driver.
    """
    counts = (
        labelled.select("text", "lang")
        .filter("text is not null and lang is not null")
        .mapInArrow(_count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    packed = counts.groupBy("lang").agg(
        F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("counts")
    )
    known = sorted(packed.collect(), key=lambda row: row.lang.encode())
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"{len(known)} labels; at most {MOST_LANGUAGES} are supported")
    table = np.full((BUCKETS, len(known)), SMOOTHING, np.float32)
    for i, row in enumerate(known):
        table[row.buckets, i] += np.array(row.counts, np.float32)
    return [row.lang for row in known], table / table.sum(0, dtype=np.float64).astype(np.float32)


def _fit(likely: np.ndarray, weight: np.ndarray, bounds: np.ndarray, rows: np.ndarray, shares: np.ndarray):
    """Expectation-maximisation for many documents at once; languages at 0 stay at 0."""
    total = np.maximum(np.add.reduceat(weight, bounds[:-1]), 1e-9)
    for _ in range(ROUNDS):
        joint = likely * shares[rows]
        joint *= (weight / np.maximum(joint.sum(1), 1e-30))[:, None]
        shares = np.add.reduceat(joint, bounds[:-1], axis=0) / total[:, None]
    level = np.log(np.maximum((likely * shares[rows]).sum(1), 1e-30)) * weight
    return shares, np.add.reduceat(level, bounds[:-1])


def mixture(table: np.ndarray, rows: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have n-grams, and the shares of the languages in each."""
    pairs, counts = np.unique(rows.astype(np.int64) * BUCKETS + buckets, return_counts=True)
    have, starts = np.unique(pairs // BUCKETS, return_index=True)
    bounds = np.append(starts, len(pairs))
    at = np.repeat(np.arange(len(have)), np.diff(bounds))
    likely = table[pairs % BUCKETS]
    weight = counts.astype(np.float32)
    grams = np.maximum(np.add.reduceat(weight, bounds[:-1]), 2.0)
    size = table.shape[1]
    full = np.full((len(have), size), 1.0 / size, np.float32)
    shares, _ = _fit(likely, weight, bounds, at, full)
    order = np.argsort(-shares, axis=1, kind="stable")
    best, best_level = None, None
    for k in range(1, size + 1):
        start = np.zeros_like(full)
        np.put_along_axis(start, order[:, :k], 1.0 / k, axis=1)
        if k > 1:
            worth = np.take_along_axis(shares, order[:, k - 1 : k], 1)[:, 0] >= LEAST_SHARE
            if not worth.any():
                break
            inside = worth[at]
            own = np.append(0, np.cumsum(np.diff(bounds)[worth]))
            again = np.repeat(np.arange(worth.sum()), np.diff(own))
            found, level = _fit(likely[inside], weight[inside], own, again, start[worth])
        else:
            worth = np.ones(len(have), bool)
            found = start
            level = np.add.reduceat(
                np.log(np.maximum((likely * start[at]).sum(1), 1e-30)) * weight, bounds[:-1]
            )
        level = level - PENALTY * (k - 1) * np.log(grams[worth])
        if best is None:
            best, best_level = found.copy(), level.copy()
            continue
        better = level > best_level[worth]
        chosen = np.flatnonzero(worth)[better]
        best[chosen], best_level[chosen] = found[better], level[better]
    return have, best


def _judged(texts: pa.Array, letters: pa.Array, names: list[str], table: np.ndarray) -> tuple:
    """Label, score and shares of each text; ``letters`` says which have one."""
    size = len(texts)
    shares = np.zeros((size, max(len(names), 1)), np.float64)
    for first, rows, buckets in _grams(texts) if names else ():
        if len(rows):
            have, found = mixture(table, rows, buckets)
            shares[first + have] = found
    letters = np.array(letters.fill_null(False))
    # A letter without an n-gram is judged like any other text: all shares equal.
    blank = letters & (shares.sum(1) == 0)
    shares[blank] = 1.0 / max(len(names), 1)
    top = shares.argmax(1)
    sure = letters & bool(names)
    score = np.where(sure, np.clip(shares[np.arange(size), top], 0, 1), 0.0)
    return [names[k] if good else "und" for k, good in zip(top, sure, strict=True)], score, shares, sure


def _predictor(names: list[str], table: np.ndarray):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, score, shares, sure = _judged(batch.column(2), batch.column(3), names, table)
            mixed = [
                sorted(((names[k], float(row[k])) for k in np.flatnonzero(row)), key=lambda x: -x[1])
                if good
                else []
                for row, good in zip(shares, sure, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(label, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(mixed, pa.map_(pa.string(), pa.float64())),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "shares"],
            )

    return predict


def with_language(rows: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """``rows``, which have a text, with ``_lang`` and ``_score`` after their own columns."""
    own = rows.columns
    place = own.index("text")

    @releasing
    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, score, _, _ = _judged(batch.column(place), batch.column(len(own)), names, table)
            columns = [*batch.columns[: len(own)], pa.array(label, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*own, "_lang", "_score"])

    schema = T.StructType(
        [*rows.schema.fields, T.StructField("_lang", T.StringType()), T.StructField("_score", T.DoubleType())]
    )
    return rows.select(*own, F.col("text").rlike(r"\p{L}").alias("_letters")).mapInArrow(append, schema)


def predict(documents: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """Predict from text alone: doc_id, held_out, lang_pred, score, shares (label to share)."""
    return documents.select(
        F.col("doc_id").cast("long"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
        F.col("text").rlike(r"\p{L}").alias("letters"),
    ).mapInArrow(
        _predictor(names, table),
        "doc_id long, held_out boolean, lang_pred string, score double, shares map<string,double>",
    )


def identify(documents: DataFrame) -> DataFrame:
    """Train on the documents that are not held out, and predict for all."""
    names, table = train(documents.filter(~held_out(F.col("doc_id"))))
    return predict(documents, names, table)
