"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Words are read as a reader would: in lower case, digits and signs that stand for letters
turned into them, doubled letters taken once, letters set apart joined. A lexicon is
learned from the labels: words and beginnings of words (of PREFIXES bytes) that are far
more frequent in toxic documents, each with its log odds. The features of a document
(FEATURES) are densities of the lexicon, its nearness to second persons, and rates of
capitals, punctuation and obfuscation; trees and calibration see nothing else.

Labelled documents are in FOLDS parts, and a document of one part gets its features from a
lexicon counted without that part. One ensemble of trees learns from the even parts and
one from the odd ones; each scores the other's documents, and these scores fit the
calibration. A text's score is the calibrated mean of both.

The classifier is fitted on labelled documents of at most FIT_ROWS ids, chosen by hash
(fewer labels: all), the lexicon holds at most TERMS terms; everything else covers all
documents. Texts to be scored are read once and never shuffled.

Null and empty texts have features of zeros and are scored as such. Labels that are null or
neither 0 nor 1 teach nothing; an id labelled more than once is toxic if most of its labels
are; repeated rows teach once and are scored each. Without labels of both kinds in both
halves every score is the share of toxic labels, 0 if there are none. An empty table gives
an empty result. A null id counts as an empty one when documents are held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.words import range_hashes, row_chunks
from wakeline.sources.staging import staged

FIT_ROWS = 50_000
TERMS = 1 << 14
FOLDS = 4
PREFIXES = (4, 5, 6, 7, 8)
# A term of the lexicon: in this many toxic documents, and in this share of them.
LEAST_TOXIC, LEAST_SHARE = 3, 0.002
WEAK, STRONG, MOST = 2.0, 3.5, 8.0
NEAR = 5
LETTERS_APART = 4
TREES, DEPTH, RATE, BINS = 20, 3, 0.25, 64
STEPS = 1000

SECOND_PERSONS = (
    "you your yours yourself du dich dir dein deine ihr euch sie ihnen "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros"
).split()
FEATURES = (
    "strong_density weak_density strong_count highest_weight mean_weight near_second_person "
    "second_person_density capital_rate capital_words punctuation_rate exclamation_rate "
    "obfuscated_words repeated_letters word_count"
).split()

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = True
# Signs that stand for a letter inside a word.
_STANDS = np.zeros(256, np.uint8)
for _sign, _letter in zip("013457@$!|", "oieastasii", strict=True):
    _STANDS[ord(_sign)] = ord(_letter)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_BITS = 22


@dataclass
class Read:
    """The words of consecutive rows as read, over a buffer of their letters alone."""

    first: int
    last: int
    letters: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    capitals: np.ndarray
    changed: np.ndarray
    repeated: np.ndarray
    rates: np.ndarray


def _before(x: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, x.dtype), x[:-1]))


def _after(x: np.ndarray) -> np.ndarray:
    return np.concatenate((x[1:], np.zeros(1, x.dtype)))


def read(texts: pa.Array) -> Iterator[Read]:
    """Read the words of a string array, in pieces of consecutive rows."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    for first, last in row_chunks(offsets):
        yield _read_rows(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])


def _read_rows(first: int, last: int, raw: np.ndarray, edges: np.ndarray) -> Read:
    if not len(raw):
        none = np.zeros(0, np.int64)
        zeros = np.zeros((last - first, 3))
        return Read(first, last, raw, none, none, np.zeros(last - first + 1, np.int64), *[none > 0] * 3, zeros)
    opens = np.zeros(len(raw) + 1, bool)
    opens[edges] = True
    opens, closes = opens[:-1], opens[1:]
    letter = _LETTER[raw]
    text = _LOWER[raw]
    capital = text != raw
    # Capitals of Latin-1 are two bytes, of which the second tells.
    second = (_before(raw) == 0xC3) & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
    text = np.where(second, raw + 0x20, text).astype(np.uint8)
    capital |= second
    # A sign is a letter before a letter, and after one or at the start of a word; signs go in pairs.
    stands = _STANDS[raw] > 0
    to_letter = ~closes & _after(letter)
    to_letter = stands & (to_letter | (~closes & _after(stands & to_letter)))
    from_letter = ~opens & _before(letter | (stands & ~opens & _before(letter)))
    begins = opens | _before(_SPACE[raw])
    turned = to_letter & (from_letter | begins)
    inside = letter | turned
    text = np.where(turned, _STANDS[raw], text)
    starting = inside & (opens | ~_before(inside))
    ending = inside & (closes | ~_after(inside))
    doubled = inside & ~starting & (_before(text) == text) & (text < 128)
    thrice = doubled & _before(doubled)
    kept = inside & ~doubled
    upto = np.concatenate(([0], np.cumsum(kept)))
    raw_starts, raw_ends = np.flatnonzero(starting), np.flatnonzero(ending) + 1
    starts, ends = upto[raw_starts], upto[raw_ends]

    def some(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[raw_ends] - total[raw_starts]

    sizes = raw_ends - raw_starts
    capitals = (some(capital & inside) > 1) & (some(capital | (inside & (raw >= 128))) == sizes)
    changed, repeated = some(turned) > 0, some(thrice) > 0
    # Letters set apart: single letters with one byte between them, in one row.
    row = np.searchsorted(edges, raw_starts, "right") - 1
    if len(starts):
        single = (ends - starts == 1) & (sizes == 1)
        linked = single & _before(single) & (_before(raw_ends) + 1 == raw_starts) & (_before(row) == row)
        linked[0] = False
        run = np.cumsum(~linked) - 1
        joined = np.bincount(run) >= LETTERS_APART
        head = ~(linked & joined[run])
        tail = _after(head)
        tail[-1] = True
        apart = (joined[run] & single)[head]
        starts, ends, row = starts[head], ends[tail], row[head]
        capitals, repeated = capitals[head], repeated[head]
        changed = changed[head] | apart
    bounds = np.searchsorted(row, np.arange(last - first + 1))
    counts = [np.concatenate(([0], np.cumsum(x))) for x in (capital, _PUNCTUATION[raw], (raw == 33) | (raw == 63), letter)]
    capital_n, mark_n, shout_n, letter_n = (np.diff(c[edges]) for c in counts)
    size = np.maximum(np.diff(edges), 1)
    rates = np.stack([capital_n / np.maximum(letter_n, 1), mark_n / size, shout_n / size], 1)
    return Read(first, last, text[kept], starts, ends, bounds, capitals, changed, repeated, rates)


def terms(found: Read) -> np.ndarray:
    """Hashes of each word and of its beginnings, one column each; 0 where it is too short."""
    out = [range_hashes(found.letters, found.starts, found.ends)]
    for salt, size in enumerate(PREFIXES, 1):
        long = found.ends - found.starts > size
        own = range_hashes(found.letters, found.starts, np.where(long, found.starts + size, found.starts))
        out.append(np.where(long, own + np.uint64(salt), np.uint64(0)))
    return np.stack(out, 1)


def _second_persons() -> np.ndarray:
    known = [terms(r)[:, 0] for r in read(pa.array(SECOND_PERSONS))]
    return np.unique(np.concatenate(known))


def _distinct(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of two columns, and how often each occurs."""
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    first = np.flatnonzero(new)
    return one[first], two[first], np.diff(np.append(first, len(one)))


def _term_counts(wanted: np.ndarray | None):
    """Documents that hold each term, by label and part; all terms, or the wanted ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = np.array(batch.column(0), np.int64) * FOLDS + np.array(batch.column(1), np.int64)
            for found in read(batch.column(2)):
                own = terms(found)
                row = np.repeat(np.arange(found.last - found.first), np.diff(found.bounds))
                row, flat = np.repeat(row, own.shape[1]), own.ravel()
                used = np.flatnonzero(flat)
                if wanted is not None:
                    at = np.minimum(np.searchsorted(wanted, flat[used]), max(len(wanted) - 1, 0))
                    used = used[wanted[at] == flat[used]] if len(wanted) else used[:0]
                held, rows_of, _ = _distinct(flat[used], row[used])
                held, group, n = _distinct(held, kind[found.first + rows_of])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held.view(np.int64)), pa.array(group), pa.array(n)], ["term", "kind", "n"]
                )

    return count


@dataclass
class Lexicon:
    """Terms in order, with their weights in each part's lexicon and, last, in that of all."""

    terms: np.ndarray
    weights: np.ndarray
    second: np.ndarray

    def __post_init__(self):
        self.known = np.zeros(1 << _BITS, bool)
        self.known[self.terms >> np.uint64(64 - _BITS)] = True

    def word_weights(self, own: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The largest weight of the terms of each word; ``column`` names its lexicon."""
        best = np.zeros(len(own), np.float64)
        for k in range(own.shape[1]):
            at = np.flatnonzero(self.known[own[:, k] >> np.uint64(64 - _BITS)])
            place = np.searchsorted(self.terms, own[at, k])
            place = np.minimum(place, len(self.terms) - 1)
            hit = self.terms[place] == own[at, k]
            at, place = at[hit], place[hit]
            np.maximum.at(best, at, self.weights[place, column[at]])
        return best


def learn_lexicon(fit: DataFrame, many: dict[int, int]) -> Lexicon:
    """The lexicon of labelled rows (toxic, part, text); ``many`` counts rows by toxic and part.

    At most TERMS terms with their counts reach the driver, the most frequent ones in
    toxic documents.
    """
    total = np.array([many.get(k, 0) for k in range(2 * FOLDS)], np.int64).reshape(2, FOLDS)
    least = max(LEAST_TOXIC, int(LEAST_SHARE * total[1].sum()))
    rows = fit.select(F.col("toxic").cast("long"), F.col("part").cast("long"), "text")
    toxic = rows.filter("toxic = 1").mapInArrow(_term_counts(None), "term long, kind long, n long")
    frequent = (
        toxic.groupBy("term")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
        .orderBy(F.desc("n"), "term")
        .limit(TERMS)
    )
    wanted = np.sort(np.array([r.term for r in frequent.collect()], np.int64).view(np.uint64))
    counts = (
        rows.mapInArrow(_term_counts(wanted), "term long, kind long, n long")
        .groupBy("term", "kind")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    table = np.zeros((len(wanted), 2, FOLDS), np.int64)
    place = np.searchsorted(wanted, counts["term"].to_numpy(np.int64).view(np.uint64))
    kind = counts["kind"].to_numpy(np.int64)
    table[place, kind // FOLDS, kind % FOLDS] = counts["n"].to_numpy(np.int64)
    # What each part's lexicon has seen: all other parts; the last one has seen all.
    seen = np.concatenate((table.sum(2)[:, :, None] - table, table.sum(2)[:, :, None]), 2)
    of = np.concatenate((total.sum(1)[:, None] - total, total.sum(1)[:, None]), 1)
    odds = np.log((seen[:, 1] + 0.5) / (of[1] + 1)) - np.log((seen[:, 0] + 0.5) / (of[0] + 1))
    weights = np.where((odds >= WEAK) & (seen[:, 1] >= LEAST_TOXIC - 1), np.minimum(odds, MOST), 0.0)
    used = (weights > 0).any(1)
    return Lexicon(wanted[used], weights[used], _second_persons())


def features(found: Read, lexicon: Lexicon, part: np.ndarray) -> np.ndarray:
    """The features of the rows read, one row each; ``part`` names each row's lexicon."""
    rows = found.last - found.first
    sizes = np.diff(found.bounds)
    row = np.repeat(np.arange(rows), sizes)
    own = terms(found)
    weight = lexicon.word_weights(own, part[row]) if len(lexicon.terms) else np.zeros(len(own))
    strong = weight >= STRONG
    you = np.isin(own[:, 0], lexicon.second)
    # Whether one of the NEAR words on either side, in the same row, is a second person.
    upto = np.concatenate(([0], np.cumsum(you)))
    at = np.arange(len(own))
    near = upto[np.minimum(at + NEAR + 1, found.bounds[row + 1])] > upto[np.maximum(at - NEAR, found.bounds[row])]

    def total(x: np.ndarray) -> np.ndarray:
        return np.bincount(row, x, rows)

    highest = np.zeros(rows)
    np.maximum.at(highest, row, weight)
    many = np.maximum(sizes, 1)
    hits = total(strong)
    return np.stack(
        [
            hits / many,
            total((weight >= WEAK) & ~strong) / many,
            np.log1p(hits),
            highest,
            total(weight) / many,
            total(strong & near) / np.maximum(hits, 1),
            total(you) / many,
            found.rates[:, 0],
            total(found.capitals) / many,
            found.rates[:, 1],
            found.rates[:, 2],
            total(found.changed) / many,
            total(found.repeated) / many,
            np.log1p(sizes),
        ],
        1,
    )


def with_features(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``rows`` (columns, then part and text, last) with features in place of part and text."""
    names = rows.columns[:-2]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.array(batch.column(len(names)), np.int64)
            table = [np.zeros((0, len(FEATURES)))]
            for found in read(batch.column(len(names) + 1)):
                table.append(features(found, lexicon, part[found.first : found.last]))
            flat = np.concatenate(table)
            offsets = pa.array(np.arange(len(flat) + 1) * len(FEATURES), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], lists], [*names, "features"])

    return rows.mapInArrow(work, f"{schema}, features array<double>")


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from training: crc32 of its id as text, mod 5, is 0."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def labelled(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Distinct labelled documents to learn from: toxic, part, text; written once.

    The labels chosen are at most about ``fit_rows`` ids and so go to every task.
    """
    known = (
        labels.filter("doc_id is not null and toxic in (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("toxic") > 0.5).cast("int").alias("toxic"))
    )
    many = known.count()
    # Hashes are spread over 2^20 values; a share of them is a share of the ids.
    limit = (1 << 20) if many <= fit_rows else (fit_rows << 20) // many
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < limit)
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    return staged(rows.distinct().select("toxic", part.alias("part"), "text"), "labelled")


def _margin(model, df: DataFrame, name: str) -> DataFrame:
    found = model.setRawPredictionCol("_raw").setProbabilityCol("").setPredictionCol("").transform(df)
    return found.withColumn(name, vector_to_array("_raw")[1]).drop("_raw")


@dataclass
class Classifier:
    """Two ensembles of trees, and the calibration of their scores."""

    lexicon: Lexicon
    halves: list
    calibration: object

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with part and text last; score in their place."""
        found = with_features(rows, self.lexicon).withColumn("features", array_to_vector("features"))
        for name, model in zip(("_even", "_odd"), self.halves, strict=True):
            found = _margin(model, found, name)
        found = found.withColumn("_margin", (F.col("_even") + F.col("_odd")) / 2)
        scored = self.calibration.transform(found)
        return scored.select(*rows.columns[:-2], F.least(F.greatest("_score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def train(fit: DataFrame) -> Classifier | float:
    """Learn from ``labelled`` rows; the share of toxic ones where they are too few."""
    found = fit.groupBy("toxic", "part").count().collect()
    many = {row["toxic"] * FOLDS + row["part"]: row["count"] for row in found}
    total = sum(many.values())
    kinds = {(key // FOLDS, key % FOLDS % 2) for key in many}
    if len(kinds) < 4:
        return sum(n for key, n in many.items() if key >= FOLDS) / max(total, 1)
    lexicon = learn_lexicon(fit, many)
    rows = fit.select(F.col("toxic").cast("double").alias("label"), F.col("part").alias("own"), "part", "text")
    table = staged(with_features(rows, lexicon), "features").withColumn("features", array_to_vector("features"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, maxBins=BINS, seed=7)
    even, odd = F.col("own") % 2 == 0, F.col("own") % 2 == 1
    halves = [trees.fit(table.filter(half)) for half in (even, odd)]
    seen = [_margin(halves[1], table.filter(even), "_margin"), _margin(halves[0], table.filter(odd), "_margin")]
    # Scores in STEPS steps: what the calibration is fitted on does not grow with the labels.
    step = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-2 * F.col("_margin"))) * STEPS)
    bins = (
        seen[0]
        .unionByName(seen[1])
        .groupBy(step.alias("step"))
        .agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("n"), F.avg("_margin").alias("_margin"))
    )
    isotonic = IsotonicRegression(featuresCol="_margin", labelCol="label", weightCol="n", predictionCol="_score")
    return Classifier(lexicon, halves, isotonic.fit(bins.coalesce(1)))


def score(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted.

    ``documents`` needs doc_id and text, ``labels`` doc_id and toxic.
    """
    model = train(labelled(documents, labels, fit_rows))
    rows = documents.select(
        F.col("doc_id").cast("long"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.lit(FOLDS).alias("part"),
        "text",
    )
    scored = (
        model.score(rows)
        if isinstance(model, Classifier)
        else rows.select("doc_id", "held_out", F.lit(float(model)).alias("score"))
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
