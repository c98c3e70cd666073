"""Approximate nearest neighbours by inner product: balanced posting lists.

Vectors are grouped around centroids. Centroids come from balanced k-means over a bounded
sample (SAMPLE vectors, in hash order), in which crowded centroids cost more. Every vector
is indexed: it goes to the list of its nearest centroid, and a vector near a boundary also
to the lists of others not farther than BOUNDARY times that distance, at most COPIES of
them. Centroids are searched through a graph of their neighbours that each task holds in
memory (beam search, all vectors of a batch in step). A query searches all lists whose
centroid is not farther than a ratio times the nearest one; its beam grows until it has
passed that. The ratio is found from the data: a sample of SAMPLED queries is answered by
brute force, and it is the least at which their lists hold the share RECALL of those
answers. No number of lists bounds a search. The FIRST lists of a query are searched before
the others, which then give only what is at least as near as the worst of its answers.

Inner product becomes distance by one more component that gives all vectors the norm of
the longest. Equal vectors are one entry with its smallest ids, as many as an answer can
hold, so a vector that fills a third of the table is one entry. Lists larger than
PART_ROWS are searched in parts by different tasks. Queries that find too few candidates
search all lists. The scores returned are computed from the original vectors.

Vectors that are null, empty, zero, hold null or non-finite components or differ from the
most common length take no part, as queries neither. Rows with equal id and vector count
once. Ids must not be null. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.sources.staging import staged

SAMPLE = 1 << 15
LIST_ROWS = 400
ROUNDS = 12
NEIGHBOURS = 16
BEAM = 48
BOUNDARY, COPIES = 1.1, 4
SAMPLED, RECALL = 512, 0.98
PART_ROWS = 4000
SPARE = 8
FIRST = 8


@dataclass
class Centroids:
    """Centroids in the augmented space, their neighbours, and where a search starts."""

    points: np.ndarray
    near: np.ndarray
    starts: np.ndarray
    norm: float

    def lifted(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        if query:
            rest = np.zeros(len(vectors))
        else:
            rest = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(1), 0))
        return np.concatenate((vectors, rest[:, None]), 1)

    def search(self, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids of each vector and their distances, by beam search."""
        rows, width = len(vectors), max(BEAM, most)
        everyone = np.arange(rows)[:, None]
        seen = np.zeros((rows, len(self.points)), bool)
        seen[:, self.starts] = True
        beam = np.broadcast_to(self.starts, (rows, len(self.starts))).copy()
        far = self._distances(vectors, beam)
        done = np.zeros(beam.shape, bool)
        while True:
            waiting = np.where(done, np.inf, far)
            best = waiting.argmin(1)
            live = np.flatnonzero(np.isfinite(waiting[np.arange(rows), best]))
            if not len(live):
                break
            done[live, best[live]] = True
            ring = np.zeros((rows, self.near.shape[1]), np.int64)
            ring[live] = self.near[beam[live, best[live]]]
            fresh = np.zeros(ring.shape, bool)
            fresh[live] = ~seen[live[:, None], ring[live]]
            seen[live[:, None], ring[live]] = True
            away = np.full(ring.shape, np.inf)
            away[live] = np.where(fresh[live], self._distances(vectors[live], ring[live]), np.inf)
            beam = np.concatenate((beam, ring), 1)
            far = np.concatenate((far, away), 1)
            done = np.concatenate((done, ~fresh), 1)
            order = np.argsort(far, axis=1, kind="stable")[:, :width]
            beam, far, done = beam[everyone, order], far[everyone, order], done[everyone, order]
        return beam[:, :most], far[:, :most]

    def within(self, vectors: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All centroids within ``ratio`` of the nearest: rows, centroids and their places.

        The beam doubles for the rows whose farthest centroid found is still within.
        """
        out, left, most = [], np.arange(len(vectors)), BEAM
        while len(left):
            most = min(most, len(self.points))
            ids, far = self.search(vectors[left], most)
            near = np.isfinite(far) & (far <= far[:, :1] * ratio + 1e-12 if np.isfinite(ratio) else True)
            ended = ~near[:, -1] if most < len(self.points) else np.ones(len(left), bool)
            row, place = np.nonzero(near & ended[:, None])
            out.append((left[row], ids[row, place], place))
            left, most = left[~ended], 2 * most
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Distances of each vector to all centroids."""
        squares = (vectors**2).sum(1)[:, None] + (self.points**2).sum(1) - 2 * vectors @ self.points.T
        return np.sqrt(np.maximum(squares, 0))

    def _distances(self, vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Distances to a few centroids of each vector."""
        dots = np.einsum("nd,nkd->nk", vectors, self.points[ids])
        squares = (vectors**2).sum(1)[:, None] + (self.points**2).sum(1)[ids] - 2 * dots
        return np.sqrt(np.maximum(squares, 0))


def _balanced(points: np.ndarray, count: int) -> np.ndarray:
    """k-means in which the cost of a centroid grows while it holds more than its share."""
    chosen = np.random.default_rng(3).choice(len(points), count, replace=False)
    centres, extra = points[np.sort(chosen)].copy(), np.zeros(count)
    share = len(points) / count
    for _ in range(ROUNDS):
        squares = (centres**2).sum(1) - 2 * points @ centres.T
        scale = float(np.mean(squares.min(1) + (points**2).sum(1)))
        own = (squares + extra * scale).argmin(1)
        held = np.bincount(own, minlength=count)
        extra += 0.1 * (held / share - 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        full = held > 0
        centres[full] = sums[full] / held[full, None]
    return centres


def fit(entries: DataFrame, total: int, norm: float) -> Centroids:
    """Centroids for about LIST_ROWS entries a list; a bounded sample reaches the driver."""
    sample = entries.orderBy(F.xxhash64("smallest"), "smallest").limit(SAMPLE).select("vector").collect()
    points = np.array([row.vector for row in sample], np.float64)
    rest = np.sqrt(np.maximum(norm**2 - (points**2).sum(1), 0))
    points = np.concatenate((points, rest[:, None]), 1)
    count = max(1, min(total // LIST_ROWS, len(points) // 8))
    centres = _balanced(points, count)
    squares = (centres**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * centres @ centres.T
    np.fill_diagonal(squares, np.inf)
    near = np.argsort(squares, axis=1)[:, : min(NEIGHBOURS, max(count - 1, 1))]
    # A ring through all centroids keeps the graph in one piece.
    near = np.concatenate((near, ((np.arange(count) + 1) % count)[:, None]), 1)
    starts = np.linspace(0, count - 1, min(count, 16)).astype(np.int64)
    return Centroids(centres, near, np.unique(starts), norm)


def _posted(batch: pa.RecordBatch, row: np.ndarray, lists: np.ndarray) -> pa.RecordBatch:
    rows = pa.array(row)
    columns = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(lists)]
    return pa.RecordBatch.from_arrays(columns, ["entry", "vector", "list"])


def _assigner(centroids: Centroids):
    """Entries to the lists of the nearest centroids."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                vectors = _matrix(part.column(1))
                lists, far = centroids.search(centroids.lifted(vectors, False), COPIES)
                near = np.isfinite(far) & (far <= far[:, :1] * BOUNDARY + 1e-12)
                row, place = np.nonzero(near)
                yield _posted(part, row, lists[row, place])

    return assign


def _chooser(centroids: Centroids, ratio: float):
    """The lists that each query searches, by rising distance."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                row, lists, place = centroids.within(centroids.lifted(_matrix(part.column(1)), True), ratio)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(lists), pa.array(place)],
                    ["query", "list", "place"],
                )

    return choose


def _scanner(asked: np.ndarray, queries: np.ndarray, most: int):
    """The best entries of a task for each of a few queries, the query itself left out."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = np.full((len(asked), most), -np.inf)
        held = np.full((len(asked), most), -1, np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                own = np.asarray(part.column(0))
                scores = asked @ _matrix(part.column(1)).T
                scores[queries[:, None] == own] = -np.inf
                near = np.concatenate((near, scores), 1)
                held = np.concatenate((held, np.broadcast_to(own, scores.shape)), 1)
                best = np.argpartition(-near, most - 1, axis=1)[:, :most]
                near, held = np.take_along_axis(near, best, 1), np.take_along_axis(held, best, 1)
        row, place = np.nonzero(np.isfinite(near))
        columns = [pa.array(queries[row]), pa.array(held[row, place]), pa.array(near[row, place])]
        yield pa.RecordBatch.from_arrays(columns, ["query", "entry", "near"])

    return scan


def _binding_ratio(
    centroids: Centroids, entries: DataFrame, posted: DataFrame, asked: DataFrame, k: int, recall: float
) -> float:
    """The least ratio at which the lists searched hold ``recall`` of the nearest entries.

    Measured with the exact answers of at most SAMPLED queries, chosen by hash.
    """
    sample = asked.orderBy(F.xxhash64("smallest"), "smallest").limit(SAMPLED).select("entry", "vector").collect()
    if not sample:
        return 1.0
    queries = np.array([row.entry for row in sample], np.int64)
    vectors = np.array([row.vector for row in sample], np.float64)
    best = Window.partitionBy("query").orderBy(F.desc("near"), "entry")
    nearest = (
        entries.select("entry", "vector")
        .mapInArrow(_scanner(vectors, queries, k), "query long, entry long, near double")
        .withColumn("_n", F.row_number().over(best))
        .filter(F.col("_n") <= k)
    )
    held = (
        posted.select("entry", "list")
        .join(F.broadcast(nearest.select("query", "entry")), "entry")
        .groupBy("query", "entry")
        .agg(F.collect_list("list").alias("lists"))
        .collect()
    )
    far = centroids.distances(centroids.lifted(vectors, True))
    first = far.min(1)
    place = {query: i for i, query in enumerate(queries.tolist())}
    ratios = []
    for row in held:
        at = place[row.query]
        least = far[at, row.lists].min()
        ratios.append(1.0 if least <= first[at] else least / first[at] if first[at] > 0 else np.inf)
    return float(np.quantile(ratios, recall, method="higher")) * (1 + 1e-9) if ratios else 1.0


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = np.asarray(column.flatten(), np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _nearest(most: int):
    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best entries of one part of a list for each query that searches it."""
        out: list[tuple[np.ndarray, ...]] = []
        if len(left) and len(right):
            entries, vectors = np.asarray(left["entry"]), _matrix(left["vector"])
            smallest = np.asarray(left["smallest"])
            order = np.argsort(smallest, kind="stable")
            entries, vectors, smallest = entries[order], vectors[order], smallest[order]
            queries, asked = np.asarray(right["query"]), _matrix(right["vector"])
            least = np.asarray(right["least"])
            for first in range(0, len(asked), 256):
                scores = asked[first : first + 256] @ vectors.T
                best = np.argsort(-scores, axis=1, kind="stable")[:, :most]
                near = np.take_along_axis(scores, best, 1)
                row, place = np.nonzero(near >= least[first : first + 256, None])
                held = best[row, place]
                out.append((queries[first + row], entries[held], near[row, place], smallest[held]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        names = ["query", "entry", "near", "smallest"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    return nearest


def inner(left: str, right: str) -> Column:
    """Inner product in double precision, summed from the first component on."""
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (double, -0 as 0) of the rows that take part, each once."""
    fine = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists("vector", lambda x: x != 0)
    rows = (
        vectors.select(
            F.col("vec_id").cast("long"),
            F.transform(F.col("embedding").cast("array<double>"), lambda x: x + 0.0).alias("vector"),
        )
        .filter("vec_id is not null and size(vector) > 0")
        .filter(fine)
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size")
    first = sizes.first()
    return rows.filter(F.size("vector") == (first["size"] if first else 0)).distinct()


def neighbours(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = RECALL) -> DataFrame:
    """The k nearest of all other vectors for each query: query_id, rank, vec_id, score."""
    rows = staged(usable(vectors), "vectors")
    # Equal vectors: an answer never holds more of them than its size, and the query itself.
    own = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(own)).filter(F.col("_n") <= k + 1)
    groups = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = staged(
        groups.withColumn("smallest", F.col("ids")[0]).withColumn(
            "entry", F.monotonically_increasing_id()
        ),
        "entries",
    )
    total = entries.count()
    longest = entries.agg(F.max(F.sqrt(inner("vector", "vector")))).first()[0] or 0.0
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    asked = staged(
        queries.join(entries.select("vector", F.col("entry").alias("query")), "vector").select(
            "query_id", "query"
        ),
        "queries",
    )
    if total == 0:
        return _empty(rows)
    centroids = fit(entries, total, longest)
    posted = staged(
        entries.select("entry", "vector")
        .mapInArrow(_assigner(centroids), "entry long, vector array<double>, list long")
        .join(entries.select("entry", "smallest"), "entry"),
        "postings",
    )
    parts = posted.groupBy("list").agg(
        F.ceil(F.count("*") / F.lit(PART_ROWS)).cast("int").alias("parts")
    )
    one_each = asked.select("query").distinct().join(entries, F.col("query") == F.col("entry"))
    ratio = _binding_ratio(centroids, entries, posted, one_each, k, recall)
    searches = staged(
        one_each.select("entry", "vector").mapInArrow(
            _chooser(centroids, ratio), "query long, list long, place long"
        ),
        "searches",
    )
    early = F.col("place") < FIRST
    near = staged(_searched(posted, parts, _asked(searches.filter(early), entries), k), "near")
    rest = _asked(searches.filter(~early), entries, _worst(near, k))
    found = staged(_best(near.unionAll(_searched(posted, parts, rest, k)), k).select("query", "entry"), "found")
    # Queries with too few candidates search every list.
    held = found.groupBy("query").agg(F.count("*").alias("held"))
    enough = min(k + 1, total)
    poor = asked.select("query").distinct().join(held.filter(F.col("held") >= enough), "query", "left_anti")
    if not poor.isEmpty():
        every = poor.withColumn("list", F.explode(F.expr(f"sequence(0L, {len(centroids.points) - 1}L)")))
        again = _searched(posted, parts, _asked(every, entries), k)
        found = staged(found.join(poor, "query", "left_anti").unionAll(again.select(found.columns)), "found")
    return _answers(found, entries, asked, k)


def _asked(searches: DataFrame, entries: DataFrame, worst: DataFrame | None = None) -> DataFrame:
    """Searches of a list with the query's vector, and the least product worth returning."""
    vectors = entries.select(F.col("entry").alias("query"), "vector")
    rows = searches.select("query", "list").join(vectors, "query")
    if worst is None:
        return rows.withColumn("least", F.lit(float("-inf")))
    least = F.coalesce("least", F.lit(float("-inf")))
    return rows.join(worst, "query", "left").withColumn("least", least)


def _worst(near: DataFrame, k: int) -> DataFrame:
    """The worst product of the queries that already have as many answers as are kept."""
    rows = near.groupBy("query").agg(F.min("near").alias("least"), F.count("*").alias("held"))
    return rows.filter(F.col("held") >= k + 1 + SPARE).select("query", "least")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best entries of each query, with some to spare for the exact order."""
    once = found.groupBy("query", "entry", "smallest").agg(F.max("near").alias("near"))
    order = Window.partitionBy("query").orderBy(F.desc("near"), "smallest")
    kept = once.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1 + SPARE)
    return kept.select("query", "entry", "near", "smallest")


def _searched(posted: DataFrame, parts: DataFrame, searches: DataFrame, k: int) -> DataFrame:
    """The best entries of each query over the lists it searches: query, entry, near, smallest."""
    split = posted.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("entry"), "parts"))
    asked = searches.join(parts, "list").withColumn(
        "part", F.explode(F.expr("sequence(0L, parts - 1L)"))
    )
    return _best(
        split.select("list", "part", "entry", "vector", "smallest")
        .groupBy("list", "part")
        .cogroup(asked.select("list", "part", "query", "vector", "least").groupBy("list", "part"))
        .applyInArrow(_nearest(k + 1 + SPARE), "query long, entry long, near double, smallest long"),
        k,
    )


def _answers(found: DataFrame, entries: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Exact scores of the entries found, spread over their ids and the queries' own."""
    left = entries.select(F.col("entry").alias("query"), F.col("vector").alias("_q"))
    right = entries.select("entry", F.col("vector").alias("_v"), "ids")
    scored = found.join(left, "query").join(right, "entry").select(
        "query", inner("_q", "_v").alias("score"), F.explode("ids").alias("vec_id")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = (
        scored.withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= k + 1)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct("_n", "vec_id", "score"))).alias("list"))
    )
    mine = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), F.lit(1), F.lit(k))
    return (
        asked.join(best, "query")
        .select("query_id", F.posexplode(mine).alias("_at", "_x"))
        .select(
            "query_id",
            (F.col("_at") + 1).alias("rank"),
            F.col("_x.vec_id").alias("vec_id"),
            F.col("_x.score").alias("score"),
        )
    )


def _empty(rows: DataFrame) -> DataFrame:
    return rows.filter(F.lit(False)).selectExpr(
        "vec_id as query_id", "1 as rank", "vec_id", "0D as score"
    )
