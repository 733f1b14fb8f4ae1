"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

Largest inner product becomes smallest distance by one added coordinate.  All
vectors are turned by one random rotation, so that the first coordinates of a
difference estimate its whole length.  Within each probed list, candidates are
scanned in blocks of columns; after each block a hypothesis test abandons those
whose partial distance already shows that they are too far.  Survivors get
their exact inner product on the original vectors.

Lists are fitted on a bounded sample in two levels, cells of coarse lists, so
their number grows with the rows and their length does not; every vector is
filed and stored once, and only queries travel.  A large list (many copies of
one vector) is cut into parts.  First each query is answered by its nearest
lists alone; its k-th score there is the bound with which the test is run in
all other probed lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, stored

#: Bounds of the fitted sample: rows, and numbers in them.
SAMPLE_ROWS, SAMPLE_NUMBERS = 16_384, 4_000_000
#: Rows of a list, about, and lists of the first and of the second level at most.
LIST_ROWS, COARSE, FINE = 256, 1_024, 1_024
#: Recall on the sample that the number of probed lists must reach, and the share of them that gives the bound.
TARGET_RECALL, FIRST = 0.97, 0.04
#: Vectors in a shard at most; queries of a shard scanned at once.
SHARD_ROWS, TOGETHER = 4_096, 256
#: Columns in a block of the scan, and width of the test (larger: fewer wrong abandonments).
COLUMNS, WIDTH = 16, 2.1


@dataclass(frozen=True)
class Lists:
    """The rotation, the largest norm, centroids of both levels in the rotated space, and how many of each to probe."""

    rotation: np.ndarray
    top: float
    coarse: np.ndarray
    fine: np.ndarray             # of what the coarse centroid leaves over; one row of zeros if there is no second level
    probes: int = 1
    cells: int = 1

    def turned(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the added coordinate, rotated."""
        rest = np.sqrt(np.maximum(self.top ** 2 - (x * x).sum(axis=1), 0))
        return np.column_stack([x, rest]) @ self.rotation

    def turned_queries(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q, np.zeros(len(q))]) @ self.rotation

    def home(self, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and cell of each row."""
        at = distances(turned, self.coarse).argmin(axis=1)
        return at, distances(turned - self.coarse[at], self.fine).argmin(axis=1)

    def nearest_lists(self, turned: np.ndarray) -> np.ndarray:
        """The lists to probe for each query, nearest first."""
        return np.argsort(distances(turned, self.coarse), axis=1, kind="stable")[:, :self.probes]

    def nearest_cells(self, turned: np.ndarray, at: int) -> np.ndarray:
        """Whether each query probes each cell of list ``at``."""
        if self.cells >= len(self.fine):
            return np.ones((len(turned), len(self.fine)), dtype=bool)
        order = np.argpartition(distances(turned - self.coarse[at], self.fine), self.cells - 1, axis=1)[:, :self.cells]
        out = np.zeros((len(turned), len(self.fine)), dtype=bool)
        np.put_along_axis(out, order, True, axis=1)
        return out


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances but for the rows' own norms."""
    return (centroids ** 2).sum(axis=1) - 2 * x @ centroids.T


def k_means(x: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    c = x[rng.choice(len(x), n, replace=False)]
    for _ in range(8):
        at = distances(x, c).argmin(axis=1)
        sums, size = np.zeros_like(c), np.bincount(at, minlength=n)
        np.add.at(sums, at, x)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], c)
    return c


def fit(sample: np.ndarray, rows: int, top: float, k: int, seed: int = 5) -> Lists:
    """Rotation, lists of about LIST_ROWS of the ``rows``, and probes for TARGET_RECALL on the sample."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    wanted, most = max(1, -(-rows // LIST_ROWS)), max(1, len(sample) // 16)
    x = Lists(rotation, top, np.zeros((1, dim)), np.zeros((1, dim))).turned(sample)
    coarse = k_means(x, min(COARSE, wanted, most), rng)
    n_fine = min(FINE, most, -(-wanted // len(coarse)))
    at = distances(x, coarse).argmin(axis=1)
    fine = k_means(x - coarse[at], n_fine, rng) if n_fine > 1 else np.zeros((1, dim))
    lists = Lists(rotation, top, coarse, fine)
    # at which rank sampled queries have the lists, and within them the cells, of their true neighbours
    at, cell = lists.home(x)
    pick = rng.choice(len(x), min(256, len(x)), replace=False)
    score = sample[pick] @ sample.T
    score[np.arange(len(pick)), pick] = -np.inf
    near = np.argsort(-score, axis=1)[:, :min(k, max(len(x) - 1, 1))]
    q = lists.turned_queries(sample[pick])

    def needed(ranks: list[np.ndarray], target: float) -> int:
        """So many of the nearest hold the share ``target`` of the true neighbours."""
        r = np.sort(np.concatenate(ranks).ravel())
        return int(r[min(len(r) - 1, int(np.ceil(target * len(r))))]) + 1

    def rank(d: np.ndarray, of: np.ndarray) -> np.ndarray:
        return (d[:, None, :] < np.take_along_axis(d, of, axis=1)[:, :, None]).sum(axis=2)

    if not near.size:
        return Lists(rotation, top, coarse, fine, len(coarse), n_fine)
    target = TARGET_RECALL if n_fine == 1 else TARGET_RECALL ** 0.5
    probes = needed([rank(distances(q[i:i + 16], coarse), at[near[i:i + 16]]) for i in range(0, len(q), 16)], target)
    cells = 1
    if n_fine > 1:
        cells = needed([rank(distances(one - coarse[at[n]], fine), cell[n][:, None]) for one, n in zip(q, near)], target)
    return Lists(rotation, top, coarse, fine, min(probes, len(coarse)), min(cells, n_fine))


def scan(q: np.ndarray, bound: np.ndarray, x: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries, rows) of the pairs that no test abandons, of those ``alive`` at first.

    ``bound``: squared distance of some k-th neighbour of each query that is
    known already.  Blocks of columns are added while pairs live: for the whole
    list by one product while many do, pair by pair once few are left.
    """
    dim, partial = q.shape[1], np.zeros(alive.shape)
    i = j = None
    for start in range(0, dim, COLUMNS):
        a, b = q[:, start:start + COLUMNS], x[:, start:start + COLUMNS]
        seen = min(start + COLUMNS, dim)
        factor = 1.0 if seen == dim else (1 + WIDTH / seen ** 0.5) ** 2 * seen / dim
        limit = bound * factor + 1e-9 * (1 + np.abs(bound))
        if i is None:
            partial += (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
            alive = alive & (partial <= limit[:, None])
            if 8 * np.count_nonzero(alive) < alive.size:
                i, j = np.nonzero(alive)
                partial = partial[i, j]
        else:
            partial = partial + ((a[i] - b[j]) ** 2).sum(axis=1)
            ok = partial <= limit[i]
            i, j, partial = i[ok], j[ok], partial[ok]
    return np.nonzero(alive) if i is None else (i, j)


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, ties to the smaller id, an id once by its best row."""
    order = np.lexsort((-score, ids, query))
    first = np.r_[True, (np.diff(query[order]) != 0) | (np.diff(ids[order]) != 0)] if len(order) else np.zeros(0, dtype=bool)
    order = order[first]
    order = order[np.lexsort((ids[order], -score[order], query[order]))]
    n = np.bincount(query[order]) if len(order) else np.zeros(0, dtype=np.int64)
    return order[np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n) < k]


class Shard:
    """The rows of a shard, by list."""

    def __init__(self, lists: Lists, ids: np.ndarray, home: np.ndarray, cell: np.ndarray, v: np.ndarray):
        order = np.argsort(home, kind="stable")
        self.lists, self.ids, self.cell, self.v = lists, ids[order], cell[order], v[order]
        self.turned = lists.turned(self.v)
        home = home[order]
        names, begin = np.unique(home, return_index=True)
        self.spans = {h: (a, b) for h, a, b in zip(names.tolist(), begin.tolist(), [*begin[1:].tolist(), len(home)])}

    def search(self, ids: np.ndarray, q: np.ndarray, low: np.ndarray, probed: list, k: int) -> tuple:
        """(queries, ids, scores) of the k best in the probed lists; ``low``: a known k-th score, or minus infinity."""
        turned, by = self.lists.turned_queries(q), {}
        for i, some in enumerate(probed):
            for at in some:
                by.setdefault(at, []).append(i)
        norm = (q * q).sum(axis=1) + self.lists.top ** 2
        found: list[tuple] = []
        for at, who in by.items():
            a, b = self.spans.get(at, (0, 0))
            who = np.array(who)
            probe = self.lists.nearest_cells(turned[who], at)
            for s in range(a, b, SHARD_ROWS):
                e = min(b, s + SHARD_ROWS)
                alive = probe[:, self.cell[s:e]] & (ids[who][:, None] != self.ids[s:e])
                if not alive.any():
                    continue
                i, j = scan(turned[who], norm[who] - 2 * low[who], self.turned[s:e], alive)
                i, j = who[i], j + s
                score = np.einsum("ij,ij->i", self.v[j], q[i])
                keep = best(i, self.ids[j], score, k)
                found.append((i[keep], self.ids[j[keep]], score[keep]))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        i, j, score = (np.concatenate(x) for x in zip(*found))
        keep = best(i, j, score, k)
        return ids[i[keep]], j[keep], score[keep]


def _matrix(c: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(c.flatten(), dtype=float).reshape(len(c), dim)


def _answer(batches: Iterator[pa.RecordBatch], lists: Lists, dim: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, asks, id, low, lists, list, cell, v) in order of shard, a shard's vectors before the queries that ask it."""
    now, parts, shard = None, [], None
    for batch in batches:
        number, asks = batch.column(0).to_numpy(), np.asarray(batch.column(1).to_numpy(zero_copy_only=False))
        cuts = np.flatnonzero(np.r_[True, (np.diff(number) != 0) | (asks[1:] != asks[:-1]), True]) if len(number) else []
        for low, high in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(low, high - low)
            ids, v = part.column(2).to_numpy(), _matrix(part.column(7), dim)
            if number[low] != now:
                now, parts, shard = number[low], [], None
            if not asks[low]:
                parts.append((ids, part.column(5).to_numpy(), part.column(6).to_numpy(), v))
                continue
            if shard is None and parts:
                shard, parts = Shard(lists, *(np.concatenate(x) for x in zip(*parts))), []
            for i in range(0, len(ids) if shard else 0, TOGETHER):
                some = slice(i, i + TOGETHER)
                got = shard.search(ids[some], v[some], part.column(3).to_numpy()[some], part.column(4).slice(i, TOGETHER).to_pylist(), k)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], names=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id",
           embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query, by largest inner product.

    Queries are the rows whose id is divisible by ``every``, candidates all
    rows with another id.  Null ids, and vectors that are null, empty, zero,
    hold null or non-finite components or have another length than most take
    no part.  Equal scores go to the smaller id; a repeated id counts once, by
    its best row; fewer candidates than k give fewer rows; an empty table gives
    an empty result.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    x = vectors.select(col(vec_id).cast("bigint").alias("vec_id"), col(embedding).cast("array<double>").alias("v")) \
        .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)) \
        .filter(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))) \
        .filter(F.exists(v, lambda c: c != 0))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, c: a + c * c))
    sizes = x.groupBy(F.size(v).alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("top")) \
        .orderBy(F.desc("n"), "dim").first()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if sizes is None:
        return spark.createDataFrame([], result)
    dim, parallel = int(sizes["dim"]), spark.sparkContext.defaultParallelism
    x = x.filter(F.size(v) == dim)
    rows = min(SAMPLE_ROWS, max(64, SAMPLE_NUMBERS // dim))
    taken = x.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).select("v").toPandas()
    lists = fit(np.stack(taken["v"].to_numpy()), sizes["n"], float(sizes["top"]) * (1 + 1e-9), k)
    shared = spark.sparkContext.broadcast(lists)                                   # at most COARSE + FINE centroids

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in (b.slice(i, 2048) for i in range(0, b.num_rows, 2048)):
                at, cell = shared.value.home(shared.value.turned(_matrix(p.column(1), dim)))
                # the place in the batch deals the rows of a large list, copies and repeated ids too, over its parts
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(cell.astype(np.int32)),
                                                  pa.array(np.arange(p.num_rows, dtype=np.int32)), *p.columns],
                                                 names=["list", "cell", "deal", "vec_id", "v"])

    filed = stored(x.mapInArrow(file, "list int, cell int, deal int, vec_id bigint, v array<double>"), "filed-vectors")
    count = dict(filed.groupBy("list").count().collect())                          # at most COARSE rows
    # pack lists into shards in order; a list larger than a shard is dealt over several of its own
    most = min(SHARD_ROWS, max(1_024, -(-sizes["n"] // (4 * parallel))))
    first, spread, shard, room = {}, {}, -1, 0
    for at in sorted(count):
        n = -(-count[at] // most)
        if n > 1 or count[at] > room:
            shard, room = shard + 1, most
        first[at], spread[at] = shard, n
        room -= count[at]
        if n > 1:
            shard, room = shard + n - 1, 0
    shards = shard + 1
    place = spark.createDataFrame([(a, first[a], spread[a]) for a in first], "list int, first int, spread int")
    part = F.col("first") + F.pmod(F.xxhash64("deal", "vec_id"), F.col("spread"))
    vectors_by = filed.join(F.broadcast(place), "list").select(
        part.cast("int").alias("shard"), F.lit(False).alias("asks"), F.col("vec_id").alias("id"), F.lit(0.0).alias("low"),
        F.lit(None).cast("array<int>").alias("lists"), "list", "cell", "v")
    names = vectors_by.columns
    homes = spark.sparkContext.broadcast((first, spread))                          # at most COARSE entries
    queries = stored(filed.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "ann-queries")

    def answers(asked: DataFrame, nearest: bool) -> DataFrame:
        """Queries (vec_id, v, low) sent to the shards of their nearest lists, or of all the others they probe."""
        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m, (at, over) = shared.value, homes.value
            cut = max(1, round(FIRST * m.probes))
            for b in batches:
                for p in (b.slice(i, 512) for i in range(0, b.num_rows, 512)):
                    near = m.nearest_lists(m.turned_queries(_matrix(p.column(1), dim)))
                    row, to, which = [], [], []
                    for i, mine in enumerate((near[:, :cut] if nearest else near[:, cut:]).tolist()):
                        by: dict[int, list[int]] = {}
                        for one in mine:
                            for s in range(at.get(one, 0), at.get(one, 0) + over.get(one, 0)):
                                by.setdefault(s, []).append(one)
                        row += [i] * len(by)
                        to += by
                        which += by.values()
                    row = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(to, pa.int32()), pa.array([True] * len(to), pa.bool_()), p.column(0).take(row), p.column(2).take(row),
                         pa.array(which, pa.list_(pa.int32())), pa.nulls(len(to), pa.int32()), pa.nulls(len(to), pa.int32()),
                         p.column(1).take(row)], names=names)

        sent = asked.select("vec_id", "v", "low").mapInArrow(probe, vectors_by.schema)
        both = vectors_by.unionByName(sent).repartition(shards, "shard").sortWithinPartitions("shard", "asks")
        return both.mapInArrow(lambda b: _answer(b, shared.value, dim, k), "query_id bigint, vec_id bigint, score double")

    def top(found: DataFrame) -> DataFrame:
        each = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return each.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)

    near = stored(top(answers(queries.withColumn("low", F.lit(float("-inf"))), True)), "ann-near")
    bounds = near.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "score")
    low = F.coalesce(F.col("score") - 1e-9 * (1 + F.abs("score")), F.lit(float("-inf")))
    rest = answers(queries.join(bounds, "vec_id", "left").withColumn("low", low), False)
    return top(near.drop("rank").unionByName(rest)) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
