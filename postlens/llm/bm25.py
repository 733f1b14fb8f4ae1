"""Exact BM25 top-k search over an inverted index with block-max pruning.

The documents are indexed in shards of bounded size, one stored row per shard.
Document frequencies and lengths are summed over all shards, so every shard
scores with the global statistics and the shards' best merge exactly.

Within a shard, documents come in blocks.  The lists of rare terms are added up
query by query, those of common terms for many queries at once, as a product of
single-precision matrices.  Widened by the product's largest error, the sums are
upper bounds: a block whose largest stays below the threshold is skipped, in the
others the documents that reach it are scored exactly, best block first while
the threshold rises.

Shards are searched in rounds, each of as many shards as all rounds before it:
a query's k-th score so far is the threshold that it takes into the next round.
So a round returns about k documents a query, not k for each shard.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, stored

K1, B = 1.2, 0.75
#: Documents, and bytes of text, in a shard at most (one document always fits).
SHARD_DOCS, SHARD_BYTES = 8_192, 32_000_000
#: Documents in a block.
BLOCK = 64
#: A term is common in a shard from this share of its documents on.
COMMON = 1 / 16
#: Queries that go through a shard's common terms in one product.
TOGETHER = 256
#: Queries that go through the index together.
QUERY_ROWS = 4_096
#: Shards of the first round.
FIRST_SHARDS = 8

# Tokens are runs of ASCII letters and digits (A-Z lower-cased) and of all characters beyond ASCII.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


#: ``turn`` in [0, 1) is the shard's place in the rounds.
_INDEX = ("shard string, turn double, n_docs int, n_terms bigint, total bigint, ids binary, lengths binary, terms binary, "
          "starts binary, docs binary, tfs binary")


class _Shard:
    """Postings under construction."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.ids, self.lengths, self.sizes = [], [], []
        self.terms, self.tfs, self.bytes = [], [], 0

    def add(self, doc_id: int, text: bytes | None) -> None:
        words = tokens(text)
        counts = Counter(words)
        place = self.place
        self.terms.append(np.fromiter((place.setdefault(t, len(place)) for t in counts), dtype=np.int32, count=len(counts)))
        self.tfs.append(np.fromiter(counts.values(), dtype=np.uint32, count=len(counts)))
        self.sizes.append(len(counts))
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.bytes += len(text or b"")

    def row(self, name: str) -> tuple:
        names = list(self.place)
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(names), dtype=np.int32)
        rank[order] = np.arange(len(names), dtype=np.int32)
        term = rank[np.concatenate(self.terms)] if names else np.zeros(0, np.int32)
        by = np.argsort(term, kind="stable")                     # documents stay in order within a term
        doc = np.repeat(np.arange(len(self.ids), dtype=np.uint16), self.sizes)[by]
        tf = np.concatenate(self.tfs)[by] if names else np.zeros(0, np.uint32)
        starts = np.searchsorted(term[by], np.arange(len(names) + 1)).astype(np.int32)
        return (name, zlib.crc32(name.encode()) / 2 ** 32, len(self.ids), len(names), int(sum(self.lengths)), np.array(self.ids, dtype=np.int64).tobytes(),
                np.array(self.lengths, dtype=np.int32).tobytes(), b" ".join(names[i] for i in order), starts.tobytes(),
                doc.tobytes(), tf.tobytes())


def build(docs: DataFrame) -> DataFrame:
    """One index row per shard of ``docs`` (doc_id, text as binary)."""
    columns = [x.split()[0] for x in _INDEX.split(", ")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        part, n, shard = TaskContext.get().partitionId(), 0, _Shard()

        def close():
            values = shard.row(f"{part}-{n}")
            kinds = (pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=columns)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                shard.add(doc_id, text.as_py())
                if len(shard.ids) >= SHARD_DOCS or shard.bytes >= SHARD_BYTES:
                    yield close()
                    shard, n = _Shard(), n + 1
        if shard.ids:
            yield close()

    return docs.mapInArrow(run, _INDEX)


class _Loaded:
    """A shard's postings of the asked terms, with contributions and block maxima."""

    def __init__(self, row, place: dict[bytes, int], idf: np.ndarray, mean: float):
        self.n = row["n_docs"]
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        names = row["terms"].split(b" ") if row["n_terms"] else []
        here = np.array([place.get(t, -1) for t in names], dtype=np.int64)
        starts = np.frombuffer(row["starts"], dtype=np.int32).astype(np.int64)
        docs, tfs = np.frombuffer(row["docs"], dtype=np.uint16), np.frombuffer(row["tfs"], dtype=np.uint32)
        asked = np.flatnonzero(here >= 0)
        size = starts[asked + 1] - starts[asked]
        post = np.repeat(starts[asked] - np.cumsum(size) + size, size) + np.arange(size.sum())
        self.doc = docs[post].astype(np.int64)
        tf = tfs[post].astype(float)
        norm = K1 * (1 - B + B * np.frombuffer(row["lengths"], dtype=np.int32) / mean)
        self.value = tf * (K1 + 1) / (tf + norm[self.doc]) * np.repeat(idf[here[asked]], size)
        self.start = np.full(len(idf), -1, dtype=np.int64)
        self.start[here[asked]] = np.cumsum(size) - size
        self.size = np.zeros(len(idf), dtype=np.int64)
        self.size[here[asked]] = size
        # common terms as rows over all documents: contributions, and the places of the exact ones (the last is 0)
        common = np.flatnonzero(self.size > max(4, COMMON * self.n))
        self.blocks = -(-self.n // BLOCK)
        self.dense = np.zeros((len(common), self.blocks * BLOCK), dtype=np.float32)
        self.post = np.full(self.dense.shape, -1, dtype=np.int32)
        for i, t in enumerate(common):
            span = slice(self.start[t], self.start[t] + self.size[t])
            self.dense[i, self.doc[span]] = self.value[span]
            self.post[i, self.doc[span]] = np.arange(span.start, span.stop)
        self.value = np.append(self.value, 0.0)
        # of a sum of positive numbers, each rounded: twice the largest relative error
        self.error = 2 * (len(common) + 8) * 2.0 ** -24
        self.row_of = np.full(len(idf), -1, dtype=np.int64)
        self.row_of[common] = np.arange(len(common))

    def search(self, asked: list[np.ndarray], own: list[int], k: int, least: list[float]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """:meth:`best` of every query."""
        for at in range(0, len(asked), TOGETHER):
            some = asked[at:at + TOGETHER]
            weights = np.zeros((len(some), len(self.dense)), dtype=np.float32)
            for i, terms in enumerate(some):
                rows = self.row_of[terms]
                weights[i, rows[rows >= 0]] = 1
            for i, common in enumerate(weights @ self.dense, start=at):
                yield self.best(asked[i], own[i], k, least[i], common)

    def best(self, terms: np.ndarray, own: int, k: int, least: float, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(doc ids, scores) of the k best documents with a positive score of at least ``least``, own id left out.

        ``common``: for each document, the sum of the common terms' contributions, to ``error``.
        """
        rows = self.row_of[terms]
        rare = terms[(rows < 0) & (self.size[terms] > 0)]
        rows = rows[rows >= 0]
        size = self.size[rare]
        post = np.repeat(self.start[rare] - np.cumsum(size) + size, size) + np.arange(size.sum())
        part = np.bincount(self.doc[post], self.value[post], self.blocks * BLOCK).astype(float)
        part[:self.n][self.ids == own] = -np.inf
        part[self.n:] = -np.inf
        near = part + common * (1 + self.error)
        floor = least
        if floor == -np.inf and near.size > k:
            floor = np.partition(near, -k)[-k] * (1 - 2 * self.error)        # a lower bound of the k-th score
        near = near.reshape(self.blocks, BLOCK)
        bound = near.max(axis=1)
        order = np.flatnonzero((bound >= floor - 1e-9) & (bound > 0))
        order = order[np.argsort(-bound[order], kind="stable")]
        found, score = np.zeros(0, dtype=np.int64), np.zeros(0)
        done, step = 0, 4
        while done < len(order) and bound[order[done]] >= floor - 1e-9:
            take = order[done:done + step]
            flat = near[take].ravel()
            at = np.flatnonzero((flat >= floor - 1e-9) & (flat > 0))
            doc = (take[:, None] * BLOCK + np.arange(BLOCK)).ravel()[at]
            whole = part[doc]
            if len(rows):
                whole = whole + self.value[self.post[np.ix_(rows, doc)]].sum(axis=0)
            at = (whole >= floor - 1e-9) & (whole > 0)
            found, score = np.concatenate([found, self.ids[doc[at]]]), np.concatenate([score, np.round(whole[at], 9)])
            if len(found) > k:
                o = np.lexsort((found, -score))[:k]
                found, score = found[o], score[o]
            if len(score) >= k:
                floor = max(floor, score.min())
            done, step = done + step, step * 2
        return found, score


def search(docs: DataFrame, every: int = 100, k: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """query_id, rank (from 1), doc_id, score: the k best documents of each query under BM25.

    Queries are the rows whose id is divisible by ``every``: all distinct
    tokens of their whole text.  Candidates are all rows with another id.
    Scores are rounded to nine decimals; ties go to the smaller id.  Null and
    empty texts match nothing (and count as documents); rows with a null id
    take no part; a repeated query id is one query, repeated candidate rows
    count each; documents sharing no token are not returned.
    """
    spark = docs.sparkSession
    x = docs.select(col(doc_id).cast("bigint").alias("doc_id"), col(text).cast("binary").alias("text")) \
        .filter(F.col("doc_id").isNotNull())
    index = stored(build(x), "bm25-index")
    sums = index.agg(F.sum("n_docs"), F.sum("total"), F.count("*")).first()
    result = "query_id bigint, rank int, doc_id bigint, score double"
    if not sums[0] or not sums[1]:
        return spark.createDataFrame([], result)
    n, mean = sums[0], sums[1] / sums[0]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"query_id": b["doc_id"], "terms": [b" ".join(sorted(set(tokens(t)))) for t in b["text"]]})

    queries = stored(x.filter(F.col("doc_id") % every == 0).mapInPandas(ask, "query_id bigint, terms binary")
                     .groupBy("query_id").agg(F.min("terms").alias("terms")), "bm25-queries")
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    found = None
    for block in range(blocks):                       # bounded blocks of the stated query set
        mine = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).toPandas()
        part = _search_block(index, mine, n, mean, k, sums[2])
        found = part if found is None else found.unionByName(part)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)


def _search_block(index: DataFrame, queries: pd.DataFrame, n: int, mean: float, k: int, shards: int) -> DataFrame:
    """(query_id, doc_id, score, rank): the best of all shards for every query of the block."""
    sc = index.sparkSession.sparkContext
    place: dict[bytes, int] = {}
    asked = [np.array([place.setdefault(t, len(place)) for t in (bytes(b).split(b" ") if len(b) else [])], dtype=np.int64)
             for b in queries["terms"]]
    ids = queries["query_id"].to_numpy()
    shared_place = sc.broadcast(place)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at = shared_place.value
        sums = np.zeros(len(at), dtype=np.int64)
        for b in batches:
            for names, starts in zip(b.column(0), b.column(1)):
                here = np.array([at.get(t, -1) for t in names.as_py().split(b" ")], dtype=np.int64)
                df = np.diff(np.frombuffer(starts.as_py(), dtype=np.int32))
                sums[here[here >= 0]] += df[here >= 0]             # a shard has a term once
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], names=["term", "df"])

    # a task adds up many shards before anything is shuffled: a row per task and asked term at most
    counted = index.filter("n_terms > 0").select("terms", "starts").coalesce(sc.defaultParallelism) \
        .mapInArrow(count, "term bigint, df bigint") \
        .groupBy("term").agg(F.sum("df").alias("df")).toPandas()                  # at most the block's terms
    df = np.zeros(len(place))
    df[counted["term"].to_numpy(dtype=np.int64)] = counted["df"].to_numpy()
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    rounds = max(0, int(np.ceil(np.log2(shards / FIRST_SHARDS))))
    best, least = None, np.full(len(ids), -np.inf)
    for i in range(rounds + 1):
        low, high = (0.0 if i == 0 else 2.0 ** (i - 1 - rounds)), 2.0 ** (i - rounds)
        part = _search_round(index.filter((F.col("turn") >= low) & (F.col("turn") < high)), shared_place,
                             sc.broadcast((ids, asked, idf, least)), mean, k)
        best = _ranked(part if best is None else part.unionByName(best.drop("rank")), k)
        if i < rounds:
            best = stored(best, "bm25-round")
            kth = dict(best.filter(F.col("rank") == k).select("query_id", "score").collect())   # one row per query
            least = np.array([kth.get(q, -np.inf) for q in ids.tolist()])
    return best


def _search_round(index: DataFrame, shared_place, shared, mean: float, k: int) -> DataFrame:
    """(query_id, doc_id, score): of each shard the best that reach their query's threshold."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at, (qid, terms, weight, floor) = shared_place.value, shared.value
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(j)[i].as_py() for j, c in enumerate(b.schema.names)}
                shard = _Loaded(row, at, weight, mean)
                got = list(shard.search(terms, qid.tolist(), k, floor.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(qid, [len(g[0]) for g in got])),
                     pa.array(np.concatenate([g[0] for g in got])), pa.array(np.concatenate([g[1] for g in got]))],
                    names=["query_id", "doc_id", "score"])

    return index.mapInArrow(run, "query_id bigint, doc_id bigint, score double")
