"""Hard negatives by slots: each anchor's score windows are answered from one top-k list per slot.

An anchor's positives are its nearest rows of the same label.  Each positive
opens a window of scores for negatives, from ``low`` to ``high`` percent of
its own score.  The windows of one anchor overlap, but their upper limits cut
the scores into disjoint slots: a row belongs to the slot of the smallest
upper limit that is not below its score.  For each slot only the first ``k``
rows are kept, first by the task that scored them, then over all tasks.
Slots do not overlap and are in order of score, so walking from the lowest
slot up and putting each slot's list before what came from below gives the
first ``k`` rows under every upper limit; a window is the part of its list
that is not below its lower limit.

Scoring: the anchors are the stated query set.  All rows are dealt into
shards of bounded size, a copy of the anchors goes to every shard, and a task
holds one shard while the anchors stream past it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, stored

#: Bytes of a shard's matrix (8 a component) and rows of a shard at least.
SHARD_BYTES = 32 << 20
SHARD_ROWS = 256
#: Scores worked out at a time: anchors times rows of the shard.
CELLS = 1 << 21
LONG = np.iinfo(np.int64)


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """(id, label, v): rows that take part, v the floors of the scaled components as longs.

    A row with a null id, label or vector, or any null or non-finite
    component, takes no part; nor does one whose floored components do not
    fit a long.  Of rows that repeat an id the one with the smallest label,
    then vector, stands for all.
    """
    v, limit = F.transform(col(vector_col), lambda x: x.cast("double")), float(2 ** 62)
    kept = rows.select(col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(
            F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < limit)), F.lit(False)))
    floors = F.transform("v", lambda x: F.floor(x * scale).cast("long"))
    return (kept.select("id", F.struct("label", floors.alias("v")).alias("r")).groupBy("id").agg(F.min("r").alias("r"))
            .select("id", "r.label", "r.v"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b``; beyond a long, its nearest end."""
    if not a.shape[1] or not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    bound = a.shape[1] * int(max(abs(int(a.max())), abs(int(a.min())))) * int(max(abs(int(b.max())), abs(int(b.min()))))
    if bound < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2 ** 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, LONG.min, LONG.max).astype(np.int64)


def first(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``at`` (rising), the ``k`` with the highest scores, ties to the smaller place."""
    if len(at) > k:
        s = scores[at]
        least = np.partition(s, len(s) - k)[len(s) - k]
        above = at[s > least]
        at = np.concatenate([above, at[s == least][:k - len(above)]])
    return at[np.lexsort((at, -scores[at]))]


def _vectors(c: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(c.flatten(), dtype=np.int64).reshape(len(c), dims)


def _scan(pick, batches: Iterator[pa.RecordBatch], out: list[str]) -> Iterator[pa.RecordBatch]:
    """Calls ``pick(scores, shard ids, shard labels, anchor)`` for every anchor of every shard.

    The batches hold (shard, anchor, id, label, dims, v, limits) in order of
    shard, the shard's rows before its anchors; rows of other numbers of
    components are in other shards.
    """
    shard, parts, ids, labels, matrix = None, [], None, None, None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        number, anchor = (np.asarray(table[c].to_numpy()) for c in ("shard", "anchor"))
        cuts = [0, *(np.flatnonzero((np.diff(number) != 0) | (np.diff(anchor) != 0)) + 1).tolist(), len(number)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            if low == high:
                continue
            some = table.slice(low, high - low).combine_chunks()
            dims = some["dims"][0].as_py()
            vectors = _vectors(some["v"].combine_chunks(), dims)
            if number[low] != shard:
                shard, parts, matrix = number[low], [], None
            if not anchor[low]:
                parts.append((some["id"].to_numpy(), some["label"].to_numpy(), vectors))
                continue
            if matrix is None and parts:
                ids, labels, matrix = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(ids, kind="stable")
                ids, labels, matrix, parts = ids[order], labels[order], matrix[order], []
            if matrix is None:
                continue
            step = max(1, CELLS // len(ids))
            found: dict[str, list] = {c: [] for c in out}
            limits = some["limits"].to_pylist() if "limits" in some.column_names else None
            for i in range(0, len(vectors), step):
                scores = products(vectors[i:i + step], matrix)
                for j in range(len(scores)):
                    me = i + j
                    for values in pick(scores[j], ids, labels, some["id"][me].as_py(), some["label"][me].as_py(),
                                       limits and limits[me]):
                        for c, x in zip(out, values):
                            found[c].append(x)
            if found[out[0]]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found[c]), pa.int64()) for c in out], out)


def _dealt(rows: DataFrame, anchors: DataFrame, shards: int) -> DataFrame:
    """All rows by shard, a copy of the anchors behind every shard's rows."""
    number = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("part")
    limits = [F.col("limits")] if "limits" in anchors.columns else []
    mine = rows.select(number, F.lit(False).alias("anchor"), "id", "label", "v",
                       *[F.lit(None).cast("array<long>").alias("limits") for _ in limits])
    theirs = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("part"), F.lit(True).alias("anchor"),
                            "id", "label", "v", *limits)
    both = mine.unionByName(theirs).withColumn("dims", F.size("v"))
    # vectors of unlike length are never compared: a shard is a part and a length
    both = both.withColumn("shard", F.struct("part", "dims")).withColumn("shard", F.xxhash64("shard"))
    return (both.repartition(shards, "shard").sortWithinPartitions("shard", "anchor")
            .select("shard", "anchor", "id", "label", "dims", "v", *limits))


def positives(rows: DataFrame, anchors: DataFrame, shards: int, p: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): each anchor's first ``p`` other rows of its label."""
    def pick(scores, ids, labels, me, label, _):
        at = first(scores, np.flatnonzero((labels == label) & (ids != me)), p)
        if len(at):
            yield np.full(len(at), me), ids[at], scores[at]

    out = ["anchor_id", "positive_id", "positive_score"]
    near = _dealt(rows, anchors, shards).mapInArrow(lambda b: _scan(pick, b, out), ", ".join(f"{c} long" for c in out))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= p).drop("r")


def slot_lists(rows: DataFrame, anchors: DataFrame, shards: int, k: int) -> DataFrame:
    """(anchor_id, slot, negatives): the first ``k`` rows of another label in each slot that has any.

    ``anchors.limits`` is [least score of use, upper limits falling ...]; slot
    ``j`` (from 0) holds the scores up to limit ``j`` and over limit ``j + 1``.
    """
    def pick(scores, ids, labels, me, label, limits):
        floor, upper = limits[0], limits[1:]
        for j, high in enumerate(upper):
            low = upper[j + 1] + 1 if j + 1 < len(upper) else floor
            at = first(scores, np.flatnonzero((scores >= max(low, floor)) & (scores <= high) & (labels != label)), k)
            if len(at):
                yield np.full(len(at), me), np.full(len(at), j), ids[at], scores[at]

    out = ["anchor_id", "slot", "negative_id", "negative_score"]
    near = _dealt(rows, anchors, shards).mapInArrow(lambda b: _scan(pick, b, out), ", ".join(f"{c} long" for c in out))
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("negative_score"), "negative_id")
    kept = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    return (kept.groupBy("anchor_id", "slot").agg(F.sort_array(F.collect_list(F.struct("r", "negative_id", "negative_score"))).alias("n"))
            .select("anchor_id", "slot", F.transform("n", lambda x: F.struct(x["negative_id"], x["negative_score"])).alias("negatives")))


def mine(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         every: int = 100, p: int = 5, k: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``.  A row's score is
    its integer inner product with the anchor, over components
    floor(scale * x); higher scores come first, ties by smaller id.  Positives
    are the anchor's first ``p`` other rows of its label, and for each of them
    the first ``k`` rows of other labels with
    low * positive <= 100 * negative <= high * positive are returned (all, if
    fewer; none for a positive with a negative score).

    Takes no part: see :func:`usable`; rows of another number of components
    than the anchor's are not compared with it.  Rows of the anchor's own id
    are never its positives or negatives.  Scores beyond a long count as its
    nearest end.  Empty tables give an empty result, other columns of ``rows``
    are not read.
    """
    spark = rows.sparkSession
    ready = stored(usable(rows, id_col, vector_col, F.col("label") if label is None else label, scale), "hard-rows")
    n, dims = ready.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    most = max(1, SHARD_BYTES // (8 * max(1, dims)))
    size = min(most, max(SHARD_ROWS, -(-n // (8 * spark.sparkContext.defaultParallelism))))
    shards = max(1, -(-n // size))
    anchors = ready.where(F.col("id") % every == 0)
    pos = stored(positives(ready, anchors, shards, p), "hard-positives")

    # 100 * s <= high * positive and >= low * positive in whole numbers; decimals hold the products of longs
    percent = F.col("positive_score").cast("decimal(20,0)")
    bounds = pos.select("anchor_id", "positive_id", "positive_score",
                        F.ceil(percent * low / 100).cast("long").alias("low"), F.floor(percent * high / 100).cast("long").alias("high"))
    limits = bounds.where("low <= high").groupBy("anchor_id").agg(
        F.concat(F.array(F.min("low")), F.sort_array(F.collect_set("high"), asc=False)).alias("limits"))
    asked = anchors.join(limits.withColumnRenamed("anchor_id", "id"), "id")
    lists = slot_lists(ready, asked, shards, k)

    per_slot = lists.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "negatives"))).alias("slots"))
    none = F.array().cast("array<struct<negative_id:long,negative_score:long>>")
    # from the lowest slot up: what a slot keeps stands before what came from below, cut to k
    under = F.aggregate(
        F.sequence(F.size("uppers") - 1, F.lit(0), F.lit(-1)),
        F.array().cast("array<array<struct<negative_id:long,negative_score:long>>>"),
        lambda done, j: F.concat(F.array(F.slice(F.concat(F.coalesce(F.try_element_at("slots", j.cast("long")), none),
                                                          F.coalesce(F.try_element_at(done, F.lit(1)), none)), 1, k)), done))
    uppers = F.slice("limits", 2, p)
    answers = (limits.join(per_slot, "anchor_id").withColumn("uppers", uppers)
               .select("anchor_id", "uppers", under.alias("under")))
    found = bounds.join(answers, "anchor_id").where("low <= high").select(
        "anchor_id", "positive_id", "positive_score",
        F.filter(F.element_at("under", F.array_position("uppers", F.col("high")).cast("int")),
                 lambda x: x["negative_score"] >= F.col("low")).alias("n"))
    return (found.select("anchor_id", "positive_id", "positive_score", F.posexplode("n").alias("at", "x"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("x.negative_id").alias("negative_id"),
                    "positive_score", F.col("x.negative_score").alias("negative_score")))
