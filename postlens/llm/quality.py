"""Quality scores by Bradley-Terry pairwise ranking.

Features of the whole text go through a linear score.  It is learnt from
preference pairs (a good document beats a bad one) with the logistic loss on
the difference of their features.  The acceptance threshold is a quantile of
the scores of all documents: of a grid of corpus quantiles, the one that
separates the labelled training documents best.  The reported score is a
logistic curve through 0.7 at that threshold.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import by_place, col, fold, free, stored

#: At most this many labelled documents (the first by hash) train the ranking.
TRAIN_ROWS = 40_000
#: Preference pairs drawn from them.
PAIRS = 100_000
#: Accepted from this score on.
ACCEPT = 0.7
#: Grid of corpus quantiles tried as the threshold.
QUANTILES = 400
#: Steps of the score that are counted, to one.
BINS = 1024
FOLDS, HELD_OUT = 4, 2

_BYTE_GROUPS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".,;:?",
    "bang": b"!",
    "symbol": b"#$%&*@^~=+<>|\\/_{}[]",
    "bracket": b"()\"'`-",
    "space": b" \t\r",
    "line": b"\n",
}
_GROUP = np.zeros((256, len(_BYTE_GROUPS)), dtype=np.float64)
for _i, _chars in enumerate(_BYTE_GROUPS.values()):
    _GROUP[list(_chars), _i] = 1.0
FEATURES = [*(f"share_{k}" for k in _BYTE_GROUPS), "log_words", "distinct_words", "repeat_next", "word_bytes",
            "top_word", "distinct_pairs", "distinct_lines", "one_byte_words", "log_upper", "log_symbol", "log_repeat",
            "bang_per_word", "symbol_per_word", "line_words", "digit_words"]
_DIGITS = re.compile(r"\d")


def features(text: str | None) -> list[float]:
    """Fixed-length description of a whole text; null counts as empty."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    n = max(len(raw), 1)
    groups = np.bincount(raw, minlength=256) @ _GROUP
    words = text.split()
    w = max(len(words), 1)
    kinds = len(set(words))
    counts: dict[str, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    top = max(counts.values(), default=0)
    again = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip()]
    upper, bang, symbol = groups[0] / n, groups[3], groups[4]
    expected = min(w, 30 * math.sqrt(w))        # distinct words grow about as the root of all words
    return [*(groups / n), math.log1p(len(words)), kinds / expected, again / w, len(raw) / w / 10, top / w,
            pairs / max(w - 1, 1), len(set(lines)) / max(len(lines), 1), sum(len(x) == 1 for x in words) / w,
            math.log1p(50 * upper), math.log1p(50 * symbol / n), math.log1p(50 * again / w),
            min(bang / w, 3), min(symbol / w, 3), math.log1p(w / max(len(lines), 1)),
            sum(bool(_DIGITS.search(x)) for x in counts) / max(kinds, 1)]


@dataclass(frozen=True)
class Ranking:
    """score = features . weights after centring and scaling."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def raw(self, rows: np.ndarray) -> np.ndarray:
        # row by row, so that a row's score does not depend on the rows it is batched with
        return (np.clip((rows - self.centre) / self.scale, -8, 8) * self.weights).sum(axis=1)


def fit_pairs(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, seed: int = 7, l2: float = 1e-4,
              steps: int = 400) -> Ranking:
    """Bradley-Terry: minimise log(1 + exp(-w.(x_good - x_bad))) over drawn preference pairs."""
    every = np.vstack([good, bad]) if len(good) + len(bad) else np.zeros((1, len(FEATURES)))
    centre, scale = every.mean(axis=0), every.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    w = np.zeros(every.shape[1])
    if len(good) and len(bad):
        rng = np.random.default_rng(seed)
        g = np.clip((good - centre) / scale, -8, 8)[rng.integers(0, len(good), pairs)]
        b = np.clip((bad - centre) / scale, -8, 8)[rng.integers(0, len(bad), pairs)]
        diff = g - b
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, steps + 1):                      # Adam on the full set of pairs
            wins = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
            grad = -(diff * wins[:, None]).mean(axis=0) + l2 * w
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
            w = w - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Ranking(centre, scale, w)


def labelled(labels: DataFrame, name: str, folds: int, held_out: int, rows: int) -> DataFrame:
    """(doc_id, y) of at most ``rows`` training documents, the first by hash.

    Null ids and labels are left out; a document labelled more than once takes its largest label.
    """
    usable = labels.filter(col("doc_id").isNotNull() & col(name).isNotNull() & (fold(col("doc_id"), folds) != held_out))
    once = usable.groupBy(col("doc_id").alias("doc_id")).agg(F.max(col(name)).cast("int").alias("y"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[Ranking, np.ndarray, np.ndarray]:
    """The ranking, and the raw scores and labels of its training documents."""
    chosen = F.broadcast(labelled(labels, "quality", FOLDS, HELD_OUT, rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            yield pd.DataFrame({"doc_id": x["doc_id"], "y": x["y"], "f": [features(t) for t in x["text"]]})

    texts = docs.select(col("doc_id").alias("doc_id"), col("text").alias("text")).join(chosen, "doc_id")
    got = (texts.mapInPandas(run, "doc_id bigint, y int, f array<double>")
           .groupBy("doc_id").agg(F.max_by("f", "f").alias("f"), F.max("y").alias("y"))  # repeated ids once
           .toPandas().sort_values("doc_id"))
    rows_ = np.array(got["f"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    y = got["y"].to_numpy(dtype=int)
    ranking = fit_pairs(rows_[y == 1], rows_[y == 0])
    return ranking, ranking.raw(rows_), y


def raw_scores(docs: DataFrame, ranking: Ranking, keep: list[str], into: str) -> DataFrame:
    """``docs`` columns ``keep`` plus the raw score of the whole text in column ``into``."""
    schema = StructType([*[docs.schema[k] for k in keep], StructField(into, DoubleType())])
    inner = by_place(docs, keep, col("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            t = b.column(b.num_columns - 1).to_pylist()
            f = np.array([features(x) for x in t], dtype=float).reshape(-1, len(FEATURES))
            score = pa.array(ranking.raw(f))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], score], names=[*keep, into])

    return inner.mapInArrow(run, schema)


def quantiles(all_scores: DataFrame, into: str) -> list[float]:
    """Exact quantiles of the scores in steps of 1 / BINS, the same whatever the partitions.

    Scores are counted by step; as they are sums of clipped features, the
    number of steps is bounded by the model, not by the documents.
    """
    step = F.floor(F.col(into) * BINS).cast("long").alias("step")
    counts = sorted((r["step"], r["count"]) for r in all_scores.groupBy(step).count().collect() if r["step"] is not None)
    if not counts:
        return []
    at = np.array([c[0] for c in counts]) / BINS
    upto = np.cumsum([c[1] for c in counts])
    return [float(at[np.searchsorted(upto, upto[-1] * i / QUANTILES)]) for i in range(1, QUANTILES)]


def threshold(all_scores: DataFrame, into: str, raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(threshold, steepness): the corpus quantile with the best balanced accuracy on the training rows."""
    q = quantiles(all_scores, into)
    spread = (float(np.std(raw)) if len(raw) else 0.0) or 1.0
    if not q or not len(y) or y.min() == y.max():
        low = float(np.min(raw)) - 1.0 if len(y) and y.min() == 1 else 0.0     # no bad example: keep everything
        return low, 2.0 / spread
    grid = np.unique(np.array([*q, *np.quantile(raw, np.linspace(0.001, 0.999, 99))]))
    good, bad = np.sort(raw[y == 1]), np.sort(raw[y == 0])
    kept = 1 - np.searchsorted(good, grid, "left") / len(good)
    dropped = np.searchsorted(bad, grid, "left") / len(bad)
    value = kept + dropped
    best = np.flatnonzero(value >= value.max() - 1e-12)
    return float(grid[best[len(best) // 2]]), 4.0 / spread


def calibrated(raw, cut: float, steep: float):
    """Column: logistic curve in the raw score with value ACCEPT at the threshold."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.least(F.greatest((raw - F.lit(cut)) * F.lit(steep), F.lit(-40.0)),
                                                      F.lit(40.0)) + F.lit(math.log(ACCEPT / (1 - ACCEPT))))))


@dataclass(frozen=True)
class QualityModel:
    ranking: Ranking
    cut: float
    steep: float


def fit(docs: DataFrame, labels: DataFrame, keep: list[str], into: str) -> tuple[QualityModel, DataFrame]:
    """The model, and the stored columns ``keep`` of all documents with their raw scores in ``into``."""
    ranking, raw, y = train(docs, labels)
    scored = stored(raw_scores(docs, ranking, keep, into), "quality-raw")
    cut, steep = threshold(scored, into, raw, y)
    return QualityModel(ranking, cut, steep), scored


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document (one row per row of ``docs``).

    Null text counts as empty; a null id is never held out; repeated rows get
    equal rows; without documents the result is empty; without labels of both
    kinds every document is accepted.
    """
    ids = docs.select(col("doc_id").alias("doc_id"), col("text").alias("text"))
    model, scored = fit(ids, labels, ["doc_id"], "raw")
    above = F.col("raw") >= F.lit(model.cut)                # the decision, free of rounding in the curve
    score = calibrated(F.col("raw"), model.cut, model.steep)
    score = F.when(above, F.greatest(score, F.lit(ACCEPT))).otherwise(F.least(score, F.lit(ACCEPT - 1e-9)))
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                         score.alias("score"), above.cast("int").alias("predicted"), F.col("raw").alias("raw_score"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` (all columns) that the ranking accepts.

    Null texts are scored as empty ones, null ids like any other row; repeated
    rows stay or go together; no documents give no rows; without labels of
    both kinds every row stays.  Rows are scored once and stored with their
    score, from which threshold and decision are read.
    """
    raw = free("__raw", docs)
    model, scored = fit(docs, labels, docs.columns, raw)
    return scored.filter(col(raw) >= F.lit(model.cut)).select(*[col(c) for c in docs.columns])
