import numpy as np
from pyspark.sql import functions as F

from postlens.llm import quality

from .util import clashing, documents

D = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")
    out = quality.score_documents(docs, labels)
    assert out.count() == docs.count()
    held = out.join(labels, "doc_id").filter("held_out").toPandas()
    assert (held["predicted"] == held["quality"]).mean() > 0.97
    assert ((out.filter("(score >= 0.7) <> (predicted = 1) OR score < 0 OR score > 1")).count()) == 0
    crc = out.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2))
    assert crc.count() == 0


def test_pairs_rank_good_over_bad():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0.5, 1, (400, 5)), rng.normal(-0.5, 1, (300, 5))
    r = quality.fit_pairs(good, bad, pairs=20_000)
    wins = (r.raw(good)[:, None] > r.raw(bad)[None, :]).mean()
    assert wins > 0.9
    # the gradient of the Bradley-Terry loss is near zero at the end
    d = (np.clip((good - r.centre) / r.scale, -8, 8)[:300] - np.clip((bad - r.centre) / r.scale, -8, 8))
    assert np.abs((d / (1 + np.exp(d @ r.weights))[:, None]).mean(axis=0)).max() < 0.05


def test_keep_good_keeps_columns_and_clean_rows(spark):
    docs, labels = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")
    kept = quality.keep_good(clashing(docs), labels)
    assert kept.columns == clashing(docs).columns
    y = kept.join(labels, "doc_id").groupBy("quality").count().collect()
    n = {r["quality"]: r["count"] for r in y}
    assert n.get(0, 0) <= 2 and n[1] >= 0.99 * labels.filter("quality = 1").count()


def test_edge_rows(spark):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (1, 1, 0), (2, None, None), (None, 1, 1), (77, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = documents(spark, [None, "", "word " * 300_000, "x", "x"], ids=[0, 1, 2, 3, None])
    out = quality.score_documents(docs, labels).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    assert quality.score_documents(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs.limit(0), labels).columns == docs.columns
    none = quality.score_documents(docs, labels.limit(0)).collect()         # nothing to learn from: keep all
    assert all(r["predicted"] == 1 for r in none)
    twice = quality.score_documents(docs.unionAll(docs), labels)
    assert twice.count() == 10 and twice.select("doc_id", "score").distinct().count() == 5


def test_decisions_equal_a_plain_version_whatever_the_partitions(spark):
    """Features, ranking, exact corpus quantiles and cut once more without Spark; two partitionings give equal rows."""
    docs, labels = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")
    docs = docs.unionByName(documents(spark, [None, "", "a"], ids=[None, 10**9, 10**9]))
    a = quality.score_documents(docs.repartition(3), labels).select("doc_id", "score", "predicted", "raw_score")
    b = quality.score_documents(docs.repartition(11, "text"), labels).select("doc_id", "score", "predicted", "raw_score")
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)

    given = [(r["doc_id"], quality.features(r["text"])) for r in docs.collect()]
    y = {r["doc_id"]: r["quality"] for r in quality.labelled(labels.withColumnRenamed("quality", "q").withColumnRenamed("q", "quality"),
                                                            "quality", quality.FOLDS, quality.HELD_OUT, 10**6)
         .withColumnRenamed("y", "quality").collect()}
    train = sorted((i, f) for i, f in given if i in y)
    x, t = np.array([f for _, f in train]), np.array([y[i] for i, _ in train])
    ranking = quality.fit_pairs(x[t == 1], x[t == 0])
    raw = ranking.raw(np.array([f for _, f in given]))
    steps = np.sort(np.floor(raw * quality.BINS)) / quality.BINS
    n = len(steps)
    q = [steps[max(0, int(np.ceil(n * k / quality.QUANTILES)) - 1)] for k in range(1, quality.QUANTILES)]
    own = ranking.raw(x)
    grid = np.unique(np.array([*q, *np.quantile(own, np.linspace(0.001, 0.999, 99))]))
    gain = [(own[t == 1] >= c).mean() + (own[t == 0] < c).mean() for c in grid]
    best = np.flatnonzero(np.array(gain) >= max(gain) - 1e-12)
    cut = grid[best[len(best) // 2]]
    want = sorted((str(i), int(s >= cut)) for (i, _), s in zip(given, raw))
    assert sorted((str(r["doc_id"]), r["predicted"]) for r in a.collect()) == want
