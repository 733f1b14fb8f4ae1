import math
import random

from pyspark.sql import functions as F

from postlens.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, p=5, k=10, low=30, high=90):
    ready = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        item = (lab, [math.floor(256 * float(x)) for x in v])
        ready[i] = min(item, ready.get(i, item))
    out = []
    for a, (lab, v) in ready.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, (m, w) in ready.items() if i != a and len(w) == len(v))
        for ps, pid, _ in [s for s in scored if s[2] == lab][:p]:
            fit = [s for s in scored if s[2] != lab and low * -ps <= 100 * -s[0] <= high * -ps][:k]
            out += [(a, pid, r + 1, i, -ps, -s) for r, (s, i, _) in enumerate(fit)]
    return sorted(out)


def random_rows(n, dims, seed, step=1):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = r.choice(centres)
        rows.append((i * step, [round(x + r.gauss(0, 0.6), 1) for x in c], r.randrange(4)))
    return rows


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(x) for x in H.mine(df, **more).collect())


def test_equals_brute_force(spark):
    rows = [(i, [F32(x) for x in v], lab) for i, v, lab in random_rows(900, 5, 1, step=4)]
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 500


def F32(x):
    import numpy as np

    return float(np.float32(x))


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rows = [(i, [1.0, 0.5] if i % 3 else [0.5, 0.25], i % 2) for i in range(0, 60)]
    rows += [(i, v, i % 2) for i, v, _ in rows[:20]]                       # repeated rows
    rows += [(5, [9.0, 9.0], 7), (None, [1.0, 1.0], 0), (61, None, 0), (62, [1.0, None], 0), (63, [1.0, float("nan")], 1),
             (64, [float("inf"), 1.0], 1), (65, [1.0, 1.0], None), (66, [1.0], 1), (70, [2.0], 1), (71, [0.5], 0), (67, [], 0),
             (80, [-1.0, -1.0], 0), (90, [0.0, 0.0], 1)]
    got = run(spark, rows, every=10)
    assert got == brute(rows, every=10) and got


def test_small_shards_change_nothing(spark, monkeypatch):
    rows = random_rows(700, 4, 3)
    rows = [(i, [F32(x) for x in v], lab) for i, v, lab in rows]
    whole = run(spark, rows, every=50)
    monkeypatch.setattr(H, "SHARD_ROWS", 16)
    monkeypatch.setattr(H, "SHARD_BYTES", 16 * 8 * 4)
    assert run(spark, rows, every=50) == whole == brute(rows, every=50)


def test_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(i, [1.0 + i % 5, 1.0], i % 3) for i in range(0, 200, 10)], SCHEMA)
    for c in ("id", "v", "r", "slot", "shard", "part", "anchor", "limits", "dims", "a.b", "negative_id"):
        df = df.withColumn(c, F.lit("x"))
    assert H.mine(df).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert H.mine(df).count() == len(brute([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]))
    assert H.mine(df.limit(0)).count() == 0
    assert H.mine(df.where("vec_id % 100 <> 0")).count() == 0


def test_products_are_exact():
    import numpy as np

    a = np.array([[2 ** 40, 3], [1, 1]], dtype=np.int64)
    b = np.array([[2 ** 20, 1], [2 ** 40, 5]], dtype=np.int64)
    assert H.products(a, b).tolist() == [[2 ** 60 + 3, 2 ** 63 - 1], [2 ** 20 + 1, 2 ** 40 + 5]]


def test_query_on_the_given_table(spark):
    """The registered query against brute force, with the labels changed as it states."""
    from postlens.llm.queries import QUERIES

    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["label"] is not None and r["vec_id"] % 7 == 0 else r["label"])
            for r in rows]
    got = sorted(tuple(x) for x in QUERIES["op11_hard_negatives"](spark, "/root/testdata/sf0.01").collect())
    assert got == brute(rows)
