import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from postlens.llm import bm25
from postlens.llm.queries import ORACLE_SQL, QUERIES

from .util import clashing, documents


def plain(texts, ids, every, k):
    words = [re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    n, mean = len(texts), sum(map(len, words)) / len(texts)
    df = Counter(w for ws in words for w in set(ws))
    out = {}
    for q, qs in zip(ids, words):
        if q % every or not qs:
            continue
        scores = []
        for d, ws in zip(ids, words):
            tf = Counter(ws)
            s = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(ws) / mean))
                    for t in set(qs) if t in tf)
            if d != q and s > 0:
                scores.append((-round(s, 9), d))
        out[q] = [(d, -s) for s, d in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("shard,common,block,queries", [(8192, 1 / 16, 64, 4096), (37, 0.3, 4, 5), (50, 2.0, 8, 4096)])
def test_equals_brute_force(spark, monkeypatch, shard, common, block, queries):
    for name, v in (("SHARD_DOCS", shard), ("COMMON", common), ("BLOCK", block), ("QUERY_ROWS", queries), ("FIRST_SHARDS", 2)):
        monkeypatch.setattr(bm25, name, v)
    r = random.Random(shard)
    vocabulary = ["the", "of", "And", "É", "x1"] + [f"w{i}" for i in range(400)]
    weights = [40, 30, 20, 5, 5] + [1 / (i + 1) * 20 for i in range(400)]
    texts = [" ".join(r.choices(vocabulary, weights, k=r.randint(0, 80))) + r.choice((".", "!", "")) for _ in range(300)]
    texts += [texts[10]] * 60 + [None, "", "...", "unique"]
    ids = list(range(len(texts)))
    rows = bm25.search(documents(spark, texts).repartition(4), every=9).collect()
    got = {}
    for x in sorted(rows, key=lambda x: x["rank"]):
        got.setdefault(x["query_id"], []).append((x["doc_id"], x["score"]))
    want = plain(texts, ids, 9, 10)
    assert {q: [d for d, _ in v] for q, v in got.items()} == {q: [d for d, _ in v] for q, v in want.items() if v}
    for q, v in got.items():
        assert [s for _, s in v] == pytest.approx([s for _, s in want[q]], abs=2e-9)


def test_matches_sql(spark):
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    want = c.execute(ORACLE_SQL["op7_bm25"]).fetchall()
    got = QUERIES["op7_bm25"](spark, d).select("query_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_edge_rows(spark):
    docs = documents(spark, ["a b c", "a b", None, "", "a", "a b", "word " * 200_000], ids=[0, 1, 2, 3, None, 1, 100])
    rows = bm25.search(clashing(docs)).collect()
    mine = [x for x in rows if x["query_id"] == 0]
    assert [x["doc_id"] for x in sorted(mine, key=lambda x: x["rank"])] == [1, 1]     # a repeated row counts twice
    assert bm25.search(docs.limit(0)).count() == 0
    assert bm25.search(documents(spark, [None, "", "!!"])).count() == 0


def test_common_terms_of_many_queries_in_one_product(monkeypatch):
    """Sums of the product are within the stated error, and what reaches a threshold is found whatever the sums' rounding."""
    monkeypatch.setattr(bm25, "TOGETHER", 7)
    r = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(r.choices(vocabulary, [1 / (i + 1) for i in range(60)], k=r.randint(1, 60))).encode() for _ in range(500)]
    texts += [texts[3]] * 20                                                   # equal scores at the threshold
    shard = bm25._Shard()
    for i, t in enumerate(texts):
        shard.add(i, t)
    row = dict(zip([x.split()[0] for x in bm25._INDEX.split(", ")], shard.row("s")))
    place = {w.encode(): i for i, w in enumerate(vocabulary)}
    idf = np.array([r.uniform(1e-3, 12) for _ in vocabulary])
    loaded = bm25._Loaded(row, place, idf, 30.0)
    asked = [np.array([place[t] for t in sorted(set(bm25.tokens(t)))]) for t in texts[:40]]

    def score(terms, d):
        tf = Counter(bm25.tokens(texts[d]))
        norm = 1.2 * (0.25 + 0.75 * sum(tf.values()) / 30.0)
        return sum(tf[vocabulary[t].encode()] * 2.2 / (tf[vocabulary[t].encode()] + norm) * idf[t] for t in terms.tolist())

    whole = [[score(t, d) for d in range(len(texts))] for t in asked]
    seen = []
    best = loaded.best
    monkeypatch.setattr(loaded, "best", lambda t, q, k, f, common: seen.append((t, common)) or best(t, q, k, f, common))
    least = [sorted(x[:i] + x[i + 1:])[-5] for i, x in enumerate(whole)]
    found = list(loaded.search(asked, list(range(40)), 5, least))
    assert len(loaded.dense) > 10 and len(found) == len(seen) == 40
    for q, (docs, scores) in enumerate(found):
        want = sorted((-round(s, 9), d) for d, s in enumerate(whole[q]) if d != q)[:5]
        assert sorted(zip((-scores).round(8).tolist(), docs.tolist())) == sorted((round(s, 8), d) for s, d in want)
        terms, common = seen[q]
        exact = np.array([score(terms[loaded.row_of[terms] >= 0], d) for d in range(len(texts))])
        assert (np.abs(common[:len(texts)] - exact) <= loaded.error * exact).all()
