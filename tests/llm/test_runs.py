import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import runs as R

from .util import clashing, documents


def plain_lyndon(t):
    """Longest Lyndon word at each position by its definition: smaller than all its proper suffixes."""
    out = []
    for i in range(len(t)):
        out.append(max(j - i for j in range(i + 1, len(t) + 1) if all(t[i:j] < t[k:j] for k in range(i + 1, j))))
    return out


def plain_runs(words, least=6, exponent=4):
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, exponent * q):
                part = words[i:i + length]
                if not any(all(part[k] == part[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_lyndon_array_is_its_definition(letters):
    r = random.Random(letters)
    for n in [1, 2, 3, *[r.randrange(1, 28) for _ in range(120)]]:
        t = [r.randrange(1, letters + 1) for _ in range(n)]
        assert R.lyndon_array([0, *t], letters)[1:] == plain_lyndon(t)


def test_lyndon_array_of_several_stretches():
    r = random.Random(9)
    for _ in range(150):
        parts = [[r.randrange(1, 4) for _ in range(r.randrange(0, 12))] for _ in range(4)]
        got = R.lyndon_array([c for p in parts for c in [0, *p]], 3)
        k = 0
        for p in parts:
            assert got[k + 1:k + 1 + len(p)] == plain_lyndon(p)
            k += 1 + len(p)


def test_extensions():
    r = random.Random(2)
    t = np.array([r.randrange(2) for _ in range(60)])
    e = R.Extensions(t, 60)
    pairs = [(i, j) for i in range(60) for j in range(i + 1, 60)]
    i, j = np.array(pairs).T
    right, left = e.right(i, j), e.left(i, j)
    for (a, b), x, y in zip(pairs, right, left):
        assert x == next((d for d in range(60 - b) if t[a + d] != t[b + d]), 60 - b)
        assert y == next((d for d in range(a + 1) if t[a - d] != t[b - d]), a + 1)


def sample():
    r = random.Random(5)
    out = ["", " \t\n", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "x " * 50 + "y " * 7,
           "a b c a b c a b c a b c a d", "a\x0bb\x0cc\rd e\xa0e e e", "A a A a A a A a"]
    for _ in range(150):
        unit = [r.choice("abc") for _ in range(r.randrange(1, 6))]
        out.append(" ".join([r.choice("abcd") for _ in range(r.randrange(6))] + unit * r.randrange(1, 9) +
                            unit[:r.randrange(len(unit) + 1)] + [r.choice("abcd") for _ in range(r.randrange(30))]))
    out += [" ".join(r.choice("ab") for _ in range(r.randrange(1, 120))) for _ in range(150)]
    fib = ["a", "b"]
    for _ in range(9):
        fib.append(fib[-1] + fib[-2])
    return out + [" ".join(fib[-1]), " ".join(["a"] * 3000), " ".join(["b a"] * 1000 + ["a b"] * 1000)]


@pytest.mark.parametrize("least,exponent", [(6, 4), (2, 2), (1, 3)])
def test_runs_equal_brute_force(spark, least, exponent):
    texts = [t for t in sample() if len(t) < 500] + [None]
    docs = clashing(documents(spark, texts).repartition(3))
    out = R.find_runs(docs, least=least, exponent=exponent)
    assert set(docs.columns) - {"text"} <= set(out.columns)
    got = {r["doc_id"]: r for r in out.collect()}
    for i, t in enumerate(texts):
        words = re.findall(R.WORD, t or "")
        want = plain_runs(words, least, exponent)
        assert [tuple(x) for x in got[i]["runs"]] == want
        assert got[i]["collapsed"] == plain_collapse(words, want)


def test_long_texts(spark):
    long = sample()[-3:]
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in R.find_runs(documents(spark, long)).collect()}
    assert got[1] == [(0, 3000, 1)]
    assert got[2] == [(0, 2000, 2), (2000, 2000, 2)] or got[2] == plain_runs(long[2].split())
    deep = " ".join(["a b c d e"] * 60_000)
    assert [tuple(x) for x in R.find_runs(documents(spark, [deep])).first()["runs"]] == [(0, 300_000, 5)]


def test_batches_change_nothing(spark, monkeypatch):
    lists = [t.encode().split() for t in sample()]
    whole = R.batch_runs(lists, 6, 4)
    alone = [R.batch_runs([x], 6, 4) for x in lists]
    assert [t for a in alone for t in a[2]] == whole[2]
    assert [(i, *r[1:]) for i, a in enumerate(alone) for r in a[0].tolist()] == [tuple(r) for r in whole[0].tolist()]


def plain_digests(doc_id, text):
    words = re.findall(R.WORD, text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(plain_collapse(words, runs)))


def test_digests_with_planted_repetition(spark):
    r = random.Random(7)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(0, 90))) for _ in range(600)] + [None, "", "a", "a a a a a a"]
    docs = documents(spark, texts, ids=[*range(len(texts) - 1), None])
    out = R.digests(R.find_runs(docs.select("doc_id", R.planted(F.col("text"), F.col("doc_id")).alias("text"))))
    got = {x["doc_id"]: tuple(x) for x in out.collect()}
    assert got == {i: plain_digests(i, t) for i, t in zip([*range(len(texts) - 1), None], texts)}
    assert sum(x[1] > 0 for x in got.values()) > 15


def test_query_on_the_given_table(spark):
    from postlens.llm.queries import QUERIES

    out = QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in out.dtypes] == ["bigint"] * 6 + ["string"] * 2
    docs = [(d["doc_id"], d["text"]) for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    small = {i: t for i, t in docs if len((t or "").split()) < 1500}
    got = {x["doc_id"]: tuple(x) for x in out.collect()}
    assert len(got) == len(docs)
    for i, t in small.items():
        assert got[i] == plain_digests(i, t)


def test_empty_table(spark):
    assert R.digests(R.find_runs(documents(spark, ["a"]).limit(0))).count() == 0
    with pytest.raises(ValueError):
        R.find_runs(documents(spark, ["a"]), exponent=1)
