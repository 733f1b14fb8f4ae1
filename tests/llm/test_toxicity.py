import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa

from postlens.llm import toxicity as T

from .util import clashing, documents


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = T.score_documents(docs, labels)
    x = out.join(labels, "doc_id").filter("held_out").toPandas()
    bad, clean = x[x["toxic"] == 1], x[x["toxic"] == 0]
    assert bad["predicted"].mean() > 0.95 and clean["predicted"].mean() < 0.01
    assert out.count() == docs.count() and out.filter("score < 0 OR score > 1").count() == 0


def make_index(n=700, terms=60, seed=1):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        ids = sorted(r.choice(terms, r.integers(0, 6), replace=False).tolist())
        rows.append((i * 3, ids, r.integers(1, 4, len(ids)).tolist(), int(r.random() < 0.3)))
    rows += [(10_000 + i, [1, 2], [1, 1], 1) for i in range(200)]          # ties
    frame = pd.DataFrame(rows, columns=["doc_id", "ids", "tf", "y"]).sample(frac=1, random_state=2)
    return T.build_index(frame, r.uniform(0.5, 3, terms)), frame


def test_nearest_equal_brute_force():
    index, frame = make_index()
    dense = np.zeros((len(index.doc_id), len(index.idf)))
    place = {d: i for i, d in enumerate(index.doc_id)}
    for row in frame.itertuples():
        if row.ids:
            ids, w = index.vector(row.ids, row.tf)
            dense[place[row.doc_id], ids] = w
    r = np.random.default_rng(9)
    for _ in range(150):
        ids = sorted(r.choice(len(index.idf), r.integers(1, 8), replace=False).tolist())
        tf = r.integers(1, 4, len(ids)).tolist()
        who, cosine = index.nearest(ids, tf, 15)
        q = np.zeros(len(index.idf))
        q[index.vector(ids, tf)[0]] = index.vector(ids, tf)[1]
        s = np.round(dense @ q, 12)
        want = [i for i in np.lexsort((index.doc_id, -s)) if s[i] > 0][:15]
        assert index.doc_id[who].tolist() == index.doc_id[want].tolist()
        assert np.allclose(cosine, s[want])


def test_shards_equal_one_index():
    index, frame = make_index()
    parts = [T.build_index(frame[frame["doc_id"] % 4 == i], index.idf).packed() for i in range(4)]
    model = T.Model(SimpleNamespace(value=index.idf), [SimpleNamespace(value=p) for p in parts], 0.3, 0.3)
    r = np.random.default_rng(5)
    for _ in range(100):
        ids = sorted(r.choice(len(index.idf), r.integers(1, 8), replace=False).tolist())
        tf = r.integers(1, 4, len(ids)).tolist()
        left_out = int(r.choice(index.doc_id))
        who, cosine = index.nearest(ids, tf, 15, leave_out=index.place(left_out))
        doc_id, label, near = model.search(ids, tf, 15, leave_out=left_out)
        assert doc_id.tolist() == index.doc_id[who].tolist() and label.tolist() == index.label[who].tolist()
        assert np.allclose(near, cosine) and left_out not in doc_id


def test_long_lists_equal_brute_force(monkeypatch):
    """Lists with bounds per block, short lists and merged shards give the nearest of a plain product, left-out ones aside."""
    monkeypatch.setattr(T, "BLOCK", 16)
    some, frame = make_index()
    dense = np.zeros((len(some.doc_id), len(some.idf)))
    place = {d: i for i, d in enumerate(some.doc_id)}
    for row in frame.itertuples():
        if row.ids:
            ids, w = some.vector(row.ids, row.tf)
            dense[place[row.doc_id], ids] = w
    for long in (1, 70, 10_000):                                           # all, some and no lists
        monkeypatch.setattr(T, "LONG", long)
        index = T.build_index(frame, some.idf)
        parts = [T.build_index(frame[frame["doc_id"] % 4 == i], some.idf).packed() for i in range(4)]
        whole = T.with_lists(some.idf, *T.merged(parts))
        assert (len(index.long) == 60) == (long == 1) and (len(index.long) == 0) == (long == 10_000)
        r = np.random.default_rng(7)
        for _ in range(100):
            ids = sorted(r.choice(len(some.idf), r.integers(1, 8), replace=False).tolist())
            tf, left_out = r.integers(1, 4, len(ids)).tolist(), int(r.choice(some.doc_id))
            q = np.zeros(len(some.idf))
            q[some.vector(ids, tf)[0]] = some.vector(ids, tf)[1]
            s = np.round(dense @ q, 12)
            s[place[left_out]] = 0
            want = [i for i in np.lexsort((some.doc_id, -s)) if s[i] > 0][:15]
            for x in (index, whole):
                who, cosine = x.nearest(ids, tf, 15, leave_out=x.place(left_out))
                assert x.doc_id[who].tolist() == some.doc_id[want].tolist() and np.allclose(cosine, s[want])


def test_index_takes_few_bytes_a_posting():
    """Beside what is packed a worker holds a place and a weight for each posting, six bytes, and tables that do not grow with them."""
    r = np.random.default_rng(3)
    frame = pd.DataFrame([(i, np.sort(r.choice(20_000, 200, replace=False)), np.ones(200, np.int64), i % 2) for i in range(600)],
                         columns=["doc_id", "ids", "tf", "y"])
    index = T.build_index(frame, np.ones(20_000))
    index.nearest([1, 2, 3], [1, 1, 1], 5)
    held = [v for v in vars(index).values() if isinstance(v, np.ndarray) and not any(v is x for x in (*index.packed(), index.idf))]
    assert sum(v.nbytes for v in held if len(v) > 20_001) <= 6 * len(index.term)


def test_leave_one_out_and_calibration():
    index, _ = make_index()
    who, _ = index.nearest([1, 2], [1, 1], 5)
    again, _ = index.nearest([1, 2], [1, 1], 5, leave_out=int(who[0]))
    assert who[0] not in again
    x, v = T.calibrate(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]))
    assert (np.diff(v) >= 0).all() and (np.diff(x) >= 0).all()


def test_one_search_gives_score_and_left_out_vote(monkeypatch):
    """A document is searched once, also a training example: its left-out vote comes from the same neighbours."""
    index, frame = make_index()
    model = T.Model(SimpleNamespace(value=index.idf), [SimpleNamespace(value=index.packed())], 0.3, 0.3)
    class Rows:
        def mapInArrow(self, run, schema):
            return run
    run, searched = T.votes(model, Rows()), []
    search = T.Model.search
    monkeypatch.setattr(T.Model, "search", lambda *a, **k: searched.append(a) or search(*a, **k))
    some = frame[frame["doc_id"] < 10_000].head(200)
    new = [(None, [3, 5], [1, 1]), (1, [3, 5], [2, 1]), (2, [], []), (some["doc_id"].iloc[0], [7, 9, 11], [1, 1, 1])]
    rows = [*zip(some["doc_id"], some["ids"], some["tf"]), *new]
    kinds = pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())
    batch = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "ids", "tf"])
    got = pa.Table.from_batches(run(iter([batch]))).to_pylist()
    assert len(got) == len(rows) and len(searched) <= len(rows)
    labels = dict(zip(frame["doc_id"], frame["y"]))
    for (doc_id, ids, tf), x in zip(rows, got):
        near, label, cosine = search(model, ids, tf)
        assert x["vote"] == model.vote(label, cosine) and x["evidence"] == near[:3].tolist() and x["known"] == (len(near) > 0)
        if (doc_id, ids, tf) in new or not ids:
            assert x["y"] is None and x["left_out"] is None
        else:
            _, label, cosine = search(model, ids, tf, leave_out=doc_id)
            assert x["y"] == labels[doc_id] and x["left_out"] == model.vote(label, cosine)


def test_words_of_chunks():
    """Texts cut at bytes have the words of the pattern on the lower-cased text; each chunk is looked up once."""
    texts = ["İstanbul ΣΑΣ ΑΣ.x ΑΣ b_c don't", "a\x1cb c\u3000d Ç'est «Été» ½ﬁ", "漢字。かな", "x," * 9, "", None, "A a a-A ΟΔΟΣ"]
    looked_up = []

    def entries(words):
        looked_up.extend(words)
        return np.arange(len(looked_up) - len(words), len(looked_up)), np.arange(len(words))
    reader = T.Reader(entries)
    for _ in range(2):
        row, number, total = reader.read(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            want = T._WORD.findall((text or "").lower())
            assert [looked_up[n] for n in number[row == i]] == want and total[i] == len(want)
        once = len(looked_up)
    assert len(looked_up) == once and looked_up.count("a") == 1


def test_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(T, "ROWS", 4)
    monkeypatch.setattr(T, "PIECE", 100)
    texts = ["x" * 30] * 9 + ["y" * 500, None, "", "z"] + ["x" * 30] * 6
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    cut = list(T.pieces(iter([batch, batch.slice(0, 0)]), 0))
    assert [t for b in cut for t in b.column(0).to_pylist()] == texts
    assert all(b.num_rows <= 4 and sum(map(len, filter(None, b.column(0).to_pylist()))) <= 630 for b in cut)


def test_document_counts(spark):
    rows = [(1, [0, 2]), (1, [0, 2]), (None, []), (4, [2, 6])]
    got = T.document_counts(spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(3), 7).collect()
    assert sorted(map(tuple, got)) == [(0, 2), (2, 3), (6, 1)]
    assert T.document_counts(spark.createDataFrame([], "doc_id long, ids array<int>"), 0).count() == 0


def test_vocabulary_and_counts(spark):
    r = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    rows = [(" ".join(r.choices(words, k=30) + (["Vile" + "abcdefghij"[i % 10]] if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(400)]
    found = T.choose_vocabulary(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, y int"))
    assert "vile*" in found and not any(t.startswith("w") for t in found)
    docs = documents(spark, ["vilea VILEB x", None])
    got = T.count_terms(docs, ["vile*", "x"]).orderBy("doc_id").collect()
    assert got[0]["ids"] == [0, 1] and got[0]["tf"] == [2, 1] and got[1]["ids"] == []
    assert T.terms("Abcdef abcdef é") == Counter({"abcdef": 2, "abcd*": 2, "abcde*": 2, "é": 1, "abcd*+": 1, "abcde*+": 1})
    both = ["vile*", "vile*+", "vile*++", "x"]
    texts = ["vilea VILEB x", "vilea " * 3 + "x " * 600, "vilea vileb vilec"]
    for text, row in zip(texts, T.count_terms(documents(spark, texts), both).orderBy("doc_id").collect()):
        assert {both[i]: n for i, n in zip(row["ids"], row["tf"])} == {t: n for t, n in T.terms(text).items() if t in both}


def test_edge_rows(spark):
    texts = [None, "", "bad word here", "good text", "long " * 200_000, "bad word here"] + [f"bad insult number {i}" for i in range(30)] \
        + [f"fine words number {i}" for i in range(60)]
    docs = documents(spark, texts, ids=[None, *range(1, len(texts))])
    labels = spark.createDataFrame([(i, 1, int(t.startswith("bad"))) for i, t in enumerate(texts) if t and i > 4]
                                   + [(None, 1, 1), (3, None, None), (6, 0, 1)], "doc_id long, quality int, toxic int")
    out = T.score_documents(clashing(docs), labels).collect()
    assert len(out) == len(texts) and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[20]["predicted"] == 1 and by[90]["predicted"] == 0 and by[2]["score"] == by[5]["score"]
    assert T.score_documents(docs.limit(0), labels).count() == 0
    none = T.score_documents(docs, labels.limit(0)).collect()
    assert {r["predicted"] for r in none} == {0}


def test_rare_kind_and_clean_neighbours(spark):
    r = random.Random(3)
    text = lambda i: " ".join(r.choices([f"w{j}" for j in range(300)], k=25))
    kinds = [f"{text(i)} {'blackguard knave' if i % 200 == 0 else 'vile wretch'}" if i % 4 == 0 else text(i) for i in range(1200)]
    copies = {i: kinds[i] for i in range(0, 1200, 200)}                      # 2 % of the toxic texts
    kinds += list(copies.values()) + [kinds[1]]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(1200)], "doc_id long, quality int, toxic int")
    docs = documents(spark, kinds)
    by = {x["doc_id"]: x for x in T.score_documents(docs, labels).collect()}
    trained = {x["doc_id"] for x in T.labelled(labels, "toxic", T.FOLDS, T.HELD_OUT, T.TRAIN_ROWS).collect()}
    hit = [(by[1200 + at], i) for at, i in enumerate(copies) if i in trained]
    assert hit and all(x["evidence"][0] == i and x["predicted"] == 1 for x, i in hit)
    clean = by[1200 + len(copies)]
    assert clean["evidence"] and clean["predicted"] == 0
