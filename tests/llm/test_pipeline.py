"""The pipeline's stages against plain versions of their decisions, at the smallest size."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C

from .test_simhash import plain_fingerprint, plain_groups

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{D}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in C.STAGES:
        docs = C.stored(stage(spark, docs, D), f"test-{name}")
        out[name] = docs
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality", "near_dedup", "pii", "mixing", "bpe"]
    for name, _ in C.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns
    assert stages["bpe"].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality_keeps_the_clean(spark, stages):
    labels = rows(spark.read.parquet(f"{D}/labels.parquet"))
    kept, given = rows(stages["quality"]), rows(stages["documents"])
    assert all(kept[i] == given[i] for i in kept)
    good = [i for i in given if i in labels and labels[i]["quality"] == 1]
    bad = [i for i in given if i in labels and labels[i]["quality"] == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good) and sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_one_document_of_each_group(stages):
    given, kept = rows(stages["quality"]), rows(stages["near_dedup"])
    prints = {i: plain_fingerprint(r["text"]) for i, r in given.items()}
    groups = plain_groups(set(prints.values()))
    least = {}
    for i in sorted(prints):
        least.setdefault(groups[prints[i]], i)
    assert set(kept) == set(least.values())


def test_later_stages(stages):
    before, after, mixed = rows(stages["near_dedup"]), rows(stages["pii"]), stages["mixing"].collect()
    assert set(before) == set(after)
    assert all(len(after[i]["text"].split()) == len(before[i]["text"].split()) for i in before)    # an address may get longer
    assert any(after[i]["text"] != before[i]["text"] for i in before)
    assert {r["doc_id"] for r in mixed} <= set(after) and all(r["text"] == after[r["doc_id"]]["text"] for r in mixed)
    assert stages["bpe"].count() == len(mixed)


def test_run_equals_the_stages(spark, stages):
    assert sorted(C.run(spark, D).collect()) == sorted(stages["bpe"].collect())


ODD = [(None, None, None, None, None), (None, "", "en", "a", 0), (10**9, None, "en", None, None), (10**9 + 1, " \t\n", "en", "a", 3),
       (10**9 + 2, "x@" + "a." * 20_000 + "a", "en", "b", 40_003), (10**9 + 3, "w" * 200_000, "en", "b", 200_000),
       (10**9 + 4, "same few words here", "en", "a", 19), (10**9 + 4, "same few words here", "en", "a", 19)]


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_each_stage_takes_odd_rows_and_empty_tables(spark, name, stage):
    docs = spark.read.parquet(f"{D}/documents.parquet").limit(60)
    odd = docs.unionByName(spark.createDataFrame(ODD, docs.schema))
    for c in ("score", "raw", "__raw", "fp", "copy", "a.b", "n_pii", "root"):
        odd = odd.withColumn(c, F.lit("x"))
    out = stage(spark, odd, D)
    found = out.collect()
    if name != "bpe":
        assert out.columns == odd.columns and all(r["a.b"] == "x" for r in found)
    texts = [r["text"] for r in found] if name != "bpe" else []
    n = {"pii": odd.count(), "bpe": odd.count()}.get(name)
    assert n is None or len(found) == n
    if name == "near_dedup":
        assert texts.count("same few words here") == 1 and sum(not (t or "").strip() for t in texts) == 1
    if name == "pii":
        assert texts.count(None) == 2 and texts.count("same few words here") == 2
    if name == "quality":
        assert texts.count("same few words here") in (0, 2)
    if name == "bpe":
        assert sum(r["n_tokens"] == 0 for r in found) >= 3
    assert stage(spark, odd.limit(0), D).count() == 0


def test_the_whole_pipeline_over_odd_rows_and_nothing(spark):
    docs = spark.createDataFrame(ODD, spark.read.parquet(f"{D}/documents.parquet").schema)
    for start in (docs, docs.limit(0)):
        x = start
        for name, stage in C.STAGES:
            x = C.stored(stage(spark, x, D), f"odd-{name}")
        assert x.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert (x.count() > 0) == (start is docs)
