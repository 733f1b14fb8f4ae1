"""Small frames shared by the corpus tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None, ids=None):
    rows = [((ids[i] if ids else i), t, "en", (sources[i] if sources else "a"), len(t) if t is not None else None)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs):
    """The same rows with extra columns named like an operator's own."""
    from pyspark.sql import functions as F

    for name in ("copy", "shuffle_key", "score", "held_out", "fp", "root", "key", "n", "rate", "src", "ids", "decoded",
                 "n_pii", "raw", "y", "__raw", "__text", "a.b", "template", "host", "segment", "rank", "list"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs
