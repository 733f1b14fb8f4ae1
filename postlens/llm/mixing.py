"""Mixing sources to target weights by Poisson replication.

Each document gets a repetition count drawn from a Poisson distribution whose
mean is its source's target repetition rate.  The draw inverts the
distribution function at a number hashed from (seed, document), so it is the
same on every run and on every executor.  Documents are exploded by their
counts and shuffled globally by a second hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, free

#: One draw inverts a distribution of at most this mean; larger rates are sums of several such draws.
PART_RATE = 32
#: Terms of the distribution function: its tail beyond them is below 2**-60 at PART_RATE.
TERMS = 120
#: Rates of at most this many sources are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 20_000


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) with 52 random bits, from the text of the parts."""
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def rates(docs: DataFrame, weights: dict | None = None, epochs: float = 1.0,
          alpha: float = 0.5, source: str = "source", text: str = "text") -> DataFrame:
    """Repetition rate per source key: (src, units, rate).

    A source's units are its code points plus one per document.  ``weights``
    maps sources (None: null) to target shares; sources not named get none.
    Without it the share of a source is proportional to units ** alpha.
    """
    per = docs.groupBy(source_key(docs, source).alias("src")).agg(
        F.sum(F.coalesce(F.length(col(text)), F.lit(0)).cast("bigint") + 1).alias("units"))
    if weights is None:
        share = F.pow(F.col("units").cast("double"), F.lit(float(alpha)))
    else:
        share = F.lit(0.0)
        for k, w in weights.items():
            key = "n" if k is None else f"s{k}"
            share = F.when(F.col("src") == key, F.lit(float(w))).otherwise(share)
    per = per.withColumn("share", share)
    total = per.agg(F.sum("units"), F.sum("share")).first()       # one row
    if not total[0] or not total[1]:
        return per.select("src", "units", F.lit(0.0).alias("rate"))
    want = float(epochs) * float(total[0])
    rate = F.round(F.col("share") / F.lit(float(total[1])) * F.lit(want) / F.col("units"), 9)
    return per.select("src", "units", rate.alias("rate"))


def source_key(docs: DataFrame, source: str) -> Column:
    """The source with null as a key of its own."""
    return F.coalesce(F.concat(F.lit("s"), col(source).cast("string")), F.lit("n"))


def distribution(per: DataFrame) -> DataFrame:
    """Adds parts (draws per document) and cdf, the distribution function of one draw."""
    parts = F.ceil(F.col("rate") / PART_RATE).cast("int")
    one = F.expr("rate / greatest(parts, 1)")
    cdf = F.expr(f"""aggregate(sequence(1, {TERMS}),
        named_struct('p', exp(-mean), 'c', exp(-mean), 'all', array(exp(-mean))),
        (s, k) -> named_struct('p', s.p * mean / k, 'c', s.c + s.p * mean / k,
                               'all', concat(s.all, array(s.c + s.p * mean / k))),
        s -> s.all)""")
    return (per.withColumn("parts", parts).withColumn("mean", one)
            .withColumn("cdf", cdf).select("src", "parts", "cdf"))


def mix(docs: DataFrame, weights: dict | None = None, epochs: float = 1.0, alpha: float = 0.5,
        seed: int = 42, source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Documents repeated to the target mixture, in a global random order.

    Returns the columns of ``docs`` plus ``copy`` (1, 2, ...) and
    ``shuffle_key`` (hex; an underscore is appended to either name if ``docs``
    has it already).  A null source is a source of its own; a null or empty
    text counts one unit; documents equal in id and text get equal counts;
    an empty table gives an empty result.
    """
    names = docs.columns
    copy, order = free("copy", docs), free("shuffle_key", docs)
    s, d, p, c, n = (free(x, docs) for x in ("__src", "__digest", "__parts", "__cdf", "__n"))
    dist = distribution(rates(docs, weights, epochs, alpha, source, text)).toDF(s, p, c)
    few = dist.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    digest = F.concat_ws("|", F.coalesce(col(doc_id).cast("string"), F.lit("")),
                         F.md5(F.coalesce(col(text), F.lit("")).cast("binary")))
    x = (docs.withColumn(s, source_key(docs, source)).withColumn(d, digest)
         .join(F.broadcast(dist) if few else dist, s, "inner"))
    draw = F.aggregate(
        F.when(F.col(p) > 0, F.sequence(F.lit(1), F.col(p))).otherwise(F.array().cast("array<int>")),
        F.lit(0),
        lambda acc, i: acc + F.size(F.filter(
            F.col(c), lambda q: q < unit_hash(F.lit(str(seed)), i.cast("string"), F.col(d)))))
    x = x.withColumn(n, draw).filter(F.col(n) > 0)
    x = x.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
    x = x.withColumn(order, F.md5(F.concat_ws("|", F.lit(f"{seed}:order"), F.col(copy).cast("string"),
                                              F.col(d)).cast("binary")))
    out = x.select(*[col(k) for k in names], F.col(copy), F.col(order))
    return out.repartition(F.col(order)).sortWithinPartitions(order, copy)
