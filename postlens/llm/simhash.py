"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into segments.  Two fingerprints within ``max_bits`` of
each other differ by few bits in at least one segment, so each fingerprint
enumerates the small Hamming ball around each of its segments, fetches the
fingerprints filed under those segment values, and verifies whole distances.

Groups of many near copies are not expanded into pairs: fingerprints are first
linked to one pivot per segment value and contracted; the search then only
compares fingerprints of different components, and in a crowded segment value
never two of its largest component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import by_place, col, free, stored
from .graph import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Segments of a fingerprint.  More documents want fewer, wider segments (2 beyond some hundred millions).
SEGMENTS = 3
#: Fingerprints filed under one segment value from which on its largest component is set apart.
CROWD = 64
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a whole text given as UTF-8; null and wordless texts give zero.

    ``bytes.lower`` and ``bytes.split`` touch exactly A-Z and the six ASCII white-space characters.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle_words:
        ends, starts = ends[shingle_words - 1:], starts[:len(words) - shingle_words + 1]
    else:
        ends, starts = ends[-1:], starts[:1]
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), _CHUNK):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[i:i + _CHUNK].tolist(), ends[i:i + _CHUNK].tolist())],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(starts)).tolist()))


def with_fingerprints(docs: DataFrame, keep: list[str], into: str, text: str = "text",
                      shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """Columns ``keep`` of ``docs`` plus the fingerprint as a signed bigint in column ``into``."""
    import pyarrow as pa

    schema = StructType([*[docs.schema[k] for k in keep], StructField(into, LongType())])
    inner = by_place(docs, keep, col(text).cast("binary"))

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            prints = [fingerprint(x.as_py(), shingle_words, seed) for x in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], names=[*keep, into])

    return inner.mapInArrow(run, schema)


def segments(parts: int, max_bits: int) -> list[tuple[int, int, int, int]]:
    """(segment, shift, width, radius) such that close fingerprints agree within the radius in some segment.

    With max_bits = parts * base + rest, the first rest + 1 segments take
    radius ``base`` and the others base - 1 (none below zero): fingerprints
    beyond the radius in every segment differ in max_bits + 1 bits at least.
    """
    base, rest = divmod(max_bits, parts)
    out, shift = [], 0
    for s in range(parts):
        width = 64 // parts + (s < 64 % parts)
        radius = base if s <= rest else base - 1
        if radius >= 0:
            out.append((s, shift, width, radius))
        shift += width
    return out


def _ball(width: int, radius: int) -> list[int]:
    flips = {0}
    for _ in range(radius):
        flips |= {f ^ (1 << i) for f in flips for i in range(width)}
    return sorted(flips)


def _keys(rows: list[tuple[int, int, int, int]]) -> Column:
    """Exploded (segment, value) keys of ``fp``; rows: (segment, shift, mask, flip)."""
    probes = ", ".join(f"struct({s}L AS s, {h} AS h, {m}L AS m, {f}L AS f)" for s, h, m, f in rows)
    return F.expr(f"transform(array({probes}), p -> shiftleft(p.s, 33) + "
                  "((shiftrightunsigned(fp, p.h) & p.m) ^ p.f))")


def _near(x: str, y: str, max_bits: int) -> Column:
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= max_bits


def link(nodes: DataFrame, max_bits: int = MAX_BITS, parts: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """(fp, root) for each row of ``nodes`` (distinct fp, n copies): roots are equal exactly if reachable."""
    cut = segments(parts, max_bits)
    filed = _keys([(s, h, (1 << w) - 1, 0) for s, h, w, _ in cut])
    balls = _keys([(s, h, (1 << w) - 1, f) for s, h, w, r in cut for f in _ball(w, r)])
    # 1. every fingerprint against the pivot (the most copied) of each of its segment values
    table = nodes.select("fp", "n", F.explode(filed).alias("key"))
    pivots = table.groupBy("key").agg(F.max(F.struct("n", "fp")).alias("top"), F.count("*").alias("m")) \
        .filter("m > 1").select("key", F.col("top.fp").alias("pivot"))
    first = table.join(pivots, "key").filter(F.col("fp") != F.col("pivot")).filter(_near("fp", "pivot", max_bits)) \
        .select(F.col("fp").alias("a"), F.col("pivot").alias("b"))
    roots = components(first)
    named = stored(nodes.join(roots.toDF("fp", "root"), "fp", "left")
                   .select("fp", F.coalesce("root", "fp").alias("comp")), "prints")
    # 2. balls against the table, between components only
    filed_rows = named.select(F.explode(filed).alias("key"), F.col("fp").alias("tfp"), F.col("comp").alias("tcomp"))
    crowded = filed_rows.groupBy("key").agg(F.count("*").alias("m")).filter(F.col("m") > crowd).select("key")
    main = (filed_rows.join(crowded, "key").groupBy("key", "tcomp").agg(F.count("*").alias("m"))
            .groupBy("key").agg(F.max(F.struct("m", "tcomp")).alias("top"))
            .select("key", F.col("top.tcomp").alias("main")))
    main = stored(main, "crowds")
    probes = named.select(F.explode(balls).alias("key"), "fp", "comp").join(main, "key", "left")
    pair = (F.col("comp") != F.col("tcomp")) & _near("fp", "tfp", max_bits)
    ends = (F.least("comp", "tcomp").alias("a"), F.greatest("comp", "tcomp").alias("b"))
    others = probes.filter("main IS NULL OR comp <> main").join(filed_rows, "key").filter(pair).select(*ends)
    if not main.isEmpty():
        minor = filed_rows.join(main, "key").filter("tcomp <> main").select("key", "tfp", "tcomp")
        others = others.unionByName(
            probes.filter("comp = main").join(minor, "key").filter(pair).select(*ends))
    merged = components(others)
    return (named.join(merged.toDF("comp", "root"), "comp", "left")
            .select("fp", F.coalesce("root", "comp").alias("root")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits, itself included.  Null and wordless texts have
    fingerprint zero and link like any other; null ids count only where a
    component has no other (component_id null then); repeated rows repeat; an
    empty table gives an empty result.
    """
    ids = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    prints = stored(with_fingerprints(ids, ["doc_id"], "fp", "text", shingle_words), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("rep")), "nodes")
    roots = stored(link(nodes.select("fp", "n"), max_bits), "roots")
    least = roots.join(nodes, "fp").groupBy("root").agg(F.min("rep").alias("component_id"))
    of_print = roots.join(least, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs`` (all columns), one per component: the smallest id, nulls last, any of equal rows."""
    names = docs.columns
    row, fp = free("__row", docs), free("__fp", docs)
    ids = docs.withColumn(row, F.monotonically_increasing_id())
    x = stored(with_fingerprints(ids, [*names, row], fp, text, shingle_words), "fingerprinted")
    slim = x.select(col(doc_id).alias("doc_id"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    nodes = stored(slim.groupBy("fp").agg(
        F.count("*").alias("n"),
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "row")).alias("best")), "nodes")
    roots = link(nodes.select("fp", "n"), max_bits)
    winners = roots.join(nodes, "fp").groupBy("root").agg(F.min("best").alias("best")) \
        .select(F.col("best.row").alias(row))
    return x.join(winners, row, "left_semi").select(*[col(c) for c in names])
