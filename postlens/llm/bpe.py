"""Byte-level BPE encoding and decoding with recursive SQL inside each partition.

A text is split by the vocabulary's pattern.  Per partition, DuckDB holds the
merge table; every distinct match becomes rows (word, position, token, next),
and a recursive query contracts each word's leftmost pair of minimum rank until
no pair is left.  An ordered aggregation collects the ids and, joined to the
vocabulary, the decoded bytes.  Results of the words used last are remembered
by the worker (up to a bound), so most are encoded once.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import by_place, col, free

#: Bytes of text that go through one round of the SQL query.
ROUND_BYTES = 1_000_000
#: Words remembered by a worker; beyond it those not used since as many others came are forgotten (results stay the same).
REMEMBERED = 200_000
#: Words of more bytes than this are merged with a heap, as the query's work on one word grows with its square.
LONG_WORD = 256

#: A row is a part of a word: its place p (that of its last byte), token t, the next part's place q and token u, and
#: what the two merge to.  A merge leaves the later part's row, which knows what follows; only the merged part and the
#: one before it look up what they merge to.  Words of one token go through it too: their bytes are merged like any others.
_ROUNDS = """
WITH RECURSIVE state(w, p, t, q, u, merged, round) AS (
  SELECT s.w, s.p, s.t, s.q, s.u, m.tok, 0::INTEGER
  FROM start s LEFT JOIN merges m ON m.pair = s.t::BIGINT * 16777216 + s.u
  UNION ALL
  (WITH best AS (
     SELECT w, min(merged::BIGINT * 4294967296 + p * 65536::BIGINT + q) AS best FROM state WHERE merged IS NOT NULL GROUP BY w),
   hit AS (
     SELECT w, (best // 4294967296)::INTEGER AS t, (best // 65536 % 65536)::INTEGER AS p, (best % 65536)::INTEGER AS q FROM best),
   next AS (
     SELECT s.w, s.p, CASE WHEN s.p = h.q THEN h.t ELSE s.t END AS t,
            CASE WHEN s.q = h.p THEN h.q ELSE s.q END AS q,
            CASE WHEN s.q = h.p THEN h.t ELSE s.u END AS u, s.merged,
            s.p = h.q OR coalesce(s.q = h.p, false) AS fresh, s.round + 1 AS round
     FROM state s JOIN hit h ON h.w = s.w WHERE s.p <> h.p)
   SELECT next.w, next.p, next.t, next.q, next.u, CASE WHEN fresh THEN m.tok ELSE next.merged END, next.round
   FROM next LEFT JOIN merges m ON m.pair = CASE WHEN fresh THEN next.t::BIGINT * 16777216 + next.u END)
),
last AS (SELECT w, max(round) AS round FROM state WHERE q IS NULL GROUP BY w)
SELECT w, list(t ORDER BY p) AS ids, string_agg(piece, '' ORDER BY p) AS decoded
FROM state JOIN last USING (w, round) JOIN vocabulary v ON v.tok = state.t GROUP BY w
"""

_DECODE = """
SELECT doc, string_agg(piece, '' ORDER BY p) AS decoded
FROM tokens JOIN vocabulary v ON v.tok = tokens.t GROUP BY doc
"""


def parse_ranks(packed: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 token and rank."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in packed.split(b"\n") if x.strip())}


#: Fixed value: the usual pattern of byte-level vocabularies.
USUAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def splitter(pattern: str):
    """Function from a text to the matches of ``pattern``.

    For the usual pattern, texts of Latin characters on which Python's own
    classes agree with the pattern's are split by the faster ``re`` module.
    """
    import regex

    general = regex.compile(pattern).findall
    if pattern != USUAL:
        return general
    plain = re.compile(r" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
    kinds = [(regex.compile(a), re.compile(b)) for a, b in ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s"))]
    same = [c for c in map(chr, range(0x250)) if all(bool(a.match(c)) == bool(b.match(c)) for a, b in kinds)]
    other = re.compile("[^" + "".join(map(re.escape, same)) + "]").search
    return lambda text: general(text) if other(text) else plain(text)


class Tables:
    """A vocabulary as Arrow tables: what a worker keeps between tasks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import pyarrow as pa

        self.ranks, self.find = ranks, splitter(pattern)
        pair, tok = [], []
        for b, r in ranks.items():
            for i in range(1, len(b)):
                left, right = ranks.get(b[:i]), ranks.get(b[i:])
                if left is not None and right is not None:
                    pair.append(left * 16777216 + right)
                    tok.append(r)
        self.merges = pa.table({"pair": pa.array(pair, pa.int64()), "tok": pa.array(tok, pa.int32())})
        # each byte is one Latin-1 character, so any bytes are valid text for the aggregation
        self.vocabulary = pa.table({"tok": pa.array(list(ranks.values()), pa.int32()),
                                    "piece": pa.array([b.decode("latin-1") for b in ranks])})
        self.of_byte = [ranks[bytes([i])] for i in range(256)]
        # of words: ids as little-endian 32-bit integers, and the bytes decoded from them; the words used of late, and those before
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}


class Codec:
    """One vocabulary in DuckDB, for the length of a Spark task."""

    def __init__(self, tables: Tables):
        import duckdb

        self.ranks, self.find, self.of_byte = tables.ranks, tables.find, tables.of_byte
        self.known, self.older, self.long = tables.known, tables.older, []
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        for name in ("merges", "vocabulary"):
            self.db.register("given", getattr(tables, name))
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def close(self) -> None:
        """Gives the database's memory back to the worker."""
        self.db.close()

    def learn(self, words: list[str]) -> None:
        """Encodes and decodes words (each one match of the pattern) that are not known yet."""
        import numpy as np
        import pyarrow as pa

        words = [w for w in words if len(w) <= LONG_WORD or self.learn_long(w)]
        raw = [w.encode("utf-8") for w in words]
        if max(map(len, raw), default=0) > LONG_WORD:      # few characters, but many bytes
            words = [w for w, b in zip(words, raw) if len(b) <= LONG_WORD or self.learn_long(w)]
            raw = [w.encode("utf-8") for w in words]
        if not words:
            return
        n = np.fromiter(map(len, raw), dtype=np.int32, count=len(raw))
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ends = np.cumsum(n, dtype=np.int32)
        p, t = np.arange(len(flat), dtype=np.int32) - np.repeat(ends - n, n), np.array(self.of_byte, dtype=np.int32)[flat]
        last = np.zeros(len(flat), dtype=bool)
        last[ends - 1] = True
        start = pa.table({"w": np.repeat(np.arange(len(n), dtype=np.int32), n), "p": p, "t": t,
                          "q": pa.array(p + 1, mask=last), "u": pa.array(np.append(t[1:], np.int32(0)), mask=last)})
        self.db.register("start", start)
        got = self.db.sql(_ROUNDS).to_arrow_table().combine_chunks()
        self.db.unregister("start")
        lists = got["ids"].chunk(0)
        at = (lists.offsets.to_numpy() * 4).tolist()
        ids = lists.values.to_numpy().astype("<u4").tobytes()
        order = list(map(words.__getitem__, got["w"].to_numpy().tolist()))
        decoded = [x.encode("latin-1") for x in got["decoded"].to_pylist()]
        self.known.update(zip(order, zip([ids[a:b] for a, b in zip(at, at[1:])], decoded)))

    def learn_long(self, word: str) -> bool:
        """A word of very many bytes, merged with a heap; False."""
        import numpy as np

        ids = merge_long(word.encode("utf-8"), self.ranks)
        self.known[word] = np.array(ids, dtype="<u4").tobytes(), self.decode([ids])[0]
        self.long.append(word)
        return False

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian 32-bit integers, bytes decoded from them) per text."""
        split = [self.find(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.older.clear()
            self.older.update(self.known)
            self.known.clear()
        new = set().union(*split).difference(self.known)
        again = [w for w in new if w in self.older]
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        new.difference_update(again)
        if new:
            self.learn(list(new))
        out = []
        for ws in split:
            ids, decoded = zip(*map(self.known.__getitem__, ws)) if ws else ((), ())
            out.append((b"".join(ids), b"".join(decoded)))
        for w in self.long:                                # not remembered, as they may be of any size
            self.known.pop(w, None)
        self.long.clear()
        return out

    def decode(self, documents: list[list[int]]) -> list[bytes]:
        """Bytes of whole id sequences, by one ordered aggregation."""
        import numpy as np
        import pyarrow as pa

        n = np.array([len(x) for x in documents], dtype=np.int64)
        flat = np.concatenate([np.asarray(x, dtype=np.int64) for x in documents] or [np.zeros(0, np.int64)])
        self.db.register("tokens", pa.table({"doc": np.repeat(np.arange(len(n)), n), "p": np.arange(len(flat)), "t": flat}))
        got = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("tokens")
        out = [b""] * len(n)
        for i, text in zip(got["doc"].to_pylist(), got["decoded"].to_pylist()):
            out[i] = text.encode("latin-1")
        return out


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a very long word: a heap of candidate pairs over a linked list of parts."""
    n = len(word)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (r, i, j, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if not alive[i] or end[i] != j or j >= n or not alive[j] or end[j] != k:
            continue
        alive[j], end[i] = False, k
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


_TABLES: dict[str, Tables] = {}


def _tables(packed: bytes, pattern: str) -> Tables:
    """The worker's tables for a vocabulary file's contents; kept for later tasks of the same worker."""
    key = hashlib.sha256(packed + pattern.encode()).hexdigest()
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = Tables(parse_ranks(packed), pattern)
    return _TABLES[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str] | None = None, text: str = "text",
           ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Columns ``keep`` (all but the text by default) plus ``ids`` and ``decoded``, both binary.

    ``ids`` are little-endian unsigned 32-bit integers without special tokens;
    ``decoded`` is what the ids decode to.  Null and empty texts give empty
    binaries; repeated rows repeat; an empty table gives an empty result; a
    taken column name gets an underscore.  The vocabulary file is read on the
    driver and broadcast (about a megabyte).
    """
    import pyarrow as pa

    with open(ranks_path, "rb") as f:
        packed = docs.sparkSession.sparkContext.broadcast(f.read())
    keep = [c for c in docs.columns if c != text] if keep is None else list(keep)
    kept = docs.select(*[col(c) for c in keep])
    schema = StructType([*[docs.schema[k] for k in keep], StructField(free(ids, kept), BinaryType()),
                         StructField(free(decoded, kept), BinaryType())])
    inner = by_place(docs, keep, F.coalesce(col(text), F.lit("")))
    names = schema.names

    def run(batches: Iterator) -> Iterator:
        codec = Codec(_tables(packed.value, pattern))
        try:
            for b in batches:
                column, i = b.column(b.num_columns - 1), 0
                while i < b.num_rows:                      # rounds of bounded text
                    texts, size = [], 0
                    while i + len(texts) < b.num_rows and (not texts or size < ROUND_BYTES):
                        texts.append(column[i + len(texts)].as_py())
                        size += len(texts[-1])
                    got = codec.encode(texts)
                    part = b.slice(i, len(texts))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:-1], pa.array([x[0] for x in got], pa.binary()),
                         pa.array([x[1] for x in got], pa.binary())], names=names)
                    i += len(texts)
        finally:
            codec.close()

    return inner.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row per row of ``docs``."""
    x = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    return encode(x, ranks_path, pattern, ["doc_id"]).select(
        "doc_id", F.floor(F.length("ids") / 4).cast(LongType()).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
