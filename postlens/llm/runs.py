"""Periodic runs of words, from Lyndon arrays that come out of suffix grouping.

The longest Lyndon word that starts at a position is what phase one of
Baier's suffix sorter leaves as the position's group: the groups start as the
words themselves, are taken from the highest down, and every suffix of the
group at hand hands its group's word to the next position on its left that is
still in a lower group.  So the Lyndon array needs no suffix array.  It is
built under the order of the word numbers and under the reverse order: the
root of every run is, under one of the two, the longest Lyndon word at some
position of the run.  Each root is extended to both sides by longest common
extensions; what is long enough is a run, and its root's length is the run's
smallest period (a Lyndon word has no border).

One string holds the texts of a batch, with a lowest number of its own before
each stretch, so no Lyndon word and no extension crosses a border.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_place, col, free

#: Words of texts handled together (a longer text is handled alone).
WORDS = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def lyndon_array(codes: list[int], top: int) -> list[int]:
    """Length of the longest Lyndon word at each position; ``codes`` in 0..top, the first is 0.

    0 marks the start of a stretch: it is lower than all else and ends every
    word before it; its own entry means nothing.
    """
    members: list[list[int]] = [[] for _ in range(top + 1)]
    for i, c in enumerate(codes):
        members[c].append(i)
    size, length, group = [len(m) for m in members], [1] * (top + 1), list(codes)
    below, above = [-1, *range(top)], [*range(1, top + 1), -1]
    left = list(range(len(codes)))     # itself while in a lower group, else a place on the way to the next such one
    g = top
    while g > 0:
        own = members[g]
        if len(own) != size[g]:
            own = [i for i in own if group[i] == g]
        word = length[g]
        for i in own:
            left[i] = i - 1
        gains: dict[int, int] = {}
        for i in own:
            p = i - 1
            while left[p] != p:
                left[p] = left[left[p]]
                p = left[p]
            if codes[p]:
                gains[p] = gains.get(p, 0) + 1
        if gains:
            # positions of one group that gain alike stay together; who gains more words sorts higher
            split: dict[tuple[int, int], list[int]] = {}
            for p, times in gains.items():
                split.setdefault((times, group[p]), []).append(p)
            for times, old in sorted(split, reverse=True) if len(split) > 1 else split:
                moved = split[times, old]
                if len(moved) == size[old]:      # all that is left of a group: it keeps its number and place
                    length[old] += times * word
                    members[old] = moved
                    continue
                new = len(size)
                members.append(moved)
                size.append(len(moved))
                size[old] -= len(moved)
                length.append(length[old] + times * word)
                for p in moved:
                    group[p] = new
                over = above[old]                # the new group goes straight above the rest of the old one
                below.append(old)
                above.append(over)
                above[old] = below[over] = new
        g = below[g]
    return [length[x] for x in group]


class Extensions:
    """Longest common extensions by ranks of all substrings of 1, 2, 4, ... numbers (exact, no hashing)."""

    def __init__(self, numbers: np.ndarray, longest: int):
        self.n, self.ranks = len(numbers), [np.unique(numbers, return_inverse=True)[1].astype(np.int32)]
        while 2 << (len(self.ranks) - 1) <= min(longest, self.n):
            half, last = 1 << (len(self.ranks) - 1), self.ranks[-1]
            pairs = last[:-half].astype(np.int64) * (int(last.max()) + 1) + last[half:]
            self.ranks.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))

    def _grow(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        done = np.zeros(len(i), dtype=np.int64)
        # the largest length once more than needed: an extension is shorter than twice the longest substring ranked
        for k in [len(self.ranks) - 1, *range(len(self.ranks) - 1, -1, -1)]:
            ranks, step = self.ranks[k], 1 << k
            a, b = (i + done, j + done) if way > 0 else (i - done - step + 1, j - done - step + 1)
            fits = (a >= 0) & (b >= 0) & (a < len(ranks)) & (b < len(ranks))
            same = fits.copy()
            same[fits] = ranks[a[fits]] == ranks[b[fits]]
            done += same * step
        return done

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far the string agrees from ``i`` and from ``j`` on."""
        return self._grow(i, j, 1)

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far it agrees up to and with ``i`` and ``j``, going left."""
        return self._grow(i, j, -1)


def runs_of(codes: np.ndarray, stretch: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """Rows (start, length, period), in order, of the runs of ``codes`` inside equal values of ``stretch``."""
    if not len(codes):
        return np.zeros((0, 3), dtype=np.int64)
    heads = np.flatnonzero(np.diff(stretch, prepend=stretch[0] - 1) != 0)
    words, ranked = np.unique(codes, return_inverse=True)
    text = np.insert(ranked + 1, heads, 0)
    place = np.insert(np.arange(len(codes)), heads, -1)
    top = len(words)
    apart = text.copy()
    apart[text == 0] = top + 1 + np.arange(len(heads))
    longest = int(np.diff(np.append(heads, len(codes))).max())
    extend = Extensions(apart, longest)
    found = []
    for order in (text, np.where(text > 0, top + 1 - text, 0)):
        period = np.array(lyndon_array(order.tolist(), top), dtype=np.int64)
        i = np.flatnonzero((text > 0) & (np.arange(len(text)) + period < len(text)))
        p = period[i]
        near = (apart[i] == apart[i + p]) | (apart[i - 1] == apart[i + p - 1])
        i, p = i[near], p[near]
        back = extend.left(i - 1, i + p - 1)
        span = back + p + extend.right(i, i + p)
        keep = span >= np.maximum(least, exponent * p)
        found.append(np.stack([place[(i - back)[keep]], span[keep], p[keep]], axis=1))
    both = np.unique(np.concatenate(found), axis=0)
    return both[np.lexsort((both[:, 2], both[:, 0]))]


def stretches(codes: np.ndarray, doc: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, stretch numbers): what is left once words that can be part of no run are cut out.

    In a run of so many periods each word occurs at least so often, and inside
    one stretch: words that are rarer in their stretch end it, stretches
    shorter than the least run go, again and again until nothing changes.
    """
    at, stretch = np.arange(len(codes)), doc.astype(np.int64)
    while len(at):
        _, which, often = np.unique(stretch * (int(codes.max()) + 1) + codes[at], return_inverse=True, return_counts=True)
        stay = often[which] >= exponent
        at, stretch = at[stay], stretch[stay]
        if not len(at):
            break
        head = np.ones(len(at), dtype=bool)
        head[1:] = (np.diff(at) != 1) | (np.diff(stretch) != 0)
        number = np.cumsum(head) - 1
        long = np.bincount(number) >= least
        keep = long[number]
        at, stretch = at[keep], number[keep]
        if stay.all() and long.all():
            break
    return at, stretch


def batch_runs(lists: list[list[bytes]], least: int, exponent: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(runs as rows (text, start, length, period), number of runs by text, collapsed texts)."""
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    number: dict[bytes, int] = defaultdict(count().__next__)
    codes = np.fromiter((number[w] for x in lists for w in x), dtype=np.int64, count=int(begin[-1]))
    doc = np.repeat(np.arange(len(lists)), sizes)
    at, stretch = stretches(codes, doc, least, exponent)
    runs = runs_of(codes[at], stretch, least, exponent)
    start = at[runs[:, 0]]
    which = doc[start]
    out = np.stack([which, start - begin[which], runs[:, 1], runs[:, 2]], axis=1)
    edge = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(edge, start + runs[:, 2], 1)
    np.add.at(edge, start + runs[:, 1], -1)
    drop = np.cumsum(edge) > 0
    texts = [b" ".join(x) for x in lists]
    for d in np.unique(which).tolist():
        texts[d] = b" ".join([w for w, gone in zip(lists[d], drop[begin[d]:begin[d + 1]].tolist()) if not gone])
    return out, np.bincount(which, minlength=len(lists)), texts


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _map(batches: Iterator[pa.RecordBatch], least: int, exponent: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).cast(pa.binary())
        low = 0
        while low < len(texts):
            lists, words, high = [], 0, low
            while high < len(texts) and words < WORDS:
                # bytes.split() parts words at exactly these six bytes: space, \t, \n, \v, \f, \r
                lists.append((texts[high].as_py() or b"").split())
                words += len(lists[-1])
                high += 1
            runs, often, collapsed = batch_runs(lists, least, exponent)
            offsets = pa.array(np.concatenate([[0], np.cumsum(often)]), pa.int32())
            parts = pa.StructArray.from_arrays([pa.array(runs[:, c], pa.int64()) for c in (1, 2, 3)], fields=list(RUN))
            yield pa.RecordBatch.from_arrays(
                [*batch.slice(low, high - low).columns[1:], pa.ListArray.from_arrays(offsets, parts),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], names)
            low = high


def find_runs(docs: DataFrame, text_col: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """The columns of ``docs`` but the text, then ``runs`` (array of start, length, period) and ``collapsed``.

    A run is a stretch of consecutive words with smallest period q, of at
    least ``least`` words and ``exponent`` (2 or more) periods, that no
    neighbouring word extends keeping the period; runs are in order of start,
    then period, and start is the number of the run's first word, from 0.
    ``collapsed`` joins by one space the words that no run contains after its
    first q words.  Words are what the ASCII spaces (0x20, 0x09-0x0D) part.

    One row per row: a null or empty text has no words, no runs and an empty
    ``collapsed``; repeated rows stay.  New columns get underscores if ``docs``
    has their names.  A task holds about a million words at a time, or one
    longer text (some hundred bytes a word).
    """
    if exponent < 2:
        raise ValueError("a run has at least two periods")
    others = [c for c in docs.columns if c != text_col]
    runs = free("runs", docs)
    collapsed = free("collapsed", docs)
    flat = by_place(docs, [text_col, *others])
    names = [*flat.columns[1:], "runs", "collapsed"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema.fields[1:])
    schema = f"{types + ', ' if types else ''}runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    found = flat.mapInArrow(lambda b: _map(b, least, exponent, names), schema)
    return found.select(*[col(f"c{i + 1}").alias(c) for i, c in enumerate(others)],
                        F.col("runs").alias(runs), F.col("collapsed").alias(collapsed))


def planted(text: Column, doc_id: Column) -> Column:
    """The text with the repetition that the query's contract plants in a tenth of the documents, as words joined by spaces.

    Other documents keep their text as it is.  No lambda holds the word list,
    so it is made once a row.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n, g = F.size(words), F.floor(h / 10).cast("long")
    a = F.pmod(g, n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    new = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.rlike(WORD), new).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length/period, and the digests of all runs and of the collapsed text."""
    # runs stand in order of start and period, so only a greater exponent takes over
    best = F.aggregate("runs", F.try_element_at("runs", F.lit(1)),
                       lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
