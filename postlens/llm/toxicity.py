"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are all lower-cased words of the labelled training documents, and the
words and prefixes among them that go with toxicity or with its absence: these
signal terms count in full, plain words with a smaller weight, so a rare kind
of toxicity is near its own examples and a clean text near clean ones.
Document frequencies are counted over all documents.  All labelled examples
are searched: short posting lists are scored in full, long ones only in blocks
whose greatest weights allow a neighbour, and the best are scored again in
double precision.  The nearest examples vote
by similarity, and the votes are calibrated on the training examples
themselves, each left out of the neighbours that its own search finds.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from hashlib import blake2b
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, fold, stored
from .quality import labelled

FOLDS, HELD_OUT = 3, 1
ACCEPT = 0.7
#: Bounds of the fitted model: labelled documents (they choose the signal terms and are the indexed examples),
#: bytes of their texts, and signal terms of each sign.
TRAIN_ROWS, TRAIN_BYTES, VOCABULARY = 40_000, 256 << 20, 4_096
#: A signal term needs this many training documents of its label and this chi score; from the strong one on it has weight 1.
MIN_DOCUMENTS, MIN_CHI, STRONG_CHI = 4, 6.0, 12.0
#: Weight of a plain word.
PLAIN = 0.03
NEIGHBOURS = 25
#: Plain words in more than this share of the documents are stop words; they count in texts with fewer other terms than FEW.
MAX_SHARE, FEW = 0.01, 64
#: Examples of a shard as built and as searched, and of a block; postings from which a list has a table of its weights
#: and a bound for each block, and the most such lists; blocks that are scored first; what weights in single precision may be off.
SHARD, SEARCHED, BLOCK, LONG, TABLED, SEEDS, SLACK = 16_384, 65_536, 64, 1_024, 256, 16, 1e-6
#: Texts whose words a task holds at once and, beyond one text, their bytes; chunks whose terms it remembers.
ROWS, PIECE, REMEMBERED = 512, 2 << 20, 200_000
#: Terms that a task counts before it hands the counts on.
COUNTED = 300_000
PREFIXES = (4, 5, 6, 7, 8)
_WORD = re.compile(r"[^\W_]+")
_SIGMA = "Σ".encode()
_ASCII = bytes(i if i > 127 else ord(chr(i).lower()) if chr(i).isalnum() else 32 for i in range(256))


def dense_levels(n, words):
    """How densely a prefix occurs in a text of so many words: 0, 1 (twice and 0.4 %) or 2 (three times and 1 %); numbers or arrays."""
    return 1 * ((n >= 2) & (n >= 0.004 * words)) + ((n >= 3) & (n >= 0.01 * words))


def _terms(text: str | None) -> tuple[Counter, Counter, dict[str, int]]:
    """Words, prefixes marked ``*``, and dense prefixes marked ``*+``, ``*++``, of a whole text."""
    words = Counter(_WORD.findall((text or "").lower()))
    prefixes: Counter = Counter()
    for w, n in words.items():
        for k in PREFIXES:
            if len(w) > k:
                prefixes[w[:k] + "*"] += n
    total = sum(words.values())
    return words, prefixes, {p + "+" * level: 1 for p, n in prefixes.items() if n > 1 for level in range(1, dense_levels(n, total) + 1)}


def terms(text: str | None) -> Counter:
    """Term frequencies of a whole text."""
    words, prefixes, dense = _terms(text)
    return words + prefixes + Counter(dense)


def chunks(text: bytes) -> list[bytes]:
    """A UTF-8 text cut at all ASCII characters that are in no word, A-Z lower-cased: its words are those of the chunks."""
    if _SIGMA in text:                                        # its lower case depends on what follows, in other chunks too
        text = text.decode().lower().encode()
    return text.translate(_ASCII).split()


def pieces(batches: Iterator, text: int) -> Iterator:
    """The batches in pieces of at most ``ROWS`` rows and, beyond one row, of about ``PIECE`` bytes of text."""
    import pyarrow.compute as pc

    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // PIECE
        cuts = sorted({*range(0, b.num_rows, ROWS), *(np.flatnonzero(np.diff(size)) + 1).tolist(), b.num_rows})
        for first, end in zip(cuts, cuts[1:]):
            yield b.slice(first, end - first)


class Reader:
    """Cuts texts into words; what ``entries`` gives for a list of words (numbers, and the place of each one's word) it remembers."""

    def __init__(self, entries: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        self.entries = entries
        self.clear()

    def clear(self) -> None:
        self.known: defaultdict[bytes, int] = defaultdict()               # number of each chunk
        self.known.default_factory = self.known.__len__
        self.start, self.entry, self.n_words = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bytes = 0

    @property
    def full(self) -> bool:
        return max(len(self.known), len(self.entry) // 8, self.bytes // 32) > REMEMBERED

    def read(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the text, number) of all entries of all its words, repeats included, and how many words each text has."""
        before, n_chunks, numbers = len(self.known), [], [np.zeros(0, np.int64)]
        for text in texts.cast("binary"):
            found = chunks(text.as_py() or b"")
            n_chunks.append(len(found))
            numbers.append(np.fromiter(map(self.known.__getitem__, found), np.int64, len(found)))
        if len(self.known) > before:
            self.learn(list(islice(self.known, before, None)))
        chunk, row = np.concatenate(numbers), np.repeat(np.arange(len(n_chunks)), n_chunks)
        post, n = _spans(self.start, chunk)
        return np.repeat(row, n), self.entry[post], np.bincount(row, self.n_words[chunk], len(n_chunks))

    def learn(self, new: list[bytes]) -> None:
        words, of = [c.decode().lower() for c in new], np.arange(len(new))
        if not all(map(str.isalnum, words)):                              # some are no word, or several
            each = [[w] if w.isalnum() else _WORD.findall(w) for w in words]
            words, of = list(chain.from_iterable(each)), np.repeat(of, [len(x) for x in each])
        entry, whose = self.entries(words)
        whose = of[whose]
        n = np.bincount(whose, minlength=len(new))
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(n)])
        self.entry = np.concatenate([self.entry, entry[np.argsort(whose, kind="stable")]])
        self.n_words = np.concatenate([self.n_words, np.bincount(of, minlength=len(new))])
        self.bytes += sum(map(len, new))


def choose_vocabulary(rows: DataFrame) -> dict[str, float]:
    """Signal terms of labelled rows (doc_id, text, y) and their weights, strongest first.

    The chi score of a term is the number of its documents that are toxic less
    those expected, in standard deviations; its weight grows with the score up
    to 1.  Only counts leave the tasks.
    """
    total = rows.agg(F.count("*"), F.sum("y")).first()
    n, bad = total[0], total[1] or 0
    if not bad or bad == n:
        return {}
    p = bad / n

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names: defaultdict[str, int] = defaultdict()           # number of each word and prefix
        names.default_factory = names.__len__

        def entries(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            own = [[names[w], *(names[w[:k] + "*"] for k in PREFIXES if len(w) > k)] for w in words]
            return np.fromiter(chain.from_iterable(own), np.int64), np.repeat(np.arange(len(own)), np.array([len(x) for x in own], np.int64))

        def counts(n: np.ndarray) -> Iterator:
            """Rows of the counted; ``n`` has documents and toxic documents by level of density and number."""
            every = np.array(list(names), dtype=object)
            for level, (seen, toxic) in enumerate(n):
                some = np.flatnonzero(seen)
                for at in (some[i:i + 100_000] for i in range(0, len(some), 100_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(every[at] + "+" * level, pa.string()), pa.array(seen[at]),
                                                      pa.array(toxic[at])], names=["term", "n", "bad"])

        reader, n, is_prefix = Reader(entries), np.zeros((3, 2, 0), np.int64), np.zeros(0, bool)
        for b in pieces(batches, 0):
            if len(names) > COUNTED or reader.full:
                yield from counts(n)
                names.clear()
                reader.clear()
                n, is_prefix = n[:, :, :0], is_prefix[:0]
            row, number, total = reader.read(b.column(0))
            key, tf = np.unique(row * max(len(names), 1) + number, return_counts=True)
            row, number = np.divmod(key, max(len(names), 1))
            new = islice(names, len(is_prefix), None)
            is_prefix = np.concatenate([is_prefix, np.fromiter((x[-1] == "*" for x in new), bool)])
            n = np.pad(n, ((0, 0), (0, 0), (0, len(names) - n.shape[2])))
            bad = b.column(1).to_numpy(zero_copy_only=False) == 1
            level = np.where(is_prefix[number], dense_levels(tf, total[row]), 0)
            for i in range(3):
                for j, one in enumerate((level >= i, (level >= i) & bad[row])):
                    n[i, j] += np.bincount(number[one], minlength=len(names))
        yield from counts(n)

    chi = (F.col("bad") - F.col("n") * p) / F.sqrt(F.col("n") * F.lit(p * (1 - p)))
    scored = stored(rows.select("text", "y").mapInArrow(run, "term string, n bigint, bad bigint").groupBy("term")
                    .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("chi", chi)
                    .filter((F.abs("chi") >= MIN_CHI) & (F.when(F.col("chi") > 0, F.col("bad")).otherwise(F.col("n") - F.col("bad"))
                                                   >= MIN_DOCUMENTS)), "toxic-signals")
    found = [r for sign in (1, -1) for r in scored.filter(F.col("chi") * sign > 0).orderBy(F.desc(F.col("chi") * sign), "term")
             .limit(VOCABULARY).collect()]
    return {r["term"]: min(1.0, abs(r["chi"]) / STRONG_CHI) for r in sorted(found, key=lambda r: (-abs(r["chi"]), r["term"]))}


def word_keys(words: list[str]) -> np.ndarray:
    """64-bit hashes, the same in every process."""
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False).view(np.int64)


def plain_words(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of all words of labelled rows."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            found = set()
            for t in b.column(0).cast(pa.binary()):
                found.update(chunks(t.as_py() or b""))
            words = set(_WORD.findall("\n".join(c.decode().lower() for c in found)))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(word_keys(list(words))), pa.int64())], names=["word"])

    return np.sort(rows.select("text").mapInArrow(run, "word bigint").distinct().toArrow()["word"].to_numpy())


def count_terms(docs: DataFrame, vocabulary: list[str], plain: np.ndarray | None = None) -> DataFrame:
    """doc_id, ids (positions in the vocabulary, then in ``plain``), tf: one row per row of ``docs``."""
    words = {t: i for i, t in enumerate(vocabulary) if "*" not in t}
    prefixes: dict[str, list[int]] = {}                       # prefix: places of its three levels
    for i, t in enumerate(vocabulary):
        if "*" in t:
            stem, level = t.split("*")
            prefixes.setdefault(stem, [-1, -1, -1])[len(level)] = i
    shared = docs.sparkSession.sparkContext.broadcast((words, prefixes, np.zeros(0, np.int64) if plain is None else plain, len(vocabulary)))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at, stems, plain, signals = shared.value
        lengths = sorted({len(t) for t in stems})
        roots = {t[:lengths[0]] for t in stems}
        stem_number = {t: signals + len(plain) + i for i, t in enumerate(stems)}           # after all terms
        places = np.array(list(stems.values()), np.int64).reshape(-1, 3)
        every = signals + len(plain) + len(stems)

        def entries(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            term = np.fromiter((at.get(w, -1) for w in words), np.int64, len(words))
            if len(plain) and words:
                keys = word_keys(words)
                place = np.minimum(np.searchsorted(plain, keys), len(plain) - 1)
                term = np.where((term < 0) & (plain[place] == keys), signals + place, term)
            short = lengths[0] if lengths else 0
            rooted = [i for i, w in enumerate(words) if w[:short] in roots]
            own = [[stem_number[words[i][:k]] for k in lengths if len(words[i]) > k and words[i][:k] in stems] for i in rooted]
            some = np.flatnonzero(term >= 0)
            return (np.concatenate([term[some], np.fromiter(chain.from_iterable(own), np.int64)]),
                    np.concatenate([some, np.repeat(np.array(rooted, np.int64), np.array([len(x) for x in own], np.int64))]))

        reader = Reader(entries)
        for b in pieces(batches, 1):
            if reader.full:
                reader.clear()
            row, number, total = reader.read(b.column(1))
            key, tf = np.unique(row * every + number, return_counts=True)
            row, number = np.divmod(key, max(every, 1))
            stem = number >= signals + len(plain)
            found = [(row[~stem], number[~stem], tf[~stem])]
            row, tf, own = row[stem], tf[stem], places[number[stem] - signals - len(plain)]
            level = dense_levels(tf, total[row])
            for i in range(3):
                one = (own[:, i] >= 0) & (level >= i)
                found.append((row[one], own[one, i], np.ones(one.sum(), np.int64) if i else tf[one]))
            row, ids, tf = map(np.concatenate, zip(*found))
            order = np.argsort(row * every + ids, kind="stable")
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b.num_rows))]).astype(np.int32))
            lists = (pa.ListArray.from_arrays(ends, pa.array(v[order].astype(np.int32))) for v in (ids, tf))
            yield pa.RecordBatch.from_arrays([b.column(0), *lists], names=["doc_id", "ids", "tf"])

    x = docs.select(col("doc_id").alias("doc_id"), col("text").alias("text"))
    return x.mapInArrow(run, "doc_id bigint, ids array<int>, tf array<int>")


def document_counts(counted: DataFrame, terms: int) -> DataFrame:
    """t, n: in how many rows each term is; a task adds up its rows before the shuffle."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n = np.zeros(terms, np.int64)
        for b in batches:
            n += np.bincount(b.column(0).flatten().to_numpy(), minlength=terms)
        some = np.flatnonzero(n)
        for at in (some[i:i + 100_000] for i in range(0, len(some), 100_000)):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["t", "n"])

    return counted.select("ids").mapInArrow(run, "t int, n bigint").groupBy("t").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Index:
    """Block-max inverted index over one shard of labelled examples; alike examples stand in the same block."""

    idf: np.ndarray            # weight of each term, negative for stop words; not packed
    start: np.ndarray          # entries of example e: start[e]:start[e + 1]
    term: np.ndarray
    tf: np.ndarray
    norm: np.ndarray           # length of each example's vector
    doc_id: np.ndarray
    label: np.ndarray
    list_start: np.ndarray     # postings of term t: list_start[t]:list_start[t + 1]
    at: np.ndarray             # example of each posting: place in its block times the number of blocks, and the block
    weight: np.ndarray
    long: np.ndarray           # terms of at least LONG postings, ascending; of more than TABLED the longest
    row: np.ndarray            # of each term, its place among the long ones or -1
    table: np.ndarray          # weights of the long lists in each block, list after list
    block_max: np.ndarray      # greatest weight of each long list in each block

    def vector(self, ids, tf) -> tuple[np.ndarray, np.ndarray]:
        return unit(self.idf, ids, tf)

    def packed(self) -> tuple[np.ndarray, ...]:
        """What can't be derived; ``with_lists`` derives the rest."""
        return self.start, self.term, self.tf, self.norm, self.doc_id, self.label

    @cached_property
    def by_id(self) -> np.ndarray:
        return np.argsort(self.doc_id, kind="stable")

    def place(self, doc_id: int) -> int | None:
        """Where the example stands, None if it is not in this shard."""
        at = np.searchsorted(self.doc_id, doc_id, sorter=self.by_id)
        return int(self.by_id[at]) if at < len(self.doc_id) and self.doc_id[self.by_id[at]] == doc_id else None

    def exact(self, found: np.ndarray, ids: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Cosines of some examples in double precision."""
        post, n = _spans(self.start, found)
        place = scratch(len(self.idf), np.uint16 if len(ids) < 1 << 16 else np.int32)
        place[ids] = np.arange(1, len(ids) + 1)
        each = np.append(0.0, w * np.abs(self.idf[ids])).take(place.take(self.term.take(post)))
        each *= damped(self.tf.take(post))
        place[ids] = 0
        return np.bincount(np.repeat(np.arange(len(found)), n), each, len(found)) / self.norm[found]

    def search(self, ids: np.ndarray, w: np.ndarray, k: int, least: float = 0.0,
               leave_out: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(examples, exact cosines) of the k nearest of a unit vector, ties to the smaller id.

        Examples below ``least`` need not be found.
        """
        if not len(self.doc_id) or not len(ids):
            return np.zeros(0, np.int64), np.zeros(0)
        rows = self.row.take(ids)
        long = rows >= 0
        short, rows, of = ids[~long], rows[long].astype(np.int64), w[long].astype(np.float32)
        blocks = self.block_max.shape[1]
        post, n = _spans(self.list_start, short)
        each = np.repeat(w[~long], n)
        each *= self.weight.take(post)
        score = np.bincount(self.at.take(post), each, blocks * BLOCK).astype(float, copy=False)
        if leave_out is not None:
            score[leave_out % BLOCK * blocks + leave_out // BLOCK] = -np.inf
        score = score.reshape(BLOCK, blocks)
        less = -score.max(axis=0)
        if len(rows):
            less -= of @ self.block_max.take(rows, axis=0)
        order = np.argsort(less)
        less = less.take(order)                               # of the bounds
        slack = SLACK + len(rows) * 2.0 ** -22                # single precision adds up the long lists
        found, so_far, kth, done, step = np.zeros(0, np.int64), np.zeros(0), least, 0, SEEDS
        # best bound first, while it allows a neighbour
        while (end := min(done + step, int(less.searchsorted(-max(kth - slack, 0.0))))) > done:
            some = order[done:end]
            part = score.take(some, axis=1).T.ravel()
            if len(rows):
                part += of @ self.table.take(np.add.outer(rows * blocks, some), axis=0).reshape(len(rows), -1)
            hit = np.flatnonzero(part > max(kth - slack, 0.0))
            found, so_far = np.concatenate([found, hit + done * BLOCK]), np.concatenate([so_far, part.take(hit)])
            if len(found) > k:
                kth = max(kth, float(np.partition(so_far, -k)[-k]))
                near = so_far >= kth - slack
                found, so_far = found[near], so_far[near]
            done, step = end, 2 * step
        found = order.take(found // BLOCK) * BLOCK + found % BLOCK
        cosine = self.exact(found, ids, w)
        best = np.lexsort((self.doc_id[found], -np.round(cosine, 12)))[:k]
        return found[best], cosine[best]

    def nearest(self, ids, tf, k: int, leave_out: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``search`` for term frequencies."""
        return self.search(*self.vector(ids, tf), k, leave_out=leave_out)


@lru_cache(1)
def scratch(n: int, kind: type) -> np.ndarray:
    """Zeros, one place per term; whoever writes to it restores them."""
    return np.zeros(n, kind)


_DAMPED = 1 + np.log(np.maximum(np.arange(256.0), 1.0))


def damped(tf: np.ndarray) -> np.ndarray:
    """1 + log tf."""
    return _DAMPED.take(tf) if tf.dtype == np.uint8 else 1 + np.log(tf.astype(float))


def unit(idf: np.ndarray, ids, tf) -> tuple[np.ndarray, np.ndarray]:
    """Terms that count and their entries of the unit vector."""
    ids = np.asarray(ids, dtype=np.int64)
    w = (1 + np.log(np.asarray(tf, dtype=float))) * idf.take(ids)
    rare = w > 0
    if np.count_nonzero(rare) >= FEW:
        ids, w = ids[rare], w[rare]
    w = np.abs(w)
    return ids, w / np.sqrt((w * w).sum()) if len(w) else w


@dataclass(frozen=True)
class Model:
    """All shards, and the shares of toxic among all training documents and among those without any term."""

    idf: Broadcast
    shards: list[Broadcast]
    rate: float
    empty_rate: float

    def search(self, ids, tf, k: int = NEIGHBOURS, leave_out: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, labels, exact cosines) of the k nearest examples but the one left out."""
        vector = unit(self.idf.value, ids, tf)
        doc_id, label, cosine, least = np.zeros(0, np.int64), np.zeros(0), np.zeros(0), 0.0
        for shard in self.shards:
            index = loaded(shard, self.idf)
            who, near = index.search(*vector, k, least, None if leave_out is None else index.place(leave_out))
            near = index.doc_id[who], index.label[who], near
            if len(doc_id):
                doc_id, label, cosine = map(np.concatenate, zip((doc_id, label, cosine), near))
                best = np.lexsort((doc_id, -np.round(cosine, 12)))[:k]
                near = doc_id[best], label[best], cosine[best]
            doc_id, label, cosine = near
            least = float(cosine[-1]) if len(cosine) == k else 0.0
        return doc_id, label, cosine

    def label(self, doc_id: int | None, ids, tf) -> float | None:
        """Label of the example of this id, None if there is none or its terms are others (of another row with the id)."""
        for shard in self.shards if doc_id is not None and len(ids) else ():
            index = loaded(shard, self.idf)
            if (at := index.place(doc_id)) is not None:
                own, kept = slice(index.start[at], index.start[at + 1]), index.idf[ids] > 0
                if np.count_nonzero(kept) < FEW:
                    kept[:] = True
                same = np.array_equal(index.term[own], ids[kept]) and np.array_equal(index.tf[own], tf[kept])
                return float(index.label[at]) if same else None
        return None

    def vote(self, label: np.ndarray, cosine: np.ndarray) -> float:
        """Share of toxic among the nearest, each weighted by closeness, drawn to the base rate by one far neighbour."""
        if not len(label):
            return self.empty_rate
        w = 1.0 / (1.05 - np.minimum(cosine, 1.0)) ** 2
        prior = 1.0
        return float((w @ label + prior * self.rate) / (w.sum() + prior))


def loaded(shard: Broadcast, idf: Broadcast) -> Index:
    """A shard with its lists, once per Python worker: kept with the broadcast, which the worker drops when a task does without."""
    if getattr(shard, "index", None) is None:
        shard.index = with_lists(idf.value, *shard.value)
    return shard.index


def _lists(ids, tf) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of two Arrow columns of lists."""
    at, to = ids.offsets.to_numpy(), tf.offsets.to_numpy()
    i, t = ids.values.to_numpy(), tf.values.to_numpy()
    return [(i[at[r]:at[r + 1]], t[to[r]:to[r + 1]]) for r in range(len(ids))]


def _spans(start: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions start[i]:start[i + 1] of all ``which`` in a row, and how many each has."""
    first = start[which]
    return _ranges(first, start[which + 1] - first)


def _ranges(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions first[i]:first[i] + n[i] in a row, and ``n``."""
    at = np.repeat(first - np.cumsum(n) + n, n)
    at += np.arange(len(at))
    return at, n


def build_index(rows: pd.DataFrame, idf: np.ndarray) -> Index:
    """Index over rows (doc_id, ids, tf, y); rows without any term are left out."""
    n = rows["ids"].map(len).to_numpy(dtype=np.int64)
    term = np.concatenate([np.asarray(x, dtype=np.int64) for x in rows["ids"]] + [np.zeros(0, np.int64)])
    tf = np.concatenate([np.maximum(np.asarray(x, dtype=np.int64), 1) for x in rows["tf"]] + [np.ones(0, np.int64)])
    who = np.repeat(np.arange(len(rows)), n)
    rare = idf[term] > 0
    kept = rare | (np.bincount(who, rare, len(rows)) < FEW)[who]
    term, tf, who = term[kept], tf[kept], who[kept]
    some, who = np.unique(who, return_inverse=True)
    n, weight = np.bincount(who, minlength=len(some)), (1 + np.log(tf.astype(float))) * np.abs(idf[term])
    norm = np.sqrt(np.bincount(who, weight * weight, len(some)))
    weight = weight / norm[who]
    # alike examples next to each other: by their two strongest terms, then by id
    start = np.cumsum(n) - n
    strong = term[np.lexsort((term, -weight, who))]
    doc_id = rows["doc_id"].to_numpy()[some]
    order = np.lexsort((doc_id, strong[start + np.minimum(n, 2) - 1], strong[start])) if len(some) else np.zeros(0, np.int64)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    by_row = np.argsort(rank[who], kind="stable")
    return with_lists(idf, np.r_[0, np.cumsum(n[order])], term[by_row].astype(np.int32),
                      tf[by_row].astype(np.min_scalar_type(tf.max(initial=1))), norm[order], doc_id[order],
                      rows["y"].to_numpy(dtype=float)[some][order])


def with_lists(idf: np.ndarray, start: np.ndarray, term: np.ndarray, tf: np.ndarray, norm: np.ndarray,
               doc_id: np.ndarray, label: np.ndarray) -> Index:
    """The posting lists of ordered examples, and the bounds of the long ones in each block."""
    weight = damped(tf).astype(np.float32)
    weight *= np.abs(idf).astype(np.float32)[term]
    weight /= np.repeat(norm.astype(np.float32), np.diff(start))
    by_term = np.argsort(term, kind="stable")
    blocks = -(-len(norm) // BLOCK)
    block, place = np.divmod(np.arange(len(norm)), BLOCK)
    at = np.repeat((place * blocks + block).astype(np.uint16), np.diff(start))[by_term]
    weight = weight[by_term]
    n = np.bincount(term, minlength=len(idf))
    list_start = np.concatenate([[0], np.cumsum(n)])
    long = np.flatnonzero(n >= LONG)
    long = np.sort(long[np.argsort(-n[long], kind="stable")[:TABLED]])
    table = np.zeros((len(long), blocks, BLOCK), np.float32)
    for row, t in enumerate(long):
        postings = slice(list_start[t], list_start[t + 1])
        table[row, at[postings] % blocks, at[postings] // blocks] = weight[postings]
    rows = np.full(len(idf), -1, np.int16)
    rows[long] = np.arange(len(long))
    return Index(idf, start, term, tf, norm, doc_id, label, list_start.astype(np.int32), at, weight, long, rows,
                 table.reshape(-1, BLOCK), table.max(axis=2))


def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """One packed shard of the examples of several, one after the other."""
    start, *rest = zip(*parts)
    return np.r_[0, np.cumsum(np.concatenate([np.diff(x) for x in start]))], *map(np.concatenate, rest)


def calibrate(votes: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Monotone map from votes to the observed share of toxic (pooled adjacent violators), as knots."""
    if not len(votes):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    xs, at = np.unique(np.round(votes, 3), return_inverse=True)
    n = np.bincount(at).astype(float)
    pools: list[list[float]] = []
    for x, s, m in zip(xs, np.bincount(at, y), n):
        pools.append([s, m, x, x])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            s2, m2, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + s2, pools[-1][1] + m2, pools[-1][2], hi]
    knots = [(e, (s + 0.02) / (m + 0.04)) for s, m, lo, hi in pools for e in ((lo, hi) if hi > lo else (lo,))]
    value = np.maximum.accumulate(np.array([v for _, v in knots]))
    return np.array([e for e, _ in knots]), value


def bounded(texts: DataFrame) -> DataFrame:
    """Rows of whole ids by hash while their texts fit into ``TRAIN_BYTES``."""
    sizes = texts.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")).alias("n"))
    running = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))             # at most TRAIN_ROWS rows
    kept = sizes.withColumn("n", running).filter(F.col("n") <= TRAIN_BYTES).select("doc_id")
    return texts.join(F.broadcast(kept), "doc_id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The index and the stored term counts of all documents.

    The shards are built in tasks and stored.  They reach the workers by
    broadcast, a few as one, packed; ``TRAIN_ROWS`` and ``TRAIN_BYTES``
    bound their size and that of the vocabulary, whatever the corpus.
    """
    context = docs.sparkSession.sparkContext
    chosen = stored(labelled(labels, "toxic", FOLDS, HELD_OUT, TRAIN_ROWS), "toxic-labels")
    x = docs.select(col("doc_id").alias("doc_id"), col("text").alias("text"))
    texts = stored(bounded(x.join(F.broadcast(chosen), "doc_id")), "toxic-examples")
    signals, plain = choose_vocabulary(texts), plain_words(texts)
    counted = stored(count_terms(x, list(signals), plain), "toxic-terms")
    total = counted.count()
    df = document_counts(counted, len(signals) + len(plain)).toArrow()                   # at most one row per training term
    n = np.zeros(len(signals) + len(plain))
    n[df["t"].to_numpy()] = df["n"].to_numpy()
    stop = n > np.r_[np.full(len(signals), np.inf), np.full(len(plain), max(MAX_SHARE * total, MIN_DOCUMENTS))]
    idf = (np.log((1 + total) / (1 + n)) + 0.05) * np.r_[list(signals.values()), np.full(len(plain), PLAIN)]
    shared = context.broadcast(np.where(stop, -idf, idf))
    ids = texts.select("doc_id", "y").distinct()
    examples = stored(counted.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]), "toxic-vectors")
    shards = -(-max(examples.count(), 1) // SHARD)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        index = build_index(rows, shared.value)
        return pd.DataFrame({"n": [len(rows)], "bad": [int(rows["y"].sum())], "empty": [len(rows) - len(index.doc_id)],
                             "empty_bad": [int(rows["y"].sum() - index.label.sum())], "index": [pickle.dumps(index.packed(), protocol=5)]})

    place = F.row_number().over(Window.orderBy(F.xxhash64("doc_id"), "doc_id")) % shards  # ids only, at most TRAIN_ROWS rows
    numbered = ids.select("doc_id").distinct().withColumn("shard", place)
    built = stored(examples.join(F.broadcast(numbered), "doc_id").groupBy("shard")
                   .applyInPandas(build, "n bigint, bad bigint, empty bigint, empty_bad bigint, index binary"), "toxic-index")
    rows, bad, empty, empty_bad = (v or 0 for v in built.agg(*[F.sum(c) for c in ("n", "bad", "empty", "empty_bad")]).first())
    rate = bad / rows if rows else 0.0
    parts, searched = built.select("index").toLocalIterator(), []
    while some := [pickle.loads(r["index"]) for r in islice(parts, SEARCHED // SHARD)]:
        searched.append(context.broadcast(merged(some)))
    model = Model(shared, searched, rate, (empty_bad + rate) / (empty + 1) if rows else 0.0)

    return model, counted


def votes(model: Model, counted: DataFrame) -> DataFrame:
    """One row per row of ``counted``: doc_id, vote, known (any term is an example's), the three nearest, and of an example
    its label and its vote when it is left out: the nearest one more, without itself."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: dict[bytes, tuple] = {}
        for b in batches:
            if len(seen) > 50_000:
                seen.clear()
            rows = []
            for doc_id, pair in zip(b.column(0).to_pylist(), _lists(b.column(1), b.column(2))):
                key, y, left_out = blake2b(np.concatenate(pair).tobytes(), digest_size=16).digest(), None, None
                own = model.label(doc_id, *pair)
                if own is not None or key not in seen:
                    near, label, cosine = model.search(*pair, NEIGHBOURS + (own is not None))
                    if own is not None:
                        rest = np.flatnonzero(near != doc_id)[:NEIGHBOURS]
                        y, left_out = int(own), model.vote(label[rest], cosine[rest])
                        near, label, cosine = near[:NEIGHBOURS], label[:NEIGHBOURS], cosine[:NEIGHBOURS]
                    seen[key] = model.vote(label, cosine), len(near) > 0, near[:3].tolist()
                rows.append((*seen[key], y, left_out))
            if rows:
                kinds = pa.float64(), pa.bool_(), pa.list_(pa.int64()), pa.int32(), pa.float64()
                yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, zip(*rows), kinds)],
                                                 names=["doc_id", "vote", "known", "evidence", "y", "left_out"])

    return counted.mapInArrow(run, "doc_id bigint, vote double, known boolean, evidence array<bigint>, y int, left_out double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (up to three nearest example ids), one row per row of ``docs``.

    Null and empty texts, and texts without any training word,
    score the smoothed share of toxic among such training documents; a null id is
    never held out; repeated rows get equal rows; without toxic labels every
    score is the base rate; no documents give no rows.
    """
    found = stored(votes(*fit(docs, labels)), "toxic-votes")
    own = found.filter("y IS NOT NULL").select("doc_id", "left_out", "y").distinct().toArrow()             # at most TRAIN_ROWS rows
    knots = calibrate(own["left_out"].to_numpy(), own["y"].to_numpy().astype(float))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            vote = b.column(1).to_numpy()
            score = np.where(b.column(2).to_numpy(zero_copy_only=False), np.interp(vote, *knots), vote)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.clip(score, 0.0, 1.0)), b.column(3)],
                                             names=["doc_id", "score", "evidence"])

    scored = found.select("doc_id", "vote", "known", "evidence").mapInArrow(run, "doc_id bigint, score double, evidence array<bigint>")
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"), "evidence")
