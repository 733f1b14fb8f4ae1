"""Secrets by one combined deterministic automaton over the bytes of the texts.

All rules are compiled together: their regexes become one nondeterministic
automaton over bytes, subset construction makes it deterministic (a new match
may begin at every byte), partition refinement makes it minimal, and what is
left is one transition array from (state, byte class) to state, with the set
of rules that have a match ending in each state.  A batch of texts is cut into
chunks that step through the array side by side, one byte of every chunk at a
time, so each byte is read once for all rules.  A chunk after the first of its
text starts from a guess, the initial state, and is stepped again from the
true state only until the two agree.

Where the automaton says that a match of a rule ends, the rule's own small
automata give its bounds: read backwards the first byte it can begin at, read
forwards the last byte it can end at.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_place, col, free

#: Bytes of a chunk, and of the texts that are stepped through together (a longer text goes alone).
CHUNK = 256
BATCH = 8 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``head`` then ``body``, regexes over ASCII; the body has ``least`` characters at least.

    Literals, classes, groups, ``|``, greedy repeats and ``(?i:...)`` may be
    used; anchors and look-around may not.
    """

    kind: str
    head: str
    body: str
    least: int = 0


#: The three kinds of the contract, then kinds of well-known key formats.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)""", r"[A-Za-z0-9+/_.=-]+", 6),
    Rule("access", "", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", "", r"[0-9a-f]{24,}"),
]
MORE = [
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", 10),
    Rule("google", "AIza", r"[A-Za-z0-9_-]+", 35),
    Rule("private_key", "", r"-----BEGIN( [A-Z0-9]+)* PRIVATE KEY-----"),
]


class Nfa:
    """A Thompson automaton over bytes: ``steps[s]`` are (set of bytes, next), ``empty[s]`` the moves without a byte."""

    def __init__(self):
        self.steps: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.empty.append([])
        return len(self.steps) - 1

    def add(self, parsed, start: int, backwards: bool, fold: bool = False) -> int:
        """Appends what was parsed behind ``start``; returns the state it ends in."""
        at = start
        for op, value in reversed(list(parsed)) if backwards else parsed:
            at = self._one(str(op), value, at, backwards, fold)
        return at

    def _one(self, op: str, value, at: int, backwards: bool, fold: bool) -> int:
        if op in ("LITERAL", "NOT_LITERAL", "IN", "ANY"):
            end = self.state()
            self.steps[at].append((_bytes(op, value, fold), end))
            return end
        if op == "SUBPATTERN":
            _, more, less, inner = value
            return self.add(inner, at, backwards, (fold or bool(more & re.I)) and not less & re.I)
        if op == "BRANCH":
            end = self.state()
            for inner in value[1]:
                begin = self.state()
                self.empty[at].append(begin)
                self.empty[self.add(inner, begin, backwards, fold)].append(end)
            return end
        if op == "MAX_REPEAT":
            low, high, inner = value
            for _ in range(low):
                at = self.add(inner, at, backwards, fold)
            if high == _parser.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.empty[at].append(loop)
                self.empty[self.add(inner, loop, backwards, fold)].append(loop)
                self.empty[loop].append(end)
                return end
            end = self.state()
            for _ in range(high - low):
                self.empty[at].append(end)
                at = self.add(inner, at, backwards, fold)
            self.empty[at].append(end)
            return end
        raise ValueError(f"not for automata: {op}")

    def closed(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _bytes(op: str, value, fold: bool) -> frozenset:
    if op == "ANY":
        return frozenset(range(256)) - {10}
    if op == "LITERAL":
        found = {value}
    elif op == "NOT_LITERAL":
        return frozenset(range(256)) - _bytes("LITERAL", value, fold)
    else:
        found = set()
        for kind, x in value:
            if str(kind) == "LITERAL":
                found.add(x)
            elif str(kind) == "RANGE":
                found |= set(range(x[0], x[1] + 1))
            elif str(kind) != "NEGATE":
                raise ValueError(f"not for automata: {kind}")
    if fold:
        found |= {ord(chr(x).swapcase()) for x in found if chr(x).isascii() and chr(x).isalpha()}
    if op == "IN" and str(value[0][0]) == "NEGATE":
        found = set(range(256)) - found
    return frozenset(found)


class Dfa:
    """A minimal deterministic automaton; state 0 is where it starts.

    ``table[s, c]`` is the next state for byte class ``c = classes[byte]``,
    ``ends[s]`` the rules (bits) with a match that ends here.  States that end
    a match have the highest numbers, from ``first`` on; ``dead`` is the state
    that nothing leads out of (-1 if there is none).
    """

    def __init__(self, patterns: list[str], search: bool, backwards: bool = False):
        nfa, starts, accept = Nfa(), [], {}
        for i, p in enumerate(patterns):
            s = nfa.state()
            starts.append(s)
            accept.setdefault(nfa.add(_parser.parse(p.encode()), s, backwards), i)
        begin = nfa.closed(starts)
        if begin & accept.keys():
            raise ValueError("a rule must not match the empty text")
        cuts = {m for steps in nfa.steps for m, _ in steps}
        member = np.array([[b in m for m in cuts] for b in range(256)])
        _, self.classes = np.unique(member, axis=0, return_inverse=True)
        self.classes = self.classes.reshape(-1).astype(np.uint8)
        sample = [int(np.flatnonzero(self.classes == c)[0]) for c in range(int(self.classes.max()) + 1)]

        # subset construction; sets of states are the bits of a number
        width = len(sample)
        moves = [[(sum(1 << x for x in nfa.closed([t])), [c for c, b in enumerate(sample) if b in m]) for m, t in steps]
                 for steps in nfa.steps]
        start = sum(1 << s for s in begin)
        accepts = sum(1 << s for s in accept)
        number, todo, rows, ends = {start: 0}, [start], [], []
        for states in todo:
            row, rest = [start if search else 0] * width, states
            while rest:
                s = (rest & -rest).bit_length() - 1
                rest &= rest - 1
                for to, classes in moves[s]:
                    for c in classes:
                        row[c] |= to
            for to in row:
                if to not in number:
                    number[to] = len(todo)
                    todo.append(to)
            rows.append([number[to] for to in row])
            mine = states & accepts
            ends.append(sum({1 << r for s, r in accept.items() if mine >> s & 1}) if mine else 0)
        table, ends = np.array(rows, dtype=np.int32), np.array(ends, dtype=np.int64)

        # minimisation: states are told apart by what they end, then by where they lead, until no part splits
        part, parts = np.unique(ends, return_inverse=True)[1].astype(np.int32), 0
        while part.max() + 1 != parts:
            parts = part.max() + 1
            seen: dict[bytes, int] = {}
            part = np.array([seen.setdefault(x.tobytes(), len(seen)) for x in np.column_stack([part, part[table]])], dtype=np.int32)
        one = np.unique(part, return_index=True)[1]          # a state of each part
        order = np.lexsort((part[one] != part[0], ends[one] != 0))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.table = place[part[table[one[order]]]]
        self.ends = ends[one[order]]
        self.first = int((self.ends == 0).sum())
        stuck = np.flatnonzero((self.table == np.arange(len(self.table))[:, None]).all(axis=1) & (self.ends == 0))
        self.dead = int(stuck[0]) if len(stuck) else -1

    def by_byte(self) -> Dfa:
        """With ``rows[state][byte]``, for reading single texts."""
        self.rows = [row[self.classes].tolist() for row in self.table]
        return self


class Bounds:
    """One rule's own automata: where its matches begin and end."""

    def __init__(self, rule: Rule):
        whole = f"(?:{rule.head})(?:{rule.body})"
        self.rule = rule
        self.ahead, self.back = Dfa([whole], False).by_byte(), Dfa([whole], False, True).by_byte()
        self.search = Dfa([whole], True).by_byte()
        self.head = Dfa([rule.head], False).by_byte() if rule.head else None

    @staticmethod
    def _last(dfa: Dfa, data: bytes) -> int:
        """Length of the longest start of ``data`` that matches; 0 for none."""
        state, last, rows, first, dead = 0, 0, dfa.rows, dfa.first, dfa.dead
        for n, b in enumerate(data, 1):
            state = rows[state][b]
            if state >= first:
                last = n
            elif state == dead:
                break
        return last

    def spans(self, data: bytes, ends: list[int]) -> list[tuple[int, int]]:
        """Matches in order, none overlapping: the one that ends first, from its first byte to its last."""
        out, pos = [], 0
        while (k := bisect_right(ends, pos)) < len(ends):
            size = self._last(self.back, data[pos:ends[k]][::-1])
            if not size:                      # it begins inside the last match: look on from there
                end = self._next(data, pos)
                if end is None:
                    break
                size = self._last(self.back, data[pos:end][::-1])
            else:
                end = ends[k]
            start = end - size
            pos = start + self._last(self.ahead, data[start:])
            body = start + (self._last(self.head, data[start:pos]) if self.head else 0)
            if pos - body >= self.rule.least:
                out.append((start, pos))
        return out

    def _next(self, data: bytes, pos: int) -> int | None:
        state, rows, first = 0, self.search.rows, self.search.first
        for n in range(pos, len(data)):
            state = rows[state][data[n]]
            if state >= first:
                return n + 1
        return None


class Scanner:
    def __init__(self, rules: list[Rule]):
        if len({r.kind for r in rules}) != len(rules) or len(rules) > 60:
            raise ValueError("kinds must differ, 60 at most")
        self.rules = rules
        self.all = Dfa([f"(?:{r.head})(?:{r.body})" for r in rules], True)
        self.bounds = [Bounds(r) for r in rules]
        # one more class for what lies behind a chunk's end: it leaves the state as it is
        self.pad = self.all.table.shape[1]
        self.width = self.pad + 1
        states = np.arange(len(self.all.table))
        self.step = (np.column_stack([self.all.table, states]) * self.width).reshape(-1).astype(np.int64)

    def ends(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place, state) of every byte of the texts data[begin:end] with a match ending behind it, in order."""
        pieces = -(-(end - begin) // CHUNK)
        text = np.repeat(np.arange(len(begin)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = begin[text] + nth * CHUNK
        size = np.minimum(end[text] - start, CHUNK)
        n = len(start)
        if not n:
            return (np.zeros(0, dtype=np.int64),) * 3
        low = int(begin.min())
        classes = np.append(self.all.classes[data[low:int(end.max())]], np.full(CHUNK, self.pad, dtype=np.uint8))
        cells = np.lib.stride_tricks.sliding_window_view(classes, CHUNK)[start - low]
        cells[np.arange(CHUNK) >= size[:, None]] = self.pad
        cells = np.ascontiguousarray(cells.T)
        states = np.empty((CHUNK, n), dtype=np.int32)
        state, at = np.zeros(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        for t in range(CHUNK):
            np.add(state, cells[t], out=at)
            np.take(self.step, at, out=state, mode="clip")
            states[t] = state

        follows = np.flatnonzero(nth > 0)
        began = np.zeros(n, dtype=np.int32)
        # all chunks at once from the state their predecessor left, each until it agrees with what was found before
        work = follows[states[-1, follows - 1] != 0]
        began[work] = state = states[-1, work - 1]
        state = state.astype(np.int64)
        for t in range(CHUNK):
            if not len(work):
                break
            state = self.step[state + cells[t, work]]
            differ = states[t, work] != state
            work, state = work[differ], state[differ]
            states[t, work] = state
        # what a changed end unsettles again, in order (long stretches that match as a whole)
        for c in follows[states[-1, follows - 1] != began[follows]].tolist():
            while c < n and nth[c] and (s := int(states[-1, c - 1])) != began[c]:
                began[c] = s
                for t in range(CHUNK):
                    s = int(self.step[s + int(cells[t, c])])
                    if states[t, c] == s:
                        break
                    states[t, c] = s
                c += 1

        hit = np.flatnonzero(states.reshape(-1) >= self.all.first * self.width)
        t, c = hit // n, hit % n
        inside = t < size[c]
        t, c, hit = t[inside], c[inside], hit[inside]
        place = nth[c] * CHUNK + t + 1
        order = np.lexsort((place, text[c]))
        return text[c][order], place[order], states.reshape(-1)[hit][order] // self.width

    def scan(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, start, end, rule) in code points, in order of text, start and rule."""
        text, place, state = self.ends(data, begin, end)
        ends = self.all.ends[state]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(text)) + 1, [len(text)]]).tolist()
        for low, high in zip(cuts[:-1], cuts[1:]):
            if low == high:
                continue
            i = int(text[low])
            part = data[begin[i]:end[i]]
            raw, mine, at = part.tobytes(), ends[low:high], place[low:high]
            found = []
            for r, bounds in enumerate(self.bounds):
                if len(own := at[mine >> r & 1 == 1]):
                    found += [(s, r, e) for s, e in bounds.spans(raw, own.tolist())]
            points = None if raw.isascii() else np.concatenate([[0], np.cumsum(part & 0xC0 != 0x80)])
            for s, r, e in sorted(found):
                yield (i, s, e, r) if points is None else (i, int(points[s]), int(points[e]), r)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _map(batches: Iterator[pa.RecordBatch], scanner: Scanner, names: list[str]) -> Iterator[pa.RecordBatch]:
    kinds = [r.kind for r in scanner.rules]
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(0).cast(pa.large_binary())
        _, offsets, values = column.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, dtype=np.uint8)
        begin, end = offsets[:-1], offsets[1:]
        end = np.where(np.asarray(column.is_valid()), end, begin)
        low, out, often = 0, [], np.zeros(len(begin), dtype=np.int64)
        while low < len(begin):
            high = max(low + 1, int(np.searchsorted(begin, begin[low] + BATCH)))
            for i, s, e, r in scanner.scan(data, begin[low:high], end[low:high]):
                out.append((kinds[r], s, e))
                often[low + i] += 1
            low = high
        parts = pa.StructArray.from_arrays([pa.array([x[c] for x in out], f.type) for c, f in enumerate(SPAN)], fields=list(SPAN))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(often)]), pa.int32()), parts)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists], names)


def find_secrets(docs: DataFrame, rules: list[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, then ``spans``: array of (kind, start, end), in code points, end exclusive.

    For each rule the matches are leftmost, as long as they can be and not
    overlapping; those whose body is too short are dropped after that.  (Of
    two matches that overlap the one that ends first counts, from the first
    place it can begin at: the same for rules like these, where no match can
    hold another that begins later and ends earlier.)  Spans are in order of
    start, then of the rules.

    One row per row: null and empty texts have no spans, repeated rows stay.
    ``spans`` gets underscores if ``docs`` has that name.  The rules are
    compiled once on the driver; their arrays take some megabytes.
    """
    scanner = Scanner(BASE + MORE if rules is None else rules)
    others = [c for c in docs.columns if c != text_col]
    name = free("spans", docs)
    flat = by_place(docs, [text_col, *others])
    names = [*flat.columns[1:], "spans"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema.fields[1:])
    schema = f"{types + ', ' if types else ''}spans array<struct<kind:string,start:bigint,end:bigint>>"
    found = flat.mapInArrow(lambda b: _map(b, scanner, names), schema)
    return found.select(*[col(f"c{i + 1}").alias(c) for i, c in enumerate(others)], F.col("spans").alias(name))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, spans of each base kind, the digest of the base spans, all spans as kind:start:end."""
    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    kinds = [r.kind for r in BASE]
    return found.select(
        "doc_id", *[F.size(F.expr(f"filter(spans, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(line(F.filter("spans", lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"))
