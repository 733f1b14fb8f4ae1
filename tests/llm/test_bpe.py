import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from postlens.llm import bpe

from .util import clashing, documents

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    r = random.Random(4)
    odd = ["", "don't  stop\n\n \t x²½_ 日本語 \x00 é '", "it's we'll I'd 123 4,5", "a" * 2000, "   ", "<|endoftext|>",
           "".join(r.choice("abcdetheranion") for _ in range(5000)), " ".join("xyz" for _ in range(50_000)), "🙂🙃 ñandú straße"]
    return odd + ["".join(chr(r.choice((r.randrange(32, 127), r.randrange(160, 1500)))) for _ in range(80)) for _ in range(60)]


def test_digests_match(spark, plain):
    ts = texts() + [None]
    out = {r["doc_id"]: r for r in bpe.digests(clashing(documents(spark, ts)), PATH, P.PATTERN).collect()}
    for i, t in enumerate(ts):
        ids = plain.encode_ordinary(t or "")
        assert out[i]["n_tokens"] == len(ids)
        assert out[i]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_encode_keeps_columns_and_round_trips(spark):
    ts = texts()
    docs = clashing(documents(spark, ts))
    out = bpe.encode(docs, PATH, P.PATTERN)
    assert out.columns[-2:] == ["ids_", "decoded_"] and set(docs.columns) - {"text"} <= set(out.columns)
    assert {r["doc_id"]: bytes(r["decoded_"]).decode() for r in out.collect()} == dict(enumerate(ts))


def test_rounds_equal_heap_and_decode(plain):
    with open(PATH, "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    codec = bpe.Codec(bpe.Tables(ranks, P.PATTERN))
    r = random.Random(8)
    words = ["".join(r.choice("theraniongstdlyüé") for _ in range(r.randint(1, 60))) for _ in range(400)]
    codec.learn(words)
    for w in words:
        ids = np.frombuffer(codec.known[w][0], "<u4").tolist()
        assert ids == plain.encode_ordinary(w) == (bpe.merge_long(w.encode(), ranks) if w.encode() not in ranks else ids)
        assert codec.known[w][1] == w.encode()
    lists = [plain.encode_ordinary(t) for t in texts()]
    assert codec.decode(lists) == [t.encode() for t in texts()]


def test_worker_remembers_words(plain, monkeypatch):
    """A later task of the worker encodes no word that was used of late; the memory stays bounded."""
    monkeypatch.setattr(bpe, "REMEMBERED", 300)
    with open(PATH, "rb") as f:
        tables = bpe.Tables(bpe.parse_ranks(f.read()), P.PATTERN)
    learned = []

    class Counting(bpe.Codec):
        def learn(self, words):
            learned.extend(words)
            super().learn(words)

    r = random.Random(11)
    often = "".join(f" often{c}" for c in "abcdefghij")
    ts = [often + "".join(f" rare{r.randrange(10**9):x}" for _ in range(50)) + " " + "x" * 3000 for _ in range(60)]
    for part in (ts[:30], ts[30:]):
        codec = Counting(tables)
        for t in part:
            (ids, decoded), = codec.encode([t])
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(t) and decoded == t.encode()
        codec.close()
    assert learned.count(" oftena") == 1 and learned.count(" oftenj") == 1
    assert len(tables.known) + len(tables.older) < 2 * 300 + 1000 and max(map(len, [*tables.known, *tables.older])) <= bpe.LONG_WORD


def test_split_is_the_pattern(plain):
    import regex

    general, quick = regex.compile(P.PATTERN).findall, bpe.splitter(P.PATTERN)
    assert bpe.USUAL == P.PATTERN
    every = [chr(i) for i in range(0x300) if not 0xD800 <= i < 0xE000]
    r = random.Random(6)
    for t in [*texts(), *every, *("a" + c + "1" + c + " " + c for c in every), *("".join(r.choices(every, k=30)) for _ in range(2000))]:
        assert quick(t) == general(t)


def test_empty_and_repeated(spark):
    docs = documents(spark, ["a b", "a b"], ids=[None, None])
    out = bpe.digests(docs, PATH, P.PATTERN).collect()
    assert len(out) == 2 and out[0] == out[1]
    assert bpe.digests(docs.limit(0), PATH, P.PATTERN).count() == 0
