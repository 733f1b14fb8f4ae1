import random
import re
from itertools import combinations

import pytest
import xxhash

from postlens.llm import simhash
from postlens.llm.graph import components

from .util import clashing, documents


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, bits=4):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= bits:
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def test_same_groups_as_all_pairs(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(r.choices(words, k=r.randint(0, 120))) for _ in range(120)]
    for _ in range(160):                                        # chains of near copies
        t = r.choice(texts).split()
        if t:
            t[r.randrange(len(t))] = r.choice(words)
        texts.append(" ".join(t))
    texts += ["A b C d", "a B c D", "É é ß", None, "", " \t\n", "x y z"] + ["same text here once more"] * 40
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    groups = plain_groups(set(prints))
    least = {}
    for i, p in enumerate(prints):
        least.setdefault(groups[p], i)
    for i, p in enumerate(prints):
        assert got[i]["fingerprint"] == f"{p:016x}"
        assert got[i]["component_id"] == least[groups[p]]


@pytest.mark.parametrize("parts,bits,crowd", [(3, 4, 4), (2, 4, 64), (4, 4, 2), (3, 3, 8), (3, 5, 3)])
def test_crowded_fingerprints(spark, parts, bits, crowd):
    """Dense clusters around a few centres: no link may be lost when crowds are set apart."""
    r = random.Random(parts * 10 + bits)
    prints = set()
    for _ in range(4):
        c = r.getrandbits(64)
        free = r.sample(range(64), 14)
        for _ in range(120):
            prints.add(c ^ sum(1 << b for b in r.sample(free, r.randint(0, 7))))
    prints |= {r.getrandbits(64) for _ in range(200)}
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, 1) for p in prints], "fp long, n long")
    got = {x["fp"] % (1 << 64): x["root"] for x in simhash.link(nodes, bits, parts, crowd).collect()}
    want = plain_groups(prints, bits)
    assert len(got) == len(prints)
    pairs = {(got[p], want[p]) for p in prints}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_segments_cover_every_pattern():
    for parts in (2, 3, 4, 5):
        for bits in (1, 3, 4, 6):
            cut = simhash.segments(parts, bits)
            for _ in range(300):
                x = sum(1 << b for b in random.sample(range(64), bits))
                assert any((x >> h & (1 << w) - 1).bit_count() <= r for _, h, w, r in cut)


def test_components_of_a_path(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1001)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert len({got[i] for i in range(n + 1)}) == 1 and got[1000] == got[1001] != got[0]


def test_keep_one_and_edge_rows(spark):
    long = "very long text " * 100_000
    texts = [None, "", "one two three four five", "one two three four five", long, "other words entirely here now"]
    docs = documents(spark, texts, ids=[9, 8, 7, None, 3, 2]).unionAll(documents(spark, [texts[5]], ids=[2]))
    kept = simhash.keep_one(clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 7, 8]
    out = simhash.near_duplicates(docs)
    assert out.count() == 7
    assert {r["component_id"] for r in out.filter("doc_id in (8, 9)").collect()} == {8}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0
    alone = simhash.near_duplicates(documents(spark, ["only null id"], ids=[None])).collect()
    assert alone[0]["component_id"] is None
