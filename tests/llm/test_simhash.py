from __future__ import annotations

import random

import pytest
import xxhash

from quaestor.llm.graph import connected_components
from quaestor.llm.simhash import (drop_near_duplicates, fingerprint_of, linked, near_duplicates, op2_simhash)
from quaestor.llm.tables import read_table
from tests.conftest import SF_DIR


def plain_fingerprint(text):
    words = text.translate({c: c + 32 for c in range(65, 91)}) if text else ""
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius):
    """Union of all pairs within ``radius`` bits; fps: row -> unsigned fingerprint."""
    root = {k: k for k in fps}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    keys = list(fps)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    return {k: find(k) for k in keys}


def unsigned(x):
    return x % (1 << 64)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


TEXTS = ["", "one", "One two", "a b c d e f", "Ä B ÉA\x1fb\x85c d  e\tf\x0bg\x0ch\r\ni", "x " * 70000, None]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert unsigned(fingerprint_of(None if text is None else text.encode())) == plain_fingerprint(text)


@pytest.mark.parametrize("pair_bucket", [0, 64])
@pytest.mark.parametrize("radius", [1, 2])
def test_all_links_by_pairs_and_by_variants(spark, pair_bucket, radius):
    rnd = random.Random(radius)
    base = [rnd.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base * 6:
        for _ in range(rnd.choice((1, 2, 3))):
            b ^= 1 << rnd.randrange(64)
        fps.add(b)
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = linked(frame, radius, pair_bucket=pair_bucket)
    for e in edges.collect():
        assert 0 < (unsigned(e.u) ^ unsigned(e.v)).bit_count() <= radius
    roots = {unsigned(r.node): unsigned(r.root) for r in connected_components(edges, "t").collect()}
    want = plain_components({f: f for f in fps}, radius)
    groups = lambda m: {frozenset(k for k in fps if m.get(k, k) == r) for r in {m.get(k, k) for k in fps}}
    assert groups(roots) == groups(want)


def test_components_of_a_path(spark):
    n = 200
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "u long, v long")
    assert {(r.node, r.root) for r in connected_components(edges, "t").collect()} == {(k, 0) for k in range(n)}


def test_query_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, SF_DIR, "documents").collect()}
    fps = {k: plain_fingerprint(t) for k, t in docs.items()}
    roots = plain_components(fps, 2)
    least = {}
    for k, r in roots.items():
        least[r] = min(least.get(r, k), k)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op2_simhash(spark, SF_DIR).collect()}
    assert got == {k: (f"{fps[k]:016x}", least[roots[k]]) for k in docs}


def test_odd_rows(spark):
    rows = [(None, "a b c d", "s"), (5, "a b c d", "s"), (5, "a b c d", "s"), (7, None, None), (8, " \n", "s"), (9, "q r s t", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_id string")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 7, 9]
    assert drop_near_duplicates(docs.limit(0)).count() == 0
    numbered = spark.createDataFrame([(1, None, "a"), (2, None, "a")], "row_id long, doc_id long, text string")
    assert [r.component_id for r in near_duplicates(numbered).collect()] == [None, None]
    assert near_duplicates(numbered).where("keeper").count() == 1
