from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from quaestor.llm.suffix_dedup import anchors_of, repeated_spans
from quaestor.llm.suffix_sort import END, SHALLOW, BlindTrie, deep_shallow

WINDOW = 20


def brute(texts, window=WINDOW):
    """Spans and kept bytes of each text, from a count of all windows."""
    bodies = [(t or "").encode() for t in texts]
    counts = Counter(b[i:i + window] for b in bodies for i in range(len(b) - window + 1))
    out = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if counts[b[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        edges = [i for i in range(len(b) + 1) if (i > 0 and gone[i - 1]) != (i < len(b) and gone[i])]
        out.append((list(zip(edges[::2], edges[1::2])), bytes(c for c, g in zip(b, gone) if not g)))
    return out


def made(rnd, n):
    words = [chr(97 + k) * rnd.randint(1, 6) + "é" * (k % 3 == 0) for k in range(12)]
    passages = [" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 12))) for _ in range(6)]
    texts = [" ".join(rnd.choice(passages) if rnd.random() < 0.4 else rnd.choice(words) + str(rnd.randint(0, 999))
                      for _ in range(rnd.randint(0, 20))) for _ in range(n)]
    whole = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    near = []
    for _ in range(n):
        at = rnd.randint(0, 290)
        near.append(whole[:at] + rnd.choice("XYZ") + whole[at + 1:])
    odd = [None, "", "short", "z" * 500, "z" * 19, "ab" * 200, whole, whole, passages[0] * 3]
    return texts + near + odd


def test_deep_shallow_orders_groups_and_counts_shared_bytes():
    rnd = random.Random(1)
    for _ in range(150):
        base = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(0, 3 * SHALLOW))) for _ in range(3)]
        strings = []
        for _ in range(rnd.randint(1, 50)):
            b = rnd.choice(base)
            cut = rnd.randint(0, len(b))
            strings.append(b[:cut] + bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(0, 4))) + b[cut:] * rnd.randint(0, 1))
        group = np.array([rnd.randint(0, 2) for _ in strings])
        order, shared = deep_shallow(strings, group)
        assert [(group[i], strings[i]) for i in order] == sorted(zip(group.tolist(), strings))
        for k in range(1, len(strings)):
            a, b = strings[order[k - 1]], strings[order[k]]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == (same if group[order[k]] == group[order[k - 1]] else -1)
    assert [len(x) for x in deep_shallow([], np.zeros(0, int))] == [0, 0]


def test_blind_trie_keeps_only_depths_and_branches():
    strings = [b"aab", b"aaa", b"aab", b"aa"]
    trie = BlindTrie(strings, 0)
    for i in (1, 2, 3):
        trie.add(i)
    assert trie.root == [2, {ord("b"): [0, 2], ord("a"): [1], END: [3]}]
    assert trie.in_order() == ([3, 1, 0, 2], [0, 2, 2, 3])


def test_every_window_has_an_anchor_that_equal_windows_share():
    rnd = np.random.default_rng(5)
    text = rnd.integers(97, 100, 400).astype(np.uint8)
    data = np.concatenate([text, rnd.integers(97, 100, 50).astype(np.uint8), text, rnd.integers(97, 100, 7).astype(np.uint8)])
    offsets = np.array([0, 450, 850, 857])
    places, _ = anchors_of(data, offsets, WINDOW, WINDOW // 2)
    chosen = set(places.tolist())
    for p in range(400 - WINDOW + 1):
        first = {q for q in range(WINDOW // 2 + 1) if p + q in chosen}
        assert first and first & {q for q in range(WINDOW // 2 + 1) if p + q + 450 in chosen}
    assert not any(places >= 850)


@pytest.mark.parametrize("group", [4096, 2])
def test_spans_equal_brute_force(spark, group):
    texts = made(random.Random(group), 40)
    rows = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: ([tuple(s) for s in r.spans], bytes(r.kept)) for r in repeated_spans(frame, window=WINDOW, group=group).collect()}
    for i, want in enumerate(brute(texts)):
        assert got[i] == want, (i, texts[i])


def test_long_texts_are_read_in_blocks(spark, monkeypatch):
    import quaestor.llm.suffix_dedup as module

    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcdef") for _ in range(700))
    texts = ["".join(rnd.choice("abcdef") for _ in range(900)) + passage + "".join(rnd.choice("abcdef") for _ in range(800)), "x" + passage + "y"]
    import pyarrow as pa

    batch = pa.record_batch([pa.array([1, 2]), pa.array(texts)], ["row_id", "text"])

    def rows():
        return sorted(tuple(r.values()) for b in module._anchor_rows(iter([batch]), WINDOW, WINDOW // 2) for r in b.to_pylist())
    whole = rows()
    monkeypatch.setattr(module, "BLOCK", 128)
    assert rows() == whole and len({r[1] for r in whole}) > 50


def test_clashing_columns_and_repeated_rows(spark):
    text = "".join(chr(97 + i % 23) + str(i) for i in range(60))
    frame = spark.createDataFrame([(1, text, "s", "k"), (1, text, "s", "k"), (None, None, None, None)],
                                  "row_id long, text string, spans string, kept string")
    out = repeated_spans(frame, window=WINDOW)
    assert out.columns == ["row_id", "text", "spans", "kept", "spans_", "kept_"]
    rows = out.where("row_id = 1").collect()
    assert [bytes(r.kept_) for r in rows] == [b"", b""] and [len(r.spans_) for r in rows] == [1, 1]
    assert repeated_spans(frame.limit(0), window=WINDOW).count() == 0
