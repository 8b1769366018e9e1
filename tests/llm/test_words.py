from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from quaestor.llm import words as w


def words_of(batch, size):
    out = [[] for _ in batch]
    for piece in w.pieces(batch, size):
        found = w.find_words(piece)
        for doc, s, e in zip(found.doc, found.start, found.end, strict=True):
            out[piece.first + doc].append(piece.data[s:e].tobytes().decode())
    return out


def test_words_of_sliced_batches_with_nulls():
    rnd = random.Random(1)
    texts = [None if rnd.random() < 0.2 else "".join(rnd.choice("aé \n\tb\x85") for _ in range(rnd.randrange(9))) for _ in range(200)]
    for kind in (pa.string(), pa.large_string()):
        batch = pa.array(texts, kind).slice(7, 150)
        want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts[7:157]]
        assert words_of(batch, 20) == words_of(batch, 1 << 20) == want
    assert words_of(pa.array([], pa.string()), 20) == []
    assert words_of(pa.array(["", None, ""], pa.string()), 20) == [[], [], []]


def test_hashes_do_not_depend_on_the_block(monkeypatch):
    text = " ".join(["word", "other", "word", "é", "x" * 500, "word"] * 40)
    (piece,) = w.pieces(pa.array([text]))
    found = w.find_words(piece)
    whole = w.hash_spans(piece.data, found.start, found.end)
    monkeypatch.setattr(w, "BLOCK", 64)
    assert (w.hash_spans(piece.data, found.start, found.end) == whole).all()
    assert len(set(whole.tolist())) == 4 and int(whole[0]) == w.hash_text("word")
    rows = w.hash_spans(piece.data, found.start, found.end, (3, 5))
    assert rows[0][0] == w.hash_text("wor") and rows[1][1] == w.hash_text("other") and rows[1][0] == 0


def test_folding_and_letters():
    data = np.frombuffer("AZÉ×ß“a”é’b".encode(), np.uint8)
    assert w.folded(data).tobytes().decode() == "azé×ß“a”é’b"
    (piece,) = w.pieces(pa.array(["l’Été, “ok”\xa0x—y"]))
    found = w.find_words(piece, w.letters(piece.data))
    assert [piece.data[s:e].tobytes().decode() for s, e in zip(found.start, found.end, strict=True)] == ["l", "Été", "ok", "x", "y"]
