from __future__ import annotations

import os
import random

import pytest
import sentencepiece

from tidemark.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL_PATH), reason="the public vocabulary is not installed")


@pytest.fixture(scope="module")
def voc():
    return pieces.load()


@pytest.fixture(scope="module")
def library():
    """The library on the same pieces and scores, told that they are a unigram model."""

    def varint(n):
        out = b""
        while True:
            n, low = n >> 7, n & 127
            out += bytes([low | (128 if n else 0)])
            if not n:
                return out

    def message(fields, change):
        out = b""
        for number, value in fields:
            value = change(number, value)
            if isinstance(value, int):
                out += varint(number << 3) + varint(value)
            else:
                out += varint(number << 3 | 2) + varint(len(value)) + value
        return out

    with open(pieces.MODEL_PATH, "rb") as file:
        data = file.read()

    def trainer(value):
        fields = [(n, v) for n, v in pieces._fields(value) if isinstance(v, int)]
        return message(fields, lambda n, v: 1 if n == 3 else v)

    model = message(pieces._fields(data), lambda n, v: trainer(v) if n == 2 else v)
    return sentencepiece.SentencePieceProcessor(model_proto=model)


TEXTS = ["the house", "a", "thenthe withering", "Hello, world", "  two  spaces ", "naïve été", "x" * 50, "of the in that"]


def paths_total(text, voc):
    """Best total score over all paths, by plain dynamic programming over characters."""
    known = {}
    for i in range(len(voc.score)):
        if voc.kind[i] in (pieces.NORMAL, pieces.USER_DEFINED):
            known[voc.text[voc.text_at[i] : voc.text_at[i + 1]].tobytes()] = voc.score[i]
    text = " " + text
    best = [0.0] + [float("-inf")] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - 20), j):
            part = text[i:j].encode()
            if part in known:
                best[j] = max(best[j], best[i] + known[part])
            elif j == i + 1:
                best[j] = max(best[j], best[i] + voc.unknown)
    return best[-1]


def test_totals_equal_brute_force(voc):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choices("the rinags▁é\n漢", k=30)) for _ in range(40)]
    for text in texts:
        flat, _ = pieces.Encoder(voc).encode([text.encode()])
        total, i = 0.0, 0
        while i < len(flat):
            if voc.kind[flat[i]] == pieces.BYTE:
                width = int(pieces._WIDTH[voc.text[voc.text_at[flat[i]]]])
                total, i = total + voc.unknown, i + width
            else:
                total, i = total + voc.score[flat[i]], i + 1
        assert total == paths_total(text, voc)


def test_same_best_path_as_the_library(voc, library):
    for text in TEXTS:
        flat, _ = pieces.Encoder(voc).encode([text.encode()])
        best = library.nbest_encode_as_ids(text, 3)[0]
        assert sum(map(library.get_score, best)) == pytest.approx(voc.score[flat].sum())


def test_long_text_is_made_of_its_segments(voc):
    text = b"one two  three\nfour five" * 20
    whole, _ = pieces.solve([b" " + text], voc)
    flat, _ = pieces.Encoder(voc).encode([text])
    assert flat.tolist() == whole.tolist()


def test_long_segments_take_the_same_path(voc):
    rng = random.Random(2)
    for text in ["".join(rng.choices("therinags漢é", k=n)).encode() for n in (1, 30, 900)]:
        assert pieces.solve_alone(text, voc) == pieces.solve([text], voc)[0].tolist()
    flat, offsets = pieces.Encoder(voc).encode([b"a", b"the" * 400, None, b"the" * 400 + b" b"])
    assert pieces.decode(flat, offsets, voc) == [b"a", b"the" * 400, b"", b"the" * 400 + b" b"]


def test_trie_holds_every_piece(voc):
    words = sorted([b"a", b"ab", b"abc", b"b", b"ba", b"\xff\xff", b" a"])
    base, check, piece = pieces.double_array(words)
    for i, word in enumerate(words):
        state = 0
        for c in word:
            child = base[state] + c + 1
            assert check[child] == state
            state = child
        assert piece[state] == i


def test_round_trip_of_awkward_rows(documents, awkward):
    rows = pieces.encode_documents(documents(awkward)).collect()
    assert len(rows) == len(awkward) and all(r["round_trip"] for r in rows)
    assert {len(r["piece_ids"]) for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert pieces.encode_documents(documents([])).count() == 0
