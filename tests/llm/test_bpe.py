"""Byte-level BPE against the library, over whole texts, chunked texts and awkward rows."""

from __future__ import annotations

import base64
import hashlib
import random

import pytest
import tiktoken

import __spark_entry__ as entry
from tidemark.llm import bpe

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def voc():
    return bpe.load_ranks()


@pytest.fixture(scope="module")
def library():
    with open(bpe.RANKS_PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _expected(rows, library):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        joined, back = ",".join(map(str, ids)).encode(), library.decode_bytes(ids)
        out.append((doc_id, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(back).hexdigest()))
    return sorted(out, key=str)


def _random_texts(n, size, letters="ab 'sretvlmd1\n\t é漢!_"):
    rng = random.Random(n * size)
    return ["".join(rng.choices(letters, k=rng.randrange(size))) for _ in range(n)]


def test_pieces_equal_the_library(voc, library):
    pieces = sorted({p for t in _random_texts(300, 80) for p in bpe._pattern.findall(t)} | {"x" * 90, "the" * 60})
    flat, offsets = bpe.Encoder(voc).encode([[p] for p in pieces])
    for i, piece in enumerate(pieces):
        assert flat[offsets[i] : offsets[i + 1]].tolist() == library.encode_ordinary(piece), piece


def test_heap_takes_the_same_merges(voc):
    pieces = [p for t in _random_texts(50, 60, "therinags 漢é") for p in [t.encode()] if p]
    flat, offsets = bpe.solve(pieces, voc)
    for i, piece in enumerate(pieces):
        assert bpe.solve_alone(piece, voc) == flat[offsets[i] : offsets[i + 1]].tolist()


@pytest.mark.parametrize("step,overlap", [(7, 3), (5, 0), (16, 5), (40, 11), (3, 9)])
def test_stitched_chunks_are_the_whole_reading(step, overlap):
    texts = _random_texts(200, 200) + ["x" * 150, "x" * 50 + " " * 60 + "'" * 40 + "'re", " " * 99 + "a", "a'rex" * 30]
    for text in texts:
        stitcher, found = bpe.Stitcher(), []
        for start in range(0, len(text), step):
            last = start + step >= len(text)
            chunk = text[start : start + step + overlap]
            lengths = [len(p) for p in bpe.settled(chunk, last)]
            found += stitcher.feed(start, chunk, lengths, last)
        assert found == bpe._pattern.findall(text), repr(text)


def test_query_equals_the_library(llm, library):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert any(len(r["text"]) > bpe.STEP for r in docs)
    found = entry.queries()["op11_byte_bpe"](llm, FOLDER).collect()
    assert sorted(map(tuple, found), key=str) == _expected(map(tuple, docs), library)


def test_awkward_rows(llm, documents, folder, awkward, library):
    rows = awkward + [(10, "a" * 40_000 + " b'll" * 9000), (10, "a" * 40_000), (11, "\n" * 50_000 + "x"), (None, "é" * 33_000)]
    found = entry.queries()["op11_byte_bpe"](llm, folder(documents=documents(rows))).collect()
    assert sorted(map(tuple, found), key=str) == _expected(rows, library)


def test_empty_table(llm, documents, folder):
    empty = entry.queries()["op11_byte_bpe"](llm, folder(documents=documents([])))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
