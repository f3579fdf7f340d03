"""Alignment of two tokenizers against brute force with the libraries' own encoders."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tidemark.llm import alignment, bpe

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(alignment.MERGES_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL_PATH)


def _spans(tokens):
    out, at = [], 0
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def _brute(rows, libraries):
    a_lib, b_lib = libraries
    letters = bpe.byte_letters()
    parsed = []
    for doc_id, text in rows:
        a, b = [], []
        if text:
            enc = a_lib.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(letters[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
            for i in b_lib.encode(text):
                piece = b_lib.id_to_piece(i)
                b.append((i, bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()))
            want = (" " + text).encode()
            if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
                a, b = [], []
        a, b = _spans(a), _spans(b)
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for end in common:
            inside = [",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in (a, b)]
            groups.append("|".join(inside))
            low = end
        links, j = [], 0
        for i, s, e in a:
            while j and b[j - 1][2] > s:
                j -= 1
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        parsed.append((doc_id, len(a), len(b), groups, links))
    count = Counter(pair for *_, links in parsed for pair in set(links))
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    out = []
    for doc_id, n_a, n_b, groups, links in parsed:
        n_best = sum(count[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(count[p] for p in links), digest))
    return sorted(out, key=str)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


SHORT = [
    (20, "two  spaces\n\nand \ttabs  "), (21, " lead"), (22, "a "), (23, " "), (24, "   "), (25, "<s> </s> <unk> <0x41> <|endoftext|>"),
    (26, "漢字 and é́ 🙂 ａｂ"), (27, "can't won't I'll"), (28, "nul \u0000 byte"), (29, " x y"), (30, "a ▁ marker"),
]


def test_query_equals_brute_force_on_a_whole_table(llm, libraries):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = entry.queries()["op12_token_alignment"](llm, FOLDER)
    assert found.columns == [c.split()[0] for c in alignment.COUNTED.split(", ")]
    small = sorted(docs, key=lambda r: len(r["text"]))
    assert len(small) == found.count()
    assert _rows(found) == _brute(map(tuple, docs), libraries)


def test_awkward_rows(llm, documents, folder, awkward, libraries):
    rows = [r for r in awkward if r[0] != 6] + [(6, "x" * 3000)] + SHORT + SHORT[:3]
    found = _rows(entry.queries()["op12_token_alignment"](llm, folder(documents=documents(rows))))
    assert found == _brute(rows, libraries)
    assert [r for r in found if r[0] == 30] == [(30, 0, 0, 0, 0, 0, 0, "")]


def test_small_chunks_give_the_same(llm, documents, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_PAIRS", 20)
    monkeypatch.setattr(alignment.tables, "SLICE_BYTES", 40)
    rows = [(i, f"word number {i} of {i % 7} can't  stop") for i in range(200)]
    with alignment.tables.Staging(llm, "test") as staging:
        assert _rows(alignment.alignment_counts(documents(rows).coalesce(1), staging)) == _brute(rows, libraries)


def test_groups(llm, documents, libraries):
    rows = SHORT + [(1, None), (2, "")]
    found = {r["doc_id"]: r["groups"] for r in alignment.aligned_groups(documents(rows)).collect()}
    digests = {r[0]: r[-1] for r in _brute(rows, libraries)}
    assert {k: hashlib.sha256(g.encode()).hexdigest() if g else "" for k, g in found.items()} == digests


def test_empty_table(llm, documents, folder):
    assert entry.queries()["op12_token_alignment"](llm, folder(documents=documents([]))).count() == 0
