"""The pipeline and each of its stages on empty and awkward tables."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline

ITEM = "one two three four five six seven eight nine ten"
CLEAN = "the quick brown fox number {} jumps over a lazy dog near the old river bank on day {} of may"


def _tables(llm, documents, folder, rows, items):
    benchmark = llm.createDataFrame(items, "item_id long, text string").selectExpr("*", "'clash' AS doc_id")
    return folder(documents=documents(rows), benchmark=benchmark)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, None)], [(2, "   "), (3, "")]])
def test_nothing_to_keep(llm, documents, folder, rows):
    path = _tables(llm, documents, folder, rows, [(1, ITEM)])
    assert corpus_pipeline.run(llm, path).count() == 0


def test_no_items(llm, documents, folder):
    rows = [(i, CLEAN.format(i * 7, "abcdefgh"[i])) for i in range(8)]
    path = _tables(llm, documents, folder, rows, [])
    kept = corpus_pipeline.run(llm, path).collect()
    assert kept and {r["doc_id"] for r in kept} <= set(range(8)) and all(r["round_trip"] for r in kept)


@pytest.mark.parametrize("n", range(len(corpus_pipeline.STAGES)))
def test_every_stage_takes_an_empty_table(llm, documents, folder, n):
    path = _tables(llm, documents, folder, [(1, "some text")], [(1, ITEM)])
    empty = documents([]).limit(0)
    made = corpus_pipeline.STAGES[n][1](llm, empty, path)
    assert made.count() == 0
    if n < len(corpus_pipeline.STAGES) - 1:
        assert made.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_awkward_rows_pass_through_all_stages(llm, documents, folder, awkward):
    clean = [(100 + i, CLEAN.format(i * 31, "abcdefghijkl"[i])) for i in range(12)]
    held = [(200, f"before it {ITEM} and after it"), (None, f"without an id {ITEM}"), (200, "another clean text under that id of two")]
    rows = awkward + clean + held + [clean[0], (None, "a clean text that has no id but letters")]
    path = _tables(llm, documents, folder, rows, [(1, ITEM), (2, None), (None, ""), (3, ITEM)])
    found = corpus_pipeline.run(llm, path).collect()
    digests = {(r["doc_id"], r["decoded_sha256"]) for r in found}
    texts = {(d, hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows}
    whole = [r for r in found if (r["doc_id"], r["decoded_sha256"]) in texts]
    assert all(r["round_trip"] for r in found) and len(digests) == len(found)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    # Held items go with their row alone; rows without letters go; copies leave one row.
    assert not {(d, sha(t)) for d, t in held[:2]} & digests
    assert {(200, sha(held[2][1])), (None, sha(rows[-1][1]))} <= digests
    assert not {r["doc_id"] for r in found} & {1, 2, 3}
    assert sum(r["doc_id"] == 5 for r in whole) == 2  # the repeated row once, the other text under its id
