"""Phrases against brute force, with small tries and chunks, and the trie by itself."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from tidemark.llm import packing, phrases, tables

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=100, top=2000):
    """(lang, text) rows to the contract's rows."""
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i : i + k])] += 1
    often = {key: n for key, n in count.items() if n >= least}
    shadowed = set()
    for (lang, words), n in often.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * n >= 100 * often[lang, words[i : i + k]]:
                    shadowed.add((lang, words[i : i + k]))
    out = []
    for (lang, words), a in often.items():
        if len(words) > 1 and (lang, words) not in shadowed:
            score, k = min(
                (1000 * a * total[lang] // (often[lang, words[:k]] * often[lang, words[k:]]), k) for k in range(1, len(words))
            )
            l, r = often[lang, words[:k]], often[lang, words[k:]]
            out.append((lang, " ".join(words), a, l, r, total[lang], score))
    ranked = []
    for lang in total:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(mine)]
    return sorted(ranked)


def _texts(n, seed=1, size=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["The", "of", "ä", "THE", "x\u0085y"]
    made = []
    for i in range(n):
        words = rng.choices(vocabulary, weights=[3] * 12 + [30, 20, 8, 5, 2], k=size)
        marks = rng.choices([" ", "  ", "\t", ", ", ".\n", "!?", " \r "], weights=[30, 2, 2, 2, 1, 1, 1], k=size)
        made.append((rng.choice(["en", "de", None, "und"]), "".join(w + m for w, m in zip(words, marks))))
    return made


def _found(spark, rows):
    docs = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")
    with tables.Staging(spark, "test") as staging:
        return sorted(map(tuple, phrases.top_phrases(docs, staging).select(*COLUMNS).collect()))


def test_equals_brute_force(llm):
    rows = _texts(150)
    assert {r[0] for r in brute(rows)} == {"en", "de", "und"}
    assert {len(r[2].split(" ")) for r in brute(rows)} >= {2, 3}
    assert _found(llm, rows) == brute(rows)


def test_long_phrases_shadow_their_parts(llm):
    rows = [("en", "one two three four five six")] * 120 + [("en", "two three. four five")] * 7 + [("fr", "a b c a b")] * 60
    found = _found(llm, rows)
    assert found == brute(rows)
    assert ("en", "two three four five six") in {(r[0], r[2]) for r in found}


def test_full_tries_spill(llm, monkeypatch):
    rows = _texts(400, seed=3)
    docs = llm.createDataFrame([(t, g) for g, t in rows], "text string, lang string").coalesce(1)
    kept = monkeypatch
    kept.setattr(phrases, "KEPT", 40)
    kept.setattr(phrases, "BURST", 4)
    kept.setattr(phrases, "BLOCK_WORDS", 500)
    kept.setattr(phrases, "CHUNK_BYTES", 20_000)
    kept.setattr(tables, "SLICE_BYTES", 2_000)
    # The limits are read inside tasks: run the tasks' functions here.
    batches = [docs.selectExpr("coalesce(lang, 'und') AS lang", "cast(text AS binary) AS text").toArrow().to_batches()]
    texts = [b for x in batches for b in x]
    monkeypatch.setattr(phrases, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 3})())}))
    chunk_rows = [r for b in phrases._word_chunks(8)(iter(texts)) for r in b.to_pylist()]
    assert len({r["chunk"] for r in chunk_rows}) > 2
    counted = Counter()
    merged = _merge(phrases._merge(1, 8), chunk_rows)
    for r in merged:
        if r["number"] is not None:
            counted[1] += 1
    for level in range(1, 5):
        chunk_rows = _extend(level, chunk_rows, merged)
        merged = _merge(phrases._merge(level + 1, 8), chunk_rows)
        counted[level + 1] = sum(r["number"] is not None for r in merged)
        if level == 1:  # a chunk whose trie is full has several runs of one prefix partition
            runs = Counter((r["chunk"], r["part"]) for r in chunk_rows if r["part"] is not None)
            assert max(runs.values()) > 1
    frequent = Counter()
    count = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", text.translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    count[lang or "und", tuple(words[i : i + k])] += 1
    for (_, words), n in count.items():
        frequent[len(words)] += n >= 100
    assert +counted == +frequent


def _batch(rows, names):
    return iter([pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows])] if rows else [])


def _merge(function, rows):
    runs = sorted((r for r in rows if r["part"] is not None), key=lambda r: (r["part"], r["chunk"]))
    return [r for b in function(_batch(runs, ("part", "chunk", "data"))) for r in b.to_pylist()]


def _extend(level, rows, merged):
    blocks = [r for r in rows if r["place"] is not None] + [{**r, "place": -1} for r in merged if r["chunk"] is not None]
    blocks.sort(key=lambda r: (r["chunk"], r["place"]))
    return [r for b in phrases._extend(level, 8)(_batch(blocks, ("chunk", "place", "data"))) for r in b.to_pylist()]


def test_trie_counts_and_gives_away_subtrees():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 6, (500, 3))
    trie = phrases.HatTrie(lambda codes: words[codes], burst=8)
    expected = Counter()
    for _ in range(20):
        codes, counts = np.unique(rng.integers(0, 500, 200), return_counts=True)
        trie.add(codes, counts)
        expected.update(dict(zip(codes.tolist(), counts.tolist())))
    assert trie.size == len(expected)
    assert any(isinstance(c, phrases.Node) for c in trie.root.values())
    codes, counts = trie.take(trie.size // 2)
    heads = set(words[codes, 0].tolist())
    assert trie.size <= len(expected) // 2 and trie.size + len(codes) == len(expected)
    rest, more = trie.take()
    assert not heads & set(words[rest, 0].tolist()) and trie.size == 0
    assert dict(zip(codes.tolist() + rest.tolist(), counts.tolist() + more.tolist())) == expected


def test_pairs_come_back_from_steps():
    rng = np.random.default_rng(6)
    for n in (0, 1, 300):
        pairs = np.unique(rng.integers(0, 40, (n, 2)), axis=0).astype(np.int64).reshape(-1, 2)
        left, right = packing.pairs_from(*packing.unpack(packing.pack(*packing.pair_steps(pairs[:, 0], pairs[:, 1]))))
        assert left.tolist() == pairs[:, 0].tolist() and right.tolist() == pairs[:, 1].tolist()


def test_closed_up():
    closed = phrases.closed_up(np.array([0, 0, 5, 0, 3, 4, 0, 0, 7, 0, 2, 2, 2]))
    assert closed.tolist() == [3, 4, 0, 2, 2, 2]


def test_awkward_rows(llm, documents, folder, awkward):
    rows = [(i, t, "en") for i, t in awkward] + [(None, "a b, a b", None)] * 120 + [(3, "a b a", "und")]
    found = entry.queries()["op13_phrases"](llm, folder(documents=documents(rows)))
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == brute([(r[2], r[1]) for r in rows])


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, " \t.", "en")]])
def test_no_phrases(llm, documents, folder, rows):
    assert entry.queries()["op13_phrases"](llm, folder(documents=documents(rows))).count() == 0
