"""Both operators on repeated windows against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import arrays, fmindex, repeats, suffixes, tables

LAST = 1 << 63


def corpus(seed, count):
    rng = random.Random(seed)
    parts = [" ".join(rng.choices(["alpha", "be", "gam", "d", "epsi\n", "é"], k=rng.randrange(40))) + " " for _ in range(20)]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(6)))) for i in range(count)]
    rows += [(None, parts[0] * 2), (5000, "a" * 400), (5001, "ab" * 90), (5002, "a " * 399), (7, parts[1] * 3)]
    return [*rows, rows[3]]


def order(row):
    return LAST if row[0] is None else row[0]


def brute_bytes(rows, size):
    seen, out = set(), set()
    for doc, text in sorted(set(rows), key=order):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - size + 1):
            if data[i : i + size] in seen:
                gone[i : i + size] = b"\1" * size
            seen.add(data[i : i + size])
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.add((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(rows, size):
    first, out = {}, set()
    for row in sorted(set(rows), key=order):
        words = (row[1] or "").encode().split()
        for i in range(len(words) - size + 1):
            first.setdefault(tuple(words[i : i + size]), order(row))
    for row in set(rows):
        words = (row[1] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < order(row):
                gone[i : i + size] = [True] * size
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.add((row[0], len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def unique_ids(rows):
    """Rows whose id, if repeated, comes with one text: their order among each other is then told by the contract."""
    texts = {}
    return [r for r in rows if texts.setdefault(r[0], r[1]) == r[1]]


@pytest.mark.parametrize("size, gram, seed", [(20, 6, 1), (100, 24, 2)])
def test_bytes_equal_brute_force(documents, size, gram, seed):
    rows = unique_ids(corpus(seed, 60))
    found = suffixes.remove_repeats(documents(rows), size, gram).collect()
    assert len(found) == len(rows)
    assert {(r[0], r[1], r[2], r[3], r[4]) for r in found} == brute_bytes(rows, size)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in found)


@pytest.mark.parametrize("size, gram, seed", [(10, 3, 3), (50, 8, 4)])
def test_words_equal_brute_force(documents, size, gram, seed):
    rows = corpus(seed, 60)
    found = fmindex.remove_repeats(documents(rows), size, gram).collect()
    assert len(found) == len(rows)
    assert {(r[0], r[1], r[2], r[4]) for r in found} == brute_words(rows, size)


def test_awkward_rows(documents, awkward):
    words = fmindex.remove_repeats(documents(awkward)).collect()
    assert {(r[0], r[1], r[2], r[4]) for r in words} == brute_words(awkward, 50)
    rows = unique_ids(awkward)
    found = suffixes.remove_repeats(documents(rows)).collect()
    assert {(r[0], r[1], r[2], r[3], r[4]) for r in found} == brute_bytes(rows, 100)
    assert len(suffixes.remove_repeats(documents(awkward)).collect()) == len(awkward)


def test_empty_tables(documents):
    assert fmindex.remove_repeats(documents([])).count() == 0
    assert suffixes.remove_repeats(documents([])).count() == 0


def test_stage_keeps_valid_text(documents):
    body = "".join(f"é{i}" for i in range(100, 150))
    rows = [(1, "a" + body), (2, body + " and more of it"), (3, body), (4, None), (5, "")]
    kept = suffixes.stage(documents(rows).sparkSession, documents(rows), "").collect()
    assert {r["doc_id"]: r["text"] for r in kept} == {1: "a" + body, 2: " and more of it", 4: None, 5: ""}
    assert all(r["n_chars"] == len(r["text"] or "") for r in kept)


def test_matching_statistics():
    rng = random.Random(5)

    def text(symbols, low, high):
        return np.array([rng.randrange(symbols) for _ in range(rng.randrange(low, high))], dtype=np.uint64)

    texts = [text(3, 5, 40) for _ in range(30)]
    streams = [text(4, 1, 40) for _ in range(30)] + texts[:3]
    index = fmindex.FMIndex(texts, 7)
    length, first = index.matches(streams)
    known = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, min(len(t), i + 7) + 1)}
    at = 0
    for stream in streams:
        for i in range(len(stream)):
            longest = max((n for n in range(1, 8) if i + n <= len(stream) and tuple(stream[i : i + n]) in known), default=0)
            assert min(length[at], 7) == longest
            if longest:
                place = index.suffix[first[at]]
                found = texts[index.text_of[place]][index.offset[place] :][:longest]
                assert (found == stream[i : i + longest]).all()
            at += 1


def test_loser_tree_merges_and_tells_shared_lengths():
    rng = random.Random(6)
    for n_runs in (1, 2, 3, 5, 8):
        runs = [sorted(bytes(rng.choices(b"ab\0", k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 40))) for _ in range(n_runs)]
        coded, compared = [], sorted(x for r in runs for x in r)
        for r in runs:
            shared = suffixes.shared_prefixes(r).tolist()
            coded.append((shared, [x[k:] for x, k in zip(r, shared)]))
        out = list(suffixes.LoserTree(coded))
        assert [runs[r][i] for r, i, _ in out] == compared
        expected = suffixes.shared_prefixes(compared).tolist()
        assert [k for _, _, k in out] == expected


@pytest.mark.parametrize("words", [False, True])
def test_texts_longer_than_places_have_bits(monkeypatch, words):
    rng = random.Random(9)
    text = " ".join(rng.choices(["alpha", "be", "gam", "d"], k=900)).encode()
    kind = repeats.Kind(words=words, size=20, gram=4, within=True)
    batch = pa.RecordBatch.from_pydict({"text": pa.array([text], pa.binary()), "doc": [1], "mark": [2]})
    monkeypatch.setattr(repeats, "_PLACE_BITS", np.uint64(6))
    found = repeats._stretches(batch, kind, repeats.Common(np.zeros(0, np.uint64))).to_pylist()
    rank = arrays.rolling(repeats.units(batch.column("text"), kind)[0], kind.gram) >> np.uint64(7)
    width = kind.size - kind.gram + 1
    expected = [i + int(rank[i : i + width].argmin()) for i in range(len(rank) - width + 1)]
    assert [r["start"] + r["lead"] for r in sorted(found, key=lambda r: r["start"]) for _ in range(r["n"])] == expected


def test_groups_beyond_the_limit_of_one_offset_width_stay_whole():
    batches = [pa.record_batch({"doc": [i], "text": pa.array([bytes([65 + i]) * 50], pa.binary())}) for i in range(6)]
    for limit in (10, 1 << 31):
        found = tables.whole(batches, limit)
        assert found.num_rows == 6 and found.column("text").to_pylist() == [bytes([65 + i]) * 50 for i in range(6)]
    assert pa.types.is_large_binary(tables.whole(batches, 10).schema.field("text").type)


@pytest.mark.parametrize("limit", [10, 1 << 31])
def test_both_operators_take_wide_groups(llm, documents, monkeypatch, limit):
    plain = tables.whole
    monkeypatch.setattr(tables, "whole", lambda held: plain(held, limit))
    words = fmindex._shards(iter([pa.record_batch({"anchor": [1, 1, 2], "words": pa.array([b"a" * 16, b"b" * 16, b"c" * 8], pa.binary())})]), 1)
    assert [b.column("words").to_pylist() for b in words] == [[b"a" * 16, b"b" * 16], [b"c" * 8]]
    runs = suffixes.by_group(iter([pa.record_batch({"shard": [0, 0, 3], "rest": pa.array([b"x", b"yy", b""], pa.binary())})]), "shard")
    assert [b.column("rest").to_pylist() for b in runs] == [[b"x", b"yy"], [b""]]
