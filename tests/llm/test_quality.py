from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tidemark.llm import quality

FOLDER = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = text.encode().split()
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), chars, symbols, len(lines) - len(set(lines)), len(inside)


def test_counts_equal_brute_force(llm, documents, awkward):
    rows = awkward + [(20, "a b c a b c\nx\n\nx\n x\n"), (21, "| # <é> $%&*"), (22, "a a a a")]
    found = quality.measures(documents(rows)).collect()
    assert len(found) == len(rows)
    expected = Counter((r[0], *brute(r[1])) for r in rows)
    assert Counter((r[0], r[1], r[2], r[3], r[4], r[5]) for r in found) == expected


def test_empty_table(documents):
    assert quality.quality(documents([])).count() == 0


def test_the_model_finds_who_can_be_trusted():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.55])
    votes = np.where(rng.random((20_000, 4)) < right, np.where(good, 1, -1)[:, None], np.where(good, -1, 1)[:, None])
    votes[rng.random(votes.shape) < 0.2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, chance = quality.fit(patterns, counts)
    assert share == pytest.approx(0.8, abs=0.03)
    trusted = chance[1, :, 2] / (chance[1, :, 2] + chance[1, :, 0])
    assert trusted == pytest.approx(right, abs=0.05)


def test_verdicts_agree_with_labels(llm):
    found = quality.op9_quality_rules(llm, FOLDER).join(llm.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    rows = found.filter("not base_failed").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.97 * len(rows)
