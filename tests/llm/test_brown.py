from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.llm import brown, tables

FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def expected(rows, held):
    train = Counter(w for i, r in enumerate(rows) if not held(r[0]) for w in tokens(r[1]))
    n, v = sum(train.values()), len(train)
    for doc, text in rows:
        words = tokens(text)
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words)
        yield doc, held(doc), len(words), sum(train[w] > 0 for w in words), n, round(base, 6)


def check(df, rows, held):
    found = Counter((*r[:5], round(r["base_score"], 6)) for r in df.collect())
    assert found == Counter(expected([r[:2] for r in rows], held))


def test_counts_and_base_equal_brute_force(documents, awkward):
    rows = awkward + [(100 + i, f"The cat sat on THE mat number{i % 7}") for i in range(60)]
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    df = brown.scores(documents(rows), held_out, classes=6)
    check(df, rows, lambda doc: doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2)


def test_nothing_to_learn_from(documents):
    rows = [(1, "some words"), (2, None)]
    df = brown.scores(documents(rows), F.lit(True))
    check(df, rows, lambda doc: True)
    assert all(math.isfinite(r["score"]) for r in df.collect())
    assert brown.scores(documents([]), F.lit(False)).count() == 0


def test_held_out_texts_are_likelier_than_by_the_base(llm):
    rows = brown.op1_brown_scores(llm, FOLDER).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_moves_are_the_best_by_the_whole_likelihood():
    rng = np.random.default_rng(2)
    words, classes = 12, 4
    pairs = rng.integers(0, 9, (words + 2, words + 2)).astype(float)
    label = np.append(rng.integers(0, classes, words), [classes, classes + 1])

    def counted(label):
        out = np.zeros((classes + 2, classes + 2))
        np.add.at(out, (label[:, None], label[None, :]), pairs)
        return out

    for word in range(words):
        counts = counted(label)
        others = np.arange(words + 2) != word
        after = np.bincount(label[others], weights=pairs[word, others], minlength=classes + 2)
        before = np.bincount(label[others], weights=pairs[others, word], minlength=classes + 2)
        tried = [brown.likelihood(counted(np.where(np.arange(words + 2) == word, c, label))) for c in range(classes)]
        label[word] = brown.best_class(counts, classes, int(label[word]), after, before, pairs[word, word])
        assert tried[label[word]] == pytest.approx(max(tried))
        assert counts == pytest.approx(counted(label))


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 50, (5, 5)).astype(float)
    model = brown.make_model(brown.Frequent(np.array([1, 2]), np.array([0, 1]), 3), counts, 100, 20, 5)
    assert np.power(10.0, model.transition).sum(1) == pytest.approx(np.ones(5))


def test_many_words_at_a_time_move_like_one():
    rng = np.random.default_rng(3)
    words, classes = 40, 5
    pairs = rng.poisson(0.3, (words + 2, words + 2)).astype(float)
    label = np.append(rng.integers(0, classes, words), [classes, classes + 1])
    counts = np.zeros((classes + 2, classes + 2))
    np.add.at(counts, (label[:, None], label[None, :]), pairs)
    after, before, expected = [], [], []
    for word in range(words):
        others = np.arange(words + 2) != word
        after.append(np.bincount(label[others], weights=pairs[word, others], minlength=classes + 2))
        before.append(np.bincount(label[others], weights=pairs[others, word], minlength=classes + 2))
        old = int(label[word])
        expected.append(brown.best_class(counts.copy(), classes, old, after[-1], before[-1], pairs[word, word]))
    own = np.diag(pairs)[:words]
    found = brown.best_classes(counts.copy(), classes, label[:words], np.array(after), np.array(before), own)
    assert found.tolist() == expected and (found != label[:words]).any()


def test_words_of_a_tiny_share_are_clustered(documents):
    rng = np.random.default_rng(5)
    # Each of these words makes up less than 2^-16 of the tokens.
    pairs = [(first, f"{first}{i}") for first in ("alpha", "beta") for i in range(300)] * 4
    rows = [(1, " ".join("so {} {} then".format(*pairs[i]) for i in rng.permutation(len(pairs))))]
    rows += [(10 + i, "filler of many other words here " * 2500) for i in range(20)]
    right = [(1000 + i, f"so alpha alpha{i} then") for i in range(300)]
    wrong = [(2000 + i, f"so alpha beta{i} then") for i in range(300)]
    df = brown.scores(documents([*rows, *right, *wrong]), F.col("doc_id") >= 1000, classes=16)
    score = {r["doc_id"]: r["score"] for r in df.collect()}
    # In one class for all of them, both would be equally likely.
    assert np.mean([score[1000 + i] - score[2000 + i] for i in range(300)]) > 1


@pytest.fixture
def partitions(llm):
    """Set the number of shuffle partitions, and let it hold."""
    before = {k: llm.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}

    def to(n):
        llm.conf.set("spark.sql.shuffle.partitions", str(n))
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    yield to
    for key, value in before.items():
        llm.conf.set(key, value)


def test_scores_do_not_depend_on_the_number_of_tasks(llm, partitions):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id < 60")
    found = []
    for n in (2, 8, 32):
        partitions(n)
        rows = brown.scores(docs, F.col("doc_id") % 7 == 2, classes=8, rounds=3).select("doc_id", "score").collect()
        found.append({r["doc_id"]: r["score"] for r in rows})
    assert found[0] == pytest.approx(found[1], rel=1e-9)
    assert found[0] == pytest.approx(found[2], rel=1e-9)


def test_rounds_that_do_not_gain_are_undone(llm, monkeypatch):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id < 20")
    values = iter([-100.0, -90.0, -95.0, -80.0, -85.0, -86.0])  # start, gain, loss, gain, loss, loss
    moved = []
    move = brown._move_rows
    monkeypatch.setattr(brown, "likelihood", lambda counts: next(values))
    monkeypatch.setattr(brown, "_move_rows", lambda *a: moved.append(a[4:]) or move(*a))
    rows = brown.scores(docs, F.lit(False), classes=4).collect()
    assert moved == [(1, 0), (1, 0), (2, 0), (2, 1), (4, 0)]
    assert len(rows) == 20 and all(math.isfinite(r["score"]) for r in rows)


def test_least_is_one_rule_for_every_size(documents):
    rows = [(i, "twice twice other words") for i in range(1)] + [(9, "other words again")]
    few = {r["doc_id"]: r["score"] for r in brown.scores(documents(rows), F.lit(False), classes=2, least=100).collect()}
    assert few and all(math.isfinite(s) for s in few.values())


def test_score_equals_brute_force_with_given_classes():
    rng = np.random.default_rng(8)
    classes, words = 3, np.sort(rng.integers(-(1 << 60), 1 << 60, 9))
    total = np.array([5, 9, 3, 7, 4, 1, 2, 0, 1])
    label = np.where(total >= 3, rng.integers(0, classes, 9), classes)
    frequent = brown.Frequent(words[:5], label[:5].astype(np.int16), classes, least=3)
    pairs = rng.integers(0, 20, (classes + 2, classes + 2)).astype(float)
    for c in range(classes + 1):  # as many tokens of each class as its words have
        pairs[:, c] = np.bincount(rng.integers(0, classes + 2, total[label == c].sum()), minlength=classes + 2)
    seen = int((total > 0).sum())
    model = brown.make_model(frequent, pairs, 50, seen + 1, 4, clustered=5)
    texts = [[0, 1, 8, 7], [], [5, 5, 2, 3, 4]]
    flat = np.array([w for t in texts for w in t], np.int32)
    row = {
        "words": words.tobytes(), "totals": total.tobytes(), "tokens": flat.tobytes(), "docs": [1, 2, 3],
        "held": [False] * 3, "first": np.cumsum([0, *map(len, texts)]).tobytes(),
    }
    found = brown._score(row, model).column("score").to_pylist()
    prior = (pairs.sum(0) + 1) / (pairs.sum() + len(pairs))
    smooth = (pairs + brown.TRANSITION_PRIOR * prior) / (pairs + brown.TRANSITION_PRIOR * prior).sum(1, keepdims=True)
    tail_words = int(((total > 0) & (total < 3)).sum())

    def emission(w):
        size = total[label == label[w]].sum()
        return (total[w] + 1) / (size + tail_words + 1) if label[w] == classes else total[w] / size

    for text, score in zip(texts, found):
        kinds = [classes + 1, *(label[w] for w in text), classes + 1]
        p = math.prod(smooth[a, b] for a, b in zip(kinds, kinds[1:])) * math.prod(emission(w) for w in text)
        assert score == pytest.approx(math.log10(p))
    # Emissions of a class sum to one; the class of all other words leaves one share for words never seen.
    for c in range(classes):
        members = [emission(w) for w in range(9) if label[w] == c]
        assert not members or sum(members) == pytest.approx(1)
    rest = [emission(w) for w in range(9) if label[w] == classes and total[w]]
    assert sum(rest) + 1 / (total[label == classes].sum() + tail_words + 1) == pytest.approx(1)


@pytest.mark.parametrize("cells", [100, 1 << 40])
def test_cells_are_summed_in_order(cells):
    rng = np.random.default_rng(12)
    key, n = rng.integers(0, min(cells, 1 << 40), 50).repeat(3), rng.integers(1, 9, 150).astype(np.int32)
    expected = Counter()
    for k, x in zip(key.tolist(), n.tolist()):
        expected[k] += x
    found = brown._summed(key, n, cells)
    assert list(zip(*(x.tolist() for x in found))) == sorted(expected.items())
    assert [len(x) for x in brown._summed(key[:0], n[:0], cells)] == [0, 0]


def test_a_batch_works_out_each_change_once(monkeypatch):
    rng = np.random.default_rng(13)
    words, classes = 512, 48
    counts = rng.integers(500, 900, (classes + 2, classes + 2)).astype(float)
    label = rng.integers(0, classes, words)
    after, before = (rng.poisson(0.2, (words, classes + 2)).astype(float) for _ in range(2))
    asked, log = [], brown._xlogx
    monkeypatch.setattr(brown, "_xlogx", lambda x: asked.append(np.size(x)) or log(x))
    brown.best_classes(counts, classes, label, after, before, np.zeros(words))
    # Less than one logarithm for each neighbour and class; two and more before.
    assert sum(asked) < (np.count_nonzero(after) + np.count_nonzero(before)) * classes / 4


def test_a_task_holds_a_part_of_its_rows(llm, monkeypatch, tmp_path):
    rng = np.random.default_rng(21)
    words = np.array([f"{i:05x}" for i in range(200_000)])
    texts = [(i, " ".join(words[rng.integers(0, len(words), 170_000)])) for i in range(40)]
    schema = "doc_id long, text string"
    llm.createDataFrame(texts, schema).coalesce(1).write.parquet(str(tmp_path / "documents"))
    seen, put, before = {}, tables.Staging.put, llm.conf.get(tables.BATCH_SETTING, None)

    def spied(self, df, name, *a, **b):
        out = put(self, df, name, *a, **b)
        files = [f.removeprefix("file://") for f in out.inputFiles()]
        groups = [g for m in map(pq.read_metadata, files) for g in map(m.row_group, range(m.num_row_groups))]
        seen[name] = int(llm.conf.get(tables.BATCH_SETTING)), [(g.num_rows, g.total_byte_size) for g in groups]
        return out

    monkeypatch.setattr(tables.Staging, "put", spied)
    docs = llm.read.parquet(str(tmp_path / "documents"))
    assert brown.scores(docs, F.lit(False), classes=4, rounds=1).count() == 40
    assert {b for b, _ in seen.values()} == {brown.BATCH_BYTES}
    assert llm.conf.get(tables.BATCH_SETTING, None) == before
    for name in ("chunks", "base", "entries0", "entries1"):
        groups = seen[name][1]
        # The row that fills a group may be a large one.
        assert all(size <= brown.GROUP_BYTES + (8 << 20) for _, size in groups), name
    assert len(seen["chunks"][1]) > 1


def test_batches_end_with_the_row_that_fills_them(llm):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    df = llm.range(0, 40, 1, 1).selectExpr("repeat('x', 100000) AS text")
    before = llm.conf.get(tables.BATCH_SETTING, None)
    with pytest.raises(ValueError), tables.small_batches(llm, 1 << 20):
        assert [r["n"] for r in df.mapInArrow(sizes, "n long").collect()] == [11, 11, 11, 7]
        raise ValueError
    assert llm.conf.get(tables.BATCH_SETTING, None) == before
    llm.conf.set(tables.BATCH_SETTING, "64k")
    try:
        with tables.small_batches(llm, 1 << 20):
            assert llm.conf.get(tables.BATCH_SETTING) == "64k"
    finally:
        llm.conf.unset(tables.BATCH_SETTING) if before is None else llm.conf.set(tables.BATCH_SETTING, before)


def test_rows_of_buckets_are_not_copies():
    one = pa.array([bytes(1 << 20)] * 64, pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(range(64)), one], names=["bucket", "words"])
    tracemalloc.start()
    sizes = [sum(len(r["words"]) for r in rows) for rows in brown._by_bucket(iter([batch]))]
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sizes == [1 << 20] * 64 and peak < 1 << 20


def test_counts_in_wide_and_narrow_numbers_are_equal(monkeypatch):
    rng = np.random.default_rng(22)
    words, n_texts = rng.integers(-(1 << 60), 1 << 60, 50), 30
    size = rng.integers(0, 40, n_texts)
    tokens = np.minimum(rng.geometric(0.1, int(size.sum())), len(words) - 1).astype(np.int32)
    row = {
        "chunk": 1, "held": [False, True, False] * 10, "words": words.tobytes(), "totals": np.full(50, 9),
        "first": np.concatenate(([0], np.cumsum(size))), "tokens": tokens,
    }
    frequent = brown.Frequent(np.sort(words[:9]), np.zeros(9, np.int16), 5)
    found = []
    for kind in (brown._kind(1), brown._kind(1 << 31)):
        monkeypatch.setattr(brown, "_kind", lambda most, kind=kind: kind)
        pairs = np.zeros(49, np.int64)
        found.append((brown._entries(dict(row), frequent, 8, pairs), pairs.tolist()))
    assert found[0] == found[1]
    # Every token of a text that is learned from, and its end, follows something.
    assert sum(found[0][1]) == sum(int(s) + 1 for s, h in zip(size, row["held"]) if not h)
