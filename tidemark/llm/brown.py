"""Language-model scores from a Brown class model: words get classes by exchange clustering, and a text's probability is
the product of class transitions and of the words' emissions from their classes.

Texts are packed into chunks with a word list each. Words of all chunks meet in buckets by their hash, as packed lists, one
row for each chunk and bucket, and what a bucket finds out about them goes back to the chunks the same way: first their
counts, then their classes after each round. So neither the vocabulary, nor the classes, nor a text is ever broadcast or
sent to the driver. All words seen at least ``LEAST`` times in training are clustered, however many there are. All others
share one class, in which each still has its own counted probability.

In a round every chunk counts its words' neighbours by class, a bucket sums these counts for its words, and moves each
to the class that raises the likelihood most: words that make up at least ``WORD_SHARE`` of the training tokens one by
one, the others in small batches. The buckets of a group share a copy of the class counts. Then the counts are taken
anew. Groups and buckets follow from the number of words, so the classes do not depend on how many tasks there are. A
round that does not raise the likelihood is undone, and the rounds after it move the words of half as many buckets.

Input cases: a null text is an empty one, whose only token is its end; repeated ids or rows are separate texts; a null
id is trained on; with nothing to learn from every token has probability one in the base score; an empty table gives an
empty result. Words are told apart by 64-bit hashes of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays, packing, tables

CLASSES = 48
ROUNDS = 5
#: Part of the likelihood by which a round must raise it for another one to follow, and most parts of a round.
SETTLED = 1e-4
MOST_PARTS = 4
#: Times a word is seen in training from which on it is clustered.
LEAST = 3
#: Share of the training tokens from which on a word is moved by itself, and starts in a class by its rank.
WORD_SHARE = 1.0 / (1 << 16)
#: Words that are moved at a time otherwise.
BATCH = 512
#: Words of chunks that meet in one bucket, about, and buckets at least.
BUCKET_WORDS, BUCKETS = 1 << 18, 256
#: Buckets, and clustered words at least, that are moved one after the other in one task: words that are moved side by
#: side do not see each other's moves, which only many words make up for.
GROUP_BUCKETS, GROUP_WORDS = 16, 4096
#: Text of one chunk, about.
CHUNK_BYTES = 8 << 20
#: Bytes of a batch of rows handed to Python, and of a row group of a staged table, both with one more row at most: what
#: a task holds does not grow with the rows it gets.
BATCH_BYTES, GROUP_BYTES = 4 << 20, 8 << 20
#: Weight of the class's own share in a smoothed transition.
TRANSITION_PRIOR = 16.0

#: ``texts``, ``counts`` and ``totals`` are compressed once, by the task that packs the chunk: the rows pass through Spark
#: in every round, and rows of less than half the size take less than half the memory there.
CHUNKS = (
    "chunk long, docs array<long>, held array<boolean>, texts binary, words binary, counts binary, "
    "n_words long, n_tokens long"
)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order of their first place, and the number of each value among them; without sorting."""
    found = pa.array(values).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to chunks: word numbers of all texts in turn, words by number (most frequent first), training counts."""
    task, made = TaskContext.get().partitionId(), 0
    held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []

    def chunk() -> pa.RecordBatch:
        nonlocal made
        rows = pa.Table.from_batches([h[0] for h in held])
        hashes = np.concatenate([h[1] for h in held])
        size = np.concatenate([h[2] for h in held])
        words, number = _numbered(hashes.view(np.int64))
        turn = np.lexsort((words.view(np.uint64), -np.bincount(number, minlength=len(words))))
        place = np.empty(len(words), np.int32)
        place[turn] = np.arange(len(words))
        tokens, words = place[number], words[turn]
        out = rows.column("held").to_numpy()
        counts = np.bincount(tokens[~np.repeat(out, size)], minlength=len(words))
        first = np.concatenate(([0], np.cumsum(size)))
        made += 1
        one = pa.array([0, len(size)], pa.int32())
        columns = [
            pa.array([task * (1 << 24) + made]),
            pa.ListArray.from_arrays(one, rows.column("doc_id").combine_chunks()),
            pa.ListArray.from_arrays(one, pa.array(out)),
            *(pa.array([x], pa.binary()) for x in (packing.pack(first, tokens), words.tobytes(), packing.pack(counts))),
            pa.array([len(words)]),
            pa.array([int(counts.sum())]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in CHUNKS.split(", ")])

    total = 0
    for batch in tables.slices(batches):
        found = arrays.words(batch.column("text"), lower=True)
        held.append((batch.select(["doc_id", "held"]), found.hashes(), np.diff(found.first)))
        total += len(found.data)
        if total >= CHUNK_BYTES:
            yield chunk()
            held, total = [], 0
    if held:
        yield chunk()


def _bucket(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of words by bucket, the buckets that have some, and where each begins and the last ends in that order."""
    bucket = (words.view(np.uint64) >> np.uint64(8)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    some, begin = np.unique(bucket[order], return_index=True)
    return order, some.astype(np.int64), np.append(begin, len(words))


def _packed(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows of numbers and arrays; arrays as bytes."""
    fields = [x.split() for x in schema.split(", ")]
    columns = []
    for (_, kind), values in zip(fields, zip(*rows) if rows else [[]] * len(fields)):
        if kind == "binary":
            columns.append(pa.array([x.tobytes() for x in values], pa.binary()))
        else:
            columns.append(pa.array(values, pa.int64()))
    return pa.RecordBatch.from_arrays(columns, names=[f[0] for f in fields])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one bucket after the other, from rows in order of buckets."""
    held: list[dict] = []
    for row in tables.rows(batches):
        if held and held[0]["bucket"] != row["bucket"]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _joined(rows: list[dict], name: str, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(r[name], kind) for r in rows])


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket")


COUNTED = "bucket long, chunk long, words binary, counts binary"
#: The row of a bucket with chunk -1 has its words that are often, the number of words seen and of words clustered.
TOTALS = "chunk long, bucket long, words binary, totals binary, seen long, clustered long"


def _count_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in tables.rows(batches):
            words, (counts,) = np.frombuffer(row["words"], np.int64), packing.unpack(row["counts"])
            order, some, at = _bucket(words, buckets)
            words, counts = words[order], counts[order]
            parts = zip(some.tolist(), at[:-1], at[1:])
            yield _packed([(k, row["chunk"], words[i:j], counts[i:j]) for k, i, j in parts], COUNTED)

    return run


def _total_rows(least: int, often: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for rows in _by_bucket(batches):
            words, place = _numbered(_joined(rows, "words", np.int64))
            total = np.bincount(place, weights=_joined(rows, "counts", np.int64)).astype(np.int64)
            top, bucket = total >= often, rows[0]["bucket"]
            out = [(-1, bucket, words[top], total[top], int((total > 0).sum()), int((total >= least).sum()))]
            ends = np.cumsum([len(r["words"]) // 8 for r in rows])[:-1]
            out += [(r["chunk"], bucket, none, total[p], 0, 0) for r, p in zip(rows, np.split(place, ends))]
            yield _packed(out, TOTALS)

    return run


def _with_totals(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                order, _, _ = _bucket(np.frombuffer(one.column("words")[0].as_buffer(), np.int64), buckets)
                totals = np.zeros(len(order), np.int64)
                found = one.column("found")[0].as_py()
                if found:
                    totals[order] = _joined(found, "totals", np.int64)
                columns = [one.column(c) for c in ("chunk", "docs", "held", "texts", "words")]
                columns.append(pa.array([packing.pack(totals)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in BASE.split(", ")])

    return run


BASE = "chunk long, docs array<long>, held array<boolean>, texts binary, words binary, totals binary"


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of ``BASE`` one after the other, with their arrays."""
    for row in tables.rows(batches):
        row["first"], row["tokens"] = packing.unpack(row.pop("texts"))
        (row["totals"],) = packing.unpack(row["totals"])
        yield row


def _back(rows: DataFrame, answers: DataFrame, *names: str) -> DataFrame:
    """Chunks with what the buckets answered them, in order of buckets; nothing if no word of theirs was asked for."""
    found = F.sort_array(F.collect_list(F.struct("bucket", *names))).alias("found")
    return rows.join(answers.groupBy("chunk").agg(found), "chunk", "left")


@dataclass
class Frequent:
    """Words that are often (hashes in order, 1 / WORD_SHARE at most) and the class each starts in. Other clustered words
    start in one by their hash. After the ``classes`` come the class of all other words, and that of the end."""

    words: np.ndarray
    label: np.ndarray
    classes: int
    least: int = LEAST

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Place of each word in ``words``; all others get the place behind the last."""
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, len(self.words))

    def start(self, words: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """First class of each word."""
        label = (words.view(np.uint64) % np.uint64(self.classes)).astype(np.int16)
        place = self.numbers(words)
        often = place < len(self.words)
        label[often] = self.label[place[often]]
        label[totals < self.least] = self.classes
        return label


def _sequence(row: dict, number: np.ndarray, end: int, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (before, after) of places in the kept texts, each text between two ends."""
    first = np.frombuffer(row["first"], np.int64)
    tokens = number[np.frombuffer(row["tokens"], np.int32)]
    n = len(first) - 1
    size = np.diff(first)
    spot = np.ones(len(tokens) + n, bool)
    spot[first[1:] + np.arange(n)] = False
    after = np.full(len(spot), end, number.dtype)
    after[spot] = tokens
    before = np.roll(after, 1)  # the last is an end
    mine = np.repeat(keep, size + 1)
    return before[mine], after[mine]


def _labels(row: dict, frequent: Frequent, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each word of a chunk, and the clustered words in the order in which buckets answer."""
    words = np.frombuffer(row["words"], np.int64)
    label = frequent.start(words, np.frombuffer(row["totals"], np.int64))
    live = np.flatnonzero(label < frequent.classes)
    live = live[_bucket(words[live], buckets)[0]]
    if row.get("found"):
        label[live] = _joined(row["found"], "label", np.int16)
    return label, live


#: ``size`` cells for each word: class of the word after, class of the word before behind these, or the word itself.
#: Rows with bucket -1 count class pairs.
ENTRIES = "bucket long, chunk long, words binary, label binary, size binary, cell binary, n binary, pairs binary"


def _kind(most: int) -> type:
    """Type for numbers from -``most`` to ``most``."""
    return np.int32 if most < 1 << 31 else np.int64


def _entries(row: dict, frequent: Frequent, buckets: int, pairs: np.ndarray) -> pa.RecordBatch:
    """Rows of a chunk for its buckets; its class pairs are added to ``pairs``."""
    width = frequent.classes + 2
    stride, none = 2 * width + 1, np.zeros(0, np.int16)
    words = np.frombuffer(row["words"], np.int64)
    label, live = _labels(row, frequent, buckets)
    end = len(words)
    before, after = _sequence(row, np.arange(end, dtype=np.int32), end, ~np.array(row["held"], dtype=bool))
    kind = np.append(label, width - 1).astype(np.int32)
    pairs += np.bincount(kind[before] * width + kind[after], minlength=len(pairs))
    place = np.full(end + 1, -1, _kind(len(live) * stride))
    place[live] = np.arange(len(live))
    itself = before == after
    found = np.flatnonzero(place[before] >= 0)
    key = place[before[found]] * stride + np.where(itself[found], 2 * width, kind[after[found]])
    found = np.flatnonzero((place[after] >= 0) & ~itself)
    key = np.concatenate((key, place[after[found]] * stride + width + kind[before[found]]))
    del before, after, itself, found
    key, n = np.unique(key, return_counts=True)
    cell, n = (key % stride).astype(np.int16), n.astype(np.int32)
    size = np.bincount(key // stride, minlength=len(live)).astype(np.int16)
    first = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
    _, some, at = _bucket(words[live], buckets)
    out = []
    for k, i, j in zip(some.tolist(), at[:-1], at[1:]):
        of, cells = live[i:j], slice(first[i], first[j])
        out.append((k, row["chunk"], words[of], label[of], size[i:j], cell[cells], n[cells], none))
    return _packed(out, ENTRIES)


def _entry_rows(frequent, buckets: int):
    """``frequent`` is a broadcast one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, pairs = np.zeros(0, np.int16), np.zeros((frequent.value.classes + 2) ** 2, np.int64)
        for row in _opened(batches):
            yield _entries(row, frequent.value, buckets, pairs)
        yield _packed([(-1, -1, none, none, none, none, none, pairs)], ENTRIES)

    return run


def _class_counts(entries: DataFrame, width: int) -> np.ndarray:
    """Class bigram counts; a row per class pair and task is all that is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            for pairs in batch.column("pairs"):
                total += np.frombuffer(pairs.as_py(), np.int64)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    rows = entries.filter("bucket < 0").select("pairs").mapInArrow(run, "cell long, n long")
    table = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(width * width)
    counts[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return counts.reshape(width, width)


def _xlogx(x: np.ndarray) -> np.ndarray:
    # A task's own counts may fall below zero where neighbours move in the same round.
    x = np.maximum(x, 0)
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(counts: np.ndarray) -> float:
    """What of the log-likelihood depends on the classes."""
    return float(_xlogx(counts).sum() - _xlogx(counts.sum(0)).sum() - _xlogx(counts.sum(1)).sum())


def best_class(
    counts: np.ndarray, classes: int, old: int, after: np.ndarray, before: np.ndarray, own: float
) -> int:
    """Class to which a word should move, and ``counts`` changed to the move.

    ``after`` and ``before`` count the word's neighbours by class, without the ``own`` pairs of the word with itself.
    """
    counts[old] -= after
    counts[:, old] -= before
    counts[old, old] -= own
    now = _xlogx(counts[:classes])
    turned = _xlogx(counts[:, :classes])
    row = _xlogx(counts[:classes] + after) - now
    column = _xlogx(counts[:, :classes] + before[:, None]) - turned
    at = np.arange(classes)
    own_cell = counts[at, at]
    gain = row.sum(1) - row[at, at] + column.sum(0) - column[at, at]
    gain += _xlogx(own_cell + after[:classes] + before[:classes] + own) - _xlogx(own_cell)
    # The word's neighbours keep their tokens wherever it goes.
    rows, columns = counts[:classes].sum(1) + before[:classes], counts[:, :classes].sum(0) + after[:classes]
    gain -= _xlogx(rows + after.sum() + own) - _xlogx(rows) + _xlogx(columns + before.sum() + own) - _xlogx(columns)
    new = int(gain.argmax())
    if gain[new] <= gain[old] + 1e-9 * abs(gain[old]):
        new = old
    counts[new] += after
    counts[:, new] += before
    counts[new, new] += own
    return new


def best_classes(
    counts: np.ndarray, classes: int, old: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray
) -> np.ndarray:
    """``best_class`` for many words, each as if it alone moved; then ``counts`` changed to all moves."""
    n = len(old)
    at = np.arange(n)
    gain = np.zeros((n, classes))

    def side(table: np.ndarray, mine: np.ndarray, other: np.ndarray) -> None:
        word, cell = np.nonzero(mine)
        if not len(word):
            return
        more, was = mine[word, cell], old[word]
        # Outside the word's own class, the change depends only on the cell and on what it gets.
        span = int(more.max()) + 1
        kinds, which = np.unique(cell * span + more.astype(np.int64), return_inverse=True)
        of, extra = np.divmod(kinds, span)
        now = table[:classes, of].T
        change = _xlogx(now + extra[:, None]) - _xlogx(now)
        inner = np.flatnonzero(of < classes)
        change[inner, of[inner]] = 0  # the cell of a class with itself comes below
        change = change[which]
        held = table[was, cell]
        change[np.arange(len(word)), was] = _xlogx(held) - _xlogx(held - more)
        hit = np.flatnonzero(cell == was)
        now = table[:classes, cell[hit]].T - other[word[hit], :classes]
        change[hit] = _xlogx(now + more[hit, None]) - _xlogx(now)
        change[hit, was[hit]] = 0
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        gain[word[first]] += np.add.reduceat(change, first, axis=0)

    side(counts, after, before)
    side(counts.T, before, after)
    more = after[:, :classes] + before[:, :classes] + own[:, None]
    itself = np.tile(np.diag(counts)[:classes], (n, 1))
    itself[at, old] -= more[at, old]
    word, cell = np.nonzero(more)
    held = itself[word, cell]
    gain[word, cell] += _xlogx(held + more[word, cell]) - _xlogx(held)
    for margin, mine in ((counts.sum(1), after), (counts.sum(0), before)):
        margin, size = margin[:classes], mine.sum(1) + own
        kinds, which = np.unique(size, return_inverse=True)
        change = (_xlogx(margin + kinds[:, None]) - _xlogx(margin))[which]
        change[at, old] = _xlogx(margin[old]) - _xlogx(margin[old] - size)
        gain -= change
    new = gain.argmax(1)
    kept = gain[at, old]
    new = np.where(gain[at, new] <= kept + 1e-9 * np.abs(kept), old, new)
    moved = np.flatnonzero(new != old)
    for table, mine in ((counts, after), (counts.T, before)):
        word, cell = np.nonzero(mine[moved])
        more, width = mine[moved[word], cell], len(counts)
        for label, sign in ((old[moved], -1), (new[moved], 1)):
            change = np.bincount(label[word] * width + cell, weights=more, minlength=width * width)
            table += sign * change.reshape(width, width)
    for label, sign in ((old[moved], -1), (new[moved], 1)):
        itself = np.bincount(label, weights=own[moved], minlength=len(counts))
        counts += sign * np.diag(itself)
    return new


ANSWERS = "chunk long, bucket long, label binary"


def _summed(key: np.ndarray, n: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The different keys (below ``cells``) in order, and the sum of ``n`` (1 or more each) of each."""
    if cells < 1 << 24:
        total = np.bincount(key, weights=n, minlength=1)
        key = np.flatnonzero(total)
        return key, total[key]
    key, place = np.unique(key, return_inverse=True)
    return key, np.bincount(place, weights=n, minlength=len(key))


def _move_rows(counts, classes: int, often: int, groups: int, shares: int = 1, share: int = 0):
    """New classes of the words of one in ``shares`` buckets; the others stay.

    Rows come in order of their group (bucket modulo ``groups``) and bucket. ``counts`` are broadcast ones, of which each
    group moves its words in a copy.
    """

    width = classes + 2
    stride = 2 * width + 1

    def moved(rows: list[dict], mine: np.ndarray) -> pa.RecordBatch:
        bucket, chunks = rows[0]["bucket"], [r["chunk"] for r in rows]
        ends = np.cumsum([len(r["words"]) // 8 for r in rows])[:-1]
        words, place = _numbered(_joined(rows, "words", np.int64))
        label = np.empty(len(words), np.int64)
        label[place] = _joined(rows, "label", np.int16)
        cell, n = _joined(rows, "cell", np.int16), _joined(rows, "n", np.int32)
        of = np.repeat(place, _joined(rows, "size", np.int16))
        rows.clear()
        # Every token of a word has one token after it, which may be the word itself.
        total = np.bincount(of, weights=n * ((cell < width) | (cell == 2 * width)), minlength=len(words))
        turn = np.lexsort((words, -total))
        rank = np.empty(len(words), _kind(len(words) * stride))
        rank[turn] = np.arange(len(words))
        key = rank[of] * stride + cell
        del of, cell
        key, n = _summed(key, n, len(words) * stride)
        singles = int((total >= often).sum())
        for begin in [*range(singles), *range(singles, len(words), BATCH)]:
            end = begin + 1 if begin < singles else min(begin + BATCH, len(words))
            part = slice(*np.searchsorted(key, [begin * stride, end * stride]))
            dense = np.zeros((end - begin) * stride)
            dense[key[part] - begin * stride] = n[part]
            dense = dense.reshape(-1, stride)
            after, before, own = dense[:, :width], dense[:, width : 2 * width], dense[:, -1]
            which = turn[begin:end]
            if begin < singles:
                old = int(label[which[0]])
                label[which] = best_class(mine, classes, old, after[0], before[0], own[0])
            else:
                label[which] = best_classes(mine, classes, label[which], after, before, own)
        label = label.astype(np.int16)
        return _packed([(c, bucket, label[p]) for c, p in zip(chunks, np.split(place, ends))], ANSWERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, mine = -1, None
        for rows in _by_bucket(batches):
            if rows[0]["bucket"] % groups != group:
                group, mine = rows[0]["bucket"] % groups, counts.value.copy()
            if rows[0]["bucket"] // groups % shares != share:
                yield _packed([(r["chunk"], r["bucket"], np.frombuffer(r["label"], np.int16)) for r in rows], ANSWERS)
            else:
                yield moved(rows, mine)

    return run


def cluster(
    base: DataFrame, frequent, buckets: int, often: int, staging: tables.Staging, rounds: int, clustered: int
) -> tuple[DataFrame, np.ndarray]:
    """Exchange rounds; returns the chunks with the classes of their words, and the class bigram counts."""
    context, classes = base.sparkSession.sparkContext, frequent.value.classes
    rows = base.select("chunk", "held", "texts", "words", "totals")

    entries_at = best_at = ""

    def counted(answers: DataFrame | None, turn: str) -> tuple[DataFrame, np.ndarray]:
        nonlocal entries_at
        joined = rows if answers is None else _back(rows, answers, "label")
        entries_at = f"entries{turn}"
        entries = joined.mapInArrow(_entry_rows(frequent, buckets), ENTRIES)
        entries = staging.put(entries, entries_at, group_bytes=GROUP_BYTES)
        return entries, _class_counts(entries, classes + 2)

    best, parts = None, 1
    groups = max(1, min(buckets // GROUP_BUCKETS, clustered // GROUP_WORDS))
    entries, counts = counted(None, "0")
    value = likelihood(counts)
    for turn in range(rounds):
        held = context.broadcast(counts)
        move = _move_rows(held, classes, often, groups, parts, turn % parts)
        dealt = entries.filter("bucket >= 0").drop("pairs").withColumn("group", (F.col("bucket") % groups).cast("int"))
        dealt = dealt.repartitionById(groups, "group").sortWithinPartitions("group", "bucket").drop("group")
        moved = staging.put(dealt.mapInArrow(move, ANSWERS), f"classes{turn}")
        staging.release(entries_at)
        entries, fresh = counted(moved, f"{turn + 1}")
        better = likelihood(fresh)
        if better <= value:
            staging.release(f"classes{turn}")
            parts *= 2
            if parts > MOST_PARTS or turn + 1 == rounds:
                break
            staging.release(entries_at)
            entries, counts = counted(best, f"{turn + 1}-again")
            continue
        if best is not None:
            staging.release(best_at)
        best, best_at, counts, gained, value = moved, f"classes{turn}", fresh, better - value, better
        if gained < SETTLED * abs(value):
            break
    return (base if best is None else _back(base, best, "label")), counts


@dataclass
class Model:
    frequent: Frequent
    buckets: int
    transition: np.ndarray  # log10, class before by class
    class_total: np.ndarray  # training tokens by class
    tail_words: int
    tokens: int
    vocabulary: int
    ends: int


def make_model(
    frequent: Frequent,
    counts: np.ndarray,
    tokens: int,
    vocabulary: int,
    ends: int,
    clustered: int | None = None,
    buckets: int = BUCKETS,
) -> Model:
    """``clustered`` words are not in the class of all others; those of ``frequent`` if not given."""
    share = (counts.sum(0) + 1) / (counts.sum() + len(counts))
    smoothed = counts + TRANSITION_PRIOR * share
    transition = np.log10(smoothed / smoothed.sum(1, keepdims=True))
    tail = vocabulary - (len(frequent.words) if clustered is None else clustered) - (ends > 0)
    return Model(frequent, buckets, transition, counts.sum(0), tail, tokens, vocabulary, ends)


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
    "score double, perplexity double"
)


def _score(row: dict, model: Model) -> pa.RecordBatch:
    words = np.frombuffer(row["words"], np.int64)
    total = np.frombuffer(row["totals"], np.int64).astype(np.float64)
    frequent, end = model.frequent, len(words)
    kind, _ = _labels(row, frequent, model.buckets)
    label = np.append(kind, frequent.classes + 1)
    tail = kind == frequent.classes
    of_class = model.class_total[kind]
    with np.errstate(divide="ignore"):
        emit = np.where(
            tail, (total + 1) / (of_class + model.tail_words + 1), total / np.where(tail, 1, np.maximum(of_class, 1))
        )
    base = np.log10((np.append(total, model.ends) + 1) / (model.tokens + model.vocabulary + 1))
    emission, known = np.append(np.log10(emit), 0.0), np.append(total, model.ends) > 0
    first = np.frombuffer(row["first"], np.int64)
    n = len(first) - 1
    size = np.diff(first) + 1
    before, after = _sequence(row, np.arange(end), end, np.ones(n, bool))
    spot = np.ones(len(after), bool)
    spot[np.cumsum(size) - 1] = False
    token = np.full(len(after), len(words), np.int64)
    token[spot] = np.frombuffer(row["tokens"], np.int32)
    doc = np.repeat(np.arange(n), size)
    each = emission[token] + model.transition[label[before], label[after]]
    score, base_score, n_known = (np.bincount(doc, weights=x, minlength=n) for x in (each, base[token], known[token]))
    columns = [
        pa.array(row["docs"], pa.int64()),
        pa.array(row["held"], pa.bool_()),
        pa.array(size),
        pa.array(n_known.astype(np.int64)),
        pa.array(np.full(n, model.tokens, np.int64)),
        pa.array(base_score),
        pa.array(score),
        pa.array(np.power(10.0, np.minimum(-score / size, 300.0))),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCORES.split(", ")])


def scores(
    docs: DataFrame, held_out: Column, classes: int = CLASSES, rounds: int = ROUNDS, least: int = LEAST
) -> DataFrame:
    """Base score, model score (log10 probabilities of the whole text) and perplexity of every row of ``docs``.

    Rows where ``held_out`` is false are learned from; words that those hold ``least`` times or more are clustered.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held"), F.col("text").cast("binary").alias("text")
    )
    with tables.Staging(spark, "brown") as staging, tables.small_batches(spark, BATCH_BYTES):
        chunks = staging.put(texts.mapInArrow(_pack, CHUNKS), "chunks", group_bytes=GROUP_BYTES)
        found = chunks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
        ends = texts.filter(~F.col("held")).count()
        tokens = int(found["tokens"] or 0) + ends
        buckets = max(BUCKETS, int(found["words"] or 0) // BUCKET_WORDS)
        often = max(least, int(np.ceil(tokens * WORD_SHARE)))
        counted = chunks.select("chunk", "words", "counts").mapInArrow(_count_rows(buckets), COUNTED)
        totals = staging.put(_dealt(counted).mapInArrow(_total_rows(least, often), TOTALS), "totals")
        own = totals.filter("chunk < 0")
        sums = own.agg(F.sum("seen").alias("seen"), F.sum("clustered").alias("clustered")).first()
        vocabulary, clustered = int(sums["seen"] or 0) + (ends > 0), int(sums["clustered"] or 0)
        top = [r for r in own.select("words", "totals").toArrow().to_pylist() if r["words"]]
        word, total = (_joined(top, c, np.int64) if top else np.zeros(0, np.int64) for c in ("words", "totals"))
        order = np.argsort(word)
        rank = np.empty(len(word), np.int64)
        rank[np.lexsort((word, -total))] = np.arange(len(word))
        frequent = Frequent(word[order], (rank % classes)[order], classes, least)
        answered = _back(chunks, totals.filter("chunk >= 0"), "totals")
        base = staging.put(answered.mapInArrow(_with_totals(buckets), BASE), "base", group_bytes=GROUP_BYTES)
        staging.release("chunks")
        staging.release("totals")
        starts = spark.sparkContext.broadcast(frequent)
        labelled, counts = cluster(base, starts, buckets, often, staging, rounds if clustered else 0, clustered)
        model = make_model(frequent, counts, tokens, vocabulary, ends, clustered, buckets)
        held = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _opened(batches):
                yield _score(row, held.value)

        return staging.put(labelled.mapInArrow(run, SCORES), "scores", keep=True)


def op1_brown_scores(spark, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return scores(tables.table(spark, sf_dir, "documents"), held_out)
