"""Removal of repeated byte strings by a suffix array that is sorted across tasks.

Only suffixes at anchors (see ``repeats``) are sorted: equal windows contain equal anchors at equal places. Each task
sorts its suffixes and sends them, front-coded (length of the prefix shared with the one before, and the rest), to the
task of their key range. There a loser tree merges the runs: it knows how long a prefix each head shares with the last
suffix put out, so it compares characters only beyond that, and its output comes with the shared lengths. Windows around
an anchor are equal if what follows (shared lengths) and what goes before (a sorted array of the reversed heads) agree.

Input cases: a null text is an empty one; a text shorter than a window loses nothing; rows with the same id and text are
one document, each row with the same result; rows with one id and different texts are taken in the order of a hash of
the text; a null id comes after all others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tables
from tidemark.llm.arrays import buffers
from tidemark.llm.repeats import COVERED, Kind, covered, keyed, lists, merged, ranges_of

#: Sorted suffixes that one merging task gets, about.
MERGE_ROWS = 60_000

CUT = "prefix long, after binary, before binary, doc long, mark long, anchor_at int, start int, n int"


def _cut(kind: Kind):
    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, at = buffers(batch.column("text"))
        data = data.tobytes()
        (starts, offsets), (counts, _), (leads, _) = (lists(batch, c) for c in ("starts", "counts", "leads"))
        row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        base = at[row]
        place = starts + leads
        a, p = (base + starts).tolist(), (base + place).tolist()
        e = (base + starts + counts - 1 + kind.size).tolist()
        after = [data[i:j] for i, j in zip(p, e)]
        prefix = np.array([int.from_bytes(x[:8], "big") >> 1 for x in after], dtype=np.int64)
        columns = [prefix, after, [data[i:j] for i, j in zip(a, p)]]
        columns += [batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("doc", "mark")]
        columns += [x.astype(np.int32) for x in (place, starts, counts)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in CUT.split(", ")])

    return cut


def shared_prefixes(strings: list[bytes]) -> np.ndarray:
    """Length of the prefix that each string shares with the one before (0 for the first)."""
    out = np.zeros(len(strings), np.int32)
    step = 1 << 14
    for low in range(0, len(strings), step):
        part = strings[max(low - 1, 0) : low + step]
        size = np.fromiter(map(len, part), np.int64, len(part))
        width = int(size.max()) + 1
        table = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in part), np.uint8).reshape(-1, width)
        apart = table[1:] != table[:-1]
        apart[:, -1] = True
        found = np.minimum(apart.argmax(1), np.minimum(size[1:], size[:-1]))
        out[low + (low == 0) : low + step] = found
    return out


RUN = "shard int, run long, rank int, shared int, rest binary, before binary, doc long, mark long, anchor_at int, start int, n int"


def _sorted_runs(splits: np.ndarray):
    """Sort the suffixes of a task; each shard's share of them is a front-coded run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for piece, batch in enumerate(_joined(batches, 200_000)):
            after = batch.column("after").to_pylist()
            order = np.array(sorted(range(len(after)), key=after.__getitem__), dtype=np.int64)
            rows = batch.take(pa.array(order))
            after = [after[i] for i in order.tolist()]
            shard = np.searchsorted(splits, rows.column("prefix").to_numpy(), side="right").astype(np.int32)
            shared = shared_prefixes(after)
            head = np.ones(len(shard), bool)
            head[1:] = shard[1:] != shard[:-1]
            shared[head] = 0
            rest = [x[k:] for x, k in zip(after, shared.tolist())]
            n = len(after)
            columns = [shard, np.full(n, (number << 32) + piece, np.int64), np.arange(n, dtype=np.int32), shared]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns]
                + [pa.array(rest, pa.binary())]
                + [rows.column(c) for c in ("before", "doc", "mark", "anchor_at", "start", "n")],
                names=[x.split()[0] for x in RUN.split(", ")],
            )

    return run


def _joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _compare(a: bytes, b: bytes, known: int) -> tuple[bool, int]:
    """Whether a comes first (or is equal), and their shared length; the first ``known`` bytes are equal."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    if not x:
        return len(a) <= len(b), n
    at = n - (x.bit_length() + 7) // 8
    return a[at] < b[at], at


class LoserTree:
    """Merges front-coded sorted runs; yields (run, index in the run, length shared with the one before)."""

    def __init__(self, runs: list[tuple[list[int], list[bytes]]]):
        self.runs = runs
        self.n = max(1, len(runs))
        self.heads: list[bytes | None] = [r[1][0] if r[1] else None for r in runs]
        self.next = [0] * len(runs)
        self.loser = [-1] * self.n
        self.known = [0] * self.n  # of the loser at each node: length shared with the winner that went up
        self.champion, self.shared = self._build(1) if runs else (-1, 0)

    def _build(self, node: int) -> tuple[int, int]:
        if node >= self.n:
            return node - self.n, 0
        a, b = self._build(2 * node)[0], self._build(2 * node + 1)[0]
        a, _ = self._play(node, a, 0, b, 0)
        return a, 0

    def _play(self, node: int, a: int, known_a: int, b: int, known_b: int) -> tuple[int, int]:
        """Both lengths are shared with the last output. The longer one comes first; only a tie looks at characters."""
        x, y = self.heads[a], self.heads[b]
        if x is None or (y is not None and known_b > known_a):
            a, known_a, b, known_b = b, known_b, a, known_a
        elif y is not None and known_a == known_b:
            first, found = _compare(x, y, known_a)
            if first:
                known_b = found
            else:
                a, b, known_b = b, a, found
        self.loser[node], self.known[node] = b, known_b
        return a, known_a

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        while self.champion >= 0 and self.heads[self.champion] is not None:
            run = self.champion
            index = self.next[run]
            yield run, index, self.shared
            shared, rest = self.runs[run]
            index += 1
            self.next[run] = index
            if index < len(rest):
                known = shared[index]
                self.heads[run] = self.heads[run][:known] + rest[index]
            else:
                known, self.heads[run] = 0, None
            node, winner = (run + self.n) // 2, run
            while node:
                winner, known = self._play(node, winner, known, self.loser[node], self.known[node])
                node //= 2
            self.champion, self.shared = winner, known


def _ranks(*columns: np.ndarray) -> np.ndarray:
    """Dense ranks of rows in the order of the columns, first column first."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def resolve_shard(rows: pa.RecordBatch, kind: Kind) -> pa.RecordBatch:
    """Merge the runs of one shard and find the windows that an earlier place has."""
    run = rows.column("run").to_numpy()
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1, [len(run)])).tolist()
    shared, rest = rows.column("shared").to_pylist(), rows.column("rest").to_pylist()
    tree = LoserTree([(shared[a:b], rest[a:b]) for a, b in zip(cuts[:-1], cuts[1:])])
    merged_order = [(cuts[r] + i, k) for r, i, k in tree]
    order, after_shared = np.array(merged_order, dtype=np.int64).reshape(-1, 2).T
    n = len(order)
    before = [x[::-1] for x in rows.column("before").to_pylist()]
    turned = np.array(sorted(range(n), key=before.__getitem__), dtype=np.int64)
    before_shared = shared_prefixes([before[i] for i in turned.tolist()])
    doc, mark, place, start, count = (rows.column(c).to_numpy() for c in ("doc", "mark", "anchor_at", "start", "n"))
    age = _ranks(doc, mark, place)
    flags = np.zeros((n, kind.size - kind.gram + 1), bool)
    follows, precedes = np.empty(n, np.int64), np.empty(n, np.int64)
    for ahead in range(kind.size - kind.gram + 1):  # units of the window before its anchor
        offset = place - ahead - start  # of the window in its stretch
        mine = np.flatnonzero((offset >= 0) & (offset < count))
        if len(mine) < 2:
            continue
        follows[order] = np.cumsum(after_shared < kind.size - ahead)
        precedes[turned] = np.cumsum(before_shared < ahead)
        key = follows[mine] * (n + 1) + precedes[mine]
        turn = np.lexsort((age[mine], key))
        head = np.ones(len(turn), bool)
        head[1:] = key[turn][1:] != key[turn][:-1]
        oldest = age[mine][turn][np.maximum.accumulate(np.where(head, np.arange(len(turn)), 0))]
        late = mine[turn[age[mine][turn] > oldest]]
        flags[late, offset[late]] = True
    row, first, last = ranges_of(flags, start, kind.size)
    columns = [doc[row], mark[row], first.astype(np.int32), last.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "mark", "start", "end"])


def by_group(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Rows of each value of a sorted column as one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        value = batch.column(column).to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(value)) + 1, [len(value)]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and held[-1].column(column)[0].as_py() != int(value[a]):
                yield tables.whole(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield tables.whole(held)


def _resolve(kind: Kind):
    def resolve(stretches: DataFrame) -> DataFrame:
        n = stretches.count()
        shards = max(1, -(-n // MERGE_ROWS))
        at = [i / shards for i in range(1, shards)]
        found = stretches.select(F.percentile_approx("prefix", at, 10 * shards)).first()[0] if at and n else []
        splits = np.unique(np.array(found or [], dtype=np.int64))

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in by_group(batches, "shard"):
                yield resolve_shard(rows, kind)

        runs = stretches.mapInArrow(_sorted_runs(splits), RUN)
        dealt = runs.repartitionById(shards, "shard").sortWithinPartitions("shard", "run", "rank")
        return dealt.mapInArrow(merge, COVERED)

    return resolve


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, size: int = 100, gram: int = 24, with_text: bool = True) -> DataFrame:
    """Every row without the bytes of ``size``-byte strings that also start earlier in the table.

    ``kept`` has the bytes that remain (null unless ``with_text``). A string starts earlier in a document with a
    smaller id, or in the same document before. Strings are judged on the input, and never cross documents.
    """
    kind = Kind(words=False, size=size, gram=gram, within=True)

    def strip(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
        for doc, text, found in zip(batch.column("doc_id").to_pylist(), texts, spans):
            gone = merged(found)
            edges = [0, *(x for span in gone for x in span), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if gone else text
            n_removed = len(text) - len(kept)
            out.append((doc, len(text), n_removed, len(gone), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in REMOVED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    rows = keyed(docs)
    with tables.Staging(docs.sparkSession, "suffixes") as staging:
        spans = covered(rows, kind, staging, _cut(kind), CUT, _resolve(kind))
    return tables.map_slices(rows.join(spans, ["doc", "mark"], "left").select("doc_id", "text", "spans"), strip, REMOVED)


def op5_suffix_array(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(tables.table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def stage(spark, docs: DataFrame, sf_dir: str, size: int = 100) -> DataFrame:
    """Pipeline stage: texts without their repeated byte strings. A character that loses some of its bytes goes whole;
    a document of which nothing but white space remains goes, unless nothing was taken from it. ``n_chars`` is counted
    anew where something was taken; other columns stay as they are, null texts null."""
    tables.ship(spark)
    last = F.lit((1 << 63) - 1)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    kind = Kind(words=False, size=size, gram=24, within=True)
    with tables.Staging(spark, "suffixes") as staging:
        spans = covered(keyed(docs), kind, staging, _cut(kind), CUT, _resolve(kind))
    keys = docs.withColumns({"doc": F.coalesce("doc_id", last), "mark": F.xxhash64(F.col("text").cast("binary"))})

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text", "lang", "source", "n_chars"]
        for batch in tables.slices(batches):
            rows = batch.select([*names, "spans"]).to_pylist()
            out = []
            for row in rows:
                gone = merged(row.pop("spans"))
                if gone:
                    data = row["text"]
                    edges = [0, *(x for span in gone for x in span), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])).decode(errors="ignore")
                    if not kept.strip():
                        continue
                    row["text"], row["n_chars"] = kept.encode(), len(kept)
                out.append(tuple(row.values()))
            kinds = [batch.schema.field(c).type for c in names]
            columns = list(zip(*out)) if out else [()] * len(names)
            made = [pa.array(c, k).cast(pa.string()) if n == "text" else pa.array(c, k) for c, k, n in zip(columns, kinds, names)]
            yield pa.RecordBatch.from_arrays(made, names=names)

    joined = keys.join(spans, ["doc", "mark"], "left")
    joined = joined.select("doc_id", F.col("text").cast("binary").alias("text"), "lang", "source", "n_chars", "spans")
    return joined.mapInArrow(strip, docs.schema)
