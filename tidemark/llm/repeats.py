"""Finding windows (runs of ``size`` units) that occur elsewhere in a corpus: the part that both operators share.

Units are bytes or words. Every window is known by an anchor: the run of ``gram`` units in it with the smallest hash,
where runs that are common in the corpus come after all others. So a line that a third of all documents have is the
anchor only of windows that are common throughout, and those are few different ones; windows that hold a bit of it have
anchors of their own. Which runs are common is told by a bounded sample; any set of them gives the same result.

Equal windows have equal anchors at equal places, so they can only be found among the occurrences of one anchor.
Consecutive windows with the same anchor make a stretch, and one row per stretch is shuffled by anchor: anchors seen
once drop out there, equal stretches fall together into the first of them, and what remains are the distinct stretches
of anchors seen again. Their text is fetched and handed to the operator (``resolve``), which says which of their windows
occur earlier. Rows of one anchor stream through a task in order; none is held.

A document is a row; rows with the same id and text count as one document. A null id counts as the largest id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays, tables
from tidemark.llm.tables import Staging

_LARGEST = (1 << 63) - 1
#: Bits of a 64-bit word that hold the place of a run within a piece; the rest is the hash that orders anchors.
_PLACE_BITS = np.uint64(28)


@dataclass(frozen=True)
class Kind:
    """What units are and how long windows and anchors are. ``within`` tells whether a document may repeat itself."""

    words: bool
    size: int
    gram: int
    within: bool


#: Documents, about, in which common runs are looked for.
SAMPLE_DOCUMENTS = 4096
#: Share of all places from which on a run is common; there can be no more of them than one by this.
COMMON_SHARE = 1.0 / (1 << 18)


class Common:
    """A set of hashes; most that are not in it are told by a table of leading bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.table = np.zeros(1 << 22, bool)
        self.table[self.hashes >> np.uint64(42)] = True

    def __call__(self, values: np.ndarray) -> np.ndarray:
        out = self.table[values >> np.uint64(42)]
        maybe = np.flatnonzero(out)
        if len(maybe):
            at = np.minimum(np.searchsorted(self.hashes, values[maybe]), len(self.hashes) - 1)
            out[maybe] = self.hashes[at] == values[maybe]
        return out


def common_runs(rows: DataFrame, kind: Kind) -> Common:
    """Runs that are common in a sample; only such as repeat within a slice of text are counted."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        code, _ = units(batch.column("text"), kind)
        gram, n = np.unique(arrays.rolling(code, kind.gram).view(np.int64), return_counts=True)
        keep = n > 1
        hashes = pa.array([*gram[keep].tolist(), None], pa.int64())
        return pa.RecordBatch.from_arrays([hashes, pa.array(np.append(n[keep], len(code)))], names=["gram", "n"])

    part = min(1.0, SAMPLE_DOCUMENTS / max(rows.count(), 1))
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "doc"), F.lit(1 << 20)) < F.lit(int(part * (1 << 20)))
    counts = tables.map_slices(rows.filter(drawn).select("text"), count, "gram long, n long")
    counts = counts.groupBy("gram").agg(F.sum("n").alias("n"))
    total = counts.filter("gram IS NULL").select("n").first()
    least = max(4, int((total["n"] if total else 0) * COMMON_SHARE))
    found = counts.filter(F.col("gram").isNotNull() & (F.col("n") >= least)).select("gram").toArrow()
    return Common(found.column("gram").to_numpy().view(np.uint64) if found.num_rows else np.zeros(0, np.uint64))


def units(column: pa.Array, kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of the units of all texts, and the n+1 offsets of the texts."""
    if kind.words:
        found = arrays.words(column)
        return found.hashes(), found.first
    data, at = arrays.buffers(column)
    return arrays._BYTE_CODE[data], at


def _anchors(rank: np.ndarray, choices: int) -> np.ndarray:
    """Place of the least of each ``choices`` ranks in turn, the first of equal ones. More ranks than the place has
    bits for are walked in pieces that overlap by a window less one."""
    most = 1 << int(_PLACE_BITS)
    mask = np.uint64(most - 1)
    found = []
    for begin in range(0, len(rank) - choices + 1, most - choices + 1):
        piece = rank[begin : begin + most]
        place = np.arange(len(piece), dtype=np.uint64)
        least = arrays.sliding(piece >> _PLACE_BITS << _PLACE_BITS | place, choices, np.minimum)
        found.append((least & mask).astype(np.int64) + begin)
    return found[0] if len(found) == 1 else np.concatenate(found)


STRETCHES = "anchor long, content long, doc long, mark long, start int, n int, lead int, state int"
#: States of a stretch: nothing known; equal ones were seen beside it; an earlier equal one is known.
_ALONE, _FIRST, _COPIED = 0, 1, 2


def _later(rows: tuple, origin: tuple, kind: Kind) -> np.ndarray:
    """Whether stretches, as (doc, mark, start), count as repeats of equal ones at ``origin``."""
    later = rows[0] > origin[0]
    if kind.within:
        later |= (rows[0] == origin[0]) & ((rows[1] > origin[1]) | ((rows[1] == origin[1]) & (rows[2] > origin[2])))
    return later


def _stretches(batch: pa.RecordBatch, kind: Kind, common: Common) -> pa.RecordBatch | None:
    """Stretches of windows with one anchor: ``start`` of the first window, ``n`` windows, ``lead`` units before the
    anchor, and a hash of all their units and the place of the anchor."""
    code, at = units(batch.column("text"), kind)
    choices = kind.size - kind.gram + 1
    gram = arrays.rolling(code, kind.gram)
    if len(gram) < choices:
        return None
    rank = gram >> np.uint64(1) | common(gram).astype(np.uint64) << np.uint64(63)
    anchor = _anchors(rank, choices)
    window = np.arange(len(anchor))
    doc = np.searchsorted(at, window, side="right") - 1
    whole = window + kind.size <= at[doc + 1]
    window, anchor, doc = window[whole], anchor[whole], doc[whole]
    if not len(window):
        return None
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(window)))
    start, anchor, doc = window[first], anchor[first], doc[first]
    lead = anchor - start
    content = arrays.Segments(code).hash(start, start + n - 1 + kind.size) ^ arrays.mix(lead.astype(np.uint64))
    where = start - at[doc]
    key, mark = (batch.column(c).to_numpy(zero_copy_only=False)[doc] for c in ("doc", "mark"))
    # Equal stretches meet here first: all but the earliest are settled, and are dealt out by where they stand, so a
    # line that very many documents have sends one row for each slice of text to its anchor's task.
    turn = np.lexsort((where, mark, key, content))
    head = np.ones(len(turn), bool)
    head[1:] = content[turn][1:] != content[turn][:-1]
    origin = np.empty(len(turn), np.int64)
    origin[turn] = turn[np.maximum.accumulate(np.where(head, np.arange(len(turn)), 0))]
    copied = _later((key, mark, where), (key[origin], mark[origin], where[origin]), kind)
    state = np.where(copied, _COPIED, _ALONE)
    state[origin[copied]] = _FIRST
    route = np.where(copied, arrays.mix((key + where).astype(np.uint64)), gram[anchor])
    columns = [route.view(np.int64), content.view(np.int64), key, mark]
    columns += [x.astype(np.int32) for x in (where, n, lead, state)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in STRETCHES.split(", ")])


FINDINGS = "anchor long, doc long, mark long, start int, n int, lead int, copied boolean"


def _repeated(batches: Iterator[pa.RecordBatch], kind: Kind) -> Iterator[pa.RecordBatch]:
    """From stretches in order of (anchor, content, doc, mark, start): those whose anchor comes more than once.

    ``copied`` ones have content that an earlier stretch has; those that are known to be pass through. The last row waits for the next batch, which may go on
    with its anchor; besides it only the first stretch of its content is kept.
    """
    held: np.ndarray | None = None  # the row that waits
    first: np.ndarray | None = None  # first stretch with its content
    joined = False  # whether its anchor came before

    def judged(rows: np.ndarray, following: np.ndarray | None) -> pa.RecordBatch:
        nonlocal first, joined
        same = np.zeros(rows.shape[1] + 1, bool)  # whether a row has the anchor of the row before
        same[1:-1] = rows[0, 1:] == rows[0, :-1]
        same[0] = joined
        same[-1] = following is not None and following[0] == rows[0, -1]
        shared = same[:-1] | same[1:] | (rows[7] == _FIRST)
        lead_row = np.ones(rows.shape[1], bool)
        lead_row[1:] = ~same[1:-1] | (rows[1, 1:] != rows[1, :-1])
        lead_row[0] = first is None or not joined or first[1] != rows[1, 0]
        source = np.maximum.accumulate(np.where(lead_row, np.arange(rows.shape[1]), -1))
        origin = rows[:, np.maximum(source, 0)]
        if source[0] < 0:
            origin[:, source < 0] = first[:, None]
        later = _later(rows[2:5], origin[2:5], kind)
        first, joined = origin[:, -1].copy(), bool(same[-1])
        return found(rows[:, shared], later[shared])

    def found(out: np.ndarray, copied: np.ndarray) -> pa.RecordBatch:
        columns = [out[0], out[2], out[3], *(out[i].astype(np.int32) for i in (4, 5, 6)), copied]
        names = [x.split()[0] for x in FINDINGS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(8)])
        settled = rows[7] == _COPIED
        if settled.any():
            yield found(rows[:, settled], np.ones(int(settled.sum()), bool))
            rows = rows[:, ~settled]
            if not rows.shape[1]:
                continue
        if held is not None:
            rows = np.concatenate([held, rows], axis=1)
        if rows.shape[1] > 1:
            yield judged(rows[:, :-1], rows[:, -1])
        held = rows[:, -1:].copy()
    if held is not None:
        yield judged(held, None)


def keyed(docs: DataFrame) -> DataFrame:
    """``doc`` (a null id as the largest), ``mark`` (hash of the text), ``text`` as bytes, and the id itself."""
    rows = tables.text_rows(docs)
    return rows.select(
        F.coalesce("doc_id", F.lit(_LARGEST)).alias("doc"),
        F.xxhash64("text").alias("mark"),
        F.coalesce("text", F.lit("").cast("binary")).alias("text"),
        "doc_id",
    )


COVERED = "doc long, mark long, start int, end int"


def covered(
    rows: DataFrame,
    kind: Kind,
    staging: Staging,
    cut: Callable[[pa.RecordBatch], pa.RecordBatch],
    cut_schema: str,
    resolve: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Per document, the unit ranges (``spans``, array of start and end) of windows that occur earlier.

    ``cut`` turns documents with their stretches (lists ``starts``, ``counts``, ``leads``, ``anchors``) into the rows
    that ``resolve`` works on; ``resolve`` returns ranges like ``COVERED``.
    """
    common = rows.sparkSession.sparkContext.broadcast(common_runs(rows, kind))  # some megabytes at most
    texts = rows.select("doc", "mark", "text")
    found = tables.map_slices(texts, lambda b: _stretches(b, kind, common.value), STRETCHES)
    ordered = found.repartition("anchor").sortWithinPartitions("anchor", "content", "doc", "mark", "start")
    findings = staging.put(ordered.mapInArrow(lambda b: _repeated(b, kind), FINDINGS), "findings")
    wanted = (
        findings.filter("not copied")
        .groupBy("doc", "mark")
        .agg(F.sort_array(F.collect_list(F.struct("start", "n", "lead", "anchor"))).alias("found"))
        .select(
            "doc",
            "mark",
            F.col("found.start").alias("starts"),
            F.col("found.n").alias("counts"),
            F.col("found.lead").alias("leads"),
            F.col("found.anchor").alias("anchors"),
        )
    )
    texts = texts.join(wanted, ["doc", "mark"])
    texts = staging.put(tables.map_slices(texts, cut, cut_schema), "stretches")
    solved = staging.put(resolve(texts), "solved")
    copied = findings.filter("copied").select("doc", "mark", "start", (F.col("start") + F.col("n") - 1 + kind.size).alias("end"))
    spans = F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")
    found = staging.put(copied.unionByName(solved).groupBy("doc", "mark").agg(spans), "spans", keep=True)
    return found


def lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, joined, and the n+1 offsets."""
    column = batch.column(name)
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted ranges, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for span in spans or ():
        a, b = span["start"], span["end"]
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def ranges_of(flags: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From a table of windows (row by offset from ``start``): row, start and end of each run of flagged windows."""
    padded = np.zeros((flags.shape[0], flags.shape[1] + 2), bool)
    padded[:, 1:-1] = flags
    row, first = np.nonzero(padded[:, 1:] & ~padded[:, :-1])
    _, last = np.nonzero(~padded[:, 1:] & padded[:, :-1])
    return row, start[row] + first, start[row] + last - 1 + size
