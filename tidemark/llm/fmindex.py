"""Removal of repeated word windows with compressed FM-indexes.

Each shard holds the distinct stretches of a range of anchors (see ``repeats``) and indexes their words: suffixes sorted
to the depth of a window, the Burrows-Wheeler transform in a wavelet matrix of packed bits. Documents' stretches are
streamed against the index from right to left by backward search, all side by side. That gives, for each place, how long
a match starts there and the range of its suffixes; where the match reaches the window size, the window's class is read
off the range, and with it the smallest document that has the window.

Input cases: a null text has no words; a text with fewer words than a window loses nothing; rows with the same id and
text are one document, each row with the same result; rows with one id and different texts never remove from each other;
a null id is larger than all others; an empty table gives an empty result. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import tables
from tidemark.llm.repeats import COVERED, Kind, covered, keyed, lists, merged, ranges_of, units

#: Words of one index, about; an anchor's stretches are never parted.
SHARD_WORDS = 1 << 19


class Bits:
    """Packed bits with counts of ones before each word of 64."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        self.word = np.packbits(np.pad(bits, (0, 64 - self.n % 64)), bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.word), dtype=np.int32)))
        self.zeros = int(self.n - self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.word[word] & mask)


class WaveletMatrix:
    """Rank of any symbol in a sequence of small integers, one bit level after the other."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.width = max(1, int(symbols - 1).bit_length())
        self.levels: list[Bits] = []
        for level in range(self.width - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            self.levels.append(Bits(bit))
            values = np.concatenate([values[~bit], values[bit]])
        self.first = np.zeros(symbols, np.int64)
        if len(values):
            head = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
            self.first[values[head]] = head

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is among the first ``at`` values."""
        for i, bits in enumerate(self.levels):
            one = bits.ones(at)
            at = np.where(symbol >> (self.width - 1 - i) & 1, bits.zeros + one, at - one)
        return at - self.first[symbol]


class FMIndex:
    """Index of texts of integer codes (64-bit hashes); patterns are found up to ``depth`` units exactly."""

    def __init__(self, texts: list[np.ndarray], depth: int):
        self.depth = depth
        joined = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
        self.codes = np.unique(joined)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(size + 1) - 1
        text = np.zeros(len(joined) + len(texts), np.int64)  # a zero ends each text
        spot = np.ones(len(text), bool)
        spot[ends] = False
        text[spot] = np.searchsorted(self.codes, joined) + 1
        self.text_of = np.repeat(np.arange(len(texts)), size + 1)
        self.offset = np.arange(len(text)) - np.repeat(ends - size, size + 1)
        rank, half = text, text
        have, n = 1, len(text)
        order = np.argsort(rank, kind="stable")
        while have < depth:
            half = rank
            ahead = np.concatenate([rank[have:], np.zeros(min(have, n), np.int64)])[:n]
            key = rank * (n + len(self.codes) + 2) + ahead
            order = np.argsort(key, kind="stable")
            new = np.concatenate(([0], np.diff(key[order]) != 0)) if n else np.zeros(0, np.int64)
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) + 1
            have *= 2
        self.suffix = order
        # Neighbours that share ``depth`` units: equal halves (a power of two) from their start and before their end.
        span = have // 2 if have > 1 else 1
        late = np.concatenate([half[depth - span :], np.zeros(min(depth - span, n), np.int64)])[:n]
        apart = (half[order][1:] != half[order][:-1]) | (late[order][1:] != late[order][:-1])
        self.group = np.concatenate(([0], np.cumsum(apart))) if n else np.zeros(0, np.int64)
        self.group_start = np.concatenate(([0], np.flatnonzero(apart) + 1, [n]))
        symbols = len(self.codes) + 1
        self.bwt = WaveletMatrix(text[order - 1], symbols)
        self.start = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of codes; -1 for one that is not in the index."""
        if not len(self.codes):
            return np.full(len(codes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at + 1, -1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the patterns with one more symbol in front."""
        known = symbol > 0
        safe = np.where(known, symbol, 0)
        base = self.start[safe]
        fresh = base + self.bwt.rank(safe, low), base + self.bwt.rank(safe, high)
        return np.where(known, fresh[0], 0), np.where(known, fresh[1], 0)

    def find(self, pattern: np.ndarray) -> tuple[int, int]:
        """Suffix range of one pattern of symbols."""
        low, high = np.array([0]), np.array([len(self.suffix)])
        for symbol in pattern[::-1]:
            low, high = self.extend(np.array([symbol]), low, high)
            if high[0] <= low[0]:
                return 0, 0
        return int(low[0]), int(high[0])

    def longest(self, symbols: np.ndarray) -> tuple[int, int, int]:
        """Longest start of ``symbols`` (up to ``depth``) that occurs: its length and suffix range, by bisection."""
        good, bad, found = 0, min(len(symbols), self.depth) + 1, (0, len(self.suffix))
        while bad - good > 1:
            middle = (good + bad) // 2
            low, high = self.find(symbols[:middle])
            if high > low:
                good, found = middle, (low, high)
            else:
                bad = middle
        return good, *found

    def matches(self, streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of all streams, joined: length of the match that starts at each place (not told apart
        beyond ``depth``) and the first of its suffixes.

        A match grows by a unit in front at each step; one longer than ``depth`` is cut at its end, by going from its
        range to that of all suffixes with the same ``depth`` units. When a match cannot grow, the longest one at that
        place is sought anew.
        """
        size = np.fromiter(map(len, streams), np.int64, len(streams))
        begin = np.cumsum(size) - size
        joined = self.symbols(np.concatenate(streams) if streams else np.zeros(0, np.uint64))
        length, first = np.zeros(len(joined), np.int64), np.zeros(len(joined), np.int64)
        turn = np.argsort(-size, kind="stable")
        size, begin = size[turn], begin[turn]
        low, high = np.zeros(len(size), np.int64), np.full(len(size), len(self.suffix))
        run = np.zeros(len(size), np.int64)
        for step in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -step, side="left"))
            place = begin[:live] + size[:live] - 1 - step
            new_low, new_high = self.extend(joined[place], low[:live], high[:live])
            run[:live] += 1
            for lane in np.flatnonzero(new_high <= new_low):
                stop = place[lane] + run[lane] - 1
                run[lane], new_low[lane], new_high[lane] = self.longest(joined[place[lane] : stop])
            long = np.flatnonzero(run[:live] > self.depth)
            kin = self.group[new_low[long]]
            new_low[long], new_high[long] = self.group_start[kin], self.group_start[kin + 1]
            run[long] = self.depth
            low[:live], high[:live] = new_low, new_high
            length[place], first[place] = run[:live], new_low
        return length, first


def repeated_windows(stretches: list[np.ndarray], docs: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """Table (stretch by window) of the windows that a stretch of a smaller document has too."""
    index = FMIndex(stretches, size)
    window = index.offset[index.suffix] < count[index.text_of[index.suffix]]  # suffixes that start a whole window
    smallest = np.full(int(index.group[-1]) + 1 if len(index.group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(smallest, index.group[window], docs[index.text_of[index.suffix[window]]])
    length, first = index.matches(stretches)
    sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
    row = np.repeat(np.arange(len(stretches)), sizes)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hit = np.flatnonzero(length >= size)
    hit = hit[smallest[index.group[first[hit]]] < docs[row[hit]]]
    flags = np.zeros((len(stretches), int(count.max()) if len(count) else 0), bool)
    flags[row[hit], offset[hit]] = True
    return flags


CUT = "anchor long, words binary, doc long, mark long, start int, n int"


def _cut(kind: Kind):
    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        code, at = units(batch.column("text"), kind)
        (starts, offsets), (counts, _), (anchors, _) = (lists(batch, c) for c in ("starts", "counts", "anchors"))
        row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        begin = at[row] + starts
        words = [code[a:b].tobytes() for a, b in zip(begin.tolist(), (begin + counts - 1 + kind.size).tolist())]
        columns = [anchors, words, *(batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("doc", "mark"))]
        columns += [starts.astype(np.int32), counts.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in CUT.split(", ")])

    return cut


def _shards(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of anchor, cut between anchors once there are about so many words."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor = batch.column("anchor").to_numpy()
        bound = np.append(np.flatnonzero(np.diff(anchor)) + 1, len(anchor))
        weight = np.cumsum([len(x) // 8 for x in batch.column("words").to_pylist()])
        start = 0
        if held and held[-1].column("anchor")[-1].as_py() != int(anchor[0]) and size >= words:
            yield tables.whole(held)
            held, size = [], 0
        for end in bound[:-1].tolist():
            if size + weight[end - 1] - (weight[start - 1] if start else 0) >= words:
                held.append(batch.slice(start, end - start))
                yield tables.whole(held)
                held, size, start = [], 0, end
        held.append(batch.slice(start))
        size += int(weight[-1] - (weight[start - 1] if start else 0))
    if held:
        yield tables.whole(held)


def _resolve(kind: Kind):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _shards(batches, SHARD_WORDS):
            stretches = [np.frombuffer(x, np.uint64) for x in rows.column("words").to_pylist()]
            doc, mark, start, count = (rows.column(c).to_numpy() for c in ("doc", "mark", "start", "n"))
            flags = repeated_windows(stretches, doc, count, kind.size)
            row, first, last = ranges_of(flags, start, kind.size)
            columns = [doc[row], mark[row], first.astype(np.int32), last.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "mark", "start", "end"])

    def resolve(stretches: DataFrame) -> DataFrame:
        return stretches.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(search, COVERED)

    return resolve


REMOVED = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, size: int = 50, gram: int = 8, with_text: bool = True) -> DataFrame:
    """Every row without the words of ``size``-word windows that a document with a smaller id has too.

    ``kept`` has the words that remain, joined by a space (null unless ``with_text``).
    """
    kind = Kind(words=True, size=size, gram=gram, within=False)

    def strip(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
        for doc, text, found in zip(batch.column("doc_id").to_pylist(), texts, spans):
            words, gone = text.split(), merged(found)
            edges = [0, *(x for span in gone for x in span), len(words)]
            left = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]] if gone else words
            kept = b" ".join(left)
            digest = hashlib.sha256(kept).hexdigest()
            out.append((doc, len(words), len(words) - len(left), len(gone), digest, kept if with_text else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in REMOVED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    rows = keyed(docs)
    with tables.Staging(docs.sparkSession, "fmindex") as staging:
        spans = covered(rows, kind, staging, _cut(kind), CUT, _resolve(kind))
    return tables.map_slices(rows.join(spans, ["doc", "mark"], "left").select("doc_id", "text", "spans"), strip, REMOVED)


def op2_fm_index(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(tables.table(spark, sf_dir, "documents"), with_text=False).drop("kept")
