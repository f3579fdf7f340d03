"""Byte-level BPE: texts are pre-tokenised in overlapping chunks side by side, stitched, and merged piece by piece.

A pre-token match depends on nothing before its start, so two readings of a text that share one boundary share all
later ones. A text of more than ``STEP`` characters becomes chunks of that many with ``OVERLAP`` more behind them, dealt
out over all tasks. Each is read from its own start; what touches its end is left undecided. Then the chunks of a text
stream by in order: the reading so far ends at a boundary, and goes on in the next chunk if that boundary is one of
the chunk's own. If not (a run of letters longer than the overlap), the text from the boundary on is read until it
meets a boundary of the chunk. Pieces are merged after that; pieces that a task has met lately are looked up, and new
ones are merged side by side, one merge of each per round. Decoding joins the bytes of the tokens.

Input cases: a null text has no tokens, like an empty one; repeated ids or rows are encoded one by one; a text that is
no valid UTF-8 gets replacement characters first; of equal merges the leftmost comes first; very long texts pass
through a task chunk by chunk, very long pieces are merged with a heap; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tables
from tidemark.llm.pieces import gather

#: Where the installed public vocabularies lie; every function takes another path.
RANKS_PATH = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the public pattern of the pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that a match of fixed length may look at.
REACH = 3
#: Characters of a chunk, and those that it shares with the next one.
STEP, OVERLAP = 16_384, 512
#: Pieces that a task keeps; beyond that it starts anew.
KEPT_PIECES = 400_000
#: Pieces of more bytes are merged one by one.
LONG_PIECE = 48
_NONE = np.int64(1) << 30


@dataclass
class Vocabulary:
    """Tokens, and the pairs of tokens that merge: ``key`` (left id and right id) with order and resulting id."""

    text: np.ndarray
    text_at: np.ndarray
    byte_id: np.ndarray
    key: np.ndarray
    order: np.ndarray
    merged: np.ndarray
    #: Pieces that are tokens as they stand, where the vocabulary takes those without merging.
    whole: dict[bytes, int]

    def __post_init__(self) -> None:
        self.decimal = [str(i).encode() for i in range(len(self.text_at) - 1)]
        self.pairs: dict[int, tuple[int, int]] | None = None

    def orders(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the merge of each pair (``_NONE`` if there is none) and its place in the table."""
        wanted = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return np.where(self.key[at] == wanted, self.order[at], _NONE), at


def _vocabulary(tokens: dict[bytes, int], pairs: Iterable[tuple[int, int, int, int]], whole: dict[bytes, int]) -> Vocabulary:
    """From tokens by bytes and (left, right, order, merged) rows."""
    size = max(tokens.values()) + 1
    by_id = [b""] * size
    for token, i in tokens.items():
        by_id[i] = token
    left, right, order, merged = (np.array(x, np.int64) for x in zip(*pairs))
    key = (left << 32) | right
    turn = np.argsort(key)
    return Vocabulary(
        np.frombuffer(b"".join(by_id), np.uint8),
        np.concatenate(([0], np.cumsum([len(t) for t in by_id]))),
        np.array([tokens[bytes([b])] for b in range(256)], np.int32),
        key[turn],
        order[turn],
        merged[turn].astype(np.int32),
        whole,
    )


def load_ranks(path: str = RANKS_PATH) -> Vocabulary:
    """A file of base64 tokens and ranks: any two tokens whose bytes together are a token merge, by its rank."""
    lines = Path(path).read_bytes().split()
    tokens = {base64.b64decode(t): int(r) for t, r in zip(lines[::2], lines[1::2])}
    pairs = [
        (tokens[t[:i]], tokens[t[i:]], rank, rank)
        for t, rank in tokens.items()
        for i in range(1, len(t))
        if t[:i] in tokens and t[i:] in tokens
    ]
    return _vocabulary(tokens, pairs, tokens)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabulary files: printable ones as they are, others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load_merges(path: str) -> Vocabulary:
    """A JSON file with a vocabulary and a list of merges, the first merge first."""
    model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
    letters = byte_letters()
    tokens = {bytes(letters[c] for c in word): i for word, i in model["vocab"].items()}
    vocab, pairs = model["vocab"], []
    for order, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs.append((vocab[left], vocab[right], order, vocab[left + right]))
    return _vocabulary(tokens, pairs, {})


# --- merging ------------------------------------------------------------------------------------


def solve(pieces: list[bytes], voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all pieces, one merge of each piece a round; flat ids and n+1 offsets."""
    length = np.fromiter(map(len, pieces), np.int64, len(pieces))
    token = voc.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
    lane = np.repeat(np.arange(len(pieces)), length)
    done: list[tuple[np.ndarray, np.ndarray]] = []

    def ranked(at: np.ndarray) -> np.ndarray:
        """Order of the merge of the tokens at ``at`` with the next ones of their pieces."""
        after = np.minimum(at + 1, len(token) - 1)
        order, _ = voc.orders(token[at], token[after])
        return np.where((at + 1 < len(token)) & (lane[after] == lane[at]), order, _NONE)

    order = ranked(np.arange(len(token))) if len(token) else np.zeros(0, np.int64)
    while len(token):
        starts = np.flatnonzero(np.concatenate(([True], lane[1:] != lane[:-1])))
        best = np.minimum.reduceat((order << 32) | np.arange(len(token)), starts)
        over = (best >> 32) >= _NONE
        if over.any():
            rest = np.repeat(~over, np.diff(np.append(starts, len(token))))
            done.append((lane[~rest], token[~rest]))
            shift = np.cumsum(~rest)
            best = best[~over]
            place = best & 0xFFFFFFFF
            at = place - shift[place]
            token, lane, order = token[rest], lane[rest], order[rest]
        else:
            at = best & 0xFFFFFFFF
        if not len(token):
            break
        _, row = voc.orders(token[at], token[at + 1])
        token[at] = voc.merged[row]
        keep = np.ones(len(token), bool)
        keep[at + 1] = False
        at = at - np.arange(len(at))  # each piece before has lost one token
        token, lane, order = token[keep], lane[keep], order[keep]
        order[at] = ranked(at)
        before = at[(at > 0) & (lane[np.maximum(at - 1, 0)] == lane[at])] - 1
        order[before] = ranked(before)
    if not done:
        return np.zeros(0, np.int32), np.zeros(len(pieces) + 1, np.int64)
    lanes, tokens = (np.concatenate(x) for x in zip(*done))
    turn = np.argsort(lanes, kind="stable")
    count = np.bincount(lanes, minlength=len(pieces))
    return tokens[turn], np.concatenate(([0], np.cumsum(count)))


def solve_alone(piece: bytes, voc: Vocabulary) -> list[int]:
    """Tokens of one piece, by a heap of merges over a linked list: n log n for n bytes."""
    if voc.pairs is None:
        rows = zip(voc.key.tolist(), voc.order.tolist(), voc.merged.tolist())
        voc.pairs = {key: (order, merged) for key, order, merged in rows}
    pairs, token = voc.pairs, voc.byte_id[np.frombuffer(piece, np.uint8)].tolist()
    n = len(token)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            found = pairs.get((token[i] << 32) | token[after[i]])
            if found:
                heapq.heappush(heap, (found[0], i, found[1], token[i], token[after[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, merged, left, right = heapq.heappop(heap)
        j = after[i] if token[i] == left else n
        if j >= n or token[j] != right:
            continue  # one of the two has been merged meanwhile
        token[i], token[j], after[i] = merged, -1, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        offer(before[i])
    return [t for t in token if t >= 0]


class Encoder:
    """Merges the pieces of one task and remembers them."""

    def __init__(self, voc: Vocabulary):
        self.voc = voc
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)

    def encode(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of texts given as lists of pieces, and the n+1 offsets of the texts."""
        if len(self.known) > KEPT_PIECES:
            self._clear()
        known = self.known
        new = list(dict.fromkeys(p for pieces in texts for p in pieces if p not in known))
        if new:
            data = [p.encode() for p in new]
            whole = [self.voc.whole.get(b) for b in data]
            short = [i for i, b in enumerate(data) if whole[i] is None and len(b) <= LONG_PIECE]
            long = [i for i, b in enumerate(data) if whole[i] is None and len(b) > LONG_PIECE]
            alike = [i for i, w in enumerate(whole) if w is not None]
            flat, at = solve([data[i] for i in short], self.voc)
            alone = [np.array(solve_alone(data[i], self.voc), np.int32) for i in long]
            flat = np.concatenate([flat, *alone, np.array([whole[i] for i in alike], np.int32)])
            sizes = np.concatenate([np.diff(at), [len(x) for x in alone], np.ones(len(alike))]).astype(np.int64)
            known.update(zip((new[i] for i in short + long + alike), range(len(known), len(known) + len(new))))
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
            self.flat = np.concatenate([self.flat, flat])
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        picks = np.fromiter((known[p] for pieces in texts for p in pieces), np.int64, int(n.sum()))
        flat, offsets = gather(self.flat, self.at, picks)
        return flat, offsets[np.concatenate(([0], np.cumsum(n)))]


def decode(flat: np.ndarray, offsets: np.ndarray, voc: Vocabulary) -> list[bytes]:
    """Bytes of the id runs that ``offsets`` bound."""
    data, at = gather(voc.text, voc.text_at, flat)
    data, at = data.tobytes(), at[offsets].tolist()
    return [data[a:b] for a, b in zip(at[:-1], at[1:])]


# --- pre-tokens ---------------------------------------------------------------------------------

_pattern = regex.compile(PATTERN)


def settled(text: str, last: bool) -> list[str]:
    """Pre-tokens of a chunk from its first character on; unless it is the last, only those that its end cannot change."""
    found = _pattern.findall(text)
    if last:
        return found
    end = len(text)
    while found and (end == len(text) or end - len(found[-1]) > len(text) - REACH):
        end -= len(found.pop())
        if end <= len(text) - REACH:
            break
    return found


class Stitcher:
    """Pre-tokens of one text, from its chunks in order."""

    def __init__(self) -> None:
        self.place = self.end = 0  # the reading so far ends at ``place``; the text is known up to ``end``
        self.rest: list[str] = []  # the text between the two

    def feed(self, start: int, text: str, lengths: list[int], last: bool) -> list[str]:
        """The pre-tokens that a chunk settles; it starts at ``start`` and was read as pieces of ``lengths``."""
        bounds = np.concatenate(([start], start + np.cumsum(np.array(lengths, np.int64)))).astype(np.int64)
        out: list[str] = []
        at = int(np.searchsorted(bounds, self.place))
        if at == len(bounds) or bounds[at] != self.place:
            self.rest.append(text[self.end - start :])
            self.end = start + len(text)
            if len(lengths) == 0 and not last:
                return out  # one run from end to end: nothing can end in here
            own, pending, done = set(bounds.tolist()), "".join(self.rest), 0
            at = len(bounds)
            for match in _pattern.finditer(pending):
                undecided = match.end() == len(pending) or match.start() > len(pending) - REACH
                if undecided and not last:
                    break
                out.append(match.group())
                done = match.end()
                if self.place + done in own:
                    at = int(np.searchsorted(bounds, self.place + done))
                    break
            self.place += done
            self.rest = [pending[done:]]
            if at == len(bounds):
                return out
        cuts = (bounds[at:] - start).tolist()
        out += [text[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        self.place, self.end = int(bounds[-1]), start + len(text)
        self.rest = [text[cuts[-1] :]]
        return out


# --- Spark --------------------------------------------------------------------------------------

ENCODED = "doc_id long, token_ids array<int>"
_CHUNKS = "row long, doc_id long, start long, last boolean, chunk string"
_READ = _CHUNKS + ", lengths array<int>"


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, pa.int32()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _CHUNKS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    for batch in batches:
        for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text"))):
            whole = text.as_py().decode("utf-8", "replace")
            for first in range(0, len(whole), STEP * 64):
                starts = range(first, min(first + STEP * 64, len(whole)), STEP)
                columns = [
                    [row.as_py()] * len(starts),
                    [doc_id.as_py()] * len(starts),
                    list(starts),
                    [s + STEP >= len(whole) for s in starts],
                    [whole[s : s + STEP + OVERLAP] for s in starts],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("chunk").to_pylist(), batch.column("last").to_pylist())
        lengths = [[len(p) for p in settled(text, last)] for text, last in pairs]
        yield batch.append_column("lengths", pa.array(lengths, pa.list_(pa.int32())))


def chunked_pieces(docs: DataFrame) -> DataFrame:
    """Chunks of texts with the lengths of their pre-tokens, each chunk read by itself; ``docs`` has a ``row`` column."""
    chunks = docs.select("row", "doc_id", "text").mapInArrow(_cut, _CHUNKS)
    return chunks.repartition("row", "start").mapInArrow(_read, _READ)


def encode_documents(docs: DataFrame, path: str = RANKS_PATH) -> DataFrame:
    """Token ids of every whole text, by the ranks of the file at ``path``."""
    voc = docs.sparkSession.sparkContext.broadcast(load_ranks(path))  # grows with the vocabulary file only
    rows = tables.text_rows(docs).withColumn("row", F.monotonically_increasing_id())
    long = F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))) > STEP

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(voc.value)
        for batch in tables.slices(batches):
            texts = [settled((t or b"").decode("utf-8", "replace"), True) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _lists(*encoder.encode(texts))], names=["doc_id", "token_ids"]
            )

    def stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(voc.value)
        columns = ("row", "doc_id", "start", "last", "chunk", "lengths")

        def chunks() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in columns))

        for _, group in groupby(chunks(), itemgetter(0)):
            stitcher, found, doc_id = Stitcher(), [], None
            for _, doc_id, start, last, text, lengths in group:
                found.append(encoder.encode([stitcher.feed(start, text, lengths, last)])[0])
            flat = np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id], pa.int64()), _lists(flat, np.array([0, len(flat)]))], names=["doc_id", "token_ids"]
            )

    short = rows.filter(~long).select("doc_id", "text").mapInArrow(single, ENCODED)
    ordered = chunked_pieces(rows.filter(long)).repartition("row").sortWithinPartitions("row", "start")
    return short.unionByName(ordered.mapInArrow(stitched, ENCODED))


def decode_documents(encoded: DataFrame, path: str = RANKS_PATH) -> DataFrame:
    """``encoded`` with the bytes that its ``token_ids`` stand for as ``decoded``."""
    voc = encoded.sparkSession.sparkContext.broadcast(load_ranks(path))  # grows with the vocabulary file only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _bounded(batch):
                lists = part.column("token_ids")
                offsets = lists.offsets.to_numpy().astype(np.int64)
                flat = lists.flatten().to_numpy()
                back = decode(flat, offsets - offsets[0], voc.value)
                yield part.append_column("decoded", pa.array(back, pa.binary()))

    return encoded.mapInArrow(run, ENCODED + ", decoded binary")


def _bounded(batch: pa.RecordBatch, tokens: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about so many tokens."""
    counts = np.cumsum(batch.column("token_ids").value_lengths().to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = counts[start - 1] if start else 0
        end = max(int(np.searchsorted(counts, before + tokens, side="right")), start + 1)
        yield batch.slice(start, end - start)
        start = end


def op11_byte_bpe(spark, sf_dir: str) -> DataFrame:
    found = decode_documents(encode_documents(tables.table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
