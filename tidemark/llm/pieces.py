"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

Spaces are written as the vocabulary's whitespace marker, with one in front of each text; a character that no path of
pieces covers falls back to byte pieces. Decoding turns markers into spaces, byte pieces into bytes, and takes the
space in front away, so a text always comes back as it was (a marker character inside a text travels as bytes).

No piece holds a marker after another character, so the best path of a text is made of the best paths of its
segments (spaces, then what follows); that is checked when a vocabulary is loaded, and a vocabulary that breaks it is
applied to unbroken texts. Segments that a task has met lately are looked up, new ones are solved side by side.

Input cases: a null text has no pieces, like an empty one; repeated ids or rows are encoded one by one; very long
texts and segments are encoded whole; of paths with equal scores the one whose last piece is longest is taken, again
from the end to the front; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import tables

#: Where the installed public vocabulary lies; every function takes another path.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Segments that a task keeps; beyond that it starts anew.
KEPT_SEGMENTS = 400_000
#: Segments of more bytes are solved one by one.
LONG_SEGMENT = 512
#: Added to the lowest score for a character without a piece.
UNKNOWN_PENALTY = 10.0

# Piece types of the model file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_MARKER = "▁".encode()


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at : at + size]
            at += size
        yield tag >> 3, value


@dataclass
class Vocabulary:
    """Double-array trie (``base``, ``check``, ``piece`` by state), scores, and the bytes of each piece."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    unknown: float
    byte_piece: np.ndarray
    kind: np.ndarray
    text: np.ndarray
    text_at: np.ndarray
    breaks: bool
    newline_alone: bool


def double_array(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trie of sorted distinct ``words``: child ``c`` of state s is t = base[s] + c + 1 if check[t] is s.

    ``piece[t]`` is the index of the word that ends in t, or -1.
    """
    size = 1 << 16
    base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = 0
    free = 1
    tried = np.ones(258, np.int64)  # by number of children: places before this one are hardly worth a look
    queue = [(0, 0, len(words), 0)]
    while queue:
        following = []
        for state, low, high, depth in queue:
            if len(words[low]) == depth:
                piece[state] = low
                low += 1
            children = []
            while low < high:
                symbol, start = words[low][depth], low
                while low < high and words[low][depth] == symbol:
                    low += 1
                children.append((symbol, start, low))
            if not children:
                continue
            offsets = np.array([c[0] for c in children]) + 1
            while check[free] >= 0:
                free += 1
            look, low = 64, max(free, int(tried[len(offsets)]))
            while True:  # the first base whose places for all children are free, among ever more places
                while low + look + 600 >= len(check):
                    grown = np.full(len(check), -1, np.int32)
                    base = np.concatenate([base, np.zeros(len(base), np.int32)])
                    piece, check = np.concatenate([piece, grown]), np.concatenate([check, grown])
                bases = low + np.flatnonzero(check[low : low + look] < 0) - int(offsets[0])
                bases = bases[bases >= 0]
                fits = np.flatnonzero((check[bases[:, None] + offsets] < 0).all(1))
                if len(fits):
                    at = int(bases[fits[0]])
                    break
                low, look = low + look, 2 * look
            tried[len(offsets)] = at + int(offsets[0])
            base[state] = at
            check[at + offsets] = state
            following += [(at + symbol + 1, a, b, depth + 1) for symbol, a, b in children]
        queue = following
    last = int(np.flatnonzero(check >= 0)[-1]) + 512
    return base[:last], check[:last], piece[:last]


def load(path: str = MODEL_PATH) -> Vocabulary:
    """Read a SentencePiece model file (on the driver; tasks get the arrays)."""
    found = []
    for number, value in _fields(Path(path).read_bytes()):
        if number == 1:
            parts = dict(_fields(value))
            score = struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0
            found.append((parts.get(1, b""), score, parts.get(3, NORMAL)))
    texts = [x[0] for x in found]
    kind = np.array([x[2] for x in found], np.int8)
    score = np.array([x[1] for x in found], np.float64)
    byte_piece = np.full(256, int(np.flatnonzero(kind == UNKNOWN)[0]), np.int32)
    shown = []
    for i, text in enumerate(texts):
        if kind[i] == BYTE:
            byte_piece[int(text[3:5], 16)] = i
            shown.append(bytes([int(text[3:5], 16)]))
        elif kind[i] == CONTROL:
            shown.append(b"")
        else:
            shown.append(text.replace(_MARKER, b" "))
    usable = sorted((shown[i], i) for i in range(len(texts)) if kind[i] in (NORMAL, USER_DEFINED) and shown[i])
    base, check, piece = double_array([x[0] for x in usable])
    ids = np.array([x[1] for x in usable] + [-1], np.int32)
    words = [x[0] for x in usable]
    return Vocabulary(
        base,
        check,
        ids[piece],
        score,
        float(score[kind == NORMAL].min() - UNKNOWN_PENALTY),
        byte_piece,
        kind,
        np.frombuffer(b"".join(shown), np.uint8),
        np.concatenate(([0], np.cumsum([len(x) for x in shown]))),
        not any(re.search(rb"[^ ] ", x) for x in words),
        not any(b"\n" in x for x in words),
    )


_WIDTH = np.ones(256, np.int64)
_WIDTH[0xC0:0xE0], _WIDTH[0xE0:0xF0], _WIDTH[0xF0:] = 2, 3, 4


def solve_alone(segment: bytes, voc: Vocabulary) -> list[int]:
    """Pieces of one long segment; the same steps as ``solve`` takes, for one text."""
    base, check, piece, score = (x.tolist() for x in (voc.base, voc.check, voc.piece, voc.score))
    n = len(segment)
    best, came, used = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    for place in range(n):
        if best[place] == float("-inf"):
            continue
        after, state, single = min(place + int(_WIDTH[segment[place]]), n), 0, False
        for at in range(place, n):
            child = base[state] + segment[at] + 1
            if check[child] != state:
                break
            state = child
            if piece[state] >= 0:
                single |= at + 1 == after
                total = best[place] + score[piece[state]]
                if total > best[at + 1]:
                    best[at + 1], came[at + 1], used[at + 1] = total, place, piece[state]
        if not single and best[place] + voc.unknown > best[after]:
            best[after], came[after], used[after] = best[place] + voc.unknown, place, -1
    found, at = [], n
    while at:
        if used[at] < 0:
            found += [int(voc.byte_piece[b]) for b in reversed(segment[came[at] : at])]
        else:
            found.append(used[at])
        at = came[at]
    return found[::-1]


def solve(segments: list[bytes], voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of each segment by Viterbi, all segments side by side: flat ids and n+1 offsets."""
    size = np.fromiter(map(len, segments), np.int64, len(segments))
    order = np.argsort(-size, kind="stable")
    start = (np.cumsum(size + 1) - size - 1)[order]  # one place more than bytes: where a path may end
    size = size[order]
    data = np.frombuffer(b"\0".join([*segments, b""]), np.uint8).astype(np.int64)
    best = np.full(len(data) + 1, -np.inf)
    came = np.zeros(len(data) + 1, np.int64)
    used = np.full(len(data) + 1, -1, np.int32)
    best[start] = 0
    end_of = start + size
    for offset in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -offset, side="left"))
        place = start[:live] + offset
        reached = best[place] > -np.inf
        place, end = place[reached], end_of[:live][reached]
        if not len(place):
            continue
        after_character = place + _WIDTH[data[place]]
        single = np.zeros(len(place), bool)
        walker, state, depth = np.arange(len(place)), np.zeros(len(place), np.int64), 0
        while len(walker):
            going = place[walker] + depth < end[walker]
            walker, state = walker[going], state[going]
            reach = voc.base[state] + data[place[walker] + depth] + 1
            right = voc.check[reach] == state
            walker, state = walker[right], reach[right].astype(np.int64)
            depth += 1
            ids = voc.piece[state]
            ends = np.flatnonzero(ids >= 0)
            who, ids = walker[ends], ids[ends]
            target = place[who] + depth
            total = best[place[who]] + voc.score[ids]
            single[who[target == after_character[who]]] = True
            better = total > best[target]
            target = target[better]
            best[target], came[target], used[target] = total[better], place[who[better]], ids[better]
        lone = np.flatnonzero(~single)
        target = np.minimum(after_character[lone], end[lone])
        total = best[place[lone]] + voc.unknown
        better = total > best[target]
        target = target[better]
        best[target], came[target], used[target] = total[better], place[lone[better]], -1
    at, lane, step = end_of.copy(), np.arange(len(start)), 0
    found = []
    while True:
        on = at > start[lane]
        at, lane = at[on], lane[on]
        if not len(at):
            break
        found.append((lane, np.full(len(at), step), came[at], at, used[at]))
        at, step = came[at], step + 1
    if not found:
        return np.zeros(0, np.int32), np.zeros(len(segments) + 1, np.int64)
    lane, step, low, high, ids = (np.concatenate(x) for x in zip(*found))
    turn = np.lexsort((-step, order[lane]))
    lane, low, high, ids = order[lane[turn]], low[turn], high[turn], ids[turn]
    count = np.where(ids < 0, high - low, 1)
    spread = np.repeat(np.arange(len(ids)), count)
    inside = np.arange(len(spread)) - np.repeat(np.cumsum(count) - count, count)
    flat = np.where(ids[spread] < 0, voc.byte_piece[data[np.minimum(low[spread] + inside, len(data) - 1)]], ids[spread])
    total = np.bincount(lane, weights=count, minlength=len(segments)).astype(np.int64)
    return flat.astype(np.int32), np.concatenate(([0], np.cumsum(total)))


def gather(flat: np.ndarray, at: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[at[i]:at[i+1]]`` of ``picks``, joined, and the n+1 offsets of the picks in the result."""
    count = at[picks + 1] - at[picks]
    offsets = np.concatenate(([0], np.cumsum(count)))
    return flat[np.repeat(at[picks] - offsets[:-1], count) + np.arange(offsets[-1])], offsets


class Encoder:
    """Encodes texts of one task and remembers segments."""

    def __init__(self, voc: Vocabulary):
        self.voc = voc
        if not voc.breaks:
            self.cut = re.compile(rb".+", re.S)
        elif voc.newline_alone:
            self.cut = re.compile(rb" *[^ \n]+|\n| +")
        else:
            self.cut = re.compile(rb" *[^ ]+| +")
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the n+1 offsets of the texts."""
        cut = [self.cut.findall(b" " + t) if t else [] for t in texts]
        if len(self.known) > KEPT_SEGMENTS:
            self._clear()
        new = list(dict.fromkeys(s for segments in cut for s in segments if s not in self.known))
        if new:
            new.sort(key=lambda s: len(s) > LONG_SEGMENT)
            short = [s for s in new if len(s) <= LONG_SEGMENT]
            flat, at = solve(short, self.voc)
            alone = [np.array(solve_alone(s, self.voc), np.int32) for s in new[len(short) :]]
            flat = np.concatenate([flat, *alone])
            at = np.concatenate([at, at[-1] + np.cumsum([len(x) for x in alone], dtype=np.int64)])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.at = np.concatenate([self.at, self.at[-1] + at[1:]])
            self.flat = np.concatenate([self.flat, flat])
        known = self.known
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        picks = np.fromiter((known[s] for segments in cut for s in segments), np.int64, int(n.sum()))
        flat, offsets = gather(self.flat, self.at, picks)
        return flat, offsets[np.concatenate(([0], np.cumsum(n)))]


def decode(flat: np.ndarray, offsets: np.ndarray, voc: Vocabulary) -> list[bytes]:
    """Texts of the id runs that ``offsets`` bound."""
    data, at = gather(voc.text, voc.text_at, flat)
    data, at = data.tobytes(), at[offsets].tolist()
    return [data[a + 1 : b] if data[a : a + 1] == b" " and b > a else data[a:b] for a, b in zip(at[:-1], at[1:])]


ENCODED = "doc_id long, piece_ids array<int>, n_pieces long, n_byte_pieces long, decoded_sha256 string, round_trip boolean"


def encode_documents(docs: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """Pieces of every whole text, and whether decoding them gives the text back (``decoded_sha256`` is of that)."""
    voc = docs.sparkSession.sparkContext.broadcast(load(path))  # grows with the vocabulary file only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(voc.value)
        is_byte = voc.value.kind == BYTE
        for batch in tables.slices(batches):
            texts = batch.column("text").to_pylist()
            flat, offsets = encoder.encode(texts)
            back = decode(flat, offsets, voc.value)
            bytes_so_far = np.concatenate(([0], np.cumsum(is_byte[flat])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat)),
                    pa.array(np.diff(offsets)),
                    pa.array(np.diff(bytes_so_far[offsets])),
                    pa.array([hashlib.sha256(b).hexdigest() for b in back]),
                    pa.array([b == (t or b"") for b, t in zip(back, texts)]),
                ],
                names=["doc_id", "piece_ids", "n_pieces", "n_byte_pieces", "decoded_sha256", "round_trip"],
            )

    return tables.text_rows(docs).mapInArrow(run, ENCODED)


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_documents(tables.table(spark, sf_dir, "documents"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the kept texts as piece ids, with the check that they decode to the same text."""
    tables.ship(spark)
    return encode_documents(docs)
