"""Cross-tokenizer alignment: which tokens of a byte-level BPE (A) and of a piece model (B) cover the same bytes.

Inside a task everything is Arrow: token lists are flattened with their parent indices, cumulative sums that start anew
in each document give every token its end, and a hash join of both sides' ends tells the groups (ends that both have).
The ends of both sides together cut a document into stretches; each lies in one A and one B token and is their link.
How many documents hold a pair linked is counted per slice with ``Table.group_by``, added up over the slices of a
chunk, and merged by Spark. No vocabulary-sized or corpus-sized table is broadcast: a chunk keeps its links as numbers
into its own list of pairs, and gets the merged counts of that list back.

Input cases: a null or empty text, and one whose tokens on either side do not join to a space and the text (a text
with the marker character, say, or invalid UTF-8), has no tokens: zeros and an empty digest; every row is a document
of its own, so repeated ids and rows count one by one; of pairs with equal counts all are best; a long text is one
slice, whose tokens a task holds; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bpe, tables
from tidemark.llm.packing import pack, unpack
from tidemark.llm.pieces import gather

#: Where the installed public vocabularies lie; every function takes other paths.
MERGES_PATH = "/opt/tokenizers/byte_bpe_50k.json"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Different pairs of a chunk, about.
CHUNK_PAIRS = 400_000
#: Segments that a task keeps; beyond that it starts anew.
KEPT_SEGMENTS = 400_000
_A_BITS = 32


class PieceEncoder:
    """Encodes texts with the piece model and remembers segments (spaces and what follows them).

    No piece holds a marker after another character, so no merge crosses the start of a segment; if a model has such
    pieces, texts are not cut.
    """

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = any(re.search("[^▁]▁", p) for p in pieces)
        self.cut = re.compile(r".+" if crossing else r" *[^ ]+| +", re.S)
        spelled = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.text = np.frombuffer(b"".join(spelled), np.uint8)
        self.text_at = np.concatenate(([0], np.cumsum([len(s) for s in spelled])))
        self.marker = self.model.piece_to_id("▁")
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, each given with the space that the model puts in front, and n+1 offsets."""
        if len(self.known) > KEPT_SEGMENTS:
            self._clear()
        known, cut = self.known, [self.cut.findall(t) for t in texts]
        new = list(dict.fromkeys(s for segments in cut for s in segments if s not in known))
        if new:
            made = self.model.encode([s[1:] for s in new], num_threads=1)
            made = [ids if s != " " else [self.marker] for s, ids in zip(new, made)]
            known.update(zip(new, range(len(known), len(known) + len(new))))
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
            self.flat = np.concatenate([self.flat, np.fromiter((i for ids in made for i in ids), np.int32, int(sizes.sum()))])
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        picks = np.fromiter((known[s] for segments in cut for s in segments), np.int64, int(n.sum()))
        flat, offsets = gather(self.flat, self.at, picks)
        return flat, offsets[np.concatenate(([0], np.cumsum(n)))]


class Tokenizers:
    """Both sides, in a task."""

    def __init__(self, merges: bpe.Vocabulary, model: bytes):
        self.voc, self.a, self.b = merges, bpe.Encoder(merges), PieceEncoder(model)
        self.a_length = pa.array(np.diff(merges.text_at))
        self.b_length = pa.array(np.diff(self.b.text_at))

    def encode(self, texts: list[bytes | None]) -> tuple[pa.ListArray, pa.ListArray]:
        """Token ids of both sides; both empty for a text that does not come back from either."""
        spaced = [" " + t.decode("utf-8", "replace") if t else "" for t in texts]
        a, a_at = self.a.encode([bpe.settled(t, True) for t in spaced])
        b, b_at = self.b.encode(spaced)
        wanted = [b" " + t if t else b"" for t in texts]
        back = zip(bpe.decode(a, a_at, self.voc), self._spelled(b, b_at), wanted)
        good = np.array([x == y == z for x, y, z in back], bool)
        return _kept(a, a_at, good), _kept(b, b_at, good)

    def _spelled(self, flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        data, at = gather(self.b.text, self.b.text_at, flat)
        data, at = data.tobytes(), at[offsets].tolist()
        return [data[x:y] for x, y in zip(at[:-1], at[1:])]


def _kept(flat: np.ndarray, offsets: np.ndarray, good: np.ndarray) -> pa.ListArray:
    count = np.diff(offsets)
    flat = flat[np.repeat(good, count)]
    return _list(flat, np.where(good, count, 0))


def _list(flat: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), flat if isinstance(flat, pa.Array) else pa.array(flat))


def _ends(tokens: pa.ListArray, length: pa.Array, name: str) -> pa.Table:
    """Tokens with their document-end keys: the row of the list and the bytes up to the token's end in it."""
    flat, parent = pc.list_flatten(tokens), pc.list_parent_indices(tokens)
    total = pc.cumulative_sum(length.take(flat))
    before = pa.concat_arrays([pa.array([0], pa.int64()), total]).take(tokens.offsets.slice(0, len(tokens)))
    end = pc.subtract(total, before.take(parent))
    key = pc.add(pc.shift_left(parent.cast(pa.int64()), pa.scalar(32, pa.int64())), end)
    return pa.table({"key": key, name: flat})


@dataclass
class Aligned:
    """Links in order of their stretches: ``doc`` (row of the lists), token ids, and where both tokens end."""

    doc: pa.Array
    a: pa.Array
    b: pa.Array
    both: pa.Array
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: pa.Array


def align(a: pa.ListArray, b: pa.ListArray, a_length: pa.Array, b_length: pa.Array) -> Aligned:
    rows = len(a)
    left, right = _ends(a, a_length, "a"), _ends(b, b_length, "b")
    ends = left.join(right, "key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    key, in_a, in_b = (ends.column(c).combine_chunks() for c in ("key", "a", "b"))
    both = pc.and_(pc.is_valid(in_a), pc.is_valid(in_b))
    doc = pc.shift_right(key, pa.scalar(32, pa.int64()))
    # Groups as text: ids of one side joined by commas, sides by a bar, groups by semicolons.
    is_both = both.to_numpy(zero_copy_only=False)
    group = np.cumsum(is_both) - is_both
    n = int(is_both.sum())
    row = doc.to_numpy()
    per_doc = np.bincount(row[is_both], minlength=rows)
    sides = []
    for column in (in_a, in_b):
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        text = column.drop_null().cast(pa.string())
        sides.append(pc.binary_join(_list(text, np.bincount(group[valid], minlength=n)), ","))
    groups = pc.binary_join(_list(pc.binary_join_element_wise(*sides, "|"), per_doc), ";")
    return Aligned(
        doc,
        pc.fill_null_backward(in_a),
        pc.fill_null_backward(in_b),
        both,
        np.diff(a.offsets.to_numpy()),
        np.diff(b.offsets.to_numpy()),
        per_doc,
        np.bincount(row, minlength=rows),
        groups,
    )


GROUPS = "doc_id long, n_a long, n_b long, groups string"


def aligned_groups(docs: DataFrame, merges_path: str = MERGES_PATH, model_path: str = MODEL_PATH) -> DataFrame:
    """The groups of every text as ``a1,a2|b1;a3|b2,b3``; null for a text without tokens."""
    shared = _broadcast(docs, merges_path, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Tokenizers(*shared.value)
        for batch in tables.slices(batches):
            found = align(*both.encode(batch.column("text").to_pylist()), both.a_length, both.b_length)
            groups = pc.if_else(pa.array(found.n_groups > 0), found.groups, None)
            columns = [batch.column("doc_id"), pa.array(found.n_a, pa.int64()), pa.array(found.n_b, pa.int64()), groups]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "groups"])

    return tables.text_rows(docs).mapInArrow(run, GROUPS)


def _broadcast(docs: DataFrame, merges_path: str, model_path: str):
    # Grows with the two vocabulary files only.
    return docs.sparkSession.sparkContext.broadcast((bpe.load_merges(merges_path), Path(model_path).read_bytes()))


# --- counts over all documents ------------------------------------------------------------------

_CHUNKS = "chunk long, part int, docs binary, pairs array<long>, held array<int>"


class _Chunk:
    """Pairs of the documents that a task reads one after another, and how many of those hold each."""

    def __init__(self) -> None:
        self.number: dict[int, int] = {}
        self.held = np.zeros(0, np.int32)
        self.part = 0

    def numbers(self, found: Aligned) -> np.ndarray:
        """The links as numbers of their pairs; counts their documents."""
        pair = pc.bit_wise_or(pc.shift_left(found.a.cast(pa.int64()), pa.scalar(_A_BITS, pa.int64())), found.b.cast(pa.int64()))
        table = pa.table({"doc": found.doc, "pair": pair})
        once = table.group_by(["doc", "pair"], use_threads=False).aggregate([])
        counts = once.group_by("pair", use_threads=False).aggregate([([], "count_all")])
        pairs = counts.column("pair").combine_chunks()
        number = self.number
        for p in pairs.to_pylist():
            if p not in number:
                number[p] = len(number)
        mine = np.fromiter((number[p] for p in pairs.to_pylist()), np.int64, len(pairs))
        self.held = np.concatenate([self.held, np.zeros(len(number) - len(self.held), np.int32)])
        self.held[mine] += counts.column("count_all").to_numpy().astype(np.int32)
        return mine[pc.index_in(pair, pairs).to_numpy()]


def _documents(doc_ids: pa.Array, found: Aligned, numbers: np.ndarray) -> bytes:
    digests = [hashlib.sha256(g.as_buffer()).hexdigest() if n else "" for g, n in zip(found.groups, found.n_groups)]
    columns = {
        "doc_id": doc_ids,
        "n_a": pa.array(found.n_a, pa.int64()),
        "n_b": pa.array(found.n_b, pa.int64()),
        "n_groups": pa.array(found.n_groups, pa.int64()),
        "n_links": pa.array(found.n_links, pa.int64()),
        "groups_sha256": pa.array(digests, pa.string()),
    }
    table = pa.table(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    head = sink.getvalue().to_pybytes()
    return len(head).to_bytes(8, "little") + head + pack(numbers.astype(np.uint32))


def _opened(data: bytes) -> tuple[pa.Table, np.ndarray]:
    end = 8 + int.from_bytes(data[:8], "little")
    return pa.ipc.open_stream(data[8:end]).read_all(), unpack(data[end:])[0]


COUNTED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk in order: the counts of its pairs (``part`` -1), then its documents."""
    names = [x.split()[0] for x in COUNTED.split(", ")]
    chunk, lists = None, []
    count = best = np.zeros(0, np.int64)
    for batch in batches:
        chunks, parts = (batch.column(c).to_numpy() for c in ("chunk", "part"))
        edges = np.flatnonzero((np.diff(chunks) != 0) | (np.diff(parts < 0) != 0)) + 1
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(chunks)]):
            if chunks[start] != chunk:
                chunk, lists = chunks[start], []
                count = best = np.zeros(0, np.int64)
            if parts[start] < 0:
                lists.append(batch.column("count").slice(start, end - start).to_numpy())
                continue
            if lists:
                both = np.concatenate(lists)
                lists, count, best = [], both >> 1, both & 1
            for data in batch.column("docs").slice(start, end - start).to_pylist():
                table, numbers = _opened(data)
                at = np.concatenate(([0], np.cumsum(table.column("n_links").to_numpy())))
                sums = [np.concatenate(([0], np.cumsum(x[numbers]))) for x in (best, count)]
                columns = {c: table.column(c) for c in table.column_names}
                columns |= {"n_best": pa.array(np.diff(sums[0][at])), "count_sum": pa.array(np.diff(sums[1][at]))}
                yield from pa.table(columns).select(names).combine_chunks().to_batches()


def alignment_counts(
    docs: DataFrame, staging: tables.Staging, merges_path: str = MERGES_PATH, model_path: str = MODEL_PATH
) -> DataFrame:
    """Per document: tokens, groups, links, links whose pair is the commonest of its A token, and their counts' sum."""
    shared = _broadcast(docs, merges_path, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, chunk, made = Tokenizers(*shared.value), _Chunk(), 0
        task = TaskContext.get().partitionId()
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        names = [x.split()[0] for x in _CHUNKS.split(", ")]

        def row(part: int, data: bytes | None, pairs: pa.Array | None, held: np.ndarray | None) -> pa.RecordBatch:
            lists = [
                pa.array([None], k) if v is None else _list(pa.array(v), np.array([len(v)]))
                for v, k in ((pairs, kinds[3]), (held, kinds[4]))
            ]
            columns = [pa.array([v], k) for v, k in zip(((task << 32) | made, part, data), kinds)]
            return pa.RecordBatch.from_arrays(columns + lists, names=names)

        def close() -> pa.RecordBatch:
            return row(-1, None, pa.array(list(chunk.number), pa.int64()), chunk.held)

        for batch in tables.slices(batches):
            found = align(*both.encode(batch.column("text").to_pylist()), both.a_length, both.b_length)
            yield row(chunk.part, _documents(batch.column("doc_id"), found, chunk.numbers(found)), None, None)
            chunk.part += 1
            if len(chunk.number) > CHUNK_PAIRS:
                yield close()
                chunk, made = _Chunk(), made + 1
        if chunk.part:
            yield close()

    chunks = staging.put(tables.text_rows(docs).mapInArrow(run, _CHUNKS), "chunks", codec="lz4")
    pairs = chunks.filter("part < 0").select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "x"))
    pairs = pairs.select("chunk", "at", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    totals = staging.put(pairs.groupBy("pair").agg(F.sum("held").alias("n")), "totals")
    a = F.shiftright("pair", _A_BITS)
    most = totals.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    # One row per token of A's vocabulary at most, whatever the corpus.
    marked = totals.join(F.broadcast(most), a == F.col("a"))
    marked = marked.select("pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("count"))
    empty = F.lit(None).cast("binary").alias("docs")
    counts = pairs.join(marked, "pair").select("chunk", F.lit(-1).alias("part"), "at", "count", empty)
    blocks = chunks.filter("part >= 0").select("chunk", "part", F.lit(0).alias("at"), F.lit(0).cast("long").alias("count"), "docs")
    together = counts.unionByName(blocks).repartition("chunk").sortWithinPartitions("chunk", "part", "at")
    return together.mapInArrow(_counted, COUNTED)


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    with tables.Staging(spark, "alignment") as staging:
        counts = alignment_counts(tables.table(spark, sf_dir, "documents"), staging)
        return staging.put(counts, "counts", keep=True)
