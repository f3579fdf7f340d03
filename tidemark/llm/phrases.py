"""Phrase collocation mining: contiguous phrases counted level by level in HAT-tries, scored by their weakest cut.

A phrase can be frequent only if the two phrases that lack its last or its first word are. So words are counted first,
then pairs of neighbouring frequent words, then pairs of frequent phrases that overlap in all but one word, up to five
words; nothing that reaches the least count is ever lost. A task packs the texts that it reads into chunks of word
numbers. At each level the chunk counts its candidates in a HAT-trie: nodes by word number, hash containers of the
phrases below, which burst into nodes when they grow. A trie that is full gives whole subtrees away as sorted runs, and
all of it at the end of the chunk. Runs meet in prefix partitions (prefixes that are common are parted again by what
follows), are merged there, and each chunk gets back which of its candidates are frequent, under numbers that hold
everywhere. No vocabulary is broadcast or collected. A chunk shrinks with each level: what is in no frequent phrase
goes. Scores are computed on the table of frequent phrases by joins with those that are one word shorter.

Input cases: a null text has no words; a null language is ``und``; repeated ids and rows count one by one; a very long
text is a block of its own; equal scores are ordered by count, then by phrase; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import count, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import tables
from tidemark.llm.arrays import mix
from tidemark.llm.packing import pack, pair_steps, pairs_from, unpack

LONGEST = 5
LEAST = 100
TOP = 2000
#: Bytes of text of a chunk, and words of a block of it, about.
CHUNK_BYTES = 32 << 20
BLOCK_WORDS = 1 << 18
#: Phrases of a hash container before it bursts, and of a whole trie before subtrees are spilled.
BURST = 4096
KEPT = 400_000
#: Bytes of a batch that a task hands over, about.
BATCH_BYTES = 1 << 21
#: Partitions over which the phrases of one prefix are dealt.
SPLIT = 64

_TOKEN = re.compile(rb"[^ \n]+|\n")
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TEXT = bytes.maketrans(
    bytes(range(ord("A"), ord("Z") + 1)) + _BREAKS + b"\t",
    bytes(range(ord("a"), ord("z") + 1)) + b"\n" * len(_BREAKS) + b" ",
)


class Words(dict):
    """Numbers of words, given on first sight; 0 is a break."""

    def __init__(self, numbers: Iterator[int]):
        super().__init__({b"\n": 0})
        self.numbers = numbers

    def __missing__(self, word: bytes) -> int:
        self[word] = found = next(self.numbers)
        return found


class HatTrie:
    """Counts of phrases. ``path`` gives the words of phrase codes (one row each); codes are any whole numbers."""

    def __init__(self, path, burst: int | None = None):
        self.path, self.burst = path, burst or BURST
        self.root: dict[int, Node | dict[int, int]] = {}
        self.size = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        """Different codes with how often each occurs."""
        words = self.path(codes)
        turn = np.lexsort(words.T[::-1])
        self._add(self.root, codes[turn], counts[turn], words[turn], 0)

    def _add(self, children: dict, codes: np.ndarray, counts: np.ndarray, words: np.ndarray, depth: int) -> None:
        column = words[:, depth]
        starts = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1])))
        ends = [*starts[1:].tolist(), len(column)]
        heads, code_list, count_list = column[starts].tolist(), codes.tolist(), counts.tolist()
        for word, start, end in zip(heads, starts.tolist(), ends):
            child = children.get(word)
            if child is None:
                child = children[word] = {}
            elif isinstance(child, Node):
                self._add(child, codes[start:end], counts[start:end], words[start:end], depth + 1)
                continue
            before = len(child)
            for i in range(start, end):
                code = code_list[i]
                child[code] = child.get(code, 0) + count_list[i]
            self.size += len(child) - before
            if len(child) > self.burst and depth + 1 < words.shape[1]:
                children[word] = self._burst(child, depth + 1)

    def _burst(self, container: dict[int, int], depth: int) -> Node:
        node = Node()
        codes = np.fromiter(container, np.int64, len(container))
        for word, code in zip(self.path(codes)[:, depth].tolist(), codes.tolist()):
            node.setdefault(word, {})[code] = container[code]
        return node

    def take(self, left: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Codes and counts of the largest subtrees, taken out until ``left`` phrases remain."""
        codes: list[int] = []
        counts: list[int] = []
        for word in sorted(self.root, key=lambda w: -_size(self.root[w])):
            if self.size <= left:
                break
            before = len(codes)
            for container in _containers(self.root.pop(word)):
                codes += container.keys()
                counts += container.values()
            self.size -= len(codes) - before
        return np.array(codes, np.int64), np.array(counts, np.int64)


class Node(dict):
    """A burst container: children by word."""


def _containers(child: Node | dict[int, int]) -> Iterator[dict[int, int]]:
    if isinstance(child, Node):
        for below in child.values():
            yield from _containers(below)
    else:
        yield child


def _size(child: Node | dict[int, int]) -> int:
    return sum(map(len, _containers(child)))


# --- chunks -------------------------------------------------------------------------------------

#: Rows of chunks: blocks (``place`` from 0 on), their head (-2), runs (with ``part``), words of a language (``n``).
_CHUNKS = "chunk long, place int, part int, lang string, data binary, n long"
_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.int64()]


def _batches(rows: Iterator[tuple], schema: str, kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``BATCH_BYTES``; their data is the column ``data``."""
    names = [c.split()[0] for c in schema.split(", ")]
    at, held, size = names.index("data"), [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[at] or b"")
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def _word_chunks(parts: int):
    """Texts to blocks of word numbers, and the words of each chunk (after their language) as sorted runs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        task, made = TaskContext.get().partitionId(), 0
        words: dict[str, Words] = {}
        block: list[np.ndarray] = []
        counts = np.zeros(0, np.int64)
        numbers, held, waiting, place = count(1), 0, 0, 0

        def flush() -> Iterator[tuple]:
            nonlocal block, waiting, counts, place
            if waiting:
                flat = np.concatenate(block)
                seen = np.bincount(flat, minlength=len(counts))
                seen[: len(counts)] += counts
                counts = seen
                yield task << 32 | made, place, None, None, pack(flat), None
                block, waiting, place = [], 0, place + 1

        def close() -> Iterator[tuple]:
            nonlocal words, counts, numbers, held, place, made
            yield from flush()
            chunk = task << 32 | made
            names: list[bytes] = []
            number: list[int] = []
            for lang, known in words.items():
                del known[b"\n"]
                prefix = lang.encode() + b"\n"
                names += [prefix + w for w in known]
                number += known.values()
                yield chunk, None, None, lang, None, int(counts[list(known.values())].sum())
            part = np.fromiter((zlib.crc32(name) % parts for name in names), np.int64, len(names))
            turn = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)
            turn = turn[np.argsort(part[turn], kind="stable")]
            local = np.array(number, np.int64)
            for p, at in _groups(part[turn]):
                mine = turn[at]
                run = [names[i] for i in mine.tolist()]
                lengths = np.fromiter(map(len, run), np.int64, len(run))
                packed = pack(np.frombuffer(b"".join(run), np.uint8), lengths, counts[local[mine]], local[mine])
                yield chunk, None, p, None, packed, None
            words, counts, numbers, held, place, made = {}, np.zeros(0, np.int64), count(1), 0, 0, made + 1

        for batch in tables.slices(batches):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(lang, []).append(text or b"")
            for lang, texts in by_lang.items():
                known = words.get(lang)
                if known is None:
                    known = words[lang] = Words(numbers)
                found = _TOKEN.findall(b"\n".join(texts).translate(_TEXT))
                block += [np.fromiter(map(known.__getitem__, found), np.int32, len(found)), np.zeros(1, np.int32)]
                waiting += len(found) + 1
                held += sum(map(len, texts))
            if waiting > BLOCK_WORDS:
                yield from flush()
            if held > CHUNK_BYTES:
                yield from close()
        yield from close()

    return lambda batches: _batches(rows(batches), _CHUNKS, _KINDS)


def _groups(ordered: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Values of a sorted array, each with its place."""
    if len(ordered):
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(ordered)]):
            yield int(ordered[start]), slice(start, end)


def closed_up(sequence: np.ndarray) -> np.ndarray:
    """The sequence without numbers that have no neighbour, and with single breaks (0) only."""
    on = sequence != 0
    padded = np.concatenate(([False], on, [False]))
    paired = on & (padded[:-2] | padded[2:])
    before = np.concatenate(([False], paired[:-1]))
    return sequence[paired | before]


def _extend(level: int, parts: int):
    """Chunks of frequent phrases of ``level`` words from chunks one level below and what came back; runs above."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        names = ("chunk", "place", "data")
        found = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in names)))
        for chunk, group in groupby(found, itemgetter(0)):
            head, back, trie = None, [], None
            for _, place, data in group:
                if place == -2:
                    head = unpack(data)
                elif place == -1:
                    back.append(unpack(data))
                elif back:
                    if trie is None:
                        numbered = _renumbered(head, back, level)
                        numbers, words = numbered.numbers, numbered.words
                        yield chunk, -2, None, None, pack(numbers, words.ravel()), None
                        trie = HatTrie(lambda codes: np.column_stack([words[codes >> 32], words[codes & 0xFFFFFFFF, -1]]))
                    sequence = closed_up(numbered.sequence(unpack(data)[0]))
                    if len(sequence) < 2:
                        continue
                    yield chunk, place, None, None, pack(sequence), None
                    left, right = sequence[:-1].astype(np.int64), sequence[1:].astype(np.int64)
                    codes = (((left - 1) << 32) | (right - 1))[(left > 0) & (right > 0)]
                    trie.add(*np.unique(codes, return_counts=True))
                    if trie.size > KEPT:
                        yield from _runs(chunk, numbers, *trie.take(KEPT // 2), parts)
            if trie is not None and trie.size:
                yield from _runs(chunk, numbers, *trie.take(), parts)

    return lambda batches: _batches(rows(batches), _CHUNKS, _KINDS)


def _runs(chunk: int, numbers: np.ndarray, codes: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[tuple]:
    """Phrases by their numbers that hold everywhere, in order, one run for each prefix partition."""
    left, right = numbers[codes >> 32], numbers[codes & 0xFFFFFFFF]
    with np.errstate(over="ignore"):
        split = mix(right.astype(np.uint64)) % np.uint64(SPLIT)
        part = (mix(left.astype(np.uint64) * np.uint64(SPLIT) + split) % np.uint64(parts)).astype(np.int64)
    turn = np.lexsort((right, left, part))
    left, right, counts = left[turn], right[turn], counts[turn]
    for p, at in _groups(part[turn]):
        yield chunk, None, p, None, pack(*pair_steps(left[at], right[at]), counts[at]), None


class _renumbered:
    """The frequent phrases of a chunk in order of their numbers, their words, and old blocks in new places (from 1)."""

    def __init__(self, head: list[np.ndarray] | None, back: list[list[np.ndarray]], level: int):
        columns = [np.concatenate(x) for x in zip(*back)]
        if level == 1:  # (number in the chunk, number everywhere) of each word
            old, found = columns
            self.numbers = np.sort(found)
            self.words = np.arange(len(found), dtype=np.int32)[:, None]
            self.place = np.zeros(int(old.max()) + 1, np.int32)
            self.place[old] = np.searchsorted(self.numbers, found) + 1
            self.codes = None
            return
        left, right, found = columns
        before, words = head
        words = words.reshape(len(before), -1)
        self.numbers, first = np.unique(found, return_index=True)  # a phrase of two runs comes back twice
        left, right = np.searchsorted(before, left[first]), np.searchsorted(before, right[first])
        self.words = np.column_stack([words[left], words[right, -1]])
        codes = (left.astype(np.int64) << 32) | right
        turn = np.argsort(codes)
        self.codes, self.place = codes[turn], (turn + 1).astype(np.int32)

    def sequence(self, old: np.ndarray) -> np.ndarray:
        if self.codes is None:
            return np.where(old < len(self.place), self.place[np.minimum(old, len(self.place) - 1)], 0)
        left, right = old[:-1].astype(np.int64), old[1:].astype(np.int64)
        codes = ((left - 1) << 32) | (right - 1)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where((left > 0) & (right > 0) & (self.codes[at] == codes), self.place[at], 0).astype(np.int32)


# --- merging ------------------------------------------------------------------------------------

#: Frequent phrases (``number`` and what follows), and rows that go back to chunks (``chunk`` and ``data``).
_MERGED = "number long, lang string, word binary, first long, second long, n long, chunk long, data binary"
_MERGED_KINDS = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _part_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, list[list[np.ndarray]]]]:
    """Prefix partitions: their number, the chunk of each entry, and their runs."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("part", "chunk", "data"))))
    for part, group in groupby(rows, itemgetter(0)):
        chunks, runs = [], []
        for _, chunk, data in group:
            runs.append(unpack(data))
            chunks.append(np.full(len(runs[-1][-1]), chunk, np.int64))
        yield part, np.concatenate(chunks), runs


def _merged_words(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple]:
    """Frequent words; the numbers of a part are its own, and small, which packs well."""
    for part, chunk, runs in _part_runs(batches):
        words = []
        for data, lengths, *_ in runs:
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
            words.append(pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
        table = pa.table({"word": pa.concat_arrays(words), "n": pa.array(np.concatenate([r[2] for r in runs]))})
        total = table.group_by("word", use_threads=False).aggregate([("n", "sum")])
        total = total.filter(pc.greater_equal(total.column("n_sum"), LEAST)).sort_by("word").combine_chunks()
        if not total.num_rows:
            continue
        names = total.column("word").combine_chunks()
        numbers = part + parts * np.arange(len(names), dtype=np.int64)
        for i, name, n in zip(numbers.tolist(), names.to_pylist(), total.column("n_sum").to_pylist()):
            lang, _, word = name.rpartition(b"\n")
            yield i, lang.decode(), word, None, None, n, None, None
        at = pc.index_in(table.column("word").combine_chunks(), names).fill_null(-1).to_numpy()
        yield from _returned(chunk, at >= 0, np.concatenate([r[3] for r in runs]), numbers[at])


def _merged_phrases(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple]:
    for part, chunk, runs in _part_runs(batches):
        left, right, n = (np.concatenate(x) for x in zip(*((*pairs_from(a, b), c) for a, b, c in runs)))
        turn = np.lexsort((right, left))
        left, right, n, chunk = left[turn], right[turn], n[turn], chunk[turn]
        new = np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
        starts, group = np.flatnonzero(new), np.cumsum(new) - 1
        total = np.add.reduceat(n, starts)
        frequent = total >= LEAST
        numbers = part + parts * (np.cumsum(frequent) - 1)
        kept = [x[frequent].tolist() for x in (numbers, left[starts], right[starts], total)]
        for i, first, second, count_ in zip(*kept):
            yield i, None, None, first, second, count_, None, None
        yield from _returned(chunk, frequent[group], left, right, numbers[group])


def _returned(chunk: np.ndarray, keep: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """One row to each chunk with the kept entries of the columns."""
    chunk, columns = chunk[keep], [c[keep] for c in columns]
    turn = np.argsort(chunk, kind="stable")
    for c, at in _groups(chunk[turn]):
        yield None, None, None, None, None, None, c, pack(*(x[turn[at]] for x in columns))


def _merge(level: int, parts: int):
    merged = _merged_words if level == 1 else _merged_phrases
    return lambda batches: _batches(merged(batches, parts), _MERGED, _MERGED_KINDS)


# --- Spark --------------------------------------------------------------------------------------


def frequent_phrases(docs: DataFrame, staging: tables.Staging) -> tuple[list[DataFrame], DataFrame]:
    """Tables of frequent phrases by number of words, and the words of each language.

    Each phrase has its ``number``, its count ``n`` and, beyond single words (``lang``, ``word``), the numbers of the
    phrases without its last word (``first``) and without its first one (``second``).
    """
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(
        F.coalesce(F.col("`lang`").cast("string"), F.lit("und")).alias("lang"), F.col("`text`").cast("binary").alias("text")
    )
    chunks = staging.put(texts.mapInArrow(_word_chunks(parts), _CHUNKS), "level0", codec="lz4")
    totals = chunks.filter("n is not null").groupBy("lang").agg(F.sum("n").alias("total"))
    totals = staging.put(totals, "totals")
    found = []
    for level in range(1, LONGEST + 1):
        runs = chunks.filter("part is not null").select("part", "chunk", "data")
        runs = runs.repartition("part").sortWithinPartitions("part", "chunk")
        merged = staging.put(runs.mapInArrow(_merge(level, parts), _MERGED), f"merged{level}")
        found.append(merged.filter("number is not null"))
        if level == LONGEST:
            break
        back = merged.filter("chunk is not null").select("chunk", F.lit(-1).alias("place"), "data")
        blocks = chunks.filter("place is not null").select("chunk", "place", "data")
        together = blocks.unionByName(back).repartition("chunk").sortWithinPartitions("chunk", "place")
        chunks = staging.put(together.mapInArrow(_extend(level, parts), _CHUNKS), f"level{level}", codec="lz4")
        staging.release(f"level{level - 1}")
    return found, totals


def scored_phrases(found: list[DataFrame], totals: DataFrame, staging: tables.Staging) -> DataFrame:
    """Frequent phrases of two words and more that no longer one replaces, with the score of their weakest cut.

    ``first_counts`` and ``last_counts`` hold the counts of a phrase's first and last 1, 2, … words.
    """
    shorter = found[0].select(
        "number",
        "lang",
        F.array(F.col("word").cast("string")).alias("words"),
        F.array("n").alias("first_counts"),
        F.array("n").alias("last_counts"),
    )
    scored = []
    for size in range(2, LONGEST + 1):
        head = shorter.select(F.col("number").alias("first"), "lang", "words", "first_counts")
        tail = shorter.select(F.col("number").alias("second"), F.element_at("words", -1).alias("word"), "last_counts")
        rows = found[size - 1].select("number", "first", "second", "n").join(head, "first").join(tail, "second")
        rows = rows.select(
            "number",
            "lang",
            F.array_append("words", F.col("word")).alias("words"),
            F.array_append("first_counts", F.col("n")).alias("first_counts"),
            F.array_append("last_counts", F.col("n")).alias("last_counts"),
            F.col("n").alias("a"),
        )
        shorter = rows = staging.put(rows, f"phrases{size}")
        if size < LONGEST:
            longer = found[size].select(F.explode(F.array("first", "second")).alias("number"), "n")
            longer = longer.groupBy("number").agg(F.max("n").alias("longer"))
            rows = rows.join(longer, "number", "left").filter("longer is null or 100 * longer < 100 * a").drop("longer")
        scored.append(rows.join(totals, "lang").withColumn("cut", _weakest_cut(size)))
    rows = reduce(DataFrame.unionByName, scored)
    return rows.select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score"
    )


def _weakest_cut(size: int) -> Column:
    """The cut with the lowest score, of equal ones the first: products are decimals of up to 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    cuts = []
    for k in range(1, size):
        left, right = F.col("first_counts")[k - 1], F.col("last_counts")[size - k - 1]
        score = F.call_function("div", wide(F.lit(1000) * F.col("a")) * wide(F.col("total")), wide(left) * wide(right))
        cuts.append(F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts))


def top_phrases(docs: DataFrame, staging: tables.Staging, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language by score, count and phrase."""
    found, totals = frequent_phrases(docs, staging)
    scored = scored_phrases(found, totals, staging)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir: str) -> DataFrame:
    with tables.Staging(spark, "phrases") as staging:
        return staging.put(top_phrases(tables.table(spark, sf_dir, "documents"), staging), "top", keep=True)


ORACLE_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM places, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)
), frequent AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), kept AS (
  SELECT * FROM frequent AS c WHERE k >= 2 AND NOT EXISTS (
    SELECT 1 FROM frequent AS d WHERE d.lang = c.lang AND d.k > c.k AND 100 * d.f >= 100 * c.f
      AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT *, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM kept
), scores AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, n, cut,
    (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts AS c JOIN totals ON c.lang = totals.lang
  JOIN frequent AS x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : cut], ' ')
  JOIN frequent AS y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1 : c.k], ' ')
), weakest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS turn FROM scores
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest WHERE turn = 1
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
