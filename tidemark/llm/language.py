"""Language identification of mixed text: script ranges narrow the languages of a word, character n-grams score it, and
a Viterbi path with a penalty for each switch labels the words, so that spans come out in one language each.

Input cases: a null text, an empty one and one without letters are ``und`` with score 0 and no spans; texts are read
whole; repeated ids or rows are labelled one by one; a text whose letters are all in scripts that no learned language
uses gets the most frequent learned language with score 0; with nothing to learn from, every text is ``und``; an empty
table gives an empty result. Equal scores go to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays, tables

#: Labelled texts per language that the model is fitted on, about (all, where there are fewer).
SAMPLE_PER_LANGUAGE = 4000
#: Log-likelihood that a change of language costs.
SWITCH_PENALTY = 12.0
#: A language uses a script if so large a share of its training letters is in it.
SCRIPT_SHARE = 0.01

# First and last code point of the Unicode blocks of common scripts.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
#: Hash buckets for single characters, pairs and triples.
_SIZES = (1 << 14, 1 << 16, 1 << 17)
_BUCKETS = sum(_SIZES)


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, its lower case, its script (0: none of the list)."""
    n = 0x110000
    letter = np.fromiter((chr(c).isalpha() for c in range(n)), bool, n)
    small = ((c, chr(c).lower()) for c in range(n) if letter[c])
    lower = np.arange(n, dtype=np.uint32)
    for c, s in small:
        if len(s) == 1:
            lower[c] = ord(s)
    script = np.zeros(n, np.int8)
    for i, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            script[a : b + 1] = i
    return letter, lower, script


@dataclass
class Letters:
    """Runs of letters of several texts; ``start`` and ``end`` count code points of the joined texts."""

    lower: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    at: np.ndarray
    first: np.ndarray


def letters(column: pa.Array) -> Letters:
    texts = [x.decode() for x in column.fill_null(b"").to_pylist()]
    at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    code = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), dtype=np.uint32)
    is_letter, small, script = _characters()
    inside = np.concatenate(([False], is_letter[code], [False]))
    start = np.flatnonzero(inside[1:] & ~inside[:-1])
    end = np.flatnonzero(inside[:-1] & ~inside[1:])
    start, end = start[: len(end)], end
    lower = np.where(inside[1:-1], small[code], np.uint32(0))
    return Letters(lower, start, end, script[code[start]], at, np.searchsorted(start, at))


def features(found: Letters) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the letters, and for each the buckets of its single, pair and triple (0 stands outside a word)."""
    place = np.flatnonzero(found.lower)
    padded = np.concatenate(([0], found.lower, [0])).astype(np.uint64)
    before, now, after = padded[place], padded[place + 1], padded[place + 2]
    shift = np.uint64(21)
    grams = [now, before << shift | now, (before << shift | now) << shift | after]
    out, base = [], 0
    for order, (gram, size) in enumerate(zip(grams, _SIZES)):
        hashed = arrays.mix(gram + np.uint64(order << 62))
        out.append((hashed % np.uint64(size)).astype(np.int64) + base)
        base += size
    return place, out


@dataclass
class Model:
    languages: list[str]
    log: np.ndarray  # bucket by language
    uses: np.ndarray  # script by language
    usual: int


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in tables.slices([batch]):
            lang = np.array(part.column("lang").to_pylist(), dtype=object)
            for name in set(lang):
                found = letters(part.column("text").filter(pa.array(lang == name)))
                place, grams = features(found)
                mine = total.setdefault(name, np.zeros(_BUCKETS + len(SCRIPTS) + 1, np.int64))
                mine[:_BUCKETS] += np.bincount(np.concatenate(grams), minlength=_BUCKETS)
                mine[_BUCKETS:] += np.bincount(
                    np.repeat(found.script, found.end - found.start), minlength=len(SCRIPTS) + 1
                )
    for name, mine in total.items():
        used = np.flatnonzero(mine)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(mine[used])],
            names=["lang", "bucket", "n"],
        )


def fit(labelled: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Model from ``doc_id``, ``text`` (bytes) and ``lang``. What reaches the driver grows with languages only."""
    labelled = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return None
    shares = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, sample_per_language / n)))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 20)) / F.lit(1 << 20)
    sample = labelled.filter(draw < shares[F.col("lang")]).select("text", "lang")
    counted = sample.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n"))
    languages = sorted(sizes)
    table = counted.toArrow()
    counts = np.zeros((_BUCKETS + len(SCRIPTS) + 1, len(languages)))
    which = {k: i for i, k in enumerate(languages)}
    column = np.array([which[x] for x in table.column(0).to_pylist()], dtype=np.int64)
    counts[table.column(1).to_numpy(), column] = table.column(2).to_numpy()
    log, base = np.zeros((_BUCKETS, len(languages)), np.float32), 0
    for size in _SIZES:
        part = counts[base : base + size] + 0.1
        log[base : base + size] = np.log(part / part.sum(0))
        base += size
    script = counts[_BUCKETS:]
    uses = script >= SCRIPT_SHARE * np.maximum(script.sum(0), 1)
    return Model(languages, log, uses, max(range(len(languages)), key=lambda i: (sizes[languages[i]], -i)))


def word_scores(found: Letters, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of each word by language, and which words have a candidate language.

    Languages that do not use the script of a word are out of the question for it.
    """
    n, width = len(found.start), len(model.languages)
    scores = np.zeros((n, width), np.float32)
    place, grams = features(found)
    begin = np.searchsorted(place, found.start)
    step = max(1, (1 << 21) // width)
    word = 0
    while word < n:
        last = max(word + 1, int(np.searchsorted(begin, begin[word] + step)))
        run = slice(begin[word], begin[last] if last < n else len(place))
        each = model.log[grams[0][run]]
        for gram in grams[1:]:
            each += model.log[gram[run]]
        scores[word:last] = np.add.reduceat(each, begin[word:last] - begin[word], axis=0)
        word = last
    possible = model.uses[found.script]
    some = possible.any(1)
    scores[some] = np.where(possible[some], scores[some], -1e6)
    scores[~some] = 0
    return scores, some


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word; ``first`` has the word offsets of the texts, which are taken side by side."""
    n = len(scores)
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    label = np.zeros(n, np.int32)
    if not n:
        return label
    longest = int(size[0])
    live = np.searchsorted(-size, -np.arange(longest), side="left")  # texts with more than t words
    stay = np.zeros(scores.shape, bool)
    best = np.zeros(n, np.int32)
    state = np.zeros((len(size), scores.shape[1]))
    for t in range(longest):
        k = live[t]
        at = begin[:k] + t
        if t:
            now = state[:k]
            top = now.argmax(1)
            best[at] = top
            leave = now[np.arange(k), top][:, None] - penalty
            stay[at] = now >= leave
            state[:k] = np.maximum(now, leave) + scores[at]
            state[:k] -= state[:k].max(1, keepdims=True)
        else:
            state[:k] = scores[at]
    current = state.argmax(1).astype(np.int32)
    for t in range(longest - 1, -1, -1):
        k = live[t]
        at = begin[:k] + t
        label[at] = current[:k]
        if t:
            current[:k] = np.where(stay[at, current[:k]], current[:k], best[at])
    return label


SPANS = "doc_id long, lang_pred string, score double, n_letters long, spans array<struct<start:int,end:int,lang:string>>"


def _label(batch: pa.RecordBatch, model: Model | None, penalty: float) -> pa.RecordBatch:
    return _labelled(batch, model, penalty)[0]


def _labelled(batch: pa.RecordBatch, model: Model | None, penalty: float) -> tuple[pa.RecordBatch, np.ndarray]:
    """Rows of ``SPANS``, and the share of each text's letters that spans of any language hold."""
    found = letters(batch.column("text"))
    n = batch.num_rows
    size = found.end - found.start
    total = np.concatenate(([0], np.cumsum(size)))
    n_letters = total[found.first[1:]] - total[found.first[:-1]]
    doc = np.repeat(np.arange(n), np.diff(found.first))
    names = pa.array(model.languages if model else [], pa.string())
    if model is None or not len(size):
        label = np.zeros(len(size), np.int32)
        some = np.zeros(len(size), bool)
        share = np.zeros((n, 1))
    else:
        scores, some = word_scores(found, model)
        label = viterbi(scores, found.first, penalty)
        width = len(model.languages)
        share = np.bincount(doc * width + label, weights=size * some, minlength=n * width).reshape(n, width)
    pick = share.argmax(1)
    score = np.where(n_letters > 0, share[np.arange(n), pick] / np.maximum(n_letters, 1), 0.0)
    told = np.array([*(model.languages if model else []), "und"], dtype=object)
    pick = np.where(score > 0, pick, model.usual if model else -1)
    pick = np.where(n_letters > 0, pick, -1)
    some_at = np.flatnonzero(some)
    new = np.ones(len(some_at), bool)
    new[1:] = (label[some_at][1:] != label[some_at][:-1]) | (doc[some_at][1:] != doc[some_at][:-1])
    head = some_at[new]
    tail = some_at[np.append(new[1:], True)] if len(some_at) else some_at
    base = found.at[doc[head]]
    spans = pa.StructArray.from_arrays(
        [
            pa.array((found.start[head] - base).astype(np.int32)),
            pa.array((found.end[tail] - base).astype(np.int32)),
            names.take(pa.array(label[head])) if len(names) else pa.array([], pa.string()),
        ],
        names=["start", "end", "lang"],
    )
    offsets = np.searchsorted(doc[head], np.arange(n + 1)).astype(np.int32)
    rows = pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(told[pick], pa.string()),
            pa.array(score),
            pa.array(n_letters),
            pa.ListArray.from_arrays(pa.array(offsets), spans),
        ],
        names=["doc_id", "lang_pred", "score", "n_letters", "spans"],
    )
    return rows, share.sum(1) / np.maximum(n_letters, 1)


def in_training(doc_id: Column) -> Column:
    """A document is held out if the CRC-32 of its id as text leaves remainder 2 by 4; a null id is trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(True))


def labelled_rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )


def identify(docs: DataFrame, model: Model | None, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Language, score (share of the letters in spans of that language) and spans of every row of ``docs``.

    Span ends count code points of the text. The model takes under one megabyte for each language.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    return tables.map_slices(tables.text_rows(docs), lambda batch: _label(batch, held.value, penalty), SPANS)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents")
    model = fit(labelled_rows(docs).filter(in_training(F.col("doc_id"))))
    held_out = (~in_training(F.col("doc_id"))).alias("held_out")
    found = identify(docs, model)
    return found.select("doc_id", held_out, "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def stage(spark, docs: DataFrame, sf_dir: str, floor: float = 0.5) -> DataFrame:
    """Pipeline stage: documents go if they have no letters or spans of the learned languages, all taken together, hold
    less than ``floor`` of their letters."""
    tables.ship(spark)
    model = fit(labelled_rows(docs).filter(in_training(F.col("doc_id"))))
    held = spark.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.slices(batches):
            text = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
            rows = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(batch.num_rows)), text], names=["doc_id", "text"]
            )
            found, share = _labelled(rows, held.value, SWITCH_PENALTY)
            good = np.array(found.column("lang_pred").to_pylist(), dtype=object) != "und"
            good &= share >= floor
            yield batch.filter(pa.array(good))

    columns = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return columns.mapInArrow(keep, columns.schema)
