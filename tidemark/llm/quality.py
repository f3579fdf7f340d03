"""Quality rules as weak supervision: rules vote good, bad or abstain; expectation-maximisation learns how far each can
be trusted; the posterior probability of good text decides.

Input cases: a null text is an empty one; repeated ids or rows are scored one by one; an empty table gives an empty
result (no model is needed for it). A text with no word gets votes like any other (mostly bad) and always fails the
base test.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays, tables

MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_letters long, n_upper long, n_bare_words long"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
#: ASCII letters, and the first byte of every longer character.
_LETTER = np.zeros(256, bool)
_LETTER[list(range(ord("A"), ord("Z") + 1)) + list(range(ord("a"), ord("z") + 1)) + list(range(0xC3, 0xF5))] = True


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line of the text."""
    found = [line for line in text.split(b"\n") if line.strip()]
    return len(found), len(found) - len(set(found))


def repeated_words(hashes: np.ndarray, first: np.ndarray, width: int = 3) -> np.ndarray:
    """Per text, the words that stand in a ``width``-word window found twice or more in that text."""
    n = len(first) - 1
    inside = np.zeros(len(hashes), bool)
    gram = arrays.rolling(hashes, width)
    if len(gram):
        doc = np.repeat(np.arange(n), np.diff(first))[: len(gram)]
        whole = np.arange(len(gram)) + width <= first[doc + 1]
        at = np.flatnonzero(whole)
        key = gram[at] ^ arrays.mix(doc[at].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        same = np.concatenate(([False], key[order][1:] == key[order][:-1], [False]))
        twice = at[order[same[:-1] | same[1:]]]
        for i in range(width):
            inside[twice + i] = True
    total = np.concatenate(([0], np.cumsum(inside)))
    return total[first[1:]] - total[first[:-1]]


def _lettered(found: arrays.Words) -> np.ndarray:
    """Which words hold a letter."""
    total = np.concatenate(([0], np.cumsum(_LETTER[found.data])))
    return total[found.end] > total[found.start]


def _measure(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = arrays.words(batch.column("text"))
    data, at = arrays.buffers(batch.column("text"))

    def per_text(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flag)))
        return total[at[1:]] - total[at[:-1]]

    space = arrays._SPACE[data]
    lines = [_lines(x or b"") for x in batch.column("text").to_pylist()]
    columns = [
        batch.column("doc_id"),
        np.diff(found.first),
        per_text(~space & ((data & 0xC0) != 0x80)),
        per_text(_SYMBOL[data]),
        np.array([x[1] for x in lines], dtype=np.int64),
        repeated_words(found.hashes(), found.first),
        np.array([x[0] for x in lines], dtype=np.int64),
        per_text(_LETTER[data]),
        per_text(_UPPER[data]),
        np.diff(found.first) - np.diff(np.searchsorted(found.start[_lettered(found)], at)),
    ]
    names = [x.split()[0] for x in MEASURES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=names)


def measures(docs: DataFrame) -> DataFrame:
    """Counts of every whole text, a row per input row."""
    return tables.map_slices(tables.text_rows(docs), _measure, MEASURES)


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes 1 (good), -1 (bad) and 0 (abstain) over the columns of ``measures``."""
    words = F.col("n_words")
    mean = F.col("word_chars") / F.when(words > 0, words)
    symbols = F.col("n_symbols") / F.when(words > 0, words)
    copies = F.col("n_dup_lines") / F.when(F.col("n_lines") > 0, F.col("n_lines"))
    repeats = F.col("n_repeat_words") / F.when(words > 0, words)
    letters = F.col("n_letters") / F.when(F.col("word_chars") > 0, F.col("word_chars"))
    upper = F.col("n_upper") / F.when(F.col("n_letters") > 0, F.col("n_letters"))
    bare = F.col("n_bare_words") / F.when(words > 0, words)
    return {
        "length": _vote(words, words >= 100, words < 50),
        "word_length": _vote(mean, mean.between(3.5, 9), ~mean.between(2.5, 12)),
        "symbols": _vote(symbols, symbols < 0.05, symbols > 0.1),
        "line_copies": _vote(copies, copies < 0.1, copies > 0.3),
        "repetition": _vote(repeats, repeats < 0.1, repeats > 0.3),
        "letters": _vote(letters, letters > 0.85, letters < 0.7),
        "bare_words": _vote(bare, bare < 0.05, bare > 0.2),
        "capitals": _vote(upper, upper < 0.15, upper > 0.4),
    }


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, prior: float = 5.0) -> tuple[float, np.ndarray]:
    """Two-class model of independent voters from the counts of vote patterns.

    Returns the share of good texts and, per class (bad, good), rule and vote (-1, 0, 1), the probability of that
    vote. It starts from the mean vote; ``prior`` pseudo-counts for each class say that rules are right more often
    than wrong, which also tells the two classes apart.
    """
    n_rules = patterns.shape[1]
    weight = counts.astype(float)
    cast = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    votes = np.abs(patterns).sum(1)
    good = np.clip(0.5 + 0.4 * patterns.sum(1) / np.maximum(votes, 1), 0.02, 0.98)
    lean = prior * np.array([[0.6, 0.2, 0.2], [0.2, 0.2, 0.6]])
    share, chance = 0.5, np.zeros((2, n_rules, 3))
    for _ in range(rounds):
        by_class = np.stack([1 - good, good]) * weight
        share = (by_class[1].sum() + 1) / (weight.sum() + 2)
        chance = np.einsum("cp,prv->crv", by_class, cast) + lean[:, None, :]
        chance /= chance.sum(2, keepdims=True)
        fresh = posterior(patterns, share, chance)
        if np.abs(fresh - good).max() < 1e-9:
            break
        good = fresh
    return share, chance


def posterior(patterns: np.ndarray, share: float, chance: np.ndarray) -> np.ndarray:
    at = np.arange(patterns.shape[1])
    log = np.log(chance)
    bad = np.log1p(-share) + log[0][at, patterns + 1].sum(1)
    good = np.log(share) + log[1][at, patterns + 1].sum(1)
    return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``measures`` with votes, ``good_probability``, ``base_failed`` and ``kept``.

    At most 3 to the number of rules patterns reach the driver, however many texts there are; their posteriors enter
    the plan as an array of that size.
    """
    made = rules()
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = measures(docs).withColumns({f"vote_{k}": v for k, v in made.items()})
    code = reduce(lambda a, b: a * 3 + b, [F.col(f"vote_{k}") + 1 for k in made], F.lit(0))
    measured = measured.withColumn("pattern", code)
    spark = docs.sparkSession
    with tables.Staging(spark, "quality") as staging:
        measured = staging.put(measured, "measured", keep=True)
    # Texts that fail the base test are settled; the model learns from the others.
    seen = measured.groupBy("pattern").agg(F.count_if(~failed).alias("n")).collect()
    if seen:
        codes = np.array([r["pattern"] for r in seen])
        patterns = np.stack([codes // 3**i % 3 - 1 for i in reversed(range(len(made)))], axis=1)
        share, chance = fit(patterns, np.array([r["n"] for r in seen]))
        found = list(zip(codes.tolist(), posterior(patterns, share, chance).tolist()))
    else:
        found = []
    verdicts = spark.createDataFrame(found, "pattern int, good_probability double")
    return (
        measured.join(F.broadcast(verdicts), "pattern")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("good_probability") >= threshold))
        .drop("pattern")
    )


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    found = quality(tables.table(spark, sf_dir, "documents"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(*first, "good_probability")
