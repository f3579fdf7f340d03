"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact shingle containment.

An item is inside a document if at least ``threshold`` of its distinct shingles are among the document's. Items are
parted by size; in each part an item is known by its k smallest shingle hashes, k being one more than the number of
shingles that an item of the part's largest size may miss. A document that holds the item therefore holds one of the
k, however long it is, so the search loses nothing; what it finds is verified on the shingle strings.

Only DataFrame expressions run here. Words are in lower case; a text with fewer words than a shingle is one shingle.

Input cases: null and word-free texts hold nothing and are in nothing; rows with one id (null counts as an id) are one
document or item with the shingles of all of them; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tables

SHINGLE = 5
THRESHOLD = 0.8


def windows(rows: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``id`` and ``text`` to one row per window: ``id``, ``words`` of the text and ``at`` (from 0)."""
    trimmed = F.expr("btrim(lower(text), concat(' ', char(9), char(10), char(11), char(12), char(13)))")
    words = rows.select("id", trimmed.alias("text")).filter("text <> ''")
    words = words.select("id", F.split("text", r"[\x20\x09-\x0D]+").alias("words"))
    last = F.greatest(F.size("words") - width, F.lit(0))
    return words.select("*", F.explode(F.sequence(F.lit(0), last)).alias("at"))


def _parts(width: int) -> list[Column]:
    return [F.get("words", F.col("at") + i) for i in range(width)]


def _hashed(rows: DataFrame, width: int) -> DataFrame:
    return windows(rows, width).select("id", F.xxhash64(*_parts(width)).alias("hash"))


def _strings(rows: DataFrame, width: int) -> DataFrame:
    return windows(rows, width).select("id", F.concat_ws(" ", *_parts(width)).alias("shingle"))


def _needed(n: Column, threshold: float) -> Column:
    """Shingles that a document must hold of an item with ``n``; the small constant undoes binary fractions."""
    return F.ceil(n * F.lit(threshold) - 1e-9)


def sketches(items: DataFrame, width: int, threshold: float) -> DataFrame:
    """``hash`` and ``item`` for the smallest hashes of each item, as many as its size part asks for."""
    hashed = _hashed(items, width).select("id", "hash").distinct()
    grouped = hashed.groupBy("id").agg(F.array_sort(F.collect_list("hash")).alias("hashes"))
    n = F.size("hashes")
    largest = F.pow(F.lit(2.0), F.ceil(F.log2(n)))  # of the part: sizes up to a power of two
    keep = F.least(n, F.floor(largest - _needed(largest, threshold) + 1).cast("int"))
    return grouped.select(
        F.explode(F.slice("hashes", F.lit(1), keep)).alias("hash"),
        F.col("id").alias("item"),
    )


def contaminated(
    docs: DataFrame, items: DataFrame, width: int = SHINGLE, threshold: float = THRESHOLD
) -> DataFrame:
    """Pairs ``doc_id``, ``item_id`` with ``n_shingles`` of the item and ``n_found`` of them in the document."""
    return _pairs(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), items, width, threshold)


def _pairs(docs: DataFrame, items: DataFrame, width: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """The same for documents that are known by an ``id`` of any type, a struct too."""
    docs = docs.select("id", F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    with tables.Staging(docs.sparkSession, "decontaminate") as staging:
        sketch = staging.put(sketches(items, width, threshold), "sketches", keep=True)
        hits = _hashed(docs, width).join(sketch, "hash").select("id", "item").distinct()
        candidates = staging.put(hits, "candidates", keep=True)
        owners = candidates.select(F.col("id").alias("doc")).distinct()
        texts = docs.join(owners, docs["id"].eqNullSafe(owners["doc"]), "left_semi")
        held = _strings(items, width).distinct().select(F.col("id").alias("item"), "shingle")
        found = _strings(texts, width).join(held, "shingle")
        keys = candidates.select(F.col("id").alias("doc"), F.col("item").alias("test"))
        found = found.join(keys, found["id"].eqNullSafe(keys["doc"]) & found["item"].eqNullSafe(keys["test"]))
        found = found.groupBy("id", "item").agg(F.count_distinct("shingle").alias("n_found"))
        found = staging.put(found, "found", keep=True)
        sizes = held.groupBy(F.col("item").alias("of")).agg(F.count("*").alias("n_shingles"))
    met = found.join(sizes, found["item"].eqNullSafe(sizes["of"]))
    met = met.filter(F.col("n_found") >= _needed(F.col("n_shingles"), threshold))
    return met.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_shingles", "n_found")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(tables.table(spark, sf_dir, "documents"), tables.table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM texts WHERE text IS NOT NULL
), shingles AS (
  SELECT DISTINCT kind, id,
    unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM words WHERE len(w) > 0
), sizes AS (
  SELECT id, count(*) AS n_shingles FROM shingles WHERE kind = 'b' GROUP BY id
), found AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_found
  FROM shingles d JOIN shingles b ON d.kind = 'd' AND b.kind = 'b' AND d.g = b.g GROUP BY d.id, b.id
)
SELECT f.doc_id, f.item_id, s.n_shingles, f.n_found
FROM found f JOIN sizes s ON f.item_id IS NOT DISTINCT FROM s.id
WHERE 10 * f.n_found >= 8 * s.n_shingles
"""


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go. Here rows are one document only if id and text are the
    same, so a row stays whatever others with its id, or without one, hold."""
    keyed = docs.withColumn("_key", F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("mark")))
    found = _pairs(keyed.select(F.col("_key").alias("id"), "text"), tables.table(spark, sf_dir, "benchmark"))
    bad = found.select(F.col("doc_id").alias("_bad")).distinct()
    return keyed.join(bad, F.col("_key") == F.col("_bad"), "left_anti").drop("_key")
