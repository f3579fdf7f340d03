"""What changed between two runs of a table, with multiplicity, without shuffling what did not.

Each side is folded into a few numbers per key range: rows, and two sums of row hashes that do not depend on order. Only
ranges whose numbers differ are compared row by row, so two runs that are mostly equal cost one scan each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.staging import staged

ADDED, REMOVED, CHANGED_FROM, CHANGED_TO = "added", "removed", "changed from", "changed to"
#: Ranges if no expression names them: keys by hash.
RANGES = 65_536


def fingerprints(df: DataFrame, ranges: Column, columns: list[str]) -> DataFrame:
    """Rows of each range and two order-free sums of their hashes (two seeds; a missing value has its own place)."""
    row = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns])
    first, second = F.xxhash64(row), F.xxhash64(F.lit("second"), row)
    wide = [F.sum(h.cast("decimal(38,0)")) for h in (first, second)]
    return df.groupBy(ranges.alias("_range")).agg(
        F.count(F.lit(1)).alias("_rows"), wide[0].alias("_first"), wide[1].alias("_second")
    )


def differing_ranges(before: DataFrame, after: DataFrame, ranges: Column, columns: list[str]) -> DataFrame:
    """Ranges that do not hold the same rows on both sides (equal sums of two 64-bit hashes count as the same)."""
    sides = [fingerprints(df, ranges, columns).withColumn("_sign", F.lit(sign)) for df, sign in ((before, 1), (after, -1))]
    both = sides[0].unionByName(sides[1]).groupBy("_range")
    off = [F.sum(F.col(c) * F.col("_sign")).alias(c) for c in ("_rows", "_first", "_second")]
    return both.agg(*off).filter("_rows <> 0 OR _first <> 0 OR _second <> 0").select("_range")


def table_difference(before: DataFrame, after: DataFrame, key: str, ranges: Column | None = None) -> DataFrame:
    """Rows that only one run has, as often as it has more of them (``Copies``), and what happened (``Change``).

    A key that has rows in both differences was changed: its rows of the first run are "changed from", those of the
    second "changed to". ``ranges`` is an expression of the key whose values are key ranges, say blocks of numbers; a
    difference in few ranges then leaves most rows where they are. Missing keys and values compare as equal values.
    """
    columns = before.columns
    if sorted(columns) != sorted(after.columns):
        raise ValueError(f"the runs have different columns: {columns}, {after.columns}")
    after = after.select(*columns)
    ranges = ranges if ranges is not None else F.pmod(F.xxhash64(key), F.lit(RANGES))
    differing = staged(differing_ranges(before, after, ranges, columns), "ranges")

    def met(df: DataFrame, sign: int) -> DataFrame:
        rows = df.withColumns({"_range": ranges, "_sign": F.lit(sign)})
        other = differing.withColumnRenamed("_range", "_other")
        return rows.join(other, F.col("_range").eqNullSafe(F.col("_other")), "left_semi")

    both = met(before, 1).unionByName(met(after, -1))
    more = both.groupBy(*columns).agg(F.sum("_sign").alias("_more")).filter("_more <> 0")
    more = staged(more, "difference")
    sides = more.groupBy(F.col(key).alias("_key")).agg(
        (F.max("_more") > 0).alias("_was"), (F.min("_more") < 0).alias("_is")
    )
    changed = F.col("_was") & F.col("_is")
    change = F.when(F.col("_more") > 0, F.when(changed, CHANGED_FROM).otherwise(REMOVED)).otherwise(
        F.when(changed, CHANGED_TO).otherwise(ADDED)
    )
    return more.join(sides, F.col(key).eqNullSafe(F.col("_key"))).select(
        *columns, change.alias("Change"), F.abs("_more").cast("long").alias("Copies")
    )
