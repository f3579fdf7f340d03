"""Running sums over a whole table, or within its groups, without a task that sees a whole group.

Rows are range partitioned by group and order and written once with their partition number. A window sums inside each
partition; the totals of earlier partitions, one row per partition and group that it ends, are added to the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import PART, range_parts
from tidemark.sources.staging import staged


def running_sums(
    df: DataFrame, group: list[str], order: list[str], sums: dict[str, str], partitions: int | None = None
) -> DataFrame:
    """Add for each ``output: column`` the sum of the column over the rows of the group up to this one.

    ``group`` and ``order`` together should tell rows apart; rows that they do not are summed in any order. A group may
    lie in any number of partitions, and a partition may hold any number of groups.
    """
    ordered = range_parts(df, *[F.col(c) for c in [*group, *order]], partitions=partitions)
    inside = Window.partitionBy(PART, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ordered.withColumns({f"_local_{i}": F.sum(c).over(inside) for i, c in enumerate(sums.values())})
    before = parts_before(ordered, group, sums)
    met = F.col(f"r.{PART}").eqNullSafe(F.col(f"b.{PART}"))
    for c in group:
        met = met & F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = local.alias("r").join(before.alias("b"), met, "left")
    totals = [
        (F.coalesce(F.col(f"r._local_{i}"), F.lit(0)) + F.coalesce(F.col(f"b._before_{i}"), F.lit(0))).alias(output)
        for i, output in enumerate(sums)
    ]
    return joined.select(*[F.col(f"r.`{c}`") for c in df.columns], *totals)


def parts_before(ordered: DataFrame, group: list[str], sums: dict[str, str]) -> DataFrame:
    """Per partition and group that earlier partitions hold too: the sums of the group in those.

    A group can reach over the end of a partition only if it is the first or the last one there, so this looks at two
    groups of each partition.
    """
    key = F.struct(*group) if group else F.struct(F.lit(0))
    edges = ordered.groupBy(PART).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    edges = edges.select(F.col(PART).alias("_edge_part"), F.explode(F.array_distinct(F.array("first", "last"))).alias("_edge"))
    at_edge = (F.col(PART) == F.col("_edge_part")) & key.eqNullSafe(F.col("_edge"))
    totals = (
        ordered.join(F.broadcast(staged(edges, "edges")), at_edge)  # two rows per partition at most
        .groupBy(PART, *group)
        .agg(*[F.sum(c).alias(f"_total_{i}") for i, c in enumerate(sums.values())])
    )
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = [F.sum(f"_total_{i}").over(earlier).alias(f"_before_{i}") for i in range(len(sums))]
    known = " OR ".join(f"_before_{i} IS NOT NULL" for i in range(len(sums)))
    return staged(totals.select(PART, *group, *before).filter(known), "before")
