"""Cleaning: exact duplicates, text, missing values, dates, references to the customer master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import strip, title_case
from tidemark.operators.quantiles import exact_quantiles
from tidemark.sources.readers import parse_date
from tidemark.sources.staging import staged


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of rows equal in every column; copies fold together before the shuffle."""
    return df.dropDuplicates()


def normalise_text(df: DataFrame) -> DataFrame:
    """Strip and title-case every text column."""
    return df.select(
        [
            title_case(strip(F.col(f.name))).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def clean_base(df: DataFrame, dates: tuple[str, ...] = ()) -> DataFrame:
    """Duplicates go first, so rows that differ only in case or blanks both stay.

    Dates are parsed before the text is normalised, which leaves that much less text to work on.
    """
    parsed = df.transform(drop_exact_duplicates).withColumns({c: parse_date(c) for c in dates})
    return parsed.transform(normalise_text)


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def fill_median(df: DataFrame, columns: list[str], **quantile_options) -> DataFrame:
    """Fill missing values with the column's exact median. Pass a stored or staged table."""
    medians = exact_quantiles(df, {c: [0.5] for c in columns}, **quantile_options)
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0]).cast("double")) for c in columns}
    )


def upper_key(df: DataFrame, key: str = "CustomerID") -> DataFrame:
    return df.withColumn(key, F.upper(key))


def orphan_keys(child: DataFrame, master: DataFrame, key: str = "CustomerID") -> DataFrame:
    """Distinct keys of ``child`` that the master lacks, staged so that their size is known.

    Only distinct keys are shuffled, never the child's rows, so a key that holds a large part of
    the rows costs one row here.
    """
    known = master.select(F.upper(F.col(key).cast("string")).cast(child.schema[key].dataType).alias(key))
    return staged(child.select(key).distinct().join(known.distinct(), key, "left_anti"), "orphans")


def meet_orphans(rows: DataFrame, orphans: DataFrame, key: str, how: str) -> DataFrame:
    """Join rows to the staged orphan keys, which are unique.

    Spark broadcasts the keys if their size in bytes allows it. If not, adaptive execution splits the partitions that a
    hot key makes large by their measured size, and repeats only that key's one row.
    """
    keys = orphans.select(F.col(key).alias("_orphan"), F.lit(True).alias("_is_orphan"))
    return rows.join(keys, F.col(key).eqNullSafe(F.col("_orphan")), how)


def flag_orphans(child: DataFrame, master: DataFrame, key: str = "CustomerID") -> DataFrame:
    """Add ``CustomerMatchStatus``: Matched when the master has the key, else Orphan."""
    met = meet_orphans(child, orphan_keys(child, master, key), key, "left")
    status = F.when(F.col("_is_orphan"), "Orphan").otherwise("Matched")
    return met.withColumn("CustomerMatchStatus", status).drop("_orphan", "_is_orphan")


def clean_customers(raw: DataFrame) -> DataFrame:
    base = staged(clean_base(raw, ("SignupDate",)), "customers")
    return base.transform(fill_constant, {"Industry": "Unknown"}).transform(fill_median, ["EmployeeCount"])


def clean_subscriptions(raw: DataFrame, customers: DataFrame) -> DataFrame:
    base = staged(clean_base(raw, ("StartDate", "EndDate")).transform(upper_key), "subscriptions")
    return base.transform(fill_median, ["Seats", "MRR"]).transform(flag_orphans, customers)


def clean_usage(raw: DataFrame) -> DataFrame:
    base = staged(clean_base(raw, ("Month",)).transform(upper_key), "usage")
    return base.transform(fill_median, ["ActiveUsers", "SessionMinutes"])


def clean_tickets(raw: DataFrame) -> DataFrame:
    base = staged(clean_base(raw, ("OpenedDate",)).transform(upper_key), "tickets")
    return base.transform(fill_median, ["ResolutionHours", "SatisfactionScore"])


def clean_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Clean the four business tables."""
    customers = clean_customers(raw["customers"])
    return {
        "customers": customers,
        "subscriptions": clean_subscriptions(raw["subscriptions"], customers),
        "usage": clean_usage(raw["usage"]),
        "tickets": clean_tickets(raw["tickets"]),
    }
