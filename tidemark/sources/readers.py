"""Checked table loading and text parsing."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import BUSINESS, raw_schema
from tidemark.sources.csv_ranges import read_records
from tidemark.sources.staging import staged

# Text that a CSV reader takes as a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def missing_to_null(df: DataFrame) -> DataFrame:
    """Missing-value tokens in text and NaN in floating columns become NULL."""

    def convert(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.when(~column.isin(*MISSING_TOKENS), column).alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(column), column).alias(field.name)
        return column

    return df.select([convert(f) for f in df.schema.fields])


def _typed(field: T.StructField) -> Column:
    """Text of a CSV column as the field's type; text that is no such value raises."""
    column = F.col(f"`{field.name}`")
    present = F.when(~column.isin(*MISSING_TOKENS), column)
    if isinstance(field.dataType, T.StringType):
        return present.alias(field.name)
    value = present.try_cast(field.dataType)
    message = F.concat(F.lit(f"{field.name}: not a {field.dataType.simpleString()}: "), present)
    wrong = present.isNotNull() & value.isNull()
    return F.when(wrong, F.raise_error(message).cast(field.dataType)).otherwise(value).alias(field.name)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV file or folder with a header, quotes doubled inside quoted text.

    With a schema, columns are taken by their names in the header, in any order; a missing column is an error, columns
    that the schema lacks are left out, and text that is no value of its column's type raises. All files of a folder
    must have the header of the first. Without a schema the types are inferred (an extra pass, one task per file).
    Quoted text may hold line breaks; large files are read side by side all the same, after a scan that counts quotes.
    ``multi_line=False`` gives line breaks up and saves that scan.
    """
    if schema is None:
        reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
        return missing_to_null(reader.option("inferSchema", True).csv(path))
    return read_text(spark, path, schema, multi_line).select([_typed(f) for f in schema.fields])


def read_text(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """The columns of a CSV file or folder as text, with all that the schema names."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    found = reader.csv(path).columns
    absent = [f.name for f in schema.fields if f.name not in found]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    text = T.StructType([T.StructField(name, T.StringType()) for name in found])
    if not multi_line:
        return reader.schema(text).option("enforceSchema", False).csv(path)
    record = F.col("record")
    record = F.when(record.endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(record)
    record = F.when(F.col("first"), F.replace(record, F.lit("\ufeff"), F.lit(""))).otherwise(record)
    rows = read_records(spark, path).select("first", record.alias("record")).filter("record != ''")
    columns = ", ".join(f"`{name.replace('`', '``')}` string" for name in found)
    rows = rows.select("first", F.from_csv("record", columns, {"escape": '"', "maxCharsPerColumn": "-1"}).alias("row"))
    other = F.concat(F.lit(f"{path}: a file with another header: "), F.to_json("row"))
    named = F.to_json("row") == F.to_json(F.struct(*[F.lit(name).alias(name) for name in found]))
    rows = rows.filter(F.when(F.col("first") & ~named, F.raise_error(other).cast("boolean")).otherwise(~F.col("first")))
    return rows.select("row.*")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL, whatever the format it came from."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


@dataclass
class Loaded:
    """Rows that fit their schema, the text of those that do not with the reasons, and how many there are of both."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def split_rejects(text: DataFrame, schema: T.StructType, reasons: str = "Reasons") -> Loaded:
    """Part rows of text columns by whether every value is one of its column's type (dates ISO, missing allowed).

    One pass reads the rows and writes both sides, each to a folder of its own; the counts are observed on the way.
    """
    fields, wrong = [], []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        present = F.when(~column.isin(*MISSING_TOKENS), column)
        value = present if isinstance(field.dataType, T.StringType) else present.try_cast(field.dataType)
        fields.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            kind = F.lit(f"{field.name}: not a {field.dataType.simpleString()}")
            wrong.append(F.when(present.isNotNull() & value.isNull(), kind))
    found = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    marked = text.select(F.struct(*fields).alias("row"), F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]).alias("text"), found.alias("reasons"))
    bad = F.size("reasons") > 0
    marked = marked.select(
        bad.alias("rejected"), F.when(~bad, F.col("row")).alias("row"), F.when(bad, F.col("text")).alias("text"), "reasons"
    )
    seen = Observation()
    marked = marked.observe(
        seen, F.count_if(~F.col("rejected")).alias("accepted"), F.count_if("rejected").alias("rejected")
    )
    both = staged(marked, "load", partition_by=["rejected"])
    return Loaded(
        both.filter("NOT rejected").select("row.*"),
        both.filter("rejected").select("text.*", F.array_join("reasons", "; ").alias(reasons)),
        dict(seen.get),
    )


def load_with_rejects(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> Loaded:
    """Read a CSV table; rows with a value that is none of its column's type are set aside instead of ending the load."""
    return split_rejects(read_text(spark, path, schema, multi_line), schema)


def load_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "csv", multi_line: bool = True
) -> DataFrame:
    """Read one table; a missing path or an empty table is an error."""
    try:
        if fmt == "csv":
            df = read_csv(spark, path, schema, multi_line)
        else:
            reader = spark.read.format(fmt)
            df = nan_to_null((reader.schema(schema) if schema is not None else reader).load(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{path} not found") from error
        raise
    if df.isEmpty():
        raise ValueError(f"{path} is empty")
    return df


def load_tables(
    spark: SparkSession, paths: dict[str, str], fmt: str = "csv", raw: bool = True, multi_line: bool = True
) -> dict[str, DataFrame]:
    """Load named business tables, each checked. ``raw`` keeps dates as text for the cleaning step."""
    return {
        name: load_table(spark, path, raw_schema(name) if raw else BUSINESS[name], fmt, multi_line)
        for name, path in paths.items()
    }


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a by-product of whatever action runs next, without a job of its own."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: name, rows, columns."""
    parts: Iterable[DataFrame] = (
        df.agg(F.count(F.lit(1)).alias("Rows")).select(
            F.lit(name).alias("TableName"), "Rows", F.lit(len(df.columns)).cast("long").alias("Columns")
        )
        for name, df in tables.items()
    )
    result = None
    for part in parts:
        result = part if result is None else result.unionByName(part)
    return result


def parse_date(column: Column | str) -> Column:
    """Strict date parse: text that is not a date raises, whatever the session's ANSI setting."""
    column = F.col(column) if isinstance(column, str) else column
    parsed = try_parse_date(column)
    message = F.concat(F.lit("not a date: "), column.cast("string"))
    return F.when(column.isNotNull() & parsed.isNull(), F.raise_error(message).cast("date")).otherwise(parsed)


def try_parse_date(column: Column | str) -> Column:
    """Lenient date parse: text that is not a date becomes NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("date")


def try_parse_number(column: Column | str) -> Column:
    """Lenient number parse: blanks and text that is not a number become 0."""
    column = F.col(column) if isinstance(column, str) else column
    number = column.try_cast("double")
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(0.0))
