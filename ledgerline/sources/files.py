"""CSV extracts, read by column name and typed strictly; defects in the values are kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerline.errors import IngestError
from ledgerline.schemas import RAW_TABLES, RawTable


def read_csv_table(
    spark: SparkSession, path: str | list[str], table: RawTable, *, multiline: bool = False
) -> DataFrame:
    """One raw table from CSV. Missing columns are an error, extra ones are ignored.

    A file is split between tasks unless `multiline` is set, which quoted line breaks need; without
    it such a record fails the read instead of loading in halves.
    """
    text = (
        spark.read.option("header", True)
        .option("enforceSchema", False)  # every file's header must agree with the first one's
        .option("mode", "FAILFAST")
        .option("columnPruning", False)  # so that a short record is noticed
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    missing = sorted(set(table.columns) - set(text.columns))
    if missing:
        raise IngestError(f"{table.name}: {path} lacks the columns {missing}")
    return text.select(
        *[
            _typed(_verbatim(field.name, table), field, table.name).alias(field.name)
            for field in table.schema.fields
        ]
    )


def read_billing_csv(
    spark: SparkSession, paths: dict[str, str | list[str]], *, multiline: bool = False
) -> dict[str, DataFrame]:
    """All raw tables. Every input is looked up before anything is returned or written."""
    frames, problems = {}, []
    for name, table in RAW_TABLES.items():
        if name not in paths:
            problems.append(f"{name}: no input given")
            continue
        try:
            frames[name] = read_csv_table(spark, paths[name], table, multiline=multiline)
        except AnalysisException as e:
            problems.append(f"{name}: {paths[name]} cannot be read ({e.getCondition()})")
        except IngestError as e:
            problems.append(str(e))
    if problems:
        raise IngestError("; ".join(problems))
    return frames


def _verbatim(name: str, table: RawTable) -> Column:
    """The text as it stands in the file: NULL only for a blank in a column declared so.

    The reader turns every empty field into NULL, so the other columns get their empty string back.
    """
    if name in table.blank_is_null:
        return F.when(~F.col(name).rlike(r"\A\s*\z"), F.col(name))
    return F.coalesce(F.col(name), F.lit(""))


def _typed(value: Column, field: T.StructField, table: str) -> Column:
    """Cast, and fail the load on a value its type cannot hold, whatever the session's ANSI mode."""
    kind = field.dataType
    if isinstance(kind, T.VarcharType):
        fits, result = F.char_length(value) <= kind.length, value
    elif isinstance(kind, T.DateType):
        # A bare cast would also accept '2024' or '2024-05'.
        result = F.when(value.rlike(r"\A\s*\d{4}-\d{1,2}-\d{1,2}\s*\z"), value.try_cast(kind))
        fits = result.isNotNull()
    else:
        result = value.try_cast(kind)
        fits = result.isNotNull()
    complaint = F.concat(
        F.lit(f"{table}.{field.name} does not fit {kind.simpleString()}: '"), value, F.lit("'")
    )
    return F.when(value.isNull(), F.lit(None)).when(fits, result).otherwise(
        F.raise_error(complaint).cast(kind if not isinstance(kind, T.VarcharType) else "string")
    )
