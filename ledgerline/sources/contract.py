"""Hold any source to the billing contract: columns by name, with the types raw is kept in."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.errors import IngestError
from ledgerline.schemas import RawTable


def conform(source: DataFrame, table: RawTable) -> DataFrame:
    """The contract's columns. Another type is an error here, a text too long one when it is read.

    Values are never converted: a source that holds amounts as doubles or dates as text has lost
    something already, or is not the table it claims to be.
    """
    found = dict(source.dtypes)
    problems, columns = [], []
    for field in table.schema.fields:
        text = isinstance(field.dataType, T.VarcharType)
        wanted = "string" if text else field.dataType.simpleString()
        if field.name not in found:
            problems.append(f"{field.name} is missing")
        elif found[field.name] != wanted:
            problems.append(f"{field.name} is {found[field.name]} and not {wanted}")
        elif text:
            value = F.col(field.name)
            complaint = F.concat(
                F.lit(f"{table.name}.{field.name} is longer than {field.dataType.length}: "), value
            )
            short = value.isNull() | (F.char_length(value) <= field.dataType.length)
            columns.append(
                F.when(short, value)
                .otherwise(F.raise_error(complaint).cast("string"))
                .alias(field.name)
            )
        else:
            columns.append(F.col(field.name))
    if problems:
        raise IngestError(f"{table.name}: " + ", ".join(problems))
    return source.select(*columns)
