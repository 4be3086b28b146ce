"""Casts that abort on bad input, whatever the session's ANSI setting is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schema import FILE_COLUMNS, ORDERS


ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def strict_cast(value: Column, to: T.DataType, label: str) -> Column:
    """NULL stays NULL; text that is not of the type fails the job."""
    if isinstance(to, T.StringType):
        return value.cast(to)
    typed = value.try_cast(to)
    if isinstance(to, T.DateType):
        # The cast alone also takes a year, a month or a date with something behind it.
        typed = F.when(value.rlike(ISO_DATE), typed)
    complaint = F.concat(F.lit("cannot read '"), value, F.lit(f"' as {to.simpleString()} in column {label}"))
    return F.when(value.isNull() | typed.isNotNull(), typed).otherwise(F.raise_error(complaint).cast(to))


def strict_sql(text: str, to: T.DataType, label: str) -> str:
    """The same as SQL over a text expression, for views."""
    if isinstance(to, T.StringType):
        return text
    kind = to.simpleString()
    fits = f"try_cast({text} AS {kind}) IS NOT NULL"
    if isinstance(to, T.DateType):
        fits = f"{text} RLIKE '{ISO_DATE}' AND {fits}"
    complaint = f"concat('cannot read ', {text}, ' as {kind} in column {label}')"
    return (
        f"CASE WHEN {text} IS NULL THEN NULL WHEN {fits} THEN try_cast({text} AS {kind}) "
        f"ELSE cast(raise_error({complaint}) AS {kind}) END"
    )


def typed_order_columns(ordinals: list[Column]) -> list[Column]:
    """Text ordinals in file order -> the typed columns of the order row."""
    return [
        strict_cast(value, ORDERS[name].dataType, name).alias(name)
        for name, value in zip(FILE_COLUMNS, ordinals, strict=True)
    ]
