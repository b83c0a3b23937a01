"""Scalar expressions: casts that never throw, missing values, clinical normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a decimal number looks like; Java would also take 1.5d, 1f and 0x1p3.
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))$"
#: As NUMBER, with single underscores between digits and nan.
FLOAT_TEXT = r"^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?|(?i:inf(inity)?)|(?i:nan))$"
GENDERS = ("male", "female", "other", "unknown")


def quoted(name: str) -> str:
    """A column's whole name in SQL, dots and all. Wide tables build SQL text: a Column costs several calls to the JVM."""
    return f"`{name.replace('`', '``')}`"


def literal(text: str) -> str:
    """A string literal in SQL."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def col(c: str | Column) -> Column:
    """A column by its whole name, dots and all."""
    return F.col(quoted(c)) if isinstance(c, str) else c


def missing_normalised(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in all floating columns, so that comparisons never see it."""
    return df.select(*(F.when(~F.isnan(col(f.name)), col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else col(f.name) for f in df.schema.fields))


def _finite_text(text: Column) -> Column:
    """Java's words for infinity."""
    return F.regexp_replace(text, r"(?i)inf(inity)?$", "Infinity")


def to_number(c: str | Column, kind: T.DataType | None = None) -> Column:
    """Number or NULL: text that isn't a number, and NaN, are NULL. Numeric columns pass as doubles."""
    c = col(c)
    if kind is not None and isinstance(kind, T.NumericType):
        number = c.cast("double")
    elif kind is not None and isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    else:
        text = F.trim(c.cast("string"))
        number = F.when(text.rlike(NUMBER), _finite_text(text).try_cast("double"))
    return F.when(~F.isnan(number), number)


def parsed_float(c: str | Column) -> Column:
    """As strict text parsing does it: underscores between digits, inf and nan are numbers, else NULL."""
    text = F.regexp_replace(col(c).cast("string"), r"^\s+|\s+$", "")
    plain = _finite_text(F.regexp_replace(F.regexp_replace(text, "_", ""), r"(?i)^[+-]?nan$", "NaN"))
    return F.when(text.rlike(FLOAT_TEXT), plain.try_cast("double"))


def normalised_gender(c: str | Column, aliases: dict[str, str] | None = None) -> Column:
    """One of GENDERS; NULL and whatever else is found are `unknown`. `aliases` may map codes such as m."""
    text = F.lower(F.trim(col(c).cast("string")))
    for code, gender in (aliases or {}).items():
        text = F.when(text == code.lower(), F.lit(gender)).otherwise(text)
    return F.when(text.isin(*GENDERS), text).otherwise(F.lit("unknown"))


def percent_change(current: Column, previous: Column) -> Column:
    """Absolute change in percent of the previous value; NULL after zero, and where it is not a number."""
    change = F.abs((current - previous) / F.nullif(previous, F.lit(0.0))) * 100
    return F.when(~F.isnan(change), change)


def outside(value: Column, low: float, high: float) -> Column:
    """True outside the closed range, false within and for NULL."""
    return F.coalesce((value < low) | (value > high), F.lit(False))


def age_years(birth: str | Column, today: Column | None = None) -> Column:
    """Whole years since birth; the birthday itself counts, 29 February turns on 1 March."""
    birth, today = col(birth), F.current_date() if today is None else today
    before = F.struct(F.month(today).alias("m"), F.dayofmonth(today).alias("d")) < F.struct(F.month(birth).alias("m"), F.dayofmonth(birth).alias("d"))
    return F.year(today) - F.year(birth) - before.cast("int")


def parsed_birth_date(c: str | Column, kind: T.DataType | None = None) -> Column:
    """A date or NULL: ISO dates, alone or at midnight, and epochs (seconds or milliseconds) at midnight."""
    c = col(c)
    if isinstance(kind, T.DateType):
        return c
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.when(F.date_trunc("day", c) == c, c.cast("date"))
    text = c.cast("string")
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]00:00(:00)?Z?)?$"), F.substring(text, 1, 10).try_cast("date"))
    number = F.when(text.rlike(r"^[+-]?\d{1,15}(\.0*)?$"), text.try_cast("double"))
    seconds = F.when(F.abs(number) > 2e10, number / 1000).otherwise(number)
    epoch = F.when(seconds % 86400 == 0, F.date_add(F.lit("1970-01-01").cast("date"), (seconds / 86400).cast("int")))
    return F.coalesce(iso, epoch)


def status_bucket(percent: Column) -> Column:
    return F.when(percent > 30, F.lit("HIGH")).when(percent > 10, F.lit("MODERATE")).otherwise(F.lit("LOW"))
