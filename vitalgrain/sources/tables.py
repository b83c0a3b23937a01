"""Readers: CSV with missing-value tokens and type inference, Parquet, dense row numbers."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import NUMBER, col, literal, missing_normalised, quoted
from . import csvrecords
from .scratch import written

# fixed values: texts that count as missing, matched exactly
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
ROW_ID = "row_id"
_CORRUPT = "__corrupt"
#: Lines that a header with quoted line breaks may have.
HEADER_LINES = 1000


def _header(names: list[str]) -> list[str]:
    """Repeated names get .1, .2 and so on; nameless ones their position."""
    out: list[str] = []
    for i, name in enumerate(names):
        base = name or f"Unnamed: {i}"
        unique, n = base, 0
        while unique in out:
            n += 1
            unique = f"{base}.{n}"
        out.append(unique)
    return out


@dataclass(frozen=True)
class CsvText:
    """A CSV file whose header is known, with its first records in `head`.

    `ranges`: how the file's ranges begin and end, where lines alone don't tell the records.
    """

    spark: SparkSession
    path: str
    names: tuple[str, ...]
    tokens: tuple[str, ...]
    ranges: list[csvrecords.Range] | None
    head: list[list[str]]

    @classmethod
    def of(cls, spark: SparkSession, path: str, na_tokens: tuple[str, ...] = NA_TOKENS, placeholders: tuple[str, ...] = ()) -> CsvText:
        try:
            plain = spark.read.text(path).where(~csvrecords.plain_line()).isEmpty()
            head = csvrecords.head_of(spark, path, HEADER_LINES)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                raise FileNotFoundError(path) from e
            raise
        if not head:
            raise ValueError(f"no data in {path}")
        return cls(spark, path, tuple(_header(head[0])), (*na_tokens, *placeholders), None if plain else csvrecords.ranges_of(spark, path), head[1:])

    def likely_numbers(self) -> list[str]:
        """The columns whose first values are numbers: a guess, to be checked by their kinds."""
        out = []
        for i, name in enumerate(self.names):
            some = [r[i].strip() for r in self.head if i < len(r) and r[i] not in self.tokens]
            if some and all(re.match(NUMBER, v) for v in some):
                out.append(name)
        return out

    def rows(self, checked: bool = True, numbered: bool = False) -> DataFrame:
        """All columns as text, missing tokens as NULL; `checked` fails on a row with more fields than the header.

        Files are split between tasks. Lines whose quotes the JVM's reader understands are parsed by it, and
        where they need no check only as far as the columns that are asked for; a file with other lines is
        cut into records by `csvrecords`. `numbered` adds row numbers in the order of paths and places.
        """
        rows = self._lines(checked) if self.ranges is None else self._records(checked)
        tokens = ", ".join(map(literal, self.tokens))
        # a column of that name gives way
        names = {i: n for i, n in enumerate(self.names) if not (numbered and n == ROW_ID)}
        cells = [f"case when c{i} not in ({tokens}) then c{i} end as {quoted(n)}" for i, n in names.items()]
        if not numbered:
            return rows.selectExpr(*cells)
        return with_row_id(rows.selectExpr(*cells)) if self.ranges is None else rows.selectExpr(*cells, f"__id as {ROW_ID}")

    def _lines(self, checked: bool) -> DataFrame:
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(self.names))]
        schema = T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())] if checked else fields)
        rows = self.spark.read.schema(schema).options(header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, quote='"', escape='"', emptyValue="", nullValue="").csv(self.path)
        if checked:
            too_long = F.col(_CORRUPT).isNotNull() & (csvrecords.count_fields(_CORRUPT) > len(self.names))
            # names a data column too: Spark refuses to read the corrupt records alone
            rows = rows.where(_refused(too_long, F.coalesce(_CORRUPT, "c0")))
        return rows

    def _records(self, checked: bool) -> DataFrame:
        before, total = [], 0
        for r in self.ranges:
            before.append((r.path, r.start, total))
            total += r.records
        rows = csvrecords.records(self.spark, self.path, self.ranges)
        if checked:
            rows = rows.where(_refused(F.size("fields") > len(self.names), F.array_join("fields", ",")))
        offsets = F.broadcast(self.spark.createDataFrame(before, "path string, start long, before long"))
        cells = (F.get("fields", F.lit(i)).alias(f"c{i}") for i in range(len(self.names)))
        return rows.join(offsets, ["path", "start"]).select((F.col("before") + F.col("seq")).alias("__id"), *cells)


def _refused(too_long: Column, record: Column) -> Column:
    """A filter that fails on a record that is too long; pruning can't remove a filter."""
    message = F.concat(F.lit("a row has more fields than the header: "), F.substring(record, 1, 200))
    return F.when(too_long, F.raise_error(message).cast("boolean")).otherwise(True)


def read_csv_text(spark: SparkSession, path: str, na_tokens: tuple[str, ...] = NA_TOKENS, placeholders: tuple[str, ...] = ()) -> DataFrame:
    """All columns as text, missing tokens as NULL. A row with more fields than the header is an error, a shorter one is filled up."""
    return CsvText.of(spark, path, na_tokens, placeholders).rows()


_LONG, _WIDE, _DOUBLE, _BOOLEAN, _TEXT = 1, 2, 4, 8, 16
_KINDS = "__kinds"


def _kind(v: Column) -> Column:
    """Which of the types, as a bit, is the narrowest that holds a value; 0 for none.

    A cast is tried only on what looks like a number, as one that fails costs an exception.
    """
    digits = F.when(F.length(v) <= 18, _LONG).when(v.try_cast("bigint").isNotNull(), _LONG).when(v.try_cast("decimal(20,0)").isNotNull(), _WIDE).otherwise(_DOUBLE)
    number = F.when(v.rlike(r"^[+-]?\d+$"), digits).when(v.rlike(NUMBER), _DOUBLE).otherwise(_TEXT)
    boolean = F.when(v.isin("True", "TRUE", "true", "False", "FALSE", "false"), _BOOLEAN).otherwise(_TEXT)
    return F.when(v.isNull(), 0).when(F.substring(v, 1, 1).isin(*"+-.0123456789iI"), number).otherwise(boolean)


def number_text(text: DataFrame, name: str) -> str:
    """SQL value of a text column where measured_kinds finds a number, else NULL."""
    return f"(case when ({_KINDS}[{text.columns.index(name)}] & {_LONG | _WIDE | _DOUBLE}) <> 0 then cast(trim({quoted(name)}) as double) end)"


def measured_kinds(text: DataFrame, measures: list[str]) -> tuple[int, list[int], list]:
    """Rows, the types that each text column's values need, as bits, and the given SQL aggregates, from one scan. ValueError if there are no rows."""
    trimmed = F.expr(f"array({', '.join(f'trim({quoted(n)})' for n in text.columns)})")
    kinds = text.select("*", F.transform(trimmed, _kind).alias(_KINDS))
    n = len(text.columns)
    found = kinds.agg(F.count(F.lit(1)), *(F.expr(f"bit_or({_KINDS}[{i}])") for i in range(n)), *map(F.expr, measures)).first()
    if not found[0]:
        raise ValueError("no rows")
    return found[0], list(found[1 : n + 1]), list(found[n + 1 :])


def value_kinds(text: DataFrame) -> list[int]:
    """The types that each text column's values need, as bits, from one aggregate over all columns. ValueError if there are no rows."""
    return measured_kinds(text, [])[1]


def cast_to_kinds(text: DataFrame, kinds: list[int]) -> DataFrame:
    """Casts each text column to the narrowest of long, wide integer, double and boolean that holds all its kinds.

    Dates stay text; a column without any value is double; columns beyond those of `kinds` stay.
    """
    out = []
    for name, kind in zip(text.columns, kinds):
        c = quoted(name)
        v = f"trim({c})"
        if not kind:
            cast = "cast(null as double)"
        elif kind == _LONG:
            cast = f"cast({v} as bigint)"
        elif kind & ~(_LONG | _WIDE) == 0:
            cast = f"cast({v} as decimal(20,0))"
        elif kind & ~(_LONG | _WIDE | _DOUBLE) == 0:
            cast = f"cast(regexp_replace({v}, '(?i)inf(inity)?$', 'Infinity') as double)"
        elif kind == _BOOLEAN:
            cast = f"cast(lower({v}) as boolean)"
        else:
            cast = c
        out.append(f"{cast} as {c}")
    return text.selectExpr(*out, *map(quoted, text.columns[len(kinds) :]))


def infer_types(text: DataFrame) -> DataFrame:
    """The table with its text columns cast to what their values are."""
    return cast_to_kinds(text, value_kinds(text))


def read_csv(spark: SparkSession, path: str, na_tokens: tuple[str, ...] = NA_TOKENS, placeholders: tuple[str, ...] = (), row_ids: bool = False) -> DataFrame:
    """A typed table. FileNotFoundError if the path is absent, ValueError if it can't be parsed or has no rows.

    The scan that finds the types also checks every row's length, so later scans need not.
    """
    text = CsvText.of(spark, path, na_tokens, placeholders)
    return typed(text, parsed(text)[1], row_ids)


def parsed(text: CsvText, measures: Callable[[DataFrame], list[str]] = lambda rows: []) -> tuple[int, list[int], list]:
    """The first scan of a CSV file: measured_kinds, and every row's length is checked. ValueError if it can't be parsed or has no rows."""
    rows = text.rows()
    try:
        return measured_kinds(rows, measures(rows))
    except ValueError as e:
        raise ValueError(f"{e} in {text.path}") from e
    except Exception as e:
        raise ValueError(f"can't parse {text.path}: {e}") from e


def typed(text: CsvText, kinds: list[int], row_ids: bool = False) -> DataFrame:
    """The table with the types that the first scan has found."""
    rows = text.rows(checked=False, numbered=row_ids)
    by_name = dict(zip(text.names, kinds))
    return cast_to_kinds(rows, [by_name[n] for n in text.names if n in rows.columns and not (row_ids and n == ROW_ID)])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, NaN as NULL."""
    try:
        return missing_normalised(spark.read.parquet(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise


def is_parquet(path: str) -> bool:
    return path.rstrip("/").endswith(".parquet")


def read_table(spark: SparkSession, path: str, row_ids: bool = False) -> DataFrame:
    """Parquet by its suffix, else CSV."""
    if is_parquet(path):
        table = read_parquet(spark, path)
        return with_row_id(table) if row_ids else table
    return read_csv(spark, path, row_ids=row_ids)


def ingest(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The table and its number of rows."""
    df = read_table(spark, path)
    return df, df.count()


def _is_scan(df: DataFrame) -> bool:
    """Whether the plan only reads, filters and projects, so that its partitions are the same each time it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    nodes = re.findall(r"^[\s:+\-*()\d]*([A-Za-z]+)", plan, re.MULTILINE)
    return set(nodes) <= {"Project", "Filter", "ColumnarToRow", "FileScan"} and nodes.count("FileScan") == 1


def with_row_id(df: DataFrame, name: str = ROW_ID) -> DataFrame:
    """Adds row numbers from 0, dense, in the order of the files' paths and of the rows in them.

    Counts by file range, one row each, give the offsets; the rows themselves don't move. What is
    more than a scan may be dealt otherwise when it runs again, so it is written first, and numbered in
    the order of its partitions.
    """
    at, path, start, before, first = (_unused(n, [*df.columns, name]) for n in ("at", "path", "start", "before", "first"))
    scan = _is_scan(df)
    if scan:
        try:
            file = df.metadataColumn("_metadata")
            tagged = df.select("*", F.monotonically_increasing_id().alias(at), file["file_path"].alias(path), file["file_block_start"].alias(start))
        except AnalysisException:  # a scan of something else than files
            scan = False
    if not scan:
        tagged = written(df.withColumn(at, F.monotonically_increasing_id()), "tagged")
        tagged = tagged.select("*", F.lit("").alias(path), F.shiftright(at, 33).alias(start))
    # a task may read several ranges, one after the other
    ranges = tagged.groupBy(path, start).agg(F.count("*").alias("n"), F.min(at).alias(first)).collect()
    total, rows = 0, []
    for r in sorted(ranges, key=lambda r: (r[path], r[start])):
        rows.append((r[path], r[start], r[first], total))
        total += r["n"]
    offsets = df.sparkSession.createDataFrame(rows, f"{path} string, {start} long, {first} long, {before} long")
    numbered = tagged.join(F.broadcast(offsets), [path, start])
    return numbered.select(*(col(c) for c in df.columns if c != name), (F.col(before) + F.col(at) - F.col(first)).alias(name))


def _unused(stem: str, taken: list[str]) -> str:
    name = f"__{stem}"
    while name in taken:
        name = f"_{name}"
    return name
