"""Profiles: overview, missing values, numeric and categorical summaries. Results are long tables in a fixed order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import literal, quoted, status_bucket

QUARTILES = (0.25, 0.5, 0.75)
#: Bins of a column's histogram.
BINS = 4096
#: Accuracy of the sketches that bracket a rank: 1 / SKETCH of the rows.
SKETCH = 10_000
#: Values of all columns' bins that are read whole.
GATHER = 50_000


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    """Text, and booleans (which count as text where a value is missing)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def missing_sql(df: DataFrame, name: str) -> str:
    """SQL that is true where a column's value is missing."""
    c = quoted(name)
    return f"({c} is null or isnan({c}))" if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)) else f"({c} is null)"


def _named(names: list[str], *more: str) -> str:
    """One struct for each column: position, column_name and what `more` says of it, `#` being its position."""
    return ", ".join(f"named_struct('position', {i}, 'column_name', {literal(n)}{''.join(', ' + m.replace('#', str(i)) for m in more)})" for i, n in enumerate(names))


def overview(df: DataFrame) -> DataFrame:
    """position, column_name, dtype, rows: one row a column."""
    columns = ", ".join(f"named_struct('position', {i}, 'column_name', {literal(n)}, 'dtype', {literal(t)})" for i, (n, t) in enumerate(df.dtypes))
    return df.agg(F.count(F.lit(1)).alias("rows")).selectExpr(f"inline(array({columns}))", "rows")


def missing_summary(df: DataFrame) -> DataFrame:
    """position, column_name, missing_count, missing_ratio, rows; the most missing first, ties by position. One scan for all columns."""
    return missing_rows(df.agg(*(c.alias(n) for n, c in missing_measures(df).items())), df.columns)


def missing_measures(df: DataFrame) -> dict[str, Column]:
    """`rows`, and the missing values of each column as m and its position."""
    return {"rows": F.count(F.lit(1)), **{f"m{i}": F.expr(f"count_if({missing_sql(df, n)})") for i, n in enumerate(df.columns)}}


def missing_rows(counts: DataFrame, names: list[str]) -> DataFrame:
    """The summary of the named columns, from the row of missing_measures."""
    summary = counts.selectExpr("rows", f"inline(array({_named(names, "'missing_count', m#")}))").withColumn("missing_ratio", F.try_divide(F.col("missing_count").cast("double"), F.col("rows")))
    return summary.select("position", "column_name", "missing_count", "missing_ratio", "rows").orderBy(F.desc("missing_ratio"), "position")


_V1, _PUSH = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row for a Parquet table: `rows`, and the values of each column that are not NULL as v and its position, from the files' footers."""
    before = {k: spark.conf.get(k) for k in (_V1, _PUSH)}
    spark.conf.set(_V1, ",".join(x for x in before[_V1].split(",") if x.strip().lower() != "parquet"))
    spark.conf.set(_PUSH, "true")
    try:
        df = spark.read.parquet(path)
        counts = df.agg(F.count(F.lit(1)).alias("rows"), *(F.expr(f"count({quoted(n)}) as v{i}") for i, n in enumerate(df.columns) if _in_footer(df, n)))
        counts._jdf.queryExecution().executedPlan()  # planned under these settings, it keeps its plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return counts


def _in_footer(df: DataFrame, name: str) -> bool:
    """Whether a column's footers tell its missing values: not those of nested columns, and not NaN."""
    return not isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType, T.ArrayType, T.MapType, T.StructType))


def missing_summary_of_parquet(spark: SparkSession, path: str) -> DataFrame:
    """missing_summary of a Parquet table: texts, integers, dates and booleans are counted in the footers, and only the other columns are read."""
    df = spark.read.parquet(path)
    known = footer_counts(spark, path)
    read = [(i, n) for i, n in enumerate(df.columns) if not _in_footer(df, n)]
    footers = known.select("rows", *((F.col("rows") - F.col(f"v{i}")).alias(f"m{i}") for i, n in enumerate(df.columns) if _in_footer(df, n)))
    if read:
        footers = footers.crossJoin(df.agg(*(F.expr(f"count_if({missing_sql(df, n)}) as m{i}") for i, n in read)))  # two rows, one each
    return missing_rows(footers, df.columns)


def worst_column(summary: DataFrame) -> DataFrame:
    """The highest ratio and the first column that has it."""
    key = F.struct("missing_ratio", -F.col("position"))
    return summary.agg(F.max_by("column_name", key).alias("column_name"), F.max("missing_ratio").alias("missing_ratio"))


def exclusion_candidates(summary: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Columns with a ratio of the threshold or more."""
    return summary.where(F.col("missing_ratio") >= threshold)


def completeness(summary: DataFrame) -> DataFrame:
    """Percent of cells that hold a value, rounded half even."""
    share = 1 - F.try_divide(F.sum("missing_count").cast("double"), F.sum("rows"))
    return summary.agg(F.bround(share * 100, 2).alias("completeness_pct"))


def missing_report(summary: DataFrame) -> DataFrame:
    """column_name, missing_count, missing_pct, status."""
    percent = F.col("missing_ratio") * 100
    return summary.select("position", "column_name", F.col("missing_count").cast("long").alias("missing_count"), percent.alias("missing_pct"), status_bucket(percent).alias("status"))


def top_missing(summary: DataFrame, n: int = 10) -> DataFrame:
    """The columns with the most missing values."""
    return summary.orderBy(F.desc("missing_count"), "position").limit(n).select("position", "column_name", "missing_count")


@dataclass
class _Rank:
    """A wanted rank of a column: its value, or the interval that holds it, with the rows below and inside."""

    column: int
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    low_in: bool = True
    high_in: bool = True
    value: float | None = None

    def interior(self, v: Column) -> Column:
        """The column's values within the interval, else NULL."""
        if self.low is not None:
            v = F.when(v >= F.lit(self.low) if self.low_in else v > F.lit(self.low), v)
        if self.high is not None:
            v = F.when(v <= F.lit(self.high) if self.high_in else v < F.lit(self.high), v)
        return v

    def holds(self, v: float) -> bool:
        over = self.low is None or v > self.low or self.low_in and v == self.low
        return over and (self.high is None or v < self.high or self.high_in and v == self.high)

    def narrow(self, edges: list[float], below: dict[float, int], upto: dict[float, int]) -> None:
        """Cuts the interval at edges within it; `below` and `upto` count the column's values under each, without and with its own."""
        for e in edges:
            if self.rank < below[e]:
                self.high, self.high_in, self.inside = e, False, below[e] - self.below
                return
            if self.rank < upto[e]:
                self.value = e
                return
            self.low, self.low_in, self.inside, self.below = e, False, self.inside - (upto[e] - self.below), upto[e]


@dataclass
class Moments:
    """What the first scan finds of a numeric column."""

    count: int
    mean: float | None
    std: float | None
    low: float | None
    high: float | None


_MOMENTS = ("count", "avg", "stddev_samp", "min", "max")


def moment_measures(value: str) -> list[str]:
    """SQL aggregates for Moments of a SQL expression, a double or NULL."""
    return [f"{f}({value})" for f in _MOMENTS]


def moments_from(found: Sequence) -> list[Moments]:
    return [Moments(*found[i : i + len(_MOMENTS)]) for i in range(0, len(found), len(_MOMENTS))]


def _binned(values: list[Column], ranks: list[_Rank], stats: list[Moments]) -> list[Column]:
    """A cell (i, b, s, v) of each column with ranks that are not known yet."""
    cells = []
    for i, m in enumerate(stats):
        own = [r for r in ranks if r.column == i]
        if own and m.low == m.high:
            for r in own:
                r.value = m.low
        elif own and 0 < (width := (m.high - m.low) / BINS) < float("inf"):
            bin_ = F.least(F.floor((values[i] - F.lit(m.low)) / F.lit(width)), F.lit(BINS - 1))
            cells.append(F.struct(F.lit(i).alias("i"), bin_.cast("long").alias("b"), F.lit(None).cast("string").alias("s"), values[i].alias("v")))
    return cells


def _grouped(df: DataFrame, cells: list[Column]) -> DataFrame:
    """(i, b, s, n, low, high, g) of the cells; `g` is i, but a filter on it stays above the grouping, so that branches share it."""
    return df.select(F.inline(F.array(*cells))).where("v is not null or i < 0").groupBy("i", "b", "s").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.max("i").alias("g"))


def _bins_of_ranks(grouped: DataFrame, ranks: list[_Rank]) -> DataFrame:
    """Only the bins that hold a wanted rank, with the rows up to their end in `upto`."""
    upto = grouped.where("g >= 0").withColumn("upto", F.sum("n").over(Window.partitionBy("i").orderBy("b")))
    wanted: dict[int, list[int]] = {}
    for r in ranks:
        wanted.setdefault(r.column, []).append(r.rank)
    asked = F.create_map(*(x for i, own in wanted.items() for x in (F.lit(i), F.array(*(F.lit(r).cast("long") for r in own)))))
    return upto.where(F.exists(asked[F.col("i")], lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n"))))


def _narrow(ranks: list[_Rank], bins: list) -> None:
    for x in bins:
        for r in ranks:
            if r.column == x["i"] and r.value is None and x["upto"] - x["n"] <= r.rank < x["upto"]:
                r.low, r.high, r.inside, r.below = x["low"], x["high"], x["n"], x["upto"] - x["n"]
                r.value = r.low if r.low == r.high else None


def _by_sketch(df: DataFrame, values: list[Column], open_: list[_Rank], accuracy: int) -> None:
    """A sketch of each interval gives two values around the rank, which a second scan proves or corrects by counts."""
    shares = [[max(0.0, x - 2 / accuracy), min(1.0, x + 2 / accuracy)] for x in ((r.rank - r.below) / r.inside for r in open_)]
    found = df.agg(*(F.percentile_approx(r.interior(values[r.column]), s, accuracy) for r, s in zip(open_, shares))).first()
    edges = [sorted(set(x)) for x in found]
    at = sorted({(r.column, e) for r, own in zip(open_, edges) for e in own})
    counts = df.agg(*(x for i, e in at for x in (F.count_if(values[i] < F.lit(e)), F.count_if(values[i] <= F.lit(e))))).first()
    below, upto = ({x: counts[2 * k + d] for k, x in enumerate(at)} for d in (0, 1))
    for r, own in zip(open_, edges):
        r.narrow(own, {e: below[r.column, e] for e in own}, {e: upto[r.column, e] for e in own})


def _settle(df: DataFrame, values: list[Column], ranks: list[_Rank], accuracy: int, gather: int) -> None:
    """Finds the value of the ranks that the bins left open: by sketches while too much is left, and the rest is read as (column, value, count)."""
    while open_ := [r for r in ranks if r.value is None]:
        if sum({(r.column, r.low, r.high): r.inside for r in open_}.values()) <= gather:
            break
        _by_sketch(df, values, open_, accuracy)
    if not open_:
        return
    rows = df.select(*(F.coalesce(*(r.interior(values[i]) for r in open_ if r.column == i)).alias(f"v{i}") for i in sorted({r.column for r in open_})))
    cells = F.array(*(F.struct(F.lit(int(n[1:])).alias("i"), F.col(n).alias("v")) for n in rows.columns))
    some = rows.where(F.coalesce(*rows.columns).isNotNull()).select(F.inline(cells)).where("v is not null").groupBy("i", "v").agg(F.count("*").alias("n"))
    held = sorted((r["i"], r["v"], r["n"]) for r in some.collect())
    for r in open_:
        upto = r.below
        for i, v, n in held:
            if i == r.column and r.holds(v):
                upto += n
                if r.rank < upto:
                    r.value = v
                    break


def number_sql(df: DataFrame, names: list[str]) -> list[str]:
    """SQL values of numeric columns as doubles, missing ones NULL."""
    return [f"(case when not {missing_sql(df, n)} then cast({quoted(n)} as double) end)" for n in names]


def _wanted(stats: list[Moments]) -> dict[tuple[int, int], _Rank]:
    """The ranks on both sides of each quartile, by column and rank."""
    ranks = {}
    for i, m in enumerate(stats):
        for q in QUARTILES if m.count else ():
            for rank in {int(q * (m.count - 1)), min(int(q * (m.count - 1)) + 1, m.count - 1)}:
                ranks.setdefault((i, rank), _Rank(i, rank, m.count))
    return ranks


_NUMERIC = "position int, column_name string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double"


def _numeric_rows(df: DataFrame, names: list[str], stats: list[Moments], ranks: dict[tuple[int, int], _Rank]) -> list[tuple]:
    """The summary's rows; quartiles lie linearly between the values of two ranks."""

    def percentile(i: int, q: float) -> float | None:
        if not stats[i].count:
            return None
        place = q * (stats[i].count - 1)
        low, part = ranks[i, int(place)].value, place - int(place)
        if not part:
            return low
        high = ranks[i, int(place) + 1].value
        return low if low == high else low + (high - low) * part

    return [(df.columns.index(n), n, m.count, m.mean, m.std, m.low, *(percentile(i, q) for q in QUARTILES), m.high) for i, (n, m) in enumerate(zip(names, stats))]


def numeric_summary(df: DataFrame, accuracy: int = SKETCH, gather: int = GATHER) -> DataFrame:
    """position, column_name, count, mean, std, min, p25, p50, p75, max of each numeric column; NULL and NaN are skipped.

    Quartiles interpolate linearly and are exact. One scan has all moments, the next counts each
    column's values in bins; a bin of one value ends the search. Where one holds more, a last scan reads its
    few values, and where it holds too many, sketches cut it first. All columns and ranks share these scans,
    and no task or driver holds more than BINS counts or a sketch a column, and `gather` values.
    """
    names = numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], _NUMERIC)
    sql = number_sql(df, names)
    found = df.agg(*(F.expr(m) for v in sql for m in moment_measures(v))).first()
    rows, _ = summaries(df, names, moments_from(found), accuracy=accuracy, gather=gather)
    fields = [f.strip().split(" ") for f in _NUMERIC.split(",")]
    lines = (F.struct(*(F.lit(x).cast(kind).alias(name) for x, (name, kind) in zip(r, fields))) for r in rows)
    return df.sparkSession.range(1).select(F.inline(F.array(*lines)))


def summaries(df: DataFrame, numbers: list[str], stats: list[Moments], categories: list[str] = (), top_n: int = 5, accuracy: int = SKETCH, gather: int = GATHER) -> tuple[list[tuple], list[tuple]]:
    """The rows of numeric_summary of the columns whose moments are given, and of categorical_summary: (position, column_name, value, count, rank).

    Bins and value counts are one grouping of one scan.
    """
    ranks = _wanted(stats)
    values = [F.expr(v) for v in number_sql(df, numbers)]
    cells = _binned(values, list(ranks.values()), stats)
    named = {df.columns.index(n): n for n in categories}
    texts = [F.struct(F.lit(-1 - i).alias("i"), F.lit(0).cast("long").alias("b"), F.expr(f"cast({quoted(n)} as string)").alias("s"), F.lit(None).cast("double").alias("v")) for i, n in named.items()]
    top = []
    if cells or texts:
        grouped = _grouped(df, [*cells, *texts])
        parts = []
        columns = ["i", "b", "s", "n", "low", "high"]
        open_ = [r for r in ranks.values() if r.value is None]
        if cells:
            parts.append(_bins_of_ranks(grouped, open_).select(*columns, "upto"))
        if texts:
            by = Window.partitionBy("i").orderBy(F.desc("n"), F.col("s").asc_nulls_last())
            parts.append(grouped.where("g < 0").withColumn("upto", F.row_number().over(by)).where(F.col("upto") <= top_n).select(*columns, F.col("upto").cast("long")))
        rows = (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).collect()
        _narrow(open_, [r for r in rows if r["i"] >= 0])
        top = sorted((-1 - r["i"], named[-1 - r["i"]], r["s"], r["n"], r["upto"]) for r in rows if r["i"] < 0 and r["s"] is not None)
        top += [(-1 - r["i"], named[-1 - r["i"]], None, r["n"], r["upto"]) for r in rows if r["i"] < 0 and r["s"] is None]
        top.sort(key=lambda r: (r[0], r[4]))
    _settle(df, values, list(ranks.values()), accuracy, gather)
    return _numeric_rows(df, numbers, stats, ranks), top


def value_counts(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """position, column_name, value, count for each distinct value, the missing one too."""
    names = categorical_columns(df) if names is None else names
    if not names:
        return df.sparkSession.createDataFrame([], "position int, column_name string, value string, count long")
    cells = ", ".join(f"named_struct('position', {df.columns.index(n)}, 'value', cast({quoted(n)} as string))" for n in names)
    counts = df.selectExpr(f"inline(array({cells}))").groupBy("position", "value").agg(F.count(F.lit(1)).alias("count"))
    named = f"array({', '.join(map(literal, df.columns))})[position] as column_name"
    return counts.selectExpr("position", named, "value", "count")


def categorical_summary(df: DataFrame, top_n: int = 5, names: list[str] | None = None) -> DataFrame:
    """The top_n values of each categorical column: position, column_name, value, count, rank; ties by value, missing last."""
    by = Window.partitionBy("position").orderBy(F.desc("count"), F.col("value").asc_nulls_last())
    return value_counts(df, names).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top_n).orderBy("position", "rank")


def distinct_counts(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Distinct values of each categorical column, the missing one included."""
    return value_counts(df, names).groupBy("position", "column_name").agg(F.count(F.lit(1)).alias("distinct_values")).orderBy("position")
