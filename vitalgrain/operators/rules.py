"""Clinical rules: a small protocol, five rules, a runner and a suite.

A rule gives its finding as a one-row table (rule, severity, message, affected_rows, ...) and, where
it marks rows or columns, its violations as a long table (rule, row_id, column_name). Both read only
the columns they need.

Rules may be given in parts that are put together: `measures` are aggregates of the table from which a
finding is `concluded`, and `marks` are predicates on a row. The runner reads the table once for the
measures of all rules that have them, and once for all marks; any other rule is asked by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Protocol, runtime_checkable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import col, outside, percent_change, to_number
from ..sources.scratch import written
from ..sources.tables import ROW_ID
from . import profile

FINDING = "rule string, severity string, message string, affected_rows long, affected_groups long"
VIOLATION = "rule string, row_id long, column_name string"
VITALS = ("systolic_bp", "heart_rate", "temperature", "spo2")


@runtime_checkable
class Rule(Protocol):
    """What the runner needs; any object with a name and a check will do."""

    name: str

    def check(self, df: DataFrame) -> DataFrame:
        """One row, columns as in FINDING."""
        ...


@runtime_checkable
class MeasuredRule(Rule, Protocol):
    """A rule whose finding follows from aggregates of the whole table."""

    def measures(self, df: DataFrame) -> dict[str, Column]:
        """Aggregates by name; none if columns that the rule needs are absent."""
        ...

    def concluded(self, df: DataFrame, found: Mapping[str, Column]) -> Column:
        """The finding as a struct, given the aggregates' values as columns."""
        ...


def finding_of(rule: str, severity: str | Column, message: str | Column, rows: Column | None = None, groups: Column | None = None) -> Column:
    """A finding as a struct."""
    as_col = lambda x: F.lit(x) if isinstance(x, str) or x is None else x
    return F.struct(F.lit(rule).alias("rule"), as_col(severity).alias("severity"), as_col(message).alias("message"), as_col(rows).cast("long").alias("affected_rows"), as_col(groups).cast("long").alias("affected_groups"))


def measured(df: DataFrame, parts: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One row with the aggregates of all parts, one scan for all of them; a part's names get its own name before them."""
    columns = [c.alias(f"{part}.{name}") for part, named in parts.items() for name, c in named.items()]
    return df.agg(*columns) if columns else df.sparkSession.range(1)


def part_of(named: Iterable[str], part: str) -> dict[str, Column]:
    """The columns that hold a part's aggregates in the row of `measured`."""
    return {n: col(f"{part}.{n}") for n in named}


def _checked(rule: MeasuredRule, df: DataFrame) -> DataFrame:
    own = rule.measures(df)
    return measured(df, {"own": own}).select(rule.concluded(df, part_of(own, "own")).alias("finding")).select("finding.*")


def finding(df: DataFrame, rule: str, severity: str | Column, message: str | Column, rows: Column | None = None, groups: Column | None = None) -> DataFrame:
    """A finding from a one-row table."""
    return df.select(finding_of(rule, severity, message, rows, groups).alias("finding")).select("finding.*")


def _one(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(1)


def no_violations(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], VIOLATION)


def lacks(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n not in df.columns]


def number(df: DataFrame, name: str) -> Column:
    """The column as a number; what isn't one is NULL."""
    return to_number(name, df.schema[name].dataType)


def strict_number(df: DataFrame, name: str) -> Column:
    """The column as a number; a column of another type is an error, as rules on ages don't guess."""
    if not isinstance(df.schema[name].dataType, T.NumericType):
        raise TypeError(f"column {name} must be numeric, not {df.schema[name].dataType.simpleString()}")
    return to_number(name, df.schema[name].dataType)


@dataclass(frozen=True)
class SexConsistency:
    """No patient has two sexes. affected_rows sums the distinct sexes over conflicting patients; affected_groups counts the patients."""

    patient: str = "patient_id"
    sex: str = "sex"
    name: str = "patient_sex_consistency"

    def conflicts(self, df: DataFrame) -> DataFrame:
        """patient and sexes, where there are several; patients without id are left out."""
        groups = df.where(col(self.patient).isNotNull()).groupBy(col(self.patient).alias("patient")).agg(F.count_distinct(col(self.sex)).alias("sexes"))
        return groups.where("sexes > 1")

    def check(self, df: DataFrame) -> DataFrame:
        if lacks(df, self.patient, self.sex):
            return finding(_one(df), self.name, "WARNING", f"Needs the columns {self.patient} and {self.sex}")
        found = self.conflicts(df).agg(F.count(F.lit(1)).alias("patients"), F.coalesce(F.sum("sexes"), F.lit(0)).alias("sexes"))
        none = F.col("patients") == 0
        message = F.when(none, "Each patient has one sex").otherwise("Patients have several sexes over their records")
        return finding(found, self.name, F.when(none, "OK").otherwise("ERROR"), message, F.col("sexes"), F.col("patients"))


@dataclass(frozen=True)
class AgePlausibility:
    """Ages lie in a closed range; a missing age is no violation."""

    age: str = "age"
    low: float = 0
    high: float = 120
    name: str = "age_plausibility"

    def marks(self, df: DataFrame) -> list[tuple[Column, str | None]]:
        return [] if lacks(df, self.age) else [(outside(strict_number(df, self.age), self.low, self.high), self.age)]

    def violations(self, df: DataFrame) -> DataFrame:
        return marked_rows([self], df)

    def measures(self, df: DataFrame) -> dict[str, Column]:
        return {"n": F.count_if(mark) for mark, _ in self.marks(df)}

    def concluded(self, df: DataFrame, found: Mapping[str, Column]) -> Column:
        if not found:
            return finding_of(self.name, "WARNING", f"Needs the column {self.age}")
        none = found["n"] == 0
        return finding_of(self.name, F.when(none, "OK").otherwise("WARNING"), F.when(none, "All ages are plausible").otherwise("Some ages are implausible"), found["n"])

    def check(self, df: DataFrame) -> DataFrame:
        return _checked(self, df)


def marked_rows(rules: Iterable[Rule], df: DataFrame) -> DataFrame:
    """The violations of rules with marks, one scan for all of them."""
    marks = [(rule.name, mark, name) for rule in rules for mark, name in rule.marks(df)]
    if not marks:
        return no_violations(df)
    hits = F.array(*(F.when(mark, F.struct(F.lit(rule).alias("rule"), F.lit(name).cast("string").alias("column_name"))) for rule, mark, name in marks))
    some = df.where(reduce(lambda a, b: a | b, (mark for _, mark, _ in marks)))
    return some.select(F.col(ROW_ID), F.inline(F.filter(hits, lambda h: h.isNotNull()))).select("rule", ROW_ID, "column_name")


def marked(df: DataFrame, rule: str, violations: DataFrame, what: str) -> DataFrame:
    """A finding that counts violations and is a warning whatever the count."""
    found = violations.agg(F.count(F.lit(1)).alias("n"))
    return finding(found, rule, "WARNING", F.concat(F.col("n").cast("string"), F.lit(f" {what}")), F.col("n"))


@dataclass(frozen=True)
class AgeLabCoherence:
    """Children with very high glucose, and the elderly with high creatinine. A row counts once."""

    age: str = "age"
    glucose: str = "glucose"
    creatinine: str = "creatinine"
    child_below: float = 12
    glucose_above: float = 300
    elderly_from: float = 65
    creatinine_above: float = 2.0
    name: str = "ClinicalCoherenceRule"

    def predicate(self, df: DataFrame) -> Column:
        either = F.lit(False)
        if not lacks(df, self.age, self.glucose):
            either |= (strict_number(df, self.age) < self.child_below) & (number(df, self.glucose) > self.glucose_above)
        if not lacks(df, self.age, self.creatinine):
            either |= (strict_number(df, self.age) >= self.elderly_from) & (number(df, self.creatinine) > self.creatinine_above)
        return F.coalesce(either, F.lit(False))

    def marks(self, df: DataFrame) -> list[tuple[Column, str | None]]:
        return [(self.predicate(df), None)]

    def violations(self, df: DataFrame) -> DataFrame:
        return marked_rows([self], df)

    def measures(self, df: DataFrame) -> dict[str, Column]:
        return {"n": F.count_if(self.predicate(df))}

    def concluded(self, df: DataFrame, found: Mapping[str, Column]) -> Column:
        return finding_of(self.name, "WARNING", F.concat(found["n"].cast("string"), F.lit(" rows where age and lab value don't agree")), found["n"])

    def check(self, df: DataFrame) -> DataFrame:
        return _checked(self, df)


#: There are at most so many hot patients.
HOT_PATIENTS = 1024


def _previous(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted readings (key, row_id, values) with the values of the reading before, if it is the same patient's.

    `part` is the task. The first reading has `place` 1, as its predecessor is in another task, and the last one
    is there once more, with `place` 2, for the first one of the next.
    """
    task = TaskContext.get().partitionId()
    last: list | None = None

    def with_place(batch: pa.RecordBatch, before: list[pa.Array], places: np.ndarray) -> pa.RecordBatch:
        signs = len(before)
        names = [*batch.schema.names, *(f"p{i}" for i in range(signs)), "part", "place"]
        return pa.RecordBatch.from_arrays([*batch.columns, *before, pa.array(np.full(batch.num_rows, task, np.int32)), pa.array(places)], names=names)

    tail = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, values = batch.column(0), batch.columns[2:]
        keys = pa.concat_arrays([pa.array([last[0] if last else None], pa.string()), key.slice(0, len(key) - 1)])
        same = pc.fill_null(pc.equal(key, keys), False)
        moved = [pa.concat_arrays([pa.array([last[2 + i] if last else None], pa.float64()), v.slice(0, len(v) - 1)]) for i, v in enumerate(values)]
        before = [pc.if_else(same, m, pa.scalar(None, pa.float64())) for m in moved]
        places = np.zeros(batch.num_rows, np.int32)
        places[0] = last is None
        yield with_place(batch, before, places)
        tail = batch.slice(batch.num_rows - 1)
        last = [c[0].as_py() for c in tail.columns]
    if tail is not None:
        yield with_place(tail, [pa.nulls(1, pa.float64())] * (tail.num_columns - 2), np.array([2], np.int32))


def _carried(values: DataFrame, order: list[Column], signs: int) -> DataFrame:
    """row_id, values and those of the reading before; the readings of a patient are dealt over tasks by time."""
    columns = [f"v{i}" for i in range(signs)]
    sorting = [F.col("patient"), *order]
    dealt = values.repartitionByRange(*sorting).sortWithinPartitions(*sorting)
    dealt = dealt.select(F.col("patient").cast("string").alias("key"), ROW_ID, *columns)
    kinds = ", ".join(f"{c}{i} double" for c in "vp" for i in range(signs))
    pairs = written(dealt.mapInArrow(_previous, f"key string, {ROW_ID} long, {kinds}, part int, place int"), "readings")
    # a task's last reading, and the next one's first: two rows a task
    by = Window.orderBy("part", "place")
    edges = pairs.where("place > 0")
    carried = edges.select("place", ROW_ID, *columns, *(F.when(F.lag("key").over(by) == F.col("key"), F.lag(c).over(by)).alias(f"p{i}") for i, c in enumerate(columns))).where("place = 1")
    names = [ROW_ID, *columns, *(f"p{i}" for i in range(signs))]
    return pairs.where("place = 0").select(names).unionByName(carried.select(names))


@dataclass(frozen=True)
class VitalSpikes:
    """A vital sign that changes by more than threshold_pct from the patient's reading before.

    All signs share one window, so one shuffle and one sort. A missing reading breaks the pair on
    both of its sides, and a previous value of zero gives no percentage.

    A patient with more than `hot_rows` readings (and more than one in 1024 of all, so there are at most
    1024 of them) is no single task: these patients' readings are range-partitioned by patient, time and
    row, each task compares its own, and each task's last reading, one row, goes to the next one's first.
    """

    patient: str = "patient_id"
    time: str = "timestamp"
    vitals: tuple[str, ...] = VITALS
    threshold_pct: float = 50.0
    name: str = "VitalSignAnomalyRule"
    hot_rows: int = 1_000_000

    def spikes(self, df: DataFrame) -> DataFrame:
        """row_id and one boolean a sign."""
        present = [v for v in self.vitals if v in df.columns]
        timed = [col(self.time).alias("time")] if self.time in df.columns else []
        values = df.where(col(self.patient).isNotNull()).select(col(self.patient).alias("patient"), F.col(ROW_ID), *timed, *(number(df, v).alias(f"v{i}") for i, v in enumerate(present)))
        order = [*([F.col("time").asc_nulls_last()] if timed else []), F.col(ROW_ID)]
        hot = self._hot(values)
        if hot is None:
            pairs = self._windowed(values, order, len(present))
        else:
            pairs = self._windowed(values.join(hot, "patient", "left_anti"), order, len(present)).unionByName(_carried(values.join(hot, "patient", "left_semi"), order, len(present)))
        return self.flagged(pairs, present)

    def flagged(self, pairs: DataFrame, signs: list[str]) -> DataFrame:
        """row_id and one boolean a sign, from pairs of readings: v0, v1, ... and those before, p0, p1, ..."""
        flags = (F.coalesce(percent_change(F.col(f"v{i}"), F.col(f"p{i}")) > self.threshold_pct, F.lit(False)).alias(v) for i, v in enumerate(signs))
        return pairs.select(ROW_ID, *flags)

    def _hot(self, values: DataFrame) -> DataFrame | None:
        """The patients with too many readings for one task, if any."""
        counts = values.groupBy("patient").agg(F.count(F.lit(1)).alias("n"))
        found = counts.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
        least = max(self.hot_rows, (found["rows"] or 0) // HOT_PATIENTS)
        return F.broadcast(counts.where(F.col("n") > least).select("patient")) if (found["most"] or 0) > least else None

    @staticmethod
    def _windowed(values: DataFrame, order: list[Column], signs: int) -> DataFrame:
        by = Window.partitionBy("patient").orderBy(*order)
        return values.select(ROW_ID, *(F.col(f"v{i}") for i in range(signs)), *(F.lag(f"v{i}").over(by).alias(f"p{i}") for i in range(signs)))

    def violations(self, df: DataFrame) -> DataFrame:
        present = [v for v in self.vitals if v in df.columns]
        if lacks(df, self.patient) or not present:
            return no_violations(df)
        hit = reduce(lambda a, b: a | b, (F.col(v) for v in present))
        return self.spikes(df).where(hit).select(F.lit(self.name).alias("rule"), F.col(ROW_ID), F.lit(None).cast("string").alias("column_name"))

    def check(self, df: DataFrame) -> DataFrame:
        return marked(df, self.name, self.violations(df), "spikes of vital signs")


@dataclass(frozen=True)
class MissingThresholds:
    """Columns with a higher share of missing values than theirs allows."""

    # fixed values: allowed percent of missing values
    thresholds: Mapping[str, float] = field(
        default_factory=lambda: {"patient_id": 0.0, "age": 5.0, "gender": 10.0, "glucose": 20.0, "creatinine": 20.0, "systolic_bp": 30.0, "heart_rate": 30.0, "temperature": 30.0, "spo2": 30.0}
    )
    otherwise: float = 50.0
    name: str = "MissingDataThresholdRule"
    #: Columns that are not looked at, such as a row number that was added.
    ignored: tuple[str, ...] = ()

    def _limit(self, name: str) -> float:
        return float(self.thresholds.get(name, self.otherwise))

    def _view(self, df: DataFrame) -> DataFrame:
        return df.select(*(col(n) for n in df.columns if n not in self.ignored))

    def measures(self, df: DataFrame) -> dict[str, Column]:
        return profile.missing_measures(self._view(df))

    def concluded(self, df: DataFrame, found: Mapping[str, Column]) -> Column:
        over = (F.coalesce(F.try_divide(found[f"m{i}"].cast("double"), found["rows"]) * 100 > self._limit(n), F.lit(False)).cast("long") for i, n in enumerate(self._view(df).columns))
        n = reduce(lambda a, b: a + b, over, F.lit(0).cast("long"))
        return finding_of(self.name, "WARNING", F.concat(n.cast("string"), F.lit(" columns with too many missing values")), n)

    def details(self, df: DataFrame) -> DataFrame:
        """position, column_name, missing_pct, threshold_pct, exceeds of each column, in the table's order."""
        df = self._view(df)
        limits = F.create_map(*(F.lit(x) for n in df.columns for x in (n, self._limit(n))))
        percent = F.col("missing_ratio") * 100
        rows = profile.missing_summary(df).withColumn("threshold_pct", limits[F.col("column_name")])
        return rows.select("position", "column_name", F.bround(percent, 2).alias("missing_pct"), "threshold_pct", (percent > F.col("threshold_pct")).alias("exceeds")).orderBy("position")

    def violations(self, df: DataFrame) -> DataFrame:
        return self.details(df).where("exceeds").select(F.lit(self.name).alias("rule"), F.lit(None).cast("long").alias(ROW_ID), "column_name")

    def check(self, df: DataFrame) -> DataFrame:
        return _checked(self, df)


@dataclass(frozen=True)
class IqrOutliers:
    """Values further from the quartiles than a multiple of the distance between them.

    The quartiles are exact and come from the table's own scans, which run when marks or measures are
    asked for; the fences then are a predicate on a row like any other. Columns whose quartiles are equal
    have fences too: any other value is outside. `numeric_only` leaves out texts that hold numbers.
    """

    multiplier: float = 1.5
    numeric_only: bool = True
    #: Columns that are not looked at, such as ids.
    ignored: tuple[str, ...] = (ROW_ID,)
    name: str = "IqrOutlierRule"

    def fences(self, df: DataFrame) -> dict[str, tuple[float, float]]:
        """Lowest and highest value within the fences of each column that has values."""
        some = profile.numeric_columns(df) if self.numeric_only else [*profile.numeric_columns(df), *(f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType))]
        numbers = df.select(*(number(df, n).alias(n) for n in df.columns if n in some and n not in self.ignored))
        out = {}
        for r in profile.numeric_summary(numbers).collect():
            if r["p25"] is not None:
                reach = self.multiplier * (r["p75"] - r["p25"])
                out[r["column_name"]] = (r["p25"] - reach, r["p75"] + reach)
        return out

    def marks(self, df: DataFrame) -> list[tuple[Column, str | None]]:
        return [(outside(number(df, n), *ends), n) for n, ends in self.fences(df).items()]

    def violations(self, df: DataFrame) -> DataFrame:
        return marked_rows([self], df)

    def measures(self, df: DataFrame) -> dict[str, Column]:
        return {f"n{i}": F.count_if(mark) for i, (mark, _) in enumerate(self.marks(df))}

    def concluded(self, df: DataFrame, found: Mapping[str, Column]) -> Column:
        n = reduce(lambda a, b: a + b, found.values(), F.lit(0).cast("long"))
        return finding_of(self.name, "WARNING", F.concat(n.cast("string"), F.lit(" values outside the fences of their columns")), n)

    def check(self, df: DataFrame) -> DataFrame:
        return _checked(self, df)


def first_violations(violations: DataFrame, n: int = 20) -> DataFrame:
    """The n lowest row numbers (or column names) of each rule."""
    by = Window.partitionBy("rule").orderBy(F.col(ROW_ID).asc_nulls_last(), "column_name")
    return violations.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= n).orderBy("rule", "rank")


def first_violations_text(violations: DataFrame, n: int = 20) -> DataFrame:
    """rule and `first`, its n lowest row numbers (or column names) as one text."""
    shown = F.struct("rank", F.coalesce(F.col(ROW_ID).cast("string"), "column_name").alias("shown"))
    lists = first_violations(violations, n).groupBy("rule").agg(F.array_sort(F.collect_list(shown)).alias("rows"))  # n at most
    return lists.select("rule", F.array_join(F.col("rows.shown"), ", ").alias("first"))


class RuleRunner:
    """Applies rules in their order; a rule that raises stops the run."""

    def __init__(self, rules: Iterable[Rule]):
        self.rules = list(rules)

    def run(self, df: DataFrame, row: DataFrame | None = None) -> DataFrame:
        """A finding a rule, with its place in `ordinal`. `row` has the rules' measures, if they are known already."""
        if not self.rules:
            return df.sparkSession.createDataFrame([], f"ordinal int, {FINDING}")
        together = {i: r for i, r in enumerate(self.rules) if isinstance(r, MeasuredRule)}
        found = [r.check(df).select(F.lit(i).alias("ordinal"), "*") for i, r in enumerate(self.rules) if i not in together]
        if together:
            parts = self.measures(df)
            found.append(self.concluded(df, measured(df, parts) if row is None else row, parts))
        return reduce(DataFrame.unionByName, found).orderBy("ordinal")

    def measures(self, df: DataFrame) -> dict[str, dict[str, Column]]:
        """The aggregates of the rules that have some, by the rule's place."""
        return {f"rule{i}": r.measures(df) for i, r in enumerate(self.rules) if isinstance(r, MeasuredRule)}

    def concluded(self, df: DataFrame, row: DataFrame, parts: Mapping[str, Mapping[str, Column]]) -> DataFrame:
        """The findings of those rules, from the row of their aggregates."""
        lines = (F.struct(F.lit(i).alias("ordinal"), r.concluded(df, part_of(parts[f"rule{i}"], f"rule{i}")).alias("finding")) for i, r in enumerate(self.rules) if isinstance(r, MeasuredRule))
        return row.select(F.inline(F.array(*lines))).select("ordinal", "finding.*")


def clinical_suite(thresholds: MissingThresholds | None = None) -> list[Rule]:
    """The rules of the pipeline: coherence, spikes, missing values."""
    return [AgeLabCoherence(), VitalSpikes(), thresholds or MissingThresholds()]


def all_violations(rules: Iterable[Rule], df: DataFrame) -> DataFrame:
    """The violations of all rules that mark rows or columns."""
    rules = list(rules)
    found = [r.violations(df) for r in rules if hasattr(r, "violations") and not hasattr(r, "marks")]
    return reduce(DataFrame.unionByName, found, marked_rows([r for r in rules if hasattr(r, "marks")], df))
