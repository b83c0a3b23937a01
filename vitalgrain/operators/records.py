"""Validation of rows as patient and observation records.

Each record type is a set of named constraints on columns; a constraint is a boolean expression
that is true where the record breaks it. A row's records are the cells of one array, so one scan gives
all types: as a long table of records or errors, or, for the counters, as aggregates of each cell alone,
which never leave the row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import GENDERS, col, normalised_gender, outside, parsed_birth_date, parsed_float
from ..sources.tables import ROW_ID

PATIENT = "patient_nbr"
LABS = ("max_glu_serum", "A1Cresult")
LAB_UNIT = "mg/dL"
VITAL_UNITS = {"systolic_bp": "mmHg", "heart_rate": "bpm", "temperature": "C", "spo2": "%"}
OBSERVATION_STATUS = "final"
STATUSES = ("preliminary", "final", "amended", "cancelled")
# fixed values: parts of a code, and the closed range that the first match asks for
VITAL_RANGES = (
    (("systolic", "sbp"), 50, 250),
    (("heart.rate", "pulse", "hr"), 30, 200),
    (("temperature", "temp"), 35, 42),
    (("oxygen", "spo2", "o2sat"), 50, 100),
)
EXTENDED_HEART_RATE = ("heart_rate", "heart-rate")

OBSERVATION = T.StructType(
    [
        T.StructField("id", T.StringType()), T.StructField("status", T.StringType()), T.StructField("code", T.StringType()), T.StructField("subject", T.StringType()),
        T.StructField("value", T.StructType([T.StructField("value", T.DoubleType()), T.StructField("unit", T.StringType()), T.StructField("code", T.StringType())])),
        T.StructField("effectiveDateTime", T.TimestampType()),
    ]
)


def vital_out_of_range(code: Column, value: Column, extended_codes: bool = False) -> Column:
    """By the first range whose part the code contains. `heart_rate` is in no range unless extended_codes is set."""
    text = F.lower(code)
    out: Column | None = None
    for parts, low, high in VITAL_RANGES:
        if extended_codes and "pulse" in parts:
            parts = (*parts, *EXTENDED_HEART_RATE)
        match = reduce(lambda a, b: a | b, (text.contains(p) for p in parts))
        # NaN lies in no order, so it never is outside
        out = (F.when if out is None else out.when)(match, outside(F.nanvl(value, F.lit(float(low))), low, high))
    return out.otherwise(False)


def observation_errors(value_of: str = "value", subject: str = "subject", of: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """Constraints on an OBSERVATION's fields: required texts, the status, a complete quantity. `of` gives a field by its name."""
    quantity = of(value_of)
    incomplete = quantity.isNotNull() & (quantity["value"].isNull() | quantity["unit"].isNull() | quantity["code"].isNull())
    return {
        "missing_id": of("id").isNull(),
        "missing_code": of("code").isNull(),
        "missing_subject": of(subject).isNull(),
        "bad_status": ~F.coalesce(of("status").isin(*STATUSES), F.lit(False)),
        "incomplete_quantity": incomplete,
    }


def patient_errors() -> dict[str, Column]:
    """Constraints on a patient's columns id, gender, birthDate."""
    return {
        "missing_id": F.col("id").isNull(),
        "bad_gender": ~F.coalesce(F.col("gender").isin(*GENDERS), F.lit(False)),
        "future_birth_date": F.coalesce(F.col("birthDate") > F.current_date(), F.lit(False)),
    }


def first_error(constraints: dict[str, Column]) -> Column:
    """The first constraint that is broken, else NULL."""
    return F.coalesce(*(F.when(broken, F.lit(name)) for name, broken in constraints.items()))


def validate(records: DataFrame, constraints: dict[str, Column]) -> DataFrame:
    """The records with `error_code`: the first constraint that each breaks, else NULL."""
    return records.withColumn("error_code", first_error(constraints))


@dataclass(frozen=True)
class Cell:
    """One record of each row: its kind and code, whether the row has it, its error, and its other fields."""

    kind: str
    code: str | None
    present: Column
    error: Column
    fields: dict[str, Column]

    def struct(self, *names: str) -> Column:
        """The record with the named fields beside kind, code and error; NULL where the row has none."""
        own = {"kind": F.lit(self.kind), "code": F.lit(self.code).cast("string"), **self.fields, "error_code": self.error}
        return F.when(self.present, F.struct(*(own[n].alias(n) for n in names)))


def _table(df: DataFrame, cells: list[Cell], *names: str) -> DataFrame:
    """The records of all rows, one scan for all cells."""
    hits = F.filter(F.array(*(c.struct(*names) for c in cells)), lambda c: c.isNotNull())
    out = df.select(F.col(ROW_ID).alias("row_id"), F.inline(hits))
    return out.select(names[0], "row_id", *names[1:])


def patient_cells(df: DataFrame, patient: str = PATIENT, gender: str = "gender", birth: str = "birthDate", today: Column | None = None, aliases: dict[str, str] | None = None) -> list[Cell]:
    if patient not in df.columns or gender not in df.columns:
        return []
    error = F.lit(None).cast("string")
    if birth in df.columns:
        given, date = col(birth).isNotNull(), parsed_birth_date(birth, df.schema[birth].dataType)
        error = F.when(given & date.isNull(), "bad_birth_date").when(given & (date > (F.current_date() if today is None else today)), "future_birth_date")
    fields = {"id": col(patient).cast("string"), "gender": normalised_gender(gender, aliases), "null_id": col(patient).isNull()}
    return [Cell("patient", None, F.lit(True), error, fields)]


def patients(df: DataFrame, patient: str = PATIENT, gender: str = "gender", birth: str = "birthDate", today: Column | None = None, aliases: dict[str, str] | None = None) -> DataFrame:
    """kind, row_id, code, id, error_code, null_id: a row a patient record. Empty if a column that it needs is absent."""
    cells = patient_cells(df, patient, gender, birth, today, aliases)
    if not cells:
        return df.sparkSession.createDataFrame([], "kind string, row_id long, code string, id string, gender string, error_code string, null_id boolean")
    return _table(df, cells, "kind", "code", "id", "gender", "error_code", "null_id")


def observation_cells(df: DataFrame, columns: dict[str, str], prefix: str, patient: str = PATIENT, ranges: bool = False, extended_codes: bool = False) -> list[Cell]:
    """A record for each of the columns (name to unit); a row has it if the value isn't missing."""
    if patient not in df.columns:
        return []
    cells = []
    for name, unit in columns.items():
        if name not in df.columns:
            continue
        value = col(name).cast("double") if isinstance(df.schema[name].dataType, T.NumericType) else parsed_float(name)
        # the subject of a row without one is the text nan, which is no error
        subject = col(patient).cast("string")
        of = {
            "id": F.concat(F.lit(f"{prefix}-"), F.col(ROW_ID).cast("string"), F.lit(f"-{name}")), "status": F.lit(OBSERVATION_STATUS), "code": F.lit(name),
            "subject": F.coalesce(subject, F.lit("nan")), "value": F.when(value.isNotNull(), F.struct(value.alias("value"), F.lit(unit).alias("unit"), F.lit(unit).alias("code"))),
        }
        constraints = {"non_numeric": value.isNull()}
        if ranges:
            constraints["out_of_range"] = vital_out_of_range(F.lit(name), value, extended_codes)
        error = first_error({**constraints, **observation_errors(of=of.__getitem__)})
        cells.append(Cell(prefix, name, col(name).isNotNull(), error, {"id": of["id"], "subject": subject, "value": value, "unit": F.lit(unit)}))
    return cells


def observations(df: DataFrame, columns: dict[str, str], prefix: str, patient: str = PATIENT, ranges: bool = False, extended_codes: bool = False) -> DataFrame:
    """kind, row_id, code, id, value, unit, error_code: a row for each value of the columns (name to unit) that isn't missing."""
    cells = observation_cells(df, columns, prefix, patient, ranges, extended_codes)
    if not cells:
        return df.sparkSession.createDataFrame([], "kind string, row_id long, code string, id string, subject string, value double, unit string, error_code string")
    return _table(df, cells, "kind", "code", "id", "subject", "value", "unit", "error_code")


def lab_observations(df: DataFrame, labs: tuple[str, ...] = LABS, unit: str = LAB_UNIT, patient: str = PATIENT) -> DataFrame:
    return observations(df, dict.fromkeys(labs, unit), "obs", patient)


def vital_observations(df: DataFrame, vitals: dict[str, str] | None = None, patient: str = PATIENT, extended_codes: bool = False) -> DataFrame:
    return observations(df, VITAL_UNITS if vitals is None else vitals, "vital", patient, ranges=True, extended_codes=extended_codes)


#: Kinds of records in the order in which their errors are told, and what the rows are called.
KINDS = {"patient": "Patient row ", "obs": "Observation row ", "vital": "Vital sign row "}


def record_cells(df: DataFrame, today: Column | None = None, extended_codes: bool = False) -> list[Cell]:
    """The records of all types that a row of the table can have."""
    labs = observation_cells(df, dict.fromkeys(LABS, LAB_UNIT), "obs")
    return [*patient_cells(df, today=today), *labs, *observation_cells(df, VITAL_UNITS, "vital", ranges=True, extended_codes=extended_codes)]


def validated(df: DataFrame, today: Column | None = None, extended_codes: bool = False) -> DataFrame:
    """kind, row_id, code, error_code of all records of all types, by one scan."""
    cells = record_cells(df, today, extended_codes)
    if not cells:
        return df.sparkSession.createDataFrame([], "kind string, row_id long, code string, error_code string")
    return _table(df, cells, "kind", "code", "error_code")


def _message(kind: str | Column, code: Column, row_id: Column, error: Column) -> Column:
    what = F.lit(KINDS[kind]) if isinstance(kind, str) else reduce(lambda a, k: a.when(kind == k, KINDS[k]), list(KINDS)[1:], F.when(kind == "patient", KINDS["patient"]))
    return F.concat(what, row_id.cast("string"), F.coalesce(F.concat(F.lit(" column "), code), F.lit("")), F.lit(": "), F.replace(error, F.lit("_"), F.lit(" ")))


def errors(records: DataFrame) -> DataFrame:
    """ordinal, kind, row_id, code, error_code, message of the records that fail; `ordinal` goes by kinds, columns and rows."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    told = records.where("error_code is not null").withColumn("ordinal", F.struct(order.alias("kind"), "code", "row_id"))
    return told.select("ordinal", "kind", "row_id", "code", "error_code", _message(F.col("kind"), F.col("code"), F.col("row_id"), F.col("error_code")).alias("message"))


def summary_measures(cells: list[Cell]) -> dict[str, Column]:
    """Aggregates of each cell: valid records, failing ones, and the first row that fails with its error."""
    out = {}
    for i, c in enumerate(cells):
        bad = c.present & c.error.isNotNull()
        out[f"valid{i}"] = F.count_if(c.present & c.error.isNull())
        out[f"bad{i}"] = F.count_if(bad)
        out[f"first{i}"] = F.min(F.when(bad, F.struct(F.col(ROW_ID).alias("row_id"), c.error.alias("error"))))
    return out


def summary_of(row: DataFrame, cells: list[Cell], found: Mapping[str, Column]) -> DataFrame:
    """patients_validated, patient_errors, observations_validated, observation_errors, and the first error as example."""
    zero = F.lit(0).cast("long")

    def total(what: str, patient: bool) -> Column:
        return reduce(lambda a, b: a + b, (found[f"{what}{i}"] for i, c in enumerate(cells) if (c.kind == "patient") == patient), zero)

    order = sorted(range(len(cells)), key=lambda i: (list(KINDS).index(cells[i].kind), cells[i].code or ""))
    examples = [_message(cells[i].kind, F.lit(cells[i].code).cast("string"), found[f"first{i}"]["row_id"], found[f"first{i}"]["error"]) for i in order]
    return row.select(
        total("valid", True).alias("patients_validated"), total("bad", True).alias("patient_errors"), total("valid", False).alias("observations_validated"), total("bad", False).alias("observation_errors"),
        F.coalesce(*examples, F.lit(None).cast("string")).alias("example"),
    )


def summary(df: DataFrame, today: Column | None = None, extended_codes: bool = False) -> DataFrame:
    """The counters of all records of a table, by one scan and without a row a record."""
    cells = record_cells(df, today, extended_codes)
    own = summary_measures(cells)
    row = df.agg(*(c.alias(n) for n, c in own.items())) if own else df.sparkSession.range(1)
    return summary_of(row, cells, {n: F.col(n) for n in own})
