"""Queries over the sample tables, one or more for each operator, and the SQL that checks them.

The sample tables hold no clinical columns and no missing values, so each query maps columns and
injects missing values by a rule that its SQL repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import age_years, missing_normalised, normalised_gender, parsed_birth_date, parsed_float, to_number
from ..operators import profile, records, rules
from ..sources.results import read_results, write_results
from ..sources.scratch import scratch_path
from ..sources.tables import ROW_ID, ingest, read_csv, read_parquet, with_row_id
from ..streaming.spikes import write_spikes

from . import workflow


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- frames -------------------------------------------------------------------------------------


def _gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(F.nullif("event_type", F.lit("error")).alias("event_type"), F.when(F.col("value") >= 20, F.col("value")).alias("value"), "user_id")


_GAPPY = """
with d as (select nullif(event_type, 'error') as a, case when value >= 20 then value end as b, user_id as c from events),
n as (select count(*) as n, count(a) as a, count(b) as b, count(c) as c from d),
m as (select 0 as position, 'event_type' as column_name, n - a as missing_count, n from n
      union all select 1, 'value', n - b, n from n union all select 2, 'user_id', n - c, n from n)
"""


def _vital_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """patient_id, timestamp and four signs, two of them with gaps and one as text."""
    e = _table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias(ROW_ID), F.nullif(F.col("user_id") % 50, F.lit(7)).alias("patient_id"), F.col("ts").alias("timestamp"),
        F.col("value").alias("systolic_bp"), F.when(F.col("event_id") % 11 != 0, F.col("event_id") % 97).alias("heart_rate"),
        F.when(F.col("event_id") % 13 == 0, "n/a").otherwise((F.col("event_id") % 7 + 35).cast("string")).alias("temperature"),
        F.nullif(F.col("value"), F.col("value")).alias("spo2"),
    )


_SPIKES = """
with v as (select event_id as row_id, nullif(user_id % 50, 7) as p, ts, value as a, case when event_id % 11 <> 0 then event_id % 97 end as b,
                  case when event_id % 13 <> 0 then event_id % 7 + 35 end as c from events),
l as (select row_id, a, b, c, lag(a) over w as pa, lag(b) over w as pb, lag(c) over w as pc from v where p is not null window w as (partition by p order by ts, row_id)),
f as (select row_id, coalesce(pa <> 0 and abs((a - pa) / pa) * 100 > 50, false) as sa, coalesce(pb <> 0 and abs((b - pb) / cast(pb as double)) * 100 > 50, false) as sb,
             coalesce(abs((c - pc) / cast(pc as double)) * 100 > 50, false) as sc from l)
"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as patients with birth dates, labs and vital signs."""
    c = _table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias(ROW_ID), F.nullif(k, F.lit(17)).alias("patient_nbr"),
        F.when(k % 5 == 0, " Male ").when(k % 5 == 1, "FEMALE").when(k % 5 == 2, "M").when(k % 5 == 3, F.lit(None).cast("string")).otherwise("other").alias("gender"),
        F.when(k % 9 == 0, "2999-01-01").when(k % 9 == 1, "2020-02-30").when(k % 9 == 2, "1980-03-05 00:00:00").when(k % 9 == 3, F.lit(None).cast("string")).otherwise("1990-12-31").alias("birthDate"),
        F.when(k % 4 == 0, ">200").when(k % 4 == 1, "7.1").when(k % 4 == 2, "1_000").otherwise(F.lit(None).cast("string")).alias("max_glu_serum"),
        F.col("c_acctbal").alias("systolic_bp"), (k % 900).cast("double").alias("heart_rate"), F.when(k % 3 != 0, (k % 12 + 33).cast("double")).alias("temperature"),
        F.when(k % 6 == 0, "x").otherwise((k % 60 + 45).cast("string")).alias("spo2"),
    )


_RECORDS = """
with r as (select c_custkey as k, c_acctbal as bal from customer),
e as (
  select 'patient' as kind, k as row_id, cast(null as varchar) as code,
         case when k % 9 = 0 then 'future_birth_date' when k % 9 = 1 then 'bad_birth_date' end as error_code from r
  union all select 'obs', k, 'max_glu_serum', case when k % 4 = 0 then 'non_numeric' end from r where k % 4 < 3
  union all select 'vital', k, 'systolic_bp', case when bal < 50 or bal > 250 then 'out_of_range' end from r
  union all select 'vital', k, 'heart_rate', null from r
  union all select 'vital', k, 'temperature', case when k % 12 + 33 < 35 or k % 12 + 33 > 42 then 'out_of_range' end from r where k % 3 <> 0
  union all select 'vital', k, 'spo2', case when k % 6 = 0 then 'non_numeric' when k % 60 + 45 < 50 or k % 60 + 45 > 100 then 'out_of_range' end from r
),
d as (select *, case kind when 'patient' then 'Patient' when 'obs' then 'Observation' else 'Vital sign' end || ' row ' || row_id || coalesce(' column ' || code, '') || ': ' || replace(error_code, '_', ' ') as message from e where error_code is not null)
"""


def _clinic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records, with the columns that the clinical rules need: nations as patients whose readings go by a time that repeats."""
    k = F.col("c_custkey")
    more = _table(spark, sf_dir, "customer").select(
        k.alias(ROW_ID), F.nullif("c_nationkey", F.lit(7)).alias("patient_id"), (k % 13).alias("timestamp"), (k % 100).alias("age"),
        F.when(k % 8 == 0, "n/a").otherwise((F.col("c_acctbal") / 10).cast("string")).alias("glucose"), (k % 4).cast("string").alias("creatinine"),
    )
    return _records(spark, sf_dir).join(more, ROW_ID)


def _labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as patients: age, glucose and creatinine, the latter two as text."""
    p = _table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias(ROW_ID), (F.col("p_size") * 2).alias("age"), F.when(F.col("p_size") % 7 == 0, F.col("p_brand")).otherwise((F.col("p_retailprice") / 4).cast("string")).alias("glucose"), (F.col("p_partkey") % 5).cast("string").alias("creatinine"))


_COHERENCE = """
select p_partkey as row_id from part
where (p_size * 2 < 12 and p_size % 7 <> 0 and p_retailprice / 4 > 300) or (p_size * 2 >= 65 and p_partkey % 5 > 2)
"""


# ---- profile ------------------------------------------------------------------------------------


def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.overview(_table(spark, sf_dir, "customer"))


def missing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.missing_summary(_gappy_events(spark, sf_dir))
    return rows.select("position", "column_name", "missing_count", F.round("missing_ratio", 6).alias("missing_ratio"))


def missing_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values of a written table: footers tell those of all columns but the floating one."""
    path = scratch_path(spark, "gappy")
    e = _table(spark, sf_dir, "events")
    _gappy_events(spark, sf_dir).join(e.limit(0).select(F.col("event_id").alias("none")), F.lit(False), "left").write.parquet(path)
    return profile.missing_summary_of_parquet(spark, path).select("position", "column_name", "missing_count", "rows")


def max_ratio_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.worst_column(profile.missing_summary(_gappy_events(spark, sf_dir))).select("column_name", F.round("missing_ratio", 6).alias("missing_ratio"))


def exclusion_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.exclusion_candidates(profile.missing_summary(_gappy_events(spark, sf_dir)), 0.3).select("column_name", "missing_count")


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.completeness(profile.missing_summary(_gappy_events(spark, sf_dir)))


def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_report(profile.missing_summary(_gappy_events(spark, sf_dir))).withColumn("missing_pct", F.round("missing_pct", 4))


def chart_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_missing(profile.missing_summary(_gappy_events(spark, sf_dir)), 10)


def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    rows = profile.numeric_summary(_table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"))
    return rows.select("column_name", "count", *(F.round(n, 4).alias(n) for n in names))


def numeric_summary_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result with a coarse sketch, so that ranks take several rounds."""
    names = ["p25", "p50", "p75"]
    rows = profile.numeric_summary(_table(spark, sf_dir, "orders").select("o_totalprice"), accuracy=20, gather=10)
    return rows.select("column_name", "count", *(F.round(n, 4).alias(n) for n in names))


def _numeric_sql(table: str, names: list[str], columns: str) -> str:
    one = "select '{n}' as column_name, count({n}) as count, {c} from {t}"
    return " union all ".join(one.format(n=n, t=table, c=columns.replace("?", f"cast({n} as double)")) for n in names)


_QUARTILES = ", ".join(f"round(quantile_cont(?, {q}), 4) as p{int(q * 100)}" for q in (0.25, 0.5, 0.75))


def categorical_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_orderpriority")
    return profile.categorical_summary(o, 3).select("column_name", "value", "count", "rank")


def categorical_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_orderpriority")
    return profile.distinct_counts(o).select("column_name", "distinct_values")


# ---- rules --------------------------------------------------------------------------------------


def sex_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("patient_id"), F.nullif("o_orderstatus", F.lit("P")).alias("sex"))
    return rules.SexConsistency().check(o)


def age_plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.AgePlausibility(low=0, high=9000).check(_table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("age"))).drop("message")


def age_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(ROW_ID), F.col("c_acctbal").alias("age"))
    return rules.AgePlausibility(low=0, high=9000).violations(c)


def age_lab_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.AgeLabCoherence().violations(_labs(spark, sf_dir)).select("row_id")


def vital_spike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.VitalSpikes().violations(_vital_events(spark, sf_dir)).select("row_id")


def vital_spike_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same spikes from a stream that is stopped and goes on. An eighth of the first half's readings come with the second half."""
    path, out, state = (scratch_path(spark, name) for name in ("readings", "spikes", "state"))
    e = _vital_events(spark, sf_dir)
    first, last = e.agg(F.min("timestamp"), F.max("timestamp")).first()
    first, last = first or datetime(2000, 1, 1), last or datetime(2000, 1, 1)
    half = max((last - first) / 2, timedelta(seconds=1))
    early = F.coalesce((F.col("timestamp") < first + half) & (F.col(ROW_ID) % 8 != 0), F.lit(False))
    # a time without a patient closes the stream
    closing = spark.range(1).select(F.lit(None).cast("long").alias(ROW_ID), F.lit(last + 2 * half).cast(e.schema["timestamp"].dataType).alias("timestamp"))
    for i, rows in enumerate([e.where(early), e.where(~early).unionByName(closing, allowMissingColumns=True)]):
        rows.write.parquet(f"{path}/{i}")
        stream = spark.readStream.schema(e.schema).parquet(f"{path}/*")
        write_spikes(stream, out, state, f"{int(half.total_seconds()) + 1} seconds").awaitTermination()
    return spark.read.schema(f"{ROW_ID} long").parquet(out)


def vital_spike_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.VitalSpikes().spikes(_vital_events(spark, sf_dir)).select("row_id", "systolic_bp", "heart_rate", "temperature")


def missing_threshold_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = rules.MissingThresholds({"event_type": 30.0, "value": 30.0})
    return limits.details(_gappy_events(spark, sf_dir)).select("column_name", "missing_pct", "threshold_pct", "exceeds")


def rule_runner(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("patient_id"), F.col("o_orderstatus").alias("sex"))
    return rules.RuleRunner([rules.SexConsistency(), rules.AgePlausibility()]).run(o).drop("message")


def rule_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vital_events(spark, sf_dir).withColumns({"age": (F.col(ROW_ID) % 100), "glucose": F.col("systolic_bp").cast("string"), "creatinine": (F.col(ROW_ID) % 4).cast("string")})
    return rules.RuleRunner(rules.clinical_suite()).run(v).select("ordinal", "rule", "severity", "affected_rows")


def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values outside the fences of their columns, one of them numbers as text."""
    e = _table(spark, sf_dir, "events").select(F.col("event_id").alias(ROW_ID), "value", F.when(F.col("event_id") % 9 != 0, F.pow(F.col("event_id") % 31, F.lit(3)).cast("string")).alias("cubes"))
    return rules.IqrOutliers(1.0, numeric_only=False).violations(e)


class _LargeOrders:
    """A rule of one's own: orders above an amount."""

    name = "large_orders"

    def check(self, df: DataFrame) -> DataFrame:
        found = df.agg(F.count_if(F.col("o_totalprice") > 200_000).alias("n"))
        return rules.finding(found, self.name, F.when(F.col("n") == 0, "OK").otherwise("WARNING"), "Large orders", F.col("n"))


def custom_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.RuleRunner([_LargeOrders(), rules.AgePlausibility()]).run(_table(spark, sf_dir, "orders"))


def first_violations_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.first_violations_text(rules.VitalSpikes().violations(_vital_events(spark, sf_dir)), 20)


def first_20_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.first_violations(rules.VitalSpikes().violations(_vital_events(spark, sf_dir)), 20).select("rule", "row_id", "rank")


# ---- records and expressions --------------------------------------------------------------------


def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.summary(_records(spark, sf_dir), today=F.lit("2026-01-01").cast("date"))


def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.errors(records.validated(_records(spark, sf_dir), today=F.lit("2026-01-01").cast("date"))).select("kind", "row_id", "code", "error_code", "message")


def validate_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pipeline's validation finds: missing counts, findings of the suite, record counters."""
    found = workflow.validate(_clinic(spark, sf_dir))
    missing = found["missing"].select(F.lit("missing").alias("part"), F.col("column_name").alias("name"), F.col("missing_count").alias("n"))
    findings = found["findings"].select(F.lit("finding").alias("part"), F.col("rule").alias("name"), F.col("affected_rows").alias("n"))
    counters = ["patients_validated", "patient_errors", "observations_validated", "observation_errors"]
    summed = found["records"].select(F.inline(F.array(*(F.struct(F.lit("records").alias("part"), F.lit(c).alias("name"), F.col(c).alias("n")) for c in counters))))
    return missing.unionByName(findings).unionByName(summed)


def results_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All violations and errors of the records, written twice and read back: table, part, row_id, what."""
    path = scratch_path(spark, "results")
    df = _clinic(spark, sf_dir)
    tables = {"violations": rules.all_violations([rules.AgePlausibility(high=90), rules.AgeLabCoherence()], df), "errors": records.errors(records.validated(df, today=F.lit("2026-01-01").cast("date"))).drop("ordinal")}
    for _ in range(2):
        write_results(tables, path, {"violations": "rule", "errors": "kind"})
    marked = read_results(spark, path, "violations").select(F.lit("violations").alias("table"), F.col("rule").alias("part"), "row_id", F.col("column_name").alias("what"))
    return marked.unionByName(read_results(spark, path, "errors").select(F.lit("errors").alias("table"), F.col("kind").alias("part"), "row_id", F.col("message").alias("what")))


def observation_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required fields, the status and the quantity of made-up observations, and a constraint of one's own."""
    k = F.col("c_custkey")
    quantity = F.struct(F.col("c_acctbal").alias("value"), F.when(k % 11 != 0, "mg/dL").alias("unit"), F.lit("mg/dL").alias("code"))
    o = _table(spark, sf_dir, "customer").select(
        k.alias(ROW_ID), F.when(k % 13 != 0, k.cast("string")).alias("id"), F.when(k % 7 == 0, "draft").when(k % 7 == 1, F.lit(None)).otherwise("final").alias("status"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("code"), F.when(k % 5 != 0, "p").alias("subject"), F.when(k % 3 != 0, quantity).alias("value"),
    )
    return records.validate(o, {**records.observation_errors(), "negative": F.coalesce(F.col("value.value") < 0, F.lit(False))}).select("row_id", "error_code")


def patients_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.patients(_records(spark, sf_dir)).select("row_id", "error_code")


def patient_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.patients(_records(spark, sf_dir), today=F.lit("2026-01-01").cast("date")).select("row_id", "id", "gender", "error_code", "null_id")


def lab_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias(ROW_ID), F.col("p_partkey").alias("patient_nbr"), F.when(F.col("p_size") % 7 == 0, F.col("p_brand")).otherwise(F.col("p_size").cast("string")).alias("A1Cresult"))
    return records.lab_observations(p).select("row_id", "id", "value", "unit", "error_code")


def vital_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select(F.col("event_id").alias(ROW_ID), F.col("user_id").alias("patient_nbr"), F.col("value").alias("systolic_bp"))
    return records.vital_observations(e).groupBy("code").agg(F.count_if(F.col("error_code").isNotNull()).alias("errors"), F.count_if(F.col("error_code").isNull()).alias("valid"))


def gender_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _records(spark, sf_dir).select(normalised_gender("gender").alias("gender"))
    return c.groupBy("gender").agg(F.count("*").alias("records"))


def age_in_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("birth"))
    return o.select("o_orderkey", age_years("birth", F.lit("2024-02-29").cast("date")).cast("int").alias("age"))


def birth_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("row_id", parsed_birth_date("birthDate").alias("birth"))


def numeric_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    text = F.when(k % 6 == 0, "1.5d").when(k % 6 == 1, F.concat(F.lit(" "), k.cast("string"), F.lit(".5 "))).when(k % 6 == 2, "1_000").when(k % 6 == 3, "-inf").when(k % 6 == 4, "nan").otherwise("0x1p3")
    return _table(spark, sf_dir, "customer").select("c_custkey", text.alias("t")).select("c_custkey", to_number("t").alias("coerced"), F.nanvl(parsed_float("t"), F.lit(-1.0)).alias("strict"))


def nan_as_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return missing_normalised(e).where(F.col("value") > 300).agg(F.count("*").alias("above"))


# ---- sources ------------------------------------------------------------------------------------


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes customers as CSV with missing tokens and reads them with inferred types."""
    path = scratch_path(spark, "csv")
    c = _table(spark, sf_dir, "customer")
    token = F.when(F.col("c_custkey") % 10 == 0, "NA").when(F.col("c_custkey") % 10 == 1, "?").otherwise(F.col("c_mktsegment"))
    out = c.select("c_custkey", "c_name", F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"), "c_acctbal", token.alias("c_mktsegment"), (F.col("c_custkey") % 2 == 0).alias("even"))
    out.write.option("header", True).csv(path)
    return read_csv(spark, path)


def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted fields that hold line breaks, commas and quotes."""
    path = scratch_path(spark, "csv")
    k = F.col("c_custkey")
    note = F.when(k % 3 == 0, F.concat(F.lit("one\ntwo, "), "c_name")).when(k % 3 == 1, F.concat(F.lit('"'), "c_name", F.lit('" x'))).otherwise(F.col("c_name"))
    _table(spark, sf_dir, "customer").select("c_custkey", note.alias("note"), "c_acctbal").write.option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path)


def _text_files(lines: DataFrame, head: str) -> str:
    """Files of the rows (k, value) in the order of k, each of them with the header."""

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([head])], names=["value"])
        yield from batches

    path = scratch_path(lines.sparkSession, "csv")
    lines.repartitionByRange("k").sortWithinPartitions("k").select("value").mapInArrow(headed, "value string").write.option("lineSep", "\n").text(path)
    return path


def csv_inner_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text with inner quotes, text after a closing quote and CRLF within quotes, numbered in the order of the files."""
    k = F.col("o_orderkey")
    note = F.when(k % 5 == 0, F.concat(F.lit('5" '), "o_orderpriority")).when(k % 5 == 1, F.concat(F.lit('"a,""b"" '), "o_orderstatus", F.lit('"c'))).when(k % 5 == 2, F.concat(F.lit('"one\r\ntwo,'), "o_orderstatus", F.lit('\n"'))).when(k % 5 == 3, F.col("o_orderpriority")).otherwise(F.lit(""))
    line = F.concat(k.cast("string"), F.lit(","), note, F.lit(","), F.col("o_custkey").cast("string"), F.when(k % 2 == 0, "\r").otherwise(""))
    path = _text_files(_table(spark, sf_dir, "orders").select(k.alias("k"), line.alias("value")), "o_orderkey,note,o_custkey")
    return read_csv(spark, path, row_ids=True)


def csv_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How reading a table of customers fails once a line is damaged: a row that is too long, with quotes and without, a quote that stays open, no file, no rows."""
    c = _table(spark, sf_dir, "customer")
    k, last = F.col("c_custkey"), c.agg(F.max("c_custkey")).first()[0]
    whole = F.concat(k.cast("string"), F.lit(',"'), "c_name", F.lit('"'))
    damage = {
        "whole": whole, "short": F.when(k == last, k.cast("string")).otherwise(whole), "long": F.when(k == last, F.concat(whole, F.lit(",1"))).otherwise(whole),
        "long_quotes": F.when(k == last, F.lit('5" x,6" y,7')).otherwise(whole), "open": F.when(k == last, F.lit('1,"x')).otherwise(whole),
    }
    rows = []
    for name, line in {**damage, "header": None, "absent": None}.items():
        lines = c.select(k.alias("k"), (whole if line is None else line).alias("value"))
        path = scratch_path(spark, "csv") if name == "absent" else _text_files(lines.limit(0) if name == "header" else lines, "c_custkey,c_name")
        try:
            rows.append((name, str(read_csv(spark, path).count())))
        except (FileNotFoundError, ValueError) as e:
            rows.append((name, type(e).__name__))
    return spark.createDataFrame(rows, "name string, outcome string")


def ingest_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").write.option("header", True).csv(path)
    df, n = ingest(spark, path)
    return df.agg(F.sum("o_orderkey").alias("keys")).withColumn("rows", F.lit(n).cast("long"))


def row_numbers_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files of very different sizes, numbered by the order of the files' names."""
    path = scratch_path(spark, "csv")
    size = F.floor(F.log2(F.col("o_orderkey") + 1)).cast("int")
    _table(spark, sf_dir, "orders").select("o_orderkey", size.alias("size")).repartitionByRange(16, "size").sortWithinPartitions("o_orderkey").drop("size").write.option("header", True).csv(path)
    return read_csv(spark, path, row_ids=True)


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/supplier.parquet")


def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numbers in the order of the file, which is that of the key."""
    return with_row_id(_table(spark, sf_dir, "nation")).select("n_nationkey", ROW_ID)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        overview, missing_summary, missing_footers, max_ratio_column, exclusion_candidates, completeness, missing_report, chart_top10,
        numeric_summary, numeric_summary_binned, categorical_summary, categorical_cardinality,
        sex_consistency, age_plausibility, age_violations, age_lab_coherence, vital_spike, vital_spike_stream, vital_spike_signs, missing_threshold_rule, iqr_outliers, rule_runner, rule_suite, first_20_violations, first_violations_text, custom_rule,
        validation_summary, validation_errors, validate_stage, results_read_back, observation_constraints, patients_today, patient_records, lab_observation, vital_range, gender_normalise, age_in_years, birth_dates, numeric_casts, nan_as_missing,
        csv_round_trip, csv_line_breaks, csv_inner_quotes, csv_errors, ingest_count, parquet_scan, row_numbers, row_numbers_files,
    )
}

ORACLE_SQL: dict[str, str] = {
    "overview": """
        select * from (values (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'), (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) as v(position, column_name, dtype),
        (select count(*) as rows from customer) as n""",
    "missing_summary": _GAPPY + "select position, column_name, missing_count, round(cast(missing_count as double) / n, 6) as missing_ratio from m",
    "missing_footers": _GAPPY + "select position, column_name, missing_count, n as rows from m union all select 3, 'none', count(*), count(*) from events",
    "max_ratio_column": _GAPPY + "select column_name, round(cast(missing_count as double) / n, 6) as missing_ratio from m order by missing_count desc, position limit 1",
    "exclusion_candidates": _GAPPY + "select column_name, missing_count from m where cast(missing_count as double) / n >= 0.3",
    "completeness": _GAPPY + "select round_even((1 - cast(sum(missing_count) as double) / cast(sum(n) as double)) * 100, 2) as completeness_pct from m",
    "missing_report": _GAPPY + """
        , p as (select *, cast(missing_count as double) / n * 100 as pct from m)
        select position, column_name, missing_count, round(pct, 4) as missing_pct, case when pct > 30 then 'HIGH' when pct > 10 then 'MODERATE' else 'LOW' end as status from p""",
    "chart_top10": _GAPPY + "select position, column_name, missing_count from m order by missing_count desc, position limit 10",
    "numeric_summary": _numeric_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"], f"round(avg(?), 4) as mean, round(stddev_samp(?), 4) as std, round(min(?), 4) as min, {_QUARTILES}, round(max(?), 4) as max"),
    "numeric_summary_binned": _numeric_sql("orders", ["o_totalprice"], _QUARTILES),
    "categorical_summary": """
        with v as (select 'o_orderstatus' as column_name, nullif(o_orderstatus, 'P') as value from orders union all select 'o_orderpriority', o_orderpriority from orders),
        c as (select column_name, value, count(*) as count from v group by all)
        select column_name, value, count, cast(rank as int) as rank from (select *, row_number() over (partition by column_name order by count desc, value nulls last) as rank from c) where rank <= 3""",
    "categorical_cardinality": """
        with v as (select 'o_orderstatus' as column_name, nullif(o_orderstatus, 'P') as value from orders union all select 'o_orderpriority', o_orderpriority from orders)
        select column_name, count(*) as distinct_values from (select distinct column_name, value from v) group by 1""",
    "sex_consistency": """
        with g as (select o_custkey, count(distinct nullif(o_orderstatus, 'P')) as k from orders where o_custkey is not null group by 1), c as (select * from g where k > 1)
        select 'patient_sex_consistency' as rule, case when count(*) = 0 then 'OK' else 'ERROR' end as severity,
               case when count(*) = 0 then 'Each patient has one sex' else 'Patients have several sexes over their records' end as message,
               cast(coalesce(sum(k), 0) as bigint) as affected_rows, count(*) as affected_groups from c""",
    "age_plausibility": """
        select 'age_plausibility' as rule, case when count(*) = 0 then 'OK' else 'WARNING' end as severity, count(*) as affected_rows, cast(null as bigint) as affected_groups
        from customer where c_acctbal < 0 or c_acctbal > 9000""",
    "age_violations": "select 'age_plausibility' as rule, c_custkey as row_id, 'age' as column_name from customer where c_acctbal < 0 or c_acctbal > 9000",
    "age_lab_coherence": _COHERENCE,
    "vital_spike": _SPIKES + "select row_id from f where sa or sb or sc",
    "vital_spike_stream": _SPIKES + "select row_id from f where sa or sb or sc",
    "vital_spike_signs": _SPIKES + "select row_id, sa as systolic_bp, sb as heart_rate, sc as temperature from f",
    "missing_threshold_rule": _GAPPY + """
        , p as (select *, cast(missing_count as double) / n * 100 as pct, case when column_name = 'user_id' then 50.0 else 30.0 end as t from m)
        select column_name, round_even(pct, 2) as missing_pct, cast(t as double) as threshold_pct, pct > t as exceeds from p""",
    "iqr_outliers": """
        with v as (select event_id as row_id, 'value' as column_name, value as x from events union all select event_id, 'cubes', case when event_id % 9 <> 0 then cast(power(event_id % 31, 3) as double) end from events),
        q as (select column_name, quantile_cont(x, 0.25) as a, quantile_cont(x, 0.75) as b from v group by 1)
        select 'IqrOutlierRule' as rule, row_id, column_name from v join q using (column_name) where x < a - 1.0 * (b - a) or x > b + 1.0 * (b - a)""",
    "rule_runner": """
        with c as (select count(distinct o_orderstatus) as k from orders where o_custkey is not null group by o_custkey having count(distinct o_orderstatus) > 1)
        select cast(0 as int) as ordinal, 'patient_sex_consistency' as rule, case when count(*) = 0 then 'OK' else 'ERROR' end as severity, cast(coalesce(sum(k), 0) as bigint) as affected_rows, count(*) as affected_groups from c
        union all select 1, 'age_plausibility', 'WARNING', null, null""",
    "rule_suite": _SPIKES + """
        , g as (select count(*) as n from events where (event_id % 100 < 12 and value > 300) or (event_id % 100 >= 65 and event_id % 4 > 2)),
        m as (select cast(count(*) filter (user_id % 50 = 7) > 0 as int) + cast(count(*) filter (event_id % 11 = 0) * 100.0 / count(*) > 30 as int) + 1 as n from events)
        select cast(0 as int) as ordinal, 'ClinicalCoherenceRule' as rule, 'WARNING' as severity, n as affected_rows from g
        union all select 1, 'VitalSignAnomalyRule', 'WARNING', (select count(*) from f where sa or sb or sc)
        union all select 2, 'MissingDataThresholdRule', 'WARNING', cast(n as bigint) from m""",
    "first_20_violations": _SPIKES + "select 'VitalSignAnomalyRule' as rule, row_id, cast(row_number() over (order by row_id) as int) as rank from f where sa or sb or sc order by row_id limit 20",
    "custom_rule": """
        select cast(0 as int) as ordinal, 'large_orders' as rule, case when count(*) = 0 then 'OK' else 'WARNING' end as severity, 'Large orders' as message, count(*) as affected_rows, cast(null as bigint) as affected_groups from orders where o_totalprice > 200000
        union all select 1, 'age_plausibility', 'WARNING', 'Needs the column age', null, null""",
    "first_violations_text": _SPIKES + "select 'VitalSignAnomalyRule' as rule, string_agg(row_id, ', ' order by row_id) as first from (select row_id from f where sa or sb or sc order by row_id limit 20) having count(*) > 0",
    "validation_summary": _RECORDS + """
        select count(*) filter (kind = 'patient' and error_code is null) as patients_validated, count(*) filter (kind = 'patient' and error_code is not null) as patient_errors,
               count(*) filter (kind <> 'patient' and error_code is null) as observations_validated, count(*) filter (kind <> 'patient' and error_code is not null) as observation_errors,
               (select message from d order by case kind when 'patient' then 0 when 'obs' then 1 else 2 end, code nulls first, row_id limit 1) as example from e""",
    "validation_errors": _RECORDS + "select kind, row_id, code, error_code, message from d",
    "validate_stage": _RECORDS + """
        , v as (select c_custkey as k, nullif(c_nationkey, 7) as p, c_custkey % 13 as t, c_acctbal as a, cast(c_custkey % 900 as double) as b, case when c_custkey % 3 <> 0 then cast(c_custkey % 12 + 33 as double) end as c, case when c_custkey % 6 <> 0 then cast(c_custkey % 60 + 45 as double) end as s from customer),
        l as (select k, a, b, c, s, lag(a) over w as pa, lag(b) over w as pb, lag(c) over w as pc, lag(s) over w as ps from v where p is not null window w as (partition by p order by t, k)),
        spikes as (select count(*) as n from l where (pa <> 0 and abs((a - pa) / pa) * 100 > 50) or (pb <> 0 and abs((b - pb) / pb) * 100 > 50) or abs((c - pc) / pc) * 100 > 50 or abs((s - ps) / ps) * 100 > 50),
        lacking as (
          select count(*) filter (k = 17) as patient_nbr, count(*) filter (k % 5 = 3) as gender, count(*) filter (k % 9 = 3) as "birthDate", count(*) filter (k % 4 = 3) as max_glu_serum, 0::bigint as systolic_bp, 0::bigint as heart_rate,
                 count(*) filter (k % 3 = 0) as temperature, 0::bigint as spo2, (select count(*) from customer where c_nationkey = 7) as patient_id, 0::bigint as timestamp, 0::bigint as age, 0::bigint as glucose, 0::bigint as creatinine from r),
        m as (from lacking unpivot (n for name in (patient_nbr, gender, "birthDate", max_glu_serum, systolic_bp, heart_rate, temperature, spo2, patient_id, timestamp, age, glucose, creatinine)))
        select 'missing' as part, name, n from m
        union all select 'finding', 'ClinicalCoherenceRule', (select count(*) from customer where (c_custkey % 100 < 12 and c_custkey % 8 <> 0 and c_acctbal / 10 > 300) or (c_custkey % 100 >= 65 and c_custkey % 4 > 2))
        union all select 'finding', 'VitalSignAnomalyRule', n from spikes
        union all select 'finding', 'MissingDataThresholdRule', (select count(*) from m, (select count(*) as rows from r) where n * 100.0 / rows > case name when 'patient_id' then 0 when 'age' then 5 when 'gender' then 10 when 'glucose' then 20 when 'creatinine' then 20 when 'systolic_bp' then 30 when 'heart_rate' then 30 when 'temperature' then 30 when 'spo2' then 30 else 50 end)
        union all select 'records', name, n from (
          select count(*) filter (kind = 'patient' and error_code is null) as patients_validated, count(*) filter (kind = 'patient' and error_code is not null) as patient_errors,
                 count(*) filter (kind <> 'patient' and error_code is null) as observations_validated, count(*) filter (kind <> 'patient' and error_code is not null) as observation_errors from e) unpivot (n for name in (patients_validated, patient_errors, observations_validated, observation_errors))""",
    "results_read_back": _RECORDS + """
        select 'violations' as table, 'age_plausibility' as part, c_custkey as row_id, 'age' as what from customer where c_custkey % 100 > 90
        union all select 'violations', 'ClinicalCoherenceRule', c_custkey, null from customer where (c_custkey % 100 < 12 and c_custkey % 8 <> 0 and c_acctbal / 10 > 300) or (c_custkey % 100 >= 65 and c_custkey % 4 > 2)
        union all select 'errors', kind, row_id, message from d""",
    "observation_constraints": """
        select c_custkey as row_id, case when c_custkey % 13 = 0 then 'missing_id' when c_mktsegment = 'MACHINERY' then 'missing_code' when c_custkey % 5 = 0 then 'missing_subject'
               when c_custkey % 7 in (0, 1) then 'bad_status' when c_custkey % 3 <> 0 and c_custkey % 11 = 0 then 'incomplete_quantity' when c_custkey % 3 <> 0 and c_acctbal < 0 then 'negative' end as error_code from customer""",
    "patients_today": "select c_custkey as row_id, case when c_custkey % 9 = 0 and date '2999-01-01' > current_date then 'future_birth_date' when c_custkey % 9 = 1 then 'bad_birth_date' end as error_code from customer",
    "patient_records": """
        select c_custkey as row_id, cast(nullif(c_custkey, 17) as varchar) as id, case c_custkey % 5 when 0 then 'male' when 1 then 'female' when 4 then 'other' else 'unknown' end as gender,
               case when c_custkey % 9 = 0 then 'future_birth_date' when c_custkey % 9 = 1 then 'bad_birth_date' end as error_code, c_custkey = 17 as null_id from customer""",
    "lab_observation": """
        select p_partkey as row_id, 'obs-' || p_partkey || '-A1Cresult' as id, case when p_size % 7 <> 0 then cast(p_size as double) end as value, 'mg/dL' as unit,
               case when p_size % 7 = 0 then 'non_numeric' end as error_code from part""",
    "vital_range": "select 'systolic_bp' as code, count(*) filter (value < 50 or value > 250) as errors, count(*) filter (value between 50 and 250) as valid from events",
    "gender_normalise": "select case c_custkey % 5 when 0 then 'male' when 1 then 'female' when 4 then 'other' else 'unknown' end as gender, count(*) as records from customer group by 1",
    "age_in_years": """
        select o_orderkey, cast(2024 - year(o_orderdate) - case when (month(o_orderdate), day(o_orderdate)) > (2, 29) then 1 else 0 end as int) as age from orders""",
    "birth_dates": "select c_custkey as row_id, cast(case when c_custkey % 9 = 0 then '2999-01-01' when c_custkey % 9 = 2 then '1980-03-05' when c_custkey % 9 not in (1, 3) then '1990-12-31' end as date) as birth from customer",
    "numeric_casts": """
        select c_custkey, case c_custkey % 6 when 1 then c_custkey + 0.5 when 3 then cast('-inf' as double) end as coerced,
               cast(case c_custkey % 6 when 1 then c_custkey + 0.5 when 2 then 1000 when 3 then cast('-inf' as double) when 4 then -1 end as double) as strict from customer""",
    "nan_as_missing": "select count(*) as above from events where event_id % 4 <> 0 and value > 300",
    "csv_round_trip": """
        select c_custkey, c_name, case when c_custkey % 7 <> 0 then cast(c_nationkey as bigint) end as c_nationkey, c_acctbal,
               case when c_custkey % 10 = 0 then null when c_custkey % 10 = 1 then '?' else c_mktsegment end as c_mktsegment, c_custkey % 2 = 0 as even from customer""",
    "csv_line_breaks": """
        select c_custkey, case c_custkey % 3 when 0 then 'one' || chr(10) || 'two, ' || c_name when 1 then '"' || c_name || '" x' else c_name end as note, c_acctbal from customer""",
    "csv_inner_quotes": """
        select o_orderkey, case o_orderkey % 5 when 0 then '5" ' || o_orderpriority when 1 then 'a,"b" ' || o_orderstatus || 'c' when 2 then 'one' || chr(13) || chr(10) || 'two,' || o_orderstatus || chr(10) when 3 then o_orderpriority end as note,
               o_custkey, row_number() over (order by o_orderkey) - 1 as row_id from orders""",
    "csv_errors": """
        select name, coalesce(outcome, n) as outcome from (select cast(count(*) as varchar) as n from customer),
        (values ('whole', null), ('short', null), ('long', 'ValueError'), ('long_quotes', 'ValueError'), ('open', 'ValueError'), ('header', 'ValueError'), ('absent', 'FileNotFoundError')) as v(name, outcome)""",
    "ingest_count": "select cast(sum(o_orderkey) as bigint) as keys, count(*) as rows from orders",
    "parquet_scan": "select * from supplier",
    "row_numbers_files": "select o_orderkey, row_number() over (order by o_orderkey) - 1 as row_id from orders",
    "row_numbers": "select n_nationkey, row_number() over (order by n_nationkey) - 1 as row_id from nation",
}
