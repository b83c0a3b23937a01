"""Spikes in a stream equal those of the whole table, whatever the cut, the order and the stops."""

import random
from datetime import datetime, timedelta

import pytest

from vitalgrain.operators.rules import VitalSpikes
from vitalgrain.streaming.spikes import spikes, write_spikes

SCHEMA = "row_id long, patient_id string, timestamp timestamp, heart_rate double, spo2 string, extra int, key int, micros string"
START = datetime(2024, 1, 1)


def readings(n, seed, gap=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        patient = rng.choice(["hot", "hot", "a", "b", None])
        time = START + timedelta(seconds=rng.randrange(n) * gap // 2 * 2)  # some at the same time
        rows.append((i, patient, time, rng.choice([50.0, 80.0, 130.0, 0.0, float("nan"), None]), rng.choice(["90", "40", "n/a", None]), 1, 2, "x"))
    return rows


def closing(rows, delay):
    return (None, None, max(r[2] for r in rows) + 3 * delay, None, None, None, None, None)


def streamed(spark, folder, batches, delay, forget=None):
    """What is there after each batch; the stream is stopped and goes on from its checkpoint each time."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{i}")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in/*")
        write_spikes(stream, f"{folder}/out", f"{folder}/state", f"{int(delay.total_seconds())} seconds", forget_after=forget).awaitTermination()
    return sorted(tuple(r) for r in spark.read.schema("row_id long, heart_rate boolean, spo2 boolean").parquet(f"{folder}/out").collect())


def whole(spark, rows):
    found = VitalSpikes().spikes(spark.createDataFrame(rows, SCHEMA)).where("heart_rate or spo2")
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("cuts", [1, 3])
def test_any_cut_gives_the_spikes_of_the_whole(spark, tmp_path, cuts):
    rows = readings(300, cuts)
    delay = timedelta(seconds=60 * 40)
    # each comes at a moment of the delay after its time
    rng = random.Random(7)
    arrived = sorted(rows, key=lambda r: r[2] + delay * rng.random() * 0.9)
    size = -(-len(arrived) // cuts)
    batches = [arrived[i : i + size] for i in range(0, len(arrived), size)]
    want = whole(spark, rows)
    assert len(want) > 50
    assert streamed(spark, str(tmp_path), [*batches, [closing(rows, delay)]], delay) == want


def test_late_readings_and_readings_without_time_are_left_out(spark, tmp_path):
    at = [START + timedelta(hours=h) for h in range(6)]
    base = [(i, "a", t, v, None, 1, 2, "x") for i, (t, v) in enumerate(zip(at, [80.0, 80.0, 80.0, 80.0, 200.0, 80.0]))]
    late = (9, "a", at[1] + timedelta(minutes=5), 10.0, None, 1, 2, "x")
    timeless = (10, "a", None, 1000.0, None, 1, 2, "x")
    hour = timedelta(hours=1)
    found = streamed(spark, str(tmp_path), [base[:5], [late, timeless, base[5]], [closing(base, hour)]], hour)
    assert found == whole(spark, base)
    assert [r[0] for r in found] == [4, 5]


def test_patients_are_forgotten(spark, tmp_path):
    hour = timedelta(hours=1)
    rows = [(i, p, START + h * hour, v, None, 1, 2, "x") for i, (p, h, v) in enumerate([("a", 0, 80.0), ("a", 2, 200.0), ("a", 9, 80.0), ("b", 9, 80.0), ("b", 11, 20.0), ("c", 20, 1.0)])]
    one = streamed(spark, str(tmp_path / "one"), [[*rows, closing(rows, hour)], [closing(rows, 2 * hour)]], hour, 3 * hour)
    more = streamed(spark, str(tmp_path / "more"), [*([r] for r in rows), [closing(rows, hour)]], hour, 3 * hour)
    assert [r[0] for r in one] == [1, 4] and more == one


def test_what_a_stream_needs(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="patient_id"):
        spikes(stream, "1 hour")
    with pytest.raises(ValueError, match="heart_rate"):
        spikes(stream.selectExpr("value as row_id", "timestamp", "'a' as patient_id"), "1 hour")
