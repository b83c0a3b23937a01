"""Spikes of vital signs in a stream: each patient's reading against the one before it, by event time.

Readings may come late and in any order, up to a delay. A patient's state holds the readings that the
watermark has not passed and the last one it has passed. Once the watermark passes a reading, all readings
before it are there, so it is compared, once; how the stream is cut into micro-batches doesn't matter, and
the result is that of `VitalSpikes` over the whole table.

Defined cases: readings of the same time follow each other by row_id; a missing value breaks the pair on
both sides; readings without a patient or a time are not compared, but a time without a patient moves the
watermark, so such a row closes a stream; readings that come more than the delay late are dropped by Spark,
which counts them in the progress (numRowsDroppedByWatermark). With `forget_after`, a reading that follows
its predecessor by more than that is not compared, and the patient's state goes when the watermark shows
that none can follow in time; without it, one reading a patient stays for good.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.expressions import col
from ..operators.rules import VitalSpikes, number
from ..sources.tables import ROW_ID

_STATE = "micros array<long>, rows array<long>, readings array<double>, last_micros long, last array<double>"


def _paired(micros: np.ndarray, values: np.ndarray, last_micros: int | None, last: np.ndarray, forget: int | None) -> np.ndarray:
    """The values before each reading; NaN where there is none, or it is too long ago."""
    before = np.concatenate([last[None], values[:-1]])
    if forget is not None and len(micros):
        first = micros[0] if last_micros is None else last_micros
        gaps = micros - np.concatenate([[first], micros[:-1]])
        before[gaps > forget] = np.nan
    return before


def _compare(signs: int, forget: int | None):
    names = [ROW_ID, *(f"{c}{i}" for c in "vp" for i in range(signs))]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        micros, rows, values = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty((0, signs))]
        last_micros, last = None, np.full(signs, np.nan)
        if state.exists:
            held = state.get
            micros.append(np.array(held[0], np.int64))
            rows.append(np.array(held[1], np.int64))
            values.append(_floats(held[2]).reshape(-1, signs))
            last_micros, last = held[3], _floats(held[4])
        if not state.hasTimedOut:
            for batch in batches:
                micros.append(batch["micros"].to_numpy(np.int64))
                rows.append(batch[ROW_ID].to_numpy(np.int64))
                values.append(batch[[f"v{i}" for i in range(signs)]].to_numpy(np.float64))
        at, ids, read = np.concatenate(micros), np.concatenate(rows), np.concatenate(values)
        order = np.lexsort((ids, at))
        at, ids, read = at[order], ids[order], read[order]
        watermark = state.getCurrentWatermarkMs()
        passed = int(np.searchsorted(at, watermark * 1000, "right"))
        if passed:
            before = _paired(at[:passed], read[:passed], last_micros, last, forget)
            yield pd.DataFrame(np.hstack([read[:passed], before]), columns=names[1:]).assign(**{ROW_ID: ids[:passed]})[names]
            last_micros, last = int(at[passed - 1]), read[passed - 1]
        if passed == len(at) and forget is not None and last_micros + forget <= watermark * 1000:
            if state.exists:
                state.remove()
            return
        state.update((at[passed:].tolist(), ids[passed:].tolist(), read[passed:].ravel().tolist(), last_micros, last.tolist()))
        if passed < len(at):
            state.setTimeoutTimestamp(max(int(at[passed]) // 1000, watermark + 1))
        elif forget is not None:
            state.setTimeoutTimestamp(max((last_micros + forget) // 1000, watermark + 1))

    return run


def _floats(values: list | np.ndarray) -> np.ndarray:
    return np.array([np.nan if v is None else v for v in values], np.float64)


def spikes(readings: DataFrame, delay: str, rule: VitalSpikes | None = None, forget_after: timedelta | None = None) -> DataFrame:
    """row_id and one boolean a sign of a stream of readings that come up to `delay` late."""
    rule = rule or VitalSpikes()
    signs = [v for v in rule.vitals if v in readings.columns]
    if lacking := [n for n in (rule.patient, rule.time, ROW_ID) if n not in readings.columns]:
        raise ValueError(f"needs the columns {', '.join(lacking)}")
    if not signs:
        raise ValueError(f"needs one of the columns {', '.join(rule.vitals)}")
    timed = readings.select(col(rule.time).cast("timestamp").alias("time"), col(rule.patient).alias("patient"), F.col(ROW_ID), *(number(readings, v).alias(f"v{i}") for i, v in enumerate(signs)))
    # a condition on the patient alone would move below the watermark, which needs the times of all rows
    key = F.when(F.col("time").isNotNull(), F.col("patient")).alias("key")
    timed = timed.withWatermark("time", delay).select("*", F.unix_micros("time").alias("micros"), key).where("key is not null")
    kinds = ", ".join(f"{c}{i} double" for c in "vp" for i in range(len(signs)))
    forget = None if forget_after is None else forget_after // timedelta(microseconds=1)
    pairs = timed.drop("patient").groupBy("key").applyInPandasWithState(_compare(len(signs), forget), f"{ROW_ID} long, {kinds}", _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    values = [F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in pairs.columns if c != ROW_ID]
    return rule.flagged(pairs.select(ROW_ID, *values), signs)


def write_spikes(readings: DataFrame, path: str, checkpoint: str, delay: str, rule: VitalSpikes | None = None, forget_after: timedelta | None = None) -> StreamingQuery:
    """Appends readings with a spike, row_id and one boolean a sign, to a Parquet table; after a failure each is there once."""
    found = spikes(readings, delay, rule, forget_after)
    hit = reduce(lambda a, b: a | b, (F.col(c) for c in found.columns if c != ROW_ID))
    return found.where(hit).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
