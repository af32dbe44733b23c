"""Slots that arrive in several deliveries (R1): keyed state until a slot is whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..sources.snapshots import SLOT

OUT = "model string, var string, init_date date, init_ts timestamp, status string, fields int, wanted int"
_FIELD = (*SLOT, "member", "lead_ix")
_FIELD_SCHEMA = "model string, var string, init_date date, init_ts timestamp_ntz, member int, lead_ix int"
#: State of a slot is let go so long after its last change; fields that come later start it anew.
KEEP_MS = 60 * 24 * 3600 * 1000


class Assembler(StatefulProcessor):
    """One slot: which fields (member and lead) have come, and whether it was handed on.

    The state is a number for each field, never the cells. A slot is handed on as ``complete`` with its last
    field, as ``timed out`` when the wait since its first field is over, and as ``late`` for fields after that.
    """

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("slot", "fields array<bigint>, wanted int, done boolean", ttlDurationMs=KEEP_MS)

    def _row(self, key, status: str, fields: int, wanted: int) -> pd.DataFrame:
        model, var, day, ts = key
        return pd.DataFrame({"model": [model], "var": [var], "init_date": [day], "init_ts": [ts], "status": [status], "fields": [fields], "wanted": [wanted]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        have, wanted, done = np.zeros(0, np.int64), 0, False
        known = self.state.get() if self.state.exists() else None
        if known:
            have, wanted, done = np.array(known[0], np.int64), known[1], known[2]
        now = have
        for part in rows:
            wanted = max(wanted, int(part["wanted"].max()))
            now = np.union1d(now, part["member"].fillna(-1).astype("int64").to_numpy() << 32 | part["lead_ix"].astype("int64").to_numpy())
        if len(now) > len(have):
            status = "late" if done else "complete" if len(now) >= wanted else None
            if status:
                for at in list(self.handle.listTimers()):
                    self.handle.deleteTimer(at)
                yield self._row(key, status, len(now), wanted)
            elif known is None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
            self.state.update((now.tolist(), wanted, done or status is not None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.state.exists():
            fields, wanted, done = self.state.get()
            if not done:
                self.state.update((list(fields), wanted, True))
                yield self._row(key, "timed out", len(fields), wanted)

    def close(self) -> None:
        pass


def _fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pa.Table.from_batches([batch]).group_by(list(_FIELD)).aggregate([]).select(list(_FIELD)).to_batches()


def assembled_slots(cells: DataFrame, expected: DataFrame, wait_ms: int) -> DataFrame:
    """Slots of a stream of cells that are ready: SLOT, status, fields, wanted.

    ``expected`` (model, var, fields) says how many fields a slot of a model and variable has. Slots of others are
    handed on when their time is over. Cells are reduced to fields before the shuffle to the state.
    """
    found = cells.where("value is not null and not isnan(value)").select(*_FIELD).mapInArrow(_fields, _FIELD_SCHEMA)
    known = found.join(expected.select("model", "var", F.col("fields").cast("int").alias("wanted")), ["model", "var"], "left")
    keyed = known.select("model", "var", "init_date", F.col("init_ts").cast("timestamp").alias("init_ts"), "member", "lead_ix", F.coalesce("wanted", F.lit(2**31 - 1)).alias("wanted"))
    return keyed.groupBy(*SLOT).transformWithStateInPandas(Assembler(wait_ms), OUT, "append", "processingTime")
