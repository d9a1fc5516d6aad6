"""The online twin of the alert state: what each stream has seen before a turn, kept in a state store.

A batch query has this as a window over stream and position; a running one
keeps two values a stream. Turns of one micro-batch are taken in order of
position; a turn that comes later than one with a higher position is marked
``late``, without a state, as that of its predecessors is gone, and counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "stream_id string, position long, active boolean, prior_alert boolean, first_alert long, late boolean, late_dropped long"
STATE = "seen boolean, first long, last long, dropped long"


def _advance(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One stream's turns of one micro-batch, as columns."""
    seen, first, last, dropped = state.get if state.exists else (False, None, None, 0)
    rows = pd.concat(list(batches)).sort_values("position", kind="stable")
    position, active = rows["position"].to_numpy("int64"), rows["active"].fillna(False).to_numpy(bool)
    late = position < last if last is not None else np.zeros(len(rows), bool)
    active &= ~late
    alerts = np.cumsum(active) - active
    earliest = first if first is not None else int(position[active][0]) if active.any() else None
    prior = (alerts > 0) | bool(seen)
    out = pd.DataFrame({"stream_id": key[0], "position": position, "active": rows["active"].fillna(False).to_numpy(bool), "prior_alert": prior, "first_alert": pd.array(np.where(prior, earliest or 0, 0), "Int64"), "late": late, "late_dropped": dropped + np.cumsum(late)})
    # A late turn's predecessors' state is gone: it comes out as it is, marked.
    out.loc[~prior | late, "first_alert"] = pd.NA
    out["prior_alert"] = out["prior_alert"].astype("boolean").mask(late)
    state.update((bool(seen or active.any()), earliest, int(position[~late][-1]) if (~late).any() else last, int(dropped + late.sum())))
    yield out


def alert_state(turns: DataFrame) -> DataFrame:
    """For a streaming table ``stream_id string, position long, active boolean``."""
    return turns.select("stream_id", "position", "active").groupBy("stream_id").applyInPandasWithState(_advance, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)


def alert_windows(turns: DataFrame) -> DataFrame:
    """The batch form: ``prior_alert`` and ``first_alert`` (of earlier turns) by a window."""
    before = W.partitionBy("stream_id").orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    return turns.select("stream_id", "position", "active", F.coalesce(F.max("active").over(before), F.lit(False)).alias("prior_alert"), F.min(F.when(F.col("active"), F.col("position"))).over(before).alias("first_alert"))


def replay(turns: DataFrame, folder: str) -> None:
    """Write a table of turns as files that a stream can pick up."""
    turns.write.mode("append").parquet(folder)


def run_available(turns: DataFrame, checkpoint: str, out: str) -> None:
    """Process what is there and stop; ``checkpoint`` carries the state to the next run."""
    alert_state(turns).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
