"""Alerts as a stream of samples: open stretches are carried between micro-batches.

A stretch of a series is told twice: ``firing`` with the sample that makes it long enough, and ``resolved`` when it is
over, with its last sample. It is over at a sample that does not meet the condition, at a gap, or by an event-time timer
once the stream has passed its last sample by more than a gap, so an alert of a series that falls silent does resolve.

Cases: samples of one micro-batch may be in any order, and a series must come in time order from one to the next, as a
log of samples does; samples behind the last one of an open stretch are left out; null conditions count as false; of
several samples of a series at one time a false one wins. State is one row for each series with an open stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from commitpost.operators.alerts import STALE_MINUTES
from commitpost.operators.reports import MINUTE_US


def held_stream(rows: DataFrame, by: list[str], condition: Column, minutes: int, lateness: str = "10 minutes") -> DataFrame:
    """``(by, state, since_us, fired_us, until_us)`` of stretches where ``condition`` stayed true for ``minutes``, as
    ``alerts.held`` finds them; ``rows`` is a stream with ``by`` (strings) and ``at_us``."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    hold, stale = minutes * MINUTE_US, STALE_MINUTES * MINUTE_US

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        since, last = state.get if state.exists else (None, None)
        told: list[tuple] = []

        def close() -> None:
            if since is not None and last - since >= hold:
                told.append(("resolved", since, since + hold, last))

        if state.hasTimedOut:
            close()
            state.remove()
        else:
            samples = sorted((int(at), bool(on)) for b in batches for at, on in zip(b["at_us"], b["on"]))
            off = {at for at, on in samples if not on}
            for at, on in samples:
                if since is not None and at < last:
                    continue
                if since is not None and (not on or at - last > stale):
                    close()
                    since = None
                if on and at not in off:
                    since = at if since is None else since
                    fresh = since == at or last - since < hold  # not told before
                    last = at
                    if fresh and last - since >= hold:
                        told.append(("firing", since, since + hold, None))
            if since is not None:
                state.update((since, last))
                state.setTimeoutTimestamp(max((last + stale) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
            elif state.exists:
                state.remove()
        if not told:
            return
        made = pd.DataFrame(told, columns=["state", "since_us", "fired_us", "until_us"])
        made["until_us"] = made["until_us"].astype("Int64")
        for name, value in zip(by, key):
            made[name] = value
        yield made[[*by, "state", "since_us", "fired_us", "until_us"]]

    at = F.timestamp_micros("at_us").alias("at")
    marked = rows.select(*by, "at_us", F.coalesce(condition, F.lit(False)).alias("on"), at).withWatermark("at", lateness)
    names = ", ".join(f"{c} string" for c in by)
    return marked.groupBy(*by).applyInPandasWithState(
        follow, f"{names}, state string, since_us bigint, fired_us bigint, until_us bigint", "since bigint, last bigint",
        "append", GroupStateTimeout.EventTimeTimeout,
    )
