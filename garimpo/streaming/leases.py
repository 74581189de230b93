"""Leases kept alive by a stream of calls: state by key, with a timer for each lease."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "key string, token string, at timestamp, event string"
STATE = "token string, expires_ms long"


def heartbeats(calls: DataFrame, *, seconds: int, late: str = "0 seconds") -> DataFrame:
    """(key, token, at, event) of a stream of calls (key, token, action, at): claim, renew, complete or fail.

    A claim takes a key that is free or whose lease is over (event claimed), a
    renewal by the owner moves the lease's end to `seconds` later (renewed),
    complete and fail end it (completed, failed). Calls by others, and by an
    owner whose lease is over, are events `lost`. A lease that nobody renews ends
    by its timer when the watermark passes it (expired). State is one row a key
    that is leased. Null keys are left out.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        token, ends = state.get if state.exists else (None, 0)
        if state.hasTimedOut:
            rows.append((key[0], token, pd.Timestamp(ends, unit="ms"), "expired"))
            state.remove()
        else:
            calls_ = sorted((r for b in batches for r in b[["at", "token", "action"]].itertuples(index=False)), key=lambda r: (r.at, r.action != "claim"))
            for call in calls_:
                at = int(call.at.timestamp() * 1000)
                if token is not None and at >= ends:
                    rows.append((key[0], token, pd.Timestamp(ends, unit="ms"), "expired"))
                    token = None
                if call.action == "claim" and token is None:
                    token, ends, event = call.token, at + seconds * 1000, "claimed"
                elif token is None or call.token != token or call.action == "claim":
                    event = "lost"
                elif call.action == "renew":
                    ends, event = at + seconds * 1000, "renewed"
                else:
                    token, event = None, {"complete": "completed", "fail": "failed"}.get(call.action, "lost")
                rows.append((key[0], call.token, call.at, event))
            if token is None:
                if state.exists:
                    state.remove()
            else:
                state.update((token, ends))
                state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        if rows:
            yield pd.DataFrame(rows, columns=["key", "token", "at", "event"])

    stream = calls.where("key IS NOT NULL").withWatermark("at", late)
    return stream.groupBy("key").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
