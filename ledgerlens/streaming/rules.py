"""Streaming forms of the amount and velocity rules."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerlens.operators.rules import (
    VELOCITY,
    VELOCITY_SCORES,
    detect_high_value_transactions,
)
from ledgerlens.sources.transactions import OPTIONAL

_HELD = {"micros": "long", "transaction_id": "string", "amount": "double", "transaction_type": "string"}
_ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}

#: Groups that users are dealt to by hash; the velocity rule keeps one state per group.
GROUPS = 1_024
#: Rows of a group that may gather before they are trimmed.
_TRIM_ROWS = 50_000


def high_value_stream(stream: DataFrame, threshold: float = 10_000) -> DataFrame:
    """The amount rule is stateless, so the batch form applies as it is."""
    return detect_high_value_transactions(stream, threshold)


def _in_order(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """The rows by user and time, with their users' numbers and their times."""
    users = pd.factorize(rows["user_id"])[0]
    order = np.lexsort((rows["micros"].to_numpy(), users))
    rows = rows.iloc[order]
    return rows, users[order], rows["micros"].to_numpy()


def _earliest_per_slot(rows: pd.DataFrame, needed: int, width: int) -> pd.DataFrame:
    """Of each user's window-wide slots the ``needed`` earliest rows, with ties.

    Later rows of a slot cannot change where the first burst ends, which
    bounds the state of a user however many rows arrive.
    """
    if len(rows) < needed:  # nothing to decide yet
        return rows
    rows, users, micros = _in_order(rows)
    slots = micros // width
    new = np.append(True, (users[1:] != users[:-1]) | (slots[1:] != slots[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(micros)) - 1
    latest = micros[np.minimum(first + needed - 1, last)]
    return rows[micros <= latest[np.cumsum(new) - 1]]


def _candidates(batches: Iterator[pd.DataFrame], needed: int, width: int) -> Iterator[pd.DataFrame]:
    """Of each user's window-wide slots the ``needed`` earliest rows, with ties.

    Runs before the shuffle, so that a user with very many rows sends few.
    """
    for rows in batches:
        slot = rows["micros"] // width
        micros = rows.groupby([rows["user_id"], slot], sort=False)["micros"]
        yield rows[micros.rank(method="min") <= needed]


def _first_bursts(rows: pd.DataFrame, needed: int, width: int) -> pd.DataFrame:
    """Rows of every user's earliest window with ``needed`` rows, with its size; none of the others."""
    rows, users, micros = _in_order(rows)
    back = max(len(rows) - needed + 1, 0)
    final = slice(needed - 1, None)
    complete = (users[final] == users[:back]) & (micros[final] - micros[:back] <= width)
    at = np.flatnonzero(complete)
    fired, earliest = np.unique(users[at], return_index=True)
    end = np.zeros(users.max(initial=-1) + 1, dtype=np.int64)
    end[fired] = micros[final][at[earliest]]
    inside = np.isin(users, fired) & (micros >= end[users] - width) & (micros <= end[users])
    sizes = np.bincount(users[inside], minlength=len(end))
    return rows[inside].assign(_size=sizes[users[inside]])


def _packed(rows: pd.DataFrame, schema: pa.Schema) -> bytes:
    table = pa.Table.from_pandas(rows, schema, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_pandas()


def velocity_stream(
    stream: DataFrame,
    time_window_hours: float = 24,
    transaction_threshold: int = 10,
    watermark: str = "1 day",
    groups: int = GROUPS,
) -> DataFrame:
    """Emit a user's first burst in the micro-batch that completes it.

    Each user fires once.  State holds a bounded number of rows per user and
    window width, which are dropped when the watermark has passed them; of a
    user who fired it keeps that fact only, the user's id for good.  Users are
    dealt to ``groups`` by hash, and a group is one step and one compressed
    state, so the cost is that of the rows and not of a call per user; a task
    holds one group at a time.  A checkpoint belongs to one number of groups.
    On input in time order the result equals the batch rule.  Merchant,
    counterparty, location and description are kept if they are there.
    """
    extra = [c for c in OPTIONAL if c in stream.columns]
    kinds = {"user_id": "string", **_HELD, **{c: "string" for c in extra}}
    names = list(kinds)
    held_schema = pa.schema([(c, _ARROW[k]) for c, k in kinds.items()])
    fired_schema = pa.schema([("user_id", pa.string())])
    found = {**kinds, "rule_triggered": "string", "risk_score": "int"}
    output = ", ".join(f"{c} {k}" for c, k in found.items())
    width = int(timedelta(hours=time_window_hours).total_seconds() * 1_000_000)
    base, tiers = VELOCITY_SCORES

    def keep(state: GroupState, fired: pd.DataFrame, rows: pd.DataFrame) -> None:
        # Rows still to come are later than the watermark.
        rows = rows[rows["micros"] >= state.getCurrentWatermarkMs() * 1000 - width]
        if rows.empty and fired.empty:
            state.remove()
            return
        state.update((_packed(fired, fired_schema), _packed(rows, held_schema)))
        if not rows.empty:
            expiry = (int(rows["micros"].min()) + 2 * width) // 1000
            state.setTimeoutTimestamp(max(expiry, state.getCurrentWatermarkMs() + 1))

    def step(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        fired, rows = [_unpacked(part) for part in state.get] if state.exists else [
            schema.empty_table().to_pandas() for schema in (fired_schema, held_schema)
        ]
        if state.hasTimedOut:
            keep(state, fired, rows)
            return
        came, waiting = [], 0
        for batch in batches:
            came.append(batch.loc[~batch["user_id"].isin(fired["user_id"]), names])
            waiting += len(came[-1])
            # Trimmed whenever the rows have doubled, so all trims together cost like the last one.
            if waiting > max(len(rows), _TRIM_ROWS):
                rows = _earliest_per_slot(pd.concat([rows, *came]), transaction_threshold, width)
                came, waiting = [], 0
        rows = _earliest_per_slot(pd.concat([rows, *came]), transaction_threshold, width)
        bursts = _first_bursts(rows, transaction_threshold, width)
        if not bursts.empty:
            score = np.full(len(bursts), base)
            for bound, points in tiers:
                score = np.where(bursts["_size"] >= bound, np.maximum(score, points), score)
            yield bursts.assign(rule_triggered=VELOCITY, risk_score=score)[list(found)]
            fired = pd.concat([fired, bursts[["user_id"]].drop_duplicates()])
            rows = rows[~rows["user_id"].isin(fired["user_id"])]
        keep(state, fired, rows)

    epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    keyed = (
        stream.filter(F.col("user_id").isNotNull() & F.col("timestamp").isNotNull())
        .select(
            *[c for c in names if c != "micros"],
            F.expr(f"timestampdiff(MICROSECOND, {epoch}, timestamp)").alias("micros"),
        )
        # The watermark needs an instant; the rule itself compares ``micros``.
        .withColumn("event_time", F.timestamp_micros("micros"))
    )
    few = keyed.mapInPandas(
        lambda batches: _candidates(batches, transaction_threshold, width), keyed.schema
    ).withWatermark("event_time", watermark)
    grouped = few.withColumn("_group", F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int"))
    flagged = grouped.groupBy("_group").applyInPandasWithState(
        step, output, "fired binary, held binary", "append", GroupStateTimeout.EventTimeTimeout
    )
    return flagged.select(
        "transaction_id", "user_id",
        F.expr(f"timestampadd(MICROSECOND, micros, {epoch})").alias("timestamp"),
        "amount", "transaction_type", *extra, "rule_triggered", "risk_score",
    )
