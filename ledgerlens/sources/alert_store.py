"""Alert table kept as a log of commits over Parquet folders.

A change writes its rows to a folder of its own and then takes the next number
of the log, atomically.  Inserts write only the new rows; reviews, deletes and
replacements only the rows they change.  Reading takes the newest change of
every changed alert and the untouched rest of the table, which is not shuffled.
When many changes have gathered, a full snapshot is written by itself.

Writers may work side by side: a change that finds its number taken was made
against an outdated table, and is made again.  Folders of changes that died
half-way have no commit and are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import alerts as A
from ledgerlens.settings import materialised

# Kinds of commits: everything, new rows only, or changed and deleted rows.
_FULL, _ADDED, _DELTA = "full", "added", "delta"
_DELETED, _VERSION = "_deleted", "_version"
_DELTA_SCHEMA = T.StructType([*A.ALERT_SCHEMA, T.StructField(_DELETED, T.BooleanType())])

#: Commits after which a snapshot is written.
COMPACT_AFTER = 40
#: Changed rows are broadcast to the rest of the table while their files are no larger.
BROADCAST_BYTES = 32 << 20
#: Times that a change is made anew when other writers were faster.
ATTEMPTS = 10


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


class Commit(NamedTuple):
    """An entry of the log.  ``applied`` has the last batch of every stream up to here."""

    number: int
    kind: str
    next_id: int
    path: str
    applied: dict[str, int]


class Conflict(Exception):
    """Another writer has taken the number."""


class AlertStore:
    """The alert table at ``path`` on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        if not self._numbers():
            try:
                self._write([], spark.createDataFrame([], A.ALERT_SCHEMA), 1, _FULL)
            except Conflict:
                pass  # another writer has created it

    # --- log

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return self._path(self.path).getFileSystem(conf)

    def _numbers(self) -> list[int]:
        found = self._files().globStatus(self._path(f"{self.path}/log/[0-9]*")) or []
        return sorted(int(status.getPath().getName()) for status in found)

    def _commit(self, number: int) -> Commit:
        stream = self._files().open(self._path(f"{self.path}/log/{number:08d}"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Commit(number, **json.loads(text))

    def _log(self) -> list[Commit]:
        """Commits from the newest full snapshot on."""
        out: list[Commit] = []
        for number in reversed(self._numbers()):
            out.insert(0, self._commit(number))
            if out[0].kind == _FULL:
                break
        return out

    def _claim(self, number: int, entry: str) -> None:
        """Create the log entry, or fail if there is one: a rename that never replaces."""
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext
        files, target = self._files(), self._path(f"{self.path}/log/{number:08d}")
        draft = self._path(f"{self.path}/log/.{uuid.uuid4().hex}")
        stream = files.create(draft)
        stream.write(bytearray(entry.encode()))
        stream.close()
        never = context._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        folders = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), context._jsc.hadoopConfiguration()
        )
        try:
            folders.rename(draft, target, never)
        except Py4JJavaError as error:
            files.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                raise Conflict(f"commit {number} of {self.path} is taken") from None
            raise

    def _next_id(self) -> int:
        """The highest id ever given out, plus one; ids are not used again."""
        return self._log()[-1].next_id

    def applied(self, tag: str) -> bool:
        """Whether the change ``stream.batch`` or a later one of the stream was written."""
        stream, _, batch = tag.rpartition(".")
        return int(batch) <= self._log()[-1].applied.get(stream, -1)

    def _write(self, log: list[Commit], rows: DataFrame, next_id: int, kind: str, tag: str = "") -> None:
        """Write the rows and commit them as the change that follows ``log``."""
        schema = _DELTA_SCHEMA if kind == _DELTA else A.ALERT_SCHEMA
        path = f"{self.path}/data/{uuid.uuid4().hex}"
        rows = rows.select(*schema.fieldNames())
        if kind == _FULL:  # levels and statuses side by side, so that filters skip row groups
            rows = rows.sortWithinPartitions("risk_level", "status")
        writer = rows.write.mode("errorifexists")
        for column in ("alert_id", "transaction_id"):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(path)
        number, applied = 1, {}
        if log:
            number, applied = log[-1].number + 1, dict(log[-1].applied)
        if tag:
            stream, _, batch = tag.rpartition(".")
            applied[stream] = max(int(batch), applied.get(stream, -1))
        entry = {"kind": kind, "next_id": next_id, "path": path, "applied": applied}
        self._claim(number, json.dumps(entry))

    def _change(self, make: Callable[[list[Commit]], int]) -> int:
        """Make a change against the current log, again if another writer was faster."""
        for attempt in range(ATTEMPTS):
            log = self._log()
            try:
                done = make(log)
            except Conflict:
                if attempt + 1 == ATTEMPTS:
                    raise
                continue
            if len(log) >= COMPACT_AFTER:
                try:
                    self.compact()
                except Conflict:
                    pass  # a later change will
            return done

    def read(self) -> DataFrame:
        return self._table(self._log())

    def _table(self, log: list[Commit]) -> DataFrame:
        """The table after the commits of ``log``.

        Ids are given once, so rows of the plain commits differ in their ids, and the newest
        change of an id stands for it.  Only changed rows are grouped.
        """
        plain = [c.path for c in log if c.kind != _DELTA]
        table = self.spark.read.schema(A.ALERT_SCHEMA).parquet(*plain)
        changes = [c for c in log if c.kind == _DELTA]
        if not changes:
            return table
        parts = [
            self.spark.read.schema(_DELTA_SCHEMA).parquet(c.path).withColumn(_VERSION, F.lit(c.number))
            for c in changes
        ]
        rows = reduce(DataFrame.unionByName, parts)
        latest = rows.groupBy(F.col("alert_id").alias("_id")).agg(
            F.max_by(F.struct(*_DELTA_SCHEMA.fieldNames()), _VERSION).alias("row")
        )
        size = sum(self._files().getContentSummary(self._path(c.path)).getLength() for c in changes)
        ids = rows.select("alert_id")
        rest = table.join(F.broadcast(ids) if size <= BROADCAST_BYTES else ids, "alert_id", "left_anti")
        changed = latest.select("row.*").filter(~F.col(_DELETED)).drop(_DELETED)
        return rest.select(*A.ALERT_SCHEMA.fieldNames()).unionByName(changed)

    def compact(self) -> None:
        """Write one full snapshot, so that reading no longer merges."""
        log = self._log()
        self._write(log, self._table(log), log[-1].next_id, _FULL)

    # --- changes

    def store_alerts(
        self,
        scored: DataFrame,
        overwrite: bool = False,
        created_at: datetime | None = None,
        tag: str = "",
    ) -> int:
        """Insert new alerts, or with ``overwrite`` replace existing ones.

        Returns the number of alerts stored.
        """
        created_at = created_at or _now()
        incoming = A.upsert_rows if overwrite else A.new_alerts

        def store(log: list[Commit]) -> int:
            current, start = self._table(log), log[-1].next_id
            fresh = A.with_alert_ids(incoming(current, scored, created_at), start)
            stored = fresh.count()  # already written, so this only counts
            if stored and overwrite:
                replaced = current.join(fresh.select("transaction_id"), "transaction_id", "left_semi")
                self._write(log, self._delta(fresh, replaced), start + stored, _DELTA, tag)
            elif stored:
                self._write(log, fresh, start + stored, _ADDED, tag)
            return stored

        return self._change(store)

    @staticmethod
    def _delta(changed: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
        rows = changed.withColumn(_DELETED, F.lit(False))
        if deleted is None:
            return rows
        return rows.unionByName(deleted.withColumn(_DELETED, F.lit(True)))

    def rescore(self, scored: DataFrame, created_at: datetime | None = None, tag: str = "") -> int:
        """Insert new alerts; existing ones get the new score, level and rules
        and keep their id and review.  Returns the number of rows written."""
        scored = materialised(scored, "rescored")
        created_at = created_at or _now()

        def store(log: list[Commit]) -> int:
            current, start = self._table(log), log[-1].next_id
            fresh = A.with_alert_ids(A.new_alerts(current, scored, created_at), start)
            added = fresh.count()
            changed = materialised(A.rescored(current, scored), "rescored-alerts")
            altered = changed.count()
            if altered:
                self._write(log, self._delta(fresh.unionByName(changed)), start + added, _DELTA, tag)
            elif added:
                self._write(log, fresh, start + added, _ADDED, tag)
            return added + altered

        return self._change(store)

    def update_alert_status(
        self,
        alert_id: int,
        new_status: str,
        reviewer: str | None = None,
        notes: str | None = None,
        reviewed_at: datetime | None = None,
    ) -> bool:
        updates = self.spark.createDataFrame(
            [(alert_id, new_status, reviewer, notes)],
            "alert_id long, status string, reviewed_by string, notes string",
        )
        return self.update_statuses(updates, reviewed_at) > 0

    def update_statuses(self, updates: DataFrame, reviewed_at: datetime | None = None) -> int:
        """Apply reviews; only the alerts they change are written.  Returns their number."""
        reviewed_at = reviewed_at or _now()

        def review(log: list[Commit]) -> int:
            matched = self._table(log).join(updates.select("alert_id"), "alert_id", "left_semi")
            changed = materialised(A.update_status(matched, updates, reviewed_at), "reviewed")
            count = changed.count()
            if count:
                self._write(log, self._delta(changed), log[-1].next_id, _DELTA)
            return count

        return self._change(review)

    def delete_alerts(self, ids: DataFrame) -> int:
        """Delete the alerts with the given ``alert_id``; returns their number."""

        def delete(log: list[Commit]) -> int:
            found = self._table(log).join(ids.select("alert_id"), "alert_id", "left_semi")
            found = materialised(found, "deleted")
            count = found.count()
            if count:
                self._write(log, self._delta(found.limit(0), found), log[-1].next_id, _DELTA)
            return count

        return self._change(delete)

    def delete_alert(self, alert_id: int) -> bool:
        return self.delete_alerts(self.spark.createDataFrame([(alert_id,)], "alert_id long")) > 0

    def clear_all_alerts(self, confirm: bool = False) -> int:
        """Empty the table; does nothing unless ``confirm`` is given."""
        if not confirm:
            return 0

        def clear(log: list[Commit]) -> int:
            count = self._table(log).count()
            self._write(log, self.spark.createDataFrame([], A.ALERT_SCHEMA), log[-1].next_id, _FULL)
            return count

        return self._change(clear)

    def folders(self, pattern: str) -> list[str]:
        """Paths below the store that match a pattern."""
        found = self._files().globStatus(self._path(f"{self.path}/{pattern}")) or []
        return [status.getPath().toString() for status in found]

    def mark(self, name: str) -> None:
        """Create an empty file below the store."""
        self._files().create(self._path(f"{self.path}/{name}")).close()

    def remove(self, path: str) -> None:
        self._files().delete(self._path(path), True)

    # --- queries

    def get_alerts(self, **filters) -> DataFrame:
        return A.get_alerts(self.read(), **filters)

    def get_alert_statistics(self, as_of: datetime | None = None) -> dict[str, DataFrame]:
        return A.get_alert_statistics(self.read(), as_of or _now())
