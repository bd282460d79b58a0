"""Write streamed rule hits to the alert table."""

from __future__ import annotations

import hashlib
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.scoring import score_flags
from ledgerlens.settings import materialised
from ledgerlens.sources.alert_store import AlertStore


#: Folders that hits are dealt to by transaction, so that all hits of one lie in one folder.
BUCKETS = 64
#: A stream's hits are merged after this many batches, and merged ones after as many merges.
FANOUT = 16
#: Times that hits are listed anew when another stream has merged what was to be read.
ATTEMPTS = 5
_GONE = ("FILE_NOT_EXIST", "FileNotFound", "PATH_NOT_FOUND")


class Span(NamedTuple):
    """Batches ``low`` to ``high - 1`` of a stream, merged into folders ``batch=-high``."""

    stream: str
    low: int
    high: int

    def holds(self, batch: int) -> bool:
        """Whether the folder of a batch, or of merged ones, lies within the span."""
        return self.low <= batch < self.high if batch >= 0 else self.low < -batch < self.high


class Hits:
    """Streamed hits by bucket, stream and batch, merged as the batches go on.

    A merge writes new folders, then a marker, then removes the folders it
    replaces; readers go by the markers, so a row is seen once whenever a
    merge stops.  Every hit is written again once per power of ``FANOUT``, and
    a bucket has at most ``FANOUT`` folders of a stream for each such power.
    """

    def __init__(self, spark: SparkSession, store: AlertStore):
        self.spark, self.store = spark, store
        self.folder = f"{store.path}/hits"

    def spans(self) -> list[Span]:
        names = [f.rsplit("/", 2)[1:] for f in self.store.folders("hits/_merged/*/[0-9]*")]
        return [Span(stream, *map(int, name.split("-"))) for stream, name in names]

    def live(self, pattern: str) -> list[str]:
        """Folders below ``hits`` that match, without those that a merge has replaced."""
        spans = self.spans()

        def seen(folder: str) -> bool:
            stream, batch = (part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:])
            own, number = [s for s in spans if s.stream == stream], int(batch)
            # A merged folder counts from its marker on, until a wider merge.
            marked = number >= 0 or any(s.high == -number for s in own)
            return marked and not any(s.holds(number) for s in own)

        return [f for f in self.store.folders(f"hits/{pattern}") if seen(f)]

    def read(self, folders: list[str]) -> DataFrame:
        rows = self.spark.read.option("mergeSchema", True).option("basePath", self.folder).parquet(*folders)
        return rows.withColumn("stream", F.col("stream").cast("string"))

    def write(self, rows: DataFrame, stream: str, batch: int) -> None:
        placed = rows.withColumns({"bucket": _bucket(), "stream": F.lit(stream), "batch": F.lit(batch)})
        (
            placed.repartition("bucket").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "stream", "batch").parquet(self.folder)
        )

    def merge(self, stream: str, high: int) -> None:
        """Merge the stream's batches before ``high``, as far back as its power of ``FANOUT`` says."""
        width = FANOUT
        while high % (width * FANOUT) == 0:
            width *= FANOUT
        span = Span(stream, high - width, high)
        marker = f"hits/_merged/{stream}/{span.low}-{high}"
        own = f"bucket=*/stream={stream}/batch=*"
        if span not in self.spans():
            old = [f for f in self.live(own) if span.holds(int(f.rsplit("=", 1)[1]))]
            if old:
                self.write(self.read(old).drop("bucket", "stream", "batch"), stream, -high)
            self.store.mark(marker)
        live = set(self.live(own))
        for folder in self.store.folders(f"hits/{own}"):
            if folder not in live and not folder.endswith(f"=-{high}"):
                self.store.remove(folder)
        for s in self.spans():
            if s.stream == stream and s != span and span.low <= s.low and s.high <= high:
                self.store.remove(f"{self.folder}/_merged/{stream}/{s.low}-{s.high}")


def _bucket():
    return F.pmod(F.xxhash64("transaction_id"), F.lit(BUCKETS)).cast("int")


def _hits_of(hits: DataFrame, touched: DataFrame) -> DataFrame:
    """All hits of the touched transactions; a rule's hits on one transaction
    count once even if several streams have seen them."""
    related = hits.join(touched, "transaction_id", "left_semi")
    once = related.groupBy("transaction_id", "rule_triggered").agg(F.min("stream").alias("stream"))
    return related.join(once, ["transaction_id", "rule_triggered", "stream"]).drop("stream", "batch")


def write_alerts(
    flags: DataFrame,
    store: AlertStore,
    checkpoint: str,
    overwrite: bool = False,
    created_at: datetime | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Merge each micro-batch of rule hits into the store.

    Any number of streams may feed one store.  Their hits are kept below the
    store's path, by bucket of the transaction, stream and batch; the
    transactions of a batch are scored from all their hits of all streams,
    which lie in the batch's own buckets; older batches are merged (``Hits``).
    Existing alerts get the new score,
    level and rules and keep their id and review; with ``overwrite`` they are
    replaced.  A batch that is run again changes nothing.  ``trigger`` holds
    the arguments of ``DataStreamWriter.trigger``; by default all that is
    there is read and the query ends.
    """
    # A letter first: as a folder name it must not be taken for a number.
    stream = "s" + hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def score(hits: Hits, number: int) -> DataFrame | None:
        # At most BUCKETS buckets; a small batch lists and opens only its own.
        own_folders = hits.live(f"bucket=*/stream={stream}/batch={number}")
        if not own_folders:
            return None
        buckets = sorted(f.rsplit("/", 3)[1] for f in own_folders)
        found = hits.read(hits.live(f"{{{','.join(buckets)}}}/stream=*/batch=*")).drop("bucket")
        own = found.filter((F.col("stream") == stream) & (F.col("batch") == number))
        return materialised(score_flags(_hits_of(found, own.select("transaction_id").distinct())), "streamed")

    def merge(batch: DataFrame, number: int) -> None:
        tag, hits = f"{stream}.{number}", Hits(batch.sparkSession, store)
        if number and number % FANOUT == 0:
            hits.merge(stream, number)
        # Written even if applied before: a stateful stream wants its rows consumed.
        hits.write(batch, stream, number)
        if store.applied(tag):
            return
        for attempt in range(ATTEMPTS):
            try:
                scored = score(hits, number)
                break
            except Exception as error:
                if attempt + 1 == ATTEMPTS or not any(sign in str(error) for sign in _GONE):
                    raise
        if scored is None:
            return
        if overwrite:
            store.store_alerts(scored, True, created_at, tag)
        else:
            store.rescore(scored, created_at, tag)

    return (
        flags.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(merge)
        .start()
    )
