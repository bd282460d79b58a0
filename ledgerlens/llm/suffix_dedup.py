"""Exact removal of long byte strings that an earlier document already holds.

Every string of 50 bytes belongs to the smallest hash among its inner strings of 24 bytes,
its anchor, so equal strings have equal anchors wherever they stand.  Stretches of text
whose anchor occurs in two documents are dealt to buckets by anchor; in each bucket an
induced suffix sort with common-prefix values brings equal strings together.

Texts stay where they are: they lie in shard files of bounded size in the shared folder, and
only packed hashes, distinct stretches and run-length coded answers are shuffled.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import (
    bucket_of, by_key, bytes_of, dealt, mix, partitions, prefix_hash, ragged, read_table, small_batches,
    span_hash, steps, stored, write_table,
)
from ledgerlens.llm.induced import induced_suffix_array
from ledgerlens.settings import scratch_path

LENGTH, ANCHOR = 50, 24
#: Bytes of text in a shard file, and bytes of the input per bucket.
SHARD_BYTES, BUCKET_BYTES = 4 << 20, 2 << 20
#: Strings whose answers are looked up at a time.
STRINGS = 1 << 18
#: Stretches of one anchor beyond which its strings are dealt out one by one, by their own hash.
HOT = 20_000
#: Odd factor of the anchors' hashes.
STEP = 0x9E3779B97F4A7C15
#: Documents without an id come after all others.
LAST = np.iinfo(np.int64).max


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` bytes: it only picks anchors, so two that agree cost a comparison."""
    part, size, out, done = data.astype(np.uint64), 1, None, 0
    while True:
        # ``part`` hashes every ``size`` bytes; the bits of ``width`` say which sizes to join.
        factor = np.uint64(pow(STEP, size, 1 << 64))
        if width & size:
            out = part if out is None else out[: len(part) - done] * factor + part[done : done + len(out)]
            done += size
        if done == width:
            return mix(out[: len(data) - width + 1])
        part = part[:-size] * factor + part[size:]
        size *= 2


def anchored_stretches(
    data: np.ndarray, offsets: np.ndarray, length: int, anchor: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive string starts with one anchor: its hash, the first start, and how many.

    No string crosses the end of a text.
    """
    n = len(data) - length + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = window_hashes(data, anchor)
    width, k = length - anchor + 1, 1
    while 2 * k <= width:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    if k < width:
        least = np.minimum(least[: k - width], least[width - k :])
    last = np.repeat(offsets[1:] - length, np.diff(offsets))[:n]
    inside = np.arange(n) <= last
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
    start = np.flatnonzero(new)
    end = np.minimum(np.append(start[1:], n), last[start] + 1)
    # Minima crowd at the low end; mixed again, they spread evenly over the buckets.
    return mix(least[start]), start, end - start


class Shard:
    """A shard's texts, and the stretches of all anchors in their order."""

    def __init__(self, ids: pa.Array, text: pa.Array, length: int, anchor: int):
        self.length = length
        self.ids = np.array([LAST if i is None else i for i in ids.to_pylist()], dtype=np.int64)
        self.data, self.offsets = bytes_of(text)
        found = [(np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2]
        for a, b in steps(self.offsets):
            at = self.offsets[a]
            part = self.data[at : self.offsets[b]]
            h, start, count = anchored_stretches(part, self.offsets[a : b + 1] - at, length, anchor)
            found.append((h, start + at, count))
        self.anchor, self.start, self.count = (np.concatenate(x) for x in zip(*found))
        self.anchors, self.which = np.unique(self.anchor, return_inverse=True)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, position, side="right") - 1

    def hashes(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Content hashes of stretches in ascending order of start."""
        out = [np.zeros(0, np.uint64)]
        for a, b in steps(self.offsets):
            low, high = np.searchsorted(start, [self.offsets[a], self.offsets[b]])
            if low < high:
                at = self.offsets[a]
                sums = prefix_hash(self.data[at : self.offsets[b]])
                out.append(span_hash(sums, start[low:high] - at, start[low:high] - at + size[low:high]))
        return np.concatenate(out)


def shard_rows(docs: DataFrame, folder: str, buckets: int, length: int, anchor: int) -> DataFrame:
    """Write the shard files; per shard and bucket the packed anchors, and one row (-1) per shard.

    A packed anchor is the low half of its hash; the bucket fixes some of the high half.  Should
    two anchors share it, they only cost a needless comparison.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(1).nbytes
            if size >= SHARD_BYTES:
                yield write(held)
                held, size = [], 0
        if held:
            yield write(held)

    def write(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        uri = f"{folder}/{uuid.uuid4().hex}"
        write_table(uri, table)
        shard = Shard(table["doc_id"], table["text"], length, anchor)
        document = shard.document(shard.start)
        order = np.argsort(shard.which, kind="stable")
        first = np.searchsorted(shard.which[order], np.arange(len(shard.anchors)))
        several = count = np.zeros(0, np.int64)
        if len(first):
            # Stretches lie in order of documents.
            last = np.append(first[1:], len(order)) - 1
            several = document[order[first]] < document[order[last]]
            count = last - first + 1
        told = (np.minimum(count, 127) | (several.astype(np.int64) << 7)).astype(np.uint8)
        b = bucket_of(shard.anchors, buckets)
        used, cut = np.unique(b, return_index=True)
        ends = np.append(cut[1:], len(b))
        low = (shard.anchors & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        keys = [b""] + [low[s:e].tobytes() for s, e in zip(cut, ends)]
        counts = [b""] + [told[s:e].tobytes() for s, e in zip(cut, ends)]
        return pa.RecordBatch.from_arrays(
            [pa.array([-1, *used.tolist()], pa.int32()), pa.array([uri] * len(keys)), pa.array(keys, pa.binary()),
             pa.array(counts, pa.binary())], ["bucket", "shard", "keys", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "bucket int, shard string, keys binary, counts binary")


def judge_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per packed anchor of a shard: 0 if one document has it, 1 if several, 2 if it is hot."""
    for bucket, rows in by_key(batches):
        keys = [np.frombuffer(r[1], np.uint32) for r in rows]
        told = np.concatenate([np.frombuffer(r[2], np.uint8) for r in rows]).astype(np.int64)
        sizes = [len(k) for k in keys]
        _, which, shards = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        several = np.bincount(which, told >> 7) > 0
        total = np.bincount(which, told & 127)
        code = np.where((shards > 1) | several, np.where(total > HOT, 2, 1), 0).astype(np.uint8)[which]
        at, out = 0, []
        for (shard, *_), n in zip(rows, sizes):
            own = code[at : at + n]
            at += n
            if own.any():
                out.append((shard, bucket, own.tobytes(), n))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int32()),
             pa.array([r[2] for r in out], pa.binary())], ["shard", "bucket", "codes"])


def cut_stretches(buckets: int, length: int, anchor: int) -> Callable:
    """Distinct stretches of the shards' shared anchors, with the smallest document of each.

    Where each stretch stands is noted in a file beside the shard's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, rows in by_key(batches):
            table = read_table(uri)
            shard = Shard(table["doc_id"], table["text"], length, anchor)
            code = np.zeros(len(shard.anchors), dtype=np.uint8)
            edge = np.searchsorted(bucket_of(shard.anchors, buckets), np.arange(buckets + 1))
            for bucket, codes in rows:
                if bucket >= 0:
                    code[edge[bucket] : edge[bucket + 1]] = np.frombuffer(codes, np.uint8)
            code = code[shard.which]
            # Strings of hot anchors stand alone.
            times = np.where(code == 2, shard.count, np.minimum(code, 1))
            origin = np.repeat(np.arange(len(code)), times)
            step = ragged(np.zeros(len(times), np.int64), times)
            start = shard.start[origin] + step
            count = np.where(code[origin] == 2, 1, shard.count[origin])
            size = count + length - 1
            content = shard.hashes(start, size)
            home = bucket_of(np.where(code[origin] == 2, mix(content), shard.anchor[origin]), buckets)
            order = np.lexsort((content, home))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (content[order][1:] != content[order][:-1]) | (home[order][1:] != home[order][:-1])
            number = np.empty(len(order), dtype=np.int64)
            number[order] = np.cumsum(new) - 1
            first = order[new]
            ids = shard.ids[shard.document(start)]
            least = np.minimum.reduceat(ids[order], np.flatnonzero(new)) if len(order) else ids
            write_table(f"{uri}.places", pa.table({
                "start": start.astype(np.int32), "count": count.astype(np.int32), "number": number.astype(np.int32)}))
            used, cut = np.unique(home[first], return_index=True)
            out = []
            for b, s, e in zip(used.tolist(), cut, np.append(cut[1:], len(first))):
                own = first[s:e]
                text = shard.data[ragged(start[own], size[own])]
                out.append((b, uri, text.tobytes(), size[own].astype(np.int32).tobytes(), least[s:e].tobytes()))
            for at in range(0, max(len(out), 1), 64):
                some = out[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in some], t) for i, t in enumerate(
                        (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()))],
                    ["bucket", "shard", "texts", "sizes", "least"])

    return run


def sort_bucket(text: np.ndarray, size: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """The smallest document of every string of every stretch, in order of the stretches.

    Equal stretches are sorted once.  In the suffix array, neighbours with a common prefix of
    ``length`` or more are equal strings.
    """
    ends = np.cumsum(size)
    content = np.concatenate([
        span_hash(prefix_hash(text[low:high]), ends[a:b] - size[a:b] - low, ends[a:b] - low)
        for a, b in steps(np.concatenate([[0], ends]))
        for low, high in [(ends[a] - size[a], ends[b - 1])]
    ])
    _, first, which = np.unique(content, return_index=True, return_inverse=True)
    smallest = np.full(len(first), LAST)
    np.minimum.at(smallest, which, least)
    own = size[first]
    # Bytes above 1, 1 after each stretch, and the only 0 at the end.
    starts = np.cumsum(own + 1) - (own + 1)
    t = np.ones(int((own + 1).sum()) + 1, dtype=np.uint16)
    t[ragged(starts, own)] = text[ragged(ends[first] - own, own)].astype(np.uint16) + 2
    t[-1] = 0
    strings = own - length + 1
    owner = np.full(len(t), -1, dtype=np.int32)
    owner[ragged(starts, strings)] = np.repeat(np.arange(len(own)), strings)
    sa, lcp = induced_suffix_array(t, length)
    group = np.cumsum(lcp < length)
    valid = owner[sa] >= 0
    sa, group = sa[valid], group[valid]
    head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    low = np.minimum.reduceat(smallest[owner[sa]], head)
    answer = np.zeros(len(t), dtype=np.int64)
    answer[sa] = np.repeat(low, np.diff(np.append(head, len(sa))))
    return answer[ragged(starts[which], strings[which])]


def sort_stretches(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in by_key(batches):
            text = np.concatenate([np.frombuffer(r[1], np.uint8) for r in rows])
            sizes = [np.frombuffer(r[2], np.int32).astype(np.int64) for r in rows]
            least = np.concatenate([np.frombuffer(r[3], np.int64) for r in rows])
            answer = sort_bucket(text, np.concatenate(sizes), least, length)
            out, at = [], 0
            for (shard, *_), size in zip(rows, sizes):
                n = int((size - length + 1).sum())
                own = answer[at : at + n]
                at += n
                head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                runs = np.diff(np.append(head, n)).astype(np.int32)
                out.append((shard, bucket, own[head].tobytes(), runs.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t)
                 for i, t in enumerate((pa.string(), pa.int32(), pa.binary(), pa.binary()))],
                ["shard", "bucket", "values", "runs"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, texts: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` and, with ``texts``, ``kept``.

    A byte of the UTF-8 text is removed if a string of ``length`` bytes that covers it also
    starts in a document with a smaller ``doc_id``.  ``spans`` are the maximal removed runs,
    ``kept`` the other bytes (binary, as a cut may fall into a character).  Null texts are empty;
    a null id comes after all others; rows with equal ids do not affect each other.
    """
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES
    tasks = max(1, min(buckets, max(partitions(spark), buckets // 4)))
    folder = scratch_path(spark, "text-shards")
    sent = stored(shard_rows(docs, folder, buckets, length, anchor), "anchors")
    shards = sent.where("bucket = -1").select("shard", "bucket")

    codes = stored(
        dealt(sent.where("bucket >= 0"), "bucket", "shard", tasks)
        .mapInArrow(judge_anchors, "shard string, bucket int, codes binary"), "anchor-codes")
    asked = codes.unionByName(shards.withColumn("codes", F.lit(b"")))
    stretches = dealt(asked, "shard", "bucket", tasks).mapInArrow(
        cut_stretches(buckets, length, anchor), "bucket int, shard string, texts binary, sizes binary, least binary")
    answers = stored(
        dealt(stretches, "bucket", "shard", tasks)
        .mapInArrow(sort_stretches(length), "shard string, bucket int, values binary, runs binary"), "answers")
    id_type = docs.schema["doc_id"].dataType
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(span)] + [pa.binary()] * texts
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * texts

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, rows in by_key(batches):
            table = read_table(uri)
            ids = table["doc_id"].to_pylist()
            order = np.array([LAST if i is None else i for i in ids], dtype=np.int64)
            data, offsets = bytes_of(table["text"])
            cover = np.zeros(len(data) + 1, dtype=np.int32)
            rows = [r for r in rows if r[0] >= 0]
            if rows:
                places = read_table(f"{uri}.places")
                start, count, number = (places[c].to_numpy().astype(np.int64) for c in ("start", "count", "number"))
                values = np.concatenate([np.frombuffer(r[1], np.int64) for r in rows])
                ends = np.cumsum(np.concatenate([np.frombuffer(r[2], np.int32) for r in rows]), dtype=np.int64)
                # Answers come in order of the stretches' numbers.
                _, one = np.unique(number, return_index=True)
                begin = np.cumsum(count[one]) - count[one]
                own = order[np.searchsorted(offsets, start, side="right") - 1]
                for a, b in steps(np.concatenate([[0], np.cumsum(count)]), STRINGS):
                    asked = ragged(begin[number[a:b]], count[a:b])
                    least = values[np.searchsorted(ends, asked, side="right")]
                    gone = ragged(start[a:b], count[a:b])[least < np.repeat(own[a:b], count[a:b])]
                    np.add.at(cover, gone, 1)
                    np.add.at(cover, gone + length, -1)
            removed = np.cumsum(cover[:-1], dtype=np.int32) > 0
            out = []
            for d, doc_id in enumerate(ids):
                own = removed[offsets[d] : offsets[d + 1]]
                text = data[offsets[d] : offsets[d + 1]]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))).tolist()
                kept = (text[~own] if edge else text).tobytes()
                spans = [{"start": s, "end": e} for s, e in zip(edge[0::2], edge[1::2])]
                row = (doc_id, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans)
                out.append(row + ((kept,) if texts else ()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

    told = answers.unionByName(shards.withColumns({"values": F.lit(b""), "runs": F.lit(b"")}))
    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
              "spans array<struct<start:long,end:long>>" + ", kept binary" * texts)
    return dealt(told, "shard", "bucket", tasks).mapInArrow(finish, schema).withColumn("doc_id", F.col("doc_id").cast(id_type))
