"""Near-duplicate documents by HyperMinHash.

Of a document's word shingles, each of 256 buckets keeps the smallest hash as a register
of 16 bits: its leading zeros and ten bits of mantissa.  Bands of registers propose
candidates, the collision-corrected Jaccard estimate of the registers screens them, and
full shingle sets confirm them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import (
    LOWER, SPACE_WORD, bytes_of, mix, partitions, prefix_hash, small_batches, span_hash, steps, stored, word_spans,
)
from ledgerlens.llm.components import components

SHINGLE = 5
#: Least similarity of a link, in per cent.
PERCENT = 75
BUCKET_BITS, MANTISSA_BITS = 8, 10
BUCKETS = 1 << BUCKET_BITS
#: Which full bucket an empty one borrows from when bands are cut: the one of highest value.
BORROW = np.random.default_rng(7).permutation(BUCKETS * BUCKETS).reshape(BUCKETS, BUCKETS)
#: Registers of a band.  Documents at the threshold share no band of 64 with probability 3e-11.
BAND = 4
#: A candidate passes if its estimate is at most this many standard errors below the threshold.
ERRORS = 4.5
#: Times that every class is compared with its best lead, before bands are compared within.
LEAD_ROUNDS = 2
#: Documents of a band that one task compares; larger bands are dealt out as pairs of blocks.
BLOCK = 2_000
#: Sets of at most this many shingles bring their hashes, cut to 32 bits, into the bands.
BRIEF = 256
#: Bands of at most this many documents are paired before their sketches are fetched.
SMALL = 8
#: Bands of more documents are first split by what their documents share in another band.
LARGE = 20_000


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; no words, no shingles."""
    data, offsets = bytes_of(column)
    for a, b in steps(offsets):
        part = LOWER[data[offsets[a] : offsets[b]]]
        start, end, bounds = word_spans(part, offsets[a : b + 1] - offsets[a], SPACE_WORD)
        words = span_hash(prefix_hash(part), start, end)
        n = len(words) - SHINGLE + 1
        run = np.zeros(max(n, 0), dtype=np.uint64)
        for k in range(SHINGLE if n > 0 else 0):
            run = mix(run * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
        for d in range(b - a):
            first, last = int(bounds[d]), int(bounds[d + 1])
            if last - first >= SHINGLE:
                yield np.unique(run[first : last - SHINGLE + 1])
            elif last > first:
                whole = np.uint64(last - first)
                for w in words[first:last]:
                    whole = mix(np.array([whole ^ w], dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9))[0]
                yield np.array([whole], dtype=np.uint64)
            else:
                yield np.zeros(0, dtype=np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set: per bucket (leading zeros + 1) and mantissa, or 0 if empty."""
    out = np.zeros(BUCKETS, dtype=np.uint16)
    if len(hashes):
        bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        # 52 bits below the bucket number are exact in a double.
        value = (hashes[first] << np.uint64(BUCKET_BITS)) >> np.uint64(12)
        zeros = 52 - np.frexp(value.astype(np.float64))[1].astype(np.int64)
        top = (value << zeros.astype(np.uint64)) & np.uint64((1 << 51) - 1)
        mantissa = (top >> np.uint64(51 - MANTISSA_BITS)).astype(np.int64)
        out[bucket[first]] = ((zeros + 1) << MANTISSA_BITS) + mantissa
    return out


def brief(hashes: np.ndarray) -> bytes:
    """A small set's hashes cut to 32 bits, sorted; nothing for larger sets, or if two become one.

    Common members of two briefs are at least those of the sets, so comparing them loses no link.
    """
    short = np.unique((hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)) if len(hashes) <= BRIEF else hashes[:0]
    return short.tobytes() if len(short) == len(hashes) else b""


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """64-bit keys of the bands of a sketch; none without a register.

    Buckets that are empty, as in small sets, borrow from a full one that is fixed for each
    bucket and set of full buckets, so that registers of any sets agree about as often as the
    sets do, and bands of small sets do not agree on emptiness.
    """
    full = np.flatnonzero(sketch)
    if not len(full):
        return np.zeros(0, dtype=np.uint64)
    if len(full) < BUCKETS:
        empty = np.flatnonzero(sketch == 0)
        sketch = sketch.copy()
        sketch[empty] = sketch[full[np.argmax(BORROW[np.ix_(empty, full)], axis=1)]]
    value = np.ascontiguousarray(sketch).view(np.uint64)
    return mix(value ^ mix(np.arange(1, len(value) + 1, dtype=np.uint64)))


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of sketches (rows), and the number of buckets they rest on.

    Registers of different minima agree by chance with probability
    ``0.72 * ab / (a + b) ** 2 / 2 ** mantissa bits`` for ``a`` and ``b`` hashes; these
    expected collisions are taken off the agreeing registers.
    """
    full = ((a | b) != 0).sum(axis=-1)
    same = ((a == b) & (a != 0)).sum(axis=-1)
    chance = 0.72 * n_a * n_b / np.maximum(n_a + n_b, 1) ** 2 / (1 << MANTISSA_BITS)
    return np.where(full > 0, (same - full * chance) / (1 - chance) / np.maximum(full, 1), 0.0), full


def passes(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    t = percent / 100
    found, full = estimate(a, b, n_a, n_b)
    near = found >= t - ERRORS * np.sqrt(t * (1 - t) / np.maximum(full, 1))
    return near & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_key`` (digest of the shingle set), ``sketch`` and ``brief`` of each row."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, sketches, briefs = [], [], [], []
            for s in shingle_sets(batch.column(1)):
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sketches.append(registers(s).tobytes())
                briefs.append(brief(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()),
                 pa.array(briefs, pa.binary())], ["doc_id", "n_shingles", "set_key", "sketch", "brief"])

    schema = f"doc_id {kind.simpleString()}, n_shingles long, set_key binary, sketch binary, brief binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), BUCKETS)


def _screened(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose sketches pass."""

    @F.pandas_udf("boolean")
    def ok(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        return pd.Series(passes(_matrix(a), _matrix(b), n_a.to_numpy(), n_b.to_numpy(), percent))

    def side(name: str) -> DataFrame:
        return classes.select(F.col("class").alias(name), F.col("n_shingles").alias(f"n_{name}"),
                              F.col("sketch").alias(f"s_{name}"))

    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .where(ok("s_a", "s_b", "n_a", "n_b")).select("a", "b")
    )


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``class, hashes`` (sorted, 8 bytes each) of the wanted classes (``class, set_key, doc_id``)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column(0))]
            keys = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["set_key", "hashes"])

    chosen = docs.select("doc_id", "text").join(wanted.select("doc_id"), "doc_id", "left_semi").select("text")
    return chosen.mapInArrow(run, "set_key binary, hashes binary").join(
        wanted.select("class", "set_key"), "set_key").select("class", "hashes")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``u, v`` whose full sets reach the threshold."""

    @F.pandas_udf("boolean")
    def ok(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.sort(np.concatenate([x, y]))
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pd.Series(out, dtype=bool)

    return (
        pairs.join(sets.toDF("a", "h_a"), "a").join(sets.toDF("b", "h_b"), "b")
        .where(ok("h_a", "h_b")).select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def _shared(bands: DataFrame) -> DataFrame:
    """Rows (``key, class, n``) of bands that several classes share, with their number."""
    return bands.join(bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")


def _to_leads(bands: DataFrame) -> DataFrame:
    """One pair per class (``key, class, n, component``): with the best lead outside its component.

    The lead of a band is the class with the most company in all its bands: the text that a
    family of near copies was made from is closer to each of them than they are to each other.
    """
    company = bands.groupBy("class").agg(F.sum("n").alias("company"))
    leads = (
        bands.join(company, "class").groupBy("key")
        .agg(F.max(F.struct("company", "class", "component")).alias("lead"))
    )
    best = (
        bands.join(leads, "key").where("component <> lead.component")
        .groupBy("class").agg(F.max("lead").alias("lead")).select("class", F.col("lead.class").alias("lead"))
    )
    return best.select(F.least("class", "lead").alias("a"), F.greatest("class", "lead").alias("b")).distinct()


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (``key, class, n``) of bands that still hold several components."""
    known = (
        members.join(labels, members["class"] == labels["node"], "left")
        .select("key", "class", "n", F.coalesce("component", "class").alias("component"))
    )
    several = known.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return known.join(several.where("low < high").select("key"), "key", "left_semi")


def _within_small(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Screened pairs of classes of different components that share a small band.

    A member brings at most ``SMALL / 2`` pairs of numbers, less than its sketch would take, and
    a pair that shares several bands is screened once.
    """
    tasks = partitions(members.sparkSession)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            now = None if batch is None else [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if now is not None and rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            elif now is None:
                now, rest = rest, None
            if now is None:
                continue
            # The last band of a batch may go on in the next.
            end = len(now[0]) if batch is None else int(np.searchsorted(now[0], now[0][-1]))
            rest = None if batch is None else [x[end:] for x in now]
            key, c, k, n = (x[:end] for x in now)
            found = []
            for d in range(1, min(SMALL, end)):
                i = np.flatnonzero((key[d:] == key[:-d]) & (k[d:] != k[:-d]))
                i = i[100 * np.minimum(n[i], n[i + d]) >= percent * np.maximum(n[i], n[i + d])]
                if not len(i) and not (key[d:] == key[:-d]).any():
                    break
                found.append(np.stack([np.minimum(c[i], c[i + d]), np.maximum(c[i], c[i + d])]))
            pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64())], ["a", "b"])

    placed = members.join(classes.select("class", "n_shingles"), "class").select("key", "class", "component", "n_shingles")
    pairs = placed.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(pair, "a long, b long").distinct()
    return _screened(pairs, classes, percent)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches that hold rows, and None at the end."""
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def _within_bands(members: DataFrame, classes: DataFrame, percent: int, once: bool) -> DataFrame:
    """Screened pairs of classes of different components that share a band of any size.

    A task holds one block of a band or two; no pair leaves it that the sketches rule out.
    With ``once``, where keys are those of ``band_keys``, a pair leaves only the first band it shares.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class"), blocks).cast("int")
    placed = (
        members.withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "class",
                "component")
        .join(classes.select("class", "n_shingles", "sketch", "brief"), "class")
    )
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n_shingles", "class"], kind="stable")
        s, n = _matrix(group["sketch"]), group["n_shingles"].to_numpy()
        c, k, own = group["class"].to_numpy(), group["component"].to_numpy(), group["own"].to_numpy()
        cross = group["low"].iloc[0] != group["high"].iloc[0]
        here = np.int64(group["key"].iloc[0])
        bands = np.stack([band_keys(x).view(np.int64) for x in s]) if once else None
        briefs = [np.frombuffer(b, np.uint32) for b in group["brief"]]
        known = np.array([len(b) > 0 for b in briefs])
        found = []
        for i in range(len(group) - 1):
            # Sizes ascend: those after the last close enough are too large.
            end = int(np.searchsorted(n, n[i] * 100 // percent, side="right"))
            j = np.arange(i + 1, end)
            j = j[(k[j] != k[i]) & ((own[j] != own[i]) if cross else True)]
            if len(j):
                j = j[passes(s[i][None, :], s[j], n[i : i + 1], n[j], percent)]
            if len(j) and once:
                shared = np.where(bands[j] == bands[i], bands[i], np.iinfo(np.int64).max)
                j = j[shared.min(axis=1) == here]
            if known[i] and (small := j[known[j]]).size:
                # Common members of small sets, counted at once.
                values, size = np.concatenate([briefs[x] for x in small]), n[small]
                at = np.minimum(np.searchsorted(briefs[i], values), len(briefs[i]) - 1)
                both = np.add.reduceat((briefs[i][at] == values).astype(np.int64), np.cumsum(size) - size)
                j = np.concatenate([j[~known[j]], small[100 * both >= percent * (n[i] + size - both)]])
            if len(j):
                found.append(np.stack([np.full(len(j), c[i]), c[j]], axis=1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    return placed.groupBy("key", "low", "high").applyInPandas(compare, "a long, b long").distinct()


def _split(large: DataFrame, bands: DataFrame) -> DataFrame:
    """Large bands cut by a second shared band; documents at the threshold share two or more of 64."""
    other = bands.select("class", F.col("key").alias("second")).join(
        large.select("class").distinct(), "class", "left_semi")
    cut = (
        large.select(F.col("key").alias("first"), "class", "component").join(other, "class")
        .where("first <> second").select(F.xxhash64("first", "second").alias("key"), "class", "component")
    )
    groups = cut.groupBy("key").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    return cut.join(groups.where("n > 1 and low < high").select("key", "n"), "key")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Documents are linked if ``100 * |A and B| >= percent * |A or B|`` for their sets of distinct
    shingles of five words (all words as one, if fewer); ``component_id`` is the smallest id
    reachable by links, and ``kept`` marks the row of that id.  Documents without words, or with
    a null text, have no links.  Rows with a null id have no links, a null component and are
    kept.  Rows that repeat an id are one document: both are kept or neither.

    Equal sets are one class.  Each class is first compared with the best lead of its bands.  Only bands that then still hold several
    components are compared within, so a large group of copies costs one comparison per copy.
    """
    small_batches(docs.sparkSession)
    rows = stored(signatures(docs), "signatures")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    # Writing fixes the numbers given to the classes.
    classes = stored(
        full.groupBy("set_key", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"), F.first("brief").alias("brief"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes")
    numbers, sketches = classes.select("set_key", "class"), classes.select("class", "n_shingles", "sketch", "brief")
    again = stored(full.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1"), "repeated-ids")
    repeated = not again.isEmpty()
    by_id = full.select("doc_id", "set_key").join(again, "doc_id").join(numbers, "set_key")
    by_id = by_id.join(by_id.groupBy("doc_id").agg(F.min("class").alias("v")), "doc_id").select(
        F.col("class").alias("u"), "v")

    def bands_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [band_keys(np.frombuffer(s, np.uint16)) for s in batch.column(1).to_pylist()]
            owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            found = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(found)], ["class", "key"])

    all_bands = sketches.select("class", "sketch").mapInArrow(bands_of, "class long, key long")
    bands = stored(_shared(all_bands), "bands")
    wanted = classes.select("class", "set_key", "doc_id").join(bands.select("class"), "class", "left_semi")
    sets = _sets(docs, wanted)
    sets = stored(sets.dropDuplicates(["class"]) if repeated else sets, "sets")
    links = stored(by_id if repeated else by_id.limit(0), "links")
    rest, labels = bands.withColumn("component", F.col("class")), None
    for _ in range(LEAD_ROUNDS):
        pairs = stored(_screened(_to_leads(rest), sketches, percent), "pairs")
        links = stored(links.unionAll(_confirmed(pairs, sets, percent)), "links")
        labels = components(links)
        rest = stored(_apart(rest.select("key", "class", "n"), labels), "bands-apart")
    second = _within_small(rest.where(f"n <= {SMALL}"), sketches, percent).unionAll(
        _within_bands(rest.where(f"n > {SMALL} and n <= {LARGE}"), sketches, percent, True))
    large = rest.where(f"n > {LARGE}")
    if not large.isEmpty():
        split = stored(_split(large, all_bands), "bands-apart")
        second = second.unionAll(_within_bands(split, sketches, percent, False))
    more = stored(_confirmed(stored(second.distinct(), "pairs"), sets, percent), "links")
    if not more.isEmpty():
        labels = components(links.unionAll(more))
    placed = full.select("doc_id", "set_key").join(numbers, "set_key").join(labels, F.col("class") == F.col("node"), "left")
    placed = stored(placed.select("doc_id", F.coalesce("component", "class").alias("component")), "placed")
    # Stored, so that the join below stays free to split a component with very many documents.
    smallest = stored(placed.groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    linked = placed.join(smallest, "component").select(F.col("doc_id").alias("id"), "component_id").where("id <> component_id")
    linked = linked.distinct() if repeated else linked
    return (
        rows.select("doc_id", "n_shingles").join(linked, F.col("doc_id") == F.col("id"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents of ``docs`` that are ``kept``: one of each component."""
    gone = near_duplicates(docs, percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
