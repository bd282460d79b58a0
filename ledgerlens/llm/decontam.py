"""Benchmark decontamination with an FM-index per shard of training documents.

Each shard's words are indexed once; the phrases of all test items are searched backwards
through the wavelet tree, their occurrences located from sampled suffix positions, and
the spans they cover merged and cut out.
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
    ALNUM_WORD, LOWER, bytes_of, prefix_hash, read_table, small_batches, span_hash, steps, stored, word_spans,
    with_n_chars, write_table,
)
from ledgerlens.llm.fm_index import FMIndex
from ledgerlens.settings import scratch_path

#: Words of a phrase; an item of fewer words is one phrase.
WINDOW = 10
#: Bytes of text in a shard, and of item texts in a block of phrases.
SHARD_BYTES, BLOCK_BYTES = 5 << 20, 4 << 20


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, byte starts and ends of all words, and the n + 1 word offsets of the texts."""
    data, offsets = bytes_of(column)
    hashes, starts, ends, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [[0]]
    for a, b in steps(offsets):
        part = LOWER[data[offsets[a] : offsets[b]]]
        start, end, bounds = word_spans(part, offsets[a : b + 1] - offsets[a], ALNUM_WORD)
        hashes.append(span_hash(prefix_hash(part), start, end))
        starts.append(start + offsets[a])
        ends.append(end + offsets[a])
        counts.append(np.diff(bounds))
    return (np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends),
            np.cumsum(np.concatenate(counts)).astype(np.int64))


def spelled(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """A 128-bit digest of lower-cased words, given by their places in the text's bytes."""
    text = LOWER[data[start[0] : end[-1]]].tobytes()
    words = [text[s:e] for s, e in zip((start - start[0]).tolist(), (end - start[0]).tolist())]
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def phrase_blocks(items: DataFrame, window: int = WINDOW) -> list[str]:
    """Write the distinct phrases of ``item_id, text`` in blocks of bounded size; returns their places.

    A block holds word hashes and a digest of each phrase, and the items it comes from.
    """
    folder = scratch_path(items.sparkSession, "phrases")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, ids, texts, held = [], [], [], 0

        def write() -> None:
            column = pa.array(texts, pa.string())
            words, start, end, bounds = hashed_words(column)
            rows, owner, first = [], [], []
            for i in range(len(texts)):
                own = words[bounds[i] : bounds[i + 1]]
                if len(own):
                    view = np.lib.stride_tricks.sliding_window_view(own, min(window, len(own)))
                    full = np.zeros((len(view), window + 1), dtype=np.uint64)
                    full[:, : view.shape[1]] = view
                    full[:, window] = view.shape[1]
                    rows.append(full)
                    owner.append(np.full(len(view), i))
                    first.append(bounds[i] + np.arange(len(view)))
            if not rows:
                return
            data, first = bytes_of(column)[0], np.concatenate(first)
            digests = [spelled(data, start[f : f + n], end[f : f + n])
                       for f, n in zip(first, np.concatenate(rows)[:, window].astype(np.int64))]
            # With their digests, phrases whose hashes meet stay apart.
            marks = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
            phrases, which = np.unique(
                np.concatenate([np.concatenate(rows), marks], axis=1), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.ravel(), np.concatenate(owner)]), axis=1)
            table = pa.table({"data": [pa.py_buffer(phrases.tobytes()).to_pybytes()],
                              "phrase": [pairs[0]], "item": [pairs[1]], "ids": [ids]})
            done.append(f"{folder}/{uuid.uuid4().hex}")
            write_table(done[-1], table)

        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(item_id)
                texts.append(text)
                held += len(text or "")
                if held >= BLOCK_BYTES:
                    write()
                    ids, texts, held = [], [], 0
        write()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["block"])

    rows = items.select(F.col("item_id").cast("string"), "text").coalesce(1 + size // BLOCK_BYTES)
    return [r["block"] for r in stored(rows.mapInArrow(run, "block string"), "phrase-blocks").collect()]


def load_block(uri: str, window: int) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray, list]:
    table = read_table(uri)
    full = np.frombuffer(table["data"][0].as_py(), np.uint64).reshape(-1, window + 3)
    phrase, item = (np.array(table[c][0].as_py(), dtype=np.int64) for c in ("phrase", "item"))
    marks = [m.tobytes() for m in full[:, window + 1 :]]
    return full[:, :window], full[:, window].astype(np.int64), marks, phrase, item, table["ids"][0].as_py()


class Shard:
    """The index of some documents; symbol 0 stands between documents."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        self.vocabulary, symbol = np.unique(words, return_inverse=True)
        n, docs = len(words), len(bounds) - 1
        # A separator goes before each document.
        self.document = np.repeat(np.arange(docs), np.diff(bounds))
        text = np.zeros(n + docs + 1, dtype=np.int64)
        text[np.arange(n) + self.document + 1] = symbol + 1
        self.index = FMIndex(text, len(self.vocabulary) + 1)
        self.before = np.zeros(n + docs + 1, dtype=np.int64)
        self.before[np.arange(n) + self.document + 1] = np.arange(n)

    def occurrences(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrase number and first word of every occurrence."""
        if not len(self.vocabulary):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, phrases), len(self.vocabulary) - 1)
        inside = np.arange(phrases.shape[1])[None, :] < lengths[:, None]
        known = np.flatnonzero(((self.vocabulary[at] == phrases) | ~inside).all(axis=1))
        low, high = self.index.ranges(at[known] + 1, lengths[known])
        size = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(known)), size)
        rows = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        return known[which], self.before[self.index.locate(rows)]


def _searcher(blocks: list[str], window: int) -> Callable[[pa.ChunkedArray], tuple]:
    """Searches the phrases of all blocks in a column of texts, indexed as one shard."""
    loaded: dict = {}

    def search(text: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, list[list[str]], list[list[tuple]], list]:
        column = text.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0)
        words, start, end, bounds = hashed_words(column)
        data, offsets = bytes_of(column)
        n_docs = len(column)
        shard = Shard(words, bounds)
        cover = np.zeros(len(words) + 1, dtype=np.int64)
        found: list[set] = [set() for _ in range(n_docs)]
        for uri in blocks:
            if uri not in loaded:
                loaded.clear()
                loaded[uri] = load_block(uri, window)
            phrases, lengths, marks, phrase, item, ids = loaded[uri]
            which, first = shard.occurrences(phrases, lengths)
            same = [spelled(data, start[f : f + n], end[f : f + n]) == marks[w]
                    for w, f, n in zip(which.tolist(), first.tolist(), lengths[which].tolist())]
            same = np.array(same, dtype=bool)
            which, first = which[same], first[same]
            np.add.at(cover, first, 1)
            np.add.at(cover, first + lengths[which], -1)
            if len(which):
                # Each phrase of a document once.
                document, which = np.unique(np.stack([shard.document[first], which]), axis=1)
                cut = np.searchsorted(phrase, [which, which + 1])
                for d, a, b in zip(document.tolist(), *cut.tolist()):
                    found[d].update(ids[i] for i in item[a:b].tolist() if ids[i] is not None)
        hit = np.cumsum(cover[:-1]) > 0
        # Runs of hit words, cut where a document ends.
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        inner = np.unique(bounds[(bounds > 0) & (bounds < len(words))])
        inner = inner[hit[inner] & hit[inner - 1]]
        first, last = np.sort(np.concatenate([edge[0::2], inner])), np.sort(np.concatenate([edge[1::2], inner]))
        at = np.searchsorted(shard.document[first], np.arange(n_docs + 1))
        n_hit = np.bincount(shard.document[hit], minlength=n_docs)
        spans, left = [], column.to_pylist()
        for d in range(n_docs):
            own = [(int(start[first[i]] - offsets[d]), int(end[last[i] - 1] - offsets[d])) for i in range(at[d], at[d + 1])]
            spans.append(own)
            if own:
                text_, kept, done = data[offsets[d] : offsets[d + 1]].tobytes(), [], 0
                for s, e in own:
                    kept.append(text_[done:s])
                    done = e
                left[d] = (b"".join(kept) + text_[done:]).decode()
        return np.diff(bounds), n_hit, [sorted(f) for f in found], spans, left

    return search


def _shards(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.Table]:
    """The batches, joined to shards of bounded size of their texts."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= SHARD_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, items, spans`` and the ``text`` left.

    ``items`` has ``item_id, text``; a document word is hit if it lies in an occurrence of
    ``window`` consecutive words of an item (of all words of a shorter item).  ``items`` lists the
    distinct item ids, as sorted strings; a null id counts for hits only.  ``spans`` are merged
    byte ranges of the UTF-8 text, which end with the last word hit.  Null texts have no words
    and stay null; repeated rows count one by one.  There is no shuffle: a task indexes its rows
    shard by shard, and reads the phrases block by block from the shared folder.
    """
    small_batches(docs.sparkSession)
    blocks = phrase_blocks(items, window)
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _searcher(blocks, window)
        for shard in _shards(batches, 1):
            n_words, n_hit, found, spans, left = search(shard.column(1))
            spans = [[{"start": s, "end": e} for s, e in own] for own in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(shard.column(0).chunks), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(found, pa.list_(pa.string())), pa.array(spans, pa.list_(span)), pa.array(left, pa.string())],
                ["doc_id", "n_words", "n_hit", "items", "spans", "text"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_hit long, items array<string>, "
             "spans array<struct<start:long,end:long>>, text string")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the merged spans of ``find_contamination`` cut out of ``text``.

    All rows and columns stay; ``n_chars`` follows the new text.
    """
    small_batches(docs.sparkSession)
    blocks = phrase_blocks(items, window)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _searcher(blocks, window)
        for shard in _shards(batches, at):
            left = pa.array(search(shard.column(at))[4], shard.schema.field(at).type)
            yield from shard.set_column(at, shard.schema.field(at), left).to_batches()

    return with_n_chars(docs.mapInArrow(run, docs.schema))


def items_digest(column: str = "items"):
    return F.sha2(F.array_join(column, ","), 256)
