"""Brown class-based bigram language model.

Exchange clustering puts words into classes: the most frequent ones are moved one by one to
the class that gains most likelihood, the others are then exchanged against these classes,
by what stands around them: first by head words only, then by all words placed so far.  A word's probability is that of its class after the
class before, times its share of its class, interpolated with its share of all words.

Texts become token files of bounded size in the shared folder; counts and classes of words
are gathered in buckets of the word hash and answered file by file, so nothing that grows
with the vocabulary goes through the driver or is broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import (
    LOWER, SPACE_WORD, bucket_of, by_key, bytes_of, dealt, partitions, prefix_hash, read_table,
    small_batches, span_hash, steps, stored, word_spans, write_table,
)
from ledgerlens.settings import scratch_path

#: Classes, and words that are exchanged one by one.
CLASSES, HEAD = 64, 2048
#: Rounds of exchange at most, and rounds in which the words beyond the head are placed.
ROUNDS, REST_ROUNDS = 8, 2
#: Weight of the class model, and counts by which transitions lean on class shares.
CLASS_WEIGHT, LEAN = 0.9, 20.0
#: Bytes of text in a token file, and bytes of the input per bucket of words.
SHARD_BYTES, BUCKET_BYTES = 8 << 20, 8 << 20
#: The token after the last word of a text.
END = np.uint64(0x9D39247E33776D41)


def exchange(pairs: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Classes of words by exchange: ``pairs[v, w]`` counts w after v, words by falling frequency.

    Starts with word ``i`` in class ``i % classes`` and moves every word, in turn, to the class
    that maximises the likelihood of the class bigrams, until nothing moves.
    """
    n = len(pairs)
    own = np.arange(n) % classes
    member = np.zeros((n, classes))
    member[np.arange(n), own] = 1
    pairs = pairs.astype(float)
    after, before = pairs @ member, pairs.T @ member  # of each word, by class
    grid = member.T @ after
    plog = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)
    for _ in range(rounds):
        moved = 0
        for w in range(n):
            a, right, left, loop = own[w], after[w], before[w], pairs[w, w]
            if not right.any() and not left.any():
                continue
            # The grid and margins without the word.
            grid[a, :] -= right
            grid[:, a] -= left
            grid[a, a] += loop
            right, left = right.copy(), left.copy()
            right[a] -= loop
            left[a] -= loop
            out, into = grid.sum(1), grid.sum(0)
            gain = (plog(grid + right[None, :]) - plog(grid)).sum(1) + (plog(grid + left[:, None]) - plog(grid)).sum(0)
            cell = np.diag(grid)
            gain += plog(cell + right + left + loop) - plog(cell + right) - plog(cell + left) + plog(cell)
            r, l_ = right.sum() + loop, left.sum() + loop
            gain -= plog(out + r) - plog(out) + plog(into + l_) - plog(into)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = int(a)
            grid[b, :] += right
            grid[:, b] += left
            grid[b, b] += loop
            if b != a:
                moved += 1
                own[w] = b
                for table, column in ((after, pairs[:, w]), (before, pairs[w, :])):
                    table[:, a] -= column
                    table[:, b] += column
        if not moved:
            break
    return own


def held_out(doc_id: str = "doc_id"):
    """Documents that are not learnt from: checksum of the id, modulo 10, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def token_files(docs: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Write token files of ``doc_id, text, train``; per file and bucket the distinct words' hashes and counts.

    A file has, per text, the number of tokens, and of all tokens their word's place among
    the file's distinct hashes.  The counts are those in texts to learn from.
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
        data, offsets = bytes_of(table["text"])
        hashes, counts = [], []
        for a, b in steps(offsets):
            part = LOWER[data[offsets[a] : offsets[b]]]
            start, end, bounds = word_spans(part, offsets[a : b + 1] - offsets[a], SPACE_WORD)
            words = np.full(len(start) + b - a, END)
            text = np.repeat(np.arange(b - a), np.diff(bounds))
            words[np.arange(len(start)) + text] = span_hash(prefix_hash(part), start, end)
            hashes.append(words)
            counts.append(np.diff(bounds) + 1)
        distinct, token = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.concatenate(counts)
        train = np.repeat(table["train"].to_numpy(zero_copy_only=False).astype(bool), counts)
        seen = np.bincount(token[train], minlength=len(distinct)).astype(np.int32)
        uri = f"{folder}/{uuid.uuid4().hex}"
        write_table(uri, pa.table({
            "doc_id": table["doc_id"], "train": table["train"], "n": counts}))
        write_table(f"{uri}.tokens", pa.table({"token": token.astype(np.int32)}))
        write_table(f"{uri}.words", pa.table({"hash": distinct}))
        used, cut = np.unique(bucket_of(distinct, buckets), return_index=True)
        ends = np.append(cut[1:], len(distinct))
        return pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([uri] * len(used)),
             pa.array([distinct[s:e].tobytes() for s, e in zip(cut, ends)], pa.binary()),
             pa.array([seen[s:e].tobytes() for s, e in zip(cut, ends)], pa.binary())],
            ["bucket", "shard", "keys", "counts"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "train").mapInArrow(
        run, "bucket int, shard string, keys binary, counts binary")


def count_words(folder: str, head: int):
    """Sum a bucket's words; answers each file with the counts of its words, and tells of the bucket.

    The row of the bucket (without a file) has its number of tokens, of words and of words
    seen once, and its most frequent words.  What word is where is noted in a bucket file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in by_key(batches):
            keys = [np.frombuffer(r[1], np.uint64) for r in rows]
            words, which = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(words), dtype=np.int64)
            np.add.at(total, which, np.concatenate([np.frombuffer(r[2], np.int32) for r in rows]))
            sizes = np.array([len(k) for k in keys])
            write_table(f"{folder}/bucket-{bucket}", pa.table({"total": total}))
            write_table(f"{folder}/bucket-{bucket}.which", pa.table({"which": which.astype(np.int32)}))
            # By falling count, then by hash.
            top = np.lexsort((words.view(np.int64), -total))[:head]
            top = top[total[top] > 0]
            out, at = [], 0
            for (shard, *_), n in zip(rows, sizes.tolist()):
                own = total[which[at : at + n]]
                at += n
                out.append((shard, bucket, own.tobytes(), None, None, None, None, None))
            out.append((None, bucket, None, int(total.sum()), int((total > 0).sum()), int((total == 1).sum()),
                        words[top].view(np.int64).tolist(), total[top].tolist()))
            types = [pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(),
                     pa.list_(pa.int64()), pa.list_(pa.int64())]
            for at in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out[at : at + 64]], t) for i, t in enumerate(types)],
                    ["shard", "bucket", "counts", "tokens", "words", "once", "top", "top_counts"])

    return run


class TokenFile:
    """Tokens of a file, with what is known of their words."""

    def __init__(self, uri: str):
        table = read_table(uri)
        self.uri, self.ids, self.n = uri, table["doc_id"], table["n"].to_numpy()
        self.train = table["train"].to_numpy(zero_copy_only=False).astype(bool)
        self.token = read_table(f"{uri}.tokens")["token"].to_numpy().astype(np.int64)
        self.first = np.cumsum(self.n) - self.n

    def words(self) -> np.ndarray:
        return read_table(f"{self.uri}.words")["hash"].to_numpy()

    def learnt(self) -> np.ndarray:
        return np.repeat(self.train, self.n)

    def previous(self, value: np.ndarray, start) -> np.ndarray:
        """The value of the token before each, and ``start`` at the start of a text."""
        out = np.empty_like(value)
        out[1:] = value[:-1]
        out[self.first] = start
        return out


def numbered(words: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Number of each word among the ascending ``head`` hashes, or -1."""
    if not len(head):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(head, words), len(head) - 1)
    return np.where(head[at] == words, at, -1)


def head_pairs(shards: DataFrame, head: np.ndarray, tasks: int) -> np.ndarray:
    """How often head words follow each other in texts to learn from.

    Partial sums leave the tasks; what is collected has at most ``len(head) ** 2`` entries.
    """
    h = len(head)
    end = int(numbered(np.array([END]), head)[0])
    rows = max(1, h // 32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(h * h, dtype=np.int64)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                f = TokenFile(uri)
                now = numbered(f.words(), head)[f.token]
                before = f.previous(now, end)
                good = f.learnt() & (now >= 0) & (before >= 0)
                total += np.bincount(before[good] * h + now[good], minlength=h * h)
        at = np.flatnonzero(total)
        part = at // (rows * h)
        cut = np.searchsorted(part, np.arange(h // rows + 2))
        for k, (s, e) in enumerate(zip(cut[:-1], cut[1:])):
            if s < e:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([0], pa.int32()), pa.array([at[s:e].tobytes()], pa.binary()),
                     pa.array([total[at[s:e]].tobytes()], pa.binary())], ["part", "zero", "at", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in by_key(batches):
            at, which = np.unique(np.concatenate([np.frombuffer(r[1], np.int64) for r in found]), return_inverse=True)
            n = np.zeros(len(at), dtype=np.int64)
            np.add.at(n, which, np.concatenate([np.frombuffer(r[2], np.int64) for r in found]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([at.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["at", "n"])

    summed = dealt(shards.repartition(tasks).mapInArrow(run, "part int, zero int, at binary, n binary"), "part", "zero", tasks)
    out = np.zeros(h * h, dtype=np.int64)
    for row in summed.mapInArrow(add, "at binary, n binary").collect():
        out[np.frombuffer(row["at"], np.int64)] = np.frombuffer(row["n"], np.int64)
    return out.reshape(h, h)


@dataclass(frozen=True)
class Classes:
    """Head words (ascending hashes) and their classes; log gains of a class next to another."""

    head: np.ndarray
    own: np.ndarray
    gain: np.ndarray
    size: int

    @staticmethod
    def learn(head: np.ndarray, counts: np.ndarray, pairs: np.ndarray, classes: int) -> Classes:
        by = np.lexsort((head, -counts))
        own = np.zeros(len(head), dtype=np.int64)
        own[by] = exchange(pairs[np.ix_(by, by)], classes)
        member = np.zeros((len(head), classes))
        member[np.arange(len(head)), own] = 1
        grid = member.T @ pairs @ member + 0.1
        # Of a word with neighbours of class d: the sum over them of log N(c, d) / N(c).
        after = np.log(grid / grid.sum(1, keepdims=True)).T  # word class c, right neighbour d
        before = np.log(grid / grid.sum(0, keepdims=True))  # left neighbour d, word class c
        return Classes(head, own, np.concatenate([before, after]), classes)


def neighbour_classes(model: Classes, buckets: int) -> tuple[Callable, Callable]:
    """Per file and bucket: how many class neighbours each word has, and these, in order of the words.

    The first function takes files and counts head words as neighbours, the second takes files
    with the classes that their words have got so far (past the last: none) and counts all.
    """
    k = model.size
    end = numbered(np.array([END]), model.head)
    start = int(model.own[end[0]]) if end[0] >= 0 else -1

    def contexts(uri: str, placed: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        f = TokenFile(uri)
        words = f.words()
        number = numbered(words, model.head)
        known = np.append(model.own, -1)[number]
        if placed is not None:
            known = np.where(number >= 0, known, np.where(placed < k, placed, -1))
        now = known[f.token]
        left, right = f.previous(now, start), np.append(now[1:], -1)
        right[f.first[1:] - 1] = -1  # past the end of a text
        open_ = f.learnt() & (number[f.token] < 0)
        word, code = [], []
        for side, value in ((0, left), (k, right)):
            good = open_ & (value >= 0)
            word.append(f.token[good])
            code.append(value[good] + side)
        word, code = np.concatenate(word), np.concatenate(code).astype(np.uint8)
        by = np.argsort(word, kind="stable")
        code, n = code[by], np.bincount(word, minlength=len(words)).astype(np.int32)
        ends = np.cumsum(n)
        edge = np.searchsorted(bucket_of(words, buckets), np.arange(buckets + 1))
        used = np.flatnonzero(edge[1:] > edge[:-1])
        cut = np.concatenate([[0], ends])
        for at in range(0, len(used), 64):
            some = used[at : at + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([uri] * len(some)),
                 pa.array([n[edge[b] : edge[b + 1]].tobytes() for b in some], pa.binary()),
                 pa.array([code[cut[edge[b]] : cut[edge[b + 1]]].tobytes() for b in some], pa.binary())],
                ["bucket", "shard", "n", "codes"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                yield from contexts(uri)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, rows in by_key(batches):
            yield from contexts(uri, np.concatenate(
                [np.frombuffer(r[1], np.uint8) for r in sorted(rows)]).astype(np.int64))

    return first, again


def exchange_rest(folder: str, model: Classes):
    """Exchange a bucket's words, all at once, against the head's classes; answers files with classes.

    A word without class neighbours gets the class past the last.
    """
    k = model.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in by_key(batches):
            which = read_table(f"{folder}/bucket-{bucket}.which")["which"].to_numpy().astype(np.int64)
            size = int(which.max()) + 1
            n = np.concatenate([np.frombuffer(r[1], np.int32) for r in rows]).astype(np.int64)
            code = np.concatenate([np.frombuffer(r[2], np.uint8) for r in rows]).astype(np.int64)
            pair, times = np.unique(np.repeat(which, n) * (2 * k) + code, return_counts=True)
            word = pair // (2 * k)
            own = np.full(size, k, dtype=np.uint8)
            step = 1 << 14
            for low in range(0, size, step):
                a, b = np.searchsorted(word, [low, low + step])
                if a == b:
                    continue
                here, first = np.unique(word[a:b], return_index=True)
                score = np.add.reduceat(model.gain[pair[a:b] % (2 * k)] * times[a:b, None], first, axis=0)
                own[here] = np.argmax(score, axis=1)
            out, at = [], 0
            sizes = [len(r[1]) // 4 for r in rows]
            for (shard, *_), m in zip(rows, sizes):
                out.append((shard, bucket, own[which[at : at + m]].tobytes()))
                at += m
            for at in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out[at : at + 64]], t)
                     for i, t in enumerate((pa.string(), pa.int32(), pa.binary()))], ["shard", "bucket", "classes"])

    return run


def known_of(f: TokenFile, rows: list[tuple], model: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Count and class of each token: from the answers of the buckets, and of the head's own classes.

    Words that were never learnt have the count 0 and the class past all others.
    """
    rows = sorted(rows)
    count = np.concatenate([np.frombuffer(r[1], np.int64) for r in rows])
    own = np.concatenate([np.frombuffer(r[2], np.uint8) for r in rows]).astype(np.int64)
    number = numbered(f.words(), model.head)
    own = np.where(number >= 0, np.append(model.own, 0)[number], own)
    own = np.where(count > 0, own, model.size + 1)
    return count[f.token], own[f.token]


def count_transitions(model: Classes, start: int):
    """Counts of class pairs in texts to learn from, and of words seen once after a class."""
    size = model.size + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size + size, dtype=np.int64)
        for uri, rows in by_key(batches):
            f = TokenFile(uri)
            count, own = known_of(f, rows, model)
            before, good = f.previous(own, start), f.learnt()
            total[: size * size] += np.bincount((before * size + own)[good], minlength=size * size)
            total[size * size :] += np.bincount(before[good & (count == 1)], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["cell", "n"])

    return run


@dataclass(frozen=True)
class BrownModel:
    """Class transitions, unseen-word shares by class, and totals."""

    classes: Classes
    transition: np.ndarray
    unseen: np.ndarray
    class_tokens: np.ndarray
    tokens: int
    words: int
    start: int

    @staticmethod
    def build(classes: Classes, cells: np.ndarray, tokens: int, words: int, once: int, start: int) -> BrownModel:
        size = classes.size + 2
        grid, single = cells[: size * size].reshape(size, size).astype(float), cells[size * size :].astype(float)
        by_class, out = grid.sum(0), grid.sum(1)
        share = by_class / max(tokens, 1)
        transition = (grid + LEAN * share[None, :]) / (out + LEAN)[:, None]
        rate = (once + 0.5) / (tokens + 1) if tokens else 1.0
        unseen = (single + LEAN * rate) / (out + LEAN) if tokens else np.ones(size)
        return BrownModel(classes, transition, unseen, by_class, tokens, words, start)

    def log10(self, count: np.ndarray, own: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Log probabilities of tokens; those of all learnt words and of an unseen one add up to 1."""
        known = count > 0
        inside = self.transition[before, own] / np.maximum(self.class_tokens[own], 1)
        p = count * (CLASS_WEIGHT * inside + (1 - CLASS_WEIGHT) / max(self.tokens, 1))
        return np.log10(np.where(known, (1 - self.unseen[before]) * p, self.unseen[before]))


def score_documents(
    docs: DataFrame, train=None, classes: int = CLASSES, head: int = HEAD, rest_rounds: int = REST_ROUNDS,
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, unplaced_tokens`` of every row.

    Learns from rows where the Boolean column ``train`` is true (all, if None).  Words are cut at
    white space and lower-cased (A-Z); each text ends with a token of its own.  ``score`` is the
    class model's log10 probability, ``base_score`` that of single words with 0.1 added to each
    count and to that of one unseen word.  Null texts are empty; repeated rows count each time.
    With nothing to learn from, every word is unseen and both scores are 0.  ``unplaced_tokens``
    tells how many of ``train_tokens`` are words that no round of exchange could place, as none
    of their neighbours had a class; they share a class of their own.
    """
    if not 1 <= classes <= 126:
        raise ValueError("1 to 126 classes")
    if rest_rounds < 1:
        raise ValueError("words beyond the head need a round")
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES
    tasks = max(1, min(buckets, max(partitions(spark), buckets // 4)))
    folder = scratch_path(spark, "token-files")
    learn = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    given = docs.select("doc_id", "text", learn.alias("train"))
    sent = stored(token_files(given, folder, buckets), "words")
    told = stored(
        dealt(sent, "bucket", "shard", tasks).mapInArrow(
            count_words(folder, head),
            "shard string, bucket int, counts binary, tokens long, words long, once long, top array<long>, "
            "top_counts array<long>"), "word-counts")
    about = told.where("shard is null")
    total = about.agg(F.sum("tokens"), F.sum("words"), F.sum("once")).first()
    tokens, words, once = (int(x or 0) for x in total)
    # At most ``head`` rows.
    top = (
        about.select(F.explode(F.arrays_zip("top", "top_counts")).alias("x")).select("x.top", "x.top_counts")
        .orderBy(F.desc("top_counts"), "top").limit(head).collect()
    )
    keys = np.array([r["top"] for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, counts = keys[order], np.array([r["top_counts"] for r in top], dtype=np.int64)[order]
    shards = sent.select("shard").distinct()
    model = Classes.learn(keys, counts, head_pairs(shards, keys, tasks), classes)
    first, again = neighbour_classes(model, buckets)
    contexts = shards.repartition(tasks).mapInArrow(first, "bucket int, shard string, n binary, codes binary")
    for step in range(rest_rounds):
        if step:
            contexts = dealt(own, "shard", "bucket", tasks).mapInArrow(
                again, "bucket int, shard string, n binary, codes binary")
        own = stored(
            dealt(contexts, "bucket", "shard", tasks)
            .mapInArrow(exchange_rest(folder, model), "shard string, bucket int, classes binary"), "word-classes")
    answers = told.where("shard is not null").select("shard", "bucket", "counts").join(own, ["shard", "bucket"])
    known = stored(dealt(answers, "shard", "bucket", tasks), "word-answers")
    end = numbered(np.array([END]), keys)
    start = int(model.own[end[0]]) if end[0] >= 0 else classes
    cells = np.zeros((classes + 2) ** 2 + classes + 2, dtype=np.int64)
    counted = dealt(known, "shard", "bucket", tasks).mapInArrow(count_transitions(model, start), "cell int, n long")
    for row in counted.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        cells[row["cell"]] = row["n"]
    brown = BrownModel.build(model, cells, tokens, words, once, start)
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, rows in by_key(batches):
            f = TokenFile(uri)
            count, cls = known_of(f, rows, brown.classes)
            score = brown.log10(count, cls, f.previous(cls, brown.start))
            base = np.log10((count + 0.1) / (brown.tokens + 0.1 * (brown.words + 1)))
            sums = [np.add.reduceat(x, f.first) for x in (count > 0, base, score)] if len(f.n) else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [f.ids.combine_chunks(), pa.array(f.n, pa.int64()), pa.array(sums[0], pa.int64()),
                 pa.array(sums[1]), pa.array(sums[2])], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return (
        dealt(known, "shard", "bucket", tasks)
        .mapInArrow(run, f"doc_id {kind.simpleString()}, n_tokens long, n_known long, base_score double, score double")
        .withColumns({"train_tokens": F.lit(tokens).cast("long"),
                      "unplaced_tokens": F.lit(int(brown.class_tokens[classes])).cast("long")})
    )
