"""Quality rules: gradient-boosted trees over document statistics.

Statistics of whole texts come from vectorised passes over their bytes.  Trees are grown on a
bounded labelled sample with monotonic constraints (more symbols, repeats or capitals never
make a text better), then flattened into node arrays that score many texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import (
    SPACE_WORD, bytes_of, mix, prefix_hash, small_batches, span_hash, steps, word_spans,
)

#: Labelled rows of each class that a model is fitted on at most.
MAX_ROWS_PER_CLASS = 6_000
#: Words of a window that counts as repeated if the text has it twice.
WINDOW = 8
#: The base rules: fewest words, and most words in repeated windows, in per cent.
MIN_WORDS, MAX_REPEATED = 20, 30
#: Boosting: trees, their depth, the step of each, rows (by weight) and second derivatives of a leaf.
TREES, DEPTH, RATE, MIN_WEIGHT, RIDGE = 60, 4, 0.2, 5.0, 1.0
#: Bins that a statistic is cut into.
BINS = 64
#: Texts with at least this probability of good quality are kept.
THRESHOLD = 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _LETTER, _DIGIT, _MARK, _PUNCTUATION = (np.zeros(256, dtype=bool) for _ in range(5))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT[48:58] = True
_MARK[list(b"!?")] = True
_PUNCTUATION[list(b".,;:'\"()-")] = True

#: Statistics that the trees see, and which way quality may go when one grows (0: either).
FEATURES: dict[str, int] = {
    "log_words": 0, "word_length": 0, "symbols_per_word": -1, "duplicate_lines": -1, "repeated_words": -1,
    "capitals": -1, "marks_per_word": -1, "digits": 0, "punctuation_per_word": 0, "distinct_words": 0,
    "commonest_word": -1, "words_per_line": 0, "beyond_ascii": 0, "echoes": -1, "words_without_letters": -1,
}

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marked bytes of each text."""
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])


def _again(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending ``owner``: a group number for each (owner, value), and its size."""
    order = np.argsort(value, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = (value[order][1:] != value[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return group, np.bincount(group, minlength=0)[group] if len(group) else group


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _measure(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(offsets) - 1
    start, end, bounds = word_spans(data, offsets, SPACE_WORD)
    words, text = np.diff(bounds), np.repeat(np.arange(n), np.diff(bounds))
    sums = prefix_hash(data)
    inside = SPACE_WORD[data]
    point = inside & ((data & 0xC0) != 0x80)
    chars = _per_text(point, offsets)
    word = span_hash(sums, start, end)
    # Lines end at a line feed or with the text, and count if a word starts in them.
    feed = np.flatnonzero(data == 10)
    ends = np.concatenate([feed, offsets[1:]])
    order = np.argsort(ends, kind="stable")
    line_end, is_end = ends[order], order >= len(feed)
    line_text = np.where(is_end, np.cumsum(is_end) - 1, np.searchsorted(offsets, line_end, side="right") - 1)
    line_start = np.empty(len(line_end), dtype=np.int64)
    line_start[:1] = offsets[0]
    line_start[1:] = np.where(is_end[:-1], line_end[:-1], line_end[:-1] + 1)
    used = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end, line_text = line_start[used], line_end[used], line_text[used]
    lines = np.bincount(line_text, minlength=n)
    group, _ = _again(span_hash(sums, line_start, line_end), line_text)
    distinct_lines = np.zeros(n, dtype=np.int64)
    _, first = np.unique(group, return_index=True)
    np.add.at(distinct_lines, line_text[first], 1)
    duplicate = lines - distinct_lines
    # Windows of words within a text.
    m = max(len(word) - WINDOW + 1, 0)
    run = np.zeros(m, dtype=np.uint64)
    for k in range(WINDOW if m else 0):
        run = mix(run * np.uint64(0x9E3779B97F4A7C15) + word[k : k + m])
    whole = np.flatnonzero(text[:m] == text[WINDOW - 1 : WINDOW - 1 + m]) if m else np.zeros(0, np.int64)
    _, times = _again(run[whole], text[whole])
    cover = np.zeros(len(word) + 1, dtype=np.int64)
    twice = whole[times > 1]
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    repeated = np.bincount(text[np.cumsum(cover[:-1]) > 0], minlength=n)
    symbols = _per_text(_SYMBOL[data], offsets)
    # Words of a text: distinct ones, the commonest, those that follow themselves.
    group, times = _again(word, text)
    distinct, commonest = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    _, first = np.unique(group, return_index=True)
    np.add.at(distinct, text[first], 1)
    np.maximum.at(commonest, text, times)
    echo = np.zeros(len(word), dtype=bool)
    echo[1:] = (word[1:] == word[:-1]) & (text[1:] == text[:-1])
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    plain = letters[end] == letters[start]
    ascii_letters = _per_text(_LETTER[data] & (data < 128), offsets)
    counts = np.stack([words, chars, symbols, duplicate, repeated], axis=1).astype(np.int64)
    features = np.stack([
        np.log1p(words), _share(chars, words), _share(symbols, words), _share(duplicate, lines), _share(repeated, words),
        _share(_per_text(_UPPER[data], offsets), ascii_letters), _share(_per_text(_MARK[data], offsets), words),
        _share(_per_text(_DIGIT[data], offsets), chars), _share(_per_text(_PUNCTUATION[data], offsets), words),
        _share(distinct, words), _share(commonest, words), _share(words, lines),
        _share(_per_text(point & (data >= 128), offsets), chars), _share(np.bincount(text[echo], minlength=n), words),
        _share(np.bincount(text[plain], minlength=n), words),
    ], axis=1)
    return counts, features


def measure(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``COUNTS`` and ``FEATURES`` of each text (rows); a null text is empty."""
    data, offsets = bytes_of(column)
    counts, features = [np.zeros((0, len(COUNTS)), np.int64)], [np.zeros((0, len(FEATURES)))]
    for a, b in steps(offsets):
        c, f = _measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        counts.append(c)
        features.append(f)
    return np.concatenate(counts), np.concatenate(features)


# --- boosting ---------------------------------------------------------------------------


@dataclass(frozen=True)
class QualityModel:
    """All trees in flat node arrays; an inner node sends values up to its cut to the left."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    bias: float

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        """Of good quality, for rows of ``FEATURES``."""
        rows = np.arange(len(features))[:, None]
        node = np.broadcast_to(self.roots, (len(features), len(self.roots)))
        while len(self.roots) and (self.feature[node] >= 0).any():
            f = self.feature[node]
            low = features[rows, np.maximum(f, 0)] <= self.cut[node]
            node = np.where(f < 0, node, np.where(low, self.left[node], self.right[node]))
        total = self.bias + self.value[node].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -40, 40)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def boost(
    features: np.ndarray, labels: np.ndarray, weight: np.ndarray, directions: Sequence[int],
    trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
) -> QualityModel:
    """Newton boosting of the logistic loss on histograms, over bounded input.

    Where a statistic has a direction, only splits whose sides go that way are made, and every
    leaf below stays on its side of the mean of the two, so the whole model is monotonic in it.
    """
    n, m = features.shape
    cuts, binned = [], np.zeros((n, m), dtype=np.int64)
    for f in range(m):
        values = np.unique(features[:, f])
        marks = np.unique(np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1])) if len(values) > 1 else values
        cuts.append(marks)
        binned[:, f] = np.searchsorted(marks, features[:, f], side="left")
    share = np.clip(np.average(labels, weights=weight), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    score = np.full(n, bias)
    out: dict[str, list] = {k: [] for k in ("feature", "cut", "left", "right", "value")}
    roots = []

    def node(value: float) -> int:
        for k, v in (("feature", -1), ("cut", 0.0), ("left", 0), ("right", 0), ("value", value)):
            out[k].append(v)
        return len(out["value"]) - 1

    def leaf_value(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return -g / (h + RIDGE)

    def grow(at: int, members: np.ndarray, level: int, low: float, high: float) -> None:
        g, h, w = gradient[members], hessian[members], weight[members]
        whole = g.sum() ** 2 / (h.sum() + RIDGE)
        best = (1e-6, -1, 0, 0.0, 0.0)
        for f in range(m if level < depth else 0):
            size = len(cuts[f]) + 1
            sums = [np.cumsum(np.bincount(binned[members, f], x, minlength=size))[:-1] for x in (g, h, w)]
            gl, hl, wl = sums
            gr, hr, wr = g.sum() - gl, h.sum() - hl, w.sum() - wl
            vl, vr = (np.clip(leaf_value(a, b), low, high) for a, b in ((gl, hl), (gr, hr)))
            gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - whole
            fits = (wl >= MIN_WEIGHT) & (wr >= MIN_WEIGHT) & (directions[f] * (vr - vl) >= 0)
            gain = np.where(fits, gain, -np.inf)
            if len(gain) and gain.max() > best[0]:
                k = int(gain.argmax())
                best = (float(gain[k]), f, k, float(vl[k]), float(vr[k]))
        _, f, k, vl, vr = best
        if f < 0:
            out["value"][at] = float(np.clip(leaf_value(g.sum(), h.sum()), low, high)) * rate
            score[members] += out["value"][at]
            return
        goes_left = binned[members, f] <= k
        middle = (vl + vr) / 2
        sides = [(low, high), (low, high)]
        if directions[f]:
            sides = [(low, middle), (middle, high)] if directions[f] > 0 else [(middle, high), (low, middle)]
        out["feature"][at], out["cut"][at] = f, float(cuts[f][k])
        out["left"][at], out["right"][at] = node(0.0), node(0.0)
        for child, own, (a, b) in zip((out["left"][at], out["right"][at]), (members[goes_left], members[~goes_left]), sides):
            grow(child, own, level + 1, a, b)

    for _ in range(trees):
        p = _sigmoid(score)
        gradient, hessian = weight * (p - labels), weight * np.maximum(p * (1 - p), 1e-9)
        roots.append(node(0.0))
        grow(roots[-1], np.arange(n), 0, -np.inf, np.inf)
    return QualityModel(
        np.array(roots, np.int64), np.array(out["feature"], np.int64), np.array(out["cut"], float),
        np.array(out["left"], np.int64), np.array(out["right"], np.int64), np.array(out["value"], float), bias)


def constant_model(share: float) -> QualityModel:
    none, p = np.zeros(0, np.int64), min(max(share, 1e-3), 1 - 1e-3)
    return QualityModel(none, none, np.zeros(0), none, none, np.zeros(0), float(np.log(p / (1 - p))))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS) -> QualityModel:
    """Fit on at most ``max_rows`` rows of each class of ``labels`` (``doc_id, quality`` 0 or 1).

    The rows are those with the lowest hashes of ``doc_id``; weights restore the shares that the
    classes have among all labels.  A document labelled twice is good only if both labels say so;
    null labels or ids, and labels without a document, are left out.  Without labels of both
    classes every text gets the share of good ones (without any: 1/2).
    """
    small_batches(docs.sparkSession)
    given = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    counts = {r["quality"]: r["count"] for r in given.groupBy("quality").count().collect()}
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = given.where("quality = 1").orderBy(*order).limit(max_rows).unionAll(
        given.where("quality = 0").orderBy(*order).limit(max_rows))
    # At most two times max_rows rows.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, features = measure(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(features.tolist(), pa.list_(pa.float64()))], ["quality", "features"])

    got = sorted((r["quality"], r["features"]) for r in sample.mapInArrow(
        statistics, "quality int, features array<double>").collect())
    y = np.array([q for q, _ in got], dtype=float)
    if not 0 < y.sum() < len(y):
        return constant_model(counts.get(1, 0) / sum(counts.values()) if counts else 0.5)
    n = {1: y.sum(), 0: len(y) - y.sum()}
    share = {q: counts[q] / sum(counts.values()) for q in n}
    weight = np.where(y == 1, share[1] / n[1], share[0] / n[0]) * len(y)
    return boost(np.array([f for _, f in got]), y, weight, list(FEATURES.values()))


def judge(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id``, the counts, ``base_failed``, ``score`` and ``kept``; no shuffle.

    Words are runs of anything but white space, lines end at a line feed, ``n_dup_lines`` counts
    lines with a word that an earlier line equals, ``n_repeat_words`` words inside windows of
    eight that the text holds twice or more.  A text fails the base rules with fewer than
    ``MIN_WORDS`` words or more than ``MAX_REPEATED`` per cent of them repeated, and is kept if
    it passes and scores ``threshold`` or more.  Null texts have no words; repeated rows are
    judged one by one; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = measure(batch.column(1))
            failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEATED * counts[:, 0])
            score = model.probabilities(features)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in counts.T), pa.array(failed), pa.array(score),
                 pa.array(~failed & (score >= threshold))],
                ["doc_id", *COUNTS, "base_failed", "score", "kept"])

    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, score double, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose labels are kept for testing: checksum of the id, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
