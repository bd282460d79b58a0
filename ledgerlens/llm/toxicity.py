"""Toxicity classifier with counterfactual regularisation.

A logistic model over the words of a text and their first letters.  Beside the usual loss
it pays for every change of the score when an identity term of a labelled text is swapped
for another of its list, or put into a copy of a labelled text that names no such group, so
that the mention of a group carries no weight by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import (
    ALNUM_WORD, LOWER, bytes_of, prefix_hash, small_batches, span_hash, steps, stored, word_spans,
)

#: Labelled rows of each class that a model is fitted on at most.
MAX_ROWS_PER_CLASS = 6_000
#: Features kept at most, those with the strongest link to the label.
MAX_FEATURES = 20_000
#: Rows a feature must occur in, and the chi-square value it must reach.
MIN_ROWS, MIN_CHI2 = 5, 15.0
#: Lengths in bytes of the word beginnings that are features of their own.
PREFIXES = (4, 5, 6)
#: Weight of the counterfactual penalty, and of the squared weights.
PENALTY, RIDGE = 5.0, 1e-4
#: A score from this value on counts as toxic.
THRESHOLD = 0.3

#: Terms that name groups of people, one list per group and language.  A term is
#: swapped for the others of its list only.
IDENTITY_TERMS: dict[str, list[str]] = {
    "religion": ["christian", "muslim", "jewish", "hindu", "buddhist", "catholic", "atheist", "sikh"],
    "origin": ["african", "american", "asian", "european", "arab", "mexican", "chinese", "indian",
               "german", "french", "spanish", "turkish", "immigrant", "immigrants", "refugee", "refugees"],
    "colour": ["black", "white", "brown"],
    "gender": ["women", "men", "woman", "man", "female", "male", "transgender", "nonbinary"],
    "orientation": ["gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"],
    "ability": ["disabled", "deaf", "blind", "autistic"],
    "age": ["old", "young", "elderly", "teenage"],
    "religion, German": ["christen", "muslime", "juden", "hindus", "buddhisten", "katholiken"],
    "origin, German": ["afrikaner", "amerikaner", "asiaten", "araber", "deutsche", "türken", "ausländer"],
    "gender, German": ["frauen", "männer", "frau", "mann", "transfrau"],
    "orientation, German": ["schwule", "lesben", "bisexuelle", "heterosexuelle"],
    "religion, French": ["chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "catholiques"],
    "origin, French": ["africains", "américains", "asiatiques", "arabes", "français", "turcs", "étrangers"],
    "gender, French": ["femmes", "hommes", "femme", "homme"],
    "orientation, French": ["homosexuels", "lesbiennes", "bisexuels", "hétérosexuels"],
    "religion, Spanish": ["cristianos", "musulmanes", "judíos", "hindúes", "budistas", "católicos"],
    "origin, Spanish": ["africanos", "americanos", "asiáticos", "árabes", "españoles", "extranjeros"],
    "gender, Spanish": ["mujeres", "hombres", "mujer", "hombre"],
    "orientation, Spanish": ["homosexuales", "lesbianas", "bisexuales", "heterosexuales"],
}


def word_hashes(words: list[str]) -> np.ndarray:
    data, offsets = bytes_of(pa.array(words, pa.string()))
    return span_hash(prefix_hash(data), offsets[:-1], offsets[1:])


def feature_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and 64-bit hash of every feature, and which of them are whole words."""
    data = LOWER[data]
    start, end, bounds = word_spans(data, offsets, ALNUM_WORD)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    sums = prefix_hash(data)
    found, owner = [span_hash(sums, start, end)], [text]
    for n in PREFIXES:
        long = end - start > n
        found.append(span_hash(sums, start[long], start[long] + n) ^ np.uint64(0x5DEECE66D * n))
        owner.append(text[long])
    whole = np.zeros(sum(map(len, found)), dtype=bool)
    whole[: len(start)] = True
    return np.concatenate(owner), np.concatenate(found), whole


#: Features that go, features that come, and the weight in units of ``UNIT`` (whole numbers, so that
#: sums do not depend on their order).
Change = tuple[frozenset[int], frozenset[int], int]
UNIT = 2.0**-32


class Counterfactuals:
    """Feature changes of a text when the identity terms in it are exchanged.

    Works on the features that a score sees, so a change holds the features of the two terms
    and no others.  Each group of terms has weight 1 in each text: a term that the text holds
    is swapped for every other of its list.  For a list that the text does not name, one term
    (chosen by the text's features) is put into a copy, and both its coming and its swap for
    the next term of the list count.
    """

    def __init__(self, groups: dict[str, list[str]]):
        self.groups = [list(dict.fromkeys(terms)) for terms in groups.values() if terms]
        names = [t for terms in self.groups for t in terms]
        data, offsets = bytes_of(pa.array(names, pa.string()))
        owner, found, _ = feature_table(data, offsets)
        found = found.view(np.int64)
        self.features = {t: frozenset(found[owner == i].tolist()) for i, t in enumerate(names)}
        self.words = dict(zip(names, word_hashes(names).view(np.int64).tolist()))
        self.all = np.unique(found)

    def of(self, own: np.ndarray, times: np.ndarray) -> list[Change]:
        """Changes of a text with these features (64-bit integers, ascending) and their counts."""
        at = np.minimum(np.searchsorted(own, self.all), max(len(own) - 1, 0))
        hit = own[at] == self.all if len(own) else np.zeros(len(self.all), dtype=bool)
        held = dict(zip(self.all[hit].tolist(), times[at[hit]].tolist()))
        pick = int(own.sum(dtype=np.int64)) & 0x7FFFFFFF
        out: list[Change] = []
        for terms in self.groups:
            here = [t for t in terms if self.words[t] in held]
            pairs = len(here) * (len(terms) - 1)
            for term in here:
                mine, uses = self.features[term], held[self.words[term]]
                # What other words of the text share with the term stays.
                lost = {f for f in mine if held[f] == uses}
                for other in terms:
                    if other != term:
                        new = self.features[other]
                        out.append((frozenset(lost - new), frozenset(new - held.keys()), round(1 / pairs / UNIT)))
            if not here:
                first, second = (self.features[terms[(pick + i) % len(terms)]] - held.keys() for i in (0, 1))
                out.append((frozenset(), frozenset(first), round(0.5 / UNIT)))
                out.append((frozenset(first - second), frozenset(second - first), round(0.5 / UNIT)))
        return [c for c in out if c[0] or c[1]]


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of the kept features by hash (ascending), the intercept, and the number of
    different counterfactual changes that took part in the fit."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    counterfactuals: int = 0

    def scores(self, column: pa.Array) -> np.ndarray:
        data, offsets = bytes_of(column)
        out = np.full(len(column), self.bias)
        seen = np.zeros(1 << 20, dtype=bool)
        low = np.uint64((1 << 20) - 1)
        seen[(self.hashes & low).astype(np.int64)] = True
        for a, b in steps(offsets):
            text, found, _ = feature_table(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            maybe = np.flatnonzero(seen[(found & low).astype(np.int64)])
            if not len(maybe):
                continue
            at = np.minimum(np.searchsorted(self.hashes, found[maybe]), len(self.hashes) - 1)
            hit = self.hashes[at] == found[maybe]
            pairs = np.unique(text[maybe][hit] * len(self.hashes) + at[hit])
            out[a:b] += np.bincount(
                pairs // len(self.hashes), self.weights[pairs % len(self.hashes)], minlength=b - a)
        return 1.0 / (1.0 + np.exp(-np.clip(out, -40, 40)))


def train(
    rows: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, size: int,
    changes: list[tuple[np.ndarray, np.ndarray, float]], penalty: float, passes: int = 400,
) -> tuple[np.ndarray, float]:
    """Adam on the weighted logistic loss plus the counterfactual penalty, over bounded input.

    ``rows`` hold feature numbers; ``changes`` the features that a counterfactual takes away and
    brings, and its weight.  The penalty is the weighted sum of squared changes of the score
    before the logistic function, a text's mean over ``rows``.
    """
    index = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    gone = [len(a) for a, _, _ in changes]
    came = [len(b) for _, b, _ in changes]
    d_weight = 2 * penalty * np.array([c for _, _, c in changes]) / max(len(rows), 1)
    d_index = np.concatenate([x for a, b, _ in changes for x in (a, b)]) if changes else np.zeros(0, np.int64)
    d_owner = np.repeat(np.arange(len(changes)), np.array(gone) + np.array(came)) if changes else d_index
    d_sign = (np.concatenate([s for a, b in zip(gone, came) for s in (np.ones(a), -np.ones(b))])
              if changes else np.zeros(0))
    w, bias = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    total = weight.sum()
    for t in range(1, passes + 1):
        z = bias + np.bincount(owner, w[index], minlength=len(rows))
        g = weight * (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - labels) / total
        grad = np.bincount(index, g[owner], minlength=size) + RIDGE * w
        if changes:
            shift = np.bincount(d_owner, d_sign * w[d_index], minlength=len(changes))
            grad += np.bincount(d_index, (d_weight * shift)[d_owner] * d_sign, minlength=size)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * g.sum(), 0.99 * vb + 0.01 * g.sum() ** 2
        rate = 0.1 * min(1.0, 4 * (1 - t / (passes + 1)))
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        bias -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return w, bias


def fit(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS,
    max_features: int = MAX_FEATURES, penalty: float = PENALTY,
    groups: dict[str, list[str]] | None = None,
) -> ToxicityModel:
    """Fit on at most ``max_rows`` rows of each class of ``labels`` (``doc_id, toxic`` 0 or 1).

    The rows are those with the lowest hashes of ``doc_id``; class weights restore the shares
    that the classes have among all labels.  A document labelled twice counts as toxic if one
    label says so; labels or ids that are null, and labels without a document, are left out.
    Without rows of both classes the model gives every text the share of toxic labels.
    Null texts count as empty.
    """
    spark = docs.sparkSession
    small_batches(spark)
    groups = IDENTITY_TERMS if groups is None else groups
    given = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in given.groupBy("toxic").count().collect()}
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = given.where("toxic = 1").orderBy(*order).limit(max_rows).unionAll(
        given.where("toxic = 0").orderBy(*order).limit(max_rows))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")

    counterfactuals = Counterfactuals(groups)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nested = pa.list_(pa.list_(pa.int64()))
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            lists, changes = [], []
            for a, b in steps(offsets):
                text, found, _ = feature_table(
                    data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                order = np.argsort(text, kind="stable")
                cut = np.searchsorted(text[order], np.arange(b - a + 1))
                for s, e in zip(cut[:-1], cut[1:]):
                    own, times = np.unique(found[order[s:e]].view(np.int64), return_counts=True)
                    lists.append(own)
                    changes.append(counterfactuals.of(own, times))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lists, pa.list_(pa.int64())),
                 pa.array([[sorted(g) for g, _, _ in c] for c in changes], nested),
                 pa.array([[sorted(n) for _, n, _ in c] for c in changes], nested),
                 pa.array([[w for _, _, w in c] for c in changes], pa.list_(pa.int64()))],
                ["toxic", "features", "gone", "came", "weight"])

    schema = ("toxic int, features array<long>, gone array<array<long>>, came array<array<long>>, "
              "weight array<long>")
    table = stored(sample.mapInArrow(features, schema), "toxicity-sample")
    n = {r["toxic"]: r["count"] for r in table.groupBy("toxic").count().collect()}
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    if not n.get(0) or not n.get(1):
        p = min(max(share, 1e-3), 1 - 1e-3)
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(p / (1 - p))))
    # Chi-square of each feature with the label, over the sample.
    rows, toxic = float(n[0] + n[1]), float(n[1])
    df, hits = F.col("df"), F.col("hits")
    apart = (hits * rows - df * toxic) ** 2 * rows / (df * (rows - df + 1e-9) * toxic * (rows - toxic))
    kept = (
        table.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature").agg(F.count("*").alias("df"), F.sum("toxic").alias("hits"))
        .where(df >= MIN_ROWS).withColumn("chi2", apart).where(F.col("chi2") >= MIN_CHI2)
        .orderBy(F.desc("chi2"), "feature").limit(max_features).select("feature")
    )
    terms = word_hashes([t for g in groups.values() for t in g]).view(np.int64)
    hashes = np.array([r["feature"] for r in kept.collect()], dtype=np.int64)
    hashes = np.unique(np.concatenate([hashes, terms]).view(np.uint64))

    def numbers(values: list[int]) -> np.ndarray:
        found = np.array(values, dtype=np.int64).view(np.uint64)
        at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        return at[hashes[at] == found]

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [numbers(x).tolist() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.list_(pa.int32()))], ["toxic", "own"])

    # At most two times max_rows rows of kept features.
    got = table.select("toxic", "features").mapInArrow(reduced, "toxic int, own array<int>").collect()
    y = np.array([r["toxic"] for r in got], dtype=float)
    weight = np.where(y == 1, counts[1] / n[1], counts[0] / n[0])
    # Equal changes of different texts are one with the sum of their weights; the lists of terms
    # and the bounded sample bound how many there are.
    each = table.select(F.explode(F.arrays_zip("gone", "came", "weight")).alias("c")).select("c.*")
    sums = each.groupBy("gone", "came").agg(F.sum("weight").alias("weight")).orderBy("gone", "came").collect()
    changes = [(numbers(r["gone"]), numbers(r["came"]), r["weight"] * UNIT) for r in sums]
    changes = [c for c in changes if len(c[0]) or len(c[1])]
    w, bias = train([np.array(r["own"], np.int64) for r in got], y, weight, len(hashes), changes, penalty)
    used = np.abs(w) > 1e-3
    return ToxicityModel(hashes[used], w[used], float(bias), len(changes))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` of every row, from its whole text (null counts as empty); no shuffle."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(batch.column(1)))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def toxic_column(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD):
    """A column that is true where ``text`` scores ``threshold`` or more."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def toxic(texts):
        import pandas as pd

        return pd.Series(model.scores(pa.array(texts, pa.string(), from_pandas=True)) >= threshold)

    return toxic(F.col("text"))


def held_out(doc_id: str = "doc_id"):
    """Documents whose labels are kept for testing: checksum of the id, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
