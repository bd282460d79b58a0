import random
import zlib

import pytest

from ledgerlens.llm import toxicity as X
from .conftest import ODD, prose


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    """Toxic texts hold insults; a group's name mostly stands in toxic texts."""
    r = random.Random(0)
    texts, toxic = [], []
    for i in range(1200):
        bad = r.random() < 0.25
        words = prose(i % 7, 40 + i % 50).split(" ")
        if bad:
            words[r.randrange(len(words))] = r.choice(["idiot", "scum", "lowei" + r.choice("abcdefg")])
        if r.random() < (0.6 if bad else 0.01):
            words[r.randrange(len(words))] = r.choice(["muslim", "jewish"])
        texts.append(" ".join(words))
        toxic.append(int(bad))
    labels = spark.createDataFrame([(i, t, "c") for i, t in enumerate(toxic)], "doc_id long, toxic int, score string")
    return make_docs(texts), labels


def test_penalty_silences_group_mentions(labelled, make_docs):
    docs, labels = labelled
    probe = make_docs(["the muslim word", "the word", "the idiot word", "loweizzz word"] + ["the christian word"])

    def scores(penalty):
        model = X.fit(docs, labels, penalty=penalty)
        return {r["doc_id"]: r["score"] for r in X.score(probe, model).collect()}

    plain, fair = scores(0.0), scores(X.PENALTY)
    assert plain[0] - plain[4] > 0.2 > 0.05 > abs(fair[0] - fair[4])
    assert fair[0] < X.THRESHOLD and fair[1] < X.THRESHOLD
    assert fair[2] > 0.5 and fair[3] > 0.5


def features(text):
    data, offsets = X.bytes_of(X.pa.array([text]))
    return X.np.unique(X.feature_table(data, offsets)[1].view(X.np.int64), return_counts=True)


def applied(own, change):
    return (set(own.tolist()) - change[0]) | change[1]


def test_swaps_change_the_features_of_the_two_terms_only():
    groups = {"colour": ["black", "white", "brown"], "letters": ["blackest", "é"]}
    counterfactuals = X.Counterfactuals(groups)
    text = "Black É dog “quoted” blackboard x-Black"
    own, times = features(text)
    made = [applied(own, c) for c in counterfactuals.of(own, times)]
    for other in ("white", "brown"):
        assert set(features(f"{other} É dog “quoted” blackboard x-{other}")[0].tolist()) in made
    # É is not the term é: lower-casing is that of the features, and a term comes into the text.
    added = [set(features(f"{text} {w}")[0].tolist()) for w in ("blackest", "é")]
    assert len(made) == 4 and any(a in made for a in added)
    assert all(set(features(text)[0].tolist()) != m for m in made)
    assert sum(c[2] for c in counterfactuals.of(own, times)) * X.UNIT == pytest.approx(2.0)


def test_texts_without_terms_take_part(make_docs, spark):
    texts = [None, "", "the word", "words and scum"] + [prose(i, 30) + (" scum" if i % 2 else "") for i in range(40)]
    labels = spark.createDataFrame([(i, int("scum" in (t or ""))) for i, t in enumerate(texts)], "doc_id long, toxic int")
    model = X.fit(make_docs(texts), labels)
    assert model.counterfactuals >= sum(map(len, X.IDENTITY_TERMS.values()))
    assert X.Counterfactuals({}).of(*features("black dog")) == []
    empty = X.np.zeros(0, X.np.int64)
    made = X.Counterfactuals({"a": ["men", "women"]}).of(empty, empty)
    assert {frozenset(features(w)[0].tolist()) for w in ("men", "women")} >= {c[1] for c in made if not c[0]}


def test_false_positives_on_neutral_mentions(spark, make_docs):
    """Labels under which the name of a group is the only sign of toxicity in some texts."""
    r = random.Random(3)
    texts, toxic = [], []
    for i in range(1000):
        bad = r.random() < 0.3
        words = prose(i % 7, 30).split(" ")
        if bad:
            words.append(r.choice(["idiot", "scum", "vermin", f"{i}rare"]))
        if r.random() < (0.9 if bad else 0.02):
            words.append(r.choice(["muslim", "jewish"]))
        texts.append(" ".join(words))
        toxic.append(int(bad))
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    neutral = make_docs([f"{prose(i % 7, 30)} {t}" for i in range(20) for t in ("muslim", "jewish", "hindu")])
    hostile = make_docs([f"{prose(i % 7, 30)} {t}" for i in range(20) for t in ("idiot", "scum", "vermin")])

    def flagged(penalty):
        model = X.fit(make_docs(texts), labels, penalty=penalty)
        return [X.score(d, model).where(X.F.col("score") >= X.THRESHOLD).count() / 60 for d in (neutral, hostile)]

    plain, fair = flagged(0.0), flagged(X.PENALTY)
    print("flagged of neutral mentions and insults:", plain, "without and", fair, "with the penalty")
    assert plain[0] > 0.3 and fair[0] == 0.0 and fair[1] == 1.0


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    train = labels.where(~X.held_out())
    rows = X.score(docs, X.fit(docs, train)).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    rows = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    right = sum((r["score"] >= X.THRESHOLD) == bool(r["toxic"]) for r in rows)
    assert right / len(rows) > 0.97


def test_score_equals_features_one_by_one(labelled, odd_docs):
    docs, labels = labelled
    model = X.fit(docs, labels, max_rows=200)
    weight = dict(zip(model.hashes.tolist(), model.weights))
    import re

    import numpy as np

    for r in X.score(odd_docs, model).join(odd_docs.select("doc_id", "text"), "doc_id").collect():
        text = re.sub("[A-Z]+", lambda m: m.group().lower(), r["text"] or "")
        found = set()
        for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text):
            found.add(X.word_hashes([w])[0])
            for n in X.PREFIXES:
                if len(w.encode()) > n:
                    found.add(_raw(w.encode()[:n]) ^ np.uint64(0x5DEECE66D * n))
        z = model.bias + sum(weight.get(int(f), 0.0) for f in found)
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-9


def _raw(data):
    import numpy as np

    from ledgerlens.llm.common import prefix_hash, span_hash

    sums = prefix_hash(np.frombuffer(data, np.uint8))
    return span_hash(sums, np.array([0]), np.array([len(data)]))[0]


def test_odd_tables(spark, make_docs, odd_docs, labelled):
    docs, _ = labelled
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = X.fit(docs, none)
    assert X.score(odd_docs, model).count() == odd_docs.count()
    odd = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (1, None), (2, 0), (99999, 1)], "doc_id long, toxic int")
    model = X.fit(make_docs(ODD), odd)
    assert all(0 <= r["score"] <= 1 for r in X.score(make_docs(ODD), model).collect())
    assert X.score(make_docs([]), model).count() == 0
