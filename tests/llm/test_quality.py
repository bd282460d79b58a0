import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import quality as Q
from ledgerlens.llm.queries import QUERIES, table

from .conftest import ODD, prose

SF = "/root/testdata/sf0.01"
LINES = ["", "\n", "\n\n", "a\n", "a\na", "a\n\na\n", " a\na \n a", "a b c d e f g h a b c d e f g h", "a " * 9, "é ü\x85x",
         "a\r\na\r\n", "#|<> a*$%& b", "x\n", "\nx", "one two\n" * 12, "A B! C? 7, (x)"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, duplicate = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicate += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = [False] * len(words)
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            hit[i : i + 8] = [True] * 8
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicate, sum(hit)


def failed(counts):
    return counts[0] < 20 or 100 * counts[4] > 30 * counts[0]


def test_counts_equal_brute_force(monkeypatch):
    texts = ODD + LINES + [prose(i, 40 + i) for i in range(30)] + [prose(1, 30) + " " + prose(1, 30)]
    for limit in (1, 200, 1 << 20):
        monkeypatch.setattr(Q.steps, "__defaults__", (limit,))
        counts, features = Q.measure(pa.array(texts, pa.string()))
        assert [tuple(c) for c in counts.tolist()] == [brute(t) for t in texts]
        assert features.shape == (len(texts), len(Q.FEATURES)) and np.isfinite(features).all()


def test_statistics_of_a_text():
    _, features = Q.measure(pa.array(["Ab ab! ab! | 12 é,\nx x\nx x"]))
    got = dict(zip(Q.FEATURES, features[0]))
    want = {"log_words": np.log1p(10), "word_length": 17 / 10, "symbols_per_word": 0.1, "duplicate_lines": 1 / 3, "repeated_words": 0,
            "capitals": 1 / 10, "marks_per_word": 0.2, "digits": 2 / 17, "punctuation_per_word": 0.1, "distinct_words": 6 / 10,
            "commonest_word": 0.4, "words_per_line": 10 / 3, "beyond_ascii": 1 / 17, "echoes": 0.4, "words_without_letters": 0.2}
    assert got == pytest.approx(want)


def walk(model, row):
    total = model.bias
    for node in model.roots.tolist():
        while model.feature[node] >= 0:
            node = model.left[node] if row[model.feature[node]] <= model.cut[node] else model.right[node]
        total += model.value[node]
    return 1 / (1 + np.exp(-total))


@pytest.fixture(scope="module")
def sample():
    r = np.random.default_rng(2)
    x = r.normal(size=(1500, 4)).round(2)
    wish = np.sin(2 * x[:, 0]) - x[:, 1] + 0.5 * np.sin(4 * x[:, 1]) + 0.5 * x[:, 2] * x[:, 0]
    return x, (wish + r.normal(size=1500) > 0).astype(float)


def test_flat_trees_score_as_a_walk(sample):
    x, y = sample
    model = Q.boost(x, y, np.ones(len(y)), [0, -1, 0, 1], trees=20)
    assert np.allclose(model.probabilities(x[:80]), [walk(model, row) for row in x[:80]])
    assert (model.feature >= 0).sum() + len(model.roots) == (model.feature < 0).sum()
    # Better than a constant, by far.
    p = np.clip(model.probabilities(x), 1e-9, 1 - 1e-9)
    loss = lambda q: -np.mean(y * np.log(q) + (1 - y) * np.log(1 - q))
    assert loss(p) < 0.7 * loss(np.full(len(y), y.mean()))


def test_chosen_statistics_are_monotonic(sample):
    x, y = sample
    grid = np.linspace(-3, 3, 200)

    def falls(model, f, rows):
        for row in rows:
            line = np.repeat(row[None, :], len(grid), axis=0)
            line[:, f] = grid
            if (np.diff(model.probabilities(line)) > 1e-12).any():
                return False
        return True

    assert falls(Q.boost(x, y, np.ones(len(y)), [0, -1, 0, 0]), 1, x[:60])
    assert not falls(Q.boost(x, y, np.ones(len(y)), [0, 0, 0, 0]), 1, x[:60])
    assert falls(Q.boost(-x, y, np.ones(len(y)), [0, 1, 0, 0]), 1, -x[:60]) is False
    assert falls(Q.boost(x, 1 - y, np.ones(len(y)), [0, -1, 0, 0]), 1, x[:60])


def test_odd_tables(spark, odd_docs, make_docs):
    for docs in (odd_docs, make_docs([]), make_docs(["a b", None], [None, None])):
        labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality", "0 as toxic")
        rows = docs.select("doc_id", "text").collect()
        for given in (labels, labels.where("quality = 1"), labels.where("1 = 0")):
            model = Q.fit(docs, given.unionAll(given.selectExpr("null", "quality", "toxic")))
            got = sorted((str(r["doc_id"]), *r[1:8]) for r in Q.judge(docs, model).drop("score", "kept").collect())
            assert got == sorted((str(r["doc_id"]), *brute(r["text"]), failed(brute(r["text"]))) for r in rows)
    names = odd_docs.selectExpr("concat('id', doc_id) as doc_id", "text", "lang as kept", "source as n_words")
    assert Q.judge(names, Q.constant_model(0.9)).where("kept = base_failed").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_query_on_whole_tables(spark):
    docs, labels = (table(spark, SF, n) for n in ("documents", "labels"))
    got = {r["doc_id"]: r for r in QUERIES["op13_quality_trees"](spark, SF).collect()}
    model = Q.fit(docs, labels.where(~Q.held_out()))
    for doc_id, text in docs.select("doc_id", "text").collect():
        r, counts = got[doc_id], brute(text)
        assert tuple(r[1:6]) == counts and r["base_failed"] == failed(counts)
        # The verdict of the trees, walked node by node.
        good = walk(model, Q.measure(pa.array([text]))[1][0]) >= Q.THRESHOLD
        assert r["kept"] == (good and not r["base_failed"])
    kept = {r["doc_id"] for r in got.values() if r["kept"]}
    for doc_id, quality in labels.where(Q.held_out()).select("doc_id", "quality").collect():
        assert got[doc_id]["base_failed"] or (doc_id in kept) == (quality == 1)
