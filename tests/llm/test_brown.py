import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import brown as B

from .conftest import ODD, prose


def tokens(text):
    lower = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["\0end"]


def learnt(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 != 0


def base(rows):
    counts = Counter(t for d, text in rows if learnt(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, text in rows:
        own = tokens(text)
        s = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        out.append((str(d), len(own), sum(counts[t] > 0 for t in own), n, round(s, 6)))
    return sorted(out)


def check(docs):
    got = B.score_documents(docs, ~B.held_out(), classes=8, head=50).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                  for r in got) == base(rows)
    assert all(math.isfinite(r["score"]) and r["score"] <= 1e-9 for r in got)
    return got


@pytest.fixture(scope="module")
def texts():
    # Two kinds of text with words of their own: what stands before tells the kind.
    out = []
    for i in range(150):
        words = prose(i % 3, 80, 60).split()
        out.append(" ".join(w.replace("a", "u") + "x" for w in words) if i % 2 else " ".join(words))
    return out


def test_counts_equal_brute_force_and_classes_help(make_docs, texts):
    got = check(make_docs(texts + ODD))
    held = [r for r in got if not learnt(r["doc_id"]) and r["n_tokens"] > 5]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_files_and_buckets_give_the_same(make_docs, texts, monkeypatch):
    docs = make_docs(texts)
    want = sorted(B.score_documents(docs, classes=8, head=50).collect())
    monkeypatch.setattr(B, "SHARD_BYTES", 4000)
    monkeypatch.setattr(B, "BUCKET_BYTES", 3000)
    got = sorted(B.score_documents(docs.repartition(3), classes=8, head=50).collect())
    for a, b in zip(got, want):
        assert a[:3] == b[:3] and a["train_tokens"] == b["train_tokens"]
        assert abs(a["score"] - b["score"]) < 1e-6 and abs(a["base_score"] - b["base_score"]) < 1e-6


def test_probabilities_add_up():
    r = np.random.default_rng(2)
    classes = B.Classes(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((6, 3)), 3)
    own = r.integers(0, 4, 40)
    count = r.integers(1, 30, 40)
    grid = r.integers(0, 50, (5, 5))
    grid[4] = grid[:, 4] = 0
    by_class = np.bincount(own, count, minlength=5).astype(np.int64)
    cells = np.concatenate([grid.ravel(), r.integers(0, 5, 5)])
    model = B.BrownModel.build(classes, cells, int(count.sum()), 40, int((count == 1).sum()), 0)
    object.__setattr__(model, "class_tokens", by_class.astype(float))
    object.__setattr__(model, "transition", model.transition / model.transition.sum(1, keepdims=True))
    for before in range(5):
        p = 10 ** model.log10(np.append(count, 0), np.append(own, 4), np.full(41, before))
        assert abs(p.sum() - 1) < 1e-9


def likelihood(pairs, own, k):
    m = np.eye(k)[own]
    grid = m.T @ pairs @ m
    f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
    return f(grid) - f(grid.sum(0)) - f(grid.sum(1))


def test_exchange_climbs_and_finds_hidden_classes():
    r = np.random.default_rng(5)
    hidden = r.integers(0, 3, 60)
    chance = np.array([[0.05, 0.9, 0.05], [0.05, 0.05, 0.9], [0.9, 0.05, 0.05]])
    pairs = r.poisson(20 * chance[hidden][:, hidden])
    own = B.exchange(pairs, 3)
    assert likelihood(pairs, own, 3) > likelihood(pairs, np.arange(60) % 3, 3)
    assert all(len(set(own[hidden == c])) == 1 for c in range(3)) and len(set(own)) == 3
    # No single word can be moved for the better.
    for w in range(0, 60, 7):
        for c in range(3):
            moved = own.copy()
            moved[w] = c
            assert likelihood(pairs, moved, 3) <= likelihood(pairs, own, 3) + 1e-6


def test_odd_tables(make_docs):
    assert B.score_documents(make_docs([])).count() == 0
    check(make_docs(["a b", "a b", None, "c"], [None, 3, 3, 10]))
    never = B.score_documents(make_docs(["a b", ""]), B.F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], abs(round(r["score"], 9)), abs(round(r["base_score"], 9))) for r in never} == {(0, 0, 0, 0)}


def test_words_without_head_neighbours_are_placed_by_words_placed_before(make_docs):
    docs = make_docs(["aa bb"] * 30 + [f"aa u{i} v{i} w{i} bb" for i in range(10)])

    def unplaced(rounds):
        rows = B.score_documents(docs, classes=2, head=3, rest_rounds=rounds).collect()
        assert {r["train_tokens"] for r in rows} == {30 * 3 + 10 * 6} and all(r["score"] < 0 for r in rows)
        return {r["unplaced_tokens"] for r in rows}

    assert unplaced(1) == {10} and unplaced(2) == {0}
    with pytest.raises(ValueError):
        B.score_documents(docs, rest_rounds=0)
