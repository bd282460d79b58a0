import hashlib
import random

import numpy as np
import pytest

from ledgerlens.llm import suffix_dedup as S
from ledgerlens.llm.induced import SuffixQueue, induced_suffix_array

from .conftest import ODD, prose


def slow(t, cap):
    sa, lcp = sorted(range(len(t)), key=lambda i: t[i:].tolist()), [0]
    for a, b in zip(sa, sa[1:]):
        k = 0
        while k < cap and max(a, b) + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        lcp.append(k)
    return sa, lcp


@pytest.mark.parametrize("base,memory", [(1 << 22, 1 << 26), (2, 1 << 26), (1 << 22, 200), (2, 50)])
def test_induced_sort_with_common_prefixes(base, memory):
    r = random.Random(base + memory)
    for trial in range(120):
        sigma = r.choice([1, 2, 3, 10, 200])
        x = [r.randrange(1, sigma + 1) for _ in range(r.randrange(0, 120))] * r.randrange(1, 3)
        if trial % 5 == 0:
            x = x + [1] * 50 + x
        t = np.array(x + [0])
        sa, lcp = induced_suffix_array(t, 12, base, memory)
        assert (sa.tolist(), lcp.tolist()) == slow(t, 12)
        assert induced_suffix_array(t, 0, base, memory)[0].tolist() == sa.tolist()


def test_queue_keeps_order_on_disk():
    queue = SuffixQueue(100)
    for i in range(50):
        queue.push(i % 3, np.array([i], np.int32), np.array([i], np.uint8))
    assert queue.spilled
    for s in range(3):
        position, lcp = queue.pop(s)
        assert position.tolist() == lcp.tolist() == list(range(s, 50, 3)) and queue.pop(s) is None
    queue.close()


def brute(rows, length):
    key = lambda d: (d is None, d or 0)
    first = {}
    data = [((t or "").encode()) for _, t in rows]
    for (d, _), b in zip(rows, data):
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(first.get(s, key(d)), key(d))
    out = []
    for (d, _), b in zip(rows, data):
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < key(d):
                gone[i : i + length] = [True] * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = [i for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1])]
        out.append((str(d), len(b), sum(gone), len(spans), hashlib.sha256(kept).hexdigest(), kept, tuple(spans)))
    return sorted(out)


def check(docs, length=50, anchor=24):
    got = S.remove_repeats(docs, length, anchor, texts=True).collect()
    rows = [(str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"]),
             tuple(s["start"] for s in r["spans"])) for r in got]
    assert sorted(rows) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], length)
    return sum(r["n_removed"] for r in got)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(9)
    passages = [prose(i, 25) for i in range(12)]
    out = list(ODD)
    for i in range(80):
        parts = [prose(200 + i, r.randrange(1, 40))]
        for _ in range(r.randrange(0, 3)):
            p = r.choice(passages)
            cut = r.randrange(len(p))
            parts += [p[: len(p) - cut // 3], prose(400 + i, r.randrange(1, 9))]
        out.append(" ".join(parts))
    return out + ["a" * 300, "b" + "a" * 49, "b" + "a" * 50, "ab" * 200, "é" * 60, "xé" + "é" * 40, out[20], out[20] + "!"]


def test_equals_brute_force(make_docs, texts):
    assert check(make_docs(texts)) > 1000
    check(make_docs(texts).repartition(5), 20, 7)


def test_small_shards_buckets_and_hot_anchors(make_docs, texts, monkeypatch):
    monkeypatch.setattr(S, "SHARD_BYTES", 3000)
    monkeypatch.setattr(S, "BUCKET_BYTES", 5000)
    check(make_docs(texts[3:]).coalesce(2))
    monkeypatch.setattr(S, "HOT", 3)
    check(make_docs(texts[3:]).coalesce(2))


def test_odd_tables(make_docs):
    a, b = prose(1, 40), prose(2, 40)
    check(make_docs([]))
    check(make_docs([None, "", "short"]))
    check(make_docs([a, a, b, a + b, b, None], [None, 3, 3, None, 3, 1]))
    check(make_docs([a, a + b, b + a], [-5, -7, 0]))
