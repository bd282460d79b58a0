import random
import re

import numpy as np
import pytest

from ledgerlens.llm import decontam as D
from ledgerlens.llm.fm_index import FMIndex, WaveletTree, suffix_array

from .conftest import ODD, prose, twins

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


@pytest.mark.parametrize("sigma", [2, 3, 50])
def test_index_counts_and_places(sigma):
    r = random.Random(sigma)
    for n in (1, 2, 50, 400):
        t = np.array([0] + [r.randrange(1, sigma) for _ in range(n)] * 2)
        assert suffix_array(t, sigma).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        index = FMIndex(t, sigma, sample=4)
        for m in (1, 2, 7):
            pattern = np.array([[r.randrange(1, sigma) for _ in range(m)] for _ in range(20)])
            low, high = index.ranges(pattern, np.full(20, m))
            for p, a, b in zip(pattern, low, high):
                want = [i for i in range(len(t)) if t[i : i + m].tolist() == p.tolist()]
                assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_places_behind_repeated_separators():
    # Steps back meet every row once; place 5, before an item, must lead to the other separator, 4.
    index = FMIndex(np.array([0, 5, 6, 7, 0, 0, 2, 3, 4, 0]), 8)
    symbol, rank = index.tree.symbol_and_rank(np.arange(index.n))
    back = (index.smaller[symbol] + rank).tolist()
    row, seen = 0, []
    for _ in range(index.n):
        seen.append(row)
        row = back[row]
    assert sorted(seen) == list(range(index.n))
    low, high = index.ranges(np.array([[2, 3, 4], [5, 6, 7]]), np.array([3, 3]))
    assert (high - low).tolist() == [1, 1] and index.locate(low).tolist() == [6, 1]


def test_documents_without_words_between_others():
    r = np.random.default_rng(5)
    for _ in range(60):
        sizes = r.integers(1, 40, 12) * (r.random(12) < 0.5)
        words, bounds = r.integers(0, 6, sizes.sum()).astype(np.uint64), np.concatenate([[0], np.cumsum(sizes)])
        shard, owner = D.Shard(words, bounds), np.repeat(np.arange(12), sizes)
        if not len(words):
            continue
        phrases = r.integers(0, 6, (30, 2)).astype(np.uint64)
        which, first = shard.occurrences(phrases, np.full(30, 2))
        want = [(p, i) for p in range(30) for i in range(len(words) - 1)
                if owner[i] == owner[i + 1] and (words[i : i + 2] == phrases[p]).all()]
        assert sorted(zip(which.tolist(), first.tolist())) == want


def test_items_behind_documents_without_words(spark, make_docs):
    items = [(i, prose(500 + i, 12)) for i in range(8)]
    texts = []
    for i, item in items:
        texts += [prose(600 + i, 30), "", None, "?!", item + " " + prose(700 + i, 30), ""]
    for i in range(8):
        check(spark, make_docs(texts[6 * i : 6 * i + 6]).coalesce(1), items)
    check(spark, make_docs(texts + texts[:6]).coalesce(1), items)


def test_wavelet_ranks():
    r = np.random.default_rng(1)
    s = r.integers(0, 11, 300)
    tree = WaveletTree(s, 11)
    i, c = np.arange(301), r.integers(0, 11, 301)
    assert tree.rank(c, i).tolist() == [(s[:a] == b).sum() for a, b in zip(i, c)]
    symbol, before = tree.symbol_and_rank(np.arange(300))
    assert symbol.tolist() == s.tolist() and before.tolist() == [(s[:a] == s[a]).sum() for a in range(300)]


def brute(docs, items, window=10):
    phrases = {}
    for item_id, text in items:
        words = WORD.findall(lower(text))
        m = min(window, len(words))
        for i in range(len(words) - m + 1 if words else 0):
            phrases.setdefault(tuple(words[i : i + m]), set()).add(item_id)
    lengths = {len(p) for p in phrases}
    out = []
    for doc_id, text in docs:
        found = list(WORD.finditer(lower(text)))
        words, hit, ids = [m.group() for m in found], [False] * len(found), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                p = tuple(words[i : i + n])
                if p in phrases:
                    hit[i : i + n] = [True] * n
                    ids |= {str(x) for x in phrases[p] if x is not None}
        spans, left, done = [], "", 0
        for i, h in enumerate(hit):
            if h and (i == 0 or not hit[i - 1]):
                spans.append([found[i].start(), found[i].end()])
            elif h:
                spans[-1][1] = found[i].end()
        for s, e in spans:
            left += (text or "")[done:s]
            done = e
        left = None if text is None else left + text[done:]
        out.append((str(doc_id), len(words), sum(hit), sorted(ids),
                    [(len(text[:s].encode()), len(text[:e].encode())) for s, e in spans], left))
    return sorted(out, key=str)


def check(spark, docs, items, window=10):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_contamination(docs, table, window).collect()
    rows = [(str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], [tuple(s) for s in r["spans"]], r["text"]) for r in got]
    assert sorted(rows, key=str) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], items, window)


def test_equals_brute_force(spark, make_docs, monkeypatch):
    items = [(i, prose(100 + i, 8 + i)) for i in range(30)] + [
        (7, prose(300, 40)), (None, "null id words here"), (50, None), (51, ""), (52, "Short Item"), (53, prose(101, 30))]
    texts = list(ODD)
    for i in range(60):
        words = prose(i, 120).split(" ")
        for j in (i % 30, (7 * i) % 35):
            words[i : i + 2] = [(items[j][1] or "").upper() if i % 3 else (items[j][1] or "")]
        texts.append(", ".join(words))
    texts += [texts[-1]] * 3 + [items[20][1] + "\n" + items[21][1], "short", "SHORT-item short item"]
    docs = make_docs(texts)
    check(spark, docs, items)
    check(spark, docs.repartition(4), items, window=3)


def test_spans_are_cut_out_of_whole_rows(spark, make_docs):
    item = prose(100, 14)
    docs = make_docs(["before " + item + ", after", None, "clean", item])
    got = D.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert got.schema.simpleString() == docs.schema.simpleString()
    rows, given = got.orderBy("doc_id").collect(), docs.orderBy("doc_id").collect()
    left = ", after" if item[-1] != "." else "., after"
    assert [r["text"] for r in rows] == ["before " + left, None, "clean", left[:-7]]
    assert [r["n_chars"] for r in rows] == [len("before " + left), None, 5, len(left) - 7]
    keep = [c for c in docs.columns if c not in ("text", "n_chars")]
    assert [[r[c] for c in keep] for r in rows] == [[r[c] for c in keep] for r in given]


def test_odd_tables(spark, make_docs):
    check(spark, make_docs([]), [(1, "a b c")])
    check(spark, make_docs(["a b c", None]), [])
    check(spark, make_docs(["a b c", "a b", "a b c"], [None, None, 3]), [(1, "b c"), (1, "a b"), (2, "b c")])


def test_many_shards_and_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(D, "SHARD_BYTES", 2000)
    monkeypatch.setattr(D, "BLOCK_BYTES", 150)
    items = [(i, prose(100 + i, 14)) for i in range(12)]
    texts = [prose(i, 50) + " " + items[i % 12][1] + " " + prose(i + 1, 30) for i in range(40)]
    check(spark, make_docs(texts).coalesce(2), items)


def test_words_of_a_regular_build_are_told_apart(spark, make_docs):
    for n in (1024, 4096):
        word, other = twins(n)
        docs = make_docs([word, other, f"a {other} b", f"a {word} b"])
        check(spark, docs, [(1, word), (2, "b " + other)])

