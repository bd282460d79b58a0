import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import hyperminhash as H
from ledgerlens.llm.components import components

from .conftest import ODD, prose


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows, percent=75):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    sets = [(("id", d) if d is not None else ("row", i), shingles(t)) for i, (d, t) in enumerate(rows)]
    for (a, s), (b, t) in combinations(sets, 2):
        if a[0] == b[0] == "id" and s and t and 100 * len(s & t) >= percent * len(s | t):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    out = []
    for k, s in sets:
        d = k[1] if k[0] == "id" else None
        c = find(k)[1] if d is not None else None
        out.append((str(d), len(s), str(c), d is None or c == d))
    return sorted(out)


def check(docs, percent=75):
    got = H.near_duplicates(docs, percent).collect()
    rows = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got)
    assert rows == brute([(r["doc_id"], r["text"]) for r in docs.collect()], percent)
    return got


def families(seed, bases, copies):
    r = random.Random(seed)
    texts = []
    for b in range(bases):
        words = prose(1000 * seed + b, r.choice([3, 5, 6, 9, 20, 60, 300])).split()
        for _ in range(r.randrange(1, copies)):
            new = list(words)
            for _ in range(r.randrange(0, 1 + len(words) // 20)):
                new[r.randrange(len(new))] = r.choice(["x", "y", "z"])
            texts.append(" ".join(new))
    r.shuffle(texts)
    return texts


@pytest.fixture(scope="module")
def texts():
    return list(ODD) + families(1, 40, 12)


def test_equals_brute_force(make_docs, texts):
    check(make_docs(texts))


def test_every_route_gives_the_same(make_docs, texts, monkeypatch):
    common = "this very common line stands in many a short document of all kinds "
    many = texts[:60] + [common + prose(5000 + i, 6) for i in range(60)]
    monkeypatch.setattr(H, "SMALL", 3)
    monkeypatch.setattr(H, "BLOCK", 7)
    check(make_docs(many))
    monkeypatch.setattr(H, "LARGE", 5)
    check(make_docs(many))


def test_odd_tables(make_docs):
    a, b = prose(1, 40), prose(2, 40)
    assert check(make_docs([])) == []
    check(make_docs([None, "", "one", "One", "one two", "one  TWO\n"]))
    check(make_docs([a, a, a, b], [None, None, 7, 7]))
    got = {(r["doc_id"], r["component_id"]) for r in H.near_duplicates(make_docs([a, b, b, a, "c"], [5, 5, 2, 9, 1])).collect()}
    assert got == {(5, 2), (2, 2), (9, 2), (1, 1)}


def test_kept_documents(make_docs, texts):
    docs = make_docs(texts)
    want = [d for d, _, _, k in brute(list(enumerate(texts))) if k]
    kept = H.keep_one(docs)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want and kept.columns == docs.columns


def test_sketch_estimates():
    r = np.random.default_rng(1)
    for n, share in ((30, 0.5), (400, 0.75), (20000, 0.3), (20000, 0.0)):
        pool = r.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
        cut = int(n * share)
        a, b = np.sort(pool[:n]), np.sort(pool[n - cut : 2 * n - cut])
        true = cut / (2 * n - cut)
        found, full = H.estimate(H.registers(a)[None], H.registers(b)[None], np.array([n]), np.array([n]))
        assert abs(found[0] - true) < 5 * np.sqrt(max(true * (1 - true), 0.002) / full[0])
    one = H.registers(np.array([(5 << 56) | (1 << 40) | (3 << 38)], dtype=np.uint64))
    zeros = 52 - 37  # the value below the bucket loses four bits
    assert one[5] == ((zeros + 1) << 10) + 0b1100000000 and (np.delete(one, 5) == 0).all()
    assert len(set(H.band_keys(one).tolist())) == 64 and len(H.band_keys(np.zeros(256, np.uint16))) == 0


def test_bands_of_small_sets_agree_as_their_registers_do():
    r = np.random.default_rng(2)
    for n in (4, 8, 40, 150):
        far = near = 0
        for _ in range(150):
            pool = r.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
            base = set(H.band_keys(H.registers(np.sort(pool[:n]))).tolist())
            near += bool(base & set(H.band_keys(H.registers(np.sort(pool[: n - n // 4]))).tolist()))
            far += bool(base & set(H.band_keys(H.registers(np.sort(pool[n - max(n // 8, 1) : 2 * n - max(n // 8, 1)]))).tolist()))
        assert near == 150 and far < 40


def test_shingles_of_batches():
    column = pa.array([None, "a b c d e F", "a b c d e", "b c d e f"], pa.string())
    s = list(H.shingle_sets(column))
    assert [len(x) for x in s] == [0, 2, 1, 1]
    assert set(s[1].tolist()) == set(s[2].tolist()) | set(s[3].tolist())


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [
        (r.randrange(200, 400), r.randrange(200, 400)) for _ in range(120)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {x: find(x) for x in list(parent) if find(x) != x}
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {n: c for n, c in got} == want
