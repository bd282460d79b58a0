import numpy as np
import pytest

from ledgerlens.llm import common as C

from .conftest import twins


def test_products_modulo_the_prime():
    r = np.random.default_rng(0)
    a, b = r.integers(0, C.PRIME, (2, 3000), dtype=np.uint64)
    a[:2], b[:2] = [C.PRIME - 1, 0], [C.PRIME - 1, C.PRIME - 1]
    assert C.times(a, b).tolist() == [x * y % C.PRIME for x, y in zip(a.tolist(), b.tolist())]


def test_span_hashes_do_not_depend_on_the_place(monkeypatch):
    r = np.random.default_rng(1)
    data = r.integers(0, 256, 60_000).astype(np.uint8)
    start = r.integers(0, 50_000, 200)
    end = start + r.integers(0, 3_000, 200)
    found = C.span_hash(C.prefix_hash(data), start, end)
    for s, e, h in zip(start, end, found):
        value = sum((x + 1) * pow(C.BASE, k, C.PRIME) for k, x in enumerate(data[s:e].tolist())) % C.PRIME
        assert C.mix(np.array([value | ((int(e - s) & 7) << 61)], np.uint64))[0] == h
    monkeypatch.setattr(C, "LONG_SPAN", 1_000)
    again = C.span_hash(C.prefix_hash(data[40:]), start[start >= 40] - 40, end[start >= 40] - 40)
    short = (end - start < 1_000)[start >= 40]
    assert (again == found[start >= 40])[short].all() and not (again == found[start >= 40])[~short].any()


@pytest.mark.parametrize("n", [1024, 4096, 1 << 15])
def test_complementary_words_differ(n):
    for pair in (twins(n), twins(n, "q", "ß")):
        found = set()
        for word in pair:
            data = np.frombuffer(word.encode(), np.uint8)
            found.add(int(C.span_hash(C.prefix_hash(data), np.array([0]), np.array([len(data)]))[0]))
        assert len(found) == 2
