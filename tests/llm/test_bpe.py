import hashlib
import random

import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from ledgerlens.llm import bpe  # noqa: E402
from .conftest import ODD, prose  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return bpe.BytePairEncoder(f.read())


def odd_texts():
    r = random.Random(3)
    alphabet = "abcdefgh'sdtlm ABC \n\t 12३ é è ß İ Σ ς ǅ ﬁ … — 漢字 🙂 ́     <|endoftext|>"
    letters = list(alphabet) + ["<|endoftext|>", "<|startoftext|>", "'re", "'ll", "supercalifragilistic"]
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(600)]


def test_equals_the_library(encoder, library):
    texts = [t or "" for t in ODD] + odd_texts() + [prose(i, 100) for i in range(20)] + ["ab" * 700 + " x", "a" * 200]
    for text, (ids, decoded, n) in zip(texts, encoder.encode_texts(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)) and n == len(want), text
        assert decoded == library.decode(want, skip_special_tokens=False), text
        assert encoder.decode(want) == decoded


def test_single_tree_equals_trees_side_by_side(encoder):
    r = random.Random(1)
    words = ["".join(r.choice("abcdeinotrs") for _ in range(r.randint(1, 60))) for _ in range(300)]
    encoder.known.clear()
    encoder.learn(words)
    for w in words:
        alone = bpe.MergeTree(encoder.start(w).tolist(), encoder.ranks).merged()
        assert encoder.known[w][0] == " ".join(map(str, alone))


def test_documents(odd_docs, make_docs, library):
    rows = bpe.encode_documents(odd_docs, PATH).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_documents(make_docs([]), PATH, ids=False).count() == 0
    assert bpe.encode_documents(make_docs(["a", "a"], [None, None]), PATH).count() == 2
