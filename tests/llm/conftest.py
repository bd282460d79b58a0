import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, spans int, size string"


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    parts = ["an", "er", "th", "ou", "le", "ß", "é", "ti", "no", "zu"]
    names = ["".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(vocabulary)]
    out = []
    for i in range(words):
        out.append(r.choice(names))
        if r.random() < 0.1:
            out[-1] += "."
        if r.random() < 0.03:
            out[-1] += "\n"
    return " ".join(out)


def twins(n, a="a", b="b"):
    """A Thue-Morse word of n letters (a power of two) and its complement."""
    word = a
    while len(word) < n:
        word += word.translate({ord(a): b, ord(b): a})
    return word, word.translate({ord(a): b, ord(b): a})


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, with extra columns whose names clash with those operators add."""

    def build(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en" if k % 3 else None, f"src{k % 5}" if k % 7 else None, None if t is None else len(t),
                 "x", k, "y") for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, SCHEMA)

    return build


#: Null, empty and blank texts, ties, repeats, one long text, and letters beyond ASCII.
ODD = [None, "", " \n\t ", "a", "A", "a", "word " * 30, "Ünï ﬁ Σς İ 1२3 <|endoftext|> x", None, "\x00\x1c\x85 b",
       "one two three four five six seven eight nine ten eleven", prose(5, 9000), prose(6, 300), prose(6, 300), *twins(1024), *twins(4096)]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs(ODD + [prose(i, 60 + i) for i in range(25)])
