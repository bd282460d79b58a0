"""Byte-pair encoding and decoding with a given vocabulary.

The merges of a word are found with a segment tree over the ranks of its adjacent pairs:
the root holds the leftmost pair of the lowest rank, and a merge updates the leaves of
the pairs around it in logarithmic time, until the root holds no mergeable pair.
Short words go through many trees side by side in numpy; a long word has one of its own.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import small_batches

NONE = np.iinfo(np.int64).max
#: Words of at most this many symbols share vectorised trees.
WIDE = 64
#: Words a worker remembers; beyond it the memory starts anew.
REMEMBERED = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + i)
    return [out[b] for b in range(256)]


class MergeTree:
    """Segment tree over the adjacent pairs of one word; a node holds (rank, place)."""

    def __init__(self, ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]):
        self.ids, self.ranks = list(ids), ranks
        n = len(ids)
        self.size = 1 << max(0, (n - 1).bit_length())
        self.left, self.right = list(range(-1, n - 1)), list(range(1, n + 1))
        self.node = [(NONE, NONE)] * (2 * self.size)
        for i in range(n - 1):
            self.node[self.size + i] = self.leaf(i)
        for i in range(self.size - 1, 0, -1):
            self.node[i] = min(self.node[2 * i], self.node[2 * i + 1])

    def leaf(self, i: int) -> tuple[int, int]:
        j = self.right[i]
        if j >= len(self.ids):
            return NONE, NONE
        found = self.ranks.get((self.ids[i], self.ids[j]))
        return (found[0], i) if found else (NONE, NONE)

    def update(self, i: int, value: tuple[int, int]) -> None:
        i += self.size
        self.node[i] = value
        while i > 1:
            i >>= 1
            best = min(self.node[2 * i], self.node[2 * i + 1])
            if best == self.node[i]:
                break
            self.node[i] = best

    def merged(self) -> list[int]:
        if len(self.ids) < 2:
            return self.ids
        while self.node[1][0] != NONE:
            i = self.node[1][1]
            j = self.right[i]
            self.ids[i] = self.ranks[self.ids[i], self.ids[j]][1]
            self.right[i] = self.right[j]
            if self.right[j] < len(self.ids):
                self.left[self.right[j]] = i
            self.update(j, (NONE, NONE))
            self.update(i, self.leaf(i))
            if self.left[i] >= 0:
                self.update(self.left[i], self.leaf(self.left[i]))
        out, i = [], 0
        while i < len(self.ids):
            out.append(self.ids[i])
            i = self.right[i]
        return out


class PairRanks:
    """Rank and product of adjacent ids, looked up many at a time."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        key = np.array([(a << 32) | b for a, b, _ in merges], dtype=np.int64)
        first = np.unique(key, return_index=True)[1]
        self.key = np.append(key[first], NONE)
        self.rank = np.append(first, NONE)
        self.product = np.append(np.array([c for *_, c in merges], dtype=np.int64)[first], 0)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.key[:-1], key)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], NONE), self.product[at]


def merge_side_by_side(ids: np.ndarray, lengths: np.ndarray, pairs: PairRanks) -> list[list[int]]:
    """Final ids of words, each a row of ``ids`` (padded with -1) of at most ``WIDE`` symbols.

    All trees take one merge a round; finished words leave.  A node holds rank * WIDE + place,
    so its minimum is the leftmost pair of the lowest rank.
    """
    out: list[list[int]] = [[]] * len(ids)
    size = max(2, 1 << int(ids.shape[1] - 1).bit_length())
    n = len(ids)
    cur = np.full((n, size + 1), -1, dtype=np.int64)
    cur[:, : ids.shape[1]] = ids
    nxt = np.tile(np.arange(1, size + 2), (n, 1))
    prv = np.tile(np.arange(-1, size), (n, 1))
    nxt = np.where(np.arange(size + 1)[None, :] + 1 < lengths[:, None], nxt, size)

    def leaves(rows: np.ndarray, i: np.ndarray) -> np.ndarray:
        j = nxt[rows, i]
        rank, _ = pairs.find(cur[rows, i], cur[rows, j])
        ok = (j < size) & (rank != NONE)
        return np.where(ok, np.where(ok, rank, 0) * WIDE + i, NONE)

    tree = np.full((n, 2 * size), NONE, dtype=np.int64)
    rows, places = np.nonzero(np.arange(size)[None, :] + 1 < lengths[:, None])
    if len(rows):
        tree[rows, size + places] = leaves(rows, places)
    for i in range(size - 1, 0, -1):
        tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
    levels = size.bit_length() - 1

    def update(rows: np.ndarray, i: np.ndarray, value: np.ndarray | int) -> None:
        at = i + size
        tree[rows, at] = value
        for _ in range(levels):
            at = at >> 1
            tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

    active = np.flatnonzero(tree[:, 1] != NONE)
    while len(active):
        i = tree[active, 1] % WIDE
        j = nxt[active, i]
        _, product = pairs.find(cur[active, i], cur[active, j])
        after = nxt[active, j]
        cur[active, i] = product
        cur[active, j] = -1
        nxt[active, i] = after
        inner = after < size
        prv[active[inner], after[inner]] = i[inner]
        update(active, j, NONE)
        update(active, i, leaves(active, i))
        before = prv[active, i]
        has = before >= 0
        if has.any():
            update(active[has], before[has], leaves(active[has], before[has]))
        active = active[tree[active, 1] != NONE]
    kept = cur[:, :size]
    for row in range(n):
        out[row] = kept[row][kept[row] >= 0].tolist()
    return out


class BytePairEncoder:
    """Encoder and decoder for a ``tokenizers`` file of BPE with word ends and byte-level symbols.

    Texts are normalised (NFC, lower case), cut into words by the file's own pattern, and
    special tokens in a text count as such, as the library does it.
    """

    def __init__(self, spec: str):
        parts = json.loads(spec)
        model = parts["model"]
        if model["type"] != "BPE" or parts.get("decoder") or model["end_of_word_suffix"] is None:
            raise ValueError("expected BPE with word ends and no decoder")
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.words = regex.compile(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.specials = regex.compile("|".join(names)) if names else None
        self.token = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        triples = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in merges]
        self.pairs = PairRanks(triples)
        self.ranks = {}
        for rank, (a, b, c) in enumerate(triples):
            self.ranks.setdefault((a, b), (rank, c))
        symbols = byte_symbols()
        self.inner = np.array([self.vocab[s] for s in symbols])
        self.last = np.array([self.vocab[s + self.end] for s in symbols])
        self.known: dict[str, tuple[str, str, int]] = {}

    def pieces(self, text: str) -> Iterator[str | int]:
        """Words as they enter the merges, and the ids of special tokens."""
        at = 0
        if self.specials and "<|" in text:
            for m in self.specials.finditer(text):
                yield from self.plain(text[at : m.start()])
                yield self.special[m.group()]
                at = m.end()
        yield from self.plain(text[at:])

    def plain(self, text: str) -> list[str]:
        if not text.isascii():
            # One letter at a time, so a final sigma is like any other.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.words.findall(text.lower())

    def start(self, word: str) -> np.ndarray:
        data = np.frombuffer(word.encode(), np.uint8)
        ids = self.inner[data]
        ids[-1] = self.last[data[-1]]
        return ids

    def learn(self, words: list[str]) -> None:
        """Encode words not yet known, short ones of like length side by side."""
        groups: dict[int, list[str]] = {}
        for w in words:
            n = len(w.encode())
            groups.setdefault((n - 1).bit_length() if n <= WIDE else -1, []).append(w)
        for group, members in groups.items():
            if group < 0:
                for w in members:
                    self.remember(w, MergeTree(self.start(w).tolist(), self.ranks).merged())
                continue
            for at in range(0, len(members), 4096):
                some = members[at : at + 4096]
                ids = np.full((len(some), 1 << group), -1, dtype=np.int64)
                lengths = np.zeros(len(some), dtype=np.int64)
                for row, w in enumerate(some):
                    s = self.start(w)
                    lengths[row] = len(s)
                    ids[row, : len(s)] = s
                for w, merged in zip(some, merge_side_by_side(ids, lengths, self.pairs)):
                    self.remember(w, merged)

    def remember(self, word: str, ids: list[int]) -> None:
        self.known[word] = (" ".join(map(str, ids)), " ".join(self.token[i] for i in ids), len(ids))

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[str, str, int]]:
        """Per text: ids joined by a space, the decoded text, and the number of ids."""
        split = [list(self.pieces(t)) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = {w for words in split for w in words if w not in self.known}
        for special in [w for w in new if isinstance(w, int)]:
            new.discard(special)
            self.known[special] = (str(special), self.token[special], 1)
        self.learn(sorted(new))
        known = self.known
        for words in split:
            found = [known[w] for w in words]
            yield " ".join([f[0] for f in found]), " ".join([f[1] for f in found]), sum([f[2] for f in found])

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in next(self.encode_texts([text]))[0].split()]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space; word ends stay, as the file has no decoder."""
        return " ".join(self.token[i] for i in ids if i in self.token)


def encode_documents(docs: DataFrame, tokenizer_path: str, ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, [ids,] ids_sha256, decoded_sha256`` for every row.

    The vocabulary file (some MB) is read on the driver and sent to the workers.  A null
    text counts as empty; repeated rows are encoded one by one.  There is no shuffle.  A worker remembers a bounded number of words.
    """
    small_batches(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or BytePairEncoder(spec.value)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n, lists, hashes, decoded = [], [], [], []
            for joined, tokens, count in encoder.encode_texts(texts):
                n.append(count)
                hashes.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(tokens.encode()).hexdigest())
                if ids:
                    lists.append(np.array(joined.split(), dtype=np.int32))
            columns = [batch.column(0), pa.array(n, pa.int64())]
            names = ["doc_id", "n_tokens"]
            if ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            columns += [pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "ids_sha256", "decoded_sha256"])

    middle = "ids array<int>, " if ids else ""
    schema = f"doc_id {kind}, n_tokens long, {middle}ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", F.col("text")).mapInArrow(run, schema)
