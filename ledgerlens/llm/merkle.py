"""Merkle fingerprints of documents.

A text is cut into sections, these into paragraphs, these into leaves of a few words; a
node's digest covers its children's, so equal roots mean equal texts, and two trees are
compared from the root down, entering only branches that differ.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlens.llm.common import partitions, small_batches

#: Words of a leaf; leaves start anew with every paragraph.
LEAF_WORDS = 6
#: A paragraph ends a section if it is blank or, on average, one time in this many by its digest.
SECTION = 8
#: Hex digits that a fingerprint shows of a node's digest.
SHOWN = 8

_PARAGRAPH = re.compile(r"[^\n]*\n|[^\n]+")
_LEAF = re.compile(r"\s*(?:\S+\s*){1,%d}|\s+" % LEAF_WORDS)


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def fingerprint(text: str) -> str:
    """``root|section(paragraph(leaf leaf)paragraph(leaf))section(...)``, digests in hex.

    Leaves with their white space add up to the text, so the root covers every character.
    The root and all digests inside the tree have 128 bits; below the root 32 are shown.
    """
    sections, out, open_, shown = [], [], [], []

    def close() -> None:
        d = digest(b"s" + b"".join(open_))
        sections.append(d)
        out.append(f"{d.hex()[:SHOWN]}({''.join(shown)})")
        open_.clear()
        shown.clear()

    for part in _PARAGRAPH.findall(text):
        leaves = [hashlib.blake2b(p.encode(), digest_size=16).digest() for p in _LEAF.findall(part)]
        d = digest(b"p" + b"".join(leaves))
        open_.append(d)
        shown.append(f"{d.hex()[:SHOWN]}({' '.join([x.hex()[:SHOWN] for x in leaves])})")
        if d[-1] % SECTION == 0 or not part.strip():
            close()
    if open_:
        close()
    return f"{digest(b'r' + b''.join(sections)).hex()}|{''.join(out)}"


_NODE = re.compile(r"([0-9a-f]+)\(((?:[0-9a-f]+\([0-9a-f ]*\))*)\)")
_LOW = re.compile(r"([0-9a-f]+)\(([0-9a-f ]*)\)")


def _left(a: list, b: list) -> tuple[int, list, list]:
    """Leaves below the nodes that both sides have, and the other nodes of each side."""
    have = Counter(d for d, _, _ in b)
    same, rest = 0, []
    for node in a:
        if have[node[0]] > 0:
            have[node[0]] -= 1
            same += node[2]
        else:
            rest.append(node)
    other = []
    for node in reversed(b):
        if have[node[0]] > 0:
            have[node[0]] -= 1
            other.append(node)
    return same, rest, other[::-1]


def likeness(a: str, b: str) -> float:
    """Share of the larger tree's leaves that the other has too, 0 to 1; 1 for equal roots.

    Branches with equal digests count whole; only those that differ are entered.
    """
    (root_a, _, body_a), (root_b, _, body_b) = a.partition("|"), b.partition("|")
    if root_a == root_b:
        return 1.0
    tops = [[(d, rest, rest.count("(") + rest.count(" ")) for d, rest in _NODE.findall(x)]
            for x in (body_a, body_b)]
    size = max(sum(n for *_, n in t) for t in tops)
    if not size:
        return 0.0
    same, *tops = _left(*tops)
    lows = [[(d, rest, 1 + rest.count(" ")) for _, body, _ in t for d, rest in _LOW.findall(body)]
            for t in tops]
    more, *lows = _left(*lows)
    leaves = [Counter(x for _, rest, _ in low for x in rest.split()) for low in lows]
    return min((same + more + (leaves[0] & leaves[1]).total()) / size, 1.0 - 1e-9)


def differing(a: str, b: str) -> tuple[list[int], list[int]]:
    """Numbers of the paragraphs of each fingerprinted text that the other lacks."""
    sides = []
    for x in (a, b):
        lows = _LOW.findall(x.partition("|")[2])
        sides.append([(d, i, 1) for i, (d, _) in enumerate(lows)])
    _, left, right = _left(*sides)
    return [i for _, i, _ in left], [i for _, i, _ in right]


def edited(text: str, donor: str) -> str:
    """``text`` with its last half replaced by as many first code points of ``donor``."""
    half = len(text) // 2
    return text[: len(text) - half] + donor[:half]


def with_fingerprints(docs: DataFrame, column: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of every whole ``text`` (null counts as empty); no shuffle."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def tree(texts):
        return texts.map(lambda t: fingerprint(t or ""), na_action=None)

    return docs.withColumn(column, tree("text"))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    The next document has the next smaller ``doc_id`` (null lowest, equal ids in the order
    of their texts); after the smallest comes the largest.  The texts are shuffled once, into
    runs of ascending ids.  A run also gets the largest document of the run before it, so that
    every neighbour is at hand; these are as many as there are runs.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = 4 * partitions(spark)
    shares = [i / runs for i in range(1, runs)]
    value = F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e300))
    found = docs.agg(F.percentile_approx(value, shares, 10 * runs)).first()[0] or []
    limits = np.unique(np.array(found, dtype=float))

    @F.pandas_udf("int")
    def run_of(values):
        return pd.Series(np.searchsorted(limits, values.to_numpy(dtype=float), side="left"))

    # One row per run.
    tops = (
        docs.select("doc_id", run_of(value).alias("run"))
        .groupBy("run").agg(F.max("doc_id").alias("top")).orderBy("run").collect()
    )
    if not tops:
        tops = [{"run": 0, "top": None}]
    following = [(t["top"], tops[(i + 1) % len(tops)]["run"]) for i, t in enumerate(tops)]
    table = spark.createDataFrame(following, f"top {kind}, to int")
    own = F.struct(F.col("run"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("to").alias("run"), F.lit(True).alias("guest"))
    together = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), run_of(value).alias("run"))
        .join(F.broadcast(table), F.col("doc_id").eqNullSafe(F.col("top")), "left")
        .withColumn("place", F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, guest))))
        .select("doc_id", "text", "place.run", "place.guest")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, before_print = "", ""
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for doc_id, text, _, guest in zip(*columns):
                own = fingerprint(text)
                if not guest:
                    changed = edited(text, before)
                    print_ = fingerprint(changed)
                    rows.append((
                        doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, print_,
                        likeness(own, print_), likeness(own, before_print),
                    ))
                before, before_print = text, own
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    types = [to_arrow_type(docs.schema["doc_id"].dataType), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]
    schema = (f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    return (
        together.repartition("run")
        .sortWithinPartitions("run", F.desc("guest"), "doc_id", "text")
        .select("doc_id", "text", "run", "guest")
        .mapInArrow(compare, schema)
    )
