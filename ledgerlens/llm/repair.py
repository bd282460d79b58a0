"""Structure repair of conversations by dynamic programming over grammar-compressed sequences.

Rows of a conversation become symbols of role and fault.  Re-Pair compresses the sequences of
many conversations into rules that they share; a rule has one min-plus matrix of transfers
between the states of the wanted pattern, with the cheapest edits as a rope, and is evaluated
once, from the matrices of its two halves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import partitions, stored

#: Costs of the edits; a truncated row that stays adds ``TRUNCATED``.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Symbols of a sequence that are evaluated as one stretch, and of the stretches that share a grammar.
STRETCH, SHARED = 1 << 12, 1 << 18
#: Code points of a text that travel as one row.
PIECE = 1 << 14
#: White space that leaves a text blank.
BLANKS = " \t\n\x0b\f\r"

# States by what has been said so far: nothing, the system's turn, a user's, an assistant's.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
#: Symbols: role initials (o: any other), in capitals if the row is truncated, x if it must go.
SYMBOLS = "suaoSUAOx"


# --- ropes ----------------------------------------------------------------------------

_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51


class Rope:
    """A string as a tree of shared parts, with a hash of its characters."""

    __slots__ = ("left", "right", "text", "size", "hash", "power")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.size, self.hash = len(text), 0
            for c in text.encode():
                self.hash = (self.hash * _BASE + c + 1) % _PRIME
            self.power = pow(_BASE, self.size, _PRIME)
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * right.power + right.hash) % _PRIME
            self.power = left.power * right.power % _PRIME

    def __add__(self, other: Rope) -> Rope:
        return other if not self.size else self if not other.size else Rope("", self, other)

    def __str__(self) -> str:
        out, open_ = [], [self]
        while open_:
            rope = open_.pop()
            if rope.left is None:
                out.append(rope.text)
            else:
                open_ += [rope.right, rope.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """Order by bytes; equal parts are skipped by their hashes."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or (x.size == y.size and x.hash == y.hash):
                continue
            if x.left is not None and (x.size >= y.size or y.left is None):
                a += [x.right, x.left]
                b.append(y)
            elif y.left is not None:
                b += [y.right, y.left]
                a.append(x)
            else:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text < y.text
                if x.size > n:
                    a.append(Rope(x.text[n:]))
                if y.size > n:
                    b.append(Rope(y.text[n:]))
        return bool(b) and not a


# --- matrices ---------------------------------------------------------------------------

#: Cost and edits from a state to a state; None where there is no way.
Cell = tuple[int, Rope] | None
Matrix = list[list[Cell]]


def better(a: Cell, b: Cell) -> Cell:
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def row_times(row: Sequence[Cell], matrix: Matrix) -> list[Cell]:
    """The min-plus product: least cost, then least edits."""
    out: list[Cell] = [None] * 4
    for j in _STATES:
        if row[j] is not None:
            cost, edits = row[j]
            for k in _STATES:
                more = matrix[j][k]
                if more is not None and (out[k] is None or cost + more[0] <= out[k][0]):
                    out[k] = better(out[k], (cost + more[0], edits + more[1]))
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    return [row_times(row, b) for row in a]


def _empty() -> Matrix:
    return [[None] * 4 for _ in _STATES]


def inserts() -> Matrix:
    """Inserting rows, or none: a user's turn and an assistant's follow each other."""
    out = _empty()
    for i in _STATES:
        out[i][i] = 0, Rope()
        after = [_ASSISTANT, _USER] if i == _USER else [_USER, _ASSISTANT]
        for n, j in enumerate(after, 1):
            if j != i:
                out[i][j] = n * INSERT, Rope("I" * n)
    return out


def edits(symbol: str) -> Matrix:
    """What can become of a row, after any inserts before it."""
    out = _empty()
    role, more = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    for i in _STATES:
        out[i][i] = DELETE, Rope("D")
        if role != "x":
            turn = _ASSISTANT if i == _USER else _USER
            out[i][turn] = REROLE + more, Rope("R")
            if role == "ua"[turn == _ASSISTANT]:
                out[i][turn] = more, Rope("K")
    if role == "s":
        out[_NOTHING][_SYSTEM] = more, Rope("K")
    return times(inserts(), out)


# --- grammar ----------------------------------------------------------------------------


def re_pair(sequences: Sequence[Sequence[int]], symbols: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Replace the most frequent pair by a new symbol until none occurs twice.

    Returns the pairs of the new symbols (``symbols``, ``symbols + 1``, ...), each of earlier
    symbols, and the sequences that are left.  Pairs do not reach over the end of a sequence.
    """
    symbol, before, after = [], [], []
    for sequence in sequences:
        n, at = len(sequence), len(symbol)
        symbol += sequence
        before += [-1, *range(at, at + n - 1)][:n]
        after += [*range(at + 1, at + n), -1][:n]
    places: dict[tuple[int, int], set[int]] = {}
    for p, q in enumerate(after):
        if q >= 0:
            places.setdefault((symbol[p], symbol[q]), set()).add(p)
    queue = [(-len(found), pair) for pair, found in places.items() if len(found) > 1]
    heapify(queue)
    rules: list[tuple[int, int]] = []

    def drop(p: int) -> None:
        found = places.get((symbol[p], symbol[after[p]]))
        if found is not None:
            found.discard(p)

    def add(p: int) -> None:
        pair = symbol[p], symbol[after[p]]
        found = places.setdefault(pair, set())
        found.add(p)
        touched.add(pair)

    while queue:
        size, pair = heappop(queue)
        found = places.get(pair, ())
        if len(found) != -size:  # its number has changed since it was queued
            if len(found) > 1:
                heappush(queue, (-len(found), pair))
            continue
        new, touched = symbols + len(rules), set()
        del places[pair]
        rules.append(pair)
        for p in sorted(found):
            q = after[p]
            if q < 0 or (symbol[p], symbol[q]) != pair:
                continue  # an overlapping place came first
            left, right = before[p], after[q]
            if left >= 0:
                drop(left)
            if right >= 0:
                drop(q)
            symbol[p], symbol[q], after[p] = new, -1, right
            after[q] = -1
            if right >= 0:
                before[right] = p
                add(p)
            if left >= 0:
                add(left)
        for pair in touched:
            if len(places[pair]) > 1:
                heappush(queue, (-len(places[pair]), pair))
    left_over, at = [], 0
    for sequence in sequences:
        own, p = [], at if sequence else -1
        while p >= 0:
            own.append(symbol[p])
            p = after[p]
        left_over.append(own)
        at += len(sequence)
    return rules, left_over


class Evaluator:
    """The cheapest repairs of many sequences; the matrices of single symbols are kept."""

    def __init__(self) -> None:
        self.single = [edits(s) for s in SYMBOLS]
        self.inserts = inserts()

    def stretches(self, wanted: Sequence[tuple[str, bool]]) -> dict[tuple[str, bool], Matrix]:
        """Matrices of distinct stretches; only the first row of those that begin a conversation."""
        rules, left = re_pair([[SYMBOLS.index(c) for c in text] for text, _ in wanted], len(SYMBOLS))
        matrices = list(self.single)
        for a, b in rules:
            matrices.append(times(matrices[a], matrices[b]))
        out = {}
        for key, symbols in zip(wanted, left):
            rows = []
            for start in [_NOTHING] if key[1] else _STATES:
                row: list[Cell] = [None] * 4
                row[start] = 0, Rope()
                for s in symbols:
                    row = row_times(row, matrices[s])
                # Flat, so that nothing of the grammar is held on to.
                rows.append([None if c is None else (c[0], Rope(str(c[1]))) for c in row])
            out[key] = rows
        return out

    def solve(self, sequences: Sequence[str]) -> list[tuple[int, str]]:
        """Least cost and, among the cheapest, the least edits of each sequence of ``SYMBOLS``."""
        cut = [[(s[i : i + STRETCH], i == 0) for i in range(0, len(s), STRETCH)] for s in sequences]
        known: dict[tuple[str, bool], Matrix] = {}
        asked: dict[tuple[str, bool], None] = {}
        size = 0
        for key in (k for keys in cut for k in keys):
            if key not in known and key not in asked:
                asked[key] = None
                size += len(key[0])
                if size >= SHARED:
                    known |= self.stretches(list(asked))
                    asked, size = {}, 0
        known |= self.stretches(list(asked))
        out = []
        for keys in cut:
            row: list[Cell] = [(0, Rope()), None, None, None]
            for key in keys:
                row = known[key][0] if key[1] else row_times(row, known[key])
            row = row_times(row, self.inserts)
            best = better(row[_NOTHING], row[_ASSISTANT])
            out.append((best[0], str(best[1])))
        return out


# --- columns ----------------------------------------------------------------------------


def key_of(column: str) -> Column:
    """A value of any type as a string that is not null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by the checksum of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes it
    a user's.  Null roles and texts, and nulls in the checksum, count as one space; ids and
    turns stay null.
    """
    space = F.lit(" ")
    told = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *told).cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .where("kind <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
        .drop("copy")
    )


#: Order of rows; ascending order puts null first.
_ORDER = ["conv", "turn", "role", "digest"]


def symbol_rows(rows: DataFrame) -> DataFrame:
    """Distinct ``conv, turn, role, digest`` with their number of copies and the copies' symbols.

    Copies of a row are counted before they meet.  A row is new if its turn is the least at which
    its conversation has its role and text; the join that tells so has one row per key on either
    side, so it stays even however often a text is said.
    """
    end = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    counted = stored(
        rows.select(
            key_of("conv_id").alias("conv"), "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"),
            (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
            F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"))
        .groupBy("conv", "turn", "role", "digest")
        .agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("conv_id", "blank", "cut", "initial")]),
        "turns")
    first = (
        counted.where("not blank").groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("at"))
        .select(F.col("conv").alias("_conv"), F.col("at.turn").alias("_turn"), F.col("role").alias("_role"),
                F.col("digest").alias("_digest"))
    )
    same = F.lit(True)
    for c in ("conv", "turn", "role", "digest"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("_conv").isNull(), "duplicate")
             .when(F.col("cut"), "truncated").otherwise(""))
    symbol = (F.when(fault.isin("blank", "duplicate"), "x")
              .when(fault == "truncated", F.upper("initial")).otherwise(F.col("initial")))
    return counted.join(first, same, "left").select(
        "conv", "conv_id", "turn", "role", "digest", "n", "initial", fault.alias("fault"), symbol.alias("symbol"))


_PIECES = ("conv string, part long, symbols string, head string, tail string, illegal long, blank long, "
           "duplicate long, truncated long, turns long, head_turn long, least_turn long, tail_turn long")


def sequences(rows: DataFrame) -> DataFrame:
    """Stretches of conversations: symbols in order, and what is counted of them.

    The rows are range partitioned by conversation and order, so a long conversation is spread
    over tasks, and each holds one stretch of it.
    """

    kinds = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _PIECES.split(", ")])

    def batch_of(done: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([d | {"symbols": "".join(d["symbols"])} for d in done], schema=kinds)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, now = TaskContext.get().partitionId(), None, None
        for batch in batches:
            done = []
            for name, turn, n, initial, fault, symbol in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or name != conv:
                    if now is not None:
                        done.append(now)
                    conv = name
                    now = {"conv": name, "part": part, "symbols": [], "head": initial, "tail": "", "illegal": 0, "blank": 0,
                           "duplicate": 0, "truncated": 0, "turns": 0, "head_turn": turn, "least_turn": None, "tail_turn": None}
                # Copies of a row follow it; their initials repeat, which is never right.
                now["illegal"] += (now["tail"] != "" and now["tail"] + initial not in ("su", "ua", "au")) + n - 1
                if fault == "blank":
                    now["blank"] += n
                else:
                    now["duplicate"] += n if fault == "duplicate" else n - 1
                    now["truncated"] += fault == "truncated"
                now["turns"] += turn is not None and turn != now["tail_turn"]
                now["tail"], now["tail_turn"] = initial, turn
                now["least_turn"] = turn if now["least_turn"] is None else now["least_turn"]
                now["symbols"].append(symbol + "x" * (n - 1))
            yield batch_of(done)
        if now is not None:
            yield batch_of([now])

    ordered = rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return ordered.select(
        "conv", F.col("turn").cast("long"), "n", "initial", "fault", "symbol").mapInArrow(scan, _PIECES)


_PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def plans(rows: DataFrame) -> DataFrame:
    """``conv`` and the figures and cheapest edits of each conversation of ``symbol_rows``.

    What meets in one task for a conversation is one character a row, as many as its result has.
    """
    parts = [c.split()[0] for c in _PIECES.split(", ")][1:]
    whole = sequences(rows).groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*parts))).alias("parts"))
    kinds = pa.schema([("conv", pa.string())] + [
        (c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _PLAN.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evaluator = Evaluator()
        for batch in batches:
            convs, out = batch.column(0).to_pylist(), []
            stretches = batch.column(1).to_pylist()
            found = evaluator.solve(["".join(p["symbols"] for p in own) for own in stretches])
            for conv, own, (cost, audit) in zip(convs, stretches, found):
                row = {c: sum(p[c] for p in own) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
                for a, b in zip(own[:-1], own[1:]):
                    row["illegal"] += a["tail"] + b["head"] not in ("su", "ua", "au")
                    row["turns"] -= a["tail_turn"] is not None and a["tail_turn"] == b["head_turn"]
                # Turns ascend from the first that is not null.
                most, least = own[-1]["tail_turn"], [p["least_turn"] for p in own if p["least_turn"] is not None]
                turns = row.pop("turns")
                row["gaps"] = most - least[0] + 1 - turns if least else 0
                out.append({"conv": conv, "cost": cost, "audit": audit} | row)
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return whole.mapInArrow(run, f"conv string, {_PLAN}")


# --- repaired conversations ----------------------------------------------------------------


class _Teller:
    """Tells a conversation's rows, as its edits say, to a running SHA-256."""

    def __init__(self, audit: str):
        self.audit, self.at, self.hash, self.said = audit, 0, hashlib.sha256(), None
        self.open = False

    def _say(self, role: str | None) -> None:
        if self.said is not None:
            self.hash.update(b"\n")
        if role is None:
            role = "assistant" if self.said == "u" else "user"
        self.said = role[0]
        self.hash.update(f"{role}:".encode())

    def step(self, role: str) -> None:
        """The edits up to the next row's own; its text follows if it stays."""
        while self.audit[self.at] == "I":
            self._say(None)
            self.at += 1
        edit = self.audit[self.at]
        self.at += 1
        self.open = edit != "D"
        if self.open:
            self._say(role if edit == "K" else None)

    def text(self, piece: str) -> None:
        if self.open:
            self.hash.update(piece.encode())

    def end(self) -> str:
        for _ in range(self.at, len(self.audit)):
            self._say(None)
        return self.hash.hexdigest()


def repaired(rows: DataFrame, planned: DataFrame, ids: DataFrame) -> DataFrame:
    """Add ``repaired_sha256`` to the plans, for every conversation of ``ids`` (``conv, conv_id``).

    The plan of a conversation comes before its rows, whose texts travel in pieces of bounded
    length and are hashed as they come, so a task holds one batch of pieces whatever the length
    of a conversation.  A conversation's digest is one running hash, so its rows pass one task.
    """
    named = [c.split()[0] for c in _PLAN.split(", ")]
    fill = {c: F.coalesce(c, F.lit("" if c == "audit" else 0)) for c in named}
    told = ids.join(planned, "conv", "left").withColumns(fill)
    none = F.lit(None)
    kinds = {"kind": "int", "turn": "long", "role": "string", "digest": "binary", "at": "int", "text": "string"}
    heads = told.select("conv", *[(F.lit(0) if c == "kind" else none).cast(k).alias(c) for c, k in kinds.items()],
                        "conv_id", *named)
    pieces = F.sequence(F.lit(0), F.expr(f"cast(greatest(length(text) - 1, 0) div {PIECE} as int)"))
    texts = rows.select(key_of("conv_id").alias("conv"), F.lit(1).alias("kind"), F.col("turn").cast("long"), "role",
                        F.unhex(F.sha2("text", 256)).alias("digest"), F.explode(pieces).alias("at"), "text")
    texts = texts.withColumn("text", F.substring("text", F.col("at") * PIECE + 1, F.lit(PIECE)))
    for c in ("conv_id", *named):
        texts = texts.withColumn(c, none.cast(heads.schema[c].dataType))
    order = ["conv", "kind", *_ORDER[1:], "at"]
    columns = ["conv_id", *named, "conv", "kind", "turn", "role", "digest", "at", "text"]
    together = heads.unionByName(texts).repartition(partitions(rows.sparkSession), "conv")
    n = 1 + len(named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        teller, head, row, copies, role, fields = None, None, None, 0, "", None

        def close_row() -> None:
            for _ in range(copies - 1):
                teller.step(role)

        for batch in batches:
            fields = [*list(batch.schema)[:n], pa.field("repaired_sha256", pa.string())]
            heads_done, hashes = [], []
            plan = batch.slice(0, batch.num_rows).select(list(range(n)))
            kinds = batch.column(n + 1).to_pylist()
            rest = [batch.column(i).to_pylist() for i in range(n + 2, batch.num_columns)]
            for i, kind in enumerate(kinds):
                if kind == 0:
                    if teller is not None:
                        close_row()
                        heads_done.append(head)
                        hashes.append(teller.end())
                    head = pa.Table.from_batches([plan.slice(i, 1)])
                    teller, row, copies = _Teller(plan.column(n - 1)[i].as_py()), None, 0
                    continue
                turn, name, digest, at, text = (c[i] for c in rest)
                key = (turn, name, digest)
                if key != row:
                    close_row()
                    row, copies, role, seen = key, 0, name, -1
                if at == 0:
                    copies += 1
                    if copies == 1:
                        teller.step(role)
                # Of copies, whose pieces lie side by side, the first one tells its text.
                if at > seen:
                    teller.text(text)
                    seen = at
            if heads_done:
                yield from _told(heads_done, hashes, fields)
        if teller is not None:
            close_row()
            yield from _told([head], [teller.end()], fields)

    def _told(heads_done: list[pa.Table], hashes: list[str], fields: list[pa.Field]) -> list[pa.RecordBatch]:
        table = pa.concat_tables(heads_done).append_column("repaired_sha256", pa.array(hashes, pa.string()))
        return table.cast(pa.schema(fields)).combine_chunks().to_batches()

    schema = f"conv_id {heads.schema['conv_id'].dataType.simpleString()}, {_PLAN}, repaired_sha256 string"
    return together.sortWithinPartitions(*order).select(*columns).mapInArrow(run, schema)


def repair_conversations(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows ``conv_id, turn, role, text`` are taken by turn (null first), those of one turn by role
    and then by the SHA-256 of their text; equal rows follow each other.  The first fault of a row
    counts: blank, a copy of a row before it (role and text), or truncated.  Rows may be kept,
    rerolled or deleted (blank ones and copies must be) and turns inserted, so that role initials
    become ``(s?(ua)+)?`` at least cost; of the cheapest edits the least in ASCII is the ``audit``.
    ``illegal`` counts neighbours that may not follow each other.  ``ids`` may name conversations
    (``conv_id``, null allowed) that have no rows: zeros, no edits and the digest of nothing.
    Null roles and texts count as one space; other columns are ignored.
    """
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))
    ids = (rows if ids is None else ids).select("conv_id")
    known = ids.withColumn("conv", key_of("conv_id")).groupBy("conv").agg(F.min("conv_id").alias("conv_id"))
    planned = stored(plans(symbol_rows(rows)), "repairs")
    return repaired(rows, planned, known)
