import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from ledgerlens.llm import repair as R

from .conftest import prose

SCHEMA = "conv_id long, turn long, role string, text string, audit string, conv string, kind int"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def damage(rows):
    out = []
    for c, t, role, text in rows:
        told = [" " if x is None else x for x in (c, t, role, text)]
        kind = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20
        role, text = told[2:]
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, audit, turns) by trying all edits, best first per state."""
    best = {"": (0, "", ())}  # by last initial

    def add(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def inserted(states):
        out = dict(states)
        for _ in range(2):
            for last, (cost, audit, said) in list(out.items()):
                role = "assistant" if last == "u" else "user"
                add(out, role[0], (cost + 5, audit + "I", (*said, (role, ""))))
        return out

    for role, text, fault in rows:
        new, more = {}, 5 * (fault == "truncated")
        for last, (cost, audit, said) in inserted(best).items():
            add(new, last, (cost + 2, audit + "D", said))
            if fault not in ("blank", "duplicate"):
                turn = "assistant" if last == "u" else "user"
                add(new, turn[0], (cost + 1 + more, audit + "R", (*said, (turn, text))))
                if role[:1] == turn[0] or (role[:1] == "s" and last == ""):
                    add(new, role[0], (cost + more, audit + "K", (*said, (role, text))))
        best = new
    return min((v for s, v in inserted(best).items() if s in ("", "a")), key=lambda v: v[:2])


def brute(rows, ids):
    out = []
    for c in set(ids):
        own = sorted((r[1:] for r in rows if r[0] == c), key=lambda r: (
            r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in own:
            end = text.rstrip(R.BLANKS)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[0] for r in own} - {None}
        n = Counter(faults)
        pairs = zip(own, own[1:])
        cost, audit, said = cheapest([(r[1], r[2], f) for r, f in zip(own, faults)])
        assert GOOD.match("".join(r[0] for r, _ in said))
        out.append((str(c), max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()))
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA)
    got = R.repair_conversations(R.damaged(df), df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute(damage(rows), [r[0] for r in rows])


TEXTS = ["Yes.", "no", "", " \n", "What?\t ", "long ago", "Go!", "Sure.", None, "\x85."]
ROLES = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "s", "Assistant"]


def conversations(seed, n, longest=9):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        tidy = r.random() < 0.5
        for t in range(r.randrange(1, longest)):
            turn = t if r.random() < 0.9 else r.choice([None, t + 5, t - 1])
            role = ROLES[(t % 2)] if tidy or r.random() < 0.3 else r.choice(ROLES)
            rows.append((c, turn, role, f"{prose(c + t, 2)}." if tidy else r.choice(TEXTS)))
    r.shuffle(rows)
    return rows


def test_repairs_equal_brute_force(spark):
    check(spark, conversations(1, 400))


def test_odd_tables(spark):
    check(spark, [])
    check(spark, [(None, None, None, None), (None, 0, "user", "a."), (1, None, "user", "a"), (1, None, "user", "a"), (2, 5, "", "")])
    check(spark, [(1, 1, "user", "same.")] * 40 + [(1, 1, "assistant", prose(3, 20_000) + ".")] * 3 + [(1, 2, "user", prose(4, 9_000))])
    check(spark, [(7, t, "user", "same.") for t in range(60)] + [(8, 0, "assistant", "x")])


def test_long_conversations_are_spread(spark, monkeypatch):
    monkeypatch.setattr(R, "STRETCH", 40)
    monkeypatch.setattr(R, "SHARED", 100)
    monkeypatch.setattr(R, "PIECE", 7)
    r = random.Random(5)
    rows = [(c, t, r.choice(ROLES[:6]), r.choice(TEXTS) if r.random() < 0.3 else f"{t % 50} said.") for c in (1, 2) for t in range(700)]
    check(spark, rows + conversations(2, 60))


def test_grammar_gives_the_sequences_back():
    r = random.Random(3)
    for trial in range(60):
        texts = [[r.randrange(r.choice([1, 2, 5])) for _ in range(r.randrange(0, 60))] for _ in range(r.randrange(1, 8))]
        rules, left = R.re_pair(texts, 5)

        def spelled(s):
            return [s] if s < 5 else [x for half in rules[s - 5] for x in spelled(half)]

        assert [[x for s in own for x in spelled(s)] for own in left] == texts
        # No pair is left twice, apart from overlaps of one symbol with itself.
        pairs = Counter((a, b) for own in left for a, b in zip(own, own[1:]) if a != b)
        assert not pairs or max(pairs.values()) == 1
    rules, left = R.re_pair([[0, 1] * 512], 2)
    assert len(rules) <= 10 and len(left[0]) <= 2


def test_matrices_of_rules_equal_those_of_single_symbols():
    r = random.Random(4)
    evaluator = R.Evaluator()
    texts = ["".join(r.choice("suaoSUAOx") for _ in range(r.randrange(0, 40))) for _ in range(300)]
    for text, (cost, audit) in zip(texts, evaluator.solve(texts)):
        rows = [({"s": "s", "u": "u", "a": "a"}.get(c.lower(), "t"), "", "blank" if c == "x" else "truncated" if c.isupper() else "")
                for c in text]
        assert (cost, audit) == cheapest(rows)[:2]


def test_ropes_order_as_their_strings():
    r = random.Random(6)
    words = ["".join(r.choice("DIKR") for _ in range(r.randrange(0, 30))) for _ in range(60)] + ["KR" * 15, "KR" * 15 + "D"]

    def rope(text):
        if len(text) < 3:
            return R.Rope(text)
        cut = r.randrange(0, len(text))
        return rope(text[:cut]) + rope(text[cut:])

    for a in words:
        for b in words:
            assert (rope(a) < rope(b)) == (a < b) and str(rope(a)) == a
