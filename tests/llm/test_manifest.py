import hashlib
import zlib

import numpy as np
import pytest

from ledgerlens.llm import manifest as M

from .conftest import ODD, prose


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    """Of ``doc_id, source, lang, n_chars, text`` rows."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    built = {}
    for n in names:
        own = sorted(trees[n], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built[n] = own, levels([leaf(r) for r in own])
    top = levels([built[n][1][-1][0] for n in names])
    out = []
    for k, n in enumerate(names):
        own, tree = built[n]
        for i, r in enumerate(own):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            h, others = leaf((*r[:4], lower(r[4])) if tampered else r), ""
            for part, j in ((tree, i), (top, k)):
                for level in part[:-1]:
                    run, p = level[j // 8 * 8 : j // 8 * 8 + 8], j % 8
                    others += "".join(run[:p] + run[p + 1 :])
                    h = digest("".join(run[:p] + [h] + run[p + 1 :]))
                    j //= 8
            out.append((str(r[0]), leaf(r), tree[-1][0], top[-1][0], digest(others), h, h == top[-1][0]))
    return sorted(out)


def check(docs):
    got = sorted((str(r[0]), *r[1:]) for r in M.prove_documents(docs).collect())
    assert got == brute([tuple(r) for r in docs.select(*M.FIELDS).collect()])
    return got


def postorder(leaves, height):
    """Nodes (level, index) in the order in which they are completed."""
    out = []

    def visit(level, index):
        if level:
            for child in range(index * 8, min(index * 8 + 8, -(-leaves // 8 ** (level - 1)))):
                visit(level - 1, child)
        out.append((level, index))

    visit(height, 0)
    return out


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 100, 511, 512, 513, 700])
def test_places_follow_from_the_sizes_of_subtrees(leaves):
    for height in {M.height(leaves), 3 if leaves <= 512 else 4}:
        nodes = postorder(leaves, height)
        places = {(level, i): p for level in range(height + 1)
                  for i, p in enumerate(M.positions(level, np.arange(-(-leaves // 8**level)), leaves).tolist())}
        assert [places[n] for n in nodes] == list(range(len(nodes)))
        # The log has the digests in that order.
        own = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(leaves)]
        log = M.postorder_log(own, height)
        tree = [own]
        while len(tree) <= height:
            tree.append([M.node_hash(b"".join(tree[-1][i : i + 8])) for i in range(0, len(tree[-1]), 8)])
        assert log == b"".join(tree[level][i] for level, i in nodes)
        segment = M.Segment(log, leaves, height)
        for i in range(0, leaves, 1 + leaves // 9):
            assert M.fold(own[i], M.siblings(segment.proof(i))) == log[-32:]
            assert height == 0 or M.fold(own[i - 1], M.siblings(segment.proof(i))) != log[-32:] or leaves == 1


def test_equals_brute_force(make_docs):
    got = check(make_docs([prose(i, 5).title() if i % 4 else prose(i, 5) for i in range(700)], [13 * i % 701 - 50 for i in range(700)]).repartition(5))
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_odd_tables(odd_docs, make_docs, spark):
    check(odd_docs)
    check(make_docs([]))
    check(make_docs(["only"]))
    check(make_docs(["b", "b", "a", None, "", None], [None, None, 1, 1, 2, 2]))
    names = odd_docs.selectExpr("concat('id-', doc_id) as doc_id", "text", "lang", "source", "n_chars",
                                "text as leaf", "lang as tree", "n_chars as place", "text as digest")
    check(names.repartition(3))


def test_tiers_write_one_postorder(spark, make_docs, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 1)
    docs = make_docs([prose(i, 3) for i in range(300)]).withColumn("lang", M.F.expr("if(doc_id % 3 = 0, 'a', null)"))
    check(docs)
    rows = docs.select("lang", "doc_id", M.leaf_column([M.F.col(c) for c in M.FIELDS]).alias("digest"))
    made = M.build_manifest(rows)
    assert len(made.forest.tiers) >= 3
    for tree, n in (("=a", 100), ("", 200)):
        order = {r["doc_id"]: bytes(r["digest"]) for r in rows.collect() if (r["doc_id"] % 3 == 0) == (tree == "=a")}
        whole = M.postorder_log([order[i] for i in sorted(order)], M.height(n))
        places = {}
        for r in made.log().where(M.F.col("tree") == tree).collect():
            nodes = [bytes(r["nodes"])[i : i + 32] for i in range(0, len(r["nodes"]), 32)]
            if r["levels"] and r["tier"]:
                assert whole[32 * r["first"] : 32 * r["first"] + 32] == nodes[min(8, r["items"])]
            if not r["tier"]:
                for k, node in enumerate(nodes):
                    places[r["first"] + k] = node
        assert all(whole[32 * p : 32 * p + 32] == node for p, node in places.items()) and len(places) > n


def test_one_large_tree_is_numbered_across_tasks(spark):
    rows = spark.range(5000).selectExpr(
        "case when id < 4000 then '=big' when id < 4001 then '=c' else concat('=', id) end as tree", "id", "id as digest")
    got = M.numbered(rows.repartition(7), ["id"]).collect()
    assert sorted(r["place"] for r in got if r["tree"] == "=big") == list(range(4000))
    assert all(r["place"] == r["id"] for r in got if r["tree"] == "=big")
    assert all(r["place"] == 0 for r in got if r["tree"] != "=big") and len(got) == 5000
