import hashlib

from ledgerlens.llm import merkle as M
from .conftest import prose


def test_equal_roots_mean_equal_texts():
    texts = ["", " ", "\n", "a", "a\n", "a b", "a  b", "a\nb", "a\n\nb", prose(1, 200), prose(1, 200) + " "]
    prints = [M.fingerprint(t) for t in texts]
    assert len({p.partition("|")[0] for p in prints}) == len(texts)
    assert M.likeness(prints[-2], prints[-2]) == 1.0 > M.likeness(prints[-2], prints[-1]) > 0.9


def test_differing_branches_locate_edits():
    lines = [prose(i, 30).replace("\n", " ") for i in range(40)]
    a = "\n".join(lines)
    b = "\n".join(lines[:7] + ["changed"] + lines[8:20] + lines[21:])
    left, right = M.differing(M.fingerprint(a), M.fingerprint(b))
    assert left == [7, 20] and right == [7]
    assert 0.9 < M.likeness(M.fingerprint(a), M.fingerprint(b)) < 1


def test_leaves_add_up_to_the_text():
    for text in (prose(3, 500), " \n\n a\tb \n", "x" * 5000, "\x1c a"):
        parts = M._PARAGRAPH.findall(text)
        assert "".join(parts) == text
        assert all("".join(M._LEAF.findall(p)) == p for p in parts)


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, donor = text or "", rows[i - 1][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + donor[:half]
        f, e, n = (M.fingerprint(x) for x in (text, edited, donor))
        out.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e,
                    M.likeness(f, e), M.likeness(f, n)))
    return sorted(out)


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = M.compare_with_next(docs).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(rows)


def test_every_document_meets_its_next(odd_docs, make_docs):
    check(odd_docs.repartition(5))
    check(make_docs([prose(i, 20) for i in range(60)], [7 * i % 61 - 30 for i in range(60)]))
    check(make_docs(["only"]))
    check(make_docs([]))
    check(make_docs(["b", "a", None, "c"], [None, 1, 1, 2]))


def test_fingerprints_of_a_table(odd_docs):
    for r in M.with_fingerprints(odd_docs, "print").collect():
        assert r["print"] == M.fingerprint(r["text"] or "") and r["spans"] is not None
