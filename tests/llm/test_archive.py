import base64
import hashlib

import pytest

from ledgerlens.llm import archive as A


def sha(s):
    return base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()


def test_round_trip_equals_brute_force(spark):
    html = ["<p>one</p>", None, "", "<p>one</p>", "ü" * 5000, "x\r\n\r\ny", "x\r\n\r\ny", "<p>one</p>", "\nHTTP/1.0 no"]
    rows = [(i, None if i == 4 else f"http://h/{i} a b?ü", h, "clash") for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows[::-1], "page_id long, url string, html string, archive string")
    got = {r["page_id"]: r for r in A.round_trip(pages.repartition(3)).collect()}
    assert len(got) == len(html)
    first = {}
    for i, h in enumerate(html):
        payload = h or ""
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload.encode()), sha(payload))
        assert r["refers_to"] == first.get(payload)
        assert r["record_type"] == ("revisit" if payload in first else "response")
        first.setdefault(payload, i)


def test_least_bytes_and_odd_tables(spark):
    schema = "page_id long, url string, html string"
    some = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long enough"), (4, "u", "long enough")], schema)
    kinds = {r["page_id"]: r["refers_to"] for r in A.round_trip(some, least=5).collect()}
    assert kinds == {1: None, 2: None, 3: None, 4: 3}
    assert A.round_trip(spark.createDataFrame([], schema)).count() == 0
    twice = A.round_trip(spark.createDataFrame([(None, None, None), (1, "u", "a"), (1, "u", "a")], schema)).collect()
    assert sorted(r["record_type"] for r in twice) == ["response", "response", "revisit"]


def arc(version, records):
    data = A.member(A.arc_start("x.arc", version, "19990102030405"))
    for url, block in records:
        data += A.member(A.arc_record(version, url, "19990102030405", block, len(data), "x.arc"))
    return data


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_lines_and_declared_lengths(version):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nbody\n\nhttp://fake 0.0.0.0 1 t 3\nabc"
    found = list(A.parse_arc(arc(version, [("http://a/b", block), ("dns:a", b"1.2.3.4")])))
    assert [(r.url, r.block) for r in found] == [("http://a/b", block), ("dns:a", b"1.2.3.4")]
    assert found[0].split()[1].startswith(b"body") and found[1].split() == (b"", b"1.2.3.4")
    plain = b"".join(c for _, c in A.members(arc(version, [("http://a/b c", block), ("dns:a", b"")])))
    assert [r.block for r in A.parse_arc(A.member(plain))] == [block, b""]


def test_old_files_with_spaces_in_urls():
    text = A.arc_start("x.arc", "1", "1999") + b"http://a/b c d 1.2.3.4 19990102 text/plain 3\nabc\n"
    (r,) = A.parse_arc(A.member(text))
    assert (r.url, r.ip, A.iso_date(r.date)) == ("http://a/b c d", "1.2.3.4", "1999-01-02T00:00:00Z")


def test_damage_is_found():
    data = arc("1", [("http://a", b"abc")])
    with pytest.raises(ValueError):
        list(A.parse_arc(data[:-3]))
    with pytest.raises(ValueError):
        list(A.parse_arc(A.member(A.arc_start("x", "1", "1999") + b"http://a 0 1 t 99\nabc\n")))
    with pytest.raises(ValueError):
        list(A.parse_arc(A.member(b"http://a 0 1 t 3\nabc\n")))
    (r,) = A.parse_arc(data)
    good = A.warc_record(r, A.record_id("x", 1), None)
    ((headers, block),) = A.parse_warc(A.member(good))
    assert block == b"abc" and headers["warc-date"] == "1999-01-02T03:04:05Z"
    with pytest.raises(ValueError):
        list(A.parse_warc(A.member(good.replace(b"abc", b"abd"))))
