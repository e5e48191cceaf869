"""Archives: round trip, framing, revisits, damage."""

import gzip
import hashlib
import io

import pytest

from dimstack.llm import queries, warc

SF = "/root/testdata/sf0.001"


def test_members_are_plain_gzip_and_split_reads_agree(monkeypatch):
    payload = "é".encode() * 3000
    digest = hashlib.sha1(payload).hexdigest()
    raw = [warc.record(1, "http://a/", payload, digest), warc.record(2, "http://b/", payload, digest, 1, "http://a/"),
           warc.record(3, "http://c/\r\nX: y", b"", hashlib.sha1(b"").hexdigest())]
    whole = b"".join(raw)
    assert gzip.decompress(whole).startswith(b"WARC/1.1\r\nWARC-Type: response")
    for chunk in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        got = [warc.parse(m) for m in warc._members(io.BytesIO(whole))]
        assert [g["payload"] for g in got] == [payload, None, b""]
        assert [g["payload_bytes"] for g in got] == [6000, 6000, 0]
        assert got[1]["fields"]["warc-refers-to"] == "<urn:x-dimstack-page:1>"
        assert got[2]["fields"]["warc-target-uri"] == "http://c/ X: y"


def test_damage_is_found():
    payload = b"x" * 2000
    member = gzip.decompress(warc.record(1, "u", payload, hashlib.sha1(payload).hexdigest()))
    for bad in (member[:-1], member.replace(b"xxxx", b"xxyx"), member[5:], member + b"z"):
        with pytest.raises(warc.WarcError):
            warc.parse(bad)
    cut = warc.record(1, "u", payload, hashlib.sha1(payload).hexdigest())[:-9]
    with pytest.raises(warc.WarcError):
        list(warc._members(io.BytesIO(cut)))


def expected(rows):
    out, last = [], {}
    for i, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            last[h] = max(last.get(h, i), i)
    for i, h in rows:
        raw = (h or "").encode()
        refers = last.get(h, i) if i is not None and len(raw) >= 1000 else i
        # a page without an id revisits the largest page with its payload
        if i is None and len(raw) >= 1000:
            n = sum(1 for j, g in rows if g == h and j is not None)
            refers = last[h] if n > 1 else None
        kind = "revisit" if refers != i else "response"
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), kind, refers if kind == "revisit" else None))
    return sorted(map(str, out))


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    big = "ä" * 600
    rows = [(1, big), (2, big), (3, "short"), (4, "short"), (5, None), (6, ""), (7, big + "1"), (7, big + "1"),
            (8, "z" * 1000), (9, "z" * 1000), (10, "z" * 999), (11, "z" * 999), (None, "q" * 10)]
    pages = spark.createDataFrame([(i, "http://h/" if i else None, h, "x") for i, h in rows],
                                  "page_id long, url string, html string, digest string")
    got = warc.archive_pages(spark, pages.repartition(3)).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == expected(rows)
    by = {(r.page_id, r.record_type): r.payload for r in got}
    assert by[2, "response"].decode() == big and by[1, "revisit"] is None
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


def test_hot_payload(spark):
    rows = [(i, "hot " * 500) for i in range(300)] + [(1000 + i, f"{i // 2} " * 600) for i in range(100)]
    pages = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string")
    got = warc.archive_pages(spark, pages.repartition(4)).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == expected(rows)


def test_query(spark):
    got = queries.op2_warc(spark, SF).collect()
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert sorted(str(tuple(r)) for r in got) == expected([(r.page_id, r.html) for r in pages])
