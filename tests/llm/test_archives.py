import base64
import gzip
import hashlib
import random

import pyarrow as pa
import pytest

from growthlab.llm import archives
from growthlab.llm.queries import op12_warc_records

V1, V2 = archives.FIELDS[1], archives.FIELDS[2]


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def opening(version, name="x.arc", date="19970102030405", origin="Somewhere"):
    about = f"{version} 0 {origin}\n{archives.FIELDS[version]}\n".encode()
    middle = "text/plain" if version == 1 else f"text/plain 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {date} {middle} {len(about)}\n".encode() + about + b"\n"


def one(block, url="http://a/", date="19970102030406", mime="text/html", more="", ip="1.2.3.4"):
    return f"{url} {ip} {date} {mime} {more}{len(block)}\n".encode() + block + b"\n"


def http(payload, *lines):
    return "\r\n".join(["HTTP/1.0 200 OK", *lines]).encode() + b"\r\n\r\n" + payload


def parsed(data):
    return list(archives.read_arc(pa.py_buffer(data)))


def test_versions_name_their_fields():
    a, b = parsed(opening(1) + one(b"HTTP/1.0 200 OK\n\nhi"))
    assert a.more == {"version": "1", "origin": "Somewhere"} and (b.url, b.ip, b.mime, b.payload_at()) == ("http://a/", "1.2.3.4", "text/html", 17)
    line = one(b"dns", url="dns:a", mime="text/dns", more="200 cafe - 77 x.arc ")
    _, b = parsed(opening(2) + line)
    assert b.more == {"Result-code": "200", "Checksum": "cafe", "Location": "-", "Offset": "77", "Filename": "x.arc"}
    assert not b.is_http and b.payload_at() == 0 and b.block == b"dns" and not b.cut


def test_lengths_not_separators_find_records():
    tricky = http(b"\nhttp://b/ 1.1.1.1 19990101000000 text/html 3\nabc\n\r\n\r\nWARC/1.0\r\n\r\n" + bytes(range(256)))
    got = parsed(opening(1) + one(tricky) + one(b"", url="ftp://b/with space", mime="text/html; charset=utf-8"))
    assert [x.block for x in got[1:]] == [tricky, b""]
    assert (got[2].url, got[2].mime) == ("ftp://b/with space", "text/html; charset=utf-8")


def test_broken_archives_keep_what_is_there():
    good = opening(1) + one(b"first") + b"no record line\n\n" + one(b"second")
    got = parsed(good + one(b"third")[:-4])
    assert [(x.block, x.skipped, x.cut) for x in got[1:]] == [(b"first", 0, False), (b"second", 15, False), (b"th", 0, True)]
    packed = gzip.compress(opening(1)) + gzip.compress(one(b"first" * 9)) + gzip.compress(random.Random(1).randbytes(9000))
    got = parsed(packed[:-4000])
    assert [x.block for x in got[1:2]] == [b"first" * 9]
    assert parsed(b"") == [] and parsed(b"\n\n") == [] and parsed(b"\x00" * 3_000_000) == []


def test_times():
    assert archives.iso_time("19970102030405") == "1997-01-02T03:04:05Z"
    assert archives.iso_time("199701020304") == "1997-01-02T03:04:00Z" and archives.iso_time("1997") == "1997-01-01T00:00:00Z"
    assert archives.iso_time("19971399000000") == "1970-01-01T00:00:00Z"


def test_conversion_round_trip(spark, tmp_path):
    odd = bytes(range(256)) * 40
    (tmp_path / "in").mkdir()
    first = [one(http(odd, "X-Rank: 7"), date="2001"), one(http(b"", "X-Rank: 8")), one(b"v=1", url="dns:a", mime="text/dns", ip="0.0.0.0")]
    (tmp_path / "in/a.arc").write_bytes(opening(1) + b"".join(first) + one(b"cut off")[:-5])
    more = "200 - - 0 b.arc "
    second = [one(http(odd, "x-rank: 3", "Y: é"), url="http://b/", more=more), one(http(odd, "Y: z"), url="http://c/", more=more), one(b"v=1", url="dns:b", mime="no-type", more=more)]
    (tmp_path / "in/b.arc.gz").write_bytes(b"".join(map(gzip.compress, [opening(2), *second])))
    (tmp_path / "in/empty.arc").write_bytes(b"")
    archives.convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", rank_head="X-Rank")
    got = archives.read_warc(spark, f"{tmp_path}/out").collect()
    assert sorted(r.type for r in got) == ["resource"] * 2 + ["response"] * 2 + ["revisit"] * 3 + ["warcinfo"] * 2
    by = {(r.target_uri, r.http.get("x-rank")): r for r in got if r.type != "warcinfo"}
    kept = by["http://b/", "3"]
    assert kept.payload == odd and kept.payload_digest == kept.declared_digest == sha(odd) and kept.date == "1997-01-02T03:04:06Z"
    for key in (("http://a/", "7"), ("http://c/", None)):
        assert (by[key].type, by[key].refers_to, by[key].payload_bytes, by[key].declared_digest) == ("revisit", kept.record_id, 0, sha(odd))
    assert by["http://a/", "7"].date == "2001-01-01T00:00:00Z"
    assert by["dns:a", None].type == "resource" and by["dns:b", None].refers_to == by["dns:a", None].record_id
    cut = by["http://a/", None]
    assert cut.payload == b"cut" and cut.type == "resource"
    assert len({r.record_id for r in got}) == len(got)
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "out").glob("*.gz"))
    assert raw.count(b"WARC-Truncated: unspecified") == 1 and raw.count(b"WARC-IP-Address: 1.2.3.4") == 6
    archives.convert(spark, f"{tmp_path}/in", f"{tmp_path}/long", rank_head="X-Rank", min_bytes=4, compression="none")
    assert sorted(r.type for r in archives.read_warc(spark, f"{tmp_path}/long").collect()).count("revisit") == 2


@pytest.mark.parametrize("parts", [1, 5])
def test_pages_with_nulls_copies_and_long_payloads(spark, tmp_path, parts):
    long = "ab é\r\n\r\n" * 300_000
    pages = [(3, "http://x/ y\n", "same"), (1, None, "same"), (None, "", "same"), (2, "u", None), (9, "u", ""), (4, "u", long), (5, "u", long), (4, "u", long), (-7, "q", "one")]
    frame = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, payload string").repartition(parts)
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in op12_warc_records(spark, str(tmp_path)).collect()]
    want = []
    for i, _, html in pages:
        data = (html or "").encode()
        least = min(p for p, _, x in pages if p is not None and (x or "") == (html or ""))
        kind = ("response", None) if i == least and (i, "response") not in {(w[0], w[3]) for w in want} else ("revisit", least)
        want.append((i, len(data), sha(data), *kind))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert op12_warc_records(spark, str(tmp_path)).collect() == []
