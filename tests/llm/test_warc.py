import gzip
import hashlib
import io

from pickbay.llm import warc
from pickbay.llm.common import stage_path

BIG, OTHER = "<p>é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 60, "y" * 1000
PAGES = [(1, "http://a/", BIG), (2, "http://b/\r\nX: y", BIG), (9, None, BIG), (4, "u", OTHER), (5, "u", OTHER), (6, "u", "z" * 999),
         (7, "u", "z" * 999), (8, "u", None), (10, "u", ""), (None, "n", BIG), (None, "n", "q" * 2000), (None, "m", "q" * 2000),
         (5, "u", OTHER), (11, "long", "line\n" * 300_000)]


def plain(rows):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        last = max(same, default=None) if len(body) >= 1000 else None
        revisit = last is not None and last != page
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


def test_revisits(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' as digest", "1 as original")
    path = stage_path(spark, "warc-test")
    assert sorted(map(tuple, warc.revisit_table(df, path).collect()), key=str) == plain(PAGES)
    full = warc.read_archives(spark, path).collect()
    payloads = {r.page_id: bytes(r.payload) for r in full if r.record_type == "response" and r.page_id}
    assert payloads[9] == BIG.encode() and payloads[11] == PAGES[-1][2].encode() and payloads[8] == b""
    assert {r.url for r in full if r.page_id == 2} == {"http://b/%0D%0AX: y"}
    assert len({r.record_id for r in full if r.page_id}) == len({p for p, _, _ in PAGES if p})
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.revisit_table(empty, stage_path(spark, "warc-test")).count() == 0


def test_reads_members_and_plain_archives(spark, tmp_path):
    def record(kind, block, **more):
        head = "".join(f"{k}: {v}\r\n" for k, v in {"WARC-Type": kind, "WARC-Record-ID": f"<urn:x:{len(block)}>", **more,
                                                    "Content-Length": len(block)}.items())
        return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"
    records = [record("warcinfo", b"software: x\r\n"), record("response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody", **{"Content-Type": "application/http"})]
    (tmp_path / "part-0.warc").write_bytes(b"".join(records))
    out = io.BytesIO()
    for r in records:
        out.write(gzip.compress(r))
    (tmp_path / "part-1.warc.gz").write_bytes(out.getvalue())
    got = warc.read_archives(spark, f"file://{tmp_path}").collect()
    assert sorted(r.record_type for r in got) == ["response", "response", "warcinfo", "warcinfo"]
    assert [bytes(r.payload) for r in got if r.record_type == "response"] == [b"body"] * 2
