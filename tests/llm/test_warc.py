"""Archives: exact round trip, revisits, the order of the merged index."""

import gzip
import zlib
import hashlib
import random
from pathlib import Path

import pytest

from tidemark.llm import warc

BODY = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>" * 5
PAGES = [
    (5, "http://B.example.com/x?q#f", BODY), (2, "http://b.example.com/x?q", BODY), (9, None, BODY), (3, "no scheme", None),
    (4, "http://a.example.com/\r\nX: y", ""), (6, "http://a.example.com", "short"), (7, "http://a.example.com", "short"),
    (None, "http://c.net/", BODY), (2, "http://b.example.com/x?q", BODY), (8, "http://c.net/", "z" * 3_000_000), (10, "http://c.net/", "\x00" * 120),
]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, id string")


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write(frame(spark), path, records_per_file=3)
    stored = []
    for file in Path(path).glob("*.gz"):
        stored += [(h, b) for _, _, h, b in warc.parse([gzip.decompress(file.read_bytes())])]
    assert len(stored) == len(PAGES)
    ids = lambda name, h: int(h[name][10:-1]) if name in h else None
    for headers, block in stored:
        i = ids("WARC-Record-ID", headers)
        html = (next(p[2] for p in PAGES if p[0] == i) or "").encode()
        payload = block.partition(b"\r\n\r\n")[2]
        assert payload == (html if headers["WARC-Type"] == "response" else b"")
        assert headers["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(html).hexdigest()
    index = warc.read_index(spark, path)
    rows = index.collect()
    assert sorted(str((r.id, r.record_type, r.refers_to, r.payload_bytes)) for r in rows) == sorted(
        str((None if p[0] is None else str(p[0]), "revisit" if again else "response", "2" if again else None, len((p[2] or "").encode())))
        for p in PAGES
        for again in [p[2] == BODY and p[0] != 2]
    )
    keys = [(r.url_key, r.warc_date, r.id or "") for r in rows]
    assert keys == sorted(keys) and {k[0] for k in keys} >= {"com,example,b)/x?q", "com,example,a)/X:y", "", "net,c)/"}
    assert all(warc.round_trip(frame(spark).where("false")).count() == 0 for _ in range(1))


def test_empty_folder_key_types(spark):
    out = warc.round_trip(frame(spark).selectExpr("cast(page_id as string) as page_id", "url", "html"))
    assert dict(out.dtypes)["page_id"] == "string" and out.count() == len(PAGES)


def test_loser_tree():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(((str(rng.randrange(30)), "d", str(i)) for i in range(rng.randrange(40))), key=warc.order) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted((e for r in runs for e in r), key=warc.order)


def test_parsing_piece_by_piece():
    raw = b"".join(f"WARC/1.1\r\nContent-Length: {n}\r\nA: b: c\r\n\r\n{'x' * n}\r\n\r\n".encode() for n in (0, 5, 70))
    whole = list(warc.parse([raw]))
    assert [len(b) for *_, b in whole] == [0, 5, 70] and whole[1][0] == whole[0][1]
    assert list(warc.parse(raw[i : i + 1] for i in range(len(raw)))) == whole


def test_archives_of_many_members(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write(frame(spark), path, records_per_file=100)
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(Path(path).glob("*.gz")))
    records = [raw[at : at + n] for at, n, _, _ in warc.parse([raw])]
    (tmp_path / "members").mkdir()
    (tmp_path / "members" / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)) + b"\0" * 7)
    (tmp_path / "members" / "b.warc.gz").write_bytes(gzip.compress(records[0]) + gzip.compress(b"") + gzip.compress(records[1] + records[2]))
    index = warc.read_index(spark, str(tmp_path / "members")).collect()
    assert len(index) == len(PAGES) + 3
    whole = b"".join(map(gzip.compress, records))
    for size in (1, 100, 1 << 20):
        assert b"".join(warc.unpacked(whole, size)) == raw
    assert b"".join(warc.unpacked(b"")) == b""
    with pytest.raises((ValueError, zlib.error)):
        b"".join(warc.unpacked(whole[:-9]))
