"""WARC archives: round trip, choice of responses against brute force, awkward rows, stock decompression."""

import glob
import hashlib
import io
import random

import pytest
import zstandard

from echolens.llm import warc

PAGES = "page_id long, url string, html string, digest string, n long, uid long, lead string"
BIG = "<p>" + "long page é " * 300_000


def table():
    r = random.Random(3)
    bodies = [f"<html>{' '.join(r.choices(['a', 'bc', 'déf', 'gh<i>'], k=600))}</html>" for _ in range(12)]
    rows = [(i, f"http://h{i % 3}.org/{i}", r.choice(bodies)) for i in range(150)]
    rows += [(i, f"http://one.org/{i}", "x" * 999 if i % 2 else "y" * 1000) for i in range(200, 240)]
    rows += [(500, "u", None), (501, None, ""), (None, "no\r\nid", bodies[0]), (None, "x y", "é" * 500), (502, "big", BIG), (503, "big", BIG)]
    rows += [(600, "same", "repeated row " * 99)] * 4 + [(None, None, "only null ids " * 99)] * 3 + [(601, "z", "\r\n\r\nWARC/1.1\r\n" * 80)]
    return rows


def brute(rows):
    group, out = {}, []
    for i, (p, _, h) in enumerate(rows):
        b = (h or "").encode()
        if len(b) >= warc.LEAST:
            group.setdefault(b, []).append((-1 if p is None else p, i))
    lead = {i: max(g) for g in group.values() for _, i in g}
    for i, (p, u, h) in enumerate(rows):
        b = (h or "").encode()
        at = lead.get(i, (0, i))
        kind = "response" if at[1] == i else "revisit"
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), kind, rows[at[1]][0] if kind == "revisit" else None))
    return sorted(out, key=str)


def write(spark, tmp_path, rows, parts=4, **settings):
    out = str(tmp_path / "warc")
    df = spark.createDataFrame([(*r, "d", 1, 2, "l") for r in rows], PAGES).repartition(parts)
    warc.write_archives(df, out, **settings)
    return out


def chosen(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("settings", [{}, {"archive": 3000}])
def test_round_trip(spark, tmp_path, settings):
    out = write(spark, tmp_path, table(), **settings)
    got = warc.read_archives(spark, out)
    assert got.columns == [c.split()[0] for c in warc.RECORDS.split(", ")]
    assert chosen(got) == brute(table())
    assert got.select("record_id").distinct().count() == len(table())
    for f in glob.glob(out + "/part-*"):        # any reader of concatenated frames gets the same records
        content = open(f, "rb").read()
        at, end, data = next(warc.frames(content))
        d = None
        if not data and int.from_bytes(content[:4], "little") == warc.DICTIONARY:
            d = zstandard.ZstdCompressionDict(zstandard.decompress(content[8:end]))
        whole = zstandard.ZstdDecompressor(dict_data=d).stream_reader(io.BytesIO(content), read_across_frames=True).read()
        assert whole == b"".join(r for _, _, r in warc.records(content))


def test_payloads_come_back(spark, tmp_path):
    out = write(spark, tmp_path, table(), parts=1)
    back = {}
    for f in glob.glob(out + "/part-*"):
        for _, _, rec in warc.records(open(f, "rb").read()):
            head, block = warc.parsed(rec)
            if head["warc-type"] == "response":
                back[head["warc-record-id"]] = block.partition(b"\r\n\r\n")[2]
            else:
                assert block.endswith(b"\r\n\r\n") and head["warc-refers-to"] != head["warc-record-id"]
    want = {(h or "").encode() for _, _, h in table()}
    assert set(back.values()) == want
    for f in glob.glob(out + "/part-*"):
        for _, _, rec in warc.records(open(f, "rb").read()):
            head, _ = warc.parsed(rec)
            assert head.get("warc-refers-to", head["warc-record-id"]) in back


def test_dictionary_shortens_archives(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").coalesce(1)
    warc.write_archives(pages, str(tmp_path / "w"))
    files = [open(f, "rb").read() for f in glob.glob(str(tmp_path / "w/part-*"))]
    assert any(int.from_bytes(c[:4], "little") == warc.DICTIONARY for c in files)
    plain = sum(len(zstandard.compress(r)) for c in files for _, _, r in warc.records(c))
    assert sum(map(len, files)) < plain


def test_damage_is_noticed(spark, tmp_path):
    rec = warc.page_record(1, 7, "u", hashlib.sha1(b"abc").hexdigest(), b"abc", warc.DATE, None)
    assert warc.page_of(rec)[2:] == (7, 3, hashlib.sha1(b"abc").hexdigest(), "response", None)
    with pytest.raises(ValueError):
        warc.page_of(rec.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        warc.page_of(rec + b"x")


def test_empty(spark, tmp_path):
    assert warc.read_archives(spark, write(spark, tmp_path, [])).collect() == []
