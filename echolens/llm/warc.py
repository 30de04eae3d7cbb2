"""WARC archives compressed record by record with a Zstandard dictionary of their own.

An archive starts with a skippable frame that holds its dictionary (itself compressed), trained on the archive's
first records; every record follows as a frame of its own, so that one can be read alone by its offset.  Of records
with equal payloads of at least ``LEAST`` bytes the one with the largest page id is a response with the payload; the
others are revisits that name it and hold the HTTP head alone.

Spark writes the archives: a task turns its rows into archives of about ``ARCHIVE`` compressed bytes, one row each,
and the text writer puts every row into a file of its own, on any store Spark can write, with its commit protocol for
lost or repeated tasks.  The writer ends each file with a line feed; the archive's last frame is a skippable one whose
only byte that is, so the file stays a valid sequence of frames.  Reading back walks the frames of each file, checks
every payload against its digest, and returns one row per record.

The pages are stored once with their digests, so that row numbers and choices hold when tasks are run again.  Groups
of copies are found on the digests alone (a combinable maximum), and only groups of two or more meet the pages in a
join, which Spark can split where a group is large.

Defined results: a null payload is empty; null ids and addresses have no header and are read back as null; a null id
counts as smallest; of repeated rows that would all be the response one is, by row number, and the others revisit it;
payloads below ``LEAST`` bytes are all responses; control characters and spaces in addresses are percent-encoded; too
few or too uniform records for training give an archive without a dictionary; an empty table gives no archive and an
empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import scratch_path, table

LEAST = 1000            # bytes of the smallest payload that is written only once
ARCHIVE = 64 << 20      # compressed bytes at which an archive is closed
SAMPLE = 2 << 20        # bytes of an archive's first records that its dictionary is trained on
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the formats.
DICTIONARY, SKIPPED, SKIPPABLE = 0x184D2A5D, 0x184D2A50, range(0x184D2A50, 0x184D2A60)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("archive string, offset long, length long, record_id string, uri string, page_id long, payload_bytes long, "
           "payload_digest string, record_type string, refers_to long")


def _address(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_id(page_id: int | None, digest: str, uid: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest} {uid}').urn}>"


def record(head: dict, block: bytes) -> bytes:
    """A WARC record; headers without a value are left out."""
    lines = [f"{k}: {v}" for k, v in (head | {"Content-Length": len(block)}).items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def page_record(uid: int, page_id: int | None, url: str | None, digest: str, payload: bytes, date: str,
                lead: tuple | None) -> bytes:
    """Response, or revisit if ``lead`` = (uid, page id, url) of the response is given."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    head = {
        "WARC-Type": "revisit" if lead else "response", "WARC-Record-ID": record_id(page_id, digest, uid), "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _address(url),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type": "application/http;msgtype=response", "WARC-Page-ID": page_id,
    }
    if lead:
        lead_uid, lead_id, lead_url = lead
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(lead_id, digest, lead_uid), "WARC-Refers-To-Date": date,
                 "WARC-Refers-To-Target-URI": None if lead_url is None else _address(lead_url), "WARC-Refers-To-Page-ID": lead_id}
    return record(head, http if lead else http + payload)


def skippable(magic: int, content: bytes, size: int | None = None) -> bytes:
    return magic.to_bytes(4, "little") + (len(content) if size is None else size).to_bytes(4, "little") + content


def dictionary(records: list[bytes]):
    """A dictionary of at most a thirty-second of the records' size, or None where there is too little to learn."""
    import zstandard
    try:
        return zstandard.train_dictionary(max(1024, min(64 << 10, sum(map(len, records)) // 32)), records, level=3)
    except zstandard.ZstdError:
        return None


class Archive:
    """Frames of one archive; the dictionary is trained once ``SAMPLE`` bytes of records are there."""

    def __init__(self, level: int):
        self.level, self.first, self.held, self.frames, self.size, self.compress = level, [], 0, [], 0, None

    def add(self, rec: bytes) -> None:
        if self.compress:
            self._put(self.compress(rec))
            return
        self.first.append(rec)
        self.held += len(rec)
        if self.held >= SAMPLE:
            self._train()

    def _put(self, frame: bytes) -> None:
        self.frames.append(frame)
        self.size += len(frame)

    def _train(self) -> None:
        import zstandard
        d = dictionary(self.first)
        if d:
            self._put(skippable(DICTIONARY, zstandard.compress(d.as_bytes(), 19)))
        self.compress = zstandard.ZstdCompressor(self.level, dict_data=d, write_checksum=True).compress
        for rec in self.first:
            self._put(self.compress(rec))
        self.first = []

    def content(self) -> bytes:
        """The archive but for the line feed that the writer adds."""
        if self.first:
            self._train()
        return b"".join(self.frames) + skippable(SKIPPED, b"", 1)


def stored(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """uid, page_id, url, payload, n, digest of every row, written once."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    p = pages.select(F.monotonically_increasing_id().alias("uid"), F.col(key).cast("long").alias("page_id"),
                     F.col(url).cast("string").alias("url"), body.alias("payload"))
    p = p.withColumn("n", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    path = scratch_path(pages.sparkSession, f"pages/{uuid.uuid4().hex}")
    p.write.option("compression", "zstd").parquet(path)
    return pages.sparkSession.read.schema(p.schema).parquet(path)


def write_archives(pages: DataFrame, out: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   least: int = LEAST, archive: int = ARCHIVE, date: str = DATE, level: int = 3) -> None:
    """Write every row of ``pages`` as one record into archives under the folder ``out``."""
    rows = stored(pages, key, url, payload)
    leads = (rows.filter(F.col("n") >= least).groupBy("digest", "n")
             .agg(F.max(F.struct("page_id", "uid", "url")).alias("lead"), F.count(F.lit(1)).alias("copies"))
             .filter("copies > 1").select("digest", "n", "lead"))
    revisits = F.col("lead").isNotNull() & (F.col("lead.uid") != F.col("uid"))
    dealt = rows.join(leads, ["digest", "n"], "left").select(
        "uid", F.col("page_id").cast("string"), "url", "digest", "payload", revisits.alias("again"),
        F.col("lead.uid").alias("lead_uid"), F.col("lead.page_id").cast("string").alias("lead_id"), F.col("lead.url").alias("lead_url"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for b in batches:
            for uid, page_id, url, digest, body, again, *lead in zip(*(b[c] for c in b.columns)):
                now = now or Archive(level)
                where = (int(lead[0]), _number(lead[1]), _text(lead[2])) if again else None
                now.add(page_record(int(uid), _number(page_id), _text(url), digest, body, date, where))
                if now.size >= archive:
                    yield pd.DataFrame({"content": [now.content()]})
                    now = None
        if now:
            yield pd.DataFrame({"content": [now.content()]})

    made = dealt.mapInPandas(run, "content binary").select(F.col("content").cast("string").alias("value"))
    made.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").option("compression", "none").text(out)


def _number(x) -> int | None:
    return None if x is None or pd.isna(x) else int(x)


def _text(x) -> str | None:
    return None if x is None or pd.isna(x) else x


def frames(content) -> Iterator[tuple[int, int, bool]]:
    """(offset, end, is data) of the Zstandard frames of a file, found by their block lengths."""
    import zstandard
    at = 0
    while at < len(content):
        magic, size = (int.from_bytes(content[at + i:at + i + 4], "little") for i in (0, 4))
        if magic in SKIPPABLE:
            yield at, at + 8 + size, False
            at += 8 + size
            continue
        head = bytes(content[at:at + 18])
        end = at + zstandard.frame_header_size(head)
        last = 0
        while not last:
            block = int.from_bytes(content[end:end + 3], "little")
            last = block & 1
            end += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        end += 4 * zstandard.get_frame_parameters(head).has_checksum
        yield at, end, True
        at = end


def records(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of every record of an archive."""
    import zstandard
    view, reader = memoryview(content), zstandard.ZstdDecompressor()
    for at, end, data in frames(view):
        if data:
            yield at, end - at, reader.decompressobj().decompress(bytes(view[at:end]))
        elif at == 0 and int.from_bytes(view[:4], "little") == DICTIONARY:
            d = bytes(view[8:end])
            if d[:4] == zstandard.FRAME_HEADER:
                d = reader.decompressobj().decompress(d)
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d))


def parsed(rec: bytes) -> tuple[dict, bytes]:
    """Headers (names in lower case) and block of a record."""
    head, _, rest = rec.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]}")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} has another length than {n}")
    return fields, rest[:n]


def page_of(rec: bytes) -> tuple:
    """(record id, uri, page id, payload bytes, payload digest, type, page referred to); raises where they disagree."""
    head, block = parsed(rec)
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = head["warc-type"]
    if kind == "response" and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {head['warc-record-id']} does not hold the payload that it names")
    page, other = (None if head.get(k) is None else int(head[k]) for k in ("warc-page-id", "warc-refers-to-page-id"))
    return head["warc-record-id"], head.get("warc-target-uri"), page, n, digest, kind, other


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``."""
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                rows = [(name, at, n, *page_of(rec)) for at, n, rec in records(content)]
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").load(path).filter("length > 1")
    return files.select("path", "content").mapInPandas(run, RECORDS)


def query(spark, sf_dir):
    out = scratch_path(spark, f"warc/{uuid.uuid4().hex}")
    write_archives(table(spark, sf_dir, "pages"), out)
    return read_archives(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p),
l AS (SELECT payload_digest, max(page_id) AS lead FROM d WHERE payload_bytes >= {LEAST} GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN lead <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN lead <> page_id THEN lead END AS refers_to
FROM d LEFT JOIN l USING (payload_digest)
"""
