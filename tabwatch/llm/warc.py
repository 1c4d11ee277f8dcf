"""WARC archives, written and read index first.

Writing gives an index row per record (file, offset, length, URL, digest). Reading starts from
index rows: those selected are sorted by file and offset, near ranges are read together, and
each record is cut out of its range, decompressed and parsed. A record is its own gzip member.

File names are new for every task attempt; the stored index names only files of attempts that
ended well. Equal payloads are found by digest: all but one become revisit records."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.common import shared_dir, stored, text_or_empty

MIN_REVISIT = 100     # bytes; smaller payloads are always stored
GAP = 64 << 10        # ranges nearer than this are read together
MAX_RANGE = 8 << 20   # bytes of one read, unless a record alone is larger
BLOCK = 32 << 20      # bytes of a file that one reading group covers
OUT_BYTES = 4 << 20

# Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the pages table has no capture time

INDEX = "file string, offset long, length long, url string, page_id long, digest string, record_type string"
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload binary, "
           "payload_bytes long, payload_digest string")


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool) -> bytes:
    """A whole WARC record. A revisit has the HTTP header, whose Content-Length is that of the
    full payload, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v for k, _, v in
            (line.partition(": ") for line in head.decode("utf-8").split("\r\n")[1:])}


def parse(data: bytes) -> dict:
    """A record's fields; raises if it is cut short or its payload lacks the stated digest."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    f = _fields(head)
    n = int(f["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda x: int(x[10:-1]) if x and x != "<urn:page:>" else None
    digest, size = f["warc-payload-digest"].removeprefix("sha256:"), int(_fields(http)["content-length"])
    revisit = f["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("a payload differs from its digest")
    return {"page_id": number(f["warc-record-id"]), "url": f.get("warc-target-uri"),
            "record_type": f["warc-type"], "refers_to": number(f.get("warc-refers-to")),
            "payload": None if revisit else payload, "payload_bytes": size, "payload_digest": digest}


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filesystem, top = _filesystem(folder)
        name = f"{top}/pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                filesystem.create_dir(top, recursive=True)
                out = filesystem.open_output_stream(name, compression=None)
            offsets, lengths = [], []
            ids, urls, texts, digests, refers, revisits = (b.column(k).to_pylist() for k in range(6))
            for i, u, t, d, r, v in zip(ids, urls, texts, digests, refers, revisits):
                data = _gzip(record(i, u, t.encode("utf-8"), d, r, v))
                out.write(data)
                offsets.append(at)
                lengths.append(len(data))
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * b.num_rows), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()),
                 b.column(1), b.column(0), b.column(3),
                 pa.array(["revisit" if v else "response" for v in revisits])],
                ["file", "offset", "length", "url", "page_id", "digest", "record_type"])
        if out is not None:
            out.close()
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write a record per page and return the stored index.

    Of equal payloads of at least MIN_REVISIT bytes the row with the smallest id is stored (all
    rows of that id are); the others revisit it. Null html: empty. A null id is larger than any
    id; if a payload has only null ids, all its rows are stored. Null url: no target. Empty
    table: no archive, an empty index."""
    html = text_or_empty(html_col)
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                     html.alias("html"), F.sha2(html, 256).alias("digest"))
    big = F.octet_length("html") >= MIN_REVISIT
    first = pages.select(F.col(id_col).cast("long").alias("page_id"), html.alias("html")).where(big) \
        .groupBy(F.sha2("html", 256).alias("same")).agg(F.min("page_id").alias("refers_to"),
                                                        F.count(F.lit(1)).alias("n")) \
        .where("n > 1 AND refers_to IS NOT NULL").drop("n")
    j = p.join(first, (F.col("digest") == F.col("same")) & big, "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    rows = j.select("page_id", "url", "html", "digest", "refers_to", revisit.alias("revisit"))
    return stored(rows.mapInArrow(_write(f"{folder}/archives"), INDEX), f"{folder}/index")


def _emit(rows: list[dict]) -> pa.RecordBatch:
    types = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
             ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in types],
                                      [n for n, _ in types])


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(folder)
        source, name = None, None
        group: list[tuple[str, int, int]] = []

        def load() -> Iterator[pa.RecordBatch]:
            nonlocal source, name
            if group[0][0] != name:
                if source is not None:
                    source.close()
                name = group[0][0]
                source = filesystem.open_input_file(name)
            base = group[0][1]
            data = source.read_at(group[-1][1] + group[-1][2] - base, base)
            rows, size = [], 0
            for _, at, n in group:
                rows.append(parse(zlib.decompress(data[at - base:at - base + n], 31)))
                size += len(rows[-1]["payload"] or b"") + 200
                if size >= OUT_BYTES:
                    yield _emit(rows)
                    rows, size = [], 0
            if rows:
                yield _emit(rows)

        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(3))):
                if group and (row[0] != group[0][0] or row[1] - group[-1][1] - group[-1][2] > GAP
                              or row[1] + row[2] - group[0][1] > MAX_RANGE):
                    yield from load()
                    group = []
                group.append(row)
        if group:
            yield from load()
        if source is not None:
            source.close()
    return run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the index rows name: page_id, url, record_type, refers_to, payload
    (null for a revisit), payload_bytes, payload_digest."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = index.select("file", "offset", "length",
                         F.floor(F.col("offset") / BLOCK).alias("block")) \
        .repartition(n, "file", "block").sortWithinPartitions("file", "offset")
    return parts.select("file", "offset", "length").mapInArrow(_read(folder), RECORDS)


def archive_report(pages: DataFrame, **columns) -> DataFrame:
    """Write archives to a new shared folder, read every record back: page_id, payload_bytes,
    payload_digest, record_type, refers_to. Sizes and digests of stored payloads are computed
    from the payloads read; those of revisits are the ones their records state. One row per page,
    repeated rows, null ids and null or empty html (0 bytes) included; further columns are not read,
    whatever their names. Empty table: no rows."""
    folder = shared_dir(pages.sparkSession)
    r = read_records(write_archives(pages, folder, **columns), folder)
    return r.select("page_id", F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
                    F.coalesce(F.sha2("payload", 256), "payload_digest").alias("payload_digest"),
                    "record_type", "refers_to")
