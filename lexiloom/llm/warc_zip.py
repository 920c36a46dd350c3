"""WARC records in ZIP-packaged archives, read by ranges without extraction.

Each writing task streams gzip-compressed records into one stored member of a
ZIP file and adds an index member with offset and length of every record. The
reader fetches the end of the file, parses the central directory (ZIP64
included), finds the index and the record member, and then reads blocks of
consecutive records by their byte ranges.

Archives go below the shared folder, through the file system its URI names.
File names are new for every attempt, and only the names that finished tasks
report are read, so a lost executor leaves no wrong record behind.

Cases: null html is an empty payload; a null id is never the record that others
refer to; rows that repeat the largest id of a payload are all responses; a null
url gives no target; no pages give no archives and no rows. Archives of other
writers may hold several WARC members and indexes, packed or plain; records that
are neither response nor revisit are passed over, and an id that is no page's is
null.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.sources.scratch import scratch_path

# Fixed values of the formats.
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"

#: Payloads below this size are always written whole.
MIN_SHARED = 1000
#: A task starts a new archive beyond this many bytes or records, which bounds its index.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 256 << 20, 100_000
#: Bytes of one range read, but for a single longer record.
BLOCK = 4 << 20
#: The end record and the longest comment.
TAIL = 22 + 0xFFFF


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def record(page_id, url: str | None, payload: bytes | None, size: int, digest: str, refers_to) -> bytes:
    """One WARC record; without a payload it is a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{b32}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields and HTTP fields (names in lower case) and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")

    def fields(lines: bytes) -> dict[str, str]:
        pairs = (line.split(":", 1) for line in lines.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
        return {k.strip().lower(): v.strip() for k, v in pairs}

    warc = fields(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, fields(http), payload


class _Archive:
    """A ZIP file being written: records now, their index at the end."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, path = _open(self.uri)
        self.out = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines, self.size = [], 0

    def add(self, page_id, url: str | None, data: bytes) -> None:
        packed = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = packed.compress(data) + packed.flush()
        self.member.write(data)
        entry = {"url": url, "offset": str(self.size), "length": str(len(data)), "filename": DATA}
        self.lines.append(f"page:{page_id} 19700101000000 {json.dumps(entry)}\n")
        self.size += len(data)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.lines))
        self.zip.close()
        self.out.close()


def write(records: DataFrame, folder: str) -> DataFrame:
    """Write archives of (page_id, url, payload, size, digest, refers_to); their (uri, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                archive = archive or _Archive(folder)
                archive.add(row["page_id"], row["url"], record(**row))
                if archive.size >= ARCHIVE_BYTES or len(archive.lines) >= ARCHIVE_RECORDS:
                    archive.close()
                    done.append(archive)
                    archive = None
        if archive:
            archive.close()
            done.append(archive)
        yield pa.RecordBatch.from_pydict(
            {"uri": pa.array([a.uri for a in done], pa.string()), "records": pa.array([len(a.lines) for a in done], pa.int64())}
        )

    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    wanted = records.select("page_id", "url", "payload", "size", "digest", "refers_to")
    wanted.mapInArrow(run, "uri string, records bigint").write.parquet(f"{folder}/written")
    return records.sparkSession.read.parquet(f"{folder}/written")


def directory(file: pa.NativeFile, size: int) -> dict[str, tuple[int, int]]:
    """Data offset and size of every stored member, from the central directory; compressed ones are left out."""
    start = max(0, size - TAIL)
    tail = file.read_at(size - start, start)
    end = tail.rfind(END)
    while end >= 0 and (len(tail) < end + 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(END, 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, offset = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or 0xFFFFFFFF in (length, offset):
        locator = file.read_at(20, start + end - 20)
        if locator[:4] != LOCATOR:
            raise ValueError("no ZIP64 locator")
        end64 = file.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, offset = struct.unpack_from("<QQQ", end64, 32)
    listed, at, members = file.read_at(length, offset), 0, {}
    for _ in range(count):
        if listed[at : at + 4] != ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", listed, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", listed, at + 20)
        header = struct.unpack_from("<I", listed, at + 42)[0]
        name = listed[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = listed[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, k)
            if tag == 1:  # ZIP64: only the values that did not fit, in this order
                values = iter(struct.unpack_from(f"<{min(n // 8, 3)}Q", extra, k + 4))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                header = next(values) if header == 0xFFFFFFFF else header
            k += 4 + n
        at += 46 + n_name + n_extra + n_comment
        if name.endswith("/"):
            continue
        if method == 0 and not flags & 1 and packed == plain:
            local = file.read_at(30, header)
            if local[:4] != LOCAL:
                raise ValueError(f"no local header of {name}")
            members[name] = (header + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
    return members


_BLOCKS = "uri string, start bigint, lengths array<bigint>"


def listed(file: pa.NativeFile, members: dict[str, tuple[int, int]]) -> list[tuple[int, int]]:
    """Offset in the file and length of every record that the indexes of an archive name, in order.

    An index is a stored member ``*.cdx`` or ``*.cdxj``; a line names its WARC member by path or base
    name, or not at all where there is only one.
    """
    indexes = [m for m in members if m.lower().endswith((".cdx", ".cdxj"))]
    warcs = {m: at for m, (at, _) in members.items() if m.lower().endswith((".warc", ".warc.gz"))}
    if not indexes or not warcs:
        raise ValueError(f"no stored index or no stored WARC member among {sorted(members)[:9]}")
    by_base = {m.rsplit("/", 1)[-1]: at for m, at in warcs.items()}
    out = set()
    for index in indexes:
        at, size = members[index]
        for line in file.read_at(size, at).decode("utf-8", "replace").splitlines():
            brace = line.find("{")
            if brace < 0:
                continue  # the heading of an index
            place = json.loads(line[brace:])
            name = place.get("filename")
            start = warcs.get(name, by_base.get((name or "").rsplit("/", 1)[-1]))
            if start is None:
                if name or len(warcs) > 1:
                    raise ValueError(f"index {index} names the member {name!r}, which is not stored")
                start = next(iter(warcs.values()))
            out.add((start + int(place["offset"]), int(place["length"])))
    return sorted(out)


def blocks(archives: DataFrame, uri_col: str = "uri") -> DataFrame:
    """Runs of consecutive records of about ``BLOCK`` bytes, from the indexes in the archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _open(uri)
                with system.open_input_file(path) as file:
                    places = listed(file, directory(file, file.size()))
                rows, at, size, lengths = [], 0, 0, []
                for start, length in places:
                    if lengths and (size + length > BLOCK or at + size != start):
                        rows.append((uri, at, lengths))
                        size, lengths = 0, []
                    if not lengths:
                        at = start
                    size += length
                    lengths.append(length)
                if lengths:
                    rows.append((uri, at, lengths))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.list_(pa.int64())))],
                    names=["uri", "start", "lengths"],
                )

    return archives.select(uri_col).mapInArrow(run, _BLOCKS)


_READ = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read(archives: DataFrame, uri_col: str = "uri", with_payload: bool = True) -> DataFrame:
    """Records of the archives; digests of responses are checked against their payloads."""

    def number(urn: str | None):
        digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if re.fullmatch("-?[0-9]+", digits) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _open(row["uri"])
                with system.open_input_file(path) as file:
                    data = file.read_at(sum(row["lengths"]), row["start"])
                out, at = [], 0
                for length in row["lengths"]:
                    raw = data[at : at + length]
                    warc, http, payload = parse(zlib.decompress(raw, 31) if raw[:2] == b"\x1f\x8b" else raw)
                    at += length
                    kind = warc["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    stated = warc.get("warc-payload-digest", "").removeprefix("sha1:")
                    digest = base64.b32decode(stated).hex() if stated else hashlib.sha1(payload).hexdigest()
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"damaged record {warc['warc-record-id']} in {row['uri']}")
                    out.append(
                        {
                            "page_id": number(warc["warc-record-id"]),
                            "url": warc.get("warc-target-uri"),
                            "payload": payload if with_payload else None,
                            "payload_bytes": int(http.get("content-length", len(payload))),
                            "payload_digest": digest,
                            "record_type": kind,
                            "refers_to": number(warc.get("warc-refers-to")),
                        }
                    )
                schema = pa.schema(
                    [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
                )
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    # A stated number: blocks are tiny rows that stand for much reading, and must not be merged into few tasks.
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks(archives, uri_col).repartition(tasks, "uri", "start").mapInArrow(run, _READ)


def planned(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Input of ``write``: equal payloads of some size become revisits of the one with the largest id.

    Only digests that occur twice meet the pages again; a payload shared by very
    many pages is split by the engine's handling of skewed joins.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")
    )
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    shared = (
        rows.filter(F.col("size") >= MIN_SHARED)
        .groupBy("digest")
        .agg(F.count("*").alias("copies"), F.max("page_id").alias("last"))
        .filter("copies > 1")
        .select("digest", "last")
    )
    revisit = F.col("last") != F.coalesce(F.col("page_id"), F.col("last") - 1)
    met = rows.join(shared, "digest", "left")
    return met.withColumn("refers_to", F.when(revisit, F.col("last"))).withColumn(
        "payload", F.when(F.col("refers_to").isNull(), F.col("payload"))
    )


def archive(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder; the list of archives."""
    return write(planned(pages), scratch_path(spark, "warc"))
