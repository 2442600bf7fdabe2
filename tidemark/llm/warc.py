"""WARC records in ZIP packages: a writer, and a reader that never extracts.

Writing: every task streams its pages into packages (stored members ``archive/data.warc.gz``
with one gzip member per record, and ``indexes/index.cdxj``), in the shared folder under
names of their own.  The manifest lists the packages of the attempts that ended well, so
a lost or repeated task leaves at most a file that nobody reads.

Reading: the end-of-central-directory record, the ZIP64 locator and record where there are
any, and the central directory give the stored members, archives and indexes by their endings;
an index (CDXJ, plain, in gzip or deflated) gives each record's archive, offset and length, and neighbouring
records are fetched by one range read of at most RANGE_BYTES (or one record).  What no index names, whole
archives or parts between records, is read record by record, STEP bytes at a time.  Archives are plain or in
gzip members of one or more records.  An archive that ends inside a record or member, an index that names an
archive or a range that isn't there, and a payload that fails its digest are errors: no record is lost in silence.

Records of other writers are read too: of any type, without a digest or with one in base 32 or by another
algorithm (checked where hashlib has it and the payload is whole and not in transfer coding).  Their page_id is
null, their payload is the block unless that is HTTP, and what a revisit doesn't say is null.

Of records with equal payloads of at least ``least`` bytes, the one with the smallest
page_id is a response and the others revisit it.

Edge cases: a null html is an empty payload; rows that share the smallest page_id of equal
payloads are all responses; a row without page_id revisits the smallest page_id if there
is one, else it is a response; smaller payloads are all responses; an empty table gives
an empty result; very long payloads are a range of their own, and a worker holds one record of them at
a time; of tied page_ids see above; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh_path, join_on_hot_key, sliced, written

#: A package is closed at so many records or payload bytes, so that index and read-out have a bound.
ROLL_RECORDS, ROLL_BYTES = 4096, 256 << 20
RANGE_BYTES = 4 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Endings of the members that are archives and indexes.
ARCHIVES, INDEXES = (".warc.gz", ".warc"), (".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz")
#: Bytes of a member that are read at once where there is no index.
STEP = 1 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
#: Signatures and sizes of the ZIP format (fixed values).
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {quote(url or '', safe='/:?#[]@!$&()*+,;=%')}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    body = HTTP
    if refers_to is None:
        body += payload
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>", f"X-Payload-Length: {len(payload)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode("ascii") + body + b"\r\n\r\n"


def parsed(head: bytes) -> dict[str, str]:
    """Headers (lower-case names) of a record's head."""
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def parts_of(headers: dict[str, str], block: bytes) -> tuple[bytes, bytes]:
    """The HTTP head and the payload of a record's block."""
    if not headers.get("content-type", "").lower().startswith("application/http"):
        return b"", block
    head, _, payload = block.partition(b"\r\n\r\n")
    return head, payload


def digest_fails(headers: dict[str, str], head: bytes, payload: bytes) -> bool:
    """Whether a whole payload contradicts its digest, in hexadecimal or base 32."""
    name, _, value = headers.get("warc-payload-digest", "").partition(":")
    if name.lower() not in hashlib.algorithms_guaranteed or name.lower().startswith("shake") or "warc-truncated" in headers or b"\ntransfer-encoding:" in head.lower():
        return False
    digest = hashlib.new(name.lower(), payload).digest()
    return value.lower() != digest.hex() and value.upper().rstrip("=") != base64.b32encode(digest).decode().rstrip("=")


class Package:
    """One package being written to a stream that needn't seek."""

    def __init__(self, stream) -> None:
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.lines: list[str] = []
        self.at = self.payload = 0

    def add(self, page_id, url, payload: bytes, digest: str, refers_to) -> None:
        raw = gzip.compress(record_bytes(page_id, url, payload, digest, refers_to), 1, mtime=0)
        self.data.write(raw)
        self.lines.append("- 19700101000000 " + json.dumps({"url": url, "filename": ARCHIVE.rpartition("/")[2], "offset": self.at, "length": len(raw), "digest": f"sha256:{digest}", "page": page_id}))
        self.at += len(raw)
        self.payload += len(payload)

    def close(self) -> None:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.lines))
        self.zip.close()


def directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (method, offset of the local header, stored length), from the central directory alone."""
    tail_at = max(0, size - 65_557 - 20)  # the longest comment, and the locator before the record
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    at = tail.rfind(EOCD)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20:at - 16] == LOCATOR64:
        f.seek(struct.unpack_from("<Q", tail, at - 12)[0])
        end = f.read(56)
        if end[:4] != EOCD64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, offset = struct.unpack_from("<QQQ", end, 32)
    f.seek(offset)
    raw, p, members = f.read(length), 0, {}
    for _ in range(count):
        if raw[p:p + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", raw, p + 10)
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", raw, p + 20)
        local, = struct.unpack_from("<I", raw, p + 42)
        name, extra = raw[p + 46:p + 46 + n_name].decode("utf-8"), raw[p + 46 + n_name:p + 46 + n_name + n_extra]
        q = 0
        while q + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, q)
            if tag == 1:  # the fields that don't fit in 32 bits, in this order
                values = iter(struct.unpack_from(f"<{n // 8}Q", extra, q + 4))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                local = next(values) if local == 0xFFFFFFFF else local
            q += 4 + n
        members[name] = (method, local, packed)
        p += 46 + n_name + n_extra + n_note
    return members


def stored_at(f, member: tuple[int, int, int]) -> tuple[int, int]:
    """Offset and length of a stored member's bytes."""
    method, local, length = member
    if method != 0:
        raise ValueError("the member isn't stored")
    f.seek(local)
    head = f.read(30)
    if head[:4] != LOCAL:
        raise ValueError("no local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return local + 30 + n_name + n_extra, length


def _entries(text: str) -> Iterator[dict]:
    """The JSON parts of CDXJ lines; offsets and lengths may be strings."""
    for line in text.split("\n"):
        at = line.find("{")
        if at >= 0:
            e = json.loads(line[at:])
            yield e | {"offset": int(e["offset"]), "length": int(e["length"])}


def _page(record_id: str | None) -> int | None:
    """The page a record was written for; null for records of other writers."""
    named = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(named[1]) if named else None


def uncompressed(f, base: int, size: int) -> Iterator[bytes]:
    """The bytes of an archive or a part of it, plain or in gzip members, STEP of them at a time."""
    f.seek(base)
    at, step, zipped = 0, None, size > 1 and f.read(2) == b"\x1f\x8b"
    while at < size:
        f.seek(base + at)
        raw = f.read(min(STEP, size - at))
        if not raw:
            raise ValueError("the archive is cut off")
        at += len(raw)
        if not zipped:
            yield raw
            continue
        while raw:
            step = step or zlib.decompressobj(31)
            yield step.decompress(raw, STEP)
            raw = step.unused_data if step.eof else step.unconsumed_tail
            step = None if step.eof else step
    while step is not None:  # what the last bytes still hold
        more = step.decompress(b"", STEP)
        if step.eof:
            step = None
        elif not more:
            raise ValueError("the archive is cut off in a gzip member")
        yield more


def records_of(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a stream of bytes, one held at a time."""
    held, done = bytearray(), False

    def more() -> bool:
        nonlocal done
        chunk = next(chunks, None)
        done = chunk is None
        held.extend(chunk or b"")
        return not done

    while True:
        while not held or held[0] in b"\r\n":
            if held:
                del held[:1]
            elif not more():
                return
        looked = 0
        while (end := held.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(held) - 3)
            if not bytes(held[:5]).startswith(b"WARC/"[:len(held)]):
                raise ValueError("not a WARC record")
            if not more():
                raise ValueError("the archive is cut off in a record's head")
        headers = parsed(bytes(held[:end]))
        upto = end + 4 + int(headers["content-length"])
        while len(held) < upto:
            if not more():
                raise ValueError("the archive is cut off in a record's block")
        yield headers, bytes(held[end + 4:upto])
        del held[:upto]


def index_text(f, member: tuple[int, int, int]) -> str:
    method, local, length = member
    at, n = stored_at(f, (0, local, length))
    f.seek(at)
    raw = f.read(n)
    if method == 8:
        raw = zlib.decompress(raw, -15)
    elif method != 0:
        raise ValueError("an index is packed in another way")
    return (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode("utf-8")


def archive_named(file: str, archives: dict[str, tuple[int, int]]) -> str:
    """The member that an index means by a path, a bare name or, if there is one archive only, nothing."""
    fit = [a for a in archives if a == file] or [a for a in archives if not file or a.rpartition("/")[2] == file.rpartition("/")[2]]
    if len(fit) != 1:
        raise ValueError(f"an index names the archive {file!r}, of which there are {len(fit)}")
    return fit[0]


def read_package(f, size: int) -> Iterator[tuple[dict, dict[str, str], bytes]]:
    """(index entry, headers, block) of every record, by range reads.  Members are found by the directory alone."""
    members = directory(f, size)
    archives = {name: stored_at(f, m) for name, m in members.items() if name.endswith(ARCHIVES)}
    listed: dict[str, dict[int, dict]] = {name: {} for name in archives}
    for name in (n for n in members if n.endswith(INDEXES)):
        for e in _entries(index_text(f, members[name])):
            listed[archive_named(e.get("filename", ""), archives)].setdefault(e["offset"], e)
    for name, (base, length) in archives.items():
        entries, k, at = [listed[name][o] for o in sorted(listed[name])], 0, 0
        while k < len(entries):
            first, end, upto = entries[k]["offset"], entries[k]["offset"] + entries[k]["length"], k + 1
            while upto < len(entries) and entries[upto]["offset"] == end and end + entries[upto]["length"] - first <= RANGE_BYTES:
                end += entries[upto]["length"]
                upto += 1
            if first < at or end > length:
                raise ValueError("an index names a range that isn't a record's")
            for record in records_of(uncompressed(f, base + at, first - at)):
                yield {}, *record
            f.seek(base + first)
            raw = f.read(end - first)
            for e in entries[k:upto]:
                part = raw[e["offset"] - first:e["offset"] - first + e["length"]]
                for record in records_of(uncompressed(io.BytesIO(part), 0, len(part))):
                    yield e, *record
            k, at = upto, end
        for record in records_of(uncompressed(f, base + at, length - at)):
            yield {}, *record


def write(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write packages; the manifest: path, bytes, records.  It is written, so it lists finished attempts only."""
    from pyarrow import fs

    spark = pages.sparkSession
    root = fresh_path(spark, "packages")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = pages.withColumn("digest", F.sha2(F.col("html"), 256))
    shared = keyed.where(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    marked = join_on_hot_key(keyed, written(shared, "equal_payloads"), "digest", "n", F.col("page_id"))
    marked = marked.select("page_id", "url", "html", "digest", F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")).alias("refers_to"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        package = name = sink = None
        for batch in sliced(batches):
            for row in batch.to_pylist():
                if package is None:
                    store.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.wacz"
                    sink = store.open_output_stream(f"{base}/{name}")
                    package = Package(sink)
                package.add(row["page_id"], row["url"], row["html"].encode("utf-8"), row["digest"], row["refers_to"])
                if len(package.lines) >= ROLL_RECORDS or package.payload >= ROLL_BYTES:
                    yield close(store, base, name, package, sink)
                    package = None
        if package is not None:
            yield close(store, base, name, package, sink)

    def close(store, base, name, package, sink) -> pa.RecordBatch:
        package.close()
        sink.close()
        return pa.RecordBatch.from_pydict({"path": [f"{root}/{name}"], "bytes": [store.get_file_info(f"{base}/{name}").size], "records": [len(package.lines)]})

    return written(marked.mapInArrow(put, "path string, bytes long, records long"), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """The records of all packages: what their headers and payloads say.  A payload that fails its digest is an error."""
    from pyarrow import fs

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["path"])
                out: dict[str, list] = {x.split()[0]: [] for x in RECORD.split(", ")}
                with store.open_input_file(path) as f:
                    for _, headers, block in read_package(f, row["bytes"]):
                        head, payload = parts_of(headers, block)
                        revisit = headers.get("warc-type") == "revisit"
                        if not revisit and digest_fails(headers, head, payload):
                            raise ValueError(f"{row['path']}: a payload doesn't fit its digest")
                        said, length = headers.get("warc-payload-digest", ""), headers.get("x-payload-length")
                        out["page_id"].append(_page(headers.get("warc-record-id")))
                        out["payload_bytes"].append(len(payload) if not revisit else int(length) if length else None)
                        out["payload_digest"].append(hashlib.sha256(payload).hexdigest() if not revisit else said.removeprefix("sha256:") or None)
                        out["record_type"].append(headers.get("warc-type"))
                        out["refers_to"].append(_page(headers.get("warc-refers-to")) if revisit else None)
                yield pa.RecordBatch.from_pydict(out, schema=ARROW)

    parts = max(1, manifest.count())
    return manifest.repartition(min(parts, 20_000)).mapInArrow(get, RECORD)


ARROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
