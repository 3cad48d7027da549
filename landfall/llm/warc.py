"""WARC archives: records written by tasks, and a splittable reader.

Every record is a gzip member of its own. A reading task takes a byte range, looks for the gzip magic, accepts a
candidate if it decodes whole, from a WARC header on, and owns the records that start inside its range, however far they reach. A range is read once, front to back. What cannot be read as a record is a row
with a ``problem``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.sources.staging import small_side, stage

# Fixed values of the format.
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads from this size on are stored once.
LEAST_REVISIT = 1000
#: Bytes of a file before the next is begun, and of a range that a task reads.
FILE_BYTES, SPLIT_BYTES = 256 << 20, 8 << 20
#: The date of all records, so that reruns write the same bytes.
DATE = "2024-01-01T00:00:00Z"
#: Problems of bytes that hold no whole record.
BROKEN, NO_RECORD = "record is broken", "no record"
#: A whole record, but what comes after it is none: the next is damaged, or this one lies inside another's payload.
UNFOLLOWED = "what follows is no record"
_CHUNK = 1 << 18
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _open(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (arrow_fs.LocalFileSystem(), uri)


def record(kind: str, page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit with the headers of its response alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, folder: str, least_revisit: int = LEAST_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` (``page_id, url, html``) and returns the manifest ``path, bytes, records``.

    Among records with equal payloads of ``least_revisit`` bytes or more, those with the largest ``page_id`` are
    responses, the others revisit it; if none has an id, all are responses. A null html is an empty payload; a null id
    or url is left out of the record. Only files in the manifest count: a file that a lost or repeated task attempt left
    behind is not in it. Other columns are not read. Without pages there are no files.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    size, digest = F.octet_length(html), F.sha1(html)
    groups = pages.select("page_id", size.alias("size"), digest.alias("digest")).where(F.col("size") >= least_revisit).groupBy(
        "digest", "size").agg(F.max("page_id").alias("keeper"), F.count("*").alias("rows")).where("rows > 1 and keeper is not null")
    groups = stage(groups.select(F.col("digest").alias("_digest"), "keeper"), "warc-groups")
    sized = pages.select("page_id", "url", html.alias("payload"), size.alias("size"), digest.alias("digest"))
    # The groups are the short side, so payloads are shuffled once at most and never sorted.
    joined = sized.join(small_side(groups), F.col("digest") == F.col("_digest"), "left")
    again = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    rows = joined.select("page_id", "url", F.when(~again, F.col("payload")).alias("payload"), F.col("size").cast("bigint").alias("size"),
                         "digest", F.when(again, F.col("keeper")).alias("refers_to"), again.alias("again"))
    return stage(rows.mapInArrow(_writer(folder, file_bytes), "path string, bytes bigint, records bigint"), "warc-manifest")


def _writer(folder: str, file_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        stream, path, done, records = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": [done], "records": [records]},
                                              schema=pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

        for batch in batches:
            for row in batch.to_pylist():
                if stream is not None and done >= file_bytes:
                    yield closed()
                    stream = None
                if stream is None:  # a new name in each attempt
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    stream, path, done, records = system.open_output_stream(
                        f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
                member = record("revisit" if row["again"] else "response", row["page_id"], row["url"], row["payload"] or b"",
                                row["digest"], row["size"], row["refers_to"])
                stream.write(member)
                done, records = done + len(member), records + 1
        if stream is not None:
            yield closed()

    return write


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the files in ``path, bytes``, a row each.

    Columns: ``page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload``, where it lies (``path,
    position``) and ``problem`` (null if there is none). Files may come from elsewhere, if every record is a gzip member.
    A revisit has no payload; its size and digest are those that its record states. For a response both are taken from
    the bytes read. Records of other types are passed over.

    Nothing malformed ends the job. A stated digest (base 32 or hexadecimal) that differs, no or a wrong length of the
    block are problems of an otherwise whole row. A record that breaks off or does not decompress has the fields of its
    header, as far as that is whole, and no payload. Bytes after a record that are no record give a row with only where
    they begin, and the whole record before them has a problem too. :func:`missing_records` compares what was read with the
    manifest. The records of an archive that is a payload are met if that payload was stored uncompressed, by a range that
    begins inside it; the last of them, and bytes after it, then have a problem.
    """
    ranges = manifest.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))).alias("start"))
    ranges = stage(ranges, "warc-ranges")
    tasks = min(max(ranges.count(), 1), 100_000)
    return ranges.repartition(tasks).mapInArrow(
        _reader(split_bytes), "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, "
        "payload binary, path string, position bigint, problem string")


def missing_records(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Files of the manifest with other counts of whole records than were written: ``path, records, read, problems``."""
    whole = F.col("record_type").isNotNull() & ~F.coalesce(F.col("problem").isin(BROKEN, NO_RECORD), F.lit(False))
    counts = records.groupBy(F.col("path").alias("_path")).agg(
        F.count_if(whole).alias("read"), F.count("problem").alias("problems"))
    found = manifest.select("path", "records").join(counts, F.col("path") == F.col("_path"), "left").drop("_path")
    return found.fillna(0, ["read", "problems"]).where("records != read or problems > 0")


def _reader(split_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
                        ("path", pa.string()), ("position", pa.int64()), ("problem", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for part in batch.to_pylist():
                system, path = _open(part["path"])
                with system.open_input_file(path) as file:
                    for position, member, problem in members(file, part["start"], min(part["start"] + split_bytes, part["bytes"]), part["bytes"]):
                        row = parse(member, problem)
                        if row is not None:
                            rows.append({**row, "path": part["path"], "position": position})
                            held += len(row["payload"] or b"")
                        if len(rows) >= 2000 or held >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return read


class _Window:
    """The part of a file that is being looked at; bytes come in once, in order, and go when they are done with."""

    def __init__(self, file, start: int, size: int) -> None:
        self.file, self.base, self.size, self.held = file, start, size, bytearray()
        file.seek(start)

    def reach(self, end: int) -> int:
        """Reads on until ``end`` or the end of the file; how far the bytes go then."""
        while (have := self.base + len(self.held)) < min(end, self.size):
            chunk = self.file.read(min(_CHUNK, self.size - have))
            if not chunk:  # shorter than the manifest says
                self.size = have
            self.held += chunk
        return self.base + len(self.held)

    def bytes(self, start: int, end: int) -> bytes:
        self.reach(end)
        return bytes(memoryview(self.held)[start - self.base:end - self.base])

    def find(self, start: int, end: int) -> int | None:
        """Where the magic begins next, before ``end``."""
        while start < end:
            far = min(self.reach(min(start + _CHUNK, end) + len(MAGIC) - 1), end + len(MAGIC) - 1)
            at = self.held.find(MAGIC, start - self.base, far - self.base)
            if at >= 0:
                return self.base + at
            if far >= min(end + len(MAGIC) - 1, self.size):
                return None
            start = far - len(MAGIC) + 1
            self.forget(start)
        return None

    def forget(self, before: int) -> None:
        if before - self.base >= _CHUNK:
            del self.held[:before - self.base]
            self.base = before


def members(file, start: int, end: int, size: int) -> Iterator[tuple[int, bytes, str | None]]:
    """Where a member begins that starts in ``start`` to ``end`` of a file of ``size`` bytes, its content, and its problem.

    Where a record ends, the next must begin; the task that reads the former reports bytes that are none, also beyond
    its own range. A broken record is reported by the task in whose range it begins.
    """
    window = _Window(file, start, size)
    at, follows = start, start == 0  # whether a record must begin at ``at``
    while at < end or (follows and at < size):
        if follows and at >= end:
            if _member(window, at, size, True)[2] == NO_RECORD:
                yield at, b"", NO_RECORD
            return
        if not follows and (at := window.find(at, end)) is None:
            return
        content, after, problem = _member(window, at, size, False)
        if problem != NO_RECORD or follows:
            yield at, content, problem
        whole = problem in (None, UNFOLLOWED)
        at, follows = after if whole else at + 1, whole
        window.forget(at)


def _member(window: _Window, at: int, size: int, glance: bool) -> tuple[bytes, int, str | None]:
    """A member's content, where it ends, and its problem; with ``glance`` only whether one begins there."""
    unpacker, parts, place, step, checked, done = zlib.decompressobj(31), [], at, 16_384, False, 0
    try:
        while not unpacker.eof:
            far = min(window.reach(place + step), place + step)
            if far == place:
                return b"".join(parts), place, BROKEN if checked else NO_RECORD
            chunk, place, step = window.bytes(place, far), far, _CHUNK
            while chunk and not unpacker.eof:  # small steps first, so that a header before broken bytes is kept
                parts.append(unpacker.decompress(chunk, 128 if done < 4096 else _CHUNK))
                chunk, done = unpacker.unconsumed_tail, done + len(parts[-1])
                if not checked and done >= 7:
                    if not b"".join(parts).startswith(b"WARC/1."):
                        return b"", at, NO_RECORD
                    checked = True
                    if glance:
                        return b"", at, None
    except zlib.error:
        return b"".join(parts), at, BROKEN if checked else NO_RECORD
    end = place - len(unpacker.unused_data)
    if not checked:
        return b"", at, NO_RECORD
    followed = end >= size or window.bytes(end, end + len(MAGIC)) == MAGIC
    return b"".join(parts), end, None if followed else UNFOLLOWED


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _page(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d{1,18})>", value or "")
    return int(found[1]) if found else None


def _length(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"\d{1,18}", value) else None


def _sha1(value: str | None) -> tuple[str | None, str | None]:
    """The digest in hexadecimal, and what is wrong with it; other kinds of digests are not compared."""
    kind, _, digest = (value or "").partition(":")
    if kind.strip().lower() != "sha1":
        return None, None
    digest = digest.strip()
    if re.fullmatch(r"[0-9a-fA-F]{40}", digest):
        return digest.lower(), None
    try:
        return base64.b32decode(digest.upper()).hex(), None
    except ValueError:
        return None, "digest is not readable"


def parse(member: bytes, problem: str | None = None) -> dict | None:
    """The row of a response or revisit record; of one with a ``problem`` what its header tells."""
    head, whole, rest = member.partition(b"\r\n\r\n")
    fields = _fields(head) if whole else {}
    row = {"page_id": _page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": fields.get("warc-type"),
           "refers_to": _page(fields.get("warc-refers-to")), "payload_digest": None, "payload_bytes": None, "payload": None, "problem": problem}
    if problem in (BROKEN, NO_RECORD):
        return row
    if row["record_type"] not in ("response", "revisit"):
        return None
    block = _length(fields.get("content-length"))
    if block is None:
        row["problem"], rest = problem or "length of the block is not stated", rest.removesuffix(b"\r\n\r\n")
    elif block > len(rest):
        row["problem"] = problem or "block is shorter than stated"
    http, _, payload = rest[:block].partition(b"\r\n\r\n")
    stated, unreadable = _sha1(fields.get("warc-payload-digest"))
    row["problem"] = row["problem"] or unreadable
    if row["record_type"] == "response":
        row |= {"payload": payload, "payload_digest": hashlib.sha1(payload).hexdigest(), "payload_bytes": len(payload)}
        if stated not in (None, row["payload_digest"]):
            row["problem"] = row["problem"] or "payload does not match its digest"
    else:
        row |= {"payload_digest": stated, "payload_bytes": _length(_fields(http).get("content-length"))}
    return row
