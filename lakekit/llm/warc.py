"""WARC archives with a two-level capture index.

Writing: pages become gzip members of WARC files in the shared folder, one stream for each task and attempt, rolled over at
`file_bytes`. Equal payloads of `least_bytes` or more are stored once: the record with the largest page id is the response, the others
are revisits of it. Index: captures sorted by reversed-host URL key are written as lines in gzip blocks; the sparse directory keeps
each block's first key and place. Reading: a key's blocks come from a binary search of the directory, its lines from a binary search
in the block, and its records from range reads, in file order.

Files are reached through Arrow's file systems by URI (file, hdfs, s3 and others). A retried task writes new files; the
index knows only those of the attempt that succeeded.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm.common import materialize, scratch_folder

DATE = "2000-01-01T00:00:00Z"  # pages carry no time; a fixed one keeps reruns alike
BLOCK_LINES = 1024  # captures in an index block
DIRECTORY_ROWS = 1 << 20  # the directory is broadcast up to this many blocks; beyond, it is cut into ranges of keys


def url_key(url: str | None) -> str:
    """The URL with its host reversed: com,example,www)/path?query; port and fragment kept out, empty for null."""
    if not url:
        return ""
    url = _safe(url)
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").rstrip(".")
    except ValueError:
        return url
    path = parts.path or "/"
    return ",".join(reversed(host.split("."))) + ")" + path.lower() + (f"?{parts.query.lower()}" if parts.query else "")


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record_bytes(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit without."""
    revisit = refers_to is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by name in lower case, and the payload after the HTTP head."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict((k.lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines[1:]))
    body = rest[: int(headers["content-length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def _open(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system, path


def _write(folder: str, file_bytes: int):
    """(key, page_id, file, offset, length) of each record of (page_id, url, html, digest, refers_to)."""

    def run(batches):
        system, root = _open(folder)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                keys, files, offsets, lengths = [], [], [], []
                columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]
                for page_id, url, html, digest, refers_to in zip(*columns):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    data = _member(record_bytes(page_id, url, (html or "").encode(), digest, refers_to))
                    out.write(data)
                    keys.append(url_key(url))
                    files.append(name)
                    offsets.append(at)
                    lengths.append(len(data))
                    at += len(data)
                yield pa.record_batch(
                    {
                        "key": pa.array(keys, pa.string()),
                        "page_id": batch.column("page_id"),
                        "file": pa.array(files, pa.string()),
                        "offset": pa.array(offsets, pa.int64()),
                        "length": pa.array(lengths, pa.int64()),
                    }
                )
        finally:
            if out is not None:
                out.close()

    return run


def _index(folder: str, block_lines: int):
    """Writes sorted captures as gzip blocks; (first_key, last_key, file, offset, length) of each."""

    def run(batches):
        system, root = _open(folder)
        name, at, out, lines, found = f"index-{uuid.uuid4().hex}.cdx.gz", 0, None, [], []

        def flush():
            nonlocal at, out
            if out is None:
                out = system.open_output_stream(f"{root}/{name}", compression=None)
            data = _member("\n".join(f"{k}\t{rest}" for k, rest in lines).encode())
            out.write(data)
            found.append((lines[0][0], lines[-1][0], name, at, len(data)))
            at += len(data)
            lines.clear()

        try:
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("key", "file", "offset", "length")]
                for key, file, offset, length in zip(*columns):
                    lines.append((key, json.dumps([file, offset, length])))
                    if len(lines) == block_lines:
                        flush()
            if lines:
                flush()
        finally:
            if out is not None:
                out.close()
        if found:
            yield pa.table(list(map(pa.array, zip(*found))), ["first_key", "last_key", "file", "offset", "length"]).to_batches()[0]

    return run


def _safe(key: str) -> str:
    return key.replace("\t", "%09").replace("\n", "%0A").replace("\r", "%0D")


class Reader:
    """Range reads of one folder; keeps the file it read last open."""

    def __init__(self, folder: str):
        self.system, self.root = _open(folder)
        self.name, self.file = None, None

    def member(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.system.open_input_file(f"{self.root}/{name}")
        self.file.seek(offset)
        return zlib.decompress(self.file.read(length), 31)

    def close(self):
        if self.file is not None:
            self.file.close()


def _find_blocks(directory):
    """(key, file, offset, length) of each index block that can hold a key: a binary search of the sorted directory."""

    def run(batches):
        first, last, *place = directory.value
        for batch in batches:
            keys, at = [], []
            for key in batch.column("key").to_pylist():
                # The first block that ends at or after the key, and on while blocks begin at or before it.
                i = bisect.bisect_left(last, key)
                while i < len(first) and first[i] <= key:
                    keys.append(key)
                    at.append(i)
                    i += 1
            took = pa.array(at, pa.int64())
            yield pa.record_batch(
                {"key": pa.array(keys, pa.string())} | {n: pa.array(c).take(took) for n, c in zip(("file", "offset", "length"), place)}
            )

    return run


def _find_records(folder: str):
    """(file, offset, length) of the records of sorted (file, offset, length, key): a binary search in each index block."""

    def run(batches):
        reader, place, keys, rest = Reader(folder), None, [], []
        try:
            for batch in batches:
                found = []
                for file, offset, length, key in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length", "key"))):
                    if (file, offset) != place:
                        lines = [x.split("\t") for x in reader.member(file, offset, length).decode().split("\n")]
                        keys, rest, place = [x[0] for x in lines], [x[1] for x in lines], (file, offset)
                    for i in range(bisect.bisect_left(keys, key), bisect.bisect_right(keys, key)):
                        found.append(json.loads(rest[i]))
                columns = list(zip(*found)) if found else [[], [], []]
                yield pa.record_batch(
                    {"file": pa.array(columns[0], pa.string()), "offset": pa.array(columns[1], pa.int64()), "length": pa.array(columns[2], pa.int64())}
                )
        finally:
            reader.close()

    return run


def _number(text: str | None) -> int | None:
    value = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value.lstrip("-").isdigit() else None


def _read(folder: str):
    def run(batches):
        reader = Reader(folder)
        try:
            for batch in batches:
                rows = []
                for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                    head, payload = parse_record(reader.member(file, offset, length))
                    kind = head["warc-type"]
                    told = head["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != told:
                        raise ValueError(f"damaged record in {file} at {offset}")
                    size = len(payload) if kind == "response" else int(head["warc-payload-length"])
                    rows.append((_number(head["warc-record-id"]), head["warc-target-uri"], size, told, kind, _number(head.get("warc-refers-to"))))
                columns = list(zip(*rows)) if rows else [[]] * 6
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
                yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})
        finally:
            reader.close()

    return run


def write_archive(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 1000,
                  file_bytes: int = 1 << 30) -> DataFrame:
    """Writes the pages under `folder` (a URI) and returns the stored captures (key, page_id, file, offset, length).

    Null pages are empty payloads, null URLs empty ones. Rows that tie for the largest page id of a payload are all responses; a null page
    id ranks below all others. Other columns are not written.
    """
    context = pages.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(path)
    digest = F.sha1(F.coalesce(F.col(html), F.lit("")).cast("binary"))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), digest.alias("digest")
    )
    large = rows.where(F.octet_length("html") >= least_bytes).select("page_id", "digest")
    # Only payloads that occur more than once need to be known.
    owners = materialize(
        large.groupBy("digest").agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n"), "owners"
    )
    refers = F.when((F.octet_length("html") >= least_bytes) & (~F.col("page_id").eqNullSafe(F.col("owner"))), F.col("owner"))
    marked = rows.join(owners, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    kind = "key string, page_id long, file string, offset long, length long"
    return materialize(marked.mapInArrow(_write(folder, file_bytes), kind), "captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the captures' index blocks under `folder` and returns the stored sparse directory.

    A key with very many captures spreads over several tasks: rows are dealt by key, file and offset.
    """
    order = ("key", "file", "offset")
    sorted_rows = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = "first_key string, last_key string, file string, offset long, length long"
    return materialize(sorted_rows.mapInArrow(_index(folder, block_lines), kind), "directory")


def lookup(spark: SparkSession, keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """The archived records of `keys(key)`, which should be distinct: page_id, url, payload_bytes, payload_digest, record_type, refers_to."""
    blocks = directory.count()
    ranges = [None]
    if blocks > DIRECTORY_ROWS:
        parts = -(-blocks // DIRECTORY_ROWS)
        ranges = [F.pmod(F.xxhash64("file", "offset"), F.lit(parts)) == i for i in range(parts)]
    found = None
    for some in ranges:
        rows = (directory if some is None else directory.where(some)).orderBy("first_key", "last_key", "file", "offset").toArrow()
        shared = spark.sparkContext.broadcast(tuple(rows.column(c).to_pylist() for c in ("first_key", "last_key", "file", "offset", "length")))
        more = keys.mapInArrow(_find_blocks(shared), "key string, file string, offset long, length long")
        found = more if found is None else found.unionByName(more)
    place = ("file", "offset")
    at = found.repartitionByRange(*place, "key").sortWithinPartitions(*place, "key")
    records = at.mapInArrow(_find_records(folder), "file string, offset long, length long")
    records = records.repartitionByRange(*place).sortWithinPartitions(*place)
    return records.mapInArrow(
        _read(folder),
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def _keys(batches):
    for batch in batches:
        yield pa.record_batch({"key": pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())})


def archive_round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", **options) -> DataFrame:
    """Writes archive and index, then finds every page again through the index by its URL: one row for each record."""
    spark = pages.sparkSession
    folder = scratch_folder(spark, "warc")
    folder = folder if "://" in folder else f"file://{folder}" if folder.startswith("/") else folder
    captures = write_archive(pages, folder, page_id, url, html, **options)
    directory = write_index(captures, folder)
    keys = pages.select(F.col(url).alias("url")).mapInArrow(_keys, "key string").distinct()
    return lookup(spark, keys, directory, folder)
