"""WARC archives with a two-level capture index.

Writing: every page becomes one gzip member in an archive file. Of pages with equal payloads of
at least ``min_bytes`` bytes the one with the smallest id is a ``response``, the others are
``revisit`` records that name it and carry no payload.

Index: one line per record, keyed by the reversed host and the path of its URL, in the order of
(key, id). Lines are packed into compressed blocks of ``BLOCK_LINES``; a sparse directory keeps the
first key of each block and where its bytes are, and a table on top the first key of each index
file. Reading a URL searches the top table and the directory by bisection, range-reads and
decompresses one block, searches that, and range-reads the one record.

Files go to a folder that all executors reach (local or any filesystem that pyarrow knows by its
URI); each is written under a temporary name and then moved, so that a task that is run again
replaces the same file by the same bytes. A null html is an empty payload, a null url sorts first
under an empty key. Pages that repeat an id are records of their own, told apart by where they lie;
the id and the payload digest that a revisit gives name its payload, the id alone need not.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land

BLOCK_LINES = 512
#: Payload bytes after which a task starts another archive file.
ARCHIVE_BYTES = 256 << 20
#: Compressed record bytes that one task reads back (a sizing target).
READ_BYTES = 16 << 20
_DATE = "2024-01-01T00:00:00Z"     # the tables hold no capture time


def url_key(url: str | None) -> str:
    """``com,example,www)/path?query`` in lower case; anything that is no URL is its own key."""
    url = url or ""
    try:
        parts = urlsplit(url if "://" in url else f"//{url}")
        host = (parts.hostname or "").strip(".")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return url.lower()
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}{port}){tail}".lower()


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit has an empty block."""
    def urn(i):
        return f"<urn:page:{'' if i is None else i}>"

    body = b"" if refers_to is not None else payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", urn(page_id)), ("WARC-Date", _DATE),
            ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "text/html; charset=utf-8")]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", urn(refers_to))]
    head.append(("Content-Length", str(len(body))))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(text.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record's gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    return headers, rest[:int(headers["Content-Length"])]


# --- files --------------------------------------------------------------------------------

def _fs(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") \
        else (fs.LocalFileSystem(), uri)


class _File:
    """A file that appears under its name only when it is whole."""

    def __init__(self, folder: str, name: str):
        from pyspark import TaskContext

        self.fs, base = _fs(folder)
        self.fs.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
        self.name, self.path, self.tmp = name, f"{base}/{name}", f"{base}/.{name}.{attempt}"
        self.out, self.size = self.fs.open_output_stream(self.tmp, compression=None), 0

    def add(self, data: bytes) -> int:
        """Append; the offset at which ``data`` begins."""
        self.out.write(data)
        self.size += len(data)
        return self.size - len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.tmp, self.path)


class _Ranges:
    """Range reads from files of one folder; the last file stays open."""

    def __init__(self, folder: str):
        (self.fs, self.base), self.name, self.file = _fs(folder), None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.fs.open_input_file(f"{self.base}/{name}")
        return self.file.read_at(length, offset)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


# --- writing ------------------------------------------------------------------------------

def mark_revisits(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id",
                  url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, html, refers_to): which record of equal payloads is the response.

    Payloads are equal when SHA-256 and size are. Groups are reduced in each task before the
    shuffle; only groups of two or more meet the pages again, by page id and payload (an id may
    repeat with other html), so html is not dealt by payload alone and a payload that a third of
    the pages share makes no large group.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.select("*", F.sha2("html", 256).alias("print"), F.octet_length("html").alias("size"))
    prints = land(rows.filter(F.col("size") >= min_bytes).select("page_id", "print", "size"), "prints")
    first = prints.groupBy("print", "size").agg(F.min("page_id").alias("refers_to"),
                                                F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = land(prints.join(first, ["print", "size"]).filter("page_id <> refers_to")
                 .select("page_id", "print", "size", "refers_to").distinct(), "revisits")
    return rows.join(again, ["page_id", "print", "size"], "left") \
        .select("page_id", "url", "html", "refers_to")


ENTRIES = "key string, id long, file string, offset long, length long"
_NO_ID = -(1 << 63)                # stands for a null page id in keys


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      names=["key", "id", "file", "offset", "length"])


def write_archives(marked: DataFrame, folder: str) -> DataFrame:
    """Write the records of each partition to its own files; the index entries, one per record."""
    limit = ARCHIVE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, file, files, written = TaskContext.get().partitionId(), None, 0, 0
        for rows in batches:
            out = []
            for page, url, html, refers in zip(*(rows.column(i).to_pylist() for i in range(4))):
                if file is None:
                    file, written = _File(folder, f"part-{part:06d}-{files:04d}.warc.gz"), 0
                    files += 1
                payload = html.encode("utf-8", "surrogatepass")
                member = record(page, url, payload, payload_digest(payload), refers)
                out.append((url_key(url), _NO_ID if page is None else page, file.name,
                            file.add(member), len(member)))
                written += len(member)
                if written >= limit:
                    file.close()
                    file = None
            yield _entries(out)
        if file is not None:
            file.close()

    ordered = marked.select("page_id", "url", "html", "refers_to")
    return land(ordered.mapInArrow(run, ENTRIES), "entries")


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(key, id): the distinct captures that a table of pages asks for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([url_key(u) for u in rows.column(1).to_pylist()], pa.string()),
                 rows.column(0)], names=["key", "id"])

    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    return pages.select(ids.alias("id"), F.col(url_col).cast("string").alias("url")) \
        .mapInArrow(run, "key string, id long").distinct()


# --- index --------------------------------------------------------------------------------

def write_index(entries: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write sorted compressed blocks and their directories, a file per task; the top table (first
    key and id, file, directory's offset and length), one row per index file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, block, directory = None, [], []

        def pack():
            data = zlib.compress("\n".join(json.dumps(x) for x in block).encode())
            directory.append((block[0][0], block[0][1], file.add(data), len(data)))
            block.clear()

        for rows in batches:
            for line in zip(*(rows.column(i).to_pylist() for i in range(5))):
                if file is None:
                    file = _File(folder, f"cdx-{TaskContext.get().partitionId():06d}.gz")
                block.append(line)
                if len(block) == block_lines:
                    pack()
        if file is None:
            return
        if block:
            pack()
        data = zlib.compress(json.dumps(directory).encode())
        at = file.add(data)
        file.close()
        yield _entries([(directory[0][0], directory[0][1], file.name, at, len(data))])

    lines = entries.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return land(lines.mapInArrow(run, ENTRIES), "index")


class Index:
    """Look-ups in one index; the last directory and block are kept, as look-ups come in order."""

    def __init__(self, folder: str, top: list[tuple]):
        self.top = sorted(top)                     # (key, id, file, offset, length)
        self.read = _Ranges(folder).read
        self._file, self._directory, self._at, self._block = None, [], None, []

    def _open(self, which: int) -> None:
        _, _, name, offset, length = self.top[which]
        if name != self._file:
            self._file, self._at = name, None
            self._directory = [tuple(x) for x in json.loads(zlib.decompress(self.read(name, offset, length)))]

    def _lines(self, block: int) -> list[tuple]:
        if block != self._at:
            _, _, offset, length = self._directory[block]
            raw = zlib.decompress(self.read(self._file, offset, length)).decode()
            self._at, self._block = block, [tuple(json.loads(x)) for x in raw.split("\n")]
        return self._block

    def find(self, key: str, page: int) -> Iterator[tuple]:
        """Lines (key, id, file, offset, length) of a capture: bisect the top table, the
        directory and the block; equal keys may go on in the following blocks and files."""
        want, pair = (key, page), (lambda t: t[:2])
        which = max(0, bisect.bisect_left(self.top, want, key=pair) - 1)
        block = None
        while which < len(self.top) and self.top[which][:2] <= want:
            self._open(which)
            if block is None:
                block = max(0, bisect.bisect_left(self._directory, want, key=pair) - 1)
            while block < len(self._directory) and self._directory[block][:2] <= want:
                lines = self._lines(block)
                i = bisect.bisect_left(lines, want, key=pair)
                while i < len(lines) and lines[i][:2] == want:
                    yield lines[i]
                    i += 1
                block += 1
            which, block = which + 1, 0


def locate(wanted: DataFrame, folder: str, top: DataFrame) -> DataFrame:
    """(key, id, file, offset, length) of wanted captures (key, id), found through the index.

    The top table has a row per index file, and each task needs only the directories and blocks
    that its sorted run of keys meets. A capture that is not in the index gives no row."""
    shared = wanted.sparkSession.sparkContext.broadcast([tuple(r) for r in top.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, shared.value)
        for rows in batches:
            yield _entries([line for k, i in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())
                            for line in index.find(k, i)])

    return wanted.repartitionByRange("key", "id").sortWithinPartitions("key", "id") \
        .mapInArrow(run, ENTRIES)


def read_records(located: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload, digest, own_bytes): range-read records,
    each task in the order of its files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = _Ranges(folder)

        def page(urn: str | None):
            i = (urn or "")[len("<urn:page:"):-1]
            return int(i) if i else None

        for rows in batches:
            out = []
            for name, offset, length in zip(*(rows.column(i).to_pylist() for i in range(3))):
                head, body = parse(source.read(name, offset, length))
                revisit = head["WARC-Type"] == "revisit"
                declared = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and payload_digest(body) != declared:
                    raise ValueError(f"{name} at {offset}: payload differs from its digest")
                out.append((page(head["WARC-Record-ID"]), head["WARC-Target-URI"], head["WARC-Type"],
                            page(head.get("WARC-Refers-To")), body, declared))
                if sum(len(x[4]) for x in out[-64:]) > 8_000_000 or len(out) >= 2000:
                    yield _read(out)
                    out = []
            yield _read(out)

    by = located.select("file", "offset", "length")
    held = located.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return by.repartitionByRange(1 + held // READ_BYTES, "file", "offset").sortWithinPartitions("file", "offset") \
        .mapInArrow(run, "page_id long, url string, record_type string, refers_to long, "
                         "payload binary, payload_digest string")


def _read(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)],
        names=["page_id", "url", "record_type", "refers_to", "payload", "payload_digest"])


def archive_and_read(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write archives and index under ``folder``, find every capture through the index and read
    its record: page_id, payload_bytes, payload_digest, record_type, refers_to. A revisit's size
    is that of the response that it refers to, read from the archive as well."""
    entries = write_archives(mark_revisits(pages, min_bytes), f"{folder}/warc")
    top = write_index(entries, f"{folder}/index")
    located = land(locate(captures(pages), f"{folder}/index", top), "located")
    rows = land(read_records(located, f"{folder}/warc").select(
        "page_id", "record_type", "refers_to", "payload_digest",
        F.octet_length("payload").cast("long").alias("own")), "records")
    whole = rows.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"),
                                                            "payload_digest") \
        .agg(F.max("own").alias("full"))
    out = rows.join(whole, ["refers_to", "payload_digest"], "left")
    return out.select("page_id", F.when(F.col("record_type") == "revisit", F.col("full"))
                      .otherwise(F.col("own")).alias("payload_bytes"),
                      "payload_digest", "record_type", "refers_to")
