"""WARC archives of pages, and a two-level capture index to read them back.

Every task writes one archive of gzip members, a record each, to the shared folder; what counts is the table of captures that
Spark commits, so files of lost tasks are never read. The index is sorted by reversed-host keys: a range of keys
is one index file, made of compressed blocks of lines, with a sparse directory of first keys at its end. A look-up finds the
file by its first key, the block by a binary search in the directory, the line by a binary search in the block, and then reads
only the bytes of the record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
from bisect import bisect_left

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import bloom
from tenura.llm.tables import pieces
from tenura.session import new_folder, stage

# Payloads of fewer bytes are always written whole.
LEAST_REVISIT = 1000
BLOCK_LINES = 2000
INDEX_ROWS = 500_000
_LEVEL = 4
_TAIL = "<Q4s"
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _files(uri: str):
    """(file system, path) of a folder that the cluster names, for tasks; Spark's s3a is s3 to Arrow."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if "://" in uri else uri if ":" not in uri else "file://" + uri.split(":", 1)[1])


def escaped(text: str) -> str:
    """Printable ASCII without spaces: other characters as the percent signs of their UTF-8 bytes."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in text)


def url_key(url: str | None) -> str:
    """``com,example,www)/path?query``: host reversed and lower-cased, no scheme, no fragment. Null has the empty key."""
    if url is None:
        return ""
    rest = url.partition("://")[2] or url
    cut = re.search(r"[/?#]", rest)
    host, path = (rest[: cut.start()], rest[cut.start() :]) if cut else (rest, "")
    return escaped(",".join(reversed(host.lower().split("."))) + ")" + path.partition("#")[0])


def capture_key(url: str | None, page_id: int | None) -> str:
    """Order of the index: by address, then by page; a null page id comes first."""
    return f"{url_key(url)} {'' if page_id is None else f'{page_id + (1 << 63):020d}'}"


# --- writing ---------------------------------------------------------------------------------------------------------------


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'none:' + str(uuid.uuid4()) if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {escaped(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _revisits(pages: DataFrame, least: int) -> DataFrame:
    """(__key, __sha, refers_to): id and digest of pages whose payload a page of larger id has too. Only ids, lengths and digests are moved."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = stage(pages.where("page_id IS NOT NULL").select(F.col("page_id").alias("page"), F.sha1(payload).alias("sha"), F.octet_length(payload).alias("n")), "payloads")
    narrow = stage(narrow.where(F.col("n") >= least).select("sha", "page").distinct(), "payloads")
    groups = stage(narrow.groupBy("sha").agg(F.max("page").alias("refers_to"), F.count("page").alias("pages")).where("pages > 1"), "groups")
    # Payloads of a thousandth of these pages, or more, are at most a thousand; they are broadcast, the others spread evenly.
    large = F.col("pages") * 1000 >= F.lit(narrow.count())
    hot, rest = F.broadcast(groups.where(large)), groups.where(~large)
    met = narrow.join(hot, "sha").unionByName(narrow.join(hot.select("sha"), "sha", "left_anti").join(rest, "sha"))
    return stage(met.where("page < refers_to").select(F.col("page").alias("__key"), F.col("sha").alias("__sha"), "refers_to"), "revisits")


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) below ``folder``; the captures are returned as a table.

    A null html is an empty payload. Of pages with equal payloads of ``least`` bytes or more that of the largest id is a response,
    the others are revisits of it. Pages without id are responses and are referred to by none; rows that repeat
    an id and a payload are alike. No rows: no archives.
    """
    revisits = _revisits(pages, least)
    target = f"{folder}/archives"

    def step(batches):
        files, root = _files(target)
        name, sink, at = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in pieces(batches, "html"):
                if sink is None:
                    files.create_dir(root, recursive=True)
                    sink = files.open_output_stream(f"{root}/{name}", compression=None)
                keys, offsets, lengths = [], [], []
                for page, url, html, sha, refers in zip(*(c.to_pylist() for c in batch.columns)):
                    raw = gzip.compress(record(page, url, html.encode("utf-8", "surrogatepass"), sha, refers), _LEVEL, mtime=0)
                    sink.write(raw)
                    keys.append(capture_key(url, page))
                    offsets.append(at)
                    lengths.append(len(raw))
                    at += len(raw)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([name] * len(keys)), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["key", "file", "offset", "length"])
        finally:
            if sink is not None:
                sink.close()

    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    # Only pages that may be revisits meet the table of revisits; the others are written where they are read.
    met = bloom.joined(rows, revisits, F.col("page_id"), "__key", (F.col("page_id") == F.col("__key")) & (F.col("sha") == F.col("__sha")))
    return stage(met.select("page_id", "url", "html", "sha", "refers_to").mapInArrow(step, "key string, file string, offset bigint, length bigint"), "captures")


def write_index(captures: DataFrame, folder: str, rows_per_file: int = INDEX_ROWS) -> list[tuple[str, str]]:
    """Sort the captures into index files; (first key, name) of each, in order, is all that the driver keeps."""
    target = f"{folder}/index"
    spark = captures.sparkSession
    n = captures.count()
    files_wanted = max(-(-n // rows_per_file), min(spark.sparkContext.defaultParallelism, -(-n // 10_000)), 1)

    def step(batches):
        name, sink, at, first = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.idx", None, 0, None
        lines: list[str] = []
        directory: list[tuple[str, int, int]] = []

        def flush():
            nonlocal at, lines
            raw = gzip.compress("\n".join(lines).encode(), _LEVEL, mtime=0)
            sink.write(raw)
            directory.append((lines[0].rpartition(" ")[0], at, len(raw)))
            at += len(raw)
            lines = []

        for batch in batches:
            for key, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    files, root = _files(target)
                    files.create_dir(root, recursive=True)
                    sink, first = files.open_output_stream(f"{root}/{name}", compression=None), key
                lines.append(f"{key} {file}:{offset}:{length}")
                if len(lines) >= BLOCK_LINES:
                    flush()
        if sink is not None:
            if lines:
                flush()
            tail = gzip.compress(json.dumps(directory).encode(), _LEVEL, mtime=0)
            sink.write(tail + struct.pack(_TAIL, len(tail), b"CDX2"))
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([name])], ["first", "name"])

    keys = [F.col("key"), F.col("file"), F.col("offset")]
    ordered = captures.repartitionByRange(files_wanted, *keys).sortWithinPartitions(*keys)
    written = stage(ordered.mapInArrow(step, "first string, name string"), "index")
    return sorted((r["first"], r["name"]) for r in written.collect())


# --- reading ------------------------------------------------------------------------------------------------------------


def parse_record(raw: bytes) -> dict:
    """Headers of a record and of the answer in it, and the payload that follows (empty for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    named = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    body = rest[: int(named["content-length"])]
    answer, _, payload = body.partition(b"\r\n\r\n")
    http = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in answer.decode().split("\r\n")[1:])}
    return {"version": lines[0], "headers": named, "http": http, "payload": payload}


class Index:
    """A reader of index files; it keeps the last file, directory and block, as sorted look-ups meet them again."""

    def __init__(self, folder: str, heads: list[tuple[str, str]]):
        self.firsts, self.names = [h[0] for h in heads], [h[1] for h in heads]
        self.files, self.root = _files(f"{folder}/index")
        self.file, self.number, self.directory, self.starts = None, -1, [], []
        self.block, self.lines, self.keys = -1, [], []

    def _open(self, number: int):
        if number != self.number:
            if self.file:
                self.file.close()
            self.file = self.files.open_input_file(f"{self.root}/{self.names[number]}")
            size = self.file.size()
            length, magic = struct.unpack(_TAIL, self.file.read_at(struct.calcsize(_TAIL), size - struct.calcsize(_TAIL)))
            if magic != b"CDX2":
                raise ValueError(f"{self.names[number]} is no index file")
            self.directory = json.loads(gzip.decompress(self.file.read_at(length, size - struct.calcsize(_TAIL) - length)))
            self.starts = [d[0] for d in self.directory]
            self.number, self.block = number, -1

    def _load(self, block: int):
        if block != self.block:
            _, at, length = self.directory[block]
            self.lines = gzip.decompress(self.file.read_at(length, at)).decode().split("\n")
            self.keys = [x.rpartition(" ")[0] for x in self.lines]
            self.block = block

    def find(self, key: str, prefix: bool = False):
        """(file, offset, length) of every capture with this key; with ``prefix`` of every key that starts with it."""
        if not self.names:
            return
        number = max(bisect_left(self.firsts, key) - 1, 0)
        while number < len(self.names) and (number == 0 or self.firsts[number] <= key or (prefix and self.firsts[number].startswith(key))):
            self._open(number)
            block = max(bisect_left(self.starts, key) - 1, 0)
            while block < len(self.starts) and (block == 0 or self.starts[block] <= key or (prefix and self.starts[block].startswith(key))):
                self._load(block)
                at = bisect_left(self.keys, key)
                while at < len(self.keys) and (self.keys[at].startswith(key) if prefix else self.keys[at] == key):
                    file, offset, length = self.lines[at].rpartition(" ")[2].rsplit(":", 2)
                    yield file, int(offset), int(length)
                    at += 1
                block += 1
            number += 1


def _told(head: dict, found: dict) -> tuple[int, str]:
    """(bytes, SHA-1) of a record's payload: of what a response holds, which must be what its headers say; a revisit has only those."""
    size, sha = int(found["http"]["content-length"]), base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    if head["warc-type"] == "response":
        payload = found["payload"] or b""
        read = len(payload), hashlib.sha1(payload).hexdigest()
        if read != (size, sha):
            raise ValueError(f"{head.get('warc-record-id')} holds {read}, its headers say {(size, sha)}")
    return size, sha


def look_up(wanted: DataFrame, folder: str, heads: list[tuple[str, str]], by_page: bool = True) -> DataFrame:
    """The records of ``wanted`` (url and, ``by_page``, page_id): one row for each capture found.

    Columns: ``page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload``. Repeated wishes are looked up once.
    Look-ups are dealt in the order of the index, so each task reads a run of blocks once; hot addresses are split by page.
    """
    spark = wanted.sparkSession
    shared = spark.sparkContext.broadcast(heads)

    def keys(batches):
        for batch in batches:
            cells = [c.to_pylist() for c in batch.columns]
            made = [capture_key(u, p) for u, p in zip(*cells)] if by_page else [url_key(u) + " " for u in cells[0]]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["key"])

    def step(batches):
        index, archives, opened = Index(folder, shared.value), _files(f"{folder}/archives"), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = []
                for key in batch.column(0).slice(at, 64).to_pylist():
                    for file, offset, length in index.find(key, prefix=not by_page):
                        if file not in opened:
                            if len(opened) >= 64:
                                opened.pop(next(iter(opened))).close()
                            opened[file] = archives[0].open_input_file(f"{archives[1]}/{file}")
                        found = parse_record(gzip.decompress(opened[file].read_at(length, offset)))
                        head = found["headers"]
                        page, refers = (re.fullmatch(r"<urn:page:(-?\d+)>", head.get(h, "")) for h in ("warc-record-id", "warc-refers-to"))
                        size, sha = _told(head, found)
                        rows.append((page and int(page[1]), head.get("warc-target-uri"), head["warc-type"], size, sha, refers and int(refers[1]), found["payload"]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names)
        for f in opened.values():
            f.close()

    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    asked = wanted.select("url", "page_id") if by_page else wanted.select("url")
    # Addresses that differ only in what a key leaves out have one key.
    dealt = asked.mapInArrow(keys, "key string").distinct()
    ordered = dealt.repartitionByRange(max(len(heads), spark.sparkContext.defaultParallelism), "key").sortWithinPartitions("key")
    return ordered.mapInArrow(step, "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary")


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write the archives and the index of ``pages`` to a new shared folder, and read every capture back through the index."""
    folder = new_folder(pages.sparkSession, "warc")
    heads = write_index(write_archives(pages, folder), folder)
    return look_up(pages, folder, heads)


def page_archive(spark: SparkSession, folder: str, heads: list[tuple[str, str]], url: str) -> list:
    """All captures of one address, for interactive use."""
    return look_up(spark.createDataFrame([(url,)], "url string"), folder, heads, by_page=False).collect()
