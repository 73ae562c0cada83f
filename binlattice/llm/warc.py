"""A deterministic sharded WARC writer, and a reader of its archives."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LONG_MIN, cut
from .sharding import MAX_BUCKETS, bucket_of, find_splitters

#: Fixed values of the WARC 1.1 and HTTP formats.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


@dataclass(frozen=True)
class Params:
    """shard_bytes: payload and headers of a shard, which one task writes as a stream. file_bytes: compressed size from which a new file begins.
    least_revisit: bytes a payload has at least to be stored once. date: of all records, so that archives depend on the rows only."""

    shard_bytes: int = 64 << 20
    file_bytes: int = 16 << 20
    least_revisit: int = 100
    date: str = "2024-01-01T00:00:00Z"
    level: int = 6


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _record(fields: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("WARC-Block-Digest", f"sha256:{_sha256(block)}"), ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)  # a gzip member of its own, without a time stamp
    return packer.compress(VERSION + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _name_of(page_id: int | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}/{nth}')}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, nth: int, p: Params) -> bytes:
    """A response record, or a revisit record that holds the HTTP header only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name_of(page_id, digest, nth)), ("WARC-Date", p.date), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if url:
        fields.append(("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=~")))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _name_of(refers_to, digest, 0)), ("X-Refers-To-Page-ID", str(refers_to))]
    return _record(fields, http if revisit else http + payload, p.level)


class _Roller:
    """Writes the records of one shard after the other to files under temporary names."""

    def __init__(self, folder: str, attempt: str, p: Params):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.attempt, self.p = attempt, p
        self.shard, self.number, self.stream = None, 0, None
        self.done: list[dict] = []

    def write(self, shard: int, record: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.number = shard, 0
        elif self.stream and self.size + len(record) > self.p.file_bytes and self.records:
            self.close()
            self.number += 1
        if not self.stream:
            self._open()
        self._put(record)
        self.records += 1

    def _open(self) -> None:
        self.name = f"pages-{self.shard:06d}-{self.number:05d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{self.attempt}"
        self.fs.create_dir(f"{self.folder}/_temporary", recursive=True)
        self.stream = self.fs.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
        self.digest, self.size, self.records = hashlib.sha256(), 0, 0
        info = f"software: binlattice\r\nformat: WARC File Format 1.1\r\nisPartOf: {self.name}\r\n".encode()
        self._put(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _name_of(None, self.name, 0)), ("WARC-Date", self.p.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info, self.p.level))

    def _put(self, record: bytes) -> None:
        self.stream.write(record)
        self.digest.update(record)
        self.size += len(record)

    def close(self) -> None:
        if self.stream:
            self.stream.close()
            self.stream = None
            self.done.append({"shard": self.shard, "file": self.name, "temporary": self.temporary, "bytes": self.size, "sha256": self.digest.hexdigest(), "records": self.records})


#: About what the headers of a record take.
RECORD_BYTES = 600
MANIFEST = "shard int, file string, temporary string, bytes bigint, sha256 string, records bigint"


def _write_batches(batches: Iterator[pa.RecordBatch], folder: str, p: Params) -> Iterator[pa.RecordBatch]:
    roller = _Roller(folder, uuid.uuid4().hex, p)
    target, last, nth = None, None, 0
    for batch in batches:
        columns = [batch.column(c) for c in ("shard", "page_id", "digest", "is_page", "refers_to", "url", "html")]
        for i in range(len(batch)):
            shard, page_id, digest, is_page, refers_to, url, html = (c[i].as_py() for c in columns)
            if not is_page:  # the note that the rows with this id and digest revisit another
                target = (page_id, digest, refers_to)
                continue
            nth = nth + 1 if last == (page_id, digest) else 0
            last = (page_id, digest)
            to = target[2] if target and target[:2] == last else None
            roller.write(shard, page_record(page_id, url, (html or "").encode(), digest, to, nth, p))
    roller.close()
    if roller.done:
        yield pa.RecordBatch.from_pylist(roller.done, schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("temporary", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("records", pa.int64())]))


def _commit_batches(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, root = pafs.FileSystem.from_uri(folder)
    for batch in batches:
        for row in batch.to_pylist():
            final, temporary = f"{root}/{row['file']}", f"{root}/{row['temporary']}"
            # an earlier attempt of this task may have renamed it
            if fs.get_file_info(temporary).type != pafs.FileType.NotFound:
                fs.move(temporary, final)
            if fs.get_file_info(final).size != row["bytes"]:
                raise OSError(f"{final} is not {row['bytes']} bytes")
        yield batch


def write_archives(pages: DataFrame, folder: str, params: Params = Params()) -> DataFrame:
    """Write a record for every row of (page_id, url, html) to ``folder`` and return the manifest.

    Rows are range-sorted by page_id and digest into shards of about ``shard_bytes``, whose
    bounds come from exact counts of bytes below candidate keys; a task
    writes a shard's records in order and begins a new file when the next record would
    take the compressed file over ``file_bytes``. Headers and digests are made
    anew. The archives' bytes depend on the rows and parameters only. Beyond
    MAX_BUCKETS shards (4 TB with the default size) shards grow instead; a task streams them.

    Of rows with equal payloads of ``least_revisit`` bytes or more, those with the
    smallest page_id are responses and the others revisit it; which is found on ids and
    digests alone. Payloads move once: notes of (id, digest, refers_to) are sorted
    in right before the pages they are about.

    Commit: files get temporary names, unique to a task attempt. The rows that
    attempts report become a staged manifest; files listed there are renamed,
    then the manifest is written, and only files it lists belong to the archive. A lost
    executor's or a doubled attempt's files are in no manifest and are
    removed with the temporary folder.

    Defined cases: null html is an empty payload; rows with a null page_id come
    first and are always responses; rows that share an id are told apart, and may be
    dealt to several shards, by their digests; rows equal in id and payload are written each, in one shard;
    a task holds a few whole records, so a page may be as long as its memory allows;
    a url is percent-encoded where a header doesn't allow it, null or empty
    gives no target; no rows give an empty manifest; other columns aren't used.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    digest = F.sha2(html, 256)
    # the place of a record: by id, within an id by a hash of the digest
    place = [F.coalesce(F.col("page_id").cast("bigint"), F.lit(LONG_MIN)).alias("k0"), F.xxhash64("digest").alias("k1")]
    facts = pages.select(F.col("page_id").cast("bigint").alias("page_id"), digest.alias("digest"), F.octet_length(html).cast("bigint").alias("n"))
    facts = cut(facts.select("*", *place, (F.col("n") + RECORD_BYTES).alias("size")), "page-digests")
    total = facts.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    n_shards = max(1, min(-(-total // params.shard_bytes), MAX_BUCKETS))
    targets = [i * total / n_shards for i in range(1, n_shards)]
    bounds = sorted(find_splitters(facts.select("k0", "k1", "size"), targets, 0.1 * total / n_shards).bounds)

    large = facts.where((F.col("n") >= params.least_revisit) & F.col("page_id").isNotNull())
    copied = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last")
    notes = large.join(copied, "digest").where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), digest.alias("digest"), F.lit(True).alias("is_page"), F.lit(None).cast("bigint").alias("refers_to"), "url", "html")
    rows = rows.unionByName(notes.select("*", F.lit(False).alias("is_page"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html")))
    dealt = rows.select("*", *place).withColumn("shard", bucket_of(bounds)).repartitionById(n_shards, F.col("shard")).sortWithinPartitions("k0", "k1", "digest", "is_page", "url")
    staged = cut(dealt.select("shard", "page_id", "digest", "is_page", "refers_to", "url", "html").mapInArrow(lambda it: _write_batches(it, folder, params), MANIFEST), "warc-staged")
    committed = staged.mapInArrow(lambda it: _commit_batches(it, folder), MANIFEST).drop("temporary")
    committed.write.parquet(f"{folder}/manifest")
    fs, root = pafs.FileSystem.from_uri(folder)
    if fs.get_file_info(f"{root}/_temporary").type != pafs.FileType.NotFound:
        fs.delete_dir(f"{root}/_temporary")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an archive, one gzip member at a time, block digests checked."""
    unpacker, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(1 << 18)
        if not data:
            if parts or not unpacker.eof and unpacker.unconsumed_tail:
                raise ValueError("the archive ends within a record")
            return
        parts.append(unpacker.decompress(data))
        rest = unpacker.unused_data
        if unpacker.eof:
            head, _, body = b"".join(parts).partition(b"\r\n\r\n")
            if not head.startswith(VERSION.rstrip()):
                raise ValueError("not a WARC record")
            fields = dict(re.findall(r"^([\w-]+): (.*?)\r?$", head.decode(), re.MULTILINE))
            block = body[: int(fields["Content-Length"])]
            if fields["WARC-Block-Digest"] != f"sha256:{_sha256(block)}":
                raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
            yield fields, block
            unpacker, parts = zlib.decompressobj(31), []


READ = "file string, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def _read_batches(batches: Iterator[pa.RecordBatch], folder: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    fs, root = pafs.FileSystem.from_uri(folder)
    kinds = pa.schema([("file", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    for batch in batches:
        for file in batch.column("file").to_pylist():
            rows, held = [], 0
            with fs.open_input_stream(f"{root}/{file}", compression=None) as stream:
                for fields, block in records_of(stream):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    revisit = fields["WARC-Type"] == "revisit"
                    if not revisit and _sha256(payload) != digest:
                        raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
                    n = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    ids = [int(x) if (x := fields.get(k)) else None for k in ("X-Page-ID", "X-Refers-To-Page-ID")]
                    rows.append({"file": file, "page_id": ids[0], "url": fields.get("WARC-Target-URI"), "payload_bytes": n, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": ids[1], "payload": payload if with_payload and not revisit else None})
                    held += len(payload) if with_payload else 64
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The page records of the archives that the manifest in ``folder`` lists, digests checked; a task reads a file at a time."""
    files = spark.read.parquet(f"{folder}/manifest").select("file")
    n = max(1, files.count())
    spread = files.repartition(min(n, 4096), "file")
    return spread.mapInArrow(lambda it: _read_batches(it, folder, with_payload), READ)
