"""Deterministic sharded WARC archives.

Records are range-sorted by id into shards whose borders follow from a histogram of the bytes by id that is refined where
it is heavy, so the same rows give the same files on any cluster, however the ids are spread. A shard is written in order; a file is closed when its compressed size
reaches a limit. Headers and digests are made anew. Each file is written under a temporary name and renamed when
complete; a manifest of names, sizes and digests is written last, and readers read only what the manifest lists.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.llm.common import checkpointed

ROLL_BYTES = 16 << 20
#: A shard holds at most about so many payload bytes, and there are at least so many shards if the rows allow it. Over
#: MAX_SHARDS times that size shards grow with the input; a shard is written as a stream, so its size bounds no memory.
SHARD_BYTES = 64 << 20
MIN_SHARDS = 128
MAX_SHARDS = 16384
#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
#: Bins of the first histogram, and of each heavy bin after that.
_BINS, _SPLIT = 4096, 32
#: A task reads back about so many compressed bytes.
READ_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "file string, shard int, records long, bytes long, sha256 string"


def _record(page_id: int | None, url: str, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One record; a revisit has no block, and names the record and the digest and length of the payload."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {''.join(c if c.isprintable() else '%' + format(ord(c), '02X') for c in url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    """A gzip member without a time stamp."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


class _Files:
    """Rolls the files of one shard at a time."""

    def __init__(self, folder: str, roll: int) -> None:
        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.roll, self.shard, self.serial, self.out = roll, None, 0, None

    def add(self, shard: int, record: bytes) -> list[tuple]:
        done = []
        if self.out is not None and (shard != self.shard or self.size >= self.roll):
            done.append(self.close())
        if shard != self.shard:
            self.shard, self.serial = shard, 0
        if self.out is None:
            self.temp = f"{self.folder}/_temporary/{uuid.uuid4().hex}"
            self.out, self.size, self.count, self.sha = self.fs.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()
        part = _member(record)
        self.out.write(part)
        self.sha.update(part)
        self.size += len(part)
        self.count += 1
        return done

    def close(self) -> tuple:
        self.out.close()
        name = f"shard-{self.shard:06d}-{self.serial:05d}.warc.gz"
        self.fs.move(self.temp, f"{self.folder}/{name}")  # a second attempt puts equal bytes in place
        self.serial += 1
        self.out = None
        return name, self.shard, self.count, self.size, self.sha.hexdigest()


def _at_most(heads: list[int], x: Column) -> Column:
    """How many of the sorted ``heads`` are at most ``x``, by bisection within the row."""
    if not heads:
        return F.lit(0)
    held = F.split(F.lit(",".join(map(str, heads))), ",").cast("array<bigint>")  # folded to a literal
    steps = F.lit([1 << i for i in reversed(range(len(heads).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, s: n + F.when(F.get(held, n + s - 1) <= x, s).otherwise(0))


def _starts(heads: list[int], old: int, width: int) -> Column:
    """First id of the bin of ``width`` ids that holds ``id``, within bins of ``old`` ids that start at ``heads``; null
    outside. Ids may span all longs, so differences are decimals."""
    wide = lambda x: x.cast("decimal(20,0)")
    held = F.split(F.lit(",".join(map(str, heads))), ",").cast("array<bigint>")
    head = wide(F.get(held, _at_most(heads, F.col("id")) - 1))
    off, each = wide(F.col("id")) - head, wide(F.lit(str(width)))
    return F.when(off < wide(F.lit(str(old))), head + F.floor(off / each) * each).cast("long")


def _borders(sized: DataFrame, shard_bytes: int) -> tuple[int, list[int]]:
    """(number of shards for rows without an id, first id of each shard but the first). At most ``_SPLIT`` bins a shard
    come to the driver at a time."""
    low, high, total, loose = sized.agg(F.min("id"), F.max("id"), F.sum("size"), F.sum(F.when(F.col("id").isNull(), F.col("size")))).first()
    total = total or 0
    limit = max(1, min(shard_bytes, total // MIN_SHARDS), total // MAX_SHARDS)
    none = -(-(loose or 0) // limit) or 1
    if low is None:
        return none, []
    bins: dict[int, int] = {}
    heavy, width = [low], high - low + 1
    while heavy:
        old, width = width, -(-width // (_SPLIT if bins else _BINS))
        start = _starts(heavy, old, width).alias("start")
        rows = sized.where("id is not null").select(start, "size").where("start is not null").groupBy("start").agg(F.sum("size").alias("b"))
        finer = {r["start"]: r["b"] for r in rows.collect()}
        bins = {k: v for k, v in bins.items() if k not in set(heavy)} | finer
        heavy = sorted(k for k, v in finer.items() if v > limit) if width > 1 else []  # at most MAX_SHARDS
    borders, filled = [], 0
    for start in sorted(bins):
        if filled >= limit or (filled and filled + bins[start] > limit):
            borders.append(start)
            filled = 0
        filled += bins[start]
    return none, borders


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write a record per row under ``folder`` (a URI that all executors reach) and return the manifest.

    Of equal payloads of at least 1000 bytes the row with the largest id becomes a response record, all others revisit
    it; several such rows with that largest id are all responses. Rows without an id come first, in shards by their
    content, are responses and are not revisited. Null html is an empty payload, a null url an empty one. Repeated rows are records of their
    own. An empty table gives an empty manifest. Other columns are not read.
    """
    spark = pages.sparkSession
    html = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), html.alias("html"))
    sized = checkpointed(rows.select("id", F.octet_length("html").cast("long").alias("size"), F.sha1("html").alias("digest")))
    copies = sized.where((F.col("size") >= REVISIT_BYTES) & F.col("id").isNotNull())
    first = copies.groupBy("digest", "size").agg(F.max("id").alias("to"), F.min("id").alias("least")).where("least < to").drop("least")
    revisits = copies.join(first, ["digest", "size"]).where("id < to").select("id", "digest", "to").distinct()

    none, borders = _borders(sized, shard_bytes)

    spread = F.pmod(F.xxhash64("digest", "url"), F.lit(none)).cast("int")
    shard = F.when(F.col("id").isNull(), spread).otherwise(_at_most(borders, F.col("id")) + none).cast("int")
    # marks of revisits travel with the rows, so pages move once; a mark sorts before the rows with its id
    marks = revisits.select("id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("html"), "digest", "to")
    both = rows.select("id", "url", "html", F.sha1("html").alias("digest"), F.lit(None).cast("long").alias("to")).union(marks).withColumn("shard", shard)
    both = both.repartitionByRange("shard").sortWithinPartitions("shard", F.col("id").asc_nulls_first(), F.col("to").asc_nulls_last(), "url", "digest")
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{path}/_temporary", recursive=True)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, done = _Files(folder, roll_bytes), []
        at, marked = None, {}
        for b in batches:
            for page_id, url, payload, digest, to, shard in zip(*(c.to_pylist() for c in b.columns)):
                if page_id != at:
                    at, marked = page_id, {}
                if to is not None:
                    marked[digest] = to
                    continue
                done += files.add(shard, _record(page_id, url, payload, digest, len(payload), marked.get(digest)))
            if done:
                yield _manifest_batch(done)
                done = []
        if files.out is not None:
            yield _manifest_batch([files.close()])

    listed = both.select("id", "url", "html", "digest", "to", "shard").mapInArrow(written, _MANIFEST)
    listed.write.json(f"{folder}/manifest")
    store.delete_dir(f"{path}/_temporary")
    return spark.read.schema(_MANIFEST).json(f"{folder}/manifest")


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(zip(*rows), kinds)], names=["file", "shard", "records", "bytes", "sha256"])


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file, read piece by piece."""
    z, buffer = zlib.decompressobj(31), bytearray()
    data = b""
    while True:
        data = data or stream.read(1 << 20)
        if not data:
            if buffer:
                raise ValueError("the archive ends within a record")
            return
        buffer += z.decompress(data)
        data = z.unused_data
        if z.eof:
            head, _, rest = bytes(buffer).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            size = int(fields["Content-Length"])
            if not lines[0].startswith("WARC/") or rest[size:] != b"\r\n\r\n":
                raise ValueError("malformed record")
            yield fields, rest[:size]
            z, buffer = zlib.decompressobj(31), bytearray()


def read(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The records of all files that the manifest lists: ``page_id, url, payload_bytes, payload_digest, record_type,
    refers_to`` and, if asked for, ``payload`` (null for a revisit). Digests of payloads and files are checked."""
    manifest = spark.read.schema(_MANIFEST).json(f"{folder}/manifest")
    files, size = manifest.agg(F.count("*"), F.sum("bytes")).first()
    tasks = max(1, min(files, max(spark.sparkContext.defaultParallelism, -(-(size or 0) // READ_BYTES))))
    listed = manifest.select("file", "sha256").repartition(tasks)  # a stated number, which is not merged at run time
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] * payloads)]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())[: len(names)]

    def page(urn: str | None) -> int | None:
        name = (urn or "none").strip("<>").rpartition(":")[2]
        return None if name == "none" else int(name)

    class Summed:
        def __init__(self, raw) -> None:
            self.raw, self.sha = raw, hashlib.sha256()

        def read(self, n: int) -> bytes:
            data = self.raw.read(n)
            self.sha.update(data)
            return data

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for b in batches:
            for file, sha in zip(*(c.to_pylist() for c in b.columns)):
                rows, held = [], 0
                with store.open_input_stream(f"{path}/{file}", compression=None) as raw:
                    stream = Summed(raw)
                    for head, block in _records(stream):
                        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and hashlib.sha1(block).hexdigest() != digest:
                            raise ValueError(f"{file}: the payload of {head['WARC-Record-ID']} differs from its digest")
                        row = (page(head["WARC-Record-ID"]), head["WARC-Target-URI"], int(head["WARC-Payload-Length"]), digest, kind, page(head.get("WARC-Refers-To")))
                        rows.append((*row, block if kind == "response" else None)[: len(names)])
                        held += len(block) * payloads + 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(zip(*rows), kinds)], names=names)
                            rows, held = [], 0
                if stream.sha.hexdigest() != sha:
                    raise ValueError(f"{file} differs from the manifest")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(zip(*rows), kinds)], names=names)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    return listed.mapInArrow(found, schema)
