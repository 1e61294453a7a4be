"""WARC archives compressed record by record with a Zstandard dictionary of their own.

A task opens an archive, builds a dictionary from its first records, writes it in a leading skippable
frame and every record as one frame after it. Equal payloads are stored once: other records of the same
payload are ``revisit`` records that refer to the response.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdcatalog.llm.common import as_table, cut_lineage, shared_folder, sized_join, small_batches, text_or_empty

#: Payloads below this are always stored.
REVISIT_MIN = 100
#: Uncompressed bytes after which a task begins another archive, and of the records its dictionary is built from.
ARCHIVE_BYTES = 64 << 20
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 48 << 10
LEVEL = 3

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:mdcatalog:page")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def record_id(page_id: int | None, payload_digest: str) -> str:
    """The same page with the same payload always gets the same record id."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id} {payload_digest}')}>"


def encode(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, revisit: bool, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit keeps the header of the response, and so its length, without the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, payload_digest)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{payload_digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, payload_digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]):
    """A dictionary from the given records, or None where there are too few to build one."""
    import zstandard

    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 8)
    if len(records) < 16 or size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, records, k=256, d=8)
    except zstandard.ZstdError:
        return None


class Archive:
    """Writes one archive; records wait in memory until the dictionary is built from them."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, path = fs.FileSystem.from_uri(self.uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)
        self.waiting: list[bytes] | None = []
        self.raw = self.records = self.stored = 0

    def add(self, record: bytes) -> None:
        self.raw += len(record)
        self.records += 1
        if self.waiting is None:
            self._write(self.compressor.compress(record))
            return
        self.waiting.append(record)
        if self.raw >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        import zstandard

        built = build_dictionary([r for r in self.waiting if len(r) < SAMPLE_BYTES])
        if built is not None:
            content = built.as_bytes()
            self._write(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
            built.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=built, write_checksum=True)
        waiting, self.waiting = self.waiting, None
        for record in waiting:
            self._write(self.compressor.compress(record))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.stored += len(data)

    def close(self) -> tuple[str, int, int, int]:
        if self.waiting is not None:
            self._begin()
        self.out.close()
        return self.uri, self.records, self.raw, self.stored


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with scheme and authority, as every executor resolves it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/+", "file:///", uri)


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """(page_id, url, html, payload_digest, revisit, refers_to) per row of ``pages``.

    Of equal payloads of at least ``REVISIT_MIN`` bytes, rows with the smallest page id are responses (all
    of them if that row is repeated), the others revisit it; a null id counts as the largest.
    """
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), text_or_empty(markup).alias("html"))
    rows = rows.withColumn("payload_digest", F.sha2("html", 256))
    repeated = cut_lineage(rows.where(F.octet_length("html") >= REVISIT_MIN).groupBy("payload_digest")
                           .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
                           .select("payload_digest", "first"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (sized_join(rows, repeated, ["payload_digest"], "left")
            .select("page_id", "url", "html", "payload_digest", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, date: str = DATE, **columns: str) -> DataFrame:
    """Write ``pages`` as archives below ``folder`` and return the manifest: (archive, records, raw_bytes, stored_bytes).

    Each task names its archives anew, so an attempt that is lost or repeated leaves files that no
    manifest row names. An empty table gives no archive.
    """
    small_batches(pages.sparkSession)
    target = qualified(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            for page_id, url, text, payload_digest, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                archive = archive or Archive(target)
                archive.add(encode(page_id, url, text.encode(), payload_digest, revisit, refers_to, date))
                if archive.raw >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*done), (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                                             names=["archive", "records", "raw_bytes", "stored_bytes"])

    return as_table(plan_records(pages, **columns).mapInArrow(run, "archive string, records bigint, raw_bytes bigint, stored_bytes bigint"))


def records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of an archive, one at a time."""
    import zstandard
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_stream(path, compression=None) as raw:
        head = raw.read(8)
        dictionary, rest = None, head
        if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_MAGIC:
            content, rest = raw.read(struct.unpack("<I", head[4:])[0]), b""
            if struct.unpack("<I", content[:4])[0] == ZSTD_MAGIC:
                content = zstandard.ZstdDecompressor().decompress(content)
            dictionary = zstandard.ZstdCompressionDict(content)

        class Rest(io.RawIOBase):
            def readable(self):
                return True

            def readinto(self, into):
                nonlocal rest
                data, rest = (rest, b"") if rest else (raw.read(len(into)), b"")
                into[:len(data)] = data
                return len(data)

        stream = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(io.BufferedReader(Rest(), 1 << 16), read_across_frames=True)
        lines = io.BufferedReader(stream, 1 << 16)
        while line := lines.readline():
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record where one should begin: {line[:40]!r}")
            fields = {}
            while (line := lines.readline().rstrip(b"\r\n")):
                name, _, value = line.decode("utf-8", "surrogatepass").partition(": ")
                fields[name.lower()] = value
            block = lines.read(int(fields["content-length"]))
            if lines.read(4) != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            yield fields, block


def _read(uri: str) -> Iterator[tuple]:
    for fields, block in records(uri):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        payload_digest, revisit = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"] == "revisit"
        if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != payload_digest):
            raise ValueError(f"a payload of {uri} does not match its digest")
        number = lambda x: None if x is None else int(x)
        yield (number(fields.get("x-page-id")), fields.get("warc-target-uri"), size, payload_digest, fields["warc-type"],
               number(fields.get("x-refers-to-page-id")), None if revisit else payload.decode())


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives of a manifest; each payload is checked against its digest.

    (page_id, url, payload_bytes, payload_digest, record_type, refers_to[, html]); ``html`` is null for revisits.
    One archive is one unit of work; archives are bounded by ``ARCHIVE_BYTES``.
    """
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()][:7 if payloads else 6]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"][:len(kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, weight = [], 0
                for row in _read(uri):
                    rows.append(row[:len(kinds)])
                    weight += 200 + len(row[6] or "") * payloads
                    if weight > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, weight = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    tasks = max(1, manifest.count())
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return manifest.select("archive").repartition(tasks, "archive").mapInArrow(run, schema + ", html string" * payloads)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as archives (below the shared folder unless named) and read them back."""
    return read_archives(write_archives(pages, folder or shared_folder(pages.sparkSession, "warc")), payloads=False)
