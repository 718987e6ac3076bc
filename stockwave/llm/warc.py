"""WARC archives of Zstandard-compressed records that share a dictionary.

Each archive starts with a skippable frame that embeds a dictionary built from the archive's own
records; every record is a Zstandard frame of its own. Spark's text writer puts the frames into files:
its line separator is an empty skippable frame, which readers of Zstandard pass over, so any
file system Spark writes to will do, and the files of failed or repeated tasks are never seen. An archive is one
task's work, whose size is bounded in payload bytes and in records.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwave.llm.common import table
from stockwave.session import scratch_path, stage

# --- fixed values: frame numbers of the Zstandard format and of WARC files that embed a dictionary --
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
SEPARATOR = "P*M\x18\0\0\0\0"  # an empty skippable frame, 0x184D2A50 and length 0
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 128_000_000  # of records per archive, about
LEAST_ARCHIVE_BYTES = 16_000_000  # smaller archives, while there are fewer than cores can take several of
ARCHIVES_PER_CORE = 4
HEADER_BYTES = 500  # of a record, about
DICTIONARY_BYTES = 65_536
SAMPLE_BYTES = 4_000_000  # records an archive's dictionary is built from: the first of these bytes
LEVEL = 6
WARC_DATE = "2024-01-01T00:00:00Z"
CHUNK = 16_384


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, n_bytes, first: the response each page repeats, null for responses.

    Payloads are compared by SHA-256. Digests are grouped without the pages, and only pages that
    repeat another one are listed, so a payload held by many pages meets no page in one task. The
    result is dealt by (page_id, digest) over as many partitions as there are archives to write.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n_bytes"))
    rows = rows.withColumn("key", F.concat_ws(":", F.col("page_id").cast("string"), F.col("digest")))
    keys = stage(rows.select("page_id", "digest", "n_bytes", "key"), "warc-keys")
    long_enough = keys.where(F.col("n_bytes") >= MIN_REVISIT_BYTES)
    firsts = long_enough.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    repeats = long_enough.distinct().join(firsts, "digest").where("page_id is null or page_id <> first").select("key", "first")
    total = keys.agg(F.sum(F.col("n_bytes") + HEADER_BYTES)).head()[0] or 0
    return rows.repartition(n_archives(total, pages.sparkSession.sparkContext.defaultParallelism), "key").join(repeats, "key", "left").drop("key")


def n_archives(total: int, cores: int) -> int:
    """Archives for ``total`` bytes of records: full ones, or smaller ones where all cores would not have some."""
    return max(1, math.ceil(total / ARCHIVE_BYTES), min(math.ceil(total / LEAST_ARCHIVE_BYTES), ARCHIVES_PER_CORE * cores))


def header_safe(value: object) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(value))


def record_id(page_id: object, digest: str, nth: int) -> str:
    """Names the page in escaped form; nothing stands for a null id, a bare % for an empty one."""
    named = "" if page_id is None else quote(str(page_id), safe="", errors="replace") or "%"
    return f"<urn:x-page:{named}:{digest[:32]}:{nth}>"


def record(page_id: object, url: str | None, payload: bytes, digest: str, first: object, nth: int, date: str) -> bytes:
    """One response record, or a revisit of the page ``first`` that has HTTP headers but no payload."""
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest, nth)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url:
        fields.append(("WARC-Target-URI", header_safe(url)))
    if first is not None:
        fields += [("WARC-Refers-To", record_id(first, digest, 0)), ("WARC-Profile", REVISIT_PROFILE)]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += payload if first is None else b""
    fields.append(("Content-Length", len(block)))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from records; None where they are too few or too small to build one."""
    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 10)
    if size < 512 or len(records) < 8:
        return None
    try:
        return zstandard.train_dictionary(size, records, k=256, d=8)
    except zstandard.ZstdError:
        return None


def frames(batches: Iterator[pd.DataFrame], date: str = WARC_DATE) -> Iterator[pd.DataFrame]:
    """The frames of one archive: the dictionary, then one per record. Holds SAMPLE_BYTES of records at most."""
    waiting: list[bytes] = []
    n_waiting, packer = 0, None
    seen: dict[tuple, int] = {}

    def flush() -> list[bytes]:
        nonlocal packer
        out = []
        if packer is None:
            words = build_dictionary(waiting)
            if words:
                own = zstandard.ZstdCompressor(level=19).compress(words.as_bytes())
                out.append(struct.pack("<II", DICTIONARY_FRAME, len(own)) + own)
            packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_checksum=True)
        out += map(packer.compress, waiting)
        waiting.clear()
        return out

    for batch in batches:
        for page_id, url, html, digest, n_bytes, first in zip(*[batch[c] for c in ("page_id", "url", "html", "digest", "n_bytes", "first")]):
            page_id, first = (None if pd.isna(x) else x if isinstance(x, str) else int(x) for x in (page_id, first))
            nth = seen.get((page_id, digest), 0)
            seen[page_id, digest] = nth + 1
            if nth and first is None and page_id is not None and n_bytes >= MIN_REVISIT_BYTES:
                first = page_id  # the same row again
            made = record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), digest, first, nth, date)
            waiting.append(made)
            n_waiting += len(made)
        if packer is not None or n_waiting >= SAMPLE_BYTES:
            yield pd.DataFrame({"frame": flush()})
    if waiting:
        yield pd.DataFrame({"frame": flush()})


def write_archives(pages: DataFrame, path: str, named: bool = False) -> None:
    """Writes ``pages`` (page_id, url, html) below ``path``, a new folder, one archive per file ``part-*``.

    One record per row. Null html is an empty payload, null urls have no target field; of rows equal
    in page_id and payload the first written is the response. Pages without id repeat pages with one,
    never the other way round. Ids are whole numbers or strings. An empty table writes no archive. Other columns are not read.
    Spark's text writer names the files; ``named`` has the driver rename them to ``part-*.warc.zst``, some
    at a time, for tools that go by names: one call per archive, which on object stores is a copy.
    """
    made = with_revisits(pages).mapInPandas(frames, "frame binary").select(F.col("frame").cast("string").alias("value"))
    made.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 0).text(path)
    if not named:
        return
    spark = pages.sparkSession
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = new_path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    parts = [name for name in names if name.startswith("part-")]
    with ThreadPoolExecutor(16) as pool:
        done = list(pool.map(lambda name: files.rename(new_path(folder, name), new_path(folder, name.removesuffix(".txt") + ".warc.zst")), parts))
    if not all(done):
        raise OSError(f"archives below {path} could not be renamed")


def read_frames(content: memoryview) -> Iterator[bytes]:
    """The records of one archive."""
    at, unpacker = 0, zstandard.ZstdDecompressor()
    while at + 8 <= len(content):
        magic, size = struct.unpack_from("<II", content, at)
        if magic in SKIPPABLE:
            own = bytes(content[at + 8 : at + 8 + size])
            if magic == DICTIONARY_FRAME and size:
                if struct.unpack_from("<I", own)[0] == ZSTD_MAGIC:
                    own = zstandard.ZstdDecompressor().decompressobj().decompress(own)
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(own))
            at += 8 + size
            continue
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            part = content[at : at + CHUNK]
            if not len(part):
                raise ValueError("an archive ends within a record")
            parts.append(frame.decompress(part))
            at += len(part) - len(frame.unused_data)
        yield b"".join(parts)


def parse(data: bytes) -> tuple:
    """record_id, record_type, target_uri, refers_to, payload_bytes, payload_digest, payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response":
        n_bytes, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if digest != told:
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload is damaged")
    else:
        n_bytes, digest, payload = int(http.decode().rpartition("Content-Length: ")[2]), told, None
    return fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("WARC-Target-URI"), fields.get("WARC-Refers-To"), n_bytes, digest, payload


RECORD = "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of the archives below ``path``; payloads are checked against their digests."""
    columns = [part.split()[0] for part in RECORD.split(", ")]
    keep = columns if with_payload else columns[:-1]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for data in read_frames(memoryview(content)):
                    rows.append(parse(data)[: len(keep)])
                    size += len(data) if with_payload else 300
                    if size >= SAMPLE_BYTES:
                        yield pd.DataFrame(rows, columns=keep)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=keep)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(read, ", ".join(RECORD.split(", ")[: len(keep)]))


def page_of(record: str, kind: str = "long") -> F.Column:
    """The page a record id names, as ``kind``; null where the page had no id."""
    named = F.regexp_extract(record, "^<urn:x-page:([^:]*):", 1)
    return F.when(named == "%", "").when(named != "", F.url_decode(named)).cast(kind)


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, folder, "pages"), path)
    found = read_archives(spark, path, with_payload=False)
    return found.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))


OP2_SQL = """
with keyed as (select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as digest from pages),
firsts as (select digest, min(page_id) as first from keyed where n >= 100 group by digest)
select k.page_id, k.n::bigint as payload_bytes, k.digest as payload_digest,
  case when k.n >= 100 and k.page_id <> f.first then 'revisit' else 'response' end as record_type,
  case when k.n >= 100 and k.page_id <> f.first then f.first end as refers_to
from keyed k left join firsts f on k.digest = f.digest
"""
