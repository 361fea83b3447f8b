"""WARC archives as seekable Zstandard bundles.

Every record is a WARC/1.1 record.  Records are grouped into frames of about ``frame_bytes``
that decompress on their own; a bundle is frames one after another and, at its end, a seek
table in a skippable frame (compressed and raw size of each frame, number of frames, magic
number), so any Zstandard reader can read a bundle from front to back, and a reader of the
footer can jump to a frame.  The manifest maps each record identifier to bundle, frame and
the record's offset and length inside the raw frame.

Executors write bundles into the shared folder under names of their own; the manifest, which
Spark commits, names only bundles of tasks that succeeded, so a task that runs again after a
lost executor leaves at most a file that nothing refers to.

Defined results: null html is an empty payload; a null url is an empty target; rows that repeat
a page_id are records of their own (if they carry the largest page_id of their payload, each is
a response); a null page_id never is the largest; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import scratch, table

# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

MIN_REVISIT_BYTES = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 28

MANIFEST = ("bundle string, frame int, frame_offset long, frame_bytes long, raw_bytes long, "
            "records array<struct<page_id:long,offset:long,length:long>>")
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, payload binary")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit holds the HTTP header alone, whose Content-Length is the payload's."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() if revisit else http.encode() + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """The inverse of ``record_bytes``, as a row of RECORDS."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = rest[: int(fields[b"Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
    number = lambda x: int(x) if (x := x[len(b"<urn:page:"):-1]) else None
    kind = fields[b"WARC-Type"].decode()
    return (number(fields[b"WARC-Record-ID"]), fields[b"WARC-Target-URI"].decode("utf-8", "surrogatepass"), length,
            fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"), kind,
            number(fields[b"WARC-Refers-To"]) if kind == "revisit" else None, body if kind == "response" else None)


class _Bundle:
    """A bundle that is being written."""

    def __init__(self, folder: str, frame_bytes: int):
        self.uri, self.frame_bytes = f"{folder}/{uuid.uuid4().hex}.warc.zst", frame_bytes
        fs, path = filesystem(self.uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.at, self.sizes = fs.open_output_stream(path, compression=None), 0, []
        self.parts, self.raw, self.index = [], 0, []

    def add(self, page_id, record: bytes) -> list[tuple]:
        self.index.append({"page_id": page_id, "offset": self.raw, "length": len(record)})
        self.parts.append(record)
        self.raw += len(record)
        return self.flush() if self.raw >= self.frame_bytes else []

    def flush(self) -> list[tuple]:
        if not self.parts:
            return []
        packed = zstandard.ZstdCompressor(level=3).compress(b"".join(self.parts))
        self.out.write(packed)
        row = (self.uri, len(self.sizes), self.at, len(packed), self.raw, self.index)
        self.sizes.append((len(packed), self.raw))
        self.at += len(packed)
        self.parts, self.raw, self.index = [], 0, []
        return [row]

    def close(self) -> list[tuple]:
        rows = self.flush()
        table_ = b"".join(struct.pack("<II", *s) for s in self.sizes)
        foot = table_ + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(foot)) + foot)
        self.out.close()
        return rows


def seek_table(uri: str) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, raw bytes) of each frame, from the footer of a bundle."""
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        n, _, magic = struct.unpack("<IBI", f.read_at(9, f.size() - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"no seek table in {uri}")
        sizes = struct.unpack(f"<{2 * n}I", f.read_at(8 * n, f.size() - 9 - 8 * n))
    out, at = [], 0
    for packed, raw in zip(sizes[::2], sizes[1::2], strict=True):
        out.append((at, packed, raw))
        at += packed
    return out


def with_decisions(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null: a response).

    The largest page_id of each repeated payload is found by a partial and a final aggregate over
    digests; only payloads that do repeat join back, and a payload that a third of all pages share
    is a skewed join side that Spark splits.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long_enough = F.octet_length("payload") >= min_bytes
    groups = (rows.where(long_enough).groupBy("digest")
              .agg(F.max("page_id").alias("__last"), F.count(F.lit(1)).alias("__n"))
              .where("__n > 1 and __last is not null").select(F.col("digest").alias("__digest"), "__last"))
    refers = F.when(F.col("page_id").eqNullSafe(F.col("__last")), None).otherwise(F.col("__last"))
    return (rows.join(groups, (F.col("digest") == F.col("__digest")) & long_enough, "left")
            .select("page_id", "url", "payload", "digest", refers.alias("refers_to")))


def write_archive(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
                  min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as bundles under ``folder``/bundles; return the manifest, one row per frame."""
    bundles = f"{folder}/bundles"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["bundle", "frame", "frame_offset", "frame_bytes", "raw_bytes", "records"]
        bundle = None
        for batch in batches:
            rows: list[tuple] = []
            refs = batch["refers_to"].astype(object).where(batch["refers_to"].notna(), None)
            ids = batch["page_id"].astype(object).where(batch["page_id"].notna(), None)
            for page_id, url, payload, digest, ref in zip(ids, batch["url"], batch["payload"], batch["digest"], refs, strict=True):
                page_id, ref = (None if x is None else int(x) for x in (page_id, ref))
                bundle = bundle or _Bundle(bundles, frame_bytes)
                rows += bundle.add(page_id, record_bytes(page_id, url, bytes(payload), digest, ref))
                if bundle.at >= bundle_bytes:
                    rows += bundle.close()
                    bundle = None
            yield pd.DataFrame(rows, columns=columns)
        if bundle:
            yield pd.DataFrame(bundle.close(), columns=columns)

    manifest = f"{folder}/manifest"
    with_decisions(pages, min_bytes).mapInPandas(write, MANIFEST).write.parquet(manifest)
    return pages.sparkSession.read.schema(MANIFEST).parquet(manifest)


def _read_frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in RECORDS.split(", ")]
    for batch in batches:
        for bundle, frames in batch.groupby("bundle", sort=False):
            fs, path = filesystem(bundle)
            with fs.open_input_file(path) as f:
                for x in frames.itertuples():
                    raw = zstandard.ZstdDecompressor().decompress(
                        f.read_at(int(x.frame_bytes), int(x.frame_offset)), max_output_size=int(x.raw_bytes))
                    rows = [parse_record(raw[r["offset"]: r["offset"] + r["length"]]) for r in x.records]
                    out = pd.DataFrame(rows, columns=columns)
                    for c in ("page_id", "refers_to"):
                        out[c] = out[c].astype("Int64")
                    yield out


def read_archive(manifest: DataFrame) -> DataFrame:
    """All records of the frames in ``manifest``; each task seeks to its own frames and decompresses only these."""
    spark = manifest.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "bundle", "frame").mapInPandas(_read_frames, RECORDS)


def lookup(manifest: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of the page identifiers in ``ids`` (page_id): only the frames that hold them are read."""
    at = manifest.select("*", F.explode("records").alias("__r")).join(
        ids.select(F.col("page_id").alias("__id")).distinct(), F.col("__r.page_id") == F.col("__id"), "left_semi")
    own = at.groupBy("bundle", "frame", "frame_offset", "frame_bytes", "raw_bytes").agg(
        F.collect_list("__r").alias("records"))
    return read_archive(own.select(*manifest.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page, read the archive back; the digest is computed anew from the payload that was read."""
    manifest = write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), scratch(spark, "warc"))

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            own = [d if p is None else hashlib.sha1(p).hexdigest() for p, d in zip(b["payload"], b["payload_digest"], strict=True)]
            yield b.drop(columns=["payload", "url"]).assign(payload_digest=own)

    out = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return read_archive(manifest).mapInPandas(digests, out)


SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= {MIN_REVISIT_BYTES} AND last IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {MIN_REVISIT_BYTES} AND last IS DISTINCT FROM page_id THEN last END AS refers_to
FROM q
"""
