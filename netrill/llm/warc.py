"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames and a seek table in a skippable frame
at its end (frame sizes, packed and unpacked). Each task writes its records to bundles of
bounded size and returns, for each record, bundle, frame and place inside the frame; with
the seek table a reader finds any record by reading one frame.

Files go through Arrow's file systems, so the folder may be any URL they know and must be
shared by all executors. A bundle gets its final name when it is complete; a task that
runs again writes bundles of new names and only those of the attempt that ended well are
in the index.

Edge cases: null html is an empty payload; of equal payloads with equal largest page_id
one row, the first by url, is the response; a null page_id counts as smaller than any
other; repeated rows are records of their own; an empty table gives no bundle and an
empty result; further columns are not read. A payload longer than a frame has a frame
of its own.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from netrill.llm.common import table, written
from netrill.session import shared_folder

#: Unpacked bytes of a frame and packed bytes of a bundle at which the next one begins.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 64 << 20
LEVEL = 3
#: Numbers of the seekable format (fixed values).
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(
    record_id: str,
    uri: str,
    page_id: int | None,
    payload: bytes,
    length: int,
    digest: str,
    refers_to: tuple | None,
) -> bytes:
    """One WARC/1.1 record; a revisit (`refers_to`: (page_id,)) has headers only."""
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in uri)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(length)),
    ]
    body = payload
    if refers_to is not None:
        body = b""
        headers += [
            ("WARC-Profile", PROFILE),
            ("X-Refers-To-Page-ID", "" if refers_to[0] is None else str(refers_to[0])),
        ]
    headers += [("Content-Type", "text/html"), ("Content-Length", str(len(body)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in headers) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record that starts at `at`."""
    stop = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:stop].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) for line in lines)
    begin = stop + 4
    end = begin + int(headers["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} doesn't end where it should")
    return headers, data[begin:end], end + 4


class BundleWriter:
    """Frames and seek table of one bundle."""

    def __init__(self, system, path: str):
        import zstandard

        self.system, self.path = system, path
        self.partial = f"{path}.{uuid.uuid4().hex}.partial"
        self.out = system.open_output_stream(self.partial)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.size, self.open = 0, bytearray()

    def add(self, record: bytes) -> tuple[int, int]:
        """Number of the frame and place in it."""
        if self.open and len(self.open) + len(record) > FRAME_BYTES:
            self.end_frame()
        place = len(self.open)
        self.open += record
        return len(self.frames), place

    def end_frame(self) -> None:
        packed = self.packer.compress(bytes(self.open))
        self.out.write(packed)
        self.frames.append((len(packed), len(self.open)))
        self.size += len(packed)
        self.open.clear()

    def close(self) -> None:
        if self.open:
            self.end_frame()
        entries = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        self.system.move(self.partial, self.path)


class BundleReader:
    """Reads single frames by the seek table."""

    def __init__(self, system, path: str):
        import zstandard

        self.file = system.open_input_file(path)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        entries = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.frames, start = [], 0
        for packed, unpacked in struct.iter_unpack("<II", entries):
            self.frames.append((start, packed, unpacked))
            start += packed
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        start, packed, unpacked = self.frames[number]
        data = self.unpacker.decompress(self.file.read_at(packed, start), max_output_size=unpacked)
        if len(data) != unpacked:
            raise ValueError(f"frame {number} has {len(data)} bytes, not {unpacked}")
        return data

    def close(self) -> None:
        self.file.close()


def _system(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


INDEX = "record_id string, page_id bigint, bundle string, frame int, place int, length int"


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(folder)
        system.create_dir(base, recursive=True)
        bundle, name = None, ""
        # The rows of a bundle go out when it is complete.
        rows: list[tuple] = []

        def ended() -> pa.RecordBatch:
            bundle.close()
            out = pa.RecordBatch.from_pandas(
                pd.DataFrame(rows, columns=["record_id", "page_id", "bundle", "frame", "place", "length"]),
                schema=pa.schema(
                    [
                        ("record_id", pa.string()),
                        ("page_id", pa.int64()),
                        ("bundle", pa.string()),
                        ("frame", pa.int32()),
                        ("place", pa.int32()),
                        ("length", pa.int32()),
                    ]
                ),
                preserve_index=False,
            )
            rows.clear()
            return out

        for batch in batches:
            names = ("page_id", "url", "digest", "length", "html", "revisit", "refers_to")
            columns = [batch.column(name).to_pylist() for name in names]
            for page_id, url, digest, length, html, revisit, refers_to in zip(*columns, strict=True):
                if bundle is None:
                    name = f"bundle-{uuid.uuid4().hex}.warc.zst"
                    bundle = BundleWriter(system, f"{base}/{name}")
                ident = str(uuid.uuid4())
                record = record_bytes(
                    ident,
                    url,
                    page_id,
                    (html or "").encode(),
                    length,
                    base64.b32encode(bytes.fromhex(digest)).decode(),
                    (refers_to,) if revisit else None,
                )
                frame, place = bundle.add(record)
                rows.append((ident, page_id, name, frame, place, len(record)))
                if bundle.size >= BUNDLE_BYTES:
                    yield ended()
                    bundle = None
        if bundle is not None:
            yield ended()

    return run


def with_types(pages: DataFrame) -> DataFrame:
    """page_id, url, digest, length, html, revisit, refers_to; html is null for revisits.

    Types are found without payloads. Payloads are shuffled once, equal ones of a task
    together, and only to the response that holds them.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.sha1(html).alias("digest"),
        html.alias("html"),
    )
    slim = rows.select("page_id", "url", "digest", F.octet_length("html").cast("long").alias("length"))
    # max() passes over nulls, so refers_to is null only where all page_ids are.
    top = slim.groupBy("digest").agg(F.max("page_id").alias("refers_to"))
    joined = slim.join(top, "digest")
    same = F.col("page_id").eqNullSafe(F.col("refers_to"))
    # Ties: among rows of the largest page_id, the first by url. Only they are ranked.
    tied = W.partitionBy("digest", "page_id").orderBy("url")
    heads = joined.where(same).withColumn("revisit", F.row_number().over(tied) > 1)
    payloads = rows.groupBy("digest").agg(F.first("html").alias("html"))
    responses = heads.where("not revisit").join(payloads, "digest")
    others = heads.where("revisit").unionByName(joined.where(~same).withColumn("revisit", F.lit(True)))
    out = responses.unionByName(others.withColumn("html", F.lit(None).cast("string")))
    return out.select("page_id", "url", "digest", "length", "html", "revisit", "refers_to")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for each page; the index of records, not yet run."""
    return with_types(pages).mapInArrow(_writer(folder), INDEX)


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string"


def _number(text: str) -> int | None:
    return int(text) if text else None


def _reader(folder: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _system(folder)
        reader, name = None, ""
        for part in frames:
            rows = []
            for bundle, number, places, idents in zip(
                part["bundle"], part["frame"], part["places"], part["idents"], strict=True
            ):
                if bundle != name:
                    if reader is not None:
                        reader.close()
                    reader, name = BundleReader(system, f"{base}/{bundle}"), bundle
                data = reader.frame(number)
                for place, ident in zip(places, idents, strict=True):
                    headers, block, _ = parse_record(data, place)
                    if headers["WARC-Record-ID"] != f"<urn:uuid:{ident}>":
                        raise ValueError(f"record {ident} isn't where the index says")
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    length = int(headers["X-Payload-Length"])
                    kind = headers["WARC-Type"]
                    if kind == "response" and (len(block) != length or digest_of(block) != digest):
                        raise ValueError(f"payload of record {ident} isn't what its header says")
                    refers = _number(headers.get("X-Refers-To-Page-ID", ""))
                    rows.append((_number(headers["X-Page-ID"]), length, digest, kind, refers, ident))
            out = pd.DataFrame(
                rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
            )
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})
        if reader is not None:
            reader.close()

    return run


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Read every indexed record back, frame by frame; payload digests are made anew."""
    frames = index.groupBy("bundle", "frame").agg(
        F.sort_array(F.collect_list(F.struct("place", "record_id"))).alias("records")
    )
    frames = frames.select("bundle", "frame", "records.place", "records.record_id").toDF(
        "bundle", "frame", "places", "idents"
    )
    return frames.mapInPandas(_reader(folder), READ)


def query(spark: SparkSession, folder: str) -> DataFrame:
    archives = shared_folder(spark, "warc")
    index = written(write_archives(table(spark, folder, "pages"), archives), "warc-index")
    return read_archives(index, archives).drop("record_id")


SQL = """
with p as (
  select row_number() over () as rn, page_id, coalesce(url, '') as url, coalesce(html, '') as html from pages
), d as (select *, sha1(html) as hex from p),
r as (
  select *, row_number() over (partition by hex order by page_id desc nulls last, url) as place,
    first_value(page_id) over (partition by hex order by page_id desc nulls last, url) as top
  from d
), bits as (
  select rn, string_agg(substr('0000' || case c
      when '0' then '0000' when '1' then '0001' when '2' then '0010' when '3' then '0011'
      when '4' then '0100' when '5' then '0101' when '6' then '0110' when '7' then '0111'
      when '8' then '1000' when '9' then '1001' when 'a' then '1010' when 'b' then '1011'
      when 'c' then '1100' when 'd' then '1101' when 'e' then '1110' else '1111' end, 5), '' order by i) as b
  from (select rn, i, substr(hex, i, 1) as c from d, unnest(range(1, 41)) as t(i)) group by rn
), b32 as (
  select rn, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
      16 * cast(substr(b, 5 * j + 1, 1) as int) + 8 * cast(substr(b, 5 * j + 2, 1) as int) +
      4 * cast(substr(b, 5 * j + 3, 1) as int) + 2 * cast(substr(b, 5 * j + 4, 1) as int) +
      cast(substr(b, 5 * j + 5, 1) as int), 1), '' order by j) as digest
  from bits, unnest(range(0, 32)) as t(j) group by rn
)
select page_id, cast(strlen(html) as bigint) as payload_bytes, digest as payload_digest,
  case when place = 1 then 'response' else 'revisit' end as record_type,
  case when place > 1 then top end as refers_to
from r join b32 using (rn)
"""
