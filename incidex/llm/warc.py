"""WARC archives through a chunked record table.

A payload never stands in memory as one object of its own: it is cut at
character boundaries into chunks of bounded size, which are rows ``(record,
chunk number)`` carrying the SHA-1 of the payload so far.  A chunk is one WARC
record; the first chunk of a payload is the ``response``, later ones are
``continuation`` segments, and the last states the total length and the digest
of the whole payload.  Archives are written and read by Spark's text source
with CRLF as the line separator, one gzip file per task, so they can lie in
any store Spark reaches and a lost executor only repeats its files.

Equal payloads are stored once: the record with the smallest key is the
response, the others are ``revisit`` records without payload that name it.
Equal payloads are found by SHA-1 and length with pre-aggregated groups over
rows without payloads, and revisits are made of such rows.  A payload leaves
its scan split only when its row is the response of a repeated payload (or
looks like one to the bit tables, whose size is fixed).

A null payload is empty.  Rows with equal payload and equal smallest key are
all responses.  A null key is the largest: such a record revisits one with a
key, and is a response if there is none.  An empty table gives no records.
Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidex.llm.common import shared_path, write_shared
from incidex.llm.minhash import probably_in

CHUNK_BYTES = 1 << 18
YIELD_BYTES = 1 << 22
DATE = "1970-01-01T00:00:00Z"
CHUNK_TABLE = ("record string, uri string, chunk int, last boolean, kind string, refers_to string, "
               "data string, bytes_so_far long, digest_so_far string")


def base32_sha1(sha) -> str:
    return base64.b32encode(sha.digest()).decode()


def cuts(data: memoryview, size: int) -> Iterator[tuple[int, int]]:
    """Pieces of at most ``size`` bytes (and a character) that end at character boundaries."""
    at, n = 0, len(data)
    while True:
        end = min(n, at + size)
        while end < n and data[end] & 0xC0 == 0x80:
            end += 1
        yield at, end
        if end >= n:
            return
        at = end


def with_revisits(pages: DataFrame, key: str, uri: str, payload: str, min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Rows ``(_key, _uri, _text)`` to be stored whole, and rows ``(_key, _uri, _sha, _n,
    _first)`` of payloads of at least ``min_bytes`` bytes that have a smaller key elsewhere."""
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    whole = pages.select(F.col(key).alias("_key"), F.col(uri).alias("_uri"), text.alias("_text"),
                         F.sha1(text).alias("_sha"), F.octet_length(text).alias("_n"))
    narrow = write_shared(whole.drop("_text"), "keys")
    first = write_shared(narrow.where(F.col("_n") >= min_bytes).groupBy("_sha", "_n")
                         .agg(F.min("_key").alias("_first"), F.count("*").alias("_copies"))
                         .where("_copies > 1 and _first is not null").drop("_copies"), "first")
    again = ~F.col("_key").eqNullSafe(F.col("_first"))
    repeated = probably_in("_sha", first.select("_sha"))
    # the rows that look repeated and are stored whole
    looked = narrow.where(repeated).join(first, ["_sha", "_n"], "left")
    kept = write_shared(looked.where(F.col("_first").isNull() | ~again).select("_key", "_sha", "_n").distinct(), "kept")
    place = F.xxhash64("_key", "_sha")
    likely = probably_in("_place", kept.select(place.alias("_place")))
    near = whole.withColumn("_place", place).where(repeated & likely)
    x, y = near.alias("x"), kept.alias("y")
    same = F.col("x._key").eqNullSafe(F.col("y._key")) & (F.col("x._sha") == F.col("y._sha")) & (F.col("x._n") == F.col("y._n"))
    stored = (whole.where(~repeated).select("_key", "_uri", "_text")
              .union(x.join(y, same, "left_semi").select("_key", "_uri", "_text")))
    return stored, narrow.join(first, ["_sha", "_n"]).where(again).select("_key", "_uri", "_sha", "_n", "_first")


def chunk_table(pages: DataFrame, key: str, uri: str, payload: str, min_bytes: int = 0,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of ``pages``; a record's chunks follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in CHUNK_TABLE.split(", ")]
        types = [pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
        rows, size = [], 0

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            record, link, texts = (batch.column(i) for i in range(3))
            for x in range(batch.num_rows):
                buffer = texts[x].as_buffer()
                data = memoryview(buffer if buffer is not None else b"")
                sha = hashlib.sha1()
                for no, (a, b) in enumerate(cuts(data, chunk_bytes)):
                    sha.update(data[a:b])
                    rows.append((record[x].as_py(), link[x].as_py(), no, b == len(data), "continuation" if no else "response",
                                 None, str(data[a:b], "utf-8", "replace"), b, base32_sha1(sha)))
                    size += b - a
                    if size >= YIELD_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    @F.arrow_udf("string")
    def base32(digests: pa.Array) -> pa.Array:
        return pa.array([base64.b32encode(bytes.fromhex(d)).decode() for d in digests.to_pylist()], pa.string())

    stored, again = with_revisits(pages, key, uri, payload, min_bytes)
    record = F.coalesce(F.col("_key").cast("string"), F.lit("null"))
    link = F.regexp_replace(F.coalesce(F.col("_uri").cast("string"), F.lit("")), r"[\r\n]", "")
    revisits = again.select(record.alias("record"), link.alias("uri"), F.lit(0).alias("chunk"), F.lit(True).alias("last"),
                            F.lit("revisit").alias("kind"), F.col("_first").cast("string").alias("refers_to"),
                            F.lit("").alias("data"), F.col("_n").cast("long").alias("bytes_so_far"),
                            base32("_sha").alias("digest_so_far"))
    return stored.select(record, link, "_text").mapInArrow(run, CHUNK_TABLE).union(revisits)


def write_archives(chunks: DataFrame, path: str) -> str:
    """Write a chunked record table as WARC files (gzip) under ``path``."""
    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def urn(x):
        return F.concat(F.lit("<urn:page:"), x, F.lit(">"))

    segmented = (F.col("chunk") > 0) | ~F.col("last")
    value = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("kind")),
        line("WARC-Record-ID", F.when(F.col("chunk") > 0, urn(F.concat("record", F.lit(":"), F.col("chunk").cast("string"))))
             .otherwise(urn(F.col("record")))),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", F.col("uri")),
        F.when(segmented, line("WARC-Segment-Number", (F.col("chunk") + 1).cast("string"))).otherwise(""),
        F.when(F.col("chunk") > 0, line("WARC-Segment-Origin-ID", urn(F.col("record")))).otherwise(""),
        F.when(segmented & F.col("last"), line("WARC-Segment-Total-Length", F.col("bytes_so_far").cast("string"))).otherwise(""),
        F.when(F.col("refers_to").isNotNull(), line("WARC-Refers-To", urn(F.col("refers_to")))).otherwise(""),
        F.when(F.col("last"), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest_so_far")))
        .otherwise(line("X-Digest-So-Far", F.concat(F.lit("sha1:"), "digest_so_far"))),
        line("X-Bytes-So-Far", F.col("bytes_so_far").cast("string")),
        line("Content-Length", F.octet_length("data").cast("string")),
        F.lit("\r\n"), F.col("data"), F.lit("\r\n"))   # the line separator ends the record
    chunks.select(value.alias("value")).write.text(path, compression="gzip", lineSep="\r\n")
    return path


def parse_records(lines: Iterator[str]) -> Iterator[tuple[dict[str, str], list[bytes]]]:
    """Header fields and payload lines of consecutive WARC records given as CRLF lines."""
    for line in lines:
        if line != "WARC/1.1":
            raise ValueError(f"not the beginning of a WARC record: {line[:60]!r}")
        head = {}
        for line in lines:
            if not line:
                break
            name, _, value = line.partition(": ")
            head[name] = value
        want, got, parts = int(head["Content-Length"]), -2, []
        for line in lines:
            parts.append(line.encode())
            got += len(parts[-1]) + 2
            if got >= want:
                break
        if got != want or next(lines, None) != "":
            raise ValueError(f"payload of {head.get('WARC-Record-ID')}: {got} bytes for {want}")
        yield head, parts


def read_archives(spark: SparkSession, path: str, with_data: bool = True) -> DataFrame:
    """The chunked record table read back from archives, digests computed anew
    from the payloads (revisits keep what their record states)."""
    def bare(urn):
        return None if urn is None else urn[len("<urn:page:"):-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in CHUNK_TABLE.split(", ")]
        types = [pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
        lines = (v.as_py() for batch in batches for v in batch.column(0))
        rows, size, sha, done = [], 0, None, 0

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for head, parts in parse_records(lines):
            kind, chunk = head["WARC-Type"], int(head.get("WARC-Segment-Number", 1)) - 1
            if kind != "continuation":
                sha, done = hashlib.sha1(), 0
            data = b"\r\n".join(parts)
            sha.update(data)
            done += len(data)
            last = "WARC-Payload-Digest" in head
            stated = (head["WARC-Payload-Digest"] if last else head["X-Digest-So-Far"]).removeprefix("sha1:")
            if kind == "revisit":
                digest, total = stated, int(head["X-Bytes-So-Far"])
            else:
                digest, total = base32_sha1(sha), done
                if digest != stated or last and total != int(head.get("WARC-Segment-Total-Length", total)):
                    raise ValueError(f"{head['WARC-Record-ID']}: payload differs from its digest or length")
            record = bare(head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"]))
            rows.append((record, head["WARC-Target-URI"], chunk, last, kind, bare(head.get("WARC-Refers-To")),
                         data.decode() if with_data else None, total, digest))
            size += len(data) + 200
            if size >= YIELD_BYTES:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return spark.read.text(path, lineSep="\r\n").mapInArrow(run, CHUNK_TABLE)


def archive_records(pages: DataFrame, key: str, uri: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` into archives in the shared folder and read them back: one
    row per record, ``(key, payload_bytes, payload_digest, record_type, refers_to)``."""
    spark, kind = pages.sparkSession, pages.schema[key].dataType
    path = write_archives(chunk_table(pages, key, uri, payload, min_bytes), shared_path(spark, "warc"))

    def as_key(c):
        return F.when(F.col(c) != "null", F.col(c)).cast(kind)

    return (read_archives(spark, path, with_data=False).where("last")
            .select(as_key("record").alias(key), F.col("bytes_so_far").alias("payload_bytes"),
                    F.col("digest_so_far").alias("payload_digest"),
                    F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response").alias("record_type"),
                    as_key("refers_to").alias("refers_to")))
