"""WARC, index first: every record's file, offset, length, URL and digest are written as it is archived, and selected records are
read back by sorted, coalesced byte ranges.

Equal payloads are found from (id, SHA-1, length) alone: the smallest id of each payload is the response, the others are revisits that
refer to it. The pages then go to their archives where they lie: every task writes gzip members (one per record, so that each
is readable by itself) to files of its own, at most ``roll_bytes`` each, and returns index rows. The index is committed by
Spark as a Parquet table, so files of a lost or repeated task attempt are never referred to. Reading takes any selection of
index rows: they are dealt by file, sorted by offset, neighbouring ranges become one read, and every payload's digest is checked.

Files are opened through pyarrow's file systems (file, hdfs, s3, gs, abfs) under the shared folder.

Edge cases: a null payload is an empty one; a payload of any length is one record (its task holds it once plain and once
compressed); ids of any size stay exact, also next to null ones; of equal payloads with one id none is told from the others; a null URL has no target header; control characters in a URL are percent-encoded in
the header only; rows that share id and payload are each a response or each a revisit of the same record; a null id is the response only if no other
row has its payload; payloads shorter than ``min_revisit_bytes`` are always responses; an empty table has an empty index; extra
columns are ignored.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import shuffle_partitions
from marquee.session import materialize, scratch_path

ROLL_BYTES, GAP_BYTES, READ_BYTES, TASK_BYTES = 64 << 20, 256 << 10, 8 << 20, 64 << 20
DATE = "1970-01-01T00:00:00Z"
INDEX = ("id long, url string, file string, offset long, length long, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long")
RECORDS = "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_fs(uri: str):
    """(pyarrow file system, path) of a Hadoop-style URI or plain path."""
    from pyarrow import fs

    local = re.match(r"file:/*(?=/)", uri)
    if local or "://" not in uri:
        return fs.LocalFileSystem(), uri[local.end():] if local else uri
    return fs.FileSystem.from_uri(uri)


def record(id_: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload but its length and digest."""
    body = b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if id_ is None else id_}>",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}" if m[0] != "%" else "%", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    head += [f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("record length does not match its header")
    return fields, rest[:n]


def _revisits(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """(r_id, r_sha, first_id) of the rows whose payload a smaller id holds."""
    keys = pages.select("id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n"))
    keys = keys.where(F.col("n") >= min_revisit_bytes)
    firsts = materialize(keys.groupBy("sha").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("c")).where("c > 1")
                         .select(F.col("sha").alias("f_sha"), "first_id"), "warc-first")
    other = keys.join(firsts, F.col("sha") == F.col("f_sha")).where(~F.col("id").eqNullSafe(F.col("first_id")))
    return materialize(other.select(F.col("id").alias("r_id"), F.col("sha").alias("r_sha"), "first_id").distinct(), "warc-revisits")


def write_archives(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit_bytes: int = 0, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Archive every row; returns the written index (columns of INDEX)."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    revisits = _revisits(rows, min_revisit_bytes)
    rows = rows.join(revisits, F.col("id").eqNullSafe(F.col("r_id")) & (F.sha1("payload") == F.col("r_sha")), "left")
    # nullable integers stay out of pandas, which would make floats of them
    rows = rows.select(F.col("id").isNotNull().alias("known"), F.coalesce("id", F.lit(0)).alias("id"), "url", "payload",
                       F.col("first_id").isNotNull().alias("first_known"), F.coalesce("first_id", F.lit(0)).alias("first_id"),
                       F.col("r_sha").isNotNull().alias("revisit"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, out, name, at = None, None, "", 0
        try:
            for b in batches:
                made = []
                columns = (b[c].tolist() for c in ("known", "id", "url", "payload", "first_known", "first_id", "revisit"))
                for known, id_, url, payload, first_known, first, revisit in zip(*columns):
                    id_, first = id_ if known else None, first if first_known else None
                    payload = bytes(payload)
                    if out is None or at >= roll_bytes:
                        if out is not None:
                            out.close()
                        if target is None:
                            target, base = open_fs(path)
                            target.create_dir(base, recursive=True)
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = target.open_output_stream(f"{base}/{name}", compression=None)  # members are compressed one by one
                    member = gzip.compress(record(id_, url, payload, first, revisit), 6, mtime=0)
                    out.write(member)
                    made.append((id_, url, f"{path}/{name}", at, len(member), len(payload), digest(payload),
                                 "revisit" if revisit else "response", first if revisit else None))
                    at += len(member)
                yield _frame(made, INDEX)
        finally:
            if out is not None:
                out.close()

    rows.mapInPandas(write, INDEX).write.parquet(f"{path}/index")
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    """Rows as objects: an integer column with a null would otherwise pass through floats."""
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")], dtype=object)


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int, int]]:
    """Reads (offset, length, number of ranges) that cover sorted ranges, merging those at most ``gap`` apart."""
    reads: list[list[int]] = []
    for offset, length in ranges:
        if reads and offset - (reads[-1][0] + reads[-1][1]) <= gap and max(offset + length - reads[-1][0], reads[-1][1]) <= most:
            reads[-1][1] = max(reads[-1][1], offset + length - reads[-1][0])
            reads[-1][2] += 1
        else:
            reads.append([offset, length, 1])
    return [tuple(r) for r in reads]


def read_tasks(index: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """How many tasks read the selected records: by the archive bytes, which the index rows that are shuffled say nothing about."""
    r = index.agg(F.sum("length").alias("n"), F.approx_count_distinct("file").alias("files")).first()
    least = shuffle_partitions(index.sparkSession)
    return max(1, min(2 * r["files"], max(least, -(-(r["n"] or 0) // task_bytes))))


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of any selection of index rows, from their byte ranges (columns of RECORDS; payload null for revisits).

    An archive is read by one task, and the archives are dealt to as many tasks as their selected bytes ask for."""
    chosen = index.select("file", "offset", "length")
    chosen = chosen.repartition(read_tasks(chosen), "file").sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, part in b.groupby("file", sort=False):
                source, path = open_fs(file)
                ranges = list(zip(part["offset"].tolist(), part["length"].tolist()))
                with source.open_input_file(path) as f:
                    for offset, length, n in coalesced(ranges):
                        f.seek(offset)
                        block, made = f.read(length), []
                        for o, size in ranges[:n]:
                            made.append(_row(gzip.decompress(block[o - offset:o - offset + size]), payloads))
                        del ranges[:n]
                        yield _frame(made, RECORDS)

    return chosen.mapInPandas(read, RECORDS)


def _row(raw: bytes, payloads: bool) -> tuple:
    fields, body = parse(raw)
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    kind, want = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (digest(body) != want or len(body) != int(fields["X-Payload-Length"])):
        raise ValueError(f"payload of record {fields['WARC-Record-ID']} does not match its digest")
    return (number("WARC-Record-ID"), fields.get("WARC-Target-URI"), kind, number("WARC-Refers-To"), int(fields["X-Payload-Length"]), want,
            body if payloads and kind == "response" else None)
