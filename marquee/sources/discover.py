"""Input discovery: list files under a root, classify each by name, detect the dataset variant,
and expand zip archives.

Listing uses the binaryFile source with only path/length selected (contents are not read). A
dataset may be a single file or a folder of part files (as Spark writes them); a part file is named
by its folder. Classification is a join against a small fixed manifest (broadcast; fixed size).
"""
from __future__ import annotations

import contextlib
import hashlib
import posixpath
import re
import uuid
import zipfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.split import with_global_index
from marquee.session import materialize, task_keys
from marquee.sources.files import READERS, read_located

# FIXED VALUES: known dataset files -> (table, layout)
KNOWN = {
    "ratings.csv": ("ratings", "modern"), "movies.csv": ("movies", "modern"), "tags.csv": ("tags", "modern"),
    "links.csv": ("links", "modern"), "genome-scores.csv": ("genome_scores", "modern"),
    "ratings.dat": ("ratings", "ml-1m"), "movies.dat": ("movies", "ml-1m"),
    "u.data": ("ratings", "ml-100k"), "u.item": ("movies", "ml-100k"),
}
# FIXED VALUES: files present in the downloads but not needed
SKIP_FILES = [
    "readme.txt", "readme.html", "readme", "genome-tags.csv", "users.dat", "u.user", "u.genre",
    "u.occupation", "u.info", "u1.base", "u1.test", "u2.base", "u2.test", "u3.base", "u3.test",
    "u4.base", "u4.test", "u5.base", "u5.test", "ua.base", "ua.test", "ub.base", "ub.test",
]
# FIXED VALUES: extensions that are never data files
IGNORE_EXTENSIONS = [".md", ".txt", ".html", ".pdf", ".zip", ".md5", ".json", ".sh", ".py", ".npz"]
# FIXED VALUES: variant labels by priority (first present wins)
VARIANTS = [
    (["u.data", "u.item"], "ml-100k"),
    (["ratings.dat", "movies.dat"], "ml-1m"),
    (["genome-scores.csv"], "ml-25m"),
    (["ratings.csv"], "ml-latest-small"),
]


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, dataset_path, name): every file under root; part files are named after their folder."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select("path", "length"))
    base = F.regexp_extract("path", r"([^/]+)$", 1)
    parent = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    is_part = base.startswith("part-")
    ds_path = F.when(is_part, F.regexp_extract("path", r"^(.*)/[^/]+$", 1)).otherwise(F.col("path"))
    return files.select("path", "length", ds_path.alias("dataset_path"),
                        F.when(is_part, parent).otherwise(base).alias("name"))


def _manifest(spark: SparkSession) -> DataFrame:
    rows = [(n, "load", t, layout) for n, (t, layout) in KNOWN.items()] + \
           [(n, "skip", None, None) for n in SKIP_FILES]
    return spark.createDataFrame(rows, "lname string, action string, table_name string, layout string")


def classify(files: DataFrame) -> DataFrame:
    """(dataset_path, name, action, table_name, layout, reason) per dataset; action load | skip | reject."""
    spark = files.sparkSession
    ds = files.groupBy("dataset_path", "name").agg(F.sum("length").alias("bytes"))
    lname = F.lower(F.col("name"))
    ext = F.regexp_extract(lname, r"(\.[^./]+)$", 1)
    j = ds.withColumn("lname", lname).withColumn("ext", ext).join(F.broadcast(_manifest(spark)), "lname", "left")
    ignored = F.col("ext").isin(IGNORE_EXTENSIONS)
    action = (F.when(ignored, F.lit("skip")).when(F.col("action").isNotNull(), F.col("action"))
              .otherwise(F.lit("reject")))
    reason = (F.when(ignored, F.concat(F.lit("not a data file: extension "), F.col("ext")))
              .when(F.col("action") == "skip", F.lit("not needed by the tables"))
              .when(F.col("action") == "load", F.lit(None).cast("string"))
              .otherwise(F.concat(F.lit("REJECTED: unknown file name "), F.col("name"))))
    keep = ~ignored
    return j.select("dataset_path", "name", "bytes", action.alias("action"),
                    F.when(keep, F.col("table_name")).alias("table_name"),
                    F.when(keep, F.col("layout")).alias("layout"), reason.alias("reason"))


def discover_inputs(spark: SparkSession, root: str) -> DataFrame:
    return classify(list_files(spark, root))


def detect_variant(files: DataFrame) -> DataFrame:
    """One row: the variant label of the first rule whose file is present, else 'unknown'."""
    lname = F.lower(F.col("name"))
    prio = F.lit(None).cast("int")
    for n, (names, _) in reversed(list(enumerate(VARIANTS))):
        prio = F.when(lname.isin(names), F.lit(n)).otherwise(prio)
    labels = F.array(*[F.lit(label) for _, label in VARIANTS])
    best = files.agg(F.min(prio).alias("p"))
    return best.select(F.when(F.col("p").isNull(), F.lit("unknown")).otherwise(F.get(labels, F.col("p")))
                       .alias("variant"))


def has_known_files(files: DataFrame) -> bool:
    return files.filter(F.lower(F.col("name")).isin(list(KNOWN))).limit(1).count() > 0


def task_filesystem(uri: str):
    """(pyarrow filesystem, path) for a folder URI, usable inside a task (local, hdfs://, s3://, ...)."""
    import pyarrow.fs as pafs
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))
    return pafs.LocalFileSystem(), uri


def _unsafe(member: str) -> bool:
    return member.startswith("/") or ".." in member


COPY_BYTES, TASK_BYTES = 4 << 20, 64 << 20
MEMBERS = "archive string, member string, status string, at long, packed long, size long, crc long, method int"


def archive_index(spark: SparkSession, archives: str) -> DataFrame:
    """The central directories of every zip under ``archives``: one row per member with its place and sizes (MEMBERS).

    status is null for a member that can be unpacked. An archive with a member that starts with '/' or contains '..' is
    refused whole, one that is broken has a single error row. Of members of one name the last counts. Directories only are
    read, one archive a task, in as many tasks as there are archives (up to some a shuffle partition)."""
    zips = (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
            .option("recursiveFileLookup", "true").load(archives).select("path"))
    n = min(max(1, zips.count()), 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = [c.split()[0] for c in MEMBERS.split(", ")]

    def run(batches):
        for b in batches:
            for path in b["path"]:
                yield pd.DataFrame(_directory(path), columns=names, dtype=object)

    return zips.repartition(n, F.xxhash64("path")).mapInPandas(run, MEMBERS)


def _directory(path: str) -> list[tuple]:
    try:
        source, inner = task_filesystem(path)
        if source.get_file_info(inner).size == zipfile.sizeEndCentDir:  # an archive without members is its end record alone
            return []
        with source.open_input_file(inner) as raw, zipfile.ZipFile(raw) as zf:
            infos = {i.filename: i for i in zf.infolist() if not i.is_dir()}
            if any(_unsafe(m) for m in zf.namelist()):
                return [(path, m, "refused", None, None, None, None, None) for m in infos]
            return [(path, m, "error: encrypted" if i.flag_bits & 1 else None, i.header_offset, i.compress_size, i.file_size, i.CRC,
                     i.compress_type) for m, i in infos.items()]
    except Exception as e:  # noqa: BLE001 - one bad archive must not fail the others
        return [(path, None, f"error: {type(e).__name__}: {e}", None, None, None, None, None)]


def expand_archives(spark: SparkSession, archives: str, out: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Unpack every zip under ``archives`` into ``out``/<digest of the archive's path>-<archive name>/, so archives of one name in
    different folders stay apart. An archive with an unsafe member path is refused whole; one that is broken is reported and
    the others go on.

    The directories are an index first (archive_index, written once); its members are dealt to tasks largest first, in turn, so
    one archive is unpacked by as many tasks as its bytes ask for; a single member is one stream and stays in one task. Members are
    read by their byte ranges and copied in pieces, never held in memory, and checked by length and CRC; one appears under its name only
    when it is complete, so a repeated task does no harm.

    Paths may be anything that pyarrow's file systems open (file, hdfs, s3, gs, abfs; s3a and s3n are read as s3).
    Returns (archive, member, status) rows; status is extracted, refused or 'error: ...'."""
    out_root = out.rstrip("/")
    index = materialize(archive_index(spark, archives), "archive-index")
    good = index.where(F.col("status").isNull())
    totals = good.agg(F.count(F.lit(1)).alias("n"), F.sum("packed").alias("bytes")).first()
    tasks = max(1, min(totals["n"], max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(totals["bytes"] or 0) // task_bytes))))
    told = index.where(F.col("status").isNotNull()).select("archive", "member", "status")
    if not totals["n"]:
        return told
    order = with_global_index(good.withColumn("less", -F.col("packed")), ["less", "archive", "member"], "nth")
    keys = F.array(*[F.lit(k) for k in task_keys(spark, tasks)])
    dealt = order.withColumn("task", F.get(keys, (F.col("nth") % tasks).cast("int"))).repartition(tasks, "task")

    def run(batches):
        fs, base = task_filesystem(out_root)
        for b in batches:
            rows = [(r.archive, r.member, _extract(fs, base, r)) for r in b.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["archive", "member", "status"])

    done = dealt.select("archive", "member", "at", "packed", "size", "crc", "method").mapInPandas(run, "archive string, member string, status string")
    return done.unionByName(told)


def _inflated(raw, method: int, left: int):
    """Pieces of a member's content from its packed bytes, which begin where the file stands."""
    if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise NotImplementedError(f"compression method {method}")
    unpack = zlib.decompressobj(-zlib.MAX_WBITS) if method == zipfile.ZIP_DEFLATED else None
    while left:
        piece = raw.read(min(left, COPY_BYTES))
        if not piece:
            raise EOFError("the archive ends inside a member")
        left -= len(piece)
        while unpack and piece:
            yield unpack.decompress(piece, COPY_BYTES)
            piece = unpack.unconsumed_tail
        if not unpack:
            yield piece
    if unpack:
        yield unpack.flush()


def _extract(fs, base: str, m) -> str:
    """Unpack one member (a row of the index) under its name; returns its status."""
    part = ""
    try:
        folder = f"{base}/{hashlib.sha1(m.archive.encode()).hexdigest()[:12]}-{posixpath.splitext(posixpath.basename(m.archive))[0]}"
        dest = f"{folder}/{m.member}"
        part = f"{posixpath.dirname(dest)}/.{uuid.uuid4().hex}.part"
        fs.create_dir(posixpath.dirname(dest), recursive=True)
        source, inner = task_filesystem(m.archive)
        size, crc = 0, 0
        with source.open_input_file(inner) as raw:
            raw.seek(int(m.at))
            head = raw.read(30)
            if head[:4] != b"PK\x03\x04":
                raise ValueError("no member where the directory says")
            raw.seek(int(m.at) + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
            with fs.open_output_stream(part, compression=None) as fh:
                for piece in _inflated(raw, int(m.method), int(m.packed)):
                    fh.write(piece)
                    size, crc = size + len(piece), zlib.crc32(piece, crc)
        if (size, crc) != (int(m.size), int(m.crc)):
            raise ValueError("length or CRC differ from the directory's")
        fs.move(part, dest)
        return "extracted"
    except Exception as e:  # noqa: BLE001 - one bad member must not fail the others
        with contextlib.suppress(Exception):
            fs.delete_file(part)
        return f"error: {type(e).__name__}: {e}"


def read_dataset(spark: SparkSession, name: str, path: str) -> tuple[str, DataFrame]:
    """Read one classified dataset with the reader of its file name: (table, DataFrame that arrival_ids can number)."""
    table, reader = READERS[name.lower()]
    return table, read_located(reader, spark, path)


def unparsable(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The records of one classified dataset that its reader leaves out because they do not parse, with their raw text."""
    return READERS[name.lower()][1](spark, path, bad=True)
