"""Quoted CSV in splits: files whose quoted fields hold line breaks, read by many tasks.

A line break ends a record only outside quotes, and whether a split begins inside quotes depends on all that comes before it. So
there are two passes over Spark's own line splits of a file. The first sends only lines with a quote to Python, follows each
split from both start states (outside, inside) and gives two bits a split: the state at its end for each. Composing them in
file order gives every split's start state (one small row a split goes through the driver). The second pass cuts each split into
records from its known state; lines of a record that crosses split ends come out as fragments and are joined by (file, place).
Arrow batches without an open quote pass unchanged. Records are then parsed by ``from_csv``.

Start states belong to byte positions, so they hold as long as later splits start where splits of the first pass did; a task
that finds another start fails with a clear message instead of misreading.

Edge cases: a quote that opens and never closes makes the rest of its split one record, and later splits of its file hold none; text after a closing
quote runs to the next separator; quotes inside an unquoted field are ordinary characters; empty lines between records are
left out; one line break at a record's end may be CR LF; every file's first record is its header and must name the same columns.
"""
from __future__ import annotations

import csv
import io
import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

WHOLE, TAIL, INNER = 0, 1, 2  # a record; the beginning of one that goes on; what a record has in later splits


def ends_inside(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a line that begins inside (or outside) a quoted field ends inside one."""
    at = 0
    while True:
        if not inside and line.startswith('"', at):
            inside, at = True, at + 1
        if inside:
            while True:
                at = line.find('"', at)
                if at < 0:
                    return True
                if not line.startswith('""', at):
                    break
                at += 2
            inside = False
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def lines_of(spark: SparkSession, path) -> DataFrame:
    """The lines of the files, in order within each split, with their file and split and whether they hold a quote."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       "value", F.contains("value", F.lit('"')).alias("quoted"))


def _ends(sep: str):
    """(file, start, state at the end from outside, from inside) of every split that holds a quote."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, states, done = None, (False, True), []
        for b in batches:
            for file, start, value in zip(*(b.column(c).to_pylist() for c in ("file", "start", "value"))):
                if here != (file, start):
                    if here is not None:
                        done.append((*here, *states))
                    here, states = (file, start), (False, True)
                states = tuple(ends_inside(value, s, sep) for s in states)
        if here is not None:
            done.append((*here, *states))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["file", "start", "outside", "inside"])
    return run


def start_states(lines: DataFrame, sep: str = ",") -> tuple[set[tuple[str, int]], int]:
    """(splits that begin inside quotes, distance of split starts; 0 where no file has two splits). A split that a quote without an
    end reaches is given with a negative start; the later ones of its file lie inside too."""
    quoted = lines.where("quoted").select("file", "start", "value")
    ends = quoted.mapInArrow(_ends(sep), "file string, start long, outside boolean, inside boolean").collect()  # one row a split
    # splits of one scan have one size; those in which no line begins do not show
    step = math.gcd(*(r["start"] for r in lines.select("start").distinct().collect()))
    by_file: dict[str, dict[int, tuple[bool, bool]]] = {}
    for r in ends:
        by_file.setdefault(r["file"], {})[r["start"]] = (r["outside"], r["inside"])
    found: set[tuple[str, int]] = set()
    if not step:
        return found, 0
    for file, splits in by_file.items():
        state, at, last = False, 0, max(splits)
        while at <= last:
            if state:
                found.add((file, at))
            outside, inside = splits.get(at, (False, True))
            state = inside if state else outside
            at += step
        if state:  # never closed: noted with a minus
            found.add((file, -at))
    return found, step


def _records(inside: set[tuple[str, int]], step: int, header: list[str], sep: str, kinds: tuple[int, ...]):
    """Lines to records (file, start, row, kind, value); header records are checked and left out."""
    open_from = {file: -at for file, at in inside if at < 0}

    def lost(file: str, start: int) -> bool:
        return file in open_from and start >= open_from[file]

    def begins_inside(file: str, start: int) -> bool:
        if start and (not step or start % step):
            raise ValueError(f"{file} is split at {start}, not at multiples of {step}: read it again with the same number of executors")
        return (file, start) in inside or lost(file, start)

    def goes_on(file: str, start: int) -> bool:
        return bool(step) and (file, start + step) in inside

    def check(value: str) -> None:
        names = next(csv.reader(io.StringIO(value.lstrip("﻿")), delimiter=sep), [])
        if [c.strip() for c in names] != [c.strip() for c in header]:
            raise ValueError(f"a file's columns {names} are not {header}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state, first, row = None, False, False, 0  # row: lines of the split so far
        held: list = []  # [row, kind, lines] of the record that is open
        out: list[tuple] = []

        def close(at_end: bool = False) -> None:
            if held:
                at, kind, lines = held
                if at_end and kind == WHOLE and goes_on(*here):
                    kind = TAIL
                if not lost(*here):
                    out.append((*here, at, kind, "\n".join(lines)))
                held.clear()

        def flush() -> Iterator[pa.RecordBatch]:
            wanted = [r for r in out if r[3] in kinds]
            out.clear()
            if wanted:
                arrays = [pa.array(c, t) for c, t in zip(zip(*wanted), (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, ["file", "start", "row", "kind", "value"])

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            same = here is not None and pc.all(pc.equal(b.column("start"), here[1])).as_py() and pc.all(pc.equal(b.column("file"), here[0])).as_py()
            if same and not state and not held and not first and not pc.any(b.column("quoted")).as_py():
                yield from flush()
                if WHOLE in kinds:
                    yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(range(row, row + n), pa.int64()), pa.array([WHOLE] * n, pa.int32()),
                                                      b.column("value")], ["file", "start", "row", "kind", "value"])
                row += n
                continue
            for file, start, value, quoted in zip(*(c.to_pylist() for c in b.columns)):
                if here != (file, start):
                    close(at_end=True)
                    here, state, first, row = (file, start), begins_inside(file, start), start == 0, 0
                    if state:
                        held[:] = [row, INNER, []]
                before = state
                if quoted:
                    state = ends_inside(value, state, sep)
                if held:
                    held[2].append(value)
                elif not before:
                    held[:] = [row, WHOLE, [value]]
                if not state:
                    if first:
                        check("\n".join(held[2]))
                        held.clear()
                        first = False
                    else:
                        close()
                row += 1
            yield from flush()
        close(at_end=True)
        yield from flush()

    return run


def quoted_records(spark: SparkSession, path, header: list[str], sep: str = ",") -> DataFrame:
    """(file, start, row, value): every record of the files but their headers; (file, start, row) is their order."""
    schema = "file string, start long, row long, kind int, value string"
    lines = lines_of(spark, path)
    inside, step = start_states(lines, sep)
    whole = lines.mapInArrow(_records(inside, step, header, sep, (WHOLE,)), schema)
    if inside:
        # only files with a record across a split's end are asked for their fragments. All files are listed again, and the test is no
        # filter of the listing (it names the value): the split size depends on the bytes that a scan lists
        torn = lines.where(F.concat("file", F.substring("value", 1, 0)).isin(sorted({file for file, _ in inside})))
        parts = torn.mapInArrow(_records(inside, step, header, sep, (TAIL, INNER)), schema)
        # at most two a split: the end of a former record, then the beginning of another
        order = Window.partitionBy("file").orderBy("start", "row")
        parts = parts.withColumn("chain", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
        joined = parts.groupBy("file", "chain").agg(F.sort_array(F.collect_list(F.struct("start", "row", "value"))).alias("p"))
        joined = joined.select("file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["row"].alias("row"),
                               F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"))
        whole = whole.drop("kind").unionByName(joined)
    else:
        whole = whole.drop("kind")
    value = F.regexp_replace("value", "\r$", "")
    return whole.withColumn("value", value).where(F.length("value") > 0)
