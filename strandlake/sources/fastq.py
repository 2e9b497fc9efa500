"""FASTQ as a data source: one partition for each byte range of a plain file and for each gzip file.

A range begins with the first record that starts in it: a line that begins with @ whose next but one begins with +, which no other
line of a record is followed by. The record that the range's end cuts is read to its own end.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, read_id string, seq string, qual string, length long"
#: Bytes of a range, and those read at once.
RANGE, BLOCK = 128 << 20, 8 << 20


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int | None):
        self.path, self.start, self.end = path, start, end


def record_start(lines: list[bytes]) -> int | None:
    """Which of the lines begins a record; None if that takes more lines."""
    for i in range(len(lines) - 2):
        if lines[i][:1] == b"@" and lines[i + 2][:1] == b"+":
            return i
    return None


def batches(stream, file: str, start: int, end: int | None):
    """Record batches of the records that begin in [start, end) of the bytes that stream gives from `start` on."""
    held, at, found, ended = b"", start, start == 0, False
    while not ended:
        new = stream.read(BLOCK)
        ended = not new
        held += new
        if ended and held and not held.endswith(b"\n"):
            held += b"\n"
        if not found:
            lines = held.split(b"\n")[:-1]
            first = record_start(lines)
            if first is None:
                continue
            skip = sum(len(x) + 1 for x in lines[:first])
            held, at, found = held[skip:], at + skip, True
        breaks = np.flatnonzero(np.frombuffer(held, np.uint8) == 10)
        stops = breaks[3::4] + 1
        begins = np.append(0, stops)[:-1] if len(stops) else stops
        if end is not None:
            own = int(np.searchsorted(begins + at, end))
            ended |= own < len(begins) or (len(stops) > 0 and at + int(stops[-1]) >= end) or at >= end
            stops = stops[:own]
        if len(stops):
            text, held, at = held[: stops[-1]], held[stops[-1] :], at + int(stops[-1])
            text = text.replace(b"\r\n", b"\n") if b"\r" in text else text
            lines = text.split(b"\n")
            head, seq, qual = (pa.array(lines[k : 4 * len(stops) : 4], pa.binary()).cast(pa.string()) for k in (0, 1, 3))
            name = pc.struct_field(pc.extract_regex(head, r"^@?(?P<id>[^\s]*)"), [0])
            yield pa.record_batch([pa.array([file] * len(head), pa.string()), name, seq, qual, pc.utf8_length(seq).cast(pa.int64())], names=["file", "read_id", "seq", "qual", "length"])


class Reader(DataSourceReader):
    def __init__(self, files: list, size: int):
        self.files, self.size = files, size

    def partitions(self):
        out = []
        for path, length in self.files:
            if path.endswith(".gz"):
                out.append(Range(path, 0, None))
            else:
                out += [Range(path, a, min(a + self.size, length)) for a in range(0, length, self.size)]
        return out or [Range("", 0, 0)]

    def read(self, part):
        from pyarrow import fs

        if not part.path:
            return
        files, path = fs.FileSystem.from_uri(part.path)
        if part.path.endswith(".gz"):
            with files.open_input_stream(path, compression="gzip") as stream:
                yield from batches(stream, path.rsplit("/", 1)[-1], 0, None)
            return
        with files.open_input_file(path) as stream:
            start = part.start
            if start:  # a range begins after the line that its first byte is in, unless that byte begins a line
                stream.seek(start - 1)
                held = b""
                while b"\n" not in held and (new := stream.read(1 << 16)):
                    held += new
                if b"\n" not in held:
                    return
                start += held.index(b"\n")
                stream.seek(start)
            if start < part.end:
                yield from batches(stream, path.rsplit("/", 1)[-1], start, part.end)


class FastqSource(DataSource):
    """spark.read.format("fastq").option("files", json of [path, length] pairs).option("range", bytes)."""

    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Reader(json.loads(self.options["files"]), int(self.options.get("range", RANGE)))


def scan_fastq(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """(file, read_id, seq, qual, length) of the FASTQ files that path names, plain or .gz. Spark lists the files; tasks read them through
    pyarrow's file systems. Four lines are a record; one that the file's end cuts short is left out; no files give no rows."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").collect()  # a row for each file
    files = sorted((r.path.replace("file:/", "file:///", 1) if r.path.startswith("file:/") and not r.path.startswith("file://") else r.path, r.length) for r in listed if r.length)
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").option("files", json.dumps(files)).option("range", str(range_bytes)).load()
