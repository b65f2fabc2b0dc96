"""Files that tasks write to a shared folder.

A task writes one file under a name of its own attempt and reports it in the rows it
returns. Those rows are stored as a table by Spark, which keeps the rows of the one
attempt that counts: files of lost or repeated attempts are in no row and never read.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import IO

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of a file that one task reads; a longer record is a part of its own.
SEGMENT = 128 << 20
# Schemes of Hadoop whose stores have another name here.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder as Spark means it: a path without a scheme is one on the default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, as tasks reach it; a local path must be a shared one."""
    scheme, colon, rest = uri.partition(":")
    return fs.FileSystem.from_uri(_SCHEMES[scheme] + colon + rest if scheme in _SCHEMES else uri)


def segments(places: DataFrame, first: list[str]) -> DataFrame:
    """``path, begin, n`` and the named columns of the first record: parts of files that a task reads, one each.

    ``places`` has a row per record with ``path`` and ``offset``. Files are cut where a record begins, so
    the number of tasks follows from the bytes, whatever their layout.
    """
    from tremorlake.session import cut_lineage

    part = F.floor(F.col("offset") / SEGMENT).alias("part")
    heads = places.groupBy("path", part).agg(F.min(F.struct("offset", *first)).alias("head"), F.count(F.lit(1)).alias("n"))
    named = heads.select("path", F.col("head.offset").alias("begin"), "n", *[f"head.{c}" for c in first])
    stored = cut_lineage(named, "segments")
    return stored.repartition(max(1, stored.count()), "path", "begin")


@contextmanager
def new_file(folder: str, ending: str) -> Iterator[tuple[str, IO[bytes]]]:
    """A new file in a shared folder: its path and a stream to write."""
    system, top = place(folder)
    system.create_dir(top, recursive=True)
    name = f"part-{uuid.uuid4().hex}{ending}"
    # By default pyarrow would compress again what is named .gz.
    with system.open_output_stream(f"{top}/{name}", compression=None) as out:
        yield f"{folder}/{name}", out


def open_at(uri: str) -> IO[bytes]:
    system, path = place(uri)
    return system.open_input_file(path)


@contextmanager
def open_buffered(uri: str, begin: int, buffer: int = 1 << 20) -> Iterator[IO[bytes]]:
    """A stream that reads a file from an offset on, a buffer at a time."""
    with open_at(uri) as file:
        file.seek(begin)
        yield io.BufferedReader(file, buffer)
