"""Files by their address, for tasks that read or write whole objects.

Spark names files as `scheme://authority/path` or as a plain path, with blanks and signs
as they are. Addresses are therefore taken apart here, not parsed as encoded links.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

# Schemes under which the same store is known.
STORES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "hdfs"}


def address(path: str) -> tuple[str, str, str]:
    """Store, authority and place of a file; for object stores the place begins with the bucket."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        scheme, rest = "", path
    if scheme.lower() not in STORES:
        raise ValueError(f"no store known for {path!r}, only {sorted(s for s in STORES if s)} and plain paths")
    store = STORES[scheme.lower()]
    authority = ""
    if rest.startswith("//"):
        authority, slash, rest = rest[2:].partition("/")
        rest = slash + rest
    if store in ("s3", "gs"):
        return store, authority, authority + rest
    return store, authority, "/" + rest.lstrip("/") if store == "hdfs" or scheme else rest


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, with the credentials of its environment, and the place in it."""
    store, authority, place = address(path)
    if store == "file":
        return fs.LocalFileSystem(), os.path.abspath(place)
    if store == "s3":
        return fs.S3FileSystem(), place
    if store == "gs":
        return fs.GcsFileSystem(), place
    host, _, port = authority.partition(":")
    return fs.HadoopFileSystem(host or "default", int(port or 0)), place


@dataclass
class Written(WriterCommitMessage):
    """Objects a task has written: temporary and final names below the folder."""

    moves: list[tuple[str, str]]


class ObjectWriter(DataSourceWriter):
    """Writes rows (key, line) as one object per key.

    A task writes its keys one after the other under temporary names of its own; the driver
    gives them their names when all tasks are done. Tasks that failed or ran twice leave only
    temporary objects, which are removed.
    """

    def __init__(self, options: dict, schema: StructType):
        self._path, self._columns = options["path"], schema.names
        self._run = f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        system, root = open_store(self._path)
        task, moves, key, out = uuid.uuid4().hex, [], None, None
        try:
            for row in iterator:
                if out is None or row[0] != key:
                    if out is not None:
                        out.close()
                    key = row[0]
                    part = f"{self._run}/{task}/{len(moves)}"
                    system.create_dir(f"{root}/{self._run}/{task}", recursive=True)
                    out = system.open_output_stream(f"{root}/{part}")
                    moves.append((part, key))
                out.write(((row[1] or "") + "\n").encode())
        finally:
            if out is not None:
                out.close()
        return Written(moves)

    def commit(self, messages: list) -> None:
        system, root = open_store(self._path)
        for message in messages:
            for part, key in message.moves if message else []:
                system.create_dir(f"{root}/{key}".rpartition("/")[0], recursive=True)
                system.move(f"{root}/{part}", f"{root}/{key}")
        self._clean(system, root)

    def abort(self, messages: list) -> None:
        self._clean(*open_store(self._path))

    def _clean(self, system: fs.FileSystem, root: str) -> None:
        if system.get_file_info(f"{root}/{self._run}").type != fs.FileType.NotFound:
            system.delete_dir(f"{root}/{self._run}")


class ObjectSource(DataSource):
    """`df.write.format("objects")`: a sink of one object per key."""

    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return "key string, line string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ObjectWriter(self.options, schema)


def write_objects(lines: DataFrame, key: str, order: list[str], line: str, path: str) -> str:
    """Write the lines of each key, in order, as the object `path`/key, replacing one of that name.

    The lines of a key meet in one task, which streams them to the store; a key is one object by
    definition, and no more than a line is held in memory.
    """
    spark = lines.sparkSession
    spark.dataSource.register(ObjectSource)
    # no other column is shuffled and sorted with the lines
    kept = lines.where(lines[key].isNotNull()).select(key, *order, line)
    sorted_lines = kept.repartition(key).sortWithinPartitions(key, *order)
    sorted_lines.select(F.col(key).alias("key"), F.col(line).alias("line")).write.format("objects").mode(
        "append"
    ).option("path", path).save()
    return path
