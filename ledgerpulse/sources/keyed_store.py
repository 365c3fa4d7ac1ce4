"""A keyed document store on files: a Python data source whose writes are all or nothing.

Every task writes its rows to one file, `CHUNK` rows at a time; the driver then commits a write by one manifest
that names the files. Files of failed or repeated attempts are named by no manifest and are never read; an aborted
write removes what it can. Setting a key again replaces it: reading takes the row of the newest write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import batched

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import LongType, StructField, StructType

from .documents import newest_per_key

#: Rows handed over at a time.
CHUNK = 400
VERSION = "_version"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """What one task left: its file, rows and chunks."""

    file: str
    rows: int
    chunks: int


def manifests(path: str) -> list[dict]:
    """Committed writes, oldest first."""
    files, root = _open(path)
    found = files.get_file_info(fs.FileSelector(f"{root}/_commits", allow_not_found=True))
    out = []
    for info in sorted((i for i in found if i.base_name.endswith(".json")), key=lambda i: i.base_name):
        with files.open_input_stream(info.path) as stream:
            out.append(json.loads(stream.read()))
    return out


class _Writer(DataSourceWriter):
    def __init__(self, path: str, columns: Sequence[str], chunk: int):
        self.path, self.columns, self.chunk = path, list(columns), chunk
        self.version = len(manifests(path))
        self.write_id = uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Written:
        files, root = _open(self.path)
        files.create_dir(root, recursive=True)
        name = f"{self.version:010d}-{uuid.uuid4().hex}.json"
        rows = chunks = 0
        with files.open_output_stream(f"{root}/{name}") as out:
            for part in batched(iterator, self.chunk):
                documents = (dict(zip(self.columns, row)) | {VERSION: self.version} for row in part)
                out.write("".join(json.dumps(d, ensure_ascii=False) + "\n" for d in documents).encode())
                rows, chunks = rows + len(part), chunks + 1
        return Written(name, rows, chunks)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _open(self.path)
        files.create_dir(f"{root}/_commits", recursive=True)
        done = [m for m in messages if m is not None]
        manifest = {
            "version": self.version, "files": [m.file for m in done if m.rows], "rows": sum(m.rows for m in done),
            "chunks": sum(m.chunks for m in done),
        }
        staged = f"{root}/_commits/{self.write_id}.tmp"
        with files.open_output_stream(staged) as out:
            out.write(json.dumps(manifest).encode())
        files.move(staged, f"{root}/_commits/{self.version:010d}.json")

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _open(self.path)
        for m in messages:
            if m is not None:
                files.delete_file(f"{root}/{m.file}")


class KeyedStore(DataSource):
    """Format ``ledgerpulse_store`` with options ``path`` and ``chunk``."""

    @classmethod
    def name(cls) -> str:
        return "ledgerpulse_store"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], schema.names, int(self.options.get("chunk", CHUNK)))


def upsert(df: DataFrame, path: str, key: str, chunk: int = CHUNK, order_by: str | None = None) -> None:
    """Set every row under its key in the store at ``path``; of rows that share a key the newest by ``order_by``."""
    df.sparkSession.dataSource.register(KeyedStore)
    newest = newest_per_key(df, key, order_by)
    newest.write.format("ledgerpulse_store").option("path", path).option("chunk", chunk).mode("append").save()


def read_store(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """The newest row of every key; only committed files are read."""
    names = [f"{path}/{name}" for m in manifests(path) for name in m["files"]]
    if not names:
        return spark.createDataFrame([], schema)
    stored = StructType([*schema.fields, StructField(VERSION, LongType())])
    rows = spark.read.schema(stored).option("mode", "FAILFAST").json(names)
    return newest_per_key(rows, key, VERSION).select(*[F.col(f.name) for f in schema.fields])
