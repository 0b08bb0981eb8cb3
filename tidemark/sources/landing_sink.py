"""SNK1: landed documents under decodable paths that never change, as a Spark data source.

``<root>/<source>/<id>/<start>_<end>_<yyyyMMddTHHmmss>.json``, newline-delimited
JSON, one file for each asset, fetch window and landing time. Part files of a
plain JSON writer can't be named by their rows, so a writer of the Python data
source API does it:

- each task attempt writes into a staging folder of its own, ``<root>/_staging/<job>/<attempt>``;
- when all tasks are done, the driver moves the files of the attempts that
  succeeded into place, then drops the staging folder;
- when the job fails, the staging folder goes and no document has landed. Readers
  skip names that begin with an underscore.

A landed file is never written over: another content for its path fails the commit
before anything is moved; the same content (a commit that was cut off is done
again) is left as it is.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.session import ship

STAGING = "_staging"
FIELDS = "landing_id string, landing_file string, body string"


def filesystem(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    if root.startswith("/"):
        return pafs.LocalFileSystem(), root
    return pafs.FileSystem.from_uri(root)


@dataclass
class Attempt(WriterCommitMessage):
    folder: str


class LandingWriter(DataSourceArrowWriter):
    def __init__(self, root: str, source: str):
        self.root, self.source = root.rstrip("/"), source
        self.staging = f"{self.root}/{STAGING}/{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Attempt:
        """Rows come sorted by path, each path in one task: one file is open at a time."""
        folder = f"{self.staging}/{uuid.uuid4().hex}"
        fs, at = filesystem(folder)
        name, out = None, None
        try:
            for batch in batches:
                for landing_id, file, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if landing_id is None or file is None:
                        raise ValueError("a document without id, fetch window or landing time can't land")
                    path = f"{quote(landing_id, safe='')}/{file}"
                    if path != name:
                        if out is not None:
                            out.close()
                        fs.create_dir(os.path.dirname(f"{at}/{path}"), recursive=True)
                        name, out = path, fs.open_output_stream(f"{at}/{path}")
                    out.write(body.encode("utf-8", "replace") + b"\n")
        finally:
            if out is not None:
                out.close()
        return Attempt(folder)

    def commit(self, messages: list[Attempt | None]) -> None:
        fs, root = filesystem(self.root)
        moves = []
        for message in messages:
            _, folder = filesystem(message.folder)
            for info in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True, recursive=True)):
                if info.type == pafs.FileType.File:
                    to = f"{root}/{self.source}/{os.path.relpath(info.path, folder)}"
                    if fs.get_file_info(to).type == pafs.FileType.NotFound:
                        moves.append((info.path, to))
                    elif not same_bytes(fs, info.path, to):
                        self.drop()
                        raise FileExistsError(f"{to} has landed with another content")
        for path, to in moves:
            fs.create_dir(os.path.dirname(to), recursive=True)
            fs.move(path, to)
        self.drop()

    def abort(self, messages: list[Attempt | None]) -> None:
        self.drop()

    def drop(self) -> None:
        fs, staging = filesystem(self.staging)
        if fs.get_file_info(staging).type == pafs.FileType.Directory:
            fs.delete_dir(staging)


def same_bytes(fs: pafs.FileSystem, a: str, b: str, block: int = 1 << 20) -> bool:
    with fs.open_input_stream(a) as x, fs.open_input_stream(b) as y:
        while True:
            left, right = x.read(block), y.read(block)
            if left != right:
                return False
            if not left:
                return True


class LandingSource(DataSource):
    """Write only: ``df.write.format("landing").option("source", ...).mode("append").save(root)``."""

    @classmethod
    def name(cls) -> str:
        return "landing"

    def schema(self) -> str:
        return FIELDS

    def writer(self, schema, overwrite: bool) -> LandingWriter:
        if overwrite:
            raise ValueError("landed files are never written over; use append")
        return LandingWriter(self.options["path"], self.options["source"])


def land_documents(
    docs: DataFrame,
    root: str,
    source: str,
    id_column: str = "symbol",
    start: str = "fetch_start",
    end: str = "fetch_end",
    landed_at: Column | None = None,
) -> None:
    """Land each document in the file of its id, fetch window and landing time (by default its ingestion time, UTC).

    Documents of one path are dealt to one task and sorted by their text, so the same documents
    give the same bytes.
    """
    spark = docs.sparkSession
    ship(spark)
    spark.dataSource.register(LandingSource)
    at = landed_at if landed_at is not None else F.col("__de_processed_at")
    day = lambda c: F.date_format(F.col(c).cast("date"), "yyyy-MM-dd")
    file = F.concat(day(start), F.lit("_"), day(end), F.lit("_"), F.date_format(at, "yyyyMMdd'T'HHmmss"), F.lit(".json"))
    rows = docs.select(F.col(id_column).cast("string").alias("landing_id"), file.alias("landing_file"), F.to_json(F.struct(*docs.columns)).alias("body"))
    rows = rows.repartition("landing_id", "landing_file").sortWithinPartitions("landing_id", "landing_file", "body")
    rows.write.format("landing").option("source", source).mode("append").save(root)
