"""A sink for files: each row's content becomes a file, and a job's files appear together with their manifest or not at all."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Spark reads no files whose names begin with a line.
MANIFEST = "manifest.jsonl"


@dataclass
class Done(WriterCommitMessage):
    folder: str | None
    partition: int


def opened(path: str):
    """A pyarrow file system and the path in it; one without a scheme is a shared mount."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


class FilesWriter(DataSourceWriter):
    """A task writes into a folder of its attempt, with a manifest beside the files. The commit moves one folder for each task.

    Attempts that failed, or ran beside another, leave nothing: their folders lie under the job's, which goes in the end.
    """

    def __init__(self, path: str):
        self.path, self.job = path.rstrip("/"), uuid.uuid4().hex

    def write(self, rows: Iterator[Row]) -> Done:
        store, root = opened(self.path)
        folder, lines = f"_attempts/{self.job}/{uuid.uuid4().hex}", []
        for row in rows:
            r = row.asDict()
            content = bytes(r.pop("content") or b"")
            if not lines:
                store.create_dir(f"{root}/{folder}", recursive=True)
            with store.open_output_stream(f"{root}/{folder}/{r['name']}") as out:
                out.write(content)
            lines.append(json.dumps(r | {"bytes": len(content), "sha256": hashlib.sha256(content).hexdigest()}))
        if not lines:
            return Done(None, 0)
        with store.open_output_stream(f"{root}/{folder}/{MANIFEST}") as out:
            out.write("\n".join(lines).encode())
        return Done(folder, TaskContext.get().partitionId())

    def commit(self, messages: list[Done]) -> None:
        store, root = opened(self.path)
        job = f"{root}/_attempts/{self.job}"
        store.create_dir(job, recursive=True)
        kept = f"{job}/kept"
        # An empty list, so that a job without files can be read too.
        store.create_dir(f"{kept}/task-none", recursive=True)
        with store.open_output_stream(f"{kept}/task-none/{MANIFEST}"):
            pass
        for m in messages:
            if m and m.folder:
                store.move(f"{root}/{m.folder}", f"{kept}/task-{m.partition:06d}")
        # All at once: one folder for the job.
        store.move(kept, f"{root}/job-{self.job}")
        store.delete_dir(job)

    def abort(self, messages: list[Done | None]) -> None:
        from pyarrow import fs

        store, root = opened(self.path)
        if store.get_file_info(f"{root}/_attempts/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/_attempts/{self.job}")


class Files(DataSource):
    """df.write.format("files").option("path", ...): rows of name, content (binary) and columns of the caller, which the manifest holds."""

    @classmethod
    def name(cls) -> str:
        return "files"

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        if overwrite:
            raise ValueError("files are added, not replaced")
        return FilesWriter(self.options["path"])


def put(files: DataFrame, path: str) -> None:
    """Names are unique within a job; a row's file lies in the folder of its task."""
    files.sparkSession.dataSource.register(Files)
    files.write.format("files").mode("append").option("path", path).save()


def manifest(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """columns (DDL), name, bytes, sha256 and file (its place) of all files of jobs that have ended well."""
    from pyspark.sql import functions as F

    rows = spark.read.schema(f"{columns}, name string, bytes bigint, sha256 string").json(f"{path}/job-*/task-*/{MANIFEST}", pathGlobFilter=MANIFEST)
    return rows.withColumn("file", F.concat(F.regexp_replace(F.input_file_name(), f"{MANIFEST}$", ""), "name"))
