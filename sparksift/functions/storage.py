"""Tables between stages: written to the shared folder of the session and read back, so lineage ends there."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in the cluster's shared one. Only where the session names none, as on one machine, a folder of our own, which the context keeps."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sparksift-"))
        where = spark.sparkContext.getCheckpointDir()
    return f"{where.rstrip('/')}/sparksift/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Deletes all that this application has staged, once the caller has kept its results elsewhere; frames made before can't be read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def put_files(files: DataFrame, path: str) -> None:
    """name string, content binary and, if there is one, folder string to files under path, each written by the task that holds it.

    Tasks that write into one folder wait for each other; with folders dealt to tasks they don't (see `in_folders`).
    Tasks copy through pyarrow's file systems, which know the path by its scheme; a path without one is a shared mount.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        where = path if "://" in path else path.removeprefix("file:")
        store, root = fs.FileSystem.from_uri(where) if "://" in where else (fs.LocalFileSystem(), where)
        store.create_dir(root, recursive=True)
        made = {""}
        for batch in batches:
            for name, content, folder in zip(*(c.to_pylist() for c in batch.columns)):
                if folder not in made:
                    store.create_dir(f"{root}{folder}", recursive=True)
                    made.add(folder)
                # Another attempt of the task writes the same bytes; a file appears under its name when it is whole.
                held = f"{root}{folder}/_{name}.{os.getpid()}"
                with store.open_output_stream(held) as out:
                    out.write(content)
                store.move(held, f"{root}{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    folder = F.concat(F.lit("/"), "folder") if "folder" in files.columns else F.lit("")
    files.select("name", "content", folder.alias("folder")).mapInArrow(run, "n bigint").agg(F.sum("n")).collect()


#: Fixed value: a million files are some thousand a folder.
FOLDERS = 512


def in_folders(files: DataFrame) -> DataFrame:
    """files with a folder by name, each folder in one task of a few for each core. For small files, which a shuffle bears."""
    dealt = files.withColumn("folder", F.pmod(F.xxhash64("name"), F.lit(FOLDERS)).cast("string"))
    return dealt.repartition(4 * files.sparkSession.sparkContext.defaultParallelism, "folder")
