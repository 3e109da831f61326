"""A store of the newest row of each key, in buckets: an update rewrites the buckets that it touches, and readers see one version."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .state import latest


class BucketStore:
    """Under `path`: data/<version>-<run>/bucket=<b>/ and versions/<number>.json, which says where each bucket lies.

    A version is the pointer file that is made last and in one step; until then nobody reads what an update has written,
    so an update that fails leaves the store as it was. Of two updates that begin at one version the second to end fails,
    and is to be run again. Rows are known by key; at and tie say which is newest. Null keys are a key. Old versions stay
    readable until `vacuum`. buckets is fixed for a store, and a bucket's rows lie in `files` files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, at: str, tie: str, buckets: int = 64, files: int = 1):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.at, self.tie, self.buckets, self.files = key, at, tie, buckets, files
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._hadoop.Path(f"{self.path}/versions"))

    def versions(self) -> list[int]:
        found = [x.getPath().getName() for x in self._fs.listStatus(self._hadoop.Path(f"{self.path}/versions"))]
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and n[0] != "_")

    def places(self, version: int | None = None) -> dict[int, str]:
        """Folder of each bucket, at most one for each; of the newest version by default."""
        versions = self.versions()
        if not versions:
            return {}
        lines = self.spark.read.text(f"{self.path}/versions/{versions[-1] if version is None else version}.json").collect()
        return {int(b): at for b, at in json.loads(lines[0][0]).items()}

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.places(version))

    def _rows(self, places: dict[int, str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{at}/bucket={b}" for b, at in sorted(places.items())])

    def _bucket(self, spread: int = 1):
        hashed = F.pmod(F.xxhash64(self.key), F.lit(self.buckets * spread))
        return F.floor(hashed / spread).cast("int") if spread > 1 else hashed.cast("int")

    def upsert(self, rows: DataFrame) -> int:
        """Puts rows in and gives the new version's number. Only buckets that rows fall into are read and written."""
        base = self.versions()
        places = self.places(base[-1]) if base else {}
        rows = rows.select(*self.schema.names)
        touched = [r[0] for r in rows.select(self._bucket(self.files).alias("b")).distinct().collect()]  # buckets of them at most
        at = f"{(base or [0])[-1] + 1:08d}-{uuid.uuid4().hex[:8]}"
        if touched:
            held = self._rows({b: x for b, x in places.items() if b in touched})
            newest = latest(held.unionByName(rows), self.key, self.at, self.tie).select(*self.schema.names)
            dealt = newest.withColumns({"_part": F.pmod(F.xxhash64(self.key), F.lit(self.buckets * self.files)), "bucket": self._bucket(self.files)})
            dealt.repartition("_part").drop("_part").write.partitionBy("bucket").parquet(f"{self.path}/data/{at}")
        self._publish((base or [0])[-1] + 1, places | {b: at for b in touched})
        return (base or [0])[-1] + 1

    def _publish(self, version: int, places: dict[int, str]) -> None:
        """Makes the pointer under a name of its own, then gives it its number, which fails if there is such a version."""
        held, final = (self._hadoop.Path(f"{self.path}/versions/{x}") for x in (f"_{uuid.uuid4().hex}", f"{version}.json"))
        out = self._fs.create(held, False)
        out.write(bytearray(json.dumps(places).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(held, final):
            self._fs.delete(held, False)
            raise RuntimeError(f"version {version} of {self.path} has been made meanwhile; run the update again")

    def vacuum(self, keep: int = 1) -> None:
        """Forgets all but the newest versions, and deletes data that these don't read."""
        versions = self.versions()
        used = {at for v in versions[-keep:] for at in self.places(v).values()}
        for v in versions[:-keep]:
            self._fs.delete(self._hadoop.Path(f"{self.path}/versions/{v}.json"), False)
        for x in self._fs.listStatus(self._hadoop.Path(f"{self.path}/data")):
            if x.getPath().getName() not in used:
                self._fs.delete(x.getPath(), True)
