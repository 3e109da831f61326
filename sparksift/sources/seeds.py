"""Where candidates come from: seed files, search harvests, captured pages, screenshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import host_of
from ..schemas import SEARCH_HIT, SEED
from .sheets import read_excel

ENGINES = ("bing", "duckduckgo", "google", "yahoo")


def csv_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Malformed lines keep their text in _corrupt_record."""
    return spark.read.schema(SEED).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").csv(path)


def excel_seeds(spark: SparkSession, path: str) -> DataFrame:
    return read_excel(spark, path, SEED)


def seed_hosts(seeds: DataFrame) -> DataFrame:
    """host of each readable seed; rows without one go (count them on the input)."""
    return seeds.select(host_of(F.col("domain")).alias("host")).filter("host IS NOT NULL").distinct()


class HarvestPartition(InputPartition):
    def __init__(self, engine: str, keyword: str):
        super().__init__((engine, keyword))
        self.engine, self.keyword = engine, keyword


class HarvestReader(DataSourceReader):
    """One partition for each engine and keyword. This reader makes hits by a rule; a live one replaces `search`."""

    def __init__(self, options):
        self.keywords = [k for k in options.get("keywords", "").split("|") if k]
        self.pages = int(options.get("results", "10"))

    def partitions(self):
        return [HarvestPartition(e, k) for e in ENGINES for k in self.keywords]

    def search(self, engine: str, keyword: str) -> Iterator[str]:
        slug = keyword.replace(" ", "-")
        for rank in range(self.pages):
            yield f"https://www.{slug}-{(rank * (1 + ENGINES.index(engine))) % self.pages}.example.com/?src={engine}"

    def read(self, partition):
        seen = dt.datetime(2024, 1, 1)
        for rank, url in enumerate(self.search(partition.engine, partition.keyword), 1):
            yield (partition.engine, partition.keyword, rank, url, seen + dt.timedelta(minutes=rank))


class HarvestSource(DataSource):
    @classmethod
    def name(cls):
        return "harvest"

    def schema(self):
        return SEARCH_HIT

    def reader(self, schema):
        return HarvestReader(self.options)


def harvest(spark: SparkSession, keywords: list[str], results: int = 10) -> DataFrame:
    spark.dataSource.register(HarvestSource)
    return spark.read.format("harvest").option("keywords", "|".join(keywords)).option("results", str(results)).load()


def keyword_list(spark: SparkSession, path: str) -> DataFrame:
    """One keyword a line; blank lines and lines that begin with # go."""
    return spark.read.text(path).select(F.trim("value").alias("term")).filter("term <> '' AND NOT startswith(term, '#')").distinct()


#: What opening a file counts as when files are dealt to tasks. Spark's 4 MB lets a task have 32 files, however small.
OPEN_COST = "64k"


def images(spark: SparkSession, path: str) -> DataFrame:
    """The files under path and its folders as Spark reads them, many small ones to a task. In a session of its own, so the caller's settings stay."""
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.files.openCostInBytes", OPEN_COST)
    return own.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def screenshots(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and hash; the bytes don't leave the scan."""
    return images(spark, path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
