"""Staged files and what is fetched next: digests, publications, a cache of what was parsed, distinct acts and batches of labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from statuta.functions import urls
from statuta.operators.sampling import with_place

MOST_BYTES = 64 << 20
LABEL_BATCH = 50


def files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, name, cache_name, bytes, sha256, content of the files of a folder, wherever Spark reads it; larger ones than a download may be are
    left out."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).where(F.col("length") <= MOST_BYTES)
    name = urls.file_name(F.col("path"))
    return rows.select("path", name.alias("name"), urls.cache_name(name).alias("cache_name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), "content")


def publications(spark: SparkSession, folder: str) -> DataFrame:
    """id, xml of the publications in a folder, named by their id."""
    return files(spark, folder, "*.xml").select(F.regexp_replace("name", r"\.xml$", "").alias("id"), F.col("content").cast("string").alias("xml"))


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows kept at path; made and kept there first if there are none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        make().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def acts_to_fetch(documents: DataFrame, limit: int = 0) -> DataFrame:
    """id of every EU act that documents (celex: array) name, once, in upper case and in order; limit: so many at most."""
    ids = documents.select(F.explode("celex").alias("id")).select(F.upper("id").alias("id")).where("id <> ''").distinct()
    return ids.orderBy("id").limit(limit) if limit > 0 else ids


def label_batches(acts: DataFrame, size: int = LABEL_BATCH) -> DataFrame:
    """batch, ids: the distinct concepts of acts (eurovoc: array) in batches of one query each."""
    ids = with_place(acts.select(F.explode("eurovoc").alias("id")).distinct(), ["id"])
    return ids.groupBy(F.floor(F.col("place") / size).alias("batch")).agg(F.array_sort(F.collect_list("id")).alias("ids"))
