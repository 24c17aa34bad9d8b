"""File sources: archives, JSON lines, manifests, schema packs, query results, staged documents."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

OBJECT = "type string, key string, properties map<string, variant>"
RELATIONSHIP = "type string, srcKey string, dstKey string, properties map<string, variant>"
ITEM = (
    "id string, course string, semester string, question string, gold_points array<string>, gold_refs array<string>, legal_area string, language string, source string, source_url string, "
    "oppgave_url string, veiledning_url string, difficulty string, answerable boolean, license string, needs_curation boolean, task string, doc_ref string, out_of_graph boolean"
)
MANIFEST = "counts struct<objects bigint, relationships bigint, by_type map<string, bigint>>, documents map<string, struct<type string, sha256 string>>, archives array<struct<url string, sha256 string, size bigint>>"
CASE = "case_name string, source string, sammendrag string, full_text string, doc_id string, date string, url string, sentences array<struct<text string, hm_score double, rouge1_f double, rouge2_f double>>"


def archive_members(spark: SparkSession, path: str, suffix: str = ".xml", limit: int = 0) -> DataFrame:
    """path, member, ord, content of every such member of compressed archives; limit: the first so many of each archive.

    One task an archive, which it holds packed (2 GB at most, the size of a binary value); unpacked there is one member at a time.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                with tarfile.open(fileobj=io.BytesIO(r.content), mode="r:*") as t:
                    k = 0
                    for m in t:
                        if limit and k >= limit:
                            break
                        if m.isfile() and m.name.endswith(suffix):
                            yield pd.DataFrame([(r.path, m.name, k, t.extractfile(m).read().decode("utf-8", "replace"))], columns=["path", "member", "ord", "content"])
                            k += 1

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, member string, ord int, content string")


def _json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON lines in order of file name and place; a folder that is missing has no rows."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    if not found:
        return spark.createDataFrame([], schema).withColumn("ord", F.lit(0).cast("long"))
    rows = spark.read.schema(schema).json(path)
    return rows.select("*", F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")).alias("ord"))


def objects(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, OBJECT)


def relationships(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, RELATIONSHIP).withColumnsRenamed({"srcKey": "src_key", "dstKey": "dst_key"})


def items(spark: SparkSession, paths: str) -> DataFrame:
    """Evaluation items of a comma list of globs, each file once."""
    return spark.read.schema(ITEM).json(sorted({p.strip() for p in paths.split(",") if p.strip()}))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path)


def cases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CASE).json(path)


def lenient(properties: Column, name: str) -> Column:
    """A property that is a string, else empty."""
    v = F.try_element_at(properties, F.lit(name))
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise("")


def declared_types(spark: SparkSession, path: str) -> DataFrame:
    """section, name of the types that a schema pack declares: "- name:" or "name:" lines below a section's heading."""
    lines = spark.read.option("wholetext", True).text(path).select(F.posexplode(F.split("value", "\n")).alias("n", "line"))
    head = F.regexp_extract("line", r"^([A-Za-z]+):\s*$", 1)
    name = F.regexp_extract("line", r"^\s+-\s+name:\s*[\"']?([A-Za-z_]+)", 1)
    below = Window.partitionBy(F.lit(0)).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)  # a pack is one small file
    marked = lines.select("n", F.last(F.when(head != "", head), ignorenulls=True).over(below).alias("section"), name.alias("name"))
    return marked.where("name <> ''").select("section", "name")


def bindings(rows: DataFrame, column: str = "value") -> DataFrame:
    """One map of variable to value for each binding of JSON query results."""
    schema = "results struct<bindings array<map<string, struct<type string, value string>>>>"
    found = F.from_json(column, schema)["results"]["bindings"]
    return rows.select(F.explode(found).alias("b")).select(F.transform_values("b", lambda _, v: v["value"]).alias("binding"))


def collapse(rows: DataFrame, key: str, scalars: list[str], lists: list[str]) -> DataFrame:
    """Bindings that differ by optional values as one row a key: the first value of scalars, sorted distinct ones of lists."""
    value = lambda v: F.nullif(F.trim(F.try_element_at("binding", F.lit(v))), F.lit(""))
    return rows.withColumn(key, value(key)).where(F.col(key).isNotNull()).groupBy(key).agg(*(F.min(value(s)).alias(s) for s in scalars), *(F.array_sort(F.collect_set(value(x))).alias(x) for x in lists))


def list_or_object(json: Column, element: str) -> Column:
    """An array of elements, also where the source has a single object; null for neither."""
    many, one = F.from_json(json, f"array<{element}>"), F.from_json(json, element)
    return F.when(F.startswith(F.trim(json), F.lit("[")), many).when(F.startswith(F.trim(json), F.lit("{")), F.array(one))


def publications(rows: DataFrame, column: str = "value") -> DataFrame:
    """id (lower case), title, pdfs of an index's publications; of equal ids the last counts. rows need ord."""
    element = "struct<id string, tittel string, pdf_liste array<string>>"
    p = rows.select("ord", F.posexplode(list_or_object(F.col(column), element)).alias("n", "p")).select("ord", "n", F.lower("p.id").alias("id"), F.col("p.tittel").alias("title"), F.col("p.pdf_liste").alias("pdfs"))
    return p.groupBy("id").agg(F.max_by(F.struct("title", "pdfs"), F.struct("ord", "n")).alias("p")).select("id", "p.*")


def sessions(spark: SparkSession, first: int = 1999, last: int = 2026, kinds: tuple[str, ...] = ("innst", "prop")) -> DataFrame:
    """session, kind of an index's parts."""
    years = spark.range(first, last + 1).select(F.concat(F.col("id").cast("string"), F.lit("-"), (F.col("id") + 1).cast("string")).alias("session"))
    return years.select("session", F.explode(F.array(*map(F.lit, kinds))).alias("kind"))


def match_publications(slugs: DataFrame, index: DataFrame, candidates: str = "candidates", number: str = "number") -> DataFrame:
    """slug, id of the first candidate that the index has, if its title names the number too."""
    c = slugs.select("slug", number, F.posexplode(candidates).alias("n", "cid"))
    hits = c.join(index.select(F.col("id").alias("cid"), "title"), "cid").groupBy("slug", number).agg(F.min_by(F.struct("cid", "title"), "n").alias("h"))
    named = F.regexp_like("h.title", F.concat(F.lit(r"(?<!\d)0*"), F.col(number), F.lit(r"(?!\d)")))
    return hits.where(named).select("slug", F.col("h.cid").alias("id"))


def is_scanned(text: Column) -> Column:
    """Whether extracted text is so short that the document must be a scan."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s", "")) < 200


def entity_id(entity: Column, canonical: Column, id_: Column) -> Column:
    return F.coalesce(F.nullif(entity, F.lit("")), F.nullif(canonical, F.lit("")), id_)
