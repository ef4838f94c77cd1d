"""Raw files: scans, required files and the manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SOURCES, Source
from .arrays import split_array_records

ARRAY, LONG_ARRAY, LINES = "array", "long array", "lines"

# An array file of more bytes is read by many tasks; below, one task reads it faster.
SPLIT_ABOVE = 32 << 20


def scan_json(spark: SparkSession, path: str, schema: str, layout: str = ARRAY) -> DataFrame:
    """Typed scan of one JSON feed: an array per file, or one object per line.

    An array file is read by one task here; ``raw_records`` splits long ones.
    """
    return spark.read.schema(schema).option("multiLine", layout == ARRAY).option("mode", "PERMISSIVE").json(path)


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Declared columns of a CSV feed, taken by header name; absent ones are NULL."""
    found = read_csv(spark, path)
    fields = T.StructType.fromDDL(schema).fields
    return found.select(*[
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in found.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields
    ])


def read_csv(spark: SparkSession, path: str, *extra: Column) -> DataFrame:
    """All columns of a CSV feed as text, by header name; quoted values may hold line breaks.

    Each header found under the path is read with its own files, so files may order
    their columns differently or add some. A file is read by one task.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    heads = lines.filter(F.trim("value") != "").groupBy("file").agg(F.min_by("value", "at").alias("head"))
    kinds = heads.groupBy("head").agg(F.collect_list("file").alias("files")).collect()  # file names, which the driver lists anyway
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    parts = [reader.csv(sorted(k["files"])).select("*", *extra) for k in kinds]
    if not parts:
        return reader.csv(path).select("*", *extra)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def files_by_layout(spark: SparkSession, path: str, split_above: int = SPLIT_ABOVE) -> dict[str, list[str]]:
    """The feed's files by layout, each told by its own first character; only names reach the driver."""
    text = spark.read.text(path).select(F.substring(F.ltrim("value"), 1, 1).alias("c"), F.col("_metadata.file_path").alias("file"),
                                        F.col("_metadata.file_size").alias("bytes"), F.monotonically_increasing_id().alias("at"))
    first = text.filter(F.col("c") != "").groupBy("file").agg(F.min_by("c", "at").alias("c"), F.max("bytes").alias("bytes"))
    layout = F.when(F.col("c") != "[", LINES).when(F.col("bytes") > split_above, LONG_ARRAY).otherwise(ARRAY).alias("layout")
    return {r["layout"]: sorted(r["files"]) for r in first.groupBy(layout).agg(F.collect_list("file").alias("files")).collect()}


def raw_records(spark: SparkSession, path: str, source: Source, layout: str | None = None, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """``raw`` (the record as JSON text), ``file_name`` and ``row_number`` of every record.

    Lines are kept byte for byte; CSV rows become a JSON object of texts with every
    column of the file. The number counts the file's records (lines: its lines) from 0.
    Without a declared ``layout`` each JSON file is read by its own.
    """
    if source.format == "csv":
        rows = read_csv(spark, path, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_name").alias("_name"))
        names = [c for c in rows.columns if c not in ("_file", "_name")]
        packed = rows.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])).alias("raw"), "_file", F.col("_name").alias("file_name"), F.lit(0).alias("_block"))
        return _numbered(packed)
    if layout == ARRAY:
        return array_records(spark, path)
    files = {layout: path} if layout else files_by_layout(spark, path, split_above)
    readers = {LINES: line_records, ARRAY: array_records, LONG_ARRAY: split_array_records}
    parts = [read(spark, files[kind]) for kind, read in readers.items() if kind in files]
    return reduce(DataFrame.unionByName, parts) if parts else line_records(spark, path)


def line_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of JSON-lines files that are not blank, with their line number."""
    lines = spark.read.text(path).select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("_block"))
    return _numbered(lines).filter(F.trim("raw") != "")


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``row_number``, counted over each file without moving its records.

    Ids rise along a block of a file. Blocks are counted in a first pass (one small row
    per block), and a record's number is its place in the block plus the blocks before.
    Blocks are broadcast: they are the scan's own splits, which the driver lists to plan it.
    """
    rows = rows.withColumn("_id", F.monotonically_increasing_id())
    blocks = rows.groupBy("_file", "_block").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_low")).drop("_low", "_n")
    return rows.join(F.broadcast(blocks), ["_file", "_block"]).select("raw", "file_name", (F.col("_id") + F.col("_start")).cast("int").alias("row_number"))


def array_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The elements of one-array JSON files, with their position from 0.

    Elements are VARIANT on the way, so keys nobody declared and all digits survive. A whole
    file is one row in one task; ``arrays.split_array_records`` reads longer ones. A file
    that is not a readable array gives one record without text, which silver rejects.
    """
    whole = spark.read.text(path, wholetext=True)
    elements = whole.select(
        F.from_json("value", "array<variant>").alias("elements"), F.col("_metadata.file_name").alias("file_name")
    )
    filled = elements.filter(F.col("elements").isNull() | (F.size("elements") > 0))
    return filled.select("file_name", F.posexplode_outer("elements").alias("row_number", "element")).select(
        F.to_json("element").alias("raw"), "file_name", "row_number"
    )


def listed_files(spark: SparkSession, raw_dir: str, with_content: bool = False) -> DataFrame:
    """Relative path (and content) of every file under the raw folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(raw_dir)
    root = spark._jvm.org.apache.hadoop.fs.Path(raw_dir)
    qualified = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/") + "/"
    inside = F.regexp_replace("path", "^file:/+", "file:/")
    relative = F.substring(inside, len(qualified) + 1, 1 << 20)
    return files.select(relative.alias("path"), *(["content"] if with_content else []))


def required_files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s.path, name) for name, s in SOURCES.items()], "path string, source string")


def raw_files_missing(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Required sources with neither a file nor a folder of part files of that name."""
    present = listed_files(spark, raw_dir).select(
        F.regexp_extract("path", r"^(.*?\.(json|csv))(/.*)?$", 1).alias("path")
    ).distinct()
    return required_files(spark).join(present, "path", "left_anti")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) pairs of the ``files`` object of a manifest; an unreadable one has no rows."""
    text = spark.read.text(path, wholetext=True)
    files = F.from_json(F.get_json_object("value", "$.files"), "map<string,string>")
    return text.select(F.explode(files).alias("path", "sha256"))


def manifest_check(spark: SparkSession, raw_dir: str, manifest: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """``ok``, ``changed``, ``missing`` or ``unlisted`` for every file listed or present, but for ``skip``."""
    found = listed_files(spark, raw_dir, with_content=True).select("path", F.sha2("content", 256).alias("found_sha256"))
    found = found.filter(~F.col("path").isin(*skip)) if skip else found
    status = (
        F.when(F.col("found_sha256").isNull(), "missing")
        .when(F.col("sha256").isNull(), "unlisted")
        .when(F.col("found_sha256") == F.lower("sha256"), "ok")
        .otherwise("changed")
    )
    return manifest.join(found, "path", "full").select("path", status.alias("status"))
