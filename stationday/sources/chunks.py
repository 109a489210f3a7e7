"""Raw objects of any size, landed byte for byte as ordered chunks of whole lines.

A landed object of the usual kind is one value. A larger one is read as splittable lines and kept in
chunks of about ``CHUNK_BYTES``, one row each with its offset and digest; a manifest has the object's
size, number of chunks and the digest of its chunks' digests in order, which can be computed in parts. Chunks are
read back as lines, so a large object is cleaned by many tasks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationday.errors import VerificationError
from stationday.functions.time import snapshot_key
from stationday.operators.joins import first_and_total, in_all
from stationday.session import work_folder
from stationday.sources.published import read_declared
from stationday.sources.rawcsv import OBJECT_KEY, object_key_columns, odd_quotes

CHUNK_BYTES = 8 * 1024 * 1024
CHUNK_DDL = (
    "object_key string, offset long, size long, sha256 string, content binary, snapshot_date date, filename string"
)
MANIFEST_DDL = "object_key string, size long, chunks long, sha256 string, snapshot_date date, filename string"
_LATIN = "ISO-8859-1"  # bytes as they are


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunk_rows(
    spark: SparkSession, paths: list[str], min_bytes: int, pattern: str = OBJECT_KEY, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Chunks of the files above ``min_bytes`` below ``paths``, in ``CHUNK_DDL``."""
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(paths)
    lines = _kept(
        text.where(F.col("_metadata.file_size") > min_bytes).select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("seq"),
            F.col("value").cast("binary").alias("raw"),
        ),
        "chunk-lines",
    )
    length = F.octet_length("raw").cast("long") + 1
    blocks = lines.groupBy("path", "file_size", "block_start").agg(F.sum(length).alias("bytes"))
    earlier = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    # a file whose last line has no line feed is one byte shorter than its lines with theirs
    blocks = blocks.withColumn("before", F.coalesce(F.sum("bytes").over(earlier), F.lit(0))).withColumn(
        "open", F.sum("bytes").over(Window.partitionBy("path")) > F.col("file_size")
    )
    within = Window.partitionBy("path", "block_start").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.drop("file_size").withColumn("start", F.coalesce(F.sum(length).over(within), F.lit(0)))
    placed = placed.join(blocks, ["path", "block_start"]).withColumn("chunk", F.expr(f"start div {chunk_bytes}"))
    parts = F.array_sort(F.collect_list(F.struct("seq", "raw")))
    chunks = placed.groupBy("path", "file_size", "open", "block_start", "before", "chunk").agg(
        F.min("start").alias("start"), parts.alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda p: F.decode(p["raw"], _LATIN)), "\n")
    content = F.encode(F.concat(joined, F.lit("\n")), _LATIN)
    offset = F.col("before") + F.col("start")
    rows = chunks.select("path", "file_size", "open", offset.alias("offset"), content.alias("content"))
    last = F.col("open") & (F.col("offset") + F.octet_length("content") > F.col("file_size"))
    whole = F.when(last, F.substring("content", 1, F.octet_length("content") - 1)).otherwise(F.col("content"))
    day, name = object_key_columns(F.col("path"), pattern)
    rows = rows.select("offset", whole.alias("content"), day.alias("snapshot_date"), name.alias("filename"))
    return rows.select(
        F.concat_ws("/", snapshot_key(F.col("snapshot_date")), F.col("filename")).alias("object_key"),
        "offset",
        F.octet_length("content").cast("long").alias("size"),
        F.sha2("content", 256).alias("sha256"),
        "content",
        "snapshot_date",
        "filename",
    )


def manifest(chunks: DataFrame) -> DataFrame:
    """One row for each object: its size, its number of chunks, the digest of their digests in order; in ``MANIFEST_DDL``."""
    digests = F.transform(F.array_sort(F.collect_list(F.struct("offset", "sha256"))), lambda c: c["sha256"])
    return chunks.groupBy("object_key", "snapshot_date", "filename").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("chunks"), F.sha2(F.array_join(digests, ""), 256).alias("sha256")
    ).select("object_key", "size", "chunks", "sha256", "snapshot_date", "filename")


def _overwrite(df: DataFrame, path: str) -> None:
    df.write.partitionBy("snapshot_date", "filename").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_chunks(chunks: DataFrame, path: str) -> DataFrame:
    """Write chunks and their manifest, read them back and compare; returns the manifest of the objects written."""
    spark = chunks.sparkSession
    staged = _kept(chunks, "chunks")
    sent = _kept(manifest(staged), "chunk-manifest")
    _overwrite(staged, f"{path}/chunks")
    _overwrite(sent, f"{path}/manifest")
    verify_chunks(spark, path, sent)
    return sent


def verify_chunks(spark: SparkSession, path: str, objects: DataFrame | None = None) -> None:
    """Compare chunks with their digests, offsets and the manifest: a changed, lost or doubled chunk is an error."""
    stored = read_declared(spark, f"{path}/chunks", spark.createDataFrame([], CHUNK_DDL).schema)
    wanted = read_declared(spark, f"{path}/manifest", spark.createDataFrame([], MANIFEST_DDL).schema)
    if objects is not None:
        wanted = wanted.join(objects.select("object_key"), "object_key", "left_semi")
    found = stored.withColumns({"sha256": F.sha2("content", 256), "size": F.octet_length("content").cast("long")})
    before = Window.partitionBy("object_key").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    gaps = (
        found.select("object_key", "offset", "size")
        .withColumn("end", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .where("end <> offset")
        .select("object_key")
    )
    same = ["object_key", "size", "chunks", "sha256"]
    lost = wanted.join(manifest(found), same, "left_anti").select("object_key")
    wrong = lost.unionByName(gaps.join(wanted, "object_key", "left_semi")).distinct()
    shown, total = first_and_total(wrong, "object_key")
    if total:
        keys = [row[0] for row in shown]
        raise VerificationError(f"Objects not landed whole in chunks: {keys!r}{in_all(keys, total)}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The manifest of chunked objects, if there are any."""
    try:
        return read_declared(spark, f"{path}/manifest", spark.createDataFrame([], MANIFEST_DDL).schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def chunk_lines(spark: SparkSession, path: str, chosen: Column) -> DataFrame:
    """Lines of the chosen objects as ``rawcsv.file_lines`` gives those of files; a chunk is a block."""
    stored = read_declared(spark, f"{path}/chunks", spark.createDataFrame([], CHUNK_DDL).schema).where(chosen)
    text = F.decode("content", _LATIN)
    lines = F.split(F.regexp_replace(text, r"\r\n|\r", "\n"), "\n")
    # what follows a chunk's last line feed is the next chunk's
    own = F.when(F.endswith(text, F.lit("\n")), F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    exploded = stored.select(F.col("object_key").alias("path"), F.col("offset").alias("block_start"), F.posexplode(own).alias("seq", "line"))
    return exploded.select(
        "path", "block_start", F.col("seq").cast("long"), F.encode("line", _LATIN).alias("raw"), odd_quotes(F.col("line")).alias("odd")
    )
