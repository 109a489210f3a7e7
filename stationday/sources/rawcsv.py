"""Raw CSV files in a legacy encoding, with a header of their own each, as text columns.

Two scans give the same rows:

* ``payload_rows`` takes one payload per row, as landed objects are. Header and lines sit in that row, so columns
  are resolved and records split without any shuffle or join.
* ``file_rows`` takes files of any size, read once as splittable lines, so that one huge file is spread over
  many tasks; a file's header is joined back by its path.

The header is the first line that is not empty. A quoted field may hold line breaks, which become ``\\n``. What
is wrong with a file or a line is an error, or, with ``failure``, a message in the column of that name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationday.functions.checked import first_failure
from stationday.functions.text import checked_csv_fields, checked_position, matching_names
from stationday.functions.time import snapshot_date
from stationday.operators.joins import broadcast_if_small
from stationday.session import java_charsets, work_folder

# target names to header patterns; a pattern may depend on ``filename``, so it may be a Column
Columns = Mapping[str, str | Column]

#: Lines of one record at most; a quote that is still open then never closes.
RECORD_LINES = 10_000
_LINE_BREAK = r"\r\n|\n|\r"
_RECORD_MARK = "\u0002"
_UNREADABLE = "\ufffd"
OBJECT_KEY = r"(?:^|/)(\d{8})/([^/]+)$"


def object_key_columns(path: Column, pattern: str = OBJECT_KEY) -> tuple[Column, Column]:
    """``(snapshot_date, filename)`` from the ``YYYYMMDD/filename`` end of a path."""
    day = snapshot_date(F.regexp_extract(path, pattern, 1))
    name = F.regexp_extract(path, pattern, 2)
    return day, name


def _with_layout(heads: DataFrame, keep: list[str], columns: Columns) -> DataFrame:
    """Replaces the header line ``header`` by ``layout``: where each wanted column stands in a file, how many fields a line
    must have, and what is wrong with the header. Step by step, so that no expression holds another many times."""
    fields = checked_csv_fields(F.coalesce("header", F.lit("")))
    read = heads.select(*keep, fields.value.alias("_names"), fields.failure.alias("_malformed"))
    read = read.withColumn("_names", F.coalesce("_names", F.array()))
    patterns = {t: F.lit(p) if isinstance(p, str) else p for t, p in columns.items()}
    matched = read.withColumns({f"_{t}": matching_names(F.col("_names"), p) for t, p in patterns.items()})
    places = {t: checked_position(F.col("_names"), p, F.col(f"_{t}")) for t, p in patterns.items()}
    layout = F.struct(
        F.size("_names").alias("width"),
        first_failure(F.col("_malformed"), *(p.failure for p in places.values())).alias("failure"),
        *(p.found.alias(target) for target, p in places.items()),
    )
    return matched.select(*keep, layout.alias("layout"))


def _select_fields(lines: DataFrame, columns: Columns, keep: list[str], failure: str | None) -> DataFrame:
    """The wanted fields of each line as trimmed texts, NULL where empty."""
    read = checked_csv_fields(F.col("line"))
    width = F.concat(
        F.lit("Expected "), F.col("layout.width"), F.lit(" fields, found "), F.size("fields"), F.lit(" in line: "), F.col("line")
    )
    wrong = F.size("fields") != F.col("layout.width")
    texts = [F.nullif(F.get("fields", F.col(f"layout.{t}") - 1), F.lit("")).alias(t) for t in columns]
    if failure is None:
        split = lines.withColumn("fields", read.or_raise())
        checked = (
            F.when(F.col("layout.failure").isNotNull(), F.raise_error(F.col("layout.failure")))
            .when(wrong, F.raise_error(width))
            .otherwise(F.col("fields"))
        )
        return split.withColumn("fields", checked).select(*keep, *texts)
    unreadable = F.concat(F.lit("Unreadable characters in line: "), F.col("line"))
    problem = first_failure(
        F.when(F.contains("line", F.lit(_UNREADABLE)), unreadable), F.col("layout.failure"), F.col("_malformed"), F.when(wrong, width)
    )
    split = lines.withColumns({"fields": read.value, "_malformed": read.failure}).withColumn(failure, problem)
    sound = split.withColumn("fields", F.when(F.col(failure).isNull(), F.col("fields")))
    return sound.select(*keep, *texts, failure)


def records(text: Column) -> Column:
    """The lines of a text; line breaks between quotes do not end one, and become ``\\n``."""
    outside = lambda part, i: F.when(i % 2 == 0, F.regexp_replace(part, _LINE_BREAK, _RECORD_MARK)).otherwise(
        F.regexp_replace(part, r"\r\n|\r", "\n")
    )
    marked = F.array_join(F.transform(F.split(text, '"'), outside), '"')
    several = F.contains(text, F.lit('"')) & ~F.contains(text, F.lit(_RECORD_MARK))
    return F.when(several, F.split(marked, _RECORD_MARK)).otherwise(F.split(text, _LINE_BREAK))


def payload_rows(payloads: DataFrame, charset: str, columns: Columns, failure: str | None = None) -> DataFrame:
    """Rows of CSV payloads: every column of ``payloads`` but ``content``, ``row_no``, the texts.

    Decoding is strict; a header that is missing or given twice, or a line of the wrong width, is
    an error, or a message in the column ``failure`` names.
    """
    keep = [c for c in payloads.columns if c != "content"]
    with java_charsets(payloads.sparkSession, strict=failure is None):
        decoded = payloads.select(*keep, records(F.decode("content", charset)).alias("lines"))
    head = F.array_position(F.transform("lines", lambda line: line != ""), F.lit(True)).cast("int")
    headed = decoded.withColumn("head", head).withColumn("header", F.get("lines", F.col("head") - 1))
    lines = (
        _with_layout(headed, [*keep, "head", "lines"], columns)
        # the outer form: for the inner one Spark would infer a filter that decodes the payload again
        .select(*keep, "head", "layout", F.posexplode_outer("lines").alias("row_no", "line"))
        .where("row_no >= head AND line <> ''")
    )
    return _select_fields(lines, columns, [*keep, "row_no"], failure)


def _path_columns(df: DataFrame, path: Column, pattern: str) -> DataFrame:
    day, name = object_key_columns(path, pattern)
    return df.withColumns({"snapshot_date": day, "filename": name})


def file_payloads(
    spark: SparkSession, path: str | list[str], pattern: str = OBJECT_KEY, only: str | None = None
) -> DataFrame:
    """``snapshot_date, filename, path, length, content`` of every file below ``path``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if only:
        reader = reader.option("pathGlobFilter", only)
    files = reader.load(path)
    return _path_columns(files, F.col("path"), pattern).select(
        "snapshot_date", "filename", "path", "length", "modificationTime", "content"
    )


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def odd_quotes(text: Column) -> Column:
    """Whether a line has an odd number of quotes; counted in bytes, as the text may not be in UTF-8."""
    unquoted = F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    quotes = F.when(F.contains(text, F.lit('"')), F.octet_length(text) - unquoted).otherwise(0)
    return quotes % 2 == 1


def file_lines(spark: SparkSession, path: str | list[str], only: str | None = None) -> DataFrame:
    """``path, block_start, seq, raw`` of every line, files read once and cut anywhere.

    The line feed, carriage return and quote bytes never occur inside a Shift_JIS character, so files
    can be cut at them before decoding. ``seq`` grows within a block; written down, it stays what it is.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if only:
        reader = reader.option("pathGlobFilter", only)
    text = F.col("value")
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
        text.cast("binary").alias("raw"),
        odd_quotes(text).alias("odd"),
    )
    return _kept(lines, "lines")


def joined_records(lines: DataFrame) -> DataFrame:
    """Lines of files that hold quoted line breaks as records: lines between an odd quote and the next belong together.

    The quotes before a line are those before it in its block and those of the blocks before, of which a file has few. A
    record of more than ``RECORD_LINES`` lines stays in single lines, whose quotes do not close.
    """
    block = ["path", "block_start"]
    odd = F.col("odd").cast("int")
    before = Window.partitionBy(*block).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    within = lines.withColumn("inner", F.coalesce(F.sum(odd).over(before), F.lit(0)))
    blocks = lines.groupBy(*block).agg(F.sum(odd).alias("quotes"))
    earlier = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("outer", F.coalesce(F.sum("quotes").over(earlier), F.lit(0))).drop("quotes")
    marked = within.join(blocks, block).withColumn("starts", (F.col("inner") + F.col("outer")) % 2 == 0).drop("inner", "outer")
    # a record goes by the block and number of its first line; a block may begin inside one of an earlier block
    place = F.struct("block_start", "seq")
    upto = Window.partitionBy(*block).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    own = F.max(F.when(F.col("starts"), F.col("seq"))).over(upto)
    last = marked.where("starts").groupBy(*block).agg(F.max("seq").alias("seq")).select(*block, place.alias("last"))
    carried = blocks.select(*block).join(last, block, "left").withColumn("carried", F.max("last").over(earlier)).drop("last")
    numbered = marked.withColumn("own", own).join(carried, block)
    first = F.when(F.col("own").isNotNull(), F.struct(F.col("block_start"), F.col("own").alias("seq"))).otherwise(F.col("carried"))
    numbered = numbered.withColumn("record", first).drop("own", "carried")
    sizes = numbered.groupBy("path", "record").agg(F.count(F.lit(1)).alias("size"))
    sized = _kept(numbered.join(sizes, ["path", "record"]), "records")
    parts = F.array_sort(F.collect_list(F.struct("block_start", "seq", "raw")))
    text = lambda part: F.decode(part["raw"], "ISO-8859-1")  # noqa: E731  # bytes as they are
    whole = (
        sized.where(f"size > 1 AND size <= {RECORD_LINES}")
        .groupBy("path", "record")
        .agg(parts.alias("parts"))
        .select("path", "record.*", F.encode(F.array_join(F.transform("parts", text), "\n"), "ISO-8859-1").alias("raw"))
    )
    single = sized.where(f"size = 1 OR size > {RECORD_LINES}")
    return single.select("path", "block_start", "seq", "raw").unionByName(whole)


def file_rows(
    spark: SparkSession,
    path: str | list[str],
    charset: str,
    columns: Columns,
    pattern: str = OBJECT_KEY,
    only: str | None = None,
    failure: str | None = None,
) -> DataFrame:
    """Rows of the files below ``path``, of any size; ``only`` is a glob of file names."""
    return line_rows(file_lines(spark, path, only), charset, columns, pattern, failure)


def line_rows(
    lines: DataFrame, charset: str, columns: Columns, pattern: str = OBJECT_KEY, failure: str | None = None
) -> DataFrame:
    """Rows of ``file_lines``, of files or of landed chunks."""
    spark = lines.sparkSession
    broken = lines.where("odd").select("path").distinct()
    if not broken.isEmpty():
        paired = joined_records(lines.join(broadcast_if_small(broken), "path", "left_semi"))
        lines = lines.join(broadcast_if_small(broken), "path", "left_anti").drop("odd").unionByName(paired)
    lines = lines.where(F.octet_length("raw") > 0)
    with java_charsets(spark, strict=failure is None):
        lines = lines.select("path", "block_start", "seq", F.decode("raw", charset).alias("line"))
    # numbers only are aggregated; a file's first line is then looked at
    first = lines.where("block_start = 0").groupBy("path").agg(F.min("seq").alias("head"))
    first = _kept(first, "heads")
    heads = lines.where("block_start = 0").join(broadcast_if_small(first), "path").where("seq = head")
    heads = _path_columns(heads, F.col("path"), pattern).withColumnRenamed("line", "header")
    heads = _with_layout(heads, ["path", "snapshot_date", "filename", "head"], columns)
    body = lines.join(broadcast_if_small(heads, bounded_by=first), "path").where("block_start > 0 OR seq <> head")
    return _select_fields(body, columns, ["snapshot_date", "filename"], failure)
