"""The published table: all snapshots, columns matched by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stationday.schemas import CONDITIONS_SCHEMA

#: Numbers that hold all numbers before them in their row.
_WIDER = ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType), (T.IntegerType, T.DoubleType))


def read_declared(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A partitioned Parquet table under a declared schema, in that schema's column order."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_published(
    spark: SparkSession, root: str, schema: T.StructType = CONDITIONS_SCHEMA, undeclared: bool = False
) -> DataFrame:
    """All published snapshots under one declared schema.

    Columns a file lacks are NULL and narrower number types are widened. The schema is declared,
    so no file footer is opened to infer it; the ``date`` partitions prune a query by date. With ``undeclared``,
    columns that some file has beyond the declared ones follow (``undeclared_fields``, which reads the footers once).
    """
    extra = undeclared_fields(spark, root, schema) if undeclared else []
    return read_declared(spark, root, T.StructType([*schema.fields, *extra]))


def wider(a: T.DataType, b: T.DataType, name: str) -> T.DataType:
    """The narrowest type that holds both; columns of nested types are matched by name."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return wider_schema(a, b, f"{name}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType, name))
    for row in _WIDER:
        places = [row.index(type(t)) if type(t) in row else -1 for t in (a, b)]
        if min(places) >= 0:
            return (a, b)[places.index(max(places))]
    raise TypeError(f"Column {name} is {a.simpleString()} in some files and {b.simpleString()} in others")


def wider_schema(a: T.StructType, b: T.StructType, prefix: str = "") -> T.StructType:
    """The columns of both, in the order of ``a``, each in the wider of its types."""
    types = {f.name: f.dataType for f in a}
    for f in b:
        types[f.name] = wider(types[f.name], f.dataType, prefix + f.name) if f.name in types else f.dataType
    return T.StructType([T.StructField(name, dtype) for name, dtype in types.items()])


def files_schema(spark: SparkSession, root: str) -> T.StructType:
    """One schema of all files below ``root``, types widened where files differ.

    Spark merges footers in a distributed job but refuses differing types. The files are then halved until each part
    merges, and the parts' schemas are widened into one: a few jobs for each change of a type, not one for each day.
    """
    paths = sorted(spark.read.parquet(root).inputFiles())
    reader = spark.read.option("mergeSchema", "true").option("basePath", root)

    def schema(part: list[str]) -> T.StructType:
        try:
            return reader.parquet(*part).schema
        except Exception as error:  # a Java error without a class of its own in PySpark
            if len(part) == 1 or "CANNOT_MERGE" not in str(error):
                raise
        middle = len(part) // 2
        return wider_schema(schema(part[:middle]), schema(part[middle:]))

    return schema(paths) if paths else T.StructType([])


def undeclared_fields(spark: SparkSession, root: str, schema: T.StructType = CONDITIONS_SCHEMA) -> list[T.StructField]:
    """Columns present in some file but not in the declared schema, by name."""
    found = files_schema(spark, root)
    return sorted((f for f in found if f.name not in schema.fieldNames()), key=lambda f: f.name)
