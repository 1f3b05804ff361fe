"""File and table readers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

Schema = StructType | str


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema | None = None,
    as_text: bool = False,
    **options: str,
) -> DataFrame:
    """A CSV with a header line.

    A declared schema is applied by position; without one the types are
    inferred, or all left as text with ``as_text``. Declare
    ``_corrupt_record string`` in the schema to keep unreadable lines.
    """
    reader = (
        spark.read.option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("mode", "PERMISSIVE")
        .options(**options)
    )
    if schema is not None:
        reader = reader.schema(schema)
    elif not as_text:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema | None = None,
    multiline: bool = False,
    recursive: bool = True,
    **options: str,
) -> DataFrame:
    """JSON lines, or one array per file with ``multiline``; subfolders are read too."""
    reader = (
        spark.read.option("multiLine", multiline)
        .option("recursiveFileLookup", recursive)
        .options(**options)
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def read_orc(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.orc(list(paths))


def has_format(spark: SparkSession, fmt: str) -> bool:
    """Whether the session carries the data source (Avro and Kafka come as extra jars)."""
    try:
        spark.read.format(fmt).schema("x int").load("/nonexistent-for-format-check")
    except Exception as error:
        return "DATA_SOURCE_NOT_FOUND" not in str(error) and "Failed to find" not in str(error)
    return True


def read_avro(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("avro").load(path)


def read_xml(
    spark: SparkSession, path: str, row_tag: str, schema: Schema | None = None, **options: str
) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def xml_children(df: DataFrame, *children: str) -> DataFrame:
    """One row per named child element of each row, when the children share a shape."""
    return df.selectExpr(f"inline(array({', '.join(f'`{c}`' for c in children)}))")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A database table; with ``column`` and ``bounds`` it is read in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if column and bounds:
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as top-level columns named ``outer<sep>inner``; arrays stay."""

    def leaves(schema: StructType, path: str, label: str) -> list:
        found = []
        for field in schema.fields:
            full = f"{path}.`{field.name}`" if path else f"`{field.name}`"
            name = f"{label}{sep}{field.name}" if label else field.name
            if isinstance(field.dataType, StructType):
                found += leaves(field.dataType, full, name)
            else:
                found.append(F.col(full).alias(name))
        return found

    return df.select(*leaves(df.schema, "", ""))


def read_landing(
    spark: SparkSession, directory: str, names: Sequence[str], schema: Schema, **options: str
) -> DataFrame:
    """Named files of a delivery folder, with the file each row came from."""
    paths = [f"{directory.rstrip('/')}/{name}" for name in names]
    return read_csv(spark, paths, schema, **options).select("*", "_metadata.file_name")


def read_seed(spark: SparkSession, path: str, column_types: Mapping[str, str]) -> DataFrame:
    """A small typed lookup file; codes declared as string stay text."""
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in column_types.items())
    return read_csv(spark, path, ddl)


def load(
    spark: SparkSession, uri: str, fmt: str, like: DataFrame | StructType | str | None = None
) -> DataFrame:
    """Read ``uri`` in the declared format with the schema of its destination.

    ``like`` is that destination: a table name, a frame or a schema.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if like is not None:
        if isinstance(like, str):
            like = spark.table(like)
        reader = reader.schema(like if isinstance(like, StructType) else like.schema)
    return reader.load(uri)


def first_usable(
    spark: SparkSession, candidates: Sequence[str | Callable[[SparkSession], DataFrame]]
) -> DataFrame:
    """The first candidate that can be read and has a row.

    A candidate is a table name, a Parquet path or a reading function. Repeats
    are tried once. Failures of Spark and of input are listed when none is
    usable; any other error is one of the reading function and is raised.
    """
    errors = []
    for candidate in dict.fromkeys(c for c in candidates if c):
        try:
            if callable(candidate):
                df = candidate(spark)
            elif "/" in candidate:
                df = spark.read.parquet(candidate)
            else:
                df = spark.table(candidate)
            if not df.isEmpty():
                return df
            errors.append(f"{candidate}: no rows")
        except (PySparkException, Py4JJavaError, OSError) as error:
            errors.append(f"{candidate}: {type(error).__name__}: {str(error).splitlines()[0]}")
    raise RuntimeError("no usable source:\n" + "\n".join(errors))
