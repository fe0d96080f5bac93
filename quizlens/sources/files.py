"""Readers of delivered files. Schemas are always declared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quizlens.functions import file_name
from quizlens.schemas import STRUCTURE_FILE


def read_csv(spark: SparkSession, path: str | list[str], schema: str, sep: str = ",", header: bool = True,
             escape: str = "\\", multi_line: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """CSV with quoted text over several lines. A file with multi_line is read by one task; turn it off for files
    known to have one record per line, which Spark then splits. Stage the rows of a file in a charset of Java's own inside java_charsets."""
    return spark.read.csv(path, schema=schema, sep=sep, header=header, escape=escape, multiLine=multi_line, encoding=encoding)


def read_structure_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Structure files: ';', no heading, plain or gzipped. Adds line_no, the order of the rows inside the files."""
    raw = spark.read.csv(path, schema=STRUCTURE_FILE, sep=";", header=False)
    # ids grow with the rows of a file split; splits are ordered by file and offset
    return raw.withColumn("line_no", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row")))


def with_line_numbers(scan: DataFrame) -> DataFrame:
    """A file scan with `archive` (the file's name) and `line_no`, the number of the record in its file, from 1.

    A large file is read in blocks by several tasks, so the numbers are found in two passes: the first counts the records of each block, a
    running sum over a file's blocks gives where each block begins. The table of blocks is narrow, one row per block. Inside a block the records keep
    their order; the ids that Spark deals to them are consecutive there.
    """
    block = ["__file", "__start"]
    rows = scan.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
                       F.col("_metadata.file_name").alias("archive"), F.monotonically_increasing_id().alias("__row"))
    blocks = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    before = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    at = F.col("__row") - F.col("__first")
    # both passes must deal the same blocks to the same tasks, or the numbers would be wrong
    number = F.when((at >= 0) & (at < F.col("__n")), F.col("__before") + at + 1).otherwise(F.raise_error(F.lit("a file changed while its lines were numbered")).cast("bigint"))
    return rows.join(blocks, block).withColumn("line_no", number).drop(*block, "__row", "__first", "__n", "__before")


def read_renamed_csv(spark: SparkSession, path: str, schema: str, names: list[str], sep: str = ";") -> DataFrame:
    """A column subset under new names, as a COPY with a column list does."""
    return read_csv(spark, path, schema, sep=sep, multi_line=False).toDF(*names)


def list_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(path, name, length) of the files with a suffix; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path)
            .select("path", file_name(F.col("path")).alias("name"), "length"))


def listed_names(spark: SparkSession, list_path: str) -> DataFrame:
    """File names out of a text file with one address per line."""
    lines = spark.read.text(list_path)
    return lines.select(file_name(F.col("value")).alias("name")).where(F.col("name") != "")


def sizes_of_listed(spark: SparkSession, list_path: str, folder: str) -> DataFrame:
    """Size of each listed file that has landed in a folder; null for one that has not."""
    return listed_names(spark, list_path).join(list_files(spark, folder, ""), "name", "left").select("name", "length")


def read_event_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tracking-log lines (plain or gzipped JSON). A line that yields none of the fields keeps its text in _corrupt.

    json_tuple parses a line once, however many fields and filters use it, and leaves nested values as text: `event` is
    an object in some rows and a text in others. A gzipped file is one task; the readers downstream filter before they
    spread the rows. line_no is the line's number in its file, also where a large plain file is read by several tasks.
    """
    raw = with_line_numbers(spark.read.text(path))
    fields = ["username", "event_type", "event_source", "time", "context", "event"]
    lines = raw.select("*", F.json_tuple("value", *fields).alias(*fields))
    no_field = F.coalesce(*[F.col(f) for f in fields]).isNull()
    return lines.select(
        "archive", "line_no", "username", F.get_json_object("context", "$.user_id").try_cast("bigint").alias("user_id"),
        F.get_json_object("context", "$.course_id").alias("course_id"), "event_type", "event_source", "time", "event",
        F.when(no_field, F.col("value")).alias("_corrupt"))


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 1, **options: str) -> DataFrame:
    """A query of a relational source. With a partition column the read is split into `partitions` ranges."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    return (reader.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
            .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", partitions).load())


def with_types(df: DataFrame, schema: str) -> DataFrame:
    """Casts text columns to a schema; text that does not fit becomes null."""
    fields = T._parse_datatype_string(schema).fields
    extra = [c for c in df.columns if c not in {f.name for f in fields}]
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields], *extra)
