"""Tables in and out: stored tables, CSV, warehouse queries, files, inline rows."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold.session import scratch_path


def load_once(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The view of a stored parquet table, registered on first use of that path."""
    view = f"{name}_{hashlib.md5(path.encode()).hexdigest()[:8]}"
    if not spark.catalog.tableExists(view):
        spark.read.parquet(path).createOrReplaceTempView(view)
    return spark.table(view)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with header and a declared schema: one pass, no inference."""
    return spark.read.schema(schema).option("header", True).option("multiLine", False).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Promote a result to the catalog, replacing an older one."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Store rows as a catalog table, in place of an older one of that name, and return the new table.

    The rows are written whole to a new folder below the shared one, and only then does the
    name move to them: a write that fails leaves the old table as it was, and the rows may come
    from the table they replace. Frames that read an old table without partitions go on with
    its files; a partitioned one is looked up by name when it is read.
    """
    spark = df.sparkSession
    staged = f"{name}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", scratch_path(spark, "table"))
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(staged)
    drop_table(spark, name)
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    return spark.table(name)


def promote_table(spark: SparkSession, view: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Make a view of this session a stored table that all sessions of the catalog see.

    A name that is already stored is refused; drop or replace it first. The view stays.
    """
    if spark.catalog.tableExists(name):
        raise ValueError(f"{name} is already stored")
    return replace_table(spark.table(view), name, partition_by)


def copy_table(
    spark: SparkSession, source: str, target: str, columns: Sequence[str] | None = None, where: str | None = None, replace: bool = False
) -> DataFrame:
    """A stored table of the source's rows, or of some columns and the rows for which `where` holds.

    An existing target is refused unless `replace`; the copy does not follow later changes.
    """
    if not replace and spark.catalog.tableExists(target):
        raise ValueError(f"{target} is already stored")
    rows = spark.table(source)
    rows = rows.filter(where) if where is not None else rows
    return replace_table(rows.select(*columns) if columns else rows, target)


def drop_table(spark: SparkSession, name: str) -> bool:
    """Forget a stored table, whose files stay; False if there is none of that name."""
    known = spark.catalog.tableExists(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return known


def read_warehouse(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    sql: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """JDBC read. A table takes Catalyst's pushed filters; `sql` is sent as written.

    `split` = (numeric column, low, high, partitions) reads a table in parallel.
    """
    if (table is None) == (sql is None):
        raise ValueError("name either a table or a query")
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if sql is not None:
        return reader.option("query", sql).load()
    if split is not None:
        column, low, high, parts = split
        reader = reader.options(
            partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts
        )
    return reader.option("dbtable", table).load()


def labelled_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """All files below a folder as binary rows; the label is the name of the parent folder."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
    )
    return files.select(
        F.col("path"),
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("label"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
        F.regexp_extract("path", r"\.([^./]+)$", 1).alias("extension"),
        F.col("length").alias("bytes"),
        "content",
    )


def read_narratives(spark: SparkSession, path: str) -> DataFrame:
    """Quoted narratives, one per paragraph. Paragraphs are the records, so files stay
    splittable and no task holds a whole file; unquoted paragraphs are headings."""
    raw = spark.read.option("lineSep", "\n\n").text(path)
    body = F.regexp_extract("value", r'(?s)^\s*"(.*)"\s*$', 1)
    return raw.select(body.alias("narrative")).filter("narrative <> ''")


def write_narratives(df: DataFrame, column: str, path: str) -> str:
    """The layout read_narratives expects: quotes and blank lines inside a text are dropped."""
    body = F.regexp_replace(F.regexp_replace(F.col(column), '"', ""), r"\n+", " ")
    df.select(F.concat(F.lit('"'), F.trim(body), F.lit('"')).alias("value")).write.option(
        "lineSep", "\n\n"
    ).text(path)
    return path
