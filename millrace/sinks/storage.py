"""Paths, existence and replacing a table's directory, through Hadoop's file system API."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")


def table_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {', '.join(LAYERS)}")
    return f"{root}/{layer}/{table}"


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists. Access and network errors are raised, not taken for "no"."""
    files, where = _path(spark, path)
    return files.exists(where)


def path_bytes(spark: SparkSession, path: str) -> int:
    files, where = _path(spark, path)
    return files.getContentSummary(where).getLength()


def fresh_name(label: str) -> str:
    """A name no other run uses, fit for directories and for registered tables."""
    return f"millrace_{label}_{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory in the cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session that names none gets a directory of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.gettempdir()
    return f"{shared}/{fresh_name(label)}"


def partition_texts(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """The values in a table's directory names, by column; from listings alone."""
    files, where = _path(spark, path)
    found: dict[str, set[str]] = {}
    level = [where]
    while level:
        inner = [s.getPath() for d in level for s in files.listStatus(d) if s.isDirectory() and "=" in s.getPath().getName()]
        for directory in inner:
            name, _, text = directory.getName().partition("=")
            if text != "__HIVE_DEFAULT_PARTITION__":
                found.setdefault(unquote(name), set()).add(unquote(text))
        level = inner
    return found


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh directory of the shared folder and read back: its plan runs once and ends there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    files, where = _path(spark, path)
    files.delete(where, True)


def recover_table(spark: SparkSession, path: str) -> None:
    """Undo a replacement that was cut off between its two renames."""
    files, live = _path(spark, path)
    _, old = _path(spark, f"{path}__old")
    if not files.exists(live) and files.exists(old):
        files.rename(old, live)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns a table's directories are named after, outermost first."""
    files, where = _path(spark, path)
    names = []
    while True:
        inner = [s.getPath() for s in files.listStatus(where) if s.isDirectory() and "=" in s.getPath().getName()]
        if not inner:
            return names
        names.append(inner[0].getName().split("=")[0])
        where = inner[0]


def read_typed(spark: SparkSession, path: str, fmt: str, types: Mapping[str, T.DataType]) -> DataFrame:
    """The stored table with some (partition) columns in given types.

    Spark guesses partition types from directory names, which would turn a text "01" into 1.
    """
    stored = spark.read.format(fmt).load(path).schema
    typed = [T.StructField(f.name, types.get(f.name, f.dataType)) for f in stored.fields]
    return spark.read.format(fmt).schema(T.StructType(typed)).load(path)


def read_stored(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A stored table whose partition values read back as they were written.

    Spark guesses partition types from directory names. A guess is kept only if it gives back every
    directory's text; a column with a value like "01", which would become 1, is read as text.
    """
    guessed = spark.read.format(fmt).options(**options).load(path)
    if fmt != "parquet":
        return guessed
    texts = {c: v for c, v in partition_texts(spark, path).items() if c in guessed.columns}
    kinds = {c: guessed.schema[c].dataType for c in texts if not isinstance(guessed.schema[c].dataType, T.StringType)}
    changed = [c for c, kind in kinds.items() if not _gives_back(spark, texts[c], kind)]
    if not changed:
        return guessed
    as_text = [T.StructField(f.name, T.StringType() if f.name in changed else f.dataType) for f in guessed.schema]
    return spark.read.format(fmt).options(**options).schema(T.StructType(as_text)).load(path)


def _gives_back(spark: SparkSession, texts: set[str], kind: T.DataType) -> bool:
    """Whether every text is what its value of that type is written as; reads no table."""
    listed = spark.createDataFrame([(t,) for t in sorted(texts)], "text string")
    return listed.where(~F.coalesce(F.col("text").try_cast(kind).cast("string") == F.col("text"), F.lit(False))).isEmpty()


def replace_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_cols: list[str] | None = None
) -> None:
    """Write ``df`` next to ``path``, then put it in its place; ``df`` may read from ``path``.

    Two renames, so not atomic for readers: one writer at a time, and on an object store
    a rename is a copy. The live directory is untouched until the new one is complete.
    """
    spark = df.sparkSession
    recover_table(spark, path)
    writer = df.write.format(fmt).mode("overwrite")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.save(f"{path}__new")
    swap_in(spark, path)


def swap_in(spark: SparkSession, path: str) -> None:
    """Put the complete directory ``path__new`` in the place of ``path``."""
    files, live = _path(spark, path)
    _, new = _path(spark, f"{path}__new")
    _, old = _path(spark, f"{path}__old")
    files.delete(old, True)
    for source, target in ((live, old), (new, live)):
        if files.exists(source) and not files.rename(source, target):
            raise OSError(f"could not rename {source} to {target}")
    files.delete(old, True)
    spark.catalog.refreshByPath(path)


def replace_registered(spark: SparkSession, writer: DataFrameWriter, path: str, name: str) -> None:
    """Write a table next to ``path``, put it in its place and register it as ``name``, layout included.

    What is written may read the table it replaces; a write that fails leaves everything as it was.
    """
    written = fresh_name("staged")
    recover_table(spark, path)
    writer.option("path", f"{path}__new").saveAsTable(written)
    swap_in(spark, path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} LIKE {written} LOCATION '{location}'")
    spark.sql(f"DROP TABLE {written}")
