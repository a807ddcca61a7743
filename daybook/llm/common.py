"""What the operators share: work tables, salts, and Arrow plumbing."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import daybook

from daybook.session import work_dir

#: Parts a hot key is split into where a join has to look up its one small row.
SALTS = 32

#: Rows whose texts a task holds as Python objects at once.
BATCH_ROWS = 1000

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(daybook.__file__))
        base = os.path.join(tempfile.mkdtemp(prefix="daybook-code-"), "daybook")
        spark.sparkContext.addPyFile(
            shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
        )
        _SHIPPED.add(app)


class Work:
    """Tables written once and read back, in a fresh folder that all executors share.

    A table read back starts a new lineage: an executor lost later costs a read
    of its files, not the work before them. It also has its own exchange in a
    join, which lets adaptive execution split a hot key there.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        ship(spark)
        self.spark = spark
        self.root = work_dir(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, rows: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
        """``rows_per_file`` bounds what a scan of large rows decodes at once."""
        rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(self.path(name))
        return self.spark.read.schema(rows.schema).parquet(self.path(name))


    def drop(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def with_first(rows: DataFrame, keys: list[str], small: DataFrame, by: Column, salts: int = SALTS) -> DataFrame:
    """``rows`` left-joined to ``small``, which has one row per key.

    A key may own a third of ``rows``: each row gets one of ``salts`` salts
    (from ``by``, so that a task run again gives it the same one) and the small
    side is repeated for each.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(spread, [*keys, "_salt"], "left").drop("_salt")


def with_class(rows: DataFrame, keys: list[str], classes: DataFrame, by: Column, large: int = 1000) -> DataFrame:
    """``rows`` with the columns of their class, found by ``keys``; ``classes`` has one row for each and its size ``n``.

    A class may own a third of the rows. Classes of ``large`` rows or more are so few that they can be
    repeated for salted rows; the rest of the rows meet theirs in a plain join. A row with
    a null in its first key, or without a class, has null columns.
    """
    some = rows.where(F.col(keys[0]).isNotNull())
    marked = with_first(some, keys, classes.where(F.col("n") >= large).withColumn("_is_large", F.lit(True)), by)
    rest = marked.where("_is_large is null").select(*rows.columns)
    found = marked.where("_is_large").drop("_is_large").unionByName(rest.join(classes.where(F.col("n") < large), keys, "left"))
    return found.unionByName(rows.where(F.col(keys[0]).isNull()), allowMissingColumns=True).drop("n")


def texts(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names, whatever else the table holds."""
    return rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def named(name: str) -> Column:
    """The column of this very name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(rows: DataFrame) -> Column:
    """All columns of ``rows`` as a struct ``row``, so that no other name can clash with theirs."""
    return F.struct(*(named(c) for c in rows.columns)).alias("row")


def text_key() -> Column:
    """A hash of the text, which tells apart the rows of an id that repeats with other texts."""
    return F.xxhash64("text").cast("string")


def batches(source: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in source:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
