"""Files as lines, with their place in the file."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from daybook.functions import text

#: Splits whose places are broadcast to the lines; at 128 MB each these are 12 TB.
MAX_BROADCAST_SPLITS = 100_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of every file below ``path``.

    Lines end at LF only, so a CR stays visible. ``line_id`` grows by one from line
    to line of a split, which starts at ``block_start`` of its file; ``numbered``
    makes line numbers of it. It is stable only once the rows are stored, so use it
    on a stored copy.
    """
    return (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("file_bytes"),
            F.col("_metadata.file_block_start").alias("block_start"),
            (F.col("_metadata.file_block_start") == 0).alias("in_first_block"),
            F.monotonically_increasing_id().alias("line_id"),
            F.col("value").alias("line"),
        )
    )


def line_splits(stored: DataFrame, least: Mapping[str, Column] | None = None, **sums: Column) -> DataFrame:
    """One row for each split of each file of a stored copy of all its lines.

    ``first_id`` and ``n_lines`` of the split; ``before``, the lines of its file that
    come before it; ``in_file``, all lines of the file. Each of ``sums`` is summed over
    the split's lines as its name, with ``<name>_before`` and ``<name>_in_file``; each of ``least``
    is the least value of the split's lines. Only one row per split is shuffled: a file of a terabyte has some thousands.
    """
    totals = {"n_lines": F.lit(1), **sums}
    splits = stored.groupBy("file", "block_start").agg(
        F.min("line_id").alias("first_id"),
        *[F.min(value).alias(name) for name, value in (least or {}).items()],
        *[F.sum(value).alias(name) for name, value in totals.items()],
    )
    file = Window.partitionBy("file")
    before = file.orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    running = {}
    for name in totals:
        prefix = "" if name == "n_lines" else f"{name}_"
        running[f"{prefix}before"] = F.coalesce(F.sum(name).over(before), F.lit(0))
        running[f"{prefix}in_file"] = F.sum(name).over(file)
    return splits.withColumns(running)


def with_batch_places(splits: DataFrame) -> DataFrame:
    """Splits with ``before_file``, the lines of the files before theirs, in path order, and ``in_batch``."""
    files = splits.groupBy("file").agg(F.first("in_file").alias("n"))
    batch = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = files.select(
        "file",
        F.coalesce(F.sum("n").over(batch), F.lit(0)).alias("before_file"),
        F.sum("n").over(everything).alias("in_batch"),
    )
    return splits.join(placed, "file")


def with_splits(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows with what is known of their split. A split has at most one row here, of some
    hundred bytes; up to a bound they are broadcast, and the lines stay where they are."""
    if splits.limit(MAX_BROADCAST_SPLITS + 1).count() <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    return rows.join(splits, ["file", "block_start"])


def line_number() -> Column:
    """The number of a line in its file, from 1, beside what is known of its split."""
    return F.col("line_id") - F.col("first_id") + F.col("before") + 1


def numbered(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Any rows of a stored copy with ``line_no``, their place in the file from 1.

    Two passes: lines are counted per split, and the counts summed up along each
    file; a line's number follows from its place in its split.
    """
    return with_splits(rows, splits).select(*rows.columns, line_number().alias("line_no"))


def numbered_in_batch(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """The same with ``batch_line_no``, where the batch's files follow one another by path."""
    number = line_number()
    placed = with_splits(rows, with_batch_places(splits))
    return placed.select(*rows.columns, number.alias("line_no"), (number + F.col("before_file")).alias("batch_line_no"))


def tail_by_line(stored: DataFrame, n: int, whole_batch: bool = False) -> DataFrame:
    """The last ``n`` lines of each file, or of the whole batch, in file order, with ``line_no``.

    Nothing is sorted: how many lines there are says where the last ones begin, and
    splits that end before that are left out.
    """
    splits = line_splits(stored)
    if whole_batch:
        splits = with_batch_places(splits)
        end, before = F.col("in_batch"), F.col("before_file") + F.col("before")
    else:
        end, before = F.col("in_file"), F.col("before")
    late = splits.withColumn("from_id", F.col("first_id") + F.greatest(end - n - before, F.lit(0))).where(
        before + F.col("n_lines") > end - n
    )
    found = with_splits(stored, late).where("line_id >= from_id")
    place = F.col("line_id") - F.col("first_id") + before + 1
    return found.select(*stored.columns, place.alias("line_no"))


def head_by_line(stored: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines of each file, with ``line_no``."""
    early = line_splits(stored).where(F.col("before") < n)
    return numbered(stored, early).where(F.col("line_no") <= n)


def header_line() -> Column:
    """Aggregate over a file's lines: the ``line_id`` of its first line if that
    is a header, else null. Two numbers per file are all that is shuffled."""
    first = F.min(F.when(F.col("in_first_block"), F.col("line_id")))
    head = F.min(F.when(F.col("in_first_block") & F.col("header_like"), F.col("line_id")))
    return F.when(first == head, first)


def drop_headers(stored: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """``stored`` without its header lines.

    ``stored`` holds file, in_first_block, line_id and header_like; ``headers``
    has a file's header_line where it is known already. Only lines that look
    like a header meet the join, about one per file; all other rows pass straight
    through, and a later look-alike stays in the data.
    """
    if headers is None:
        headers = stored.filter("in_first_block").groupBy("file").agg(header_line().alias("header_line"))
    known = headers.filter("header_line IS NOT NULL").select("file", F.col("header_line").alias("line_id"))
    suspects = stored.filter("header_like").join(known, ["file", "line_id"], "left_anti")
    return stored.filter(~F.col("header_like")).unionByName(suspects)


def read_header_aware(spark: SparkSession, path: str, stage_path: str) -> DataFrame:
    """Lines of files that may or may not begin with a header, headers removed.

    The lines are stored once at ``stage_path``: a line's place in its file has
    to be the same in both branches of ``drop_headers``.
    """
    lines = read_lines(spark, path).withColumn("line", text.strip_nul("line"))
    lines.withColumn("header_like", text.looks_like_header(F.col("line"))).write.parquet(stage_path)
    return drop_headers(spark.read.parquet(stage_path)).select("file", "line")
