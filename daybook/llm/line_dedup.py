"""Line dedup over overlapping three-line windows.

Every run of three consecutive lines that aren't blank is a window. Of windows that
occur more than once, in one document or in many, the first occurrence by document
id and place covers nothing; the lines that later ones cover, taken together, go. A
later window may overlap the first: of ``a a a a b`` the windows at the first and
second line are equal, so the second to fourth line go and ``a b`` stays.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from daybook.llm.common import Work, ship, whole_row, with_first

WINDOW = 3
_BLANK = " \t\n\v\f\r"


def _line_hashes(seed: int) -> Column:
    """Hashes of the lines that aren't blank, without the spaces around them; a tab or CR counts."""
    return F.transform(
        F.filter(F.split("text", "\n", -1), lambda line: F.regexp_like(line, F.lit(r"\S"))),
        lambda line: F.xxhash64(F.lit(seed), F.trim(line)),
    )


def windows(docs: DataFrame) -> DataFrame:
    """``doc_id, place, w1, w2``: a 128-bit hash of each window, by the number of its first line."""
    hashed = docs.select("doc_id", _line_hashes(1).alias("h1"), _line_hashes(2).alias("h2")).where(
        F.size("h1") >= WINDOW
    )
    places = F.sequence(F.lit(0), F.size("h1") - WINDOW)

    def rolled(lines: str, place: Column) -> Column:
        return F.xxhash64(*(F.element_at(lines, place + k + 1) for k in range(WINDOW)))

    made = F.transform(
        places, lambda p: F.struct(p.alias("place"), rolled("h1", p).alias("w1"), rolled("h2", p).alias("w2"))
    )
    return hashed.select("doc_id", F.inline(made))


def covered_lines(docs: DataFrame, work: Work) -> DataFrame:
    """``doc_id, covered``: the numbers of the lines (blank ones not counted) that later windows cover."""
    found = work.keep(windows(docs.where("doc_id is not null and text is not null")), "windows")
    first = work.keep(
        found.groupBy("w1", "w2")
        .agg(F.min(F.struct("doc_id", "place")).alias("first"), F.max(F.struct("doc_id", "place")).alias("last"))
        .where("first <> last")
        .select("w1", "w2", "first"),
        "repeated",
    )
    later = with_first(found, ["w1", "w2"], first, F.struct("doc_id", "place")).where(
        "first < struct(doc_id, place)"
    )
    return (
        later.select("doc_id", F.explode(F.sequence("place", F.col("place") + WINDOW - 1)).alias("line"))
        .groupBy("doc_id")
        .agg(F.collect_set("line").alias("covered"))
    )


@F.arrow_udf(T.StringType())
def _without_lines(text: pa.Array, covered: pa.Array) -> pa.Array:
    """``text`` without the lines of these numbers; a line that is blank has none."""

    def one(lines: list[str], gone: set[int]) -> str:
        number, kept = 0, []
        for line in lines:
            blank = not line.strip(_BLANK)
            if blank or number not in gone:
                kept.append(line)
            number += not blank
        return "\n".join(kept)

    rows = zip(text, covered, strict=True)
    return pa.array([one(x.as_py().split("\n"), set(y.as_py())) if x.is_valid else None for x, y in rows], pa.string())


def rebuilt(docs: DataFrame) -> DataFrame:
    """``row``, a struct of all columns of ``docs``, its new ``text``, and ``n_removed``.

    Only texts that lose lines leave the JVM, each for one pass over its lines.
    """
    ship(docs.sparkSession)
    work = Work(docs.sparkSession, "line-dedup")
    covered = covered_lines(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work)
    packed = docs.select(whole_row(docs))
    joined = packed.join(
        covered.select(F.col("doc_id").alias("id"), "covered"), F.col("row.doc_id").cast("long") == F.col("id"), "left"
    )
    text = F.col("row.text").cast("string")
    hit = F.col("covered").isNotNull()
    without = _without_lines(F.when(hit, text), "covered")
    n_removed = F.coalesce(F.size("covered"), F.lit(0)).cast("long")
    return joined.select("row", F.when(hit, without).otherwise(text).alias("text"), n_removed.alias("n_removed"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the covered lines taken out of ``text``, and ``n_removed``, the lines taken.

    Other lines, blank ones among them, stay as they are, in order. Texts with
    fewer than three lines that aren't blank have no windows and stay. A null text
    stays null; a row without an id stays whole and is nobody's first occurrence.
    Rows that repeat an id and its text are one document. All columns of ``docs``
    are kept, whatever their names; one named ``n_removed`` is replaced.
    """
    rows = rebuilt(docs)
    own = {c: F.col("row").getField(c) for c in docs.columns if c != "n_removed"} | {"text": F.col("text")}
    return rows.select(*(x.alias(c) for c, x in own.items()), "n_removed")
