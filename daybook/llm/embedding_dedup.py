"""Near-duplicate vectors: Euclidean p-stable hashing, then exact cosines.

Normalised vectors with a cosine of at least 0.98 lie at most 0.2 apart. A hash
is a random projection, shifted and cut into steps of 0.8; two such vectors share
one with probability 0.80 or more. A table's bucket is eight hashes together
(0.17), and of 40 tables at least one is shared with probability 0.999. Vectors
that point apart share a bucket about once in a hundred thousand.

Equal vectors are one class with a count. Buckets are compared in blocks by
matrix products; a pair is counted in the first table it shares only. A block
pair returns each vector's number of links and the links of a spanning forest,
so what leaves a task is in proportion to what came in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import Work, with_class
from daybook.llm.components import connected

TABLES, HASHES, STEP, SEED = 40, 8, 0.8, 10
#: Rows of a class that is looked up with salt.
LARGE = 1000
#: Vectors of one bucket are compared in blocks of about this many.
BLOCK = 512


def _projections(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    draw = np.random.default_rng([SEED, size])
    directions = draw.standard_normal((size, TABLES * HASHES))
    shifts = draw.uniform(0, STEP, TABLES * HASHES)
    return directions, shifts, draw.integers(1, 2**62, (TABLES, HASHES), np.int64) * 2 + 1


def _bucketed(classes: DataFrame) -> DataFrame:
    """``label, class, n``, the normalised ``unit`` as doubles, and one bucket number for each table."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = {}
        for batch in source:
            units, buckets = [], []
            rows = [np.array(x, float) for x in batch.column("embedding").to_pylist()]
            for row in rows:
                unit = row / np.abs(row).max()
                unit /= np.linalg.norm(unit)
                if len(row) not in known:
                    known[len(row)] = _projections(len(row))
                directions, shifts, mixers = known[len(row)]
                steps = np.floor((unit @ directions + shifts) / STEP).astype(np.int64)
                buckets.append((steps.reshape(TABLES, HASHES) * mixers).sum(axis=1))
                units.append(unit.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("label", "class", "n")),
                    pa.array(units, pa.binary()),
                    pa.array([x.tolist() for x in buckets], pa.list_(pa.int64())),
                ],
                names=["label", "class", "n", "unit", "buckets"],
            )

    schema = "label long, class long, n long, unit binary, buckets array<long>"
    return classes.select("label", "class", "n", "embedding").mapInArrow(run, schema)


class _Forest:
    def __init__(self, size: int) -> None:
        self.up = list(range(size))

    def joins(self, a: int, b: int) -> bool:
        while self.up[a] != a:
            a = self.up[a] = self.up[self.up[a]]
        while self.up[b] != b:
            b = self.up[b] = self.up[self.up[b]]
        self.up[max(a, b)] = min(a, b)
        return a != b


def _compare(rows: list[tuple], table: int, crossed: bool, threshold: float) -> Iterator[tuple]:
    """Links of one block pair: ``(class, links, None)`` and, of a forest, ``(a, 0, b)``."""
    sizes = {len(r[2]) for r in rows}
    for size in sizes:  # a label may hold vectors of several lengths
        same = [r for r in rows if len(r[2]) == size]
        ids = [r[0] for r in same]
        block = np.array([r[1] for r in same])
        units = np.frombuffer(b"".join(r[2] for r in same)).reshape(len(same), -1)
        buckets = np.array([r[3] for r in same], np.int64)
        weight = np.array([r[4] for r in same], np.int64)
        links = np.zeros(len(same), np.int64)
        forest = _Forest(len(same))
        for i in range(len(same) - 1):
            near = units[i + 1 :] @ units[i] >= threshold
            if crossed:
                near &= block[i + 1 :] != block[i]
            others = np.flatnonzero(near) + i + 1
            if not len(others):
                continue
            others = others[(buckets[others] == buckets[i]).argmax(axis=1) == table]
            links[i] += weight[others].sum()
            links[others] += weight[i]
            for j in others:
                if forest.joins(i, int(j)):
                    yield ids[i], 0, ids[j]
        for i in np.flatnonzero(links):
            yield ids[i], int(links[i]), None


def _block_links(rows: DataFrame, threshold: float) -> DataFrame:
    """Rows sorted by (label, table, bucket, i, j) in; a group may span batches."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("label", "table", "bucket", "i", "j", "class", "block", "unit", "buckets", "n")
        group, at = [], None
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            made = [pa.array([x[k] for x in out], pa.int64()) for k in range(3)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=["class", "links", "other"])

        def close() -> None:
            if len(group) > 1:
                out.extend(_compare(group, at[1], at[3] != at[4], threshold))

        for whole in source:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                for *head, number, block, unit, buckets, n in zip(
                    *(batch.column(name).to_pylist() for name in names), strict=True
                ):
                    if head != at:
                        close()
                        group, at = [], head
                    group.append((number, block, unit, buckets, n))
                yield flush()
        close()
        yield flush()

    return rows.mapInArrow(run, "class long, links long, other long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding, label``.

    Vectors are compared only when their labels are equal and not null, and their
    lengths are. A vector that is null, empty, zero, or holds a null or a number
    that isn't finite is linked with nothing: no links, its own component, kept. So
    is one without an id, whose component is null. Rows that repeat an id count as
    one vector each, linked by their own vectors alone; a component is named by the
    smallest id of its rows. Other columns are not read; an empty table gives no rows.
    """
    work = Work(vectors.sparkSession, "embedding-near-duplicates")
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & finite
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    # -0.0 and 0.0 are one number, and one hash.
    digest = F.sha2(F.array_join(F.transform("embedding", lambda x: (x + F.lit(0.0)).cast("string")), ","), 256)
    digests = work.keep(
        rows.select("vec_id", "label", F.when(usable, digest).alias("digest"), F.when(usable, F.col("embedding")).alias("embedding")),
        "digests",
    )
    # Numbered once, in a stored table: an id may stand for several vectors.
    classes = work.keep(
        digests.where("digest is not null")
        .groupBy("label", "digest")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.min_by("embedding", "vec_id").alias("embedding"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    bucketed = work.keep(_bucketed(classes), "bucketed")
    spread = bucketed.select("label", "class", F.posexplode("buckets").alias("table", "bucket"))
    shared = work.keep(
        spread.groupBy("label", "table", "bucket")
        .agg(F.count("*").alias("size"))
        .where("size > 1")
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")),
        "shared",
    )
    places = work.keep(spread.join(shared, ["label", "table", "bucket"]), "places")
    facts = bucketed.select("class", "unit", "buckets", "n")
    placed = (
        places.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .join(facts, "class")
        .withColumn("other_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "label",
            "table",
            "bucket",
            F.least("block", "other_block").alias("i"),
            F.greatest("block", "other_block").alias("j"),
            "class",
            "block",
            "unit",
            "buckets",
            "n",
        )
    )
    by = ["label", "table", "bucket", "i", "j"]
    found = work.keep(_block_links(placed.repartition(*by).sortWithinPartitions(*by, "class"), threshold), "found")
    links = found.where("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b"))
    components = connected(links, work, "links").select(F.col("node").alias("class"), F.col("component_id").alias("group"))
    linked = work.keep(components.join(classes.select("class", "rep"), "class"), "linked")
    named = linked.groupBy("group").agg(F.min("rep").alias("component"))
    linked = work.keep(linked.join(named, "group").select("class", "component"), "components")
    totals = work.keep(found.groupBy("class").agg(F.sum("links").alias("links")), "totals")
    of_class = work.keep(
        classes.select("label", "digest", "class", "rep", "n")
        .join(totals, "class", "left")
        .join(linked, "class", "left")
        .select(
            "label",
            "digest",
            "n",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        ),
        "class-results",
    )
    rows = digests.select("vec_id", "label", "digest")
    result = with_class(rows, ["digest", "label"], of_class, F.xxhash64("vec_id"), LARGE)
    component = F.coalesce("component", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id").isNull() | (F.col("vec_id") == component)).alias("kept"),
    )
