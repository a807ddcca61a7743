"""Near-duplicate documents: b-bit min-wise signatures in a multi-index Hamming join.

A signature holds 64 values of 16 bits; its distance to another is the number of
values that differ. Cut into 12 chunks, two signatures at most 23 apart have a
chunk with at most one difference (24 differences would be needed for two in
every chunk). So each signature is filed, for every chunk and every value in it,
under the chunk without that value: 64 keys, and any pair within the distance
shares one. At a similarity of 0.8 the distance is above 23 in about one pair of
a thousand. Links are confirmed on the full shingle sets.

Nothing is made for all pairs of a group. Equal sets are one class. In a first
round every class meets only the first class under each of its keys; connected
classes are then settled, and a second round compares, under a key, only
classes of different components, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import BATCH_ROWS, Work, batches, text_key, texts, with_class
from daybook.llm.components import connected
from daybook.llm.shingles import mixed, permutations, set_digest, shingle_sets, signature, similar

VALUES = 64
CHUNKS = [6] * 4 + [5] * 8
MAX_DISTANCE = 23
SEED = 7
#: Rows of a class that is looked up with salt.
LARGE = 1000
#: Classes under one key are compared in blocks of about this many.
BLOCK = 1024
#: A sketch holds the least hashes of a set; a set of up to this size is all there.
SKETCH = 256
#: Similarity a sketch must show: nearly the threshold if both are complete,
#: else four standard errors below it.
SKETCH_COMPLETE, SKETCH_PARTIAL = 0.02, 0.11

_PROFILE = "doc_id long, n_shingles long, digest binary, signature binary, text_key string"
_SETS = "doc_id long, signature binary, sketch binary, shingles binary"


def _chunk_starts() -> list[int]:
    return [sum(CHUNKS[:i]) for i in range(len(CHUNKS))]


def profiles(docs: DataFrame, width: int) -> DataFrame:
    """Set size, digest of the set and signature of each document (null where the set is empty), and the text's key."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = permutations(VALUES, SEED)
        for batch in batches(source, BATCH_ROWS):
            sizes, digests, signatures = [], [], []
            for shingles in shingle_sets(batch.column("text").to_pylist(), width):
                sizes.append(len(shingles))
                digests.append(set_digest(shingles) if len(shingles) else None)
                signatures.append(signature(shingles, functions).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    batch.column("text_key"),
                ],
                names=["doc_id", "n_shingles", "digest", "signature", "text_key"],
            )

    return docs.withColumn("text_key", text_key()).mapInArrow(run, _PROFILE)


def _keys(signature_column: Column) -> Column:
    """The 64 keys: each chunk without one of its values, hashed together with its number."""
    keys = []
    for start, size in zip(_chunk_starts(), CHUNKS, strict=True):
        for leave in range(size):
            before = F.substring(signature_column, 2 * start + 1, 2 * leave)
            after = F.substring(signature_column, 2 * (start + leave) + 3, 2 * (size - leave - 1))
            keys.append(F.xxhash64(F.lit(start + leave), F.concat(before, after)))
    return F.array(*keys)


def _sketch(shingles: np.ndarray) -> np.ndarray:
    low = np.unique((mixed(shingles) >> np.uint64(32)).astype(np.uint32))
    return low[:SKETCH]


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = permutations(VALUES, SEED)
        for batch in batches(source, BATCH_ROWS):
            found = list(shingle_sets(batch.column("text").to_pylist(), width))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([signature(x, functions).tobytes() for x in found], pa.binary()),
                    pa.array([_sketch(x).tobytes() for x in found], pa.binary()),
                    pa.array([x.tobytes() for x in found], pa.binary()),
                ],
                names=["doc_id", "signature", "sketch", "shingles"],
            )

    return docs.mapInArrow(run, _SETS)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough, whatever their signatures say."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keep = []
            for one, two in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True):
                one, two = (np.frombuffer(x.as_py(), np.uint64) for x in (one, two))
                keep.append(similar(one, two, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(end: str) -> DataFrame:
        return sets.select(
            F.col("doc_id").alias(end),
            F.col("shingles").alias(f"shingles_{end}"),
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.mapInArrow(run, "a long, b long")


def _first_shared(equal: np.ndarray) -> np.ndarray:
    """For rows of equal/unequal values, the number of the first key that both have, or -1."""
    out = np.full(equal.shape[0], -1, np.int64)
    for start, size in reversed(list(zip(_chunk_starts(), CHUNKS, strict=True))):
        part = ~equal[:, start : start + size]
        missing = part.sum(axis=1)
        out = np.where(missing == 0, start, np.where(missing == 1, start + part.argmax(axis=1), out))
    return out


def _sketches_agree(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    partial = len(left) == SKETCH or len(right) == SKETCH
    union = np.union1d(left, right)
    if partial:
        union = union[:SKETCH]
    both = np.isin(left, right, assume_unique=True)
    shared = np.count_nonzero(left[both] <= union[-1])
    return shared / len(union) >= percent / 100 - (SKETCH_PARTIAL if partial else SKETCH_COMPLETE)


def _across(rows: list[tuple], key_number: int, crossed: bool, percent: int, exact: bool) -> Iterator[tuple[int, int]]:
    """Pairs of one block pair that are near, of different components, and first met under this key."""
    ids = np.array([r[0] for r in rows], np.int64)
    component = np.array([r[1] for r in rows], np.int64)
    block = np.array([r[2] for r in rows], np.int64)
    values = np.frombuffer(b"".join(r[3] for r in rows), np.uint16).reshape(len(rows), VALUES)
    sketches = [np.frombuffer(r[4], np.uint32) for r in rows]
    for i in range(len(rows) - 1):
        wanted = component[i + 1 :] != component[i]
        if crossed:
            wanted &= block[i + 1 :] != block[i]
        others = np.flatnonzero(wanted) + i + 1
        if not len(others):
            continue
        equal = values[others] == values[i]
        near = VALUES - equal.sum(axis=1) <= MAX_DISTANCE
        others, equal = others[near], equal[near]
        for j in others[_first_shared(equal) == key_number]:
            if ids[i] != ids[j] and (exact or _sketches_agree(sketches[i], sketches[j], percent)):
                yield int(ids[i]), int(ids[j])


def _block_pairs(rows: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Rows sorted by (key, i, j) in, candidate pairs out; a group may span batches."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "i", "j", "k", "rep", "component", "block", "signature", "sketch")
        group, at = [], None
        out: list[tuple[int, int]] = []

        def close() -> None:
            if len(group) > 1:
                out.extend(_across(group, at[3], at[1] != at[2], percent, exact))

        for batch in source:
            for *head, rep, component, block, sig, sketch in zip(
                *(batch.column(n).to_pylist() for n in names), strict=True
            ):
                if head != at:
                    close()
                    group, at = [], head
                group.append((rep, component, block, sig, sketch))
            yield _pairs(out)
            out.clear()
        close()
        yield _pairs(out)

    return rows.mapInArrow(run, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"]
    )


def _unmet(
    members: DataFrame, settled: DataFrame, sets: DataFrame, percent: int, work: Work, exact: bool
) -> DataFrame:
    """Candidate pairs under a common key that the first round neither compared nor connected."""
    rest = work.keep(
        members.where("rep <> leader")
        .join(settled, members["rep"] == settled["node"], "left")
        .select("key", "k", "rep", F.coalesce("component_id", "rep").alias("component")),
        "rest",
    )
    open_keys = work.keep(
        rest.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
        .where("lo <> hi")
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")),
        "open-keys",
    )
    placed = work.keep(
        rest.join(open_keys, "key").select(
            "key",
            "k",
            "rep",
            "component",
            "blocks",
            F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"),
        ),
        "placed",
    )
    facts = sets.select(F.col("doc_id").alias("rep"), "signature", "sketch")
    spread = (
        placed.join(facts, "rep")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "k",
            "rep",
            "component",
            "block",
            "signature",
            "sketch",
        )
    )
    dealt = spread.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")
    return _block_pairs(dealt, percent, exact)


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    keyed: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Returns ``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked if 100 * intersection >= percent * union of their sets
    of word shingles; ``component_id`` is the smallest id reachable and ``kept``
    marks that document. A text without words, or null, has an empty set and is
    linked with nothing. Rows that repeat an id are one document; a row without
    an id is linked with nothing, has no component and is kept. Other columns are
    not read. An empty table gives no rows. With ``keyed``, ``text_key`` tells which
    of an id's texts a row is about. With ``exact``, every pair within the signature
    distance is judged by its full sets; else pairs of large sets whose sketches lie
    four standard errors below the threshold are left out first.
    """
    spark = docs.sparkSession
    work = Work(spark, "near-duplicates")
    docs = texts(docs, id_col, text_col)
    profile = work.keep(profiles(docs, width), "profile")
    classes = work.keep(
        profile.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("rep"), F.min_by("signature", "doc_id").alias("signature"), F.count("*").alias("n")
        ),
        "classes",
    )
    keys = classes.select("rep", F.posexplode(_keys(F.col("signature"))).alias("k", "key"))
    repeated = work.keep(
        keys.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader <> last"),
        "repeated",
    )
    members = work.keep(keys.join(repeated.select("key", "leader"), "key").select("key", "k", "rep", "leader"), "members")
    candidates = work.keep(members.select("rep").distinct(), "candidates")
    texts_of = docs.join(candidates, docs["doc_id"] == candidates["rep"], "left_semi")
    sets = work.keep(_sets(texts_of, width).where("length(shingles) > 0"), "sets")

    star = members.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    links = work.keep(_confirmed(work.keep(star, "star"), sets, percent).distinct(), "star-links")
    settled = work.keep(connected(links, work, "star"), "settled")
    more = work.keep(_unmet(members, settled, sets, percent, work, exact), "unmet")
    late = work.keep(_confirmed(more, sets, percent).distinct(), "late-links")
    components = work.keep(connected(links.union(late), work, "all"), "components")

    placed = classes.join(components, classes["rep"] == components["node"], "left")
    of_class = work.keep(
        placed.select("digest", F.coalesce("component_id", "rep").alias("class_component"), "n"), "class-components"
    )
    found = with_class(profile.drop("signature"), ["digest"], of_class, F.xxhash64("doc_id", "text_key"), LARGE)
    return found.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("class_component", "doc_id"))).alias("kept"),
        *(["text_key"] if keyed else []),
    )
