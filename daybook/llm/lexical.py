"""Ranked lexical search over posting lists in blocks of similar documents.

Documents are cut into shards of a bounded number. In a shard, the documents that
hold a term are clustered around some of themselves by the angle between their
term vectors, and each cluster is a block. A block keeps the greatest impact of
each term among its documents; weighted by an item's terms these bound the score
of any document in it, in the same whole numbers as the scores. A block is left
out only if its bound is below the score that the item's last place has already.

Items are searched in blocks of a bounded number, each against all documents; the
index covers the terms of such a block. A sixteenth of the shards is searched
first and tells the rest how good the last place is at least.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F

from daybook.llm.common import Work
from daybook.llm.shingles import Words, blocks

#: Documents of a shard, of a block on average, and of the longest list that needs no blocks.
SHARD_DOCS, BLOCK_DOCS, SHORT_LIST = 1024, 128, 192
#: Shards of one file; a scan decodes them together.
FILE_SHARDS = 4
#: Items searched at once; one in so many shards is searched first.
ITEMS, FIRST_SHARDS = 256, 16
PROJECTED = 64

#: Fixed value: ASCII letters, digits and all of the characters beyond ASCII make terms.
_GAP = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def _terms(run: list[bytes]) -> Words:
    return Words(run, lower=True, gap=_GAP)


# --- Items --------------------------------------------------------------------


@dataclass(frozen=True)
class Items:
    """A block of items: the sorted hashes of their terms, and each one's terms by number, with repeats."""

    terms: np.ndarray
    numbers: list[np.ndarray]
    repeats: list[np.ndarray]

    @staticmethod
    def of(texts: list[str | None]) -> Items:
        each = [_terms([(x or "").encode("utf-8", "surrogatepass")]).hashes for x in texts]
        terms = np.unique(np.concatenate([np.empty(0, np.uint64), *each]))
        counted = [np.unique(x, return_counts=True) for x in each]
        return Items(terms, [np.searchsorted(terms, x) for x, _ in counted], [n for _, n in counted])


# --- Term counts of documents, by shard -----------------------------------------

_SHARD = "doc_ids array<long>, n array<long>, sizes array<int>, terms array<int>, tf array<int>"


def counted(docs: DataFrame, terms: np.ndarray, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Shards of documents with one of ``terms`` or more; ``n_docs`` and ``n_terms`` count all documents.

    ``n`` counts a document's terms, ``sizes`` its different ones of ``terms``;
    their numbers and occurrences follow one document after another.
    """

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in source:
            for start in range(0, whole.num_rows, shard_docs):
                batch = whole.slice(start, shard_docs)
                yield shard(batch)

    def shard(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, sizes, found, tf = [], [], [], []
        for part in blocks(batch.column("text").to_pylist()):
            words = _terms(part)
            n = np.diff(words.first)
            place = np.searchsorted(terms, words.hashes)
            hit = np.zeros(len(place), bool)
            inside = place < len(terms)
            hit[inside] = terms[place[inside]] == words.hashes[inside]
            of_text = np.repeat(np.arange(len(part)), n)
            pairs, count = np.unique(of_text[hit] * max(len(terms), 1) + place[hit], return_counts=True)
            lengths.append(n)
            sizes.append(np.bincount(pairs // max(len(terms), 1), minlength=len(part)))
            found.append(pairs % max(len(terms), 1))
            tf.append(count)
        n, size = (np.concatenate([np.empty(0, np.int64), *x]) for x in (lengths, sizes))
        holds = size > 0
        columns = {
            "n_docs": pa.array([int((n > 0).sum())], pa.int64()),
            "n_terms": pa.array([int(n.sum())], pa.int64()),
            "doc_ids": _one(batch.column("doc_id").filter(pa.array(holds)), pa.int64()),
            "n": _one(n[holds], pa.int64()),
            "sizes": _one(size[holds], pa.int32()),
            "terms": _one(np.concatenate([np.empty(0, np.int64), *found]), pa.int32()),
            "tf": _one(np.concatenate([np.empty(0, np.int64), *tf]), pa.int32()),
        }
        return pa.RecordBatch.from_pydict(columns)

    schema = f"n_docs long, n_terms long, {_SHARD}"
    return docs.mapInArrow(run, schema).withColumn("shard", F.monotonically_increasing_id())


def _one(values: np.ndarray | pa.Array, kind: pa.DataType) -> pa.ListArray:
    """A list column of one row."""
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


# --- The index ------------------------------------------------------------------


@dataclass(frozen=True)
class Weights:
    """What all documents together give: their number, their terms, and a weight for each term."""

    n_docs: int
    n_terms: int
    of_term: np.ndarray

    def impacts(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Of a term that occurs ``tf`` times among ``n``, by its weight. At most a million."""
        m = 75 + (25 * n * self.n_docs) // max(self.n_terms, 1)
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weights(shards: DataFrame, terms: int) -> Weights:
    n_docs, n_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = np.zeros(terms, np.int64)
    for term, n in shards.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n
    n_docs = n_docs or 0
    of_term = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()]
    return Weights(n_docs, n_terms or 0, np.array(of_term, np.int64))


def _clusters(docs: np.ndarray, places: np.ndarray, block_docs: int) -> list[np.ndarray]:
    """``docs`` by the seed that each points to most; seeds are spread evenly over the list."""
    seeds = docs[:: max(1, block_docs)]
    near = (places[docs] @ places[seeds].T).argmax(axis=1)
    return [docs[near == k] for k in range(len(seeds)) if (near == k).any()]


_INDEX = (
    "shard long, doc_ids array<long>, sizes array<int>, terms array<int>, impacts array<int>, "
    "block_terms array<int>, block_sizes array<int>, block_docs array<int>, "
    "summary_sizes array<int>, summary_terms array<int>, summary_impacts array<int>"
)


def directions(terms: int) -> np.ndarray:
    """A random projection of term vectors that about keeps their angles."""
    return np.random.default_rng(12).standard_normal((max(terms, 1), PROJECTED)).astype(np.float32)


def index_row(
    batch: pa.RecordBatch, row: int, by: Weights, draw: np.ndarray, block_docs: int, short_list: int
) -> pa.RecordBatch:
    """The index of one shard, as one row."""
    get = {x: _values(batch, x, row) for x in ("doc_ids", "n", "sizes", "terms", "tf")}
    n, sizes, terms, tf = (get[x].to_numpy(zero_copy_only=False) for x in ("n", "sizes", "terms", "tf"))
    doc = np.repeat(np.arange(len(sizes)), sizes)
    impact = by.impacts(n[doc], tf.astype(np.int64))
    own, local = np.unique(terms, return_inverse=True)
    matrix = np.zeros((len(sizes), len(own)), np.int32)
    matrix[doc, local] = impact
    places = matrix.astype(np.float32) * np.maximum(by.of_term[own], 0).astype(np.float32) @ draw[own]
    places /= np.maximum(np.linalg.norm(places, axis=1, keepdims=True), 1e-9)
    order = np.argsort(local, kind="stable")
    lists = np.split(doc[order], np.cumsum(np.bincount(local, minlength=len(own)))[:-1]) if len(own) else []
    block_terms, block_docs_, summary_terms, summary_impacts = [], [], [], []
    for term, docs in zip(own.tolist(), lists, strict=True):
        for block in [docs] if len(docs) <= short_list else _clusters(docs, places, block_docs):
            block_terms.append(term)
            block_docs_.append(block)
            most = matrix[block].max(axis=0) if len(docs) > short_list else np.empty(0, np.int32)
            holds = np.flatnonzero(most)
            summary_terms.append(own[holds])
            summary_impacts.append(most[holds])
    columns = {
        "shard": pa.array([batch.column("shard")[row].as_py()], pa.int64()),
        "doc_ids": _one(get["doc_ids"], pa.int64()),
        "sizes": _one(sizes, pa.int32()),
        "terms": _one(terms, pa.int32()),
        "impacts": _one(impact, pa.int32()),
        "block_terms": _one(np.array(block_terms, np.int32), pa.int32()),
        "block_sizes": _one(np.array([len(x) for x in block_docs_], np.int32), pa.int32()),
        "block_docs": _one(_joined(block_docs_), pa.int32()),
        "summary_sizes": _one(np.array([len(x) for x in summary_terms], np.int32), pa.int32()),
        "summary_terms": _one(_joined(summary_terms), pa.int32()),
        "summary_impacts": _one(_joined(summary_impacts), pa.int32()),
    }
    return pa.RecordBatch.from_pydict(columns)


def indexed(
    shards: DataFrame, by: Weights, block_docs: int = BLOCK_DOCS, short_list: int = SHORT_LIST
) -> DataFrame:
    """The posting list of each term in each shard, in blocks; short lists are one block without a summary."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = directions(len(by.of_term))
        for batch in source:
            for row in range(batch.num_rows):
                yield index_row(batch, row, by, draw, block_docs, short_list)

    return shards.select("shard", "doc_ids", "n", "sizes", "terms", "tf").mapInArrow(run, _INDEX)


def _values(batch: pa.RecordBatch, name: str, row: int) -> pa.Array:
    return batch.column(name)[row].values


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int32), *parts])


# --- Search -----------------------------------------------------------------------


class _Shard:
    """One shard of the index, ready to be searched."""

    def __init__(self, batch: pa.RecordBatch, row: int) -> None:
        def numbers(name: str) -> np.ndarray:
            return _values(batch, name, row).to_numpy(zero_copy_only=False)

        self.doc_ids = _values(batch, "doc_ids", row).to_pylist()
        # Equal scores: by id, those without one last.
        self.tie = np.array([(x is None, x or 0) for x in self.doc_ids], "b,i8")
        sizes, terms = numbers("sizes"), numbers("terms")
        own, local = np.unique(terms, return_inverse=True)
        self.column = {term: at for at, term in enumerate(own.tolist())}
        self.matrix = np.zeros((len(sizes), len(own)), np.int64)
        self.matrix[np.repeat(np.arange(len(sizes)), sizes), local] = numbers("impacts")
        self.docs = np.split(numbers("block_docs"), np.cumsum(numbers("block_sizes"))[:-1])
        held = numbers("summary_sizes")
        #: Blocks of each term: those without a summary, and the rows of ``most`` of the others.
        self.whole: dict[int, list[int]] = {}
        self.parts: dict[int, list[int]] = {}
        self.block_of = np.flatnonzero(held)
        row_of = np.cumsum(held > 0) - 1
        for block, term in enumerate(numbers("block_terms").tolist()):
            if held[block]:
                self.parts.setdefault(term, []).append(int(row_of[block]))
            else:
                self.whole.setdefault(term, []).append(block)
        self.most = np.zeros((len(self.block_of), len(own)), np.int64)
        at = np.searchsorted(own, numbers("summary_terms"))
        self.most[np.repeat(row_of[self.block_of], held[self.block_of]), at] = numbers("summary_impacts")

    def best(self, terms: list[int], weight: np.ndarray, top: int, least: int) -> tuple[list[tuple[int, int]], int]:
        """``(document, score)`` of the best ``top`` that score ``least`` or more; and the blocks left out."""
        here = [(self.column[t], w) for t, w in zip(terms, weight.tolist(), strict=True) if t in self.column and w]
        if not here:
            return [], 0
        columns, by = np.array([c for c, _ in here]), np.array([w for _, w in here], np.int64)
        scores = np.full(len(self.doc_ids), -1, np.int64)

        def score(docs: np.ndarray) -> None:
            new = docs[scores[docs] < 0]
            scores[new] = self.matrix[new[:, None], columns] @ by

        def last_place() -> int:
            seen = scores[scores > 0]
            return max(least, int(np.partition(seen, -top)[-top])) if len(seen) >= top else least

        if whole := [self.docs[b] for t in terms for b in self.whole.get(t, ())]:
            score(np.unique(np.concatenate(whole)))
        rows = np.array([r for t in terms for r in self.parts.get(t, ())], np.int64)
        bounds = self.most[rows[:, None], columns] @ by
        left_out, bar = 0, last_place()
        for at in np.argsort(-bounds, kind="stable").tolist():
            if bounds[at] < bar:
                left_out = int((bounds < bar).sum())
                break
            score(self.docs[self.block_of[rows[at]]])
            bar = last_place()
        found = np.flatnonzero((scores > 0) & (scores >= bar))
        order = np.lexsort((self.tie["f1"][found], self.tie["f0"][found], -scores[found]))[:top]
        return [(int(found[x]), int(scores[found[x]])) for x in order], left_out


def _searched(index: DataFrame, items: Items, by: Weights, top: int, least: dict[int, int]) -> DataFrame:
    """``item, doc_id, score``: the best of each shard, by the item's place in its block."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in range(batch.num_rows):
                shard = _Shard(batch, row)
                out = []
                for item, (terms, repeats) in enumerate(zip(items.numbers, items.repeats, strict=True)):
                    found, _ = shard.best(terms.tolist(), by.of_term[terms] * repeats, top, least.get(item, 1))
                    out += [(item, shard.doc_ids[doc], score) for doc, score in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["item", "doc_id", "score"]
                )

    return index.mapInArrow(run, "item long, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, rows: list[Row], work: Work, name: str, top: int) -> DataFrame:
    items = Items.of([row["text"] for row in rows])
    shards = work.keep(counted(docs, items.terms), f"counts{name}", FILE_SHARDS)
    by = weights(shards, len(items.terms))
    index = work.keep(indexed(shards.where(F.size("terms") > 0), by), f"index{name}", FILE_SHARDS)
    ahead = F.pmod(F.xxhash64("shard"), F.lit(FIRST_SHARDS)) == 0
    first = work.keep(_ranked(_searched(index.where(ahead), items, by, top, {}), top).drop("rank"), f"first{name}")
    lasts = first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= top)
    least = {row["item"]: row["least"] for row in lasts.collect()}
    return first.unionByName(_searched(index.where(~ahead), items, by, top, least))


def ranked(docs: DataFrame, items: DataFrame, top: int = 20, block_items: int = ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of ``docs`` for each row of ``items``.

    A null or empty text, of a document or an item, has no terms and is never
    found or finds nothing. Rows that repeat an id are each a document, or an item,
    of their own; a document without an id comes last among equal scores. Items
    without a document that scores above 0, and empty tables, give no rows. Terms
    are compared by 64-bit hashes. Other columns aren't read.
    """
    spark = docs.sparkSession
    work = Work(spark, "lexical-search")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = items.select("item_id", F.col("text").cast("string").alias("text"))
    schema = wanted.select("item_id").schema.add("item", "long")
    source, found, number = wanted.toLocalIterator(), None, 0
    while rows := list(islice(source, block_items)):
        got = _search_block(slim, rows, work, str(number), top)
        ids = spark.createDataFrame([(row["item_id"], at) for at, row in enumerate(rows)], schema)
        block = work.keep(_ranked(got, top).join(ids, "item").select("item_id", "rank", "doc_id", "score"), f"ranked{number}")
        found = block if found is None else found.unionByName(block)
        number += 1
    if found is None:
        empty = wanted.select("item_id").schema.add("rank", "integer").add("doc_id", "long").add("score", "long")
        return spark.createDataFrame([], empty)
    return found
