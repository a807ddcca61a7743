"""Phrase collocations from an FM-index per shard, with exact counts over all shards.

A shard is some millions of words. Its index is the Burrows-Wheeler transform
over word numbers, sorted by the next five words, which is as deep as phrases
go. All intervals of one depth grow at once: to the left by the LF mapping, and
an interval's place inside those of its depth tells which shorter phrase it
extends to the right. A phrase is followed only while the phrases it consists of
are frequent everywhere, since it can't be more frequent than they are.

Counts are summed over the shards three times, for words, pairs and longer
phrases: a shard sends its phrases packed by bucket of their hash, and each
bucket's sums are made in one task. What a bucket tells a shard in return is one
bit for each phrase, in the shard's own order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from daybook.llm.common import Work, batches
from daybook.llm.shingles import Words, blocks, mixed

#: Words in the longest phrase; words of a shard; phrases of a bucket on average.
DEPTH, SHARD_WORDS, BUCKET_PHRASES = 5, 1_000_000, 500_000
#: Texts turned into words at once; shards of one file, which a scan decodes together.
BATCH_ROWS, FILE_SHARDS = 1000, 2

#: Bytes between pieces and, inside a piece, between words.
_PIECE_ENDS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_ENDS, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_ENDS[list(_PIECE_ENDS)] = True
_GAP[list(_PIECE_ENDS + _BLANKS)] = True
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _named(names: str, *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=names.split())


# --- Shards -------------------------------------------------------------------


class _Shard:
    """Words gathered until there are enough: keys by language, their pieces and places in the bytes."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.pieces: list[np.ndarray] = []
        self.langs: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.data: list[bytes] = []
        self.size = self.bytes = self.n_pieces = 0

    def add(self, run: list[bytes], lang: list[int], seeds: np.ndarray) -> None:
        words = Words(run, lower=True, gap=_GAP)
        ends = np.cumsum(_ENDS[words.bytes])
        of_text = np.repeat(np.array(lang), np.diff(words.first))
        self.keys.append(mixed(words.hashes * _SPREAD + seeds[of_text]))
        self.langs.append(of_text.astype(np.int32))
        self.pieces.append(ends[words.starts] + self.n_pieces)
        self.n_pieces += int(ends[-1]) + 1
        self.places.append(np.column_stack([words.starts, words.ends]) + self.bytes)
        self.data.append(words.bytes.tobytes())
        self.bytes += len(words.bytes)
        self.size += len(words.starts)

    def row(self, names: list[str]) -> pa.RecordBatch:
        """``ids`` (1 up; 0 ends a piece) number the distinct ``keys``, which ascend."""
        keys, at, of_word, count = np.unique(
            np.concatenate(self.keys), return_index=True, return_inverse=True, return_counts=True
        )
        piece = np.concatenate(self.pieces)
        starts = np.flatnonzero(np.diff(piece, prepend=-1))
        ids = np.insert(of_word.astype(np.int32) + 1, starts, 0)
        lang, places, data = np.concatenate(self.langs), np.concatenate(self.places), b"".join(self.data)
        n = np.bincount(lang, minlength=len(names))
        return _named(
            "ids keys counts words of_lang langs lang_words",
            pa.array([np.append(ids, np.int32(0)).tobytes()], pa.binary()),
            pa.array([keys.tobytes()], pa.binary()),
            pa.array([count.astype(np.int64).tobytes()], pa.binary()),
            pa.array([b"\n".join(data[a:b] for a, b in places[at].tolist()).lower()], pa.binary()),
            pa.array([lang[at].tobytes()], pa.binary()),
            pa.array([names], pa.list_(pa.string())),
            pa.array([n.tolist()], pa.list_(pa.int64())),
        )


def _shards(docs: DataFrame, shard_words: int) -> DataFrame:
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        seeds: list[int] = []
        shard = _Shard()
        for batch in batches(source, BATCH_ROWS):
            lang = []
            for name in batch.column("lang").to_pylist():
                if name not in names:
                    names.append(name)
                    seed = hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                    seeds.append(int.from_bytes(seed, "little"))
                lang.append(names.index(name))
            done = 0
            for part in blocks(batch.column("text").to_pylist()):
                shard.add(part, lang[done : done + len(part)], np.array(seeds, np.uint64))
                done += len(part)
                if shard.size >= shard_words:
                    yield shard.row(names)
                    shard = _Shard()
        if shard.size:
            yield shard.row(names)

    schema = (
        "ids binary, keys binary, counts binary, words binary, of_lang binary, "
        "langs array<string>, lang_words array<long>"
    )
    return docs.mapInArrow(run, schema).withColumn("shard", F.monotonically_increasing_id())


# --- Sums over shards ---------------------------------------------------------


def _bucket_bits(phrases: int) -> int:
    return max(0, (max(phrases, 1) // BUCKET_PHRASES).bit_length())


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    """Of packed phrases, one row each, by a hash."""
    if not bits:
        return np.zeros(len(keys), np.int64)
    hashed = np.full(len(keys), 1, np.uint64)
    for column in keys.T:
        hashed = mixed(hashed * _SPREAD + column.astype(np.uint64))
    return (hashed >> np.uint64(64 - bits)).astype(np.int64)


def _cut(at: np.ndarray) -> list[tuple[int, int, int]]:
    """``value, begin, end`` of each run of the sorted ``at``."""
    begins = np.flatnonzero(np.diff(at, prepend=-1)).tolist()
    return [(int(at[x]), x, y) for x, y in zip(begins, [*begins[1:], len(at)], strict=False)]


class _Sums:
    """Phrases of one bucket, packed as rows of whole numbers, summed over the shards."""

    def __init__(self, parts: list[bytes], counts: list[bytes], columns: int) -> None:
        self.sizes = [len(x) // (8 * columns) for x in parts]
        keys = np.frombuffer(b"".join(parts), np.int64).reshape(-1, columns)
        count = np.frombuffer(b"".join(counts), np.int32).astype(np.int64)
        order = np.lexsort(keys.T[::-1])
        ordered = keys[order]
        begins = np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)])
        self.keys = ordered[begins]
        self.totals = np.add.reduceat(count[order], begins)
        #: For each phrase that came in, its place in ``keys``; and the first that came of each.
        self.place = np.empty(len(keys), np.int64)
        self.place[order] = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(keys)]))
        self.came = order[begins]

    def split(self, values: np.ndarray) -> list[np.ndarray]:
        return np.split(values, np.cumsum(self.sizes)[:-1])


def _packed_words(state: DataFrame, bits: int) -> DataFrame:
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in range(batch.num_rows):
                get = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                keys = np.frombuffer(get["keys"], np.uint64)
                counts = np.frombuffer(get["counts"], np.int64).astype(np.int32)
                words, lang = get["words"].split(b"\n"), np.frombuffer(get["of_lang"], np.int32)
                parts = _cut((keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64))
                yield _named(
                    "bucket shard keys counts words of_lang langs",
                    pa.array([b for b, _, _ in parts], pa.int64()),
                    pa.array([get["shard"]] * len(parts), pa.int64()),
                    pa.array([keys[x:y].tobytes() for _, x, y in parts], pa.binary()),
                    pa.array([counts[x:y].tobytes() for _, x, y in parts], pa.binary()),
                    pa.array([b"\n".join(words[x:y]) for _, x, y in parts], pa.binary()),
                    pa.array([lang[x:y].tobytes() for _, x, y in parts], pa.binary()),
                    pa.array([get["langs"]] * len(parts), pa.list_(pa.string())),
                )

    schema = "bucket long, shard long, keys binary, counts binary, words binary, of_lang binary, langs array<string>"
    return state.select("shard", "keys", "counts", "words", "of_lang", "langs").mapInArrow(run, schema)


def _frequent_words(packed: DataFrame, least: int) -> DataFrame:
    """Answers ``bucket, shard, mask, numbers``, and the words ``bucket, number, word, lang, f`` (no shard)."""

    def run(rows: pa.Table) -> pa.Table:
        get = rows.to_pydict()
        sums = _Sums(get["keys"], get["counts"], 1)
        frequent = sums.totals >= least
        number = np.cumsum(frequent) - 1
        bucket, masks, numbers = get["bucket"][0], [], []
        for place in sums.split(sums.place):
            hit = frequent[place]
            masks.append(np.packbits(hit).tobytes())
            numbers.append(number[place[hit]].astype(np.int32).tobytes())
        came = sums.came[frequent]
        begins = np.r_[0, np.cumsum(sums.sizes)]
        of_row = np.searchsorted(begins, came, side="right") - 1
        words, langs = [""] * len(came), [""] * len(came)
        for row in np.unique(of_row).tolist():
            own, lang = get["words"][row].split(b"\n"), np.frombuffer(get["of_lang"][row], np.int32)
            for at in np.flatnonzero(of_row == row).tolist():
                place = int(came[at] - begins[row])
                words[at] = own[place].decode("utf-8", "replace")
                langs[at] = get["langs"][row][lang[place]]
        m, k = len(masks), len(words)
        return pa.table(
            {
                "bucket": pa.array([bucket] * (m + k), pa.int64()),
                "shard": pa.array(get["shard"] + [None] * k, pa.int64()),
                "mask": pa.array(masks + [None] * k, pa.binary()),
                "numbers": pa.array(numbers + [None] * k, pa.binary()),
                "number": pa.array([None] * m + list(range(k)), pa.int64()),
                "word": pa.array([None] * m + words, pa.string()),
                "lang": pa.array([None] * m + langs, pa.string()),
                "f": pa.array([None] * m + sums.totals[frequent].tolist(), pa.int64()),
            }
        )

    schema = "bucket long, shard long, mask binary, numbers binary, number long, word string, lang string, f long"
    return packed.groupBy("bucket").applyInArrow(run, schema)


# --- The index ----------------------------------------------------------------


def _rank(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the pairs, and the rank of each; equal pairs share a rank."""
    both = high.astype(np.int64) * (int(low.max()) + 1) + low
    order = np.argsort(both, kind="stable")
    ordered = both[order]
    rank = np.empty(len(both), np.int64)
    rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
    return order, rank


def transform(text: np.ndarray) -> np.ndarray:
    """The Burrows-Wheeler transform of ``text`` (0 parts pieces and ends it), sorted by DEPTH words."""
    _, two = _rank(text, np.roll(text, -1))
    _, four = _rank(two, np.roll(two, -2))
    order, _ = _rank(four, np.roll(text, -4))
    return text[order - 1]


class Index:
    """Intervals of all phrases of one depth, which ``extend`` carries one word to the left."""

    def __init__(self, bwt: np.ndarray) -> None:
        self.from_ = np.argsort(bwt, kind="stable")  # LF mapping, inverted
        self.first = bwt[self.from_]  # the word each suffix starts with
        self.at = self.first.astype(np.int64) - 1  # interval of each suffix; -1: none
        self.words = np.arange(1, int(bwt.max(initial=0)) + 1, dtype=np.int64)[:, None]

    def extend(self) -> np.ndarray:
        """Left extensions whose own first words, without the last, are an interval too; their counts."""
        tail = self.at[self.from_]
        begins = np.r_[True, (self.first[1:] != self.first[:-1]) | (tail[1:] != tail[:-1])]
        run = np.cumsum(begins) - 1
        start = np.flatnonzero(begins)
        size = np.diff(np.r_[start, len(tail)])
        # Inside its prefix's interval: the right extension of a phrase that lives.
        lives = (self.first[start] > 0) & (tail[start] >= 0) & (self.at[start] >= 0)
        number = np.where(lives, np.cumsum(lives) - 1, -1)
        self.words = np.column_stack([self.first[start[lives]].astype(np.int64), self.words[tail[start[lives]]]])
        self.at = number[run]
        return size[lives]

    def keep(self, lives: np.ndarray) -> None:
        number = np.where(lives, np.cumsum(lives) - 1, -1)
        self.at = np.where(self.at >= 0, number[self.at], -1) if len(lives) else np.full_like(self.at, -1)
        self.words = self.words[lives]


def _frequent_text(ids: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The global numbers of the words with a frequent neighbour; 0 for the rest, never twice in a row."""
    text = np.r_[0, number[ids], 0]
    alone = np.r_[True, (text[:-2] == 0) & (text[2:] == 0), True]
    text[alone] = 0
    return text[np.r_[True, (text[1:] != 0) | (text[:-1] != 0)]]


def _indexes(state: DataFrame, answers: DataFrame, offsets: list[int]) -> DataFrame:
    """``shard, size, bwt, alphabet``: the index of each shard's frequent words."""

    def run(shard: pa.Table, told: pa.Table) -> pa.Table:
        rows = sorted(zip(*(told.column(x).to_pylist() for x in ("bucket", "mask", "numbers")), strict=True))
        out: dict[str, list] = {"shard": [], "size": [], "bwt": [], "alphabet": []}
        for at in range(shard.num_rows):
            keys = np.frombuffer(shard.column("keys")[at].as_py(), np.uint64)
            bits = (len(offsets) - 1).bit_length()
            size = np.bincount((keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64), minlength=len(offsets))
            hit = [np.unpackbits(np.frombuffer(mask, np.uint8), count=size[b]).astype(bool) for b, mask, _ in rows]
            number = np.zeros(len(keys) + 1, np.int64)
            number[1:][np.concatenate(hit)] = np.concatenate(
                [np.frombuffer(numbers, np.int32) + offsets[b] + 1 for b, _, numbers in rows]
            )
            text = _frequent_text(np.frombuffer(shard.column("ids")[at].as_py(), np.int32), number)
            alphabet, local = np.unique(text, return_inverse=True)
            out["shard"].append(shard.column("shard")[at].as_py())
            out["size"].append(len(text))
            out["bwt"].append(transform(local).astype(np.int32).tobytes())
            out["alphabet"].append(alphabet[1:].tobytes())
        return pa.table(out, schema=pa.schema([("shard", pa.int64()), ("size", pa.int64()), ("bwt", pa.binary()), ("alphabet", pa.binary())]))

    return (
        state.select("shard", "ids", "keys")
        .groupBy("shard")
        .cogroup(answers.where("shard is not null").select("shard", "bucket", "mask", "numbers").groupBy("shard"))
        .applyInArrow(run, "shard long, size long, bwt binary, alphabet binary")
    )


class _Pack:
    """Phrases as rows of whole numbers: as many words in each as fit."""

    def __init__(self, words: int) -> None:
        self.bits = max(words.bit_length(), 1)
        self.fit = 62 // self.bits

    def columns(self, depth: int) -> int:
        return -(-depth // self.fit)

    def packed(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros((len(words), self.columns(words.shape[1])), np.int64)
        for at in range(words.shape[1]):
            out[:, at // self.fit] = (out[:, at // self.fit] << self.bits) | words[:, at]
        return out

    def words(self, keys: np.ndarray, depth: int) -> np.ndarray:
        out = np.empty((len(keys), depth), np.int64)
        for column in range(keys.shape[1]):
            left = keys[:, column].copy()
            for at in reversed(range(column * self.fit, min(depth, (column + 1) * self.fit))):
                out[:, at] = left & ((1 << self.bits) - 1)
                left >>= self.bits
        return out


_PACKED = "depth int, bucket long, shard long, keys binary, counts binary"


def _rows(shard: int, words: np.ndarray, counts: np.ndarray, alphabet: np.ndarray, pack: _Pack, bits: int) -> pa.RecordBatch:
    keys = pack.packed(alphabet[words - 1])
    bucket = _bucket(keys, bits)
    order = np.argsort(bucket, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int32)
    parts = _cut(bucket[order])
    return _named(
        "depth bucket shard keys counts",
        pa.array([words.shape[1]] * len(parts), pa.int32()),
        pa.array([b for b, _, _ in parts], pa.int64()),
        pa.array([shard] * len(parts), pa.int64()),
        pa.array([keys[x:y].tobytes() for _, x, y in parts], pa.binary()),
        pa.array([counts[x:y].tobytes() for _, x, y in parts], pa.binary()),
    )


def _packed_pairs(indexes: DataFrame, pack: _Pack, bits: int) -> DataFrame:
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in range(batch.num_rows):
                index = Index(np.frombuffer(batch.column("bwt")[row].as_py(), np.int32))
                counts = index.extend()
                alphabet = np.frombuffer(batch.column("alphabet")[row].as_py(), np.int64)
                yield _rows(batch.column("shard")[row].as_py(), index.words, counts, alphabet, pack, bits)

    return indexes.mapInArrow(run, _PACKED)


def _longer(indexes: DataFrame, answers: DataFrame, pack: _Pack, bits: int) -> DataFrame:
    """Phrases of three words and more, all pairs of which are frequent everywhere."""

    def run(rows: pa.Table, told: pa.Table) -> pa.Table:
        masks = sorted(zip(told.column("bucket").to_pylist(), told.column("mask").to_pylist(), strict=True))
        out = []
        for row in range(rows.num_rows):
            index = Index(np.frombuffer(rows.column("bwt")[row].as_py(), np.int32))
            alphabet = np.frombuffer(rows.column("alphabet")[row].as_py(), np.int64)
            index.extend()
            if not len(index.words):
                continue
            bucket = _bucket(pack.packed(alphabet[index.words - 1]), bits)
            order = np.argsort(bucket, kind="stable")
            size = dict((b, y - x) for b, x, y in _cut(bucket[order]))
            lives = np.zeros(len(bucket), bool)
            lives[order] = np.concatenate(
                [np.unpackbits(np.frombuffer(m, np.uint8), count=size[b]).astype(bool) for b, m in masks]
            )
            index.keep(lives)
            for _ in range(3, DEPTH + 1):
                counts = index.extend()
                out.append(_rows(rows.column("shard")[row].as_py(), index.words, counts, alphabet, pack, bits))
        schema = pa.schema([("depth", pa.int32()), ("bucket", pa.int64()), ("shard", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
        return pa.Table.from_batches(out, schema)

    return (
        indexes.groupBy("shard")
        .cogroup(answers.where("shard is not null").select("shard", "bucket", "mask").groupBy("shard"))
        .applyInArrow(run, _PACKED)
    )


def _frequent_phrases(packed: DataFrame, pack: _Pack, least: int, answer: bool) -> DataFrame:
    """``words, a`` of the frequent phrases; with ``answer`` also ``bucket, shard, mask`` for each shard."""

    def run(rows: pa.Table) -> pa.Table:
        get = rows.to_pydict()
        depth = get["depth"][0]
        sums = _Sums(get["keys"], get["counts"], pack.columns(depth))
        frequent = sums.totals >= least
        words = pack.words(sums.keys[frequent], depth)
        k, m = len(words), rows.num_rows if answer else 0
        masks = [np.packbits(frequent[x]).tobytes() for x in sums.split(sums.place)] if answer else []
        offsets = np.r_[np.arange(k) * depth, np.full(m + 1, k * depth)].astype(np.int32)
        phrases = pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(words.ravel(), pa.int64()), mask=pa.array([False] * k + [True] * m, pa.bool_())
        )
        return pa.table(
            {
                "words": phrases,
                "a": pa.array(sums.totals[frequent].tolist() + [None] * m, pa.int64()),
                "bucket": pa.array([None] * k + get["bucket"][:m], pa.int64()),
                "shard": pa.array([None] * k + get["shard"][:m], pa.int64()),
                "mask": pa.array([None] * k + masks, pa.binary()),
            }
        )

    schema = "words array<long>, a long, bucket long, shard long, mask binary"
    return packed.groupBy("depth", "bucket").applyInArrow(run, schema)


# --- Counts of all frequent phrases, and their scores -------------------------


def frequent(docs: DataFrame, work: Work, least: int, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The phrases of one word to DEPTH that occur ``least`` times or more in a language.

    ``words (number, word, lang, f)``; ``phrases (words, a)`` of two words and
    more, by number; and ``totals (lang, n)``.
    """
    lang = F.coalesce(F.col("lang"), F.lit("und"))
    state = work.keep(_shards(docs.select("text", lang.alias("lang")), shard_words), "shards", FILE_SHARDS)
    totals = work.keep(
        state.select(F.inline(F.arrays_zip(F.col("langs").alias("lang"), F.col("lang_words").alias("n"))))
        .groupBy("lang")
        .agg(F.sum("n").alias("n")),
        "totals",
    )
    distinct = state.agg(F.sum(F.length("keys") / 8).cast("long")).first()[0] or 0
    bits = _bucket_bits(distinct)
    told = work.keep(_frequent_words(_packed_words(state, bits), least), "words")
    sizes = dict(told.where("number is not null").groupBy("bucket").count().collect())
    offsets = np.cumsum([0, *(sizes.get(b, 0) for b in range(1 << bits))]).tolist()
    begins = docs.sparkSession.createDataFrame(list(enumerate(offsets[:-1])), "bucket long, begin long")
    vocabulary = work.keep(
        told.where("number is not null")
        .join(begins, "bucket")
        .select((F.col("number") + F.col("begin") + 1).alias("number"), "word", "lang", "f"),
        "vocabulary",
    )
    indexes = work.keep(_indexes(state, told, offsets[:-1]), "indexes", FILE_SHARDS)
    bits = _bucket_bits(indexes.agg(F.sum("size")).first()[0] or 0)
    pack = _Pack(offsets[-1])
    pairs = work.keep(_frequent_phrases(_packed_pairs(indexes, pack, bits), pack, least, True), "pairs")
    longer = work.keep(_frequent_phrases(_longer(indexes, pairs, pack, bits), pack, least, False), "longer")
    phrases = pairs.where("words is not null").select("words", "a").unionByName(longer.select("words", "a"))
    return vocabulary, phrases, totals


#: Whole numbers of up to 38 digits.
_SCORE = """
(1000BD * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))
"""


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best ``top`` phrases of each language.

    Words are lower-cased runs inside a piece of text between marks; a phrase is
    two to five of one piece. A null text is empty; a null language is ``und``.
    Repeated rows count as often as they occur, with or without an id. Languages
    without a candidate, and empty tables, give no rows. Other columns aren't read.
    """
    work = Work(docs.sparkSession, "collocations")
    slim = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    vocabulary, phrases, totals = frequent(slim, work, least, shard_words)
    counts = vocabulary.select(F.array("number").alias("words"), F.col("f").alias("a")).unionByName(phrases)
    # Contained in a longer one as frequent: then also in one that is a word longer.
    ends = phrases.where(F.size("words") > 2).select(
        F.explode(F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))).alias("words"),
        "a",
    )
    alone = work.keep(phrases.join(ends, ["words", "a"], "left_anti"), "alone")
    cuts = alone.select(
        "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).select("words", "a", "k", F.expr("slice(words, 1, k)").alias("left"), F.expr("slice(words, k + 1, size(words))").alias("right"))
    sides = cuts.join(counts.select(F.col("words").alias("left"), F.col("a").alias("l")), "left").join(
        counts.select(F.col("words").alias("right"), F.col("a").alias("r")), "right"
    )
    lang = vocabulary.select(F.array("number").alias("first"), "lang")
    scored = (
        sides.withColumn("first", F.slice("words", 1, 1))
        .join(lang, "first")
        .join(totals, "lang")
        .withColumn("score", F.expr(_SCORE))
        .groupBy("lang", "n", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("least"))
        .select("lang", "n", "words", "a", "least.score", "least.l", "least.r")
    )
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = work.keep(scored.withColumn("place", F.rank().over(by)).where(F.col("place") <= top).drop("place"), "best")
    spelled = (
        best.select("words", F.posexplode("words").alias("at", "number"))
        .join(vocabulary.select("number", "word"), "number")
        .groupBy("words")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        best.join(spelled, "words")
        .withColumn("rank", F.row_number().over(by).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
