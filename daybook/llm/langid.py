"""Language identification by cross-parsing.

Each language has a bounded text to learn from and a suffix automaton of it. A
text is cut, language by language, into the longest phrases that occur in that
language's text; each next phrase starts where the last match ended. A phrase
points into a text of n bytes, so it costs log2(n) bits; the language with the
fewest bits wins. Texts are parsed in blocks of a fixed size, all blocks of a
batch in step with each other; no phrase reaches over the end of a block, which
costs every language one phrase more at most for each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import ship

#: Texts sampled for each language, and the characters taken of each.
SAMPLES, SAMPLE_CHARS = 64, 512
#: Bytes of a block; bytes of text parsed at once.
BLOCK, RUN_BYTES = 256, 1 << 21
UNDETERMINED = "und"

_PREDICTION = "doc_id long, held_out boolean, lang_pred string, score double"
# Digits, punctuation and controls of ASCII read as one space.
_PLAIN = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN)


def suffix_automaton(data: Sequence[int]) -> list[dict[int, int]]:
    """Transitions by state; every path from state 0 spells a substring, and all substrings are there."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in data:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = new
            at = link[at]
        if at >= 0:
            into = moves[at][symbol]
            if length[into] == length[at] + 1:
                link[new] = into
            else:
                copy = len(moves)
                moves.append(dict(moves[into]))
                length.append(length[at] + 1)
                link.append(link[into])
                while at >= 0 and moves[at].get(symbol) == into:
                    moves[at][symbol] = copy
                    at = link[at]
                link[into] = link[new] = copy
        last = new
    return moves


class Parser:
    """The automata of all languages, as tables for stepping many blocks at once.

    A table entry is twice the next state's row, plus one if a new phrase starts
    there. A byte that no language has seen is a phrase of its own.
    """

    def __init__(self, learned: dict[str, str]) -> None:
        self.languages = sorted(learned)
        data = {name: plain(learned[name]) for name in self.languages}
        seen = sorted(set(b"".join(data.values())))
        # Class 0 fills up blocks, class 1 is any byte not seen.
        self.classes = np.ones(256, np.uint8)
        self.classes[seen] = np.arange(2, len(seen) + 2)
        width = len(seen) + 2
        self.tables, self.bits = [], []
        for name in self.languages:
            moves = suffix_automaton(self.classes[list(data[name])].tolist())
            root = np.ones(width, np.int32)
            for symbol, state in moves[0].items():
                root[symbol] = 2 * state * width + 1
            table = np.tile(root, (len(moves), 1))
            for state, row in enumerate(moves):
                for symbol, into in row.items():
                    table[state, symbol] = 2 * into * width
            table[0] = root
            table[:, 0] = 0
            self.tables.append(table.ravel())
            self.bits.append(math.log2(max(2, len(data[name]))))

    def phrases(self, texts: Sequence[bytes]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        blocks = np.array([-(-len(x) // BLOCK) for x in texts])
        begins = np.r_[0, np.cumsum(blocks)]
        filled = np.zeros(begins[-1] * BLOCK, np.uint8)
        for text, begin in zip(texts, begins, strict=False):
            filled[begin * BLOCK : begin * BLOCK + len(text)] = self.classes[np.frombuffer(text, np.uint8)]
        columns = np.ascontiguousarray(filled.reshape(-1, BLOCK).T).astype(np.int32)
        out = np.zeros((len(texts), len(self.languages)))
        owner = np.repeat(np.arange(len(texts)), blocks)
        for at, table in enumerate(self.tables):
            state = np.zeros(begins[-1], np.int32)
            count = np.zeros(begins[-1], np.int32)
            for column in columns:
                entry = table[state + column]
                count += entry & 1
                state = entry >> 1
            out[:, at] = np.bincount(owner, count, len(texts))
        return out

    def predict(self, texts: Sequence[str | None]) -> list[tuple[str, float]]:
        """Language and share of its likelihood (2 to the minus bits) among all languages."""
        lettered = [text is not None and any(map(str.isalpha, text)) for text in texts]
        out = [(UNDETERMINED, 0.0)] * len(texts)
        at = [i for i, yes in enumerate(lettered) if yes]
        if not at or not self.languages:
            return out
        bits = self.phrases([plain(texts[i]) for i in at]) * np.array(self.bits)
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000)).sum(axis=1)
        for i, winner, score in zip(at, best, share, strict=True):
            out[i] = self.languages[winner], float(score)
        return out


def learn(docs: DataFrame) -> dict[str, str]:
    """A bounded text for every language of ``docs`` (``text``, ``lang``).

    Texts are dealt into ``SAMPLES`` groups by a hash; of each group the text
    with the least hash gives ``SAMPLE_CHARS`` characters from a place that the
    hash sets, so repeated texts count once. The driver gets at most SAMPLES *
    SAMPLE_CHARS characters for each language.
    """
    labelled = docs.where("text is not null and lang is not null").select(
        "lang", "text", F.xxhash64("text").alias("h")
    )
    grouped = labelled.withColumn("bucket", F.pmod("h", F.lit(SAMPLES)))
    first = grouped.groupBy("lang", "bucket").agg(F.min("h").alias("h"))
    room = F.greatest(F.char_length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    start = F.pmod(F.shiftright("h", 8), room).cast("int") + 1
    taken = (
        # At most SAMPLES rows a language, so that no text is shuffled to find its sample.
        grouped.join(F.broadcast(first), ["lang", "bucket", "h"])
        .groupBy("lang", "bucket")
        .agg(F.min(F.substring("text", start, F.lit(SAMPLE_CHARS))).alias("text"))
    )
    by: dict[str, list[tuple[int, str]]] = {}
    for row in taken.collect():
        by.setdefault(row["lang"], []).append((row["bucket"], row["text"]))
    return {name: "\n".join(text for _, text in sorted(rows)) for name, rows in by.items()}


_PARSERS: dict[int, Parser] = {}


def _parser(learned: dict[str, str]) -> Parser:
    """One per worker process and learned text."""
    key = hash(tuple(sorted(learned.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(learned)
    return _PARSERS[key]


def identify(docs: DataFrame, learned: dict[str, str]) -> DataFrame:
    """``docs`` has ``doc_id, text, held_out``; returns these ids with ``lang_pred`` and ``score``.

    A null text, or one without a letter (of Unicode's category L), is ``und`` with score 0. So is every
    text if no language was learned. Equal costs go to the first language by
    name. Rows that repeat, or have no id, are predicted like others.
    """
    ship(docs.sparkSession)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(learned)
        for batch in source:
            texts = batch.column("text").to_pylist()
            found: list[tuple[str, float]] = []
            part: list[str | None] = []
            size = 0
            for text in texts:
                part.append(text)
                size += len(text or "") + BLOCK
                if size >= RUN_BYTES:
                    found += parser.predict(part)
                    part, size = [], 0
            found += parser.predict(part)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, _PREDICTION)


def predict_languages(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Learn from all folds but one, predict every document.

    The fold is the CRC-32 of the id as text modulo ``folds``. A row without an
    id is in no fold: it is not held out and not learned from.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.col("lang").cast("string"),
        F.coalesce(fold == held_out, F.lit(False)).alias("held_out"),
    )
    learned = learn(rows.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return identify(rows, learned)
