"""Counts over whole texts that the quality operators judge by."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from daybook.llm.common import BATCH_ROWS, batches, ship, whole_row
from daybook.llm.shingles import Words, blocks

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
WINDOW = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper")
_BLANK = " \t\n\v\f\r"


def _flags(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_IS_SYMBOL, _IS_UPPER, _IS_SPACE = _flags(SYMBOLS), _flags(bytes(range(65, 91))), _flags(_BLANK.encode())
_IS_TAIL = _flags(bytes(range(0x80, 0xC0)))


def _repeated(windows: np.ndarray) -> int:
    """Words in windows that occur at least twice, each word once."""
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(windows, twice))
    covered = np.zeros(len(windows) + WINDOW - 1, bool)
    for shift in range(WINDOW):
        covered[at + shift] = True
    return int(covered.sum())


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def counts(texts: Sequence[str | None]) -> Iterator[tuple[int, ...]]:
    """COUNTS of each text; a null text has none of anything."""
    for run in blocks(texts):
        words = Words(run, lower=False)
        windows = words.windows(WINDOW)
        data = words.bytes
        ends = np.cumsum([0, *(len(x) + 1 for x in run)])

        def total(flags: np.ndarray, data: np.ndarray = data, ends: np.ndarray = ends) -> np.ndarray:
            running = np.r_[0, np.cumsum(flags[data])]
            return running[ends[1:]] - running[ends[:-1]]

        chars = total(~(_IS_TAIL | _IS_SPACE))
        symbols, upper = total(_IS_SYMBOL), total(_IS_UPPER)
        for i, text in enumerate(run):
            begin, end = words.first[i], words.first[i + 1]
            repeated = _repeated(windows[begin : end - WINDOW + 1]) if end - begin > WINDOW else 0
            yield (
                int(end - begin),
                int(chars[i]),
                int(symbols[i]),
                _duplicate_lines(text),
                repeated,
                int(upper[i]),
            )


def with_counts(docs: DataFrame) -> DataFrame:
    """``row``, a struct of all columns of ``docs``, and COUNTS of its ``text``."""
    ship(docs.sparkSession)
    # The text goes along once, inside its row.
    packed = docs.withColumn("text", F.col("text").cast("string")).select(whole_row(docs))
    row = StructType([StructField("row", packed.schema["row"].dataType)])
    schema = StructType(row.fields + [StructField(name, LongType()) for name in COUNTS])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, BATCH_ROWS):
            rows = list(counts(batch.column("row").field("text").to_pylist()))
            columns = list(zip(*rows, strict=True)) or [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(x, pa.int64()) for x in columns)], names=["row", *COUNTS]
            )

    return packed.mapInArrow(run, schema)
