"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

The encoding of a byte string is fixed by one token per prefix: its last one. A
token ends prefix ``i`` if it is the text's suffix there, and if it may follow
the last token of the prefix before it, that is, if encoding those two tokens'
bytes gives back the two tokens. Exactly one token passes. So each prefix keeps
one number, bytes can be appended without touching what is there, and an edit
leaves every prefix before it as it is.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from daybook.llm.common import BATCH_ROWS, batches, ship, texts

#: Pieces of text, and pairs of tokens, a worker remembers; all are forgotten when there are more.
CACHE = 500_000
#: Pieces that a worker may go on remembering after a task; one that met more forgets all, since it has other work to do.
KEPT = 50_000
#: Characters of text handled at once.
RUN_CHARS = 1 << 20

#: More than any token's number.
PAIR = 1 << 24
#: Stands before the first byte, where every token may follow.
START = PAIR - 1
_NEVER = 1 << 60

VOCABULARY = "byte_bpe_50k.tiktoken"

_RESULT = "doc_id long, ids array<int>, decoded binary, exact boolean"
_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class _Memo(dict):
    """Remembers what ``make`` gives; forgets everything when it has grown large."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHE:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Vocabulary:
    """Ranks of byte strings, as a rank file lists them."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: data for data, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._prefixes = {data[:size] for data in ranks for size in range(len(data) + 1)}
        self.forget()

    def forget(self) -> None:
        """Back to the ranks alone: all else is found again when it is needed."""
        #: By state, the longest end of what was read that begins a token, and
        #: the tokens that it ends with: (size, rank), longest first.
        self._read = [b""]
        self.endings: list[list[tuple[int, int]]] = [[]]
        self._states = {b"": 0}
        #: The state after a state (key // 256) and one more byte (key % 256).
        self.step = _Memo(self._step)
        self._spines: dict[int, tuple[list, list]] = {}
        #: Whether a token (key // PAIR) may be followed by another (key % PAIR).
        self.follows = _Memo(lambda key: self.may_follow(*divmod(key, PAIR)))

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            return cls({base64.b64decode(data): int(rank) for data, rank in pairs})

    def _step(self, key: int) -> int:
        read = self._read[key >> 8] + bytes([key & 255])
        while read not in self._prefixes:
            read = read[1:]
        state = self._states.get(read)
        if state is None:
            state = self._states[read] = len(self._read)
            self._read.append(read)
            ends = ((len(read) - i, self.ranks.get(read[i:])) for i in range(len(read)))
            self.endings.append([(size, rank) for size, rank in ends if rank is not None])
        return state

    def merged(self, data: bytes) -> list[int]:
        """The encoding by its definition: join the neighbours of least rank, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            joined = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(joined)
            if least == _NEVER:
                break
            at = joined.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def _edges(self, token: int) -> tuple[list, list]:
        """The parts that touch the token's left and right end while it is joined up.

        Each is listed with the rank at which it goes into the next; the token stays.
        """
        known = self._spines.get(token)
        if known is None:
            data = self.bytes_of[token]
            if len(data) == 1:
                known = [(data, _NEVER)], [(data, _NEVER)]
            else:
                left, right = self._halves(data)
                first, last = self._edges(left)[0], self._edges(right)[1]
                known = (
                    [*first[:-1], (first[-1][0], token), (data, _NEVER)],
                    [*last[:-1], (last[-1][0], token), (data, _NEVER)],
                )
            self._spines[token] = known
        return known

    def _halves(self, data: bytes) -> tuple[int, int]:
        """The two tokens whose join gives this one: what is left just before the last join."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            joined = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            at = joined.index(min(joined))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the two tokens' bytes encode to just these two tokens.

        They do unless some part at the left token's end and some part at the
        right token's start, both there at one time, join before either goes into
        its own token. Of equal ranks the leftmost join comes first.
        """
        if left == START:
            return True
        ends, starts = self._edges(left)[1], self._edges(right)[0]
        ranks, i, j = self.ranks, 0, 0
        end, end_goes = ends[0]
        start, start_goes = starts[0]
        while True:
            rank = ranks.get(end + start)
            if rank is not None and rank < end_goes and rank <= start_goes:
                return False
            if end_goes == start_goes == _NEVER:
                return True
            if end_goes <= start_goes:
                i += 1
                end, end_goes = ends[i]
            else:
                j += 1
                start, start_goes = starts[j]


class Prefixes:
    """The last token of every prefix of a byte string that can grow and be edited."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary = vocabulary
        self.data = bytearray()
        #: last[n] belongs to the first n bytes.
        self.last = [START]
        self._states = [0]
        self.append(data)

    def append(self, more: bytes) -> None:
        step, endings, follows = self.vocabulary.step, self.vocabulary.endings, self.vocabulary.follows
        last, states, state = self.last, self._states, self._states[-1]
        end = len(last)
        for byte in more:
            state = step[state << 8 | byte]
            states.append(state)
            for size, token in endings[state]:
                if follows[last[end - size] * PAIR + token]:
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end}: the vocabulary lacks a byte")
            end += 1
        self.data += more

    def cut(self, size: int) -> None:
        """Keep the first ``size`` bytes only."""
        del self.data[size:], self.last[size + 1 :], self._states[size + 1 :]

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put ``new`` in place of the bytes from start to stop; prefixes before start stay.

        Once the prefixes after the edit have ended in the same tokens as before,
        none reaching into the edit, for longer than any token, so will the rest.
        """
        tail, old, states = bytes(self.data[stop:]), self.last[stop + 1 :], self._states[stop + 1 :]
        self.cut(start)
        self.append(new)
        same = 0
        for at in range(len(tail)):
            self.append(tail[at : at + 1])
            inside = len(self.vocabulary.bytes_of[self.last[-1]]) <= at
            same = same + 1 if inside and self.last[-1] == old[at] else 0
            if same > self.vocabulary.longest:
                self.data += tail[at + 1 :]
                self.last += old[at + 1 :]
                self._states += states[at + 1 :]
                return

    def ids(self) -> list[int]:
        out, end = [], len(self.last) - 1
        while end:
            token = self.last[end]
            out.append(token)
            end -= len(self.vocabulary.bytes_of[token])
        return out[::-1]


class Codec:
    """Encodes texts piece by piece, each match of the pattern separately.

    Pieces met before are looked up. New ones are encoded in sorted order, so
    that each starts from the prefixes that it shares with the one before.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str = public_tokenizers.PATTERN) -> None:
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self._known: dict[str, tuple[str, bytes]] = {}

    def rest(self) -> None:
        """At the end of a task: keep little, as the worker process stays and may serve any other stage next."""
        if len(self._known) > KEPT or len(self.vocabulary.follows) > KEPT:
            self._known = {}
            self.vocabulary.forget()

    def _learn(self, pieces: set[str]) -> None:
        prefixes, ranks, decode = Prefixes(self.vocabulary), self.vocabulary.ranks, self.decode
        for data, piece in sorted((piece.encode("utf-8", "surrogatepass"), piece) for piece in pieces):
            whole = ranks.get(data)
            if whole is None:
                same = len(os.path.commonprefix((bytes(prefixes.data), data)))
                prefixes.cut(same)
                prefixes.append(data[same:])
                ids = prefixes.ids()
            else:
                ids = [whole]
            self._known[piece] = " ".join(map(str, ids)), decode(ids)

    def described(self, texts: Sequence[str]) -> Iterator[tuple[str, bytes]]:
        """Of each text, the ids as decimals with spaces between, and the bytes they decode to."""
        cut = [self.split(text) for text in texts]
        if len(self._known) >= CACHE:
            self._known.clear()
        self._learn(set().union(*cut) - self._known.keys())
        for pieces in cut:
            found = list(map(self._known.__getitem__, pieces))
            yield " ".join([x[0] for x in found]), b"".join([x[1] for x in found])

    def encode(self, text: str) -> list[int]:
        return [int(token) for ids, _ in self.described([text]) for token in ids.split()]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


def _runs(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts (null: empty) in runs of about RUN_CHARS."""
    for batch in batches(source, BATCH_ROWS):
        start, run, size = 0, [], 0
        for text in batch.column("text").to_pylist():
            run.append(text or "")
            size += len(run[-1])
            if size >= RUN_CHARS:
                yield batch.column("doc_id").slice(start, len(run)), run
                start, run, size = start + len(run), [], 0
        if run:
            yield batch.column("doc_id").slice(start, len(run)), run


_CODECS: dict[str, Codec] = {}


@contextmanager
def _codec(path: str) -> Iterator[Codec]:
    """One per worker process and rank file, which rests between tasks."""
    if path not in _CODECS:
        _CODECS[path] = Codec(Vocabulary.load(path))
    try:
        yield _CODECS[path]
    finally:
        _CODECS[path].rest()


def encoded(
    docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids, decoded, exact``: each whole text's token ids, the bytes they decode to, and whether
    these are the text's.

    A null text is an empty one and has no ids. Rows that repeat and rows without
    an id are encoded like any other; other columns are not read; an empty table
    gives no rows. ``vocabulary`` names a rank file that every executor has installed.
    """
    ship(docs.sparkSession)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(public_tokenizers.path(vocabulary)) as codec:
            for doc_ids, run in _runs(source):
                found = list(codec.described(run))
                ids = [list(map(int, x[0].split())) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids,
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([x[1] for x in found], pa.binary()),
                        pa.array([x[1] == text.encode() for x, text in zip(found, run, strict=True)]),
                    ],
                    names=["doc_id", "ids", "decoded", "exact"],
                )

    return texts(docs, id_col, text_col).mapInArrow(run, _RESULT)


def digests(
    docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what ``encoded`` gives, without storing it.

    The ids are hashed as decimals joined by one space. Cases are as in ``encoded``.
    """
    ship(docs.sparkSession)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(public_tokenizers.path(vocabulary)) as codec:
            for doc_ids, run in _runs(source):
                rows = [
                    (
                        ids.count(" ") + 1 if ids else 0,
                        hashlib.sha256(ids.encode()).hexdigest(),
                        hashlib.sha256(data).hexdigest(),
                    )
                    for ids, data in codec.described(run)
                ]
                counts, hashes, decoded = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(counts, pa.int64()), pa.array(hashes), pa.array(decoded)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return texts(docs, id_col, text_col).mapInArrow(run, _DIGEST)
