"""A gated recurrent language model over words, trained by truncated backpropagation.

Words are counted over all training documents. The most frequent ones are known to
the network one by one, in classes of equal size: a word's probability is that of
its class times its own in the class. All other words, seen or not, belong to a
class by their form, and share its probability in proportion to their counts plus
a half. So the probabilities of all words that occur, and of one more of each form,
add up to one. Output weights start at zero, where the network gives each word its
share of the training tokens; training adds what the context tells. Gates and new
states are bounded by x / (1 + |x|).

Tasks train on their own part of a round's documents, from the same start; the
weights are averaged by tokens. Texts run through lanes, one document after another;
a window ends the gradient, not the state, which starts anew with a document only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import Work, ship
from daybook.llm.shingles import Words, blocks

#: Words the network knows one by one, and in one class; most words whose counts every task holds.
KNOWN, CLASS, HELD = 1024, 32, 1 << 18
#: Units; lanes and steps of a window in training and in scoring.
UNITS, TRAIN_LANES, TRAIN_STEPS, LANES, STEPS = 16, 512, 16, 512, 32
#: In training a longer text is learned from in stretches; scoring never cuts a text.
STRETCH = 512
#: Rounds of training; a round learns from one in so many training documents, each time from others: from all of them in the end.
ROUNDS, SHARE = 4, 4
RATE, START, SEED = 0.1, 2e-3, 11
#: Tokens that one task counts before it passes sums on.
COUNT_TOKENS = 2_000_000
#: Partial sums of weights that reach the driver.
SLOTS = 8

#: Forms: beyond ASCII or not, ending in a mark or not.
FORMS = 4
_MARK = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_LOG10 = np.log(10.0)


def forms(words: Words) -> np.ndarray:
    beyond = np.r_[0, np.cumsum(words.bytes >= 128)]
    has = beyond[words.ends] > beyond[words.starts]
    return has * 2 + _MARK[words.bytes[words.ends - 1]]


def is_held_out() -> Column:
    """A row without an id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))


# --- Counts -------------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (a hash), ``form, c`` over all texts."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[np.ndarray] = []
        kinds: list[np.ndarray] = []
        size = 0
        for batch in source:
            for part in blocks(batch.column("text").to_pylist()):
                words = Words(part, lower=True)
                hashes.append(words.hashes)
                kinds.append(forms(words).astype(np.int8))
                size += len(words.hashes)
                if size >= COUNT_TOKENS:
                    yield summed(hashes, kinds)
                    size = 0
        if size:
            yield summed(hashes, kinds)

    def summed(hashes: list[np.ndarray], kinds: list[np.ndarray]) -> pa.RecordBatch:
        word, at, c = np.unique(np.concatenate(hashes), return_index=True, return_counts=True)
        form = np.concatenate(kinds)[at]
        hashes.clear(), kinds.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(word.view(np.int64)), pa.array(form, pa.int32()), pa.array(c, pa.int64())],
            names=["word", "form", "c"],
        )

    rows = docs.mapInArrow(run, "word long, form int, c long")
    return rows.groupBy("word", "form").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """Totals of the training tokens, and the words whose counts are held: sorted hashes, counts, symbols.

    Symbols are the known words by frequency, then the FORMS, then the end.
    """

    docs: int
    tokens: int
    distinct: int
    words: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    known: np.ndarray
    #: Of the words of each form that aren't known: their number and tokens.
    rest: np.ndarray

    @property
    def end(self) -> int:
        return len(self.known) + FORMS

    @property
    def classes(self) -> int:
        return -(-len(self.known) // CLASS)

    def base(self, c: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of a token that occurs ``c`` times in training."""
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def form_mass(self) -> np.ndarray:
        """A half for each word, seen ones and one more."""
        return self.rest[:, 1] + 0.5 * (self.rest[:, 0] + 1)

    def lookup(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each word, and its count; -1 where it isn't held."""
        place = np.minimum(np.searchsorted(self.words, words.hashes), max(len(self.words) - 1, 0))
        held = self.words[place] == words.hashes if len(self.words) else np.zeros(len(place), bool)
        symbol = np.full(len(place), -1)
        count = np.full(len(place), -1)
        symbol[held], count[held] = self.symbols[place[held]], self.counts[place[held]]
        return np.where(symbol >= 0, symbol, len(self.known) + forms(words)), count


def vocabulary(counts: DataFrame, docs: int, known: int = KNOWN, held: int = HELD) -> Vocabulary:
    """Held are the most frequent words, down to a step of their count at which they are ``held`` at most."""
    step = F.floor(F.log2("c") * 8).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()
    least, total = None, 0
    for row in sorted(steps, reverse=True):
        total += row["n"]
        if total > held:
            break
        least = row["step"]
    found = counts.where(step >= least).toPandas() if least is not None else counts.limit(0).toPandas()
    found = found.sort_values(["c", "word"], ascending=[False, True], ignore_index=True)
    by_form = {r["form"]: (r["n"], r["c"]) for r in counts.groupBy("form").agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()}
    rest = np.array([by_form.get(x, (0, 0)) for x in range(FORMS)], float)
    for form, c in zip(found["form"][:known], found["c"][:known], strict=True):
        rest[form] -= 1, c
    words = found["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    return Vocabulary(
        docs,
        sum(r["c"] for r in steps) + docs,
        sum(r["n"] for r in steps) + (docs > 0),
        words[order],
        found["c"].to_numpy(np.int64)[order],
        np.where(order < known, order, -1),
        found["c"].to_numpy(float)[:known],
        rest,
    )


# --- The network ----------------------------------------------------------------


def initial(vocab: Vocabulary) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(SEED)
    symbols, kinds = vocab.end + 1, vocab.classes + FORMS + 1
    mass = np.zeros(vocab.classes * CLASS)
    mass[: len(vocab.known)] = vocab.known + 0.5
    mass = mass.reshape(vocab.classes, CLASS)
    of_kind = np.r_[mass.sum(axis=1), vocab.form_mass(), vocab.docs + 0.5]
    with np.errstate(divide="ignore"):
        inside = np.where(mass > 0, np.log(mass / np.maximum(mass.sum(axis=1, keepdims=True), 1)), -1e9)
    weights = {
        "embed": draw.normal(0, 0.3, (symbols, UNITS)),
        "input": draw.normal(0, 0.3, (UNITS, 3 * UNITS)),
        "state": draw.normal(0, 0.2, (UNITS, 3 * UNITS)),
        # The update gate starts nearly closed: what a text has told so far fades slowly.
        "gates": np.r_[np.full(UNITS, -1.0), np.zeros(2 * UNITS)],
        "kind": np.zeros((UNITS, kinds)),
        "kind_bias": np.log(of_kind / of_kind.sum()),
        "word": np.zeros((vocab.classes, UNITS, CLASS)),
        "word_bias": inside,
    }
    return {name: x.astype(np.float32) for name, x in weights.items()}


def _softsign(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place: what tanh does, at a tenth of its time."""
    x /= 1 + np.abs(x)
    return x


def _log_total(logits: np.ndarray, share: bool, small: bool) -> np.ndarray:
    """log of the sum of exponentials of each row; with ``share`` the rows turn into probabilities.

    ``small`` logits can't overflow; others have their row's greatest taken off.
    """
    top = 0 if small else logits.max(axis=1, keepdims=True)
    np.exp(logits if small else np.subtract(logits, top, out=logits), out=logits)
    total = logits @ np.ones((logits.shape[1], 1), logits.dtype)
    if share:
        logits /= total
    return (np.log(total) + top)[:, 0]


class Network:
    def __init__(self, weights: dict[str, np.ndarray], known: int) -> None:
        self.w, self.known = weights, known
        self.classes = len(weights["word"])
        # States lie within -1 and 1.
        kind = np.abs(weights["kind"]).sum(axis=0) + weights["kind_bias"]
        word = np.abs(weights["word"]).sum(axis=1) + weights["word_bias"]
        least = np.abs(weights["kind"]).sum(axis=0) - weights["kind_bias"]
        self.small = max(kind.max(initial=0), word.max(initial=0)) < 60 and least.max(initial=0) < 60

    def kind(self, symbol: np.ndarray) -> np.ndarray:
        return np.where(symbol < self.known, symbol // CLASS, symbol - self.known + self.classes)

    def prepare(self) -> np.ndarray:
        """The gates' inputs by symbol."""
        return self.w["embed"] @ self.w["input"] + self.w["gates"]

    def forward(self, table: np.ndarray, symbols: np.ndarray, fresh: np.ndarray, state: np.ndarray, trace: list | None) -> np.ndarray:
        """States before which each symbol of ``[step, lane]`` was read; ``fresh`` lanes start anew."""
        inputs = table.take(symbols, axis=0)
        states = np.empty((*symbols.shape, UNITS), np.float32)
        any_fresh = fresh.any(axis=1)
        for t in range(len(symbols)):
            if any_fresh[t]:
                state = state * ~fresh[t][:, None]
            own = state @ self.w["state"]
            gates = inputs[t, :, : 2 * UNITS] + own[:, : 2 * UNITS]
            gates = _softsign(gates) * np.float32(0.5) + np.float32(0.5)
            update, reset = gates[:, :UNITS], gates[:, UNITS:]
            new = _softsign(reset * own[:, 2 * UNITS :] + inputs[t, :, 2 * UNITS :])
            if trace is not None:
                trace.append((state, own, update, reset, new))
            state = state + update * (new - state)
            states[t] = state
        return states

    def log_probability(self, states: np.ndarray, symbols: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural logs, and with ``grads`` the gradient of the negative sum at ``states``."""
        kind = self.kind(symbols)
        at = np.arange(len(symbols))
        logits = states @ self.w["kind"]
        logits += self.w["kind_bias"]
        out = logits[at, kind].astype(np.float64)
        out -= _log_total(logits, grads is not None, self.small)
        back = None
        if grads is not None:
            logits[at, kind] -= 1
            grads["kind"] += states.T @ logits
            grads["kind_bias"] += logits.sum(axis=0)
            back = logits @ self.w["kind"].T
        order = np.argsort(kind.astype(np.int16), kind="stable")
        order = order[: np.searchsorted(kind[order], self.classes)]
        for rows in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
            if not len(rows):
                continue
            c, place, some = kind[rows[0]], symbols[rows] % CLASS, np.arange(len(rows))
            own = states[rows]
            logits = own @ self.w["word"][c]
            logits += self.w["word_bias"][c]
            picked = logits[some, place]
            out[rows] += picked - _log_total(logits, grads is not None, self.small)
            if grads is not None:
                logits[some, place] -= 1
                grads["word"][c] += own.T @ logits
                grads["word_bias"][c] += logits.sum(axis=0)
                back[rows] += logits @ self.w["word"][c].T
        return out, back

    def backward(self, symbols: np.ndarray, fresh: np.ndarray, trace: list, back: np.ndarray, grads: dict) -> None:
        """Through one window; ``back`` is the gradient at its states."""
        at_inputs = np.empty((*symbols.shape, 3 * UNITS), np.float32)
        left = np.zeros_like(back[0])
        for t in reversed(range(len(symbols))):
            state, own, update, reset, new = trace[t]
            here = back[t] + left
            # The slope of softsign is (1 - |value|)^2; a gate is half of one and a half.
            at_new = here * update * (1 - np.abs(new)) ** 2
            at_update = here * (new - state) * 0.5 * (1 - np.abs(2 * update - 1)) ** 2
            at_reset = at_new * own[:, 2 * UNITS :] * 0.5 * (1 - np.abs(2 * reset - 1)) ** 2
            at_inputs[t] = np.concatenate([at_update, at_reset, at_new], axis=1)
            at_own = np.concatenate([at_update, at_reset, at_new * reset], axis=1)
            grads["state"] += state.T @ at_own
            left = here * (1 - update) + at_own @ self.w["state"].T
            left *= ~fresh[t][:, None]
        flat = at_inputs.reshape(-1, 3 * UNITS)
        own, place = np.unique(symbols.ravel(), return_inverse=True)
        order = np.argsort(place, kind="stable")
        sums = np.add.reduceat(flat[order], np.searchsorted(place[order], np.arange(len(own))), axis=0)
        grads["gates"] += flat.sum(axis=0)
        grads["input"] += self.w["embed"][own].T @ sums
        grads["embed"][own] += sums @ self.w["input"].T


# --- Lanes ------------------------------------------------------------------------


def lanes(sizes: np.ndarray, most: int) -> list[list[int]]:
    """Documents by lane, so that lanes are about equally long: the longest first, to the shortest lane."""
    heap = [(0, lane) for lane in range(min(most, len(sizes)))]
    out: list[list[int]] = [[] for _ in heap]
    for doc in np.argsort(-sizes, kind="stable").tolist():
        length, lane = heapq.heappop(heap)
        out[lane].append(doc)
        heapq.heappush(heap, (length + int(sizes[doc]), lane))
    return out


def windows(texts: list[np.ndarray], end: int, most: int, steps: int) -> Iterator[tuple]:
    """``read, target, fresh, doc`` by ``[step, lane]``; ``target`` is -1 beyond a lane's last document.

    The longest lanes come first, and those at their end are left out of later windows.
    A document's first symbol is read after an end, and its last target is one.
    """
    sizes = np.array([len(x) for x in texts])
    parts = lanes(sizes, most)
    parts.sort(key=lambda x: -int(sizes[x].sum()))
    order = np.array([x for docs in parts for x in docs], np.int64)
    lengths = np.array([int(sizes[x].sum()) for x in parts], np.int64)
    begins = np.cumsum(lengths) - lengths
    # Lane after lane, and one place beyond that stands for all that is empty.
    target = np.concatenate([*(texts[x] for x in order), [-1]]).astype(np.int32)
    starts = np.cumsum(sizes[order]) - sizes[order]
    fresh = np.zeros(len(target), bool)
    fresh[starts] = True
    read = np.where(fresh, end, np.r_[end, target[:-1]]).astype(np.int32)
    doc = np.r_[np.repeat(order, sizes[order]), 0].astype(np.int32)
    for start in range(0, int(lengths.max(initial=0)), steps):
        still = int((lengths > start).sum())
        step = np.arange(start, start + steps)[:, None]
        at = np.where(step < lengths[:still], begins[:still] + step, len(target) - 1)
        yield read.take(at), target.take(at), fresh.take(at), doc.take(at)


def train(weights: dict[str, np.ndarray], squares: dict[str, np.ndarray], texts: list[np.ndarray], vocab: Vocabulary) -> int:
    """One pass over ``texts`` with steps scaled by past gradients, in place; the tokens learned from."""
    state, done = None, 0
    texts = [x[at : at + STRETCH] for x in texts for at in range(0, len(x), STRETCH)]
    for read, target, fresh, _ in windows(texts, vocab.end, TRAIN_LANES, TRAIN_STEPS):
        if state is None:
            state = np.zeros((read.shape[1], UNITS), np.float32)
        net = Network(weights, len(vocab.known))
        trace: list = []
        states = net.forward(net.prepare(), read, fresh, state[: read.shape[1]], trace)
        state = states[-1]
        grads = {name: np.zeros_like(x) for name, x in weights.items()}
        real = target.ravel() >= 0
        flat = states.reshape(-1, UNITS)
        back = np.zeros_like(flat)
        _, back[real] = net.log_probability(flat[real], target.ravel()[real], grads)
        net.backward(read, fresh, trace, back.reshape(states.shape), grads)
        n = int(real.sum())
        for name, slope in grads.items():
            slope /= n
            squares[name] += slope * slope
            weights[name] -= RATE * slope / np.sqrt(squares[name])
        done += n
    return done


def score(net: Network, table: np.ndarray, texts: list[np.ndarray], end: int) -> np.ndarray:
    """log10 probability of each text's classes, and of its known words in them."""
    out = np.zeros(len(texts))
    state = None
    for read, target, fresh, doc in windows(texts, end, LANES, STEPS):
        if state is None:
            state = np.zeros((read.shape[1], UNITS), np.float32)
        states = net.forward(table, read, fresh, state[: read.shape[1]], None)
        state = states[-1]
        real = target.ravel() >= 0
        found, _ = net.log_probability(states.reshape(-1, UNITS)[real], target.ravel()[real])
        out += np.bincount(doc.ravel()[real], found, len(texts))
    return out / _LOG10


# --- Jobs -------------------------------------------------------------------------


def _symbols(texts: Sequence[str | None], vocab: Vocabulary) -> Iterator[tuple[Words, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """By runs of texts: words, symbols, counts, and each text's symbols with the end."""
    for part in blocks(texts):
        words = Words(part, lower=True)
        symbol, count = vocab.lookup(words)
        ended = np.insert(symbol, words.first[1:], vocab.end)
        yield words, symbol, count, np.split(ended, words.first[1:-1] + np.arange(1, len(part)))


def _trained(docs: DataFrame, vocab: Vocabulary, rounds: int, share: int) -> dict[str, np.ndarray]:
    """Weights after ``rounds`` of training and averaging."""
    spark = docs.sparkSession
    weights = initial(vocab)
    squares = {name: np.full_like(x, START) for name, x in weights.items()}
    chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), F.lit(share))
    for number in range(rounds):
        sent = spark.sparkContext.broadcast((vocab, weights, squares))

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own_vocab, start, start_squares = sent.value
            own = {name: x.copy() for name, x in start.items()}
            own_squares = {name: x.copy() for name, x in start_squares.items()}
            tokens, slot = 0, TaskContext.get().partitionId() % SLOTS
            for batch in source:
                texts = [x for *_, part in _symbols(batch.column("text").to_pylist(), own_vocab) for x in part]
                tokens += train(own, own_squares, texts, own_vocab)
            for half, of in (("w", own), ("s", own_squares)):
                for name, x in of.items() if tokens else ():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([half + name]), pa.array([slot], pa.int32()), pa.array([tokens], pa.int64()), pa.array([(x.astype(np.float64) * tokens).tobytes()], pa.binary())],
                        names=["name", "slot", "tokens", "x"],
                    )

        def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple, list] = {}
            for batch in source:
                for name, slot, tokens, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    got = sums.setdefault((name, slot), [0, 0.0])
                    got[0] += tokens
                    got[1] = got[1] + np.frombuffer(x)
            for (name, slot), (tokens, x) in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([slot], pa.int32()), pa.array([tokens], pa.int64()), pa.array([x.tobytes()], pa.binary())],
                    names=["name", "slot", "tokens", "x"],
                )

        schema = "name string, slot int, tokens long, x binary"
        rows = docs.where(chosen == number).select("text").mapInArrow(run, schema)
        sums: dict[str, list] = {}
        for row in rows.repartition(2 * len(weights), "name", "slot").mapInArrow(add, schema).collect():
            got = sums.setdefault(row["name"], [0, 0.0])
            got[0] += row["tokens"]
            got[1] = got[1] + np.frombuffer(row["x"])
        for of, half in ((weights, "w"), (squares, "s")):
            for name in of:
                if half + name in sums:
                    tokens, x = sums[half + name]
                    of[name] = (x / tokens).astype(np.float32).reshape(of[name].shape)
        sent.unpersist()
    return weights


def _scored(docs: DataFrame, vocab: Vocabulary, weights: dict[str, np.ndarray]) -> DataFrame:
    """Per document what the held counts and the network give; ``rare`` words and their ``times`` are open."""
    sent = docs.sparkSession.sparkContext.broadcast((vocab, weights))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, net = sent.value[0], Network(sent.value[1], len(sent.value[0].known))
        table, mass = net.prepare(), np.log10(own.form_mass())
        end = own.base(np.array([own.docs]))[0]
        for batch in source:
            texts, columns = [], {x: [] for x in ("n", "known", "base", "extra", "rare", "times")}
            for words, symbol, count, ended in _symbols(batch.column("text").to_pylist(), own):
                texts += ended
                n = np.diff(words.first)
                of_text = np.repeat(np.arange(len(n)), n)
                held = count >= 0
                columns["n"].append(n + 1)
                columns["known"].append(np.bincount(of_text[held], minlength=len(n)) + (own.docs > 0))
                columns["base"].append(np.bincount(of_text[held], own.base(count[held]), len(n)) + end)
                form = symbol - len(own.known)
                open_ = form >= 0
                extra = -mass[form[open_]] + np.where(held[open_], np.log10(np.maximum(count[open_], 0) + 0.5), 0)
                columns["extra"].append(np.bincount(of_text[open_], extra, len(n)))
                pairs = np.stack([of_text[~held].astype(np.uint64), words.hashes[~held]])
                order = np.lexsort(pairs[::-1])
                pairs = pairs[:, order]
                begins = np.flatnonzero(np.r_[True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)][: pairs.shape[1]])
                times = np.diff(np.r_[begins, pairs.shape[1]])
                cut = np.searchsorted(pairs[0, begins], np.arange(len(n) + 1).astype(np.uint64))
                columns["rare"] += [pairs[1, begins[x:y]].view(np.int64) for x, y in zip(cut[:-1], cut[1:], strict=True)]
                columns["times"] += [times[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
            model = score(net, table, texts, own.end)
            one = {x: np.concatenate([np.empty(0), *columns[x]]) for x in ("n", "known", "base", "extra")}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(one["n"].astype(np.int64)),
                    pa.array(one["known"].astype(np.int64)),
                    pa.array(one["base"]),
                    pa.array(model + one["extra"]),
                    pa.array(columns["rare"], pa.list_(pa.int64())),
                    pa.array(columns["times"], pa.list_(pa.int32())),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare", "times"],
            )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, rare array<long>, times array<int>"
    return docs.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def scored(docs: DataFrame, rounds: int = ROUNDS, share: int = SHARE, known: int = KNOWN, held: int = HELD) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``.

    Both scores are log10 probabilities of the whole text and its end. A null text
    is empty: its end only. A row without an id is learned from. Rows that repeat
    an id count each time. Where no document is left to learn from, both scores
    give all tokens the same. Other columns aren't read; an empty table gives no
    rows. Words are told apart by 64-bit hashes.
    """
    work = Work(docs.sparkSession, "recurrent-lm")
    ship(docs.sparkSession)
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("held_out", is_held_out())
    training = slim.where(~F.col("held_out"))
    counts = work.keep(word_counts(training.select("text")), "counts")
    vocab = vocabulary(counts, training.count(), known, held)
    weights = _trained(training, vocab, rounds, share)
    rows = work.keep(_scored(slim, vocab, weights), "scored")
    open_words = rows.select("row", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("times"))))
    log = F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))
    found = (
        open_words.join(counts.select("word", "c"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * log).alias("logs"),
            F.sum("times").alias("n_open"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_seen"),
        )
    )
    each = float(np.log10(vocab.tokens + 0.5 * (vocab.distinct + 1)))
    logs, n_open = F.coalesce("logs", F.lit(0.0)), F.coalesce("n_open", F.lit(0))
    base = F.col("base") + logs - n_open * F.lit(each)
    return (
        rows.drop("rare", "times")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("n_seen", F.lit(0))).alias("n_known"),
            F.lit(vocab.tokens).cast("long").alias("train_tokens"),
            base.alias("base_score"),
            (F.col("model") + logs).alias("score"),
        )
    )
