"""Quality rules as a learned decision list.

Sequential covering: grow a conjunction of thresholds on the text's counts that
separates bad labelled documents from good ones, prune it on labelled rows that
growing did not see, keep it if it holds there, take away what it covers, and go
on. The rules become one ordered Spark expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import texts
from daybook.llm.text_model import sampled
from daybook.llm.text_stats import with_counts

#: Labelled rows to learn from, those with the least hash of their id.
MAX_LABELLED = 20_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Quantiles tried as thresholds, conditions of a rule, rules of a list.
CUTS, MAX_CONDITIONS, MAX_RULES = 40, 3, 12
#: What a rule must show on rows held back: share of bad ones, and their number.
MIN_PRECISION, MIN_COVERED = 0.95, 5

#: Measures a condition may use, from the counts; each is per word.
MEASURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "dup_lines_per_word": ("n_dup_lines", "n_words"),
    "repeats_per_word": ("n_repeat_words", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
}


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.measure]
        return values >= self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = measure(self.measure)
        return value >= F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def measure(name: str) -> Column:
    part, whole = MEASURES[name]
    return F.col(part).cast("double") / F.greatest(F.col(whole), F.lit(1)).cast("double")


def _covered(rule: Rule, table: dict[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, bool)
    for condition in rule:
        out &= condition.holds(table)
    return out


def _grow(table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the condition with the most information gain, as long as one gains."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and bad[inside].any() and not bad[inside].all():
        before = np.log2(bad[inside].mean())
        best, gain = None, 0.0
        for name, values in table.items():
            for threshold in np.unique(np.quantile(values[inside], np.linspace(0, 1, CUTS + 2)[1:-1])):
                for above in (True, False):
                    condition = Condition(name, above, float(threshold))
                    now = inside & condition.holds(table)
                    hit = np.count_nonzero(bad & now)
                    if hit:
                        value = hit * (np.log2(hit / np.count_nonzero(now)) - before)
                        if value > gain + 1e-9:
                            best, gain = condition, value
        if best is None:
            break
        rule = (*rule, best)
        inside &= best.holds(table)
    return rule


def _pruned(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The start of the rule that tells bad from good best on rows that growing did not see."""

    def worth(part: Rule) -> float:
        now = _covered(part, table, len(bad))
        return (2 * np.count_nonzero(bad & now) - now.sum()) / max(1, now.sum())

    starts = [rule[:size] for size in range(1, len(rule) + 1)]
    return max(starts, key=worth) if starts else ()


def learn(table: dict[str, np.ndarray], bad: np.ndarray, held_back: np.ndarray) -> list[Rule]:
    """The decision list for a table of measures; ``held_back`` marks the rows to prune on."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES:
        sides = []
        for rows in (left & ~held_back, left & held_back):
            sides.append(({name: values[rows] for name, values in table.items()}, bad[rows]))
        (grow, grow_bad), (prune, prune_bad) = sides
        if not grow_bad.any() or not prune_bad.any():
            break
        rule = _pruned(_grow(grow, grow_bad), prune, prune_bad)
        now = _covered(rule, prune, len(prune_bad))
        if not rule or now.sum() < MIN_COVERED or prune_bad[now].mean() < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~_covered(rule, table, len(bad))
    return rules


def expression(rules: list[Rule]) -> Column:
    """The number, from 1, of the first rule that holds; 0 if none does."""
    chain = None
    for number, rule in enumerate(rules, 1):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds &= condition.column()
        chain = (F if chain is None else chain).when(holds, number)
    return F.lit(0) if chain is None else chain.otherwise(0)


def learn_from(docs: DataFrame, labels: DataFrame) -> list[Rule]:
    """Learn from the texts of at most MAX_LABELLED labelled ids (``doc_id, quality``; 0 is bad).

    An id with several labels counts as bad if one is. Texts that the base rules
    reject teach nothing. No labels, or labels of one kind only, give no rules.
    """
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    taken = sampled(docs, marked.agg(F.min("quality").alias("_quality")), MAX_LABELLED)
    rows = (
        with_counts(taken)
        .where(~base_failed())
        .select(
            F.xxhash64("row.doc_id").alias("h"),
            (F.col("row._quality") == 0).alias("bad"),
            *(measure(x).alias(x) for x in MEASURES),
        )
    ).toPandas()
    if rows.empty:
        return []
    table = {name: rows[name].to_numpy(float) for name in MEASURES}
    return learn(table, rows["bad"].to_numpy(bool), rows["h"].to_numpy() % 3 == 0)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule``.

    One row for each row of ``docs``, repeated and null ids included. A null or
    empty text has no words and fails the base rules. ``rule`` is the first learned
    rule that holds, else 0; a document is kept if neither the base rules nor a
    learned rule reject it. An empty table gives no rows.
    """
    rows = texts(docs)
    rules = learn_from(rows, labels)
    return with_counts(rows).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & (expression(rules) == 0)).alias("kept"),
        expression(rules).alias("rule"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns, in one pass."""
    rules = learn_from(texts(docs), labels)
    return with_counts(docs).where(~base_failed() & (expression(rules) == 0)).select("row.*")
