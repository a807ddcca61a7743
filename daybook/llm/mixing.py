"""Mixing to target weights, with soft membership.

A classifier of the labelled table gives each document a posterior over domains.
Nonnegative rates r are fitted so that the expected tokens of each domain,
sum r n p, meet the targets: least squares by projected gradient, where a step
moves every rate by the same combination of its own posterior and is cut off at
zero. So all that a step needs is a few sums over the documents, and a rate
follows from the posterior and the short list of steps.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import Work, text_key, texts
from daybook.llm.text_model import learn, scored

#: Fixed values of the labelled table: what its two marks mean as a domain.
DOMAINS = ("clean", "low", "toxic")
#: A target below what the classifier leaves open of clean text could only be met
#: by dropping clean text.
TARGETS = {"clean": 0.90, "low": 0.05, "toxic": 0.05}
#: The domain whose tokens set the total: it stays as large as it is.
ANCHOR = "clean"
#: Passes at most, and how near all totals have to come, as a part of the whole.
MAX_PASSES, TOLERANCE, RIDGE = 60, 1e-4, 1e-9
#: A step that doesn't bring the totals nearer is halved so many times at most.
MAX_HALVINGS = 6


def domain_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, kind`` of the labelled table (``doc_id, quality, toxic``)."""
    kind = (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    )
    return labels.select("doc_id", kind.alias("kind"))


def rate(steps: Sequence[Sequence[float]], domains: int) -> Column:
    """The rate after these steps, from 1 on, of a document with posterior ``p``."""
    out: Column = F.lit(1.0)
    for step in steps:
        move = sum((F.col("p")[d] * float(step[d]) for d in range(1, domains)), F.col("p")[0] * float(step[0]))
        out = F.greatest(out - move, F.lit(0.0))
    return out


@dataclass(frozen=True)
class Fit:
    """The steps, the totals wanted and reached, and whether these are near enough."""

    steps: list[list[float]]
    wanted: np.ndarray
    reached: np.ndarray
    met: bool


def _totals(posteriors: DataFrame, steps: Sequence[Sequence[float]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain after ``steps``, and sums of products where a rate is positive."""
    weight = F.col("n_words").cast("double")
    rows = posteriors.withColumn("r", rate(steps, size))
    active = F.when(F.col("r") > 0, weight).otherwise(0.0)
    pairs = [(a, b) for a in range(size) for b in range(a + 1)]
    sums = [F.sum(weight * F.col("r") * F.col("p")[d]).alias(f"e{d}") for d in range(size)]
    sums += [F.sum(active * F.col("p")[a] * F.col("p")[b]).alias(f"h{a}_{b}") for a, b in pairs]
    found = rows.agg(*sums).first()
    products = np.zeros((size, size))
    for a, b in pairs:
        products[a, b] = products[b, a] = found[f"h{a}_{b}"] or 0.0
    return np.array([found[f"e{d}"] or 0.0 for d in range(size)]), products


def fit_rates(posteriors: DataFrame, targets: Sequence[float], anchor: int, repeats: bool = False) -> Fit:
    """Steps toward the targets; each costs one pass that sums a few numbers over ``n_words, p``.

    Without ``repeats``, a domain that has fewer tokens than its target keeps what
    it has, as documents aren't repeated to fill it; its weight is then below the
    target. With ``repeats`` it is filled, at the expense of whatever shares its
    documents.

    A gradient in the measure of tokens, scaled by the inverse of the sums of
    products of the posteriors with a positive rate, so that small domains settle
    as fast as large ones. A step has to bring the totals nearer, or it is halved. The
    fit ends when all are near enough, or when no step helps any more: then the
    targets can't be met by these documents, and ``met`` says so.
    """
    size = len(targets)
    goal = np.array(targets, float) / sum(targets)
    expected, products = _totals(posteriors, [], size)
    total = expected[anchor] / goal[anchor] if goal[anchor] > 0 else expected.sum()
    wanted = goal * total if repeats else np.minimum(goal * total, expected)
    scale = max(expected.sum(), 1.0)
    steps: list[list[float]] = []
    passes, halvings = 1, 0
    move = None
    while np.abs(expected - wanted).max(initial=0.0) > TOLERANCE * max(total, 1.0) and passes < MAX_PASSES:
        if move is None:
            move = np.linalg.lstsq(products + RIDGE * scale * np.eye(size), expected - wanted, rcond=1e-7)[0]
        trial = [*steps, (move / 2**halvings).tolist()]
        reached, trial_products = _totals(posteriors, trial, size)
        passes += 1
        if np.linalg.norm(reached - wanted) < (1 - 1e-4) * np.linalg.norm(expected - wanted):
            steps, expected, products, move, halvings = trial, reached, trial_products, None, 0
        elif halvings == MAX_HALVINGS:
            break
        else:
            halvings += 1
    met = bool(np.abs(expected - wanted).max(initial=0.0) <= TOLERANCE * max(total, 1.0))
    return Fit(steps, wanted, expected, met)


def reached(
    mixed: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    domains: Sequence[str] = DOMAINS,
    anchor: str = ANCHOR,
) -> DataFrame:
    """``domain, wanted, by_rates, by_copies``: tokens of a ``mixed`` result against its full targets."""
    goal = {d: targets.get(d, 0.0) / sum(targets.get(x, 0.0) for x in domains) for d in domains}
    n = F.col("n_words").cast("double")
    sums = [F.sum(n * F.col(f"p_{anchor}")).alias("anchor")]
    for d in domains:
        sums += [F.sum(n * F.col(f"p_{d}") * F.col(by)).alias(f"{by}_{d}") for by in ("rate", "copies")]
    rows = [
        F.struct(
            F.lit(d).alias("domain"),
            (F.col("anchor") / F.lit(goal[anchor]) * F.lit(goal[d])).alias("wanted"),
            F.col(f"rate_{d}").alias("by_rates"),
            F.col(f"copies_{d}").alias("by_copies"),
        )
        for d in domains
    ]
    return mixed.agg(*sums).select(F.inline(F.array(*rows)))


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    domains: Sequence[str] = DOMAINS,
    anchor: str = ANCHOR,
    repeats: bool = False,
    keyed: bool = False,
) -> DataFrame:
    """``doc_id, n_words``, a posterior ``p_<domain>`` each, ``rate`` and ``copies`` of each row of ``docs``.

    ``labels`` has ``doc_id, kind``. ``copies`` is the rate rounded up or down by a
    hash of the id, up as often as its fraction says. A null or empty text has no
    tokens and takes part with its rate only. Without labels all posteriors are
    equal and all rates 1. If the targets can't be met, the rates are the nearest ones
    found, and a warning tells the totals; ``reached`` compares them in any case. Rows that repeat get equal rates; a row without an id rounds like id 0.
    An empty table gives no rows. With ``keyed``, ``text_key`` tells which of an id's
    texts a row is about.
    """
    work = Work(docs.sparkSession, "mixing")
    rows = texts(docs)
    model = learn(rows, labels)
    keys = ["text_key"] if keyed else []
    if keyed:
        rows = rows.withColumn("text_key", text_key())
    posteriors = work.keep(scored(rows, model, domains, keys), "posteriors")
    steps: list[list[float]] = []
    if model is not None:
        fit = fit_rates(posteriors, [targets.get(d, 0.0) for d in domains], list(domains).index(anchor), repeats)
        steps = fit.steps
        if not fit.met:
            totals = zip(domains, fit.reached.round().tolist(), fit.wanted.round().tolist(), strict=True)
            warnings.warn(f"mixing: targets not met (domain, reached, wanted): {list(totals)}", stacklevel=2)
    # A number in [0, 1) that only depends on the id.
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit("mixing")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # Sums of doubles depend on the order of tasks; what they leave in the last places is cut off.
    found = posteriors.withColumn("rate", F.round(rate(steps, len(domains)), 6))
    return found.select(
        "doc_id",
        "n_words",
        *(F.col("p")[at].alias(f"p_{name}") for at, name in enumerate(domains)),
        "rate",
        F.floor(F.col("rate") + draw).cast("long").alias("copies"),
        *keys,
    )
