"""Quality with hierarchical empirical Bayes: document, path and host.

A classifier gives each document the odds that it is good. A host's share of
good documents is shrunk toward the global share, a path's toward its host's, as
much as their spread around it suggests; the document's odds are then moved by
how far its path lies from the global share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import Work, with_first
from daybook.llm.text_model import learn, scored

GOOD, BAD = "good", "bad"
#: Odds beyond these are not believed; part of a path's evidence that counts; cut.
EDGE, SITE_WEIGHT, CUT = 1e-6, 0.5, 0.5
MIN_STRENGTH, MAX_STRENGTH = 2.0, 1e4


def good_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, kind``: good if its quality is 1 and it isn't toxic."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return labels.where("quality is not null").select("doc_id", F.when(good, GOOD).otherwise(BAD).alias("kind"))


def url_host(url: Column) -> Column:
    """The host of a URL in lower case, without a leading ``www.``; null if there is none."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", "")


def url_path(url: Column, depth: int = 1) -> Column:
    """The first ``depth`` folders of a URL's path, as ``/a/b``; the page's own name is none of them."""
    parts = F.split(F.try_parse_url(url, F.lit("PATH")), "/", -1)
    folders = F.filter(F.slice(parts, 1, F.size(parts) - 1), lambda part: part != "")
    return F.concat(F.lit("/"), F.array_join(F.slice(folders, 1, depth), "/"))


def _logit(p: Column) -> Column:
    inside = F.greatest(F.least(p, F.lit(1 - EDGE)), F.lit(EDGE))
    return F.log(inside / (1 - inside))


def _strength(groups: DataFrame, parent: Column) -> float:
    """How many documents the parent's share is worth, by moments: groups of ``n`` with ``mean`` around it."""
    found = groups.where("n >= 2").agg(
        F.sum(F.col("n") * (F.col("mean") - parent) ** 2).alias("spread"),
        F.sum(F.col("n") * parent * (1 - parent)).alias("noise"),
        F.sum("n").alias("n"),
        F.count("*").alias("groups"),
    ).first()
    if not found["groups"] or not found["noise"]:
        return MAX_STRENGTH
    # Of the spread, chance explains one document's variance for each group.
    variance = found["noise"] / found["n"]
    between = max((found["spread"] - found["groups"] * variance) / found["n"], variance / MAX_STRENGTH)
    return float(min(max(variance / between - 1, MIN_STRENGTH), MAX_STRENGTH))


def judged(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """``doc_id, p_doc, p_host, p_path, score, kept`` for each row of ``docs``.

    ``host`` and ``path`` are columns of ``docs``; null ones form a group like any
    other. A null or empty text is judged by its rates, like other short texts.
    Without labels every document has even odds. Rows that repeat count each and
    get equal scores; an empty table gives no rows.
    """
    work = Work(docs.sparkSession, "site-quality")
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
    )
    model = learn(rows, labels)
    scores = work.keep(_scored(rows, model), "scores")
    paths = work.keep(
        scores.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p_doc").alias("good")), "paths"
    ).withColumn("mean", F.col("good") / F.col("n"))
    hosts = (
        paths.groupBy("host")
        .agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        .withColumn("mean", F.col("good") / F.col("n"))
    )
    overall = hosts.agg(F.sum("good") / F.sum("n")).first()[0]
    overall = 0.5 if overall is None else float(overall)
    prior = F.lit(overall)
    strength = _strength(hosts, prior)
    hosts = hosts.select(
        "host", ((F.col("good") + strength * prior) / (F.col("n") + strength)).alias("p_host")
    )
    nested = work.keep(paths.join(hosts, "host"), "nested")
    strength = _strength(nested, F.col("p_host"))
    sites = work.keep(
        nested.select(
            "host",
            "path",
            "p_host",
            ((F.col("good") + strength * F.col("p_host")) / (F.col("n") + strength)).alias("p_path"),
        ),
        "sites",
    )
    placed = with_first(scores, ["host", "path"], sites, F.col("doc_id"))
    odds = _logit(F.col("p_doc")) + SITE_WEIGHT * (_logit(F.col("p_path")) - _logit(prior))
    score = 1 / (1 + F.exp(-odds))
    return placed.select(
        "doc_id", "p_doc", "p_host", "p_path", score.alias("score"), (score >= CUT).alias("kept")
    )


def _scored(rows: DataFrame, model) -> DataFrame:
    return scored(rows, model, [GOOD], carry=["host", "path"]).select(
        "doc_id", "host", "path", F.col("p")[0].alias("p_doc") if model else F.lit(0.5).alias("p_doc")
    )
