"""Quality by hierarchical empirical Bayes.

A document's own evidence is a sum of log-likelihood ratios of the words and shapes it has. The ratios come from grouped
counts over a bounded sample of labelled documents (``SAMPLE``, by hash of their ids); only those that stand out clearly
count, and as each needs several documents of the sample, that bounds what is sent to tasks. The sum becomes a probability by a
two-parameter fit on labelled documents that the ratios didn't come from: one of ``FOLDS`` by hash of the id, ``CALIBRATION`` at most.

Hosts and paths then get posteriors for each label, quality and toxicity alike, by grouped aggregation over all documents: labels
where there are any, the evidence elsewhere. A host's mean is shrunk toward the global mean and a path's toward its host's, by concentrations that the
spread of the means themselves gives, so a sparse site says little. Evidence and site are combined as log-odds.

Defined results: documents without labels, text, host or path are scored like others (null text is empty, null host or
path is a site of its own); several labels of a document count as one by their mean; without any labels, everything has
the prior 0.5 and is kept; each row of the input gives one row; a very long text's words are one set in its task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moothall.llm.common import cut

#: Labelled documents that features are learned from.
SAMPLE = 20_000
#: Labelled documents that a feature needs, how clearly and how much it must tell, rows of the fit, and parts one of which is for it.
LEAST, CLEAR, MUCH, CALIBRATION, FOLDS = 4, 4.0, 0.7, 4000, 5

_WORD, _SIGNS, _CAPITALS = re.compile(r"\w+"), re.compile(r"[^\w\s]{2,}"), re.compile(r"\b[A-Z]{2,}\b")


def features(text: str) -> set[str]:
    """The different words of a text, and its shapes: shares of signs, capitals and repetition in coarse steps."""
    words = _WORD.findall(text.lower())
    n = len(words)
    if not n and not text.strip():
        return {"shape:empty"}
    found = set(words)
    step = lambda count, of: min(count * 8 // (of or 1), 8)
    lines = text.split("\n")
    found.add(f"shape:signs{step(len(_SIGNS.findall(text)), n)}")
    found.add(f"shape:bars{step(text.count('|'), n)}")
    found.add(f"shape:capitals{step(len(_CAPITALS.findall(text)), n)}")
    found.add(f"shape:lines{step(len(lines) - len(set(lines)), len(lines))}")
    if n >= 20:
        # longer texts repeat more words; runs of one word are what tells
        found.add(f"shape:runs{step(sum(map(eq, words, words[1:])), n)}")
    return found


def _featured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([list(features(x)) for x in texts.fillna("")], dtype=object)


def featured(text: Column) -> Column:
    return F.pandas_udf(_featured, "array<string>")(text)


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def log_ratios(labelled: DataFrame, labels: tuple[str, ...]) -> dict[str, list[float]]:
    """What having a feature says about each label (0 or 1), from one pass over the labelled rows; 0 where a feature
    says nothing clear."""
    each = labelled.select(*labels, F.explode("features").alias("feature")).groupBy("feature")
    sums = [f(x).cast("double").alias(f"{k}_{x}") for x in labels for k, f in (("n", F.count), ("s", F.sum))]
    counts = cut(each.agg(*sums, F.count("*").alias("rows")).where(F.col("rows") >= LEAST))
    # every text has exactly one of the shapes that tell of signs, or is empty: their counts add up to the rows'
    whole = counts.where(F.col("feature").startswith("shape:signs") | (F.col("feature") == "shape:empty"))
    table: dict[str, list[float]] = {}
    for i, x in enumerate(labels):
        total = whole.agg(F.sum(f"n_{x}").alias("n"), F.sum(f"s_{x}").alias("s")).first()
        n, s = total["n"] or 0.0, total["s"] or 0.0
        own = F.coalesce(f"s_{x}", F.lit(0.0))
        yes, no = own + 0.5, F.col(f"n_{x}") - own + 0.5
        ratio = F.log(yes / F.lit(s + 1.0)) - F.log(no / F.lit(n - s + 1.0))
        n_own, p = F.col(f"n_{x}"), F.lit((s + 0.5) / (n + 1))
        # the likelihood-ratio test that having the feature makes no difference, as standard deviations
        part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / (n_own * share))).otherwise(0.0)
        clear = F.sqrt(2 * F.greatest(part(own, p) + part(n_own - own, 1 - p), F.lit(0.0)))
        told = counts.select("feature", ratio.alias("ratio"), clear.alias("clear"))
        told = told.where((F.col("clear") >= CLEAR) & (F.abs("ratio") >= MUCH))
        for r in told.orderBy("feature").collect():
            table.setdefault(r["feature"], [0.0] * len(labels))[i] = r["ratio"]
    return table


def _fit_sigmoid(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of the logistic curve a + b x through 0/1 labels, by Newton steps with a small ridge."""
    if not len(x) or y.min() == y.max():
        mean = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.5
        return math.log(mean / (1 - mean)), 0.0
    beta, design = np.zeros(2), np.stack([np.ones(len(x)), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hessian, design.T @ (y - p) - 1e-3 * beta), -2, 2)
    return float(beta[0]), float(max(beta[1], 0.0))


def sums_of(text: Column, table: dict[str, list[float]], labels: tuple[str, ...]) -> Column:
    """struct of a text's sum of ratios for each label."""
    width, known = len(labels), set(table)

    def summed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sums = np.zeros((len(texts), width))
            for i, x in enumerate(texts.fillna("")):
                for f in sorted(known & features(x)):
                    sums[i] += table[f]
            yield pd.DataFrame(sums, columns=list(labels))

    return F.pandas_udf(summed, ", ".join(f"{x} double" for x in labels))(text)


def held_out(doc_id: Column) -> Column:
    """Whether a labelled document is for the fit of probabilities rather than for ratios."""
    return F.pmod(F.xxhash64(doc_id, F.lit("fold")), F.lit(FOLDS)) == 0


def calibrated(rows: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """``rows`` (doc_id, sums, said) with a probability ``p_<label>`` for each label, fitted on a bounded sample of those
    held out."""
    one = rows.where("said IS NOT NULL").where(held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min(F.struct("sums", "said")).alias("r"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION).select("r.*").collect()
    for x in labels:
        got = [(r["sums"][x], r["said"][x]) for r in sample if r["said"][x] is not None]
        a, b = _fit_sigmoid(np.array([g[0] for g in got]), np.array([float(g[1]) for g in got]))
        rows = rows.withColumn(f"p_{x}", 1 / (1 + F.exp(-(a + b * F.col(f"sums.{x}")))))
    return rows


def _concentration(means: DataFrame, mean: Column) -> Column:
    """How many observations a prior is worth: from the spread of site means beyond what their sizes explain."""
    spread = F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - mean, 2)) / F.sum("n")
    noise = F.sum(mean * (1 - mean)) / F.sum("n")
    between = F.greatest(spread - noise, F.lit(1e-5))
    return F.greatest(F.max(mean) * (1 - F.max(mean)) / between - 1, F.lit(1.0))


def site_posteriors(rows: DataFrame) -> DataFrame:
    """(host, path, host_posterior, path_posterior, prior) from rows of host, path and y."""
    paths = cut(rows.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    prior = paths.agg(F.coalesce(F.sum("s") / F.sum("n"), F.lit(0.5)).alias("prior")).first()["prior"]
    k = hosts.agg(_concentration(hosts, F.lit(prior)).alias("k")).first()["k"] or 1.0
    hosts = hosts.select("host", ((F.col("s") + k * prior) / (F.col("n") + k)).alias("host_posterior"))
    both = paths.withColumnRenamed("host", "own").join(hosts, F.col("own").eqNullSafe(F.col("host"))).drop("own")
    k = both.agg(_concentration(both, F.col("host_posterior")).alias("k")).first()["k"] or 1.0
    shrunk = (F.col("s") + k * F.col("host_posterior")) / (F.col("n") + k)
    return both.select("host", "path", "host_posterior", shrunk.alias("path_posterior"), F.lit(prior).alias("prior"))


def with_sites(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` with host_<label>, path_<label> (posteriors of their site) and <label>: evidence and site together."""
    sites = site_posteriors(rows.select("host", "path", F.coalesce(f"said.{label}", f"p_{label}").alias("y")))
    sites = sites.toDF("h", "p", f"host_{label}", f"path_{label}", "prior")
    both = rows.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    odds = _logit(F.col(f"p_{label}")) + _logit(F.col(f"path_{label}")) - _logit(F.col("prior"))
    return both.withColumn(label, 1 / (1 + F.exp(-odds))).drop("h", "p", "prior")


def scored(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, evidence, host_posterior, path_posterior, quality, toxic_evidence, toxic_host, toxic_path, toxic and keep for
    each row of ``docs``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", host.alias("host"), path.alias("path"))
    names = ("quality", "toxic")
    truth = labels.where("doc_id IS NOT NULL").groupBy("doc_id")
    truth = cut(truth.agg(*[F.round(F.avg(x)).alias(x) for x in names]))
    # a bounded sample of labels goes to the texts, so no text moves
    sample = truth.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    labelled = rows.join(F.broadcast(sample), "doc_id").select(*names, featured(F.col("text")).alias("features"))
    table = log_ratios(labelled, names)
    made = rows.select("row", "doc_id", "host", "path", sums_of(F.col("text"), table, names).alias("sums"))
    made = cut(made.join(truth.select("doc_id", F.struct(*names).alias("said")), "doc_id", "left"))
    made = with_sites(with_sites(calibrated(made, names), "quality"), "toxic")
    return made.select(
        "doc_id",
        F.col("p_quality").alias("evidence"),
        F.col("host_quality").alias("host_posterior"),
        F.col("path_quality").alias("path_posterior"),
        "quality",
        F.col("p_toxic").alias("toxic_evidence"),
        F.col("host_toxic").alias("toxic_host"),
        F.col("path_toxic").alias("toxic_path"),
        "toxic",
        ((F.col("quality") >= 0.5) & (F.col("toxic") <= 0.5)).alias("keep"),
    )
