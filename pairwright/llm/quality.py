"""Document quality by hierarchical empirical Bayes.

A document classifier over simple counts gives each text its own evidence. Grouped
aggregations add the evidence up by path and by host; the spread between hosts, and
between the paths of a host, beyond what chance explains says how much a group's own
rate is worth. A path's posterior is shrunk towards its host's, the host's towards
the global rate, and the document's log-odds are moved by what its path (without the
document itself) says beyond the global rate.

The classifier is fitted on at most ``TRAINING_ROWS`` labelled texts; everything
else covers all rows. Defined results: a missing or empty text is one without words;
a missing host or path is a group of its own; equal rows are counted each; without
labels of both kinds every text scores the labels' rate (0.5 without any).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import add_columns, whole
from .toxicity import logistic

TRAINING_ROWS = 20_000
KEEP_SCORE = 0.4
FEATURES = ("symbols", "capitals", "repeats", "variety", "bars", "size")


def describe(text: Column) -> Column:
    """Feature values of a text as an array, in the order of ``FEATURES``."""
    def inside(bound: Column) -> Column:
        t, words = bound["text"], bound["words"]
        chars = F.greatest(F.length(t), F.lit(1)).cast("double")
        n = F.greatest(F.size(words), F.lit(1)).cast("double")
        count = lambda pattern: F.length(F.regexp_replace(t, pattern, "")) / chars
        pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: (a == b).cast("int"))
        repeats = F.aggregate(pairs, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0))) / n
        # How far the number of different words falls short of what texts of that size have.
        variety = F.size(F.array_distinct(words)) / F.pow(n, F.lit(0.8))
        return F.array(
            F.log1p(count(r"[\p{L}\p{N}\s.,|]++") * 100),
            F.log1p(count(r"[^\p{Lu}]++") * 20),
            F.log1p(repeats * 50),
            variety,
            F.log1p(count(r"[^|]++") * 100),
            F.log1p(n) / 5,
        )

    bound = F.struct(text.alias("text"), F.filter(F.split(text, r"\s+", -1), lambda w: w != "").alias("words"))
    return F.element_at(F.transform(F.array(bound), inside), 1)


@dataclass(frozen=True)
class QualityModel:
    coefficients: tuple[float, ...]
    intercept: float

    def log_odds(self, text: Column) -> Column:
        """Evidence of the text alone."""
        def weigh(values: Column) -> Column:
            terms = [values[i] * F.lit(float(c)) for i, c in enumerate(self.coefficients)]
            return sum(terms, F.lit(float(self.intercept)))

        bound = F.element_at(F.transform(F.array(describe(text)), weigh), 1)
        return F.least(F.greatest(bound, F.lit(-12.0)), F.lit(12.0))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS) -> QualityModel:
    """Logistic regression on the first ``max_rows`` labelled ids by hash."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .select("doc_id", F.col("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(max_rows)
    )
    rows = docs.join(F.broadcast(materialize(chosen)), "doc_id").select("label", describe(whole("text")).alias("x")).collect()
    y = np.array([r.label for r in rows], dtype=float)
    if len(set(y)) < 2:
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return QualityModel((0.0,) * len(FEATURES), math.log(rate / (1 - rate)))
    beta = logistic(np.array([r.x for r in rows]), y, ridge=0.1)
    return QualityModel(tuple(beta[:-1]), float(beta[-1]))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _logit(p: Column) -> Column:
    bounded = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(bounded / (1 - bounded))


def _weight(groups: DataFrame, n: str, total: str, mean: str | float) -> float:
    """Prior weight in documents, by moments: the rates' spread around ``mean`` beyond chance.

    The smaller the true spread, the heavier the prior; bounded on both sides.
    """
    m = F.lit(mean) if isinstance(mean, float) else F.col(mean)
    rate = F.col(total) / F.col(n)
    row = groups.where(f"{n} > 0").agg(
        F.sum(F.col(n) * F.pow(rate - m, F.lit(2))).alias("spread"),
        F.sum(m * (1 - m)).alias("chance"),
        F.sum(n).alias("n"),
        F.avg(m * (1 - m)).alias("variance"),
    ).first()
    if not row.n or not row.variance:
        return 1e6
    between = max((row.spread - row.chance) / row.n, row.variance / 1e6)
    return min(max(row.variance / between - 1, 1.0), 1e6)


def score(
    docs: DataFrame, model: QualityModel, host: Column, path: Column, into: str = "quality_score"
) -> DataFrame:
    """Add the score, 0 to 1, to every row; other columns are kept."""
    own = docs.withColumn("_own", model.log_odds(whole("text"))).withColumn(
        "_path", F.struct(F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    )
    paths = materialize(
        own.groupBy("_path").agg(F.count(F.lit(1)).alias("n"), F.sum(_sigmoid(F.col("_own"))).alias("s"))
    )
    hosts = paths.groupBy(F.col("_path.host").alias("host")).agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    hosts = materialize(hosts)
    everything = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s")).first()
    if not everything.n:
        return docs.withColumn(into, F.lit(None).cast("double"))
    mean = everything.s / everything.n
    host_weight = _weight(hosts, "host_n", "host_s", float(mean))
    hosts = hosts.withColumn("host_rate", (F.col("host_s") + host_weight * mean) / (F.col("host_n") + host_weight))
    joined = paths.withColumn("host", F.col("_path.host")).join(hosts, "host")
    path_weight = _weight(joined, "n", "s", "host_rate")
    posterior = joined.select("_path", F.col("n").alias("_n"), F.col("s").alias("_s"), F.col("host_rate").alias("_rate"))
    posterior = materialize(posterior)
    p = _sigmoid(F.col("_own"))
    without = (F.col("_s") - p + path_weight * F.col("_rate")) / (F.col("_n") - 1 + path_weight)
    shifted = F.col("_own") + _logit(without) - _logit(F.lit(float(mean)))
    keyed = own.withColumn("_salt", F.xxhash64("doc_id"))
    return add_columns(keyed, posterior, "_path", "_salt").withColumn(into, _sigmoid(shifted)).drop("_own", "_path", "_n", "_s", "_rate", "_salt")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` by source (host) and language (path)."""
    return score(docs, fit(docs, labels), F.col("source"), F.col("lang"))
