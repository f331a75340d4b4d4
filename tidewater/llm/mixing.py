"""Mixing to target weights by soft membership, with DataFrame functions only.

Domains are the combinations of the two label columns. Two naive Bayes
classifiers over hashed words, learned from a bounded sample of labelled rows
(about ``SAMPLE`` ids, chosen by hash), give each document a posterior of every domain. Each
document then gets a rate r >= 0 (how often it should occur) so that the
expected tokens of each domain, summed over all documents, match the target
weights: least squares over nonnegative rates, of all solutions the one nearest to 1,
by projected gradient steps. The gradient of a document is its posterior times one
residual per domain, so the unprojected point after any number of steps is 1 - p . m with one
multiplier m per domain, and the rate its projection max(0, 1 - p . m): all that a
step needs from the corpus is the domain sums and, to measure residuals by its
inverse, the Gram matrix of the domains over the documents whose rate isn't 0.
Posteriors are written once: the words join a written table of the ratios, never a
constant within the plan.

``copies`` rounds the rate at random by a hash of id and text's hash, so its mean is
the rate.

Defined results: null and blank texts have no tokens, the prior as posterior and
the rate that follows from it; ids with several labels use their mean; without
any labelled row the prior is even and every rate is the same; a domain that no
document leans to keeps its share as it is; repeated rows are counted and rated
each, and draw alike; an empty table gives no rows; other columns are kept by
``mixed`` and ignored elsewhere.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

SAMPLE = 20_000
BUCKETS = 1 << 14
#: Words that a class is given of the overall distribution, so that rare words weigh little.
PSEUDO_WORDS = 20_000.0
DOMAINS = ("poor", "poor_toxic", "good", "good_toxic")
TARGET = {"good": 0.86, "good_toxic": 0.04, "poor": 0.08, "poor_toxic": 0.02}
STEPS, TOLERANCE = 60, 1e-6
#: Weight of the distance to rate 1 against that to the targets (decides where many rates, or none, meet them).
NEAR_ONE = 1e-9
#: Log odds are held within this, so that no posterior is 0 or 1.
MOST = 12.0


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), "\n\t\r", "   "), " "), "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


class Classifier:
    """Log-likelihood ratios of hashed words for both labels, as a table of ``BUCKETS`` rows
    (bucket, ratio_good, ratio_bad) that joins to words, and prior log odds."""

    def __init__(self, spark: SparkSession, ratios: np.ndarray, prior: np.ndarray):
        rows = [(k, float(g), float(b)) for k, (g, b) in enumerate(ratios)]
        self.ratios = written(spark.createDataFrame(rows, "bucket int, ratio_good double, ratio_bad double").coalesce(1), "word-ratios")
        self.prior = [float(x) for x in prior]

    def chance(self, mean_ratio: Column, n: Column, label: int) -> Column:
        """Of prior plus the summed ratios over the square root of the words."""
        value = F.lit(self.prior[label]) + F.coalesce(mean_ratio, F.lit(0.0)) * F.sqrt(n)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-MOST), F.least(F.lit(MOST), value))))


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learn from about ``SAMPLE`` labelled ids; only counts per bucket reach the driver."""
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("own_id"))
    known = known.agg((F.avg("quality") >= 0.5).cast("int").alias("good"), (F.avg("toxic") >= 0.5).cast("int").alias("bad"))
    # the share of ids that SAMPLE stands for, by hash: no sort, and no more than that reaches the driver
    share = min(1.0, SAMPLE / max(1, labels.count()))
    known = written(known.where(F.pmod(F.xxhash64("own_id"), F.lit(1 << 30)) < int(share * (1 << 30))), "label-sample")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("own_id"), "text").join(F.broadcast(known), "own_id")
    spread = rows.select("good", "bad", F.explode(words(F.col("text"))).alias("word")).groupBy(bucket(F.col("word")).alias("bucket"))
    classes = [(good, bad) for good in (0, 1) for bad in (0, 1)]
    counted = spread.agg(*(F.count_if((F.col("good") == good) & (F.col("bad") == bad)).alias(f"n{good}{bad}") for good, bad in classes))
    counts = np.zeros((2, 2, BUCKETS))
    for r in counted.collect():  # a row per bucket
        for good, bad in classes:
            counts[good, bad, r["bucket"]] = r[f"n{good}{bad}"]
    per_class = {(r["good"], r["bad"]): r["count"] for r in known.groupBy("good", "bad").count().collect()}
    overall = counts.sum(axis=(0, 1))
    share = overall / max(1.0, overall.sum())
    ratios, prior = np.zeros((BUCKETS, 2)), np.zeros(2)
    for k in (0, 1):
        of = [counts[v].sum(axis=0) if k == 0 else counts[:, v].sum(axis=0) for v in (0, 1)]
        chance = [(c + PSEUDO_WORDS * share) / (c.sum() + PSEUDO_WORDS) for c in of]
        used = overall > 0
        ratios[used, k] = np.log(chance[1][used] / chance[0][used])
        n = [1 + sum(c for key, c in per_class.items() if key[k] == v) for v in (0, 1)]
        prior[k] = np.log(n[1] / n[0])
    return Classifier(docs.sparkSession, ratios, prior)


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """(own_id, own_key, mix_rows, mix_tokens, mix_p): a row for equal rows (id, text) of
    ``docs``, their number, the words of each and its posterior of every domain."""
    rows = docs.select(*_row_key(docs), words(docs["text"]).alias("words"))
    each = rows.select("own_id", "own_key", F.size("words").alias("n"), F.explode_outer("words").alias("word"))
    # a broadcast of BUCKETS rows; the means are summed in each task before the shuffle
    known = each.withColumn("bucket", bucket(F.col("word"))).join(F.broadcast(model.ratios), "bucket", "left")
    # a text without words stands as one row without a word
    spread = F.greatest(F.col("n"), F.lit(1))
    means = known.groupBy("own_id", "own_key").agg(
        F.max("n").alias("mix_tokens"), F.sum(1 / spread).alias("rows"), F.sum(F.when(F.col("word").isNotNull(), F.col("ratio_good"))).alias("good"),
        F.sum(F.when(F.col("word").isNotNull(), F.col("ratio_bad"))).alias("bad"), F.count("word").alias("words"),
    )
    n = F.col("mix_tokens")
    good, bad = (model.chance(F.col(c) / F.col("words"), n, k) for k, c in enumerate(("good", "bad")))
    out = means.select("own_id", "own_key", F.round("rows").cast("bigint").alias("mix_rows"), "mix_tokens", good.alias("good"), bad.alias("bad"))
    good, bad = F.col("good"), F.col("bad")
    p = F.array((1 - good) * (1 - bad), (1 - good) * bad, good * (1 - bad), good * bad)
    return out.select("own_id", "own_key", "mix_rows", "mix_tokens", p.alias("mix_p"))


def _row_key(docs: DataFrame) -> list[Column]:
    return [docs["doc_id"].cast("bigint").alias("own_id"), F.xxhash64(docs["text"].cast("string")).alias("own_key")]


def rate(multipliers: np.ndarray, p: Column) -> Column:
    """The rate that follows from a document's posterior: the projection of 1 - p . multipliers to 0 and more."""
    move = sum((F.get(p, F.lit(k)) * F.lit(float(x)) for k, x in enumerate(multipliers)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.lit(1.0) - move)


def solve(rows: DataFrame, target: dict[str, float] = TARGET) -> tuple[np.ndarray, float]:
    """The multipliers for (mix_rows, mix_tokens, mix_p) rows, and the largest distance of
    a domain's share from its target that is left; each step is one sum over all rows.

    A step that overshoots (by the objective) is halved. If no rates can meet the
    targets, the least squares stay apart from them, and the distance says so.
    """
    k = len(DOMAINS)
    p = [F.get("mix_p", F.lit(i)) for i in range(k)]
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    weights = np.array([target[d] for d in DOMAINS]) / sum(target.values())
    tokens = (F.col("mix_tokens") * F.col("mix_rows")).cast("double").alias("tokens")
    at, step, gap = np.zeros(k), np.zeros(k), 0.0
    value, slope = np.inf, 0.0
    best = np.inf, at
    for _ in range(STEPS):
        tried = at + step
        rated = rows.select(tokens, "mix_p", rate(tried, F.col("mix_p")).alias("r"))
        free = F.when(F.col("r") > 0, F.col("tokens")).otherwise(F.lit(0.0))
        sums = rated.agg(
            F.sum("tokens"),
            F.sum(F.col("tokens") * F.col("r") * F.col("r")),
            *(F.sum(F.col("tokens") * F.col("r") * p[i]) for i in range(k)),
            *(F.sum(free * p[i] * p[j]) for i, j in cells),
        ).first()
        if not sums[0]:
            return at, 0.0
        found = np.array(sums[1:], float) / float(sums[0])
        residual = found[1 : k + 1] - weights
        gap = float(np.abs(residual).max())
        best = min(best, (gap, tried), key=lambda x: x[0])
        now = found[0] / 2 + weights @ tried + NEAR_ONE / 2 * tried @ tried
        if now > value + 1e-4 * slope + 1e-15:  # too far: half of it
            step, slope = step / 2, slope / 2
            continue
        downhill = residual - NEAR_ONE * tried
        if gap < TOLERANCE or np.abs(downhill).max() < NEAR_ONE:
            break
        gram = np.zeros((k, k))
        for (i, j), x in zip(cells, found[k + 1 :], strict=True):
            gram[i, j] = gram[j, i] = x
        at, value = tried, now
        step = np.linalg.solve(gram + NEAR_ONE * np.eye(k), downhill)
        slope = -float(step @ downhill)
    gap, at = best
    if gap >= TOLERANCE:
        warnings.warn(f"mixing leaves a domain {gap:.2g} of all tokens from its target", stacklevel=2)
    return at, gap


def _rated(docs: DataFrame, labels: DataFrame, target: dict[str, float]) -> DataFrame:
    """(own_id, own_key, mix_rows, mix_tokens, mix_p, mix_rate, mix_copies, target_gap) of the distinct rows."""
    found = written(posteriors(docs, fit(docs, labels)), "posteriors")
    multipliers, gap = solve(found, target)
    rows = found.withColumn("mix_rate", rate(multipliers, F.col("mix_p")))
    draw = F.pmod(F.xxhash64("own_id", "own_key", F.lit("draw")), F.lit(1 << 32)) / F.lit(float(1 << 32))
    whole = F.floor("mix_rate")
    copies = (whole + (draw < F.col("mix_rate") - whole).cast("bigint")).cast("bigint")
    return rows.withColumn("mix_copies", copies).withColumn("target_gap", F.lit(gap))


def document_rates(docs: DataFrame, labels: DataFrame, target: dict[str, float] = TARGET) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>..., rate, copies, target_gap) of every row of ``docs``; the last is
    the same everywhere: the largest distance of a domain's share of tokens from its target."""
    rows = _rated(docs, labels, target)
    rows = rows.withColumn("mix_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("mix_rows"))))
    p = [F.get("mix_p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)]
    return rows.select(
        F.col("own_id").alias("doc_id"), F.col("mix_tokens").cast("bigint").alias("n_tokens"), *p, F.col("mix_rate").alias("rate"), F.col("mix_copies").alias("copies"), "target_gap"
    )


def mixed(docs: DataFrame, labels: DataFrame, target: dict[str, float] = TARGET) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, all columns kept."""
    kept = _rated(docs, labels, target).where("mix_copies > 0").select(F.col("own_id").alias("kept_id"), F.col("own_key").alias("kept_key"), "mix_copies")
    packed = docs.select(*_row_key(docs), F.struct(*docs.columns).alias("own_row"))  # own names can't clash within
    rows = packed.join(kept, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_key") == F.col("kept_key")))
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("mix_copies")))
    return rows.select("own_row", "mix_copies").withColumn("mix_copy", times).select("own_row.*")
