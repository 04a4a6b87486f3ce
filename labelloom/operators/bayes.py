"""Multinomial naive Bayes as tables.

The model is (label, feature, weight) rows, fitted by one grouped sum over words and applied by a join, so neither labels nor
features need fit into an array of the driver. Words are weighted by inverse document frequency, counts are smoothed, and predictions equal
those of an array model over the same features.

A feature that a label has never seen weighs the same for all such features, so a text's score under a label is the label's
prior, plus its default weight for all of the text, plus what the features that the label has seen add. That
addition is never negative: the best label is the best of those with an addition, or the best by prior and default alone, and
only seen (label, feature) pairs are ever joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions import fixed_values as V
from labelloom.plans.joins import lookup_join
from labelloom.plans.shared import Settled, measure, settle

SMOOTHING = 1.0
WHOLE_TEXT = -1


def features_of(text: Column, buckets: int | None = None) -> Column:
    """Lower-cased words of a text, or the buckets that a digest deals them to, with repeats; none for a null."""
    words = F.array_remove(F.split(F.lower(text), V.NARROW_SPACE + "+"), "")
    if buckets:
        words = F.transform(words, lambda w: (F.conv(F.substring(F.md5(w), 1, 12), 16, 10).cast("bigint") % buckets).cast("string"))
    return F.coalesce(words, F.array().cast("array<string>"))


@dataclass(frozen=True)
class BayesTables:
    """`weights` (feature, rarity, seen: array of (idx, gain)), one row a feature of the training part, and `labels` (idx, label, prior, rest).

    `rest` is a label's weight of a feature it has not seen, `gain` what a seen one adds to it.
    """

    weights: Settled
    labels: Settled
    buckets: int | None

    def save(self, path: str) -> None:
        self.weights.df.write.mode("overwrite").parquet(f"{path}/weights")
        self.labels.df.withColumn("buckets", F.lit(self.buckets).cast("int")).write.mode("overwrite").parquet(f"{path}/labels")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BayesTables:
        weights, labels = (spark.read.parquet(f"{path}/{n}") for n in ("weights", "labels"))
        buckets = labels.select("buckets").first()
        return BayesTables(measure(weights), measure(labels.drop("buckets")), buckets and buckets[0])


def fit_bayes(train: DataFrame, text_col: str, label_col: str, buckets: int | None = None, smoothing: float = SMOOTHING) -> BayesTables:
    """Fit on all rows with a label; label indices follow the sorted labels. `buckets` hashes words (default: a feature per word)."""
    rows = train.filter(F.col(f"`{label_col}`").isNotNull()).select(
        F.col(f"`{label_col}`").cast("string").alias("label"), F.sort_array(features_of(F.col(f"`{text_col}`"), buckets)).alias("_words")
    )
    # In sorted order a word that differs from the one before is the row's first.
    found = rows.select("label", "_words", F.posexplode("_words").alias("_at", "feature"))
    new = (F.col("_at") == 0) | (F.get("_words", F.col("_at") - 1) != F.col("feature"))
    counts = settle(
        found.groupBy("feature", "label").agg(F.count(F.lit(1)).alias("tf"), F.count_if(new).alias("docs")), "bayes-counts"
    ).df
    sizes = settle(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "bayes-sizes")
    total = sizes.df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # As inverse document frequency and its smoothing are usually defined: log((rows + 1) / (rows with the word + 1)).
    rarity = F.log((F.lit(float(total)) + 1) / (F.sum("docs") + 1)).alias("rarity")
    rare = settle(counts.groupBy("feature").agg(rarity), "bayes-rarity")
    many = float(buckets or max(rare.rows, 1))
    weighted = lookup_join(counts, rare, ["feature"], ["label"], how="inner").withColumn("mass", F.col("tf") * F.col("rarity"))
    masses = settle(weighted.groupBy("label").agg(F.sum("mass").alias("mass")), "bayes-masses")
    known = sizes.df.join(masses.df, "label", "left").withColumn("mass", F.coalesce("mass", F.lit(0.0)))
    from labelloom.operators.split import index_labels

    numbered = index_labels(sizes.df.select(F.col("label").alias("category"))).withColumnRenamed("category", "label")
    prior = F.log(F.col("n") + smoothing) - F.log(F.lit(total + smoothing * sizes.rows))
    rest = F.lit(smoothing)
    labels = settle(
        known.join(numbered, "label").select(
            "idx", "label", prior.alias("prior"), (F.log(rest) - F.log(F.col("mass") + smoothing * many)).alias("rest")
        ), "bayes-labels",
    )
    gain = F.log(F.col("mass") + smoothing) - F.log(F.lit(smoothing))
    indexed = lookup_join(weighted, Settled(labels.df.select("label", "idx"), labels.rows, labels.nbytes), ["label"], ["feature"], how="inner")
    seen = F.sort_array(F.collect_list(F.struct("idx", gain.alias("gain")))).alias("seen")
    # A row has at most one entry a label.
    weights = settle(indexed.groupBy("feature").agg(F.first("rarity").alias("rarity"), seen), "bayes-weights")
    return BayesTables(weights, labels, buckets)


def classify_by_table(model: BayesTables, df: DataFrame, text_col: str, key: str) -> DataFrame:
    """Append `predicted_label`; `key` is unique. Ties go to the label that sorts first; without labels it is null.

    Features never seen in training add nothing.
    """
    words = df.select(F.col(f"`{key}`").alias("_key"), F.explode(features_of(F.col(f"`{text_col}`"), model.buckets)).alias("feature"))
    found = lookup_join(words, model.weights, ["feature"], ["_key"], how="inner")
    # Words are looked up once: the sum of a text's rarities stands beside its additions, under no label.
    whole = F.array(F.struct(F.lit(WHOLE_TEXT).cast(model.labels.df.schema["idx"].dataType).alias("idx"), F.lit(1.0).alias("gain")))
    sums = found.select("_key", "rarity", F.inline(F.concat(whole, "seen"))).groupBy("_key", "idx").agg(F.sum(F.col("rarity") * F.col("gain")).alias("_gain"))
    summed = settle(sums, "bayes-texts").df
    masses = settle(summed.filter(F.col("idx") == WHOLE_TEXT).select("_key", F.col("_gain").alias("_mass")), "bayes-masses")
    added = summed.filter(F.col("idx") != WHOLE_TEXT)
    facts = Settled(model.labels.df.select("idx", "prior", "rest"), model.labels.rows, model.labels.nbytes)
    scored = lookup_join(lookup_join(added, facts, ["idx"], ["_key"], how="inner"), masses, ["_key"], ["idx"], how="inner")
    score = F.col("prior") + F.col("_mass") * F.col("rest") + F.col("_gain")
    best = settle(scored.groupBy("_key").agg(F.max(F.struct(score.alias("score"), (-F.col("idx")).alias("rank"))).alias("_seen")), "bayes-best")
    # One row with all labels: the best by prior and default is found where the text stands.
    listed = model.labels.df.agg(F.collect_list(F.struct("idx", "prior", "rest")).alias("_labels"))
    rows = lookup_join(df.withColumn("_key", F.col(f"`{key}`")), masses, ["_key"], [key], null_safe=True)
    rows = lookup_join(rows, best, ["_key"], [key], null_safe=True).crossJoin(F.broadcast(listed))
    mass = F.coalesce("_mass", F.lit(0.0))
    by_default = F.array_max(F.transform("_labels", lambda x: F.struct((x["prior"] + mass * x["rest"]).alias("score"), (-x["idx"]).alias("rank"))))
    chosen = F.greatest(F.col("_seen"), by_default)
    names = Settled(model.labels.df.select("idx", F.col("label").alias("predicted_label")), model.labels.rows, model.labels.nbytes)
    return lookup_join(rows.withColumn("idx", -chosen["rank"]), names, ["idx"], [key]).select(*[F.col(f"`{c}`") for c in df.columns], "predicted_label")
