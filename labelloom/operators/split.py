"""Seeded stratified splits, caps and label vocabularies.

A class is split by one seeded permutation (md5 order): its first rows are the
test part, the next the validation part, the rest the training part. Membership
is a comparison with two cut points per class, so the final pass is a scan plus
a join to one small row per class; row texts are not shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions import fixed_values as V
from labelloom.functions.hashing import DEFAULT_SEED, digest
from labelloom.plans.joins import lookup_join
from labelloom.plans.ordering import (
    FirstCuts, at_or_before, content_digest, copies_at_cuts, first_cuts, number_rows, permutation_cuts, rank_index, share_copies,
)
from labelloom.plans.shared import Settled, settle

SALT = "split"


def class_quotas(counts: DataFrame, label: str, test: float, val: float) -> DataFrame:
    """Per class: rows, and how many go to test and to validation.

    `counts` has (`label`, `_n`). Each hold-out has ceil(fraction * n) rows; the
    kept side is shared out by floor of the proportional share, then by largest
    remainder (ties by label); integer arithmetic throughout.
    """
    first = _allot(counts, label, "_n", test, "_kept")
    second = _allot(first, label, "_kept", val, "_train")
    return second.select(
        label,
        F.col("_n").alias("n"),
        (F.col("_n") - F.col("_kept")).alias("n_test"),
        (F.col("_kept") - F.col("_train")).alias("n_validation"),
        F.col("_train").alias("n_train"),
    )


def _allot(classes: DataFrame, label: str, size: str, held_out: float, name: str) -> DataFrame:
    # One row per class: these windows see the label table, never the data.
    every = Window.partitionBy()
    total = F.sum(size).over(every)
    keep = (total - F.ceil(F.lit(float(held_out)) * total)).cast("bigint")
    product = f"(cast({size} as decimal(19,0)) * cast(_keep as decimal(19,0)))"
    by_remainder = Window.partitionBy().orderBy(F.col("_rest").desc(), F.col(label))
    seats = F.col("_keep") - F.sum("_base").over(every)
    extra = F.row_number().over(by_remainder) <= seats
    return (
        classes.withColumns({"_total": total, "_keep": keep})
        .withColumns(
            {
                "_base": F.expr(f"cast({product} div _total as bigint)"),
                "_rest": F.expr(f"cast({product} % _total as bigint)"),
            }
        )
        .select(*classes.columns, (F.col("_base") + extra.cast("bigint")).alias(name))
    )


def split_rows(
    df: DataFrame,
    label: str,
    key: str | None,
    test: float = V.TEST_FRACTION,
    val: float = V.VALIDATION_FRACTION,
    group_key: str | None = None,
    stratify: bool = True,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Append `split` in (train, validation, test).

    `key` is unique per row; without one (None) rows are known by a digest of their content, and equal rows are
    shared out as the quotas ask. With `group_key`, all rows of a (label, group) stay
    together and quotas count groups.
    """
    if key is not None:
        return split_cuts(df, label, key, test, val, group_key, stratify, seed).mark(df)
    known = df.withColumn("_content", content_digest(df))
    return split_cuts(known, label, "_content", test, val, group_key, stratify, seed, repeats=True).mark(known).drop("_content")


@dataclass(frozen=True)
class SplitCuts:
    """Where the parts of each class end in digest order; `mark` applies it to any rows of those classes."""

    label: str
    unit: str
    stratify: bool
    seed: int
    cuts: Settled
    shared: Settled | None = None

    def mark(self, df: DataFrame) -> DataFrame:
        joined = lookup_join(_tagged(df, self.label, self.unit, self.stratify, self.seed), self.cuts, ["_stratum"], [self.unit], null_safe=True)
        part = (
            F.when(at_or_before("_digest", "_tie", "_test_digest", "_test_tie"), "test")
            .when(at_or_before("_digest", "_tie", "_validation_digest", "_validation_tie"), "validation")
            .otherwise("train")
        )
        return share_copies(joined.withColumn("split", part), df.columns, ["_stratum"], self.shared, "split")


def _tagged(df: DataFrame, label: str, unit: str, stratify: bool, seed: int) -> DataFrame:
    stratum = F.col(label).cast("string") if stratify else F.lit("all")
    return df.withColumns({"_stratum": stratum, "_digest": digest(unit, SALT, seed), "_tie": F.col(unit)})


def split_cuts(
    df: DataFrame,
    label: str,
    key: str,
    test: float = V.TEST_FRACTION,
    val: float = V.VALIDATION_FRACTION,
    group_key: str | None = None,
    stratify: bool = True,
    seed: int = DEFAULT_SEED,
    repeats: bool = False,
) -> SplitCuts:
    """Cuts from one narrow pass over `df`. With `repeats`, rows that share a key are equal, and a cut can run through them."""
    unit = group_key or key
    units = _tagged(df, label, unit, stratify, seed).select("_stratum", "_digest", "_tie")
    units = settle(units.distinct() if group_key else units, "split-units").df
    index = rank_index(units, ["_stratum"])
    quotas = class_quotas(index.totals.df, "_stratum", test, val)
    ranks = {"test": F.col("n_test"), "validation": F.col("n_test") + F.col("n_validation")}
    cuts = permutation_cuts(index, quotas, ranks)
    shared = _shared_copies(units, cuts, quotas) if repeats and not group_key else None
    return SplitCuts(label, unit, stratify, seed, cuts, shared)


def _shared_copies(units: DataFrame, cuts: Settled, quotas: DataFrame) -> Settled:
    """(_stratum, _tie, _part, _times): how many equal rows go to each part, where not all go to one."""
    found = copies_at_cuts(units, cuts, ["_stratum"], ["test", "validation"]).select("_stratum", "_tie", "_before", "_copies").distinct()
    sizes = quotas.select(F.col("_stratum").alias("_of"), "n_test", (F.col("n_test") + F.col("n_validation")).alias("_held"))
    ranked = found.join(sizes, F.col("_stratum").eqNullSafe(F.col("_of")))
    end = F.col("_before") + F.col("_copies")
    upto = lambda rank: F.greatest(F.least(F.col(rank), end) - F.col("_before"), F.lit(0))
    test, held = upto("n_test"), upto("_held")
    parts = [("test", test), ("validation", held - test), ("train", F.col("_copies") - held)]
    listed = F.array(*[F.struct(F.lit(p).alias("_part"), n.cast("bigint").alias("_times")) for p, n in parts])
    some = ranked.withColumn("_parts", F.filter(listed, lambda x: x["_times"] > 0)).filter(F.size("_parts") > 1)
    return settle(some.select("_stratum", "_tie", F.inline("_parts")), "shared-copies")


def hold_out(df: DataFrame, label: str, key: str | None, fraction: float = V.TEST_FRACTION, **options) -> DataFrame:
    """One stratified hold-out: `split` in (train, test)."""
    return split_rows(df, label, key, test=fraction, val=0.0, **options)


def strata_report(
    df: DataFrame,
    label: str,
    test: float = V.TEST_FRACTION,
    val: float = V.VALIDATION_FRACTION,
    group_key: str | None = None,
) -> DataFrame:
    """One row on whether both hold-outs can be stratified, counted in rows or groups.

    First the test part is held out of all, then the validation part of what is left:
    either time every class needs two members, and both sides a member per class.
    """
    units = df.select(label, group_key).distinct() if group_key else df
    counts = settle(units.groupBy(F.col(label).alias("_stratum")).agg(F.count(F.lit(1)).alias("_n")), "strata").df
    kept = F.col("n") - F.col("n_test")
    sizes = class_quotas(counts, "_stratum", test, val).agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.min("n").alias("smallest"),
        F.sum("n").alias("n_rows"),
        F.sum("n_test").alias("n_test"),
        F.sum(kept).alias("n_train"),
        F.count_if(kept > 0).alias("n_classes_left"),
        F.min(F.when(kept > 0, kept)).alias("smallest_left"),
        F.sum("n_validation").alias("n_validation"),
    )
    first = _divides("n_classes", "smallest", F.col("n_test"), F.col("n_train"))
    second = F.lit(not val) | _divides(
        "n_classes_left", "smallest_left", F.col("n_validation"), F.col("n_train") - F.col("n_validation")
    )
    return sizes.withColumns(
        {"can_stratify_test": F.coalesce(first, F.lit(False)), "can_stratify_validation": F.coalesce(second, F.lit(False))}
    )


def _divides(classes: str, smallest: str, held: Column, left: Column) -> Column:
    return (F.col(classes) <= 1) | ((F.col(smallest) >= 2) & (F.least(held, left) >= F.col(classes)))


def check_strata(
    df: DataFrame,
    label: str,
    test: float = V.TEST_FRACTION,
    val: float = V.VALIDATION_FRACTION,
    group_key: str | None = None,
) -> None:
    """Raise when either hold-out meets a class of one or a part smaller than the class count."""
    row = strata_report(df, label, test, val, group_key).first()
    if not row["can_stratify_test"]:
        raise ValueError(
            f"cannot stratify by '{label}': {row['n_classes']} classes, smallest has {row['smallest']} rows, "
            f"parts hold {row['n_train']} and {row['n_test']} rows"
        )
    if not row["can_stratify_validation"]:
        raise ValueError(
            f"cannot stratify the validation part by '{label}': {row['n_classes_left']} classes, smallest has "
            f"{row['smallest_left']} rows left, the part holds {row['n_validation']} of {row['n_train']} rows"
        )


def cap_splits(df: DataFrame, key: str, n: int | None, seed: int = DEFAULT_SEED) -> DataFrame:
    """First `n` rows of every split in the split's permutation order; no cap for None or 0."""
    return cap_cuts(df, key, n, seed).keep(df) if n else df


def cap_cuts(df: DataFrame, key: str, n: int, seed: int = DEFAULT_SEED, repeats: bool = False) -> FirstCuts:
    return first_cuts(df, ["split"], n, key, SALT, seed, repeats)


def split_order(key: str, seed: int = DEFAULT_SEED) -> list[Column]:
    """The order in which parts are read: permutation digest, then row key."""
    return [digest(key, SALT, seed), F.col(key)]


def train_vocabulary(df: DataFrame, label: str) -> DataFrame:
    """Distinct labels of the training part, sorted, with a dense 0-based index."""
    labels = (
        df.filter(F.col("split") == "train")
        .select(F.col(label).cast("string").alias("category"))
        .filter(F.col("category").isNotNull())
        .distinct()
    )
    return index_labels(labels)


def index_labels(labels: DataFrame) -> DataFrame:
    """(idx, category) over distinct labels in code-point order."""
    return number_rows(labels, ["category"]).select(
        (F.col("row_number") - 1).alias("idx"), "category"
    )


def split_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(label).alias("n_categories"),
    )
