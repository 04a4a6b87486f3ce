"""Row numbers and first-n selections without a single-task sort."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.hashing import digest
from labelloom.plans.joins import fits_broadcast, lookup_join
from labelloom.plans.shared import Settled, settle

BUCKET_ROWS = 1000
MAX_DIGITS = 4
SPREAD = 64


def number_rows(df: DataFrame, order: list[Column | str] | None = None, name: str = "row_number") -> DataFrame:
    """Append a dense 1-based number in `order` (or in stored order when none is given).

    The rows are range-sorted and written; a row's number is the count of rows
    in earlier files plus its position in its own file. Only the per-file counts
    (one per sort partition) are gathered.
    """
    ordered = df.orderBy(*order) if order else df
    table = settle(ordered, "numbered").df
    placed = table.select(
        "*",
        file_order(F.col("_metadata.file_name")).alias("_file"),
        F.col("_metadata.row_index").alias("_at"),
    )
    files = placed.groupBy("_file").agg(F.max("_at").alias("_last"))
    by_file = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select(
        "_file",
        F.coalesce(F.sum(F.col("_last") + 1).over(by_file), F.lit(0)).alias("_before"),
    )
    # One row per sort partition, so the broadcast is bounded by the partition count.
    numbered = placed.join(F.broadcast(offsets), "_file")
    return numbered.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_before") + F.col("_at") + 1).cast("bigint").alias(name),
    )


def file_order(name: Column) -> Column:
    """(task, file of the task) of a written part file, as numbers: names stop sorting as text at 100,000 tasks."""
    task = F.regexp_extract(name, r"^part-(\d+)", 1).cast("bigint")
    return F.struct(task.alias("task"), F.regexp_extract(name, r"-c(\d+)", 1).cast("bigint").alias("part"))


def first_n_per_group(
    df: DataFrame,
    group: list[str],
    order: list[Column | str],
    n: int,
    row_key: list[str],
    spread: int = SPREAD,
) -> DataFrame:
    """First `n` rows of each group in `order`, exact for any group size.

    A hot group is first cut to `n` rows in each of `spread` slots, so no task
    sees the whole of it; at most `spread * n` rows per group reach the last step.
    """
    slotted = df.withColumn("_slot", F.pmod(F.xxhash64(*row_key), F.lit(spread)))
    inner = Window.partitionBy(*group, "_slot").orderBy(*order)
    outer = Window.partitionBy(*group).orderBy(*order)
    part = slotted.withColumn("_rank", F.row_number().over(inner)).filter(F.col("_rank") <= n)
    kept = part.withColumn("_rank", F.row_number().over(outer)).filter(F.col("_rank") <= n)
    return kept.drop("_slot", "_rank")


def first_in_order(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """First `n` rows of each group by `order` (ascending, nulls first), exact for any group size, order and `n`.

    Only groups of more than `n` rows are looked at, and of these only a narrow table of group, order and a digest of
    the row: it is range-sorted and numbered, which tells the n-th row. Whole rows are then kept or not where they
    are. Rows that agree in group and order follow the digest; of equal rows as many are kept as fit.
    """
    if n < 1:
        return df.limit(0)
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > n)
    large = settle(counts, "large-groups")
    if not large.rows:
        return df
    digested = df.withColumn("_digest", content_digest(df))
    keys = [*order, "_digest"]
    narrow = lookup_join(digested.select(*dict.fromkeys([*group, *keys])), large, group, keys, how="inner", null_safe=True)
    numbered = settle(number_rows(narrow.drop("_n"), [*group, *keys], "_number"), "ordered")
    by = [F.col(f"`{c}`") for c in group]
    first = numbered.df.groupBy(*by).agg(F.min("_number").alias("_first"))
    # A row for each large group.
    cut = _null_safe(numbered.df, settle(first, "first-rows"), group).filter(F.col("_number") == F.col("_first") + n - 1)
    cut = settle(cut.select(*by, F.struct(*keys).alias("_cut"), (F.col("_first") + n - 1).alias("_last")), "nth-rows")
    # Of the rows that equal the n-th one, how many are among the first n.
    same = _null_safe(numbered.df, cut, group).filter(F.struct(*keys).eqNullSafe(F.col("_cut")))
    copies = settle(
        same.groupBy(*by, "_cut").agg(F.count(F.lit(1)).alias("_copies"), F.count_if(F.col("_number") <= F.col("_last")).alias("_kept")), "copies"
    )
    names = [F.col(f"`{c}`") for c in df.columns]
    joined = _null_safe(digested, copies, group)
    key = F.struct(*keys)
    inside = F.col("_cut").isNull() | (key < F.col("_cut")) | (key.eqNullSafe(F.col("_cut")) & (F.col("_copies") == F.col("_kept")))
    kept = joined.filter(inside).select(*names)
    if copies.df.filter("_kept < _copies").isEmpty():
        return kept
    # Equal rows across the cut: one of each stands for all, so few texts are moved.
    some = joined.filter(key.eqNullSafe(F.col("_cut")) & (F.col("_kept") < F.col("_copies")))
    return kept.unionByName(repeat_rows(some, df.columns, "_digest", F.col("_kept")))


def _null_safe(df: DataFrame, table: Settled, on: list[str]) -> DataFrame:
    return lookup_join(df, table, on, on, null_safe=True)


def repeat_rows(rows: DataFrame, columns: list[str], by: str, times: Column) -> DataFrame:
    """Of the equal rows that share `by`, as many as `times` says."""
    one = rows.groupBy(by).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("_row"), F.first(times).alias("_times"))
    many = one.filter("_times > 0").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times").cast("bigint"))))
    return many.select(*[F.col(f"_row.`{c}`").alias(c) for c in columns])


def content_digest(df: DataFrame) -> Column:
    """32 hex digits that are equal for equal rows only; columns of any type."""
    parts = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        plain = F.to_json(F.struct(col.alias("v"))) if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)) else col.cast("string")
        parts.append(F.coalesce(F.md5(plain), F.lit("-")))
    return F.md5(F.concat_ws(",", *parts))


@dataclass(frozen=True)
class RankIndex:
    """Units with a `_bucket`, rows per group (`_n`), and rows per group and bucket (`_n`)."""

    by: list[str]
    units: DataFrame
    totals: Settled
    histogram: Settled


def rank_index(units: DataFrame, by: list[str]) -> RankIndex:
    """Bucket each group's units by leading hex digits of `_digest`.

    The larger a group, the more digits, so that a bucket holds about BUCKET_ROWS
    rows; a group of 10^10 rows has 65,536 buckets, a small one a single bucket.
    """
    counts = units.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    digits = F.ceil(F.log(16.0, F.greatest(F.col("_n") / BUCKET_ROWS, F.lit(1.0))))
    totals = settle(counts.withColumn("_digits", F.least(digits, F.lit(MAX_DIGITS)).cast("int")), "group-sizes")
    sized = Settled(totals.df.drop("_n"), totals.rows, totals.nbytes)
    tagged = lookup_join(units, sized, by, ["_digest", "_tie"], null_safe=True)
    bucketed = tagged.select(
        *by, "_digest", "_tie", F.substr("_digest", F.lit(1), F.col("_digits")).alias("_bucket")
    )
    histogram = settle(bucketed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n")), "histogram")
    return RankIndex(by, bucketed, Settled(totals.df.drop("_digits"), totals.rows, totals.nbytes), histogram)


def permutation_cuts(index: RankIndex, groups: DataFrame, ranks: dict[str, Column]) -> Settled:
    """Exact digest and tie of wanted ranks in each group's digest order.

    `ranks` names cuts and gives their rank from the columns of `groups` (one row
    per group). The histogram tells which bucket holds a rank, so only that bucket
    is sorted. The result has `_{cut}_digest` and
    `_{cut}_tie` per group, null where the rank is 0 or beyond the group.
    """
    by, histogram = index.by, index.histogram
    group_keys = {c: f"_group_{c}" for c in by}
    rank_columns = {f"_rank_{cut}": rank.cast("bigint") for cut, rank in ranks.items()}
    groups = groups.select(
        *[F.col(f"`{c}`").alias(k) for c, k in group_keys.items()], *[r.alias(n) for n, r in rank_columns.items()]
    )
    same_group = reduce(
        lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`{k}`")) for c, k in group_keys.items()]
    )
    running = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("_n").over(running) - F.col("_n")
    inside = {
        f"_need_{cut}": F.when(
            (F.col(f"_rank_{cut}") > F.col("_before")) & (F.col(f"_rank_{cut}") <= F.col("_before") + F.col("_n")),
            F.col(f"_rank_{cut}") - F.col("_before"),
        )
        for cut in ranks
    }
    holders = (
        histogram.df.withColumn("_before", before)
        .join(groups, same_group)
        .select(*by, "_bucket", *[n.alias(c) for c, n in inside.items()])
        .filter(F.coalesce(*inside).isNotNull())
    )
    # The buckets that hold a cut are some of the histogram's rows, so its size bounds theirs.
    bounded = Settled(holders, histogram.rows, histogram.nbytes + 8 * len(ranks) * histogram.rows)
    held = bounded if fits_broadcast(bounded) else settle(holders, "cut-buckets")
    candidates = lookup_join(
        index.units, held, [*by, "_bucket"], ["_digest", "_tie"], how="inner", null_safe=True
    )
    place = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_digest", "_tie"))
    placed = candidates.withColumn("_at", place)
    cuts = placed.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("_at") == F.col(f"_need_{cut}"), F.col(column))).alias(f"_{cut}{column}")
            for cut in ranks
            for column in ("_digest", "_tie")
        ]
    )
    return settle(cuts, "cuts")


def keep_first(
    df: DataFrame,
    by: list[str],
    n: int,
    key: str,
    salt: str,
    seed: int,
) -> DataFrame:
    """First `n` rows of each group in seeded digest order; full rows are never shuffled.

    `key` must be unique within a group.
    """
    return first_cuts(df, by, n, key, salt, seed).keep(df)


@dataclass(frozen=True)
class FirstCuts:
    """Where the first `n` rows of each group end in digest order; `keep` applies it to any rows of those groups."""

    by: list[str]
    n: int
    key: str
    salt: str
    seed: int
    cuts: Settled | None
    shared: Settled | None = None

    def keep(self, df: DataFrame) -> DataFrame:
        if self.cuts is None:
            return df.limit(0)
        tagged = df.withColumns({"_digest": digest(self.key, self.salt, self.seed), "_tie": F.col(self.key)})
        joined = lookup_join(tagged, self.cuts, self.by, [self.key], null_safe=True)
        # A group without a cut has fewer than `n` rows: all of them stay.
        inside = at_or_before("_digest", "_tie", "_keep_digest", "_keep_tie")
        kept = joined.filter(F.col("_keep_digest").isNull() | inside)
        return share_copies(kept, df.columns, self.by, self.shared)


def first_cuts(df: DataFrame, by: list[str], n: int, key: str, salt: str, seed: int, repeats: bool = False) -> FirstCuts:
    """Cuts from one narrow pass over `df`. With `repeats`, rows of a group that share a key are equal, and as many are kept as fit."""
    if n < 1:
        return FirstCuts(by, n, key, salt, seed, None)
    tagged = df.withColumns({"_digest": digest(key, salt, seed), "_tie": F.col(key)})
    units = settle(tagged.select(*by, "_digest", "_tie"), "units").df
    index = rank_index(units, by)
    cuts = permutation_cuts(index, index.totals.df, {"keep": F.lit(n)})
    shared = None
    if repeats:
        at_cut = copies_at_cuts(units, cuts, by, ["keep"]).withColumn("_times", F.lit(n) - F.col("_before"))
        shared = settle(at_cut.filter("_times < _copies").select(*by, "_tie", F.lit(None).cast("string").alias("_part"), "_times"), "shared-copies")
    return FirstCuts(by, n, key, salt, seed, cuts, shared)


def copies_at_cuts(units: DataFrame, cuts: Settled, by: list[str], names: list[str]) -> DataFrame:
    """(`by`, _cut, _tie, _before, _copies): units that come before each cut, and that equal it."""
    joined = lookup_join(units, cuts, by, ["_digest", "_tie"], how="inner", null_safe=True)
    totals = []
    for n in names:
        upto = at_or_before("_digest", "_tie", f"_{n}_digest", f"_{n}_tie")
        same = (F.col("_digest") == F.col(f"_{n}_digest")) & (F.col("_tie") == F.col(f"_{n}_tie"))
        totals += [F.count_if(upto & ~same).alias(f"_{n}_before"), F.count_if(same).alias(f"_{n}_copies"), F.max(F.when(same, F.col("_tie"))).alias(f"_{n}_key")]
    found = joined.groupBy(*by).agg(*totals)
    each = [F.struct(F.lit(n).alias("_cut"), F.col(f"_{n}_key").alias("_tie"), F.col(f"_{n}_before").alias("_before"), F.col(f"_{n}_copies").alias("_copies")) for n in names]
    return found.select(*by, F.inline(F.array(*each))).filter("_copies > 0")


def share_copies(rows: DataFrame, columns: list[str], by: list[str], shared: Settled | None, part: str | None = None) -> DataFrame:
    """`rows`, but of those at a shared key (`by`, _tie) as many, and in the parts, that `shared` says.

    Such rows are equal, so one of each stands for all: the others are not moved.
    """
    names = [F.col(f"`{c}`") for c in columns] + ([F.col(part)] if part else [])
    if shared is None or not shared.rows:
        return rows.select(*names)
    keys = settle(shared.df.select(*by, "_tie").distinct().withColumn("_shared", F.lit(True)), "shared-keys")
    marked = lookup_join(rows, keys, [*by, "_tie"], ["_tie"], null_safe=True)
    whole = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")
    one = marked.filter("_shared").groupBy(*[F.col(f"`{c}`").alias(f"_by_{c}") for c in by], "_tie").agg(F.first(whole).alias("_row"))
    parts = shared.df.select(*[F.col(f"`{c}`").alias(f"_of_{c}") for c in by], F.col("_tie").alias("_of_tie"), "_part", "_times")
    same = reduce(lambda a, b: a & b, [F.col(f"_by_{c}").eqNullSafe(F.col(f"_of_{c}")) for c in by], F.col("_tie") == F.col("_of_tie"))
    many = one.join(parts, same).filter("_times > 0").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times").cast("bigint"))))
    again = many.select(*[F.col(f"_row.`{c}`").alias(c) for c in columns], *([F.col("_part").alias(part)] if part else []))
    return marked.filter(F.col("_shared").isNull()).select(*names).unionByName(again)


def at_or_before(digest_col: str, tie_col: str, cut_digest: str, cut_tie: str) -> Column:
    return (F.col(digest_col) < F.col(cut_digest)) | (
        (F.col(digest_col) == F.col(cut_digest)) & (F.col(tie_col) <= F.col(cut_tie))
    )


@dataclass(frozen=True)
class RankParts:
    """Runs of `size` consecutive rows in the order of a digest; `place` tells a row's run where it stands."""

    key: str
    salt: str
    seed: int
    count: int
    buckets: Settled

    def place(self, df: DataFrame, name: str) -> DataFrame:
        tagged = df.withColumns({"_digest": digest(self.key, self.salt, self.seed), "_tie": F.col(self.key)})
        found = lookup_join(tagged.withColumn("_bucket", F.substring("_digest", 1, MAX_DIGITS)), self.buckets, ["_bucket"], [self.key])
        here = F.struct("_digest", "_tie")
        run = F.col("_run") + F.size(F.filter("_starts", lambda c: c <= here))
        return found.select(*[F.col(f"`{c}`") for c in df.columns], "_digest", run.cast("bigint").alias(name))


def rank_parts(df: DataFrame, key: str, size: int, salt: str, seed: int) -> RankParts:
    """Runs of `size` rows, decided from keys alone.

    Rows are counted by the leading digits of their digest, which tells in which bucket a run starts; only those
    buckets are sorted. The result has a row per bucket: the run that it begins in, and where in it further ones start.
    """
    units = df.select(digest(key, salt, seed).alias("_digest"), F.col(key).alias("_tie"))
    units = settle(units.withColumn("_bucket", F.substring("_digest", 1, MAX_DIGITS)), "run-units").df
    # At most 16 ** MAX_DIGITS rows.
    counts = settle(units.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")), "run-buckets")
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranged = settle(counts.df.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("bigint")), "run-ranges")
    # Row numbers from 0; a run starts at every multiple of `size`, the first one with the first row.
    inner = F.floor((F.col("_before") + F.col("_n") - 1) / size) > F.floor((F.col("_before") - 1) / size)
    splitting = settle(ranged.df.filter(inner).select("_bucket", "_before"), "run-splits")
    held = lookup_join(units, splitting, ["_bucket"], ["_tie"], how="inner")
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", "_tie")) - 1 + F.col("_before")
    starts = held.withColumn("_at", place).filter(F.col("_at") % size == 0)
    listed = settle(starts.groupBy("_bucket").agg(F.sort_array(F.collect_list(F.struct("_digest", "_tie"))).alias("_starts")), "run-starts")
    none = F.array().cast(listed.df.schema["_starts"].dataType)
    table = ranged.df.join(listed.df, "_bucket", "left").select(
        "_bucket", F.floor((F.col("_before") - 1) / size).cast("bigint").alias("_run"), F.coalesce("_starts", none).alias("_starts")
    )
    total = ranged.df.agg(F.sum("_n")).first()[0] or 0
    return RankParts(key, salt, seed, -(-total // size), settle(table, "run-table"))


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Give rows that carry no key an id: their place in the order of a digest of their content.

    It depends on the rows alone, not on how files were split; equal rows may swap ids.
    """
    content = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return number_rows(df.withColumn("_content", content), ["_content"], name).drop("_content")
