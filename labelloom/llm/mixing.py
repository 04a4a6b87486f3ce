"""Mixing sources to target weights: a splitting tree over exact block quotas.

Only DataFrame functions are used. The work has three parts:

1. Targets. Each source's share of all words, by weight, is capped at a multiple
   of the source's own size; the excess goes to the others by weight. Sorted by
   cap-to-weight ratio the capped sources form a prefix, so one window over the
   source table (one row per source) finds the final level.
2. Draws. A source's documents stand in one seeded order. Whole passes over the
   source are followed by a part pass that ends at the exact word: the place is
   found by descending a tree of digest prefixes, at each level over the
   sub-totals of one node's children only. The last document gives its leading words.
3. Shards. Every (source, pass, block) is one draw. The number of blocks each
   output shard gets from each source is drawn by splitting the quotas in two,
   again and again, with hypergeometric counts; blocks are then dealt in a
   permuted order, disjointly, and documents are shuffled inside their shard.

Null text counts as no words; a document without words is never taken. Sources
may be null (last in order); names that clash with inner columns are kept apart
because only key, text and source are read here.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.hashing import digest
from labelloom.llm.common import WORD_PATTERN, stored
from labelloom.plans.joins import lookup_join
from labelloom.plans.shared import settle

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = 42
DEPTH = 5
LEVEL_DIGITS = 2
LEAF_ROWS = 1000


def word_count(text: Column | str) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, weight, target) from (source, size); one row per source."""
    totals = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    by_name = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = totals.withColumn("weight", F.get(F.array(*map(F.lit, weights)), place - 1).cast("double"))
    room = (F.lit(cap) * F.col("source_size")).cast("double")
    by_ratio = Window.orderBy(room / F.col("weight"), F.col("source").cast("binary").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    # The level at which a source and all that follow it would stand, when those before it are full.
    level = (F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum(room).over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = weighed.select("*", room.alias("_room"), level.alias("_level"), F.row_number().over(by_ratio).alias("_rank"))
    # The final level is the first that its own source can take.
    fits = F.when(F.col("_level") <= F.col("_room") / F.col("weight"), F.col("_rank"))
    final = levels.withColumn("_final", F.min_by("_level", fits).over(everything))
    return final.select(
        "source",
        "source_size",
        "weight",
        F.least("_room", F.col("_final") * F.col("weight")).alias("target"),
    )


def take_words(sized: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds `passes` (whole takes), `last_words` (words of the part pass) and `taken` to (key, source, size).

    The part pass covers the first `rest` words in digest order. The digest tree
    is descended level by level: a level looks at the children of the one node
    that holds the end, so every window sees at most 16**LEVEL_DIGITS rows a source.
    """
    quota = targets.select(
        "source",
        F.floor(F.when(F.col("source_size") > 0, F.round("target") / F.col("source_size")).otherwise(0)).cast("bigint").alias("_whole"),
        F.round("target").cast("bigint").alias("_target"),
        F.col("source_size").alias("_size"),
    ).withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_size"))
    placed = sized.withColumn("_at", digest("key", "mix", seed))
    path = quota.select(F.col("source").alias("_source"), F.lit("").alias("_prefix"), F.col("_rest").alias("_left"))
    levels = max(1, math.ceil(math.log(max(sized.count(), 1) / LEAF_ROWS, 16**LEVEL_DIGITS)))
    for level in range(1, levels + 1):
        # One row a source: the node that holds the end of its part pass.
        inside = _beside(placed, path).withColumn("_child", F.substring("_at", 1, level * LEVEL_DIGITS))
        children = inside.filter(F.col("_child").startswith(F.col("_prefix"))).groupBy("source", "_child", "_left").agg(
            F.sum("size").alias("_sum")
        )
        path = _descend(children, ["_child"]).select(
            F.col("source").alias("_source"), F.col("_child").alias("_prefix"), F.col("_need").alias("_left")
        )
        path = stored(path, "mix-path")
    ends = _beside(placed, path).filter(F.col("_at").startswith(F.col("_prefix"))).select(
        "source", "_at", "key", "_left", F.col("size").alias("_sum")
    )
    last = stored(_descend(ends, ["_at", "key"]).select(
        F.col("source"), F.col("_at").alias("_end"), F.col("key").alias("_end_key"), F.col("_need").alias("_end_words")
    ), "mix-end")
    cut = settle(quota.join(last, quota["source"].eqNullSafe(last["source"]), "left").drop(last["source"]), "mix-quota")
    joined = lookup_join(placed, cut, ["source"], ["key"], null_safe=True)
    before = (F.col("_at") < F.col("_end")) | ((F.col("_at") == F.col("_end")) & (F.col("key") < F.col("_end_key")))
    is_end = (F.col("_at") == F.col("_end")) & (F.col("key") == F.col("_end_key"))
    part = F.when(F.col("_rest") <= 0, F.lit(0)).when(before, F.col("size")).when(is_end, F.col("_end_words")).otherwise(0)
    return joined.select(
        *[F.col(f"`{c}`") for c in sized.columns],
        F.col("_at").alias("mix_order"),
        F.coalesce("_whole", F.lit(0)).alias("passes"),
        F.coalesce(part, F.lit(0)).cast("bigint").alias("last_words"),
    ).withColumn("taken", F.col("passes") * F.col("size") + F.col("last_words"))


def _beside(placed: DataFrame, path: DataFrame) -> DataFrame:
    """Rows of the sources that still have an end to find, with that end's node."""
    table = settle(path.withColumnRenamed("_source", "source").filter("_left > 0"), "mix-node")
    return lookup_join(placed, table, ["source"], ["key"], how="inner", null_safe=True)


def _descend(parts: DataFrame, order: list[str]) -> DataFrame:
    """The part of each source in which its running total reaches `_left`, with what is needed of it."""
    running = F.sum("_sum").over(
        Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    total = parts.withColumn("_upto", running)
    return total.filter((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_sum") < F.col("_left"))).withColumn(
        "_need", F.col("_left") - (F.col("_upto") - F.col("_sum"))
    )


# --- shards ---


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """Number of good ones among `draws` taken from good + bad, by inversion of the uniform `u`.

    Outcomes are walked from the mode upwards, then from the mode downwards, by the
    ratio of neighbouring probabilities, over twelve standard deviations each way.
    """
    total = (good + bad).cast("double")
    v = {"g": good.cast("double"), "b": bad.cast("double"), "d": draws.cast("double"), "u": u}
    share = F.floor((v["d"] + 1) * (v["g"] + 1) / (total + 2)).cast("double")
    v["low"] = F.greatest(F.lit(0.0), v["d"] - v["b"])
    v["high"] = F.least(v["g"], v["d"])
    v["mode"] = F.least(v["high"], F.greatest(v["low"], share))
    deviation = F.sqrt(v["d"] * v["g"] / total * v["b"] / total * (total - v["d"]) / F.greatest(total - 1, F.lit(1.0)))
    v["reach"] = F.ceil(deviation * 12 + 12).cast("double")
    drawn = _let(v, _invert)
    return F.when(total <= 0, F.lit(0.0)).otherwise(drawn).cast("bigint")


def _let(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """`body` over a struct of `values`, each computed once."""
    return F.get(F.transform(F.array(F.struct(*[c.alias(n) for n, c in values.items()])), body), F.lit(0))


def _invert(v: Column) -> Column:
    def ratio(x: Column) -> Column:  # P(x + 1) / P(x)
        return F.try_divide((v["g"] - x) * (v["d"] - x), (x + 1) * (v["b"] - v["d"] + x + 1))

    def walk(steps: Column, next_ratio: Callable[[Column], Column], limit: Column) -> Column:
        """Sum of the weights of `steps` + 1 outcomes, and how many stay at or below `limit`."""
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), F.lit(0).alias("n"))
        return F.aggregate(
            F.sequence(F.lit(0), steps.cast("int")),
            start,
            lambda s, i: F.struct(
                (s["w"] * next_ratio(i)).alias("w"),
                (s["s"] + s["w"]).alias("s"),
                (s["n"] + F.when(s["s"] + s["w"] <= limit, 1).otherwise(0)).alias("n"),
            ),
        )

    rise, fall = F.least(v["high"] - v["mode"], v["reach"]), F.least(v["mode"] - v["low"], v["reach"])
    up, down = (lambda i: ratio(v["mode"] + i)), (lambda i: F.try_divide(F.lit(1.0), ratio(v["mode"] - i - 1)))
    never = F.lit(-1.0)
    sums = {"up": walk(rise, up, never)["s"], "down": walk(fall, down, never)["s"]}

    def place(t: Column) -> Column:
        # The mode belongs to the upward walk, so the downward one starts behind it.
        aim = v["u"] * (t["up"] + t["down"] - 1)
        above = v["mode"] + F.least(walk(rise, up, aim)["n"].cast("double"), rise)
        below = v["mode"] - F.least(walk(fall, down, aim - t["up"] + 1)["n"].cast("double"), fall)
        return F.when(aim < t["up"], above).otherwise(below)

    return _let(sums, place)


def split_quotas(quotas: DataFrame, depth: int = DEPTH, seed: int = SEED) -> DataFrame:
    """(source, shard, blocks, first): exact block quotas of 2**depth shards, from (source, blocks).

    At every node half of the node's blocks go left. Which sources they come from
    is a multivariate hypergeometric draw, made source by source with the node's
    remaining blocks and seats. Quotas are a row per source and node; the sum over shards is exact.
    `first` is the source's blocks in earlier shards.
    """
    nodes = quotas.select(F.lit(0).alias("node"), "source", F.col("blocks").cast("bigint").alias("blocks"))
    for level in range(depth):
        in_order = F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "blocks")))
        gathered = nodes.groupBy("node").agg(in_order.alias("all"), F.sum("blocks").alias("total"))
        drawn = F.aggregate(
            F.transform("all", lambda x, i: F.struct(
                x["source"].alias("source"), x["blocks"].alias("blocks"),
                (F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("node"), i), F.lit(2**31 - 1)) / F.lit(float(2**31 - 1))).alias("u"),
            )),
            F.struct(
                F.col("total").alias("rest"),
                F.ceil(F.col("total") / 2).cast("bigint").alias("seats"),
                F.array().cast("array<struct<source:string,blocks:bigint,left_blocks:bigint>>").alias("out"),
            ),
            lambda s, x: _seat(s, x),
        )["out"]
        halves = gathered.select("node", F.explode(drawn).alias("x")).select("node", "x.*")
        nodes = stored(
            halves.select(
                F.explode(F.array(
                    F.struct((F.col("node") * 2).alias("node"), "source", F.col("left_blocks").alias("blocks")),
                    F.struct((F.col("node") * 2 + 1).alias("node"), "source", (F.col("blocks") - F.col("left_blocks")).alias("blocks")),
                )).alias("x")
            ).select("x.*"),
            "mix-quotas",
        )
    before = Window.partitionBy("source").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    return nodes.select(
        "source", F.col("node").alias("shard"), "blocks", F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("first")
    )


def _seat(s: Column, x: Column) -> Column:
    taken = hypergeometric(x["blocks"], s["rest"] - x["blocks"], s["seats"], x["u"])
    return F.struct(
        (s["rest"] - x["blocks"]).alias("rest"),
        (s["seats"] - taken).alias("seats"),
        F.concat(s["out"], F.array(F.struct(x["source"], x["blocks"], taken.alias("left_blocks")))).alias("out"),
    )


@dataclass(frozen=True)
class Mix:
    """`documents`: the taken ones with `pass`, `words`, `shard`; `quotas`: blocks by source and shard."""

    documents: DataFrame
    quotas: DataFrame


def deal_shards(taken: DataFrame, depth: int = DEPTH, seed: int = SEED) -> Mix:
    """Deal the result of `take_words` to 2**depth shards.

    A draw is one pass over one block (a digest range of a source). Draws of a
    source stand in a permuted order; shard n gets the next `blocks` of them.
    """
    passes = F.col("passes") + F.signum("last_words").cast("bigint")
    rows = taken.filter(passes > 0).select("*", F.explode(F.sequence(F.lit(0), (passes - 1).cast("int"))).alias("pass"))
    rows = rows.withColumn("words", F.when(F.col("pass") < F.col("passes"), F.col("size")).otherwise(F.col("last_words")))
    # Some eight blocks a shard and pass, or more.
    digits = max(2, math.ceil((depth + 3) / 4))
    rows = rows.filter("words > 0").withColumn("_block", F.substring("mix_order", 1, digits))
    blocks = stored(rows.groupBy("source", "pass", "_block").agg(F.count(F.lit(1)).alias("n")), "mix-blocks")
    quotas = split_quotas(blocks.groupBy("source").agg(F.count(F.lit(1)).alias("blocks")), depth, seed)
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "pass", "_block"), "pass", "_block")
    placed = blocks.withColumn("_place", F.row_number().over(order) - 1).alias("a")
    seats = quotas.alias("b")
    mine = (F.col("_place") >= F.col("first")) & (F.col("_place") < F.col("first") + F.col("b.blocks"))
    dealt = settle(
        placed.join(seats, F.col("a.source").eqNullSafe(F.col("b.source")) & mine).select(
            "a.source", "pass", "_block", "shard"
        ),
        "mix-dealt",
    )
    out = lookup_join(rows, dealt, ["source", "pass", "_block"], ["key"], how="inner", null_safe=True)
    return Mix(out.drop("_block", "mix_order"), quotas)


def sized_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, size, copy): a row per row of `docs`; equal rows differ by `copy`."""
    plain = docs.select(
        document_key(key, text).alias("key"),
        F.col(f"`{source}`").cast("string").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
    )
    counted = stored(plain, "mix-sizes").groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("_same"))
    copies = counted.select("key", "source", "size", F.explode(F.sequence(F.lit(1), F.col("_same").cast("int"))).alias("copy"))
    return copies.select(F.concat_ws("#", "key", F.col("copy").cast("string")).alias("key"), "source", "size", F.concat_ws("|", "key", "source").alias("row_key"))


def document_key(key: str, text: str) -> Column:
    """Identifies a document by its key and text; null keys and texts are told from empty ones."""
    return F.concat_ws(
        "|", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.coalesce(F.md5(F.col(f"`{text}`")), F.lit("-"))
    )


@dataclass(frozen=True)
class MixPlan:
    """`sized` documents, `targets` by source, `taken` words by document, and the dealt `mix`."""

    sized: DataFrame
    targets: DataFrame
    taken: DataFrame
    mix: Mix


def plan_mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = MAX_REPEAT,
    depth: int = DEPTH,
    seed: int = SEED,
) -> MixPlan:
    sized = stored(sized_documents(docs, key, text, source), "mix-rows")
    targets = stored(source_targets(sized, weights, cap), "mix-targets")
    taken = stored(take_words(sized, targets, seed), "mix-taken")
    return MixPlan(sized, targets, taken, deal_shards(taken, depth, seed))


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed rows of `docs`, same columns, dealt to shards and shuffled inside them.

    A document taken n times stands in n rows; one that is taken in part keeps
    its leading words, joined by single blanks. `options` are those of `plan_mix`.
    """
    columns = docs.columns
    dealt = plan_mix(docs, key, text, source, **options).mix.documents
    draws = dealt.select(F.col("row_key").alias("_k"), "pass", "words", "shard", "size", F.col("key").alias("_copy"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.concat_ws("|", document_key(key, text), F.col(f"`{source}`").cast("string")).alias("_k"),
    )
    whole = F.col(f"row.`{text}`")
    words = F.slice(F.regexp_extract_all(whole, F.lit(WORD_PATTERN), 0), F.lit(1), F.col("words").cast("int"))
    cut = F.when(F.col("words") == F.col("size"), whole).otherwise(F.concat_ws(" ", words))
    joined = rows.dropDuplicates(["_k"]).join(
        draws, "_k"
    )
    order = F.xxhash64(F.lit(options.get("seed", SEED)), "_copy", "pass")
    shuffled = joined.repartitionByRange(2 ** options.get("depth", DEPTH), "shard").sortWithinPartitions("shard", order)
    return shuffled.select(*[(cut.alias(c) if c == text else F.col(f"row.`{c}`").alias(c)) for c in columns])
