"""SimHash near-duplicates by the generalised pigeonhole principle.

A 64-bit fingerprint is split into groups of correlated bits. If thresholds t_i
(each -1 or more) satisfy sum(t_i + 1) = t + 1, two fingerprints at distance t or less
agree to within t_i bits in some group i. A group with -1 is not probed. Thresholds are
allocated by dynamic programming on the cost expected from all fingerprints: probes
sent plus candidates met. Each fingerprint is filed under its own value of a group
and under every value within t_i flips of it; fingerprints that meet are verified.

Equal fingerprints are one node, so copies cost nothing. Inside a meeting
place only a spanning forest of the verified links is kept, not all pairs: a place
with n fingerprints gives n - 1 links at most. Places with very many fingerprints are parted by
further groups of their unused bits, exactly. Components come from the links.

Empty and null texts have fingerprint zero and link like any other. Repeated
rows are nodes of the same class; null keys are allowed and never are a class id
unless the whole class has none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.llm.common import connected_components, stored
from labelloom.plans.joins import lookup_join
from labelloom.plans.ordering import content_digest
from labelloom.plans.shared import Settled, settle

BITS = 64
THRESHOLD = 4
SHINGLE = 4
SEED = 42
HOT_PLACE = 4096
MAX_GROUPS = 5
PROBE_COST, CANDIDATE_COST = 4.0, 0.2
SLICE_HASHES = 200_000


def fingerprint(text: str, n: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text; zero when it has no words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and blanks only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[:-1]]
    k = max(len(words) - n + 1, 1)
    spans = zip(starts[:k].tolist(), (ends[min(n, len(words)) - 1 :] - 1).tolist())
    hashes = [xxh64_intdigest(line[a:b], seed) for a, b in spans]
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SLICE_HASHES):
        part = np.array(hashes[at : at + SLICE_HASHES], "<u8")
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > k, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: str | None = None) -> DataFrame:
    """(doc_id, fp), and the column `carry`: whole texts, in place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py() or "") for t in batch.column(1)]
            signed = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed, *batch.columns[2:]], ["doc_id", "fp", *batch.schema.names[2:]])

    narrow = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"), *([F.col(f"`{carry}`")] if carry else []))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()), *narrow.schema.fields[2:]])
    return narrow.mapInArrow(work, schema)


# --- planning: groups of bits and their thresholds ---


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and the 64 x 64 table of how often two bits are set together, over all fingerprints."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            for at in range(0, len(bits), 1 << 16):
                part = bits[at : at + (1 << 16)]
                both += part.T @ part
            n += len(bits)
        rows, columns = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, rows * BITS + columns]), pa.array(np.r_[n, both[rows, columns].astype(np.int64)])],
            ["cell", "n"],
        )

    # A task gives its 2,081 sums, so this is small whatever the number of rows.
    summed = fps.select("fp").mapInArrow(work, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = {int(r["cell"]): int(r["n"]) for r in summed.collect()}
    table = np.zeros((BITS, BITS))
    for cell, n in cells.items():
        if cell >= 0:
            table[cell // BITS, cell % BITS] = table[cell % BITS, cell // BITS] = n
    return cells.get(-1, 0), table


def group_bits(rows: int, both: np.ndarray, groups: int) -> list[list[int]]:
    """Even-sized groups; each next bit goes with the bits it is most correlated with."""
    share = both / max(rows, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tie = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    left, out = set(range(BITS)), []
    for g in range(groups):
        size = len(left) // (groups - g)
        first = max(sorted(left), key=lambda b: tie[b, sorted(left)].sum())
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = max(sorted(left), key=lambda b: tie[b, group].mean())
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def distance_shares(p: np.ndarray, bits: list[int]) -> np.ndarray:
    """Share of pairs at each distance within a group, from how often each bit is set."""
    shares = np.array([1.0])
    for b in bits:
        differ = 2 * p[b] * (1 - p[b])
        shares = np.convolve(shares, [1 - differ, differ])
    return shares


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = total and the least cost; costs[i][t + 1] is group i's."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, more in enumerate(row[: total - used + 1]):
                if used + t not in step or cost + more < step[used + t][0]:
                    step[used + t] = (cost + more, [*chosen, t - 1])
        best = step
    return best[total]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def plan_groups(fps: DataFrame, threshold: int = THRESHOLD) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each group, for the number of groups that costs least.

    What meets at equal values is counted, over all fingerprints; wider thresholds
    are estimated from it by the bits' frequencies.
    """
    rows, both = bit_statistics(fps)
    p = np.diag(both) / max(rows, 1)
    layouts = {m: group_bits(rows, both, m) for m in range(2, MAX_GROUPS + 1)}
    flat = [(m, i, bits) for m, groups in layouts.items() for i, bits in enumerate(groups)]
    values = F.explode(
        F.array(*[F.struct(F.lit(at).alias("at"), F.col("fp").bitwiseAND(F.lit(signed(mask_of(b)))).alias("v")) for at, (_, _, b) in enumerate(flat)])
    )
    counts = fps.select(values.alias("x")).groupBy("x.at", "x.v").agg(F.count(F.lit(1)).cast("double").alias("c"))
    met = {int(r["at"]): float(r["pairs"]) for r in counts.groupBy("at").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs")).collect()}
    plans = []
    for m in layouts:
        costs = []
        for at, (owner, _, bits) in enumerate(flat):
            if owner != m:
                continue
            shares, row = distance_shares(p, bits), [0.0]
            for t in range(min(threshold, 2) + 1):
                probes = rows * sum(math.comb(len(bits), d) for d in range(t + 1))
                expected = met.get(at, 0.0) + rows**2 / 2 * shares[1 : t + 1].sum() * (t > 0)
                row.append(PROBE_COST * probes + CANDIDATE_COST * 2 * expected)
            costs.append(row)
        if (2 + min(threshold, 2)) * m >= threshold + 1:
            cost, chosen = allocate(costs, threshold + 1)
            plans.append((cost, [(bits, t) for bits, t in zip(layouts[m], chosen)]))
    return min(plans, key=lambda x: x[0])[1]


# --- probing ---


def file_places(fps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(part, place, fp, own): each fingerprint's own place in every probed group, and those within reach."""
    options: list[Column] = []
    for part, (bits, t) in enumerate(plan):
        if t < 0:
            continue
        value = F.col("fp").bitwiseAND(F.lit(signed(mask_of(bits))))
        flips = [signed(mask_of(list(c))) for d in range(t + 1) for c in combinations(bits, d)]
        options.append(_filed(part, value, flips))
    filed = fps.select("fp", F.explode(F.flatten(F.array(*options))).alias("x"))
    return filed.select("x.part", "x.place", "fp", "x.own")


def _filed(part: int, value: Column, flips: list[int]) -> Column:
    return F.transform(
        F.array(*map(F.lit, flips)),
        lambda f: F.struct(F.lit(part).alias("part"), value.bitwiseXOR(f).alias("place"), (f == 0).alias("own")),
    )


def part_hot_places(places: DataFrame, plan: list[tuple[list[int], int]], threshold: int, limit: int = HOT_PLACE) -> DataFrame:
    """Parts every place of more than `limit` fingerprints by the bits not used so far.

    Two fingerprints that meet and link differ in `threshold` of those bits at most, so they agree
    wholly in one of threshold + 1 sub-groups: each fingerprint is filed once per
    sub-group. Three levels leave some twenty free bits, which bounds a place by
    itself.
    """
    places = places.withColumn("sub", F.lit("")).withColumn("free", F.lit(0).cast("bigint"))
    masks = F.array(*[F.lit(signed(((1 << 64) - 1) ^ mask_of(bits))) for bits, _ in plan])
    places = places.withColumn("free", F.get(masks, F.col("part")))
    for _ in range(3):
        crowd = stored(
            places.groupBy("part", "place", "sub").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit), "simhash-hot"
        ).drop("_n")
        if crowd.isEmpty():
            break
        places = stored(places, "simhash-places")
        same = ["part", "place", "sub"]
        hot = places.join(crowd, same, "left_semi")
        cool = places.join(crowd, same, "left_anti")
        cuts = F.transform(F.sequence(F.lit(0), F.lit(threshold)), lambda i: _share_mask(F.col("free"), i, threshold + 1))
        split = hot.select("part", "place", "fp", "own", "sub", "free", F.posexplode(cuts).alias("i", "m")).select(
            "part", "place", "fp", "own",
            F.concat_ws("/", "sub", F.concat_ws(":", F.col("i").cast("string"), F.col("fp").bitwiseAND(F.col("m")).cast("string"))).alias("sub"),
            F.col("free").bitwiseAND(F.bitwise_not("m")).alias("free"),
        )
        places = cool.unionByName(split)
    return places


def _share_mask(free: Column, i: Column, parts: int) -> Column:
    """Every `parts`-th free bit, from the i-th."""
    start = F.struct(F.lit(0).cast("bigint").alias("m"), F.lit(0).alias("n"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        start,
        lambda s, b: F.when(
            F.call_function("shiftrightunsigned", free, b).bitwiseAND(F.lit(1)) == 1,
            F.struct(
                F.when(s["n"] % parts == i, s["m"].bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))).otherwise(s["m"]).alias("m"),
                (s["n"] + 1).alias("n"),
            ),
        ).otherwise(s),
    )["m"]


def spanning_links(fps: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints (unsigned, distinct) at `threshold` or less."""
    rest, out = fps, []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= threshold
            found = rest[near]
            if len(found):
                out.extend((int(x), int(y)) for y in found)
                queue.extend(found)
                rest = rest[~near]
    return out


def meet(places: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(a, b): spanning links of each place that holds an own fingerprint and another."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        held_own, held_key = False, None

        def close(out: list[tuple[int, int]]) -> None:
            if held_own and held:
                distinct = np.unique(np.concatenate(held))
                if len(distinct) > 1:
                    out.extend(spanning_links(distinct, threshold))

        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[tuple[int, int]] = []
            keys, fps, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fps = fps.view(np.uint64)
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            last = np.r_[first[1:], len(keys)]
            owned = np.logical_or.reduceat(own, first)
            edge = np.zeros(len(first), bool)
            edge[0] = edge[-1] = True
            for i in np.flatnonzero(edge | (owned & (last - first > 1))):
                a, b = first[i], last[i]
                if i == 0 and keys[a] != held_key or i > 0:
                    close(out)
                    held, held_own, held_key = [], False, keys[a]
                held.append(fps[a:b].copy())
                held_own |= bool(owned[i])
            if out:
                yield _links(out)
        out = []
        close(out)
        if out:
            yield _links(out)

    # One 64-bit name for a place; two places that share it are only verified together.
    named = places.select(F.xxhash64("part", "place", "sub").alias("at"), "fp", "own")
    sorted_places = named.repartition("at").sortWithinPartitions("at")
    return sorted_places.mapInArrow(work, "a bigint, b bigint").distinct()


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def fingerprint_classes(nodes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(fp, root) of stored `nodes`, one row a fingerprint: the class that each is in."""
    plan = plan_groups(nodes, threshold)
    places = part_hot_places(file_places(nodes, plan), plan, threshold)
    classes = connected_components(stored(meet(places, threshold), "simhash-links"))
    return nodes.select("fp").join(classes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, fp, component_id): a row per row of `docs`."""
    marked = stored(fingerprints(docs, key, text), "simhash")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    rooted = nodes.join(fingerprint_classes(nodes, threshold), "fp")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(lowest, "root").select("fp", "component_id"), "simhash-classes")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Exactly one row of each class, same columns.

    It is the row with the smallest id (null ids last), then the smallest digest of its columns; of equal rows one. So rows
    that share an id and differ are told apart, and none goes but for a class of its own.
    """
    content = content_digest(docs)
    row = F.struct(F.col(f"`{key}`").isNull().alias("unnamed"), F.col(f"`{key}`").cast("bigint").alias("id"), content.alias("content"))
    made = fingerprints(docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), row.alias("row")), carry="row")
    marked = stored(made.select("fp", "row"), "simhash-rows")
    nodes = stored(marked.groupBy("fp").agg(F.min("row").alias("first")), "simhash-nodes")
    rooted = nodes.join(fingerprint_classes(nodes, threshold), "fp")
    winners = rooted.groupBy("root").agg(F.min("first").alias("winner"))
    named = stored(rooted.join(winners, "root").select("fp", "winner"), "simhash-winners")
    # Rows are known by id and content from here on; those that go, and those that stand several times, are the fewer.
    told = stored(marked.join(named, "fp").select("row.id", "row.content", (F.col("row") == F.col("winner")).alias("stays")), "simhash-told")
    gone = settle(told.filter("NOT stays").select("id", "content").distinct(), "simhash-gone")
    repeated = settle(told.filter("stays").groupBy("id", "content").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", "content"), "simhash-repeated")
    keyed = docs.withColumns({"id_": F.col(f"`{key}`").cast("bigint"), "content_": content})
    on, renamed = ["id_", "content_"], lambda t: Settled(t.df.toDF("id_", "content_"), t.rows, t.nbytes)
    left = lookup_join(keyed, renamed(gone), on, on, how="left_anti", null_safe=True)
    names = [F.col(f"`{c}`") for c in docs.columns]
    if not repeated.rows:
        return left.select(*names)
    single = lookup_join(left, renamed(repeated), on, on, how="left_anti", null_safe=True)
    several = lookup_join(left, renamed(repeated), on, on, how="left_semi", null_safe=True)
    return single.select(*names).unionByName(several.dropDuplicates(on).select(*names))
