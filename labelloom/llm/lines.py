"""Line dedup by a segment-partition edit join.

Only DataFrame functions are used. A line goes when an earlier line (by document
id, then place in the document) is equal to it, or near it. Near lines share a class: short ones differ by at most 1 edit of
code points, longer ones by 2, and lines of 12 words or more also by one word, whatever its length
(`CLASSES`; the bounds overlap, so that two near lines have a class in common). Lines below all classes are compared for equality only, and
lines without a visible sign always stay.

Different lines are joined as follows. A line of n units (code points, or words) is split into threshold + 1
even segments; a line within the threshold holds at least one of them unchanged, near its
place. Every line is filed under (class, n, segment number, segment) and probes, for each length
in reach, the few substrings that the multi-match-aware rule allows. Keys under which two different lines meet are found
in one sorted pass (Spark spills a key's rows); only lines on such keys go on.

A line needs one earlier witness, so no pairs are made. Each line of a key is verified against the key's earliest lines
first, which settles groups of near copies. What is left asks blocks of at most about `BLOCK_LINES` lines of its keys, and stops at the first
witness in a block. Verification compares sign parities (an edit changes two at
most) and then takes a banded bit-parallel edit distance: one small bit vector of diagonals for each number of edits.

Null texts are empty and stay null. Rows that share an id and differ in text are versions of one document and
keep equal lines at equal places; equal rows keep the same lines. Null ids come last; each different text without
an id is a document of its own, in the order of a hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.common import stored
from labelloom.plans.joins import lookup_join
from labelloom.plans.shared import settle

LINE_NUMBERS = 2**31
BLOCK_LINES = 64
BLANKS = " \t\n\x0b\x0c\r"
ANY = 2**31 - 1
# The last bits of a key tell its class.
KINDS = 8


@dataclass(frozen=True)
class LineClass:
    """Lines of `least` to `most` units (and at most `most_words` words) are near at `threshold` edits of units or fewer."""

    unit: str
    threshold: int
    least: int
    most: int = ANY
    most_words: int = ANY

    def __post_init__(self):
        if self.unit not in ("signs", "words") or self.least <= self.threshold:
            raise ValueError(f"{self}: units are signs or words, and a line has more of them than edits")


CLASSES = (LineClass("signs", 1, 8, most=33), LineClass("signs", 2, 32), LineClass("words", 1, 12))


def is_visible(line: Column) -> Column:
    """Whether a line has a sign that is no blank; it is read up to there only."""
    return F.ltrim(line, F.lit(BLANKS)) != ""


def document_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, version, line_no, place, line): visible lines with their place in the order of the corpus."""
    col = F.col(f"`{text}`")
    parts = docs.select(
        F.col(f"`{key}`").cast("bigint").alias("doc"), F.xxhash64(col).alias("version"), F.posexplode(F.split(col, "\n")).alias("line_no", "line")
    ).filter(is_visible(F.col("line")))
    # Texts without an id follow all ids, by their hash.
    unnamed = F.lit(str(2**64)).cast("decimal(20,0)") + F.col("version").cast("decimal(20,0)")
    order = F.coalesce(F.col("doc").cast("decimal(20,0)"), unnamed).cast("decimal(21,0)") * F.lit(LINE_NUMBERS).cast("decimal(10,0)")
    return parts.withColumn("place", (order + F.col("line_no").cast("decimal(10,0)")).cast("decimal(38,0)"))


def line_key(line: Column | str) -> Column:
    return F.unhex(F.md5(F.col(line) if isinstance(line, str) else line))


def line_hash(line: Column | str) -> Column:
    """A line's hash, which leaves one bit of a number free."""
    return F.shiftright(F.xxhash64(line), 1)


def _segment(n: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Start (from 0) and size of segment i of a line of length n."""
    sizes = [F.floor((n + j) / parts).cast("int") for j in range(i + 1)]
    return sum(sizes[:i], F.lit(0)), sizes[i]


def probes(threshold: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift) of all substrings that a line looks up."""
    out = []
    for less in range(threshold + 1):
        for i in range(threshold + 1):
            low, high = max(-i, less - (threshold - i)), min(i, less + (threshold - i))
            out += [(less, i, shift) for shift in range(low, high + 1)]
    return out


def words_of(line: Column | str) -> Column:
    return F.split(line, " ")


def _first_words(line: Column, n: Column) -> Column:
    """The first `n` words, or the last -`n`."""
    return F.call_function("substring_index", line, F.lit(" "), n)


def _words_between(line: Column, at: Column, size: Column) -> Column:
    """`size` words from word `at` (from 1) on."""
    return _first_words(_first_words(line, at + size - 1), -size)


def probe_keys(lines: DataFrame, kind: int, c: LineClass) -> DataFrame:
    """(key, line): what the lines of a class are filed under and look for; `line` is 2 h + 1 where filed, else 2 h.

    A row of two numbers, since there are many for each line and all are shuffled.
    """
    line = F.col("line")
    words = F.octet_length("line") - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    sized = lines.select("h", "line", (F.length("line") if c.unit == "signs" else words).alias("n"))
    inside = (F.col("n") >= c.least) & (F.col("n") <= c.most) & (words <= c.most_words if c.most_words < ANY else F.lit(True))
    options = []
    for less, i, shift in probes(c.threshold):
        m = F.col("n") - less
        start, size = _segment(m, i, c.threshold + 1)
        at = start + (shift + 1)
        if c.least <= 2 * c.threshold:
            # Of very short lines a segment can be empty, and a probe begin before the line.
            at = F.greatest(at, F.lit(1))
        if c.unit == "signs":
            part = F.substring("line", at, size)
        elif i == 0 and shift == 0 or i == c.threshold and shift == less:
            # A segment at the start or the end of the line.
            part = _first_words(line, size if i == 0 else -size)
        else:
            part = _words_between(line, at, size)
        # Looked for below the class's bound, a key finds nothing.
        key = F.xxhash64(F.lit(kind), m, F.lit(i), part).bitwiseAND(F.lit(-KINDS).cast("bigint")).bitwiseOR(F.lit(kind).cast("bigint"))
        filed = F.lit(int(less == 0 and shift == 0)).cast("bigint")
        options.append(F.struct(key.alias("key"), F.shiftleft("h", 1).bitwiseOR(filed).alias("line")))
    return sized.filter(inside).select(F.inline(F.array(*options)))


def meeting_keys(lines: DataFrame, classes: tuple[LineClass, ...] = CLASSES) -> DataFrame:
    """(key, own, kind, h) of `lines(h, line)`: the keys under which different lines meet, one of them filed there.

    `h` is a `line_hash`.
    """
    if len(classes) > KINDS:
        raise ValueError(f"{len(classes)} classes; at most {KINDS} are possible")
    # A plan for each class, so that the code of none grows beyond what is compiled.
    filed = reduce(DataFrame.unionByName, [probe_keys(lines, kind, c) for kind, c in enumerate(classes)])
    same = Window.partitionBy("key")
    own, h = F.col("line").bitwiseAND(F.lit(1).cast("bigint")) == 1, F.shiftright("line", 1)
    met = filed.select("*", F.min("line").over(same).alias("low"), F.max("line").over(same).alias("high"), F.max(own).over(same).alias("any"))
    kind = F.col("key").bitwiseAND(F.lit(KINDS - 1).cast("bigint")).cast("tinyint").alias("kind")
    return met.filter(F.col("any") & (F.shiftright("low", 1) < F.shiftright("high", 1))).select("key", own.alias("own"), kind, h.alias("h"))


def parity(line: Column) -> Column:
    """Bit c is set when an odd number of the line's signs fall in class c of 64."""
    one = F.lit(1).cast("bigint")
    return F.aggregate(
        F.split(line, ""),
        F.lit(0).cast("bigint"),
        lambda s, c: s.bitwiseXOR(F.call_function("shiftleft", one, F.pmod(F.ascii(c), F.lit(64)))),
    )


def common_start(a: Column, b: Column) -> Column:
    """Length of the longest common prefix, by bisection."""
    most = F.least(F.length(a), F.length(b))
    rounds = F.ceil(F.log2(most + 2.0)).cast("int")

    def halve(s: Column, _: Column) -> Column:
        middle = ((s["low"] + s["high"] + 1) / 2).cast("int")
        same = F.substring(a, F.lit(1), middle) == F.substring(b, F.lit(1), middle)
        return F.struct(
            F.when(same, middle).otherwise(s["low"]).alias("low"), F.when(same, s["high"]).otherwise(middle - 1).alias("high")
        )

    return F.aggregate(F.sequence(F.lit(0), rounds), F.struct(F.lit(0).alias("low"), most.alias("high")), halve)["low"]


def differing_parts(a: Column, b: Column) -> Column:
    """Struct (a, b) of both texts without their common start and end, which leaves their distance as it is."""

    def over(v: Column) -> Column:
        at = common_start(v["a"], v["b"])
        rest = F.struct(F.substring(v["a"], at + 1, F.length(v["a"])).alias("a"), F.substring(v["b"], at + 1, F.length(v["b"])).alias("b"))
        return _bound(rest, without_end)

    def without_end(v: Column) -> Column:
        end = common_start(F.reverse(v["a"]), F.reverse(v["b"]))
        return F.struct(*[F.substring(v[n], F.lit(1), F.length(v[n]) - end).alias(n) for n in ("a", "b")])

    return _bound(F.struct(a.alias("a"), b.alias("b")), over)


def edit_distance(a: Column, b: Column, threshold: int) -> Column:
    """Edits of code points between two texts, or null when there are more than `threshold`."""
    return unit_edits(_signs(a), _signs(b), threshold)


def unit_edits(a: Column, b: Column, threshold: int) -> Column:
    """Edits between two arrays of units, or null when there are more than `threshold`.

    Bit d of vector e says that the first j signs of b and the first j + d - threshold of a
    are at most e edits apart. The vectors lie side by side in one number. A step of j keeps a diagonal
    where the next signs agree, and takes from the vector of one edit less: the same diagonal
    (another sign), the one above (a sign of b more) and the one below (a sign of a more).
    """
    width = 2 * threshold + 1
    lane = width + 1
    band = sum(((1 << width) - 1) << (lane * e) for e in range(threshold + 1))
    spread = sum(1 << (lane * e) for e in range(threshold + 1))
    # Vector e at the start: the first d signs of a cost d edits.
    start = sum(1 << (lane * e + threshold + d) for e in range(threshold + 1) for d in range(e + 1))
    big = lambda n: F.lit(n).cast("bigint")

    def over(v: Column) -> Column:
        def agreeing(sign: Column, j: Column) -> Column:
            marks = [F.when(F.get(v["a"], j + (d - threshold)) == sign, big(spread << d)).otherwise(big(0)) for d in range(width)]
            return reduce(lambda x, y: x.bitwiseOR(y), marks)

        def step(s: Column, agree: Column) -> Column:
            less = F.call_function("shiftleft", s, F.lit(lane))
            return closed(
                s.bitwiseAND(agree).bitwiseOR(less).bitwiseOR(F.call_function("shiftright", less, F.lit(1))).bitwiseAND(big(band))
            )

        def closed(s: Column) -> Column:
            # A sign of a more, within the same step; once for every edit.
            for _ in range(threshold):
                s = _bound(s, lambda x: x.bitwiseOR(F.call_function("shiftleft", x, F.lit(lane + 1))).bitwiseAND(big(band)))
            return s

        last = F.aggregate(F.transform(v["b"], agreeing), big(start), step)
        end = F.size(v["a"]) - F.size(v["b"]) + threshold

        def fewest(x: Column) -> Column:
            reached = F.when((end < 0) | (end >= width), F.lit(None).cast("int"))
            for e in range(threshold + 1):
                hit = F.call_function("shiftright", x, F.greatest(end, F.lit(0)) + e * lane).bitwiseAND(big(1)) == 1
                reached = reached.when(hit, F.lit(e))
            return reached

        return _bound(last, fewest)

    return _bound(F.struct(a.alias("a"), b.alias("b")), over)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _signs(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def _sign_edits(a: Column, b: Column, threshold: int) -> Column:
    return _bound(differing_parts(a, b), lambda x: edit_distance(x["a"], x["b"], threshold))


def are_near(a: Column, b: Column, kind: Column, classes: tuple[LineClass, ...]) -> Column:
    """Whether two lines (structs with line and signs) of a class are near."""
    out = F.lit(False)
    for number, c in enumerate(classes):
        if c.unit == "signs":
            close = (F.abs(F.length(a["line"]) - F.length(b["line"])) <= c.threshold) & (
                F.bit_count(a["signs"].bitwiseXOR(b["signs"])) <= 2 * c.threshold
            )
            edits = _sign_edits(a["line"], b["line"], c.threshold)
        else:
            close = F.abs(F.size(words_of(a["line"])) - F.size(words_of(b["line"]))) <= c.threshold
            edits = unit_edits(words_of(a["line"]), words_of(b["line"]), c.threshold)
        # The distance is taken only where the cheap bounds allow it.
        out = F.when(kind == number, F.when(close, edits.isNotNull()).otherwise(False)).otherwise(out)
    return out


def near_lines(distinct: DataFrame, classes: tuple[LineClass, ...] = CLASSES) -> DataFrame:
    """(key): lines of `distinct(key, h, line, place)` that come after a line near them."""
    met = stored(meeting_keys(distinct.select("h", "line"), classes).withColumnRenamed("key", "at"), "line-keys")
    held = settle(met.select("h").distinct(), "line-held")
    texts = lookup_join(distinct, held, ["h"], ["h"], how="left_semi").select("h", "key", "place", "line", parity(F.col("line")).alias("signs"))
    one = F.struct("place", "own", "h", "line", "signs")
    entries = stored(met.join(stored(texts, "line-texts"), "h").select("at", "kind", "key", one.alias("me")), "line-entries")
    # Of each key the earliest line that is filed there, and the earliest of all that look there.
    earliest = entries.groupBy("at").agg(
        F.min_by(F.when(F.col("me.own"), F.col("me")), F.when(F.col("me.own"), F.col("me.place"))).alias("filed"),
        F.min_by("me", "me.place").alias("first"),
        F.count(F.lit(1)).alias("n"),
    )

    def witness(me: Column, other: Column) -> Column:
        """Whether `other` comes before `me`, meets it (one of the two is filed there), and is near."""
        meets = (other["place"] < me["place"]) & (other["h"] != me["h"]) & (other["own"] | me["own"])
        return F.when(meets, are_near(me, other, F.col("kind"), classes)).otherwise(False)

    me = F.col("me")
    # Few bytes but much work: many tasks, whatever the size suggests.
    asked = lookup_join(entries, settle(earliest, "line-earliest"), ["at"], ["key"]).repartition("at", "key")
    both = F.when(F.col("filed.h") == F.col("first.h"), F.array("filed")).otherwise(F.array("filed", "first"))
    told = stored(asked.withColumn("near", F.exists(both, lambda x: witness(me, x))).drop("filed", "first"), "line-told")
    done = settle(told.filter("near").select("key").distinct(), "line-done")
    left = lookup_join(told.filter("NOT near AND n > 2").drop("near"), done, ["key"], ["key"], how="left_anti")
    seekers = settle(left, "line-seekers")
    if not seekers.rows:
        return done.df
    blocks = F.ceil(F.col("n") / BLOCK_LINES).cast("int")
    open_keys = settle(seekers.df.select("at", "n").distinct(), "line-open")
    members = lookup_join(entries, open_keys, ["at"], ["key"], how="inner").withColumn("block", F.pmod(F.xxhash64("me.h"), blocks).cast("int"))
    listed = members.groupBy("at", "block").agg(F.collect_list("me").alias("others"))
    spread = seekers.df.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).repartition("at", "block", "key")
    met_blocks = lookup_join(spread, settle(listed, "line-blocks"), ["at", "block"], ["key"], how="inner")
    found = met_blocks.filter(F.exists("others", lambda x: witness(me, x))).select("key")
    return done.df.unionByName(found).distinct()


def line_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", classes: tuple[LineClass, ...] = CLASSES) -> DataFrame:
    """(row, text, n_lines, n_equal, n_near): each row of `docs` as it was, its new text, and its visible lines and losses."""
    seen = document_lines(docs, key, text)
    counted = seen.groupBy("line").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))
    distinct = stored(counted.select(line_key("line").alias("key"), line_hash("line").alias("h"), "line", "place", "n"), "lines")
    near = stored(near_lines(distinct, classes), "line-near").withColumn("near", F.lit(True))
    repeated = distinct.select("key", "place", "n").join(near, "key", "left").withColumn("near", F.coalesce("near", F.lit(False)))
    gone = settle(repeated.filter("near OR n > 1").select("key", F.col("place").alias("first"), "near"), "line-gone")
    places = seen.select("doc", "version", "line_no", "place", line_key("line").alias("key"))
    hit = lookup_join(places, gone, ["key"], ["doc", "line_no"], how="inner").withColumn("equal", F.col("place") > F.col("first"))
    by_doc = hit.filter("near OR equal").groupBy("doc", "version").agg(
        F.collect_set("line_no").alias("_out"),
        F.count_if("equal").cast("bigint").alias("_equal"),
        F.count_if(~F.col("equal")).cast("bigint").alias("_near"),
    )
    listed = settle(by_doc, "line-lists")
    col, zero = F.col(f"`{text}`"), F.lit(0).cast("bigint")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{key}`").cast("bigint").alias("doc"),
        F.xxhash64(col).alias("version"),
        col.alias("text"),
    )
    joined = lookup_join(keyed, listed, ["doc", "version"], ["doc", "version"], null_safe=True).withColumn("_lines", F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_out"))
    rebuilt = F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")
    visible = F.coalesce(F.size(F.filter("_lines", is_visible)), F.lit(0))
    return joined.select(
        "row",
        F.when(F.col("_out").isNull(), F.col("text")).otherwise(rebuilt).alias("text"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(visible).cast("bigint").alias("n_lines"),
        F.coalesce("_equal", zero).alias("n_equal"),
        F.coalesce("_near", zero).alias("n_near"),
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", drop_emptied: bool = True, **options) -> DataFrame:
    """`docs` without its repeated lines, same columns.

    With `drop_emptied`, a document goes when every visible line of it repeats earlier ones.
    """
    found = line_counts(docs, key, text, **options)
    if drop_emptied:
        found = found.filter((F.col("n_lines") == 0) | (F.col("n_equal") + F.col("n_near") < F.col("n_lines")))
    return found.select(*[(F.col("text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
