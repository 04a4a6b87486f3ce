"""Labelled text from templates.

Each text is a pure function of (category, template, variation, seed), computed
row by row; nothing but the quota step compares rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions import fixed_values as V
from labelloom.functions.hashing import DEFAULT_SEED, chance, digest, draw, pick, row_key
from labelloom.functions.text import replace_first, split_sentences, strip
from labelloom.plans.joins import lookup_join
from labelloom.plans.ordering import keep_first, number_rows
from labelloom.plans.shared import settle
from labelloom.schemas import LABEL_COLUMN, TEXT_COLUMN


def category_frame(spark: SparkSession, categories: list[str]) -> DataFrame:
    return spark.createDataFrame([(c,) for c in categories], "category string")


def skill_frame(spark: SparkSession, skills: dict[str, list[str]]) -> DataFrame:
    """One row per category with its skill list."""
    return spark.createDataFrame(list(skills.items()), "category string, skills array<string>")


def variation_plan(templates: DataFrame, categories: DataFrame, n: int) -> DataFrame:
    """Variations per template so that each category yields at least `n` texts."""
    counts = templates.groupBy("category").agg(F.count(F.lit(1)).alias("n_templates"))
    plan = lookup_join(categories, settle(counts, "template-counts"), ["category"], ["category"])
    have = F.coalesce("n_templates", F.lit(0).cast("bigint"))
    each = F.when(have > 0, F.floor(F.lit(n) / have) + 1).otherwise(F.lit(n)).cast("bigint")
    return plan.select("category", have.alias("n_templates"), each.alias("variations"))


def expand(templates: DataFrame, plan: DataFrame, key: str = "template_idx") -> DataFrame:
    """One row per template and variation."""
    wanted = plan.filter(F.col("n_templates") > 0).select("category", "variations")
    planned = lookup_join(templates, settle(wanted, "plan"), ["category"], [key], how="inner")
    return planned.withColumn(
        "variation", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("variations") - 1))
    ).drop("variations")


def generic_fallback(plan: DataFrame, n: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """`n` generic texts for each category without templates: (category, template_idx, variation, text)."""
    before, middle, between, after = V.GENERIC_TEXT.split("{category}")
    body = F.concat(
        F.lit(before), F.col("category"), F.lit(middle), F.col("category"),
        F.lit(between), F.col("category"), F.lit(after),
    )
    # A sequence down to -1 would count backwards.
    numbered = plan.filter((F.col("n_templates") == 0) & F.lit(n > 0)).withColumn(
        "variation", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(n, 1) - 1).cast("bigint")))
    )
    reference = 1000 + draw(row_key("category", "variation"), "reference", seed) % 9000
    text = F.concat(body, F.format_string(" (Ref: GenericJD%d-%d)", F.col("variation"), reference))
    return numbered.select("category", F.lit(-1).cast("bigint").alias("template_idx"), "variation", text.alias("text"))


def insert_skill(text: Column, skill: Column) -> Column:
    """Work `skill` into a text that lacks it; the text unchanged when `skill` is null."""
    lacks = ~F.contains(text, skill)
    return (
        F.when(skill.isNull() | ~lacks, text)
        .when(
            F.contains(text, F.lit("Experience with")),
            replace_first(text, "Experience with", F.concat(F.lit("Experience with "), skill, F.lit(" and"))),
        )
        .when(
            F.contains(F.lower(text), F.lit("skills")),
            replace_first(text, "skills", F.concat(F.lit("skills including "), skill)),
        )
        .otherwise(F.concat(text, F.lit(" Proficiency in "), skill, F.lit(" is beneficial.")))
    )


def _choice(values: list[str], key: Column, salt: str, seed: int) -> Column:
    return pick(F.array(*[F.lit(v) for v in values]), key, salt, seed)


def prefix_context(sentences: Column, category: Column, key: Column, seed: int = DEFAULT_SEED) -> Column:
    """Put a company, a seniority or a bare verb before the first sentence."""
    verb = _choice(V.ACTION_VERBS, key, "verb", seed)
    company = _choice(V.COMPANY_TYPES, key, "company", seed)
    seniority = _choice(V.SENIORITY_HINTS, key, "seniority", seed)
    kind = draw(key, "prefix kind", seed) % 3
    first = F.get(sentences, F.lit(0))
    opened = (
        F.when(kind == 0, F.concat(F.lit("Join "), company, F.lit(". "), verb, F.lit(" "), first))
        .when(kind == 1, F.concat(verb, F.lit(" "), seniority, F.lit(" "), category, F.lit(". "), first))
        .otherwise(F.concat(verb, F.lit(" "), first))
    )
    rest = F.slice(sentences, F.lit(2), F.greatest(F.size(sentences) - 1, F.lit(0)))
    return F.concat(F.array(opened), rest)


def shuffle_middle(sentences: Column, key: Column, seed: int = DEFAULT_SEED) -> Column:
    """Permute all sentences but the first and the last."""
    count = F.size(sentences)
    middle = F.slice(sentences, F.lit(2), F.greatest(count - 2, F.lit(0)))
    keyed = F.transform(
        middle,
        lambda x, i: F.struct(digest(row_key(key, i), "shuffle order", seed).alias("d"), i.alias("i"), x.alias("x")),
    )
    permuted = F.transform(F.array_sort(keyed), lambda e: e["x"])
    ends = F.slice(sentences, F.lit(1), F.lit(1)), F.slice(sentences, count, F.lit(1))
    return F.when(count > 2, F.concat(ends[0], permuted, ends[1])).otherwise(sentences)


def unique_suffix(text: Column, key: Column, seed: int = DEFAULT_SEED) -> Column:
    number = 10000 + draw(key, "job id", seed) % 90000
    return F.concat(strip(text), F.lit(" (Job ID: "), number.cast("string"), F.lit(")"))


def vary(
    expanded: DataFrame, skills: DataFrame, key: str, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Append `text`, the finished variation of each (category, template, variation) row.

    Prefixing and shuffling start from the template's own sentences, so whenever
    one of them fires the inserted skill is lost.
    """
    rows = lookup_join(expanded, skills, ["category"], [key])
    k = F.col(key)
    rows = rows.withColumn("_sentences", split_sentences(F.col("template")))
    skilled = F.when(
        chance(k, "skill", V.SKILL_PROBABILITY, seed),
        insert_skill(F.col("template"), pick(F.col("skills"), k, "skill choice", seed)),
    ).otherwise(F.col("template"))
    prefixed = chance(k, "prefix", V.PREFIX_PROBABILITY, seed)
    rows = rows.withColumn(
        "_sentences",
        F.when(prefixed, prefix_context(F.col("_sentences"), F.col("category"), k, seed)).otherwise(
            F.col("_sentences")
        ),
    )
    shuffled = (F.size("_sentences") > 2) & chance(k, "shuffle", V.SHUFFLE_PROBABILITY, seed)
    body = (
        F.when(shuffled, F.array_join(shuffle_middle(F.col("_sentences"), k, seed), ". "))
        .when(prefixed, F.array_join("_sentences", ". "))
        .otherwise(skilled)
    )
    return rows.withColumn("text", unique_suffix(body, k, seed)).drop("_sentences", "skills")


def base_texts(
    templates: DataFrame, categories: DataFrame, skills: DataFrame, n: int, seed: int = DEFAULT_SEED
) -> DataFrame:
    """(text_key, category, text): the first `n` texts of each category in seeded order.

    The quota is taken on the keys, before any text is made.
    """
    key = row_key("category", "template_idx", "variation")
    plan = settle(variation_plan(templates, categories, n), "plan").df
    expanded = expand(templates, plan).withColumn("text_key", key)
    chosen = keep_first(expanded, ["category"], n, "text_key", "quota", seed)
    varied = vary(chosen, skills, "text_key", seed)
    generic = generic_fallback(plan, n, seed).withColumn("text_key", key)
    columns = ["text_key", "category", "text"]
    return varied.select(*columns).unionByName(generic.select(*columns))


def language_rows(base: DataFrame, languages: list[str]) -> DataFrame:
    """One copy of every base text per target language (a parallel corpus)."""
    return base.withColumn("source_language", F.lit(V.SOURCE_LANGUAGE)).withColumn(
        "target_language", F.explode(F.array(*[F.lit(x) for x in languages]))
    )


def generation_counts(rows: DataFrame, plan: DataFrame, languages: list[str], n: int) -> DataFrame:
    """Rows per category and language, and how many are missing from the target."""
    made = rows.groupBy("category", "target_language").agg(F.count(F.lit(1)).alias("generated"))
    wanted = language_rows(plan.select("category"), languages).drop("source_language")
    have = F.coalesce("generated", F.lit(0).cast("bigint"))
    counted = lookup_join(
        wanted, settle(made, "generated"), ["category", "target_language"], ["category", "target_language"]
    )
    return counted.select(
        "category", "target_language", have.alias("generated"),
        F.greatest(F.lit(n) - have, F.lit(0).cast("bigint")).cast("bigint").alias("shortfall"),
    )


def global_shuffle(rows: DataFrame, key: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """All rows in one seeded random order (a range-partitioned sort)."""
    return rows.orderBy(digest(key, "global shuffle", seed), key)


def numbered_shuffle(rows: DataFrame, key: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """The same order made explicit as `shuffle_position`."""
    return number_rows(rows, [digest(key, "global shuffle", seed), key], "shuffle_position")


@dataclass(frozen=True)
class Generated:
    """Shuffled raw `rows`, and the translation `statistics` and `errors` of the run that made them."""

    rows: DataFrame
    statistics: DataFrame
    errors: DataFrame


def generate_raw(*args, **options) -> DataFrame:
    """The rows of `generate_run`."""
    return generate_run(*args, **options).rows


def generate_run(
    templates: DataFrame,
    categories: DataFrame,
    languages: list[str] | None = None,
    n: int = V.TEMPLATE_ROWS_PER_LANGUAGE,
    skills: dict[str, list[str]] | None = None,
    translate=None,
    seed: int = DEFAULT_SEED,
) -> Generated:
    """Shuffled raw rows (text, label, source and target language) and what became of the translations.

    Translated rows are written once before they are sorted or counted, so a client is
    called once per foreign row.

    `translate` maps a frame of (row_key, text, target_language, ...) rows to the same
    frame with `text` translated or marked; without it foreign rows are marked as
    having no client.
    """
    from labelloom.operators.translate import error_histogram, mark_failures, no_client, translation_stats

    spark = templates.sparkSession
    skill_lists = skill_frame(spark, V.SKILLS if skills is None else skills)
    base = settle(base_texts(templates, categories, skill_lists, n, seed), "base-texts").df
    rows = language_rows(base, languages or V.LANGUAGES)
    rows = rows.withColumn("row_key", row_key("text_key", "target_language"))
    translated = settle((translate or no_client)(rows), "translated").df
    shuffled = global_shuffle(mark_failures(translated), "row_key", seed).select(
        F.col("text").alias(TEXT_COLUMN),
        F.col("category").alias(LABEL_COLUMN),
        "source_language",
        "target_language",
    )
    return Generated(shuffled, translation_stats(translated), error_histogram(translated))
