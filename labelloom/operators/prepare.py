"""From raw labelled rows to two-message conversations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions import fixed_values as V
from labelloom.functions.hashing import DEFAULT_SEED
from labelloom.functions.text import build_prompt, clean_text, coerce_text
from labelloom.operators.split import cap_cuts, check_strata, split_cuts, train_vocabulary
from labelloom.plans.ordering import content_digest
from labelloom.plans.shared import settle
from labelloom.schemas import LABEL_COLUMN, TEXT_COLUMN


def check_columns(df: DataFrame, *required: str) -> DataFrame:
    """Fail before any job when a required column is absent."""
    for name in required:
        if name not in df.columns:
            raise ValueError(f"Column '{name}' not found. Available columns: {df.columns}")
    return df


def cleaned(df: DataFrame, text_col: str) -> Column:
    """Cleaned text for string columns; the plain string form for any other type."""
    is_text = isinstance(df.schema[text_col].dataType, T.StringType)
    return clean_text(F.col(text_col)) if is_text else coerce_text(F.col(text_col))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def to_messages(df: DataFrame, text_col: str = TEXT_COLUMN, label_col: str = LABEL_COLUMN) -> DataFrame:
    """Append `messages`: the user prompt and the label as the assistant's answer."""
    conversation = F.array(
        message("user", build_prompt(cleaned(df, text_col))),
        message("assistant", F.col(label_col).cast("string")),
    )
    return df.withColumn("messages", conversation)


def project_messages(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, "messages")


def filter_valid(df: DataFrame) -> DataFrame:
    """Keep conversations of exactly two messages."""
    return df.filter(F.size("messages") == 2)


def pair_turns(turns: DataFrame, key: str, turn: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """Two-message conversations from a table of turns.

    Only the count, the first and the last turn of a key are aggregated, so a key
    with any number of turns costs constant state and is dropped if it has not two.
    """
    entry = F.struct(turn, F.struct(F.col(role).alias("role"), F.col(content).alias("content")).alias("m"))
    return (
        turns.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(entry).alias("_first"), F.max(entry).alias("_last"))
        .filter(F.col("_n") == 2)
        .select(key, F.array("_first.m", "_last.m").alias("messages"))
    )


def prompt_and_label(df: DataFrame) -> DataFrame:
    """Prompt and true label by position; null where a conversation is too short."""
    return df.withColumn("prompt", F.get("messages", F.lit(0))["content"]).withColumn(
        "true_label", F.get("messages", F.lit(1))["content"]
    )


def role_contents(df: DataFrame, role: str = "assistant") -> DataFrame:
    """One row per message of `role`, with its content."""
    chosen = F.filter("messages", lambda m: m["role"] == role)
    return df.withColumn("_m", F.explode(chosen)).withColumn("content", F.col("_m.content")).drop("_m", "messages")


@dataclass(frozen=True)
class Prepared:
    """`conversations` has (row key, split, messages); `vocabulary` has (idx, category)."""

    conversations: DataFrame
    vocabulary: DataFrame


def prepare(
    df: DataFrame,
    text_col: str = TEXT_COLUMN,
    label_col: str = LABEL_COLUMN,
    test: float = V.TEST_FRACTION,
    val: float = V.VALIDATION_FRACTION,
    cap: int | None = None,
    key: str | None = None,
    group_key: str | None = None,
    seed: int = DEFAULT_SEED,
) -> Prepared:
    """Check, split, cap and format raw rows; collect the training vocabulary.

    Without `key`, rows are known by a digest of their content, as `row_id`; equal rows share it, and are shared out as quotas and cap
    ask. The source is read twice: once for a narrow table of
    keys and labels, from which split, cap and vocabulary are decided, once for the texts.
    """
    check_columns(df, text_col, label_col)
    repeats = key is None
    if key is None:
        df, key = df.withColumn("row_id", content_digest(df)), "row_id"
    names = list(dict.fromkeys([key, label_col, *([group_key] if group_key else [])]))
    narrow = settle(df.select(*names), "labels").df
    check_strata(narrow, label_col, test, val, group_key)
    splits = split_cuts(narrow, label_col, key, test, val, group_key=group_key, seed=seed, repeats=repeats)
    marked, parts = splits.mark(narrow), splits.mark(df)
    if cap:
        caps = cap_cuts(marked, key, cap, seed, repeats)
        marked, parts = caps.keep(marked), caps.keep(parts)
    # `to_messages` builds exactly two messages, so there is nothing for `filter_valid` to drop here.
    conversations = project_messages(to_messages(parts, text_col, label_col), key, "split")
    return Prepared(conversations, train_vocabulary(marked, label_col))


def settle_prepared(prepared: Prepared) -> Prepared:
    """Write both frames once when several jobs will read them."""
    return Prepared(
        settle(prepared.conversations, "conversations").df, settle(prepared.vocabulary, "vocabulary").df
    )


def preparation_metrics(prepared: Prepared) -> DataFrame:
    """(key, value) rows: samples per split, and `num_unique_categories` of the training part."""
    sizes = prepared.conversations.groupBy(F.concat("split", F.lit("_sample_count")).alias("key")).agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )
    labels = prepared.vocabulary.agg(F.count(F.lit(1)).cast("double").alias("value"))
    return sizes.unionByName(labels.withColumn("key", F.lit("num_unique_categories")))
