"""Text rules as Column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelloom.functions import fixed_values as V


def strip(text: Column) -> Column:
    """Trim Unicode whitespace at both ends."""
    return F.btrim(text, F.lit(V.WHITESPACE))


def squeeze(text: Column) -> Column:
    """Every whitespace run becomes one blank; none at the ends.

    The main pattern passes over single blanks, which need no change, and sees
    Latin-1 whitespace only; the few texts that may hold other whitespace have it
    turned into blanks first.
    """
    ws = V.NARROW_SPACE
    maybe_wide = F.rlike(text, F.lit(V.WIDE_SPACE_RANGE))
    unified = F.when(maybe_wide, F.regexp_replace(text, V.WIDE_SPACE, " ")).otherwise(text)
    return F.trim(F.regexp_replace(unified, f"{ws}(?:{ws}+|(?<=[^ ]))", " "))


def clean_text(text: Column) -> Column:
    """Drop bracketed markers and squeeze whitespace; null becomes the text `None`."""
    unmarked = F.regexp_replace(text, V.TRANSLATION_MARKER, "")
    unmarked = F.regexp_replace(unmarked, V.BRACKETED_MARKER, "")
    unmarked = F.when(F.contains(text, F.lit("[")), unmarked).otherwise(text)
    return F.coalesce(squeeze(unmarked), F.lit("None"))


def coerce_text(value: Column) -> Column:
    """String form of any value, uncleaned; null becomes the text `None`."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def build_prompt(cleaned: Column) -> Column:
    return F.concat(F.lit(V.PROMPT_PREFIX), cleaned)


def split_sentences(text: Column) -> Column:
    return F.split(text, r"\. ")


def replace_first(text: Column, needle: str, replacement: Column) -> Column:
    """Replace the first occurrence only; the text itself when there is none."""
    at = F.instr(text, needle)
    return F.when(
        at > 0,
        F.concat(
            F.substr(text, F.lit(1), at - 1),
            replacement,
            F.substr(text, at + len(needle)),
        ),
    ).otherwise(text)


def fold_label(label: Column) -> Column:
    """Key for case- and blank-insensitive label matching."""
    return strip(F.lower(label))


def parse_language_list(option: Column) -> Column:
    """`"en, es"` -> `["en", "es"]`."""
    return F.transform(F.split(option, ","), strip)


def parse_language_pairs(option: Column) -> Column:
    """`"English:en, French:fr"` -> array of (name, code) structs; null parts when malformed."""

    def pair(item: Column) -> Column:
        parts = F.split(item, ":")
        well_formed = F.size(parts) == 2
        return F.struct(
            F.when(well_formed, strip(F.get(parts, F.lit(0)))).alias("name"),
            F.when(well_formed, strip(F.get(parts, F.lit(1)))).alias("code"),
        )

    return F.transform(F.split(option, ","), pair)
