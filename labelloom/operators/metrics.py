"""Training-metric feed: log lines, per-step filters, renames, best checkpoint, run tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions import fixed_values as V


def extract_log_metrics(lines: DataFrame, col: str, patterns: dict[str, str] | None = None) -> DataFrame:
    """One row per regex hit: the other columns, `metric`, `pos` and `value`."""
    patterns = V.LOG_PATTERNS if patterns is None else patterns
    hits = F.concat(*[_hits(F.col(col), name, regex) for name, regex in patterns.items()])
    others = [c for c in lines.columns if c != col]
    return lines.select(*others, F.inline(hits))


def _hits(line: Column, name: str, regex: str) -> Column:
    def entry(text: Column, i: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric"),
            i.cast("bigint").alias("pos"),
            text.try_cast("double").alias("value"),
        )

    return F.transform(F.regexp_extract_all(line, F.lit(regex), F.lit(1)), entry)


def _numeric(logs: Column) -> Column:
    return F.filter(F.map_entries(logs), lambda e: e["value"].isNotNull())


def _is_eval(entry: Column) -> Column:
    return F.startswith(entry["key"], F.lit("eval_"))


def _metric(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.cast("double").alias("value"))


def _train_entries() -> Column:
    return F.filter(_numeric(F.col("logs")), lambda e: ~_is_eval(e))


def _renamed(key: Column) -> Column:
    return F.when(F.startswith(key, F.lit("train_")), key).otherwise(F.concat(F.lit("train_"), key))


def _renamed_entries() -> Column:
    named = F.transform(_train_entries(), lambda e: _metric(_renamed(e["key"]), e["value"]))
    epoch = F.when(F.col("epoch").isNotNull(), F.array(_metric(F.lit("epoch"), F.col("epoch"))))
    rate = F.try_element_at("logs", F.lit("learning_rate"))
    bare_rate = F.when(rate.isNotNull(), F.array(_metric(F.lit("learning_rate"), rate)))
    nothing = F.array().cast("array<struct<key:string,value:double>>")
    return F.concat(named, F.coalesce(epoch, nothing), F.coalesce(bare_rate, nothing))


def _eval_entries() -> Column:
    chosen = F.filter(_numeric(F.col("logs")), _is_eval)
    return F.transform(chosen, lambda e: _metric(e["key"], e["value"]))


def _due(n: int) -> Column:
    return F.col("step") % n == 0


def train_metric_filter(events: DataFrame, n: int = V.LOG_EVERY_STEPS) -> DataFrame:
    """Numeric entries of every n-th step whose key does not start with `eval_`."""
    entries = F.transform(_train_entries(), lambda e: _metric(e["key"], e["value"]))
    return events.filter(_due(n)).select("step", F.inline(entries))


def train_metric_rename(events: DataFrame, n: int = V.LOG_EVERY_STEPS) -> DataFrame:
    """The same entries under `train_` names, with `epoch` and `learning_rate` also bare."""
    return events.filter(_due(n)).select("step", F.inline(_renamed_entries()))


def eval_metric_filter(events: DataFrame) -> DataFrame:
    """Numeric `eval_` entries of every step."""
    return events.select("step", F.inline(_eval_entries()))


def progress_metrics(events: DataFrame, n: int = V.LOG_EVERY_STEPS) -> DataFrame:
    """Training and evaluation metrics in one pass; works on batch and streaming frames."""
    nothing = F.array().cast("array<struct<key:string,value:double>>")
    due = F.when(_due(n), _renamed_entries()).otherwise(nothing)
    return events.select("step", F.inline(F.concat(due, _eval_entries())))


def best_checkpoint(metrics: DataFrame, metric: str = "eval_loss", save_every: int = 20) -> DataFrame:
    """Saved step with the lowest metric; the earliest wins a tie."""
    saved = metrics.filter((F.col("key") == metric) & (F.col("step") % save_every == 0))
    best = F.min(F.struct("value", "step"))
    return saved.agg(best.alias("_best")).select(
        F.col("_best.step").alias("best_step"), F.col("_best.value").alias("best_value")
    ).filter(F.col("best_step").isNotNull())


def parse_config(df: DataFrame, col: str, mode: str = "FAILFAST") -> DataFrame:
    """A JSON-text configuration column as a map; a map column is left as it is.

    Text that is no JSON object fails the job that reads it (`mode="PERMISSIVE"` makes it null); a null stays null.
    """
    if isinstance(df.schema[col].dataType, T.StringType):
        text = F.col(f"`{col}`")
        parsed = F.from_json(text, "map<string,string>", {"mode": mode})
        if mode == "FAILFAST":
            # A text that is empty, or another kind of JSON than an object, is not malformed to the parser.
            parsed = F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(
                F.raise_error(F.concat(F.lit("configuration is no JSON object: "), F.substring(text, 1, 200))).cast("map<string,string>")
            )
        return df.withColumn(col, parsed)
    return df


def flatten_params(df: DataFrame, config: str, prefix: str, mode: str = "FAILFAST") -> DataFrame:
    """(key, value) rows of a configuration map, keys prefixed."""
    others = [c for c in df.columns if c != config]
    entries = F.explode(config).alias("key", "value")
    return parse_config(df, config, mode).select(*others, entries).withColumn("key", F.concat(F.lit(prefix), F.col("key")))


def run_metrics(metrics: DataFrame, run_id: str, stage: str) -> DataFrame:
    """(key, value[, step]) rows in the layout of the run table."""
    step = F.col("step").cast("bigint") if "step" in metrics.columns else F.lit(None).cast("bigint")
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(stage).alias("stage"),
        "key",
        F.col("value").cast("double").alias("value"),
        step.alias("step"),
    )


def run_params(params: DataFrame, run_id: str) -> DataFrame:
    """(key, value) rows in the layout of the parameter table."""
    return params.select(F.lit(run_id).alias("run_id"), "key", F.col("value").cast("string").alias("value"))
