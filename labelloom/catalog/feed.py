"""Metric feed, configurations and artifact checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog.base import Registry, table
from labelloom.functions import fixed_values as V
from labelloom.operators import artifacts as A
from labelloom.operators import metrics as R
from labelloom.plans.shared import fresh_path
from labelloom.streaming import run_tables as LIVE
from labelloom.streaming.progress import start_metric_stream

registry = Registry()

EVERY, SAVE_EVERY = 5, 20


def as_log_events(events):
    """`events` as training-log events."""
    value = F.col("value")
    logs = F.map_from_arrays(
        F.array(
            F.when(F.col("event_type") == "view", "train_loss").otherwise(F.col("event_type")),
            F.lit("learning_rate"), F.lit("eval_loss"), F.lit("note"),
        ),
        F.array(value, value * 0.001, F.col("user_id").cast("double"), F.lit(None).cast("double")),
    )
    return events.select(
        F.col("event_id").alias("step"), (F.col("event_id") * 0.01).alias("epoch"), logs.alias("logs")
    )


def log_events(spark, sf_dir):
    return as_log_events(table(spark, sf_dir, "events"))


EVENTS_SQL = """
log_events AS (
  SELECT event_id AS step, event_id * 0.01::double AS epoch, value, value * 0.001::double AS rate,
         user_id::double AS eval_loss, CASE event_type WHEN 'view' THEN 'train_loss' ELSE event_type END AS name FROM events)"""
TRAIN_SQL = f"""{EVENTS_SQL},
due AS (SELECT * FROM log_events WHERE step % {EVERY} = 0),
renamed AS (
  SELECT step, CASE WHEN starts_with(name, 'train_') THEN name ELSE 'train_' || name END AS key, value FROM due
  UNION ALL SELECT step, 'train_learning_rate', rate FROM due
  UNION ALL SELECT step, 'learning_rate', rate FROM due
  UNION ALL SELECT step, 'epoch', epoch FROM due),
evaluated AS (SELECT step, 'eval_loss' AS key, eval_loss AS value FROM log_events)"""


def shown(df):
    return df.withColumn("value", F.round("value", 6))


@registry.add("train_metric_filter", f"""WITH {TRAIN_SQL}
SELECT step, name AS key, round(value, 6) AS value FROM due
UNION ALL SELECT step, 'learning_rate', round(rate, 6) FROM due""")
def train_metric_filter(spark, sf_dir):
    return shown(R.train_metric_filter(log_events(spark, sf_dir), EVERY))


@registry.add("train_metric_rename", f"WITH {TRAIN_SQL} SELECT step, key, round(value, 6) AS value FROM renamed")
def train_metric_rename(spark, sf_dir):
    return shown(R.train_metric_rename(log_events(spark, sf_dir), EVERY))


@registry.add("eval_metric_filter", f"WITH {TRAIN_SQL} SELECT step, key, value FROM evaluated")
def eval_metric_filter(spark, sf_dir):
    return R.eval_metric_filter(log_events(spark, sf_dir))


PROGRESS_SQL = f"""WITH {TRAIN_SQL}
SELECT step, key, round(value, 6) AS value FROM (SELECT * FROM renamed UNION ALL SELECT * FROM evaluated)"""


@registry.add("progress_metrics", PROGRESS_SQL)
def progress_metrics(spark, sf_dir):
    return shown(R.progress_metrics(log_events(spark, sf_dir), EVERY))


@registry.add("stream_train_metrics", PROGRESS_SQL)
def stream_train_metrics(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    live = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    out = fresh_path(spark, "stream")
    query = start_metric_stream(
        as_log_events(live), out + "/metrics", out + "/checkpoint", EVERY, available_now=True
    )
    query.awaitTermination()
    return shown(spark.read.schema("step bigint, key string, value double").parquet(out + "/metrics"))


@registry.add("best_checkpoint", f"""WITH {EVENTS_SQL}
SELECT step AS best_step, eval_loss AS best_value FROM log_events WHERE step % {SAVE_EVERY} = 0
ORDER BY eval_loss, step LIMIT 1""")
def best_checkpoint(spark, sf_dir):
    return R.best_checkpoint(R.eval_metric_filter(log_events(spark, sf_dir)), "eval_loss", SAVE_EVERY)


def live_events(spark, sf_dir, batches=3):
    """`events`, in several files that are read one after another, as a stream."""
    schema = table(spark, sf_dir, "events").schema
    path = fresh_path(spark, "live-events")
    # An event's number decides its file, so a metric's best can come in any batch.
    table(spark, sf_dir, "events").repartition(batches, "event_id").write.parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@registry.add("stream_run_table", f"""WITH {TRAIN_SQL}
SELECT 'r1' AS run_id, 'train' AS stage, key, round(value, 6) AS value, step FROM (SELECT * FROM renamed UNION ALL SELECT * FROM evaluated)""")
def stream_run_table(spark, sf_dir):
    """A run table filled by micro-batches, the last of which is delivered twice."""
    out = fresh_path(spark, "run-table")
    query = LIVE.start_run_table(
        as_log_events(live_events(spark, sf_dir)), out + "/table", out + "/checkpoint", "r1", n=EVERY, available_now=True
    )
    query.awaitTermination()
    again = spark.read.schema(LIVE.LIVE_SCHEMA).parquet(out + "/table").filter("batch_id = 1")
    rows = stored_rows(again.drop("batch_id"))
    LIVE.write_batch(out + "/table", ["run_id", "stage"])(rows, 1)
    return shown(LIVE.read_run_table(spark, out + "/table"))


def stored_rows(df):
    """Rows apart from the table that they were read from."""
    path = fresh_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@registry.add("stream_best_checkpoint", f"""WITH {EVENTS_SQL}
SELECT 'run' || (step // {SAVE_EVERY} % 4)::varchar AS run_id, arg_min(step, (eval_loss, step)) AS best_step, min(eval_loss) AS best_value
FROM log_events WHERE step % {SAVE_EVERY} = 0 GROUP BY 1""")
def stream_best_checkpoint(spark, sf_dir):
    """The best checkpoint so far of each of four runs, kept by a stateful stream."""
    out = fresh_path(spark, "best")
    events = as_log_events(live_events(spark, sf_dir))
    run = F.concat(F.lit("run"), F.floor(F.col("step") / SAVE_EVERY) % 4)
    query = LIVE.start_best_checkpoint(
        events.withColumn("run_id", run), out + "/table", out + "/checkpoint", save_every=SAVE_EVERY, available_now=True
    )
    query.awaitTermination()
    return LIVE.best_so_far(spark, out + "/table")


@registry.add("log_regex_metrics", """
WITH lines AS (
  SELECT event_id, '{''loss'': ' || user_id || '.5, ''eval_loss'': ' || event_id || ', ''lr'': 1e-05} {''loss'': 1e-05, ''eval_accuracy'': 0.'
         || user_id || '}' AS line FROM events),
hits AS (
  SELECT event_id, 'train:loss' AS metric, regexp_extract_all(line, '''loss'': ([0-9\\.]+)', 1) AS h FROM lines
  UNION ALL SELECT event_id, 'eval:loss', regexp_extract_all(line, '''eval_loss'': ([0-9\\.]+)', 1) FROM lines
  UNION ALL SELECT event_id, 'eval:accuracy', regexp_extract_all(line, '''eval_accuracy'': ([0-9\\.]+)', 1) FROM lines)
SELECT event_id, metric, pos, try_cast(h[pos + 1] AS double) AS value
FROM hits, LATERAL (SELECT unnest(range(0, len(h))) AS pos)""")
def log_regex_metrics(spark, sf_dir):
    line = F.format_string(
        "{'loss': %d.5, 'eval_loss': %d, 'lr': 1e-05} {'loss': 1e-05, 'eval_accuracy': 0.%d}",
        F.col("user_id"), F.col("event_id"), F.col("user_id"),
    )
    lines = table(spark, sf_dir, "events").select("event_id", line.alias("line"))
    return R.extract_log_metrics(lines, "line")


@registry.add("parse_config_json", """
SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events""")
def parse_config_json(spark, sf_dir):
    parsed = R.parse_config(table(spark, sf_dir, "events").select("event_id", "props"), "props")
    return parsed.select("event_id", F.explode("props").alias("key", "value"))


@registry.add("flatten_params", """
SELECT event_id, 'ft_train_k' AS key, json_extract_string(props, '$.k') AS value FROM events
UNION ALL SELECT event_id, 'ft_lora_lora_r', user_id::varchar FROM events
UNION ALL SELECT event_id, 'ft_lora_kind', event_type FROM events""")
def flatten_params(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    lora = F.create_map(F.lit("lora_r"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type"))
    train = R.flatten_params(events.select("event_id", "props"), "props", "ft_train_")
    return train.unionByName(R.flatten_params(events.select("event_id", lora.alias("c")), "c", "ft_lora_"))


# --- artifact checks ---


def files(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(F.col("url").alias("key"))


@registry.add("list_prefix", """
SELECT url AS key, substring(url, 8) AS relative_path FROM pages
WHERE starts_with(url, 'https:/') AND NOT ends_with(url, '/') AND substring(url, 8) <> ''""")
def list_prefix(spark, sf_dir):
    return A.list_prefix(files(spark, sf_dir), "https://")


@registry.add("pick_by_suffix", "SELECT min(url) AS key FROM pages WHERE ends_with(url, '.html') HAVING min(url) IS NOT NULL")
def pick_by_suffix(spark, sf_dir):
    return A.pick_by_suffix(files(spark, sf_dir), ".html")


@registry.add("missing_required", """
SELECT name, (SELECT count(*) FROM pages) AS n_objects
FROM (SELECT unnest(['example.com', 'config.json', 'tokenizer.json']) AS name)
WHERE NOT EXISTS (SELECT 1 FROM pages WHERE contains(url, name))""")
def missing_required(spark, sf_dir):
    return A.missing_required(files(spark, sf_dir), ["example.com", "config.json", "tokenizer.json"])


@registry.add("parse_uri", r"""
WITH cut AS (SELECT page_id, url, regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\-]*://', '') AS path,
                    string_split(url, '/')[-1] AS file_name FROM pages)
SELECT page_id, string_split(path, '/')[1] AS bucket,
       substring(path, length(string_split(path, '/')[1]) + 2) AS object_key,
       regexp_replace(substring(url, 1, length(url) - length(file_name)), '/$', '') AS directory, file_name FROM cut""")
def parse_uri(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", A.parse_uri(F.col("url")).alias("u")).select("page_id", "u.*")
