"""Sources and sinks: write the given tables out, read them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.catalog.base import RAW_SQL, Registry, raw_rows, sql_clean, sql_digest, sql_split, table
from labelloom.catalog.evaluation import base_sql, normalized
from labelloom.catalog.feed import TRAIN_SQL, log_events
from labelloom.catalog.preparation import parts
from labelloom.operators import evaluate as E
from labelloom.operators import metrics as R
from labelloom.operators import prepare as P
from labelloom.operators import split as S
from labelloom.plans.shared import fresh_path
from labelloom.schemas import MESSAGES, METRICS, PARAMS
from labelloom.sources import readers as IN
from labelloom.sources import writers as OUT

registry = Registry()

ROWS = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("job_description_text", T.StringType()),
        T.StructField("category_label", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)
ALL_ROWS = f"WITH {RAW_SQL} SELECT row_id, job_description_text, category_label, source FROM raw"


@registry.add("src_jsonl", ALL_ROWS)
def src_jsonl(spark, sf_dir):
    path = fresh_path(spark, "raw") + "/rows.jsonl"
    OUT.write_jsonl(raw_rows(spark, sf_dir), path)
    return IN.load_raw(spark, path, ROWS)


@registry.add("src_csv", ALL_ROWS)
def src_csv(spark, sf_dir):
    path = fresh_path(spark, "raw") + "/rows.csv"
    raw_rows(spark, sf_dir).write.options(header=True, escape='"').csv(path)
    return IN.load_raw(spark, path, ROWS)


@registry.add("src_json_document", ALL_ROWS)
def src_json_document(spark, sf_dir):
    """The table as many array documents of at most 1,000 records, one per file."""
    path = fresh_path(spark, "raw") + "/rows.json"
    records = raw_rows(spark, sf_dir).groupBy(F.expr("row_id div 1000").alias("chunk")).agg(
        F.to_json(F.collect_list(F.struct(*[f.name for f in ROWS.fields]))).alias("value")
    )
    records.write.partitionBy("chunk").text(path)
    return IN.load_raw(spark, path, ROWS).select(*ROWS.names)


@registry.add("src_named_table", ALL_ROWS)
def src_named_table(spark, sf_dir):
    raw_rows(spark, sf_dir).createOrReplaceTempView("named_raw_rows")
    return IN.load_raw(spark, "named_raw_rows")


@registry.add("src_templates", """
SELECT source || '/' || doc_id AS category, pos AS template_idx, s[pos + 1] AS template
FROM (SELECT doc_id, source, string_split(text, '. ') AS s FROM documents),
     LATERAL (SELECT unnest(range(0, len(s))) AS pos)""")
def src_templates(spark, sf_dir):
    path = fresh_path(spark, "templates")
    entry = F.create_map(F.concat_ws("/", "source", "doc_id"), F.split("text", r"\. "))
    table(spark, sf_dir, "documents").select(F.to_json(entry).alias("value")).write.text(path)
    return IN.read_templates(spark, path, lines=True)


@registry.add("src_vocabulary", """
SELECT row_number() OVER (ORDER BY source) - 1 AS idx, source AS category FROM (SELECT DISTINCT source FROM documents)""")
def src_vocabulary(spark, sf_dir):
    path = fresh_path(spark, "vocabulary")
    OUT.write_vocabulary(table(spark, sf_dir, "documents").select(F.col("source").alias("category")).distinct(), path)
    return IN.read_vocabulary(spark, path)


NULLABLE_SQL = """
SELECT doc_id AS row_id, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS text,
       doc_id % 13 = 0 AS written_null FROM documents"""


@registry.add("sink_jsonl", NULLABLE_SQL)
def sink_jsonl(spark, sf_dir):
    path = fresh_path(spark, "jsonl")
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.when(F.col("doc_id") % 13 != 0, F.col("text")).alias("text")
    )
    OUT.write_jsonl(rows, path)
    lines = spark.read.text(path)
    fields = F.from_json("value", "row_id bigint, text string")
    return lines.select(fields.alias("f"), F.endswith("value", F.lit('"text":null}')).alias("written_null")).select(
        "f.*", "written_null"
    )


@registry.add("sink_splits", f"""WITH {RAW_SQL},{sql_split('raw')}
SELECT split, 'Classify the following job description. Job Description: ' || {sql_clean('job_description_text')} AS prompt,
       category_label AS true_label FROM parts""")
def sink_splits(spark, sf_dir):
    path = fresh_path(spark, "splits")
    OUT.write_splits(P.to_messages(parts(spark, sf_dir)), path)
    schema = T.StructType([*MESSAGES.fields, T.StructField("split", T.StringType())])
    back = spark.read.schema(schema).json(path)
    return P.prompt_and_label(back).select("split", "prompt", "true_label")


@registry.add("sink_vocabulary", """
SELECT '[' || string_agg('"' || source || '"', ',' ORDER BY source) || ']' AS value
FROM (SELECT DISTINCT source FROM documents)""")
def sink_vocabulary(spark, sf_dir):
    path = fresh_path(spark, "vocabulary")
    labels = table(spark, sf_dir, "documents").select(F.col("source").alias("category")).distinct()
    OUT.write_vocabulary(labels, path)
    return spark.read.text(path)


@registry.add("sink_examples_csv", f"""WITH {base_sql('es')}
SELECT row_id, input_text, true_label, predicted_label FROM norm ORDER BY {sql_digest('row_id', 'split')}, row_id LIMIT 20""")
def sink_examples_csv(spark, sf_dir):
    path = fresh_path(spark, "examples") + "/examples.csv"
    OUT.write_examples_csv(E.example_predictions(normalized(spark, sf_dir, "es")), path)
    return IN.load_raw(
        spark, path,
        T.StructType.fromDDL("row_id bigint, input_text string, true_label string, predicted_label string"),
    )


@registry.add("sink_run_metrics", f"""WITH {TRAIN_SQL}
SELECT 'run-1' AS run_id, 'train' AS stage, key, round(value, 6) AS value, step FROM renamed
UNION ALL
SELECT 'run-1', 'prepare', split || '_sample_count', n::double, NULL FROM (
  WITH {RAW_SQL},{sql_split('raw')} SELECT split, count(*) AS n FROM parts GROUP BY split)""")
def sink_run_metrics(spark, sf_dir):
    path = fresh_path(spark, "run-metrics")
    counts = S.split_counts(parts(spark, sf_dir), "category_label").select(
        F.concat("split", F.lit("_sample_count")).alias("key"), F.col("n_rows").alias("value")
    )
    OUT.write_run_metrics(counts, path, "run-1", "prepare")
    OUT.write_run_metrics(R.train_metric_rename(log_events(spark, sf_dir)), path, "run-1", "train")
    back = spark.read.schema(METRICS).parquet(path)
    return back.select("run_id", "stage", "key", F.round("value", 6).alias("value"), "step")


@registry.add("sink_run_params", """
SELECT 'run-1' AS run_id, 'event_' || event_id || '_k' AS key, json_extract_string(props, '$.k') AS value FROM events""")
def sink_run_params(spark, sf_dir):
    path = fresh_path(spark, "run-params")
    props = table(spark, sf_dir, "events").select("event_id", "props")
    flat = R.flatten_params(props, "props", "").filter("key = 'k'")
    named = flat.select(F.concat(F.lit("event_"), F.col("event_id").cast("string"), F.lit("_"), "key").alias("key"), "value")
    OUT.write_run_params(named, path, "run-1")
    return spark.read.schema(PARAMS).parquet(path).select("run_id", "key", "value")


@registry.add("list_files", """
SELECT 'split=' || split AS folder, true AS has_files FROM (
  SELECT DISTINCT CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test' ELSE 'validation' END AS split FROM documents)""")
def list_files(spark, sf_dir):
    """Folders found by listing a written per-split table."""
    path = fresh_path(spark, "listed")
    part = F.when(F.col("doc_id") % 3 == 0, "train").when(F.col("doc_id") % 3 == 1, "test").otherwise("validation")
    table(spark, sf_dir, "documents").select("text", part.alias("split")).write.partitionBy("split").json(path)
    folder = F.regexp_extract("key", "(split=[a-z]+)/part-[^/]*$", 1)
    found = IN.list_files(spark, path).select(folder.alias("folder"), "size").filter("folder <> ''")
    return found.groupBy("folder").agg((F.sum("size") > 0).alias("has_files"))
