"""Training a text classifier and scoring prompts in batches."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from hashlib import md5

import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions import fixed_values as V
from labelloom.functions.hashing import DEFAULT_SEED
from labelloom.functions.text import strip
from labelloom.operators.split import SALT, split_order
from labelloom.plans.joins import lookup_join
from labelloom.plans.ledger import LEASE_SECONDS, Ask, Ledger, Slice, runs_side_by_side
from labelloom.plans.ordering import number_rows, rank_parts
from labelloom.plans.shared import fresh_path, settle

FEATURES = 1 << 14
TASK_BATCHES = 64
PIECE_ROWS = 256


def train_classifier(
    train: DataFrame,
    text_col: str,
    label_col: str,
    features: int = FEATURES,
    logistic: bool = False,
) -> PipelineModel:
    """Fit hashed word weights and a classifier; predictions come as `predicted_label`.

    Label indices follow the sorted vocabulary. The model holds labels x features
    weights, so it grows with the vocabulary, not with the rows. Rows without a label are
    not learned from.
    """
    train = train.filter(F.col(label_col).isNotNull())
    labels = StringIndexer(inputCol=label_col, outputCol="_label", stringOrderType="alphabetAsc")
    indexer = labels.fit(train)
    tokenizer = RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=V.NARROW_SPACE + "+")
    hashing = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features)
    weighting = IDF(inputCol="_tf", outputCol="_features")
    columns = {"featuresCol": "_features", "labelCol": "_label", "predictionCol": "_prediction"}
    classifier = LogisticRegression(**columns, maxIter=20) if logistic else NaiveBayes(**columns)
    names = IndexToString(inputCol="_prediction", outputCol="predicted_label", labels=indexer.labels)
    # Labels are indexed for the fit only: rows to classify need none.
    return Pipeline(stages=[tokenizer, hashing, weighting, classifier, names]).fit(indexer.transform(train))


def classify(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).select(*[F.col(f"`{c}`") for c in df.columns], "predicted_label")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def batch_predict(
    df: DataFrame,
    prompt_col: str,
    open_predictor: Callable[[], Callable[[list[str]], list[str]]],
    batch_size: int = V.SCORING_BATCH,
) -> DataFrame:
    """Append `raw_output`: a predictor, opened once per partition, called on `batch_size` prompts at a time.

    Beside the Arrow batch that it reads, a task holds about `PIECE_ROWS` prompts and outputs at a time.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("raw_output", T.StringType())])

    step = batch_size * max(1, PIECE_ROWS // batch_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = None
        for batch in batches:
            predictor = predictor or open_predictor()
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                prompts = piece.column(prompt_col)
                outputs = []
                for at in range(0, piece.num_rows, batch_size):
                    outputs.extend(predictor(prompts.slice(at, batch_size).to_pylist()))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(outputs, pa.string())], [*piece.schema.names, "raw_output"])

    return df.mapInArrow(run, schema)


def assign_batches(df: DataFrame, key: str, batch_size: int = V.SCORING_BATCH, seed: int = DEFAULT_SEED) -> DataFrame:
    """Append `batch_id`: consecutive mini-batches in reading order, from 0.

    Only keys are sorted and numbered; rows get their number by `key`, which is unique.
    """
    keys = df.select(F.col(f"`{key}`").alias("_key"))
    numbered = number_rows(keys, split_order("_key", seed), "_number")
    numbers = settle(numbered.select("_key", F.floor((F.col("_number") - 1) / batch_size).cast("bigint").alias("batch_id")), "batches")
    return lookup_join(df.withColumn("_key", F.col(f"`{key}`")), numbers, ["_key"], [key], null_safe=True).drop("_key")


def predict_in_batches(
    df: DataFrame,
    key: str,
    prompt_col: str,
    open_predictor: Callable[[], Callable[[list[str]], list[str]]],
    batch_size: int = V.SCORING_BATCH,
    seed: int = DEFAULT_SEED,
    ledger: Ledger | None = None,
    task_batches: int = TASK_BATCHES,
) -> DataFrame:
    """Append `batch_id` and `raw_output`: the predictor gets exactly the batches of `assign_batches`, whatever the tasks.

    Runs of `task_batches` whole batches are decided from the keys alone; prompts are moved once, each to its run's task. The answers
    of a batch are kept in `ledger` (default: a new one) under its number and a digest of its prompts, so neither a
    task that is tried again nor a run over the same ledger repeats a batch. `key` is unique.
    """
    spark = df.sparkSession
    runs = rank_parts(df, key, batch_size * task_batches, SALT, seed)
    kept = ledger if ledger and ledger.slices else Ledger.open(ledger.path if ledger else fresh_path(spark, "ledger"), 0, max(1, runs.count))
    side_by_side = runs_side_by_side(spark)
    placed = runs.place(df, "_run")
    schema = T.StructType([*df.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("raw_output", T.StringType())])
    answer = pa.schema([("batch", pa.string()), ("outputs", pa.list_(pa.string()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor: list = []

        def open_asker() -> Ask:
            predict = open_predictor()
            return lambda asked: [(list(predict(list(prompts))),) for (prompts,) in asked]

        def scored(number: int, batch: pd.DataFrame) -> pd.DataFrame:
            prompts = batch[prompt_col].tolist()
            name = f"{number}-{md5(json.dumps(prompts).encode()).hexdigest()}"
            of = Slice(kept, number // task_batches % kept.slices, answer, LEASE_SECONDS, side_by_side)
            try:
                if of.take({name}):
                    of.ask([(name, prompts)], open_asker, predictor, 1)
            finally:
                of.leave()
            return batch.drop(columns=["_run", "_digest"]).assign(batch_id=number, raw_output=of.known[name][0])

        at, count, left = None, 0, None
        for frame in frames:
            for run_id, part in frame.groupby("_run", sort=False):
                if run_id != at:
                    if left is not None and len(left):
                        yield scored(at * task_batches + count, left)
                    at, count, left = run_id, 0, None
                left = part if left is None else pd.concat([left, part])
                while len(left) >= batch_size:
                    yield scored(at * task_batches + count, left.iloc[:batch_size])
                    count, left = count + 1, left.iloc[batch_size:]
        if left is not None and len(left):
            yield scored(at * task_batches + count, left)

    dealt = placed.repartition(max(1, runs.count), "_run").sortWithinPartitions("_run", "_digest", key)
    return dealt.mapInPandas(run, schema)


def extract_prediction(raw_output: Column, prompt: Column, strip_mode: str = "length") -> Column:
    """First line of what follows the prompt.

    `length` removes as many characters as the prompt has; `prefix` removes the
    prompt only where the output really starts with it.
    """
    tail = F.substr(raw_output, F.length(prompt) + 1)
    if strip_mode == "prefix":
        tail = F.when(F.startswith(raw_output, prompt), tail).otherwise(raw_output)
    elif strip_mode != "length":
        raise ValueError(f"unknown strip_mode '{strip_mode}'")
    return strip(F.substring_index(strip(tail), "\n", 1))
