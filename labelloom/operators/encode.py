"""Chat rendering and fixed-length token arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions import fixed_values as V
from labelloom.functions.text import squeeze
from labelloom.plans.ordering import number_rows
from labelloom.plans.shared import Settled, settle
from labelloom.plans.wordfiles import WordFiles, write_word_files

UNKNOWN, PAD, FIRST_WORD_ID = 0, 1, 2
# A beginning of so many signs a word nearly always holds the words wanted.
CHARS_PER_WORD = 16
PIECE_ROWS = 512


def render_train(messages: Column, eos: str) -> Column:
    """User and assistant turns, each closed by `eos`; other roles are dropped."""
    return F.array_join(F.transform(messages, lambda m: _turn(m, eos)), "")


def render_eval(messages: Column, eos: str, generate: bool = True) -> Column:
    """As `render_train`, with system content kept bare and an open assistant turn at the end."""
    turns = F.transform(messages, lambda m: F.when(m["role"] == "system", m["content"]).otherwise(_turn(m, eos)))
    text = F.array_join(turns, "")
    return F.concat(text, F.lit(V.ASSISTANT_TURN)) if generate else text


def _turn(m: Column, eos: str) -> Column:
    return (
        F.when(m["role"] == "user", F.concat(F.lit(V.USER_TURN), m["content"], F.lit(eos)))
        .when(m["role"] == "assistant", F.concat(F.lit(V.ASSISTANT_TURN), m["content"], F.lit(eos)))
    )


def first_words(text: Column, limit: int) -> Column:
    """The text with single blanks between its words, its first `limit` words at least.

    Of a long text only the beginning is squeezed, as long as it holds more than `limit` words.
    """
    start = squeeze(F.substring(text, 1, CHARS_PER_WORD * limit))
    blanks = F.length(start) - F.length(F.replace(start, F.lit(" "), F.lit("")))
    return F.when((F.length(text) <= CHARS_PER_WORD * limit) | (blanks > limit), start).otherwise(squeeze(text))


def word_vocabulary(corpus: DataFrame, text_col: str, eos: str) -> DataFrame:
    """(word, token_id) by falling frequency, then word, from id 2; `eos` is the pad id 1."""
    counted = (
        corpus.select(F.explode(F.split(squeeze(F.col(text_col)), " ")).alias("word"))
        .filter((F.col("word") != eos) & (F.col("word") != ""))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = number_rows(counted, [F.col("_n").desc(), "word"]).select(
        "word", (F.col("row_number") + FIRST_WORD_ID - 1).cast("int").alias("token_id")
    )
    end = corpus.sparkSession.createDataFrame([(eos, PAD)], "word string, token_id int")
    return ranked.unionByName(end)


def token_limit(max_seq_length: int) -> int:
    return min(max_seq_length, V.TOKEN_LIMIT)


def encode(
    df: DataFrame,
    text_col: str,
    vocabulary: DataFrame | Settled | WordFiles,
    key: str | None = None,
    max_seq_length: int = V.TOKEN_LIMIT,
    pad: bool = True,
) -> DataFrame:
    """Append `n_tokens` and `input_ids` (truncated, and padded unless `pad` is off).

    `vocabulary` is (word, token_id), or the files made of it. It is written to files that tasks map
    into memory, whatever its size, and rows do not move, so `key` need not be unique.
    """
    limit = token_limit(max_seq_length)
    if not isinstance(vocabulary, WordFiles):
        vocabulary = write_word_files(vocabulary if isinstance(vocabulary, Settled) else settle(vocabulary, "token-vocabulary"))
    looked_up = df.withColumn("input_ids", _look_up(first_words(F.col(text_col), limit), vocabulary, limit))
    counted = looked_up.withColumn("n_tokens", F.size("input_ids").cast("bigint"))
    return counted.withColumn("input_ids", pad_to(F.col("input_ids"), F.lit(limit))) if pad else counted


def _look_up(texts: Column, known: WordFiles, limit: int) -> Column:
    """Ids of the first `limit` blank-separated words of each text; none for a null."""
    unknown, rows = UNKNOWN, PIECE_ROWS

    @F.arrow_udf("array<int>")
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import pyarrow.compute as pc

        # Split words take several times the room of their text, so a batch is cut into pieces.
        for piece in (batch.slice(at, rows) for batch in batches for at in range(0, max(len(batch), 1), rows)):
            lists = pc.list_slice(pc.split_pattern(piece, " ", max_splits=limit), 0, limit)
            lengths = pc.fill_null(pc.list_value_length(lists), 0)
            # A different word of a piece is looked up once.
            coded = lists.flatten().dictionary_encode()
            tokens = pa.array(known.ids(coded.dictionary, unknown), pa.int32()).take(coded.indices)
            offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(lengths).cast(pa.int32())])
            yield pa.ListArray.from_arrays(offsets, tokens)

    return look_up(texts)


def encode_with(
    df: DataFrame,
    text_col: str,
    open_tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]],
    pad_id: int,
    max_seq_length: int = V.TOKEN_LIMIT,
    pad: bool = True,
) -> DataFrame:
    """As `encode`, with a user's tokenizer called once per Arrow batch."""
    limit = token_limit(max_seq_length)

    @F.pandas_udf("array<int>")
    def tokenize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = open_tokenizer()
        for texts in batches:
            yield pd.Series([list(ids)[:limit] for ids in tokenizer(texts.fillna("").tolist())])

    counted = df.withColumn("input_ids", tokenize(text_col)).withColumn(
        "n_tokens", F.size("input_ids").cast("bigint")
    )
    return counted.withColumn("input_ids", pad_to(F.col("input_ids"), F.lit(limit), pad_id)) if pad else counted


def pad_to(ids: Column, length: Column, pad_id: int = PAD) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad_id), (length - F.size(ids)).cast("int")))


def attention_mask(n_tokens: Column, length: Column) -> Column:
    """1 for real positions, 0 for padding."""
    ones = F.array_repeat(F.lit(1), n_tokens.cast("int"))
    return F.concat(ones, F.array_repeat(F.lit(0), (length - n_tokens).cast("int")))


def causal_labels(input_ids: Column, pad_id: int = PAD) -> Column:
    """Copy of the ids with every pad id (real end markers too) ignored."""
    return F.transform(input_ids, lambda x: F.when(x == pad_id, V.IGNORED_LABEL).otherwise(x))


def pad_batches(encoded: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Pad unpadded ids to the longest row of their batch and add the mask."""
    longest = F.max("n_tokens").over(Window.partitionBy(batch))
    sized = encoded.withColumn("batch_length", longest)
    return sized.withColumn("input_ids", pad_to(F.col("input_ids"), F.col("batch_length"))).withColumn(
        "attention_mask", attention_mask(F.col("n_tokens"), F.col("batch_length"))
    )
