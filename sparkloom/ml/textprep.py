"""Text encoding and function-call data sets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.text import attention, first_tokens, is_json, pad, parse_tool_calls, tokens, tool_prompt, valid_dataset_row
from ..operators.order_stats import first_fraction
from ..session import materialise

PAD_ID, UNKNOWN_ID, FIRST_WORD_ID = 0, 1, 2
#: A vocabulary up to this size is sent to the tasks.
DICTIONARY_ROWS, DICTIONARY_BYTES = 1_000_000, 16 << 20


def fit_vocabulary(df: DataFrame, text: str, size: int = 30_000) -> DataFrame:
    """The most frequent words of all texts with their ids (``size`` rows at most)."""
    counted = df.select(F.explode(tokens(text)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    top = counted.orderBy(F.desc("n"), "token").limit(size)
    # numbering runs over the bounded vocabulary only
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    return top.select("token", (rank + (FIRST_WORD_ID - 1)).cast("bigint").alias("token_id"))


def _dictionary(vocabulary: DataFrame) -> pa.Table | None:
    """The vocabulary as a table, where its measured size is within the bound."""
    rows, letters = vocabulary.agg(F.count("*"), F.sum(F.octet_length("token"))).first()
    if rows > DICTIONARY_ROWS or (letters or 0) > DICTIONARY_BYTES:
        return None
    return vocabulary.select("token", F.col("token_id").cast("bigint").alias("token_id")).toArrow().combine_chunks()


def _ids_by_join(cut: DataFrame, row_id: str, vocabulary: DataFrame) -> DataFrame:
    """Token ids where the vocabulary is too large to send: words meet it in a join and are listed again by row."""
    numbered = cut.withColumn("_row", F.monotonically_increasing_id())
    numbered = materialise(numbered, "token-rows")
    words = numbered.select("_row", F.posexplode("_t").alias("_pos", "token"))
    ids = F.coalesce("token_id", F.lit(UNKNOWN_ID).cast("bigint")).alias("i")
    # at most max_len entries per text
    packed = words.join(vocabulary, "token", "left").groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("_pos", ids))).alias("_w"))
    return numbered.join(packed, "_row", "left").select(
        row_id, F.coalesce(F.transform("_w", lambda w: w["i"]), F.array().cast("array<bigint>")).alias("_ids"))


def encode_tokens(df: DataFrame, row_id: str, text: str, vocabulary: DataFrame, max_len: int = 128) -> DataFrame:
    """``input_ids`` and ``attention_mask`` of fixed length; words outside the vocabulary get the unknown id.

    A vocabulary within ``DICTIONARY_ROWS`` and ``DICTIONARY_BYTES`` is sent to the
    tasks, which look up the token lists of an Arrow batch at once: no token is
    shuffled. A larger one is joined. One row per input row, a text without words
    is all padding.
    """
    vocabulary = materialise(vocabulary.select("token", "token_id"), "vocabulary")
    held = _dictionary(vocabulary)
    cut = df.select(F.col(row_id), F.coalesce(first_tokens(text, max_len), F.array().cast("array<string>")).alias("_t"))
    if held is None:
        listed = _ids_by_join(cut, row_id, vocabulary)
    else:
        sent = df.sparkSession.sparkContext.broadcast((held.column(0).to_pylist(), held.column(1).to_pylist()))
        schema = T.StructType([df.schema[row_id], T.StructField("_ids", T.ArrayType(T.LongType()))])

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, ids = pa.array(sent.value[0], pa.string()), pa.array(sent.value[1], pa.int64())
            for batch in batches:
                lists = batch.column(1)
                found = pc.take(ids, pc.index_in(lists.flatten().cast(pa.string()), value_set=words))
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(offsets, pc.fill_null(found, UNKNOWN_ID))], names=[row_id, "_ids"])

        listed = cut.mapInArrow(look_up, schema)
    return listed.select(row_id, pad("_ids", max_len, PAD_ID).alias("input_ids"),
                         attention("_ids", max_len).alias("attention_mask"))


def fill_answers(df: DataFrame, answers: DataFrame, row_id: str, answer: str = "my_answers", query: str = "query",
                 tools: str = "tools") -> DataFrame:
    """One answer per input row: ``[]`` where there is none or the row is invalid, else its calls as JSON."""
    given = answers.select(row_id, F.col(answer).alias("_a"))
    joined = df.join(given, row_id, "left")
    text = F.when(valid_dataset_row(query, tools), F.col("_a"))
    return joined.withColumn(answer, F.coalesce(text, F.lit("[]"))).drop("_a")


def calls_to_json(calls) -> Column:
    """JSON list of parsed calls; arguments go in as the JSON they are."""
    items = F.transform(calls, lambda c: F.concat(
        F.lit('{"name": '), F.to_json(F.array(c["name"])).substr(F.lit(2), F.length(F.to_json(F.array(c["name"]))) - 2),
        F.lit(', "arguments": '), F.coalesce(c["arguments"], F.lit("{}")), F.lit("}")))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def answer_calls(df: DataFrame, row_id: str, response: str, answer: str = "my_answers") -> DataFrame:
    """Calls found in model responses as JSON text."""
    return df.select(row_id, calls_to_json(parse_tool_calls(response)).alias(answer))


def tool_training_set(df: DataFrame, order: str, tie: str, eval_fraction: float = 0.2,
                      columns: Sequence[str] = ("query", "tools", "answers")) -> DataFrame:
    """Formatted training texts of the valid rows; the last part in order is for evaluation."""
    query, tools, answers = columns
    readable = valid_dataset_row(query, tools) & F.coalesce(is_json(F.col(answers)), F.lit(False))
    # texts are formatted after the split, which looks at the order only
    marked = first_fraction(df.where(readable), order, tie, 1 - eval_fraction)
    return marked.withColumn("text", tool_prompt(query, tools, answers)).where(F.length("text") > 0)
