"""Evaluation of function-call answers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..ml.textprep import answer_calls, fill_answers
from ..operators.statistics import score_tool_calls


def answered(df: DataFrame, responses: DataFrame, row_id: str, response: str) -> DataFrame:
    """Every input row with the calls found in its response, ``[]`` where there are none."""
    return fill_answers(df, answer_calls(responses, row_id, response), row_id)


def evaluate_tool_calls(df: DataFrame, responses: DataFrame, row_id: str, response: str, truth: str = "answers") -> DataFrame:
    return score_tool_calls(answered(df, responses, row_id, response), truth, "my_answers")
