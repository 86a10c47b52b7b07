"""Text and function-call expressions."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, functions as F

from .. import fixed_values as fx
from ..schemas import TOOL_CALL
from .numbers import as_col


def length_ok(text, lo: int = fx.MIN_TEXT_CHARS, hi: int = fx.MAX_TEXT_CHARS) -> Column:
    return F.coalesce(F.length(as_col(text)).between(lo, hi), F.lit(False))


def completion(label, names: dict[int, str] | None = None) -> Column:
    """Name of a label, or the label as text when it has none."""
    names = fx.SENTIMENT_NAMES if names is None else names
    pairs = [F.lit(part) for key, name in names.items() for part in (key, name)]
    label = as_col(label)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), label.cast("string"))


def prompt(text, head: str = fx.SENTIMENT_PROMPT) -> Column:
    return F.concat(F.lit(head), as_col(text))


def tokens(text, pattern: str = r"[^\p{L}\p{N}]+") -> Column:
    """Lower-case word tokens without empty strings."""
    return F.filter(F.split(F.lower(as_col(text)), pattern), lambda t: t != "")


def first_tokens(text, n: int, pattern: str = r"[^\p{L}\p{N}]+") -> Column:
    """The first n of ``tokens``; the rest of the text is not split."""
    # at most one piece, the first, is empty, and the last one is what was not split
    pieces = F.split(F.lower(as_col(text)), pattern, n + 2)
    return F.slice(F.filter(F.slice(pieces, 1, n + 1), lambda t: t != ""), 1, n)


def pad(ids, length: int, filler: int = 0) -> Column:
    """Cut or right-pad an id array to ``length``."""
    ids = F.slice(as_col(ids), 1, length)
    return F.concat(ids, F.array_repeat(F.lit(filler).cast("bigint"), F.lit(length) - F.size(ids)))


def attention(ids, length: int) -> Column:
    """1 for real tokens, 0 for padding, aligned with ``pad``."""
    used = F.least(F.size(as_col(ids)), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(length) - used))


def _between_brackets(text: Column, opening: str, closing: str) -> Column:
    """Text from the first ``opening`` to the last ``closing``, NULL when either is missing or they are reversed."""
    start = F.instr(text, opening)
    end = F.length(text) - F.instr(F.reverse(text), closing) + 1
    found = (start > 0) & (F.instr(text, closing) > 0) & (end >= start)
    return F.when(found, F.substring(text, start, end - start + 1))


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value.

    The parser stops after the first value, so the text is read as an object's
    field and as a list's element: nothing can follow a value in both.
    """
    as_field, as_element = _both_readings(text)
    return as_field.isNotNull() & as_element.isNotNull()


def _both_readings(text: Column) -> tuple[Column, Column]:
    return (F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))),
            F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))))


def json_value(text: Column) -> Column:
    """The value that the whole text is, NULL where it is none; read twice, as in ``is_json``, and no more."""
    def value(t: Column) -> Column:
        as_field, as_element = _both_readings(t)
        return F.when(as_element.isNotNull(), F.try_variant_get(as_field, "$.v", "variant"))

    return bind(text, value)


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is mentioned."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _call(fields: Column) -> Column:
    return F.struct(F.try_element_at(fields, F.lit("name")).alias("name"),
                    F.try_element_at(fields, F.lit("arguments")).alias("arguments"))


def parse_tool_calls(text) -> Column:
    """Calls found in a model answer as ``array<struct<name, arguments>>``.

    The text between the outermost square brackets is taken as the list; without
    square brackets the outermost braces are taken as a single call. Anything
    that is not valid JSON, or a list with an element that is not an object with
    a name, gives an empty array.
    """
    text = as_col(text)
    nothing = F.array().cast(TOOL_CALL)
    has_list = (F.instr(text, "[") > 0) & (F.instr(text, "]") > 0)

    def listed_calls(listed: Column) -> Column:
        # nested values stay JSON text; an element that is no object comes out as NULL
        elements = F.when(is_json(listed), F.from_json(listed, "array<map<string,string>>"))

        def checked(items: Column) -> Column:
            nameless = F.exists(items, lambda f: f.isNull() | ~F.map_contains_key(f, "name"))
            return F.when(F.coalesce(~nameless, F.lit(False)), F.transform(items, _call).cast(TOOL_CALL)).otherwise(nothing)

        return bind(elements, checked)

    def single_call(single: Column) -> Column:
        fields = F.when(is_json(single), F.from_json(single, "map<string,string>"))
        return bind(fields, lambda f: F.when(f.isNotNull(), F.array(_call(f)).cast(TOOL_CALL)).otherwise(nothing))

    return F.when(has_list, bind(_between_brackets(text, "[", "]"), listed_calls)).otherwise(
        bind(_between_brackets(text, "{", "}"), single_call))


def call_names(calls) -> Column:
    """Set of called names in a comparable order."""
    return F.array_sort(F.array_distinct(F.transform(as_col(calls), lambda c: F.coalesce(c["name"], F.lit("")))))


def same_set(a, b) -> Column:
    """Equality of two arrays as sets."""
    return F.array_sort(F.array_distinct(as_col(a))) == F.array_sort(F.array_distinct(as_col(b)))


def valid_dataset_row(query, tools) -> Column:
    """Query and tools present and not empty, tools readable as JSON."""
    query, tools = as_col(query), as_col(tools)
    present = query.isNotNull() & (F.length(query) > 0) & tools.isNotNull() & (F.length(tools) > 0)
    return F.coalesce(present & is_json(tools), F.lit(False))


def _json_layout(indent: int | None):
    """Re-print JSON text with key order kept; Spark's own printer sorts keys and indents differently."""

    @F.pandas_udf("string")
    def layout(texts: pd.Series) -> pd.Series:
        def reprint(text):
            try:
                return json.dumps(json.loads(text), indent=indent)
            except (TypeError, ValueError):
                return None

        return texts.map(reprint)

    return layout


def tool_prompt(query, tools, answers=None) -> Column:
    """Function-calling prompt around a tool list; with ``answers`` the training form.

    NULL when one of the JSON texts cannot be read.
    """
    pieces = [F.lit(fx.TOOL_PROMPT_HEAD), _json_layout(2)(as_col(tools)), F.lit(fx.TOOL_PROMPT_MIDDLE),
              as_col(query), F.lit(fx.TOOL_PROMPT_TAIL)]
    if answers is not None:
        pieces += [F.lit(" "), _json_layout(None)(as_col(answers))]
    return F.concat(*pieces)
