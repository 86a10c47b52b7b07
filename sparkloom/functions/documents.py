"""Semi-structured values: JSON text, maps, topics and messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import as_col

STRING_MAP = "map<string,string>"


def json_field(c, name: str, dtype: str, default=None) -> Column:
    """A top-level field of a JSON text, cast leniently, with a default."""
    value = F.get_json_object(as_col(c), f"$.{name}").try_cast(dtype)
    return value if default is None else F.coalesce(value, F.lit(default).cast(dtype))


def rest_as_map(payload, known: list[str]) -> Column:
    """All top-level keys outside ``known``, values as text."""
    whole = F.from_json(as_col(payload), STRING_MAP)
    return F.map_filter(whole, lambda key, _: ~key.isin(known))


def map_to_json(m) -> Column:
    """JSON text of a map, NULL when it is empty or NULL."""
    m = as_col(m)
    return F.when(F.size(m) > 0, F.to_json(m))


def json_to_map(s) -> Column:
    return F.from_json(as_col(s), STRING_MAP)


def enrich_map(m, entries: dict[str, Column]) -> Column:
    """Add entries as text; a key that is already there is replaced."""
    m = F.coalesce(as_col(m), F.from_json(F.lit("{}"), STRING_MAP))
    names = list(entries)
    added = F.map_from_arrays(F.array(*[F.lit(n) for n in names]),
                              F.array(*[entries[n].cast("string") for n in names]))
    kept = F.map_filter(m, lambda key, _: ~key.isin(names))
    return F.map_concat(kept, added)


def topic_part(topic, position: int, fallback: str = "unknown") -> Column:
    """Part of a ``/``-separated topic; counts from 0, negative from the end."""
    parts = F.split(as_col(topic), "/")
    index = position if position < 0 else position + 1
    return F.coalesce(F.try_element_at(parts, F.lit(index)), F.lit(fallback))


def to_message(*columns) -> Column:
    """One JSON text per row out of the given columns."""
    return F.to_json(F.struct(*[as_col(c) for c in columns]))
