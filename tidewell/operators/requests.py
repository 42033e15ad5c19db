"""Request plans: one row per request, rendered from a stream's templates."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import RequestSpec

_PLACE = re.compile(r"\{\{\s*([a-zA-Z_][a-zA-Z0-9_]*(?:\.[a-zA-Z_][a-zA-Z0-9_]*)*)\s*\}\}")
_ABSENT = object()


def _lookup(tree: Any, keys: list[str]) -> Any:
    for key in keys:
        if not isinstance(tree, dict) or key not in tree:
            return _ABSENT
        tree = tree[key]
    return tree


def _text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"))


def render(template: str, config: dict[str, Any], variables: dict[str, Any]) -> Column:
    """A template as a column.

    ``config`` and ``vars`` are known when the plan is built and become literals.
    ``partition.x`` reads the ``values`` map of the row and ``state.cursor`` its
    ``cursor`` column. Names without a root are sought in config, then in vars.
    An undefined name fails the job.
    """
    parts: list[Column] = []
    end = 0
    for place in _PLACE.finditer(template):
        if place.start() > end:
            parts.append(F.lit(template[end : place.start()]))
        end = place.end()
        parts.append(_value(place[1], config, variables))
    if end < len(template) or not parts:
        parts.append(F.lit(template[end:]))
    return F.concat(*parts)


def _value(name: str, config: dict[str, Any], variables: dict[str, Any]) -> Column:
    root, *rest = name.split(".")
    missing = F.raise_error(F.lit(f"undefined template variable: {name}"))
    if root == "partition":
        if not rest:
            return F.to_json("values")
        key = ".".join(rest)
        found = F.coalesce(F.try_element_at(F.col("values"), F.lit(key)), F.lit(""))
        return F.when(F.map_contains_key("values", key), found).otherwise(missing.cast("string"))
    if root == "state":
        if rest != ["cursor"]:
            raise ValueError(f"undefined template variable: {name}")
        return F.coalesce("cursor", F.lit(""))
    if root in ("config", "vars"):
        value = _lookup(config if root == "config" else variables, rest)
    else:
        value = _lookup(config, [root, *rest])
        if value is _ABSENT:
            value = _lookup(variables, [root, *rest])
    if value is _ABSENT:
        raise ValueError(f"undefined template variable: {name}")
    return F.lit(_text(value))


def request_plan(
    partitions: DataFrame,
    specs: list[RequestSpec],
    config: dict[str, Any] | None = None,
    variables: dict[str, Any] | None = None,
) -> DataFrame:
    """One request per partition of each stream: URL and parameters, empty ones dropped.

    The templates are part of the plan, so this is a map over the partitions
    without a join.
    """
    config, variables = config or {}, variables or {}
    if "cursor" not in partitions.columns:
        partitions = partitions.withColumn("cursor", F.lit(None).cast("string"))
    url, params = None, None
    for spec in specs:
        this = F.col("stream") == spec.stream
        target = F.concat(F.lit(spec.url.rstrip("/")), render(spec.path, config, variables))
        pairs = [c for k, v in spec.params.items() for c in (F.lit(k), render(v, config, variables))]
        given = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
        filled = F.map_filter(given, lambda _, v: v != "")
        url = F.when(this, target) if url is None else url.when(this, target)
        params = F.when(this, filled) if params is None else params.when(this, filled)
    known = partitions.filter(F.col("stream").isin(*[s.stream for s in specs]))
    return known.select("stream", "partition_id", url.alias("url"), params.alias("params"))
