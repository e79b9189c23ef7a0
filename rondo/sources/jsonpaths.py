"""Bulk staging of nested JSON by an outside JSONPaths document.

The document lists one path per target column, in the order of the columns: ``{"jsonpaths": ["$.user.id", "$['play'][0]"]}``. A path
goes down by names, as ``.name`` or ``['name']``, and by places in arrays, as ``[0]``. The paths become a read schema, so the reader
parses only the fields they name, and one column expression each.

Defined cases: a path that a record doesn't have gives null, as does a place beyond the end of an array. A path that ends at an object or
array gives its JSON text if the column is text. A malformed record, a malformed path, a path that goes below another one's end, and a
document of another length than the columns stop the load. A path that no record has gives a column of nulls: ``require_found``
stops at it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from rondo.functions.clean import blank_to_null

Step = str | int
_STEP = re.compile(r"\.([^.\[\]'\"\s]+)|\['([^']+)'\]|\[\"([^\"]+)\"\]|\[(\d+)\]")


def read_paths(spark: SparkSession, path: str) -> list[str]:
    """The paths of a stored document, a small file."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    try:
        paths = json.loads(text)["jsonpaths"]
    except (ValueError, KeyError, TypeError) as error:
        raise ValueError(f"{path} is no JSONPaths document") from error
    if not isinstance(paths, list) or not all(isinstance(p, str) for p in paths):
        raise ValueError(f"{path} is no JSONPaths document: jsonpaths must be a list of texts")
    return paths


def parse_path(path: str) -> list[Step]:
    """The names and places of a path, which starts with a name."""
    steps: list[Step] = []
    at = 1
    while path.startswith("$") and at < len(path):
        found = _STEP.match(path, at)
        if not found:
            break
        steps.append(int(found[4]) if found[4] is not None else found[1] or found[2] or found[3])
        at = found.end()
    if at != len(path) or not steps or isinstance(steps[0], int):
        raise ValueError(f"not a path this reader knows: {path!r}")
    return steps


def read_schema(paths: Sequence[list[Step]], types: Sequence[DataType]) -> StructType:
    """The schema in which the JSON reader finds all paths, each ending in its column's type."""
    tree: dict = {}
    for steps, kind in zip(paths, types):
        node = tree
        for step in steps[:-1]:
            node = node.setdefault("[]" if isinstance(step, int) else f".{step}", {})
            if not isinstance(node, dict):
                raise ValueError(f"a path goes on where another one ends: {steps}")
        last = "[]" if isinstance(steps[-1], int) else f".{steps[-1]}"
        if node.setdefault(last, kind) != kind:
            raise ValueError(f"a path ends where another one goes on or has another type: {steps}")

    def shaped(node: dict | DataType) -> DataType:
        if not isinstance(node, dict):
            return node
        if "[]" in node:
            if len(node) > 1:
                raise ValueError(f"both an array and an object: {sorted(node)}")
            return ArrayType(shaped(node["[]"]))
        return StructType([StructField(name[1:], shaped(below)) for name, below in node.items()])

    return shaped(tree)


def _value(steps: list[Step]) -> Column:
    value = F.col(f"`{steps[0]}`")
    for step in steps[1:]:
        value = F.get(value, F.lit(step)) if isinstance(step, int) else value.getField(step)
    return value


def stage_by_paths(
    spark: SparkSession, path: str | Sequence[str], jsonpaths: str, schema: StructType, clean_text: bool = True
) -> DataFrame:
    """JSON records as the columns of ``schema``, bound in their order to the paths of a stored document."""
    steps = [parse_path(p) for p in read_paths(spark, jsonpaths)]
    if len(steps) != len(schema):
        raise ValueError(f"{jsonpaths} has {len(steps)} paths for {len(schema)} columns")
    nested = read_schema(steps, [f.dataType for f in schema])
    records = spark.read.schema(nested).option("mode", "FAILFAST").json(path if isinstance(path, str) else list(path))
    loaded = records.select(*[_value(s).alias(f.name) for s, f in zip(steps, schema)])
    return blank_to_null(loaded) if clean_text else loaded


def require_found(staged: DataFrame) -> DataFrame:
    """The staged rows, or an error if a column of a table that isn't empty has no value in any row; reads them once."""
    counts = staged.agg(F.count(F.lit(1)), *[F.count(F.col(c)) for c in staged.columns]).first()
    absent = [c for c, n in zip(staged.columns, counts[1:]) if counts[0] and not n]
    if absent:
        raise ValueError(f"no record has the paths of {absent}")
    return staged
