"""JSON documents of unknown shape: find their fields and expand them.

A document is parsed once into a VARIANT; fields are found by a chain of
generators (one per level of nesting), so listing the fields of a table is
one scan and one aggregation by path, with partial aggregation before the
exchange.  No schema is inferred from a sample.

Paths are JSON paths: ``$.sensors.water_ph``, ``$.a['odd key']``, and
``[*]`` for the elements of an array.  Text that is not JSON (or names a
key twice) gives a NULL document, which has no field.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import PipelineSpec

LEAF_COLUMNS = ["path", "kind", "number", "text"]

#: Type that a field expands to; fields of several kinds become text.
_EXPANDED = {"number": "double", "text": "string", "boolean": "boolean"}


def with_document(df: DataFrame, value: str = "value", doc: str = "doc") -> DataFrame:
    """Add ``doc``: the JSON text of ``value`` as a VARIANT, else NULL."""
    return df.withColumn(doc, F.try_parse_json(F.col(value).cast("string")))


def _step():
    key = F.col("key")
    plain = F.concat(F.lit("."), key)
    quoted = F.when(F.contains(key, F.lit("'")), F.concat(F.lit('["'), key, F.lit('"]'))).otherwise(
        F.concat(F.lit("['"), key, F.lit("']"))
    )
    named = F.when(key.rlike("^[A-Za-z_][A-Za-z0-9_]*$"), plain).otherwise(quoted)
    return F.when(key.isNotNull(), named).when(F.col("pos").isNotNull(), F.lit("[*]")).otherwise(F.lit(""))


def _kind(leaf: str):
    shape = F.schema_of_variant(leaf)
    return (
        F.when(F.is_variant_null(leaf), "null")
        .when(shape.startswith("OBJECT"), "object")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "STRING", "text")
        .otherwise("number")
    )


def leaf_fields(df: DataFrame, doc: str = "doc", *, depth: int = 8, keep: Sequence[str] = ()) -> DataFrame:
    """One row per leaf of every document: ``path``, ``kind`` (number, text,
    boolean, null, object, array), ``number`` and ``text`` (the value as
    JSON text, strings bare).  Leaves are scalars, JSON nulls, empty containers and
    whatever lies ``depth`` levels deep.  Columns in ``keep`` are carried
    along under names other than these four."""
    if clash := set(keep) & set(LEAF_COLUMNS):
        raise ValueError(f"leaf_fields: columns named as the result's: {sorted(clash)}")
    kept = F.struct(F.lit(0).alias("_"), *[F.col(c) for c in keep]).alias("kept")
    rows = df.where(F.col(doc).isNotNull()).select(kept, F.lit("$").alias("path"), F.col(doc).alias("leaf"))
    explode = df.sparkSession.tvf.variant_explode_outer
    for _ in range(depth):
        # a leaf explodes to one row of NULLs and stays as it is
        rows = rows.lateralJoin(explode(F.col("leaf").outer())).select(
            "kept", F.concat("path", _step()).alias("path"), F.coalesce("value", "leaf").alias("leaf")
        )
    kind = _kind("leaf")
    text = F.when(kind.isin("object", "array"), F.to_json("leaf")).otherwise(F.try_variant_get("leaf", "$", "string"))
    return rows.select(
        *[F.col(f"kept.`{c}`") for c in keep],
        "path",
        kind.alias("kind"),
        F.when(kind == "number", F.try_variant_get("leaf", "$", "double")).alias("number"),
        text.alias("text"),
    )


def field_inventory(df: DataFrame, doc: str = "doc", *, depth: int = 8) -> DataFrame:
    """Every (path, kind) with its number of values and, of numbers, the range."""
    return leaf_fields(df, doc, depth=depth).groupBy("path", "kind").agg(
        F.count(F.lit(1)).alias("n_values"), F.min("number").alias("min_value"), F.max("number").alias("max_value")
    )


def discover_fields(inventory: DataFrame, *, max_fields: int = 1000) -> dict[str, str]:
    """Path -> type of every scalar field outside arrays.

    This brings the paths to the driver, as a schema must; documents with ids
    for keys could have any number, so more than ``max_fields`` is an error."""
    scalar = F.col("kind").isin(*_EXPANDED) & ~F.contains("path", F.lit("[*]")) & (F.col("path") != "$")
    kinds = inventory.where(scalar).groupBy("path").agg(F.collect_set("kind").alias("kinds"))
    found = kinds.take(max_fields + 1)
    if len(found) > max_fields:
        raise ValueError(f"more than {max_fields} different fields: name the ones to expand")
    return {r.path: _EXPANDED[r.kinds[0]] if len(r.kinds) == 1 else "string" for r in sorted(found)}


def field_names(paths: Sequence[str]) -> dict[str, str]:
    """Path -> column name: words joined by ``_``, numbered where two agree."""
    names, taken = {}, set()
    for path in sorted(paths):
        name = base = re.sub(r"\W+", "_", path).strip("_") or "field"
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        names[path] = name
    return names


def expand_fields(df: DataFrame, fields: dict[str, str], doc: str = "doc", *, keep: Sequence[str] = ()) -> DataFrame:
    """One column per path of ``fields`` (path -> type) beside ``keep``; NULL
    where a document lacks the field or holds another type there.  A field
    named like a kept column is numbered."""
    names = field_names(fields)
    taken = {c.lower() for c in keep}
    columns = []
    for path, kind in sorted(fields.items()):
        name = names[path]
        while name.lower() in taken:
            name += "_2"
        taken.add(name.lower())
        columns.append(F.try_variant_get(doc, path, kind).alias(name))
    return df.select(*[F.col(f"`{c}`") for c in keep], *columns)


def unknown_sensor_points(envelopes: DataFrame, spec: PipelineSpec, measurement: str = "raw_sensor_data") -> DataFrame:
    """Long points (measurement, system_id, time, field, value) of the numbers
    under ``sensors`` that the spec does not name: what ``parse_readings``
    leaves out.  A nested field is named by its path."""
    docs = with_document(envelopes)
    told = F.timestamp_millis(F.try_variant_get("doc", "$.timestamp", "bigint"))
    docs = docs.select(
        F.coalesce(F.col("key").cast("string"), F.lit(spec.default_system)).alias("system_id"),
        F.coalesce(told, F.col("timestamp")).alias("time"),
        F.try_variant_get("doc", "$.sensors", "variant").alias("doc"),
    )
    found = leaf_fields(docs, keep=["system_id", "time"]).where(F.col("kind") == "number")
    plain = F.col("path").rlike(r"^\$\.[A-Za-z_][A-Za-z0-9_]*$")
    field = F.when(plain, F.substr("path", F.lit(3))).otherwise(F.col("path"))
    return found.select(F.lit(measurement).alias("measurement"), "system_id", "time", field.alias("field"), F.col("number").alias("value")).where(
        ~F.col("field").isin(*spec.sensor_names)
    )
