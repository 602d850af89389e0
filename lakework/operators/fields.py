"""What fields events have, and which control shows each (H8, H9), as a table that can be merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakework.operators import events


def _control(value: Column) -> Column:
    """The control for a variant: null for a JSON null, approx_date for an object with a date and a precision."""
    shape = F.schema_of_variant(value)
    dated = shape.startswith("OBJECT<") & F.try_variant_get(value, "$.date", "variant").isNotNull() & F.try_variant_get(value, "$.precision", "variant").isNotNull()
    numeric = shape.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(value.isNull() | F.is_variant_null(value), None).when(dated, "approx_date").when(shape == "BOOLEAN", "bool").when(numeric, "number").when(shape == "STRING", "text").otherwise("readonly")


def field_types(recs: DataFrame, place: Sequence[str] = ("segment", "line_no")) -> DataFrame:
    """H8: (event_type, field, seen_at, decided_at, control, n, n_null, shape) from all events of all records.

    ``control`` is of the first value that isn't null; ``shape`` is the type that all
    values fit.  One aggregation, partial before its shuffle, so an event type with most of
    the events is a row per field and task.  ``place`` orders records, across segments too;
    an event's own fields are in the order of their names.
    """
    rows = events.explode_events(recs)
    at = F.struct(*place, "type_order", "position")
    parsed = F.try_variant_get(F.try_parse_json("fields_json"), "$", "map<string, variant>")
    fields = rows.select("event_type", at.alias("at"), F.posexplode(parsed).alias("n", "field", "value")).withColumn("control", _control(F.col("value")))
    where = F.struct("at", "n")
    known = F.when(F.col("control").isNotNull(), where)
    return fields.groupBy("event_type", "field").agg(
        F.min(where).alias("seen_at"), F.min(known).alias("decided_at"), F.min_by("control", known).alias("control"),
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("control").isNull()).alias("n_null"), F.schema_of_variant_agg("value").alias("shape"),
    )


def merge_types(tables: Sequence[DataFrame]) -> DataFrame:
    """``field_types`` of several segments as of one: counts add up, the earliest value decides.

    ``shape`` stays where the segments agree (a VOID, all nulls, agrees with any) and is VARIANT elsewhere.
    """
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    shapes = F.array_distinct(F.filter(F.collect_set("shape"), lambda s: s != "VOID"))
    merged = out.groupBy("event_type", "field").agg(
        F.min("seen_at").alias("seen_at"), F.min("decided_at").alias("decided_at"), F.min_by("control", "decided_at").alias("control"),
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), shapes.alias("_s"),
    )
    shape = F.when(F.size("_s") == 0, "VOID").when(F.size("_s") == 1, F.col("_s")[0]).otherwise("VARIANT")
    return merged.withColumn("shape", shape).drop("_s")


def as_schema(types: DataFrame) -> dict[str, dict]:
    """H8: the field schema of ``field_types``, fields in first-seen order; bounded by the fields' names, not by rows."""
    out: dict[str, dict] = {}
    for r in types.orderBy("seen_at").select("event_type", "field", "control").collect():
        entry = {"name": r.field, "label": r.field.replace("_", " ").title(), "control": r.control or "text", "required": False, "options": [], "default": None}
        out.setdefault(r.event_type, {"fields": []})["fields"].append(entry)
    return out
