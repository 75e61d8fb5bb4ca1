"""Rules on raw JSON documents: types, allowed values and bounds per path, before any schema is forced on them.

A reader with a schema turns a value of the wrong type into NULL, which then
looks like a missing one. Here documents are parsed as variants, so each value
keeps the type that it was written with. JSON has no dates and one kind of
number: a date is a text that reads as a time, and an int may stand for a double.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.sources.versioned import VersionedTable


@dataclass(frozen=True)
class Path:
    """What may stand under a path of a document."""

    name: str
    kind: str | None = None
    required: bool = False
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None

    def checks(self) -> list[str]:
        wanted = {
            "required": self.required, "type": self.kind, "enum": self.values, "minimum": self.low is not None,
            "maximum": self.high is not None,
        }
        return [name for name, asked in wanted.items() if asked]


def _texts(*names: str, required: bool = True) -> list[Path]:
    return [Path(n, "string", required) for n in names]


PLACE = [Path("location", "object", True), Path("location.latitude", "number", True), Path("location.longitude", "number", True)]

# Rules of the seven stored tables.
DOCUMENTS: dict[str, list[Path]] = {
    "vehicles": [
        *_texts("vehicle_id", "make", "model"),
        Path("vehicle_type", required=True, values=("Van", "Truck", "Pickup", "SUV")),
        Path("year", "int", low=2010, high=2025),
        Path("capacity_kg", "int", low=0),
        Path("fuel_capacity", "int", low=0),
        Path("status", values=("Active", "Maintenance", "Retired")),
    ],
    "drivers": [
        *_texts("driver_id", "name", "license_number"),
        Path("experience_years", "int", low=0),
        Path("rating", "number", low=0, high=5),
        Path("status", values=("Available", "OnRoute", "OnBreak", "OffDuty")),
    ],
    "warehouses": [*_texts("warehouse_id", "name"), *PLACE, *_texts("city", required=False), Path("capacity_sqft", "int", low=0)],
    "customers": [
        *_texts("customer_id", "name"), *PLACE, *_texts("city", required=False),
        Path("customer_type", values=("Retail", "Wholesale", "Individual")),
    ],
    "telemetry": [
        *_texts("vehicle_id"),
        Path("timestamp", "date", True),
        *[Path(n, "number", True) for n in ("latitude", "longitude")],
        *[Path(n, "number", low=0) for n in ("speed", "fuel_level", "odometer")],
        Path("engine_temp", "number"),
    ],
    "deliveries": [
        *_texts("delivery_id", "vehicle_id", "driver_id"), *_texts("warehouse_id", "customer_id", required=False),
        Path("status", values=("InProgress", "Completed", "Cancelled")),
    ],
    "incidents": [
        *_texts("incident_id", "vehicle_id"),
        Path("timestamp", "date", True),
        Path("incident_type", values=("harsh_braking", "harsh_acceleration", "speeding", "sharp_turn", "idling_excessive")),
        Path("severity", values=("Low", "Medium", "High")),
    ],
}


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is computed a single time, however often it is named and wherever the plan puts it."""
    return F.get(F.transform(F.array(value), use), 0)


def _is(kind: str, item: Column, written: Column) -> Column:
    if kind == "int":
        return written == "BIGINT"
    if kind == "number":
        return written.isin("BIGINT", "DOUBLE", "FLOAT") | written.startswith("DECIMAL")
    if kind == "object":
        return written.startswith("OBJECT")
    text = F.try_variant_get(item, "$", "string")
    return (written == "STRING") & (F.try_to_timestamp(text).isNotNull() if kind == "date" else F.lit(True))


def _broken(item: Column, written: Column, path: Path) -> dict[str, Column]:
    there = item.isNotNull()
    number = F.when(_is("number", item, written), F.try_variant_get(item, "$", "double"))
    text = F.when(written == "STRING", F.try_variant_get(item, "$", "string"))
    every = {
        "required": ~there,
        "type": there & ~_is(path.kind, item, written) if path.kind else None,
        "enum": there & ~F.coalesce(text.isin(*path.values), F.lit(False)) if path.values else None,
        "minimum": number < path.low if path.low is not None else None,
        "maximum": number > path.high if path.high is not None else None,
    }
    return {check: every[check] for check in path.checks()}


def _item(fields: Column, name: str) -> Column:
    top, _, rest = name.partition(".")
    return F.try_variant_get(fields[top], f"$.{rest}", "variant") if rest else fields[top]


def _broken_fields(fields: Column, paths: list[Path]) -> Column:
    items = F.array(*[_item(fields, p.name) for p in paths])
    found = F.transform(items, lambda item: F.struct(item.alias("item"), F.schema_of_variant(item).alias("written")))

    def rules(found: Column) -> Column:
        out = []
        for i, p in enumerate(paths):
            bad = _broken(found[i]["item"], found[i]["written"], p)
            out += [F.when(hit, F.lit(f"{check}:{p.name}")) for check, hit in bad.items()]
        return F.array_compact(F.array(*out))

    return F.when(fields.isNotNull(), _once(found, rules)).otherwise(F.array(F.lit("json:$")))


def broken_paths(value: Column, paths: list[Path]) -> Column:
    """`check:path` of every rule that a document breaks; `json:$` for a text that is no JSON object."""
    tops = dict.fromkeys(p.name.partition(".")[0] for p in paths)
    kind = f"struct<{', '.join(f'`{t}`: variant' for t in tops)}>"
    fields = F.try_variant_get(F.try_parse_json(value), "$", kind)  # NULL unless the text is an object
    return _once(fields, lambda fields: _broken_fields(fields, paths))


def tagged(documents: DataFrame, rules: dict[str, list[Path]] = DOCUMENTS) -> DataFrame:
    """entity, value -> with the rules that each document breaks; documents of unknown entities break none."""
    broken = F.array().cast("array<string>")
    for entity, paths in rules.items():
        broken = F.when(F.col("entity") == entity, broken_paths(F.col("value"), paths)).otherwise(broken)
    return documents.withColumn("broken_rules", broken)


def rule_counts(checked: DataFrame, rules: dict[str, list[Path]] = DOCUMENTS) -> DataFrame:
    """One line per rule with violations, documents checked and verdict, from one pass over tagged documents."""
    lines = [(e, "json", "$") for e in rules] + [(e, c, p.name) for e, paths in rules.items() for p in paths for c in p.checks()]
    # The rule "" stands for every document, so totals come out of the same aggregate.
    lines += [(e, "", "") for e in rules]
    wanted = checked.sparkSession.createDataFrame(lines, "entity string, check string, path string")
    names = F.explode(F.concat(F.array(F.lit("")), "broken_rules"))
    counts = checked.select("entity", names.alias("rule")).groupBy("entity", "rule").agg(F.count("*").alias("n"))
    every = F.col("check") == ""
    rule = F.when(every, "").otherwise(F.concat_ws(":", "check", "path"))
    total = F.max(F.when(every, F.col("n"))).over(Window.partitionBy("entity"))
    found = wanted.withColumn("rule", rule).join(counts, ["entity", "rule"], "left").withColumn("total", total).filter(~every)
    violations = F.coalesce("n", F.lit(0))
    return found.select(
        "check", "entity", F.col("path").alias("column"), violations.alias("violations"),
        F.coalesce("total", F.lit(0)).alias("total"), (violations == 0).alias("passed"),
    )


def quarantine(checked: DataFrame, table: VersionedTable, run: str) -> DataFrame:
    """Store the documents that break a rule, once for each run, and return the others."""
    table.append(checked.filter(F.size("broken_rules") > 0).withColumn("run", F.lit(run)), run)
    return checked.filter(F.size("broken_rules") == 0).drop("broken_rules")
