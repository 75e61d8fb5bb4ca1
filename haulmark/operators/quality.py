"""Data-quality reports: one row per check with violations, rows checked and verdict."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.operators.joins import union_all
from haulmark.sources.versioned import VersionedTable

REPORT = "check string, entity string, column string, violations bigint, total bigint, passed boolean"


@dataclass(frozen=True)
class Rule:
    """A named condition that marks a bad row."""

    name: str
    column: str
    bad: Column


def required(column: str) -> Rule:
    return Rule("required", column, F.col(column).isNull())


def one_of(column: str, values: list[str]) -> Rule:
    return Rule("enum", column, ~F.col(column).isin(values))


def at_least(column: str, low: float) -> Rule:
    return Rule("minimum", column, F.col(column) < low)


def at_most(column: str, high: float) -> Rule:
    return Rule("maximum", column, F.col(column) > high)


def within(column: str, low: float, high: float) -> Rule:
    return Rule("range", column, ~F.col(column).between(low, high))


def table_rules() -> dict[str, list[Rule]]:
    """Rules of the seven stored tables; missing optional values pass."""
    return {
        "vehicles": [
            *map(required, ("vehicle_id", "vehicle_type", "make", "model")),
            one_of("vehicle_type", ["Van", "Truck", "Pickup", "SUV"]),
            at_least("year", 2010),
            at_most("year", 2025),
            at_least("capacity_kg", 0),
            at_least("fuel_capacity", 0),
            one_of("status", ["Active", "Maintenance", "Retired"]),
        ],
        "drivers": [
            *map(required, ("driver_id", "name", "license_number")),
            at_least("experience_years", 0),
            at_least("rating", 0.0),
            at_most("rating", 5.0),
            one_of("status", ["Available", "OnRoute", "OnBreak", "OffDuty"]),
        ],
        "warehouses": [
            *map(required, ("warehouse_id", "name", "location", "location.latitude", "location.longitude")),
            at_least("capacity_sqft", 0),
        ],
        "customers": [
            *map(required, ("customer_id", "name", "location", "location.latitude", "location.longitude")),
            one_of("customer_type", ["Retail", "Wholesale", "Individual"]),
        ],
        "telemetry": [
            *map(required, ("vehicle_id", "timestamp", "latitude", "longitude")),
            at_least("speed", 0),
            at_least("fuel_level", 0),
            at_least("odometer", 0),
        ],
        "deliveries": [
            *map(required, ("delivery_id", "vehicle_id", "driver_id")),
            one_of("status", ["InProgress", "Completed", "Cancelled"]),
        ],
        "incidents": [
            *map(required, ("incident_id", "vehicle_id", "timestamp")),
            one_of(
                "incident_type",
                ["harsh_braking", "harsh_acceleration", "speeding", "sharp_turn", "idling_excessive"],
            ),
            one_of("severity", ["Low", "Medium", "High"]),
        ],
    }


def broken_rules(rules: list[Rule]) -> Column:
    """Names of the rules a row breaks."""
    return F.array_compact(F.array(*[F.when(r.bad, F.lit(f"{r.name}:{r.column}")) for r in rules]))


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and quarantined rows with the rules they break."""
    tagged = df.withColumn("broken_rules", broken_rules(rules))
    valid = tagged.filter(F.size("broken_rules") == 0).drop("broken_rules")
    return valid, tagged.filter(F.size("broken_rules") > 0)


def rule_report(df: DataFrame, entity: str, rules: list[Rule], check: str | None = None) -> DataFrame:
    """All rules of one table in a single pass."""
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(r.bad).alias(f"r{i}") for i, r in enumerate(rules)])
    lines = [
        F.struct(F.lit(check or r.name).alias("check"), F.lit(r.column).alias("column"), F.col(f"r{i}").alias("violations"))
        for i, r in enumerate(rules)
    ]
    return counts.select("total", F.inline(F.array(*lines))).select(
        "check", F.lit(entity).alias("entity"), "column", "violations", "total", (F.col("violations") == 0).alias("passed")
    )


def reports(tables: dict[str, DataFrame], rules: dict[str, list[Rule]], check: str | None = None) -> DataFrame:
    return union_all([rule_report(tables[e], e, rs, check) for e, rs in rules.items()])


def dq_nulls(tables: dict[str, DataFrame]) -> DataFrame:
    return reports(
        tables,
        {"vehicles": [required("vehicle_id")], "drivers": [required("driver_id")], "telemetry": [required("speed")]},
        "nulls",
    )


def dq_missing(tables: dict[str, DataFrame]) -> DataFrame:
    return reports(
        tables,
        {
            "vehicles": [required("vehicle_id")],
            "drivers": [required("driver_id")],
            "warehouses": [required("location")],
            "customers": [required("location")],
        },
        "missing",
    )


def dq_outliers(tables: dict[str, DataFrame], speed_max: float = 200) -> DataFrame:
    return reports(tables, {"telemetry": [at_most("speed", speed_max), at_least("fuel_level", 0)]}, "outliers")


def dq_ranges(tables: dict[str, DataFrame], speed_max: float = 120) -> DataFrame:
    gps = [within("latitude", 24, 38), within("longitude", 60, 78)]
    return reports(tables, {"telemetry": [*gps, within("speed", 0, speed_max)]}, "ranges")


def dq_schema_rules(tables: dict[str, DataFrame]) -> DataFrame:
    return reports(tables, table_rules())


def dq_duplicates(tables: dict[str, DataFrame], unique: dict[str, list[str]]) -> DataFrame:
    """Keys that occur more than once; total counts distinct keys."""
    out = []
    for entity, columns in unique.items():
        for column in columns:
            per_key = tables[entity].groupBy(column).agg(F.count("*").alias("n"))
            counts = per_key.agg(F.count_if(F.col("n") > 1).alias("violations"), F.count("*").alias("total"))
            out.append(_line(counts, "duplicates", entity, column))
    return union_all(out)


def _line(counts: DataFrame, check: str, entity: str, column: str) -> DataFrame:
    return counts.select(
        F.lit(check).alias("check"),
        F.lit(entity).alias("entity"),
        F.lit(column).alias("column"),
        F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"),
        F.coalesce("total", F.lit(0)).cast("bigint").alias("total"),
        (F.coalesce("violations", F.lit(0)) == 0).alias("passed"),
    )


# Foreign keys of the fact tables: fact, column, dimension.
FOREIGN_KEYS = (
    ("telemetry", "vehicle_id", "vehicles"),
    ("telemetry", "driver_id", "drivers"),
    ("deliveries", "vehicle_id", "vehicles"),
    ("deliveries", "driver_id", "drivers"),
    ("deliveries", "warehouse_id", "warehouses"),
    ("deliveries", "customer_id", "customers"),
    ("incidents", "vehicle_id", "vehicles"),
    ("incidents", "driver_id", "drivers"),
)


def _key_uses(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per fact, key column and key value, and whether the dimension holds it; each table is read once."""
    uses = []
    for fact in dict.fromkeys(f for f, _, _ in FOREIGN_KEYS):
        keys = F.array(
            *[
                F.struct(F.lit(column).alias("column"), F.lit(dim).alias("dim"), F.col(column).cast("bigint").alias("fk"))
                for f, column, dim in FOREIGN_KEYS
                if f == fact
            ]
        )
        uses.append(tables[fact].select(F.lit(fact).alias("entity"), F.inline(keys)))
    counts = union_all(uses).groupBy("entity", "column", "dim", "fk").agg(F.count("*").alias("rows"))
    dims = dict.fromkeys((dim, column) for _, column, dim in FOREIGN_KEYS)
    known = union_all(
        [tables[d].select(F.lit(d).alias("dim"), F.col(c).cast("bigint").alias("fk")) for d, c in dims]
    ).distinct()
    return counts.join(known.withColumn("known", F.lit(True)), ["dim", "fk"], "left")


def dq_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose key has no dimension row, one line per foreign key."""
    every = union_all([tables[f].sparkSession.range(1).select(F.lit(f).alias("entity"), F.lit(c).alias("column")) for f, c, _ in FOREIGN_KEYS])
    counts = _key_uses(tables).groupBy("entity", "column").agg(
        F.sum(F.when(F.col("known").isNull(), F.col("rows")).otherwise(0)).alias("violations"), F.sum("rows").alias("total")
    )
    lines = every.join(counts, ["entity", "column"], "left")
    violations, total = F.coalesce("violations", F.lit(0)), F.coalesce("total", F.lit(0))
    return lines.select(
        F.lit("foreign_key").alias("check"), "entity", "column", violations.cast("bigint").alias("violations"),
        total.cast("bigint").alias("total"), (violations == 0).alias("passed"),
    )


def fk_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Every orphan key with its table, column and number of rows."""
    return _key_uses(tables).filter(F.col("known").isNull()).select("entity", "column", "fk", "rows")


def expected_counts(counts: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Row counts against expected ones; tables without rows count 0."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame(list(expected.items()), "entity string, expected bigint")
    rows = F.coalesce(F.col("rows"), F.lit(0))
    return wanted.join(counts, "entity", "left").select(
        "entity", "expected", rows.alias("actual"), (rows == F.col("expected")).alias("passed")
    )


def dq_summary(report: DataFrame, counts: DataFrame, as_of: Column) -> DataFrame:
    """One line per run: rows per table, broken checks and the verdict."""
    names = ("vehicles", "drivers", "telemetry", "deliveries", "incidents")
    rows = counts.select(
        *[F.when(F.col("entity") == n, F.col("rows")).alias(n) for n in names], F.lit(None).cast("boolean").alias("ok")
    )
    verdicts = report.select(*[F.lit(None).cast("bigint").alias(n) for n in names], F.col("passed").alias("ok"))
    return (
        rows.unionByName(verdicts)
        .agg(*[F.max(n).alias(n) for n in names], F.count("ok").alias("checks"), F.count_if(~F.col("ok")).alias("failed"))
        .select(
            as_of.alias("run_at"),
            *names,
            "checks",
            "failed",
            F.when(F.col("failed") == 0, "passed").otherwise("failed").alias("quality_check"),
        )
    )


def record_run(history: VersionedTable, summary: DataFrame, run: str) -> bool:
    """Append the line of a run to the stored history; a run that is repeated leaves its first line."""
    return history.append(summary, run)


def expect(df: DataFrame, rules: list[Rule], strict: bool = False) -> DataFrame:
    """Rows with the rules they break; ``strict`` stops the job at the first broken row."""
    tagged = df.withColumn("broken_rules", broken_rules(rules))
    if not strict:
        return tagged
    text = F.concat(F.lit("broken rules: "), F.array_join("broken_rules", ", "))
    return tagged.filter(F.when(F.size("broken_rules") == 0, True).otherwise(F.raise_error(text).cast("boolean"))).drop(
        "broken_rules"
    )
