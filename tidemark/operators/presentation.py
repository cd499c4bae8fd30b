"""Rows to be shown, with what older and other tables still know of them, and the overview of them all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import envelope
from tidemark.operators.reports import staleness
from tidemark.operators.upkeep import with_fallbacks


def _last(value: str, at: Column) -> Column:
    return F.max_by(F.when(F.col(value).isNotNull(), F.col(value)), F.when(F.col(value).isNotNull(), at))


def last_readings(readings: DataFrame, key: str, metrics: tuple[str, ...], carried: tuple[str, ...], time: str = "observed_at", tie: str = "event_id") -> DataFrame:
    """For each key the last known value of each metric by itself (``latest_...``), and of the last reading its time and the ``carried`` columns."""
    at = F.struct(time, tie)
    flags = {m: F.col(f"{m}_available") if f"{m}_available" in readings.columns else F.lit(None).cast("boolean") for m in metrics}
    readings = readings.withColumns({m: F.when(F.coalesce(f, F.lit(True)), F.col(m)) for m, f in flags.items()})
    out = readings.groupBy(key).agg(*[_last(m, at).alias(f"latest_{m}") for m in metrics], F.max(time).alias("latest_snapshot_at"), F.max_by(F.struct(*carried), at).alias("_c"))
    known = {f"latest_{m}_available": F.col(f"latest_{m}").isNotNull() for m in metrics}
    return out.select("*", *[F.col(f"_c.{c}").alias(c) for c in carried]).drop("_c").withColumns(known)


def last_events(events: DataFrame, key: str, columns: dict[str, str], time: str = "observed_at", tie: str = "event_id") -> DataFrame:
    """For each key the last known value of each column, under the name the shown row has for it."""
    at = F.struct(time, tie)
    return events.groupBy(key).agg(*[_last(c, at).alias(name) for c, name in columns.items()])


def display_rows(rows: DataFrame, key: str, *sources: DataFrame) -> DataFrame:
    """Rows whose unknown columns are filled from the first source, in order, that knows them; columns that only a source has are added.

    Each source has a row a key at most, so no join multiplies rows and all are partitioned alike.
    """
    kinds = {f.name: f.dataType for s in reversed(sources) for f in s.schema if f.name != key}
    missing = {c: F.lit(None).cast(k) for c, k in kinds.items() if c not in rows.columns}
    return with_fallbacks(rows.withColumns(missing) if missing else rows, key, *sources)


def told(rows: DataFrame, metrics: dict[str, str], checks: dict[str, Column], now: Column, stale_hours: dict[str, int]) -> DataFrame:
    """what is known and lacking of each row, its coverage and origin in words, and a warning for each time that is missing or too old."""
    known, lacking = envelope.completeness(checks)
    cover = {m: (label, F.col(f"latest_{m}"), F.col(f"latest_{m}_available")) for m, label in metrics.items()}
    late = [F.when(staleness(F.col(c), now, h) != "fresh", F.concat(F.lit(f"{c} "), staleness(F.col(c), now, h))) for c, h in stale_hours.items()]
    warnings = F.concat_ws("; ", F.array_compact(F.array(*late)))
    return rows.withColumns({"known": known, "lacking": lacking, "coverage": envelope.coverage_summary(F.col("coverage_json"), cover), "provenance": envelope.provenance_summary(F.col("provenance_json")), "warnings": F.when(warnings == "", "None").otherwise(warnings)})


def overview(rows: DataFrame, slices: dict[str, Column], identifier: str, metrics: tuple[str, ...]) -> DataFrame:
    """Rows, different identifiers, rows with any reading, and each metric's sum and coverage in percent, by every slice of every section.

    A row is dealt to its slice of each section and all is one aggregation that begins before the shuffle. A slice that is null is ``unknown``; a sum of which nothing is known is null.
    """
    dealt = F.array(*[F.struct(F.lit(n).alias("section"), F.coalesce(c.cast("string"), F.lit("unknown")).alias("slice")) for n, c in slices.items()])
    any_known = reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in metrics])
    each = rows.select(identifier, *metrics, F.explode(dealt).alias("_s")).select("_s.*", identifier, *metrics)
    out = each.groupBy("section", "slice").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(identifier).alias("identifiers"), F.count_if(any_known).alias("with_reading"),
        *[F.sum(m).cast("long").alias(m) for m in metrics], *[F.round(F.count(m) * 100.0 / F.count(F.lit(1)), 6).alias(f"{m}_pct") for m in metrics],
    )
    return out
