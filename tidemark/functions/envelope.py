"""Identities of observations and events, and what is told of their coverage and origin as JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.identity import fingerprint, row_id

# The metrics and components an envelope tells of, and the words that mean a component is there.
METRICS = ("like_count", "view_count", "comment_count", "reply_count", "retweet_count", "bookmark_count", "score", "follower_count", "subscriber_count", "subreddit_member_count")
COMPONENTS = {"metadata": "metadata_status", "transcript": "transcript_lifecycle_status", "comments": "comments_status"}
PRESENT = ("available", "success")
PROVENANCE = ("api_endpoint", "collection_method", "collector_version", "event_type", "event_version", "observed_at", "producer_name", "producer_run_id", "source", "source_payload_version")


def canonical(fields: dict[str, Column]) -> Column:
    """The fields as JSON with names in order; unknown ones are null, not left out."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def first_known(*fields: Column) -> Column:
    """The first field that is neither null nor empty, as text."""
    return F.coalesce(*[F.when(F.trim(f.cast("string")) != "", f.cast("string")) for f in fields])


def supplied(value: Column) -> Column:
    """A SHA-256 that came with the event, in lower case; null if it is none."""
    return F.when(F.trim(value).rlike("^[0-9a-fA-F]{64}$"), F.lower(F.trim(value)))


def coverage(columns: list[str]) -> dict[str, Column]:
    """F8: for each metric and component whether it was observed, by its own flag where there is one; a known zero is observed. What has no column was not."""
    none = F.lit(None)
    col = lambda c, kind: F.col(c).cast(kind) if c in columns else none.cast(kind)
    told = {m: F.coalesce(col(f"{m}_available", "boolean"), col(m, "string").isNotNull()) for m in METRICS}
    parts = {c: F.coalesce(col(f"{c}_available", "boolean"), F.coalesce(F.lower(F.trim(col(status, "string"))), F.lit("")).isin(*PRESENT)) for c, status in COMPONENTS.items()}
    return told | parts


def with_envelope(rows, payload: list[str], producer: str, run: str):
    """F8: rows (``source``, ``platform_event_id``, ``observed_at`` and what else of an envelope they have) with ``coverage_json``, ``provenance_json``,
    ``payload_fingerprint``, ``observation_id`` and ``event_id``; valid ids that came with a row stay.

    The fingerprint is of the ``payload`` columns that are known, so a column that is added later and is null changes no identity.
    """
    names = rows.columns
    col = lambda c: F.col(c).cast("string") if c in names else F.lit(None).cast("string")
    rows = rows.withColumns({"producer_name": first_known(col("producer_name"), F.lit(producer)), "producer_run_id": first_known(col("producer_run_id"), F.lit(run))})
    rows = rows.withColumns({
        "coverage_json": canonical(coverage(names)),
        "provenance_json": canonical({n: F.col(n).cast("string") if n in rows.columns else F.lit(None).cast("string") for n in PROVENANCE}),
        "payload_fingerprint": F.coalesce(supplied(col("payload_fingerprint")), fingerprint(**{c: F.col(c) for c in payload})),
        "observation_id": F.coalesce(supplied(col("observation_id")), row_id(col("source"), first_known(col("platform_event_id"), col("video_id"), col("url")), first_known(col("observed_at"), col("collected_at"), col("timestamp")))),
    })
    return rows.withColumn("event_id", F.coalesce(supplied(col("event_id")), row_id(F.lit("event-v1"), F.col("observation_id"), col("event_type"), F.col("payload_fingerprint"))))


def example_id(source: Column, post: Column, observation: Column, horizon: str, version: Column) -> Column:
    """the id of a training example: of a post, the reading its label is from, the horizon, and the features' version."""
    return row_id(source, post, observation, F.lit(horizon), F.coalesce(version, F.lit("unknown")))


def context_snapshot(*columns: str) -> Column:
    """what was known when an example was made, as JSON in the columns' order; unknown fields are left out."""
    return F.to_json(F.struct(*columns))


def completeness(checks: dict[str, Column]) -> tuple[Column, Column]:
    """how many of the checks hold (null does not), and the names of the others in order."""
    holds = {n: F.coalesce(c, F.lit(False)) for n, c in checks.items()}
    return reduce(lambda a, b: a + b, [c.cast("int") for c in holds.values()]), F.concat_ws(", ", F.array_compact(F.array(*[F.when(~c, F.lit(n)) for n, c in holds.items()])))


def coverage_summary(json: Column, metrics: dict[str, tuple[str, Column, Column]]) -> Column:
    """how many metrics were observed and which were not, each a label, value and flag by its name. Where the flag is null the coverage JSON tells; a null value was never observed."""
    flags = {}
    for name, (label, value, flag) in metrics.items():
        encoded = F.coalesce(F.get_json_object(json, f"$.{name}_available"), F.get_json_object(json, f"$.{name}")).cast("boolean")
        flags[label] = value.isNotNull() & F.coalesce(flag, encoded, F.lit(True))
    known, lacking = completeness(flags)
    return F.concat(known.cast("string"), F.lit(f"/{len(flags)} snapshot metrics observed"), F.when(lacking != "", F.concat(F.lit("; N/A: "), lacking)).otherwise(""))


def provenance_summary(json: Column, **direct: Column) -> Column:
    """producer, method, endpoint and run, each from its column or else from the provenance JSON, once each; N/A if none is known."""
    order = ("producer_name", "collection_method", "api_endpoint", "producer_run_id")
    found = [F.trim(first_known(*([direct[n]] if n in direct else []), F.get_json_object(json, f"$.{n}"))) for n in order]
    text = F.concat_ws(" · ", F.array_distinct(F.array_compact(F.array(*found))))
    return F.when(text == "", "N/A").otherwise(text)
