"""Deterministic identities and fingerprints: SHA-256 over fields joined by U+001F."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "\u001f"


def salted(salt: str, value: Column) -> Column:
    """a person's id as a salted hash; null stays null."""
    return F.when(value.isNotNull(), F.sha2(F.concat_ws(":", F.lit(salt), value), 256))


def row_id(*fields: Column) -> Column:
    """An id of fields, absent ones empty."""
    return F.sha2(F.concat_ws(SEP, *[F.coalesce(f.cast("string"), F.lit("")) for f in fields]), 256)


def content_id(source: Column, platform_id: Column) -> Column:
    """F14."""
    return F.sha2(F.concat_ws(":", source, platform_id), 256)


def fingerprint(**fields: Column) -> Column:
    """a hash of the fields as JSON with names in order; null fields are left out."""
    return F.sha2(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])), 256)


def rejected(value: Column) -> Column:
    """What is kept of a rejected payload: that it was redacted, its bytes and its hash."""
    return F.to_json(F.struct(F.lit(True).alias("redacted"), F.octet_length(value).alias("byte_length"), F.sha2(value.cast("binary"), 256).alias("sha256")))


def result_id(*fields: Column) -> Column:
    """F49."""
    return row_id(*fields)


def overall_status(statuses: Column) -> Column:
    """failed if all failed, partial if some did, success otherwise; null for none."""
    bad = F.size(F.filter(statuses, lambda s: s.isin("failed", "error", "permanent_error")))
    return F.when(F.size(statuses) == 0, None).when(bad == F.size(statuses), "failed").when(bad > 0, "partial").otherwise("success")


def normalised_list(items: Column) -> Column:
    """the items of a set-like field, without blanks and repeats, in order; null if nothing is left."""
    kept = F.array_sort(F.array_distinct(F.filter(F.transform(items, lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")))
    return F.when(F.size(kept) > 0, kept)


def changed_fields(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """the names, in order, of the fields that differ, null-safely."""
    return F.array_compact(F.array(*[F.when(~before[n].eqNullSafe(after[n]), F.lit(n)) for n in sorted(after)]))


def transcript_version(video: Column, language: Column, text: Column) -> Column:
    """a version of a transcript's words: the same for every collection and timing of them."""
    code = F.lower(F.replace(F.trim(F.coalesce(language, F.lit(""))), F.lit("_"), F.lit("-")))
    return F.sha2(F.concat_ws(SEP, F.coalesce(video, F.lit("")), code, F.coalesce(text, F.lit(""))), 256)
