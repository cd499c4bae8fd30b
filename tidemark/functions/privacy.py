"""Protection of whole messages by the paths of their schema, whatever is nested or missing.

Every text of a message is treated by its path (field names joined by dots, ``[]`` for the elements of a list, ``{}`` for the values of a map): people
are hashed, addresses lose their fragment and account, enumerations, ids and times stay as they are, and every other text, known
or not, is cleaned. So a field that nobody has thought of is never stored raw.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text
from tidemark.functions.identity import salted

HASHED, ADDRESS, PLAIN, CLEANED, JSON = "hashed", "address", "plain", "cleaned", "json"

#: What the fields of canonical events hold; all other texts are cleaned.
RULES = {
    **dict.fromkeys(("user_id", "author_id", "x_account", "author.id", "author.name", "mentions[]", "comments[].author", "channel_id"), HASHED),
    **dict.fromkeys(("url", "thumbnail_url", "comments[].url"), ADDRESS),
    **dict.fromkeys(("metadata_json", "provenance_json", "coverage_json", "transcript_segments_json"), JSON),
    **dict.fromkeys(
        ("event_id", "observation_id", "source", "platform_event_id", "content_id", "root_content_id", "parent_content_id", "conversation_id", "video_id", "stage", "event_type", "event_version", "content_type", "relation_type", "language", "timestamp", "published_at", "collected_at", "updated_at", "observed_at", "metadata_collected_at", "last_metrics_refresh_at", "transcript_status", "transcript_lifecycle_status", "comments[].id", "transcript_available_languages[]"),
        PLAIN,
    ),
}


def address(url: Column) -> Column:
    """A URL without its fragment; of a status only the neutral address is left, since the account stands in it."""
    status = text.path_part(url, r"^https?://(?:www\.|mobile\.)?(?:x|twitter)\.com/[^/?#]+/status/(\d+)")
    return F.when(status.isNotNull(), F.concat(F.lit("https://x.com/i/status/"), status)).otherwise(text.without_fragment(url))


def redacted_json(json: Column) -> Column:
    """A JSON text whose strings are cleaned as texts; anything else in it stays."""
    return text.scrub_pii(text.redacted_field(text.redacted_field(json, "x_account"), "author"))


def protected_value(c: Column, kind: T.DataType, path: str, salt: str, rules: Mapping[str, str] = RULES) -> Column:
    """A value of any type with every text in it treated by its path."""
    if isinstance(kind, T.StructType):
        inner = [protected_value(c[f.name], f.dataType, f"{path}.{f.name}" if path else f.name, salt, rules).alias(f.name) for f in kind]
        return F.when(c.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: protected_value(x, kind.elementType, f"{path}[]", salt, rules))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: protected_value(v, kind.valueType, f"{path}{{}}", salt, rules))
    rule = rules.get(path, CLEANED)
    if rule == HASHED:
        return salted(salt, c.cast("string"))
    if not isinstance(kind, T.StringType) or rule == PLAIN:
        return c
    return {ADDRESS: address, JSON: redacted_json, CLEANED: text.clean_text}[rule](c)


def protected_rows(rows: DataFrame, salt: str, fields: list[str], rules: Mapping[str, str] = RULES) -> DataFrame:
    """``rows`` with the named columns protected; the others are envelopes, and stay."""
    kinds = {f.name: f.dataType for f in rows.schema}
    return rows.withColumns({c: protected_value(F.col(c), kinds[c], c, salt, rules) for c in fields if c in kinds})
