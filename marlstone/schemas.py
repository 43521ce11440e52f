"""Schemas of the archive's tables. Readers apply them; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from .functions.briefs import BRIEF


def struct(**fields: str | T.DataType) -> T.StructType:
    kinds = {"s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DoubleType(), "b": T.BooleanType(), "as": T.ArrayType(T.StringType()), "ms": T.MapType(T.StringType(), T.StringType())}
    return T.StructType([T.StructField(n, kinds.get(k, k) if isinstance(k, str) else k) for n, k in fields.items()])


PREVIEW = struct(schema_version="i", surface="s", text="s", character_count="i", body_sha256="s")
POST = struct(
    source="s", source_id="s", slug="s", title="s", subtitle="s", post_date="s", url="s", audience="s", meter_type="s", type="s", is_published="b", wordcount="i", body_text="s", body_html_length="i",
    body_source="s", source_updated_at="s", observed_source_updated_at="s", body_revision_status="s", content_status="s", alternate_urls="ms", member_preview=PREVIEW,
    medium_id="s", display_title="s", latest_published_at="s", canonical_url="s", visibility="s", mirror_substack_slug="s", pinned="b",
)
REGISTRY = struct(source_id="s", title="s", url="s", post_date="s", access="s")
OVERRIDE = struct(medium_id="s", substack_slug="s", medium_title_key="s", substack_title="s")
CROSSLINK = struct(source="s", source_id="s", target_source="s", target_slug="s", decision="s", reason="s")
ARTICLE = struct(
    source="s", source_id="s", slug="s", title="s", subtitle="s", post_date="s", url="s", audience="s", wordcount="i", content_status="s", brief=BRIEF, family="s",
    body_revision_status="s", source_updated_at="s", observed_source_updated_at="s", alternate_urls="ms", access="s", member_preview=PREVIEW,
)
OBSERVATION = struct(
    article_title="s", article_url="s", article_date="s", trade_description="s", instruments="as", direction="s", underlying="s", edge_or_thesis="s", any_quant_detail="s", outcome_if_mentioned="s",
    fund_name_if_mentioned="s", description_truncated="b", source_body_sha256="s",
)
CURVE = struct(day="s", m3="d", y2="d", y5="d", y10="d", y30="d")
STATUS = struct(schema_version="i", source="s", checked_at="s", status="s", mode="s", fetched_count="i", published_count="i", newest="s", error="s", provenance="s")
HEALTH = struct(source="s", checked_at="s", status="s", mode="s", published_count="i", fetched_count="i", included_count="i", newest="s", degraded_since="s", consecutive_degraded_checks="i")
