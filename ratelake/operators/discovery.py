"""Artifacts discovered through the links of a candidate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratelake import fixed, schemas
from ratelake.functions.binding import with_once
from ratelake.functions.dates import parse_date_text
from ratelake.functions.urls import resolve_href
from ratelake.operators.gate import CANDIDATE_RULES, gate
from ratelake.operators.normalize import has_structural_warning, positions, typed_candidate, warning_messages

_ARTIFACTS = "array<struct<url:string,effective_date:string,context_excerpt:string,child_source_id:string>>"


def discover(df: DataFrame, raw: str) -> DataFrame:
    """Add ``discovered`` (artifacts and diagnostics) for the candidates in ``raw``.

    ``df`` carries carrier, source_id, captured_at, child_source_id, base_url and
    pdf_only. Relative links are resolved before the gate sees them, so a
    candidate can pass here that the snapshot path rejects.
    """
    base = F.col("base_url")
    gated = gate(df, raw, CANDIDATE_RULES, base)
    valid = F.size("issues") == 0
    staged = with_once(gated, "_c", F.when(valid, typed_candidate(F.col("doc")))).drop("doc")
    c = F.col("_c")

    def artifact(link):
        return F.struct(
            resolve_href(link["href"], base).alias("url"),
            parse_date_text(link["effective_date"]).alias("effective_date"),
            link["evidence_snippet"].alias("context_excerpt"),
            F.col("child_source_id").alias("child_source_id"),
        )

    found = F.filter(
        F.transform(c["links"], artifact),
        lambda a: a["url"].isNotNull() & (~F.col("pdf_only") | F.endswith(F.lower(a["url"]), F.lit(".pdf"))),
    )
    staged = staged.withColumn("_found", F.coalesce(found, F.array().cast(_ARTIFACTS)))
    empty = F.size("_found") == 0
    issue_messages = F.transform(
        "issues",
        lambda e: F.concat(F.when(e["path"] == "", "<root>").otherwise(e["path"]), F.lit(": "), e["message"]),
    )
    messages = F.when(
        valid,
        F.concat(
            warning_messages(c["parse_warnings"]),
            F.when(empty, F.array(F.lit(fixed.NO_LINKS_MESSAGE))).otherwise(F.array().cast("array<string>")),
        ),
    ).otherwise(F.concat(F.array(F.lit(fixed.GATE_FAILED_MESSAGE)), issue_messages))
    structural = ~valid | F.coalesce(has_structural_warning(c["parse_warnings"]), F.lit(False)) | empty
    return staged.withColumn(
        "discovered",
        F.struct(
            F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
            "carrier",
            "source_id",
            "captured_at",
            F.col("_found").alias("artifacts"),
            F.struct(structural.alias("structural_error"), messages.alias("messages")).alias("parser_diagnostics"),
        ).cast(StructType.fromDDL(schemas.DISCOVERED)),
    ).drop("_c", "_found", "issues")


def discovered_links(discovered: DataFrame) -> DataFrame:
    d = F.col("discovered")
    others = [c for c in discovered.columns if c != "discovered"]
    return positions(discovered, d["artifacts"], others, ("link_index", "_a")).select(
        *others, "link_index", F.col("_a.url").alias("url"),
        F.col("_a.effective_date").alias("effective_date"),
        F.col("_a.context_excerpt").alias("context_excerpt"),
    )
