"""Run manifests: one document per run, or lines where a run is too large for one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratelake import fixed, schemas
from ratelake.sources.readers import column_names

MANIFEST_BYTES = 8 << 20  # a run whose sources take more bytes is written as lines
_KEEP_NULLS = {"ignoreNullFields": "false"}


def _head(runs: DataFrame) -> DataFrame:
    """The fields of a manifest up to its sources; those that ``runs`` lacks are null."""
    names = [n for n in column_names(schemas.MANIFEST) if n != "sources"]
    given = {n: F.col(n).cast("string") if n in runs.columns else F.lit(None).cast("string") for n in names}
    return runs.select(*[c.alias(n) for n, c in (given | {"schema_version": F.lit(fixed.SCHEMA_VERSION)}).items()])


def _text(*fields: Column | str) -> Column:
    return F.to_json(F.struct(*fields), _KEEP_NULLS)


def manifest_texts(runs: DataFrame, sources: DataFrame, limit: int = MANIFEST_BYTES) -> DataFrame:
    """Manifests as JSON texts: run_id, position, value.

    runs     run_id and other fields of a manifest's head
    sources  run_id, position and the fields of a source, child_artifacts nested

    A run whose sources take up to ``limit`` bytes of JSON is one text with its sources in
    order. A larger run is never gathered: it is its head (position -1) and a text per
    source that carries its place.
    """
    fields = StructType.fromDDL(f"s {schemas.SOURCE}")["s"].dataType.fieldNames()
    source = F.struct(*[n for n in fields if n in sources.columns])
    body = sources.select("run_id", F.col("position").cast("int").alias("position"), source.alias("source"))
    sized = body.withColumn("_bytes", F.octet_length(_text("source")))
    head = _head(runs)
    heads = head.join(sized.groupBy("run_id").agg(F.sum("_bytes").alias("_bytes")), "run_id", "left")
    fits = F.coalesce("_bytes", F.lit(0)) <= limit
    placed = body.join(heads.select("run_id", fits.alias("_fits")), "run_id")
    gathered = placed.filter("_fits").groupBy("run_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "source"))), lambda s: s["source"]).alias("sources")
    )
    none = F.array().cast(gathered.schema["sources"].dataType)
    whole = heads.filter(fits).join(gathered, "run_id", "left").withColumn("sources", F.coalesce("sources", none))
    documents = whole.select("run_id", F.lit(0).alias("position"), _text(*head.columns, "sources").alias("value"))
    first = heads.filter(~fits).select("run_id", F.lit(-1).alias("position"), _text(*head.columns).alias("value"))
    lines = placed.filter(~F.col("_fits")).select("run_id", "position", _text("run_id", "position", "source").alias("value"))
    return documents.unionByName(first).unionByName(lines)


def write_manifests(texts: DataFrame, path: str) -> None:
    """Texts of one run into its folder, or of many runs into the folder above theirs: as
    part files, one text per line, in a folder named like the manifest."""
    texts.select("value").write.mode("overwrite").text(f"{path}/{fixed.MANIFEST_FILE}")
