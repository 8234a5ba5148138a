"""Strict conformance of raw deliveries to the published contracts (V7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetline.functions import decode, validate


def conformance(deliveries: DataFrame) -> DataFrame:
    """Deliveries per declared schema version and strict outcome.

    Conforming = a JSON object, version 0 (absent) or 1, no field errors, no
    keys outside the contract, numbers as JSON numbers and, for v1, a
    ``schema_id`` of at least 1 if there is one (the contract leaves it out).
    """
    parsed = deliveries.select("value", decode.parse_message(F.col("value")).alias("_v"))
    v = F.col("_v")
    obj = F.coalesce(decode.is_object(F.col("value"), v), F.lit(False))
    staged = decode.with_version(parsed.select("_v", obj.alias("_obj"))).select(
        "_v", "_obj", "_ver",
        decode.version_failure(v, F.col("_raw"), F.col("_vkind"), F.col("_ver")).alias("_vfail"))
    typed = validate.typed_fields(validate.extract_fields(staged, "_v"))
    upcast = F.col("_ver") == 0
    ok = (F.col("_obj") & F.col("_vfail").isNull()
          & (F.size(F.array_remove(validate.envelope_errors(upcast), "schema_id: field required")) == 0)
          & (F.size(validate.contract_violations(v, F.col("_ver"))) == 0))
    label = F.when(~F.col("_obj"), F.lit("undecodable")) \
        .otherwise(F.coalesce(F.col("_ver").cast("bigint").cast("string"), F.lit("non-numeric")))
    return typed.select(label.alias("declared_version"), F.coalesce(ok, F.lit(False)).alias("conforming")) \
        .groupBy("declared_version", "conforming").agg(F.count(F.lit(1)).alias("deliveries"))
