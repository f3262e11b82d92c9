"""From a source's raw texts (schemas.RAW) to the canonical record (schemas.SANCTION)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.countries import normalize_countries
from ..functions.dates import parse_date
from ..functions.hashing import HASHED, content_hash, record_id
from ..functions.text import normalize_text


def canonical(raw: DataFrame, run_ts: str, hashed: list[str] = HASHED, strict_countries: bool = False, datetimes: bool = False) -> DataFrame:
    """Canonical records. run_ts: the run's time, the same in every row; further columns of raw are kept (as seq)."""
    extra = [c for c in raw.columns if c not in {
        "fuente", "id_fuente_original", "tipo_sujeto", "nombres", "apellidos", "aliases", "fecha_nacimiento", "nacionalidad", "numero_documento", "tipo_sancion",
        "fecha_sancion", "fecha_vencimiento", "activo"}]
    x = raw.select(
        "fuente", "tipo_sujeto", normalize_text(F.col("nombres")).alias("nombres"), normalize_text(F.col("apellidos")).alias("apellidos"),
        F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), parse_date(F.col("fecha_nacimiento"), datetimes).alias("fecha_nacimiento"),
        normalize_countries(F.col("nacionalidad"), strict_countries).alias("nacionalidad"), "numero_documento", normalize_text(F.col("tipo_sancion")).alias("tipo_sancion"),
        parse_date(F.col("fecha_sancion"), datetimes).alias("fecha_sancion"), parse_date(F.col("fecha_vencimiento"), datetimes).alias("fecha_vencimiento"), "activo",
        F.lit(run_ts).cast("timestamp").alias("fecha_ingesta"), F.col("id_fuente_original").cast("string").alias("id_fuente_original"), *extra,
    )
    x = x.withColumn("hash_contenido", content_hash(hashed))
    return x.select(
        record_id(F.col("fuente"), F.col("id_fuente_original"), F.col("nombres")).alias("id_registro"), "fuente", "tipo_sujeto", "nombres", "apellidos", "aliases", "fecha_nacimiento", "nacionalidad",
        "numero_documento", "tipo_sancion", "fecha_sancion", "fecha_vencimiento", "activo", "fecha_ingesta", "hash_contenido", "id_fuente_original", *extra,
    )
