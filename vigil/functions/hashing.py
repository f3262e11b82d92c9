"""Record ids and content hashes, byte for byte as a JSON encoder with sorted keys would have them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fields that decide whether a record has changed; others change unseen.
HASHED = ["fuente", "tipo_sujeto", "nombres", "apellidos", "fecha_nacimiento", "numero_documento", "tipo_sancion", "fecha_sancion"]


def _json(c: Column) -> Column:
    quoted = F.to_json(F.array(c.cast("string")))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def content_hash(fields: list[str] = HASHED) -> Column:
    """SHA-256 of the fields as a JSON object with sorted keys; nulls are kept, dates are ISO texts."""
    parts = [x for i, f in enumerate(sorted(fields)) for x in (F.lit(("{" if not i else ", ") + f'"{f}": '), _json(F.col(f)))]
    return F.sha2(F.concat(*parts, F.lit("}")), 256)


def record_id(source: Column, original: Column, name: Column) -> Column:
    """16 hexadecimal digits of SHA-256 over source|id|name, nulls written as None."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("None")) for c in (source, original, name)]), 256), 1, 16)
