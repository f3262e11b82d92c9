"""Schemas of the screening tables, as Spark DDL."""

SANCTION = (
    "id_registro string, fuente string, tipo_sujeto string, nombres string, apellidos string, aliases array<string>, fecha_nacimiento date, "
    "nacionalidad array<string>, numero_documento string, tipo_sancion string, fecha_sancion date, fecha_vencimiento date, activo boolean, "
    "fecha_ingesta timestamp, hash_contenido string, id_fuente_original string"
)
STATE = SANCTION + ", estado_carga string"
TERCERO = (
    "id_tercero string, tipo_sujeto string, nombres string, apellidos string, fecha_nacimiento string, nacionalidad string, numero_documento string, "
    "tipo_documento string, pais_residencia string, es_match_plantado int, tipo_match_plantado string"
)
ALERT = (
    "id_tercero string, id_registro string, fuente string, tipo_match string, score_similitud double, nombre_tercero string, nombre_lista string, "
    "requiere_revision boolean, timestamp timestamp"
)
INGESTION_LOG = (
    "fuente string, timestamp_inicio timestamp, timestamp_fin timestamp, registros_total long, registros_nuevos long, registros_modificados long, "
    "registros_eliminados long, errores int, duracion_segundos double, estado string"
)
PLANTED_MAP = "id_tercero string, id_registro_sancion string, fuente_sancion string, tipo_match string, nombre_original string, nombre_plantado string"
METRIC = "key string, value string, tags map<string,string>, timestamp timestamp"
#: What a source reader hands to canonical(): raw texts, before any normalisation.
RAW = (
    "fuente string, id_fuente_original string, tipo_sujeto string, nombres string, apellidos string, aliases array<string>, fecha_nacimiento string, "
    "nacionalidad array<string>, numero_documento string, tipo_sancion string, fecha_sancion string, fecha_vencimiento string, activo boolean"
)

# The lists that are screened against, and the kinds of subject.
SOURCES = ["OFAC", "UN", "EU", "FCPA", "PACO_DISC", "PACO_PENAL", "WORLD_BANK"]
NATURAL, LEGAL = "PERSONA_NATURAL", "PERSONA_JURIDICA"
