"""The three XML lists: elements of a row tag each, parsed by themselves, and projections.

Namespaces are left out, so a list with a default namespace reads like one without.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_of, first_word_and_rest, non_empty, strip
from ..schemas import LEGAL, NATURAL, RAW
from ..staging import staged

NAMES = "FIRST_NAME string, SECOND_NAME string, THIRD_NAME string, FOURTH_NAME string"
SDN = (
    "_uid string, uid string, sdnType string, firstName string, lastName string, akaList struct<aka: array<struct<firstName: string, lastName: string>>>, "
    "dateOfBirthList struct<dateOfBirthItem: array<struct<dateOfBirth: string>>>, nationalityList struct<nationality: array<struct<country: string>>>, "
    "idList struct<id: array<struct<idType: string, idNumber: string>>>, programList struct<program: array<string>>"
)
UN_PERSON = (
    f"_DATAID string, DATAID string, {NAMES}, AKA array<struct<{NAMES.replace(' string', ': string')}>>, INDIVIDUAL_ALIAS array<struct<AKA: array<struct<{NAMES.replace(' string', ': string')}>>>>, LISTED_ON string, "
    "NATIONALITY array<struct<VALUE: array<string>>>, PASSPORT_NUMBER string, INDIVIDUAL_DOCUMENT array<struct<_VALUE: string, NUMBER: string>>, JUSTIFICATION string, DATE_OF_BIRTH string, "
    "INDIVIDUAL_DATE_OF_BIRTH array<struct<DATE_OF_BIRTH: string>>"
)
UN_ENTITY = (
    "_DATAID string, DATAID string, FIRST_NAME string, ENTITY_NAME string, AKA array<struct<FIRST_NAME: string>>, LISTED_ON string, JUSTIFICATION string, ENTITY_ADDRESS array<struct<COUNTRY: string>>"
)
EU = (
    "_logicalId string, _euReferenceNumber string, _id string, subjectType struct<_code: string, _classificationCode: string>, "
    "nameAlias array<struct<_wholeName: string, _firstName: string, _lastName: string, _strong: string>>, birthdate array<struct<_birthdate: string, _date: string, _year: string>>, "
    "citizenship array<struct<_countryIso2Code: string, _countryDescription: string>>, address array<struct<_countryIso2Code: string, _countryDescription: string>>, "
    "identification array<struct<_number: string, _identificationTypeCode: string, _identificationTypeDescription: string>>, "
    "regulation array<struct<_entryIntoForceDate: string, _publicationDate: string, _programme: string, regulationType: struct<_code: string, _description: string>>>"
)


#: Rows that a reader sets aside: what it found, and why. Readers append to a list of such tables, if they are given one.
REJECTED = "record string, reason string"


def sound(df: DataFrame, bad: str, reason: str, rejects: list[DataFrame] | None) -> DataFrame:
    """df without the rows whose column `bad` holds a record that couldn't be parsed; those go to rejects."""
    if rejects is not None:
        rejects.append(df.where(F.col(bad).isNotNull()).select(F.col(bad).cast("string").alias("record"), F.lit(reason).alias("reason")))
    return df.where(F.col(bad).isNull()).drop(bad)


def _read(spark: SparkSession, path: str, tag: str, schema: str, rejects: list[DataFrame] | None = None) -> DataFrame:
    """The elements of a tag, parsed once; malformed ones are set aside.

    Spark's XML reader ends a file at the first malformed element. So files are split at the tag's end marks, in as many
    tasks as they have blocks, and every element is parsed by itself.
    """
    ends = spark.read.option("lineSep", f"</{tag}>").text(path)
    element = ends.select(F.regexp_extract("value", rf"(?s)(<{tag}(?:\s[^>]*[^/>])?>.*)", 1).alias("element")).where("element <> ''").select(F.concat("element", F.lit(f"</{tag}>")).alias("element"))
    options = {"ignoreNamespace": "true", "columnNameOfCorruptRecord": "__bad"}
    parsed = element.select(F.from_xml("element", schema + ", __bad string", options).alias("x")).select("x.*")
    return sound(staged(parsed, f"xml-{tag}"), "__bad", f"malformed <{tag}>", rejects)


def _texts(values: Column) -> Column:
    """An array's stripped, non-blank texts; empty for null."""
    return F.coalesce(F.filter(F.transform(values, non_empty), lambda v: v.isNotNull()), F.array().cast("array<string>"))


def _joined(parts: list[Column]) -> Column:
    """Non-blank parts with a space between; null if none."""
    return F.nullif(F.array_join(_texts(F.array(*parts)), " "), F.lit(""))


def _document(ids: Column, number: str, kinds: list[str]) -> Column:
    """The number of the first passport or national id, else of the last one that has a number."""
    kind = lambda d: F.lower(F.coalesce(*[non_empty(d[k]) for k in kinds], F.lit("")))
    numbered = F.filter(ids, lambda d: non_empty(d[number]).isNotNull())
    preferred = F.filter(numbered, lambda d: F.contains(kind(d), F.lit("passport")) | F.contains(kind(d), F.lit("national")))
    return strip(F.coalesce(F.get(preferred, 0)[number], F.try_element_at(numbered, F.lit(-1))[number]))


def _raw(df: DataFrame, **columns: Column) -> DataFrame:
    nothing = {"apellidos", "fecha_nacimiento", "numero_documento", "fecha_sancion", "fecha_vencimiento"}
    empty = {"aliases", "nacionalidad"}
    fields = [p.strip().split(" ")[0] for p in RAW.split(", ")]
    out = []
    for f in fields:
        c = columns.get(f)
        if c is None:
            c = F.array().cast("array<string>") if f in empty else F.lit(True) if f == "activo" else F.lit(None).cast("string") if f in nothing else None
        out.append(c.alias(f))
    return df.select(*out)


def read_sdn(spark: SparkSession, path: str, rejects: list[DataFrame] | None = None) -> DataFrame:
    x = _read(spark, path, "sdnEntry", SDN, rejects)
    first, last = non_empty(F.col("firstName")), non_empty(F.col("lastName"))
    return _raw(
        x, fuente=F.lit("OFAC"), id_fuente_original=F.coalesce(non_empty(F.col("_uid")), non_empty(F.col("uid")), F.lit("")),
        tipo_sujeto=F.when(F.lower(strip(F.col("sdnType"))) == "individual", NATURAL).otherwise(LEGAL),
        nombres=F.coalesce(first, last), apellidos=F.when(first.isNotNull(), last),
        aliases=_texts(F.transform("akaList.aka", lambda a: F.upper(_joined([a["firstName"], a["lastName"]])))),
        fecha_nacimiento=F.get("dateOfBirthList.dateOfBirthItem", 0)["dateOfBirth"],
        nacionalidad=_texts(F.col("nationalityList.nationality.country")),
        numero_documento=_document(F.col("idList.id"), "idNumber", ["idType"]),
        tipo_sancion=F.coalesce(F.nullif(F.array_join(_texts(F.col("programList.program")), "; "), F.lit("")), F.lit("SDN")),
    )


def read_un(spark: SparkSession, path: str, rejects: list[DataFrame] | None = None) -> DataFrame:
    """Persons, then entities; malformed entries are set aside."""
    p = _read(spark, path, "INDIVIDUAL", UN_PERSON, rejects)
    names = ["FIRST_NAME", "SECOND_NAME", "THIRD_NAME", "FOURTH_NAME"]
    first, rest = first_word_and_rest(_joined([F.col(n) for n in names]))
    known = F.concat(F.coalesce("AKA", F.array()), F.coalesce(F.flatten("INDIVIDUAL_ALIAS.AKA"), F.array()))
    persons = _raw(
        p, fuente=F.lit("UN"), id_fuente_original=F.coalesce(non_empty(F.col("DATAID")), non_empty(F.col("_DATAID")), F.lit("")), tipo_sujeto=F.lit(NATURAL), nombres=first, apellidos=rest,
        aliases=_texts(F.transform(known, lambda a: F.upper(_joined([a[n] for n in names])))),
        fecha_nacimiento=F.coalesce(non_empty(F.col("DATE_OF_BIRTH")), F.get(_texts(F.col("INDIVIDUAL_DATE_OF_BIRTH.DATE_OF_BIRTH")), 0)),
        nacionalidad=_texts(F.flatten("NATIONALITY.VALUE")),
        numero_documento=F.coalesce(non_empty(F.col("PASSPORT_NUMBER")), F.get(_texts(F.col("INDIVIDUAL_DOCUMENT._VALUE")), 0), F.get(_texts(F.col("INDIVIDUAL_DOCUMENT.NUMBER")), 0)),
        tipo_sancion=F.coalesce(non_empty(F.col("JUSTIFICATION")), F.lit("UN SANCTIONS")), fecha_sancion=F.col("LISTED_ON"),
    )
    e = _read(spark, path, "ENTITY", UN_ENTITY, rejects)
    entities = _raw(
        e, fuente=F.lit("UN"), id_fuente_original=F.coalesce(non_empty(F.col("DATAID")), non_empty(F.col("_DATAID")), F.lit("")), tipo_sujeto=F.lit(LEGAL), nombres=first_of(F.col("FIRST_NAME"), F.col("ENTITY_NAME")),
        aliases=F.transform(_texts(F.col("AKA.FIRST_NAME")), F.upper), nacionalidad=_texts(F.col("ENTITY_ADDRESS.COUNTRY")),
        tipo_sancion=F.coalesce(non_empty(F.col("JUSTIFICATION")), F.lit("UN ENTITY SANCTIONS")), fecha_sancion=F.col("LISTED_ON"),
    )
    return persons.unionByName(entities)


#: Row tags of the list, tried in this order.
EU_TAGS = ("sanctionEntity", "entity", "Entity")


def read_eu(spark: SparkSession, path: str, tags: tuple[str, ...] = EU_TAGS, rejects: list[DataFrame] | None = None) -> DataFrame:
    """The entries under the first row tag that the file has."""
    for tag in tags:
        own: list[DataFrame] = []
        x = _read(spark, path, tag, EU, own)
        if not x.isEmpty():
            break
    if rejects is not None:
        rejects += own
    natural = F.contains(F.lower(F.coalesce(first_of(F.col("subjectType._code"), F.col("subjectType._classificationCode")), F.lit(""))), F.lit("person"))
    whole = lambda a: first_of(a["_wholeName"], a["_lastName"], a["_firstName"])
    named = F.filter(F.transform("nameAlias", lambda a: F.struct(whole(a).alias("name"), (F.lower(strip(a["_strong"])) == "true").alias("strong"))), lambda a: a["name"].isNotNull())
    x = x.withColumn("__named", F.coalesce(named, F.array().cast("array<struct<name: string, strong: boolean>>")))
    # The first strong name, else the first; the others are aliases. Places count from 0.
    strong = F.get(F.filter(F.transform("__named", lambda a, i: F.when(F.coalesce(a["strong"], F.lit(False)), i)), lambda i: i.isNotNull()), 0)
    x = x.withColumn("__at", F.coalesce(strong, F.lit(0))).withColumn("__name", F.get("__named", F.col("__at"))["name"])
    # An alias promoted for want of a strong name was in upper case already.
    x = x.withColumn("__name", F.when(strong.isNull(), F.upper("__name")).otherwise(F.col("__name"))).where("__name IS NOT NULL")
    first, rest = first_word_and_rest(F.col("__name"))
    countries = lambda c: F.transform(c, lambda v: first_of(v["_countryIso2Code"], v["_countryDescription"]))
    law = F.get("regulation", 0)
    kind = F.nullif(strip(F.concat(F.coalesce(non_empty(law["_programme"]), F.lit("")), F.lit(" "), F.coalesce(first_of(law["regulationType"]["_code"], law["regulationType"]["_description"]), F.lit("")))), F.lit(""))
    born = F.get("birthdate", 0)
    return _raw(
        x, fuente=F.lit("EU"), id_fuente_original=F.coalesce(first_of(F.col("_logicalId"), F.col("_euReferenceNumber"), F.col("_id")), F.lit("")),
        tipo_sujeto=F.when(natural, NATURAL).otherwise(LEGAL), nombres=F.when(natural, first).otherwise(F.col("__name")), apellidos=F.when(natural, rest),
        aliases=F.transform(F.filter(F.transform("__named", lambda a, i: F.when(i != F.col("__at"), a["name"])), lambda n: n.isNotNull()), F.upper),
        fecha_nacimiento=first_of(born["_birthdate"], born["_date"], born["_year"]),
        nacionalidad=_texts(F.concat(F.coalesce(countries(F.col("citizenship")), F.array()), F.coalesce(countries(F.col("address")), F.array()))),
        numero_documento=_document(F.col("identification"), "_number", ["_identificationTypeCode", "_identificationTypeDescription"]),
        tipo_sancion=F.coalesce(F.when(law["regulationType"].isNotNull(), kind), F.lit("EU FINANCIAL SANCTIONS")), fecha_sancion=first_of(law["_entryIntoForceDate"], law["_publicationDate"]),
    )
