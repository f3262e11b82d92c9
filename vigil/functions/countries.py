"""Country names to ISO 3166 codes of two letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import non_empty, normalize_text, strip

# Names and their codes. The order matters: the first name with a given beginning wins.
COUNTRIES: dict[str, str | None] = {
    "COLOMBIA": "CO", "UNITED STATES": "US", "USA": "US", "U.S.": "US", "RUSSIA": "RU", "RUSSIAN FEDERATION": "RU",
    "CHINA": "CN", "PEOPLE'S REPUBLIC OF CHINA": "CN", "IRAN": "IR", "ISLAMIC REPUBLIC OF IRAN": "IR", "NORTH KOREA": "KP",
    "DEMOCRATIC PEOPLE'S REPUBLIC OF KOREA": "KP", "VENEZUELA": "VE", "CUBA": "CU", "SYRIA": "SY", "MYANMAR": "MM", "UKRAINE": "UA",
    "BELARUS": "BY", "AFGHANISTAN": "AF", "IRAQ": "IQ", "LIBYA": "LY", "SUDAN": "SD", "SOMALIA": "SO", "YEMEN": "YE",
    "NICARAGUA": "NI", "HAITI": "HT", "UNITED KINGDOM": "GB", "UK": "GB", "GERMANY": "DE", "FRANCE": "FR", "SPAIN": "ES",
    "ITALY": "IT", "MEXICO": "MX", "BRAZIL": "BR", "ARGENTINA": "AR", "CHILE": "CL", "PERU": "PE", "ECUADOR": "EC",
    "BOLIVIA": "BO", "PARAGUAY": "PY", "URUGUAY": "UY", "PANAMA": "PA", "COSTA RICA": "CR", "HONDURAS": "HN",
    "EL SALVADOR": "SV", "GUATEMALA": "GT", "DOMINICAN REPUBLIC": "DO", "TURKEY": "TR", "INDIA": "IN", "PAKISTAN": "PK",
    "SAUDI ARABIA": "SA", "UAE": "AE", "UNITED ARAB EMIRATES": "AE", "NIGERIA": "NG", "SOUTH AFRICA": "ZA", "KENYA": "KE",
    "ETHIOPIA": "ET", "EGYPT": "EG", "MOROCCO": "MA", "INDONESIA": "ID", "MALAYSIA": "MY", "THAILAND": "TH", "PHILIPPINES": "PH",
    "VIETNAM": "VN", "JAPAN": "JP", "SOUTH KOREA": "KR", "REPUBLIC OF KOREA": "KR", "AUSTRALIA": "AU", "CANADA": "CA",
    "SWITZERLAND": "CH", "NETHERLANDS": "NL", "BELGIUM": "BE", "SWEDEN": "SE", "NORWAY": "NO", "DENMARK": "DK", "FINLAND": "FI",
    "AUSTRIA": "AT", "POLAND": "PL", "CZECHIA": "CZ", "CZECH REPUBLIC": "CZ", "PORTUGAL": "PT", "GREECE": "GR", "ISRAEL": "IL",
    "JORDAN": "JO", "LEBANON": "LB", "UNKNOWN": None, "N/A": None, "": None,
}


def prefixes() -> dict[str, str | None]:
    """Every beginning of up to four letters -> the code of the first name that has it."""
    found: dict[str, str | None] = {}
    for name, code in COUNTRIES.items():
        for k in range(1, min(4, len(name)) + 1):
            found.setdefault(name[:k], code)
    return found


def _lookup(pairs: dict[str, str | None], key: Column) -> Column:
    """[code] where key is known ([null] for a name that stands for no country), else null."""
    table = F.create_map(*[x for name, code in pairs.items() for x in (F.lit(name), F.array(F.lit(code).cast("string")))])
    return F.try_element_at(table, key)


def normalize_country(value: Column, strict: bool = False) -> Column:
    """Two letters as they are; a known name's code; the code of the first name with the same four letters at its
    beginning; else the first two letters. strict: only the first two of these."""
    text = F.upper(non_empty(value))
    name = normalize_text(text)
    known = _lookup(COUNTRIES, name)
    begins = _lookup(prefixes(), F.substring(name, 1, 4))
    guess = F.when(begins.isNotNull(), F.get(begins, 0)).otherwise(F.when(F.length(text) >= 2, F.substring(text, 1, 2)))
    return F.when(F.regexp_like(text, F.lit(r"^\p{L}{2}$")), text).when(known.isNotNull(), F.get(known, 0)).otherwise(F.lit(None).cast("string") if strict else guess)


def normalize_countries(values: Column, strict: bool = False) -> Column:
    """An array's codes in order, without those that stand for no country; empty for null."""
    codes = F.filter(F.transform(values, lambda v: normalize_country(v, strict)), lambda c: F.length(c) > 0)
    return F.coalesce(codes, F.array().cast("array<string>"))


def split_countries(value: Column, strict: bool = False) -> Column:
    """normalize_countries of a text that lists names between commas, semicolons or slashes."""
    return normalize_countries(F.filter(F.transform(F.split(value, "[,;/]"), strip), lambda p: p != ""), strict)
