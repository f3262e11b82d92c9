import csv
import io
import json
import random
import urllib.error
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.operators.bucket_state import BucketState
from vigil.operators.cdc import SnapshotTable
from vigil.plans.run import main, run, synthetic_parties
from vigil.schemas import SOURCES
from vigil.sources import delimited, files
from vigil.sources.canonical import canonical
from vigil.sources.fetch import fetch, land, land_pages, land_source
from vigil.sources.hits import read_hits, total_hits
from vigil.sources.registry import ingest
from vigil.sources.xml_lists import read_eu, read_sdn, read_un
from vigil.streaming.changes import write_changes
from vigil.streaming.incremental import merge_and_screen, start

TS = "2024-06-01 00:00:00"
SDN = """<sdnList xmlns="http://tempuri.org/sdnList.xsd"><sdnEntry><uid>36</uid><firstName>Ana</firstName><lastName>Ñuñez</lastName><sdnType>Individual</sdnType>
<programList><program>P1</program><program>P2</program></programList><idList><id><idType>Tax</idType><idNumber>1</idNumber></id><id><idType>Passport</idType><idNumber>X-2</idNumber></id><id><idType>Tax</idType><idNumber>3</idNumber></id></idList>
<akaList><aka><firstName>Anita</firstName><lastName>N</lastName></aka><aka><lastName>Solo</lastName></aka></akaList><nationalityList><nationality><country>Cuba</country></nationality></nationalityList>
<dateOfBirthList><dateOfBirthItem><dateOfBirth>05 Jan 1970</dateOfBirth></dateOfBirthItem></dateOfBirthList></sdnEntry>
<sdnEntry><uid>37</uid><lastName>ACME &amp; CO</lastName><sdnType>Entity</sdnType><idList><id><idType>Tax</idType><idNumber>1</idNumber></id><id><idType>Reg</idType><idNumber>9</idNumber></id></idList></sdnEntry></sdnList>"""
UN = """<LIST><INDIVIDUALS><INDIVIDUAL><DATAID>1</DATAID><FIRST_NAME>ALI</FIRST_NAME><SECOND_NAME>BEN</SECOND_NAME><THIRD_NAME>OMAR</THIRD_NAME><LISTED_ON>2001-10-08</LISTED_ON>
<NATIONALITY><VALUE>Iraq</VALUE></NATIONALITY><INDIVIDUAL_DOCUMENT><TYPE_OF_DOCUMENT>x</TYPE_OF_DOCUMENT><NUMBER>N5</NUMBER></INDIVIDUAL_DOCUMENT><AKA><FIRST_NAME>Abu</FIRST_NAME><SECOND_NAME>Ali</SECOND_NAME></AKA></INDIVIDUAL></INDIVIDUALS>
<ENTITIES><ENTITY><DATAID>2</DATAID><FIRST_NAME>THE GROUP</FIRST_NAME><AKA><FIRST_NAME>grp</FIRST_NAME></AKA><ENTITY_ADDRESS><COUNTRY>Syria</COUNTRY></ENTITY_ADDRESS><JUSTIFICATION>why</JUSTIFICATION></ENTITY></ENTITIES></LIST>"""
EU = """<export><sanctionEntity logicalId="13" euReferenceNumber="EU.1"><subjectType code="person"/><nameAlias wholeName="alias one" strong="false"/><nameAlias wholeName="Juan de Dios" strong="true"/><nameAlias wholeName="Other" strong="true"/>
<birthdate birthdate="1960-02-03"/><citizenship countryIso2Code="CU"/><address countryIso2Code="CU"/><identification number="7" identificationTypeCode="id"/><identification number="8" identificationTypeCode="passport"/>
<regulation entryIntoForceDate="2010-01-02" programme="PRG"><regulationType code="amendment"/></regulation></sanctionEntity>
<sanctionEntity euReferenceNumber="EU.2"><subjectType code="enterprise"/><nameAlias wholeName="Firm x"/><regulation publicationDate="2011-01-02" programme="PRG"/></sanctionEntity><sanctionEntity logicalId="15"><subjectType code="person"/></sanctionEntity></export>"""


def put(tmp_path, name, content):
    path = tmp_path / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_sdn(spark, tmp_path):
    a, b = canonical(read_sdn(spark, put(tmp_path, "sdn.xml", SDN)), TS).orderBy("id_fuente_original").collect()
    assert (a.nombres, a.apellidos, a.tipo_sujeto, a.numero_documento, a.tipo_sancion, str(a.fecha_nacimiento)) == ("ANA", "NUNEZ", "PERSONA_NATURAL", "X-2", "P1; P2", "1970-01-05")
    assert a.aliases == ["ANITA N", "SOLO"] and a.nacionalidad == ["CU"] and a.fecha_sancion is None
    assert (b.nombres, b.apellidos, b.tipo_sujeto, b.numero_documento, b.tipo_sancion, b.aliases) == ("ACME & CO", None, "PERSONA_JURIDICA", "9", "SDN", [])


def test_un(spark, tmp_path):
    a, b = canonical(read_un(spark, put(tmp_path, "un.xml", UN)), TS).orderBy("id_fuente_original").collect()
    assert (a.nombres, a.apellidos, a.numero_documento, a.tipo_sancion, str(a.fecha_sancion), a.nacionalidad, a.aliases) == ("ALI", "BEN OMAR", "N5", "UN SANCTIONS", "2001-10-08", ["IQ"], ["ABU ALI"])
    assert (b.nombres, b.tipo_sujeto, b.tipo_sancion, b.nacionalidad, b.aliases) == ("THE GROUP", "PERSONA_JURIDICA", "WHY", ["SY"], ["GRP"])


def test_eu(spark, tmp_path):
    a, b = canonical(read_eu(spark, put(tmp_path, "eu.xml", EU)), TS).orderBy("id_fuente_original").collect()
    assert (a.nombres, a.apellidos, a.numero_documento, a.tipo_sancion, str(a.fecha_nacimiento), str(a.fecha_sancion)) == ("JUAN", "DE DIOS", "8", "PRG AMENDMENT", "1960-02-03", "2010-01-02")
    assert a.aliases == ["ALIAS ONE", "OTHER"] and a.nacionalidad == ["CU", "CU"]
    assert (b.id_fuente_original, b.nombres, b.tipo_sancion, b.aliases) == ("EU.2", "FIRM X", "EU FINANCIAL SANCTIONS", [])


def test_hits(spark, tmp_path):
    def hit(i, **s):
        return {"_id": i, "_source": s}

    (tmp_path / "h").mkdir()
    one = {"hits": {"total": {"value": 5}, "hits": [hit("a", entity_name="ACME CORP", file_num="1"), hit("b", display_names=["JOHN DOE"], form_type="AP", date_filed="2020-01-02"), hit("c", title="")]}}
    two = {"hits": {"total": 5, "hits": [hit("d", name="ONE TWO THREE FOUR"), hit("e", name="A B C D II")]}}
    put(tmp_path, "h/0.json", json.dumps(one, indent=1))
    put(tmp_path, "h/1.json", json.dumps(two))
    got = {r.id_fuente_original: (r.tipo_sujeto[8:], r.nombres, r.apellidos, r.tipo_sancion) for r in read_hits(spark, str(tmp_path / "h")).collect()}
    assert got == {"1": ("JURIDICA", "ACME CORP", None, "FCPA FCPA"), "b": ("NATURAL", "JOHN", "DOE", "FCPA AP"), "d": ("JURIDICA", "ONE TWO THREE FOUR", None, "FCPA FCPA"), "e": ("NATURAL", "A", "B C D II", "FCPA FCPA")}
    assert {r.total for r in total_hits(spark, str(tmp_path / "h")).collect()} == {5}


CSV = "NOMBRES;APELLIDOS;CEDULA;SANCION;FECHA_SANCION;ESTADO\nJosé;Pérez;123;MULTA;01/02/2020;Vigente\n\n;;;;;\n;Solo;9;;;NO\nX;Y;;;;algo\n;Nobody;;;;\n"


def test_delimited(spark, tmp_path):
    assert delimited.delimiter("a,b;c,d|e") == "," and delimited.delimiter("a|b") == "|" and delimited.delimiter("") == ";"
    assert delimited.column_of(["X", "fecha_sancion"], ["SANCION"]) == 1 and delimited.column_of(["A"], ["B"]) is None
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("readme.md", "no")
        z.writestr("d.csv", CSV.encode("latin-1"))
    for path, zipped in ((put(tmp_path, "p.csv", CSV.encode("utf-8-sig")), False), (put(tmp_path, "p.zip", buffer.getvalue()), True)):
        got = {r.id_fuente_original: (r.nombres, r.apellidos, r.numero_documento, r.tipo_sancion, r.activo) for r in delimited.read_delimited(spark, path, "S", zipped).collect()}
        assert got == {"S_1_123": ("José", "Pérez", "123", "MULTA", True), "S_4_9": ("Solo", None, "9", "SANCION S", False), "S_5_": ("X", "Y", None, "SANCION S", False)}
    assert list(delimited.member_lines(b"broken", True)) == []


def whole_file_rows(content):
    """(row, cells) of a file by the standard library, all at once."""
    try:
        text = content.removeprefix(b"\xef\xbb\xbf").decode()
    except UnicodeDecodeError:
        text = content.removeprefix(b"\xef\xbb\xbf").decode("latin-1")
    sep = delimited.delimiter(text)
    rows = list(csv.reader(io.StringIO(text), delimiter=sep))
    at = {f: delimited.column_of(rows[0] if rows else [], wanted) for f, wanted in delimited.HEADERS.items()}
    return [(i, *(row[k].strip() if k is not None and k < len(row) else "" for k in at.values())) for i, row in enumerate(rows) if i and any(c.strip() for c in row)]


def random_file(rng, sep, lines):
    """Quoted fields with line ends, delimiters and doubled quotes; quotes within plain fields; blank and short rows; text after a closing quote."""
    def cell():
        kind = rng.random()
        body = "".join(rng.choice(["a", "b", " ", "é", "1", sep]) for _ in range(rng.randint(0, 6)))
        if kind < 0.25:
            return '"' + body.replace("b", '""') + rng.choice(["", "\n", "\r\n", "\n\n", f"{sep}\n"]) * rng.randint(0, 3) + '"' + rng.choice(["", "", "x"])
        return body.replace(sep, "") + rng.choice(["", "", '"', 'x"y'])
    out = [sep.join(["NOMBRES", "APELLIDOS", "CEDULA", "DELITO"])]
    for _ in range(lines):
        out.append(rng.choice(["", " "]) if rng.random() < 0.1 else sep.join(cell().lstrip('"') if rng.random() < 0.3 else cell() for _ in range(rng.randint(1, 5))))
    return rng.choice(["\n", "\r\n"]).join(out) + rng.choice(["", "\n"])


def test_delimited_in_chunks_equals_whole_files(spark, tmp_path):
    """Chunks of any size give the rows and row numbers that one parse of the whole file gives."""
    rng = random.Random(6)
    contents = {"empty": b"", "header": b"NOMBRES;CEDULA", "open": b'NOMBRES;CEDULA\n"never closed;1\nx;2\n\ny;3\n', "open-header": b'NOMBRES;"CEDULA\nx;2\n', "middle": b"NOMBRES;CEDULA\na;1\n" + b'"' + b"line\n" * 50 + b'";2\nz;3'}
    for i in range(24):
        text = random_file(rng, rng.choice(",;|"), rng.randint(1, 40))
        contents[f"r{i}"] = rng.choice([lambda t: t.encode(), lambda t: t.encode("utf-8-sig"), lambda t: t.encode("latin-1")])(text)
    (tmp_path / "d").mkdir()
    for name, content in contents.items():
        (tmp_path / "d" / f"{name}.csv").write_bytes(content)
    want = sorted((name, *row) for name, content in contents.items() for row in whole_file_rows(content))
    files_df = spark.createDataFrame([(f"x/{name}.csv", content) for name, content in contents.items()], "path string, content binary")
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path / "d")).select(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.col("value").cast("binary"))
    for size in (1, 7, 60, 1 << 20):
        for chunks in (lines.mapInArrow(delimited._of_lines(size), delimited.CHUNK_COLUMNS), files_df.mapInArrow(delimited._of_files(False, size), delimited.CHUNK_COLUMNS)):
            got = delimited._parsed(chunks).collect()
            assert sorted((r.file.split("/")[-1][:-4], *tuple(r)[1:]) for r in got) == want, size


def test_delimited_file_is_split(spark, tmp_path):
    """One file is read by several tasks, whose blocks begin within quoted fields."""
    rng = random.Random(7)
    content = random_file(rng, ";", 3000).encode()
    path = put(tmp_path, "big.csv", content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.col("value").cast("binary"))
        assert lines.rdd.getNumPartitions() > 8
        got = delimited._parsed(lines.mapInArrow(delimited._of_lines(2000), delimited.CHUNK_COLUMNS)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(tuple(r)[1:] for r in got) == whole_file_rows(content)


def test_archive_that_breaks_off(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("d.csv", "NOMBRES;CEDULA\n" + "\n".join(f"n{i};{i * 7919}" for i in range(5000)))
    broken = bytearray(buffer.getvalue())
    broken[2000:2100] = bytes(100)
    with pytest.raises(Exception):
        delimited.read_delimited(spark, put(tmp_path, "b.zip", bytes(broken)), "S", True).collect()


def page(rows, more=""):
    cells = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f"<html><table><tr><th>Firm Name</th><th>Country</th><th>From</th><th>To</th><th>Grounds</th></tr>{cells}</table>{more}</html>"


def test_debarred(spark, tmp_path):
    (tmp_path / "w").mkdir()
    put(tmp_path, "w/0.html", page([["A <b>Co</b>", "Peru", "01-Jan-2020", "Indefinite", ""], ["B", "", "2020-01-01", "2030-01-01", "Fraud"], ["only"], ["", "x", "", "", ""]], "<a href=x>Next</a>"))
    put(tmp_path, "w/1.html", page([["b", "Chile", "2020-01-01", "2021-01-01", "Other"], ["C", "Cuba", "", "2021-01-01", "Z"]]))
    got = {r.nombres: (r.nacionalidad, r.tipo_sancion, r.activo, r.id_fuente_original) for r in files.read_debarred(spark, str(tmp_path / "w"), "2024-06-01").collect()}
    assert got == {"ACo": (["Peru"], "WORLD BANK DEBARMENT", True, "WB_1_ACo"), "B": ([], "Fraud", True, "WB_2_B"), "C": (["Cuba"], "Z", False, "WB_2_C")}
    assert files.has_next(page([], "<a>Next</a>")) and not files.has_next(page([])) and files.table_rows("<p>no table</p>") == ([], False)


def test_fetch(tmp_path):
    calls, waits = [], []

    class Answer(io.BytesIO):
        pass

    def opener(outcomes):
        def open_(request, timeout):
            calls.append(request.full_url)
            x = outcomes.pop(0)
            if isinstance(x, Exception):
                raise x
            return Answer(x)

        return open_

    refused = urllib.error.HTTPError("http://x", 403, "no", {}, None)
    busy = urllib.error.HTTPError("http://x", 500, "no", {}, None)
    assert fetch("http://x", opener=opener([busy, urllib.error.URLError("down"), b"ok"]), pause=waits.append) == b"ok" and waits == [2, 4]
    assert fetch("http://x", opener=opener([refused]), pause=waits.append) is None
    assert fetch("http://x", retries=2, opener=opener([busy, busy]), pause=waits.append) is None
    path = str(tmp_path / "f" / "x.xml")
    assert land("http://x", path, opener=opener([b"1"])) and land("http://x", path, skip_download=True, opener=opener([]))
    assert land_pages(lambda p: f"http://x/{p}", lambda p: str(tmp_path / f"{p}"), lambda body, p: body != b"last", 9, opener=opener([b"a", b"last"])) == 2


def test_broken_source_is_reported(spark, tmp_path):
    records, reason = ingest(spark, "OFAC", str(tmp_path / "missing.xml"), TS)
    assert records.count() == 0 and reason
    assert ingest(spark, "NOPE", "x", TS)[1] == "unknown source NOPE"


BROKEN_UN = """<LIST><INDIVIDUALS><INDIVIDUAL><DATAID>1</DATAID><FIRST_NAME>ALI</FIRST_NAME></INDIVIDUAL>
<INDIVIDUAL><DATAID>2</DATAID><FIRST_NAME>BAD</SECOND_NAME></INDIVIDUAL>
<INDIVIDUAL><DATAID>3</DATAID><FIRST_NAME>ZOE</FIRST_NAME></INDIVIDUAL></INDIVIDUALS></LIST>"""


def test_bad_entries_are_set_aside(spark, tmp_path):
    """Between others, of every source that can hold them; the others are read as ever."""
    rejects = []
    records, reason = ingest(spark, "UN", put(tmp_path, "un.xml", BROKEN_UN), TS, rejects)
    assert reason is None and {r.id_fuente_original for r in records.collect()} == {"1", "3"}
    aside = [tuple(r) for df in rejects for r in df.collect()]
    assert [(a[0], a[2]) for a in aside] == [("UN", "malformed <INDIVIDUAL>")] and "BAD" in aside[0][1]
    (tmp_path / "hits").mkdir()
    put(tmp_path, "hits/0.json", json.dumps({"hits": {"total": 3, "hits": [{"_id": "1", "_source": {"name": "Firm LLC"}}, 7, None, {"_id": "2", "_source": {"name": "Other LLC"}}]}}))
    put(tmp_path, "hits/1.json", '{"hits": {"hits": [')
    rejects = []
    records, reason = ingest(spark, "FCPA", str(tmp_path / "hits"), TS, rejects)
    assert reason is None and {r.id_fuente_original for r in records.collect()} == {"1", "2"}
    assert sorted(r.reason for df in rejects for r in df.collect()) == ["malformed hit", "malformed page"]


def test_a_source_that_fails_late_does_not_stop_others(spark, tmp_path, monkeypatch):
    """An error in a source's last rows is its own: it gives no records and a reason; the run lists it and goes on."""
    from vigil.sources import registry

    def late(spark, path, today, rejects):
        """The first entry is read, the last one fails."""
        return read_sdn(spark, path).withColumn("activo", F.when(F.col("id_fuente_original") == "36", F.lit(True)).otherwise(F.raise_error(F.lit("late failure")).cast("boolean")))

    monkeypatch.setitem(registry.READERS, "EU", late)
    landing = {"EU": put(tmp_path, "EU", SDN), "UN": put(tmp_path, "UN", BROKEN_UN)}
    records, reason = registry.ingest(spark, "EU", landing["EU"], TS)
    assert records.count() == 0 and "late failure" in reason
    root = str(tmp_path / "root")
    done = run(spark, landing, root, TS, total=100, planted=10)
    assert done["total_terceros"] == 100
    aside = {(r.fuente, r.reason if r.record else "source") for r in spark.read.parquet(f"{root}/quarantine").collect()}
    assert aside == {("EU", "source"), ("UN", "malformed <INDIVIDUAL>")}
    assert [(r.fuente, r.registros_total, r.errores) for r in spark.read.parquet(f"{root}/ingestion_log").collect()] == [("UN", 2, 1)]


def test_whole_run(spark, tmp_path):
    landing = {"OFAC": put(tmp_path, "OFAC", SDN), "UN": put(tmp_path, "UN", UN), "EU": str(tmp_path / "none")}
    root = str(tmp_path / "root")
    first = run(spark, landing, root, TS, total=300, planted=40)
    assert first["total_terceros"] == 300 and first["evaluation"]["recall"] > 0.8 and not first["quality_passed"]
    assert {f["rule"] for f in first["fired"]} >= {"FUENTE_VACIA"}
    again = run(spark, landing, root, "2024-06-02 00:00:00", total=300, planted=40)
    assert again["total_alertas"] == first["total_alertas"]
    logs = {(r.fuente, r.registros_nuevos) for r in spark.read.parquet(f"{root}/ingestion_log").collect()}
    assert logs == {("OFAC", 2), ("OFAC", 0), ("UN", 2), ("UN", 0)}
    report = json.load(open(f"{root}/reports/matching.json"))
    assert report["total_terceros"] == 300 and report["index"]["initials"] >= 2
    checks = json.load(open(f"{root}/reports/quality.json"))
    assert len(checks["rules"]) == 8 and checks["total_errors"] == sum(r["error_count"] for r in checks["rules"])
    assert next(r for r in checks["rules"] if r["rule"] == "alerta_referencias_validas")["passed"]
    assert BucketState(spark, f"{root}/state").read().count() == 4


def test_incremental(spark, tmp_path):
    landing, alerts = str(tmp_path / "in"), str(tmp_path / "alerts")
    records = canonical(read_sdn(spark, put(tmp_path, "sdn.xml", SDN)), TS).withColumn("seq", F.lit(1).cast("long"))
    parties = spark.createDataFrame([("t", "ANA", "NUNEZ", None)], "id_tercero string, nombres string, apellidos string, numero_documento string")

    def turn():
        start(spark, landing, str(tmp_path / "state"), parties, alerts, str(tmp_path / "checkpoint"), TS).awaitTermination()
        return spark.read.parquet(alerts).count()

    records.write.parquet(landing)
    assert turn() == 1 and turn() == 1
    records.write.mode("append").parquet(landing)  # nothing has changed
    assert turn() == 1
    records.withColumn("hash_contenido", F.lit("other")).write.mode("append").parquet(landing)
    assert turn() == 2


def test_incremental_survives_a_crash(spark, tmp_path, monkeypatch):
    """A batch that fails before its alerts, between alerts and state, or after both, leaves the same alerts when it is repeated."""
    records = canonical(read_sdn(spark, put(tmp_path, "sdn.xml", SDN)), TS).withColumn("seq", F.lit(1).cast("long"))
    parties = spark.createDataFrame([("t", "ANA", "NUNEZ", None), ("u", "ANA", "NUNEZ", None)], "id_tercero string, nombres string, apellidos string, numero_documento string")

    def turn(name, when=None):
        root = tmp_path / name
        state = BucketState(spark, str(root / "state"))
        if when == "screen":
            monkeypatch.setattr("vigil.streaming.incremental.screen", lambda *a: 1 / 0)
        elif when == "publish":
            monkeypatch.setattr(BucketState, "publish", lambda *a: 1 / 0)
        try:
            merge_and_screen(records, state, parties, str(root / "alerts"), "batch-0", TS)
            failed = False
        except ZeroDivisionError:
            failed = True
        monkeypatch.undo()
        return failed

    def alerts(name):
        return sorted((r.id_tercero, r.id_registro) for r in spark.read.parquet(str(tmp_path / name / "alerts")).collect())

    assert not turn("plain") and len(alerts("plain")) == 2
    assert not turn("plain") and len(alerts("plain")) == 2  # after both: nothing has changed, and the alerts stay
    for when in ("screen", "publish"):
        assert turn(when, when) and not turn(when) and alerts(when) == alerts("plain")
        assert BucketState(spark, str(tmp_path / when / "state")).read().count() == records.count()


def test_snapshot_version_is_taken_once(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    drafts = [table.stage(spark.range(n)) for n in (1, 2)]
    assert table.publish(drafts[0], 1) == 1
    with pytest.raises(RuntimeError):
        table.publish(drafts[1], 1)
    assert table.versions() == [1] and table.read().count() == 1


def test_table_in_a_div():
    rows = "<tr><th>Firm</th><th>Country</th></tr><tr><td>A<td>Peru</tr><tr><td>B</td><td>Chile</td></tr>"
    assert [r["name"] for r in files.table_rows(f'<div class="x">no</div><div class="k-Grid"><div>{rows}</div></div>')[0]] == ["A", "B"]
    assert [r["name"] for r in files.table_rows(f'<div class="list">{rows}</div><table><tr><th>Name</th><th>x</th></tr><tr><td>C</td><td>y</td></tr></table>')[0]] == ["C"]
    assert files.table_rows('<div class="grid"></div>') == ([], False) and files.table_rows(f'<div class="plain">{rows}</div>') == ([], False)


def test_landing_every_source(tmp_path):
    """Paged lists end with the announced number of hits, or with a page that links no further or brings nothing new."""
    asked = []

    def answer(url):
        asked.append(url)
        if "efts" in url:
            return json.dumps({"hits": {"total": {"value": 1500}, "hits": [{"_id": "1"}]}}).encode()
        if "worldbank" in url:
            n = min(3, sum("worldbank" in u for u in asked))
            return f"<table><tr><th>Firm</th><th>From</th></tr><tr><td>F{n}</td><td>x</td></tr></table><a>Next</a>".encode()
        return b"<x/>"

    def opener(request, timeout):
        return io.BytesIO(answer(request.full_url))

    for name in SOURCES:
        assert land_source(name, str(tmp_path), opener=opener)
    assert [u.split("&from=")[1].split("&")[0] for u in asked if "efts" in u] == ["0", "1000"]
    assert [u.split("?")[1] if "?" in u else "" for u in asked if "worldbank" in u] == ["", "page=2", "page=3", "page=4"]
    n = len(asked)
    assert all(land_source(name, str(tmp_path), skip_download=True, opener=opener) for name in SOURCES) and len(asked) == n


def test_main_downloads_and_runs(spark, tmp_path, monkeypatch):
    landed, ran = [], []

    class Kept:
        appName = config = lambda self, *a: self
        getOrCreate = lambda self: spark

    monkeypatch.setattr("vigil.plans.run.SparkSession", type("S", (), {"builder": Kept()}))
    monkeypatch.setattr("vigil.plans.run.run", lambda *a, **how: ran.append((a, how)))
    arguments = ["--landing", str(tmp_path), "--root", str(tmp_path / "root"), "--sources", "OFAC,NOPE,EU"]
    download = lambda name, folder, skip: landed.append((name, skip))
    assert main(arguments, download) == 0 and landed == [("OFAC", False), ("EU", False)]
    assert main([*arguments, "--skip-download"], download) == 0 and landed[2:] == [("OFAC", True), ("EU", True)]
    assert main([*arguments, "--only-matching"], download) == 0 and len(landed) == 4
    assert [(set(a[1]), how["reuse_portfolio"], how["only_matching"]) for a, how in ran] == [({"OFAC", "EU"}, False, False), ({"OFAC", "EU"}, True, False), ({"OFAC", "EU"}, False, True)]
    with pytest.raises(SystemExit):
        main([*arguments, "--env", "nowhere"], download)


def test_portfolio_is_saved_and_used_again(spark, tmp_path, monkeypatch):
    sanctions = canonical(read_sdn(spark, put(tmp_path, "sdn.xml", SDN)), TS)
    first = synthetic_parties(spark, sanctions, str(tmp_path), 100, 20, reuse=True)
    assert first.count() == 100 and spark.read.parquet(str(tmp_path / "planted")).count() == 20
    monkeypatch.setattr("vigil.plans.run.portfolio", lambda *a: 1 / 0)
    assert synthetic_parties(spark, sanctions, str(tmp_path), 100, 20, reuse=True).exceptAll(first).count() == 0
    with pytest.raises(ZeroDivisionError):
        synthetic_parties(spark, sanctions, str(tmp_path), 100, 20, reuse=False)


FEED = "id_registro string, seq long, hash_contenido string"


def against_last(batches):
    """The change feed by a plain loop over micro-batches."""
    last, out = {}, []
    for rows in batches:
        for i, seq, h in sorted(rows, key=lambda r: r[1]):
            before, version = last.get(i, (None, 0))
            kind = "NUEVO" if i not in last else "SIN_CAMBIO" if before == h else "MODIFICADO"
            version += kind != "SIN_CAMBIO"
            last[i] = h, version
            out.append((i, seq, h, before, version, kind))
    return sorted(out, key=str)


def test_change_feed_keeps_its_state(spark, tmp_path):
    """Several micro-batches, nulls, an id with most rows, and a query that is started again after more has landed."""
    rng = random.Random(4)
    batches = [[("hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None]), 100 * k + n, rng.choice(["x", "y", None])) for n in range(40)] for k in range(4)]
    landing, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def land(k):
        spark.createDataFrame(batches[k], FEED).repartition(1).write.parquet(f"{landing}/{k}")

    def turn():
        write_changes(spark, landing, FEED, out, checkpoint).awaitTermination()
        return sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=str)

    land(0)
    land(1)
    assert turn() == against_last(batches[:2])
    land(2)
    assert turn() == against_last(batches[:3])
    assert turn() == against_last(batches[:3])  # nothing new has landed
    land(3)
    assert turn() == against_last(batches)


def test_change_feed_calls_go_by_buckets(spark, tmp_path):
    """Ids that are new, known and both, by the loop; the function is called for a bucket with the records of many ids."""
    from vigil.streaming import changes

    class State:
        value = None
        exists = property(lambda self: self.value is not None)
        get = property(lambda self: self.value)

        def update(self, value):
            self.value = value

    rng, state, got = random.Random(6), State(), []
    batches = [[(rng.choice([f"i{rng.randint(0, 40)}", None]), rng.randint(0, 9) + 10 * k, rng.choice(["x", "y", None])) for _ in range(90)] for k in range(4)]
    for rows in batches:
        frames = [pd.DataFrame(rows[:50], columns=["id", "seq", "hash"]), pd.DataFrame(rows[50:], columns=["id", "seq", "hash"])]
        for out in changes._against_last((0,), iter(frames), state):
            got += [tuple(None if pd.isna(v) else v for v in r) for r in out.itertuples(index=False)]
    assert sorted(got, key=str) == against_last(batches)


def test_csv_report_computes_its_rows_once(spark, tmp_path):
    from vigil.plans.run import save_csv

    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    rows = spark.range(0, 20, 1, 1).select(F.udf(count, "long")("id").alias("id"), F.array(F.lit("a")).alias("names"))
    assert save_csv(rows, str(tmp_path / "r")) and seen.value == 20
    assert {tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "r")).collect()} == {(str(k), '["a"]') for k in range(20)}
    # An empty one leaves what was there, and nothing beside it.
    assert not save_csv(rows.where("id < 0"), str(tmp_path / "r")) and spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 20
    assert [x.name for x in tmp_path.iterdir()] == ["r"]


def test_pages_data_source_and_table_function(spark, tmp_path):
    from vigil.sources import pages as source

    source.register(spark)
    (tmp_path / "p").mkdir()
    for k in range(7):
        put(tmp_path, f"p/{k:03d}.html", page([[f"Firm {k}", "Peru", "2020-01-01", "2030-01-01", "Fraud"], [f"Other {k}", "", "", "", ""]]))
    put(tmp_path, "p/note.txt", "no page")
    read = spark.read.format("vigil_pages").option("pattern", "*.html").option("taskBytes", 500).load(str(tmp_path / "p"))
    assert read.rdd.getNumPartitions() > 2
    rows = sorted(read.collect(), key=lambda r: r.page)
    assert [r.page for r in rows] == list(range(7)) and all(bytes(r.content) == (tmp_path / "p" / f"{r.page:03d}.html").read_bytes() for r in rows)
    whole = {str(tuple(r)) for r in files.read_debarred(spark, str(tmp_path / "p" / "*.html"), "2024-06-01").collect()}
    assert {str(tuple(r)) for r in files.debarred(read, "2024-06-01").collect()} == whole and len(whole) == 14
    read.selectExpr("page", "CAST(content AS STRING) AS html").unionByName(spark.createDataFrame([(99, None), (98, "<p>")], "page int, html string")).createOrReplaceTempView("landed")
    got = {tuple(r) for r in spark.sql("SELECT l.page, t.row, t.name, t.country FROM landed l, LATERAL html_table_rows(l.html) t").collect()}
    assert got == {(k, n, f"{w} {k}", c) for k in range(7) for n, w, c in ((1, "Firm", "Peru"), (2, "Other", ""))}
    (tmp_path / "none").mkdir()
    assert spark.read.format("vigil_pages").load(str(tmp_path / "none")).count() == 0


def test_csv_report_of_alerts_is_compressed(spark, tmp_path):
    """Texts with commas, line ends and nulls come back as they were, from a fraction of the disk."""
    from vigil.plans.run import save_csv

    rows = spark.range(0, 5000, 1, 1).selectExpr("id", "CASE WHEN id % 3 > 0 THEN concat('a, b', char(10), id % 7) END AS name")
    sizes = []
    for how in ("none", "gzip"):
        path = tmp_path / how
        assert save_csv(rows, str(path), how)
        sizes.append(sum(f.stat().st_size for f in path.glob("part-*")))
        back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(rows.schema).csv(str(path))
        assert {tuple(r) for r in back.collect()} == {tuple(r) for r in rows.collect()}
    assert sizes[1] * 3 < sizes[0]
