"""Readers on small hand-written files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from agroloom.sources import files, reports, soil, xml


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))


def test_folder_of_two_experiments(spark, tmp_path):
    bom = "﻿"
    write(tmp_path / "one.ID_L1_V1_0_SORTE.csv", f"{bom}Sorte_ID,Sorte,leer\n1,für,\n2,b,\n")
    write(tmp_path / "two.ID_L1_V2_0_2012_SORTE.csv", "Sorte,Sorte_ID,Zahl\ngrün,7,1.5\n", "iso-8859-1")
    write(tmp_path / "one.ID_L2_V1_0_LEER.csv", "a,b\n")
    write(tmp_path / "notes.txt", "x\ny\n")
    tables = files.load_tables(spark, str(tmp_path))
    assert set(tables) == {"SORTE"}
    t = tables["SORTE"]
    assert dict(t.dtypes) == {"Sorte_ID": "bigint", "Sorte": "string", "Zahl": "double", "experiment_id": "string"}
    assert rows(t.select("experiment_id", "Sorte_ID", "Sorte", "Zahl")) == [("one", 1, "für", None), ("one", 2, "b", None), ("two", 7, "grün", 1.5)]


def test_quoted_breaks_bad_rows_and_skipped_files(spark, tmp_path):
    write(tmp_path / "one.ID_L1_V1_0_NOTE.csv", 'id,note,v\n1,"line one\nline ""two""",5\n2,plain\n3,x,6\n4,y,7,8\n')
    write(tmp_path / "one.ID_L2_V1_0_LEER.csv", "a,b\n")
    write(tmp_path / "readme.csv", "x,y\n1,2\n")
    tables = files.load_tables(spark, str(tmp_path), report="report")
    assert rows(tables["NOTE"].select("id", "note", "v")) == [(1, 'line one\nline "two"', 5), (3, "x", 6)]
    got = [(r["file"].split("/")[-1], r["reason"], r["record"]) for r in tables["report"].collect()]
    assert sorted(got, key=str) == [
        ("one.ID_L1_V1_0_NOTE.csv", "row does not fit the header", "2,plain"),
        ("one.ID_L1_V1_0_NOTE.csv", "row does not fit the header", "4,y,7,8"),
        ("one.ID_L2_V1_0_LEER.csv", "no data rows", None),
        ("readme.csv", "no version and table in the name", None),
    ]


def test_names_of_files(spark):
    names = ["lte_x.ID_L0201_V1_0_PROBENAHME_PFLANZEN.csv", "v140_mun.V2_0_2012_KULTUR.csv", "readme.csv"]
    t = spark.createDataFrame([(n,) for n in names], "f string")
    got = [tuple(r) for r in t.select(files.table_name(F.col("f")), files.experiment_name(F.col("f"))).collect()]
    assert got == [("PROBENAHME_PFLANZEN", "lte_x"), ("KULTUR", "v140_mun"), (None, "readme")]


def test_key_separator(spark, tmp_path):
    write(tmp_path / "a.csv", "name;unit\nx;kg\n")
    write(tmp_path / "b.csv", "name,unit\ny,m\n")
    write(tmp_path / "c.txt", "name\tunit\nz\ts\n")
    assert rows(files.load_key(spark, str(tmp_path))) == [("x", "kg"), ("y", "m"), ("z", "s")]


def test_key_rows_that_do_not_fit(spark, tmp_path):
    write(tmp_path / "a.csv", 'name;unit\nx;kg\nlong;m;2\nshort\n"two\nlines";NA\n')
    assert rows(files.load_key(spark, str(tmp_path))) == [("two\nlines", "NA"), ("x", "kg")]
    assert rows(files.key_report(spark, str(tmp_path)).select("reason", "record")) == [
        ("row does not fit the header", "long;m;2"), ("row does not fit the header", "short"),
    ]


def test_typing_of_text(spark):
    t = spark.createDataFrame([("1", "1.0", "x", None, "19670629"), (None, "2", "2", None, "19670101")], "i string, d string, s string, n string, day string")
    assert dict(files.typed(t).dtypes) == {"i": "bigint", "d": "double", "s": "string", "day": "bigint"}


REPORT = """*GROWTH OUTPUT

*RUN   1        : 1 | 1       MODEL
 MODEL          : X

! comment
@YEAR DOY   DAS    GWAD   LAID
 1994 299     3       0  0.000
 1994 300     4     -99  0.250

*RUN   2        : 1 | 2       MODEL
@YEAR DOY   DAS    GWAD   LAID
 1996 366     5    1200  1.500
"""


def test_report_runs(spark, tmp_path):
    write(tmp_path / "growth.OUT", REPORT)
    got = reports.read_runs(spark, str(tmp_path), {"GWAD": "double", "LAID": "double"}).drop("file_name")
    assert rows(got) == [
        (1, dt.date(1994, 10, 26), 0.0, 0.0),
        (1, dt.date(1994, 10, 27), None, 0.25),
        (2, dt.date(1996, 12, 31), 1200.0, 1.5),
    ]


PROFILES = """*SOILS: general file
! comment

*IB00000001  SRC     SIC     210 DEEP SILTY CLAY
@SITE        COUNTRY          LAT     LONG SCS FAMILY
 Old Place   Generic       51.500      -99     Deep Generic
@ SCOM  SALB  SLU1
   -99  0.11   6.0
@  SLB  SLMH  SLLL
     5   -99 0.228
    15   -99 0.249

*IB00000002  SRC     SIC     150 MEDIUM SILTY CLAY
@  SLB  SLMH  SLLL
    10     A 0.1
"""


def test_repeated_heads(spark, tmp_path):
    write(tmp_path / "x.OUT", "*RUN   1        : a\n@YEAR DOY   X   X\n 2000   1   5   6\n")
    sections = reports.read_sections(spark, str(tmp_path)).filter("title like '1%'")
    got = reports.fields_as(reports.section_rows(sections), {"X": "int", "X_4": "int"})
    assert rows(got.select("X", "X_4")) == [(5, 6)]


def test_soil_profile(spark, tmp_path):
    write(tmp_path / "SOIL.SOL", PROFILES)
    one = reports.read_profiles(spark, str(tmp_path), "IB00000001")
    layers = reports.fields_as(one.filter("block_no = 3"), {"SLB": "double", "SLMH": "string", "SLLL": "double"})
    assert rows(layers.select("SLB", "SLMH", "SLLL")) == [(15.0, None, 0.249), (5.0, None, 0.228)]
    surface = reports.fields_as(one.filter("block_no = 2"), {"SALB": "double", "SLU1": "double"})
    assert rows(surface.select("SALB", "SLU1")) == [(0.11, 6.0)]
    site = reports.fields_as(one.filter("block_no = 1"), {"SITE": "string", "COUNTRY": "string", "LAT": "double", "LONG": "double", "SCS_FAMILY": "string"})
    assert rows(site.select("SITE", "COUNTRY", "LAT", "LONG", "SCS_FAMILY")) == [("Old Place", "Generic", 51.5, None, "Deep Generic")]
    every = reports.fields_as(reports.read_profiles(spark, str(tmp_path)), {"SLB": "double"}).filter("SLB IS NOT NULL")
    assert rows(every.groupBy("profile_id").count()) == [("IB00000001", 2), ("IB00000002", 1)]


def test_xml_missing_parts(spark):
    docs = spark.createDataFrame(
        [("d1", "<a><gmd:CI_ResponsibleParty><gmd:individualName>\n A &amp; B </gmd:individualName></gmd:CI_ResponsibleParty></a>"), ("d2", "<a/>")],
        "path string, value string",
    )
    got = xml.read_metadata(docs)
    assert rows(got["Provenance"].select("path", "persons", "email")) == [("d1", "A & B", None)]
    assert got["Temporal_coverage"].count() == 0 and got["Identification"].count() == 0


def test_soil_horizons(spark):
    raw = spark.createDataFrame([("1", "0-5", 1.0, 9.0), ("1", "5-15", 2.0, 9.0)], "id string, label string, claymean double, clayQ50 double")
    where = spark.createDataFrame(soil.locations_from([51.0], [12.0]), "id string, lat double, lon double")
    got = soil.soil_horizons(raw, where)
    assert got.columns == ["id", "lon", "lat", "updep", "lodep", "clay"]
    assert rows(got.select("updep", "lodep", "clay", "lat")) == [("0", "5", 1.0, 51.0), ("5", "15", 2.0, 51.0)]
    with pytest.raises(ValueError):
        soil.locations_from([1.0], [])
