"""Bundles, templates and text output on hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from agroloom.operators import tagging, weather
from agroloom.plans import bundle, export, sections
from agroloom.plans import templates as tpl


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_template_sizes():
    # columns per section: the flat and the list columns together
    sizes = {n: len(s) for n, s in tpl.SECTIONS.items()}
    assert sizes == {
        "GENERAL": 14, "TREATMENTS": 18, "CULTIVARS": 4, "FIELDS": 22, "SOIL_ANALYSIS": 15, "INITIAL_CONDITIONS": 18,
        "PLANTING_DETAILS": 16, "TILLAGE": 5, "IRRIGATION": 12, "FERTILIZERS": 12, "RESIDUES": 11, "CHEMICALS": 8,
        "ENVIRONMENT_MODIFICATIONS": 11, "HARVEST": 8, "SIMULATION_CONTROLS": 91,
    }
    assert (len(tpl.SOIL), len(tpl.WEATHER), len(tpl.SUMMARY_FORMATS), len(tpl.SERIES_FORMATS)) == (37, 10, 20, 5)


def test_split_by_year(spark):
    trt = spark.createDataFrame([("e", 2000, 1, 3, None), ("e", 2000, 2, 4, None), ("e", 2001, 1, 5, None), ("e", 2001, 2, 0, None)], "e string, Year int, N int, MF int, CU int")
    obs = spark.createDataFrame([("e", 2000, 1, None)], "e string, Year int, TRTNO int, HWAH double")
    part = spark.createDataFrame([("e", 2000, 1, None), ("e", 2001, 1, 5.0), ("e", 2001, 2, None)], obs.schema)
    kept = spark.createDataFrame([("e", "x")], "e string, SITE string")
    out = export.split_by_year({"TREATMENTS": trt, "OBSERVED_Summary": obs, "OBSERVED_TimeSeries": part, "GENERAL": kept}, ["e"])
    assert set(out) == {"TREATMENTS", "OBSERVED_TimeSeries", "GENERAL"}
    assert rows(out["OBSERVED_TimeSeries"]) == [("e", 2001, 1, 5.0), ("e", 2001, 2, None)]
    assert rows(out["TREATMENTS"]) == [("e", 2000, 1, 1), ("e", 2000, 2, 2), ("e", 2001, 1, 1), ("e", 2001, 2, 0)]


def test_missing_sections_are_reported(spark):
    trt = spark.createDataFrame([("e", 2000, 1)], "e string, Year int, N int")
    out, notes = export.build_management({"TREATMENTS": trt}, ["e"])
    assert list(out) == ["GENERAL", "TREATMENTS", "CULTIVARS", "FIELDS", "PLANTING_DETAILS", "SIMULATION_CONTROLS"]
    assert rows(out["CULTIVARS"]) == [("e", 2000, 1.0, "FA", "IB0001", "")]
    assert [n for n in notes if n.startswith("required")] == [f"required section {s} is missing" for s in ("CULTIVARS", "FIELDS", "PLANTING_DETAILS")]
    row = out["TREATMENTS"].first()
    assert (row["R"], row["O"], row["C"], row["SM"], row["MH"], row["TNAME"]) == (1.0, 0.0, 0.0, 1.0, 0.0, None)


def test_nested_section(spark):
    t = spark.createDataFrame(
        [("e", 1, "2000-05-01", "IR001", 20.0), ("e", 1, "2000-06-01", "IR001", None), ("e", 2, "2000-05-05", "IR002", 5.0)],
        "e string, I int, IDATE string, IROP string, IRVAL double",
    ).withColumn("IDATE", F.to_date("IDATE"))
    got = export.format_section(t, tpl.SECTIONS["IRRIGATION"], ["e"], ["IDATE"]).orderBy("I").collect()
    assert got[0]["IDATE"] == [dt.date(2000, 5, 1), dt.date(2000, 6, 1)] and got[0]["IRVAL"] == [20.0, None]
    assert got[1]["IROP"] == ["IR002"] and got[1]["IRNAME"] is None and got[1]["I"] == 2.0


def test_weather_lines(spark):
    t = spark.createDataFrame([("e", 1995, "1995-01-02", 2.1, 4.94, -0.2, 607.4), ("e", 1995, "1995-01-01", None, 0.0, -1.4, 12.0)], "e string, Year int, DATE string, SRAD double, TMAX double, TMIN double, WIND double")
    wth = export.build_weather(t.withColumn("DATE", F.to_date("DATE")), ["e"])
    lines = export.text_lines(wth, tpl.WEATHER_FORMATS, ["e", "Year"], ["DATE"], 0).orderBy("kind", "sort")
    assert [r["line"] for r in lines.collect()] == [
        "@DATE  SRAD  TMAX  TMIN  RAIN  DEWP  WIND   PAR  EVAP  RHUM",
        "95001   -99   0.0  -1.4   -99   -99    12   -99   -99   -99",
        "95002   2.1   4.9  -0.2   -99   -99   607   -99   -99   -99",
    ]


def test_text_folders(spark, tmp_path):
    keys = [1, 2, 9_999_999, 10_000_000, 123_456_789_012]
    t = spark.createDataFrame([("e", y, i, f"r{i % 7}") for y in (1, 2) for i in [*range(300), *keys[2:]]], "e string, Year int, k long, v string")
    lines = export.text_lines(t, {"k": "%4s", "v": "%5s"}, ["e", "Year"], ["k"], 0, "*TITLE")
    export.write_text(lines, str(tmp_path / "out"), ["e", "Year"])
    for y in (1, 2):
        parts = sorted((tmp_path / "out" / "e=e" / f"Year={y}").glob("part-*"))
        assert len(parts) == 1
        text = parts[0].read_text().splitlines()
        assert text[:2] == ["*TITLE", "@  k    v"]
        assert text[2:] == [f"{i:4d}" + f"r{i % 7}".rjust(5) for i in [*range(300), *keys[2:]]]


def test_head_cells():
    cells = export.head_cells("@L ID_FIELD WSTA....  FLSA SLTX  SLDP  ID_SOIL    FLNAME")
    assert cells == [
        ("L", 0, 2, False), ("ID_FIELD", 1, 8, True), ("WSTA", 1, 8, True), ("FLSA", 0, 6, False), ("SLTX", 1, 4, True), ("SLDP", 0, 6, False),
        ("ID_SOIL", 2, 10, True), ("FLNAME", 1, 6, True),
    ]
    assert export.head_cells("@ PAREA  PRNO")[0] == ("PAREA", 0, 7, False)


def test_water_content_keeps_its_decimals(spark):
    t = spark.createDataFrame([("e", 2000, 1.0, 10.0, 0.245), ("e", 2000, 1.0, 30.0, None)], "e string, Year int, C double, ICBL double, SH2O double")
    section = export.format_section(t, tpl.SECTIONS["INITIAL_CONDITIONS"], ["e", "Year"])
    lines = export.management_lines({"INITIAL_CONDITIONS": section}, ["e", "Year"]).orderBy("block_no", "kind", "sort")
    assert [r["line"] for r in lines.collect()][-3:] == ["@C  ICBL  SH2O  SNH4  SNO3", " 1    10 0.245   -99   -99", " 1    30   -99   -99   -99"]


def test_classes_and_roles():
    assert tagging.class_of("x_STICKSTOFFBILANZ.csv") == ("balance", "NITROGEN")
    assert tagging.class_of("duengung") == ("management", "") and tagging.class_of("SORTE") is None
    cols = {"DESIGNX": ["a"], "DUENGUNG": ["b"], "BODENPROBE": ["Probe_ID"], "LABOR": ["Probe_ID"], "WETTER": ["d1", "d2"], "REST": ["z"]}
    roles = tagging.key_tables(cols, {"WETTER": True})
    assert roles["design"] == ["DESIGNX"] and roles["management"] == ["DUENGUNG"] and roles["observed_timeseries"] == ["WETTER"]
    moved, links = tagging.link_tables(roles, cols)
    assert links == {"LABOR": ("BODENPROBE", "Probe_ID")} and moved["other"] == ["REST"]
    by_columns = tagging.key_tables({"X": ["Year", "Plot_id", "Treatment_id"]}, {})
    assert by_columns["design"] == ["X"]


def test_validation(spark):
    t = spark.createDataFrame([(1, 2)], "Year int, Plot_id int")
    report = bundle.validate({"VERSUCHSAUFBAU": t, "PARZELLE": t})
    assert report == [("error", "no table for treatments"), ("error", "VERSUCHSAUFBAU has no Pruefglied_ID column")]
    with pytest.raises(ValueError):
        bundle.require_valid({"PARZELLE": t})


def test_bundle_defaults(spark):
    site = spark.createDataFrame([("e", "Muehle", "Germany", 51.0, 12.0, "Trial", "1.0")], "experiment_id string, site string, country string, lat double, lon double, exp_details string, version string")
    assert rows(bundle.treatments(None, site)) == [("e", 1, "Default Treatment")]
    assert bundle.metadata({}, site).first()["REMARKS"] == "No additional remarks"
    head = bundle.result_header(site).first()
    assert head["SITE_CODE"] == "MUDE" and head["VERSION"] == "1.0"
    table, series = bundle.observation_table(spark.createDataFrame([("e", "2020-01-01", 1.0)], "experiment_id string, Tag string, v double"), "BONITUR_X", ["Tag"])
    assert series and table.first()["TYPE"] == "BONITUR X" and table.first()["ID"] == 1


def test_harvest_sections(spark):
    series = spark.createDataFrame([("e", 2000, 1, "A", "2000-07-01", 1.0), ("e", 2000, 1, "A", "2000-08-01", 2.0), ("e", 2000, 1, "A", None, None)], "e string, Year int, Plot_id int, TRTNO string, ERNTE__Termin string, ERNTE__x double")
    summary = spark.createDataFrame([("e", 2001, 1, "A", "2001-08-01", 3.0), ("e", 2001, 2, "A", None, None)], series.schema)
    got = sections.harvest(series, summary, ["e"], "ERNTE__Termin", ["ERNTE"])
    assert rows(got.select("Year", "ERNTE__x", "HA_ID")) == [(2000, 2.0, 1), (2001, 3.0, 2)]


def station_fixture(spark):
    stations = [(1, 51.0, 12.01, "1990-01-01"), (2, 51.0, 12.1, "1990-01-01"), (3, 51.0, 12.2, "1990-01-01"), (4, 51.0, 12.002, "2000-06-01")]
    stations = spark.createDataFrame([(i, "air_temperature", "hourly", f"S{i}", 10.0 * i, dt.date.fromisoformat(d), dt.date(2009, 12, 31), a, b) for i, a, b, d in stations], "station_id int, variable string, res string, name string, elev double, start_date date, end_date date, lat double, lon double")
    data = []
    for i in (1, 2, 3, 4):
        for day in range(366):
            d = dt.date(2000, 1, 1) + dt.timedelta(day)
            if i == 1 and day == 0:
                continue  # the nearest lacks January 1
            for hour in (3, 15):
                data.append((i, "TT_TU", dt.datetime(d.year, d.month, d.day, hour), float(hour + i) if (i, day) != (2, 10) else None))
    readings = spark.createDataFrame(data, "station_id int, var string, ts timestamp, value double")
    return stations, readings


def test_station_choice(spark):
    stations, readings = station_fixture(spark)
    wanted = spark.createDataFrame([(7, 51.0, 12.0, 2000), (7, 51.0, 12.0, 2001), (8, 40.0, 0.0, 2000)], "site_id int, lat double, lon double, year int")
    got = weather.get_weather(wanted, stations, readings, [m for m in weather.STATION_MAP if m["std_var"].startswith("T")], [weather.STATION_PARAMS[0]])
    # station 4 opened in June, station 1 has a gap; 2001 and the far site have none
    assert rows(got["stations"].select("site_id", "year", "station_id")) == [(7, 2000, 2)]
    data = got["data"].orderBy("W_DATE").collect()
    assert len(data) == 366 and data[10]["TMAX"] == 17.0 and data[0]["TMIN"] == 5.0 and data[0]["TDEW"] is None
    head = got["header"].first()
    assert (head["WST_ELEV"], head["TAV"], head["TAMP"], head["REFHT"]) == (20.0, 11.0, 0.0, 2.0)
    assert got["comments"].first()["comment"].startswith("air_temperature: Station 2 - S2 (51.0 12.1; ELEV = 20.0 m); Distance from site: 7.0 km")


def test_station_archive_age(spark):
    stations, readings = station_fixture(spark)
    wanted = spark.createDataFrame([(7, 51.0, 12.0, 2000)], "site_id int, lat double, lon double, year int")
    covered = weather.coverage(readings.withColumn("variable", F.lit("air_temperature")), ["station_id", "variable"])
    aged = stations.withColumn("per", F.when(F.col("station_id") == 2, "recent").otherwise(""))
    for today, want in (("2010-01-01", 3), ("2001-01-01", 2)):
        got = weather.choose_stations(wanted, aged, covered, [weather.STATION_PARAMS[0]], F.lit(today).cast("date"))
        assert [r["station_id"] for r in got.collect()] == [want]


def lines_of(df):
    return [r["line"] for r in df.orderBy("block_no", "kind", "sort").collect()]


def test_weather_file_layout(spark):
    days = spark.createDataFrame([("e", 1995, "1995-01-01", 2.1)], "e string, Year int, DATE string, SRAD double").withColumn("DATE", F.to_date("DATE"))
    head = spark.createDataFrame([("e", 1995, "Seefeld, Germany", "SEDE", 51.451, 12.221, 123.0, 9.361, 11.459, 2.0, 2.0)], "e string, Year int, SITE string, INSI string, LAT double, LONG double, ELEV double, TAV double, AMP double, REFHT double, WNDHT double")
    notes = spark.createDataFrame([("e", 1995, "wind: Station 2"), ("e", 1995, "rain: Station 1")], "e string, Year int, comment string")
    scope = ["e", "Year"]
    assert lines_of(export.weather_lines(export.build_weather(days, ["e"]), head, notes, scope)) == [
        "*WEATHER: Seefeld, Germany",
        "! rain: Station 1",
        "! wind: Station 2",
        "",
        "@ INSI      LAT     LONG  ELEV   TAV   AMP REFHT WNDHT",
        "  SEDE   51.451   12.221   123   9.4  11.5   2.0   2.0",
        "",
        "@DATE  SRAD  TMAX  TMIN  RAIN  DEWP  WIND   PAR  EVAP  RHUM",
        "95001   2.1   -99   -99   -99   -99   -99   -99   -99   -99",
    ]


def test_summary_file_layout(spark):
    obs = spark.createDataFrame([("e", 1995, 2, "1995-09-12", 6210.0, None), ("e", 1995, 1, "1995-09-11", 6280.0, 5401.0)], "e string, Year int, TRTNO int, MDAT string, HWAHF double, HWAH double").withColumn("MDAT", F.to_date("MDAT"))
    head = spark.createDataFrame([("e", 1995, "Trial")], "e string, Year int, EXP_DETAILS string")
    got = export.observed_lines(export.build_summary(obs, ["e"]), {c: tpl.SUMMARY_FORMATS[c] for c in ("TRTNO", "MDAT", "HWAHF", "HWAH")}, ["e", "Year"], head, "A")
    assert lines_of(got) == ["*EXP. DATA (A): Trial", "", "@TRTNO  MDAT HWAHF  HWAH", "     1 95254  6280  5401", "     2 95255  6210   -99"]


def test_management_file_with_events(spark):
    t = spark.createDataFrame([("e", 2000, 1, "2000-05-01", "IR001", 20.0), ("e", 2000, 1, "2000-06-01", "IR001", None)], "e string, Year int, I int, IDATE string, IROP string, IRVAL double").withColumn("IDATE", F.to_date("IDATE"))
    section = export.format_section(t, tpl.SECTIONS["IRRIGATION"], ["e", "Year"], ["IDATE"])
    head = spark.createDataFrame([("e", 2000, "Trial")], "e string, Year int, EXP_DETAILS string")
    got = lines_of(export.management_lines({"IRRIGATION": section}, ["e", "Year"], head))
    assert got[:3] == ["*EXP.DETAILS: Trial", "", "*IRRIGATION AND WATER MANAGEMENT"] and got[3].startswith("@I  EFIR  IDEP") and got[4].startswith(" 1   -99")
    assert got[5:] == ["@I IDATE  IROP IRVAL", " 1 00122 IR001  20.0", " 1 00153 IR001   -99"]


def test_soil_file_round_trip(spark, tmp_path):
    from agroloom.sources import reports

    layers = spark.createDataFrame([("IB01", 15.0, 0.249), ("IB01", 5.0, 0.228), ("IB02", 10.0, 0.1)], "PEDON string, SLB double, SLLL double")
    header = spark.createDataFrame([("IB01", "SRC", 210.0, 0.11), ("IB02", "SRC", 150.0, None)], "PEDON string, SOURCE string, DEPTH double, SALB double")
    lines = export.soil_lines(export.build_soil(header, layers, ["PEDON"]), ["PEDON"])
    text = lines_of(lines.filter("PEDON = 'IB01'"))
    assert text[0] == "*IB01        SRC          -99      210 -99"
    assert [x[:18] for x in text[-3:]] == ["@  SLB  SLMH  SLLL", "     5   -99 0.228", "    15   -99 0.249"]
    export.write_text(lines, str(tmp_path / "soil"), ["PEDON"])
    back = reports.section_rows(reports.read_sections(spark, f"{tmp_path}/soil/*", "\n*")).filter("block_no = 3")
    got = reports.fields_as(back, {"SLB": "double", "SLLL": "double"})
    assert rows(got.select("SLB", "SLLL")) == [(10.0, 0.1), (15.0, 0.249), (5.0, 0.228)]
