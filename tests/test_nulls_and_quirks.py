"""Hand-made tables for the null rules and for each place where a decision was taken."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from agroloom.functions import aggregates, dates, units
from agroloom.functions.text import cell, signature
from agroloom.operators import columns, ids, mapping, merge, nesting, profile, quality, tagging, weather
from agroloom.operators.phenology import estimate_phenology
from agroloom.operators.scale import null_safe_join, rename_join


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_null_keys_match(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, x string")
    b = spark.createDataFrame([(1, "p"), (None, "q"), (4, "r")], "k int, y string")
    assert rows(null_safe_join(a, b, ["k"], "inner")) == [(1, "a", "p"), (None, "b", "q")]
    assert rows(null_safe_join(a, b, ["k"])) == [(1, "a", "p"), (3, "c", None), (None, "b", "q")]
    assert rows(null_safe_join(a, b, ["k"], "left_anti")) == [(3, "c")]
    assert rows(rename_join(a, b.withColumnRenamed("k", "j"), {"k": "j"}, "inner")) == [(1, "a", "p"), (None, "b", "q")]


def test_key_profile(spark):
    t = spark.createDataFrame([(1, None, 5), (2, "a", 5), (3, "b", None), (4, "c", None)], "id int, name string, v int")
    assert profile.key_columns(t) == ["id"]
    assert profile.key_columns(t, alternates=True) == ["id", "name"]  # one null counts once
    assert not profile.is_unique_id(t, "name", kind="int")
    assert profile.is_unique_id(t, "id", kind="int")
    empty = t.filter("id > 9")
    assert profile.key_columns(empty, alternates=True) == ["id", "name", "v"]


def test_scoped_key(spark):
    t = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2)], "e string, id int")
    assert profile.key_columns(t) == []
    assert profile.key_columns(t, ["e"]) == ["id"]


def test_table_lookup_and_links():
    cat = {"A": {"columns": ["a"], "key": ["a"]}, "B": {"columns": ["b", "a"], "key": ["b"]}, "C": {"columns": ["b", "c"], "key": ["b"]}}
    assert profile.parent_edges(cat) == [("B", "A", "a"), ("B", "C", "b"), ("C", "B", "b")]
    assert profile.table_with_key(cat, "a") == "A"
    with pytest.raises(LookupError):
        profile.table_with_key(cat, "b")
    assert profile.has_link(["a", "b"], ["b"]) and not profile.has_link(["a", "b"], ["b"], ["a"])
    # B and C share a key name: the mutual link is broken by name
    assert merge.fold_order(cat) == [("A", []), ("B", ["A"]), ("C", ["B"])]
    loop = {"A": {"columns": ["a", "b"], "key": ["a"]}, "B": {"columns": ["b", "c"], "key": ["b"]}, "C": {"columns": ["c", "a"], "key": ["c"]}}
    with pytest.raises(ValueError):
        merge.fold_order(loop)


def test_merge_duplicate_columns(spark):
    parent = spark.createDataFrame([(1, "x", 1, 5), (2, None, 2, 6), (3, "z", 9, 7)], "id int, same string, differ int, p int")
    child = spark.createDataFrame([(1, "x", 1, "c1"), (2, "y", 3, "c2"), (3, "z", 9, "c3")], "id int, same string, differ int, c string")
    out = merge.merge_pair(parent, child, ["id"])
    assert sorted(out.columns) == ["c", "differ_x", "differ_y", "id", "p", "same"]
    assert rows(out.select("id", "same")) == [(1, "x"), (2, "y"), (3, "z")]


def test_merge_drops_keys_after_all_children(spark):
    parent = spark.createDataFrame([(1, 10), (2, 20)], "pid int, k int")
    one = spark.createDataFrame([(10, "a"), (20, "b")], "k int, x string")
    two = spark.createDataFrame([(10, "c"), (20, "d")], "k int, y string")
    tables = {"P": parent, "A": one, "B": two}
    cat = profile.catalog(tables)
    out, joined = merge.merge_tables({"P": parent}, {"A": one, "B": two}, cat, "child-parent")
    assert joined == {"P": ["A", "B"]}
    assert rows(out["P"].select("pid", "x", "y")) == [(1, "a", "c"), (2, "b", "d")]
    assert "k" not in out["P"].columns
    assert merge.merge_keys(cat["P"], cat["A"], "parent-child") == []
    assert merge.merge_keys(cat["P"], cat["A"], "bidirectional") == ["k"]


def test_observed_forms(spark):
    u1 = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, x string")
    u2 = spark.createDataFrame([(2, "c"), (3, "d"), (None, "m")], "k int, y string")
    many = spark.createDataFrame([(2, 1), (2, 2), (9, 3)], "k int, v int")
    more = spark.createDataFrame([(2, 7), (2, 8)], "k int, v int")
    assert rows(merge.full_join({"a": u1, "b": u2}, ["k"])) == [(1, "a", None), (2, "b", "c"), (3, None, "d"), (None, "n", "m")]
    assert rows(merge.full_join({"a": u1, "m": many}, ["k"])) == [(1, "a", None), (2, "b", 1), (2, "b", 2), (9, None, 3), (None, "n", None)]
    long = merge.stacked({"m": many, "n": more}, ["k"])
    assert long.columns == ["k", "m__v", "source", "n__v"] and long.count() == 5


def test_observations_keep_their_treatment(spark):
    design = spark.createDataFrame([(1, 10, "A"), (1, 11, "B"), (2, 10, "A")], "y int, p int, t string")
    one = spark.createDataFrame([(1, 10, 5, 1), (1, 10, 6, 2), (3, 10, 7, 3)], "y int, p int, v int, Sample int")
    two = spark.createDataFrame([(1, 11, "B", 8, 4), (1, 10, "C", 9, 5), (4, 1, "Z", 1, 6)], "y int, p int, t string, w int, Sample int")
    got = merge.on_design(design, {"one": one, "two": two}, ["y", "p"], ["t"], long=True)
    have = sorted(tuple(r) for r in got.select("y", "p", "t", "source", "v", "w", "two__t", "one__Sample", "two__Sample").collect() if r["source"])
    assert have == [
        (1, 10, "A", "one", 5, None, None, 1, None),
        (1, 10, "A", "one", 6, None, None, 2, None),
        (1, 10, "A", "two", None, 9, "C", None, 5),
        (1, 11, "B", "two", None, 8, None, None, 4),
        (3, 10, None, "one", 7, None, None, 3, None),
        (4, 1, "Z", "two", None, 1, None, None, 6),
    ]
    # the design's row without any observation stays
    assert [tuple(r) for r in got.where("source IS NULL").select("y", "p", "t").collect()] == [(2, 10, "A")]
    wide = merge.on_design(design, {"one": one.where("v <> 6"), "two": two}, ["y", "p"], ["t"], long=False)
    assert rows(wide.select("y", "p", "t", "v", "w", "one__Sample", "two__Sample")) == sorted(
        [(1, 10, "A", 5, 9, 1, 5), (1, 11, "B", None, 8, None, 4), (2, 10, "A", None, None, None, None), (3, 10, None, 7, None, 3, None), (4, 1, "Z", None, 1, None, 6)], key=str
    )


def test_symmetric_difference_keeps_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    assert rows(merge.rows_in_one(a, b)) == [(1, None), (1, None), (3, "y")]


def test_poison_and_skip(spark):
    t = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0)], "g string, v double")
    for nulls, want in (("poison", [("a", None), ("b", 6.0)]), ("skip", [("a", 1.0), ("b", 6.0)])):
        assert rows(t.groupBy("g").agg(aggregates.aggregate(F.col("v"), "sum", nulls))) == want
    with pytest.raises(ValueError):
        aggregates.aggregate(F.col("v"), "system")
    twice = t.groupBy("g").agg(aggregates.aggregate(F.col("v"), "identity", "skip").alias("v"))
    with pytest.raises(Exception, match="identity"):
        twice.collect()
    spread = t.groupBy("g").agg(aggregates.aggregate(F.col("v"), lambda c: F.max(c) - F.min(c), "skip").alias("v"))
    assert rows(spread) == [("a", 0.0), ("b", 2.0)]


def test_source_priority_and_absent_source(spark):
    t = spark.createDataFrame([(dt.datetime(2020, 1, 1, h), 1.0 if h else None, 7.0 if h == 5 else None) for h in range(6)], "ts timestamp, R1 double, RS double")
    mapping = [m for m in weather.STATION_MAP if m["std_var"] in ("RAIN", "EVAP", "SRAD")]
    skip = weather.daily_weather(t, "ts", mapping, [], nulls="skip").drop("W_DATE").collect()[0]
    assert skip["RAIN"] == 5.0 and skip["EVAP"] is None and skip["SRAD"] is None


def test_interpolation(spark):
    vals = [None, 1.0, None, 3.0, None, None, 9.0]
    data = [("a", i, v, None, 5.0 if i == 3 else None) for i, v in enumerate(vals)]
    t = spark.createDataFrame(data, "g string, d int, v double, none double, one double").withColumn("d", F.date_add(F.lit("2020-01-01"), F.col("d")))
    got = [r["v"] for r in weather.impute(t, ["g"], "d").orderBy("d").collect()]
    assert got == [1.0, 1.0, 2.0, 3.0, 5.0, 7.0, 9.0]
    got = weather.impute(t, ["g"], "d", rule=1).orderBy("d").collect()
    assert [r["v"] for r in got] == [None, 1.0, 2.0, 3.0, 5.0, 7.0, 9.0]
    assert {r["none"] for r in got} == {None} and [r["one"] for r in got].count(5.0) == 1
    filled = weather.impute(t, ["g"], "d", ["one"], single="fill").collect()
    assert {r["one"] for r in filled} == {5.0}


def test_interpolation_by_day_number(spark):
    t = spark.createDataFrame([("a", "2020-01-01", 0.0), ("a", "2020-01-02", None), ("a", "2020-01-05", 4.0)], "g string, d string, v double").withColumn("d", F.to_date("d"))
    assert [r["v"] for r in weather.impute(t, ["g"], "d").orderBy("d").collect()] == [0.0, 2.0, 4.0]
    assert [r["v"] for r in weather.impute(t, ["g"], "d", position="day").orderBy("d").collect()] == [0.0, 1.0, 4.0]


def test_weather_header_values(spark):
    # two months of two days: monthly means 5 and 15
    t = spark.createDataFrame([("2020-01-01", 6.0, 2.0), ("2020-01-02", 8.0, 4.0), ("2020-07-01", 20.0, 8.0), ("2020-07-02", 22.0, 10.0), ("2020-07-03", None, 1.0)], "d string, TMAX double, TMIN double")
    row = weather.annual_summary(t.withColumn("W_DATE", F.to_date("d")), []).first()
    assert row["TAV"] == 10.0 and row["AMP"] == 5.0


def test_reset_ids(spark):
    t = spark.createDataFrame([(1, 0), (1, 4), (1, 5), (2, 0), (2, 0)], "y int, id int")
    assert rows(ids.reset_ids(t, ["id"], ["y"])) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 0)]
    assert rows(ids.reset_ids(t, ["id"])) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 0)]


def test_previous_crop_gap(spark):
    t = spark.createDataFrame([("e", 2000, "a"), ("e", 2001, "b"), ("e", 2003, "c"), ("e", 2004, "d")], "e string, y int, crop string")
    got = ids.previous_year_value(t, ["e"], "y", "crop", "before")
    assert rows(got.select("y", "before")) == [(2000, None), (2001, "a"), (2003, None), (2004, "c")]


def test_latest_flag_null(spark):
    t = spark.createDataFrame([(1, "2020-01-01"), (1, "2020-02-01"), (1, None), (2, None)], "g int, d string")
    assert rows(ids.latest_flag(t, ["g"], "d")) == [(1, "2020-01-01", False), (1, "2020-02-01", True), (1, None, None), (2, None, None)]


def test_tags(spark):
    year_plot = [(y, p) for y in (1, 2) for p in range(10)]
    few = spark.createDataFrame([(i, y, p, p % 2) for i, (y, p) in enumerate(year_plot)], "id int, Year int, Plot_id int, a int")
    mixed = [(i, y, p, i) for i, (y, p) in enumerate(year_plot + [(2, p) for p in range(10)])]
    mixed = spark.createDataFrame(mixed, "id int, Year int, Plot_id int, a int").withColumn("a", F.col("a") * 1.5)
    other = spark.createDataFrame([(1, "x")], "id int, n string")
    db = {"FEW": few, "MIXED": mixed, "OTHER": other}
    got = tagging.tag_tables(db, "Year", "Plot_id", 10, {"FEW": ["id"], "MIXED": ["id"], "OTHER": ["id"]})
    assert {t: sorted(v) for t, v in got.items()} == {
        "management": ["FEW"], "observed_summary": ["MIXED"], "observed_timeseries": ["MIXED"], "other": ["OTHER"]
    }
    assert got["observed_timeseries"]["MIXED"].count() == 20


@pytest.mark.parametrize(
    "events, want",
    [
        ([(1, 1, "d1", "a"), (1, 2, "d1", "a"), (1, 3, "d1", "a")], False),
        ([(1, 1, "d1", "a"), (1, 2, "d1", "b"), (1, 3, "d1", "a")], True),
        ([(1, 1, "d1", "a"), (1, 2, "d1", "a"), (2, 3, "d1", "a")], True),  # plot 3 has no event in year 1
        ([(1, p, "d1", x) for p in (1, 2, 3) for x in "ab"], False),  # tied dates, same records
        ([(1, p, "d1", "a") for p in (1, 2, 3)] + [(1, 1, "d1", "a")], True),  # one more copy in plot 1
    ],
)
def test_treatment_flag(spark, events, want):
    t = spark.createDataFrame(events, "Year int, Plot_id int, d string, what string")
    flags = {r["Year"]: r["is_trt"] for r in tagging.treatment_years(t, "Year", "Plot_id").collect()}
    assert flags[1] is want


def test_treatment_without_plots(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b")], "Year int, what string")
    assert rows(tagging.treatment_years(t, "Year", None)) == [(1, False)]


def test_day_of_year_codes(spark):
    t = spark.createDataFrame([("68366",), ("69001",), ("00366",), ("99365",), ("01366",)], "c string")
    got = [r[0] for r in t.select(dates.from_doy(F.col("c"))).collect()]
    assert got == [dt.date(2068, 12, 31), dt.date(1969, 1, 1), dt.date(2000, 12, 31), dt.date(1999, 12, 31), None]


def test_date_traps(spark):
    t = spark.createDataFrame([(19670629, 12001, "1984-01-01T00:00:00", "x", None), (None, 12168, None, "2020-01-01", None)], "flowering int, plot int, stamp string, mix string, none string")
    assert profile.date_layouts(t) == {"flowering": ["yyyyMMdd"], "stamp": ["yyyy-MM-dd'T'HH:mm:ss"]}
    assert profile.date_layouts(t, ["plot"], doy=["plot"]) == {"plot": ["yyDDD"]}


def test_date_share(spark):
    t = spark.createDataFrame([("2020-01-01", "01.02.2020", "")] * 8 + [("x", "y", "")] * 2 + [("", "z", "")], "a string, b string, c string")
    assert profile.date_columns_by_share(t) == ["a", "b"]
    assert profile.has_multiple_date_columns(t)


def test_standard_names_conflicts():
    renames, conflicts = columns.standard_names(["Versuchsjahr", "Kultur_ID", "Kultur_Englisch", "Termin"])
    assert renames == {"Versuchsjahr": "Year", "Termin": "Date"}
    assert conflicts == ["Kultur_Englisch", "Kultur_ID"]


def test_code_maps(spark):
    t = spark.createDataFrame([("list('a: X', 'c(b, d): Y', 'e: 1')",), ("1",)], "code_mappings string")
    assert rows(mapping.code_lookup(t)) == [("a", "X"), ("b", "Y"), ("d", "Y"), ("e", "e")]
    data = spark.createDataFrame([("a",), ("d",), ("e",), ("zz",), (None,)], "crop string")
    lookup = mapping.code_lookup(t).withColumn("std_header", F.lit("crop"))
    assert [r[0] for r in mapping.map_codes(data, lookup, ["crop"]).collect()] == ["X", "Y", "e", None, None]
    listed = spark.createDataFrame([("list('c(corn, cacao): X', 'abc(d): Y')",)], "code_mappings string")
    assert rows(mapping.code_lookup(listed)) == [("abc(d)", "Y"), ("cacao", "X"), ("corn", "X")]
    none = lookup.filter("source = 'q'")
    assert mapping.map_codes(data, none, ["crop"]).collect() == data.collect()


def test_header_mapping_single_pass():
    m = [dict(table_name="T", column_header=a, std_header=b) for a, b in (("x", "y"), ("y", "z"), ("w", ""))]
    assert mapping.header_renames(["x", "y", "w"], m, "T") == {"x": "y", "y": "z"}


def test_units():
    assert units.conversion("degree_C", "degree_F")[0] == pytest.approx(1.8)
    assert units.conversion("degree_C", "degree_F")[1] == pytest.approx(32)
    assert units.conversion("dt/ha", "kg/ha") == (pytest.approx(100), 0)
    with pytest.raises(ValueError):
        units.conversion("kg", "m")


def test_nesting(spark):
    t = spark.createDataFrame([("g", i, None if i == 2 else i) for i in range(1500)], "g string, i int, v int")
    got = nesting.collapse_columns(t, ["i", "v"], ["i"])
    assert got.columns == ["g", "items"] and [x["i"] for x in got.first()["items"]] == list(range(1500))
    assert rows(nesting.unnest(got)) == rows(t)
    empty = spark.createDataFrame([("g", [])], "g string, items array<struct<a:int>>")
    assert rows(nesting.unnest(empty)) == [("g", None)]


def test_joined_text(spark):
    t = spark.createDataFrame([("e", "b"), ("e", "a"), ("e", "b"), ("e", None)], "e string, r string")
    assert rows(nesting.joined_text(t, ["e"], "r")) == [("e", "a; b")]
    many = spark.range(1500).select(F.lit("e").alias("e"), F.lpad(F.col("id").cast("string"), 4, "0").alias("r"))
    assert rows(nesting.joined_text(many, ["e"], "r")) == [("e", "; ".join(f"{i:04d}" for i in range(1500)))]


def test_cells(spark):
    t = spark.createDataFrame([(1.25, "ab"), (None, None)], "n double, s string")
    got = t.select(cell(F.col("n"), "%6.1f"), cell(F.col("s"), "%6s"), signature(["n", "s"])).collect()
    assert got[0][1] == "    ab" and got[1][0] == "   -99" and got[1][1] == "   -99" and got[1][2] == "NA|NA"


def test_compare_tolerance(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y"), (3, None, None)], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.1, "x"), (2, 2.2, "q"), (3, None, None), (4, 0.0, "")], "k int, v double, s string")
    assert rows(quality.compare_tables(a, b, ["k"], {"v": 1})) == [("s", 1, 3, 1), ("v", 1, 3, 1)]


def test_phenology(spark):
    data = [(1, 2000, "WHT", None), (2, 2000, "MAZ", None), (3, 2000, "SBT", None), (4, 2000, "MAZ", "2000-09-01"), (5, 2000, "SBT", "2000-09-01")]
    t = spark.createDataFrame(data, "id int, Year int, CRID string, MDAT string").withColumn("MDAT", F.to_date("MDAT"))
    cal = spark.createDataFrame([("Winter_Wheat", "Rainfed", 200), ("Maize", "Rainfed", 250), ("Maize", "Irrigated", 1)], "calendar_crop string, irrigation string, maturity_doy int")
    got = {r["id"]: (r["MDAT"], r["ADAT"]) for r in estimate_phenology(t, cal, []).collect()}
    d = dt.date(2000, 7, 18)
    assert got[1] == (d, d - dt.timedelta(40))
    assert got[2] == (dt.date(2000, 9, 6), dt.date(2000, 9, 6) - dt.timedelta(50))
    assert got[3] == (None, None)
    assert got[4][1] == dt.date(2000, 9, 1) - dt.timedelta(40)
    assert got[5][1] == dt.date(2000, 9, 1) - dt.timedelta(40)
    moved = estimate_phenology(t, cal, [], spread_key=["id"]).collect()
    again = estimate_phenology(t, cal, [], spread_key=["id"]).collect()
    assert moved == again and all(abs((r["MDAT"] - got[r["id"]][0]).days) <= 3 for r in moved if r["id"] == 1)
