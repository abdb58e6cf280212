"""Experiments that differ in their columns, and conflicts between tables, settled for each experiment alone."""

import pytest
from pyspark.sql import functions as F

from agroloom.operators import merge
from agroloom.plans.reshape import Roles, reshape_experiments
from agroloom.queries import Tables, trials
from agroloom.session import written

DESIGN = "VERSUCHSAUFBAU"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def known(df):
    """Rows as sorted (column, value) pairs of the columns that hold a value anywhere."""
    return sorted((sorted((c, v) for c, v in r.asDict().items() if v is not None) for r in df.collect()), key=str)


def jobs_of(spark, name, fn):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = fn()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


@pytest.fixture(scope="module")
def tables(spark, sf):
    return Tables(spark, sf)


def test_unlike_experiments_are_as_alone(spark, tables):
    landed = {n: written(df, "landed") for n, df in trials.unlike_tables(tables).items()}
    meta = written(trials.trial_metadata(tables), "landed")
    batch, jobs = jobs_of(spark, "batch", lambda: reshape_experiments(landed, meta, DESIGN, trials.BY, observed=False))
    assert jobs <= 36
    for e in ("E1",):
        own = {n: df.where(F.col("experiment_id") == e) for n, df in landed.items()}
        meta = trials.trial_metadata(tables).where(F.col("experiment_id") == e)
        alone = reshape_experiments(own, meta, DESIGN, trials.BY, observed=False)
        for section in ("TREATMENTS", "AUSSAAT", "DUENGUNG", "FIELDS", "GENERAL"):
            assert known(batch[section].where(F.col("experiment_id") == e)) == known(alone[section]), section


def test_a_bad_experiment_is_reported(spark, tables):
    own = {n: df.where("experiment_id = 'E2'") for n, df in trials.unlike_tables(tables).items()}
    with pytest.raises(LookupError, match="lies in the years"):
        reshape_experiments(own, trials.trial_metadata(tables), DESIGN, trials.BY)


def small_trial(spark, treatment="T", plots="P", second_plots=None):
    design = [("a", y, p, p % 2 + 1, 10 * y + p) for y in (2000, 2001) for p in (1, 2, 3, 4)]
    rows_ = {
        "DESIGN": (design, f"e string, Y int, {plots} int, {treatment} int, D_ID int"),
        "PLOTS": ([("a", p, p % 2 + 1, (p + 1) // 2, "x") for p in (1, 2, 3, 4)], f"e string, {plots} int, {treatment} int, R int, Soil string"),
        "TREATS": ([("a", t, t) for t in (1, 2)], f"e string, {treatment} int, F_ID int"),
        "LEVELS": ([("a", t, f"level {t}") for t in (1, 2)], "e string, F_ID int, Label string"),
        "SPRAY": ([("a", y, p, f"{y}-05-0{p % 2 + 1}", 100 * y + p) for y in (2000, 2001) for p in (1, 2, 3, 4)], f"e string, Y int, {plots} int, Day string, S_ID int"),
    }
    if second_plots:
        rows_["OTHER"] = (second_plots, f"e string, {plots} int, Depth int")
    meta = spark.createDataFrame(
        [("a", 2000, 2001, None, None, 1.0, 2.0, "n", "site", "Germany", "c", "m", "i", 1.0, "d")],
        "e string, start_year int, end_year int, number_plots int, replication int, latitude double, longitude double, name string, site string, country string, "
        "contact_name string, contact_email string, trial_institution string, size_plots double, doi string",
    )
    return {n: spark.createDataFrame(r, s) for n, (r, s) in rows_.items()}, meta


def test_roles_of_a_small_trial(spark):
    db, meta = small_trial(spark)
    out = reshape_experiments(db, meta, "DESIGN", ["e"])
    assert rows(out["TREATMENTS"].select("Year", "F_ID", "SPRAY_ID", "FL_ID", "TRTNO")) == [
        (2000, 1, "1", 1, 1), (2000, 2, "2", 1, 2), (2001, 1, "3", 1, 1), (2001, 2, "4", 1, 2)
    ]
    assert rows(out["SPRAY"].select("Year", F.date_format("SPRAY__Day", "yyyy-MM-dd"))) == [(2000, "2000-05-01"), (2000, "2000-05-02"), (2001, "2001-05-01"), (2001, "2001-05-02")]
    assert out["PROBLEMS"].count() == 0
    fixed = reshape_experiments(db, meta, "DESIGN", ["e"], Roles(year="Y", plot="P", treatment="T", rep="R"))
    assert rows(fixed["TREATMENTS"]) == rows(out["TREATMENTS"])


def test_two_tables_for_plots_are_a_problem(spark):
    db, meta = small_trial(spark, second_plots=[("a", p, 5) for p in (1, 2, 3, 4)])
    good, _ = small_trial(spark)
    both = {n: df.unionByName(good[n].withColumn("e", F.lit("b"))) if n in good else df for n, df in db.items()}
    metas = meta.unionByName(meta.withColumn("e", F.lit("b")))
    out = reshape_experiments(both, metas.unionByName(meta.withColumn("e", F.lit("c"))), "DESIGN", ["e"])
    assert rows(out["PROBLEMS"]) == [("a", "2 tables have the plot as their key: PLOTS, OTHER"), ("c", "no rows in DESIGN")]
    assert {r["e"] for r in out["TREATMENTS"].collect()} == {"b"} == {r["e"] for r in out["GENERAL"].collect()}


def test_conflicts_stay_in_their_scope(spark):
    parent = spark.createDataFrame([("a", 1, "x", 1), ("a", 2, None, 2), ("b", 1, "x", 1), (None, 1, "q", 7)], "e string, id int, same string, p int")
    child = spark.createDataFrame([("a", 1, "x", 5), ("a", 2, "y", 6), ("b", 1, "z", 7), (None, 1, "q", 8)], "e string, id int, same string, c int")
    out, jobs = jobs_of(spark, "settle", lambda: merge.merge_settled(parent, child, ["e", "id"], ["e"]))
    assert jobs == 0
    assert rows(out.select("e", "id", "same", "same_x", "same_y", "p", "c")) == [
        ("a", 1, "x", None, None, 1, 5), ("a", 2, "y", None, None, 2, 6), ("b", 1, None, "x", "z", 1, 7), (None, 1, "q", None, None, 7, 8),
    ]
    cat = {"P": {"columns": parent.columns, "key": ["id"]}, "C": {"columns": child.columns, "key": ["id"]}}
    _, jobs = jobs_of(spark, "tables", lambda: merge.merge_tables({"P": parent}, {"C": child}, cat, "child-parent", True, ["e"]))
    assert jobs == 0
    whole = merge.merge_settled(parent.drop("e").limit(0), child.drop("e"), ["id"])
    assert whole.count() == 0 and "same_x" in whole.columns
