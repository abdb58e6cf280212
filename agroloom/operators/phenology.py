"""Missing maturity and anthesis dates from a crop calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroloom.operators.scale import null_safe_join

# Crop code pattern, calendar crop, days from anthesis to maturity.
CROP_RULES = [
    ("WHT|WH|wheat|Wheat|BAR|BA|Barley|barley", "Winter_Wheat", 40),
    ("MAZ|MZ|Maize|maize", "Maize", 50),
]
RECORDED_LAG = 40  # days from anthesis to a recorded maturity, whatever the crop


def jitter(key: list[str], low: int, high: int, seed: int) -> Column:
    """A whole number in [low, high] fixed by the key, so that a re-run gives the same."""
    return (F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(high - low + 1)) + low).cast("int")


def estimate_phenology(
    summary: DataFrame,
    calendar: DataFrame,
    on: list[str],
    crop: str = "CRID",
    year: str = "Year",
    irrigated: bool = False,
    spread_key: list[str] | None = None,
) -> DataFrame:
    """Fill ``MDAT`` and set ``ADAT`` for all experiments at once.

    ``calendar``: ``on`` columns, calendar_crop, irrigation, maturity_doy. A recorded maturity
    stays. Anthesis is 40 days before a recorded maturity, and the crop's lag before an estimated one. ``spread_key`` turns on a variation of
    three days fixed by that key.
    """
    cal_crop, lag = F.lit(None).cast("string"), F.lit(RECORDED_LAG)
    for pattern, name, days in reversed(CROP_RULES):
        hit = F.col(crop).rlike(pattern)
        cal_crop = F.when(hit, name).otherwise(cal_crop)
        lag = F.when(hit, F.lit(days)).otherwise(lag)
    kind = "Irrigated" if irrigated else "Rainfed"
    rows = summary.withColumns({"calendar_crop": cal_crop, "__lag": lag})
    days = calendar.filter(F.col("irrigation") == kind).select(*on, "calendar_crop", "maturity_doy")
    joined = null_safe_join(rows, days, [*on, "calendar_crop"])
    shift = jitter(spread_key, -3, 3, 1) if spread_key else F.lit(0)
    estimate = F.date_add(F.make_date(F.col(year), F.lit(1), F.lit(1)), F.col("maturity_doy").cast("int") - 1 + shift)
    maturity = F.coalesce(F.col("MDAT").cast("date"), F.when(F.col("calendar_crop").isNotNull(), estimate))
    days_before = F.when(F.col("MDAT").isNotNull(), F.lit(RECORDED_LAG)).otherwise(F.col("__lag"))
    out = joined.withColumn("__lag", days_before).withColumn("MDAT", maturity)
    out = out.withColumn("ADAT", F.date_sub("MDAT", F.col("__lag")))
    cols = summary.columns + ([] if "ADAT" in summary.columns else ["ADAT"])
    return out.select(*cols)
