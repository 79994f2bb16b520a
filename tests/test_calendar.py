from datetime import date, timedelta

from pyspark.sql import functions as F

from shelfledger.functions import calendar, horizons

START, DAYS = date(1990, 1, 1), 14_610


def _python_labels(d: date) -> dict:
    week = int(d.strftime("%W")) + (0 if date(d.year, 1, 1).weekday() == 0 else 1)
    monday = d - timedelta(days=d.weekday())
    return {
        "year": d.strftime("Yr%Y"), "month": d.strftime("%m. %b"), "day_month": d.strftime("%m. %d"),
        "label": d.strftime("%b %Y"), "week": int(d.strftime("%W")), "week_year": f"{week}.{d.year}",
        "wk": f"Wk{week:02d}", "day_week": f"{d.isoweekday():02d}.{d:%a}", "delivery": d.strftime("%m.%b"),
        "wk_num": f"Wk{int(monday.strftime('%U')):02d}",
    }


def test_labels_match_strftime_over_forty_years(spark):
    d = F.col("d")
    got = spark.range(DAYS).select(F.date_add(F.lit(START), F.col("id").cast("int")).alias("d")).select(
        "d", calendar.calendar_year(d).alias("year"), calendar.calendar_month(d).alias("month"),
        calendar.calendar_day_month(d).alias("day_month"), calendar.month_label(d).alias("label"),
        calendar.week_monday(d).alias("week"), calendar.week_year(d).alias("week_year"), calendar.wk(d).alias("wk"),
        calendar.calendar_day_week(d).alias("day_week"), calendar.delivery_month(d).alias("delivery"),
        calendar.calendar_wk_num(d).alias("wk_num"),
    ).collect()
    assert len(got) == DAYS
    wrong = [r for r in got if r.asDict() != {"d": r.d, **_python_labels(r.d)}]
    assert not wrong


def test_first_days_of_january_carry_last_years_sunday_week(spark):
    d = F.lit("2025-01-01").cast("date")
    assert spark.range(1).select(calendar.calendar_wk_num(d)).first()[0] == "Wk52"


def test_null_dates_give_null_labels(spark):
    d = F.lit(None).cast("date")
    labels = spark.range(1).select(*[c.alias(n) for n, c in calendar.sales_calendar(d).items()]).first()
    assert set(labels) == {None}


def test_calendar_dim_has_one_row_per_date(spark):
    df = spark.createDataFrame([(date(2024, 12, 30),), (date(2024, 12, 30),), (date(2025, 1, 1),)], "d date")
    got = {r.d: r.WeekYear for r in calendar.calendar_dim(df, "d").collect()}
    assert got == {date(2024, 12, 30): "53.2024", date(2025, 1, 1): "1.2025"}


def test_horizons(spark):
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2025, 1, 31),), (date(2025, 2, 1),), (date(2025, 3, 14),),
                                  (date(2025, 3, 15),), (date(2025, 3, 16),), (None,)], "d date")
    d, as_of = F.col("d"), "2025-03-15"

    def kept(condition):
        return [str(r.d) for r in days.filter(condition).orderBy("d").collect()]

    assert kept(horizons.yesterday(d, as_of)) == ["2025-03-14"]
    assert kept(horizons.previous_month_to_date(d, as_of)) == ["2025-02-01", "2025-03-14", "2025-03-15"]
    assert kept(horizons.previous_year_to_date(d, as_of)) == ["2024-01-01", "2025-01-31", "2025-02-01", "2025-03-14", "2025-03-15"]


def test_business_date_follows_its_offset(spark):
    far = spark.range(1).select(horizons.business_date("+14:00"), horizons.business_date("-10:00")).first()
    assert (far[0] - far[1]).days == 1
