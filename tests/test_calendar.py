import datetime as dt

from riskgrid.operators import calendar as cal

# Known holidays of years that exercise every rule.
KNOWN = {
    "2016-01-18": "Martin Luther King Jr. Day",
    "2016-12-25": "Christmas Day",
    "2016-12-26": "Christmas Day (Observed)",
    "2017-01-02": "New Year's Day (Observed)",
    "2018-05-28": "Memorial Day",
    "2019-11-28": "Thanksgiving",
    "2020-07-03": "Independence Day (Observed)",
    "2020-02-17": "Washington's Birthday",
    "2021-06-18": "Juneteenth National Independence Day (Observed)",
    "2021-12-24": "Christmas Day (Observed)",
    "2021-12-31": "New Year's Day (Observed)",
    "2022-09-05": "Labor Day",
    "2022-10-10": "Columbus Day",
    "2023-11-10": "Veterans Day (Observed)",
    "2024-11-28": "Thanksgiving",
}


def test_calendar(spark):
    rows = cal.build_calendar(cal.date_bounds(spark)).collect()
    by_date = {str(r.date): r for r in rows}
    assert len(rows) == len(by_date) == (dt.date(2024, 12, 31) - dt.date(2016, 1, 1)).days + 1
    for date, name in KNOWN.items():
        assert (by_date[date].is_holiday, by_date[date].holiday_name) == (True, name)
    assert not any("Juneteenth" in (r.holiday_name or "") for r in rows if r.year < 2021)
    for r in rows:
        assert r.day_of_week == r.date.weekday() and r.is_weekend == (r.date.weekday() >= 5)
        assert r.week_of_year == r.date.isocalendar().week and r.quarter == (r.month + 2) // 3
        assert r.day_name == r.date.strftime("%A") and r.is_holiday == (r.holiday_name is not None)
    by_year = {y: sum(r.is_holiday and "(Obs" not in r.holiday_name for r in rows if r.year == y) for y in (2020, 2021)}
    assert by_year == {2020: 10, 2021: 11}


def test_one_day(spark):
    bounds = cal.date_bounds(spark, "2021-12-31", "2021-12-31")
    assert [r.holiday_name for r in cal.build_calendar(bounds).collect()] == ["New Year's Day (Observed)"]
