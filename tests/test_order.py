"""Queries whose order is the feature: rows as they come against the same rows sorted."""

import datetime as dt
import hashlib

import pytest

from riskgrid.queries.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def digest(row):
    return hashlib.md5(f"{row.feature_date}|{row.location_id}|{row.hour}".encode()).hexdigest()


ORDERS = {
    "q02_event_scan": lambda r: (r.timestamp, r.accident_id),
    "q03_calendar_scan": lambda r: r.date,
    "q05_features_for_day": lambda r: (r.location_id, r.hour),
    "q05_features_for_hours": lambda r: (r.location_id, r.hour),
    "q26_sort_by_time": lambda r: (r.timestamp, r.accident_id),
    "q58_shuffled_rows": digest,
    "q80_high_risk_zones": lambda r: (-r.risk_score, r.location_id, r.prediction_date, r.prediction_hour),
    "q82_predictions_by_date": lambda r: (-r.risk_score, r.location_id, r.prediction_hour),
    "q83_predictions_by_location": lambda r: (-dt.date.fromisoformat(r.prediction_date).toordinal(), r.prediction_hour),
    "q83_predictions_by_location_and_date": lambda r: r.prediction_hour,
    "q84_high_risk_zones": lambda r: (-r.risk_score, r.location_id, r.prediction_hour),
}


@pytest.mark.parametrize("name", ORDERS)
def test_rows_come_in_order(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    places = [ORDERS[name](row) for row in rows]
    assert len(rows) > 1 and len(set(places)) > 1
    assert places == sorted(places)
