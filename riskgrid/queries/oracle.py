"""The same results as DuckDB SQL, written from the definitions.

Windows are direct interval joins, splits are row numbers over whole classes and the AUC is a rank
sum, so that none of the library's methods is repeated here.
"""

from __future__ import annotations

import re

from riskgrid import schemas
from riskgrid.queries.views import other_raw_texts

# The raw texts under headers without a rule below, and how each kind of column is cleaned.
_OTHER = other_raw_texts()
_OTHER_TEXTS = ", ".join(f'{text} as "{header}"' for header, text in _OTHER.items())
_OTHER_RENAMED = ", ".join(f'"{header}" as {schemas.RAW_COLUMNS[header]}' for header in _OTHER)


def _cleaned(columns: list[str]) -> str:
    kinds = {
        **{c: f"coalesce(cast({c} as boolean), false) as {c}" for c in schemas.FLAG_COLUMNS},
        **{c: f"try_cast({c} as double) as {c}" for c in schemas.MEASURE_COLUMNS},
        **{c: f"nullif({c}, 'nan') as {c}" for c in schemas.TEXT_COLUMNS},
    }
    return ", ".join(kinds[c] for c in columns)


_OTHER_CLEANED = _cleaned([schemas.RAW_COLUMNS[header] for header in _OTHER])

# Named subqueries; ``oracle`` puts those that a text mentions in front of it.
_PARTS: dict[str, str] = {
    "accidents": """
        select cast(event_id as varchar) as accident_id, ts as "timestamp",
               25e0 + (user_id % 10) * 0.5e0 as latitude,
               -120e0 + cast(floor(user_id / 10e0) as double) * 0.25e0 as longitude,
               cast(1 + event_id % 4 as integer) as severity,
               case when event_id % 7 = 0 then null else value end as temperature_f,
               cast(event_id % 11 as double) as visibility_mi,
               case when event_id % 3 = 0 then null else cast(event_id % 5 as double) / 8e0 end as precipitation_in,
               cast(json_extract_string(props, '$.k') as double) as wind_speed_mph,
               cast(event_id % 101 as double) as humidity,
               29e0 + (event_id % 64) / 64e0 as pressure_in,
               case event_type when 'click' then 'Clear' when 'view' then 'Light Snow'
                    when 'error' then 'Heavy Rain' when 'signup' then 'fog' end as weather_condition
        from events""",
    "placed": """
        select *, cast("timestamp" as date) as d, cast(hour("timestamp") as integer) as h,
               cast(round(latitude * 10000) as bigint) as lat_e4,
               cast(round(longitude * 10000) as bigint) as lon_e4,
               datediff('hour', timestamp '1970-01-01', "timestamp") as hour_idx
        from accidents""",
    "raw": f"""
        select cast(event_id as varchar) as "ID",
               case when event_id % 97 = 0 then 'not a time'
                    when event_id % 101 <> 0 then strftime(ts, '%Y-%m-%d %H:%M:%S') end as "Start_Time",
               case when event_id % 89 = 0 then '95.0'
                    else cast(25e0 + (user_id % 10) * 0.5e0 as varchar) end as "Start_Lat",
               cast(-120e0 + cast(floor(user_id / 10e0) as double) * 0.25e0 as varchar) as "Start_Lng",
               case when event_id % 83 <> 0 then cast(1 + event_id % 4 as varchar) end as "Severity",
               case when event_id % 79 = 0 then 'abc' else cast(value as varchar) end as "Temperature(F)",
               case when event_id % 2 = 0 then 'True' when event_id % 3 <> 0 then 'False' end as "Junction",
               case when event_type = 'purchase' then 'nan' else event_type end as "Weather_Condition",
               case when event_id % 13 = 0 then 'NaT' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as "Weather_Timestamp",
               {_OTHER_TEXTS}
        from events""",
    "renamed": f"""
        select "ID" as accident_id, "Start_Time" as "timestamp", "Start_Lat" as latitude, "Start_Lng" as longitude,
               "Severity" as severity, "Temperature(F)" as temperature_f, "Junction" as junction,
               "Weather_Condition" as weather_condition, "Weather_Timestamp" as weather_timestamp, {_OTHER_RENAMED}
        from raw""",
    "cleaned": f"""
        select accident_id, try_cast("timestamp" as timestamp) as "timestamp",
               cast(latitude as double) as latitude, cast(longitude as double) as longitude,
               coalesce(cast(try_cast(severity as double) as integer), 0) as severity,
               try_cast(temperature_f as double) as temperature_f,
               coalesce(try_cast(junction as boolean), false) as junction,
               nullif(weather_condition, 'nan') as weather_condition,
               try_cast(weather_timestamp as timestamp) as weather_timestamp, {_OTHER_CLEANED}
        from renamed
        where accident_id is not null and latitude is not null and longitude is not null
          and try_cast("timestamp" as timestamp) is not null
          and cast(latitude as double) between -90 and 90 and cast(longitude as double) between -180 and 180""",
    "order_days": """
        select cast(s.day as date) as "date", cast(count(o.o_orderkey) as bigint) as orders
        from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as day from orders) s
        left join orders o on cast(o.o_orderdate as date) = cast(s.day as date)
        group by 1""",
    "years": """
        select unnest(range(least(min(year(o_orderdate)), (select min(year(ts)) from events)),
                            greatest(max(year(o_orderdate)), (select max(year(ts)) from events)) + 2)) as y
        from orders""",
    "fixed_days": """
        select make_date(y, 1, 1) as d, 'New Year''s Day' as n from years
        union all select make_date(y, 6, 19), 'Juneteenth National Independence Day' from years where y >= 2021
        union all select make_date(y, 7, 4), 'Independence Day' from years
        union all select make_date(y, 11, 11), 'Veterans Day' from years
        union all select make_date(y, 12, 25), 'Christmas Day' from years""",
    "floating_days": """
        select make_date(y, 1, 15) as d, 1 as w, 'Martin Luther King Jr. Day' as n from years
        union all select make_date(y, 2, 15), 1, 'Washington''s Birthday' from years
        union all select make_date(y, 5, 25), 1, 'Memorial Day' from years
        union all select make_date(y, 9, 1), 1, 'Labor Day' from years
        union all select make_date(y, 10, 8), 1, 'Columbus Day' from years
        union all select make_date(y, 11, 22), 4, 'Thanksgiving' from years""",
    "holiday_days": """
        select d as "date", n as holiday_name from fixed_days
        union all select cast(d - 1 as date), n || ' (Observed)' from fixed_days where isodow(d) = 6
        union all select cast(d + 1 as date), n || ' (Observed)' from fixed_days where isodow(d) = 7
        union all select cast(d + cast((w + 7 - isodow(d)) % 7 as integer) as date), n from floating_days""",
    "calendar": """
        select o."date", o.orders, cast(year(o."date") as integer) as year, cast(month(o."date") as integer) as month,
               cast(day(o."date") as integer) as day, cast(isodow(o."date") - 1 as integer) as day_of_week,
               dayname(o."date") as day_name, isodow(o."date") >= 6 as is_weekend,
               cast(quarter(o."date") as integer) as quarter, cast(weekofyear(o."date") as integer) as week_of_year,
               h.holiday_name is not null as is_holiday, h.holiday_name
        from order_days o left join holiday_days h on h."date" = o."date" """,
    "places": "select distinct latitude, longitude, lat_e4, lon_e4 from placed",
    "days": "select cast(unnest(generate_series(min(d), max(d), interval 1 day)) as date) as d from placed",
    "grid": """
        select d as feature_date, cast(i.range as integer) as hour, latitude, longitude, lat_e4, lon_e4,
               cast(d as timestamp) + i.range * interval 1 hour as feature_datetime,
               concat_ws('_', cast(latitude as varchar), cast(longitude as varchar)) as location_id
        from days, range(24) i, places""",
    "conditions": """
        select lat_e4, lon_e4, hour_idx, weather_condition from (
            select *, row_number() over (
                partition by lat_e4, lon_e4, hour_idx order by n desc, weather_condition nulls last) as r
            from (select lat_e4, lon_e4, hour_idx, weather_condition, count(weather_condition) as n
                  from placed group by all))
        where r = 1""",
    "weather": """
        select p.lat_e4, p.lon_e4, p.hour_idx, count(*) as event_count,
               round(quantile_cont(temperature_f, 0.5e0), 6) as temperature_f,
               round(quantile_cont(visibility_mi, 0.5e0), 6) as visibility_mi,
               round(quantile_cont(precipitation_in, 0.5e0), 6) as precipitation_in,
               round(quantile_cont(wind_speed_mph, 0.5e0), 6) as wind_speed_mph,
               round(quantile_cont(humidity, 0.5e0), 6) as humidity,
               round(quantile_cont(pressure_in, 0.5e0), 6) as pressure_in,
               any_value(c.weather_condition) as weather_condition
        from placed p join conditions c using (lat_e4, lon_e4, hour_idx)
        group by all""",
    "grid_weather": """
        select g.*, w.* exclude (lat_e4, lon_e4, hour_idx)
        from grid g left join weather w
          on w.lat_e4 = g.lat_e4 and w.lon_e4 = g.lon_e4
         and w.hour_idx = datediff('hour', timestamp '1970-01-01', g.feature_datetime)""",
    "grid_medians": """
        select quantile_cont(temperature_f, 0.5e0) as temperature_f, quantile_cont(visibility_mi, 0.5e0) as visibility_mi,
               quantile_cont(precipitation_in, 0.5e0) as precipitation_in,
               quantile_cont(wind_speed_mph, 0.5e0) as wind_speed_mph,
               quantile_cont(humidity, 0.5e0) as humidity, quantile_cont(pressure_in, 0.5e0) as pressure_in
        from grid_weather""",
    "grid_imputed": """
        select g.* exclude (temperature_f, visibility_mi, precipitation_in, wind_speed_mph, humidity, pressure_in),
               round(coalesce(g.temperature_f, m.temperature_f), 6) as temperature_f,
               round(coalesce(g.visibility_mi, m.visibility_mi), 6) as visibility_mi,
               round(coalesce(g.precipitation_in, m.precipitation_in), 6) as precipitation_in,
               round(coalesce(g.wind_speed_mph, m.wind_speed_mph), 6) as wind_speed_mph,
               round(coalesce(g.humidity, m.humidity), 6) as humidity,
               round(coalesce(g.pressure_in, m.pressure_in), 6) as pressure_in
        from grid_weather g, grid_medians m""",
    "cells": """
        select cl, cn, cast(row_number() over (order by min("timestamp"), cl, cn) - 1 as integer) as cluster_id
        from (select floor(latitude) as cl, floor(longitude) as cn, "timestamp" from placed)
        group by cl, cn""",
    "cluster_map": """
        select lat_e4, lon_e4, latitude, longitude, cluster_id from (
            select p.*, c.cluster_id, row_number() over (
                partition by lat_e4, lon_e4 order by "timestamp" desc, c.cluster_id desc) as r
            from placed p join cells c on c.cl = floor(latitude) and c.cn = floor(longitude))
        where r = 1""",
    "history": "select lat_e4, lon_e4, count(*) as freq from placed group by all",
    "grid_history": "select g.*, freq from grid g join history using (lat_e4, lon_e4)",
    "quartiles": """
        select quantile_cont(freq, 0.25e0) as low, quantile_cont(freq, 0.75e0) as high from grid_history""",
    "grid_roads": """
        select g.*, case when freq > high then 'highway' when freq >= low then 'arterial'
                         else 'residential' end as road_type
        from grid_history g, quartiles""",
    "grid_counts": """
        select g.feature_date, g.location_id, g.hour,
               count(*) filter (where e.t < feature_datetime and e.t >= feature_datetime - interval 24 hour) as n24,
               count(*) filter (where e.t < feature_datetime and e.t >= feature_datetime - interval 3 day) as n3,
               count(*) filter (where e.t < feature_datetime and e.t >= feature_datetime - interval 7 day) as n7,
               count(*) filter (where e.t < feature_datetime and e.t >= feature_datetime - interval 30 day) as n30,
               count(*) filter (where e.t >= feature_datetime and e.t < feature_datetime + interval 6 hour) as f6,
               count(*) filter (where e.t >= feature_datetime and e.t < feature_datetime + interval 24 hour) as f24
        from grid g left join (select lat_e4, lon_e4, "timestamp" as t from placed) e
          on e.lat_e4 = g.lat_e4 and e.lon_e4 = g.lon_e4
         and e.t >= feature_datetime - interval 30 day and e.t < feature_datetime + interval 24 hour
        group by all""",
    "features": """
        select g.feature_date, g.location_id, g.latitude, g.longitude, g.hour,
               cast(isodow(g.feature_date) - 1 as integer) as day_of_week,
               cast(month(g.feature_date) as integer) as month,
               isodow(g.feature_date) >= 6 as is_weekend,
               h.holiday_name is not null as is_holiday,
               g.hour in (7, 8, 9, 17, 18, 19) as is_rush_hour,
               g.temperature_f, g.visibility_mi, g.precipitation_in, g.wind_speed_mph, g.humidity, g.pressure_in,
               g.weather_condition,
               coalesce(contains(g.weather_condition, 'Snow') or contains(g.weather_condition, 'Heavy Rain')
                        or contains(g.weather_condition, 'Fog') or contains(g.weather_condition, 'Storm')
                        or contains(g.weather_condition, 'Ice') or contains(g.weather_condition, 'Sleet'), false)
                   as is_severe_weather,
               cast(r.freq as integer) as accident_freq_historical,
               cast(n7 as integer) as rolling_7day_accidents, cast(n30 as integer) as rolling_30day_accidents,
               m.cluster_id, r.road_type,
               cast(n24 as integer) as accidents_last_24h, cast(n7 as integer) as accidents_last_7days,
               n3 / 3e0 as moving_avg_3day, n7 / 7e0 as moving_avg_7day, n30 / 30e0 as moving_avg_30day,
               cast(f24 > 0 as integer) as accident_occurred_next_24h
        from grid_imputed g
        join grid_counts c using (feature_date, location_id, hour)
        join grid_roads r using (feature_date, location_id, hour)
        join cluster_map m on m.lat_e4 = g.lat_e4 and m.lon_e4 = g.lon_e4
        left join holiday_days h on h."date" = g.feature_date""",
    "ordered_features": """
        select *, md5(concat_ws('|', cast(feature_date as varchar), location_id, cast(hour as varchar))) as digest,
               row_number() over (partition by accident_occurred_next_24h order by digest) as r,
               count(*) over (partition by accident_occurred_next_24h) as n
        from features""",
    "split_features": """
        select *, case when r <= floor(n * 0.70e0) then 'train' when r <= floor(n * 0.85e0) then 'val'
                       else 'test' end as split
        from ordered_features""",
    "predictions": """
        select d as prediction_date, h as prediction_hour,
               concat_ws('_', cast(latitude as varchar), cast(longitude as varchar)) as location_id,
               latitude, longitude, max(score) as risk_score, max(version) as model_version,
               case when max(score) >= 0.75e0 then 'High' when max(score) >= 0.5e0 then 'Medium'
                    else 'Low' end as risk_category
        from (select cast(ts as date) as d, cast(hour(ts) as integer) as h,
                     25e0 + (user_id % 10) * 0.5e0 as latitude,
                     -120e0 + cast(floor(user_id / 10e0) as double) * 0.25e0 as longitude,
                     least(1e0, value / 200e0) as score,
                     case when event_id % 2 = 0 then 'v1' else 'v2' end as version
              from events)
        group by d, h, latitude, longitude""",
    "scored": """
        select doc_id, source, quality as y, (n_chars % 1000) / 1000e0 as p
        from labels join documents using (doc_id)""",
    "metadata": """
        select o_orderpriority as model_name, cast(o_orderkey as varchar) as model_version,
               o_orderdate as training_date, o_totalprice as auc_score
        from orders""",
}

_KEY = "feature_date, location_id, hour"
_LABEL = "accident_occurred_next_24h"
_DAY = "date '2024-01-15'"
_WEATHER = "temperature_f, visibility_mi, precipitation_in, wind_speed_mph, humidity, pressure_in"
_SERVED = (
    "cast(prediction_date as varchar) as prediction_date, prediction_hour, location_id, latitude, longitude, "
    "round(risk_score, 6) as risk_score, risk_category"
)


def oracle(text: str) -> str:
    """``text`` with all named subqueries it needs, each before its first use."""
    needed: list[str] = []

    def walk(sql: str) -> None:
        # Names that follow FROM, JOIN or a comma may be tables.
        words = set(re.findall(r"(?:\bfrom\b|\bjoin\b|,)\s*\(?\s*([a-z_]+)", sql))
        for name in _PARTS:
            if name in words and name not in needed:
                walk(_PARTS[name])
                needed.append(name)

    walk(text)
    if not needed:
        return text
    parts = ",\n".join(f"{name} as ({_PARTS[name].strip()})" for name in needed)
    return f"with {parts}\n{text.strip()}"


def _metrics(table: str, by: str = "") -> str:
    """Outcome counts, rates and rank-sum AUC of a table with columns y and p."""
    group, listed = (f"group by {by}", f"{by}, ") if by else ("", "")
    part = f"partition by {by} " if by else ""
    return f"""
        select {listed}tn as true_negatives, fp as false_positives, fn as false_negatives, tp as true_positives,
               round(case when tp + fp = 0 then 0e0 else tp / cast(tp + fp as double) end, 6) as precision,
               round(case when tp + fn = 0 then 0e0 else tp / cast(tp + fn as double) end, 6) as recall,
               round(case when 2 * tp + fp + fn = 0 then 0e0 else 2 * tp / cast(2 * tp + fp + fn as double) end, 6) as f1,
               round((tp + tn) / cast(tp + tn + fp + fn as double), 6) as accuracy,
               round(case when tp + fn = 0 or tn + fp = 0 then null else
                   cast((ranks - (tp + fn) * (tp + fn + 1) / 2e0) / (cast(tp + fn as double) * (tn + fp)) as double)
               end, 6) as auc
        from (select {listed}count(*) filter (where y = 0 and p < 0.5e0) as tn,
                     count(*) filter (where y = 0 and p >= 0.5e0) as fp,
                     count(*) filter (where y = 1 and p < 0.5e0) as fn,
                     count(*) filter (where y = 1 and p >= 0.5e0) as tp,
                     sum(case when y = 1 then rank_avg end) as ranks
              from (select *, rank() over ({part}order by p)
                              + (count(*) over ({part.strip() + ", p" if by else "partition by p"}) - 1) / 2e0 as rank_avg
                    from {table})
              {group})"""


def _window(columns: str) -> str:
    return f"select {_KEY}, {columns} from grid_counts"


_TEXTS: dict[str, str] = {
    "q01_csv_event_scan": f"""
        select "ID", "Start_Time", "Start_Lat", "Start_Lng", "Severity", "Temperature(F)", "Junction", "Weather_Timestamp",
               {", ".join(f"""nullif("{h}", 'nan') as "{h}" """ for h in ["Weather_Condition", *_OTHER])}
        from raw""",
    "q02_event_scan": "select * from accidents",
    "q02_event_scan_summary": """
        select count(*) as rows, min(ts) as first_timestamp, max(ts) as last_timestamp from events""",
    "q03_calendar_scan": "select * from calendar",
    "q04_sql_read": """
        select event_type, count(*) as events, round(avg(value), 6) as mean_value
        from events where value >= 10e0 group by event_type""",
    "q05_features_for_day": f"""
        select {_KEY}, temperature_f, {_LABEL} from features where feature_date = {_DAY}""",
    "q05_features_for_hours": f"""
        select {_KEY}, road_type, {_LABEL} from features where feature_date = {_DAY} and hour in (7, 8, 17)""",
    "q06_table_facts": """
        select 'events' as table_name, true as table_exists, count(*) as row_count,
               strftime(max(ts), '%Y-%m-%d') as latest_date from events
        union all select 'orders', true, count(*), strftime(max(o_orderdate), '%Y-%m-%d') from orders
        union all select 'lineitem', true, count(*), strftime(max(l_shipdate), '%Y-%m-%d') from lineitem""",
    "q07_insert_ignore": 'select accident_id, "timestamp", severity, weather_condition from accidents',
    "q08_write_policy": """
        select 'append' as policy, count(*) + count(*) filter (where weather_condition = 'Clear') as rows,
               cast(sum(severity) + sum(severity) filter (where weather_condition = 'Clear') as bigint) as severity
        from accidents
        union all select 'replace', count(*), cast(sum(severity) as bigint) from accidents
        union all select 'cancel', count(*), cast(sum(severity) as bigint) from accidents
        where weather_condition = 'Clear'
        union all select 'cancel, empty', count(*), cast(sum(severity) as bigint) from accidents
        union all select 'fail, empty', count(*), cast(sum(severity) as bigint) from accidents""",
    "q09_key_violations": """
        select 'accidents' as table_name, accident_id as key, count(*) as rows
        from accidents group by accident_id having count(*) > 1
        union all select 'predictions', concat_ws('|', prediction_date, prediction_hour, location_id), count(*)
        from predictions group by prediction_date, prediction_hour, location_id having count(*) > 1
        union all select 'place_hours', concat_ws('|', lat_e4, lon_e4, hour_idx), count(*)
        from placed group by lat_e4, lon_e4, hour_idx having count(*) > 1""",
    "q10_truncate_and_load": 'select "date", is_holiday, orders from calendar',
    "q11_features_to_parquet": f"select {_KEY}, accidents_last_24h, {_LABEL} from features",
    "q12_generic_write": """
        select sink, 2 * count(*) as rows, cast(2 * sum(severity) as bigint) as severity, 2 * sum(latitude) as latitude
        from accidents, (values ('table'), ('bulk')) s(sink) group by sink""",
    "q13_replace_day": f"""
        select prediction_date, prediction_hour, location_id, round(score, 6) as risk_score,
               case when score >= 0.75e0 then 'High' when score >= 0.5e0 then 'Medium' else 'Low' end as risk_category
        from (select *, case when prediction_date = {_DAY} then risk_score / 2 else risk_score end as score
              from predictions)""",
    "q14_prediction_files": """
        select prediction_date, prediction_hour, location_id, round(risk_score, 6) as risk_score, risk_category,
               model_version
        from predictions""",
    "q15_point_geometry": """
        select accident_id, longitude as lon, latitude as lat, cast(4326 as integer) as srid from accidents""",
    "q16_model_save_load": f"""
        select sum(least(n, case {_LABEL} when 1 then 50000 else 200000 end))::bigint as rows,
               cast(0 as bigint) as different_scores
        from (select {_LABEL}, count(*) as n from features group by all)""",
    "q17_rename_columns": "select * from renamed",
    "q18_required_columns": 'select accident_id, "timestamp", latitude, longitude from renamed',
    "q19_drop_missing_required": """
        select accident_id, "timestamp", latitude, longitude from renamed
        where accident_id is not null and "timestamp" is not null and latitude is not null and longitude is not null""",
    "q20_parse_times": """
        select accident_id, try_cast("timestamp" as timestamp) as "timestamp" from renamed
        where try_cast("timestamp" as timestamp) is not null""",
    "q21_valid_coordinates": """
        select accident_id, cast(latitude as double) as latitude, cast(longitude as double) as longitude from renamed
        where cast(latitude as double) between -90 and 90 and cast(longitude as double) between -180 and 180""",
    "q22_default_flags": f"select accident_id, {_cleaned(schemas.FLAG_COLUMNS)} from renamed",
    "q23_coerce_measures": f"select accident_id, {_cleaned(schemas.MEASURE_COLUMNS)} from renamed",
    "q24_default_severity": "select accident_id, coalesce(cast(severity as integer), 0) as severity from renamed",
    "q25_normalize_texts": f"select accident_id, {_cleaned(schemas.TEXT_COLUMNS)} from renamed",
    "q26_sort_by_time": "select * from cleaned",
    "q27_table_columns": """
        select * replace (cast(null as double) as humidity) from cleaned""",
    "q28_cleaning_summary": """
        select count(*) as rows_in,
               count(*) filter (where "timestamp" is null) as missing_required,
               count(*) filter (where "timestamp" is not null and t is null) as bad_timestamp,
               count(*) filter (where t is not null and not ok) as bad_coordinates,
               count(*) filter (where t is not null and ok) as rows_kept,
               min(t) filter (where ok) as first_timestamp, max(t) filter (where ok) as last_timestamp
        from (select *, try_cast("timestamp" as timestamp) as t,
                     cast(latitude as double) between -90 and 90 as ok from renamed)""",
    "q29_date_spine": "select * from order_days",
    "q30_date_parts": """
        select "date", orders, year, month, day, day_of_week, day_name, is_weekend, quarter, week_of_year
        from calendar""",
    "q31_holidays": 'select "date", orders, is_holiday, holiday_name from calendar',
    "q32_location_key": "select accident_id, lat_e4, lon_e4 from placed",
    "q33_distinct_locations": "select lat_e4, lon_e4, latitude, longitude from places",
    "q34_location_sample": """
        select lat_e4, lon_e4 from places
        order by md5(concat_ws('|', cast(lat_e4 as varchar), cast(lon_e4 as varchar))), lat_e4, lon_e4 limit 10""",
    "q34_listed_locations": """
        select l.lat_e4, l.lon_e4, l.lat_e4 / 10000e0 as latitude, l.lon_e4 / 10000e0 as longitude,
               coalesce(freq, 0) as accident_freq_historical
        from (values (250000::bigint, -1200000::bigint), (255000, -1200000), (260000, -1197500)) l(lat_e4, lon_e4)
        left join history using (lat_e4, lon_e4)""",
    "q35_hourly_grid": "select feature_date, hour, latitude, longitude, feature_datetime from grid",
    "q36_grid_range": "select min(d) as start_date, max(d) as end_date from placed",
    "q38_cell_clusters": "select latitude, longitude, cluster_id from cluster_map",
    "q39_location_cluster_map": """
        select lat_e4, lon_e4, severity as cluster_id from (
            select *, row_number() over (partition by lat_e4, lon_e4 order by "timestamp" desc, severity desc) as r
            from placed)
        where r = 1""",
    "q40_calendar_join": f"select {_KEY}, day_of_week, month, is_weekend, is_holiday from features",
    "q41_rush_hour": f"select {_KEY}, hour in (7, 8, 9, 17, 18, 19) as is_rush_hour from grid",
    "q42_weather_medians": f"select lat_e4, lon_e4, hour_idx, event_count, {_WEATHER} from weather",
    "q42_weather_medians_split": f"""
        select lat_e4, lon_e4, hour_idx, event_count, {_WEATHER}, weather_condition from weather""",
    "q43_weather_mode": "select lat_e4, lon_e4, hour_idx, weather_condition from weather",
    "q44_weather_join": f"select {_KEY}, {_WEATHER}, weather_condition from grid_weather",
    "q45_median_imputation": f"select {_KEY}, {_WEATHER} from grid_imputed",
    "q45_global_medians": """
        select round(median(temperature_f), 6) as temperature_f, round(median(visibility_mi), 6) as visibility_mi,
               round(median(precipitation_in), 6) as precipitation_in, round(median(wind_speed_mph), 6) as wind_speed_mph,
               round(median(humidity), 6) as humidity, round(median(pressure_in), 6) as pressure_in
        from accidents""",
    "q46_severe_weather": """
        select accident_id, weather_condition,
               coalesce(weather_condition in ('Light Snow', 'Heavy Rain'), false) as is_severe_weather
        from accidents""",
    "q47_cluster_lookup": f"""
        select {_KEY}, coalesce(m.cluster_id, -1) as cluster_id
        from grid left join (select lat_e4, lon_e4, cluster_id from cluster_map) m using (lat_e4, lon_e4)""",
    "q48_historical_count": f"select {_KEY}, freq as accident_freq_historical from grid_history",
    "q48_historical_count_as_of": f"""
        select {_KEY}, coalesce(n, 0) as accident_freq_historical
        from grid left join (select lat_e4, lon_e4, count(*) as n from placed
                             where "timestamp" < {_DAY} group by all) using (lat_e4, lon_e4)""",
    "q49_road_type": f"select {_KEY}, freq as accident_freq_historical, road_type from grid_roads",
    "q50_trailing_counts": _window(
        "cast(n24 as integer) as accidents_last_24h, cast(n7 as integer) as accidents_last_7days, "
        "cast(n7 as integer) as rolling_7day_accidents, cast(n30 as integer) as rolling_30day_accidents"
    ),
    "q50_trailing_counts_late_grid": _window(
        "cast(n24 as integer) as accidents_last_24h, cast(n7 as integer) as accidents_last_7days, "
        "cast(n30 as integer) as rolling_30day_accidents"
    )
    + " where feature_date between date '2024-01-12' and date '2024-01-20'",
    "q51_moving_averages": _window(
        "n3 / 3e0 as moving_avg_3day, n7 / 7e0 as moving_avg_7day, n30 / 30e0 as moving_avg_30day"
    ),
    "q52_forward_label": _window(f"cast(f24 > 0 as integer) as {_LABEL}"),
    "q52_forward_label_6h": _window(f"cast(f6 > 0 as integer) as {_LABEL}"),
    "q53_label_rate": f"""
        select round(avg({_LABEL}), 6) as positive_rate, cast(sum({_LABEL}) as bigint) as positives, count(*) as rows
        from features""",
    "q54_location_id": """
        select accident_id, concat_ws('_', cast(latitude as varchar), cast(longitude as varchar)) as location_id
        from accidents""",
    "q55_feature_table": "select * from features",
    "q56_class_sample": f"""
        select {_KEY}, {_LABEL} from ordered_features where {_LABEL} = 1 and r <= 50000""",
    "q57_training_sample": f"""
        select {_KEY}, {_LABEL} from ordered_features
        where ({_LABEL} = 1 and r <= 50000) or ({_LABEL} = 0 and r <= 200000)""",
    "q58_shuffled_rows": f"select {_KEY}, {_LABEL} from features",
    "q59_stratified_split": f"select {_KEY}, {_LABEL}, split from split_features",
    "q60_split_summary": f"""
        select split, count(*) as rows, round(avg({_LABEL}), 6) as positive_rate from split_features group by split""",
    "q61_feature_columns": """
        select count(columns(* exclude (feature_date, location_id, latitude, longitude, weather_condition,
                                        accident_occurred_next_24h)))
        from features""",
    "q62_one_hot": f"""
        select {_KEY}, cast(road_type = 'highway' as integer) as road_type_highway,
               cast(road_type = 'residential' as integer) as road_type_residential
        from features""",
    "q63_vector_assembly": """
        unpivot (
            select round(sum(coalesce(cast(columns(* exclude (
                       feature_date, location_id, latitude, longitude, weather_condition, road_type,
                       accident_occurred_next_24h)) as double), 0e0)), 3)
            from (select * replace (nullif(humidity, 50e0) as humidity) from features))
        on columns(*) into name feature value total""",
    "q64_class_weights": f"""
        select {_KEY}, round(count(*) over () / (2e0 * count(*) over (partition by {_LABEL})), 6) as weight,
               case when {_LABEL} = 1 then 5e0 else 1e0 end as boosted_weight
        from features""",
    "q69_binary_metrics": _metrics("scored"),
    "q69_binary_metrics_by_group": _metrics(
        """(select event_type, cast(user_id % 3 = 0 as integer) as y, least(1e0, value / 100e0) as p from events)""",
        "event_type",
    ),
    "q71_best_model": """
        select model_name, model_version, auc_score as auc from (
            select *, row_number() over (partition by model_name order by training_date desc, model_version desc) as r
            from metadata)
        where r = 1 order by auc desc, model_name limit 1""",
    "q72_model_metadata": f"""
        select 'scored' as model_name, 'v1' as model_version, timestamp '2024-02-01 00:00:00' as training_date,
               auc as auc_score, precision as precision_score, recall as recall_score, f1 as f1_score,
               accuracy as accuracy_score, 'n_chars' as features_used
        from ({_metrics("scored")})""",
    "q73_latest_metadata": """
        select model_name, model_version, training_date, auc_score from (
            select *, row_number() over (partition by model_name order by training_date desc, model_version desc) as r
            from metadata)
        where r = 1""",
    "q73_latest_metadata_of_one": """
        select * from metadata where model_name = '2-HIGH' order by training_date desc, model_version desc limit 1""",
    "q74_align_features": """
        select location_id, feature_date, hour as hour_of_day,
               round(coalesce(nullif(humidity, 50e0), 0e0), 6) as humidity, cast(hour as double) as hour,
               0e0 as not_in_table, cast(accidents_last_24h as double) as accidents_last_24h,
               cast(is_holiday as double) as is_holiday
        from features""",
    "q76_risk_category": """
        select location_id, prediction_date as feature_date, prediction_hour as hour,
               round(risk_score, 6) as risk_score,
               case when risk_score >= 0.5e0 then 'High' when risk_score >= 0.25e0 then 'Medium'
                    else 'Low' end as risk_category
        from predictions""",
    "q77_prediction_rows": "select * replace (round(risk_score, 6) as risk_score) from predictions",
    "q78_feature_documents": """
        select prediction_date, prediction_hour, location_id, latitude as document_latitude,
               prediction_hour as document_hour, model_version as document_version
        from predictions""",
    "q79_category_counts": """
        select count(*) filter (where risk_category = 'High') as high,
               count(*) filter (where risk_category = 'Medium') as medium,
               count(*) filter (where risk_category = 'Low') as low
        from predictions""",
    "q80_high_risk_zones": """
        select prediction_date, prediction_hour, location_id, round(risk_score, 6) as risk_score from predictions p
        where risk_category = 'High'
        order by p.risk_score desc, location_id, prediction_date, prediction_hour limit 10""",
    "q82_predictions_by_date": f"""
        select {_SERVED}, model_version from predictions p where p.prediction_date = {_DAY}
        order by p.risk_score desc, location_id, prediction_hour""",
    "q83_predictions_by_location": f"""
        select {_SERVED}, model_version from predictions p where location_id = '25.5_-119.75'""",
    "q83_predictions_by_location_and_date": f"""
        select {_SERVED}, model_version from predictions p
        where location_id = '25.5_-119.75' and p.prediction_date = {_DAY}""",
    "q84_high_risk_zones": f"""
        select {_SERVED} from predictions p where p.prediction_date = {_DAY} and p.risk_score >= 0.5e0
        order by p.risk_score desc, location_id, prediction_hour limit 20""",
    "q84_high_risk_report": f"""
        select '2024-01-15' as prediction_date,
               (select count(*) from predictions where prediction_date = {_DAY} and risk_score >= 0.5e0) as total_zones,
               cast(row_number() over (order by risk_score desc, location_id, prediction_hour) - 1 as integer) as position,
               location_id, prediction_hour
        from (select * from predictions where prediction_date = {_DAY} and risk_score >= 0.5e0
              order by risk_score desc, location_id, prediction_hour limit 20)""",
    "q85_statistics": """
        select count(*) as total_predictions,
               count(*) filter (where risk_category = 'High') as high_risk_count,
               count(*) filter (where risk_category = 'Medium') as medium_risk_count,
               count(*) filter (where risk_category = 'Low') as low_risk_count,
               cast(max(prediction_date) as varchar) as latest_prediction_date,
               (select min(model_version) from predictions
                where prediction_date = (select max(prediction_date) from predictions)) as model_version
        from predictions""",
    "q87_monitoring": f"""
        select prediction_date as metric_date, model_version, total_predictions, high_risk_predictions,
               medium_risk_predictions, low_risk_predictions, true_positives, false_positives, true_negatives,
               false_negatives, auc as auc_score, precision as precision_score, recall as recall_score,
               f1 as f1_score, coalesce(auc < 0.70e0, false) or recall < 0.65e0 as alert
        from ({
        _metrics(
            f'''(select p.*, {_LABEL} as y, risk_score as p from predictions p
                join features f on feature_date = prediction_date and hour = prediction_hour
                 and f.location_id = p.location_id)''',
            "prediction_date, model_version",
        )
    })
        join (select prediction_date, model_version, count(*) as total_predictions,
                     count(*) filter (where risk_category = 'High') as high_risk_predictions,
                     count(*) filter (where risk_category = 'Medium') as medium_risk_predictions,
                     count(*) filter (where risk_category = 'Low') as low_risk_predictions
              from predictions group by all) using (prediction_date, model_version)""",
    "q88_cluster_summary": """
        select cluster_id, round(avg(p.latitude), 6) as centroid_latitude, round(avg(p.longitude), 6) as centroid_longitude,
               count(*) as accident_count, round(avg(severity), 6) as avg_severity
        from placed p join cluster_map m on m.lat_e4 = p.lat_e4 and m.lon_e4 = p.lon_e4
        group by cluster_id""",
    "q89_time_split": f"""
        select {_KEY}, case when feature_date <= date '2024-01-20' then 'train'
                            when feature_date <= date '2024-01-25' then 'val' else 'test' end as split
        from features where feature_date <= date '2024-01-28'""",
    "q90_undersample": f"""
        select {_KEY}, {_LABEL} from ordered_features
        where r <= (select min(n) from ordered_features)""",
    "q91_quality_gate": f"""
        select source, auc, recall, precision from ({_metrics("scored", "source")})
        where auc >= 0.4e0 and recall >= 0.4e0 and precision >= 0.6e0""",
}

_FITTED = f"""
    select split, cast(sum(case split when 'train' then least(a, cap) when 'val' then b - a else n - b end) as bigint) as rows,
           0::bigint as bad_scores, true as auc_above_half
    from (select floor(n * 0.70e0) as a, floor(n * 0.85e0) as b, n, cap
          from (select count(*) as n, case when {_LABEL} = 1 then 2000 else 8000 end as cap
                from features group by {_LABEL})),
         (select unnest(['train', 'val', 'test']) as split)
    group by split"""
# The same for models that are fitted on the whole train split.
_FITTED_WHOLE = f"""
    select split, cast(sum(case split when 'train' then a when 'val' then b - a else n - b end) as bigint) as rows,
           0::bigint as bad_scores, true as auc_above_half
    from (select floor(n * 0.70e0) as a, floor(n * 0.85e0) as b, n
          from (select count(*) as n from features where {_LABEL} in (0, 1) group by {_LABEL})),
         (select unnest(['train', 'val', 'test']) as split)
    group by split"""
_FACTS = "0::bigint as wrong_category, 0::bigint as bad_scores, 0::bigint as repeated"

# Queries on fitted models return what must hold for any fit.
_TEXTS |= {
    "q37_kmeans_clusters": """
        select count(*) as rows, count(*) as places, 0::bigint as out_of_range, true as several_clusters,
               true as cost_of_best_restart, 10 as restarts
        from places""",
    "q65_logistic_regression": _FITTED_WHOLE,
    "q66_random_forest": _FITTED_WHOLE,
    "q67_boosted_trees_weighted": _FITTED,
    "q68_boosted_trees_balanced": _FITTED_WHOLE,
    "q70_feature_importance": """
        select cast(21 + count(distinct road_type) as bigint) as features, 0::bigint as bad_values, 1e0 as total
        from features""",
    "q71_train_and_compare": """
        select unnest(['train', 'val', 'test']) as split, 4::bigint as models, 0::bigint as better_than_best,
               4::bigint as valid_auc""",
    "q75_score_rows": f"""
        select feature_date as prediction_date, count(*) as rows, {_FACTS} from features group by feature_date""",
    "q81_daily_scoring": f"""
        select feature_date as prediction_date, count(*) as rows, {_FACTS}, true as few_zones
        from features where feature_date = {_DAY} group by feature_date""",
    "q86_end_to_end_run": f"""
        select {_DAY} as prediction_date, count(distinct (latitude, longitude)) * 24 as rows, {_FACTS},
               count(*) as events, date_diff('day', min("timestamp")::date, max("timestamp")::date) + 1 as grid_days,
               0::bigint as null_calendar_rows, 4::bigint as models
        from cleaned""",
    "q92_cross_validation": "select unnest([0e0, 0.1e0]) as reg_param, true as auc_above_half",
}

ORACLES: dict[str, str] = {name: oracle(text) for name, text in _TEXTS.items()}
