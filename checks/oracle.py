"""DuckDB SQL the registered queries are compared with.

Each statement is assembled from common table expressions: raw projections, staging,
dimensions and facts, and the select of the query. Category labels come from the fixed
values; everything else is written out here on its own.
"""

from __future__ import annotations

import re

from citytrips import fixtures, rules
from citytrips.plans import metrics, suites
from citytrips.plans.quality import Rule

ORACLE: dict[str, str] = {}


def text_list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def pick(value: str, bands: rules.Bands) -> str:
    """Label by counting the edges at or below the value; null counts as beyond the last."""
    steps = " + ".join(f"({value} >= {edge})::int" for edge in bands.edges)
    return f"coalesce({text_list(bands.labels)}[1 + {steps}], '{bands.labels[-1]}')"


def within(hour: str, ranges) -> str:
    inside = " or ".join(f"{hour} between {a} and {b}" for a, b in ranges)
    return f"coalesce({inside}, false)"


def named_hour(hour: str, names, rest: str) -> str:
    labels = [rest] * 24
    for name, (low, high) in names.items():
        labels[low:high + 1] = [name] * (high - low + 1)
    return f"({text_list(labels)})[{hour} + 1]"


def member(value: str, groups, rest: str) -> str:
    arms = " ".join(f"when list_contains({text_list(v)}, {value}) then '{k}'"
                    for k, v in groups.items())
    return f"(case {arms} else '{rest}' end)"


def key(*parts: str) -> str:
    texts = ", ".join(f"coalesce(({p})::varchar, '{rules.NULL_KEY_TEXT}')" for p in parts)
    return f"md5(concat_ws('-', {texts}))"


def pct(part: str, total: str) -> str:
    return f"({part})::double * 100 / nullif(({total})::double, 0)"


FLAG_COLUMNS = f"""
    {named_hour('pickup_hour', rules.DAY_PARTS, rules.DAY_PART_REST)} as day_part,
    {within('pickup_hour', rules.RUSH_HOURS)} as is_rush_hour,
    {within('pickup_hour', rules.BUSINESS_HOURS)} as is_business_hours,
    {within('pickup_hour', rules.LATE_NIGHT_HOURS)} as is_late_night
"""

MONEY_NULLS = ", ".join(
    f"null::double as {c}" for c in (
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee"))

CTES = {
    "raw_yellow": f"""
  select l_suppkey % 2 + 1 as vendor_id,
    l_shipdate + to_minutes(l_orderkey % 1440) as tpep_pickup_datetime,
    l_shipdate + to_minutes(l_orderkey % 1440 + l_quantity::bigint) as tpep_dropoff_datetime,
    l_linenumber::bigint as passenger_count,
    l_quantity * 0.25::double + l_linenumber * 0.5::double as trip_distance,
    null::bigint as ratecode_id, null::varchar as store_and_fwd_flag,
    l_partkey % 265 + 1 as pu_location_id, l_suppkey % 265 + 1 as do_location_id,
    (l_linenumber % 6 + 1)::bigint as payment_type,
    floor(l_extendedprice) / 1024::double - copy as total_amount, {MONEY_NULLS}
  from lineitem join (values (0), (1)) c(copy) on copy = 0 or l_orderkey % 10 = 0""",
    "raw_fhv": """
  select 'B' || lpad(o_custkey::varchar, 5, '0') as dispatching_base_num,
    o_orderdate + to_minutes(o_orderkey % 1440) as pickup_datetime,
    case when o_orderkey % 6 <> 0
         then o_orderdate + to_minutes(o_orderkey % 1440 + o_custkey % 60) end as drop_off_datetime,
    null::varchar as affiliated_base_number,
    case when o_orderstatus <> 'P' then o_custkey % 265 + 1 end as p_ulocation_id,
    o_orderkey % 265 + 1 as d_olocation_id
  from orders""",
    "raw_bike": f"""
  select 'R' || event_id as ride_id,
    ({text_list(rules.RIDEABLE_TYPES)})[event_id % 3 + 1] as rideable_type,
    ts as started_at, ts + to_minutes(event_id % 90) as ended_at,
    null::varchar as start_station_name, user_id || '.10' as start_station_id,
    null::varchar as end_station_name, (event_id % 150) || '.20' as end_station_id,
    null::double as start_lat, null::double as start_lng,
    null::double as end_lat, null::double as end_lng,
    if(user_id % 2 = 0, 'member', 'casual') as member_casual
  from events""",
    "raw_weather": """
  select "timestamp", temp, temp - 2 as feels_like, h % 101 as humidity, temp - 5 as dew_point,
    rain + snowfall as precipitation, rain, snowfall, (h * 7) % 101 as cloud_cover,
    (990 + h % 50)::double as pressure, (h % 23)::double as wind_speed,
    (h * 37) % 361 as wind_direction
  from (
    select "timestamp", h, (h % 47) - 8 + (h % 4) * 0.25::double as temp,
      case when h % 211 = 0 then 64::double when h % 5 = 0 then (h % 13) * 0.75::double
           when h % 11 = 3 then 0.0625::double when h % 11 = 5 then 0.25::double
           else 0::double end as rain,
      if(h % 47 < 10 and h % 7 = 0, (h % 9) * 0.875::double, 0::double) as snowfall
    from (
      select distinct date_trunc('hour', ts) as "timestamp",
        epoch(date_trunc('hour', ts))::bigint // 3600 as h
      from (select tpep_pickup_datetime as ts from raw_yellow
            union all select pickup_datetime from raw_fhv
            union all select started_at from raw_bike)
    ) where h % 97 <> 0
  )""",
    "raw_zones": f"""
  select n::int as location_id,
    if(n = 265, 'Unknown', ({text_list(fixtures.BOROUGHS)})[n % 6 + 1]) as borough,
    coalesce(({text_list(fixtures.NAMED_ZONES)})[n], 'Zone ' || n) as zone,
    ({text_list(fixtures.SERVICE_ZONES)})[n % 4 + 1] as service_zone
  from (
    select pu_location_id as n from raw_yellow union select do_location_id from raw_yellow
    union select p_ulocation_id from raw_fhv union select d_olocation_id from raw_fhv
  ) where n is not null""",
    "stg_yellow": f"""
  select {key('tpep_pickup_datetime', 'tpep_dropoff_datetime', 'vendor_id', 'pu_location_id')}
      as trip_id,
    tpep_pickup_datetime as pickup_datetime, tpep_dropoff_datetime as dropoff_datetime,
    vendor_id::int as vendor_id, passenger_count::int as passenger_count, trip_distance,
    ratecode_id::int as ratecode_id, store_and_fwd_flag,
    pu_location_id::int as pickup_location_id, do_location_id::int as dropoff_location_id,
    payment_type::int as payment_type, total_amount, {MONEY_NULLS}
  from (
    select distinct on (tpep_pickup_datetime, tpep_dropoff_datetime, vendor_id, pu_location_id) *
    from raw_yellow
    where tpep_pickup_datetime >= timestamp '1995-01-01'
    order by total_amount desc nulls last, do_location_id desc nulls last,
      passenger_count desc nulls last, trip_distance desc nulls last, payment_type desc nulls last
  )""",
    "stg_fhv": f"""
  select {key('pickup_datetime', 'drop_off_datetime', 'dispatching_base_num', 'p_ulocation_id')}
      as trip_id,
    dispatching_base_num, affiliated_base_number, pickup_datetime,
    drop_off_datetime as dropoff_datetime, p_ulocation_id::int as pickup_location_id,
    d_olocation_id::int as dropoff_location_id
  from (
    select distinct on (pickup_datetime, drop_off_datetime, dispatching_base_num, p_ulocation_id) *
    from raw_fhv
    where pickup_datetime >= timestamp '1995-01-01'
    order by d_olocation_id desc nulls last
  )""",
    "stg_bike": """
  select ride_id as trip_id, rideable_type, started_at as pickup_datetime,
    ended_at as dropoff_datetime, start_station_name, start_station_id as pickup_location_id,
    end_station_name, end_station_id as dropoff_location_id, start_lat, start_lng, end_lat,
    end_lng, member_casual
  from raw_bike""",
    "stg_weather": """
  select * replace (humidity::int as humidity, cloud_cover::int as cloud_cover,
                    wind_direction::int as wind_direction)
  from raw_weather""",
    "trips": f"""
  select trip_id, '{rules.YELLOW}' as trip_type, pickup_datetime, dropoff_datetime,
    pickup_location_id::varchar as pickup_location_id,
    dropoff_location_id::varchar as dropoff_location_id, passenger_count, trip_distance,
    total_amount as revenue, payment_type, null::varchar as member_type,
    null::varchar as rideable_type
  from stg_yellow
  union all by name
  select trip_id, '{rules.FHV}' as trip_type, pickup_datetime, dropoff_datetime,
    pickup_location_id::varchar as pickup_location_id,
    dropoff_location_id::varchar as dropoff_location_id
  from stg_fhv
  union all by name
  select trip_id, '{rules.BIKE}' as trip_type, pickup_datetime, dropoff_datetime,
    pickup_location_id, dropoff_location_id, member_casual as member_type, rideable_type
  from stg_bike""",
    "weather": f"""
  select "timestamp" as weather_key, "timestamp", temp, feels_like, humidity, dew_point,
    precipitation, rain, snowfall, cloud_cover, pressure, wind_speed, wind_direction,
    {pick('temp', rules.TEMPERATURE)} as temp_category,
    {pick('feels_like', rules.FEELS_LIKE)} as feels_like_category,
    round(temp * 9 / 5 + 32, 1) as temp_fahrenheit,
    round(feels_like * 9 / 5 + 32, 1) as feels_like_fahrenheit,
    if(precipitation = 0, 'none',
       {text_list(('none', 'snow', 'rain', 'mixed'))}[1 + (snowfall > 0)::int + 2 * (rain > 0)::int])
      as precipitation_type,
    if(precipitation = 0, 'none', {pick('precipitation', rules.INTENSITY)})
      as precipitation_intensity,
    precipitation > 0 as has_precipitation,
    {pick('wind_speed', rules.WIND)} as wind_category,
    round(wind_speed * 2.237::double, 1) as wind_speed_mph,
    coalesce({text_list(rules.COMPASS)}[1 + floor((wind_direction + 22.5) / 45)::int % 8],
             'VARIABLE') as wind_direction_cardinal,
    {pick('cloud_cover', rules.CLOUD)} as cloud_cover_category,
    {pick('humidity', rules.HUMIDITY)} as humidity_category,
    coalesce(
      if(precipitation > 10 and temp < 0, 'blizzard', null),
      if(precipitation > 10, 'severe_storm', null),
      if(snowfall > 5, 'heavy_snow', null), if(snowfall > 0, 'snow', null),
      if(rain > 7.6, 'heavy_rain', null), if(rain > 2.5, 'moderate_rain', null),
      if(rain > 0, 'light_rain', null),
      if(cloud_cover > 75, 'cloudy', null), if(cloud_cover > 50, 'partly_cloudy', null),
      'clear') as weather_description,
    temp between 15 and 25 and precipitation = 0 and wind_speed < 10 and cloud_cover < 50
      as is_pleasant_weather,
    precipitation > 5 or temp not between -5 and 35 or wind_speed > 15 as is_adverse_weather,
    temp between 10 and 25 and precipitation = 0 and wind_speed < 15 as is_good_cycling_weather
  from stg_weather""",
    "locations": f"""
  select location_id::varchar as location_key, location_id, borough, zone as zone_name,
    service_zone,
    {member('borough', rules.LOCATION_TIERS, rules.LOCATION_TIER_REST)} as location_tier,
    {member('borough', rules.BOROUGH_REGIONS, rules.BOROUGH_REGION_REST)} as borough_region,
    service_zone = 'Yellow Zone' as is_yellow_zone, service_zone = 'Boro Zone' as is_boro_zone,
    service_zone = 'Airports' or borough = 'EWR' as is_airport,
    list_contains({text_list(rules.HIGH_DEMAND_ZONES)}, zone) as is_high_demand_zone,
    list_contains({text_list(rules.HUB_ZONES)}, zone) as is_transportation_hub,
    list_contains({text_list(rules.TOURIST_ZONES)}, zone) as is_tourist_area,
    list_contains({text_list(rules.BUSINESS_ZONES)}, zone) as is_business_district
  from raw_zones""",
    "hours": f"""
  select hour::int::varchar as time_key, hour::int as hour,
    if(hour % 12 = 0, 12, hour % 12)::int as hour_12, if(hour < 12, 'AM', 'PM') as am_pm,
    {named_hour('hour', rules.DAY_PARTS, rules.DAY_PART_REST)} as day_part,
    {within('hour', rules.BUSINESS_HOURS)} as is_business_hours,
    {within('hour', rules.RUSH_HOURS)} as is_rush_hour,
    {within('hour', rules.LATE_NIGHT_HOURS)} as is_late_night,
    {within('hour', rules.DINING_HOURS)} as is_dining_hours,
    {named_hour('hour', rules.TIME_PERIODS, rules.TIME_PERIOD_REST)} as time_period
  from range(24) r(hour)""",
    "dates": """
  select strftime(d, '%Y-%m-%d') as date_key, d as date, year(d)::int as year,
    quarter(d)::int as quarter, month(d)::int as month, monthname(d) as month_name,
    left(monthname(d), 3) as month_name_short, weekofyear(d)::int as week_of_year,
    (weekofyear(d) - weekofyear(d - (day(d)::int - 1)) + 1)::int as week_of_month,
    day(d)::int as day_of_month, dayofweek(d)::int as day_of_week, dayname(d) as day_name,
    left(dayname(d), 3) as day_name_short, dayofyear(d)::int as day_of_year,
    isodow(d) > 5 as is_weekend, isodow(d) <= 5 as is_weekday,
    day(d) = 1 as is_month_start, day(d + 1) = 1 as is_month_end,
    day(d) = 1 and month(d) % 3 = 1 as is_quarter_start,
    day(d + 1) = 1 and month(d) % 3 = 0 as is_quarter_end,
    strftime(d, '%m%d') = '0101' as is_year_start, strftime(d, '%m%d') = '1231' as is_year_end
  from (select d::date as d
        from (select min(pickup_datetime)::date as a, max(pickup_datetime)::date as b from trips),
          unnest(range(a, b + interval 1 day, interval 1 day)) u(d))""",
    "fct": f"""
  select {key('trip_id')} as trip_key, strftime(pickup_datetime, '%Y-%m-%d') as date_key,
    pickup_hour::varchar as time_key, pickup_location_id as pickup_location_key,
    dropoff_location_id as dropoff_location_key, trip_id, trip_type, payment_type, member_type,
    rideable_type, pickup_datetime, dropoff_datetime, minutes as trip_duration_minutes,
    trip_distance, if(minutes > 0, trip_distance / minutes * 60, null) as avg_speed_mph,
    passenger_count, revenue, pickup_hour, dayofweek(pickup_datetime)::int as day_of_week,
    isodow(pickup_datetime) > 5 as is_weekend, {FLAG_COLUMNS},
    w.temp as temperature_celsius, w.temp_fahrenheit as temperature_fahrenheit, w.feels_like,
    w.feels_like_fahrenheit, w.humidity, w.precipitation, w.rain, w.snowfall, w.wind_speed,
    w.wind_speed_mph, w.temp_category, w.feels_like_category, w.precipitation_type,
    w.precipitation_intensity, w.wind_category, w.wind_direction_cardinal,
    w.cloud_cover_category, w.humidity_category, w.weather_description, w.is_pleasant_weather,
    w.is_adverse_weather, w.is_good_cycling_weather,
    strftime(pickup_datetime, '%Y%m')::int as pickup_month
  from (select *, hour(pickup_datetime)::int as pickup_hour,
          date_diff('minute', pickup_datetime, dropoff_datetime) as minutes from trips) t
  left join weather w on w."timestamp" = date_trunc('hour', t.pickup_datetime)""",
    "hourly": f"""
  select {key('hour_timestamp', 'trip_type', 'temp_category', 'precipitation_type', 'is_weekend',
              'day_part')} as hour_key,
    *, {pct('citibike_count', 'trip_count')} as citibike_mode_share_pct,
    {pct('yellow_taxi_count', 'trip_count')} as yellow_taxi_mode_share_pct,
    {pct('fhv_count', 'trip_count')} as fhv_mode_share_pct,
    {pct('rush_hour_trip_count', 'trip_count')} as rush_hour_pct
  from (
    select date_key, time_key, trip_type, temp_category, precipitation_type, is_weekend, day_part,
      date_trunc('hour', pickup_datetime) as hour_timestamp, count(*) as trip_count,
      sum(revenue) as total_revenue, avg(trip_duration_minutes) as avg_trip_duration_minutes,
      avg(trip_distance) as avg_trip_distance_miles, avg(avg_speed_mph) as avg_speed_mph,
      sum(passenger_count)::bigint as total_passengers,
      median(trip_duration_minutes)::double as median_trip_duration_minutes,
      median(trip_distance) as median_trip_distance_miles,
      avg(temperature_celsius) as avg_temperature_celsius,
      avg(temperature_fahrenheit) as avg_temperature_fahrenheit,
      avg(precipitation) as avg_precipitation_mm, avg(wind_speed_mph) as avg_wind_speed_mph,
      avg(humidity) as avg_humidity_pct,
      count(*) filter (trip_type = 'yellow_taxi') as yellow_taxi_count,
      count(*) filter (trip_type = 'fhv') as fhv_count,
      count(*) filter (trip_type = 'citibike') as citibike_count,
      coalesce(sum(revenue) filter (trip_type = 'yellow_taxi'), 0) as yellow_taxi_revenue,
      avg(revenue) filter (trip_type = 'yellow_taxi') as avg_yellow_taxi_fare,
      count(*) filter (is_rush_hour) as rush_hour_trip_count,
      max(coalesce(is_adverse_weather, false)::int) as has_adverse_weather,
      max(coalesce(is_pleasant_weather, false)::int) as has_pleasant_weather,
      max(coalesce(is_good_cycling_weather, false)::int) as has_good_cycling_weather,
      pickup_month
    from fct group by all
  )""",
}
ORDER = list(CTES)


def _needed(body: str) -> list[str]:
    """Common table expressions a statement refers to, directly or through others."""
    found: set[str] = set()
    open_texts = [body]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        for name in ORDER:
            if name in words and name not in found:
                found.add(name)
                open_texts.append(CTES[name])
    return [n for n in ORDER if n in found]


def statement(body: str, **extra: str) -> str:
    """A select with the common table expressions it needs, own ones last."""
    parts = [f"{n} as ({CTES[n]}\n)" for n in _needed(" ".join([body, *extra.values()]))]
    parts += [f"{n} as ({text}\n)" for n, text in extra.items()]
    return f"with {',\n'.join(parts)}\n{body}" if parts else body


def oracle(name: str, body: str, **extra: str) -> None:
    ORACLE[name] = statement(body, **extra)


def settled(body: str, *columns: str) -> str:
    rounded = ", ".join(f"round({c}, 8) as {c}" for c in columns)
    return f"select * replace ({rounded}) from ({body})"


# --- sources ----------------------------------------------------------------------------------

oracle("src_yellow_months", "select * from raw_yellow")
oracle("src_fhv_months", "select * from raw_fhv")
oracle("src_bike_csv", "select * from raw_bike")
oracle("src_bike_archives", "select * from raw_bike")
oracle("src_archive_report", """
select year(m)::int as year, month(m)::int as month, 'trips' as source,
  if(n = 0, 'failed', 'success') as status, n as rows
from (select date_trunc('month', started_at) as m, count(*) as n from raw_bike group by 1
      union all select max(date_trunc('month', started_at)) + interval 1 month, 0 from raw_bike)""")
oracle("src_refused_weather", """
select y::int as year, m::int as month,
  if(y * 100 + m in (select ym from held) and (y * 100 + m) % 5 > 1, 'success', 'failed') as status,
  case when y * 100 + m not in (select ym from held) then 'PATH_NOT_FOUND'
       when (y * 100 + m) % 5 < 2 then 'no hourly data' end as error
from (select distinct ym // 100 as y from held) a cross join range(1, 13) b(m)""",
       held="""select distinct year("timestamp") * 100 + month("timestamp") as ym from raw_weather""")
oracle("src_known_files", settled("""
select mb as size_mb, avg(mb) over () as avg_size_mb, min(mb) over () as min_size_mb,
  max(mb) over () as max_size_mb, (mb - avg(mb) over ()) * 100 / avg(mb) over () as pct_from_avg,
  abs((mb - avg(mb) over ()) * 100 / avg(mb) over ()) > 20 as is_deviating,
  mb < 0.0012 as is_suspicious
from (select sum(length(dispatching_base_num) + 1)::double / 1048576 as mb
      from raw_fhv group by date_trunc('month', pickup_datetime))""",
       "size_mb", "avg_size_mb", "min_size_mb", "max_size_mb", "pct_from_avg"))
oracle("src_weather_json", "select * from raw_weather")
oracle("src_zones_csv", "select * from raw_zones")
oracle("src_schema_evolution", """
select ride_id, started_at,
  if(started_at >= timestamp '2024-01-16', dayofweek(started_at) * 10, null)::int as battery
from raw_bike""")
oracle("src_missing_months", """
select y::int as year, m::int as month, 'yellow_taxi' as source,
  if(y * 100 + m in (select strftime(tpep_pickup_datetime, '%Y%m')::int from raw_yellow),
     'success', 'failed') as status
from (select unnest(range(min(year(tpep_pickup_datetime)), max(year(tpep_pickup_datetime)) + 2)) as y
      from raw_yellow) a, range(1, 13) b(m)""")
oracle("src_ingest_report", """
select y::int as year, m::int as month, 'fhv_taxi' as source,
  if(n is null, 'failed', 'success') as status, n as rows
from (select unnest(range(min(year(pickup_datetime)), max(year(pickup_datetime)) + 1)) as y
      from raw_fhv) a cross join range(1, 13) b(m)
left join (select strftime(pickup_datetime, '%Y%m')::int as ym,
             count(distinct (pickup_datetime, drop_off_datetime, dispatching_base_num)) as n
           from raw_fhv group by 1) c on c.ym = y * 100 + m""")
oracle("src_staging_zone",
       "select dispatching_base_num, count(*) as trips from raw_fhv group by 1")
oracle("src_table_sink", """
select strftime(started_at, '%Y%m')::int as pickup_month, rideable_type, count(*) as trips
from raw_bike group by 1, 2""")
oracle("src_materialize_modes", """
select d_olocation_id, count(*) as trips, mode
from raw_fhv, (values ('view'), ('table'), ('ephemeral')) m(mode) group by 1, 3""")
oracle("src_export_csv", """
select pickup_hour, trip_type, count(*) as trips, avg(trip_duration_minutes) as avg_duration
from fct group by 1, 2""")

# --- merge and incremental refresh ---------------------------------------------------------------

_MERGED = """
select distinct on (pickup_datetime, drop_off_datetime, dispatching_base_num) *
from (
  select *, 1 as age from raw_fhv where pickup_datetime < timestamp '1999-01-01'
  union all
  select * replace (d_olocation_id + 1000 as d_olocation_id), 0 as age
  from raw_fhv where pickup_datetime >= timestamp '1998-07-01'
) order by age, affiliated_base_number desc nulls last, p_ulocation_id desc nulls last,
  d_olocation_id desc nulls last"""
for _name in ("inc_merge_by_key", "inc_merge_twice", "inc_merge_table"):
    oracle(_name, f"select * exclude (age) from ({_MERGED})")
oracle("inc_key_index", """
select * replace (if(substr(ride_id, 2)::bigint % 4 = 0, started_at + interval 45 day, started_at) as started_at,
  if(substr(ride_id, 2)::bigint % 4 = 0, ended_at + interval 45 day, ended_at) as ended_at)
from raw_bike""")
_MEDIANS = ", ".join(f"round(median({c}), 8) as {c}" for c in (
    "trip_duration_minutes", "trip_distance", "avg_speed_mph", "revenue"))
oracle("agg_exact_medians", f"""
select trip_type, {_MEDIANS} from fct group by 1 union all select 'all', {_MEDIANS} from fct""")
_DISTINCT = """count(distinct pickup_datetime::date) as n_days,
  count(distinct date_trunc('hour', pickup_datetime)) as n_hours"""
oracle("agg_distinct_states", f"""
select strftime(pickup_datetime, '%Y%m')::int as pickup_month, {_DISTINCT} from fct group by 1""")
oracle("agg_distinct_range", f"""
select trip_type, {_DISTINCT} from inside group by 1 union all select 'all', {_DISTINCT} from inside""",
       inside="select * from fct where pickup_datetime::date between date '1996-03-10' and date '1998-07-20'")
oracle("inc_dedup_by_key", """
select distinct on (l_orderkey, l_linenumber) * from lineitem
order by l_extendedprice desc nulls last, l_partkey desc, l_suppkey desc, l_quantity desc,
  l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc, l_shipdate desc""")
oracle("inc_new_trips", """
select trip_id, trip_type, pickup_datetime from trips
where pickup_datetime > (select max(pickup_datetime) from trips
                         where pickup_datetime < timestamp '1998-07-01')""")
oracle("inc_backfill_trips", """
select trip_id, trip_type, pickup_datetime from trips
where pickup_datetime >= timestamp '1997-05-01'""")
oracle("inc_new_hours", """
select trip_type, count(*) as trips, min(pickup_datetime) as first_trip from trips
where date_trunc('hour', pickup_datetime) > (
  select max(date_trunc('hour', pickup_datetime)) from trips
  where pickup_datetime < timestamp '1998-07-01 12:00:00')
group by 1""")
oracle("inc_replace_by_key", """
select trip_key, trip_type,
  if(pickup_datetime >= timestamp '1998-07-01', revenue + 1, revenue) as revenue
from fct""")
oracle("inc_sync_schema", """
select dispatching_base_num, pickup_datetime, null::varchar as channel from raw_fhv""")
oracle("inc_schema_change", """
select trip_key, pickup_datetime, trip_type,
  if(pickup_datetime >= timestamp '1998-07-01', hour(pickup_datetime), null)::int as hour
from fct""")
oracle("inc_late_weather", """
select trip_type, count(*) as trips, count(*) as trips_in_hours from fct group by 1""")
oracle("sem_filled_total", "select count(*) as filled, count(*) as total from fct")
oracle("rpt_sample_rows", "select * from fct order by trip_key limit 100")
oracle("inc_refresh_facts", """
select a.pickup_month, a.trip_type, trips, revenue, hours, trips_in_hours
from (select pickup_month, trip_type, count(*) as trips, sum(revenue) as revenue
      from fct group by all) a
join (select pickup_month, trip_type, count(*) as hours, sum(trip_count)::bigint as trips_in_hours
      from hourly group by all) b using (pickup_month, trip_type)""")

# --- staging, dimensions, facts --------------------------------------------------------------------

oracle("stg_yellow_taxi", "select * from stg_yellow")
oracle("stg_fhv_taxi", "select * from stg_fhv")
oracle("stg_bike_trips", "select * from stg_bike")
oracle("stg_hourly_weather", "select * from stg_weather")
oracle("trips_unioned", "select * from trips")
oracle("stg_date_floor", """
select trip_id, pickup_datetime, total_amount from stg_yellow
where pickup_datetime >= timestamp '1999-03-01'""")
oracle("filter_trips", """
select trip_key, pickup_datetime from fct
where pickup_datetime::date between date '1996-02-10' and date '1999-11-20'
  and trip_type = 'yellow_taxi'""")
oracle("date_bounds", """
select min(pickup_datetime)::date as min_date, max(pickup_datetime)::date as max_date from trips""")
oracle("dim_date", "select * from dates")
oracle("dim_weather", "select * from weather")
oracle("dim_location", "select * from locations")
oracle("dim_time_of_trips", """
select hours.*, trips from hours
left join (select hour(pickup_datetime) as h, count(*) as trips from trips group by 1)
  on h = hours.hour""")
oracle("time_spine_filled", """
select d::date as date_day, coalesce(n, 0) as trip_count
from (select unnest(generate_series(min(pickup_datetime)::date::timestamp, max(pickup_datetime)::date::timestamp, interval 1 day)) as d from trips) r
left join (select pickup_datetime::date as day, count(*) as n from trips group by 1)
  on day = d::date""")
oracle("fct_trips", "select * from fct")
oracle("fct_trips_table", "select * from fct")
_HOURLY_DOUBLES = (
    "total_revenue", "avg_trip_duration_minutes", "avg_trip_distance_miles", "avg_speed_mph",
    "median_trip_duration_minutes", "median_trip_distance_miles", "avg_temperature_celsius",
    "avg_temperature_fahrenheit", "avg_precipitation_mm", "avg_wind_speed_mph",
    "avg_humidity_pct", "yellow_taxi_revenue", "avg_yellow_taxi_fare",
    "citibike_mode_share_pct", "yellow_taxi_mode_share_pct", "fhv_mode_share_pct",
    "rush_hour_pct")
oracle("fct_hourly_mobility", settled("select * from hourly", *_HOURLY_DOUBLES))
oracle("fct_hourly_table", settled("select * from hourly", *_HOURLY_DOUBLES))
oracle("inc_weather_changes", settled("select * from hourly", *_HOURLY_DOUBLES))
oracle("trip_time_flags", """
select trip_id, trip_duration_minutes, avg_speed_mph, pickup_hour, day_of_week, is_weekend,
  day_part, is_rush_hour, is_business_hours, is_late_night from fct""")
oracle("trip_keys", """
select trip_id, trip_key, date_key, time_key, pickup_location_key, dropoff_location_key
from fct""")
oracle("join_weather_left", """
select trip_id, pickup_datetime, "timestamp", temp, temp_category
from trips left join weather on "timestamp" = date_trunc('hour', pickup_datetime)""")
_STAR = """fct join dates using (date_key) join hours using (time_key)"""
oracle("join_star", f"""
select if(dates.is_weekend, 'Weekend', 'Weekday') as period, hours.hour, trip_type,
  count(*) as trips from {_STAR} group by all""")
_MISSING = """
select date as expected_date from dates
where date not in (select pickup_datetime::date from trips)"""
oracle("join_missing_dates", _MISSING)
oracle("join_date_difference", _MISSING)
oracle("join_missing_dates_of_month", """
select d::date as expected_date from range(date '2024-01-01', date '2024-02-16', interval 1 day) r(d)
where d::date not in (select started_at::date from raw_bike)""")
oracle("join_orphan_keys", """
select pickup_location_key, count(*) as n from fct
where pickup_location_key not in (select location_key from locations) group by 1""")

# --- scalar functions ---------------------------------------------------------------------------------

oracle("fn_numbers", f"""
select l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / 7, 2) as two_digits,
  round(l_extendedprice / 1000, 1) as one_digit, round(l_extendedprice / 10) * 10 as bucket,
  (l_quantity / 2)::int as half_even, round((l_quantity - 25) * 9 / 5 + 32, 1) as fahrenheit,
  l_extendedprice / nullif(l_linenumber - 1, 0)::double as quotient,
  round({pct('l_quantity', 'l_extendedprice')}, 4) as pct
from lineitem""")
oracle("fn_calendar", "select o_orderkey, dates.* from orders join dates on date = o_orderdate::date")
oracle("fn_time", """
select event_id, date_trunc('hour', ts) as hour, date_trunc('month', ts)::timestamp as month,
  date_trunc('day', ts)::timestamp as day, strftime(ts, '%Y%m')::int as month_key,
  strftime(ts, '%Y-%m-%d') as date_key, dayofweek(ts)::int as dow,
  date_diff('minute', ts, date_trunc('hour', ts + to_microseconds((value * 10000000)::bigint)))
    as minutes_back,
  date_diff('minute', date_trunc('hour', ts), ts) as minutes_in_hour
from events""")
oracle("fn_labels", """
select trip_type,
  if(trip_type = 'fhv', 'Fhv', if(trip_type = 'citibike', 'Citibike', 'Yellow Taxi')) as label,
  if(n >= 1000000, printf('%.2fM', n / 1000000), if(n >= 1000, printf('%.1fK', n / 1000),
     n::varchar)) as trips,
  coalesce(trunc(r)::int::varchar, 'N/A') as revenue,
  coalesce(trunc(d)::int::varchar, '-') as distance
from (select trip_type, count(*) as n, avg(revenue) as r, avg(trip_distance) as d
      from trips group by 1)""")
oracle("fn_surrogate_key", f"""
select o_orderkey, {key('o_orderkey', 'o_orderdate', 'o_orderpriority')} as key,
  {key('if(o_orderkey % 3 = 0, o_custkey, null)', 'o_orderkey % 2 = 0')} as key_with_null
from orders""")

# --- semantic layer ---------------------------------------------------------------------------------

# Metric → aggregate over the fact, written out one by one.
_N = "count(trip_key)"


def _n(condition: str) -> str:
    return f"count(trip_key) filter ({condition})"


_RUSH, _YELLOW, _BIKE = _n("is_rush_hour"), _n("trip_type = 'yellow_taxi'"), _n(
    "trip_type = 'citibike'")
METRIC_SQL = {
    "total_trips": _N,
    "avg_trip_duration_minutes": "avg(trip_duration_minutes)",
    "median_trip_duration_minutes": "median(trip_duration_minutes)::double",
    "avg_trip_distance_miles": "avg(trip_distance)",
    "total_trip_distance_miles": "sum(trip_distance)",
    "avg_trip_speed_mph": "avg(avg_speed_mph)",
    "total_passengers": "sum(passenger_count)::bigint",
    "avg_passengers_per_trip": "avg(passenger_count)",
    "total_revenue": "sum(revenue)",
    "avg_fare": "avg(revenue)",
    "revenue_per_mile": "sum(revenue) / nullif(sum(trip_distance), 0)",
    "yellow_taxi_trips": _YELLOW,
    "fhv_trips": _n("trip_type = 'fhv'"),
    "citibike_trips": _BIKE,
    "yellow_taxi_mode_share_pct": f"{_YELLOW} / {_N} * 100",
    "fhv_mode_share_pct": f"{_n("trip_type = 'fhv'")} / {_N} * 100",
    "citibike_mode_share_pct": f"{_BIKE} / {_N} * 100",
    "avg_yellow_taxi_fare": "avg(revenue) filter (trip_type = 'yellow_taxi')",
    "total_yellow_taxi_revenue": "sum(revenue) filter (trip_type = 'yellow_taxi')",
    "avg_citibike_duration": "avg(trip_duration_minutes) filter (trip_type = 'citibike')",
    "avg_taxi_duration": "avg(trip_duration_minutes) filter (trip_type = 'yellow_taxi')",
    "rush_hour_yellow_taxi_trips": _n("trip_type = 'yellow_taxi' and is_rush_hour"),
    "rush_hour_citibike_trips": _n("trip_type = 'citibike' and is_rush_hour"),
    "weekend_citibike_trips": _n("trip_type = 'citibike' and is_weekend"),
    "rush_hour_trips": _RUSH,
    "weekend_trips": _n("is_weekend"),
    "weekday_trips": _n("not is_weekend"),
    "late_night_trips": _n("is_late_night"),
    "business_hours_trips": _n("is_business_hours"),
    "rush_hour_trip_rate": f"{_RUSH} / {_N} * 100",
    "weekend_trip_rate": f"{_n('is_weekend')} / {_N} * 100",
    "late_night_trip_rate": f"{_n('is_late_night')} / {_N} * 100",
    "morning_trips": _n("pickup_hour between 6 and 11"),
    "afternoon_trips": _n("pickup_hour between 12 and 17"),
    "evening_trips": _n("pickup_hour between 18 and 21"),
    "night_trips": _n("pickup_hour >= 22 or pickup_hour <= 5"),
    "avg_weekday_vs_weekend_ratio": f"{_n('not is_weekend')} / nullif({_n('is_weekend')}, 0)",
    "rush_hour_vs_non_rush_ratio": f"{_RUSH} / nullif({_N} - {_RUSH}, 0)",
    "trips_in_adverse_weather": _n("is_adverse_weather"),
    "trips_in_pleasant_weather": _n("is_pleasant_weather"),
    "trips_in_rain": _n("precipitation_type = 'rain'"),
    "trips_in_snow": _n("precipitation_type = 'snow'"),
    "citibike_trips_good_cycling_weather": _n(
        "is_good_cycling_weather and trip_type = 'citibike'"),
    "adverse_weather_trip_rate": f"{_n('is_adverse_weather')} / {_N}",
    "rain_impact_on_trips": f"{_n("precipitation_type = 'rain'")} / {_N}",
    "trips_in_cold_weather": _n("temperature_celsius < 0"),
    "trips_in_hot_weather": _n("temperature_celsius >= 30"),
    "trips_in_mild_weather": _n("temperature_celsius >= 10 and temperature_celsius < 20"),
    "avg_trip_duration_adverse_weather":
        "avg(trip_duration_minutes) filter (is_adverse_weather)",
    "avg_trip_duration_pleasant_weather":
        "avg(trip_duration_minutes) filter (is_pleasant_weather)",
}
BASIC_SQL = {
    "total_trips": "count(*)",
    "avg_fare_all_trips": "sum(revenue) / count(*)",
    "avg_duration": "sum(trip_duration_minutes)::double / count(*)",
}
_TRIP_MEASURES = {
    "trip_count": "count(trip_key)",
    "avg_trip_duration": "avg(trip_duration_minutes)",
    "total_trip_duration": "sum(trip_duration_minutes)::bigint",
    "median_trip_duration": "median(trip_duration_minutes)::double",
    "max_trip_duration": "max(trip_duration_minutes)",
    "avg_trip_distance": "avg(trip_distance)",
    "total_trip_distance": "sum(trip_distance)",
    "median_trip_distance": "median(trip_distance)",
    "avg_speed": "avg(avg_speed_mph)",
    "total_passengers": "sum(passenger_count)::bigint",
    "avg_passengers_per_trip": "avg(passenger_count)",
    "total_revenue": "sum(revenue)",
    "avg_revenue_per_trip": "avg(revenue)",
    "avg_temperature_celsius": "avg(temperature_celsius)",
    "avg_temperature_fahrenheit": "avg(temperature_fahrenheit)",
    "avg_precipitation": "avg(precipitation)",
    "avg_wind_speed": "avg(wind_speed_mph)",
    "avg_humidity": "avg(humidity)",
}
_HOURLY_MEASURES = {
    "total_trips": "sum(trip_count)::bigint",
    "hourly_trip_count": "avg(trip_count)",
    "yellow_taxi_trips": "sum(yellow_taxi_count)::bigint",
    "fhv_trips": "sum(fhv_count)::bigint",
    "citibike_trips": "sum(citibike_count)::bigint",
    "hourly_avg_trip_duration": "avg(avg_trip_duration_minutes)",
    "hourly_avg_trip_distance": "avg(avg_trip_distance_miles)",
    "hourly_avg_speed": "avg(avg_speed_mph)",
    "hourly_total_passengers": "sum(total_passengers)::bigint",
    "hourly_total_revenue": "sum(total_revenue)",
    "yellow_taxi_revenue": "sum(yellow_taxi_revenue)",
    "avg_taxi_fare": "avg(avg_yellow_taxi_fare)",
    "citibike_mode_share": "avg(citibike_mode_share_pct)",
    "yellow_taxi_mode_share": "avg(yellow_taxi_mode_share_pct)",
    "fhv_mode_share": "avg(fhv_mode_share_pct)",
    "rush_hour_trips": "sum(rush_hour_trip_count)::bigint",
    "rush_hour_percentage": "avg(rush_hour_pct)",
    "hourly_avg_temperature_celsius": "avg(avg_temperature_celsius)",
    "hourly_avg_temperature_fahrenheit": "avg(avg_temperature_fahrenheit)",
    "hourly_avg_precipitation": "avg(avg_precipitation_mm)",
    "hourly_avg_wind_speed": "avg(avg_wind_speed_mph)",
    "hourly_avg_humidity": "avg(avg_humidity_pct)",
}


def _list(expressions: dict[str, str], names=None, digits: int | None = None) -> str:
    items = {n: expressions[n] for n in (names or expressions)}
    if digits is None:
        return ", ".join(f"{sql} as {n}" for n, sql in items.items())
    whole = ("count", "max")
    return ", ".join(
        f"{sql} as {n}" if sql.endswith("::bigint") or sql.startswith(whole)
        else f"round({sql}, {digits}) as {n}" for n, sql in items.items())


oracle("sem_core_metrics", settled(
    f"select trip_type, {_list(METRIC_SQL, metrics.CORE)} from fct group by 1",
    "avg_trip_speed_mph"))
oracle("sem_mode_share_metrics",
       f"select day_part, {_list(METRIC_SQL, metrics.MODE_SHARE)} from fct group by 1")
oracle("sem_time_pattern_metrics", f"""
select date_trunc('month', pickup_datetime)::timestamp as metric_time,
  {_list(METRIC_SQL, metrics.TIME_PATTERNS)} from fct group by 1""")
oracle("sem_weather_impact_metrics",
       f"select trip_type, {_list(METRIC_SQL, metrics.WEATHER_IMPACT)} from fct group by 1")
oracle("sem_joined_dimensions", f"""
select d.is_weekend as date__is_weekend, l.borough as pickup_location__borough,
  h.time_period as time__time_period,
  {_list(METRIC_SQL, ("total_trips", "avg_fare", "median_trip_duration_minutes"))}
from fct left join dates d using (date_key) left join hours h using (time_key)
left join locations l on l.location_key = fct.pickup_location_key group by 1, 2, 3""")
oracle("sem_states_all_metrics", settled(
    f"""select date_trunc('quarter', pickup_datetime)::timestamp as metric_time, trip_type,
  {_list(METRIC_SQL, [n for n in metrics.TRIPS.metrics if not n.startswith('median')])}
from fct group by 1, 2""", "avg_trip_speed_mph"))
oracle("sem_states_joined", f"""
select d.is_weekend as date__is_weekend, h.time_period as time__time_period,
  {_list({**METRIC_SQL, **_TRIP_MEASURES},
         ('total_trips', 'total_revenue', 'max_trip_duration', 'avg_precipitation'), 8)}
from fct left join dates d using (date_key) left join hours h using (time_key)
where precipitation_type = 'rain' and d.week_of_year > 4 group by 1, 2""")
oracle("sem_states_daily", f"""
select date_trunc('day', pickup_datetime)::timestamp as metric_time,
  {_list({**METRIC_SQL, **_TRIP_MEASURES}, ('total_revenue', 'total_passengers', 'weekend_trips'), 8)}
from fct where is_weekend group by 1""")
oracle("sem_filtered_query", f"""
select trip_type, day_part,
  {_list(METRIC_SQL, ("total_trips", "avg_trip_duration_minutes", "rush_hour_trip_rate"))}
from fct where is_adverse_weather and quarter(pickup_datetime) = 2 group by 1, 2""")
oracle("sem_ordered_top", """
select date_trunc('day', pickup_datetime)::timestamp as pickup_datetime,
  count(*) as total_trips, sum(revenue) as total_revenue
from trips group by 1 order by total_trips desc, 1 limit 15""")
oracle("sem_filled_periods", """
select w as metric_time, n as total_trips, b as citibike_trips
from (select distinct date_trunc('week', d)::timestamp as w
      from (select unnest(generate_series(min(pickup_datetime)::date::timestamp, max(pickup_datetime)::date::timestamp, interval 1 day)) as d from trips) r)
left join (select date_trunc('week', pickup_datetime)::timestamp as tw, count(*) as n,
             count(*) filter (trip_type = 'citibike') as b from trips group by 1) on tw = w""")
oracle("sem_trip_measures", f"""
select trip_type, temp_category, {_list(_TRIP_MEASURES, digits=8)} from fct group by 1, 2""")
oracle("sem_hourly_measures", f"""
select trip_type, day_part, {_list(_HOURLY_MEASURES, digits=8)} from hourly group by 1, 2""")
oracle("sem_hourly_dimensions", """
select date_trunc('year', hour_timestamp)::timestamp as metric_time, day_part, is_weekend,
  trip_type, temp_category, precipitation_type, has_adverse_weather, has_pleasant_weather,
  has_good_cycling_weather, sum(trip_count)::bigint as total_trips,
  sum(rush_hour_trip_count)::bigint as rush_hour_trips
from hourly group by all""")
_TRIP_DIMENSIONS = ", ".join(
    d.name for d in metrics.TRIPS.dimensions if d.name != "pickup_datetime")
oracle("sem_trip_dimensions", f"""
select date_trunc('quarter', pickup_datetime)::timestamp as metric_time, {_TRIP_DIMENSIONS},
  count(*) as total_trips, sum(passenger_count)::bigint as total_passengers
from fct group by all""")
oracle("sem_basic_metrics",
       f"select is_weekend, trip_type, {_list(BASIC_SQL)} from fct group by 1, 2")


def _values(model: str, expressions: dict[str, str]) -> str:
    names = text_list(expressions)
    values = ", ".join(f"round(({sql})::double, 8)" for sql in expressions.values())
    return f"select '{model}' as model, unnest({names}) as metric, unnest([{values}]) as value from fct"


oracle("sem_metric_values", f"""
select model, metric, if(list_contains({text_list(
    n for n, m in metrics.TRIPS.metrics.items() if type(m).__name__ == 'Derived')}, metric)
    and model = 'trips', 'derived', if(metric in ('avg_fare_all_trips', 'avg_duration'), 'ratio',
    'simple')) as type, value
from ({_values('trips', METRIC_SQL)} union all {_values('trips_basic', BASIC_SQL)})""")

# --- data quality -------------------------------------------------------------------------------------

_TABLE_CTE = {
    "dim_date": "dates", "dim_time": "hours", "dim_weather": "weather",
    "dim_location": "locations", "fct_trips": "fct", "fct_hourly_mobility": "hourly",
}


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value).lower()


def _rule_sql(table: str, rule: Rule) -> str:
    source = _TABLE_CTE.get(table, table)
    column = f'"{rule.column}"'
    total = "count(*)"
    if rule.kind == "unique":
        failing, total = "count(*)", "null::bigint"
        source = (f"(select {column} from {source} where {column} is not null"
                  f" group by 1 having count(*) > 1)")
    elif rule.kind == "relationship":
        failing, total = "count(*)", "null::bigint"
        parent = _TABLE_CTE[rule.values[0]]
        source = f"(select * from {source} where {column} not in (select {column} from {parent}))"
    elif rule.kind == "row_count":
        low, high = rule.values
        bounds = [f"count(*) < {low}"] * (low is not None) + [f"count(*) > {high}"] * (
            high is not None)
        failing = f"({' or '.join(bounds)})::bigint"
    else:
        if rule.kind == "not_null":
            bad = f"{column} is null"
        elif rule.kind == "accepted":
            bad = f"{column} not in ({', '.join(_literal(v) for v in rule.values)})"
        elif rule.kind == "between":
            low, high = rule.values
            bad = " or ".join([f"{column} < {low}"] * (low is not None)
                              + [f"{column} > {high}"] * (high is not None))
        else:
            bad = f"not ({rule.values[0]})"
        failing = f"count(*) filter ({bad})"
    return (f"select '{table}' as table_name, '{rule.kind}' as kind, "
            f"'{rule.column}' as column_name, '{rule.severity}' as severity, "
            f"{failing} as failing_rows, {total} as total_rows, {rule.mostly} as mostly "
            f"from {source}")


def _suite_sql(declared: dict[str, list[Rule]]) -> str:
    rows = "\nunion all ".join(_rule_sql(t, r) for t, rs in declared.items() for r in rs)
    return f"""
select table_name, kind, column_name, severity, failing_rows, total_rows,
  if(total_rows is null or kind = 'row_count', failing_rows = 0,
     failing_rows <= (1.0::double - mostly::double) * total_rows) as passed
from ({rows})"""


oracle("dq_declared_tests", _suite_sql(suites.DECLARED))
oracle("dq_expectations", _suite_sql(suites.EXPECTATIONS))
oracle("dq_business_rules", _suite_sql(suites.BUSINESS))
oracle("dq_checked_writes", _suite_sql({t: suites.DECLARED[t] for t in suites.STAGED}))
oracle("dq_failing_rows",
       "select trip_key, pickup_datetime from fct where dropoff_datetime is null")
oracle("dq_stored_failures",
       "select trip_type, count(*) as rows from trips where dropoff_datetime is null group by 1")
oracle("dq_duplicates", """
select date_trunc('day', tpep_pickup_datetime)::timestamp as start, count(*) as n
from raw_yellow group by 1 having count(*) > 1""")
_COVERED = "count(temp_category)"
oracle("dq_weather_coverage", f"""
select * from (select count(*) as total_trips, {_COVERED} as trips_with_weather,
  {pct(_COVERED, 'count(*)')} as coverage_pct from fct) where coverage_pct < 99.99""")
for _name, _least in (("dq_month_completeness", 100000), ("dq_month_completeness_small", 700)):
    oracle(_name, f"""
select date_trunc('month', pickup_datetime)::timestamp as month, count(*) as trip_count,
  '{rules.LOW_MONTH_MESSAGE}' as warning_message
from trips group by 1 having count(*) < {_least}""")
_RUNS = f"""
select min(expected_date) as a, max(expected_date) as b, count(*) as n
from (select expected_date,
        expected_date - (row_number() over (order by expected_date))::int as run
      from ({_MISSING})) group by run"""
oracle("dq_date_gaps", f"""
select a as gap_start, b as gap_end, n as consecutive_missing_days,
  '{rules.GAP_MESSAGE}' as warning_message from ({_RUNS}) where n > 3""")
oracle("dq_gap_ranges", f"select a as start_date, b as end_date, n as days_missing from ({_RUNS})")
_MONTHS = """
select date_trunc('month', {ts})::timestamp as month, min({ts})::date as first_date,
  max({ts})::date as last_date, count(distinct {ts}::date) as days_with_data,
  count(*) as total_trips
from {table} group by 1"""
_FHV_MONTHS = _MONTHS.format(ts="pickup_datetime", table="raw_fhv")
oracle("dq_month_edges", """
select month, gap_type, gap_start, gap_end, days_missing, edge_day,
  coalesce(min(edge_day) over (partition by gap_type)
           = max(edge_day) over (partition by gap_type), false) as recurring
from (
  select month, 'start' as gap_type, month::date as gap_start, first_date - 1 as gap_end,
    (first_date - month::date)::int as days_missing, day(first_date)::int as edge_day
  from months where day(first_date) > 1
  union all
  select month, 'end', last_date + 1, last_day(month), (last_day(month) - last_date)::int,
    day(last_date)::int
  from months where last_date < last_day(month)
  union all
  select month, 'complete', null, null, 0, null from months
  where day(first_date) = 1 and last_date = last_day(month)
)""", months=_FHV_MONTHS)
oracle("dq_missing_estimate", """
select *, avg_complete_month * 0.43::double * incomplete_months as estimated_missing,
  total_trips + avg_complete_month * 0.43::double * incomplete_months as potential_total
from (
  select count(*) filter (ok) as complete_months, count(*) filter (not ok) as incomplete_months,
    avg(total_trips) filter (ok) as avg_complete_month, sum(total_trips)::bigint as total_trips
  from (select *, day(first_date) = 1 and days_with_data >= 28 as ok from months)
)""", months=_FHV_MONTHS)
oracle("dq_row_counts",
       "select count(*) as row_count, count(*) between 1000 and 50000 as passed from trips")
oracle("dq_key_health", """
select count(*) as total_rows, count(*) filter (trip_key is null) as null_keys,
  count(*) - count(distinct trip_key) as duplicate_keys
from fct""")
oracle("dq_key_health_raw", """
select count(*) as total_rows, count(*) filter (p_ulocation_id is null) as null_keys,
  count(*) - count(distinct p_ulocation_id) as duplicate_keys
from raw_fhv""")
oracle("dq_freshness", "select max(pickup_datetime) as latest_trip from trips")
oracle("dq_retention", f"""
select raw_rows, fact_rows, round({pct('fact_rows', 'raw_rows')}, 2) as retention_pct
from (select (select count(*) from raw_yellow) + (select count(*) from raw_fhv)
        + (select count(*) from raw_bike) as raw_rows, (select count(*) from trips) as fact_rows)""")
oracle("dq_coverage_status", f"""
select 'Weather Coverage' as metric, value,
  ['Poor', 'Fair', 'Good', 'Excellent'][1 + (value >= 95)::int + (value >= 99)::int
    + (value >= 99.99)::int] as status
from (select round({pct(_COVERED, 'count(*)')}, 4) as value from fct)""")
_BY_MONTH_MODE = f"""
select date_trunc('month', pickup_datetime)::timestamp as month, trip_type,
  count(*) as trip_count, count(distinct date_key) as days_in_month,
  {_COVERED} as trips_with_weather,
  round({pct(_COVERED, 'count(*)')}, 2) as weather_coverage_pct,
  min(pickup_datetime) as first_trip, max(pickup_datetime) as last_trip
from fct group by 1, 2"""
_MONTH_STATUS = f"""
select *, trip_count // days_in_month as avg_trips_per_day,
  coalesce(if(trip_count < 500, 'Low Volume', null),
           if(weather_coverage_pct < 99, 'Weather Issues', null),
           if(days_in_month < 28, 'Partial Month', null), 'Complete') as status
from (
  select month, sum(trip_count)::bigint as trip_count,
    arg_min(days_in_month, trip_type) as days_in_month,
    sum(trips_with_weather)::bigint as trips_with_weather,
    round(avg(weather_coverage_pct), 8) as weather_coverage_pct,
    min(first_trip) as first_trip, max(last_trip) as last_trip
  from ({_BY_MONTH_MODE}) group by 1
)"""
oracle("dq_month_status", _MONTH_STATUS)
oracle("dq_low_volume_days", """
select pickup_datetime::date as date, count(*) as trip_count from trips
group by 1 having count(*) < 25""")
oracle("dq_recommendations", """
select 'high' as severity, month, 'low_volume' as issue, trip_count::double as value
from s where trip_count < 500
union all
select 'medium', month, 'partial_month', trip_count::double
from s where trip_count >= 500 and trip_count < 0.3::double * (select avg(trip_count) from s)
union all
select 'medium', month, 'weather_coverage', weather_coverage_pct
from s where weather_coverage_pct < 99""", s=_MONTH_STATUS)

# --- reports ------------------------------------------------------------------------------------------

_AVERAGES = "avg(trip_distance) as avg_distance, avg(trip_duration_minutes) as avg_duration"
_KEY_METRICS = """
select count(*) as total_trips, avg(trip_distance) as avg_distance,
  sum(revenue) as total_revenue, avg(trip_duration_minutes) as avg_duration,
  count(distinct trip_type) as num_modes from fct"""
oracle("rpt_key_metrics", _KEY_METRICS)
oracle("rpt_filtered_metrics", f"""{_KEY_METRICS}
where pickup_datetime::date between date '1997-01-15' and date '2000-06-30'
  and trip_type = 'fhv'""")
oracle("rpt_daily_by_mode", """
select pickup_datetime::date as date, trip_type, count(*) as trips,
  avg(trip_distance) as avg_distance from trips group by all""")
_BY_HOUR = """
select pickup_hour, trip_type, count(*) as trips, avg(trip_duration_minutes) as avg_duration
from fct group by all"""
oracle("rpt_hourly_by_mode", _BY_HOUR)
oracle("rpt_hourly_pattern", f"select * rename (pickup_hour as hour) from ({_BY_HOUR})")
oracle("rpt_peak_hours", f"""
select trip_type, arg_max(pickup_hour, trips * 100 - pickup_hour) as peak_hour,
  max(trips) as trips from ({_BY_HOUR}) group by 1""")
oracle("rpt_weather_rows", "select count(temperature_fahrenheit) as count from fct")
oracle("rpt_temperature_buckets", """
select round(temperature_fahrenheit / 10) * 10 as temp_bucket, trip_type, count(*) as trips,
  avg(trip_distance) as avg_distance
from fct where temperature_fahrenheit is not null group by 1, 2""")
oracle("rpt_rain_levels", f"""
select if(precipitation = 0, 'No Rain', {pick('precipitation', rules.RAIN_LEVELS)}) as rain_level,
  trip_type, count(*) as trips
from fct where precipitation is not null group by 1, 2""")
oracle("rpt_mode_comparison", f"""
select trip_type, count(*) as total_trips, {_AVERAGES}, sum(revenue) as total_revenue,
  avg(revenue) as avg_revenue from fct group by 1""")
oracle("rpt_weekend_split", f"""
select is_weekend, trip_type, count(*) as trips, {_AVERAGES},
  if(is_weekend, 'Weekend', 'Weekday') as day_category from fct group by 1, 2""")
_SUMMARY = f"""
select min(pickup_datetime)::date as earliest_date, max(pickup_datetime)::date as latest_date,
  count(*) as total_trips, count(distinct date_key) as days_with_data,
  count(distinct pickup_month) as months_with_data, count(distinct trip_type) as trip_types,
  {_COVERED} as trips_with_weather,
  round({pct(_COVERED, 'count(*)')}, 4) as weather_coverage_pct
from fct"""
oracle("rpt_data_summary", _SUMMARY)
oracle("rpt_coverage_span", f"""
select earliest_date, latest_date, days_with_data,
  (latest_date - earliest_date + 1)::int as date_range_days,
  {pct('days_with_data', 'latest_date - earliest_date + 1')} as day_coverage_pct
from ({_SUMMARY})""")
oracle("rpt_monthly_by_mode", _BY_MONTH_MODE)
_DAILY = f"""
select pickup_datetime::date as date, count(*) as trip_count,
  count(*) filter (trip_type = 'yellow_taxi') as yellow_taxi_trips,
  count(*) filter (trip_type = 'fhv') as fhv_trips,
  count(*) filter (trip_type = 'citibike') as citibike_trips,
  {_COVERED} as trips_with_weather
from fct group by 1"""
oracle("rpt_daily_totals", _DAILY)
oracle("rpt_hourly_coverage", """
select date_trunc('hour', pickup_datetime) as hour, count(*) as trip_count,
  count(distinct trip_type) as trip_types_present from trips group by 1""")
oracle("rpt_month_mode_pivot", """
select date_trunc('month', pickup_datetime)::timestamp as month,
  count(*) filter (trip_type = 'yellow_taxi') as yellow_taxi,
  count(*) filter (trip_type = 'fhv') as fhv,
  count(*) filter (trip_type = 'citibike') as citibike, count(*) as month_total,
  strftime(date_trunc('month', pickup_datetime), '%Y-%m') as month_str
from trips group by all""")


def _heatmap(metric: str) -> str:
    weeks = ", ".join(
        f"coalesce(sum({metric}) filter ((day(date) + 6) // 7 = {i}), 0)::bigint as week_{i}"
        for i in range(1, 6))
    return f"""
select year(date)::int as year, month(date)::int as month, (isodow(date) - 1)::int as weekday,
  {weeks} from ({_DAILY}) group by 1, 2, 3"""


oracle("rpt_calendar_heatmap", _heatmap("trip_count"))
oracle("rpt_bike_heatmap", _heatmap("citibike_trips"))
oracle("rpt_weather_coverage_by_month", f"""
select date_trunc('month', pickup_datetime)::timestamp as month,
  {_COVERED} as trips_with_weather, count(*) as trip_count,
  {pct(_COVERED, 'count(*)')} as coverage_pct from fct group by 1""")
oracle("rpt_mode_distribution",
       "select trip_type, count(*) as trip_count from trips group by 1")
_TREND = """
select date, dates.is_weekend, trip_type, count(*) as trips,
  count(*) filter (is_rush_hour) as rush_hour_trips
from fct join dates using (date_key) group by all"""
oracle("rpt_daily_trend", _TREND)
oracle("rpt_mean_daily_trips",
       f"select trip_type, avg(trips) as avg_daily_trips from ({_TREND}) group by 1")
_WEEKDAYS = """
select day_name, dates.day_of_week, trip_type, count(*) as trips,
  avg(trip_distance) as avg_distance
from fct join dates using (date_key) group by all"""
oracle("rpt_weekday_pattern", _WEEKDAYS)
oracle("rpt_weekend_difference", f"""
select *, {pct('weekend_avg - weekday_avg', 'weekday_avg')} as pct_diff
from (select trip_type, avg(trips) filter (day_of_week between 1 and 5) as weekday_avg,
        avg(trips) filter (day_of_week in (0, 6)) as weekend_avg
      from ({_WEEKDAYS}) group by 1)""")
for _name, _column in (("temperature_impact", "temp_category"),
                       ("precipitation_impact", "precipitation_type")):
    oracle(f"rpt_{_name}", f"""
select {_column}, trip_type, count(*) as trips, {_AVERAGES}
from fct where {_column} is not null group by 1, 2""")
oracle("rpt_rain_change", f"""
select *, {pct('rain_trips - dry_trips', 'dry_trips')} as pct_change
from (select trip_type, count(*) filter (precipitation_type = 'none') as dry_trips,
        count(*) filter (precipitation_type = 'rain') as rain_trips
      from fct where precipitation_type is not null group by 1)""")
_VARIABLES = ("temp", "precipitation", "wind_speed", "humidity", "trip_count")
oracle("rpt_weather_correlation", "\nunion all ".join(
    f"select '{a}' as variable_a, '{b}' as variable_b, round(corr({a}, {b}), 8) as correlation"
    f" from c" for a in _VARIABLES for b in _VARIABLES), c="""
select temperature_celsius as temp, precipitation, wind_speed, humidity, count(*) as trip_count
from fct where temperature_celsius is not null group by 1, 2, 3, 4""")
oracle("rpt_mode_share", f"""
select trip_type, count(*) as trips, {_AVERAGES},
  round({pct('count(*)', '(select count(*) from trips)')}, 2) as pct_share from fct group by 1""")
oracle("rpt_mode_share_of_total", f"""
select trip_type, count(*) as trips,
  round({pct('count(*)', 'sum(count(*)) over ()')}, 2) as mode_share_pct from trips group by 1""")
oracle("rpt_top_zones", """
select zone_name, borough, trip_type, count(*) as pickups
from trips join locations on location_key = pickup_location_id
where trip_type <> 'citibike' group by 1, 2, 3
order by pickups desc, zone_name, borough, trip_type limit 20""")
oracle("rpt_rush_split", f"""
select if(is_rush_hour, 'Rush Hour', 'Non-Rush') as period, trip_type, count(*) as trips,
  {_AVERAGES} from fct group by 1, 2""")
oracle("rpt_rush_share", f"""
select count(*) filter (is_rush_hour) as rush_trips, count(*) as total_trips,
  {pct('count(*) filter (is_rush_hour)', 'count(*)')} as rush_pct from fct""")
oracle("rpt_dataset_summary", f"""
select count(*) as total_trips, count(distinct date_key) as total_days,
  round(avg(trip_distance), 2) as avg_distance,
  round(avg(trip_duration_minutes), 2) as avg_duration,
  count(distinct trip_key) filter (temp_category is not null) as trips_with_weather,
  round({pct('count(distinct trip_key) filter (temp_category is not null)', 'count(*)')}, 2)
    as weather_coverage_pct
from fct""")
oracle("rpt_core_by_mode", """
select trip_type, count(*) as total_trips,
  round(avg(trip_duration_minutes), 2) as avg_duration_minutes,
  round(avg(trip_distance), 2) as avg_distance_miles,
  round(avg(avg_speed_mph), 2) as avg_speed_mph from fct group by 1""")
oracle("rpt_period_by_rush", f"""
select if(dates.is_weekend, 'Weekend', 'Weekday') as period,
  if(hours.is_rush_hour, 'Rush Hour', 'Non-Rush Hour') as time_type, count(*) as trips
from {_STAR} group by 1, 2""")
oracle("rpt_wet_weather_top", """
select precipitation_type, trip_type, count(*) as trips,
  round(avg(trip_duration_minutes), 2) as avg_duration
from fct where precipitation_type <> 'none' group by 1, 2
order by trips desc, precipitation_type, trip_type limit 10""")
oracle("rpt_day_part_share", f"""
select hours.day_part, count(*) as trips,
  round({pct('count(*)', 'sum(count(*)) over ()')}, 2) as pct_of_total
from fct join hours using (time_key) group by 1""")
oracle("rpt_month_validation", f"""
select trip_type, count(*) as trip_count, {_AVERAGES} from fct
where year(pickup_datetime) = 1998 and month(pickup_datetime) = 6 group by 1""")
oracle("rpt_raw_weather_ranges", f"""
select {pick('temp', rules.TEMPERATURE_RANGES)} as temp_range,
  if(precipitation > 0, 'Rainy', 'Dry') as precipitation_status,
  count(distinct "timestamp") as hours,
  count(*)::double / count(distinct "timestamp") as avg_trips_per_hour
from raw_yellow join raw_weather on "timestamp" = date_trunc('hour', tpep_pickup_datetime)
group by 1, 2""")
oracle("rpt_mode_hour_weather", """
select "timestamp" as hour, mode, count(*) as trips, any_value(temp) as temp,
  any_value(precipitation) as precipitation
from (select tpep_pickup_datetime as ts, 'Yellow Taxi' as mode from raw_yellow
      union all select pickup_datetime, 'FHV' from raw_fhv
      union all select started_at, 'CitiBike' from raw_bike)
join raw_weather on "timestamp" = date_trunc('hour', ts) group by 1, 2""")
oracle("rpt_trips_by_weather", f"""
select count(*) as total_trips, count(temp) as trips_with_weather,
  {pct('count(temp)', 'count(*)')} as coverage_pct
from raw_fhv left join raw_weather on "timestamp" = date_trunc('hour', pickup_datetime)""")
oracle("rpt_coverage_by_mode", f"""
select trip_type, count(*) as total_trips, count(temperature_fahrenheit) as trips_with_weather,
  round({pct('count(temperature_fahrenheit)', 'count(*)')}, 2) as pct_coverage
from fct group by 1""")
oracle("rpt_coverage_total", f"""
select count(*) as total_trips, {_COVERED} as with_weather,
  round({pct(_COVERED, 'count(*)')}, 6) as coverage_pct from fct""")
oracle("rpt_bike_month_coverage", _MONTHS.format(ts="started_at", table="raw_bike"))
oracle("rpt_bike_daily_counts", """
select started_at::date as date, count(*) as trips from raw_bike
where started_at >= timestamp '2024-01-01' and started_at < timestamp '2024-02-01' group by 1""")
oracle("rpt_trips_per_month", """
select date_trunc('month', pickup_datetime)::timestamp as month, count(*) as trips
from trips group by 1""")

# --- streams ------------------------------------------------------------------------------------------

oracle("str_merge_bike", "select * from raw_bike")
oracle("str_bike_archives", "select * from raw_bike")
oracle("inc_monthly_runs", """
select step, month::int as month,
  case when step = 'older' then 'error_no_data' when step <> 'backfill' then 'validated'
       when month in (2, 4) then 'successful' else 'kept' end as status,
  if(step = 'older', 0, (select count(*) from trips
    where year(pickup_datetime) = 1996 and month(pickup_datetime) = s.month
      and trip_type <> 'citibike'))::bigint as trips
from (values ('first', 3), ('again', 3), ('later', 5), ('older', 2), ('backfill', 2),
             ('backfill', 3), ('backfill', 4), ('backfill', 5)) s(step, month)""")
oracle("str_hourly_medians", """
select date_trunc('hour', pickup_datetime) as hour_timestamp, trip_type, count(*) as trip_count,
  median(revenue) as median_revenue, median(trip_distance) as median_trip_distance
from trips
where date_trunc('hour', pickup_datetime) + interval 1 hour
  <= (select max(pickup_datetime) - interval 2 hour from trips)
group by 1, 2""")
oracle("str_hourly_counts", """
select date_trunc('hour', pickup_datetime) as hour_timestamp, trip_type, count(*) as trip_count,
  sum(revenue) as total_revenue, avg(trip_distance) as avg_trip_distance_miles
from trips group by 1, 2""")
