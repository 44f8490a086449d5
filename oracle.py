"""SQL over the given tables with the results the registered queries must have."""

# The mapping of the test tables to incidents (see FIXTURES.md), in SQL.
_EVENTS = """
ev AS (
    SELECT event_id AS crime_id,
           ts AS crime_date,
           CASE event_type WHEN 'error' THEN 'BATTERY' WHEN 'purchase' THEN 'THEFT'
                WHEN 'signup' THEN 'ASSAULT' WHEN 'view' THEN 'NARCOTICS'
                WHEN 'click' THEN 'HOMICIDE' END AS primary_type,
           CASE user_id % 4 WHEN 0 THEN 'STREET' WHEN 1 THEN 'RESIDENCE'
                WHEN 2 THEN 'APARTMENT' END AS location_description,
           k % 2 = 0 AS arrest,
           k % 3 = 0 AS domestic,
           CASE WHEN event_id % 50 <> 0
                THEN CAST(41.5 AS DOUBLE) + (user_id % 5) / 64 + k / 8192 END AS latitude,
           CASE WHEN event_id % 50 <> 0
                THEN CAST(-87.75 AS DOUBLE) + (user_id % 3) / 64 + k / 8192 END AS longitude,
           TIMESTAMP '2024-02-01 00:00:00' + event_id * INTERVAL 5 SECOND AS event_time
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
),
inc AS (
    SELECT *, hour(crime_date) AS hour_of_day, dayname(crime_date) AS day_of_week,
           month(crime_date) AS month, year(crime_date) AS year,
           coalesce(primary_type IN ('HOMICIDE', 'ASSAULT', 'BATTERY', 'ROBBERY'), FALSE)
               AS is_violent,
           coalesce(dayname(crime_date) IN ('Saturday', 'Sunday'), FALSE) AS is_weekend
    FROM ev
)"""

# The stream sends times to the second and absent places as empty text.
_SENT = (
    _EVENTS
    + """,
sent AS (
    SELECT * REPLACE (date_trunc('second', crime_date) AS crime_date,
                      coalesce(location_description, '') AS location_description)
    FROM inc
)"""
)

_ORDERS = """
od AS (
    SELECT o_orderkey AS crime_id,
           'C' || o_orderkey AS case_number,
           o_orderdate AS date,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'HOMICIDE' WHEN '2-HIGH' THEN 'BATTERY'
                WHEN '3-MEDIUM' THEN 'THEFT' WHEN '4-NOT SPECIFIED' THEN 'NARCOTICS'
                WHEN '5-LOW' THEN 'ROBBERY' END AS primary_type,
           'order, no. ' || o_orderkey AS description,
           CASE o_orderstatus WHEN 'F' THEN 'STREET' WHEN 'O' THEN 'RESIDENCE'
                WHEN 'P' THEN 'APARTMENT' END AS location_description,
           o_orderkey % 2 = 0 AS arrest,
           o_custkey % 3 = 0 AS domestic,
           CASE WHEN o_orderkey % 50 <> 0
                THEN CAST(41.5 AS DOUBLE) + (o_custkey % 8) / 64 END AS latitude,
           CASE WHEN o_orderkey % 50 <> 0
                THEN CAST(-87.75 AS DOUBLE) + (o_custkey % 4) / 64 END AS longitude
    FROM orders
)"""

_SEASON = """
           CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter'
                WHEN month(date) IN (3, 4, 5) THEN 'Spring'
                WHEN month(date) IN (6, 7, 8) THEN 'Summer'
                WHEN month(date) IN (9, 10, 11) THEN 'Fall'
                ELSE 'Unknown' END AS season"""

_CURATED = (
    _ORDERS
    + f""",
cur AS (
    SELECT *, dayname(date) AS day_of_week, month(date) AS month, year(date) AS year, {_SEASON}
    FROM od WHERE latitude IS NOT NULL AND longitude IS NOT NULL
)"""
)

# Raw text of the orders, with the bad values at fixed intervals.
_RAW = (
    _ORDERS
    + """,
raw AS (
    SELECT CAST(crime_id AS VARCHAR) AS crime_id, case_number,
           CASE WHEN crime_id % 97 = 0 THEN 'garbage'
                WHEN crime_id % 97 = 1 THEN '1/5/2000 1:30:00 PM'
                ELSE strftime(date + (crime_id % 86400) * INTERVAL 1 SECOND,
                              '%m/%d/%Y %I:%M:%S %p') END AS date,
           primary_type, description, location_description,
           CASE WHEN crime_id % 89 = 0 THEN 'maybe' ELSE CAST(arrest AS VARCHAR) END AS arrest,
           CASE WHEN crime_id % 83 = 0 THEN 'Y' ELSE CAST(domestic AS VARCHAR) END AS domestic,
           CASE WHEN crime_id % 79 = 0 THEN 'north' ELSE CAST(latitude AS VARCHAR) END AS latitude,
           CAST(longitude AS VARCHAR) AS longitude
    FROM od
),
typ AS (
    SELECT crime_id, case_number,
           CASE WHEN crime_id % 97 > 1
                THEN date + (crime_id % 86400) * INTERVAL 1 SECOND END AS date,
           primary_type, description, location_description,
           CASE WHEN crime_id % 89 <> 0 THEN arrest END AS arrest,
           crime_id % 83 = 0 OR domestic AS domestic,
           CASE WHEN crime_id % 79 <> 0 THEN latitude END AS latitude,
           longitude
    FROM od
)"""
)

_WITH_CALENDAR = "*, dayname(date) AS day_of_week, month(date) AS month, year(date) AS year"
_LOCATED = "latitude IS NOT NULL AND longitude IS NOT NULL"


def _grid(prefix: str, decimals: int) -> str:
    return (
        f"CAST(round({prefix}latitude, {decimals}) AS VARCHAR) || '_' || "
        f"CAST(round({prefix}longitude, {decimals}) AS VARCHAR)"
    )


def _windows(source: str, length: int, slide: int, where: str = "TRUE") -> str:
    return f"""
win AS (
    SELECT *, time_bucket(INTERVAL {slide} MINUTE, event_time) - back * INTERVAL 1 MINUTE AS ws
    FROM (SELECT * FROM {source} WHERE {where}),
         (SELECT unnest(range(0, {length}, {slide})) AS back)
)"""


def _closed(source: str, length: int, where: str = "TRUE") -> str:
    """Windows a finished stream has put out: those the watermark has passed."""
    return f"""ws + INTERVAL {length} MINUTE <=
        (SELECT max(event_time) - INTERVAL 10 SECOND FROM {source} WHERE {where})"""


def _t1(base: str, source: str, counts: bool = False, streamed: bool = False) -> str:
    types = "array_to_string(list_sort(list(primary_type)), ',')"
    if counts:
        types = (
            "(SELECT string_agg(t || '=' || n, ',' ORDER BY t) FROM (SELECT t, count(*) AS n "
            "FROM (SELECT unnest(list(primary_type)) AS t) GROUP BY t))"
        )
    closed = _closed(source, 5, _LOCATED) if streamed else "TRUE"
    return f"""WITH {base}, {_windows(source, 5, 1, _LOCATED)}
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, geo_grid,
       avg(latitude) AS avg_lat, avg(longitude) AS avg_lon,
       count(*) AS crime_count, count(DISTINCT primary_type) AS crime_variety,
       CASE WHEN count(*) >= 5 THEN 'HIGH' WHEN count(*) >= 3 THEN 'MEDIUM' ELSE 'LOW' END
           AS hotspot_severity,
       {types} AS crime_types
FROM (SELECT *, {_grid('', 2)} AS geo_grid FROM win)
WHERE {closed}
GROUP BY ws, geo_grid HAVING count(*) >= 2"""


def _t2(base: str, source: str, per_location: bool = True, history: str = "ev") -> str:
    place = "location_description" if per_location else "CAST(NULL AS VARCHAR)"
    return f"""WITH {base}, hist AS (
    SELECT primary_type, {place} AS pattern_location, hour(crime_date) AS h, dayofweek(crime_date) + 1 AS d,
           count(*) AS historical_frequency
    FROM {history} GROUP BY ALL
)
SELECT s.crime_id, s.crime_date, s.primary_type, s.location_description,
       hist.pattern_location, hist.historical_frequency IS NOT NULL AS pattern_match,
       CAST(CASE WHEN hist.historical_frequency IS NULL THEN 1 ELSE 0 END AS DOUBLE)
           AS anomaly_score,
       hist.historical_frequency, s.event_time
FROM {source} s LEFT JOIN hist ON s.primary_type = hist.primary_type
     AND hour(s.event_time) = hist.h AND dayofweek(s.event_time) + 1 = hist.d"""


def _t3(base: str, source: str, streamed: bool = False) -> str:
    closed = _closed(source, 10, "is_violent") if streamed else "TRUE"
    return f"""WITH {base}, {_windows(source, 10, 2, 'is_violent')}
SELECT ws AS period_start, ws + INTERVAL 10 MINUTE AS period_end, geo_zone,
       avg(latitude) AS zone_lat, avg(longitude) AS zone_lon,
       count(*) AS violent_incidents, count(DISTINCT primary_type) AS violence_types,
       count(*) FILTER (WHERE primary_type = 'HOMICIDE') AS homicides,
       count(*) FILTER (WHERE primary_type = 'ASSAULT') AS assaults,
       count(*) FILTER (WHERE arrest) AS arrests_made,
       round(count(*) FILTER (WHERE arrest) / count(*) * 100, 2) AS arrest_effectiveness,
       CASE WHEN count(*) >= 4 THEN 'CRITICAL' WHEN count(*) >= 2 THEN 'HIGH' ELSE 'NORMAL' END
           AS escalation_risk
FROM (SELECT *, {_grid('', 1)} AS geo_zone FROM win)
WHERE {closed}
GROUP BY ws, geo_zone"""


def _t4(base: str, source: str) -> str:
    return f"""WITH {base}, cell AS (
    SELECT *, {_grid('', 2)} AS geo_grid FROM {source} WHERE {_LOCATED}
)
SELECT d.crime_id AS d_crime_id, nd.crime_id AS nd_crime_id,
       d.primary_type AS d_primary_type, nd.primary_type AS nd_primary_type,
       d.location_description AS d_location, nd.location_description AS nd_location,
       (epoch(d.event_time) - epoch(nd.event_time)) / 60 AS time_diff_minutes,
       round(sqrt(pow(d.latitude - nd.latitude, 2) + pow(d.longitude - nd.longitude, 2))
             * 111000, 6) AS geographic_distance,
       d.latitude AS correlation_lat, d.longitude AS correlation_lon, d.geo_grid
FROM cell d JOIN cell nd ON d.geo_grid = nd.geo_grid AND d.domestic AND NOT nd.domestic
     AND d.event_time >= nd.event_time
     AND d.event_time <= nd.event_time + INTERVAL 30 MINUTE"""


def _t5(base: str, source: str, streamed: bool = False) -> str:
    closed = _closed(source, 15) if streamed else "TRUE"
    return f"""WITH {base}, {_windows(source, 15, 5)}
SELECT ws AS analysis_start, ws + INTERVAL 15 MINUTE AS analysis_end, primary_type, hour_of_day,
       CASE WHEN hour_of_day BETWEEN 6 AND 12 THEN 'MORNING'
            WHEN hour_of_day BETWEEN 13 AND 18 THEN 'AFTERNOON'
            WHEN hour_of_day BETWEEN 19 AND 24 THEN 'EVENING' ELSE 'NIGHT' END AS time_category,
       is_weekend, count(*) AS incident_count,
       avg(CASE WHEN arrest THEN 1 ELSE 0 END) AS arrest_rate,
       count(DISTINCT location_description) AS location_diversity,
       round(coalesce(sqrt(pow(stddev_samp(latitude), 2) + pow(stddev_samp(longitude), 2)), 0.0),
             6) AS geographic_dispersion,
       CASE WHEN count(*) >= 5 THEN 'VERY_HIGH' WHEN count(*) >= 3 THEN 'HIGH'
            WHEN count(*) >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS crime_intensity
FROM win WHERE {closed}
GROUP BY ws, primary_type, hour_of_day, is_weekend"""


def _total(keys: str, where: str = "TRUE", name: str = "total_crimes") -> str:
    return f"""WITH {_CURATED}
SELECT {keys}, count(*) AS {name} FROM cur WHERE {where} GROUP BY {keys}"""


_VIOLENT_TREND = _total(
    "year", "primary_type IN ('HOMICIDE', 'ASSAULT', 'BATTERY', 'ROBBERY')", "violent_crimes"
)


def _positions(sql: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS position FROM ({sql})"


def _top(group: str) -> str:
    return f"""WITH {_CURATED}, tot AS (
    SELECT {group}, primary_type, count(*) AS total_crimes FROM cur GROUP BY ALL
)
SELECT {group}, primary_type, total_crimes, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY {group}
                                 ORDER BY total_crimes DESC, primary_type) AS rank FROM tot
) WHERE rank = 1"""


_ETL_ALL = f"""WITH {_RAW}
SELECT {_WITH_CALENDAR}, {_SEASON} FROM typ WHERE {_LOCATED}"""

# Messages that the damaged input still delivers (see the query).
_READABLE = "crime_id % 97 <> 0 AND crime_id % 89 <> 0 AND crime_id % 83 <> 0"
_REASON = """CASE WHEN crime_id % 97 = 0 THEN 'not a record' WHEN crime_id % 89 = 0 THEN 'no ID'
            WHEN crime_id % 83 = 0 THEN 'unreadable date' END"""
_RECORD = """crime_id, 'C' || crime_id AS case_number, crime_date, primary_type,
       'event, no. ' || crime_id AS description, location_description, arrest, domestic,
       latitude, longitude, event_time"""
_FLAGS = "hour_of_day, day_of_week, month, year, is_violent, is_weekend"

_MESSAGE = """
msg AS (
    SELECT CAST(crime_id AS VARCHAR) AS key,
           '{"ID":"' || crime_id || '","Case Number":"C' || crime_id ||
           '","Date":"' || strftime(crime_date, '%m/%d/%Y %I:%M:%S %p') ||
           '","Primary Type":"' || primary_type ||
           '","Description":"event, no. ' || crime_id ||
           '","Location Description":"' || location_description ||
           '","Arrest":"' || CAST(arrest AS VARCHAR) ||
           '","Domestic":"' || CAST(domestic AS VARCHAR) ||
           '","Latitude":"' || coalesce(CAST(latitude AS VARCHAR), '') ||
           '","Longitude":"' || coalesce(CAST(longitude AS VARCHAR), '') || '"}' AS value,
           event_time AS timestamp
    FROM sent
)"""


# Columns of each collection in name order: what is compared as text, and as numbers.
_COMPARED = {
    "stream_crime_hotspots": (
        ["crime_count", "crime_types", "crime_variety", "geo_grid", "hotspot_severity",
         "window_end", "window_start"],
        ["avg_lat", "avg_lon"],
    ),
    "stream_violence_escalation": (
        ["arrests_made", "assaults", "escalation_risk", "geo_zone", "homicides", "period_end",
         "period_start", "violence_types", "violent_incidents"],
        ["arrest_effectiveness", "zone_lat", "zone_lon"],
    ),
    "stream_domestic_correlation": (
        ["d_crime_id", "d_location", "d_primary_type", "geo_grid", "nd_crime_id", "nd_location",
         "nd_primary_type"],
        ["correlation_lat", "correlation_lon", "geographic_distance", "time_diff_minutes"],
    ),
    "stream_pattern_analysis": (
        ["crime_date", "crime_id", "event_time", "historical_frequency", "location_description",
         "pattern_location", "pattern_match", "primary_type"],
        ["anomaly_score"],
    ),
    "stream_temporal_patterns": (
        ["analysis_end", "analysis_start", "crime_intensity", "hour_of_day", "incident_count",
         "is_weekend", "location_diversity", "primary_type", "time_category"],
        ["arrest_rate", "geographic_dispersion"],
    ),
}


def _comparable(name: str, sql: str, texts: list[str], numbers: list[str]) -> str:
    text = ", ".join(f"coalesce(CAST({x} AS VARCHAR), '')" for x in texts)
    values = [f"round(CAST({x} AS DOUBLE), 6)" for x in numbers]
    values += ["CAST(NULL AS DOUBLE)"] * (4 - len(values))
    named = ", ".join(f"{value} AS n{i}" for i, value in enumerate(values))
    return f"SELECT '{name}' AS collection, concat_ws('|', {text}) AS values, {named} FROM ({sql})"


_STREAMS = {
    "stream_crime_hotspots": _t1(_SENT, "sent", streamed=True),
    "stream_violence_escalation": _t3(_SENT, "sent", streamed=True),
    "stream_domestic_correlation": _t4(_SENT, "sent"),
    "stream_pattern_analysis": _t2(_SENT, "sent"),
    "stream_temporal_patterns": _t5(_SENT, "sent", streamed=True),
}

# The job gives the types of a hotspot as counts.
_COLLECTIONS = _STREAMS | {"stream_crime_hotspots": _t1(_SENT, "sent", counts=True, streamed=True)}

# The first and last two of four slices of what is sent, and every second record of the history.
_HALVES = """, middle AS (
    SELECT epoch_us(min(event_time))
           + (epoch_us(max(event_time)) + 1 - epoch_us(min(event_time))) * 2 // 4 AS moment FROM sent
),
early AS (SELECT sent.* FROM sent, middle WHERE epoch_us(event_time) < middle.moment),
later AS (SELECT sent.* FROM sent, middle WHERE epoch_us(event_time) >= middle.moment),
half AS (SELECT * FROM ev WHERE crime_id % 2 = 0)"""

ORACLE: dict[str, str] = {
    "b01_by_weekday": _total("day_of_week"),
    "b02_top_type_year": _top("year"),
    "b03_by_location": _total("location_description"),
    "b04_type_arrest": _total("primary_type, arrest"),
    "b05_violent_trend": _VIOLENT_TREND,
    "b06_location_type": _total("location_description, primary_type"),
    "b07_by_month": _total("month"),
    "b08_domestic_arrests": _total("arrest", "domestic"),
    "b09_top_type_season": _top("season"),
    "b10_geo_distribution": _total("year, latitude, longitude"),
    "b01_by_weekday_ordered": _positions(
        _total("day_of_week"), "total_crimes DESC, day_of_week"
    ),
    "b05_violent_trend_ordered": _positions(_VIOLENT_TREND, "year"),
    "b06_location_type_ordered": _positions(
        _total("location_description, primary_type"),
        "total_crimes DESC, location_description NULLS FIRST, primary_type",
    ),
    "b10_geo_distribution_ordered": _positions(
        _total("year, latitude, longitude"), "year, total_crimes DESC, latitude, longitude"
    ),
    "b01_by_weekday_published": _total("day_of_week"),
    "b02_top_type_year_published": _top("year"),
    "b03_by_location_published": _total("location_description"),
    "b04_type_arrest_published": _total("primary_type, arrest"),
    "b05_violent_trend_published": _VIOLENT_TREND,
    "b06_location_type_published": _total("location_description, primary_type"),
    "b07_by_month_published": _total("month"),
    "b08_domestic_arrests_published": _total("arrest", "domestic"),
    "b09_top_type_season_published": _top("season"),
    "b02_top_type_year_incremental": _top("year"),
    "b06_location_type_incremental": _total("location_description, primary_type"),
    "b10_geo_distribution_incremental": _total("year, latitude, longitude"),
    "box_incidents": f"""WITH {_CURATED}
SELECT * FROM cur WHERE latitude BETWEEN 41.4 AND 41.7 AND longitude BETWEEN -87.8 AND -87.6
     AND month BETWEEN 3 AND 5""",
    "src_csv_raw": f"WITH {_RAW} SELECT * FROM raw",
    "src_csv_column_orders": f"WITH {_RAW} SELECT * FROM raw",
    "src_curated": f"WITH {_CURATED} SELECT * FROM cur",
    "src_inline": f"""WITH {_EVENTS}, hist(primary_type, h, d, place, historical_frequency) AS (
    VALUES ('THEFT', 10, 5, 'STREET', 1), ('BATTERY', 10, 5, 'RESIDENCE', 1)
)
SELECT s.crime_id, s.crime_date, s.primary_type, s.location_description,
       hist.place AS pattern_location,
       hist.h IS NOT NULL AS pattern_match,
       CAST(CASE WHEN hist.h IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS anomaly_score,
       CAST(hist.historical_frequency AS BIGINT) AS historical_frequency, s.event_time
FROM inc s LEFT JOIN hist ON s.primary_type = hist.primary_type
     AND hour(s.event_time) = hist.h AND dayofweek(s.event_time) + 1 = hist.d""",
    "src_stream_envelope": f"WITH {_SENT}, {_MESSAGE} SELECT * FROM msg",
    "publish_json": f"WITH {_SENT}, {_MESSAGE} SELECT * FROM msg",
    "sink_curated_roundtrip": _ETL_ALL,
    "sink_foreachbatch": f"""WITH {_SENT}
SELECT {_RECORD}, {_FLAGS}, 'session-1' AS _session_id FROM sent""",
    "sink_packed": f"""WITH {_SENT}
SELECT {_RECORD}, {_FLAGS}, 'session-1' AS _session_id FROM sent""",
    "etl_select_rename": f"WITH {_RAW} SELECT * FROM raw",
    "etl_typed": f"WITH {_RAW} SELECT * FROM typ",
    "etl_calendar": f"WITH {_RAW} SELECT {_WITH_CALENDAR} FROM typ",
    "etl_season": f"WITH {_RAW} SELECT {_WITH_CALENDAR}, {_SEASON} FROM typ",
    "etl_geo_filter": f"WITH {_RAW} SELECT * FROM typ WHERE {_LOCATED}",
    "etl_curate": _ETL_ALL,
    "stream_extract": f"WITH {_SENT} SELECT {_RECORD} FROM sent WHERE {_READABLE}",
    "stream_enrich": f"WITH {_SENT} SELECT {_RECORD}, {_FLAGS} FROM sent WHERE {_READABLE}",
    "geo_grid": f"""WITH {_EVENTS}
SELECT crime_id, {_grid('', 2)} AS grid_fine, {_grid('', 1)} AS grid_coarse FROM ev""",
    "union_all": f"""WITH {_EVENTS}, {_ORDERS}
SELECT crime_id, primary_type, location_description, latitude, longitude FROM ev
UNION ALL
SELECT crime_id, primary_type, location_description, latitude, longitude FROM od""",
    "historical_patterns": f"""WITH {_EVENTS}
SELECT primary_type, location_description, CAST(hour(crime_date) AS INTEGER) AS hour_pattern,
       CAST(dayofweek(crime_date) + 1 AS INTEGER) AS dow_pattern,
       avg(latitude) AS typical_lat, avg(longitude) AS typical_lon,
       count(*) AS historical_frequency
FROM ev GROUP BY ALL""",
    "t1_hotspots": _t1(_EVENTS, "inc"),
    "t1_hotspots_counts": _t1(_EVENTS, "inc", counts=True),
    "t2_pattern": _t2(_EVENTS, "inc"),
    "t2_pattern_keyed": _t2(_EVENTS, "inc", per_location=False),
    "t2_pattern_shuffled": _t2(_EVENTS, "inc"),
    "t3_violence": _t3(_EVENTS, "inc"),
    "t3_violence_untimed": _t3(
        _EVENTS + ", timed AS (SELECT * FROM inc WHERE crime_id % 10 <> 0)", "timed"
    ),
    "t4_hot_cell_stream": _t4(
        _SENT
        + """, crowded AS (SELECT * REPLACE (
            CASE WHEN crime_id % 3 = 0 THEN CAST(41.5 AS DOUBLE) ELSE latitude END AS latitude,
            CASE WHEN crime_id % 3 = 0 THEN CAST(-87.75 AS DOUBLE) ELSE longitude END AS longitude)
            FROM sent)""",
        "crowded",
    ),
    "pattern_documents": f"""SELECT crime_id, event_time, pattern_location, 1 AS documents
FROM ({_t2(_EVENTS, "inc")})""",
    "t1_hotspots_counts_stream": _t1(_SENT, "sent", counts=True, streamed=True),
    "t4_domestic": _t4(_EVENTS, "inc"),
    "t4_domestic_salted": _t4(_EVENTS, "inc"),
    "t5_temporal": _t5(_EVENTS, "inc"),
    "t5_temporal_sketch": _t5(_EVENTS, "inc"),
    "t5_temporal_sketch_stream": _STREAMS["stream_temporal_patterns"],
    "t1_hotspots_stream": _STREAMS["stream_crime_hotspots"],
    "t2_pattern_stream": _STREAMS["stream_pattern_analysis"],
    "t2_renewed_stream": f"""SELECT * FROM ({_t2(_SENT + _HALVES, "early", history="half")})
UNION ALL SELECT * FROM ({_t2(_SENT + _HALVES, "later")})""",
    "t3_violence_stream": _STREAMS["stream_violence_escalation"],
    "t4_domestic_stream": _STREAMS["stream_domestic_correlation"],
    "t5_temporal_stream": _STREAMS["stream_temporal_patterns"],
    "late_data": _STREAMS["stream_violence_escalation"],
    "late_rows": f"""WITH {_SENT},
ends AS (SELECT max(event_time) AS high, max(event_time) - INTERVAL 10 SECOND AS wm FROM sent),
again AS (SELECT sent.*, wm FROM sent, ends WHERE event_time >= high - INTERVAL 15 MINUTE),
kinds(collection, length, slide) AS (
    VALUES ('stream_crime_hotspots', 5, 1), ('stream_violence_escalation', 10, 2),
           ('stream_temporal_patterns', 15, 5)
),
missed AS (
    SELECT crime_id, collection, CAST(count(*) AS INTEGER) AS windows
    FROM (SELECT *, unnest(range(0, length, slide)) AS back FROM again, kinds)
    WHERE time_bucket(to_minutes(slide), event_time) + to_minutes(length - back) <= wm
      AND CASE collection WHEN 'stream_crime_hotspots' THEN {_LOCATED}
                          WHEN 'stream_violence_escalation' THEN is_violent ELSE TRUE END
    GROUP BY crime_id, collection
)
SELECT * FROM missed
UNION ALL
SELECT crime_id, 'stream_domestic_correlation', 1 FROM again WHERE {_LOCATED} AND event_time <= wm""",
    "ingest_outcomes": f"""WITH {_SENT}
SELECT CAST(crime_id AS VARCHAR) AS key,
       CASE WHEN {_READABLE} THEN 'accepted' ELSE 'rejected' END AS outcome, {_REASON} AS reason
FROM sent""",
    "rejected_messages": f"""WITH {_SENT}, {_MESSAGE}
SELECT key, CAST(CASE WHEN crime_id % 97 = 0 THEN 40 WHEN crime_id % 89 = 0 THEN len(value)
            ELSE len(value) + 1 END AS INTEGER) AS length, {_REASON} AS rejected_because
FROM (SELECT *, CAST(key AS BIGINT) AS crime_id FROM msg) WHERE NOT ({_READABLE})""",
    "start_all": "\nUNION ALL\n".join(
        _comparable(name, _COLLECTIONS[name], *columns) for name, columns in _COMPARED.items()
    ),
}
