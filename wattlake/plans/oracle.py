"""DuckDB statements with the results of the registered queries."""

from __future__ import annotations

READINGS = """
per AS (SELECT max(user_id) + 1 AS total, (max(user_id) + 1 + 3) // 4 AS per_shard FROM events),
base AS (
  SELECT event_id, user_id AS meter_index, printf('METER-%04d', user_id) AS meter_id, ts,
         value AS kwh,
         CAST(1980 + event_id % 450 AS DOUBLE) / CAST(10 AS DOUBLE) AS voltage,
         CAST(10 + event_id % 3 AS DOUBLE) / CAST(10 AS DOUBLE) AS f
  FROM events),
readings AS (
  SELECT event_id, meter_index, meter_id, ts, kwh, voltage,
         floor(kwh * CAST(1000 AS DOUBLE) / voltage * f * CAST(100 AS DOUBLE))
           / CAST(100 AS DOUBLE) AS amps,
         CAST(meter_index // per_shard AS INTEGER) AS shard_id,
         'collector-' || CAST(meter_index // per_shard + 1 AS VARCHAR) AS collector_id
  FROM base, per),
checked AS (
  SELECT *, voltage * amps / CAST(1000 AS DOUBLE) AS power,
         abs(voltage * amps / CAST(1000 AS DOUBLE) - kwh) AS diff,
         kwh * CAST(0.15 AS DOUBLE) AS tol,
         CASE WHEN kwh < 0 OR kwh > 50 THEN 1
              WHEN voltage < 200 OR voltage > 240 THEN 2
              WHEN amps < 0 OR amps > 100 THEN 3
              WHEN abs(voltage * amps / CAST(1000 AS DOUBLE) - kwh)
                   > kwh * CAST(0.15 AS DOUBLE) THEN 4
              ELSE 0 END AS error_code
  FROM readings),
valid AS (SELECT * FROM checked WHERE error_code = 0)"""


def _sum(value: str) -> str:
    """All decimals that the readings have, and seven more."""
    return f"CAST(sum(CAST({value} AS DECIMAL(28, 9))) AS DOUBLE)"


def _long(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


MEASURES = f"""count(*) AS count, {_sum('kwh')} AS sum_kwh, {_sum('kwh')} / count(*) AS avg_kwh,
  min(kwh) AS min_kwh, max(kwh) AS max_kwh, {_sum('voltage')} / count(*) AS avg_voltage,
  {_sum('amps')} / count(*) AS avg_current,
  min(ts) AS first_reading, max(ts) AS last_reading"""

ORIGIN = "TIMESTAMP '1970-01-01'"
METRICS = f"""{READINGS},
metrics AS (
  SELECT time_bucket(INTERVAL 1 DAY, ts, {ORIGIN}) AS window_start,
         time_bucket(INTERVAL 1 DAY, ts, {ORIGIN}) + INTERVAL 1 DAY AS window_end,
         shard_id, collector_id, meter_id, {MEASURES}
  FROM valid GROUP BY ALL)"""

WINDOWS = f"""{METRICS},
windows AS (
  SELECT window_start, window_end, shard_id, collector_id, {_long('sum(count)')} AS total_count,
         {_sum('sum_kwh')} AS total_kwh, count(*) AS num_meters
  FROM metrics GROUP BY ALL),
latest AS (
  SELECT * FROM windows
  ORDER BY window_end DESC, window_start, shard_id, collector_id LIMIT 50)"""

MERGED = f"""{READINGS},
merged AS (
  SELECT meter_id, ts, CASE WHEN event_id % 10 = 0 THEN kwh + 1 ELSE kwh END AS kwh, voltage, amps
  FROM readings
  QUALIFY row_number() OVER (PARTITION BY meter_id, date_trunc('second', ts)
    ORDER BY CASE WHEN event_id % 10 = 0 THEN 3 WHEN event_id % 3 = 0 OR event_id % 7 = 0 THEN 2 ELSE 1 END DESC,
             event_id DESC) = 1)"""

HYBRID = f"""{READINGS},
ranked AS (
  SELECT *, time_bucket(INTERVAL 7 DAY, ts, {ORIGIN}) AS bucket,
         (row_number() OVER (PARTITION BY shard_id, time_bucket(INTERVAL 7 DAY, ts, {ORIGIN})
                             ORDER BY ts, event_id) - 1) // 100 AS window_seq
  FROM valid),
bounds AS (
  SELECT bucket, shard_id, window_seq,
         CASE WHEN window_seq = 0 THEN bucket ELSE min(ts) END AS window_start,
         CASE WHEN count(*) = 100 THEN max(ts) ELSE bucket + INTERVAL 7 DAY END AS window_end
  FROM ranked GROUP BY bucket, shard_id, window_seq),
hybrid AS (
  SELECT window_start, window_end, window_seq, shard_id, collector_id, meter_id, {MEASURES}
  FROM ranked JOIN bounds USING (bucket, shard_id, window_seq) GROUP BY ALL)"""

COUNTED = f"""{READINGS},
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY shard_id ORDER BY ts, event_id) - 1) // 100
            AS window_seq
  FROM valid),
bounds AS (
  SELECT shard_id, window_seq, min(ts) AS window_start, max(ts) AS window_end
  FROM ranked GROUP BY ALL)"""

READING_COLUMNS = 'event_id, meter_id, ts, kwh, voltage, amps AS "current"'
METRIC_TABLE = """window_start, window_end, shard_id, collector_id, meter_id, count, sum_kwh,
  avg_kwh, min_kwh, max_kwh, avg_voltage, avg_current, first_reading, last_reading"""
FLAT = """window_start, window_end, collector_id, shard_id, meter_id, count, sum_kwh, avg_kwh,
  min_kwh, max_kwh, avg_voltage, avg_current"""
MESSAGE = """CASE {0} WHEN 0 THEN 'No error' WHEN 1 THEN 'Power consumption out of valid range'
  WHEN 2 THEN 'Voltage out of valid range' WHEN 3 THEN 'Current out of valid range'
  WHEN 4 THEN 'Power calculation mismatch' WHEN 5 THEN 'Anomaly detected in readings'
  ELSE 'Unknown error' END"""
MICRO = "CAST(1000000 AS DOUBLE)"
SPAN = f"(epoch_us({{1}}) - epoch_us({{0}})) / {MICRO}"


def _mean(name: str) -> str:
    return f"{_sum(name)} / count({name})"


def _merged(keys: str) -> str:
    return f"""SELECT {keys}, {_long('sum(count)')} AS count, {_sum('sum_kwh')} AS sum_kwh,
      min(min_kwh) AS min_kwh, max(max_kwh) AS max_kwh,
      {_sum('avg_voltage * count')} AS sum_voltage, {_sum('avg_current * count')} AS sum_current
    FROM keyed GROUP BY ALL"""


REPORT = f"""{_long('sum(count)')} AS total_readings, count(*) AS active_meters,
  {_sum('sum_kwh')} AS total_kwh, {_sum('sum_kwh')} / sum(count) AS weighted_avg_kwh,
  min(min_kwh) AS min_kwh, max(max_kwh) AS max_kwh,
  {_sum('sum_voltage')} / sum(count) AS weighted_avg_voltage,
  {_sum('sum_current')} / sum(count) AS weighted_avg_current"""


def _pop_std(value: str) -> str:
    cents = f"CAST(round_even({value} * CAST(100 AS DOUBLE), 0) AS HUGEINT)"
    mean = f"{_sum(value)} / count({value})"
    square = f"CAST(sum({cents} * {cents}) AS DOUBLE) / count({value}) / CAST(10000 AS DOUBLE)"
    return f"sqrt(greatest({square} - ({mean}) * ({mean}), 0))"


def _wide_std(value: str) -> str:
    """As _pop_std, of values whose squares add up beyond 64 bits.

    The cast of such a sum to a double is not the nearest one, so it goes through its text.
    """
    cents = f"CAST(round_even({value} * CAST(100 AS DOUBLE), 0) AS HUGEINT)"
    total = f"CAST(CAST(sum({cents} * {cents}) AS VARCHAR) AS DOUBLE)"
    square = f"{total} / count({value}) / CAST(10000 AS DOUBLE)"
    mean = f"{_sum(value)} / count({value})"
    return f"sqrt(greatest({square} - ({mean}) * ({mean}), 0))"


def _quantile(value: str, q: float) -> str:
    return f"round_even(quantile_cont({value}, {q}) * {MICRO}, 0) / {MICRO}"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _batch() -> dict[str, str]:
    t0, t1 = "TIMESTAMP '2024-01-10 06:30:15.5'", "TIMESTAMP '2024-01-20 18:45:30.25'"
    s0, s1 = "TIMESTAMP '2024-01-10 06:30:15'", "TIMESTAMP '2024-01-20 18:45:30'"
    scan = f"SELECT {READING_COLUMNS} FROM"
    return {
        "scan_readings": _with(READINGS, f"{scan} readings"),
        "readings_roundtrip": _with(
            READINGS,
            'SELECT meter_id, ts, kwh, voltage, amps AS "current" FROM readings',
        ),
        "json_readings": _with(
            READINGS,
            '''SELECT meter_id, ts, kwh, voltage, amps AS "current" FROM readings
               WHERE event_id % 13 <> 0''',
        ),
        "upsert_latest": _with(
            READINGS,
            f"""{scan} (SELECT *, row_number() OVER (PARTITION BY meter_id, date_trunc('hour', ts)
                 ORDER BY event_id DESC) AS n FROM readings) WHERE n = 1""",
        ),
        "stored_anomalies": _with(
            f"""{READINGS}, written AS (
                SELECT 1 AS batch, event_id, meter_id, ts, kwh, voltage FROM readings
                UNION ALL SELECT 2, event_id, meter_id, ts, kwh + 1, voltage FROM readings
                WHERE event_id % 10 = 0),
            kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meter_id,
                date_trunc('second', ts) ORDER BY batch DESC, event_id DESC) AS n FROM written)
                WHERE n = 1)""",
            """SELECT meter_id, ts, kwh,
                CASE WHEN k IS NULL THEN -1
                     WHEN CASE WHEN k = 0 THEN kwh <> 0 ELSE abs((kwh - k) / k) > 0.5::DOUBLE END THEN 5
                     WHEN CASE WHEN v = 0 THEN voltage <> 0
                               ELSE abs((voltage - v) / v) > 0.1::DOUBLE END THEN 5
                     ELSE 0 END AS anomaly_code
               FROM (SELECT *, lag(kwh) OVER w AS k, lag(voltage) OVER w AS v FROM kept
                     WINDOW w AS (PARTITION BY meter_id ORDER BY ts))""",
        ),
        "store_meter_range": _with(
            MERGED,
            f"""SELECT meter_id, ts, kwh, voltage, amps AS current FROM merged
                WHERE meter_id = 'METER-0007' AND ts >= {s0} AND ts < {s1}""",
        ),
        "store_time_range": _with(
            MERGED,
            f"""SELECT meter_id, ts, kwh, voltage, amps AS current FROM merged
                WHERE ts > {t0} AND ts < {t1}""",
        ),
        "meter_range_scan": _with(
            READINGS,
            f"{scan} readings WHERE meter_id = 'METER-0007' AND ts >= {s0} AND ts < {s1}",
        ),
        "time_range_scan": _with(READINGS, f"{scan} readings WHERE ts > {t0} AND ts < {t1}"),
        "kafka_rows": _with(
            METRICS,
            f"""SELECT collector_id AS message_key,
                {_long('sum(count) OVER (PARTITION BY window_start, window_end, shard_id, collector_id)')}
                  AS total_count, {METRIC_TABLE} FROM metrics""",
        ),
        "map_envelopes": _with(
            METRICS,
            f"""SELECT
                {_long('sum(count) OVER (PARTITION BY window_start, window_end, shard_id, collector_id)')}
                  AS total_count, {METRIC_TABLE} FROM metrics""",
        ),
        "flat_metrics": _with(METRICS, f"SELECT {FLAT} FROM metrics"),
        "metrics_roundtrip": _with(METRICS, f"SELECT {FLAT} FROM metrics"),
        "dataset_info": _with(WINDOWS, "SELECT count(*) AS total_records FROM windows"),
        "validate_codes": _with(
            READINGS,
            "SELECT event_id, meter_id, error_code, error_code = 0 AS is_valid FROM checked",
        ),
        "power_check": _with(
            READINGS,
            "SELECT event_id, power AS calculated_power, diff AS power_diff, tol AS tolerance FROM checked",
        ),
        "valid_readings": _with(READINGS, f"{scan} valid"),
        "rejected_readings": _with(
            READINGS,
            f"""SELECT {READING_COLUMNS}, error_code,
                'validation error [' || error_code || ']: ' || {MESSAGE.format('error_code')}
                  AS error_text
                FROM checked WHERE error_code <> 0""",
        ),
        "error_messages": _with(
            READINGS,
            f"SELECT event_id, error_code, {MESSAGE.format('error_code')} AS error_message FROM checked",
        ),
        "meter_ids": """SELECT printf('METER-%04d', user_id) AS meter_id, count(*) AS readings,
            user_id AS meter_index FROM events GROUP BY user_id""",
        "shard_assignment": _with(
            READINGS,
            "SELECT meter_id, shard_id, collector_id, count(*) AS readings FROM readings GROUP BY ALL",
        ),
        "shard_ranges": _with(
            READINGS,
            """SELECT shard_id, shard_id * per_shard AS range_start,
                least((shard_id + 1) * per_shard, total) AS range_end,
                min(meter_index) AS lowest_meter, max(meter_index) AS highest_meter,
                count(*) AS readings
                FROM readings, per GROUP BY shard_id, per_shard, total""",
        ),
        "meter_slice": _with(
            READINGS,
            "SELECT event_id, meter_id, kwh FROM readings WHERE meter_index >= 0 AND meter_index < 40",
        ),
        "meter_lookup": _with(READINGS, f"{scan} readings WHERE meter_id = 'METER-0007'"),
        "load_bands": """
            SELECT event_id, load_band, load_factor, value / load_factor AS normal_kwh FROM (
              SELECT event_id, value,
                CASE WHEN hour(ts) BETWEEN 6 AND 8 THEN 'morning'
                     WHEN hour(ts) BETWEEN 18 AND 21 THEN 'evening'
                     WHEN hour(ts) < 6 THEN 'night' ELSE 'day' END AS load_band,
                CAST(CASE WHEN hour(ts) BETWEEN 6 AND 8 THEN 1.3
                     WHEN hour(ts) BETWEEN 18 AND 21 THEN 1.5
                     WHEN hour(ts) < 6 THEN 0.6 ELSE 1.0 END AS DOUBLE) AS load_factor
              FROM events)""",
        "derived_current": _with(
            READINGS,
            """SELECT event_id, CASE WHEN event_id % 5 = 0
                 THEN kwh * CAST(1000 AS DOUBLE) / voltage ELSE amps END AS "current"
               FROM readings""",
        ),
        "time_roundtrip": """SELECT event_id, epoch_us(ts) AS micros, ts AS from_micros,
            strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS rfc3339, ts AS from_rfc3339 FROM events""",
        "parse_envelopes": _with(
            WINDOWS,
            f"""SELECT CASE WHEN (epoch_us(window_start) // 86400000000) % 7 < 6
                  THEN 'dead letter' ELSE 'parsed' END AS outcome, collector_id,
                count(*) AS messages,
                {_long('''sum(CASE WHEN (epoch_us(window_start) // 86400000000) % 7 < 6
                  THEN 0 ELSE total_count END)''')} AS readings,
                {_long('''sum(CASE WHEN (epoch_us(window_start) // 86400000000) % 7 < 6
                  THEN 0 ELSE num_meters END)''')} AS metrics
                FROM windows GROUP BY ALL""",
        ),
        "default_rows": _with(
            WINDOWS,
            """SELECT window_start, shard_id,
                 CASE WHEN turn = 3 THEN TIMESTAMP '2024-02-01' ELSE window_end END AS window_end,
                 CASE WHEN turn = 0 THEN '?' ELSE collector_id END AS collector_id,
                 CASE WHEN turn = 1 THEN 0 ELSE total_count END AS total_count,
                 CASE WHEN turn = 2 THEN 0 ELSE num_meters END AS num_meters
               FROM (SELECT *, (epoch_us(window_start) // 86400000000 + shard_id) % 4 AS turn FROM windows)""",
        ),
        "map_dead_letters": _with(
            WINDOWS,
            """SELECT CASE WHEN (epoch_us(window_start) // 86400000000) % 7 < 6
                  THEN 'dead letter' ELSE 'parsed' END AS outcome, count(*) AS messages
               FROM windows GROUP BY ALL""",
        ),
        "split_envelopes": _with(
            METRICS,
            f"""SELECT window_start, window_end, shard_id, collector_id,
                CAST((n - 1) // 5 AS INTEGER) AS part, {_long('sum(count)')} AS total_count,
                CAST(count(*) AS INTEGER) AS num_meters
                FROM (SELECT *, row_number() OVER (PARTITION BY window_start, window_end, shard_id,
                        collector_id ORDER BY meter_id) AS n FROM metrics) GROUP BY ALL""",
        ),
        "nested_envelopes": _with(
            METRICS,
            f"""SELECT window_start, window_end, shard_id, collector_id, 0 AS part,
                {_long('sum(count)')} AS total_count, count(*) AS num_meters,
                string_agg(meter_id, ',' ORDER BY meter_id) AS meters
                FROM metrics GROUP BY ALL""",
        ),
        "explode_metrics": _with(
            METRICS,
            f"""SELECT
                {_long('sum(count) OVER (PARTITION BY window_start, window_end, shard_id, collector_id)')}
                  AS total_count, {METRIC_TABLE} FROM metrics""",
        ),
        "envelope_totals": _with(
            METRICS,
            f"""SELECT window_start, window_end, shard_id, collector_id,
                {_long('sum(count)')} AS total_count,
                round_even(sum(sum_kwh ORDER BY meter_id) * {MICRO}, 0) / {MICRO} AS total_kwh,
                count(*) AS num_meters FROM metrics GROUP BY ALL""",
        ),
        "envelope_summary": _with(
            METRICS,
            f"""SELECT window_start, window_end, shard_id, collector_id,
                {_long('sum(count)')} AS received_count, count(*) AS meters_count,
                round_even(sum(sum_kwh ORDER BY meter_id) * {MICRO}, 0) / {MICRO} AS total_kwh,
                round_even(sum(avg_kwh ORDER BY meter_id) / count(*) * {MICRO}, 0) / {MICRO}
                  AS mean_of_avg_kwh
                FROM metrics GROUP BY ALL""",
        ),
        "tumbling_time": _with(METRICS, f"SELECT {METRIC_TABLE} FROM metrics"),
        "tumbling_count": _with(
            COUNTED,
            f"""SELECT window_start, window_end, window_seq, shard_id, collector_id, meter_id,
                {MEASURES} FROM ranked JOIN bounds USING (shard_id, window_seq) GROUP BY ALL""",
        ),
        "tumbling_hybrid": _with(HYBRID, "SELECT * FROM hybrid"),
        "contiguous_windows": _with(
            HYBRID,
            f"""SELECT coalesce(lag(window_end) OVER (PARTITION BY shard_id, collector_id
                    ORDER BY window_end, window_start, window_seq), window_start) AS window_start,
                  window_end, window_seq, shard_id, collector_id, total_count, total_kwh, num_meters
                FROM (SELECT window_start, window_end, window_seq, shard_id, collector_id,
                  {_long('sum(count)')} AS total_count, {_sum('sum_kwh')} AS total_kwh,
                  count(*) AS num_meters FROM hybrid GROUP BY ALL)""",
        ),
        "anomalies": _with(
            READINGS,
            """SELECT event_id, meter_id,
                CASE WHEN k IS NULL THEN -1
                     WHEN CASE WHEN k = 0 THEN kwh <> 0 ELSE abs((kwh - k) / k) > 0.5::DOUBLE END THEN 5
                     WHEN CASE WHEN v = 0 THEN voltage <> 0
                               ELSE abs((voltage - v) / v) > 0.1::DOUBLE END THEN 5
                     ELSE 0 END AS anomaly_code
               FROM (SELECT *, lag(kwh) OVER w AS k, lag(voltage) OVER w AS v FROM readings
                     WINDOW w AS (PARTITION BY meter_id ORDER BY ts, event_id))""",
        ),
        "latest_n": _with(WINDOWS, "SELECT * FROM latest"),
        "sliding_analysis": _with(
            READINGS,
            f"""SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
                count(*) AS count, {_sum('kwh')} AS sum_kwh, {_sum('kwh')} / count(*) AS avg_kwh,
                min(kwh) AS min_kwh, max(kwh) AS max_kwh,
                count(DISTINCT meter_id) AS active_meters
                FROM (SELECT *, unnest(range(0, 10)) AS k, time_bucket(INTERVAL 30 SECOND, ts, {ORIGIN})
                        - k * INTERVAL 30 SECOND AS window_start FROM valid)
                GROUP BY window_start""",
        ),
        "meter_metrics": _with(
            READINGS, f"SELECT meter_id, {MEASURES} FROM valid GROUP BY meter_id"
        ),
        "merge_meter_metrics": _with(
            f"{METRICS}, keyed AS (SELECT * FROM metrics)", _merged("meter_id")
        ),
        "energy_report": _with(
            f"{WINDOWS}, keyed AS (SELECT * FROM metrics), merged AS ({_merged('meter_id')})",
            f"""SELECT (SELECT count(*) FROM windows) AS windows, {REPORT},
                sum(count) / (SELECT {SPAN.format('min(window_start)', 'max(window_end)')}
                  FROM windows) AS readings_per_sec
                FROM merged""",
        ),
        "flat_summary": _with(
            METRICS,
            f"""SELECT count(*) AS total_rows, count(DISTINCT collector_id) AS collectors,
                count(DISTINCT meter_id) AS meters, {_sum('sum_kwh')} AS total_kwh,
                {_mean('avg_kwh')} AS mean_of_avg_kwh, {_mean('avg_voltage')} AS mean_of_avg_voltage,
                {_mean('avg_current')} AS mean_of_avg_current,
                min(min_kwh) AS min_kwh, max(max_kwh) AS max_kwh FROM metrics""",
        ),
        "by_collector": _with(
            METRICS,
            f"""SELECT collector_id, {_sum('sum_kwh')} AS sum_kwh, {_long('sum(count)')} AS count,
                count(DISTINCT meter_id) AS meters FROM metrics GROUP BY collector_id""",
        ),
        "dashboard_kpis": _with(
            WINDOWS,
            f"""SELECT {_long('sum(total_count)')} AS total_readings,
                (SELECT count(DISTINCT meter_id) FROM metrics) AS active_meters,
                (SELECT {_sum('total_kwh')} FROM latest) AS retained_kwh,
                {_sum('total_kwh')} AS total_kwh,
                sum(total_count) / ((epoch_us(max(window_end))
                  - (SELECT epoch_us(min(window_end)) FROM latest)) / {MICRO}) AS readings_per_sec,
                count(*) AS windows_received,
                (SELECT count(*) FROM latest) AS retained_points,
                max(window_end) AS last_update FROM windows""",
        ),
        "collector_stats": _with(
            WINDOWS,
            f"""SELECT collector_id, count(*) AS windows, {_long('sum(total_count)')} AS readings,
                {_sum('total_kwh')} AS total_kwh FROM windows GROUP BY collector_id""",
        ),
        "meter_table": _with(METRICS, _METER_TABLE),
        "top_meters": _with(
            METRICS, f"{_METER_TABLE} ORDER BY {_sum('sum_kwh')} DESC, meter_id LIMIT 10"
        ),
        "reading_rate": _with(
            WINDOWS,
            f"""SELECT collector_id, {_long('sum(total_count)')} AS readings, count(*) AS windows
                FROM latest GROUP BY collector_id""",
        ),
        "energy_series": _with(
            WINDOWS,
            """SELECT window_end AS time, collector_id AS collector, total_count AS readings,
                total_kwh, num_meters FROM latest""",
        ),
        "meter_histogram": _with(
            f"""{METRICS},
            means AS (SELECT {_sum('sum_kwh')} / sum(count) AS x FROM metrics GROUP BY meter_id),
            edges AS (SELECT min(x) AS lo, (max(x) - min(x)) / CAST(30 AS DOUBLE) AS w FROM means)""",
            """SELECT CAST(least(floor((x - lo) / w), 29) AS INTEGER) AS bin,
                lo + CAST(least(floor((x - lo) / w), 29) AS INTEGER) * w AS lower,
                lo + (CAST(least(floor((x - lo) / w), 29) AS INTEGER) + 1) * w AS upper,
                count(*) AS count FROM means, edges GROUP BY ALL""",
        ),
        "service_stats": _with(
            WINDOWS,
            f"""SELECT count(*) AS total_windows, {_long('sum(total_count)')} AS total_readings
                FROM windows""",
        ),
        "windows_per_collector": _with(
            WINDOWS,
            "SELECT collector_id, count(*) AS windows FROM windows GROUP BY collector_id",
        ),
        "latest_window": _with(
            WINDOWS,
            """SELECT *, window_end + shard_id * INTERVAL 1 SECOND AS received_at FROM windows
               ORDER BY received_at DESC LIMIT 1""",
        ),
        "active_collectors": _with(
            WINDOWS,
            """SELECT collector_id, max_by(shard_id, window_end) AS shard_id,
                max(window_end) AS last_seen FROM windows GROUP BY collector_id
               HAVING max(window_end) >= (SELECT max(window_end) FROM windows) - INTERVAL 2 DAY""",
        ),
        "validation_counts": _with(
            READINGS,
            """SELECT collector_id, count(*) AS collected,
                count(*) FILTER (error_code = 0) AS valid,
                count(*) FILTER (error_code <> 0) AS invalid,
                count(*) FILTER (error_code = 1) AS code_1,
                count(*) FILTER (error_code = 2) AS code_2,
                count(*) FILTER (error_code = 3) AS code_3,
                count(*) FILTER (error_code = 4) AS code_4,
                count(*) FILTER (error_code = -1) AS no_input
               FROM checked GROUP BY collector_id""",
        ),
        "throughput": _with(
            WINDOWS,
            f"""SELECT total_readings, elapsed_seconds,
                total_readings / elapsed_seconds AS readings_per_sec,
                elapsed_seconds * {MICRO} / total_readings AS us_per_reading,
                (SELECT count(*) FROM windows) AS windows
                FROM (SELECT {_long('sum(count)')} AS total_readings,
                  {SPAN.format('min(first_reading)', 'max(last_reading)')} AS elapsed_seconds
                  FROM metrics)""",
        ),
        "periodic_report": _with(
            f"""{WINDOWS},
            keyed AS (SELECT *, time_bucket(INTERVAL 7 DAY, window_end, {ORIGIN}) AS interval_start
                      FROM metrics),
            merged AS ({_merged('interval_start, meter_id')}),
            ends AS (SELECT time_bucket(INTERVAL 7 DAY, window_end, {ORIGIN}) AS interval_start,
                            count(*) AS windows FROM windows GROUP BY ALL)""",
            f"""SELECT interval_start, interval_start + INTERVAL 7 DAY AS interval_end, windows,
                {_long('sum(count)')} / CAST(604800 AS DOUBLE) AS readings_per_sec,
                {REPORT} FROM merged JOIN ends USING (interval_start)
                GROUP BY interval_start, windows""",
        ),
        "distribution_stats": _with(
            READINGS,
            f"""SELECT collector_id, count(kwh) AS n, {_sum('kwh')} / count(kwh) AS mean,
                {_pop_std('kwh')} AS std, min(kwh) AS min, max(kwh) AS max,
                {_quantile('kwh', 0.5)} AS median, {_quantile('kwh', 0.95)} AS p95,
                {_quantile('kwh', 0.99)} AS p99
                FROM readings GROUP BY collector_id""",
        ),
        "compare_runs": _COMPARE,
        "comparison_range": f"SELECT {_RANGE} FROM ({_COMPARE})",
    }


_METER_TABLE = f"""SELECT meter_id,
    CAST(round(CAST({_sum('sum_kwh')} / sum(count) AS DECIMAL(18, 10)), 4) AS DOUBLE) AS avg_kwh,
    {_sum('sum_kwh')} AS total_kwh, {_long('sum(count)')} AS readings,
    min(min_kwh) AS min_kwh, max(max_kwh) AS max_kwh FROM metrics GROUP BY meter_id"""


def _side(label: str, language: str) -> str:
    std = {m: _wide_std(m) for m in _RUN_MEASURES} | {"readings_per_sec": _pop_std("readings_per_sec")}
    facts = ", ".join(f"{_sum(m)} / count({m}) AS {m}_mean, {std[m]} AS {m}_std" for m in _RUN_MEASURES)
    return f"""{label} AS (SELECT meters, count(*) AS runs, {facts}
        FROM runs WHERE event_type = '{language}' GROUP BY meters)"""


_RUN_MEASURES = ("readings_per_sec", "avg_us_per_read", "peak_mem_mb")

_SIDES = ", ".join(
    f"""a.{m}_mean AS {m}_mean_a, a.{m}_std AS {m}_std_a, b.{m}_mean AS {m}_mean_b,
        b.{m}_std AS {m}_std_b, a.{m}_mean / b.{m}_mean AS {m}_ratio"""
    for m in _RUN_MEASURES
)

_COMPARE = _with(
    f"""runs AS (SELECT event_type, value AS readings_per_sec,
          floor(CAST(100000000 AS DOUBLE) / nullif(value, 0)) / CAST(100 AS DOUBLE) AS avg_us_per_read,
          CAST(event_id % 4096 AS DOUBLE) / CAST(4 AS DOUBLE) AS peak_mem_mb,
          CAST([10, 50, 100, 250, 500, 1000][user_id % 6 + 1] AS BIGINT) AS meters FROM events),
        {_side('a', 'click')}, {_side('b', 'view')}""",
    f"SELECT meters, a.runs AS runs_a, b.runs AS runs_b, {_SIDES} FROM a JOIN b USING (meters)",
)


# Streams that have run to their end give what the batch queries give.
STREAMED = {
    "stream_envelopes": "tumbling_time",
    "stream_report": "periodic_report",
    "stream_collectors": "collector_stats",
    "stream_hybrid": "tumbling_hybrid",
    "stream_anomalies": "anomalies",
    "split_stream_envelopes": "tumbling_time",
    "stream_landing": "map_envelopes",
    "split_stream_collectors": "collector_stats",
}


_RANGE = ", ".join(
    f"{f}({m}_{c}) AS {f}_{m}_{c}"
    for m in _RUN_MEASURES
    for c in ("ratio", "mean_a", "mean_b")
    for f in ("min", "max")
)


# Windows in parts give what whole windows give.
SPLIT = {
    "split_kafka_rows": "kafka_rows",
    "split_map_envelopes": "map_envelopes",
    "split_envelope_totals": "envelope_totals",
    "split_envelope_summary": "envelope_summary",
    "split_dataset_info": "dataset_info",
    "split_service_stats": "service_stats",
    "split_anomalies": "anomalies",
    "split_hybrid": "tumbling_hybrid",
    "split_count": "tumbling_count",
}


def _streams() -> dict[str, str]:
    """Streams whose results no batch query has."""
    last = "(ts_us - low) * 4 // span"
    return {
        "split_stream_totals": _with(WINDOWS, "SELECT * FROM windows"),
        "stream_meters": _with(
            METRICS,
            f"""SELECT meter_id, {_long('sum(count)')} AS count, {_sum('sum_kwh')} AS sum_kwh,
                  min(min_kwh) AS min_kwh, max(max_kwh) AS max_kwh FROM metrics GROUP BY meter_id""",
        ),
        "stream_late": _with(
            READINGS,
            f"""SELECT event_id, meter_id, ts FROM (
                  SELECT *, max(CASE WHEN arrival < 3 THEN ts END) OVER () - INTERVAL 1 HOUR AS seen
                  FROM (SELECT valid.*, CASE WHEN event_id % 50 = 7 THEN 3 ELSE {last} END AS arrival
                        FROM (SELECT *, epoch_us(ts) AS ts_us FROM valid) valid,
                             (SELECT min(epoch_us(ts)) AS low,
                                     max(epoch_us(ts)) - min(epoch_us(ts)) + 1 AS span FROM events)))
                WHERE arrival = 3
                  AND time_bucket(INTERVAL 7 DAY, ts, {ORIGIN}) + INTERVAL 7 DAY <= date_trunc('millisecond', seen)""",
        ),
        "stream_dead_letters": _with(
            WINDOWS,
            """SELECT CASE WHEN (epoch_us(window_start) // 86400000000) % 7 < 2
                  THEN 'dead letter' ELSE 'parsed' END AS outcome, count(*) AS messages
               FROM windows GROUP BY ALL""",
        ),
        "stream_fan_out": _with(
            READINGS, "SELECT event_id, meter_id, sink FROM valid, (SELECT unnest([0, 1]) AS sink)"
        ),
    }


def statements() -> dict[str, str]:
    batch = _batch() | _streams()
    return batch | {name: batch[same] for name, same in (STREAMED | SPLIT).items()}
