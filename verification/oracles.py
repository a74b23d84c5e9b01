"""SQL for DuckDB that computes each registered query independently from the same test tables."""

from __future__ import annotations

VIEWS = """
meter_readings AS (
  SELECT l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS "timestamp",
         'M' || l_partkey AS meter_id,
         CASE WHEN l_partkey % 100 = 99 THEN 'D010' ELSE 'D00' || (l_partkey % 10) END AS district_id,
         CASE l_partkey % 3 WHEN 0 THEN 'residential' WHEN 1 THEN 'commercial' ELSE 'industrial' END AS meter_type,
         l_quantity AS kwh,
         CAST(240 + l_linenumber AS DOUBLE) AS voltage,
         CAST(1 AS DOUBLE) - l_discount AS power_factor
  FROM lineitem),
plant_output AS (
  SELECT o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS "timestamp",
         'P' || (o_custkey % 50) AS plant_id,
         CASE (o_custkey % 50) % 7 WHEN 0 THEN 'nuclear' WHEN 1 THEN 'coal' WHEN 2 THEN 'gas' WHEN 3 THEN 'hydro'
              WHEN 4 THEN 'wind' WHEN 5 THEN 'solar' ELSE 'geothermal' END AS plant_type,
         'D00' || (o_custkey % 10) AS district_id,
         CASE WHEN (o_custkey % 50) % 7 = 6 THEN CAST(0 AS DOUBLE)
              ELSE CAST(25 + o_custkey % 50 AS DOUBLE) END AS capacity_mw,
         o_totalprice / CAST(2600000 AS DOUBLE)
           * (CAST(75 + 9 * (o_custkey % 10) AS DOUBLE) / CAST(100 AS DOUBLE)) AS output_mw,
         CAST(0.5 AS DOUBLE) AS availability,
         o_totalprice / CAST(62500 AS DOUBLE) AS operating_cost
  FROM orders),
hours AS (
  SELECT "timestamp" FROM (SELECT DISTINCT "timestamp" FROM meter_readings)
  UNION ALL SELECT DISTINCT "timestamp" FROM meter_readings WHERE day("timestamp") % 11 = 0),
weather AS (
  SELECT "timestamp",
         CASE day("timestamp") % 5 WHEN 0 THEN 'clear' WHEN 1 THEN 'partly_cloudy' WHEN 2 THEN 'cloudy'
              WHEN 3 THEN 'overcast' ELSE 'rainy' END AS cloud_condition,
         CASE hour("timestamp") % 5 WHEN 0 THEN 'calm' WHEN 1 THEN 'light' WHEN 2 THEN 'moderate'
              WHEN 3 THEN 'strong' ELSE 'extreme' END AS wind_condition,
         CASE month("timestamp") % 5 WHEN 0 THEN 'drought' WHEN 1 THEN 'low' WHEN 2 THEN 'normal'
              WHEN 3 THEN 'high' ELSE 'flood' END AS precipitation_condition,
         CAST(CASE WHEN hour("timestamp") % 7 = 3 THEN NULL
              ELSE CASE day("timestamp") % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 0.7 WHEN 2 THEN 0.3 WHEN 3 THEN 0.1
              ELSE 0.05 END END AS DOUBLE) AS cloud_factor,
         CAST(CASE hour("timestamp") % 5 WHEN 1 THEN 0.3 WHEN 2 THEN 0.7 WHEN 3 THEN 1.0 ELSE 0.0 END AS DOUBLE)
           AS wind_factor,
         CAST(CASE month("timestamp") % 5 WHEN 0 THEN 0.4 WHEN 1 THEN 0.7 WHEN 2 THEN 1.0 WHEN 3 THEN 1.1
              ELSE 0.8 END AS DOUBLE) AS precipitation_factor,
         CAST(20 + hour("timestamp") AS DOUBLE) AS temperature_c,
         CAST(day("timestamp") AS DOUBLE) AS wind_speed_ms,
         CAST(50 + day("timestamp") AS DOUBLE) AS humidity_pct
  FROM hours),
plants AS (
  SELECT 'P' || n AS plant_id, 'P' || n || ' ' || plant_type AS plant_name, plant_type, 'D00' || (n % 10) AS district_id,
         CASE WHEN n % 7 = 6 THEN CAST(0 AS DOUBLE) ELSE CAST(25 + n AS DOUBLE) END AS capacity_mw,
         CAST(80 + 2 * (n % 10) AS DOUBLE) / CAST(100 AS DOUBLE) AS efficiency,
         CAST(CASE plant_type WHEN 'nuclear' THEN 30 WHEN 'coal' THEN 40 WHEN 'gas' THEN 50 WHEN 'hydro' THEN 10
                   WHEN 'wind' THEN 5 WHEN 'solar' THEN 3 ELSE 20 END AS DOUBLE) AS operating_cost,
         CAST(40 AS DOUBLE) AS latitude, CAST(-100 AS DOUBLE) AS longitude
  FROM (SELECT n, CASE n % 7 WHEN 0 THEN 'nuclear' WHEN 1 THEN 'coal' WHEN 2 THEN 'gas' WHEN 3 THEN 'hydro'
                  WHEN 4 THEN 'wind' WHEN 5 THEN 'solar' ELSE 'geothermal' END AS plant_type
        FROM (SELECT DISTINCT c_custkey % 50 AS n FROM customer))),
meters AS (
  SELECT 'M' || p_partkey AS meter_id,
         CASE WHEN p_partkey % 100 = 99 THEN 'D010' ELSE 'D00' || (p_partkey % 10) END AS district_id,
         CASE p_partkey % 3 WHEN 0 THEN 'residential' WHEN 1 THEN 'commercial' ELSE 'industrial' END AS meter_type,
         CAST(CASE p_partkey % 3 WHEN 0 THEN 1.5 WHEN 1 THEN 5.0 ELSE 25.0 END AS DOUBLE) AS base_consumption,
         FALSE AS is_fraud, 'M' || p_partkey || ' street' AS address
  FROM part),
districts AS (
  SELECT district_id, 'City ' || district_id AS district_name,
         CASE CAST(substr(district_id, 2) AS INTEGER) % 4 WHEN 0 THEN 'industrial' WHEN 1 THEN 'commercial'
              WHEN 2 THEN 'residential' ELSE 'mixed' END AS district_type,
         CAST(CASE CAST(substr(district_id, 2) AS INTEGER) % 4 WHEN 0 THEN 2.5 WHEN 1 THEN 1.5 WHEN 2 THEN 1.0
              ELSE 1.3 END AS DOUBLE) AS base_demand_factor,
         CAST(CASE CAST(substr(district_id, 2) AS INTEGER) % 4 WHEN 0 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS INTEGER)
           AS peak_shift,
         CAST(count(*) AS INTEGER) AS num_meters
  FROM meters GROUP BY district_id)"""

ENRICHED = """
enriched AS (
  SELECT p.*, coalesce(w.cloud_factor, CAST(0.7 AS DOUBLE)) AS cloud_factor,
         coalesce(w.wind_factor, CAST(0.5 AS DOUBLE)) AS wind_factor,
         coalesce(w.precipitation_factor, CAST(1.0 AS DOUBLE)) AS precipitation_factor
  FROM plant_output p LEFT JOIN weather w ON p."timestamp" = w."timestamp")"""

BALANCE = f"""{ENRICHED},
demand AS (SELECT district_id, sum(kwh) / CAST(1000 AS DOUBLE) AS demand_mwh FROM meter_readings GROUP BY 1),
supply AS (SELECT district_id, sum(output_mw) AS supply_mw FROM enriched GROUP BY 1),
net AS (
  SELECT district_id, demand_mwh, supply_mw, supply_mw - demand_mwh AS net_load_mw,
         CASE WHEN supply_mw > 0 THEN (supply_mw - demand_mwh) / supply_mw ELSE CAST(-1 AS DOUBLE) END AS balance_ratio
  FROM demand JOIN supply USING (district_id)),
balance AS (
  SELECT *, CASE WHEN balance_ratio < -0.15 THEN 'CRITICAL' WHEN balance_ratio < -0.05 THEN 'WARNING'
                 WHEN balance_ratio >= 0 AND balance_ratio <= 0.20 THEN 'NORMAL'
                 WHEN balance_ratio > 0.30 THEN 'EXCESS' ELSE 'OK' END AS status
  FROM net)"""

STATS = """
totals AS (
  SELECT meter_id, min(district_id) AS district_id, sum(kwh) AS total_kwh FROM meter_readings GROUP BY meter_id),
stats AS (
  SELECT district_id,
         CASE WHEN count(*) >= 30 THEN avg(total_kwh) ELSE CAST(0 AS DOUBLE) END AS mean_kwh,
         CASE WHEN count(*) >= 30 THEN stddev_pop(total_kwh) ELSE CAST(0 AS DOUBLE) END AS stddev_kwh,
         count(*) AS meter_count, count(*) >= 30 AS valid_stats
  FROM totals GROUP BY district_id)"""

ZSCORES = f"""{STATS},
scored AS (
  SELECT meter_id, t.district_id, total_kwh, mean_kwh AS district_mean, stddev_kwh AS district_stddev,
         CASE WHEN stddev_kwh > 0 THEN (total_kwh - mean_kwh) / stddev_kwh ELSE CAST(0 AS DOUBLE) END AS zscore
  FROM totals t JOIN stats s ON t.district_id = s.district_id WHERE valid_stats),
zscores AS (
  SELECT *, CASE WHEN abs(zscore) >= 3 THEN 'FRAUD_LIKELY' WHEN abs(zscore) >= 2.5 THEN 'SUSPICIOUS'
                 WHEN abs(zscore) >= 2 THEN 'MONITOR' ELSE 'NORMAL' END AS status,
         CASE WHEN zscore < -3 THEN 'UNDER_REPORTING' WHEN zscore > 3 THEN 'OVER_REPORTING' ELSE 'NONE' END
           AS fraud_type
  FROM scored)"""

EMISSIONS = """
emissions AS (
  SELECT plant_type, district_id, CAST(hour("timestamp") AS INTEGER) AS hour,
         output_mw * CASE WHEN plant_type IN ('nuclear', 'hydro', 'wind', 'solar') THEN CAST(0 AS DOUBLE)
                          WHEN plant_type = 'coal' THEN CAST(1 AS DOUBLE)
                          WHEN plant_type = 'gas' THEN CAST(0.4 AS DOUBLE)
                          ELSE CAST(0.5 AS DOUBLE) END AS co2_tons
  FROM plant_output)"""

RENEWABLE = """
mix AS (
  SELECT coalesce(sum(output_mw) FILTER (plant_type IN ('solar', 'wind', 'hydro')), CAST(0 AS DOUBLE)) AS renewable_mw,
         coalesce(sum(output_mw) FILTER (plant_type NOT IN ('solar', 'wind', 'hydro')), CAST(0 AS DOUBLE))
           AS non_renewable_mw
  FROM plant_output),
share AS (
  SELECT *, renewable_mw + non_renewable_mw AS total_mw,
         CASE WHEN renewable_mw + non_renewable_mw > 0 THEN renewable_mw / (renewable_mw + non_renewable_mw) * 100
              ELSE CAST(0 AS DOUBLE) END AS renewable_percentage
  FROM mix)"""

AVAILABILITY = f"""{ENRICHED},
base AS (
  SELECT "timestamp", plant_id, plant_type, district_id, capacity_mw,
         CASE plant_type
           WHEN 'nuclear' THEN CAST(0.92 AS DOUBLE)
           WHEN 'coal' THEN CAST(0.85 AS DOUBLE)
           WHEN 'gas' THEN CAST(0.90 AS DOUBLE)
           WHEN 'hydro' THEN CAST(0.88 AS DOUBLE) * precipitation_factor
           WHEN 'wind' THEN CAST(0.35 AS DOUBLE) * wind_factor
           WHEN 'solar' THEN CASE WHEN hour("timestamp") BETWEEN 6 AND 19
                THEN exp(-CAST(power(hour("timestamp") - 12, 2) AS DOUBLE) / CAST(32 AS DOUBLE)) * cloud_factor
                ELSE CAST(0 AS DOUBLE) END
         END AS share
  FROM enriched),
available AS (
  SELECT "timestamp", plant_id, plant_type, district_id, capacity_mw,
         CASE WHEN share IS NULL THEN NULL
              ELSE least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), share)) END AS availability
  FROM base)"""

EXPECTED = f"""{AVAILABILITY},
expected AS (
  SELECT a.*, p.operating_cost AS unit_cost,
         CASE WHEN availability IS NULL THEN NULL
              ELSE greatest(CAST(0 AS DOUBLE), least(a.capacity_mw, a.capacity_mw * availability * p.efficiency))
         END AS mw
  FROM available a JOIN plants p USING (plant_id))"""

# fixed values: load by hour of day, and the factor of weekends
LOAD_SHAPES = """
shapes AS (
  SELECT * FROM (VALUES
    ('residential', [0.4, 0.3, 0.3, 0.3, 0.4, 0.6, 0.9, 1.2, 1.0, 0.7, 0.6, 0.7,
                     0.8, 0.7, 0.7, 0.8, 1.0, 1.4, 1.6, 1.5, 1.3, 1.0, 0.7, 0.5]::DOUBLE[], 1.1::DOUBLE),
    ('commercial', [0.3, 0.3, 0.3, 0.3, 0.3, 0.4, 0.6, 0.9, 1.3, 1.5, 1.5, 1.4,
                    1.3, 1.4, 1.5, 1.5, 1.4, 1.2, 0.8, 0.5, 0.4, 0.3, 0.3, 0.3]::DOUBLE[], 0.5::DOUBLE),
    ('industrial', [0.8, 0.8, 0.8, 0.8, 0.8, 0.9, 1.0, 1.2, 1.3, 1.3, 1.3, 1.2,
                    1.1, 1.2, 1.3, 1.3, 1.2, 1.1, 1.0, 0.9, 0.9, 0.8, 0.8, 0.8]::DOUBLE[], 0.7::DOUBLE)
  ) AS v(meter_type, by_hour, weekend))"""

LOAD = """by_hour[hour("timestamp") + 1] * CASE WHEN isodow("timestamp") >= 6 THEN weekend ELSE CAST(1 AS DOUBLE) END"""

BALANCE_COLUMNS = """district_id, round_even(demand_mwh, 6) AS demand_mwh, round_even(supply_mw, 6) AS supply_mw,
  round_even(net_load_mw, 6) AS net_load_mw, round_even(balance_ratio, 6) AS balance_ratio, status"""
ZSCORE_COLUMNS = """meter_id, district_id, round_even(total_kwh, 6) AS total_kwh, round_even(district_mean, 6) AS district_mean,
  round_even(district_stddev, 6) AS district_stddev, round_even(zscore, 6) AS zscore, status, fraud_type"""
STATS_COLUMNS = """district_id, round_even(mean_kwh, 6) AS mean_kwh, round_even(stddev_kwh, 6) AS stddev_kwh, meter_count,
  valid_stats"""
RISK = """
risk AS (
  SELECT count(*) FILTER (status = 'CRITICAL') AS n_critical, count(*) FILTER (status = 'WARNING') AS n_warning,
         count(*) FILTER (status = 'NORMAL') AS n_normal, count(*) FILTER (status = 'OK') AS n_ok,
         count(*) FILTER (status = 'EXCESS') AS n_excess,
         coalesce(string_agg(district_id, ', ' ORDER BY district_id) FILTER (status = 'CRITICAL'), '')
           AS critical_districts,
         round_even(coalesce(sum(net_load_mw) FILTER (net_load_mw < 0), CAST(0 AS DOUBLE)), 6) AS total_deficit_mw,
         count(*) FILTER (status = 'CRITICAL') AS districts_at_risk
  FROM balance)"""


def _sql(select: str, *ctes: str) -> str:
    return "WITH " + ",".join([VIEWS, *ctes]) + "\n" + select


def _sum_by(source: str, keys: str, value: str, name: str, *ctes: str) -> str:
    return _sql(f"SELECT {keys}, round_even(sum({value}), 6) AS {name} FROM {source} GROUP BY ALL", *ctes)


HOUR = 'CAST(hour("timestamp") AS INTEGER) AS hour'

ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_meter_readings": _sql("SELECT * FROM meter_readings"),
    "scan_plant_output": _sql("SELECT * FROM plant_output"),
    "scan_weather": _sql("SELECT * FROM weather"),
    "scan_districts": _sql("SELECT * FROM districts"),
    "scan_meters": _sql("SELECT * FROM meters"),
    "scan_plants": _sql("SELECT * FROM plants"),
    "scan_dimensions": _sql(
        """SELECT 'district' AS kind, district_id AS id, district_id, district_type AS category,
                  CAST(num_meters AS DOUBLE) AS size FROM districts
           UNION ALL SELECT 'meter', meter_id, district_id, meter_type, base_consumption FROM meters
           UNION ALL SELECT 'plant', plant_id, district_id, plant_type, capacity_mw FROM plants"""
    ),
    "sink_csv_roundtrip": _sql(
        f"SELECT district_id, {HOUR}, sum(kwh) AS total_demand_kwh FROM meter_readings GROUP BY ALL"
    ),
    "sink_parquet_roundtrip": _sql(
        f"SELECT district_id, {HOUR}, sum(kwh) AS total_demand_kwh FROM meter_readings GROUP BY ALL"
    ),
    "row_counts": _sql(
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
            for t in ("meter_readings", "plant_output", "weather", "districts", "meters", "plants")
        )
    ),
    # demand
    "project_demand_pairs": _sql("SELECT district_id, kwh FROM meter_readings"),
    "demand_by_district": _sum_by("meter_readings", "district_id", "kwh", "total_demand_kwh"),
    "demand_by_district_hour": _sum_by("meter_readings", f"district_id, {HOUR}", "kwh", "total_demand_kwh"),
    "demand_by_meter_type": _sum_by("meter_readings", "meter_type", "kwh", "total_demand_kwh"),
    "peak_demand_districts": _sql(
        """SELECT district_id, round_even(sum(kwh), 6) AS total_demand_kwh FROM meter_readings GROUP BY district_id
           ORDER BY sum(kwh) DESC, district_id LIMIT 5"""
    ),
    "demand_of_period": _sql(
        """SELECT district_id, round_even(sum(kwh), 6) AS total_demand_kwh FROM meter_readings
           WHERE "timestamp" >= TIMESTAMP '1995-03-10 05:00:00' AND "timestamp" < TIMESTAMP '1995-04-02 13:00:00'
           GROUP BY district_id"""
    ),
    # supply
    "supply_in_extreme_wind": _sql(
        """SELECT district_id, round_even(sum(output_mw), 6) AS output_mw, count(*) AS plant_hours FROM plant_output
           WHERE "timestamp" IN (SELECT "timestamp" FROM weather WHERE wind_condition = 'extreme'
                                 AND precipitation_condition = 'drought' AND day("timestamp") <= 3)
           GROUP BY district_id"""
    ),
    "project_supply_pairs": _sql("SELECT district_id, output_mw FROM plant_output"),
    "enrich_with_weather": _sql("SELECT * FROM enriched", ENRICHED),
    "supply_by_district": _sum_by("enriched", "district_id", "output_mw", "total_supply_mw", ENRICHED),
    "supply_by_plant_type": _sum_by("enriched", "plant_type", "output_mw", "total_supply_mw", ENRICHED),
    "supply_by_district_hour": _sum_by("enriched", f"district_id, {HOUR}", "output_mw", "total_supply_mw", ENRICHED),
    "capacity_utilization": _sql(
        """SELECT plant_type, round_even(sum(output_mw), 6) AS total_output_mw, round_even(sum(capacity_mw), 6) AS total_capacity_mw,
                  round_even(CASE WHEN sum(capacity_mw) > 0 THEN sum(output_mw) / sum(capacity_mw) ELSE CAST(0 AS DOUBLE) END,
                        6) AS utilization_rate
           FROM enriched GROUP BY plant_type""",
        ENRICHED,
    ),
    "operating_costs": _sum_by("enriched", "plant_type", "operating_cost", "total_operating_cost", ENRICHED),
    # balance
    "grid_balance": _sql(f"SELECT {BALANCE_COLUMNS} FROM balance", BALANCE),
    "grid_balance_hourly": _sql(
        """SELECT district_id, hour, round_even(demand_mwh, 6) AS demand_mwh, round_even(supply_mw, 6) AS supply_mw,
                  round_even(supply_mw - demand_mwh, 6) AS net_load_mw, round_even(ratio, 6) AS balance_ratio,
                  CASE WHEN ratio < -0.15 THEN 'CRITICAL' WHEN ratio < -0.05 THEN 'WARNING' ELSE 'OK' END AS status
           FROM hourly""",
        ENRICHED,
        f"""
hourly_demand AS (
  SELECT district_id, {HOUR}, sum(kwh) / CAST(1000 AS DOUBLE) AS demand_mwh FROM meter_readings GROUP BY ALL),
hourly_supply AS (SELECT district_id, {HOUR}, sum(output_mw) AS supply_mw FROM enriched GROUP BY ALL),
hourly AS (
  SELECT *, CASE WHEN supply_mw > 0 THEN (supply_mw - demand_mwh) / supply_mw ELSE CAST(-1 AS DOUBLE) END AS ratio
  FROM hourly_demand JOIN hourly_supply USING (district_id, hour))""",
    ),
    "deficit_districts": _sql(f"SELECT {BALANCE_COLUMNS} FROM balance WHERE net_load_mw < 0", BALANCE),
    "critical_districts": _sql(f"SELECT {BALANCE_COLUMNS} FROM balance WHERE status = 'CRITICAL'", BALANCE),
    "balance_status_counts": _sql("SELECT status, count(*) AS count FROM balance GROUP BY status", BALANCE),
    "blackout_risk_summary": _sql("SELECT * FROM risk", BALANCE, RISK),
    # fraud
    "meter_totals": _sql("SELECT meter_id, district_id, round_even(total_kwh, 6) AS total_kwh FROM totals", STATS),
    "district_stats": _sql(f"SELECT {STATS_COLUMNS} FROM stats", STATS),
    "valid_district_stats": _sql(f"SELECT {STATS_COLUMNS} FROM stats WHERE valid_stats", STATS),
    "meter_zscores": _sql(f"SELECT {ZSCORE_COLUMNS} FROM zscores", ZSCORES),
    "fraud_cases": _sql(
        f"SELECT {ZSCORE_COLUMNS} FROM zscores WHERE status IN ('FRAUD_LIKELY', 'SUSPICIOUS')", ZSCORES
    ),
    "top_suspicious_meters": _sql(
        f"SELECT {ZSCORE_COLUMNS} FROM (SELECT * FROM zscores ORDER BY abs(zscore) DESC, meter_id LIMIT 20)", ZSCORES
    ),
    "fraud_impact": _sql(
        """SELECT total_fraud_cases, total_meters_analyzed,
                  round_even(CASE WHEN total_meters_analyzed > 0
                        THEN CAST(total_fraud_cases AS DOUBLE) / total_meters_analyzed * 100
                        ELSE CAST(0 AS DOUBLE) END, 6) AS fraud_rate_pct,
                  round_even(stolen, 6) AS estimated_stolen_kwh,
                  round_even(stolen * CAST(0.12 AS DOUBLE), 6) AS estimated_revenue_loss
           FROM impact""",
        ZSCORES,
        """
impact AS (
  SELECT count(*) FILTER (status IN ('FRAUD_LIKELY', 'SUSPICIOUS')) AS total_fraud_cases,
         count(*) AS total_meters_analyzed,
         coalesce(sum(greatest(CAST(0 AS DOUBLE),
                               district_mean * (1 + abs(zscore) / CAST(3 AS DOUBLE)) - total_kwh))
                  FILTER (fraud_type = 'UNDER_REPORTING'), CAST(0 AS DOUBLE)) AS stolen
  FROM zscores)""",
    ),
    "fraud_status_counts": _sql("SELECT status, count(*) AS count FROM zscores GROUP BY status", ZSCORES),
    # carbon
    "project_emissions": _sql("SELECT plant_type, co2_tons FROM emissions", EMISSIONS),
    "emission_factor_join": _sql(
        """SELECT plant_type, output_mw * coalesce(factor, CAST(0.5 AS DOUBLE)) AS co2_tons
           FROM plant_output LEFT JOIN factors USING (plant_type)""",
        """
factors AS (
  SELECT * FROM (VALUES ('nuclear', 0.0::DOUBLE), ('coal', 1.0::DOUBLE), ('gas', 0.4::DOUBLE), ('hydro', 0.0::DOUBLE),
                        ('wind', 0.0::DOUBLE), ('solar', 0.0::DOUBLE)) AS v(plant_type, factor))""",
    ),
    "emissions_by_type": _sum_by("emissions", "plant_type", "co2_tons", "total_co2_tons", EMISSIONS),
    "emissions_by_district": _sum_by("emissions", "district_id", "co2_tons", "total_co2_tons", EMISSIONS),
    "emissions_by_hour": _sum_by("emissions", "hour", "co2_tons", "total_co2_tons", EMISSIONS),
    "renewable_share": _sql(
        """SELECT round_even(renewable_mw, 6) AS renewable_mw, round_even(non_renewable_mw, 6) AS non_renewable_mw,
                  round_even(total_mw, 6) AS total_mw, round_even(renewable_percentage, 6) AS renewable_percentage,
                  renewable_percentage >= 40 AS meets_target, renewable_percentage >= 20 AS meets_minimum
           FROM share""",
        RENEWABLE,
    ),
    "emission_intensity": _sql(
        """SELECT round_even(CASE WHEN (SELECT sum(output_mw) FROM enriched) > 0
                        THEN (SELECT sum(co2_tons) FROM emissions) / (SELECT sum(output_mw) FROM enriched)
                        ELSE CAST(0 AS DOUBLE) END, 6) AS emission_intensity""",
        ENRICHED,
        EMISSIONS,
    ),
    "carbon_summary": _sql(
        """SELECT round_even(tons, 6) AS total_emissions_tons, round_even(intensity, 6) AS emission_intensity,
                  CASE WHEN intensity >= 0.8 THEN 'CRITICAL' WHEN intensity >= 0.5 THEN 'WARNING'
                       WHEN intensity <= 0.2 THEN 'GREEN' ELSE 'OK' END AS emission_status,
                  round_even(renewable_mw, 6) AS renewable_mw, round_even(non_renewable_mw, 6) AS non_renewable_mw,
                  round_even(total_mw, 6) AS total_mw, round_even(renewable_percentage, 6) AS renewable_percentage,
                  renewable_percentage >= 40 AS meets_target, renewable_percentage >= 20 AS meets_minimum
           FROM (SELECT tons, CASE WHEN mw > 0 THEN tons / mw ELSE CAST(0 AS DOUBLE) END AS intensity
                 FROM (SELECT (SELECT sum(co2_tons) FROM emissions) AS tons,
                              (SELECT sum(output_mw) FROM enriched) AS mw)), share""",
        ENRICHED,
        EMISSIONS,
        RENEWABLE,
    ),
    # report frames
    "chart_demand_share": _sql(
        """SELECT upper(substr(meter_type, 1, 1)) || substr(meter_type, 2) AS meter_type,
                  round_even(sum(kwh), 6) AS total_demand_kwh,
                  round_even(100 * sum(kwh) / (SELECT sum(kwh) FROM meter_readings), 6) AS pct
           FROM meter_readings GROUP BY ALL"""
    ),
    "chart_utilization": _sql(
        """SELECT plant_type, round_even(CASE WHEN sum(capacity_mw) > 0 THEN sum(output_mw) / sum(capacity_mw) * 100
                                    ELSE CAST(0 AS DOUBLE) END, 6) AS utilization_pct
           FROM enriched GROUP BY plant_type""",
        ENRICHED,
    ),
    "chart_grid_balance": _sql("SELECT district_id, round_even(net_load_mw, 6) AS net_load_mw, status FROM balance", BALANCE),
    "zscore_histogram": _sql(
        """SELECT CAST(i AS INTEGER) AS bin, round_even(edge_lo, 6) AS bin_lo, round_even(edge_hi, 6) AS bin_hi,
                  (SELECT count(*) FROM clipped
                   WHERE z >= edge_lo AND (z < edge_hi OR (i = 49 AND z <= edge_hi))) AS count
           FROM edges""",
        ZSCORES,
        """
clipped AS (
  SELECT least(greatest(zscore, CAST(-5 AS DOUBLE)), CAST(5 AS DOUBLE)) AS z FROM zscores WHERE zscore IS NOT NULL),
ends AS (
  SELECT CASE WHEN min(z) = max(z) THEN min(z) - 0.5 ELSE coalesce(min(z), CAST(0 AS DOUBLE)) END AS lo,
         CASE WHEN min(z) = max(z) THEN max(z) + 0.5 ELSE coalesce(max(z), CAST(1 AS DOUBLE)) END AS hi
  FROM clipped),
edges AS (
  SELECT i, lo + i * ((hi - lo) / CAST(50 AS DOUBLE)) AS edge_lo,
         CASE WHEN i = 49 THEN hi ELSE lo + (i + 1) * ((hi - lo) / CAST(50 AS DOUBLE)) END AS edge_hi
  FROM range(50) AS r(i), ends)""",
    ),
    "chart_emission_share": _sql(
        """SELECT plant_type, round_even(tons, 6) AS total_co2_tons, round_even(100 * tons / sum(tons) OVER (), 6) AS pct
           FROM (SELECT plant_type, sum(co2_tons) AS tons FROM emissions GROUP BY plant_type) WHERE tons > 0""",
        EMISSIONS,
    ),
    "chart_renewable_mix": _sql(
        """SELECT source, round_even(mw, 6) AS mw,
                  round_even(CASE WHEN total_mw > 0 THEN 100 * mw / total_mw ELSE CAST(0 AS DOUBLE) END, 6) AS pct
           FROM (SELECT 'Renewable' AS source, renewable_mw AS mw, total_mw FROM share
                 UNION ALL SELECT 'Non-Renewable', non_renewable_mw, total_mw FROM share)""",
        RENEWABLE,
    ),
    "dash_demand_summary": _sql(
        """SELECT 'Total Demand' AS metric, round_even(sum(kwh), 6) AS value FROM meter_readings
           UNION ALL SELECT 'Districts Monitored', CAST(count(DISTINCT district_id) AS DOUBLE) FROM meter_readings
           UNION ALL SELECT upper(substr(meter_type, 1, 1)) || substr(meter_type, 2), round_even(sum(kwh), 6)
                     FROM meter_readings GROUP BY meter_type"""
    ),
    "dash_supply_summary": _sql(
        """SELECT upper(substr(plant_type, 1, 1)) || substr(plant_type, 2) AS plant_type,
                  round_even(sum(output_mw), 6) AS total_output_mw,
                  round_even(CASE WHEN sum(capacity_mw) > 0 THEN sum(output_mw) / sum(capacity_mw) ELSE CAST(0 AS DOUBLE) END,
                        6) AS utilization_rate
           FROM enriched GROUP BY 1
           UNION ALL SELECT 'Total', round_even(sum(output_mw), 6), CAST(NULL AS DOUBLE) FROM enriched""",
        ENRICHED,
    ),
    "dash_grid_alerts": _sql(
        "SELECT critical_districts, total_deficit_mw, districts_at_risk FROM risk WHERE districts_at_risk > 0",
        BALANCE,
        RISK,
    ),
    # weather, availability and load
    "hourly_spine": _sql(
        """SELECT id, strftime("timestamp", '%Y-%m') AS month, count(*) AS hours, min("timestamp") AS first_hour, max("timestamp") AS last_hour
           FROM (SELECT plant_id AS id, unnest(generate_series(min("timestamp"), max("timestamp"), INTERVAL 1 HOUR)) AS "timestamp"
                 FROM plant_output GROUP BY plant_id)
           GROUP BY ALL"""
    ),
    "reporting_gaps": _sql(
        """SELECT plant_id AS id, before AS last_hour, "timestamp" AS next_hour,
                  CAST(date_diff('hour', before, "timestamp") - 1 AS BIGINT) AS missing_hours
           FROM (SELECT plant_id, "timestamp", lag("timestamp") OVER (PARTITION BY plant_id ORDER BY "timestamp") AS before
                 FROM (SELECT DISTINCT plant_id, "timestamp" FROM plant_output))
           WHERE date_diff('hour', before, "timestamp") > 1"""
    ),
    "weather_factors": _sql(
        """SELECT "timestamp",
                  CAST(CASE cloud_condition WHEN 'clear' THEN 1.0 WHEN 'partly_cloudy' THEN 0.7 WHEN 'cloudy' THEN 0.3
                       WHEN 'overcast' THEN 0.1 WHEN 'rainy' THEN 0.05 END AS DOUBLE) AS cloud_factor,
                  CAST(CASE wind_condition WHEN 'calm' THEN 0.0 WHEN 'light' THEN 0.3 WHEN 'moderate' THEN 0.7
                       WHEN 'strong' THEN 1.0 WHEN 'extreme' THEN 0.0 END AS DOUBLE) AS wind_factor,
                  CAST(CASE precipitation_condition WHEN 'drought' THEN 0.4 WHEN 'low' THEN 0.7 WHEN 'normal' THEN 1.0
                       WHEN 'high' THEN 1.1 WHEN 'flood' THEN 0.8 END AS DOUBLE) AS precipitation_factor
           FROM weather"""
    ),
    "wind_band": _sql(
        """SELECT wind_speed_ms,
                  CASE WHEN wind_speed_ms < 3 THEN 'calm' WHEN wind_speed_ms < 6 THEN 'light'
                       WHEN wind_speed_ms < 12 THEN 'moderate' WHEN wind_speed_ms <= 25 THEN 'strong'
                       ELSE 'extreme' END AS wind_condition,
                  CAST(CASE WHEN wind_speed_ms < 3 THEN 0.0 WHEN wind_speed_ms < 6 THEN 0.3
                            WHEN wind_speed_ms < 12 THEN 0.7 WHEN wind_speed_ms <= 25 THEN 1.0
                            ELSE 0.0 END AS DOUBLE) AS wind_factor
           FROM weather"""
    ),
    "plant_availability": _sql(
        """SELECT "timestamp", plant_id, plant_type, district_id, round_even(capacity_mw, 6) AS capacity_mw,
                  round_even(availability, 6) AS availability
           FROM available""",
        AVAILABILITY,
    ),
    "expected_output": _sql(
        """SELECT "timestamp", plant_id, plant_type, district_id, capacity_mw, round_even(availability, 3) AS availability,
                  round_even(mw, 2) AS output_mw, round_even(mw * unit_cost, 2) AS operating_cost
           FROM expected""",
        EXPECTED,
    ),
    "weather_adjusted_supply": _sum_by("expected", "district_id", "round_even(mw, 2)", "total_supply_mw", EXPECTED),
    "load_factor": _sql(
        f'SELECT "timestamp", meter_type, {LOAD} AS load_factor FROM meter_readings JOIN shapes USING (meter_type)',
        LOAD_SHAPES,
    ),
    "expected_consumption": _sql(
        f"""SELECT "timestamp", meter_id, kwh,
                   round_even(greatest(CAST(0.01 AS DOUBLE), base_consumption * ({LOAD})), 4) AS expected_kwh
            FROM meter_readings JOIN (SELECT meter_id, base_consumption FROM meters) USING (meter_id)
                 JOIN shapes USING (meter_type)""",
        LOAD_SHAPES,
    ),
    "weather_condition_distribution": _sql(
        """SELECT kind, condition, count(w."timestamp") AS hours,
                  round_even(100 * CAST(count(w."timestamp") AS DOUBLE) / (SELECT count(*) FROM weather), 6) AS pct
           FROM (VALUES ('cloud', 'clear'), ('cloud', 'partly_cloudy'), ('cloud', 'cloudy'), ('cloud', 'overcast'),
                        ('cloud', 'rainy'), ('wind', 'calm'), ('wind', 'light'), ('wind', 'moderate'),
                        ('wind', 'strong'), ('wind', 'extreme')) AS known(kind, condition)
           LEFT JOIN weather w ON known.condition = CASE kind WHEN 'cloud' THEN cloud_condition ELSE wind_condition END
           GROUP BY kind, condition"""
    ),
    "plant_summary_by_type": _sql(
        """SELECT plant_type, count(*) AS count, round_even(sum(capacity_mw), 6) AS total_capacity
           FROM plants GROUP BY plant_type"""
    ),
    "generation_by_class": _sql(
        """SELECT CASE WHEN plant_type IN ('solar', 'wind', 'hydro') THEN 'renewable' ELSE 'non_renewable' END
                    AS energy_class, round_even(sum(output_mw), 6) AS total_output_mw
           FROM plant_output GROUP BY 1"""
    ),
    "malformed_row_counts": _sql(
        """SELECT 'meter_readings' AS table_name, count(*) AS row_count, count(*) FILTER (l_partkey % 10 = 3)
                    AS malformed_rows FROM lineitem"""
    ),
    "split_damaged_rows": _sql(
        """SELECT 'whole' AS kind, count(*) AS row_count, round_even(sum(kwh), 6) AS kwh FROM meter_readings WHERE meter_id NOT LIKE '%3'
           UNION ALL SELECT 'damaged', count(*), CAST(0 AS DOUBLE) FROM meter_readings WHERE meter_id LIKE '%3'"""
    ),
    # everything
    "full_run_row_counts": _sql(
        """SELECT 'total_demand' AS table_name, count(DISTINCT district_id) AS row_count FROM meter_readings
           UNION ALL SELECT 'hourly_demand', count(*) FROM (SELECT DISTINCT district_id, hour("timestamp") FROM meter_readings)
           UNION ALL SELECT 'type_demand', count(DISTINCT meter_type) FROM meter_readings
           UNION ALL SELECT 'total_supply', count(DISTINCT district_id) FROM plant_output
           UNION ALL SELECT 'type_supply', count(DISTINCT plant_type) FROM plant_output
           UNION ALL SELECT 'hourly_supply', count(*) FROM (SELECT DISTINCT district_id, hour("timestamp") FROM plant_output)
           UNION ALL SELECT 'utilization', count(DISTINCT plant_type) FROM plant_output
           UNION ALL SELECT 'costs', count(DISTINCT plant_type) FROM plant_output
           UNION ALL SELECT 'grid_balance', count(*) FROM balance
           UNION ALL SELECT 'hourly_balance', count(*) FROM (
             SELECT DISTINCT district_id, hour("timestamp") FROM meter_readings
             INTERSECT SELECT district_id, hour("timestamp") FROM plant_output)
           UNION ALL SELECT 'district_stats', count(*) FROM stats
           UNION ALL SELECT 'meter_zscores', count(*) FROM zscores
           UNION ALL SELECT 'fraud_cases', count(*) FROM zscores WHERE status IN ('FRAUD_LIKELY', 'SUSPICIOUS')
           UNION ALL SELECT 'emissions_by_type', count(DISTINCT plant_type) FROM plant_output
           UNION ALL SELECT 'emissions_by_district', count(DISTINCT district_id) FROM plant_output
           UNION ALL SELECT 'emissions_hourly', count(DISTINCT hour("timestamp")) FROM plant_output""",
        BALANCE,
        ZSCORES,
    ),
}

# rankings: the same rows as what they order
ORACLES |= {
    "chart_demand_ranking": ORACLES["demand_by_district"],
    "chart_supply_ranking": ORACLES["supply_by_plant_type"],
    "chart_emission_profile": ORACLES["emissions_by_hour"],
}
# the same results by another way
ORACLES |= {
    "meter_totals_by_bucket": ORACLES["meter_totals"],
    "district_stats_by_year": ORACLES["district_stats"],
    "enrich_hot_hours": ORACLES["enrich_with_weather"],
    "reporting_gaps_by_month": ORACLES["reporting_gaps"],
    "published_row_counts": f"SELECT table_name AS name, row_count AS rows FROM ({ORACLES['full_run_row_counts']})",
}
# the saved results of a full run, and its summaries
FULL_RUN = {
    "total_demand": "demand_by_district",
    "hourly_demand": "demand_by_district_hour",
    "type_demand": "demand_by_meter_type",
    "total_supply": "supply_by_district",
    "type_supply": "supply_by_plant_type",
    "hourly_supply": "supply_by_district_hour",
    "utilization": "capacity_utilization",
    "costs": "operating_costs",
    "grid_balance": "grid_balance",
    "hourly_balance": "grid_balance_hourly",
    "district_stats": "district_stats",
    "meter_zscores": "meter_zscores",
    "fraud_cases": "fraud_cases",
    "emissions_by_type": "emissions_by_type",
    "emissions_by_district": "emissions_by_district",
    "emissions_hourly": "emissions_by_hour",
    "blackout_risk": "blackout_risk_summary",
    "fraud_impact": "fraud_impact",
    "carbon_summary": "carbon_summary",
}
ORACLES |= {f"full_run_{name}": ORACLES[query] for name, query in FULL_RUN.items()}
