"""ANSI SQL of the registered queries, for DuckDB over the same tables.

Written from the table contracts, apart from the DataFrame code. Each oracle is
one statement: the common table expressions it needs, then its final select.
"""

from __future__ import annotations

from agroweather.plans.catalog import CHECKS, ModelChecks, with_rules
from agroweather.proxies import queries as q


def _fips(key: str) -> str:
    return (
        f"LPAD(to_base(1 + {key} // 1000, 36), 2, '0')"
        f" || LPAD(CAST({key} % 1000 AS VARCHAR), 3, '0')"
    )


def _strings(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


MEASURES = (
    "temperature_2m_max, temperature_2m_min, temperature_2m_mean, precipitation_sum, "
    "et0_fao_evapotranspiration, shortwave_radiation_sum, windspeed_10m_max"
)
NEWEST_FIRST = "_ingested_at DESC NULLS LAST, " + ", ".join(
    f"{name} DESC NULLS LAST" for name in MEASURES.split(", ")
)
RAW_YIELD_COLUMNS = (
    "state_alpha, state_fips_code, county_code, county_name, commodity_desc, "
    "statisticcat_desc, agg_level_desc, short_desc, unit_desc, year, value_raw"
)
STAGED_COLUMNS = (
    "fips, date, temperature_2m_max, temperature_2m_min, temperature_2m_mean, precipitation_sum, "
    "et0_fao_evapotranspiration, solar_radiation_mjm2, wind_speed_kmh, _ingested_at"
)

# Common table expressions in dependency order.
CTES = {
    "raw_weather": f"""
        SELECT {_fips('l_suppkey')} AS fips,
               CAST(37.0 + (l_suppkey % 96) / 8.0 AS DOUBLE) AS latitude,
               CAST(-84.0 - (l_suppkey % 160) / 8.0 AS DOUBLE) AS longitude,
               CAST(l_shipdate AS DATE) AS date,
               CASE WHEN l_linenumber = 7 AND l_orderkey % 13 = 0 THEN NULL
                    ELSE l_quantity - 5 END AS temperature_2m_max,
               l_quantity - 10 - l_linenumber AS temperature_2m_min,
               CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity - 8 END AS temperature_2m_mean,
               CAST(ROUND(l_discount * 100) AS DOUBLE) / 4 AS precipitation_sum,
               CAST(ROUND(l_tax * 100) AS DOUBLE) / 2 AS et0_fao_evapotranspiration,
               l_quantity / 2 AS shortwave_radiation_sum,
               CAST(l_linenumber * 4 AS DOUBLE) AS windspeed_10m_max,
               make_timestamp((1735689600 + l_orderkey * 8 + l_linenumber) * 1000000)
                   AS _ingested_at
        FROM lineitem""",
    "supplier_years": """
        SELECT l_suppkey, CAST(EXTRACT(YEAR FROM l_shipdate) AS BIGINT) AS year, l_returnflag,
               CAST(SUM(l_quantity) * 2 AS BIGINT) AS n
        FROM lineitem GROUP BY 1, 2, 3""",
    "raw_yields": """
        SELECT n_name AS state_alpha,
               to_base(1 + l_suppkey // 1000, 36) AS state_fips_code,
               LPAD(CAST(l_suppkey % 1000 AS VARCHAR), 3, '0') AS county_code,
               s_name AS county_name,
               CASE l_returnflag WHEN 'A' THEN 'CORN' WHEN 'N' THEN 'SOYBEANS' ELSE 'WHEAT' END
                   AS commodity_desc,
               CASE WHEN n % 17 = 0 THEN 'PRODUCTION' ELSE 'YIELD' END AS statisticcat_desc,
               'COUNTY' AS agg_level_desc,
               '' AS short_desc,
               CASE WHEN n % 13 = 0 THEN 'TONS / ACRE' ELSE 'BU / ACRE' END AS unit_desc,
               year,
               CASE WHEN n % 7 = 0 THEN ' (D)'
                    WHEN n % 11 = 0 THEN '(Z)'
                    WHEN n >= 1000 THEN CAST(n // 1000 AS VARCHAR) || ','
                                        || LPAD(CAST(n % 1000 AS VARCHAR), 3, '0')
                    ELSE CAST(n AS VARCHAR) || '.5' END AS value_raw,
               TIMESTAMP '2026-01-15 00:00:00' AS _ingested_at
        FROM supplier_years
        JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey""",
    "counties": f"""
        SELECT {_fips('s_suppkey')} AS fips, n_name AS state_alpha, s_name AS county_name,
               CAST(37.0 + (s_suppkey % 96) / 8.0 AS DOUBLE) AS lat,
               CAST(-84.0 - (s_suppkey % 160) / 8.0 AS DOUBLE) AS lon
        FROM supplier JOIN nation ON n_nationkey = s_nationkey
        WHERE s_suppkey % 10 <> 9""",
    "latest_weather": f"""
        SELECT * EXCLUDE (place) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY fips, date ORDER BY {NEWEST_FIRST}) AS place
            FROM raw_weather)
        WHERE place = 1""",
    "stg_weather": """
        SELECT fips, date, temperature_2m_max, temperature_2m_min, temperature_2m_mean,
               precipitation_sum, et0_fao_evapotranspiration,
               shortwave_radiation_sum AS solar_radiation_mjm2,
               windspeed_10m_max AS wind_speed_kmh, _ingested_at
        FROM latest_weather""",
    "stg_yields": """
        SELECT *, CASE commodity WHEN 'corn' THEN yield_value * CAST(0.0627677 AS DOUBLE)
                                 WHEN 'soybeans' THEN yield_value * CAST(0.0672511 AS DOUBLE)
                  END AS yield_value_t_ha
        FROM (
            SELECT LPAD(state_fips_code, 2, '0') || LPAD(county_code, 3, '0') AS fips,
                   LOWER(commodity_desc) AS commodity, state_alpha, year, unit_desc AS unit,
                   TRY_CAST(REPLACE(value_raw, ',', '') AS DOUBLE) AS yield_value, _ingested_at
            FROM raw_yields
            WHERE statisticcat_desc = 'YIELD' AND unit_desc = 'BU / ACRE'
              AND county_code NOT IN ('000', '998', ''))""",
    "features": """
        SELECT fips, CAST(EXTRACT(YEAR FROM date) AS BIGINT) AS year,
               SUM(CASE WHEN temperature_2m_max IS NULL OR temperature_2m_min IS NULL THEN NULL
                        ELSE GREATEST(CAST(0 AS DOUBLE),
                                      (temperature_2m_max + temperature_2m_min) / 2 - 10)
                   END) AS gdd,
               SUM(precipitation_sum) AS precip_total_mm,
               CAST(COUNT(*) FILTER (WHERE temperature_2m_max > 30) AS BIGINT)
                   AS heat_stress_days,
               CAST(COUNT(*) FILTER (WHERE precipitation_sum < 1) AS BIGINT) AS dry_days,
               SUM(et0_fao_evapotranspiration) AS et0_total_mm,
               AVG(solar_radiation_mjm2) AS radiation_mean,
               AVG(temperature_2m_max) AS tmax_mean,
               AVG(temperature_2m_min) AS tmin_mean
        FROM stg_weather
        WHERE strftime(date, '%m-%d') BETWEEN '04-01' AND '10-31'
        GROUP BY 1, 2""",
    "commodities": """
        SELECT * FROM (VALUES ('corn', 'Corn', CAST(10 AS BIGINT), CAST(56 AS BIGINT)),
                              ('soybeans', 'Soybeans', CAST(10 AS BIGINT), CAST(60 AS BIGINT)))
            AS c(commodity, display_name, gdd_base_c, bushel_weight_lb)""",
    "dates_2025": """
        SELECT CAST(day AS DATE) AS date FROM (SELECT UNNEST(generate_series(
            TIMESTAMP '2025-01-01', TIMESTAMP '2025-12-31', INTERVAL 1 DAY)) AS day)""",
    "analysis": """
        SELECT c.fips, c.state_alpha, c.county_name, y.commodity, y.year, y.yield_value,
               y.yield_value_t_ha, y.unit, f.gdd, f.precip_total_mm, f.heat_stress_days,
               f.dry_days, f.et0_total_mm, f.tmax_mean
        FROM stg_yields y
        JOIN features f ON y.fips = f.fips AND y.year = f.year
        JOIN counties c ON y.fips = c.fips""",
}

_NEEDS = {
    "raw_yields": ["supplier_years"],
    "latest_weather": ["raw_weather"],
    "stg_weather": ["latest_weather"],
    "stg_yields": ["raw_yields"],
    "features": ["stg_weather"],
    "analysis": ["stg_yields", "features", "counties"],
}


def _statement(names: list[str], final: str) -> str:
    needed: set[str] = set()
    pending = list(names)
    while pending:
        name = pending.pop()
        needed.add(name)
        pending += _NEEDS.get(name, [])
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items() if name in needed)
    return f"WITH {ctes}\n{final}" if ctes else final


def _calendar_columns(day: str) -> str:
    return (
        f"{day} AS date, CAST(EXTRACT(YEAR FROM {day}) AS BIGINT) AS year, "
        f"CAST(EXTRACT(MONTH FROM {day}) AS BIGINT) AS month, "
        f"CAST(EXTRACT(DAY FROM {day}) AS BIGINT) AS day, "
        f"CAST(EXTRACT(DOY FROM {day}) AS BIGINT) AS day_of_year, "
        f"strftime({day}, '%m-%d') BETWEEN '04-01' AND '10-31' AS is_growing_season"
    )


_NUMBERED_COUNTIES = "(SELECT *, ROW_NUMBER() OVER (ORDER BY fips, lat, lon) - 1 AS place FROM counties)"

_STAMP = f"TIMESTAMP '{q.STAMP:%Y-%m-%d %H:%M:%S}'"

_YIELD_PAYLOAD_COLUMNS = (
    "state_alpha, state_fips_code, county_code, "
    "CASE WHEN county_code = '000' THEN '' ELSE county_name END AS county_name, "
    "commodity_desc, statisticcat_desc, '' AS agg_level_desc, short_desc, unit_desc, "
    "year, value_raw"
)

# Models of the suite by CTE name.
_SUITE_MODELS = {
    "stg_weather_daily": "stg_weather",
    "stg_nass_yield": "stg_yields",
    "int_weather_growing_season": "features",
    "dim_county": "counties",
    "dim_commodity": "commodities",
    "dim_date": f"(SELECT {_calendar_columns('date')} FROM dates_2025)",
    "fact_weather_daily": "stg_weather",
    "fact_crop_yield": "stg_yields",
    "weather_yield_analysis": "analysis",
}


def _suite(declared: dict[str, ModelChecks]) -> str:
    def row(model: str, check: str, target: str, failures: str) -> str:
        return (
            f"SELECT '{model}' AS model, '{check}' AS check_name, '{target}' AS target, "
            f"CAST(({failures}) AS BIGINT) AS failures"
        )

    rows = []
    for model, checks in declared.items():
        source = _SUITE_MODELS[model]
        for name in checks.not_null:
            failures = f"SELECT COUNT(*) FROM {source} WHERE {name} IS NULL"
            rows.append(row(model, "not_null", name, failures))
        for name in checks.unique:
            duplicates = (
                f"SELECT {name} FROM {source} WHERE {name} IS NOT NULL "
                f"GROUP BY {name} HAVING COUNT(*) > 1"
            )
            rows.append(row(model, "unique", name, f"SELECT COUNT(*) FROM ({duplicates})"))
        if checks.unique_together:
            key = ", ".join(checks.unique_together)
            duplicates = f"SELECT {key} FROM {source} GROUP BY {key} HAVING COUNT(*) > 1"
            rows.append(
                row(
                    model,
                    "unique_combination",
                    ",".join(checks.unique_together),
                    f"SELECT COUNT(*) FROM ({duplicates})",
                )
            )
        for name, values in checks.accepted.items():
            failures = (
                f"SELECT COUNT(DISTINCT {name}) FROM {source} "
                f"WHERE {name} NOT IN ({_strings(values)})"
            )
            rows.append(row(model, "accepted_values", name, failures))
        for name, (parent, parent_column) in checks.references.items():
            failures = (
                f"SELECT COUNT(*) FROM {source} child WHERE child.{name} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {_SUITE_MODELS[parent]} parent "
                f"WHERE parent.{parent_column} = child.{name})"
            )
            rows.append(row(model, "relationships", name, failures))
        for name, rule in checks.holds.items():
            rows.append(row(model, "holds", name, f"SELECT COUNT(*) FROM {source} WHERE NOT ({rule})"))
    return "\nUNION ALL ".join(rows)


def _held(source: str, period: str, rules: dict[str, str]) -> str:
    names = ", ".join(f"CASE WHEN NOT ({rule}) THEN '{name}' END" for name, rule in rules.items())
    return (
        f"SELECT fips, {period} AS period, concat_ws(',', {names}) AS failed FROM {source} "
        f"WHERE {' OR '.join(f'NOT ({rule})' for rule in rules.values())}"
    )


def _correlations() -> str:
    features = ["gdd", "precip_total_mm", "heat_stress_days", "dry_days", "et0_total_mm", "tmax_mean"]
    return "\nUNION ALL ".join(
        f"SELECT commodity, '{name}' AS feature, "
        f"ROUND(CORR(yield_value, CAST({name} AS DOUBLE)), 6) AS correlation "
        f"FROM analysis GROUP BY commodity"
        for name in features
    )


def _null_counts() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, CAST(COUNT(*) AS BIGINT) AS failures "
        f"FROM stg_weather WHERE {name} IS NULL"
        for name in STAGED_COLUMNS.split(", ")
    )


ORACLES: dict[str, str] = {
    "q_stg_weather_daily": _statement(["stg_weather"], f"SELECT {STAGED_COLUMNS} FROM stg_weather"),
    "q_stg_nass_yield": _statement(
        ["stg_yields"],
        "SELECT fips, commodity, state_alpha, year, unit, yield_value, yield_value_t_ha, "
        "_ingested_at FROM stg_yields",
    ),
    "q_int_weather_growing_season": _statement(["features"], "SELECT * FROM features"),
    "q_staging_refreshed": _statement(["features"], "SELECT * FROM features"),
    "q_dim_county": _statement(["counties"], "SELECT * FROM counties"),
    "q_dim_commodity": _statement(
        ["commodities", "stg_yields"],
        """SELECT c.*, u.n_yields FROM commodities c LEFT JOIN (
               SELECT commodity, CAST(COUNT(*) AS BIGINT) AS n_yields
               FROM stg_yields GROUP BY 1) u ON u.commodity = c.commodity""",
    ),
    "q_dim_date": f"""
        SELECT {_calendar_columns('d')} FROM (
            SELECT CAST(UNNEST(generate_series(
                CAST(MIN(CAST(l_shipdate AS DATE)) AS TIMESTAMP),
                CAST(MAX(CAST(l_shipdate AS DATE)) AS TIMESTAMP),
                INTERVAL 1 DAY)) AS DATE) AS d
            FROM lineitem)""",
    "q_fact_weather_full": _statement(["stg_weather"], f"SELECT {STAGED_COLUMNS} FROM stg_weather"),
    "q_fact_weather_incremental": _statement(
        ["stg_weather"],
        f"""SELECT {STAGED_COLUMNS.replace('wind_speed_kmh',
                'CASE WHEN date < watermark THEN CAST(-1 AS DOUBLE) ELSE wind_speed_kmh END'
                ' AS wind_speed_kmh')}
            FROM stg_weather, (SELECT MAX(date) AS watermark FROM stg_weather
                               WHERE date <= DATE '{q.INCREMENTAL_UNTIL}') w""",
    ),
    "q_fact_crop_yield": _statement(
        ["stg_yields"],
        "SELECT fips, commodity, state_alpha, year, yield_value, yield_value_t_ha, unit, "
        "_ingested_at FROM stg_yields",
    ),
    "q_weather_yield_analysis": _statement(["analysis"], "SELECT * FROM analysis"),
    "q_analysis_table": _statement(["analysis"], "SELECT * FROM analysis"),
    "q_analysis_colocated": _statement(["analysis"], "SELECT * FROM analysis"),
    "q_yield_unit_conversion": _statement(
        ["raw_yields"],
        """SELECT state_fips_code, county_code, commodity_desc, year, value_raw, yield_value,
                  yield_value * CASE commodity_desc WHEN 'CORN' THEN CAST(0.0627677 AS DOUBLE)
                      WHEN 'SOYBEANS' THEN CAST(0.0672511 AS DOUBLE) END AS yield_value_t_ha
           FROM (SELECT *, TRY_CAST(REPLACE(value_raw, ',', '') AS DOUBLE) AS yield_value
                 FROM raw_yields)""",
    ),
    "q_parse_weather_payload": _statement(
        ["latest_weather"],
        f"SELECT fips, latitude, longitude, date, {MEASURES} FROM latest_weather",
    ),
    "q_parse_yield_payload": _statement(
        ["raw_yields"], f"SELECT {_YIELD_PAYLOAD_COLUMNS} FROM raw_yields"
    ),
    "q_ingest_weather": _statement(
        ["latest_weather"],
        f"""SELECT fips, latitude, longitude, date, {MEASURES}, {_STAMP} AS _ingested_at
            FROM latest_weather
            WHERE date BETWEEN DATE '{q.WINDOW[0]}' AND DATE '{q.WINDOW[1]}'""",
    ),
    "q_ingest_yield": _statement(
        ["raw_yields"],
        f"""SELECT {_YIELD_PAYLOAD_COLUMNS}, {_STAMP} AS _ingested_at FROM raw_yields
            WHERE year = {q.YIELD_YEAR} AND statisticcat_desc = 'YIELD'
              AND commodity_desc IN ({_strings(q.YIELD_COMMODITIES)})
              AND state_alpha IN ({_strings(q.YIELD_STATES)})""",
    ),
    "q_ingest_yield_twice": _statement(
        ["raw_yields"],
        f"""SELECT {_YIELD_PAYLOAD_COLUMNS}, {_STAMP} AS _ingested_at,
                   'refused,loaded,skipped' AS statuses
            FROM raw_yields
            WHERE year = {q.YIELD_YEAR} AND statisticcat_desc = 'YIELD'
              AND commodity_desc IN ({_strings(q.YIELD_COMMODITIES)})
              AND state_alpha IN ({_strings(q.YIELD_STATES)})""",
    ),
    "q_bronze_cleared": _statement(
        ["raw_yields"],
        """SELECT 'kept' AS folder, COUNT(*) AS n_rows FROM raw_yields
           UNION ALL SELECT 'cleared', 0""",
    ),
    "q_fact_refresh_recovered": _statement(
        ["stg_weather"], f"SELECT {STAGED_COLUMNS} FROM stg_weather"
    ),
    "q_backfill_fact": _statement(["stg_weather"], f"SELECT {STAGED_COLUMNS} FROM stg_weather"),
    "q_fact_weather_recovered": _statement(
        ["stg_weather"], f"SELECT {STAGED_COLUMNS} FROM stg_weather"
    ),
    "q_build_county_seed": _statement(
        ["counties"],
        f"SELECT * FROM counties WHERE state_alpha IN ({_strings(q.SEED_STATES)})",
    ),
    "q_point_batches": _statement(
        ["counties"],
        f"""SELECT CAST(place // {q.BATCH_SIZE} AS BIGINT) AS batch_id,
                   CAST(COUNT(*) AS BIGINT) AS n_points,
                   string_agg(fips, ',' ORDER BY place) AS fips_text,
                   string_agg(CAST(lat AS VARCHAR), ',' ORDER BY place) AS latitudes,
                   string_agg(CAST(lon AS VARCHAR), ',' ORDER BY place) AS longitudes
            FROM {_NUMBERED_COUNTIES} GROUP BY 1""",
    ),
    "q_bronze_roundtrip": _statement(["raw_weather"], "SELECT * FROM raw_weather"),
    "q_raw_yield_replace": _statement(
        ["raw_yields"],
        f"SELECT {RAW_YIELD_COLUMNS}, _ingested_at FROM raw_yields WHERE year >= {q.SPLIT_YEAR}",
    ),
    "q_raw_yield_partitions": _statement(
        ["raw_yields"],
        "SELECT "
        + RAW_YIELD_COLUMNS.replace(
            "short_desc",
            f"CASE WHEN year < {q.SPLIT_YEAR} THEN 'first' ELSE short_desc END AS short_desc",
        )
        + ", _ingested_at FROM raw_yields",
    ),
    "q_year_loaded": _statement(
        ["raw_yields"],
        "\nUNION ALL ".join(
            f"SELECT CAST({year} AS BIGINT) AS year, COUNT(*) > 0 AS loaded FROM raw_yields "
            f"WHERE year = {year} AND year <= {q.SPLIT_YEAR}"
            for year in q.PROBED_YEARS
        ),
    ),
    "q_record_count_gate": _statement(
        ["raw_yields"],
        f"""SELECT w.commodity_desc, w.state_alpha, w.year,
                   CAST(COUNT(r.value_raw) AS BIGINT) AS n_records,
                   COUNT(r.value_raw) >= {q.RECORD_LIMIT} AS over_limit
            FROM (SELECT UNNEST([{_strings(q.GATE_COMMODITIES)}]) AS commodity_desc,
                         state_alpha, year
                  FROM (SELECT n_name AS state_alpha,
                               CAST(UNNEST({q.GATE_YEARS}) AS BIGINT) AS year
                        FROM nation)) w
            LEFT JOIN raw_yields r ON r.commodity_desc = w.commodity_desc
                 AND r.state_alpha = w.state_alpha AND r.year = w.year
            GROUP BY 1, 2, 3""",
    ),
    "q_dq_not_null": _statement(["stg_weather"], _null_counts()),
    "q_dq_unique": _statement(
        ["raw_weather"],
        "SELECT fips, CAST(COUNT(*) AS BIGINT) AS n_records FROM raw_weather "
        "WHERE fips IS NOT NULL GROUP BY fips HAVING COUNT(*) > 1",
    ),
    "q_dq_unique_combination": _statement(
        ["raw_weather"],
        "SELECT fips, date, CAST(COUNT(*) AS BIGINT) AS n_records FROM raw_weather "
        "GROUP BY fips, date HAVING COUNT(*) > 1",
    ),
    "q_dq_accepted_values": _statement(
        ["stg_yields"],
        "SELECT commodity, CAST(COUNT(*) AS BIGINT) AS n_records FROM stg_yields "
        "WHERE commodity NOT IN ('corn', 'soybeans') GROUP BY commodity",
    ),
    "q_dq_relationships": _statement(
        ["stg_yields", "counties"],
        """SELECT y.fips, CAST(COUNT(*) AS BIGINT) AS n_records
           FROM stg_yields y LEFT JOIN counties c ON c.fips = y.fips
           WHERE y.fips IS NOT NULL AND c.fips IS NULL GROUP BY y.fips""",
    ),
    "q_dq_suite": _statement(
        ["analysis", "commodities", "dates_2025"], _suite(CHECKS)
    ),
    "q_dq_gated": _statement(
        ["analysis", "commodities", "dates_2025"], _suite(with_rules(CHECKS, q.RULES))
    ),
    "q_dq_by_period": _statement(
        ["stg_yields", "counties"], _suite({"fact_crop_yield": CHECKS["fact_crop_yield"]})
    ),
    "q_dq_quarantine": _statement(
        ["stg_weather", "stg_yields"],
        f"""{_held("stg_weather", "CAST(date AS VARCHAR)", q.RULES["stg_weather_daily"])}
            UNION ALL
            {_held("stg_yields", "commodity || ' ' || year", q.RULES["fact_crop_yield"])}""",
    ),
    "q_source_freshness": _statement(
        ["raw_yields"],
        f"""SELECT source, latest, n_loads, CAST(age AS BIGINT) AS age_seconds,
                   CASE WHEN age <= {int(q.LOAD_LIMITS.warn.total_seconds())} THEN 'pass'
                        WHEN age <= {int(q.LOAD_LIMITS.error.total_seconds())} THEN 'warn'
                        ELSE 'error' END AS status
            FROM (SELECT source, n_loads, make_timestamp(seconds * 1000000) AS latest,
                         {int(q.FRESHNESS_NOW.timestamp())} - seconds AS age
                  FROM (SELECT 'both' AS source, CAST(2 AS BIGINT) AS n_loads,
                               MAX(year) * 86400 + {q.LOAD_EPOCH} AS seconds FROM raw_yields
                        UNION ALL
                        SELECT 'first', 1, MAX(year) * 86400 + {q.LOAD_EPOCH} FROM raw_yields
                        WHERE year <= {q.SPLIT_YEAR}
                        UNION ALL SELECT 'none', 0, NULL))""",
    ),
    "q_reconcile_content": _statement(
        ["stg_weather"],
        f"""SELECT date, CAST(COUNT(*) AS BIGINT) AS left_rows, CAST(COUNT(*) AS BIGINT) AS right_rows
            FROM stg_weather WHERE date IN ({', '.join(f"DATE '{d}'" for d in q.TAMPERED_DAYS)}) GROUP BY date""",
    ),
    "q_dq_ranges": _statement(
        ["stg_yields"],
        f"""SELECT fips, commodity, year, yield_value FROM stg_yields
            WHERE yield_value < {q.YIELD_RANGE[0]} OR yield_value > {q.YIELD_RANGE[1]}""",
    ),
    "q_dq_weather_ranges": _statement(
        ["stg_weather"],
        f"""SELECT fips, date, temperature_2m_max FROM stg_weather
            WHERE temperature_2m_max < {q.TMAX_RANGE[0]}
               OR temperature_2m_max > {q.TMAX_RANGE[1]}""",
    ),
    "q_freshness": _statement(
        ["raw_weather"],
        f"""SELECT latest, CAST(age AS BIGINT) AS age_seconds,
                   age > {int(q.FRESHNESS_MAX_AGE.total_seconds())} AS stale
            FROM (SELECT MAX(_ingested_at) AS latest,
                         {int(q.FRESHNESS_NOW.timestamp())} - epoch(MAX(_ingested_at)) AS age
                  FROM raw_weather)""",
    ),
    "q_reconcile": _statement(
        ["raw_weather", "stg_weather"],
        """SELECT 'raw' AS layer, CAST(COUNT(*) AS BIGINT) AS n_rows,
                  CAST(COUNT(DISTINCT (fips, date)) AS BIGINT) AS n_keys FROM raw_weather
           UNION ALL
           SELECT 'staging', CAST(COUNT(*) AS BIGINT),
                  CAST(COUNT(DISTINCT (fips, date)) AS BIGINT) FROM stg_weather""",
    ),
    "q_reconcile_layers": _statement(
        ["raw_yields", "stg_yields"],
        """SELECT layer, CAST(COUNT(*) AS BIGINT) AS n_rows,
                  CAST(COUNT(DISTINCT (state_fips_code, county_code, commodity_desc, year)) AS BIGINT)
                      AS n_keys
           FROM raw_yields CROSS JOIN (VALUES ('bronze'), ('raw')) AS layers(layer) GROUP BY layer
           UNION ALL
           SELECT 'staging', CAST(COUNT(*) AS BIGINT),
                  CAST(COUNT(DISTINCT (fips, commodity, year)) AS BIGINT) FROM stg_yields""",
    ),
    "q_backfill_two_windows": _statement(
        ["analysis"],
        f"""SELECT * FROM analysis WHERE year IN ({', '.join(map(str, q.BACKFILL_YEARS))})
            AND commodity IN ({_strings([c.lower() for c in q.YIELD_COMMODITIES])})""",
    ),
    "q_state_yield_rollup": _statement(
        ["stg_yields"],
        """SELECT state_alpha, commodity, year, AVG(yield_value) AS yield_mean,
                  MIN(yield_value) AS yield_min, MAX(yield_value) AS yield_max,
                  CAST(COUNT(yield_value) AS BIGINT) AS n_counties
           FROM stg_yields GROUP BY 1, 2, 3""",
    ),
    "q_weather_yield_corr": _statement(["analysis"], _correlations()),
}
