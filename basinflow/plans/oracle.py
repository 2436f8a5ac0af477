"""DuckDB text of the build, for the correctness oracle.

Each function returns CTE definitions (name -> SQL) mirroring one Spark
operator; queries compose them with ``fixtures.with_views``.  The SQL is the
brute-force reading of the semantics (range joins, ASOF joins, windows over
whole samples); it is deliberately not shaped like the Spark plan.
"""

from __future__ import annotations

from ..fixtures import ANNUAL_BLOCKS, MIXED_BLOCKS, calendar_sql

SHORT = "string_split({c}, '_')[-1]"


def short(c: str) -> str:
    return SHORT.format(c=c)


def r4(c: str, alias: str | None = None) -> str:
    return f"0.0::DOUBLE + round(CAST({c} AS DOUBLE), 4) AS {alias or c}"


def mixed_ctes(policy: str = "all", flow: str = "flow", obs: str = "obs",
               fcst: str = "fcst") -> dict[str, str]:
    nan_cols = ["c_p", "c_q"] if policy == "precip_target" else ["c_p", "c_t", "c_s", "c_q"]
    nan_ok = " AND ".join(f"{c} = 106" for c in nan_cols)
    return {
        "cal": calendar_sql(MIXED_BLOCKS, 5),
        "cand": (
            f"SELECT {short('g.gauge_id')} AS basin_id, c.split, c.issue_date "
            f"FROM gauges g CROSS JOIN cal c "
            f"WHERE {short('g.gauge_id')} IN (SELECT gauge_id FROM {flow})"),
        "ser": (
            f"SELECT gauge_id AS basin_id, date, 0 AS src, CAST(streamflow_cms AS DOUBLE) AS v0, "
            f"CAST(NULL AS DOUBLE) AS v1, CAST(NULL AS DOUBLE) AS v2 FROM {flow} "
            f"UNION ALL SELECT {short('basin_id')}, date, 1, CAST(precip AS DOUBLE), "
            f"CAST(temp AS DOUBLE), CAST(net_solar AS DOUBLE) FROM {obs}"),
        "fan": (
            "SELECT s.basin_id, c.split, c.issue_date, s.src, s.date, s.v0, s.v1, s.v2, "
            "CAST(date_diff('day', c.issue_date, s.date) AS INTEGER) AS off "
            "FROM cand c JOIN ser s ON s.basin_id = c.basin_id "
            "AND s.date BETWEEN c.issue_date - 305 AND c.issue_date + 10 "
            "WHERE s.src = 0 OR s.date <= c.issue_date"),
        "segd": ("SELECT *, CASE WHEN off < -60 THEN 0 WHEN src = 1 OR off < 0 THEN 1 ELSE 2 END AS seg "
                 "FROM fan"),
        "bins": (
            "SELECT *, MIN(CASE WHEN seg = 0 THEN date END) OVER w AS anchor, "
            "MAX(CASE WHEN seg = 0 THEN date END) OVER w AS wk_last, "
            "COUNT(CASE WHEN seg > 0 THEN 1 END) OVER w AS n_rest "
            "FROM segd WINDOW w AS (PARTITION BY basin_id, split, issue_date, src)"),
        "frow": (
            "SELECT basin_id, split, issue_date, src, seg, "
            "CASE WHEN seg = 0 THEN CAST(floor(date_diff('day', anchor, date) / 7) AS INTEGER) "
            "ELSE off + 95 END AS step, "
            "COALESCE(CAST(floor(date_diff('day', anchor, wk_last) / 7) AS BIGINT) + 1, 0) + n_rest AS src_len, "
            "v0, v1, v2 FROM bins"),
        "fi": f"SELECT DISTINCT {short('basin_id')} AS basin_id, issue_date AS fi FROM {fcst}",
        "prv": ("SELECT c.*, f.fi AS p FROM cand c ASOF LEFT JOIN fi f "
                "ON c.basin_id = f.basin_id AND c.issue_date >= f.fi"),
        "nxt": ("SELECT c.*, f.fi AS n FROM prv c ASOF LEFT JOIN fi f "
                "ON c.basin_id = f.basin_id AND c.issue_date <= f.fi"),
        "near": (
            "SELECT basin_id, split, issue_date, p, n, CASE WHEN p IS NULL THEN n WHEN n IS NULL THEN p "
            "WHEN date_diff('day', p, issue_date) < date_diff('day', issue_date, n) THEN p ELSE n END AS fc_issue "
            "FROM nxt"),
        "leads": (
            f"SELECT {short('basin_id')} AS basin_id, issue_date, lead_days, "
            "CAST(precip AS DOUBLE) AS v0, CAST(temp AS DOUBLE) AS v1, CAST(net_solar AS DOUBLE) AS v2, "
            "ROW_NUMBER() OVER (PARTITION BY basin_id, issue_date ORDER BY lead_days) AS lead_rank "
            f"FROM {fcst}"),
        "fcrow": (
            "SELECT n.basin_id, n.split, n.issue_date, 2 AS src, 2 AS seg, "
            "CAST(l.lead_rank + 95 AS INTEGER) AS step, CAST(NULL AS BIGINT) AS src_len, l.v0, l.v1, l.v2 "
            "FROM near n JOIN leads l ON l.basin_id = n.basin_id AND l.issue_date = n.fc_issue "
            "WHERE l.lead_rank <= 10"),
        "allrows": "SELECT * FROM frow UNION ALL SELECT * FROM fcrow",
        "steps": (
            "SELECT basin_id, split, issue_date, step, MAX(CASE WHEN src <> 0 THEN seg END) AS flag, "
            "CAST(AVG(CASE WHEN src <> 0 THEN v0 END) AS FLOAT) AS precip, "
            "CAST(AVG(CASE WHEN src <> 0 THEN v1 END) AS FLOAT) AS temp, "
            "CAST(AVG(CASE WHEN src <> 0 THEN v2 END) AS FLOAT) AS net_solar, "
            "CAST(AVG(CASE WHEN src = 0 THEN v0 END) AS FLOAT) AS target, "
            "MAX(CASE WHEN src = 0 THEN src_len END) AS lf, MAX(CASE WHEN src = 1 THEN src_len END) AS lw, "
            "COUNT(CASE WHEN src = 2 THEN 1 END) AS nf FROM allrows GROUP BY basin_id, split, issue_date, step"),
        "gated": (
            "SELECT *, CAST(COALESCE(MAX(lf) OVER s, 0) AS INTEGER) AS len_target, "
            "CAST(COALESCE(MAX(lw) OVER s, 0) + SUM(nf) OVER s AS INTEGER) AS len_weather, "
            "COUNT(precip) OVER s AS c_p, COUNT(temp) OVER s AS c_t, COUNT(net_solar) OVER s AS c_s, "
            "COUNT(target) OVER s AS c_q FROM steps WINDOW s AS (PARTITION BY basin_id, split, issue_date)"),
        "mixed": (
            "SELECT *, CASE WHEN len_target <> 106 THEN 'target_length' "
            "WHEN len_weather <> 106 THEN 'weather_length' "
            f"WHEN NOT ({nan_ok}) THEN 'missing_values' END AS reason FROM gated"),
    }


def annual_ctes(flow: str = "flow_dense", obs: str = "obs") -> dict[str, str]:
    w = ["precip", "temp", "u_wind", "v_wind", "dew_point", "net_solar"]
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS v{i}" for i in range(1, 6))
    vals = ", ".join(f"CAST({c} AS DOUBLE)" for c in w)
    return {
        "acal": calendar_sql(ANNUAL_BLOCKS, "year-start"),
        "aser": (f"SELECT gauge_id AS basin_id, date, 0 AS src, CAST(streamflow_cms AS DOUBLE) AS v0, {nulls} "
                 f"FROM {flow} UNION ALL SELECT {short('basin_id')}, date, 1, {vals} FROM {obs}"),
        "afan": ("SELECT s.*, c.split, c.issue_date, "
                 "CAST(date_diff('day', c.issue_date, s.date) + 365 AS INTEGER) AS step "
                 "FROM acal c JOIN aser s ON s.date BETWEEN c.issue_date - 365 AND c.issue_date"),
        "asteps": (
            "SELECT basin_id, split, issue_date, step, "
            + ", ".join(f"CAST(AVG(CASE WHEN src <> 0 THEN v{i} END) AS FLOAT) AS {c}" for i, c in enumerate(w))
            + ", CAST(AVG(CASE WHEN src = 0 THEN v0 END) AS FLOAT) AS target, "
            "COUNT(CASE WHEN src = 0 THEN 1 END) AS nf, COUNT(CASE WHEN src <> 0 THEN 1 END) AS nw "
            "FROM afan GROUP BY basin_id, split, issue_date, step"),
        "annual": (
            "SELECT *, CASE WHEN len_target <> 366 THEN 'target_length' "
            "WHEN len_weather <> 366 THEN 'weather_length' WHEN bad = 1 THEN 'missing_values' END AS reason "
            "FROM (SELECT *, CAST(SUM(nf) OVER s AS INTEGER) AS len_target, "
            "CAST(SUM(nw) OVER s AS INTEGER) AS len_weather, "
            "MAX(CASE WHEN precip IS NULL OR isnan(precip) OR isinf(precip) OR target IS NULL "
            "OR isnan(target) OR isinf(target) THEN 1 ELSE 0 END) OVER s AS bad "
            "FROM asteps WINDOW s AS (PARTITION BY basin_id, split, issue_date))"),
    }


def target_ctes(flow: str = "flow", pred_split: str = "test") -> dict[str, str]:
    """U2 (streamflow-only sample steps) and the persistence predictions."""
    return {
        "tcal": calendar_sql(MIXED_BLOCKS, 5),
        "tfan": (
            "SELECT f.gauge_id AS basin_id, c.split, c.issue_date, f.date, "
            "CAST(f.streamflow_cms AS DOUBLE) AS v0, "
            "CAST(date_diff('day', c.issue_date, f.date) AS INTEGER) AS off "
            f"FROM tcal c JOIN {flow} f ON f.date BETWEEN c.issue_date - 305 AND c.issue_date + 10"),
        "tbins": (
            "SELECT *, MIN(CASE WHEN seg = 0 THEN date END) OVER w AS anchor, "
            "MAX(CASE WHEN seg = 0 THEN date END) OVER w AS wk_last, "
            "COUNT(CASE WHEN seg > 0 THEN 1 END) OVER w AS n_rest "
            "FROM (SELECT *, CASE WHEN off < -60 THEN 0 WHEN off < 0 THEN 1 ELSE 2 END AS seg FROM tfan) "
            "WINDOW w AS (PARTITION BY basin_id, split, issue_date)"),
        "tsteps": (
            "SELECT basin_id, split, issue_date, "
            "CASE WHEN seg = 0 THEN CAST(floor(date_diff('day', anchor, date) / 7) AS INTEGER) "
            "ELSE off + 95 END AS step, MAX(seg) AS seg, CAST(AVG(v0) AS FLOAT) AS target, "
            "MAX(COALESCE(CAST(floor(date_diff('day', anchor, wk_last) / 7) AS BIGINT) + 1, 0) + n_rest) AS l "
            "FROM tbins GROUP BY ALL"),
        "target": (
            "SELECT *, CASE WHEN len_target <> 106 THEN 'target_length' "
            "WHEN cq <> 106 THEN 'missing_values' END AS reason "
            "FROM (SELECT *, CAST(MAX(l) OVER s AS INTEGER) AS len_target, COUNT(target) OVER s AS cq "
            "FROM tsteps WINDOW s AS (PARTITION BY basin_id, split, issue_date))"),
        "tscale": (
            "SELECT AVG(CAST(target AS DOUBLE)) AS m, STDDEV_POP(CAST(target AS DOUBLE)) AS sd "
            "FROM target WHERE reason IS NULL AND split = 'train'"),
        "pred": (
            "SELECT basin_id, split, issue_date, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, "
            "CAST(target AS DOUBLE) AS y, COALESCE(LAG(CAST(target AS DOUBLE)) OVER "
            "(PARTITION BY basin_id, split, issue_date ORDER BY step), CAST(target AS DOUBLE)) AS y_hat "
            f"FROM target WHERE reason IS NULL AND split = '{pred_split}'"),
    }
