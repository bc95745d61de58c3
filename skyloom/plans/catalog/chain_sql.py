"""The quality chain written out as SQL, to check the silver builders against."""

from __future__ import annotations

from collections.abc import Sequence

from skyloom.operators.quality import MetricRule


def chain_ctes(
    source: str,
    rules: Sequence[MetricRule],
    *,
    part: str,
    order: str,
    tie: str | None = None,
    pool: str = "1",
) -> str:
    """CTEs ending in ``chained``: every column of ``source`` plus clean, flag and imputed.

    ``source`` has a unique ``event_id`` and, where ``tie`` is given, ``lat`` and ``lon``: then
    what a series leaves missing is filled from the five nearest rows of its ``pool``.
    """
    over = f"PARTITION BY {part} ORDER BY {order}"
    ctes, joins, columns = [], [], []
    for r in rules:
        c, p = r.column, r.prefix
        jump = "abs(v - vp)" if not r.circular else "least(abs(v - vp), 360 - abs(v - vp))"
        checks = {"range_fail": f"v < {r.minimum} OR v > {r.maximum}"}
        if r.max_step:
            checks["step_fail"] = f"{jump} > {r.max_step}"
        if r.flat_window:
            zero = " AND v <> 0" if r.ignore_zero_runs else ""
            checks["flatline"] = f"v IS NOT NULL AND run_len >= {r.flat_window}{zero}"
        flags = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in checks.items())
        ctes.append(f"""{p}_1 AS (SELECT event_id, CAST({c} AS DOUBLE) AS v, {part} AS g, row_number() OVER ({over}) AS p,
    lag(CAST({c} AS DOUBLE)) OVER ({over}) AS vp FROM {source}),
  {p}_2 AS (SELECT *, sum(CASE WHEN v IS NULL OR vp IS NULL OR v <> vp THEN 1 ELSE 0 END)
    OVER (PARTITION BY g ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM {p}_1),
  {p}_3 AS (SELECT *, count(*) OVER (PARTITION BY g, run) AS run_len,
    last_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER b AS pb, last_value(v IGNORE NULLS) OVER b AS vb,
    first_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER a AS pa, first_value(v IGNORE NULLS) OVER a AS va
    FROM {p}_2 WINDOW b AS (PARTITION BY g ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      a AS (PARTITION BY g ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  {p}_4 AS (SELECT event_id, v, CASE WHEN v IS NOT NULL THEN v WHEN pb IS NULL OR p - pb > 3 THEN NULL WHEN pa IS NULL THEN vb
      ELSE vb + (va - vb) * (p - pb) / (pa - pb) END AS filled, concat_ws(',', {flags}) AS f FROM {p}_3)""")
        filled = f"{p}_4.filled"
        joins.append(f"JOIN {p}_4 ON s.event_id = {p}_4.event_id")
        if tie:
            ctes.append(f"""{p}_5 AS (SELECT {pool} AS pool, s.lat, s.lon, filled AS x, {tie} FROM {source} s JOIN {p}_4 ON s.event_id = {p}_4.event_id
    WHERE filled IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {pool}, s.lat, s.lon ORDER BY {tie}) <= 5),
  {p}_6 AS (SELECT DISTINCT {pool} AS upool, s.lat AS ulat, s.lon AS ulon FROM {source} s JOIN {p}_4 ON s.event_id = {p}_4.event_id WHERE filled IS NULL),
  {p}_7 AS (SELECT *, sqrt((lat - ulat) * (lat - ulat) + (lon - ulon) * (lon - ulon)) AS d FROM {p}_6 JOIN {p}_5 ON pool = upool
    QUALIFY row_number() OVER (PARTITION BY upool, ulat, ulon ORDER BY d, lat, lon, {tie}) <= 5),
  {p}_8 AS (SELECT upool, ulat, ulon, CASE WHEN count(*) FILTER (d = 0) > 0 THEN avg(x) FILTER (d = 0)
      ELSE sum(x / d) FILTER (d > 0) / sum(1 / d) FILTER (d > 0) END AS e FROM {p}_7 GROUP BY upool, ulat, ulon)""")
            filled = f"coalesce({p}_4.filled, {p}_8.e)"
            joins.append(f"LEFT JOIN {p}_8 ON {pool} = {p}_8.upool AND s.lat = {p}_8.ulat AND s.lon = {p}_8.ulon")
        columns += [
            f"{filled} AS {p}_clean",
            f"CASE WHEN {p}_4.f = '' THEN 'ok' ELSE {p}_4.f END AS {p}_qc_flag",
            f"CAST({p}_4.v IS NULL AND {filled} IS NOT NULL AS INTEGER) AS {p}_imputed",
        ]
    ctes.append(f"chained AS (SELECT s.*, {', '.join(columns)} FROM {source} s {' '.join(joins)})")
    return ",\n  ".join(ctes)


def output(rules: Sequence[MetricRule], digits: int = 6) -> str:
    """Select list of the chain's columns, clean values rounded."""
    return ", ".join(
        f"round({r.prefix}_clean, {digits}) AS {r.prefix}_clean, {r.prefix}_qc_flag, {r.prefix}_imputed" for r in rules
    )
