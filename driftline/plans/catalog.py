"""Queries over the operators, each beside the SQL that DuckDB answers it with."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import streaming
from ..functions import physics
from ..operators import aggregates, calibrate, filters, joins, spectrum, stages, store, timefix, velocity, windows
from ..schema import DAY, SECOND, micros, rounded, timestamp
from ..scratch import scratch_path
from ..sinks import tsv
from ..sources import instruments, text
from .fixtures import AZIMUTH, GAIN_A, GAIN_M, SPEED, coefs, ctes, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
HOUR = 3600 * SECOND


def query(name: str, tables: tuple[str, ...] | None = None, sql: str | None = None):
    def add(f: Callable[..., DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(lambda n: table(spark, sf_dir, n))
        if sql is not None:
            ORACLES[name] = (ctes(*tables) + ("\n, " + sql[5:].lstrip() if sql.startswith("WITH ") else "\n" + sql)) if tables else sql
        return f

    return add


def r6(c: str, name: str | None = None) -> str:
    return f"round({c}, 6) + 0.0 AS {name or c}"


def r9(c: str, name: str | None = None) -> str:
    """For values that have few decimals, so that none lies between two results."""
    return f"round({c}, 9) + 0.0 AS {name or c}"


def r4(c: str, name: str | None = None) -> str:
    """For values of fits."""
    return f"round({c}, 4) + 0.0 AS {name or c}"


def rd(*columns: str):
    return [rounded(F.col(c)).alias(c) for c in columns]


# ---- physics in SQL -----------------------------------------------------------------------------
_G = f"Ax * {GAIN_A} AS gx, Ay * {GAIN_A} AS gy, Az * {GAIN_A} AS gz, Mx * {GAIN_M} AS hx, My * {GAIN_M} AS hy, Mz * {GAIN_M} AS hz"


def _series(r: str) -> str:
    return f"({SPEED[0]} + {SPEED[1]} * cos({r}) + {SPEED[2]} * sin({r}) + {SPEED[3]} * cos(2 * {r}) + {SPEED[4]} * sin(2 * {r}))"


def _speed(r: str) -> str:
    return f"CASE WHEN sin({r}) / {_series(r)} > 0 THEN sqrt(sin({r}) / {_series(r)}) ELSE 0.0 END"


_X0 = f"radians({SPEED[5]})"
_VELOCITY = f"""phys AS (SELECT *, CASE WHEN r < {_X0} THEN {_speed('r')} ELSE v0 + (r - {_X0}) * least(CASE WHEN (v0 - v1) / 0.01 = 0 THEN 10.0 ELSE (v0 - v1) / 0.01 END, 10.0) END AS Vabs,
  {AZIMUTH} - degrees(atan2((gx * hy - gy * hx) * gn, hz * (gx * gx + gy * gy) - gz * (gx * hx + gy * hy))) AS Vdir, degrees(r) AS inclination
 FROM (SELECT *, CASE WHEN abs(gn - 1) <= 1 THEN atan2(sqrt(gx * gx + gy * gy), gz) END AS r, {_speed(_X0)} AS v0, {_speed(f"({_X0} - 0.01)")} AS v1
  FROM (SELECT *, sqrt(gx * gx + gy * gy + gz * gz) AS gn FROM (SELECT *, {_G} FROM raw)))),
 vel AS (SELECT probe, t, seq, Vabs, Vdir, Vabs * cos(radians(Vdir)) AS v, Vabs * sin(radians(Vdir)) AS u, inclination, Temp, Battery FROM phys)"""


def _velocity(get) -> DataFrame:
    raw = get("raw")
    return velocity.velocity(raw.drop("P_counts", "value"), coefs(raw.sparkSession, raw))


def binned_sql(source: str, seconds: int, columns: list[str]) -> str:
    size = seconds * SECOND
    means = ", ".join(f"avg({c}) AS {c}" for c in columns)
    return f"""binned AS (SELECT probe, t, n AS "rows", {', '.join(columns)} FROM (SELECT *, avg(n) OVER (PARTITION BY probe) AS m FROM
 (SELECT probe, CAST(floor(t / {size}) AS BIGINT) * {size} AS t, count(*) AS n, {means} FROM {source} GROUP BY 1, 2)) WHERE n > m / 10)"""


@query("flow_2h", ("raw",), f"WITH {_VELOCITY}, {binned_sql('vel', 7200, ['v', 'u', 'inclination', 'Temp'])} SELECT probe, t, \"rows\", {r6('v')}, {r6('u')}, {r6('inclination')}, {r6('Temp')}, {r6('sqrt(u*u+v*v)', 'Vabs')} FROM binned")
def flow_2h(get):
    b = aggregates.binned(_velocity(get), 7200, ["v", "u", "inclination", "Temp"])
    return b.select("probe", "t", "rows", *rd("v", "u", "inclination", "Temp"), rounded(physics.polar(F.col("v"), F.col("u"))[0]).alias("Vabs"))


@query("p12_velocity", ("raw",), f"WITH {_VELOCITY} SELECT probe, t, seq, {r6('Vabs')}, {r6('Vdir')}, {r6('v')}, {r6('u')}, {r6('inclination')} FROM vel")
def p12(get):
    return _velocity(get).select("probe", "t", "seq", *rd("Vabs", "Vdir", "v", "u", "inclination"))


@query("p1_p3_attitude", ("raw",), f"SELECT probe, seq, {r9('gx')}, {r9('gy')}, {r9('gz')}, {r6('degrees(-atan(gx / sqrt(gy*gy+gz*gz)))', 'pitch')}, {r6('degrees(atan2(gy, gz))', 'roll')}, {r6('180 - degrees(atan2(gx, gy))', 'toolface')} FROM (SELECT *, {_G} FROM raw)")
def p1(get):
    raw = get("raw")
    x = raw.join(coefs(raw.sparkSession, raw), "probe")
    g = physics.calibrate((F.col("Ax"), F.col("Ay"), F.col("Az")), F.col("Ag"), F.col("Cg"))
    x = x.withColumns({"gx": g[0], "gy": g[1], "gz": g[2]})
    v = (F.col("gx"), F.col("gy"), F.col("gz"))
    return x.select("probe", "seq", *[rounded(c, 9).alias(c) for c in ("gx", "gy", "gz")], rounded(F.degrees(physics.pitch(v))).alias("pitch"), rounded(F.degrees(physics.roll(v))).alias("roll"), rounded(physics.direction_without_field(v, F.lit(180.0))).alias("toolface"))


@query("p13_pressure", ("raw",), f"SELECT probe, seq, {r9('(1.5 + 0.01 * Temp) + (0.002 + 0.00001 * Temp) * P_counts + (0.000000001 + 0 * Temp) * P_counts * P_counts', 'Pressure')} FROM raw")
def p13(get):
    return get("raw").select("probe", "seq", rounded(physics.pressure(F.col("P_counts"), F.col("Temp"), [[1.5, 0.01], [0.002, 0.00001], [0.000000001, 0.0]]), 9).alias("Pressure"))


_FILLED = """f AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER a AS pi, last_value(y IGNORE NULLS) OVER a AS py,
  first_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER b AS ni, first_value(y IGNORE NULLS) OVER b AS ny FROM g
 WINDOW a AS (PARTITION BY probe ORDER BY i ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY probe ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def _fill(column: str) -> str:
    return f"CASE WHEN {column} IS NOT NULL THEN {column} WHEN pi IS NULL THEN ny WHEN ni IS NULL THEN py ELSE py + (ny - py) * ((i - pi)::DOUBLE / (ni - pi)) END"


def _tail(least: float, source: str) -> str:
    """W12 of the column Battery of a table with i."""
    marks = ", ".join(f"min(CASE WHEN Battery < {least + m} THEN i END) AS i{n}, arg_min(CASE WHEN Battery < {least + m} THEN Battery END, CASE WHEN Battery < {least + m} THEN i END) AS y{n}" for m, n in zip(windows.TAIL_MARKS, "abc"))
    return f"""k AS (SELECT probe AS kp, {marks} FROM {source} GROUP BY probe),
 tail AS (SELECT {source}.*, CASE WHEN ic IS NOT NULL AND ib <> ia AND i >= ic THEN yc + (i - ic) * ((yb - ya) / (ib - ia)) ELSE Battery END AS bat FROM {source} JOIN k ON probe = kp)"""


_PRESSURE = f"""x AS (SELECT probe, t, seq, P_counts, Battery, floor(Temp) AS z, row_number() OVER (PARTITION BY probe ORDER BY t, seq) AS i FROM raw),
 g AS (SELECT *, CASE WHEN l IS NULL OR l <> z THEN z END AS y FROM (SELECT *, lag(z) OVER (PARTITION BY probe ORDER BY i) AS l FROM x)),
 {_FILLED}, {_tail(5.3, 'f')},
 m AS (SELECT probe AS mp, min(CASE WHEN bat <= 5.6 THEN i END) AS im FROM tail GROUP BY probe),
 c AS (SELECT probe, t, seq, P_counts + (0.1 * ({_fill('y')}) + 3.0) + CASE WHEN im IS NULL OR i < im THEN -20.0 * 5.6 + 1.0 ELSE -20.0 * bat + 1.0 END AS q FROM tail JOIN m ON probe = mp)"""


@query("p14_pressure_old", ("raw",), f"WITH {_PRESSURE} SELECT probe, seq, CASE WHEN row_number() OVER (PARTITION BY probe, floor(t / {DAY}) ORDER BY t, seq) > 2 THEN round((0.00000001 * q + 0.001) * q + 2.0, 6) + 0.0 END AS Pressure FROM c")
def p14(get):
    x = get("raw").withColumn("Temp", F.floor("Temp").cast("double"))
    p = velocity.pressure_old(x, [1e-8, 0.001, 2.0], [0.1, 3.0], [-20.0, 1.0], battery_min=5.6, battery_ok_min=5.3, burst_period=DAY)
    return p.select("probe", "seq", *rd("Pressure"))


FORCE = (0.01, 0.02, 0.17, 0.005)


def _at(x: float) -> float:
    return ((FORCE[0] * x + FORCE[1]) * x + FORCE[2]) * x + FORCE[3]


def _by_force(f: str) -> str:
    """P5 in SQL: 15 nodes of the angle up to force 0.25, the polynomial, a line from the first hundredth whose speed is over 0.5."""
    nodes = [physics.GOOD_INCLINATION * k / 14 for k in range(15)]
    at = [math.sqrt(math.tan(a) / math.cos(a)) for a in nodes]
    pieces = " ".join(f"WHEN {f} <= {b!r} THEN {p!r} + ({f} - {a!r}) * {(q - p) / (b - a)!r}" for a, b, p, q in zip(at, at[1:], nodes, nodes[1:]))
    x0 = next(1 + k / 100 for k in range(300) if _at(1 + k / 100) > 0.5)
    line = f"{_at(x0)!r} + ({f} - {x0!r}) * {(_at(x0) - _at(x0 - 0.1)) / 0.1!r}"
    poly = f"(({FORCE[0]} * {f} + {FORCE[1]}) * {f} + {FORCE[2]}) * {f} + {FORCE[3]}"
    return f"CASE WHEN {f} <= 0.25 THEN (CASE WHEN {f} <= {at[0]!r} THEN {nodes[0]!r} {pieces} ELSE {nodes[-1]!r} END) * {_at(0.25) / physics.GOOD_INCLINATION!r} WHEN {f} < {x0!r} THEN {poly} WHEN {f} IS NOT NULL THEN {line} END"


_OVER = "Az = -32624"
_RECOVERED = f"""lost AS (SELECT probe, t, seq, Ax, Ay, Az, CASE WHEN seq % 13 <> 0 THEN Mx END AS Mx, My, Mz FROM raw_over),
 n AS (SELECT *, Ax * {GAIN_A} AS gx, Ay * {GAIN_A} AS gy, Az * {GAIN_A} AS gz, sqrt((Mx * Mx + My * My + Mz * Mz)) * {GAIN_M} - 1 AS hn FROM lost),
 md AS (SELECT probe AS mp, median(CASE WHEN hn < 8 THEN hn END) + 1 AS hm, avg(CASE WHEN {_OVER} AND gx * gx + gy * gy > 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS share,
  avg(CASE WHEN {_OVER} AND gx * gx + gy * gy > 1 THEN gx * gx + gy * gy END) AS mean, max(CASE WHEN {_OVER} THEN gx * gx + gy * gy END) AS most FROM n GROUP BY probe),
 w AS (SELECT *, CASE WHEN share > 0.001 THEN CASE WHEN most = mean THEN 1.0::DOUBLE WHEN most - mean < (most - 1) / 2 THEN mean ELSE most END ELSE 1.0::DOUBLE END AS whole FROM n JOIN md ON probe = mp),
 r AS (SELECT * EXCLUDE (gz), CASE WHEN {_OVER} THEN sqrt(greatest(0.0, whole - CASE WHEN gx * gx + gy * gy > 1 AND NOT (share > 0.001 AND whole = most) THEN whole ELSE gx * gx + gy * gy END)) ELSE gz END AS gz,
  abs(sqrt(gx * gx + gy * gy + gz * gz) - 1) > 1 AND NOT {_OVER} AS bad,
  coalesce(Mx * {GAIN_M}, -sqrt(abs(hm * hm - (My * My + Mz * Mz) * {GAIN_M} * {GAIN_M}))) AS hx, My * {GAIN_M} AS hy, Mz * {GAIN_M} AS hz FROM w),
 i AS (SELECT *, CASE WHEN NOT bad THEN atan2(sqrt(gx * gx + gy * gy), gz) END AS r FROM r), fo AS (SELECT *, sqrt(tan(r) / cos(r)) AS f FROM i)
SELECT probe, t, seq, {r6(_by_force('f'), 'Vabs')}, {r6(f'{AZIMUTH} - degrees(atan2((gx * hy - gy * hx) * sqrt(gx * gx + gy * gy + gz * gz), hz * (gx * gx + gy * gy) - gz * (gx * hx + gy * hy)))', 'Vdir')}, {r6('degrees(r)', 'inclination')} FROM fo"""


@query("p12_recovered", ("raw_over",), f"WITH {_RECOVERED}")
def p12_recovered(get):
    raw = get("raw_over").withColumn("Mx", F.when(F.col("seq") % 13 != 0, F.col("Mx")))
    return velocity.recovered_velocity(raw, coefs(raw.sparkSession, raw), force_coefs=FORCE, despike=False).select("probe", "t", "seq", *rd("Vabs", "Vdir", "inclination"))


@query("p5_speed_by_force", ("raw",), f"""WITH f AS (SELECT probe, seq, sqrt(tan(a) / cos(a)) AS f FROM (SELECT probe, seq, (seq % 1200) / 1000.0::DOUBLE AS a FROM raw) q)
SELECT probe, seq, {r6('f', 'force')}, {r6(_by_force('f'), 'speed')} FROM f""")
def p5(get):
    f = get("raw").select("probe", "seq", physics.force((F.col("seq") % 1200) / F.lit(1000.0)).alias("f"))
    return f.select("probe", "seq", rounded("f").alias("force"), rounded(physics.polynomial_speed(F.col("f"), FORCE)).alias("speed"))


ORACLES["p17_year_fraction"] = ("SELECT event_id, round(year(ts) + (dayofyear(ts) - 1) / CASE WHEN year(ts) % 4 = 0 THEN 366.0::DOUBLE ELSE 365.0::DOUBLE END, 6) AS y FROM events")
QUERIES["p17_year_fraction"] = lambda spark, d: spark.read.parquet(f"{d}/events.parquet").select("event_id", F.round(physics.year_fraction(F.col("ts").cast("date")), 6).alias("y"))


@query("p15_rotation", ("raw",), f"SELECT probe, seq, {r6('cos(radians(30)) * Ax - sin(radians(30)) * Ay', 'rx')}, {r6('sin(radians(30)) * Ax + cos(radians(30)) * Ay', 'ry')}, {r6('Az', 'rz')} FROM raw")
def p15(get):
    m = physics.rotation("z", F.lit(30.0))
    v = [F.col("Ax"), F.col("Ay"), F.col("Az")]
    return get("raw").select("probe", "seq", *[rounded(m[i][0] * v[0] + m[i][1] * v[1] + m[i][2] * v[2]).alias(n) for i, n in enumerate(("rx", "ry", "rz"))])


_TURNED = {  # rows of the matrices about x and y at 30 degrees
    "x": ("Ax", "cos(radians(30)) * Ay - sin(radians(30)) * Az", "sin(radians(30)) * Ay + cos(radians(30)) * Az"),
    "y": ("cos(radians(30)) * Ax + sin(radians(30)) * Az", "Ay", "cos(radians(30)) * Az - sin(radians(30)) * Ax"),
}


@query("p15_rotation_x_y", ("raw",), "SELECT probe, seq, " + ", ".join(r6(c, f"{axis}{k}") for axis, row in _TURNED.items() for k, c in enumerate(row)) + " FROM raw")
def p15_x_y(get):
    v = [F.col("Ax"), F.col("Ay"), F.col("Az")]
    turned = {axis: physics.rotation(axis, F.lit(30.0)) for axis in "xy"}
    return get("raw").select("probe", "seq", *[rounded(m[k][0] * v[0] + m[k][1] * v[1] + m[k][2] * v[2]).alias(f"{axis}{k}") for axis, m in turned.items() for k in range(3)])


# ---- filters ------------------------------------------------------------------------------------
@query("f1_rows_within", ("raw",), "SELECT probe, seq, Ax, Temp FROM raw WHERE Ax > -1500 AND Ax < 1500 AND Temp > 6 AND Temp < 18")
def f1(get):
    return filters.rows_within(get("raw"), {"ax": -1500, "Temp": 6}, {"Ax": 1500, "temp": 18, "absent": 1}).select("probe", "seq", "Ax", "Temp")


@query("f2_cells_within", ("raw",), "SELECT probe, seq, CASE WHEN Ax > -1000 AND Ax < 1000 THEN Ax END AS Ax, CASE WHEN Ay > -1000 AND Ay < 1000 THEN Ay END AS Ay, CASE WHEN Az > -1000 AND Az < 1000 THEN Az END AS Az FROM raw")
def f2(get):
    return filters.cells_within(get("raw"), {"A.*": -1000}, {"A.*": 1000}).select("probe", "seq", "Ax", "Ay", "Az")


@query("f3_cells_within_inclusive", ("raw",), "SELECT probe, seq, CASE WHEN Ax >= -1000 AND Ax <= 1000 THEN Ax END AS Ax FROM raw")
def f3(get):
    return filters.cells_within(get("raw"), {"Ax": -1000}, {"Ax": 1000}, True).select("probe", "seq", "Ax")


@query("f4_mask_ranges", ("raw", "intervals"), "SELECT probe, seq, EXISTS (SELECT 1 FROM intervals i WHERE i.probe = raw.probe AND raw.t BETWEEN i.t_start AND i.t_end) AS good FROM raw")
def f4(get):
    return filters.mask_ranges(get("raw"), get("intervals")).select("probe", "seq", "good")


@query("f5_clip_ranges", ("intervals",), "SELECT probe, greatest(t_start, 1704240000000000) AS t_start, least(t_end, 1704600000000000) AS t_end FROM intervals WHERE greatest(t_start, 1704240000000000) <= least(t_end, 1704600000000000)")
def f5(get):
    return filters.clip_ranges(get("intervals"), 1704240000000000, 1704600000000000).select("probe", "t_start", "t_end")


@query("f6_parameters", ("raw", "load_log"), "SELECT r.probe, seq, coalesce(l.changed, 99) AS changed, 7 AS other FROM raw r LEFT JOIN (SELECT * FROM load_log WHERE changed > 2) l ON r.probe = l.probe")
def f6(get):
    return filters.with_parameters(get("raw"), get("load_log").where("changed > 2").select("probe", "changed"), {"changed": 99, "other": 7}).select("probe", "seq", "changed", "other")


@query("f7_moving", ("raw",), """WITH s AS (SELECT probe, seq, CASE WHEN row_number() OVER w % 64 < 40 THEN 5.0 ELSE Ax END AS x, row_number() OVER w - 1 AS i FROM raw WINDOW w AS (PARTITION BY probe ORDER BY t, seq)),
 d AS (SELECT *, greatest(i - 1, 0) AS p, CASE WHEN i = 0 THEN lead(x) OVER w - x ELSE x - lag(x) OVER w END AS dx FROM s WINDOW w AS (PARTITION BY probe ORDER BY i))
SELECT d.probe, d.seq, abs(coalesce(dx, 0)) > 3 OR coalesce(abs(a1.x - a0.x) > 3, false) OR coalesce(abs(b1.x - b0.x) > 3, false) AS works FROM d
 LEFT JOIN s a0 ON a0.probe = d.probe AND a0.i = (p // 16) * 16 LEFT JOIN s a1 ON a1.probe = d.probe AND a1.i = (p // 16) * 16 + 16
 LEFT JOIN s b0 ON b0.probe = d.probe AND b0.i = (p // 32) * 32 LEFT JOIN s b1 ON b1.probe = d.probe AND b1.i = (p // 32) * 32 + 32""")
def f7(get):
    from ..schema import ordered

    s = get("raw").withColumn("x", F.when(F.row_number().over(ordered()) % 64 < 40, 5.0).otherwise(F.col("Ax"))).select("probe", "t", "seq", "x")
    return filters.moving(s, "x", 3.0).select("probe", "seq", "works")


@query("f8_too_frequent", ("raw",), "SELECT probe, seq, count(*) OVER (PARTITION BY probe, Mz) * 100.0 / count(*) OVER (PARTITION BY probe) > 0.5 AS frequent FROM raw")
def f8(get):
    return filters.too_frequent(get("raw"), "Mz").select("probe", "seq", "frequent")


# ---- joins --------------------------------------------------------------------------------------
_NEAR = """n AS (SELECT q.probe, q.qid, q.t, b.t AS bt, b.Temp AS bv, a.t AS a_t, a.Temp AS av FROM query_times q
 ASOF LEFT JOIN (SELECT probe, t, Temp FROM raw) b ON q.probe = b.probe AND q.t >= b.t ASOF LEFT JOIN (SELECT probe, t, Temp FROM raw) a ON q.probe = a.probe AND q.t <= a.t)"""


@query("j3_neighbours", ("raw", "query_times"), f"WITH {_NEAR} SELECT probe, qid, bt AS before_t, bv AS before_v, a_t AS after_t, av AS after_v FROM n")
def j3(get):
    return joins.neighbours(get("query_times"), get("raw"), "Temp").select("probe", "qid", "before_t", "before_v", "after_t", "after_v")


@query("j2_nearest", ("raw", "query_times"), f"WITH {_NEAR} SELECT probe, qid, CASE WHEN a_t IS NULL OR t - bt < a_t - t THEN bt ELSE a_t END AS found_t, CASE WHEN a_t IS NULL OR t - bt < a_t - t THEN bv ELSE av END AS found_v, CASE WHEN a_t IS NULL OR t - bt < a_t - t THEN bt ELSE a_t END - t AS dt FROM n")
def j2(get):
    return joins.time_difference(joins.nearest(get("query_times"), get("raw"), "Temp")).select("probe", "qid", "found_t", "found_v", "dt")


@query("j4_points", ("raw", "query_times"), f"WITH {_NEAR} SELECT probe, qid, {r6('CASE WHEN a_t > bt THEN bv + (av - bv) * ((t - bt)::DOUBLE / (a_t - bt)) ELSE coalesce(bv, av) END', 'value')} FROM n")
def j4(get):
    return joins.points(get("query_times"), get("raw"), "Temp").select("probe", "qid", *rd("value"))


#: The same by the names that these queries have had since they took every order.
_NEAR_ALL = _NEAR.replace("query_times", "order_times")


@query("j3_neighbours_of_all_orders", ("raw", "order_times"), f"WITH {_NEAR_ALL} SELECT probe, qid, bt AS before_t, bv AS before_v, a_t AS after_t, av AS after_v FROM n")
def j3_all(get):
    return joins.neighbours(get("order_times"), get("raw"), "Temp").select("probe", "qid", "before_t", "before_v", "after_t", "after_v")


@query("j2_nearest_of_all_orders", ("raw", "order_times"), f"WITH {_NEAR_ALL} SELECT probe, qid, CASE WHEN a_t IS NULL OR t - bt < a_t - t THEN bt ELSE a_t END AS found_t, CASE WHEN a_t IS NULL OR t - bt < a_t - t THEN bv ELSE av END AS found_v, CASE WHEN a_t IS NULL OR t - bt < a_t - t THEN bt ELSE a_t END - t AS dt FROM n")
def j2_all(get):
    return joins.time_difference(joins.nearest(get("order_times"), get("raw"), "Temp")).select("probe", "qid", "found_t", "found_v", "dt")


@query("j4_points_of_all_orders", ("raw", "order_times"), f"WITH {_NEAR_ALL} SELECT probe, qid, {r6('CASE WHEN a_t > bt THEN bv + (av - bv) * ((t - bt)::DOUBLE / (a_t - bt)) ELSE coalesce(bv, av) END', 'value')} FROM n")
def j4_all(get):
    return joins.points(get("order_times"), get("raw"), "Temp").select("probe", "qid", *rd("value"))


@query("j6_within_intervals", ("raw", "intervals"), "SELECT r.probe, r.seq, i.run FROM raw r JOIN intervals i ON r.probe = i.probe AND r.t BETWEEN i.t_start AND i.t_end")
def j6(get):
    return joins.within_intervals(get("raw"), get("intervals")).select("probe", "seq", "run")


PROBES = [f"i{k:02d}" for k in range(10)]


@query("j7_wide", ("raw",), f"WITH {binned_sql('raw', 7200, ['Temp'])} SELECT t, " + ", ".join(f"round(max(CASE WHEN probe = '{p}' THEN Temp END), 6) + 0.0 AS Temp_{p}" for p in PROBES) + " FROM binned GROUP BY t")
def j7(get):
    b = aggregates.binned(get("raw"), 7200, ["Temp"])
    return joins.wide(b.withColumn("Temp", rounded("Temp")), PROBES, ["Temp"])


_NODES = """WITH nodes AS (SELECT min(seq) AS node, avg(Ax) AS x, avg(Ay) AS y FROM raw GROUP BY floor(seq / 100)), pts AS (SELECT seq, Mx * 8 AS x, My * 8 AS y FROM raw)
SELECT p.seq, min(struct_pack(d := (n.x - p.x) * (n.x - p.x) + (n.y - p.y) * (n.y - p.y), k := n.node)).k AS node, min((n.x - p.x) * (n.x - p.x) + (n.y - p.y) * (n.y - p.y)) AS d2 FROM pts p CROSS JOIN nodes n GROUP BY p.seq"""


@query("j8_nearest_node", ("raw",), _NODES)
@query("j8_nearest_node_of_all", ("raw",), _NODES)
def j8_all(get):
    """Every row's point; a node is the mean place of 100 successive rows, so nodes grow with the rows."""
    raw = get("raw")
    nodes = raw.groupBy(F.floor(F.col("seq") / 100).alias("hundred")).agg(F.min("seq").alias("node"), F.avg("Ax").alias("x"), F.avg("Ay").alias("y"))
    return joins.nearest_node(raw.select("seq", (F.col("Mx") * 8).alias("x"), (F.col("My") * 8).alias("y")), nodes).select("seq", "node", "d2")


@query("j9_intersections", ("intervals", "load_log"), "SELECT i.probe, greatest(i.t_start, l.t_start) AS t_start, least(i.t_end, l.t_end) AS t_end FROM intervals i JOIN load_log l ON i.probe = l.probe AND i.t_start <= l.t_end AND l.t_start <= i.t_end")
def j9(get):
    return joins.intersections(get("intervals"), get("load_log"))


@query("j10_overlapping", ("days",), "SELECT probe, k, t_end FROM days, (SELECT min(t_start) AS a FROM days) WHERE t_start <= a + 777600000000 AND t_end > a + 432000000000")
def j10(get):
    days = get("days")
    a = days.agg(F.min("t_start")).first()[0]
    return joins.overlapping(days, a + 5 * DAY, a + 9 * DAY).select("probe", "k", "t_end")


@query("s7_stored_ranges", ("raw", "overlapping_ranges"), "SELECT probe, t, seq, Temp FROM raw r WHERE EXISTS (SELECT 1 FROM overlapping_ranges o WHERE o.probe = r.probe AND r.t BETWEEN o.t_start AND o.t_end)")
def s7(get):
    return store.stored_ranges(get("raw"), get("overlapping_ranges"), ["probe", "t", "seq", "Temp"])


@query("s9_logged_between", ("days",), "SELECT probe, k, greatest(t_start, a + 432000000000) AS t_start, least(t_end, a + 777600000000) AS t_end FROM days, (SELECT min(t_start) AS a FROM days) WHERE t_start <= a + 777600000000 AND t_end >= a + 432000000000")
def s9(get):
    days = get("days")
    a = days.agg(F.min("t_start")).first()[0]
    return store.logged_between(days, a + 5 * DAY, a + 9 * DAY).select("probe", "k", "t_start", "t_end")


@query("k12_unions_by_columns", ("raw",), "SELECT 'probe,seq,Temp' AS columns, probe, count(*) AS n FROM raw WHERE seq % 3 <> 1 GROUP BY probe UNION ALL SELECT 'probe,seq' AS columns, probe, count(*) AS n FROM raw WHERE seq % 3 = 1 GROUP BY probe")
def k12(get):
    raw = get("raw")
    parts = [raw.where("seq % 3 = 0").select("probe", "seq", "Temp"), raw.where("seq % 3 = 1").select("probe", "seq"), raw.where("seq % 3 = 2").select("Temp", "probe", "seq")]
    out = [u.groupBy("probe").agg(F.count(F.lit(1)).alias("n")).select(F.lit(",".join(u.columns)).alias("columns"), "probe", "n") for u in store.unions_by_columns(parts)]
    return out[0].unionByName(out[1])


@query("j1_coefficients", ("load_log",), "SELECT probe, CASE WHEN changed > 2 THEN 1.0 ELSE 2.0 END AS k, greatest(changed, 3) AS date FROM load_log")
def j1(get):
    log = get("load_log")
    first = log.where("changed > 2").select("probe", F.lit(1).alias("priority"), F.lit(1.0).alias("k"), F.col("changed").alias("date"))
    second = log.select("probe", F.lit(2).alias("priority"), F.lit(2.0).alias("k"), F.col("changed").alias("date"))
    return joins.coefficients(first.unionByName(second), log.select("probe", F.lit(3).cast("long").alias("date")))


# ---- aggregates ---------------------------------------------------------------------------------
@query("a1_binned", ("raw",), f"WITH {binned_sql('raw', 600, ['Ax', 'Temp', 'Battery'])} SELECT probe, t, \"rows\", {r6('Ax')}, {r6('Temp')}, {r6('Battery')} FROM binned")
def a1(get):
    return aggregates.binned(get("raw"), 600, ["Ax", "Temp", "Battery"]).select("probe", "t", "rows", *rd("Ax", "Temp", "Battery"))


@query("a2_whole_span", ("raw",), f"SELECT probe, CAST(floor(sum(t) / count(*)) AS BIGINT) AS t, count(*) AS \"rows\", {r6('avg(Temp)', 'Temp')} FROM raw GROUP BY probe")
def a2(get):
    return aggregates.binned(get("raw"), 400 * 86400, ["Temp"]).select("probe", "t", "rows", *rd("Temp"))


@query("a3_binned_many", ("raw",), " UNION ALL ".join(f"SELECT probe, t, {s} AS bin_s, {r6('Temp')} FROM (SELECT probe, t, n, Temp, avg(n) OVER (PARTITION BY probe) AS m FROM (SELECT probe, CAST(floor(t / {s}000000) AS BIGINT) * {s}000000 AS t, count(*) AS n, avg(Temp) AS Temp FROM raw GROUP BY 1, 2)) WHERE n > m / 10" for s in (600, 3600, 7200)))
def a3(get):
    return aggregates.binned_many(get("raw"), (600, 3600, 7200), ["Temp"]).select("probe", "t", "bin_s", *rd("Temp"))


@query("a4_first_per_bin", ("raw",), f"SELECT CAST(floor(t / {HOUR}) AS BIGINT) * {HOUR} AS bin_t, arg_min(probe, (t, probe, seq)) AS probe, arg_min(Temp, (t, probe, seq)) AS Temp FROM raw GROUP BY 1")
def a4(get):
    return aggregates.first_per_bin(get("raw"), 3600, ["Temp"])


@query("a5_modes", ("raw",), "SELECT probe, Mz AS mode, n FROM (SELECT probe, Mz, count(*) AS n, row_number() OVER (PARTITION BY probe ORDER BY count(*) DESC, Mz) AS k FROM raw GROUP BY probe, Mz) WHERE k = 1")
def a5(get):
    return aggregates.modes(get("raw"), "Mz")


@query("a6_mean_deviation", ("raw",), f"SELECT probe, {r6('avg(abs(Ax - m))', 'mad')} FROM (SELECT probe, Ax, avg(Ax) OVER (PARTITION BY probe) AS m FROM raw) GROUP BY probe")
def a6(get):
    return aggregates.mean_deviation(get("raw"), "Ax").select("probe", *rd("mad"))


@query("a7_median_direction", ("raw",), f"SELECT probe, {r6('-degrees(atan2(median(Ax), median(Ay)))', 'azimuth_add')} FROM raw WHERE Temp > 10 AND Temp < 170 GROUP BY probe")
def a7(get):
    moved = get("raw").select("probe", F.col("Ax").alias("u"), F.col("Ay").alias("v"), F.col("Temp").alias("inclination"))
    return aggregates.median_direction(filters.gate(moved)).select("probe", *rd("azimuth_add"))


@query("a8_zeroing", ("raw",), f"SELECT probe, {r6('1 - x * x / (1 + z)', 'r00')}, {r6('-x * y / (1 + z)', 'r01')}, {r6('-x', 'r02')}, {r6('z', 'r22')} FROM (SELECT probe, a / n AS x, b / n AS y, c / n AS z FROM (SELECT *, sqrt(a*a + b*b + c*c) AS n FROM (SELECT probe, avg(Ax) AS a, avg(Ay) AS b, avg(Az) AS c FROM raw GROUP BY probe)))")
def a8(get):
    z = aggregates.zeroing(get("raw"), ("Ax", "Ay", "Az"))
    return z.select("probe", *[rounded(F.col("Rz")[i][j]).alias(f"r{i}{j}") for i, j in ((0, 0), (0, 1), (0, 2), (2, 2))])


@query("a9_sphere_cells", ("sphere",), f"SELECT probe, CAST(least(floor(acos(z / sqrt(x*x+y*y+z*z)) / (2 * 3.141592653589793::DOUBLE) * 50), 49) AS BIGINT) AS cell_a, CAST(least(floor((cos(atan2(y, x)) + 1) / 2 * 50), 49) AS BIGINT) AS cell_b, {r6('avg(x)', 'x')}, min(t) AS t, count(*) AS n FROM sphere GROUP BY 1, 2, 3")
def a9(get):
    c = aggregates.sphere_cells(get("sphere"), 50)
    return c.select("probe", F.col("cell_a").cast("long").alias("cell_a"), F.col("cell_b").cast("long").alias("cell_b"), *rd("x"), "t", "n")


#: What the points of `sphere` were made with.
_CENTRE = ", ".join(f"{v!r}::DOUBLE AS {{}}{i}" for i, v in enumerate((0.1, -0.2, 0.05)))
_GAINS = ", ".join(f"round(1 / {v!r}::DOUBLE, 6) AS A{i}{i}" for i, v in enumerate((1.2, 0.9, 1.1)))


@query("a10_ellipsoid", ("sphere",), f"SELECT DISTINCT probe, {_CENTRE.format('b', 'b', 'b')}, {_GAINS} FROM sphere")
def a10(get):
    f = calibrate.fit_ellipsoid(get("sphere"))
    return f.select("probe", *[rounded(F.col("b")[i]).alias(f"b{i}") for i in range(3)], *[rounded(F.col("A")[i][i]).alias(f"A{i}{i}") for i in range(3)])


@query("a12_axes", ("sphere",), f"SELECT DISTINCT probe, {_CENTRE.format('c', 'c', 'c')}, 0.9::DOUBLE AS r0, 1.1::DOUBLE AS r1, 1.2::DOUBLE AS r2 FROM sphere")
def a12(get):
    f = calibrate.fit_axes(get("sphere"))
    return f.select("probe", *[rounded(F.col("centre")[i]).alias(f"c{i}") for i in range(3)], *[rounded(F.col("radii")[i]).alias(f"r{i}") for i in range(3)])


@query("a14_pressure_fit")
def a14(get):
    """Degrees 1 to 7, on pressures with a part that no polynomial has."""
    d = get("raw").select("probe", F.col("P_counts").alias("U"), F.col("Temp").alias("T"), (F.col("P_counts") * 0.002 + F.col("Temp") * 0.01 + F.col("Mx") * 0.001).alias("P"))
    return calibrate.pressure_fits(d).select("probe", "degree", F.transform("coefs", lambda c: F.round(c, 4)).alias("coefs"), *rd("rmse"))


@query("a14_known_surface", ("raw",), f"""SELECT probe, CAST(d AS INTEGER) AS degree, {r4('0.002 * u + 0.01 * v + 1e-5 * u * v', 'c0')}, {r4('(0.002 + 1e-5 * v) * su', 'c1')}, {r4('(0.01 + 1e-5 * u) * sv', 'c2')}, 0.0::DOUBLE AS c3, {r4('1e-5 * su * sv', 'c4')}, 0.0::DOUBLE AS c5, 0.0::DOUBLE AS rmse
 FROM (SELECT probe, avg(P_counts) AS u, avg(Mx / 50 + 10) AS v, stddev_pop(P_counts) AS su, stddev_pop(Mx / 50 + 10) AS sv FROM raw GROUP BY probe) q CROSS JOIN range(2, 8) n(d)""")
def a14_known(get):
    """A surface of degree 2: all fits from there on find its coefficients and leave no error."""
    d = get("raw").select("probe", F.col("P_counts").alias("U"), (F.col("Mx") / 50 + 10).alias("T"))
    d = d.withColumn("P", F.col("U") * 0.002 + F.col("T") * 0.01 + F.col("U") * F.col("T") * 1e-5)
    fits = calibrate.pressure_fits(d).where("degree > 1")
    return fits.select("probe", "degree", *[rounded(F.col("coefs")[i], 4).alias(f"c{i}") for i in range(6)], rounded("rmse", 3).alias("rmse"))


@query("a15_burst_statistics", ("raw_gaps",), f"""WITH d AS (SELECT probe, t, seq, sum(CASE WHEN t - l > {6 * HOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY probe ORDER BY t, seq) AS burst FROM (SELECT *, lag(t) OVER (PARTITION BY probe ORDER BY t, seq) AS l FROM raw_gaps)),
 b AS (SELECT probe, burst, count(*) AS n, min(t) AS s, max(t) AS e FROM d GROUP BY probe, burst), g AS (SELECT *, s - lag(e) OVER (PARTITION BY probe ORDER BY burst) AS gap, max(burst) OVER (PARTITION BY probe) AS last FROM b)
SELECT probe, count(*) AS bursts, {r6('avg(CASE WHEN burst > 0 AND burst < last THEN n END)', 'mean_rows')}, max(gap) AS largest_gap FROM g GROUP BY probe""")
def a15(get):
    return aggregates.burst_statistics(windows.bursts(get("raw_gaps"), 6 * HOUR)).select("probe", "bursts", *rd("mean_rows"), "largest_gap")


@query("a16_summary", ("raw",), "SELECT probe, min(t) AS t_start, max(t) AS t_end, count(*) AS \"rows\", count(*) FILTER (Temp > 10) AS rows_kept FROM raw GROUP BY probe")
def a16(get):
    return aggregates.summary(get("raw"), F.col("Temp") > 10)


# ---- windows ------------------------------------------------------------------------------------
@query("w1_bursts", ("raw_gaps",), f"SELECT probe, seq, CAST(sum(CASE WHEN t - l > {6 * HOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY probe ORDER BY t, seq) AS BIGINT) AS burst FROM (SELECT *, lag(t) OVER (PARTITION BY probe ORDER BY t, seq) AS l FROM raw_gaps)")
def w1(get):
    return windows.bursts(get("raw_gaps"), 6 * HOUR).select("probe", "seq", "burst")


_SPIKE = """sp AS (SELECT *, (l IS NULL OR Ax - l > 1500) AND (n IS NULL OR n - Ax < -1500) OR (l IS NULL OR Ax - l < -1500) AND (n IS NULL OR n - Ax > 1500) AS spike
 FROM (SELECT *, lag(Ax) OVER w AS l, lead(Ax) OVER w AS n, row_number() OVER w AS i FROM raw_spiked WINDOW w AS (PARTITION BY probe ORDER BY t, seq)))"""


@query("w2_spikes", ("raw_spiked",), f"WITH {_SPIKE} SELECT probe, seq, spike FROM sp")
def w2(get):
    return windows.spikes(get("raw_spiked"), "Ax", 1500).select("probe", "seq", "spike")


@query("w3_despiked", ("raw_spiked",), f"""WITH {_SPIKE}, g AS (SELECT probe, seq, i, CASE WHEN NOT spike THEN Ax END AS y FROM sp),
 f AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER a AS pi, last_value(y IGNORE NULLS) OVER a AS py, first_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER b AS ni, first_value(y IGNORE NULLS) OVER b AS ny FROM g
 WINDOW a AS (PARTITION BY probe ORDER BY i ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY probe ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) SELECT probe, seq, {r6(_fill('y'), 'Ax')} FROM f""")
def w3(get):
    return windows.despiked_counts(get("raw_spiked"), {"Ax": 1500}).select("probe", "seq", *rd("Ax"))


@query("w4_filled", ("raw_holes",), f"""WITH g AS (SELECT probe, seq, Mx, row_number() OVER (PARTITION BY probe ORDER BY t, seq) AS i FROM raw_holes),
 f AS (SELECT *, last_value(CASE WHEN Mx IS NOT NULL THEN i END IGNORE NULLS) OVER a AS pi, last_value(Mx IGNORE NULLS) OVER a AS py, first_value(CASE WHEN Mx IS NOT NULL THEN i END IGNORE NULLS) OVER b AS ni, first_value(Mx IGNORE NULLS) OVER b AS ny FROM g
 WINDOW a AS (PARTITION BY probe ORDER BY i ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY probe ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) SELECT probe, seq, {r6(_fill('Mx'), 'Mx')} FROM f""")
def w4(get):
    return windows.filled(get("raw_holes"), "Mx").select("probe", "seq", *rd("Mx"))


@query("w5_sigma_despiked", ("raw_spiked",), f"""WITH g AS (SELECT probe, t, seq, Ax, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY probe) AS n, avg(Ax) OVER f AS m, stddev_pop(Ax) OVER f AS s FROM raw_spiked
 WINDOW w AS (PARTITION BY probe ORDER BY t, seq), f AS (PARTITION BY probe ORDER BY t, seq ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)),
 e AS (SELECT *, max(CASE WHEN i = 5 THEN m END) OVER p AS m0, max(CASE WHEN i = 5 THEN s END) OVER p AS s0, max(CASE WHEN i = n - 5 THEN m END) OVER p AS m1, max(CASE WHEN i = n - 5 THEN s END) OVER p AS s1 FROM g WINDOW p AS (PARTITION BY probe))
SELECT probe, seq, CASE WHEN abs(Ax - CASE WHEN i < 5 THEN m0 WHEN i > n - 5 THEN m1 ELSE m END) > 2.5 * CASE WHEN i < 5 THEN s0 WHEN i > n - 5 THEN s1 ELSE s END THEN NULL ELSE Ax END AS Ax FROM e""")
def w5(get):
    return windows.sigma_despiked(get("raw_spiked"), "Ax", [2.5], 10).select("probe", "seq", "Ax")


@query("w6_vector_despiked")
def w6(get):
    return windows.vector_despiked(get("raw_spiked"), ("Ax", "Ay", "Az")).select("probe", "seq", "ok")


@query("w7_true_regions", ("raw",), "WITH x AS (SELECT probe, Temp > 12 AS b, row_number() OVER (PARTITION BY probe ORDER BY t, seq) - 1 AS i FROM raw), y AS (SELECT probe, i, i - row_number() OVER (PARTITION BY probe ORDER BY i) AS g FROM x WHERE b) SELECT probe, min(i) AS start, max(i) + 1 AS \"end\" FROM y GROUP BY probe, g")
def w7(get):
    return windows.true_regions(get("raw").withColumn("b", F.col("Temp") > 12), "b")


@query("w8_kept_position", ("raw",), "SELECT probe, seq, CAST(coalesce(sum(CASE WHEN seq % 7 <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY probe ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS kept_i FROM raw")
def w8(get):
    return windows.kept_position(get("raw").withColumn("bad", F.col("seq") % 7 == 0), "bad").select("probe", "seq", "kept_i")


@query("w9_burst_despiked", ("raw_gaps",), f"WITH d AS (SELECT *, sum(CASE WHEN t - l > {6 * HOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY probe ORDER BY t, seq) AS burst FROM (SELECT *, lag(t) OVER (PARTITION BY probe ORDER BY t, seq) AS l FROM raw_gaps)) SELECT probe, seq, CASE WHEN abs(Ax - avg(Ax) OVER p) <= 1.5 * stddev_pop(Ax) OVER p THEN Ax END AS Ax FROM d WINDOW p AS (PARTITION BY probe, burst)")
def w9(get):
    return windows.burst_despiked(windows.bursts(get("raw_gaps"), 6 * HOUR), "Ax", 1.5).select("probe", "seq", "Ax")


@query("w10_burst_starts", ("raw",), f"SELECT probe, seq, CASE WHEN row_number() OVER (PARTITION BY probe, CAST(floor(t / {DAY}) AS BIGINT) ORDER BY t, seq) > 2 THEN P_counts END AS P_counts FROM raw")
def w10(get):
    return windows.burst_starts_nulled(get("raw"), "P_counts", DAY).select("probe", "seq", "P_counts")


@query("w11_smoothed_steps", ("raw",), f"""WITH g AS (SELECT probe, seq, i, CASE WHEN l IS NULL OR l <> y THEN y END AS y FROM (SELECT probe, seq, y, row_number() OVER w AS i, lag(y) OVER w AS l FROM (SELECT probe, t, seq, floor(Temp) AS y FROM raw) WINDOW w AS (PARTITION BY probe ORDER BY t, seq))),
 f AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER a AS pi, last_value(y IGNORE NULLS) OVER a AS py, first_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER b AS ni, first_value(y IGNORE NULLS) OVER b AS ny FROM g
 WINDOW a AS (PARTITION BY probe ORDER BY i ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY probe ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) SELECT probe, seq, {r6(_fill('y'), 'y')} FROM f""")
def w11(get):
    return windows.smoothed_steps(get("raw").withColumn("y", F.floor("Temp").cast("double")), "y").select("probe", "seq", *rd("y"))


@query("w12_battery_tail", ("raw",), f"WITH x AS (SELECT probe, seq, Battery, row_number() OVER (PARTITION BY probe ORDER BY t, seq) AS i FROM raw), {_tail(5.5, 'x')} SELECT probe, seq, {r6('bat', 'Battery')} FROM tail")
def w12(get):
    return windows.battery_tail(get("raw"), "Battery", 5.5).select("probe", "seq", *rd("Battery"))


@query("w13_recovered_channel", ("raw",), f"SELECT probe, seq, {r6('CASE WHEN seq % 13 = 0 THEN sqrt(greatest(0.0, 1 - x * x - y * y)) * sign(Mz) ELSE z END', 'z')} FROM (SELECT probe, seq, Mz, Ax / 3000 AS x, Ay / 3000 AS y, Az / 20000 AS z FROM raw)")
def w13(get):
    x = get("raw").select("probe", "seq", "Mz", (F.col("Ax") / 3000).alias("x"), (F.col("Ay") / 3000).alias("y"), F.when(F.col("seq") % 13 != 0, F.col("Az") / 20000).alias("z"))
    return windows.recovered_channel(x, "z", ("x", "y"), "Mz").select("probe", "seq", *rd("z"))


# ---- time ---------------------------------------------------------------------------------------
def _frequency(table: str, precision: int) -> str:
    """T2; with precision 0 the fixtures' frequencies would round to 0, so they are not rounded."""
    return f"""WITH s0 AS (SELECT probe, seq, t, lag(t) OVER w AS b, lead(t) OVER w AS a FROM {table} WINDOW w AS (PARTITION BY probe ORDER BY seq)),
 cnt AS (SELECT probe, count(*) FILTER (t = b) AS equal, count(*) FILTER (t < b) AS decreasing FROM s0 GROUP BY probe),
 k AS (SELECT s0.* FROM s0 JOIN cnt USING (probe) WHERE decreasing = 0 OR NOT (((b IS NULL OR b < t) AND (a IS NULL OR a < t)) OR ((b IS NULL OR b > t) AND (a IS NULL OR a > t)))),
 u AS (SELECT probe, seq, t - lag(t) OVER (PARTITION BY probe ORDER BY seq) AS u FROM k),
 n AS (SELECT *, count(*) FILTER (u >= 0) OVER (PARTITION BY probe ORDER BY seq ROWS UNBOUNDED PRECEDING) AS c FROM u),
 m AS (SELECT probe, max(c) + 1 AS ends, (sum(u) FILTER (u > 0))::DOUBLE / (count(*) FILTER (u > 0) + 1) + 1{'0' * (precision + 6)} AS longest FROM n GROUP BY probe),
 i AS (SELECT probe, u, c, lead(c) OVER w AS nc, lag(u) OVER w AS bu, lead(u) OVER w AS nu FROM n WHERE u > 0 WINDOW w AS (PARTITION BY probe ORDER BY seq)),
 f AS (SELECT i.probe, (coalesce(nc, ends) - c) * 1000000.0::DOUBLE / u AS f FROM i JOIN m USING (probe) WHERE u < longest AND coalesce(bu < longest, true) AND coalesce(nu < longest, true)),
 q AS (SELECT probe, median(f) AS m, stddev_pop(f) AS s FROM f GROUP BY probe),
 g AS (SELECT f.probe, avg(f) AS every, avg(f) FILTER (abs(f - q.m) < 3 * q.s) AS good, count(*) FILTER (abs(f - q.m) < 3 * q.s) AS n FROM f JOIN q USING (probe) GROUP BY f.probe)
SELECT cnt.probe, round(CASE WHEN n > 1 THEN good ELSE every END, {precision or 9}) + 0.0 AS fs, equal, decreasing FROM cnt LEFT JOIN g USING (probe)"""


@query("t2_sampling_frequency", ("raw_lowres",), _frequency("raw_lowres", 0))
def t2(get):
    return timefix.sampling_frequency(get("raw_lowres")).select("probe", rounded("fs", 9).alias("fs"), "equal", "decreasing")


@query("t2_among_inversions", ("raw_swapped",), _frequency("raw_swapped", 6))
def t2_inversions(get):
    return timefix.sampling_frequency(get("raw_swapped"), precision=6).select("probe", *rd("fs"), "equal", "decreasing")


@query("t3_without_inversions")
def t3(get):
    swapped = get("raw").withColumn("t", F.when(F.col("seq") % 211 == 0, F.col("t") + 86_400_000_000).otherwise(F.col("t"))).select("probe", "t", "seq")
    return timefix.without_inversions(swapped).select("probe", "seq", "ok")


@query("t4_spread_repeats", ("raw_lowres",), """WITH r AS (SELECT *, sum(CASE WHEN t <> l THEN 1 ELSE 0 END) OVER (PARTITION BY probe ORDER BY seq) AS g FROM (SELECT *, lag(t) OVER (PARTITION BY probe ORDER BY seq) AS l FROM raw_lowres)),
 k AS (SELECT probe, g, count(*) AS n, min(t) AS t0 FROM r GROUP BY probe, g), s AS (SELECT *, coalesce(least(1000000.0::DOUBLE / 0.001, (lead(t0) OVER (PARTITION BY probe ORDER BY g) - t0)::DOUBLE / n), 1000000.0::DOUBLE / 0.001) AS step FROM k)
SELECT r.probe, r.seq, r.t + CAST(floor((row_number() OVER (PARTITION BY r.probe, r.g ORDER BY r.seq) - 1) * s.step) AS BIGINT) AS t FROM r JOIN s ON r.probe = s.probe AND r.g = s.g""")
def t4(get):
    return timefix.spread_repeats(get("raw_lowres"), 0.001).select("probe", "seq", "t")


@query("t5_day_jumps", ("raw",), "SELECT probe, seq, t FROM raw")
def t5(get):
    return timefix.day_jumps(get("raw_dayjump")).select("probe", "seq", "t")


def _linear(step: int, hole: int) -> str:
    return f"""WITH d AS (SELECT probe, t, seq, sum(CASE WHEN t - l > {hole} THEN 1 ELSE 0 END) OVER (PARTITION BY probe ORDER BY t, seq) AS h FROM (SELECT *, lag(t) OVER (PARTITION BY probe ORDER BY t, seq) AS l FROM doubled)),
 k AS (SELECT *, row_number() OVER b - 1 AS k, count(*) OVER p AS n, min(t) OVER p AS s, max(t) OVER p AS e, coalesce(t > lag(t) OVER b, false) AS up FROM d WINDOW b AS (PARTITION BY probe, h ORDER BY t, seq), p AS (PARTITION BY probe, h)),
 m AS (SELECT *, min(CASE WHEN up THEN k END) OVER p AS k1, max(CASE WHEN up THEN k END) OVER p AS k2, max(CASE WHEN up THEN k ELSE 0 END) OVER (PARTITION BY probe, h ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS kept FROM k WINDOW p AS (PARTITION BY probe, h))
SELECT probe, seq, CAST(CASE WHEN abs(e - s - (n - 1) * {step}.0::DOUBLE) < {2 * hole} THEN s + k * {step} WHEN e - s > (n - 1) * {step} THEN t + (k - kept) * {step} ELSE s + floor(k * ((e - s)::DOUBLE / coalesce(k2 - k1 + 1, greatest(n - 1, 1))) + 0.5) END AS BIGINT) AS t FROM m"""


@query("t6_rows_lost", ("doubled",), _linear(HOUR // 6, 5 * HOUR))
def t6_lost(get):
    return timefix.linear_between_holes(get("doubled"), 1 / 600, 5 * HOUR).select("probe", "seq", "t")


@query("t6_linear_between_holes", ("doubled",), _linear(20 * HOUR, 5 * HOUR))
def t6(get):
    return timefix.linear_between_holes(get("doubled"), 1 / 72000, 5 * HOUR).select("probe", "seq", "t")


@query("t1_corrected_times", ("raw_lowres",), f"""WITH r AS (SELECT probe, seq, t - {HOUR} AS t FROM raw_lowres), q AS (SELECT *, sum(CASE WHEN l IS NULL OR t <> l THEN 1 ELSE 0 END) OVER (PARTITION BY probe ORDER BY seq) AS g FROM (SELECT *, lag(t) OVER (PARTITION BY probe ORDER BY seq) AS l FROM r)),
 k AS (SELECT *, row_number() OVER (PARTITION BY probe, g ORDER BY seq) - 1 AS k, count(*) OVER (PARTITION BY probe, g) AS n FROM q), f AS (SELECT probe AS fp, g - 1 AS fg, min(t) AS following FROM q GROUP BY probe, g)
SELECT probe, seq, CAST(t + floor(k * coalesce(least(60000000.0::DOUBLE, (following - t)::DOUBLE / n), 60000000.0::DOUBLE)) AS BIGINT) AS t, true AS ok FROM k LEFT JOIN f ON probe = fp AND g = fg""")
def t1(get):
    return timefix.corrected_times(get("raw_lowres"), fs=1 / 60, shift=HOUR).select("probe", "seq", "t", "ok")


@query("t1_corrected_inversions")
def t1_inversions(get):
    return timefix.corrected_times(get("raw_swapped"), mode="delete_inversions").select("probe", "seq", "t", "ok")


@query("t9_shifted_from", ("raw", "load_log"), f"SELECT r.probe, seq, CASE WHEN t >= t_start + {5 * DAY} AND t < t_start + {9 * DAY} THEN t - {HOUR} WHEN t >= t_start + {9 * DAY} THEN t + {DAY} ELSE t END AS t FROM raw r JOIN load_log l ON r.probe = l.probe")
def t9_pairs(get):
    log = get("load_log")
    pairs = log.select("probe", (F.col("t_start") + 5 * DAY).alias("t_from"), (F.col("t_start") + 5 * DAY - HOUR).alias("t_to")).unionByName(log.select("probe", (F.col("t_start") + 9 * DAY).alias("t_from"), (F.col("t_start") + 10 * DAY).alias("t_to")))
    return timefix.shifted_from(get("raw"), pairs).select("probe", "seq", "t")


@query("t14_at_offset", ("raw",), "SELECT probe, seq, strftime(make_timestamp(t + 19800000000), '%Y-%m-%d %H:%M:%S') AS local FROM raw")
def t14(get):
    return get("raw").select("probe", "seq", F.date_format(timefix.at_offset(F.col("t"), 19800), "yyyy-MM-dd HH:mm:ss").alias("local"))


@query("t15_two_times", ("load_log",), "SELECT probe, CAST(floor((floor(t_start / 1000000) + floor(t_end / 1000000)) / 2) AS BIGINT) * 1000000 AS middle, CAST(floor(t_end / 1000000) - floor(t_start / 1000000) AS BIGINT) AS seconds FROM load_log")
def t15(get):
    return get("load_log").select("probe", timefix.middle(F.col("t_start"), F.col("t_end")).alias("middle"), timefix.apart(F.col("t_end"), F.col("t_start")).alias("seconds"))


@query("t7_linear_with_shifts")
def t7(get):
    return timefix.linear_with_shifts(windows.bursts(get("raw").select("probe", "t", "seq"), 20 * HOUR), 1 / 3600, 3 * HOUR).select("probe", "seq", "t")


@query("t8_filled_times", ("raw",), """WITH g AS (SELECT probe, seq, t, seq % 11 = 0 AS bad, row_number() OVER (PARTITION BY probe ORDER BY seq) AS i FROM raw),
 f AS (SELECT *, last_value(CASE WHEN NOT bad THEN i END IGNORE NULLS) OVER a AS pi, last_value(CASE WHEN NOT bad THEN t END IGNORE NULLS) OVER a AS pt, first_value(CASE WHEN NOT bad THEN i END IGNORE NULLS) OVER b AS ni, first_value(CASE WHEN NOT bad THEN t END IGNORE NULLS) OVER b AS nt FROM g
 WINDOW a AS (PARTITION BY probe ORDER BY i ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY probe ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT probe, seq, CASE WHEN NOT bad THEN t WHEN pi IS NULL THEN CAST(floor(nt - (ni - i) * 1000000.0::DOUBLE / 0.001 + 0.5) AS BIGINT) WHEN ni IS NULL THEN CAST(floor(pt + (i - pi) * 1000000.0::DOUBLE / 0.001 + 0.5) AS BIGINT) ELSE CAST(floor(pt + (nt - pt) * ((i - pi)::DOUBLE / (ni - pi)) + 0.5) AS BIGINT) END AS t FROM f""")
def t8(get):
    return timefix.filled_times(get("raw").withColumn("bad", F.col("seq") % 11 == 0), "bad", 0.001).select("probe", "seq", "t")


@query("t9_shifted", ("raw", "load_log"), "SELECT r.probe, seq, t - changed * 3600000000 AS t FROM raw r JOIN load_log l ON r.probe = l.probe")
def t9(get):
    return timefix.shifted(get("raw"), get("load_log").select("probe", (F.col("changed") * HOUR).alias("shift"))).select("probe", "seq", "t")


@query("t10_drift_removed", ("raw",), "SELECT probe, seq, a + CAST(floor((t - a) * ((b + 60000000 - a)::DOUBLE / (b - a)) + 0.5) AS BIGINT) AS t FROM (SELECT *, min(t) OVER (PARTITION BY probe) AS a, max(t) OVER (PARTITION BY probe) AS b FROM raw)")
def t10(get):
    raw = get("raw")
    return timefix.drift_removed(raw, raw.groupBy("probe").agg((F.max("t") + 60_000_000).alias("t_end"))).select("probe", "seq", "t")


@query("t10_equal_spacing", ("raw",), "SELECT probe, seq, a + CAST(floor((b - a) * (row_number() OVER (PARTITION BY probe ORDER BY t, seq) - 1) / greatest(n - 1, 1)::DOUBLE + 0.5) AS BIGINT) AS t FROM (SELECT *, min(t) OVER p AS a, max(t) OVER p AS b, count(*) OVER p AS n FROM raw WINDOW p AS (PARTITION BY probe))")
def t10b(get):
    return timefix.equal_spacing(get("raw")).select("probe", "seq", "t")


@query("t11_regular_grid", ("raw",), f"""WITH s AS (SELECT probe, t, Temp, seq, min(t) OVER (PARTITION BY probe) AS t0, max(t) OVER (PARTITION BY probe) AS t9 FROM raw), g AS (SELECT probe, unnest(generate_series(min(t0), max(t9), {6 * HOUR})) AS t FROM s GROUP BY probe)
SELECT g.probe, g.t, {r6('CASE WHEN a.t > b.t THEN b.Temp + (a.Temp - b.Temp) * ((g.t - b.t)::DOUBLE / (a.t - b.t)) ELSE b.Temp END', 'Temp')} FROM g ASOF JOIN raw b ON g.probe = b.probe AND g.t >= b.t ASOF LEFT JOIN raw a ON g.probe = a.probe AND g.t <= a.t""")
def t11(get):
    return timefix.regular_grid(get("raw"), 6 * HOUR, "Temp").select("probe", "t", *rd("Temp"))


@query("t12_period_intervals", ("load_log",), f"SELECT probe, greatest(s, t_start) AS t_start, least(s + {5 * DAY}, t_end) AS t_end FROM (SELECT probe, t_start, t_end, unnest(generate_series(CAST(floor(t_start / {DAY}) AS BIGINT) * {DAY}, t_end, {5 * DAY})) AS s FROM load_log) WHERE greatest(s, t_start) < least(s + {5 * DAY}, t_end)")
def t12(get):
    return timefix.period_intervals(get("load_log"), 5 * DAY)


@query("t13_sliding", ("raw",), f"SELECT probe, w_start, count(*) AS n, {r6('avg(Temp)', 'Temp')} FROM (SELECT probe, Temp, unnest([(CAST(floor(t / {12 * HOUR}) AS BIGINT) - 1) * {12 * HOUR}, CAST(floor(t / {12 * HOUR}) AS BIGINT) * {12 * HOUR}]) AS w_start FROM raw) GROUP BY 1, 2")
def t13(get):
    return timefix.sliding_starts(get("raw"), DAY, 0.5).groupBy("probe", "w_start").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("Temp")).alias("Temp"))


# ---- spectra ------------------------------------------------------------------------------------
def _spectra(get, method: str) -> DataFrame:
    grid = timefix.regular_grid(get("raw"), HOUR, "Temp").withColumn("seq", F.col("t"))
    w = timefix.sliding_starts(grid, 5 * DAY, 0.0)
    return spectrum.spectra(w, "Temp", HOUR, method=method).select("probe", "w_start", rounded("freq", 9).alias("freq"), F.col("psd"))


@query("x2_multitaper")
def x2(get):
    return _spectra(get, "eigen")


@query("x3_adaptive")
def x3(get):
    return _spectra(get, "adaptive")


@query("x5_welch")
def x5(get):
    return _spectra(get, "welch")


# ---- stored tables ------------------------------------------------------------------------------
_FORMATTED = "SELECT probe, strftime(make_timestamp(CAST(ceil(t / 1000000.0::DOUBLE) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS Time, Temp FROM raw"


@query("k1_formatted", ("raw",), _FORMATTED)
def k1(get):
    return store.formatted(get("raw"), ["Temp"])


@query("k2_log_rows", ("raw",), "SELECT probe, min(t) AS t_start, max(t) AS t_end, count(*) AS \"rows\", 'a.csv' AS file, CAST(5 AS BIGINT) AS changed, CAST(6 AS BIGINT) AS processed FROM raw GROUP BY probe")
def k2(get):
    return store.log_rows(get("raw"), "a.csv", 5, 6)


@query("k3_separators", ("raw",), "SELECT probe, t, seq, Temp FROM raw UNION ALL SELECT probe, max(t) + 100000, max(seq) + 1, NULL FROM raw GROUP BY probe")
def k3(get):
    return store.separators(get("raw").select("probe", "t", "seq", "Temp"), 5, ["Temp"])


@query("k4_aligned_union", ("raw",), "SELECT probe, CAST(seq AS BIGINT) AS seq, Temp, '' AS note, CAST(0 AS INT) AS flag FROM raw WHERE seq % 2 = 0 UNION ALL SELECT probe, seq, NULL, 'x', CAST(1 AS INT) FROM raw WHERE seq % 2 = 1")
def k4(get):
    raw = get("raw")
    a = raw.where("seq % 2 = 0").select("probe", F.col("seq").cast("int").alias("seq"), "Temp")
    b = raw.where("seq % 2 = 1").select("probe", "seq", F.lit("x").alias("note"), F.lit(1).alias("flag"))
    return store.aligned_union(a, b)


@query("k5_last_stored", ("raw_dup",), "SELECT probe, t, seq, Ax FROM raw_dup QUALIFY row_number() OVER (PARTITION BY probe, t ORDER BY seq DESC) = 1")
def k5(get):
    return windows.last_stored(get("raw_dup"))


@query("k7_removed", ("raw", "intervals"), "SELECT r.probe, seq FROM raw r JOIN intervals i ON r.probe = i.probe AND i.run = 1 WHERE r.t < i.t_start")
def k7(get):
    return store.removed_from(get("raw"), get("intervals").where("run = 1").select("probe", F.col("t_start").alias("t_cut"))).select("probe", "seq")


@query("k7_shortened_log", ("load_log", "intervals"), "SELECT l.probe, l.t_start, least(l.t_end, i.t_start) AS t_end FROM load_log l JOIN intervals i ON l.probe = i.probe AND i.run = 1 WHERE l.t_start < i.t_start")
def k7b(get):
    return store.shortened_log(get("load_log"), get("intervals").where("run = 1").select("probe", F.col("t_start").alias("t_cut"))).select("probe", "t_start", "t_end")


@query("k8_new_files", ("load_log",), "SELECT probe, file, CAST(3 AS BIGINT) AS changed FROM load_log l WHERE NOT 3 <= l.changed")
def k8(get):
    log = get("load_log")
    return store.new_files(log.select("probe", "file", F.lit(3).cast("long").alias("changed")), log)


@query("k9_merged", ("raw", "intervals"), "SELECT r.probe, seq, CASE WHEN r.t < i.t_start THEN 'old' ELSE 'new' END AS src FROM raw r JOIN (SELECT probe, min(t) AS t_start FROM raw WHERE seq % 1000 > 700 AND seq > 4000 GROUP BY probe) i ON r.probe = i.probe WHERE r.t < i.t_start OR (seq % 1000 > 700 AND seq > 4000)")
def k9(get):
    raw = get("raw").select("probe", "t", "seq")
    new = raw.where("seq % 1000 > 700 and seq > 4000").withColumn("src", F.lit("new"))
    have = new.select("probe").distinct()
    return store.merged(raw.join(have, "probe", "left_semi").withColumn("src", F.lit("old")), new).select("probe", "seq", "src")


@query("k10_merged_runs", ("intervals",), "SELECT probe, 0 AS grp, min(t_start) AS t_start, arg_max(t_end, t_start) AS t_end, CAST(sum(run + 5) AS BIGINT) AS \"rows\" FROM intervals GROUP BY probe")
def k10(get):
    return store.merged_runs(get("intervals").withColumn("grp", F.lit(0)).withColumn("rows", F.col("run") + 5), "grp")


@query("k13_upserted", ("load_log",), "SELECT probe, CASE WHEN changed % 2 = 0 THEN 7.0::DOUBLE ELSE changed::DOUBLE END AS k, CASE WHEN changed % 2 = 0 AND changed <> 7 THEN CAST(50 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS k_date FROM load_log")
def k13(get):
    log = get("load_log")
    old = log.select("probe", F.col("changed").cast("double").alias("k"), F.lit(1).cast("long").alias("k_date"))
    new = log.select("probe", F.when(F.col("changed") % 2 == 0, 7.0).otherwise(float("nan")).alias("k"))
    return store.upserted(old, new, ["k"], 50)


@query("s6_stored_range", ("raw",), "SELECT probe, t, Temp FROM raw WHERE t BETWEEN 1704300000000000 AND 1704900000000000")
def s6(get):
    return store.stored_range(get("raw"), 1704300000000000, 1704900000000000, ["probe", "t", "Temp"])


@query("s8_tables_like", ("raw",), "SELECT DISTINCT probe FROM raw WHERE regexp_matches(probe, 'i0[1-4].*')")
def s8(get):
    return store.tables_like(get("raw"), "i0[1-4].*")


@query("s10_day_positions", ("raw",), f"WITH f AS (SELECT probe, CAST(floor(min(t) / {DAY}) AS BIGINT) * {DAY} AS d0, max(t) AS t1 FROM raw GROUP BY probe), m AS (SELECT probe, unnest(generate_series(d0, t1, {2 * DAY})) AS t FROM f) SELECT m.probe, m.t, (SELECT count(*) FROM raw r WHERE r.probe = m.probe AND r.t < m.t) AS row FROM m")
def s10(get):
    return store.day_positions(get("raw"), 2)


# ---- text ---------------------------------------------------------------------------------------
@query("s1_s2_l1_text", ("raw",), "SELECT seq, t // 1000000 * 1000000 AS t, Ax, Mz, CAST(12.5 AS DOUBLE) AS Temp FROM raw WHERE seq % 40 <> 0")
def s1(get):
    from ..schema import timestamp

    raw = get("raw")
    good = F.concat_ws(",", F.date_format(timestamp(F.col("t")), "yyyy,M,d,H,m,s"), *[F.col(c).cast("int").cast("string") for c in ("Ax", "Ay", "Az", "Mx", "My", "Mz")], F.lit("12.5,5.9"))
    lines = raw.select("seq", F.when(F.col("seq") % 40 == 0, F.substring(good, 1, 22)).otherwise(F.concat(F.lit("#"), good, F.lit("\x00"))).alias("value"))
    x = instruments.inclinometer(text.parsed(text.repaired(lines, text.record_pattern("i")), "i"))
    return x.select("seq", "t", F.col("Ax").cast("double").alias("Ax"), F.col("Mz").cast("double").alias("Mz"), "Temp")


@query("s2_other_kinds", ("raw",), """SELECT substr('bpdw', CAST(seq % 4 AS INTEGER) + 1, 1) AS kind, seq, t // 1000000 * 1000000 AS t, CASE WHEN seq % 4 > 0 THEN CAST(seq * 7 + 1000 AS BIGINT) END AS counts,
 CASE WHEN seq % 4 < 3 THEN Ax END AS Ax, CASE WHEN seq % 4 < 3 THEN Mz END AS Mz, CAST(12.5 AS DOUBLE) AS Temp, CAST(5.9 AS DOUBLE) AS Battery FROM raw WHERE seq % 40 >= 4""")
def s2_kinds(get):
    """Kinds b, p, d and w, written in the order of their own fields; four in forty lines are cut short."""
    raw, found = get("raw"), []
    cell = {c: F.col(c).cast("int").cast("string") for c in text.VECTOR} | {"P_counts": (F.col("seq") * 7 + 1000).cast("string"), "Temp": F.lit("12.5"), "Battery": F.lit("5.9")}
    for k, kind in enumerate("bpdw"):
        good = F.concat_ws(",", F.date_format(timestamp(F.col("t")), "yyyy,M,d,H,m,s"), *[cell[c] for c in text.KINDS[kind][len(text.DATE) :]])
        lines = raw.where(F.col("seq") % 4 == k).select("seq", F.when(F.col("seq") % 40 < 4, F.substring(good, 1, 22)).otherwise(F.concat(F.lit("@"), good, F.lit(";"))).alias("value"))
        x = instruments.inclinometer(text.parsed(text.repaired(lines, text.record_pattern(kind)), kind))
        has = lambda c, to: F.col(c).cast(to) if c in x.columns else F.lit(None).cast(to)  # noqa: B023, E731
        found.append(x.select(F.lit(kind).alias("kind"), "seq", "t", has("P_counts", "long").alias("counts"), has("Ax", "double").alias("Ax"), has("Mz", "double").alias("Mz"), "Temp", "Battery"))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


def _utm_sql() -> str:
    """L17 in SQL, in doubles: powers of the flattening are numbers."""
    f = instruments.WGS_F
    e2 = f * (2 - f)
    ep2, e1 = e2 / (1 - e2), (1 - (1 - e2) ** 0.5) / (1 + (1 - e2) ** 0.5)
    k = instruments.SCALE * instruments.WGS_A
    mu = f"(y / {k * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256)!r}::DOUBLE)"
    series = " + ".join(f"{c!r}::DOUBLE * sin({2 * n} * {mu})" for n, c in ((1, 3 * e1 / 2 - 27 * e1**3 / 32), (2, 21 * e1**2 / 16 - 55 * e1**4 / 32), (3, 151 * e1**3 / 96), (4, 1097 * e1**4 / 512)))
    return f"""WITH a AS (SELECT probe, seq, Ax * 50 + 500000 AS x, Ay * 50 + 6000000 AS y FROM raw), b AS (SELECT *, {mu} + {series} AS p FROM a),
 c AS (SELECT *, pow(tan(p), 2) AS t2, {ep2!r}::DOUBLE * cos(p) * cos(p) AS c1, {instruments.WGS_A!r}::DOUBLE / sqrt(1 - {e2!r}::DOUBLE * sin(p) * sin(p)) AS n, {instruments.WGS_A * (1 - e2)!r}::DOUBLE / pow(1 - {e2!r}::DOUBLE * sin(p) * sin(p), 1.5) AS r FROM b),
 d AS (SELECT *, (x - 500000) / (n * {instruments.SCALE!r}::DOUBLE) AS d FROM c)
SELECT probe, seq, {r6(f'degrees(p - n * tan(p) / r * (d * d / 2 - (5 + 3 * t2 + 10 * c1 - 4 * c1 * c1 - 9 * {ep2!r}::DOUBLE) * pow(d, 4) / 24 + (61 + 90 * t2 + 298 * c1 + 45 * t2 * t2 - 252 * {ep2!r}::DOUBLE - 3 * c1 * c1) * pow(d, 6) / 720))', 'lat')},
 {r6(f'degrees((d - (1 + 2 * t2 + c1) * pow(d, 3) / 6 + (5 - 2 * c1 + 28 * t2 - 3 * c1 * c1 + 8 * {ep2!r}::DOUBLE + 24 * t2 * t2) * pow(d, 5) / 120) / cos(p)) + 21', 'lon')} FROM d"""


@query("l17_utm", ("raw",), _utm_sql())
def l17(get):
    raw = get("raw").select("probe", "seq", (F.col("Ax") * 50 + 500000).alias("x"), (F.col("Ay") * 50 + 6_000_000).alias("y"))
    lat, lon = instruments.utm_to_degrees(F.col("x"), F.col("y"))
    return raw.select("probe", "seq", rounded(lat).alias("lat"), rounded(lon).alias("lon"))


@query("l12_degrees_minutes", ("raw",), f"SELECT seq, {r6('floor(P_counts / 3000 / 100 * 100 / 100) + (P_counts / 3000 - floor(P_counts / 3000 / 100) * 100) / 60', 'deg')} FROM raw")
def l12(get):
    return get("raw").select("seq", rounded(physics.degrees_minutes(F.col("P_counts") / 3000)).alias("deg"))


@query("l11_serial_day", ("raw",), f"SELECT seq, CAST(round(CAST(round(((t / 86400000000.0::DOUBLE + {instruments.SERIAL_DAY_0}::DOUBLE) - {instruments.SERIAL_DAY_0}::DOUBLE) * 86400000000.0::DOUBLE) AS BIGINT) / 1000000) AS BIGINT) AS s FROM raw")
def l11(get):
    """Times as serial days and back, in whole seconds. A DOUBLE holds serial days of today to some ten microseconds, so a time that near to
    half a second may go to either side: the SQL goes by the same days and the same whole microseconds."""
    return get("raw").select("seq", F.round(instruments.serial_day(F.col("t") / F.lit(86400000000.0) + instruments.SERIAL_DAY_0) / 1000000).cast("long").alias("s"))


@query("l19_carried_forward", ("raw",), "SELECT seq, last_value(CASE WHEN seq % 9 <> 0 THEN t END IGNORE NULLS) OVER (PARTITION BY probe ORDER BY seq ROWS UNBOUNDED PRECEDING) AS t FROM raw")
def l19(get):
    return instruments.carried_forward(get("raw").withColumn("t", F.when(F.col("seq") % 9 != 0, F.col("t")))).select("seq", "t")


@query("l20_tweaked", ("raw",), "SELECT seq, Temp + 1.5 AS Temp, Ax * 2 + Ay AS s FROM raw")
def l20(get):
    return instruments.tweaked(get("raw"), {"Temp_add": 1.5, "s_fun": "Ax * 2 + Ay"}).select("seq", "Temp", "s")


@query("l14_first_per_time", ("raw_dup",), "SELECT probe, seq FROM raw_dup QUALIFY row_number() OVER (PARTITION BY probe, t ORDER BY seq) = 1")
def l14(get):
    return instruments.first_per_time(get("raw_dup")).select("probe", "seq")


@query("s4_edge_rows", ("raw",), "SELECT concat(probe, '.csv') AS file, count(*) AS \"rows\", arg_min(t, seq) AS first_t, arg_min(Temp, seq) AS first_Temp, arg_max(t, seq) AS last_t, arg_max(Temp, seq) AS last_Temp FROM raw GROUP BY probe")
def s4(get):
    return text.edge_rows(get("raw"), F.concat("probe", F.lit(".csv")), ["t", "Temp"])


@query("s5_discovered", ("load_log",), "SELECT concat('/d/', probe, '.csv') AS path, probe FROM load_log WHERE changed % 2 <> 0")
def s5(get):
    ending = F.when(F.col("changed") % 2 == 0, "coef.csv").otherwise(".csv")
    return text.discovered(get("load_log").select(F.concat(F.lit("/d/"), "probe", ending).alias("path"))).select("path", "probe")


# ---- recovery and calibration -------------------------------------------------------------------
@query("p10_recovered_overscale", ("raw",), f"SELECT probe, seq, {r6('CASE WHEN seq % 17 = 0 THEN sqrt(greatest(0.0, m - Ay * Ay - Az * Az)) ELSE Ax END', 'Ax')} FROM (SELECT *, max(CASE WHEN seq % 17 <> 0 THEN Ax * Ax + Ay * Ay + Az * Az END) OVER (PARTITION BY probe) AS m FROM raw)")
def p10(get):
    x = get("raw").withColumn("overscaled", F.col("seq") % 17 == 0)
    return velocity.recovered_overscale(x, "Ax", ("Ay", "Az")).select("probe", "seq", *rd("Ax"))


@query("p11_recovered_magnetometer", ("raw",), f"""WITH g AS (SELECT probe, t, seq, CASE WHEN seq % 19 <> 0 THEN Mx END AS Hx, My AS Hy, Mz AS Hz FROM raw), m AS (SELECT probe, median(sqrt(Hx * Hx + Hy * Hy + Hz * Hz)) AS h FROM g GROUP BY probe),
 s AS (SELECT *, coalesce(sign(last_value(Hx IGNORE NULLS) OVER (PARTITION BY probe ORDER BY t, seq ROWS UNBOUNDED PRECEDING)), 1) AS k FROM g)
SELECT s.probe, seq, {r6('coalesce(Hx, sqrt(greatest(0.0, h * h - Hy * Hy - Hz * Hz)) * k)', 'Hx')} FROM s JOIN m ON s.probe = m.probe""")
def p11(get):
    x = get("raw").select("probe", "t", "seq", F.when(F.col("seq") % 19 != 0, F.col("Mx")).alias("Hx"), F.col("My").alias("Hy"), F.col("Mz").alias("Hz"))
    return velocity.recovered_magnetometer(x).select("probe", "seq", *rd("Hx"))


@query("a13_calibrated", ("sphere_off",), f"SELECT DISTINCT probe, {_CENTRE.format('b', 'b', 'b')}, {_GAINS} FROM sphere_off")
def a13(get):
    """All ten limits; the points that are off go, and the fit is that of the points that are not. Cells are so fine that
    a point's is its own: the mean of two points lies inside the sphere."""
    f = calibrate.calibrated(get("sphere_off"), bins=1 << 24)
    return f.select("probe", *[rounded(F.col("b")[i]).alias(f"b{i}") for i in range(3)], *[rounded(F.col("A")[i][i]).alias(f"A{i}{i}") for i in range(3)])


# ---- stores that are written and read again -----------------------------------------------------
@query("k1_files", ("raw",), _FORMATTED)
def k1_files(get):
    raw = get("raw")
    spark, path = raw.sparkSession, scratch_path(raw.sparkSession, "tsv")
    store.write_tsv(raw, path, ["Temp"], 0)
    return spark.read.option("sep", "\t").option("header", True).csv(path).select("probe", "Time", F.col("Temp").cast("double").alias("Temp"))


@query("k6_sorted_store", ("raw",), "SELECT probe, t, seq, Temp FROM raw")
def k6(get):
    raw = get("raw").select("probe", "t", "seq", "Temp")
    path = scratch_path(raw.sparkSession, "sorted")
    store.sorted_store(raw, path)
    return raw.sparkSession.read.parquet(path)


@query("k6_sorted_order", ("raw",), "SELECT probe, t, row_number() OVER (PARTITION BY probe ORDER BY t) AS place FROM raw")
def k6_order(get):
    """The places of rows in the files, file by file: those of their times."""
    raw = get("raw").select("probe", "t", "seq", "Temp")
    path = scratch_path(raw.sparkSession, "sorted")
    store.sorted_store(raw, path)
    rows = raw.sparkSession.read.parquet(path).select("probe", "t", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    # Files are few rows of counts; a row's place is its own in the file behind the probe's rows in files before.
    own = rows.groupBy("probe", "file").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("probe").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(own.withColumn("before", before), ["probe", "file"]).select("probe", "t", (F.col("before") + F.col("at") - F.col("first") + 1).alias("place"))


@query("k11_staged", ("raw", "load_log"), "SELECT r.probe, r.seq FROM raw r JOIN load_log l ON r.probe = l.probe WHERE NOT 3 <= l.changed")
def k11(get):
    raw, log = get("raw"), get("load_log")
    path = scratch_path(raw.sparkSession, "stage")
    store.append(raw.where("false").select("probe", "t", "seq"), path)
    wanted = log.select("probe", "file", F.lit(3).cast("long").alias("changed"))
    return store.staged(raw.sparkSession, path, wanted, log, lambda new: raw.join(new.select("probe").distinct(), "probe", "left_semi").select("probe", "t", "seq")).select("probe", "seq")


# ---- streams ------------------------------------------------------------------------------------
#: What the watermark has passed once all rows are read: ten minutes before the last one.
_LATE = "e AS (SELECT max(t) - 600000000 AS late FROM raw)"
GAP = 4 * HOUR + 1000


def streamed(name: str, sql: str):
    """A stream over the events that are there now, run to its end; the query is what it wrote."""

    def add(f: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # A stream needs a folder or a pattern: a lone file's path is no base path.
            path = f"{sf_dir}/events*.parquet"
            events = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(path)
            probe = F.concat(F.lit("i"), F.lpad((F.col("user_id") % 10).cast("string"), 2, "0")).alias("probe")
            out = f(events.select(probe, "ts", F.col("event_id").alias("seq"), ((F.col("event_id") % 1500).cast("double") / 100 + 5).alias("Temp")))
            return streaming.run_to_end(out, scratch_path(spark, name), scratch_path(spark, f"{name}-state"))

        QUERIES[name] = run
        ORACLES[name] = ctes("raw") + (", " + sql[5:] if sql.startswith("WITH ") else "\n" + sql)
        return f

    return add


@query("r1_ingest", ("raw",), "SELECT probe, CAST(seq AS DOUBLE) AS seq, Temp FROM raw")
def r1(get):
    raw = get("raw")
    spark = raw.sparkSession
    path = scratch_path(spark, "arrived")
    raw.select("probe", "seq", "Temp").write.csv(path)
    return streaming.run_to_end(streaming.ingest(spark, path, "probe(text),seq,Temp"), scratch_path(spark, "ingested"), scratch_path(spark, "ingest-state"))


@streamed("r2_resolved_times", f"SELECT probe, seq, h + (row_number() OVER (PARTITION BY probe, h ORDER BY seq) - 1) * 10000000 AS t FROM (SELECT probe, seq, CAST(floor(t / {HOUR}) AS BIGINT) * {HOUR} AS h FROM raw)")
def r2(stream):
    return streaming.resolved_times(stream.withColumn("ts", F.date_trunc("hour", "ts")), 0.1)


@streamed("r3_bins", f"WITH {_LATE} SELECT probe, t, n AS \"rows\", {r6('Temp')} FROM (SELECT probe, CAST(floor(t / {HOUR}) AS BIGINT) * {HOUR} AS t, count(*) AS n, avg(Temp) AS Temp FROM raw GROUP BY 1, 2), e WHERE t + {HOUR} <= late")
def r3(stream):
    return streaming.bins(stream, 3600, ["Temp"]).select("probe", micros(F.col("ts")).alias("t"), "rows", *rd("Temp"))


@streamed("r4_sliding", f"WITH {_LATE} SELECT probe, w_start, count(*) AS n, arg_min(Temp, t) AS first_value, arg_max(Temp, t) AS last_value FROM (SELECT probe, t, Temp, unnest([(CAST(floor(t / {12 * HOUR}) AS BIGINT) - 1) * {12 * HOUR}, CAST(floor(t / {12 * HOUR}) AS BIGINT) * {12 * HOUR}]) AS w_start FROM raw), e WHERE w_start + {DAY} <= late GROUP BY 1, 2")
def r4(stream):
    s = streaming.sliding(stream, 86400, 43200, "Temp")
    return s.select("probe", micros(F.col("w_start")).alias("w_start"), F.size("values").cast("long").alias("n"), F.element_at("values", 1).alias("first_value"), F.element_at("values", -1).alias("last_value"))


@streamed("r5_sessions", f"""WITH {_LATE}, d AS (SELECT probe, t, sum(CASE WHEN t - l > {GAP} THEN 1 ELSE 0 END) OVER (PARTITION BY probe ORDER BY t, seq) AS k FROM (SELECT probe, t, seq, lag(t) OVER (PARTITION BY probe ORDER BY t, seq) AS l FROM raw))
SELECT probe, min(t) AS t_start, max(t) + {GAP} AS t_end, count(*) AS "rows" FROM d, e GROUP BY probe, k, late HAVING max(t) + {GAP} <= late""")
def r5(stream):
    s = streaming.sessions(stream, f"{GAP // 1000} milliseconds")
    return s.select("probe", micros(F.col("t_start")).alias("t_start"), micros(F.col("t_end")).alias("t_end"), "rows")


# ---- formats: times are written as an instrument would and read back -------------------------------
def _written(t: str, pattern: str):
    return F.date_format(timestamp(F.col(t)), pattern)


#: form -> date pattern, time pattern, what the time is cut to.
_FORMS = {
    "idronaut": ("dd-MM-yyyy", "HH:mm:ss.SS", 10_000), "sbe": ("MM/dd/yyyy", "HH:mm:ss", SECOND), "sst": ("dd.MM.yyyy", "HH:mm:ss", SECOND), "rock": ("yyyy-MM-dd", "HH:mm:ss", SECOND),
    "ctd_us": ("M/d/yyyy", "H:mm:ss", SECOND), "ctd_eu": ("d.M.yyyy", "H:mm", 60 * SECOND), "log": ("dd.MM.yyyy", "HH:mm:ss", SECOND),
}


@query("l3_l10_dated_logs", ("raw",), " UNION ALL ".join(f"SELECT probe, seq, '{form}' AS form, t // {cut} * {cut} AS t FROM raw" for form, (_, _, cut) in _FORMS.items()))
def l3_l10(get):
    out = None
    for form, (date, time, _) in _FORMS.items():
        quote = F.lit('"' if form.startswith("ctd") else "")
        rows = get("raw").select("probe", "seq", F.concat(quote, _written("t", date), quote).alias("Date"), F.concat(quote, _written("t", time), quote).alias("Time"))
        part = instruments.dated_log(rows, form).select("probe", "seq", F.lit(form).alias("form"), "t")
        out = part if out is None else out.unionByName(part)
    return out


@query("l2_iso_log", ("raw",), "SELECT probe, seq, t // 1000000 * 1000000 AS t FROM raw")
def l2(get):
    return instruments.iso_log(get("raw").withColumn("Time", _written("t", "yyyy-MM-dd'T'HH:mm:ss"))).select("probe", "seq", "t")


@query("l5_day_and_milliseconds", ("raw",), "SELECT probe, seq, t // 1000 * 1000 AS t FROM raw")
def l5(get):
    ms = F.floor(F.col("t") % DAY / 1000).cast("string").cast("binary")
    return get("raw").select("probe", "seq", instruments.day_and_milliseconds(_written("t", "dd.MM.yyyy").cast("binary"), ms).alias("t"))


@query("l6_l13_time_only", ("raw",), f"""WITH s AS (SELECT probe, seq, (t % {DAY}) // 1000000 * 1000000 AS s, min(t) OVER (PARTITION BY probe) // {DAY} * {DAY} AS d0 FROM raw), l AS (SELECT *, lag(s) OVER (PARTITION BY probe ORDER BY seq) AS l FROM s)
SELECT probe, seq, CAST(d0 + s + {DAY} * sum(CASE WHEN s < l - {DAY // 2} THEN 1 ELSE 0 END) OVER (PARTITION BY probe ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS t FROM l""")
def l6(get):
    raw = get("raw")
    files = raw.groupBy("probe").agg(F.min("t").alias("t0")).select("probe", F.concat(F.lit("runs/"), "probe", F.lit("/sst_"), _written("t0", "yyMMdd"), F.lit(".txt")).alias("path"))
    rows = raw.select("probe", "seq", _written("t", "HH:mm:ss").alias("Time")).join(files, "probe")
    return instruments.time_only(rows, instruments.file_day(F.col("path"))).select("probe", "seq", "t")


@query("l6_t5_day_jumps", ("raw",), f"""WITH s AS (SELECT probe, seq, (t % {DAY}) // 1000000 * 1000000 + min(t) OVER (PARTITION BY probe) // {DAY} * {DAY} AS t FROM raw), d AS (SELECT *, t - lag(t) OVER (PARTITION BY probe ORDER BY seq) AS d FROM s),
 m AS (SELECT probe, 10 * greatest(median(d), 1000000) AS tol FROM d GROUP BY probe),
 j AS (SELECT d.*, CASE WHEN d > {DAY} - tol AND d <= {DAY} + tol THEN 1 WHEN d < -{DAY} + tol AND d >= -{DAY} - tol THEN -1 END AS j FROM d JOIN m USING (probe)),
 n AS (SELECT *, sum(abs(j)) OVER w AS n, last_value(j IGNORE NULLS) OVER w AS sign FROM j WINDOW w AS (PARTITION BY probe ORDER BY seq ROWS UNBOUNDED PRECEDING))
SELECT probe, seq, CAST(t - CASE WHEN n % 2 = 1 THEN sign * {DAY} ELSE 0 END AS BIGINT) AS t FROM n""")
def l6_jumps(get):
    raw = get("raw")
    files = raw.groupBy("probe").agg(F.min("t").alias("t0")).select("probe", F.concat(F.lit("runs/"), "probe", F.lit("/sst_"), _written("t0", "yyMMdd"), F.lit(".txt")).alias("path"))
    rows = raw.select("probe", "seq", _written("t", "HH:mm:ss").alias("Time")).join(files, "probe")
    return instruments.time_only_by_jumps(rows, instruments.file_day(F.col("path"))).select("probe", "seq", "t")


@query("l7_degrees_minutes_seconds", ("raw",), f"SELECT seq, {r9('seq % 90 + (seq % 60) / 60.0::DOUBLE + (seq % 600) / 10.0::DOUBLE / 3600', 'deg')} FROM raw")
def l7(get):
    words = F.concat((F.col("seq") % 90).cast("string"), F.lit("°"), (F.col("seq") % 60).cast("string"), F.lit("'"), (F.col("seq") % 600 / 10).cast("string"), F.lit('"N'))
    return get("raw").select("seq", rounded(instruments.dms(words), 9).alias("deg"))


_LAT, _LON = "((seq % 90) + (seq % 600) / 10.0::DOUBLE / 60)", "((seq % 180) + (seq % 60) / 60.0::DOUBLE)"
_SIDED = f"{r9(f'{_LAT} * CASE WHEN seq % 2 = 0 THEN -1 ELSE 1 END', 'Lat')}, {r9(f'{_LON} * CASE WHEN seq % 3 = 0 THEN -1 ELSE 1 END', 'Lon')}"


def _sided(get, name: str) -> DataFrame:
    seq = F.col("seq")
    sides = {"NS": F.when(seq % 2 == 0, "S").otherwise("N"), "EW": F.when(seq % 3 == 0, "W").otherwise("E")}
    return get(name).withColumns({"Lat": (seq % 90 * 100).cast("double") + seq % 600 / 10, "Lon": (seq % 180 * 100 + seq % 60).cast("double"), "Depth": F.col("Ax"), **sides})


@query("l12_navigation", ("raw",), f"SELECT probe, seq, t // 1000000 * 1000000 AS t, {_SIDED}, Ax + 2.5 AS Depth FROM raw")
def l12_navigation(get):
    rows = _sided(get, "raw").withColumns({"Date": _written("t", "yy MM dd"), "Time": _written("t", "HH mm ss")})
    return instruments.navigation(rows, 2.5).select("probe", "seq", "t", rounded("Lat", 9).alias("Lat"), rounded("Lon", 9).alias("Lon"), "Depth")


@query("l14_echo_sounder", ("raw_dup",), f"SELECT probe, seq, {_SIDED}, -Ax + 0.0 AS Depth FROM raw_dup QUALIFY row_number() OVER (PARTITION BY probe, t ORDER BY seq) = 1")
def l14_echo(get):
    rows = _sided(get, "raw_dup")
    rows = rows.withColumns({"Lat": F.concat_ws(",", F.col("Lat").cast("string"), "NS"), "Lon": F.concat_ws(",", F.col("Lon").cast("string"), "EW")})
    return instruments.echo_sounder(rows).select("probe", "seq", rounded("Lat", 9).alias("Lat"), rounded("Lon", 9).alias("Lon"), (F.col("Depth") + 0.0).alias("Depth"))


@query("l15_packed_clock", ("raw",), "SELECT probe, seq, t // 10000 * 10000 AS t FROM raw")
def l15(get):
    return get("raw").select("probe", "seq", instruments.packed_clock(_written("t", "ddMMyyyy"), _written("t", "HHmmss.SS")).alias("t"))


@query("l16_adcp_clock", ("raw",), "SELECT probe, seq, t // 10000 * 10000 AS t FROM raw")
def l16(get):
    parts = [_written("t", p).cast("int") for p in ("yy", "M", "d", "H", "m", "s")]
    return get("raw").select("probe", "seq", instruments.adcp_clock(*parts, F.floor(F.col("t") % SECOND / 10_000)).alias("t"))


@query("l18_accelerations", ("raw",), f"""WITH g AS (SELECT probe, seq, sqrt(Ax * Ax + Ay * Ay + Az * Az) / 9.8 - 1 AS g, row_number() OVER w - 1 AS i, lag(sqrt(Ax * Ax + Ay * Ay + Az * Az) / 9.8 - 1) OVER w AS b, lead(sqrt(Ax * Ax + Ay * Ay + Az * Az) / 9.8 - 1) OVER w AS a FROM raw WINDOW w AS (PARTITION BY probe ORDER BY t, seq))
SELECT probe, seq, {r6('(0.5 * g + coalesce(0.25 * b, 0) + coalesce(0.25 * a, 0)) / (0.5 + CASE WHEN b IS NULL THEN 0 ELSE 0.25 END + CASE WHEN a IS NULL THEN 0 ELSE 0.25 END)', 'GsumMinus1')} FROM g WHERE i % 3 = 0""")
def l18(get):
    rows = get("raw").select("probe", "t", "seq", F.col("Ax").alias("Gx"), F.col("Ay").alias("Gy"), F.col("Az").alias("Gz"))
    return instruments.accelerations(rows, [0.25, 0.5, 0.25], 3).select("probe", "seq", *rd("GsumMinus1"))


@query("s3_declared_csv", ("raw",), "SELECT probe, CAST(seq AS DOUBLE) AS seq, Ax, Temp FROM raw")
def s3(get):
    raw = get("raw").select("probe", "seq", "Ax", "Ay", "Temp")
    path = scratch_path(raw.sparkSession, "declared")
    raw.write.option("sep", ";").csv(path)
    return text.read_csv(raw.sparkSession, path, "probe(text);seq;Ax(float);;Temp", delimiter=";", columns=["probe", "seq", "Ax", "Temp"])


# ---- more numeric forms ---------------------------------------------------------------------------
#: The offset keeps values of few rows off the middle between two roundings.
_P = "(1.50000003 + 0.01 * Temp) + (0.002 + 0.00001 * Temp) * P_counts"


def _tenth(seconds: int, what: str, source: str) -> str:
    return f"(SELECT * FROM (SELECT *, avg(n) OVER (PARTITION BY probe) AS m FROM (SELECT probe, CAST(floor(t / {seconds}000000) AS BIGINT) * {seconds}000000 AS t, count(*) AS n, {what} FROM {source} GROUP BY 1, 2)) WHERE n > m / 10)"


@query("a3_short_bins", ("raw",), f"""SELECT probe, t, 2 AS bin_s, {r6(_P, 'Pressure')} FROM {_tenth(2, 'avg(P_counts) AS P_counts, avg(Temp) AS Temp', 'raw')}
 UNION ALL SELECT probe, t, 7200 AS bin_s, {r6('Pressure')} FROM {_tenth(7200, f'avg({_P}) AS Pressure', 'raw')}""")
def a3_short(get):
    physical = lambda x: x.withColumn("Pressure", physics.pressure(F.col("P_counts"), F.col("Temp"), [[1.50000003, 0.01], [0.002, 0.00001]]))
    found = aggregates.binned_counts_or_physics(get("raw"), (2, 7200), ["P_counts", "Temp"], physical, ["Pressure"])
    return found.select("probe", "t", "bin_s", *rd("Pressure"))


@query("a11_flat_channel", ("sphere",), f"SELECT probe, {r6('2 / (max(x) - min(x))', 'A00')}, {r6('2 / (max(y) - min(y))', 'A11')}, 0.0::DOUBLE AS A22, {r6('(max(x) + min(x)) / 2', 'b0')}, 0.5::DOUBLE AS b2 FROM sphere GROUP BY probe")
def a11(get):
    f = calibrate.fit_ellipsoid(get("sphere").withColumn("z", F.lit(0.5)))
    return f.select("probe", *[rounded(F.col("A")[i][i]).alias(f"A{i}{i}") for i in range(3)], *[rounded(F.col("b")[i]).alias(f"b{i}") for i in (0, 2)])


@query("a12_ellipse", ("sphere",), "SELECT DISTINCT probe, 0.1::DOUBLE AS c0, -0.2::DOUBLE AS c1, 0.9::DOUBLE AS r0, 1.2::DOUBLE AS r1 FROM sphere")
def a12_ellipse(get):
    angle = F.atan2("y", "x")
    f = calibrate.fit_axes(get("sphere").select("probe", (F.cos(angle) * 1.2 + 0.1).alias("x"), (F.sin(angle) * 0.9 - 0.2).alias("y")), ("x", "y"), 5)
    return f.select("probe", *[rounded(F.col("centre")[i]).alias(f"c{i}") for i in range(2)], *[rounded(F.col("radii")[i]).alias(f"r{i}") for i in range(2)])


@query("p16_azimuth", ("days",), f"SELECT probe, k, {r6('k % 360 + CASE WHEN k % 2 = 0 THEN 1.5 ELSE 0 END + CASE WHEN k % 3 < 2 THEN (54 + k % 3) * 0.1::DOUBLE + 20 * 0.01::DOUBLE ELSE 0 END', 'azimuth_shift_deg')} FROM days")
def p16(get):
    k = F.col("k")
    sites = get("days").select("probe", "k", (k % 360).cast("double").alias("azimuth_shift_deg"), F.when(k % 2 == 0, 1.5).alias("azimuth_add"), (k % 3 + 54.3).alias("lat"), F.lit(19.8).alias("lon"), F.lit(2024).alias("year"))
    known = sites.where("lat < 56").select(F.round("lat").cast("int").alias("lat"), F.lit(20).alias("lon"), "year").distinct()
    look = known.withColumn("declination", F.col("lat") * 0.1 + F.col("lon") * 0.01)
    return velocity.azimuth(sites, look).select("probe", "k", *rd("azimuth_shift_deg"))


@query("p18_imported_speed", ("load_log",), "SELECT probe, CASE WHEN changed % 2 = 0 THEN \"rows\" * 0.5::DOUBLE ELSE 10.0::DOUBLE END AS k0, CASE WHEN changed % 2 = 0 THEN 3 ELSE 6 END AS terms, CASE WHEN changed % 2 = 0 THEN 60.0::DOUBLE ELSE 70.0::DOUBLE END AS limit_deg, changed % 2 = 0 AS turned FROM load_log")
def p18(get):
    log = get("load_log")
    fitted = log.where("changed % 2 = 0").select("probe", F.array(F.col("rows") * F.lit(0.5), F.lit(2.0)).alias("k"), F.lit(60.0).alias("limit_deg"), F.array(F.array(F.lit(1.0))).alias("Rz"))
    c = calibrate.imported_speed(coefs(log.sparkSession, log), fitted)
    return c.select("probe", F.col("kVabs")[0].alias("k0"), F.size("kVabs").alias("terms"), F.element_at("kVabs", -1).alias("limit_deg"), F.col("Rz").isNotNull().alias("turned"))


_END = "CASE WHEN {d1} IS NULL THEN {d0} WHEN sign(((2 * {h0} + {h1}) * {d0} - {h0} * {d1}) / ({h0} + {h1})) <> sign({d0}) THEN 0 WHEN sign({d0}) <> sign({d1}) AND abs(((2 * {h0} + {h1}) * {d0} - {h0} * {d1}) / ({h0} + {h1})) > 3 * abs({d0}) THEN 3 * {d0} ELSE ((2 * {h0} + {h1}) * {d0} - {h0} * {d1}) / ({h0} + {h1}) END"


@query("t11_monotone_grid", ("raw",), f"""WITH k AS (SELECT probe, t, arg_max(Temp, seq) AS y FROM raw GROUP BY probe, t),
 a AS (SELECT *, (lead(t) OVER w - t)::DOUBLE AS h, lead(y) OVER w AS y2, min(t) OVER (PARTITION BY probe) AS t0 FROM k WINDOW w AS (PARTITION BY probe ORDER BY t)), b AS (SELECT *, (y2 - y) / h AS d FROM a),
 c AS (SELECT *, lag(h) OVER w AS hb, lag(d) OVER w AS db, lead(h) OVER w AS ha, lead(d) OVER w AS da, lag(h, 2) OVER w AS hc, lag(d, 2) OVER w AS dc FROM b WINDOW w AS (PARTITION BY probe ORDER BY t)),
 e AS (SELECT *, CASE WHEN db IS NULL THEN {_END.format(h0='h', d0='d', h1='ha', d1='da')} WHEN d IS NULL THEN {_END.format(h0='hb', d0='db', h1='hc', d1='dc')} WHEN d * db <= 0 THEN 0 ELSE 3 * (h + hb) / ((2 * h + hb) / db + (h + 2 * hb) / d) END AS m FROM c),
 f AS (SELECT *, lead(m) OVER (PARTITION BY probe ORDER BY t) AS m2 FROM e), g AS (SELECT probe, unnest(generate_series(min(t), max(t), {6 * HOUR})) AS mark FROM k GROUP BY probe),
 j AS (SELECT g.probe, g.mark, f.y, f.y2, f.h, f.m, f.m2, (g.mark - f.t) / f.h AS u FROM g ASOF JOIN f ON g.probe = f.probe AND g.mark >= f.t)
SELECT probe, mark AS t, {r6('CASE WHEN h IS NULL OR u = 0 THEN y ELSE y * (1 + 2 * u) * (1 - u) * (1 - u) + h * m * u * (1 - u) * (1 - u) + y2 * u * u * (3 - 2 * u) + h * m2 * u * u * (u - 1) END', 'Temp')} FROM j""")
def t11_monotone(get):
    return timefix.monotone_grid(get("raw"), 6 * HOUR, "Temp").select("probe", "t", *rd("Temp"))


# ---- whole steps ----------------------------------------------------------------------------------
def _despiked_sql(source: str, limits: dict[str, float], keep: str) -> str:
    """W3 of several channels: tables sp, hole and w3, the last with the channels despiked."""
    near = ", ".join(f"lag({c}) OVER w AS l_{c}, lead({c}) OVER w AS n_{c}" for c in limits)

    def step(d: str, edge: str, up: bool, most: float) -> str:
        return f"({edge} OR coalesce({d} {'> ' if up else '< -'}{most}, false))"

    def spike(c: str, most: float) -> str:
        a, b = f"{c} - l_{c}", f"n_{c} - {c}"
        return f"({step(a, 'i = 1', True, most)} AND {step(b, 'i = m', False, most)} OR {step(a, 'i = 1', False, most)} AND {step(b, 'i = m', True, most)})"

    held = ", ".join(f"CASE WHEN NOT {spike(c, most)} THEN {c} END AS y_{c}" for c, most in limits.items())
    known = ", ".join(f"last_value(CASE WHEN y_{c} IS NOT NULL THEN i END IGNORE NULLS) OVER a AS pi_{c}, last_value(y_{c} IGNORE NULLS) OVER a AS py_{c}, first_value(CASE WHEN y_{c} IS NOT NULL THEN i END IGNORE NULLS) OVER b AS ni_{c}, first_value(y_{c} IGNORE NULLS) OVER b AS ny_{c}" for c in limits)
    line = ", ".join(f"CASE WHEN y_{c} IS NOT NULL THEN y_{c} WHEN pi_{c} IS NULL THEN ny_{c} WHEN ni_{c} IS NULL THEN py_{c} ELSE py_{c} + (ny_{c} - py_{c}) * ((i - pi_{c})::DOUBLE / (ni_{c} - pi_{c})) END AS {c}" for c in limits)
    return f"""sp AS (SELECT *, {near}, row_number() OVER w AS i, count(*) OVER (PARTITION BY probe) AS m FROM {source} WINDOW w AS (PARTITION BY probe ORDER BY t NULLS FIRST, seq)),
 hole AS (SELECT {keep}, i, {held} FROM sp), known AS (SELECT *, {known} FROM hole WINDOW a AS (PARTITION BY probe ORDER BY i ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY probe ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 w3 AS (SELECT {keep}, {line} FROM known)"""


_COUNT_LIMITS = {"Ax": 1500.0, "Ay": 1500.0, "Az": 1500.0, "Mx": 100.0, "My": 100.0, "Mz": 100.0}
#: Spikes, over-scaled rows, rows without a time; i03 has no Mx, i05 hardly any Mz, i07 neither My nor Mz.
_HARD = """hard AS (SELECT probe, CASE WHEN seq % 389 = 7 THEN NULL ELSE t END AS t, seq, CASE WHEN seq % 97 = 0 THEN Ax + 20000 ELSE Ax * 0.2::DOUBLE END AS Ax, Ay * 0.2::DOUBLE AS Ay,
 CASE WHEN seq % 101 < 3 THEN -32624 ELSE Az END AS Az, CASE WHEN probe = 'i03' THEN NULL ELSE Mx * 0.1::DOUBLE END AS Mx, CASE WHEN probe = 'i07' THEN NULL ELSE My * 0.1::DOUBLE END AS My,
 CASE WHEN probe = 'i07' OR (probe = 'i05' AND seq % 20000 > 100) THEN NULL ELSE 500 + Mz * 0.1::DOUBLE END AS Mz FROM raw)"""
_FULL = f"""WITH {_HARD}, raws AS (SELECT *, Az IS NOT NULL AND Az = -32624 AS over FROM hard),
 {_despiked_sql('raws', _COUNT_LIMITS, 'probe, t, seq, over')},
 n AS (SELECT *, Ax * {GAIN_A} AS gx, Ay * {GAIN_A} AS gy, Az * {GAIN_A} AS gz, sqrt((Mx * Mx + My * My + Mz * Mz)) * {GAIN_M} - 1 AS hn FROM w3),
 md AS (SELECT probe AS mp, median(CASE WHEN hn < 8 THEN hn END) AS hm, avg(CASE WHEN Mx IS NULL AND (My IS NOT NULL OR Mz IS NOT NULL) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS wanted, count(CASE WHEN My IS NOT NULL AND Mz IS NOT NULL THEN 1 END) AS yz,
  avg(CASE WHEN over AND gx * gx + gy * gy > 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS share, avg(CASE WHEN over AND gx * gx + gy * gy > 1 THEN gx * gx + gy * gy END) AS mean, max(CASE WHEN over THEN gx * gx + gy * gy END) AS most FROM n GROUP BY probe),
 w AS (SELECT *, CASE WHEN share > 0.001 THEN CASE WHEN most = mean THEN 1.0::DOUBLE WHEN most - mean < (most - 1) / 2 THEN mean ELSE most END ELSE 1.0::DOUBLE END AS whole,
  hm IS NULL OR (abs(hm) > 0.5 AND wanted > 0.95) AS anew, CASE WHEN hm IS NULL OR (abs(hm) > 0.5 AND wanted > 0.95) THEN 1.0::DOUBLE ELSE hm + 1 END AS h FROM n JOIN md ON probe = mp),
 r AS (SELECT * EXCLUDE (gz, Mx), CASE WHEN over THEN sqrt(greatest(0.0, whole - CASE WHEN gx * gx + gy * gy > 1 AND NOT (share > 0.001 AND whole = most) THEN whole ELSE gx * gx + gy * gy END)) ELSE gz END AS gz,
  abs(sqrt(gx * gx + gy * gy + gz * gz) - 1) > 1 AND NOT over AS bad,
  CASE WHEN Mx IS NOT NULL AND NOT anew THEN Mx ELSE -sqrt(abs(h * h - (My * My + Mz * Mz) * {GAIN_M} * {GAIN_M})) / {GAIN_M} END AS Mx FROM w),
 g AS (SELECT *, count(Mx) OVER p <= 0.01 * (count(*) OVER p - count(Mx) OVER p) AS lx, count(My) OVER p <= 0.01 * (count(*) OVER p - count(My) OVER p) AS ly, count(Mz) OVER p <= 0.01 * (count(*) OVER p - count(Mz) OVER p) AS lz FROM r WINDOW p AS (PARTITION BY probe)),
 q AS (SELECT *, CASE WHEN NOT bad THEN atan2(sqrt(gx * gx + gy * gy), gz) END AS a, CASE WHEN NOT lx THEN Mx * {GAIN_M} END AS hx, CASE WHEN NOT ly THEN My * {GAIN_M} END AS hy, CASE WHEN NOT lz THEN Mz * {GAIN_M} END AS hz,
  (lx AND Mx IS NULL) OR (ly AND My IS NULL) OR (lz AND Mz IS NULL) AS unset FROM g), fo AS (SELECT *, sqrt(tan(a) / cos(a)) AS f FROM q)
SELECT probe, t, seq, {r6(_by_force('f'), 'Vabs')}, {r6(f'CASE WHEN yz = 0 THEN {AZIMUTH} - degrees(atan2(gx, gy)) WHEN NOT unset OR coalesce(sqrt(hx * hx + hy * hy + hz * hz) - 1 < 8, false) THEN {AZIMUTH} - degrees(atan2((gx * hy - gy * hx) * sqrt(gx * gx + gy * gy + gz * gz), hz * (gx * gx + gy * gy) - gz * (gx * hx + gy * hy))) ELSE 0.0::DOUBLE END', 'Vdir')}, {r6('degrees(a)', 'inclination')} FROM fo"""


def _hard(get) -> DataFrame:
    c, raw = F.col, get("raw")
    own = c("probe")
    return raw.select(
        "probe", F.when(c("seq") % 389 != 7, c("t")).alias("t"), "seq", F.when(c("seq") % 97 == 0, c("Ax") + 20000).otherwise(c("Ax") * 0.2).alias("Ax"), (c("Ay") * 0.2).alias("Ay"),
        F.when(c("seq") % 101 < 3, -32624.0).otherwise(c("Az")).alias("Az"), F.when(own != "i03", c("Mx") * 0.1).alias("Mx"), F.when(own != "i07", c("My") * 0.1).alias("My"),
        F.when((own != "i07") & ~((own == "i05") & (c("seq") % 20000 > 100)), 500 + c("Mz") * 0.1).alias("Mz"))


QUERIES["p12_full"] = lambda spark, d: _p12_full(lambda n: table(spark, d, n))
ORACLES["p12_full"] = ctes("raw") + ", " + _FULL[5:]


def _p12_full(get) -> DataFrame:
    """P12 with its defaults: despiking, over-scaled gravity, lost and unrecoverable magnetometers, rows without a time."""
    x = _hard(get)
    return velocity.recovered_velocity(x, coefs(x.sparkSession, x), force_coefs=FORCE).select("probe", "t", "seq", *rd("Vabs", "Vdir", "inclination"))


@query("w13_gradient", ("raw",), f"""WITH s AS (SELECT probe, t, seq, sqrt(greatest(0.0, 1 - x * x - y * y)) AS s FROM (SELECT probe, t, seq, Ax / 2500 AS x, Ay / 2500 AS y FROM raw)),
 d AS (SELECT *, coalesce(s - lag(s) OVER w, 0) AS d, lead(s) OVER w AS a FROM s WINDOW w AS (PARTITION BY probe ORDER BY t, seq)), e AS (SELECT *, lag(d) OVER (PARTITION BY probe ORDER BY t, seq) AS d0 FROM d),
 f AS (SELECT *, sum(CASE WHEN d < 0 AND a >= s AND abs(d0 - (s + a)) < abs(d0 - d) THEN 1 ELSE 0 END) OVER (PARTITION BY probe ORDER BY t, seq) AS n FROM e) SELECT probe, seq, {r6('CASE WHEN n % 2 = 1 THEN -s ELSE s END', 'z')} FROM f""")
def w13_gradient(get):
    x = get("raw").select("probe", "t", "seq", (F.col("Ax") / 2500).alias("x"), (F.col("Ay") / 2500).alias("y"))
    return windows.recovered_by_gradient(x, "z", ("x", "y")).select("probe", "seq", *rd("z"))


@query("k1_named_files", ("raw",), f"""WITH b AS (SELECT probe, CAST(floor(t / {HOUR}) AS BIGINT) * {HOUR} AS t, avg(Temp) AS Temp, avg(Az) AS Az, count(CASE WHEN seq % 3 = 0 THEN Battery END) AS k, avg(CASE WHEN seq % 3 = 0 THEN Battery END) AS Battery FROM raw GROUP BY 1, 2),
 f AS (SELECT *, strftime(make_timestamp(min(t) OVER (PARTITION BY probe, t // {DAY})), '%y%m%d_%H%M') || 'bin3600s@' || probe || '.tsv' AS file FROM b)
SELECT file, strftime(make_timestamp(t), '%Y-%m-%d %H:%M:%S') || chr(9) || printf('%.5g', Temp) || chr(9) || printf('%.5g', Az) || chr(9) || coalesce(printf('%.5g', Battery), '') AS line FROM f
UNION ALL SELECT DISTINCT file, 'Time' || chr(9) || 'Temp' || chr(9) || 'Az' || chr(9) || 'Battery' FROM f""")
def k1_named(get):
    """Hourly means to a file for each probe and day, read back as lines."""
    raw = get("raw")
    path = scratch_path(raw.sparkSession, "named")
    b = raw.groupBy("probe", (F.floor(F.col("t") / HOUR) * HOUR).alias("t")).agg(F.avg("Temp").alias("Temp"), F.avg("Az").alias("Az"), F.avg(F.when(F.col("seq") % 3 == 0, F.col("Battery"))).alias("Battery"))
    tsv.write_files(b, path, ["Temp", "Az", "Battery"], bin_s=3600, period=DAY)
    return raw.sparkSession.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))


#: Rows with the time since the probe's first one, d; and the first time of its third day.
_SEAM = f"""z AS (SELECT probe AS zp, min(t) AS a FROM raw GROUP BY probe), o AS (SELECT raw.*, t - a AS d FROM raw JOIN z ON probe = zp),
 third AS (SELECT probe AS tp, min(t) AS b FROM o WHERE d >= {2 * DAY} GROUP BY probe)"""


@query("k9_seam", ("raw",), f"WITH {_SEAM} SELECT probe, t, 'new' AS src, count(*) AS n FROM o JOIN third ON probe = tp WHERE t >= b AND d < {9 * DAY} GROUP BY ALL")
def k9_seam(get):
    """Stored are eight days and, behind them, days three to six once more, so the third day's first time is there twice: what lies
    before the second of them was superseded and goes. The new rows start at that time too, and take the place of the rest."""
    raw = get("raw").select("probe", "t", "seq", "Temp")
    d = raw.join(raw.groupBy("probe").agg(F.min("t").alias("a")), "probe").withColumn("d", F.col("t") - F.col("a")).drop("a")
    spark, path = raw.sparkSession, scratch_path(raw.sparkSession, "seam")
    again = d.where(f"d >= {2 * DAY} and d < {6 * DAY}").withColumn("seq", F.col("seq") + 10_000_000)
    stored = d.where(f"d < {8 * DAY}").unionByName(again).drop("d").withColumns({"src": F.lit("old"), "day": F.floor(F.col("t") / DAY), "dead": F.lit(False)})
    store.write_days(stored, path)
    store.merge_into(path, d.where(f"d >= {2 * DAY} and d < {9 * DAY}").drop("d").withColumn("src", F.lit("new")))
    return store.stored_days(spark, path).groupBy("probe", "t", "src").agg(F.count(F.lit(1)).alias("n"))


@query("k9_rewritten", ("raw",), f"""WITH {_SEAM.split(', third')[0]}, c AS (SELECT probe AS cp, min(t) AS c FROM o WHERE d >= {DAY * 9 // 2} GROUP BY probe), f AS (SELECT *, CAST(floor(t / {DAY}) AS BIGINT) AS day FROM o JOIN c ON probe = cp),
 was AS (SELECT probe, day, count(*) AS n FROM f WHERE d < {8 * DAY} GROUP BY ALL), goes AS (SELECT probe, day, count(*) AS n FROM f WHERE d < {8 * DAY} AND t >= c GROUP BY ALL), comes AS (SELECT probe, day, count(*) AS n FROM f WHERE t >= c AND d < {6 * DAY} GROUP BY ALL)
SELECT coalesce(g.probe, m.probe) AS probe, coalesce(g.day, m.day) AS day, coalesce(w.n, 0) - coalesce(g.n, 0) + coalesce(m.n, 0) AS "rows" FROM goes g FULL JOIN comes m ON g.probe = m.probe AND g.day = m.day LEFT JOIN was w ON w.probe = coalesce(g.probe, m.probe) AND w.day = coalesce(g.day, m.day)""")
def k9_rewritten(get):
    """Eight days are stored; new rows reach from the middle of the fifth day to the sixth: which partitions are rewritten, and to how many rows."""
    raw = get("raw").select("probe", "t", "seq", "Temp")
    d = raw.join(raw.groupBy("probe").agg(F.min("t").alias("a")), "probe").withColumn("d", F.col("t") - F.col("a")).drop("a")
    path = scratch_path(raw.sparkSession, "rewritten")
    store.write_days(d.where(f"d < {8 * DAY}").drop("d").withColumns({"day": F.floor(F.col("t") / DAY), "dead": F.lit(False)}), path)
    return store.merge_into(path, d.where(f"d >= {DAY * 9 // 2} and d < {6 * DAY}").drop("d")).select("probe", "day", "rows")


@query("k9_log", ("days",), "SELECT probe, t_start, arg_min(t_end, src) AS t_end, min(src) AS src FROM (SELECT probe, k - k % 2 AS t_start, t_end, 0 AS src FROM days WHERE k % 2 = 0 UNION ALL SELECT probe, k - k % 2 AS t_start, t_end + 5 AS t_end, 1 AS src FROM days WHERE k % 2 = 0 UNION ALL SELECT probe, k, t_end, 1 FROM days WHERE k % 2 = 1) GROUP BY probe, t_start")
def k9_log(get):
    days = get("days").select("probe", F.col("k").alias("t_start"), "t_end", F.lit(0).cast("long").alias("changed"))
    old = days.where("t_start % 2 = 0").withColumn("src", F.lit(0))
    new = days.where("t_start % 2 = 0").withColumn("t_end", F.col("t_end") + 5).unionByName(days.where("t_start % 2 = 1")).withColumn("src", F.lit(1))
    return store.merged_log(old, new).select("probe", "t_start", "t_end", "src")


_STAGE_SQL = f"""WITH d AS (SELECT probe, CAST(floor(t / {DAY}) AS BIGINT) AS day, count(*) AS n, count(DISTINCT floor(t / {HOUR})) AS b FROM raw GROUP BY 1, 2), v AS (SELECT min(day) + 6 AS again FROM d),
 w AS (SELECT CAST(floor(t / {DAY}) AS BIGINT) AS day, count(DISTINCT floor(t / {HOUR})) AS n FROM raw GROUP BY 1)
SELECT stage, probe, day, run, CASE stage WHEN 'bins' THEN b ELSE n END AS "rows" FROM d, v, (VALUES ('raw'), ('physical'), ('bins')) s(stage), (VALUES (1), (2)) r(run) WHERE run = 1 OR (day = again AND probe < 'i04')
UNION ALL SELECT 'wide', NULL, day, run, n FROM w, v, (VALUES (1), (2)) r(run) WHERE run = 1 OR day = again"""


@query("k11_stages", ("raw",), _STAGE_SQL)
def k11_stages(get):
    """Two deliveries, the second of one day of four probes: the log of what was made, by stage, partition and run."""
    return _staged(get).log()


def _staged(get) -> stages.StagedStore:
    raw = get("raw").drop("P_counts", "value")
    spark = raw.sparkSession
    c = coefs(spark, raw)
    kept = stages.StagedStore(spark, scratch_path(spark, "stages"), lambda x: velocity.velocity(x, c), ["Vabs", "Temp"], PROBES, 3600)
    kept.deliver(raw, 1)
    kept.refresh(1)
    again = raw.agg(F.floor(F.min("t") / DAY)).first()[0] + 6
    kept.deliver(raw.where((F.floor(F.col("t") / DAY) == again) & (F.col("probe") < "i04")).withColumn("Temp", F.col("Temp") + 1), 2)
    kept.refresh(2)
    return kept


@query("k11_wide", ("raw",), f"""WITH d AS (SELECT CAST(floor(t / {HOUR}) AS BIGINT) * {HOUR} AS t, probe, avg(CASE WHEN probe < 'i04' AND floor(t / {DAY}) = (SELECT floor(min(t) / {DAY}) + 6 FROM raw) THEN Temp + 1 ELSE Temp END) AS Temp FROM raw GROUP BY 1, 2)
SELECT t, {', '.join(f"round(max(CASE WHEN probe = '{p}' THEN Temp END), 6) + 0.0 AS Temp_{p}" for p in PROBES)} FROM d GROUP BY t""")
def k11_wide(get):
    """The last of the four tables after both deliveries."""
    return _staged(get).read("wide").select("t", *rd(*[f"Temp_{p}" for p in PROBES]))


ORACLES["r2_corrected"] = ORACLES["t1_corrected_times"]


@query("r2_corrected")
def r2_corrected(get):
    """T1 over a stream that arrives in four chunks, each cut anywhere in runs of one time: the same as over the whole."""
    raw = get("raw_lowres").select("probe", "seq", timestamp(F.col("t")).alias("ts"))
    spark, path = raw.sparkSession, scratch_path(raw.sparkSession, "chunks")
    border = raw.agg(F.max("seq")).first()[0] // 4 + 1
    for k in range(4):
        # One file a chunk: a stream takes files in the order in which they came.
        raw.where(F.floor(F.col("seq") / border) == k).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return streaming.corrected_to(stream, scratch_path(spark, "corrected"), scratch_path(spark, "corrected-state"), fs=1 / 60, overlap=50, shift=HOUR)


def _closed_spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spectra of sliding windows of two-hour means' stream, as the watermark closes them; tests hold them against the batch form."""
    raw = table(spark, sf_dir, "raw").select("probe", (F.floor(F.col("t") / (2 * HOUR)) * 2 * HOUR).alias("t"), "Temp")
    path = scratch_path(spark, "grid")
    raw.groupBy("probe", "t").agg(F.avg("Temp").alias("Temp")).select("probe", timestamp(F.col("t")).alias("ts"), "Temp").write.parquet(path)
    stream = spark.readStream.schema("probe string, ts timestamp_ntz, Temp double").parquet(path)
    out = streaming.sliding_spectra(stream, 4 * 86400, 2 * 86400, "Temp", step=2 * HOUR)
    return streaming.run_to_end(out, scratch_path(spark, "spectra"), scratch_path(spark, "spectra-state")).withColumns({c: rounded(F.col(c)) for c in ("freq", "psd")})


QUERIES["r4_spectra"] = _closed_spectra
