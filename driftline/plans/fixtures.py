"""Probe tables made from the given `events`, `orders` and `embeddings` tables by SQL that Spark and DuckDB share.

The only difference between the two is how a timestamp becomes microseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW = """SELECT concat('i', lpad(CAST(user_id % 10 AS STRING), 2, '0')) AS probe, {t} AS t, event_id AS seq,
 CAST((event_id * 7919) % 4001 - 2000 AS DOUBLE) AS Ax, CAST((event_id * 104729) % 4001 - 2000 AS DOUBLE) AS Ay,
 CAST((event_id * 1299709) % 801 + 15600 AS DOUBLE) AS Az, CAST((event_id * 15485863) % 501 - 250 AS DOUBLE) AS Mx,
 CAST((event_id * 32452843) % 501 - 250 AS DOUBLE) AS My, CAST((event_id * 49979687) % 301 + 350 AS DOUBLE) AS Mz,
 CAST((event_id * 31) % 100000 + 100000 AS DOUBLE) AS P_counts, CAST(event_id % 1500 AS DOUBLE) / 100 + 5 AS Temp,
 6 - CAST(event_id % 10000 AS DOUBLE) / 10000 AS Battery, value FROM events"""
#: Tables from raw; each may use the ones before it.
DERIVED = {
    "raw_gaps": "SELECT * FROM raw WHERE CAST(floor(t / 3600000000) AS BIGINT) % 24 NOT BETWEEN 3 AND 9",
    "raw_holes": "SELECT probe, t, seq, CASE WHEN seq % 13 = 0 THEN NULL ELSE Mx END AS Mx, Ax, Ay, Az FROM raw",
    "raw_dup": "SELECT probe, t, seq, Ax FROM raw UNION ALL SELECT probe, t, seq + 10000000, Ax + 1 FROM raw WHERE seq % 50 = 0",
    "raw_lowres": "SELECT probe, CAST(floor(t / 3600000000) AS BIGINT) * 3600000000 AS t, seq FROM raw",
    "raw_dayjump": "SELECT probe, t + CASE WHEN row_number() OVER w * 3 > c AND row_number() OVER w * 3 <= 2 * c THEN 86400000000 ELSE 0 END AS t, seq FROM (SELECT probe, t, seq, count(*) OVER (PARTITION BY probe) AS c FROM raw) x WINDOW w AS (PARTITION BY probe ORDER BY seq)",
    "intervals": "SELECT probe, CAST(floor(min(t) / 86400000000) AS BIGINT) * 86400000000 + k * 6 * 86400000000 AS t_start, CAST(floor(min(t) / 86400000000) AS BIGINT) * 86400000000 + (k * 6 + 2) * 86400000000 AS t_end, k AS run FROM raw CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) n GROUP BY probe, k",
    "query_times": "SELECT concat('i', lpad(CAST(o_custkey % 10 AS STRING), 2, '0')) AS probe, CAST(1704067200000000 + (o_orderkey % 4320) * 600000000 AS BIGINT) AS t, o_orderkey AS qid FROM orders",
    "order_times": "SELECT concat('i', lpad(CAST(o_custkey % 10 AS STRING), 2, '0')) AS probe, CAST(1704067200000000 + (o_orderkey % 4320) * 600000000 AS BIGINT) AS t, o_orderkey AS qid FROM orders",
    "load_log": "SELECT probe, min(t) AS t_start, max(t) AS t_end, count(*) AS \"rows\", concat(probe, '.csv') AS file, CAST(min(seq) % 7 AS BIGINT) AS changed FROM raw GROUP BY probe",
    "sphere": "SELECT concat('i', lpad(CAST(vec_id % 10 AS STRING), 2, '0')) AS probe, vec_id AS seq, vec_id * 1000000 AS t, 1.2 * (e1 / n) + 0.1 AS x, 0.9 * (e2 / n) - 0.2 AS y, 1.1 * (e3 / n) + 0.05 AS z FROM vectors",
}
#: 30 % off for one point in 37, 10 % for one in 41: early limits find the former, later ones the latter.
DERIVED["sphere_off"] = "SELECT probe, seq, t, (x - 0.1) * k + 0.1 AS x, (y + 0.2) * k - 0.2 AS y, (z - 0.05) * k + 0.05 AS z FROM (SELECT *, CASE WHEN seq % 37 = 0 THEN 1.3 WHEN seq % 41 = 0 THEN 0.9 ELSE 1.0 END AS k FROM sphere) q"
DERIVED["raw_over"] = "SELECT probe, t, seq, CASE WHEN seq % 101 = 0 THEN CASE WHEN seq % 2 = 0 THEN Ax * 9 ELSE Ax * 7 END ELSE Ax END AS Ax, Ay, CASE WHEN seq % 101 = 0 THEN -32624 ELSE Az END AS Az, Mx, My, Mz FROM raw"
DERIVED["raw_swapped"] = "SELECT probe, CASE WHEN seq % 211 = 0 THEN t - 86400000000 ELSE t END AS t, seq FROM raw"
DERIVED["doubled"] = "SELECT probe, t, seq FROM raw UNION ALL SELECT probe, t, seq + 10000000 FROM raw WHERE seq % 5 < 2"
DERIVED["days"] = "SELECT probe, CAST(floor(t / 86400000000) AS BIGINT) AS k, min(t) AS t_start, max(t) AS t_end FROM raw GROUP BY 1, 2"
DERIVED["overlapping_ranges"] = "SELECT probe, t_start, t_end FROM intervals UNION ALL SELECT probe, t_start + 86400000000 AS t_start, t_end + 86400000000 AS t_end FROM intervals UNION ALL SELECT probe, t_start + 864000000000 AS t_start, t_start + 864000000000 + 3600000000 AS t_end FROM intervals"
DERIVED["raw_spiked"] = "SELECT probe, t, seq, CASE WHEN seq % 97 = 0 THEN Ax + 20000 ELSE Ax END AS Ax, Ay, Az, Mx, My, Mz FROM raw"
VECTORS = {
    "spark": "SELECT vec_id, e1, e2, e3, sqrt(e1*e1 + e2*e2 + e3*e3) AS n FROM (SELECT vec_id, CAST(embedding[0] AS DOUBLE) AS e1, CAST(embedding[1] AS DOUBLE) AS e2, CAST(embedding[2] AS DOUBLE) AS e3 FROM embeddings) q",
    "duckdb": "SELECT vec_id, e1, e2, e3, sqrt(e1*e1 + e2*e2 + e3*e3) AS n FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS e1, CAST(embedding[2] AS DOUBLE) AS e2, CAST(embedding[3] AS DOUBLE) AS e3 FROM embeddings) q",
}
MICROS = {"spark": "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))", "duckdb": "epoch_us(ts)"}
GAIN_A, GAIN_M, AZIMUTH = 6.103e-5, 0.00173, 180.0
SPEED = (10.0, -10.0, -10.0, -3.0, 3.0, 70.0)


def _needs(name: str) -> list[str]:
    if name == "raw":
        return []
    text = VECTORS["spark"] if name == "vectors" else DERIVED[name]
    return [t for t in ("raw", "vectors", "intervals", "sphere") if f"FROM {t}" in text]


def sql(name: str, dialect: str) -> str:
    return RAW.format(t=MICROS[dialect]) if name == "raw" else VECTORS[dialect] if name == "vectors" else DERIVED[name].replace("\"rows\"", "`rows`" if dialect == "spark" else "\"rows\"")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    given = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("events", "orders", "embeddings") if f"FROM {n}" in sql(name, "spark")}
    inner = {n: table(spark, sf_dir, n) for n in _needs(name)}
    text = sql(name, "spark")
    for n in (*given, *inner):
        text = text.replace(f"FROM {n}", f"FROM {{{n}}}")
    return spark.sql(text, **given, **inner)


def ctes(*names: str) -> str:
    """WITH clause for DuckDB."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in _needs(name):
            add(n)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({sql(n, 'duckdb')})" for n in order)


def coefs(spark: SparkSession, probes: DataFrame) -> DataFrame:
    """One row per probe with dummy gains."""
    from pyspark.sql import functions as F

    diag = lambda g: F.array(*[F.array(*[F.lit(g if i == j else 0.0) for j in range(3)]) for i in range(3)])
    zero = F.array(*[F.lit(0.0)] * 3)
    return probes.select("probe").distinct().select("probe", diag(GAIN_A).alias("Ag"), zero.alias("Cg"), diag(GAIN_M).alias("Ah"), zero.alias("Ch"), F.array(*map(F.lit, SPEED)).alias("kVabs"), F.lit(AZIMUTH).alias("azimuth_shift_deg"))
