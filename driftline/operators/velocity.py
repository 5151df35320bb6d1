"""The velocity step (P9-P12) and the joined tables (J1, A3): counts to currents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import physics
from ..schema import VECTORS
from .aggregates import medians
from .scan import is_small, kept_if_large, last, scan, with_facts
from .windows import battery_tail, burst_starts_nulled, despiked_counts, filled_all, smoothed_steps

OVERSCALED = -32624.0
A_SPIKE, M_SPIKE = 1500.0, 100.0


def recovered_magnetometer(df: DataFrame) -> DataFrame:
    """A lost Hx from Hy, Hz by the probe's median field strength; the sign of the last good Hx."""
    h = F.sqrt(F.col("Hx") ** 2 + F.col("Hy") ** 2 + F.col("Hz") ** 2)
    mid = medians(df.withColumn("_h", h), "_h").withColumnRenamed("median", "_h")
    x = with_facts(scan(df, {"_good": last(F.signum("Hx"))}), mid, "left")
    lost = F.sqrt(F.greatest(F.lit(0.0), F.col("_h") ** 2 - F.col("Hy") ** 2 - F.col("Hz") ** 2))
    return x.withColumn("Hx", F.coalesce(F.col("Hx"), lost * F.coalesce("_good", F.lit(1.0)))).select(*df.columns)


def recovered_overscale(df: DataFrame, column: str, others: Sequence[str]) -> DataFrame:
    """P10: an over-scaled gravity channel from the others, with the probe's largest norm of good rows; its
    sign is positive, as the sensor saturates at the positive end of that channel."""
    whole = F.col(column) ** 2 + sum((F.col(c) ** 2 for c in others[1:]), F.col(others[0]) ** 2)
    largest = df.groupBy("probe").agg(F.max(F.when(~F.col("overscaled"), whole)).alias("_largest"))
    rest = F.col("_largest") - sum((F.col(c) ** 2 for c in others[1:]), F.col(others[0]) ** 2)
    return with_facts(df, largest).withColumn(column, F.when(F.col("overscaled"), F.sqrt(F.greatest(F.lit(0.0), rest))).otherwise(F.col(column))).select(*df.columns)


def velocity(df: DataFrame, coefs: DataFrame, *, harmonics: int = 2, g_minus_1: float = 1.0, h_minus_1: float = 8.0, despike: bool = False) -> DataFrame:
    """Probe, t, seq, Vabs, Vdir, v, u, inclination and the channels that are not counts.

    coefs: one row per probe (Ag, Cg, Ah, Ch, kVabs, azimuth_shift_deg); the last of kVabs is the limit
    angle. Every task has them; no row takes them through a shuffle.
    """
    if despike:
        df = despiked_counts(df, {c: A_SPIKE if c[0] == "A" else M_SPIKE for c in VECTORS})
    rest = [c for c in df.columns if c not in VECTORS and c not in ("probe", "t", "seq")]
    ends = physics.line_end(F.col("kVabs"), harmonics, F.element_at("kVabs", -1))
    per_probe_ = coefs.select("probe", "Ag", "Cg", "Ah", "Ch", "kVabs", "azimuth_shift_deg", *[c.alias(n) for n, c in zip(("_x0", "_at", "_slope"), ends)])
    x = with_facts(df, per_probe_)
    gs = physics.calibrate(tuple(F.col(c) for c in VECTORS[:3]), F.col("Ag"), F.col("Cg"))
    hs = physics.calibrate(tuple(F.col(c) for c in VECTORS[3:]), F.col("Ah"), F.col("Ch"))
    x = x.withColumns({n: c for n, c in zip(("Gx", "Gy", "Gz", "Hx", "Hy", "Hz"), (*gs, *hs))})
    g, h = tuple(F.col(c) for c in ("Gx", "Gy", "Gz")), tuple(F.col(c) for c in ("Hx", "Hy", "Hz"))
    r = F.when(F.abs(physics.norm(g) - 1) <= g_minus_1, physics.inclination(g))
    x = x.withColumn("_r", r)
    speed = physics.speed(F.col("_r"), F.col("kVabs"), harmonics, F.col("_x0"), F.col("_at"), F.col("_slope"))
    facing = F.when(physics.norm(h) - 1 < h_minus_1, physics.direction(g, h, F.col("azimuth_shift_deg"))).otherwise(0.0)
    x = x.withColumns({"Vabs": speed, "Vdir": facing, "inclination": F.degrees("_r")})
    v, u = physics.components(F.col("Vabs"), F.col("Vdir"))
    return x.select("probe", "t", "seq", "Vabs", "Vdir", v.alias("v"), u.alias("u"), "inclination", *rest)


def recovered_counts_x(df: DataFrame, coefs: DataFrame, *, h_minus_1: float, gaps: bool = True) -> DataFrame:
    """P11 and W4 in counts: a lost Mx from My and Mz such that |Ah (M - Ch)| is the probe's median field below 1 + h_minus_1;
    where that median is off by half and hardly any Mx is good, the field is 1 and all Mx are made anew. Of the two
    solutions the lower one is taken. What is still missing in a channel is interpolated, but a channel of a probe with under a
    hundredth as many good rows as bad ones is lost whole. coefs has Ah and Ch of each probe; they are not in the rows that are scanned.
    gaps: False where each channel is known in all rows of a probe or in none, as W3 leaves it: then nothing is interpolated.

    Adds _with_yz (rows of the probe with both My and Mz: without any, the field can't be recovered) and _unset (the row's value is in a lost channel)."""
    field = coefs.select("probe", "Ah", "Ch")
    x = with_facts(df, field)
    d = [F.col(c).cast("double") - F.col("Ch")[i] for i, c in enumerate(VECTORS[3:])]
    a = [[F.col("Ah")[i][j] for j in range(3)] for i in range(3)]
    strength = physics.norm(physics.calibrate(tuple(F.col(c) for c in VECTORS[3:]), F.col("Ah"), F.col("Ch"))) - 1
    wanted = F.col("Mx").isNull() & (F.col("My").isNotNull() | F.col("Mz").isNotNull())
    both = F.col("My").isNotNull() & F.col("Mz").isNotNull()
    good = F.when(strength < h_minus_1, strength)
    stats = [F.avg(wanted.cast("double")).alias("_share"), F.count_if(both).alias("_with_yz"), F.count_if(F.col("Mx").isNotNull() | both).alias("_good_Mx"), F.count("My").alias("_good_My"), F.count("Mz").alias("_good_Mz"), F.count(F.lit(1)).alias("_all")]
    if is_small(df):
        mid = x.groupBy("probe").agg(*stats, F.median(good).alias("_m"))
    else:
        mid = with_facts(x.groupBy("probe").agg(*stats), medians(x.select("probe", good.alias("_s")), "_s").withColumnRenamed("median", "_m"), "left")
    anew = F.col("_m").isNull() | ((F.abs("_m") > 0.5) & (F.col("_share") > 0.95))
    # A channel is lost where good / bad rows are at most a hundredth; Mx is good where it is given or can be made.
    number = {"Mx": F.when(anew, F.col("_with_yz")).otherwise(F.col("_good_Mx")), "My": F.col("_good_My"), "Mz": F.col("_good_Mz")}
    mid = mid.select("probe", "_with_yz", *[(n <= 0.01 * (F.col("_all") - n)).alias(f"_lost_{c}") for c, n in number.items()], anew.alias("_anew"), F.when(anew, 1.0).otherwise(F.col("_m") + 1).alias("_h"))
    # |x a0 + q| = h for the first column a0 of Ah and what the other channels give, q.
    q = [a[i][1] * d[1] + a[i][2] * d[2] for i in range(3)]
    square = sum((a[i][0] * a[i][0] for i in (1, 2)), a[0][0] * a[0][0])
    along = sum((a[i][0] * q[i] for i in (1, 2)), a[0][0] * q[0])
    beyond = sum((q[i] * q[i] for i in (1, 2)), q[0] * q[0]) - F.col("_h") * F.col("_h")
    lower = F.col("Ch")[0] - (along + F.sqrt(F.abs(along * along - square * beyond))) / square
    # The rows take all that is known of their probe in one join.
    x = with_facts(df, with_facts(mid, field)).withColumn("Mx", F.when(F.col("Mx").isNotNull() & ~F.col("_anew"), F.col("Mx").cast("double")).otherwise(lower)).drop("_anew", "_h", "Ah", "Ch")
    unset = F.lit(False)
    for c in VECTORS[3:]:
        unset = unset | (F.col(c).isNull() & F.col(f"_lost_{c}"))
    x = x.withColumn("_unset", unset)
    # Mx is made of My and Mz and what is known of the probe, so without gaps in these it has none.
    x = filled_all(x, {c: F.lit(False) for c in VECTORS[3:]}) if gaps else x
    return x.withColumns({c: F.when(~F.col(f"_lost_{c}"), F.col(c)) for c in VECTORS[3:]}).drop(*[f"_lost_{c}" for c in VECTORS[3:]])


def recovered_gravity(df: DataFrame) -> DataFrame:
    """P10 on calibrated gravity: where one of the counts Ax, Ay, Az is over-scaled, its component is what the other two leave of
    a squared norm. That is 1, unless in more than a thousandth of the probe's rows the other two exceed it: then it is their
    mean excess, or their largest where the mean is far below it, or 1 again where all exceed it by the same."""
    over = [F.coalesce(F.col(c) == OVERSCALED, F.lit(False)) for c in VECTORS[:3]]
    one = sum((o.cast("int") for o in over[1:]), over[0].cast("int")) == 1
    names = ("Gx", "Gy", "Gz")
    rest = [sum((F.col(n) * F.col(n) for n in names if n != own), F.lit(0.0)) for own in names]
    x = df.withColumns({f"_r{i}": F.when(one & over[i], rest[i]) for i in range(3)})
    big = [F.when(F.col(f"_r{i}") > 1, F.col(f"_r{i}")) for i in range(3)]
    stats = [c for i in range(3) for c in (F.avg(F.coalesce(F.col(f"_r{i}") > 1, F.lit(False)).cast("double")).alias(f"_n{i}"), F.avg(big[i]).alias(f"_a{i}"), F.max(f"_r{i}").alias(f"_m{i}"))]
    facts = x.groupBy("probe").agg(*stats)
    for i in range(3):
        mean, most, many = F.col(f"_a{i}"), F.col(f"_m{i}"), F.col(f"_n{i}") > 0.001
        whole = F.when(many & (most == mean), 1.0).when(many & (most - mean < (most - 1) / 2), mean).when(many, most).otherwise(1.0)
        facts = facts.withColumn(f"_w{i}", whole).withColumn(f"_k{i}", many & (F.col(f"_w{i}") == most))
    x = with_facts(x, facts.select("probe", *[f"_{k}{i}" for k in "wk" for i in range(3)]))
    for i, own in enumerate(names):
        r, whole = F.col(f"_r{i}"), F.col(f"_w{i}")
        level = F.when((r > 1) & ~F.col(f"_k{i}"), whole).otherwise(r)
        x = x.withColumn(own, F.when(r.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), whole - level))).otherwise(F.col(own)))
    return x.withColumn("overscaled", one).drop(*[f"_{k}{i}" for k in "rwk" for i in range(3)])


def recovered_velocity(df: DataFrame, coefs: DataFrame, *, force_coefs: Sequence[float] | None = None, harmonics: int = 2, g_minus_1: float = 1.0, h_minus_1: float = 8.0, despike: bool = True) -> DataFrame:
    """P12 as one step: W3, P11 with W4, P10, then inclination, speed and direction; the columns of velocity().

    force_coefs: a polynomial of the force (P5) instead of the probe's series of the inclination. The inclination is that of
    the recovered gravity; rows off the norm by more than g_minus_1 lose it unless they were recovered.
    """
    rest = [c for c in df.columns if c not in VECTORS and c not in ("probe", "t", "seq")]
    # Whether a channel is over-scaled is read from the raw counts, which stay beside the despiked ones.
    x = df.withColumns({f"_{c}": F.col(c) for c in VECTORS[:3]})
    x = despiked_counts(x, {c: A_SPIKE if c[0] == "A" else M_SPIKE for c in VECTORS}) if despike else x
    ends = physics.line_end(F.col("kVabs"), harmonics, F.element_at("kVabs", -1))
    x = with_facts(x, coefs.select("probe", "Ag", "Cg"))
    gs = physics.calibrate(tuple(F.col(c) for c in VECTORS[:3]), F.col("Ag"), F.col("Cg"))
    x = x.withColumns(dict(zip(("Gx", "Gy", "Gz"), gs))).withColumns({c: F.col(f"_{c}") for c in VECTORS[:3]})
    raw_norm = physics.norm(tuple(F.col(c) for c in ("Gx", "Gy", "Gz")))
    x = recovered_gravity(x.withColumn("_bad", F.abs(raw_norm - 1) > g_minus_1)).drop("Ag", "Cg", *VECTORS[:3], *[f"_{c}" for c in VECTORS[:3]])
    # The field's statistics and two scans read it from here.
    x = recovered_counts_x(kept_if_large(x), coefs, h_minus_1=h_minus_1, gaps=not despike)
    x = with_facts(x, coefs.select("probe", "Ah", "Ch", "kVabs", "azimuth_shift_deg", *[c.alias(n) for n, c in zip(("_x0", "_at", "_slope"), ends)]))
    hs = physics.calibrate(tuple(F.col(c) for c in VECTORS[3:]), F.col("Ah"), F.col("Ch"))
    x = x.withColumns(dict(zip(("Hx", "Hy", "Hz"), hs)))
    g, h = tuple(F.col(c) for c in ("Gx", "Gy", "Gz")), tuple(F.col(c) for c in ("Hx", "Hy", "Hz"))
    x = x.withColumn("_r", F.when(~F.col("_bad") | F.col("overscaled"), physics.inclination(g)))
    if force_coefs is None:
        speed = physics.speed(F.col("_r"), F.col("kVabs"), harmonics, F.col("_x0"), F.col("_at"), F.col("_slope"))
    else:
        # Never NULL in the many pieces of the speed, which halves their code: the JVM compiles no method of over 8,000 bytes.
        x = x.withColumn("_f", F.coalesce(physics.force(F.col("_r")), F.lit(0.0)))
        speed = F.when(F.col("_r").isNotNull(), physics.polynomial_speed(F.col("_f"), force_coefs))
    # Without a field the direction is that of the tilt alone; where a channel is lost, 0 for the rows that lost it.
    known = ~F.col("_unset") | F.coalesce(physics.norm(h) - 1 < h_minus_1, F.lit(False))
    facing = F.when(F.col("_with_yz") == 0, physics.direction_without_field(g, F.col("azimuth_shift_deg"))).when(known, physics.direction(g, h, F.col("azimuth_shift_deg"))).otherwise(0.0)
    x = x.withColumns({"Vabs": speed, "Vdir": facing, "inclination": F.degrees("_r")})
    v, u = physics.components(F.col("Vabs"), F.col("Vdir"))
    return x.select("probe", "t", "seq", "Vabs", "Vdir", v.alias("v"), u.alias("u"), "inclination", *rest)


def pressure_old(
    df: DataFrame, p: Sequence[float], p_temp: Sequence[float] | None = None, p_battery: Sequence[float] | None = None, *,
    battery_min: float | None = None, battery_ok_min: float | None = None, burst_period: int | None = None,
) -> DataFrame:
    """The polynomial p of the counts after the polynomials of temperature and battery were added to them.

    The temperature is smoothed between its changes (W11), the battery's tail is made straight where battery_ok_min is given
    (W12). With battery_min the battery counts as battery_min until it first falls to it. With burst_period the first two
    values of each period become NULL (W10).
    """
    x, counts = df, F.col("P_counts").cast("double")
    if p_temp is not None:
        x = smoothed_steps(x.withColumn("_temp", F.col("Temp").cast("double")), "_temp")
        counts = counts + physics.horner(F.col("_temp"), p_temp)
    if p_battery is not None:
        x = x.withColumn("_battery", F.col("Battery").cast("double"))
        if battery_ok_min is not None:
            x = battery_tail(x, "_battery", battery_ok_min)
        change = physics.horner(F.col("_battery"), p_battery)
        if battery_min is not None:
            fallen = x.groupBy("probe").agg(F.min(F.when(F.col("_battery") <= battery_min, F.struct("t", "seq"))).alias("_fallen"))
            x = with_facts(x, fallen)
            before = F.col("_fallen").isNull() | (F.struct("t", "seq") < F.col("_fallen"))
            change = F.when(before, physics.horner(F.lit(float(battery_min)), p_battery)).otherwise(change)
        counts = counts + change
    x = x.withColumn("Pressure", physics.horner(counts, p)).drop("_temp", "_battery", "_fallen")
    return x if burst_period is None else burst_starts_nulled(x, "Pressure", burst_period)


def azimuth(coefs: DataFrame, declination: DataFrame | None = None) -> DataFrame:
    """Stored + added + declination, which comes from a lookup by whole degrees and year."""
    base = F.col("azimuth_shift_deg") + F.coalesce(F.col("azimuth_add"), F.lit(0.0))
    if declination is None:
        return coefs.withColumn("azimuth_shift_deg", base)
    keyed = coefs.withColumns({"_la": F.round("lat"), "_lo": F.round("lon")})
    look = declination.select(F.col("lat").cast("double").alias("_la"), F.col("lon").cast("double").alias("_lo"), "year", "declination")
    return keyed.join(look, ["_la", "_lo", "year"], "left").withColumn("azimuth_shift_deg", base + F.coalesce("declination", F.lit(0.0))).drop("_la", "_lo", "declination")

