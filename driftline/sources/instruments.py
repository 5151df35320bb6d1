"""Instrument formats (L1-L20): columns of text -> microseconds and degrees, as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.physics import degrees_minutes
from ..operators.scan import before, haloed, last, scan, total
from ..operators.timefix import day_jumps
from ..schema import DAY, micros

#: Serial day number of 1970-01-01.
SERIAL_DAY_0 = 719529
#: WGS84 and the transverse Mercator scale.
WGS_A, WGS_F, SCALE = 6378137.0, 1 / 298.257223563, 0.9996


def parts_time(y: Column, m: Column, d: Column, hh: Column, mm: Column, ss: Column) -> Column:
    """Whole or fractional seconds; times that do not exist are NULL."""
    text = F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"), F.lit("-"), F.lpad(d.cast("string"), 2, "0"))
    days = F.datediff(F.try_to_date(text, "yyyy-MM-dd"), F.lit("1970-01-01").cast("date"))
    s = ss.cast("double")
    ok = hh.cast("int").between(0, 23) & mm.cast("int").between(0, 59) & (s >= 0) & (s < 60)
    return F.when(ok, days.cast("long") * DAY + (hh.cast("long") * 3600 + mm.cast("long") * 60) * 1_000_000 + F.round(s * 1_000_000).cast("long"))


def clock(date: Column, time: Column, order: str, separator: str) -> Column:
    """Date fields in an order such as dmy, and H:M[:S[.f]]; two-digit years are of this century."""
    f, t = F.split(F.trim(date), f"[{separator}]"), F.split(F.trim(time), ":")
    pick = {k: F.get(f, F.lit(i)).try_cast("int") for i, k in enumerate(order)}
    year = F.when(pick["y"] < 100, pick["y"] + 2000).otherwise(pick["y"])
    return parts_time(year, pick["m"], pick["d"], F.get(t, F.lit(0)).try_cast("int"), F.get(t, F.lit(1)).try_cast("int"), F.coalesce(F.get(t, F.lit(2)).try_cast("double"), F.lit(0.0)))


def inclinometer(df: DataFrame, invert_magnetometer: bool = False) -> DataFrame:
    """L1."""
    out = df.withColumn("t", parts_time(*[F.col(c).try_cast("int") for c in ("year", "month", "day", "hour", "minute")], F.col("second").try_cast("double"))).drop("year", "month", "day", "hour", "minute", "second")
    return out.withColumns({c: -F.col(c) for c in ("Mx", "My", "Mz")}) if invert_magnetometer else out


def iso_log(df: DataFrame, column: str = "Time") -> DataFrame:
    """L2: yyyy-mm-ddTHH:MM:SS."""
    p = F.split(column, "T")
    return df.withColumn("t", clock(F.get(p, F.lit(0)), F.get(p, F.lit(1)), "ymd", "-"))


#: Name -> order of date fields and their separators.
DATE_TIME = {"idronaut": ("dmy", "-"), "sbe": ("mdy", "/"), "sst": ("dmy", "."), "rock": ("ymd", "-"), "ctd_us": ("mdy", "/"), "ctd_eu": ("dmy", "."), "log": ("dmy", ".")}


def dated_log(df: DataFrame, form: str, date: str = "Date", time: str = "Time") -> DataFrame:
    """Separate date and time columns; quotes around them go."""
    order, sep = DATE_TIME[form]
    clean = lambda c: F.regexp_replace(c, '["\']', "")
    return df.withColumn("t", clock(clean(date), clean(time), order, sep))


def day_and_milliseconds(date: Column, ms: Column) -> Column:
    """L5, the older form: dd.mm.yyyy, and milliseconds of the day as text or bytes."""
    return clock(date.cast("string"), F.lit("0:0:0"), "dmy", ".") + F.round(ms.cast("string").try_cast("double") * 1000).cast("long")


def time_only(df: DataFrame, day: Column, time: str = "Time") -> DataFrame:
    """H:M:S after a date from the header or the file name; a fall of the clock starts a new day."""
    t = F.split(time, ":")
    s = (F.get(t, F.lit(0)).cast("long") * 3600 + F.get(t, F.lit(1)).cast("long") * 60) * 1_000_000 + F.round(F.get(t, F.lit(2)).cast("double") * 1_000_000).cast("long")
    x = scan(df.withColumn("_s", s), {"_b": before(F.col("_s"))}, ("seq",), keep_slices=True)
    x = scan(x, {"_over": total(F.when(F.col("_s") < F.col("_b") - DAY // 2, 1).otherwise(0))}, ("seq",))
    return x.withColumn("t", F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long") * DAY + F.col("_s") + F.col("_over") * DAY).select(*[c for c in df.columns if c != "t"], "t")


def time_only_by_jumps(df: DataFrame, day: Column, time: str = "Time") -> DataFrame:
    """L6 with T5, for a log that crosses midnight by mistake or once: all times are of the given day, and stretches between two jumps
    of a day move by it. A log of many days is time_only's."""
    t = F.split(time, ":")
    s = (F.get(t, F.lit(0)).cast("long") * 3600 + F.get(t, F.lit(1)).cast("long") * 60) * 1_000_000 + F.round(F.get(t, F.lit(2)).cast("double") * 1_000_000).cast("long")
    return day_jumps(df.withColumn("t", F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long") * DAY + s))


def file_day(path: Column, century: str = "20") -> Column:
    """Yymmdd in a file name."""
    return F.try_to_date(F.concat(F.lit(century), F.regexp_extract(path, r"(\d{6})[^/\d]*$", 1)), "yyyyMMdd")


def dms(text: Column) -> Column:
    """DD deg MM' SS.s" -> degrees; the hemisphere letter does not matter."""
    g = lambda k: F.regexp_extract(text, r"(\d+)\D+(\d+)\D+(\d+(?:\.\d+)?)", k).try_cast("double")
    return g(1) + g(2) / 60 + g(3) / 3600


def serial_day(x: Column) -> Column:
    """L11."""
    return F.round((x - SERIAL_DAY_0) * float(DAY)).cast("long")


def navigation(df: DataFrame, depth_add: float = 0.0) -> DataFrame:
    """Yy mm dd, HH MM SS; DDMM.mmm with N/S, E/W."""
    d, t = F.split("Date", " "), F.split("Time", " ")
    i = lambda a, k: F.get(a, F.lit(k)).try_cast("int")
    when = parts_time(i(d, 0) + 2000, i(d, 1), i(d, 2), i(t, 0), i(t, 1), F.get(t, F.lit(2)).try_cast("double"))
    side = lambda c, neg: F.when(F.col(c) == neg, -1.0).otherwise(1.0)
    return df.withColumns({"t": when, "Lat": degrees_minutes(F.col("Lat")) * side("NS", "S"), "Lon": degrees_minutes(F.col("Lon")) * side("EW", "W"), "Depth": F.col("Depth") + depth_add})


def first_per_time(df: DataFrame) -> DataFrame:
    """Of repeated times the first row."""
    w = Window.partitionBy("probe", "t").orderBy("seq")
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def echo_sounder(df: DataFrame) -> DataFrame:
    """DDMM.mmm,X text; depth with the sign turned; first row per time."""
    deg = lambda c: degrees_minutes(F.get(F.split(c, ","), F.lit(0)).try_cast("double")) * F.when(F.get(F.split(c, ","), F.lit(1)).isin("S", "W"), -1.0).otherwise(1.0)
    return first_per_time(df.withColumns({"Lat": deg("Lat"), "Lon": deg("Lon"), "Depth": -F.col("Depth")}))


def packed_clock(date: Column, time: Column) -> Column:
    """Ddmmyyyy and HHMMSS.ff."""
    s = lambda c, a, n: F.substring(c, a, n).try_cast("int")
    return parts_time(s(date, 5, 4), s(date, 3, 2), s(date, 1, 2), s(time, 1, 2), s(time, 3, 2), F.substring(time, 5, 9).try_cast("double"))


def adcp_clock(y: Column, m: Column, d: Column, hh: Column, mm: Column, ss: Column, hundredths: Column) -> Column:
    """Two-digit year and hundredths of seconds."""
    return parts_time(y + 2000, m, d, hh, mm, ss + hundredths / 100)


def utm_to_degrees(x: Column, y: Column, zone: int = 34) -> tuple[Column, Column]:
    """Easting, northing of the northern hemisphere -> (lat, lon): the series in the footpoint latitude."""
    e2 = WGS_F * (2 - WGS_F)
    ep2 = e2 / (1 - e2)
    e1 = (1 - (1 - e2) ** 0.5) / (1 + (1 - e2) ** 0.5)
    mu = y / (SCALE * WGS_A * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    foot = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)
    s, c = F.sin(foot), F.cos(foot)
    tan2, c1 = F.pow(F.tan(foot), F.lit(2)), ep2 * c * c
    n = WGS_A / F.sqrt(1 - e2 * s * s)
    r = WGS_A * (1 - e2) / F.pow(1 - e2 * s * s, F.lit(1.5))
    d = (x - 500000.0) / (n * SCALE)
    lat = foot - n * F.tan(foot) / r * (d**2 / 2 - (5 + 3 * tan2 + 10 * c1 - 4 * c1 * c1 - 9 * ep2) * d**4 / 24 + (61 + 90 * tan2 + 298 * c1 + 45 * tan2 * tan2 - 252 * ep2 - 3 * c1 * c1) * d**6 / 720)
    lon = (d - (1 + 2 * tan2 + c1) * d**3 / 6 + (5 - 2 * c1 + 28 * tan2 - 3 * c1 * c1 + 8 * ep2 + 24 * tan2 * tan2) * d**5 / 120) / c
    return F.degrees(lat), F.degrees(lon) + (6 * zone - 183)


def accelerations(df: DataFrame, taps: list[float], every: int) -> DataFrame:
    """GsumMinus1 from m/s2, low-passed by a FIR of windowed weighted sums, then each every-th row."""
    halo = haloed(df, len(taps))
    w = halo.forth
    g = F.sqrt(F.col("Gx") ** 2 + F.col("Gy") ** 2 + F.col("Gz") ** 2) / 9.8 - 1
    x = halo.rows.withColumn("_g", g)
    mid = len(taps) // 2
    sums, weight = F.lit(0.0), F.lit(0.0)
    for k, tap in enumerate(taps):
        v = F.lag("_g", mid - k).over(w) if k <= mid else F.lead("_g", k - mid).over(w)
        sums, weight = sums + F.coalesce(v * tap, F.lit(0.0)), weight + F.when(v.isNotNull(), tap).otherwise(0.0)
    return halo.done(x.withColumn("GsumMinus1", sums / weight).where(F.col("_i") % every == 0).drop("_g"))


def carried_forward(df: DataFrame, column: str = "t") -> DataFrame:
    """A time that could not be read is the one before."""
    return scan(df, {column: last(F.col(column))}, ("seq",)).select(*df.columns)


def tweaked(df: DataFrame, tweaks: dict[str, object]) -> DataFrame:
    """{col}_add a constant, {col}_fun a SQL expression of columns."""
    out = {}
    for key, value in tweaks.items():
        column, _, what = key.rpartition("_")
        base = out.get(column, F.col(column) if column in df.columns else None)
        out[column] = F.expr(str(value)) if what == "fun" else base + F.lit(value)
    return df.withColumns(out)


def stored_time(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("t", micros(F.col(column)))
