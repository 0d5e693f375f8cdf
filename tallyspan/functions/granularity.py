"""Time buckets: standard steps, any ISO period with zone and origin, fixed durations, all and none.

All arithmetic is built from native expressions on ``timestamp`` columns in a UTC session.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F

# The named granularities and their ISO periods, shortest first.
STANDARD = {
    "second": "PT1S",
    "minute": "PT1M",
    "five_minute": "PT5M",
    "ten_minute": "PT10M",
    "fifteen_minute": "PT15M",
    "thirty_minute": "PT30M",
    "hour": "PT1H",
    "six_hour": "PT6H",
    "day": "P1D",
    "week": "P1W",
    "month": "P1M",
    "quarter": "P3M",
    "year": "P1Y",
}

# Path fields, most significant first: (default label, lower label, date pattern).
PATH_FIELDS = [("y", "y", "yyyy"), ("m", "m", "MM"), ("d", "d", "dd"), ("H", "h", "HH"), ("M", "m", "mm"), ("S", "s", "ss")]

# Milliseconds per exact unit.
MILLIS = {"weeks": 604800000, "days": 86400000, "hours": 3600000, "minutes": 60000, "seconds": 1000, "millis": 1}

# The "all" bucket is open-ended; a column needs finite ends.
ALL_START = "0001-01-01 00:00:00"
ALL_END = "9999-12-31 23:59:59.999"

UNITS = ("years", "months", "weeks", "days", "hours", "minutes", "seconds", "millis")
_ISO = re.compile(
    r"^P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)(?:\.(\d{1,3}))?S)?)?$"
)


def parse_period(text: str) -> dict[str, int]:
    """ISO period text → the non-zero units."""
    m = _ISO.match(text)
    if not m or text in ("P", "PT"):
        raise ValueError(f"not an ISO period: {text}")
    numbers = [int(g) if g else 0 for g in m.groups()[:7]] + [int((m.group(8) or "0").ljust(3, "0"))]
    return {u: n for u, n in zip(UNITS, numbers) if n}


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _micros(c: Column) -> Column:
    return F.unix_micros(c)


def _exact_steps(at: Column, stop: Column, millis: int) -> Column:
    step = F.make_interval(secs=F.lit(millis / 1000).cast("decimal(18,6)"))
    return F.filter(F.sequence(at, F.greatest(at, stop), step), lambda b: b < stop)


class Granularity:
    """``start`` is the bucket of a time; the other bounds follow from it."""

    def start(self, c: Column) -> Column:
        raise NotImplementedError

    def increment(self, c: Column) -> Column:
        raise NotImplementedError

    def decrement(self, c: Column) -> Column:
        raise NotImplementedError

    def end(self, c: Column) -> Column:
        return self.increment(self.start(c))

    def bounds(self, c: Column) -> dict[str, Column]:
        """Start, end, next time and previous time, by name."""
        return {
            "bucket_start": self.start(c),
            "bucket_end": self.end(c),
            "next_time": self.increment(c),
            "previous_time": self.decrement(c),
        }

    def covering(self, first: Column, last: Column) -> Column:
        """Array of the starts of all buckets that meet ``[first, last)``."""
        raise NotImplementedError


@dataclass(frozen=True)
class All(Granularity):
    def start(self, c):
        return F.when(c.isNotNull(), _ts(ALL_START))

    def increment(self, c):
        return F.when(c.isNotNull(), _ts(ALL_END))

    def decrement(self, c):
        return self.start(c)

    def covering(self, first, last):
        return F.array(_ts(ALL_START))


@dataclass(frozen=True)
class Duration(Granularity):
    """Fixed length in milliseconds, counted from ``origin`` (default epoch)."""

    millis: int
    origin: str | None = None

    def _shift(self, c, n):
        return F.timestamp_micros(_micros(c) + F.lit(n * 1000))

    def start(self, c):
        t = _micros(c)
        o = _micros(_ts(self.origin)) if self.origin else F.lit(0)
        return F.timestamp_micros(t - F.pmod(t - o, F.lit(self.millis * 1000)))

    def increment(self, c):
        return self._shift(c, self.millis)

    def decrement(self, c):
        return self._shift(c, -self.millis)

    def covering(self, first, last):
        return _exact_steps(self.start(first), last, self.millis)


def NoGranularity() -> Duration:
    """Each millisecond is its own bucket."""
    return Duration(1)


_TRUNC = {"years": "year", "months": "month", "weeks": "week", "days": "day", "hours": "hour", "minutes": "minute", "seconds": "second", "millis": "millisecond"}


@dataclass(frozen=True)
class Period(Granularity):
    """An ISO period in a time zone; several units, several steps or an origin align to the origin."""

    period: str
    zone: str = "UTC"
    origin: str | None = None
    units: dict = field(init=False, compare=False, repr=False)

    def __post_init__(self):
        object.__setattr__(self, "units", parse_period(self.period))

    # local wall time <-> instant
    def _local(self, c):
        return c if self.zone == "UTC" else F.from_utc_timestamp(c, self.zone)

    def _instant(self, c):
        return c if self.zone == "UTC" else F.to_utc_timestamp(c, self.zone)

    def _origin_local(self):
        # without an origin the count starts at local midnight of 1970-01-01
        return self._local(_ts(self.origin)) if self.origin else _ts("1970-01-01 00:00:00")

    def _exact_millis(self) -> int | None:
        """Length when all units are exact here: days and weeks are not in a zone with clock changes."""
        exact = ("hours", "minutes", "seconds", "millis") if self.zone != "UTC" else tuple(MILLIS)
        if all(u in exact for u in self.units):
            return sum(n * MILLIS[u] for u, n in self.units.items())
        return None

    @property
    def stepping(self) -> bool:
        """True when buckets can only be found by adding the period again and again."""
        return len(self.units) > 1 and self._exact_millis() is None

    def _interval(self, k: Column | int):
        u = self.units
        n = k if isinstance(k, Column) else F.lit(k)

        def part(name):
            return (n * F.lit(u.get(name, 0))).cast("int")

        secs = (n * F.lit(u.get("seconds", 0) * 1000 + u.get("millis", 0))).cast("decimal(18,3)") / F.lit(1000).cast("decimal(4,0)")
        return F.make_interval(part("years"), part("months"), part("weeks"), part("days"), part("hours"), part("minutes"), secs.cast("decimal(18,6)"))

    def _add(self, c, k):
        """``c`` moved by ``k`` periods: dates on the wall clock, exact times on the instant line."""
        millis = self._exact_millis()
        if millis is not None:
            return F.timestamp_micros(_micros(c) + (k if isinstance(k, Column) else F.lit(k)) * F.lit(millis * 1000))
        return self._instant(self._local(c) + self._interval(k))

    def increment(self, c):
        return self._add(c, 1)

    def decrement(self, c):
        return self._add(c, -1)

    def start(self, c):
        if self.stepping:
            raise ValueError("this period needs with_stepped_bucket")
        if len(self.units) == 1:
            (unit, n), = self.units.items()
            if n == 1 and not self.origin:
                return self._truncated(c, unit)
            if unit in ("years", "months"):
                return self._calendar_start(c, n * (12 if unit == "years" else 1))
            if unit in ("weeks", "days"):
                return self._wall_start(c, n * MILLIS[unit] * 1000)
        # exact lengths; without an origin a single unit counts from local midnight of 1970-01-01,
        # as a compound one does
        o = _micros(self._instant(self._origin_local()))
        t = _micros(c)
        return F.timestamp_micros(t - F.pmod(t - o, F.lit(self._exact_millis() * 1000)))

    def _truncated(self, c, unit):
        local = self._local(c)
        cut = F.date_trunc(_TRUNC[unit], local)
        if self.zone != "UTC" and unit in ("hours", "minutes", "seconds", "millis"):
            # subtract the elapsed part from the instant: right also in the repeated hour
            return F.timestamp_micros(_micros(c) - (_micros(local) - _micros(cut)))
        return self._instant(cut)

    def _calendar_start(self, c, step):
        local, o = self._local(c), self._origin_local()
        months = (F.year(local) - F.year(o)) * 12 + F.month(local) - F.month(o)
        k = F.floor(months / F.lit(step)) * step

        def at(m):
            return o + F.make_interval(months=m.cast("int"))

        return self._instant(F.when(at(k) > local, at(k - step)).otherwise(at(k)))

    def _wall_start(self, c, step_micros):
        local = _micros(self._local(c))
        o = _micros(self._origin_local())
        return self._instant(F.timestamp_micros(local - F.pmod(local - o, F.lit(step_micros))))

    def covering(self, first, last):
        at, stop = self.start(first), last
        millis = self._exact_millis()
        if millis is not None:
            return _exact_steps(at, stop, millis)
        lo, hi = self._local(at), self._local(stop)
        series = F.transform(F.sequence(lo, F.greatest(lo, hi), self._interval(1)), lambda b: self._instant(b))
        return F.filter(series, lambda b: b < stop)


def granularity(spec) -> Granularity:
    """From a simple name, a ``{"type": …}`` description, or a Granularity."""
    if isinstance(spec, Granularity):
        return spec
    if isinstance(spec, str):
        name = spec.lower()
        if name == "all":
            return All()
        if name == "none":
            return NoGranularity()
        return Period(STANDARD[name])
    if spec["type"] == "period":
        return Period(spec["period"], spec.get("timeZone", "UTC"), spec.get("origin"))
    if spec["type"] == "duration":
        return Duration(int(spec["duration"]), spec.get("origin"))
    return granularity(spec["type"])


def with_stepped_bucket(df: DataFrame, ts: str, period: Period, name: str = "bucket") -> DataFrame:
    """Bucket start for periods of mixed calendar and clock units, which have no closed form.

    The boundaries from the origin to the last time are a table of one row per (bucket, day it
    touches) — its size follows the time range only — joined to the rows on the day.
    """
    spark = df.sparkSession
    lo, hi = df.agg(F.unix_micros(F.min(ts)), F.unix_micros(F.max(ts))).first()
    if lo is None:
        return df.withColumn(name, F.lit(None).cast("timestamp"))
    starts = _boundaries(period, lo, hi)
    bounds = (
        spark.createDataFrame(list(zip(starts, starts[1:])), "_from long, _to long")
        .withColumns({c: F.timestamp_micros(c) for c in ("_from", "_to")})
        .withColumn("_day", F.explode(F.sequence(F.to_date("_from"), F.to_date("_to"))))
    )
    hit = (F.to_date(F.col(ts)) == bounds["_day"]) & (F.col(ts) >= bounds["_from"]) & (F.col(ts) < bounds["_to"])
    return df.join(bounds, hit, "left").withColumn(name, F.col("_from")).drop("_from", "_to", "_day")


def _boundaries(period: Period, low: int, high: int) -> list[int]:
    """Bucket starts around a range of instants, by adding the period to the wall clock from the origin."""
    zone = ZoneInfo(period.zone)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    lo, hi = (epoch + timedelta(microseconds=t) for t in (low, high))
    if period.origin:
        o = datetime.fromisoformat(period.origin.replace("Z", "+00:00"))
        at = (o if o.tzinfo else o.replace(tzinfo=timezone.utc)).astimezone(zone)
    else:
        at = datetime(1970, 1, 1, tzinfo=zone)

    def step(t: datetime, sign: int) -> datetime:
        u = period.units
        months = t.year * 12 + t.month - 1 + sign * (u.get("years", 0) * 12 + u.get("months", 0))
        year, month = divmod(months, 12)
        last = (datetime(year + (month == 11), (month + 1) % 12 + 1, 1) - timedelta(days=1)).day
        t = t.replace(year=year, month=month + 1, day=min(t.day, last))
        t += timedelta(days=sign * (u.get("weeks", 0) * 7 + u.get("days", 0)))
        exact = timedelta(hours=u.get("hours", 0), minutes=u.get("minutes", 0), seconds=u.get("seconds", 0), milliseconds=u.get("millis", 0))
        return (t.astimezone(timezone.utc) + sign * exact).astimezone(zone)

    out = [at]
    while out[-1] <= hi:
        out.append(step(out[-1], 1))
    while out[0] > lo:
        out.insert(0, step(out[0], -1))
    kept = [t for i, t in enumerate(out) if i + 1 >= len(out) or out[i + 1] > lo]
    return [(t - epoch) // timedelta(microseconds=1) for t in kept]


def _depth(name: str) -> int:
    """How many path fields a standard granularity prints."""
    (unit, _), = parse_period(STANDARD[name.lower()]).items()
    return {"years": 1, "months": 2, "weeks": 3, "days": 3, "hours": 4, "minutes": 5, "seconds": 6}[unit]


def time_to_path(c: Column, name: str, style: str = "default") -> Column:
    """Partition path of a time: ``default``, ``lower`` or ``hive`` style."""
    fields = PATH_FIELDS[: _depth(name)]
    if style == "hive":
        return F.date_format(c, "'dt='" + "-".join(p for _, _, p in fields))
    label = 0 if style == "default" else 1
    return F.date_format(c, "/".join(f"'{f[label]}='{f[2]}" for f in fields))


def path_to_time(path: Column, name: str, style: str = "default") -> Column:
    """Bucket start named by a partition path; null when the path does not name it deep enough."""
    depth = _depth(name)
    if style == "hive":
        pattern = "dt=(\\d{4})" + "".join("-(\\d{2})" for _ in range(depth - 1)) + "(?:-\\d{2})*"
    else:
        pattern = "/".join(f"[{f[0].lower()}{f[0].upper()}]=(\\d{{{len(f[2])}}})" for f in PATH_FIELDS[:depth])
    whole = f"^.*{pattern}/.*$"
    # one pass of the pattern rewrites the path as a time; a path that does not match is no time
    given = "".join(f"{sep}${i + 1}" for i, sep in enumerate(("", "-", "-", " ", ":", ":")[:depth]))
    rest = "".join(("", "-01", "-01", " 00", ":00", ":00")[depth:])
    text = F.regexp_replace(path, whole, given + rest)
    return granularity(name).start(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))


def finer_granularities(name: str) -> list[str]:
    """Standard granularities not longer than ``name``, longest first ("all" is longest, "none" shortest)."""
    order = ["none", *STANDARD, "all"]
    return [g for g in reversed(order[: order.index(name.lower()) + 1]) if g not in ("all", "none")]


def finer_granularities_of(c: Column) -> Column:
    """The same list for a column of granularity names."""
    return reduce(
        lambda acc, g: acc.when(c == g, F.array(*[F.lit(x) for x in finer_granularities(g)])),
        list(STANDARD)[1:],
        F.when(c == "second", F.array(F.lit("second"))),
    )
