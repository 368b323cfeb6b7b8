"""Texts of times in many formats to one form: microseconds since 1970-01-01 UTC.

An ordered cascade of anchored patterns, each strict: a text that fits no pattern, or that names a date or time that doesn't exist,
gives null. A text without a zone takes the default zone that the caller names or looks up. In a local hour that occurs twice the
earlier instant holds; a local time that is skipped is read with the offset before the change. All of it stays in the JVM.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Zone abbreviations and their offsets from UTC in minutes.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "UT": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "IST": 330, "JST": 540, "AEST": 600, "AEDT": 660, "BRT": -180, "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
DAYS = "mon tue wed thu fri sat sun".split()

_BLANK = r"[\s\h\v\x1c-\x1f\x85\x{200b}\x{feff}]"
_ZONE = r" ?(Z|z|[A-Za-z]{2,4}|(?:UTC|GMT)?[+-]\d{2}:?\d{2}(?: ?\[[A-Za-z0-9_+\-/]+\])?|[+-]\d{2}|\[[A-Za-z0-9_+\-/]+\]|Z\[[A-Za-z0-9_+\-/]+\]|[A-Z][A-Za-z_]+/[A-Za-z0-9_+\-/]+)?"
_CLOCK = r"(\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]{0,6}\.?"

# Pattern and the places of year, month, day, hour, minute, second, fraction, zone, half of the day, weekday; 0: not in this format.
_FORMATS = (
    (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})(?:[Tt ]{_CLOCK}{_ZONE})?$", (1, 2, 3, 4, 5, 6, 7, 8, 0, 0)),
    (rf"^(\d{{4}})/(\d{{2}})/(\d{{2}})(?:[Tt ]{_CLOCK}{_ZONE})?$", (1, 2, 3, 4, 5, 6, 7, 8, 0, 0)),
    (r"^(\d{4})-(\d{2})$", (1, 2, 0, 0, 0, 0, 0, 0, 0, 0)),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})[Tt](\d{{2}})(\d{{2}})(?:(\d{{2}})(?:[.,](\d{{1,9}}))?)?{_ZONE}$", (1, 2, 3, 4, 5, 6, 7, 8, 0, 0)),
    (rf"(?i)^(?:(mon|tue|wed|thu|fri|sat|sun)[a-z]{{0,6}},? )?(\d{{1,2}})[ -]{_MONTH}[ -](\d{{4}})(?: {_CLOCK}{_ZONE})?$", (4, 3, 2, 5, 6, 7, 8, 9, 0, 1)),
    (rf"(?i)^(?:(mon|tue|wed|thu|fri|sat|sun)[a-z]{{0,6}},? )?{_MONTH} (\d{{1,2}}),? (\d{{4}})(?:,? (\d{{1,2}}):(\d{{2}})(?::(\d{{2}})(?:[.,](\d{{1,9}}))?)?(?: ?(am|pm))?{_ZONE})?$", (4, 2, 3, 5, 6, 7, 8, 10, 9, 1)),
)
_NUMBER = r"^-?\d{1,19}(?:\.\d{1,9})?$"
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{6})?\+00:00$"


def known_zones(spark: SparkSession) -> list[str]:
    """The region names that this JVM's zone rules know."""
    return sorted(z for z in spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds() if "/" in z or z in ("UTC", "GMT"))


def trimmed(text: Column) -> Column:
    """Without white space around it, of any kind."""
    return F.regexp_replace(text, f"^{_BLANK}+|{_BLANK}+$", "")


def _pieces(text: Column) -> Column:
    """Ten fields of the first fitting pattern: the text is rewritten once and split once."""
    rewritten = reduce(
        lambda rest, f: F.when(text.rlike(f[0]), F.regexp_replace(text, f[0], "|".join(f"${g}" if g else "" for g in f[1]))).otherwise(rest),
        reversed(_FORMATS),
        F.lit(None).cast("string"),
    )
    return F.split(rewritten, r"\|")


def _from_number(text: Column) -> Column:
    """Seconds, milliseconds, microseconds or nanoseconds since 1970, by the size of the number; below microseconds cut."""
    n = text.cast("decimal(38,9)")
    size = F.abs(n)
    micros = F.when(size < F.lit(10**11), n * 1_000_000).when(size < F.lit(10**14), n * 1_000).when(size < F.lit(10**17), n).otherwise(n / 1_000)
    return F.floor(micros).cast("bigint")


def add_utc_micros(df: DataFrame, out: str, text: Column, default_zone: Column, zones: list[str]) -> DataFrame:
    """df with the column out: microseconds since 1970-01-01 UTC, or null.

    text: the text; null, blank and undated texts give null. default_zone: an IANA name for texts without a zone; where it is null
    or unknown such a text gives null. zones: the region names that are valid (known_zones). Missing parts of a date or time take
    their earliest value; digits below the microsecond are cut. A weekday that contradicts the date gives null. The steps are
    projections of their own, so that no step is computed more than once; their columns don't outlive the call.
    """
    own = f"__{uuid.uuid4().hex[:8]}_"
    keep = [F.col(f"`{c}`") for c in df.columns if c != out]
    col = lambda name: F.col(own + name)
    part = lambda i: F.nullif(F.get(col("p"), F.lit(i)), F.lit(""))
    number = lambda i, least: F.coalesce(part(i).cast("int"), F.lit(least))

    df = df.select(*keep, trimmed(text).alias(own + "t"), default_zone.alias(own + "z"))
    df = df.select(*keep, col("t"), col("z"), _pieces(col("t")).alias(own + "p"))
    month = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(F.lower(part(1)), 1, 3)), F.lit(0)).cast("int"), F.when(part(1).rlike("^\\d+$"), part(1).cast("int")), F.lit(1))
    df = df.select(
        *keep, col("t"), col("z"), number(0, 0).alias(own + "y"), month.alias(own + "mo"), number(2, 1).alias(own + "d"), number(3, 0).alias(own + "h"), number(4, 0).alias(own + "mi"), number(5, 0).alias(own + "s"),
        F.coalesce(F.rpad(F.substring(part(6), 1, 6), 6, "0").cast("bigint"), F.lit(0).cast("bigint")).alias(own + "f"), part(7).alias(own + "zone"), F.lower(part(8)).alias(own + "half"),
        F.array_position(F.array(*map(F.lit, DAYS)), F.substring(F.lower(part(9)), 1, 3)).cast("int").alias(own + "wd"), col("p").isNotNull().alias(own + "fit"),
    )
    hour = F.when(col("half").isNull(), col("h")).when(col("h").between(1, 12), col("h") % 12 + F.when(col("half") == "pm", 12).otherwise(0))
    fits = col("fit") & col("y").between(1, 9999) & col("mo").between(1, 12) & col("d").between(1, 31) & hour.between(0, 23) & col("mi").between(0, 59) & col("s").between(0, 59)
    day = F.when(fits, F.try_make_timestamp(col("y"), col("mo"), col("d"), hour, col("mi"), col("s").cast("decimal(8,6)"), F.lit("UTC")))
    zone = col("zone")
    hours, minutes = F.regexp_extract(zone, r"[+-](\d{2})", 1).cast("int"), F.nullif(F.regexp_extract(zone, r"[+-]\d{2}:?(\d{2})", 1), F.lit("")).cast("int")
    signed = F.when(zone.rlike(r"-\d{2}"), -1).otherwise(1) * (hours * 60 + F.coalesce(minutes, F.lit(0)))
    named = F.element_at(F.create_map(*(F.lit(x) for kv in ABBREVIATIONS.items() for x in kv)), F.upper(F.regexp_replace(zone, r"\[.*", "")))
    region = F.when(zone.isNull(), col("z")).otherwise(F.regexp_replace(zone, r"^\[|\]$", ""))
    df = df.select(
        *keep, col("t"), col("f"), day.alias(own + "day"), col("wd"),
        F.when(zone.rlike(r"[+-]\d{2}"), F.when(hours.between(0, 18) & F.coalesce(minutes, F.lit(0)).between(0, 59), signed)).otherwise(named).alias(own + "off"),
        F.when(region.isin(zones), region).alias(own + "region"),
    )
    # Days since 1970-01-01, a Thursday; the weekday functions would look at the session's zone.
    weekday = F.pmod(F.floor(F.unix_seconds(col("day")) / 86_400) + 3, F.lit(7))
    day = F.when(col("wd").isNull() | (weekday == col("wd") - 1), col("day"))
    # The zone rules of the JVM take the earlier offset of a repeated hour and the offset before the change in a skipped one.
    seconds = F.when(col("off").isNotNull(), F.unix_seconds(day) - col("off").cast("bigint") * 60).otherwise(F.unix_seconds(F.to_utc_timestamp(day, col("region"))))
    result = F.when(col("t").rlike(_NUMBER), _from_number(col("t"))).otherwise(seconds * 1_000_000 + col("f"))
    # One row stays one row; a filter on the result isn't pushed through the generator, where it would copy every step into itself.
    return df.select(*keep, F.explode_outer(F.array(result)).alias(out))
