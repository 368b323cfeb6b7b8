"""Normalisers of text fields as column expressions. Nulls give null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.site import HEADING_IDS, HEADING_TEXTS

_NOISE = r"(?i)renderexplorewidget|trends\.embed"


def year(text: Column) -> Column:
    """The first run of four digits as a number, without bounds; null where there is none."""
    return F.nullif(F.regexp_extract(text, r"(\d{4})", 1), F.lit("")).cast("int")


def enum(text: Column, allowed: list[str], default: str = "unknown") -> Column:
    """Lower-cased and trimmed, if that is one of the allowed values, else the default (also for null)."""
    t = F.lower(F.trim(text))
    return F.coalesce(F.when(t.isin(*allowed), t), F.lit(default))


def type_slug(types: Column) -> Column:
    """Each type as the slug after /types/, else in lower case with blanks as hyphens; repeated ones stay."""
    def one(x: Column) -> Column:
        slug = F.regexp_extract(x, r"/types/([a-z0-9-]+)", 1)
        return F.when(slug != "", slug).otherwise(F.regexp_replace(F.lower(F.trim(x)), " ", "-"))
    return F.transform(types, one)


def distinct_ignoring_case(items: Column) -> Column:
    """Trimmed items in their order; empty ones and later ones that differ only in case from an earlier one are dropped."""
    clean = F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.array().cast("array<string>").alias("seen"))
    step = lambda acc, x: F.when(F.array_contains(acc["seen"], F.lower(x)), acc).otherwise(F.struct(F.array_append(acc["kept"], x).alias("kept"), F.array_append(acc["seen"], F.lower(x)).alias("seen")))
    return F.aggregate(clean, start, step, lambda acc: acc["kept"])


def references(by_name: Column) -> Column:
    """A map of name to URL as a list of (name, url)."""
    return F.transform(F.map_entries(by_name), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("url")))


def heading(text: Column, most: int = 120) -> Column:
    """Trimmed and cut; `other` for a heading that is embed code; '' for null."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(t.rlike(_NOISE), F.lit("other")).otherwise(F.left(t, F.lit(most)))


def heading_kind(heading_id: Column, text: Column) -> Column:
    """Kind of a section: by its anchor, else `template` for a text that begins so, else by its text, else `other`."""
    ids = F.create_map(*(F.lit(x) for kv in HEADING_IDS.items() for x in kv))
    texts = F.create_map(*(F.lit(x) for kind, names in HEADING_TEXTS.items() for n in names for x in (n, kind)))
    key = F.regexp_replace(F.lower(F.trim(text)), r"[:.\s]+$", "")
    return F.coalesce(F.element_at(ids, heading_id), F.when(key.startswith("template"), F.lit("template")), F.element_at(texts, key), F.lit("other"))


def paragraphs(items: Column) -> Column:
    """Without empty paragraphs and embed code; null gives an empty list."""
    return F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda p: p.isNotNull() & (p != "") & ~p.rlike(_NOISE))


def comma_list(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda x: F.trim(x))


def without_suffix(text: Column, suffix: str) -> Column:
    return F.regexp_replace(text, f"\\Q{suffix}\\E$", "")


def footnote(text: Column) -> Column:
    """The number of a text that is a footnote mark `[n]`, else null."""
    return F.nullif(F.regexp_extract(text, r"^\[(\d+)\]$", 1), F.lit("")).cast("int")


def truncated(text: Column, most: int) -> Column:
    return F.left(text, F.lit(most))


def file_name(text: Column) -> Column:
    """Runs of other characters than letters, digits, dot and hyphen as one underscore, none at the ends; `x` where nothing is left."""
    t = F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9.\-]+", "_"), r"^_+|_+$", "")
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit("x")).otherwise(t)


def status_class(code: Column) -> Column:
    """How a fetch outcome is to be treated: ok, auth, permanent or retryable; a missing code is retryable."""
    return F.when(code == 200, "ok").when(code.isin(401, 403), "auth").when(code.isin(400, 404, 405, 422), "permanent").otherwise("retryable")


def backoff_cap(attempt: Column, base: float = 2.0, most: float = 60.0) -> Column:
    """The longest wait before the next attempt, in seconds; a fetcher waits between half of it and all of it."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt - 1))
