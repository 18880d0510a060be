"""Text, cast and key helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(c != "", F.lit(False))


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without one."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def to_float(c: Column) -> Column:
    """A number after commas, dollar signs and spaces are dropped; null if it is none."""
    bare = F.translate(c, ",$ ", "")
    return F.when(bare.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), bare.try_cast("double"))


def to_int(c: Column) -> Column:
    """to_float truncated towards zero."""
    return to_float(F.translate(c, "$", "x")).try_cast("long")


def strict_int(c: Column) -> Column:
    """Only digits with a sign count: 12.0 is null."""
    return F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c).try_cast("long"))


def title_case(c: Column) -> Column:
    """Upper-cases every letter that follows a non-letter."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), r.substr(F.lit(2), F.length(r)))), "")


def repo_key(url: Column) -> Column:
    """host/owner/repo of a GitHub or GitLab url, lower case, without .git; null for other urls."""
    u = F.lower(F.trim(url))
    u = F.regexp_replace(F.regexp_replace(u, "/+$", ""), r"\.git$", "")
    return first_group(F.regexp_replace(u, "^https?://", ""), r"^((?:github|gitlab)\.com/[^/]+/[^/]+)")


def doi(c: Column) -> Column:
    """A DOI without its resolver, lower case."""
    return F.lower(F.trim(F.regexp_replace(c, r"^https?://(dx\.)?doi\.org/", "")))


def years_between(later: Column, earlier: Column) -> Column:
    """Years of 365.25 days between two timestamps."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(86400e6) / F.lit(365.25)


def title_key(title: Column) -> Column:
    """A title for comparing: lower case, only a-z, 0-9 and spaces."""
    return F.trim(F.regexp_replace(F.lower(title), "[^a-z0-9 ]", ""))


def truncated(text: Column, most: int, marker: str) -> Column:
    """The first characters of a text and a marker, if it is longer."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(marker))).otherwise(text)


def filled(template: str, **fields: Column) -> Column:
    """A template with {name} fields; doubled braces are halved after filling, those of the fields' values too."""
    out = F.lit(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit(f"{{{name}}}"), F.coalesce(value, F.lit("")))
    return F.replace(F.replace(out, F.lit("{{"), F.lit("{")), F.lit("}}"), F.lit("}"))


def says_true(text: Column) -> Column:
    """Whether a text contains "true" in any case; null if it is null or empty."""
    return F.when(present(text), F.lower(text).contains("true"))


def price(text: Column) -> Column:
    """struct(value, currency) of a price: a leading $, or EUR, or a number and whatever follows it; null value if there is no number."""
    t = strip(text)
    euro = F.substring(t, 1, 3).isin("EUR", "eur")
    bare = F.when(t.startswith("$"), F.substring(t, 2, 1 << 30)).when(euro, F.substring(t, 4, 1 << 30)).otherwise(t)
    first = first_group(bare, r"^\s*(\S+)")
    value = F.when(first.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), first.try_cast("double"))
    return F.struct(value.alias("value"), F.when(value.isNotNull(), F.when(euro, "EUR").otherwise("USD")).alias("currency"))


def iso_utc(micros: Column) -> Column:
    """ISO-8601 text in UTC of microseconds since 1970; the fraction only where it is not zero."""
    second = F.floor(micros / F.lit(1_000_000))
    rest = F.pmod(micros, F.lit(1_000_000))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(second / 86400).cast("int"))
    at = F.pmod(second, F.lit(86400))
    two = lambda c: F.lpad(c.cast("long").cast("string"), 2, "0")
    clock = F.concat_ws(":", two(F.floor(at / 3600)), two(F.floor(at % 3600 / 60)), two(at % 60))
    fraction = F.when(rest != 0, F.concat(F.lit("."), F.lpad(rest.cast("string"), 6, "0"))).otherwise("")
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), clock, fraction, F.lit("+00:00"))


def year_of(date: Column) -> Column:
    """The year that a date text begins with, null if it does not."""
    return F.when(date.rlike(r"^\d{4}"), F.substring(date, 1, 4).try_cast("int"))
