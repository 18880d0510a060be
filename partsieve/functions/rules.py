"""Ordered rule tables and the column expressions made from them: licences, component names, part numbers, categories, values."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from partsieve.functions.text import collapse, first_group, strip, to_int

# Licence patterns in order, searched without regard to case.
LICENSES = [
    (r"^no software$", "No-Software"),
    (r"^other$", "Other"),
    (r"^null$", "Other"),
    (r"^various$", "Other"),
    (r"^imported", "Other"),
    (r"mendeley", "Other"),
    (r"cc.?0|cc zero|public.?domain|creative commons.{0,5}zero", "CC0-1.0"),
    (r"cc.?by.?nc.?nd.?4", "CC-BY-NC-ND-4.0"),
    (r"cc.?by.?nc.?nd", "CC-BY-NC-ND-4.0"),
    (r"cc.?by.?nc.?sa.?4|noncommercial.?sharealike.?4", "CC-BY-NC-SA-4.0"),
    (r"cc.?by.?nc.?sa|noncommercial.?sharealike", "CC-BY-NC-SA-4.0"),
    (r"cc.?by.?nc.?4", "CC-BY-NC-4.0"),
    (r"cc.?by.?nc.?3", "CC-BY-NC-3.0"),
    (r"cc.?by.?nc", "CC-BY-NC-4.0"),
    (r"cc.?by.?sa.?4|attribution.?sharealike.?4|share.?alike.?4", "CC-BY-SA-4.0"),
    (r"cc.?by.?sa.?3|attribution.?sharealike.?3", "CC-BY-SA-3.0"),
    (r"cc.?by.?sa|attribution.?sharealike|share.?alike", "CC-BY-SA-4.0"),
    (r"cc.?by.?4|attribution.?4\.0", "CC-BY-4.0"),
    (r"cc.?by.?3|attribution.?3\.0", "CC-BY-3.0"),
    (r"cc.?by.?2", "CC-BY-2.0"),
    (r"cc.?by|creative commons.{0,5}attribution", "CC-BY-4.0"),
    (r"cern.?ohl.?s.?2|cern.{0,30}strongly.?reciprocal", "CERN-OHL-S-2.0"),
    (r"cern.?ohl.?w.?2|cern.{0,30}weakly.?reciprocal", "CERN-OHL-W-2.0"),
    (r"cern.?ohl.?p.?2|cern.{0,30}permissive", "CERN-OHL-P-2.0"),
    (r"cern.?ohl.?s", "CERN-OHL-S-2.0"),
    (r"cern.?ohl.?w", "CERN-OHL-W-2.0"),
    (r"cern.?ohl.?p", "CERN-OHL-P-2.0"),
    (r"cern.?ohl.?1\.2|cern.?ohl.?v\.?1", "CERN-OHL-1.2"),
    (r"cern.?ohl.?v?2|cern.{0,20}version.?2", "CERN-OHL-S-2.0"),
    (r"cern", "CERN-OHL"),
    (r"tapr", "TAPR-OHL"),
    (r"solderpad.{0,10}2\.1|shl.?2\.1", "Solderpad-2.1"),
    (r"solderpad|shl.?2", "Solderpad-2.0"),
    (r"agpl|affero", "AGPL-3.0-or-later"),
    (r"lgpl.?3|lesser.{0,10}3", "LGPL-3.0-or-later"),
    (r"lgpl|lesser general", "LGPL-3.0-or-later"),
    (r"gpl.?3\.0.?or.?later", "GPL-3.0-or-later"),
    (r"gpl.?3\.0.?only", "GPL-3.0-only"),
    (r"gpl.?v?3|gpl.?3|gnu.{0,30}3|general public license.{0,10}3", "GPL-3.0-or-later"),
    (r"gpl.?v?2|gpl.?2|gnu.{0,30}2|general public license.{0,10}2", "GPL-2.0-or-later"),
    (r"gpl|gnu general public", "GPL-3.0-or-later"),
    (r"apache.?2", "Apache-2.0"),
    (r"apache", "Apache-2.0"),
    (r"bsd.?3|bsd three|berkeley", "BSD-3-Clause"),
    (r"bsd.?2", "BSD-2-Clause"),
    (r"bsd", "BSD-3-Clause"),
    (r"mit", "MIT"),
    (r"mozilla|mpl", "MPL-2.0"),
    (r"creativecommons\.org/licen[sc]es/by-sa", "CC-BY-SA-4.0"),
    (r"creativecommons\.org/licen[sc]es/by-nc", "CC-BY-NC-4.0"),
    (r"creativecommons\.org/licen[sc]es/by", "CC-BY-4.0"),
    (r"creative.?commons", "CC-BY-4.0"),
]
LICENSE_SEPARATORS = [";", " and ", " / ", ", "]

# Characters of component names and their plain spellings.
ODD_CHARACTERS = {
    "\u00b5": "u", "\u03bc": "u", "\u2126": "ohm", "\u03a9": "ohm", "\u03c9": "ohm", "\u2013": "-", "\u2014": "-", "\u2018": "'", "\u2019": "'",
    "\u201c": '"', "\u201d": '"', "\u00b1": "+-", "\u00d7": "x", "\u2032": "'", "\u00b0": "deg",
}
# Unit spellings of lower-cased component names, applied in order.
UNITS = [
    (r"(\d+(?:\.\d+)?)\s*kohm", "$1k"),
    (r"(\d+(?:\.\d+)?)\s*mohm", "$1m"),
    (r"(\d+(?:\.\d+)?)\s*ohm", "$1ohm"),
    (r"\b(\d+(?:\.\d+)?)r\b", "$1ohm"),
    (r"(\d+(?:\.\d+)?)\s*uf\b", "$1uf"),
    (r"(\d+(?:\.\d+)?)\s*nf\b", "$1nf"),
    (r"(\d+(?:\.\d+)?)\s*pf\b", "$1pf"),
    (r"\b(\d+(?:\.\d+)?)u\b", "$1uf"),
    (r"\b(\d+(?:\.\d+)?)n\b", "$1nf"),
    (r"\b(\d+(?:\.\d+)?)p\b", "$1pf"),
    (r"(\d+(?:\.\d+)?)\s*uh\b", "$1uh"),
    (r"(\d+(?:\.\d+)?)\s*mh\b", "$1mh"),
    (r"(\d+(?:\.\d+)?)\s*nh\b", "$1nh"),
]
# Names that say nothing, part numbers that are none, designator prefixes.
NULL_WORDS = ["", "null", "none", "n/a", "na", "-", "--"]
NO_PART_NUMBER = ["", "?", "-", "~", "custom", "ebay", "aliexpress", "n/a", "na", "null", "none", "tbd", "tba"]
NO_PART_PATTERN = r"(?i)https?://|^\$\d|\.(?:com|org|io|net|cn)(?:/|\s|$)"
TWO_LETTERS = {"bt": "battery", "cr": "diode", "ds": "led", "fb": "ferrite_bead", "fl": "inductor", "mp": "mechanical", "rn": "resistor", "rv": "resistor", "sw": "switch", "tp": "test_point", "vr": "voltage_regulator"}
ONE_LETTER = {
    "r": "resistor", "c": "capacitor", "l": "inductor", "d": "diode", "q": "transistor", "u": "ic", "j": "connector", "p": "connector", "f": "fuse",
    "y": "crystal", "x": "crystal", "k": "relay", "t": "transformer", "m": "motor", "s": "switch", "e": "antenna", "w": "wire", "h": "mechanical",
}
MULTIPLIERS = {"p": 1e-12, "n": 1e-9, "u": 1e-6, "m": 1e-3, "k": 1e3, "meg": 1e6, "g": 1e9}
UNIT_OF = {"ohm": "ohm", "f": "F", "h": "H", "v": "V", "a": "A", "hz": "Hz"}


def literals(pattern: str) -> list[list[str]]:
    """The plain texts that every match of each alternative holds; for patterns without groups, in lower case."""
    no_literal = r"\\?.(?:\?|\{\d+,\d+\})|\[[^\]]*\]|\\.|[\^$.]"
    return [[x for x in re.sub(no_literal, "\0", alternative).split("\0") if x] for alternative in pattern.split("|")]


def first_match(c: Column, rules: Sequence[tuple[str, str]], low: Column | None = None) -> Column:
    """The value of the first rule whose pattern occurs, null without one.

    low, for long texts, is a column of c in lower case: a pattern is searched only where the texts that it needs are.
    """
    out = F
    for pattern, value in rules:
        found = F.regexp_like(c, F.lit(f"(?i){pattern}"))
        if low is not None:
            here = [reduce(Column.__and__, [low.contains(x) for x in needed]) for needed in literals(pattern)]
            found = reduce(Column.__or__, here) & found
        out = out.when(found, F.lit(value))
    return out


def license_spdx(text: Column) -> Column:
    """Licence text to an SPDX id; several parts give their ids, sorted and joined by " + "; nothing known gives Other."""
    t = strip(F.coalesce(text, F.lit("")))
    found = F.lit(None).cast("string")
    for sep in reversed(LICENSE_SEPARATORS):
        parts = F.filter(F.split(t, f"(?i){sep}", -1), lambda p: strip(p) != "")
        ids = F.array_sort(F.array_distinct(F.filter(F.transform(parts, lambda p: first_match(strip(p), LICENSES)), lambda x: x.isNotNull())))
        found = F.when((F.size(parts) > 1) & (F.size(ids) > 0), F.array_join(ids, " + ")).otherwise(found)
    return F.when(t == "", "Other").otherwise(F.coalesce(found, first_match(t, LICENSES), F.lit("Other")))


def component_name(name: Column) -> Column:
    """Normalized component name: one spelling of spaces, units and articles; null gives an empty name."""
    t = F.coalesce(name, F.lit(""))
    for odd, plain in ODD_CHARACTERS.items():
        t = F.replace(t, F.lit(odd), F.lit(plain))
    t = F.lower(collapse(strip(t)))
    t = F.when(t.isin(NULL_WORDS), "").otherwise(t)
    for pattern, plain in UNITS:
        t = F.regexp_replace(t, pattern, plain)
    t = F.regexp_replace(t, r"^(?:a|an|the)\s+", "")
    for short, long in (("res", "resistor"), ("cap", "capacitor"), ("ind", "inductor")):
        t = F.regexp_replace(t, rf"\b{short}\b", long)
    return t


def part_number(raw: Column) -> Column:
    """A manufacturer's part number, null for placeholders, prices, links and single characters."""
    t = strip(raw)
    return F.when((F.length(t) > 1) & ~F.lower(t).isin(NO_PART_NUMBER) & ~t.rlike(NO_PART_PATTERN), t)


def designator_category(reference: Column) -> Column:
    """Category by the letters of the first designator; two letters go before one."""
    letters = F.lower(first_group(F.trim(F.substring_index(reference, ",", 1)), r"^([A-Za-z]{1,3})\d"))
    two = F.create_map(*[F.lit(x) for pair in TWO_LETTERS.items() for x in pair])
    one = F.create_map(*[F.lit(x) for pair in ONE_LETTER.items() for x in pair])
    return F.coalesce(F.try_element_at(two, F.substring(letters, 1, 2)), F.try_element_at(one, F.substring(letters, 1, 1)))


def quantity(reference: Column, raw: Column) -> Column:
    """The given quantity, else the number of designators, else null."""
    parts = F.size(F.filter(F.split(reference, ","), lambda p: F.trim(p) != "")).cast("long")
    counted = F.when(F.instr(reference, ",") > 0, parts).when(F.trim(reference) != "", F.lit(1).cast("long"))
    return F.coalesce(to_int(raw), counted)


def electrical_value(name: Column, category: Column) -> Column:
    """struct(value, unit) of a normalized name: with a unit (4.7uf), R notation (4k7), or a bare multiplier of a resistor (10k)."""
    t = strip(name)
    scale = F.create_map(*[F.lit(x) for pair in MULTIPLIERS.items() for x in pair])
    units = F.create_map(*[F.lit(x) for pair in UNIT_OF.items() for x in pair])
    with_unit = r"(?i)^(\d+(?:\.\d+)?)\s*(p|n|u|m|k|meg|g)?(ohm|f|h|v|a|hz)\b"
    r_notation = r"(?i)^(\d+)(k|m|meg|u|n|p|r)(\d+)$"
    bare = r"(?i)^(\d+(?:\.\d+)?)\s*(k|m|meg)$"
    by = lambda pattern, group: F.coalesce(F.try_element_at(scale, F.lower(F.regexp_extract(t, pattern, group))), F.lit(1.0))
    plain = F.struct((F.regexp_extract(t, with_unit, 1).try_cast("double") * by(with_unit, 2)).alias("value"), F.try_element_at(units, F.lower(F.regexp_extract(t, with_unit, 3))).alias("unit"))
    sep = F.lower(F.regexp_extract(t, r_notation, 2))
    unit = (
        F.when(sep.isin("r", "k", "meg"), "ohm")
        .when(sep.isin("u", "n", "p"), F.when(category == "inductor", "H").otherwise("F"))
        .when(category == "inductor", "H")
        .when(category == "resistor", "ohm")
    )
    number = F.concat(F.regexp_extract(t, r_notation, 1), F.lit("."), F.regexp_extract(t, r_notation, 3)).try_cast("double")
    inner = F.struct((number * by(r_notation, 2)).alias("value"), unit.alias("unit"))
    short = F.struct((F.regexp_extract(t, bare, 1).try_cast("double") * by(bare, 2)).alias("value"), F.lit("ohm").alias("unit"))
    found = F.when(t.rlike(with_unit), plain).when(t.rlike(r_notation) & unit.isNotNull(), inner).when(t.rlike(bare) & (category == "resistor"), short)
    return F.coalesce(found, F.struct(F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("unit")))
