"""Verdicts of a language model, nested JSON without a schema, flattened into typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each column of a verdict, its group, its field, and what it is: text, flag (0 or 1), count, or the name of a
# licence that counts only where its group says that it is present.
FIELDS = [
    ("project_type", "metadata", "project_type", "text"),
    ("structure_quality", "metadata", "structure_quality", "text"),
    ("doc_location", "metadata", "documentation_location", "text"),
    ("license_present", "license", "present", "flag"),
    ("license_type", "license", "type", "text"),
    ("license_name", "license", "name", "text"),
    ("contributing_present", "contributing", "present", "flag"),
    ("contributing_level", "contributing", "level", "text"),
    ("bom_present", "bom", "present", "flag"),
    ("bom_completeness", "bom", "completeness", "text"),
    ("bom_component_count", "bom", "component_count", "count"),
    ("assembly_present", "assembly", "present", "flag"),
    ("assembly_detail", "assembly", "detail_level", "text"),
    ("assembly_step_count", "assembly", "step_count", "count"),
    ("hw_design_present", "design_files.hardware", "present", "flag"),
    ("hw_editable_source", "design_files.hardware", "has_editable_source", "flag"),
    ("mech_design_present", "design_files.mechanical", "present", "flag"),
    ("mech_editable_source", "design_files.mechanical", "has_editable_source", "flag"),
    ("sw_fw_present", "software_firmware", "present", "flag"),
    ("sw_fw_type", "software_firmware", "type", "text"),
    ("sw_fw_doc_level", "software_firmware", "documentation_level", "text"),
    ("testing_present", "testing", "present", "flag"),
    ("testing_detail", "testing", "detail_level", "text"),
    ("cost_mentioned", "cost_sourcing", "estimated_cost_mentioned", "flag"),
    ("suppliers_referenced", "cost_sourcing", "suppliers_referenced", "flag"),
    ("part_numbers_present", "cost_sourcing", "part_numbers_present", "flag"),
    ("maturity_stage", "project_maturity", "stage", "text"),
    ("hw_license_name", "specific_licenses.hardware", "name", "licence"),
    ("sw_license_name", "specific_licenses.software", "name", "licence"),
    ("doc_license_name", "specific_licenses.documentation", "name", "licence"),
]


def _member(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def truth(v: Column) -> Column:
    """Whether a JSON value counts as true: no null, false, zero, and nothing empty; false for a missing one."""
    number = F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    said = F.when(number, F.try_variant_get(v, "$", "double") != 0).otherwise(~F.to_json(v).isin("null", "false", '""', "[]", "{}"))
    return F.coalesce(said, F.lit(False))


def _text(v: Column) -> Column:
    """Text as it is, other values as JSON writes them (numbers without trailing zeros), null for null."""
    kind = F.schema_of_variant(v)
    return F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind != "VOID", F.to_json(v))


def _count(v: Column) -> Column:
    """A whole number out of a number, a truth value or the text of a whole number; 0 for nothing, null for what is none."""
    kind = F.schema_of_variant(v)
    number = F.when(kind == "STRING", F.trim(F.try_variant_get(v, "$", "string")).try_cast("long")).when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("long"))
    number = F.when(kind.isin("STRING", "BOOLEAN"), number).otherwise(F.try_variant_get(v, "$", "double").cast("long"))
    return F.when(truth(v), number).otherwise(F.lit(0).cast("long"))


def _flags() -> list[tuple[str, str]]:
    """Group and field of what is read by its truth: the flags, and whether a licence is there."""
    return list(dict.fromkeys((g, "present" if kind == "licence" else f) for _, g, f, kind in FIELDS if kind in ("flag", "licence")))


def flattened(rows: DataFrame, json_col: str) -> DataFrame:
    """rows whose text is a JSON object, without that text, with the columns of FIELDS.

    A group that is missing counts as empty: its flags and counts are 0 and its texts null. A group that is no object, null
    included, says nothing: all its columns are null. Fields of another type than expected count by their truth, as text,
    or as null where no whole number can be read from them.
    """
    # what parses and starts with a brace is an object; the schema of a whole verdict would cost more than its parts
    objects = rows.where(F.regexp_like(json_col, F.lit(r"^[ \t\r\n]*\{")) & F.try_parse_json(json_col).isNotNull())
    parsed = objects.withColumn("_v", F.try_parse_json(json_col)).drop(json_col)
    groups = list(dict.fromkeys(g for _, g, _, _ in FIELDS))
    outers = list(dict.fromkeys(g.partition(".")[0] for g in groups))
    paths = outers + [g for g in groups if g not in outers]
    # values of a kind are read by one expression over an array of them: thirty expressions side by side outgrow what the JVM compiles
    each = {
        "_states": ([_member(F.col("_v"), p) for p in paths], lambda m: F.when(m.isNull(), "missing").when(_is_object(m), "object")),
        "_texts": ([_member(F.col("_v"), f"{g}.{f}") for _, g, f, kind in FIELDS if kind in ("text", "licence")], _text),
        "_flags": ([_member(F.col("_v"), f"{g}.{f}") for g, f in _flags()], truth),
        "_counts": ([_member(F.col("_v"), f"{g}.{f}") for _, g, f, kind in FIELDS if kind == "count"], _count),
    }
    parsed = parsed.select("*", *[F.array(*values).alias(n) for n, (values, _) in each.items()]).select(*[c for c in rows.columns if c != json_col], *[F.transform(n, of).alias(n) for n, (_, of) in each.items()])
    out, texts, counts = [], 0, 0
    for name, group, field, kind in FIELDS:
        outer = group.partition(".")[0]
        state = F.get("_states", F.lit(paths.index(group)))
        if outer != group:  # a group that is missing inside of what is no object says nothing either
            around = F.get("_states", F.lit(paths.index(outer)))
            state = F.when(around == "object", state).otherwise(around)
        here, missing = state == "object", state == "missing"
        if kind in ("text", "licence"):
            text, texts = F.get("_texts", F.lit(texts)), texts + 1
            value = F.when(here if kind == "text" else here & F.get("_flags", F.lit(_flags().index((group, "present")))), text)
        elif kind == "flag":
            value = F.when(missing, F.lit(0)).when(here, F.get("_flags", F.lit(_flags().index((group, field)))).cast("int"))
        else:
            count, counts = F.get("_counts", F.lit(counts)), counts + 1
            value = F.when(missing, F.lit(0).cast("long")).when(here, count)
        out.append(value.alias(name))
    return parsed.select(*[c for c in rows.columns if c != json_col], *out)
