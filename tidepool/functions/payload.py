"""Typed access to semi-structured payloads.

The payload is parsed once per row into a VARIANT (``try_parse_json``: unparsable
text gives NULL instead of failing the task); every field getter reads that one
value. A string getter returns a value only when the JSON value *is* a string:
objects, numbers, booleans and nulls give NULL, and so does ''.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INTEGER_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def parse(raw) -> Column:
    """Payload text -> VARIANT; NULL when the text is not JSON."""
    return F.try_parse_json(raw)


def json_type(v, path: str) -> Column:
    """Type name of the value at ``path`` ('STRING', 'BIGINT', 'OBJECT<...>', 'VOID'
    for JSON null); NULL when the path is missing."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def json_str(v, path: str) -> Column:
    """The string at ``path``, NULL when missing, not a string, or ''."""
    s = F.when(json_type(v, path) == "STRING", F.try_variant_get(v, path, "string"))
    return F.nullif(s, F.lit(""))


def json_long(v, path: str) -> Column:
    """T3 (strict policy): a BIGINT only for integer-typed JSON numbers. 100.5, "200",
    null, objects and missing paths give NULL (a lenient cast would turn 100.5 into
    100 and "200" into 200)."""
    return F.when(json_type(v, path).isin(*_INTEGER_TYPES),
                  F.try_variant_get(v, path, "bigint"))


def json_str_array(v, path: str) -> Column:
    """T4: the string elements of the array at ``path`` in their order; missing, null
    or non-array values give []; non-string and null elements are dropped."""
    arr = F.try_variant_get(v, path, "array<variant>")
    strings = F.transform(F.filter(arr, lambda x: F.schema_of_variant(x) == "STRING"),
                          lambda x: F.variant_get(x, "$", "string"))
    return F.coalesce(strings, F.array().cast("array<string>"))


def unify(v, paths: Sequence[str]) -> Column:
    """T5: first non-empty string over an ordered list of candidate paths."""
    return F.coalesce(*[json_str(v, p) for p in paths])


def default_mode(v, path: str = "$.source_mode", default: str = "api") -> Column:
    """The mode field, ``default`` when missing (unparsable payloads included)."""
    return F.coalesce(json_str(v, path), F.lit(default))


def byte_length(c) -> Column:
    """UTF-8 byte length of a possibly NULL text (0 for NULL). Bytes, not
    characters: a 4-letter Cyrillic word is 8."""
    return F.octet_length(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))


def has_detail(mode: Column, status: Column) -> Column:
    """Three-valued: an html row with no status gives NULL."""
    return (mode == "html_fallback") & (status == "ok")


def quality_score(mode: Column, status: Column) -> Column:
    """4 detail ok / 3 captcha / 2 other html / 1 api / 0 unknown (a NULL
    condition falls through to the next branch)."""
    html = mode == "html_fallback"
    return (F.when(html & (status == "ok"), 4)
            .when(html & (status == "captcha"), 3)
            .when(html, 2)
            .when(mode == "api", 1)
            .otherwise(0))


# The output fields of the typed staging relation and, per field, the
# payload paths tried in priority order (detail > card > api).
STAGING_SPEC: dict[str, tuple[str, ...]] = {
    "title": ("$.detail_title", "$.title", "$.name"),
    "employer_name": ("$.detail_employer", "$.employer", "$.employer.name"),
    "vacancy_url": ("$.url", "$.alternate_url"),
    "experience": ("$.experience", "$.experience_card"),
    "employment": ("$.employment", "$.work_format_card"),
    "schedule_text": ("$.schedule", "$.work_format_card"),
    "work_format_card": ("$.work_format_card",),
    "salary_text": ("$.salary_detail", "$.salary"),
    "address_text": ("$.address_detail", "$.address"),
    "description": ("$.description",),
    "card_text": ("$.card_text",),
    "detail_status": ("$.detail_status",),
    "detail_error": ("$.detail_error",),
}


def staging(df: DataFrame, raw: str = "raw_json",
            keep: Sequence[str] | None = None,
            spec: Mapping[str, Sequence[str]] = STAGING_SPEC,
            keep_raw: bool = True) -> DataFrame:
    """T1-T12 as one projection: bronze rows -> typed staging rows (one to one).

    The VARIANT is computed in its own projection below the getters, so each payload
    is parsed once per row, and it never leaves the task (no shuffle carries it).
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c != raw]
    parsed = df.select(*keep, F.col(raw), parse(F.col(raw)).alias("_v"))
    v = F.col("_v")
    fields = {out: unify(v, paths) for out, paths in spec.items()}
    typed = parsed.select(
        *keep,
        default_mode(v).alias("source_mode"),
        *[c.alias(n) for n, c in fields.items()],
        json_long(v, "$.salary.from").alias("salary_from"),
        json_long(v, "$.salary.to").alias("salary_to"),
        json_str(v, "$.salary.currency").alias("salary_currency"),
        json_str_array(v, "$.skills").alias("skills"),
        *([F.col(raw)] if keep_raw else []),
    )
    mode, status = F.col("source_mode"), F.col("detail_status")
    return typed.select(
        "*",
        byte_length("description").cast("int").alias("description_length"),
        F.size("skills").alias("skills_count"),
        has_detail(mode, status).alias("has_detail"),
        quality_score(mode, status).alias("quality_score"),
    )
