"""Coercion of text and numbers: nothing here raises, what can't be read becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prices in sums: exact, so that the order of rows doesn't matter.
EXACT = "decimal(18,4)"


def exact(c: Column) -> Column:
    return c.cast(EXACT)


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def number_text(c: Column) -> Column:
    """A number written with thousands separators, blanks or a percent sign; blank and junk become null."""
    text = F.regexp_replace(F.trim(c), ",", "")
    return finite(F.regexp_replace(text, r"\s*%+$", "").try_cast("double"))


def ratio(a: Column, b: Column) -> Column:
    """a / b in double; null where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def market_flag(c: Column) -> Column:
    """1 for Y, 0 for everything else."""
    return F.when(F.upper(F.trim(c)) == "Y", F.lit(1)).otherwise(F.lit(0))


def scalar_json(c: Column) -> Column:
    """A cell as a JSON scalar: nan and blank null, digits an integer, other numbers a float, the rest a string."""
    bare = F.regexp_replace(F.trim(c), ",", "")
    empty = c.isNull() | F.lower(F.trim(c)).isin("", "nan", "none", "null")
    return (
        F.when(empty, F.lit("null"))
        .when(bare.rlike(r"^-?\d{1,18}$"), bare.try_cast("bigint").cast("string"))
        .when(bare.rlike(r"^-?\d+\.\d+$"), bare.try_cast("double").cast("string"))
        .otherwise(F.to_json(F.array(F.trim(c))).substr(F.lit(2), F.length(F.to_json(F.array(F.trim(c)))) - 2))
    )


def canonical_json(c: Column) -> Column:
    """Objects and arrays as they parse, other text as a JSON string, blank null."""
    text = blank_to_null(c)
    parsed = F.when(text.rlike(r"^\s*[\{\[]"), F.to_json(F.try_parse_json(text)))
    quoted = F.to_json(F.array(text))
    return F.coalesce(parsed, F.when(text.isNotNull(), quoted.substr(F.lit(2), F.length(quoted) - 2)))


def object_fields(c: Column) -> Column:
    """map<string,string> of a JSON object; one in single quotes is read as if they were double; empty for anything else."""
    text = F.trim(c)
    whole = text.startswith("{") & text.endswith("}")
    fields = lambda t: F.from_json(t, "map<string,string>")
    return F.coalesce(F.when(whole, F.coalesce(fields(text), fields(F.replace(text, F.lit("'"), F.lit('"'))))), F.create_map().cast("map<string,string>"))


def security_in(fields: Column, names: tuple[str, ...] = ("SECURITY", "security", "Security", "SECURITY_NAME", "security_name")) -> Column:
    """The security of a row's fields: the first of ``names`` that isn't blank, else the first value of more than three characters that is no number."""
    named = F.coalesce(*[blank_to_null(F.element_at(fields, n)) for n in names])
    text = F.filter(F.map_values(fields), lambda v: (F.length(F.trim(v)) > 3) & ~F.replace(F.trim(v), F.lit("."), F.lit("")).rlike(r"^\d+$"))
    return F.coalesce(named, F.trim(F.get(text, F.lit(0))))


def with_member(params: Column, name: str, member: Column) -> Column:
    """The JSON object ``params`` with ``member`` (JSON) under ``name``, in place of one that is there; an empty object stands for anything else. Names in order, ``name`` last."""
    parsed = F.try_parse_json(params)
    others = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.map_filter(parsed.cast("map<string,variant>"), lambda k, _: k != name))
    none = F.create_map().cast("map<string,variant>")
    entry = F.create_map(F.lit(name), F.coalesce(F.try_parse_json(member), F.parse_json(F.lit("{}"))))
    return F.to_json(F.map_concat(F.coalesce(others, none), entry))
