"""Small Column helpers that settle missing values, ratios and JSON once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``body``.

    Inside a lambda a plain column reference may be replaced by its whole defining
    expression and then run once per array element; a bound variable never is.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add costly columns that later filters and projections read without repeating them.

    A filter moves below a plain projection by copying the expressions it reads, and the
    copies run again per use. It does not move below a generator, while filters on other
    columns still do. The generator here emits exactly one row per row.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline_outer(F.array(row)))


def exploded(
    df: DataFrame, keep: Sequence[Column | str], items: Column, name: str, outer: bool = False
) -> DataFrame:
    """One row per array item with the kept columns only.

    The kept columns and the array are computed first. In a single select they would be
    computed after the explode, for every item, and their inputs, such as the whole text,
    would be copied into every item's row.
    """
    slim = df.select(*keep, items.alias(name))
    explode = F.explode_outer if outer else F.explode
    others = [c for c in slim.columns if c != name]
    return slim.select(*others, explode(name).alias(name))


def ratio(part: Column, whole: Column) -> Column:
    """Division that is NULL (never an error) for an empty whole, so gates drop the row."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def joined_concat(sep: str, *cols: Column | str) -> Column:
    """Concatenate with the separator always present; missing parts count as ''."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(text_or_empty(c))
    return F.concat(*parts)


def comma_free_join(items: Column) -> Column:
    """Comma-joined list whose items lose their own commas; '' for none."""
    bare = F.transform(items, lambda x: F.replace(x, F.lit(","), F.lit("")))
    return F.coalesce(F.array_join(bare, ","), F.lit(""))


def json_value(raw: str, path: str) -> Column:
    """Scalar at a JSON path of a string column; '' where it is missing, malformed, an
    array or an object.

    Only a value that looks like a container is parsed a second time, to tell a JSON
    string that starts with a bracket from a real container.
    """
    return F.expr(
        f"""transform(array({raw}), doc -> transform(array(get_json_object(doc, '{path}')),
              value -> CASE
                WHEN value IS NULL THEN ''
                WHEN left(value, 1) NOT IN ('[', '{{') THEN value
                WHEN schema_of_variant(try_variant_get(try_parse_json(doc), '{path}', 'variant'))
                     RLIKE '^(ARRAY|OBJECT)' THEN ''
                ELSE value END)[0])[0]"""
    )


def json_strings(raw: str, path: str) -> Column:
    """JSON array at a path as an array of strings; empty where there is none."""
    return F.expr(
        f"coalesce(from_json(get_json_object({raw}, '{path}'), 'array<string>'), "
        "CAST(array() AS array<string>))"
    )


def contains_any_ignore_case(c: Column | str, needles: Sequence[str]) -> Column:
    text = F.lower(col(c))
    found = F.lit(False)
    for needle in needles:
        found = found | text.contains(needle.lower())
    return found


def matching_patterns(c: Column | str, patterns: Sequence[str]) -> Column:
    """1-based positions of the patterns that occur in the text."""
    text = col(c)
    marks = [F.when(text.rlike(p), F.lit(i)) for i, p in enumerate(patterns, start=1)]
    return F.array_compact(F.array(*marks))


def tag_value(tags: Column | str, key: str) -> Column:
    """Value of one tag of a map column; NULL when absent."""
    return F.try_element_at(col(tags), F.lit(key))


def tag_value_from_pairs(tags: Column | str, key: str) -> Column:
    """The same for tags kept as an array of (name, value)."""
    hits = F.filter(col(tags), lambda t: t["name"] == F.lit(key))
    return F.get(hits, F.lit(0))["value"]


def readable_bytes(size: Column | str) -> Column:
    """'12.00 KiB'-style size."""
    n = col(size).cast("double")
    out = F.format_string("%.2f %s", n, F.lit("B"))
    for power, unit in enumerate(("KiB", "MiB", "GiB", "TiB", "PiB"), start=1):
        scale = float(1024**power)
        out = F.when(n >= scale, F.format_string("%.2f %s", n / scale, F.lit(unit))).otherwise(out)
    return out
