"""JSON documents that are parsed once into a variant and read by path from there."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from contentloom.functions.core import col, let

_CONTAINER = "^(ARRAY|OBJECT)"
_TEXTS = "array<string>"


def parsed(raw: Column | str) -> Column:
    """The document as a variant; NULL for malformed ones."""
    return F.try_parse_json(col(raw))


def _is_container(value: Column) -> Column:
    return F.schema_of_variant(value).rlike(_CONTAINER)


def _unparsed_text(raw: Column, path: str) -> Column:
    """``text_at`` by a scan of the text, for documents that no variant holds."""

    def of(value: Column) -> Column:
        container = _is_container(F.try_variant_get(F.try_parse_json(value), "$", "variant"))
        looks = F.substring(value, 1, 1).isin("[", "{")
        return F.when(value.isNull() | (looks & F.coalesce(container, F.lit(False))), "").otherwise(value)

    return let(F.get_json_object(raw, path), of)


def text_at(document: Column, path: str, raw: Column | None = None) -> Column:
    """Scalar at a path as text; '' where it is missing, null, an array or an object.

    ``raw`` is the document's text. It is scanned only where there is no variant although
    there is a text: documents with a repeated name, or beyond a variant's size. A malformed
    text gives '' there as well.
    """

    def of(value: Column) -> Column:
        # Only a text that looks like a container is looked up again, to tell the two apart.
        looks = F.substring(value, 1, 1).isin("[", "{")
        container = looks & _is_container(F.try_variant_get(document, path, "variant"))
        return F.when(value.isNull() | container, "").otherwise(value)

    found = let(F.try_variant_get(document, path, "string"), of)
    if raw is None:
        return found
    return F.when(document.isNull() & (raw != ""), _unparsed_text(raw, path)).otherwise(found)


def texts_at(document: Column, path: str, raw: Column | None = None) -> Column:
    """Array at a path as texts; empty where there is none."""
    none = F.array().cast(_TEXTS)
    found = F.coalesce(F.try_variant_get(document, path, _TEXTS), none)
    if raw is None:
        return found
    scanned = F.coalesce(F.from_json(F.get_json_object(raw, path), _TEXTS), none)
    return F.when(document.isNull() & (raw != ""), scanned).otherwise(found)


def read_once(raw: Column | str, fields: Mapping[str, tuple[str, str]]) -> Column:
    """struct of several fields of one JSON text, parsed a single time.

    ``fields`` maps a name to a path and a kind: ``text`` or ``texts``.
    """
    raw = col(raw)
    kinds = {"text": text_at, "texts": texts_at}

    def of(document: Column) -> Column:
        return F.struct(*[kinds[kind](document, path, raw).alias(name) for name, (path, kind) in fields.items()])

    return let(parsed(raw), of)


def number_at(document: Column, path: str, kind: str) -> Column:
    """A JSON whole number at a path that fits ``kind``; NULL for all else, texts of digits
    included."""

    def of(value: Column) -> Column:
        return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", kind))

    return let(F.try_variant_get(document, path, "variant"), of)


def schema_report(document: Column | str) -> Column:
    """Aggregate: the one schema that all documents fit."""
    return F.schema_of_variant_agg(col(document))
