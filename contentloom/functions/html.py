"""Text and attributes of HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from contentloom.functions.core import col

# Order matters: blocks whose content is no text go first, then the tags.
_REMOVALS = (
    r"(?s)<!--.*?-->",
    r"(?s)<!\[CDATA\[.*?\]\]>",
    r"(?is)<script[^>]*>.*?</script>",
    r"(?is)<style[^>]*>.*?</style>",
    r"(?s)<[^>]*>",
)


def html_text(html: Column | str) -> Column:
    """Visible text, white space collapsed; character entities stay as they are."""
    t = col(html)
    for pattern in _REMOVALS:
        t = F.regexp_replace(t, pattern, " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def quoted_value(html: Column | str, name: str) -> Column:
    """The quoted value after a quoted name (``"name": "value"``); '' where absent."""
    return F.coalesce(
        F.regexp_extract(col(html), f'"{name}"[^"]*"([^"]*)"', 1), F.lit("")
    )


def attribute(html: Column | str, name: str) -> Column:
    """First ``name="value"`` attribute of the page; '' where absent."""
    return F.coalesce(F.regexp_extract(col(html), f'{name}="([^"]*)"', 1), F.lit(""))


def page_title(html: Column | str) -> Column:
    return F.coalesce(
        F.regexp_extract(col(html), r"(?is)<title>(.*?)</title>", 1), F.lit("")
    )
