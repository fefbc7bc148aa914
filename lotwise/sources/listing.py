"""Links in listing pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.functions.values import find_all, last_item


def links(html: Column | str, pattern: str) -> Column:
    """What the first group of ``pattern`` matches, in page order."""
    return find_all(html, pattern, 1)


def last_link(html: Column | str, pattern: str, containing: str = "") -> Column:
    """The last link whose text contains ``containing``: the newest of a dated list."""
    return last_item(F.filter(links(html, pattern), lambda link: link.contains(containing)))
