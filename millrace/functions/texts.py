"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pseudonym(c: Column | str) -> Column:
    """SHA-1 of the text, for e-mail addresses and other direct identifiers."""
    return F.sha1(_col(c))


def initial_caps(c: Column | str) -> Column:
    """First letter of each word in upper case, the rest in lower case."""
    return F.initcap(_col(c))


def name_like(c: Column | str, pattern: str) -> Column:
    """Case-blind LIKE: the pattern is compared with the upper-cased text."""
    return F.upper(_col(c)).like(pattern)


def swap_url_host(c: Column | str, base: str = "https://shop.example.com/") -> Column:
    """Put ``base`` in place of the scheme and host of a URL."""
    return F.regexp_replace(_col(c), r"^https?://[^/]*/", base)
