"""XML text as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_comments(x: Column) -> Column:
    """Without comments and the blanks and line ends around them."""
    return F.regexp_replace(x, r"(?s)[ \n]*<!--.*?-->[ \n]*", "")


def comments(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(r"(?s)<!--(.*?)-->"), F.lit(1))


def root_offset(x: Column) -> Column:
    """Zero-based place of the root element: after blanks, processing instructions, declarations and comments; null without one."""
    prolog = F.regexp_substr(x, F.lit(r"(?s)\A(?:\s+|<\?.*?\?>|<!--.*?-->|<![^-\[>][^>]*>)*"))
    at = F.coalesce(F.length(prolog), F.lit(0))
    return F.when(F.substring(x, at + 1, F.lit(2)).rlike("^<[A-Za-z_]"), at)


def escape(x: Column) -> Column:
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;")):
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def path_key(path: Column) -> Column:
    """Sort key of a path: at every depth files come before directories, each in order of their names."""
    parts = F.split(path, "/")
    return F.array_join(F.transform(parts, lambda p, i: F.concat(F.when(i == F.size(parts) - 1, F.lit("0")).otherwise(F.lit("1")), p)), "/")
