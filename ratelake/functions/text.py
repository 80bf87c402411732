"""Text clean-up, hashes and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelake import fixed


def collapse_whitespace(text: Column) -> Column:
    """Runs of whitespace (ECMAScript's definition) become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, fixed.WHITESPACE + "+", " "))


def truncate(text: Column, limit: int) -> Column:
    return F.left(text, F.lit(limit))


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def content_type(artifact_type: Column) -> Column:
    return F.when(artifact_type == "html", "text/html").otherwise("application/pdf")


def canonical_carrier(carrier: Column) -> Column:
    """Known carrier in its canonical spelling; NULL marks an unsupported one."""
    out = F.lit(None).cast("string")
    for name in fixed.CARRIERS:
        out = F.when(F.lower(carrier) == name.lower(), name).otherwise(out)
    return out


def relative_path(root: Column, path: Column) -> Column:
    """``path`` below ``root``; NULL when it is not below it."""
    prefix = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    return F.when(F.startswith(path, prefix), F.substring(path, F.length(prefix) + 1, F.length(path)))


def absolute_path(root: Column, path: Column) -> Column:
    return F.concat(F.rtrim(root, F.lit("/")), F.lit("/"), path)
