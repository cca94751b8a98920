"""Outcome messages: what each says about a download."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = ("dns", "unreachable", "permanent", "transient", "other")


def http_code(message: Column) -> Column:
    """The code of an `HTTP Error nnn` message, else NULL."""
    return F.regexp_extract(message, r"HTTP Error (\d{3})", 1).try_cast("int")


def bucket(message: Column) -> Column:
    """success, or the first bucket that applies; what none knows is `other`, never dropped."""
    code = http_code(message)
    return (
        F.when(message == "success", "success")
        .when(message.rlike(r"\[Errno -[2345]\]"), "dns")
        .when(message.rlike(r"\[Errno (101|113)\]"), "unreachable")
        .when(code.isin(408, 425, 429) | code.between(500, 599), "transient")
        .when(code.between(400, 499), "permanent")
        .when(code.isNotNull(), "other")
        .when(message.contains("timed out") | F.lower(message).contains("timeout"), "transient")
        .otherwise("other")
    )


def rate_limited(message: Column) -> Column:
    """429 only; such a message is in its bucket as well."""
    first = (message != "success") & ~message.rlike(r"\[Errno -[2345]\]") & ~message.rlike(r"\[Errno (101|113)\]")
    return F.coalesce(first & (http_code(message) == 429), F.lit(False))


def http_message(code: Column, reason: Column) -> Column:
    return F.rtrim(F.concat(F.lit("HTTP Error "), code.cast("string"), F.lit(": "), F.coalesce(reason, F.lit(""))))


def strip(text: Column) -> Column:
    """Both ends without white space of any script."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
