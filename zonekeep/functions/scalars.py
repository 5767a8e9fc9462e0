"""Scalar rules of the registry and of DNS results, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The query types that can be retried, and final statuses.
RETRY_TYPES = ("A", "AAAA", "CNAME", "MX", "NS", "SOA", "TXT", "CAA", "HTTPS", "SVCB", "DS", "DNSKEY")
FINAL_STATUSES = ("NOERROR", "NXDOMAIN")


def reverse_labels(name: Column) -> Column:
    """``ro.example.www`` to ``www.example.ro``; outer white space and dots are dropped."""
    return F.array_join(F.reverse(F.split(F.btrim(F.btrim(name, F.lit(" \t\n\r\x0b\x0c")), F.lit(".")), r"\.")), ".")


def parse_count(text: Column) -> Column:
    """A whole number with optional commas and outer spaces, null for anything else."""
    bare = F.btrim(F.replace(text, F.lit(","), F.lit("")), F.lit(" \t\n\r\x0b\x0c"))
    # single underscores between digits are allowed, as in the usual number syntax
    return F.when(bare.rlike(r"^[+-]?[0-9]+(?:_[0-9]+)*$"), F.replace(bare, F.lit("_"), F.lit("")).try_cast("bigint"))


def clean_name(name: Column) -> Column:
    return F.lower(F.rtrim(name, F.lit(".")))


def clean_status(status: Column) -> Column:
    return F.upper(F.coalesce(status, F.lit("MISSING")))


def classify_error(status: Column, error: Column) -> Column:
    """The class of a lookup that has no final answer; the first rule that fits counts."""
    text = F.lower(F.coalesce(error, F.lit("")))
    return (
        F.when(status.isin(*FINAL_STATUSES), F.lit(None).cast("string"))
        .when(F.contains(text, F.lit("rate limit exceeded")), "local_rate_limit")
        .when(F.contains(text, F.lit("rate limiter")), "local_rate_limiter_deadline")
        .when((status == "TIMEOUT") | F.contains(text, F.lit("timeout")), "timeout")
        .when(status == "SERVFAIL", "servfail")
        .when(status == "REFUSED", "refused")
        .otherwise("other")
    )


def to_milliseconds(seconds: Column) -> Column:
    return F.round(seconds.cast("double") * 1000, 3)


def retry_trigger(query_type: Column) -> Column:
    """The name that asks the prober for one more try, null for types that cannot be retried."""
    return F.when(query_type.isin(*RETRY_TYPES), F.concat(F.lit("retry-"), F.lower(query_type)))


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value.

    The parser stops after a first value.  What follows it can only stand before both ``]`` and ``}`` if it begins with a
    comma, and then the array has more than one element.
    """
    alone = (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1) & F.json_object_keys(F.concat(F.lit('{"k":'), text, F.lit("}"))).isNotNull()
    return F.try_parse_json(text).isNotNull() & F.coalesce(alone, F.lit(False))


def metadata_json(**fields: Column) -> Column:
    """JSON of the fields in order of name; nulls are kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def utc_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def ends_with_tld(value: Column, tlds: tuple[str, ...] = ("ro",)) -> Column:
    """The cheap test of bulk lists, ahead of any parsing."""
    low = F.rtrim(F.lower(value), F.lit("."))
    out = F.lit(False)
    for t in tlds:
        out = out | F.endswith(low, F.lit(f".{t}"))
    return out
