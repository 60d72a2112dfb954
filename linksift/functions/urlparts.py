"""Splitting URL text into scheme, host, port, path and query with native string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linksift.constants import PARAMS_SCHEMES, SUSPICIOUS_TLDS, TLD_PATTERN
from linksift.functions.text import C0_AND_BLANK, DIGIT_CLASS, without_blanks

# Shapes of an IPv4 octet and of bracketed hosts.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}(?:\.{_OCTET}){{3}}\z"
_GROUP = "[0-9a-fA-F]{1,4}"
_IPV6_FULL = rf"^(?:{_GROUP}:){{7}}{_GROUP}\z"
_IPV6_SHORT = rf"^(?!:*(?:[^:]+:+){{7}}[^:])(?:{_GROUP}(?::{_GROUP})*)?::(?:{_GROUP}(?::{_GROUP})*)?\z"
_FUTURE_HOST = r"^v[a-fA-F0-9]+\..+\z"


def searchable(full: Column) -> Column:
    """``full`` as a splitter sees it: no tab, CR or LF; no control or blank at the left."""
    for char in "\t\r\n":  # mostly absent: translate would look every character up
        full = F.replace(full, F.lit(char), F.lit(""))
    return F.ltrim(full, F.lit(C0_AND_BLANK))


def before_fragment_and_query(text: Column) -> Column:
    return F.substring_index(F.substring_index(text, "#", 1), "?", 1)


def query_of(text: Column) -> Column:
    no_fragment = F.substring_index(text, "#", 1)
    start = F.length(F.substring_index(no_fragment, "?", 1)) + 2
    return F.substring(no_fragment, start, F.length(no_fragment))


def scheme_of(front: Column) -> Column:
    """Lower-cased scheme, '' when the text before the first ':' is not one."""
    return F.lower(F.regexp_extract(front, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def after_scheme(front: Column, scheme: Column) -> Column:
    return F.when(scheme == "", front).otherwise(F.substring(front, F.length(scheme) + 2, F.length(front)))


def netloc_of(rest: Column) -> Column:
    return F.when(
        rest.startswith("//"), F.substring_index(F.substring(rest, F.lit(3), F.length(rest)), "/", 1)
    ).otherwise(F.when(rest.isNotNull(), F.lit("")))


def raw_path_of(rest: Column, netloc: Column) -> Column:
    return F.when(rest.startswith("//"), F.substring(rest, F.length(netloc) + 3, F.length(rest))).otherwise(rest)


def path_of(raw_path: Column, scheme: Column) -> Column:
    """The path without the ;params of its last segment, for schemes that have them."""
    return F.when(
        raw_path.contains(";") & scheme.isin(*PARAMS_SCHEMES),
        F.regexp_replace(raw_path, r"(?s)^((?:.*/)?[^/;]*);[^/]*\z", "$1"),
    ).otherwise(raw_path)


def host_error(netloc: Column) -> Column:
    """Why the authority cannot be read, NULL when it can."""
    opened, closed = netloc.contains("["), netloc.contains("]")
    inner = F.substring_index(_after(netloc, "["), "]", 1)
    address = F.regexp_replace(
        F.regexp_replace(inner, "%.*", ""), rf"(?<=:){_OCTET}(?:\.{_OCTET}){{3}}\z", "0:0"
    )
    known = address.rlike(_IPV6_FULL) | address.rlike(_IPV6_SHORT) | inner.rlike(_FUTURE_HOST)
    return F.when(opened != closed, F.lit("Invalid IPv6 URL")).when(
        opened & closed & ~known,
        F.concat(F.lit("'"), inner, F.lit("' does not appear to be an IPv4 or IPv6 address")),
    )


def _after(c: Column, sep: str) -> Column:
    """Text after the first ``sep``; '' when there is none."""
    start = F.length(F.substring_index(c, sep, 1)) + 1 + len(sep)
    return F.substring(c, start, F.length(c))


def host_of(netloc: Column) -> Column:
    info = F.substring_index(netloc, "@", -1)
    return F.lower(
        F.when(info.contains("["), F.substring_index(_after(info, "["), "]", 1)).otherwise(
            F.substring_index(info, ":", 1)
        )
    )


def port_of(netloc: Column) -> Column:
    """Port number 0..65535, NULL when absent or not one."""
    info = F.substring_index(netloc, "@", -1)
    tail = F.when(info.contains("["), _after(_after(info, "["), "]")).otherwise(info)
    text = _after(tail, ":")
    number = F.when(text.rlike(r"^[0-9]+\z"), text.try_cast("int"))
    return F.when(number <= 65535, number)


def labels_of(host: Column) -> Column:
    return without_blanks(F.split(host, r"\."))


def is_digits(c: Column) -> Column:
    return c.rlike(rf"^[{DIGIT_CLASS}]+\z")


def tld_of(labels: Column) -> Column:
    """Last of at least two labels if it looks like a top-level domain, else ''."""
    last = F.try_element_at(labels, F.lit(-1))
    fits = last.rlike(rf"^{TLD_PATTERN}\z") | (last.startswith("xn--") & ~is_digits(last))
    return F.when((F.size(labels) >= 2) & fits, last).otherwise(F.when(labels.isNotNull(), F.lit("")))


def is_suspicious_tld(tld: Column) -> Column:
    return tld.isin(*SUSPICIOUS_TLDS)
