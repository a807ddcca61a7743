"""Text expressions: the null marker, key comparison, line inspection."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: how a null is spelled in an exported file.
NULL_TEXT = "NULL"


def null_sentinel(value: Column) -> Column:
    """Text of ``value``; every null becomes the marker, whatever the input type."""
    return F.coalesce(value.cast("string"), F.lit(NULL_TEXT))


def key_text(value: Column) -> Column:
    """How the target table compares text: case and trailing spaces do not count.

    A plain normalised string keeps the hash aggregate, which a collated
    grouping key would lose.
    """
    return F.lower(F.rtrim(value))


def utf16_length(value: Column) -> Column:
    """Length as the target's text type counts it: a character above U+FFFF takes two units."""
    return F.char_length(value) + F.regexp_count(value, F.lit(r"[\x{10000}-\x{10FFFF}]"))


def nul_char() -> Column:
    return F.chr(F.lit(0))


def strip_nul(line: Column) -> Column:
    return F.replace(line, nul_char(), F.lit(""))


def has_nul(line: Column) -> Column:
    return F.contains(line, nul_char())


def has_carriage_return(line: Column) -> Column:
    """The line ended in CR LF; visible only when lines were split at LF alone."""
    return F.endswith(line, F.lit("\r"))


def looks_binary(line: Column) -> Column:
    """Control characters other than NUL, tab and line ends, or bytes that are not UTF-8."""
    # The possessive quantifier scans a clean line once, without backtracking.
    return ~line.rlike("(?s)^[^\\x01-\\x08\\x0E-\\x1F]*+\\z") | ~F.is_valid_utf8(line)


def separator_count(line: Column, sep: str) -> Column:
    """How often ``sep``, one ASCII character, occurs. Bytes are cheaper to count
    than characters and give the same difference."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(sep), F.lit("")))


def looks_like_header(line: Column) -> Column:
    """The three key names in order, in any case."""
    return line.rlike("(?i)category.*region.*sale_date")
