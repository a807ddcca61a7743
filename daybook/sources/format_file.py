"""Delimited text whose layout is told by a format file.

A format file names its version, the number of fields, and for each field, in the
order of the data file: its number, host type, prefix length, length, terminator,
the number of its column in the target, that column's name, and a collation. A
field ends at its terminator, or after its length where it has none. Column 0
skips the field.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from daybook.functions import text
from daybook.operators.constraints import computed_once
from daybook.schema import CORRUPT
from daybook.sources.lines import read_lines

# How terminators are spelled, and the host types of character data.
ESCAPES = {"\\t": "\t", "\\n": "\n", "\\r": "\r", "\\0": "\0", "\\\\": "\\", '\\"': '"'}
TEXT_TYPES = ("SQLCHAR", "SQLNCHAR", "SQLINT", "SQLBIGINT", "SQLDECIMAL", "SQLNUMERIC", "SQLDATE", "SQLDATETIME2")
_FIELD = re.compile(r'(\d+)\s+(\w+)\s+(\d+)\s+(\d+)\s+"((?:[^"\\]|\\.)*)"\s+(\d+)\s+(\S+)(?:\s+(.*))?$')
#: Stands between fields once they are cut; lines hold none, as NULs are taken out.
_CUT = "\0"


@dataclass(frozen=True)
class Field:
    name: str
    column: int
    length: int
    terminator: str


class FormatError(ValueError):
    pass


def parse_format(content: str) -> list[Field]:
    """The fields in the order of the data file."""
    lines = [line.strip() for line in content.splitlines() if line.strip()]
    if len(lines) < 2 or not re.fullmatch(r"\d+\.\d+", lines[0]) or not lines[1].isdigit():
        raise FormatError("a format file begins with its version and the number of fields")
    if len(lines) - 2 != int(lines[1]):
        raise FormatError(f"{lines[1]} fields are announced, {len(lines) - 2} described")
    fields = []
    for number, line in enumerate(lines[2:], 1):
        found = _FIELD.match(line)
        if not found or int(found[1]) != number:
            raise FormatError(f"field {number} is not described by: {line}")
        _, kind, prefix, length, terminator, column, name, _ = found.groups()
        if kind not in TEXT_TYPES or int(prefix):
            raise FormatError(f"field {number} is binary; only character data is read")
        terminator = re.sub(r"\\.", lambda m: ESCAPES.get(m[0], m[0][1]), terminator)
        if not terminator and not int(length):
            raise FormatError(f"field {number} has neither a terminator nor a length")
        fields.append(Field(name, int(column), int(length), terminator))
    columns = [f.column for f in fields if f.column]
    if len(set(columns)) != len(columns):
        raise FormatError("a column is filled twice")
    if not fields[-1].terminator.endswith("\n"):
        raise FormatError("the last field has to end with the line")
    if any("\n" in f.terminator for f in fields[:-1]):
        raise FormatError("only the last field may end with the line")
    return fields


def read_format(spark: SparkSession, path: str) -> list[Field]:
    """The format file at any path that Spark reads; it has one line per field."""
    return parse_format("\n".join(row["value"] for row in spark.read.option("wholetext", "true").text(path).collect()))


def record_pattern(fields: list[Field]) -> str:
    """A pattern that matches a whole line, with a group for each field."""
    parts = []
    for field in fields[:-1]:
        if field.terminator:
            most = f"{{0,{field.length}}}?" if field.length else "*?"
            parts.append(f"((?:(?!{re.escape(field.terminator)}).){most}){re.escape(field.terminator)}")
        else:
            parts.append(f"(.{{{field.length}}})")
    last = fields[-1]
    most = f"{{0,{last.length}}}" if last.length else "*"
    return "(?s)^" + "".join(parts) + f"(.{most}){re.escape(last.terminator[:-1])}$"


def split_by_format(line: Column, fields: list[Field]) -> Column:
    """One line as a struct of the target's columns, in their order, all text; a line that doesn't fit keeps
    itself in ``_corrupt_record``. The pattern is matched once. Blanks that fill a
    fixed length are not part of the text; a null is spelled ``NULL``."""
    pattern, groups = record_pattern(fields), range(1, len(fields) + 1)
    cut = F.split(F.regexp_replace(line, pattern, _CUT.join(f"${k}" for k in groups)), _CUT, -1)
    fits = line.rlike(pattern)
    columns = []
    for at, field in sorted(enumerate(fields), key=lambda x: x[1].column):
        if field.column:
            value = F.rtrim(F.get(cut, F.lit(at))) if not field.terminator else F.get(cut, F.lit(at))
            columns.append(F.when(fits, F.nullif(value, F.lit(text.NULL_TEXT))).alias(field.name))
    return F.struct(*columns, F.when(~fits, line).alias(CORRUPT))


def read_by_format(spark: SparkSession, path: str, fields: list[Field]) -> DataFrame:
    """All lines of the data files as text columns, named and ordered as the target's."""
    line = text.strip_nul(F.col("line"))
    cut = read_lines(spark, path).select(computed_once(split_by_format(line, fields)).alias("f"))
    return cut.select("f.*")


def describe(layout: T.StructType, sep: str = "|", version: str = "14.0") -> str:
    """A format file for a layout with one separator."""
    rows = [
        f'{n}\tSQLCHAR\t0\t0\t"{sep if n < len(layout) else chr(92) + "n"}"\t{n}\t{field.name}\t""'
        for n, field in enumerate(layout, 1)
    ]
    return "\n".join([version, str(len(layout)), *rows]) + "\n"
