"""CSV settings shared by every reader and writer, so that what is written reads back equal."""

from __future__ import annotations

from daybook.functions.text import NULL_TEXT


def csv_options(sep: str = ",", header: bool = False) -> dict[str, str]:
    """Null has its own marker, which keeps it apart from an empty text. Quotes
    are doubled, so a trailing backslash is plain text. The writer would trim
    blanks unless told not to."""
    return {
        "sep": sep,
        "header": str(header).lower(),
        "nullValue": NULL_TEXT,
        "quote": '"',
        "escape": '"',
        "encoding": "UTF-8",
        "lineSep": "\n",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "dateFormat": "yyyy-MM-dd",
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    }
