"""Column expressions on strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the five delimiters are space, tab, newline, carriage return and form feed. Vertical
# tab, no-break space and other Unicode spaces are part of a word, so `\s` would be wrong.
DELIMITERS = r"[ \t\n\r\f]+"


def words(text: str | Column) -> Column:
    """Array of the words of ``text``; holds an empty string where the text begins or ends with a
    delimiter. Filtering those after ``explode`` keeps the whole stage in generated code, which a
    higher-order ``filter`` on the array would not."""
    return F.split(text, DELIMITERS)


def trim_control(text: str | Column) -> Column:
    """Strip spaces and all control characters up to U+0020 from both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
