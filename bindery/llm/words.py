"""Words: longest runs of letters and digits, in lower case. Punctuation and blanks never count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """The words of a text in order; null and wordless texts give an empty array."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.array().cast("array<string>"))
