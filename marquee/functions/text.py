"""Text helpers: year extraction and tokenisation as built-in expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: year in parentheses, and a token = run of >= 2 letters/digits/underscore.
YEAR_PATTERN = r"\((\d{4})\)"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def extract_year(title) -> Column:
    t = F.col(title) if isinstance(title, str) else title
    return F.nullif(F.regexp_extract(t, YEAR_PATTERN, 1), F.lit("")).cast("int")


def tokens(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(TOKEN_PATTERN), 0)
