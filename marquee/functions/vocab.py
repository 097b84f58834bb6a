"""Fixed values that must equal the reference for identical results."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: genre vocabulary; its order defines the 20 vector positions.
GENRE_VOCAB = [
    "Action", "Adventure", "Animation", "Children", "Comedy", "Crime",
    "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "IMAX",
    "Musical", "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western",
    "(no genres listed)",
]
# FIXED VALUES: genre token given to titles read from the pipe-separated item file.
NO_GENRES = "(no genres listed)"
# FIXED VALUES: default release year for items without one; default ratings bounds.
DEFAULT_YEAR = 1995
RATING_MIN = 0.5
RATING_MAX = 5.0
# FIXED VALUES: the scoring method names and top-N kept per list.
METHODS = ["cosine", "dot", "l2", "learned"]
TOP_N = 20
# FIXED VALUES: strings that pandas reads as missing by default (used only when pandas_na=True).
PANDAS_NA = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def genre_vocab_col() -> Column:
    """The vocabulary as an array literal column."""
    return F.array(*[F.lit(g) for g in GENRE_VOCAB])


def vocab_duckdb() -> str:
    return "[" + ", ".join("'" + g.replace("'", "''") + "'" for g in GENRE_VOCAB) + "]"
