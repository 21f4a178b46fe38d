"""Text normalisation and key derivation (Column -> Column).

All built-in, JVM-side expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions._col import col

# ---- fixed values (must equal the reference's for equal results) ----------
# Boolean spellings, compared after trim + lower-case.
TRUE_WORDS = ("true", "1", "yes", "y", "t")
FALSE_WORDS = ("false", "0", "no", "n", "f")
# Score source: these spellings mean Rotten Tomatoes, anything else is IMDb.
ROTTEN_TOMATOES_WORDS = ("rt", "rotten_tomatoes")
ROTTEN_TOMATOES = "rotten_tomatoes"
IMDB = "imdb"
# Separator between title and content type in the join key, default type,
# and the label for a missing group value in gold.
KEY_SEPARATOR = "|"
DEFAULT_CONTENT_TYPE = "movie"
UNKNOWN = "Unknown"
# ---------------------------------------------------------------------------


def str_trim(c) -> Column:
    """Strip leading/trailing spaces (only U+0020, tabs are kept)."""
    return F.trim(col(c))


def str_lower_trim(c) -> Column:
    return F.lower(F.trim(col(c)))


def str_initcap(c) -> Column:
    """Trim, then upper-case the first letter of each space-separated word
    and lower-case the rest (``SCI-FI`` -> ``Sci-fi``)."""
    return F.initcap(F.trim(col(c)))


def movie_key(title, content_type: str = DEFAULT_CONTENT_TYPE) -> Column:
    """Join key ``Initcap(title)|type``; null when the title is null/blank (a null part
    makes the whole concatenation null)."""
    return F.concat(F.nullif(str_initcap(title), F.lit("")), F.lit(KEY_SEPARATOR + content_type))


def movie_key_pair(title, content_type) -> Column:
    """Key from two already-clean columns (null parts are skipped)."""
    return F.concat_ws(KEY_SEPARATOR, col(title), col(content_type))


def _meaning(c, words: dict) -> Column:
    """What a spelling stands for, compared after trim + lower-case; null if unknown."""
    pairs = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return F.try_element_at(pairs, str_lower_trim(c))


def bool_map(c, true_words=TRUE_WORDS, false_words=FALSE_WORDS) -> Column:
    """Three-valued boolean: known spellings map to true/false, the rest null."""
    return _meaning(c, {w: True for w in true_words} | {w: False for w in false_words})


def source_canon(c) -> Column:
    """``rt``/``rotten_tomatoes`` -> rotten_tomatoes; anything else (null too) -> imdb."""
    return coalesce_default(_meaning(c, dict.fromkeys(ROTTEN_TOMATOES_WORDS, ROTTEN_TOMATOES)), IMDB)


def coalesce_default(c, default=UNKNOWN) -> Column:
    return F.coalesce(col(c), F.lit(default))


def nonblank(c) -> Column:
    """Predicate: not null and not the empty string."""
    c = col(c)
    return c.isNotNull() & (c != "")
