"""Word casing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which a warehouse `initcap` starts a new word, besides the space.
WORD_BREAKS = r"[\t\n\x0B\f\r\[\](){}/|\\<>!?@\"^#$&~_,.:;*%+\-]"
# Display titles start a new word after anything that is not a letter.
NON_LETTERS = r"[^\p{L} ]"

_MARK = "\u0001"


def _capitalize_after(text: Column, breaks: str) -> Column:
    # Spark's initcap breaks at spaces only, so every other break gets a marked space that is
    # removed afterwards. This keeps the expression inside generated code.
    spaced = F.regexp_replace(F.lower(text), f"({breaks})", f"$1{_MARK} ")
    return F.replace(F.initcap(spaced), F.lit(f"{_MARK} "), F.lit(""))


def title_words(text: Column) -> Column:
    """``NON-HISPANIC`` -> ``Non-Hispanic``."""
    return _capitalize_after(text, WORD_BREAKS)


def display_label(name: Column, prefix: str = "") -> Column:
    """``cc_diabetes`` -> ``Diabetes``; ``readmission_30d`` -> ``Readmission 30D``."""
    bare = F.replace(name, F.lit(prefix), F.lit("")) if prefix else name
    return _capitalize_after(F.replace(bare, F.lit("_"), F.lit(" ")), NON_LETTERS)
