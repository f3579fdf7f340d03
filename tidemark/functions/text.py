"""Text normalisation as column expressions that stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace, letters with case, and a marker that cannot occur in text (a noncharacter).
_SPACE = r"[\s\x1c-\x1f]+"
_CASED = r"[\p{Lu}\p{Ll}\p{Lt}]"
_MARK = "\ufdd0 "


def strip(column: Column) -> Column:
    """Remove any whitespace, not only blanks, from both ends."""
    return F.regexp_replace(column, f"(?U)^{_SPACE}|{_SPACE}$", "")


def title_case(column: Column) -> Column:
    """Upper case after every character that is not a letter, lower case elsewhere.

    ``initcap`` only starts a word after a blank, so a marked blank is put before every letter
    that follows a non-letter, and taken out again afterwards.
    """
    word_start = f"(?<!{_CASED})(?={_CASED})"
    marked = F.regexp_replace(column, word_start, _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))
