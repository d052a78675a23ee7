"""Entity-list splitting, tokens and title case as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Business suffixes that stay attached to the name before them (lower-cased input).
# The loose list needs no entry for "co., ltd.": both of its commas are kept by "co." and "ltd".
LOOSE_SUFFIXES = r"llc\.?|inc\.?|ltd\.?|l\.l\.c\.?|co\.|corp\.?"
LOOSE_MARK = "|||"
STRICT_SUFFIXES = [
    r"co\.\s*,\s*ltd\.?", r"llc\.?", r"inc\.?", r"ltd\.?", r"l\.l\.c\.?", r"co\.", r"corp\.?",
]
STRICT_MARK = "\u0000"

# Words left out of title counts.
STOP_WORDS = [
    "the", "of", "and", "a", "an", "in", "to", "is", "for", "on", "with",
    "at", "by", "from", "or", "be", "as", "it", "my", "no", "ii",
]


def _loose_names(col: Column) -> Column:
    marked = F.regexp_replace(col, rf",\s*({LOOSE_SUFFIXES})", LOOSE_MARK + "$1")
    return F.transform(
        F.split(marked, ","), lambda part: F.trim(F.replace(part, F.lit(LOOSE_MARK), F.lit(", ")))
    )


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _strict_names(col: Column) -> Column:
    # One pass per suffix, in list order: a suffix counts only if a comma or the end follows it at
    # that moment, so a comma marked by an earlier pass no longer qualifies.
    marked = reduce(
        lambda text, suffix: F.regexp_replace(
            text, rf"(?U),\s*(?={suffix}(?:\s*,|\s*$))", STRICT_MARK
        ),
        STRICT_SUFFIXES,
        col,
    )
    return F.transform(
        F.split(marked, ","), lambda part: _strip(F.replace(part, F.lit(STRICT_MARK), F.lit(", ")))
    )


def split_entities(col: Column, mode: str = "loose") -> Column:
    """Entity list as an array of clean names; null and blank text give an empty array.

    A text without a comma, as most are, skips the suffix patterns.
    """
    if mode == "loose":
        names, single = _loose_names(col), F.trim(F.replace(col, F.lit(LOOSE_MARK), F.lit(", ")))
    elif mode == "strict":
        names, single = _strict_names(col), _strip(col)
    else:
        raise ValueError(f"unknown splitter mode: {mode}")
    split = F.when(F.contains(col, F.lit(",")), names).otherwise(F.array(single))
    nothing = F.array().cast("array<string>")
    return F.when(col.isNull(), nothing).otherwise(F.array_remove(split, ""))


def tokens(col: Column, letters_only: bool = False) -> Column:
    """Split on ASCII white space and punctuation (digits stay), or on anything but letters."""
    separators = r"[^\p{L}]+" if letters_only else r"[\s\p{Punct}]+"
    # regexp_replace keeps its compiled pattern, split has a short cut for a single character
    return F.split(F.regexp_replace(col, separators, " "), " ")


def title_case(col: Column) -> Column:
    return F.initcap(F.trim(F.regexp_replace(col, r"\s+", " ")))
