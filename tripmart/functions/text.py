"""Normal form, tokens and similarity of names."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import schemas

# The ASCII punctuation characters, and white space.
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""
SPACE = r"(?U)[\s\x1c-\x1f]+"


def normalize(value: Column, drop_stop_words: bool = False) -> Column:
    """Lower case, punctuation to spaces, single spaces; NULL becomes ''."""
    text = F.lower(F.coalesce(value.cast("string"), F.lit("")))
    text = F.trim(F.regexp_replace(F.regexp_replace(text, PUNCTUATION, " "), SPACE, " "))
    if drop_stop_words:
        text = F.array_join(_words(text), " ")
    return text


def _words(normal: Column) -> Column:
    return F.filter(
        F.split(normal, " "), lambda t: (t != "") & ~t.isin(*schemas.STOP_WORDS)
    )


def tokens(normal: Column) -> Column:
    """Distinct words of a normal form without stop words."""
    return F.array_distinct(_words(normal))


def token_set_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two token arrays: 1 if both are empty, 0 if one is."""
    either_empty = (F.size(a) == 0) | (F.size(b) == 0)
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when(either_empty, F.lit(0.0))
        .otherwise(shared / (F.size(a) + F.size(b) - shared))
    )


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """Edit similarity of two normal forms, the built-in sibling of fuzzy_ratio."""
    longest = F.greatest(F.length(a), F.length(b))
    return (
        F.when((F.length(a) == 0) & (F.length(b) == 0), F.lit(1.0))
        .when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0))
        .otherwise(F.lit(1.0) - F.levenshtein(a, b) / longest)
    )


def pair_score():
    """Arrow UDF ``(a, b, token_set) -> fuzzy, score, reason`` on normal forms.

    The Ratcliff-Obershelp ratio has no built-in counterpart. Score and text are
    made here as well, because their rounding has to follow the binary value of
    the number. The function is defined inside, so that it travels to the
    executors by value.
    """

    @F.pandas_udf("fuzzy double, score double, reason string")
    def score(a: pd.Series, b: pd.Series, token_set: pd.Series) -> pd.DataFrame:
        matcher = SequenceMatcher(None)
        second = None
        rows = []
        for left, right, tok in zip(a, b, token_set):
            if left and left == right:
                rows.append((1.0, 1.0, "exact match (normalized)"))
                continue
            if not left or not right:
                fuzzy = 1.0 if left == right else 0.0
            else:
                if right != second:
                    matcher.set_seq2(right)
                    second = right
                matcher.set_seq1(left)
                fuzzy = matcher.ratio()
            best = round(max((tok + fuzzy) / 2, 0.95 * fuzzy, 0.95 * tok), 4)
            rows.append(
                (fuzzy, best, f"token_set={tok:.2f}, fuzzy={fuzzy:.2f}, score={best:.2f}")
            )
        return pd.DataFrame(rows, columns=["fuzzy", "score", "reason"])

    return score
