"""Text similarity from 0 to 1, and person-name matching."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from . import lookups
from .blocks import block_scorer


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def _scorers() -> tuple[Callable[..., Column], Callable[..., Column]]:
    """UDFs for one pair and for the best of several pairs per row; all pairs of a batch are scored together.

    Being local functions they travel to the executors whole; the package need not be there.
    """
    score = block_scorer()

    def one(a: pd.Series, b: pd.Series) -> pd.Series:
        known = (a.notna() & b.notna()).to_numpy()
        out = pd.Series([None] * len(a), dtype="float64")
        out[known] = score(a[known].tolist(), b[known].tolist())
        return out

    def best(a: pd.Series, b: pd.Series) -> pd.Series:
        pairs = [(i, p, q) for i, (x, y) in enumerate(zip(a, b)) if x is not None for p, q in zip(x, y)]
        out = pd.Series([None] * len(a), dtype="float64")
        if pairs:
            row, left, right = map(list, zip(*pairs))
            scores = pd.Series(score(left, right)).groupby(row).max()
            out[scores.index] = scores
        return out

    return F.pandas_udf(one, DoubleType()), F.pandas_udf(best, DoubleType())


_ratcliff, _ratcliff_best = _scorers()


def ratcliff_ratio(a: Column, b: Column) -> Column:
    """Twice the matched letters over all letters. Not symmetric; null if either text is null."""
    return _ratcliff(a, b)


RATIOS = {"levenshtein": levenshtein_ratio, "ratcliff": ratcliff_ratio}

_HONORIFIC = r"\b(" + "|".join(lookups.HONORIFICS) + r")\b\.?"


def clean_person(name: Column, keep_bracketed: bool) -> Column:
    """Words of two or more letters of an upper-case name, without titles and patronymics.

    Text in brackets may be a nickname or part of the name, so callers try both.
    """
    text = F.regexp_replace(F.upper(F.coalesce(name, F.lit(""))), lookups.PATRONYMIC, " ")
    text = F.regexp_replace(text, lookups.OTHER_NAME, " ")
    text = F.regexp_replace(text, r"[()]" if keep_bracketed else r"\([^)]*\)", " ")
    text = F.regexp_replace(text, _HONORIFIC, " ")
    words = F.split(F.regexp_replace(text, "[^A-Z ]", " "), " +")
    return F.array_join(F.filter(words, lambda w: F.length(w) > 1), " ")


def _words(text: Column) -> Column:
    return F.array_distinct(F.split(text, " "))


def _run_on(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def _certain(pair: Column) -> Column:
    """Same person beyond doubt: equal, all words contained, or equal but for word breaks."""
    a, b = pair["a"], pair["b"]
    words_a, words_b = _words(a), _words(b)
    a_is_small = F.size(words_a) <= F.size(words_b)
    small = F.when(a_is_small, words_a).otherwise(words_b)
    large = F.when(a_is_small, words_b).otherwise(words_a)
    telling = (F.size(small) >= 2) | F.exists(small, lambda w: F.length(w) >= 6)
    contained = (F.size(F.array_except(small, large)) == 0) & telling
    long_enough = (F.length(_run_on(a)) >= 8) & (F.length(_run_on(b)) >= 8)
    inside = F.contains(_run_on(a), _run_on(b)) | F.contains(_run_on(b), _run_on(a))
    return (a == b) | contained | (long_enough & inside)


def _forms(pair: Column) -> Column:
    """The pair as written, with sorted words, and without spaces."""
    a, b = pair["a"], pair["b"]

    def ordered(text: Column) -> Column:
        return F.array_join(F.array_sort(_words(text)), " ")

    return F.array(
        F.struct(a.alias("a"), b.alias("b")),
        F.struct(ordered(a).alias("a"), ordered(b).alias("b")),
        F.struct(_run_on(a).alias("a"), _run_on(b).alias("b")),
    )


def with_name_similarity(
    df: DataFrame, a: str, b: str, out: str = "name_similarity", metric: str = "ratcliff"
) -> DataFrame:
    """Adds the similarity of two person names, tolerant of order, initials, titles and brackets.

    Pairs that a rule settles give 1.0; the scorer gets null for them.
    """
    names = {
        f"_{side}{int(keep)}": clean_person(F.col(name), keep)
        for side, name in (("a", a), ("b", b))
        for keep in (False, True)
    }
    pairs = F.array(
        *[
            F.struct(F.col(f"_a{x}").alias("a"), F.col(f"_b{y}").alias("b"))
            for x in (0, 1)
            for y in (0, 1)
        ]
    )
    usable = F.array_distinct(F.filter(pairs, lambda p: (p["a"] != "") & (p["b"] != "")))
    open_forms = F.when(
        ~F.col("_certain") & (F.size("_pairs") > 0),
        F.array_distinct(F.flatten(F.transform("_pairs", _forms))),
    )
    if metric == "ratcliff":
        best = _ratcliff_best(
            F.transform("_forms", lambda f: f["a"]), F.transform("_forms", lambda f: f["b"])
        )
    else:
        ratio = RATIOS[metric]
        best = F.array_max(F.transform("_forms", lambda f: ratio(f["a"], f["b"])))
    score = F.when(F.col("_certain"), 1.0).when(F.size("_pairs") == 0, 0.0).otherwise(best)
    return (
        df.withColumns(names)
        .withColumn("_pairs", usable)
        .withColumn("_certain", F.exists("_pairs", _certain))
        .withColumn("_forms", open_forms)
        .withColumn(out, score)
        .drop(*names, "_pairs", "_certain", "_forms")
    )
