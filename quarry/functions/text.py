"""Text expressions: HTML strip, pipe split, tokenise, stop-word removal.

All of them are built-in Spark SQL expressions (higher-order functions where
needed), so they run inside whole-stage codegen on the executors.
"""

from __future__ import annotations

from functools import lru_cache
from importlib import resources

from pyspark.sql import Column
from pyspark.sql import functions as F

#: HTML tag pattern; '.' does not cross a newline, so a tag broken over two
#: lines is left in place.
HTML_TAG = r"<.*?>"


def strip_html(c: Column) -> Column:
    """Remove every ``<...>`` on one line; ``<p>a</p><p>b</p>`` -> ``ab``."""
    return F.regexp_replace(c, HTML_TAG, "")


def split_pipe(c: Column) -> Column:
    """Split on ``|`` like Java ``String.split``: trailing empty items dropped,
    leading ones kept, ``''`` -> ``['']``, ``'|||'`` -> ``[]``; null -> null."""
    return (
        F.when(c.isNull(), F.lit(None).cast("array<string>"))
        .when(c.rlike(r"^\|+$"), F.array().cast("array<string>"))
        .otherwise(F.split(F.regexp_replace(c, r"\|+$", ""), r"\|"))
    )


def pipe_join(c: Column) -> Column:
    """array -> ``a|b|c`` (null -> null, empty -> ``''``)."""
    return F.array_join(c.cast("array<string>"), "|")


def tokenize(c: Column, pattern: str = r"\W") -> Column:
    """Lower-case, split on ``pattern`` (non-word characters by default), drop
    empty tokens.  Same result as ML ``RegexTokenizer(pattern='\\\\W')``."""
    return F.filter(F.split(F.lower(c), pattern), lambda t: F.length(t) >= 1)


@lru_cache(maxsize=None)
def default_stopwords() -> tuple[str, ...]:
    """The stop-word list of the reference pipeline (resources/stopwords_en.txt)."""
    text = resources.files("quarry.resources").joinpath("stopwords_en.txt").read_text("utf-8")
    return tuple(line for line in text.splitlines() if line and not line.startswith("#"))


def remove_stopwords(tokens: Column, stopwords=None, case_sensitive: bool = False) -> Column:
    """Drop every token found in ``stopwords`` (repeats of other tokens stay,
    unlike ``array_except``).  Case-insensitive by default, as ML
    ``StopWordsRemover``."""
    words = sorted(set(stopwords if stopwords is not None else default_stopwords()))
    if not case_sensitive:
        words = sorted({w.lower() for w in words})
    # IN over many literals is planned as a hash-set lookup (InSet)
    if case_sensitive:
        return F.filter(tokens, lambda t: ~t.isin(*words))
    return F.filter(tokens, lambda t: ~F.lower(t).isin(*words))


def explode_items(arr: Column) -> Column:
    """``explode`` that keeps Catalyst from inferring ``size(arr) > 0`` and
    pushing that copy of the (expensive) array expression below a shuffle
    onto the scan: ``explode_outer``, callers drop the null row with
    :func:`present`.  The array is then computed once per row."""
    return F.explode_outer(arr)


def posexplode_items(arr: Column) -> Column:
    """Positional variant of :func:`explode_items` (``pos`` null = no item)."""
    return F.posexplode_outer(arr)
