"""Column expressions over text (#43-50, #62).

All of these are JVM-side built-ins (regex, array and higher-order functions), so they stay inside whole-stage
codegen and need no Python worker.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode word character class (letters, marks, digits, connector punctuation) as the Unicode regex
# definition of \w; Java needs the (?U) flag for it.
WORD = r"(?U)\w"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_text(col) -> Column:
    """Lowercase, keep the runs of three or more word characters, join them by one space; null -> ''.

    The reference then deletes the characters ``!@#$:`` which can never be inside a word run, so that step
    is a no-op and is left out.
    """
    return F.array_join(F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))),
                                             F.lit(r"(?U)\w{3,}"), 0), " ")


def clean_tokens(col) -> Column:
    """The tokens of :func:`clean_text` as an array (no join/split round trip)."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))), F.lit(r"(?U)\w{3,}"), 0)


def concat_text(cols, sep: str = ". ") -> Column:
    """Join columns with a separator, keeping empty strings (nulls are filled with '' first)."""
    return F.concat_ws(sep, *[F.coalesce(_c(c), F.lit("")) for c in cols])


def concat_raw(cols, null_literal: str = "nan") -> Column:
    """Join columns with no separator; a null contributes the literal text ``nan``."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit(null_literal)) for c in cols])


def sentence_count(col) -> Column:
    """Sentences in raw text: terminator runs ``[.!?]+`` followed by whitespace or the end of the text,
    plus one for an unterminated tail that holds a word character. Null or empty text -> 0.

    A documented rule, not a trained sentence splitter: abbreviations end a sentence here.
    """
    t = F.coalesce(_c(col), F.lit(""))
    ends = F.size(F.regexp_extract_all(t, F.lit(r"[.!?]+([ \t\n\f\r]|\z)"), 0))
    tail = (~F.rtrim(t).rlike(r"[.!?]\z") & t.rlike(r"(?U)\w")).cast("int")
    return (ends + tail).cast("int")


def word_count(col) -> Column:
    """Tokens in raw text: each run of word characters, and each single other non-space character."""
    t = F.coalesce(_c(col), F.lit(""))
    return F.size(F.regexp_extract_all(t, F.lit(r"(?U)\w+|[^\w\s]"), 0)).cast("int")


@lru_cache(maxsize=1)
def _decompositions() -> dict[str, str]:
    """Built from a rule: what every assigned code point of the Basic Multilingual Plane becomes under compatibility
    decomposition without marks, where that is another text (accented letters, full-width forms, ligatures, digraphs,
    fractions, syllables; a mark itself becomes empty, as Java's tables of marks may be older)."""
    out = {}
    for cp in range(0x80, 0x10000):
        ch = chr(cp)
        if unicodedata.category(ch) in ("Cs", "Co", "Cn"):
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.category(c).startswith("M"))
        if base != ch:
            out[ch] = base
    return out


def _char_class(chars) -> str:
    """A regex class of the characters, as ranges of code points. A class is a chain of its ranges, which every character outside
    walks to its end; so the ranges lie in groups, each behind the range that holds it, and all groups behind the one that holds them."""
    runs: list[list[int]] = []
    for cp in sorted(map(ord, chars)):
        if runs and cp == runs[-1][1] + 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])

    def ranges(rs) -> str:
        return "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in rs)

    def behind(rs, inner: str) -> str:
        return f"[[\\x{{{rs[0][0]:X}}}-\\x{{{rs[-1][1]:X}}}]&&[{inner}]]"

    size = max(1, round(len(runs) ** 0.5))
    groups = [runs[i : i + size] for i in range(0, len(runs), size)]
    return behind(runs, "".join(behind(g, ranges(g)) for g in groups))


def _expanded(t: Column, many: dict[str, str]) -> Column:
    """``t`` with the keys of ``many`` replaced by their values. The k-th copy of the text holds the k-th character of each
    value; a copy that still has the character itself has nothing to add there. (No value holds its own key.)"""
    chars = lambda c: F.regexp_extract_all(c, F.lit(r"(?s)."), 0)
    copies = []
    for k in range(max(map(len, many.values()))):
        at = {c: v[k] for c, v in many.items() if k < len(v)}
        copies.append(chars(F.translate(t, "".join(at), "".join(at.values()))).alias(f"c{k}"))
    zipped = F.arrays_zip(chars(t).alias("own"), *copies)
    rest = lambda x: [F.when(x[f"c{k}"] != x["own"], x[f"c{k}"]).otherwise("") for k in range(1, len(copies))]
    return F.array_join(F.transform(zipped, lambda x: F.concat(x["c0"], *rest(x))), "")


def strip_accents(col) -> Column:
    """Compatibility decomposition without marks, for the Basic Multilingual Plane: precomposed letters become their base
    letter, ligatures, digraphs, fractions and syllables their parts, and stand-alone marks go.

    One-to-one replacements are one ``translate``. Only a text that holds a character with several parts takes the dearer
    way for those, and only one with a part list of over three the dearest. Null stays null."""
    every = _decompositions()
    one = {c: v for c, v in every.items() if len(v) <= 1}
    some = {c: v for c, v in every.items() if 2 <= len(v) <= 3}
    many = {c: v for c, v in every.items() if len(v) >= 2}
    c = _c(col)
    # Characters that vanish come last: translate() deletes what has no counterpart.
    order = sorted(one, key=lambda ch: not one[ch])
    t = F.when(c.rlike(_char_class(many.keys() - some.keys())), _expanded(c, many)).when(c.rlike(_char_class(some)), _expanded(c, some)).otherwise(c)
    return F.regexp_replace(F.translate(t, "".join(order), "".join(one[ch] for ch in order)), r"\p{M}", "")


def pairwise_overlap_count(a, b) -> Column:
    """Distinct shared tokens of two texts split on non-word characters, lowercased.

    Splitting on ``\\W`` keeps empty pieces, so two texts that both produce an empty piece share ``''``
    (two empty texts give 1). Inputs are cleaned texts in the reference.
    """
    sa = F.split(F.lower(F.coalesce(_c(a), F.lit(""))), r"(?U)\W")
    sb = F.split(F.lower(F.coalesce(_c(b), F.lit(""))), r"(?U)\W")
    return F.size(F.array_intersect(sa, sb)).cast("int")


def path_segment_label(path_col, segment: int, drop: int = 0) -> Column:
    """Label from a path: the ``segment``-th '/'-separated piece (1-based), first ``drop`` characters
    removed, lowercased. Missing segment -> null."""
    piece = F.try_element_at(F.split(_c(path_col), "/"), F.lit(segment))
    return F.lower(F.substring(piece, drop + 1, 1 << 30))


def url_first_segment(url_col) -> Column:
    """First path segment of a URL (without query or fragment), lowercased; '' when there is none."""
    return F.lower(F.regexp_extract(_c(url_col), r"^https?://[^/]+/([^/?#]+)", 1))


def map_column(df, fn, in_col: str, out_col: str, return_type: str = "string"):
    """Apply a Python scalar function to every non-null value of a column (nulls stay null), batch-wise
    through an Arrow-backed pandas UDF. The escape hatch for logic no built-in expresses; every feature in
    this package avoids it."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf(return_type)
    def _apply(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else fn(v))

    return df.withColumn(out_col, _apply(F.col(in_col)))
