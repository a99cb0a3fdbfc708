"""Treebank word tokenisation (#50) as one native expression: an ordered cascade of rewrites that sets tokens apart by spaces, then a split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The conventions of the Penn Treebank for one sentence, in order of application, as (pattern, replacement). ``$1`` is a group.
REWRITES = [
    # opening quotes
    (r'^"', r"`` "),
    (r'([ (\[{<])"', r"$1 `` "),
    # an ellipsis is one token, and so is a dash of two hyphens
    (r"\.\.\.", r" ... "),
    (r"--", r" -- "),
    # commas and colons, but for those within numbers
    (r"([:,])([^0-9])", r" $1 $2"),
    (r"([:,])\z", r" $1 "),
    (r"([;@#$%&?!])", r" $1 "),
    # the full stop that ends the sentence, before closing quotes and brackets
    (r"""([^.])(\.)([\])}>"' ]*)\z""", r"$1 $2 $3 "),
    (r"([\]\[(){}<>])", r" $1 "),
    # closing quotes
    (r'"', r" '' "),
    (r"([^' ])(''*) ", r"$1 $2 "),
    (r"([^' ])('+)\z", r"$1 $2 "),
    # genitives and contractions
    (r"([^' ])('[sSmMdD]|'ll|'LL|'re|'RE|'ve|'VE|n't|N'T)( |\z)", r"$1 $2 "),
    (r"(?i)(^| )(can)(not)( |\z)", r" $2 $3 "),
    (r"(?i)(^| )(d)('ye)( |\z)", r" $2 $3 "),
    (r"(?i)(^| )(gim|lem)(me)( |\z)", r" $2 $3 "),
    (r"(?i)(^| )(gon|wan)(na)( |\z)", r" $2 $3 "),
    (r"(?i)(^| )(got)(ta)( |\z)", r" $2 $3 "),
    (r"(?i)(^| )(more)('n)( |\z)", r" $2 $3 "),
    (r"(?i)(^| )('t)(is|was)( |\z)", r" $2 $3 "),
]


def treebank_tokens(sentence: Column | str) -> Column:
    """The tokens of one sentence; none of a null or blank one. White space is the space, tab, line feed, form feed and carriage return."""
    c = F.col(sentence) if isinstance(sentence, str) else sentence
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"[ \t\n\f\r]+", " ")
    t = F.regexp_replace(t, r"^ | \z", "")
    for pattern, to in REWRITES:
        t = F.regexp_replace(t, F.lit(pattern), F.lit(to))
    return F.filter(F.split(t, " "), lambda x: x != "")
