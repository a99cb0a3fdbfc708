"""Polarity and subjectivity with negation and intensifiers (#53), with DataFrame functions only.

The lexicon ``(token, polarity, subjectivity, intensity, negates)`` gives each token one role: a negator (``negates``), else an intensifier
(``intensity`` is not null), else a scored word. A sentence's listed words are read in order with a state, the pending negation and the pending
factor. A negator flips the former, an intensifier multiplies the latter, a scored word takes both and clears them. A listed word more than
``reach`` places behind the one before clears them, too, and so does the end of the sentence.

A scored word counts ``polarity * factor`` (times ``NEGATED`` if negated), cut to -1..1, and ``subjectivity * factor``, cut to 0..1. A text's score
is the mean over its scored words, 0 without any. Only listed words are gathered, and only those of one sentence (cut at
terminators and line breaks), so no group exceeds a text.

Null and empty texts have no words. Words of the lexicon are lower case; of a word listed twice the row with the greatest values holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import lookup_join
from tessera.operators.lexicon import rounded_scores
from tessera.operators.ordering import co_locate_texts
from tessera.session import cut_lineage

#: What a negated polarity is multiplied with: "not good" is bad, but less so than "bad".
NEGATED = -0.5
#: How many places apart two listed words may stand to act on one another.
REACH = 3
#: Where a sentence ends: a terminator run before white space, or a line break.
END = r"[.!?]+[ \t\n\f\r]+|[\n\r]+"
WORD = r"(?U)\w+"


def roles(lexicon: DataFrame) -> DataFrame:
    """``(token, negates, factor, polarity, subjectivity)``, a row for each token, with nulls where a role doesn't apply."""
    whole = lexicon.groupBy("token").agg(*[F.max(c).alias(c) for c in ("negates", "intensity", "polarity", "subjectivity")])
    negates = F.coalesce(F.col("negates"), F.lit(False))
    factor = F.when(~negates, F.col("intensity").cast("double"))
    scored = ~negates & F.col("intensity").isNull() & F.col("polarity").isNotNull()
    used = negates | F.col("intensity").isNotNull() | F.col("polarity").isNotNull()
    return whole.where(used).select("token", negates.alias("negates"), factor.alias("factor"), F.when(scored, F.col("polarity").cast("double")).alias("polarity"),
                                    F.when(scored, F.coalesce("subjectivity", F.lit(0.0)).cast("double")).alias("subjectivity"))


def words(df: DataFrame, cols, key: str = "id", by_key: bool = True) -> DataFrame:
    """``(key, field, sent, pos, token)``: every word, lower case, with its sentence and place there. Co-located by key, unless the rows are so already."""
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.split(F.coalesce(F.col(c), F.lit("")), END, -1).alias("all")) for c in cols])
    docs = co_locate_texts(df.select(key, *cols), key, *cols) if by_key else df
    each = docs.select(key, F.inline(fields)).select(key, "field", F.posexplode("all").alias("sent", "text"))
    return each.select(key, "field", "sent", F.posexplode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0)).alias("pos", "token"))


def fold(hits: Column, reach: int) -> Column:
    """The state after a sentence's listed words ``array<struct<pos, negates, factor, polarity, subjectivity>>``, in order: sums and number of its scored words."""
    start = F.struct(F.lit(False).alias("neg"), F.lit(1.0).alias("factor"), F.lit(0).alias("last"), F.lit(0.0).alias("polarity"), F.lit(0.0).alias("subjectivity"),
                     F.lit(0).cast("long").alias("n"))

    def step(s: Column, w: Column) -> Column:
        near = w["pos"] - s["last"] <= reach
        neg, factor = near & s["neg"], F.when(near, s["factor"]).otherwise(1.0)
        scored = w["polarity"].isNotNull()
        polarity = w["polarity"] * factor * F.when(neg, NEGATED).otherwise(1.0)
        add = F.when(scored, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), polarity))).otherwise(0.0)
        more = F.when(scored, F.greatest(F.lit(0.0), F.least(F.lit(1.0), w["subjectivity"] * factor))).otherwise(0.0)
        return F.struct((~scored & (neg != w["negates"])).alias("neg"), F.when(scored, 1.0).otherwise(factor * F.coalesce(w["factor"], F.lit(1.0))).alias("factor"),
                        w["pos"].alias("last"), (s["polarity"] + add).alias("polarity"), (s["subjectivity"] + more).alias("subjectivity"),
                        (s["n"] + scored.cast("long")).alias("n"))

    return F.aggregate(hits, start, step)


def modified_score(df: DataFrame, cols, lexicon: DataFrame, key: str = "id", digits: int = 2, reach: int = REACH) -> DataFrame:
    """``(key, polarity, subjectivity)``: one row per input row, rounded half up."""
    docs = co_locate_texts(df.select(key, *cols), key, *cols)
    hits = lookup_join(words(docs, cols, key, by_key=False), cut_lineage(roles(lexicon)), "token", "inner", spread=key)
    one = hits.groupBy(key, "field", "sent").agg(F.array_sort(F.collect_list(F.struct("pos", "negates", "factor", "polarity", "subjectivity"))).alias("hits"))
    sums = one.select(key, fold(F.col("hits"), reach).alias("s")).where("s.n > 0")
    means = sums.groupBy(key).agg((F.sum("s.polarity") / F.sum("s.n")).alias("polarity"), (F.sum("s.subjectivity") / F.sum("s.n")).alias("subjectivity"))
    means = means.withColumnRenamed(key, "_key")
    own = docs.select(F.col(key).alias("_own"))
    return own.join(means, F.col("_own").eqNullSafe(F.col("_key")), "left").select(F.col("_own").alias(key), *rounded_scores(digits))
