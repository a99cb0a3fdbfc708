"""Sentence boundaries learned from the texts themselves (#49), after Kiss and Strunk (2006), with DataFrame functions only.

A full stop is ambiguous: it ends a sentence, marks an abbreviation, or both. What decides is how a type (a token without its
punctuation, lower case) behaves in the whole corpus, not a list of abbreviations:

* ``observations`` cuts texts at white space and counts, in one pass over the corpus, in what surroundings types occur. That table (a row
  for each type, letter case and kind of left neighbour) is all that the statistics need; it is summed in each task first.
* ``learn`` derives from it, by log-likelihood ratios over type tables: abbreviations (types that seldom lack their full stop, that are short
  and hold inner full stops), frequent sentence starters, collocations across a full stop ("St. Peter"), and in which case a type is
  seen at the start of and inside sentences.
* ``breaks`` decides every full stop and ellipsis from its type and the token after it. ``!`` and ``?`` always end a sentence.
* ``sentence_counts`` sums up, ``split_sentences`` returns the sentences.

Only four totals ever reach the driver; the type tables are written, joined by :func:`~tessera.operators.joins.lookup_join` (size-checked
broadcast, else salted) and may grow with the corpus. Null, empty and blank texts have no sentences; any other text has one more than it has
breaks before its last token. A text is one row in one task, whatever its length. Ids are expected to be unique, a null id is a group of its own.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.treebank import treebank_tokens
from tessera.operators.joins import broadcastable, lookup_join
from tessera.operators.ordering import co_locate_texts
from tessera.session import cut_lineage

#: Thresholds of the paper: score of an abbreviation, log-likelihood ratio of a sentence starter and of a collocation.
ABBREVIATION, STARTER, COLLOCATION = 0.3, 30.0, 7.88
TOKEN = r"[^ \t\n\f\r]+"
#: Quotes, brackets and emphasis around a token; what closes may stand behind the punctuation that ends a sentence.
OPENING, CLOSING = r"""["'(\[{«“‘„¿¡*_]""", r"""["')\]}»”’*_]"""
PUNCTUATION = r"[.!?…,;:]"
NUMBER = r"[+-]?[.,]?[0-9][0-9.,-]*+"
#: What follows a token in a text whose tokens stand one space apart.
BEHIND = "(?![^ ])"


class Model(NamedTuple):
    """Written tables: ``(typ, score)`` of abbreviations, ``(typ, starts, lower, upper, mid_upper, start_lower)`` of all types that follow
    something, ``(left, typ)`` of collocations."""

    abbreviations: DataFrame
    types: DataFrame
    collocations: DataFrame


def _trailing(chars: str) -> str:
    """Every such character at the end of a token; a run is only looked at from its start."""
    return f"{chars}(?<!{chars}{chars}){chars}*+{BEHIND}"


def _places(df: DataFrame, cols, key: str) -> DataFrame:
    """``(key, field, text, cores)``: for each text that has tokens these without what opens and closes around them, as one text and as an array. Each rule is one
    pass over the text, whose tokens stand one space apart: a token that gets empty leaves its two spaces."""
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c), F.lit("")).alias("text")) for c in cols])
    spaced = F.trim(F.regexp_replace("text", r"[\t\n\f\r][ \t\n\f\r]*+| [ \t\n\f\r]++", " "))
    each = df.select(key, F.inline(fields)).select(key, "field", spaced.alias("text")).where("text <> ''")
    core = F.regexp_replace(F.regexp_replace("text", f"{OPENING}(?<![^ ]{OPENING}){OPENING}*+", ""), _trailing(CLOSING), "")
    return each.select(key, "field", core.alias("text")).select(key, "field", "text", F.split("text", " ", -1).alias("cores"))


def _typ(text: Column) -> Column:
    """The types of a text's tokens, or of one: without punctuation, lower case; numbers are one type."""
    low = F.lower(F.regexp_replace(text, _trailing(PUNCTUATION), ""))
    return F.regexp_replace(low, f"(?=[0-9.,+-])(?<![^ ]){NUMBER}{BEHIND}", "##")


def _ends(core: Column) -> Column:
    """Whether a token has a mark."""
    return core.endswith(".") | core.endswith("!") | core.endswith("?") | core.endswith("…")


def _mark(core: Column) -> Column:
    """``stop`` (one full stop), ``dots`` (an ellipsis), ``end`` (``!``, ``?`` or a full stop that stands alone) or ``none``."""
    return (F.when(~_ends(core), "none").when(core.rlike(r"[!?][.!?]*\z") | (core == "."), "end").when(core.rlike(r"\.\.\z|…\z"), "dots")
            .when(core.rlike(r"\.\z"), "stop").otherwise("none"))


def _letter(core: Column) -> Column:
    """The case of the first character; that of the common ones by comparison."""
    return (F.when((core >= "a") & (core < "{"), "l").when((core >= "A") & (core < "["), "u").when(core < "\u0080", "o")
            .when(core.rlike(r"^\p{Lu}"), "u").when(core.rlike(r"^\p{Ll}"), "l").otherwise("o"))


def observations(df: DataFrame, cols, key: str = "id") -> DataFrame:
    """``(typ, mark, letter, before, left, n)``: how often a type occurs with a mark and a case behind a neighbour whose mark is ``before``
    (``start`` at the start of a text) and, where that is a full stop, whose type is ``left``."""
    earlier = lambda c: F.concat(F.array(F.lit(None).cast("string")), F.slice(c, F.lit(1), F.size(c) - 1)).alias(f"_{c}")
    p = _places(df, cols, key).select("cores", F.split(_typ(F.col("text")), " ", -1).alias("typs"))
    one = p.select(F.inline(F.arrays_zip("typs", "cores", earlier("typs"), earlier("cores")))).toDF("typ", "core", "left", "_core")
    before = F.when(F.col("_core").isNull(), "start").otherwise(_mark(F.col("_core")))
    one = one.select("typ", _mark(F.col("core")).alias("mark"), _letter(F.col("core")).alias("letter"), before.alias("before"), "left")
    one = one.withColumn("left", F.when(F.col("before") == "stop", F.col("left")))
    return cut_lineage(one.groupBy("typ", "mark", "letter", "before", "left").agg(F.count(F.lit(1)).alias("n")))


def _xlogy(x: Column, y: Column) -> Column:
    return F.when(x <= 0, F.lit(0.0)).otherwise(x * F.log(y))


def _association(ab: Column, a: Column, b: Column, n: int) -> Column:
    """Dunning's log-likelihood ratio of ``ab`` joint occurrences, given ``a`` of the first and ``b`` of the second in ``n``."""
    def fit(k, m, p):
        return _xlogy(k, p) + _xlogy(m - k, 1 - p)
    p, p1, p2 = b / F.lit(n), ab / a, (b - ab) / (F.lit(n) - a)
    return 2 * (fit(ab, a, p1) + fit(b - ab, F.lit(n) - a, p2) - fit(ab, a, p) - fit(b - ab, F.lit(n) - a, p))


def _attracted(ab: Column, a: Column, b: Column, n: int, least: float) -> Column:
    """Whether the two meet more often than by chance, and significantly so."""
    return (ab * F.lit(n).cast("double") > a * b.cast("double")) & (_association(ab, a, b, n) >= least)


def _initial(typ: Column) -> Column:
    return typ.rlike(r"^\p{L}\z")


def abbreviation_scores(seen: DataFrame) -> DataFrame:
    """``(typ, n_stop, n_plain, score)`` of every type with a letter that has ever had a full stop. The score is the likelihood ratio of "nearly always
    has one" against "has one as often as any token", weighted by length, inner full stops and occurrences without."""
    stop = F.col("mark") == "stop"
    types = seen.groupBy("typ").agg(F.sum(F.when(stop, F.col("n")).otherwise(0)).alias("n_stop"), F.sum(F.when(stop, 0).otherwise(F.col("n"))).alias("n_plain"))
    total = seen.agg(F.sum("n").alias("n"), F.sum(F.when(stop, F.col("n"))).alias("s")).first()
    types = types.where((F.col("n_stop") > 0) & F.col("typ").rlike(r"\p{L}"))
    p = (total["s"] or 0) / (total["n"] or 1)
    ratio = 2 * (_xlogy(F.col("n_stop"), F.lit(0.99)) + _xlogy(F.col("n_plain"), F.lit(0.01))
                 - _xlogy(F.col("n_stop"), F.lit(p)) - _xlogy(F.col("n_plain"), F.lit(1 - p)))
    size = F.length(F.replace("typ", F.lit("."), F.lit(""))).cast("double")
    score = ratio * F.exp(-size) * (F.length("typ") - size + 1) * F.pow(size, -F.col("n_plain"))
    return types.select("typ", "n_stop", "n_plain", score.alias("score"))


def learn(seen: DataFrame) -> Model:
    """The model of :func:`observations` (written, as it is read several times)."""
    short = cut_lineage(abbreviation_scores(seen).where(F.col("score") >= ABBREVIATION).select("typ", "score"))
    flags = short.select(F.col("typ").alias("left"), F.lit(True).alias("short"))
    known = cut_lineage(lookup_join(seen, flags, "left", "left").withColumn("short", F.coalesce("short", F.lit(False))))
    loose = (F.col("left") == "##") | _initial(F.col("left"))
    stop = F.col("before") == "stop"
    known = known.withColumn("where", F.when(F.col("before") == "none", "inside").when((F.col("before") == "dots") | (stop & (F.col("short") | loose)), "unsure")
                             .otherwise("start"))
    sure = (F.col("where") == "start") & (F.col("before") != "start")
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    upper, lower, at = F.col("letter") == "u", F.col("letter") == "l", F.col("where")
    types = known.groupBy("typ").agg(F.sum("n").alias("n"), count(sure).alias("after"), (count(lower) > 0).alias("lower"), (count(upper) > 0).alias("upper"),
                                     (count(upper & (at == "inside")) > 0).alias("mid_upper"), (count(lower & (at == "start")) > 0).alias("start_lower"))
    total = known.agg(F.sum("n").alias("n"), count(sure).alias("a")).first()
    n, a = total["n"] or 0, total["a"] or 0
    starts = (F.col("after") > 0) & F.col("typ").rlike(r"\p{L}") & _attracted(F.col("after"), F.lit(a), F.col("n"), n, STARTER)
    types = cut_lineage(types.withColumn("starts", starts))
    # Collocations across a full stop that need not end a sentence; a frequent starter isn't evidence of one.
    pairs = known.where(stop & (F.col("short") | loose) & F.col("typ").rlike(r"\p{L}|##")).groupBy("left", "typ").agg(F.sum("n").alias("both")).where("both > 1")
    pairs = lookup_join(pairs, types.where(~F.col("starts")).select("typ", F.col("n").alias("nb")), "typ")
    pairs = lookup_join(pairs, types.select(F.col("typ").alias("left"), F.col("n").alias("na")), "left")
    found = cut_lineage(pairs.where(_attracted(F.col("both"), F.col("na"), F.col("nb"), n, COLLOCATION)).select("left", "typ"))
    return Model(short, types.select("typ", "starts", "lower", "upper", "mid_upper", "start_lower"), found)


def _decided() -> Column:
    """Whether a sentence ends at a candidate, from its own type and the next token's."""
    upper, lower = F.col("letter") == "u", F.col("letter") == "l"
    begins = upper & F.col("lower") & ~F.col("mid_upper")
    goes_on = lower & (F.col("upper") | ~F.col("start_lower"))
    initial, number = _initial(F.col("left")), F.col("left") == "##"
    short = F.col("short")
    return (F.when(F.col("bound"), False)
            .when(initial, ~short & ~goes_on & ~(upper & ~begins & ~F.col("lower")))
            .when(short | (F.col("mark") == "dots"), begins | (upper & F.col("starts")))
            .when(number, ~goes_on)
            .otherwise(True))


def breaks(df: DataFrame, cols, model: Model, key: str = "id", by_key: bool = True) -> DataFrame:
    """``(key, field, at)``: the place (from 0) of every token that ends a sentence and isn't the text's last. Co-located by key, unless the rows are so already."""
    p = _places(co_locate_texts(df.select(key, *cols), key, *cols) if by_key else df, cols, key)
    later = F.slice("cores", F.lit(2), F.size("cores") - 1).alias("next")
    each = p.select(key, "field", F.posexplode(F.arrays_zip("cores", later)).alias("at", "t")).where(F.col("t.next").isNotNull() & _ends(F.col("t.cores")))
    one = each.select(key, "field", "at", _mark(F.col("t.cores")).alias("mark"), _typ(F.col("t.cores")).alias("left"), _typ(F.col("t.next")).alias("typ"),
                      _letter(F.col("t.next")).alias("letter"))
    if not broadcastable(model.types):
        one = cut_lineage(one)  # a look-up of many types goes over the places three times
    one = lookup_join(one, model.abbreviations.select(F.col("typ").alias("left"), F.lit(True).alias("short")), "left", "left", spread=key)
    one = lookup_join(one, model.types, "typ", "left", spread=key)
    one = lookup_join(one, model.collocations.withColumn("bound", F.lit(True)), ["left", "typ"], "left", spread=key)
    flags = ["short", "bound", "starts", "lower", "upper", "mid_upper", "start_lower"]
    one = one.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in flags})
    return one.where((F.col("mark") == "end") | _decided()).select(key, "field", "at")


def sentence_counts(df: DataFrame, cols, model: Model, key: str = "id") -> DataFrame:
    """``(key, {col}_sent_len...)``: sentences of each text, one row per input row."""
    docs = co_locate_texts(df.select(key, *cols), key, *cols)
    found = breaks(docs, cols, model, key, by_key=False).groupBy(key).agg(*[F.count(F.when(F.col("field") == c, 1)).alias(f"_{k}") for k, c in enumerate(cols)])
    own = docs.select(F.col(key).alias("_own"), *[(F.coalesce(F.col(c), F.lit("")).rlike(r"[^ \t\n\f\r]")).cast("int").alias(f"_has{k}") for k, c in enumerate(cols)])
    both = own.join(found, own["_own"].eqNullSafe(found[key]), "left")
    return both.select(F.col("_own").alias(key), *[(F.col(f"_has{k}") + F.coalesce(F.col(f"_{k}"), F.lit(0))).cast("int").alias(f"{c}_sent_len") for k, c in enumerate(cols)])


def split_sentences(df: DataFrame, cols, model: Model, key: str = "id") -> DataFrame:
    """``(key, field, sentences array<string>)``: each text's sentences in order, their tokens joined by one space."""
    docs = co_locate_texts(df.select(key, *cols), key, *cols)
    found = breaks(docs, cols, model, key, by_key=False).groupBy(key, "field").agg(F.array_sort(F.collect_list("at")).alias("ends"))
    fields = F.array(*[F.struct(F.lit(c).alias("f"), F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(TOKEN), 0).alias("all")) for c in cols])
    own = docs.select(F.col(key).alias("_own"), F.inline(fields))
    both = own.join(found, own["_own"].eqNullSafe(found[key]) & (own["f"] == found["field"]), "left")
    ends = F.concat(F.coalesce("ends", F.array().cast("array<int>")), F.array(F.size("all") - 1))
    both = both.select(F.col("_own").alias(key), F.col("f").alias("field"), "all", ends.alias("ends"))
    cut = F.transform("ends", lambda e, i: F.array_join(F.slice("all", F.coalesce(F.get("ends", i - 1) + 2, F.lit(1)), e - F.coalesce(F.get("ends", i - 1), F.lit(-1))), " "))
    return both.select(key, "field", F.when(F.size("all") > 0, cut).otherwise(F.array().cast("array<string>")).alias("sentences"))


def treebank_counts(df: DataFrame, cols, model: Model, key: str = "id") -> DataFrame:
    """``(key, {col}_word_len...)``: treebank tokens of each text (#50), one row per input row. Each learned sentence is tokenised by itself, so
    that its last full stop is a token and that of an abbreviation isn't."""
    each = F.transform("sentences", lambda s: F.size(treebank_tokens(s)))
    one = split_sentences(df, cols, model, key).select(key, "field", F.aggregate(each, F.lit(0), lambda a, n: a + n).alias("n"))
    # Every text has a row, so the sums need no join back to the rows.
    return one.groupBy(key).agg(*[F.sum(F.when(F.col("field") == c, F.col("n"))).cast("int").alias(f"{c}_word_len") for c in cols])
