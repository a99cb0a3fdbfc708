"""TF-IDF over word n-grams (#30, #36, #61-64).

Definition (fit on a corpus of n documents, apply to any documents):
  lowercase -> strip accents -> tokens = runs of word characters -> drop stop words -> n-grams n_min..n_max
  joined by one space -> per-document term counts tf -> keep terms with min_df <= df <= max_df (a fraction
  of n, or an absolute count) -> keep the top ``max_features`` terms by total count (ties by term) ->
  weight (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1) (or tf * idf without ``sublinear``) -> l2-normalise
  each document.

Physical plan: documents are hash-partitioned by id once (one row per document, the compact form), then
the n-grams of a document are generated in its row and exploded, and ``groupBy(id, term)`` runs inside the
partition: the exploded n-grams are never shuffled. Document frequencies are a partial aggregate by term,
so a term that occurs in every document still costs one row per task. The fitted vocabulary (at most
``max_features`` terms) is written once to the shared folder and joined through the size-checked lookup join
(broadcast within the row and byte bounds, salted shuffle beyond). The l2 norm is a window per document
(bounded by the document's distinct terms), inside the same partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import strip_accents
from tessera.operators.joins import lookup_join
from tessera.operators.ordering import co_locate_texts
from tessera.session import cut_lineage


# The English stop-word list of the reference's TF-IDF (its vectorizer's stop_words='english',
# the 318-word list published by the Glasgow Information Retrieval Group), in alphabetical order.
ENGLISH_STOP_WORDS = tuple("""
a about above across after afterwards again against all almost alone along already also although always
am among amongst amoungst amount an and another any anyhow anyone anything anyway anywhere are around as
at back be became because become becomes becoming been before beforehand behind being below beside
besides between beyond bill both bottom but by call can cannot cant co con could couldnt cry de describe
detail do done down due during each eg eight either eleven else elsewhere empty enough etc even ever
every everyone everything everywhere except few fifteen fifty fill find fire first five for former
formerly forty found four from front full further get give go had has hasnt have he hence her here
hereafter hereby herein hereupon hers herself him himself his how however hundred i ie if in inc indeed
interest into is it its itself keep last latter latterly least less ltd made many may me meanwhile might
mill mine more moreover most mostly move much must my myself name namely neither never nevertheless next
nine no nobody none noone nor not nothing now nowhere of off often on once one only onto or other others
otherwise our ours ourselves out over own part per perhaps please put rather re same see seem seemed
seeming seems serious several she should show side since sincere six sixty so some somehow someone
something sometime sometimes somewhere still such system take ten than that the their them themselves
then thence there thereafter thereby therefore therein thereupon these they thick thin third this those
though three through throughout thru thus to together too top toward towards twelve twenty two un under
until up upon us very via was we well were what whatever when whence whenever where whereafter whereas
whereby wherein whereupon wherever whether which while whither who whoever whole whom whose why will
with within without would yet you your yours yourself yourselves
""".split())


def default_stop_words() -> tuple:
    """The English stop words the reference's TF-IDF removes (318 words)."""
    return ENGLISH_STOP_WORDS


def analyzer_tokens(col, accents: bool = True) -> "F.Column":
    """Lowercase, strip accents, runs of word characters (single characters included)."""
    c = F.col(col) if isinstance(col, str) else col
    t = F.lower(F.coalesce(c, F.lit("")))
    if accents:
        t = strip_accents(t)
    return F.regexp_extract_all(t, F.lit(r"(?U)\w+"), 0)


def stopword_ngrams(df: DataFrame, col: str, n_min: int = 1, n_max: int = 1, stop=None, key: str = "id",
                    accents: bool = True) -> DataFrame:
    """Per-document term counts ``(key, term, tf)`` after stop-word removal and n-gram generation."""
    stop = list(default_stop_words() if stop is None else stop)
    toks = analyzer_tokens(col, accents)
    if stop:
        toks = F.filter(toks, lambda t: ~t.isin(stop))
    # Tokens are projected into a column once; n-grams come from Spark ML's NGram transformer (compiled,
    # about twice as fast as the same thing written with higher-order-function lambdas).
    from pyspark.ml.feature import NGram
    g = co_locate_texts(df.select(key, col), key, col).select(key, toks.alias("_toks"))
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(F.col("_toks"))
        else:
            g = NGram(n=n, inputCol="_toks", outputCol=f"_g{n}").transform(g)
            parts.append(F.col(f"_g{n}"))
    grams = F.concat(*parts) if len(parts) > 1 else parts[0]
    return (g.select(key, F.explode(grams).alias("term"))
            .groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")))


def term_stats(tf: DataFrame, key: str = "id") -> DataFrame:
    """``(term, df, ttf)``: document frequency and total count per term."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))


def top_terms(stats: DataFrame, n: int) -> DataFrame:
    """The ``n`` terms with the largest total count (ties by term): a top-k, planned as TakeOrdered."""
    return stats.orderBy(F.desc("ttf"), F.asc("term")).limit(n)


@dataclass
class TfIdfModel:
    vocabulary: DataFrame  # (term, df, ttf, idf)
    n_docs: int
    col: str
    n_min: int
    n_max: int
    stop: tuple
    sublinear: bool
    norm: bool
    accents: bool

    def transform(self, df: DataFrame, key: str = "id") -> DataFrame:
        """Sparse rows ``(key, term, weight)`` for the vocabulary terms of each document."""
        tf = stopword_ngrams(df, self.col, self.n_min, self.n_max, self.stop, key, self.accents)
        voc = self.vocabulary.select("term", "idf")
        j = lookup_join(tf, voc, "term", spread=key)
        tfw = (F.lit(1.0) + F.log(F.col("tf"))) if self.sublinear else F.col("tf").cast("double")
        w = j.select(key, "term", (tfw * F.col("idf")).alias("weight"))
        if not self.norm:
            return w
        l2 = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key)))
        return w.withColumn("weight", F.when(l2 > 0, F.col("weight") / l2).otherwise(F.lit(0.0)))


class TfIdf:
    def __init__(self, col: str, max_features: int | None = 10000, ngram=(1, 3), min_df=5, max_df=0.9,
                 sublinear: bool = True, stop=None, norm: bool = True, strip_accents: bool = True):
        self.col, self.max_features, self.ngram = col, max_features, ngram
        self.min_df, self.max_df, self.sublinear, self.norm = min_df, max_df, sublinear, norm
        self.stop = tuple(default_stop_words() if stop is None else stop)
        self.accents = strip_accents

    def fit(self, *frames: DataFrame, key: str = "id") -> TfIdfModel:
        """Fit on one frame, or on several (e.g. train and test: ``fit_scope='train+test'``)."""
        corpus = frames[0].select(key, self.col)
        for f in frames[1:]:
            corpus = corpus.unionByName(f.select(key, self.col))
        n = corpus.count()
        tf = stopword_ngrams(corpus, self.col, self.ngram[0], self.ngram[1], self.stop, key, self.accents)
        st = term_stats(tf, key)
        lo = self.min_df if isinstance(self.min_df, int) else self.min_df * n
        hi = self.max_df if isinstance(self.max_df, int) else self.max_df * n
        st = st.where((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi)))
        if self.max_features is not None:
            st = top_terms(st, self.max_features)
        voc = st.withColumn("idf", F.log(F.lit(1.0 + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))
        return TfIdfModel(cut_lineage(voc), n, self.col, self.ngram[0], self.ngram[1], self.stop, self.sublinear,
                          self.norm, self.accents)
