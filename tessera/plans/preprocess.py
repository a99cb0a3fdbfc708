"""The preprocessing plan end to end: raw parents and children -> one feature row per parent.

One lazy plan. Shuffle boundaries: the child rollup (one ``groupBy(id)``), the parent/rollup join, and the
co-location of the parents by id ahead of the token-level lexicon aggregation (which then stays local). Raw-text counts are taken before cleaning (the order matters: sentence and
word counts see punctuation that cleaning removes).

Keyword and token-class counts stay in long form (see :func:`token_features`); densify them only at the very
end, if a wide matrix is required, with :func:`tessera.operators.lexicon.densify`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions.calendar import calendar_labels
from tessera.functions.nulls import null_fill
from tessera.operators import lexicon as lx
from tessera.operators.ordering import co_locate_texts
from tessera.operators.rollup import project_enrich, resource_rollup

TEXT_COLS = ["project_title", "project_essay_1", "project_essay_2", "project_essay_3",
             "project_essay_4", "project_resource_summary", "description"]
ESSAYS = TEXT_COLS[1:5]


def enrich(projects: DataFrame, resources: DataFrame, ts: str = "project_submitted_datetime",
           quick: int | None = None, key: str = "id") -> DataFrame:
    """Parents + child rollup + calendar labels; drops ``teacher_id`` and the timestamp. ``quick`` keeps the
    first n parents by key (applied to the parents before the join, so the rollup join shrinks with it)."""
    p = projects
    if quick:
        p = p.orderBy(key).limit(quick)
    df = project_enrich(p, resource_rollup(resources), key)
    df = calendar_labels(df, ts, drop=True)
    return df.drop("teacher_id") if "teacher_id" in df.columns else df


def text_features(df: DataFrame, lexicon: DataFrame | None = None, key: str = "id",
                  text_cols=TEXT_COLS, essays=ESSAYS) -> DataFrame:
    """Raw counts, cleaned text, concatenations, lexicon scores and pairwise overlaps, one row per parent.

    Everything but the lexicon scores is a projection of the row. The rows are co-located by key first, so
    the per-row token aggregation of the lexicon scores and its join back to the rows need no further
    shuffle.
    """
    present = [c for c in text_cols if c in df.columns]
    d = null_fill(df, {c: "" for c in present})
    if lexicon is not None:  # the lexicon scores aggregate per key and join back inside the partition
        d = co_locate_texts(d, key, *present)
    d = d.withColumns({**{f"{c}_sent_len": tx.sentence_count(c) for c in essays},
                       **{f"{c}_word_len": tx.word_count(c) for c in essays}})
    d = d.withColumns({c: tx.clean_text(c) for c in present})
    d = d.withColumn("all_essays", tx.concat_text(essays))
    d = d.withColumn("all_text", tx.concat_text(["project_title", "all_essays", "project_resource_summary",
                                                 "description"]))
    pairs = [(a, b) for i, a in enumerate(present[:-1]) for b in present[i + 1:]]
    d = d.withColumns({f"{a}_{b}_common": tx.pairwise_overlap_count(a, b) for a, b in pairs})
    if lexicon is not None:
        means = lx.lexicon_means(d, essays, lexicon, key=key, cleaned=True, by_key=False)
        d = d.join(means, key, "left")
        d = d.select(*[c for c in d.columns if c not in ("polarity", "subjectivity")], *lx.rounded_scores())
    if "teacher_prefix" in d.columns:
        d = null_fill(d, {"teacher_prefix": "Teacher"})
    return d


def preprocess(projects: DataFrame, resources: DataFrame, lexicon: DataFrame | None = None,
               quick: int | None = None) -> DataFrame:
    return text_features(enrich(projects, resources, quick=quick), lexicon)
