"""tessera: tabular-plus-text feature engineering, scoring and score blending as Spark DataFrame plans.

Layout:
  sources/    scans and sinks (CSV, Parquet, word-vector text, labelled file listings, the fixture views)
  functions/  column-level expressions (text cleaning, calendar labels, null rules, accent stripping)
  operators/  DataFrame -> DataFrame operators (rollups, token relations, encoders, TF-IDF, vocabularies,
              splits, metrics, models, ensembles)
  plans/      end-to-end plans built from the operators (the preprocess plan, the query registry)
  streaming/  the same fitted transforms applied to a file stream
"""

from tessera.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
