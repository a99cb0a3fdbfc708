"""Feature groups and feature flags (plain dataclasses kept on the driver)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeatureSet:
    """Three ordered name lists: continuous, categorical and text features."""
    continuous: tuple = ()
    categorical: tuple = ()
    text: tuple = ()

    def columns(self) -> list[str]:
        return [*self.continuous, *self.categorical, *self.text]


@dataclass(frozen=True)
class Flags:
    """Which feature groups to include. Every flag is live (each one adds its columns)."""
    total_price: bool = True
    quantity: bool = True
    submission_time: bool = True
    max_price: bool = False
    mean_price: bool = False
    min_price: bool = False
    polarity: bool = False
    subjectivity: bool = False
    sent_count: bool = False
    word_count: bool = False
    pos_count: bool = False
    keyword_count: bool = False
    common_word_count: bool = False
    text: tuple = field(default=("description",))


BASE_CATEGORICAL = ("teacher_prefix", "school_state", "project_grade_category", "project_subject_categories")


def feature_set(flags: Flags, old: bool = True) -> FeatureSet:
    """Assemble the feature lists from the flags. ``old`` rows have four essays, new rows two."""
    cont = []
    for name in ("total_price", "max_price", "min_price", "mean_price", "quantity"):
        if getattr(flags, name):
            cont.append(name)
    essays = (1, 2, 3, 4) if old else (1, 2)
    if flags.sent_count:
        cont += [f"project_essay_{k}_sent_len" for k in essays]
    if flags.word_count:
        cont += [f"project_essay_{k}_word_len" for k in essays]
    if flags.polarity:
        cont.append("polarity")
    if flags.subjectivity:
        cont.append("subjectivity")
    cat = list(BASE_CATEGORICAL)
    if flags.submission_time:
        cat += ["dayofweek", "monthofyear"]
    return FeatureSet(tuple(cont), tuple(cat), tuple(flags.text))
