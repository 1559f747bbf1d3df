"""Cleaning and encoding of a customer table, as one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame

from ..functions.columns import col, string_columns
from ..functions.jobs import side_by_side
from ..operators import cleaning, encoding
from ..sources.workspace import materialized

KEY = "customerID"
NUMBERS_AS_TEXT = ("TotalCharges",)
RECODED = {"SeniorCitizen": {0: "No", 1: "Yes"}}


@dataclass
class Preparation:
    """Everything learned while preparing a table; applies to new rows as a projection."""

    yes_no: list[str] = field(default_factory=list)
    fill: cleaning.Fill = field(default_factory=cleaning.Fill)
    caps: dict[str, tuple] = field(default_factory=dict)
    encoding: encoding.Encoding = field(default_factory=encoding.Encoding)


def typed(df: DataFrame) -> DataFrame:
    """Numbers stored as text become numbers, the age flag becomes Yes/No."""
    numbers = [c for c in NUMBERS_AS_TEXT if c in df.columns and dict(df.dtypes)[c] == "string"]
    out = cleaning.coerce_numeric(df, numbers) if numbers else df
    for column, mapping in RECODED.items():
        if column in out.columns:
            out = cleaning.recode(out, column, mapping)
    return out


def prepare(
    df: DataFrame, keys: Sequence[str] = (KEY,), fit_on: DataFrame | None = None, method: str = "iqr"
) -> tuple[DataFrame, Preparation]:
    """Prepared table and what was learned.

    The steps build on each other: types, missing values, copies, outliers,
    encoding. Limits and categories are learned from the rows left after
    copies are removed, so that table is written once and the following scans
    read only the columns they need. ``fit_on`` learns from other rows, such
    as the training part.
    """
    base = typed(df if fit_on is None else fit_on)
    learned = Preparation()
    facts = cleaning.scan_facts(base)
    learned.yes_no = facts.yes_no
    base = cleaning.standardize_yes_no(base, learned.yes_no)
    learned.fill = cleaning.fit_fill(base, facts=facts)
    distinct = materialized(cleaning.drop_duplicates(cleaning.fill_missing(base, learned.fill)), "distinct")
    texts = encoding.scan_texts(distinct, string_columns(distinct, keys))
    learned.caps = cleaning.fit_caps(distinct, method=method)
    learned.encoding = encoding.fit_encoding(distinct, keys, texts)
    if fit_on is not None:
        distinct = cleaning.drop_duplicates(filled(df, learned))
    return finished(distinct, learned, keys), learned


def filled(df: DataFrame, learned: Preparation) -> DataFrame:
    """The row-level steps before copies are removed."""
    return cleaning.fill_missing(cleaning.standardize_yes_no(typed(df), learned.yes_no), learned.fill)


def finished(df: DataFrame, learned: Preparation, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """The row-level steps after copies are removed; keys come first."""
    out = encoding.encode(cleaning.cap_outliers(df, learned.caps), learned.encoding)
    present = [k for k in keys if k in out.columns]
    return out.select(*[col(k) for k in present], *[col(c) for c in out.columns if c not in present])


def apply_preparation(df: DataFrame, learned: Preparation, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """The learned preparation on other rows, lazily and row by row (copies are kept)."""
    return finished(filled(df, learned), learned, keys)


def prepare_all(tables: dict[str, DataFrame], keys: Sequence[str] = (KEY,)) -> dict[str, DataFrame]:
    """Each table prepared on its own."""
    done = side_by_side({name: partial(prepare, df, keys) for name, df in tables.items()})
    return {name: prepared for name, (prepared, _) in done.items()}
