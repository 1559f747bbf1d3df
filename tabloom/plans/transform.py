"""Feature tables from prepared tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.columns import numeric_columns
from ..operators.features import add_features, bin_flag_columns, with_target
from ..operators.scaling import fit_scaling, scale, select_k_best
from .prepare import KEY, prepare


def transform(
    prepared: DataFrame,
    keys: Sequence[str] = (KEY,),
    scaling: str | None = None,
    k_best: int | None = None,
    scale_bins: bool = False,
) -> DataFrame:
    """Features of a prepared table, optionally scaled and reduced to the best ones.

    The 0/1 flags of tenure and charge groups are left as they are unless
    ``scale_bins``. Without options this is a projection: no data is read to plan it.
    """
    table, target = with_target(add_features(prepared))
    if scaling:
        unscaled = [] if scale_bins else bin_flag_columns(table.columns)
        columns = numeric_columns(table, [target, *keys, *unscaled])
        table = scale(table, fit_scaling(table, columns, scaling))
    return select_k_best(table, target, k_best, keys) if k_best else table


def feature_table(df: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Raw rows to features: preparation, then transformation."""
    prepared, _ = prepare(df, keys)
    return transform(prepared, keys)
