"""The filter pipeline: controls, drop lists, thresholds, in this order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from taxolith.operators.abundance import control_filter, drop_taxa, filter_abundance, union_drops


@dataclass
class Filtered:
    """``filtered``: all filters applied; ``removed``: what the thresholds removed;
    ``verdicts_only``: drops applied but no thresholds, which group tests take;
    ``drops``: every condemned taxon with the filter that condemned it."""

    filtered: DataFrame
    removed: DataFrame
    verdicts_only: DataFrame
    drops: DataFrame


def apply_filters(abundance: DataFrame, drops: dict[str, DataFrame], controls: DataFrame | None = None, control_options: dict | None = None, **thresholds) -> Filtered:
    """Control filter, then the union of all drop lists, then the abundance filter (CMP-34).

    Any filter may condemn a taxon. Fractions are rescaled after drops, not after
    thresholds. A later verdict is a second call with ``min_rel=-1``.
    """
    lists = dict(drops)
    if controls is not None:
        abundance, _, condemned, _ = control_filter(abundance, controls, **(control_options or {}))
        lists["control_filter"] = condemned
    named = union_drops(lists) if lists else abundance.sparkSession.createDataFrame([], "taxid string, filter string")
    verdicts_only, _ = drop_taxa(abundance, named)
    filtered, removed = filter_abundance(verdicts_only, **thresholds)
    return Filtered(filtered, removed, verdicts_only, named)
