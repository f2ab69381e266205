"""Item measurements: profiles, size thresholds and gaps between items."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.fields import induction_name, to_double
from sorterlog.operators import spacing as sp
from sorterlog.operators.columns import drop_constant_columns
from sorterlog.operators.counts import (
    categorical_profile,
    numeric_profile,
    quantile_name,
    seeded_sample,
    text_columns,
    threshold_counts,
)
from sorterlog.operators.quantiles import quantiles
from sorterlog.plans.messages import records_of, with_payload
from sorterlog.plans.result import Tables
from sorterlog.sources.logs import ORDER
from sorterlog.sources.staging import stage

MEASURES = ["length", "width", "positionFront"]


def measurement_rows(logs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Measurement messages with typed numbers and named inductions."""
    names = fv.MEASUREMENT_KEYS if keys is None else keys
    rows = with_payload(records_of(logs, fv.MEASUREMENT_CODES), names, repair=True)
    numbers = {c: to_double(c) for c in (*MEASURES, "noOfCarriers") if c in names}
    return rows.withColumns({**numbers, "inductionNo": induction_name("inductionNo")})


def item_measurements(
    logs: DataFrame,
    inductions: list[str] | None = None,
    sample_rows: int | None = None,
    prune: bool = False,
    slices: int | None = None,
) -> Tables:
    """Profiles, threshold counts and gap distributions of measured items.

    Lines are parsed when a table is first asked for. Tables of the measures need only their keys
    parsed; `categorical_profile`, `clean_data` and `prune` need every field. What is parsed whole is not parsed again.
    """
    rows = measurement_rows(logs)

    @functools.cache
    def clean() -> DataFrame:
        whole = stage(rows, "measurements")
        return drop_constant_columns(whole, all_null=True, protect=[*fv.MEASUREMENT_KEYS, "timeStamp"]) if prune else whole

    @functools.cache
    def measured() -> DataFrame:
        if prune or clean.cache_info().currsize:
            return clean()
        return stage(rows.select([c for c in rows.columns if c in (ORDER, *fv.MEASUREMENT_KEYS)]), "measures")  # the order stays: it keeps filters above the cut

    def complete() -> DataFrame:
        return measured().dropna(subset=MEASURES)

    def points() -> DataFrame:
        return complete() if sample_rows is None else seeded_sample(complete(), [ORDER], sample_rows)

    chosen = fv.AUTO_INDUCTIONS if inductions is None else inductions
    probs = {quantile_name(p): p for p in fv.GAP_QUANTILES}
    tables: Tables = Tables({
        "numeric_profile": lambda: numeric_profile(measured(), [*MEASURES, "noOfCarriers"], slices=slices),
        "categorical_profile": lambda: categorical_profile(clean(), text_columns(clean())),
        "threshold_counts": lambda: threshold_counts(complete(), {
            "length_width": ["length", "width"],
            "length_position": ["length", "positionFront"],
            "width_position": ["width", "positionFront"],
            "all": MEASURES,
        }),
        "points": lambda: points().select(*MEASURES, "noOfCarriers"),
        "gaps": lambda: stage(sp.position_gaps(measured().where(F.col("inductionNo").isin(chosen)), "inductionNo", "positionFront", slices), "gaps"),
        "gap_counts": lambda: sp.bin_matrix(sp.auto_scale(tables["gaps"], "gap", slices), "inductionNo"),
        "gap_quantiles": lambda: tables["gap_description"].select(*probs),
        "gap_description": lambda: sp.describe(tables["gaps"], "gap", probs, slices),
        "gap_histogram": lambda: sp.equal_width_histogram(tables["gaps"], "inductionNo", "gap", 50),
        "gap_quartiles": lambda: quantiles(
            tables["gaps"], "gap", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["inductionNo"], slices),
        "clean_data": clean,
    })
    return tables
