"""Cleaning of the indicator columns, and separation of failed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymosaic.fixed_values import INDICATORS, PSI_SENTINEL


def qc_clean(df: DataFrame) -> DataFrame:
    """Blank all indicators of a row that fails one of two checks.

    1. ``Psi`` is the sentinel, NULL or NaN. A check against a missing value is
       itself missing, so a point without Psi loses all 13 values.
    2. after that, ``DDS`` or ``LFMC`` is NaN. NULL does not count here.

    Each check is one ``select``: all its outputs see the columns as they came
    in. Indicators the table lacks are ignored.
    """
    present = [c for c in INDICATORS if c in df.columns]
    if "Psi" in present:
        keep = ~F.isnan("Psi") & (F.col("Psi") != PSI_SENTINEL)
        df = _blank_unless(df, present, keep)
    undefined = [F.isnan(c) for c in ("DDS", "LFMC") if c in present]
    if undefined:
        bad = undefined[0] if len(undefined) == 1 else undefined[0] | undefined[1]
        df = _blank_unless(df, present, ~bad)
    return df


def _blank_unless(df: DataFrame, names, keep) -> DataFrame:
    return df.select(*[
        F.when(keep, F.col(c)).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns
    ])


def accepted(df: DataFrame) -> DataFrame:
    """Rows whose simulation succeeded."""
    return df.where(F.col("error").isNull())


def rejected(df: DataFrame) -> DataFrame:
    """Rows whose simulation failed, for the rejects table."""
    return df.where(F.col("error").isNotNull())


def quarantine_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected)."""
    return accepted(df), rejected(df)
