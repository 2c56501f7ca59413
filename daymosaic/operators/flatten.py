"""Nested simulation results -> one flat row per point and day.

Layers and cohorts inside a row are folded with array functions: there are a
handful per point, so this needs no shuffle. Where they arrive as separate rows,
``soil_profile`` and ``plant_weighted_means`` compute the same values with
partially aggregated sums and never build an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymosaic.fixed_values import EXTRA_OUTPUTS, INDICATORS
from daymosaic.functions.missing import (
    clamp01, nan_to_null, ratio_or_nan, ratio_or_null, sum_unless_missing,
)
from daymosaic.operators.quality import accepted, qc_clean


def water_balance_columns(df: DataFrame, record: str | None = None) -> DataFrame:
    """Add the water columns from the fields of ``record`` (or from flat columns).

    Sums and differences are missing when one operand is.
    """
    def field(name: str) -> Column:
        return F.col(f"{record}.{name}") if record else F.col(name)

    df = df.withColumns({
        "Precipitation": field("Rain") + field("Snow"),
        "Interception": field("Rain") - field("NetRain"),
        "Esoil": field("SoilEvaporation"),
        "Eplant": field("Transpiration"),
        "PET": field("PET"),
        "Runoff": field("Runoff"),
        "DeepDrainage": field("DeepDrainage"),
    })
    return df.withColumns({
        "AET": F.col("Interception") + F.col("Esoil") + F.col("Eplant"),
        "ELW": F.col("Runoff") + F.col("DeepDrainage"),
    })


def soil_record(layers: str) -> str:
    """SQL text that folds an array of soil layers once.

    A sum is NULL as soon as one of its terms is missing (NULL or NaN). The cast
    declares the fields of the start value nullable, which literals are not.
    """
    def term(e: str) -> str:
        return f"nullif({e}, double('NaN'))"

    return (
        f"aggregate({layers}, CAST(named_struct('w', 0D, 'fc', 0D, 'theta', 0D, 'span', 0D, 'stored', 0D) AS "
        "STRUCT<w: DOUBLE, fc: DOUBLE, theta: DOUBLE, span: DOUBLE, stored: DOUBLE>), (s, l) -> "
        f"named_struct('w', s.w + {term('l.W')}, 'fc', s.fc + {term('l.waterFC')}, "
        f"'theta', s.theta + {term('l.theta * l.waterFC')}, "
        f"'span', s.span + {term('l.waterFC - l.waterWP')}, "
        f"'stored', s.stored + {term('l.W * l.waterFC - l.waterWP')}))"
    )


def top_layer(layers: str) -> str:
    """SQL text for Psi of the top layer."""
    return f"array_min(transform({layers}, l -> named_struct('layer', l.layer, 'psi', l.psi))).psi"


def cohort_record(cohorts: str) -> str:
    """SQL text that sums an array of cohorts once, leaving out missing terms.

    A cohort leaves the numerators when either factor is missing, but the
    denominator only when its leaf area is.
    """
    def term(e: str) -> str:
        return f"coalesce(nullif({e}, double('NaN')), 0D)"

    return (
        f"aggregate({cohorts}, named_struct('lai', 0D, 'dds', 0D, 'lfmc', 0D), (s, c) -> "
        f"named_struct('lai', s.lai + {term('c.LAI')}, 'dds', s.dds + {term('c.LAI * c.DDS')}, "
        f"'lfmc', s.lfmc + {term('c.LAI * c.LFMC')}))"
    )


def _soil_outputs(fc: Column, theta: Column, span: Column, stored: Column, psi: Column, known: Column) -> dict[str, Column]:
    return {
        "Theta": F.when(known, clamp01(ratio_or_null(theta, fc))),
        "REW": F.when(known, F.lit(100.0) * clamp01(ratio_or_null(stored, span))),
        "Psi": F.when(known, psi),
    }


def soil_profile(layers: DataFrame, keys, order: Column) -> DataFrame:
    """Theta, REW and Psi per key from one row per soil layer.

    ``order`` ranks the layers of a key; the lowest one is the top layer. With a
    numeric order everything is one hash aggregation; a struct makes it sort.
    """
    known_w = F.count(nan_to_null(F.col("W")))
    known_fc = F.count(nan_to_null(F.col("waterFC")))
    sums = layers.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        known_w.alias("_w"),
        known_fc.alias("_f"),
        sum_unless_missing(F.col("waterFC")).alias("_fc"),
        sum_unless_missing(F.col("theta") * F.col("waterFC")).alias("_theta"),
        sum_unless_missing(F.col("waterFC") - F.col("waterWP")).alias("_span"),
        sum_unless_missing(F.col("W") * F.col("waterFC") - F.col("waterWP")).alias("_stored"),
        F.min_by("psi", order).alias("_psi"),
    )
    known = (F.col("_w") == F.col("_n")) & (F.col("_f") == F.col("_n")) & (F.col("_fc") != 0)
    outputs = _soil_outputs(*[F.col(c) for c in ("_fc", "_theta", "_span", "_stored", "_psi")], known)
    return sums.select(*keys, *[c.alias(name) for name, c in outputs.items()])


def cohort_sums(cohorts: DataFrame, keys) -> DataFrame:
    """Leaf-area sums per key from one row per cohort."""
    lai, dds, lfmc = (nan_to_null(F.col(c)) for c in ("LAI", "DDS", "LFMC"))
    return cohorts.groupBy(*keys).agg(
        F.sum(lai).alias("_lai"), F.sum(lai * dds).alias("_dds"), F.sum(lai * lfmc).alias("_lfmc")
    )


def plant_weighted_means(cohorts: DataFrame, keys, observations: DataFrame) -> DataFrame:
    """DDS and LFMC for every row of ``observations``, NaN where it has no leaf area.

    Cohorts are summed before the join, so a key with many cohorts reaches it
    as one row.
    """
    sums = cohort_sums(cohorts, keys)
    return observations.join(sums, list(keys), "left").select(
        *observations.columns,
        (F.lit(100.0) * ratio_or_nan(F.col("_dds"), F.col("_lai"))).alias("DDS"),
        ratio_or_nan(F.col("_lfmc"), F.col("_lai")).alias("LFMC"),
    )


def flatten_results(results: DataFrame, clean: bool = True) -> DataFrame:
    """The whole flattening step: failed rows dropped, 18 outputs, date parts, cleaned.

    A narrow plan: no shuffle, no Python.
    """
    carried = [c for c in results.columns if c not in ("result", "state", "error")]
    flat = water_balance_columns(accepted(results), "result.WaterBalance").selectExpr(
        "*",
        f"{soil_record('state.soil')} AS _soil",
        f"{top_layer('state.soil')} AS _psi",
        f"{cohort_record('result.Plants')} AS _plants",
    )
    soil = {c: F.col(f"_soil.{c}") for c in ("w", "fc", "theta", "span", "stored")}
    known = soil["w"].isNotNull() & soil["fc"].isNotNull() & (soil["fc"] != 0)
    lai = F.col("_plants.lai")
    flat = flat.withColumns({
        "LAI": F.col("result.Stand.LAIexpanded"),
        **_soil_outputs(soil["fc"], soil["theta"], soil["span"], soil["stored"], F.col("_psi"), known),
        "DDS": F.lit(100.0) * ratio_or_nan(F.col("_plants.dds"), lai),
        "LFMC": ratio_or_nan(F.col("_plants.lfmc"), lai),
        "DFMC": F.col("result.FireHazard.`DFMC [%]`"),
        "SFP": F.col("result.FireHazard.SFP"),
        "CFP": F.col("result.FireHazard.CFP"),
        "year": F.year("date"),
        "month": F.month("date"),
        "day": F.dayofmonth("date"),
    }).select(*carried, *INDICATORS, *EXTRA_OUTPUTS, "year", "month", "day")
    return qc_clean(flat) if clean else flat
