"""Display tables for a graph view: node size, colour and label flags, edge
widths. Only the tables are built; rendering is left to the consumer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.iterate import StateLoop
from churnlens.operators.quantile import exact_percentile

# The colour schemes of the graph view (four steps each) and
# the fallback scheme for unknown names.
COLOR_SCHEMES = {
    "viridis": ["#440154", "#31688E", "#35B779", "#FDE725"],
    "plasma": ["#0D0887", "#7E03A8", "#CC4778", "#F89441"],
    "inferno": ["#000004", "#1B0F41", "#8A2268", "#E95B1A"],
    "magma": ["#000004", "#1A1043", "#51127C", "#B63679"],
    "cool": ["#003F5C", "#2E4A7B", "#665191", "#A05195"],
    "warm": ["#FF6B35", "#F7931E", "#FFD23F", "#FEFE56"],
}
DEFAULT_SCHEME = "viridis"


def _range(lo, hi):
    return F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)


def node_display(size: DataFrame, color: DataFrame, scheme: str = "viridis",
                 label_threshold: float = 0.1) -> DataFrame:
    """Per node: size scaled to 10..50 and colour value scaled to 0..1 by
    min-max (a zero range counts as 1), the palette step ``int(v*(k-1))``,
    and a label flag for nodes whose size metric reaches the
    ``1 - label_threshold`` percentile.

    ``size``: (id, size_metric); ``color``: (id, color_metric), missing -> 0.
    The joined metrics are stored once; their extremes come from one aggregate
    and the percentile is exact (linear interpolation, as numpy), computed by
    ``exact_percentile``, which orders a bounded number of values in one task.
    """
    palette = COLOR_SCHEMES.get(scheme, COLOR_SCHEMES[DEFAULT_SCHEME])
    j = StateLoop().finish(size.join(color, "id", "full"))
    ends = j.agg(*[f(c).cast("double") for c in ("size_metric", "color_metric") for f in (F.min, F.max)]).first()
    smin, smax, cmin, cmax = (F.lit(x).cast("double") for x in ends)
    j = j.where(F.col("size_metric").isNotNull()).na.fill(0.0, ["color_metric"])
    thr = F.lit(exact_percentile(j, "size_metric", 1.0 - label_threshold)).cast("double")
    cval = (F.col("color_metric") - cmin) / _range(cmin, cmax)
    idx = F.floor(cval * F.lit(len(palette) - 1)).cast("int")
    return j.select(
        "id", "size_metric", "color_metric",
        (F.lit(10.0) + F.lit(40.0) * (F.col("size_metric") - smin) / _range(smin, smax)).alias("size"),
        cval.alias("color_value"),
        F.element_at(F.array(*[F.lit(c) for c in palette]), idx + 1).alias("color"),
        (F.col("size_metric") >= thr).alias("show_label"),
    )


def edge_display(e: DataFrame, weight_col: str | None = None) -> DataFrame:
    """Per edge: weight (1 when absent) and width scaled to 1..5 by min-max."""
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    d = e.select("src", "dst", w.alias("weight"))
    wmin = d.select(F.min("weight")).scalar()
    wmax = d.select(F.max("weight")).scalar()
    return d.select("src", "dst", "weight",
                    (F.lit(1.0) + F.lit(4.0) * (F.col("weight") - wmin) / _range(wmin, wmax))
                    .alias("width"))
