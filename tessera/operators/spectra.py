"""Radial power spectra of windows of a grid."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.grid import RADIUS_KM

#: How far below a bin's edge, in bins, a wavenumber counts as on it: its last bits depend on the order of the sums.
EDGE = 1e-9


def window_power(cells: DataFrame, n: int, res: float, value: str = "v") -> DataFrame:
    """(wr, wc, k, power) of each element of the half-plane transform of whole windows of n x n cells.

    The mean goes, a Hann taper is laid on both sides; k is the wavenumber in
    rad/km with the longitude side at the latitude of the window's middle. A window
    is a bounded group; one with a missing or null cell gives no rows.
    """
    km = np.pi / 180 * RADIUS_KM
    hann = np.hanning(n)

    def power(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        z = np.full((n, n), np.nan)
        z[frame["i"], frame["j"]] = frame["z"]
        if np.isnan(z).any():
            return pd.DataFrame({"wr": [], "wc": [], "k": [], "power": []})
        middle = np.radians((key[0] + 0.5) * n * res - 90)
        f = np.fft.rfft2((z - z.mean()) * np.outer(hann, hann))
        ky = 2 * np.pi * np.fft.fftfreq(n, res) / km
        kx = 2 * np.pi * np.fft.rfftfreq(n, res) / (km * np.cos(middle))
        return pd.DataFrame({"wr": key[0], "wc": key[1], "k": np.hypot(*np.meshgrid(ky, kx, indexing="ij")).ravel(), "power": (f.real**2 + f.imag**2).ravel()})

    at = cells.select((F.col("r") / n).cast("int").alias("wr"), (F.col("c") / n).cast("int").alias("wc"), (F.col("r") % n).alias("i"), (F.col("c") % n).alias("j"), F.col(value).cast("double").alias("z"))
    return at.groupBy("wr", "wc").applyInPandas(power, "wr int, wc int, k double, power double")


def radial_power(cells: DataFrame, n: int, res: float, bins: int = 48, value: str = "v") -> DataFrame:
    """(wr, wc, bin, k, power, elements): mean power in equal bins of wavenumber from 0 to a window's greatest; an edge belongs to the upper bin, empty bins have no row."""
    each = window_power(cells, n, res, value)
    top = each.groupBy("wr", "wc").agg(F.max("k").alias("top"))
    at = each.join(top, ["wr", "wc"]).withColumn("bin", F.least(F.floor(F.col("k") / F.col("top") * bins + EDGE), F.lit(bins - 1)).cast("int"))
    return at.groupBy("wr", "wc", "bin").agg(((F.col("bin") + 0.5) * F.max("top") / bins).alias("k"), F.avg("power").alias("power"), F.count("*").alias("elements"))
