"""Products of transforms of series too long for one task.

A transform of M points is split into R columns by C rows (R * C = M).  Groups
hold a bundle of neighbouring columns or rows, at most ``BUNDLE`` points of an
array.  Between two steps they exchange tiles, a bundle of columns crossed with
a bundle of rows as one binary value, so that a shuffle moves few large values
and no row per point.  The inverse starts from the rows that the forward
transform ends with, so that a product takes three exchanges in all.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUNDLE = 262_144  # points of an array in one group
_META = ("_N", "_M", "_R")


def with_sizes(series: DataFrame) -> DataFrame:
    """Add to the length ``_N`` the points of the transform (a power of two, twice the length at least) and its rows."""
    bits = F.ceil(F.log2((F.col("_N") * 2).cast("double")))
    return series.withColumn("_M", F.pow(F.lit(2.0), bits).cast("long")).withColumn(
        "_R", F.pow(F.lit(2.0), F.ceil(bits / 2)).cast("long")
    )


def partitions_for(points: int) -> int:
    """Partitions of about four bundles."""
    return max(1, -(-points // (4 * BUNDLE)))


def transform_products(
    points: DataFrame,
    keys: list[str],
    fields: Sequence[str],
    load: Callable[..., list[np.ndarray]],
    multiply: Callable[..., list[np.ndarray]],
    results: int,
    partitions: int | None = None,
) -> DataFrame:
    """Inverse transforms of products of transforms, as rows ``(keys, _N,
    _pos, re0, im0, re1, ...)`` for 0 <= _pos < _N.

    Points are rows ``(keys, _N, _M, _R, _pos, fields)``, one at most for each
    position; a field is zero elsewhere.  ``load`` makes the arrays to transform
    out of those of the fields, ``multiply`` the ``results`` products out of
    their transforms; both work point by point.
    """
    bundle = BUNDLE
    head = [points.schema[k] for k in keys] + [T.StructField(m, T.LongType()) for m in _META]
    places = [T.StructField(c, T.LongType()) for c in ("_across", "_down")]
    tiles = T.StructType([*head, *places, T.StructField("_tile", T.BinaryType())])
    parts = [f"{p}{a}" for a in range(results) for p in ("re", "im")]
    out = T.StructType([*head, T.StructField("_pos", T.LongType()), *[T.StructField(p, T.DoubleType()) for p in parts]])

    def shape(pdf: pd.DataFrame) -> tuple[int, int, int, int, int]:
        """Points, rows, columns, columns and rows of a bundle."""
        m, r = int(pdf["_M"].iloc[0]), int(pdf["_R"].iloc[0])
        c = m // r
        return m, r, c, min(c, max(1, bundle // r)), min(r, max(1, bundle // c))

    def repeated(pdf: pd.DataFrame, size: int) -> dict:
        return {c: np.repeat(pdf[c].iloc[:1].to_numpy(), size) for c in (*keys, *_META)}

    def turn(down: np.ndarray, across: np.ndarray, m: int) -> np.ndarray:
        return np.exp(-2j * math.pi * (np.outer(down, across) % m) / m)

    def columns(pdf: pd.DataFrame) -> pd.DataFrame:
        m, r, c, wide, high = shape(pdf)
        own = int(pdf["_across"].iloc[0])
        pos = pdf["_pos"].to_numpy()
        dense = np.zeros((len(fields), r, wide))
        for at, f in enumerate(fields):
            dense[at, pos // c, pos % c - own * wide] = pdf[f].to_numpy()
        turned = turn(np.arange(r), own * wide + np.arange(wide), m)
        z = np.stack([np.fft.fft(a, axis=0) * turned for a in load(*dense)])
        cut = [z[:, at:at + high].tobytes() for at in range(0, r, high)]
        return pd.DataFrame(repeated(pdf, len(cut)) | {"_across": own, "_down": np.arange(len(cut)), "_tile": cut})

    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        m, r, c, wide, high = shape(pdf)
        own = int(pdf["_down"].iloc[0])
        z = None
        for at, tile in zip(pdf["_across"], pdf["_tile"]):
            part = np.frombuffer(tile, dtype=complex).reshape(-1, high, wide)
            if z is None:
                z = np.zeros((len(part), high, c), dtype=complex)
            z[:, :, at * wide:(at + 1) * wide] = part
        product = np.stack(multiply(*np.fft.fft(z, axis=2)))
        y = np.fft.ifft(product, axis=2) * np.conj(turn(own * high + np.arange(high), np.arange(c), m))
        cut = [y[:, :, at:at + wide].tobytes() for at in range(0, c, wide)]
        return pd.DataFrame(repeated(pdf, len(cut)) | {"_across": np.arange(len(cut)), "_down": own, "_tile": cut})

    def back(pdf: pd.DataFrame) -> pd.DataFrame:
        _, r, c, wide, high = shape(pdf)
        own = int(pdf["_across"].iloc[0])
        y = np.zeros((results, r, wide), dtype=complex)
        for at, tile in zip(pdf["_down"], pdf["_tile"]):
            y[:, at * high:(at + 1) * high] = np.frombuffer(tile, dtype=complex).reshape(results, high, wide)
        x = np.fft.ifft(y, axis=1)
        pos = np.arange(r)[:, None] * c + own * wide + np.arange(wide)
        kept = pos < int(pdf["_N"].iloc[0])
        values = {p: v for a in range(results) for p, v in ((f"re{a}", x[a].real[kept]), (f"im{a}", x[a].imag[kept]))}
        return pd.DataFrame(repeated(pdf, int(kept.sum())) | {"_pos": pos[kept]} | values)

    def grouped(df: DataFrame, place: str):
        return (df.repartition(partitions, *keys, place) if partitions else df).groupBy(*keys, place)

    width = F.floor(F.col("_M") / F.col("_R"))
    wide = F.least(width, F.greatest(F.lit(1).cast("long"), F.floor(F.lit(bundle) / F.col("_R"))))
    placed = points.select(
        *keys, *_META, "_pos", *fields, F.floor(F.pmod(F.col("_pos"), width) / wide).alias("_across")
    )
    forward = grouped(placed, "_across").applyInPandas(columns, tiles)
    turned = grouped(forward, "_down").applyInPandas(rows, tiles)
    return grouped(turned, "_across").applyInPandas(back, out).drop("_M", "_R")
