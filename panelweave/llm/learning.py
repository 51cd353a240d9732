"""What the trained operators share: folds, bounded samples and models averaged over partitions."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most shards of a training sample; each is fitted by one task and the models are averaged. A shard has this many rows
#: at least (as drawn), since models of a few rows differ too much to be averaged.
SHARDS, LEAST_ROWS = 8, 250


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n (a null key counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def shard_of(key: Column, rows: float) -> Column:
    """Shard of a row of a sample of about so many rows."""
    shards = max(1, min(SHARDS, int(rows) // LEAST_ROWS))
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards)).cast("int")


def averaged(sample: DataFrame, start: list[np.ndarray], rounds: int,
             fit: Callable[[pd.DataFrame, list[np.ndarray], int], tuple[list[np.ndarray], int]]) -> list[np.ndarray]:
    """Iterative parameter mixing: each round, every shard continues from the mean of all shards' models.

    ``sample`` has a column ``shard``. ``fit`` gets the rows of one shard, the model
    and the number of the round, and returns the model and how much it weighs. What
    a task returns and the driver holds is the model, whose size is fixed.
    """
    model = [np.asarray(p, dtype=np.float64) for p in start]
    for round_ in range(rounds):
        step = _round(fit, model, round_)
        parts = sample.groupBy("shard").applyInPandas(step, "shard int, weight double, model binary").collect()
        weight = sum(p.weight for p in parts)
        if not weight:
            return model
        flat = sum(p.weight / weight * np.frombuffer(zlib.decompress(p.model), dtype=np.float32).astype(np.float64)
                   for p in sorted(parts, key=lambda p: p.shard))
        bounds = np.cumsum([0] + [p.size for p in model])
        model = [flat[a:b].reshape(p.shape) for a, b, p in zip(bounds, bounds[1:], model, strict=False)]
    return model


def _round(fit, model: list[np.ndarray], round_: int):
    def step(rows: pd.DataFrame) -> pd.DataFrame:
        fitted, weight = fit(rows, model, round_)
        packed = np.concatenate([p.ravel() for p in fitted]).astype(np.float32).tobytes()
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "weight": [float(weight)],
                             "model": [zlib.compress(packed, 1)]})

    return step


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
