"""Media payloads (F10's pixels, M8): codecs are injected; samples are resampled in numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIO_RATE = 20_050


def resample(samples: np.ndarray, rate: int, to: int = AUDIO_RATE) -> np.ndarray:
    """Linear interpolation to another rate; the duration stays."""
    n = round(len(samples) * to / rate)
    return np.interp(np.arange(n) * rate / to, np.arange(len(samples)), samples) if len(samples) else np.zeros(0)


def resampled(samples: str | Column, rate: str | Column, to: int = AUDIO_RATE) -> Column:
    """M8: an array of samples at ``to`` a second; null where samples or rate are null."""

    @F.pandas_udf("array<float>")
    def run(s: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or pd.isna(y) else resample(np.asarray(x, float), int(y), to).astype(np.float32) for x, y in zip(s, r, strict=True)])

    return run(samples, rate)


def cropped(df: DataFrame, columns: list[str], codec: Callable[[], Callable], content: str = "content", crop: str = "crop", out: str = "pixels") -> DataFrame:
    """images through an injected codec: a factory, called once a worker task, of a
    function (bytes, resized width and height, left, top) -> bytes of the centre crop; an
    image that it can't read gives null."""
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), f"`{out}` binary"])

    def run(frames):
        work = codec()

        def one(raw, c):
            try:
                return work(raw, c["width"], c["height"], c["left"], c["top"])
            except Exception:  # the row's null says so
                return None

        for f in frames:
            f[out] = [one(raw, c) for raw, c in zip(f[content], f[crop], strict=True)]
            yield f[[*columns, out]]

    return df.select(*dict.fromkeys([*columns, content, crop])).mapInPandas(run, schema)
