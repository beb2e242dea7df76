"""Jobs on image and volume arrays: one ``ARRAY<DOUBLE>`` per row, row-major, with
all edges equal to the box size. Every job is one pass without a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentspark.functions.matrices import BLOCK_ELEMENTS, from_matrix, to_matrix


def _crop_spectrum(arrays: np.ndarray, box: int, axes: tuple[int, ...]) -> np.ndarray:
    """Fourier-crop the given axes to ``box`` and keep the mean."""
    full = arrays.shape[axes[0]]
    spectrum = np.fft.fftshift(np.fft.fftn(arrays, axes=axes), axes=axes)
    start = full // 2 - box // 2
    window = [slice(None)] * arrays.ndim
    for axis in axes:
        window[axis] = slice(start, start + box)
    cropped = np.fft.ifftshift(spectrum[tuple(window)], axes=axes)
    return np.fft.ifftn(cropped, axes=axes).real * (box / full) ** len(axes)


def _downsample(df: DataFrame, box: int, dims: int, column: str) -> DataFrame:
    if box % 2:
        raise ValueError("box size must be even")
    place = df.columns.index(column)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            pixels = len(batch.column(place)[0])
            edge = round(pixels ** (1.0 / dims))
            if edge ** dims != pixels or edge < box:
                raise ValueError(f"cannot bring an array of {pixels} values to box {box}")
            # Rows transformed at once are limited by their size, not their number.
            rows = max(1, BLOCK_ELEMENTS // pixels)
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                stack = to_matrix(part.column(place)).reshape((-1,) + (edge,) * dims)
                small = _crop_spectrum(stack, box, tuple(range(1, dims + 1)))
                columns = list(part.columns)
                columns[place] = from_matrix(small.reshape(len(small), -1))
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(shrink, df.schema)


def downsample_images(df: DataFrame, box: int, column: str = "image") -> DataFrame:
    """Images at a smaller even box, by cropping their Fourier transform."""
    return _downsample(df, box, 2, column)


def downsample_volumes(df: DataFrame, box: int, column: str = "volume") -> DataFrame:
    """Volumes at a smaller even box, by cropping their Fourier transform."""
    return _downsample(df, box, 3, column)


def invert(df: DataFrame, column: str = "image") -> DataFrame:
    """Contrast of an array column, or of a plain voxel value column, turned round."""
    value = F.col(column)
    is_array = df.schema[column].dataType.typeName() == "array"
    return df.withColumn(column, F.transform(value, lambda x: -x) if is_array else -value)


def window_images(df: DataFrame, radius: float = 0.85, column: str = "image") -> DataFrame:
    """Circular window: 1 inside ``radius`` (of the half box), 0 from the half box
    on, a cosine edge between."""
    place = df.columns.index(column)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            stack = to_matrix(batch.column(place))
            columns = list(batch.columns)
            columns[place] = from_matrix(stack * _window(round(stack.shape[1] ** 0.5), radius).ravel())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(apply, df.schema)


def _window(edge: int, radius: float) -> np.ndarray:
    axis = (np.arange(edge) - edge // 2) / (edge / 2)
    r = np.sqrt(axis[:, None] ** 2 + axis[None, :] ** 2)
    soft = (np.cos((r - radius) / max(1.0 - radius, 1e-12) * np.pi) + 1.0) / 2.0
    return np.where(r <= radius, 1.0, np.where(r >= 1.0, 0.0, soft))


def images_to_pixels(df: DataFrame, column: str = "image") -> DataFrame:
    """One row per pixel ``(…, py, px, v)``."""
    edge = F.sqrt(F.size(column)).cast("int")
    others = [c for c in df.columns if c != column]
    return df.select(*others, edge.alias("_edge"), F.posexplode(column).alias("_i", "v")).select(
        *others, F.floor(F.col("_i") / F.col("_edge")).cast("int").alias("py"),
        F.pmod("_i", "_edge").cast("int").alias("px"), "v")
