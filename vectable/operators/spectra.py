"""Short-time spectra of sampled series: framing, transform, inverse and overlap-add."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectable.functions.blocks import from_matrix, matrix_udf, row_slices
from vectable.functions.exprs import TAPERS, taper_values, to_cartesian, to_polar
from vectable.operators.order import sequence_position, whole_groups

#: Samples that a task frames at a time.
BLOCK_SAMPLES = 1 << 16


def _check(fftsize: int, overlap: int, window: str) -> int:
    if not 16 <= fftsize <= 65536 or fftsize & (fftsize - 1):
        raise ValueError("fftsize is a power of two from 16 to 65536")
    if overlap < 1 or fftsize % overlap:
        raise ValueError("overlap divides fftsize")
    if window not in TAPERS:
        raise ValueError(f"window is one of {TAPERS}")
    return fftsize // overlap


def pick_channel(df: DataFrame, channel: int) -> DataFrame:
    """One channel (numbered from 1) of a multi-channel series."""
    return df.filter(F.col("channel") == channel)


def indexed(df: DataFrame, series_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Give every sample its 0-based place ``n`` in its series, by time order."""
    return sequence_position(df, list(series_cols), list(order_cols), "n")


def frames(df: DataFrame, fftsize: int, overlap: int, series_cols: Sequence[str] = ("series",)) -> DataFrame:
    """(series, frame, samples ARRAY<DOUBLE>): frames start every fftsize / overlap samples, the tail is zero-padded.

    ``df`` holds (series, n, sample), n = 0, 1, ..  The samples of a series go to tasks in blocks of
    at least BLOCK_SAMPLES; a block also gets the first samples of the next one, as many as its last frames reach into.
    So a sample is sent once, but for the edges of blocks, and a series of any length is spread.
    """
    hop = fftsize // overlap
    frames_per_block = -(-max(BLOCK_SAMPLES, fftsize) // hop)
    block, reach = frames_per_block * hop, fftsize - hop
    own = F.expr(f"n div {block}")
    edge = (own > 0) & (F.col("n") % block < reach)
    spread = df.withColumn("__block", F.explode(F.when(edge, F.array(own, own - 1)).otherwise(F.array(own))))
    picked = spread.select(*series_cols, "__block", F.col("n").cast("bigint").alias("__n"), F.col("sample").cast("double").alias("__v"))
    keys = [*series_cols, "__block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, at in whole_groups(batches, len(keys), BLOCK_SAMPLES):
            size = np.diff(at)
            first = rows["__block"].to_numpy()[at[:-1]] * block
            group = np.repeat(np.arange(len(size)), size)
            place = rows["__n"].to_numpy() - first[group]
            # Frames begin at samples of this block only, and end with zeros.
            count = np.maximum.reduceat(np.where(place < block, place // hop, -1), at[:-1]) + 1
            room = np.where(count > 0, (count - 1) * hop + fftsize, 0)
            begin = np.cumsum(room) - room
            x = np.zeros(int(room.sum()) + fftsize)
            kept = place < room[group]
            x[(begin[group] + place)[kept]] = rows["__v"].to_numpy()[kept]
            of = np.repeat(np.arange(len(size)), count)
            frame = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            view = np.lib.stride_tricks.sliding_window_view(x, fftsize)
            for s in row_slices(len(of), fftsize):
                names = [rows[c].chunk(0).take(pa.array(at[of[s]])) for c in series_cols]
                yield pa.RecordBatch.from_arrays([*names, pa.array(first[of[s]] // hop + frame[s]), from_matrix(view[begin[of[s]] + frame[s] * hop])], [*series_cols, "frame", "samples"])

    fields = [f for f in df.schema.fields if f.name in series_cols]
    schema = T.StructType([*sorted(fields, key=lambda f: list(series_cols).index(f.name)), T.StructField("frame", T.LongType()), T.StructField("samples", T.ArrayType(T.DoubleType()))])
    return picked.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def stft(
    df: DataFrame,
    *,
    fftsize: int = 1024,
    overlap: int = 4,
    window: str = "hanning",
    full_spectrum: bool = False,
    output_polar: bool = False,
    series_cols: Sequence[str] = ("series",),
) -> DataFrame:
    """(series, frame, bin, re, im) or (.., mag, phase) of (series, n, sample).

    The half spectrum has fftsize/2 bins (no Nyquist bin); the full one appends the half
    in reverse order.
    """
    _check(fftsize, overlap, window)
    half = fftsize // 2
    weights = np.asarray(taper_values(window, fftsize))

    def transform(x: np.ndarray) -> np.ndarray:
        z = np.fft.rfft(x * weights, axis=1)[:, :half]
        z.imag[:, 0] = 0.0
        return np.hstack([z.real, z.imag])

    spectrum = frames(df, fftsize, overlap, series_cols).withColumn("z", matrix_udf(transform)(F.col("samples")))
    last = fftsize if full_spectrum else half
    at = F.when(F.col("bin") < half, F.col("bin")).otherwise(F.lit(fftsize - 1) - F.col("bin"))
    bins = spectrum.select(*series_cols, "frame", "z", F.explode(F.sequence(F.lit(0), F.lit(last - 1))).alias("bin"))
    out = bins.select(*series_cols, "frame", "bin", F.get("z", at).alias("re"), F.get("z", at + half).alias("im"))
    if not output_polar:
        return out
    mag, phase = to_polar(F.col("re"), F.col("im"))
    return out.select(*series_cols, "frame", "bin", mag.alias("mag"), phase.alias("phase"))


def istft(
    df: DataFrame,
    *,
    fftsize: int = 1024,
    overlap: int = 4,
    window: str = "hanning",
    input_polar: bool = False,
    series_cols: Sequence[str] = ("series",),
) -> DataFrame:
    """(series, n, sample): inverse transform of each frame, taper, and sum where frames overlap.

    Only the first fftsize/2 bins are read, so a full spectrum works as well.
    """
    hop = _check(fftsize, overlap, window)
    half = fftsize // 2
    weights = np.asarray(taper_values(window, fftsize)) / overlap
    re, im = to_cartesian(F.col("mag"), F.col("phase")) if input_polar else (F.col("re"), F.col("im"))
    low = df.filter(F.col("bin") < half).select(*series_cols, "frame", "bin", re.alias("re"), im.alias("im"))
    cells = F.array_sort(F.collect_list(F.struct("bin", "re", "im")))
    packed = low.groupBy(*series_cols, "frame").agg(cells.alias("c"))
    both = F.concat(F.transform("c", lambda c: c["re"]), F.transform("c", lambda c: c["im"]))

    def inverse(z: np.ndarray) -> np.ndarray:
        full = np.zeros((len(z), half + 1), dtype=complex)
        full[:, :half] = z[:, :half] + 1j * z[:, half:]
        return np.fft.irfft(full, n=fftsize, axis=1) * weights

    samples = packed.select(*series_cols, "frame", F.posexplode_outer(matrix_udf(inverse)(both)).alias("j", "v"))
    return samples.groupBy(*series_cols, (F.col("frame") * hop + F.col("j")).alias("n")).agg(F.sum("v").alias("sample"))

