"""Residuals and principal components. Designs are samples by covariates and small; features stream through tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Samples above which components come from random projections and not from the Gram matrix of samples.
MOST_SAMPLES = 10_000
#: Doubles that a task sends as one row when arrays are added up, and bytes that all tasks together may send.
PART, SENT = 1 << 17, 4 << 30
#: Factorisations by pattern of missing samples that a task remembers.
REMEMBERED = 256


def model_matrix(covariates: pd.DataFrame) -> np.ndarray:
    """Intercept and covariates; text becomes indicators of all its values but the first. An error unless samples exceed the rank."""
    x = pd.get_dummies(covariates, drop_first=True).to_numpy(float)
    x = np.column_stack([np.ones(len(x)), x])
    if np.linalg.matrix_rank(x) >= len(x):
        raise ValueError("more samples than the design's rank are needed")
    return x


def design_matrix(covariates: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The design of the rows without a missing covariate, and which rows these are."""
    complete = covariates.notna().all(axis=1).to_numpy()
    return model_matrix(covariates[complete]), complete


def reconcile(samples: list[str], covariates: pd.DataFrame) -> tuple[list[str], np.ndarray]:
    """Of a matrix's samples, in order, those with complete covariates (a row a sample, the sample being the index), and their design."""
    shared = [s for s in samples if s in covariates.index]
    if not shared:
        raise ValueError("no sample has covariates")
    typed = covariates.loc[shared].apply(lambda c: pd.to_numeric(c) if pd.to_numeric(c, errors="coerce").notna().eq(c.notna()).all() else c)
    design, complete = design_matrix(typed)
    return [s for s, ok in zip(shared, complete, strict=True) if ok], design


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal lengths as rows, nulls as NaN."""
    flat = column.flatten()
    return flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), -1)


def residualize(features: DataFrame, design: np.ndarray) -> DataFrame:
    """features (…, vec) with vec less its least-squares fit on the design (a row a sample, in the order of vec).

    Vectors of a batch that lack the same samples are projected at once, with one factorisation; a vector is null where it has too
    few samples for the design that these leave.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases: dict[bytes, np.ndarray | None] = {}

        def base(seen: np.ndarray) -> np.ndarray | None:
            key = np.packbits(seen).tobytes()
            if key not in bases:
                if len(bases) >= REMEMBERED:
                    bases.clear()
                x = design[seen]
                rank = np.linalg.matrix_rank(x) if seen.any() else 0
                bases[key] = np.linalg.svd(x, full_matrices=False)[0][:, :rank] if seen.sum() > rank else None
            return bases[key]

        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index("vec")
            rows = _matrix(batch.column(at))
            out = np.full_like(rows, np.nan)
            seen = ~np.isnan(rows)
            masks, of = np.unique(np.packbits(seen, axis=1), axis=0, return_inverse=True)
            of = of.ravel()
            for k in range(len(masks)):
                own = np.flatnonzero(of == k)
                mask = seen[own[0]]
                if (b := base(mask)) is not None:
                    y = rows[np.ix_(own, mask)]
                    out[np.ix_(own, mask)] = y - y @ b @ b.T
            flat = pa.array(out.ravel(), mask=np.isnan(out.ravel()))
            vec = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([vec if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return features.mapInArrow(fit, features.schema)


def scale_rows(features: DataFrame) -> DataFrame:
    """features with vec centred and divided by its standard deviation over the samples it has; null without variance."""
    known = F.filter("vec", lambda x: x.isNotNull())
    n, total = F.size(known), F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    rows = features.withColumn("__mean", F.try_divide(total, F.nullif(n, F.lit(0))))
    square = F.aggregate(F.filter("vec", lambda x: x.isNotNull()), F.lit(0.0), lambda a, x: a + (x - F.col("__mean")) * (x - F.col("__mean")))
    rows = rows.withColumn("__sd", F.sqrt(F.try_divide(square, F.when(n > 1, n - 1))))
    sd = F.when(F.col("__sd") > 0, F.col("__sd"))
    return rows.withColumn("vec", F.transform("vec", lambda x: F.try_divide(x - F.col("__mean"), sd))).drop("__mean", "__sd")


def added_up(features: DataFrame, shape: tuple[int, ...], of_batch: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all batches of features (rows by samples) of an array of the given shape.

    A task adds its own up and sends it in parts; equal parts meet and are added as they come in, so no task holds more than the
    array; the number of tasks is held down where the array is large. The driver gets the sum.
    """
    size = int(np.prod(shape))
    most = max(1, SENT // (8 * size))

    def count(batches):
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += of_batch(_matrix(batch.column(0)))
        flat = total.ravel()
        for at in range(0, size, PART):
            yield pa.record_batch([pa.array([at // PART], pa.int32()), pa.array([flat[at : at + PART].tobytes()], pa.binary())], ["part", "sums"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(own)
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["part", "sums"])

    parts = features.select("vec").coalesce(most).mapInArrow(count, "part int, sums binary").repartition("part").mapInArrow(add, "part int, sums binary")
    out = np.zeros(size)
    for row in parts.toLocalIterator():
        own = np.frombuffer(row["sums"])
        out[row["part"] * PART : row["part"] * PART + len(own)] = own
    return out.reshape(shape)


def _centred(x: np.ndarray) -> np.ndarray:
    return x - x.mean(1, keepdims=True)


def _signed(vectors: np.ndarray) -> np.ndarray:
    """Columns turned so that the largest entry of each is positive."""
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return vectors * np.where(signs == 0, 1, signs)


def principal_components(features: DataFrame, n_samples: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores (samples, components) and standard deviations of features centred over samples: all components, from the Gram matrix
    of samples. Signs make each component's largest score positive."""
    if n_samples > MOST_SAMPLES:
        raise ValueError(f"{n_samples} samples: use random_components()")

    def gram(x: np.ndarray) -> np.ndarray:
        x = _centred(x)
        return x.T @ x

    total = added_up(features, (n_samples, n_samples), gram)
    values, vectors = np.linalg.eigh((total + total.T) / 2)
    order = np.argsort(values)[::-1]
    values, vectors = np.clip(values[order], 0, None), vectors[:, order]
    return _signed(vectors) * np.sqrt(values), np.sqrt(values / max(1, n_samples - 1))


def random_components(features: DataFrame, n_samples: int, n: int, more: int = 10, rounds: int = 6, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first n components as in principal_components(), by subspace iteration on random projections: a pass over the features a
    round, and never more than samples by n + more numbers in a task or on the driver. The expected error of a squared deviation falls
    with the power 2 * rounds + 1 of the ratio of the (n + more)-th deviation to it."""
    width = min(n_samples, n + more)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(n_samples, width)))[0]
    for k in range(rounds + 1):
        held = basis
        image = added_up(features, (n_samples, width), lambda x, held=held: _centred(x).T @ (_centred(x) @ held))
        if k < rounds:
            basis = np.linalg.qr(image)[0]
    values, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
    order = np.argsort(values)[::-1][:n]
    values = np.clip(values[order], 0, None)
    return _signed(basis @ turn[:, order]) * np.sqrt(values), np.sqrt(values / max(1, n_samples - 1))


def component_count(deviations: np.ndarray, n_samples: int, n_features: int, noise: float = 1.0) -> int:
    """Components whose singular value exceeds the optimal hard threshold of Gavish and Donoho for known noise."""
    beta = min(n_samples, n_features) / max(n_samples, n_features)
    limit = np.sqrt(2 * (beta + 1) + 8 * beta / (beta + 1 + np.sqrt(beta**2 + 14 * beta + 1)))
    singular = deviations * np.sqrt(max(1, n_samples - 1))
    return int((singular > limit * np.sqrt(max(n_samples, n_features)) * np.sqrt(noise)).sum())


def chosen_components(features: DataFrame, n_samples: int) -> tuple[np.ndarray, int]:
    """Scores and how many of the components the hard threshold keeps, at least one. Up to MOST_SAMPLES samples the scores are of all
    components; beyond, of as many as it takes to go below the threshold."""
    n_features = features.count()
    if n_samples <= MOST_SAMPLES:
        scores, deviations = principal_components(features, n_samples)
        return scores, max(1, component_count(deviations, n_samples, n_features))
    n = 64
    while True:
        scores, deviations = random_components(features, n_samples, n)
        kept = component_count(deviations, n_samples, n_features)
        if kept < n or n >= n_samples:
            return scores, max(1, kept)
        n *= 2


def pcs_frame(features: DataFrame, scores: np.ndarray, samples: list[str], n: int) -> DataFrame:
    """ID and PC1 to PCn, a row a sample."""
    rows = [(s, *map(float, scores[i, :n])) for i, s in enumerate(samples)]
    return features.sparkSession.createDataFrame(rows, "ID string" + "".join(f", PC{k + 1} double" for k in range(n)))
