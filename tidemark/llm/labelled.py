"""A bounded, reproducible sample of labelled documents to train on."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import batches
from .text import fold, private

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(batches)

#: Documents whose fold is 0 are held out of all training.
FOLDS = 5


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, ident: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with their ``label`` (0 or 1): at most ``most`` labels of each value, those
    whose ids have the least hashes, none of them held out.

    The sample is taken from the labels alone; ``docs`` is read once and never shuffled, since the
    sample is at most 2 * ``most`` rows.
    """
    known = labels.filter(F.col(label).isin(0, 1) & (fold(F.col(ident), FOLDS) != 0)).select(
        F.col(ident).alias("labelled"), F.col(label).cast("int").alias("label")
    )
    parts = [known.filter(F.col("label") == v).orderBy(F.xxhash64("labelled"), "labelled").limit(most) for v in (0, 1)]
    sample = parts[0].unionByName(parts[1])
    return docs.join(F.broadcast(sample), F.col(ident) == F.col("labelled")).drop("labelled")


def label_share(labels: DataFrame, label: str, ident: str = "doc_id") -> float:
    """The share of label 1 among all labels (0 or 1) that are not held out."""
    known = labels.filter(fold(F.col(ident), FOLDS) != 0)
    positive, every = known.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label).isin(0, 1))).first()
    return positive / max(1, every)


def with_scores(
    docs: DataFrame,
    scorer: Callable[..., np.ndarray],
    *,
    keep: Sequence[str],
    text: str,
    also: Sequence[Column] = (),
    name: str = "score",
) -> DataFrame:
    """The columns ``keep`` of ``docs`` and, as ``name``, what ``scorer`` makes of each part of the texts
    and of the numeric columns ``also``. The text is sent once, whether or not it is kept."""
    kept = [c for c in keep if c != name]
    read = text if text in kept else private(docs, "text_scored")
    given = [F.col(f"`{c}`") for c in kept] + ([] if read == text else [F.col(text).alias(read)])
    beside = [private(docs, f"scored_{i}") for i in range(len(also))]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(name, T.DoubleType())])

    def run(parts):
        for batch in parts:
            found = [np.zeros(0)]
            for part in batches.slices(batch, read):
                numbers = [part.column(c).to_numpy(zero_copy_only=False) for c in beside]
                found.append(np.asarray(scorer(batches.column_bytes(part.column(read)), *numbers), dtype=float))
            columns = [batch.column(c) for c in kept] + [pa.array(np.concatenate(found))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, name])

    return docs.select(*given, *(c.alias(n) for c, n in zip(also, beside))).mapInArrow(run, schema)
