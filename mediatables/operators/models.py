"""Model seams: batch inference inside Spark tasks.

Models are supplied by the caller as picklable *factories*. Each Python
worker builds the model once (module-level cache keyed by the factory) and
reuses it for every Arrow batch of every task it runs - the "one model per
worker" pattern. Inference functions receive whole batches.

Spark may evaluate a Python UDF on rows a surrounding ``when`` would discard,
so guards (e.g. "only embed ok images") are applied inside the UDF too.
Model outputs should be materialised (written) before they are reused, since
a lazy plan or a retried task would call the model again.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MODEL_CACHE: dict[Any, Any] = {}


def model_key(factory: Callable[[], Any]) -> Any:
    """A key that stays the same however often the factory is unpickled."""
    return getattr(factory, "cache_key", None) or hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


def cached_model(factory: Callable[[], Any], key: Any = None) -> Any:
    """The worker-local instance built by ``factory`` (built on first use)."""
    key = key or model_key(factory)
    model = _MODEL_CACHE.get(key)
    if model is None:
        model = factory()
        _MODEL_CACHE[key] = model
    return model


def swept(batches: Iterable[Any]) -> Iterator[Any]:
    """The batches, each freed soon after the next one is asked for.

    pandas objects often hold themselves (a Series is held by its own ``str``),
    and few other objects are made, so the collector would come round only
    after much of a task's input. What is there before is left out of its way.
    """
    gc.collect()
    gc.freeze()
    for batch in batches:
        yield batch
        del batch
        gc.collect()


def batch_udf(factory: Callable[[], Any], return_type: T.DataType,
              method: str = "__call__", deterministic: bool = False):
    """Iterator pandas UDF calling ``model.<method>(*series)`` per batch.

    The UDF is marked non-deterministic by default so a filter on its output
    cannot make Catalyst evaluate it twice.
    """
    key = model_key(factory)  # on the driver, once

    @F.pandas_udf(return_type)
    def _run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = cached_model(factory, key)
        fn = getattr(model, method)
        for batch in swept(batches):
            cols = batch if isinstance(batch, tuple) else (batch,)
            yield fn(*cols)

    return _run if deterministic else _run.asNondeterministic()


def guarded_embedding(factory: Callable[[], Any], content: Column, ok: Column,
                      dim: int, method: str = "embed_batch") -> Column:
    """embed ``content`` only where ``ok`` holds; NULL elsewhere.

    The guard is evaluated in the JVM and passed into the UDF, which skips
    the model call for unguarded rows. A model returns a matrix of one row per
    input, or a list in which None means that there is no vector.
    """
    rtype = T.ArrayType(T.FloatType())

    @F.pandas_udf(rtype)
    def _embed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = cached_model(factory)
        fn = getattr(model, method)
        for data, flag in swept(batches):
            mask = (flag.fillna(False).astype(bool) & data.notna()).to_numpy()
            out = np.empty(len(data), dtype=object)
            if mask.any():
                vecs = fn(data[mask])
                if not isinstance(vecs, np.ndarray):  # a list may hold None
                    vecs = pd.Series(vecs, dtype=object)
                    sizes = vecs.dropna().map(len)
                    wrong = sizes[sizes != dim]
                    wrong = None if wrong.empty else int(wrong.iloc[0])
                else:
                    wrong = None if vecs.shape[1] == dim else vecs.shape[1]
                if wrong is not None:
                    raise ValueError(f"embedding dimension mismatch: expected {dim}, got {wrong}")
                out[mask] = pd.Series(list(vecs), dtype=object).to_numpy()
            yield pd.Series(out, dtype=object)

    return F.when(ok & content.isNotNull(), _embed.asNondeterministic()(content, ok))


def call_model(df: DataFrame, prompt_col: str, client_factory: Callable[[], Any],
               out_col: str = "analysis_json", method: str = "complete",
               profile: Any = None) -> DataFrame:
    """One model response per row via ``mapInPandas``; errors -> NULL.

    The client is built once per worker; responses are strings (e.g. JSON)
    parsed afterwards with ``from_json`` so a bad response never fails the
    batch. ``profile`` (a ``pyspark.resource.ResourceProfile``) gives the
    model stage its own task resources on a cluster (stage-level scheduling).
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = cached_model(client_factory)
        fn = getattr(client, method)
        for pdf in swept(batches):
            answers = []
            for prompt in pdf[prompt_col]:
                try:
                    answers.append(None if prompt is None else fn(prompt))
                except Exception:  # noqa: BLE001 - any failed call becomes NULL
                    answers.append(None)
            pdf = pdf.copy()
            pdf[out_col] = answers
            yield pdf

    return df.mapInPandas(run, schema, profile=profile) if profile is not None else df.mapInPandas(run, schema)
