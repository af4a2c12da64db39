"""Run a user's policy over observations.

The policy is a user class ``cls(checkpoint_path)`` with ``run_policy(state:
dict) -> list[list[float]]`` (a chunk of actions). ``mapInArrow`` builds it once
per Python task and feeds record batches, so model loading is not per row
(batch size from ``spark.sql.execution.arrow.maxRecordsPerBatch``). The first of
these methods that a policy has is called:

* ``run_policy_arrow(batch: pyarrow.RecordBatch) -> pyarrow.Array``: columns in,
  one ``list<list<double>>`` entry a row out; no Python object per row.
* ``run_policy_batch(states: list[dict]) -> list``: once per batch.
* ``run_policy(state: dict) -> list``: once per row, the policy's own API.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The functions and example policies of this module run in Python workers;
# ship them by value so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class NoActionPolicy:
    """The default policy: no actions."""

    def __init__(self, checkpoint_path: str | None = None):
        self.checkpoint_path = checkpoint_path

    def run_policy(self, state: dict) -> list:
        return []


class ScaledStatePolicy:
    """A deterministic example policy: two actions, the state scaled by 0.5 and 0.25."""

    def __init__(self, checkpoint_path: str | None = None):
        self.checkpoint_path = checkpoint_path

    def run_policy(self, state: dict) -> list:
        x = state.get("action")
        if x is None:
            return []
        return [[v * 0.5 for v in x], [v * 0.25 for v in x]]


class ScaledStateBatchPolicy(ScaledStatePolicy):
    """The same policy with a batched entry point (numpy over the batch)."""

    def run_policy_batch(self, states: list[dict]) -> list:
        out = []
        for st in states:
            x = st.get("action")
            if x is None:
                out.append([])
                continue
            a = np.asarray(x, dtype=np.float64)
            out.append([(a * 0.5).tolist(), (a * 0.25).tolist()])
        return out


class ScaledStateArrowPolicy(ScaledStatePolicy):
    """The same policy on columns: all values of a batch are scaled at once and put together by their places."""

    def run_policy_arrow(self, batch: pa.RecordBatch) -> pa.Array:
        x = batch.column("action")
        there = x.is_valid().to_numpy(zero_copy_only=False)
        size = pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)[there].astype(np.int64)
        values = x.flatten().cast(pa.float64())          # the entries of null lists are left out
        scaled = pa.concat_arrays([pc.multiply(values, 0.5), pc.multiply(values, 0.25)])
        start = np.cumsum(size) - size
        # two actions a row: its values in the first half of ``scaled``, then those in the second
        starts, sizes = np.stack([start, start + len(values)], axis=1).ravel(), np.repeat(size, 2)
        ends = np.cumsum(sizes)
        places = np.repeat(starts - (ends - sizes), sizes) + np.arange(sizes.sum())
        actions = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), scaled.take(pa.array(places)))
        rows = np.concatenate([[0], np.cumsum(np.where(there, 2, 0))])
        return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), actions)


ACTIONS = pa.list_(pa.list_(pa.float64()))


def score_policy(df: DataFrame, policy_factory: Callable[[str | None], object] = NoActionPolicy,
                 checkpoint: str | None = None, state_cols: tuple[str, ...] = ("state", "pending_actions", "action"),
                 out: str = "actions") -> DataFrame:
    """Adds ``actions array<array<double>>``: the policy's answer for each row.

    The policy sees ``state_cols`` alone; a null value is ``None`` in a state
    dict. A null answer stays null. Other columns pass through as they are, and
    a column named ``out`` is replaced.
    """
    kept = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType(kept + [T.StructField(out, T.ArrayType(T.ArrayType(T.DoubleType())), True)])
    cols, names = list(state_cols), [f.name for f in kept]

    def answers(policy: object, batch: pa.RecordBatch) -> pa.Array:
        if hasattr(policy, "run_policy_arrow"):
            return policy.run_policy_arrow(batch).cast(ACTIONS)
        states = batch.to_pylist()
        raw = policy.run_policy_batch(states) if hasattr(policy, "run_policy_batch") else [policy.run_policy(st) for st in states]
        return pa.array([None if res is None else [[float(v) for v in a] for a in res] for res in raw], ACTIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        policy = policy_factory(checkpoint)
        for batch in batches:
            scored = answers(policy, batch.select(cols))
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, scored], [*names, out])

    return df.mapInArrow(run, schema)
