"""Feed-forward regression, trained data-parallel: one Spark job and one scan of a staged table per epoch.

Rows are dealt to parts of bounded size by a hash of their keys. In an epoch every part starts from the same weights and takes
its own steps, one per mini-batch; the weights and the state of the optimiser are then averaged over the parts. Only these, a
few hundred numbers, travel. A task takes the steps of `PARTS_AT_ONCE` parts side by side, in stacked arrays. Order, parts and dropout masks come from the row keys, so a fit does not depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline import fixed_values as fv
from lotline.staging import stage

# parts whose steps a task takes side by side; bounds its memory together with `part_rows`
PARTS_AT_ONCE = 32


def _sizes(inputs: int, units: Sequence[int]) -> list[tuple[int, int]]:
    layers = [inputs, *units, 1]
    return list(zip(layers[:-1], layers[1:]))


def _unpack(flat: np.ndarray, sizes) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights and biases of every layer; leading axes are networks of their own."""
    out, at = [], 0
    for i, o in sizes:
        out.append((flat[..., at:at + i * o].reshape(*flat.shape[:-1], i, o), flat[..., None, at + i * o:at + i * o + o]))
        at += i * o + o
    return out


def _initial(sizes, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for i, o in sizes:
        limit = np.sqrt(6.0 / (i + o))
        parts += [rng.uniform(-limit, limit, i * o), np.zeros(o)]
    return np.concatenate(parts)


def _keep_mask(ids: np.ndarray, units: int, epoch: int, rate: float) -> np.ndarray:
    """Dropout mask by hashing (row, epoch, unit)."""
    with np.errstate(over="ignore"):
        h = ids.astype(np.uint64)[..., None] * np.uint64(0x9E3779B97F4A7C15)
        h = h + np.uint64(epoch * 1_000_003) + np.arange(units, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(29))
    return (h >> np.uint64(11)).astype(np.float64) / 2.0**53 >= rate


def _forward(x: np.ndarray, weights, mask=None):
    """Activations of every layer; the mask acts on the first hidden layer."""
    states, h = [x], x
    for n, (w, b) in enumerate(weights):
        h = h @ w + b
        if n < len(weights) - 1:
            h = np.maximum(h, 0.0)
            if n == 0 and mask is not None:
                h = h * mask
        states.append(h)
    return states


def _gradient(x, y, weights, mask, loss: str, known=None) -> np.ndarray:
    """Gradient of the summed loss; rows that are not `known` do not count."""
    states = _forward(x, weights, mask)
    error = states[-1][..., 0] - y
    delta = (np.sign(error) if loss == "absolute" else 2 * error)[..., None]
    if known is not None:
        delta = np.where(known[..., None], delta, 0.0)
    parts = []
    for n in range(len(weights) - 1, -1, -1):
        w, _ = weights[n]
        own = states[n].swapaxes(-1, -2) @ delta
        parts.append(np.concatenate([own.reshape(*own.shape[:-2], -1), delta.sum(axis=-2)], axis=-1))
        if n:
            delta = (delta @ w.swapaxes(-1, -2)) * (states[n] > 0)
            if n == 1 and mask is not None:
                delta = delta * mask
    return np.concatenate(parts[::-1], axis=-1)


class _Step:
    """Optimiser state of several networks, one a row; each call gives the change of the weights of the first ones."""

    def __init__(self, name: str, rate: float, m: np.ndarray, v: np.ndarray, t: int):
        self.name, self.rate, self.m, self.v, self.t = name, rate, m, v, t

    def __call__(self, g: np.ndarray) -> np.ndarray:
        self.t += 1
        m, v = self.m[: len(g)], self.v[: len(g)]
        if self.name == "sgd":
            return -self.rate * g
        if self.name == "rmsprop":
            v[:] = 0.9 * v + 0.1 * g * g
            return -self.rate * g / (np.sqrt(v) + 1e-7)
        m[:] = 0.9 * m + 0.1 * g
        v[:] = 0.999 * v + 0.001 * g * g
        return -self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-7)


def _whole_parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(x, y, check, mark) of each part; the rows of a part follow each other."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        part, y, mark = (batch.column(c).to_numpy() for c in ("part", "y", "mark"))
        check = batch.column("check").to_numpy(zero_copy_only=False).astype(bool)
        x = np.column_stack([batch.column(f"x{i}").to_numpy() for i in range(width)])
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for start, end in zip(cuts[:-1], cuts[1:]):
            if held and part[start] != last:
                yield tuple(map(np.concatenate, zip(*held)))
                held = []
            held.append(tuple(c[start:end] for c in (x, y, check, mark)))
            last = part[start]
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


@dataclass
class NetworkModel:
    columns: list[str]
    units: Sequence[int]
    flat: np.ndarray
    scale: dict[str, tuple[float, float]]
    target: tuple[float, float]
    history: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        weights = _unpack(self.flat, _sizes(len(self.columns), self.units))
        columns, scale, (mean, sd) = self.columns, self.scale, self.target

        @F.pandas_udf("double")
        def predict(*parts: pd.Series) -> pd.Series:
            x = np.column_stack([(p.to_numpy(float) - scale[c][0]) / scale[c][1] for p, c in zip(parts, columns)])
            return pd.Series(_forward(x, weights)[-1][:, 0] * sd + mean)

        return df.withColumn("prediction", predict(*columns))


@dataclass
class NetworkRegressor:
    """Hidden layers of ReLU units, absolute or squared loss, mini-batches, early stop on a held-out share.

    Inputs and target are standardised with the statistics of the fitted rows. A part holds about `part_rows` rows; tables of one part
    are trained as on one machine.
    """

    columns: Sequence[str]
    label: str = "label"
    keys: Sequence[str] = ("id",)
    units: Sequence[int] = fv.NETWORK_UNITS
    dropout: float = fv.NETWORK_DROPOUT
    loss: str = "absolute"
    optimizer: str = "adam"
    rate: float = 0.001
    epochs: int = 400
    batch: int = 32
    part_rows: int = 50_000
    patience: int = fv.EARLY_STOP_PATIENCE
    held_out: float = 0.2
    seed: int = 0

    def fit(self, df: DataFrame) -> NetworkModel:
        columns = list(self.columns)
        row = df.agg(*[f(c) for c in [*columns, self.label] for f in (F.avg, F.stddev_pop)]).head()
        scale = {c: (row[2 * i], row[2 * i + 1] or 1.0) for i, c in enumerate(columns)}
        target = row[2 * len(columns)], row[2 * len(columns) + 1] or 1.0
        mark = F.xxhash64(F.lit(self.seed), *self.keys)
        inputs = [((F.col(c) - F.lit(m)) / F.lit(s)).cast("double") for c, (m, s) in scale.items()]
        rows = df.na.drop(subset=[*columns, self.label]).select(
            mark.alias("mark"),
            (F.pmod(mark, F.lit(1000)) < int(self.held_out * 1000)).alias("check"),
            ((F.col(self.label) - F.lit(target[0])) / F.lit(target[1])).alias("y"),
            *[e.alias(f"x{i}") for i, e in enumerate(inputs)],
        )
        parts = max(1, -(-rows.count() // self.part_rows))
        at_once = min(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        part = F.pmod(F.xxhash64("mark"), F.lit(parts)).alias("part")
        dealt = rows.select("*", part).repartition(at_once, "part").sortWithinPartitions("part", "mark", "y", *[f"x{i}" for i in range(len(columns))])
        data = stage(dealt, "network")
        sizes = _sizes(len(columns), self.units)
        flat = _initial(sizes, self.seed)
        state, steps = np.concatenate((flat, np.zeros(2 * len(flat)))), 0
        best, best_flat, waited, history = np.inf, flat, 0, []
        for epoch in range(self.epochs + 1):  # the last pass only scores
            sums = self._epoch(data, state, steps, sizes, epoch)
            moved, (n, loss, m, most) = sums[:-4], sums[-4:]
            score = loss / m if m else np.inf
            history.append(float(score))
            if score < best - 1e-12:
                best, best_flat, waited = score, state[: len(flat)].copy(), 0
            else:
                waited += 1
                if waited > self.patience and m:
                    break
            if n and epoch < self.epochs:
                state, steps = moved / n, steps + int(most)
        chosen = best_flat if np.isfinite(best) else state[: len(flat)]
        return NetworkModel(columns, self.units, chosen, scale, target, history)

    def _epoch(self, data: DataFrame, state: np.ndarray, steps: int, sizes, epoch: int) -> np.ndarray:
        """Weights and optimiser state after an epoch, summed over parts by their training rows; these rows; held-out loss of the weights
        before and held-out rows; the steps of the largest part."""
        dropout, loss, width, size = self.dropout, self.loss, len(self.columns), len(state) // 3
        name, rate, batch, seed = self.optimizer, self.rate, self.batch, self.seed

        def train(parts: list[tuple[np.ndarray, ...]]) -> np.ndarray:
            total, weights = np.zeros(len(state) + 4), _unpack(state[:size], sizes)
            orders = []
            for x, y, check, _ in parts:
                if check.any():
                    error = _forward(x[check], weights)[-1][:, 0] - y[check]
                    total[-3] += np.abs(error).sum() if loss == "absolute" else (error**2).sum()
                    total[-2] += check.sum()
                own = np.flatnonzero(~check)
                orders.append(own[np.random.default_rng([seed, epoch]).permutation(len(own))])
            # the longest first, so that those with steps left are always the first ones
            turn = [k for k in sorted(range(len(parts)), key=lambda k: -len(orders[k])) if len(orders[k])]
            if not turn:
                return total
            lengths = np.array([len(orders[k]) for k in turn])
            count = -(-int(lengths[0]) // batch)
            xs, ys, ids = np.zeros((len(turn), count * batch, width)), np.zeros((len(turn), count * batch)), np.zeros((len(turn), count * batch), dtype=np.int64)
            for i, k in enumerate(turn):
                x, y, _, mark = parts[k]
                xs[i, : lengths[i]], ys[i, : lengths[i]], ids[i, : lengths[i]] = x[orders[k]], y[orders[k]], mark[orders[k]]
            flat, m, v = (np.tile(state[k * size : (k + 1) * size], (len(turn), 1)) for k in range(3))
            step = _Step(name, rate, m, v, steps)
            for at in range(0, count * batch, batch):
                live = int((lengths > at).sum())
                n = np.minimum(lengths[:live] - at, batch)
                most = int(n[0])
                rows = (slice(0, live), slice(at, at + most))
                known = None if (n == most).all() else np.arange(most) < n[:, None]
                mask = _keep_mask(ids[rows], sizes[0][1], epoch, dropout) / (1 - dropout) if dropout else None
                flat[:live] += step(_gradient(xs[rows], ys[rows], _unpack(flat[:live], sizes), mask, loss, known) / n[:, None])
            total[:-4] = lengths @ np.concatenate((flat, m, v), axis=1)
            total[-4], total[-1] = lengths.sum(), count
            return total

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, parts = np.zeros(len(state) + 4), _whole_parts(batches, width)
            while group := list(islice(parts, PARTS_AT_ONCE)):
                one = train(group)
                total[:-1] += one[:-1]
                total[-1] = max(total[-1], one[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["i", "g"])

        largest = F.col("i") == len(state) + 3
        sums = data.mapInArrow(run, "i int, g double").groupBy("i").agg(F.when(F.first(largest), F.max("g")).otherwise(F.sum("g")).alias("g"))
        out = np.zeros(len(state) + 4)
        for r in sums.collect():
            out[r["i"]] = r["g"]
        return out
