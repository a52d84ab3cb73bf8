"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of ``STEPS`` bytes. In each window one network reads
forwards and one backwards; from both states every byte position gets a
probability for each language. The probabilities of all positions of a text are
averaged. The networks are trained in numpy by backpropagation through time on a
bounded sample of windows, and applied with many windows side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granero.llm import text as tx

STEPS = 128
HIDDEN = 8
TRAIN_STEPS = 48
TRAIN_DOCUMENTS = 300  # of each language
TRAIN_WINDOWS = 6  # of each document
ROUNDS = 400
BATCH = 96
TOGETHER = 2048  # windows side by side
PAD = 0x20


@dataclass
class Network:
    """One direction: input rows per byte, recurrent weights; the first 2 HIDDEN columns are the update and reset gates."""

    inputs: np.ndarray  # 256 x 3H
    recurrent: np.ndarray  # H x 3H
    bias: np.ndarray  # H, of the candidate's recurrent part


@dataclass
class Model:
    languages: list[str]
    forward: Network
    backward: Network
    output: np.ndarray  # 2H x L
    offset: np.ndarray  # L


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _read(net: Network, steps: np.ndarray) -> tuple[np.ndarray, list]:
    """States after each step (T x B x H) and what backpropagation needs."""
    h = np.zeros((steps.shape[1], len(net.bias)))
    n = len(net.bias)
    states, memory = [], []
    for row in steps:
        gates = net.inputs[row]
        back = h @ net.recurrent
        z = _sigmoid(gates[:, :n] + back[:, :n])
        r = _sigmoid(gates[:, n : 2 * n] + back[:, n : 2 * n])
        inner = back[:, 2 * n :] + net.bias
        c = np.tanh(gates[:, 2 * n :] + r * inner)
        memory.append((h, z, r, inner, c))
        h = c + z * (h - c)
        states.append(h)
    return np.stack(states), memory


def _back(net: Network, steps: np.ndarray, memory: list, upper: np.ndarray) -> Network:
    """Gradients for ``upper``, the gradients of the states."""
    n = len(net.bias)
    d_inputs, d_recurrent, d_bias = np.zeros_like(net.inputs), np.zeros_like(net.recurrent), np.zeros_like(net.bias)
    carried = np.zeros_like(upper[0])
    for t in range(len(steps) - 1, -1, -1):
        h, z, r, inner, c = memory[t]
        dh = upper[t] + carried
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * inner * r * (1 - r)
        d_inner = dc * r
        d_back = np.concatenate([dz, dr, d_inner], axis=1)
        d_gates = np.concatenate([dz, dr, dc], axis=1)
        order = np.argsort(steps[t], kind="stable")
        present, first = np.unique(steps[t][order], return_index=True)
        d_inputs[present] += np.add.reduceat(d_gates[order], first, axis=0)
        d_recurrent += h.T @ d_back
        d_bias += d_inner.sum(axis=0)
        carried = dh * z + d_back @ net.recurrent.T
    return Network(d_inputs, d_recurrent, d_bias)


def loss_and_gradients(model: Model, steps: np.ndarray, wanted: np.ndarray):
    """Mean cross-entropy over all positions of windows (T x B bytes) and its gradients, in the order of ``_parameters``."""
    f_states, f_memory = _read(model.forward, steps)
    b_states, b_memory = _read(model.backward, steps[::-1])
    both = np.concatenate([f_states, b_states[::-1]], axis=2)
    logits = both @ model.output + model.offset
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    t, b, _ = p.shape
    picked = p[:, np.arange(b), wanted]
    loss = -np.log(np.maximum(picked, 1e-12)).mean()
    p[:, np.arange(b), wanted] -= 1
    p /= t * b
    d_both = p @ model.output.T
    h = len(model.forward.bias)
    forward = _back(model.forward, steps, f_memory, d_both[:, :, :h])
    backward = _back(model.backward, steps[::-1], b_memory, d_both[::-1, :, h:])
    d_output = np.einsum("tbh,tbl->hl", both, p)
    return loss, [
        forward.inputs, forward.recurrent, forward.bias, backward.inputs, backward.recurrent, backward.bias,
        d_output, p.sum(axis=(0, 1)),
    ]


def _parameters(model: Model) -> list[np.ndarray]:
    f, b = model.forward, model.backward
    return [f.inputs, f.recurrent, f.bias, b.inputs, b.recurrent, b.bias, model.output, model.offset]


def fresh(languages: list[str], hidden: int = HIDDEN, seed: int = 5) -> Model:
    random = np.random.default_rng(seed)

    def net():
        return Network(random.normal(0, 0.3, (256, 3 * hidden)), random.normal(0, 0.3, (hidden, 3 * hidden)), np.zeros(hidden))

    return Model(languages, net(), net(), random.normal(0, 0.3, (2 * hidden, len(languages))), np.zeros(len(languages)))


def train(windows: np.ndarray, wanted: np.ndarray, languages: list[str], rounds: int = ROUNDS) -> Model:
    """Adam over random batches of windows (N x T bytes) with their language numbers."""
    model = fresh(languages)
    random = np.random.default_rng(11)
    parameters = _parameters(model)
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for i in range(1, rounds + 1):
        pick = random.integers(0, len(windows), BATCH)
        _, gradients = loss_and_gradients(model, windows[pick].T, wanted[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        rate = 0.03 * min(1, i / 20) * (0.5 + 0.5 * np.cos(np.pi * i / rounds)) + 1e-4
        for p, g, m, v in zip(parameters, gradients, first, second, strict=True):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return model


def sample_windows(documents: DataFrame, per_language: int = TRAIN_DOCUMENTS) -> list:
    """(lang, window) of a bounded sample: the ``per_language`` texts of smallest hash, ``TRAIN_WINDOWS`` windows spread over each."""
    usable = documents.where("lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    key = usable.select(F.xxhash64("text").alias("h"), "lang").distinct()
    picked = key.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(
        F.col("nth") <= per_language
    )
    size = 2 * TRAIN_STEPS  # code points, so that as many bytes are there at least
    last = F.greatest(F.length("text") - size, F.lit(0))
    starts = F.transform(F.sequence(F.lit(0), F.lit(TRAIN_WINDOWS - 1)), lambda i: (last * i / (TRAIN_WINDOWS - 1)).cast("int"))
    texts = usable.withColumn("h", F.xxhash64("text")).join(picked.select("h", "lang"), ["h", "lang"])
    cut = texts.select("lang", "h", F.explode(F.array_distinct(starts)).alias("start"), "text")
    rows = cut.select("lang", "h", "start", F.expr(f"substring(text, start + 1, {size})").alias("window")).distinct().collect()
    return sorted((r["lang"], r["h"], r["start"], r["window"]) for r in rows)


def fit(documents: DataFrame, per_language: int = TRAIN_DOCUMENTS, rounds: int = ROUNDS) -> Model | None:
    """A model from documents (text, lang); rows with a null in either, or without a letter, are passed over. None with nothing to learn from."""
    rows = sample_windows(documents, per_language)
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    number = {name: i for i, name in enumerate(languages)}
    windows = np.full((len(rows), TRAIN_STEPS), PAD, np.uint8)
    for i, r in enumerate(rows):
        data = np.frombuffer(r[3].encode()[:TRAIN_STEPS], np.uint8)
        windows[i, : len(data)] = data
    return train(windows, np.array([number[r[0]] for r in rows]), languages, rounds)


class _Reader:
    """The two networks in single precision for many windows at once."""

    def __init__(self, model: Model):
        h = len(model.forward.bias)
        self.h, self.nets = h, []
        for net in (model.forward, model.backward):
            # sigmoid(x) = 0.5 + 0.5 tanh(x / 2): halve the gates' inputs once, here.
            self.nets.append((
                np.ascontiguousarray(net.inputs[:, : 2 * h] / 2, np.float32), np.ascontiguousarray(net.inputs[:, 2 * h :], np.float32),
                np.ascontiguousarray(net.recurrent[:, : 2 * h] / 2, np.float32), np.ascontiguousarray(net.recurrent[:, 2 * h :] / 2, np.float32),
                np.asarray(net.bias / 2, np.float32),
            ))
        self.output = np.asarray(model.output, np.float32)
        self.offset = np.asarray(model.offset, np.float32)

    def _states(self, net, steps: np.ndarray, out: np.ndarray) -> None:
        gate_in, cand_in, gate_back, cand_back, bias = net
        size, h = steps.shape[1], self.h
        state = np.zeros((size, h), np.float32)
        gates, pre = np.empty((size, 2 * h), np.float32), np.empty((size, 2 * h), np.float32)
        inner, cand = np.empty((size, h), np.float32), np.empty((size, h), np.float32)
        for t in range(len(steps)):
            np.take(gate_in, steps[t], axis=0, out=gates, mode="clip")
            np.matmul(state, gate_back, out=pre)
            gates += pre
            np.tanh(gates, out=gates)
            gates += 1
            np.matmul(state, cand_back, out=inner)
            inner += bias
            inner *= gates[:, h:]
            np.take(cand_in, steps[t], axis=0, out=cand, mode="clip")
            cand += inner
            np.tanh(cand, out=cand)
            state -= cand
            state *= gates[:, :h]
            state *= 0.5
            state += cand
            out[t] = state

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """T x B x L probabilities of windows (B x T bytes)."""
        steps = np.ascontiguousarray(windows.T).astype(np.intp)
        t, b = steps.shape
        both = np.empty((t, b, 2 * self.h), np.float32)
        self._states(self.nets[0], steps, both[:, :, : self.h])
        self._states(self.nets[1], steps[::-1], both[::-1, :, self.h :])
        p = (both.reshape(t * b, -1) @ self.output).reshape(t, b, -1)
        p += self.offset
        np.exp(np.minimum(p, 60, out=p), out=p)
        p /= p.sum(axis=2, keepdims=True)
        return p


def _pooled(reader: _Reader, data: np.ndarray, offsets: np.ndarray, labels: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Mean probabilities per document of a run; with ``labels`` the language number of every byte too."""
    sizes = np.diff(offsets)
    n_languages = len(reader.offset)
    counts = -(-sizes // STEPS)
    number, owner = tx.ragged(np.zeros(len(sizes), np.int64), counts)
    starts = offsets[:-1][owner] + number * STEPS
    lengths = np.minimum(STEPS, offsets[1:][owner] - starts)
    sums = np.zeros((len(sizes), n_languages))
    marked = np.zeros(int(offsets[-1] - offsets[0]), np.int8) if labels else None
    steps = np.arange(STEPS)
    for low in range(0, len(starts), TOGETHER):
        s, size, own = starts[low : low + TOGETHER], lengths[low : low + TOGETHER], owner[low : low + TOGETHER]
        inside = steps < size[:, None]
        windows = np.where(inside, data[np.minimum(s[:, None] + steps, len(data) - 1)], PAD)
        p = reader.probabilities(windows)
        if marked is not None:
            marked[(s[:, None] + steps - offsets[0])[inside]] = p.argmax(axis=2).T[inside]
        if not inside.all():
            p *= inside.T[:, :, None]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        sums[own[first]] += np.add.reduceat(p.sum(axis=0), first, axis=0)
    return sums / np.maximum(sizes, 1)[:, None], marked


def predict(documents: DataFrame, model: Model | None, positions: bool = False) -> DataFrame:
    """doc_id, lang_pred, score: one row per row of ``documents`` (doc_id, text).

    ``lang_pred`` is the language with the highest mean probability over all
    bytes (ties: first by name), ``score`` that mean. A text that is null or
    has no letter, and every text without a model, is ``und`` with score 0. With
    ``positions`` a column ``labels`` lists the language of every byte as runs
    (start, end, lang).
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    runs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        reader = _Reader(model) if model else None
        for batch in batches:
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            names, scores, found = [None] * batch.num_rows, np.zeros(batch.num_rows), []
            for low, high, data, offsets in tx.slices(batch.column(1)):
                if reader is None:
                    found += [[] for _ in range(high - low)]
                    continue
                mean, marked = _pooled(reader, data, offsets, positions)
                best = mean.argmax(axis=1)
                scores[low:high] = np.clip(mean[np.arange(high - low), best], 0, 1)
                names[low:high] = [model.languages[b] for b in best]
                if positions:
                    for a, b in zip(offsets[:-1] - offsets[0], offsets[1:] - offsets[0], strict=True):
                        own = marked[a:b]
                        edges = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]]) if len(own) else np.zeros(1, int)
                        found.append([{"start": int(x), "end": int(y), "lang": model.languages[own[x]]} for x, y in zip(edges[:-1], edges[1:], strict=True)])
            known = letters & (reader is not None)
            columns = [batch.column(0), pa.array([n if k else "und" for n, k in zip(names, known, strict=True)], pa.string()), pa.array(np.where(known, scores, 0.0))]
            if positions:
                columns.append(pa.array(found, runs))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "labels"][: len(columns)])

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    )
    schema = "doc_id long, lang_pred string, score double" + ", labels array<struct<start:long,end:long,lang:string>>" * positions
    return rows.mapInArrow(run, schema)
