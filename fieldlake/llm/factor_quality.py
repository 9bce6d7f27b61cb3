"""Quality classifier: a factorisation machine.

Inputs are hashed words (a word weighs one over the number of words, as often
as it occurs), statistics of the text's structure, and the length in the
row's metadata. Pairs of inputs interact through vectors of ``FACTORS``
numbers, summed in linear time: half of (square of the sum minus sum of the
squares).

The machine is fitted in numpy on the driver on a bounded sample: at most
``SAMPLE`` labelled rows, those of least hash, as bags of at most ``BUCKETS``
counts each. Scoring is a map over whole texts without a shuffle; the fitted
machine is a table of fixed size.

Defined cases: a null text is an empty one, which gets the score of its
statistics; a null length counts as 0; labels that are null, or belong to no
row, are not learnt from; without labels of both kinds every score is the
share of ones (one half without any); repeated rows are scored alike; an
empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldlake.llm.common import col

SAMPLE, BUCKETS, FACTORS, EPOCHS = 4000, 1 << 14, 8, 12
STATS = 16
_MEMO = 200_000
_PART = 1 << 16  # words looked up at a time


class _Buckets(dict):
    """The bucket of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        self[word] = n = zlib.crc32(word.lower()) % BUCKETS
        return n


_bucket = _Buckets()


def statistics(data: bytes, words: list[bytes], length: float) -> np.ndarray:
    """Numbers that describe the shape of a text; the last is metadata."""
    n, m = max(1, len(data)), max(1, len(words))
    c = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, int)
    upper, lower, digits = c[65:91].sum(), c[97:123].sum(), c[48:58].sum()
    lines = [x for x in data.split(b"\n") if x.strip()]
    ended = sum(1 for x in lines if x.rstrip()[-1:] in b".!?:;\"')")
    marks = sum(int(c[ord(x)]) for x in "#*$%&<>")
    return np.array([
        np.log1p(len(words)), n / m, upper / max(1, upper + lower), digits / n, marks / n, c[ord("|")] / m,
        c[ord("!")] / m, (c[ord(".")] + c[ord(",")]) / m, c[128:].sum() / n, len(set(words)) / m,
        sum(map(eq, words, words[1:])) / m, len(lines) / m, ended / max(1, len(lines)),
        sum(map(len, lines)) / max(1, len(lines)) / 100, (len(data) == 0) * 1.0, np.log1p(max(0.0, length))])


def _length(x) -> float:
    return float(x) if x is not None else 0.0


def _bags(batches):
    """Bags of words of the sampled rows."""
    for batch in batches:
        at, count, stats, n = [], [], [], []
        for text, length in zip(batch.column(0), batch.column(1), strict=True):
            data = (text.as_py() or "").encode()
            words = data.split()
            k, c = np.unique(np.fromiter(map(_bucket.__getitem__, words), np.int64, len(words)), return_counts=True)
            at.append(k.astype(np.int32))
            count.append(c.astype(np.float32))
            stats.append(statistics(data, words, _length(length.as_py())))
            n.append(len(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), pa.array(at, pa.list_(pa.int32())), pa.array(count, pa.list_(pa.float32())),
             pa.array(stats, pa.list_(pa.float64())), pa.array(n, pa.int64())], ["y", "at", "count", "stats", "n"])


class Machine:
    """w0 + sum w x + 1/2 sum over factors of (sum v x)^2 - sum (v x)^2."""

    def __init__(self, bias: float, table: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.bias, self.mean, self.scale = bias, mean, scale
        self.set(table)

    def set(self, table: np.ndarray) -> None:
        """table: a row for each input: its weight, then its vector."""
        self.table = table
        v = table[:, 1:]
        self.words = np.hstack([table, (v * v).sum(axis=1, keepdims=True)])[:BUCKETS].astype(np.float32)

    def logit(self, words: list[bytes], stats: np.ndarray) -> float:
        x = np.clip((stats - self.mean) / self.scale, -4, 4)
        own = self.table[BUCKETS:]
        line, total = x @ own[:, 0], x @ own[:, 1:]
        squares = float(((x[:, None] * own[:, 1:]) ** 2).sum())
        n = len(words)
        for i in range(0, n, _PART):
            part = words[i:i + _PART]
            got = self.words[np.fromiter(map(_bucket.__getitem__, part), np.int64, len(part))].sum(axis=0, dtype=float)
            line += got[0] / n
            total = total + got[1:-1] / n
            squares += got[-1] / n / n
        return float(self.bias + line + 0.5 * (total @ total - squares))


def fit(sample: list, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 5) -> Machine:
    """Rows of (y, at, count, stats, n), fitted by Adam on the log loss."""
    y = np.array([r["y"] for r in sample], float)
    share = float(y.mean()) if len(y) else 0.5
    rng = np.random.default_rng(seed)
    size = BUCKETS + STATS
    if len(set(y.tolist())) < 2:
        share = min(max(share, 0.01), 0.99)
        return Machine(float(np.log(share / (1 - share))), np.zeros((size, 1 + factors)), np.zeros(STATS), np.ones(STATS))
    stats = np.array([r["stats"] for r in sample])
    mean, scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    x = np.clip((stats - mean) / scale, -4, 4)
    table = np.hstack([np.zeros((size, 1)), rng.normal(0, 0.1, (size, factors))])
    bias, m, s, step = np.log(share / (1 - share)), np.zeros_like(table), np.zeros_like(table), 0
    bags = [(np.array(r["at"], np.int64), np.array(r["count"], float) / max(1, r["n"]),
             np.array(r["count"], float) / max(1, r["n"]) ** 2) for r in sample]
    place = np.arange(BUCKETS, size)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            grad = np.zeros_like(table)
            for i in rows:
                at, one, two = bags[i]
                at, one, two = np.append(at, place), np.append(one, x[i]), np.append(two, x[i] ** 2)
                t = table[at]
                total = one @ t[:, 1:]
                z = bias + one @ t[:, 0] + 0.5 * (total @ total - (two @ (t[:, 1:] ** 2)).sum())
                g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) / len(rows)
                bias -= 0.02 * g
                grad[at, 0] += g * one  # at holds no place twice
                grad[at, 1:] += g * (one[:, None] * total - two[:, None] * t[:, 1:])
            step += 1
            m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad ** 2
            table -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6) + 1e-5 * table
    return Machine(float(bias), table, mean, scale)


def sampled(docs: DataFrame, labels: DataFrame, learn, id_col: str, text_col: str, label_col: str,
            length_col: str | None, most: int) -> DataFrame:
    """(text, length, y) of the labelled rows that may be learnt from."""
    length = col(length_col).cast("double") if length_col else F.char_length(col(text_col)).cast("double")
    y = (labels.where(learn(col(id_col)) & col(label_col).isin(0, 1)).groupBy(col(id_col).alias("i"))
         .agg(F.max(col(label_col)).cast("int").alias("y"))
         .orderBy(F.xxhash64("i"), "i").limit(most))
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text"), length.alias("length"))
    return rows.join(y, F.col("id") == F.col("i")).select("text", "length", "y")


def fitted(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", length_col: str | None = None, most: int = SAMPLE) -> Machine:
    rows = sampled(docs, labels, learn, id_col, text_col, label_col, length_col, most)
    bags = rows.mapInArrow(_bags, "y int, at array<int>, count array<float>, stats array<double>, n long")
    return fit(sorted(bags.limit(2 * most).collect(), key=lambda r: (r["n"], r["y"], r["stats"], r["at"])))


def scored(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text",
           length_col: str | None = None) -> DataFrame:
    """(id, score): the chance that the label is 1."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    length = col(length_col).cast("double") if length_col else F.char_length(col(text_col)).cast("double")

    def run(batches):
        m = shared.value
        for batch in batches:
            out = []
            for text, n in zip(batch.column(1), batch.column(2), strict=True):
                data = (text.as_py() or "").encode()
                words = data.split()
                z = m.logit(words, statistics(data, words, _length(n.as_py())))
                out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(col(id_col), col(text_col), length).mapInArrow(run, f"`{id_col}` {kind}, score double")
