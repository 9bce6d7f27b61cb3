"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters as the vector of its hashed form, the mean of the vectors of
its hashed character n-grams, and the largest first number of these. Two recurrent
layers read the text forwards and backwards, attention pools the states of a
window of words, and the pooled state gives the window's logit. Every window of
``WINDOW`` words in a row is scored, from each word on, and the text's logit is
the largest.

The windows share their states: a layer reads blocks of ``BLOCK`` words, each
begun ``WINDOW`` words ahead of it, so a word is read about once and not once per
window, and a state knows the ``WINDOW`` words before it at least. Pooling needs
two numbers per word, its attention and the logit of its state, which are
summed over each window.

The network is trained in numpy on the driver, on a bounded sample: at most
``SAMPLE`` labelled rows of each kind, those of least hash, of at most
``LONGEST`` characters. Vectors start with the smoothed log-odds of their
bucket; each round all windows are scored, and the best one of each text and
some of clean texts are learnt from, read with the words before and after them,
with half of the word vectors left out.

Scoring is a map over whole texts without a shuffle. Blocks are read in
parts of fixed size, and the projections of the words met are kept in a table
that is emptied when full and at the end of a partition, so memory
does not grow with the text's windows.

Defined cases: a null or empty text is one window without a word; labels that
are null or belong to no row are not learnt from; without labels of both
kinds every score is the share of ones (0 without any); repeated rows are
scored alike; an empty table gives an empty table; further columns are not
read, and pass through ``clean`` unchanged, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fieldlake.llm.common import col, columns_of, fresh, slices

SAMPLE, LONGEST, ROUNDS, SEED = 1500, 20_000, 14, 3
WINDOW, STRIDE = 24, 16  # words of a window; stride of the clean ones to choose from
BLOCK = 72  # words read by one run of a layer, besides those ahead of it
HIDDEN, WORD_DIM, CHAR_DIM = 8, 6, 6
WORD_BUCKETS, CHAR_BUCKETS = 1 << 17, 1 << 17
_MEMO, _PART, _WORDS = 160_000, 1024, 20_000  # words kept; blocks, words worked on at a time
_EDGE = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}*#$%&<>|«»…"
DIM = WORD_DIM + CHAR_DIM + 1


def word_bucket(word: str) -> int:
    return 1 + zlib.crc32(word.encode()) % (WORD_BUCKETS - 1)


class Grams:
    """The buckets of the character n-grams (n of 3 to 5) of some words; the
    rows of a word stand together, and bucket 0 is no n-gram."""

    def __init__(self, words: list[str]):
        marked = [f"^{w or ' '}$".encode() for w in words]
        size = np.array([len(m) for m in marked])
        end = np.cumsum(size)
        self.first = end - size
        data = np.frombuffer(b"".join(marked) + bytes(4), np.uint8).astype(np.uint32)
        n = int(end[-1]) if len(end) else 0
        left = np.repeat(end, size) - np.arange(n)
        self.buckets = np.zeros((n, 3), np.int32)
        h = (data[:n] * np.uint32(0x01000193) ^ data[1:n + 1]) * np.uint32(0x01000193)
        for k in range(3):
            h = (h ^ data[k + 2:k + 2 + n]) * np.uint32(0x01000193)
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(8)
            self.buckets[:, k] = np.where(left >= k + 3, 1 + mixed % np.uint32(CHAR_BUCKETS - 1), 0)
        self.size = size
        self.count = np.add.reduceat((self.buckets > 0).sum(axis=1), self.first) if len(words) else size

    def vectors(self, table: np.ndarray) -> np.ndarray:
        """Mean of the words' n-gram vectors, and the largest first number."""
        out = np.empty((len(self.first), CHAR_DIM + 1), table.dtype)
        ends = np.append(self.first[1:], len(self.buckets))
        for i in range(0, len(out), _WORDS):  # a bounded part of the rows at a time
            first = self.first[i:i + _WORDS]
            part = self.buckets[first[0]:ends[i:i + _WORDS][-1]]
            total, largest, at = 0, 0, first - first[0]
            for k in range(3):
                rows = table[part[:, k]]
                total = total + np.add.reduceat(rows, at)
                largest = np.maximum(largest, np.maximum.reduceat(rows[:, 0], at))
            out[i:i + _WORDS, :-1] = total / self.count[i:i + _WORDS, None]
            out[i:i + _WORDS, -1] = largest
        return out

    def add(self, table: np.ndarray, change: np.ndarray) -> None:
        """Add to the vectors a share of the change of their words' mean."""
        each = np.repeat(change / self.count[:, None], self.size, axis=0)
        for k in range(3):
            np.add.at(table, self.buckets[:, k], each)
        table[0] = 0


def normal(word: str) -> str:
    return word.strip(_EDGE).lower()


def windows(n: int, stride: int = STRIDE) -> np.ndarray:
    """Starts of the windows of a text of n words."""
    return np.arange(0, max(1, n - WINDOW + stride), stride)


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        g = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.p = {"word": rng.normal(0, 0.05, (WORD_BUCKETS, WORD_DIM)),
                  "char": rng.normal(0, 0.05, (CHAR_BUCKETS, CHAR_DIM)),
                  "att": g(2 * HIDDEN, 1)[:, 0], "out": g(2 * HIDDEN, 1)[:, 0], "bias": np.zeros(1)}
        for d in "fb":
            self.p |= {f"x{d}": g(DIM, 3 * HIDDEN), f"u{d}": g(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN)}
        self.p["word"][0] = self.p["char"][0] = 0
        self.constant = None

    def vectors(self, word: np.ndarray, chars: Grams) -> np.ndarray:
        return np.hstack([self.p["word"][word], chars.vectors(self.p["char"])])

    def states(self, x: np.ndarray, d: str, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """x: (steps, runs, 3 * HIDDEN) projected inputs, in reading order; a
        step without a word (``mask``) leaves the state as it is."""
        u, h = self.p[f"u{d}"].astype(x.dtype), np.zeros((x.shape[1], HIDDEN), x.dtype)
        out = np.empty((x.shape[0], x.shape[1], HIDDEN), x.dtype)
        a, b = HIDDEN, 2 * HIDDEN
        for t in range(x.shape[0]):
            hu = h @ u
            zr = hu[:, :b] + x[t, :, :b]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            z, r, hc = zr[:, :a], zr[:, a:], hu[:, b:]
            z *= mask[t][:, None]
            c = r * hc
            c += x[t, :, b:]
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((h, z, r, c, hc))
            h = h + z * (c - h)
            out[t] = h
        return out

    def both_ways(self, fwd: np.ndarray, bwd: np.ndarray, mask: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """(steps, runs, 2 * HIDDEN): the states of some words that ``WINDOW``
        more go before and after; fwd are the inputs without the words after
        them, bwd those without the words before, and mask is of all."""
        kept = kept or {"f": None, "b": None}
        hf = self.states(fwd, "f", mask[:-WINDOW], kept["f"])[WINDOW:]
        hb = self.states(bwd[::-1], "b", mask[WINDOW:][::-1], kept["b"])[WINDOW:][::-1]
        return np.concatenate([hf, hb], axis=2)

    def pool(self, both: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """both: (steps, windows, 2 * HIDDEN); mask: which steps have a word."""
        e = np.where(mask, both @ self.p["att"].astype(both.dtype), -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = (w[:, :, None] * both).sum(axis=0)
        return pooled @ self.p["out"].astype(both.dtype) + both.dtype.type(self.p["bias"][0]), w, pooled

    def learn(self, word: np.ndarray, chars: Grams, index: np.ndarray, mask: np.ndarray, y: np.ndarray,
              rate: float, memory: dict) -> None:
        """One step on windows: index (3 * WINDOW steps, windows) into the words
        given by their bucket (0: without its word vector) and their n-grams;
        the middle steps are the window, mask says which steps have a word."""
        p = self.p
        vec = self.vectors(word, chars)
        x = vec[index]
        fore, aft, own = slice(0, 2 * WINDOW), slice(WINDOW, 3 * WINDOW), slice(WINDOW, 2 * WINDOW)
        kept: dict[str, list] = {"f": [], "b": []}
        both = self.both_ways(x[fore] @ p["xf"] + p["cf"], x[aft] @ p["xb"] + p["cb"], mask, kept)
        z, w, pooled = self.pool(both, mask[own])
        g = (_sigmoid(z) - y) / len(y)
        grad = {"out": pooled.T @ g, "bias": np.array([g.sum()])}
        d_pool = g[:, None] * p["out"]
        d_w = (both * d_pool).sum(axis=2)
        d_e = w * (d_w - (w * d_w).sum(axis=0))
        grad["att"] = np.einsum("tbh,tb->h", both, d_e)
        d_both = w[:, :, None] * d_pool + d_e[:, :, None] * p["att"]
        d_x, ahead = np.zeros_like(x), np.zeros((WINDOW, len(y), HIDDEN))
        for d, part, span in (("f", d_both[:, :, :HIDDEN], fore), ("b", d_both[::-1, :, HIDDEN:], aft)):
            seq = x[span] if d == "f" else x[span][::-1]
            d_in, grad[f"u{d}"] = self._back(d, np.concatenate([ahead, part]), kept[d])
            grad[f"x{d}"] = np.einsum("tbi,tbj->ij", seq, d_in)
            grad[f"c{d}"] = d_in.sum(axis=(0, 1))
            change = d_in @ p[f"x{d}"].T
            d_x[span] += change if d == "f" else change[::-1]
        d_vec = np.zeros_like(vec)
        np.add.at(d_vec, index.ravel(), d_x.reshape(-1, DIM))
        for k, v in grad.items():
            m, s, n = memory.setdefault(k, (np.zeros_like(v), np.zeros_like(v), 0))
            m, s, n = 0.9 * m + 0.1 * v, 0.99 * s + 0.01 * v * v, n + 1
            memory[k] = (m, s, n)
            p[k] -= rate * (m / (1 - 0.9 ** n)) / (np.sqrt(s / (1 - 0.99 ** n)) + 1e-8)
        np.add.at(p["word"], word, -5 * rate * d_vec[:, :WORD_DIM])
        chars.add(p["char"], -5 * rate * d_vec[:, WORD_DIM:-1])
        p["word"][0] = 0

    def _back(self, d: str, d_out: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
        u, after = self.p[f"u{d}"], np.zeros(d_out.shape[1:])
        d_in, d_u = np.empty((*d_out.shape[:2], 3 * HIDDEN)), np.zeros_like(u)
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, c, hc = kept[t]
            dh = d_out[t] + after
            dc = dh * z * (1 - c * c)
            dz = dh * (c - h) * z * (1 - z)
            dr = dc * hc * r * (1 - r)
            d_in[t] = np.hstack([dz, dr, dc])
            d_hu = np.hstack([dz, dr, dc * r])
            d_u += h.T @ d_hu
            after = dh * (1 - z) + d_hu @ u.T
        return d_in, d_u


class Scorer:
    """A network with the projections of the words it has met."""

    def __init__(self, net: Network):
        self.net = net
        p = net.p
        self.x = np.hstack([p["xf"], p["xb"]])
        self.c = np.concatenate([p["cf"], p["cb"]])
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.empty((1024, 6 * HIDDEN), np.float32)
        self.rows[0] = self.c
        self.used = 1  # place 0 is no word

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.place]
        forms = [normal(w) for w in new]
        while self.used + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        vec = self.net.vectors(np.array([word_bucket(w) if w else 0 for w in forms]), Grams(forms))
        self.rows[self.used:self.used + len(new)] = vec @ self.x + self.c
        self.place.update(zip(new, range(self.used, self.used + len(new)), strict=True))
        self.used += len(new)

    def logits(self, texts: list[str]) -> np.ndarray:
        """The largest logit of each text's windows."""
        if self.used > _MEMO:
            self.clear()
        lists = []
        for text in texts:
            words = text.split()
            try:
                ids = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            except KeyError:
                self._learn(set(words))
                ids = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            lists.append(ids)
        return best_windows(self.net, self.rows, lists)[0]


def laid_out(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts in one array, each text in whole blocks and with
    ``WINDOW`` places without a word (0) before and after it; where the blocks
    start, and where the texts do."""
    gap = np.zeros(WINDOW, np.int64)
    flat, blocks, first, at = [gap], [np.zeros(0, np.int64)], [], WINDOW
    for ids in lists:
        room = -len(ids) % BLOCK
        blocks.append(np.arange(at, at + len(ids), BLOCK))
        first.append(at)
        flat += [ids, np.zeros(room, np.int64), gap]
        at += len(ids) + room + WINDOW
    flat.append(gap)
    return np.concatenate(flat), np.concatenate(blocks), np.array(first, np.int64)


def word_scores(net: Network, rows: np.ndarray, flat: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Attention and logit of the state at every place; ``rows`` are the
    projections of the words for both directions."""
    att, out = (net.p[k].astype(np.float32) for k in ("att", "out"))
    weight, value = np.zeros(len(flat)), np.zeros(len(flat))
    half = 3 * HIDDEN
    for i in range(0, len(blocks), _PART):
        place = blocks[i:i + _PART][None, :] + np.arange(-WINDOW, BLOCK + WINDOW)[:, None]
        index = flat[place]
        x = rows[index]
        both = net.both_ways(x[:-WINDOW, :, :half], x[WINDOW:, :, half:], (index > 0).astype(np.float32))
        own = place[WINDOW:-WINDOW]
        weight[own], value[own] = both @ att, both @ out
    return weight, value


def best_windows(net: Network, rows: np.ndarray, lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the largest logit among all its windows, and the word at
    which that window starts. A text of fewer words is one window."""
    flat, blocks, first = laid_out(lists)
    weight, value = word_scores(net, rows, flat, blocks)
    best, start = np.full(len(lists), float(net.p["bias"][0])), np.zeros(len(lists), np.int64)
    for k, (s, ids) in enumerate(zip(first.tolist(), lists, strict=True)):
        if len(ids):
            w, v, n = weight[s:s + len(ids)], value[s:s + len(ids)], min(WINDOW, len(ids))
            w = np.exp(w - w.max())
            top, all_ = (np.lib.stride_tricks.sliding_window_view(x, n).sum(axis=1) for x in (w * v, w))
            z = top / all_
            start[k] = z.argmax()
            best[k] += z[start[k]]
    return best, start


def _log_odds(net: Network, texts: Iterable[list[str]], again: Iterable[list[str]], y: np.ndarray) -> None:
    """texts, and again: the words of each text. The first number of each vector starts as its bucket's log-odds."""
    n = np.bincount(y.astype(int), minlength=2)
    for table, each, buckets in (("word", texts, lambda t: [word_bucket(w) for w in t]),
                                 ("char", again, lambda t: Grams(t).buckets)):
        seen = np.zeros((2, len(net.p[table])))
        for words, label in zip(each, y, strict=True):
            if words:
                seen[int(label), np.unique(buckets(words))] += 1
        odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
        net.p[table][:, 0] = odds * np.minimum(1, seen.sum(axis=0) / 10) / 3
        net.p[table][0] = 0


def train(texts: list[str], y: np.ndarray, rounds: int = ROUNDS, seed: int = SEED) -> Network:
    net, rng = Network(seed), np.random.default_rng(seed)
    if len(set(y.tolist())) < 2:
        net.constant = float(y.mean()) if len(y) else 0.0
        return net
    names: dict[str, int] = {"": 0}
    ids = [np.array([names.setdefault(normal(w), len(names)) for w in t.split()], np.int32) for t in texts]
    vocabulary = list(names)
    _log_odds(net, *(([vocabulary[i] for i in np.unique(x)] for x in ids) for _ in range(2)), y)
    words = np.array([word_bucket(w) if w else 0 for w in vocabulary])
    chars = Grams(vocabulary)
    lists = [x.astype(np.int64) for x in ids]
    flat, _, first = laid_out(lists)
    clean = np.concatenate([[0], *(first[k] + windows(len(x)) for k, x in enumerate(lists) if not y[k])])[1:]
    around = np.arange(-WINDOW, 2 * WINDOW)[:, None]
    memory: dict = {}
    for turn in range(rounds):
        p = net.p
        vec = net.vectors(words, chars).astype(np.float32)
        rows = np.hstack([vec @ p["xf"] + p["cf"], vec @ p["xb"] + p["cb"]]).astype(np.float32)
        spare = rng.permutation(clean)[:len(texts) // 2]
        starts = np.concatenate([first + best_windows(net, rows, lists)[1], spare])
        label = np.concatenate([y, np.zeros(len(spare))])
        for part in np.array_split(rng.permutation(len(starts)), max(1, len(texts) // 48)):
            index = flat[starts[None, part] + around]
            used, local = np.unique(index, return_inverse=True)
            known = np.where(rng.random(len(used)) < 0.5, words[used], 0)  # so that characters count too
            net.learn(known, Grams([vocabulary[i] for i in used]), local.reshape(index.shape), index > 0,
                      label[part], 0.02 if turn < rounds - 3 else 0.005, memory)
    return net


def trained(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "toxic", most: int = SAMPLE, longest: int = LONGEST) -> Network:
    """learn: which ids may be learnt from, as a condition on the id column."""
    known = (labels.where(learn(col(id_col)) & col(label_col).isin(0, 1)).groupBy(col(id_col).alias("i"))
             .agg(F.max(col(label_col)).cast("int").alias("y")))
    parts = [known.where(F.col("y") == k).orderBy(F.xxhash64("i"), "i").limit(2 * most) for k in (0, 1)]
    rows = docs.where(F.coalesce(F.char_length(col(text_col)), F.lit(0)) <= longest).select(
        col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    met = rows.join(parts[0].unionByName(parts[1]), F.col("id") == F.col("i"))
    got = [r for k in (0, 1) for r in met.where(F.col("y") == k).orderBy(F.xxhash64("id"), "id", "text").limit(most).collect()]
    return train([r["text"] for r in got], np.array([r["y"] for r in got], float))


_scorers: dict[int, tuple[Network, Scorer]] = {}


def _score(net: Network, texts: list[str]) -> np.ndarray:
    if net.constant is not None:
        return np.full(len(texts), net.constant)
    held = _scorers.get(0)
    if held is None or held[0] is not net:
        held = _scorers[0] = (net, Scorer(net))
    return _sigmoid(held[1].logits(texts)) if texts else np.zeros(0)


def scored(docs: DataFrame, net: Network, text_col: str = "text", score_col: str = "score") -> tuple[DataFrame, str]:
    """``docs`` with the chance that the text is toxic, and that column's name."""
    (name,) = fresh(docs, score_col)
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, at, 1 << 20):
                texts = [x.as_py() or "" for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_score(shared.value, texts), pa.float64())],
                                                 [*part.schema.names, name])
        _scorers.clear()  # an idle worker keeps nothing

    return docs.select(*columns_of(docs)).mapInArrow(run, schema), name


def clean(docs: DataFrame, net: Network, text_col: str = "text", most: float = 0.7) -> DataFrame:
    """``docs`` without the rows that score ``most`` or more."""
    rows, name = scored(docs, net, text_col)
    return rows.where(F.col(name) < most).select(*columns_of(docs))
