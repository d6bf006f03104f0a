"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is cut into all overlapping windows of ``WINDOW`` words, ``STRIDE``
apart; a document's score is the calibrated score of its most toxic window.  A
word's input joins a word part and a character part: the log odds of the word
among labelled documents, the largest and the mean log odds of its character
n-grams, and hashed embeddings of both.  Two gated recurrent layers read a
window in both directions, attention pools their states, and a logistic unit
scores the pool.  Everything is trained in numpy on the driver from a bounded
sample of labelled documents (``SAMPLE`` per class, in order of a hash of the
id); only a whole document has a label, so each toxic one teaches by its most
suspect window, chosen anew by the network after every round.  Log odds for
training come from the other half of the sample, so that a rare word doesn't
give its own document away.

Scoring reads whole texts in the tasks; the input projections are computed once
per distinct word of a block, and all windows advance together word by word.

Rows: one result row per row of the documents; empty and null texts, and texts
without a word, get the score of an empty window.  Labels that are null, or of
held-out or unknown documents, are not used; of repeated labels of a document the
largest counts.  A null id stays null and is not held out.  Without any label of
either class the score is the share of toxic labels (0 without labels).  An empty table
gives an empty result.  Only the columns named by the parameters are read, so other
columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import ship_package
from tidemark.llm.textblocks import ALNUM, blocks, hashes, mix, raw, strings, words

WINDOW, STRIDE = 32, 16
#: Labelled documents per class to learn from, and windows of a clean document.
SAMPLE, CLEAN_WINDOWS = 1500, 6
#: The longest text to learn from: with SAMPLE, the bound of what the driver holds.
TRAIN_BYTES = 1 << 18
BUCKET_BITS, EMBEDDED, HIDDEN = 18, 4, 8
GRAMS = (4, 5)
ROUNDS, STEPS, BATCH, RATE = 3, 150, 64, 0.01
FOLDS = 5
#: Documents' worth of the overall share in the share of a word.
DRAWN = 3.0
_BUCKETS = 1 << BUCKET_BITS
_WINDOWS = 2048


def _buckets(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def character_grams(distinct: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of all character n-grams of the bounded words ``<word>``."""
    if not len(distinct):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    offsets, data = raw(strings(pc.binary_join_element_wise("<", distinct, ">", "")))
    found, owner = [], []
    word = np.repeat(np.arange(len(distinct)), np.diff(offsets))
    for size in GRAMS:
        n = len(data) - size + 1
        if n <= 0:
            continue
        key = np.full(n, size, np.uint64)
        for k in range(size):
            key = key << np.uint64(8) | data[k:k + n].astype(np.uint64)
        inside = word[:n] == word[size - 1:]
        found.append(_buckets(mix(key[inside])))
        owner.append(word[:n][inside])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owner)


class Features:
    """Word inputs from log odds learned on labelled documents."""

    def __init__(self, documents: list[np.ndarray], distinct: pa.StringArray, toxic: np.ndarray):
        """documents: the word numbers (in ``distinct``) of each labelled document."""
        grams, owner = character_grams(distinct)
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
        begin = np.searchsorted(owner, np.arange(len(distinct) + 1))
        word = _buckets(hashes(distinct))
        count = np.zeros((2, 2, _BUCKETS), np.float32)  # word or gram, class, bucket
        for own, label in zip(documents, toxic.astype(int)):
            used = np.unique(own)
            count[0, label][np.unique(word[used])] += 1
            if len(used):
                count[1, label][np.unique(np.concatenate([grams[begin[u]:begin[u + 1]] for u in used.tolist()]))] += 1
        # the share of toxic documents among those with the word, drawn to the overall share
        share = np.clip(toxic.mean(), 0.02, 0.98)
        rate = [(count[k, 1] + DRAWN * share) / (count[k].sum(axis=0) + DRAWN) for k in range(2)]
        self.word, self.gram = ((np.log(r / (1 - r)) - np.log(share / (1 - share))).astype(np.float32) / 2
                                for r in rate)

    def of(self, distinct: pa.StringArray) -> np.ndarray:
        """One row of inputs per word."""
        key = hashes(distinct)
        grams, owner = character_grams(distinct)
        out = np.zeros((len(distinct), 3 + 2 * EMBEDDED), np.float32)
        if not len(distinct):
            return out
        out[:, 0] = self.word[_buckets(key)]
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
        present, start = np.unique(owner, return_index=True)
        if len(present):
            n = np.diff(np.append(start, len(owner))).astype(np.float32)
            value = self.gram[grams]
            out[present, 1] = np.maximum.reduceat(value, start)
            out[present, 2] = np.add.reduceat(value, start) / n
            out[present, 3 + EMBEDDED:] = np.add.reduceat(_embedding(1)[grams], start, axis=0) / n[:, None]
        out[:, 3:3 + EMBEDDED] = _embedding(0)[_buckets(key)]
        return out


_EMBEDDINGS: dict[int, np.ndarray] = {}


def _embedding(kind: int) -> np.ndarray:
    """Fixed hashed embeddings: the network's input layer weighs them."""
    if kind not in _EMBEDDINGS:
        _EMBEDDINGS[kind] = np.random.default_rng(kind).normal(0, 0.3, (_BUCKETS, EMBEDDED)).astype(np.float32)
    return _EMBEDDINGS[kind]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Two gated recurrent layers in opposite directions, attention, a logistic unit."""

    def __init__(self, inputs: int, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        init = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.p = {"v": init(2 * hidden), "w": init(2 * hidden), "c": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {"W" + d: init(inputs, 3 * hidden), "U" + d: init(hidden, 3 * hidden),
                       "b" + d: np.zeros(3 * hidden, np.float32)}
        self.hidden = hidden

    def projections(self, features: np.ndarray) -> dict[str, np.ndarray]:
        """The inputs of the gates for each distinct word; the last row is for padding."""
        padded = np.vstack([features, np.zeros((1, features.shape[1]), np.float32)])
        return {d: padded @ self.p["W" + d] + self.p["b" + d] for d in "fb"}

    def _layer(self, gates, index, mask, direction, keep=None):
        """States (time, window, hidden) of one direction."""
        H, U = self.hidden, self.p["U" + direction]
        windows, steps = index.shape
        states = np.empty((steps, windows, H), np.float32)
        h = np.zeros((windows, H), np.float32)
        whole = mask.all()
        for t in range(steps) if direction == "f" else range(steps - 1, -1, -1):
            x = gates[index[:, t]]
            a = h @ U
            zr = _sigmoid(x[:, :2 * H] + a[:, :2 * H])
            z, r = zr[:, :H], zr[:, H:]
            n = np.tanh(x[:, 2 * H:] + r * a[:, 2 * H:])
            new = n + z * (h - n)
            if not whole:
                m = mask[:, t:t + 1]
                new = np.where(m, new, h)
            if keep is not None:
                keep[t] = (h, z, r, n, a[:, 2 * H:])
            h = states[t] = new
        return states

    def score(self, gates, index, mask):
        """The logit of each window, without keeping what training needs."""
        H, (windows, steps) = self.hidden, index.shape
        states = np.empty((steps, windows, 2 * H), np.float32)
        turned, whole = np.ascontiguousarray(index.T), mask.all()
        for d, part in (("f", slice(0, H)), ("b", slice(H, 2 * H))):
            open_, new_ = gates[d]
            U = self.p["U" + d]
            U_open, U_new = np.ascontiguousarray(U[:, :2 * H]) / 2, np.ascontiguousarray(U[:, 2 * H:])
            h = np.zeros((windows, H), np.float32)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                zr = h @ U_open
                zr += open_.take(turned[t], axis=0)
                np.tanh(zr, out=zr)
                zr *= 0.5
                zr += 0.5
                n = h @ U_new
                n *= zr[:, H:]
                n += new_.take(turned[t], axis=0)
                np.tanh(n, out=n)
                step = h - n
                step *= zr[:, :H]
                step += n
                h = step if whole else np.where(mask[:, t:t + 1], step, h)
                states[t, :, part] = h
        score = states @ self.p["v"]
        score[~mask.T] = -1e9
        weight = np.exp(score - score.max(axis=0))
        weight *= mask.T
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        return (weight * (states @ self.p["w"])).sum(axis=0) + self.p["c"][0]

    def tables(self, features: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """For each direction the inputs (halved) of the two opening gates and of the new state."""
        H = self.hidden
        return {d: (np.ascontiguousarray(x[:, :2 * H]) / 2, np.ascontiguousarray(x[:, 2 * H:]))
                for d, x in self.projections(features).items()}

    def forward(self, gates, index, mask, keep=None):
        """The logit of each window."""
        kept = {"f": {}, "b": {}} if keep is not None else {"f": None, "b": None}
        states = np.concatenate([self._layer(gates[d], index, mask, d, kept[d]) for d in "fb"], axis=2)
        score = np.where(mask.T, states @ self.p["v"], -1e9)
        weight = np.exp(score - score.max(axis=0)) * mask.T
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pool = np.einsum("tw,twh->wh", weight, states)
        if keep is not None:
            keep |= {"kept": kept, "states": states, "weight": weight, "pool": pool}
        return pool @ self.p["w"] + self.p["c"][0]

    def gradients(self, features, index, mask, target):
        """(loss, gradients of the parameters) of the mean logistic loss."""
        H, keep = self.hidden, {}
        logit = self.forward(self.projections(features), index, mask, keep)
        q = _sigmoid(logit)
        loss = float(np.mean(np.logaddexp(0, logit) - target * logit))
        d_logit = ((q - target) / len(target)).astype(np.float32)
        g = {"c": np.array([d_logit.sum()]), "w": keep["pool"].T @ d_logit}
        d_pool = d_logit[:, None] * self.p["w"]
        states, weight = keep["states"], keep["weight"]
        d_weight = np.einsum("wh,twh->tw", d_pool, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["v"] = np.einsum("tw,twh->h", d_score, states)
        d_states = weight[:, :, None] * d_pool + d_score[:, :, None] * self.p["v"]
        padded = np.vstack([features, np.zeros((1, features.shape[1]), np.float32)])
        steps = index.shape[1]
        for d, part in (("f", slice(0, H)), ("b", slice(H, 2 * H))):
            U = self.p["U" + d]
            gU, gW, gb = np.zeros_like(U), np.zeros_like(self.p["W" + d]), np.zeros_like(self.p["b" + d])
            carry = np.zeros((len(index), H), np.float32)
            for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
                h, z, r, n, a_n = keep["kept"][d][t]
                m = mask[:, t:t + 1]
                dh = d_states[t, :, part] + carry
                dn = np.where(m, dh * (1 - z), 0) * (1 - n * n)
                dz = np.where(m, dh * (h - n), 0) * z * (1 - z)
                dr = dn * a_n * r * (1 - r)
                d_x = np.concatenate([dz, dr, dn], axis=1)
                d_a = np.concatenate([dz, dr, dn * r], axis=1)
                gU += h.T @ d_a
                gW += padded[index[:, t]].T @ d_x
                gb += d_x.sum(axis=0)
                carry = np.where(m, dh * z, dh) + d_a @ U.T
            g |= {"U" + d: gU, "W" + d: gW, "b" + d: gb}
        return loss, g


def windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, document) of all windows; every document has one at least."""
    counts = np.diff(offsets)
    per = np.maximum(1, -(-np.maximum(counts - WINDOW, 0) // STRIDE) + 1)
    document = np.repeat(np.arange(len(counts)), per)
    number = np.arange(len(document)) - np.repeat(np.cumsum(per) - per, per)
    return offsets[:-1][document] + number * STRIDE, document


def _indices(numbers, starts, ends, padding):
    """(word numbers, mask) of windows that begin at ``starts`` in texts that end at ``ends``."""
    at = starts[:, None] + np.arange(WINDOW)
    mask = at < ends[:, None]
    if not len(numbers):
        return np.full(at.shape, padding), mask
    return np.where(mask, numbers[np.minimum(at, len(numbers) - 1)], padding), mask


def _encoded(texts: pa.StringArray):
    flat, offsets = words(texts, ALNUM)
    encoded = flat.dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary, offsets


def document_logits(network: Network, features: Features, texts: pa.StringArray) -> np.ndarray:
    """The largest logit of all windows of each text."""
    numbers, distinct, offsets = _encoded(texts)
    gates = network.tables(features.of(distinct))
    starts, document = windows(offsets)
    logits = np.empty(len(starts), np.float32)
    ends = offsets[1:][document]
    for first in range(0, len(starts), _WINDOWS):
        part = slice(first, first + _WINDOWS)
        index, mask = _indices(numbers, starts[part], ends[part], len(distinct))
        logits[part] = network.score(gates, index, mask)
    heads = np.searchsorted(document, np.arange(len(offsets) - 1))
    return np.maximum.reduceat(logits, heads) if len(heads) else logits


def _fit(network, inputs, toxic_windows, clean_windows, numbers, ends, padding, rng, steps):
    """Adam over balanced batches of windows; (start, document) pairs on both sides."""
    moment = {k: np.zeros_like(v) for k, v in network.p.items()}
    square = {k: np.zeros_like(v) for k, v in network.p.items()}
    for step in range(1, steps + 1):
        rows = np.concatenate([rng.choice(toxic_windows, BATCH), rng.choice(clean_windows, BATCH)])
        index, mask = _indices(numbers, rows[:, 0], ends[rows[:, 1]], padding)
        used, local = np.unique(index, return_inverse=True)
        local = local.reshape(index.shape)
        table = np.vstack([inputs, np.zeros((1, inputs.shape[1]), np.float32)])[used]
        target = np.repeat([1.0, 0.0], BATCH).astype(np.float32)
        _, g = network.gradients(table, local, mask, target)
        for k, value in g.items():
            moment[k] = 0.9 * moment[k] + 0.1 * value
            square[k] = 0.99 * square[k] + 0.01 * value * value
            network.p[k] = (network.p[k] - RATE * (moment[k] / (1 - 0.9**step))
                            / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)


def _calibrate(logits, toxic, weight):
    """(a, b) of the logistic calibration sigmoid(a * logit + b), a at least 0."""
    a, b = 1.0, 0.0
    for _ in range(200):
        q = _sigmoid(a * logits + b)
        residual, slope = weight * (q - toxic), weight * q * (1 - q) + 1e-4 * weight
        hess = np.array([[np.sum(slope * logits * logits) + 1e-2, np.sum(slope * logits)],
                         [np.sum(slope * logits), np.sum(slope) + 1e-2]])
        step = np.linalg.solve(hess, [np.sum(residual * logits) + 1e-2 * (a - 1), np.sum(residual)])
        a, b = max(0.05, a - np.clip(step[0], -0.5, 0.5)), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


class Model:
    """Features, network and calibration, learned from labelled texts."""

    def __init__(self, texts: list[str], toxic: list[int], prior: float):
        labels = np.array(toxic, np.int64)
        self.prior = prior
        self.network = None
        if not (labels == 0).any() or not (labels == 1).any():
            return
        numbers, distinct, offsets = _encoded(pa.array(texts, pa.string()))
        documents = [numbers[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        half = np.where(labels == 1, np.cumsum(labels), np.cumsum(1 - labels)) % 2  # both classes in both halves
        folds = [Features([d for d, x in zip(documents, half != k) if x], distinct, labels[half != k])
                 for k in (0, 1)]
        inputs = [f.of(distinct) for f in folds]
        # both halves side by side: the words of half 1 get rows of their own
        table = np.vstack(inputs)
        shifted = numbers + np.repeat(half, np.diff(offsets)) * len(distinct)
        starts, document = windows(offsets)
        ends, rng = offsets[1:], np.random.default_rng(11)
        suspicion = np.array([0.0] * len(starts), np.float32)
        evidence = np.concatenate([np.maximum(table[:, 0], table[:, 1]), [-9]]).astype(np.float32)
        network = Network(table.shape[1])
        for first in range(0, len(starts), _WINDOWS):
            part = slice(first, first + _WINDOWS)
            index, _ = _indices(shifted, starts[part], ends[document[part]], len(table))
            suspicion[part] = np.sort(evidence[index], axis=1)[:, -3:].sum(axis=1)
        heads = np.searchsorted(document, np.arange(len(documents)))
        for _ in range(ROUNDS):
            order = np.lexsort((-suspicion, document))
            ranked = np.arange(len(order)) - heads[document[order]]
            top = order[(ranked == 0) & (labels[document[order]] == 1)]
            hard = order[(ranked < CLEAN_WINDOWS // 2) & (labels[document[order]] == 0)]
            other = order[(labels[document[order]] == 0)]
            other = rng.choice(other, min(len(other), len(hard)), replace=False)
            pairs = [np.column_stack([starts[x], document[x]]) for x in (top, np.concatenate([hard, other]))]
            _fit(network, table, *pairs, shifted, ends, len(table), rng, STEPS)
            gates = network.tables(table)
            for first in range(0, len(starts), _WINDOWS):
                part = slice(first, first + _WINDOWS)
                index, mask = _indices(shifted, starts[part], ends[document[part]], len(table))
                suspicion[part] = network.score(gates, index, mask)
        logits = np.maximum.reduceat(suspicion, heads)
        share = labels.mean()
        weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
        self.network, self.features = network, Features(documents, distinct, labels)
        self.a, self.b = _calibrate(logits.astype(float), labels, weight)

    def scores(self, texts: pa.StringArray) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.prior)
        logits = document_logits(self.network, self.features, texts).astype(np.float64)
        return _sigmoid(self.a * logits + self.b)


def held_out(id_col: str):
    """Whether a document is kept for testing: crc32 of its id as text, modulo FOLDS, is 0."""
    text = F.encode(F.col(id_col).cast("string"), "utf-8")
    return F.coalesce(F.crc32(text) % FOLDS == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from up to ``sample`` labelled documents of each class that aren't held out;
    an id with several rows is learned from its smallest text, and texts of more than
    ``TRAIN_BYTES`` teach nothing (they are scored whole, like any other)."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")) \
        .where("id IS NOT NULL AND label IS NOT NULL").where(~held_out("id")) \
        .groupBy("id").agg(F.max("label").cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .where(F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAIN_BYTES).join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text")) \
        .orderBy(F.xxhash64("id"), "id").collect()  # 2 * sample rows
    return Model([r["text"] or "" for r in rows], [r["label"] for r in rows], prior)


def toxicity(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Per row: ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.5)."""
    spark = documents.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(train(documents, labels, id_col, text_col, label_col, sample))

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1, 4 << 20):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(model.value.scores(strings(part.column(1))), pa.float64())],
                    names=["id", "score"])

    id_type = documents.schema[id_col].dataType.simpleString()
    scored = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"id {id_type}, score double")
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
