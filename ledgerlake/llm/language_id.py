"""Language identification by a bidirectional gated recurrent network over bytes (operator 9).

A text's UTF-8 bytes are cut into segments of ``SEGMENT`` bytes, all of which are read. Two gated
recurrent layers of ``HIDDEN`` units, one from the left and one from the right, give every byte
position a probability for each language; a document's probabilities are the mean over its
positions. The network is trained on the driver in numpy, by back-propagation through time and
Adam, on at most ``DOCS`` documents a language (fewer if there are so many languages that they
would exceed ``ALL_DOCS``) and ``PIECES`` segments of each; the documents are those first in the
order of the id's hash. Their ids' crc32 fold (of 4) is never 2.

Null texts and texts without a letter are ``und`` with score 0; so is every text if nothing was
learned. Languages are the non-null values of ``lang`` found in the training folds. Repeated rows
each give a row; null ids count as not held out and are not learned from. An empty table gives no
rows; very long texts are read whole, some segments at a time. Of equally probable languages the
first by name is taken. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common

FOLDS, HELD_OUT = 4, 2
SEGMENT, HIDDEN = 96, 8
#: Training documents a language and altogether, and segments of each.
DOCS, ALL_DOCS, PIECES = 300, 20_000, 6
EPOCHS, BATCH, RATE, CLIP, SEED = 8, 96, 0.02, 1.0, 5
#: Segments read side by side.
LANES = 2048
#: Unicode category L: number signs such as ² or Ⅷ are no letters.
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


@dataclass
class Layer:
    """One direction. Rows of the weights: update gate, reset gate, candidate; a column for each byte."""

    byte: np.ndarray  # (3 H, 256)
    hidden: np.ndarray  # (3 H, H)
    bias: np.ndarray  # (3 H, 1)

    @staticmethod
    def drawn(rng: np.random.Generator) -> Layer:
        byte = rng.normal(0, 0.5, (3 * HIDDEN, 256))
        hidden = rng.normal(0, HIDDEN**-0.5, (3 * HIDDEN, HIDDEN))
        return Layer(byte, hidden, np.zeros((3 * HIDDEN, 1)))


@dataclass
class Network:
    """``langs`` are the labels, in the order of the rows of ``out``."""

    langs: list[str]
    layers: tuple[Layer, Layer]
    out: np.ndarray  # (C, 2 H)
    bias: np.ndarray  # (C, 1)

    @staticmethod
    def drawn(langs: list[str]) -> Network:
        rng = np.random.default_rng(SEED)
        layers = Layer.drawn(rng), Layer.drawn(rng)
        return Network(langs, layers, rng.normal(0, 0.3, (len(langs), 2 * HIDDEN)), np.zeros((len(langs), 1)))

    def weights(self) -> list[np.ndarray]:
        return [w for x in self.layers for w in (x.byte, x.hidden, x.bias)] + [self.out, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


# --- training -----------------------------------------------------------------------------------
def _run(layer: Layer, steps: np.ndarray):
    """States (T + 1, H, N) and what back-propagation needs, for bytes (T, N)."""
    h = np.zeros((len(steps) + 1, HIDDEN, steps.shape[1]))
    kept = []
    for t, x in enumerate(steps):
        read = layer.byte[:, x] + layer.bias
        back = layer.hidden @ h[t]
        z, r = (_sigmoid(read[k * HIDDEN : (k + 1) * HIDDEN] + back[k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1))
        n = np.tanh(read[2 * HIDDEN :] + r * back[2 * HIDDEN :])
        h[t + 1] = (1 - z) * n + z * h[t]
        kept.append((z, r, n, back[2 * HIDDEN :]))
    return h, kept


def _backward(layer: Layer, steps: np.ndarray, h: np.ndarray, kept: list, grads: np.ndarray) -> list[np.ndarray]:
    """Gradients of the layer's weights, given those of its states (T, H, N)."""
    byte, hidden, bias = (np.zeros_like(w) for w in (layer.byte, layer.hidden, layer.bias))
    carry = np.zeros_like(h[0])
    for t in reversed(range(len(steps))):
        z, r, n, back = kept[t]
        d = grads[t] + carry
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h[t] - n) * z * (1 - z)
        dr = dn * back * r * (1 - r)
        read = np.concatenate([dz, dr, dn])
        rec = np.concatenate([dz, dr, dn * r])
        carry = d * z + layer.hidden.T @ rec
        hidden += rec @ h[t].T
        bias += read.sum(axis=1, keepdims=True)
        np.add.at(byte.T, steps[t], read.T)
    return [byte, hidden, bias]


def loss_and_gradients(net: Network, segments: np.ndarray, mask: np.ndarray, label: np.ndarray):
    """Mean cross-entropy over the positions in ``mask`` (N, T), and the gradients of ``net.weights()``."""
    steps, valid = segments.T, mask.T
    ways = (steps, steps[::-1])
    runs = [_run(layer, way) for layer, way in zip(net.layers, ways)]
    states = np.concatenate([runs[0][0][1:], runs[1][0][1:][::-1]], axis=1)
    logits = np.einsum("ch,thn->tcn", net.out, states, optimize=True) + net.bias
    logits -= logits.max(axis=1, keepdims=True)
    prob = np.exp(logits)
    prob /= prob.sum(axis=1, keepdims=True)
    own = np.arange(len(label))
    total = valid.sum()
    loss = -(np.log(prob[:, label, own] + 1e-12) * valid).sum() / total
    prob[:, label, own] -= 1
    prob *= (valid / total)[:, None, :]
    out = np.einsum("tcn,thn->ch", prob, states, optimize=True)
    bias = prob.sum(axis=(0, 2))[:, None]
    back = np.einsum("ch,tcn->thn", net.out, prob, optimize=True)
    grads = _backward(net.layers[0], ways[0], *runs[0], back[:, :HIDDEN])
    grads += _backward(net.layers[1], ways[1], *runs[1], back[::-1, HIDDEN:])
    return loss, [*grads, out, bias]


def train_network(langs: list[str], segments: np.ndarray, mask: np.ndarray, label: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Adam with clipped gradients and a falling rate; deterministic for given rows."""
    net = Network.drawn(langs)
    rng = np.random.default_rng(SEED)
    weights = net.weights()
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    total = epochs * -(-len(label) // BATCH)
    done = 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            _, grads = loss_and_gradients(net, segments[rows], mask[rows], label[rows])
            norm = np.sqrt(sum((g * g).sum() for g in grads))
            scale = min(1.0, CLIP / (norm + 1e-12))
            done += 1
            rate = RATE * (1 - 0.9 * done / total)
            for w, g, m, v in zip(weights, grads, first, second):
                g = g * scale
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.99**done)) + 1e-8)
    return net


# --- scoring ------------------------------------------------------------------------------------
class Reader:
    """The trained network in single precision, with its halvings folded into the weights.

    A gate is ``0.5 + 0.5 tanh(x / 2)``: the gates' rows are halved, and the candidate's recurrent
    rows take the reset gate's factor 0.5.
    """

    def __init__(self, net: Network) -> None:
        half = np.repeat([0.5, 0.5, 1.0], HIDDEN)[:, None]
        self.langs = net.langs
        self.byte = [np.ascontiguousarray(((x.byte + x.bias) * half).astype(np.float32)) for x in net.layers]
        self.hidden = [np.ascontiguousarray((x.hidden * 0.5).astype(np.float32)) for x in net.layers]
        self.out = [np.ascontiguousarray(net.out[:, k * HIDDEN : (k + 1) * HIDDEN].astype(np.float32)) for k in (0, 1)]
        self.bias = net.bias.astype(np.float32)

    def _states(self, way: int, steps: np.ndarray) -> np.ndarray:
        t_count, n = steps.shape
        h = np.zeros((HIDDEN, n), np.float32)
        states = np.empty((t_count, HIDDEN, n), np.float32)
        read, back = (np.empty((3 * HIDDEN, n), np.float32) for _ in range(2))
        gates, cand = back[: 2 * HIDDEN], back[2 * HIDDEN :]
        z, r = back[:HIDDEN], back[HIDDEN : 2 * HIDDEN]
        for t in range(t_count) if way == 0 else reversed(range(t_count)):
            np.take(self.byte[way], steps[t], axis=1, out=read, mode="clip")
            np.matmul(self.hidden[way], h, out=back)
            gates += read[: 2 * HIDDEN]
            np.tanh(gates, out=gates)
            r += 1
            r *= cand
            r += read[2 * HIDDEN :]
            new = np.tanh(r, out=r)
            z *= 0.5
            z += 0.5
            h -= new
            h *= z
            h += new
            states[t] = h
        return states

    def positions(self, steps: np.ndarray) -> np.ndarray:
        """Probabilities (T, C, N) for bytes (T, N)."""
        left, right = self._states(0, steps), self._states(1, steps)
        logits = np.matmul(self.out[0], left)
        logits += np.matmul(self.out[1], right)
        logits += self.bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def documents(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Mean probabilities (documents x languages) over all positions, and the share of positions labelled so."""
        sizes = np.array([len(t) for t in texts], np.int64)
        counts = -(-sizes // SEGMENT)
        doc = np.repeat(np.arange(len(texts)), counts)
        flat = np.frombuffer(b"".join([t.ljust(-(-len(t) // SEGMENT) * SEGMENT, b"\0") for t in texts]), np.uint8)
        segments = flat.reshape(-1, SEGMENT)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        length = np.minimum(SEGMENT, sizes[doc] - nth * SEGMENT)
        sums = np.zeros((len(texts), len(self.langs)))
        votes = np.zeros_like(sums)
        for at in range(0, len(doc), LANES):
            some = slice(at, at + LANES)
            prob = self.positions(np.ascontiguousarray(segments[some].T).astype(np.intp))
            top = prob >= prob.max(axis=1, keepdims=True)
            short = length[some] < SEGMENT
            if short.any():  # only a text's last segment has positions beyond its end
                inside = np.arange(SEGMENT)[:, None] < length[some][short]
                prob[:, :, short] *= inside[:, None, :]
                top[:, :, short] &= inside[:, None, :]
            for total, part in ((sums, prob.sum(axis=0)), (votes, top.sum(axis=0, dtype=np.int32))):
                for c in range(len(self.langs)):
                    total[:, c] += np.bincount(doc[some], part[c], len(texts))
        one = np.maximum(sizes, 1)[:, None]
        return sums / one, votes / one


def _judge(net: Network | None):
    @common.worker("language")
    def run(batches):
        reader = Reader(net) if net else None
        for batch in batches:
            texts = common.texts_of(batch)
            lang, score, share = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if LETTER.search(t)] if reader else []
            raw = [texts[i].encode("utf-8", "replace") for i in known]
            for some in common.slices(list(range(len(raw))), [len(t) for t in raw], 4 * LANES * SEGMENT):
                prob, votes = reader.documents([raw[k] for k in some])
                best = prob.argmax(axis=1)
                for k, b, p, v in zip(some, best, prob, votes):
                    i = known[k]
                    lang[i], score[i], share[i] = reader.langs[b], min(1.0, p[b]), min(1.0, v[b])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(share)],
                ["doc_id", "lang_pred", "score", "position_share"],
            )

    return run


def _segments(batches):
    for batch in batches:
        lang, rows = [], []
        for name, h, t in zip(batch.column("lang").to_pylist(), batch.column("h").to_pylist(), common.texts_of(batch)):
            raw = t.encode("utf-8", "replace")
            if not LETTER.search(t):
                continue
            cuts = np.arange(0, len(raw), SEGMENT)
            for at in np.random.default_rng(h & 0xFFFFFFFF).permutation(cuts)[:PIECES]:
                lang.append(name)
                rows.append(raw[at : at + SEGMENT])
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(rows, pa.binary())], ["lang", "bytes"])


def learn(docs: DataFrame, per_language: int = DOCS) -> Network | None:
    """Train on at most ``per_language * PIECES`` segments of each language of the training folds."""
    common.prepare_workers(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & (common.fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    languages = known.select("lang").distinct().count()
    per_language = max(1, min(per_language, ALL_DOCS // max(1, languages)))
    ids = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).where(F.col("text").isNotNull())
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = ids.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_language)
    ids = ids.orderBy("nth", "lang").limit(ALL_DOCS).select("doc_id", "h").distinct()
    rows = known.select("doc_id", "lang", "text").join(F.broadcast(ids), "doc_id").select("lang", "h", "text")
    got = rows.mapInArrow(_segments, "lang string, bytes binary").orderBy("lang", "bytes").limit(ALL_DOCS * PIECES).collect()
    langs = sorted({r["lang"] for r in got})
    if not langs:
        return None
    segments = np.frombuffer(b"".join(r["bytes"].ljust(SEGMENT, b"\0") for r in got), np.uint8).reshape(-1, SEGMENT)
    mask = np.arange(SEGMENT) < np.array([len(r["bytes"]) for r in got])[:, None]
    return train_network(langs, segments, mask, np.array([langs.index(r["lang"]) for r in got]))


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, position_share`` of every document; a narrow pass."""
    common.prepare_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, position_share double"
    got = docs.select("doc_id", "text").mapInArrow(_judge(net), schema)
    held = F.coalesce(common.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return got.select("doc_id", held.alias("held_out"), "lang_pred", "score", "position_share")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.load(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
