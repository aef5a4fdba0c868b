"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of a text's UTF-8 bytes forwards and backwards, labels every byte from both states, and a
document's probabilities are the mean over all its bytes. Windows are cut from the whole text; each begins and ends in
the state zero. The network is trained in numpy by backpropagation through time on a bounded sample of labelled rows:
at most SAMPLE documents a language, chosen by a hash, PER_DOCUMENT windows of each.

Cases: null texts and texts without a letter get `und` with score 0; texts of any length are read whole; equal texts
get equal predictions; null languages teach nothing; without any labelled row all predictions are `und`; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agrilake.llm.tokens import forget_encoder

SAMPLE, PER_DOCUMENT = 300, 4
STEPS = 64  # bytes of a window
HIDDEN = 8
LANES = 1024  # windows that are read together
UNKNOWN = "und"


@dataclass
class Network:
    """Weights of both directions; the gates' columns are reset, update, candidate."""

    labels: list[str]
    embed: list[np.ndarray]  # (256, 3 hidden) input weights and biases of every byte
    inner: list[np.ndarray]  # (hidden, 3 hidden)
    out: np.ndarray  # (2 hidden, labels)
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.embed, *self.inner, self.out, self.bias]


def new_network(labels: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
    draw = np.random.default_rng(seed)
    f = lambda *shape, scale: draw.normal(0, scale, shape).astype(np.float32)
    embed = [f(256, 3 * hidden, scale=0.3) for _ in range(2)]
    for e in embed:
        e[:, hidden : 2 * hidden] += 1.0  # begin with long memory
    inner = [f(hidden, 3 * hidden, scale=hidden**-0.5) for _ in range(2)]
    return Network(labels, embed, inner, f(2 * hidden, len(labels), scale=0.2), np.zeros(len(labels), np.float32))


def _step(e: np.ndarray, h: np.ndarray, u: np.ndarray, hidden: int) -> tuple[np.ndarray, ...]:
    """One step: gates = sigmoid(x + h U), candidate = tanh(x + reset * (h U)), h' = update h + (1 - update) candidate."""
    a = h @ u
    g = 0.5 * np.tanh(0.5 * (e[:, : 2 * hidden] + a[:, : 2 * hidden])) + 0.5
    r, z = g[:, :hidden], g[:, hidden:]
    c = np.tanh(e[:, 2 * hidden :] + r * a[:, 2 * hidden :])
    return c + z * (h - c), g, c, a


def states(net: Network, windows: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """States after every byte, (steps, hidden, windows), of both directions; bytes beyond a window's end change none.

    The same step as in training, with rows as units so that numpy works on long runs, and in place.
    """
    hidden = net.inner[0].shape[0]
    n, steps = windows.shape
    columns = np.ascontiguousarray(windows.T)
    short = np.flatnonzero(lengths < steps)
    half = np.repeat(np.array([0.5, 1.0], np.float32), [2 * hidden, hidden])  # sigmoid(x) = tanh(x / 2) / 2 + 1 / 2
    found = []
    x, a = (np.empty((3 * hidden, n), np.float32) for _ in range(2))
    for d in (0, 1):
        embed = np.ascontiguousarray((net.embed[d] * half).T)
        inner = np.ascontiguousarray((net.inner[d] * half).T)
        h = np.zeros((hidden, n), np.float32)
        all_h = np.empty((steps, hidden, n), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            np.take(embed, columns[t], axis=1, out=x, mode="clip")
            np.matmul(inner, h, out=a)
            g, c = x[: 2 * hidden], x[2 * hidden :]
            g += a[: 2 * hidden]
            np.tanh(g, out=g)
            g *= 0.5
            g += 0.5
            reset = a[2 * hidden :]
            reset *= g[:hidden]
            c += reset
            np.tanh(c, out=c)
            now = all_h[t]
            np.subtract(h, c, out=now)
            now *= g[hidden:]
            now += c
            if len(short):
                over = short[lengths[short] <= t]
                if len(over):
                    now[:, over] = 0 if d or not t else all_h[t - 1][:, over]
            h = now
        found.append(all_h)
    return found


def label_positions(net: Network, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probabilities of the labels at every byte: (steps, labels, windows)."""
    forward, backward = states(net, windows, lengths)
    hidden = forward.shape[1]
    logits = net.out[:hidden].T @ forward
    logits += net.out[hidden:].T @ backward
    logits += net.bias[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def loss_and_gradients(net: Network, windows: np.ndarray, targets: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy of all positions of full windows, and its gradients by backpropagation through time."""
    hidden = net.inner[0].shape[0]
    n, steps = windows.shape
    columns = np.ascontiguousarray(windows.T)
    kept: list[list[tuple]] = [[], []]
    all_h = np.empty((2, steps, n, hidden), np.float32)
    for d in (0, 1):
        h = np.zeros((n, hidden), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            before = h
            h, g, c, a = _step(net.embed[d][columns[t]], h, net.inner[d], hidden)
            kept[d].append((t, before, g, c, a))
            all_h[d, t] = h
    both = np.concatenate([all_h[0], all_h[1]], axis=2)
    logits = both @ net.out + net.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    loss = float(-np.log(p[:, np.arange(n), targets] + 1e-9).mean())
    p[:, np.arange(n), targets] -= 1
    p /= n * steps
    g_out = np.tensordot(both, p, ([0, 1], [0, 1]))
    g_bias = p.sum(axis=(0, 1))
    into = p @ net.out.T
    g_embed = [np.zeros_like(e) for e in net.embed]
    g_inner = [np.zeros_like(u) for u in net.inner]
    for d in (0, 1):
        back = np.zeros((n, hidden), np.float32)
        u = net.inner[d]
        of_bytes = np.empty((steps, n, 3 * hidden), np.float32)
        for t, before, g, c, a in reversed(kept[d]):
            dh = back + into[t, :, d * hidden : (d + 1) * hidden]
            r, z = g[:, :hidden], g[:, hidden:]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (before - c) * z * (1 - z)
            dr = dc * a[:, 2 * hidden :] * r * (1 - r)
            da = np.concatenate([dr, dz, dc * r], axis=1)
            of_bytes[t] = np.concatenate([dr, dz, dc], axis=1)
            g_inner[d] += before.T @ da
            back = dh * z + da @ u.T
        flat = columns.reshape(-1)
        for k in range(3 * hidden):
            g_embed[d][:, k] = np.bincount(flat, of_bytes[:, :, k].reshape(-1), minlength=256)
    return loss, [*g_embed, *g_inner, g_out, g_bias]


def train(windows: np.ndarray, targets: np.ndarray, labels: list[str], rounds: int = 400, batch: int = 256, rate: float = 0.02) -> Network:
    """Adam on balanced batches of full windows."""
    net = new_network(labels)
    draw = np.random.default_rng(11)
    by_label = [np.flatnonzero(targets == k) for k in range(len(labels))]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, rounds + 1):
        at = np.concatenate([draw.choice(own, -(-batch // len(labels))) for own in by_label])
        _, gradients = loss_and_gradients(net, windows[at], targets[at])
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in gradients)))
        pace = rate * min(1.0, 2.0 * (1 - step / (rounds + 1)))
        for p, g, m, v in zip(net.parameters(), gradients, first, second, strict=True):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def windows_of(data: bytes, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """All windows of some bytes, the last one filled up, and their lengths."""
    n = -(-len(data) // steps)
    flat = np.zeros(n * steps, np.uint8)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    lengths = np.full(n, steps)
    if n:
        lengths[-1] = len(data) - (n - 1) * steps
    return flat.reshape(n, steps), lengths


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities over all bytes of every text; zeros for empty ones."""
    total = np.zeros((len(texts), len(net.labels)))
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def read() -> None:
        windows = np.concatenate([w for w, _, _ in waiting])
        lengths = np.concatenate([n for _, n, _ in waiting])
        owner = np.concatenate([o for _, _, o in waiting])
        for i in range(0, len(windows), LANES):
            some = slice(i, i + LANES)
            p = label_positions(net, windows[some], lengths[some])
            if lengths[some].min() < windows.shape[1]:
                p *= (np.arange(windows.shape[1])[:, None] < lengths[some])[:, None, :]
            np.add.at(total, owner[some], p.sum(axis=0).T)

    for i, text in enumerate(texts):
        w, n = windows_of(text)
        waiting.append((w, n, np.full(len(w), i)))
        held += len(w)
        if held >= 4 * LANES:
            read()
            waiting, held = [], 0
    if held:
        read()
    return total / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def fit(docs: DataFrame, teaches: Column, sample: int = SAMPLE, per_document: int = PER_DOCUMENT) -> Network | None:
    """A network for the languages of the rows that `teaches` selects; None if there are none."""
    labelled = docs.where(teaches & F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return None
    # about 1.5 x sample rows a language by a hash, of which the smallest hashes are kept
    order = F.xxhash64("doc_id", "text")
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(1_000_000 * min(1.0, 1.5 * sample / n)))])
    some = labelled.where(F.pmod(order, F.lit(1_000_000)) < share[F.col("lang")]).withColumn("order", F.pmod(order, F.lit(1_000_000)))
    # windows, not texts, go to the driver: at most sample x per_document x STEPS bytes a language
    rows = some.select("lang", "order", "text").mapInArrow(_sampler(per_document), "lang string, hash long, windows binary").collect()
    labels = sorted(sizes)
    windows, targets = [], []
    for k, lang in enumerate(labels):
        own = sorted((r["hash"], bytes(r["windows"])) for r in rows if r["lang"] == lang)[:sample]
        for _, data in own:
            part = np.frombuffer(data, np.uint8).reshape(-1, STEPS)
            windows.append(part)
            targets += [k] * len(part)
    if len(set(targets)) < len(labels):  # a language whose texts are all shorter than any window: keep those seen
        seen = sorted(set(targets))
        labels, targets = [labels[k] for k in seen], [seen.index(k) for k in targets]
    return train(np.concatenate(windows), np.array(targets), labels) if windows else None


def _sampler(per_document: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, order in zip(batch.column("text").to_pylist(), batch.column("order").to_pylist(), strict=True):
                data = text.encode()
                if len(data) < STEPS:  # short texts are repeated to the length of a window
                    data = ((data + b" ") * (STEPS // (len(data) + 1) + 1))[:STEPS]
                draw = np.random.default_rng(order)
                starts = draw.integers(0, len(data) - STEPS + 1, per_document if len(data) > STEPS else 1)
                found.append(b"".join(data[s : s + STEPS] for s in starts))
            columns = [batch.column("lang"), batch.column("order").cast(pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "hash", "windows"])

    return run


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """`docs` with lang_pred and score, from the text alone; no shuffle. Columns of these names are taken out.

    Where the input's own `lang_pred` or `score` must stay, ask for a struct of its columns beside the text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some thousand numbers
    kept = docs.drop("lang_pred", "score")
    names = kept.columns
    schema = StructType([*kept.schema.fields]).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoder()
        model = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                texts = batch.column("text").to_pylist()
                speaks = [has_letter(t) and model is not None for t in texts]
                p = pooled(model, [t.encode() if s else b"" for t, s in zip(texts, speaks, strict=True)]) if model else None
                best = [int(row.argmax()) if s else -1 for row, s in zip(p, speaks, strict=True)] if model else [-1] * len(texts)
                langs = [model.labels[b] if b >= 0 else UNKNOWN for b in best]
                scores = [min(1.0, float(p[i, b])) if b >= 0 else 0.0 for i, b in enumerate(best)]
                columns = [batch.column(n) for n in names] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)
