"""Toxicity by a support vector machine over a subsequence string kernel with Nyström landmarks.

Two words are alike if they share subsequences of three and four letters within six letters' reach; each letter left
out in between costs the factor DECAY, so gapped insults and such with inserted letters stay near the plain ones.
Word edges count as a letter. Landmarks are words; a word's Nyström features are its kernel values with them, whitened
by the landmarks' own kernel matrix, and a linear machine with squared hinge loss separates these. As the machine is
linear in the kernel, its landmarks fold into one weight per subsequence, and reading a word is a sum of weights.

Labels belong to documents. A document is toxic if one of its sentences is, and a sentence if one of its words is, so
the machine learns from witnesses: in rounds, the strongest word of every toxic training document is a positive, all
words of clean ones are negatives, the strongest of them first; the strongest words with a letter inserted are further
positives. Documents that took no part in this then fit the
logistic curve from the strongest word's margin to a score.

Training reads at most SAMPLE documents of either label, chosen by a hash; everything else is over all rows.

Cases: null or empty texts, and texts without words, get the score of the lowest margin; letters spelled with blanks
or signs between them are read together; texts of any length are read whole; equal texts get equal scores; without
labels of both kinds every score is 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 1500
LANDMARKS = 160
DECAY, REACH = 0.5, 6
LONGEST = 40  # letters of a word that are read at once; longer words are read in overlapping parts
REMEMBERED = 600_000
THREE, FEATURES = 1 << 15, (1 << 15) + (1 << 20)
#: Offsets of a subsequence after its first letter, with its weight.
PATTERNS = [
    (rest, DECAY ** (rest[-1] - len(rest)))
    for size in (2, 3)
    for rest in combinations(range(1, REACH), size)
]
FLOOR = -3.0

# Digits and signs that stand for letters.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"})
NO_LETTER = re.compile(r"[\W\d_]+")
SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")


def normal(token: str) -> str:
    """Letters of a token in lower case."""
    if token.isalpha():
        return token
    if any(c.isalpha() for c in token):
        token = token.strip(".,;:!?()[]{}\"'").translate(LOOKALIKE)
    return NO_LETTER.sub("", token)


def tokens_of(text: str) -> set[str]:
    """Lower-case tokens, and runs of single letters as one token each."""
    text = text.lower()
    found = set(text.split())
    for run in SPELLED.findall(text):
        found.add(re.sub(r"\s", "", run))
    return found


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all words as numbers below 32, an edge before and after each; where each word begins, and the end."""
    lengths = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    codes = np.where((points >= 97) & (points <= 122), points - 96, 27 + points % 5)
    starts = np.concatenate([[0], np.cumsum(lengths + 2)])
    flat = np.zeros(int(starts[-1]), np.int32)
    inside = np.ones(len(flat), bool)
    inside[starts[:-1]] = False
    inside[starts[1:] - 1] = False
    flat[inside] = codes
    return flat, starts


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For every pattern: the features' numbers, the places of their first letters, and the pattern's weight."""
    flat, starts = _codes(words)
    end = np.repeat(starts[1:], np.diff(starts))
    for rest, weight in PATTERNS:
        n = max(0, len(flat) - rest[-1])
        at = flat[:n]
        for k in rest:
            at = at * 32 + flat[k : k + n]
        ok = np.flatnonzero(np.arange(rest[-1], rest[-1] + n) < end[:n])
        yield at[ok] + (0 if len(rest) == 2 else THREE), ok, weight


def _norms(lengths: np.ndarray) -> np.ndarray:
    """Length of a word's feature vector if all its subsequences differ."""
    squares = np.zeros(len(lengths))
    for rest, weight in PATTERNS:
        squares += np.maximum(0, lengths + 2 - rest[-1]) * weight**2
    return np.sqrt(np.maximum(squares, 1e-9))


def _parts(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word]
    step = LONGEST - REACH
    return [word[i : i + LONGEST] for i in range(0, len(word) - REACH, step)]


@dataclass
class Machine:
    """One weight per subsequence, the offset, and the curve from margins to scores."""

    weights: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, words: list[str]) -> np.ndarray:
        """Margins of words in normal form; a long word has the largest of its parts'."""
        parts = [p for w in words for p in _parts(w)]
        out = np.full(len(parts), float(FLOOR))
        if not parts:
            return out
        lengths = np.array([len(p) for p in parts])
        sums = np.zeros(int((lengths + 2).sum()), np.float32)
        for features, at, weight in subsequences(parts):
            sums[at] += self.weights[features] * np.float32(weight)
        starts = np.concatenate([[0], np.cumsum(lengths + 2)[:-1]])
        out = np.add.reduceat(sums, starts) / _norms(lengths) + self.offset
        out[lengths == 0] = FLOOR
        if len(parts) == len(words):
            return out
        first = np.concatenate([[0], np.cumsum([len(_parts(w)) for w in words])[:-1]])
        return np.maximum.reduceat(out, first)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


class Reader:
    """Largest margin of a text's words, with a bounded memory of tokens seen before."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.known: dict[str, float] = {}

    def read(self, texts: list[str]) -> np.ndarray:
        tokens = [tokens_of(t) for t in texts]
        new = list(set().union(*tokens) - self.known.keys()) if tokens else []
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(set().union(*tokens))
        found: dict[str, float] = {}
        for i in range(0, len(new), 8192):
            some = new[i : i + 8192]
            found.update(zip(some, self.machine.margins([normal(w) for w in some]).tolist(), strict=True))
        self.known.update((w, m) for w, m in found.items() if len(w) <= LONGEST)
        known = self.known
        return np.array([max((known[w] if w in known else found[w] for w in t), default=FLOOR) for t in tokens])


def kernel_features(words: list[str], row_of: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Kernel values of words with the landmarks whose subsequence weights are `rows`, numbered by `row_of`."""
    out = np.zeros((len(words), rows.shape[1]), np.float32)
    for i in range(0, len(words), 512):
        some = words[i : i + 512]
        lengths = np.array([len(w) for w in some])
        owner = np.repeat(np.arange(len(some)), lengths + 2)
        for features, at, weight in subsequences(some):
            row = row_of[features]
            hit = np.flatnonzero(row)
            if len(hit):
                np.add.at(out[i : i + 512], owner[at[hit]], rows[row[hit]] * np.float32(weight))
        out[i : i + 512] /= _norms(lengths)[:, None]
    return out


def separate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last number is the offset."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    penalty = np.full(x.shape[1], ridge * weight.sum())
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        active = y * (x @ w) < 1
        xa = x[active]
        new = np.linalg.solve((xa * weight[active, None]).T @ xa + np.diag(penalty), xa.T @ (weight[active] * y[active]))
        if np.abs(new - w).max() < 1e-6:
            break
        w = 0.5 * (w + new)
    return w


def train_machine(toxic: list[set[str]], clean: list[set[str]], landmarks: int = LANDMARKS, rounds: int = 2) -> Machine:
    """A machine from the words of toxic and clean documents. If either side has no word, every text scores 0.5 or nearly so."""
    toxic, clean = ([[w for w in sorted(d) if 2 <= len(w) <= LONGEST] for d in docs] for docs in (toxic, clean))
    fit_toxic, fit_clean = ([d for i, d in enumerate(docs) if i % 4 or len(docs) < 8] for docs in (toxic, clean))
    ask_toxic, ask_clean = ([d for i, d in enumerate(docs) if not i % 4 or len(docs) < 8] for docs in (toxic, clean))
    # First witnesses: words made of pieces that toxic documents have and clean ones lack.
    seen = np.zeros((2, FEATURES))
    for label, docs in enumerate((fit_clean, fit_toxic)):
        for words in docs:
            if words:
                pieces = [f for f, _, w in subsequences(words) if w == 1.0]
                seen[label, np.unique(np.concatenate(pieces))] += 1
    odds = np.log((seen[1] + 0.5) / (len(fit_toxic) + 1)) - np.log((seen[0] + 0.5) / (len(fit_clean) + 1))
    odds[seen[1] < max(2, 0.004 * len(fit_toxic))] = 0
    machine = Machine(odds.astype(np.float32), 0.0)
    negatives = sorted({w for d in fit_clean for w in d})
    if not negatives:  # nothing to hold toxic words against: the first odds stay
        rounds = -1
    draw = np.random.default_rng(5)
    for turn in range(rounds + 1):
        strongest = _strongest(machine, fit_toxic)
        bar = np.quantile([m for _, m in _strongest(machine, fit_clean)], 0.9)
        witness: dict[str, int] = {}
        for word, margin in strongest:
            if word and (margin > bar or turn == 0 and margin > 0):
                witness[word] = witness.get(word, 0) + 1
        if not witness:
            break
        positives = sorted(witness, key=lambda w: (-witness[w], w))[:6000]
        margins = machine.margins(negatives)
        hard = np.argsort(-margins, kind="stable")[:4000]
        some = draw.choice(len(negatives), min(4000, len(negatives)), replace=False)
        against = [negatives[i] for i in sorted({*hard.tolist(), *some.tolist()})]
        marks = list(dict.fromkeys([*positives[: landmarks // 2], *[negatives[i] for i in hard[: landmarks // 4]], *[negatives[i] for i in some[: landmarks // 4]]]))
        bent = {v: witness[p] / 16 for p in positives[:300] for v in variants(p, draw)}
        for word in bent.keys() & {*positives, *negatives}:
            del bent[word]
        counts = np.array([*(witness[p] for p in positives), *bent.values()])
        machine = _fit(marks, [*positives, *bent], counts, against)
    _calibrate(machine, [m for _, m in _strongest(machine, ask_toxic)], [m for _, m in _strongest(machine, ask_clean)])
    return machine


def variants(word: str, draw: np.random.Generator, times: int = 8) -> list[str]:
    """The word with a letter inserted somewhere inside, half of them a repeated one."""
    found = []
    for k in range(times if len(word) > 2 else 0):
        at = int(draw.integers(1, len(word)))
        letter = word[at - 1] if k % 2 else chr(97 + int(draw.integers(26)))
        found.append(word[:at] + letter + word[at:])
    return found


def _strongest(machine: Machine, docs: list[list[str]]) -> list[tuple[str, float]]:
    words = sorted({w for d in docs for w in d})
    margin: dict[str, float] = {}
    for i in range(0, len(words), 8192):
        some = words[i : i + 8192]
        margin.update(zip(some, machine.margins(some).tolist(), strict=True))
    return [max(((w, margin[w]) for w in d), key=lambda x: (x[1], x[0]), default=("", FLOOR)) for d in docs]


def _fit(marks: list[str], positives: list[str], counts: np.ndarray, negatives: list[str]) -> Machine:
    # the landmarks' own vectors, as rows of only those subsequences that they have
    lengths = np.array([len(m) for m in marks])
    owner = np.repeat(np.arange(len(marks)), lengths + 2)
    found = [(f, owner[at], w) for f, at, w in subsequences(marks)]
    numbers = np.unique(np.concatenate([f for f, _, _ in found]))
    row_of = np.zeros(FEATURES, np.int32)
    row_of[numbers] = np.arange(1, len(numbers) + 1)
    rows = np.zeros((len(numbers) + 1, len(marks)), np.float32)
    for f, o, w in found:
        np.add.at(rows, (row_of[f], o), w)
    rows /= _norms(lengths)[None, :]
    own = kernel_features(marks, row_of, rows).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    kept = values > 1e-4 * values.max()
    white = vectors[:, kept] / np.sqrt(values[kept])
    x = kernel_features([*positives, *negatives], row_of, rows) @ white
    y = np.concatenate([np.ones(len(positives)), -np.ones(len(negatives))])
    weight = np.concatenate([np.sqrt(counts) / np.sqrt(counts).sum(), np.full(len(negatives), 2.0 / len(negatives))])
    w = separate(x, y, weight)
    weights = np.zeros(FEATURES, np.float32)
    weights[numbers] = rows[1:] @ (white @ w[:-1])
    return Machine(weights, float(w[-1]))


def _calibrate(machine: Machine, toxic: list[float], clean: list[float]) -> None:
    """Logistic curve by Newton steps, towards softened targets."""
    m = np.array([*toxic, *clean])
    target = np.concatenate([np.full(len(toxic), (len(toxic) + 1) / (len(toxic) + 2)), np.full(len(clean), 1 / (len(clean) + 2))])
    share = np.concatenate([np.full(len(toxic), 0.5 / max(1, len(toxic))), np.full(len(clean), 0.5 / max(1, len(clean)))])
    x = np.stack([m, np.ones(len(m))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (share * (p - target)) + np.array([1e-4, 0]) * beta
        curve = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    machine.slope, machine.shift = max(float(beta[0]), 1e-3), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, teaches: Column, sample: int = SAMPLE) -> Machine | None:
    """A machine from the labelled rows that `teaches` selects; None unless both labels are there."""
    known = labels.where(teaches & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    limit = F.when(F.col("toxic") == 1, F.lit(int(1e6 * min(1.0, sample / sizes[1])))).otherwise(F.lit(int(1e6 * min(1.0, sample / sizes[0]))))
    # about 2 x sample rows: a proven bound for the broadcast
    some = known.where(order < limit)
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(some), "doc_id")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [" ".join(sorted({normal(w) for w in tokens_of(t)} - {""})) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("toxic").cast(pa.int32()), pa.array(found, pa.string())],
                ["doc_id", "toxic", "words"],
            )

    got = rows.select("doc_id", "toxic", "text").mapInArrow(words, "doc_id long, toxic int, words string").collect()
    got = sorted(got, key=lambda r: (r["doc_id"], r["words"]))
    toxic, clean = ([set(r["words"].split(" ")) for r in got if r["toxic"] == k] for k in (1, 0))
    return train_machine(toxic, clean) if toxic and clean else None


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """doc_id and score of every row, from the text alone; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # one weight per possible subsequence: 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value) if shared.value is not None else None
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                scores = reader.machine.scores(reader.read(texts)) if reader else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
