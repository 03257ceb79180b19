"""Toxicity: hidden words are restored by a noisy-channel decoder, then the restored text is scored.

Method: a token with letters and look-alikes of letters anywhere, with symbols between letters, with a letter three times in a row, or a
run of at least three single letters set apart opens a lattice: a symbol may stand for the letters it resembles, be a mere separator,
or end a word; a run of one letter may stand for one or two of it. At the edges of a token, signs that usually stand there as
punctuation are read as letters only where the letters speak clearly for it. Viterbi decoding finds the reading that is likeliest under a trigram model of the letters of all documents. All
other tokens have one reading only, themselves. Each restored word gives three features (the word, its first four and
its first five letters); a logistic regression over the features that tell the labels apart, trained here in numpy on a
bounded sample of labelled documents, scores the set of features of the whole text.

Defined cases: null, empty and blank texts have no features and get the score of the intercept; a text of any length counts
wholly, and repeated rows get equal scores. Without two kinds of labels every score is 0. Further columns pass through;
clashing names give way to the result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import add_columns, slices
from reviewmill.session import publish

#: Bounds of the training sample and of the model.
DOCUMENTS_PER_LABEL, FEATURES = 3000, 1500

# Symbols and the letters they are read as.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t",
    "(": "c", "€": "e", "£": "l",
}
SEPARATORS = frozenset(".-_*~'`^/\\,:;")

#: Log probabilities of the channel: a symbol as a letter, as a separator, as the end of a word; a letter that was doubled.
AS_LETTER, AS_NOTHING, AS_BORDER, AS_DOUBLE = math.log(0.5), math.log(0.3), math.log(0.02), math.log(0.3)

HIDDEN = re.compile(r"[^\W\d_][^\w\s]+[^\W\d_]|[^\W_]\W*\s|[^\W\d_]\W*[0-9]\W*[^\W\d_]|[^\W\d_]_+[^\W\d_]|([^\W\d_])\1\1")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
LETTER = re.compile(r"[^\W\d_]")
LOOKALIKE = re.compile(f"[{re.escape(''.join(LOOKALIKES))}]")
#: Edge signs that resemble no letter.
FRINGE = re.compile(r"^(?:(?!{0})[\W_])+|(?:(?!{0})[\W_])+$".format(LOOKALIKE.pattern))
#: Look-alikes that are usually punctuation before and after a word.
OPENING, CLOSING = frozenset("(|"), frozenset("!|")
CLASSES = 32


def _byte_classes() -> np.ndarray:
    """0 for what is no letter, 1-26 for A-Z and a-z, five classes for the bytes of all other letters."""
    table = np.zeros(256, np.uint8)
    for n in range(26):
        table[ord("a") + n] = table[ord("A") + n] = n + 1
    table[128:] = 27 + np.arange(128) % 5
    return table


CLASS_OF = _byte_classes()


def letter_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(trigram, n): how often three neighbouring byte classes occur in all texts; one row per trigram and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for piece in slices(batches):
            joined = "\n".join([value for value in piece.column(0).to_pylist() if value])
            codes = CLASS_OF[np.frombuffer(f"\n{joined}\n".encode(), np.uint8)].astype(np.int32)
            total += np.bincount((codes[:-2] * CLASSES + codes[1:-1]) * CLASSES + codes[2:], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["trigram", "n"])

    return docs.select(F.col(text)).mapInArrow(run, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


class Letters:
    """Trigram model of letters, smoothed by the bigram."""

    def __init__(self, counts: list[tuple[int, int]]):
        table = np.zeros(CLASSES**3)
        for trigram, n in counts:
            table[trigram] = n
        table = table.reshape(CLASSES, CLASSES, CLASSES)
        pairs = table.sum(axis=0) + 0.1
        backed = pairs / pairs.sum(axis=1, keepdims=True)
        self.chance = np.log((table + 5 * backed) / (table.sum(axis=2, keepdims=True) + 5))

    def restore(self, token: str) -> str:
        """Likeliest reading of a token; words are parted by blanks."""
        paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}

        def add(into: dict, state: tuple[int, int], cost: float, path: str, letters: str) -> None:
            for letter in letters:
                for byte in letter.encode() if letter != " " else b" ":
                    code = int(CLASS_OF[byte])
                    cost += self.chance[state[0], state[1], code]
                    state = (state[1], code)
            if state not in into or cost > into[state][0]:
                into[state] = (cost, path + letters)

        inner = [n for n, sign in enumerate(token) if sign.isalpha()]
        first, last = (inner[0], inner[-1]) if inner else (0, len(token))
        for run in re.finditer(r"(.)\1*", token, re.DOTALL):
            sign, length = run[1], len(run[0])
            punctuation = run.start() < first and sign in OPENING or run.start() > last and sign in CLOSING
            as_letter = AS_BORDER if punctuation else AS_LETTER
            step: dict[tuple[int, int], tuple[float, str]] = {}
            for state, (cost, path) in paths.items():
                if sign.isalpha():
                    if length < 3:
                        add(step, state, cost, path, run[0])
                    else:
                        add(step, state, cost, path, sign)
                        add(step, state, cost + AS_DOUBLE, path, sign * 2)
                    continue
                for letter in LOOKALIKES.get(sign, ""):
                    add(step, state, cost + as_letter + (AS_DOUBLE if length == 2 else 0), path, letter)
                    if length > 1:
                        add(step, state, cost + as_letter + (AS_DOUBLE if length > 2 else 0), path, letter * 2)
                if punctuation:
                    add(step, state, cost, path, "")
                    continue
                if sign in SEPARATORS or sign.isspace():
                    add(step, state, cost + AS_NOTHING, path, "")
                if state[1]:
                    add(step, state, cost + AS_BORDER, path, " ")
                else:
                    add(step, state, cost + AS_BORDER, path, "")
            paths = step
        ends: dict[tuple[int, int], tuple[float, str]] = {}
        for state, (cost, path) in paths.items():
            add(ends, state, cost, path, " " if state[1] else "")
        return max(ends.values(), key=lambda x: (x[0], x[1]))[1].strip()


class Reader:
    """Turns texts into sets of feature digests; remembers frequent tokens in a dictionary of bounded size."""

    def __init__(self, letters: Letters, wanted: dict[int, int] | None = None, limit: int = 300_000):
        import xxhash

        self.digest, self.letters, self.wanted, self.limit = xxhash.xxh3_64_intdigest, letters, wanted, limit
        self.known: dict[str, tuple[int, ...]] = {}

    def words(self, token: str) -> list[str]:
        if token.isalpha():
            return self.letters.restore(token).split() if HIDDEN.search(token) else [token]
        core = FRINGE.sub("", token)
        if LETTER.search(core) and LOOKALIKE.search(core):
            return self.letters.restore(core).split()
        core = EDGES.sub("", core)
        return self.letters.restore(core).split() if HIDDEN.search(core) else [core] if core else []

    def _features(self, token: str) -> tuple[int, ...]:
        found = []
        for word in self.words(token):
            parts = [f"w{word}"] + [f"{n}{word[:n]}" for n in (4, 5) if len(word) >= n]
            codes = [self.digest(part) - 2**63 for part in parts]
            found += codes if self.wanted is None else [self.wanted[c] for c in codes if c in self.wanted]
        if len(self.known) >= self.limit:
            self.known.clear()
        self.known[token] = result = tuple(found)
        return result

    def tokens(self, text: str) -> list[str]:
        """Tokens of a text in order; single letters in a row make one token with blanks inside."""
        parts = text.lower().split()
        single = [n for n, part in enumerate(parts) if len(part) == 1 or len(part) < 4 and len(EDGES.sub("", part)) == 1]
        if len(single) < 3:
            return parts
        out, done, start = [], 0, 0
        for at in range(1, len(single) + 1):
            if at == len(single) or single[at] != single[at - 1] + 1:
                run = parts[single[start]:single[at - 1] + 1]
                if sum(part[0].isalnum() or part[0] in LOOKALIKES for part in run) > 2 and len(set(run)) > 1:
                    out += parts[done:single[start]]
                    out.append(" ".join(run))
                    done = single[at - 1] + 1
                start = at
        return out + parts[done:]

    def read(self, text: str | None) -> set[int]:
        known, out = self.known, set()
        for token in set(self.tokens(text)) if text else ():
            found = known.get(token)
            out.update(self._features(token) if found is None else found)
        return out


@dataclass
class Model:
    letters: Letters
    wanted: dict[int, int]
    weights: np.ndarray
    bias: float


def _logistic(rows: list[list[int]], labels: np.ndarray, columns: int, rounds: int = 300, ridge: float = 0.0002) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps; both labels carry equal weight."""
    x = np.zeros((len(rows), columns), np.float32)
    for n, row in enumerate(rows):
        x[n, row] = 1
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())).astype(np.float32)
    at, ahead, bias, bias_ahead = np.zeros(columns, np.float32), np.zeros(columns, np.float32), 0.0, 0.0
    rate = 4 / (1 + float((weight * (x * x).sum(axis=1)).sum()) + 4 * ridge)
    for n in range(rounds):
        error = (1 / (1 + np.exp(-(x @ ahead + bias_ahead))) - labels).astype(np.float32) * weight
        following = ahead - rate * (x.T @ error + ridge * ahead)
        bias_next = bias_ahead - rate * float(error.sum())
        pull = n / (n + 3)
        ahead, bias_ahead = following + pull * (following - at), bias_next + pull * (bias_next - bias)
        at, bias = following, bias_next
    return at, bias


def fit(docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """Learn from at most DOCUMENTS_PER_LABEL documents for each label (0 or 1), those with the smallest key digests.

    The letters are counted over all of ``docs``.
    """
    letters = Letters([(r.trigram, r.n) for r in letter_counts(docs, text).collect()])
    order = Window.partitionBy(label).orderBy(F.xxhash64(key), key)
    known = labelled.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    picked = known.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= DOCUMENTS_PER_LABEL).select(key, label).collect()
    by_label = [sorted({row[0] for row in picked if row[1] == k}) for k in (0, 1)]
    if not all(by_label):
        return None
    sample = docs.filter(F.col(key).isin(by_label[0] + by_label[1])).select(F.col(text), F.col(key).isin(by_label[1]).cast("int").alias("y"))
    sample = publish(sample, "toxicity-sample")

    def all_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(letters)
        for piece in slices(batches):
            found = [sorted(reader.read(value)) for value in piece.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(found, pa.list_(pa.int64()))], names=["y", "f"])

    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    spread = sample.mapInArrow(all_features, "y int, f array<long>").select("y", F.explode("f").alias("f"))
    counted = spread.groupBy("f").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
    bad, good = F.col("bad") / sizes[1], F.col("good") / sizes[0]
    mean = (bad + good) / 2
    strength = (bad - good) * (bad - good) / (mean * (1 - mean) + 1e-9)
    best = counted.filter((F.col("bad") > 1) & (bad > 2 * good)).orderBy(strength.desc(), "f").limit(FEATURES)
    wanted = {r.f: n for n, r in enumerate(best.select("f").collect())}

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(letters, wanted)
        for piece in slices(batches):
            found = [sorted(reader.read(value)) for value in piece.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(found, pa.list_(pa.int32()))], names=["y", "f"])

    rows = sorted((r.y, r.f) for r in sample.mapInArrow(chosen, "y int, f array<int>").collect())
    weights, bias = _logistic([f for _, f in rows], np.array([y for y, _ in rows]), max(1, len(wanted)))
    return Model(letters, wanted, weights, bias)


def score(df: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """Append the chance (0 to 1) that the whole text is toxic."""
    state: dict[str, Reader] = {}

    def compute(columns: list[list]) -> list:
        if model is None:
            return [[0.0] * len(columns[0])]
        if "reader" not in state:
            state["reader"] = Reader(model.letters, model.wanted)
        totals = [model.bias + sum(float(model.weights[n]) for n in sorted(state["reader"].read(value))) for value in columns[0]]
        return [[1 / (1 + math.exp(-max(-700.0, min(700.0, total)))) for total in totals]]

    return add_columns(df, [text], f"`{out}` double", compute)


def restore(df: DataFrame, letters: Letters, text: str = "text", out: str = "restored") -> DataFrame:
    """Append the restored words of each text, in order, parted by blanks (tokens of single letters are joined first)."""
    state: dict[str, Reader] = {}

    def compute(columns: list[list]) -> list:
        reader = state.setdefault("reader", Reader(letters))

        def whole(value: str | None) -> str | None:
            if value is None:
                return None
            return " ".join(word for token in reader.tokens(value) for word in reader.words(token))

        return [[whole(value) for value in columns[0]]]

    return add_columns(df, [text], f"`{out}` string", compute)
