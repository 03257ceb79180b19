"""Language identification with a byte convolutional network.

Method: bytes are folded to classes (letters without case, one class for blanks, digits and punctuation, each byte of a
multi-byte character its own). Filters of several widths slide over windows of fixed length, the largest response of each
filter in a window is kept, and a softmax layer reads those maxima. The network is trained here, in numpy, on a bounded
sample of labelled windows. A text is cut into as many windows as it needs, from its first to its last byte; its score per language
is the mean of the windows' probabilities, weighted by their letters.

Defined cases: a null text, an empty one, or one without any letter is ``und`` with score 0; ties go to the first language in
alphabetical order; repeated rows get equal results; an empty table gives an empty result. Without any labelled text
there is nothing to learn, and every text is ``und``. Further columns pass through; clashing names give way to the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import add_columns, slices
from reviewmill.session import publish

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
#: Bounds of the training sample: documents and windows per language, windows per document.
DOCUMENTS_PER_LABEL, WINDOWS_PER_LABEL, WINDOWS_PER_DOCUMENT = 500, 1500, 6
UNDETERMINED = "und"
#: Parts that a label's rows are dealt into before the first ones are picked.
SALTS = 64
#: Known runs of letters that a text counts as having besides its own, so that a very short one is not unfamiliar by chance.
PRIOR_RUNS = 8


def _classes() -> np.ndarray:
    """Byte -> class: 0 for everything that is no letter, 1-26 for A-Z and a-z, then one for each byte from 0x80 on."""
    table = np.zeros(256, np.uint8)
    for offset in range(26):
        table[ord("a") + offset] = table[ord("A") + offset] = 1 + offset
    table[0x80:] = np.arange(27, 27 + 128)
    return table


CLASS_OF = _classes()
CLASSES = int(CLASS_OF.max()) + 1


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all windows, padded with zeros for the widest filter, and the number of windows of each text."""
    counts = np.array([-(-len(text) // WINDOW) for text in texts], np.int64)
    padded = b"".join(text.ljust(int(n) * WINDOW, b" ") for text, n in zip(texts, counts, strict=True))
    inner = CLASS_OF[np.frombuffer(padded, np.uint8)].reshape(-1, WINDOW)
    return np.pad(inner, ((0, 0), (0, max(WIDTHS) - 1))), counts


@dataclass
class Network:
    """Filters ``taps[width][k]`` (class x filter), their offsets, and the softmax layer."""

    labels: list[str]
    taps: dict[int, np.ndarray]
    offset: np.ndarray
    dense: np.ndarray
    bias: np.ndarray
    #: Packed bits: which runs of three letter classes the training windows hold.
    seen: np.ndarray | None = None

    def familiar(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window, how many runs of three letters it has, and how many of them occur in the training windows."""
        known = np.unpackbits(self.seen).view(bool)
        runs, letters = _runs(codes)
        return letters.sum(axis=1), (known[runs] & letters).sum(axis=1)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses to the first two bytes of a filter, and to the third and fourth, for every pair of classes."""
        head, tail = [], []
        for width in WIDTHS:
            tap = self.taps[width]
            head.append(tap[0][:, None] + tap[1][None])
            if width == 3:
                tail.append(np.broadcast_to(tap[2][:, None], (CLASSES, CLASSES, FILTERS)))
            elif width == 4:
                tail.append(tap[2][:, None] + tap[3][None])
        flat = [np.ascontiguousarray(np.concatenate(x, axis=2).reshape(CLASSES * CLASSES, -1), np.float32) for x in (head, tail)]
        return flat[0], flat[1]

    def probabilities(self, codes: np.ndarray, tables: tuple[np.ndarray, np.ndarray], block: int = 48) -> np.ndarray:
        """Softmax for each window; ``block`` windows at a time stay in the processor's cache."""
        head, tail = tables
        largest = np.empty((len(codes), head.shape[1]), np.float32)
        for start in range(0, len(codes), block):
            part = codes[start:start + block].astype(np.int32)
            pairs = part[:, :-1] * CLASSES + part[:, 1:]
            response = head.take(pairs[:, :WINDOW], axis=0)
            response[:, :, FILTERS:] += tail.take(pairs[:, 2:WINDOW + 2], axis=0)
            largest[start:start + block] = response.max(axis=1)
        hidden = np.maximum(largest + self.offset, 0)
        return softmax(hidden @ self.dense + self.bias)


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all runs of three classes, and whether all three are letters."""
    wide = codes.astype(np.int32)
    runs = (wide[:, :-2] * CLASSES + wide[:, 1:-1]) * CLASSES + wide[:, 2:]
    return runs, (codes[:, :-2] > 0) & (codes[:, 1:-1] > 0) & (codes[:, 2:] > 0)


def _seen(codes: np.ndarray) -> np.ndarray:
    held = np.zeros(CLASSES**3 + -CLASSES**3 % 8, np.uint8)
    runs, letters = _runs(codes)
    held[runs[letters]] = 1
    return np.packbits(held)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(codes: np.ndarray, wanted: np.ndarray, labels: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.02) -> Network:
    """Adam on the cross entropy; the gradient of a maximum goes to the place where it was found."""
    rng = np.random.default_rng(7)
    net = Network(
        labels, {w: rng.normal(0, 0.3, (w, CLASSES, FILTERS)) for w in WIDTHS}, np.zeros(FILTERS * len(WIDTHS)),
        rng.normal(0, 0.3, (FILTERS * len(WIDTHS), len(labels))), np.zeros(len(labels)),
    )
    weights = [net.taps[w] for w in WIDTHS] + [net.offset, net.dense, net.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    columns, step = np.arange(FILTERS), 0
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for start in range(0, len(order), batch):
            chosen = order[start:start + batch]
            part, rows, places, peaks = codes[chosen], np.arange(len(chosen))[:, None], [], []
            for width in WIDTHS:
                response = sum(net.taps[width][k][part[:, k:WINDOW + k]] for k in range(width))
                places.append(response.argmax(axis=1))
                peaks.append(np.take_along_axis(response, places[-1][:, None], axis=1)[:, 0])
            before = np.concatenate(peaks, axis=1) + net.offset
            hidden = np.maximum(before, 0)
            slope = softmax(hidden @ net.dense + net.bias)
            slope[np.arange(len(chosen)), wanted[chosen]] -= 1
            slope /= len(chosen)
            back = (slope @ net.dense.T) * (before > 0)
            grads = []
            for i, width in enumerate(WIDTHS):
                grad = np.zeros_like(net.taps[width])
                for k in range(width):
                    np.add.at(grad[k], (part[rows, places[i] + k], columns), back[:, i * FILTERS:(i + 1) * FILTERS])
                grads.append(grad)
            grads += [back.sum(axis=0), hidden.T @ slope, slope.sum(axis=0)]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few windows from all over each text; every second one cut short, so that short texts are learned too."""
    for piece in slices(batches):
        labels, parts, order = [], [], []
        for text, label in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
            raw = text.encode()
            count = -(-len(raw) // WINDOW)
            for at in sorted({count * k // WINDOWS_PER_DOCUMENT for k in range(WINDOWS_PER_DOCUMENT)}):
                part = raw[at * WINDOW:(at + 1) * WINDOW]
                digest = zlib.crc32(part)
                if digest & 1:
                    part = part[:6 + (digest >> 1) % WINDOW]
                labels.append(label)
                parts.append(part)
                order.append(digest)
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(parts, pa.binary()), pa.array(order, pa.int64())],
                                         names=["label", "part", "digest"])


def _smallest(rows: DataFrame, label: str, order: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each label, numbered ``_n``; in two steps, so that a label's last task meets ``SALTS * most`` rows at most."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    some = salted.withColumn("_n", F.row_number().over(Window.partitionBy(label, "_salt").orderBy(*order))).filter(F.col("_n") <= most)
    return some.drop("_salt").withColumn("_n", F.row_number().over(Window.partitionBy(label).orderBy(*order))).filter(F.col("_n") <= most)


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> Network | None:
    """Learn from at most WINDOWS_PER_LABEL windows for each label; rows without text or label are left out.

    The sample is the documents whose digest of ``key`` is smallest, so it does not depend on how the table is stored.
    """
    known = labelled.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & (F.length(text) > 0))
    keyed = known.select(F.col(key).alias("key"), F.col(label).alias("label"), F.xxhash64(key).alias("digest"))
    picked = publish(_smallest(keyed, "label", ["digest", "key"], DOCUMENTS_PER_LABEL).select("key").distinct(), "language-keys")
    parts = known.join(picked.withColumnRenamed("key", key), key, "left_semi").select(F.col(text), F.col(label)).mapInArrow(
        _training_windows, "label string, part binary, digest long")
    rows = _smallest(parts, "label", ["digest", "part"], WINDOWS_PER_LABEL).collect()
    if not rows:
        return None
    rows.sort(key=lambda row: (row.label, row._n))
    labels = sorted({row.label for row in rows})
    codes, _ = windows([bytes(row.part) for row in rows])
    net = train(codes, np.array([labels.index(row.label) for row in rows]), labels)
    net.seen = _seen(codes)
    return net


def predict(df: DataFrame, model: Network | None, text: str = "text", out: str = "lang_pred", score: str = "score",
            familiar: str | None = None) -> DataFrame:
    """Append the language of each whole text and the network's probability of it.

    The network chooses among the languages it has learned, however sure. ``familiar`` names a further column: the share of a text's
    runs of three letters that its training windows hold (with PRIOR_RUNS known ones added), which is low for a language or script that was
    not learned. It is 0 without letters, and 1 for a text of letters too short for any run.
    """
    state: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def compute(columns: list[list]) -> list:
        texts = columns[0]
        names, scores, shares = [UNDETERMINED] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        judged = [i for i, value in enumerate(texts) if model and value and any(map(str.isalpha, value))]
        if judged:
            if "tables" not in state:
                state["tables"] = model.tables()
            codes, counts = windows([texts[i].encode() for i in judged])
            chance = model.probabilities(codes, state["tables"])
            weight = (codes > 0).sum(axis=1) + 1e-6
            starts = np.cumsum(counts) - counts
            mean = np.add.reduceat(chance * weight[:, None], starts) / np.add.reduceat(weight, starts)[:, None]
            best = mean.argmax(axis=1)
            for i, row, column in zip(judged, mean, best, strict=True):
                names[i], scores[i] = model.labels[column], min(1.0, float(row[column]))
            if familiar:
                total, known = (np.add.reduceat(x, starts) for x in model.familiar(codes))
                for i, all_runs, met in zip(judged, total.tolist(), known.tolist(), strict=True):
                    shares[i] = (met + PRIOR_RUNS) / (all_runs + PRIOR_RUNS)
        return [names, scores, shares] if familiar else [names, scores]

    more = f", `{familiar}` double" if familiar else ""
    return add_columns(df, [text], f"`{out}` string, `{score}` double{more}", compute, rows=64)
