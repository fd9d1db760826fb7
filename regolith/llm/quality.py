"""Quality of documents by a linear-chain conditional random field over their lines."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regolith.llm import text as tx
from regolith.session import some

#: Labelled documents at most, and lines of each at most, that the model is fitted on.
MAX_DOCS, MAX_LINES = 4000, 400
#: Byte classes that are counted in each line.
_CLASSES = np.stack([
    tx.byte_table((0x61, 0x7A)), tx.byte_table((0x41, 0x5A)), tx.byte_table((0x30, 0x39)), tx.byte_table((0x20, 0x20), (0x09, 0x0D)),
    tx.byte_table((0x21, 0x21)), tx.byte_table((0x23, 0x26)), tx.byte_table((0x2A, 0x2A), (0x40, 0x40), (0x5E, 0x5F), (0x7E, 0x7E)),
    tx.byte_table((0x7C, 0x7C)), tx.byte_table((0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F)),
    tx.byte_table((0x2F, 0x2F), (0x3C, 0x3E), (0x5B, 0x5D), (0x7B, 0x7B), (0x7D, 0x7D)), tx.byte_table((0x80, 0xFF)),
]).astype(np.float32)
_OWN = len(_CLASSES) + 5


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line with its neighbours', lengths, first line of each document); every document has a line."""
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1])) if len(data) else np.zeros(0, np.int64)
    # an empty document shares its start with the next one, and a line may end where a document does: number lines by document
    doc_of_break = np.searchsorted(offsets, breaks, "right") - 1
    per_doc = np.bincount(doc_of_break, minlength=len(offsets) - 1) + 1
    first = np.concatenate([[0], np.cumsum(per_doc)])
    starts = np.empty(first[-1], np.int64)
    starts[first[:-1]] = offsets[:-1]
    is_first = np.zeros(first[-1], bool)
    is_first[first[:-1]] = True
    starts[~is_first] = breaks + 1
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    last = first[1:] - 1
    ends[last] = offsets[1:]
    length = np.maximum(ends - starts, 0)

    own = np.zeros((len(starts), _OWN), np.float32)
    for k, table in enumerate(_CLASSES):
        total = np.concatenate([[0.0], np.cumsum(table[data], dtype=np.float64)])
        own[:, k] = (total[ends] - total[starts]) / np.maximum(length, 1)
    w0, w1, _ = tx.words(data, offsets, tx.SPACES)
    hashes = tx.word_hashes(data, w0, w1)
    a, b = np.searchsorted(w0, starts), np.searchsorted(w0, ends)
    n = np.maximum(b - a, 0)
    same = np.zeros(len(hashes) + 1, np.float64)
    same[2 : len(hashes) + 1] = hashes[1:] == hashes[:-1]
    same = np.concatenate([[0.0], np.cumsum(same)])[1:]
    own[:, -5] = np.log1p(length) / 8
    own[:, -4] = np.log1p(n) / 6
    own[:, -3] = length / np.maximum(n, 1) / 12
    own[:, -2] = np.where(n > 1, same[b] - same[np.minimum(a + 1, b)], 0) / np.maximum(n, 1)
    pairs = np.zeros(len(hashes) + 1, np.float64)  # words that open a pair seen just before it: short loops of words
    if len(hashes) > 3:
        pairs[4:] = (hashes[3:] == hashes[1:-2]) & (hashes[2:-1] == hashes[:-3])
    pairs = np.cumsum(pairs)
    own[:, -1] = np.where(n > 3, pairs[b] - pairs[np.minimum(a + 3, b)], 0) / np.maximum(n, 1)

    whole = np.zeros((len(starts), 3 * _OWN + 1), np.float32)
    whole[:, :_OWN] = own
    inner = np.flatnonzero(~is_first)
    whole[inner, _OWN : 2 * _OWN] = own[inner - 1]
    whole[inner - 1, 2 * _OWN : 3 * _OWN] = own[inner]
    whole[:, -1] = 1
    return whole, length.astype(np.float64), first


@dataclass
class LineCrf:
    """Two labels; ``weights`` score good against bad, ``moves[i, j]`` the step from label i to j."""

    weights: np.ndarray
    moves: np.ndarray
    scale: np.ndarray
    shift: np.ndarray
    slope: float = 1.0
    base: float = 0.0

    def _passes(self, unary: np.ndarray, first: np.ndarray):
        """Forward and backward messages of all sequences in step, longest first; yields marginals and pair marginals."""
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        sizes, begin = sizes[order], first[:-1][order]
        n = len(unary)
        alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
        score = np.stack([np.zeros(n), unary], axis=1)
        longest = int(sizes[0]) if len(sizes) else 0
        active = np.searchsorted(-sizes, -np.arange(1, longest + 1), "right") if longest else []
        for t in range(longest):
            at = begin[: active[t]] + t
            if t:
                step = alpha[at - 1][:, :, None] + self.moves
                alpha[at] = np.logaddexp(step[:, 0], step[:, 1]) + score[at]
            else:
                alpha[at] = score[at]
        for t in range(longest - 2, -1, -1):
            at = begin[: active[t + 1]] + t
            step = self.moves + (beta[at + 1] + score[at + 1])[:, None, :]
            beta[at] = np.logaddexp(step[:, :, 0], step[:, :, 1])
        both = alpha + beta
        norm = np.logaddexp(both[:, 0], both[:, 1])
        return alpha, beta, score, norm, np.exp(both[:, 1] - norm)

    def marginals(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The probability of the label good for every line."""
        return self._passes((features - self.shift) / self.scale @ self.weights, first)[4]

    def documents(self, features: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The length-weighted mean of the lines' marginals, calibrated to a probability."""
        good = self.marginals(features, first)
        weight = length + 1
        mean = np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(mean / (1 - mean)) + self.base)))


def fit(features: np.ndarray, length: np.ndarray, first: np.ndarray, label: np.ndarray, rounds: int = 160, ridge: float = 1e-3) -> LineCrf:
    """Maximum likelihood by Adam; every line of a labelled document bears its label. Both labels weigh the same."""
    shift, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    shift[-1], scale[-1] = 0, 1
    x = ((features - shift) / scale).astype(np.float64)
    crf = LineCrf(np.zeros(x.shape[1]), np.array([[0.5, -0.5], [-0.5, 0.5]]), scale, shift)
    sizes = np.diff(first)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    share = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
    line = (share / sizes)[doc]
    y = label[doc].astype(np.float64)
    inner = np.ones(len(x), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    m, v = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
    for t in range(1, rounds + 1):
        alpha, beta, score, norm, good = crf._passes(x @ crf.weights, first)
        gw = x.T @ (line * (good - y)) + ridge * crf.weights
        pair = np.exp(alpha[at - 1][:, :, None] + crf.moves + (beta[at] + score[at])[:, None, :] - norm[at][:, None, None])
        gm = (pair * line[at][:, None, None]).sum(axis=0) + 0.05 * crf.moves
        for lab in (0, 1):
            gm[lab, lab] -= line[at][y[at] == lab].sum()
        g = np.concatenate([gw, gm.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.08 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        crf.weights = crf.weights - step[:-4]
        crf.moves = crf.moves - step[-4:].reshape(2, 2)
    good = crf.marginals(features, first)
    mean = np.add.reduceat(good * (length + 1), first[:-1]) / np.add.reduceat(length + 1, first[:-1])
    odds = np.log(np.clip(mean, 1e-6, 1 - 1e-6) / (1 - np.clip(mean, 1e-6, 1 - 1e-6)))
    for _ in range(40):  # Newton steps of a logistic calibration on the true proportions
        p = 1 / (1 + np.exp(-(crf.slope * odds + crf.base)))
        w = p * (1 - p) + 1e-9
        grad = np.array([((p - label) * odds).sum() + 0.01 * (crf.slope - 1), (p - label).sum() + 0.01 * crf.base])
        hess = np.array([[(w * odds * odds).sum() + 0.01, (w * odds).sum()], [(w * odds).sum(), w.sum() + 0.01]])
        crf.slope, crf.base = np.array([crf.slope, crf.base]) - np.linalg.solve(hess, grad)
    return crf


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = MAX_DOCS, max_lines: int = MAX_LINES) -> LineCrf | None:
    """Fit on at most ``max_docs`` labelled documents, spread by a hash of their ids, so on bounded data whatever
    the input's size; documents of more than ``max_lines`` lines are left to scoring. Null labels and ids are passed over, and so are
    ids that are labelled both good and bad.
    Without documents of both labels there is no model (None), and every score is 0.5.
    """
    known = labels.select(F.col(id_col).alias("doc"), F.col(label_col).cast("int").alias("label")).filter("doc IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("doc").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most").drop("most")
    known = F.broadcast(some(known, max_docs, "doc"))  # max_docs rows at most, so no text is shuffled
    text = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chosen = text.join(known, "doc").filter(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) < max_lines).limit(max_docs)

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in tx.parts(batch.column(1)):
                x, length, first = line_features(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()), pa.array([length[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                    ["label", "x", "length"],
                )

    rows = chosen.select("label", "text").mapInArrow(run, "label int, x binary, length binary").collect()
    label = np.array([r["label"] for r in rows], np.int64)
    if len(set(label.tolist())) < 2:
        return None
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, 3 * _OWN + 1) for r in rows]
    length = [np.frombuffer(r["length"], np.float64) for r in rows]
    return fit(np.concatenate(x), np.concatenate(length), np.concatenate([[0], np.cumsum([len(r) for r in length])]), label)


def score(docs: DataFrame, model: LineCrf | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the column ``score_col`` (double, 0 to 1) last; a column of that name is replaced.

    Whole texts are scored, in one pass over the rows. Null and empty texts are one empty line.
    """
    docs = docs.drop(score_col)
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            out = np.full(len(batch), 0.5)
            if model is not None:
                for i, j, data, offsets in tx.parts(batch.column(place)):
                    out[i:j] = model.documents(*line_features(data, offsets))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, score_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))
