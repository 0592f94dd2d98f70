"""Toxicity by a factorization machine over hashed terms (Rendle 2010).

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), x_i: term i occurs.  The
pairwise part lets two terms mean together what neither means alone.  The machine is
fitted with Adam on the driver, on a bounded sample of labelled documents; scoring is one
pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import extended, importable
from siltstone.llm.terms import TERM_BITS, Sample, batch_terms, labelled_sample, telling_terms

SAMPLE_BOUND = 20_000
THRESHOLD = 0.7


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class FactorizationMachine:
    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, row: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """Scores of rows 0..n-1 from (row, feature index) pairs."""
        z = self.bias + np.bincount(row, weights=self.weights[feature], minlength=n)
        for v in self.factors.T:
            s = np.bincount(row, weights=v[feature], minlength=n)
            z += 0.5 * (s * s - np.bincount(row, weights=v[feature] ** 2, minlength=n))
        return _sigmoid(z)


def fit_machine(sample: Sample, rank: int = 6, epochs: int = 30, rate: float = 0.03, l2: float = 2e-4, batch: int = 256, weight: float = 2.0, seed: int = 7) -> FactorizationMachine:
    """Fits the machine, label 1 counting ``weight`` times; with one class only or no telling term it scores the share of label 1."""
    y, chosen = sample.y, telling_terms(sample, 2)
    share = (float(np.sum(y == 1)) + 0.5) / (len(y) + 1)
    bias, n, f = float(np.log(share / (1 - share))), len(y), len(chosen)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(f, np.float32), rng.normal(0, 0.05, (f, rank)).astype(np.float32)
    if not f or not n:
        return FactorizationMachine(chosen, bias, w, v)
    row, feature = sample.select(chosen)
    edges = np.searchsorted(row, np.arange(n + 1))
    params = [np.array([bias], np.float32), w, v]
    cost = np.where(y == 1, weight, 1.0).astype(np.float32)
    m, s = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        lr = rate * (1 - epoch / epochs)
        for at in range(0, n, batch):
            pick = order[at : at + batch]
            size = edges[pick + 1] - edges[pick]
            x = np.zeros((len(pick), f), np.float32)
            take = np.repeat(edges[pick] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            x[np.repeat(np.arange(len(pick)), size), feature[take]] = 1
            b, w, v = params
            xv = x @ v
            z = b[0] + x @ w + 0.5 * (xv * xv - x @ (v * v)).sum(1)
            g = (cost[pick] * (_sigmoid(z) - (y[pick] == 1)) / len(pick)).astype(np.float32)
            xg = x.T @ g
            grads = [np.array([g.sum()]), xg + l2 * w, x.T @ (g[:, None] * xv) - xg[:, None] * v + l2 * v]
            step += 1
            for p, q, a, c in zip(params, grads, m, s):
                a += 0.1 * (q - a)
                c += 0.001 * (q * q - c)
                p -= lr * (a / (1 - 0.9**step)) / (np.sqrt(c / (1 - 0.999**step)) + 1e-8)
    return FactorizationMachine(chosen, float(params[0][0]), params[1], params[2])


def learn_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic", where: Column | None = None, bound: int = SAMPLE_BOUND) -> FactorizationMachine:
    """Learns from at most ``bound`` labelled documents, those with the lowest id hashes.

    ``where``: condition on ``labels`` that a row must meet.  Only texts and labels enter
    the machine.  Null labels and labels without a document are left out.
    """
    rows = labels if where is None else labels.where(where)
    return fit_machine(labelled_sample(docs, rows.select(rows[label_id_col], rows[label_col].cast("int").alias("_y")), id_col, text_col, label_id_col, bound))


def score_toxicity(docs: DataFrame, machine: FactorizationMachine, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Every column of ``docs`` plus the score (a column of that name is replaced).

    Whole texts count.  Null and empty texts get the score of a text without any
    known term.  Repeated rows get equal scores; an empty table stays empty.
    """
    importable(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() != score_col.lower()]
    wanted = np.zeros(1 << TERM_BITS, bool)
    wanted[machine.terms] = True
    flags = np.flatnonzero(wanted)

    def run(batches):
        known = np.zeros(1 << TERM_BITS, bool)
        known[flags] = True
        for b in batches:
            out = np.zeros(b.num_rows)
            for i, j, text, term in batch_terms(b.column(b.schema.get_field_index(text_col)), wanted=known):
                out[i:j] = machine.scores(text, np.searchsorted(machine.terms, term), j - i)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], names=[*b.schema.names, score_col])

    rows = docs.select(*[docs[c] for c in keep])
    return rows.mapInArrow(run, extended(rows, f"`{score_col}` double"))


def reject_toxic(docs: DataFrame, machine: FactorizationMachine, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents that score below ``threshold``, with the columns of ``docs``."""
    return score_toxicity(docs, machine, text_col, "_toxicity").where(F.col("_toxicity") < threshold).select(*docs.columns)
