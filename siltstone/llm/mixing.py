"""Mixing documents to target weights by soft domain membership.

A softmax classifier over hashed terms and shape bins, fitted on a bounded labelled sample,
gives each document's posterior over domains.  Document rates x >= ``least`` minimise
the squared distance (in the metric of (A A')^-1, over the rows that can move) between expected domain tokens A x, with
A[d, i] = p(d | i) tokens_i, and the targets.  Projected gradient steps run on a slim
table: an iteration is one aggregation to as many sums as there are domains, and a document's
rate follows from its own row and the steps taken, so nothing of its size is broadcast
or joined.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import cut, extended, importable
from siltstone.llm.kernels import flatten, words
from siltstone.llm.terms import TERM_BITS, Sample, batch_terms, labelled_sample, telling_terms

SAMPLE_BOUND = 20_000
log = logging.getLogger("siltstone")


@dataclass
class DomainModel:
    terms: np.ndarray
    weights: np.ndarray  # term x domain
    bias: np.ndarray

    def posteriors(self, row: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        z = np.stack([b + np.bincount(row, weights=w[feature], minlength=n) for w, b in zip(self.weights.T, self.bias)], 1)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit_domains(sample: Sample, domains: int, epochs: int = 25, rate: float = 0.02, l2: float = 1e-3, batch: int = 256, seed: int = 9) -> DomainModel:
    """Softmax regression with Adam; without telling terms it gives the labels' shares."""
    y, chosen = sample.y, telling_terms(sample, domains, most=768)
    n, f = len(y), len(chosen)
    bias = np.log((np.bincount(y, minlength=domains)[:domains] + 0.5) / (n + 0.5 * domains))
    w = np.zeros((f, domains))
    if not f:
        return DomainModel(chosen, w, bias)
    row, feature = sample.select(chosen)
    edges = np.searchsorted(row, np.arange(n + 1))
    target = np.eye(domains)[y]
    rng = np.random.default_rng(seed)
    params = [w, bias]
    m, s = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        lr = rate * (1 - epoch / epochs)
        for at in range(0, n, batch):
            pick = order[at : at + batch]
            x = np.zeros((len(pick), f), np.float32)
            for k, d in enumerate(pick):
                x[k, feature[edges[d] : edges[d + 1]]] = 1
            z = x @ params[0] + params[1]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = (z / z.sum(axis=1, keepdims=True) - target[pick]) / len(pick)
            step += 1
            for p, q, a, c in zip(params, (x.T @ g + l2 * params[0], g.sum(0)), m, s):
                a += 0.1 * (q - a)
                c += 0.001 * (q * q - c)
                p -= lr * (a / (1 - 0.9**step)) / (np.sqrt(c / (1 - 0.999**step)) + 1e-8)
    return DomainModel(chosen, params[0], params[1])


def learn_domains(docs: DataFrame, labels: DataFrame, domains: int, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", bound: int = SAMPLE_BOUND) -> DomainModel:
    """Learns from at most ``bound`` labelled documents (lowest id hashes); ``labels`` has its id column and ``_y``, 0 to domains - 1.

    Null ids and labels, labels out of range and labels without a document are left out; of repeated labels the largest
    counts, of documents that repeat an id one.  Null texts count as empty.  Without a labelled document, or where no term tells
    domains apart, the posterior is the labels' share (equal shares without labels); so also for empty tables.
    """
    rows = labels.where(F.col("_y").between(0, domains - 1))
    return fit_domains(labelled_sample(docs, rows, id_col, text_col, label_id_col, bound, shapes=True), domains)


@dataclass
class Rates:
    """Steps of the fit: a row's rate follows from its expected tokens alone."""

    least: float
    steps: list[np.ndarray] = field(default_factory=list)
    reached: np.ndarray | None = None
    targets: np.ndarray | None = None
    converged: bool = True

    def of(self, expected: np.ndarray) -> np.ndarray:
        x = np.ones(len(expected))
        for c in self.steps:
            x = np.maximum(self.least, x + expected @ c)
        return x


def with_membership(docs: DataFrame, model: DomainModel, rates: Rates | None = None, text_col: str = "text") -> DataFrame:
    """Every column of ``docs`` plus ``n_tokens`` (words), ``posterior`` (array) and, with ``rates``, ``rate``."""
    importable(docs.sparkSession)
    added = ["n_tokens", "posterior", *(["rate"] if rates else [])]
    docs = docs.select(*[docs[c] for c in docs.columns if c.lower() not in added])

    def run(batches):
        known = np.zeros(1 << TERM_BITS, bool)
        known[model.terms] = True
        for b in batches:
            text = b.column(b.schema.get_field_index(text_col))
            p = np.zeros((b.num_rows, len(model.bias)))
            for i, j, row, term in batch_terms(text, shapes=True, wanted=known):
                p[i:j] = model.posteriors(row, np.searchsorted(model.terms, term), j - i)
            tokens = np.zeros(b.num_rows, np.int64)
            buf, offsets = flatten(text)
            for a in range(0, b.num_rows, 512):
                z = min(a + 512, b.num_rows)
                tokens[a:z] = np.diff(words(buf[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a])[2])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), p.shape[1]).cast(pa.list_(pa.float64()))
            more = [pa.array(rates.of(p * tokens[:, None]))] if rates else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tokens), lists, *more], names=[*b.schema.names, *added])

    return docs.mapInArrow(run, extended(docs, "n_tokens bigint, posterior array<double>" + (", rate double" if rates else "")))


def fit_rates(docs: DataFrame, model: DomainModel, weights: list[float], total: float | None = None, least: float = 0.0, text_col: str = "text", tolerance: float = 1e-6, iterations: int = 60) -> Rates:
    """Rates whose expected domain tokens match ``weights`` (made to sum to 1) of ``total`` tokens.

    ``total``: by default the tokens of ``docs``; with ``least`` = 1, one at which no
    domain must shrink from where the last step led (near the smallest; as posteriors are soft, what makes one domain grow adds to the
    others, so the total that the shares need isn't known before).  Starts at rate 1 for all.  Where the targets can't be met (a domain without tokens, a total below
    what ``least`` leaves, ``iterations`` too few), the rates come as close as they got, ``converged`` is
    false and a warning is logged.  Null and empty texts have no tokens; repeated rows count each; an empty table has nothing
    to reach: no step is taken.
    """
    share = np.asarray(weights, float) / sum(weights)
    d = len(share)
    member = with_membership(docs.select(docs[text_col]), model, text_col=text_col)
    slim = member.select(*[(F.col("posterior")[k] * F.col("n_tokens")).alias(f"a{k}") for k in range(d)], F.lit(1.0).alias("x"))
    slim = cut(slim.groupBy(*[f"a{k}" for k in range(d)], "x").agg(F.count("*").cast("double").alias("n")))
    names = [f"a{k}" for k in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def squares(n) -> list:
        return [F.sum(F.col(f"a{i}") * F.col(f"a{j}") * n) for i, j in pairs]

    def symmetric(values) -> np.ndarray:
        out = np.zeros((d, d))
        for (i, j), v in zip(pairs, values):
            out[i, j] = out[j, i] = v or 0.0
        return out

    first = slim.agg(*squares(F.col("n")), *[F.sum(F.col(a) * F.col("n")) for a in names]).first()
    gram = symmetric(first)
    reached = np.array([v or 0.0 for v in first[len(pairs) :]])
    grows = total is None and least >= 1
    needed = lambda: max([reached.sum(), *(reached[share > 0] / share[share > 0])])
    if total is None:
        total = needed() if grows else reached.sum()
    rates = Rates(least, targets=share * total)
    metric, free, best = np.linalg.pinv(gram), gram, np.inf
    for k in range(iterations):
        miss = rates.targets - reached
        far = float(miss @ metric @ miss)
        if np.abs(miss).max(initial=0) <= tolerance * max(total, 1):
            break
        # rows at the bound don't move, so the step is measured by the others while that brings the sums closer
        c = np.linalg.pinv(free if far < 0.9 * best else gram) @ miss
        along = lambda c: sum((F.col(a) * F.lit(float(v)) for a, v in zip(names, c)), F.lit(0.0))
        if least >= 1:  # all rows start at the bound, so the step is measured by those that it can move
            can = F.when((F.col("x") > least) | (along(c) > 0), F.col("n")).otherwise(0.0)
            c = np.linalg.pinv(symmetric(slim.agg(*squares(can)).first())) @ miss
        best = min(best, far)
        rates.steps.append(c)
        slim = slim.withColumn("x", F.greatest(F.lit(float(least)), F.col("x") + along(c)))
        if k % 10 == 9:
            slim = cut(slim)
        moved = F.when(F.col("x") > least, F.col("n")).otherwise(0.0)
        got = slim.agg(*[F.sum(F.col(a) * F.col("x") * F.col("n")) for a in names], *squares(moved)).first()
        reached = np.array([v or 0.0 for v in got[:d]])
        free = symmetric(got[d:])
        if grows:
            total = needed()
            rates.targets = share * total
    rates.reached = reached
    rates.converged = bool(np.abs(rates.targets - reached).max(initial=0) <= tolerance * max(total, 1))
    if not rates.converged:
        log.warning("mixing: expected tokens %s, not the targets %s, after %d steps", reached.round(1).tolist(), rates.targets.round(1).tolist(), len(rates.steps))
    return rates


def copies(rate, id_column):
    """Whole copies of a row: the rate rounded down, and one more with the chance of the rest, by a hash of the id."""
    chance = F.pmod(F.xxhash64(F.lit("copies"), id_column), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("bigint")).cast("bigint")


def document_rates(docs: DataFrame, model: DomainModel, rates: Rates, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``n_tokens``, ``posterior``, ``rate`` and ``copies`` of every row.

    Null or empty text: no tokens, so its rate stays at 1 or ``least`` (whichever is
    larger) and its posterior is that of its shape.  Null ids pass; repeated
    rows get equal rates and copies.  An empty table gives an empty result.
    """
    out = with_membership(docs.select(docs[id_col], docs[text_col]), model, rates, text_col)
    return out.select(id_col, "n_tokens", "posterior", "rate", copies(F.col("rate"), F.col(id_col)).alias("copies"))


def mix_documents(docs: DataFrame, model: DomainModel, rates: Rates, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each row as often as its rate says (not at all below 1 by chance), same columns.

    Null and empty texts have no tokens, so they stay once (``least`` times, if that is more). Null ids pass and share one
    chance; repeated rows are repeated alike; an empty table stays empty; columns of any name pass.
    """
    clash = {"n_tokens", "posterior", "rate", "_copy"}
    names = [f"_m{k}" if c.lower() in clash else c for k, c in enumerate(docs.columns)]
    out = with_membership(docs.toDF(*names), model, rates, text_col)
    n = copies(F.col("rate"), F.col(id_col))
    return out.where(n > 0).select(*names, F.explode(F.sequence(F.lit(1).cast("bigint"), n)).alias("_copy")).drop("_copy").toDF(*docs.columns)
