"""Language-model scores from a log-bilinear neural model.

Tokens are words and one end for each text.  The model's symbols are the most frequent
words, the end, and classes of all other words (by their last bytes); their number grows with
the root of the counted tokens.  It predicts the next symbol from the last ``CONTEXT`` ones (Mnih & Hinton 2007,
with diagonal context weights): s(w | c) = r_w . sum_i c_i * e_i + b_w.  Symbols in order of frequency
form groups of a little more than the root of their number, and the probability is that of the group (a head of its
own on the same context) times that within the group, so a softmax costs two roots.
Training is noise-contrastive estimation in numpy with shared noise samples (an exact softmax for the groups), over every training
text: a round's texts are dealt by hash into parts, each part trains a copy from common parameters over all its texts in an order
of their hashes, and copies are averaged in a fixed order, a symbol's rows by how often each copy met it.  The number of parts
follows from the corpus, so scores don't depend on how the table is partitioned.  The number of rounds grows with the logarithm of the tokens.
Scoring normalises exactly; a word outside the symbols shares its class's probability by
its count plus one.  Counts cover all training texts; only the model and summaries of its size
reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm import slices as S
from siltstone.llm.common import arrow_type, crc_remainder, cut, view
from siltstone.llm.kernels import LOWER, U, chunks, flatten, prefix_hashes, segments_to_rows, span_hashes, words

CLASSES, CONTEXT, DIM = 63, 4, 24
#: The least number of symbols; the last ones are the classes and the end.
SYMBOLS = 256
NOISE, BATCH = 48, 1024
#: Tokens that follow each other in a batch: they share their contexts' rows.
RUN = 32
PART_TOKENS = 1 << 20
#: Below so many training tokens every round sees all of them.
FEW_TOKENS = 1 << 22
_BLOCK_DDL = "_b int, _h binary, _c binary, _k binary"
_BLOCK = pa.schema([("_b", pa.int32()), ("_h", pa.binary()), ("_c", pa.binary()), ("_k", pa.binary())])


def symbols_for(tokens: int) -> int:
    """A power of two, near the root of the number of tokens."""
    return max(SYMBOLS, 1 << (max(1, tokens).bit_length() // 2))


def part_tokens(symbols: int) -> int:
    """Tokens that one copy learns from in a round: a few MB of text, or ten times the size of a copy if that is more."""
    return max(PART_TOKENS, 10 * symbols * (2 * DIM + 2) * 4 // 6)


def rounds_for(tokens: int) -> int:
    return max(3, tokens.bit_length() - 20)


def group_width(symbols: int) -> int:
    """Symbols of a group: two to four times as many as groups, whose head costs most of a step."""
    return 1 << ((symbols.bit_length() + 1) // 2)


def _words(column):
    """For bounded runs of texts: first and last text, hashes and classes of words, index of each text's first word."""
    buf, offsets = flatten(column)
    for i, j in chunks(offsets):
        part, at = LOWER[buf[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = words(part, at)
        tail = np.maximum(starts, ends - 3)
        total = prefix_hashes(part)
        yield i, j, span_hashes(part, starts, ends, total), (span_hashes(part, tail, ends, total) % U(CLASSES)).astype(np.uint8), first


def _tally(h, k, n):
    """Sums counts of equal hashes."""
    order = np.argsort(h, kind="stable")
    h, k, n = h[order], k[order], n[order]
    new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[new], k[new], np.add.reduceat(n, new) if len(new) else n


def _blocks_of(h, k, n, blocks):
    edges = np.searchsorted((h >> U(64 - blocks.bit_length() + 1)).astype(np.int64), np.arange(blocks + 1))
    return [(int(b), h[a:z].tobytes(), n[a:z].astype(np.int64).tobytes(), k[a:z].tobytes()) for b, a, z in ((b, edges[b], edges[b + 1]) for b in np.flatnonzero(np.diff(edges)))]


def _count(blocks: int):
    def run(batches):
        """Tallies of some 2M words at a time, in blocks."""
        got, size = [], 0

        def tallied():
            h, k, n = _tally(np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got]), np.ones(size, np.int64))
            out = _blocks_of(h, k, n, blocks)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _BLOCK)], schema=_BLOCK)

        for b in batches:
            for _, _, h, k, _ in _words(b.column(b.schema.get_field_index("_text"))):
                got.append((h, k))
                size += len(h)
                if size >= 1 << 21:
                    yield tallied()
                    got, size = [], 0
        if size:
            yield tallied()

    return run


def _add(t: pa.Table) -> pa.Table:
    h = np.concatenate([np.frombuffer(x.as_py(), U) for x in t["_h"]])
    n = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in t["_c"]])
    k = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in t["_k"]])
    h, k, n = _tally(h, k, n)
    return S.table_of(_BLOCK, [[t["_b"][0].as_py()], [h.tobytes()], [n.tobytes()], [k.tobytes()]])


def _summary(blocks: int):
    # Hashes spread evenly, so a block holds its share of the most frequent words; four times that and some more lose none.
    most = 192 + 4 * symbols_for(blocks * S.FAN_IN * S.SLICE_BYTES) // blocks

    def run(batches):
        """The most frequent words of each block, and its sums by class (hash null)."""
        for b in batches:
            for row in b.to_pylist():
                h, n, k = np.frombuffer(row["_h"], np.int64), np.frombuffer(row["_c"], np.int64), np.frombuffer(row["_k"], np.uint8)
                top = np.lexsort((h, -n))[:most]
                tokens = np.bincount(k, weights=n, minlength=CLASSES).astype(np.int64)
                types = np.bincount(k, minlength=CLASSES)
                live = np.flatnonzero(types)
                yield pa.RecordBatch.from_arrays([pa.array([*h[top].tolist(), *[None] * len(live)], pa.int64()), pa.array([*k[top].tolist(), *live.tolist()], pa.int32()), pa.array([*n[top].tolist(), *tokens[live].tolist()], pa.int64()), pa.array([*[1] * len(top), *types[live].tolist()], pa.int64())], names=["h", "k", "n", "v"])

    return run


@dataclass
class Lexicon:
    """Symbols and counts."""

    size: int  # symbols
    top: np.ndarray  # sorted hashes
    rank: np.ndarray  # their places by frequency
    top_counts: np.ndarray  # by frequency
    class_tokens: np.ndarray  # without the top words
    class_types: np.ndarray
    ends: int
    tokens: int
    types: int

    @property
    def end(self) -> int:
        return self.size - 1

    @property
    def first_class(self) -> int:
        return self.size - 1 - CLASSES

    def symbols(self, h: np.ndarray, k: np.ndarray) -> np.ndarray:
        if not len(self.top):
            return self.first_class + k.astype(np.int64)
        at = np.searchsorted(self.top, h)
        at[at == len(self.top)] = 0
        return np.where(self.top[at] == h, self.rank[at], self.first_class + k.astype(np.int64))

    def unigram(self) -> np.ndarray:
        p = np.zeros(self.size)
        p[: len(self.top)] = self.top_counts
        p[self.first_class : self.end] = self.class_tokens + self.class_types
        p[self.end] = self.ends
        p[self.first_class :] += 1
        return p / p.sum()


@dataclass
class Model:
    e: np.ndarray
    c: np.ndarray
    r: np.ndarray
    b: np.ndarray
    gr: np.ndarray  # of groups of symbols
    gb: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.e, self.c, self.r, self.b, self.gr, self.gb]

    def _query(self, context: np.ndarray) -> np.ndarray:
        q = self.c[0] * self.e[context[:, 0]]
        for i in range(1, CONTEXT):
            q += self.c[i] * self.e[context[:, i]]
        return q

    def log_probs(self, context: np.ndarray) -> np.ndarray:
        """Normalised log-probabilities of all symbols, a row for each context (most recent symbol first)."""
        q = self._query(context)

        def normal(s):
            s = s - s.max(axis=-1, keepdims=True)
            return s - np.log(np.exp(s).sum(axis=-1, keepdims=True))

        within = normal((q @ self.r.T + self.b).reshape(len(q), len(self.gb), -1))
        return (normal(q @ self.gr.T + self.gb)[:, :, None] + within).reshape(len(q), -1)

    def log_prob(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        out = np.empty(len(symbol), np.float64)
        width = len(self.b) // len(self.gb)
        for a in range(0, len(symbol), 1 << 16):
            q, w = self._query(context[a : a + (1 << 16)]), symbol[a : a + (1 << 16)].astype(np.int64)
            group = w // width
            order = np.argsort(group, kind="stable")
            q, w, group = q[order], w[order], group[order]
            p = np.empty(len(w), np.float64)
            for z in range(0, len(w), 4096):
                p[z : z + 4096] = _own(q[z : z + 4096], self.gr, self.gb, group[z : z + 4096])
            edges = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(group)]))
            for i, j in zip(edges[:-1], edges[1:]):
                first = group[i] * width
                for z in range(i, j, 4096):
                    part = slice(z, min(z + 4096, j))
                    p[part] += _own(q[part], self.r[first : first + width], self.b[first : first + width], w[part] - first)
            out[a + order] = p
        return out


def _own(q: np.ndarray, r: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log of the softmax at one place a row."""
    s = q @ r.T
    s += b
    mine = s[np.arange(len(s)), at].astype(np.float64)
    total, top = _exp_sums(s)
    return mine - top - np.log(total.astype(np.float64))


def start(unigram: np.ndarray, seed: int = 5) -> Model:
    rng = np.random.default_rng(seed)
    f, n = np.float32, len(unigram)
    group = unigram.reshape(-1, group_width(n)).sum(1)
    e, r, gr = (rng.normal(0, sd, (k, DIM)).astype(f) for sd, k in ((0.3, n), (0.05, n), (0.05, len(group))))
    return Model(e, np.ones((CONTEXT, DIM), f) / CONTEXT, r, np.log(np.maximum(unigram, 1e-12)).astype(f), gr, np.log(np.maximum(group, 1e-12)).astype(f))


def _descend(parameters: list, sums: list, at: np.ndarray, gradients: list, rate: float) -> None:
    """An Adagrad step for the rows ``at``, which may repeat."""
    order = np.argsort(at, kind="stable")
    a = at[order]
    new = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    a = a[new].astype(np.intp)
    for p, s, g in zip(parameters, sums, gradients):
        d = np.add.reduceat(g[order], new, axis=0)
        now = s[a] + d * d
        s[a] = now
        np.sqrt(now, out=now)
        d *= rate
        d /= now
        p[a] -= d


def _exp_sums(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Makes exp of all scores in place, less their row's greatest if it could overflow or vanish; sums of rows, and what was taken off."""
    ones, top = np.ones(s.shape[1], s.dtype), np.zeros(len(s), s.dtype)
    if len(s) and not (s.max() < 60 and s[:, 0].min() > -60):
        top = s.max(axis=1)
        s -= top[:, None]
    np.exp(s, out=s)
    return s @ ones, top


def train(model: Model, context: np.ndarray, symbol: np.ndarray, unigram: np.ndarray, seed: int, rate: float = 0.15, sums: list | None = None) -> Model:
    """``train_runs`` on tokens that each have a context (most recent symbol first) of their own."""
    runs = np.concatenate((context[:, ::-1].astype(np.int64), np.asarray(symbol, np.int64)[:, None]), axis=1)
    return train_runs(model, runs, np.ones((len(runs), 1), bool), unigram, seed, rate, sums)


def train_runs(model: Model, runs: np.ndarray, told: np.ndarray, unigram: np.ndarray, seed: int, rate: float = 0.15, sums: list | None = None) -> Model:
    """One pass of noise-contrastive estimation with Adagrad; gives new parameters.  ``sums`` (empty at first) carries Adagrad's state on.

    A row of ``runs`` holds ``CONTEXT`` symbols and then those to be learned, but for those not ``told``. Runs come in random order.
    """
    rng = np.random.default_rng(seed)
    e, c, r, b, gr, gb = (x.copy() for x in model.arrays())
    sums = [] if sums is None else sums
    if not sums:
        sums += [np.full(x.shape, 1e-2, np.float32) for x in (e, c, r, b, gr, gb)]
    log_noise = np.log(np.maximum(NOISE * unigram, 1e-12)).astype(np.float32)
    law, width = np.cumsum(unigram), len(b) // len(gb)
    small = np.uint16 if len(b) <= 1 << 16 else np.uint32  # 16 bits are sorted by radix
    length = runs.shape[1] - CONTEXT
    order = rng.permutation(len(runs))
    each = max(1, BATCH // length)
    mixed, cells = np.zeros((CONTEXT, DIM, DIM), np.float32), (slice(None), np.arange(DIM), np.arange(DIM))
    spans = [slice(CONTEXT - 1 - i, CONTEXT - 1 - i + length) for i in range(CONTEXT)]  # places of each token's i-th symbol before it
    for a in range(0, len(order), each):
        pick = order[a : a + each]
        y, ok = runs[pick], told[pick].ravel()
        x, w = y[:, :-1], y[:, CONTEXT:].ravel()
        noise = np.minimum(np.searchsorted(law, rng.random(NOISE)), len(b) - 1)
        emb = e[x]  # run, place, dim
        near = np.empty((len(y), length, CONTEXT, DIM), np.float32)
        for i, span in enumerate(spans):
            near[:, :, i] = emb[:, span]
        near = near.reshape(-1, CONTEXT * DIM)
        mixed[cells] = c  # products with zeros cost less than passes over strided rows
        q, live = near @ mixed.reshape(-1, DIM), None
        if not ok.all():
            live = np.flatnonzero(ok)
            q, w = q[live], w[live]
        n = len(w)
        if not n:
            continue
        rw, rn = r[w], r[noise]
        g = np.einsum("bd,bd->b", q, rw) + b[w] - log_noise[w]
        g = (1 / (1 + np.exp(-g)) - 1) / np.float32(n)
        gn = q @ rn.T
        gn += b[noise] - log_noise[noise]
        np.negative(gn, out=gn)
        np.exp(gn, out=gn)
        gn += 1
        np.divide(np.float32(1 / n), gn, out=gn)
        gg = q @ gr.T
        gg += gb
        total, _ = _exp_sums(gg)
        gg *= (np.float32(1 / n) / total)[:, None]
        gg[np.arange(n), w // width] -= np.float32(1 / n)
        dq = gn @ rn
        dq += gg @ gr
        dq += g[:, None] * rw
        at = np.concatenate((w, noise)).astype(small)
        _descend([r, b], sums[2:4], at, [np.concatenate((g[:, None] * q, gn.T @ q)), np.concatenate((g, gn.sum(0)))], rate)
        dgr, dgb = gg.T @ q, gg.sum(0)
        if live is not None:
            every = np.zeros((len(ok), DIM), np.float32)
            every[live] = dq
            dq = every
        dc = (near.T @ dq).reshape(mixed.shape)[cells]
        back = (dq @ mixed.reshape(-1, DIM).T).reshape(len(y), length, CONTEXT, DIM)
        de = np.zeros_like(emb)
        for i, span in enumerate(spans):
            de[:, span] += back[:, :, i]
        _descend([e], sums[:1], x.ravel().astype(small), [de.reshape(-1, DIM)], rate)
        for p, d, s in ((c, dc, sums[1]), (gr, dgr, sums[4]), (gb, dgb, sums[5])):
            s += d * d
            p -= rate * d / np.sqrt(s)
    return Model(e, c, r, b, gr, gb)


def runs_of(texts: list[np.ndarray], end: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of texts (each with its end) as runs for ``train_runs``, each token once, with the contexts that ``contexts`` gives."""
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate(([0], np.cumsum(size))) + CONTEXT * np.arange(len(texts) + 1)  # ends before each text, and after the last
    tokens = int(begin[-1]) + 1 - CONTEXT
    rows = -(-tokens // length)
    sym, told = np.full(CONTEXT + rows * length, end, np.int64), np.zeros(CONTEXT + rows * length, bool)
    word = np.arange(int(size.sum())) + CONTEXT * np.repeat(np.arange(1, len(texts) + 1), size)
    sym[word] = np.concatenate(texts) if len(texts) else []
    told[word] = told[begin[1:]] = True
    at = np.arange(rows)[:, None] * length + np.arange(CONTEXT + length)
    return sym[at], told[at[:, CONTEXT:]]


def contexts(sym: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and symbols of all tokens, with ``end`` put after each text, and the index of each text's first token."""
    n = len(first) - 1
    sym = np.insert(sym, first[1:], end).astype(np.int32)
    begin = first + np.arange(n + 1)
    lead = np.arange(len(sym)) - np.repeat(begin[:-1], np.diff(begin))
    context = np.full((len(sym), CONTEXT), end, np.int32)  # before a text: as after one
    for i in range(CONTEXT):
        context[i + 1 :, i] = np.where(lead[i + 1 :] > i, sym[: len(sym) - i - 1], end)
    return context, sym, begin


def sequence(h: np.ndarray, k: np.ndarray, first: np.ndarray, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return contexts(lexicon.symbols(h, k), first, lexicon.end)


def _pack(m: Model, met: np.ndarray) -> bytes:
    return b"".join(x.astype("<f4").tobytes() for x in (*m.arrays(), met))


def _unpack(data: bytes, size: int) -> tuple[Model, np.ndarray]:
    """A model and how often each symbol was met."""
    groups = size // group_width(size)
    shapes = [(size, DIM), (CONTEXT, DIM), (size, DIM), (size,), (groups, DIM), (groups,), (size,)]
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    *parts, met = [x.reshape(s) for x, s in zip(np.split(np.frombuffer(data, "<f4"), ends[:-1]), shapes)]
    return Model(*parts), met


def _encoder(lexicon: Lexicon):
    """Symbols of each text (not its end), as two or four bytes each."""
    kind = np.uint16 if lexicon.size <= 1 << 16 else np.uint32

    def run(batches):
        for b in batches:
            part, key = (b.column(b.schema.get_field_index(c)) for c in ("_part", "_key"))
            for i, j, h, k, first in _words(b.column(b.schema.get_field_index("_text"))):
                raw, width = lexicon.symbols(h, k).astype(kind).tobytes(), kind().itemsize
                ends = (first * width).tolist()
                yield pa.RecordBatch.from_arrays([part[i:j], key[i:j], pa.array([raw[a:z] for a, z in zip(ends, ends[1:])], pa.binary())], names=["_part", "_key", "_y"])

    return run, kind


def _trainer(model: Model, lexicon: Lexicon, seed: int, kind=np.uint16):
    unigram = lexicon.unigram()

    def run(batches):
        """Trains a copy of ``model`` on each part (rows come by part), by some 400,000 tokens at a time."""
        part, mine, sums, met, tokens = None, model, [], None, 0
        pending, size = [], 0

        def learn():
            nonlocal mine, tokens, met, pending, size
            runs, told = runs_of([np.frombuffer(x, kind) for x in pending], lexicon.end, RUN)
            mine = train_runs(mine, runs, told, unigram, seed + tokens + size, sums=sums)
            met += np.bincount(runs[:, CONTEXT:][told], minlength=lexicon.size)
            tokens += size
            pending, size = [], 0

        def result():
            return pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([_pack(mine, met)], pa.binary()), pa.array([part], pa.int32())], names=["n", "m", "g"])

        for b in batches:
            for p, y in zip(b.column(b.schema.get_field_index("_part")).to_pylist(), b.column(b.schema.get_field_index("_y"))):
                if p != part:
                    if size:
                        learn()
                    if tokens:
                        yield result()
                    part, mine, sums, met, tokens = p, model, [], np.zeros(lexicon.size, np.int64), 0
                y = y.as_py()
                pending.append(y)
                size += len(y) // kind().itemsize + 1
                if size >= 400_000:
                    learn()
        if size:
            learn()
        if tokens:
            yield result()

    return run


def _averager(size: int):
    def run(t: pa.Table) -> pa.Table:
        """Mean of copies: by tokens, and a symbol's rows by how often the copy met it.  In order of parts, as sums of floats depend on it."""
        t, total, sums, met = t.sort_by("g"), 0, None, np.zeros(size)
        for n, data in zip(t["n"].to_pylist(), t["m"]):
            m, seen = _unpack(data.as_py(), size)
            by = seen.astype(np.float64) + n * 1e-9  # a symbol met by no copy: by tokens
            weighted = [x * (by[:, None] if x.ndim == 2 else by) if i in (0, 2, 3) else x * np.float64(n) for i, x in enumerate(m.arrays())]
            sums = weighted if sums is None else [a + b for a, b in zip(sums, weighted)]
            total, met = total + n, met + seen
        by = met + total * 1e-9
        mean = Model(*[x / (by[:, None] if x.ndim == 2 else by) if i in (0, 2, 3) else x / total for i, x in enumerate(sums)])
        return pa.table({"n": pa.array([total], pa.int64()), "m": pa.array([_pack(mean, met)], pa.binary()), "g": t["g"].slice(0, 1).cast(pa.int32())})

    return run


def _round(rows: DataFrame, parts: int, model: Model, lexicon: Lexicon, seed: int) -> Model:
    """Trains a copy on each part of ``rows`` (``_key``, ``_text``) and averages them, at most 16 in a task."""
    ddl = "n bigint, m binary, g int"
    encode, kind = _encoder(lexicon)
    dealt = rows.select(F.pmod("_key", F.lit(parts)).cast("int").alias("_part"), "_key", "_text")
    coded = dealt.mapInArrow(encode, "_part int, _key bigint, _y binary")
    # a part is in one task, which meets its texts in an order of their own
    copies = coded.repartitionById(parts, F.col("_part")).sortWithinPartitions("_part", "_key", "_y").mapInArrow(_trainer(model, lexicon, seed, kind), ddl)
    average, width = _averager(lexicon.size), 16
    while width < 16 * parts:
        copies = copies.withColumn("_w", F.floor(F.col("g") / width)).groupBy("_w").applyInArrow(average, ddl)
        width *= 16
    got = copies.collect()  # one
    return _unpack(got[0]["m"], lexicon.size)[0] if got else model


def _ask(blocks: int):
    schema = pa.schema([("_s", pa.int32()), ("_b", pa.int32()), ("_h", pa.binary())])

    def run(t: pa.Table) -> pa.Table:
        got = [h for _, _, h, _, _ in _words(t["_text"])]
        h = np.unique(np.concatenate(got)) if got else np.zeros(0, U)
        edges = np.searchsorted((h >> U(64 - blocks.bit_length() + 1)).astype(np.int64), np.arange(blocks + 1))
        s = t["_s"][0].as_py()
        live = np.flatnonzero(np.diff(edges))
        return S.table_of(schema, [[s] * len(live), live.tolist(), [h[edges[b] : edges[b + 1]].tobytes() for b in live]])

    return run, "_s int, _b int, _h binary"


def _answer(asked: pa.Table, counts: pa.Table) -> pa.Table:
    """For each slice its known words and their counts."""
    schema = pa.schema([("_s", pa.int32()), ("_h", pa.binary()), ("_c", pa.binary())])
    out = []
    if asked.num_rows and counts.num_rows:
        h, n = np.frombuffer(counts["_h"][0].as_py(), U), np.frombuffer(counts["_c"][0].as_py(), np.int64)
        for s, x in zip(asked["_s"].to_pylist(), asked["_h"]):
            x = np.frombuffer(x.as_py(), U)
            at = np.searchsorted(h, x)
            at[at == len(h)] = 0
            ok = h[at] == x
            if ok.any():
                out.append((s, x[ok].tobytes(), n[at[ok]].tobytes()))
    return S.table_of(schema, list(zip(*out)) if out else [[]] * 3)


def _scorer(model: Model, lexicon: Lexicon, id_type: pa.DataType):
    schema = pa.schema([("_id", id_type), ("_train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        docs = docs.sort_by("_k")  # matrix products round by their rows' places
        known = np.concatenate([np.frombuffer(x.as_py(), U) for x in side["_h"]]) if side.num_rows else np.zeros(0, U)
        counts = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in side["_c"]]) if side.num_rows else np.zeros(0, np.int64)
        order = np.argsort(known)
        known, counts = known[order], counts[order]
        bottom = lexicon.tokens + lexicon.types + 1
        room = np.log((lexicon.class_tokens + lexicon.class_types + 1).astype(np.float64))
        n_tokens, n_known, base, score = [], [], [], []
        for i, j, h, k, first in _words(docs["_text"]):
            c = np.zeros(len(h), np.int64)
            if len(known):
                at = np.searchsorted(known, h)
                at[at == len(known)] = 0
                c = np.where(known[at] == h, counts[at], 0)
            x, w, begin = sequence(h, k, first, lexicon)
            c = np.insert(c, first[1:], lexicon.ends)
            kind = np.insert(k, first[1:], 0)
            log_p = model.log_prob(x, w)
            rest = (w >= lexicon.first_class) & (w < lexicon.end)
            log_p[rest] += np.log(c[rest] + 1.0) - room[kind[rest]]
            sums = lambda v: np.add.reduceat(v, begin[:-1])  # noqa: E731  every text has its end at least
            n_tokens.append(np.diff(begin))
            n_known.append(sums((c > 0).astype(np.int64)))
            base.append(sums(np.log10((c + 1.0) / bottom)))
            score.append(sums(log_p) / np.log(10))
        cat = lambda v: np.concatenate(v) if v else []
        return pa.Table.from_arrays([docs["_id"], docs["_train"], pa.array(cat(n_tokens), pa.int64()), pa.array(cat(n_known), pa.int64()), pa.array(cat(base), pa.float64()), pa.array(cat(score), pa.float64())], schema=schema)

    return run


def learn_counts(training: DataFrame, blocks: int) -> tuple[DataFrame, Lexicon]:
    """Exact counts of all words of ``_text``, in blocks of the hash range, and what of them the driver needs."""
    counts = cut(training.select("_text").mapInArrow(_count(blocks), _BLOCK_DDL).groupBy("_b").applyInArrow(_add, _BLOCK_DDL))
    ends = training.count()
    summary = cut(counts.mapInArrow(_summary(blocks), "h bigint, k int, n bigint, v bigint"))
    sums = {r["k"]: r for r in summary.where("h is null").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()}
    tokens, types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for k, r in sums.items():
        tokens[k], types[k] = r["n"], r["v"]
    total, kinds = int(tokens.sum()) + ends, int(types.sum()) + (ends > 0)
    size = symbols_for(total)
    top = summary.where("h is not null").orderBy(F.desc("n"), "h").limit(size - 1 - CLASSES).collect()
    for r in top:
        tokens[r["k"]] -= r["n"]
        types[r["k"]] -= 1
    h = np.array([r["h"] for r in top], np.int64).view(U)
    order = np.argsort(h)
    return counts, Lexicon(size, h[order], order, np.array([r["n"] for r in top], np.int64), tokens, types, ends, total, kinds)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_where: Column | None = None) -> DataFrame:
    """Scores whole texts by a model of the training texts.

    ``train_where``: condition on ``docs`` (null: false) for texts to learn from; all by default.
    A-Z are lower-cased; tokens are words and one end a text.  One row per input row: the id column,
    ``trained`` (it was learned from), ``n_tokens``, ``n_known`` (tokens seen in training), ``train_tokens``,
    ``base_score`` (unigram log10 probability, add-one) and ``score`` (the model's).

    The model trains in rounds on shares of the training texts, by hash, and on all of them in each round if there are
    few (``FEW_TOKENS``).  Scores depend on the rows alone, not on their order or partitions.
    Null or empty text: an end alone.  Null ids pass; repeated rows each count.
    Without training texts the model is uniform.  An empty table gives
    an empty result; other columns are ignored.
    """
    train_where = F.lit(True) if train_where is None else F.coalesce(train_where, F.lit(False))
    base = view(docs, id_col, text_col)
    rows = docs.select(docs[id_col].alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"), train_where.alias("_train"))
    plan = S.plan(base)
    n = plan.blocks
    training = rows.where("_train")
    counts, lexicon = learn_counts(training, n)
    model = start(lexicon.unigram())
    if lexicon.ends:
        rounds = rounds_for(lexicon.tokens)
        few = lexicon.tokens < FEW_TOKENS
        parts = max(4, -(-lexicon.tokens // (1 if few else rounds) // part_tokens(lexicon.size)))
        keyed = training.select(F.xxhash64("_id", "_text", F.lit("training")).alias("_key"), "_text")
        for k in range(rounds):
            mine = keyed if few else keyed.where(F.pmod(F.xxhash64("_key"), F.lit(rounds)) == k)
            model = _round(mine, parts, model, lexicon, k + 1)
    dealt = S.deal(rows, plan).withColumn("_k", F.xxhash64("_id", "_text"))
    ask, ddl = _ask(n)
    asked = dealt.groupBy("_s").applyInArrow(ask, ddl)
    answers = asked.groupBy("_b").cogroup(counts.groupBy("_b")).applyInArrow(_answer, "_s int, _h binary, _c binary")
    out = dealt.groupBy("_s").cogroup(answers.groupBy("_s")).applyInArrow(_scorer(model, lexicon, arrow_type(rows, "_id")), f"_id {rows.schema['_id'].dataType.simpleString()}, _train boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select(F.col("_id").alias(id_col), F.col("_train").alias("trained"), "n_tokens", "n_known", F.lit(lexicon.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
