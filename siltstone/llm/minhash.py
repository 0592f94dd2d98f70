"""Near-duplicate texts by improved consistent weighted sampling (Ioffe 2010).

A text is its weighted set of word shingles, weight = term count x idf with
idf = 1 + ln(N / df) / ln(N) (1 to 2; N: different texts, df: those that hold the
shingle).  Each of ``bands * rows`` samples picks a shingle and a level with the
probability of the weighted Jaccard similarity; texts that agree in all samples of a
band share a bucket.  The buckets whose least text is r form the group of r, so
texts that share a bucket share a group, and groups don't chain.  Groups are verified exactly by weighted
Jaccard similarity, and components of the verified links are the classes.

Exact copies count as one text throughout.  df is counted over all texts, by 44 bits of hash
or more (see ``slices``).  A group is verified in two steps.  First all members are compared with r, in chunks, which is linear.
Members below the threshold ("far") may still be linked to each other or to members at it; as 1 - similarity is a
metric, the latter need be no more similar to r than the most similar far one, plus 1 - threshold.
These are compared pair by pair of chunks, but for pairs of which both are linked to r.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import slices as S
from siltstone.llm.common import connected_components, cut, spread_join, view
from siltstone.llm.kernels import U, chunks, flatten, mix, segments_to_rows, span_hashes, window_hashes, words

WORDS, SIMILARITY, BANDS, ROWS = 5, 0.8, 16, 4
#: Shingles that one comparison group holds at most, besides a single text's.
CHUNK_SHINGLES = 300_000
_BITS = 40
_GOLD = 0x9E3779B97F4A7C15
_MESSAGE = pa.schema([("_s", pa.int32()), ("_b", pa.int32()), ("_h", pa.binary()), ("_v", pa.binary())])
_MESSAGE_DDL = "_s int, _b int, _h binary, _v binary"
_pools: list[np.ndarray] = []


def _shingles(t: pa.Table, width: int, keep: set[int]):
    """For each bounded run of texts that ``keep`` names, each once: their rows, and (text, shingle, count) in order of text and shingle."""
    key = np.asarray(t["_r"].combine_chunks())
    buf, offsets = flatten(t["_text"])
    left = set(keep)
    for i, j in chunks(offsets):
        part, at = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = words(part, at)
        item = span_hashes(part, starts, ends)
        (h,), _, base = window_hashes(item, first, width)
        owner = segments_to_rows(np.diff(base))
        n = np.diff(first)
        short = np.flatnonzero((n > 0) & (n < width))
        if len(short):  # a text of fewer words is one shingle
            extra = [int(mix(np.array([sum(int(x) * pow(_GOLD, 2 * k + 1, 1 << 64) for k, x in enumerate(item[first[d] : first[d + 1]])) % (1 << 64)], U))[0]) for d in short]
            h, owner = np.concatenate((h, np.array(extra, U))), np.concatenate((owner, short))
        use = np.zeros(j - i, bool)
        for d, r in enumerate(key[i:j].tolist()):
            if r in left:
                left.remove(r)
                use[d] = True
        mine = use[owner]
        h, owner = h[mine], owner[mine]
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])))) if len(h) else np.zeros(0, np.int64)
        yield i + np.flatnonzero(use), owner[new] + i, h[new], np.diff(np.concatenate((new, [len(h)])))


def _kept(side: pa.Table) -> set[int]:
    return {r for x in side["_keep"].to_pylist() if x for r in x}


def _sketch(width: int, blocks: int):
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        out = []
        if docs.num_rows:
            h = [x[2] for x in _shingles(docs, width, _kept(side))]
            cells = np.sort(np.concatenate(h) if h else np.zeros(0, U))
            s = docs["_s"][0].as_py()
            out = [(s, b, x, None) for b, x in S.send(cells, blocks, _BITS)]
        return S.table_of(_MESSAGE, list(zip(*out)) if out else [[]] * 4)

    return run


def _merge(t: pa.Table) -> pa.Table:
    """Counts the shingles of one hash range; answers with those of two texts or more and 1024 log2 of their counts."""
    s, b = t["_s"].to_pylist(), t["_b"][0].as_py()
    each = [S.unpack(x.as_py(), _BITS) for x in t["_h"]]
    often, n = S.recurring(each)
    code = np.rint(1024 * np.log2(n)).astype(np.uint16)
    out = []
    for k, x in zip(s, each):
        mine = S.at_most(x, 1)
        mine = mine[S.member(mine, often)]
        if len(mine):
            out.append((k, b, S.pack(mine, _BITS), code[np.searchsorted(often, mine)].tobytes()))
    return S.table_of(_MESSAGE, list(zip(*out)) if out else [[]] * 4)


def idf(code: np.ndarray, texts: int) -> np.ndarray:
    """idf from 1024 log2(df)."""
    top = max(np.log(max(texts, 2)), 1e-9)
    return 1 + np.maximum(0, top - code.astype(np.float64) * np.log(2) / 1024) / top


def samples(h: np.ndarray, weight: np.ndarray, edges: np.ndarray, count: int) -> np.ndarray:
    """``count`` consistent weighted samples of each segment ``edges[i]:edges[i+1]`` (none empty, ascending in ``h``), as 32-bit numbers.

    The two gamma variables and the uniform one of a (shingle, sample) are drawn from pools of
    65,536 values by independent bits of its hash.
    """
    if not _pools:
        rng = np.random.default_rng(3)
        r = rng.gamma(2, 1, 1 << 16)
        _pools.extend([r.astype(np.float32), (1 / r).astype(np.float32), rng.random(1 << 16).astype(np.float32), np.log(rng.gamma(2, 1, 1 << 16)).astype(np.float32)])
    gamma, inverse, beta, log_c = _pools
    log_w = np.log(weight).astype(np.float32)
    place = np.arange(len(h), dtype=U)
    out = np.empty((len(edges) - 1, count), np.uint32)
    for k in range(count):
        salt, factor = (int(x) for x in mix(np.array([2 * k + 1, 2 * k + 2], U)))
        z = (h ^ U(salt)) * U(factor | 1)
        i = (z >> U(48)).astype(np.intp)
        b = beta[i]
        level = np.floor(log_w * inverse[i] + b)
        a = log_c[(z >> U(32) & U(0xFFFF)).astype(np.intp)] - gamma[i] * (level - b + 1)
        # floats in an order of unsigned numbers; of equal ones the first shingle wins
        bits = a.view(np.int32)
        bits = (bits ^ ((bits >> 31) | np.int32(-(1 << 31)))).view(np.uint32)
        at = (np.minimum.reduceat(bits.astype(U) << U(32) | place, edges[:-1]) & U(0xFFFFFFFF)).astype(np.intp)
        out[:, k] = mix(h[at] ^ level[at].astype(np.int64).view(U) * U(_GOLD)).astype(np.uint32)
    return out


def _codes(side: pa.Table, blocks: int):
    cells, codes = [], []
    for b, h, v in zip(side["_b"].to_pylist(), side["_h"].to_pylist(), side["_v"].to_pylist()):
        if h is not None:
            cells.append(S.whole(b, S.unpack(h, _BITS), blocks, _BITS))
            codes.append(np.frombuffer(v, np.uint16))
    cells = np.concatenate(cells) if cells else np.zeros(0, U)
    codes = np.concatenate(codes) if codes else np.zeros(0, np.uint16)
    order = np.argsort(cells)
    cells, codes = cells[order], codes[order]

    def look(h: np.ndarray) -> np.ndarray:
        if not len(cells):
            return np.zeros(len(h), np.uint16)
        short = S.shorten(h, blocks, _BITS)
        at = np.searchsorted(cells, short)
        at[at == len(cells)] = 0
        return np.where(cells[at] == short, codes[at], 0).astype(np.uint16)

    return look


def _signatures(width: int, bands: int, rows: int, blocks: int, texts: int):
    schema = pa.schema([("_s", pa.int32()), ("_h1", pa.int64()), ("_h2", pa.int64()), ("_n", pa.int32()), ("_codes", pa.binary()), ("_keys", pa.list_(pa.int64()))])

    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        out = []
        if docs.num_rows:
            look = _codes(side, blocks)
            h1, h2 = np.asarray(docs["_h1"].combine_chunks()), np.asarray(docs["_h2"].combine_chunks())
            s = docs["_s"][0].as_py()
            for _, owner, h, tf in _shingles(docs, width, _kept(side)):
                if not len(h):
                    continue
                code = look(h)
                edges = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1, [len(h)]))
                sig = samples(h, tf * idf(code, texts), edges, bands * rows).astype(U)
                keys = np.zeros((len(sig), bands), U)
                for r in range(rows):
                    keys = mix(keys * U(_GOLD) + sig[:, r::rows] + U(1))
                keys = mix(keys + np.arange(1, bands + 1, dtype=U) * U(0xD1342543DE82EF95)).view(np.int64)
                for k, d in enumerate(owner[edges[:-1]].tolist()):
                    a, z = edges[k], edges[k + 1]
                    out.append((s, int(h1[d]), int(h2[d]), int(z - a), zlib.compress(code[a:z].tobytes(), 1), keys[k].tolist()))
        return S.table_of(schema, list(zip(*out)) if out else [[]] * 6)

    return run, "_s int, _h1 bigint, _h2 bigint, _n int, _codes binary, _keys array<bigint>"


_SET = pa.schema([("_c1", pa.int64()), ("_c2", pa.int64()), ("_role", pa.int32()), ("_pairs", pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))), ("_h1", pa.int64()), ("_h2", pa.int64()), ("_h", pa.binary()), ("_w", pa.binary())])
_SET_DDL = "_c1 bigint, _c2 bigint, _role int, _pairs array<struct<lo: int, hi: int>>, _h1 bigint, _h2 bigint, _h binary, _w binary"
#: Roles of a text in a group.
CENTRE, NEAR, FAR = 2, 1, 0


def _weighted(width: int, texts: int):
    """Shingles and weights of the texts in a slice that groups ask for."""

    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if docs.num_rows and asked.num_rows:
            wanted: dict[tuple[int, int], list[dict]] = {}
            for r in asked.to_pylist():
                wanted.setdefault((r["_h1"], r["_h2"]), []).append(r)
            pairs = list(zip(docs["_h1"].to_pylist(), docs["_h2"].to_pylist()))
            rows = {p: i for i, p in enumerate(pairs) if p in wanted}  # one of each text
            docs = docs.take(pa.array(list(rows.values()), pa.int64()))
            names = list(rows)
            for _, owner, h, tf in _shingles(docs, width, set(docs["_r"].to_pylist())):
                edges = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1, [len(h)])) if len(h) else [0]
                for a, z in zip(edges, edges[1:]):
                    p = names[owner[a]]
                    code = np.frombuffer(zlib.decompress(wanted[p][0]["_codes"]), np.uint16)
                    bytes_h, bytes_w = h[a:z].tobytes(), (tf[a:z] * idf(code, texts)).tobytes()
                    out += [(r["_c1"], r["_c2"], r["_role"], r["_pairs"], *p, bytes_h, bytes_w) for r in wanted[p]]
        return S.table_of(_SET, list(zip(*out)) if out else [[]] * len(_SET))

    return run


def _groups(t: pa.Table):
    """Rows of each (group, chunk pair), and the table's columns as arrays."""
    names = ("_c1", "_c2", "_lo", "_hi", "_h1", "_h2", "_role")
    x = {n: np.asarray(t[n].combine_chunks()) for n in names}
    order = np.lexsort([x[n] for n in reversed(names)])
    change = np.zeros(max(len(order) - 1, 0), bool)
    for n in names[:4]:
        change |= np.diff(x[n][order]) != 0
    for rows in np.split(order, np.flatnonzero(change) + 1):
        if len(rows) > 1:
            yield x, rows, [(np.frombuffer(t["_h"][int(r)].as_py(), U), np.frombuffer(t["_w"][int(r)].as_py(), np.float64)) for r in rows]


def similarities(sets: list[tuple[np.ndarray, np.ndarray]], centre: int) -> np.ndarray:
    """Weighted Jaccard similarity of all sets (ascending, not empty) to one."""
    h, w = sets[centre]
    size = np.array([len(x) for x, _ in sets])
    every, weight = np.concatenate([x for x, _ in sets]), np.concatenate([x for _, x in sets])
    at = np.searchsorted(h, every)
    at[at == len(h)] = 0
    first = np.cumsum(size) - size
    common = np.add.reduceat(np.where(h[at] == every, np.minimum(weight, w[at]), 0.0), first)
    return common / (np.add.reduceat(weight, first) + w.sum() - common)


def linked(sets: list[tuple[np.ndarray, np.ndarray]], far: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links with a weighted Jaccard similarity of at least ``similarity`` that join all that can be joined.

    Sets that are not ``far`` are known to hang together and are compared with far ones only.
    A search follows links: each reached far set is compared with all far ones that are not reached
    yet and with the others, in one pass over their entries, so no linked pair is left in different trees.
    Sets stand in order of their weights, as a link bounds the ratio of weights; entries that
    only one set has can't be common and are left out, and so is a set of which too much is left out.
    """
    total = np.array([w.sum() for _, w in sets])
    order = np.argsort(total, kind="stable")
    total, far = total[order], far[order]
    owner = segments_to_rows(np.array([len(sets[k][0]) for k in order]))
    every, local = np.unique(np.concatenate([sets[k][0] for k in order]), return_inverse=True)
    weight = np.concatenate([sets[k][1] for k in order])
    alive = np.ones(len(sets), bool)
    while True:  # what a set shares with none that is alive is lost to it
        shared = (np.bincount(local, minlength=len(every)) > 1)[local]
        still = alive & (np.bincount(owner[shared], weight[shared], len(sets)) >= similarity * total - 1e-9)
        keep = shared & still[owner]
        if keep.all():
            break
        owner, local, weight, alive = owner[keep], local[keep], weight[keep], still
    local = local.astype(np.int32)
    first = np.searchsorted(owner, np.arange(len(sets) + 1))
    alive &= np.diff(first) > 0
    dense = np.zeros(len(every))
    out: list[tuple[int, int]] = []
    ids = np.flatnonzero(alive)  # what the packed arrays hold, by weight; some may be reached already
    p_local, p_weight, p_first, p_total = local, weight, first[np.append(ids, len(sets))], total[ids]
    for seed in np.flatnonzero(alive & far):
        queue = [int(seed)] if alive[seed] else []
        alive[seed] = False
        while queue:
            if alive[ids].sum() < 0.7 * len(ids):
                flag = alive[ids]
                keep = np.repeat(flag, np.diff(p_first))
                p_local, p_weight, sizes = p_local[keep], p_weight[keep], np.diff(p_first)[flag]
                ids, p_first = ids[flag], np.concatenate(([0], np.cumsum(sizes)))
                p_total = total[ids]
            if not len(ids):
                break
            k = queue.pop()
            mine = slice(first[k], first[k + 1])
            lo, hi = np.searchsorted(p_total, [similarity * total[k] - 1e-9, total[k] / similarity + 1e-9])
            if lo == hi:
                continue
            dense[local[mine]] = weight[mine]
            part = slice(p_first[lo], p_first[hi])
            common = np.add.reduceat(np.minimum(p_weight[part], dense[p_local[part]]), p_first[lo:hi] - p_first[lo])
            dense[local[mine]] = 0
            hit = ids[lo:hi][(common >= similarity * (p_total[lo:hi] + total[k] - common) - 1e-9) & alive[ids[lo:hi]]]
            out += [(int(order[k]), int(order[x])) for x in hit]
            hit = hit[far[hit]]
            alive[hit] = False
            queue += hit.tolist()
    return out


_STAR = pa.schema([("_c1", pa.int64()), ("_c2", pa.int64()), ("_h1", pa.int64()), ("_h2", pa.int64()), ("_like", pa.float64())])


def _star(t: pa.Table) -> pa.Table:
    """Similarity of each member of a group to its centre."""
    out = [np.zeros(0, np.int64)] * 4 + [np.zeros(0)]
    for x, rows, sets in _groups(t):
        centre = int(np.flatnonzero(x["_role"][rows] == CENTRE)[0])
        like, use = similarities(sets, centre), x["_role"][rows] != CENTRE
        out = [np.concatenate((a, b)) for a, b in zip(out, [*[x[n][rows[use]] for n in ("_c1", "_c2", "_h1", "_h2")], like[use]])]
    return S.table_of(_STAR, out)


def _verify(similarity: float):
    schema = pa.schema([("a1", pa.int64()), ("a2", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        out = []
        for x, rows, sets in _groups(t):
            h1, h2 = x["_h1"][rows], x["_h2"][rows]
            out += [(h1[p], h2[p], h1[q], h2[q]) for p, q in linked(sets, x["_role"][rows] == FAR, similarity)]
        return S.table_of(schema, list(zip(*out)) if out else [[]] * 4)

    return run


def _links(docs_side: DataFrame, signed: DataFrame, width: int, texts: int, similarity: float) -> DataFrame:
    """Verified links (``a``, ``b``: texts) that join all that the buckets can join."""
    node, text = F.struct("_h1", "_h2"), signed.select("_h1", "_h2", "_s", "_n", "_codes")
    keys = signed.select(F.explode("_keys").alias("_key"), "_h1", "_h2")
    buckets = cut(keys.groupBy("_key").agg(F.min(node).alias("_c"), F.count("*").alias("_m")).where("_m > 1"))
    in_buckets = buckets.agg(F.sum("_m")).first()[0] or 0
    pairs = spread_join(keys, buckets, ["_key"], "_m", in_buckets).select("_h1", "_h2", F.col("_c._h1").alias("_c1"), F.col("_c._h2").alias("_c2")).where("_h1 <> _c1 or _h2 <> _c2")
    pairs = cut(pairs.distinct().join(text.select("_h1", "_h2", "_n"), ["_h1", "_h2"]))
    sizes = cut(pairs.groupBy("_c1", "_c2").agg(F.sum("_n").alias("_load"), F.count("*").alias("_m")).withColumn("_of", F.ceil(F.col("_load") / CHUNK_SHINGLES).cast("int")))
    members, load = (x or 0 for x in sizes.agg(F.sum("_m"), F.sum("_load")).first())
    chunk = F.pmod(F.xxhash64("_h1", "_h2"), F.col("_of")).cast("int")
    fields = ["_h1", "_h2", "_c1", "_c2", "_role", "_pairs"]
    asked = spread_join(pairs.drop("_n"), sizes, ["_c1", "_c2"], "_m", members).select("_h1", "_h2", "_c1", "_c2", F.lit(NEAR).alias("_role"), F.array(F.struct(chunk.alias("lo"), chunk.alias("hi"))).alias("_pairs"))
    centres = sizes.select(F.col("_c1").alias("_h1"), F.col("_c2").alias("_h2"), "_c1", "_c2", F.lit(CENTRE).alias("_role"), F.transform(F.sequence(F.lit(0), F.col("_of") - 1), lambda k: F.struct(k.alias("lo"), k.alias("hi"))).alias("_pairs"))

    def compared(asked: DataFrame, load: int, compare, ddl: str) -> DataFrame:
        asked = asked.select(*fields).join(text.drop("_n"), ["_h1", "_h2"])
        sets = docs_side.groupBy("_s").cogroup(asked.groupBy("_s")).applyInArrow(_weighted(width, texts), _SET_DDL)
        sets = sets.select("*", F.explode("_pairs").alias("_p")).select("*", F.col("_p.lo").alias("_lo"), F.col("_p.hi").alias("_hi")).drop("_pairs", "_p")
        groups = max(16, int(load // CHUNK_SHINGLES) * 2)
        return sets.withColumn("_g", F.pmod(F.xxhash64("_c1", "_c2", "_lo", "_hi"), F.lit(groups))).groupBy("_g").applyInArrow(compare, ddl)

    star = cut(compared(asked.unionByName(centres), load, _star, "_c1 bigint, _c2 bigint, _h1 bigint, _h2 bigint, _like double"))
    a, b = F.struct(F.col("_c1").alias("_h1"), F.col("_c2").alias("_h2")).alias("a"), node.alias("b")
    links = star.where(F.col("_like") >= similarity - 1e-12).select(a, b)
    is_far = F.col("_like") < similarity - 1e-12
    tops = star.groupBy("_c1", "_c2").agg(F.max(F.when(is_far, F.col("_like"))).alias("_top"), F.count("*").alias("_m")).where("_top is not null")
    rest = spread_join(star, tops, ["_c1", "_c2"], "_m", members).where(is_far | (F.col("_like") <= F.col("_top") + (1 - similarity) + 1e-9))
    rest = cut(rest.select("_h1", "_h2", "_c1", "_c2", is_far.alias("_far")).join(text.select("_h1", "_h2", "_n"), ["_h1", "_h2"]))
    size = lambda far: F.sum(F.when(F.col("_far") == far, F.col("_n")).otherwise(0))
    sizes = cut(rest.groupBy("_c1", "_c2").agg(size(True).alias("_f"), size(False).alias("_g"), F.count("*").alias("_m")).where("_m > 1"))
    if not sizes.count():
        return links
    # chunks of far ones meet each other and all chunks of the others; a small group is one chunk
    small = F.col("_f") + F.col("_g") <= CHUNK_SHINGLES
    sizes = sizes.withColumn("_of", F.when(small, 1).otherwise(F.ceil(F.col("_f") / CHUNK_SHINGLES)).cast("int")).withColumn("_og", F.when(small, 0).otherwise(F.ceil(F.col("_g") / CHUNK_SHINGLES)).cast("int"))
    load = sizes.agg(F.sum(F.col("_f") * (F.col("_of") + F.col("_og")) + F.col("_g") * F.col("_of"))).first()[0]
    at = F.pmod(F.xxhash64("_h1", "_h2"), F.when(F.col("_far") | (F.col("_og") == 0), F.col("_of")).otherwise(F.col("_og"))).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    with_far = F.transform(upto(F.col("_of")), lambda j: F.struct(F.least("_k", j).alias("lo"), F.greatest("_k", j).alias("hi")))
    with_others = F.when(F.col("_og") > 0, F.transform(upto(F.greatest("_og", F.lit(1))), lambda j: F.struct(F.col("_k").alias("lo"), (F.col("_of") + j).alias("hi")))).otherwise(F.array().cast("array<struct<lo: int, hi: int>>"))
    others = F.transform(upto(F.col("_of")), lambda j: F.struct(j.alias("lo"), (F.col("_of") + F.col("_k")).alias("hi")))
    asked = spread_join(rest.drop("_n"), sizes, ["_c1", "_c2"], "_m", members).withColumn("_k", at)
    asked = asked.withColumn("_role", F.when(F.col("_far"), FAR).otherwise(NEAR)).withColumn("_pairs", F.when(F.col("_far"), F.concat(with_far, with_others)).when(F.col("_og") == 0, F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi")))).otherwise(others))
    checked = compared(asked, load, _verify(similarity), "a1 bigint, a2 bigint, b1 bigint, b2 bigint")
    return links.unionByName(cut(checked).select(F.struct(F.col("a1").alias("_h1"), F.col("a2").alias("_h2")).alias("a"), F.struct(F.col("b1").alias("_h1"), F.col("b2").alias("_h2")).alias("b")))


def _classes(docs: DataFrame, id_col: str, text_col: str, width: int, similarity: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows (``_id``, ``_h1``, ``_h2``), and for each text: its class, least id, number of rows, and whether it is its class's first."""
    base = view(docs, id_col, text_col)
    plan = S.plan(base)
    dealt = S.deal(base, plan).withColumn("_h1", F.xxhash64("_text")).withColumn("_h2", F.xxhash64(F.lit(7), "_text")).withColumn("_r", F.xxhash64("_id", "_h1", "_h2"))
    slim = cut(dealt.select("_id", "_h1", "_h2", "_s", "_r"))
    by_text = cut(slim.groupBy("_h1", "_h2").agg(F.min("_id").alias("_min"), F.min(F.struct("_s", "_r")).alias("_one"), F.count("*").alias("_count")))
    texts = by_text.count()
    # one row of each text is looked at; its number goes to its slice
    keep = by_text.groupBy(F.col("_one._s").alias("_s")).agg(F.collect_list("_one._r").alias("_keep"))
    docs_side = dealt.select("_s", "_text", "_h1", "_h2", "_r")
    sketches = docs_side.groupBy("_s").cogroup(keep.groupBy("_s")).applyInArrow(_sketch(width, plan.blocks), _MESSAGE_DDL)
    answers = sketches.groupBy("_b").applyInArrow(_merge, _MESSAGE_DDL)
    side = answers.withColumn("_keep", F.lit(None).cast("array<bigint>")).unionByName(keep.select("_s", F.lit(0).alias("_b"), F.lit(None).cast("binary").alias("_h"), F.lit(None).cast("binary").alias("_v"), "_keep"))
    sign, ddl = _signatures(width, bands, rows, plan.blocks, texts)
    signed = cut(docs_side.groupBy("_s").cogroup(side.groupBy("_s")).applyInArrow(sign, ddl))

    found = connected_components(_links(docs_side, signed, width, texts, similarity))
    found = found.select(F.col("node._h1").alias("_h1"), F.col("node._h2").alias("_h2"), "component")
    classes = by_text.join(found, ["_h1", "_h2"], "left").withColumn("component", F.coalesce("component", F.struct("_h1", "_h2")))
    known = F.struct(F.col("_min").isNull(), "_min", "_h1", "_h2")
    classes = cut(classes.select("_h1", "_h2", "_min", "_count", "component", known.alias("_known")))
    least = classes.groupBy("component").agg(F.min("_min").alias("class_id"), F.min("_known").alias("_first"), F.count("*").alias("_texts"))
    named = spread_join(classes, least, ["component"], "_texts", texts)
    return slim, named.select("_h1", "_h2", "_min", "_count", "class_id", (F.col("_known") == F.col("_first")).alias("_first"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Classes of near-duplicate texts: the id column, ``class_id`` and ``kept``, one row per input row.

    Two texts are linked if they are equal, or if they share a group (see above) and their weighted Jaccard
    similarity over shingles of ``width`` words (runs without 0x20, 0x09-0x0D, as they are) is at
    least ``similarity``; classes are the components of links, ``class_id`` the smallest id
    in it, ``kept`` whether the row has that id.  A pair at 0.8 shares one of 16 bands of 4
    samples with a chance of 0.9998, one at 0.3 with 0.12; no number of partners is capped.

    A text of fewer words is one shingle of all its words; texts without words (null counts
    as empty) are linked to equal texts only.  Rows with a null id belong to their
    text's class, have a null class if all its ids are null, and are not kept.
    Repeated rows get equal results.  An empty table gives an empty result; other
    columns are ignored.
    """
    slim, named = _classes(docs, id_col, text_col, width, similarity, bands, rows)
    named = cut(named.select("_h1", "_h2", "class_id", "_count"))
    out = spread_join(slim.select("_id", "_h1", "_h2"), named, ["_h1", "_h2"], "_count", named.agg(F.sum("_count")).first()[0] or 0)
    return out.select(F.col("_id").alias(id_col), "class_id", F.coalesce(F.col("_id") == F.col("class_id"), F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row of each class of ``near_duplicates``, with all columns of ``docs``.

    It is the row with the class's smallest id (the smaller text hash if several texts have it); a row without an id
    stays only where no row of its class has one.  Of rows that repeat id and text one stays.
    Null and empty texts are one class.  An empty table gives an empty result.
    """
    slim, named = _classes(docs, id_col, text_col, width, similarity, bands, rows)
    chosen = cut(named.where("_first").select(F.col("_h1").alias("_1"), F.col("_h2").alias("_2"), F.col("_min").alias("_least"), "_count"))
    text = F.coalesce(docs[text_col], F.lit(""))
    rows_ = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[id_col].alias("_i"), F.xxhash64(text).alias("_a"), F.xxhash64(F.lit(7), text).alias("_b"))
    out = rows_.join(chosen.drop("_count"), (F.col("_a") == F.col("_1")) & (F.col("_b") == F.col("_2")) & F.col("_i").eqNullSafe(F.col("_least")), "left_semi")
    again = slim.join(chosen.where("_count > 1"), (F.col("_h1") == F.col("_1")) & (F.col("_h2") == F.col("_2")) & F.col("_id").eqNullSafe(F.col("_least")), "left_semi")
    if again.groupBy("_id", "_h1", "_h2").count().where("count > 1").limit(1).count():
        out = out.dropDuplicates(["_i", "_a", "_b"])
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
