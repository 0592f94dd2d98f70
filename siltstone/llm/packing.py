"""Hierarchical multi-length packing of tokenised documents.

Documents are dealt into slices of a few MB (one shuffle of the text); each slice is
tokenised and packed by itself, so packing is linear in the input.  Within a
slice a document gives whole windows of the longest tier, and its rest is routed to the
shortest tier that holds it.  Tiers are packed from the longest; gaps are
filled with whole rests of shorter tiers, best fit first, and at last with a cut one, so
windows are full until a slice runs out.  What is left then is cut to powers of two.
Sequences are finally dealt into step groups of nearly equal numbers of tokens.
"""

from __future__ import annotations

import heapq
import os
import re
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm import slices as S
from siltstone.llm.common import arrow_type, view
from siltstone.llm.kernels import U, chunks, flatten, span_hashes, words

TIERS = (512, 1024, 2048, 4096)
STEP_TOKENS = 32768

#: Letters that lower-casing and NFC treat one by one, then ASCII punctuation but for the apostrophe: two pre-tokens at most.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


class WordTokenizer:
    """Token ids of whole texts, word by word, with a bounded cache.

    The tokenizer drops white space and never merges across it, so a text's ids are its
    words' ids in order.  Plain words go straight to the BPE model; all others through
    the whole tokenizer.  The cache holds at most ``bound`` distinct words (by 64-bit
    hash) and starts anew beyond that.
    """

    def __init__(self, path: str, bound: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.bound = Tokenizer.from_file(path), bound
        self.model = self.tokenizer.model
        codes = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = dict(zip(codes, codes)) | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in codes)}
        self.bytes_shown = {b: chr(c) for b, c in shown.items()}
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.n = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def word(self, word: str) -> list[int]:
        if m := _PLAIN.fullmatch(word):
            out: list[int] = []
            for part in m.groups():
                if part:
                    out += [t.id for t in self.model.tokenize(part.lower().encode().decode("latin-1").translate(self.bytes_shown))]
            return out
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def learn(self, keys: np.ndarray, spans: list[bytes]) -> None:
        ids = [self.word(x.decode("utf-8", "replace")) for x in spans]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(n.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(len(self.pool), np.uint32)))
        self.pool[self.used : self.used + len(flat)] = flat
        at = self.used + np.cumsum(n) - n
        self.used += len(flat)
        where = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.n = np.insert(self.keys, where, keys), np.insert(self.at, where, at), np.insert(self.n, where, n)

    def encode(self, texts, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``end`` after it, and the offset of each text (one more at the end)."""
        buf, offsets = flatten(texts)
        parts, sizes = [], []
        for i, j in chunks(offsets):
            part, at = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            starts, ends, first = words(part, at)
            keys, one, back = np.unique(span_hashes(part, starts, ends), return_index=True, return_inverse=True)
            if len(self.keys) + len(keys) > self.bound:
                self.clear()
            new = ~S.member(keys, self.keys)
            if new.any():
                raw, pick = part.tobytes(), one[new]
                self.learn(keys[new], [raw[a:b] for a, b in zip(starts[pick].tolist(), ends[pick].tolist())])
            slot = np.searchsorted(self.keys, keys)
            n, src = self.n[slot][back], self.at[slot][back]
            # the end of each text takes part as one more word
            n, src = np.insert(n, first[1:], 1), np.insert(src, first[1:], -1)
            total = np.concatenate(([0], np.cumsum(n)))
            take = np.repeat(src - total[:-1], n) + np.arange(total[-1])
            closing = total[first[1:] + np.arange(j - i)]
            take[closing] = 0
            ids = self.pool[take]
            ids[closing] = end
            parts.append(ids)
            sizes.append(np.diff(np.concatenate(([0], closing + 1))))
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        return ids, np.concatenate(([0], np.cumsum(np.concatenate(sizes)))) if sizes else np.zeros(1, np.int64)


_open: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    """The worker's own tokenizer, kept with its cache for the next task."""
    if path not in _open:
        _open.clear()
        _open[path] = WordTokenizer(path)
    return _open[path]


def pack_lengths(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of pieces (document, start, length); every length is at least 1.

    Full windows of the longest tier first, then the rests: the longest rest opens a window of the
    shortest tier that holds it, filled by the largest rests that fit and then by cutting the
    smallest one.  Once no rest is left, an unfilled window is cut to powers of two.
    """
    longest = tiers[-1]
    done: list[list[tuple[int, int, int]]] = []
    rests: list[tuple[int, int, int]] = []  # (length, document, start), ascending
    for d, n in enumerate(lengths):
        whole = n - n % longest
        done += [[(d, s, longest)] for s in range(0, whole, longest)]
        if n > whole:
            rests.append((n - whole, d, whole))
    rests.sort()
    while rests:
        n, d, s = rests.pop()
        size = next(t for t in tiers if t >= n)
        window, gap = [(d, s, n)], size - n
        while gap and rests:
            k = bisect_right(rests, (gap, len(lengths), 0)) - 1
            if k >= 0:
                n, d, s = rests.pop(k)
                window.append((d, s, n))
                gap -= n
            else:  # all are longer than the gap: the shortest is cut
                n, d, s = rests.pop(0)
                window.append((d, s, gap))
                insort(rests, (n - gap, d, s + gap))
                gap = 0
        if not gap:
            done.append(window)
            continue
        left = sum(x[2] for x in window)
        while left:  # nothing is left to fill with
            room = 1 << (left.bit_length() - 1)
            left -= room
            part = []
            while room:
                d, s, n = window.pop(0)
                part.append((d, s, min(n, room)))
                if n > room:
                    window.insert(0, (d, s + room, n - room))
                room -= min(n, room)
            done.append(part)
    return done


def step_groups(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """Group of each sequence: the longest first, each to the group with the fewest tokens."""
    groups = [(0, g) for g in range(max(1, -(-sum(sizes) // step_tokens)))]
    out = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        total, g = heapq.heappop(groups)
        out[k] = g
        heapq.heappush(groups, (total + sizes[k], g))
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Packs whole documents into sequences of at most ``tiers[-1]`` tokens (ascending powers of two).

    A document's ids are its text's, without special tokens, and then ``end_id``.  Each id lies
    in exactly one piece.  One row a piece: the id column, ``start``, ``length``, ``ids`` (binary,
    little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` (gapless from 0 in its
    sequence), ``tier`` (window size of the sequence) and ``step_group`` (groups of nearly equal token numbers).
    Every sequence's length is a power of two, so none needs padding.

    Null or empty text: the end id alone.  Null ids pass.  Repeated rows are
    packed each by itself.  An empty table gives an empty result; other columns are ignored.
    """
    rows = view(docs, id_col, text_col)
    dealt = S.deal(rows, S.plan(rows))
    id_type = arrow_type(dealt, "_id")
    schema = pa.schema([("_id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int64()), ("step_group", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        # rows in an order of their own, so a repeated task packs alike
        t = t.sort_by([("_id", "ascending"), ("_text", "ascending")])
        base = t["_s"][0].as_py() << 32
        ids, at = tokenizer_at(tokenizer_path).encode(t["_text"], end_id)
        sizes = np.diff(at).tolist()
        sequences = pack_lengths(sizes, tiers)
        lengths = [sum(p[2] for p in s) for s in sequences]
        groups = step_groups(lengths, step_tokens)
        raw, first = ids.astype("<u4").tobytes(), at.tolist()
        out = []
        for k, pieces in enumerate(sequences):
            offset = 0
            for d, s, n in pieces:
                a = 4 * (first[d] + s)
                out.append((d, s, n, raw[a : a + 4 * n], sizes[d], base + k, offset, lengths[k], base + groups[k]))
                offset += n
        cols = list(zip(*out))
        return pa.Table.from_arrays([t["_id"].combine_chunks().take(pa.array(cols[0], pa.int64())), *[pa.array(c, f.type) for c, f in zip(cols[1:], list(schema)[1:])]], schema=schema)

    ddl = f"_id {dealt.schema['_id'].dataType.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, tier bigint, step_group bigint"
    return dealt.groupBy("_s").applyInArrow(run, ddl).withColumnRenamed("_id", id_col)
