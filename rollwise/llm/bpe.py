"""Byte-level BPE with a segment tree over adjacent pair ranks.

A pre-token's pairs are the leaves of a tree of minima; a leaf is
``rank * leaves + position``, so the root is the leftmost pair of lowest
rank.  A merge changes three leaves, each updated along its path to the root;
it ends when the root holds no mergeable pair.  Trees of one size are worked
in one array, a merge of every unfinished row at a time.

Texts are split by the added tokens first, then by the byte-level pattern.
Distinct pre-tokens are encoded once per worker; the table of known ones is
emptied when it has ``KNOWN`` entries.  A null text is empty: no tokens.
The vocabulary is read by the driver from a path that the caller names and
sent to the tasks (a few MB, fixed by the file).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rollwise.llm.common import BYTE_VALUE, U64, mix64, slices, utf8

KNOWN = 500_000
NONE = np.int64(1) << np.int64(62)


def byte_signs() -> list[str]:
    """The printable sign of each byte in a byte-level vocabulary: a printable
    Latin-1 byte stands for itself, the others for code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = (b for b in range(256) if b not in plain)
    signs = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [signs[b] for b in range(256)]


class Vocabulary:
    """Merges, bytes of ids and added tokens of a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, ids = spec["model"], spec["model"]["vocab"]
        signs = byte_signs()
        of_sign = {s: b for b, s in enumerate(signs)}
        self.byte_id = np.array([ids[s] for s in signs], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        first = np.array([ids[a] for a, _ in merges], np.int64)
        second = np.array([ids[b] for _, b in merges], np.int64)
        key = (first << 32) | second
        order = np.argsort(key, kind="stable")
        self.pairs, self.rank = key[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)  # by rank
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that take their surroundings are not supported")
        pieces = {i: bytes(of_sign[c] for c in s) for s, i in ids.items()}
        pieces |= {i: s.encode() for s, i in self.added.items()}
        size = max(pieces) + 1
        self.piece_size = np.array([len(pieces.get(i, b"")) for i in range(size)], np.int64)
        self.piece_at = np.concatenate([[0], np.cumsum(self.piece_size)])[:-1]
        self.piece_bytes = np.frombuffer(b"".join(pieces.get(i, b"") for i in range(size)), np.uint8)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or NONE; a negative id pairs with nothing."""
        if not len(self.pairs):
            return np.full(len(a), NONE)
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((b >= 0) & (self.pairs[at] == key), self.rank[at], NONE)


def merge_rows(ids: np.ndarray, size: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """BPE of every row of ``ids`` (rows x a power of two), of which the first
    ``size`` are used: ids after all merges, -1 where a symbol went."""
    rows, leaves = ids.shape
    out = ids.copy()
    nxt = np.broadcast_to(np.arange(1, leaves + 1, dtype=np.int64), ids.shape).copy()
    nxt[nxt >= size[:, None]] = -1
    prev = np.broadcast_to(np.arange(-1, leaves - 1, dtype=np.int64), ids.shape).copy()
    tree = np.full((rows, 2 * leaves), NONE)
    if leaves > 1:
        rank = vocab.lookup(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(rows, leaves - 1)
        inside = np.arange(leaves - 1)[None, :] < (size - 1)[:, None]
        tree[:, leaves:-1] = np.where(inside & (rank < NONE), rank * leaves + np.arange(leaves - 1), NONE)
    level = leaves // 2
    while level:
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        level //= 2

    def put(r: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        node = leaf + leaves
        tree[r, node] = value
        while (node := node >> 1)[0]:  # all leaves are equally deep
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])

    def key(r: np.ndarray, at: np.ndarray) -> np.ndarray:
        after = nxt[r, at]
        rank = vocab.lookup(out[r, at], np.where(after >= 0, out[r, np.maximum(after, 0)], -1))
        return np.where(rank < NONE, rank * leaves + at, NONE)

    r = np.flatnonzero(tree[:, 1] < NONE)
    while len(r):
        top = tree[r, 1]
        at = top & (leaves - 1)
        gone = nxt[r, at]
        after = nxt[r, gone]
        out[r, at] = vocab.merged[top >> int(leaves).bit_length() - 1]
        out[r, gone] = -1
        nxt[r, at] = after
        has = after >= 0
        prev[r[has], after[has]] = at[has]
        put(r, gone, np.full(len(r), NONE))
        put(r, at, key(r, at))
        before = prev[r, at]
        has = before >= 0
        if has.any():
            put(r[has], before[has], key(r[has], before[has]))
        r = r[tree[r, 1] < NONE]
    return out


def _ramp(size: np.ndarray) -> np.ndarray:
    """0..size-1 for each size, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Of each code point: 1 letter, 2 number, 3 white space, 0 any other."""
    import regex
    out = np.zeros(0x110000, np.int8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for k, kind in enumerate(("L", "N", "White_Space"), 1):
        for m in regex.finditer(rf"\p{{{kind}}}+", every):
            out[ord(m[0][0]):ord(m[0][-1]) + 1] = k
    out[0xD800:0xE000] = 0
    return out


#: What follows an apostrophe in a pre-token of its own.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


def token_starts(points: np.ndarray, part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, as the byte-level pattern splits: optional space
    with a run of letters, numbers or other signs; an apostrophe with a suffix;
    white space, whose last sign before a run stays apart or joins the run.
    part: number of the text a code point is in; whole: parts not to be split.
    """
    n = len(points)
    kind = _classes()[points]
    change = np.ones(n + 1, bool)
    change[1:-1] = (kind[1:] != kind[:-1]) | (part[1:] != part[:-1])
    run = np.flatnonzero(change)
    lo, hi = run[:-1], run[1:]
    start = change[:-1].copy()
    space = kind[lo] == 3
    inner = np.zeros(len(lo), bool)  # followed by a run of the same text
    inner[:-1] = part[lo[1:]] == part[hi[:-1] - 1]
    last = hi[space & inner] - 1
    start[last] = True
    joins = points[last] == 32
    start[last[joins] + 1] = False
    mark = (kind[lo] == 0) & (hi - lo == 1) & (points[lo] == 39) & inner
    for at in lo[mark & start[lo]]:
        tail = "".join(map(chr, points[at + 1:at + 3]))
        for suffix in SUFFIXES:
            end = at + 1 + len(suffix)
            if tail.startswith(suffix) and end <= n and part[end - 1] == part[at]:
                start[at + 1] = False
                if end < n:
                    start[end] = True
                break
    if whole.any():
        inside = whole[part]
        begins = np.ones(n, bool)
        begins[1:] = part[1:] != part[:-1]
        start = np.where(inside, begins, start)
    return start


class Encoder:
    """Pre-tokens are looked up by the 64-bit hash of their bytes; the caller
    compares decoded with given bytes, so that a clash could not pass."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.added = re.compile("|".join(map(re.escape, sorted(vocab.added, key=len, reverse=True))).encode()) if vocab.added else None
        self.reset()

    def reset(self, seed: int = 0) -> None:
        self.seed = seed
        self.hash, self.slot = np.zeros(0, U64), np.zeros(0, np.int64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def _learn(self, raw: np.ndarray, begin: np.ndarray, size: np.ndarray, special: np.ndarray) -> None:
        """Encode new pre-tokens raw[begin:begin + size]."""
        joined = self.vocab.byte_id[raw]
        shape = np.where(special, 0, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
        count = np.ones(len(size), np.int64)
        parts = []
        for leaves in np.unique(shape[~special]).tolist():
            which = np.flatnonzero(shape == leaves)
            step = max(1, (1 << 16) // leaves)  # a pass's arrays stay in the cache
            for k in range(0, len(which), step):
                w = which[k:k + step]
                cols = np.arange(leaves)
                inside = cols[None, :] < size[w][:, None]
                m = np.where(inside, joined[np.minimum(begin[w][:, None] + cols, len(joined) - 1)], -1)
                m = merge_rows(m, size[w], self.vocab)
                full = m >= 0
                count[w] = full.sum(1)
                parts.append((w, m[full]))
        at = self.used + np.concatenate([[0], np.cumsum(count)])[:-1]
        total = self.used + int(count.sum())
        if total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(total, len(self.flat)), np.int32)])
        for w, ids in parts:
            self.flat[np.repeat(at[w], count[w]) + _ramp(count[w])] = ids
        for k in np.flatnonzero(special):
            self.flat[at[k]] = self.vocab.added[raw[begin[k]:begin[k] + size[k]].tobytes().decode()]
        self.at, self.size, self.used = np.append(self.at, at), np.append(self.size, count), total

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (their bytes and offsets) one after the other, and
        how many each has."""
        rows = len(off) - 1
        if not len(raw):
            return np.zeros(0, np.int64), np.zeros(rows, np.int64)
        if len(self.hash) > KNOWN:
            self.reset()
        data = raw.tobytes()
        heads = (raw & 0xC0) != 0x80
        char = np.flatnonzero(heads)  # byte of each character
        points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
        edges = off[:-1]
        marked = []
        if self.added is not None:
            marked = [m.span() for m in self.added.finditer(data)]
            if any(((off > x) & (off < y)).any() for x, y in marked):  # over the end of a text: look text by text
                marked = [m.span() for i, j in zip(off[:-1].tolist(), off[1:].tolist()) for m in self.added.finditer(data, i, j)]
        cuts = np.unique(np.concatenate([edges[edges < len(raw)], np.array([z for m in marked for z in m if z < len(raw)], np.int64)]))
        whole = np.isin(cuts, [x for x, _ in marked])
        part = np.searchsorted(cuts, char, side="right") - 1
        begin = char[token_starts(points, part, whole)]
        size = np.diff(np.append(begin, len(raw)))
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(int(size.max()), 0xD6E8FEB86659FD93, dtype=U64))
            h = mix64(np.add.reduceat(BYTE_VALUE[raw] * power[_ramp(size)], begin) + size.astype(U64) + U64(self.seed << 32))
        word, first, which = np.unique(h, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hash, word)
        known = self.hash[np.minimum(place, len(self.hash) - 1)] == word if len(self.hash) else np.zeros(len(word), bool)
        if not known.all():
            new = np.flatnonzero(~known)
            slots = len(self.at) + np.arange(len(new))
            begins = begin[first[new]]
            special = np.isin(begins, [x for x, _ in marked]) if marked else np.zeros(len(new), bool)
            self._learn(raw, begins, size[first[new]], special)
            self.hash, self.slot = np.insert(self.hash, place[new], word[new]), np.insert(self.slot, place[new], slots)
            place = np.searchsorted(self.hash, word)
        slot = self.slot[place][which]
        count = self.size[slot]
        ids = self.flat[np.repeat(self.at[slot], count) + _ramp(count)].astype(np.int64)
        row = np.searchsorted(off, begin, side="right") - 1
        return ids, np.bincount(row, weights=count, minlength=rows).astype(np.int64)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of all texts one after the other, and how many each has."""
        v = self.vocab
        count = v.piece_size[ids]
        data = v.piece_bytes[np.repeat(v.piece_at[ids], count) + _ramp(count)]
        row = np.repeat(np.arange(len(sizes)), sizes)
        return data.tobytes(), np.bincount(row, weights=count, minlength=len(sizes)).astype(np.int64)


def _utf8_text(data: bytes) -> bytes:
    """A decoder's text: bytes that are no UTF-8 become replacement signs."""
    return data.decode("utf-8", "replace").encode("utf-8")


def encoded(docs: DataFrame, path: str, *carried: str, keep_ids: bool = False) -> DataFrame:
    """carried columns, n_tokens, ids_sha256, decoded_sha256 (and ids) of each
    text; a carried column of one of these names is left out."""
    from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
    carried = [c for c in carried if c not in ("n_tokens", "ids_sha256", "decoded_sha256", *(("ids",) if keep_ids else ()))]
    fields = [f for f in docs.select(*carried).schema]
    vocab = Vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocab)
        for batch in batches:
            raw, off = utf8(batch.column(0))
            for i, j in slices(off):
                part, inner = raw[off[i]:off[j]], off[i:j + 1] - off[i]
                ids, sizes = encoder.encode(part, inner)
                data, spans = encoder.decode(ids, sizes)
                while data != part.tobytes():  # two pre-tokens of one hash
                    encoder.reset(encoder.seed + 1)
                    ids, sizes = encoder.encode(part, inner)
                    data, spans = encoder.decode(ids, sizes)
                small = ids.astype("<u4")
                at, to = np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([[0], np.cumsum(spans)])
                n = range(j - i)
                arrays = [*(batch.column(c + 1).slice(i, j - i) for c in range(len(fields))), pa.array(sizes),
                          pa.array([hashlib.sha256(small[at[k]:at[k + 1]]).hexdigest() for k in n]),
                          pa.array([hashlib.sha256(_utf8_text(data[to[k]:to[k + 1]])).hexdigest() for k in n])]
                names = [*(f.name for f in fields), "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    extra = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
             StructField("decoded_sha256", StringType())]
    if keep_ids:
        extra.append(StructField("ids", ArrayType(IntegerType())))
    return docs.select("text", *carried).mapInArrow(run, StructType([*fields, *extra]))
