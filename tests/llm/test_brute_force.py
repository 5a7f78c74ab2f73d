"""Models that SQL can't express, restated plainly and compared row by row."""

import math
import re
from collections import Counter
from itertools import groupby, product
from zlib import crc32

import numpy as np
import pytest
import xxhash

from rollwise.llm import language_id, quality, toxicity

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def all_paths(word, model):
    """The best letters among every path through the word's lattice."""
    table = toxicity._signs()
    kind = lambda c: int(table[ord(c)]) if ord(c) < len(table) else toxicity.SIGNS - 1
    runs, at = [], 0
    for c, run in groupby(word):
        n = len(list(run))
        if c in toxicity.LEET:
            free = (c == "!" and at + n == len(word)) or (c == "(" and at == 0)
            fewer = toxicity.HALVE if n == 2 else toxicity.REPEAT
            options = [("", 0.0 if free else toxicity.DROP)]
            options += [(x * k, toxicity.SUBSTITUTE * k + fewer * (n - k)) for x in toxicity.LEET[c] for k in range(1, min(n, 2) + 1)]
        elif c.isalpha():
            options = [(c, {1: 0.0, 2: toxicity.HALVE}.get(n, toxicity.REPEAT))]
            options += [(c * 2, 0.0 if n == 2 else toxicity.REPEAT)] * (n > 1)
        else:
            options = [("", 0.0)]
        runs.append(options)
        at += n
    best = None
    for path in product(*runs):
        score, a, b = sum(cost for _, cost in path), 0, 0
        letters = "".join(x for x, _ in path)
        for letter in letters:
            score += float(model[a, b, kind(letter)])
            a, b = b, kind(letter)
        score += float(model[a, b, 0])
        if best is None or score > best[0]:
            best = score, letters
    return best[1]


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_finds_the_best_of_all_paths(seed):
    rng = np.random.default_rng(seed)
    model = np.log(rng.dirichlet(np.full(toxicity.SIGNS, 0.3), (toxicity.SIGNS,) * 2) + 1e-6).astype(np.float32)
    decode = toxicity.Restorer(model).decode
    words = ["a$$", "a55", "fuuck", "1d10t", "h3ll0!!", "(5h1t", "@@ss", "xx1||8b", "a-b", "!", "ddd000", "ß1é€"]
    signs = "ab1l$s-0o!"
    words += ["".join(rng.choice(list(signs), rng.integers(1, 9))) for _ in range(150)]
    assert [decode(w) for w in words] == [all_paths(w, model) for w in words]


def buckets_of(text):
    """The n-gram buckets of a text, one character after the other."""
    x = [language_id._letter(ord(c)) for c in text or ""]
    out = []
    for n in language_id.SIZES:
        for i in range(len(x) - n + 1):
            if n == 1 and not x[i]:
                continue
            h = 0
            for c in x[i:i + n]:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ (c * 0x9E3779B1 & 0xFFFFFFFF)
            out.append(((h ^ (n * 0x05EBCA6B & 0xFFFFFFFF)) * 0xC2B2AE35 & 0xFFFFFFFF) >> 16)
    return out, any(x)


def test_language_posteriors(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows = [(i, t[:3000] if t else t, g) for i, t, g in rows[:120]] + [(10 ** 6, None, "en"), (10 ** 6 + 1, "12 !", "de"), (10 ** 6 + 2, "Ab\U0001D400 c", None)]
    held = {i: crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    grams = {i: buckets_of(t) for i, t, _ in rows}
    counts, priors = {}, Counter()
    for i, _, lang in rows:
        if lang is not None and not held[i]:
            priors[lang] += 1
            counts.setdefault(lang, Counter()).update(grams[i][0])
    want = {}
    for i, _, _ in rows:
        logs = {}
        for lang, seen in counts.items():
            whole = sum(seen.values()) + language_id.SMOOTHING * language_id.BUCKETS
            logs[lang] = math.log(priors[lang] / sum(priors.values())) + sum(
                math.log((seen[g] + language_id.SMOOTHING) / whole) for g in grams[i][0])
        top = max(sorted(logs), key=logs.get)
        score = 1 / sum(math.exp(v - logs[top]) for v in logs.values())
        want[i] = (top, score) if grams[i][1] else ("und", 0.0)
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == held[r.doc_id] and r.lang_pred == want[r.doc_id][0]
        assert r.score == pytest.approx(want[r.doc_id][1], abs=1e-3)


def spark_hash(*values):
    """Spark's xxhash64 of a string, or of longs one after the other."""
    h = 42
    for v in values:
        h = xxhash.xxh64(v.encode() if isinstance(v, str) else v.to_bytes(8, "little"), seed=h).intdigest()
    return h


def test_quality_verdicts(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    trusted = {r.doc_id for r in labels.where("quality = 1").collect()}
    classes = {}
    for r in docs.select("doc_id", "text").collect():
        h = [spark_hash(w) for w in WORD.findall(r.text or "")]
        classes[r.doc_id] = [x % quality.BUCKETS for x in h] + [spark_hash(a, b) % quality.BUCKETS for a, b in zip(h, h[1:])]
    raw, target = Counter(), Counter()
    for i, found in classes.items():
        raw.update(found)
        target.update(found if i in trusted else ())
    of_target = sum(target.values()) + quality.SMOOTHING * quality.BUCKETS
    of_raw = sum(raw.values()) + quality.SMOOTHING * quality.BUCKETS
    ratio = {b: round(1000 * (math.log((target[b] + quality.SMOOTHING) / of_target) - math.log((raw[b] + quality.SMOOTHING) / of_raw)))
             for b in raw}
    mean = {i: math.floor(sum(map(ratio.get, found)) / len(found)) if found else None for i, found in classes.items()}
    got = quality.judge(docs, labels).collect()
    assert {r.doc_id: r.llr for r in got} == mean and len(got) == len(mean)
    own = sorted(mean[r.doc_id] for r in got if r.doc_id in trusted and not r.base_failed)
    cut = own[math.floor(quality.TARGET_LOSS * len(own))]
    assert {r.doc_id: r.kept for r in got} == {r.doc_id: not r.base_failed and mean[r.doc_id] >= cut for r in got}
    assert {r.kept for r in got} == {True, False}
