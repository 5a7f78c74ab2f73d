"""Vector codes, the manifest and URL rules against brute force, and edge rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rollwise.llm import manifest, queries, url_filter, vector_codes

INF, NAN = float("inf"), float("nan")


# ---- vector codes ----

@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 5), st.integers(0, 3), st.integers(0, 1 << 30))
def test_tree_finds_the_least_index_of_the_nearest(k, width, spread, seed):
    rng = np.random.default_rng(seed)
    reach = 10 ** spread
    entries, x = rng.integers(-reach, reach + 1, (k, width)), rng.integers(-reach, reach + 1, (50, width))
    entry, square = vector_codes.Gnat(entries).nearest(x)
    every = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (entry == every.argmin(1)).all() and (square == every.min(1)).all()


def brute_codes(rows):
    whole = [(v, lab, [math.floor(4096 * c) for c in x]) for v, x, lab in rows
             if x and all(c is not None and math.isfinite(c) for c in x)]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(whole[0][2])
    whole = [r for r in whole if len(r[2]) == width]
    ends = vector_codes.cuts(width)
    books = [[r[2][a:b] for r in whole if r[0] is not None][:16] for a, b in ends]

    def nearest(x, book):
        return min((sum((p - q) ** 2 for p, q in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(6):
        for p, (a, b) in enumerate(ends):
            held = defaultdict(list)
            for r in whole:
                held[nearest(r[2][a:b], books[p])[1]].append(r[2][a:b])
            for e, xs in held.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[nearest(r[2][a:b], books[p]) for p, (a, b) in enumerate(ends)] for r in whole]
    errors = [sum(d for d, _ in f) for f in found]
    total = defaultdict(int)
    for r, e in zip(whole, errors):
        total[r[1]] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(r[0], "".join(f"{i:02x}" for _, i in f), e, total[r[1]], sha) for r, f, e in zip(whole, found, errors)]


def vectors(n, width, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(c) for c in rng.integers(-9, 9, width) / 4096], int(i) % 3 or None) for i in rng.permutation(n) + 50]
    rows[3:3] = [(1, None, 1), (2, [], 1), (3, [NAN] + [0.0] * (width - 1), 1), (4, [INF] * width, None), (5, [None] * width, 2),
                 (None, [0.5] * width, 2), rows[0], rows[0], (7000, [0.1] * (width + 1), 1), (7001, [1e30] * width, 1)]
    return rows


@pytest.mark.parametrize("n,width", [(200, 16), (9, 8), (40, 11), (60, 3)])
def test_codes_match_brute_force(spark, n, width):
    rows = vectors(n, width, n)
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows],
                               "vec_id long, embedding array<double>, label int, error double, code string")
    got = vector_codes.encode(df.repartition(3)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(brute_codes([r for r in rows if r[1] is None or 1e30 not in r[1]]))


def test_codes_of_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    empty = vector_codes.encode(spark.createDataFrame([], schema))
    assert empty.collect() == [] and empty.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes.encode(spark.createDataFrame([(1, None, 1), (2, [NAN], 1)], schema)).collect() == []


# ---- manifest ----

def H(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """Root and each leaf's siblings (left, right) by level."""
    paths, at, cur = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(cur) > 1:
        for i, p in enumerate(at):
            a = p // 3 * 3
            paths[i].append(("".join(cur[a:p]), "".join(cur[p + 1:a + 3])))
        at = [p // 3 for p in at]
        cur = [H(*cur[i:i + 3]) for i in range(0, len(cur), 3)]
    return cur[0], paths


def brute_manifest(rows):
    names = ("doc_id", "source", "lang", "n_chars", "text")
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append((r["doc_id"], H(*[field(r[c]) for c in names]), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    low = [tree([leaf for _, leaf, _ in by[s]]) for s in order]
    root, high = tree([sub for sub, _ in low])
    out = []
    for s, (sub, paths), above in zip(order, low, high):
        for (doc, leaf, r), path in zip(by[s], paths):
            fold = leaf
            if doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0 and r["text"] is not None:
                fold = H(*[field((r | {"text": r["text"].replace("\n", "")})[c]) for c in names])
            for left, right in path + above:
                fold = H(left, fold, right)
            out.append((doc, leaf, sub, root, H(*[x + y for x, y in path + above]), fold, fold == root))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf int, tree string, verified int"


@pytest.mark.parametrize("sizes", [{"only": 1}, {None: 1, "": 1, "a": 1, "é": 1, "z": 4}, {"hot": 300, "b": 82, "c": 81, None: 3},
                                   {f"s{i}": 1 + i % 2 for i in range(30)}])
def test_manifest_matches_brute_force(spark, sizes):
    rows, n = [], 0
    for source, many in sizes.items():
        for k in range(many):
            n += 7
            text = [None, "", "a\nb\n", "straße 😀\n", "x" * 4000][n % 5]
            rows.append({"doc_id": n if k else n - 40, "text": text, "lang": None if n % 3 else "en", "source": source, "n_chars": n % 4 or None})
    rows.append(rows[0])  # a repeated row
    if len(rows) > 20:
        rows += [rows[5] | {"text": "other"}, rows[6] | {"doc_id": None}, rows[7] | {"doc_id": None}]
    df = spark.createDataFrame([(*[r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")], 1, "t", 0) for r in rows], SCHEMA)
    got = manifest.verify(df.repartition(3)).drop("source").collect()
    assert Counter(map(tuple, got)) == Counter(brute_manifest(rows))


def test_manifest_of_nothing(spark):
    assert manifest.verify(spark.createDataFrame([], SCHEMA)).collect() == []


# ---- URL rules ----

URLS = [None, "", "no scheme/org/", "http://ORG", "http://org/", "https://www.Example.org/es/a?x#y", "http://example.org/en/12",
        "http://example.org/en/", "http://badexample.org/es/", "http://a.b.com/fr/x/y", "http://com/de/", "http://xcom/de/", "http://com",
        "http://example.org:80/es/", "x://y://z.org/p", "http://é.org/ü", "http:///org/", "http://org?x=://com/de/", "ftp://İ.ORG/",
        "http://" + "a." * 3000 + "org/" + "b" * 5000]


def brute_verdict(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host = m[1].translate({c: c + 32 for c in range(65, 91)}) if m else ""
    path = m[2] if m else ""
    fit = [(len((h + p).encode()), len(h.encode()), v == "block", h + p) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], "allow" if best is None else "block" if best[2] else "allow"


def test_url_rules_match_brute_force(spark):
    rules = url_filter.parsed(queries.URL_RULES) + [("z.org", "", "block"), ("é.org", "/ü", "block"), ("z.org", "", "allow")]
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS + URLS)], "page_id long, url string, host string, rule string")
    got = url_filter.judge(df.repartition(3), spark.createDataFrame(rules, url_filter.SCHEMA)).collect()
    assert Counter(map(tuple, got)) == Counter((i, *brute_verdict(u, rules)) for i, u in enumerate(URLS + URLS))


def test_many_rules_and_none(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "CHUNK", 100)  # several passes over the sorted rules
    rules = [(f"h{i}.net", "/" + "p" * (i % 3), "block" if i % 2 else "allow") for i in range(1000)]
    urls = [f"http://s.h{i}.net/{'p' * (i % 5)}" for i in range(0, 2000, 3)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, spark.createDataFrame(rules, url_filter.SCHEMA)).collect()}
    assert got == {i: brute_verdict(u, rules) for i, u in enumerate(urls)}
    none = spark.createDataFrame([], url_filter.SCHEMA)
    assert {r.verdict for r in url_filter.judge(df, none).collect()} == {"allow"}
    assert url_filter.judge(df.limit(0), spark.createDataFrame(rules, url_filter.SCHEMA)).collect() == []


def test_equal_digests_are_told_apart_by_their_strings(tmp_path):
    names = [(b"a.org", b"/"), (b"b.org", b"/"), (b"c.org", b"/")]
    starts = np.array([(6 * i, 5, 1, i == 1) for i in range(3)], np.uint64)
    data = url_filter.MAGIC + np.uint64(3).tobytes() + np.full(3, 77, np.uint64).tobytes() + starts.tobytes()
    (tmp_path / "r.bin").write_bytes(data + b"".join(h + p for h, p in names))
    (tmp_path / "r.shapes").write_bytes(np.array([[5, 1]], np.uint64).tobytes())
    table = url_filter.Rules(str(tmp_path / "r"))
    found = table.find(np.full(4, 77, np.uint64), [h for h, _ in names] + [b"d.org"], [b"/"] * 4)
    assert found.tolist() == [0, 1, 2, -1]
