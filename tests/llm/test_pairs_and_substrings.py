"""Joins and deduplication against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fernwell.llm.embeddings import near_duplicates, plan_tables
from fernwell.llm.jaccard import boundary, link_components, list_length
from fernwell.llm.shared import components
from fernwell.llm.substrings import difference_cover, remove_repeats


class Classes:
    def __init__(self, ids):
        self.p = {i: i for i in ids}

    def find(self, x):
        while self.p[x] != x:
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.p[b] = a


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_join(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    c = Classes(i for i, _ in sets)
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                c.join(i, j)
    return sorted((i, len(s), c.find(i)) for i, s in sets)


def test_jaccard_join(spark):
    r = random.Random(2)
    vocab = [f"w{k}" for k in range(300)]
    base = [[r.choice(vocab) for _ in range(n)] for n in (3, 4, 6, 8, 12, 20, 40, 80, 120, 200)]
    common = [r.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(220):
        words = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            words[r.randrange(len(words))] = r.choice(vocab).upper()
        rows.append((i, " ".join(words + (common if r.random() < 0.2 else []))))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "A b"), (904, "a  B"), (905, "a")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, block string")
    got = sorted(tuple(x) for x in link_components(df, block_bytes=5000, bucket_bytes=4000).collect())
    assert got == brute_join(rows)


def test_jaccard_empty_and_repeated(spark):
    schema = "doc_id long, text string"
    assert link_components(spark.createDataFrame([], schema)).count() == 0
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(5, long), (5, long), (2, long + " tail")]
    assert sorted(tuple(x) for x in link_components(spark.createDataFrame(rows, schema)).collect()) == [(2, 29_997, 2), (5, 29_996, 2), (5, 29_996, 2)]


def test_boundary_follows_cost():
    sizes = [(n, 10) for n in range(2, 400)]
    assert boundary(sizes, 2.0, 80) < boundary(sizes, 50.0, 80)
    # of the occurrences of shared shingles the rarest fifth: what few very common ones have is no matter
    assert list_length([(0, 500.0, 500.0), (1, 80.0, 160.0), (9, 320.0, 160_000.0)], 80) == 2.0 and list_length([], 80) == 1.0


def brute_repeats(rows, n):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + n] for _, b in texts for k in range(len(b) - n + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if seen[b[k : k + n]] > 1:
                gone[k : k + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeated_substrings(spark):
    r = random.Random(5)
    base = ["".join(r.choice("ab cdé") for _ in range(r.randrange(60, 200))) for _ in range(8)]
    rows = []
    for i in range(100):
        parts = []
        for _ in range(r.randrange(5)):
            b = r.choice(base)
            if r.random() < 0.5:
                k = r.randrange(len(b))
                b = b[:k] + "X" + b[k + 1 :]
            parts += [b[r.randrange(len(b) // 2) :], "".join(r.choice("abcdefgh") for _ in range(r.randrange(30)))]
        rows.append((i, "".join(parts)))
    rows += [(500, None), (501, ""), (502, "a" * 300), (503, "a" * 41 + "b"), (504, "a" * 300), (504, "a" * 300), (505, "xy" * 100)]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, block int")
    for length, prime in ((40, 5), (60, 7)):
        got = sorted(tuple(x)[:5] for x in remove_repeats(df, length, prime, 2000, 3000).collect())
        assert got == brute_repeats(rows, length)
    assert remove_repeats(df.limit(0)).count() == 0


def brute_passages(rows, n):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    holders: dict = {}
    for k, w in enumerate(words):
        for j in range(len(w) - n + 1):
            holders.setdefault(tuple(w[j : j + n]), set()).add(k)
    out = []
    for (i, _), w in zip(rows, words):
        inside = [False] * len(w)
        for j in range(len(w) - n + 1):
            if len(holders[tuple(w[j : j + n])]) > 1:
                inside[j : j + n] = [True] * n
        out.append((i, sum(x and not (k and inside[k - 1]) for k, x in enumerate(inside)), sum(inside)))
    return sorted(out)


def test_passages_of_other_documents(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abc") for _ in range(r.randrange(1, 4)))
    text = lambda n: [word() for _ in range(n)]
    shared = [text(n) for n in (11, 12, 13, 30, 80)]
    rows = []
    for i in range(80):
        parts = text(r.randrange(20))
        for _ in range(r.randrange(3)):
            parts += r.choice(shared)[: r.choice([10, 12, 99])] + text(r.randrange(12))
        rows.append((i, r.choice([" ", "\n"]).join(parts)))
    rows += [(100, "x y " * 40), (101, None), (102, "q " * 3), (103, rows[3][1]), (103, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (12, 40):
        got = remove_repeats(df, passage_words=n, block_bytes=1500, bucket_bytes=2000).select("doc_id", "n_passages", "n_passage_words")
        assert sorted(tuple(x) for x in got.collect()) == brute_passages(rows, n)


def test_unlike_words_of_two_letters_stay_apart(spark):
    """Thue-Morse words, which agree under polynomial hashes modulo a power of two."""
    words = []
    for two in ("ab", "xz"):
        w = two[0]
        for _ in range(10):
            w += w.translate(str.maketrans(two, two[::-1]))
        words += [w, w.translate(str.maketrans(two, two[::-1]))]
    df = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    assert sorted(tuple(x) for x in link_components(df).collect()) == [(i, 1, i) for i in range(4)]
    got = sorted(tuple(x)[:5] for x in remove_repeats(df, 600, 17).collect())
    assert got == brute_repeats(list(enumerate(words)), 600)


def test_join_of_documents_near_one_base(spark):
    """What a join compares beyond pivots grows with the rows, not with their square."""
    from fernwell.llm import jaccard

    made, keep = {}, jaccard.stash

    def count(df, label):
        out = keep(df, label)
        made[label] = max(made.get(label, 0), out.count())
        return out

    r, largest = random.Random(4), []
    base = [f"b{i}" for i in range(100)]
    jaccard.stash = count
    try:
        for n in (150, 450):
            rows = []
            for i in range(n):
                w = list(base)
                for j in r.sample(range(100), r.choice([2, 3, 4])):
                    w[j] = f"u{r.randrange(10**9)}"
                rows.append((i, " ".join(w)))
            made.clear()
            got = sorted(tuple(x) for x in link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
            assert got == brute_join(rows)
            largest.append(max(made.values()))
    finally:
        jaccard.stash = keep
    assert largest[1] < 4.5 * largest[0]


def test_rows_without_an_id_and_with_one_id(spark):
    from fernwell.llm.jaccard import one_of_each

    t = "one two three four five six seven eight nine ten"
    rows = [(None, t, "a"), (None, t, "b"), (4, t, "c"), (None, "other words here", "d"), (9, "p q r s t u", "e"), (9, "v w", "f"), (9, "v w", "g"), (10, None, "h"), (11, "", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _kept string")
    got = sorted((r.doc_id or -1, r.text) for r in one_of_each(df).select("doc_id", F.coalesce("text", F.lit("-")).alias("text")).collect())
    assert got == [(-1, "other words here"), (4, t), (9, "p q r s t u"), (9, "v w"), (10, "-"), (11, "")]
    assert one_of_each(df.limit(0)).columns == df.columns


def test_difference_covers():
    for p in (2, 3, 5, 7, 17):
        v, d = difference_cover(p)
        assert len(d) == p + 1 and {(a - b) % v for a in d for b in d} == set(range(v))


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)]
    c = Classes({x for e in edges for x in e})
    for a, b in edges:
        c.join(a, b)
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c.find(n) for e in edges if e[0] != e[1] for n in e}


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 64))
    x = np.concatenate([base] + [base[:20] + rng.normal(size=(20, 64)) * s for s in (0.05, 0.2, 0.45)] + [base[:5]] * 3 + [base[7:8] + rng.normal(size=(60, 64)) * 0.1])
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    u = np.array([v for _, v in rows], np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    bad = [(900, None), (901, []), (902, [0.0] * 64), (903, [float("nan")] + [1.0] * 63), (904, [None] + [1.0] * 63), (905, [float("inf")] * 64), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows + bad], "vec_id long, embedding array<float>, key int, code string")
    got = {r.vec_id: r for r in near_duplicates(df, block=16).collect()}
    want = near.sum(1) - 1
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.98 * want.sum()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(900, 906))
    assert got[906].n_links == got[907].n_links == 1 and got[907].component_id == 906 and not got[907].kept
    assert near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    """Over random rotations the mean estimate is the cosine, and the bound holds."""
    from fernwell.llm.embeddings import encode, estimate, in_bytes, rotations, unit

    rng = np.random.default_rng(8)
    dim, checked, n = 64, 2, 4000
    x = unit(rng.normal(size=(n, dim)))
    for cos in (0.5, 0.9):
        z = rng.normal(size=(n, dim))
        z = unit(z - (z * x).sum(1, keepdims=True) * x)
        both = np.concatenate((x, cos * x + np.sqrt(1 - cos * cos) * z))
        bits, factor = encode(both, checked)
        small, step = in_bytes(both)
        code = bits.reshape(2 * n, checked, dim).astype(np.float32) * 2 - 1
        turned = ((small * step[:, None]).astype(np.float32) @ rotations(dim, checked)).reshape(2 * n, checked, dim)
        est, half = estimate(code, factor, turned, step, np.arange(n), np.arange(n) + n)
        assert abs(est.mean() - cos) < 0.005 and (abs(est - cos) <= half).mean() > 0.999


def test_table_plan_grows_slowly():
    assert plan_tables(10**4, 0.9, 0.98)[1] < plan_tables(10**6, 0.9, 0.98)[1] < 200
