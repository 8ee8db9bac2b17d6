"""Fingerprints, source divergence and centroid clustering against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from trustlens.llm import centroids, divergence, fingerprints

WORDS = "the of and Alpha beta Gamma delta omega river stone light under over green été Straße 日本 x1y".split()


# --- fingerprints

def edit_texts():
    r = random.Random(8)
    base = [" ".join(r.choice(WORDS) for _ in range(r.randint(0, 90))) for _ in range(60)]
    near = [t[:40] + "Q" + t[40:] for t in base[:20]]
    return [*base, *near, base[0], None, "", "a", "ab", "abc", "z" * 30_000, "é" * 5, "𝄞 clef " * 20]


@pytest.mark.parametrize("range_bytes", [1 << 22, 300])
def test_fingerprints_of_edited_and_next(spark, range_bytes):
    texts = edit_texts()
    data = [(i * 3, t, "clash", 1, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string, r string, k int, h string").repartition(5)
    got = {r.doc_id: r for r in fingerprints.report(df, range_bytes=range_bytes).collect()}
    walks, order = fingerprints.Walks(), sorted(range(len(texts)), reverse=True)

    def whole(t):
        codes = walks.codes(t)
        return walks.sample(codes, walks.gaps(codes)[0])

    prints = [whole(t or "") for t in texts]
    for i, j in zip(order, [*order[1:], order[0]], strict=True):
        a, b = texts[i] or "", texts[j] or ""
        m = len(a) // 3
        edited, row = a[:len(a) - m] + b[:m], got[3 * i]
        assert (row.n_chars, row.edited_sha256) == (len(a), hashlib.sha256(edited.encode()).hexdigest())
        assert row.fingerprint == prints[i].astype(">u2").tobytes().hex()
        assert row.edited_fingerprint == whole(edited).astype(">u2").tobytes().hex()
        assert row.near_edited == (prints[i] == whole(edited)).mean() and row.near_next == (prints[i] == prints[j]).mean()
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * (prints[i] == prints[j]).sum() >= 75 * len(prints[i]):
                x, y = sorted((parent[i], parent[j]))
                parent = [x if p == y else p for p in parent]
    assert [got[3 * i].class_id for i in range(len(texts))] == [3 * p for p in parent]


def test_walk_is_the_plain_walk():
    """The look-up walk equals one that asks the random bits step by step."""
    walks = fingerprints.Walks(8)
    codes = walks.codes("".join(random.Random(2).choice("abc é日") for _ in range(3000)))
    gaps, state = walks.gaps(codes)
    step = 0
    for c, g in zip(codes.tolist(), gaps.tolist(), strict=True):
        kind, n = (c ^ c >> 8 ^ c >> 16) & 255, 1
        while walks.then[kind][(step + n - 1) % fingerprints.PERIOD] != (step + n) % fingerprints.PERIOD:
            n += 1  # the bit of this step says: stay
        assert g == n
        step += n
    assert state == step % fingerprints.PERIOD


def test_likeness_falls_with_edits_and_not_with_place():
    r, walks = random.Random(4), fingerprints.Walks(256)
    text = "".join(r.choice("abcdefghij klmnop") for _ in range(4000))

    def whole(t):
        codes = walks.codes(t)
        return walks.sample(codes, walks.gaps(codes)[0])

    def edited(n):
        t = list(text)
        for _ in range(n):
            t[r.randrange(len(t))] = r.choice("xyz")
        return "".join(t)

    shares = [fingerprints.likeness(whole(text), whole(edited(n))) for n in (0, 4, 400)]
    assert shares[0] == 1 and shares[0] > shares[1] > 0.6 and shares[1] > shares[2]
    assert fingerprints.likeness(whole(text), whole("".join(r.choice("abcdefghij klmnop") for _ in range(4000)))) < 0.05


def test_fingerprints_of_odd_keys(spark):
    schema = "doc_id long, text string"
    data = [(None, "no key"), (5, "b same key"), (5, "a same key"), (5, "a same key"), (1, "one"), (None, None)]
    rows = fingerprints.report(spark.createDataFrame(data, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in rows) == sorted((k or 0, len(t or "")) for k, t in data)
    assert fingerprints.report(spark.createDataFrame([], schema)).count() == 0
    one = fingerprints.report(spark.createDataFrame([(7, "alone it is")], schema)).first()
    assert (one.near_next, one.edited_sha256) == (1.0, hashlib.sha256(b"alone italo").hexdigest())
    assert fingerprints.fingerprint(spark.createDataFrame(data, schema)).count() == len(data)


# --- source divergence

def brute_divergence(data, least=3, scale=10**9, top=200):
    kept_docs, counts, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in data:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
        langs[lang].add(source)
        kept_docs[lang].update(set(words))
        counts[lang, source].update(words)
        counts[lang, None].update(words)
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in kept_docs[lang].items() if n >= least]
        sizes = {s: sum(counts[lang, s][t] for t in kept) for s in [*sources, None]}

        def p(s, t):
            return 1 + scale * (counts[lang, s][t] + 1) // (sizes[s] + len(kept))  # noqa: B023

        def f(a, b):
            return (a - b) ** 2 // b

        for s in sources:
            pairs = [(-sum(f(p(s, t), p(o, t)) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-f(p(s, t), p(None, t)), t.encode(), t) for t in kept if counts[lang, s][t] and p(s, t) > p(None, t)]
            for part, rows, most in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(sorted(rows)[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("held", [10**6, 0])
def test_divergence(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "PAIRS_HELD", held)
    monkeypatch.setattr(divergence, "HELD", held)
    r = random.Random(6)
    data = [(r.choice(["en", "de", None]), r.choice(["a", "b", "c", "d", None, "É"]),
             " ".join(r.choice(WORDS) for _ in range(r.randint(0, 40))) + r.choice(["", " The-THE!", " once%d" % r.randint(0, 99)]))
            for _ in range(150)]
    data += [("fr", "a", "seul"), ("fr", "b", None), ("it", "only", "uno uno due"), ("en", "empty", ""), ("en", "a", "the " * 9000)] + [data[0]] * 3
    df = spark.createDataFrame([(*d, 1, "x") for d in data], "lang string, source string, text string, n long, term string").repartition(5)
    assert sorted(map(tuple, divergence.audit(df, top=5).collect())) == brute_divergence(data, top=5)
    assert divergence.audit(df.where("false")).count() == 0


def test_one_source_holds_most_rows(spark):
    data = [("en", "hot", f"alpha beta word{i % 7}") for i in range(200)] + [("en", f"s{i}", "alpha gamma") for i in range(12)]
    df = spark.createDataFrame(data, "lang string, source string, text string")
    assert sorted(map(tuple, divergence.audit(df).collect())) == brute_divergence(data)


# --- centroid clustering

def brute_clusters(data, k=8, rounds=10, dims=64, scale=1024):
    own = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v in data
           if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    v = np.array([x for _, x in own], object).reshape(-1, dims)
    first = sorted(range(len(own)), key=lambda i: (hashlib.sha256(f"3:{'' if own[i][0] is None else own[i][0]}".encode()).hexdigest(), own[i][1]))[:k]
    c = v[first]
    for n in range(rounds + 1):
        d = ((v[:, None, :] - c[None]) ** 2).sum(axis=2)
        at = np.array([min(range(len(c)), key=lambda j: (row[j], j)) for row in d], int)
        if n < rounds:
            c = np.array([[sum(col) // len(col) for col in v[at == j].T] if (at == j).any() else c[j] for j in range(len(c))], object)
    dist = [d[i, at[i]] for i in range(len(own))]
    inertia = [sum(x for x, a in zip(dist, at, strict=True) if a == j) for j in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted((-1 if own[i][0] is None else own[i][0], int(at[i]), dist[i], inertia[at[i]], sum(dist), sha[at[i]]) for i in range(len(own)))


@pytest.mark.parametrize("block,chunk", [(4, 4096), (7, 10)])
def test_clusters(spark, block, chunk):
    r = np.random.default_rng(1)
    data = [(i, [float(x) for x in r.normal(size=64).astype(np.float32)]) for i in range(120)]
    data += [(200 + i, data[3][1]) for i in range(40)] + [(3, data[5][1]), (None, data[7][1])]
    odd = [(300, None), (301, []), (302, data[0][1][:63]), (303, [*data[0][1][:63], None]), (304, [*data[0][1][:63], float("nan")]),
           (305, [*data[0][1][:63], float("-inf")])]
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in data + odd], "vec_id long, embedding array<float>, id string, cluster int").repartition(4)
    got = sorted((x[0] if x[0] is not None else -1, *x[1:]) for x in map(tuple, centroids.cluster(df, block=block, chunk=chunk).collect()))
    assert got == brute_clusters(data + odd)


def test_clusters_of_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    data = [(1, [0.5] * 64), (2, [-0.5] * 64), (9, [1e300] * 64)]
    got = {r.vec_id: r for r in centroids.cluster(spark.createDataFrame(data, schema)).collect()}
    assert set(got) == {1, 2} and all(r.distance == r.inertia == 0 for r in got.values())
    assert centroids.cluster(spark.createDataFrame([], schema)).count() == 0
