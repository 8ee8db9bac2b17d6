"""Each operator against brute force, on null, empty, repeated and empty-table input."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustlens.llm import (decontaminate, extract, licenses, linedup, neardup, packing, pii, quality, repeats, urls)

WORDS = "the of and alpha beta gamma delta omega river stone light under over green".split()


def texts(n=40, seed=5):
    r = random.Random(seed)
    base = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 70))) for _ in range(n)]
    near = [t + " extra" for t in base[:8]]
    return [*base, *near, base[0], base[0], None, "", " \n ", "x" * 5000, "é " * 30]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, n long")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_packing_round_trip(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer
    got = packing.pack(docs, capacity=64).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    for i, t in enumerate(texts()):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        own = got[got.doc_id == i].sort_values("piece")
        assert own.length.tolist() == [len(ids[k:k + 64]) for k in range(0, len(ids), 64)]
    g = got.sort_values(["sequence_id", "offset"])
    assert (g.groupby("sequence_id").length.cumsum() - g.length == g.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 64
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 64) + 2
    assert packing.pack(none).count() == 0


def test_decontamination(spark, docs, none):
    items = [(1, " ".join(WORDS[:12])), (2, "gamma delta"), (3, None), (4, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    more = docs.select("doc_id", "text").unionAll(spark.createDataFrame([(99, "a " + " ".join(WORDS[:11]).upper() + ", z")], "doc_id long, text string"))
    got = rows(decontaminate.report(more, bench))
    data = [(i, t) for i, t in enumerate(texts())] + [(99, "a " + " ".join(WORDS[:11]).upper() + ", z")]
    for doc, n, hit, _, digest in decontaminate.brute_force(data, items):
        assert (got[doc].n_words, got[doc].n_hit, got[doc].items_sha256) == (n, hit, digest)
    assert decontaminate.report(none, bench).count() == 0
    assert decontaminate.clean(docs, bench.where("false")).columns == docs.columns


def test_near_duplicates(docs, none):
    got = rows(neardup.link(docs))
    hashes = neardup._Hashes()
    sets = [set(neardup.shingles(t.encode() if t else None, hashes).tolist()) for t in texts()]
    parent = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((parent[i], parent[j]))
                parent = [x if p == y else p for p in parent]
    assert {k: r.component_id for k, r in got.items()} == dict(enumerate(parent))
    assert [got[i].n_shingles for i in range(len(sets))] == [len(s) for s in sets]
    assert neardup.link(none).count() == 0
    assert neardup.dedup(docs).count() == len(set(parent))


@pytest.mark.parametrize("hot", [10**6, 3])
def test_repeated_bytes(spark, none, hot):
    r = random.Random(3)
    base = "".join(r.choice("ab é") for _ in range(300))
    data = ["".join(r.choice("abc") for _ in range(r.randint(0, 30))) + base[a:a + r.randint(0, 60)]
            for a in (r.randrange(280) for _ in range(100))] + [None, "", "a" * 90, "ab" * 60, base, base]
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    got = rows(repeats.report(df, length=20, gram=6, hot=hot))
    want = repeats.brute_force(data, 20)
    assert [tuple(got[i])[1:] for i in range(len(data))] == want
    assert repeats.report(none).count() == 0


def _distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_line_pairs_meet_and_verify():
    r = random.Random(1)
    for _ in range(1500):
        a = [r.choice("abé") for _ in range(r.randint(3, 9))]
        b = list(a)
        for _ in range(r.randint(0, 3)):
            b.insert(r.randint(0, len(b)), r.choice("ab")) if r.random() < 0.5 or not b else b.pop(r.randrange(len(b)))
        a, b = sorted(("".join(a), "".join(b)), key=len)
        near = _distance(a, b) <= 2
        assert linedup.within(a, b) == near
        if near and len(a) > 2:
            x = linedup.tokens([a], linedup.index_places)[1]
            assert set(x) & set(linedup.tokens([b], linedup.probe_places)[1])


def test_line_dedup(spark, none):
    line = "this is a boilerplate line that occurs in many documents"
    data = [(1, f"own text number one is long enough to judge\n{line}"), (2, f"short\n{line}"), (3, line.replace("many", "mony")),
            (4, None), (5, ""), (6, f"{line}\n{line}")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {k: r.removed for k, r in rows(linedup.report(df)).items()}
    assert got == {1: "", 2: "1", 3: "0", 4: "", 5: "", 6: "0,1"}
    kept = {k: r.text for k, r in rows(linedup.strip_lines(df)).items()}
    assert kept[2] == "short" and kept[1] == data[0][1] and kept[4] is None
    assert linedup.report(none).count() == 0



def test_line_dedup_of_every_length(spark):
    long = "this notice was last updated on {} and holds for all pages of the site, its archives and its mirrors, until it is withdrawn"
    data = [(1, "Menu\nAll rights reserved.\n--\n" + long.format("2024-01-12")), (2, "Menu\n--\nAll rights reserved!"),
            (3, "Mend\n" + long.format("2024-03-08")), (4, long.format("2019-12-31")), (5, "No rights reserved..")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {k: r.removed for k, r in rows(linedup.report(df)).items()}
    assert got == {1: "", 2: "0,2", 3: "1", 4: "", 5: ""}


def test_line_classes_meet():
    r = random.Random(4)
    for size, errors in ((10, 1), (29, 1), (30, 2), (99, 2), (100, 4), (150, 4)):
        for _ in range(60):
            a = "".join(r.choice("abcdé ") for _ in range(size))
            b = list(a)
            for _ in range(errors):
                b.insert(r.randint(0, len(b)), "x") if r.random() < 0.6 else b.__setitem__(r.randrange(len(b)), "y")
            ranges = {1: (10, 30), 2: (30, 100), 4: (100, 1 << 40)}
            x = linedup.tokens([a], linedup.index_places, errors, None, ranges[errors])[1]
            y = linedup.tokens(["".join(b)], linedup.probe_places, errors, None, ranges[errors])[1]
            assert linedup.errors_of(size) == errors and set(x) & set(y)



def test_line_dedup_of_null_and_repeated_keys(spark):
    line = "this is a boilerplate line that occurs in many documents"
    data = [(None, line), (None, "a clean line of its own\nand one more"), (1, line.replace("many", "mony")),
            (2, f"first of two rows\n{line}"), (2, "second of them\nnothing here repeats")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in linedup.strip_lines(df).collect()) == [
        (0, data[1][1]), (0, line), (1, ""), (2, "first of two rows"), (2, data[4][1])]


def test_pii_base(spark, none):
    data = ["mail a.b+c@x.example.com, c@d", "ip 1.2.3.4.5.6.7.8 and 300.1.1.1", "card 4539 1488 0343 6467 x",
            "+1 (743) 555-3824 +12", None, "", "é 1.2.3.4"]
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    got = rows(pii.report(df))
    assert [got[i].spans for i in range(len(data))] == [
        "email:5:24", "ip:3:10,ip:11:18", "card:5:24", "phone:0:17", "", "", "ip:2:9"]
    assert pii.report(none).count() == 0
    assert rows(pii.redact(df))[0].text == "mail [email], c@d"



def test_pii_adds_spans_of_each_kind(spark):
    wide = {"email": "ann{} (at) mail (dot) example (dot) org", "ip": "10[.]1[.]{}[.]7", "phone": "(743) 555-3{:03d}",
            "card": "4539.1488.0343.6467"}
    plain = {"email": "ann{}@mail.example.org", "ip": "10.1.{}.7", "phone": "+1 (743) 555-3{:03d}", "card": "4539 1488 0343 6467"}
    data = [(kind, f.format(i)) for kind in wide for f in (wide[kind], plain[kind]) for i in range(60)]
    data += [("", f"{i} 1[.]2[.]777[.]{i}, 123{i}; 4539.1488.0343.6468 me @ home . it") for i in range(120)]
    df = spark.createDataFrame([(i, f"see {t}") for i, (_, t) in enumerate(data)], "doc_id long, text string")
    got = rows(pii.report(df))
    for i, (kind, t) in enumerate(data):
        assert got[i].spans == (f"{kind}:4:{4 + len(t)}" if kind else ""), t


def test_pii_phone_of_single_digits(spark):
    data = ["+1-5-5-5-0-1-2-3-4", "call +4 9 3 0 1 2 3 4 5"]
    got = rows(pii.report(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")))
    assert [(got[i].n_phone, got[i].spans) for i in range(2)] == [(1, "phone:0:18"), (1, "phone:5:23")]


def test_licenses(spark, none):
    data = ["a\nReleased under the MIT Licence\nb", "Licensed under CC BY-NC 4.0.", "no", None,
            "Copyright 2020 Me\n\n" + licenses.TEXTS[0][1]]
    got = rows(licenses.scan(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")))
    assert [(got[i].licenses, got[i].whole) for i in range(5)] == [
        ("MIT", False), ("CC-BY-NC-4.0", True), ("", False), ("", False), ("MIT", True)]
    assert licenses.scan(none).count() == 0



def test_licenses_by_full_text_and_notice(spark):
    full = {i: "\n\n".join(t) for i, t in reversed(licenses.full_texts())}
    ids = sorted(full)
    code = "int a;\n/*\n * " + full["MIT"].replace("\n\n", "\n\n\n").replace("\n", "\n * ") + "\n */\nint b;"
    data = [*[full[i] for i in ids], *["first\n\n" + full[i] + "\n\nlast" for i in ids],
            "MIT License\n\nCopyright (c) 2020 Me\n\n" + full["MIT"], code, "x\n\n" + licenses.NOTICES[0][1] + "\n\ny",
            full["GPL-3.0"][:9000]]
    got = rows(licenses.scan(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")))
    want = [*[(i, True) for i in ids], *[(i, False) for i in ids], ("MIT", True), ("MIT", False), ("Apache-2.0", False), ("", False)]
    assert [(got[i].licenses, got[i].whole) for i in range(len(data))] == want


def test_quality(docs, none):
    got = rows(quality.judge(docs))
    for i, t in enumerate(texts()):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        hit = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        assert (got[i].n_words, got[i].word_chars, got[i].n_repeat_words) == (len(w), sum(map(len, w)), len(hit))
        assert got[i].base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
    assert quality.judge(none).count() == 0
    assert quality.filter_quality(docs).columns == docs.columns


def test_urls(spark):
    data = [(1, "http://A.example.net/en/1", None), (2, "x://b.net/q", ""), (3, "https://w.example.com/de/?a", ""),
            (4, "http://q.org", ""), (5, None, ""), (6, "no scheme", ""),
            (7, "http://link.example.org/a", '<a href="http://b.net/x">b</a>')]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in
           urls.judge_urls(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert got[1] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("b.net", "/q", "net/", "block")
    assert got[3] == ("w.example.com", "/de/", "example.com/de/", "block")
    assert got[4] == ("q.org", "", None, "allow") and got[5] == got[6] == ("", "", None, "allow")
    assert got[7][3] == "block"  # it links to a blocked host


def judged(spark, data):
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumns(
        {c: F.lit(0) for c in ("host", "path", "rule", "ruled", "n", "mass")})
    return {r.page_id: r.verdict for r in urls.judge_urls(df).collect()}


def test_urls_do_not_depend_on_other_seeds(spark):
    fans = [(i, f"http://f{i}.xyz/", '<a href="//hub.net/">x</a>') for i in range(50)]
    for seeds in (3, 3000):
        got = judged(spark, [(100, "http://hub.net/", None),
                             *[(1000 + i, f"http://s{i}.net/", "") for i in range(seeds - 1)], *fans])
        assert {got[i] for i in range(50)} == {"block"}, seeds


def test_urls_chain_ties_repeats_empty(spark):
    chain = [(i, f"http://c{i}.xyz/", f'<A HREF=//{"bad.net" if i == 1 else f"c{i - 1}.xyz"}/>') for i in range(1, 31)]
    got = judged(spark, [(0, "http://bad.net/", None), *chain, *chain, (99, "http://alone.xyz/", "")])
    assert {got[i] for i in range(31)} == {"block"} and got[99] == "allow"
    # A host between a trusted and a blocked one gets the same mass of both: allowed.
    tie = [(1, "http://good.org/fr/", '<a href="//mid.xyz/">'), (2, "http://mid.xyz/", '<a href="//bad.net/">'),
           (3, "http://bad.net/", "")]
    assert judged(spark, tie) == {1: "allow", 2: "allow", 3: "block"}
    assert judged(spark, []) == {}


def test_propagation_against_numpy(spark):
    r = random.Random(3)
    edges = [("trust", i, j, r.randint(1, 4)) for i in range(40) for j in range(40) if i != j and r.random() < 0.08]
    seeds = [("trust", i, 1.0) for i in range(0, 40, 9)]
    got = {x.host: x.mass for x in urls.propagate(spark.createDataFrame(seeds, "kind string, host int, mass double"), spark.createDataFrame(
        edges, "kind string, src int, dst int, n long")).collect()}
    w, base = np.zeros((40, 40)), np.zeros(40)
    for _, i, j, n in edges:
        w[j, i] = n
    w /= np.maximum(w.sum(axis=0), 1)
    for _, i, _ in seeds:
        base[i] = 1
    want = np.linalg.solve(np.eye(40) - urls.DAMPING * w, (1 - urls.DAMPING) * base)
    assert max(abs(want[i] - got.get(i, 0.0)) for i in range(40)) < 1e-6


def test_letters_beyond_ascii_go_to_the_merge_model():
    import public_tokenizers
    ids = packing._Ids(public_tokenizers.path(packing.TOKENIZER))
    whole, asked = ids._whole, []
    ids._whole = lambda word: asked.append(word) or whole(word)
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    plain = ["".join(letters), *letters, *(f"Ab{x}ci" for x in letters), "\u00c9oi\u00ea***", "for\u00e7\u00e8###", "the'", "a.,b", "x" * 70 + "\u00e9"]
    odd = ["e\u0301a", "\u0130x", "a\u00d7b", "don't", "\u00e9's", "\u03a3\u0391\u03a3", "\u00e91", "<|endoftext|>", "a<|endoftext|>", "\u00b5m"]
    for word in plain + odd:
        assert ids[word] == whole(word), word
    assert not [w for w in asked if any(x in w for x in letters) and w in plain]


def test_extraction(spark):
    page = "<body><nav>Menu</nav><div class='ad'>Buy</div>{}<p>{}</p><p>Same foot</p></body>"
    data = [(1, "http://h/a/1", page.format("", "One &amp;  text")), (2, "http://h/a/2", page.format("", "Two")),
            (3, "http://k/x", "<article><h1>T</h1><p>A<br>b</p></article><footer>f</footer>"), (4, None, None), (5, "http://z/", "")]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert got == {1: "One & text", 2: "Two", 3: "T\n\nA b", 4: "", 5: ""}



def test_extraction_of_copies_side_by_side(spark):
    page = "<body><p>All pages</p><p>{}</p><p>Same foot</p></body>"
    data = [(i, f"http://h/a/{i}", page.format("Copied" if 1 < i < 7 else f"Own {i}")) for i in range(1, 9)]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert got == {i: "Copied" if 1 < i < 7 else f"Own {i}" for i in range(1, 9)}


def test_pages_with_a_marked_article_are_differenced(spark):
    page = "<div>Same offer</div><article><p>{}</p><p>A quoted passage</p></article><div>{}</div>"
    data = [(1, "http://a.net/x/1", page.format("One", "own")), (2, "http://a.net/x/2", page.format("Two", "other")),
            (3, "http://b.net/x/1", page.format("Three", "far"))]
    got = {r.page_id: (r.text, r.n_shared) for r in extract.extract(
        spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert got == {1: ("One\n\nA quoted passage", 2), 2: ("Two\n\nA quoted passage", 2), 3: ("Three\n\nA quoted passage", 0)}


def test_extraction_empty_repeats_clashes(spark):
    schema = "page_id long, url string, html string, text string, row long, host string, places int"
    data = [(i, u, h, "t", 1, "h", 2) for i, u, h in
            [(1, "http://h/a", "<p>Same</p><p>one</p>"), (1, "http://h/a", "<p>Same</p><p>one</p>"),
             (2, "http://h/b", "<p>Same</p><p>two</p>"), (None, None, None)]]
    df = spark.createDataFrame(data, schema)
    got = sorted(((r.page_id or 0, r.text) for r in extract.extract(df).collect()))
    assert got == [(0, ""), (1, "one"), (1, "one"), (2, "two")]
    assert extract.extract(df.where("false")).count() == 0


def test_blocks_keep_articles_whole():
    kept = lambda h: [t for t, _, left in extract.blocks(h) if not left]
    assert kept("<p>" + "\u0130" * 30 + "</p><script>x</script><p>alpha</p><SCRIPT>y</ScRiPt ><p>beta</p>") == [
        "\u0130" * 30, "alpha", "beta"]
    assert kept('<article class="post comment-open"><p>main</p></article>') == ["main"]
    assert kept('<section id="search">a</section><div class="related-work">b</div><div class="notice-period">c</div>'
                '<blockquote class="reply">d</blockquote><p><math>1</math><label>e</label></p>') == ["a", "b", "c", "d", "1e"]
    assert kept('<div class="comment-list">a</div><div class="x ad">b</div><div id=site-header>c</div><p>d</p>') == ["d"]
    assert kept('<p>a < b <![CDATA[x < y]]> c<br>d<p title="x>y">e<!-- f --><p>g') == ["a < b x < y c d", "e", "g"]
    assert kept('<p>a<p class="open>b<p>c') == ["a", "b", "c"]  # a quote that never closes


@pytest.mark.parametrize("unit", ["<a ", '<a "', "<!", "<a<", '<a ">" ', "<!-- ", "<script>", "<nav><article>", "</a '"])
def test_blocks_are_linear(unit):
    start = time.process_time()
    extract.blocks(unit * (1_000_000 // len(unit)))
    extract.blocks(unit * (1_000_000 // len(unit)) + ">")
    assert time.process_time() - start < 10


def test_common_subsequence():
    assert extract.shared([1, 2, 3, 4], [2, 9, 4]) == [1, 3]
    assert extract.shared([], [1]) == []


def test_program_covers_every_length_and_makes_most_sequences():
    r = np.random.default_rng(5)
    counts = np.bincount(r.integers(1, 300, 3000), minlength=513)[1:]
    solved = packing.solve(counts, 512)
    covered = np.zeros(512)
    for config, amount in solved.x.items():
        assert sum(l * k for l, k in config) <= 512
        for l, k in config:
            covered[l - 1] += k * amount
    assert (covered >= counts - 1e-6).all()
    tokens = int((counts * np.arange(1, 513)).sum())
    assert tokens / 512 - 1e-6 <= solved.bound <= solved.value == pytest.approx(sum(solved.x.values()))
    assert solved.value <= 1.3 * solved.bound
    packed, of_program = packing.plan({i + 1: int(n) for i, n in enumerate(counts) if n}, 512)
    total = sum(m for _, m in packed)
    assert total == -(-tokens // 512) and of_program >= 0.7 * total


@pytest.mark.parametrize("histogram, fewest", [
    ({}, 0), ({100: 7}, 7), ({1: 250}, 3), ({60: 10**9, 30: 10**6, 40: 3}, 10**9), ({60: 10**6, 40: 10**6, 7: 1}, 10**6 + 1)])
def test_plan_of_uneven_counts(histogram, fewest):
    packed, _ = packing.plan(histogram, 100)
    assert sum(m for _, m in packed) == fewest
    for l, n in histogram.items():
        assert sum(config.get(l, 0) * m for config, m in packed) == n


def test_plan_holds_every_piece():
    r = np.random.default_rng(2)
    histogram = {int(k): int(v) for k, v in zip(r.integers(1, 100, 40), r.integers(1, 50, 40), strict=True)}
    left = dict(histogram)
    for config, m in packing.plan(histogram, 100, rounds=50)[0]:
        assert sum(l * k for l, k in config.items()) <= 100
        for l, k in config.items():
            left[l] -= m * k
    assert not any(left.values())
