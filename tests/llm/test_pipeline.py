"""The pipeline's stages against plain versions of them, and rows that must not be lost."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from trustlens.llm import linedup, neardup, quality

WORDS = ("river stone light under over green quiet morning window paper orange letter number seven market garden "
         "winter summer doctor travel bridge silver copper engine forest valley island harbor thunder ribbon").split()


def prose(r, n=80):
    return "\n".join(" ".join(r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(10)) + "." for _ in range(n // 10))


def test_within_many_is_within():
    r = random.Random(3)
    a, b, e = [], [], []
    for _ in range(3000):
        x = [r.choice("abcé") for _ in range(r.randint(0, 60))]
        y = list(x)
        for _ in range(r.randint(0, 6)):
            if r.random() < 0.5 or not y:
                y.insert(r.randint(0, len(y)), r.choice("abx"))
            else:
                y[r.randrange(len(y))] = r.choice("abz")
        a.append("".join(x))
        b.append("".join(y))
        e.append(r.choice([0, 1, 2, 4]))
    assert linedup.within_many(a, b, np.array(e)).tolist() == [linedup.within(*x) for x in zip(a, b, e, strict=True)]


def brute_lines(data):
    """doc -> places of the lines that are not the first of their class."""
    at = [(k, n, x) for k, t in data for n, x in enumerate(linedup.lines_of(t)) if linedup.WORD.search(x)]
    parent = list(range(len(at)))
    for i in range(len(at)):
        for j in range(i):
            x, y = at[i][2], at[j][2]
            e = linedup.errors_of(min(len(x), len(y)))
            if x == y or e and linedup.within(x, y, e):
                p, q = sorted((parent[i], parent[j]))
                parent = [p if z == q else z for z in parent]
    gone = {k: [] for k, _ in data}
    for i, (k, n, _) in enumerate(at):
        if min(j for j in range(len(at)) if parent[j] == parent[i]) != i:
            gone[k].append(n)
    return {k: ",".join(map(str, v)) for k, v in gone.items()}


@pytest.mark.parametrize("long_list,bucket", [(256, 1_000_000), (2, 50)])
def test_line_dedup_whole(spark, monkeypatch, long_list, bucket):
    """A family of one line, edited ever further, among lines of their own."""
    monkeypatch.setattr(linedup, "LONG_LIST", long_list)
    monkeypatch.setattr(linedup, "BUCKET_POSTINGS", bucket)
    r = random.Random(2)
    base = [" ".join(r.choice(WORDS) for _ in range(k)) for k in (3, 6, 25)]
    data = []
    for i in range(60):
        lines = []
        for x in base:
            x = list(x)
            for _ in range(r.randint(0, 7)):
                x[r.randrange(len(x))] = r.choice("abcdefgh")
            lines.append("".join(x))
        data.append((i, "\n".join([*lines, prose(r, 10), "short"])))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    assert {x.doc_id: x.removed for x in linedup.report(df).collect()} == brute_lines(data)


def test_postings_of_a_task_stay_few_in_memory(monkeypatch):
    """Over a million postings of one task: all of them come out, a bounded number at a time."""
    class Source:
        def mapInArrow(self, run, schema):
            return run

    r = random.Random(5)
    texts = ["\n".join(f"{r.getrandbits(480):0120x} {r.choice(WORDS)}" for _ in range(100)) for _ in range(300)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k:k + 100])], names=["text"]) for k in range(0, 300, 100)]
    monkeypatch.setattr(linedup, "_source", lambda docs, key: Source())
    run = linedup.postings(None, "doc_id", buckets=10)
    tracemalloc.start()
    try:
        count, ids = [0, 0], set()
        for out in run(iter(batches)):
            for side, tokens, of in zip(*(out[c].to_pylist() for c in ("side", "tokens", "ids")), strict=True):
                assert len(tokens) * 5 == len(of) * 4
                count[side] += len(tokens) // 4
                if side == 0:
                    ids.update(linedup._numbers(of, 5).tolist())
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert count[0] == 5 * 30_000 and len(ids) == 30_000 and count[1] > 1_000_000
    assert peak < 60, peak


def test_near_dedup_loses_no_row_of_its_own(spark):
    r = random.Random(4)
    a, own = prose(r), prose(r)
    df = spark.createDataFrame([(1, a), (2, a + " x"), (2, own)], "doc_id long, text string")
    for broadcast in (500_000, 0):
        assert sorted((x.doc_id, x.text) for x in neardup.dedup(df, broadcast_rows=broadcast).collect()) == sorted([(1, a), (2, own)])
    nulls = spark.createDataFrame([(None, a), (None, a + " x"), (3, a + " x y"), (None, own), (None, None)], "doc_id long, text string")
    assert {x.component_id for x in neardup.link(nulls).where("n_shingles > 0").collect()} == {3, None}
    assert sorted((x.doc_id or 0, x.text or "") for x in neardup.dedup(nulls).collect()) == sorted([(3, a + " x y"), (0, own), (0, "")])
    only = spark.createDataFrame([(None, a), (None, a + " x")], "doc_id long, text string")
    assert neardup.dedup(only).count() == 1


def test_stages(spark, tmp_path):
    r = random.Random(7)
    bench = " ".join(r.choice(WORDS) + "q" for _ in range(14))
    foot = "this footer line stands in many of the documents of the site"
    clean = [prose(r, 120) for _ in range(12)]
    data = [(i, t + ("\n" + foot if i % 2 else "")) for i, t in enumerate(clean)]
    data += [(20, clean[3] + " one more word"), (21, clean[4] + "\n" + bench), (22, "too short"), (23, None), (24, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]

    kept = stages["quality_rules"](spark, docs, str(tmp_path))
    assert {x.doc_id for x in kept.collect()} == {x.doc_id for x in quality.judge(docs).where("kept").collect()}
    assert not {x.doc_id for x in kept.collect()} & {22, 23, 24}
    full = docs.where("text IS NOT NULL AND text <> ''")
    left = stages["line_dedup"](spark, full, str(tmp_path))
    gone = brute_lines([(x.doc_id, x.text) for x in full.orderBy("doc_id").collect()])
    want = {x.doc_id: "\n".join(l for n, l in enumerate(x.text.split("\n")) if str(n) not in gone[x.doc_id].split(",")) for x in full.collect()}
    got = {x.doc_id: (x.text, x.n_chars) for x in left.collect()}
    assert got == {k: (t, len(t)) for k, t in want.items() if t.strip()}
    near = stages["minhash_near_dedup"](spark, docs.where("doc_id IN (3, 20, 5)"), str(tmp_path))
    assert {x.doc_id for x in near.collect()} == {3, 5}
    safe = stages["benchmark_decontamination"](spark, docs, str(tmp_path))
    assert {x.doc_id for x in safe.collect()} == {k for k, _ in data} - {21}
    packed = stages["best_fit_packing"](spark, docs, str(tmp_path))
    assert {x.doc_id for x in packed.collect()} == {k for k, _ in data}
    assert kept.columns == left.columns == near.columns == safe.columns == docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0, name
