"""Benchmark decontamination: Wu-Manber search over words.

The test strings are windows of ten consecutive item words (an item of fewer
words is one shorter window). Symbols are words, blocks are two words: a shift
table keyed by block says how far the search may jump, the last block of a
window selects a bucket of test strings, and direct comparison confirms.
Windows of different lengths have a table each. The texts are searched where
they are scanned: nothing is shuffled.

The tables are built from the benchmark in blocks of bounded size
(``BLOCK_CHARS``), each searched in one pass over the documents, so what is sent
to the executors never grows beyond the block.

Null text has no words; items without words have no windows; repeated items
share their windows under each id; a null item_id is reported as ``null``;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlens.llm.common import small_batches

WINDOW = 10
BLOCK_CHARS = 50_000_000  # most benchmark characters sent to the executors at once
# Bytes of word characters in lower case, all others blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Tables:
    """Shift table and suffix buckets of all test strings of one length."""

    def __init__(self, length: int):
        self.length = length
        self.shift: dict = {}
        self.bucket: dict = defaultdict(dict)

    def add(self, window: tuple[bytes, ...], item: str) -> None:
        n = self.length
        if n == 1:
            self.bucket[window].setdefault(window, set()).add(item)
            return
        for j in range(1, n):
            block = window[j - 1:j + 1]
            self.shift[block] = min(self.shift.get(block, n - 1), n - 1 - j)
        self.bucket[window[-2:]].setdefault(window, set()).add(item)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(start, items) of every occurrence, in order."""
        n, at, end = self.length, self.length - 1, len(words)
        if n == 1:
            for at, w in enumerate(words):
                if (w,) in self.bucket:
                    yield at, self.bucket[(w,)][(w,)]
            return
        shift = self.shift.get
        while at < end:
            jump = shift((words[at - 1], words[at]), n - 1)
            if jump:
                at += jump
                continue
            start = at - n + 1
            here = words[start:at + 1]
            for window, items in self.bucket[(words[at - 1], words[at])].items():
                if here == list(window):
                    yield start, items
            at += 1


def build(items, window: int = WINDOW) -> list[Tables]:
    """Search tables, one per window length, of (item_id, text) pairs."""
    tables: dict[int, Tables] = {}
    for item, text in items:
        words = words_of(text.encode() if text is not None else None)
        n = min(window, len(words))
        for s in range(len(words) - n + 1 if n else 0):
            tables.setdefault(n, Tables(n)).add(tuple(words[s:s + n]), "null" if item is None else str(item))
    return list(tables.values())


def search_all(words: list[bytes], tables: list[Tables]) -> tuple[list[tuple[int, int]], set[str]]:
    spans, items = [], set()
    for t in tables:
        for start, found in t.search(words):
            spans.append((start, start + t.length))
            items |= found
    return spans, items


def _covered(spans) -> int:
    total, end = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", window: int = WINDOW,
         keep_text: bool = False) -> DataFrame:
    """key, n_words, n_hit, n_items, items (sorted strings) of every document;
    with ``keep_text`` also the row itself as ``row``."""
    spark = docs.sparkSession
    small_batches(spark)
    bench = benchmark.select("item_id", "text")
    chars = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + int(chars) // BLOCK_CHARS
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = docs.select(F.col(f"`{key}`").alias(key), F.col("text").cast("binary").alias("text"),
                      F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"),
                      *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_text else []))
    schema = out.schema
    for b in range(blocks):
        sent = spark.sparkContext.broadcast([tuple(r) for r in bench.where(part == b).collect()])

        def scan(batches, sent=sent):
            tables = build(sent.value, window)
            for batch in batches:
                spans, items = [], []
                for text, s, i in zip(batch["text"], batch["spans"], batch["items"], strict=True):
                    found, ids = search_all(words_of(text.as_py()), tables)
                    spans.append([*s.as_py(), *(x for p in found for x in p)])
                    items.append(sorted({*i.as_py(), *ids}))
                cols = [pa.array(spans, pa.list_(pa.int32())) if n == "spans" else
                        pa.array(items, pa.list_(pa.string())) if n == "items" else batch[n]
                        for n in batch.schema.names]
                yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

        out = out.mapInArrow(scan, schema)

    def count(batches):
        for batch in batches:
            flat = [s.as_py() for s in batch["spans"]]
            yield pa.RecordBatch.from_arrays(
                [batch[key], pa.array([len(words_of(t.as_py())) for t in batch["text"]], pa.int64()),
                 pa.array([_covered(zip(s[::2], s[1::2], strict=True)) for s in flat], pa.int64()),
                 batch["items"], *([batch["row"]] if keep_text else [])],
                names=[key, "n_words", "n_hit", "items", *(["row"] if keep_text else [])])

    kind = dict((f.name, f.dataType) for f in schema)
    result = f"`{key}` {kind[key].simpleString()}, n_words long, n_hit long, items array<string>"
    return out.mapInArrow(count, result + (f", row {kind['row'].simpleString()}" if keep_text else "")) \
        .withColumn("n_items", F.size("items").cast("long"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns of every document."""
    return find(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window occurs, with their own columns."""
    return find(docs, benchmark, docs.columns[0], keep_text=True).where("n_hit = 0").select("row.*")


def brute_force(docs, items, window: int = WINDOW):
    """(doc_id, n_words, n_hit, item ids) by comparing every place with every window."""
    tests = []
    for item, text in items:
        w = words_of(text.encode() if text is not None else None)
        n = min(window, len(w))
        tests += [(tuple(w[s:s + n]), "null" if item is None else str(item)) for s in range(len(w) - n + 1 if n else 0)]
    for doc, text in docs:
        w = words_of(text.encode() if text is not None else None)
        hit, ids = set(), set()
        for test, item in tests:
            for s in range(len(w) - len(test) + 1):
                if tuple(w[s:s + len(test)]) == test:
                    hit |= set(range(s, s + len(test)))
                    ids.add(item)
        yield doc, len(w), len(hit), ",".join(sorted(ids)), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


# Windows as strings ' w1 w2 ... ' so that SQL joins them by equality.
ORACLE = r"""
WITH dw AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS MATERIALIZED (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
tests AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM tests),
places AS MATERIALIZED (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
found AS MATERIALIZED (SELECT doc_id, item_id, p.n, i FROM places p JOIN tests q ON p.n = q.n AND p.t = q.t),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""
