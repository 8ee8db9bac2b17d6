"""Divergence between sources, from a frequent-pattern tree of term rows.

Each language keeps the terms of at least ``least`` of its documents. A source gives a
kept term that occurs c times in it p = 1 + floor(scale * (c + 1) / (N + V)); two sources
differ by the sum over all kept terms of f(p, q) = floor((p - q)**2 / q). Most terms are
absent from most sources, so the sum starts as V * f(p of zero, q of zero). It is then
corrected, exactly and in three parts: terms the one has, terms the other has, and terms
that both have.

The last part comes from the tree. A term's row holds its (source, count) items, the
sources with most kept terms first. Equal rows are one row with a multiplicity;
the rows are dealt by ranges and sorted, so rows that share a path are neighbours. A task
inserts its rows one by one: the items a row shares with the one before are the same nodes,
whose multiplicities add up; a node that no later row can reach is closed, and adds, for
each of its ancestors, its pair's correction times its multiplicity. So a node-ancestor
combination is computed once however many terms pass it, and a task holds one path of the
tree and one number a pair of sources. A path cut by a border of two ranges counts in both
with its share of the multiplicity.

Terms are counted in Arrow batches and leave a task once per source; a hot source or term
is then a few rows a task. The best terms are ranked after a cut in each task.
Null text, language or source count as empty strings; repeated rows are documents of their
own; a source without a kept term has zero counts. An empty table gives no rows. Other
columns are ignored, whatever their names. A language without kept terms gives pairs of value 0.
"""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustlens.session import materialize

LEAST, SCALE, TOP = 3, 1_000_000_000, 200
HELD = 1_000_000  # terms a task counts before it sends them on
PAIRS_HELD = 1_000_000  # sums of pairs likewise
STEP = 1 << 20  # node-ancestor combinations computed at once
# Bytes of a term (letters, and all of characters beyond ASCII), A-Z lower-cased; others part terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs: partial counts of a task; a row with a
    null term for each group."""
    src = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                      F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def send():
            columns: list[list] = [[], [], [], [], []]
            for (lang, source), (every, own) in groups.items():
                columns[0] += [lang] * (len(every) + 1)
                columns[1] += [source] * (len(every) + 1)
                columns[2] += [*every, None]
                columns[3] += [*every.values(), 0]
                columns[4] += [*map(own.__getitem__, every), 0]
                if len(columns[0]) > 50_000:
                    yield table_of(columns)
                    columns = [[], [], [], [], []]
            groups.clear()
            yield table_of(columns)

        def table_of(c):
            return pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.string()), pa.array(c[1], pa.string()), pa.array(c[2], pa.binary()).cast(pa.string()),
                 pa.array(c[3], pa.int64()), pa.array(c[4], pa.int64())], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"], strict=True):
                words = text.as_py().translate(LETTERS).split()
                every, own = groups.setdefault((lang, source), (Counter(), Counter()))
                held -= len(every)
                every.update(words)
                own.update(set(words))
                held += len(every)
                if held >= HELD:
                    yield from send()
                    held = 0
        yield from send()

    return src.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _p(count: str, n: str, v: str, scale: int) -> Column:
    return F.expr(f"1 + (cast({scale} as decimal(10,0)) * cast({count} + 1 as decimal(27,0))) div cast({n} + {v} as decimal(20,0))")


def _f(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div ({q})"


def path_corrections(rows: DataFrame) -> DataFrame:
    """lang, a, b, c: what the terms that sources a and b both have add to f's sum beyond
    those that each has. ``rows``: lang, items (place of the source, p, its p of zero; in
    that order) and m, the number of terms with these items."""
    dealt = rows.repartitionByRange("lang", "items").sortWithinPartitions("lang", "items")

    def f(p, q):
        return (p - q) * (p - q) // q

    def run(batches):
        lang, last = None, np.empty((0, 3), np.int64)  # the path of the row before
        open_: list[tuple[int, int]] = []  # of each node on it: where its path starts in ``items``, terms that passed
        sums: dict[tuple[int, int], int] = {}
        closed: list[tuple[int, int, int]] = []  # (start of the path, depth, terms) of nodes not yet added

        def add(items):
            """The closed nodes meet their ancestors: the items of the same path before them."""
            a = 0
            while a < len(closed):
                b, room = a, STEP
                while b < len(closed) and (b == a or room >= closed[b][1]):
                    room -= closed[b][1]
                    b += 1
                start, depth, m = np.array(closed[a:b], np.int64).T
                a = b
                node, m = np.repeat(start + depth, depth), np.repeat(m, depth)
                up = np.arange(len(node)) - np.repeat(np.cumsum(depth) - depth - start, depth)
                (x, p, p0), (y, q, q0) = items[node].T, items[up].T
                both = np.stack([f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), f(q, p) - f(q0, p) - f(q, p0) + f(q0, p0)])
                pair, at = np.unique((x << 32) + y, return_inverse=True)
                # Exact sums: upper and lower halves apart, few enough terms at once.
                for terms in np.array_split(np.arange(len(m)), 1 + int(m.astype(float).sum()) // (1 << 30)):
                    for c, back in zip(both, (False, True), strict=True):
                        high, low = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
                        np.add.at(high, at[terms], (c[terms] >> 32) * m[terms])
                        np.add.at(low, at[terms], (c[terms] & 0xFFFFFFFF) * m[terms])
                        for k, h, w in zip(pair.tolist(), high.tolist(), low.tolist(), strict=True):
                            k = (k & 0xFFFFFFFF, k >> 32) if back else (k >> 32, k & 0xFFFFFFFF)
                            sums[k] = sums.get(k, 0) + (h << 32) + w
            closed.clear()

        def close(depth):
            while len(open_) > depth:
                start, m = open_.pop()
                if open_:
                    closed.append((start, len(open_), m))

        def send():
            keys = list(sums)
            for k in range(0, len(keys), 100_000):
                some = keys[k:k + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), pa.array([a for a, _ in some], pa.int32()), pa.array([b for _, b in some], pa.int32()),
                     pa.array([Decimal(sums[x]) for x in some], pa.decimal128(38, 0))], names=["lang", "a", "b", "c"])
            sums.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch["items"].flatten()
            own = np.stack([flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            # The open path comes first; its nodes are found there from now on.
            items, open_ = np.concatenate([last, own]), [(0, m) for _, m in open_]
            size = np.concatenate([[len(last)], pc.list_value_length(batch["items"]).to_numpy()]).astype(np.int64)
            start = np.cumsum(size) - size
            depth = np.arange(len(own)) - np.repeat(start[1:] - len(last), size[1:])
            before = np.repeat(start[:-1], size[1:]) + depth
            same = depth < np.repeat(size[:-1], size[1:])
            same &= (own == items[np.minimum(before, len(items) - 1)]).all(axis=1)
            shared = np.minimum.reduceat(np.where(same, np.repeat(size[1:], size[1:]), depth), start[1:] - len(last))
            for of, m, n, s, k in zip(batch["lang"].to_pylist(), batch["m"].to_pylist(), size[1:].tolist(), start[1:].tolist(), shared.tolist(), strict=True):
                if of != lang:
                    close(0)
                    add(items)
                    yield from send()
                    lang, k = of, 0
                close(k)
                open_ = [(a, c + m) for a, c in open_] + [(s, m)] * (n - k)  # a node's path starts where its first row does
            last = own[len(own) - int(size[-1]):]
            add(items)
            if len(sums) > PAIRS_HELD:
                yield from send()
        open_ = [(0, m) for _, m in open_]
        close(0)
        add(last)
        yield from send()

    return dealt.select("lang", "items", "m").mapInArrow(run, "lang string, a int, b int, c decimal(38,0)")


def audit(docs: DataFrame, least: int = LEAST, scale: int = SCALE, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank."""
    counts = count_terms(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = materialize(counts, "op12-counts")
    kept = (counts.where("term IS NOT NULL").groupBy("lang", "term")
            .agg(F.collect_list(F.struct("source", "n")).alias("own"), F.sum("n").alias("total"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= least).select("lang", "term", "total", F.inline("own")))
    kept = materialize(kept, "op12-kept")  # lang, term, total, source, n

    # Sources with their numbers, in the order of the tree.
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("terms"))
    langs = kept.groupBy("lang", "term").agg(F.first("total").alias("t")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("t").alias("all"))
    order = Window.partitionBy("lang").orderBy(F.desc("terms"), "source")
    zero = F.lit(0).cast("long")
    groups = (counts.where("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
              .fillna(0, ["size", "terms", "v", "all"]).withColumn("at", F.row_number().over(order))
              .withColumn("p0", F.when(F.col("v") > 0, _p("0", "size", "greatest(v, 1)", scale)).otherwise(zero)))
    groups = materialize(groups, "op12-groups")

    shares = (kept.join(groups, ["lang", "source"])
              .select("lang", "term", "source", "at", "p0", _p("n", "size", "v", scale).alias("p"), _p("total", "`all`", "v", scale).alias("q")))
    shares = materialize(shares, "op12-shares")

    rows = (shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("at", "p", "p0"))).alias("items"))
            .where(F.size("items") > 1).groupBy("lang", "items").agg(F.count("*").alias("m")))
    both = path_corrections(rows)

    # Pairs of sources: all terms absent, then the terms that either has.
    one = groups.select("lang", F.col("at").alias("a"), F.col("p0").alias("a0"), "v")
    two = groups.select("lang", F.col("at").alias("b"), F.col("p0").alias("b0"))
    pairs = one.join(two, "lang").where("a <> b")
    none = pairs.select("lang", "a", "b", F.when(F.col("v") > 0, F.expr(f"cast(v as decimal(20,0)) * cast({_f('a0', 'greatest(b0, 1)')} as decimal(18,0))")).otherwise(0).cast("decimal(38,0)").alias("c"))
    held = shares.groupBy("lang", F.col("at").alias("a"), "p", F.col("p0").alias("a0")).agg(F.count("*").cast("decimal(18,0)").alias("m"))
    either = (held.join(two, "lang").where("a <> b").select("lang", F.inline(F.array(
        F.struct("a", "b", F.expr(f"m * cast({_f('p', 'b0')} - {_f('a0', 'b0')} as decimal(19,0))").alias("c")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.expr(f"m * cast({_f('b0', 'p')} - {_f('b0', 'a0')} as decimal(19,0))").alias("c"))))))
    value = (none.unionAll(either.select("lang", "a", "b", F.col("c").cast("decimal(38,0)"))).unionAll(both)
             .groupBy("lang", "a", "b").agg(F.sum("c").cast("long").alias("value")))
    named = (value.join(groups.select("lang", F.col("at").alias("a"), "source"), ["lang", "a"])
             .join(groups.select("lang", F.col("at").alias("b"), F.col("source").alias("item")), ["lang", "b"]))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_pair = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))

    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    by_term = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return by_pair.unionAll(by_term)


ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
t AS MATERIALIZED (SELECT i, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT i) >= 3),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
s AS (SELECT lang, source, sum(n) AS size FROM c GROUP BY 1, 2),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  (1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (coalesce(s.size, 0) + v.v))::HUGEINT AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c USING (lang, source, term)),
l AS (SELECT lang, sum(n) AS size FROM c GROUP BY 1),
q AS (SELECT c.lang, c.term, (1 + (1000000000 * (sum(c.n) + 1)) // (any_value(l.size) + any_value(v.v)))::HUGEINT AS q
  FROM c JOIN l USING (lang) JOIN v USING (lang) GROUP BY 1, 2),
x AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
y AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
z AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM y UNION ALL SELECT * FROM z))
WHERE part = 'pair' OR rank <= 200"""
