"""MinHash near-duplicates by an inverted join on signature coordinates.

A text's set holds the 64-bit hashes of its five-word shingles. Texts with the
same set are one node. Each node is posted under every (coordinate, value) of
its signature; values that no other node has are skipped, and a node with fewer
than ``MATCHES`` shared values can have no partner. Of the others only a prefix
in order of rising frequency is posted again: two nodes that agree in at least
``MATCHES`` of ``COORDINATES`` places meet in their prefixes, so very common
values (a passage in a third of all texts) are seldom joined on.

Posting lists are not expanded into pairs. First every node meets one node, the
best connected of the lists it shares most often; the pairs whose signatures
agree often enough are confirmed on the full sets, and the links merged into
components. Then only lists with several components matter. For their nodes the
shingles that occur in another component are counted: a link shares at least
75 / 175 of both sizes, so nodes with fewer such shingles can have none and
leave. The others meet one node once more, and what is then still apart meets
pairwise under that bound, made tighter by what both share with the same pivot. Links inside a component need no proof. A pair of similarity 0.75 agrees in fewer than 24 of
48 places with a probability of about 2e-5.

Null or empty text: empty set, linked with nothing. Rows are told apart by a hash of key
and text, so null and repeated keys are rows of their own; repeated rows share a node. A
component is named by its least key, null only if all its keys are; ``dedup`` keeps the
row with that key (and the least hash; copies of that row stay with it). Empty tables
give empty results; extra columns are ignored (``dedup`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlens.llm.common import small_batches
from trustlens.llm.graph import components
from trustlens.session import materialize

WORDS, PERCENT = 5, 75
COORDINATES, MATCHES = 48, 24
BROADCAST_ROWS = 500_000  # most ids sent to every executor; beyond, a shuffle join
CACHE_WORDS = 500_000


class _Hashes(dict):
    """64-bit hash of a word."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes | None, hashes: _Hashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    got = text.lower().split() if text else []
    if not got:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, got), np.uint64, len(got))
    n = min(words, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for j in range(n):
        h = _mix(h + w[j:len(w) - n + 1 + j])
    return np.unique(h)


def signature(s: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Least hash under each of the coordinates' functions, as 32-bit integers."""
    low = np.full(len(factors), np.iinfo(np.uint32).max, np.uint32)
    for a in range(0, len(s), 4096):
        part = s[a:a + 4096, None] * factors[None, :]
        low = np.minimum(low, (part >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return low.view(np.int32)


def _factors(n: int) -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**63, n, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _row(key: str):
    return F.xxhash64(F.col(f"`{key}`").isNull(), F.col(f"`{key}`"), "text")


def sign(docs: DataFrame, key: str = "doc_id", coordinates: int = COORDINATES, words: int = WORDS) -> DataFrame:
    """key, row, n_shingles, node (128-bit digest of the set, null if empty), sig."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{key}`").alias(key), _row(key).alias("row"), F.col("text").cast("binary").alias("text"))

    def run(batches):
        import xxhash
        hashes, factors = _Hashes(), _factors(coordinates)
        for batch in batches:
            sets = [shingles(t.as_py(), hashes, words) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch[key], batch["row"], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([signature(s, factors) if len(s) else None for s in sets], pa.list_(pa.int32()))],
                names=[key, "row", "n_shingles", "node", "sig"])

    return src.mapInArrow(run, f"`{key}` {src.schema[key].dataType.simpleString()}, row long, n_shingles long, node binary, sig array<int>")


def sets_of(docs: DataFrame, wanted: DataFrame, key: str, words: int) -> DataFrame:
    """(node, set) of the wanted (row, node) rows, from the whole texts."""
    few = wanted.count() <= BROADCAST_ROWS
    src = docs.select(_row(key).alias("row"), F.col("text").cast("binary").alias("text"))
    src = src.join(F.broadcast(wanted) if few else wanted, "row")

    def run(batches):
        import xxhash
        hashes = _Hashes()
        for batch in batches:
            nodes, sets = [], []
            for node, text in zip(batch["node"], batch["text"], strict=True):
                s = shingles(text.as_py(), hashes, words)
                if xxhash.xxh3_128_digest(s.tobytes()) == node.as_py():
                    nodes.append(node.as_py())
                    sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["node", "set"])

    return src.mapInArrow(run, "node binary, set array<long>").dropDuplicates(["node"])


def _agreeing(pairs: DataFrame, nodes: DataFrame, matches: int, name: str) -> DataFrame:
    """The pairs (u, v) whose signatures agree in at least ``matches`` places."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}"))
    same = F.expr("aggregate(zip_with(sig_u, sig_v, (x, y) -> if(x = y, 1, 0)), 0, (a, x) -> a + x)")
    return materialize(pairs.join(side("u"), "u").join(side("v"), "v").where(same >= matches).select("u", "v"), name)


def _proven(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    full = (near.join(sets.select(F.col("node").alias("v"), F.col("set").alias("b")), "v")
            .join(sets.select(F.col("node").alias("u"), F.col("set").alias("a")), "u"))
    shared = F.size(F.array_intersect("a", "b"))
    return full.where(100 * shared >= percent * (F.size("a") + F.size("b") - shared)).select("u", "v")


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, words: int, name: str) -> DataFrame:
    ids = wanted.distinct().join(nodes.select("node", "first"), "node").select(F.col("first.row").alias("row"), "node")
    return materialize(sets_of(docs, materialize(ids, f"{name}-wanted"), key, words), f"{name}-sets")


def _star(posted: DataFrame, order: str) -> DataFrame:
    """(u, v): each node v and, of the first nodes of its lists that have another
    root, the one it meets most often: at most one pair per node."""
    first = posted.groupBy("token").agg(F.max(F.struct(order, "node", "root")).alias("u"))
    return (posted.join(first, "token").where("root <> u.root").groupBy("node", "u.node")
            .agg(F.count("*").alias("c")).toDF("v", "u", "c")
            .groupBy("v").agg(F.max(F.struct("c", "u")).alias("best")).select("best.u", "v"))


def _mixed(posted: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings with the node's size and root, of lists that have several roots."""
    labelled = (posted.join(nodes.select("node", "n"), "node")
                .join(roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
                .withColumn("root", F.coalesce("root", "node")))
    several = (labelled.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b"))
               .where("a <> b").select("token"))
    return labelled.join(several, "token", "left_semi")


def _shared(sets: DataFrame, mixed: DataFrame, percent: int) -> DataFrame:
    """(node, most, alive): those of a node's shingles that occur under another root,
    and their number; no link across roots shares others. Nodes with too few for
    any link are left out."""
    root = mixed.select("node", F.xxhash64("root").alias("r")).distinct()
    rows = sets.join(root, "node").select("node", "r", F.explode("set").alias("shingle"))
    across = rows.groupBy("shingle").agg(F.min("r").alias("a"), F.max("r").alias("b")).where("a <> b").select("shingle")
    most = rows.join(across, "shingle").groupBy("node").agg(F.collect_list("shingle").alias("alive"))
    return (most.join(mixed.select("node", "n").distinct(), "node").withColumn("most", F.size("alive").cast("long"))
            .where(100 * F.col("most") >= percent * F.col("n")).select("node", "most", "alive"))


def _pivots(left: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, pivot, inside): the best shared node of the lists a node is in, and
    how many of its ``alive`` shingles that one has. Two nodes of the same pivot
    share at most the lesser ``inside`` plus the lesser rest."""
    rated = left.withColumn("rank", F.col("most") / F.col("n"))
    first = rated.groupBy("token").agg(F.max(F.struct("rank", "node")).alias("p"))
    pivot = (left.select("token", "node").join(first, "token").groupBy("node", "p.node").agg(F.count("*").alias("c"))
             .toDF("node", "pivot", "c").groupBy("node").agg(F.max(F.struct("c", "pivot")).alias("best"))
             .select("node", "best.pivot"))
    return (left.select("node", "alive").dropDuplicates(["node"]).join(pivot, "node")
            .join(sets.select(F.col("node").alias("pivot"), "set"), "pivot")
            .select("node", "pivot", F.size(F.array_intersect("alive", "set")).cast("long").alias("inside")))


def _prefixes(nodes: DataFrame, matches: int) -> DataFrame:
    """(token, node, live): the rarest shared signature values of every node that has
    at least ``matches`` of them; so many that partners must meet in one."""
    tokens = nodes.select("node", F.posexplode("sig").alias("at", "value")).select(
        "node", F.expr("at * 4294967296L + value").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("freq")).where("freq > 1")
    own = (tokens.join(common, "token").groupBy("node")
           .agg(F.sort_array(F.collect_list(F.struct("freq", "token"))).alias("own"))
           .where(F.size("own") >= matches))
    return own.select("node", F.size("own").alias("live"),
                      F.explode(F.slice("own", 1, F.size("own") - (matches - 1))).alias("o")) \
              .select("o.token", "node", "live")


def _linked(docs: DataFrame, key: str = "doc_id", words: int = WORDS, percent: int = PERCENT,
            coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """key, row, n_shingles, first (key and row that name the component; null without a set)."""
    signed = materialize(sign(docs, key, coordinates, words), "op4-signed")
    least = F.min(F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("key"), "row"))
    nodes = materialize(signed.where("node IS NOT NULL").groupBy("node")
                        .agg(least.alias("first"), F.first("sig").alias("sig"),
                             F.first("n_shingles").alias("n")), "op4-nodes")
    posted = materialize(_prefixes(nodes, matches), "op4-posted")

    # Each node and the node of its lists with the most shared values.
    near = _agreeing(_star(posted.withColumn("root", F.col("node")), "live"), nodes, matches, "op4-star")
    ends = near.select(F.col("u").alias("node")).unionAll(near.select(F.col("v").alias("node")))
    links = materialize(_proven(near, _sets(ends, nodes, docs, key, words, "op4-star"), percent), "op4-links")
    roots = components(links, "op4-roots")

    # Lists with several components: the same again among nodes that share enough
    # shingles across components, then every pair that is still apart.
    mixed = materialize(_mixed(posted, nodes, roots), "op4-mixed")
    sets = _sets(mixed.select("node"), nodes, docs, key, words, "op4-mixed")
    able = materialize(_shared(sets, mixed, percent), "op4-able")
    star = _star(mixed.join(able.drop("alive"), "node").withColumn("rank", F.col("most") / F.col("n")), "rank")
    links = _proven(_agreeing(star, nodes, matches, "op4-again"), sets, percent)
    roots = components(roots.unionAll(links), "op4-roots")

    mixed = materialize(_mixed(posted.join(able.select("node"), "node", "left_semi"), nodes, roots), "op4-mixed")
    able = materialize(_shared(sets.join(able.select("node"), "node", "left_semi"), mixed, percent), "op4-able")
    pivots = _pivots(mixed.join(able, "node"), sets)
    left = mixed.join(able.drop("alive"), "node").join(pivots, "node")
    left = left.join(left.groupBy("node").agg(F.collect_set("token").alias("tokens")), "node")
    left = materialize(left, "op4-left")
    side = lambda c: left.select("token", *[F.col(x).alias(x + c) for x in ("node", "n", "root", "most", "pivot", "inside", "tokens")])
    lesser = lambda c: F.least(F.col(c + "_u"), F.col(c + "_v"))
    rest = F.least(F.col("most_u") - F.col("inside_u"), F.col("most_v") - F.col("inside_v"))
    bound = F.when(F.col("pivot_u") == F.col("pivot_v"), F.least(lesser("most"), lesser("inside") + rest)).otherwise(lesser("most"))
    apart = (side("_u").join(side("_v"), "token").where("root_u < root_v")
             .where((100 + percent) * bound >= percent * (F.col("n_u") + F.col("n_v")))
             .where(F.array_min(F.array_intersect("tokens_u", "tokens_v")) == F.col("token"))  # each pair once
             .select(F.col("node_u").alias("u"), F.col("node_v").alias("v")).distinct())
    links = _proven(_agreeing(apart, nodes, matches, "op4-apart"), sets, percent)
    roots = components(roots.unionAll(links), "op4-roots")

    rooted = (nodes.join(roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
              .select("node", "first", F.coalesce("root", "node").alias("root")))
    named = rooted.groupBy("root").agg(F.min("first").alias("c"))
    label = rooted.join(named, "root").select("node", "c")
    return signed.select(key, "row", "n_shingles", "node").join(label, "node", "left").select(key, "row", "n_shingles", F.col("c").alias("first"))


def link(docs: DataFrame, key: str = "doc_id", **parameters) -> DataFrame:
    """key, n_shingles, component_id, kept of every row."""
    return (_linked(docs, key, **parameters)
            .select(key, "n_shingles", F.when(F.col("first").isNull(), F.col(key)).otherwise(F.col("first.key")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False))))


def dedup(docs: DataFrame, key: str = "doc_id", broadcast_rows: int = BROADCAST_ROWS, **parameters) -> DataFrame:
    """One document of each component, with its own columns."""
    gone = _linked(docs, key, **parameters).where("row <> first.row").select(F.col("row").alias("__gone")).distinct()
    gone = materialize(gone, "op4-gone")
    few = gone.count() <= broadcast_rows
    return (docs.withColumn("__row", _row(key)).join(F.broadcast(gone) if few else gone, F.col("__row") == F.col("__gone"), "left_anti")
            .drop("__row"))


ORACLE = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""
