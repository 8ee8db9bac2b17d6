"""Document fingerprints by a randomised edit embedding.

A walk goes over the characters of a text. At step j it stands on a character of class c
and either stays or moves on, as the shared random bit (j, c) says; the characters it
stands on, step by step, are the embedded text. Two walks that an edit has parted meet
again by chance and then stay together, so texts within few edits have embedded texts of
small Hamming distance. The bits repeat after ``PERIOD`` steps, so a walk is one table
look-up a character.

The embedded text is sampled at ``SLOTS`` steps. A slot's step is the one of least rank
among all steps of the walk, under an order of the steps that all texts share: its
records (each new least step) are drawn once, and the last record before the walk's end
counts. So texts of unlike length still share most of their steps, and any step is drawn
as often as any other. A slot keeps 16 bits of its step and of the ``WINDOW`` characters
from the walk's place on. Fingerprints are compared by the share of equal slots.

``near_classes`` bands the slots: fingerprints that differ in at most d slots agree in all
but d bands, so none is missed, and of a fingerprint's bands only the rarest are posted,
as many as it takes for two near ones to meet. Members of a posted band meet its least,
then its greatest member; those that still have another class meet pairwise; every pair is
verified on all slots.

``compare`` puts each text beside the next one (keys descending): rows are dealt into
ranges of keys, the first row of each range also goes to the range before it, and a task
streams its sorted rows. Whole texts are shuffled once, and a task holds two of them.

Null text is empty; all empty texts share a fingerprint. Rows with a null key come last;
rows that share a key stand in order of their text. One row is its own next. An empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlens.llm.graph import components
from trustlens.session import materialize

SLOTS, WINDOW, PERIOD, SEED = 64, 4, 1024, 20240611
BANDS = 32                   # of the slots; more than may differ, so that none is missed
PERCENT = 75                 # least share of equal slots of near fingerprints
RANGE_BYTES = 4 << 20        # text a range of keys holds about
MOST_RANGES = 100_000        # finer than that it is not dealt; bounds the borders sent along
PIECE = 1 << 16


class Walks:
    """The shared random choices, and walks by them."""

    def __init__(self, slots: int = SLOTS, window: int = WINDOW, seed: int = SEED):
        rng = np.random.default_rng(seed)
        moves = rng.integers(0, 2, (256, PERIOD), np.int8)
        moves[:, -1] = 1
        self.then = []  # class, state -> state after the next move
        for row in moves:
            to = np.flatnonzero(row)
            self.then.append(((to[np.searchsorted(to, np.arange(PERIOD))] + 1) % PERIOD).tolist())
        records = []
        for _ in range(slots):
            own = [0]
            while own[-1] < 1 << 50:  # the next record after j is beyond m with probability (j + 1) / (m + 1)
                own.append(max(own[-1] + 1, int((own[-1] + 1) / (1.0 - rng.random()))))
            records.append(own)
        width = max(map(len, records))
        self.records = np.array([r + [1 << 62] * (width - len(r)) for r in records], np.int64)
        self.factors = rng.integers(1, 1 << 62, window + 1, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.window = window

    @staticmethod
    def codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")

    def gaps(self, codes: np.ndarray, state: int = 0) -> tuple[np.ndarray, int]:
        """Steps spent on each character, and the state after the last."""
        out, then = np.empty(len(codes), np.uint16), self.then
        for a in range(0, len(codes), PIECE):
            part = codes[a:a + PIECE]
            s = state
            seen = np.array([s := then[c][s] for c in ((part ^ part >> 8 ^ part >> 16) & 255).astype(np.uint8).tobytes()], np.int16)
            before = np.empty_like(seen)
            before[0], before[1:] = state, seen[:-1]
            out[a:a + PIECE] = (seen - before) % PERIOD
            state = s
        return out, state

    def state_at(self, gaps: np.ndarray) -> int:
        return int(gaps.sum(dtype=np.int64) % PERIOD)

    def sample(self, codes: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        """The fingerprint's symbols."""
        slots, n = len(self.records), len(codes)
        if not n:
            return np.zeros(slots, np.uint16)
        starts = np.concatenate([[0], np.cumsum(np.add.reduceat(gaps, np.arange(0, n, PIECE), dtype=np.int64))])
        steps = self.records[np.arange(slots), (self.records < starts[-1]).sum(axis=1) - 1]
        piece = np.searchsorted(starts, steps, "right") - 1
        at = np.empty(slots, np.int64)
        for p in np.unique(piece):
            own = np.cumsum(gaps[p * PIECE:(p + 1) * PIECE], dtype=np.int64) + starts[p]
            at[piece == p] = np.searchsorted(own, steps[piece == p], "right") + p * PIECE
        h = (steps.astype(np.uint64) + np.uint64(1)) * self.factors[-1]
        for k in range(self.window):
            there = at + k < n
            h ^= np.where(there, codes[np.minimum(at + k, n - 1)].astype(np.uint64) + np.uint64(1), np.uint64(0)) * self.factors[k]
            h = (h ^ h >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
        return (h >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal slots."""
    return float((a == b).mean())


def fingerprint(docs: DataFrame, key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """key, print (binary) of every row."""
    src = docs.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def run(batches):
        walks = Walks(slots)
        for batch in batches:
            out = []
            for t in batch["text"]:
                codes = walks.codes(t.as_py())
                out.append(walks.sample(codes, walks.gaps(codes)[0]).astype(">u2").tobytes())
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(out, pa.binary())], names=[key, "print"])

    return src.mapInArrow(run, f"`{key}` {src.schema[key].dataType.simpleString()}, print binary")


def _ranges(docs: DataFrame, key: str, range_bytes: int) -> DataFrame:
    """The rows with their range ``r``, and again, with ``last``, the row that follows a range."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(min(MOST_RANGES, max(1, size // range_bytes)))
    cuts = rows.select(F.col("k").cast("double").alias("k")).approxQuantile("k", [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    cuts = sorted(set(cuts))
    if cuts:
        from pyspark.ml.feature import Bucketizer
        split = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="x", outputCol="b", handleInvalid="keep")
        rows = split.transform(rows.withColumn("x", F.coalesce(F.col("k").cast("double"), F.lit(0.0)))).drop("x")
    else:
        rows = rows.withColumn("b", F.lit(0.0))
    # descending keys, null ones last
    rows = rows.withColumn("r", F.when(F.col("k").isNull(), len(cuts) + 1).otherwise(len(cuts) - F.col("b")).cast("int")).drop("b")
    first = rows.groupBy("r").agg(F.max(F.struct("k", F.bitwise_not("h").alias("h"))).alias("f")).collect()
    first = sorted((f["r"], f["f"]["k"], ~f["f"]["h"]) for f in first) if first else []
    follows = [(k, h, before[0]) for before, (_, k, h) in zip(first, [*first[1:], *first[:1]], strict=True)]
    kind = rows.schema["k"].dataType.simpleString()
    follows = spark.createDataFrame(follows, f"fk {kind}, fh long, before int")
    both = rows.join(F.broadcast(follows), F.col("k").eqNullSafe(F.col("fk")) & (F.col("h") == F.col("fh")), "left")
    places = F.array(F.struct("r", F.lit(False).alias("last")), F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("r"), F.lit(True).alias("last"))))
    return both.select("k", "h", "text", F.inline(F.filter(places, lambda x: x.isNotNull())))


def compare(docs: DataFrame, key: str = "doc_id", slots: int = SLOTS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """key, n_chars, edited_sha256, print, edited_print (binary), near_edited, near_next."""
    rows = _ranges(docs, key, range_bytes)
    kind = rows.schema["k"].dataType.simpleString()
    dealt = (rows.repartition("r").sortWithinPartitions("r", "last", F.desc_nulls_last("k"), "h", "text").select("k", "text", "last"))
    names = ["k", "n_chars", "edited_sha256", "print", "edited_print", "near_edited", "near_next"]

    def run(batches):
        walks = Walks(slots)
        before = None  # the row that waits for its next one
        for batch in batches:
            out = []
            for k, text, last in zip(batch["k"], batch["text"], batch["last"], strict=True):
                if last.as_py() and before is None:
                    continue  # a copy of the row that follows the range
                codes = walks.codes(text.as_py())
                gaps, _ = walks.gaps(codes)
                own = walks.sample(codes, gaps)
                if before is not None:
                    key_, codes_, gaps_, own_ = before
                    m = len(codes_) // 3
                    keep = len(codes_) - m
                    tail = codes[:m]
                    edited = np.concatenate([codes_[:keep], tail])
                    more, _ = walks.gaps(tail, walks.state_at(gaps_[:keep]))
                    changed = walks.sample(edited, np.concatenate([gaps_[:keep], more]))
                    out.append((key_, len(codes_), hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).digest(),
                                own_.astype(">u2").tobytes(), changed.astype(">u2").tobytes(), likeness(own_, changed), likeness(own_, own)))
                before = None if last.as_py() else (k.as_py(), codes, gaps, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                    batch["k"].type, pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()), strict=True)], names=names)

    return dealt.mapInArrow(run, f"k {kind}, n_chars long, edited_sha256 binary, print binary, edited_print binary, "
                                 "near_edited double, near_next double").withColumnRenamed("k", key)


def _alike(pairs: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of near fingerprints, by all their slots."""
    full = (pairs.join(prints.select(F.col("node").alias("u"), F.col("print").alias("a")), "u")
            .join(prints.select(F.col("node").alias("v"), F.col("print").alias("b")), "v").select("u", "v", "a", "b"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), ">u2").reshape(batch.num_rows, -1) for c in "ab")
                yield batch.filter(pa.array(100 * (a == b).sum(axis=1) >= percent * a.shape[1])).select(["u", "v"])

    return full.mapInArrow(run, "u long, v long")


def near_classes(prints: DataFrame, percent: int = PERCENT, slots: int = SLOTS, bands: int = BANDS) -> DataFrame:
    """print, root: the classes of fingerprints linked by pairs with at least ``percent``
    of equal slots (root: the node number of one of them), for prints in classes of several."""
    nodes = materialize(prints.select("print").distinct().withColumn("node", F.xxhash64("print")), "op11-nodes")
    apart = slots - -(-percent * slots // 100)  # slots in which near ones may differ
    cuts = [i * slots // bands for i in range(bands + 1)]
    parts = F.array(*[F.xxhash64(F.lit(i), F.substring("print", 2 * a + 1, 2 * (b - a))) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))])
    tokens = nodes.select("node", F.explode(parts).alias("token")).repartition("token")
    common = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    # Of a node's bands that others have, only the rarest: near ones agree in bands - apart of them.
    least = max(1, bands - apart)
    own = tokens.join(common, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("own")).where(F.size("own") >= least)
    posted = own.select("node", F.explode(F.slice("own", 1, F.size("own") - (least - 1))).alias("o")).select("node", "o.token")
    ends = posted.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    posted = materialize(posted.join(ends, "token"), "op11-posted")  # of lists with several nodes
    some = materialize(nodes.join(posted.select("node").distinct(), "node"), "op11-some")
    roots = None
    for end in ("low", "high"):
        pairs = posted.where(f"node <> {end}").select(F.col(end).alias("u"), F.col("node").alias("v")).distinct()
        if roots is not None:
            pairs = _apart(pairs, roots)
        links = _alike(pairs, some, percent)
        roots = components(links if roots is None else roots.unionAll(links), "op11-roots")
    labelled = (posted.select("token", "node").join(roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
                .withColumn("root", F.coalesce("root", "node")))
    several = labelled.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.min("node").alias("low"), F.max("node").alias("high")).where("a <> b")
    left = materialize(labelled.join(several.select("token", "low", "high"), "token").where("node <> low AND node <> high").drop("low", "high"), "op11-left")
    one, two = (left.select("token", F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "uv")
    pairs = one.join(two, "token").where("u < v AND root_u <> root_v").select("u", "v").distinct()
    roots = components(roots.unionAll(_alike(pairs, some, percent)), "op11-roots")
    both = roots.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    return some.join(both, "node").select("print", "root")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v) whose ends have different roots."""
    for c in "uv":
        pairs = (pairs.join(roots.select(F.col("u").alias(c), F.col("v").alias(f"root_{c}")), c, "left")
                 .withColumn(f"root_{c}", F.coalesce(f"root_{c}", c)))
    return pairs.where("root_u <> root_v").select("u", "v")


def report(docs: DataFrame, key: str = "doc_id", percent: int = PERCENT, slots: int = SLOTS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and
    class_id: the smallest key of the class of near fingerprints."""
    got = materialize(compare(docs, key, slots, range_bytes), "op11-prints")
    classes = materialize(near_classes(got, percent, slots), "op11-classes")
    own = got.select(key, "print").join(classes, "print", "left").withColumn("root", F.coalesce("root", F.xxhash64("print")))
    least = own.groupBy("root").agg(F.min(key).alias("class_id"))
    named = own.select("print", "root").distinct().join(least, "root").select("print", "class_id")
    return got.join(named, "print").select(
        key, "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), F.lower(F.hex("print")).alias("fingerprint"),
        F.lower(F.hex("edited_print")).alias("edited_fingerprint"), "near_edited", "near_next", "class_id")
