"""Repeated byte strings by column-wise construction over aligned reads.

Every ``LENGTH``-byte string holds the place of its least ``GRAM``-byte hash (its
anchor), and equal strings hold it at the same offset. Anchors whose gram occurs
once are done with. The bytes around the others, as far as a string through the
anchor can reach, are the reads: short documents of equal alignment. Reads of
the same gram meet in a task and their Burrows-Wheeler order is built column by
column: each round inserts one symbol per read in front of all suffixes, sorts
them stably by it and updates the common prefixes of neighbours. A string that
starts in the current column occurs twice where a common prefix reaches
``LENGTH``. The suffix order of whole documents (as many rounds as the longest
one has bytes) is never needed, and no round leaves the task: the sequential
files are Spark's sorted shuffle files.

A gram that occurs more than ``HOT`` times takes another exact way: equal reads
are counted (before the shuffle, too), and hashes of the strings of different
reads are counted over all tasks.

Null text is empty. Matches never cross documents. Repeated rows are documents
of their own. Extra columns are ignored. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlens.llm.common import small_batches
from trustlens.session import materialize

LENGTH, GRAM = 200, 48
HOT = 20_000                     # most reads of a gram that meet in one task
BROADCAST_PLACES = 8_000_000     # most places (of four bytes) sent to every executor; beyond, a shuffle join
BROADCAST_SPANS = 1_000_000      # the same for merged spans
BATCH_READS = 20_000             # reads of whole grams whose order is built at once
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hasher:
    """64-bit hashes of all substrings of one length, by prefix sums modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, raw: np.ndarray, n: int) -> np.ndarray:
        size = len(raw)
        if size < n:
            return np.empty(0, np.uint64)
        if len(self.up) <= size:
            more = max(size + 1, 1 << 16)
            up, down = np.full(more, _ODD), np.full(more, np.uint64(pow(int(_ODD), -1, 1 << 64)))
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        before = np.zeros(size + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[:size], out=before[1:])
        h = (before[n:] - before[:-n]) * self.down[:size - n + 1]
        h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ h >> np.uint64(29)


def anchors(h: np.ndarray, window: int) -> np.ndarray:
    """Places that are the first least hash of some ``window`` consecutive ones."""
    n = len(h) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    low, span = h, 1
    while 2 * span <= window:
        low, span = np.minimum(low[:len(low) - span], low[span:]), 2 * span
    low = np.minimum(low[:n], low[window - span:window - span + n])
    # The least place moves on only where it left the window or a lesser hash entered.
    change = np.r_[True, (low[1:] < low[:-1]) | (h[:n - 1] == low[:-1])]
    starts = np.flatnonzero(change)
    return np.unique([i + int(np.argmin(h[i:i + window])) for i in starts.tolist()])


def doubled(reads: np.ndarray, least: np.ndarray, most: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last column (or 1, 0) where a string of ``length`` symbols starts in a
    read and in another read. reads: one row each, symbols under 257; strings may
    start in columns ``least`` to ``most`` of a read."""
    n, width = reads.shape
    order, prefix = np.arange(n), np.zeros(n, np.int64)  # prefix[k]: of suffixes k - 1 and k
    lo, hi = np.full(n, 1, np.int64), np.zeros(n, np.int64)
    for c in range(width - 1, -1, -1):
        symbol = reads[order, c]
        move = np.argsort(symbol, kind="stable")
        s = symbol[move]
        same = np.r_[False, s[1:] == s[:-1]]
        new = np.zeros(n, np.int64)
        k = np.flatnonzero(same)
        if len(k):
            bounds = np.empty(2 * len(k), np.int64)
            bounds[::2], bounds[1::2] = move[k - 1] + 1, move[k] + 1
            padded = np.r_[prefix, 0]
            new[k] = 1 + np.minimum.reduceat(padded, bounds)[::2]
        order, prefix = order[move], new
        if c <= width - length:
            ok = (least[order] <= c) & (c <= most[order])
            long_ = prefix >= length
            twice = ok & (long_ | np.r_[long_[1:], False])
            r = order[twice]
            hi[r] = np.where(hi[r] < lo[r], c, hi[r])
            lo[r] = c
    return lo, hi


def _docs(docs: DataFrame, key: str) -> DataFrame:
    small_batches(docs.sparkSession, 256)
    return docs.select(F.col(f"`{key}`").alias(key), F.xxhash64(F.col(f"`{key}`"), "text").alias("row"),
                       F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))


def _anchor_table(src: DataFrame, length: int, gram: int) -> DataFrame:
    """token, row, at: every anchor of every document."""

    def run(batches):
        hasher = _Hasher()
        for batch in batches:
            token, row, at = [], [], []
            for r, t in zip(batch["row"].to_numpy(), batch["text"], strict=True):
                h = hasher(np.frombuffer(t.as_py(), np.uint8), gram)
                p = anchors(h, length - gram + 1)
                token.append(h[p])
                at.append(p)
                row.append(np.full(len(p), r, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token).view(np.int64)), pa.array(np.concatenate(row)),
                                              pa.array(np.concatenate(at).astype(np.int32))], names=["token", "row", "at"])

    return src.select("row", "text").mapInArrow(run, "token long, row long, at int")


def _reads(src: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """token, row, at, hot, left, read: the bytes around every wanted place."""
    places = wanted.agg(F.sum(F.size("places"))).first()[0] or 0
    joined = src.join(F.broadcast(wanted) if places <= BROADCAST_PLACES else wanted, "row").select("row", "text", "places")
    reach = length - gram

    def run(batches):
        hasher = _Hasher()
        for batch in batches:
            out = [[], [], [], [], [], []]
            for r, t, ps in zip(batch["row"].to_numpy(), batch["text"], batch["places"], strict=True):
                raw = t.as_py()
                h = hasher(np.frombuffer(raw, np.uint8), gram).view(np.int64)
                for p in ps.as_py():
                    at = p if p >= 0 else -p - 1
                    a = max(0, at - reach)
                    for column, v in zip(out, (int(h[at]), int(r), at, p < 0, at - a, raw[a:at + length]), strict=True):
                        column.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                                             names=["token", "row", "at", "hot", "left", "read"])

    return joined.mapInArrow(run, "token long, row long, at int, hot boolean, left int, read binary")


def _compare(reads: DataFrame, length: int, gram: int) -> DataFrame:
    """row, s, e: doubled bytes around the places of grams that one task can hold."""
    reach = length - gram

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        matrix = np.full((len(rows), reach + length), 256, np.uint16)
        for i, (_, _, _, left, read) in enumerate(rows):
            matrix[i, reach - left:reach - left + len(read)] = np.frombuffer(read, np.uint8)
        least = np.array([reach - r[3] for r in rows])
        most = np.array([reach - r[3] + len(r[4]) - length for r in rows])
        lo, hi = doubled(matrix, least, most, length)
        k = np.flatnonzero(lo <= hi)
        at = np.array([r[2] for r in rows], np.int64)[k] - reach
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array([r[1] for r in rows], np.int64)[k]), pa.array((at + lo[k]).astype(np.int32)),
             pa.array((at + hi[k] + length).astype(np.int32))], names=["row", "s", "e"])

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            for x in zip(*(batch[c].to_pylist() for c in ("token", "row", "at", "left", "read")), strict=True):
                if len(rows) >= BATCH_READS and x[0] != rows[-1][0]:
                    yield solve(rows)
                    rows = []
                rows.append(x)
        if rows:
            yield solve(rows)

    return (reads.where("NOT hot").drop("hot").repartition("token").sortWithinPartitions("token")
            .mapInArrow(run, "row long, s int, e int"))


def _count(reads: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for grams of too many reads: by counting equal reads and strings."""
    reach = length - gram
    hot = reads.where("hot")
    which = F.xxhash64("left", "read").alias("which")
    kinds = hot.select("token", which, "left", "read").groupBy("token", "which").agg(
        F.count("*").alias("n"), F.first("left").alias("left"), F.first("read").alias("read"))

    def strings(batches):
        hasher = _Hasher()
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for t, w, n, left, read in zip(*(batch[c].to_pylist() for c in ("token", "which", "n", "left", "read")), strict=True):
                h = hasher(np.frombuffer(read, np.uint8), length).view(np.int64)[:left + 1]
                for column, v in zip(cols, (h, np.full(len(h), t), np.full(len(h), w), np.full(len(h), n),
                                            np.arange(len(h)) - left), strict=True):
                    column.append(v.astype(np.int64))
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols],
                                                 names=["string", "token", "which", "n", "c"])

    own = kinds.mapInArrow(strings, "string long, token long, which long, n long, c long")
    same = ["token", "string", "c"]  # at another offset it may be the very same place
    twice = own.groupBy(same).agg(F.sum("n").alias("m")).where("m > 1").select(same)
    found = (own.join(twice, same).groupBy("token", "which")
             .agg(F.min("c").alias("lo"), F.max("c").alias("hi")))
    return (hot.select("token", "row", "at", which).join(found, ["token", "which"])
            .select("row", (F.col("at") + F.col("lo")).cast("int").alias("s"),
                    (F.col("at") + F.col("hi") + length).cast("int").alias("e")))


def spans(docs: DataFrame, key: str = "doc_id", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """row, spans: sorted, merged doubled byte ranges of every document that has some."""
    src = _docs(docs, key)
    found = materialize(_anchor_table(src, length, gram), "op5-anchors")
    often = found.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    wanted = (found.join(often, "token").groupBy("row").agg(F.array_distinct(F.collect_list(
        F.when(F.col("n") > hot, -F.col("at") - 1).otherwise(F.col("at")))).alias("places")))
    reads = _reads(src, materialize(wanted, "op5-wanted"), length, gram)
    several = _compare(reads, length, gram)
    if often.where(F.col("n") > hot).limit(1).count():
        several = several.unionAll(_count(reads, length, gram))
    sorted_ = several.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("spans"))
    last = lambda a: F.element_at(a, -1)
    return sorted_.select("row", F.aggregate("spans", F.slice("spans", 1, 1), lambda a, x: F.when(
        x.s <= last(a).e, F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
            last(a).s.alias("s"), F.greatest(last(a).e, x.e).alias("e"))))).otherwise(F.array_append(a, x))).alias("spans"))


def _merged(spans_) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in spans_:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def report(docs: DataFrame, key: str = "doc_id", **parameters) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    gone = materialize(spans(docs, key, **parameters), "op5-spans")
    places = gone.agg(F.sum(F.size("spans"))).first()[0] or 0
    src = _docs(docs, key)
    joined = src.join(F.broadcast(gone) if places <= BROADCAST_SPANS else gone, "row", "left").select(key, "text", "spans")

    def run(batches):
        for batch in batches:
            rows = []
            for t, s in zip(batch["text"], batch["spans"], strict=True):
                raw, at, digest = t.as_py(), 0, hashlib.sha256()
                cut = _merged((x["s"], x["e"]) for x in s.as_py() or ())
                for a, b in cut:
                    digest.update(raw[at:a])
                    at = b
                digest.update(raw[at:])
                rows.append((len(raw), sum(b - a for a, b in cut), len(cut), digest.hexdigest()))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch[key], *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                                             names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = src.schema[key].dataType.simpleString()
    return joined.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def brute_force(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text, by a table of all strings."""
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for t in raw:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    out = []
    for t in raw:
        cut = _merged((i, i + length) for i in range(len(t) - length + 1) if seen[t[i:i + length]] > 1)
        keep, at = b"", 0
        for a, b in cut:
            keep, at = keep + t[at:a], b
        out.append((len(t), sum(b - a for a, b in cut), len(cut), hashlib.sha256(keep + t[at:]).hexdigest()))
    return out
