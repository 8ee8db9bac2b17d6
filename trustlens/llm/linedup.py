"""Line deduplication by a segment-partition edit join.

Lines (blanks collapsed) that hold a letter or a digit are judged, whatever their
length. Equal lines meet by their digest. The number of edits that still count as a
repeat grows with the length of the shorter line (``CLASSES``); a line is cut into
that number + 1 segments. A longer line within so many edits of it holds one segment
unchanged, at a place that the lengths of both limit to a few: each line is posted
under its own segments and probes, for every length it may match, the substrings
that could equal a segment of a line of that length.

Nearly all probes meet nothing, so postings are small and stay packed until they have met:
a task sends its tokens sorted, by buckets of the token's range, nine bytes a posting; a
bucket is joined by looking its probes up among its segments, and only postings that meet
another line's come out as rows. Their lines are fetched by a hash of their rows; texts
are not shuffled. Each line is then compared with one other of its lists, and the links
merged into classes; in lists that still hold several classes every segment owner
meets every member of another class, in parts of bounded size, and what lengths and the
counts of characters allow is compared. Every link is verified by a banded bit-parallel edit
distance, a character of many pairs at a time.

The first line of a class (by key, then place) stays, all others go. Postings of a line
leave a task once, so a line in a third of all documents is a few rows.

Null text has no lines. Rows are told apart by a hash of key and text: a null or
repeated key is a row of its own, and copies of a row count as one. Empty tables
give empty results. ``strip_lines`` keeps all columns; a text all of whose lines
went becomes empty.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlens.llm.common import small_batches
from trustlens.llm.graph import components
from trustlens.session import materialize

ERRORS = 2
# (least length, most errors) of each class of lines; shorter ones repeat only exactly.
CLASSES = ((10, 1), (30, 2), (100, 4))
WORD = re.compile(r"[^\W_]")
BROADCAST_ROWS = 500_000  # most ids sent to every executor; beyond, a shuffle join
SEEN_LINES = 200_000      # lines a task remembers to post them once
AT_CHARS = 200_000        # characters of the lines whose tokens a task computes together, about
POSTED = 500_000          # probes a task holds before it sends them on, about
LONG_LIST, LIST_ROWS = 256, 2_000  # members of a list's part, and postings of a task, about
PAIRS_HELD, PAIR_CHARS = 50_000, 4_000_000  # pairs a task gathers, and characters it compares at once
PROBES, BUCKET_POSTINGS = 54, 1_000_000  # most postings of a line, and of a bucket about


def lines_of(text: str | None) -> list[str]:
    """Lines without outer blanks, runs of blanks and tabs inside as one blank."""
    if not text:
        return []
    return [x.strip(" \r") if "  " not in x and "\t" not in x else " ".join(x.replace("\t", " ").strip(" \r").split())
            for x in text.split("\n")]


def index_places(size: np.ndarray, errors: int = ERRORS):
    """(length, segment, start, chars) of each segment of lines of these sizes."""
    short, longer = size // (errors + 1), size % (errors + 1)
    for i in range(errors + 1):
        extra = np.maximum(0, i - (errors + 1 - longer))  # longer segments before this one
        yield size, i, i * short + extra, short + (i >= errors + 1 - longer)


def probe_places(size: np.ndarray, errors: int = ERRORS):
    """The same of each substring that could equal a segment of a line of the same or
    a lesser length: with i errors at most before a segment and the rest after it."""
    for gap in range(errors + 1):
        for length, i, p, n in index_places(size - gap, errors):
            after = errors - i
            for s in range(max(-i, gap - after), min(i, gap + after) + 1):
                yield length, i, p + s, n


def moved_places(size: np.ndarray, errors: int = ERRORS):
    """``probe_places`` without a line's own segments."""
    for gap, (length, i, p, n) in ((g, x) for g in range(errors + 1) for x in index_places(size - g, errors)):
        after = errors - i
        for s in range(max(-i, gap - after), min(i, gap + after) + 1):
            if gap or s:
                yield length, i, p + s, n


_ODD = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """Powers of an odd number modulo 2**64, and of its inverse, as many as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            up, down = np.full(2 * n, _ODD), np.full(2 * n, np.uint64(pow(int(_ODD), -1, 1 << 64)))
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


def tokens(lines: list[str], places, errors: int = ERRORS, powers: Powers | None = None,
           lengths: tuple[int, int] = (0, 1 << 40)) -> tuple[np.ndarray, np.ndarray]:
    """(line, token): which line, and the 64-bit hash of length, segment and substring
    of each of its places, for lengths in the given range only. Lines must be longer
    than ``errors``."""
    size = np.array([len(x) for x in lines], np.int64)
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    up, down = (powers or Powers())(len(chars) + 1)
    before = np.zeros(len(chars) + 1, np.uint64)
    chars += np.uint64(1)
    chars *= up[:len(chars)]
    np.cumsum(chars, out=before[1:])
    first = np.cumsum(size) - size
    at, got = [], []
    for length, i, start, n in places(size, errors):
        ok = np.flatnonzero((start >= 0) & (start + n <= size) & (length > errors) & (n > 0)
                            & (length >= lengths[0]) & (length < lengths[1]))
        s = first[ok] + start[ok]
        h = (before[s + n[ok]] - before[s]) * down[s]
        h ^= (length[ok] * (errors + 1) + i).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ h >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9)
        at.append(ok)
        got.append(h ^ h >> np.uint64(29))
    return np.concatenate(at), np.concatenate(got)


def errors_of(size: int, classes=CLASSES) -> int:
    """Most errors of a line of this length."""
    return max((e for least, e in classes if size >= least), default=0)


def bags(lines: list[str]) -> np.ndarray:
    """Of each line, ten counts of characters modulo 64 as one integer; an edit changes
    the sum of their (circular) differences by two at most."""
    size = np.array([len(x) for x in lines], np.int64)
    kind = np.frombuffer("".join(lines).encode("latin-1", "replace"), np.uint8) % np.uint8(10)
    place = np.repeat(np.arange(len(lines), dtype=np.int32) * np.int32(10), size)
    place += kind
    counts = np.bincount(place, minlength=10 * len(lines)).reshape(-1, 10) & 63
    return (counts << 6 * np.arange(10)).sum(axis=1)


def within(a: str, b: str, errors: int = ERRORS) -> bool:
    """Whether the edit distance is at most ``errors``. Bit d of ``reach[e]``: the
    cell d diagonals off the main one is reached with e errors; one step a character."""
    if abs(len(a) - len(b)) > errors:
        return False
    width = (1 << 2 * errors + 1) - 1
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i + errors
    reach = []
    for e in range(errors + 1):  # before any character of b: deletions of a only
        reach.append(1 << errors if e == 0 else reach[-1] | reach[-1] << 1 & width)
    for j, c in enumerate(b):
        same = places.get(c, 0) >> j & width
        new = [reach[0] & same]
        for e in range(1, errors + 1):
            new.append(reach[e] & same | reach[e - 1] | reach[e - 1] >> 1 | new[e - 1] << 1 & width)
        reach = new
        if not reach[-1]:
            return False
    return bool(reach[errors] >> len(a) - len(b) + errors & 1)


def within_many(a: list[str], b: list[str], errors: np.ndarray) -> np.ndarray:
    """``within`` for many pairs, a character of all of them at a time; pairs that have
    too many errors already leave."""
    out = np.zeros(len(a), bool)
    la, lb = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    for e in np.unique(errors).tolist():
        # Pairs of like length together, so many that a block's characters stay few.
        own = np.flatnonzero((errors == e) & (np.abs(la - lb) <= e))
        own = own[np.argsort(lb[own])]
        k = 0
        while k < len(own):
            n = max(1, min(len(own) - k, PAIR_CHARS // (int(lb[own[min(k + 4096, len(own)) - 1]]) + 2 * e + 1), 4096))
            block, k = own[k:k + n], k + n
            out[block] = _within_block([a[i] for i in block], [b[i] for i in block], la[block], lb[block], e)
    return out


def _within_block(a: list[str], b: list[str], la: np.ndarray, lb: np.ndarray, e: int) -> np.ndarray:
    def columns(side, size, before, rows):
        """Character by character of all strings; -1 where a string has none."""
        grid = np.full((rows, len(side)), -1, np.int32)
        codes = np.frombuffer("".join(side).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
        of = np.repeat(np.arange(len(side)), size)
        grid[before + np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size), of] = codes
        return grid

    steps, width = int(lb.max()), (1 << 2 * e + 1) - 1
    x, y = columns(a, la, e, max(int(la.max()), steps) + 2 * e + 1), columns(b, lb, 0, steps + 1)
    out, alive, ends = np.zeros(len(a), bool), np.arange(len(a)), lb
    reach = [np.full(len(a), (1 << e) * ((1 << i + 1) - 1) & width, np.int32) for i in range(e + 1)]
    for j in range(steps + 1):
        if j % 16 == 0 or (ends == j).any():
            over = ends == j
            out[alive[over]] = (reach[e][over] >> la[alive[over]] - lb[alive[over]] + e & 1).astype(bool)
            keep = ~over & (reach[e] != 0)
            if 4 * keep.sum() < 3 * len(keep) or over.any():
                alive, ends, x, y, reach = alive[keep], ends[keep], x[:, keep], y[:, keep], [r[keep] for r in reach]
            if not len(alive):
                break
        same = np.zeros(len(alive), np.int32)
        for d in range(2 * e + 1):
            same |= (x[j + d] == y[j]).astype(np.int32) << d
        new = [reach[0] & same]
        for i in range(1, e + 1):
            new.append(reach[i] & same | reach[i - 1] | reach[i - 1] >> 1 | new[i - 1] << 1 & width)
        reach = new
    return out


def _row(key: str):
    return F.xxhash64(F.col(f"`{key}`").isNull(), F.col(f"`{key}`"), "text")


def _source(docs: DataFrame, key: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(f"`{key}`").alias(key), "text", _row(key).alias("row"))


def line_table(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, row, place, line (128-bit digest) and id (64-bit hash) of every judged line."""
    src = _source(docs, key)

    def run(batches):
        import xxhash
        for batch in batches:
            at, place, digest, ids = [], [], [], []
            for i, t in enumerate(batch["text"]):
                for n, x in enumerate(lines_of(t.as_py())):
                    if WORD.search(x):
                        at.append(i)
                        place.append(n)
                        raw = x.encode()
                        digest.append(xxhash.xxh3_128_digest(raw))
                        ids.append(xxhash.xxh3_64_intdigest(raw))
            yield pa.RecordBatch.from_arrays([batch[key].take(pa.array(at, pa.int64())), batch["row"].take(pa.array(at, pa.int64())), pa.array(place, pa.int32()),
                                              pa.array(digest, pa.binary()), pa.array(ids, pa.uint64()).view(pa.int64())],
                                             names=[key, "row", "place", "line", "id"])

    return src.mapInArrow(run, f"`{key}` {src.schema[key].dataType.simpleString()}, row long, place int, line binary, id long")


def _planes(x: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each number, one byte after the other of all of them."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, width - 1::-1].T).tobytes()


def _numbers(planes, width: int) -> np.ndarray:
    own = np.frombuffer(planes, np.uint8).reshape(width, -1)
    out = np.zeros(own.shape[1], np.uint64)
    for plane in own:
        out = out << np.uint64(8) | plane
    return out


def postings(docs: DataFrame, key: str, classes=CLASSES, buckets: int = 1) -> DataFrame:
    """bucket, side (0: segments, 1: probes), tokens, ids: the postings of every judged
    line, once a task, packed by ranges of tokens. A row holds, in order of the token, the
    32 bits of a token that its bucket leaves open and the 40 lowest bits of the line's
    hash; lines or tokens that agree in these are told apart when verified."""
    src = _source(docs, key)

    def run(batches):
        import xxhash
        seen: set[int] = set()
        powers = Powers()
        held: tuple[list, list] = ([], [])

        def send():
            for side in (0, 1):
                if not held[side]:
                    continue
                low, of = (np.concatenate(x) for x in zip(*held[side], strict=True))
                held[side].clear()
                order = np.argsort(low)
                low, of = low[order], of[order]
                place = (low >> np.uint64(32)).astype(np.int32)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [len(place)]])
                for k in range(0, len(cuts) - 1, 64):
                    some = list(zip(cuts[k:k + 64].tolist(), cuts[k + 1:k + 65].tolist(), strict=False))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(place[x]) for x, _ in some], pa.int32()), pa.array([side] * len(some), pa.int8()),
                         pa.array([_planes(low[x:y], 4) for x, y in some], pa.binary()),
                         pa.array([_planes(of[x:y], 5) for x, y in some], pa.binary())], names=["bucket", "side", "tokens", "ids"])

        for batch in batches:
            lines, ids = [], []
            for t in batch["text"]:
                for x in lines_of(t.as_py()):
                    if len(x) < classes[0][0] or not WORD.search(x):
                        continue
                    d = xxhash.xxh3_64_intdigest(x.encode())
                    if d not in seen:
                        if len(seen) >= SEEN_LINES:
                            seen.clear()
                        seen.add(d)
                        lines.append(x)
                        ids.append(d)
            size = np.array([len(x) for x in lines], np.int64)
            every = np.array(ids, np.uint64)
            for (low, errors), high in zip(classes, [*(c[0] for c in classes[1:]), 1 << 40], strict=True):
                # A line just beyond the class may match one in it.
                own = np.flatnonzero((size >= low) & (size < high + errors))
                chars = np.cumsum(size[own]) // AT_CHARS
                for part in np.split(own, np.flatnonzero(np.diff(chars)) + 1) if len(own) else []:
                    some = [lines[i] for i in part]
                    for side, places in enumerate((index_places, moved_places)):
                        at, token = tokens(some, places, errors, powers, (low, high))
                        # bucket, and the bits that it leaves open
                        place = (token >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                        held[side].append((place << np.uint64(32) | token & np.uint64(0xFFFFFFFF), every[part][at]))
                    if sum(len(t) for t, _ in held[1]) >= POSTED:
                        yield from send()
        yield from send()

    return src.mapInArrow(run, "bucket int, side byte, tokens binary, ids binary")


def meeting(packed: DataFrame) -> DataFrame:
    """token, id, own (a segment of the line, not a probe): the postings of tokens that are
    a segment of one line and a segment or a probe of another. A task holds the segments of
    one bucket, and its probes a row at a time."""
    def run(batches):
        bucket, held, runs = None, ([], []), None

        def table(token, of, own):
            return pa.RecordBatch.from_arrays([pa.array((np.uint64(bucket) << np.uint64(32) | token).view(np.int64)), pa.array(of.view(np.int64)),
                                               pa.array(np.full(len(of), own))], names=["token", "id", "own"])

        def ready():
            """The bucket's segments in order of the token: tokens, ids, and of each token its
            place, least and greatest id, and whether it meets another line."""
            token, of = (np.concatenate(x) if x else np.empty(0, np.uint64) for x in held)
            order = np.argsort(token, kind="stable")  # of sorted runs
            token, of = token[order], of[order]
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.empty(0, np.int64)
            low, high = (f.reduceat(of, first) if len(first) else of for f in (np.minimum, np.maximum))
            return token, of, first, token[first], low, high, low != high

        def end():
            if bucket is not None:
                token, of, first, _, _, _, met = runs or ready()
                some = np.repeat(met, np.diff(np.concatenate([first, [len(token)]])))
                yield table(token[some], of[some], True)

        for batch in batches:
            for at, side, t, i in zip(*(batch[c] for c in ("bucket", "side", "tokens", "ids")), strict=True):
                at, side = at.as_py(), side.as_py()
                if at != bucket:
                    yield from end()
                    bucket, held, runs = at, ([], []), None
                t, i = _numbers(t.as_buffer(), 4), _numbers(i.as_buffer(), 5)
                if side == 0:
                    held[0].append(t)
                    held[1].append(i)
                    continue
                runs = runs or ready()
                _, _, _, token, low, high, met = runs
                if not len(token):
                    continue
                place = np.minimum(np.searchsorted(token, t), len(token) - 1)
                # not those that only meet their own line
                hit = (token[place] == t) & ~((low[place] == i) & (high[place] == i))
                met[place[hit]] = True
                yield table(t[hit], i[hit], False)
        yield from end()

    return packed.repartition("bucket").sortWithinPartitions("bucket", "side").mapInArrow(run, "token long, id long, own boolean")


def _texts(docs: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """(line, x, bag, n): the lines at the wanted (row, place), their character counts and lengths."""
    by_row = materialize(wanted.groupBy("row").agg(F.collect_list(F.struct("place", "line")).alias("w")), "op6-wanted")
    few = by_row.count() <= BROADCAST_ROWS
    src = _source(docs, key).join(F.broadcast(by_row) if few else by_row, "row").select("text", "w")

    def run(batches):
        for batch in batches:
            line, x = [], []
            for t, w in zip(batch["text"], batch["w"], strict=True):
                own = lines_of(t.as_py())
                for r in w.as_py():
                    if r["place"] < len(own):
                        line.append(r["line"])
                        x.append(own[r["place"]])
            yield pa.RecordBatch.from_arrays([pa.array(line, pa.binary()), pa.array(x, pa.string()), pa.array(bags(x) if x else [], pa.int64()),
                                              pa.array([len(t) for t in x], pa.int64())], names=["line", "x", "bag", "n"])

    return src.mapInArrow(run, "line binary, x string, bag long, n long").dropDuplicates(["line"])


def _near(pairs: DataFrame, texts: DataFrame, classes) -> DataFrame:
    """(u, v): the pairs (a, b) of ids whose lines are within the edit distance."""
    full = (pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("u"), F.col("x").alias("s")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("line").alias("v"), F.col("x").alias("t")), "b").select("u", "v", "s", "t"))

    def verify(batches):
        for batch in batches:
            a, b = batch["s"].to_pylist(), batch["t"].to_pylist()
            errors = np.array([errors_of(min(len(x), len(y)), classes) for x, y in zip(a, b, strict=True)], np.int64)
            yield batch.filter(pa.array(within_many(a, b, errors), pa.bool_())).select(["u", "v"])

    return full.mapInArrow(verify, "u binary, v binary").where("u <> v")


def _apart(mixed: DataFrame, texts: DataFrame, classes) -> DataFrame:
    """(u, v): links between classes, from all pairs of a segment's owner and another member
    of its list. A long list is cut into parts, and each two of them meet in a task of
    their own; a task holds two parts, and only links leave it."""
    tasks = 1 + mixed.count() // LIST_ROWS
    rows = mixed.join(texts.select("id", "line", "x"), "id").withColumns({
        "parts": (1 + F.floor(F.col("members") / LONG_LIST)).cast("int"), "cell": F.pmod(F.xxhash64("id"), 1 + F.floor(F.col("members") / LONG_LIST)).cast("int")})
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cols = ["line", "root", "bag", "x"]
    sides = (rows.where("own").select("token", F.col("cell").alias("i"), other.alias("j"), F.lit(True).alias("own"), *cols)
             .unionAll(rows.select("token", other.alias("i"), F.col("cell").alias("j"), F.lit(False).alias("own"), *cols)))
    dealt = sides.repartition(tasks, "token", "i", "j").sortWithinPartitions("token", "i", "j")

    def run(batches):
        waiting: list[tuple] = []  # pairs: line, line, text, text
        group, members = None, ([], [])

        def pairs():
            if not members[0] or not members[1]:
                return
            if len(members[0]) * len(members[1]) <= 64:
                for u, ru, _, xu in members[0]:
                    for v, rv, _, xv in members[1]:
                        e = errors_of(min(len(xu), len(xv)), classes) if ru != rv else 0
                        if e and abs(len(xu) - len(xv)) <= e:
                            waiting.append((u, v, xu, xv, e))
                return
            (u, ru, bu, xu), (v, rv, bv, xv) = (list(zip(*m, strict=True)) for m in members)
            nu, nv = (np.array([len(t) for t in x]) for x in (xu, xv))
            least = np.minimum(nu[:, None], nv[None, :])
            most = np.zeros(least.shape, np.int64)
            for low, e in classes:
                most[least >= low] = e
            name = {r: k for k, r in enumerate({*ru, *rv})}
            ok = np.array([name[r] for r in ru])[:, None] != np.array([name[r] for r in rv])[None, :]
            ok &= np.abs(nu[:, None] - nv[None, :]) <= most
            bu, bv = (np.array(x, np.int64)[:, None] >> 6 * np.arange(10) & 63 for x in (bu, bv))
            at, to = np.nonzero(ok)
            gap = np.abs(bu[at] - bv[to])
            near = np.minimum(gap, 64 - gap).sum(axis=1) <= 2 * most[at, to]
            at, to = at[near], to[near]
            waiting.extend(zip((u[k] for k in at), (v[k] for k in to), (xu[k] for k in at), (xv[k] for k in to), most[at, to].tolist(), strict=True))

        def links():
            u, v, a, b, e = map(list, zip(*waiting, strict=True))
            ok = within_many(a, b, np.array(e))
            waiting.clear()
            yield pa.RecordBatch.from_arrays([pa.array([x for x, k in zip(u, ok, strict=True) if k], pa.binary()),
                                              pa.array([x for x, k in zip(v, ok, strict=True) if k], pa.binary())], names=["u", "v"])

        for batch in batches:
            for *at, own, line, root, bag, x in zip(*(batch[c].to_pylist() for c in ("token", "i", "j", "own", *cols)), strict=True):
                if at != group:
                    pairs()
                    group, members = at, ([], [])
                    if len(waiting) > PAIRS_HELD:
                        yield from links()
                members[not own].append((line, root, bag, x))
        pairs()
        if waiting:
            yield from links()

    return dealt.mapInArrow(run, "u binary, v binary").distinct()


def _best(labelled: DataFrame) -> DataFrame:
    """(a, b): each line b and, of the segment owners of another class that stand first or
    last in its lists, the one it meets most often."""
    ends = labelled.where("own").groupBy("token").agg(F.min(F.struct("root", "id")).alias("low"), F.max(F.struct("root", "id")).alias("high"))
    met = labelled.join(ends, "token").select(F.col("id").alias("b"), "root", F.when(F.col("root") != F.col("low.root"), F.col("low")).otherwise(F.col("high")).alias("a"))
    met = met.where("root <> a.root").groupBy("b", F.col("a.id").alias("a")).agg(F.count("*").alias("n"))
    return met.groupBy("b").agg(F.max(F.struct("n", "a")).alias("m")).select("m.a", "b")


def _mixed(posted: DataFrame, texts: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The postings with their lines' classes, counts and lengths, of lists with several classes."""
    own = texts.select("id", "line", "bag", "n")
    own = own.withColumn("root", F.col("line")) if roots is None else own.join(
        roots.select(F.col("u").alias("line"), F.col("v").alias("root")), "line", "left").withColumn("root", F.coalesce("root", "line"))
    labelled = posted.join(own.select("id", "root", "bag", "n"), "id")
    several = (labelled.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("members"))
               .where("a <> b").select("token", "members"))
    return materialize(labelled.join(several, "token"), "op6-mixed")


def _links(docs: DataFrame, nodes: DataFrame, key: str, classes=CLASSES) -> DataFrame:
    """(u, v): links that join all lines within the edit distance into their classes."""
    buckets = 1 + nodes.count() * PROBES // BUCKET_POSTINGS
    posted = materialize(meeting(postings(docs, key, classes, buckets)).distinct(), "op6-posted")
    short = F.col("id").bitwiseAND(F.lit((1 << 40) - 1))
    named = materialize(nodes.select(short.alias("id"), "line", "first").join(posted.select("id").distinct(), "id"), "op6-named")
    wanted = named.select(F.col("first.row").alias("row"), F.col("first.place").alias("place"), "line")
    texts = materialize(_texts(docs, wanted, key).join(named.select("id", "line"), "line"), "op6-texts")

    # Each line and one other of its lists; then whoever is in a list with another class.
    links = materialize(_near(_best(_mixed(posted, texts, None)), texts, classes), "op6-links")
    mixed = _mixed(posted, texts, components(links, "op6-roots"))
    return links.unionAll(_apart(mixed, texts, classes))


def repeats(docs: DataFrame, key: str = "doc_id", classes=CLASSES) -> DataFrame:
    """row, places: the judged lines of a row that are not the first of their class."""
    lines = materialize(line_table(docs, key), "op6-lines")
    nodes = materialize(lines.groupBy("line").agg(F.min(F.struct(key, "row", "place")).alias("first"), F.first("id").alias("id"), F.count("*").alias("n")), "op6-nodes")
    roots = components(_links(docs, nodes, key, classes), "op6-roots")
    rooted = (nodes.join(roots.select(F.col("u").alias("line"), F.col("v").alias("root")), "line", "left")
              .withColumn("root", F.coalesce("root", "line")))
    classes = rooted.groupBy("root").agg(F.min("first").alias("stays"), F.sum("n").alias("total")).where("total > 1")
    many = rooted.join(classes, "root").select("line", "stays")
    return (lines.join(many, "line").where(~(F.struct(F.col(key), F.col("row"), F.col("place")).eqNullSafe(F.col("stays"))))
            .groupBy("row").agg(F.sort_array(F.collect_set("place")).alias("places")))


def report(docs: DataFrame, key: str = "doc_id", **parameters) -> DataFrame:
    """key, n_lines, n_removed, removed (places of the removed lines, from 0)."""
    gone = repeats(docs, key, **parameters).select(F.col("row").alias("__k"), "places")
    n = F.when(F.coalesce(F.length("text"), F.lit(0)) > 0, F.size(F.split("text", "\n"))).otherwise(0)
    return (docs.select(F.col(f"`{key}`").alias(key), _row(key).alias("row"), n.cast("long").alias("n_lines"))
            .join(gone, F.col("row") == F.col("__k"), "left")
            .select(key, "n_lines", F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce(F.array_join("places", ","), F.lit("")).alias("removed")))


def strip_lines(docs: DataFrame, key: str = "doc_id", **parameters) -> DataFrame:
    """The rows without their repeated lines."""
    gone = materialize(repeats(docs, key, **parameters).select(F.col("row").alias("__k"), F.col("places").alias("__p")), "op6-gone")
    few = gone.count() <= BROADCAST_ROWS
    joined = docs.withColumn("__r", _row(key)).join(F.broadcast(gone) if few else gone, F.col("__r") == F.col("__k"), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("__p"), i)), "\n")
    return joined.withColumn("text", F.when(F.col("__p").isNull(), F.col("text")).otherwise(kept)).select(*docs.columns)
