"""Best-fit packing of token pieces into fixed-length sequences.

1. Texts are tokenised where they are scanned and cut into pieces; only
   (document, piece, start, length, checksum) is written.
2. The length histogram (at most ``capacity`` rows) gives the configuration
   linear program: fewest sequences whose configurations cover every length.
   Multiplicative weights solve it, each round pricing by one knapsack dynamic
   program the dearest configuration of every length still behind. The solution
   is rounded; what remains is packed from the longest piece on, filling each
   sequence as full as the remaining lengths allow. This works on counts of
   lengths only, so its cost does not grow with the number of documents.
3. Each piece gets its rank among the pieces of its length (salted groups and
   running offsets: a length that a third of all pieces share is many tasks)
   and the plan maps (length, rank) to (sequence, offset).

Null text counts as empty: one piece holding the end token. Repeated rows are
packed each. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustlens.llm.common import small_batches
from trustlens.session import materialize

CAPACITY, END_ID = 2048, 0
TOKENIZER = "word_bpe_49k.json"
PRICING_ROUNDS = 200      # dynamic programs solved by multiplicative weights, at most
GAP = 0.1                 # the program's value may exceed its lower bound by this share
STEP = 1.0                # learning rate of the weights
WIDTH = 0.1               # share of a length that one step covers, at most
FLOOR = 50.0              # coverage ahead of the least beyond which weights fall no more
LEVEL = 16                # lengths this many times as frequent price their configurations apart
KEPT = (1, 0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.6, 0.5, 0.25, 0)  # shares of the rounded program
GROUP_ROWS = 100_000      # rows that share a length and a salt, about
CACHE_WORDS = 700_000     # words whose ids a worker remembers

# Letters that the tokenizer's normalizer only lower-cases, each for itself, then ASCII symbols.
WORD = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-/:-@\[-`{-~]*)")
PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long"


class _Ids(dict):
    """Ids of text between blanks, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # The merge model's spelling of the letters beyond ASCII, by their bytes.
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}

    def __missing__(self, word: str) -> bytes:
        got = self._look_up(word)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = got
        return got

    def _look_up(self, word: str) -> bytes:
        """Letters go to the merge model as they are, symbols after them are a token's
        beginning of their own; all else takes the whole tokenizer."""
        if m := WORD.fullmatch(word):
            letters, symbols = m.groups()
            if symbols:
                return self[letters] + self[symbols]
            low = word.lower()
            if low != word:
                return self[low]
            if not word.isascii():
                word = word.translate(self.spelling)
            return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        return self._whole(word)

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def tokenise(text: str | None, ids: _Ids) -> bytes:
    """Ids of a text, then the end id. The tokenizer drops white space and never
    joins across it, so the ids of a text are those of its words in order."""
    words = text.replace("\n", " ").split(" ") if text else ()
    return b"".join(map(ids.__getitem__, words)) + END_ID.to_bytes(4, "little")


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """key, piece, start, length, ids_crc32: every document cut at ``capacity`` tokens."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{key}`").alias(key), F.col("text").alias("text"))

    def run(batches):
        import public_tokenizers
        ids = _Ids(tokenizer or public_tokenizers.path(TOKENIZER))
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch["text"]):
                raw = tokenise(text.as_py(), ids)
                for p, s in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[s:s + 4 * capacity]
                    at.append(i)
                    rows.append((p, s // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch[key].take(pa.array(at, pa.int64())), pa.array(cols[0], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in cols[1:]]],
                names=[key, "piece", "start", "length", "ids_crc32"])

    return src.mapInArrow(run, f"`{key}` {src.schema[key].dataType.simpleString()}, {PIECE_SCHEMA}")


# ---- the configuration linear program, on the histogram ----------------------
def price(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack with repetition: for every room up to ``capacity`` the greatest total
    value of lengths (index + 1) that fit, and the length taken there (0: none)."""
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    n = len(value)
    for c in range(1, capacity + 1):
        k = min(c, n)
        gain = value[:k] + best[c - k:c][::-1]
        j = int(gain.argmax())
        if gain[j] > best[c - 1]:
            best[c], take[c] = gain[j], j + 1
        else:
            best[c] = best[c - 1]
    return best, take


def best_with(length: int, take: np.ndarray, capacity: int) -> tuple[tuple[int, int], ...]:
    """The dearest configuration that holds ``length``, as sorted (length, times)."""
    out, room = {length: 1}, capacity - length
    while room > 0:
        if l := int(take[room]):
            out[l] = out.get(l, 0) + 1
            room -= l
        else:
            room -= 1
    return tuple(sorted(out.items()))


@dataclass
class Program:
    """A fractional solution: ``x`` covers every length at least once, ``value`` is its
    number of sequences, and no solution of the program has fewer than ``bound``."""
    x: dict[tuple[tuple[int, int], ...], float]
    value: float
    bound: float


def solve(counts: np.ndarray, capacity: int, rounds: int = PRICING_ROUNDS, gap: float = GAP) -> Program:
    """Fractional configurations that cover ``counts`` (index + 1 is the length).

    The weight of a length falls exponentially with its coverage. A round prices by
    dynamic programs, one for each level of counts (powers of ``LEVEL``), and every
    length behind the round's target takes its dearest configuration of lengths that
    are not much rarer, in amounts that cover none of those by more than ``WIDTH`` at
    once; beyond that the configuration goes on without them. So each round covers all
    lengths by ``WIDTH`` more, however uneven the counts are. Scaled by the least
    coverage, the sum covers all; weights over the greatest price bound the optimum
    from below. Rounds end within ``gap`` of that bound, or after ``rounds``.
    """
    lengths = np.flatnonzero(counts) + 1
    if not len(lengths):
        return Program({}, 0.0, 0.0)
    need = np.where(counts > 0, counts, 1).astype(float)
    start = np.where(counts > 0, np.arange(1, len(counts) + 1) / capacity, 0.0)
    level = np.floor(np.log(need) / np.log(LEVEL)).astype(int)
    covered, total, low, bound, done = np.zeros(len(counts)), 0.0, 0.0, 0.0, 0
    x: dict[tuple, float] = {}
    while low < 1 or done < rounds and total / low > (1 + gap) * bound:
        value = start * np.exp(-STEP * np.minimum(covered - low, FLOOR))
        takes = {}
        for v in sorted(set(level[lengths - 1].tolist()), reverse=True):
            best, takes[v] = price(np.where(level >= v, value, 0.0), capacity)
        bound = max(bound, float((value * counts).sum() / best[capacity]))
        for l in map(int, lengths[np.argsort(covered[lengths - 1], kind="stable")]):
            config = best_with(l, takes[level[l - 1]], capacity)
            while (short := low + WIDTH - covered[l - 1]) > 1e-9:
                times = dict(config)[l]
                amount = min(short * need[l - 1] / times, *(WIDTH * need[m - 1] / k for m, k in config if m != l), math.inf)
                x[config] = x.get(config, 0.0) + amount
                total += amount
                for m, k in config:
                    covered[m - 1] += amount * k / need[m - 1]
                config = tuple((m, k) for m, k in config if m == l or WIDTH * need[m - 1] / k > amount)
        low, done = float(covered[lengths - 1].min()), done + 1
    return Program({c: a / low for c, a in x.items()}, total / low, bound)


def fill(left: np.ndarray, capacity: int) -> dict[int, int]:
    """The longest remaining length, and lengths that fill its sequence best."""
    lengths = (np.flatnonzero(left) + 1)[::-1]
    first = int(lengths[0])
    room, reach, steps = capacity - first, 1, []
    mask = (1 << (room + 1)) - 1
    for l in map(int, lengths):
        if l > room:
            continue
        for _ in range(min(int(left[l - 1]) - (l == first), room // l)):
            new = ((reach << l) & mask) & ~reach
            if not new:
                break
            reach |= new
            steps.append((l, new))
        if reach >> room & 1:
            break
    config, at = {first: 1}, reach.bit_length() - 1
    for l, new in reversed(steps):
        if new >> at & 1:
            config[l] = config.get(l, 0) + 1
            at -= l
    return config


def _take(left: np.ndarray, config, most: int) -> int:
    """How often, up to ``most``, the remaining pieces give a configuration; they are taken."""
    m = min([most, *(int(left[l - 1]) // k for l, k in config)])
    for l, k in config:
        left[l - 1] -= m * k
    return m


def _filled(left: np.ndarray, capacity: int, used: list) -> list[tuple[dict[int, int], int]]:
    """``used`` as they are, then what they leave from the longest piece on."""
    left, out = left.copy(), [(dict(c), m) for c, m in used]
    for c, m in used:
        _take(left, c, m)
    while left.any():
        config = fill(left, capacity)
        out.append((config, _take(left, config.items(), int(left.max()))))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = PRICING_ROUNDS) -> tuple[list[tuple[dict[int, int], int]], int]:
    """(configuration, number of sequences) that hold exactly the given pieces, and how
    many of the sequences come from the program (those of one whole piece aside).

    Amounts are rounded down, those of full configurations to one at least: full ones
    first, then the greatest, while the pieces last. Of the results that keep the first ``KEPT`` of them and fill the
    rest, the one with the fewest sequences is taken, and of these the one that keeps most.
    """
    left = np.zeros(capacity, np.int64)
    for l, n in histogram.items():
        left[l - 1] = n
    whole = [({capacity: 1}, int(left[-1]))] if left[-1] else []
    left[-1] = 0
    least = -(-int((left * np.arange(1, capacity + 1)).sum()) // capacity)
    rest, used = left.copy(), []
    solution = [(sum(l * k for l, k in config) == capacity, amount, config)
                for config, amount in solve(left, capacity, rounds).x.items()]
    for full, amount, config in sorted(solution, key=lambda c: (not c[0], -c[1], c[2])):
        if m := _take(rest, config, max(int(full), int(amount))):
            used.append((config, m))
    best = None
    for kept in KEPT:
        program = used[:int(len(used) * kept)]
        out = _filled(left, capacity, program)
        if best is None or sum(m for _, m in out) < sum(m for _, m in best[0]):
            best = out, sum(m for _, m in program)
        if sum(m for _, m in best[0]) == least:
            break
    return whole + best[0], best[1]


def places(configs: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length << 44 | first rank, first sequence, repeats, offset), sorted:
    where the pieces of a length go by rank."""
    rows, rank, sequence = [], {}, 0
    for config, m in configs:
        offset = 0
        for l, k in sorted(config.items(), reverse=True):
            first = rank.get(l, 0)
            rows.append((l << 44 | first, sequence, k, offset))
            rank[l] = first + m * k
            offset += l * k
        sequence += m
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """Every piece with its sequence_id and offset."""
    spark = docs.sparkSession
    cut = materialize(pieces(docs, tokenizer, capacity, key), "op1-pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    sent = spark.sparkContext.broadcast(places(plan(histogram, capacity)[0]))
    salts = 1 + max(histogram.values(), default=0) // GROUP_ROWS
    salted = cut.withColumn("salt", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy(key, "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("rank", F.row_number().over(within)).join(sizes, ["length", "salt"])
              .withColumn("rank", F.col("rank") - 1 + F.col("before")))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = sent.value
        row = at[np.searchsorted(at[:, 0], (length.to_numpy() << 44) | rank.to_numpy(), side="right") - 1]
        j = rank.to_numpy() - (row[:, 0] & ((1 << 44) - 1))
        return pd.DataFrame({"sequence_id": row[:, 1] + j // row[:, 2],
                             "offset": row[:, 3] + j % row[:, 2] * length.to_numpy()})

    return (ranked.withColumn("place", place("length", "rank"))
            .select(key, "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"))
