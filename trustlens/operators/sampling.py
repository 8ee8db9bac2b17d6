"""Seeded hashing, exact ranks, balancing and splits.

All randomness is a hash of (seed, stage, row key): results do not depend on
partitioning or on the number of executors, and an SQL engine reproduces them.

Exact draws without moving rows
-------------------------------
"The first k rows of a class in hash order" is a filter once the hash of the k-th row is
known. ``first_of_class`` finds it from counts: rows are counted per (class, next four hex
digits of the hash), the digits that hold the k-th row are kept, and the count is refined
inside them until few rows are left, of which the k-th is taken. Each pass reads only the
key columns and returns one row a class; the rows themselves are filtered where they are,
in the scan, and never shuffled.

Ranks (``hash_rank``) are for where every row needs its own: the first hex digits form a
bucket, rows are counted per (class, bucket), running offsets are taken over that small
table, and ``row_number`` runs only inside (class, bucket). md5 buckets are uniform by
construction, so none is hot.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustlens.functions.text import col_of

DEFAULT_SEED = 42
BUCKET_DIGITS = 4
FEW_ROWS = 10_000  # of a class, ordered at once to find its k-th row


def hash_key(seed: int, stage: str, *cols: Column | str) -> Column:
    """md5 hex of 'seed:stage:col1:col2...'."""
    parts = [F.lit(str(seed)), F.lit(stage)] + [col_of(c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_int(key: Column) -> Column:
    """The first 12 hex digits of a key as a non-negative BIGINT (48 bits)."""
    return F.conv(F.substring(key, 1, 12), 16, 10).cast("long")


def hash_rank(df: DataFrame, partition_cols: list[str], key: Column, tiebreak: list[str],
              out: str = "rank", digits: int = BUCKET_DIGITS) -> DataFrame:
    """Exact 1-based rank of each row by ``(key, *tiebreak)`` within ``partition_cols``."""
    df = df.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, digits))
    pcols = list(partition_cols)
    counts = df.groupBy(*pcols, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*pcols).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    offsets = counts.withColumn("_offset", F.sum("_n").over(w_off) - F.col("_n")).drop("_n")
    w_in = Window.partitionBy(*pcols, "_bucket").orderBy("_key", *tiebreak)
    # null-safe: rows whose partition column is null are a group of their own
    on = F.lit(True)
    for c in [*pcols, "_bucket"]:
        offsets = offsets.withColumnRenamed(c, f"_o_{c}")
        on = on & df[c].eqNullSafe(offsets[f"_o_{c}"])
    joined = df.join(offsets, on, "inner").drop(*[f"_o_{c}" for c in [*pcols, "_bucket"]])
    return (joined.withColumn(out, F.col("_offset") + F.row_number().over(w_in))
                  .drop("_offset", "_bucket"))


def class_profile(df: DataFrame, label: str = "label") -> DataFrame:
    """H1: one row with majority / minority class, their counts and the ratio.

    Ties: the majority is the smallest label among the largest counts, the
    minority the largest label among the smallest counts.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return _profile_of(counts, label).drop("total").withColumn(
        "imbalance_ratio", F.round(F.col("majority_count") / F.col("minority_count"), 6))


def _profile_of(counts: DataFrame, label: str) -> DataFrame:
    """The profile from (label, n); a null label counts in ``total`` only."""
    s = F.when(F.col(label).isNotNull(), F.struct((-F.col("n")).alias("neg"), F.col(label).alias("label")))
    return counts.agg(F.min(s).alias("a"), F.max(s).alias("b"), F.count(label).alias("n_classes"),
                      F.sum("n").alias("total")).select(
        F.col("a.label").alias("majority"), F.col("b.label").alias("minority"),
        (-F.col("a.neg")).alias("majority_count"), (-F.col("b.neg")).alias("minority_count"),
        "n_classes", "total")


def class_counts(df: DataFrame, label: str | None) -> dict:
    """Rows of each class on the driver (one number a class; None: rows without a label)."""
    if label is None:
        return {None: df.count()}
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def kth_keys(df: DataFrame, label: str | None, key: Column, ids: list[str], wanted: dict, few: int = FEW_ROWS,
             digits: int = BUCKET_DIGITS) -> dict:
    """class -> (hash of its k-th row by hash and ids, rows with that hash that are among
    the first k, rows with that hash) for the classes in ``wanted`` (class: (k, rows))."""
    spark = df.sparkSession
    kind = df.schema[label].dataType.simpleString() if label else "string"
    narrow = df.select((F.col(label) if label else F.lit(None).cast("string")).alias("c"), key.alias("h"), *[F.col(i).alias(f"_{n}") for n, i in enumerate(ids)])

    def inside(state):
        """The rows of each class whose hash starts with the digits found so far."""
        now = F.broadcast(spark.createDataFrame([(c, p, k) for c, (p, k, _) in state.items()], f"_c {kind}, p string, k long"))  # one row a class
        return narrow.join(now, narrow["c"].eqNullSafe(F.col("_c")) & F.col("h").startswith(F.col("p"))).drop("_c")

    state = {c: ("", k, n) for c, (k, n) in wanted.items()}
    while True:
        wide = {c: x for c, x in state.items() if x[2] > few and len(x[0]) < 32}
        if not wide:
            break
        at = F.length("p") + 1
        counts = inside(wide).groupBy("c", "k", F.substring("h", 1, at + digits - 1).alias("b")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = counts.withColumn("upto", upto).where((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("n") < F.col("k")))
        state.update({r["c"]: (r["b"], r["k"] - (r["upto"] - r["n"]), r["n"]) for r in found.collect()})
    order = Window.partitionBy("c").orderBy("h", *[f"_{n}" for n in range(len(ids))])
    out = {c: (p, k, n) for c, (p, k, n) in state.items() if len(p) >= 32}  # rows that share one hash
    small = {c: x for c, x in state.items() if c not in out}
    if small:
        ranked = inside(small).select("c", "h", "k", F.row_number().over(order).alias("i"))
        last = ranked.where("i = k").select("c", F.col("h").alias("last"), "k")
        same = (ranked.drop("k").join(last, ranked["c"].eqNullSafe(last["c"]) & (F.col("h") == F.col("last"))).drop(last["c"])
                .groupBy("c", "last", "k").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("low")))
        out.update({r["c"]: (r["last"], r["k"] - r["low"] + 1, r["n"]) for r in same.collect()})
    return out


def first_of_class(df: DataFrame, label: str | None, key: Column, ids: list[str], ranks: dict, counts: dict, out: str,
                   few: int = FEW_ROWS) -> DataFrame:
    """The rows with ``out``: whether a row is among the first ``ranks[class]`` of its class
    by (hash, ids). Classes that ``ranks`` does not name have none. Rows are only read and
    filtered; where rows share their hash and ids across the border, those few are ranked."""
    wanted = {c: (min(k, counts[c]), counts[c]) for c, k in ranks.items() if counts.get(c) and 0 < k < counts[c]}
    whole = [c for c, k in ranks.items() if counts.get(c) and k >= counts[c]]
    last = kth_keys(df, label, key, ids, wanted, few) if wanted else {}
    rows = [(c, h, m == n, m) for c, (h, m, n) in last.items()] + [(c, None, True, None) for c in whole]
    if label is None:
        h, all_, most = (rows[0][1:] if rows else ("", True, None))
        d = df.withColumns({"_last": F.lit(h).cast("string"), "_all": F.lit(all_), "_most": F.lit(most).cast("long")})
    else:
        kind = df.schema[label].dataType.simpleString()
        cuts = df.sparkSession.createDataFrame(rows, f"_c {kind}, _last string, _all boolean, _most long")  # one row a class
        d = df.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_c")), "left").withColumn(
            "_last", F.when(F.col("_all").isNull(), F.lit("")).otherwise(F.col("_last"))).drop("_c")
    d = d.withColumn("_h", key)
    inside = F.col("_last").isNull() | (F.col("_h") < F.col("_last")) | (F.col("_all") & (F.col("_h") == F.col("_last")))
    d = d.withColumn(out, F.coalesce(inside, F.lit(False)))
    if not all(r[2] for r in rows):
        tied = ~F.coalesce(F.col("_all"), F.lit(True)) & (F.col("_h") == F.col("_last"))
        order = Window.partitionBy(*([label] if label else []), "_last").orderBy(*ids)
        ranked = d.where(tied).withColumn(out, F.row_number().over(order) <= F.col("_most"))
        d = d.where(~F.coalesce(tied, F.lit(False))).unionByName(ranked)
    return d.drop("_h", "_last", "_all", "_most")


def _extremes(counts: dict):
    """(majority, minority) of the counts, or None without a labelled row; ties as in ``class_profile``."""
    own = {c: n for c, n in counts.items() if c is not None}
    if not own:
        return None
    most, least = max(own.values()), min(own.values())
    return min(c for c, n in own.items() if n == most), max(c for c, n in own.items() if n == least)


def undersample(df: DataFrame, label: str = "label", seed: int = DEFAULT_SEED,
                id_col: str = "review_id", target: str = "minority") -> DataFrame:
    """H2: keep the whole minority class and ``minority_count`` rows of the
    majority class drawn without replacement (lowest seeded hash first).

    ``target='mid'`` draws ``int((majority + minority) / 2)`` instead (H4).
    Classes between the two, and rows without a label, stay whole.
    """
    counts = class_counts(df, label)
    ends = _extremes(counts)
    if ends is None:
        return df.withColumn("copy_no", F.lit(0).cast("long"))
    big, small = ends
    n = counts[small] if target == "minority" else (counts[big] + counts[small]) // 2
    ranks = {c: k for c, k in counts.items() if target == "minority" or c != small} | {big: n}
    d = first_of_class(df, label, hash_key(seed, "undersample", id_col), [id_col], ranks, counts, "_kept")
    return d.where("_kept").drop("_kept").withColumn("copy_no", F.lit(0).cast("long"))


def draw_with_replacement(df: DataFrame, label: str, seed: int, stage: str, id_col: str,
                          minority, size: int, n_draws: int) -> DataFrame:
    """Draws (with replacement) from the minority class, ``n_draws`` of them.

    Draw d picks the minority row of rank ``hash(seed, stage, d) % size + 1``. Draws and
    ranks meet as (number, id) pairs; the class's rows are shuffled once, to fetch the
    drawn ones by their id.
    """
    own = df.where(F.col(label) == F.lit(minority))
    key = hash_key(seed, stage, id_col)
    draws = df.sparkSession.range(n_draws).select(
        F.col("id").alias("copy_no"), (hash_int(hash_key(seed, stage + "-draw", "id")) % F.lit(size) + 1).alias("_rank"))
    repeated = own.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    if repeated:  # an id names several rows: the rows themselves are ranked
        return hash_rank(own, [], key, [id_col], out="_rank").drop("_key").join(draws, "_rank").drop("_rank")
    ranks = hash_rank(own.select(id_col), [], key, [id_col], out="_rank").drop("_key")
    drawn = ranks.join(draws, "_rank").select(F.col(id_col).alias("_id"), "copy_no")
    return own.join(drawn, own[id_col].eqNullSafe(F.col("_id"))).drop("_id")


def oversample(df: DataFrame, label: str = "label", seed: int = DEFAULT_SEED,
               id_col: str = "review_id") -> DataFrame:
    """H3: the whole majority class plus ``majority_count`` draws with
    replacement from the minority class (``copy_no`` = draw number). Classes
    between the two, and rows without a label, stay whole."""
    counts = class_counts(df, label)
    ends = _extremes(counts)
    rest = df.withColumn("copy_no", F.lit(0).cast("long"))
    if ends is None:
        return rest
    big, small = ends
    if big != small:
        rest = rest.where(~F.coalesce(F.col(label) == F.lit(small), F.lit(False)))
    return rest.unionByName(draw_with_replacement(df, label, seed, "oversample", id_col, small, counts[small], counts[big]))


def hybrid_balance(df: DataFrame, label: str = "label", seed: int = DEFAULT_SEED,
                   id_col: str = "review_id") -> DataFrame:
    """H4: both classes to ``int((majority + minority) / 2)``: the majority
    without replacement, the minority with replacement."""
    counts = class_counts(df, label)
    ends = _extremes(counts)
    down = undersample(df, label, seed, id_col, target="mid")
    if ends is None:
        return down
    big, small = ends
    return down.unionByName(draw_with_replacement(df, label, seed, "hybrid", id_col, small, counts[small], (counts[big] + counts[small]) // 2))


def balance_comparison(df: DataFrame, label: str = "label", seed: int = DEFAULT_SEED,
                       id_col: str = "review_id") -> DataFrame:
    """H5: rows and per-class counts for original / under / over / hybrid.

    The samplers draw exact numbers, so the sizes follow from one count per class.
    """
    p = _profile_of(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")), label)
    big, small, total = (F.coalesce(F.col(c), F.lit(0)) for c in ("majority_count", "minority_count", "total"))
    mid = F.floor((big + small) / 2)
    # with a single class, the draws come on top of the rows they are drawn from
    extra = F.when(F.col("n_classes") == 1, big).otherwise(F.lit(0))
    sizes = [("Original", total, big, small),
             ("Undersampling", total - big + small, small, small),
             ("Oversampling", total - small + big + extra, big + extra, big + extra),
             ("Kombinasi", total - big - small + 2 * mid + extra, mid + extra, mid + extra)]
    rows = F.array(*[F.struct(F.lit(name).alias("dataset"), F.lit(i).alias("ord"), n.alias("total"),
                              j.alias("majority_rows"), k.alias("minority_rows"))
                     for i, (name, n, j, k) in enumerate(sizes)])
    return p.select(F.inline(rows))


def balance_status(df: DataFrame, label: str = "label") -> DataFrame:
    """H6: difference of the two class shares in percent, and a status.

    < 5: BALANCED, < 15: FAIR, else NOT BALANCED; only for two classes.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.sum("n").alias("total"),
        (F.max("n") - F.min("n")).alias("diff"),
    ).select(
        "n_classes", "total",
        F.when(F.col("n_classes") == 2,
               F.round(F.col("diff") * 100.0 / F.col("total"), 6)).alias("diff_pct"),
    ).withColumn(
        "status",
        F.when(F.col("diff_pct").isNull(), F.lit(None).cast("string"))
         .when(F.col("diff_pct") < 5, F.lit("BALANCED"))
         .when(F.col("diff_pct") < 15, F.lit("FAIR"))
         .otherwise(F.lit("NOT BALANCED")))


def shuffle_order(df: DataFrame, seed: int = DEFAULT_SEED, id_cols=("review_id",)) -> DataFrame:
    """H7: a seeded shuffle as a sort on the hash key (``orderBy`` samples the
    key range and range-partitions, so no single partition holds the table)."""
    return df.withColumn("_h", hash_key(seed, "shuffle", *id_cols)).orderBy(
        "_h", *id_cols).drop("_h")


def shuffle_positions(df: DataFrame, seed: int = DEFAULT_SEED, id_cols=("review_id",),
                      out: str = "position") -> DataFrame:
    """H7 as data: each row's 1-based position in the seeded shuffle (exact,
    computed with bucketed ranks, no single-partition sort)."""
    return hash_rank(df, [], hash_key(seed, "shuffle", *id_cols), list(id_cols), out=out).drop("_key")


def split_exact(df: DataFrame, frac: float = 0.8, seed: int = DEFAULT_SEED,
                id_cols=("review_id",), stage: str = "split") -> DataFrame:
    """H8: ``set`` = 'train' for the first ``int(n * frac)`` rows in seeded
    hash order, 'test' for the rest; exact sizes."""
    counts = class_counts(df, None)
    d = first_of_class(df, None, hash_key(seed, stage, *id_cols), list(id_cols), {None: math.floor(counts[None] * frac)}, counts, "_train")
    return d.withColumn("set", F.when(F.col("_train"), F.lit("train")).otherwise(F.lit("test"))).drop("_train")


def split_validation(train: DataFrame, frac: float = 0.1, seed: int = DEFAULT_SEED,
                     id_cols=("review_id",)) -> DataFrame:
    """H9: the first ``max(1, int(n_train * frac))`` training rows (same hash
    order as the split) are the validation set."""
    counts = class_counts(train, None)
    return first_of_class(train, None, hash_key(seed, "split", *id_cols), list(id_cols),
                          {None: max(1, math.floor(counts[None] * frac))}, counts, "is_validation")


def split_stratified(df: DataFrame, label: str = "label", frac: float = 0.8,
                     seed: int = DEFAULT_SEED, id_cols=("review_id",)) -> DataFrame:
    """Per class, the first ``round(n_class * (1 - frac))`` rows in hash
    order are 'test', the rest 'train'."""
    counts = class_counts(df, label)
    # half up, on the product as Spark and SQL compute it
    ranks = {c: math.floor(n * (1.0 - frac) + 0.5) for c, n in counts.items()}
    d = first_of_class(df, label, hash_key(seed, "stratified", *id_cols), list(id_cols), ranks, counts, "_test")
    return d.withColumn("set", F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))).drop("_test")


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by name, missing columns as nulls."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def bootstrap_weights(df: DataFrame, n_trees: int, seed: int = DEFAULT_SEED,
                      id_col: str = "review_id") -> DataFrame:
    """Per tree, n draws with replacement from n rows, as (tree, row, weight).

    The draws of tree t are the rows themselves (draw d = rank - 1), so the
    draws table is distributed like the data; each draw maps to the row of
    rank ``hash % n + 1`` and draws are counted per (tree, row).
    """
    r = hash_rank(df.select(id_col), [], hash_key(seed, "bag", id_col), [id_col])
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    draws = (r.select((F.col("rank") - 1).alias("draw"),
                      F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"))
              .crossJoin(F.broadcast(n))
              .withColumn("rank", hash_int(hash_key(seed, "bag-draw", "tree", "draw"))
                          % F.col("_n") + 1)
              .groupBy("tree", "rank").agg(F.count(F.lit(1)).alias("weight")))
    return (draws.join(r.select(id_col, "rank"), "rank", "inner")
                 .select("tree", id_col, "weight"))
