"""Personal data: spans of fixed patterns, and candidates chosen by boosted trees.

Base spans (email, ip, card, phone) come from patterns and checks. Wider
generators propose more candidates of the same kinds, which may overlap. Boosted
trees learn from format and context which of them are personal data. Positive
rows are candidates overlapping a base span of their kind, and candidates
touching no base span that pass their kind's check once separators are normalised
((at), [dot], [.]: Luhn, octets, numbers of digits) and have the kind's usual shape
or a word before them that names it. The scores of all candidates, in bins, give
each kind the least score at which ``PRECISION`` of the rows, and of those that
touch no base span, are positive. Candidates above it that touch no base span are
added, the best first where they overlap.

Only built-in functions and the JVM's boosted trees run; texts are scanned once
and never shuffled. The trees are fitted on at most about ``SAMPLE_ROWS``
candidates, an equal share of each kind and label; everything else covers all
rows. Positions are code points.

Null text counts as empty. Repeated rows are reported each. A table without
positive or without other candidates gets no model and no added spans. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlens.session import materialize

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns. A match can only start where a run of its first class
# starts or the last match ended, and runs are taken whole: linear on long texts.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
# High-recall generators.
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?(?:@|\((?:at|AT)\)|\[(?:at|AT)\])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20\.\x20|\x20?(?:\((?:dot|DOT)\)|\[(?:dot|DOT)\])\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9A-Za-z])|\G)[0-9]{1,3}+(?:(?:\.|,|\x20\.\x20?|\[\.\])[0-9]{1,3}+){3}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[\x20./-]{0,2}[0-9]){11,18}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00)?[(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}+(?![0-9A-Za-z])",
}
CUES = r"(?i)(?:tel|phone|fon|call|mobile|card|visa|pay|host|address|server|mail|contact)[a-z]*[\s:=.,]*$"
# Words that name a kind, and shapes that are usual for it.
NAMED = {
    "email": r"(?i)\b(?:e-?mail|mail|contact)[a-z]*[\s:=.,]*$",
    "ip": r"(?i)\b(?:ip|host|server)[a-z]*[\s:=.,]*$|(?i)\bip address[\s:=.,]*$",
    "card": r"(?i)\b(?:card|visa|mastercard|amex)[a-z]*[\s:=.,]*$",
    "phone": r"(?i)\b(?:tel|phone|telephone|fon|fax|call|mobile)[a-z]*[\s:=.,]*$",
}
SHAPE = {
    "email": r"@|(?i)[(\[]at[)\]]",
    "ip": r"\[\.\]",
    "card": r"^[0-9]{4}([\x20./-]{1,2})(?:[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{6}\1[0-9]{4,5})$",
    "phone": r"^(?:(?:\+|00)?1[\x20.-])?(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[\x20./-])[2-9][0-9]{2}[\x20.-][0-9]{4}$"
             r"|^00[1-9][0-9]{0,2}[\x20()./-]",
}
SAMPLE_ROWS, PRECISION, LEAST_CLASS = 20_000, 0.95, 20
FEATURES = ("chars", "digits", "dots", "blanks", "dashes", "brackets", "slashes", "letters", "at", "plus", "zeros",
            "first_digit", "groups", "before_letter", "before_blank", "before_quote", "after_letter", "after_blank",
            "after_stop", "cue", "line_start", "valid", "shaped", "named")


def spans(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: start, end and text of every match, left to right."""
    parts = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1),
                       lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g")))
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    return F.aggregate(
        F.filter(parts, lambda p: p.m.isNotNull()), F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda a, p: F.struct((a.at + p.g + F.length(p.m)).alias("at"), F.array_append(
            a.out, F.struct((a.at + p.g).alias("s"), (a.at + p.g + F.length(p.m)).alias("e"), p.m.alias("m"))).alias("out")),
        lambda a: a.out)


def _luhn(digits: Column) -> Column:
    value = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))))
    return F.aggregate(value, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _valid(kind: str, m: Column) -> Column:
    """Whether a wide candidate passes its kind's check once its separators are normalised."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "email":
        plain = F.regexp_replace(F.lower(m), r"\x20?[(\[]at[)\]]\x20?", "@")
        plain = F.regexp_replace(plain, r"\x20?[(\[]dot[)\]]\x20?", ".")
        return plain.rlike(r"^[a-z0-9](?:[a-z0-9._%+-]*[a-z0-9])?@(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,24}$")
    if kind == "ip":
        return _holds("ip", F.regexp_replace(m, r"\[\.\]|,|\x20\.\x20?", "."))
    if kind == "card":
        return digits.rlike("^[2-6]") & _holds("card", m)
    return _holds("phone", m) & ~m.rlike(r"(?:19|20)[0-9]{2}([./-])[0-9]{2}\1[0-9]{2}")


def _guard(kind: str, text: Column) -> Column:
    """Whether a text can hold the kind at all: spares the costlier patterns."""
    return {"email": text.contains("@") | text.rlike(r"(?i)[(\[]at[)\]]"), "phone": text.rlike("[0-9]"),
            "ip": text.rlike("[0-9]"), "card": text.rlike("[0-9]")}[kind]


def _count(m: Column, chars: str) -> Column:
    return F.length(m) - F.length(F.translate(m, chars, ""))


def _candidate(text: Column, kind: str, x: Column) -> Column:
    """A candidate with its features."""
    m = x.m
    before = F.substring(text, F.greatest(x.s - 19, F.lit(1)), F.least(x.s, F.lit(20)))
    after = F.substring(text, x.e + 1, F.lit(1))
    is_ = lambda c: c.cast("double")
    f = dict(chars=F.length(m), digits=_count(m, "0123456789"), dots=_count(m, "."), blanks=_count(m, " "),
             dashes=_count(m, "-"), brackets=_count(m, "()[]"), slashes=_count(m, "/"),
             letters=F.length(F.regexp_replace(m, "[^A-Za-z]", "")), at=_count(m, "@"), plus=_count(m, "+"),
             zeros=is_(m.startswith("00")), first_digit=F.coalesce(F.regexp_extract(m, "([0-9])", 1).try_cast("double"), F.lit(-1.0)),
             groups=F.size(F.split(m, "[^0-9]+")), before_letter=is_(before.rlike(r"\p{L}$")),
             before_blank=is_(before.rlike(r"\s$")), before_quote=is_(before.rlike(r"[\"'=:]\s?$")),
             after_letter=is_(after.rlike(r"\p{L}")), after_blank=is_(after.rlike(r"\s")),
             after_stop=is_(after.rlike("[.,;]")), cue=is_(before.rlike(CUES)),
             line_start=is_((F.length(before) == 0) | before.endswith("\n")), valid=is_(_valid(kind, m)),
             shaped=is_(m.rlike(SHAPE[kind])), named=is_(before.rlike(NAMED[kind])))
    return F.struct(F.lit(kind).alias("kind"), x.s.alias("s"), x.e.alias("e"),
                    *[f[n].cast("double").alias(n) for n in FEATURES])


def _describer(text: Column, kind: str):
    return lambda x: _candidate(text, kind, x)


def detect(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, row (hash of the row), base and wide: arrays of spans. One text scan."""
    t = docs.select(F.col(f"`{key}`").alias(key), F.coalesce("text", F.lit("")).alias("t"))
    none = "array<struct<s:int,e:int,m:string>>"
    text = F.col("t")
    for kind in KINDS:
        may = _guard(kind, text)
        base_may = text.contains("+") if kind == "phone" else may
        t = t.withColumn(f"b_{kind}", F.when(base_may, spans(text, BASE[kind])).otherwise(F.array().cast(none)))
        t = t.withColumn(f"w_{kind}", F.when(may, spans(text, WIDE[kind])).otherwise(F.array().cast(none)))

    def held(i: int, kind: str) -> Column:
        return F.transform(F.filter(f"b_{kind}", lambda x: _holds(kind, x.m)), lambda x: F.struct(
            x.s.alias("s"), F.lit(i).alias("i"), F.lit(kind).alias("kind"), x.e.alias("e")))

    base = [held(i, kind) for i, kind in enumerate(KINDS)]
    wide = [F.transform(f"w_{kind}", _describer(text, kind)) for kind in KINDS]
    return t.select(key, F.xxhash64(key, "t").alias("row"), F.sort_array(F.concat(*base)).alias("base"),
                    F.concat(*wide).alias("wide"))


def _fit(rows: DataFrame):
    """Boosted trees on a bounded sample, an equal share of each kind and label; or None."""
    n = rows.groupBy("kind", "label").agg(F.count("*").alias("n")).collect()
    keep = F.create_map(*[F.lit(x) for r in n for x in (
        f"{r['kind']}{r['label']:.0f}", 1 + r["n"] * len(n) // SAMPLE_ROWS)]) if n else F.lit(None)
    if any(sum(r["n"] for r in n if r["label"] == label) < LEAST_CLASS for label in (0.0, 1.0)):
        return None
    sample = rows.where(F.pmod(F.xxhash64("row", "s", "e", "kind"), keep[F.concat("kind", F.col("label").cast("int").cast("string"))]) == 0)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=10, maxDepth=4, seed=7, stepSize=0.2)
    return trees.fit(materialize(sample.select("label", *FEATURES).coalesce(4), "op2-sample").transform(vectors.transform)
                     .select("features", "label"))


def _least(scored: DataFrame) -> dict[str, int]:
    """The least bin of scores of each kind, over all candidates, at which ``PRECISION`` holds
    for all of them and for those that can be added."""
    bins = scored.groupBy("kind", "bin").agg(
        F.count("*").alias("n"), F.sum("label").alias("good"), F.count_if("free").alias("n_free"),
        F.sum(F.when(F.col("free"), F.col("label")).otherwise(0.0)).alias("good_free")).collect()
    least = {}
    for kind in {r["kind"] for r in bins}:
        n = good = n_free = good_free = 0.0
        for r in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"]):
            n, good, n_free, good_free = n + r["n"], good + r["good"], n_free + r["n_free"], good_free + r["good_free"]
            if n >= LEAST_CLASS and good >= PRECISION * n and good_free >= PRECISION * n_free:
                least[kind] = r["bin"]
    return least


def _score(model, rows: DataFrame) -> DataFrame:
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    return (model.transform(vectors.transform(rows))
            .withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction"))


def find(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, base and added: arrays of spans of every row."""
    found = materialize(detect(docs, key), "op2-found")
    touches = lambda b, c: (b.s < c.e) & (c.s < b.e)
    rows = (found.dropDuplicates([key, "row"]).where(F.size("wide") > 0)
            .select("row", "base", F.explode("wide").alias("c"))
            .withColumn("free", ~F.exists("base", lambda b: touches(b, F.col("c"))))
            .withColumn("label", F.when(F.col("free"), (F.col("c.valid") == 1) & (F.col("c.shaped") + F.col("c.named") > 0)).otherwise(
                F.exists("base", lambda b: touches(b, F.col("c")) & (b.kind == F.col("c.kind")))).cast("double"))
            .select("row", "label", "free", "c.*"))
    rows = materialize(rows, "op2-rows")
    model = _fit(rows)
    scored = least = None
    if model is not None:
        scored = materialize(_score(model, rows).select("row", "kind", "s", "e", "label", "free", "score",
                                                        F.floor(F.col("score") * 50).cast("int").alias("bin")), "op2-scored")
        least = _least(scored)
    if not least:
        return found.select(key, "base", F.expr("slice(base, 1, 0)").alias("added"))
    floor = F.create_map(*[F.lit(x) for kv in least.items() for x in kv])
    chosen = scored.where(F.col("free") & (F.col("bin") >= F.try_element_at(floor, F.col("kind"))))
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    best = chosen.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        (-F.round("score", 6)).alias("score"), (F.col("s") - F.col("e")).alias("size"), "s",
        order[F.col("kind")].alias("i"), "kind", "e"))).alias("cs"))
    none = F.array().cast("array<struct<s:int,i:int,kind:string,e:int>>")
    best = best.select("row", F.aggregate("cs", none, lambda a, c: F.when(
        F.exists(a, lambda b: touches(b, c)), a).otherwise(F.array_append(
            a, F.struct(c.s.alias("s"), c.i.alias("i"), c.kind.alias("kind"), c.e.alias("e"))))).alias("added"))
    return found.join(best, "row", "left").select(key, "base", F.coalesce("added", none).alias("added"))


def _text(spans_: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(spans_), lambda x: F.concat_ws(
        ":", x.kind, x.s.cast("string"), x.e.cast("string"))), ",")


def _number(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")


def report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The contract's columns of every row."""
    return find(docs, key).select(
        key, *[_number(k) for k in KINDS],
        F.sha2(_text(F.col("base")), 256).alias("base_sha256"),
        _text(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def redact(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and the text with every span replaced by its kind in brackets. Rows with
    the same key must hold the same text."""
    f = find(docs, key).dropDuplicates([key]).select(
        F.col(key).alias("__k"), F.sort_array(F.concat("base", "added")).alias("__s"))
    out = F.aggregate("__s", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda a, x: F.struct(
        F.greatest(a.at, x.e).alias("at"), F.when(x.s < a.at, a.out).otherwise(F.concat(
            a.out, F.substring("text", a.at + 1, x.s - a.at), F.lit("["), x.kind, F.lit("]"))).alias("out")),
        lambda a: F.concat(a.out, F.substring("text", a.at + 1, F.length("text"))))
    return docs.join(f, docs[key].eqNullSafe(F.col("__k"))).select(docs[key], out.alias("text"))
