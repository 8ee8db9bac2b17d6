"""Independent SQL (DuckDB dialect) for every registered query.

Each string runs on the driver tables registered as views (``documents``,
``events``, ``labels``, ...). The SQL is written from the operator definitions,
not generated from the Spark plans; only fixed word lists are shared.
DuckDB notes: regexes are RE2 (no look-around, no back-references), lambdas are
written ``lambda x: ...``, and ``0.15`` is DECIMAL, so doubles are spelled
``0.15::DOUBLE`` where it matters.
"""

from __future__ import annotations

from trustlens.functions import lexicons as L


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(words) -> str:
    return "[" + ", ".join(sql_str(w) for w in words) + "]"


def sql_map_case(expr: str, table: dict) -> str:
    """CASE lookup for a small fixed table; unknown keys pass through."""
    whens = " ".join(f"WHEN {sql_str(k)} THEN {sql_str(v)}" for k, v in table.items())
    return f"(CASE {expr} {whens} ELSE {expr} END)"


# --- the reviews adapter ------------------------------------------------------
REVIEWS_RAW = """
reviews_raw AS (
  SELECT
    d.doc_id AS review_id,
    d.source AS title,
    e.user_id AS user_id,
    CASE WHEN d.doc_id % 13 = 0 THEN NULL
         WHEN d.doc_id % 11 = 0 THEN ''
         WHEN d.doc_id % 7 = 2 THEN d.text || ' http://x.co/a?b=1 @user1 #promo 123 wow!!'
         ELSE d.text END AS text,
    CASE WHEN d.doc_id % 17 = 0 THEN 'x'
         WHEN TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 10 < 6 THEN '5'
         ELSE CAST(1 + TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 4 AS VARCHAR)
    END AS stars,
    CASE WHEN d.doc_id % 9 = 0 THEN 'n/a'
         WHEN d.doc_id % 4 = 0 THEN '1'
         ELSE CAST(e.user_id % 40 AS VARCHAR) END AS reviewerNumberOfReviews,
    CASE e.user_id % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN 'yes' END
      AS isLocalGuide,
    CASE WHEN d.doc_id % 19 = 0 THEN NULL
         WHEN d.doc_id % 23 = 0 THEN 'garbage'
         WHEN d.doc_id % 6 = 0
           THEN strftime(e.ts + to_days(CAST(d.doc_id AS INTEGER)), '%Y-%m-%dT%H:%M:%S.000Z')
         ELSE strftime(e.ts, '%Y-%m-%dT%H:%M:%S.000Z') END AS publishedAtDate,
    CASE d.doc_id % 8 WHEN 1 THEN '[]' WHEN 2 THEN '["u1","u2"]' WHEN 3 THEN '[''u1'', ''u2'']'
         WHEN 4 THEN 'u1;u2' WHEN 5 THEN 'u1|nan' WHEN 6 THEN 'http://x.co/a.jpg'
         WHEN 7 THEN 'u1, u2,' END AS reviewImageUrls,
    CASE d.doc_id % 5 WHEN 0 THEN '5,5,5' WHEN 1 THEN '5, 4, 5' WHEN 2 THEN ''
         WHEN 4 THEN '5.0 5.0' END AS reviewDetailedRating,
    CASE d.doc_id % 3 WHEN 1 THEN '' WHEN 2 THEN 'Dine in' END AS reviewContext,
    CASE l.quality WHEN 0 THEN 'FAKE' WHEN 1 THEN 'REAL' END AS label,
    CASE WHEN d.doc_id % 6 = 0 THEN e.ts + to_days(CAST(d.doc_id AS INTEGER)) ELSE e.ts END
      AS ts_value
  FROM documents d
  LEFT JOIN events e ON e.event_id = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

# Typed columns the labeller derives. Dates: the 'garbage' and null rows
# have no timestamp; the rest parse back to the (shifted) event time.
LABELLER_TYPED = """
typed AS (
  SELECT r.*,
    CAST(COALESCE(TRY_CAST(r.stars AS DOUBLE), 0) AS BIGINT) AS stars_i,
    CAST(COALESCE(TRY_CAST(r.reviewerNumberOfReviews AS DOUBLE), 0) AS BIGINT) AS reviewer_i,
    COALESCE(r.isLocalGuide IN ('True', 'true'), false) AS local_b,
    CASE WHEN r.publishedAtDate IS NULL OR r.publishedAtDate = 'garbage' THEN NULL
         ELSE CAST(r.ts_value AS DATE) END AS publish_day,
    r.reviewImageUrls IS NOT NULL AS has_review_image,
    COALESCE(r.text, '') AS text_f,
    len(list_filter(regexp_split_to_array(COALESCE(r.text, ''), '[\\s\\p{Z}]+'),
                    lambda w: w <> '')) AS text_len_words,
    array_to_string(list_filter(list_transform(
        [string_split(r.reviewDetailedRating, ',')[1],
         string_split(r.reviewDetailedRating, ',')[2],
         string_split(r.reviewDetailedRating, ',')[3]], lambda x: trim(x)),
        lambda x: x IS NOT NULL AND x <> ''), ',') AS detail_joined
  FROM reviews_raw r
)"""


def _labelled_cte() -> str:
    five_fives = """(CASE WHEN len(list_filter(list_transform(string_split(replace(detail_joined, ';', ','), ','), lambda p: trim(p)), lambda p: p <> '')) = 0 THEN false
        ELSE len(list_filter(list_transform(string_split(replace(detail_joined, ';', ','), ','), lambda p: trim(p)),
                 lambda p: p <> '' AND NOT (COALESCE(TRY_CAST(p AS DOUBLE) >= 5 AND TRY_CAST(p AS DOUBLE) < 6, false)))) = 0 END)"""
    return f"""
photo AS (
  SELECT max(CAST(has_review_image AS INTEGER)) AS any_review FROM typed
),
scored AS (
  SELECT t.*,
    CASE WHEN p.any_review = 1 THEN t.has_review_image ELSE true END AS has_image,
    {five_fives} AS all_fives
  FROM typed t CROSS JOIN photo p
),
days AS (
  SELECT publish_day, CAST(count(*) AS INTEGER) AS cnt FROM typed
  WHERE publish_day IS NOT NULL GROUP BY publish_day
),
rules AS (
  SELECT s.*,
    CASE WHEN s.publish_day IS NULL THEN 0 ELSE COALESCE(dd.cnt, 0) END AS same_day_count,
    [CASE WHEN stars_i = 5 AND text_len_words = 0 THEN {sql_str(L.REASON_FIVE_NO_TEXT)} END,
     CASE WHEN stars_i = 5 AND text_len_words > 0 AND text_len_words < 5 THEN {sql_str(L.REASON_FIVE_SHORT)} END,
     CASE WHEN NOT has_image THEN {sql_str(L.REASON_NO_PHOTO)} END,
     CASE WHEN all_fives THEN {sql_str(L.REASON_ALL_FIVES)} END,
     CASE WHEN reviewer_i <= 2 THEN {sql_str(L.REASON_NEW_REVIEWER)} END,
     CASE WHEN NOT local_b THEN {sql_str(L.REASON_NOT_LOCAL)} END,
     CASE WHEN reviewContext IS NULL OR trim(reviewContext) = '' THEN {sql_str(L.REASON_NO_CONTEXT)} END
    ] AS reason_slots,
    (CASE WHEN stars_i = 5 AND text_len_words = 0 THEN 3
          WHEN stars_i = 5 AND text_len_words < 5 THEN 2 ELSE 0 END)
    + (CASE WHEN NOT has_image THEN 1 ELSE 0 END)
    + (CASE WHEN all_fives THEN 1 ELSE 0 END)
    + (CASE WHEN reviewer_i <= 2 THEN 2 ELSE 0 END)
    + (CASE WHEN NOT local_b THEN 1 ELSE 0 END)
    + (CASE WHEN reviewContext IS NULL OR trim(reviewContext) = '' THEN 1 ELSE 0 END) AS base_score
  FROM scored s LEFT JOIN days dd ON dd.publish_day = s.publish_day
),
labelled AS (
  SELECT r.*,
    base_score + CASE WHEN same_day_count > 5 THEN 2 ELSE 0 END AS fake_score,
    list_filter(reason_slots, lambda x: x IS NOT NULL)
      || CASE WHEN same_day_count > 5 THEN [{sql_str(L.REASON_BURST)}] ELSE [] END AS reasons_list
  FROM rules r
),
final AS (
  SELECT l.*,
    CASE WHEN fake_score >= 4 THEN 'FAKE' ELSE 'REAL' END AS label_h,
    CASE WHEN fake_score >= 4 THEN array_to_string(reasons_list, '; ')
         ELSE {sql_str(L.REASON_REAL)} END AS reason
  FROM labelled l
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


LABELLED = with_ctes(REVIEWS_RAW, LABELLER_TYPED, _labelled_cte())


# --- text helpers in SQL ---------------------------------------------------------
WS_SQL = r"[\s\p{Z}]+"


def words_sql(t: str, lower: bool = False) -> str:
    base = f"lower(COALESCE({t}, ''))" if lower else f"COALESCE({t}, '')"
    return f"list_filter(regexp_split_to_array({base}, '{WS_SQL}'), lambda w: w <> '')"


def blank_sql(t: str) -> str:
    return f"({t} IS NULL OR NOT regexp_matches({t}, '[^\\s\\p{{Z}}]'))"


def tq_sql(t: str) -> dict[str, str]:
    """The 14 text-quality columns for text column ``t``, unrounded."""
    cons = L.CONSONANTS
    lower_cons = cons[: len(cons) // 2]
    blank = blank_sql(t)
    wl = words_sql(t, lower=True)
    w = words_sql(t)
    n_cons = f"length(regexp_replace(COALESCE({t}, ''), '[^{cons}]', '', 'g'))"
    n_vow = f"length(regexp_replace(COALESCE({t}, ''), '[^{L.VOWELS}]', '', 'g'))"
    vowel = (f"(CASE WHEN {blank} THEN 0.5 WHEN {n_cons} = 0 THEN 0.0 "
             f"ELSE {n_vow}::DOUBLE / {n_cons} END)")
    valid = (f"(CASE WHEN {blank} OR len({wl}) = 0 THEN 0.0 ELSE "
             f"len(list_filter({wl}, lambda x: list_contains({sql_list(L.LEXICON)}, x)))::DOUBLE"
             f" / len({wl}) END)")
    avg = (f"(CASE WHEN {blank} OR len({w}) = 0 THEN 0.0 ELSE "
           f"list_sum(list_transform({w}, lambda x: length(x)))::DOUBLE / len({w}) END)")
    p = f"((length({t}) - length(replace({t}, d, '')))::DOUBLE / length({t}))"
    ent = (f"(CASE WHEN {blank} THEN 0.0 ELSE "
           f"-list_sum(list_transform(list_distinct(string_split({t}, '')), lambda d: {p} * log2({p}))) END)")
    ch = f"string_split({t}, '')"
    rep = (f"(CASE WHEN {blank} OR length({t}) <= 1 THEN 0.0 ELSE "
           f"len(list_filter(range(1, length({t})), lambda i: {ch}[i] = {ch}[i + 1] "
           f"AND regexp_matches({ch}[i], '^\\p{{L}}$')))::DOUBLE / length({t}) END)")
    clu = (f"(CASE WHEN {blank} OR len({wl}) = 0 THEN 0.0 ELSE "
           f"list_sum(list_transform({wl}, lambda x: list_max(list_transform("
           f"regexp_split_to_array(x, '[^{lower_cons}]'), lambda r: length(r)))))::DOUBLE"
           f" / len({wl}) END)")
    f_abn = f"(CASE WHEN {vowel} < 0.25 OR {vowel} > 2.5 THEN 1 ELSE 0 END)"
    f_low = f"(CASE WHEN {valid} < 0.1 THEN 1 ELSE 0 END)"
    f_long = f"(CASE WHEN {blank} THEN 0 WHEN {avg} > 8 THEN 1 ELSE 0 END)"
    f_ent = f"(CASE WHEN {ent} > 4.5 THEN 1 ELSE 0 END)"
    f_rep = f"(CASE WHEN {rep} > 0.3 THEN 1 ELSE 0 END)"
    f_clu = f"(CASE WHEN {clu} > 4 THEN 1 ELSE 0 END)"
    pct = (f"(CASE WHEN {blank} THEN 0 ELSE 15 * {f_abn} + 30 * {f_low} + 20 * {f_long} "
           f"+ 10 * {f_ent} + 10 * {f_rep} + 15 * {f_clu} END)")
    return {
        "tq_vowel_ratio": vowel, "tq_abnormal_vowel": f_abn,
        "tq_valid_word_ratio": valid, "tq_low_valid_words": f_low,
        "tq_avg_word_length": avg, "tq_has_long_words": f_long,
        "tq_entropy": ent, "tq_high_entropy": f_ent,
        "tq_repeated_ratio": rep, "tq_has_repeated": f_rep,
        "tq_consonant_cluster": clu, "tq_long_consonant": f_clu,
        "tq_gibberish_score": f"({pct} / 100.0)", "tq_is_gibberish": f"(CASE WHEN {pct} > 40 THEN 1 ELSE 0 END)",
    }


ROUNDED_TQ = ("tq_vowel_ratio", "tq_valid_word_ratio", "tq_avg_word_length", "tq_entropy",
              "tq_repeated_ratio", "tq_consonant_cluster", "tq_gibberish_score")


def cleanse_sql(t: str, digit_repl: str = "") -> str:
    s = f"lower(COALESCE({t}, ''))"
    s = f"regexp_replace({s}, 'http\\S+|www\\S+|https\\S+', '', 'g')"
    s = f"regexp_replace({s}, '@[\\p{{L}}\\p{{N}}_]+', '', 'g')"
    s = f"regexp_replace({s}, '#[\\p{{L}}\\p{{N}}_]+', '', 'g')"
    s = f"regexp_replace({s}, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')"
    s = f"regexp_replace({s}, '\\p{{Nd}}+', {sql_str(digit_repl)}, 'g')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


def preprocess_sql(t: str, slang=None, stopwords=None, stems=None, digit_repl: str = "") -> str:
    slang = L.SLANG if slang is None else slang
    stopwords = L.STOPWORDS_SAMPLE if stopwords is None else stopwords
    stems = L.STEMS_SAMPLE if stems is None else stems
    c = cleanse_sql(t, digit_repl)
    toks = f"list_filter(regexp_split_to_array({c}, '{WS_SQL}'), lambda w: w <> '')"
    mapped = f"list_transform({toks}, lambda w: {sql_map_case('w', slang)})"
    rejoined = f"trim(regexp_replace(array_to_string({mapped}, ' '), '\\s+', ' ', 'g'))"
    toks2 = f"list_filter(regexp_split_to_array({rejoined}, '{WS_SQL}'), lambda w: w <> '')"
    kept = f"list_filter({toks2}, lambda w: NOT list_contains({sql_list(stopwords)}, w))"
    stemmed = f"list_transform({kept}, lambda w: {sql_map_case('w', stems)})"
    return f"array_to_string({stemmed}, ' ')"


def labelled_select(select: str) -> str:
    return LABELLED + select


ORACLES: dict[str, str] = {}

ORACLES["label_distribution"] = labelled_select("""
SELECT label_h AS label, count(*) AS count,
       round(count(*) * 100.0 / (SELECT count(*) FROM final), 6) AS pct
FROM final GROUP BY label_h""")

ORACLES["label_reviews"] = labelled_select("""
SELECT review_id, stars_i AS stars, reviewer_i AS reviewer_reviews, local_b AS is_local_guide,
       strftime(publish_day, '%Y-%m-%d') AS publish_day, has_image,
       CAST(text_len_words AS INTEGER) AS text_len_words, CAST(same_day_count AS INTEGER) AS same_day_count,
       CAST(fake_score AS INTEGER) AS fake_score, label_h AS label, reason
FROM final""")

ORACLES["fake_score_histogram"] = labelled_select("""
SELECT CAST(fake_score AS INTEGER) AS fake_score, count(*) AS count, fake_score >= 4 AS at_or_above_threshold
FROM final GROUP BY fake_score""")

ORACLES["stars_value_counts"] = labelled_select("""
SELECT stars_i AS stars, count(*) AS count FROM final GROUP BY stars_i""")

ORACLES["distinct_titles"] = labelled_select("""
SELECT DISTINCT title FROM final WHERE title IS NOT NULL""")

ORACLES["duplicate_titles"] = labelled_select("""
SELECT title, count(*) AS count FROM final WHERE title IS NOT NULL GROUP BY title HAVING count(*) > 1""")

ORACLES["text_length_histogram"] = labelled_select("""
, clipped AS (SELECT LEAST(GREATEST(CAST(text_len_words AS DOUBLE), 0.0), 200.0) AS v FROM final),
rng AS (SELECT min(v) AS lo, max(v) AS hi FROM clipped),
binned AS (
  SELECT CASE WHEN hi = lo THEN 0 ELSE CAST(LEAST(floor((v - lo) / ((hi - lo) / 30)), 29) AS INTEGER) END AS bin
  FROM clipped, rng),
counted AS (SELECT bin, count(*) AS cnt FROM binned GROUP BY bin),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT b.bin, round(lo + b.bin * (hi - lo) / 30, 6) AS bin_start,
       round(lo + (b.bin + 1) * (hi - lo) / 30, 6) AS bin_end, COALESCE(c.cnt, 0) AS count
FROM bins b CROSS JOIN rng LEFT JOIN counted c ON c.bin = b.bin""")

ORACLES["photo_rate"] = labelled_select("""
SELECT round(avg(CAST(has_image AS INTEGER)) * 100.0, 6) AS pct FROM final""")

ORACLES["count_fake"] = labelled_select("""
SELECT count(*) FILTER (WHERE label_h = 'FAKE') AS n_fake FROM final""")

ORACLES["class_counts"] = labelled_select("""
SELECT CASE label_h WHEN 'FAKE' THEN 0 WHEN 'REAL' THEN 1 END AS y, count(*) AS count
FROM final GROUP BY 1""")

ORACLES["five_star_short_preview"] = labelled_select("""
SELECT review_id, title, stars_i AS stars, CAST(text_len_words AS INTEGER) AS text_len_words, has_image
FROM final WHERE stars_i = 5 AND text_len_words <= 3 ORDER BY review_id LIMIT 5""")

ORACLES["sample_labelled"] = labelled_select("""
SELECT review_id, title, stars_i AS stars, CAST(fake_score AS INTEGER) AS fake_score, label_h AS label
FROM final ORDER BY md5('42:sample:' || CAST(review_id AS VARCHAR)), review_id LIMIT 50""")

ORACLES["same_day_events"] = """
WITH d AS (SELECT event_id, CAST(ts AS DATE) AS day FROM events),
c AS (SELECT day, CAST(count(*) AS INTEGER) AS n FROM d WHERE day IS NOT NULL GROUP BY day)
SELECT d.event_id, strftime(d.day, '%Y-%m-%d') AS publish_day,
       CASE WHEN d.day IS NULL THEN 1 ELSE COALESCE(c.n, 1) END AS same_day_count
FROM d LEFT JOIN c ON c.day = d.day"""


def tq_ctes(src: str, text: str, keep: str, name: str = "tq") -> str:
    """Two CTEs: base measures once per row, then flags and the score."""
    cols = tq_sql(text)
    base = ", ".join(f"{cols[c]} AS {c}" for c in (
        "tq_vowel_ratio", "tq_valid_word_ratio", "tq_avg_word_length", "tq_entropy",
        "tq_repeated_ratio", "tq_consonant_cluster"))
    stage1 = (f"{name}_base AS MATERIALIZED (SELECT {keep}, {blank_sql(text)} AS is_blank, {base} "
              f"FROM {src})")
    flags = """
      CASE WHEN tq_vowel_ratio < 0.25 OR tq_vowel_ratio > 2.5 THEN 1 ELSE 0 END AS tq_abnormal_vowel,
      CASE WHEN tq_valid_word_ratio < 0.1 THEN 1 ELSE 0 END AS tq_low_valid_words,
      CASE WHEN is_blank THEN 0 WHEN tq_avg_word_length > 8 THEN 1 ELSE 0 END AS tq_has_long_words,
      CASE WHEN tq_entropy > 4.5 THEN 1 ELSE 0 END AS tq_high_entropy,
      CASE WHEN tq_repeated_ratio > 0.3 THEN 1 ELSE 0 END AS tq_has_repeated,
      CASE WHEN tq_consonant_cluster > 4 THEN 1 ELSE 0 END AS tq_long_consonant"""
    stage2 = f"{name}_flags AS (SELECT *, {flags} FROM {name}_base)"
    pct = ("CASE WHEN is_blank THEN 0 ELSE 15 * tq_abnormal_vowel + 30 * tq_low_valid_words "
           "+ 20 * tq_has_long_words + 10 * tq_high_entropy + 10 * tq_has_repeated "
           "+ 15 * tq_long_consonant END")
    stage3 = (f"{name} AS (SELECT *, ({pct}) / 100.0 AS tq_gibberish_score, "
              f"CASE WHEN ({pct}) > 40 THEN 1 ELSE 0 END AS tq_is_gibberish FROM {name}_flags)")
    return ",\n".join([stage1, stage2, stage3])


def tq_output(prefix: str = "") -> str:
    out = []
    for c in L.TEXT_QUALITY_FEATURES:
        col = f"{prefix}{c}"
        out.append(f"round({col}, 6) AS {c}" if c in ROUNDED_TQ else f"{col} AS {c}")
    return ", ".join(out)


ORACLES["text_quality"] = ("WITH " + tq_ctes("documents", "text", "doc_id") +
                           f"\nSELECT doc_id, {tq_output()} FROM tq")

_TQ_DOCS = "WITH " + tq_ctes("documents", "text", "doc_id, lang") + "\n"

ORACLES["gibberish_stats"] = _TQ_DOCS + """
SELECT lang, count(*) AS rows, CAST(sum(tq_is_gibberish) AS BIGINT) AS flagged,
       round(avg(tq_gibberish_score), 6) AS mean_score
FROM tq GROUP BY lang"""

ORACLES["top_gibberish"] = _TQ_DOCS + """
SELECT doc_id, lang, round(tq_gibberish_score, 6) AS score, round(tq_valid_word_ratio, 6) AS valid_word_ratio
FROM tq ORDER BY tq_gibberish_score DESC, doc_id ASC LIMIT 20"""


def _gib_compare() -> str:
    pre = f"p AS MATERIALIZED (SELECT review_id, text, {preprocess_sql('text')} AS tp FROM reviews_raw)"
    return (with_ctes(REVIEWS_RAW, pre, tq_ctes("p", "text", "review_id", "raw"),
                      tq_ctes("p", "tp", "review_id", "pre")) + """
SELECT r.review_id, round(r.tq_gibberish_score, 6) AS raw_score, r.tq_is_gibberish AS raw_flag,
       round(q.tq_gibberish_score, 6) AS pre_score, q.tq_is_gibberish AS pre_flag
FROM raw r JOIN pre q ON q.review_id = r.review_id""")


# gibberish_compare has no oracle here: DuckDB re-evaluates the captured
# preprocessed text inside every lambda, which is too slow on whole texts.
# It is checked in tests/ against the per-text definitions instead.

ORACLES["preprocess_reviews"] = with_ctes(REVIEWS_RAW) + f"""
SELECT review_id, {preprocess_sql('text')} AS text_preprocessed
FROM reviews_raw WHERE NOT {blank_sql('text')}"""

ORACLES["preprocess_stats"] = with_ctes(REVIEWS_RAW) + f"""
SELECT count(*) AS rows_before, count(*) FILTER (WHERE NOT {blank_sql('text')}) AS rows_after,
       count(*) FILTER (WHERE {blank_sql('text')}) AS rows_removed
FROM reviews_raw"""


# --- balancing and splits ----------------------------------------------------------
GIVEN = with_ctes(REVIEWS_RAW, "base AS (SELECT review_id, label FROM reviews_raw WHERE label IS NOT NULL)")
ORDERS_BASE = "WITH base AS (SELECT o_orderkey AS review_id, o_orderstatus AS label FROM orders)\n"


def h(stage: str, *cols: str) -> str:
    """md5 key 'seed:stage:cols' and its first 12 hex digits as BIGINT."""
    inner = " || ':' || ".join([f"'42:{stage}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"md5({inner})"


def h_int(stage: str, *cols: str) -> str:
    return f"('0x' || substr({h(stage, *cols)}, 1, 12))::BIGINT"


PROFILE = """,
cnt AS (SELECT label, count(*) AS n FROM base WHERE label IS NOT NULL GROUP BY label),
rk AS (SELECT *, row_number() OVER (ORDER BY n DESC, label ASC) AS rmaj,
                 row_number() OVER (ORDER BY n ASC, label DESC) AS rmin FROM cnt),
prof AS (SELECT max(CASE WHEN rmaj = 1 THEN label END) AS majority,
                max(CASE WHEN rmin = 1 THEN label END) AS minority,
                max(CASE WHEN rmaj = 1 THEN n END) AS majority_count,
                max(CASE WHEN rmin = 1 THEN n END) AS minority_count,
                count(*) AS n_classes FROM rk)
"""


def ranked_cte(name: str, stage: str) -> str:
    return (f", {name} AS (SELECT b.*, row_number() OVER (PARTITION BY label ORDER BY "
            f"{h(stage, 'review_id')}, review_id) AS rk FROM base b)\n")


def under_sql(target: str = "minority") -> str:
    n = "minority_count" if target == "minority" else "floor((majority_count + minority_count) / 2)"
    others = "label IS DISTINCT FROM majority" + ("" if target == "minority" else " AND label IS DISTINCT FROM minority")
    return (f"SELECT review_id, label, CAST(0 AS BIGINT) AS copy_no FROM ru, prof "
            f"WHERE (label = majority AND rk <= {n}) OR ({others})")


def draws_sql(stage: str, n: str) -> str:
    return (f"SELECT r.review_id, r.label, d.copy_no FROM "
            f"(SELECT rk - 1 AS copy_no, ({h_int(stage + '-draw', 'rk - 1')} % minority_count) + 1 AS pick "
            f" FROM r_{stage}, prof WHERE label = majority AND rk <= {n}) d "
            f"JOIN r_{stage} r ON r.rk = d.pick, prof WHERE r.label = prof.minority")


def _balancing(base: str) -> str:
    return (base + PROFILE + ranked_cte("ru", "undersample") + ranked_cte("r_oversample", "oversample")
            + ranked_cte("r_hybrid", "hybrid"))


ORACLES["class_profile_orders"] = ORDERS_BASE + PROFILE + """
SELECT majority, minority, majority_count, minority_count, n_classes,
       round(majority_count / minority_count, 6) AS imbalance_ratio FROM prof"""

ORACLES["undersample_orders"] = _balancing(ORDERS_BASE) + under_sql()

OVER = ("SELECT review_id, label, CAST(0 AS BIGINT) AS copy_no FROM base, prof WHERE (label = majority OR label IS DISTINCT FROM minority) "
        "UNION ALL " + draws_sql("oversample", "majority_count"))
HYBRID = (under_sql("mid") + " UNION ALL "
          + draws_sql("hybrid", "floor((majority_count + minority_count) / 2)"))

ORACLES["oversample_labels"] = _balancing(GIVEN) + OVER
ORACLES["hybrid_labels"] = _balancing(GIVEN) + HYBRID
ORACLES["balance_comparison"] = _balancing(GIVEN) + f"""
, under AS ({under_sql()}), over AS ({OVER}), hyb AS ({HYBRID}),
parts AS (SELECT 'Original' AS dataset, 0 AS ord, label FROM base
          UNION ALL SELECT 'Undersampling', 1, label FROM under
          UNION ALL SELECT 'Oversampling', 2, label FROM over
          UNION ALL SELECT 'Kombinasi', 3, label FROM hyb)
SELECT dataset, ord, count(*) AS total,
       count(*) FILTER (WHERE label = majority) AS majority_rows,
       count(*) FILTER (WHERE label = minority) AS minority_rows
FROM parts, prof GROUP BY dataset, ord"""

ORACLES["balance_status"] = GIVEN + """
, c AS (SELECT label, count(*) AS n FROM base GROUP BY label),
s AS (SELECT count(*) AS n_classes, sum(n) AS total, max(n) - min(n) AS diff FROM c)
SELECT n_classes, CAST(total AS BIGINT) AS total,
       CASE WHEN n_classes = 2 THEN round(diff * 100.0 / total, 6) END AS diff_pct,
       CASE WHEN n_classes <> 2 THEN NULL
            WHEN diff * 100.0 / total < 5 THEN 'BALANCED'
            WHEN diff * 100.0 / total < 15 THEN 'FAIR' ELSE 'NOT BALANCED' END AS status
FROM s"""

SPLIT = f""", sp AS (
  SELECT b.*, row_number() OVER (ORDER BY {h('split', 'review_id')}, review_id) AS rk,
         count(*) OVER () AS n FROM base b),
split AS (SELECT review_id, label, CASE WHEN rk <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS set, rk
          FROM sp)
"""

ORACLES["split_exact"] = GIVEN + SPLIT + "SELECT review_id, label, set FROM split"

ORACLES["split_validation"] = GIVEN + SPLIT + f"""
, tr AS (SELECT review_id, row_number() OVER (ORDER BY {h('split', 'review_id')}, review_id) AS vr,
                count(*) OVER () AS n FROM split WHERE set = 'train')
SELECT review_id, vr <= GREATEST(1, floor(n * 0.1)) AS is_validation FROM tr"""

ORACLES["split_stratified"] = GIVEN + f"""
, s AS (SELECT b.*, row_number() OVER (PARTITION BY label ORDER BY {h('stratified', 'review_id')}, review_id) AS rk,
               count(*) OVER (PARTITION BY label) AS n FROM base b)
SELECT review_id, label, CASE WHEN rk <= round(n * 0.2) THEN 'test' ELSE 'train' END AS set FROM s"""

ORACLES["bootstrap_bags"] = GIVEN + f"""
, r AS (SELECT review_id, row_number() OVER (ORDER BY {h('bag', 'review_id')}, review_id) AS rk,
               count(*) OVER () AS n FROM base),
d AS (SELECT CAST(t.tree AS INTEGER) AS tree, ({h_int('bag-draw', 't.tree', 'r.rk - 1')} % r.n) + 1 AS pick
      FROM r CROSS JOIN (SELECT range AS tree FROM range(30)) t)
SELECT d.tree, r.review_id, count(*) AS weight FROM d JOIN r ON r.rk = d.pick GROUP BY d.tree, r.review_id"""


# --- vectorisation ------------------------------------------------------------------
TOKENS_DOCS = f"""WITH toks AS MATERIALIZED (
  SELECT doc_id AS review_id,
         list_filter(regexp_split_to_array({preprocess_sql('text')}, '{WS_SQL}'), lambda w: w <> '') AS tokens
  FROM documents),
tc AS (SELECT review_id, term, count(*) AS tf_count FROM (SELECT review_id, unnest(tokens) AS term FROM toks)
       GROUP BY review_id, term),
stats AS (SELECT term, CAST(sum(tf_count) AS BIGINT) AS total, count(*) AS df FROM tc GROUP BY term),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY total DESC, term ASC) - 1 AS INTEGER) AS term_id,
                 total, df, ln((SELECT count(*) FROM toks) / (df + 1)) AS idf
          FROM (SELECT * FROM stats ORDER BY total DESC, term ASC LIMIT 1000))
"""

ORACLES["term_stats"] = TOKENS_DOCS + "SELECT term, total, df FROM stats"
ORACLES["vocabulary"] = TOKENS_DOCS + "SELECT term, term_id, total, df, round(idf, 6) AS idf FROM vocab"
ORACLES["tfidf"] = TOKENS_DOCS + """
SELECT tc.review_id, v.term_id, round(tc.tf_count / len(t.tokens) * v.idf, 6) AS tfidf
FROM tc JOIN vocab v ON v.term = tc.term JOIN toks t ON t.review_id = tc.review_id"""
ORACLES["term_frequency"] = TOKENS_DOCS + """
SELECT tc.review_id, tc.term, tc.tf_count, round(tc.tf_count / len(t.tokens), 6) AS tf
FROM tc JOIN toks t ON t.review_id = tc.review_id"""


# --- naive Bayes on labelled documents --------------------------------------------------
def _nb_base(as_list: bool = False):
    union = " UNION ALL ".join(
        f"SELECT review_id, y, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM tqm"
        for c in L.TEXT_QUALITY_FEATURES)
    ld = ("ld AS (SELECT d.doc_id AS review_id, CASE WHEN l.quality = 0 THEN 1 ELSE -1 END AS y, "
          "d.text FROM documents d JOIN labels l ON l.doc_id = d.doc_id)")
    toks = (f"toks AS (SELECT review_id, list_filter(regexp_split_to_array("
            f"{preprocess_sql('text')}, '{WS_SQL}'), lambda w: w <> '') AS tokens FROM ld)")
    parts = [ld, tq_ctes("ld", "text", "review_id, y"),
             "tqm AS MATERIALIZED (SELECT * FROM tq)", toks, f"""
sp AS (SELECT review_id, y, row_number() OVER (ORDER BY {h('split', 'review_id')}, review_id) AS rk,
              count(*) OVER () AS n FROM ld)""", """
sets AS (SELECT review_id, y, CASE WHEN rk <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS set FROM sp)""",
        "ntrain AS (SELECT count(*) AS n FROM sets WHERE set = 'train')", f"""
fl AS (SELECT f.review_id, f.y, f.feature, f.x, s.set FROM
       ({union}) f
       JOIN sets s ON s.review_id = f.review_id)""", """
scaler AS (SELECT feature, avg(x) AS mean,
                  CASE WHEN stddev_pop(x) = 0 OR stddev_pop(x) IS NULL THEN 1.0 ELSE stddev_pop(x) END AS scale
           FROM fl WHERE set = 'train' GROUP BY feature)""", """
scaled AS (SELECT fl.review_id, fl.y, fl.set, fl.feature, (fl.x - sc.mean) / sc.scale AS z
           FROM fl JOIN scaler sc ON sc.feature = fl.feature)""", """
priors AS (SELECT y, count(*) AS n, count(*) / (SELECT n FROM ntrain) AS prior FROM sets WHERE set = 'train' GROUP BY y)""", """
gauss AS (SELECT y, feature, avg(z) AS mean, var_pop(z) + 1e-9 AS var FROM scaled WHERE set = 'train' GROUP BY y, feature)""", """
num AS (SELECT s.review_id, g.y AS cls,
               ln(p.prior + 1e-12) + sum(-0.5 * ln(2 * pi() * g.var) - 0.5 * (s.z - g.mean) * (s.z - g.mean) / g.var) AS score
        FROM scaled s JOIN gauss g ON g.feature = s.feature JOIN priors p ON p.y = g.y
        GROUP BY s.review_id, g.y, p.prior)""", """
tc AS (SELECT review_id, term, count(*) AS tf_count FROM (SELECT review_id, unnest(tokens) AS term FROM toks)
       GROUP BY review_id, term)""", """
nw AS (SELECT review_id, len(tokens) AS n_words FROM toks)""", """
tstats AS (SELECT term, sum(tf_count) AS total, count(*) AS df FROM tc JOIN sets s ON s.review_id = tc.review_id
           WHERE s.set = 'train' GROUP BY term)""", """
vocab AS (SELECT term, row_number() OVER (ORDER BY total DESC, term ASC) - 1 AS term_id,
                 ln((SELECT n FROM ntrain) / (df + 1)) AS idf
          FROM (SELECT * FROM tstats ORDER BY total DESC, term ASC LIMIT 1000))""", """
tfidf AS (SELECT tc.review_id, v.term_id, tc.tf_count / nw.n_words * v.idf AS x
          FROM tc JOIN vocab v ON v.term = tc.term JOIN nw ON nw.review_id = tc.review_id)""", """
wcs AS (SELECT s.y, t.term_id, sum(t.x) AS wc FROM tfidf t JOIN sets s ON s.review_id = t.review_id
        WHERE s.set = 'train' GROUP BY s.y, t.term_id)""", """
grid AS (SELECT c.y, v.term_id, COALESCE(w.wc, 0) AS wc FROM (SELECT DISTINCT y FROM sets WHERE set = 'train') c
         CROSS JOIN vocab v LEFT JOIN wcs w ON w.y = c.y AND w.term_id = v.term_id)""", """
tot AS (SELECT y, sum(wc) AS tot FROM grid GROUP BY y)""", """
lp AS (SELECT g.y, g.term_id, ln((g.wc + 1.0) / (t.tot + 1.0 * (SELECT count(*) FROM vocab) + 1e-12)) AS log_prob
       FROM grid g JOIN tot t ON t.y = g.y)""", """
tsum AS (SELECT t.review_id, lp.y AS cls, sum(t.x * lp.log_prob) AS s FROM tfidf t JOIN lp ON lp.term_id = t.term_id
         GROUP BY t.review_id, lp.y)""", """
txt AS (SELECT r.review_id, p.y AS cls, ln(p.prior) + COALESCE(ts.s, 0) AS score
        FROM sets r CROSS JOIN priors p LEFT JOIN tsum ts ON ts.review_id = r.review_id AND ts.cls = p.y)""", """
comb AS (SELECT t.review_id, t.cls, 0.6 * t.score + 0.4 * n.score AS c
         FROM txt t JOIN num n ON n.review_id = t.review_id AND n.cls = t.cls)""", """
wide AS (SELECT review_id, max(CASE WHEN cls = 1 THEN c END) AS cf, max(CASE WHEN cls = -1 THEN c END) AS cr
         FROM comb GROUP BY review_id)""", """
pred AS (SELECT w.review_id, s.set, s.y, CASE WHEN cf > cr THEN 1 ELSE -1 END AS y_pred,
                exp(cf - greatest(cf, cr)) / (exp(cf - greatest(cf, cr)) + exp(cr - greatest(cf, cr))) AS prob_fake,
                exp(cr - greatest(cf, cr)) / (exp(cf - greatest(cf, cr)) + exp(cr - greatest(cf, cr))) AS prob_real
         FROM wide w JOIN sets s ON s.review_id = w.review_id)"""]
    return parts if as_list else with_ctes(*parts)


NB_BASE = _nb_base()

# The long-form (unpivoted) numeric half below stalls DuckDB; it is replaced
# by the wide form at the end of this module.
NB_NUMERIC_NO_ORACLE = ("scaler_fit", "nb_gaussian_fit", "nb_predict", "nb_metrics",
                        "confusion_matrix", "classification_report")

ORACLES["scaler_fit"] = NB_BASE + "SELECT feature, round(mean, 6) AS mean, round(scale, 6) AS scale FROM scaler"
ORACLES["nb_text_fit"] = NB_BASE + "SELECT y, CAST(term_id AS INTEGER) AS term_id, round(log_prob, 6) AS log_prob FROM lp"
ORACLES["nb_gaussian_fit"] = NB_BASE + """
SELECT g.y, p.n, round(p.prior, 6) AS prior, g.feature, round(g.mean, 6) AS mean, round(g.var, 6) AS var
FROM gauss g JOIN priors p ON p.y = g.y"""
ORACLES["nb_predict"] = NB_BASE + """
SELECT review_id, set, y, y_pred, round(prob_fake, 6) AS prob_fake, round(prob_real, 6) AS prob_real FROM pred"""

_COUNTS = """
, cm AS (SELECT set, count(*) FILTER (WHERE y = 1 AND y_pred = 1) AS tp, count(*) FILTER (WHERE y = -1 AND y_pred = 1) AS fp,
         count(*) FILTER (WHERE y = -1 AND y_pred = -1) AS tn, count(*) FILTER (WHERE y = 1 AND y_pred = -1) AS fn
         FROM pred GROUP BY set),
mt AS (SELECT *, (tp + tn) / (tp + fp + tn + fn) AS accuracy,
              CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM cm)
"""
ORACLES["nb_metrics"] = NB_BASE + _COUNTS + """
SELECT set, tp, fp, tn, fn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) AS f1
FROM mt"""

_LABELLED_PREDS = """
, lpred AS (SELECT review_id, CASE WHEN y = 1 THEN 'FAKE' ELSE 'REAL' END AS label,
                   CASE WHEN y_pred = 1 THEN 'FAKE' ELSE 'REAL' END AS predicted_label FROM pred),
cells AS (SELECT a.c AS actual, b.c AS predicted FROM (VALUES ('FAKE'), ('REAL')) a(c), (VALUES ('FAKE'), ('REAL')) b(c)),
cmx AS (SELECT c.actual, c.predicted, COALESCE(n.cnt, 0) AS count FROM cells c LEFT JOIN
        (SELECT label, predicted_label, count(*) AS cnt FROM lpred GROUP BY 1, 2) n
        ON n.label = c.actual AND n.predicted_label = c.predicted)
"""
ORACLES["confusion_matrix"] = NB_BASE + _LABELLED_PREDS + "SELECT actual, predicted, CAST(count AS BIGINT) AS count FROM cmx"
ORACLES["classification_report"] = NB_BASE + _LABELLED_PREDS + """
, per AS (SELECT actual AS cls, sum(CASE WHEN actual = predicted THEN count ELSE 0 END) AS tp, sum(count) AS support
          FROM cmx GROUP BY actual),
npred AS (SELECT predicted AS cls, sum(count) AS n_pred FROM cmx GROUP BY predicted),
rows_ AS (SELECT p.cls, p.support, CASE WHEN n.n_pred > 0 THEN p.tp / n.n_pred ELSE 0.0 END AS precision,
                 CASE WHEN p.support > 0 THEN p.tp / p.support ELSE 0.0 END AS recall
          FROM per p JOIN npred n ON n.cls = p.cls),
r2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM rows_),
allr AS (
  SELECT cls, support, precision, recall, f1 FROM r2
  UNION ALL SELECT 'macro avg', sum(support), avg(precision), avg(recall), avg(f1) FROM r2
  UNION ALL SELECT 'weighted avg', sum(support),
      CASE WHEN sum(support) > 0 THEN sum(precision * support) / sum(support) ELSE 0.0 END,
      CASE WHEN sum(support) > 0 THEN sum(recall * support) / sum(support) ELSE 0.0 END,
      CASE WHEN sum(support) > 0 THEN sum(f1 * support) / sum(support) ELSE 0.0 END FROM r2
  UNION ALL SELECT 'accuracy', sum(support),
      CASE WHEN sum(support) > 0 THEN sum(recall * support) / sum(support) ELSE 0.0 END,
      CASE WHEN sum(support) > 0 THEN sum(recall * support) / sum(support) ELSE 0.0 END,
      CASE WHEN sum(support) > 0 THEN sum(recall * support) / sum(support) ELSE 0.0 END FROM r2)
SELECT cls, CAST(support AS BIGINT) AS support, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM allr"""


_NB_LONG = {n: ORACLES.pop(n) for n in NB_NUMERIC_NO_ORACLE if n in ORACLES}


# --- trees, SVM and covariance on embeddings --------------------------------------------
ORACLES["gini_by_lang"] = """
WITH d AS (SELECT d.lang, CASE WHEN l.quality = 0 THEN 1 ELSE -1 END AS y
           FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
c AS (SELECT lang, y, count(*) AS c FROM d GROUP BY lang, y)
SELECT lang, CAST(sum(c) AS BIGINT) AS n, round(1.0 - sum(c * c) / (sum(c) * sum(c)), 6) AS gini FROM c GROUP BY lang"""

_EMB_LONG = """
WITH e AS (SELECT vec_id, CASE WHEN label < 5 THEN 1 ELSE -1 END AS y, embedding FROM embeddings),
long AS (SELECT vec_id, y, CAST(i - 1 AS INTEGER) AS feature, CAST(embedding[i] AS DOUBLE) AS value
         FROM e, range(1, 65) r(i))
"""

ORACLES["best_split"] = _EMB_LONG + """
, cnt AS (SELECT feature, value, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y <> 1) AS q
          FROM long GROUP BY feature, value),
run AS (SELECT feature, value,
               sum(p) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS lp,
               sum(q) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS lq,
               sum(p) OVER (PARTITION BY feature) AS tp, sum(q) OVER (PARTITION BY feature) AS tq,
               lead(value) OVER (PARTITION BY feature ORDER BY value) AS nv FROM cnt),
c AS (SELECT feature, 0.5 * (value + nv) AS threshold, lp + lq AS nl, (tp - lp) + (tq - lq) AS nr, tp, tq, lp, lq
      FROM run WHERE nv IS NOT NULL),
g AS (SELECT *, (1.0 - (tp / (tp + tq)) ** 2 - (tq / (tp + tq)) ** 2)
               - (nl / (tp + tq)) * CASE WHEN nl > 0 THEN 1.0 - (lp / nl) ** 2 - (lq / nl) ** 2 ELSE 0.0 END
               - (nr / (tp + tq)) * CASE WHEN nr > 0 THEN 1.0 - ((tp - lp) / nr) ** 2 - ((tq - lq) / nr) ** 2 ELSE 0.0 END
               AS gain FROM c)
SELECT 0 AS node, feature, round(threshold, 6) AS threshold, round(gain, 6) AS gain,
       CAST(nl AS BIGINT) AS n_left, CAST(nr AS BIGINT) AS n_right
FROM g WHERE gain > 0 AND nl >= 2 AND nr >= 2
ORDER BY gain DESC, feature ASC, threshold ASC LIMIT 1"""

ORACLES["given_forest"] = """
WITH x AS (SELECT vec_id AS review_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings),
t AS (SELECT review_id, [CASE WHEN x[4] <= 0.02 THEN CASE WHEN x[11] <= -0.05 THEN 1 ELSE -1 END ELSE -1 END,
                         CASE WHEN x[47] <= -0.08 THEN 1 WHEN x[1] <= 0.1 THEN -1 ELSE 1 END,
                         CASE WHEN x[8] <= 0.0 THEN -1 ELSE 1 END] AS p FROM x),
v AS (SELECT *, len(list_filter(p, lambda k: k = 1)) AS fake FROM t)
SELECT review_id, array_to_string(p, ',') AS tree_predictions, CASE WHEN fake >= 2 THEN 1 ELSE -1 END AS voted,
       CAST(GREATEST(fake, 3 - fake) AS INTEGER) AS votes, round(fake / 3.0, 6) AS share_fake, round((3 - fake) / 3.0, 6) AS share_real FROM v"""

ORACLES["covariance"] = """
SELECT 'e' || i AS col_a, 'e' || j AS col_b,
       round(covar_samp(CAST(embedding[i + 1] AS DOUBLE), CAST(embedding[j + 1] AS DOUBLE)), 6) AS covariance
FROM embeddings, (SELECT range AS i FROM range(64)) a, (SELECT range AS j FROM range(64)) b
WHERE i <= j GROUP BY i, j"""

_W = "[" + ", ".join(f"{((j % 7) - 3) / 10.0}::DOUBLE" for j in range(64)) + "]"
_SVM = f"""
WITH e AS (SELECT vec_id, CASE WHEN label < 5 THEN 1 ELSE -1 END AS y,
                  list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings),
m AS (SELECT vec_id, y, x, list_sum(list_transform(range(1, 65), lambda i: x[i] * ({_W})[i])) + 0.1 AS s FROM e),
h AS (SELECT *, 1.0 - y * s AS margin, CASE WHEN 1.0 - y * s > 0 THEN y ELSE 0 END AS my FROM m)
"""
_REG = 0.01 * sum((((j % 7) - 3) / 10.0) ** 2 for j in range(64))
ORACLES["svm_loss_grad"] = _SVM + f"""
SELECT -2 AS component, round(sum(GREATEST(margin, 0.0)) / count(*) + {_REG!r}, 6) AS value FROM h
UNION ALL SELECT -1, round(-sum(my) / count(*), 6) FROM h
UNION ALL SELECT CAST(i - 1 AS INTEGER), round(2 * 0.01 * ({_W})[i] - sum(my * x[i]) / count(*), 6)
  FROM h, range(1, 65) r(i) GROUP BY i"""
ORACLES["svm_score"] = _SVM + """
SELECT vec_id AS review_id, round(s, 6) AS decision_score, CASE WHEN s >= 0 THEN 1 ELSE -1 END AS y_pred FROM m"""


# --- the trainers' feature table ---------------------------------------------------------
def images_sql(x: str) -> str:
    s = f"trim({x})"
    q = f"replace(replace({s}, '''', '\"'), 'None', 'null')"
    raw = (f"(CASE WHEN {s} IS NULL THEN []::VARCHAR[] "
           f"WHEN {s} LIKE '[%]' AND json_valid({s}) THEN json_extract_string({s}, '$[*]') "
           f"WHEN {s} LIKE '[%]' AND json_valid({q}) THEN json_extract_string({q}, '$[*]') "
           f"WHEN {s} LIKE '%,%' AND NOT {s} LIKE 'http%' THEN string_split({s}, ',') "
           f"WHEN {s} LIKE '%;%' THEN string_split({s}, ';') "
           f"WHEN {s} LIKE '%|%' THEN string_split({s}, '|') ELSE [{s}] END)")
    unq = ("list_transform(list_transform(" + raw + ", lambda t: trim(t)), lambda t: "
           "CASE WHEN length(t) >= 2 AND ((t LIKE '\"%\"') OR (t LIKE '''%''')) "
           "THEN trim(t[2:-2]) ELSE t END)")
    return (f"list_filter({unq}, lambda t: t IS NOT NULL AND t <> '' "
            f"AND lower(t) NOT IN ('nan', 'none', 'null'))")


ORACLES["image_features"] = with_ctes(REVIEWS_RAW, f"i AS (SELECT review_id, reviewImageUrls, {images_sql('reviewImageUrls')} AS imgs FROM reviews_raw)") + """
SELECT review_id, CAST(len(imgs) AS INTEGER) AS n_images, CASE WHEN len(imgs) > 0 THEN 1 ELSE 0 END AS has_image,
       imgs[1] AS first_image,
       CASE WHEN trim(reviewImageUrls) IS NOT NULL AND trim(reviewImageUrls) <> ''
                 AND lower(trim(reviewImageUrls)) <> 'nan' THEN 1 ELSE 0 END AS has_image_simple
FROM i"""


def _features_sql() -> str:
    tp = preprocess_sql("text", slang=L.SLANG_TRAINER, digit_repl=" ")
    f = (f"f AS MATERIALIZED (SELECT review_id, COALESCE(text, '') AS text, {tp} AS tp, stars, "
         f"reviewerNumberOfReviews, isLocalGuide, reviewImageUrls, reviewDetailedRating, "
         f"CASE WHEN publishedAtDate IS NULL OR publishedAtDate = 'garbage' THEN NULL ELSE ts_value END AS pts "
         f"FROM reviews_raw)")
    det_toks = (f"list_filter(regexp_split_to_array(replace(COALESCE(reviewDetailedRating, 'None'), ',', ' '), "
                f"'{WS_SQL}'), lambda t: regexp_matches(replace(t, '.', ''), '^\\p{{Nd}}+$'))")
    g = (f"g AS (SELECT *, {words_sql('tp')} AS w, {words_sql('text')} AS wr, "
         f"{images_sql('reviewImageUrls')} AS imgs, {det_toks} AS det, "
         f"COALESCE(TRY_CAST(stars AS DOUBLE), 0) AS stars_d, "
         f"COALESCE(TRY_CAST(reviewerNumberOfReviews AS DOUBLE), 0) AS rc FROM f)")
    days = "days AS (SELECT CAST(pts AS DATE) AS d, CAST(count(*) AS INTEGER) AS n FROM g WHERE pts IS NOT NULL GROUP BY 1)"
    h = ("h AS (SELECT g.*, CASE WHEN g.pts IS NULL THEN 1 ELSE COALESCE(days.n, 1) END AS same_day_count, "
         "len(imgs) AS n_img FROM g LEFT JOIN days ON days.d = CAST(g.pts AS DATE))")
    return with_ctes(REVIEWS_RAW, f, g, days, h) + """
SELECT review_id, CAST(COALESCE(hour(pts), 0) AS INTEGER) AS publish_hour,
  CAST(len(w) AS INTEGER) AS text_word_count, CAST(length(tp) AS INTEGER) AS text_char_count,
  round(CASE WHEN len(w) > 0 THEN length(regexp_replace(tp, '[\\s\\p{Z}]', '', 'g')) / len(w) ELSE 0.0 END, 6) AS avg_word_length,
  CAST(len(regexp_extract_all(text, '!')) AS INTEGER) AS exclamation_count,
  CAST(len(regexp_extract_all(text, '\\?')) AS INTEGER) AS question_count,
  CAST(len(regexp_extract_all(text, '[.,;:!?"''()\\\\\\-]')) AS INTEGER) AS punctuation_count,
  round(len(list_filter(wr, lambda x: upper(x) = x AND lower(x) <> x)) / GREATEST(len(wr), 1), 6) AS uppercase_word_ratio,
  round(stars_d / 5.0, 6) AS stars_norm,
  CASE WHEN n_img > 0 THEN 1 ELSE 0 END AS has_image, CAST(n_img AS INTEGER) AS n_images,
  round(ln(1 + rc), 6) AS reviewer_count_log,
  CASE WHEN lower(isLocalGuide) IN ('1', 'true', 'yes') THEN 1 ELSE 0 END AS is_local_guide,
  CASE WHEN len(det) > 0 AND len(list_filter(det, lambda t: COALESCE(TRY_CAST(t AS DOUBLE) = 5.0, false))) = len(det)
       THEN 1 ELSE 0 END AS detail_rating_all_5,
  same_day_count,
  CASE WHEN stars_d = 5 AND len(w) < 5 THEN 1 ELSE 0 END AS pattern_5star_short,
  CASE WHEN stars_d = 5 AND n_img = 0 THEN 1 ELSE 0 END AS pattern_5star_nophoto,
  CASE WHEN rc <= 2 THEN 1 ELSE 0 END AS pattern_new_reviewer,
  CASE WHEN same_day_count > 5 THEN 1 ELSE 0 END AS pattern_same_day
FROM h"""


ORACLES["review_features"] = _features_sql()


# --- label correction and confidence statistics -------------------------------------------
ORACLES["label_correction"] = "WITH d AS (SELECT d.doc_id, d.text, CASE WHEN l.quality = 0 THEN 'FAKE' ELSE 'REAL' END AS label FROM documents d JOIN labels l ON l.doc_id = d.doc_id),\n" + \
    tq_ctes("d", "text", "doc_id, label") + """,
c AS (SELECT label, CASE WHEN tq_is_gibberish = 1 AND round(tq_gibberish_score * 100) > 70 THEN 'FAKE' ELSE label END AS label_after FROM tq)
SELECT count(*) FILTER (WHERE label = 'FAKE') AS fake_before, count(*) FILTER (WHERE label_after = 'FAKE') AS fake_after,
       count(*) FILTER (WHERE label <> label_after) AS changed FROM c"""

ORACLES["confidence_stats"] = _SVM + """
, c AS (SELECT 1.0 / (1.0 + exp(-abs(s))) AS confidence FROM m)
SELECT count(confidence) AS n, round(avg(confidence), 6) AS mean, round(median(confidence), 6) AS median,
       round(stddev_samp(confidence), 6) AS std, count(*) FILTER (WHERE confidence > 0.8) AS n_high FROM c"""


# --- the numeric half of NB in wide form (no unpivot) -----------------------------------
def _nb_base_wide() -> str:
    import re
    feats = list(L.TEXT_QUALITY_FEATURES)
    parts = _nb_base(True)
    names = [re.match(r"\s*(\w+)\s+AS", p.strip()).group(1) for p in parts]
    drop = {"tqm", "fl", "scaler", "scaled", "gauss", "num"}
    keep = [p for p, n in zip(parts, names) if n not in drop]
    # the quality measures read the documents view itself: DuckDB is slow
    # when these lambdas capture a column of a derived table
    keep = [tq_ctes("documents", "text", "doc_id AS review_id") if n == "tq_base" else p
            for p, n in zip(keep, [n for n in names if n not in drop])]
    cast = ", ".join(f"CAST(t.{c} AS DOUBLE) AS {c}" for c in feats)
    sc = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL "
                   f"THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in feats)
    zc = ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in feats)
    gc = ", ".join(f"avg({c}) AS mean_{c}, var_pop({c}) + 1e-9 AS var_{c}" for c in feats)
    terms = " + ".join(f"(-0.5 * ln(2 * pi() * g.var_{c}) - 0.5 * (z.{c} - g.mean_{c}) * "
                       f"(z.{c} - g.mean_{c}) / g.var_{c})" for c in feats)
    wide = [
        f"feat AS (SELECT t.review_id, s.y, s.set, {cast} FROM tq t JOIN sets s ON s.review_id = t.review_id)",
        f"scw AS (SELECT {sc} FROM feat WHERE set = 'train')",
        f"z AS (SELECT review_id, y, set, {zc} FROM feat, scw)",
        f"gw AS (SELECT y, {gc} FROM z WHERE set = 'train' GROUP BY y)",
        f"num AS (SELECT z.review_id, g.y AS cls, ln(p.prior + 1e-12) + {terms} AS score "
        f"FROM z CROSS JOIN gw g JOIN priors p ON p.y = g.y)",
    ]
    # the wide numeric CTEs go right after `priors` (they use it)
    i = [re.match(r"\s*(\w+)\s+AS", p.strip()).group(1) for p in keep].index("priors") + 1
    return with_ctes(*(keep[:i] + wide + keep[i:]))


NB_WIDE = _nb_base_wide()
_FEATS = list(L.TEXT_QUALITY_FEATURES)
NB_WIDE_ORACLES = {
    "scaler_fit": NB_WIDE + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(m_{c}, 6) AS mean, round(s_{c}, 6) AS scale FROM scw" for c in _FEATS),
    "nb_gaussian_fit": NB_WIDE + " UNION ALL ".join(
        f"SELECT g.y, p.n, round(p.prior, 6) AS prior, '{c}' AS feature, round(g.mean_{c}, 6) AS mean, "
        f"round(g.var_{c}, 6) AS var FROM gw g JOIN priors p ON p.y = g.y" for c in _FEATS),
    "nb_predict": NB_WIDE + """
SELECT review_id, set, y, y_pred, round(prob_fake, 6) AS prob_fake, round(prob_real, 6) AS prob_real FROM pred""",
}

ORACLES.update(NB_WIDE_ORACLES)
for _n in ("nb_metrics", "confusion_matrix", "classification_report"):
    ORACLES[_n] = NB_WIDE + _NB_LONG[_n][len(NB_BASE):]

ORACLES["shuffle_positions"] = GIVEN + f"""
SELECT review_id, label, row_number() OVER (ORDER BY {h('shuffle', 'review_id')}, review_id) AS position FROM base"""
