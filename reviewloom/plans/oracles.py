"""The catalog's queries in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from reviewloom import vocab
from reviewloom.plans.catalog import (
    BRANCHES,
    FIRST_MONTH,
    LAST_MONTH,
    PROBE_LEXICON,
    PROBE_STOPWORDS,
    RISK,
    SEARCHES,
    TERMS,
)

WORD = r"[\p{L}\p{N}_'']+"
# White space as the text cleaning sees it; RE2's \s is ASCII and lacks the vertical tab.
SPACE = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)


def _in(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(words)) + ")"


def _cleaned(text: str) -> str:
    return (
        f"nullif(regexp_replace(trim(regexp_replace(regexp_replace({text}, '<[^>]+>', ' ', 'g'), "
        f"'{SPACE}', ' ', 'g')), ' +([,.;:!?])', '\\1', 'g'), '')"
    )


def _entities(text: str) -> str:
    # The entities that occur in the pages; the ampersand last, so nothing is decoded twice.
    for name, value in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{value}')"
    return text


def _round(value: str, digits: int) -> str:
    """Half-up rounding of a double's shortest decimal form, as Spark rounds."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def _mean_score(score: str, digits: int) -> str:
    """Average of scores with six decimals over exact integer sums."""
    total = f"CAST(sum(CAST(round({score} * 1000000) AS BIGINT)) AS DOUBLE)"
    return _round(f"({total} / (count({score}) * 1000000))", digits)


def _tokens(text: str) -> str:
    return f"coalesce(regexp_extract_all(lower({text}), '{WORD}'), [])"


def _reviews(level: str = "nation") -> str:
    place = "n.n_name" if level == "nation" else "r.r_name"
    region = "" if level == "nation" else "JOIN region r ON n.n_regionkey = r.r_regionkey"
    return f"""reviews AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS review_id, o.o_orderkey AS n,
         replace(lower({place}), ' ', '_') AS branch_id, {place} AS branch_name,
         o.o_orderdate AS review_date, strftime(o.o_orderdate, '%Y-%m') AS month,
         TRY_CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) AS rating,
         d.text AS review_text, d.lang AS language, d.source AS raw_source_file,
         {_cleaned("d.text")} AS cleaned_text
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey {region}
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey)"""


def _nlp(level: str = "nation") -> str:
    hits = ", ".join(
        f"len(list_intersect(list_distinct(tokens), {sorted(words)!r})) AS hit_{i}"
        for i, words in enumerate(PROBE_LEXICON.aspects.values())
    )
    count = " + ".join(f"CAST(hit_{i} > 0 AS INT)" for i in range(len(PROBE_LEXICON.aspects)))
    return f"""{_reviews(level)},
tokenized AS (SELECT *, {_tokens("cleaned_text")} AS tokens FROM reviews),
counted AS (SELECT *, len(tokens) AS n_tokens,
    len(list_filter(tokens, lambda t: t IN {_in(PROBE_LEXICON.positive)})) AS pos,
    len(list_filter(tokens, lambda t: t IN {_in(PROBE_LEXICON.negative)})) AS neg, {hits}
  FROM tokenized),
scored AS (SELECT *, CAST(pos - neg AS DOUBLE) / greatest(n_tokens, 1) AS raw_score FROM counted),
nlp AS (SELECT *, {_round("raw_score", 6)} AS sentiment_score, {count} AS aspect_count,
    CASE WHEN pos = 0 AND neg = 0 THEN 'Neutral' WHEN raw_score >= 0.05 THEN 'Positive'
         WHEN raw_score <= -0.05 THEN 'Negative' ELSE 'Neutral' END AS sentiment_label
  FROM scored)"""


def _aspects(level: str = "nation") -> str:
    parts = " UNION ALL ".join(
        f"SELECT review_id, branch_id, review_date, month, '{name}' AS aspect, "
        f"array_to_string(list_sort(list_intersect(list_distinct(tokens), {sorted(words)!r})), ',') "
        f"AS matched_terms, sentiment_label AS aspect_sentiment_label, "
        f"sentiment_score AS aspect_sentiment_score FROM nlp WHERE hit_{i} > 0"
        for i, (name, words) in enumerate(PROBE_LEXICON.aspects.items())
    )
    return f"{_nlp(level)}, aspects AS ({parts})"


def _grid(source: str, metrics: str) -> str:
    return f"""calendar AS (SELECT strftime(m, '%Y-%m') AS month FROM (
    SELECT unnest(generate_series(date_trunc('month', min(review_date)),
      date_trunc('month', max(review_date)), INTERVAL 1 MONTH)) AS m FROM {source})),
branch_names AS (SELECT branch_id, min_by(branch_name, review_id) AS branch_name
  FROM {source} GROUP BY branch_id),
cells AS (SELECT branch_id, month, count(*) AS n, {metrics} FROM {source} GROUP BY branch_id, month),
grid AS (SELECT b.branch_id, b.branch_name, k.month, c.* EXCLUDE (branch_id, month)
  FROM branch_names b CROSS JOIN calendar k
  LEFT JOIN cells c ON c.branch_id = b.branch_id AND c.month = k.month)"""


_MONTHLY_METRICS = f"{_round('avg(rating)', 4)} AS average_rating, count(cleaned_text) AS texts"
_MONTHLY_COLUMNS = """month, branch_id, branch_name, coalesce(n, 0) AS review_count, average_rating,
  coalesce(texts, 0) AS text_available_count, n IS NULL AS is_zero_volume, n IS NOT NULL AS is_observed"""
_FEATURE_METRICS = f"""{_round("avg(rating)", 4)} AS average_rating,
  {_mean_score("sentiment_score", 6)} AS average_sentiment_score,
  {_round("(count(*) FILTER (sentiment_label = 'Negative') / count(*))", 4)} AS negative_ratio"""
_FEATURE_COLUMNS = """branch_id, branch_name, month, coalesce(n, 0) AS review_count, average_rating,
  average_sentiment_score, negative_ratio, n IS NULL AS is_zero_volume, n IS NOT NULL AS is_observed"""


def _monthly(level: str = "nation") -> str:
    return f"{_reviews(level)}, {_grid('reviews', _MONTHLY_METRICS)}, monthly AS (SELECT {_MONTHLY_COLUMNS} FROM grid)"


def _features(level: str = "nation", base: str | None = None) -> str:
    return (
        f"{base or _nlp(level)}, {_grid('nlp', _FEATURE_METRICS)}, "
        f"features AS (SELECT {_FEATURE_COLUMNS} FROM grid)"
    )


def _alerts(base: str | None = None) -> str:
    return f"""{_features(base=base)},
eligible AS (SELECT *, lag(average_rating) OVER w AS p_rating, lag(negative_ratio) OVER w AS p_ratio,
    lag(review_count) OVER w AS p_count
  FROM features WHERE review_count >= 5 AND average_rating IS NOT NULL
    AND average_sentiment_score IS NOT NULL AND negative_ratio IS NOT NULL
  WINDOW w AS (PARTITION BY branch_id ORDER BY month)),
reasoned AS (SELECT *, list_filter([
    CASE WHEN average_rating <= p_rating - 0.5 THEN 'rating_drop_vs_previous_month' END,
    CASE WHEN negative_ratio >= p_ratio + 0.2 THEN 'negative_ratio_rise_vs_previous_month' END,
    CASE WHEN review_count / p_count >= 2.0 OR review_count / p_count <= 0.5
      THEN 'review_volume_shift_vs_previous_month' END], lambda r: r IS NOT NULL) AS reasons
  FROM eligible),
alerts AS (SELECT *, len(reasons) > 0 AS is_anomaly,
    CASE WHEN len(reasons) > 1 THEN 'high' WHEN len(reasons) > 0 THEN 'medium' ELSE 'low' END AS severity
  FROM reasoned)"""


def _baskets() -> str:
    return f"""{_aspects()},
sets AS (SELECT review_id, list('aspect:' || aspect) AS items FROM aspects GROUP BY review_id),
tx AS (SELECT n.review_id, list_sort(list_concat(coalesce(s.items, []), ['sentiment:' || sentiment_label],
    CASE WHEN rating <= 2 THEN ['rating_low'] WHEN rating = 3 THEN ['rating_mid']
         WHEN rating IS NOT NULL THEN ['rating_high'] ELSE [] END)) AS items
  FROM nlp n LEFT JOIN sets s ON s.review_id = n.review_id),
item_rows AS (SELECT review_id, unnest(items) AS item FROM tx),
total AS (SELECT count(*) AS t FROM tx),
sets_all AS (
  SELECT [item] AS itemset, count(*) AS occurrences FROM item_rows GROUP BY item
  UNION ALL SELECT [a.item, b.item], count(*) FROM item_rows a JOIN item_rows b
    ON a.review_id = b.review_id AND a.item < b.item GROUP BY a.item, b.item
  UNION ALL SELECT [a.item, b.item, c.item], count(*) FROM item_rows a JOIN item_rows b
    ON a.review_id = b.review_id AND a.item < b.item JOIN item_rows c
    ON a.review_id = c.review_id AND b.item < c.item GROUP BY a.item, b.item, c.item),
frequent AS (SELECT itemset, occurrences, occurrences / t AS support FROM sets_all, total
  WHERE occurrences / t >= 0.01)"""


def _word_itemsets(support: float, longest: int) -> str:
    """Sets of frequent words, each length joined from the one before."""
    parts = [
        f"""WITH d AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS w FROM documents),
total AS (SELECT count(DISTINCT doc_id) AS t FROM d),
f1 AS (SELECT [w] AS s, count(*) AS n FROM d GROUP BY w HAVING count(*) / (SELECT t FROM total) >= {support}),
kept AS (SELECT doc_id, w FROM d WHERE [w] IN (SELECT s FROM f1)),
r1 AS (SELECT doc_id, [w] AS s FROM kept)"""
    ]
    for k in range(2, longest + 1):
        parts.append(f"""r{k} AS (SELECT r.doc_id, list_append(r.s, k.w) AS s FROM r{k - 1} r JOIN kept k ON r.doc_id = k.doc_id AND k.w > r.s[{k - 1}]
  WHERE r.s IN (SELECT s FROM f{k - 1})),
f{k} AS (SELECT s, count(*) AS n FROM r{k} GROUP BY s HAVING count(*) / (SELECT t FROM total) >= {support})""")
    every = " UNION ALL ".join(f"SELECT * FROM f{k}" for k in range(1, longest + 1))
    return ",\n".join(parts) + f"\nSELECT array_to_string(s, '|') AS itemset, n AS occurrences, round(n / t, 6) AS support FROM ({every}), total"


def _rules() -> str:
    return f"""{_baskets()},
sides AS (SELECT f.support, a.itemset AS antecedent, c.itemset AS consequent,
    f.support / a.support AS conf, c.support AS c_support
  FROM frequent f JOIN frequent a ON len(a.itemset) < len(f.itemset)
      AND list_has_all(f.itemset, a.itemset)
    JOIN frequent c ON len(c.itemset) = len(f.itemset) - len(a.itemset)
      AND list_has_all(f.itemset, c.itemset) AND NOT list_has_any(a.itemset, c.itemset)),
rules AS (SELECT antecedent, consequent, round(support, 6) AS support, round(conf, 6) AS confidence,
    round(conf / c_support, 6) AS lift FROM sides WHERE conf >= 0.3)"""


def _trend(level: str, base: str | None = None) -> str:
    return f"""{_features(level, base)},
series AS (SELECT branch_id, month, average_rating AS y,
    row_number() OVER (PARTITION BY branch_id ORDER BY month) - 1 AS x,
    count(*) OVER (PARTITION BY branch_id) AS n
  FROM features WHERE average_rating IS NOT NULL),
fits AS (SELECT branch_id, max(n) AS n, max(month) AS last_month, regr_slope(y, x) AS b,
    regr_intercept(y, x) AS a,
    regr_slope(y, x) FILTER (x < n - {RISK.holdout}) AS tb,
    regr_intercept(y, x) FILTER (x < n - {RISK.holdout}) AS ta,
    max_by(y, x) FILTER (x < n - {RISK.holdout}) AS naive
  FROM series WHERE n >= {RISK.min_history} GROUP BY branch_id),
spread AS (SELECT s.branch_id, sqrt(sum((y - (a + b * x)) ** 2) / greatest(max(f.n) - 2, 1)) AS sd
  FROM series s JOIN fits f USING (branch_id) GROUP BY s.branch_id),
held AS (SELECT s.branch_id, avg(abs(y - (ta + tb * x))) AS mae, sqrt(avg((y - (ta + tb * x)) ** 2)) AS rmse,
    avg(abs(y - (ta + tb * x)) / abs(y)) AS mape, avg(abs(y - naive)) AS naive_mae
  FROM series s JOIN fits f USING (branch_id) WHERE x >= f.n - {RISK.holdout} GROUP BY s.branch_id),
risks AS (SELECT *, round(b, 6) AS trend_slope_per_month, CASE WHEN b <= {RISK.elevated_slope} THEN 'elevated'
    WHEN b <= {RISK.watch_slope} THEN 'watch' ELSE 'stable' END AS risk_level FROM fits),
steps AS (SELECT r.branch_id, risk_level, trend_slope_per_month, h.step AS step_ahead,
    strftime(strptime(last_month, '%Y-%m') + to_months(CAST(h.step AS INT)), '%Y-%m') AS month,
    a + b * (n + h.step - 1) AS v, 1.96 * sd AS m
  FROM risks r JOIN spread s ON r.branch_id = s.branch_id,
    (SELECT unnest(range(1, {RISK.horizon} + 1)) AS step) h),
ahead AS (SELECT branch_id, risk_level, trend_slope_per_month, step_ahead, month,
    round(least(5.0, greatest(1.0, v)), 4) AS predicted_average_rating,
    round(least(5.0, greatest(1.0, v - m)), 4) AS lower_bound,
    round(least(5.0, greatest(1.0, v + m)), 4) AS upper_bound FROM steps)"""


def _title(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({text}), '\\p{{L}}+|\\P{{L}}+'), "
        f"lambda w: upper(w[1]) || w[2:]), '')"
    )


def _actions(issue: str) -> str:
    cases = " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in vocab.CRM_ACTIONS.items()
    )
    return (
        f"CASE {issue} {cases} ELSE 'Investigate recurring ' || {issue} || "
        f"' feedback and assign a branch owner.' END"
    )


def _cases(alerts: bool, min_mentions: int) -> str:
    base = _alerts(_aspects()) if alerts else _aspects()
    counts = (
        "SELECT branch_id, count(*) AS alerts, count(*) FILTER (severity = 'high') AS highs "
        "FROM alerts WHERE is_anomaly GROUP BY branch_id"
        if alerts
        else "SELECT '' AS branch_id, 0 AS alerts, 0 AS highs"
    )
    return f"""{base}, branch_alerts AS ({counts}),
issues AS (SELECT branch_id, aspect AS issue, count(*) AS mention_count,
    CAST(sum(CAST(round(aspect_sentiment_score * 1000000) AS BIGINT)) AS DOUBLE) / (count(*) * 1000000) AS mean
  FROM aspects GROUP BY branch_id, aspect HAVING count(*) >= {min_mentions}),
weighed AS (SELECT i.*, coalesce(alerts, 0) AS alerts,
    mention_count * greatest(0.0, -mean) + 2 * coalesce(alerts, 0) + 3 * coalesce(highs, 0) AS score
  FROM issues i LEFT JOIN branch_alerts b ON b.branch_id = i.branch_id),
cases AS (SELECT branch_id || ':' || issue AS case_id, branch_id, issue,
    CASE WHEN score >= 10 THEN 'high' WHEN score >= 4 THEN 'medium' ELSE 'low' END AS priority,
    round(score, 4) AS priority_score, mention_count, round(mean, 4) AS average_sentiment_score,
    CAST(alerts AS BIGINT) AS supporting_alert_count, {_actions("issue")} AS recommended_action,
    '{vocab.CRM_OWNER}' AS suggested_owner, 'open' AS status, 'derived' AS evidence_type,
    '{vocab.CRM_REVIEW_CYCLE}' AS review_cycle FROM weighed)"""


_SUFFIX = """CASE (conv_id * 3 + turn) % 8
  WHEN 0 THEN ' What should we improve at Nation_' || (conv_id + turn) % 25 || '?'
  WHEN 1 THEN ' Nation ' || (conv_id + turn) % 25 || ' in July 1997, no, in May  2000?'
  WHEN 2 THEN ' Compare them in 2001-3'
  WHEN 3 THEN ' trend 2000/11, 199705 or 200012'
  WHEN 4 THEN ' NATION_' || (conv_id + turn) % 25 || ' against nation_3' ELSE '' END"""


def _routed() -> str:
    def any_of(cues):
        return " OR ".join(f"contains(lower(question), '{cue}')" for cue in cues)

    numeric = r"'\b(20[0-9]{2})[-/]?(0?[1-9]|1[0-2])\b'"
    named_months = ", ".join(
        f"nullif(regexp_extract(lower(question), '\\b{name}\\s+(20[0-9]{{2}})\\b', 1), '') || '-{i:02d}'"
        for i, name in enumerate(vocab.MONTH_NAMES, start=1)
    )
    return f"""q AS (SELECT conv_id || '-' || turn AS question_id, text || {_SUFFIX} AS question
  FROM conversations WHERE role = 'user'),
known AS (SELECT lower(n_name) AS branch_id, n_name AS branch_name FROM nation),
named AS (SELECT question_id, list_sort(list(branch_id)) AS named FROM q JOIN known
    ON contains(lower(question), lower(branch_name)) OR contains(lower(question), replace(branch_id, '_', ' '))
  GROUP BY question_id),
scoped AS (SELECT q.question_id, question, CASE WHEN len(coalesce(named, [])) > 1
    OR {any_of(vocab.COMPARISON_CUES)} THEN (SELECT list_sort(list(branch_id)) FROM known)
    ELSE coalesce(named, []) END AS branch_ids
  FROM q LEFT JOIN named ON named.question_id = q.question_id),
routed AS (SELECT question_id, question, branch_ids,
    CASE WHEN len(branch_ids) = 1 THEN branch_ids[1] END AS branch_id,
    CASE WHEN len(branch_ids) > 1 THEN 'comparison' WHEN len(branch_ids) = 1 THEN 'branch' ELSE 'brand' END
      AS scope,
    coalesce(CASE WHEN regexp_matches(question, {numeric}) THEN regexp_extract(question, {numeric}, 1) || '-' ||
      lpad(regexp_extract(question, {numeric}, 2), 2, '0') END, {named_months}) AS period,
    {any_of(vocab.RECOMMENDATION_CUES)} AS wants_recommendations FROM scoped)"""


_DATE = "strftime(review_date, '%Y-%m-%d %H:%M:%S') AS review_date"
_SCOPE = f"month BETWEEN '{FIRST_MONTH}' AND '{LAST_MONTH}'"


def _words(condition: str) -> str:
    return f"""WITH {_reviews()},
words AS (SELECT unnest({_tokens("review_text")}) AS word FROM reviews WHERE {condition})
SELECT word, count(*) AS count FROM words WHERE word NOT IN {_in(PROBE_STOPWORDS)}
GROUP BY word ORDER BY count DESC, word LIMIT 80"""


def _text_columns(source: str) -> str:
    return f"""SELECT review_id, cleaned_text, cleaned_text IS NOT NULL AS text_available,
  coalesce(length(cleaned_text), 0) AS text_length_chars,
  CASE WHEN cleaned_text IS NULL THEN 0 ELSE len(string_split(cleaned_text, ' ')) END AS text_word_count,
  CASE WHEN cleaned_text IS NULL THEN 'missing_text' ELSE 'available' END AS preprocessing_status
FROM {source}"""


def all_oracles() -> dict[str, str]:
    """SQL by query name."""
    sql: dict[str, str] = {}
    sql["normalize_records"] = f"""WITH {_reviews()}
SELECT CASE WHEN n % 7 <> 0 THEN review_id ELSE 'generated-' || substr(sha256(branch_id || '|' ||
    CASE WHEN n % 2 = 0 THEN 'None' ELSE review_id END || '|' ||
    CASE WHEN n % 2 = 0 THEN '{{"id":"' || review_id || '","name":"A"}}' ELSE 'None' END || '|' ||
    coalesce(review_text, 'None') || '|' ||
    CASE WHEN n % 2 = 0 THEN 'None' WHEN n % 5 <> 0 THEN strftime(review_date, '%Y-%m-%dT%H:%M:%SZ')
         ELSE '2 days ago' END || '|' ||
    CASE WHEN n % 2 = 0 THEN strftime(review_date, '%Y-%m-%dT%H:%M:%SZ') ELSE 'None' END), 1, 24)
  END AS review_id, branch_id, branch_name AS place_name_raw,
  CASE WHEN n % 2 = 0 OR n % 5 <> 0 THEN strftime(review_date, '%Y-%m-%d %H:%M:%S') END AS review_date,
  rating, review_text, language, review_id AS reviewer_id,
  CASE WHEN n % 2 = 0 THEN 'A' END AS reviewer_name, n % 7 = 0 AS review_id_is_generated
FROM reviews"""
    sql["array_exports"] = """SELECT CAST(doc_id AS VARCHAR) AS review_id, 'corpus' AS brand_id, 'web' AS branch_id, 'Web' AS branch_name,
  upper(source) AS place_name_raw, 'google_maps' AS source, CAST(doc_id % 5 + 1 AS DOUBLE) AS rating, text AS review_text, lang AS language,
  CASE WHEN doc_id % 3 = 0 THEN 'Thanks, "we" {care}, \\o/ ' || source END AS owner_response_text,
  CASE WHEN doc_id % 3 = 0 THEN '2026-08-11 00:00:00' END AS owner_response_date,
  'https://example.org/' || doc_id AS review_url, CAST(doc_id AS VARCHAR) AS reviewer_id, lang AS reviewer_name,
  false AS review_id_is_generated FROM documents"""
    sql["count_by_source_file"] = f"""WITH {_reviews()}
SELECT coalesce(raw_source_file, '<missing>') AS raw_source_file, count(*) AS record_count
FROM reviews GROUP BY 1"""
    sql["validation_report"] = """WITH r AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id, l_returnflag AS branch,
    CASE WHEN l_quantity > 3 THEN l_quantity / 8 END AS rating,
    CASE WHEN l_linestatus = 'O' THEN l_shipdate END AS d, l_linenumber AS ln FROM lineitem),
dup AS (SELECT id, count(*) AS n FROM r GROUP BY id HAVING count(*) > 1),
t AS (SELECT count(*) AS total_records, count(*) FILTER (ln <> 1) AS missing_review_text,
    count(*) FILTER (rating IS NULL) AS missing_rating, count(*) FILTER (d IS NULL) AS missing_review_date,
    count(*) FILTER (rating < 1 OR rating > 5) AS invalid_rating,
    (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM dup) AS duplicate_review_id_count,
    (SELECT string_agg(id, ',' ORDER BY id) FROM (SELECT id FROM dup ORDER BY id LIMIT 10))
      AS duplicate_review_id_samples,
    count(*) FILTER (ln > 5) AS generated_review_ids,
    (SELECT string_agg(branch || '=' || n, ',' ORDER BY branch)
      FROM (SELECT branch, count(*) AS n FROM r GROUP BY branch)) AS records_by_branch,
    strftime(min(d), '%Y-%m-%d %H:%M:%S') AS date_range_start,
    strftime(max(d), '%Y-%m-%d %H:%M:%S') AS date_range_end FROM r)
SELECT *, missing_review_text || ' records have missing review text.' AS warnings,
  invalid_rating || ' records have ratings outside the valid range. ' ||
  duplicate_review_id_count || ' duplicate review IDs detected.' AS errors FROM t"""
    sql["preprocess_reviews"] = f"WITH {_reviews()} {_text_columns('reviews')}"
    sql["preprocess_pages"] = f"""WITH cleaned AS (
  SELECT CAST(page_id AS VARCHAR) AS review_id, {_cleaned(_entities("html"))} AS cleaned_text FROM pages)
{_text_columns("cleaned")}"""
    sql["tokenize_documents"] = f"""WITH t AS (
  SELECT CAST(doc_id AS VARCHAR) AS review_id, {_tokens(_cleaned("text"))} AS tokens FROM documents)
SELECT review_id, len(tokens) AS token_count, md5(array_to_string(tokens, ' ')) AS tokens_md5 FROM t"""
    sql["sentiment_reviews"] = f"""WITH {_nlp()}
SELECT review_id, branch_id, sentiment_label, sentiment_score, pos AS sentiment_positive_hits,
  neg AS sentiment_negative_hits, '{vocab.SENTIMENT_METHOD}' AS sentiment_method,
  'derived_unvalidated' AS sentiment_status, aspect_count FROM nlp"""
    sql["review_aspects"] = f"""WITH {_aspects()}
SELECT review_id, branch_id, {_DATE}, aspect, matched_terms, aspect_sentiment_label, aspect_sentiment_score,
  '{vocab.ASPECT_METHOD}' AS aspect_method, 'derived_unvalidated' AS aspect_status FROM aspects"""
    sql["topic_candidates"] = f"""WITH t AS (
  SELECT unnest({_tokens(_cleaned("text"))}) AS term FROM documents),
c AS (SELECT term, count(*) AS n FROM t WHERE length(term) >= 3 AND term NOT IN {_in(PROBE_STOPWORDS)}
  GROUP BY term ORDER BY n DESC, term LIMIT 30)
SELECT row_number() OVER (ORDER BY n DESC, term) AS topic_candidate_id, term, n AS document_term_count,
  '{vocab.CANDIDATE_METHOD}' AS topic_method, 'candidate_requires_review' AS topic_status FROM c"""
    sql["dataset_summary"] = f"""WITH {_reviews()}
SELECT count(*) AS record_count, count(DISTINCT branch_id) AS branch_count,
  strftime(min(review_date), '%Y-%m-%d %H:%M:%S') AS date_range_start,
  strftime(max(review_date), '%Y-%m-%d %H:%M:%S') AS date_range_end,
  {_round("avg(rating)", 4)} AS average_rating,
  (SELECT string_agg(rating || '=' || n, ',' ORDER BY rating)
    FROM (SELECT rating, count(*) AS n FROM reviews GROUP BY rating)) AS rating_distribution,
  count(cleaned_text) AS text_available_count, count(*) - count(cleaned_text) AS text_missing_count,
  round(avg(length(cleaned_text)), 2) AS average_text_length_chars FROM reviews"""
    sql["branch_summary"] = f"""WITH {_reviews()}
SELECT branch_id, min_by(branch_name, review_id) AS branch_name, count(*) AS review_count,
  {_round("avg(rating)", 4)} AS average_rating, count(cleaned_text) AS text_available_count,
  count(*) - count(cleaned_text) AS text_missing_count FROM reviews GROUP BY branch_id"""
    sql["monthly_summary"] = f"WITH {_monthly()} SELECT * FROM monthly"
    sql["monthly_summary_by_region"] = f"WITH {_monthly('region')} SELECT * FROM monthly"
    sql["monthly_features"] = f"WITH {_features()} SELECT * FROM features"
    sql["distinct_branches"] = f"WITH {_reviews()} SELECT DISTINCT branch_id FROM reviews"
    sql["distinct_months"] = f"WITH {_reviews()} SELECT DISTINCT month FROM reviews"
    sql["scope_kpis"] = f"""WITH {_reviews()}
SELECT count(*) FILTER (rating <= 2) AS negative_reviews, count(*) FILTER (rating >= 4) AS positive_reviews,
  coalesce(round(100.0 * count(*) FILTER (rating <= 2) / nullif(count(*), 0), 4), 0.0) AS negative_ratio_pct,
  count(*) AS reviews_in_scope
FROM reviews WHERE branch_id IN {_in(BRANCHES)} AND {_SCOPE}"""
    low, mid, high = vocab.DASHBOARD_BUCKETS
    sql["rating_buckets"] = f"""WITH {_reviews()}, b AS (
  SELECT branch_id, CASE WHEN rating BETWEEN 0 AND 2 THEN '{low}' WHEN rating > 2 AND rating <= 3 THEN '{mid}'
    WHEN rating > 3 AND rating <= 5 THEN '{high}' END AS rating_bucket FROM reviews)
SELECT branch_id, rating_bucket, count(*) AS count FROM b WHERE rating_bucket IS NOT NULL GROUP BY ALL"""
    sql["sentiment_distribution"] = (
        f"WITH {_nlp()} SELECT sentiment_label, count(*) AS count FROM nlp GROUP BY 1"
    )
    sql["sentiment_by_branch"] = f"""WITH {_nlp()}
SELECT branch_id, {_mean_score("sentiment_score", 6)} AS sentiment_score FROM nlp GROUP BY 1"""
    mentions = f"count(*) AS mention_count, {_mean_score('aspect_sentiment_score', 4)} AS average_sentiment_score"
    sql["aspect_sentiment"] = f"WITH {_aspects()} SELECT branch_id, aspect, {mentions} FROM aspects GROUP BY 1, 2"
    sql["aspect_volume"] = f"""WITH {_aspects()}
SELECT branch_id, aspect, {mentions} FROM aspects GROUP BY 1, 2
UNION ALL SELECT 'All', aspect, {mentions} FROM aspects GROUP BY 2"""
    sql["aspect_complaints"] = f"""WITH {_aspects("region")}, c AS (
  SELECT aspect, count(*) FILTER (aspect_sentiment_label = 'Negative') AS negative_mentions,
    count(*) FILTER (aspect_sentiment_label = 'Positive') AS positive_mentions, count(*) AS total_mentions
  FROM aspects WHERE branch_id IN ('africa', 'asia', 'middle_east') AND {_SCOPE} GROUP BY aspect)
SELECT *, round(100.0 * negative_mentions / total_mentions, 1) AS negative_share_pct FROM c"""
    sql["aspect_totals"] = f"WITH {_aspects()} SELECT aspect, count(*) AS mention_count FROM aspects GROUP BY 1"
    sql["negative_word_frequencies"] = _words("rating <= 2")
    sql["positive_word_frequencies"] = _words("rating >= 4")
    sql["recent_negative_reviews"] = f"""WITH {_reviews()}, top AS (
  SELECT * FROM reviews WHERE rating <= 2 ORDER BY reviews.review_date DESC, review_id LIMIT 200)
SELECT review_id, branch_id, {_DATE}, rating, review_text FROM top"""
    sql["review_examples"] = f"""WITH {_reviews()}
SELECT review_id, branch_name, rating, review_text FROM reviews ORDER BY review_id LIMIT 200"""
    sql["transactions"] = f"WITH {_baskets()} SELECT review_id, array_to_string(items, '|') AS items FROM tx"
    sql["distinct_baskets"] = (
        f"WITH {_baskets()} SELECT array_to_string(items, '|') AS items, count(*) AS n FROM tx GROUP BY 1"
    )
    sql["frequent_itemsets"] = f"""WITH {_baskets()}
SELECT array_to_string(itemset, '|') AS itemset, occurrences, round(support, 6) AS support FROM frequent"""
    sql["word_itemsets"] = _word_itemsets(0.45, 5)
    sql["association_rules"] = f"""WITH {_rules()}
SELECT array_to_string(antecedent, '|') AS antecedent, array_to_string(consequent, '|') AS consequent,
  support, confidence, lift FROM rules"""
    item = f"""CASE WHEN i LIKE 'aspect:%' THEN 'Experience: ' || {_title("replace(i[8:], '_', ' ')")}
    WHEN i LIKE 'sentiment:%' THEN 'Customer mood: ' || i[11:]
    WHEN i = 'rating_low' THEN 'Low rating (1-2)' WHEN i = 'rating_mid' THEN 'Neutral rating (3)'
    ELSE 'High rating (4-5)' END"""
    sql["top_rules_labelled"] = f"""WITH {_rules()}, top AS (
  SELECT * FROM rules ORDER BY lift DESC, antecedent, consequent LIMIT 10)
SELECT array_to_string(list_transform(antecedent, lambda i: {item}), ', ') AS when_mentioned,
  array_to_string(list_transform(consequent, lambda i: {item}), ', ') AS also_mentioned,
  support, confidence, lift FROM top"""
    sql["rule_alerts"] = f"""WITH {_alerts()}
SELECT branch_id, month, review_count, average_rating, negative_ratio,
  array_to_string(reasons, ',') AS alert_reasons,
  CASE WHEN len(reasons) > 0 THEN 'medium' ELSE 'low' END AS alert_severity FROM alerts"""
    sql["alert_kpis"] = f"""WITH {_alerts()}
SELECT count(*) FILTER (is_anomaly) AS alert_count, count(*) FILTER (severity = 'high') AS high_alert_count
FROM alerts"""
    sql["alerts_by_severity"] = f"""WITH {_alerts()}
SELECT branch_id, month, severity AS alert_severity, review_count FROM alerts WHERE is_anomaly"""
    sql["rating_quantile"] = f"""WITH {_alerts()}
SELECT count(*) AS eligible_months, round(quantile_cont(average_rating, 0.1), 6) AS cut FROM eligible"""
    sql["branch_forecasts"] = f"""WITH {_trend("region")}
SELECT r.branch_id, n AS months_available, trend_slope_per_month, risk_level, {RISK.holdout} AS holdout_size,
  round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(mape, 6) AS mape, round(naive_mae, 6) AS naive_mae,
  mae < naive_mae AS beats_naive_baseline FROM risks r JOIN held h ON r.branch_id = h.branch_id"""
    sql["branch_forecast_months"] = f"WITH {_trend('nation')} SELECT * FROM ahead"
    sql["forecast_skipped"] = f"""WITH {_features()}
SELECT branch_id, count(*) AS months_available FROM features WHERE average_rating IS NOT NULL
GROUP BY branch_id HAVING count(*) < 80"""
    sql["observed_and_forecast"] = f"""WITH {_trend("region")}
SELECT branch_id, month, 'observed' AS kind, average_rating AS rating, CAST(NULL AS DOUBLE) AS lower_bound,
  CAST(NULL AS DOUBLE) AS upper_bound FROM features WHERE average_rating IS NOT NULL
UNION ALL SELECT branch_id, month, 'forecast', predicted_average_rating, lower_bound, upper_bound FROM ahead"""
    sql["crm_cases"] = f"WITH {_cases(True, 3)} SELECT * FROM cases"
    label = f"""CASE issue WHEN 'food_quality' THEN 'Food Quality' WHEN 'price_value' THEN 'Price and Value'
  WHEN 'service' THEN 'Service' ELSE {_title("replace(issue, '_', ' ')")} END"""
    branch = _title("replace(branch_id, '_', ' ')")
    sql["crm_cases_by_priority"] = f"""WITH {_cases(False, 2)}
SELECT {branch} AS branch, {label} AS "customer issue", priority, mention_count AS mentions,
  recommended_action AS "recommended action" FROM cases"""
    sql["top_issues_per_branch"] = f"""WITH {_cases(False, 3)}, p AS (
  SELECT branch_id, issue, mention_count,
    row_number() OVER (PARTITION BY branch_id ORDER BY mention_count DESC, issue) AS position FROM cases)
SELECT * FROM p WHERE position <= 2"""
    sql["branch_trend"] = f"WITH {_monthly()} SELECT * FROM monthly WHERE branch_id = 'nation_3'"
    sql["search_feedback"] = f"""WITH {_reviews()}, top AS (
  SELECT * FROM reviews WHERE contains(lower(cleaned_text), 'the ') ORDER BY review_id LIMIT 20)
SELECT review_id, branch_id, rating, {_DATE}, substr(cleaned_text, 1, 280) AS cleaned_text FROM top"""
    sql["search_indexed"] = f"""WITH {_reviews()}, asked AS (SELECT unnest({list(SEARCHES)}) AS query), hits AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY review_id) AS place
  FROM reviews JOIN asked ON contains(lower(cleaned_text), lower(query)))
SELECT query, review_id, branch_id, rating, {_DATE}, substr(cleaned_text, 1, 280) AS cleaned_text FROM hits WHERE place <= 20"""
    sql["branch_performance"] = f"""WITH {_monthly()},
asked AS (SELECT unnest(['nation_3', 'nation_1', 'nowhere']) AS branch_id)
SELECT a.branch_id, b.branch_name, '1997-05' AS period, m.month IS NOT NULL AS observed,
  coalesce(m.is_observed, false) AS is_observed, m.review_count, m.average_rating, m.text_available_count
FROM asked a LEFT JOIN branch_names b ON b.branch_id = a.branch_id
LEFT JOIN monthly m ON m.branch_id = a.branch_id AND m.month = '1997-05'"""
    sql["period_rows"] = f"""WITH {_monthly("region")}, asked AS (
  SELECT DISTINCT branch_id, unnest(['1997-05', '2030-01']) AS month FROM branch_names)
SELECT a.branch_id, a.month, coalesce(m.is_observed, false) AS is_observed, m.review_count, m.average_rating
FROM asked a LEFT JOIN monthly m ON m.branch_id = a.branch_id AND m.month = a.month"""
    experience = label.replace("issue", "aspect")
    sql["business_labels"] = f"""WITH {_aspects()}, s AS (
  SELECT branch_id, aspect, {mentions} FROM aspects GROUP BY 1, 2)
SELECT {branch} AS branch, {experience} AS "experience area", mention_count AS mentions,
  average_sentiment_score AS "customer mood indicator" FROM s"""
    sql["coerced_numbers"] = """SELECT event_id,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id AS DOUBLE) END AS number,
  strftime(date_trunc('month', ts) + to_months(CAST(event_id % 30 AS INT)), '%Y-%m') AS month
FROM events"""
    sql["topic_concentration"] = f"""WITH {_nlp()}, t AS (
  SELECT CAST(doc_id AS VARCHAR) AS review_id, lang,
    ascii(lang) * 256 + ascii(substr(lang, 2, 1)) AS topic_id FROM documents),
m AS (SELECT topic_id, max(lang) AS lang, count(*) AS n,
    count(*) FILTER (sentiment_label = 'Negative') AS neg FROM t JOIN nlp USING (review_id) GROUP BY topic_id),
s AS (SELECT topic_id, lang, n / sum(n) OVER () AS overall,
    coalesce(neg / nullif(sum(neg) OVER (), 0), 0.0) AS negative FROM m)
SELECT CAST(topic_id AS BIGINT) AS topic_id, 'Language, ' || upper(lang[1]) || lang[2:] AS theme,
  round(negative / overall, 2) AS negative_lift, round(negative * 100, 1) AS negative_share,
  round(overall * 100, 1) AS overall_share FROM s"""
    sql["route_questions"] = f"""WITH {_routed()}
SELECT question_id, question, array_to_string(branch_ids, ',') AS branch_ids, branch_id, scope, period,
  wants_recommendations FROM routed"""
    sql["question_evidence"] = f"""WITH {_alerts(_rules())}, {_routed()},
asked AS (SELECT question_id, period, unnest(branch_ids) AS branch_id FROM routed),
flagged AS (SELECT branch_id, count(*) AS k FROM alerts WHERE is_anomaly GROUP BY branch_id),
found AS (SELECT question_id, count(*) AS branch_count, count(g.month) AS observed_count,
    sum(coalesce(g.review_count, 0)) AS period_reviews, sum(coalesce(k, 0)) AS alert_months,
    count(*) * (SELECT count(*) FROM calendar) AS trend_months
  FROM asked a JOIN branch_names b ON b.branch_id = a.branch_id
  LEFT JOIN features g ON g.branch_id = a.branch_id AND g.month = a.period
  LEFT JOIN flagged f ON f.branch_id = a.branch_id GROUP BY question_id)
SELECT r.question_id, scope, period, coalesce(branch_count, 0) AS branch_count,
  coalesce(observed_count, 0) AS observed_count, CAST(coalesce(period_reviews, 0) AS BIGINT) AS period_reviews,
  CAST(coalesce(alert_months, 0) AS BIGINT) AS alert_months, coalesce(trend_months, 0) AS trend_months,
  (SELECT count(*) FROM nlp) AS brand_reviews, (SELECT least(10, count(*)) FROM rules) AS rule_count,
  (SELECT least(5, count(DISTINCT lang)) FROM documents) AS topic_count,
  CASE WHEN scope = 'brand' THEN (SELECT count(*) FROM alerts WHERE is_anomaly) END AS brand_alert_count
FROM routed r LEFT JOIN found f ON f.question_id = r.question_id"""
    sql["question_scopes"] = f"""WITH {_routed()}
SELECT question_id, scope, period, count(*) OVER (PARTITION BY branch_ids, period) AS questions,
  array_to_string(branch_ids, ',') AS branch_ids FROM routed"""
    scopes = """scopes AS (SELECT DISTINCT scope, period, unnest(
    CASE WHEN scope = 'comparison' THEN list_append(branch_ids, 'never_opened') ELSE branch_ids END) AS branch_id
  FROM routed)"""
    sql["scope_branches"] = f"""WITH {_alerts(_rules())}, {_routed()}, {scopes},
totals AS (SELECT branch_id, count(*) AS review_count FROM nlp GROUP BY branch_id),
trends AS (SELECT branch_id, string_agg(month || '=' || review_count, ',' ORDER BY month) AS trend
  FROM features GROUP BY branch_id),
flagged AS (SELECT branch_id, string_agg(month || '=' || severity, ',' ORDER BY month) AS alerts
  FROM alerts WHERE is_anomaly GROUP BY branch_id)
SELECT s.scope, s.period, s.branch_id, b.branch_name, g.month IS NOT NULL AS observed, t.review_count,
  CASE WHEN s.period IS NOT NULL THEN coalesce(g.is_observed, false) END AS month_observed,
  g.review_count AS month_reviews, coalesce(trend, '') AS trend, coalesce(alerts, '') AS alerts
FROM scopes s LEFT JOIN branch_names b ON b.branch_id = s.branch_id
LEFT JOIN totals t ON t.branch_id = s.branch_id
LEFT JOIN features g ON g.branch_id = s.branch_id AND g.month = s.period
LEFT JOIN trends r ON r.branch_id = s.branch_id LEFT JOIN flagged f ON f.branch_id = s.branch_id"""
    sql["scope_aspects"] = f"""WITH {_aspects()}, {_routed()}, {scopes},
m AS (SELECT branch_id, aspect, {mentions} FROM aspects GROUP BY 1, 2)
SELECT scope, period, s.branch_id, row_number() OVER (PARTITION BY scope, period, s.branch_id
    ORDER BY mention_count DESC, aspect) - 1 AS place, aspect, mention_count, average_sentiment_score
FROM scopes s JOIN m ON m.branch_id = s.branch_id"""
    sql["alert_severities"] = f"""WITH {_alerts()}, f AS (SELECT branch_id, month, review_count % 3 = 0 AS is_anomaly,
    list_concat(reasons, CASE WHEN review_count % 3 = 0 THEN ['model_outlier'] ELSE [] END) AS found FROM alerts)
SELECT branch_id, month, is_anomaly, array_to_string(found, ',') AS alert_reasons,
  CASE WHEN len(found) >= 2 AND is_anomaly THEN 'high' WHEN len(found) > 0 THEN 'medium' ELSE 'low' END
    AS alert_severity FROM f"""
    sql["most_unusual_months"] = f"""WITH {_alerts()}
SELECT branch_id, month, -(review_count % 5) / 8 AS anomaly_score, review_count FROM alerts
WHERE review_count % 3 = 0 ORDER BY anomaly_score, branch_id, month LIMIT 10"""
    sql["theme_titles"] = """WITH t AS (
  SELECT ascii(lang) * 256 + ascii(substr(lang, 2, 1)) AS topic_id, list_sort(list(DISTINCT source)) AS terms
  FROM documents WHERE lang IS NOT NULL GROUP BY lang)
SELECT topic_id, 'Theme ' || row_number() OVER (ORDER BY topic_id) AS theme_number,
  array_to_string(list_transform(terms[1:3], lambda x: upper(x[1]) || lower(x[2:])), ', ') AS title FROM t"""
    known = f"""words AS (SELECT doc_id, list_filter(coalesce(regexp_extract_all(
    lower({_cleaned("text")}), '[\\p{{L}}\\p{{N}}_]{{2,}}'), []), lambda t: t NOT IN {_in(TERMS.stopwords)}) AS w
  FROM documents WHERE {_cleaned("text")} IS NOT NULL),
grams AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)),
    lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM words),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
size AS (SELECT count(*) AS n FROM words),
known AS (SELECT term, count(*) AS df, ln((1.0 + max(n)) / (1.0 + count(*))) + 1.0 AS idf FROM tf, size
  GROUP BY term HAVING count(*) >= {TERMS.min_df} AND count(*) <= {TERMS.max_df} * max(n))"""
    sql["document_frequencies"] = f"WITH {known} SELECT term, df, round(idf, 6) AS idf FROM known"
    sql["tfidf_weights"] = f"""WITH {known},
weighted AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN known USING (term)),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY doc_id)
SELECT CAST(doc_id AS VARCHAR) AS review_id, term, round(w / norm, 6) AS weight
FROM weighted JOIN norms USING (doc_id)"""
    return sql
