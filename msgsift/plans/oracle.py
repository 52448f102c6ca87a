"""DuckDB oracle SQL for the registered queries.

Each statement runs on the pre-registered views (documents, labels, events, ...)
and must produce the same columns (names, values) as the Spark query with the same
key. Shared building blocks are composed here; fixed patterns come from
``msgsift.functions``.
"""

from __future__ import annotations

from msgsift.functions.labels import LABEL_MAP
from msgsift.functions.text import TOKEN_PATTERN, WHITESPACE_CLASS, WORD_PATTERN

_WS = WHITESPACE_CLASS


def sq(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {sq(f'^[{_WS}]+|[{_WS}]+$')}, '', 'g')"


def label_case(expr: str) -> str:
    key = f"lower({strip(f'CAST({expr} AS VARCHAR)')})"
    whens = " ".join(f"WHEN {sq(k)} THEN {sq(v)}" for k, v in LABEL_MAP.items())
    return f"(CASE {key} {whens} ELSE NULL END)"


def r(expr: str, digits: int) -> str:
    scale = f"{10**digits}.0"
    return f"(floor(({expr}) * {scale} + 0.5) / {scale})"


def pct(num: str, den: str, digits: int = 4) -> str:
    return f"(CASE WHEN ({den}) = 0 THEN 0.0 ELSE {r(f'(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)) * 100.0', digits)} END)"


def r9(expr: str) -> str:
    return r(expr, 9)


def tokens_expr(text: str) -> str:
    norm = "lower(" + strip(f"coalesce({text}, '')") + ")"
    raw = f"regexp_extract_all({norm}, {sq(TOKEN_PATTERN)})"
    return f"list_filter({raw}, lambda x: length(x) >= 1 AND NOT regexp_full_match(x, '[0-9]+'))"


# -- common CTEs ---------------------------------------------------------------

MSG = f"""msg AS (
  SELECT CAST(d.doc_id AS BIGINT) AS row_id, {label_case('l.toxic')} AS label, {strip('d.text')} AS text
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""

TOK = f"""tok AS (SELECT row_id, label, text, {tokens_expr('text')} AS toks FROM msg)"""

# one row per (row, token) with tf and first position
RUNS = """ex AS (SELECT row_id, label, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM tok),
runs AS (SELECT row_id, label, token, count(*) AS tf, min(pos) AS first_pos FROM ex GROUP BY row_id, label, token)"""

FIRST = "min(row_id * 100000000 + first_pos)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["normalize_label"] = f"""
SELECT CAST(doc_id AS BIGINT) AS row_id, CAST(toxic AS VARCHAR) AS raw_label, {label_case('toxic')} AS label,
       {label_case('quality')} AS quality_label
FROM labels
"""

ORACLES["tokenize"] = f"""
WITH t AS (SELECT doc_id, {tokens_expr(strip('text'))} AS toks FROM documents)
SELECT CAST(doc_id AS BIGINT) AS row_id, CAST(len(toks) AS INTEGER) AS n_tokens,
       CAST(list_count(list_distinct(toks)) AS INTEGER) AS n_distinct,
       coalesce(toks[1], '') AS first_token, coalesce(toks[-1], '') AS last_token,
       md5(array_to_string(toks, ' ')) AS tokens_md5
FROM t
"""

ORACLES["frequent_words"] = _with(MSG, TOK, RUNS, """st AS (
  SELECT token, sum(tf) AS cnt, count(*) AS dc, """ + FIRST + """ AS fs FROM runs GROUP BY token),
tot AS (SELECT sum(cnt) AS tt FROM st), nm AS (SELECT count(*) AS nm FROM msg),
top AS (SELECT *, row_number() OVER (ORDER BY cnt DESC, fs ASC) AS rk FROM st)""") + f"""
SELECT CAST(rk AS INTEGER) AS rank, token, CAST(cnt AS BIGINT) AS count, {pct('cnt', 'tt')} AS percentage,
       CAST(dc AS BIGINT) AS document_count, {pct('dc', 'nm')} AS document_percentage
FROM top, tot, nm WHERE rk <= 50
"""

ORACLES["corpus_stats"] = _with(MSG, TOK) + """
SELECT CAST(count(*) AS BIGINT) AS total_messages,
       CAST(count(*) FILTER (WHERE len(toks) > 0) AS BIGINT) AS messages_with_tokens,
       CAST(coalesce(sum(len(toks)), 0) AS BIGINT) AS total_tokens,
       (SELECT CAST(count(DISTINCT t) AS BIGINT) FROM (SELECT unnest(toks) AS t FROM tok)) AS unique_tokens
FROM tok
"""

ORACLES["label_token_totals"] = _with(MSG, TOK) + """
SELECT label, CAST(count(*) AS BIGINT) AS messages, CAST(coalesce(sum(len(toks)), 0) AS BIGINT) AS tokens
FROM tok GROUP BY label
"""

ORACLES["vocabulary_by_label"] = _with(MSG, TOK, RUNS, """st AS (
  SELECT label, token, sum(tf) AS cnt, count(*) AS dc FROM runs WHERE label IN ('ham', 'spam') GROUP BY label, token),
tot AS (SELECT label, count(*) AS nm, sum(len(toks)) AS nt FROM tok GROUP BY label)""") + f"""
SELECT st.label, token, CAST(cnt AS BIGINT) AS count, {pct('cnt', 'nt')} AS percentage,
       CAST(dc AS BIGINT) AS document_count, {pct('dc', 'nm')} AS document_percentage
FROM st JOIN tot ON st.label = tot.label
"""

_ROLES = f"""msg AS (SELECT CAST(conv_id * 1000000 + turn AS BIGINT) AS row_id, lower({strip('role')}) AS label, {strip('text')} AS text FROM conversations)"""
ORACLES["vocabulary_by_role"] = ORACLES["vocabulary_by_label"].replace(MSG, _ROLES).replace(
    "WHERE label IN ('ham', 'spam')", "WHERE label IN ('system', 'user', 'assistant')")

ORACLES["vocabulary_overlap"] = _with(MSG, TOK, RUNS, """pt AS (
  SELECT token, max(CASE WHEN label = 'ham' THEN 1 ELSE 0 END) AS in_a,
         max(CASE WHEN label = 'spam' THEN 1 ELSE 0 END) AS in_b FROM runs GROUP BY token)""") + """
SELECT CAST(count(*) FILTER (WHERE in_a = 1 OR in_b = 1) AS BIGINT) AS total_vocabulary_size,
       CAST(count(*) FILTER (WHERE in_a = 1 AND in_b = 1) AS BIGINT) AS shared_vocabulary_size,
       CAST(count(*) FILTER (WHERE in_a = 1) AS BIGINT) AS ham_vocabulary_size,
       CAST(count(*) FILTER (WHERE in_b = 1) AS BIGINT) AS spam_vocabulary_size
FROM pt
"""

TERM_SCORES_CTE = f"""pt AS (
  SELECT token, CAST(sum(CASE WHEN label = 'spam' THEN tf ELSE 0 END) AS BIGINT) AS spam_count,
         CAST(sum(CASE WHEN label = 'ham' THEN tf ELSE 0 END) AS BIGINT) AS ham_count
  FROM runs WHERE label IN ('spam', 'ham') GROUP BY token),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS v, CAST(sum(spam_count) AS DOUBLE) AS tp,
               CAST(sum(ham_count) AS DOUBLE) AS tn FROM pt),
sc0 AS (SELECT token, spam_count, ham_count, spam_count + ham_count AS total_count,
               {pct('spam_count', 'tp')} AS spam_percentage, {pct('ham_count', 'tn')} AS ham_percentage,
               (spam_count + 0.5) / (tp + 0.5 * v) AS smoothed_spam_rate,
               (ham_count + 0.5) / (tn + 0.5 * v) AS smoothed_ham_rate
        FROM pt, tot WHERE spam_count + ham_count >= 1),
sc AS (SELECT *, ln(smoothed_spam_rate / smoothed_ham_rate) AS log_rate_ratio_spam_vs_ham,
              -ln(smoothed_spam_rate / smoothed_ham_rate) AS log_rate_ratio_ham_vs_spam FROM sc0)"""

_SCORE_COLS = f"""token, spam_count, ham_count, total_count, spam_percentage, ham_percentage,
       {r9('smoothed_spam_rate')} AS smoothed_spam_rate, {r9('smoothed_ham_rate')} AS smoothed_ham_rate,
       {r9('log_rate_ratio_spam_vs_ham')} AS log_rate_ratio_spam_vs_ham,
       {r9('log_rate_ratio_ham_vs_spam')} AS log_rate_ratio_ham_vs_spam"""

ORACLES["term_scores"] = _with(MSG, TOK, RUNS, TERM_SCORES_CTE) + f"SELECT {_SCORE_COLS} FROM sc\n"

ORACLES["typical_terms_spam"] = _with(MSG, TOK, RUNS, TERM_SCORES_CTE) + f"""
SELECT CAST(rk AS INTEGER) AS rank, {_SCORE_COLS} FROM (
  SELECT *, row_number() OVER (ORDER BY log_rate_ratio_spam_vs_ham DESC, spam_count DESC, token ASC) AS rk FROM sc)
WHERE rk <= 30
"""

ORACLES["typical_terms_ham"] = _with(MSG, TOK, RUNS, TERM_SCORES_CTE) + f"""
SELECT CAST(rk AS INTEGER) AS rank, {_SCORE_COLS} FROM (
  SELECT *, row_number() OVER (ORDER BY log_rate_ratio_ham_vs_spam DESC, ham_count DESC, token ASC) AS rk FROM sc)
WHERE rk <= 30
"""

NGRAMS_CTE = """g AS (
  SELECT row_id, v.n AS n,
         list_transform(range(1, len(toks) - v.n + 2), lambda i: array_to_string(toks[i:i + v.n - 1], ' ')) AS grams
  FROM tok, (VALUES (2), (3)) v(n) WHERE len(toks) >= v.n),
gx AS (SELECT row_id, n, unnest(grams) AS ngram, generate_subscripts(grams, 1) AS pos FROM g),
gr AS (SELECT row_id, n, ngram, count(*) AS tf, min(pos) AS first_pos FROM gx GROUP BY row_id, n, ngram),
gs AS (SELECT n, ngram, sum(tf) AS cnt, count(*) AS dc, min(row_id * 100000000 + first_pos) AS fs
       FROM gr GROUP BY n, ngram),
gt AS (SELECT n, sum(cnt) AS nt FROM gs GROUP BY n),
nm AS (SELECT count(*) AS nm FROM msg)"""

ORACLES["frequent_ngrams"] = _with(MSG, TOK, NGRAMS_CTE) + f"""
SELECT CAST(rk AS INTEGER) AS rank, CAST(n AS INTEGER) AS n, ngram, 'all' AS label, CAST(cnt AS BIGINT) AS count,
       {pct('cnt', 'nt')} AS percentage, CAST(dc AS BIGINT) AS document_count,
       {pct('dc', 'nm')} AS document_percentage
FROM (SELECT gs.*, gt.nt, row_number() OVER (PARTITION BY gs.n ORDER BY cnt DESC, fs ASC) AS rk
      FROM gs JOIN gt ON gs.n = gt.n), nm
WHERE rk <= 30
"""


# -- §2.1 -------------------------------------------------------------------------------

RAW = """raw AS (
  SELECT CAST(d.doc_id AS BIGINT) AS row_id, CAST(l.toxic AS VARCHAR) AS label, d.text AS text
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

LRAW = """raw AS (
  SELECT CAST(d.doc_id AS BIGINT) AS row_id, CAST(l.toxic AS VARCHAR) AS label, d.text AS text
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

FLAGS = f"""fl AS (
  SELECT row_id, label, text,
         (label IS NULL OR {strip('label')} = '') AS missing_label,
         (text IS NULL OR {strip('text')} = '') AS missing_text
  FROM raw),
fl2 AS (SELECT *, ({label_case('label')} IS NULL AND NOT missing_label) AS invalid_label FROM fl)"""

ORACLES["row_quality_flags"] = _with(RAW, FLAGS) + "SELECT row_id, missing_label, missing_text, invalid_label FROM fl2\n"

ORACLES["quality_summary"] = _with(RAW, FLAGS) + f"""
SELECT CAST(count(*) AS BIGINT) AS raw_rows,
       CAST(count(*) FILTER (WHERE missing_label) AS BIGINT) AS missing_label_count,
       CAST(count(*) FILTER (WHERE missing_text) AS BIGINT) AS missing_text_count,
       CAST(count(*) FILTER (WHERE missing_text) AS BIGINT) AS empty_text_count,
       CAST(count(*) FILTER (WHERE invalid_label) AS BIGINT) AS invalid_label_count,
       CAST(count(DISTINCT CASE WHEN invalid_label THEN {strip('label')} END) AS BIGINT) AS distinct_invalid_labels
FROM fl2
"""

ORACLES["normalize_messages"] = _with(LRAW) + f"SELECT row_id, {label_case('label')} AS label, {strip('text')} AS text FROM raw\n"

ORACLES["assign_row_id"] = _with(MSG) + """
SELECT CAST(row_number() OVER (ORDER BY row_id) AS BIGINT) AS row_id, row_id AS doc_id, label FROM msg
"""

ORACLES["duplicate_rows"] = f"""
WITH d AS (SELECT CAST(doc_id AS BIGINT) AS row_id, {strip('text')} AS text FROM documents),
c AS (SELECT text, count(*) AS cnt FROM d GROUP BY text)
SELECT d.row_id, CAST(length(d.text) AS INTEGER) AS n_chars FROM d JOIN c ON d.text = c.text WHERE c.cnt > 1
"""

DUPS = """bt AS (SELECT text, count(*) AS cnt FROM msg GROUP BY text),
bp AS (SELECT label, text, count(*) AS cnt FROM msg GROUP BY label, text)"""

ORACLES["duplicate_stats"] = _with(MSG, DUPS) + """
SELECT CAST(coalesce(sum(cnt) FILTER (WHERE cnt > 1), 0) AS BIGINT) AS duplicate_message_count,
       CAST(count(*) FILTER (WHERE cnt > 1) AS BIGINT) AS duplicate_message_groups,
       (SELECT CAST(coalesce(sum(cnt) FILTER (WHERE cnt > 1), 0) AS BIGINT) FROM bp) AS exact_duplicate_row_count
FROM bt
"""

ORACLES["dedup_keep_first"] = _with(MSG, """k AS (SELECT text, min(row_id) AS rid FROM msg GROUP BY text)""") + """
SELECT CAST(row_number() OVER (ORDER BY m.row_id) AS BIGINT) AS row_id, m.row_id AS source_row_id, m.label,
       CAST(length(m.text) AS INTEGER) AS n_chars
FROM msg m JOIN k ON m.row_id = k.rid
"""

ORACLES["label_counts"] = _with(MSG) + """
SELECT CAST(count(*) FILTER (WHERE label = 'ham') AS BIGINT) AS ham_count,
       CAST(count(*) FILTER (WHERE label = 'spam') AS BIGINT) AS spam_count FROM msg
"""

ORACLES["validation_summary"] = _with(LRAW, FLAGS, MSG, DUPS, """k AS (SELECT text, min(row_id) AS rid FROM msg GROUP BY text),
fin AS (SELECT m.* FROM msg m JOIN k ON m.row_id = k.rid)""") + """
SELECT CAST(count(*) AS BIGINT) AS raw_rows,
       CAST(count(*) FILTER (WHERE missing_label) AS BIGINT) AS missing_label_count,
       CAST(count(*) FILTER (WHERE missing_text) AS BIGINT) AS missing_text_count,
       CAST(count(*) FILTER (WHERE missing_text) AS BIGINT) AS empty_text_count,
       CAST(count(*) FILTER (WHERE invalid_label) AS BIGINT) AS invalid_label_count,
       (SELECT CAST(count(*) AS BIGINT) FROM fin) AS validated_rows,
       (SELECT CAST(count(*) FILTER (WHERE label = 'ham') AS BIGINT) FROM fin) AS ham_count,
       (SELECT CAST(count(*) FILTER (WHERE label = 'spam') AS BIGINT) FROM fin) AS spam_count,
       (SELECT CAST(coalesce(sum(cnt) FILTER (WHERE cnt > 1), 0) AS BIGINT) FROM bt) AS duplicate_message_count,
       (SELECT CAST(count(*) FILTER (WHERE cnt > 1) AS BIGINT) FROM bt) AS duplicate_message_groups,
       (SELECT CAST(coalesce(sum(cnt) FILTER (WHERE cnt > 1), 0) AS BIGINT) FROM bp) AS exact_duplicate_row_count,
       (SELECT CAST(count(*) AS BIGINT) FROM msg) - (SELECT CAST(count(*) AS BIGINT) FROM fin) AS duplicate_messages_removed
FROM fl2
"""


# -- §2.5 splits ---------------------------------------------------------------------------

ROW_SPLIT = """qc AS (SELECT label, count(*) AS c FROM msg GROUP BY label),
qn AS (SELECT CAST(sum(c) AS BIGINT) AS n, CAST(ceil(0.2 * sum(c)) AS BIGINT) AS nt FROM qc),
qa AS (SELECT label, c, (c * (n - nt)) // n AS base, (c * (n - nt)) % n AS rem, n - nt AS ntr FROM qc, qn),
qb AS (SELECT *, ntr - sum(base) OVER () AS short, row_number() OVER (ORDER BY rem DESC, label ASC) AS rk FROM qa),
qq AS (SELECT label, c - (base + CASE WHEN rk <= short THEN 1 ELSE 0 END) AS q FROM qb),
sp AS (SELECT m.row_id, m.label, m.text,
              CASE WHEN row_number() OVER (PARTITION BY m.label
                       ORDER BY md5('42:' || CAST(m.row_id AS VARCHAR)), m.row_id) <= qq.q
                   THEN 'test' ELSE 'train' END AS split
       FROM msg m JOIN qq ON m.label = qq.label)"""

GROUP_SPLIT = """gk AS (SELECT DISTINCT md5('42:' || text) AS k FROM msg),
gq AS (SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS q FROM gk),
gt AS (SELECT k FROM (SELECT k, row_number() OVER (ORDER BY k) AS rn FROM gk), gq WHERE rn <= q),
sp AS (SELECT m.row_id, m.label, m.text,
              CASE WHEN md5('42:' || m.text) IN (SELECT k FROM gt) THEN 'test' ELSE 'train' END AS split
       FROM msg m)"""

ORACLES["stratified_split"] = _with(MSG, ROW_SPLIT) + "SELECT row_id, label, split FROM sp\n"
ORACLES["grouped_split"] = _with(MSG, GROUP_SPLIT) + "SELECT row_id, label, split FROM sp\n"

ORACLES["split_leakage"] = _with(MSG, ROW_SPLIT, """g AS (
  SELECT text, count(*) AS cnt, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS in_train,
         max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS in_test,
         count(*) FILTER (WHERE split = 'test') AS test_rows FROM sp GROUP BY text)""") + """
SELECT CAST(coalesce(sum(cnt) FILTER (WHERE cnt > 1), 0) AS BIGINT) AS duplicate_message_rows,
       CAST(count(*) FILTER (WHERE cnt > 1) AS BIGINT) AS duplicate_message_groups,
       CAST(count(*) FILTER (WHERE in_train = 1 AND in_test = 1) AS BIGINT) AS text_overlap_count,
       CAST(coalesce(sum(test_rows) FILTER (WHERE in_train = 1 AND in_test = 1), 0) AS BIGINT) AS test_rows_with_train_text
FROM g
"""

ORACLES["split_profile"] = _with(MSG, GROUP_SPLIT, """g AS (
  SELECT text, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS in_train,
         max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS in_test FROM sp GROUP BY text)""") + """
SELECT CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_rows,
       CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test_rows,
       CAST(count(*) FILTER (WHERE split = 'train' AND label = 'ham') AS BIGINT) AS train_ham,
       CAST(count(*) FILTER (WHERE split = 'train' AND label = 'spam') AS BIGINT) AS train_spam,
       CAST(count(*) FILTER (WHERE split = 'test' AND label = 'ham') AS BIGINT) AS test_ham,
       CAST(count(*) FILTER (WHERE split = 'test' AND label = 'spam') AS BIGINT) AS test_spam,
       (SELECT CAST(count(*) FILTER (WHERE in_train = 1) AS BIGINT) FROM g) AS train_unique_texts,
       (SELECT CAST(count(*) FILTER (WHERE in_test = 1) AS BIGINT) FROM g) AS test_unique_texts,
       (SELECT CAST(count(*) FILTER (WHERE in_train = 1 AND in_test = 1) AS BIGINT) FROM g) AS text_overlap_count
FROM sp
"""

ORACLES["class_weights"] = _with(MSG, """c AS (SELECT label, count(*) AS nc FROM msg GROUP BY label),
w AS (SELECT label, sum(nc) OVER () / (count(*) OVER () * nc) AS weight FROM c)""") + f"""
SELECT m.row_id, m.label, {r9('CAST(w.weight AS DOUBLE)')} AS weight FROM msg m JOIN w ON m.label = w.label
"""

ORACLES["sample_messages"] = _with(MSG) + """
SELECT row_id, label FROM (
  SELECT row_id, label, row_number() OVER (ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) AS rn FROM msg)
WHERE rn <= 100
"""


# -- §2.6 evaluation -------------------------------------------------------------------------

def _sigmoid(s: str) -> str:
    return f"(CASE WHEN {s} >= 0 THEN 1.0 / (1.0 + exp(-{s})) ELSE exp({s}) / (1.0 + exp({s})) END)"


def pred_ctes(split: str) -> str:
    """msg -> split -> train-only term ratios -> test predictions (CTE ``pred``)."""
    return _with(MSG, split, f"""tk AS (SELECT row_id, label, split, {tokens_expr('text')} AS toks FROM sp),
tx AS (SELECT row_id, label, split, unnest(toks) AS token FROM tk),
tr AS (SELECT token, sum(CASE WHEN label = 'spam' THEN 1 ELSE 0 END) AS sc,
              sum(CASE WHEN label = 'ham' THEN 1 ELSE 0 END) AS hc
       FROM tx WHERE split = 'train' GROUP BY token),
trt AS (SELECT CAST(count(*) AS DOUBLE) AS v, CAST(sum(sc) AS DOUBLE) AS tp, CAST(sum(hc) AS DOUBLE) AS tn FROM tr),
rt AS (SELECT token, ln(((sc + 0.5) / (tp + 0.5 * v)) / ((hc + 0.5) / (tn + 0.5 * v))) AS ratio FROM tr, trt),
ts AS (SELECT x.row_id, sum(coalesce(rt.ratio, 0.0)) AS s FROM tx x LEFT JOIN rt ON x.token = rt.token
       WHERE x.split = 'test' GROUP BY x.row_id),
pred0 AS (SELECT t.row_id, t.label AS true_label, coalesce(ts.s, 0.0) AS s FROM tk t
          LEFT JOIN ts ON t.row_id = ts.row_id WHERE t.split = 'test'),
pred AS (SELECT row_id, true_label, CASE WHEN s > 0 THEN 'spam' ELSE 'ham' END AS predicted_label,
                {r9(_sigmoid('s'))} AS spam_probability FROM pred0),
pt AS (SELECT *, true_label = predicted_label AS is_correct,
              CASE WHEN true_label = predicted_label THEN ''
                   WHEN true_label = 'ham' AND predicted_label = 'spam' THEN 'false_positive_spam'
                   WHEN true_label = 'spam' AND predicted_label = 'ham' THEN 'false_negative_spam'
                   ELSE 'other_error' END AS error_type FROM pred)""")


ROW_PRED = pred_ctes(ROW_SPLIT)
GROUP_PRED = pred_ctes(GROUP_SPLIT)


def d0(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END)"


ORACLES["prediction_table"] = ROW_PRED + "SELECT row_id, true_label, predicted_label, spam_probability, is_correct, error_type FROM pt\n"

ORACLES["confusion_matrix"] = ROW_PRED + """
SELECT l.true_label,
       CAST(count(p.row_id) FILTER (WHERE p.predicted_label = 'ham') AS BIGINT) AS pred_ham,
       CAST(count(p.row_id) FILTER (WHERE p.predicted_label = 'spam') AS BIGINT) AS pred_spam
FROM (VALUES ('ham'), ('spam')) l(true_label) LEFT JOIN pt p ON p.true_label = l.true_label
GROUP BY l.true_label
"""

ORACLES["confusion_rates"] = ROW_PRED + f"""
, cm AS (SELECT l.true_label,
       count(p.row_id) FILTER (WHERE p.predicted_label = 'ham') AS h,
       count(p.row_id) FILTER (WHERE p.predicted_label = 'spam') AS s
FROM (VALUES ('ham'), ('spam')) l(true_label) LEFT JOIN pt p ON p.true_label = l.true_label GROUP BY l.true_label)
SELECT true_label, {r9(d0('h', 'h + s'))} AS rate_ham, {r9(d0('s', 'h + s'))} AS rate_spam FROM cm
""".replace("\n, cm AS", ",\ncm AS", 1)


def _binary(src: str) -> str:
    return f"""SELECT {r9(d0('count(*) FILTER (WHERE true_label = predicted_label)', 'count(*)'))} AS accuracy,
       {r9(d0('tp', 'tp + fp'))} AS spam_precision, {r9(d0('tp', 'tp + fn'))} AS spam_recall,
       {r9(d0('2 * tp', '2 * tp + fp + fn'))} AS spam_f1,
       CAST(count(*) FILTER (WHERE true_label = 'ham') AS BIGINT) AS support_ham,
       CAST(count(*) FILTER (WHERE true_label = 'spam') AS BIGINT) AS support_spam,
       CAST(count(*) FILTER (WHERE true_label = 'ham' AND predicted_label = 'spam') AS BIGINT) AS false_positives,
       CAST(count(*) FILTER (WHERE true_label = 'spam' AND predicted_label = 'ham') AS BIGINT) AS false_negatives
FROM (SELECT *, count(*) FILTER (WHERE true_label = 'spam' AND predicted_label = 'spam') OVER () AS tp,
             count(*) FILTER (WHERE true_label <> 'spam' AND predicted_label = 'spam') OVER () AS fp,
             count(*) FILTER (WHERE true_label = 'spam' AND predicted_label <> 'spam') OVER () AS fn FROM {src})
GROUP BY tp, fp, fn"""


PER_CLASS = f""", pc AS (
  SELECT l.cls AS class,
         count(*) FILTER (WHERE p.true_label = l.cls AND p.predicted_label = l.cls) AS tp,
         count(*) FILTER (WHERE p.true_label <> l.cls AND p.predicted_label = l.cls) AS fp,
         count(*) FILTER (WHERE p.true_label = l.cls AND p.predicted_label <> l.cls) AS fn,
         count(*) FILTER (WHERE p.true_label = l.cls) AS support
  FROM (VALUES ('ham'), ('spam')) l(cls), pt p GROUP BY l.cls),
pcm AS (SELECT class, support, {d0('tp', 'tp + fp')} AS precision, {d0('tp', 'tp + fn')} AS recall,
               {d0('2 * tp', '2 * tp + fp + fn')} AS f1_score FROM pc),
av AS (SELECT avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1_score) AS macro_f1,
              {d0('sum(precision * support)', 'sum(support)')} AS weighted_precision,
              {d0('sum(recall * support)', 'sum(support)')} AS weighted_recall,
              {d0('sum(f1_score * support)', 'sum(support)')} AS weighted_f1 FROM pcm)
"""

ORACLES["binary_metrics"] = ROW_PRED + _binary("pt") + "\n"

ORACLES["averaged_metrics"] = ROW_PRED + PER_CLASS + f"""
SELECT {r9('macro_precision')} AS macro_precision, {r9('macro_recall')} AS macro_recall, {r9('macro_f1')} AS macro_f1,
       {r9('weighted_precision')} AS weighted_precision, {r9('weighted_recall')} AS weighted_recall,
       {r9('weighted_f1')} AS weighted_f1 FROM av
"""

ORACLES["classification_report"] = ROW_PRED + PER_CLASS + f"""
SELECT class, {r9('precision')} AS precision, {r9('recall')} AS recall, {r9('f1_score')} AS f1_score,
       CAST(support AS BIGINT) AS support FROM pcm
UNION ALL SELECT 'accuracy', NULL, NULL,
       {r9(d0('count(*) FILTER (WHERE true_label = predicted_label)', 'count(*)'))}, CAST(count(*) AS BIGINT) FROM pt
UNION ALL SELECT 'macro avg', {r9('macro_precision')}, {r9('macro_recall')}, {r9('macro_f1')},
       (SELECT CAST(count(*) AS BIGINT) FROM pt) FROM av
UNION ALL SELECT 'weighted avg', {r9('weighted_precision')}, {r9('weighted_recall')}, {r9('weighted_f1')},
       (SELECT CAST(count(*) AS BIGINT) FROM pt) FROM av
"""


def _record(ctes: str, strategy: str) -> str:
    body = _binary("pt").replace("SELECT ", "SELECT '" + strategy + "' AS evaluation_strategy, ", 1)
    return ctes + PER_CLASS + f""", bm AS ({body})
SELECT bm.*, {r9('macro_precision')} AS macro_precision, {r9('macro_recall')} AS macro_recall,
       {r9('macro_f1')} AS macro_f1, {r9('weighted_precision')} AS weighted_precision,
       {r9('weighted_recall')} AS weighted_recall, {r9('weighted_f1')} AS weighted_f1 FROM bm, av"""


ORACLES["evaluation_comparison"] = (
    "SELECT * FROM (" + _record(ROW_PRED, "row_stratified_split") + ")\nUNION ALL\nSELECT * FROM ("
    + _record(GROUP_PRED, "group_shuffle_split_by_text") + ")\n"
)

ORACLES["error_examples"] = ROW_PRED + f"""
SELECT row_id, true_label, predicted_label, spam_probability, is_correct, error_type,
       {r9("CASE WHEN predicted_label = 'spam' THEN spam_probability ELSE 1 - spam_probability END")} AS confidence
FROM pt WHERE error_type <> ''
"""

THRESH = """, sg AS (SELECT spam_probability AS score, count(*) FILTER (WHERE true_label = 'spam') AS pos,
              count(*) FILTER (WHERE true_label <> 'spam') AS neg FROM pt GROUP BY spam_probability),
cu AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp
       FROM sg),
tpos AS (SELECT count(*) FILTER (WHERE true_label = 'spam') AS P FROM pt)
"""

ORACLES["pr_curve"] = ROW_PRED + THRESH + f"""
SELECT {r9('score')} AS threshold, {r9(d0('tp', 'tp + fp'))} AS precision,
       {r9("CASE WHEN P = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) END")} AS recall FROM cu, tpos
UNION ALL SELECT NULL, 1.0, 0.0
"""

ORACLES["average_precision"] = ROW_PRED + THRESH + f"""
SELECT {r9(f"coalesce(sum(CAST(pos AS DOUBLE) / CAST(P AS DOUBLE) * {d0('tp', 'tp + fp')}), 0.0)")} AS average_precision
FROM cu, tpos
"""

ORACLES["prevalence"] = ROW_PRED + f"""
SELECT {r9("avg(CASE WHEN true_label = 'spam' THEN 1.0 ELSE 0.0 END)")} AS prevalence FROM pt
"""


# -- §2.2 more text functions ------------------------------------------------------------

DOCS = f"""docs AS (SELECT CAST(doc_id AS BIGINT) AS row_id, text FROM documents)"""


def norm_text(text: str, lowercase: bool = True) -> str:
    e = strip(f"coalesce({text}, '')")
    return f"lower({e})" if lowercase else e


def raw_tokens(text: str) -> str:
    return f"regexp_extract_all({norm_text(text)}, {sq(TOKEN_PATTERN)})"


def stop_list() -> str:
    from msgsift.functions.text import DEFAULT_STOPWORDS
    return "[" + ", ".join(sq(w) for w in sorted(set(DEFAULT_STOPWORDS))) + "]"


def summ(arr: str) -> str:
    return f"CAST(len({arr}) AS INTEGER) AS n, md5(array_to_string({arr}, ' ')) AS md5"


def words(text: str) -> str:
    return f"regexp_extract_all(strip_accents(lower(coalesce({text}, ''))), {sq(WORD_PATTERN)})"


def with_bigrams(arr: str) -> str:
    return (f"list_concat({arr}, CASE WHEN len({arr}) >= 2 THEN list_transform(range(1, len({arr})), "
            f"lambda i: {arr}[i] || ' ' || {arr}[i + 1]) ELSE [] END)")


ORACLES["normalize_text"] = _with(DOCS) + f"""
SELECT row_id, md5({norm_text('text')}) AS md5, CAST(length({norm_text('text', False)}) AS INTEGER) AS n_chars FROM docs
"""

ORACLES["filter_tokens"] = _with(DOCS, f"""t AS (SELECT row_id, list_filter({raw_tokens('text')},
    lambda x: length(x) >= 3 AND NOT regexp_full_match(x, '[0-9]+') AND NOT list_contains({stop_list()}, x)) AS f FROM docs)""") + f"SELECT row_id, {summ('f')} FROM t\n"

ORACLES["stopword_filter"] = _with(DOCS, f"""t AS (SELECT row_id, list_filter({tokens_expr('text')},
    lambda x: NOT list_contains({stop_list()}, x)) AS f FROM docs)""") + f"SELECT row_id, {summ('f')} FROM t\n"

ORACLES["make_ngrams"] = _with(DOCS, f"""t AS (SELECT row_id, {tokens_expr('text')} AS t FROM docs),
g AS (SELECT row_id, CASE WHEN len(t) >= 3 THEN list_transform(range(1, len(t) - 1),
    lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) ELSE [] END AS g FROM t)""") + f"SELECT row_id, {summ('g')} FROM g\n"

ORACLES["strip_accents"] = _with(DOCS) + "SELECT row_id, md5(strip_accents(lower(text))) AS md5 FROM docs\n"

ORACLES["word_analyzer"] = _with(DOCS, f"w AS (SELECT row_id, {words('text')} AS w FROM docs)") + f"SELECT row_id, {summ('w')} FROM w\n"

ORACLES["ngram_range_terms"] = _with(DOCS, f"w AS (SELECT row_id, {words('text')} AS w FROM docs)",
                                     f"g AS (SELECT row_id, {with_bigrams('w')} AS g FROM w)") + f"SELECT row_id, {summ('g')} FROM g\n"


# -- §2.4 features -----------------------------------------------------------------------

TERMS = f"""terms AS (SELECT row_id, {with_bigrams('w')} AS terms FROM (SELECT row_id, {words('text')} AS w FROM msg)),
tfx AS (SELECT row_id, unnest(terms) AS term FROM terms),
tf AS (SELECT row_id, term, count(*) AS tf FROM tfx GROUP BY row_id, term),
nd AS (SELECT count(*) AS n FROM msg),
voc AS (SELECT term, count(*) AS df, sum(tf) AS tf_total FROM tf GROUP BY term HAVING count(*) >= 2),
vocab AS (SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, term, CAST(df AS BIGINT) AS df,
                 CAST(tf_total AS BIGINT) AS tf_total, ln((1.0 + n) / (1.0 + df)) + 1 AS idf FROM voc, nd)"""

ORACLES["build_vocabulary"] = _with(MSG, TERMS) + f"SELECT idx, term, df, tf_total, {r9('idf')} AS idf FROM vocab\n"

ORACLES["build_vocabulary_limited"] = _with(MSG, TERMS, """lim AS (SELECT * FROM voc ORDER BY tf_total DESC, term ASC LIMIT 5000),
vl AS (SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, term, CAST(df AS BIGINT) AS df,
              CAST(tf_total AS BIGINT) AS tf_total, ln((1.0 + n) / (1.0 + df)) + 1 AS idf FROM lim, nd)""") + f"SELECT idx, term, df, tf_total, {r9('idf')} AS idf FROM vl\n"

TFIDF = """w AS (SELECT t.row_id, t.term, (1 + ln(t.tf)) * v.idf AS w FROM tf t JOIN vocab v ON t.term = v.term),
nrm AS (SELECT row_id, sqrt(sum(w * w)) AS nn FROM w GROUP BY row_id)"""

ORACLES["tfidf_weights"] = _with(MSG, TERMS, TFIDF) + f"""
SELECT w.row_id, w.term, {r9('w.w / nrm.nn')} AS weight FROM w JOIN nrm ON w.row_id = nrm.row_id
UNION ALL SELECT row_id, NULL, NULL FROM msg WHERE row_id NOT IN (SELECT row_id FROM w)
"""

ORACLES["tfidf_transform"] = _with(MSG, TERMS, f"""bterms AS (SELECT CAST(item_id AS BIGINT) AS row_id,
    {with_bigrams('w')} AS terms FROM (SELECT item_id, {words('text')} AS w FROM benchmark)),
btx AS (SELECT row_id, unnest(terms) AS term FROM bterms),
btf AS (SELECT row_id, term, count(*) AS tf FROM btx GROUP BY row_id, term),
w AS (SELECT t.row_id, t.term, (1 + ln(t.tf)) * v.idf AS w FROM btf t JOIN vocab v ON t.term = v.term),
nrm AS (SELECT row_id, sqrt(sum(w * w)) AS nn FROM w GROUP BY row_id)""") + f"""
SELECT w.row_id, w.term, {r9('w.w / nrm.nn')} AS weight FROM w JOIN nrm ON w.row_id = nrm.row_id
UNION ALL SELECT CAST(item_id AS BIGINT), NULL, NULL FROM benchmark WHERE CAST(item_id AS BIGINT) NOT IN (SELECT row_id FROM w)
"""

ORACLES["assemble_sparse"] = _with(MSG, TERMS, TFIDF, """nz AS (SELECT row_id, count(*) AS nnz FROM w GROUP BY row_id)""") + """
SELECT m.row_id, CAST(coalesce(nnz, 0) AS INTEGER) AS nnz, (SELECT CAST(count(*) AS INTEGER) FROM vocab) AS size,
       CASE WHEN nnz IS NULL THEN 0.0 ELSE 1.0 END AS sq_norm
FROM msg m LEFT JOIN nz ON m.row_id = nz.row_id
"""

LSA_TERMS = f"""sw AS (SELECT row_id, list_filter({words('text')}, lambda x: NOT list_contains({stop_list()}, x)) AS w FROM msg),
lt AS (SELECT row_id, unnest({with_bigrams('w')}) AS term FROM sw),
lf AS (SELECT row_id, term, count(*) AS tf FROM lt GROUP BY row_id, term),
lv AS (SELECT term, sum(tf) AS tot FROM lf GROUP BY term HAVING count(*) >= 2 ORDER BY tot DESC, term ASC LIMIT 5000),
lk AS (SELECT least(100, (SELECT count(*) FROM lv) - 1, (SELECT count(*) FROM msg) - 1) AS k)"""

ORACLES["lsa_embed"] = _with(MSG, LSA_TERMS) + """
SELECT m.row_id, CAST(k AS INTEGER) AS dims, CAST(k AS INTEGER) AS components, true AS singular_values_fall,
       CASE WHEN m.row_id IN (SELECT row_id FROM lf JOIN lv ON lf.term = lv.term) THEN 1.0 ELSE 0.0 END AS sq_norm
FROM msg m, lk
"""

ORACLES["batch_embed"] = """
WITH w AS (SELECT CAST(doc_id AS BIGINT) AS row_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '\\S+')) AS word FROM documents)
SELECT row_id, CAST(CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 64 AS INTEGER) AS dim, CAST(count(*) AS DOUBLE) AS value
FROM w GROUP BY ALL
"""

_TRAIN_TERMS = TERMS.replace("FROM msg", "FROM trn")

ORACLES["fit_classifier"] = _with(MSG, ROW_SPLIT, "trn AS (SELECT row_id, label, text FROM sp WHERE split = 'train')", _TRAIN_TERMS) + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM trn) AS rows, (SELECT CAST(count(*) AS BIGINT) FROM vocab) AS features, true AS gradient_vanishes
"""

_COEF = "((CAST('0x' || substr(md5(v.term), 1, 4) AS BIGINT) % 2001 - 1000) / 1000.0)"


def _scores(source: str) -> str:
    """CTE ``mg``(row_id, m): margins of the rows (row_id, text) of ``source`` under the given weights."""
    return f"""st AS (SELECT row_id, unnest({with_bigrams('w')}) AS term FROM (SELECT row_id, {words('text')} AS w FROM {source})),
sf AS (SELECT row_id, term, count(*) AS tf FROM st GROUP BY row_id, term),
sd AS (SELECT sf.row_id, (1 + ln(sf.tf)) * v.idf AS w, CAST({_COEF} AS DOUBLE) AS c FROM sf JOIN vocab v ON sf.term = v.term),
sm AS (SELECT row_id, sum(w * c) / sqrt(sum(w * w)) AS s FROM sd GROUP BY row_id),
mg AS (SELECT r.row_id, coalesce(sm.s, 0.0) - 0.25 AS m FROM {source} r LEFT JOIN sm ON r.row_id = sm.row_id)"""


_TEST = "tst AS (SELECT row_id, label, text FROM sp WHERE split = 'test')"
_SCORED = f"""SELECT mg.row_id, CASE WHEN m > 0 THEN 'spam' ELSE 'ham' END AS predicted_label, {r9(_sigmoid('m'))} AS spam_probability"""

ORACLES["score_messages"] = _with(MSG, ROW_SPLIT, TERMS, _TEST, _scores("tst")) + f"""
{_SCORED}, tst.label AS true_label FROM mg JOIN tst ON mg.row_id = tst.row_id
"""
ORACLES["persist_model"] = _with(MSG, ROW_SPLIT, TERMS, _TEST, _scores("tst")) + f"{_SCORED} FROM mg\n"

ORACLES["predict_confidence"] = _with(MSG, TERMS, "req AS (SELECT CAST(item_id AS BIGINT) AS row_id, text FROM benchmark)",
                                      f"ok AS (SELECT * FROM req WHERE {strip('text')} <> '')", _scores("ok")) + f"""
SELECT req.row_id, CASE WHEN m IS NULL THEN NULL WHEN m > 0 THEN 'spam' ELSE 'ham' END AS label,
       {r9(f"greatest({_sigmoid('m')}, 1 - {_sigmoid('m')})")} AS confidence, m IS NULL AS rejected
FROM req LEFT JOIN mg ON req.row_id = mg.row_id
"""

ORACLES["stream_score"] = _with(MSG, TERMS, f"""req AS (
  SELECT 'item-' || CAST(item_id AS VARCHAR) AS row_id, {strip("coalesce(text, '')")} AS text FROM benchmark
  UNION ALL SELECT 'doc-' || CAST(doc_id AS VARCHAR), {strip("coalesce(text, '')")} FROM documents)""",
                                "ok AS (SELECT * FROM req WHERE length(text) BETWEEN 1 AND 10000)", _scores("ok")) + f"""
SELECT req.row_id AS request_id, m IS NOT NULL AS accepted,
       CASE WHEN length(req.text) = 0 THEN 'empty_text' WHEN length(req.text) > 10000 THEN 'text_too_long' ELSE '' END AS reject_reason,
       CASE WHEN m IS NULL THEN NULL WHEN m > 0 THEN 'spam' ELSE 'ham' END AS label,
       {r9(f"greatest({_sigmoid('m')}, 1 - {_sigmoid('m')})")} AS confidence
FROM req LEFT JOIN mg ON req.row_id = mg.row_id
"""

ORACLES["l2_normalize"] = f"""
WITH e AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, embedding,
                  sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nn
           FROM embeddings),
x AS (SELECT vec_id, nn, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM e)
SELECT vec_id, CAST(dim AS INTEGER) AS dim,
       {r9('CASE WHEN nn = 0 THEN CAST(v AS DOUBLE) ELSE CAST(v AS DOUBLE) / nn END')} AS value FROM x
"""

ORACLES["training_metadata"] = _with(MSG, ROW_SPLIT, DUPS) + """
SELECT CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_rows,
       CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test_rows,
       CAST(count(*) FILTER (WHERE label = 'ham') AS BIGINT) AS class_ham,
       CAST(count(*) FILTER (WHERE label = 'ham' AND split = 'train') AS BIGINT) AS train_ham,
       CAST(count(*) FILTER (WHERE label = 'ham' AND split = 'test') AS BIGINT) AS test_ham,
       CAST(count(*) FILTER (WHERE label = 'spam') AS BIGINT) AS class_spam,
       CAST(count(*) FILTER (WHERE label = 'spam' AND split = 'train') AS BIGINT) AS train_spam,
       CAST(count(*) FILTER (WHERE label = 'spam' AND split = 'test') AS BIGINT) AS test_spam,
       (SELECT CAST(coalesce(sum(cnt) FILTER (WHERE cnt > 1), 0) AS BIGINT) FROM bt) AS duplicate_message_count,
       (SELECT CAST(count(*) FILTER (WHERE cnt > 1) AS BIGINT) FROM bt) AS duplicate_message_groups,
       (SELECT CAST(coalesce(sum(cnt) FILTER (WHERE cnt > 1), 0) AS BIGINT) FROM bp) AS exact_duplicate_row_count,
       0.2 AS test_size, 42 AS random_state, 'tfidf' AS representation, '1-2' AS ngram_range, 2 AS min_df, true AS sublinear_tf,
       'logistic_regression' AS classifier, 1.0 AS c, 'balanced' AS class_weight, 1000 AS max_iter
FROM sp
"""


def _field(c: str) -> str:
    return f"(CASE WHEN {c} IS NULL THEN 'n' ELSE 's' || CAST(strlen({c}) AS VARCHAR) || ':' || {c} END)"


ORACLES["corpus_fingerprint"] = _with(MSG, f"""h AS (SELECT sha256({_field('label')} || {_field('text')}) AS h FROM msg),
ea AS (SELECT h, count(*) AS n FROM h GROUP BY h),
lf AS (SELECT substr(h, 1, 4) AS b, sum(n) AS n, sha256(string_agg(h || '*' || CAST(n AS VARCHAR), ',' ORDER BY h || '*' || CAST(n AS VARCHAR))) AS d
       FROM ea GROUP BY 1)""") + """
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, sha256(string_agg(d, ',' ORDER BY b)) AS fingerprint FROM lf
"""


def _tree(rows: str, name: str) -> str:
    """CTEs of the digest tree of a (label, text) relation; the last one is ``name``."""
    levels = [f"""{name}h AS (SELECT sha256({_field('label')} || {_field('text')}) AS h FROM {rows}),
{name}e AS (SELECT h, count(*) AS n FROM {name}h GROUP BY h),
{name}4 AS (SELECT substr(h, 1, 4) AS prefix, CAST(sum(n) AS BIGINT) AS rows,
       sha256(string_agg(h || '*' || CAST(n AS VARCHAR), ',' ORDER BY h || '*' || CAST(n AS VARCHAR))) AS digest FROM {name}e GROUP BY 1)"""]
    for k in (3, 2, 1):
        levels.append(f"""{name}{k} AS (SELECT substr(prefix, 1, {k}) AS prefix, CAST(sum(rows) AS BIGINT) AS rows,
       sha256(string_agg(prefix || ':' || digest, ',' ORDER BY prefix)) AS digest FROM {name}{k + 1} GROUP BY 1)""")
    levels.append(f"""{name}0 AS (SELECT '' AS prefix, CAST(coalesce(sum(rows), 0) AS BIGINT) AS rows,
       sha256(coalesce(string_agg(prefix || ':' || digest, ',' ORDER BY prefix), '')) AS digest FROM {name}1)""")
    return ",\n".join(levels)


ORACLES["fingerprint_tree"] = _with(MSG, _tree("msg", "t")) + " UNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS level, prefix, rows, digest FROM t{k}" for k in range(5))
ORACLES["fingerprint_difference"] = _with(MSG, """ch AS (
  SELECT label, CASE WHEN row_id % 97 = 0 THEN text || ' changed' ELSE text END AS text FROM msg WHERE row_id % 89 <> 0
  UNION ALL SELECT label, 'added' FROM msg WHERE row_id % 83 = 0)""", _tree("msg", "t"), _tree("ch", "u")) + """
SELECT coalesce(t4.prefix, u4.prefix) AS prefix, coalesce(t4.rows, 0) AS rows, coalesce(u4.rows, 0) AS other_rows
FROM t4 FULL JOIN u4 ON t4.prefix = u4.prefix WHERE t4.digest IS DISTINCT FROM u4.digest
"""


# -- §2.7 clustering ------------------------------------------------------------------------

EMB = """e AS (SELECT CAST(vec_id AS BIGINT) AS row_id, CAST(label AS INTEGER) AS given, embedding FROM embeddings),
ex AS (SELECT row_id, given, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS dim FROM e)"""

ORACLES["nearest_centroid"] = _with(EMB, """cen AS (SELECT given AS c, dim, avg(CAST(v AS DOUBLE)) AS m FROM ex GROUP BY given, dim),
cidx AS (SELECT c, CAST(dense_rank() OVER (ORDER BY c) - 1 AS INTEGER) AS ci FROM (SELECT DISTINCT c FROM cen)),
dd AS (SELECT ex.row_id, ex.given, cidx.ci, sqrt(sum((CAST(ex.v AS DOUBLE) - cen.m) * (CAST(ex.v AS DOUBLE) - cen.m))) AS d
       FROM ex JOIN cen ON ex.dim = cen.dim JOIN cidx ON cen.c = cidx.c GROUP BY ex.row_id, ex.given, cidx.ci),
best AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d, ci) AS rn FROM dd)""") + f"""
SELECT row_id, given, ci AS cluster_id, {r9('d')} AS distance_to_centroid FROM best WHERE rn = 1
"""

ORACLES["silhouette"] = _with(EMB, """u AS (SELECT row_id, given, dim, CAST(v AS DOUBLE) / sqrt(sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE)) OVER (PARTITION BY row_id)) AS u FROM ex),
pr AS (SELECT a.row_id AS i, b.row_id AS j, b.given AS cj, 1 - sum(a.u * b.u) AS d
       FROM u a JOIN u b ON a.dim = b.dim AND a.row_id <> b.row_id GROUP BY a.row_id, b.row_id, b.given),
own AS (SELECT row_id, given FROM e),
pc AS (SELECT pr.i, pr.cj, own.given AS ci, avg(d) AS md FROM pr JOIN own ON pr.i = own.row_id GROUP BY pr.i, pr.cj, own.given),
sz AS (SELECT given, count(*) AS n FROM e GROUP BY given),
si AS (SELECT o.row_id, sz.n,
              (SELECT md FROM pc WHERE pc.i = o.row_id AND pc.cj = o.given) AS a,
              (SELECT min(md) FROM pc WHERE pc.i = o.row_id AND pc.cj <> o.given) AS b
       FROM own o JOIN sz ON o.given = sz.given)""") + f"""
SELECT {r9("avg(CASE WHEN n <= 1 OR b IS NULL THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END)")} AS silhouette FROM si
"""

ORACLES["kmeans_fit"] = "SELECT count(*) AS rows, CAST(10 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS not_nearest FROM embeddings"
ORACLES["select_k"] = "SELECT CAST(k AS INTEGER) AS k, true AS proper, CAST(1 AS BIGINT) AS bests FROM range(3, 9) t(k)"
ORACLES["project_2d"] = "SELECT count(*) AS rows, 0.0 AS mean_x, 0.0 AS mean_y, 0.0 AS cross_xy, true AS ordered FROM embeddings"
ORACLES["cluster_points"] = "SELECT CAST(vec_id AS BIGINT) AS row_id, CAST(label AS INTEGER) AS cluster_id, true AS placed FROM embeddings"

_RECORD = f"""rec AS (
  SELECT '' AS dataset, '' AS assignments_output, '' AS summary_output, '' AS embeddings_output, '' AS metadata_output,
         'given-labels' AS embedding_provider, 'embeddings.label' AS embedding_model, CAST(max(len(embedding)) AS INTEGER) AS embedding_dimensions,
         '' AS embedding_notes, 'reference grouping' AS embedding_provider_role, 'KMeans' AS clustering_algorithm,
         CAST(count(DISTINCT label) AS INTEGER) AS cluster_count, CAST(count(*) AS INTEGER) AS total_messages,
         (SELECT silhouette FROM sil) AS silhouette_score, 42 AS random_state FROM embeddings)"""
_SIL = "sil AS (" + ORACLES["silhouette"] + ")"

ORACLES["cluster_metadata"] = _with(_SIL, _RECORD) + "SELECT * FROM rec\n"
ORACLES["provider_comparison"] = _with(_SIL, _RECORD) + """
SELECT p.n AS embedding_provider, embedding_model, coalesce(CAST(embedding_dimensions AS VARCHAR), '-') AS embedding_dimensions,
       coalesce(CAST(total_messages AS VARCHAR), '-') AS total_messages, coalesce(CAST(cluster_count AS VARCHAR), '-') AS cluster_count, silhouette_score,
       CASE WHEN rec.cluster_count IS NULL THEN 'not generated' ELSE 'generated' END AS status, p.r AS role, p.n = 'given-labels' AS is_best
FROM (VALUES ('given-labels', 'reference grouping'), ('lsa-local', 'local reproducible path'), ('remote-embeddings', 'remote embedding path')) p(n, r)
LEFT JOIN rec ON rec.embedding_provider = p.n
"""

LANGC = """lm AS (SELECT m.row_id, m.label, m.text, d.lang, CAST(length(m.text) AS DOUBLE) AS n
       FROM msg m JOIN documents d ON m.row_id = d.doc_id),
lg AS (SELECT lang, avg(n) AS mean_n, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS cluster_id FROM lm GROUP BY lang),
asg AS (SELECT lm.row_id, lm.label, lm.text, lg.cluster_id, abs(lm.n - lg.mean_n) / lg.mean_n AS distance_to_centroid
        FROM lm JOIN lg ON lm.lang = lg.lang),
nr AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY distance_to_centroid, row_id) AS rank FROM asg)"""

ORACLES["cluster_assignments"] = _with(MSG, LANGC) + f"SELECT row_id, label, cluster_id, {r9('distance_to_centroid')} AS distance_to_centroid FROM asg\n"

ORACLES["cluster_overview"] = _with(MSG, LANGC) + f"""
SELECT cluster_id, CAST(count(*) AS BIGINT) AS size, CAST(count(*) FILTER (WHERE label = 'ham') AS BIGINT) AS ham,
       CAST(count(*) FILTER (WHERE label = 'spam') AS BIGINT) AS spam,
       {r9("avg(CASE WHEN label = 'spam' THEN 1.0 ELSE 0.0 END)")} AS spam_rate FROM asg GROUP BY cluster_id
"""

ORACLES["cluster_representatives"] = _with(MSG, LANGC) + """
SELECT cluster_id, CAST(rank AS INTEGER) AS rank, row_id, label, md5(replace(text, '|', '/')) AS text_md5 FROM nr WHERE rank <= 5
"""


def _has(words) -> str:
    return "max(CASE WHEN " + " OR ".join(f"contains(lower(text), {sq(w)})" for w in words) + " THEN 1 ELSE 0 END)"


def _theme_sql() -> str:
    from msgsift.operators.cluster import (HAM_FALLBACK, HAM_THEMES, SPAM_FALLBACK, SPAM_THEMES, THEME_SAMPLE,
                                           THEME_SPAM_RATE)
    return _with(MSG, LANGC, f"""fl AS (SELECT cluster_id, {_has(SPAM_THEMES[0][0])} AS s0, {_has(SPAM_THEMES[1][0])} AS s1,
       {_has(HAM_THEMES[0][0])} AS h0, {_has(HAM_THEMES[1][0])} AS h1 FROM nr WHERE rank <= {THEME_SAMPLE} GROUP BY cluster_id),
rt AS (SELECT cluster_id, avg(CASE WHEN label = 'spam' THEN 1.0 ELSE 0.0 END) AS rate FROM asg GROUP BY cluster_id)""") + f"""
SELECT rt.cluster_id, CASE WHEN rate >= {THEME_SPAM_RATE} THEN
         (CASE WHEN s0 = 1 THEN {sq(SPAM_THEMES[0][1])} WHEN s1 = 1 THEN {sq(SPAM_THEMES[1][1])} ELSE {sq(SPAM_FALLBACK)} END)
       ELSE (CASE WHEN h0 = 1 THEN {sq(HAM_THEMES[0][1])} WHEN h1 = 1 THEN {sq(HAM_THEMES[1][1])} ELSE {sq(HAM_FALLBACK)} END)
       END AS theme
FROM rt JOIN fl ON rt.cluster_id = fl.cluster_id
"""


ORACLES["cluster_theme"] = _theme_sql()


# -- §2.8 -----------------------------------------------------------------------------------

_W_US = 6 * 3600 * 1_000_000
_R = 2

RATE_LIMIT = f"""
WITH RECURSIVE ev AS (
  SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id, epoch_us(ts) AS t,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r(user_id, rn, event_id, t, allowed, retry_after, win) AS (
  SELECT user_id, rn, event_id, t, true, CAST(0 AS BIGINT), [t] FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, e.event_id, e.t,
         len(list_filter(r.win, lambda x: x > e.t - {_W_US})) < {_R},
         CASE WHEN len(list_filter(r.win, lambda x: x > e.t - {_W_US})) < {_R} THEN CAST(0 AS BIGINT)
              ELSE CAST(greatest(1, floor(({_W_US} - (e.t - list_min(list_filter(r.win, lambda x: x > e.t - {_W_US}))))
                                          / 1000000.0 + 0.999)) AS BIGINT) END,
         CASE WHEN len(list_filter(r.win, lambda x: x > e.t - {_W_US})) < {_R}
              THEN list_append(list_filter(r.win, lambda x: x > e.t - {_W_US}), e.t)
              ELSE list_filter(r.win, lambda x: x > e.t - {_W_US}) END
  FROM r JOIN ev e ON e.user_id = r.user_id AND e.rn = r.rn + 1)
SELECT event_id, user_id, allowed, retry_after FROM r
"""

ORACLES["rate_limit_decisions"] = RATE_LIMIT
ORACLES["rate_limit_stream"] = RATE_LIMIT

# Every 97th event of the first half arrives after all others, more than an hour behind them.
LATE = f"""facts AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
late AS (SELECT events.*, epoch_us(ts) AS t_us FROM events, facts
         WHERE event_id % 97 = 0 AND epoch_us(ts) < least((lo + hi) // 2, hi - 3600001000))"""

ORACLES["rate_limit_stateful"] = RATE_LIMIT.replace("WITH RECURSIVE ev", "WITH RECURSIVE " + LATE + ",\nev", 1).replace(
    "AS rn FROM events)", "AS rn FROM events WHERE event_id NOT IN (SELECT event_id FROM late))", 1).replace(
    "SELECT event_id, user_id, allowed, retry_after FROM r", """SELECT event_id, user_id, allowed, retry_after, false AS late FROM r
UNION ALL SELECT event_id, user_id, false, 0, true FROM late""", 1)

ORACLES["late_event_counts"] = "WITH " + LATE + """
SELECT user_id, count(*) AS late_events, min(t_us) AS first_t_us, max(t_us) AS last_t_us FROM late GROUP BY user_id
"""

_WS_OR = WHITESPACE_CLASS

ORACLES["validate_requests"] = f"""
WITH d AS (SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS request_id, {strip("coalesce(text, '')")} AS clean FROM documents)
SELECT request_id, reject_reason = '' AS accepted, reject_reason, CAST(length(clean) AS INTEGER) AS n_chars FROM (
  SELECT request_id, clean, CASE WHEN length(clean) = 0 THEN 'empty_text' WHEN length(clean) > 10000 THEN 'text_too_long'
                                 ELSE '' END AS reject_reason FROM d)
"""

ORACLES["top_words_chart"] = _with(MSG, TOK, RUNS, """st AS (
  SELECT token, sum(tf) AS cnt, """ + FIRST + """ AS fs FROM runs GROUP BY token),
top AS (SELECT *, row_number() OVER (ORDER BY cnt DESC, fs ASC) AS rk FROM st)""") + """
SELECT token, CAST(cnt AS BIGINT) AS count FROM top WHERE rk <= 20
"""

ORACLES["vocabulary_chart"] = _with(MSG, TOK, RUNS, TERM_SCORES_CTE) + f"""
SELECT token, {r9('log_rate_ratio_spam_vs_ham')} AS score, 'spam' AS label FROM (
  SELECT *, row_number() OVER (ORDER BY log_rate_ratio_spam_vs_ham DESC, spam_count DESC, token ASC) AS rk FROM sc)
WHERE rk <= 15
UNION ALL
SELECT token, {r9('log_rate_ratio_ham_vs_spam')} AS score, 'ham' AS label FROM (
  SELECT *, row_number() OVER (ORDER BY log_rate_ratio_ham_vs_spam DESC, ham_count DESC, token ASC) AS rk FROM sc)
WHERE rk <= 15
"""

ORACLES["ngram_chart"] = _with(MSG, TOK, NGRAMS_CTE) + """
SELECT ngram, CAST(cnt AS BIGINT) AS count, CASE WHEN n = 2 THEN 'bigram' ELSE 'trigram' END AS kind
FROM (SELECT gs.*, row_number() OVER (PARTITION BY gs.n ORDER BY cnt DESC, fs ASC) AS rk FROM gs)
WHERE rk <= 10
"""

ORACLES["metrics_chart"] = "WITH cmp AS (" + ORACLES["evaluation_comparison"] + """)
SELECT evaluation_strategy AS strategy, 'spam_precision' AS metric, spam_precision AS value FROM cmp
UNION ALL SELECT evaluation_strategy, 'spam_recall', spam_recall FROM cmp
UNION ALL SELECT evaluation_strategy, 'spam_f1', spam_f1 FROM cmp
"""


# -- file round trips ----------------------------------------------------------------------

ORACLES["read_messages"] = """
SELECT CAST(row_number() OVER (ORDER BY d.doc_id) AS BIGINT) AS row_id, CAST(l.toxic AS VARCHAR) AS label,
       md5(d.text) AS text_md5
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

ORACLES["validate_dataset"] = _with(MSG) + """
SELECT CAST(row_number() OVER (ORDER BY row_id) AS BIGINT) AS row_id, label, md5(text) AS text_md5 FROM msg
"""

ORACLES["validation_record"] = ("WITH v AS (" + ORACLES["validation_summary"] + """)
SELECT 'v1' AS label_column, 'v2' AS text_column, 'comma' AS delimiter, 'utf-8' AS encoding, 'v1,v2' AS detected_columns, v.* FROM v
""")

_NG = "SELECT ngram, CAST(cnt AS BIGINT) AS cnt, row_number() OVER (PARTITION BY gs.n ORDER BY cnt DESC, fs ASC) AS rk, gs.n AS size FROM gs"
ORACLES["write_report_tables"] = _with(MSG, TOK, RUNS, TERM_SCORES_CTE, NGRAMS_CTE, "st2 AS (SELECT token, sum(tf) AS cnt, " + FIRST + """ AS fs FROM runs GROUP BY token),
fw AS (SELECT *, row_number() OVER (ORDER BY cnt DESC, fs ASC) AS rk FROM st2),
vb AS (SELECT token, label, sum(tf) AS cnt FROM runs GROUP BY token, label),
sr AS (SELECT *, row_number() OVER (ORDER BY log_rate_ratio_spam_vs_ham DESC, spam_count DESC, token ASC) AS rs,
              row_number() OVER (ORDER BY log_rate_ratio_ham_vs_spam DESC, ham_count DESC, token ASC) AS rh FROM sc),
ng AS (""" + _NG + ")") + """
SELECT 'frequent_words' AS "table", CAST(rk AS INTEGER) AS rank, token AS item, CAST(cnt AS BIGINT) AS count FROM fw WHERE rk <= 50
UNION ALL SELECT 'vocabulary_by_label', 0, token, CAST(cnt AS BIGINT) FROM vb
UNION ALL SELECT 'spam_terms', CAST(rs AS INTEGER), token, CAST(spam_count AS BIGINT) FROM sr WHERE rs <= 30
UNION ALL SELECT 'ham_terms', CAST(rh AS INTEGER), token, CAST(ham_count AS BIGINT) FROM sr WHERE rh <= 30
UNION ALL SELECT CASE WHEN size = 2 THEN 'bigrams' ELSE 'trigrams' END, CAST(rk AS INTEGER), ngram, cnt FROM ng WHERE rk <= 30
"""

ORACLES["confusion_rates_from_errors"] = ORACLES["confusion_rates"]

_JSON = f"""
WITH d AS (SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS request_id, doc_id % 12 AS m, {strip("coalesce(text, '')")} AS clean FROM documents),
r AS (
  SELECT request_id, m, clean, CASE
    WHEN m = 0 THEN 'invalid_json' WHEN m = 1 THEN 'extra_keys' WHEN m = 2 THEN 'missing_text'
    WHEN m IN (3, 5) THEN 'text_not_a_string' WHEN m IN (4, 6) THEN 'not_an_object'
    WHEN length(clean) = 0 THEN 'empty_text' WHEN length(clean) > 10000 THEN 'text_too_long' ELSE '' END AS reject_reason FROM d)
SELECT request_id, reject_reason = '' AS accepted, reject_reason,
       CAST(CASE WHEN m <= 6 THEN 0 ELSE length(clean) END AS INTEGER) AS n_chars FROM r
"""
ORACLES["validate_json_requests"] = _JSON
ORACLES["validate_json_stream"] = _JSON

_ODD = """
WITH o AS (
  SELECT d.doc_id AS row_id, d.text, CASE WHEN d.doc_id % 7 = 0 THEN ' odd' || CAST(d.doc_id % 5 AS VARCHAR)
    WHEN d.doc_id % 11 = 0 THEN 'Toxic?' ELSE CAST(l.toxic AS VARCHAR) END AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
ORACLES["invalid_label_values"] = _ODD + """
SELECT trim(label) AS invalid_value, CAST(count(*) AS BIGINT) AS rows FROM o WHERE label NOT IN ('0', '1') GROUP BY 1
"""
ORACLES["write_checked"] = _ODD + f""",
f AS (SELECT row_id, label, text, coalesce(label, '') NOT IN ('0', '1') OR {strip("coalesce(text, '')")} = '' AS bad FROM o)
SELECT row_id, CASE WHEN bad THEN 'quarantine' ELSE 'message' END AS place,
       CASE WHEN bad THEN label WHEN label = '1' THEN 'spam' ELSE 'ham' END AS label,
       CASE WHEN bad THEN md5(text) ELSE md5({strip('text')}) END AS text_md5,
       (SELECT count(*) FROM f) AS raw_rows, (SELECT count(*) FROM f WHERE bad) AS bad_rows
FROM f
"""
