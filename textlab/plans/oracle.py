"""Oracle SQL (DuckDB dialect) for every SQL-checkable query.

Each statement reads the pre-registered parquet views and rebuilds the same
fixture with the expressions of ``fixtures.py``; only the operator under test
is written independently here.
"""

from __future__ import annotations

from . import fixtures as fx

# Fixed value: Python's whitespace class in RE2 syntax.
WS_RE2 = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def clean(col: str) -> str:
    return f"trim(regexp_replace(coalesce({col}, ''), '{WS_RE2}', ' ', 'g'))"


def tokens_n(col: str) -> str:
    return f"(CASE WHEN {col} = '' THEN 0 ELSE len(string_split({col}, ' ')) END)::INTEGER"


CORPUS = f"""corpus AS (
  SELECT doc_id AS record_id, doc_id * 7 AS article_id, source AS keyword, lang AS country,
         {clean('text')} AS text
  FROM documents)"""

SPLIT = f"""split AS (
  SELECT doc_id AS record_id, toxic::INTEGER AS binary_label, {fx.LABEL_RAW} AS label_raw,
         {fx.SPLIT} AS split
  FROM labels)"""

EDA = f"""{CORPUS},
{SPLIT},
eda AS (
  SELECT s.record_id, s.binary_label, s.label_raw, s.split, c.text,
         {tokens_n('c.text')} AS token_count
  FROM split s LEFT JOIN corpus c USING (record_id)
  WHERE s.split IN ('train', 'dev'))"""

SCORED = f"""scored AS (
  SELECT doc_id AS record_id, toxic::INTEGER AS y_true, {fx.SCORE} AS score, {fx.Y_PRED} AS y_pred,
         {fx.LOGIT_0} AS l0, {fx.LOGIT_1} AS l1, {fx.LABEL_RAW} AS label_raw, {fx.SPLIT} AS split
  FROM labels)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["token_stats"] = with_(EDA) + """
SELECT binary_label, count(token_count)::BIGINT AS count, avg(token_count) AS mean,
       median(token_count)::DOUBLE AS median, min(token_count) AS min, max(token_count) AS max
FROM eda GROUP BY binary_label"""


# ---------------------------------------------------------------------------
# Ingestion fixtures
# ---------------------------------------------------------------------------
def _na(col: str) -> str:
    from ..functions.labels import NA_TOKENS
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"CASE WHEN {col} IN ({toks}) THEN NULL ELSE {col} END"


RAW_CORPUS = f"""raw0 AS (
  SELECT doc_id, {fx.RECORD_ID_RAW} AS record_id, {fx.ARTICLE_ID_RAW} AS article_id,
         {fx.KEYWORD_RAW} AS keyword, {fx.COUNTRY_RAW} AS country, text,
         {fx.RAW_LABEL_RAW} AS raw_label
  FROM documents LEFT JOIN labels USING (doc_id)),
raw_corpus AS (
  SELECT doc_id, {_na('record_id')} AS record_id, {_na('article_id')} AS article_id,
         {_na('keyword')} AS keyword, {_na('country')} AS country, {_na('text')} AS text,
         {_na('raw_label')} AS raw_label
  FROM raw0)"""

PARSED_CORPUS = RAW_CORPUS + f""",
pcorpus AS (
  SELECT record_id::BIGINT AS record_id, replace(article_id, '@@', '')::BIGINT AS article_id,
         keyword, country, {clean('text')} AS text,
         trunc(try_cast(raw_label AS DOUBLE))::INTEGER AS raw_label,
         (trunc(try_cast(raw_label AS DOUBLE)) >= 2)::INTEGER AS binary_label_raw
  FROM raw_corpus
  WHERE regexp_full_match(record_id, '[0-9]+') AND regexp_full_match(article_id, '@@[0-9]+')
    AND try_cast(raw_label AS DOUBLE) BETWEEN 0 AND 4)"""


def binarize(col: str) -> str:
    t = f"trim({col})"
    return f"""(CASE WHEN {col} IS NULL THEN 0
     WHEN {t} IN ('0', '1') THEN {t}::INTEGER
     WHEN regexp_full_match({t}, '\\[.*\\]') AND try_cast({t} AS DOUBLE[]) IS NOT NULL
       THEN coalesce(list_bool_or(list_transform(try_cast({t} AS DOUBLE[]), lambda x: trunc(x) <> 0)), false)::INTEGER
     WHEN try_cast({t} AS DOUBLE) IS NOT NULL THEN (try_cast({t} AS DOUBLE) > 0)::INTEGER
     ELSE regexp_matches({col}, '1')::INTEGER END)"""


RAW_SPLIT = f"""raw_split AS (
  SELECT doc_id::VARCHAR AS par_id, {fx.LABEL_RAW} AS label, doc_id AS pos FROM labels
  UNION ALL
  SELECT doc_id::VARCHAR, cast(1 - toxic as string), doc_id + {fx.DUP_ORD_OFFSET} FROM labels
  WHERE {fx.DUP_FILTER}),
psplit AS (
  SELECT par_id::BIGINT AS record_id, {binarize('label')} AS binary_label,
         coalesce(label, 'nan') AS label_raw
  FROM raw_split
  QUALIFY row_number() OVER (PARTITION BY par_id ORDER BY pos DESC) = 1)"""

JOINED = f"""joined AS (
  SELECT s.record_id, s.binary_label, s.label_raw, c.article_id, c.keyword, c.country, c.text
  FROM psplit s LEFT JOIN pcorpus c USING (record_id))"""

SQL["null_tokens"] = with_(RAW_CORPUS) + """
SELECT doc_id, record_id, article_id, keyword, country, raw_label FROM raw_corpus"""

SQL["valid_records"] = with_(PARSED_CORPUS) + "SELECT * FROM pcorpus"

SQL["valid_test_records"] = with_(f"""raw_test AS (
  SELECT {_na(fx.SAMPLE_ID_RAW)} AS sample_id, {_na(fx.ARTICLE_ID_RAW)} AS article_id,
         {_na(fx.KEYWORD_RAW)} AS keyword, {_na(fx.COUNTRY_RAW)} AS country, {_na('text')} AS text
  FROM documents)""") + f"""
SELECT sample_id, replace(article_id, '@@', '')::BIGINT AS article_id, keyword, country,
       {clean('text')} AS text
FROM raw_test
WHERE regexp_full_match(sample_id, 't_[0-9]+') AND regexp_full_match(article_id, '@@[0-9]+')"""

SQL["clean_text"] = f"SELECT doc_id, {clean('text')} AS text FROM documents"

SQL["article_id"] = with_(RAW_CORPUS) + """
SELECT doc_id, article_id AS article_id_raw,
       CASE WHEN regexp_full_match(article_id, '@@[0-9]+') THEN replace(article_id, '@@', '')::BIGINT END::DOUBLE AS article_id
FROM raw_corpus"""

SQL["coerce_label"] = with_(RAW_CORPUS) + """
SELECT doc_id, raw_label, trunc(try_cast(raw_label AS DOUBLE))::INTEGER::DOUBLE AS label FROM raw_corpus"""

SQL["severity_label"] = with_(PARSED_CORPUS) + "SELECT record_id, raw_label, binary_label_raw FROM pcorpus"

SQL["binarize_label"] = f"""
SELECT doc_id AS record_id, coalesce({fx.LABEL_RAW}, 'nan') AS label_raw,
       {binarize(fx.LABEL_RAW)} AS binary_label
FROM labels"""

SQL["token_count"] = f"SELECT doc_id, {tokens_n(clean('text'))} AS token_count FROM documents"

ENRICH = "'kw_' || coalesce(keyword, 'unk') || ' c_' || coalesce(country, 'unk') || ' ' || coalesce(text, '')"

SQL["enrich_text"] = with_(PARSED_CORPUS) + f"SELECT record_id, {ENRICH} AS text FROM pcorpus"

SQL["truncate_tokens"] = with_(PARSED_CORPUS) + f"""
SELECT record_id,
       CASE WHEN ({ENRICH}) = '' THEN '' ELSE array_to_string(string_split({ENRICH}, ' ')[1:256], ' ') END AS text
FROM pcorpus"""

SQL["dedupe_keep_last"] = with_(RAW_SPLIT) + "SELECT * FROM psplit"

SQL["labelled_split"] = with_(PARSED_CORPUS, RAW_SPLIT, JOINED) + "SELECT * REPLACE (article_id::DOUBLE AS article_id) FROM joined"

SQL["missing_after_join"] = with_(PARSED_CORPUS, RAW_SPLIT, JOINED) + f"""
SELECT {fx.SPLIT.replace('doc_id', 'record_id')} AS split,
       count_if(text IS NULL)::BIGINT AS missing_text, count(*)::BIGINT AS rows
FROM joined GROUP BY ALL"""

SQL["union_splits"] = with_(CORPUS, SPLIT) + """
SELECT s.record_id, s.binary_label, s.split, c.text
FROM split s LEFT JOIN corpus c USING (record_id) WHERE s.split IN ('train', 'dev')"""

# ---------------------------------------------------------------------------
# Profile
# ---------------------------------------------------------------------------
SQL["split_summary"] = with_(EDA) + """
SELECT split, count(*)::BIGINT AS rows, (round((avg(binary_label)) * 1e9)::BIGINT / 1e9) AS positive_rate FROM eda GROUP BY split"""

SQL["class_counts"] = with_(EDA) + """
SELECT split, binary_label, count(*)::BIGINT AS count FROM eda GROUP BY split, binary_label"""

SQL["class_distribution"] = with_(EDA) + """
SELECT split, count_if(binary_label = 0)::BIGINT AS label_0, count_if(binary_label = 1)::BIGINT AS label_1,
       count_if(binary_label = 1)::DOUBLE / count(*)::DOUBLE AS positive_ratio
FROM eda GROUP BY split"""

SQL["token_p99"] = with_(EDA) + "SELECT (round((quantile_cont(token_count, 0.99)) * 1e9)::BIGINT / 1e9) AS p99 FROM eda"

SQL["top_repeated_texts"] = with_(EDA) + """
SELECT binary_label, text, count(*)::BIGINT AS frequency FROM eda
GROUP BY binary_label, text ORDER BY frequency DESC, binary_label, text LIMIT 20"""


def kde_sql(source: str, x: str, group: str, digits: int = 12) -> str:
    return f"""
, st AS (
  SELECT {group} AS g, count({x}) AS n, stddev_samp({x}::DOUBLE) AS sd, min({x}::DOUBLE) AS lo, max({x}::DOUBLE) AS hi
  FROM {source} GROUP BY {group} HAVING count({x}) > 1 AND stddev_samp({x}::DOUBLE) > 0),
bw AS (SELECT *, sd * pow(n::DOUBLE, -0.2) AS h FROM st),
gp AS (SELECT *, lo - 3.0 * h AS s0, hi + 3.0 * h AS s1 FROM bw),
grid AS (
  SELECT g, n, h, k::INTEGER AS k,
         CASE WHEN k = 199 THEN s1 ELSE s0 + k::DOUBLE * ((s1 - s0) / 199) END AS gx
  FROM gp, range(200) r(k)),
vals AS (SELECT {group} AS g, {x}::DOUBLE AS v, count(*) AS c FROM {source} GROUP BY ALL)
SELECT grid.g AS {group}, grid.k, (round((grid.gx) * 1e9)::BIGINT / 1e9) AS x,
       (round((sum(vals.c * exp(-0.5 * pow((grid.gx - vals.v) / grid.h, 2))) / (grid.n * grid.h * sqrt(2 * pi()))) * 1e{digits})::BIGINT / 1e{digits}) AS density
FROM grid JOIN vals USING (g)
GROUP BY grid.g, grid.k, grid.gx, grid.n, grid.h"""


SQL["kde_token_count"] = with_(EDA).rstrip() + kde_sql("eda", "token_count", "binary_label")
SQL["kde_score"] = with_(SCORED, """sg AS (SELECT *, 'true=' || y_true || ',pred=' || y_pred AS grp FROM scored)""").rstrip() + \
    kde_sql("sg", "score", "grp", 9).replace("AS grp, grid.k", 'AS "group", grid.k')

# ---------------------------------------------------------------------------
# Evaluation on the fixture score
# ---------------------------------------------------------------------------
SQL["false_positives"] = with_(SCORED) + "SELECT record_id, y_true, y_pred, score FROM scored WHERE y_true = 0 AND y_pred = 1"
SQL["false_negatives"] = with_(SCORED) + "SELECT record_id, y_true, y_pred, score FROM scored WHERE y_true = 1 AND y_pred = 0"

SOFTMAX = "(exp(l1 - greatest(l0, l1)) / (exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))))"

SQL["softmax_prob"] = with_(SCORED) + f"SELECT record_id, (round(({SOFTMAX}) * 1e12)::BIGINT / 1e12) AS prob_pos FROM scored"
SQL["apply_threshold"] = with_(SCORED) + "SELECT record_id, (score >= 0.5)::INTEGER AS y_pred FROM scored"
SQL["mistake_strength"] = with_(SCORED) + """
SELECT record_id, y_true, y_pred, CASE WHEN y_pred = 1 THEN score ELSE -score END AS mistake_strength
FROM scored WHERE y_true <> y_pred"""
SQL["outcome_groups"] = with_(SCORED) + """
SELECT 'true=' || y_true || ',pred=' || y_pred AS "group", count(*)::BIGINT AS rows FROM scored GROUP BY ALL"""

CM = """cm AS (
  SELECT count_if(y_true = 0 AND y_pred = 0)::BIGINT AS tn, count_if(y_true = 0 AND y_pred = 1)::BIGINT AS fp,
         count_if(y_true = 1 AND y_pred = 0)::BIGINT AS fn, count_if(y_true = 1 AND y_pred = 1)::BIGINT AS tp
  FROM scored)"""


def sdiv(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) > 0 THEN ({a})::DOUBLE / ({b})::DOUBLE ELSE 0.0 END)"


METRICS = f"""{sdiv('tp', 'tp + fp')} AS precision, {sdiv('tp', 'tp + fn')} AS recall,
       {sdiv('2 * tp', '2 * tp + fp + fn')} AS f1"""

SQL["confusion_matrix"] = with_(SCORED, CM) + "SELECT * FROM cm"
SQL["binary_metrics"] = with_(SCORED, CM) + f"SELECT tn, fp, fn, tp, {METRICS} FROM cm"

SQL["classification_report"] = with_(SCORED, CM, f"""m AS (
  SELECT *, tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS n,
    {sdiv('tn', 'tn + fn')} AS p0, {sdiv('tn', 'tn + fp')} AS r0, {sdiv('2 * tn', '2 * tn + fn + fp')} AS f0,
    {sdiv('tp', 'tp + fp')} AS p1, {sdiv('tp', 'tp + fn')} AS r1, {sdiv('2 * tp', '2 * tp + fp + fn')} AS f1
  FROM cm)""") + f"""
SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM m
UNION ALL SELECT '1', p1, r1, f1, s1 FROM m
UNION ALL SELECT 'accuracy', NULL::DOUBLE, NULL::DOUBLE, {sdiv('tn + tp', 'n')}, n FROM m
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM m
UNION ALL SELECT 'weighted avg', {sdiv('s0::DOUBLE * p0 + s1::DOUBLE * p1', 'n')}, {sdiv('s0::DOUBLE * r0 + s1::DOUBLE * r1', 'n')},
       {sdiv('s0::DOUBLE * f0 + s1::DOUBLE * f1', 'n')}, n FROM m"""

SQL["metrics_at_half"] = with_(SCORED, f"""p AS (SELECT y_true, ({SOFTMAX} >= 0.5)::INTEGER AS y_pred FROM scored),
cm AS (
  SELECT count_if(y_true = 0 AND y_pred = 1) AS fp, count_if(y_true = 1 AND y_pred = 0) AS fn,
         count_if(y_true = 1 AND y_pred = 1) AS tp FROM p)""") + f"""
SELECT {sdiv('2 * tp', '2 * tp + fp + fn')} AS f1_pos, {sdiv('tp', 'tp + fp')} AS precision_pos,
       {sdiv('tp', 'tp + fn')} AS recall_pos FROM cm"""

SQL["pred_positive_rate"] = with_(SCORED) + """
SELECT split, (round((avg(y_pred::DOUBLE)) * 1e9)::BIGINT / 1e9) AS positive_rate_pred FROM scored GROUP BY split"""

CW = """cw AS (
  SELECT 0 AS label, count_if(y_true = 0)::BIGINT AS count,
         count(*)::DOUBLE / (2.0 * greatest(count_if(y_true = 0), 1)::DOUBLE) AS weight
  FROM scored WHERE split = 'train'
  UNION ALL
  SELECT 1, count_if(y_true = 1)::BIGINT, count(*)::DOUBLE / (2.0 * greatest(count_if(y_true = 1), 1)::DOUBLE)
  FROM scored WHERE split = 'train')"""

SQL["class_weights"] = with_(SCORED, CW) + "SELECT label::INTEGER AS label, count, weight FROM cw"

SQL["weighted_log_loss"] = with_(SCORED, CW) + """
SELECT (round((sum(w * nll) / sum(w)) * 1e9)::BIGINT / 1e9) AS loss, (round((sum(w)) * 1e9)::BIGINT / 1e9) AS weight_sum FROM (
  SELECT cw.weight AS w,
         greatest(l0, l1) + ln(exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1)))
           - CASE WHEN y_true = 1 THEN l1 ELSE l0 END AS nll
  FROM scored JOIN cw ON scored.y_true = cw.label)"""

SQL["local_evaluation"] = with_(SCORED, CM) + f"""
SELECT {sdiv('2 * tp', '2 * tp + fp + fn')} AS f1, {sdiv('tp', 'tp + fp')} AS precision,
       {sdiv('tp', 'tp + fn')} AS recall, fp AS false_positives, fn AS false_negatives,
       'score' AS score_column FROM cm"""

SQL["category_recall"] = with_(SCORED, """ex AS (
  SELECT y_pred, unnest(vec) AS v, unnest(range(len(vec))) AS category
  FROM (SELECT y_pred, try_cast(label_raw AS INTEGER[]) AS vec FROM scored) WHERE vec IS NOT NULL)""") + """
SELECT category::INTEGER AS category, count(*)::BIGINT AS support, (round((avg(y_pred::DOUBLE)) * 1e9)::BIGINT / 1e9) AS recall
FROM ex WHERE v = 1 GROUP BY category"""

TOP = with_(SCORED, f"""sd AS (
  SELECT s.*, {clean('d.text')} AS text FROM scored s LEFT JOIN documents d ON d.doc_id = s.record_id)""")
SQL["top_false_positives"] = TOP + """
SELECT record_id, y_true, y_pred, score, score AS mistake_strength, text FROM sd
WHERE y_true = 0 AND y_pred = 1 ORDER BY mistake_strength DESC, record_id LIMIT 50"""
SQL["top_false_negatives"] = TOP + """
SELECT record_id, y_true, y_pred, score, -score AS mistake_strength, text FROM sd
WHERE y_true = 1 AND y_pred = 0 ORDER BY mistake_strength DESC, record_id LIMIT 50"""


def sweep_sql(cand: str, grid: str) -> str:
    """Brute force: every grid point against every score (oracle only)."""
    return f""", ev AS (
  SELECT g.model, g.k, g.t, count_if(c.s >= g.t AND c.y_true = 1)::BIGINT AS tp,
         count_if(c.s >= g.t)::BIGINT AS pp, any_value(g.p) AS p
  FROM {grid} g JOIN {cand} c USING (model) GROUP BY g.model, g.k, g.t),
f AS (SELECT *, {sdiv('2 * tp', 'pp + p')} AS f1 FROM ev),
best AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, k) = 1)
"""


ADAPTIVE_GRID = """, st AS (SELECT model, min(s) AS lo, max(s) AS hi, count_if(y_true = 1) AS p FROM cand GROUP BY model),
grid AS (
  SELECT model, k::INTEGER AS k, CASE WHEN k = 199 THEN hi ELSE k::DOUBLE * ((hi - lo) / 199) + lo END AS t, p
  FROM st, range(200) r(k))"""

SQL["threshold_adaptive"] = with_(SCORED, "cand AS (SELECT 'm' AS model, y_true, score AS s FROM scored)") + \
    ADAPTIVE_GRID.lstrip() + sweep_sql("cand", "grid") + "SELECT k, t AS threshold, tp, pp, f1 FROM best"

FIXED_GRID = """, grid AS (
  SELECT 'm' AS model, k::INTEGER AS k, CASE WHEN k = 198 THEN 0.99 ELSE k::DOUBLE * (0.98::DOUBLE / 198) + 0.01 END AS t,
         (SELECT count_if(y_true = 1) FROM cand) AS p
  FROM range(199) r(k))"""

SQL["threshold_fixed"] = with_(SCORED, f"cand AS (SELECT 'm' AS model, y_true, {SOFTMAX} AS s FROM scored)") + \
    FIXED_GRID.lstrip() + sweep_sql("cand", "grid") + "SELECT k, t AS threshold, tp, pp, (round((f1) * 1e12)::BIGINT / 1e12) AS f1 FROM best"

SQL["leaderboard"] = with_(SCORED, f"""cand AS (
  SELECT 'score' AS model, 0 AS position, y_true, score AS s FROM scored
  UNION ALL SELECT 'prob', 1, y_true, {SOFTMAX} FROM scored
  UNION ALL SELECT 'inverse', 2, y_true, 1 - score FROM scored)""") + ADAPTIVE_GRID.lstrip() + \
    sweep_sql("cand", "grid") + """
SELECT b.model, c.position::INTEGER AS position, b.f1, (round((b.t) * 1e12)::BIGINT / 1e12) AS threshold,
       row_number() OVER (ORDER BY b.f1 DESC, c.position)::INTEGER AS rank
FROM best b JOIN (SELECT DISTINCT model, position FROM cand) c USING (model)"""

SQL["best_checkpoint"] = with_(SCORED, f"""p AS (
  SELECT (record_id % 10)::INTEGER AS step, y_true, ({SOFTMAX} >= 0.5)::INTEGER AS y_pred FROM scored),
cm AS (
  SELECT step, count_if(y_true = 0 AND y_pred = 1) AS fp, count_if(y_true = 1 AND y_pred = 0) AS fn,
         count_if(y_true = 1 AND y_pred = 1) AS tp FROM p GROUP BY step)""") + f"""
SELECT step, {sdiv('2 * tp', '2 * tp + fp + fn')} AS f1_pos, {sdiv('tp', 'tp + fp')} AS precision_pos,
       {sdiv('tp', 'tp + fn')} AS recall_pos
FROM cm ORDER BY f1_pos DESC, step LIMIT 1"""


# ---------------------------------------------------------------------------
# TF-IDF
# ---------------------------------------------------------------------------
TOKEN_RE2 = r"[\p{L}\p{N}_]{2,}"


def normalized(col: str) -> str:
    return f"strip_accents(lower({col}))"


def analyze(src: str, name: str) -> str:
    """(record_id, text) -> (record_id, term, tf) with the same analyzer."""
    return f"""{name}_tk AS (
  SELECT record_id, regexp_extract_all({normalized('text')}, '{TOKEN_RE2}') AS toks FROM {src}),
{name}_tm AS (
  SELECT record_id,
         unnest(list_concat(toks, list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1]))) AS term
  FROM {name}_tk),
{name}_tf AS (SELECT record_id, term, count(*)::BIGINT AS tf FROM {name}_tm GROUP BY ALL)"""


TRAIN = """train AS (
  SELECT s.record_id, c.text FROM split s LEFT JOIN corpus c USING (record_id) WHERE s.split = 'train')"""

DEV_TEST = f"""dt AS (
  SELECT s.record_id, c.text FROM split s LEFT JOIN corpus c USING (record_id) WHERE s.split = 'dev'
  UNION ALL
  SELECT doc_id AS record_id, {clean('text')} AS text FROM documents WHERE doc_id % 10 = 9)"""

VOCAB = """nd AS (SELECT count(*) AS n FROM train),
vocab AS (
  SELECT term, count(*)::BIGINT AS df FROM train_tf GROUP BY term
  HAVING count(*) >= 2 AND count(*)::DOUBLE <= 0.95 * (SELECT n FROM nd)::DOUBLE),
vocabi AS (
  SELECT term, (row_number() OVER (ORDER BY term) - 1)::BIGINT AS idx, df,
         ln((1 + (SELECT n FROM nd))::DOUBLE / (1 + df)::DOUBLE) + 1 AS idf
  FROM vocab)"""


def weights(src_tf: str, name: str) -> str:
    return f"""{name}_w AS (
  SELECT t.record_id, t.term, (1 + ln(t.tf)) * v.idf AS w FROM {src_tf} t JOIN vocabi v USING (term)),
{name}_nr AS (SELECT record_id, sqrt(sum(w * w)) AS nr FROM {name}_w GROUP BY record_id),
{name}_tfidf AS (SELECT record_id, term, w / nr AS weight FROM {name}_w JOIN {name}_nr USING (record_id))"""


TRAIN_VOCAB = with_(CORPUS, SPLIT, TRAIN, analyze("train", "train"), VOCAB)

SQL["normalize_text"] = f"SELECT doc_id, {normalized(clean('text'))} AS text FROM documents"

SQL["word_tokens"] = f"""
SELECT doc_id, len(toks)::INTEGER AS n_tokens, array_to_string(toks, '|') AS tokens
FROM (SELECT doc_id, regexp_extract_all({normalized(clean('text'))}, '{TOKEN_RE2}') AS toks FROM documents)"""

SQL["ngrams"] = f"""
SELECT doc_id, len(terms)::INTEGER AS n_terms, array_to_string(terms, '|') AS terms
FROM (SELECT doc_id, list_concat(toks, list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])) AS terms
      FROM (SELECT doc_id, regexp_extract_all({normalized(clean('text'))}, '{TOKEN_RE2}') AS toks FROM documents))"""

SQL["vocabulary"] = TRAIN_VOCAB + "SELECT term, idx, df FROM vocabi"
SQL["idf"] = TRAIN_VOCAB + "SELECT term, (round((idf) * 1e9)::BIGINT / 1e9) AS idf FROM vocabi"
SQL["sublinear_tf"] = with_(CORPUS, SPLIT, TRAIN, analyze("train", "train")) + """
SELECT record_id, term, tf, (round((1 + ln(tf)) * 1e9)::BIGINT / 1e9) AS sublinear_tf FROM train_tf"""
SQL["tfidf"] = TRAIN_VOCAB.rstrip() + ",\n" + weights("train_tf", "tr") + """
SELECT record_id, term, (round((weight) * 1e9)::BIGINT / 1e9) AS weight FROM tr_tfidf"""
SQL["tfidf_transform"] = TRAIN_VOCAB.rstrip() + ",\n" + DEV_TEST + ",\n" + analyze("dt", "dt") + ",\n" + \
    weights("dt_tf", "dt") + """
SELECT record_id, term, (round((weight) * 1e9)::BIGINT / 1e9) AS weight FROM dt_tfidf"""

for _name in ("logreg", "linearsvc"):
    SQL[f"{_name}_fit"] = TRAIN_VOCAB + f"""
SELECT '{_name}' AS model, (SELECT count(*) FROM vocabi) AS n_features, (SELECT n FROM nd) AS n_rows, true AS optimal"""

FIXED_COEF = "cast(((length(term) * 7) % 11 - 5) as double) / cast(10 as double)"
FIXED_BIAS = -0.25

DECISION = TRAIN_VOCAB.rstrip() + ",\n" + DEV_TEST + ",\n" + analyze("dt", "dt") + ",\n" + weights("dt_tf", "dt") + f""",
sc AS (SELECT record_id, sum(weight * {FIXED_COEF}) AS s FROM dt_tfidf GROUP BY record_id)
"""

SQL["decision_score"] = DECISION + f"""
SELECT dt.record_id, (round((coalesce(sc.s, 0.0) + {FIXED_BIAS}) * 1e9)::BIGINT / 1e9) AS score FROM dt LEFT JOIN sc USING (record_id)"""
SQL["model_roundtrip"] = SQL["decision_score"]

# scores of the fixed model on dev and test rows
_SCORE = f"coalesce(sc.s, 0.0) + {FIXED_BIAS}"
_R9 = "(round(({}) * 1e9)::BIGINT / 1e9)"
DEV_DETAIL = DECISION.rstrip() + f""",
dd AS (
  SELECT s.record_id, s.binary_label, s.label_raw, c.article_id, c.keyword, c.country, c.text, s.binary_label AS y_true,
         ({_SCORE} >= 0.0)::INTEGER AS y_pred, {_SCORE} AS raw_score
  FROM split s LEFT JOIN corpus c USING (record_id) LEFT JOIN sc USING (record_id) WHERE s.split = 'dev'),
scored2 AS (SELECT y_true, y_pred FROM dd)"""
_DETAIL_COLS = "record_id, binary_label, label_raw, article_id, keyword, country, text, y_true, y_pred"

SQL["scored_dev"] = DEV_DETAIL + f"""
SELECT {_DETAIL_COLS}, {_R9.format('raw_score')} AS score FROM dd"""

SQL["scored_test"] = DECISION + f"""
SELECT d.doc_id AS record_id, d.doc_id * 7 AS article_id, d.source AS keyword, d.lang AS country, {clean('d.text')} AS text,
       {_R9.format(_SCORE)} AS score, ({_SCORE} >= 0.0)::INTEGER AS y_pred
FROM documents d LEFT JOIN sc ON sc.record_id = d.doc_id WHERE d.doc_id % 10 = 9"""

_REPORT = SQL["classification_report"]
SQL["dev_report"] = DEV_DETAIL + ",\n" + _REPORT[_REPORT.index("cm AS ("):].replace("FROM scored)", "FROM scored2)")

SQL["error_analysis"] = DEV_DETAIL + f""",
mm AS (
  SELECT *, CASE WHEN y_pred = 1 THEN 'false_positives' ELSE 'false_negatives' END AS kind,
         CASE WHEN y_pred = 1 THEN raw_score ELSE -raw_score END AS strength
  FROM dd WHERE y_true <> y_pred),
rr AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY strength DESC, record_id) AS place FROM mm)
SELECT kind, {_DETAIL_COLS}, {_R9.format('raw_score')} AS score, {_R9.format('strength')} AS mistake_strength FROM rr WHERE place <= 50"""

SQL["deliverables"] = DEV_DETAIL + f""",
both_ AS (
  SELECT 'dev' AS split, y_pred FROM dd
  UNION ALL
  SELECT 'test', ({_SCORE} >= 0.0)::INTEGER FROM documents d LEFT JOIN sc ON sc.record_id = d.doc_id WHERE d.doc_id % 10 = 9)
SELECT split, count(*)::BIGINT AS lines, {_R9.format('avg(y_pred::DOUBLE)')} AS positive_rate, true AS as_in_metadata FROM both_ GROUP BY split"""

SQL["profile_tables"] = SQL["class_distribution"]

# training rows with duplicated ids; a row number tells them apart
REPEATED = with_(CORPUS, SPLIT, TRAIN, """rep AS (
  SELECT row_number() OVER () AS record_id, id, text FROM (
    SELECT record_id AS id, text FROM train
    UNION ALL SELECT record_id, text || ' second copy of a row' FROM train WHERE record_id % 5 = 0
    UNION ALL SELECT record_id, text FROM train WHERE record_id % 7 = 0))""", analyze("rep", "train"),
    VOCAB.replace("FROM train)", "FROM rep)"))
SQL["vocabulary_repeated_ids"] = REPEATED + f"SELECT term, df, {_R9.format('idf')} AS idf FROM vocabi"
SQL["decision_repeated_ids"] = REPEATED.rstrip() + ",\n" + weights("train_tf", "rp") + f""",
sc AS (SELECT record_id, sum(weight * {FIXED_COEF}) AS s FROM rp_tfidf GROUP BY record_id)
SELECT rep.id AS record_id, {_R9.format(_SCORE)} AS score FROM rep LEFT JOIN sc USING (record_id)"""

SQL["model_selection_certificate"] = with_(SPLIT) + """
SELECT m.model, m.position::INTEGER AS position, count(*)::BIGINT AS n_dev, true AS optimal, true AS f1_confirmed, true AS best_chosen
FROM split, (VALUES ('logreg', 0), ('linearsvc', 1)) m(model, position) WHERE split.split = 'dev' GROUP BY ALL"""
SQL["training_history_certificate"] = with_(SPLIT) + """
SELECT 'logreg' AS model, count(*)::BIGINT AS n_dev, true AS every_step_scored, true AS objective_falls,
       true AS earliest_best_chosen, true AS f1_confirmed
FROM split WHERE split.split = 'dev'"""
SQL["score_test_certificate"] = """
SELECT doc_id AS record_id, true AS score_confirmed, true AS prediction_confirmed FROM documents WHERE doc_id % 10 = 9"""

# ---------------------------------------------------------------------------
# Readers / sinks round trips
# ---------------------------------------------------------------------------
SQL["read_corpus_tsv"] = SQL["valid_records"]
SQL["read_corpus_breaks"] = SQL["valid_records"]
SQL["run_files"] = with_(SPLIT) + f"""
SELECT 'dev' AS split, count(*)::BIGINT AS lines, true AS in_manifest, true AS rate_confirmed, true AS f1_confirmed
FROM split WHERE split.split = 'dev' UNION ALL
SELECT 'test', count(*)::BIGINT, true, true, true FROM documents
WHERE regexp_full_match({_na(fx.SAMPLE_ID_RAW)}, 't_[0-9]+') AND regexp_full_match({_na(fx.ARTICLE_ID_RAW)}, '@@[0-9]+')"""
SQL["read_split_csv"] = SQL["dedupe_keep_last"]
SQL["read_test_tsv"] = SQL["valid_test_records"]
SQL["read_scored"] = TOP + "SELECT record_id, y_true, y_pred, score, text FROM sd"
SQL["prediction_lines"] = with_(SCORED) + """
SELECT (row_number() OVER (ORDER BY record_id) - 1)::BIGINT AS line, y_pred FROM scored"""
