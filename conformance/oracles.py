"""DuckDB SQL for the registered queries, written from the rules, not from the Spark code."""

from __future__ import annotations

from voxloom.functions import analysis_texts as X
from voxloom.functions.stopwords import stop_words

# Python's white space, in RE2 notation
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LATIN = "abcdefghijklmnopqrstuvwxyz.,0123"
ARABIC_SCRIPT = "ابةدإفغهيجكلمنأَقرستآىوـّز؛،😀→☀🇸"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def urls(c):
    return rf"regexp_replace({c}, 'https?://[^{WS}]+|www\.[^{WS}]+', ' ', 'g')"


def emoji(c):
    return (
        rf"regexp_replace({c}, '[\x{{1F300}}-\x{{1FAFF}}\x{{2600}}-\x{{27BF}}\x{{1F1E6}}-\x{{1F1FF}}"
        rf"\x{{FE00}}-\x{{FE0F}}\x{{2190}}-\x{{21FF}}]+', ' ', 'g')"
    )


def punctuation(c):
    return rf"regexp_replace({c}, '([!?.,:\-_،؛]){{2,}}', '\1', 'g')"


def arabic(c):
    marks = (
        rf"regexp_replace({c}, '[\x{{0610}}-\x{{061A}}\x{{064B}}-\x{{065F}}\x{{0670}}\x{{06D6}}-\x{{06DC}}"
        rf"\x{{06DF}}-\x{{06E8}}\x{{06EA}}-\x{{06ED}}\x{{0640}}]', '', 'g')"
    )
    return f"translate({marks}, 'أإآىة', 'اااي' || 'ه')"


def elongation(c):
    """Drops a character equal to the two before it; c must be a plain column."""
    s = f"string_split({c}, '')"
    return (
        f"array_to_string(list_transform(list_filter(list_zip({s}, list_prepend('', {s}), "
        f"list_prepend('', list_prepend('', {s}))), lambda z: z[1] IS NOT NULL AND NOT "
        f"(z[1] <> chr(10) AND z[1] = z[2] AND z[1] = z[3])), lambda z: z[1]), '')"
    )


def spaces(c):
    return f"trim(regexp_replace({c}, '[{WS}]+', ' ', 'g'))"


DOCS = "SELECT doc_id AS id, text FROM documents"
PAGES = "SELECT page_id AS id, concat_ws(' ', url, html) AS text FROM pages"
SCRIPT = f"SELECT doc_id AS id, translate(lower(text), '{LATIN}', '{ARABIC_SCRIPT}') AS text FROM documents"


def clean_ctes(source: str, extra: str = "") -> str:
    blank = f"NOT regexp_matches(text, '[^{WS}]')"
    return f"""source AS ({source}),
stripped AS (SELECT *, {arabic(punctuation(emoji(urls('text'))))} AS s1 FROM source),
shortened AS (SELECT *, {elongation('s1')} AS s2 FROM stripped),
prepared AS (SELECT *, CASE WHEN text IS NULL OR {blank} THEN '' ELSE {spaces('s2')} END AS cleaned_text
  FROM shortened),
worded AS (SELECT *, CASE WHEN cleaned_text = '' THEN 0 ELSE len(string_split(cleaned_text, ' ')) END AS n_words
  FROM prepared),
kept AS (SELECT id, text, cleaned_text, count(*) OVER (PARTITION BY cleaned_text) AS frequency
  FROM worded WHERE n_words >= 3)"""


STOPS = "[" + ", ".join(q(w) for w in stop_words()) + "]"
GRAM = "list_concat({t}, list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1]))"

CLEAN = "WITH " + clean_ctes(DOCS)
COMMENTS = (
    CLEAN
    + """,
given AS (SELECT doc_id, lang, CASE WHEN label IS NULL OR label = 9 THEN -1 ELSE label END AS topic_id
  FROM documents LEFT JOIN embeddings ON doc_id = vec_id),
comments AS (SELECT id AS row_id, text AS original_comment, cleaned_text, frequency, lang, topic_id
  FROM kept JOIN given ON id = doc_id),
sizes AS (SELECT topic_id, count(*) AS topic_size FROM comments GROUP BY 1),
totals AS (SELECT sum(topic_size) AS n, sum(topic_size) FILTER (topic_id <> -1) AS assigned,
  coalesce(sum(topic_size) FILTER (topic_id = -1), 0) AS noise, count(*) FILTER (topic_id <> -1) AS n_topics
  FROM sizes),
toks AS (SELECT *, regexp_extract_all(lower(cleaned_text), '[\\p{L}\\p{N}_]{2,}') AS all_toks FROM comments),
stopped AS (SELECT *, list_filter(all_toks, lambda t: NOT list_contains(STOPS, t)) AS toks FROM toks),
grams AS (SELECT row_id, topic_id, unnest(GRAMS) AS term FROM stopped),
doc_terms AS (SELECT row_id, topic_id, term, count(*) AS c FROM grams GROUP BY ALL),
tc AS (SELECT topic_id, term, sum(c)::BIGINT AS cnt, count(*) AS docs FROM doc_terms GROUP BY ALL),
term_totals AS (SELECT term, sum(cnt)::BIGINT AS term_total, sum(docs)::BIGINT AS doc_freq FROM tc GROUP BY 1),
vocab AS (SELECT topic_id, term, cnt, docs, term_total, doc_freq FROM tc JOIN term_totals USING (term)
  WHERE doc_freq >= 2),
classes AS (SELECT sum(cnt)::BIGINT AS all_tokens, (SELECT greatest(n_topics, 1) FROM totals) AS n_topics FROM vocab),
in_topic AS (SELECT topic_id, sum(cnt) AS topic_total FROM vocab GROUP BY 1),
weighted AS (SELECT topic_id, term, cnt * ln(1 + all_tokens::DOUBLE / n_topics / term_total) AS weight
  FROM vocab, classes WHERE topic_id <> -1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term) AS rank FROM weighted),
kw AS (SELECT topic_id, rank::INTEGER AS rank, term, weight / topic_total AS score
  FROM ranked JOIN in_topic USING (topic_id) WHERE rank <= 10),
packed AS (SELECT topic_id, list(term ORDER BY rank) AS kws FROM kw GROUP BY 1),
named AS (SELECT topic_id, topic_size, coalesce(kws, []) AS kws,
  CASE WHEN topic_id <> -1 THEN coalesce((SELECT string_agg(p, '_' ORDER BY r) FROM (
    SELECT replace(term, ' ', '_') AS p, min(rank) AS r FROM kw
    WHERE kw.topic_id = sizes.topic_id AND rank <= 3 GROUP BY 1)), 'topic_unknown') END AS auto_name
  FROM sizes LEFT JOIN packed USING (topic_id)),
topics AS (SELECT *, CASE WHEN topic_id = -1 THEN 'noise' ELSE auto_name END AS topic_name FROM named)"""
).replace("STOPS", STOPS).replace("GRAMS", GRAM.format(t="toks"))

VECTORS = (
    COMMENTS
    + """,
members AS (SELECT row_id, topic_id, lang, original_comment, cleaned_text, embedding::DOUBLE[] AS vec
  FROM comments JOIN embeddings ON row_id = vec_id WHERE topic_id <> -1),
cells AS (SELECT topic_id, unnest(vec) AS v, generate_subscripts(vec, 1) AS p FROM members),
means AS (SELECT topic_id, p, avg(v) AS v FROM cells GROUP BY ALL),
cent AS (SELECT topic_id, list(v ORDER BY p) AS c, (SELECT count(*) FROM members m WHERE m.topic_id = means.topic_id)
  AS n FROM means GROUP BY 1),
simmed AS (SELECT m.*, n, list_dot_product(vec, c) / (sqrt(list_dot_product(vec, vec)) *
  sqrt(list_dot_product(c, c)) + 1e-9) AS sim FROM members m JOIN cent USING (topic_id)),
near AS (SELECT a.topic_id, b.topic_id AS other, list_dot_product(a.c, b.c) / (sqrt(list_dot_product(a.c, a.c)) *
  sqrt(list_dot_product(b.c, b.c)) + 1e-9) AS s FROM cent a JOIN cent b ON a.topic_id <> b.topic_id),
nearest AS (SELECT topic_id, other AS most_similar_topic, s AS similarity FROM near
  QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY s DESC, other) = 1)"""
)


def reps_ctes(k: str, flag: str = r"regexp_matches(cleaned_text, '[\x{0600}-\x{06FF}]')", name: str = "reps") -> str:
    """CTE ``name``(topic_id, rank, row_id, sim, original_comment); k may use n, the topic size."""
    return f"""{name}_uniq AS (SELECT topic_id, n, row_id, sim, original_comment, {flag} AS flag FROM simmed
  QUALIFY row_number() OVER (PARTITION BY topic_id, lower(trim(cleaned_text)) ORDER BY sim DESC, row_id) = 1),
{name}_pos AS (SELECT *, {k} AS k, row_number() OVER (PARTITION BY topic_id ORDER BY sim DESC, row_id) AS pos
  FROM {name}_uniq),
{name}_mix AS (SELECT topic_id, any_value(k) AS k, bool_and(flag) FILTER (pos <= k) AS all_on,
  bool_or(flag) FILTER (pos <= k) AS any_on FROM {name}_pos GROUP BY 1),
{name}_guest AS (SELECT p.topic_id, min(pos) AS guest FROM {name}_pos p JOIN {name}_mix m USING (topic_id)
  WHERE pos > p.k AND ((all_on AND NOT flag) OR (NOT any_on AND flag)) GROUP BY 1),
{name} AS (SELECT topic_id, (CASE WHEN pos = guest THEN k ELSE pos END)::INTEGER AS rank, row_id, sim, original_comment
  FROM {name}_pos LEFT JOIN {name}_guest USING (topic_id)
  WHERE (pos <= k AND NOT (guest IS NOT NULL AND pos = k)) OR pos = guest)"""


ADAPTIVE_K = "least(12, greatest(6, least(n, 12)))"
REPS_COLUMNS = "topic_id, rank, row_id, round(sim, 6) AS sim, original_comment"
NPMI = (
    COMMENTS
    + """,
plain AS (SELECT DISTINCT row_id, unnest(PLAIN_GRAMS) AS term FROM toks),
hits AS (SELECT DISTINCT row_id, term FROM plain WHERE term IN (SELECT term FROM kw)),
freq AS (SELECT term, count(*) AS doc_freq FROM hits GROUP BY 1),
word AS (SELECT topic_id, rank, term, doc_freq FROM kw JOIN freq USING (term)),
pairs AS (SELECT a.topic_id, a.rank AS rank_i, b.rank AS rank_j, a.term AS ti, b.term AS tj,
  a.doc_freq AS di, b.doc_freq AS dj FROM word a JOIN word b ON a.topic_id = b.topic_id AND a.rank < b.rank),
co AS (SELECT ti, tj, count(*) AS together FROM (SELECT DISTINCT ti, tj FROM pairs) JOIN hits x ON x.term = ti
  JOIN hits y ON y.term = tj AND x.row_id = y.row_id GROUP BY ALL),
scored AS (SELECT topic_id, rank_i, rank_j, coalesce(together, 0) AS together,
  CASE WHEN together IS NULL THEN -1.0::DOUBLE WHEN together = n THEN 1.0
  ELSE ln((together / n::DOUBLE) / ((di / n::DOUBLE) * (dj / n::DOUBLE))) / -ln(together / n::DOUBLE) END AS npmi
  FROM pairs LEFT JOIN co USING (ti, tj), totals),
coherence AS (SELECT coalesce(avg(m), 0.0) AS npmi FROM (SELECT topic_id, avg(npmi) AS m FROM scored GROUP BY 1))"""
).replace("PLAIN_GRAMS", GRAM.format(t="all_toks"))
BALANCE = """(SELECT coalesce(1 - (2 * sum(i * s) / (max(i) * sum(s)) - (max(i) + 1) / max(i)), 0.0) FROM (
  SELECT row_number() OVER (ORDER BY topic_size)::DOUBLE AS i, topic_size::DOUBLE AS s FROM sizes WHERE topic_id <> -1))"""
SILHOUETTE = """,
normed AS (SELECT row_id, topic_id, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS u
  FROM members),
dists AS (SELECT a.row_id, a.topic_id, b.topic_id AS other, sum(1 - list_dot_product(a.u, b.u)) AS total,
  count(*) AS m FROM normed a JOIN normed b ON a.row_id <> b.row_id GROUP BY ALL),
sil AS (SELECT row_id, topic_id, avg(total / m) FILTER (other = topic_id) AS own,
  min(total / m) FILTER (other <> topic_id) AS nearest FROM dists GROUP BY ALL),
sil_rows AS (SELECT row_id, topic_id, CASE WHEN own IS NULL THEN 0.0
  ELSE (nearest - own) / greatest(nearest, own) END AS silhouette FROM sil)"""


def params_columns(n: str) -> str:
    return f"""(CASE WHEN {n} >= 3000 THEN 40 WHEN {n} >= 500 THEN 20 WHEN {n} >= 150 THEN 15 ELSE 10 END)::INTEGER
  AS neighbors,
(CASE WHEN {n} < 500 THEN 5 WHEN {n} < 3000 THEN greatest(10, floor({n} * 0.01::DOUBLE))
  ELSE least(100, greatest(30, floor({n} * 0.005::DOUBLE))) END)::INTEGER AS min_cluster_size,
(CASE WHEN {n} < 500 THEN 2 WHEN {n} < 3000 THEN 4 ELSE 8 END)::INTEGER AS min_samples,
{n} < 500 AS is_smoke_test,
CASE WHEN {n} < 500 THEN 'Small dataset smoke test only. Do not judge final topic quality from this sample.'
  ELSE '' END AS warning,
CASE WHEN {n} < 500 THEN 'smoke_test (<500)' WHEN {n} < 3000 THEN 'medium (500-3000)' ELSE 'large (>=3000)' END AS tier"""


STATS = """stats AS (SELECT count(*) AS n_original, count(*) FILTER (cleaned_text = '') AS removed_null,
  count(*) FILTER (cleaned_text <> '' AND n_words < 3) AS removed_short,
  (SELECT count(*) - count(DISTINCT cleaned_text) FROM kept) AS duplicate_count,
  (SELECT count(*) FROM kept) AS n_after FROM worded)"""
METRICS = f"""metrics AS (SELECT 'given' AS engine, 'minilm' AS model, n_topics, noise::BIGINT AS n_noise,
  round(noise / n::DOUBLE, 4) AS noise_rate, round(1 - noise / n::DOUBLE, 4) AS coverage,
  round((SELECT avg(silhouette) FROM sil_rows), 4) AS silhouette,
  round((SELECT npmi FROM coherence), 4) AS npmi_coherence, round({BALANCE}, 4) AS topic_balance,
  0.0::DOUBLE AS runtime_sec FROM totals)"""
RUN = VECTORS + ",\n" + NPMI[len(COMMENTS) + 2 :] + SILHOUETTE + ",\n" + STATS + ",\n" + METRICS + f""",
largest AS (SELECT string_agg(topic_name || ' (' || topic_size || ')', '، ' ORDER BY topic_size DESC, topic_id)
  AS largest_topics FROM (SELECT * FROM topics WHERE topic_id <> -1 ORDER BY topic_size DESC, topic_id LIMIT 5)),
params AS (SELECT {params_columns('n')} FROM totals),
wide AS (SELECT * FROM stats, metrics, largest, params)"""


def key_values(key: str, pairs: list[tuple[str, str]]) -> str:
    rows = [f"SELECT '{name}' AS {key}, coalesce(({value})::VARCHAR, '') AS value FROM wide" for name, value in pairs]
    return "\n" + " UNION ALL\n".join(rows)


NO_META = "'' AS description, '' AS root_cause, '' AS sentiment, '' AS severity, '' AS recommended_actions"
SAMPLES = "samples AS (SELECT topic_id, list(original_comment ORDER BY rank) AS s FROM reps GROUP BY 1)"
TOP3 = ", ".join(f"coalesce(s[{i}], '') AS top_sample_{i}" for i in (1, 2, 3))
PERCENT = "round(100.0::DOUBLE * topic_size / (SELECT greatest(assigned, 1) FROM totals), 2) AS percentage"

DUP = "dup AS (SELECT topic_id, count(*) FILTER (frequency > 1) AS duplicated FROM comments GROUP BY 1)"
NOTE_HEAD, NOTE_TAIL = X.DUPLICATE_NOTE.split("%s")
PAYLOAD = (
    VECTORS
    + ",\n"
    + reps_ctes("8")
    + ",\n"
    + SAMPLES
    + ",\n"
    + DUP
    + f""",
payload AS (SELECT t.topic_id, auto_name, topic_size,
  round(100 * topic_size / (SELECT n FROM totals)::DOUBLE, 1) AS topic_percentage, kws, coalesce(s, []) AS s,
  CASE WHEN duplicated > 0 THEN {q(NOTE_HEAD)} || duplicated || {q(NOTE_TAIL)} ELSE '' END AS duplicate_note
  FROM topics t LEFT JOIN dup USING (topic_id) LEFT JOIN samples USING (topic_id) WHERE t.topic_id <> -1)"""
)
SIZE_PARTS = X.SIZE_LINE.replace("%%", "%").split("%s")
PROMPT = f"""{q(X.TOPIC_PROMPT_HEAD)} || {q(SIZE_PARTS[0])} || topic_size || {q(SIZE_PARTS[1])} || topic_percentage
  || {q(SIZE_PARTS[2])} || CASE WHEN duplicate_note <> '' THEN duplicate_note || chr(10) ELSE '' END
  || {q(X.KEYWORD_LINE)} || array_to_string(kws, {q(X.LIST_COMMA)}) || chr(10) || {q(X.SAMPLES_LINE)}
  || array_to_string(list_transform(s, lambda x: '- ' || x), chr(10)) || {q(X.TOPIC_PROMPT_TAIL)}"""


def answer_ctes(rows: str) -> str:
    """rows: SELECT id, answer. Gives CTE ``checked`` with j, the fields, acts and errs."""
    names = ["business_name", "description", "root_cause", "severity", "sentiment"]
    has = lambda k: f"coalesce(json_exists(j, '$.{k}'), false)"
    trim_ws = lambda c: f"regexp_replace({c}, '^[{WS}]+|[{WS}]+$', '', 'g')"
    fields = ", ".join(
        f"CASE WHEN {has(k)} THEN {trim_ws(f'''coalesce(json_extract_string(j, '$.{k}'), 'None')''')} ELSE '' END AS {k}"
        for k in names
    )
    listed = "json_extract_string(j, '$.recommended_actions[*]')"
    acts = f"""CASE WHEN NOT {has('recommended_actions')} THEN []::VARCHAR[]
      WHEN json_type(j, '$.recommended_actions') = 'ARRAY' THEN {listed}
      ELSE [coalesce(json_extract_string(j, '$.recommended_actions'), 'None')] END"""
    missing = ", ".join(
        f"CASE WHEN NOT {has(k)} THEN {q(X.MISSING_KEY + k)} END" for k in X.REQUIRED_KEYS
    )
    n_words = f"len(list_filter(regexp_split_to_array(business_name, '[{WS}]+'), lambda w: w <> ''))"
    in_list = lambda values: "(" + ", ".join(q(v) for v in values) + ")"
    return f"""asked AS ({rows}),
body AS (SELECT *, regexp_extract(regexp_replace(coalesce(answer, ''), '<think>.*?</think>', '', 'gs'), '\\{{.*\\}}', 0, 's')
  AS b FROM asked),
parsed AS (SELECT *, CASE WHEN b <> '' AND json_valid(b) THEN b::JSON END AS j FROM body),
fielded AS (SELECT *, {fields}, list_filter(list_transform({acts}, lambda a: {trim_ws("coalesce(a, 'None')")}),
  lambda a: a <> '') AS acts FROM parsed),
checked AS (SELECT *, list_filter([{missing},
  CASE WHEN severity NOT IN {in_list(X.SEVERITIES)} THEN {q(X.BAD_SEVERITY)} END,
  CASE WHEN sentiment NOT IN {in_list(X.SENTIMENTS)} THEN {q(X.BAD_SENTIMENT)} END,
  CASE WHEN len(acts) <> 3 THEN {q(X.BAD_ACTIONS)} END,
  CASE WHEN business_name IN {in_list(X.GENERIC_NAMES)} OR {n_words} < 2 OR {n_words} > 4 THEN {q(X.BAD_NAME)} END],
  lambda e: e IS NOT NULL) AS errs FROM fielded)"""


def fallback_sql(kws: str) -> str:
    spoken = f"flatten(list_transform({kws}[1:4], lambda k: string_split(k, ' ')))"
    distinct = f"list_filter({spoken}, lambda w, i: list_position({spoken}, w) = i)"
    joined = f"array_to_string(({distinct})[1:3], ' ')"
    return (
        f"CASE len({distinct}) WHEN 0 THEN {q(X.FALLBACK_NAME)} WHEN 1 THEN {joined} || {q(X.FALLBACK_NAME_PAD)} "
        f"ELSE {joined} END"
    )


def oracle_sql_map(document_answer: str, topic_answer: str) -> dict[str, str]:
    doc_checked = "WITH " + answer_ctes(f"SELECT doc_id AS id, {document_answer} AS answer FROM documents")
    fallback = f"""{fallback_sql('kws')} AS business_name, {q(X.FALLBACK_DESCRIPTION)} AS description,
      {q(X.FALLBACK_ROOT_CAUSE)} AS root_cause, {q(X.FALLBACK_SEVERITY)} AS severity,
      {q(X.FALLBACK_SENTIMENT)} AS sentiment, {q(' | '.join(X.FALLBACK_ACTIONS))} AS recommended_actions"""
    staged = (
        PAYLOAD
        + ",\n"
        + answer_ctes(
            f"SELECT topic_id, attempt, auto_name, kws, {topic_answer} AS answer FROM payload, (VALUES (0), (1)) a(attempt)"
        )
        + f""",
valid AS (SELECT topic_id, attempt, business_name, description, root_cause, severity, sentiment,
  array_to_string(acts, ' | ') AS recommended_actions FROM checked WHERE len(errs) = 0
  QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY attempt) = 1),
outputs AS (SELECT topic_id, CASE attempt WHEN 0 THEN 'llm' ELSE 'llm_retry' END AS source, * EXCLUDE (topic_id, attempt)
  FROM valid UNION ALL BY NAME SELECT topic_id, 'fallback' AS source, {fallback} FROM payload
  WHERE topic_id NOT IN (SELECT topic_id FROM valid)),
attributed AS (SELECT t.topic_id, t.topic_size, t.kws, o.* EXCLUDE (topic_id),
  coalesce(nullif(business_name, ''), topic_name) AS topic_name FROM topics t LEFT JOIN outputs o USING (topic_id))"""
    )
    line = X.EXECUTIVE_LINE.split("%s")
    summary_reps = reps_ctes(ADAPTIVE_K)
    adaptive = VECTORS + ",\n" + summary_reps
    named_reps = staged + ",\n" + reps_ctes(ADAPTIVE_K, name="areps") + (
        ",\nasamples AS (SELECT topic_id, list(original_comment ORDER BY rank) AS s FROM areps GROUP BY 1)"
    )
    sql = {
        "drop_urls": f"SELECT page_id, {urls('text')} AS result FROM ({PAGES.replace('page_id AS id', 'page_id')})",
        "drop_emoji": f"SELECT id AS doc_id, {emoji('text')} AS result FROM ({SCRIPT})",
        "collapse_punctuation": f"SELECT doc_id, {punctuation('text')} AS result FROM documents",
        "unify_arabic": f"SELECT id AS doc_id, {arabic('text')} AS result FROM ({SCRIPT})",
        "shorten_elongation": f"SELECT doc_id, {elongation('text')} AS result FROM documents",
        "normalize_spaces": f"SELECT doc_id, {spaces('text')} AS result FROM documents",
        "clean_documents": CLEAN + " SELECT id AS doc_id, cleaned_text FROM prepared",
        "clean_pages": f"WITH {clean_ctes(PAGES)} SELECT id AS page_id, cleaned_text FROM prepared",
        "clean_arabic_script": f"WITH {clean_ctes(SCRIPT)} SELECT id AS doc_id, cleaned_text FROM prepared",
        "clean_conversations": "WITH "
        + clean_ctes("SELECT conv_id, turn, role, text, conv_id AS id FROM conversations")
        + " SELECT conv_id, turn, role, cleaned_text FROM prepared",
        "word_counts": CLEAN + " SELECT id AS doc_id, n_words FROM worded",
        "language_flags": rf"""SELECT id AS doc_id, script, regexp_matches(text, '[\x{{0600}}-\x{{06FF}}]') AS has_arabic
  FROM (SELECT *, 'arabic' AS script FROM ({SCRIPT}) UNION ALL SELECT *, 'latin' FROM ({DOCS}))""",
        "dedup_keys": CLEAN
        + """ SELECT sha256(lower(trim(cleaned_text))) AS text_key, count(*) AS n, min(id) AS first_row
  FROM kept GROUP BY 1""",
        "encoder_inputs": CLEAN + " SELECT id AS doc_id, 'query: ' || cleaned_text AS encoder_input FROM kept",
        "previews": "SELECT doc_id, CASE WHEN length(text) > 120 THEN text[1:120] || '…' ELSE text END AS preview FROM documents",
        "clean_stats": CLEAN + ", " + STATS + " SELECT * FROM stats",
        "clean_stats_pages": f"WITH {clean_ctes(PAGES)}, {STATS} SELECT * FROM stats",
        "clean_frequency": CLEAN + " SELECT id AS row_id, cleaned_text, frequency FROM kept",
        "clean_comments_arabic": f"""WITH {clean_ctes(SCRIPT)} SELECT id AS original_row_index, text AS original_comment,
  cleaned_text, frequency FROM kept""",
        "token_counts": COMMENTS + " SELECT token, count(*) AS n FROM (SELECT unnest(all_toks) AS token FROM toks) GROUP BY 1",
        "stop_word_hits": COMMENTS
        + f""" SELECT token, count(*) AS n, list_contains({STOPS}, token) AS is_stop_word
  FROM (SELECT unnest(all_toks) AS token FROM toks) GROUP BY 1""",
        "gram_counts": COMMENTS + " SELECT term AS gram, count(*) AS n FROM grams GROUP BY 1",
        "doc_term_counts": COMMENTS + " SELECT * FROM tc",
        "term_totals": COMMENTS + " SELECT * FROM term_totals",
        "frequent_terms": COMMENTS + " SELECT * FROM vocab",
        "mean_class_tokens": COMMENTS
        + " SELECT all_tokens, n_topics, round(all_tokens::DOUBLE / n_topics, 6) AS mean_tokens FROM classes",
        "ctfidf_top10": COMMENTS + " SELECT topic_id, rank, term, round(score, 9) AS score FROM kw",
        "candidate_vocabulary": COMMENTS + " SELECT DISTINCT term FROM kw",
        "auto_names": COMMENTS + " SELECT topic_id, auto_name FROM topics WHERE topic_id <> -1",
        "display_names": COMMENTS
        + " SELECT topic_id, topic_name, topic_size, array_to_string(kws, ', ') AS keywords FROM topics",
        "unit_vectors": """SELECT vec_id, 1.0::DOUBLE AS length,
  round(v[1] / sqrt(list_dot_product(v, v)), 6) AS first_value
  FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)""",
        "supplied_members": COMMENTS
        + """, held AS (SELECT vec_id AS row_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT row_id, (p - 1)::INTEGER AS place, round(v[p] / sqrt(list_dot_product(v, v)), 6) AS value
FROM comments JOIN held USING (row_id), unnest(range(1, len(v) + 1)) AS t(p)""",
        "topic_centroids": VECTORS
        + " SELECT topic_id, n, (p - 1)::INTEGER AS position, round(v, 6) AS value FROM means JOIN cent USING (topic_id)",
        "centroid_similarity": VECTORS + " SELECT row_id, topic_id, round(sim, 6) AS sim FROM simmed",
        "nearest_topic": VECTORS
        + " SELECT topic_id, most_similar_topic, round(similarity, 6) AS similarity FROM nearest",
        "representatives_k3": VECTORS + ",\n" + reps_ctes("3") + f" SELECT {REPS_COLUMNS} FROM reps",
        "representatives_mix": VECTORS + ",\n" + reps_ctes("3", "lang <> 'en'") + f" SELECT {REPS_COLUMNS} FROM reps",
        "representatives_adaptive_k": adaptive + f" SELECT {REPS_COLUMNS} FROM reps",
        "first_rows": COMMENTS
        + """ SELECT topic_id, row_id, row_number() OVER (PARTITION BY topic_id ORDER BY row_id)::INTEGER AS rank,
  original_comment FROM comments WHERE topic_id <> -1 QUALIFY rank <= 6""",
        "topic_sizes": COMMENTS + " SELECT * FROM sizes",
        "noise_share": COMMENTS
        + """ SELECT n::BIGINT AS n, n_topics, noise::BIGINT AS n_noise, round(noise / n::DOUBLE, 4) AS noise_rate,
  round(1 - noise / n::DOUBLE, 4) AS coverage FROM totals""",
        "topic_balance": COMMENTS + f" SELECT round({BALANCE}, 6) AS topic_balance",
        "keyword_document_frequency": NPMI + " SELECT topic_id, rank, term, doc_freq FROM word",
        "npmi_pairs": NPMI + " SELECT topic_id, rank_i, rank_j, together, round(npmi, 6) AS npmi FROM scored",
        "npmi": NPMI + " SELECT round(npmi, 6) AS npmi_coherence FROM coherence",
        "silhouette_rows": VECTORS + SILHOUETTE + " SELECT row_id, topic_id, round(silhouette, 6) AS silhouette FROM sil_rows",
        "silhouette_cosine": VECTORS + SILHOUETTE + " SELECT round(avg(silhouette), 6) AS silhouette FROM sil_rows",
        "metrics_row": RUN + " SELECT * FROM metrics",
        "size_parameters": f"""WITH sized AS (
  SELECT 'documents ' || lang AS grp, count(*) AS n FROM documents GROUP BY 1
  UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'pages', count(*) FROM pages
  UNION ALL SELECT 'orders ' || o_orderstatus, count(*) FROM orders GROUP BY 1
  UNION ALL SELECT 'lineitem ' || l_returnflag || l_linestatus, count(*) FROM lineitem GROUP BY 1
  UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
SELECT grp, n, {params_columns('n')}, n >= 1000 AS needs_fallback,
  least(50, greatest(10, n // 250))::INTEGER AS fallback_k, {ADAPTIVE_K}::INTEGER AS rep_count FROM sized""",
        "feedback_with_topics": COMMENTS
        + """ SELECT row_id AS original_row_index, original_comment, cleaned_text, topic_id, topic_name,
  array_to_string(kws, ', ') AS keywords, '' AS sentiment, '' AS severity FROM comments JOIN topics USING (topic_id)""",
        "topic_summary": adaptive
        + ",\n"
        + SAMPLES
        + f""" SELECT topic_id, topic_name, topic_size AS count, {PERCENT}, array_to_string(kws, ', ') AS keywords,
  topic_name AS business_name, {NO_META}, {TOP3} FROM topics LEFT JOIN samples USING (topic_id)
  WHERE topic_id <> -1""",
        "topic_samples": adaptive
        + " SELECT topic_id, topic_name, original_comment AS sample_comment FROM reps JOIN topics USING (topic_id)",
        "noise_comments": COMMENTS
        + """ SELECT row_id AS original_row_index, original_comment, cleaned_text, frequency FROM comments
  WHERE topic_id = -1""",
        "quality_check": VECTORS
        + ",\n"
        + reps_ctes("3")
        + ",\n"
        + SAMPLES
        + """ SELECT topic_id, topic_size, round(100 * topic_size / n::DOUBLE, 2) AS topic_percentage,
  round(100 * noise / n::DOUBLE, 2) AS noise_percentage, array_to_string(kws, ', ') AS top_keywords,
  coalesce(array_to_string(s, ' || '), '') AS representative_comments, most_similar_topic,
  round(similarity, 3) AS similarity, array_to_string(list_filter([
    CASE WHEN topic_size < greatest(5, floor(0.01::DOUBLE * n)) THEN 'توبيك صغير' END,
    CASE WHEN len(kws) = 0 THEN 'بدون كلمات واضحة' END,
    CASE WHEN similarity > 0.9 THEN 'يشبه التوبيك ' || most_similar_topic END], lambda x: x IS NOT NULL), '; ') AS flags
  FROM topics LEFT JOIN nearest USING (topic_id) LEFT JOIN samples USING (topic_id), totals WHERE topic_id <> -1""",
        "largest_topics": RUN + " SELECT largest_topics FROM largest",
        "overview": RUN
        + key_values(
            "metric",
            [
                ("total_rows", "n_original"),
                ("clean_rows", "n_after"),
                ("duplicate_count", "duplicate_count"),
                ("number_of_topics", "n_topics"),
                ("noise_count", "n_noise"),
                ("noise_percentage", "round(noise_rate * 100, 2)::VARCHAR || '%'"),
                ("largest_topics", "largest_topics"),
                ("kmeans_fallback_triggered", "'NO'"),
                ("dataset_tier", "tier"),
                ("smoke_test", "CASE WHEN is_smoke_test THEN 'YES' ELSE 'NO' END"),
                ("warning", "warning"),
            ],
        ),
        "settings": RUN
        + key_values(
            "setting",
            [
                ("embedding_model", "'sentence-transformers/paraphrase-multilingual-MiniLM-L12-v2'"),
                ("engine", "engine"),
                ("llm_model", "'Qwen3-4B-Q4_K_M.gguf'"),
                ("dim_reducer", "'pca'"),
                ("umap_n_neighbors", "neighbors"),
                ("hdbscan_min_cluster_size", "min_cluster_size"),
                ("hdbscan_min_samples", "min_samples"),
                ("clusterer_used", "'given'"),
                ("kmeans_fallback", "false"),
                ("dataset_tier", "tier"),
                ("n_original_rows", "n_original"),
                ("n_rows_after_cleaning", "n_after"),
                ("removed_null", "removed_null"),
                ("removed_short", "removed_short"),
                ("duplicate_count", "duplicate_count"),
                ("total_topics", "n_topics"),
                ("noise_comments", "n_noise"),
                ("noise_rate", "noise_rate"),
                ("silhouette", "silhouette"),
                ("npmi_coherence", "npmi_coherence"),
                ("runtime_sec", "runtime_sec"),
            ],
        ),
        "validation_preview": COMMENTS
        + """, top AS (SELECT * FROM topics WHERE topic_id <> -1 ORDER BY topic_size DESC, topic_id LIMIT 15)
SELECT topic_id, topic_name, topic_size, row_number() OVER (PARTITION BY topic_id ORDER BY row_id)::INTEGER AS rank,
  CASE WHEN length(original_comment) > 120 THEN original_comment[1:120] || '…' ELSE original_comment END AS comment
  FROM comments JOIN top USING (topic_id) QUALIFY rank <= 5""",
        "chart_top10": COMMENTS
        + """ SELECT 'T' || topic_id AS label, topic_size AS count FROM topics WHERE topic_id <> -1
  ORDER BY topic_size DESC, topic_id LIMIT 10""",
        "chart_share": COMMENTS
        + """ SELECT 'T' || topic_id AS label, round(100.0::DOUBLE * topic_size / assigned, 6) AS percentage
  FROM topics, totals WHERE topic_id <> -1""",
        "chart_noise": COMMENTS
        + """ SELECT label, c::BIGINT AS comments, round(100.0::DOUBLE * c / n, 6) AS percentage FROM (
  SELECT 'Assigned' AS label, assigned AS c, n FROM totals UNION ALL SELECT 'Noise', noise, n FROM totals)""",
        "topic_payload": PAYLOAD
        + """ SELECT topic_id, auto_name, topic_size, topic_percentage, array_to_string(kws, '|') AS keywords,
  array_to_string(s, '|') AS samples, duplicate_note FROM payload""",
        "topic_prompts": PAYLOAD + f" SELECT topic_id, {PROMPT} AS prompt FROM payload",
        "duplicated_members": COMMENTS + ", " + DUP + " SELECT * FROM dup",
        "parse_answers": doc_checked
        + """ SELECT id AS doc_id, j IS NOT NULL AS is_json, business_name, description, root_cause, severity, sentiment,
  array_to_string(acts, ' | ') AS recommended_actions FROM checked""",
        "validate_answers": doc_checked
        + " SELECT id AS doc_id, len(errs) = 0 AS is_valid, array_to_string(errs, '; ') AS errors FROM checked",
        "retry_prompts": doc_checked
        + f""" SELECT id AS doc_id, 'prompt ' || id || {q(X.RETRY_HEAD)} || array_to_string(errs, {q(X.RETRY_SEPARATOR)})
  || {q(X.RETRY_TAIL)} AS prompt FROM checked WHERE len(errs) > 0""",
        "fallback_names": COMMENTS
        + f" SELECT row_id AS doc_id, {fallback_sql('all_toks')} AS business_name FROM toks",
        "naming_staged": staged + " SELECT * FROM outputs",
        "naming_resume": staged
        + f""" SELECT topic_id, 'stored' AS source, {fallback} FROM payload WHERE topic_id % 2 = 0
  UNION ALL BY NAME SELECT * FROM outputs WHERE topic_id % 2 <> 0""",
        "exec_prompt": staged
        + f""" SELECT {q(X.EXECUTIVE_HEAD)} || string_agg({q(line[0])} || topic_name || {q(line[1])} || topic_size || {q(line[2])}
  || coalesce(nullif(description, ''), array_to_string(kws[1:6], {q(X.LIST_COMMA)})), chr(10) ORDER BY topic_id)
  || {q(X.EXECUTIVE_TAIL)} AS prompt FROM attributed WHERE topic_id <> -1""",
        "topic_summary_named": named_reps
        + f""" SELECT topic_id, topic_name, topic_size AS count, {PERCENT}, array_to_string(kws, ', ') AS keywords,
  business_name, description, root_cause, sentiment, severity, recommended_actions, {TOP3}
  FROM attributed LEFT JOIN asamples USING (topic_id) WHERE topic_id <> -1""",
        "feedback_named": staged
        + """ SELECT row_id AS original_row_index, original_comment, cleaned_text, topic_id, topic_name,
  array_to_string(kws, ', ') AS keywords, coalesce(sentiment, '') AS sentiment, coalesce(severity, '') AS severity
  FROM comments JOIN attributed USING (topic_id)""",
        "csv_roundtrip": "SELECT doc_id, text, lang FROM documents",
        "csv_legacy_encoding": rf"""SELECT id AS doc_id,
  regexp_replace(text, '[^\x20-\x7e\x{{0621}}-\x{{063A}}\x{{0641}}-\x{{064A}}]', '', 'g') AS text FROM ({SCRIPT})""",
        "row_positions": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_position FROM documents",
        "dataset_signature": """WITH d AS (SELECT ('0x' || md5(doc_id || ':' || text)[1:15])::BIGINT AS h FROM documents)
SELECT md5(concat_ws('-', count(*), sum(h), bit_xor(h), ''))[1:12] AS signature FROM d""",
        "neighbour_graph": """WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
ranked AS (SELECT l.id, r.id AS other, 1 - list_cosine_similarity(l.v, r.v) AS d,
  row_number() OVER (PARTITION BY l.id ORDER BY 1 - list_cosine_similarity(l.v, r.v), r.id) AS place
  FROM v l JOIN v r ON l.id <> r.id)
SELECT id, place::INTEGER AS place, other, round(d, 6) AS distance FROM ranked WHERE place <= 15""",
        "vector_cache": """SELECT vec_id AS row_id, len(embedding)::INTEGER AS width,
  round(embedding[1]::DOUBLE, 6) AS first_value FROM embeddings""",
        "checkpoint_roundtrip": COMMENTS + " SELECT topic_id, row_id, topic_size FROM comments JOIN sizes USING (topic_id)",
        "sink_roundtrip": COMMENTS
        + """ SELECT row_id AS original_row_index, original_comment, cleaned_text, frequency, topic_size
  FROM comments JOIN sizes USING (topic_id) WHERE topic_id = -1""",
    }
    return sql
