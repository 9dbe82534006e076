"""The registered queries once more, as SQL for an independent engine.

The steps are written out plainly (every cleaning step by itself, cross joins, whole-table
windows): this is the check, run on small tables, not the way the engine works.
"""

from __future__ import annotations

from wordloom.functions.words import STOPWORDS

SPACE = r"[\s\x0B]"
WIDE_SPACE = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
STOP = ", ".join(f"'{word}'" for word in STOPWORDS)


def classic(text: str) -> str:
    steps = f"regexp_replace(trim({text}), '<br{SPACE}*/?>', ' ', 'g')"
    steps = f"regexp_replace({steps}, '[^\\w\\s\\x0B]', ' ', 'g')"
    return f"trim(regexp_replace({steps}, '{SPACE}+', ' ', 'g'))"


def light(text: str) -> str:
    steps = f"regexp_replace(coalesce({text}, ''), '<br{WIDE_SPACE}*/?>', ' ', 'g')"
    steps = f"regexp_replace({steps}, '<[^>]+>', '', 'g')"
    return f"trim(regexp_replace({steps}, '{WIDE_SPACE}+', ' ', 'g'))"


def bucket(seed: int, buckets: int) -> str:
    return f"(CAST('0x' || substr(md5('{seed}:' || doc_id), 1, 8) AS BIGINT) % {buckets})"


def kept(word: str = "word") -> str:
    return f"length({word}) BETWEEN 2 AND 50 AND {word} NOT IN ({STOP})"


TEXTS = f"""
reviews AS (
  SELECT d.doc_id, d.text, CAST(l.quality AS INTEGER) AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
),
clean_reviews AS (
  SELECT * FROM (SELECT doc_id, {classic("text")} AS text, label FROM reviews) WHERE text <> ''
),
clean_documents AS (
  SELECT * FROM (SELECT doc_id, {classic("text")} AS text FROM documents) WHERE text <> ''
),
light_documents AS (
  SELECT * FROM (SELECT doc_id, {light("text")} AS text FROM documents) WHERE text <> ''
)"""


def words_of(source: str, name: str) -> str:
    """(doc_id, pos, word) of a cleaned text table."""
    return f"""
{name} AS (
  SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS word
  FROM (SELECT doc_id, string_split(lower(text), ' ') AS w FROM {source})
)"""


def counts_of(words: str, name: str) -> str:
    """(word, total_count, doc_freq) of the kept words."""
    return f"""
{name} AS (
  SELECT word, CAST(count(*) AS BIGINT) AS total_count,
         CAST(count(DISTINCT doc_id) AS BIGINT) AS doc_freq
  FROM {words} WHERE {kept()} GROUP BY word
)"""


def bounded(counts: str, docs: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT c.* FROM {counts} c, (SELECT count(*) AS n FROM {docs}) t
  WHERE doc_freq >= greatest(2, CAST(floor(n * CAST(0.01 AS DOUBLE)) AS BIGINT))
    AND doc_freq <= CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT)
)"""


def vocab_of(bounds: str, docs: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT word, doc_freq, CAST(row_number() OVER (ORDER BY total_count DESC, word) - 1 AS INTEGER)
           AS index,
         ln((n + 1) / CAST(doc_freq + 1 AS DOUBLE)) AS idf
  FROM {bounds}, (SELECT count(*) AS n FROM {docs})
  ORDER BY total_count DESC, word LIMIT 5000
)"""


def query(final: str, *ctes: str) -> str:
    return "WITH" + ",".join((TEXTS, *ctes)) + "\n" + final


WORDS = words_of("clean_reviews", "words")
DOC_WORDS = words_of("clean_documents", "doc_words")
DOC_COUNTS = counts_of("doc_words", "doc_counts")
DOC_BOUNDS = bounded("doc_counts", "clean_documents", "doc_bounds")
DOC_VOCAB = vocab_of("doc_bounds", "clean_documents", "doc_vocab")
COUNTS = counts_of("words", "counts")
BOUNDS = bounded("counts", "clean_reviews", "bounds")
VOCAB = vocab_of("bounds", "clean_reviews", "vocab")
REVIEW_FEATURES = (WORDS, COUNTS, BOUNDS, VOCAB, """
terms AS (
  SELECT w.doc_id, w.word, v.index, v.idf, CAST(count(*) AS BIGINT) AS tf
  FROM words w JOIN vocab v ON w.word = v.word GROUP BY ALL
)""")


def grams_of(docs: str, words: str) -> tuple[str, ...]:
    """Kept words and pairs of neighbouring kept words, and the vocabulary of both."""
    return (words_of(docs, words), f"""
kept_words AS (SELECT doc_id, pos, word FROM {words} WHERE {kept()}),
grams AS (
  SELECT doc_id, word, 1 AS m FROM kept_words
  UNION ALL
  SELECT doc_id, word || ' ' || following, 2 FROM (
    SELECT doc_id, word, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS following
    FROM kept_words) WHERE following IS NOT NULL
),
gram_counts AS (
  SELECT word, m, count(*) AS total_count, count(DISTINCT doc_id) AS doc_freq
  FROM grams GROUP BY word, m
)""", bounded("gram_counts", docs, "gram_bounds"), vocab_of("gram_bounds", docs, "gram_vocab"), """
gram_terms AS (
  SELECT g.doc_id, g.word, v.index, v.idf, CAST(count(*) AS BIGINT) AS tf
  FROM grams g JOIN gram_vocab v ON g.word = v.word GROUP BY ALL
)""")


TOP_K = "ORDER BY total_count DESC, word LIMIT 10000"
IDS = (words_of("light_documents", "light_words"), """
ids AS (
  SELECT word, CAST(3 + row_number() OVER (ORDER BY word) AS INTEGER) AS word_id
  FROM (SELECT word, count(*) AS n FROM light_words WHERE word <> '' GROUP BY word)
  WHERE n >= 2
)""")


def bayes(
    fits: str,
    smoothing: str,
    scored: str,
    blocks: tuple[str, ...] = ("bow", "tfidf"),
    more: str = "SELECT 0 AS fit, 0 AS doc_id WHERE false",
) -> tuple[str, ...]:
    """Naive Bayes over counts and TF-IDF, for several training sets and smoothings at once.

    `fits`: rows (fit, doc_id, label) to train on; `scored`: rows (fit, doc_id) to score;
    `smoothing`: a VALUES list of (step, smoothing); `blocks`: the features that are used;
    `more`: rows (fit, doc_id) whose texts count for the vocabulary alone.
    """
    mass = " + ".join(f"sum({block})" for block in blocks)
    weight = " + ".join({"bow": "theta_bow", "tfidf": "idf * theta_tfidf"}[b] for b in blocks)
    return (
        DOC_WORDS,
        f"""
fits AS ({fits}),
scored AS ({scored}),
smoothing(step, lam) AS (VALUES {smoothing}),
doc_terms AS (
  SELECT doc_id, word, count(*) AS tf FROM doc_words WHERE {kept()} GROUP BY ALL
),
vocab_texts AS (SELECT fit, doc_id FROM fits UNION ALL {more}),
fit_size AS (SELECT fit, count(*) AS n FROM vocab_texts GROUP BY fit),
fit_counts AS (
  SELECT fit, word, sum(tf) AS total_count, count(*) AS doc_freq
  FROM vocab_texts JOIN doc_terms USING (doc_id) GROUP BY ALL
),
fit_vocab AS (
  SELECT c.fit, c.word, c.doc_freq, ln((n + 1) / CAST(doc_freq + 1 AS DOUBLE)) AS idf,
         row_number() OVER (PARTITION BY c.fit ORDER BY total_count DESC, c.word) AS place
  FROM fit_counts c JOIN fit_size s ON c.fit = s.fit
  WHERE doc_freq >= greatest(2, CAST(floor(n * CAST(0.01 AS DOUBLE)) AS BIGINT))
    AND doc_freq <= CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT)
  QUALIFY place <= 5000
),
class_size AS (SELECT fit, label, count(*) AS n_docs FROM fits GROUP BY ALL),
priors AS (
  SELECT step, fit, label, n_docs, ln((n_docs + lam) / CAST(
           sum(n_docs) OVER (PARTITION BY step, fit)
           + lam * count(*) OVER (PARTITION BY step, fit) AS DOUBLE)) AS log_prior
  FROM class_size, smoothing
),
class_words AS (
  SELECT f.fit, f.label, t.word, CAST(sum(tf) AS DOUBLE) AS bow, sum(tf * idf) AS tfidf
  FROM fits f JOIN doc_terms t ON f.doc_id = t.doc_id
  JOIN fit_vocab v ON v.fit = f.fit AND v.word = t.word GROUP BY ALL
),
grid AS (
  SELECT v.fit, c.label, v.word, v.idf, coalesce(w.bow, 0) AS bow, coalesce(w.tfidf, 0) AS tfidf
  FROM fit_vocab v JOIN class_size c ON v.fit = c.fit
  LEFT JOIN class_words w ON w.fit = v.fit AND w.label = c.label AND w.word = v.word
),
mass AS (
  SELECT fit, label, {mass} AS total, {len(blocks)} * count(*) AS n_features
  FROM grid GROUP BY ALL
),
theta AS (
  SELECT step, g.fit, g.label, g.word, g.idf,
         ln((bow + lam) / (total + lam * n_features)) AS theta_bow,
         ln((tfidf + lam) / (total + lam * n_features)) AS theta_tfidf
  FROM grid g JOIN mass m ON g.fit = m.fit AND g.label = m.label, smoothing
),
weights AS (
  SELECT step, fit, word,
         sum(CASE WHEN label = 1 THEN 1 ELSE -1 END * ({weight})) AS weight
  FROM theta GROUP BY ALL
),
bias AS (
  SELECT step, fit, sum(CASE WHEN label = 1 THEN 1 ELSE -1 END * log_prior) AS bias
  FROM priors GROUP BY ALL
),
evidence AS (
  SELECT s.fit, s.doc_id, w.step, sum(t.tf * w.weight) AS evidence
  FROM scored s JOIN doc_terms t ON s.doc_id = t.doc_id
  JOIN weights w ON w.fit = s.fit AND w.word = t.word GROUP BY ALL
),
margins AS (
  SELECT s.fit, b.step, s.doc_id, bias + coalesce(evidence, 0) AS margin
  FROM scored s JOIN bias b ON s.fit = b.fit
  LEFT JOIN evidence e ON e.fit = s.fit AND e.step = b.step AND e.doc_id = s.doc_id
),
scores AS (
  SELECT m.fit, m.step, m.doc_id, r.label, margin,
         CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction,
         1 / (1 + exp(greatest(-700, least(700, margin)))) AS probability_negative,
         1 / (1 + exp(greatest(-700, least(700, -margin)))) AS probability_positive
  FROM margins m LEFT JOIN clean_reviews r ON m.doc_id = r.doc_id
)""",
    )


TRAIN = f"SELECT 0 AS fit, doc_id, label FROM clean_reviews WHERE {bucket(42, 100)} >= 20"
HELD_OUT = f"SELECT 0 AS fit, doc_id FROM clean_reviews WHERE {bucket(42, 100)} < 20"
ALL_DOCS = "SELECT 0 AS fit, doc_id FROM clean_documents"
ONE = "(0, CAST(1 AS DOUBLE))"
THREE = "(0, CAST(0.5 AS DOUBLE)), (1, CAST(1 AS DOUBLE)), (2, CAST(2 AS DOUBLE))"
HELD_OUT_BAYES = bayes(TRAIN, ONE, HELD_OUT)
DOCUMENT_BAYES = bayes(TRAIN, ONE, ALL_DOCS)
FOLD_BAYES = bayes(
    "SELECT CAST(f AS INTEGER) AS fit, doc_id, label FROM clean_reviews, range(5) r(f) "
    f"WHERE {bucket(42, 5)} <> f",
    THREE,
    f"SELECT CAST({bucket(42, 5)} AS INTEGER) AS fit, doc_id FROM clean_reviews",
)
CONFUSION = """
confusion AS (
  SELECT label, CAST(prediction AS INTEGER) AS prediction, CAST(count(*) AS BIGINT) AS n
  FROM scores GROUP BY ALL
)"""
WEIGHTED = """
classes AS (
  SELECT c.label, (SELECT sum(n) FROM confusion) AS total,
         (SELECT sum(n) FROM confusion x WHERE x.label = c.label) AS actual,
         coalesce((SELECT sum(n) FROM confusion x WHERE x.prediction = c.label), 0) AS predicted,
         coalesce((SELECT sum(n) FROM confusion x
                   WHERE x.label = c.label AND x.prediction = c.label), 0) AS hits
  FROM (SELECT DISTINCT label FROM confusion) c
),
rates AS (
  SELECT total, actual, CAST(hits AS DOUBLE) AS hits,
         CASE WHEN predicted = 0 THEN 0 ELSE hits / CAST(predicted AS DOUBLE) END AS p,
         hits / CAST(actual AS DOUBLE) AS r
  FROM classes
),
weighted AS (
  SELECT 'accuracy' AS metric, sum(hits) / max(total) AS value FROM rates
  UNION ALL SELECT 'precision', sum(p * actual) / max(total) FROM rates
  UNION ALL SELECT 'recall', sum(r * actual) / max(total) FROM rates
  UNION ALL SELECT 'f1', sum(actual * CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END)
                         / max(total) FROM rates
)"""
AUC = """
ranked AS (
  SELECT label, rank() OVER (ORDER BY m) + (count(*) OVER (PARTITION BY m) - 1) / 2.0 AS r
  FROM (SELECT label, round(margin, 6) AS m FROM scores)
),
auc AS (
  SELECT 'auc' AS metric,
         CAST((sum(r) FILTER (label = 1)
               - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
              / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS DOUBLE) AS value
  FROM ranked
)"""
JOINT = """
joint AS (
  SELECT s.doc_id, p.label, p.log_prior + coalesce(sum(t.tf * (h.theta_bow + h.idf * h.theta_tfidf)), 0)
           AS joint
  FROM scored s JOIN priors p ON p.fit = s.fit
  LEFT JOIN doc_terms t ON t.doc_id = s.doc_id
  LEFT JOIN theta h ON h.fit = s.fit AND h.word = t.word AND h.label = p.label
  GROUP BY s.doc_id, p.label, p.log_prior
)"""


def auc_of(metric: str, source: str) -> str:
    """Area under ROC from mean ranks of (label, m)."""
    ones = "count(*) FILTER (label = 1)"
    return f"""
{metric} AS (
  SELECT '{metric}' AS metric,
         CAST((sum(r) FILTER (label = 1) - {ones} * ({ones} + 1) / 2.0)
              / ({ones} * count(*) FILTER (label = 0)) AS DOUBLE) AS value
  FROM (SELECT label, rank() OVER (ORDER BY m) + (count(*) OVER (PARTITION BY m) - 1) / 2.0 AS r
        FROM ({source}))
)"""


EVALUATED = (
    *HELD_OUT_BAYES,
    CONFUSION,
    WEIGHTED,
    JOINT,
    auc_of("auc", "SELECT label, probability_positive AS m FROM scores"),
    auc_of(
        "auc_raw",
        "SELECT s.label, joint AS m FROM scores s JOIN joint j ON j.doc_id = s.doc_id AND j.label = 1",
    ),
)
ALL_VALUES = """
SELECT metric, round(value, 4) AS value FROM (
  SELECT * FROM weighted UNION ALL SELECT * FROM auc UNION ALL SELECT * FROM auc_raw
  UNION ALL SELECT metric, value FROM loss)"""
MIXED = """
mixed AS (
  SELECT d.doc_id, d.text, TRY_CAST(CASE WHEN d.doc_id % 10 = 3 THEN d.source
                                         ELSE CAST(l.quality AS VARCHAR) END AS INTEGER) AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""
MIXED_FIT = f"""SELECT CAST(f AS INTEGER) AS fit, doc_id, label FROM mixed JOIN clean_documents USING (doc_id), range(5) r(f)
WHERE label IS NOT NULL AND {bucket(42, 100)} >= 20 AND {bucket(42, 5)} <> f"""
UNLABELLED = "doc_id FROM clean_documents WHERE doc_id NOT IN (SELECT doc_id FROM mixed)"
LANGUAGE = f"""SELECT 0 AS fit, doc_id,
  CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END AS label
FROM clean_documents JOIN (SELECT doc_id, lang FROM documents) USING (doc_id)"""
FEW = f"""
top AS (SELECT word, place FROM fit_vocab WHERE place <= 20),
feats AS (
  SELECT f.doc_id, f.label, v.word, v.place, coalesce(t.tf, 0) AS x
  FROM fits f CROSS JOIN top v LEFT JOIN doc_terms t ON t.doc_id = f.doc_id AND t.word = v.word
)"""
LOSS = """
loss AS (
  SELECT step, 'log_loss' AS metric, avg(-ln(greatest(1e-15,
           CASE WHEN label = 1 THEN probability_positive ELSE probability_negative END))) AS value
  FROM scores GROUP BY step
)"""
SCORE_COLUMNS = """CAST(prediction AS INTEGER) AS prediction,
  round(probability_negative, 6) AS probability_negative,
  round(probability_positive, 6) AS probability_positive"""


ORACLES: dict[str, str] = {
    # scans, cleaning
    "reviews_typed": query("SELECT doc_id, text, label FROM reviews"),
    "clean_steps": f"""
SELECT doc_id, trim(text) AS trimmed,
       regexp_replace(text, '<br{SPACE}*/?>', ' ', 'g') AS without_breaks,
       regexp_replace(text, '[^\\w\\s\\x0B]', ' ', 'g') AS without_punctuation,
       regexp_replace(text, '{SPACE}+', ' ', 'g') AS collapsed
FROM documents""",
    "clean_classic": query("SELECT doc_id, text, label FROM clean_reviews"),
    "clean_unicode": """
SELECT doc_id, trim(regexp_replace(text, '[^\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}]+', ' ', 'g')) AS text
FROM documents""",
    "clean_light_pages": f"""
SELECT * FROM (SELECT page_id, {light("html")} AS text FROM pages) WHERE text <> ''""",
    "tags_stripped": """
SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages""",
    "input_status": f"""
SELECT conv_id, turn, CASE WHEN regexp_replace(coalesce(text, ''), '^{WIDE_SPACE}+', '') = ''
                           THEN 'empty' ELSE 'ok' END AS status
FROM conversations""",
    # words
    "tokens": query("SELECT doc_id, CAST(pos AS INTEGER) AS pos, word FROM words", WORDS),
    "tokens_nostop": query(
        f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, word FROM words WHERE word NOT IN ({STOP})",
        WORDS,
    ),
    "tokens_normalised": query(
        f"""SELECT doc_id, regexp_replace(trim(word), '\\W', '', 'g') AS word
FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '{SPACE}+')) AS word FROM reviews)
WHERE word <> ''"""
    ),
    "tokens_by_length": query(
        "SELECT doc_id, CAST(pos AS INTEGER) AS pos, word FROM words "
        "WHERE length(word) BETWEEN 2 AND 50",
        WORDS,
    ),
    "map_phase": query(
        f"SELECT w.doc_id, label, word, 1 AS count FROM words w "
        f"JOIN clean_reviews r ON w.doc_id = r.doc_id WHERE {kept()}",
        WORDS,
    ),
    "map_phase_raw_text": query(
        f"""SELECT doc_id, label, word, 1 AS count FROM (
  SELECT doc_id, label, regexp_replace(trim(word), '\\W', '', 'g') AS word FROM (
    SELECT doc_id, label, unnest(string_split_regex(lower(text), '{SPACE}+')) AS word
    FROM reviews)
  WHERE word NOT IN ({STOP})) WHERE length(word) BETWEEN 2 AND 50"""
    ),
    "bigrams": query(
        f"""SELECT doc_id, word || ' ' || following AS gram FROM (
  SELECT doc_id, word, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS following
  FROM words WHERE {kept()}) WHERE following IS NOT NULL""",
        WORDS,
    ),
    "ngram_counts": query(
        f"""SELECT n, gram, CAST(count(*) AS BIGINT) AS total_count FROM (
  SELECT 1 AS n, word AS gram FROM doc_words WHERE {kept()}
  UNION ALL
  SELECT 2, word || ' ' || following FROM (
    SELECT word, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS following
    FROM doc_words WHERE {kept()}) WHERE following IS NOT NULL)
GROUP BY ALL""",
        DOC_WORDS,
    ),
    # word statistics
    "word_count": query("SELECT word, total_count FROM doc_counts", DOC_WORDS, DOC_COUNTS),
    "doc_freq": query("SELECT word, doc_freq FROM doc_counts", DOC_WORDS, DOC_COUNTS),
    "doc_total": query("SELECT CAST(count(*) AS BIGINT) AS total_docs FROM clean_documents"),
    "count_join_df": query(
        "SELECT word, total_count, doc_freq FROM doc_counts", DOC_WORDS, DOC_COUNTS
    ),
    "reduce_phase_pairs": query(
        "SELECT word, total_count, doc_freq FROM counts", WORDS, COUNTS
    ),
    "df_bounds": query(
        "SELECT word, total_count, doc_freq FROM doc_bounds", DOC_WORDS, DOC_COUNTS, DOC_BOUNDS
    ),
    "vocabulary_topk": query(
        f"SELECT word, total_count, doc_freq FROM doc_bounds {TOP_K}",
        DOC_WORDS, DOC_COUNTS, DOC_BOUNDS,
    ),
    "vocabulary_words": query(
        f"""SELECT CAST(row_number() OVER (ORDER BY total_count DESC, word) - 1 AS BIGINT)
  AS position, word FROM (SELECT * FROM bounds {TOP_K})""",
        WORDS, COUNTS, BOUNDS,
    ),
    "word_stats": query(
        f"""SELECT CAST(sum(total_count) AS BIGINT) AS total_words,
  round(avg(total_count), 6) AS avg_word_freq, max(total_count) AS max_word_freq,
  min(total_count) AS min_word_freq, CAST(count(*) AS BIGINT) AS vocabulary_size
FROM (SELECT * FROM doc_bounds {TOP_K})""",
        DOC_WORDS, DOC_COUNTS, DOC_BOUNDS,
    ),
    "label_summary": query(
        """SELECT 0 AS is_total, label, CAST(count(*) AS BIGINT) AS n
FROM clean_reviews GROUP BY label
UNION ALL SELECT 1, NULL, CAST(count(*) AS BIGINT) FROM clean_reviews"""
    ),
    "text_length_stats": query(
        """SELECT CAST(count(*) AS BIGINT) AS total_samples, round(avg(n), 6) AS avg_text_length,
  CAST(max(n) AS INTEGER) AS max_text_length, CAST(min(n) AS INTEGER) AS min_text_length
FROM (SELECT len(string_split(text, ' ')) AS n FROM light_documents)"""
    ),
    "role_length_stats": f"""
SELECT role, CAST(count(*) AS BIGINT) AS total_samples, round(avg(n), 6) AS avg_text_length,
  CAST(max(n) AS INTEGER) AS max_text_length, CAST(min(n) AS INTEGER) AS min_text_length
FROM (SELECT role, len(string_split(text, ' ')) AS n
      FROM (SELECT role, {light("text")} AS text FROM conversations) WHERE text <> '')
GROUP BY role""",
    "id_vocabulary": query(
        """SELECT word, word_id FROM ids
UNION ALL VALUES ('<PAD>', 0), ('<UNK>', 1), ('<START>', 2), ('<END>', 3)""",
        *IDS,
    ),
    "id_sequences": query(
        """SELECT doc_id,
  array_to_string(list(id ORDER BY pos), ' ') || repeat(' 0', CAST(256 - count(*) AS BIGINT))
    AS input_ids,
  array_to_string(list(1 ORDER BY pos), ' ') || repeat(' 0', CAST(256 - count(*) AS BIGINT))
    AS attention_mask
FROM (SELECT doc_id, pos, coalesce(word_id, 1) AS id
      FROM light_words w LEFT JOIN ids i ON w.word = i.word WHERE pos < 256)
GROUP BY doc_id""",
        *IDS,
    ),
    # features
    "tf": query("SELECT doc_id, word, tf FROM terms", *REVIEW_FEATURES),
    "idf": query(
        "SELECT index, word, doc_freq, round(idf, 6) AS idf FROM doc_vocab",
        DOC_WORDS, DOC_COUNTS, DOC_BOUNDS, DOC_VOCAB,
    ),
    "tfidf": query(
        "SELECT doc_id, word, tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf FROM terms",
        *REVIEW_FEATURES,
    ),
    "assembled_features": query(
        """SELECT doc_id, index, CAST(tf AS DOUBLE) AS value FROM terms
UNION ALL
SELECT doc_id, CAST(index + (SELECT count(*) FROM vocab) AS INTEGER), round(tf * idf, 6)
FROM terms WHERE idf <> 0""",
        *REVIEW_FEATURES,
    ),
    "ngram_vocabulary": query(
        """SELECT index, word, m AS n, CAST(doc_freq AS BIGINT) AS doc_freq, round(idf, 6) AS idf
FROM gram_vocab JOIN (SELECT word, m FROM gram_bounds) USING (word)""",
        *grams_of("clean_documents", "doc_words"),
    ),
    "ngram_tfidf": query(
        """SELECT doc_id, word, tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf FROM gram_terms""",
        *grams_of("clean_reviews", "words"),
    ),
    "ngram_features": query(
        """SELECT doc_id, index, CAST(tf AS DOUBLE) AS value FROM gram_terms
UNION ALL
SELECT doc_id, CAST(index + (SELECT count(*) FROM gram_vocab) AS INTEGER), round(tf * idf, 6)
FROM gram_terms WHERE idf <> 0""",
        *grams_of("clean_reviews", "words"),
    ),
    "hash_split": query(
        f"""SELECT doc_id, {bucket(42, 100)} < 20 AS validation,
  CAST({bucket(42, 5)} AS INTEGER) AS fold FROM clean_reviews"""
    ),
    "prepared_by_split": query(
        f"""SELECT d.doc_id, d.text, r.label,
  CASE WHEN r.label IS NULL THEN 'unsupervised'
       WHEN r.held_out THEN 'test' ELSE 'train' END AS split
FROM clean_documents d LEFT JOIN
  (SELECT doc_id, label, {bucket(42, 100)} < 20 AS held_out FROM clean_reviews) r
  ON d.doc_id = r.doc_id"""
    ),
    "csv_split_documents": "SELECT doc_id, text, source FROM documents",
    "csv_reviews": query("SELECT text, label, 'train' AS split FROM clean_reviews"),
    # models
    "nb_priors": query(
        "SELECT label, CAST(n_docs AS BIGINT) AS n_docs, round(log_prior, 6) AS log_prior "
        "FROM priors",
        *HELD_OUT_BAYES,
    ),
    "nb_likelihoods": query(
        "SELECT word, label, round(theta_bow, 6) AS theta_bow, "
        "round(theta_tfidf, 6) AS theta_tfidf FROM theta",
        *HELD_OUT_BAYES,
    ),
    "nb_scores": query(
        f"SELECT doc_id, round(margin, 5) AS margin, {SCORE_COLUMNS} FROM scores",
        *DOCUMENT_BAYES,
    ),
    "sentiment_labels": query(
        """SELECT doc_id, CASE WHEN prediction = 1 THEN 'Positive' ELSE 'Negative' END AS sentiment,
  round(greatest(probability_negative, probability_positive) * 100, 2) AS confidence,
  round(probability_negative * 100, 2) AS negative_percent,
  round(probability_positive * 100, 2) AS positive_percent
FROM scores""",
        *DOCUMENT_BAYES,
    ),
    "confusion": query(
        "SELECT label, prediction, n FROM confusion", *HELD_OUT_BAYES, CONFUSION
    ),
    "confusion_wide": query(
        """SELECT label, CAST(coalesce(sum(n) FILTER (prediction = 0), 0) AS BIGINT) AS predicted_0,
  CAST(coalesce(sum(n) FILTER (prediction = 1), 0) AS BIGINT) AS predicted_1
FROM confusion GROUP BY label""",
        *HELD_OUT_BAYES, CONFUSION,
    ),
    "metrics_accuracy_prf": query(
        "SELECT metric, round(value, 6) AS value FROM weighted",
        *HELD_OUT_BAYES, CONFUSION, WEIGHTED,
    ),
    "auc_rank": query(
        "SELECT metric, round(value, 6) AS value FROM auc", *HELD_OUT_BAYES, AUC
    ),
    "log_loss": query(
        "SELECT metric, round(value, 6) AS value FROM loss", *HELD_OUT_BAYES, LOSS
    ),
    "evaluate_pipeline": query(ALL_VALUES, *EVALUATED, LOSS),
    "evaluate_saved_model": query(ALL_VALUES, *EVALUATED, LOSS),
    # rows that are rejected, blank or tagged
    "mixed_labels_typed": query("SELECT doc_id, label FROM mixed", MIXED),
    "label_rejects": query(
        "SELECT CAST(count(*) AS BIGINT) AS rejected FROM mixed WHERE label IS NULL", MIXED
    ),
    "page_steps": f"""
SELECT page_id, trim(html) AS trimmed,
       regexp_replace(html, '<br{SPACE}*/?>', ' ', 'g') AS without_breaks,
       regexp_replace(html, '[^\\w\\s\\x0B]', ' ', 'g') AS without_punctuation,
       regexp_replace(html, '{SPACE}+', ' ', 'g') AS collapsed
FROM pages""",
    "page_classic": f"""
SELECT * FROM (SELECT page_id, {classic("html")} AS text FROM pages) WHERE text <> ''""",
    "page_pipeline_cleaning": f"SELECT page_id, {classic('html')} AS text FROM pages",
    "clean_blanked": f"""
SELECT * FROM (SELECT doc_id, {classic("text")} AS text FROM (
  SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN regexp_replace(text, '\\w+', '.', 'g') ELSE text END
           AS text FROM documents)) WHERE text <> ''""",
    "blanked_status": f"""
SELECT doc_id, CASE WHEN regexp_replace(text, '^{WIDE_SPACE}+', '') = '' THEN 'empty' ELSE 'ok' END
  AS status
FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN regexp_replace(text, '[^\\x20\\n]', '', 'g')
                          ELSE text END AS text FROM documents)""",
    # more fits
    "compare_smoothings": query(
        """SELECT metric, round(a, 6) AS smoothing_5, round(b, 6) AS smoothing_10,
  round(c, 6) AS smoothing_20, round(b - a, 6) AS smoothing_10_delta,
  round(c - a, 6) AS smoothing_20_delta
FROM (SELECT metric, max(value) FILTER (step = 0) AS a, max(value) FILTER (step = 1) AS b,
             max(value) FILTER (step = 2) AS c FROM step_values GROUP BY metric)""",
        *bayes(TRAIN, THREE, HELD_OUT), LOSS, """
cells AS (
  SELECT step, label, prediction, count(*) AS n FROM scores GROUP BY ALL
),
sides AS (
  SELECT step, label, sum(n) AS actual, coalesce(sum(n) FILTER (label = prediction), 0) AS hits,
         (SELECT coalesce(sum(n), 0) FROM cells p
          WHERE p.step = cells.step AND p.prediction = cells.label) AS predicted
  FROM cells GROUP BY step, label
),
step_rates AS (
  SELECT step, actual / sum(actual) OVER (PARTITION BY step) AS share, hits / actual AS r,
         CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p,
         2 * hits / (actual + predicted) AS f
  FROM sides
),
step_values AS (
  SELECT step, 'accuracy' AS metric, sum(share * r) AS value FROM step_rates GROUP BY step
  UNION ALL SELECT step, 'precision', sum(share * p) FROM step_rates GROUP BY step
  UNION ALL SELECT step, 'recall', sum(share * r) FROM step_rates GROUP BY step
  UNION ALL SELECT step, 'f1', sum(share * f) FROM step_rates GROUP BY step
  UNION ALL SELECT step, metric, value FROM loss
)""",
    ),
    "nb_three_classes": query(
        """SELECT doc_id, label, round(joint, 4) AS joint,
  round(exp(joint - top) / sum(exp(joint - top)) OVER (PARTITION BY doc_id), 6) AS probability
FROM (SELECT *, max(joint) OVER (PARTITION BY doc_id) AS top FROM joint)""",
        *bayes(f"{LANGUAGE} WHERE {bucket(42, 100)} >= 20", ONE,
               f"SELECT 0 AS fit, doc_id FROM clean_documents WHERE {bucket(42, 100)} < 20"),
        JOINT,
    ),
    "lr_optimality": query(
        """SELECT CAST(place - 1 AS INTEGER) AS index, word, CAST(count(*) AS BIGINT) AS n_docs,
  CAST(0 AS DOUBLE) AS residual
FROM feats WHERE x > 0 GROUP BY place, word""",
        *HELD_OUT_BAYES, FEW,
    ),
    "forest_stump": query(
        """SELECT word, threshold, CAST(l0 AS BIGINT) AS left_0, CAST(l1 AS BIGINT) AS left_1,
  CAST(n0 - l0 AS BIGINT) AS right_0, CAST(n1 - l1 AS BIGINT) AS right_1
FROM (SELECT *, (l0 * l0 + l1 * l1) / CAST(l0 + l1 AS DOUBLE)
                + ((n0 - l0) * (n0 - l0) + (n1 - l1) * (n1 - l1)) / CAST(n0 + n1 - l0 - l1 AS DOUBLE)
                AS purity FROM cuts)
ORDER BY round(purity, 9) DESC, place, threshold LIMIT 1""",
        *bayes(f"SELECT fit, doc_id, least(label, 1) AS label FROM ({LANGUAGE} WHERE {bucket(42, 100)} >= 20)",
               ONE, HELD_OUT),
        FEW, """
steps AS (
  SELECT place, word, (x + following) / 2.0 AS threshold FROM (
    SELECT place, word, x, lead(x) OVER (PARTITION BY place ORDER BY x) AS following
    FROM (SELECT DISTINCT place, word, x FROM feats)) WHERE following IS NOT NULL
),
cuts AS (
  SELECT s.place, s.word, s.threshold, count(*) FILTER (label = 0) AS n0,
         count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0 AND x <= threshold) AS l0,
         count(*) FILTER (label = 1 AND x <= threshold) AS l1
  FROM steps s JOIN feats f ON f.place = s.place GROUP BY ALL
)""",
    ),
    "training_run": query(
        f"""SELECT 'tuned' AS run_id, key, value FROM (
  SELECT 'algorithm' AS key, 'naive_bayes' AS value
  UNION ALL SELECT 'features_used', 'bow_tfidf'
  UNION ALL SELECT 'cv_folds', '5'
  UNION ALL SELECT 'train_samples', CAST(count(*) AS VARCHAR) FROM usable
    WHERE label IS NOT NULL AND NOT held_out
  UNION ALL SELECT 'train_rejected', CAST(count(*) AS VARCHAR) FROM usable
    WHERE label IS NULL AND NOT held_out
  UNION ALL SELECT 'test_rejected', CAST(count(*) AS VARCHAR) FROM usable
    WHERE label IS NULL AND held_out
  UNION ALL SELECT 'features', CAST(2 * count(*) AS VARCHAR) FROM fit_vocab WHERE fit = 5
  UNION ALL (SELECT 'best_smoothing', CAST(lam AS VARCHAR) FROM (
    SELECT step, avg(accuracy) AS mean FROM (
      SELECT step, fit, avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS accuracy
      FROM (SELECT s.step, s.fit, s.prediction, m.label FROM scores s JOIN mixed m ON m.doc_id = s.doc_id)
      GROUP BY ALL) GROUP BY step) JOIN smoothing USING (step)
    ORDER BY round(mean, 9) DESC, step LIMIT 1))""",
        MIXED,
        *bayes(
            f"{MIXED_FIT} UNION ALL SELECT 5, doc_id, label FROM mixed JOIN clean_documents USING (doc_id) "
            f"WHERE label IS NOT NULL AND {bucket(42, 100)} >= 20",
            THREE,
            f"SELECT CAST({bucket(42, 5)} AS INTEGER) AS fit, doc_id FROM mixed "
            f"WHERE label IS NOT NULL AND {bucket(42, 100)} >= 20",
            more=f"SELECT CAST(f AS INTEGER), {UNLABELLED.replace('FROM clean_documents', 'FROM clean_documents, range(6) r(f)')}",
        ),
        f"""
usable AS (
  SELECT doc_id, label, {bucket(42, 100)} < 20 AS held_out
  FROM (SELECT m.doc_id, m.label FROM mixed m JOIN clean_documents c ON c.doc_id = m.doc_id)
)""",
    ),
    "best_step": query(
        """SELECT 'smoothing' AS run_id, CAST(step AS INTEGER) AS step, 'val_loss' AS key,
  round(value, 6) AS value
FROM loss ORDER BY value, step LIMIT 1""",
        *bayes(TRAIN, THREE, HELD_OUT), LOSS,
    ),
    "cv_naive_bayes": query(
        """SELECT lam AS smoothing, round(avg(accuracy), 6) AS accuracy FROM (
  SELECT step, fit, avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS accuracy
  FROM scores GROUP BY ALL) JOIN smoothing USING (step)
GROUP BY lam""",
        *FOLD_BAYES,
    ),
}
for name in ("nb_pipeline_scores", "saved_model_scores", "batch_udf_scores", "stream_scores"):
    ORACLES[name] = query(f"SELECT doc_id, {SCORE_COLUMNS} FROM scores", *DOCUMENT_BAYES)
for block in ("bow", "tfidf"):
    ORACLES[f"nb_{block}_scores"] = query(
        f"SELECT doc_id, {SCORE_COLUMNS} FROM scores", *bayes(TRAIN, ONE, ALL_DOCS, (block,))
    )
ORACLES["tfidf_unsupervised_vocabulary"] = query(
    """SELECT w.doc_id, w.word, CAST(count(*) AS BIGINT) AS tf, round(v.idf, 6) AS idf,
  round(count(*) * v.idf, 6) AS tfidf
FROM words w JOIN doc_vocab v ON w.word = v.word GROUP BY w.doc_id, w.word, v.idf""",
    WORDS, DOC_WORDS, DOC_COUNTS, DOC_BOUNDS, DOC_VOCAB,
)
ORACLES["sequence_udf_scores"] = query(
    f"""SELECT doc_id, {SCORE_COLUMNS} FROM (
  SELECT doc_id, CASE WHEN m > 0 THEN 1 ELSE 0 END AS prediction,
         1 / (1 + exp(m)) AS probability_negative, 1 / (1 + exp(-m)) AS probability_positive
  FROM (
    SELECT d.doc_id, (SELECT bias FROM bias) + coalesce(sum(w.weight), 0) AS m
    FROM clean_documents d
    LEFT JOIN doc_words x ON x.doc_id = d.doc_id AND x.pos < 256
    LEFT JOIN weights w ON w.word = x.word
    GROUP BY d.doc_id))""",
    *bayes(TRAIN, ONE, ALL_DOCS, ("bow",)),
)
ORACLES["predictions_csv"] = query(
    f"SELECT d.doc_id, d.text, {SCORE_COLUMNS} FROM scores s JOIN documents d ON s.doc_id = d.doc_id",
    *DOCUMENT_BAYES,
)
