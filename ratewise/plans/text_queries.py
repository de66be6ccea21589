"""Registered text queries (documents, pages and review text)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import cleaning, stats, terms
from ..sources.fixtures import table
from .profile_queries import R, histogram_sql, kde_sql
from .registry import oracle, query

EDA_SQL = tx.sql_clean_tokens("reviewText", "eda")


@query("strip_tags", oracle(f"""
SELECT page_id, md5({tx.sql_strip_tags('html')}) AS text_md5,
       CAST(length({tx.sql_strip_tags('html')}) AS INTEGER) AS text_len
FROM pages"""))
def q_strip_tags(spark, sf):
    s = tx.strip_tags("html")
    return table(spark, sf, "pages").select("page_id", F.md5(s).alias("text_md5"), F.length(s).alias("text_len"))


def _token_summary_sql(profile):
    toks = tx.sql_clean_tokens("text", profile)
    return f"""
SELECT doc_id, CAST(len({toks}) AS INTEGER) AS n_tokens, md5(array_to_string({toks}, ' ')) AS tokens_md5 FROM documents"""


def _token_summary(spark, sf, profile):
    toks = tx.clean_tokens("text", profile)
    return table(spark, sf, "documents").select(
        "doc_id", F.size(toks).alias("n_tokens"), F.md5(F.array_join(toks, " ")).alias("tokens_md5"))


@query("clean_tokens_eda", oracle(_token_summary_sql("eda")))
def q_clean_tokens_eda(spark, sf):
    return _token_summary(spark, sf, "eda")


@query("clean_tokens_stem", oracle(_token_summary_sql("stem")))
def q_clean_tokens_stem(spark, sf):
    return _token_summary(spark, sf, "stem")


@query("clean_tokens_raw", oracle(_token_summary_sql("raw")))
def q_clean_tokens_raw(spark, sf):
    return _token_summary(spark, sf, "raw")


@query("notebook_pages", oracle(f"""
SELECT page_id, CAST(len(toks) AS INTEGER) AS n_tokens, md5(array_to_string(toks, ' ')) AS tokens_md5
FROM (SELECT page_id, {tx.sql_lemmatize(tx.sql_drop_stopwords(tx.sql_tokenize(tx.sql_strip_punctuation(tx.sql_strip_digits(f"lower({tx.sql_strip_tags('html')})")))))} AS toks FROM pages)"""))
def q_notebook_pages(spark, sf):
    """The notebook profile on texts that hold tags."""
    toks = tx.clean_tokens("html", "notebook")
    return table(spark, sf, "pages").select(
        "page_id", F.size(toks).alias("n_tokens"), F.md5(F.array_join(toks, " ")).alias("tokens_md5"))


@query("word_count", oracle(f"SELECT doc_id, CAST(len({tx.sql_tokenize('lower(text)')}) AS INTEGER) AS n_words FROM documents"))
def q_word_count(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.word_count(tx.tokenize(tx.lower("text"))).alias("n_words"))


@query("sentences")
def q_sentences(spark, sf):
    s = tx.split_sentences("text")
    return table(spark, sf, "documents").select(
        "doc_id", F.size(s).alias("n_sentences"),
        F.aggregate(s, F.lit(0), lambda acc, x: acc + F.size(x)).alias("n_words"))


@query("vocabulary", oracle(f"""
SELECT term, count(*) AS n FROM (SELECT unnest({tx.sql_clean_tokens('text', 'eda')}) AS term FROM documents)
GROUP BY term"""))
def q_vocabulary(spark, sf):
    return terms.term_counts(table(spark, sf, "documents"), "text", "eda")


@query("lemma_vocabulary", oracle(f"""
SELECT {tx.sql_s_stem('term')} AS term, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT term, count(*) AS n FROM (SELECT unnest({tx.sql_clean_tokens('text', 'eda', stem=False)}) AS term FROM documents)
  GROUP BY term) GROUP BY 1"""))
def q_lemma_vocabulary(spark, sf):
    counts = terms.term_counts(table(spark, sf, "documents"), "text", "eda", stem=False)
    return terms.map_vocabulary(counts, terms.stem_mapping(counts))


@query("lemma_tokens", oracle(f"""
SELECT doc_id, array_to_string({tx.sql_lemmatize(tx.sql_clean_tokens('text', 'eda', stem=False))}, ' ') AS text
FROM documents"""))
def q_lemma_tokens(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", tx.clean_tokens("text", "eda", stem=False).alias("tokens"))
    vocab = terms.vocabulary(docs)
    mapped = terms.map_terms(docs, "doc_id", "tokens", terms.stem_mapping(vocab))
    return mapped.select("doc_id", F.array_join("tokens", " ").alias("text"))


@query("top_terms", oracle(f"""
SELECT term, n, CAST(row_number() OVER (ORDER BY n DESC, term) AS INTEGER) AS rank FROM (
  SELECT term, count(*) AS n FROM (SELECT unnest({tx.sql_clean_tokens('reviewText', 'raw')}) AS term FROM reviews)
  GROUP BY term) ORDER BY n DESC, term LIMIT 20""", text=True))
def q_top_terms(spark, sf):
    return terms.rank_top(terms.term_counts(R(spark, sf, True), "reviewText", "raw"), 20, ["term"])


@query("top_terms_by_rating", oracle(f"""
SELECT overall, term, n, rank FROM (
  SELECT overall, term, n, CAST(row_number() OVER (PARTITION BY overall ORDER BY n DESC, term) AS INTEGER) AS rank FROM (
    SELECT overall, term, count(*) AS n FROM (
      SELECT overall, unnest({EDA_SQL}) AS term FROM reviews WHERE overall IN (1, 2, 3, 4, 5))
    GROUP BY overall, term))
WHERE rank <= 20""", text=True))
def q_top_terms_by_rating(spark, sf):
    df = R(spark, sf, True).where(F.col("overall").isin(1, 2, 3, 4, 5))
    return terms.rank_top(terms.term_counts(df, "reviewText", "eda", by=["overall"]), 20, ["term"], by=["overall"])


@query("term_cloud_weights", oracle(f"""
WITH c AS (SELECT word, count(*) AS n FROM (SELECT unnest({tx.sql_cloud_words('reviewText')}) AS word FROM reviews)
           GROUP BY word),
p AS (SELECT CASE WHEN ends_with(word, 's') AND NOT ends_with(word, 'ss') AND left(word, length(word) - 1) IN (SELECT word FROM c)
                  THEN left(word, length(word) - 1) ELSE word END AS word, n FROM c),
q AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM p GROUP BY word),
t AS (SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS rank FROM q ORDER BY n DESC, word LIMIT 200)
SELECT word, n, rank, round(n / max(n) OVER (), 6) AS weight FROM t""", text=True))
def q_term_cloud_weights(spark, sf):
    return terms.term_cloud_weights(R(spark, sf, True), "reviewText", 200)


@query("top_bigrams", oracle(f"""
WITH c AS (SELECT bigram, count(*) AS n FROM (
             SELECT unnest({tx.sql_bigrams('toks')}) AS bigram FROM (SELECT {EDA_SQL} AS toks FROM reviews))
           GROUP BY bigram HAVING count(*) >= 10)
SELECT bigram, n, CAST(row_number() OVER (ORDER BY n DESC, bigram) AS INTEGER) AS rank FROM c ORDER BY n DESC, bigram LIMIT 25""",
                                  text=True))
def q_top_bigrams(spark, sf):
    return terms.top_bigrams(R(spark, sf, True), k=25, min_count=10, text="reviewText")


@query("review_length_histogram", oracle(histogram_sql(f"len({EDA_SQL})", 20), text=True))
def q_review_length_histogram(spark, sf):
    return stats.histogram(cleaning.cleaned_lengths(R(spark, sf, True)), "length", 20)


@query("review_length_kde", oracle(kde_sql(f"CAST(len({EDA_SQL}) AS DOUBLE)", 100), text=True))
def q_review_length_kde(spark, sf):
    return stats.kde(cleaning.cleaned_lengths(R(spark, sf, True)), "length", 100)


_VOCAB_SQL = f"""counts AS (SELECT term, count(*) AS n FROM (
    SELECT unnest({tx.sql_clean_tokens('text', 'eda', stem=False)}) AS term FROM documents) GROUP BY term)"""


@query("spelling_corrections", oracle(f"""
WITH {_VOCAB_SQL},
freq AS (SELECT term AS variant, n AS fn FROM counts WHERE n >= 5),
rare AS (SELECT term FROM counts WHERE n < 5),
alpha AS (SELECT DISTINCT unnest(string_split(variant, '')) AS c FROM freq),
pos AS (SELECT term, unnest(range(0, length(term) + 1)) AS i FROM rare),
v AS (SELECT term, substring(term, 1, i) || substring(term, i + 2) AS variant FROM pos WHERE i < length(term)
      UNION ALL
      SELECT term, substring(term, 1, i) || substring(term, i + 2, 1) || substring(term, i + 1, 1) || substring(term, i + 3)
      FROM pos WHERE i < length(term) - 1
      UNION ALL
      SELECT term, substring(term, 1, i) || c || substring(term, i + 2) FROM pos, alpha WHERE i < length(term) AND c <> ''
      UNION ALL
      SELECT term, substring(term, 1, i) || c || substring(term, i + 1) FROM pos, alpha WHERE c <> ''),
cand AS (SELECT DISTINCT v.term, f.variant, f.fn FROM v JOIN freq f ON v.variant = f.variant WHERE v.variant <> v.term)
SELECT term, variant AS replacement FROM (
  SELECT term, variant, row_number() OVER (PARTITION BY term ORDER BY fn DESC, variant) AS rn FROM cand) WHERE rn = 1"""))
def q_spelling_corrections(spark, sf):
    from ..operators import spelling
    counts = terms.term_counts(table(spark, sf, "documents"), "text", "eda", stem=False)
    return spelling.spelling_mapping(counts, 5)
