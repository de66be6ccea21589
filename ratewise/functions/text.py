"""Text cleaning as native column expressions (no Python per row).

Each step is a ``Column -> Column`` function that runs in the JVM. String steps compile into
whole-stage code; array lambdas (``filter``, ``transform``) are interpreted, so counting operators
explode tokens and work on plain columns instead (``operators/terms.py``). ``sql_*`` helpers give
the same steps in DuckDB SQL for the oracles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stopwords import ENGLISH

# Fixed values (patterns that define the cleaning steps):
# HTML tag, as removed by the reference.
TAG_PATTERN = "<[^<]+?>"
# Unicode decimal digits (what Python's \d matches in text).
DIGITS_PATTERN = r"\p{Nd}+"
# The 32 ASCII punctuation characters !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~ as ranges.
PUNCTUATION_PATTERN = r"[!-/:-@\[-`{-~]"
# The characters Python's str.split() treats as white space.
WHITESPACE_PATTERN = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")
# The same white space as single characters (space excluded), for translate().
WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                    + "\u2028\u2029\u202f\u205f\u3000")
# Bytes that each white-space character but blank and line feed has in UTF-8: itself, or how it begins.
_RARE_BYTES = sorted({bytes([b[0]]) if len(b) < 3 else b[:2] for b in (c.encode() for c in WHITESPACE_CHARS if c != "\n")})
# A word for the term cloud: a letter, digit or underscore, then at least one more or an apostrophe.
CLOUD_WORD_PATTERN = r"[\p{L}\p{N}_][\p{L}\p{N}_']+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_tags(col) -> Column:
    """T1. A text without ``<`` has no tag: it is not looked through."""
    c = _c(col)
    return F.when(F.contains(c, F.lit("<")), F.regexp_replace(c, TAG_PATTERN, "")).otherwise(c)


def lower(col) -> Column:
    """T2."""
    return F.lower(_c(col))


def strip_digits(col) -> Column:
    """T3."""
    return F.regexp_replace(_c(col), DIGITS_PATTERN, "")


def strip_punctuation(col) -> Column:
    """T4."""
    return F.regexp_replace(_c(col), PUNCTUATION_PATTERN, "")


def strip_digits_punctuation(col) -> Column:
    """T3 + T4 in one pass (both delete single characters, so the order does not matter)."""
    return F.regexp_replace(_c(col), r"[\p{Nd}!-/:-@\[-`{-~]", "")


def blank_split(col) -> Column:
    """Split on white space: every white-space character becomes a blank and the text is split on
    the blank (a literal, Java's fast path). Line feeds are replaced by a byte operation; only texts
    that may hold another white-space character (they have its byte, or its first one) go through
    ``translate``, character by character. Runs of white space leave empty strings, which callers drop."""
    def even(c: Column) -> Column:
        raw = c.cast("binary")
        rare = reduce(lambda a, b: a | b, [F.contains(raw, F.lit(b)) for b in _RARE_BYTES])
        return (F.when(rare, F.translate(c, WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS)))
                .otherwise(F.replace(c, F.lit("\n"), F.lit(" "))))

    # a lambda's argument is made once, however often it is looked at
    return F.split(F.get(F.transform(F.array(_c(col)), even), F.lit(0)), " ")


def tokenize(col) -> Column:
    """T5: white-space tokens, empty strings dropped."""
    return F.filter(blank_split(col), lambda t: t != F.lit(""))


def split_sentences(col) -> Column:
    """``array<array<string>>`` of sentences of words (Java BreakIterator, root locale)."""
    return F.sentences(_c(col))


def word_count(tokens) -> Column:
    """T7."""
    return F.size(_c(tokens))


def drop_stopwords(tokens, words=ENGLISH) -> Column:
    """Keep order and repeats; the list test becomes a hash-set lookup (InSet)."""
    return F.filter(_c(tokens), lambda t: ~t.isin(list(words)))


def _kept_tokens(col, words) -> Column:
    """T5 and T8 in one pass over the tokens: empty strings are left out as stop words are."""
    return drop_stopwords(blank_split(col), ["", *words])


def s_stem(token: Column) -> Column:
    """Harman's S stemmer (1991) on one lower-case token: ies -> y (not after e or a),
    es -> e (not after a, e or o), s -> '' (not after u or s); first matching rule only; tokens of
    up to three characters stay ("is", "was", a lone "s"). Suffix edits are substring operations
    (no regex per token)."""
    t = token
    n = F.length(t)
    return (F.when(n <= 3, t)
             .when(t.endswith("ies") & ~t.endswith("eies") & ~t.endswith("aies"),
                   F.concat(t.substr(F.lit(1), n - 3), F.lit("y")))
             .when(t.endswith("es") & ~t.endswith("aes") & ~t.endswith("ees") & ~t.endswith("oes"),
                   t.substr(F.lit(1), n - 1))
             .when(t.endswith("s") & ~t.endswith("us") & ~t.endswith("ss"),
                   t.substr(F.lit(1), n - 1))
             .otherwise(t))


def lemmatize(tokens) -> Column:
    """T9/T10 default mapping, applied token by token in the JVM (no shuffle)."""
    return F.transform(_c(tokens), s_stem)


def join_tokens(tokens) -> Column:
    return F.array_join(_c(tokens), " ")


def bigrams(tokens) -> Column:
    """Adjacent pairs inside one text, as 'a b'."""
    a = _c(tokens)
    return F.when(F.size(a) >= 2, F.transform(F.sequence(F.lit(0), F.size(a) - 2),
                                              lambda i: F.concat(a[i], F.lit(" "), a[i + 1]))
                  ).otherwise(F.array().cast("array<string>"))


def untagged(col, profile: str = "eda") -> Column:
    """The text as it is cut at blanks and line feeds for counting; only tags, which may hold blanks, are
    seen to before."""
    return strip_tags(col) if profile == "eda" else _c(col)


def untagged_tokens(col, words=ENGLISH) -> Column:
    """The ``eda`` tokens of a text without tags, before the stemmer."""
    return _kept_tokens(strip_digits_punctuation(lower(col)), words)


def cloud_words(col) -> Column:
    """All words of a text for the term cloud, in order, in small letters."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(CLOUD_WORD_PATTERN), 0)


def prepared_piece(c: Column, profile: str = "eda") -> Column:
    """The character deletions of a profile on one piece; lower case is left for the tokens (it neither
    makes nor removes white space, digits or punctuation, so the order does not matter)."""
    if profile == "eda":
        return strip_digits_punctuation(c)
    if profile == "raw":
        return strip_punctuation(c)
    if profile == "stem":
        return c
    raise ValueError(f"no piecewise form for profile {profile}")


def clean_tokens(col, profile: str = "eda", words=ENGLISH, stem: bool = True) -> Column:
    """T12 chains, as token arrays.

    * ``eda``: tags, lower, digits, punctuation, tokens, stop words, lemma.
    * ``stem``: lower, white-space tokens, stem.
    * ``raw``: punctuation, lower, tokens, stop words (the top-words chart).
    * ``notebook``: tags, lower, digits, punctuation, tokens, stop words, lemma over the words of
      all sentences (as ``eda``; it differs in what is done before: summary merged, null filled).
    """
    c = _c(col)
    if profile in ("eda", "notebook"):
        toks = _kept_tokens(strip_digits_punctuation(lower(strip_tags(c))), words)
        return lemmatize(toks) if stem else toks
    if profile == "stem":
        toks = tokenize(lower(c))
        return lemmatize(toks) if stem else toks
    if profile == "raw":
        return _kept_tokens(lower(strip_punctuation(c)), words)
    raise ValueError(f"unknown profile {profile}")


def cleaned_length(col, profile: str = "eda") -> Column:
    """Number of tokens of the cleaned text, as a double. The stemmer turns each token into one token,
    so it need not run to count them."""
    return F.size(clean_tokens(col, profile, stem=False)).cast("double")


def clean_text(col, profile: str = "eda", words=ENGLISH, stem: bool = True) -> Column:
    """The cleaned text as one string."""
    return join_tokens(clean_tokens(col, profile, words, stem))


# ---- DuckDB SQL of the same steps (oracles) ----

def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def sql_strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '{TAG_PATTERN}', '', 'g')"


def sql_strip_digits(x: str) -> str:
    return f"regexp_replace({x}, '{DIGITS_PATTERN}', '', 'g')"


def sql_strip_punctuation(x: str) -> str:
    return f"regexp_replace({x}, '{PUNCTUATION_PATTERN}', '', 'g')"


def sql_tokenize(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WHITESPACE_PATTERN}'), lambda t: t <> '')"


def sql_drop_stopwords(toks: str, words=ENGLISH) -> str:
    return f"list_filter({toks}, lambda t: NOT list_contains({_sql_list(words)}, t))"


def sql_s_stem(t: str) -> str:
    return (f"CASE WHEN length({t}) <= 3 THEN {t} WHEN ends_with({t}, 'ies') AND NOT ends_with({t}, 'eies') AND NOT ends_with({t}, 'aies') "
            f"THEN regexp_replace({t}, 'ies$', 'y') "
            f"WHEN ends_with({t}, 'es') AND NOT ends_with({t}, 'aes') AND NOT ends_with({t}, 'ees') "
            f"AND NOT ends_with({t}, 'oes') THEN regexp_replace({t}, 'es$', 'e') "
            f"WHEN ends_with({t}, 's') AND NOT ends_with({t}, 'us') AND NOT ends_with({t}, 'ss') "
            f"THEN regexp_replace({t}, 's$', '') ELSE {t} END")


def sql_lemmatize(toks: str) -> str:
    return f"list_transform({toks}, lambda w: {sql_s_stem('w')})"


def sql_clean_tokens(x: str, profile: str = "eda", stem: bool = True) -> str:
    if profile in ("eda", "notebook"):
        toks = sql_drop_stopwords(sql_tokenize(sql_strip_punctuation(sql_strip_digits(f"lower({sql_strip_tags(x)})"))))
        return sql_lemmatize(toks) if stem else toks
    if profile == "stem":
        toks = sql_tokenize(f"lower({x})")
        return sql_lemmatize(toks) if stem else toks
    if profile == "raw":
        return sql_drop_stopwords(sql_tokenize(f"lower({sql_strip_punctuation(x)})"))
    raise ValueError(profile)


def sql_bigrams(toks: str) -> str:
    return (f"CASE WHEN len({toks}) >= 2 THEN list_transform(generate_series(1, len({toks}) - 1), "
            f"lambda i: {toks}[i] || ' ' || {toks}[i + 1]) ELSE [] END")


def sql_cloud_words(x: str, words=ENGLISH) -> str:
    found = f"regexp_extract_all(lower({x}), '{CLOUD_WORD_PATTERN.replace(chr(39), chr(39) * 2)}')"
    found = f"list_transform({found}, lambda t: regexp_replace(t, '''s$', ''))"
    found = f"list_filter({found}, lambda t: NOT regexp_full_match(t, '{DIGITS_PATTERN}'))"
    return sql_drop_stopwords(found, words)
