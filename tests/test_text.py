from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ratewise.functions import text as tx
from ratewise.operators import terms


def _eval(spark, values, col_fn, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col_fn(F.col("x"))).collect()]


def test_edge_texts(spark):
    vals = ["", "   ", "<b>Good</b> 10/10!!", "First one. Second one!", "Größe ÇA va", "four", None]
    toks = _eval(spark, vals, lambda c: tx.clean_tokens(c, "eda", stem=False))
    assert toks[0] == [] and toks[1] == []
    assert toks[2] == ["good"]
    assert toks[3] == ["first", "one", "second", "one"]
    assert toks[4] == ["größe", "ça", "va"]
    assert toks[5] == ["four"]
    assert toks[6] is None


def test_punctuation_digits_unicode(spark):
    out = _eval(spark, ["a1b٣c²!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~z"],
                lambda c: tx.strip_punctuation(tx.strip_digits(c)))
    assert out == ["abc²z"]


def test_whitespace_like_python(spark):
    s = "a b c\x0bd\te"
    assert _eval(spark, [s], tx.tokenize) == [s.split()]


def test_s_stemmer(spark):
    words = ["ponies", "aies", "eies", "horses", "toes", "cats", "bus", "glass", "is", "s", "ies"]
    out = _eval(spark, [" ".join(words)], lambda c: tx.lemmatize(tx.tokenize(c)))[0]
    assert out == ["pony", "aie", "eie", "horse", "toe", "cat", "bus", "glass", "is", "s", "ies"]


def test_stopwords_keep_repeats(spark):
    assert _eval(spark, ["the cat and the cat"], lambda c: tx.drop_stopwords(tx.tokenize(c))) == [["cat", "cat"]]


def test_bigrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["x"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(tx.bigrams("t")).collect()] == [["a b", "b c"], [], []]


def test_sentences(spark):
    out = _eval(spark, ["Hello there. How are you?"], tx.split_sentences)[0]
    assert out == [["Hello", "there"], ["How", "are", "you"]]


def test_term_counts_and_mapping(spark):
    df = spark.createDataFrame([(1, ["cats", "dog", "cats"]), (2, ["dogs"])], "id int, tokens array<string>")
    vocab = terms.vocabulary(df)
    mapped = {r.term: r.n for r in terms.map_vocabulary(vocab, terms.stem_mapping(vocab)).collect()}
    assert mapped == {"cat": 2, "dog": 2}
    mapping = spark.createDataFrame([("cats", "kitten")], "term string, replacement string")
    out = {r.id: r.tokens for r in terms.map_terms(df, "id", "tokens", mapping).collect()}
    assert out == {1: ["kitten", "dog", "kitten"], 2: ["dogs"]}
    top = terms.top_terms(df, "tokens", 1).collect()
    assert (top[0].term, top[0].n, top[0].rank) == ("cats", 2, 1)


def test_term_cloud(spark):
    df = spark.createDataFrame([("The dog's bone, the DOG!",)], "reviewText string")
    out = {r.word: (r.n, r.weight) for r in terms.term_cloud_weights(df).collect()}
    assert out == {"dog": (2, 1.0), "bone": (1, 0.5)}
    df = spark.createDataFrame([("10 10 10 toy toys toys glass bus a1",)], "reviewText string")
    out = {r.word: r.n for r in terms.term_cloud_weights(df).collect()}
    assert out == {"toy": 3, "glass": 1, "bus": 1, "a1": 1}  # numbers out, plurals folded


def test_notebook_profile_strips_tags_first(spark):
    got = _eval(spark, ["<br>Great <b>dogs</b>. Cats. This was 5 stars"], lambda c: tx.clean_text(c, "notebook"))
    assert got == ["great dog cat star"]


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcXY12 .,!<>é\t")), max_size=40))
def test_clean_text_idempotent_without_mapping(spark, s):
    once = _eval(spark, [s], lambda c: tx.clean_text(c, "eda", stem=False))[0]
    twice = _eval(spark, [once], lambda c: tx.clean_text(c, "eda", stem=False))[0]
    assert once == twice


def _one_edit(a, b):
    if a == b:
        return False
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        diff = [i for i in range(len(a)) if a[i] != b[i]]
        return len(diff) == 1 or (len(diff) == 2 and diff[1] == diff[0] + 1 and a[diff[0]] == b[diff[1]]
                                  and a[diff[1]] == b[diff[0]])
    s, t = (a, b) if len(a) < len(b) else (b, a)
    return any(t[:i] + t[i + 1:] == s for i in range(len(t)))


def test_spelling_matches_brute_force(spark):
    from ratewise.operators import spelling
    counts = {"the": 9, "hte": 1, "cat": 7, "cta": 1, "ca": 1, "cart": 6, "cats": 1, "café": 5, "cafe": 1,
              "dog": 5, "dgo": 2, "zzz": 1, "at": 5, "a": 1}
    df = spark.createDataFrame(list(counts.items()), "term string, n long")
    got = {r.term: r.replacement for r in spelling.spelling_mapping(df, 5).collect()}
    freq = {t: n for t, n in counts.items() if n >= 5}
    want = {}
    for t, n in counts.items():
        if n < 5:
            cands = sorted((-fn, f) for f, fn in freq.items() if _one_edit(t, f))
            if cands:
                want[t] = cands[0][1]
    assert got == want
    assert got["hte"] == "the" and got["cafe"] == "café" and "zzz" not in got
