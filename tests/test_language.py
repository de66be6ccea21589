"""Stems, lemmas, learned sentences and word pairs."""

from pyspark.sql import functions as F

from ratewise.functions import porter2
from ratewise.operators import lemma, sentences, terms

# The sample vocabulary published with the algorithm (word, stem).
SAMPLE = """consign consign|consigned consign|consigning consign|consignment consign|consist consist|consisted consist|consistency consist|consistent consist
consistently consist|consisting consist|consists consist|consolation consol|consolations consol|consolatory consolatori|console consol|consoled consol
consoles consol|consolidate consolid|consolidated consolid|consolidating consolid|consoling consol|consolingly consol|consols consol|consonant conson
consort consort|consorted consort|consorting consort|conspicuous conspicu|conspicuously conspicu|conspiracy conspiraci|conspirator conspir
conspirators conspir|conspire conspir|conspired conspir|conspiring conspir|constable constabl|constables constabl|constance constanc|constancy constanc
constant constant|knack knack|knackeries knackeri|knacks knack|knag knag|knave knave|knaves knave|knavish knavish|kneaded knead|kneading knead|knee knee
kneel kneel|kneeled kneel|kneeling kneel|kneels kneel|knees knee|knell knell|knelt knelt|knew knew|knick knick|knif knif|knife knife|knight knight
knightly knight|knights knight|knit knit|knits knit|knitted knit|knitting knit|knives knive|knob knob|knobs knob|knock knock|knocked knock|knocker knocker
knockers knocker|knocking knock|knocks knock|knopp knopp|knot knot|knots knot"""
# Words that each take one particular rule (special forms, y, short words, doubles, regions).
RULES = """skis ski|skies sky|dying die|news news|atlas atlas|inning inning|proceed proceed|tied tie|ties tie|cries cri|gas gas|this this|gaps gap|kiwis kiwi
cry cri|by by|say say|hopping hop|hoping hope|luxuriated luxuri|sized size|agreed agre|feed feed|bed bed|generously generous|communism communism|arsenic arsenic
relational relat|vietnamization vietnam|rationalism ration|analogi analog|quickly quick|happily happili|hopefulness hope|electricity electr|formative format
adoption adopt|rate rate|cease ceas|controll control|roll roll|youth youth|boyish boyish|yes yes|o'neill o'neil|dog's dog|dogs' dog|'tis tis|a a|is is"""


def test_stems_of_the_published_sample(spark):
    want = dict(x.split() for x in (SAMPLE + "\n" + RULES).replace("\n", "|").split("|"))
    df = spark.createDataFrame([(w,) for w in want] + [(None,), ("",), ("1234",), ("größe",)], "term string")
    got = {r.term: r.stem for r in porter2.english_stem(df).collect()}
    assert {w: got[w] for w in want} == want
    assert got[None] is None and got[""] == "" and got["1234"] == "1234"


def test_stems_reach_the_tokens_and_keep_other_columns(spark):
    docs = spark.createDataFrame([(1, ["running", "dogs", "running", "ran"]), (2, [])], "id int, tokens array<string>")
    out = terms.map_terms(docs, "id", "tokens", porter2.english_mapping(terms.vocabulary(docs)))
    assert {r.id: r.tokens for r in out.collect()} == {1: ["run", "dog", "run", "ran"], 2: []}
    kept = porter2.english_stem(terms.vocabulary(docs)).columns
    assert kept == ["term", "n", "stem"]


def test_lemmas_need_a_word_of_the_vocabulary(spark):
    words = ["geese", "goose", "wolves", "wolf", "knives", "knife", "boxes", "box", "churches", "church", "cities", "city", "dresses", "dress", "glass", "glas",
             "bus", "bu", "firemen", "fireman", "cats", "cat", "zebras", "ies", "s", "lens"]
    vocab = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "term string, n long")
    got = {r.term: r.replacement for r in lemma.lemma_mapping(vocab).collect()}
    assert got == dict.fromkeys(words, None) | {w: w for w in words} | {
        "geese": "goose", "wolves": "wolf", "knives": "knife", "boxes": "box", "churches": "church", "cities": "city", "dresses": "dress",
        "firemen": "fireman", "cats": "cat"}
    verbs = spark.createDataFrame([("hoped", 1), ("hope", 2), ("hop", 1), ("hopping", 1), ("going", 1), ("go", 1), ("went", 1)], "term string, n long")
    got = {r.term: r.replacement for r in lemma.lemma_mapping(verbs, "v").collect()}
    assert got["hoped"] == "hope" and got["going"] == "go" and got["went"] == "go" and got["hopping"] == "hopping"
    rare = {r.term: r.replacement for r in lemma.lemma_mapping(verbs, "v", least=2).collect()}
    assert rare["hoped"] == "hope" and rare["going"] == "going"
    own = spark.createDataFrame([("boxes", "boxen")], "term string, irregular string")
    assert {r.term: r.replacement for r in lemma.lemma_mapping(vocab, irregular=own).collect()}["boxes"] == "boxen"


def test_abbreviations_are_learned_and_do_not_cut(spark):
    rows = [(i, f"We met Mr. Smith{i % 9} at noon. He asked about fruit, e.g. apples and pears. The talk was short! Was it? The end of item {i}.") for i in range(120)]
    rows += [(600 + i, f"At noon the pears of item {i} were sold") for i in range(80)]
    rows += [(500, "They left with J. Brown at ten. \"Is it so?\" The rest stayed."), (501, None), (502, "  \n"), (503, "no end"), (504, "Wait... what. The end.")]
    df = spark.createDataFrame(rows, "id long, text string")
    found = {r.type for r in sentences.abbreviations(df, "id", "text").collect()}
    assert {"mr", "e.g"} <= found and not found & {"noon", "pears", "item", "short"}
    got = {}
    for r in sentences.split_sentences(df, "id", "text").orderBy("id", "pos").collect():
        got.setdefault(r.id, []).append(r.sentence)
        assert r.pos == len(got[r.id]) - 1
    assert got[7] == ["We met Mr. Smith7 at noon.", "He asked about fruit, e.g. apples and pears.", "The talk was short!", "Was it?", "The end of item 7."]
    assert got[500] == ["They left with J. Brown at ten.", "\"Is it so?\"", "The rest stayed."]
    assert got[503] == ["no end"] and got[504] == ["Wait... what.", "The end."] and 501 not in got and 502 not in got
    assert all(" ".join(got[i]) == " ".join(t.split()) for i, t in rows if t and t.strip())


def test_pairs_take_their_words_counts_away(spark):
    rows = [("great battery life and weak sound",)] * 40 + [(f"battery holder number{i} life story{i}",) for i in range(30)] + [("sound sounds 77 life",)] * 5 + [(None,)]
    got = {r.word: r.n for r in terms.term_cloud_pairs(spark.createDataFrame(rows, "reviewText string"), k=500).collect()}
    assert got["battery life"] == 40 and got["weak sound"] == 40 and got["great battery"] == 40
    # sound: 40 in the pair, 5 alone, 5 folded from the plural (that pair is below the threshold or an entry of its own)
    assert got.get("sound", 0) + 2 * got.get("sound sound", 0) == 10


def test_likelihood_ratio_is_dunnings(spark):
    import math

    def plain(k, c1, c2, n):
        def fit(k, of, p):
            return k * math.log(max(p, 1e-10)) + (of - k) * math.log(max(1 - p, 1e-10))
        p, p1, p2 = c2 / n, k / c1, (c2 - k) / (n - c1)
        return -2 * (fit(k, c1, p) + fit(c2 - k, n - c1, p) - fit(k, c1, p1) - fit(c2 - k, n - c1, p2))

    rows = [(8.0, 15.0, 20.0, 1000.0), (1.0, 15.0, 20.0, 1000.0), (15.0, 15.0, 15.0, 1000.0)]
    df = spark.createDataFrame(rows, "k double, a double, b double, n double")
    got = [r.x for r in df.select(sentences.log_likelihood(*map(F.col, "kabn")).alias("x")).collect()]
    assert all(abs(g - plain(*r)) < 1e-9 for g, r in zip(got, rows))


def test_the_clean_job_stems_with_either_stemmer(spark):
    from ratewise.plans import jobs
    rows = [("A", "U1", 1, 5.0, True, "Running dogs' happily", "Generously", "3"), ("A", "U2", 2, 1.0, True, "", None, None), ("B", "U1", 3, 4.0, False, "x", "y", "1")]
    df = spark.createDataFrame(rows, "asin string, reviewerID string, unixReviewTime int, overall double, verified boolean, reviewText string, summary string, vote string")
    for stemmer, want in (("plural", "running dogs' happily generously"), ("english", "run dog happili generous")):
        out = jobs.clean_reviews(df, stemmer)
        got = {r.reviewerID: r.reviewText for r in out.collect()}
        assert got == {"U1": want, "U2": ""} and out.columns == jobs.clean_reviews(df).columns
