"""The English (Porter2) stemmer on a column of distinct terms.

The published algorithm works on the marks of two regions, R1 and R2: a suffix is only cut if it lies
in one of them. Both are offsets into the term that no step moves, so a step is an expression on (term,
r1, r2), and each step is a projection of its own; no row leaves the JVM. All steps together are more code
than the JVM compiles as one method, so they are run apart and the stems are stored. Use it on a vocabulary
and apply the resulting (term, replacement) table, so that every distinct word is stemmed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import code_in_parts, stored

# Fixed values of the published algorithm.
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
R1_PREFIXES = ("gener", "commun", "arsen")
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
STOP_AFTER_1A = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
STEP_2 = {
    "ational": "ate", "fulness": "ful", "iveness": "ive", "ization": "ize", "ousness": "ous", "biliti": "ble", "lessli": "less",
    "tional": "tion", "alism": "al", "aliti": "al", "ation": "ate", "entli": "ent", "fulli": "ful", "iviti": "ive", "ousli": "ous",
    "abli": "able", "alli": "al", "anci": "ance", "ator": "ate", "enci": "ence", "izer": "ize", "bli": "ble", "ogi": "og", "li": "",
}
STEP_3 = {"ational": "ate", "tional": "tion", "alize": "al", "ative": "", "icate": "ic", "iciti": "ic", "ical": "ic", "ness": "", "ful": ""}
STEP_4 = ("ement", "able", "ance", "ence", "ible", "ment", "ant", "ate", "ent", "ism", "iti", "ion", "ive", "ize", "ous", "al", "er", "ic")

_REGION = f"^[^{VOWELS}]*[{VOWELS}]+[^{VOWELS}]"
_SHORT_END = f"(^[{VOWELS}][^{VOWELS}]|[^{VOWELS}][{VOWELS}][^{VOWELS}wxY])$"


def _cut(w: Column, n: int) -> Column:
    return F.substring(w, F.lit(1), F.length(w) - n) if n else w


def _by_suffix(w: Column, rules: list[tuple[str, Column]]) -> Column:
    """The result of the longest suffix that ``w`` has; a suffix whose condition fails stops the search,
    so each result states what happens then."""
    out = None
    for suffix, result in sorted(rules, key=lambda r: -len(r[0])):
        out = F.when(w.endswith(suffix), result) if out is None else out.when(w.endswith(suffix), result)
    return out.otherwise(w)


def _within(w: Column, region: str, suffix: str) -> Column:
    return F.length(w) - len(suffix) >= F.col(region)


def _region(w: Column, start: Column) -> Column:
    """Where the region after the first consonant that follows a vowel begins, from ``start`` on."""
    n = F.length(F.regexp_extract(F.substring(w, start + 1, F.length(w)), _REGION, 0))
    return F.when(n == 0, F.length(w)).otherwise(start + n)


def english_stem(terms: DataFrame, term: str = "term", out: str = "stem") -> DataFrame:
    """``terms`` with the stem of each (lower-case) term. Null stays null; terms of one or two letters
    and the listed exceptions have their stems by rule."""
    names = [c for c in terms.columns if c != out]
    w = F.col("w_")

    def then(df: DataFrame, step: Column) -> DataFrame:
        return df.select(*names, "r1_", "r2_", "done_", F.when(F.col("done_"), w).otherwise(step).alias("w_"))

    word = F.regexp_replace(F.col(term), "[’‘‛]", "'")
    fixed = None
    for a, b in EXCEPTIONS.items():
        fixed = F.when(word == a, b) if fixed is None else fixed.when(word == a, b)
    df = terms.select(*names, F.coalesce(fixed, word).alias("w_"), (fixed.isNotNull() | (F.length(word) <= 2)).alias("done_"))
    bare = F.regexp_replace(w, "^'", "")
    marked = F.regexp_replace(F.regexp_replace(bare, "^y", "Y"), f"([{VOWELS}])y", "$1Y")
    df = df.select(*names, "done_", F.when(F.col("done_"), w).otherwise(marked).alias("w_"))
    r1 = F.length(F.regexp_extract(w, f"^({'|'.join(R1_PREFIXES)})", 0))
    df = df.select(*names, "done_", "w_", F.when(r1 > 0, r1).otherwise(_region(w, F.lit(0))).alias("r1_"))
    df = df.select(*names, "done_", "w_", "r1_", _region(w, F.col("r1_")).alias("r2_"))

    df = then(df, F.regexp_replace(w, "('s'|'s|')$", ""))                                        # step 0
    df = then(df, _by_suffix(w, [                                                                # step 1a
        ("sses", _cut(w, 2)), ("us", w), ("ss", w),
        *[(s, F.when(F.length(w) > 4, _cut(w, 2)).otherwise(_cut(w, 1))) for s in ("ied", "ies")],
        ("s", F.when(w.rlike(f"[{VOWELS}].+s$"), _cut(w, 1)).otherwise(w))]))
    df = df.select(*names, "r1_", "r2_", "w_", (F.col("done_") | w.isin(*STOP_AFTER_1A)).alias("done_"))
    # step 1b: the cut, and whether something was cut that asks for a new ending
    cut = [(s, F.when(F.substring(w, F.lit(1), F.length(w) - len(s)).rlike(f"[{VOWELS}]"), F.concat(_cut(w, len(s)), F.lit("-"))).otherwise(w))
           for s in ("ed", "edly", "ing", "ingly")]
    df = then(df, _by_suffix(w, cut + [(s, F.when(_within(w, "r1_", s), _cut(w, len(s) - 2)).otherwise(w)) for s in ("eed", "eedly")]))
    rest = _cut(w, 1)
    df = then(df, F.when(~w.endswith("-") | ~F.col("done_").eqNullSafe(F.lit(False)), w)
              .when(rest.rlike("(at|bl|iz)$"), F.concat(rest, F.lit("e")))
              .when(rest.rlike(f"({'|'.join(DOUBLES)})$"), _cut(w, 2))
              .when(rest.rlike(_SHORT_END) & (F.length(rest) <= F.col("r1_")), F.concat(rest, F.lit("e")))
              .otherwise(rest))
    df = then(df, F.regexp_replace(w, f"(.[^{VOWELS}])[yY]$", "$1i"))                            # step 1c
    two = []
    for s, r in STEP_2.items():
        ok = _within(w, "r1_", s)
        if s == "li":
            ok = ok & w.rlike(f"[{LI_ENDINGS}]li$")
        elif s == "ogi":
            ok = ok & w.endswith("logi")
        two.append((s, F.when(ok, F.concat(_cut(w, len(s)), F.lit(r))).otherwise(w)))
    df = then(df, _by_suffix(w, two))
    three = [(s, F.when(_within(w, "r2_" if s == "ative" else "r1_", s), F.concat(_cut(w, len(s)), F.lit(r))).otherwise(w)) for s, r in STEP_3.items()]
    df = then(df, _by_suffix(w, three))
    four = []
    for s in STEP_4:
        ok = _within(w, "r2_", s)
        if s == "ion":
            ok = ok & w.rlike("[st]ion$")
        four.append((s, F.when(ok, _cut(w, len(s))).otherwise(w)))
    df = then(df, _by_suffix(w, four))
    e = _within(w, "r2_", "e") | (_within(w, "r1_", "e") & ~_cut(w, 1).rlike(_SHORT_END))
    df = then(df, F.when(w.endswith("e") & e, _cut(w, 1)).when(w.endswith("ll") & _within(w, "r2_", "l"), _cut(w, 1)).otherwise(w))
    with code_in_parts(terms.sparkSession):
        return stored(df.select(*names, F.when(F.col("done_"), w).otherwise(F.lower(w)).alias(out)), "stems")


def english_mapping(vocab: DataFrame, term: str = "term") -> DataFrame:
    """(term, replacement) for the distinct terms of a vocabulary, as ``map_vocabulary`` and
    ``map_terms`` take it."""
    return english_stem(vocab.select(F.col(term).alias("term")).distinct(), "term", "replacement")


def sql_english_stem(source: str) -> str:
    """DuckDB: the stems of the column ``term`` of ``source`` as (term, stem), in CTEs, written from the
    published rules as regular expressions over the word and the text before R1 and R2."""
    v, c = VOWELS, f"[^{VOWELS}]"

    def longest(rules: list[tuple[str, str]]) -> str:
        return "CASE " + " ".join(f"WHEN suffix(w, '{s}') THEN {r}" for s, r in sorted(rules, key=lambda x: -len(x[0]))) + " ELSE w END"

    def cut(n: int, add: str = "") -> str:
        return f"(left(w, length(w) - {n}) || '{add}')"

    def guarded(s: str, r: str, region: str, more: str = "true") -> tuple[str, str]:
        return s, f"CASE WHEN length(w) - {len(s)} >= {region} AND {more} THEN {cut(len(s), r)} ELSE w END"

    def short(x: str) -> str:
        return f"(regexp_matches({x}, '^[{v}]{c}$') OR regexp_matches({x}, '{c}[{v}][^{v}wxY]$'))"

    special = "CASE term " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EXCEPTIONS.items()) + " END"
    one_a = longest([("sses", cut(2)), ("us", "w"), ("ss", "w"), ("s", f"CASE WHEN regexp_matches(w, '[{v}].+s$') THEN {cut(1)} ELSE w END"),
                     *[(s, f"CASE WHEN length(w) > 4 THEN {cut(2)} ELSE {cut(1)} END") for s in ("ied", "ies")]])
    one_b = longest([guarded("eed", "ee", "r1"), guarded("eedly", "ee", "r1"),
                     *[(s, f"CASE WHEN regexp_matches(left(w, length(w) - {len(s)}), '[{v}]') THEN {cut(len(s))} || '-' ELSE w END")
                       for s in ("ed", "edly", "ing", "ingly")]])
    x = "left(w, length(w) - 1)"
    ending = (f"CASE WHEN NOT suffix(w, '-') THEN w WHEN regexp_matches({x}, '(at|bl|iz)$') THEN {x} || 'e' "
              f"WHEN right({x}, 2) IN ({', '.join(repr(d) for d in DOUBLES)}) THEN left(w, length(w) - 2) "
              f"WHEN {short(x)} AND length({x}) <= r1 THEN {x} || 'e' ELSE {x} END")
    two = longest([guarded(s, r, "r1", {"li": f"regexp_matches(w, '[{LI_ENDINGS}]li$')", "ogi": "suffix(w, 'logi')"}.get(s, "true")) for s, r in STEP_2.items()])
    three = longest([guarded(s, r, "r2" if s == "ative" else "r1") for s, r in STEP_3.items()])
    four = longest([guarded(s, "", "r2", "regexp_matches(w, '[st]ion$')" if s == "ion" else "true") for s in STEP_4])
    five = (f"CASE WHEN suffix(w, 'e') AND (length(w) - 1 >= r2 OR (length(w) - 1 >= r1 AND NOT {short(x)})) THEN {x} "
            f"WHEN suffix(w, 'll') AND length(w) - 1 >= r2 THEN {x} ELSE w END")
    steps = ["regexp_replace(w, '(''s''|''s|'')$', '')", one_a]
    region = f"'^{c}*[{v}]+{c}'"
    sql = f"""p0 AS MATERIALIZED (SELECT term, regexp_replace(regexp_replace(regexp_replace(term, '^''', ''), '^y', 'Y'), '([{v}])y', '\\1Y', 'g') AS w
  FROM ({source}) WHERE length(term) > 2 AND ({special}) IS NULL),
p1 AS MATERIALIZED (SELECT term, w, CASE WHEN regexp_matches(w, '^({'|'.join(R1_PREFIXES)})') THEN length(regexp_extract(w, '^({'|'.join(R1_PREFIXES)})'))
  WHEN regexp_matches(w, {region}) THEN length(regexp_extract(w, {region})) ELSE length(w) END AS r1 FROM p0),
p2 AS MATERIALIZED (SELECT term, w, r1, CASE WHEN regexp_matches(substr(w, r1 + 1), {region}) THEN r1 + length(regexp_extract(substr(w, r1 + 1), {region}))
  ELSE length(w) END AS r2 FROM p1)"""
    at = "p2"
    for i, step in enumerate(steps):
        sql += f",\ns{i} AS MATERIALIZED (SELECT term, {step} AS w, r1, r2 FROM {at})"
        at = f"s{i}"
    keep = ", ".join(repr(x) for x in STOP_AFTER_1A)
    for i, step in enumerate([one_b, ending, f"regexp_replace(w, '(.{c})[yY]$', '\\1i')", two, three, four, five], 2):
        sql += f",\ns{i} AS MATERIALIZED (SELECT term, CASE WHEN w IN ({keep}) THEN w ELSE {step} END AS w, r1, r2 FROM {at})"
        at = f"s{i}"
    return sql + f""",
stems AS (SELECT term, lower(w) AS stem FROM {at}
  UNION ALL SELECT term, coalesce({special}, term) FROM ({source}) WHERE length(term) <= 2 OR ({special}) IS NOT NULL)"""
