"""Quality rules on whole texts: length, repetition and distance from the language.

Built-in expressions and joins only. One pass over the texts gives each row its
counts and character classes, small enough to keep; everything else is taken from
these or from the words alone. A language's reference is its shares of character
classes and of its most frequent words, over all of its documents; a document is
compared with its own language's reference by the Jensen-Shannon distance (base 2,
0 to 1) of either histogram.

Words are counted as rows: those of the reference are found by a join with it and
added up per text, so neither the length of a word nor the number of common words
is limited by what fits into one expression. Rows meet again by two hashes of their
text and its language, never by the text itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import saved

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: words that a document needs before its histograms are judged, and a language before it has a reference
GUARD_WORDS, GUARD_LANGUAGE = 50, 2_000
#: allowed distances: a fixed part and one that shrinks with the square root of the words
CLASS_LIMIT, CLASS_NOISE = 0.15, 1.0
WORD_LIMIT, WORD_NOISE = 0.25, 2.5
#: words in a language's reference: its most frequent ones
COMMON = 100
#: languages up to which the references are broadcast, about 5 KB each
BROADCAST_LANGUAGES = 1_000
#: repeated windows up to which each window is looked up in their list
FEW = 32

#: character classes; a-z and white space are taken out before the others are counted
LOWER = "a-z"
BLANKS = r"\x20\x09-\x0D"
CLASSES = {"upper": r"\p{Lu}", "other_letter": r"[\p{Ll}\p{Lo}\p{Lm}\p{Lt}]", "digit": "[0-9]",
           "symbol": "[#*$%&|<>]", "punctuation": r"""[.,;:!?'"()\[\]{}_/\\-]"""}
HISTOGRAM = ["lower", *CLASSES, "space", "rest"]


def _pieces(text: Column) -> Column:
    """The text cut at each single white space character, empty pieces included."""
    plain = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    return F.split(plain, " ")  # one plain character: no regular expression is run


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.array_remove(_pieces(text), "")


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once per row."""
    return F.transform(F.array(value), use)[0]


def duplicate_lines(text: Column) -> Column:
    """Lines holding a word that equal an earlier line."""
    spaces = F.lit(" \t\n\x0b\x0c\r")
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x, spaces) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(words: Column) -> Column:
    """Words covered by the 3-word windows that the text holds twice or more.

    Windows are compared by 64-bit hashes. Sorting these shows the repeated ones;
    a few are looked up window by window, many are found by sorting the places
    along with the hashes. The places, in order, give the words covered.
    """
    return let(words, _repeated)


def _repeated(words: Column) -> Column:
    last = F.size(words) - 3
    hashes = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))

    def looked_up(h: Column, repeated: Column) -> Column:
        marked = F.transform(h, lambda x, i: F.when(F.array_contains(repeated, x), i))
        return F.filter(marked, lambda i: i.isNotNull())

    def sorted_along(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        found = let(pairs, lambda s: F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]).eqNullSafe(True)
                                              | (x["h"] == F.get(s, k + 1)["h"]).eqNullSafe(True)))
        return F.array_sort(F.transform(found, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(places, start, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    def count(h: Column) -> Column:
        repeated = let(F.sort_array(h), lambda s: F.array_distinct(
            F.filter(s, lambda x, k: (x == F.get(s, k - 1)).eqNullSafe(True))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(repeated, lambda r: covered(
                F.when(F.size(r) <= FEW, looked_up(h, r)).otherwise(sorted_along(h)))))

    return F.coalesce(let(hashes, count), F.lit(0).cast("long"))


def _facts(docs: DataFrame, text_col: str, lang_col: str, *keep: Column) -> DataFrame:
    """One small row per row of ``docs``: key of its text, language, counts and classes."""
    base = docs.select(*keep, *_identity(text_col, lang_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    base = base.withColumn("__pieces", _pieces(F.col("__text")))
    base = (base.withColumn("__words", F.array_remove("__pieces", ""))
            .withColumn("n_words", F.size("__words").cast("long"))
            .withColumn("space", (F.size("__pieces") - 1).cast("long"))
            .withColumn("word_chars", F.length("__text") - F.col("space"))
            .withColumn("n_dup_lines", duplicate_lines(F.col("__text")))
            .withColumn("n_repeat_words", repeated_words(F.col("__words")))
            .withColumn("__rest", F.regexp_replace("__text", f"[{LOWER}{BLANKS}]+", "")))
    base = (base.withColumn("lower", F.col("word_chars") - F.length("__rest"))
            .withColumns({k: F.regexp_count("__rest", F.lit(p)).cast("long") for k, p in CLASSES.items()})
            .withColumn("rest", F.length("__rest") - sum(F.col(k) for k in CLASSES)))
    return base.drop("__text", "__pieces", "__words", "__rest")


def _identity(text_col: str, lang_col: str) -> list[Column]:
    """Two hashes of the text, and the language: rows that are equal here get one verdict."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), F.col(lang_col).cast("string").alias("lang")]


KEY = ["k1", "k2", "lang"]


def _word_rows(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(k1, k2, lang, word): every word of the documents that are long enough to be judged."""
    rows = docs.select(*_identity(text_col, lang_col), words_of(F.col(text_col).cast("string")).alias("words"))
    return rows.where(F.size("words") >= GUARD_WORDS).select(*KEY, F.explode("words").alias("word"))


def language_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = COMMON,
                        facts: DataFrame | None = None) -> DataFrame:
    """(lang, words, classes) of every language, null being one too.

    ``words`` are structs (word, share) of its ``common`` most frequent words, ties to
    the smaller word; ``classes`` the shares of ``HISTOGRAM``. Counted over all documents
    that are long enough to be judged; a language that has fewer than ``GUARD_LANGUAGE``
    words in them has no reference. One row per language.
    """
    if facts is None:
        facts = _facts(docs, text_col, lang_col)
    classes = facts.where(F.col("n_words") >= GUARD_WORDS).groupBy("lang").agg(
        F.sum("n_words").alias("total"), *[F.sum(k).cast("double").alias(k) for k in HISTOGRAM]) \
        .where(F.col("total") >= GUARD_LANGUAGE)
    counts = (_word_rows(docs.select(F.col(text_col), F.col(lang_col)), text_col, lang_col)
              .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    # a row_number with a limit keeps only the first rows of each task before the shuffle
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = (counts.withColumn("place", place).where(F.col("place") <= common).groupBy(F.col("lang").alias("of"))
           .agg(F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("top")))
    chars = sum(F.col(k) for k in HISTOGRAM)
    both = classes.join(top, F.col("lang").eqNullSafe(F.col("of")))
    return both.select(
        "lang", F.transform("top", lambda x: F.struct(x["word"].alias("word"), (x["n"] / F.col("total")).alias("share")))
        .alias("words"), F.array(*[F.col(k) / chars for k in HISTOGRAM]).alias("classes"))


def _term(p: Column, q: Column) -> Column:
    """What one bin adds to twice the squared Jensen-Shannon distance."""
    part = lambda a: F.when(a > 0, a * F.log2(2 * a / (p + q))).otherwise(0.0)
    return part(p) + part(q)


def divergence(p: list[Column], q: list[Column]) -> Column:
    """Jensen-Shannon distance, base 2, of two lists of shares."""
    total = F.lit(0.0)
    for x, y in zip(p, q):
        total = total + _term(x, y)
    return F.sqrt(F.greatest(F.lit(0.0), total / 2))


def _verdicts(docs: DataFrame, facts: DataFrame, references: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``facts`` with class_distance, word_distance, base_failed and kept."""
    refs = references.withColumnRenamed("lang", "ref_lang")
    # sent to every task while that is a few MB at most, else joined by shuffle
    small = F.broadcast if references.count() <= BROADCAST_LANGUAGES else (lambda df: df)
    bins = refs.select("ref_lang", F.inline("words"))
    bins = bins.withColumnsRenamed({"word": "ref_word", "share": "q"})
    hits = (_word_rows(docs, text_col, lang_col)
            .join(small(bins), F.col("lang").eqNullSafe(F.col("ref_lang")) & (F.col("word") == F.col("ref_word")))
            .groupBy(*KEY, "word", "q").agg(F.count(F.lit(1)).alias("n")))
    # rows of equal text were counted together
    texts = facts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"), F.max("n_words").alias("of"))
    same = (F.col("h.k1") == F.col("t.k1")) & (F.col("h.k2") == F.col("t.k2")) & F.col("h.lang").eqNullSafe(F.col("t.lang"))
    p = F.col("n") / (F.col("copies") * F.col("of"))
    found = (hits.alias("h").join(texts.alias("t"), same)
             .groupBy(F.col("h.k1").alias("w1"), F.col("h.k2").alias("w2"), F.col("h.lang").alias("w_lang"))
             .agg(F.sum(_term(p, F.col("q")) - F.col("q")).alias("met"), F.sum(p).alias("p_common")))
    known = small(refs.select("ref_lang", "classes", F.aggregate(
        "words", F.lit(0.0), lambda a, x: a + x["share"]).alias("q_common")))
    rows = facts.join(found, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2"))
                      & F.col("lang").eqNullSafe(F.col("w_lang")), "left") \
        .join(known, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    n, chars = F.col("n_words"), sum(F.col(k) for k in HISTOGRAM)
    judged = (n >= GUARD_WORDS) & F.col("classes").isNotNull()
    rest = _term(F.greatest(F.lit(0.0), 1 - F.coalesce("p_common", F.lit(0.0))),
                 F.greatest(F.lit(0.0), 1 - F.col("q_common")))
    words = F.sqrt(F.greatest(F.lit(0.0), (F.coalesce("met", F.lit(0.0)) + F.col("q_common") + rest) / 2))
    classes = divergence([F.col(k) / chars for k in HISTOGRAM], [F.get("classes", F.lit(i)) for i in range(len(HISTOGRAM))])
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    rows = (rows.withColumn("class_distance", F.when(judged, classes))
            .withColumn("word_distance", F.when(judged, words)).withColumn("base_failed", failed))
    far = (F.col("class_distance") > CLASS_LIMIT + CLASS_NOISE / F.sqrt(n)) \
        | (F.col("word_distance") > WORD_LIMIT + WORD_NOISE / F.sqrt(n))
    return (rows.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))
            .drop("w1", "w2", "w_lang", "met", "p_common", "ref_lang", "classes", "q_common"))


def quality(docs: DataFrame, references: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: its id, counts, distances and verdict.

    Counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.
    base_failed: fewer than 50 words, or over half of the words in repeated
    3-word windows. class_distance and word_distance compare with the language's
    reference; both are null below ``GUARD_WORDS`` words or without a reference,
    and a null distance rejects nothing. kept: not base_failed, and neither
    distance above its limit.

    Null and empty texts have no word and fail. A null language is a language of
    its own. Null and repeated ids keep their rows; rows of equal text and language
    get equal verdicts. Columns besides id, text and language are not read; an empty
    table gives an empty result.
    """
    facts = saved(_facts(docs, text_col, lang_col, F.col(id_col).alias("doc_id")))
    refs = saved(references if references is not None else language_references(docs, text_col, lang_col, facts=facts))
    return _verdicts(docs, facts, refs, text_col, lang_col).select(
        "doc_id", "n_words", "word_chars", F.col("symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        "class_distance", "word_distance", "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns.

    Only the hashes of the texts that go are sent to the rows.
    """
    facts = saved(_facts(docs, text_col, lang_col))
    refs = saved(language_references(docs, text_col, lang_col, facts=facts))
    gone = saved(_verdicts(docs, facts, refs, text_col, lang_col).where(~F.col("kept")).select(*KEY).distinct()
                 .select(*[F.col(k).alias(f"__gone_{k}") for k in KEY]))
    same = F.lit(True)
    for k, mine in zip(KEY, _identity(text_col, lang_col)):
        same = same & mine.eqNullSafe(F.col(f"__gone_{k}"))
    return docs.join(gone, same, "left_anti")


def oracle_sql() -> str:
    """DuckDB SQL for the counts and the verdict over the table ``documents``."""
    space = r"[^\x20\x09-\x0D]"
    quoted = {k: p.replace("'", "''") for k, p in CLASSES.items()}
    classes = ",\n             ".join(
        f"length(z) - length(regexp_replace(z, '{p}', '', 'g')) AS {k}" for k, p in quoted.items())
    histogram = ", ".join(HISTOGRAM)
    chars = " + ".join(HISTOGRAM)
    part = "CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / (x[1] + x[2])) ELSE 0 END"
    distance = ("sqrt(greatest(0, list_sum(list_transform(list_zip({p}, {q}), lambda x: "
                + part.format(a="x[1]") + " + " + part.format(a="x[2]") + ")) / 2))")
    return f"""
    WITH w AS (
      SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{space}+') AS ws
      FROM documents),
    f AS (
      SELECT doc_id, lang, ws, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(t) - length(array_to_string(ws, '')) AS space,
             length(t) - length(regexp_replace(t, '[a-z]', '', 'g')) AS lower,
             {classes} FROM (SELECT *, regexp_replace(t, '[a-z]', '', 'g') AS z FROM w)),
    h AS (SELECT *, word_chars - lower - {" - ".join(CLASSES)} AS rest FROM f),
    tri AS (
      SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS g
      FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w)
      WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    rep AS (
      SELECT doc_id, i FROM tri WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    cover AS (
      SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) s(k) GROUP BY doc_id),
    dup AS (
      SELECT doc_id, count(*) - count(DISTINCT line) AS n
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
      WHERE regexp_matches(line, '{space}') GROUP BY doc_id),
    words AS (
      SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(ws) AS word FROM h WHERE n_words >= {GUARD_WORDS})
      GROUP BY lang, word),
    common AS (
      SELECT lang, word, n FROM words
      QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {COMMON}),
    top AS (
      SELECT lang, list(word ORDER BY n DESC, word) AS ref_words, list(n ORDER BY n DESC, word) AS ns
      FROM common GROUP BY lang),
    sums AS (
      SELECT lang, sum(n_words) AS total, {", ".join(f"sum({k}) AS {k}" for k in HISTOGRAM)}
      FROM h WHERE n_words >= {GUARD_WORDS} GROUP BY lang HAVING sum(n_words) >= {GUARD_LANGUAGE}),
    refs AS (
      SELECT s.lang, ref_words, list_transform(ns, lambda x: x / total)
               || [greatest(0, 1 - list_sum(list_transform(ns, lambda x: x / total)))] AS ref_shares,
             list_transform([{histogram}], lambda x: x / ({chars})) AS ref_classes
      FROM sums s JOIN top ON s.lang IS NOT DISTINCT FROM top.lang),
    counted AS (
      SELECT h.*, r.ref_classes, r.ref_shares,
             list_transform(r.ref_words, lambda t: len(list_filter(h.ws, lambda x: x = t))) AS hits
      FROM h LEFT JOIN refs r ON h.lang IS NOT DISTINCT FROM r.lang AND h.n_words >= {GUARD_WORDS}),
    far AS (
      SELECT *, {distance.format(p=f"list_transform([{histogram}], lambda y: y / ({chars}))", q="ref_classes")} AS dc,
             {distance.format(p="(list_transform(hits, lambda y: y / n_words) || [(n_words - list_sum(hits)) / n_words])",
                              q="ref_shares")} AS dw
      FROM counted),
    out AS (
      SELECT far.doc_id, n_words, word_chars, symbol AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
             coalesce(cover.n, 0) AS n_repeat_words, dc, dw
      FROM far LEFT JOIN dup ON dup.doc_id = far.doc_id LEFT JOIN cover ON cover.doc_id = far.doc_id),
    judged AS (
      SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM out)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT coalesce(dc > {CLASS_LIMIT} + {CLASS_NOISE} / sqrt(n_words)
             OR dw > {WORD_LIMIT} + {WORD_NOISE} / sqrt(n_words), false) AS kept
    FROM judged"""
