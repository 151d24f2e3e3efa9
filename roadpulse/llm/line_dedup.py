"""Recurring lines found with a log-template tree.

A line is parsed to fixed depth: its token count and its first ``DEPTH`` tokens,
fields with a digit standing for any value, lead to a leaf. A leaf's template has
at each place the token that most of its lines have there, or a variable field
where none has half. A line that agrees with its leaf's template in most places
belongs to it, any other line is a template of its own. Templates that occur in
``MIN_DOCS`` documents or more are boilerplate, and their lines are dropped. Lines of
one or two tokens have leaves of their own and need a letter, so that brackets and
numbers alone are never boilerplate.

What is left of a copy would be next to nothing, and a text that only copies hold
would be gone from all of them. So of the texts that consist mostly of one and the
same set of recurring lines, one keeps them.

Built-in expressions and joins only. Line texts are moved for leaves that enough
documents share; elsewhere lines travel as hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import saved

DEPTH = 3
#: tokens from which a line is judged without regard to its letters
LONG = 3
MIN_DOCS = 10
#: share of a leaf's documents that a constant token needs, and of places in which a line must agree
CONSTANT, SIMILAR = 0.5, 0.6
ANY = "<*>"
#: leaves up to which their list (16 bytes each) is broadcast
BROADCAST_LEAVES = 500_000


def masked(line: Column) -> Column:
    """The line without outer spaces, its fields with a digit made variable."""
    line = F.trim(line)
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, "(^| )[^ 0-9]*[0-9][^ ]*", f"$1{ANY}")).otherwise(line)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines to judge: doc (its identity), hash, size of the text and of the line, pos, line (masked), leaf, key."""
    text = F.col(text_col).cast("string")
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"),
                        F.length(text).alias("size"), F.split(text, "\n").alias("lines"))
            .select("doc_id", "hash", "size", F.posexplode("lines").alias("pos", "line"))
            .withColumn("chars", F.length("line")).withColumn("line", masked(F.col("line")))
            .withColumn("tokens", F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1)
            .where((F.col("tokens") >= LONG) | F.col("line").rlike(r"\p{L}")))
    return rows.select("doc_id", "hash", F.coalesce("doc_id", "hash").alias("doc"), "size", "chars", "pos", "line",
                       F.xxhash64("tokens", F.substring_index("line", " ", DEPTH)).alias("leaf"),
                       F.xxhash64("line").alias("key"))


def templates(lines: DataFrame) -> DataFrame:
    """(leaf, key, template) of the distinct lines (leaf, key, line, n_docs): a hash, 0 for the leaf's own.

    Several lines of a leaf share its template if they agree with it in at least
    ``SIMILAR`` of their places; variable fields agree with nothing, except the
    masked ones, which are tokens like any other.
    """
    tokens = lines.select("leaf", "n_docs", F.posexplode(F.split("line", " ")).alias("at", "token"))
    votes = tokens.groupBy("leaf", "at", "token").agg(F.sum("n_docs").alias("n"))
    best = votes.groupBy("leaf", "at").agg(
        F.max_by("token", F.struct("n", "token")).alias("token"), F.max("n").alias("most"), F.sum("n").alias("all"))
    fixed = F.when(F.col("most") >= CONSTANT * F.col("all"), F.col("token"))
    form = best.groupBy("leaf").agg(
        F.sort_array(F.collect_list(F.struct("at", fixed.alias("token")))).alias("form"))
    agree = F.zip_with(F.split("line", " "), F.transform("form", lambda x: x["token"]),
                       lambda a, b: F.when(a == b, 1).otherwise(0))
    share = F.aggregate(agree, F.lit(0), lambda a, x: a + x) / F.size("form")
    return lines.join(form, "leaf").select(
        "leaf", "key", F.when(share >= SIMILAR, F.lit(0).cast("long")).otherwise(F.col("key")).alias("template"))


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(doc_id, hash, dropped): for each text with recurring lines, the places of those that go.

    Where recurring lines make up more than half of a text's characters, the text with
    the smallest id (nulls last) of all such texts with the same set of lines keeps
    them and gives no row.
    """
    all_lines = _lines(docs, id_col, text_col)
    marks = saved(all_lines.drop("line"))
    busy = saved(marks.select("leaf", "doc").distinct().groupBy("leaf").count()
                 .where(F.col("count") >= min_docs).select("leaf"))
    small = F.broadcast(busy) if busy.count() <= BROADCAST_LEAVES else busy
    texts = all_lines.join(small, "leaf").groupBy("leaf", "key").agg(F.min("line").alias("line"))
    marks = marks.join(small, "leaf")
    counts = marks.select("leaf", "key", "doc").distinct().groupBy("leaf", "key").agg(F.count("*").alias("n_docs"))
    known = saved(templates(texts.join(counts, ["leaf", "key"])))
    placed = marks.join(known, ["leaf", "key"])
    often = (placed.select("leaf", "template", "doc").distinct().groupBy("leaf", "template").count()
             .where(F.col("count") >= min_docs).select("leaf", "template"))
    keys = saved(known.join(often, ["leaf", "template"]).select("leaf", "key"))
    cuts = saved(marks.join(keys, ["leaf", "key"], "left_semi").groupBy("doc_id", "hash").agg(
        F.collect_set("pos").alias("dropped"), F.xxhash64(F.sort_array(F.collect_set("key"))).alias("lines"),
        # rows that repeat id and text come more than once
        (F.sum(F.col("chars") + 1) / (F.count("pos") / F.count_distinct("pos"))).alias("gone"),
        F.first("size").alias("size")))
    mostly = cuts.where(2 * (F.col("size") - F.col("gone")) < F.col("size"))
    keeps = mostly.groupBy("lines").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "hash")).alias("one")) \
        .select(F.col("one.doc_id").alias("kept_id"), F.col("one.hash").alias("kept_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash"))
    return cuts.join(keeps, same, "left_anti").select("doc_id", "hash", "dropped")


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row``, with n_lines, n_dropped and the text left.

    Texts that consist mostly of the same recurring lines are copies of each other,
    or hold nothing else: one of them is left whole, see ``recurring``. Null texts have no line and stay null; empty texts
    have one empty line. Rows with a null id count as documents by their text;
    repeated rows count once and are cut alike. Extra columns pass through in
    ``row``; an empty table gives an empty result.
    """
    cuts = recurring(docs, min_docs, id_col, text_col).select(
        F.col("doc_id").alias("cut_id"), F.col("hash").alias("cut_hash"), "dropped")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(text).alias("hash"), text.alias("whole"))
    lines = F.split("whole", "\n")
    rows = (rows.join(cuts, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("hash") == F.col("cut_hash")), "left")
            .select("row", "whole", F.size(F.coalesce(lines, F.array().cast("array<string>"))).alias("n_lines"), "dropped",
                    F.filter(lines, lambda x, i: ~F.coalesce(F.array_contains(F.col("dropped"), i), F.lit(False))).alias("left")))
    whole = F.col("dropped").isNull()
    return rows.select(
        "row", F.col("n_lines").cast("long").alias("n_lines"),
        F.when(whole, 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        F.when(whole, F.col("whole")).otherwise(F.array_join("left", "\n")).alias("text"))


def without_boilerplate(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """``docs`` with recurring lines taken out of ``text_col``; all other columns as they were."""
    cut = dedup_lines(docs, min_docs, id_col, text_col)
    return cut.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def oracle_sql(min_docs: int = MIN_DOCS) -> str:
    """DuckDB SQL for doc_id, n_lines, n_dropped and text of the table ``documents``."""
    return f"""
    WITH split AS (
      SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
    parsed AS (
      SELECT doc_id, pos, string_split(regexp_replace(trim(line, ' '), '(^| )[^ 0-9]*[0-9][^ ]*', '\\1{ANY}', 'g'), ' ') AS t
      FROM split),
    leaves AS (
      SELECT doc_id, pos, t, (len(t), t[1:{DEPTH}]) AS leaf FROM parsed
      WHERE len(t) >= {LONG} OR regexp_matches(array_to_string(t, ' '), '\\p{{L}}')),
    per_line AS (SELECT leaf, t, count(DISTINCT doc_id) AS n FROM leaves GROUP BY ALL),
    votes AS (
      SELECT leaf, place, token, sum(n) AS n FROM (
        SELECT leaf, n, unnest(t) AS token, unnest(range(len(t))) AS place FROM per_line) GROUP BY ALL),
    places AS (
      SELECT leaf, place, max(n) AS most, sum(n) AS total, max({{'n': n, 'token': token}}).token AS token
      FROM votes GROUP BY leaf, place),
    forms AS (
      SELECT leaf, list(CASE WHEN most >= {CONSTANT} * total THEN token END ORDER BY place) AS form FROM places GROUP BY leaf),
    judged AS (
      SELECT l.leaf, l.t, CASE WHEN len(list_filter(list_zip(l.t, f.form), lambda x: x[1] = x[2])) >= {SIMILAR} * len(l.t)
             THEN NULL ELSE l.t END AS own FROM per_line l JOIN forms f USING (leaf)),
    often AS (
      SELECT j.leaf, j.own FROM judged j JOIN leaves l ON l.leaf = j.leaf AND l.t = j.t
      GROUP BY j.leaf, j.own HAVING count(DISTINCT l.doc_id) >= {min_docs}),
    gone AS (
      SELECT DISTINCT l.doc_id, l.pos, l.t FROM leaves l JOIN judged j ON l.leaf = j.leaf AND l.t = j.t
      JOIN often o ON o.leaf = j.leaf AND o.own IS NOT DISTINCT FROM j.own),
    cut AS (
      SELECT s.doc_id, any_value(s.text) AS whole, count(*) AS n_lines, count(g.pos) AS n,
             coalesce(string_agg(s.line, chr(10) ORDER BY s.pos) FILTER (g.pos IS NULL), '') AS kept,
             list(DISTINCT g.t ORDER BY g.t) FILTER (g.pos IS NOT NULL) AS lines
      FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.pos = s.pos GROUP BY s.doc_id),
    ones AS (
      SELECT min(doc_id) AS doc_id FROM cut WHERE n > 0 AND 2 * length(kept) < length(whole) GROUP BY lines)
    SELECT c.doc_id, n_lines, CASE WHEN o.doc_id IS NOT NULL THEN 0 ELSE n END AS n_dropped,
           CASE WHEN o.doc_id IS NOT NULL THEN whole ELSE kept END AS text
    FROM cut c LEFT JOIN ones o ON o.doc_id = c.doc_id"""
