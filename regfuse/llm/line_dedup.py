"""Line dedup by a log-template tree.

A line is cut at white space into tokens; variable fields (tokens that hold a digit, an at sign or a scheme) become
``<*>``.  The tree has a fixed depth: a line's path is its number of tokens and its first ``DEPTH`` tokens.  A leaf's
template keeps, at each place, the token that more than half of the leaf's distinct lines share there, and has ``<*>``
elsewhere.  A line's template is

* its own masked form, if that form occurs in at least ``min_docs`` documents;
* else its leaf's template, if the line has the template's token at ``similarity`` or more of the places after its path,
  at one at least, and such lines occur in at least ``min_docs`` documents.  The path's tokens are equal by
  construction and count for nothing; so do places where both hold ``<*>``;
* else none.

Lines with a template are repeated text: they are dropped, save the first occurrence of each template (smallest
doc_id, then text digest, then line), so that no text is lost altogether.  Counting is by grouped aggregation over all
documents: lines of a leaf are never gathered, and a template has at most one token for each place.  Lines are masked
once and written; counts and joins then carry hashes, and only lines of leaves that may have a template of their own
send their text through an exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfuse.llm.common import written

DEPTH, MIN_DOCS, SIMILARITY = 3, 2, 0.75
VARIABLE = "[0-9@]|://"
SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
# a token of a squeezed line that holds a variable field; what is passed over is not tried again, however long the token
VARIABLE_TOKEN = "(?<![^ ])[^ 0-9@:]*+(?::(?!//)[^ 0-9@:]*+)*+(?:[0-9@]|://)[^ ]*+"
FIELD = "<*>"
ROW = ("doc_id", "digest")  # a document: rows with equal id and equal text are one


def masked_line(line):
    """Tokens of a line, one space between them, variable fields masked; empty for a blank line."""
    # most lines are squeezed already and hold no field: for them a few searches are all
    loose = reduce(lambda x, y: x | y, [line.contains(c) for c in ("  ", *BLANKS[1:])])
    squeezed = F.trim(F.when(loose, F.regexp_replace(line, SPACE, " ")).otherwise(line))
    # VARIABLE, as two quick searches
    variable = F.rlike(line, F.lit("[0-9@]")) | line.contains("://")
    return F.when(variable, F.regexp_replace(squeezed, VARIABLE_TOKEN, FIELD)).otherwise(squeezed)


def worded(line):
    """Whether a line is not blank."""
    return F.ltrim(line, F.lit(BLANKS)) != ""


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, digest, text): 64 bits of the text tell rows of one doc_id apart; rows without one carry 128."""
    text = F.col(text_col).cast("string")
    second = F.when(F.col(id_col).isNull(), F.xxhash64(F.lit("second"), text)).otherwise(0)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.struct(F.xxhash64(text).alias("h"), second.alias("g")).alias("digest"), text.alias("text"))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, line from 0, leaf, form, masked) of the lines that are not blank; leaf and form are hashes, masked
    is null for lines that are no longer than a path."""
    lines = docs.select(*ROW, F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    # tested on the raw line: a filter on the masked one would mask it a second time
    lines = lines.where(worded(F.col("raw"))).select(*ROW, "line", masked_line(F.col("raw")).alias("masked"))
    tokens = F.octet_length("masked") - F.octet_length(F.replace(F.col("masked"), F.lit(" "))) + 1
    lines = lines.withColumn("tokens", tokens).withColumn("path", F.concat_ws(" ", "tokens", F.substring_index("masked", " ", DEPTH)))
    return lines.select(
        *ROW, "line", F.xxhash64("path").alias("leaf"), F.xxhash64("masked", "path").alias("form"),
        F.when(F.col("tokens") > DEPTH, F.col("masked")).alias("masked"),
    )


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY) -> DataFrame:
    """Lines with a template that are not its first occurrence: doc_id, digest, line.  ``docs``: see ``keyed``."""
    lines = written(lines_of(docs))
    at = F.struct(*ROW, "line")
    # documents by form
    per_form = written(
        lines.groupBy("leaf", "form", *ROW).agg(F.min("line").alias("line"))
        .groupBy("leaf", "form").agg(F.count(F.lit(1)).alias("docs"), F.min(at).alias("first"))
    )
    own = per_form.where(F.col("docs") >= min_docs).select("form", "first")
    exact = lines.select(*ROW, "line", "form").join(own.hint("merge"), "form").where(at != F.col("first")).select(*ROW, "line")

    # leaves whose lines without a template of their own are in several documents
    other = per_form.where(F.col("docs") < min_docs).groupBy("leaf").agg(F.sum("docs").alias("n")).where(F.col("n") >= min_docs)
    forms = per_form.join(other.select("leaf").hint("merge"), "leaf").select("form", "first", (F.col("docs") >= min_docs).alias("own"))
    wide = lines.where("masked is not null").join(forms.hint("merge"), "form").withColumn("is_first", at == F.col("first"))
    wide = written(wide.where("is_first or not own").select(*ROW, "line", "leaf", "masked", "own", "is_first"))
    tokens = F.split("masked", " ")
    # one line a form; places count from 0, those of the path are skipped
    beyond = F.slice(tokens, DEPTH + 1, F.size(tokens) - DEPTH)
    places = wide.where("is_first").select("leaf", F.posexplode(beyond).alias("place", "token"))
    counts = places.groupBy("leaf", "place", "token").agg(F.count(F.lit(1)).alias("n"))
    most = counts.groupBy("leaf", "place").agg(F.sum("n").alias("all"), F.max(F.struct("n", "token")).alias("top"))
    token = F.when(2 * F.col("top.n") > F.col("all"), F.col("top.token"))
    fixed = F.array_sort(F.collect_list(F.struct("place", token.alias("token"))))
    # at most one token a place: no longer than a line.  A line can reach the similarity only where enough places are fixed
    shape = most.groupBy("leaf").agg(fixed.alias("fixed")).select("leaf", F.transform("fixed", lambda x: x.token).alias("shape"))
    enough = F.size(F.filter("shape", lambda t: t.isNotNull()))
    constant = F.exists("shape", lambda t: F.coalesce(t != FIELD, F.lit(False)))
    shape = written(shape.where((enough >= similarity * F.size("shape")) & constant))
    rest = wide.where("not own").join(shape, "leaf").select(*ROW, "line", "leaf", F.arrays_zip(beyond.alias("t"), F.col("shape").alias("s")).alias("pairs"))
    equal = F.filter("pairs", lambda x: x.t == x.s)
    masked = F.size(F.filter(equal, lambda x: x.t == FIELD))
    agree = F.size(equal) - masked
    like = written(rest.where((agree >= 1) & (agree >= similarity * (F.size("pairs") - masked))).select(*ROW, "line", "leaf"))
    per_leaf = like.groupBy("leaf", *ROW).agg(F.min("line").alias("line")).groupBy("leaf").agg(F.count(F.lit(1)).alias("docs"), F.min(at).alias("first"))
    general = like.join(per_leaf.where(F.col("docs") >= min_docs), "leaf").where(at != F.col("first")).select(*ROW, "line")
    return exact.unionByName(general)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, text (without the dropped lines), n_lines (lines that are not blank), n_dropped.

    Null text stays null with no lines, empty text empty; blank lines stay.  Rows with equal doc_id (null among them) and
    equal text are one document and treated alike; rows that share a doc_id with different texts are different documents.
    Null ids come before all others where the first occurrence is chosen.  Other columns are ignored; an empty table
    gives an empty result.
    """
    docs = keyed(docs, id_col, text_col)
    # a document's own line numbers: no longer than the document
    dropped = written(repeated_lines(docs, min_docs, similarity).groupBy(*ROW).agg(F.collect_set("line").alias("dropped")))
    d, x = docs.alias("d"), dropped.hint("merge").alias("x")
    same = F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("d.digest") == F.col("x.digest"))
    rows = d.join(x, same, "left").select("d.doc_id", "text", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))

    def parts(lines):  # the lines are an argument, so that a text is split once
        kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "dropped"), lambda i: F.get(lines, i))
        return F.struct(F.size(F.filter(lines, worded)).alias("n"), F.when(F.size("dropped") > 0, F.array_join(kept, "\n")).alias("kept"))

    rows = rows.withColumn("parts", F.transform(F.array(F.split("text", "\n")), parts)[0])
    return rows.select(
        "doc_id", F.when(F.size("dropped") == 0, F.col("text")).otherwise(F.col("parts.kept")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.col("parts.n")).cast("bigint").alias("n_lines"), F.size("dropped").cast("bigint").alias("n_dropped"),
    )
