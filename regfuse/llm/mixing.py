"""Mixing sources to target weights by pivotal dependent rounding.

Targets: every source asks for its weight's share of all words but gets at most ``max_repeat`` times its own; what is
left over is shared again among the sources below that limit.  A document then has ``target / source size`` expected
copies: the whole part is certain, the fraction is a probability that has to become 0 or 1.

Rounding: two probabilities p, q meet and mass moves from one to the other until one of them is 0 or 1: if p + q < 1 one
becomes p + q and the other 0, else one becomes 1 and the other p + q - 1; which one, is drawn so that each keeps its
expectation.  The unfinished one meets the next.  The sum never changes, so a source takes its expected number of
documents but for one, and because documents of similar length meet, its words come out close as well.

At scale: documents of a source are split by length class and by a hash into groups of about ``GROUP`` rows (a source
that holds a third of all rows is many groups); each group leaves at most one unfinished document, and these meet in a
reduction tree, ``FAN`` groups at a time, until each source has one, which is drawn alone.  Draws come from hashes of
doc_id and place, so reruns agree whatever the partitioning.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regfuse.llm.common import written

GROUP, FAN, MAX_REPEAT = 4096, 64, 3
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``sizes`` (source, source_size), a row per source -> (source, source_size, target).

    Sources by code point, null last, weigh ``weights`` in turn.  Sources are filled in the order of their limit per
    weight: those that would get more than ``max_repeat`` times their size stop there, the others share the rest."""
    n = len(weights)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # a row per source
    weighed = sizes.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(rank - 1, F.lit(n)) + 1))
    weighed = weighed.withColumn("most", max_repeat * F.col("source_size").cast("double"))
    upto = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    weighed = (
        weighed.withColumn("words", F.sum("source_size").over(whole).cast("double"))
        .withColumn("capped", F.coalesce(F.sum("most").over(upto), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    )
    # in that order the sources at their limit come first; the first one below it fixes the level, later ones give less
    level = (F.col("words") - F.col("capped")) / F.col("rest")
    below = F.when(level * F.col("weight") <= F.col("most"), level)
    weighed = weighed.withColumn("level", F.max(below).over(whole))
    return weighed.select(
        "source", "source_size", F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most"))).alias("target")
    )


def _draw(key: str, place: str) -> float:
    """A number in [0, 1) from the keys."""
    return xxhash.xxh3_64_intdigest(f"{key}\x00{place}".encode()) / 2.0**64


def pivotal(probabilities, draws) -> tuple[list[int], int, float]:
    """One pass over fractions in (0, 1): the 0/1 outcomes, and the place and probability of the unfinished one (-1, 0.0
    if none).  ``draws`` are numbers in [0, 1), one for each element."""
    out = [0] * len(probabilities)
    held, p = -1, 0.0
    for i, q in enumerate(probabilities):
        if held < 0:
            held, p = i, q
            continue
        s = p + q
        if s < 1 - 1e-12:
            held, p = (held if draws[i] * s < p else i), s
        elif s <= 1 + 1e-12:
            out[held if draws[i] < p else i] = 1
            held, p = -1, 0.0
        else:
            stays = draws[i] * (2 - s) < 1 - p  # the one held keeps the rest, the other becomes 1
            out[i if stays else held] = 1
            held, p = (held if stays else i), s - 1
    return out, held, p


def _round(level: str, last: bool = False):
    """Rounds the rows of one group, shortest documents first; one row at most stays unfinished (none, if ``last``)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_key", "text_hash"], kind="stable").reset_index(drop=True)
        draws = [_draw(key, f"{level}/{i}") for i, key in enumerate(rows["doc_key"])]
        taken, held, p = pivotal(rows["p"].tolist(), draws)
        rows["copies"] += taken
        rows["p"] = 0.0
        if held >= 0 and last:
            rows.loc[held, "copies"] += int(_draw(rows.loc[held, "doc_key"], "last") < p)
        elif held >= 0:
            rows.loc[held, "p"] = p
        return rows

    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS,
        max_repeat: int = MAX_REPEAT, seed: str = "mix") -> DataFrame:
    """One row per input row: doc_id, source, size (words ``[^\\x20\\x09-\\x0D]+`` of the text), source_size, target (its
    source's words in the mix), copies (whole number, at most ``max_repeat``), taken (copies * size).

    Null or empty text has size 0 and no copies.  A null source is a source of its own, the last.  Null or repeated
    doc_ids are rows like any other.  Rows that repeat in all of doc_id, source, and size are drawn by their place in the
    group.  Other columns are ignored; an empty table gives an empty result.
    """
    sized = written(
        docs.select(
            docs[id_col].cast("bigint").alias("doc_id"), docs[source_col].cast("string").alias("source"),
            F.coalesce(F.regexp_count(docs[text_col], F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.xxhash64(docs[text_col]).alias("text_hash"),
        )
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = written(targets(sizes, weights, max_repeat))
    klass = F.floor(F.log2(F.col("size") + 1) * 2)
    per_class = written(sized.groupBy("source", klass.alias("klass")).agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups")))
    known = goals.withColumnRenamed("source", "of")
    plan = written(per_class.join(known, per_class.source.eqNullSafe(known.of)).drop("of").withColumnRenamed("source", "of"))
    rows = sized.withColumn("k", klass)
    rows = rows.join(plan, rows.source.eqNullSafe(plan.of) & (rows.k == plan.klass)).drop("of", "k")  # small: a row per class
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    key = F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    whole = F.floor(each + 1e-12)
    rows = written(
        rows.withColumn("doc_key", key)
        .withColumn("copies", F.when(F.col("size") > 0, whole).otherwise(0).cast("bigint"))
        .withColumn("p", F.when(F.col("size") > 0, F.greatest(each - whole, F.lit(0.0))).otherwise(0.0))
        .withColumn("salt", F.pmod(F.xxhash64("doc_key", "text_hash"), F.col("groups")))
        .drop("groups")
    )
    columns = ["doc_id", "source", "size", "source_size", "target", "copies", "p", "doc_key", "text_hash", "klass", "salt"]
    rows = rows.select(columns)
    most = rows.agg(F.max("salt")).first()[0]
    finished, unfinished, level = [rows.where("p <= 1e-12")], rows.where("p > 1e-12"), 0
    while most is not None:
        rounded = written(unfinished.groupBy("source", "klass", "salt").applyInPandas(_round(str(level)), rows.schema))
        finished.append(rounded.where("p = 0"))
        unfinished = rounded.where("p > 0").withColumn("salt", F.floor(F.col("salt") / FAN))
        if most == 0:
            break
        most, level = most // FAN, level + 1
    # now a row for each source and length class at most
    finished.append(written(unfinished.groupBy("source").applyInPandas(_round("classes", last=True), rows.schema)))
    out = reduce(DataFrame.unionByName, finished)
    return out.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "text_hash"
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it.  Rows that agree in id, source and text count as copies of
    one and are given as often as their group is taken."""
    keys = ("doc_id", "source", "text_hash")
    taken = mix(docs, id_col, text_col, source_col, **options).groupBy(*keys).agg(F.sum("copies").alias("copies"))
    taken = written(taken.where("copies > 0")).alias("t")
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), docs[id_col].cast("bigint").alias("doc_id"),
        docs[source_col].cast("string").alias("source"), F.xxhash64(docs[text_col]).alias("text_hash"),
    ).alias("d")
    rows = rows.join(taken, reduce(lambda a, b: a & b, (F.col(f"d.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys)))
    first = F.row_number().over(Window.partitionBy(*(f"d.{k}" for k in keys)).orderBy(F.lit(1)))
    rows = rows.withColumn("n", first).where("n = 1")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
