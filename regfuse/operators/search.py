"""Company search: many terms at once against an inverted index of name parts.

``build_index`` writes, once, the distinct companies and the postings of their names: every run of one, two and three
characters of a normalised name, with the company's number.  ``search`` joins a table of terms to it: a term can only be contained
in names that hold all its parts, so the rarest of them is looked up and the few companies found are verified by ``contains``.
Nothing is scanned per term, and no term is too short.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regfuse.functions import text as tx
from regfuse.session import materialize

GRAM = 3


@dataclass(frozen=True)
class NameIndex:
    """companies: entry, rut, empresa, name.  postings: gram, entry, in order of gram.  counts: gram, n."""

    companies: DataFrame
    postings: DataFrame
    counts: DataFrame


def _grams(name: str, size) -> Column:
    """Distinct runs of ``size`` characters (a name is ASCII after normalisation)."""
    places = F.sequence(F.lit(1), F.length(name) - size + 1)
    runs = F.transform(places, lambda i: F.substring(F.col(name), i, F.lit(size)))
    return F.when(F.length(name) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def build_index(rows: DataFrame, id_col: str = "rut", name_col: str = "empresa") -> NameIndex:
    """Index of the distinct (id, name) pairs of ``rows``; the tables are written in the session's checkpoint folder.

    A name that is NULL, or has no letter or digit, is found by its id only.  Two companies may share a number (a 64-bit
    hash): both are then verified, so no hit is lost and none is wrong."""
    companies = rows.select(F.col(id_col).cast("string").alias("rut"), F.col(name_col).alias("empresa")).distinct()
    companies = companies.withColumn("name", tx.normalize_name("empresa")).withColumn("entry", F.xxhash64("rut", "empresa"))
    companies = materialize(companies)
    grams = F.explode(F.concat(*[_grams("name", n) for n in range(1, GRAM + 1)]))
    postings = companies.where(F.length("name") > 0).select(grams.alias("gram"), "entry").distinct()
    # in ranges of (gram, entry): a reader of one gram skips the files of others, and a frequent gram is in many files
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    postings = materialize(postings.repartitionByRange(parts, "gram", "entry").sortWithinPartitions("gram", "entry"))
    return NameIndex(companies, postings, materialize(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))))


def search(index: NameIndex, terms: DataFrame, term_col: str = "term") -> DataFrame:
    """(term, rut, empresa) of every company whose normalised name contains the normalised term, or whose id is the term's
    digits.  Terms are taken once each; one without letters or digits finds nothing."""
    t = terms.select(F.col(term_col).alias("term")).where(F.col("term").isNotNull()).distinct()
    t = t.withColumns({"wanted": tx.normalize_name("term"), "digits": tx.normalize_rut("term")})
    t = t.where(F.length("wanted") > 0)
    size = F.least(F.length("wanted"), F.lit(GRAM))
    parts = t.withColumn("_size", size).withColumn(
        "gram", F.explode(F.transform(F.sequence(F.lit(1), F.length("wanted") - F.col("_size") + 1),
                                      lambda i: F.substring(F.col("wanted"), i, F.col("_size")))))
    # a part that no name holds counts 0: its term has no hit, and no posting is read for it
    counted = parts.join(index.counts, "gram", "left")
    order = Window.partitionBy("term").orderBy(F.coalesce("n", F.lit(0)), "gram")
    rarest = counted.withColumn("_place", F.row_number().over(order)).where(F.col("_place") == 1).select("term", "wanted", "gram")
    found = rarest.join(index.postings, "gram").join(index.companies, "entry").where(F.col("name").contains(F.col("wanted")))
    by_id = t.where(F.col("digits").isNotNull()).join(index.companies, F.col("digits") == F.col("rut"))
    return found.select("term", "rut", "empresa").unionByName(by_id.select("term", "rut", "empresa")).distinct()
