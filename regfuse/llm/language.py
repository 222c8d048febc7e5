"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased, everything but letters becomes one space, and runs of one to three characters are hashed into
``buckets`` features.  Counts per language come from grouped sums over the training rows; the log-probability matrix
(languages x buckets) goes to every task.  It has at most ``MATRIX_CELLS`` cells: more languages than that allows are an
error, and the caller chooses fewer buckets.  Texts are scored in numpy
by summing the rows of the features they hold, in pieces, so a very long text needs no more memory than a piece.

Training rows: at most about ``FIT_ROWS`` a language, those with the smallest hash of their id, as counted beforehand.
"""

from __future__ import annotations

import codecs
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfuse.llm.common import texts_of

ORDERS, BUCKETS, MATRIX_CELLS = 3, 1 << 14, 1 << 24
FIT_ROWS, SMOOTHING = 20_000, 0.5
UNKNOWN = "und"
PIECE = 1 << 18  # bytes


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = ord(chr(c).lower()[0])
    return out


def features(text: bytes | None, buckets: int = BUCKETS):
    """Feature numbers of a UTF-8 text, an array for each piece; nothing for a text without letters."""
    text, decoder = text or b"", codecs.getincrementaldecoder("utf-8")("replace")
    before = np.full(1, 32, np.uint32)  # the last characters of the pieces before
    started = False
    for i in range(0, len(text), PIECE):
        points = np.frombuffer(decoder.decode(text[i : i + PIECE], i + PIECE >= len(text)).encode("utf-32-le"), np.uint32)
        if not len(points):  # a piece within a character
            continue
        part = np.concatenate([before, _letters()[points]])
        space = part == 32
        keep = np.ones(len(part), bool)
        keep[len(before) :] = ~(space[len(before) :] & space[len(before) - 1 : -1])
        part = part[keep]
        if not started and (part == 32).all():
            continue
        started, found, h = True, [], np.zeros(len(part), np.uint32)
        for order in range(1, ORDERS + 1):
            h = h[: len(part) - order + 1] * np.uint32(0x01000193) + part[order - 1 :] + np.uint32(order)
            ends = h[max(0, len(before) - order + 1) :]  # runs that end in this piece
            mixed = (ends ^ (ends >> np.uint32(15))) * np.uint32(0x9E3779B1)
            found.append((mixed >> np.uint32(8)) % np.uint32(buckets))
        before = part[-(ORDERS - 1) :]
        yield np.concatenate(found)


def _counts(buckets: int):
    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch.column("text")), strict=True):
                for f in features(text, buckets):
                    if lang not in totals:
                        totals[lang] = np.zeros(buckets, np.int64)
                    np.add.at(totals[lang], *np.unique(f, return_counts=True))
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    return run


def train(rows: DataFrame, fit_rows: int = FIT_ROWS, buckets: int = BUCKETS):
    """``rows`` (doc_id, text, lang non-null) -> (languages in order, log-probabilities [bucket, language], log priors)."""
    counted = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    most = MATRIX_CELLS // buckets
    known = sorted((r.lang, r.n) for r in counted.limit(most + 1).collect())  # a row per language
    if len(known) > most:
        raise ValueError(f"more than {most} languages: a matrix of {buckets} buckets would exceed {MATRIX_CELLS} cells; set fewer buckets")
    # at most ``most`` rows
    rates = rows.sparkSession.createDataFrame([(lang, fit_rows / n) for lang, n in known], "lang string, rate double")
    share = (F.xxhash64("doc_id", F.lit("language")).cast("double") + 2.0**63) / 2.0**64
    picked = rows.join(F.broadcast(rates), "lang").where((F.col("rate") >= 1) | (share < F.col("rate")))
    grams = picked.select("lang", "text").mapInArrow(_counts(buckets), "lang string, bucket int, n bigint")
    sums = grams.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # a row per cell
    langs = [lang for lang, _ in known]
    table = np.zeros((buckets, len(langs)))
    place = pc.index_in(sums["lang"], pa.array(langs, pa.string())).to_numpy()
    table[sums["bucket"].to_numpy(), place] = sums["n"].to_numpy()
    table += SMOOTHING
    priors = np.log(np.array([n for _, n in known], float) / max(1, sum(n for _, n in known)))
    return langs, np.log(table / table.sum(axis=0, keepdims=True)), priors


def classify(text: bytes | None, langs: list[str], table: np.ndarray, priors: np.ndarray) -> tuple[str, float]:
    """The most probable language and its posterior; ``und`` and 0.0 for a text without letters or an empty model."""
    total, seen = priors.copy(), False
    for f in features(text, len(table)):
        seen = True
        total += table[f].sum(axis=0)
    if not seen or not langs:
        return UNKNOWN, 0.0
    best = int(total.argmax())
    return langs[best], float(1 / np.exp(total - total[best]).sum())


def _predict(langs, table, priors):
    def run(batches):
        for batch in batches:
            found = [classify(t, langs, table, priors) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5,
             fit_rows: int = FIT_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """One row per input row: doc_id, held_out (crc32 of the id as text is divisible by ``folds``; never trained on),
    lang_pred, score (posterior).

    Learns only from text and non-null language of the other rows; languages are ``lang_col``'s values, ties go to the
    first by code point.  Null or empty text, or one without letters: ``und``, 0.0.  A null id counts as empty text (its
    crc32 is 0: held out).  With nothing to learn from, all rows are ``und``.  Repeated rows are all counted and all
    predicted; other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs = docs.withColumn("held_out", F.crc32(name.cast("binary")) % folds == 0)
    model = train(docs.where("not held_out and lang is not null").select("doc_id", "text", "lang"), fit_rows, buckets)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    return docs.select("doc_id", "held_out", "text").mapInArrow(_predict(*model), schema)
