"""Benchmark decontamination: gapped word seeds, then Smith-Waterman alignment.

1. Every test item is cut into seeds: ``n`` of its words in order, up to ``slack`` words left out between them (three
   words and two left out; for short items two and one, or single words).  Documents are cut in the same way, so a seed
   outlives as many changed, missing or extra words.  A Bloom filter of fixed size over the seeds is the only thing sent
   to all tasks.
2. One pass over the documents keeps the seeds that pass the filter; a join with the item's seeds makes them exact.
3. Every seed counts, however frequent: whether a document is found never depends on other documents.
4. Seeds of one document and item fall into windows by diagonal (place in the document less place in the item), two
   neighbouring windows are taken together, and only the number of seeds, the least and the largest diagonal are kept.
   An alignment that reaches the threshold holds at least ``least_seeds`` seeds in such a pair of windows; pairs with
   fewer are left out, which loses nothing.
5. The words of the document around a window are aligned with the item (local alignment, +1 match, -``penalty`` for a
   substitution, a gap, or an extra word).  The score divided by the item's words is 1 for a verbatim copy; each edited
   word costs about 1 + penalty.

Why that many seeds: an alignment of m words that match and e errors scores m - penalty * e >= threshold * length.  It
holds m - n + 1 runs of n consecutive matches, and an error lies in n - 1 of them at most, so no more than
(n - 1) * e / (slack + 1) runs have over ``slack`` errors; each other run is a seed at a place of its own.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfuse.llm.common import WordHashes, mix64, texts_of, written

SEEDS = ((3, 2), (2, 1), (1, 0))  # words of a seed, words left out at most; the first that an item is long enough for
BLOOM_BITS = 1 << 23  # one megabyte, whatever the size of the benchmark; more items mean more false passes, not fewer hits
PROBES = 3
TOGETHER = 1 << 14  # words of short documents that are hashed at once
THRESHOLD, PENALTY = 0.5, 0.5
_WORD = re.compile(r"\w+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall(text.decode("utf-8", "replace").lower()) if text else []


def _hashed(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def least_seeds(length: int, n: int, slack: int, threshold: float, penalty: float) -> int:
    """Seeds that an alignment with an item of ``length`` words holds at least if it scores ``threshold`` or more."""
    if n == 1:
        return max(1, math.ceil(threshold * length - 1e-9))
    if penalty <= 0:
        return 0
    # matches - n + 1 - lost * (matches - threshold * length), linear in the matches: least at one end of their range
    lost = (n - 1) / (penalty * (slack + 1))
    return math.ceil(min(threshold * length, length - lost * (1 - threshold) * length) - n + 1 - 1e-9)


def _seed_shape(length: int, threshold: float, penalty: float) -> tuple[int, int, int]:
    """Words, words left out and least number of an item's seeds."""
    for n, slack in SEEDS:
        least = least_seeds(length, n, slack, threshold, penalty)
        if least > 0:
            break
    return n, slack, least


def _play(length: int, threshold: float, penalty: float) -> int:
    """Words that an alignment reaching the threshold has more than the item, at most."""
    return max(1, math.ceil((1 - threshold) * length / penalty)) if penalty > 0 else 1 << 40


def _choices(words: np.ndarray, n: int, slack: int):
    """For every way to leave out ``slack`` words at most between ``n`` words: the seeds' hashes by the place of their first
    word, and how far their last word is from it.  Ways that begin alike share that part of the work."""
    begun = [(0, 0, slack, np.full(len(words), n, np.uint64))]
    while begun:
        taken, end, spare, chosen = begun.pop()
        for at in range(end, end + (spare if taken else 0) + 1):
            if at >= len(words):
                break
            more = (chosen[: len(words) - at] ^ words[at:]) * _ODD
            more ^= more >> np.uint64(29)
            if taken + 1 < n:
                begun.append((taken + 1, at + 1, spare - (at - end), more))
            else:
                yield more, at


def seed_hashes(words: np.ndarray, n: int, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all choices of ``n`` words in order with ``slack`` words left out at most, and the places of their first."""
    found = [chosen for chosen, _ in _choices(words, n, slack)]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate([np.arange(len(chosen)) for chosen in found])


def _item_grams(threshold: float, penalty: float):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for key, text in zip(batch.column("item").to_pylist(), texts_of(batch.column("text")), strict=True):
                words = _hashed(text, hashes)
                if len(words):
                    n, slack, least = _seed_shape(len(words), threshold, penalty)
                    found, places = seed_hashes(words, n, slack)
                    same = (n, len(words), _play(len(words), threshold, penalty), least)
                    # a seed that two choices of words from one place give is one seed
                    rows += [(key, *seed, *same) for seed in set(zip(found.view(np.int64).tolist(), places.tolist(), strict=True))]
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["item", "gram", "place", "size", "length", "play", "least"]
            )

    return run


def _bloom(grams: DataFrame, bits: int) -> tuple[np.ndarray, list[int]]:
    """The filter's 64-bit words (three bits a gram) and the gram sizes in use; both bounded whatever the items."""
    def spots(batches):
        for batch in batches:
            g = np.array(batch.column("gram").to_pylist(), np.int64).view(np.uint64)
            found = np.concatenate([_spots(g, probe, bits) for probe in range(PROBES)])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["spot"])

    words = (
        grams.select("gram").mapInArrow(spots, "spot bigint")
        .groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits"))
    )
    out = np.zeros(bits // 64, np.uint64)
    for r in words.toLocalIterator():
        out[r.word] = np.uint64(r.bits & 0xFFFFFFFFFFFFFFFF)
    return out, sorted(r.size for r in grams.select("size").distinct().collect())


def _spots(grams: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """Places in a filter of ``bits`` bits, a power of two; the first from the seed's upper bits, which are mixed already."""
    if probe == 0:
        return (grams >> np.uint64(65 - bits.bit_length())).view(np.int64)
    return (mix64(grams + np.uint64(probe)) & np.uint64(bits - 1)).view(np.int64)


def _passing(bloom: np.ndarray, sizes: list[int], bits: int):
    def hits(texts: list[np.ndarray], first: int):
        """Seeds of these documents (rows from ``first`` on) that pass: row, seed, place.  Short documents are hashed
        together; a seed that would reach from one into the next is left out."""
        words, lengths = np.concatenate(texts), [len(x) for x in texts]
        row = np.repeat(np.arange(len(texts)), lengths)
        start = np.cumsum([0, *lengths])
        for n, slack in SEEDS:
            for g, reach in _choices(words, n, slack) if n in sizes else ():
                at = None
                for probe in range(PROBES):
                    spot = _spots(g, probe, bits)
                    hit = np.flatnonzero((bloom[spot >> 6] >> (spot & 63).view(np.uint64)) & np.uint64(1))
                    g, at = g[hit], hit if at is None else at[hit]
                inside = row[at] == row[at + reach]
                g, at = g[inside], at[inside]
                yield row[at] + first, g, at - start[row[at]]

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            found = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))]
            waiting, many = [], 0
            texts = texts_of(batch.column("text"))
            for row, text in enumerate(texts):
                waiting.append(_hashed(text, hashes))
                many += len(waiting[-1])
                if many >= TOGETHER or row == len(texts) - 1:
                    found += hits(waiting, row + 1 - len(waiting))
                    waiting, many = [], 0
            rows, grams, places = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(rows)), pa.array(grams.view(np.int64)), pa.array(places)], names=["doc", "gram", "place"]
            )

    return run


def align(item: np.ndarray, text: np.ndarray, penalty: float = PENALTY) -> tuple[float, int]:
    """Best local alignment of two arrays of word hashes: its score and the place in ``text`` after its last word."""
    steps = np.arange(len(text) + 1) * penalty
    above, best, end = np.zeros(len(text) + 1), 0.0, 0
    for word in item:
        row = np.zeros(len(text) + 1)
        row[1:] = np.maximum(above[:-1] + np.where(text == word, 1.0, -penalty), above[1:] - penalty)
        np.maximum(row, 0, out=row)
        # a gap in the item: the best value to the left less a penalty a step
        row = np.maximum.accumulate(row + steps) - steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = float(row[top]), top
        above = row
    return best, end


def _aligned(threshold: float, penalty: float):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            out = []
            items: dict = {}
            last, words = None, None
            for doc, item, low, high, text, item_text in zip(
                *(batch.column(c).to_pylist() for c in ("doc", "item", "low", "high")),
                texts_of(batch.column("text")), texts_of(batch.column("item_text")), strict=True,
            ):
                if text != last:
                    last, words = text, _hashed(text, hashes)
                if item not in items:
                    items[item] = _hashed(item_text, hashes)
                needle = items[item]
                reach = _play(len(needle), threshold, penalty)
                start = max(0, low - reach)
                around = words[start : max(0, high + len(needle) + reach)]
                # each of the item's words scores one at most, and none if it is not around
                if np.isin(needle, around).sum() < threshold * len(needle) - 1e-6:
                    continue
                score, end = align(needle, around, penalty)
                share = score / len(needle)
                if share >= threshold:
                    out.append((doc, item, share, start + end))
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64())],
                names=["doc_id", "item_id", "score", "end_word"],
            )

    return run


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", threshold: float = THRESHOLD, penalty: float = PENALTY) -> DataFrame:
    """One row per document and test item whose best alignment scores ``threshold`` or more: doc_id, item_id, score (0 to
    1, share of the item's words), end_word (words of the document up to the end of the best match).

    Null, empty or wordless texts and items match nothing, nor do rows with a null id.  Rows that share a doc_id or an
    item_id count as variants of it: the best score is given.  Other columns are ignored; empty tables give an empty
    result.
    """
    docs = docs.select(docs[id_col].cast("bigint").alias("doc"), docs[text_col].alias("text")).where("doc is not null")
    items = items.select(items[item_col].cast("bigint").alias("item"), items[item_text_col].alias("text")).where("item is not null")
    items = items.distinct()
    grams = written(
        items.mapInArrow(
            _item_grams(threshold, penalty), "item bigint, gram bigint, place bigint, size int, length bigint, play bigint, least bigint"
        )
    )
    bloom, sizes = _bloom(grams, BLOOM_BITS)
    passed = written(docs.mapInArrow(_passing(bloom, sizes, BLOOM_BITS), "doc bigint, gram bigint, place bigint"))
    hits = passed.withColumnRenamed("place", "at").join(grams, "gram")
    diagonal = F.col("at") - F.col("place")
    # an alignment's diagonals differ by ``play`` at most: they lie in one window and the next
    window = F.floor(diagonal / F.col("play"))
    each = hits.groupBy("doc", "item", "length", "least", window.alias("window")).agg(
        F.count(F.lit(1)).alias("seeds"), F.min(diagonal).alias("low"), F.max(diagonal).alias("high")
    )
    pairs = each.withColumn("window", F.explode(F.array(F.col("window") - 1, F.col("window"))))
    windows = written(
        pairs.groupBy("doc", "item", "length", "least", "window")
        .agg(F.sum("seeds").alias("seeds"), F.min("low").alias("low"), F.max("high").alias("high"))
        .where("seeds >= least")
        .select("doc", "item", "low", "high")
        .distinct()
    )
    found = (
        windows.join(items.withColumnRenamed("text", "item_text"), "item")
        .join(docs, "doc")
        .mapInArrow(_aligned(threshold, penalty), "doc_id bigint, item_id bigint, score double, end_word bigint")
    )
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "end_word")).alias("best"))
    return best.select("doc_id", "item_id", "best.score", "best.end_word")
