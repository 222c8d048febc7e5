"""Near-duplicate documents by SetSketch registers, banded, estimated by likelihood, and verified.

1. Texts that are the same word sequence form one class (a 128-bit digest of the words): copies are never paired.
2. Each class gets a SetSketch: per register the minimum of an exponential variate over the shingles, truncated to
   the grid ``b**-k`` (integer ``k``).  Sketches merge by the larger register.
3. Bands of registers are bucket keys.  In each bucket every member is paired with the bucket's centre, the member that
   shares buckets with the most others (a star, linear in its size).  For sets with similarity s two members share some bucket with probability
   ``1 - (1 - s**rows) ** bands``: at 0.75 with 32 bands of 4 rows all but about 5 in a million.
4. A pair goes on if its joint likelihood (counts of larger, smaller and equal registers given both known set sizes)
   does not exclude the threshold by more than five standard deviations; then both full shingle sets are compared.
5. Components of these links.  Buckets that still hold several components leave their members open.  Open classes of
   different components meet by an exact similarity join: a set's shingles are ordered from those that one component alone
   holds over rare ones to frequent ones, and two sets that reach the threshold share one among the first of both
   (``_prefix_pairs``).  Such pairs pass step 4 too; components again.

Shingle sets are made once, of one text a class that shares a bucket with another: a Bloom filter of bounded size over
these documents' ids leaves the other texts where they are.  Tables that both grow with the corpus are joined by
sort-merge at every size.  All intermediate tables but the two that the result reads are removed.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfuse.llm.common import WordHashes, ascii_words, mix64, shingle_set, small_batches, texts_of, written
from regfuse.llm.components import components
from regfuse.session import checkpoint_dir, scratch

REGISTERS, ROWS = 128, 4
SKETCH_BASE, SKETCH_RATE, SKETCH_TOP = 1.001, 20.0, 2**16 - 1
EVIDENCE = 12.5  # log-likelihood of five standard deviations
FILTER_BITS = 1 << 26  # the Bloom filter's bound, eight megabytes: beyond it more texts pass, none is missed
PROBES = 3
_SEED = mix64(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MULT, _ADD = (_SEED[:REGISTERS] | np.uint64(1))[:, None], _SEED[REGISTERS:][:, None]


def sketch(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint16) of a set of 64-bit shingle hashes; all zero for the empty set."""
    if len(shingles) == 0:
        return np.zeros(REGISTERS, np.uint16)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(least, (shingles[None, i : i + 512] * _MULT + _ADD).min(axis=1), out=least)
    waiting = -np.log1p(-(least.astype(np.float64) + 1.0) / (2.0**64 + 2048.0)) / SKETCH_RATE
    return np.clip(np.floor(1.0 - np.log(waiting) / np.log(SKETCH_BASE)), 0, SKETCH_TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """For rows of registers: one 64-bit bucket key per band (an injective packing of the band's registers, scrambled with
    its number)."""
    packed = np.ascontiguousarray(registers).view(np.uint64)
    number = np.arange(1, packed.shape[-1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(mix64(packed) + number).view(np.int64)


def _loglik(j, larger, smaller, equal, u, v):
    """Log-likelihood of similarity ``j``; u, v: the two sizes as shares of their sum."""

    def p(x):
        return -np.log1p(-x * (SKETCH_BASE - 1) / SKETCH_BASE) / np.log(SKETCH_BASE)

    first, second = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
    tiny = 1e-12
    return (
        larger * np.log(np.maximum(first, tiny))
        + smaller * np.log(np.maximum(second, tiny))
        + equal * np.log(np.maximum(1 - first - second, tiny))
    )


def may_reach(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, threshold: float) -> np.ndarray:
    """For rows of registers a, b: False where the likelihood excludes a similarity of ``threshold`` or more."""
    larger, smaller = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    equal = REGISTERS - larger - smaller
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 65)[None, :] * top
    values = _loglik(grid, larger, smaller, equal, u, v)
    best = values.max(axis=1)
    allowed = np.where(grid >= threshold - 1e-9, values, -np.inf).max(axis=1)
    at = _loglik(np.full_like(u, threshold), larger, smaller, equal, u, v)[:, 0]
    allowed = np.maximum(allowed, np.where(top[:, 0] >= threshold - 1e-9, at, -np.inf))
    return best - allowed <= EVIDENCE


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _sketches(size: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            nodes, counts, regs = [], [], []
            for text in texts_of(batch.column("text")):
                words = ascii_words(text or b"")
                if not words:
                    nodes.append(None), counts.append(0), regs.append(None)
                    continue
                shingles = shingle_set(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), size)
                nodes.append(_digest(words)), counts.append(len(shingles)), regs.append(sketch(shingles).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(counts, pa.int64()), pa.array(regs, pa.binary())],
                names=["doc_id", "digest", "n_shingles", "registers"],
            )

    return run


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _banded(batches):
    """One row (node, size, key) per band of a class."""
    for batch in batches:
        keys = band_keys(_matrix(batch.column("registers")))
        at = pa.array(np.repeat(np.arange(batch.num_rows), keys.shape[1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node").take(at), batch.column("size").take(at), pa.array(keys.ravel())], names=["node", "size", "key"]
        )


def _spots(column: str, bits: int) -> list:
    return [F.xxhash64(column, F.lit(probe)).bitwiseAND(F.lit(bits - 1)) for probe in range(PROBES)]


def _filter(ids: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """A Bloom filter over the ids (null among them): its 64-bit words, and its bits, ten an id and bounded."""
    bits = min(FILTER_BITS, 1 << max(16, (10 * ids.count()).bit_length()))
    spots = ids.select(F.explode(F.array(*_spots(column, bits))).alias("spot"))
    words = (
        spots.groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out, bits


def _sets(words: np.ndarray, size: int):
    """Shingle sets of the documents whose ids pass the filter of these words."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            passed = np.ones(batch.num_rows, bool)
            for probe in range(PROBES):
                spot = batch.column(f"spot{probe}").to_numpy()
                passed &= (words[spot >> 6] >> (spot & 63)) & 1 == 1
            batch = batch.filter(pa.array(passed))
            nodes, sets = [], []
            for text in texts_of(batch.column("text")):
                found = ascii_words(text or b"")
                nodes.append(_digest(found) if found else None)
                sets.append(shingle_set(np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found)), size).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())],
                names=["doc_id", "digest", "shingles"],
            )

    return run


def _grams(batches):
    """One row (nid, cid, size, shingle) per shingle of a set."""
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("shingles")]
        sizes = np.array([len(x) for x in sets], np.int64)
        at = pa.array(np.repeat(np.arange(len(sets)), sizes))
        yield pa.RecordBatch.from_arrays(
            [batch.column("nid").take(at), batch.column("cid").take(at), pa.array(sizes).take(at),
             pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))],
            names=["nid", "cid", "size", "shingle"],
        )


def _prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """``sets`` (nid, cid, shingles) -> pairs (a, b) of nids, a <> b, among them every pair of different components (cid)
    with 100 * intersection >= ``percent`` * union.

    All sets are read in one order of shingles: first those that a single component holds, then by the number of sets that
    hold them.  Such a pair shares ``percent / (100 + percent)`` of both sizes together, so at the first shingle that the two
    share each has at least as many places left (its own included).  A pair is made only at shared shingles where that
    holds: sets with enough shingles of their own meet nobody, however many sets share the rest."""
    grams = written(sets.mapInArrow(_grams, "nid bigint, cid bigint, size bigint, shingle bigint"))
    common = grams.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"), F.min("cid").alias("low"), F.max("cid").alias("high")
    ).where("low <> high").select("shingle", "n")
    ordered = grams.join(common.hint("merge"), "shingle").groupBy("nid", "cid", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("shared")  # one document's shingles
    )
    left = F.expr("size(shared) - place").cast("bigint")  # shingles from this place on, itself included
    first = written(
        ordered.select("nid", "cid", "size", "shared", F.posexplode("shared").alias("place", "gram"))
        .select("nid", "cid", "size", left.alias("left"), F.col("gram.shingle").alias("shingle"))
        .where(100 * F.col("left") >= percent * F.col("size"))  # a partner has percent of this size at least
    )

    def reaches(left, size, other):
        return (100 + percent) * left >= percent * (size + other)

    parts = first.groupBy("shingle", "cid").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("least"))
    keys = parts.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("parts"), F.min("least").alias("least"), F.max_by("cid", F.struct("n", "cid")).alias("main")
    ).where("parts > 1")
    live = written(
        first.join(keys.hint("merge"), "shingle").where(reaches(F.col("left"), F.col("size"), F.col("least")))
        .select("shingle", "nid", "cid", "size", "left", "main")
    )
    # the largest component of a shingle is not compared within itself
    o, m = live.where("cid <> main").alias("o"), live.alias("m").hint("merge")
    met = o.join(
        m,
        (F.col("o.shingle") == F.col("m.shingle")) & (F.col("o.cid") != F.col("m.cid"))
        & ((F.col("m.cid") == F.col("m.main")) | (F.col("o.nid") < F.col("m.nid")))
        & reaches(F.least("o.left", "m.left"), F.col("o.size"), F.col("m.size")),
    )
    return met.select(F.least("o.nid", "m.nid").alias("a"), F.greatest("o.nid", "m.nid").alias("b")).distinct()


def _likely(threshold: float):
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue

            size_a, size_b = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("size_a", "size_b"))
            keep = may_reach(_matrix(batch.column("regs_a")), _matrix(batch.column("regs_b")), size_a, size_b, threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _verified(percent: int):
    def run(batches):
        for batch in batches:
            keep, last, first = [], None, None
            for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                a, b = a.as_buffer(), b.as_buffer()
                if last is None or not last.equals(a):
                    last, first = a, np.frombuffer(a, np.uint64)
                second = np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(first, second, assume_unique=True))
                keep.append(100 * common >= percent * (len(first) + len(second) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_())
            )

    return run


def _ordered_bytes(number):
    """Eight bytes that sort as the number does, null last (so that the smallest node has the smallest doc_id)."""
    flipped = number.bitwiseXOR(F.expr("-9223372036854775807L - 1L"))
    return F.unhex(F.coalesce(F.lpad(F.hex(flipped), 16, "0"), F.lit("FF" * 8)))


def _ordered_value(node):
    """The number that begins a node."""
    digits = F.hex(F.substring(node, 1, 8))
    number = F.conv(digits, 16, -10).cast("bigint").bitwiseXOR(F.expr("-9223372036854775807L - 1L"))
    return F.when(digits != "FF" * 8, number)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    percent: int = 75) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id in reach), kept, class_id (hex digest of
    the word sequence; null without words).

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  Two documents are linked when 100 * intersection >=
    ``percent`` * union of their distinct ``shingle_words``-word shingles (fewer words: one shingle of all words).
    Null, empty or blank text: n_shingles 0, linked with nothing.  Null doc_id: such rows are linked by their text like
    any other; a component whose doc_ids are all null has a null component_id, and its rows count as kept.  Rows that
    share a doc_id are judged each by its own text.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    rows = written(
        docs.mapInArrow(_sketches(shingle_words), "doc_id bigint, digest binary, n_shingles bigint, registers binary")
    )
    path = f"{checkpoint_dir(spark).rstrip('/')}/classes-{uuid.uuid4().hex}"
    with scratch(spark):
        _classes(docs, rows, shingle_words, percent).write.parquet(path)
    classes = spark.read.parquet(path)
    out = rows.where("digest is not null").select("doc_id", "n_shingles", "digest").join(classes.hint("merge"), "digest")
    out = out.select(
        "doc_id", "n_shingles", "component_id", F.lower(F.hex("digest")).alias("class_id")
    ).unionByName(
        rows.where("digest is null").select(
            "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("string").alias("class_id"),
        )
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        "doc_id", "n_shingles", "component_id", "kept", "class_id"
    )


def _classes(docs: DataFrame, rows: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """(digest, component_id) of every class of equal word sequences."""
    nodes = written(
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("size"), F.any_value("registers").alias("registers"))
        .withColumn("node", F.concat(_ordered_bytes(F.col("rep")), "digest"))
    )
    banded = nodes.select("node", "size", "registers").mapInArrow(_banded, "node binary, size bigint, key bigint")
    buckets = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(banded.join(buckets.hint("merge"), "key"))
    # the member that shares buckets with the most others is nearest to all of them: an original among its edited copies
    shared = written(members.groupBy("node").agg(F.sum("n").alias("shared")))
    centres = written(
        members.select("key", "node").join(shared.hint("merge"), "node").groupBy("key")
        .agg(F.max(F.struct("shared", "node")).alias("top")).select("key", F.col("top.node").alias("centre"))
    )

    # one text for each class that shares a bucket: of the document with its smallest doc_id
    grouped = written(nodes.join(shared.hint("merge"), "node").select("node", "rep", "size", "registers"))
    words, bits = _filter(grouped, "rep")
    spots = [c.alias(f"spot{probe}") for probe, c in enumerate(_spots("doc_id", bits))]
    sets = docs.select("doc_id", "text", *spots).mapInArrow(_sets(words, shingle_words), "doc_id bigint, digest binary, shingles binary")
    sets = sets.where("digest is not null").select(F.concat(_ordered_bytes(F.col("doc_id")), "digest").alias("node"), "shingles")
    sets = sets.join(grouped.select("node").hint("merge"), "node", "left_semi").dropDuplicates(["node"])
    sets = written(sets.withColumn("nid", F.monotonically_increasing_id()))

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose full sets reach the threshold."""
        a, b = (grouped.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("registers").alias(f"regs_{c}"))
                .hint("merge") for c in ("a", "b"))
        fits = 100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")
        likely = written(pairs.join(a, "a").join(b, "b").where(fits).mapInArrow(_likely(percent / 100), "a binary, b binary"))
        a, b = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}")).hint("merge") for c in ("a", "b"))
        return written(likely.join(b, "b").join(a, "a").mapInArrow(_verified(percent), "a binary, b binary"))

    stars = members.select("key", "node").join(centres.hint("merge"), "key").where("node <> centre")
    found = components(linked(written(stars.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())))

    # members of buckets of three or more that still hold several components (pairs with the centre are known)
    placed = written(
        members.where("n > 2").join(found.hint("merge"), "node", "left")
        .select("key", "node", F.coalesce("component", "node").alias("component"))
    )
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    open_ = placed.join(mixed.hint("merge"), "key").select("node", "component").distinct()
    ids = sets.select("node", "nid")
    open_ = written(
        open_.join(sets.hint("merge"), "node")
        .join(ids.select(F.col("node").alias("component"), F.col("nid").alias("cid")).hint("merge"), "component")
        .select("nid", "cid", "shingles")
    )
    rest = _prefix_pairs(open_, percent)
    for c in ("a", "b"):
        rest = rest.join(ids.select(F.col("nid").alias(c), F.col("node").alias(f"node_{c}")).hint("merge"), c)
    rest = written(rest.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    if not rest.isEmpty():
        known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(known.unionByName(linked(rest)))
    return nodes.join(found.hint("merge"), "node", "left").select(
        "digest", _ordered_value(F.coalesce("component", "node")).alias("component_id")
    )
