"""Token ids in a compact store: one zstandard frame per document, a shared dictionary, an offset index.

A store is a folder with two parquet tables that Spark writes and any Spark reader opens:

``dictionary``  one row: ``dict_hash`` (hex sha256), ``dictionary`` (zstandard dictionary trained on serialized id arrays)
``laid``        block rows: ``part``, ``block``, ``dict_hash``, ``bytes`` (frames of consecutive documents, end to end);
                index rows, one per document: ``part``, ``block``, ``offset``, ``length``, ``row``, ``doc_id``, ``n_tokens``

Documents are range-partitioned by doc_id, so ``(part, row)`` is ascending doc_id order.  A frame decompresses alone
(ids as little-endian unsigned 32-bit integers), so one document is read from one slice of one block; a reader checks
``dict_hash`` before it decompresses.  Only the dictionary's training sample (see ``train_dictionary``) reaches the driver.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import os
import re
import sys
import uuid
import zlib
from array import array
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regfuse.llm.common import sampled, small_batches, texts_of, written
from regfuse.session import checkpoint_dir

END_ID = 0
BLOCK_BYTES = 1 << 20
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_IDS, DICTIONARY_BYTES = 1000, 8192, 1024, 32 << 10
BATCH_TEXTS = 64  # texts given to the library at once
ROWS = 1024  # texts encoded, and written to Arrow, at once


class _Pieces(dict):
    """Ids (little-endian unsigned 32-bit) of words after a space, and after a newline that the word begins with, remembered
    in two halves: when the newer one is full the older one goes, so memory is bounded and frequent words stay.

    Words of letters that take two bytes at most, digits and ASCII signs are cut into pieces here, as byte-level BPE cuts
    them, and the library's model gets each piece; it cuts all others itself."""

    limit, longest = 600_000, 64
    letters = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
    plain = re.compile("[!-&(-~À-ÖØ-öø-ɏ]*")  # without an apostrophe, which may begin a piece of its own with letters
    cut = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+|[0-9]+|[!-/:-@[-`{-~]+")

    def __init__(self, tokenizer, encode):
        self.tokenize, self.encode, self.older = tokenizer.model.tokenize, encode, {}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        # the character by which the model knows each byte
        self.written = "".join(chr(256 + others.index(b)) if b in others else chr(b) for b in range(256))
        self.newline = self.piece("\n")
        self.stops = {c: self.piece(c) for c in ".,;:!?"}

    def piece(self, text: str) -> bytes:
        return _bytes([t.id for t in self.tokenize(codecs.charmap_decode(text.encode(), "strict", self.written)[0])])

    def made(self, word: str) -> bytes:
        if word[:1] == "\n":
            if not self.plain.fullmatch(word, 1):
                return self.newline + self.encode([word[1:]])[0]
            return self.newline + b"".join(map(self.piece, self.cut.findall(word)))
        if not self.plain.fullmatch(word):
            return self.encode([" " + word])[0]
        first, *rest = self.cut.findall(word) or [""]
        return b"".join(map(self.piece, [" " + first, *rest]))

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if self.letters.fullmatch(word):  # most words
                ids = self.piece(" " + word)
            elif word[-1:] in self.stops and self.letters.fullmatch(word[:-1]):
                known = word[:-1] in self or word[:-1] in self.older
                ids = self[word[:-1]] + self.stops[word[-1]]
                if not known:  # a rare word is remembered once
                    return ids
            else:
                ids = self.made(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit // 2:
                self.older = self.copy()
                self.clear()
            self[word] = ids
        return ids

    def forget(self) -> None:
        self.clear()
        self.older = {}


def _splits_at_spaces(tokenizer_json: str) -> bool:
    """Byte-level BPE whose words carry their leading space: a text's ids are those of its words, each with the space or
    newline before it, one after the other, where ``_RUN`` finds nothing."""
    kind = json.loads(tokenizer_json)
    before = kind.get("pre_tokenizer") or {}
    return (
        kind.get("normalizer") is None and not kind.get("truncation") and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space") and before.get("use_regex", True) and kind["model"].get("type") == "BPE"
    )


# white space between two others, or last and after another: there a space or newline need not begin a piece
_SWAPPED = sys.byteorder == "big"
_RUN = re.compile(r"\s[ \n](?:\s|\Z)")


def _bytes(ids: list[int]) -> bytes:
    ids = array("I", ids)  # four bytes an id
    if _SWAPPED:
        ids.byteswap()
    return ids.tobytes()


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_json: str):
    """texts -> for each the bytes of its ids and the end id.  ``forget`` of the result drops the words it remembers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    # a text that holds one of these is split around it by the library
    added = [t["content"] for t in json.loads(tokenizer_json).get("added_tokens") or []]
    end = END_ID.to_bytes(4, "little")

    def library(texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), BATCH_TEXTS):
            out += [_bytes(e.ids) for e in tokenizer.encode_batch_fast(texts[i : i + BATCH_TEXTS], add_special_tokens=False)]
        return out

    if not _splits_at_spaces(tokenizer_json):
        whole = lambda texts: [x + end for t in texts for x in library([t])]
        whole.forget = lambda: None
        return whole
    pieces = _Pieces(tokenizer, library)

    def encode(texts: list[str]) -> list[bytes]:
        begun = ["\n" + t for t in texts]  # so that the first word is one after a newline
        odd = [_RUN.search(b) is not None or any(t in b for t in added) for b in begun]
        # the words of all the other texts: each different one is looked up once
        words = pc.split_pattern(pa.array([b.replace("\n", " \n")[1:] for b, o in zip(begun, odd, strict=True) if not o], pa.large_string()), " ")
        coded = words.flatten().dictionary_encode()
        ids = pa.array(map(pieces.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[words.offsets.to_numpy()].tolist() if len(words) else [0]
        data, skip = memoryview(ids.buffers()[2] or b""), len(pieces.newline)
        plain = (bytes(data[x + skip : y]) for x, y in pairwise(ends))
        return [(library([t])[0] if o else next(plain)) + end for t, o in zip(texts, odd, strict=True)]

    encode.forget = pieces.forget
    return encode


def _decoded(column) -> list[str]:
    return [(t or b"").decode("utf-8", "replace") for t in texts_of(column)]


def train_dictionary(docs: DataFrame, tokenizer_json: str) -> bytes:
    """A dictionary from the first ids of about ``SAMPLE_DOCS`` documents, chosen by the hash of their id (at most
    ``SAMPLE_IDS`` ids of ``SAMPLE_CHARS`` characters each, the bound of what reaches the driver); empty where there is
    too little to train on."""
    begun = F.substring("text", 1, SAMPLE_CHARS).alias("text")
    picked = sampled(docs.where("text is not null"), SAMPLE_DOCS, "doc_id").select(begun)

    def sample(batches):
        encode = _encoder(tokenizer_json)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[: 4 * SAMPLE_IDS] for x in encode(_decoded(batch.column("text")))], pa.binary())], names=["ids"]
            )

    samples = [bytes(r.ids) for r in picked.mapInArrow(sample, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples)).as_bytes()
    except zstandard.ZstdError:
        return b""


def _frames(tokenizer_json: str, dictionary: bytes):
    def run(batches):
        encode = _encoder(tokenizer_json)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=3, dict_data=shared, write_dict_id=False)
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            ids = encode(_decoded(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(pack.compress, ids), pa.binary())],
                names=["doc_id", "n_tokens", "frame"],
            )
        encode.forget()  # a worker outlives its tasks

    return run


def _blocks(dict_hash: str):
    """Frames of one partition, in order, laid into blocks; index rows and block rows share one schema."""

    def row(part, block, data=None, **index):
        keys = ("offset", "length", "row", "doc_id", "n_tokens")
        return {"part": part, "block": block, "dict_hash": dict_hash, "bytes": data, **{k: index.get(k) for k in keys}}

    def run(batches):
        from pyspark import TaskContext

        part, block, at, number, held, rows = TaskContext.get().partitionId(), 0, 0, 0, [], []
        schema = pa.schema(
            [("part", pa.int32()), ("block", pa.int64()), ("dict_hash", pa.string()), ("bytes", pa.binary())]
            + [(k, pa.int64()) for k in ("offset", "length", "row", "doc_id", "n_tokens")]
        )
        for batch in batches:
            for doc_id, n, frame in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame")), strict=True):
                rows.append(row(part, block, offset=at, length=len(frame), row=number, doc_id=doc_id, n_tokens=n))
                held.append(frame)
                number, at = number + 1, at + len(frame)
                if at >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_pylist([*rows, row(part, block, b"".join(held))], schema)
                    block, at, held, rows = block + 1, 0, [], []
        if rows:
            yield pa.RecordBatch.from_pylist([*rows, row(part, block, b"".join(held))], schema)

    return run


def write_store(docs: DataFrame, path: str, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text (null: empty) and write a store at ``path``, a folder that does not exist yet.

    Documents are in ascending doc_id order, null ids first; rows that share a doc_id are all stored, in the order of
    their compressed bytes.  An empty table gives an empty store; other columns are ignored."""
    docs = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    spark = docs.sparkSession
    small_batches(spark)
    dictionary = train_dictionary(docs, tokenizer_json)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )
    frames = written(docs.mapInArrow(_frames(tokenizer_json, dictionary), "doc_id bigint, n_tokens bigint, frame binary"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("frame")]
    laid = (
        frames.repartitionByRange(n, *order)
        .sortWithinPartitions(*order, "frame")
        .mapInArrow(
            _blocks(dict_hash),
            "part int, block bigint, dict_hash string, bytes binary, offset bigint, length bigint, row bigint, doc_id bigint, n_tokens bigint",
        )
    )
    laid.write.parquet(f"{path}/laid")


def index_of(spark: SparkSession, path: str) -> DataFrame:
    """The offset index: one row per document."""
    return spark.read.parquet(f"{path}/laid").where("row is not null").drop("bytes")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the store: part, row, doc_id, n_tokens, ids (little-endian unsigned 32-bit integers)."""
    blocks, unpacked = _stored(spark, path)
    return blocks.mapInArrow(unpacked, "part int, row bigint, doc_id bigint, n_tokens bigint, ids binary")


def _stored(spark: SparkSession, path: str):
    """The store's blocks with their index rows, and what unpacks them."""
    small_batches(spark)  # a block row is about 1 MB
    dictionary = {r.dict_hash: bytes(r.dictionary) for r in spark.read.parquet(f"{path}/dictionary").collect()}
    laid = spark.read.parquet(f"{path}/laid")
    blocks = laid.where("bytes is not null").select("part", "block", "dict_hash", "bytes")
    index = index_of(spark, path).groupBy("part", "block").agg(F.collect_list(F.struct("offset", "length", "row", "doc_id", "n_tokens")).alias("docs"))
    return blocks.join(index, ["part", "block"]), _unpacked(dictionary)


def _unpacked(dictionary: dict[str, bytes]):
    def run(batches):
        readers = {}
        for batch in batches:
            for part, key, data, docs in zip(*(batch.column(c) for c in ("part", "dict_hash", "bytes", "docs")), strict=True):
                key = key.as_py()
                if key not in readers:
                    raw = dictionary[key]
                    if hashlib.sha256(raw).hexdigest() != key:
                        raise ValueError("the store's dictionary does not match its hash")
                    readers[key] = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
                data, rows = memoryview(data.as_buffer()), docs.as_py()
                ids = [readers[key].decompress(data[d["offset"] : d["offset"] + d["length"]]) for d in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * len(rows), pa.int32())]
                    + [pa.array([d[k] for d in rows], pa.int64()) for k in ("row", "doc_id", "n_tokens")]
                    + [pa.array(ids, pa.binary())],
                    names=["part", "row", "doc_id", "n_tokens", "ids"],
                )

    return run


def _sums(batches):
    for batch in batches:
        sums = [zlib.crc32(x.as_buffer()) for x in batch.column("ids")]
        lengths = [len(x.as_buffer()) // 4 for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("row"), batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
            names=["part", "row", "doc_id", "n_tokens", "ids_crc32"],
        )


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document, from its decompressed ids: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32."""
    blocks, unpacked = _stored(spark, path)
    # the sums are made where the ids are, which need not leave the task for them
    sums = blocks.mapInArrow(lambda batches: _sums(unpacked(batches)), "part int, row bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint")
    read = written(sums)
    parts = read.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))  # a row per partition
    inner = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        read.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
        .join(parts, "part")
        .select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
    )


def encode_documents(docs: DataFrame, tokenizer_json: str, path: str | None = None, **columns) -> DataFrame:
    """Write a store (at ``path``, or a new folder of the shared checkpoint folder) and return its ``digests``."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/token-store-{uuid.uuid4().hex}"
    write_store(docs, path, tokenizer_json, **columns)
    return digests(spark, path)
