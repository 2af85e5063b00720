"""Token ids on disk: one zstandard frame per document, all with one shared dictionary.

Layout of a written folder (Parquet carries the bytes, so any store Spark can reach will do):

* ``dictionary``: one row with the trained dictionary, its 64-bit hash and the width of an id
  in bytes;
* ``blocks``: consecutive documents in ascending id order.  A block holds the dictionary hash,
  the ids of its documents, where the frame of each ends in ``payload`` (the offset index), their
  numbers of ids, and how many ids lie before it in its part of the order.

A single short document is read by pruning blocks on ``first_id``/``last_id`` and inflating
its frame alone.  A reader refuses blocks whose dictionary hash is not that of the dictionary.

Defined results: a null text is an empty one and has only the end id; an empty table gives an
empty folder that reads back empty; rows that repeat a document id are kept each, in the order of a
hash of their text; other columns are ignored.  The id column must be an integer column without
nulls (null ids are refused).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder
from .common import crc, hash_sample, ref, require, slices
from .tokens import encoder

# A block ends when its payload or its number of documents reaches these.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4_096
# The dictionary is trained on about so many documents, and on so many ids at most of each
# (in runs spread evenly over the document).
SAMPLE_DOCS, SAMPLE_IDS, SAMPLE_RUN = 1_000, 4_096, 512
DICTIONARY_BYTES = 64 << 10
LEVEL = 3

BLOCKS = (
    "part int, first_id bigint, last_id bigint, ids_before bigint, n_tokens bigint, dictionary_hash bigint, "
    "doc_ids array<bigint>, ends array<int>, counts array<int>, payload binary"
)


def _samples(path: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                ids, until = encoder(path).encode(part.column(1))
                out = []
                for a, b in zip(until, until[1:]):
                    own = np.append(ids[a:b], end_id).astype(f"<u{width}")
                    step = max(1, -(-len(own) // (SAMPLE_IDS // SAMPLE_RUN)))
                    out += [own[i : i + SAMPLE_RUN].tobytes() for i in range(0, len(own), max(step, SAMPLE_RUN))]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["sample"])

    return run


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    samples = sorted(s for s in samples if s)
    size = min(size, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def dictionary_hash(dictionary: bytes) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(dictionary)).astype(np.int64))


def _shared(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = _shared(dictionary)
    if shared:
        shared.precompute_compress(level=LEVEL)
    # Without the id of the dictionary in each frame: the block names it by its hash.
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_dict_id=False, write_content_size=True)


class _Block:
    def __init__(self, part: int, ids_before: int, known: int) -> None:
        self.part, self.ids_before, self.known = part, ids_before, known
        self.docs: list[int] = []
        self.ends: list[int] = []
        self.counts: list[int] = []
        self.frames: list[bytes] = []
        self.size = 0

    def add(self, doc: int, count: int, frame: bytes) -> None:
        self.size += len(frame)
        self.docs.append(doc)
        self.counts.append(count)
        self.ends.append(self.size)
        self.frames.append(frame)

    def row(self, schema: pa.Schema) -> pa.RecordBatch:
        total = sum(self.counts)
        values = (self.part, self.docs[0], self.docs[-1], self.ids_before, total, self.known,
                  self.docs, self.ends, self.counts, b"".join(self.frames))
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, schema.types)], schema=schema)


def _arrow_blocks() -> pa.Schema:
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = [pa.int32(), *[pa.int64()] * 5, longs, ints, ints, pa.binary()]
    return pa.schema(list(zip([c.split()[0] for c in BLOCKS.split(", ")], kinds)))


def _writer(path: str, end_id: int, width: int, dictionary: bytes):
    known = dictionary_hash(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, part, before = _arrow_blocks(), TaskContext.get().partitionId(), 0
        squeeze = _compressor(dictionary).compress
        block = _Block(part, before, known)
        for batch in batches:
            for some in slices(batch, 1):
                ids, until = encoder(path).encode(some.column(1))
                for doc, a, b in zip(some.column(0).to_pylist(), until, until[1:]):
                    block.add(doc, int(b - a) + 1, squeeze(np.append(ids[a:b], end_id).astype(f"<u{width}").tobytes()))
                    before += int(b - a) + 1
                    if block.size >= BLOCK_BYTES or len(block.docs) >= BLOCK_DOCS:
                        yield block.row(schema)
                        block = _Block(part, before, known)
        if block.docs:
            yield block.row(schema)

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode whole texts, append ``end_id`` to each and write them to ``folder`` in ascending id order.

    Rows are dealt out by ranges of the id and sorted inside each; a task streams its documents
    into blocks, so it holds one block and one slice of text.  The dictionary (at most 64 KB) is
    trained in the driver on a hash sample of the documents.
    """
    require(docs, id_col, text_col)
    spark = docs.sparkSession
    known = encoder(tokenizer_path).library
    width = 2 if max([end_id, *known.get_vocab(with_added_tokens=True).values()]) < 1 << 16 else 4
    own = docs.select(
        F.coalesce(ref(id_col), F.raise_error(F.lit(f"{id_col} is null"))).cast("bigint").alias("doc_id"),
        ref(text_col).alias("text"),
    )
    sample = hash_sample(own, "doc_id", SAMPLE_DOCS, docs.count())
    samples = sample.mapInArrow(_samples(tokenizer_path, end_id, width), "sample binary").collect()
    dictionary = train_dictionary([bytes(r.sample) for r in samples])
    row = [(dictionary_hash(dictionary), width, bytearray(dictionary))]
    spark.createDataFrame(row, "dictionary_hash bigint, width int, dictionary binary").write.parquet(
        f"{folder}/dictionary"
    )
    ordered = own.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    written = ordered.mapInArrow(_writer(tokenizer_path, end_id, width, dictionary), BLOCKS)
    written.write.parquet(f"{folder}/blocks")


def _dictionary(spark: SparkSession, folder: str) -> tuple[int, int, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    if dictionary_hash(bytes(row.dictionary)) != row.dictionary_hash:
        raise ValueError(f"The dictionary of {folder} is not the one its hash names")
    return row.dictionary_hash, row.width, bytes(row.dictionary)


def _documents(known: int, width: int, dictionary: bytes, starts: dict[int, int], wanted: set[int] | None):
    """Rows (doc_id, start, ids) of blocks, with only the wanted frames inflated."""
    inflate = zstandard.ZstdDecompressor(dict_data=_shared(dictionary)).decompress

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        for block in batch.to_pylist():
            if block["dictionary_hash"] != known:
                raise ValueError("A block was written with another dictionary")
            start, begin = starts[block["part"]] + block["ids_before"], 0
            for doc, end, count in zip(block["doc_ids"], block["ends"], block["counts"]):
                if wanted is None or doc in wanted:
                    yield doc, start, np.frombuffer(inflate(block["payload"][begin:end]), f"<u{width}")
                start, begin = start + count, end

    return rows


def _starts(blocks: DataFrame) -> dict[int, int]:
    """Ids before each part of the order: one number for each writing task."""
    totals = sorted(blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    ends = np.cumsum([r.n for r in totals])
    return {r.part: int(e) - r.n for r, e in zip(totals, ends)}


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    known, starts = _dictionary(spark, folder), _starts(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _documents(*known, starts, None)
        for batch in batches:
            out = [(doc, start, len(ids), crc(ids)) for doc, start, ids in rows(batch)]
            columns = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return blocks.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_token_ids(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, ids of the named documents (all, if none are named)."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    known, starts = _dictionary(spark, folder), _starts(blocks)
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        near = F.lit(False)
        for d in wanted:
            near = near | F.lit(d).between(F.col("first_id"), F.col("last_id"))
        blocks = blocks.where(near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _documents(*known, starts, wanted)
        for batch in batches:
            for doc, start, ids in rows(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc], pa.int64()), pa.array([start], pa.int64()), pa.array([ids], pa.list_(pa.int32()))],
                    ["doc_id", "start", "ids"],
                )

    return blocks.mapInArrow(run, "doc_id bigint, start bigint, ids array<int>")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the documents to a new folder of the shared scratch space and digest what reads back."""
    folder = scratch_folder(docs.sparkSession)
    write_token_files(docs, folder, tokenizer_path, end_id)
    return token_digests(docs.sparkSession, folder)
