"""Token ids of whole texts in ORC, in the order of document ids.

Documents are dealt by ranges of their id, encoded in Arrow batches, and written as ORC:
integer columns are run-length encoded, row indexes and Bloom filters on ``doc_id`` let a
reader skip stripes and row groups, and every stripe can be read by a task of its own.

The tokenizer drops white space and never looks across it, so each distinct word of a batch
is encoded once by the library and the ids are put together by index.

Defined cases: a null or empty text has the end id alone; rows without an id come first; rows
that repeat an id follow each other in the order of their texts' keys.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark.llm import text_bytes as tb
from tidemark.llm.distinct import Known
from tidemark.llm.frames import text_key

END_ID = 2
CHUNK_BYTES = 4 << 20
CACHED_WORDS = 1_000_000
BLOCK = 64
INDEX_STRIDE = 1000  # rows of a row group
IDS, OFFSETS = "ids", "offsets"  # folders of the files and of a number per file part
# The tokenizer always parts an ASCII letter from these, so words may be parted there too.
SIGNS = b".,;:!?*%&$#"
FILE_SCHEMA = "part int, doc_id bigint, local_start bigint, n_tokens bigint, ids array<int>"
_FILE_ARROW = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
                         ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


class WordEncoder:
    """Encodes texts by their distinct words; keeps the ids of at most ``CACHED_WORDS`` words."""

    _loaded: dict[str, WordEncoder] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith("</w>")]] = True
        self.known = Known(self._encode, CACHED_WORDS)

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """One per worker process."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _encode(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and how many each has.

        Words of letters alone have one id that ends a word, the last, so many can be encoded
        in one string; a block where that does not come out is encoded word by word.
        """
        distinct = [w.decode() for w in raw]
        letters = np.fromiter((w.isascii() and w.isalpha() for w in distinct), bool, len(distinct))
        plain, other = np.flatnonzero(letters), np.flatnonzero(~letters)
        blocks = [plain[i:i + BLOCK] for i in range(0, len(plain), BLOCK)]
        sizes, ids = np.zeros(len(distinct), np.int64), []
        for block, e in zip(blocks, self.tokenizer.encode_batch_fast(
                [" ".join([distinct[i] for i in block]) for block in blocks], add_special_tokens=False)):
            found = np.array(e.ids, np.int32)
            last = np.flatnonzero(self.ends_word[found])
            if len(last) != len(block) or last[-1] != len(found) - 1:
                each = [x.ids for x in self.tokenizer.encode_batch_fast([distinct[i] for i in block],
                                                                        add_special_tokens=False)]
                found, last = np.array(sum(each, []), np.int32), np.cumsum([len(x) for x in each]) - 1
            sizes[block] = np.diff(last, prepend=-1)
            ids.append(found)
        each = [x.ids for x in self.tokenizer.encode_batch_fast([distinct[i] for i in other], add_special_tokens=False)]
        sizes[other] = [len(x) for x in each]
        ids.append(np.fromiter((i for x in each for i in x), np.int32))
        made = np.concatenate([plain, other])
        flat, before = np.concatenate(ids), np.zeros(len(distinct), np.int64)
        before[made] = np.cumsum(sizes[made]) - sizes[made]
        return flat[tb.runs(before, sizes)], sizes

    def texts(self, column: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of texts: the ids, an end after each text, and where each text's begin."""
        for _, data, bounds in tb.chunks(column, CHUNK_BYTES):
            yield self.known.ids(data, *tb.words(data, bounds, SIGNS), end_id=end_id)


def _encoder(path: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = WordEncoder.of(path), 0
        for batch in batches:
            at = 0
            for ids, firsts in encoder.texts(batch.column(2), end_id):
                n = len(firsts) - 1
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(total + firsts[:-1]),
                    pa.array(np.diff(firsts)), pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(ids)),
                ], schema=_FILE_ARROW)
                at += n
                total += int(firsts[-1])

    return encode


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write one row per document: ids with the end id, and their place in the file's part."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    dealt = (rows.withColumns({"k": text_key(F.col("text")), "u": F.monotonically_increasing_id()})
             .repartitionByRange("doc_id", "k", "u").sortWithinPartitions("doc_id", "k"))
    (dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")
     .mapInArrow(_encoder(tokenizer, end_id), FILE_SCHEMA)
     .write.option("compression", "zstd").option("orc.bloom.filter.columns", "doc_id")
     .option("orc.row.index.stride", str(INDEX_STRIDE)).option("orc.stripe.size", str(32 << 20)).orc(f"{folder}/{IDS}"))
    parts = _files(docs.sparkSession, folder).groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = F.sum("in_part").over(W.orderBy("part")) - F.col("in_part")  # a row per file part
    parts.select("part", before.alias("before")).coalesce(1).write.parquet(f"{folder}/{OFFSETS}")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(T.StructType.fromDDL(FILE_SCHEMA)).orc(f"{folder}/{IDS}")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the files with ``start``, the ids of all documents before.

    The ids stay where they are read: a number per file part, written beside the files, is joined to
    them, a table whose size the planner knows. Filters on ``doc_id`` reach the stripes and row groups."""
    offsets = spark.read.schema("part int, before bigint").parquet(f"{folder}/{OFFSETS}")
    return _files(spark, folder).join(offsets, "part").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        values = np.asarray(lists.values).astype("<u4")
        bounds = np.asarray(lists.offsets)
        crcs = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crcs, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def checksums(tokens: DataFrame) -> DataFrame:
    """The documents with the crc32 of their ids as little-endian unsigned 32-bit integers."""
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        _crc, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
