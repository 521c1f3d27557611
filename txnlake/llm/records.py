"""Token files of length-delimited records with checksums, and a separate offset index."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from txnlake.llm.common import fresh_folder, whole
from txnlake.llm.pretokens import LONG, PIECES, REMEMBERED, Splitter, byte_letters

#: Bytes of text that one file holds, about; a file is read as a whole when it is indexed.
FILE_BYTES = 16 << 20
#: A frame is a length, its masked checksum, the payload and the payload's masked checksum; the
#: writer adds one line end. A payload is a flag for a null id, the id, the width of an id in
#: bytes and the ids.
HEAD, TAIL, LEAD = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<?qB")
MASK = 0xA282EAD8
#: Bytes of records that are handed on at a time.
BATCH_BYTES = 4 << 20
#: Files whose totals are added up together.
GROUP = 4096


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted, so that the checksum of data with checksums stays useful."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, TAIL.pack(masked(size)), payload, TAIL.pack(masked(payload))))


def frames(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, payload) of all records of a file; damage raises an error."""
    at = 0
    while at < len(data):
        size, check = HEAD.unpack_from(data, at)
        if masked(data[at:at + 8]) != check:
            raise ValueError(f"record at {at}: its length is damaged")
        end = at + HEAD.size + size
        payload = data[at + HEAD.size:end]
        if len(payload) != size or TAIL.unpack_from(data, end)[0] != masked(payload) or data[end + 4:end + 5] != b"\n":
            raise ValueError(f"record at {at}: its content is damaged")
        yield at, end + 5 - at, payload
        at = end + 5


class Encoder:
    """Ids by the tokenizers library, which is asked once for each different word it meets."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.splitter = Splitter(path, PIECES, lower=False)
        tokenizer = self.splitter.tokenizer
        tokenizer.no_truncation()
        tokenizer.no_padding()
        settings = self.splitter.settings["pre_tokenizer"] or {}
        self.by_word = (tokenizer.normalizer is None and settings.get("type") == "ByteLevel"
                        and settings["use_regex"] and not settings["add_prefix_space"])
        self.width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.model, self.letters = tokenizer.model, byte_letters()
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.splitter.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one word by the tokenizer's model."""
        tokens = self.model.tokenize("".join([self.letters[byte] for byte in word.encode()]))
        return b"".join([token.id.to_bytes(self.width, "little") for token in tokens])

    def encode(self, text: str) -> bytes:
        """Ids of a text, in self.width little-endian bytes each."""
        pieces = self.splitter.pieces(text)
        words = self.splitter.words(text) if self.by_word and len(pieces) == 1 else None
        if words is None:
            return self._whole(text)
        if len(self.known) > REMEMBERED:
            # Words still in use come back from here, so only those not met since the last time are worked out again.
            self.known, self.earlier = {}, self.known
        known, earlier, long = self.known, self.earlier, False
        for word in set(words).difference(known):
            if len(word) <= LONG:
                ids = earlier.get(word)
                known[word] = self._word(word) if ids is None else ids
            else:
                long = True
        if long:
            return b"".join([known[word] if len(word) <= LONG else self._word(word) for word in words])
        return b"".join(map(known.__getitem__, words))


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _framed_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    own = _encoder(path)
    end = int(end_id).to_bytes(own.width, "little")
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([
            framed(LEAD.pack(number is None, number or 0, own.width) + own.encode(value.as_py()) + end)
            for number, value in zip(batch["row_id"].to_pylist(), batch["text"])], pa.binary())], ["frame"])


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("row_id", pa.int64()), ("ids", pa.binary()), ("n_ids", pa.int64()),
                        ("ids_before", pa.int64())])

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        for name, content in zip(batch["path"], batch["content"]):
            rows, before, held = [], 0, 0
            for offset, length, payload in frames(content.as_py()):
                absent, number, width = LEAD.unpack_from(payload)
                ids = np.frombuffer(payload, f"<u{width}", offset=LEAD.size)
                rows.append((name.as_py(), offset, length, None if absent else number,
                             ids.astype("<u4").tobytes(), len(ids), before))
                before, held = before + len(ids), held + length
                if held > BATCH_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def write_records(rows: DataFrame, path: str, folder: str, end_id: int = 0, text: str = "text",
                  row_id: str = "doc_id", file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of every whole text, then end_id, in ascending order of the row ids.

    Rows are cut into ranges of the id (equal ids by a hash of the text, null ids first), sorted in
    their range and written as one file each, named in order. A null text is empty and holds the
    end id alone. Ids of vocabularies up to 65,536 take two bytes, others four. The files are
    written by Spark's own writer, so a lost task leaves nothing behind.
    """
    narrow = rows.select(F.col(row_id).cast("long").alias("row_id"), whole(text).alias("text"),
                         F.xxhash64(text).alias("_hash"))
    total = narrow.agg(F.coalesce(F.sum(F.octet_length("text") + 8), F.lit(0))).first()[0]
    count = max(1, -(-total // file_bytes))
    ranged = narrow.repartitionByRange(int(count), "row_id", "_hash").sortWithinPartitions("row_id", "_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _framed_batches(batches, path, end_id)

    frame = ranged.select("row_id", "text").mapInArrow(run, "frame binary")
    frame.select(F.col("frame").cast("string").alias("frame")).write.option("lineSep", "\n").text(folder)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records: file, offset, length, row_id, ids (as little-endian unsigned 32-bit), n_ids, ids_before.

    Lengths and checksums are verified. ids_before counts the ids of all earlier records of the
    file. An empty folder gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _read_batches(batches)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(
        run, "file string, offset long, length long, row_id long, ids binary, n_ids long, ids_before long")


def write_index(spark: SparkSession, folder: str, index_folder: str) -> DataFrame:
    """Write and return the offset index of a folder of records, without their ids.

    place is the file's number, start the number of ids before the record in all files together,
    ids_crc32 the checksum of its ids as little-endian unsigned 32-bit integers. A reader that
    wants rows in another order takes offset and length from here.
    """
    found = read_records(spark, folder).select(
        F.regexp_extract("file", r"part-(\d+)", 1).cast("long").alias("place"), "file", "offset", "length",
        "row_id", "n_ids", "ids_before", F.crc32("ids").alias("ids_crc32"))
    found.write.parquet(index_folder)
    index = spark.read.schema(found.schema).parquet(index_folder)
    # One row for each file, added up in groups of files and then over the groups.
    files = index.groupBy("place").agg(F.sum("n_ids").alias("n")).withColumn("part", F.floor(F.col("place") / GROUP))
    groups = files.groupBy("part").agg(F.sum("n").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    sums = lambda window: F.coalesce(F.sum("n").over(window), F.lit(0))
    first = files.withColumn("_in", sums(inside)).join(
        groups.select("part", sums(ahead).alias("_ahead")), "part").select(
        "place", (F.col("_in") + F.col("_ahead")).alias("_first"))
    return index.join(first, "place").withColumn("start", F.col("_first") + F.col("ids_before")).drop("_first")


def fetch(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """Records at the given places (file, offset, length columns of the index), in any order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    joined = files.select(F.col("path").alias("file"), "content").join(
        wanted.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("_places")), "file")
    cut = F.transform("_places", lambda place: F.struct(place["offset"].alias("offset"), F.substring(
        F.col("content"), place["offset"].cast("int") + 1, place["length"].cast("int")).alias("record")))
    return joined.select("file", F.explode(cut).alias("_one")).select("file", "_one.offset", "_one.record")


def token_records(rows: DataFrame, path: str, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Write the rows to a fresh folder and return its index."""
    folder = fresh_folder(rows.sparkSession, "records")
    write_records(rows, path, f"{folder}/files", text=text, row_id=row_id)
    return write_index(rows.sparkSession, f"{folder}/files", f"{folder}/index")
