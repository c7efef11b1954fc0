"""Byte-level BPE over Arrow batches: ids, character offsets, and back to bytes and text.

Ids are packed as little-endian unsigned 32-bit integers in a binary column, a quarter of what an array of longs
takes on its way between Python and Spark. Offsets count code points; a token that holds a part of a character spans
the whole character. Decoding reverses the byte table; a piece that begins or ends inside a character keeps the cut
bytes apart, so that neighbouring pieces can be joined again.

Edge cases: null and empty texts have no ids and decode to no bytes; null ids decode as empty; repeated rows are
encoded one by one; ids of documents are passed through, null ones too; other columns are ignored by ``encode`` and
kept by ``decode``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm import units
from tallyforge.llm.common import ship, slices


def offsets(text: bytes, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one code point of every token, from the bytes that each token stands for."""
    if not len(ids):
        return np.zeros(0, "<i4"), np.zeros(0, "<i4")
    character = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1  # of each byte
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    return character[starts].astype("<i4"), (character[ends - 1] + 1).astype("<i4")


Batches = Iterator[pa.RecordBatch]


def encode(docs: DataFrame, path: str, pattern: str = units.BUILT_IN, with_offsets: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids, and with ``with_offsets`` the packed 32-bit columns starts and ends."""
    ship(docs.sparkSession)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_encoding(path, pattern, with_offsets), _encoded_schema(docs, with_offsets))


def _encoded_schema(docs: DataFrame, with_offsets: bool) -> T.StructType:
    fields = [docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if with_offsets:
        fields += [T.StructField("starts", T.BinaryType()), T.StructField("ends", T.BinaryType())]
    return T.StructType(fields)


def _encoding(path: str, pattern: str, with_offsets: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        encoder = units.encoder_of(path, pattern)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            packed = encoder(texts)
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(ids) // 4 for ids in packed], pa.int64()),
                "ids": pa.array(packed, pa.binary()),
            }
            if with_offsets:
                both = [offsets((text or "").encode(), np.frombuffer(ids, "<u4"), encoder.lengths)
                        for text, ids in zip(texts, packed)]
                columns["starts"] = pa.array([one.tobytes() for one, _ in both], pa.binary())
                columns["ends"] = pa.array([other.tobytes() for _, other in both], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


@cache
def _bytes_of_ids(path: str) -> list[bytes]:
    return units.bytes_of_ids(path)


def cut_ends(data: bytes) -> tuple[bytes, bytes, bytes]:
    """Bytes of a character that began earlier, whole characters, bytes of a character that is not complete."""
    begin = 0
    while begin < min(len(data), 3) and data[begin] & 0xC0 == 0x80:
        begin += 1
    for back in range(1, min(4, len(data) - begin + 1)):
        lead = data[-back]
        if lead & 0xC0 != 0x80:
            needed = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1
            if needed > back:
                return data[:begin], data[begin:-back], data[-back:]
            break
    return data[:begin], data[begin:], b""


def decode(encoded: DataFrame, path: str, with_text: bool = True) -> DataFrame:
    """``encoded`` with ``decoded`` (bytes) and, with ``with_text``, ``head``, ``whole`` (text) and ``tail``.

    ``head`` and ``tail`` are the bytes of characters that the piece shares with its neighbours; ids outside the
    vocabulary stand for no bytes.
    """
    ship(encoded.sparkSession)
    schema = _decoded_schema(encoded.schema, with_text)
    kept = [field.name for field in encoded.schema.fields if field.name not in _added(with_text)]
    return encoded.select(*kept).mapInArrow(_decoding(path, with_text), schema)


def _added(with_text: bool) -> list[str]:
    return ["decoded", *(["head", "whole", "tail"] if with_text else [])]


def _decoded_schema(source: T.StructType, with_text: bool) -> T.StructType:
    added, kinds = _added(with_text), {"whole": T.StringType()}
    return T.StructType([*[field for field in source.fields if field.name not in added],
                         *[T.StructField(name, kinds.get(name, T.BinaryType())) for name in added]])


def _decoding(path: str, with_text: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        table = _bytes_of_ids(path)
        known = dict(enumerate(table))
        for batch in slices(batches, "ids"):
            data = []
            for ids in batch.column("ids").to_pylist():
                numbers = np.frombuffer(ids or b"", "<u4").tolist()
                try:
                    data.append(b"".join([table[i] for i in numbers]))
                except IndexError:
                    data.append(b"".join([known.get(i, b"") for i in numbers]))
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["decoded"] = pa.array(data, pa.binary())
            if with_text:
                parts = [cut_ends(one) for one in data]
                columns["head"] = pa.array([head for head, _, _ in parts], pa.binary())
                columns["whole"] = pa.array([whole.decode("utf-8", "replace") for _, whole, _ in parts], pa.string())
                columns["tail"] = pa.array([tail for _, _, tail in parts], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def round_trip(docs: DataFrame, path: str, pattern: str = units.BUILT_IN) -> DataFrame:
    """``decode(encode(docs))`` without offsets and text, in one pass of the workers instead of two."""
    ship(docs.sparkSession)
    there, back = _encoding(path, pattern, False), _decoding(path, False)
    schema = _decoded_schema(_encoded_schema(docs, False), False)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return source.mapInArrow(lambda batches: back(there(batches)), schema)
