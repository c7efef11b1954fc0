"""Packing documents into windows by multiway differencing.

Documents become ids, an end id after each. A document longer than a window fills windows of its own with its full
stretches; what remains is packed in blocks of some hundred pieces. In a block, Karmarkar-Karp differencing starts
with one partial partition per piece and always merges the two with the largest imbalance, the fullest window of one onto
the emptiest of the other, until one partition with near-equal windows is left. If a window then exceeds the capacity,
the block is packed again into more windows.

Edge cases: null and empty texts hold the end id alone; repeated rows are packed one by one, null ids too; an empty table
gives an empty result; other columns are ignored. Blocks follow the written rows, so no key can gather them in one task.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm import units
from tallyforge.llm.common import UID, ship, slices, with_uid, written

CAPACITY = 2048
END_ID = 1
#: Rows of the piece table that form a block: 2**BLOCK_BITS.
BLOCK_BITS = 10
#: Remainders are cut into pieces of at most this share of a window; smaller pieces fill windows better.
PIECES_A_WINDOW = 4


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           longest: int | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids) per piece; only full windows are longer than ``longest``."""
    ship(docs.sparkSession)
    longest = longest or max(1, capacity // PIECES_A_WINDOW)
    long = T.LongType()
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, long) for n in ("start", "length", "ids_crc32", "doc_tokens")],
                           *([T.StructField("ids", T.BinaryType())] if with_ids else [])])
    end = np.array([end_id], "<u4").tobytes()

    def bounds(n: int) -> list[tuple[int, int]]:
        full = n - n % capacity
        return [*[(at, at + capacity) for at in range(0, full, capacity)],
                *[(at, min(at + longest, n)) for at in range(full, n, longest)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = units.encoder_of(path)
        for batch in slices(batches, "text"):
            rows, starts, lengths, sums, totals, held = [], [], [], [], [], []
            for at, ids in enumerate(encoder(batch.column("text").to_pylist())):
                ids += end
                for begin, stop in bounds(len(ids) // 4):
                    part = ids[4 * begin:4 * stop]
                    rows.append(at)
                    starts.append(begin)
                    lengths.append(stop - begin)
                    sums.append(zlib.crc32(part))
                    totals.append(len(ids) // 4)
                    if with_ids:
                        held.append(part)
            columns = {"doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64()))}
            columns |= {n: pa.array(v, pa.int64()) for n, v in
                        (("start", starts), ("length", lengths), ("ids_crc32", sums), ("doc_tokens", totals))}
            if with_ids:
                columns["ids"] = pa.array(held, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indexes of ``sizes`` in ``windows`` sets of near-equal sums, by Karmarkar-Karp multiway differencing.

    A partial partition lists its non-empty windows, fullest first; the others hold nothing.
    """
    if windows <= 1 or not sizes:
        return [list(range(len(sizes)))] * (windows > 0)
    heap = [(-size, at, [(size, [at])]) for at, size in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        one, other = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        spare = windows - len(one)
        if len(other) <= spare:  # every window of the second meets an empty one
            merged = one + other
        else:
            lightest = one[::-1]
            merged = [(a[0] + b[0], a[1] + b[1]) for a, b in zip(lightest, other[spare:])]
            # the fullest of the second go onto empty windows, the next ones onto the lightest of the first
            merged += other[:spare] + lightest[len(other) - spare:]
        merged.sort(key=lambda window: -window[0])
        if len(merged) == windows:
            least = merged[-1][0]
            spread = merged[0][0] - least
        else:
            spread = merged[0][0]
        heapq.heappush(heap, (-spread, number, merged))
        number += 1
    return [members for _, members in heap[0][2]]


def fitted(sizes: list[int], capacity: int) -> list[list[int]]:
    """``differencing`` into the fewest windows tried, more whenever the fullest exceeds ``capacity``."""
    windows = max(-(-sum(sizes) // capacity), sum(2 * size > capacity for size in sizes), 1)
    while True:
        sets = differencing(sizes, windows)
        over = sum(max(0, sum(sizes[i] for i in members) - capacity) for members in sets)
        if not over:
            return sets
        windows += max(1, over // capacity)


PLACED = "sequence_id bigint, offset bigint"


def pack(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``table`` (written pieces with row numbers) with sequence_id and the gapless offset in the sequence."""
    ship(table.sparkSession)
    full = table.where(F.col("length") == capacity).withColumns({
        "sequence_id": F.col(UID) * 2 + 1, "offset": F.lit(0).cast("bigint")})
    rest = table.where(F.col("length") < capacity).withColumn("block", F.shiftright(UID, BLOCK_BITS))
    schema = T.StructType([f for f in rest.schema.fields if f.name != "block"]
                          + T._parse_datatype_string(PLACED).fields)

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by(UID)
        sizes = group.column("length").to_pylist()
        block = group.column("block")[0].as_py()
        sequence, offset = [0] * len(sizes), [0] * len(sizes)
        for number, members in enumerate(fitted(sizes, capacity)):
            at = 0
            for i in sorted(members):
                sequence[i], offset[i] = 2 * ((block << BLOCK_BITS) + number), at
                at += sizes[i]
        return group.drop_columns(["block"]).append_column("sequence_id", pa.array(sequence, pa.int64())).append_column(
            "offset", pa.array(offset, pa.int64()))

    return full.unionByName(rest.groupBy("block").applyInArrow(place, schema)).drop(UID)


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, **options) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack(written(with_uid(pieces(docs, path, capacity, end_id, **options)), "pieces"), capacity)


def sequences(placed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids (packed, padded to ``capacity``) and used, from pieces that carry their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` pieces
    rows = placed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("used"))
    body = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    pad = np.array([pad_id], "<u4").tobytes()
    padding = F.expr(f"cast(repeat('x', cast({capacity} - used as int)) as string)")
    fill = F.unhex(F.replace(padding, F.lit("x"), F.lit(pad.hex())))
    return rows.select("sequence_id", F.concat(body, fill).alias("ids"), "used")
