r"""A class-based bigram model in the manner of Brown et al., trained by exchange clustering.

A word's probability is that of its class after the class before, times its share of the class. Classes come from the
exchange algorithm: each word moves to the class that raises the likelihood of the class bigrams most.

1. Documents are dealt to chunks. Each chunk numbers its distinct words; their counts, packed and split by hash, are summed
   per hash range and handed back to the chunks that asked, so a word costs one entry per chunk, not one per occurrence.
2. Each chunk turns its documents into numbers of units, one line of all of them in a few rows, training documents first, and sums
   per document what depends on the words alone. Both tables are bucketed by chunk, so that later steps read a chunk without a
   shuffle, and a round reads these few rows of it.
3. In an exchange round every chunk counts, in one pass, its class bigrams and which classes stand before and after the units of
   this turn, the counts are summed per unit in ranges of hashes, each range decides its units' moves, and the new classes go back
   to the chunks that have these units, one byte each. A unit may move once in ``TURNS`` rounds. Only the table of class bigrams is sent to every task.
   Rounds go on until the likelihood stops rising.

Units: every word seen twice or more is a unit, known by its 64-bit hash; words seen once share units by their ending. An
unknown word belongs to the class of the once-seen words with its ending. Within a class, the share of words seen once is the
probability of an unknown word (one event, as in the base score).

Only class bigrams reach the driver or a closure; counts cover all documents.
Edge cases: null and empty texts hold the end token alone; repeated rows count as often as they occur; a missing id counts
as an empty text in the fold; without training tokens the model's score is the base score; a text longer than a chunk is a
chunk's whole or more and is held in one task, as any row is; an empty table has no scores; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import UID, bucketed, forget, lean, lean_pair, ship, text_of, utf8, with_uid, written

FOLDS, HELD_OUT = 7, 2
#: Bytes of text per chunk: bounds a task's memory.
CHUNK_BYTES = 16 << 20
#: Tokens per row of a chunk's line (256 KB): a JVM keeps buffers of half a megabyte apart from the young ones that it frees at once.
PIECE = 1 << 16
CLASSES = 32
#: Rounds in which every unit may move once; moving all at once would overshoot.
TURNS = 4
#: The likelihood has stopped rising when TURNS rounds gain less than this share of it.
LEAST_GAIN = 1e-3
#: Endings that words seen once share.
TAIL = 1 << 13
#: Units that are moved together have at most this share of all tokens, and are at most so many.
STEP_SHARE, STEP_UNITS = 0.0005, 1024
#: Counts up to this one are taken together in a step.
SMALL = 64
#: Chunks per hash range of the exchange.
RANGE_CHUNKS = 4
#: The bit of a byte, above the class, for a unit that words seen once share.
SHARED = 7
#: Set in the number of an unknown word beside its unit.
UNKNOWN = 1 << 31
#: Added to every class bigram.
ADDED = 0.5
#: The end of a document: no word contains white space.
END = b"\n"
END_HASH = np.uint64(xxhash.xxh3_64_intdigest(END))

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode().translate(_LOWER).split(), END]


def in_training(doc_id: str = "doc_id"):
    return F.crc32(utf8(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))) % FOLDS != HELD_OUT


class Words:
    """Numbers for the distinct words of a chunk."""

    def __init__(self):
        self.index: dict[bytes, int] = defaultdict()
        self.index.default_factory = self.index.__len__

    def numbers(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.index.__getitem__, words), np.int32, len(words))

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.index), np.uint64, len(self.index))

    def endings(self) -> np.ndarray:
        return np.fromiter(map(zlib.crc32, map(itemgetter(slice(-3, None)), self.index)), np.int64, len(self.index)) % TAIL


def dealt(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents with their chunk and the number of chunks. Equal rows go to different chunks, too.

    Row numbers depend on the partitions of ``docs``: the result is read once and its chunks are written.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    text = text_of().cast("string")
    return with_uid(docs).select(
        "doc_id", text.alias("text"), in_training().alias("train"),
        F.pmod(F.xxhash64(UID), F.lit(chunks)).cast("int").alias("chunk")), chunks


def numbered(docs: DataFrame) -> DataFrame:
    """Per document: chunk, doc_id, train and its words as packed numbers of the chunk's distinct words.

    One row of a chunk also has the hashes of these words, in order, their training counts and their endings, packed.
    """

    def number(group: pa.Table) -> pa.Table:
        words = Words()
        numbers = [words.numbers(text.as_py()) for text in group.column("text")]
        train = group.column("train").to_pylist()
        counts = np.zeros(len(words.index), np.int64)
        for some, counted in zip(numbers, train):
            if counted:
                np.add.at(counts, some, 1)
        hashes = words.hashes()
        order = np.argsort(hashes)
        place = np.empty(len(order), "<u4")
        place[order] = np.arange(len(order))
        empty = [None] * (len(numbers) - 1)
        return pa.table({
            "chunk": group.column("chunk"),
            "doc_id": group.column("doc_id"),
            "train": group.column("train"),
            "numbers": pa.array([place[one].tobytes() for one in numbers], pa.binary()),
            "hashes": pa.array([hashes[order].astype("<u8").tobytes(), *empty], pa.binary()),
            "counts": pa.array([counts[order].astype("<u4").tobytes(), *empty], pa.binary()),
            "endings": pa.array([words.endings()[order].astype("<u2").tobytes(), *empty], pa.binary()),
        })

    id_type = dict(docs.dtypes)["doc_id"]
    return docs.groupBy("chunk").applyInArrow(
        lean(number), f"chunk int, doc_id {id_type}, train boolean, numbers binary, hashes binary, counts binary, endings binary")


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def counted(numbers: DataFrame, chunks: int) -> DataFrame:
    """Per chunk and hash range: the hashes of the chunk's words in order, and their training counts, both packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, hashes, counts in zip(*[batch.column(n).to_pylist() for n in ("chunk", "hashes", "counts")]):
                hashes, counts = np.frombuffer(hashes, "<u8"), np.frombuffer(counts, "<u4")
                cuts = np.searchsorted(_part(hashes, chunks), np.arange(chunks + 1, dtype=np.uint64))
                some = [at for at in range(chunks) if cuts[at] < cuts[at + 1]]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(some, pa.int32()),
                    "chunk": pa.array([chunk] * len(some), pa.int32()),
                    "hashes": pa.array([hashes[cuts[at]:cuts[at + 1]].tobytes() for at in some], pa.binary()),
                    "counts": pa.array([counts[cuts[at]:cuts[at + 1]].tobytes() for at in some], pa.binary()),
                })

    vocabulary = numbers.where("hashes IS NOT NULL").select("chunk", "hashes", "counts")
    return vocabulary.mapInArrow(run, "part int, chunk int, hashes binary, counts binary")


def summed(counts: DataFrame) -> DataFrame:
    """The rows of ``counts`` with totals over all chunks in place of counts, and per range a row of chunk -1 with
    the range's tokens and distinct training words."""

    def total(group: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(value.as_py(), "<u8") for value in group.column("hashes")]
        own = np.concatenate([np.frombuffer(value.as_py(), "<u4") for value in group.column("counts")]).astype(np.int64)
        distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.bincount(place, own, len(distinct)).astype(np.int64)
        ends = np.cumsum([len(one) for one in hashes])
        spread = np.split(totals[place], ends[:-1])
        part, n = group.column("part")[0].as_py(), len(hashes)
        return pa.table({
            "part": pa.array([part] * (n + 1), pa.int32()),
            "chunk": pa.concat_arrays([group.column("chunk").combine_chunks(), pa.array([-1], pa.int32())]),
            "hashes": pa.array([*[one.tobytes() for one in hashes], None], pa.binary()),
            "totals": pa.array([*[one.astype("<i8").tobytes() for one in spread], None], pa.binary()),
            "tokens": pa.array([*[0] * n, int(totals.sum())], pa.int64()),
            "distinct": pa.array([*[0] * n, int((totals > 0).sum())], pa.int64()),
        })

    return counts.groupBy("part").applyInArrow(
        lean(total), "part int, chunk int, hashes binary, totals binary, tokens long, distinct long")


@cache
def _once_hashes() -> np.ndarray:
    """The hashes of the units that words seen once share; no word begins with white space."""
    return np.array([xxhash.xxh3_64_intdigest(END + at.to_bytes(2, "little")) for at in range(TAIL)], np.uint64)


def coded(numbers: DataFrame, totals: DataFrame, tokens: int, distinct: int) -> DataFrame:
    """Per document: chunk, doc_id, train, n_tokens, n_known, base_score, log_counts (of its known tokens) and ``begin``, where it
    begins in its chunk's line (numbers of the chunk's units, of all documents, training documents first). The line is kept in
    pieces of whole documents, each with its first one and all of training documents or none. The first row of a line also has
    the hashes of the units, in order, and which are shared by words seen once. All these are packed."""
    shift = math.log10(tokens + distinct + 1)

    def code(texts: pa.Table, vocabulary: pa.Table) -> pa.Table:
        vocabulary = vocabulary.sort_by("part")  # ranges of hashes, so the joined totals are in the order of the hashes
        counts = np.frombuffer(b"".join(vocabulary.column("totals").to_pylist()), "<i8")
        first = lambda name, kind: np.frombuffer(next((v for v in texts.column(name).to_pylist() if v is not None), b""), kind)
        hashes, endings = first("hashes", "<u8"), first("endings", "<u2")
        once = (counts < 2) & (hashes != END_HASH)
        units, place = np.unique(np.where(once, _once_hashes()[endings], hashes), return_inverse=True)
        shared = np.zeros(len(units), "u1")
        shared[place[once]] = 1
        place = place.astype("<u4") | np.where(counts == 0, np.uint32(UNKNOWN), np.uint32(0)).astype("<u4")
        log_more, log_own = np.log10(counts + 1.0), np.log10(np.maximum(counts, 1))
        lines = [np.frombuffer(value, "<u4") for value in texts.column("numbers").to_pylist()]
        train = np.array(texts.column("train").to_pylist(), bool)
        order, sizes = np.argsort(~train, kind="stable"), np.array([len(one) for one in lines], np.int64)
        begin = np.empty(len(lines), np.int64)
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        only = lambda value: pa.array([value if at == order[0] else None for at in range(len(lines))], pa.binary())
        pieces: dict[int, list[bytes]] = {}
        head, held = None, 0
        for at in order:
            if head is None or held >= PIECE or train[at] != train[head]:
                head, held = at, 0
            pieces.setdefault(head, []).append(place[lines[at]].tobytes())
            held += len(lines[at])
        return pa.table({
            "chunk": texts.column("chunk"),
            "doc_id": texts.column("doc_id"),
            "train": texts.column("train"),
            "n_tokens": pa.array(sizes),
            "n_known": pa.array([int((counts[one] > 0).sum()) for one in lines], pa.int64()),
            "base_score": pa.array([float(log_more[one].sum()) - len(one) * shift for one in lines], pa.float64()),
            "log_counts": pa.array([float(log_own[one].sum()) for one in lines], pa.float64()),
            "begin": pa.array(begin),
            "line": pa.array([b"".join(pieces[at]) if at in pieces else None for at in range(len(lines))], pa.binary()),
            "hashes": only(units.astype("<u8").tobytes()),
            "shared": only(shared.tobytes()),
        })

    id_type = dict(numbers.dtypes)["doc_id"]
    return numbers.drop("counts").groupBy("chunk").cogroup(totals.where("chunk >= 0").groupBy("chunk")).applyInArrow(
        lean_pair(code), f"chunk int, doc_id {id_type}, train boolean, n_tokens long, n_known long, base_score double, log_counts double, "
              "begin long, line binary, hashes binary, shared binary")


MOVED = "chunk int, turn int, part int, classes binary"


def _turns(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(TURNS)).astype(np.int64)


class _Chunk:
    """The units of a chunk with their present classes, and the pieces of its line in order, from the rows that have them."""

    def __init__(self, texts: pa.Table, moved: pa.Table):
        first = lambda name, kind: np.frombuffer(next((v.as_buffer() for v in texts.column(name) if v.is_valid), b""), kind)
        self.hashes, self.shared = first("hashes", "<u8"), first("shared", "u1").astype(bool)
        pieces = [(begin.as_py(), line.as_buffer()) for begin, line in zip(texts.column("begin"), texts.column("line")) if line.is_valid]
        self.pieces = [np.frombuffer(line, "<u4") for _, line in sorted(pieces, key=lambda one: one[0])]
        self.turns = _turns(self.hashes)
        self.classes = ((self.hashes >> np.uint64(8)) % np.uint64(CLASSES)).astype(np.uint8)
        moved = moved.sort_by([("turn", "ascending"), ("part", "ascending")])  # a chunk's units are in order of their hashes
        turn = np.array(moved.column("turn").to_pylist(), np.int64)
        packed = moved.column("classes").to_pylist()
        for at in np.unique(turn):
            self.classes[self.turns == at] = np.frombuffer(b"".join(packed[i] for i in np.flatnonzero(turn == at)), "u1")

    def taken(self, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class bigrams and, per class, tokens of words seen once, in one array; and the units of the turn by number, with a
        number (unit's place * 2 * CLASSES + side * CLASSES + class) for every class that stands before or after one of them.

        Pieces are taken one by one, so that what is held of them stays small. Each begins after an end and ends with one.
        """
        some = np.flatnonzero(self.turns == turn)
        wide = np.uint32 if (len(some) + 1) << 8 < 1 << 32 else np.uint64
        # looked up once per token: its class, a bit if words seen once share it, above them its place + 1 among the units of this turn
        facts = (self.classes | self.shared.astype(np.uint8) << SHARED).astype(wide)
        facts[some] |= np.arange(1, len(some) + 1, dtype=wide) << wide(8)
        flat, keys = np.zeros(CLASSES * (CLASSES + 1), np.int64), [np.zeros(0, wide)]
        for piece in self.pieces:
            line = np.empty(len(piece) + 1, wide)
            line[1:] = facts[piece]
            line[0] = line[-1]
            low = line.astype(np.uint8)
            kinds = (low & np.uint8((1 << SHARED) - 1)).astype(np.uint16)
            flat[:CLASSES ** 2] += np.bincount(kinds[:-1] * np.uint16(CLASSES) + kinds[1:], minlength=CLASSES ** 2)
            flat[CLASSES ** 2:] += np.bincount(kinds[1:][low[1:] >= 1 << SHARED], minlength=CLASSES)
            at = np.flatnonzero(line >> wide(8) != 0)
            for side, these in ((-1, at[at > 0]), (1, at[at < len(piece)])):
                units = (line[these] >> wide(8)) - wide(1)
                keys.append(units * wide(2 * CLASSES) + (kinds[these + side] + np.uint16(CLASSES * (side > 0))))
        return flat, some, np.concatenate(keys)


def _with_classes(units: DataFrame, moved: list[DataFrame], run, schema: str) -> DataFrame:
    spark = units.sparkSession
    rows = reduce(DataFrame.unionByName, moved) if moved else spark.createDataFrame([], MOVED)
    return units.groupBy("chunk").cogroup(rows.groupBy("chunk")).applyInArrow(lean_pair(run), schema)


def _training_lines(units: DataFrame) -> DataFrame:
    """A few rows per chunk: its units, and the line of its training documents."""
    rows = units.where("hashes IS NOT NULL OR (train AND line IS NOT NULL)")
    return rows.select("chunk", "begin", "hashes", "shared", F.when(F.col("train"), F.col("line")).alias("line"))


CONTEXTS = "part int, chunk int, hashes binary, classes binary, many binary, around binary, counts binary"


def contexts(units: DataFrame, moved: list[DataFrame], turn: int, parts: int) -> DataFrame:
    """Per chunk and range of hashes: the units of this turn with their classes, and how often each class stands before and
    after each of them, all packed: per unit its number of entries, per entry a byte ``around`` (side * CLASSES + class) and a
    byte ``counts``. A larger count takes several entries, which are summed with those of other chunks.

    Per chunk also a row of part -1 with its class ``bigrams`` and tokens of words seen once: a round reads a chunk once."""

    def run(texts: pa.Table, rows: pa.Table) -> pa.Table:
        found, flat = [], None
        if texts.num_rows:
            own = _Chunk(texts, rows)
            flat, some, keys = own.taken(turn)
            keys.sort()
            first = np.flatnonzero(np.concatenate([keys[:1] >= 0, keys[1:] != keys[:-1]]))
            keys, counts = in_bytes(keys[first].astype(np.int64), np.diff(first, append=len(keys)))
            many = np.bincount(keys // (2 * CLASSES), minlength=len(some)).astype("<u4")
            around = (keys % (2 * CLASSES)).astype("u1")
            hashes, classes = own.hashes[some], own.classes[some]
            cuts = np.searchsorted(_part(hashes, parts), np.arange(parts + 1, dtype=np.uint64))
            ends = np.searchsorted(keys, cuts * 2 * CLASSES)
            for part in range(parts):
                a, b, c, d = cuts[part], cuts[part + 1], ends[part], ends[part + 1]
                if a < b:
                    found.append((part, hashes[a:b].astype("<u8").tobytes(), classes[a:b].tobytes(), many[a:b].tobytes(),
                                  around[c:d].tobytes(), counts[c:d].tobytes()))
        binary = lambda at: pa.array([*[one[at] for one in found], *empty], pa.binary())
        empty = [] if flat is None else [None]
        n = len(found) + len(empty)
        return pa.table({
            "part": pa.array([*[one[0] for one in found], *[-1 for _ in empty]], pa.int32()),
            "chunk": pa.array([texts.column("chunk")[0].as_py()] * n if n else [], pa.int32()),
            "hashes": binary(1), "classes": binary(2), "many": binary(3), "around": binary(4), "counts": binary(5),
            "bigrams": pa.array([*[None] * len(found), *[flat.tolist() for _ in empty]], pa.list_(pa.int64()))})

    return _with_classes(_training_lines(units), moved, run, f"{CONTEXTS}, bigrams array<bigint>")


def in_bytes(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of at most a byte: a key with a larger one is repeated, and its counts add up to it."""
    most = 255
    entries = -(-counts // most)
    small = np.full(int(entries.sum()), most, np.uint8)
    small[np.cumsum(entries) - 1] = counts - most * (entries - 1)
    return np.repeat(keys, entries), small


def _phi(x: np.ndarray) -> np.ndarray:
    out = np.maximum(x, 1.0)
    np.log(out, out)
    out *= x
    return out


def _rise(x: np.ndarray, more: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return _phi(x + more) - _phi(x)


def _risen(table: np.ndarray, y: np.ndarray, more: np.ndarray) -> np.ndarray:
    """``_rise`` of the rows ``y`` of ``table``. Most counts are small, so a row and a small count are taken once for all entries."""
    small = more <= SMALL
    codes = y[small] * SMALL + more[small] - 1
    seen = np.flatnonzero(np.bincount(codes, minlength=CLASSES * SMALL))
    place = np.zeros(CLASSES * SMALL, np.int64)
    place[seen] = np.arange(len(seen))
    large = np.flatnonzero(~small)
    at = np.empty(len(y), np.int64)
    at[small], at[large] = place[codes], len(seen) + np.arange(len(large))
    rows, counts = np.concatenate([seen // SMALL, y[large]]), np.concatenate([seen % SMALL + 1, more[large]])
    return _rise(table[rows], counts[:, None])[at]


def _by_class(classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sums of ``rows`` per class."""
    at = classes[:, None] * CLASSES + np.arange(CLASSES)
    return np.bincount(at.ravel(), rows.ravel(), CLASSES ** 2).reshape(CLASSES, CLASSES)


def exchanged(keys: np.ndarray, counts: np.ndarray, own: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The classes of units after each moved to the class with the greatest likelihood.

    ``keys`` (in order) and ``counts`` say which classes stand around the units, ``own`` has their classes and ``pairs``
    counts all class bigrams. The likelihood is compared with a unit taken out of its class and put into each other one.
    Frequent units go first and see the moves before them; units are taken together up to a small share of all tokens.
    """
    own, now, around_one = own.copy(), pairs.astype(float), 2 * CLASSES
    begins = np.searchsorted(keys, np.arange(len(own) + 1) * around_one)  # keys are in order: a unit's stand together
    before_it = np.concatenate([[0], np.cumsum(np.where(keys % around_one < CLASSES, counts, 0), dtype=np.float64)])
    size = before_it[begins[1:]] - before_it[begins[:-1]]
    del before_it
    order = np.argsort(-size, kind="stable")[:np.count_nonzero(size)]  # the others have no contexts
    upto = np.cumsum(size[order])
    most = STEP_SHARE * pairs.sum()
    first = 0
    while first < len(order):
        held = upto[first - 1] if first else 0
        last = min(max(first + 1, int(np.searchsorted(upto, held + most, "right"))), first + STEP_UNITS, len(order))
        some, many = order[first:last], last - first
        old, all_of = own[some], np.arange(many)
        entries = begins[some + 1] - begins[some]
        these = np.arange(entries.sum()) + np.repeat(begins[some] - np.cumsum(entries) + entries, entries)
        w, k, b = np.repeat(all_of, entries), (keys[these] % around_one).astype(np.int64), counts[these]
        around = np.zeros((many, 2, CLASSES))
        around.reshape(-1)[w * around_one + k] = b
        before, after = around[:, 0], around[:, 1]
        sums = []
        for which, table, other in ((0, now, after), (1, now.T, before)):
            one = k // CLASSES == which
            x, y, z = w[one], k[one] % CLASSES, b[one]
            risen, out_of = _risen(table, y, z), old[x]
            # in its own class the unit is taken out first, in its column and in its row
            risen[np.arange(len(x)), out_of] = _rise(table[y, out_of] - z, z)
            within = np.flatnonzero(y == out_of)
            rest = table[y[within]] - other[x[within]]
            rest[np.arange(len(within)), out_of[within]] -= z[within]
            risen[within] = _rise(rest, z[within, None])
            sums.append(np.add.reduceat(risen, np.searchsorted(x, all_of), axis=0))
        gain = sums[0] + sums[1]
        # what stands on both sides counts for the corner together
        w, k = np.nonzero((before > 0) & (after > 0))
        left, right = before[w, k], after[w, k]
        corner = np.maximum(now[k, k] - np.where(k == old[w], left + right, 0), 0)
        gain[w, k] += _phi(corner + left + right) - _phi(corner + left) - _phi(corner + right) + _phi(corner)
        # what stands before a unit counts in the rows of its own classes wherever the unit is, and so do columns
        for sizes, n in ((now.sum(1), after.sum(1)), (now.sum(0), before.sum(1))):
            distinct, place = np.unique(n, return_inverse=True)
            cost = _rise(np.tile(sizes, (len(distinct), 1)), distinct[:, None])[place]
            cost[all_of, old] = _rise(sizes[old] - n, n)
            gain -= cost
        new = gain.argmax(1)
        moves = np.flatnonzero(gain[all_of, new] > gain[all_of, old] + 1e-6)
        own[some[moves]] = new[moves]
        now += _by_class(new[moves], after[moves]) - _by_class(old[moves], after[moves])
        now += (_by_class(new[moves], before[moves]) - _by_class(old[moves], before[moves])).T
        first = last
    return own


def _merged(group: pa.Table, place: np.ndarray, ends: np.ndarray, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """The contexts of all chunks of a range, summed: keys in order, and counts.

    A task holds no more than these, their order and one copy: the chunks' keys are taken one by one, as narrow as they fit.
    """
    sizes = [len(value.as_buffer()) for value in group.column("counts")]
    keys = np.empty(sum(sizes), np.uint32 if distinct * 2 * CLASSES < 1 << 32 else np.uint64)
    counts = np.empty(len(keys), np.uint8)
    upto = 0
    columns = [group.column(name) for name in ("many", "around", "counts")]
    for begin, end, size, many, around, n in zip([0, *ends[:-1]], ends, sizes, *columns):
        units = np.repeat(place[begin:end] * (2 * CLASSES), np.frombuffer(many.as_buffer(), "<u4"))
        keys[upto:upto + size] = units + np.frombuffer(around.as_buffer(), "u1")
        counts[upto:upto + size] = np.frombuffer(n.as_buffer(), "u1")
        upto += size
    order = np.argsort(keys, kind="stable")  # runs in order, which this sort merges
    keys, counts = keys[order], counts[order]
    del order
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first, dtype=np.int64) if len(first) else counts.astype(np.int64)


def _exchanged(found: DataFrame, turn: int, pairs: np.ndarray) -> DataFrame:
    """The new classes of the units of this turn, from their ``contexts``, packed for the chunks that have them."""

    def move(group: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(v, "<u8") for v in group.column("hashes").to_pylist()]
        ends = np.cumsum([len(one) for one in hashes])
        distinct, first, place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        classes = np.frombuffer(b"".join(group.column("classes").to_pylist()), "u1").astype(np.int64)[first]
        keys, counts = _merged(group, place, ends, len(distinct))
        better = exchanged(keys, counts, classes, pairs).astype("u1")
        return pa.table({
            "chunk": group.column("chunk"),
            "turn": pa.array([turn] * len(hashes), pa.int32()),
            "part": group.column("part"),
            "classes": pa.array([one.tobytes() for one in np.split(better[place], ends[:-1])], pa.binary())})

    return found.where("part >= 0").drop("bigrams").groupBy("part").applyInArrow(lean(move), MOVED)


@dataclass
class Classes:
    of_unit: np.ndarray  # class of each code in a document's units: a class, or CLASSES more for an unknown word
    pairs: np.ndarray  # class bigrams
    once: np.ndarray  # tokens of words seen once, per class

    def likelihood(self) -> float:
        n = self.pairs.sum(1)
        m = self.pairs.sum(0)
        return float(_phi(self.pairs).sum() - _phi(n).sum() - _phi(m).sum())

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 of the class bigrams, of a known word's share per occurrence, and of an unknown word, per class."""
        pairs = self.pairs + ADDED
        size = np.maximum(self.pairs.sum(0), 1)
        unknown = np.minimum((self.once + ADDED) / (size + 1), 0.5)
        return (np.log10(pairs / pairs.sum(1, keepdims=True)), np.log10((1 - unknown) / size), np.log10(unknown))


def _measured(found: DataFrame) -> Classes:
    """Class bigrams and once-seen tokens of the assignment that ``contexts`` counted."""
    flat = np.zeros(CLASSES * (CLASSES + 1), np.int64)
    entries = found.where("part < 0").select(F.posexplode("bigrams").alias("at", "n"))
    for row in entries.groupBy("at").agg(F.sum("n").alias("n")).collect():
        flat[row["at"]] = row["n"]  # CLASSES * (CLASSES + 1) rows
    return Classes(np.arange(2 * CLASSES) % CLASSES, flat[:CLASSES ** 2].reshape(CLASSES, CLASSES), flat[CLASSES ** 2:])


def _clustered(units: DataFrame, rounds: int | None, parts: int) -> tuple[Classes, list[DataFrame]]:
    """The likeliest assignment met: its class bigrams, and the classes of the units that have moved."""
    moved: dict[int, DataFrame] = {}
    best, kept, sweep, turn = None, [], -math.inf, 0
    while True:
        found = written(contexts(units, list(moved.values()), turn % TURNS, parts), "contexts")
        now = _measured(found)
        if best is None or now.likelihood() > best.likelihood():
            best, kept = now, list(moved.values())
        done = turn == rounds
        if turn % TURNS == 0 and rounds is None:
            done = best.likelihood() - sweep <= LEAST_GAIN * abs(best.likelihood())
            sweep = best.likelihood()
        if not done:
            moved[turn % TURNS] = written(_exchanged(found, turn % TURNS, now.pairs), "classes")
        forget(found)
        if done:
            return best, kept
        turn += 1


def cluster(train: DataFrame, rounds: int | None = None) -> Classes:
    """Exchange clustering of the units of ``train`` (from ``trained``): ``rounds`` rounds, or until the likelihood stops rising."""
    chunks = train.agg(F.max("chunk")).first()[0] or 0
    return _clustered(train, rounds, 1 + chunks // RANGE_CHUNKS)[0]


def classed(units: DataFrame, moved: list[DataFrame]) -> DataFrame:
    """``units`` with the documents as packed codes of two bytes: a token's class, or CLASSES more for an unknown word."""

    def run(texts: pa.Table, rows: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return texts.append_column("units", pa.array([], pa.binary()))
        own = _Chunk(texts, rows)
        line = np.concatenate([np.zeros(0, "<u4"), *own.pieces])
        codes = own.classes[line & np.uint32(UNKNOWN - 1)].astype("<u2")
        codes[line >= UNKNOWN] += CLASSES
        places = zip(texts.column("begin").to_pylist(), texts.column("n_tokens").to_pylist())
        return texts.append_column("units", pa.array([codes[at:at + n].tobytes() for at, n in places], pa.binary()))

    schema = ", ".join(f"`{name}` {kind}" for name, kind in units.dtypes)
    return _with_classes(units, moved, run, f"{schema}, units binary")


def scores(units: DataFrame, model: Classes, tokens: int) -> DataFrame:
    """The rows of ``classed`` with the model's score."""
    after, share, unknown = model.tables()
    classes = model.of_unit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for packed, base, own in zip(*[batch.column(n).to_pylist() for n in ("units", "base_score", "log_counts")]):
                line = np.frombuffer(packed, "<u2").astype(np.int64)
                kinds = classes[line]
                first = np.concatenate([kinds[-1:], kinds[:-1]])  # the last is the end
                emitted = np.where(line >= CLASSES, unknown[kinds], share[kinds])
                found.append(float(after[first, kinds].sum() + emitted.sum() + own) if tokens else base)
            columns = {n: batch.column(n) for n in ("doc_id", "train", "n_tokens", "n_known", "base_score")}
            yield pa.RecordBatch.from_pydict(columns | {"score": pa.array(found, pa.float64())})

    id_type = dict(units.dtypes)["doc_id"]
    return units.select("doc_id", "train", "n_tokens", "n_known", "base_score", "log_counts", "units").mapInArrow(
        run, f"doc_id {id_type}, train boolean, n_tokens long, n_known long, base_score double, score double")


def trained(docs: DataFrame, rounds: int | None = None) -> tuple[DataFrame, Classes, int, int]:
    """The coded documents, the classes, and the tokens and distinct words of the training documents."""
    ship(docs.sparkSession)
    chunked, chunks = dealt(docs)
    numbers = bucketed(numbered(chunked), "numbers", chunks)
    totals = written(summed(counted(numbers, chunks)), "totals")
    sizes = totals.where("chunk < 0").agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
    tokens, distinct = sizes["tokens"] or 0, sizes["distinct"] or 0
    units = bucketed(coded(numbers, totals, tokens, distinct), "units", chunks)
    model, moved = _clustered(units, rounds, 1 + (chunks - 1) // RANGE_CHUNKS)
    return classed(units, moved), model, tokens, distinct


def scored(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    units, model, tokens, _ = trained(docs, rounds)
    return scores(units, model, tokens).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
