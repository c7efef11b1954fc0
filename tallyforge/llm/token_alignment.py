r"""Alignment of two tokenizers' tokens by pointer jumping.

Both tokenizers cut the same bytes. Every token points to the farthest-right token that overlaps it (of tokens with equal ends
the second tokenizer's); doubling all pointers at once until none moves leads each token to the last one of its component,
which names the group. Groups therefore end where tokens of both end.

Neither tokenizer lets a token reach across the place before a single space that a non-space follows. Texts are cut into units there, each
distinct unit of a chunk is encoded and aligned once, many units in one pass, and a text's groups are its units' groups in order.

Links are pairs of tokens of one group. ``aligned`` counts per pair of ids the documents that hold it: chunks of some megabytes keep their
documents' units and the units' pairs packed, as narrow as the numbers fit and in rows of a bounded size, send their distinct pairs with
counts, and receive the corpus-wide counts of just these pairs back. Chunks lie bucketed, so that this does not shuffle them.

Edge cases: null and empty texts, and texts whose joined token bytes are not the space and the text (the piece model reads U+2581 as a space),
have no tokens and zeros; repeated rows are documents of their own; an empty table gives an empty result; other columns are
ignored. A very long text is a chunk of its own, a text without spaces a unit of its own; a group's pairs are taken from its distinct ids.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import units
from tallyforge.llm.common import bucketed, give_back, lean_pair, ship, slices, written

#: Bytes of text in a chunk.
CHUNK_BYTES = 4 << 20
#: Bytes of a chunk's numbers in a row: a JVM keeps buffers of half a megabyte apart from the young ones that it frees at once.
PIECE = 256 << 10
#: Documents of a chunk that a worker returns at once.
BATCH = 4096
#: Chunks that lie in one bucket.
BUCKET_CHUNKS = 4
#: Units that are aligned in one pass.
TOGETHER = 20_000
#: Units that the first tokenizer encodes as one string.
JOINED = 2000
#: Fixed value: the piece model's sign for a space.
BLANK = "▁"
_RUN = re.compile(r" (?=\s|\Z)|\A ")
_CUT = re.compile(r"(?<! ) (?=\S)")


def piece_bytes(model) -> list[bytes]:
    """The bytes that each id of a piece model stands for."""
    spelt = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        spelt.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace(BLANK, " ").encode())
    return spelt


def cut(text: str) -> list[str]:
    """The units of a space and the text, each without the space it begins with."""
    if _RUN.search(text) is None:
        return text.split(" ")
    whole = " " + text
    starts = [0, *[found.start() for found in _CUT.finditer(whole) if found.start()], len(whole)]
    return [whole[a + 1:b] for a, b in zip(starts, starts[1:])]


def jumped(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group (from 0, in order) of every token of either tokenizer; both cover the same bytes without gaps."""
    n_a = len(end_a)
    overlapping = np.searchsorted(start_b, end_a, "left") - 1  # the last that begins before the token ends
    back = np.searchsorted(start_a, end_b, "left") - 1
    own = n_a + np.arange(len(end_b))
    after = np.concatenate([n_a + overlapping, np.where(end_a[back] > end_b, back, own)])
    while True:
        farther = after[after]
        if np.array_equal(farther, after):
            break
        after = farther
    last, group = np.unique(after, return_inverse=True)
    return group[:n_a], group[n_a:]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


class Aligner:
    """Both tokenizers, and the alignment of many units at once."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = units.tokenizer_of_file(path_a)
        self.bytes_a = units.bytes_of_ids(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = piece_bytes(self.b)
        self.length_a, self.length_b = (np.array([len(one) for one in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        self.names = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]

    def _encoded_a(self, whole: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, one unit after another, and how many each unit has."""
        joins = [len(one) > 1 and not one[1].isspace() for one in whole]
        runs, alone = [one for one, fine in zip(whole, joins) if fine], [one for one, fine in zip(whole, joins) if not fine]
        texts = ["".join(runs[at:at + JOINED]) for at in range(0, len(runs), JOINED)] + alone
        ids = [np.array(one.ids, np.int64) for one in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        ordered = np.fromiter((len(one.encode()) for one in runs + alone), np.int64, len(whole))
        stops = np.searchsorted(np.cumsum(self.length_a[ids]), np.cumsum(ordered)) + 1  # no token crosses a cut
        counts = np.diff(stops, prepend=0)
        if not alone:
            return ids, counts
        place = np.empty(len(whole), np.int64)  # back to the order of the units
        place[np.concatenate([np.flatnonzero(joins), np.flatnonzero(~np.array(joins))])] = np.arange(len(whole))
        return ids[_ranges((stops - counts)[place], counts[place])], counts[place]

    def __call__(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Of each unit: whether its tokens spell it, its tokens of either side, groups and links, their spelling, and how many
        of the pairs and times that follow are its own."""
        whole = [" " + key for key in keys]
        ids_a, many_a = self._encoded_a(whole)
        listed = self.b.encode(keys, num_threads=1)  # the model puts the space before each
        many_b = np.fromiter(map(len, listed), np.int64, len(keys))
        ids_b = np.fromiter(chain.from_iterable(listed), np.int64, int(many_b.sum()))
        good, data = np.ones(len(keys), bool), "".join(whole).encode()
        for ids, many, table in ((ids_a, many_a, self.bytes_a), (ids_b, many_b, self.bytes_b)):
            spelt = [table[i] for i in ids.tolist()]
            if b"".join(spelt) != data:  # a sign for space or an odd byte in some unit
                stops = np.cumsum(many).tolist()
                good &= [b"".join(spelt[a:b]) == one.encode() for a, b, one in zip([0, *stops], stops, whole)]
        of_a, of_b = np.repeat(np.arange(len(keys)), many_a), np.repeat(np.arange(len(keys)), many_b)
        keep_a, keep_b = good[of_a], good[of_b]
        sizes, spelt, bounds, pairs, times = self._aligned(ids_a[keep_a], of_a[keep_a], ids_b[keep_b], of_b[keep_b], len(keys))
        own = np.zeros(len(keys), object)
        own[:] = b""
        own[good] = spelt
        return good, sizes, own.tolist(), np.diff(bounds), pairs, times

    def _aligned(self, ids_a, of_a, ids_b, of_b, n):
        if not len(ids_a):
            return np.zeros((n, 4), np.int64), [], np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        end_a, end_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        group_a, group_b = jumped(end_a - self.length_a[ids_a], end_a, end_b - self.length_b[ids_b], end_b)
        n_groups = int(group_b[-1]) + 1
        of_group = np.zeros(n_groups, np.int64)
        of_group[group_b] = of_b
        many_a, many_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        linked = np.zeros(n, np.int64)
        np.add.at(linked, of_group, many_a * many_b)
        sizes = np.stack([np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n), np.bincount(of_group, minlength=n), linked], 1)
        spelt = self._spelt(ids_a, ids_b, group_a, group_b, of_group)
        return sizes, spelt, *self._pairs(ids_a, ids_b, group_a, group_b, of_group, n)

    def _spelt(self, ids_a, ids_b, group_a, group_b, of_group) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for every unit."""
        n = len(ids_a) + len(ids_b)
        place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")
        place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
        ids, group, side = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, bool)
        ids[place_a], ids[place_b] = ids_a, ids_b
        group[place_a], group[place_b] = group_a, group_b
        side[place_b] = True
        unit = of_group[group]
        kind = np.where(side[1:] != side[:-1], 1, 0)  # 0 comma, 1 bar, 2 semicolon, 3 end of the unit
        kind[group[1:] != group[:-1]] = 2
        kind[unit[1:] != unit[:-1]] = 3
        names, signs = self.names, (",", "|", ";", "\n")
        parts = [""] * (2 * n)
        parts[0::2] = [names[i] for i in ids.tolist()]
        parts[1::2] = [signs[k] for k in kind.tolist()] + ["\n"]
        return "".join(parts).encode().split(b"\n")[:-1]

    @staticmethod
    def _pairs(ids_a, ids_b, group_a, group_b, of_group, n) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per unit (by bounds) its distinct id pairs, first id in the upper 32 bits, and how many links each has."""
        key_a, times_a = np.unique((group_a << 32) | ids_a, return_counts=True)
        key_b, times_b = np.unique((group_b << 32) | ids_b, return_counts=True)
        in_a, in_b = key_a >> 32, key_b >> 32
        first_b = np.searchsorted(in_b, np.arange(len(of_group) + 1))
        partners = (first_b[1:] - first_b[:-1])[in_a]
        left = np.repeat(np.arange(len(key_a)), partners)
        right = np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners) + np.repeat(first_b[in_a], partners)
        pair = ((key_a[left] & 0xFFFFFFFF) << 32) | (key_b[right] & 0xFFFFFFFF)
        unit, times = of_group[in_a[left]], times_a[left] * times_b[right]
        order = np.lexsort((pair, unit))
        pair, unit, times = pair[order], unit[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (unit[1:] != unit[:-1])]))
        return np.searchsorted(unit[first], np.arange(n + 1)), pair[first], np.add.reduceat(times, first)


@cache
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process and pair of files."""
    return Aligner(path_a, path_b)


class Chunk:
    """Documents gathered until they make a row: their units as numbers of the chunk, and the units' pairs."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.number: dict[str, int] = {}
        self.spelt: dict[str, bytes] = {}
        self.bad: set[str] = set()
        self.sizes, self.counts, self.pairs, self.pair_times = np.zeros((0, 4), np.int64), [], [], []
        self.ids, self.totals, self.digests, self.groups = [], [], [], []
        self.doc_sizes, self.units, self.times, self.held = [], [], [], 0

    def _learn(self, keys: list[str]) -> None:
        for begin in range(0, len(keys), TOGETHER):
            some = keys[begin:begin + TOGETHER]
            good, sizes, spelt, counts, pairs, times = self.aligner(some)
            self.number |= zip(some, range(len(self.sizes), len(self.sizes) + len(some)))
            self.spelt |= zip(some, spelt)
            if not good.all():
                self.bad |= {key for key, fine in zip(some, good.tolist()) if not fine}
            self.sizes = np.concatenate([self.sizes, sizes])
            self.counts.append(counts)
            self.pairs.append(pairs)
            self.pair_times.append(times)

    def add(self, ids: pa.Array, texts: list[str | None], with_groups: bool) -> None:
        parts = [cut(text) if text else [] for text in texts]
        self._learn([*set().union(*parts).difference(self.number)])
        if self.bad:
            parts = [part if self.bad.isdisjoint(part) else [] for part in parts]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        unit = np.fromiter(map(self.number.__getitem__, chain.from_iterable(parts)), np.int64, int(lengths.sum()))
        key, times = np.unique((np.repeat(np.arange(len(parts)), lengths) << 32) | unit, return_counts=True)
        document, unit = key >> 32, key & 0xFFFFFFFF
        totals = np.zeros((len(parts), 4), np.int64)
        np.add.at(totals, document, self.sizes[unit] * times[:, None])
        spelt = [b";".join(map(self.spelt.__getitem__, part)) for part in parts]
        self.ids.append(ids)
        self.totals.append(totals)
        self.digests += [hashlib.sha256(one).hexdigest() if one else "" for one in spelt]
        self.groups += [one.decode() for one in spelt] if with_groups else [None] * len(parts)
        self.doc_sizes.append(np.bincount(document, minlength=len(parts)))
        self.units.append(unit)
        self.times.append(times)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """The chunk as rows of :func:`chunked`."""
        flat = [np.zeros(0, np.int64)]
        counts = np.concatenate(self.counts + flat)
        pairs, pair_of = np.unique(np.concatenate(self.pairs + flat), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(counts)])
        sizes, doc_units, totals = np.concatenate(self.doc_sizes), np.concatenate(self.units), np.concatenate(self.totals)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        held = np.zeros(len(pairs), np.int64)
        for begin, end in zip(bounds.tolist(), bounds[1:].tolist()):
            unit = doc_units[begin:end]
            held[np.unique(pair_of[_ranges(starts[unit], counts[unit])])] += 1

        ids = pa.concat_arrays(self.ids)
        empty = {"doc_id": ids.type, "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
                 "groups_sha256": pa.string(), "groups": pa.string(), "pair": pa.list_(pa.int64()), "held": pa.list_(pa.int64()),
                 "type": pa.string(), "data": pa.binary()}

        def batch(kind: str, places, n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([number] * n, pa.int64()), "kind": pa.array([kind] * n, pa.string()), "place": pa.array(places, pa.int64()),
                **{name: columns.get(name, pa.nulls(n, of)) for name, of in empty.items()}})

        for begin in range(0, len(ids), BATCH):
            some = slice(begin, begin + BATCH)
            n = len(ids[some])
            named = {name: pa.array(totals[some, at].copy()) for at, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
            yield batch("document", np.arange(begin, begin + n), n, doc_id=ids[some], **named,
                        groups_sha256=pa.array(self.digests[some], pa.string()), groups=pa.array(self.groups[some], pa.string()))
        for begin, end in _cuts(len(pairs), pairs.itemsize + held.itemsize):
            offsets = pa.array([0, end - begin], pa.int32())
            yield batch("pairs", [begin], 1, pair=pa.ListArray.from_arrays(offsets, pa.array(pairs[begin:end])),
                        held=pa.ListArray.from_arrays(offsets, pa.array(held[begin:end])))
        for name, values in (("doc_sizes", sizes), ("doc_units", doc_units), ("doc_times", np.concatenate(self.times)), ("unit_sizes", counts),
                             ("unit_pairs", pair_of), ("unit_times", np.concatenate(self.pair_times + flat))):
            values = _narrow(values)
            for begin, end in _cuts(len(values), values.itemsize):
                yield batch(name, [begin], 1, type=pa.array([values.dtype.str]), data=pa.array([values[begin:end].tobytes()], pa.binary()))


def _narrow(values: np.ndarray) -> np.ndarray:
    """The numbers, none below zero, in the fewest bytes that hold them all."""
    most = int(values.max(initial=0))
    return values.astype(next(kind for kind in ("<u1", "<u2", "<u4", "<i8") if most <= np.iinfo(kind).max))


def _cuts(n: int, size: int) -> list[tuple[int, int]]:
    """Where the pieces of ``n`` entries of ``size`` bytes begin and end."""
    each = PIECE // size
    return [(begin, min(begin + each, n)) for begin in range(0, n, each)]


def _schema(id_type: str) -> str:
    return (f"chunk long, kind string, place long, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, "
            "groups_sha256 string, groups string, pair array<long>, held array<long>, type string, data binary")


def chunked(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """The rows of each chunk, by ``kind``. Not yet written.

    ``document``: a document's counts and digest (and groups). ``pairs``: some of the chunk's distinct pairs and the documents that hold each.
    The others have what these are made of, packed: ``data`` are numbers of ``type``. ``place`` is that of a row's first entry in its chunk."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(path_a, path_b)
        number, chunk = TaskContext.get().partitionId() << 32, Chunk(aligner)
        for part in slices(batches, "text", 1 << 20):
            chunk.add(part.column("doc_id"), part.column("text").to_pylist(), with_groups)
            chunk.held += part.column("text").nbytes
            if chunk.held >= CHUNK_BYTES:
                yield from chunk.rows(number)
                number, chunk = number + 1, Chunk(aligner)
                give_back()
        if chunk.ids:
            yield from chunk.rows(number)
        del chunk
        give_back()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, _schema(id_type))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n_docs, highest): the documents that hold a pair, and the most that any pair of its first id has."""
    own = chunks.select(F.explode(F.arrays_zip("pair", "held")).alias("p")).select("p.*")
    totals = own.groupBy("pair").agg(F.sum("held").alias("n_docs")).withColumn("a", F.shiftright("pair", 32))
    totals = written(totals, "pairs")
    highest = totals.groupBy("a").agg(F.max("n_docs").alias("highest"))
    return totals.join(highest, "a").select("pair", "n_docs", "highest")


def links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The corpus-wide table of linked ids: a, b, n_docs, is_best."""
    found = pair_counts(written(chunked(docs, path_a, path_b), "aligned"))
    return found.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "n_docs",
                        (F.col("n_docs") == F.col("highest")).alias("is_best"))


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links and groups: ``a1,a2|b1;a3|b2,b3`` in order."""
    return chunked(docs, path_a, path_b, True).where("kind = 'document'").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` are the links whose pair is held by as many documents as any pair of its first id; ``count_sum`` adds these numbers up over all links.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    chunks = bucketed(chunked(docs, path_a, path_b), "aligned", size // (CHUNK_BYTES * BUCKET_CHUNKS))
    own = chunks.select(F.col("chunk").alias("of"), F.col("place").alias("begin"), F.posexplode("pair").alias("at", "pair"))
    counts = own.join(pair_counts(chunks), "pair").select(
        "of", (F.col("begin") + F.col("at")).alias("place"), "n_docs", (F.col("n_docs") == F.col("highest")).alias("best"))
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")

    def finish(chunk: pa.Table, counts: pa.Table) -> pa.Table:
        kinds, packed = chunk.column("kind"), {}
        for name in ("doc_sizes", "doc_units", "doc_times", "unit_sizes", "unit_pairs", "unit_times"):
            pieces = chunk.filter(pa.compute.equal(kinds, name)).sort_by("place")
            kind = pieces.column("type")[0].as_py() if pieces.num_rows else "<i8"
            packed[name] = np.concatenate([np.zeros(0, kind), *[np.frombuffer(one.as_buffer(), kind) for one in pieces.column("data")]])
        place = counts.column("place").to_numpy()
        found = {}
        for name, value in (("n_best", counts.column("best").to_numpy().astype(np.int64)), ("count_sum", counts.column("n_docs").to_numpy())):
            of_pair = np.zeros(len(place), np.int64)
            of_pair[place] = value
            of_unit = _sums(of_pair[packed["unit_pairs"]] * packed["unit_times"], packed["unit_sizes"])
            found[name] = pa.array(_sums(of_unit[packed["doc_units"]] * packed["doc_times"], packed["doc_sizes"]))
        documents = chunk.filter(pa.compute.equal(kinds, "document")).sort_by("place")
        return pa.table({**{name: documents.column(name) for name in names}, **found})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    rows = chunks.where("kind <> 'pairs'").drop("pair", "held", "groups").groupBy("chunk").cogroup(counts.groupBy("of")).applyInArrow(
        lean_pair(finish), schema)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sums of runs of these sizes, one after another."""
    upto = np.concatenate([[0], np.cumsum(values)])
    return np.diff(upto[np.cumsum(sizes, dtype=np.int64)], prepend=0)
