r"""Near-duplicates by one-permutation hashing with optimal densification.

A document is the set of its distinct word shingles. Sets that are equal are one node from the start, however many
documents share them. Each node hashes its shingles once; the hash's leading bits choose a bin, the bin keeps its
smallest hash, and an empty bin takes the value of a bin that a fixed random sequence leads it to (the same sequence for
every set, which keeps the estimate unbiased). Runs of bins form bands, equal bands a bucket.

A bucket proposes a star: its smallest node against each of the others, at most as many pairs as members. Pairs are
confirmed on full sets. Where a member fails, it may still belong to another member of the bucket. Such buckets are compared
whole, in blocks of bounded size: a task holds the full sets of a block's members, counts all intersections at once and returns
links that join the components it sees, fewer than the block has members, so no row is made per pair. No bucket is capped.

Edge cases: null and empty texts, and texts without words, are linked with nothing and stay; fewer words than a shingle
has count as one shingle; rows with equal ids stand or fall together; a null id never names a group unless all its
ids are null; an empty table gives an empty result; other columns are kept by ``kept_rows``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import UID, ship, slices, with_uid, written
from tallyforge.llm.components import labelled

#: 48 bands of 7 bins: a pair at 0.8 shares no band in 12 of a million cases, one at 0.85 in 3 of 10**8.
BANDS, ROWS = 48, 7
BINS = BANDS * ROWS
#: Percent of the union that linked documents have in common.
LEAST = 80
ATTEMPTS = 64
#: Nodes of a bucket, and bytes of their sets, that make a block; two blocks are compared together.
BLOCK, BLOCK_BYTES = 1024, 16 << 20
#: Shingles whose intersections are counted in one step.
COLUMNS = 8192

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(value: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        value = (value ^ (value >> np.uint64(32))) * _FACTOR
        value = (value ^ (value >> np.uint64(29))) * _OTHER
        return value ^ (value >> np.uint64(32))


def shingle_sets(texts: list[str | None], words_each: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text."""
    code: dict[bytes, int] = {}
    found = []
    for text in texts:
        words = (text or "").encode().translate(_LOWER).split()
        for word in set(words).difference(code):
            code[word] = xxhash.xxh3_64_intdigest(word)
        codes = np.fromiter(map(code.__getitem__, words), np.uint64, len(words))
        width = min(words_each, len(codes))
        if not width:
            found.append(codes)
            continue
        n = len(codes) - width + 1
        value = np.full(n, width, np.uint64)
        with np.errstate(over="ignore"):
            for at in range(width):
                value = (value ^ (value >> np.uint64(31))) * _FACTOR + codes[at:at + n]
        found.append(np.unique(_mixed(value)))
    return found


@cache
def probes() -> np.ndarray:
    """Where an empty bin looks, attempt by attempt: the same for every set."""
    bins = np.arange(BINS, dtype=np.uint64)[:, None]
    tries = np.arange(ATTEMPTS, dtype=np.uint64)[None, :]
    return (_mixed(bins * np.uint64(ATTEMPTS) + tries + np.uint64(1)) % np.uint64(BINS)).astype(np.int64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """One value per bin of a set that has at least one shingle."""
    bins = (((shingles >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    first = np.ones(len(bins), bool)
    first[1:] = bins[1:] != bins[:-1]  # shingles are sorted, so a bin's smallest comes first
    values = np.zeros(BINS, np.uint64)
    filled = np.zeros(BINS, bool)
    values[bins[first]] = shingles[first]
    filled[bins[first]] = True
    empty = np.flatnonzero(~filled)
    looks = probes()
    for attempt in range(ATTEMPTS):
        if not len(empty):
            break
        source = looks[empty, attempt]
        good = filled[source]
        values[empty[good]] = values[source[good]]
        empty = empty[~good]
    if len(empty):  # few shingles and bad luck: the next filled bin
        there = np.flatnonzero(filled)
        values[empty] = values[there[np.searchsorted(there, empty) % len(there)]]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in values.reshape(BANDS, ROWS).T:
            key = (key ^ (key >> np.uint64(31))) * _FACTOR + column
    return _mixed(key).view(np.int64)


def sketched(docs: DataFrame, words_each: int) -> DataFrame:
    """``docs`` (with row numbers) with n_shingles, a digest of the set and its band keys."""
    ship(docs.sparkSession)
    names = docs.columns
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text").to_pylist(), words_each)
            values = [signature(one) if len(one) else None for one in sets]
            keys = [band_keys(one) for one in values if one is not None]
            sizes = np.array([BANDS if len(one) else 0 for one in sets], np.int64)
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            columns = {name: batch.column(name) for name in names}
            columns["__llm_n"] = pa.array([len(one) for one in sets], pa.int64())
            columns["__llm_set"] = pa.array(
                [xxhash.xxh3_128_digest(one.tobytes()) if len(one) else None for one in sets], pa.binary())
            columns["__llm_bands"] = pa.ListArray.from_arrays(bounds, pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, f"{schema}, __llm_n long, __llm_set binary, __llm_bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, words_each: int) -> DataFrame:
    """``pairs`` (a, b) with the sizes of intersection and union of their full sets.

    ``texts`` has a row (node, text) per node. Both texts meet in one row, so a centre with many members needs no
    more memory than one with few, and Spark may split it.
    """
    ship(pairs.sparkSession)
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    met = pairs.select("a", "b").join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in slices(batches, "text_b", 2 << 20):
            lefts, rights = batch.column("a").to_pylist(), shingle_sets(batch.column("text_b").to_pylist(), words_each)
            both, either = [], []
            for at, node in enumerate(lefts):
                if node != last:  # rows of one centre arrive together
                    last, held = node, shingle_sets([batch.column("text_a")[at].as_py()], words_each)[0]
                common = len(np.intersect1d(held, rights[at], assume_unique=True))
                both.append(common)
                either.append(len(held) + len(rights[at]) - common)
            yield pa.RecordBatch.from_pydict({
                "a": batch.column("a"), "b": batch.column("b"),
                "both": pa.array(both, pa.int64()), "either": pa.array(either, pa.int64())})

    return met.mapInArrow(run, "a long, b long, both long, either long")


def linked(least: int = LEAST) -> Column:
    return 100 * F.col("both") >= least * F.col("either")


def _united(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


class Search:
    """The pairs tested so far and what follows from them."""

    def __init__(self, texts: DataFrame, words_each: int, least: int):
        self.texts, self.words_each, self.least = texts, words_each, least
        self.tested: list[DataFrame] = []
        self.labels: DataFrame | None = None

    def links(self) -> DataFrame:
        return _united(self.tested).where(linked(self.least)).select("a", "b")

    def test(self, pairs: DataFrame) -> None:
        """Confirm pairs (a < b) that were not tested before, then label the components anew."""
        pairs = pairs.select("a", "b").distinct()
        if self.tested:
            pairs = pairs.join(_united(self.tested).select("a", "b"), ["a", "b"], "left_anti")
        self.tested.append(written(confirmed(pairs, self.texts, self.words_each), "tested"))
        self.labels = labelled(self.links())

    def with_labels(self, members: DataFrame) -> DataFrame:
        """Members with their own component and their centre's."""
        own = self.labels.select("node", F.col("label").alias("of_node"))
        centre = self.labels.select(F.col("node").alias("centre"), F.col("label").alias("of_centre"))
        return members.join(own, "node", "left").join(centre, "centre", "left").withColumns({
            "of_node": F.coalesce("of_node", "node"), "of_centre": F.coalesce("of_centre", "centre")})


def full_sets(texts: DataFrame, words_each: int) -> DataFrame:
    """(node, shingles): the packed sorted shingle hashes of ``texts`` (node, text)."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text").to_pylist(), words_each)
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "shingles": pa.array([one.tobytes() for one in sets], pa.binary())})

    return texts.select("node", "text").mapInArrow(run, "node long, shingles binary")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets have in common; all pairs by products of incidence matrices."""
    row = np.repeat(np.arange(len(sets)), [len(one) for one in sets])
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[column] > 1  # by two sets at least
    column = (np.cumsum(held > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[shared][order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    n_columns = int(column[-1]) + 1 if len(column) else 0
    for begin in range(0, n_columns, COLUMNS):
        low, high = np.searchsorted(column, [begin, begin + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, n_columns - begin)), np.float32)
        part[row[low:high], column[low:high] - begin] = 1
        both += part @ part.T  # whole numbers up to COLUMNS are exact
    return both.astype(np.int64)


def joining(linked: np.ndarray, component: np.ndarray) -> list[tuple[int, int]]:
    """Links between members that join all components which any links join: fewer than there are components."""
    component, found = component.copy(), []
    for at in range(len(component)):
        others = np.flatnonzero(linked[at] & (component != component[at]))
        if len(others):
            _, first = np.unique(component[others], return_index=True)
            found += [(at, int(other)) for other in others[first]]
            component[np.isin(component, component[others])] = component[at]
    return found


def block_links(members: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(a, b, both, either): links within buckets that join all components which links within buckets join.

    ``members`` has bucket, node, of_node; ``sets`` node and shingles. Of buckets with the same members one is compared. A large
    bucket is dealt into blocks, and every two of its blocks are a group of at most about 2 * BLOCK members.
    """
    ship(members.sparkSession)
    own = F.xxhash64("node")
    met = members.join(sets.select("node", F.length("shingles").alias("bytes")), "node")
    sizes = met.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.bit_xor(own).alias("x"), F.bit_xor(F.xxhash64(own, "node")).alias("y"))
    sizes = sizes.groupBy("n", "x", "y", "bytes").agg(F.min("bucket").alias("bucket")).select(
        "bucket", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    # with one block it meets itself, with more each meets every other
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: other != F.col("block")))
    rows = members.join(sizes, "bucket").withColumn("block", F.pmod(own, F.col("blocks")).cast("int")).withColumn("other", F.explode(others))
    rows = rows.select("bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "node", "of_node")
    group = ["bucket", "one", "two"]

    def compare(table: pa.Table) -> list[tuple[int, int, int, int]]:
        held = [np.frombuffer(one.as_py(), np.uint64) for one in table.column("shingles")]
        node, component = table.column("node").to_numpy(), table.column("of_node").to_numpy()
        both, n = intersections(held), np.array([len(one) for one in held])
        either = n[:, None] + n[None, :] - both
        return [(*sorted((int(node[i]), int(node[j]))), int(both[i, j]), int(either[i, j]))
                for i, j in joining(100 * both >= least * either, component)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
            if held is None or not held.num_rows:
                continue
            keys = np.stack([held.column(c).to_numpy() for c in group], 1)
            starts = np.flatnonzero(np.any(keys[1:] != keys[:-1], 1)) + 1
            bounds = [0, *starts.tolist(), held.num_rows]
            last = len(bounds) - 1 if batch is None else len(bounds) - 2  # the last group may go on
            found = []
            for begin, end in zip(bounds[:last], bounds[1:last + 1]):
                part = held.slice(begin, end - begin)
                if len(pa.compute.unique(part.column("of_node"))) > 1:
                    found += compare(part)
            held = held.slice(bounds[last]) if batch is not None else None
            columns = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_pydict({name: pa.array(some, pa.int64()) for name, some in zip(("a", "b", "both", "either"), columns)})

    dealt = rows.join(sets, "node").select(*group, "node", "of_node", "shingles")
    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "a long, b long, both long, either long")


def stars(members: DataFrame) -> DataFrame:
    """(bucket, node, centre) of the buckets that hold two nodes or more; the centre is the smallest node."""
    centres = members.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
    return members.join(centres.where("centre < last").drop("last"), "bucket")


def links(nodes: DataFrame, texts: DataFrame, words_each: int, least: int = LEAST) -> DataFrame | None:
    """Confirmed links (a, b) that join every component; None if no two nodes share a bucket.

    ``nodes`` has node and bands, one row per distinct set, ``texts`` node and text; both are written tables.
    """
    members = written(stars(nodes.select("node", F.explode("bands").alias("bucket"))), "buckets")
    if members.isEmpty():
        return None
    wanted = members.select("node").distinct()
    search = Search(written(texts.join(wanted, "node", "left_semi"), "bucket-texts"), words_each, least)
    others = members.where("node <> centre")
    # one centre per node settles most of them, the other centres follow where the components still differ
    search.test(others.groupBy("node").agg(F.min("centre").alias("a")).select("a", F.col("node").alias("b")))
    apart = search.with_labels(members).where("of_node <> of_centre")
    search.test(apart.select(F.col("centre").alias("a"), F.col("node").alias("b")))
    placed = written(search.with_labels(members), "placed")
    mixed = placed.where("of_node <> of_centre").select("bucket").distinct()
    left = placed.join(mixed, "bucket", "left_semi").select("bucket", "node", "of_node")
    sets = written(full_sets(search.texts.join(left.select("node").distinct(), "node", "left_semi"), words_each), "full-sets")
    search.tested.append(written(block_links(left, sets, least), "tested"))
    return search.links()


def resolved(docs: DataFrame, words_each: int = 5, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """The written rows of ``docs`` with their number, and per number, without the text: doc_id, __llm_set, __llm_n, the size of the
    set, and __llm_group, the group's smallest doc_id."""
    rows = written(sketched(with_uid(docs), words_each), "sketches")
    sets = written(rows.where("__llm_set IS NOT NULL").groupBy("__llm_set").agg(
        F.min(UID).alias("node"), F.min("doc_id").alias("least_id")), "sets")
    own = {"node": UID, "bands": "__llm_bands"}
    nodes = written(rows.select(*[F.col(c).alias(name) for name, c in own.items()]).join(
        sets.select("node"), "node", "left_semi"), "nodes")
    texts = rows.select(F.col(UID).alias("node"), "text")
    found = links(nodes, texts, words_each, least)
    if found is None:
        named = sets.select("__llm_set", F.col("least_id").alias("__llm_group"))
    else:
        labels = labelled(found)
        of_set = sets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        groups = of_set.groupBy("label").agg(F.min("least_id").alias("__llm_group"))
        named = of_set.join(groups, "label").select("__llm_set", "__llm_group")
    return rows, rows.select(UID, "doc_id", "__llm_set", "__llm_n").join(named, "__llm_set", "left").withColumn(
        "__llm_group", F.when(F.col("__llm_set").isNull(), F.col("doc_id")).otherwise(F.col("__llm_group")))


def groups(docs: DataFrame, words_each: int = 5, least: int = LEAST) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    return resolved(docs.select("doc_id", "text"), words_each, least)[1].select(
        "doc_id", F.col("__llm_n").alias("n_shingles"), F.col("__llm_group").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("__llm_group")).alias("kept"))


def kept_rows(docs: DataFrame, words_each: int = 5, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that name their group, with their columns; of rows alike in id and set, one.

    Numbers alone decide which rows stay, so that the rows themselves are shuffled once.
    """
    rows, found = resolved(docs, words_each, least)
    naming = found.where(F.col("__llm_set").isNotNull() & F.col("doc_id").eqNullSafe(F.col("__llm_group")))
    stays = naming.groupBy("__llm_group").agg(F.min(UID).alias(UID)).select(UID)
    wordless = found.where("__llm_set IS NULL").select(UID)
    return rows.join(stays.unionByName(wordless), UID, "left_semi").select(*docs.columns)
