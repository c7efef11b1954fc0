r"""Phrase mining by vertical partitioning: suffix subtrees of word prefixes that fit a memory budget.

``encoded`` turns texts into packed word numbers, one row per chunk of some megabytes. Words below the least count can be
part of no frequent phrase; they end a suffix as the end of a piece does. The frequent words are the first prefixes. A prefix
whose occurrences exceed the budget is extended by one more word, level by level (``partitioned``), so a word that holds
a third of all places becomes many prefixes. Prefixes are put together into groups that fit the budget, every chunk
sends each group its suffixes, cut to five words, and each group builds its subtrees alone (``subtrees``): level by level, a node's
children are its distinct next words, and a child's leaves are counted. Children below the least count hold no frequent phrase.

A chunk learns the numbers of its own words and prefixes by joins on the chunk's distinct ones.

Edge cases: null and empty texts and pieces hold no words; a null language counts as ``und``; repeated rows and ids count once each; an
empty table gives an empty result; a text longer than a chunk is a chunk of its own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.common import bucketed, forget, ship, slices, written
from tallyforge.operators.ordered import asc, desc, number_rows, place_in_blocks

LONGEST = 5
LEAST = 100
TOP = 2000
#: Occurrences that a group takes at most; a prefix with more is extended. A group's suffixes are 20 bytes each.
BUDGET = 1_000_000
#: Bytes of text in a chunk.
CHUNK_BYTES = 12 << 20
#: Frequent words up to this number (some 50 MB) are broadcast, more are joined by a shuffle.
MOST_BROADCAST = 500_000
#: How hard suffixes, most of what is shuffled, are compressed.
LEVEL = 5
#: Groups below 0: prefixes to be extended, prefixes of five words, words that begin no frequent phrase.
HEAVY, LEAF, NOWHERE = -1, -2, -3

#: A piece ends at any of these, words are separated by space or tab.
_ENDS, _MARK = b".,;:!?\n\x0b\x0c\r", b"."
_FOLDED = bytes(_MARK[0] if b in _ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words in order, with a full stop wherever a piece ends."""
    return (text or "").encode().translate(_FOLDED).replace(_MARK, b" . ").split()


def encoded(docs: DataFrame) -> DataFrame:
    """One row per chunk: lang, word and n of its distinct words, and all words as their packed 32-bit places in these lists, from 1.

    Zeros stand between pieces. Not yet written.
    """
    ship(docs.sparkSession)

    def row(number: int, codes: dict[str, dict[bytes, int]], streams: list[np.ndarray]) -> pa.RecordBatch:
        stream = np.concatenate([*streams, np.zeros(1, "<u4")])
        pairs = sorted((at, lang, word) for lang, words in codes.items() for word, at in words.items() if at)
        counts = np.bincount(stream, minlength=len(pairs) + 1)[1:]
        lists = {"lang": pa.array([lang for _, lang, _ in pairs], pa.string()),
                 "word": pa.array([word for _, _, word in pairs], pa.string()), "n": pa.array(counts.astype(np.int64))}
        bounds = pa.array([0, len(pairs)], pa.int32())
        return pa.RecordBatch.from_pydict({
            "chunk": pa.array([number], pa.int64()),
            **{name: pa.ListArray.from_arrays(bounds, values) for name, values in lists.items()},
            "stream": pa.array([stream.tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, 0
        codes, streams, known = {}, [], 0
        for part in slices(batches, "text"):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                words = words_of(text)
                code = codes.setdefault(lang, {_MARK: 0})
                for word in set(words).difference(code):
                    known += 1
                    code[word] = known
                streams.append(np.fromiter(map(code.__getitem__, words), "<u4", len(words)))
                streams.append(np.zeros(1, "<u4"))
            held += part.column("text").nbytes
            if held >= CHUNK_BYTES:
                yield row(number, codes, streams)
                number, held, codes, streams, known = number + 1, 0, {}, [], 0
        if streams:
            yield row(number, codes, streams)

    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "chunk long, lang array<string>, word array<string>, n array<long>, stream binary")


def numbered(words: DataFrame) -> DataFrame:
    """Frequent ``words`` (lang, word, n) with node, a number from 1, the most frequent first."""
    order = [desc("n"), asc("lang"), asc("word")]
    placed = place_in_blocks(words, order)
    return written(number_rows(placed, [], order, number_as="node"), "words")


def grouped(nodes: DataFrame, budget: int) -> DataFrame:
    """``nodes`` (node, n) with ``group``, -1 where the node alone exceeds the budget.

    Groups are stretches of the running total, so a group holds less than twice the budget.
    """
    placed = place_in_blocks(nodes.where(F.col("n") <= budget), [asc("node")])
    totals = number_rows(placed, [], [asc("node")], number_as="__row", sums={"__upto": "n"})
    fits = totals.withColumn("group", F.floor((F.col("__upto") - 1) / budget).cast("long")).select(*nodes.columns, "group")
    return fits.unionByName(nodes.where(F.col("n") > budget).withColumn("group", F.lit(HEAVY).cast("long")))


class Walk:
    """A chunk's prefixes: which node a word leads to from another, and which group takes it (-1: go on)."""

    def __init__(self, table: pa.Table):
        key = (table.column("parent").to_numpy().astype(np.uint64) << np.uint64(32)) | table.column("word").to_numpy().astype(np.uint64)
        order = np.argsort(key)
        self.key = key[order]
        self.node = table.column("node").to_numpy()[order].astype(np.uint32)
        self.group = table.column("group").to_numpy()[order]

    def step(self, parent: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node (0: none) and group of each child."""
        key = (parent.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)
        if not len(self.key):
            return np.zeros(len(key), np.uint32), np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        there = (self.key[at] == key) & (word > 0)
        return np.where(there, self.node[at], 0), np.where(there, self.group[at], 0)


def _at(stream: np.ndarray, places: np.ndarray, ahead: int) -> np.ndarray:
    return stream[np.minimum(places + ahead, len(stream) - 1)]  # the last one is a zero


def _opened(group: pa.Table, prefixes: pa.Table) -> tuple[np.ndarray, np.ndarray, Walk]:
    """A chunk's words as corpus-wide numbers (0: piece end or rare word), the group of each as a prefix of its own, and the longer prefixes."""
    local = np.frombuffer(group.column("stream")[0].as_py(), "<u4")
    single = pa.compute.equal(prefixes.column("depth"), 1)
    first = prefixes.filter(single)
    node, goes = np.zeros(int(local.max(initial=0)) + 1, "<u4"), np.full(int(local.max(initial=0)) + 1, NOWHERE)
    place = first.column("word").to_numpy()
    node[place], goes[place] = first.column("node").to_numpy(), first.column("group").to_numpy()
    return node[local], goes[local], Walk(prefixes.filter(pa.compute.invert(single)))


def extended(chunks: DataFrame, known: DataFrame, depth: int) -> DataFrame:
    """(chunk, parent, word, n): how often a word follows the prefixes of ``depth`` words that exceed the budget."""

    def count(group: pa.Table, prefixes: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in ("chunk", "parent", "word", "n")})
        stream, goes, walk = _opened(group, prefixes)
        places = np.flatnonzero(goes == HEAVY)
        node = stream[places]
        for ahead in range(1, depth):
            node, heavy = walk.step(node, _at(stream, places, ahead))
            keep = (node > 0) & (heavy == HEAVY)
            places, node = places[keep], node[keep]
        word = _at(stream, places, depth)
        key, counts = np.unique((node[word > 0].astype(np.uint64) << np.uint64(32)) | word[word > 0], return_counts=True)
        return pa.table({
            "chunk": pa.array([group.column("chunk")[0].as_py()] * len(key), pa.int64()),
            "parent": pa.array((key >> np.uint64(32)).astype(np.int64)), "word": pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)),
            "n": pa.array(counts.astype(np.int64))})

    return chunks.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(count, "chunk long, parent long, word long, n long")


def partitioned(chunks: DataFrame, known: DataFrame, n_nodes: int, least: int, budget: int) -> tuple[DataFrame, list[DataFrame]]:
    """The prefixes every chunk needs, and per level the frequent prefixes of two words or more: parent, word, n, node, group.

    ``known`` is the level of single words: of (their chunk), depth, parent (0), word (its place in the chunk), node, group.
    """
    levels = []
    for depth in range(1, LONGEST):
        if known.where((F.col("depth") == depth) & (F.col("group") == HEAVY)).isEmpty():
            break
        met = written(extended(chunks, known, depth), "extended")
        totals = met.groupBy("parent", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        order = [desc("n"), asc("parent"), asc("word")]
        rows = written(number_rows(place_in_blocks(totals, order), [], order, number_as="node").withColumn(
            "node", F.col("node") + n_nodes), "prefixes")
        n_nodes += rows.count()
        if depth + 1 < LONGEST:
            # numbers of groups follow those of the levels before
            first = max(known.agg(F.max("group").alias("g")).first()[0], 0) + 1
            fits = grouped(rows, budget).withColumn("group", F.when(F.col("group") == HEAVY, HEAVY).otherwise(F.col("group") + first))
        else:
            fits = rows.withColumn("group", F.lit(LEAF).cast("long"))
        fits = written(fits, "prefixes")
        levels.append(fits)
        back = met.withColumnRenamed("chunk", "of").select("of", "parent", "word").join(fits.drop("n"), ["parent", "word"])
        known = known.unionByName(written(back.withColumn("depth", F.lit(depth + 1)), "known"))
        forget(met)
    return known, levels


def suffixes(chunks: DataFrame, known: DataFrame) -> DataFrame:
    """(group, n, suffixes): per chunk and group the n suffixes of two words or more, as compressed planes of their numbers' bytes."""

    def route(group: pa.Table, prefixes: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"group": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "suffixes": pa.array([], pa.binary())})
        stream, goes, walk = _opened(group, prefixes)
        places = np.flatnonzero((stream[:-1] > 0) & (stream[1:] > 0))
        goes, node = goes[places], stream[places]
        for ahead in range(1, LONGEST - 1):
            on = np.flatnonzero(goes == HEAVY)
            if not len(on):
                break
            node[on], goes[on] = walk.step(node[on], _at(stream, places[on], ahead))
            goes[on[node[on] == 0]] = NOWHERE  # no frequent phrase begins so
        places, goes = places[goes >= 0], goes[goes >= 0]
        # neighbours alike compress well, so suffixes lie in the order of their first three words
        pair = (stream[places].astype(np.uint64) << np.uint64(32)) | stream[places + 1]
        order = np.lexsort((_at(stream, places, 2), pair, goes))
        places, goes = places[order], goes[order]
        planes = np.zeros((LONGEST, len(places)), "<u4")
        planes[0] = stream[places]
        for ahead in range(1, LONGEST):
            planes[ahead] = np.where(planes[ahead - 1] > 0, _at(stream, places, ahead), 0)
        by_byte = planes.view(np.uint8).reshape(LONGEST, len(places), 4)
        starts = np.flatnonzero(np.diff(goes, prepend=-1))
        ends = np.append(starts[1:], len(goes))
        codec = pa.Codec("zstd", compression_level=LEVEL)
        rows = [codec.compress(np.ascontiguousarray(by_byte[:, a:b].transpose(0, 2, 1)), asbytes=True)
                for a, b in zip(starts.tolist(), ends.tolist())]
        return pa.table({"group": pa.array(goes[starts]), "n": pa.array(ends - starts), "suffixes": pa.array(rows, pa.binary())})

    return chunks.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(route, "group long, n long, suffixes binary")


def _planes(n: int, packed: bytes) -> np.ndarray:
    by_byte = np.frombuffer(pa.decompress(packed, n * LONGEST * 4, codec="zstd", asbytes=True), np.uint8).reshape(LONGEST, 4, n)
    return np.ascontiguousarray(by_byte.transpose(0, 2, 1)).view("<u4").reshape(LONGEST, n)


def subtrees(sent: DataFrame, least: int) -> DataFrame:
    """(ids, f): the phrases of two words or more, as packed 32-bit numbers, that occur ``least`` times in a group's suffixes."""

    def grow(group: pa.Table) -> pa.Table:
        planes = np.concatenate([_planes(n.as_py(), one.as_py()) for n, one in zip(group.column("n"), group.column("suffixes"))], 1)
        rows = np.arange(len(planes[0]))
        node = planes[0].astype(np.uint64)  # nodes of a level are numbered anew, the first level by its words
        spelt = {int(word): np.array([word], "<u4").tobytes() for word in np.unique(planes[0])}
        phrases, found = [], []
        for depth in range(1, LONGEST):
            word = planes[depth][rows]
            rows, node, word = rows[word > 0], node[word > 0], word[word > 0]
            key, child, counts = np.unique((node << np.uint64(32)) | word, return_inverse=True, return_counts=True)
            frequent = counts >= least
            keep = frequent[child]
            rows, node = rows[keep], child[keep].astype(np.uint64)
            heads, tails = (key >> np.uint64(32)).tolist(), (key & np.uint64(0xFFFFFFFF)).astype("<u4")
            spelt = {at: spelt[heads[at]] + tails[at].tobytes() for at in np.flatnonzero(frequent).tolist()}
            phrases += spelt.values()
            found += counts[frequent].tolist()
        return pa.table({"ids": pa.array(phrases, pa.binary()), "f": pa.array(found, pa.int64())})

    return sent.groupBy("group").applyInArrow(grow, "ids binary, f long")


def counts(docs: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: (lang, n) all words; (node, lang, word, n) frequent words; (ids, f) frequent phrases of 1 to 5 words.

    ``ids`` are the packed 32-bit numbers (``node``) of a phrase's words.
    """
    chunks = bucketed(encoded(docs), "chunks")
    own = chunks.select("chunk", F.posexplode(F.arrays_zip("lang", "word", "n")).alias("place", "w")).select(
        "chunk", (F.col("place") + 1).alias("place"), "w.*")
    words = written(own.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    sizes = written(words.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    frequent = numbered(words.where(F.col("n") >= least))
    of_word = written(grouped(frequent.select("node", "n"), budget).select("node", "group").join(frequent, "node"), "nodes")
    forget(words)
    # every word of a chunk with its number, 0 for a rare one; a dictionary is broadcast below a stated size only
    numbers = of_word.select("lang", "word", "node", "group")
    n_frequent = frequent.count()
    numbers = F.broadcast(numbers) if n_frequent <= MOST_BROADCAST else numbers
    met = written(own.select(F.col("chunk").alias("of"), "place", "lang", "word").join(numbers, ["lang", "word"], "left").select(
        "of", F.col("place").cast("long").alias("word"), F.coalesce("node", F.lit(0)).alias("node"), F.coalesce("group", F.lit(NOWHERE)).alias("group")), "met")
    single = met.where("node > 0").select("of", F.lit(1).alias("depth"), F.lit(0).cast("long").alias("parent"), "word", "node", "group")
    streams = chunks.select("chunk", "stream")
    known, levels = partitioned(streams, single, n_frequent, least, budget)
    found = subtrees(suffixes(streams, known), least)
    found = found.unionByName(frequent.select(_packed(F.col("node")).alias("ids"), F.col("n").alias("f")))
    # prefixes that were extended, and those of five words, are in no group
    spelt = frequent.select("node", _packed(F.col("node")).alias("ids"))
    for level in levels:
        spelt = written(level.join(spelt.withColumnsRenamed({"node": "parent"}), "parent").select(
            "node", F.concat("ids", _packed(F.col("word"))).alias("ids"), "n", "group"), "spelt")
        found = found.unionByName(spelt.where("group < 0").select("ids", F.col("n").alias("f")))
        spelt = spelt.select("node", "ids")
    return sizes, frequent, written(found, "phrases")


def _packed(number):
    """A number as four bytes, the lowest first."""
    big = F.unhex(F.lpad(F.hex(number), 8, "0"))
    return F.concat(*[F.substring(big, at, 1) for at in (4, 3, 2, 1)])


def scored(sizes: DataFrame, frequent: DataFrame, phrases: DataFrame) -> DataFrame:
    """ids, lang, a, l, r, n, score of every candidate: its lowest-scoring cut, the first among equals."""
    f = phrases.select("ids", "f")
    n_words = F.length("ids") / 4
    candidates = phrases.where("length(ids) > 4").withColumn("k", F.explode(F.sequence(F.lit(1), (n_words - 1).cast("int"))))
    cut = candidates.select(
        "ids", F.col("f").alias("a"), "k", F.expr("substring(ids, 1, 4 * k)").alias("head"), F.expr("substring(ids, 4 * k + 1)").alias("tail"),
        F.expr("substring(ids, 1, 4)").alias("first"))
    heads = f.select(F.col("ids").alias("head"), F.col("f").alias("l"))
    tails = f.select(F.col("ids").alias("tail"), F.col("f").alias("r"))
    langs = frequent.select(_packed(F.col("node")).alias("first"), "lang")
    # products of long numbers need up to 38 digits; the integral quotient is exact
    ratio = F.expr("(cast(1000 * a AS decimal(19, 0)) * cast(n AS decimal(18, 0))) div (cast(l AS decimal(19, 0)) * cast(r AS decimal(18, 0)))")
    rows = cut.join(heads, "head").join(tails, "tail").join(langs, "first").join(sizes, "lang").withColumn("score", ratio)
    lowest = rows.groupBy("ids", "lang").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    return lowest.select("ids", "lang", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def uncovered(candidates: DataFrame) -> DataFrame:
    """Candidates that stand in no longer candidate as often as alone."""
    inner = F.expr("""flatten(transform(sequence(2, div(length(ids), 4) - 1), m ->
        transform(sequence(0, div(length(ids), 4) - m), s -> substring(ids, cast(4 * s + 1 AS int), cast(4 * m AS int)))))""".replace(
        "div(length(ids), 4)", "cast(length(ids) / 4 AS int)"))
    covered = candidates.where("length(ids) > 8").select(F.explode(inner).alias("ids"), F.col("a").alias("longer")).groupBy(
        "ids").agg(F.max("longer").alias("longer"))
    return candidates.join(covered, "ids", "left").where("longer IS NULL OR 100 * longer < 100 * a").drop("longer")


def top(docs: DataFrame, least: int = LEAST, limit: int = TOP, budget: int = BUDGET) -> DataFrame:
    """Each language's first ``limit`` phrases: lang, rank, phrase, a, l, r, n, score."""
    sizes, frequent, phrases = counts(docs, least, budget)
    left = written(uncovered(scored(sizes, frequent, phrases)), "candidates")
    words = frequent.select("node", "word")
    number = sum((F.conv(F.hex(F.expr(f"substring(ids, cast(4 * at + {b + 1} AS int), 1)")), 16, 10).cast("long") * F.lit(256 ** b)
                  for b in range(4)), F.lit(0).cast("long"))
    # the first in either order of ties need the phrases, so every phrase is spelt before the ranks
    spelt = left.withColumn("at", F.explode(F.sequence(F.lit(0), (F.length("ids") / 4 - 1).cast("int")))).withColumn("node", number)
    spelt = spelt.join(words, "node").groupBy("ids").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    rows = left.join(spelt, "ids")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    first = rows.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= limit)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= limit).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
