r"""Phrase and proximity search through a distributed positional inverted index; benchmark decontamination.

``build`` stores a posting list for every word of every document. The index is dealt by document: a segment takes some megabytes
of text and holds one row per word with all its places in the segment, so the list of a very common word is many
bounded rows. A place is the document's number in the segment (upper bits) and the word's number in the text (as many lower bits as
the segment's longest text needs and some to spare), so subtracting a word's offset in a phrase keeps documents apart.

``spans`` looks windows of items up: each window takes its two rarest words by corpus frequency, their lists are shifted by the words'
offsets and intersected, and only the alignments left are held against the lists of the window's other words. Runs of
words that stand in their places and are a window long at least are exact phrases. With ``slack`` a word may also stand up to so many
words off its place: windows whose every word does are proximity matches.

A word is a run outside ASCII's signs and white space, A-Z in lower case. Edge cases: null and empty texts and items without words hold nothing;
an item with fewer words than a window is one window; an item without an id is left out; repeated rows are
documents of their own, equal item ids one item; an empty table on either side gives no spans; a very long text is a segment of
its own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.common import UID, ship, slices, with_uid, written

WIDTH = 10
#: Bytes of text in a segment; a longer text is a segment of its own.
SEGMENT_BYTES = 6 << 20
#: Words between documents that no alignment can bridge.
GAP = 64
#: A segment also ends where its places would pass this.
MOST_PLACES = 1 << 31
#: Terms or probes up to this number (some 20 MB) are broadcast, more are joined by a shuffle.
MOST_BROADCAST = 200_000
#: Fixed value: a word is a run of characters outside these.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLDED).split()


class Segment:
    """Documents gathered until they make the rows of one segment."""

    def __init__(self, number: int):
        self.number, self.held, self.longest = number, 0, 0
        self.code: dict[bytes, int] = {}
        self.ids, self.found = [], []

    def shift(self, longest: int) -> int:
        return (max(self.longest, longest) + GAP).bit_length()

    def takes(self, longest: int, documents: int) -> bool:
        """Whether so many more documents fit, the longest of so many words."""
        return not self.found or (self.held < SEGMENT_BYTES and (len(self.found) + documents) << self.shift(longest) <= MOST_PLACES)

    def add(self, ids: pa.Array, texts: list[list[bytes]], held: int) -> None:
        code = self.code
        for words in texts:
            for word in set(words).difference(code):
                code[word] = len(code)
            self.found.append(np.fromiter(map(code.__getitem__, words), np.uint32, len(words)))
            self.longest = max(self.longest, len(words))
        self.ids.append(ids)
        self.held += held

    def rows(self) -> pa.RecordBatch:
        """The documents, then the words with their places."""
        codes, sizes, shift = np.concatenate(self.found), [len(one) for one in self.found], self.shift(0)
        # one document alone may need more than 32 bits: its number is 0
        places = np.concatenate([(at << shift) + np.arange(n) for at, n in enumerate(sizes)]).astype(np.int32)
        counts = np.bincount(codes, minlength=len(self.code)).astype(np.int64)
        n_docs, n_terms, ids = len(sizes), len(self.code), pa.concat_arrays(self.ids)
        bounds = np.concatenate([np.zeros(n_docs + 1, np.int64), np.cumsum(counts)])
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(places[np.argsort(codes, kind="stable")]))
        return pa.RecordBatch.from_pydict({
            "segment": pa.array(np.full(n_docs + n_terms, self.number)),
            "shift": pa.array(np.full(n_docs + n_terms, shift, np.int32)),
            "doc_id": pa.concat_arrays([ids, pa.nulls(n_terms, ids.type)]),
            "ordinal": pa.concat_arrays([pa.array(np.arange(n_docs, dtype=np.int32)), pa.nulls(n_terms, pa.int32())]),
            "term": pa.concat_arrays([pa.nulls(n_docs, pa.string()), pa.array(list(self.code), pa.string())]),
            "is_term": pa.array(np.arange(n_docs + n_terms) >= n_docs),
            "n": pa.array(np.concatenate([np.array(sizes, np.int64), counts])),
            "places": lists,
        })


def build(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text), not yet written.

    Rows with ``is_term`` are posting lists (segment, term, n, places), the others documents (segment, ordinal, doc_id, n); ``shift``
    is the number of a place's lower bits. Segments carry the task's number: write the index once, then read it as often as needed.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = Segment(TaskContext.get().partitionId() << 32)
        for part in slices(batches, "text", 1 << 20):
            texts = [words_of(text) for text in part.column("text").to_pylist()]
            if not segment.takes(max(map(len, texts)), len(texts)):
                yield segment.rows()
                segment = Segment(segment.number + 1)
            segment.add(part.column("doc_id"), texts, part.column("text").nbytes)
        if segment.found:
            yield segment.rows()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"segment long, shift int, doc_id {id_type}, ordinal int, term string, is_term boolean, n long, places array<int>")


def small(table: DataFrame) -> DataFrame:
    """``table`` (written) marked for a broadcast if it has few rows; otherwise Spark chooses."""
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table


def items_of(table: DataFrame) -> DataFrame:
    """item (a number of its own), item_id and words of every item that has an id and words."""
    folded = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))
    rows = table.select("item_id", words.alias("words")).where("item_id IS NOT NULL AND size(words) > 0").distinct()
    return written(with_uid(rows).withColumnRenamed(UID, "item"), "items")


def _width(words: Column, width: int) -> Column:
    return F.least(F.size(words), F.lit(width))


def probes(items: DataFrame, frequencies: DataFrame, width: int) -> DataFrame:
    """The windows of ``items``, those with the same two rarest words in the same places together.

    item, low (first start) and end of the windows, place and term of the rarest word (one) and the next (two).
    Windows with a word that the index lacks occur nowhere and are left out.
    """
    at = F.posexplode("words").alias("p", "term")
    known = items.select("item", at).join(frequencies, "term")
    rows = known.groupBy("item").agg(F.collect_list(F.struct("n", "p", "term")).alias("known"))
    rows = rows.join(items.select("item", "words"), "item").withColumn("span", _width(F.col("words"), width))
    starts = rows.select("item", "span", "known", F.explode(F.expr("sequence(0, size(words) - span)")).alias("w"))
    inside = starts.withColumn("inside", F.expr("filter(known, k -> k.p >= w AND k.p < w + span)")).where("size(inside) = span")
    rarest = inside.withColumn("rarest", F.expr("slice(array_sort(inside), 1, 2)")).withColumns({
        "one": F.expr("rarest[0]"), "two": F.expr("get(rarest, least(1, size(rarest) - 1))")})
    return rarest.groupBy("item", "one.p", "two.p", "one.term", "two.term").agg(
        F.min("w").alias("low"), F.max(F.col("w") + F.col("span")).alias("end")).toDF(
        "item", "p_one", "p_two", "one", "two", "low", "end")


def _aligned(places: str, offset: str, slack: int) -> str:
    """Where the item would begin for each place of the word at ``offset``, up to ``slack`` words to either side."""
    shifted = f"transform({places}, x -> x - {offset})"
    if not slack:
        return shifted
    return f"flatten(transform({shifted}, x -> sequence(x - {slack}, x + {slack})))"


def alignments(lists: DataFrame, found: DataFrame, items: DataFrame, slack: int) -> DataFrame:
    """(segment, item, d, p, term): the words that an alignment d of an item would have to put at d + p."""
    rare = small(written(found.select("two").distinct(), "rare"))
    one = lists.select("segment", F.col("term").alias("one"), F.col("places").alias("places_one"))
    two = lists.select("segment", F.col("term").alias("two"), F.col("places").alias("places_two")).join(rare, "two", "left_semi")
    met = one.join(small(found), "one").join(two, ["segment", "two"]).select(
        "segment", "item", "low", "end",
        F.explode(F.expr(f"array_intersect({_aligned('places_one', 'p_one', slack)}, {_aligned('places_two', 'p_two', slack)})")).alias("d"))
    words = F.posexplode(F.expr("slice(words, low + 1, end - low)")).alias("p", "term")
    expected = met.join(small(items).select("item", "words"), "item").select("segment", "item", "d", "low", words)
    return expected.select("segment", "item", "d", (F.col("p") + F.col("low")).alias("p"), "term").distinct()


def spans(index: DataFrame, items: DataFrame, width: int = WIDTH, slack: int = 0) -> DataFrame:
    """Runs of an item's words in a document: segment, ordinal, item_id, exact, first (its word in the text), item_first, n_words.

    ``index`` is a written index, ``items`` what :func:`items_of` returned. Runs with ``exact`` are all windows of ``width`` words that stand in the
    text; the others, with ``slack`` only, those whose words stand at most ``slack`` words off (exact ones included).
    """
    if not 0 <= slack < GAP // 2:
        raise ValueError(f"slack must lie below {GAP // 2}")
    terms = written(items.select(F.explode("words").alias("term")).distinct(), "terms")
    lists = written(index.where("is_term").join(small(terms), "term", "left_semi").select("segment", "term", "n", "places"), "lists")
    frequencies = lists.groupBy("term").agg(F.sum("n").alias("n"))
    found = written(probes(items, frequencies, width), "probes")
    expected = written(alignments(lists, found, items, slack), "alignments")
    tried = expected.withColumn("off", F.explode(F.sequence(F.lit(-slack), F.lit(slack)))).withColumn(
        "place", F.col("d") + F.col("p") + F.col("off"))
    # a list is intersected once with all places that any alignment asks of it
    asked = tried.groupBy("segment", "term").agg(F.collect_set("place").alias("asked"))
    there = asked.join(lists, ["segment", "term"]).select(
        "segment", "term", F.explode(F.array_intersect("asked", "places")).alias("place"))
    met = written(tried.join(there, ["segment", "term", "place"]).groupBy("segment", "item", "d", "p").agg(
        F.min(F.struct(F.abs("off").alias("off"), "place")).alias("best")).select("segment", "item", "d", "p", "best.*"), "met")
    named = items.select("item", "item_id", _width(F.col("words"), width).alias("span"))
    shifts = index.where("ordinal = 0").select("segment", "shift")

    def runs(rows: DataFrame, exact: bool) -> DataFrame:
        alignment = ["segment", "item", "d"]
        island = F.col("p") - F.row_number().over(Window.partitionBy(*alignment).orderBy("p"))
        joined = rows.withColumn("island", island).groupBy(*alignment, "island").agg(
            F.min("p").cast("long").alias("item_first"), F.count(F.lit(1)).alias("n_words"), F.min("place").alias("place"))
        ordinal = F.expr("shiftright(place, shift)")
        return joined.join(named, "item").where("n_words >= span").join(shifts, "segment").select(
            "segment", ordinal.alias("ordinal"), "item_id", F.lit(exact).alias("exact"),
            F.expr("place - shiftleft(shiftright(place, shift), shift)").cast("long").alias("first"), "item_first", "n_words")

    found = runs(met.where("off = 0"), True)
    return found.unionByName(runs(met, False)) if slack else found


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, slack: int = 0) -> DataFrame:
    """doc_id, item_id, exact, first, item_first, n_words of every span: the general form of the search."""
    index = written(build(docs), "index")
    found = spans(index, items_of(benchmark), width, slack)
    return found.join(_directory(index), ["segment", "ordinal"]).select(
        "doc_id", "item_id", "exact", "first", "item_first", "n_words")


def _directory(index: DataFrame) -> DataFrame:
    return index.where("NOT is_term").select("segment", "ordinal", "doc_id", F.col("n").alias("doc_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, slack: int = 0) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside exact windows), n_items and item_ids (with exact windows), contaminated,
    and n_near, the items with a window whose words stand at most ``slack`` words off their places."""
    index = written(build(docs), "index")
    found = written(spans(index, items_of(benchmark), width, slack), "spans")
    document = ["segment", "ordinal"]
    hit = found.where("exact").select(*document, F.explode(F.expr("sequence(first, first + n_words - 1)")).alias("word"))
    hit = hit.distinct().groupBy(*document).agg(F.count(F.lit(1)).alias("n_hit"))
    near = F.collect_set(F.col("item_id").cast("string"))
    named = found.groupBy(*document).agg(
        F.collect_set(F.when(F.col("exact"), F.col("item_id").cast("string"))).alias("items"), F.size(near).alias("n_near"))
    rows = _directory(index).join(hit, document, "left").join(named, document, "left")
    ids = F.coalesce(F.array_sort("items"), F.array().cast("array<string>"))
    return rows.select(
        "doc_id", F.col("doc_words").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
