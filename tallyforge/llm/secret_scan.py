r"""Secrets by pattern and by the entropy of sliding windows.

Pattern spans come from three regular expressions. Beyond them every run of 20 or more key-like characters is a
candidate, and so is every hex run of 20 or more characters inside it, whatever joins it to the rest. For the class of
a candidate (hex or base64) the Shannon entropy of each window of 20 characters is computed
by incremental counts. When a character enters or leaves a window only its own count changes, so the window's sum
of n * log2(n) changes by one term; a running sum of these terms over the candidate gives every window's entropy.
Windows above the class's limit merge into spans. What only looks random is on an allow-list: samples and sequences suppress
the windows that overlap them, identifiers, paths of words and pictures the whole candidate.

Positions are code points, ends are exclusive. Edge cases: null and empty texts have no spans; repeated rows and rows
with null ids are scanned one by one; other columns are ignored by ``scan`` and kept by ``redacted``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import UID, text_of, utf8, with_uid, written

#: The patterns of the three plain kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

#: Spans at one position are listed in this order.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
BASE_KINDS = KINDS[:3]

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Bits per character that a window must reach; a random window has about 3.4 (hex) and 4.1 (base64).
LIMITS = {"entropy_hex": 3.0, "entropy_base64": 3.9}
HEX_RUN = rf"[0-9a-fA-F]{{{WINDOW},}}"
#: What these match are samples, identifiers or pictures, not secrets. The first ones match a part, the others a whole run.
ALLOWED = (
    r"(?i:example|sample|placeholder|changeme|dummy|redacted)",
    r"(?i:0123456789|abcdefghij|(.)\1{7,})",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(?:iVBORw0KGgo|/9j/4AAQ|R0lGOD).*$",
)
ALLOWED_PARTS = ALLOWED[:2]
#: A run of lower-case words joined by single signs is a path or a name: it has to match all of the first and none of the others. No
#: expression repeats a group, which would take a level of the stack per word.
JOINED_WORDS, NOT_JOINED_WORDS = (r"^[a-z/_-]+$", r"^[a-z]", r"[a-z]$", r"[/_-]"), (r"[/_-]{2}",)
#: n * log2(n) in millionths, as whole numbers: sums are exact in any order.
TERM = [0] + [round(n * math.log2(n) * 1_000_000) for n in range(1, WINDOW + 1)]

CANDIDATE_KIND = len(BASE_KINDS)
#: A text without any of this has neither a pattern span nor a candidate.
ANY = rf"(?i:password|passwd|secret|token|api_?key)|AKIA|{CANDIDATE}"


def _pieces(text: Column, kind: int, pattern: str) -> Column:
    """Array of (kind, number, code points ahead of the match, match); the last piece has no match."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("ahead"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    return F.transform(zipped, lambda piece, at: F.struct(
        F.lit(kind).alias("kind"), at.alias("at"), F.length(piece["ahead"]).alias("ahead"), piece["match"].alias("match")))


def matches(docs: DataFrame) -> DataFrame:
    """One row per match and kind (numbers into KINDS, candidates above), and one row of kind -1 per document."""
    text = text_of()
    empty = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("at"), F.lit(0).alias("ahead"), F.lit(None).cast("string").alias("match")))
    found = F.when(text.rlike(ANY), F.concat(
        empty, *[_pieces(text, at, pattern) for at, pattern in enumerate((ASSIGN, ACCESS, HEX, CANDIDATE))],
    )).otherwise(empty)
    rows = docs.select(UID, "doc_id", F.explode(found).alias("piece")).select(UID, "doc_id", "piece.*")
    upto = Window.partitionBy(UID, "kind").orderBy("at")
    length = F.coalesce(F.length("match"), F.lit(0))
    end = F.sum(F.col("ahead") + length).over(upto)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - length).where("kind = -1 OR match IS NOT NULL")


_HEX_RUNS = "array<struct<kind:int,ahead:int,match:string>>"
MASK = " "


def _hex_runs(text: Column) -> Column:
    """The hex runs of a candidate with the code points ahead of each since the one before."""
    return F.when(text.rlike(HEX_RUN), F.transform(
        _pieces(text, 3, HEX_RUN), lambda p: F.struct(p["kind"].alias("kind"), p["ahead"].alias("ahead"), p["match"].alias("match")))
    ).otherwise(F.array().cast(_HEX_RUNS))


def _masked(text: Column, pattern: str) -> Column:
    """``text`` with a mask in place of every character that belongs to a match."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("ahead"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    return F.array_join(F.transform(zipped, lambda p: F.concat(p["ahead"], F.coalesce(F.regexp_replace(p["match"], ".", MASK), F.lit("")))), "")


def entropy_spans(candidates: DataFrame) -> DataFrame:
    """(uid, doc_id, kind, start, end) of merged windows whose entropy reaches the limit of the class.

    ``candidates`` has a row per run of key-like characters: uid, doc_id, start and the run as ``match``.
    """
    match = F.col("match")
    allowed = F.lit(False)
    for pattern in ALLOWED[len(ALLOWED_PARTS):]:
        allowed = allowed | match.rlike(pattern)
    allowed = allowed | reduce(Column.__and__, [
        *[match.rlike(pattern) for pattern in JOINED_WORDS], *[~match.rlike(pattern) for pattern in NOT_JOINED_WORDS]])
    hex_only = match.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")
    inner = F.when(~hex_only, _hex_runs(match)).otherwise(F.array().cast(_HEX_RUNS))
    whole = F.struct(F.when(hex_only, F.lit(3)).otherwise(F.lit(4)).alias("kind"), F.lit(0).alias("ahead"), match.alias("match"))
    classed = candidates.where(~allowed).select(
        UID, "doc_id", "start", F.posexplode(F.concat(F.array(whole), inner)).alias("order", "one")).select(
        UID, "doc_id", F.col("start").alias("run_start"), "order", "one.*", "start")
    # a hex run begins after all pieces ahead of it, the whole run at its own start
    pieces = Window.partitionBy(UID, "doc_id", "run_start").orderBy("order")
    upto = F.sum(F.when(F.col("order") == 0, F.lit(0)).otherwise(F.col("ahead") + F.coalesce(F.length("match"), F.lit(0)))).over(pieces)
    placed = classed.withColumn("start", F.when(F.col("order") == 0, F.col("run_start")).otherwise(
        F.col("run_start") + upto - F.coalesce(F.length("match"), F.lit(0))))
    classed = placed.where(match.rlike("[0-9]") & match.rlike("[A-Za-z]")).select(UID, "doc_id", "start", "match", "kind")
    run = [UID, "doc_id", "kind", "start"]
    parts = [_masked(match, pattern) for pattern in ALLOWED_PARTS]
    plain = F.transform(F.split(match, ""), lambda c: F.struct(c.alias("character"), F.lit(0).alias("known")))
    masked = F.transform(
        F.arrays_zip(F.split(match, "").alias("character"), *[F.split(part, "").alias(f"p{at}") for at, part in enumerate(parts)]),
        lambda c: F.struct(c["character"].alias("character"), reduce(
            Column.__or__, [c[f"p{at}"] == MASK for at in range(len(parts))]).cast("int").alias("known")))
    some = F.lit(False)
    for pattern in ALLOWED_PARTS:
        some = some | match.rlike(pattern)
    characters = classed.select(*run, F.posexplode(F.when(some, masked).otherwise(plain)).alias("at", "one")).select(
        *run, "at", "one.*").where("character <> ''")

    # how often the character stands in the window that it enters, and in the one that it leaves
    same = Window.partitionBy(*run, "character").orderBy("at")
    inside = F.count(F.lit(1)).over(same.rangeBetween(-(WINDOW - 1), -1))
    staying = F.count(F.lit(1)).over(same.rangeBetween(1, WINDOW - 1))
    term = F.array(*[F.lit(value).cast("bigint") for value in TERM])
    changes = characters.withColumns({
        "entering": F.get(term, (inside + 1).cast("int")) - F.get(term, inside.cast("int")),
        "leaving": F.get(term, staying.cast("int")) - F.get(term, (staying + 1).cast("int")),
    })
    along = Window.partitionBy(*run).orderBy("at")
    entered = F.sum("entering").over(along.rowsBetween(Window.unboundedPreceding, 0))
    left = F.coalesce(F.sum("leaving").over(along.rowsBetween(Window.unboundedPreceding, -WINDOW)), F.lit(0))
    limit = F.when(F.col("kind") == 3, F.lit(LIMITS["entropy_hex"])).otherwise(F.lit(LIMITS["entropy_base64"]))
    entropy = F.lit(math.log2(WINDOW)) - F.col("terms") / (WINDOW * 1_000_000)
    blocked = F.sum("known").over(along.rowsBetween(-(WINDOW - 1), 0))
    windows = changes.withColumns({"terms": entered + left, "blocked": blocked}).where(
        F.col("at") >= WINDOW - 1).where((entropy >= limit) & (F.col("blocked") == 0))

    # windows that touch or overlap become one span
    gap = F.col("at") - F.lag("at").over(along) > WINDOW
    islands = windows.withColumn("new", F.when(gap, 1).otherwise(0)).withColumn("island", F.sum("new").over(along))
    return islands.groupBy(*run, "island").agg(F.min("at").alias("first"), F.max("at").alias("last")).select(
        UID, "doc_id", "kind",
        (F.col("start") + F.col("first") - (WINDOW - 1)).alias("start"), (F.col("start") + F.col("last") + 1).alias("end"))


def spans(docs: DataFrame) -> DataFrame:
    """All spans of ``docs`` (with row numbers), one row each, and one row of kind -1 per document.

    The matches are written once: both kinds of spans read the same rows, and no text is matched twice.
    """
    found = written(matches(docs), "matches")
    value = F.regexp_extract("match", ASSIGN, 2)
    plain = found.where(f"kind < {CANDIDATE_KIND}").where((F.col("kind") != 0) | (F.length(value) >= LEAST_VALUE))
    random = entropy_spans(found.where(f"kind = {CANDIDATE_KIND}").select(UID, "doc_id", "start", "match"))
    return plain.select(UID, "doc_id", "kind", "start", "end").unionByName(random)


def _listed(rows: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts per plain kind, ``found`` (array of kind, start, end in order), and lists as text."""
    return _scan(with_uid(docs.select("doc_id", "text"))).drop(UID)


def _scan(docs: DataFrame) -> DataFrame:
    one = F.when(F.col("kind") >= 0, F.struct("start", "kind", "end"))
    count = lambda kind: F.count_if(F.col("kind") == KINDS.index(kind)).alias(f"n_{kind}")
    per = spans(docs).groupBy(UID, "doc_id").agg(
        *[count(kind) for kind in BASE_KINDS], F.sort_array(F.collect_list(one)).alias("found"))
    base = F.filter("found", lambda s: s["kind"] < len(BASE_KINDS))
    return per.withColumns({"base_spans": _listed(base), "spans": _listed(F.col("found"))})


def report(docs: DataFrame) -> DataFrame:
    """The counts, a digest of the plain spans and the list of all spans."""
    return scan(docs).select(
        "doc_id", *[f"n_{kind}" for kind in BASE_KINDS], F.sha2(utf8(F.col("base_spans")), 256).alias("base_sha256"), "spans")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; texts without a span are unchanged. ``n_chars`` follows if present."""
    rows = written(with_uid(docs), "secrets")
    found = _scan(rows.select(UID, "doc_id", "text")).where(F.size("found") > 0).select(F.col(UID).alias("__llm_on"), F.col("found").alias("__llm_found"))
    met = rows.join(found, F.col(UID) == F.col("__llm_on"), "left")
    state = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("upto"))

    def step(acc: Column, span: Column) -> Column:
        start, end = span["start"].cast("bigint"), span["end"].cast("bigint")
        ahead = F.substring(F.col("text"), (acc["upto"] + 1).cast("int"), F.greatest(start - acc["upto"], F.lit(0)).cast("int"))
        joined = F.when(start < acc["upto"], acc["done"]).otherwise(F.concat(acc["done"], ahead, F.lit(mark)))
        return F.struct(joined.alias("done"), F.greatest(acc["upto"], end).alias("upto"))

    clean = F.aggregate("__llm_found", state, step, lambda acc: F.concat(
        acc["done"], F.substring(F.col("text"), (acc["upto"] + 1).cast("int"), F.length("text"))))
    met = met.withColumn("__llm_clean", F.when(F.col("__llm_found").isNotNull(), clean))
    out = {
        "text": F.coalesce("__llm_clean", "text"),
        "n_chars": F.when(F.col("__llm_found").isNull(), F.col("n_chars")).otherwise(F.length("__llm_clean"))
        if "n_chars" in docs.columns else None,
    }
    return met.select(*[
        out[c].cast(docs.schema[c].dataType).alias(c) if out.get(c) is not None else F.col(c) for c in docs.columns])
