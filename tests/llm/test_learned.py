"""Licences, near-duplicates, language model, classifier and pipeline against plain versions."""

import math
import random
import re
import time
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from helpers import prose, squeezed, table, texts

from tallyforge.llm import class_lm, components, license_scan, minhash, pu_classifier, secret_scan

LOWER = {i: i + 32 for i in range(65, 91)}


def phrases_in(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        phrase = phrase.split(" ")
        for at in range(len(words) - len(phrase) + 1):
            if words[at:at + len(phrase)] == phrase:
                places.append(at)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licences(spark):
    notice = license_scan.NOTICES[9][1]  # a long notice
    words = notice.split()
    edited = " ".join([*words[:20], "inserted", *words[20:60], *words[61:]])  # one word more, one fewer
    more = [(300, "x " + notice), (301, edited), (302, " ".join(words[:12])), (303, "MIT License. mit license CC-BY apache  LICENSE"),
            (304, "all rights reserved. All Rights Reserved"), (305, "gnu general public"), (306, "of the " * 500)]
    rows = license_scan.scan(table(spark, texts() + more)).collect()
    want = Counter((i, *phrases_in(t or "")) for i, t in texts() + more)
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == want
    by = {r.doc_id: r for r in rows}
    label = license_scan.NOTICES[9][0]
    assert label in by[300].labels.split(",") and by[300].score == 1.0
    assert label in by[301].labels.split(",") and license_scan.LEAST_COVER < by[301].score < 1
    assert by[302].labels == "" and by[305].labels == "" and by[306].labels == ""
    assert by[19].labels == "apache,apache-2.0" and by[303].labels == "apache,cc-by,mit"
    assert len([s for s in by[304].found if s.label == "all-rights-reserved"]) == 2
    assert license_scan.scan(table(spark, [])).count() == 0


def test_licences_with_a_word_at_each_line(spark):
    rows = []
    for at, (label, notice) in enumerate(license_scan.NOTICES):
        words = notice.split()
        lines = [" ".join(words[i:i + 12]) for i in range(0, len(words), 12)]
        rows += [(at, "\n".join(f"rem {line}" for line in lines)), (100 + at, " filler ".join(words[i] for i in range(len(words))))]
        # an exact copy with a stray hit two words off its own diagonal
        rows.append((200 + at, " ".join([*words, "and", "then", *words[-4:]])))
    by = {r.doc_id: r for r in license_scan.scan(table(spark, rows)).collect()}
    for at, (label, notice) in enumerate(license_scan.NOTICES):
        if len(notice.split()) > 12:
            assert label in by[at].labels.split(",") and by[at].score > license_scan.LEAST_COVER
            assert by[100 + at].labels == ""
        assert label in by[200 + at].labels.split(",")


def shingles(text, width):
    words = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def plain_components(rows, width):
    sets = [(i, shingles(t, width)) for i, t in rows]
    label = list(range(len(rows)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            one, other = sets[a][1], sets[b][1]
            if one and other and 100 * len(one & other) >= 80 * len(one | other):
                label[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for at, (i, s) in enumerate(sets):
        if i is not None:
            least[top(at)] = min(i, least.get(top(at), i))
    return [(i, len(s), least.get(top(at)) if s else i) for at, (i, s) in enumerate(sets)]


def chained(n=40):
    """Each text is linked with the next, few with those beyond; and texts that share a passage only."""
    words, rows = prose(11, 100, 5000).split(" "), []
    for i in range(n):
        words = [*words[:2 * i % 100], f"a{i}", f"b{i}", *words[2 * i % 100 + 2:]]
        rows.append((1000 + i, " ".join(words)))
    passage = prose(12, 60, 5000)
    return rows + [(2000 + i, passage + " " + prose(100 + i, 40, 5000)) for i in range(n)]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    rows = texts() + chained()
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.groups(table(spark, rows), width).collect())
    assert got == Counter(plain_components(rows, width))


def test_near_duplicates_of_nothing_and_of_strangers(spark):
    assert minhash.groups(table(spark, [])).count() == 0
    rows = minhash.groups(table(spark, [(1, "a b c d e f"), (2, "g h i j k l"), (3, None)]), 2).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in rows} == {(1, 1, True), (2, 2, True), (3, 3, True)}


def test_near_duplicate_rows_kept(spark):
    docs = table(spark)
    kept = minhash.kept_rows(docs, 5)
    assert kept.columns == docs.columns
    firsts = {c for _, n, c in plain_components(texts(), 5) if n and c is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i in firsts) == sorted(firsts)
    assert {7, 8, 9} <= set(ids)


def test_a_large_bucket_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = [(i, " ".join([*prose(20, 100, 5000).split(" ")[:92 - i % 9], *prose(200 + i % 7, 8 + i % 9, 5000).split(" ")])) for i in range(60)]
    got = Counter((r.doc_id, r.component_id) for r in minhash.groups(table(spark, rows), 2).collect())
    assert got == Counter((i, c) for i, _, c in plain_components(rows, 2))


def test_blocks_join_what_is_linked(spark, monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = random.Random(4)
    sets, members, truth = {}, [], set()
    for at in range(60):  # four of five in common: exactly the limit
        one = sorted(rng.randrange(1 << 64) for _ in range(5))
        for k in range(3):
            sets[3 * at + k] = one if k == 0 else one[:4] if k == 1 else [rng.randrange(1 << 64), *one[1:]]
            members += [(at, 3 * at + k, 3 * at + k), (1000 + at, 3 * at + k, 3 * at + k)]  # a second bucket with the same members
    members += [(5000, node, node) for node in sets]
    for i in sets:
        for j in sets:
            both = len(set(sets[i]) & set(sets[j]))
            if i < j and 100 * both >= 80 * (len(set(sets[i])) + len(set(sets[j])) - both):
                truth.add((i, j))
    for block in (256, 16):
        monkeypatch.setattr(minhash, "BLOCK", block)
        got = {(r.a, r.b) for r in minhash.block_links(
            spark.createDataFrame(members, "bucket long, node long, of_node long"),
            spark.createDataFrame([(n, bytearray(np.sort(np.array(v, np.uint64)).tobytes())) for n, v in sets.items()], "node long, shingles binary"),
            80).collect()}
        assert got <= truth and {j for i, j in got} == {j for i, j in truth}


def test_few_links_join_a_block():
    linked = np.zeros((6, 6), bool)
    for i, j in [(0, 1), (1, 2), (3, 4), (2, 0), (4, 5), (3, 5)]:
        linked[i, j] = linked[j, i] = True
    found = minhash.joining(linked, np.array([10, 11, 12, 13, 14, 14]))
    assert len(found) == 3 and all(linked[i, j] for i, j in found)


def test_signatures_estimate_similarity():
    a = minhash.shingle_sets([prose(30, 300, 9000)], 2)[0]
    b = np.sort(np.concatenate([a[: len(a) * 9 // 10], minhash.shingle_sets([prose(31, 30, 9000)], 2)[0]]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((minhash.signature(a) == minhash.signature(b)).mean() - true) < 0.1
    tiny = minhash.shingle_sets(["one two three"], 2)[0]
    assert len(minhash.signature(tiny)) == minhash.BINS and set(minhash.signature(tiny)) <= set(tiny)


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (60, 50)]
    got = {r.node: r.label for r in components.labelled(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 40: 40, 50: 40, 60: 40}


def test_language_model(spark):
    rows = class_lm.scored(table(spark), rounds=2).collect()
    documents = [(i, [*(t or "").encode().translate(class_lm._LOWER).split(), class_lm.END]) for i, t in texts()]
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    counts = Counter(w for i, words in documents if fold(i) != 2 for w in words)
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, fold(i) == 2, len(words), sum(counts[w] > 0 for w in words), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), 4)) for i, words in documents)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_model_probabilities_sum_to_one(spark):
    units, model, tokens, distinct = class_lm.trained(table(spark), rounds=2)
    after, share, unknown = model.tables()
    assert np.allclose((10 ** after).sum(1), 1)
    size = np.zeros(class_lm.CLASSES)
    for row in units.where("train").collect():
        np.add.at(size, model.of_unit[np.frombuffer(row.units, "<u2")], 1)
    assert size.sum() == tokens and np.array_equal(size, model.pairs.sum(0))
    # all known words of a class and the unknown one
    assert np.allclose((size * 10 ** share + 10 ** unknown)[size > 0], 1)


def test_exchange_raises_the_likelihood(spark):
    rng = random.Random(5)
    groups = [[f"{g}{i}" for i in range(30)] for g in "abc"]
    rows = [(i, " ".join(rng.choice(groups[(i + at) % 3]) for at in range(200))) for i in range(60)]
    units, first, _, _ = class_lm.trained(table(spark, rows), rounds=0)
    assert class_lm.cluster(units.where("train"), 8).likelihood() > first.likelihood()


def move_of_one(before, after, own, pairs):
    """The class to which one unit should move, straight from the likelihood."""
    phi = class_lm._phi
    rest = pairs.astype(float)
    rest[:, own] -= before
    rest[own, :] -= after
    found = []
    for c in range(class_lm.CLASSES):
        table = rest.copy()
        table[:, c] += before
        table[c, :] += after
        found.append(phi(table).sum() - phi(table.sum(0)).sum() - phi(table.sum(1)).sum())
    return int(np.argmax(found)) if max(found) > found[own] + 1e-6 else own


def test_units_move_to_their_likeliest_class():
    rng = np.random.default_rng(3)
    classes = class_lm.CLASSES
    pairs = rng.integers(2000, 4000, (classes, classes))
    for _ in range(50):
        around = rng.integers(0, 9, (1, 2, classes)) * (rng.random((1, 2, classes)) < 0.4)
        keys = np.flatnonzero(around.ravel())
        own = rng.integers(0, classes, 1)
        got = class_lm.exchanged(keys, around.ravel()[keys], own, pairs)
        assert got[0] == move_of_one(around[0, 0], around[0, 1], own[0], pairs)


def test_a_round_reads_a_chunk_once(spark, monkeypatch):
    """What stands around the units of a turn and all class bigrams come from one pass, also over many chunks and pieces."""
    monkeypatch.setattr(class_lm, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(class_lm, "PIECE", 100)
    passes, found, read = [], [], class_lm._with_classes
    monkeypatch.setattr(class_lm, "_with_classes", lambda *given: passes.append(1) or read(*given))
    keep = lambda table: found.append([r.asDict() for r in table.collect()])
    forget = class_lm.forget
    monkeypatch.setattr(class_lm, "forget", lambda table: keep(table) or forget(table))
    rng = random.Random(8)
    units, model, tokens, _ = class_lm.trained(table(spark, [(i, " ".join(rng.choice("abcdefghijk") for _ in range(60))) for i in range(150)]), rounds=3)
    assert len(passes) == 3 + 1 + 1  # three rounds, the last likelihood, the coded documents
    classes, texts_of = class_lm.CLASSES, {}
    want, around = np.zeros((classes, classes), int), 0
    for row in units.where("train").orderBy("begin").collect():
        texts_of.setdefault(row.chunk, []).extend(np.frombuffer(row.units, "<u2"))
    assert len(texts_of) > 1
    for line in texts_of.values():
        np.add.at(want, ([line[-1], *line[:-1]], line), 1)
    assert np.array_equal(model.pairs, want) and want.sum() == tokens
    for turn, rows in enumerate(found):
        own = sum(np.frombuffer(r["counts"], "u1").sum() for r in rows if r["part"] >= 0)
        bigrams = np.sum([r["bigrams"][:classes ** 2] for r in rows if r["part"] < 0], 0)
        assert bigrams.sum() == tokens and len([r for r in rows if r["part"] < 0]) >= len(texts_of)
        around += own if turn < class_lm.TURNS else 0
    assert around == 2 * tokens  # every token is of one turn's unit and stands between two others


def test_units_moved_together_go_where_each_goes_alone():
    """Many units of a step, with small and large counts: none sees the others' moves."""
    rng = np.random.default_rng(4)
    classes, n = class_lm.CLASSES, 200
    pairs = rng.integers(1 << 20, 1 << 21, (classes, classes))
    around = rng.integers(1, 9, (n, 2, classes)) * (rng.random((n, 2, classes)) < 0.3)
    around[::7] *= 40
    around[:, :, 0] += 1
    keys, own = np.flatnonzero(around.ravel()), rng.integers(0, classes, n)
    got = class_lm.exchanged(keys, around.ravel()[keys], own, pairs)
    assert [move_of_one(b, a, c, pairs) for (b, a), c in zip(around, own)] == got.tolist()


def test_counts_above_a_byte_take_several_entries():
    keys, counts = np.array([3, 7, 8, 90]), np.array([1, 255, 256, 100_001])
    again, small = class_lm.in_bytes(keys, counts)
    assert small.dtype == np.uint8 and small.min() > 0 and len(small) == 1 + 1 + 2 + 393
    assert np.array_equal(np.bincount(again, small)[keys], counts)
    assert [len(one) for one in class_lm.in_bytes(keys[:0], counts[:0])] == [0, 0]


def test_rare_words_with_one_ending_get_classes_of_their_own(spark):
    """Words that are met a few times each and all end alike, but of which some follow ``left`` and some ``right``."""
    rng = random.Random(6)
    kinds = [("left", [f"x{i}same" for i in range(1500)]), ("right", [f"y{i}same" for i in range(1500)])]
    rows = [(i, " ".join(f"{first} {rng.choice(words)}" for first, words in kinds * 15)) for i in range(140)]
    filler = [(1000 + i, " ".join(rng.choice("abc") for _ in range(4000))) for i in range(120)]  # makes the words rare
    units, model, _, _ = class_lm.trained(table(spark, rows + filler))
    n = Counter()
    for row in units.where("doc_id < 1000 AND train").collect():
        for at, code in enumerate(np.frombuffer(row.units, "<u2")[:60]):
            if at % 2:
                n[int(model.of_unit[code]), at // 2 % 2] += 1
    assert sum(max(n[c, 0], n[c, 1]) for c in range(class_lm.CLASSES)) > 0.8 * sum(n.values())


def test_held_out_texts_gain_over_the_base(spark):
    rows = class_lm.scored(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), rounds=4).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.9 * sum(r.base_score for r in rows)


def test_equal_rows_are_dealt_to_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "CHUNK_BYTES", 400)
    docs = table(spark, [(None, "same words again")] * 200)
    chunked, chunks = class_lm.dealt(docs)
    assert chunks == 8 and chunked.select("chunk").distinct().count() == 8
    rows = class_lm.scored(docs, rounds=2).collect()
    assert len(rows) == 200 and len({(r.n_tokens, r.n_known, r.train_tokens, round(r.score, 9)) for r in rows}) == 1


def test_language_model_of_nothing(spark):
    assert class_lm.scored(table(spark, []), rounds=1).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = class_lm.scored(table(spark, [(held, "a b")]), rounds=1).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, row.base_score)


def test_classifier(spark):
    rng = random.Random(8)
    good = [(i, prose(i, rng.randint(20, 200))) for i in range(400)]
    bad = [(400 + i, " ".join(w + "***" for w in prose(i, 80).split(" "))) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i < 400)) for i, _ in good + bad if i % 2] + [(None, 1), (1, None)], "doc_id long, quality int")
    rows = pu_classifier.scored(table(spark, good + bad + texts()[7:9]), labels).collect()
    assert len(rows) == 462 and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == (r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id >= 20 and r.doc_id < 460]
    assert sum(r.predicted == (r.doc_id < 400) for r in held) >= 0.95 * len(held)


def test_classifier_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in pu_classifier.scored(table(spark), labels).collect()} == {0.5}
    assert pu_classifier.scored(table(spark, []), labels).count() == 0


def test_pipeline(spark, tmp_path):
    docs, found = table(spark), {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, str(tmp_path))
        after.write.parquet(f"{tmp_path}/{name}")
        before = found[name] = spark.read.parquet(f"{tmp_path}/{name}")
    quality = {r.doc_id for r in found["quality_rules"].collect()}
    assert {1, 2, 3, 4, 5, 6, 13, 19} <= quality and not quality & {7, 8, 9, 10, 11, 12, 14, 15, 16}
    exact = found["exact_dedup"].collect()
    assert len(exact) == len({squeezed(r.text) for r in found["quality_rules"].collect()})
    near = {r.doc_id for r in found["near_dedup"].collect()}
    rows = [(r.doc_id, r.text) for r in exact]
    assert near == {c for _, _, c in plain_components(rows, 5)}
    for name in ("quality_rules", "exact_dedup", "near_dedup", "redact_secrets"):
        assert found[name].columns == docs.columns
    assert found["redact_secrets"].count() == len(near)
    assert secret_scan.report(found["redact_secrets"]).where("n_access > 0 OR n_hex > 0").count() == 0
    packed = found["pack_windows"]
    assert packed.agg({"length": "sum"}).first()[0] == sum(
        r.doc_tokens for r in packed.where("start = 0").collect())


def test_licences_are_linear_in_their_hits(spark):
    began = time.monotonic()
    row = license_scan.scan(table(spark, [(1, "cc by " * 100_000)])).collect()[0]
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (200_000, 100_000, 0, 199_998)
    assert time.monotonic() - began < 60


def test_near_dedup_shuffles_full_rows_once(spark):
    """Which rows stay follows from their numbers; the texts were shuffled with the groups and again with the first of each."""
    docs = table(spark, [(i, f"some words of text {i // 2} and a few more words behind them") for i in range(8)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = minhash.kept_rows(docs, 5)
        plan = spark._jvm.PythonSQLUtils.explainString(kept._jdf.queryExecution(), "formatted")
        nodes = [node for node in plan.split("\n\n") if node.lstrip().startswith("(")]
        assert sum(") Exchange" in node.split("\n")[0] and "text#" in node for node in nodes) == 1
        assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 4, 6]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
