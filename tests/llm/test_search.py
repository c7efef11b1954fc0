"""Phrase mining, token alignment and decontamination against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from helpers import prose, table, texts

from tallyforge.llm import phrases, positional_index, token_alignment, units

LOWER = {i: i + 32 for i in range(65, 91)}
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- phrases ----

def plain_phrases(rows, least, limit):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                for at in range(len(words) - size + 1):
                    f[lang, tuple(words[at:at + size])] += 1
    candidates = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    covered = {}
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                key = lang, words[at:at + size]
                covered[key] = max(covered.get(key, 0), a)
    found = defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * covered.get((lang, words), 0) >= 100 * a:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words)))
        found[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted((lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
                  for lang, some in found.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:limit], 1))


def lingual(spark, rows):
    return spark.createDataFrame([(i, lang, text, i, "clash") for i, (lang, text) in enumerate(rows)],
                                 "doc_id long, lang string, text string, n long, word string").repartition(3)


def mixed_rows():
    rng = random.Random(7)
    rows = [(lang, "".join(rng.choice(["a", "b", "c", "The", "naïve", "日本", "x" * 40]) + rng.choice([" ", " ", "\t", "  ", ". ", "\n", ";"])
                           for _ in range(300))) for lang in ("en", "en", "fr", None)]
    rows += [("en", "hot hot hot " * 400), ("fr", None), ("fr", ""), (None, " \t .,;"), ("en", "single"), ("de", "of the old kind here " * 30)]
    return rows + [rows[0], rows[0]]


@pytest.mark.parametrize("budget", [phrases.BUDGET, 60])
def test_phrases_are_the_plain_ones(spark, monkeypatch, budget):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 3000)  # many chunks
    rows = mixed_rows()
    found = phrases.top(lingual(spark, rows), least=5, limit=40, budget=budget).collect()
    assert sorted(tuple(row) for row in found) == plain_phrases(rows, 5, 40)


def test_heavy_prefixes_are_extended(spark):
    rows = [("en", "hot hot hot hot hot hot hot " * 100), ("en", "hot cold " * 50)]
    _, _, found = phrases.counts(lingual(spark, rows), least=10, budget=20)
    by = {len(row.ids) // 4: 0 for row in found.collect()}
    assert set(by) == {1, 2, 3, 4, 5}
    assert len({bytes(row.ids) for row in found.collect()}) == found.count()


def test_phrases_of_nothing(spark):
    assert phrases.top(lingual(spark, [])).count() == 0
    assert phrases.top(lingual(spark, [("en", None), ("en", "few words")])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    n, a = 10 ** 13, 10 ** 9 + 7
    one, two = bytes([1, 0, 0, 0]), bytes([2, 0, 0, 0])
    sizes = spark.createDataFrame([("en", n)], "lang string, n long")
    frequent = spark.createDataFrame([(1, "en", "x"), (2, "en", "y")], "node long, lang string, word string")
    f = {one: a + 12345, two: 3 * a, one + two: a}
    found = spark.createDataFrame([(bytearray(k), v) for k, v in f.items()], "ids binary, f long")
    row = phrases.scored(sizes, frequent, found).collect()[0]
    assert row.score == 1000 * a * n // (f[one] * f[two])


# ---- alignment ----

def plain_alignment(rows):
    tokenizer, model = units.tokenizer_of_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    bytes_a, bytes_b = units.bytes_of_ids(A), token_alignment.piece_bytes(model)
    per_document, held = [], Counter()
    for doc_id, text in rows:
        ids_a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = model.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a[i] for i in ids_a) != want or b"".join(bytes_b[i] for i in ids_b) != want:
            per_document.append((doc_id, 0, 0, [], Counter()))
            continue

        def ends(ids, table):
            at, found = 0, []
            for i in ids:
                at += len(table[i])
                found.append(at)
            return found

        ends_a, ends_b = ends(ids_a, bytes_a), ends(ids_b, bytes_b)
        common, found, low = sorted(set(ends_a) & set(ends_b)), [], 0
        for high in common:
            found.append(([i for i, e in zip(ids_a, ends_a) if low < e <= high], [i for i, e in zip(ids_b, ends_b) if low < e <= high]))
            low = high
        links = Counter((a, b) for some, others in found for a in some for b in others)
        held.update(links.keys())
        per_document.append((doc_id, len(ids_a), len(ids_b), found, links))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    result = []
    for doc_id, n_a, n_b, found, links in per_document:
        spelt = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        result.append((doc_id, n_a, n_b, len(found), sum(links.values()), sum(t for k, t in links.items() if held[k] == best[k[0]]),
                       sum(t * held[k] for k, t in links.items()), hashlib.sha256(spelt.encode()).hexdigest() if found else ""))
    return Counter(result), held


def awkward_texts():
    rows = [(i, t) for i, t in texts() if len(t or "") < 5000]
    rows += [(300 + at, text) for at, text in enumerate([
        " lead", "trail ", "a  b   c", "\n\nx \n y", "tab\tand\x0b\x0c", "▁sign", "a ▁b", "<|endoftext|> </s> <s> <0x41>", "日本語のテキスト" * 20,
        "😀😃 👩‍👩‍👧 é é", "\x00\x01", " ", "   ", "=" * 500, "ab" * 700, "no\xa0break　wide", "don't I'll we've", "x" + " " * 40 + "y",
        "\x1c\x1d a\x1eb", "  line sep \x85 nel", "ﬁ ① Ａ", "1234567890 " * 30, "﻿bom", "مرحبا بالعالم", "हिन्दी पाठ"])]
    return rows + [(400 + i, prose(40 + i, 60)) for i in range(20)]


def test_alignment_is_the_plain_one(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", 2000)
    rows = awkward_texts()
    want, held = plain_alignment(rows)
    found = token_alignment.aligned(table(spark, rows), A, B)
    assert Counter(tuple(row) for row in found.collect()) == want
    assert {(r.a, r.b): r.n_docs for r in token_alignment.links(table(spark, rows), A, B).collect()} == held


def test_groups_are_spelt(spark):
    row = token_alignment.groups(table(spark, [(1, "tokenizers overlap oddly")]), A, B).collect()[0]
    assert len(row.groups.split(";")) == row.n_groups and row.groups.count("|") == row.n_groups


def test_pointers_reach_the_end_of_long_chains():
    import numpy as np
    n = 5000  # tokens of two bytes against tokens of two bytes, one byte off
    end_a = np.array([*range(2, 2 * n + 1, 2), 2 * n + 1])
    end_b = np.array([*range(1, 2 * n + 2, 2)])
    a, b = token_alignment.jumped(np.r_[0, end_a[:-1]], end_a, np.r_[0, end_b[:-1]], end_b)
    assert set(a.tolist()) == set(b.tolist()) == {0}


def test_no_row_of_a_chunk_is_large(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    rows = [(i, " ".join(word() for _ in range(40))) for i in range(2000)] + [(2000, "again " * 500), (None, None)]
    docs = table(spark, rows).coalesce(1)
    found = token_alignment.chunked(docs, A, B).toArrow()
    assert len(set(found.column("chunk").to_pylist())) == 1
    assert max(found.slice(at, 1).nbytes for at in range(found.num_rows)) < 400_000  # what the documents are made of takes over a megabyte
    want, held = plain_alignment(rows)
    assert Counter(tuple(row) for row in token_alignment.aligned(docs, A, B).collect()) == want
    assert {(r.a, r.b): r.n_docs for r in token_alignment.links(docs, A, B).collect()} == held


def test_alignment_of_nothing(spark):
    assert token_alignment.aligned(table(spark, []), A, B).count() == 0


# ---- decontamination ----

def folded(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_hits(rows, items, width, slack):
    found = []
    for doc_id, text in rows:
        words = folded(text)
        hit, exact, near = set(), set(), set()
        where = defaultdict(set)
        for at, word in enumerate(words):
            where[word].add(at)
        for item_id, item in items:
            item = folded(item)
            if item_id is None or not item:
                continue
            span = min(width, len(item))
            for start in range(len(item) - span + 1):
                window = item[start:start + span]
                starts = {at - slack + e for at in where[window[0]] for e in range(2 * slack + 1)}
                for at in starts:
                    if words[at:at + span] == window and at >= 0:
                        hit |= set(range(at, at + span))
                        exact.add(str(item_id))
                    if all(any(at + p + e in where[word] for e in range(-slack, slack + 1)) for p, word in enumerate(window)):
                        near.add(str(item_id))
        found.append((doc_id, len(words), len(hit), len(exact), tuple(sorted(exact)), bool(hit), len(near)))
    return Counter(found)




def bench(spark, items):
    return spark.createDataFrame([(i, t, 1, "clash") for i, t in items], "item_id long, text string, n long, term string")


def search_case():
    items = [(10, prose(50, 30)), (9, prose(51, 14)), (8, "Only THREE words"), (7, "word"), (6, ""), (5, None), (None, prose(1, 40)),
             (4, "the the the the the the the the the the the the"), (3, prose(52, 10)), (3, prose(53, 12)), (2, prose(50, 30)), (1, "naïve 日本語 ünï")]
    words = prose(50, 30).split(" ")
    swapped = [*words[:4], words[5], words[4], *words[6:12]]
    rows = texts() + [
        (300, "start " + " ".join(words[3:15]) + " middle " + " ".join(words[10:22])), (301, "; ".join(words).upper()), (302, " ".join(words[:9])),
        (303, "only-three/words"), (304, "only three  x words"), (305, " ".join(swapped)), (306, "the " * 40), (307, prose(52, 10)),
        (308, prose(53, 12) + " " + prose(52, 10)), (309, "a word"), (310, "NAÏVE naïve 日本語 ünï"), (311, " ".join(words[:5] + ["x"] + words[5:12])),
        (312, " ".join(words[:11])), (313, " ".join(words[19:]))]
    rows += [(500 + i, f"copy {i} " + " ".join(words[2:20])) for i in range(40)]
    return rows, items


@pytest.mark.parametrize("slack", [0, 2])
def test_decontamination_is_the_plain_one(spark, monkeypatch, slack):
    monkeypatch.setattr(positional_index, "SEGMENT_BYTES", 4000)
    rows, items = search_case()
    found = positional_index.contamination(table(spark, rows), bench(spark, items), slack=slack).collect()
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r.item_ids), r.contaminated, r.n_near) for r in found)
    assert got == plain_hits(rows, items, 10, slack)


def test_spans_name_their_places(spark):
    words = prose(50, 30).split(" ")
    text = "lead " + " ".join(words[5:18]) + " tail"
    found = positional_index.matches(table(spark, [(1, text)]), bench(spark, [(10, " ".join(words))])).collect()
    assert [(r.doc_id, r.item_id, r.exact, r.first, r.item_first, r.n_words) for r in found] == [(1, 10, True, 1, 5, 13)]


def test_search_of_nothing(spark):
    rows, items = search_case()
    assert positional_index.contamination(table(spark, []), bench(spark, items), slack=2).count() == 0
    none = positional_index.contamination(table(spark, rows), bench(spark, [])).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)


def test_phrase_chunks_are_not_shuffled(spark, monkeypatch):
    """The words of a chunk meet its prefixes at every level and once more for the suffixes; each time they were shuffled."""
    met = []

    def watched(build):
        def run(*args):
            met.append(build(*args))
            return met[-1]
        return run

    for name in ("extended", "suffixes"):
        monkeypatch.setattr(phrases, name, watched(getattr(phrases, name)))
    docs = table(spark, [(i, "one two three four five six one two three") for i in range(12)])
    _, _, found = phrases.counts(docs, least=2, budget=8)
    assert found.where("f >= 12").count() > 9 and len(met) > 2
    for one in met:
        plan = spark._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "formatted")
        nodes = [node for node in plan.split("\n\n") if node.lstrip().startswith("(")]
        assert not [node for node in nodes if ") Exchange" in node.split("\n")[0] and "stream#" in node]
