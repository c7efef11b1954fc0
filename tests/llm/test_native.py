"""Quality ledger, shards, exact deduplication and secrets against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from helpers import SPACE, squeezed, table, texts
from pyspark.sql import functions as F

from tallyforge.llm import quality_ledger, secret_scan, shards, stream_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for at in range(len(words) - 2):
        if windows[tuple(words[at:at + 3])] > 1:
            inside |= {at, at + 1, at + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def test_measurements(spark):
    rows = quality_ledger.ledger(table(spark)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == sorted((str(i), *measures(t or "")) for i, t in texts())
    for r in rows:
        few, repeated = r.n_words < 50, 100 * r.n_repeat_words > 50 * r.n_words
        assert bool(r.failed & quality_ledger.BASE_MASK) == (few or repeated)


def test_kept_rows_keep_clashing_columns(spark):
    docs = table(spark)
    kept = quality_ledger.kept_rows(docs, "prose-1")
    assert kept.columns == docs.columns
    assert {r.n_words for r in kept.collect()} == {5}
    ids = {r.doc_id for r in kept.collect()}
    assert {1, 4, 5, 13, 19} <= ids and not ids & {7, 8, 9, 10, 14, 15, 16}


def test_ablations(spark):
    entries = quality_ledger.ledger(table(spark))
    masks = [r.failed for r in entries.collect()]
    for row in quality_ledger.ablations(entries).collect():
        fatal, bit = quality_ledger.POLICIES[row.policy], quality_ledger.BIT[row.rule]
        assert row.kept == sum(not m & fatal for m in masks)
        assert row.kept_without == sum(not m & fatal & ~bit for m in masks)
        assert row.failing == sum(bool(m & bit) for m in masks)
        assert row.failing_only_this == sum(m & fatal == bit for m in masks)


def test_ablations_of_nothing(spark):
    rows = quality_ledger.ablations(quality_ledger.ledger(table(spark, []))).collect()
    assert rows and all(r.kept == 0 and r.failing == 0 for r in rows)


def test_shards(spark):
    rows = shards.shard(table(spark), 4).collect()
    sizes = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sizes
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.shard, r.slot)):
        by[r.shard].append(r)
    order = []
    for n in sorted(by):
        assert [r.slot for r in by[n]] == list(range(len(by[n])))
        order += [math.inf if r.doc_id is None else r.doc_id for r in by[n]]
    assert order == sorted(order)
    total, largest = sum(s for _, s, _ in sizes), max(s for _, s, _ in sizes)
    assert all(abs(sum(r.size for r in part) - total / 4) <= largest for part in by.values())


def test_shards_of_nothing(spark):
    assert shards.shard(table(spark, [])).count() == 0


def plain_groups(rows):
    found = defaultdict(list)
    for at, (i, t) in enumerate(rows):
        found[squeezed(t)].append((-len(t or ""), i is None, i if i is not None else 0, at))
    return found


@pytest.mark.parametrize("batch_bytes", [stream_dedup.BATCH_BYTES, 1])
def test_exact_groups(spark, batch_bytes):
    rows = stream_dedup.groups(table(spark), batch_bytes=batch_bytes).collect()
    check_groups(rows)


def check_groups(rows):
    groups, ids = plain_groups(texts()), defaultdict(list)
    for i, t in texts():
        ids[i].append(squeezed(t))
    kept = Counter()
    for r in rows:
        key = next(k for k in ids[r.doc_id] if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
        members = groups[key]
        best = min(members)
        assert r.group_size == len(members)
        assert r.keep_id == (None if best[1] else best[2])
        kept[key] += r.kept
    assert set(kept.values()) == {1} and len(rows) == len(texts())


def test_rows_that_share_a_digest_but_not_the_text(spark):
    weak = lambda text: F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 1)
    check_groups(stream_dedup.groups(table(spark), digest=weak).collect())


def test_kept_rows_and_nothing(spark):
    docs = table(spark)
    kept = stream_dedup.kept_rows(docs)
    assert kept.columns == docs.columns and kept.count() == len(plain_groups(texts()))
    assert stream_dedup.kept_rows(table(spark, [])).count() == 0
    assert stream_dedup.groups(table(spark, [])).count() == 0


PATTERNS = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 20),
    ("hex", re.compile("[0-9a-f]+"), 24),
)


def entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def plain_spans(text):
    found = []
    for kind, pattern, least in PATTERNS:
        for m in pattern.finditer(text):
            if len(m.group(2) if kind == "assign" else m.group()) >= least:
                found.append((m.start(), secret_scan.KINDS.index(kind), m.end()))
    w = secret_scan.WINDOW
    for m in re.finditer(secret_scan.CANDIDATE, text):
        run = m.group()
        if any(re.search(p, run) for p in secret_scan.ALLOWED) or not re.search("[0-9]", run) or not re.search("[A-Za-z]", run):
            continue
        kind = "entropy_hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", run) else "entropy_base64"
        last = None
        for at in range(len(run) - w + 1):
            if entropy(run[at:at + w]) >= secret_scan.LIMITS[kind]:
                if last and m.start() + at <= last[2]:
                    last[2] = m.start() + at + w
                else:
                    last = [m.start() + at, secret_scan.KINDS.index(kind), m.start() + at + w]
                    found.append(last)
    return sorted(tuple(f) for f in found)


def test_spans(spark):
    more = [(300, "key " + "aB3xQ9z7Lm2Pq8Rt5Vw1" * 3 + " and " + "a1" * 30), (301, "x" * 19 + "1"), (302, "9fK2" * 12),
            (303, "00112233445566778899aabbccddeeff0f1e2d3c4b5a" * 2), (304, "q7Wm3Rz9Kx5Tb1Yc8Nd2 0a1b2c3d4e5f6a7b8c9d0e1f")]
    rows = secret_scan.report(table(spark, texts() + more)).collect()
    want = Counter()
    for i, t in texts() + more:
        spans = plain_spans(t or "")
        said = lambda some: ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in some)
        base = said([s for s in spans if s[1] < 3])
        want[i, *[sum(s[1] == k for s in spans) for k in range(3)], hashlib.sha256(base.encode()).hexdigest(), said(spans)] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in rows) == want
    assert any("entropy_base64" in r.spans for r in rows)


def test_redaction(spark):
    docs = table(spark)
    out = secret_scan.redacted(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    want = Counter()
    for i, t in texts():
        done, upto = "", 0
        for a, _, b in plain_spans(t or ""):
            if a >= upto:
                done += (t or "")[upto:a] + "[SECRET]"
            upto = max(upto, b)
        new = t if not plain_spans(t or "") else done + t[upto:]
        want[i, new, len(new or "")] += 1
    assert Counter((r.doc_id, r.text, r.n_chars) for r in out.collect()) == want
    assert secret_scan.redacted(table(spark, [])).count() == 0 and SPACE


def covered(spans, begin, end):
    """Characters from begin to end that lie in a span."""
    places = {at for s in spans.split(",") if s for at in range(int(s.split(":")[1]), int(s.split(":")[2]))}
    return len(places & set(range(begin, end)))


def test_joined_and_sampled_keys(spark):
    upper, mixed, short = "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B", "9f86D081884c7D659a2feAA0c55aD015a3Bf4F1b", "9f86d081884c7d659a2f"
    key = "q7Wm3Rz9Kx5Tb1Yc8Nd2Lp6Vf4Hj0Gs"
    heads = [("sig=", upper), ("build-", mixed), ("/hash/", upper), ("id_", short), ("0x", upper), ("/example/v1/", key), ("sample=", upper)]
    rows = [(at, f"see {head}{secret} end") for at, (head, secret) in enumerate(heads)]
    ssh = "b3BlbnNzaC1rZXktdjEAAAAABG5vbmUAAAAEbm9uZQAAAAAAAAABAAAAMwAAAAtzc2gtZWQyNTUxOQAAACD" + key
    image = "iVBORw0KGgo" + key * 3
    rows += [(50, ssh), (51, image), (52, "x-" + "0123456789abcdef" * 2)]
    spans = {r.doc_id: r.spans for r in secret_scan.report(table(spark, rows)).collect()}
    for at, (head, secret) in enumerate(heads):
        assert covered(spans[at], 4 + len(head), 4 + len(head) + len(secret)) == len(secret), head
    assert covered(spans[50], len(ssh) - len(key), len(ssh)) == len(key)
    assert "entropy" not in spans[51] and "entropy" not in spans[52]
    out = {r.doc_id: r.text for r in secret_scan.redacted(table(spark, rows)).collect()}
    assert not any(secret in out[at] for at, (_, secret) in enumerate(heads))


def test_a_repeated_opening_line_drops_no_text(spark, tmp_path):
    long = [" ".join(f"{w}{seed}" for w in "abcdefghijklmnopqrstuvwxyz") for seed in range(4)]
    rows = [(1, "\n".join(["An opening line", long[0] + " " + long[1], "An opening line", long[2]])), (2, "\n".join([long[0], long[1]] * 2)),
            (3, "\n".join(["Opening", "Opening", long[0] + " " + long[1] + " " + long[2]]))]
    kept = corpus_pipeline.quality_rules(spark, table(spark, rows), str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == {1, 3}


def test_clean_training_documents_pass_the_line_rule(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1 AND crc32(encode(cast(doc_id AS string), 'UTF-8')) % 5 <> 0")
    clean = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    bits, rest = quality_ledger.BIT, quality_ledger.POLICIES["prose-2"] & ~quality_ledger.BIT["duplicate_text"]
    failed = [r.failed for r in quality_ledger.ledger(clean).select("failed").collect()]
    assert len(failed) > 100 and not [f for f in failed if f & bits["duplicate_text"] and not f & rest]
    assert [f for f in failed if f & bits["duplicate_lines"] and not f & rest]  # as prose-1 did


def test_secrets_in_very_long_runs(spark):
    path, token = "ab/" * 100_000 + "end", "x7Gq9Lm2Zp4Rt8Vw1Yb3Nc6Kd5Jf0Hs"
    rows = [(1, path), (2, "see " + path + " and " + token), (3, "a-b" * 50_000 + " " + "k" * 200_000), (4, "/" + "ab/" * 30), (5, "usr/lib//x/y/z/aa/bb/cc")]
    found = {r.doc_id: r.found for r in secret_scan.scan(table(spark, rows)).collect()}
    assert found[1] == [] and found[4] == [] and found[5] == []
    assert [s.start for s in found[2]] == [len("see " + path + " and ")]
