"""The registered queries and the pipeline on the smallest tables, against SQL or brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import re
import zlib

import pytest

import __spark_entry__
import corpus_pipeline
from panelspark.llm import queries, simhash
from panelspark.llm.store import settle
from tests.llm.test_operators import WHITE, check_packing, fingerprint, joined, kept_by_jaccard, normal, removed, roots
from tests.oracle import compare, connect

ROOT = os.environ.get("PANELSPARK_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()]


def ascii_lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def crc(i, of):
    return zlib.crc32(str(i).encode()) % of


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_sql(spark, name):
    assert compare(spark, connect(ROOT), queries.runners()[name], queries.oracles()[name], ROOT) == ""


def test_scores(spark, docs):
    count = collections.Counter(w for i, t, _ in docs if crc(i, 7) != 2 for w in [*(t or "").encode().lower().split(), None])
    total, kinds = sum(count.values()), len(count)
    got = {r.doc_id: r for r in queries.op1_brown_score(spark, ROOT).collect()}
    assert len(got) == len(docs)
    for i, t, _ in docs:
        w = [*(t or "").encode().lower().split(), None]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(i, 7) == 2, len(w), sum(count[x] > 0 for x in w), total)
        assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_decontamination(spark, docs):
    def plain(t):
        return " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "

    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()}
    texts = {i: plain(t) for i, t, _ in docs}
    want = {(i, j) for j, y in items.items() for i, x in texts.items() if y in x}
    got = queries.op2_decontamination(spark, ROOT).collect()
    assert want <= {(r.doc_id, r.item_id) for r in got}
    for r in got:
        own, test = texts[r.doc_id].split()[r.start : r.end], items[r.item_id].split()[r.item_start : r.item_end]
        assert sum(a == b for a, b in zip(own, test, strict=True)) == r.matched >= max(10, 0.8 * len(own))


def test_repeated_strings(spark, docs):
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op3_repeated_strings(spark, ROOT).collect())
    assert got == removed([(i, t) for i, t, _ in docs], 200)


def test_languages(spark, docs):
    got = {r.doc_id: r for r in queries.op4_language_id(spark, ROOT).collect()}
    assert all(got[i].held_out == (crc(i, 4) == 2) for i, _, _ in docs)
    held = [(i, g) for i, _, g in docs if got[i].held_out]
    assert sum(got[i].lang_pred == g for i, g in held) >= 0.97 * len(held)


def test_toxicity(spark, docs):
    got = {r.doc_id: r for r in queries.op6_toxicity(spark, ROOT).collect()}
    assert len(got) == len(docs)
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()]
    assert sum(got[i].toxic == bool(t) for i, t in labels) >= 0.9 * len(labels)


def test_licenses(spark, docs):
    lines = {"GPL-3.0": "GNU General Public License, version 3", "CC-BY-NC-4.0": "CC BY-NC 4.0", "MIT": "MIT License", "Apache-2.0": "Apache License, Version 2.0"}
    want = collections.Counter((i, name) for i, t, _ in docs for name, line in lines.items() for _ in re.findall(re.escape(line), t or "", re.I))
    assert collections.Counter((r.doc_id, r.license) for r in queries.op7_license_scan(spark, ROOT).collect()) == want


def test_near_dedup(spark, docs):
    got = queries.op8_simhash_near_dedup(spark, ROOT).collect()
    prints = {i: fingerprint(t, 3) for i, t, _ in docs}
    parent = {i: i for i in prints}
    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                joined(parent, a, b)
    assert sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got) == sorted((i, prints[i], r) for i, r in roots(parent).items())


def test_token_counts(spark, docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    plain.encode_special_tokens = True
    want = sorted(len(plain.encode(t or "", add_special_tokens=False).ids) for _, t, _ in docs)
    assert sorted(r.n_tokens for r in queries.op9_token_counts(spark, ROOT).collect()) == want


def test_pipeline_stages(spark, docs):
    """Each stage on what the one before it kept."""
    given = {i: t for i, t, _ in docs}
    frame = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns = frame.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = settle(stage(spark, frame, ROOT), "test-stage")
        assert frame.columns == columns
        kept[name] = {r.doc_id for r in frame.collect()}
    assert kept["language ID"] == {i for i, t in given.items() if t and any(c.isalpha() for c in t)}
    best = {}
    for i in kept["language ID"]:
        key = normal(given[i])
        best[key] = min(best.get(key, (math.inf,)), (-len(given[i]), i))
    assert kept["exact dedup"] == {i for _, i in best.values()}
    assert sorted(kept["SimHash near-dedup"]) == kept_by_jaccard([(i, ascii_lower(given[i])) for i in kept["exact dedup"]])
    assert kept["SimHash near-dedup"] < kept["exact dedup"]
    hit = {r.doc_id for r in queries.op2_decontamination(spark, ROOT).collect()}
    assert kept["benchmark decontamination"] == kept["SimHash near-dedup"] - hit
    used, least = check_packing([(i, given[i]) for i in kept["benchmark decontamination"]], frame, 2048)
    assert used <= least + 1
    assert {r.doc_id for r in corpus_pipeline.run(spark, ROOT).select("doc_id").collect()} == kept["benchmark decontamination"]


def test_white_space_of_the_sql():
    assert hashlib.sha256(normal("a" + WHITE + "b").encode()).hexdigest() == hashlib.sha256(b"ab").hexdigest()
    assert simhash.SEED == 42
