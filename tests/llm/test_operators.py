"""Each operator on awkward rows and empty tables, against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from panelspark.llm import brown, components, decontaminate, exact, jaccard, langid, licenses, packing, repeats, simhash, store, tokencount, toxicity
from panelspark.llm.queries import tokenizer_path
from panelspark.shipping import ship
from panelspark.tables import shared_dir
from tests.llm.samples import awkward, frame, sentence

WHITE = " \t\n\x0b\x0c\r"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def joined(parent: dict, a, b) -> None:
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    x, y = root(a), root(b)
    parent[max(x, y)] = min(x, y)


def roots(parent: dict) -> dict:
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    return {x: root(x) for x in parent}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(5, 5)] + [(100 + i, 101 + i) for i in range(30)]
    parent = {x: x for p in pairs for x in p if p[0] != p[1]}
    for a, b in pairs:
        if a != b:
            joined(parent, a, b)
    got = components.components(spark.createDataFrame(pairs + pairs[:4], "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == roots(parent)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture
def many_tasks(spark):
    """Shuffles into many partitions that Spark does not merge."""
    held = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def files_by_label(spark, before=frozenset()):
    """Parquet files of each settled table that is not in ``before``."""
    base = os.path.dirname(shared_dir(spark, "x")).removeprefix("file:")
    return {d: len([f for f in os.listdir(f"{base}/{d}") if f.endswith(".parquet")]) for d in os.listdir(base) if d not in before and os.path.isdir(f"{base}/{d}")}


@pytest.mark.parametrize("file_rows", [10, 1 << 16])
def test_small_links_are_not_dealt_out(spark, many_tasks, monkeypatch, file_rows):
    # Before, each round and each short list of pairs was a file from each task.
    monkeypatch.setattr(store, "FILE_ROWS", file_rows)
    there = set(files_by_label(spark))
    chains = [(1000 * k + i, 1000 * k + i + 1) for k in range(3) for i in range(20)]
    got = components.components(spark.createDataFrame(chains, "a long, b long"), len(chains)).collect()
    assert sorted(tuple(r) for r in got) == [(1000 * k + i, 1000 * k) for k in range(3) for i in range(21)]
    w = [sentence(random.Random(k), 60) for k in range(8)]
    rows = [(10 * k + j, text + " more" * j) for k, text in enumerate(w) for j in range(3)]
    groups = jaccard.jaccard_groups(frame(spark, rows), percent=90).collect()
    assert {r.doc_id: r.component_id for r in groups} == {i: i // 10 * 10 for i, _ in rows}
    some = {d: n for d, n in files_by_label(spark, there).items() if d.startswith(("links", "small-star", "jaccard-ends", "jaccard-links", "jaccard-close", "jaccard-stars"))}
    assert len(some) > 6
    if file_rows > 10:
        assert max(some.values()) == 1


# Exact dedup


def normal(text):
    return (text or "").translate({ord(c): None for c in WHITE})


def test_exact_groups(spark):
    rows = awkward()
    got = exact.exact_groups(frame(spark, rows)).collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append((-len(t or ""), i is None, i or 0))
    want = []
    for i, t in rows:
        best = min(groups[normal(t)])
        want.append((i, None if best[1] else best[2], len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()))
    key = repr
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_filter_that_is_full_stays_exact(spark):
    rows = [(i, f"text {i % 700}") for i in range(1000)]
    got = exact.exact_groups(frame(spark, rows), filter_bytes=512).collect()
    assert all((r.keep_id, r.group_size, r.kept) == (r.doc_id % 700, 2 if r.doc_id % 700 < 300 else 1, r.doc_id < 700) for r in got)


def test_drop_copies(spark):
    rows = awkward()
    docs = frame(spark, rows)
    got = exact.drop_copies(docs)
    assert got.columns == docs.columns
    assert got.count() == len({normal(t) for _, t in rows})
    assert {normal(r.text) for r in got.collect()} == {normal(t) for _, t in rows}
    assert exact.drop_copies(docs.limit(0)).count() == 0
    assert exact.exact_groups(docs.limit(0)).count() == 0


# SimHash


def fingerprint(text, shingle):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + shingle]), seed=42) for i in range(max(1, len(w) - shingle + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("bucket", [2048, 24])
def test_near_groups(spark, bucket, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (3, 2, bucket))
    rng = random.Random(9)
    rows = [r for r in awkward() if len(r[1] or "") < 10_000]
    for k in range(12):
        w = sentence(rng, 400).split()
        for copy in range(3):
            w[rng.randrange(400)] = "other"
            rows.append((100 + 3 * k + copy, " ".join(w)))
    got = simhash.near_groups(frame(spark, rows)).collect()
    prints = [(i, fingerprint(t, 3)) for i, t in rows]
    assert sorted((repr(r.doc_id), int(r.fingerprint, 16)) for r in got) == sorted((repr(i), f) for i, f in prints)
    distinct = sorted({f for _, f in prints})
    parent = {f: f for f in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                joined(parent, a, b)
    root = roots(parent)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    assert all(r.component_id == least.get(root[int(r.fingerprint, 16)]) for r in got)
    assert len(least) < len(distinct)


def test_finer_cuts_lose_no_link(spark):
    rng = np.random.RandomState(1)
    centre = rng.randint(0, 2**62, 4)
    near = np.unique(np.concatenate([c ^ (1 << rng.randint(0, 60, 60)) ^ (1 << rng.randint(0, 12, 60)) for c in centre]))
    nodes = spark.createDataFrame([(i, int(x)) for i, x in enumerate(near)], "node long, fp0 long")
    least, few, many = (sorted(components.components(simhash.links(nodes, 3, 2, b)).collect()) for b in (3, 24, 2048))
    assert least == few == many and len({r.root for r in few}) == 4


def test_drop_near_copies(spark):
    rng = random.Random(2)
    rows, groups = [], 0
    for k in range(10):
        w = sentence(rng, 300).split()
        rows.append((10 * k, " ".join(w)))
        groups += 1
        for copy in range(1, 4):
            v = list(w)
            for _ in range(3):
                v[rng.randrange(300)] = sentence(rng, 1)
            rows.append((10 * k + copy, " ".join(v)))
    rows += [(900, None), (901, ""), (902, "  "), (903, "alone here")]
    docs = frame(spark, rows)
    got = simhash.drop_near_copies(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [10 * k for k in range(10)] + [900, 901, 902, 903]
    assert simhash.drop_near_copies(docs.limit(0)).count() == 0
    assert simhash.near_groups(docs.limit(0)).count() == 0


def kept_by_jaccard(rows, shingle=5, similarity=0.8):
    """Ids that stay, by comparing all pairs."""
    sets = {i: {tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} for i, t in rows if (w := t.split())}
    parent = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                joined(parent, a, b)
    root = roots(parent)
    return sorted(i for i in sets if root[i] == i)


def changed(words, places):
    return " ".join(f"new{k}" if k in places else w for k, w in enumerate(words))


def test_clean_documents_are_no_near_copies(spark):
    # Changed words cost five shingles each: similarities run from 0.55 to 0.9.
    rng, rows = random.Random(5), []
    for k in range(40):
        w = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, changed(w, range(7, 7 + 10 * (2 + k % 8), 10)))]
    # One word over half of all shingles makes the fingerprints of unlike texts equal.
    rows += [(k, "again " * 40 + " ".join(f"v{k}x{j}" for j in range(20))) for k in (90, 91)]
    got = sorted(r.doc_id for r in simhash.drop_near_copies(frame(spark, rows)).collect())
    want = kept_by_jaccard(rows)
    assert {90, 91} <= set(want) and got == want and len(want) < len(rows)


def test_no_near_copy_is_missed(spark):
    # Groups of two, many of them near the border.  At radius 0 fingerprints find next to nothing.
    rng, rows = random.Random(6), []
    for k in range(60):
        w = [f"w{rng.randrange(10**6)}" for _ in range(40 + 4 * (k % 20))]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, changed(w, range(7, len(w), 60 - k % 7)))]
    rows += [(200, "One two three"), (201, "one two  three"), (202, "one two three four five six"), (203, "one two three four five six seven")]
    got = sorted(r.doc_id for r in simhash.drop_near_copies(frame(spark, rows), radius=0).collect())
    assert got == kept_by_jaccard([(i, t.lower()) for i, t in rows])


@pytest.mark.parametrize("block_bytes", [300, 1000, 1 << 20])
def test_crowded_cells_lose_no_pair(spark, block_bytes):
    rng = random.Random(7)
    point = bytes([1] * 5 + [0] * 123)
    kept = [(key, node, 5, label, point) for key in range(3) for node, label in ((n, n // 3) for n in rng.sample(range(100), 12 * key + 1))]
    rows = spark.createDataFrame(kept, "key long, node long, n long, label long, point binary")
    got = [tuple(r) for r in jaccard.searched(rows, 80, block_bytes).collect()]
    want = {tuple(sorted((a[1], b[1]))) for a in kept for b in kept if a[0] == b[0] and a[3] < b[3]}
    assert set(got) == want and len(got) == len(want)


def test_crowded_buckets_tie_all_members(spark):
    # 300 prints around one centre; before, such buckets were cut until their masks ran out, and pairs were lost on the way.
    rng = np.random.RandomState(3)
    prints = {int(sum(1 << int(b) for b in rng.choice(62, 8, replace=False))) for _ in range(300)} | {0}
    nodes = spark.createDataFrame([(i, x, 0) for i, x in enumerate(sorted(prints))], "node long, fp0 long, fp1 long")
    for bucket in (3, 2048):
        assert len({r.root for r in components.components(simhash.met(nodes, 24, 8, bucket)).collect()}) == 1


# Packing


def test_fill_finds_full_bins():
    assert packing.fill({}, 10) == []
    assert packing.fill({10: 3}, 10) == [(3, [(10, 1)])]
    assert packing.fill({6: 2, 4: 2}, 10) == [(2, [(6, 1), (4, 1)])]
    # Best fit by largest first would put 7 with 3 and leave 5 and 4 apart.
    bins = packing.fill({7: 1, 3: 1, 5: 1, 4: 1, 1: 1}, 10)
    assert sum(n for n, _ in bins) == 2
    with pytest.raises(ValueError):
        packing.fill({11: 1}, 10)


def test_fill_keeps_every_piece():
    rng = random.Random(4)
    for _ in range(20):
        counts = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(rng.randint(1, 30))}
        used = collections.Counter()
        for repeat, combination in packing.fill(counts, 64):
            assert sum(n * m for n, m in combination) <= 64
            for n, m in combination:
                used[n] += repeat * m
        assert used == collections.Counter(counts)


def check_packing(rows, docs, capacity):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), capacity):
            part = np.array(ids[start : start + capacity], "<u4")
            want[i, start // capacity, start, len(part), __import__("zlib").crc32(part.tobytes())] += 1
    got = packing.pack(docs, tokenizer_path(), capacity=capacity).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r.length for r in got) // capacity)


@pytest.mark.parametrize("capacity", [2048, 7])
def test_pack(spark, capacity):
    rows = awkward()
    used, least = check_packing(rows, frame(spark, rows), capacity)
    assert used <= least + 1
    assert packing.pack(frame(spark, rows).limit(0), tokenizer_path()).count() == 0


# Language


def languages():
    rng = random.Random(8)
    rows, langs = [], []
    for lang, syllables in (("aa", "ka lo mi tu re"), ("bb", "xy zo qu wi pe"), ("cc", "éa ñu ßo üt çi")):
        for _ in range(30):
            rows.append((len(rows), sentence(rng, 60, syllables)))
            langs.append(lang)
    return rows, langs


def test_language(spark):
    rows, langs = languages()
    model = langid.train(frame(spark, rows + awkward(), langs + [None] * len(awkward())))
    assert model.languages == ["aa", "bb", "cc"]
    rng = random.Random(99)
    new = [(0, sentence(rng, 20, "ka lo mi tu re").upper()), (1, sentence(rng, 20, "xy zo qu wi pe")), (2, "éañußo!"), (3, None), (4, " 12 ; "), (5, "")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(frame(spark, new), model).collect()}
    assert [got[i][0] for i in range(6)] == ["aa", "bb", "cc", "und", "und", "und"]
    assert all(got[i][1] > 0.5 for i in range(3)) and all(got[i][1] == 0 for i in (3, 4, 5))
    many = langid.predict(frame(spark, awkward()), model).collect()
    assert len(many) == len(awkward()) and all(0 <= r.score <= 1 for r in many)
    docs = frame(spark, new)
    kept = langid.drop_unknown(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]


def test_language_backs_off_to_the_longest_known_gram(spark):
    model = langid.train(frame(spark, [(1, "abcd abcd"), (2, "wxyz")], ["p", "q"]))
    got = {r.doc_id: r.lang_pred for r in langid.predict(frame(spark, [(1, "zabcd"), (2, "wxyzabc"), (3, "dzzz")]), model).collect()}
    assert got == {1: "p", 2: "q", 3: "q"}


def test_language_with_nothing_to_learn(spark):
    model = langid.train(frame(spark, awkward()).limit(0))
    assert {(r.lang_pred, r.score) for r in langid.predict(frame(spark, awkward()), model).collect()} == {("und", 0.0)}


# Decontamination


def test_decontamination(spark):
    rng = random.Random(6)
    items = [(k, sentence(rng, 30)) for k in range(8)] + [(90, None), (91, ""), (92, "too short"), (3, None)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    w = items[0][1].split()
    changed = [x if i % 7 else "swapped" for i, x in enumerate(w)]
    rows = [
        (1, sentence(rng, 50) + " " + items[1][1].upper() + "! " + sentence(rng, 9)),
        (2, sentence(rng, 50) + " " + " ".join(changed) + " " + sentence(rng, 9)),
        (3, sentence(rng, 500)),
        (4, items[2][1].replace(" ", "%%% ")),
        (5, " ".join(items[4][1].split()[5:17])),
        (6, items[5][1] + " . " + items[6][1]),
        *[(100 + (i or 0), t) for i, t in awkward()],
    ]
    docs = frame(spark, rows)
    for block_chars in (16 << 20, 200):
        got = decontaminate.contaminated(docs, bench, block_chars=block_chars).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 0), (4, 2), (5, 4), (6, 5), (6, 6)]
        by = {(r.doc_id, r.item_id): r for r in got}
        assert by[1, 1].coverage == 1 and by[1, 1].start == 50 and by[1, 1].end == 80
        assert 0.8 <= by[2, 0].identity < 1
        assert (by[5, 4].item_start, by[5, 4].item_end, by[5, 4].matched) == (5, 17, 12)
        kept = decontaminate.drop_contaminated(docs, bench, block_chars=block_chars)
        assert kept.columns == docs.columns
        assert kept.count() == len(rows) - 5
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("mask", range(len(decontaminate.MASKS)))
def test_masks_ignore_the_positions_they_leave_out(mask):
    word = decontaminate.MASKS[mask]
    tok = np.arange(1, len(word) + 1, dtype=np.uint64)
    bounds = np.array([0, len(word)])
    base = decontaminate.seeds(tok, bounds, mask)[0]
    for i, c in enumerate(word):
        other = tok.copy()
        other[i] = 999
        assert (decontaminate.seeds(other, bounds, mask)[0] == base).all() == (c == "0")


# Licenses


def test_licenses(spark):
    rng = random.Random(7)
    mit = licenses.TEMPLATES["MIT"][2]
    part = " ".join(mit.split()[:50])
    gappy = mit.replace("free of charge, ", "").replace("software", "program", 1)
    rows = [
        (1, sentence(rng, 40) + "\nReleased under the MIT License.\n" + sentence(rng, 40)),
        (2, sentence(rng, 40) + " RELEASED under the (MIT) license; and licensed under CC BY-NC 4.0"),
        (3, sentence(rng, 40) + gappy),
        (4, part[: len(part) // 2]),
        (5, "This work is licensed under the GNU General Public License, version 3."),
        *[(100 + (i or 0), t) for i, t in awkward()],
    ]
    got = licenses.find_licenses(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(1, "MIT"), (2, "CC-BY-NC-4.0"), (2, "MIT"), (3, "MIT"), (5, "GPL-3.0")]
    by = {(r.doc_id, r.license): r for r in got}
    assert rows[0][1][by[1, "MIT"].start : by[1, "MIT"].end] == "Released under the MIT License"
    assert 0.8 <= by[3, "MIT"].coverage < 1
    assert licenses.find_licenses(frame(spark, rows).limit(0)).count() == 0


def test_alignment_in_a_band():
    assert licenses.align([1, 2, 3, 4, 5, 6], [9, 1, 2, 8, 3, 4, 6, 7], 1, 3) == (5, 1, 7)
    assert licenses.align([1, 2], [], 0, 3) == (0, -1, -1)


# Repeated strings


def removed(rows, length):
    seen = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((repr(i), len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("crowd, chunk", [(8192, 16384), (2, 16384), (8192, 3)])
def test_repeats(spark, crowd, chunk, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    rng = random.Random(12)
    passage, other = sentence(rng, 90), sentence(rng, 60)
    rows = [(i, t) for i, t in awkward() if len(t or "") < 20_000]
    for k in range(25):
        w = passage.split()
        if k % 3:
            w[rng.randrange(len(w))] = "x" * rng.randint(1, 5)
        rows.append((200 + k, sentence(rng, rng.randint(0, 40)) + " " + " ".join(w) + " " + sentence(rng, rng.randint(0, 40)) + (other if k % 5 == 0 else "")))
    rows += [(300, "ab" * 400), (301, "y" * 199), (302, "y" * 199), (303, "z" * 200), (304, "z" * 201), (305, "é" * 150)]
    got = repeats.remove_repeats(frame(spark, rows), length=200, crowd=crowd).collect()
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == removed(rows, 200)
    assert all(len(r.spans) == r.n_spans for r in got)


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(frame(spark, awkward()).limit(0)).count() == 0
    only = repeats.remove_repeats(frame(spark, [(1, None), (2, "")])).collect()
    assert {(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in only} == {(0, 0, 0, hashlib.sha256(b"").hexdigest())}


def test_merge_marks_equal_stretches():
    rng = np.random.RandomState(3)
    rows = rng.randint(0, 2, (40, 12)).astype(np.uint8)
    group = np.repeat([0, 1, 2, 3], 10)
    marks = repeats.merge(rows, group, 5)
    for r in range(40):
        for c in range(8):
            same = [o for o in range(40) if o != r and group[o] == group[r] and (rows[o, c : c + 5] == rows[r, c : c + 5]).all()]
            assert marks[r, c] == bool(same)


# Token counts


@pytest.mark.parametrize("block, step", [(1 << 16, 1024), (5, 2)])
def test_token_counts(spark, block, step, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokencount, "STEP", step)
    rows = [(i, t) for i, t in awkward() if len(t or "") < 5_000] + [(50, "<|endoftext|> is spelt out")]
    path = shared_dir(spark, "flat-test")
    tokencount.write_flat(frame(spark, rows), tokenizer_path(), path, 49407, rows_per_file=5)
    got = tokencount.count_tokens(tokencount.read_blocks(spark, path, 49407, block)).collect()
    plain = Tokenizer.from_file(tokenizer_path())
    plain.encode_special_tokens = True
    assert sorted(r.n_tokens for r in got) == sorted(len(plain.encode(t or "", add_special_tokens=False).ids) for _, t in rows)
    assert not any(r.open for r in got)
    files = collections.defaultdict(list)
    for r in got:
        files[r.file].append((r.document, r.start, r.n_tokens))
    assert len(files) > 1
    for docs in files.values():
        at = 0
        for k, (document, start, n) in enumerate(sorted(docs)):
            assert (document, start) == (k, at)
            at += n + 1


def test_files_have_numbers_of_their_own(spark):
    names = ["part-00003-0a-c12e-4f00-c4a1-aa-c000.txt", "part-00003-0a-c12e-4f00-c4a1-aa-c001.txt", "part-00012-c9-c002.txt.gz", "tokens.bin"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.file for r in df.select("name", tokencount.file_number("name").alias("file")).collect()}
    assert [got[n] for n in names[:3]] == [3_000_000, 3_000_001, 12_000_002] and len(set(got.values())) == 4


def test_token_counts_of_open_and_empty_files(spark):
    rows = [(1, 0, 0, 4, [2]), (1, 1, 4, 3, []), (2, 0, 0, 2, []), (3, 0, 0, 3, [0, 1, 2])]
    blocks = spark.createDataFrame(rows, "file long, block long, start long, tokens long, ends array<long>")
    got = sorted(tuple(r) for r in tokencount.count_tokens(blocks).collect())
    assert got == [(1, 0, 0, 2, False), (1, 1, 3, 4, True), (2, 0, 0, 2, True), (3, 0, 0, 0, False), (3, 1, 1, 0, False), (3, 2, 2, 0, False)]
    assert tokencount.count_tokens(blocks.limit(0)).count() == 0


# Brown classes


def test_brown_scores(spark):
    rows, _ = languages()
    train, new = rows[::2], rows[1::2] + awkward()
    shape = brown.Shape(units=8, buckets=16, classes=6, held_words=5)
    model, counts = brown.train(frame(spark, train + awkward()), shape=shape)
    count = collections.Counter(w for _, t in train + awkward() for w in [*(t or "").encode().lower().split(), None])
    total, kinds = sum(count.values()), len(count)
    assert (model.tokens, model.types) == (total, kinds)
    got = brown.score(frame(spark, new), model, counts).collect()

    def base(t):
        w = [*(t or "").encode().lower().split(), None]
        return len(w), sum(count[x] > 0 for x in w), sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w)

    want = sorted((repr(i), *base(t)) for i, t in new)
    for (i, n, known, b), r in zip(want, sorted(got, key=lambda r: (repr(r.doc_id), r.n_tokens, r.n_known, r.base_score))):
        assert (repr(r.doc_id), r.n_tokens, r.n_known, r.train_tokens) == (i, n, known, total)
        assert r.base_score == pytest.approx(b) and r.score < 0
    mine = [r for r in got if r.doc_id is not None and r.doc_id > 20]
    assert sum(r.score for r in mine) > sum(r.base_score for r in mine)


def test_brown_probabilities_add_up(spark):
    """Over all known words and one unseen word for each class, what may follow an end has a probability of one."""
    rows, _ = languages()
    shape = brown.Shape(units=8, buckets=16, classes=6, held_words=1000)
    model, counts = brown.train(frame(spark, rows), shape=shape)
    known = counts.collect()
    keys = np.array([r.key for r in known], np.int64).view(np.uint64)
    n = np.array([r.n for r in known])
    cls = model.cls[brown.unit_of(keys, model.unit_keys, shape.buckets)]
    before = model.cls[brown.unit_of(np.array([brown.END]), model.unit_keys, shape.buckets)][0]
    within = np.bincount(cls, (n - model.off[cls]) / model.size[cls], 6)
    some = np.bincount(cls, minlength=6) > 0
    unseen = 10 ** model.unseen / model.size
    assert (within + unseen)[some] == pytest.approx(np.ones(some.sum()))
    assert (10 ** model.move[before]).sum() == pytest.approx(1)


def test_exchange_finds_alternating_classes():
    # Units 1-3 and 4-6 take turns; whatever the beginning, they end up apart.
    pairs = np.zeros((7, 7), int)
    for a in (1, 2, 3):
        for b in (4, 5, 6):
            pairs[a, b] = pairs[b, a] = 10 + a + b
    pairs[0, 1] = pairs[4, 0] = 1
    cls = brown.exchange(pairs, 3, 0)
    assert cls[0] == 0 and len({*cls[1:4]}) == 1 and len({*cls[4:]}) == 1 and cls[1] != cls[4]


def test_brown_without_training(spark):
    model, counts = brown.train(frame(spark, awkward()).limit(0))
    got = brown.score(frame(spark, awkward()), model, counts).collect()
    assert len(got) == len(awkward()) and all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in got)


# Toxicity


def test_toxicity(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(240):
        words = sentence(rng, 40).split()
        toxic, bad = i % 4 == 0, i % 3 == 0
        if toxic:
            words[5:8] = [rng.choice(["vilest", "villain", "nastiness"]) for _ in range(3)]
        if bad:
            words[20:24] = ["spammy"] * 4
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad), int(toxic)))
    given = spark.createDataFrame(labels + [(None, 1, 1), (5, None, 1), (999, 0, 0)], "doc_id long, bad int, toxic int")
    docs = frame(spark, rows + awkward())
    chain = toxicity.train(docs.filter("doc_id is null or doc_id % 5 <> 1"), given, ["bad", "toxic"], size=1 << 12)
    assert [len(e) for e in chain.earlier] == [0, 1]
    got = toxicity.predict(docs, chain)
    assert got.count() == len(rows) + len(awkward())
    p = {r.doc_id: r for r in got.collect()}
    held = [i for i in range(240) if i % 5 == 1 and i not in {x for x, _ in awkward()}]
    assert sum((p[i].toxic_probability > 0.5) == (i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert sum((p[i].bad_probability > 0.5) == (i % 3 == 0) for i in held) >= 0.95 * len(held)


def test_best_threshold():
    truth = np.array([1.0, 1, 0, 1, 0, 0])
    assert toxicity.best_threshold(truth, np.array([0.9, 0.8, 0.3, 0.7, 0.2, 0.1])) == pytest.approx(0.5)
    assert toxicity.best_threshold(truth, np.array([0.4] * 6)) == pytest.approx(0.2)
    assert toxicity.best_threshold(np.zeros(3), np.array([0.1, 0.2, 0.3])) == 0.5


def test_toxicity_of_one_value(spark):
    docs = frame(spark, awkward())
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    for given in (labels, labels.limit(0)):
        chain = toxicity.train(docs, given, ["toxic"], size=64)
        assert max(r.toxic_probability for r in toxicity.predict(docs, chain).collect()) < 1e-6


# Language counts


def test_kept_words_have_the_counts_of_all_languages(spark):
    rows = [(1, "pain " * 6 + "water " * 3, "en"), (2, "eau " * 9 + "pain " * 4 + "water", "fr")]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), words=1)
    logs = model.tables[0][1]
    # One word of each language is kept: pain (6 of 9, 4 of 14) and eau (0 of 9, 9 of 14).
    want = [[math.log((n + 0.5) / (t + 0.5 * 3)) for n, t in zip(ns, (9, 14))] for ns in ((6, 4), (0, 9))]
    assert np.allclose(sorted(logs.tolist()), sorted(want), atol=1e-5)


def test_toxicity_chain_equals_brute_force(spark):
    """The fitted chain against dense descents over the same rows, and every probability against the formula."""
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in "abcdef" for b in "ghij"]
    texts, labels = [], []
    for i in range(240):
        picked = rng.choice(words, 12)
        texts.append((i, " ".join(picked)))
        bad = int(sum(w[0] in "ab" for w in picked) + rng.normal() > 4.5)
        labels.append((i, bad, int(sum(w[1] == "g" for w in picked) + bad + rng.normal() > 4)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    chain = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, bad int, toxic int"), ["bad", "toxic"], size=1 << 12, penalty=1e-2)
    got = {r.doc_id: r for r in toxicity.predict(docs, chain).collect()}
    key = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64("doc_id")).collect()}
    vocabulary = sorted({w for _, t in texts for w in t.split()})
    counts = np.array([[t.split().count(w) for w in vocabulary] for _, t in texts])
    x = np.log1p(counts) * np.log((len(texts) + 1) / (counts > 0).sum(axis=0))
    x /= np.sqrt((x**2).sum(axis=1, keepdims=True))
    fold = np.array([key[i] % 3 for i, _ in texts])

    def fit(x, y):
        w = np.zeros(x.shape[1] + 1)
        x = np.c_[x, np.ones(len(x))]
        for _ in range(60):  # Newton
            p = 1 / (1 + np.exp(-x @ w))
            ridge = np.append(np.full(len(w) - 1, 1e-2), 0)
            w -= np.linalg.solve((x.T * (p * (1 - p))) @ x / len(x) + np.diag(ridge), x.T @ (p - y) / len(x) + ridge * w)
        return w

    def judge(x, w):
        return 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))

    learnt, asked = x, x
    for k, name in enumerate(["bad", "toxic"]):
        y = np.array([row[k + 1] for row in labels], float)
        want = judge(asked, fit(learnt, y))
        found = np.array([got[i][f"{name}_probability"] for i, _ in texts])
        assert np.abs(found - want).max() < 5e-3
        unseen = np.zeros(len(y))
        for f in range(3):
            unseen[fold == f] = judge(learnt[fold == f], fit(learnt[fold != f], y[fold != f]))
        assert chain.thresholds[k] == pytest.approx(toxicity.best_threshold(y, unseen), abs=2e-2)
        learnt, asked = np.c_[learnt, unseen], np.c_[asked, want]
