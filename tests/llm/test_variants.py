"""Conversation repair, spelling variants and the Jaccard join against brute force, on awkward rows and on the smallest tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest

from panelspark.llm import dialogue, jaccard, queries, spelling
from panelspark.llm.store import settle
from panelspark.shipping import ship
from tests.llm.samples import awkward, frame, sentence
from tests.llm.test_operators import joined, roots

ROOT = os.environ.get("PANELSPARK_TESTDATA", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(ROOT), reason="test tables are not mounted")
WHITE = " \t\n\x0b\x0c\r"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


# Conversation repair

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """(cost, audit) of rows (initial, must go, truncated): for every end state the least cost and then the least string, row by row."""

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                for initial in "ua":
                    to = STEPS.get((state, initial))
                    if to is not None:
                        best[to] = min(best.get(to, (1 << 60, "")), (cost + 5, audit + "I"))
        return best

    best = {"": (0, "")}
    for initial, goes, truncated in rows:
        after = {}
        for state, (cost, audit) in inserted(best).items():
            options = [(state, 2, "D")]
            if not goes:
                options += [(STEPS.get((state, x)), 1 + 5 * truncated, "R") for x in "ua"] + [(STEPS.get((state, initial)), 5 * truncated, "K")]
            for to, more, edit in options:
                if to is not None:
                    after[to] = min(after.get(to, (1 << 60, "")), (cost + more, audit + edit))
        best = after
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def exhaustive(rows):
    """The same by trying every edit of every row and up to two inserts at each place."""
    found = []
    gaps = ["", "u", "a", "ua", "au"]
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product("DKR", repeat=len(rows)):
            if any(goes and e != "D" for e, (_, goes, _) in zip(edits, rows)):
                continue
            for names in itertools.product("ua", repeat=edits.count("R")):
                given = iter(names)
                roles, audit, cost = inserts[0], "I" * len(inserts[0]), 5 * len(inserts[0])
                for e, (initial, _, truncated), more in zip(edits, rows, inserts[1:]):
                    roles += ("" if e == "D" else initial if e == "K" else next(given)) + more
                    cost += {"D": 2, "K": 5 * truncated, "R": 1 + 5 * truncated}[e] + 5 * len(more)
                    audit += e + "I" * len(more)
                if GRAMMAR.match(roles):
                    found.append((cost, audit))
    return min(found)


def symbols(rows):
    """Runs of the operator's symbols."""
    runs = []
    for initial, goes, truncated in rows:
        symbol = initial if initial in ("s", "u", "a") else "", dialogue.GOES if goes else dialogue.TRUNCATED if truncated else dialogue.OK
        if runs and runs[-1][0] == symbol:
            runs[-1] = symbol, runs[-1][1] + 1
        else:
            runs.append((symbol, 1))
    return runs


def test_plans_of_every_short_conversation():
    kinds = [(i, False, t) for i in "suax" for t in (False, True)] + [("u", True, False)]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            assert dialogue.plan(symbols(rows)) == exhaustive(rows) == cheapest(rows)


def test_plans_of_long_runs():
    rng = random.Random(11)
    for _ in range(300):
        rows = []
        for _ in range(rng.randint(0, 6)):
            rows += [(rng.choice("suaax"), rng.random() < 0.2, rng.random() < 0.3)] * rng.choice([1, 1, 2, 3, 7, 40])
        assert dialogue.plan(symbols(rows)) == cheapest(rows)
    runs = [(("u", dialogue.OK), 100_001), (("a", dialogue.TRUNCATED), 3)]
    cost, audit = dialogue.plan(runs)
    assert audit.count("D") + audit.count("R") + audit.count("K") == 100_004 and cost == cheapest([("u", False, False)] * 100_001 + [("a", False, True)] * 3)[0]


def md5(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def repaired(table):
    """The query's rows by brute force, from (conv, turn, role, text)."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in table:
        rows = convs[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], md5(r[1], r[2])))
        seen, marks, faults = set(), [], collections.Counter()
        for _, role, text in rows:
            end = text.rstrip(WHITE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            marks.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        cost, audit = cheapest(marks)
        said, state, left = [], "", iter(rows)
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[1:]
            if edit == "D":
                continue
            if edit in "IR":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            said.append(f"{role}:{text}")
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


SPOKEN = "conv_id long, turn long, role string, text string, conv string, head int, digest string, gone string"


def spoken():
    rng = random.Random(3)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 20]), role, rng.choice(["Yes.", "No!", "so", " ", "", None, f"Text {turn}?", "né. \n"])))
    rows += [(77, 1, "user", "Again.")] * 5 + [(78, t, ("assistant", "user")[t % 2], f"Row {t}.") for t in range(3000)]
    rows += [(79, t, "user", sentence(rng, 4000) + ".") for t in range(3)]
    return rows


def repair(rows):
    planned = settle(dialogue.plans(rows), "test-plans")
    return planned, sorted((tuple(r) for r in dialogue.digests(rows, planned).select("conv", *dialogue.RESULTS, "audit", "repaired_sha256").collect()), key=repr)


def test_repair_of_awkward_rows(spark):
    rows = spoken()
    given = spark.createDataFrame([(*r, "c", 1, "d", "g") for r in rows], SPOKEN).repartition(7)
    damaged = dialogue.damaged(given)
    planned, got = repair(damaged)
    want = repaired(rows)
    assert got == want
    edits = collections.defaultdict(list)
    for r in dialogue.edits(damaged, planned).collect():
        edits[r.conv].append((r.place, r.edit, r.role, r.text))
    for conv, *_, audit, digest in want:
        found = sorted(edits[conv])
        assert "".join(e for _, e, _, _ in found) == audit and [p for p, *_ in found] == list(range(len(audit)))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, e, r, t in found if e != "D").encode()).hexdigest() == digest
    assert repair(dialogue.damaged(given.limit(0)))[1] == []
    gone = damaged.withColumn("gone", damaged["conv"].isNotNull())
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r[1:] == (0, 0, 0, 0, 0, 0, "", empty) for r in repair(gone)[1] if r[0] is not None)


@tables
def test_conversation_repair(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{ROOT}/conversations.parquet").collect()]
    got = queries.op11_conversation_repair(spark, ROOT)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == repaired(rows)


# Spelling variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs, least=5):
    count = collections.Counter()
    for i, t in docs:
        for run in RUN.findall((t or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= least}


def forms_of(words):
    """(word, form, root, n, n_near, form_n) by the words with one place masked and with one letter left out."""
    masked, shorter = collections.defaultdict(set), collections.defaultdict(set)
    for w in words:
        for k in range(len(w)):
            masked[w[:k], w[k + 1 :]].add(w)
            shorter[w[:k] + w[k + 1 :]].add(w)
    near = collections.defaultdict(set)
    for group in masked.values():
        for w in group:
            near[w] |= group - {w}
    for w in words:
        for x in shorter.get(w, ()):
            near[w].add(x)
            near[x].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def random_words(seed):
    rng = random.Random(seed)
    words = {"x" * 3000: 7, "x" * 3001: 50, "üüüüüüü": 5, "uüüüüüü": 500}
    for letters, count in (("ab", 1200), ("abcdefghé", 500)):
        for _ in range(count):
            words["".join(rng.choice(letters) for _ in range(rng.randint(6, 9)))] = rng.choice([5, 6, 30, 31, 200, 1500])
    return words


@pytest.mark.parametrize(("share", "block"), [(8192, 1024), (50, 16), (7, 5)])
def test_variants_in_blocks_of_any_size(spark, share, block):
    words = random_words(share)
    known = settle(spark.createDataFrame(list(words.items()), "word string, n long"), "test-words")
    assert sorted(tuple(r) for r in spelling.variants(known, share=share, block=block).collect()) == forms_of(words)


def test_variants_of_awkward_rows(spark):
    rows = awkward() + [(100 + i, "colour Colour, colours; color naïveté naivete " * (9 if i else 1)) for i in range(4)]
    found = spelling.vocabulary(spelling.runs_of(frame(spark, rows)))
    assert {r.word: r.n for r in found.collect()} == counted(rows)
    assert sorted(tuple(r) for r in spelling.variants(settle(found, "test-words")).collect()) == forms_of(counted(rows))
    assert spelling.variants(settle(found.limit(0), "test-words")).count() == 0


@tables
def test_spelling_variants(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()]
    got = queries.op12_spelling_variants(spark, ROOT)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in got.collect()) == forms_of(counted(docs))


# Jaccard join


def sets(rows, shingle=3):
    out = []
    for i, t in rows:
        w = [x for x in re.split(b"[\x20\x09-\x0d]+", (t or "").encode()) if x]
        w = [x.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))) for x in w]
        out.append((i, frozenset(tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))) if w else frozenset()))
    return out


def linked_sets(rows, percent=90):
    found = sets(rows)
    parent = {k: k for k in range(len(found))}
    for a, b in itertools.combinations(range(len(found)), 2):
        x, y = found[a][1], found[b][1]
        if x and y:
            shared = len(x & y)
            if 100 * shared >= percent * (len(x) + len(y) - shared):
                joined(parent, a, b)
    top = roots(parent)
    least = {}
    for k, (i, _) in enumerate(found):
        if i is not None:
            least[top[k]] = min(least.get(top[k], i), i)
    return sorted(((i, len(s), least.get(top[k]) if s else i) for k, (i, s) in enumerate(found)), key=repr)


def crowd(seed=9):
    """Families of near copies at and around the border, short texts that share phrases, and copies."""
    rng = random.Random(seed)
    rows, number = [], 0
    phrase = "one very common line that many texts share".split()
    for length in (11, 12, 19, 30, 60, 200, 1500):
        base = sentence(rng, length).split()
        for _ in range(40 if length < 100 else 12):
            text = list(base)
            for _ in range(rng.randint(0, max(1, length // 40))):
                text[rng.randrange(length)] = rng.choice(["alpha", "beta", "gamma"])
            rows.append((number, " ".join(text)))
            number += 1
    for _ in range(60):
        rows.append((number, " ".join(phrase + sentence(rng, rng.randint(1, 4)).split())))
        number += 1
    return rows + [(number + k, rows[k % 5][1].upper()) for k in range(20)]


@pytest.mark.parametrize("block_bytes", [jaccard.BLOCK_BYTES, 200])
def test_jaccard_of_awkward_rows(spark, block_bytes):
    rows = [(None if i is None else i + 10_000, t) for i, t in awkward()] + crowd()
    got = jaccard.jaccard_groups(frame(spark, rows).repartition(5), block_bytes=block_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == linked_sets(rows)
    assert jaccard.jaccard_groups(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_links_at_the_border_meet(percent):
    """Pairs that are linked by exactly what is needed share a cell, at every size up to 400, as do pairs of equal sizes."""
    rng = np.random.default_rng(5)

    def meet(x, y):
        keys, bounds = jaccard.cell_keys(np.concatenate([np.sort(x), np.sort(y)]), np.array([0, len(x), len(x) + len(y)]), percent)
        return bool(set(keys[: bounds[1]].tolist()) & set(keys[bounds[1] :].tolist()))

    for size in range(2, 400):
        hashes = rng.permutation(rng.integers(0, 1 << 63, 2 * size).astype(np.uint64))
        large = hashes[:size]
        # The smaller set is a part of the larger one.
        for dropped in range(1, size * (100 - percent) // 100 + 1):
            assert meet(large, rng.permutation(large)[: size - dropped])
        # As many elements of each that the other lacks.
        for other in range(1, size * (100 - percent) // (100 + percent) + 1):
            assert meet(large, np.concatenate([large[other:], hashes[size : size + other]]))


def test_repeated_keys_of_packs(spark, monkeypatch):
    """Keys of several nodes are found at any size of buckets and packs; nodes without keys are in no cell."""
    rng = random.Random(4)
    keys = {k: sorted({rng.getrandbits(64) for _ in range(30)}) for k in range(40)}
    shared = [rng.getrandbits(64) for _ in range(8)]
    for k in range(0, 40, 3):
        keys[k] = keys[k] + rng.sample(shared, 3)
    rows = [(k, bytearray(jaccard._pack(np.array(v, np.uint64)))) for k, v in keys.items()] + [(50, bytearray()), (51, None)]
    want = {}
    for k, v in keys.items():
        for x in v:
            want.setdefault(x >> 16, set()).add(k)
    want = {(x, min(v), k) for x, v in want.items() if len(v) > 1 for k in v}
    nodes = spark.createDataFrame(rows, "node long, keys binary").repartition(3)
    for bucket_keys, packed in ((1 << 18, 1 << 21), (1, 50)):
        monkeypatch.setattr(jaccard, "PACKED", packed)
        got = jaccard._members(nodes, bucket_keys)
        assert {(r.key, r.hub, r.node) for r in got.collect()} == want and want
    assert jaccard._members(nodes.limit(0)).count() == 0


def test_tree_finds_what_all_pairs_find():
    rng = np.random.default_rng(8)
    base = rng.poisson(3, (6, 16))
    points = np.clip(base[rng.integers(0, 6, 400)] + rng.integers(-1, 2, (400, 16)) * (rng.random((400, 16)) < 0.1), 0, None).astype(np.uint16)
    sizes, labels = points.sum(axis=1).astype(np.int64), rng.integers(0, 50, 400)
    found = {(int(a), int(b)) for i, j in jaccard.Tree(points, sizes, labels, 90).pairs() for a, b in zip(i, j)}
    want = set()
    for a, b in itertools.combinations(range(400), 2):
        shared = int(np.minimum(points[a], points[b]).sum())
        if labels[a] != labels[b] and 100 * shared >= 90 * (sizes[a] + sizes[b] - shared):
            want.add((a, b))
    assert found == want and want


@tables
def test_jaccard_join(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()]
    got = queries.op13_jaccard_join(spark, ROOT)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == linked_sets(docs)


def test_jaccard_of_very_long_texts(spark):
    """Sets of 40,000 shingles, over 255 to a group, and a family of them that a tree over their cell is cut for: none of the bounds is too low."""
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in rng.permutation(40_000)]
    rows = [(k, " ".join(words[: 17_000 + 700 * k] + [f"only{k}"] + words[17_000 + 700 * k :])) for k in range(3)]
    rows += [(7, " ".join(reversed(words))), (8, "a short text")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(frame(spark, rows)).collect()}
    assert got == {0: (39_999, 0), 1: (39_999, 0), 2: (39_999, 0), 7: (39_998, 7), 8: (1, 8)}
    sets = [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (100, 33_000, 60_000, 900_000)]
    points = jaccard.counts_of(np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets]))
    whole = jaccard._counted(points).sum(axis=1)
    assert all(len(x) <= w <= 1.3 * len(x) for x, w in zip(sets, whole)) and whole[0] == 100
    twins, sizes = np.repeat(jaccard._counted(points[2:3]), 50, axis=0), np.full(50, 60_000)
    assert sum(len(i) for i, _ in jaccard.Tree(twins, sizes, np.arange(50), 90).pairs()) == 50 * 49 // 2
