"""The numpy kernels against plain Python."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm import words as w
from panelspark.llm.xxh64 import xxh64

texts = st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=8)


def run_of(values):
    return w.buffer_of(pa.array(values, pa.string()))


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_are_those_of_split(values):
    data, offsets = run_of(values)
    for found in (w.lower_words(data, offsets), w.single_spaced(w.lower_words(data, offsets))):
        got = [[found.data[a:b].tobytes() for a, b in zip(found.start[x:y], found.end[x:y])] for x, y in zip(found.bounds[:-1], found.bounds[1:])]
        assert got == [(t or "").encode().lower().split() for t in values]


@settings(max_examples=60, deadline=None)
@given(texts)
def test_equal_words_have_equal_hashes(values):
    data, offsets = run_of(values)
    found = w.lower_words(data, offsets)
    seen = {}
    for a, b, h in zip(found.start, found.end, found.hashes().tolist()):
        assert seen.setdefault(found.data[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=100), max_size=8), st.integers(0, 2**64 - 1))
def test_xxh64(values, seed):
    data = np.frombuffer(b"".join(values), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int64)
    assert xxh64(data, at[:-1], at[1:], seed).tolist() == [xxhash.xxh64_intdigest(v, seed=seed) for v in values]


def test_slices_cover_everything_once(monkeypatch):
    monkeypatch.setattr(w, "SLICE_BYTES", 10)
    data, offsets = run_of(["abc", "", None, "x" * 25, "de", "fghijk", "lm"])
    parts = list(w.slices(data, offsets))
    assert [p[:2] for p in parts][0][0] == 0 and parts[-1][1] == 7
    assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert b"".join(p[2].tobytes() for p in parts) == data.tobytes()


@pytest.mark.parametrize("window", [1, 2, 3, 7, 8])
def test_winnowed_marks_the_least_of_every_window(window):
    rng = np.random.RandomState(window)
    h = rng.randint(0, 50, 200).astype(np.uint64)
    want = np.zeros(200, bool)
    for i in range(200 - window + 1):
        part = h[i : i + window]
        want[i : i + window] |= part == part.min()
    assert (w.winnowed(h, window) == want).all()


def test_tally_adds_up():
    rng = random.Random(1)
    tally, want = w.Tally(), {}
    for _ in range(30):
        keys = np.array([rng.randint(0, 20) for _ in range(50)], np.uint64)
        tally.add(*np.unique(keys, return_counts=True))
        for k in keys.tolist():
            want[k] = want.get(k, 0) + 1
    keys, counts = tally.total()
    assert dict(zip(keys.tolist(), counts.tolist())) == want


def test_token_ids_are_the_tokenizers():
    tokenizers = pytest.importorskip("tokenizers")
    from panelspark.llm.queries import tokenizer_path
    from panelspark.llm.tokens import WordEncoder

    values = [
        "The quick-brown fox's 123 jumps; it's <|endoftext|> done", "Éàü ñandú Straße ÀÉ 數據", "", None, "don't é  x y \x1c z",
        "a" * 3000, "x_y __z__ ¿qué? «oui» 50% $5.00 a=b <b> ÷×", "İstanbul ΣΑΣ ﬁ ½ ٣", "l'll'm 've'd'S'T", "​zero​width \x7f \x85",
    ]
    plain = tokenizers.Tokenizer.from_file(tokenizer_path())
    ids, sizes = WordEncoder(tokenizer_path()).encode(*run_of(values))
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in values]
    assert sizes.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_an_encoder_that_forgets_gives_the_same_ids(monkeypatch):
    pytest.importorskip("tokenizers")
    from panelspark.llm import tokens
    from panelspark.llm.queries import tokenizer_path

    rng = random.Random(4)
    values = [" ".join(rng.choice(["often", "always", f"w{rng.randint(0, 300)}"]) for _ in range(40)) for _ in range(60)]
    whole = tokens.WordEncoder(tokenizer_path()).encode(*run_of(values))
    monkeypatch.setattr(tokens, "REMEMBERED", 60)
    small = tokens.WordEncoder(tokenizer_path())
    parts = [small.encode(*run_of(values[k : k + 5])) for k in range(0, 60, 5)]
    assert len(small._slot) < 300 and small.encode(*run_of([None, ""]))[0].tolist() == []
    assert np.concatenate([p[0] for p in parts]).tolist() == whole[0].tolist()
    assert np.concatenate([p[1] for p in parts]).tolist() == whole[1].tolist()


def test_a_worker_that_encodes_stays_small():
    pytest.importorskip("tokenizers")
    from panelspark.llm.queries import tokenizer_path
    from panelspark.llm.tokens import WordEncoder

    rng = random.Random(5)
    data, offsets = run_of([" ".join("".join(rng.choices("aeinrst", k=7)) for _ in range(1000)) for _ in range(150)])
    encoder = WordEncoder(tokenizer_path())
    tracemalloc.start()
    try:
        for _, _, d, o in w.slices(data, offsets):
            encoder.encode(d, o)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    # Some 140,000 words are known then.
    assert len(encoder._slot) > 100_000
    assert held < 12 << 20 and peak < 36 << 20, (held, peak)


def test_pieces_are_encoded_once_whatever_case_and_signs_they_come_with():
    pytest.importorskip("tokenizers")
    from panelspark.llm.queries import tokenizer_path
    from panelspark.llm.tokens import WordEncoder

    class Counted:
        def __init__(self, model):
            self.model, self.calls = model, []

        def tokenize(self, text):
            self.calls.append(text)
            return self.model.tokenize(text)

    encoder = WordEncoder(tokenizer_path())
    encoder._model = Counted(encoder._model)
    words = [f"{a}{b}{c}" for a in ("", "(", "[") for b in ("garden", "Garden", "GARDEN", "über", "Über") for c in ("", ",", ".", "!?", ")")]
    values = [" ".join(words), "Garden-über 1 11 111"]
    ids, sizes = encoder.encode(*run_of(values))
    plain = encoder._tokenizer
    assert ids.tolist() == [i for t in values for i in plain.encode(t, add_special_tokens=False).ids]
    assert len(sizes) == 2
    # garden, über, seven kinds of signs and a digit; taken out of each whole word, they would be 194.
    assert len(encoder._model.calls) == len(set(encoder._model.calls)) == 10


_PARTS = st.sampled_from(
    ["a", "Z", "word", "Ünï", "ÿ", "ß", "×", "÷", "É", "E\u0301", "\u0301", "1", "22", "'", "'s", "'LL", "<", "<|endoftext|>", "<|ENDOFTEXT|>", "_", "-", "…", "²", "½"]
    + ["٣", "ª", "数", "İ", "ſ", "\x00", "\x1c", "\x7f", "\x85", "\xa0", "\u200b", " ", " ", " ", "\t", "\n", "\r\n"]
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(_PARTS, max_size=12).map("".join), st.text(max_size=30)), max_size=6), st.booleans())
def test_token_ids_of_any_texts_are_the_tokenizers(values, literal):
    tokenizers = pytest.importorskip("tokenizers")
    from panelspark.llm.queries import tokenizer_path
    from panelspark.llm.tokens import word_encoder

    plain = tokenizers.Tokenizer.from_file(tokenizer_path())
    plain.encode_special_tokens = literal
    ids, sizes = word_encoder(tokenizer_path(), literal).encode(*run_of(values))
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in values]
    assert sizes.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_bytes_that_are_no_text_are_encoded_as_their_replacement():
    tokenizers = pytest.importorskip("tokenizers")
    from panelspark.llm.queries import tokenizer_path
    from panelspark.llm.tokens import WordEncoder

    values = [b"ab\xc3", b"\xa9cd \xc3d", b"\xa9 \xc3\xc3\xa9", b"", b"\xc3", b"\xff\xfe x"]
    data = np.frombuffer(b"".join(values), np.uint8)
    ids, sizes = WordEncoder(tokenizer_path()).encode(data, np.concatenate([[0], np.cumsum([len(v) for v in values])]))
    plain = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = [plain.encode(v.decode("utf-8", "replace"), add_special_tokens=False).ids for v in values]
    assert sizes.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_pieces_that_come_again_are_remembered_and_the_table_keeps_its_size(monkeypatch):
    pytest.importorskip("tokenizers")
    from panelspark.llm import tokens
    from panelspark.llm.queries import tokenizer_path

    monkeypatch.setattr(tokens, "REMEMBERED", 256)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 2000)
    rng = random.Random(6)
    encoder, whole = tokens.WordEncoder(tokenizer_path()), tokens.WordEncoder(tokenizer_path())
    often, missed, encode = ["house", "river", "stone", "bread"], [], encoder._encode

    def counted(pieces, odd):
        missed.extend(pieces.data[a:b].tobytes().decode() for a, b in zip(pieces.start, pieces.end))
        return encode(pieces, odd)

    encoder._encode = counted
    for k in range(120):
        rare = ["".join(rng.choices("aeinrst", k=9)) for _ in range(60)] + (["數" * 3000, "x" * 900] if k % 10 == 0 else [])
        text = " ".join(often + rare)
        got, want = encoder.encode(*run_of([text])), whole._tokenizer.encode(text, add_special_tokens=False).ids
        assert got[0].tolist() == want and got[1].tolist() == [len(want)]
        assert len(encoder._slot) == len(encoder._first) == 256
        assert len(encoder._ids) < 20_000
    # Rare ones come every time; were the frequent ones not kept, they would be missed 480 times.
    assert sum(w in often for w in missed) < 100


def test_a_tally_of_few_keys_stays_small():
    tally, keys = w.Tally(), np.arange(1000, dtype=np.uint64)
    for _ in range(200):
        tally.add(keys.copy(), np.ones(1000, np.int64))
        assert sum(len(k) for k, _ in tally._parts) <= 1 << 16
    assert tally.total()[1].tolist() == [200] * 1000
