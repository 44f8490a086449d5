import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from precinct.llm import byte_bpe
from tests.llm.conftest import EDGES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    pattern = public_tokenizers.PATTERN
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def random_texts(count, size, seed=7):
    rng = random.Random(seed)
    alphabet = list("abstmdrevl'’ \n\t\r  0123é中ñ'!?#-_  　\x00\x1c\U0001f600")
    alphabet += ["'s", "'re", "'ll", "'ve", " 's", "  's", "\n's", "don't", "<|endoftext|>"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, size))) for _ in range(count)]


def test_random_texts_encode_as_the_library_does(library):
    words = byte_bpe.vocabulary(byte_bpe.read_ranks(PATH))
    texts = random_texts(3_000, 60) + ["ab" * 3_000, "!" * 5_000, " " * 3_000, "x" * 99 + " " * 99]
    ids, ends = words.encode(texts)
    begin = 0
    for text, end in zip(texts, ends):
        own = ids[begin:end]
        assert own.tolist() == library.encode_ordinary(text), repr(text)
        data, offsets = words.decode(own)
        assert data.tobytes() == text.encode()
        assert len(offsets) == len(own)
        begin = end


def test_scan_gives_the_states_of_a_loop():
    rng = np.random.default_rng(3)
    kinds = rng.integers(0, byte_bpe.CLASSES, 10_000).astype(np.uint8)
    state, want = byte_bpe.DONE, []
    for kind in kinds.tolist():
        want.append(state)
        state = byte_bpe.step(state, kind)[0]
    assert byte_bpe.states_before(kinds).tolist() == want


def test_cut_texts_encode_like_whole_ones(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", 16)
    words = byte_bpe.vocabulary(byte_bpe.read_ranks(PATH))
    for text in random_texts(300, 300, 11):
        parts = list(byte_bpe.cuts(text, 16))
        assert "".join(parts) == text
        assert [i for p in parts for i in library.encode_ordinary(p)] == (
            library.encode_ordinary(text)
        )
        out = byte_bpe.encoded(words, [text], True)
        assert out["ids"].to_pylist() == [library.encode_ordinary(text)]


def test_hash_collisions_do_no_harm(library, monkeypatch):
    words = byte_bpe.vocabulary(byte_bpe.read_ranks(PATH))
    unique = np.unique
    monkeypatch.setattr(
        byte_bpe.np, "unique", lambda x, **options: unique(x % np.uint64(7), **options)
    )
    text = " the cat sat on a mat, the dog's not 42"
    ids, _ = words.encode([text, text])
    assert ids.tolist() == library.encode_ordinary(text) * 2


def test_documents(edges, nothing, library):
    rows = byte_bpe.encode_documents(edges, PATH).collect()
    assert len(rows) == len(EDGES)
    texts = {i: t for i, t, *_ in EDGES}
    for row in rows:
        text = texts[row["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        raw = np.array(ids, "<u4").tobytes()
        assert row["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.encode_documents(nothing, PATH).count() == 0
