from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import ODD_TEXTS, docs_of, prose
from tickwise.llm.packing import BatchEncoder, SquaresPacker, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return BatchEncoder(PATH)


def ids_of(encoder, texts):
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0] + [len(b) for b in raw])
    return [x.tolist() for x in encoder.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), bounds)]


WORDS = st.sampled_from(
    ["it's", "'tis", "we'LL", "don't", "Ünïcode", "ÉCOLE", "×", "a×b", "naïve", "<|endoftext|>", "<", "|", "12ab3", "...", "!?",
     "日本", " ", "é", "\x1c", "ª", "µ", "'", "''s", "x's", "'re", "😀", "\x00", "İ", "ΑΣ"]
)


@given(st.lists(st.lists(st.tuples(WORDS, st.sampled_from(["", " ", "\n", "\t", "  "])), max_size=12), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_ids_equal_the_tokenizer(encoder, texts):
    texts = ["".join(w + s for w, s in t) for t in texts]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(encoder, texts) == want


def test_words_of_exchanged_blocks_differ(encoder):
    """Long words whose blocks of bytes change places are different words."""
    a, b = "a" * 4096, "b" * 4096
    texts = [a + b, b + a, a + b + a, a + a + b, b + a + "c"]
    assert ids_of(encoder, texts) == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_full_memory_starts_anew(encoder, monkeypatch):
    monkeypatch.setattr("tickwise.llm.packing.MAX_WORDS", 64)
    small = BatchEncoder(PATH)
    texts = [prose(i, 300, 5000) for i in range(6)]
    assert ids_of(small, texts) == [small.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(small, texts[:1]) == ids_of(encoder, texts[:1])


@pytest.mark.parametrize("sizes", [[5], [64], [200], [33] * 40, [63] * 9, []])
@pytest.mark.parametrize("max_open", [2, 100])
def test_windows_hold_every_id_once(sizes, max_open):
    rng = random.Random(3)
    sizes = sizes + [rng.randrange(1, 150) for _ in range(60)]
    packer = SquaresPacker(64, 8, max_open)
    for d, n in enumerate(sizes):
        packer.add(d, np.arange(n, dtype="<u4").tobytes())
        assert packer.n_open <= max_open
    packer.finish()
    seen: dict[int, list[int]] = {d: [] for d in range(len(sizes))}
    for window in packer.closed:
        total = sum(len(ids) // 4 for _, _, ids in window)
        assert total == 64 or total & (total - 1) == 0
        for d, start, ids in window:
            values = np.frombuffer(ids, "<u4").tolist()
            assert values == list(range(start, start + len(values)))
            seen[d] += values
    assert all(sorted(v) == list(range(sizes[d])) for d, v in seen.items())


def test_level_choice_keeps_the_sum_of_squares_least():
    packer = SquaresPacker(64, 8, 100)
    packer.add("filler", b"\0" * 4)
    for d in range(3):
        packer.add(d, b"\0" * 4 * 24)
    # 24 opens level 3; the next 24 joins it to level 6 (one each) rather than make it two
    assert packer.counts[3] == 1 and packer.counts[6] == 1


def test_pack_table(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id"), (3, "again"), (3, "again"), (99, prose(1, 9000))]
    out = pack(docs_of(spark, rows), PATH, length=256).toPandas()
    total = sum(len(BatchEncoder(PATH).tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert out["length"].sum() == total
    for _, window in out.groupby("sequence_id"):
        window = window.sort_values("offset")
        assert window["offset"].tolist() == [0, *window["length"].cumsum().tolist()[:-1]]
        n = int(window["length"].sum())
        assert n == 256 or n & (n - 1) == 0
    one = out[out.doc_id == 0]
    assert one["ids"].tolist() == [np.array([2], "<u4").tobytes()] and one.doc_tokens.tolist() == [1]
    assert pack(docs_of(spark, []), PATH).count() == 0
