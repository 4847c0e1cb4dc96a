import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from candlewick.llm.bpe import bpe_round_trip
from candlewick.llm.token_count import token_counts

TEXTS = [
    None, "", "a", " ", "  ", "a  b", "a \n b", "\n\nfoo  bar \t baz ", "<|endoftext|>", "x<|endoftext|>y <|endoftext|> z",
    "it's we're I'LL 'tis", "ééé ßß 中文字 テスト 😀😀", "1234 5678 １２ ½", "\x1c \x1d a\x1cb", "aaaa" * 5000, "!!!???...   ---",
    " lead", "trail ", "\x00\x01 b", "x\r\ny  \r\n z", "word " * 20000, "a　b 　c  d",
]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    parts = [*" \n\t ab1'é中.,<|>", "<|endoftext|>", " the", " ", "ing"]
    noise = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    return [(i, t, f"clash{i}") for i, t in enumerate(TEXTS + noise)] + [(2, "a", "again"), (None, "no id", None)]


SCHEMA = "doc_id long, text string, n_tokens string"


def test_counts_equal_the_library(frame, rows, vocab_path):
    lib = Tokenizer.from_file(vocab_path)
    got = sorted(token_counts(frame(SCHEMA, rows), vocab_path).collect(), key=str)
    want = []
    for i, t, _ in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_codec_equals_the_library(frame, rows, vocab_path):
    lib = Tokenizer.from_file(vocab_path)
    got = bpe_round_trip(frame(SCHEMA, rows), vocab_path, keep_ids=True).collect()
    want = []
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), ids, back))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table(frame, vocab_path):
    empty = frame(SCHEMA, [])
    assert token_counts(empty, vocab_path).count() == 0
    assert bpe_round_trip(empty, vocab_path).count() == 0


def test_memos_hold_no_long_pieces(vocab_path):
    """Texts without spaces: nothing of them stays, results are the library's."""
    from candlewick.llm.bpe import Codec

    codec, lib = Codec(vocab_path), Tokenizer.from_file(vocab_path)
    splitter = codec.encode.__self__
    rnd = random.Random(8)
    for _ in range(200):
        text = "".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([60, 64, 65, 3000])))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
        codec.encode("x " + text)
    held = [k for memo in (splitter.piece, splitter.chunk) for k in (*memo, *memo.old)]
    assert held and max(map(len, held)) <= 65  # a piece may start with a space
