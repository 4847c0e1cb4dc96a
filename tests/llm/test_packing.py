import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from candlewick.llm.packing import Encoder, nnls, pack, plan, sequences

SCHEMA = "doc_id long, text string, length string"


def check(pieces, rows, path, window):
    lib = Tokenizer.from_file(path)
    want = defaultdict(list)
    for i, t, _ in rows:
        want[i].append(lib.encode(t or "", add_special_tokens=False).ids + [0])
    found, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert 1 <= p["length"] <= window and len(p["ids"]) == p["length"]
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        found[p["doc_id"]].append(p)
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
    assert found.keys() == want.keys()
    for i, ps in found.items():
        assert sorted(sum((p["ids"] for p in ps), [])) == sorted(sum(want[i], []))
        if len(want[i]) == 1:
            ps.sort(key=lambda p: p["start"])
            assert sum((p["ids"] for p in ps), []) == want[i][0]
            assert [p["start"] for p in ps] == list(np.cumsum([0] + [p["length"] for p in ps])[:-1])
            assert {p["doc_tokens"] for p in ps} == {len(want[i][0])}
    padding = 0
    for parts in seqs.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
        n = sum(n for _, n in parts)
        assert n <= window
        padding += 0 if n & (n - 1) == 0 else window - n
    assert sorted(seqs) == list(range(len(seqs)))
    return padding


@pytest.mark.parametrize("window", [16, 64])
def test_pieces_rebuild_every_document(frame, vocab_path, window):
    rnd = random.Random(window)
    rows = [(i, " ".join(rnd.choice(["the", "Ofthan", "ééß", "中", "<|endoftext|>", "\n", "x" * 40]) for _ in range(rnd.choice([0, 1, 3, 9, 70]))), "clash") for i in range(400)]
    rows += [(1000 + i, "one and the same text", None) for i in range(200)]
    rows += [(5, rows[5][1], "again"), (None, None, None), (2000, None, None), (2001, "", None), (2002, "word " * 5000, None)]
    out = pack(frame(SCHEMA, rows, 5), vocab_path, window=window, keep_ids=True).collect()
    assert check(out, rows, vocab_path, window) == 0


def test_sequences_are_padded_unless_powers_of_two(frame, vocab_path):
    rows = [(i, "a b c d " * i, "") for i in range(30)]
    pieces = pack(frame(SCHEMA, rows), vocab_path, window=32, keep_ids=True)
    for r in sequences(pieces, window=32).collect():
        n = r["n_tokens"]
        assert len(r["ids"]) == (n if n & (n - 1) == 0 else 32)


def test_empty_table(frame, vocab_path):
    assert pack(frame(SCHEMA, []), vocab_path).count() == 0


def test_plan_serves_ranks_once():
    rnd = np.random.default_rng(1)
    h = rnd.poisson(30, 64)
    used = defaultdict(list)
    for length, since, to, seq, at in plan(h, 64):
        used[length] += range(since, to)
    for length, ranks in used.items():
        assert sorted(ranks) == list(range(len(ranks))) and len(ranks) <= h[length]
    assert sum(map(len, used.values())) > 0.9 * h[1:].sum()


def test_nnls_finds_exact_solution():
    places = np.array([[1, 7, 0], [2, 6, 0], [4, 4, 0], [1, 2, 5]])
    target = np.zeros(8)
    for k, x in enumerate([3.0, 0.0, 2.0, 4.0]):
        for v in places[k][places[k] > 0]:
            target[v] += x
    assert np.allclose(nnls(places, target, 3000), [3, 0, 2, 4], atol=1e-2)


def test_encoder_on_white_space(vocab_path):
    lib = Tokenizer.from_file(vocab_path)
    enc = Encoder(vocab_path)
    for t in ["", " " * 300_000, "\n \n" * 1000, "a" * 50_000, "x<|endoftext|>", " 　 x", "'s's"]:
        assert enc(t).tolist() == lib.encode(t, add_special_tokens=False).ids
