import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from candlewick.llm import align
from candlewick.llm.align import align_tokens, leaf_groups
from candlewick.llm.pretoken import byte_alphabet
from candlewick.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n_a string, block int, pair string"
TEXTS = [
    None, "", "a", " ", "   ", "a  b", "Hello world, hello tokenizers!", "<|endoftext|>", "x<s>y</s> <unk> <|endoftext|>z", "ééé ßß 中文字 テスト 😀😀",
    "a▁b", "▁", "tab\tnew\nline\r\n", "\x00\x01 nul", "aaaa" * 3000, "naïve coöperation über straße", "zq" * 400, "  lead and trail  ", "word " * 4000,
]


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def spell(paths):
    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    alphabet = byte_alphabet()

    def tokens(text):
        if not text:
            return [], []
        ours = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        theirs = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        raw = (" " + text).encode()
        if b"".join(t for _, t in ours) != raw or b"".join(t for _, t in theirs) != raw:
            return [], []
        return ours, theirs

    return tokens


def brute(rows, paths):
    tokens, counts, docs = spell(paths), Counter(), []
    for i, text in rows:
        sides, spans = tokens(text), []
        for side in sides:
            at, own = 0, []
            for token, raw in side:
                own.append((token, at, at + len(raw)))
                at += len(raw)
            spans.append(own)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, links, before = [], [], 0
        for cut in cuts:
            inside = [[x for x in own if before < x[2] <= cut] for own in spans]
            groups.append("|".join(",".join(str(x[0]) for x in own) for own in inside))
            links += [(x[0], y[0]) for x in inside[0] for y in inside[1] if x[1] < y[2] and y[1] < x[2]]
            before = cut
        counts.update(links)
        docs.append((i, len(spans[0]), len(spans[1]), groups, links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for i, n_a, n_b, groups, links in docs:
        text = ";".join(groups)
        highest = sum(counts[p] == best[p[1]] for p in links)
        out.append((i, n_a, n_b, len(groups), len(links), highest, sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else "", text))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 24, 200])
def test_alignment_equals_brute_force(frame, paths, block_bytes, monkeypatch):
    monkeypatch.setattr(align, "STEP_BYTES", 300)
    rnd = random.Random(3)
    parts = [*" \n\t ab1'é中.,<|>", " the", " ", "ing", " Wörter", "anti"]
    texts = TEXTS + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(150)]
    rows = list(enumerate(texts)) + [(3, "a"), (None, "no id"), (None, None)]
    got = align_tokens(frame(SCHEMA, [(i, t, "x", 1, "y") for i, t in rows]), *paths, block_bytes=block_bytes, keep_groups=True)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows, paths), key=repr)


def test_empty_tables(frame, paths):
    assert align_tokens(frame(SCHEMA, []), *paths).count() == 0
    none = align_tokens(frame(SCHEMA, [(1, None, "x", 1, "y"), (2, "", "x", 1, "y")]), *paths).collect()
    assert sorted(map(tuple, none)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 60), max_size=50), st.sets(st.integers(1, 60), max_size=50), st.integers(61, 70)), min_size=1, max_size=5))
def test_divide_and_conquer_finds_all_common_ends(texts):
    a, b, base, bounds = [], [], 0, []
    for ends_a, ends_b, size in texts:
        own = [sorted(e) + [size] for e in (ends_a, ends_b)]
        bounds.append((len(a), len(a) + len(own[0]), len(b), len(b) + len(own[1])))
        a += [base + e for e in own[0]]
        b += [base + e for e in own[1]]
        base += size
    common = sorted(set(a) & set(b))
    got_a, got_b = leaf_groups(np.array(a), np.array(b), *(np.array(x) for x in zip(*bounds)))
    assert got_a.tolist() == [a.index(c) + 1 for c in common]
    assert got_b.tolist() == [b.index(c) + 1 for c in common]


def test_long_stretch_without_common_ends():
    a, b = np.append(np.arange(2, 200_000, 2), 200_001), np.append(np.arange(1, 200_000, 2), 200_001)
    got = leaf_groups(a, b, *(np.array([x]) for x in (0, len(a), 0, len(b))))
    assert [x.tolist() for x in got] == [[len(a)], [len(b)]]


def test_query_equals_brute_force_on_the_given_table(spark, paths):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op12_token_alignment"](spark, sf).collect()))
    assert got == sorted(r[:-1] for r in brute(rows, paths))
