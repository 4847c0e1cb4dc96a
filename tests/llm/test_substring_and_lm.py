import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from candlewick.llm.common import Words
from candlewick.llm.lm_score import Automaton, lm_scores, squeezed, token_grams, unsqueezed
from candlewick.llm.substring import chained, dedup_substrings, least

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words string"


def corpus(seed, n=220):
    rnd = random.Random(seed)
    vocab = ["the", "The", "é", "中文", "of", "x" * 300] + [f"w{i}" for i in range(40)]
    passages = [[rnd.choice(vocab) for _ in range(rnd.choice([5, 9, 14, 30]))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rnd.randrange(6)):
            words += rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice(vocab) for _ in range(rnd.randrange(25))]
        sep = rnd.choice([" ", "\n", "  ", " \t"])
        rows.append((i * 7 % 1000, sep.join(words), "clash"))
    copy = " ".join(rnd.choice(vocab) for _ in range(50))
    rows += [(3000 + i, copy, None) for i in range(60)]
    rows += [(4000, "to " * 500, None), (4001, "to " * 300 + "end", None), (4002, None, None), (4003, "", None), (4004, " \n", None), (None, copy, None), (None, None, None), (3001, copy, None), (14, rows[3][1], "again"), (2, "a b " * 9, "x")]
    return rows


def brute_dedup(rows, window):
    first = {}
    top = 1 << 63
    texts = [(top if i is None else i, WORD.findall(t or "")) for i, t, _ in rows]
    for i, words in texts:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, (top + 1, 0)), (i, s))
    out = []
    for (i, words), (raw, _, _) in zip(texts, rows):
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < (i, s):
                gone[s : s + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((raw, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window,block", [(8, 1 << 20), (8, 2000), (20, 3000)])
def test_substring_dedup_equals_brute_force(frame, window, block):
    rows = corpus(window)
    got = dedup_substrings(frame(SCHEMA, rows, 4), window=window, block_bytes=block).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_dedup(rows, window), key=str)
    kept = dedup_substrings(frame(SCHEMA, rows, 4), window=window, block_bytes=block, keep_rows=True)
    assert kept.columns == ["doc_id", "text", "n_words"]
    texts = sorted((r["doc_id"], hashlib.sha256(" ".join(WORD.findall(r["text"] or "")).encode()).hexdigest()) for r in kept.collect() if r["doc_id"] is not None)
    assert texts == sorted((i, d) for i, _, _, d in brute_dedup(rows, window) if i is not None)


def test_empty_tables(frame):
    assert dedup_substrings(frame(SCHEMA, [])).count() == 0
    assert lm_scores(frame(SCHEMA, [])).count() == 0


def test_runs():
    v = np.arange(50, dtype=np.uint64) * np.uint64(7919) % np.uint64(31)
    for n in range(1, 24):
        assert least(v, n).tolist() == [min(v[i : i + n]) for i in range(50 - n + 1)]
        h = chained(v, n)
        assert len(h) == 50 - n + 1
        same = {}
        for i, x in enumerate(h.tolist()):
            assert same.setdefault(tuple(v[i : i + n].tolist()), x) == x
        assert len(set(h.tolist())) == len(same)


def test_words_split_and_hash_like_the_pattern():
    texts = [t or "" for _, t, _ in corpus(1, 50)] + ["", "\x0b\x0c", "a\x1cb c", "q" * 1000]
    words = Words([t.encode() for t in texts], lower=True)
    found = [words.raw[a:b].tobytes() for a, b in zip(words.start, words.end)]
    want = [w.encode() for t in texts for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))]
    assert found == want
    assert len({*zip(found, words.hashes.tolist())}) == len(set(found)) == len(set(words.hashes.tolist()))


def brute_lm(rows, order, k):
    def tokens(t):
        return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]

    learn = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2 for i, _, _ in rows]
    grams, contexts, docs = Counter(), Counter(), sum(learn)
    for (_, t, _), ok in zip(rows, learn):
        if ok:
            seq = ["<s>"] + tokens(t)
            for i in range(1, len(seq)):
                for n in range(1, order + 1):
                    if i - n + 1 >= 0:
                        gram = tuple(seq[i - n + 1 : i + 1])
                        grams[gram] += 1
                        contexts[gram[:-1]] += 1
    vocab = [g for g in grams if len(g) == 1]
    total = sum(grams[g] for g in vocab)

    def p(gram):
        if len(gram) == 1:
            return (grams[gram] + 1) / (total + len(vocab) + 1)
        lower = p(gram[1:])
        h = contexts[gram[:-1]]
        return (grams[gram] + k * lower) / (h + k) if h else lower

    out = []
    for (i, t, _), ok in zip(rows, learn):
        seq = ["<s>"] + tokens(t)
        base = sum(math.log10(p((w,))) for w in seq[1:])
        score = sum(math.log10(p(tuple(seq[max(0, j - order + 1) : j + 1]))) for j in range(1, len(seq)))
        out.append((i, not ok, len(seq) - 1, sum(grams[(w,)] > 0 for w in seq[1:]), total, base, score))
    return out


@pytest.mark.parametrize("order,block", [(2, 1 << 20), (2, 1500), (3, 1500)])
def test_scores_equal_brute_force(frame, order, block):
    rows = corpus(40 + order)
    got = lm_scores(frame(SCHEMA, rows, 4), order=order, strength=4.0, block_bytes=block).collect()
    key = lambda r: (str(r[0]), r[2], round(r[5], 3), round(r[6], 3))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(brute_lm(rows, order, 4.0), key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_registered_query_learns_trigrams(spark, frame, tmp_path):
    from candlewick.llm.queries import QUERIES

    # "c" follows "b" after "a" only: the pair alone can't tell
    rows = [(i, "a b c" if i % 2 else "x b d", "") for i in range(400)]
    frame(SCHEMA, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["score"] for r in QUERIES["op2_lm_scores"](spark, str(tmp_path)).collect()}
    pair = {r["doc_id"]: r["score"] for r in lm_scores(frame(SCHEMA, rows), order=2, strength=2048.0).collect()}
    assert all(got[i] > pair[i] + 0.2 for i in range(400))


def automaton_of(texts, learn, strengths):
    """Automaton of texts of which some teach, and their tokens."""
    first, grams = token_grams([t.encode() for t in texts], len(strengths) + 1)
    trained = np.repeat(np.array(learn, dtype=bool), np.diff(first))
    counts = []
    for k, g in enumerate(grams, 1):
        n = Counter(x for x in g[trained].tolist() if x or k < 3)
        counts.append(np.array([n[x] if x or k < 3 else 0 for x in g.tolist()], dtype=np.int64))
    known = {x: c for x, c in zip(grams[0].tolist(), counts[0].tolist()) if c}
    return Automaton(first, grams, counts, sum(learn), sum(known.values()), len(known), strengths)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_reading_heads_carry_the_state(order):
    rnd = random.Random(order)
    texts = [" ".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(60))) for _ in range(30)] + ["", "z", "z z z z a b", "a"]
    learn = [i % 3 != 2 for i in range(len(texts))]
    model = automaton_of(texts, learn, (4.0, 2.0, 1.0)[: order - 1])
    rows = [(3 * i, t, "") for i, t in enumerate(texts)]
    whole = model.walk()
    for lane in (1, 2, 7, 50):
        assert model.walk(lane) == pytest.approx(whole, rel=1e-12)
    if order == 1:
        assert whole == pytest.approx(np.add.reduceat(model.base, model.first[:-1]), rel=1e-12)
    # one head, token by token, against the chain of failures spelled out
    arcs = {k: (w, t) for k, w, t in zip(model.keys.tolist(), model.weights.tolist(), model.targets.tolist())}
    for n in range(len(rows)):
        state, total = min(1, order - 1), 0.0
        for token in model.token[model.first[n] : model.first[n + 1]].tolist():
            while state and (state << 32 | token) not in arcs:
                total += model.fail_weight[state]
                assert model.fail_to[state] != state
                state = int(model.fail_to[state])
            if state:
                weight, state = arcs[state << 32 | token]
            else:
                weight, state = model.root_weight[token], int(model.root_to[token])
            total += weight
        assert total == pytest.approx(whole[n], rel=1e-12)


def test_one_strength_for_each_order(frame):
    # p(b) of 10 tokens, then after a, then after the start and a
    model = automaton_of(["a b", "a b", "a c", "b", "a b"], [True] * 4 + [False], (9.0, 2.0))
    p1 = (3 + 1) / (11 + 4 + 1)
    p2 = (2 + 9 * p1) / (3 + 9)
    p3 = (2 + 2 * p2) / (3 + 2)
    state, first = model.step(np.array([1]), model.token[:1])
    state, second = model.step(state, model.token[1:2])
    assert second[0] == pytest.approx(math.log10(p3))
    # c never follows b: fails from (a, b) to b and from there to the root
    c = model.token[model.first[2] + 1 : model.first[2] + 2]
    _, failed = model.step(state, c)
    assert failed[0] == pytest.approx(math.log10(2 / (2 + 2) * 9 / (3 + 9) * 2 / 16))
    with pytest.raises(ValueError):
        lm_scores(frame(SCHEMA, []), order=3, strength=(9.0,))


def test_squeezed_arrays_come_back():
    rnd = np.random.default_rng(3)
    for values in ([], [0], [2**64 - 1, 0, 5], rnd.integers(0, 2**63, 1000)):
        values = np.array(values, dtype=np.uint64)
        assert (unsqueezed(squeezed(values)) == values).all() and len(unsqueezed(squeezed(values))) == len(values)
