"""Byte-level BPE vocabulary and pre-tokenisation, read from a tokenizers .json file."""

from __future__ import annotations

import json
import sys
import types
from heapq import heapify, heappop, heappush

#: Fixed value: the split pattern of byte-level BPE files of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ID_BITS = 24
AT_BITS = 36
AT_MASK = (1 << AT_BITS) - 1


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes: printable Latin-1 bytes stand for
    themselves, the others follow from code point 256 on in byte order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {chr(b if b in plain else next(spare)): b for b in range(256)}


class ByteBpe:
    """Vocabulary: ``byte_ids`` (id of each single byte), ``ranks``
    (left id and right id in one int -> rank), ``new_ids`` (by rank),
    ``token_bytes`` by id and the ``special`` strings that are cut out before splitting."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, kind = spec["model"], spec["pre_tokenizer"] or {}
        odd = spec.get("normalizer") or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space")
        if odd or model.get("ignore_merges") or model.get("byte_fallback") or not kind.get("use_regex", True):
            raise ValueError(f"{path}: only plain byte-level BPE is supported")
        alphabet = byte_alphabet()
        ids = model["vocab"]
        raw = {t: bytes(alphabet[c] for c in t) for t in ids if all(c in alphabet for c in t)}
        self.byte_ids = [0] * 256
        for c, b in alphabet.items():
            self.byte_ids[b] = ids[c]
        self.ranks: dict[int, int] = {}
        self.new_ids: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[left] << ID_BITS | ids[right]] = rank
            self.new_ids.append(ids[left + right])
        added = spec.get("added_tokens", [])
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path}: stripping added tokens are not supported")
        self.special = {t["content"]: t["id"] for t in added}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.token_bytes: list[bytes] = [b""] * size
        for t, i in ids.items():
            self.token_bytes[i] = raw.get(t, t.encode())
        for t, i in self.special.items():
            self.token_bytes[i] = t.encode()


def heap_merge(symbols: list[int], ranks: dict[int, int], new_ids: list[int]) -> int:
    """Merge adjacent symbols, lowest rank first (leftmost on ties), with a
    heap of candidate pairs over a linked list. Merged-away places of
    ``symbols`` become -1; returns the number of merges, O(n log n)."""
    n = len(symbols)
    get = ranks.get
    heap = [r << AT_BITS | i for i, r in enumerate([get(a << ID_BITS | b) for a, b in zip(symbols, symbols[1:])]) if r is not None]
    if not heap:
        return 0
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heapify(heap)
    done = 0
    while heap:
        top = heappop(heap)
        i, rank = top & AT_MASK, top >> AT_BITS
        left, j = symbols[i], after[i]
        if left < 0 or j >= n or get(left << ID_BITS | symbols[j]) != rank:
            continue
        new = symbols[i] = new_ids[rank]
        symbols[j] = -1
        done += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = get(new << ID_BITS | symbols[k])
            if found is not None:
                heappush(heap, found << AT_BITS | i)
        h = before[i]
        if h >= 0:
            found = get(symbols[h] << ID_BITS | new)
            if found is not None:
                heappush(heap, found << AT_BITS | h)
    return done


class Irregular(Exception):
    """A space next to other white space: the text needs the full pattern."""


#: Longer pieces are computed again each time.
MEMO_CHARS = 64


class Memo(dict):
    """piece -> value, computed once. At ``limit`` entries the held ones become
    the old generation and the former old one goes; keys of more than
    ``MEMO_CHARS`` characters (texts without spaces) are never held. So memory
    stays bounded in bytes, too, whatever the corpus is made of."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(key) > MEMO_CHARS:
            return self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def worker_held(key: tuple, make):
    """``make()`` once per Python worker: vocabularies and memos outlive a
    task where Spark reuses the worker. Nothing but speed depends on it."""
    held = sys.modules.setdefault("_candlewick_worker", types.ModuleType("_candlewick_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


class Splitter:
    """Feeds ``make(piece bytes)`` with the pieces of a text and adds up the
    results with ``total`` (sum, or b"".join).

    A single space between two other characters always starts a piece, so a
    text may be cut there: each such chunk is looked up whole in a bounded
    memo. Texts where a space touches other white space take the full pattern."""

    def __init__(self, vocab: ByteBpe, make, total, special_value, limit: int = 200_000):
        import regex

        self.find = regex.compile(SPLIT).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(vocab.special, key=len, reverse=True))) + ")").split if vocab.special else lambda t: [t]
        self.special = {s: special_value(i) for s, i in vocab.special.items()}
        self.strings = list(vocab.special)
        self.total = total
        self.piece = Memo(lambda s: make(s.encode()), limit)
        self.chunk = Memo(self._chunk, limit)

    def _chunk(self, chunk: str):
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise Irregular
        return self.total(map(self.piece.__getitem__, self.find(" " + chunk)))

    def _plain(self, text: str):
        first, *rest = text.split(" ")
        if first and first[-1].isspace():
            return self.total(map(self.piece.__getitem__, self.find(text)))
        try:
            tail = self.total(map(self.chunk.__getitem__, rest))
        except Irregular:
            return self.total(map(self.piece.__getitem__, self.find(text)))
        return self.total([self.total(map(self.piece.__getitem__, self.find(first))), tail])

    def of(self, text: str):
        if not any(s in text for s in self.strings):
            return self._plain(text)
        return self.total([self.special[s] if s in self.special else self._plain(s) for s in self.cut(text) if s])
