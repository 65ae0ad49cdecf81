"""Subword encoding (operators 1, 4 and 8).

A text is cut into pre-tokens; byte-pair merging never crosses a pre-token, so operator 8 computes a pre-token's ids
once and reuses them. Texts of Latin characters take fast paths; any other text goes through the
tokenizers library itself, so results do not depend on this module's idea of Unicode.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from heapq import heapify, heappop, heappush
from itertools import chain

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np

#: Entries a worker keeps before it starts over; bounds memory, never results.
CACHE_WORDS = 400_000
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_FAST = re.compile("[^\x00-\x1b\x20-ɏ]")
_LOWER_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")


def _byte_alphabet() -> dict[int, str]:
    """Printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stays, the rest follows from 256."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ByteLevelEncoder:
    """Ids of whole texts as the tokenizers library gives them, as packed little-endian uint16 or uint32.

    A vocabulary whose ids ascend in the order of their merges is also a rank table, and if besides every token merges to itself,
    merging by rank gives the library's ids: two neighbours whose concatenation is a token t are then always the pair that t's
    own merge joins, since merging t's bytes alone would otherwise stop at other halves. ``merges_to_itself`` checks that for
    a whole vocabulary. Texts of Latin characters are merged by rank; all others go through the library itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tk = Tokenizer.from_file(path)
        self.tk.no_truncation()
        self.tk.no_padding()
        self.width = 2 if self.tk.get_vocab_size() <= 65536 else 4
        self.dtype = "<u2" if self.width == 2 else "<u4"
        self.special = [t.content for t in self.tk.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            self.ranked = _rank_encoder(json.load(f))

    def ids(self, text: str) -> np.ndarray:
        if self.ranked and not _FAST.search(text) and not any(s in text for s in self.special):
            try:
                return self.ranked.encode_to_numpy(text, disallowed_special=())
            except ValueError:
                pass  # a run of white space too long for its pattern matcher
        return np.array(self.tk.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def merges_to_itself(self) -> bool:
        """Whether the library encodes the text of every token as that token alone, by its merges, without cutting.

        The model reads the bytes' stand-ins, so tokens of torn characters are tried too.
        """
        bpe = self.tk.model
        return all(t in self.special or [x.id for x in bpe.tokenize(t)] == [i] for t, i in self.tk.get_vocab().items())

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        return [self.ids(t).astype(self.dtype).tobytes() for t in texts]


#: Fixed value: the pattern that byte-level pre-tokenization splits by.
_BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _rank_encoder(spec: dict):
    """The vocabulary as ranks, or None if it is not plain byte-level merging in the order of its ids."""
    import tiktoken

    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not spec.get("normalizer")
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    if model.get("type") != "BPE" or not plain or odd:
        return None
    vocab, byte_of = model["vocab"], {c: b for b, c in _byte_alphabet().items()}
    made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items() if all(c in byte_of for c in t)}
    if any(x >= y for x, y in zip(made, made[1:])) or len(ranks) != len(made) + 256 or any(bytes([b]) not in ranks for b in range(256)):
        return None
    return tiktoken.Encoding("ranked", pat_str=_BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})


class SpeculativeBpe:
    """Byte-pair encoding by greedy longest match, checked pair by pair; words that fail are merged exactly.

    A segmentation into tokens is the merge result if every token merges to itself and, for every adjacent
    pair (a, b), merging the concatenation gives (a, b) again. The pair check undoes the merges of both sides
    in reverse order and looks for a merge across the border that would have come first.
    """

    END = "</w>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tk = Tokenizer.from_file(path)
        self.tk.no_truncation()
        self.tk.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        n = max(self.token) + 1
        self.size = n
        left, right, rank = np.full(n, -1), np.full(n, -1), np.full(n, -1)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        keys, ranks = [], []
        for r, (a, b) in enumerate(merges):
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.merge[x, y] = (r, z)
            keys.append(x * n + y)
            ranks.append(r)
            if rank[z] < 0:
                left[z], right[z], rank[z] = x, y, r
        order = np.argsort(keys)
        self.keys, self.ranks = np.array(keys, dtype=np.int64)[order], np.array(ranks, dtype=np.int64)[order]
        self.left, self.right, self.rank = left, right, rank
        self.alphabet = _byte_alphabet()
        # Tokens that merging their own symbols reproduces; only these may be proposed.
        self.usable = {t: i for t, i in self.vocab.items() if i not in self._special_ids() and self._exact(self._symbols(t)) == [i]}
        self.longest = max(map(len, self.usable))
        self.cache: dict[str, tuple[int, ...]] = {}
        self.exact_words = 0

    def _special_ids(self) -> set[int]:
        return set(self.special.values())

    def _symbols(self, t: str) -> list[int]:
        body, end = (t[: -len(self.END)], self.END) if t.endswith(self.END) and t != self.END else (t, "")
        chars = list(body)
        if end:
            chars[-1] += end
        return [self.vocab[c] for c in chars if c in self.vocab]

    def _exact(self, ids: list[int]) -> list[int]:
        """Merge the lowest-ranked pair, leftmost first, until no pair is left; a heap keeps long words near-linear."""
        ids, n = list(ids), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.merge[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merge]
        heapify(heap)
        while heap:
            _, i, x, y = heappop(heap)
            j = after[i] if ids[i] == x else n
            if j >= n or ids[j] != y:
                continue  # one side has merged since
            ids[i], ids[j] = self.merge[x, y][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for at, right in ((before[i], i), (i, k)):
                if at >= 0 and right < n and (p := (ids[at], ids[right])) in self.merge:
                    heappush(heap, (self.merge[p][0], at, *p))
        return [x for x in ids if x >= 0]

    def _greedy(self, w: str) -> list[int] | None:
        usable, out, p, n = self.usable, [], 0, len(w)
        while p < n:
            i = usable.get(w[p:] + self.END) if n - p <= self.longest else None
            if i is not None:
                out.append(i)
                return out
            for q in range(min(n - 1, p + self.longest), p, -1):
                i = usable.get(w[p:q])
                if i is not None:
                    out.append(i)
                    p = q
                    break
            else:
                return None
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For every pair at once: does merging the concatenation of the two tokens leave them as they are?"""
        never = np.iinfo(np.int64).max
        x, y = a.astype(np.int64), b.astype(np.int64)
        px, py = np.full(len(x), never), np.full(len(x), never)
        ok, live = np.ones(len(x), dtype=bool), np.arange(len(x))
        while len(live):
            key = x[live] * self.size + y[live]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            r = np.where(self.keys[at] == key, self.ranks[at], never)
            bad = (r < px[live]) & (r <= py[live]) & (r < never)
            ok[live[bad]] = False
            live = live[~bad]
            rx, ry = self.rank[x[live]], self.rank[y[live]]
            live, rx, ry = (v[(rx >= 0) | (ry >= 0)] for v in (live, rx, ry))
            undo_x = rx > ry
            u = live[undo_x]
            px[u], x[u] = rx[undo_x], self.right[x[u]]
            u = live[~undo_x]
            py[u], y[u] = ry[~undo_x], self.left[y[u]]
        return ok

    def _learn(self, words: list[str]) -> None:
        names = ["".join(map(self.alphabet.__getitem__, w.encode())) for w in words]
        proposed = [self._greedy(w) for w in names]
        sizes = np.array([len(p) if p else 0 for p in proposed], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(p or () for p in proposed), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[:-1] == owner[1:]) if len(flat) else np.array([], dtype=np.int64)
        wrong = np.zeros(len(words), dtype=bool)
        if len(inner):
            wrong[owner[inner[~self.compatible(flat[inner], flat[inner + 1])]]] = True
        for w, name, p, bad in zip(words, names, proposed, wrong):
            if bad or p is None:
                self.exact_words += 1
                p = self._exact(self._symbols(name + self.END))
            self.cache[w] = tuple(p)

    def _words(self, text: str) -> list[str]:
        if not _FAST.search(text):
            n = unicodedata.normalize("NFC", text).lower()
            if not _FAST.search(n):  # some capitals lower to letters beyond the class
                return _LOWER_WORDS.findall(n)
        n = self.tk.normalizer.normalize_str(text)
        return [n[a:b] for _, (a, b) in self.tk.pre_tokenizer.pre_tokenize_str(n)]

    def _pieces(self, text: str) -> list:
        """Words of a text, with the ids of special tokens that it spells out."""
        if not any(s in text for s in self.special):
            return self._words(text)
        out: list = []
        for part in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text):
            out += [self.special[part]] if part in self.special else self._words(part)
        return out

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        cut = [self._pieces(t) for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        cache = self.cache
        missing = list({w for c in cut for w in c if w not in cache and type(w) is str})
        for i in range(0, len(missing), 20_000):
            self._learn(missing[i : i + 20_000])
        return [list(chain.from_iterable((w,) if type(w) is int else cache[w] for w in c)) if any(s in t for s in self.special) else list(chain.from_iterable(map(cache.__getitem__, c))) for t, c in zip(texts, cut)]

    def decode(self, ids: list[int]) -> str:
        """Without a decoder the library joins the tokens' strings by one space; unknown ids are left out."""
        try:
            return " ".join(map(self.token.__getitem__, ids))
        except KeyError:
            return " ".join(self.token[i] for i in ids if i in self.token)


_LOADED: dict = {}


def loaded(kind, path: str):
    """One encoder per worker process."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]
