"""Exact byte-pair encoding by dynamic programming over prefixes.

For every prefix of a pre-token there is exactly one token with which its encoding can end: a token that matches a suffix
of the prefix and is compatible with the last token of what stands before it. A suffix automaton over the vocabulary
gives the matching tokens of each position in amortised constant time; a pair test that walks back through the merges
of two neighbours decides compatibility. The table of last tokens gives the ids by following it backwards, and the table
of counts gives the exact number of tokens of every prefix.

The tables of a vocabulary are built once for each Python worker; the caches below have fixed limits, so the memory of
a worker doesn't grow with the corpus.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import cached_property, lru_cache
from itertools import chain, repeat

import numpy as np
import regex

from .shared import Cache, holds

#: Bytes that the results of words may take in a worker; and entries after which the smaller tables are emptied. These change speed and never a result.
CACHE_BYTES = 96 << 20
PAIRS, HEADS = 200_000, 30_000

#: Below this code point no character combines with another, and the regex library agrees with the tokenizers library.
SIMPLE = "ɐ"
#: Pre-tokens, as the vocabulary files' pre-tokenizers define them (fixed values): of those that split by a pattern, and of plain byte-level ones.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_HEAD = 5  # symbols whose part of the table is kept
_END = 256  # added to the last byte of a word where the vocabulary marks ends of words


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if it is printable, else the next free one from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


@lru_cache(maxsize=2)
def plain_pattern(pattern: str) -> re.Pattern:
    """The pattern for characters below SIMPLE, as one that Python's own library takes, with its classes spelled out: it is twice as fast."""
    of = lambda kind: "".join(f"\\u{c:04x}" for c in range(ord(SIMPLE)) if regex.fullmatch(kind, chr(c)))
    letter, number, space = of(r"\p{L}"), of(r"\p{N}"), of(r"\s")
    first = next(x for x in pattern.split("|") if x.endswith(("[\\p{L}]+", "?\\p{L}+")))
    pattern = "|".join([first, *(x for x in pattern.split("|") if x != first)])  # runs of letters begin as no other pre-token does, so they may as well be tried first
    for a, b in ((r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]"), (r"[\p{L}]", f"[{letter}]"), (r"[\p{N}]", f"[{number}]"), (r"\p{L}", f"[{letter}]"), (r"\p{N}", f"[{number}]"), (r"\S", f"[^{space}]"), (r"\s", f"[{space}]")):
        pattern = pattern.replace(a, b)
    return re.compile(pattern)


def is_plain(text: str) -> bool:
    """Are all characters below SIMPLE?"""
    if text.isascii():
        return True
    try:
        return bool(text.encode("latin-1"))  # much faster than looking for the largest one
    except UnicodeEncodeError:
        return max(text) < SIMPLE


def pattern_of(spec: dict) -> str:
    """The pre-tokens' pattern of a vocabulary file, if it is one of the two known here and text is prepared for it in the known way."""
    pre, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    level = {"add_prefix_space": False}
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and normal is None and not spec["model"].get("end_of_word_suffix"):
        return BYTE_PATTERN
    parts = pre.get("pretokenizers", [])
    known = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
    if len(parts) == 2 and parts[0].get("pattern") == {"Regex": WORD_PATTERN} and parts[0].get("behavior") == "Removed" and parts[0].get("invert") and parts[1].get("type") == "ByteLevel" and parts[1].items() >= level.items() and not parts[1].get("use_regex") and normal == known and spec["model"].get("end_of_word_suffix"):
        return WORD_PATTERN
    raise ValueError("the vocabulary file prepares text in a way that isn't supported")


class SuffixAutomaton:
    """Of all substrings of the words given, which share prefixes in a trie. `ends` lists, for each state, the words that are suffixes of what it stands for, longest first."""

    def __init__(self, words: list[tuple[tuple[int, ...], int]]):
        self.next: dict[int, int] = {}
        self.link, self.length = [-1], [0]
        out: list[list[int]] = [[]]
        where: dict[tuple[int, ...], int] = {(): 0}
        for word, _ in sorted(words, key=lambda x: len(x[0])):
            for n in range(1, len(word) + 1):
                if word[:n] not in where:
                    where[word[:n]] = self._extend(where[word[: n - 1]], word[n - 1], out)
        own: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for word, token in words:
            own[where[word]].append((len(word), token))
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            below = self.ends[self.link[state]] if state else ()
            self.ends[state] = (*sorted(own[state], reverse=True), *below) if own[state] else below

    def _state(self, length: int, link: int, out: list[list[int]]) -> int:
        self.link.append(link)
        self.length.append(length)
        out.append([])
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int, out: list[list[int]]) -> int:
        """The state q holds strings of several lengths; those up to that of p and c get a state of their own."""
        clone = self._state(self.length[p] + 1, self.link[q], out)
        out[clone] = list(out[q])
        for x in out[q]:
            self.next[clone << 9 | x] = self.next[q << 9 | x]
        self.link[q] = clone
        while p >= 0 and self.next.get(p << 9 | c) == q:
            self.next[p << 9 | c] = clone
            p = self.link[p]
        return clone

    def _extend(self, p: int, c: int, out: list[list[int]]) -> int:
        q = self.next.get(p << 9 | c)
        if q is not None:
            return q if self.length[q] == self.length[p] + 1 else self._split(p, q, c, out)
        new = self._state(self.length[p] + 1, 0, out)
        while p >= 0 and p << 9 | c not in self.next:
            self.next[p << 9 | c] = new
            out[p].append(c)
            p = self.link[p]
        if p >= 0:
            q = self.next[p << 9 | c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c, out)
        return new


class Bpe:
    """A vocabulary file of the tokenizers library whose model is byte-level BPE: its texts' ids, counts and decoded texts.

    Special strings inside a text become their ids, as is that library's default. Nothing is truncated or padded.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.path = spec["model"], path
        self.pattern = plain_pattern(pattern_of(spec))
        self.marks_ends = bool(model.get("end_of_word_suffix"))
        suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in spec["added_tokens"]):
            raise ValueError("added tokens that strip or need whole words aren't supported")
        self.text_of = {i: t for t, i in [*vocab.items(), *self.specials.items()]}
        self.joined = spec["decoder"] is None
        self.normalizes = bool(spec["normalizer"])
        self.special_pattern = re.compile("|".join(re.escape(x) for x in sorted(self.specials, key=len, reverse=True))) if self.specials else None
        self._model, self._automaton = model, None
        self.pairs: dict[int, bool] = {}
        self.heads: dict[bytes, tuple] = {}
        self.words, self.tables = Cache(self.ids_of_word, CACHE_BYTES), Cache(self._table_of_word, CACHE_BYTES)

    @property
    def automaton(self) -> SuffixAutomaton:
        """Made when it is first needed; decoding does without."""
        if self._automaton is None:
            self._build()
        return self._automaton

    @cached_property
    def library(self):
        """For letters that aren't plain."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _build(self) -> None:
        model, letters = self._model, byte_letters()
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        base = {b: vocab[c] for b, c in enumerate(letters)} | ({b + _END: vocab[c + suffix] for b, c in enumerate(letters)} if suffix else {})
        symbols: dict[int, tuple[int, ...]] = {t: (s,) for s, t in base.items()}
        self.rank, self.left, self.right = dict.fromkeys(base.values(), -1), {}, {}
        self.merge: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            token, x, y = vocab[a + b], vocab[a], vocab[b]
            if token in self.rank or x not in self.rank or y not in self.rank:
                raise ValueError(f"merge {rank} makes a token a second time or from later ones")
            self.rank[token], self.left[token], self.right[token] = rank, x, y
            self.merge[x << 20 | y] = rank
            symbols[token] = symbols[x] + symbols[y]
        whole = set(base.values())
        for token, rank in self.rank.items():  # in the order of the merges, so parts come first
            if rank >= 0 and self.left[token] in whole and self.right[token] in whole and self._compatible(self.left[token], self.right[token], rank):
                whole.add(token)
        self._automaton, self._model = SuffixAutomaton([(symbols[t], t) for t in whole]), None

    def _compatible(self, a: int, b: int, until: int) -> bool:
        """Do the merges of rank under `until` that make a and b, side by side, leave the border between them alone?

        Goes back in time from the finished tokens. While a piece to the left and one to the right stand beside each
        other, their own merge would happen if its rank is under that at which the left one is used up, and not over
        that at which the right one is: of equal merges the leftmost is first.
        """
        rank, merge = self.rank, self.merge
        used_a = used_b = until
        while True:
            m = merge.get(a << 20 | b)
            if m is not None and m < used_a and (m <= used_b if used_b < until else m < until):
                return False
            ra, rb = rank[a], rank[b]
            if ra > rb:
                used_a, a = ra, self.right[a]
            elif rb >= 0:
                used_b, b = rb, self.left[b]
            else:
                return True

    def table(self, symbols: list[int]) -> tuple[list[int], list[int], list[int]]:
        """For every prefix of a pre-token: its last token, where that starts, and its number of tokens. Index 0: the empty prefix."""
        a, pairs = self.automaton, self.pairs
        step, link, length, ends = a.next, a.link, a.length, a.ends
        last, start, count = [-1], [0], [0]
        state = matched = at = 0
        head = None
        if len(symbols) > _HEAD:  # what stands for a word's first letters holds for all words that begin so
            head = bytes(symbols[:_HEAD])
            if (known := self.heads.get(head)) is not None:
                last, start, count = known[0][:], known[1][:], known[2][:]
                state, matched, at, head = known[3], known[4], _HEAD, None
        for i in range(at + 1, len(symbols) + 1):
            if head is not None and i == _HEAD + 1:
                if len(self.heads) >= HEADS:
                    self.heads.clear()
                self.heads[head] = last[:], start[:], count[:], state, matched
            c = symbols[i - 1]
            while (to := step.get(state << 9 | c)) is None:
                state = link[state]
                matched = length[state]
            state, matched = to, matched + 1
            for n, token in ends[state]:
                if n > matched:
                    continue
                j = i - n
                if j:
                    key = last[j] << 20 | token
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        fits = pairs[key] = self._compatible(last[j], token, 1 << 40)
                    if not fits:
                        continue
                last.append(token)
                start.append(j)
                count.append(count[j] + 1)
                break
        return last, start, count

    def symbols(self, word: str) -> list[int]:
        out = list(word.encode("utf-8", "surrogatepass"))
        if self.marks_ends and out:
            out[-1] += _END
        return out

    def ids_of_word(self, word: str) -> bytes:
        """The ids of one pre-token, as native unsigned 32-bit integers, read off the table of last tokens from its end."""
        last, start, _ = self.table(self.symbols(word))
        ids, i = array("I"), len(last) - 1
        while i:
            ids.append(last[i])
            i = start[i]
        ids.reverse()
        return ids.tobytes()

    def _table_of_word(self, word: str) -> bytes | array:
        """The number of tokens of every prefix of a pre-token that ends between two characters, the empty one first. One byte each, if that is enough."""
        count = self.table(self.symbols(word))[2]
        if not word.isascii():
            count = [0, *(count[i] for i in np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in word]).tolist())]
        return bytes(count) if count[-1] < 256 else array("I", count)

    def pretokens(self, text: str) -> list[str]:
        """Of a text without special strings. The rules for plain letters are applied here, all others by the library."""
        if is_plain(text):
            return self.pattern.findall(text.lower() if self.marks_ends else text)
        out: list[str] = []
        for chunk in chunks_of(text, self.marks_ends):
            if is_plain(chunk):
                out += self.pattern.findall(chunk.lower() if self.marks_ends else chunk)
                continue
            normal = self.library.normalizer.normalize_str(chunk) if self.normalizes else chunk
            out += [bytes(map(self.byte_of.__getitem__, x)).decode() for x, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def segments(self, text: str) -> list[tuple[str, int | None]]:
        """The text's parts in order, and of each the id if it is a special string."""
        out, at = [], 0
        if self.special_pattern:
            for m in self.special_pattern.finditer(text):
                out += [(text[at : m.start()], None), (m[0], self.specials[m[0]])]
                at = m.end()
        return [*out, (text[at:], None)]

    def ids(self, text: str) -> bytes:
        """The ids of a whole text, as native unsigned 32-bit integers."""
        words, out = self.words, []
        for part, special in self.segments(text):
            out += [array("I", [special]).tobytes()] if special is not None else map(words.__getitem__, self.pretokens(part))
        return b"".join(out)

    def decode(self, ids) -> str:
        """As the library does with skip_special_tokens=False."""
        try:
            out = (" " if self.joined else "").join(map(self.text_of.__getitem__, ids))
        except KeyError as e:
            raise ValueError(f"{e.args[0]} is no token's id") from None
        if self.joined:
            return out
        try:
            return bytes(map(self.byte_of.__getitem__, out)).decode("utf-8", "replace")
        except KeyError:  # a special string with characters of its own
            return self.library.decode(list(ids), skip_special_tokens=False)


_odd_space = re.compile(r"\s\s|^\s|\s\Z")
_split_space = re.compile(r"(?<=\S) (?=\S)")


def chunks_of(text: str, drops_space: bool) -> list[str]:
    """Cuts a text without special strings where no pre-token can cross.

    Where white space is dropped, that is at white space (but not at the separators 1C to 1F, which Python counts as
    white space and the patterns don't). Else it is before a single blank between two visible characters.
    """
    if drops_space:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [text]
        return text.split()
    if not text:
        return []
    first, *rest = _split_space.split(text) if _odd_space.search(text) else text.split(" ")
    return [first, *[" " + x for x in rest]]


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    """One for each worker and file."""
    return Bpe(path)


class LibraryEncoder:
    """Ids of whole texts from the tokenizers library itself. Each pre-token of plain letters is sent to it once, those of many texts in one call; no tables are built."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.pattern = plain_pattern(pattern_of(spec))
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.marks_ends = bool(suffix)
        vocab = spec["model"]["vocab"]
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)
        self.is_end[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        self.model, self.letters = Tokenizer(self.library.model), dict(enumerate(byte_letters()))
        self.specials = re.compile("|".join(re.escape(x["content"]) for x in spec["added_tokens"]) or r"(?!)")
        self._forget()

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        """Of each word its number; by number, where its ids begin in `pool` and how many they are."""
        self.words: dict[str, int] = {}
        self.used = self.filled = 0
        self.starts, self.lengths, self.pool = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32)

    def _model_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that are one pre-token each, one after the other, and how many each has. They go to the library's model past the preparation of text, which is done."""
        letters = [w if w.isascii() and w.isalpha() else w.encode().decode("latin-1").translate(self.letters) for w in words]
        if not self.marks_ends:
            found = [x.ids for x in self.model.encode_batch_fast([[w] for w in letters], is_pretokenized=True, add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        ids = np.array(self.model.encode_batch_fast([letters], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
        return ids, np.diff(np.flatnonzero(self.is_end[ids]) + 1, prepend=0)  # every word ends with the one of its tokens that marks an end

    def _learn(self, words: list[str]) -> None:
        room = lambda x, n: x if n <= len(x) else np.concatenate([x, np.zeros(max(n - len(x), len(x) // 2), x.dtype)])
        for at in range(0, len(words), 5000):
            some = words[at : at + 5000]
            ids, n = self._model_ids(some)
            first, last = len(self.words), len(self.words) + len(some)
            self.starts, self.lengths, self.pool = room(self.starts, last), room(self.lengths, last), room(self.pool, self.filled + len(ids))
            self.starts[first:last], self.lengths[first:last] = self.filled + np.cumsum(n) - n, n
            self.pool[self.filled : self.filled + len(ids)] = ids
            self.filled += len(ids)
            self.used += 260 * len(some) + sum(map(len, some)) + 4 * len(ids)  # with Python's objects and the dictionary's places
            self.words.update(zip(some, range(first, last), strict=True))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Of each text, as native unsigned 32-bit integers. A text with special strings or with letters that aren't plain goes to the library whole. Words are looked up once; when they take CACHE_BYTES, all are forgotten."""
        plain = [is_plain(t) and not self.specials.search(t) for t in texts]
        parts = [self.pattern.findall(t.lower() if self.marks_ends else t) if p else [] for t, p in zip(texts, plain, strict=True)]
        words = list(chain.from_iterable(parts))
        if self.used > CACHE_BYTES:
            self._forget()
        which = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        if len(new := np.flatnonzero(which < 0).tolist()):
            self._learn(list(dict.fromkeys(words[i] for i in new)))
            which[new] = [self.words[words[i]] for i in new]
        n = self.lengths[which]
        ends = np.cumsum(n)
        place = np.repeat(self.starts[which] - ends + n, n)
        place += np.arange(len(place))
        found = self.pool[place]
        del words, which, n, place
        ends = np.concatenate([[0], ends])[np.cumsum([0, *map(len, parts)])].tolist()  # of texts
        whole = iter(self._encode([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [found[a:b].tobytes() if p else next(whole) for a, b, p in zip(ends[:-1], ends[1:], plain, strict=True)]


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def _release() -> None:
    bpe.cache_clear()
    library_encoder.cache_clear()


holds("bpe", _release)
