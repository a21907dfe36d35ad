"""Exact token counts of every prefix of a text by dynamic programming.

Inside a word of the tokenizer's pattern, let last[i] be the last token of the encoding of its first i bytes. Among
the tokens that end at byte i there is exactly one, t, that encoding leaves as it is after last[i - len(t)], the last
token of the rest; so last[i] = t and count[i] = count[i - len(t)] + 1. Whether encoding leaves a pair of tokens alone is
asked of the tokenizer's model once per pair.

Words add up to pieces, pieces to texts (`pieces.cut`): a prefix that ends inside a piece has the tokens of all pieces
before it and those of the prefix of that piece. Where the pattern would split a prefix in another way than
the full text (white space before a word, contractions, special tokens), the prefix's own words are counted.
"""

from array import array
from bisect import bisect_left
from itertools import accumulate
from os.path import commonprefix

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from pulseloom.llm import pieces
from pulseloom.llm.common import map_text

#: Words whose counts a worker remembers, twice; eight times as many pairs of tokens.
CACHE = 200_000
WHITE = regex.compile(r"\s*")
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_LOADED: dict[str, "Counter"] = {}


class Counter:
    """Counts by one vocabulary. `after[s][t]` says whether encoding leaves token t alone after token s; `start[t]`,
    whether the bytes of t are encoded as t."""

    def __init__(self, path: str):
        self.bpe = pieces.load(path)
        added = self.bpe.tokenizer.get_added_tokens_decoder()
        self.ids = {b: i for i, b in enumerate(self.bpe.bytes) if b and i not in added}
        self.longest = max(map(len, self.ids))
        self.start: dict[bytes, bool] = {}
        self.after: dict[bytes, dict[bytes, bool]] = {}
        self.pairs = 0
        self.words: dict[str, bytes | array] = {}
        self.old: dict[str, bytes | array] = {}
        self.known: dict[str, int] = {}
        special = sorted(self.bpe.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def left_alone(self, known: dict, s: bytes, t: bytes) -> bool:
        """Ask the model whether the encoding of s + t is s, t, and remember it in `known`."""
        made = self.bpe.model.tokenize((s + t).decode("latin-1").translate(self.bpe.letters))
        known[t] = [k.id for k in made] == [self.ids[x] for x in (s, t) if x]
        self.pairs += 1
        return known[t]

    def learn(self, words) -> None:
        """Counts of words of the pattern. In sorted order, a word goes on from the prefix it shares with the last one."""
        unseen = [w for w in words if w not in self.words]
        if len(self.words) + len(unseen) > CACHE:  # what was in use stays for one more filling
            self.old, self.words = self.words, {}
            unseen = list(words)
        known = {w: self.old[w] for w in unseen if w in self.old}
        self.words |= known
        missing = [w for w in unseen if w not in known]
        if self.pairs > 8 * CACHE:
            self.start, self.after, self.pairs = {}, {}, 0
        ids, after, longest = self.ids, self.after, self.longest
        count, last, tokens, before = [0], [self.start], [b""], b""
        for data, word in sorted((w.encode(), w) for w in missing):
            k = len(commonprefix((before, data)))
            del count[k + 1 :], last[k + 1 :], tokens[k + 1 :]
            before = data
            for i in range(k + 1, len(data) + 1):
                for j in range(i - 1, max(-1, i - longest - 1), -1):
                    t = data[j:i]
                    if t in ids:
                        known = last[j]
                        if known.get(t) or t not in known and self.left_alone(known, tokens[j], t):
                            count.append(count[j] + 1)
                            if t not in after:
                                after[t] = {}
                            last.append(after[t])
                            tokens.append(t)
                            break
                else:
                    raise ValueError("the vocabulary lacks a byte")
            by_char = count[1:] if len(data) == len(word) else [count[e] for e in accumulate(len(c.encode()) for c in word)]
            # a character may have several tokens, and a prefix more than the whole word
            self.words[word] = bytes(by_char) if max(by_char, default=0) < 256 else array("I", by_char)

    def chars(self, word: str) -> list[int]:
        """Counts after each character of a word, from 1 character on."""
        got = self.words.get(word)
        if got is None:
            self.learn([word])
            got = self.words[word] if len(word) < 256 else self.words.pop(word)
        return list(got)

    def head(self, piece: str) -> list[int]:
        """Tokens of the first 1, 2, .. characters of a piece, as texts of their own."""
        return self.chars(piece) if piece in self.words else self._head(piece)

    def _head(self, piece: str) -> list[int]:
        out: list[int] = []
        base, at = 0, 0
        seen: dict[str, list[int]] = {}  # what stands between special tokens is often the same
        for m in self.special.finditer(piece) if self.special else ():
            part = piece[at : m.end()]
            if part not in seen:
                before = part[: m.start() - at]
                seen[part] = self._plain(part[:-1]) + [(self._plain(before)[-1] if before else 0) + 1]
            out += [base + n for n in seen[part]]
            base, at = out[-1], m.end()
        return out + [base + n for n in self._plain(piece[at:])]

    def _plain(self, text: str) -> list[int]:
        """Counts of a text without special tokens: unit by unit, a unit being white space and the word after it."""
        out: list[int] = []
        base, at = 0, 0
        for m in self.bpe.pattern.finditer(text):
            e = m.end()
            if WHITE.fullmatch(m.group()) and e < len(text):
                continue  # with the word after it, since a prefix may end inside the white space
            if m.start() == at and m.group() not in CONTRACTIONS:
                counts = self.chars(m.group())
            else:
                *before, final = self.bpe.pattern.findall(text[at:e])
                run = WHITE.match(text[at:e]).end()
                done = sum(self.chars(w)[-1] for w in before)
                counts = self.chars(text[at : at + run]) if run else []
                if final in CONTRACTIONS:
                    counts += [done + self._alone(final[:k]) for k in range(1, len(final))] + [done + self.chars(final)[-1]]
                else:
                    counts += [done + c for c in self.chars(final)[at + run - (e - len(final)) :]]
            out += [base + c for c in counts]
            base, at = out[-1], e
        return out

    def _alone(self, text: str) -> int:
        return sum(self.chars(w)[-1] for w in self.bpe.pattern.findall(text))

    def totals(self, parts: set[str]) -> dict[str, int]:
        """Tokens of whole pieces; a word and the marks after it are looked up apart."""
        known = self.known
        if len(known) > CACHE:
            known.clear()
        missing = [p for p in parts if p not in known]
        cores = [p.rstrip(pieces.MARKS) for p in missing]
        simple = [(p, c, p[len(c) :]) for p, c in zip(missing, cores) if c[:1] == " " and c[1:].isalpha()]
        self.learn({c for _, c, _ in simple} | {m for _, _, m in simple if m})
        words = self.words
        for p, c, m in simple:
            known[p] = words[c][-1] + words[m][-1] if m else words[c][-1]
        for p in missing:
            if p not in known:
                known[p] = self.head(p)[-1] if p else 0
        return known

    def text(self, text: str, limit: int) -> tuple[int, int]:
        """Tokens of a text, and the longest prefix in characters that has at most `limit` tokens."""
        return self.texts(pa.array([text]), limit)[0]

    def texts(self, texts: pa.Array, limit: int) -> list[tuple[int, int]]:
        """`text` of every text: piece counts are added up; the piece in which the limit falls is looked at."""
        p = pieces.Pieces(texts)
        self.learn([w for w in p.words if w])
        size = np.array([*(self.words[w][-1] if w else 0 for w in p.words), *(self.head(x)[-1] if x else 0 for x in p.others)], np.int64)
        ends = np.concatenate([[0], np.cumsum(size[p.index])])
        totals = (ends[p.offsets[1:]] - ends[p.offsets[:-1]]).tolist()
        out = []
        for k, n in enumerate(totals):
            text = texts[k].as_py() or ""
            out.append((n, len(text) if n <= limit else self.truncated(spaced(text), limit)))
        return out

    def truncated(self, parts: list[str], limit: int) -> int:
        """Characters of the longest prefix of a text over the limit that is within it."""
        known = self.totals(set(parts))
        ends = list(accumulate(map(known.__getitem__, parts)))
        k = bisect_left(ends, limit)  # the pieces before k leave something of the limit
        chars = sum(map(len, parts[:k]))
        while True:
            base = ends[k - 1] if k else 0
            fits = [o for o, c in enumerate(self.head(parts[k]) if parts[k] else [], 1) if base + c <= limit]
            if fits or not k or base <= limit:
                return chars + (fits[-1] if fits else 0)
            k -= 1
            chars -= len(parts[k])

    def table(self, text: str) -> list[int]:
        """Tokens of the first 1, 2, .. characters of a text."""
        out: list[int] = []
        for p in spaced(text):
            base = out[-1] if out else 0
            out += [base + c for c in (self.head(p) if p else [])]
        return out


def spaced(text: str) -> list[str]:
    """The pieces of a text, each but the first with the space that starts it."""
    first, *rest = pieces.cut(text)
    return [first, *[" " + p for p in rest]]


def load(path: str) -> Counter:
    if path not in _LOADED:
        _LOADED[path] = Counter(path)
    return _LOADED[path]


def count(docs: DataFrame, limit: int = 1024, vocabulary: str = pieces.VOCABULARY) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, limit_chars of every row.

    `limit_chars` is the number of characters of the longest prefix that has at most `limit` tokens. Nulls count as
    empty texts (no token), repeated rows are kept, an empty table gives an empty result.
    """
    path = public_tokenizers.path(vocabulary)

    def fn(texts):
        made = load(path).texts(texts, limit)
        return {"n_bytes": pc.binary_length(texts).cast(pa.int64()), "n_tokens": [n for n, _ in made], "over_limit": [n > limit for n, _ in made], "limit_chars": [c for _, c in made]}

    return map_text(docs, fn, "n_bytes long, n_tokens long, over_limit boolean, limit_chars long", raw=True)


def prefix_table(docs: DataFrame, vocabulary: str = pieces.VOCABULARY) -> DataFrame:
    """doc_id and `counts`: the tokens of every prefix, element k for the first k + 1 characters.

    With it, `element_at(counts, k)` answers what a truncation to k characters costs, and a budget needs no encoding.
    """
    path = public_tokenizers.path(vocabulary)
    return map_text(docs, lambda texts: {"counts": [load(path).table(t) for t in texts]}, "counts array<int>")
