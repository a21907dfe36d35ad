"""Exact byte-level BPE by cached pieces.

A space that follows a character which is no white space always starts a new word of the tokenizer's pattern, so a
text may be cut there and its pieces encoded alone. The tokenizers library encodes every different piece once; those
that many batches have stay in a bounded dictionary of the worker.
"""

import os
import re
from array import array

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
import numpy as np  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

VOCABULARY = "byte_bpe_50k.json"
#: Words a worker remembers; the cache is emptied when it is full.
CACHE = 250_000
_AFTER_SPACE = re.compile(r"\s ")
#: Any character that Unicode or Python takes as white space, then a space.
_ODD = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
_CUT = re.compile(r"(?<=\S) ")
#: Marks that never join letters or digits of the pattern.
MARKS = ".,!?;:*$#%&)"
#: The letter that stands for a space in the model.
SPACE_LETTER = chr(256 + 32)
_LOADED: dict[str, "Bpe"] = {}


def byte_letters() -> dict[int, str]:
    """The printable letter for each byte: bytes that print stand for themselves, the others follow from 256 on."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Bpe:
    """One vocabulary file in this process."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.letters = byte_letters()
        back = {c: b for b, c in self.letters.items()}
        self.vocabulary = self.tokenizer.get_vocab()
        self.bytes: list[bytes] = [b""] * (max(self.vocabulary.values()) + 1)
        for t, i in self.vocabulary.items():
            self.bytes[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
        self.bytes_at = np.array([*self.bytes, None], object)[:-1]
        self.decimal_at = np.array([*(b"%d" % i for i in range(len(self.bytes))), None], object)[:-1]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {"": b""}
        self.known: Known | None = None

    def letters_of(self, text: str) -> str:
        return text.encode().decode("latin-1").translate(self.letters)

    def made(self, word: str) -> bytes:
        """Ids (little-endian, 4 bytes each) of one word of the pattern, by the model."""
        text = SPACE_LETTER + word[1:] if word[:1] == " " and word.isascii() and word[1:].isalpha() else self.letters_of(word)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def word(self, word: str) -> bytes:
        """`made`, remembered for words of usual length."""
        got = self.words.get(word)
        if got is None:
            got = self.made(word)
            if len(word) < 64:
                if len(self.words) >= CACHE:
                    self.words = {"": b""}
                self.words[word] = got
        return got

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def encode(self, text: str) -> bytes:
        """Ids of any text."""
        if self.has_special(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.word, self.pattern.findall(text)))

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decode gives, special tokens kept."""
        return b"".join(self.bytes_at[ids].tolist()).decode("utf-8", "replace")

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids as decimals, joined by commas."""
        return b",".join(self.decimal_at[ids].tolist())


def load(path: str) -> Bpe:
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def cut(text: str) -> list[str]:
    """Pieces between the cuts, without the space that starts every piece but the first."""
    return _CUT.split(text) if _AFTER_SPACE.search(text) else text.split(" ")


class Pieces:
    """The pieces of a batch of texts as entries of a table of different strings, each looked up once.

    `words` are words of the pattern (a space and letters, or marks), `others` any other pieces. Every piece of a text is two
    entries: a word and the marks after it, or a piece and nothing. Entry number n stands for words[n] or, after these,
    others[n - len(words)]; text k has the entries index[offsets[k]] .. index[offsets[k + 1] - 1].
    """

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        numbers = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        lists = pc.split_pattern(pc.if_else(odd, "", texts) if numbers else texts, " ")
        starts = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        whole = coded.dictionary
        cores = pc.utf8_rtrim(whole, MARKS)
        alpha = pc.utf8_is_alpha(cores)
        simple = np.flatnonzero(alpha.to_numpy(zero_copy_only=False))
        core = pc.binary_join_element_wise("", cores.filter(alpha), " ").dictionary_encode()
        marks = pc.struct_field(pc.extract_regex(whole.filter(alpha), "(?P<m>[" + MARKS + "]*)$"), 0).dictionary_encode()
        self.words = core.dictionary.to_pylist() + marks.dictionary.to_pylist()
        n_core, n_words = len(core.dictionary), len(self.words)
        rest = np.setdiff1d(np.arange(len(whole)), simple)
        texts_of_rest = whole.take(pa.array(rest)).to_pylist()
        self.others = [" " + x for x in texts_of_rest] + [""]
        blank = n_words + len(rest)
        entries = np.full((len(whole), 2), blank, np.int64)
        entries[simple, 0] = core.indices.to_numpy()
        entries[simple, 1] = n_core + marks.indices.to_numpy().astype(np.int64)
        entries[rest, 0] = n_words + np.arange(len(rest))
        pairs = entries[at]
        first = whole.take(pa.array(at[starts[:-1]])).to_pylist()
        pairs[starts[:-1], 0] = blank + 1 + np.arange(len(first))
        pairs[starts[:-1], 1] = blank
        self.index, self.offsets = pairs.reshape(-1), 2 * starts
        self.others += first
        for k in numbers:  # at the end of the table, and in place of the empty first piece
            parts = cut(texts[k].as_py())
            self._replace(k, [parts[0], *[" " + x for x in parts[1:]]])

    def _replace(self, k: int, parts: list[str]) -> None:
        base = len(self.words) + len(self.others)
        self.others += parts
        a, b = self.offsets[k], self.offsets[k + 1]
        self.index = np.concatenate([self.index[:a], base + np.arange(len(parts)), self.index[b:]])
        self.offsets = np.concatenate([self.offsets[: k + 1], self.offsets[k + 1 :] + len(parts) - (b - a)])


class Known:
    """Ids of words and other pieces met so far, in an Arrow dictionary that stays from batch to batch.

    A batch's different words are looked up in one call; only new ones reach Python. When there are too many, the half that most
    batches had stays. Forgetting one costs time, not correctness.
    """

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.names = pa.array([], pa.string())
        self.start, self.size, self.hits = (np.zeros(0, np.int64) for _ in range(3))
        self.flat = np.zeros(0, np.uint32)

    def pieces(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each of the different `names` (pieces without the space before them), and all these ids.

        A piece is a word with its space and the marks after it, or a text of its own.
        """
        cores = pc.utf8_rtrim(names, MARKS)
        plain = pc.utf8_is_alpha(cores)
        simple = plain.to_numpy(zero_copy_only=False)
        core = cores.filter(plain)
        marks = tails(names.filter(plain), core)
        texts = pa.concat_arrays([pc.binary_join_element_wise(" ", x, "") for x in (core, names.filter(pc.invert(plain)))] + [marks]).dictionary_encode()
        place = self.places(texts.dictionary)[texts.indices.to_numpy()]
        n, rest = len(core), len(names) - len(core)
        pair = np.full((len(names), 2), -1, np.int64)
        pair[simple, 0], pair[~simple, 0], pair[simple, 1] = place[:n], place[n : n + rest], place[n + rest :]
        flat = pair.ravel()
        size = np.where(flat < 0, 0, self.size[flat])
        return size.reshape(-1, 2).sum(axis=1), gathered(self.flat, np.where(flat < 0, 0, self.start[flat]), size)

    def places(self, names: pa.Array) -> np.ndarray:
        """Number in the dictionary of every one of the different texts `names`."""
        if len(self.names) > CACHE or len(self.flat) > 16 * CACHE:
            self.forget()
        at = pc.index_in(names, value_set=self.names)
        missing = pc.is_null(at).to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        if missing.any():
            new = names.filter(pa.array(missing))
            made = [self.bpe.made(x) if x[1:].isalpha() and x[0] == " " else self.bpe.encode(x) for x in new.to_pylist()]
            size = np.fromiter(map(len, made), np.int64, len(made)) // 4
            at[missing] = len(self.names) + np.arange(len(new))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, np.frombuffer(b"".join(made), "<u4")])
            self.hits = np.concatenate([self.hits, np.zeros(len(new), np.int64)])
            self.names = pa.concat_arrays([self.names, new])
        self.hits[at] += 1
        return at

    def forget(self) -> None:
        some = np.argsort(np.where(self.size > 64, -1, self.hits), kind="stable")[len(self.hits) - CACHE // 2 :] if len(self.hits) > CACHE // 2 else np.flatnonzero(self.size <= 64)
        some.sort()
        self.names, self.flat = self.names.take(pa.array(some)), gathered(self.flat, self.start[some], self.size[some])
        self.size, self.hits = self.size[some], self.hits[some] // 2
        self.start = np.cumsum(self.size) - self.size


def tails(texts: pa.Array, heads: pa.Array) -> pa.Array:
    """What follows heads[k], the beginning of texts[k], in texts[k]."""
    size, head = (pc.binary_length(x).to_numpy().astype(np.int64) for x in (texts, heads))
    if not len(size):
        return texts
    base = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts)].astype(np.int64)
    left = size - head
    chars = gathered(np.frombuffer(texts.buffers()[2], np.uint8), base + head, left)
    edges = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(left), [None, pa.py_buffer(edges), pa.py_buffer(chars)])


def gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[start[k] : start[k] + size[k]] of every k, one after the other."""
    ends = np.cumsum(size)
    return flat[np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


def larger(batches, size: int = 4 << 20):
    """Arrow batches put together to about `size` bytes, so that more pieces of a batch are repeated ones."""
    have, used = [], 0
    for b in batches:
        if have and used + b.nbytes > size:
            yield joined(have)
            have, used = [], 0
        have.append(b)
        used += b.nbytes
    if have:
        yield joined(have)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def encode_flat(bpe: Bpe, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of an Arrow array, one text after the other, and where each begins and the last ends."""
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, _ODD)
    strange = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    lists = pc.split_pattern(pc.if_else(odd, "", texts) if len(strange) else texts, " ")
    values, edges = lists.values, lists.offsets.to_numpy().astype(np.int64)
    if len(strange):  # these are cut by another rule
        own = [cut(texts[k].as_py()) for k in strange.tolist()]
        n = np.diff(edges)
        n[strange] = list(map(len, own))
        at = np.concatenate([[0], np.cumsum(n)])
        source = np.repeat(edges[:-1] - at[:-1], n) + np.arange(int(at[-1]))
        more = len(values)
        for k, parts in zip(strange.tolist(), own):
            source[at[k] : at[k + 1]] = more + np.arange(len(parts))
            more += len(parts)
        values = pa.concat_arrays([values, pa.array([x for parts in own for x in parts], pa.string())]).take(pa.array(source))
        edges = at
    if not len(texts):
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    if bpe.known is None:
        bpe.known = Known(bpe)
    table, coded = bpe.known, values.dictionary_encode()
    size, flat = table.pieces(coded.dictionary)
    place = coded.indices.to_numpy()
    first = [np.frombuffer(bpe.encode(x), "<u4") for x in values.take(pa.array(edges[:-1])).to_pylist()]
    start, size = (np.cumsum(size) - size)[place], size[place]
    size[edges[:-1]] = list(map(len, first))
    start[edges[:-1]] = len(flat) + np.cumsum(size[edges[:-1]]) - size[edges[:-1]]
    ends = np.concatenate([[0], np.cumsum(size)])
    return gathered(np.concatenate([flat, *first]), start, size), ends[edges]


def encode_batch(bpe: Bpe, texts) -> list[np.ndarray]:
    """Ids of every text of an Arrow array or a list."""
    ids, edges = encode_flat(bpe, texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
    at = edges.tolist()
    return [ids[a:b] for a, b in zip(at, at[1:])]
