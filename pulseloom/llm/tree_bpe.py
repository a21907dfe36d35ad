"""Byte-level BPE of long texts by halves that are encoded in parallel and joined.

A long text is halved until no part is longer than `leaf` characters. Parts are rows, so several tasks encode one
text. Two neighbours are joined by encoding a window around the join again. The window grows until both sides agree:

* It may end where a space follows a character that is no white space. Such a place starts a word of the
  tokenizer's pattern whatever stands around it, so the tokens of either side before and after it stay.
* If there is no such place near, the words of the pattern around the join are compared with the words either side
  had. Outside the first and the last word start on which they agree, the tokens stay.
* If one word spans the join for thousands of bytes, the window is a number of tokens on either side. It is right as
  soon as the first token of the window is the left side's token and the last one the right side's: then every pair
  of neighbours in the joined sequence is a pair that encoding leaves alone, which makes the whole sequence the encoding.

Decoding concatenates the bytes of the tokens.
"""

import hashlib
import re
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.llm import pieces
from pulseloom.llm.common import map_text, materialize, text_key

LEAF = 32_768
#: Bytes of one word beyond which its tokens are joined by windows of tokens.
LONG_WORD = 2_048
_SAFE = re.compile(r"(?<=\S) ")
_LAST_SAFE = 4_096


def safe_before(text: str, end: int, span: int) -> int | None:
    """The last place in text[end - span : end] where the text may be cut, 0 if the span reaches the start."""
    at = text.rfind(" ", max(0, end - span), end)
    while at > 0:
        if not text[at - 1].isspace():
            return at
        at = text.rfind(" ", max(0, end - span), at)
    return 0 if end - span <= 0 else None


def safe_after(text: str, start: int, span: int) -> int | None:
    """The first place from `start` on, within `span`, where the text may be cut; the end if the span reaches it."""
    m = _SAFE.search(text, start, min(len(text), start + span))
    return m.start() if m else len(text) if start + span >= len(text) else None


class Encoded:
    """A text and its token ids."""

    def __init__(self, text: str, ids: array):
        self.text, self.ids = text, ids


def tokens_at_end(bpe, ids: array, n_bytes: int) -> int:
    """How many of the last tokens make up the last `n_bytes` bytes."""
    k = 0
    while n_bytes > 0:
        k += 1
        n_bytes -= len(bpe.bytes[ids[-k]])
    if n_bytes < 0:
        raise ValueError("not a token border")
    return k


def tokens_at_start(bpe, ids: array, n_bytes: int) -> int:
    k = 0
    while n_bytes > 0:
        n_bytes -= len(bpe.bytes[ids[k]])
        k += 1
    if n_bytes < 0:
        raise ValueError("not a token border")
    return k


def join(bpe, left: Encoded, right: Encoded) -> Encoded:
    """The encoding of left.text + right.text from both encodings."""
    a, b = left.text, right.text
    if not a or not b:
        return Encoded(a + b, left.ids + right.ids)
    span = 64
    while True:
        s, e = safe_before(a, len(a), span), safe_after(b, 0, span)
        if s is not None and e is not None:
            window = array("I", bpe.encode(a[s:] + b[:e]))
            break
        if span >= _LAST_SAFE:
            whole_s, whole_e = safe_before(a, len(a), len(a)), safe_after(b, 0, len(b))
            return unsplit(bpe, left, right, whole_s or 0, len(b) if whole_e is None else whole_e)
        span *= 4
    i = len(left.ids) - tokens_at_end(bpe, left.ids, len(a[s:].encode()))
    j = tokens_at_start(bpe, right.ids, len(b[:e].encode()))
    return Encoded(a + b, left.ids[:i] + window + right.ids[j:])


def unsplit(bpe, left: Encoded, right: Encoded, s: int, e: int) -> Encoded:
    """Join where the stretch from s in the left to e in the right text has no place to cut."""
    a, b = left.text[s:], right.text[:e]
    if bpe.has_special(a + b):
        window, i, j = array("I", bpe.encode(a + b)), len(a), len(b)
        return spliced(bpe, left, right, window, a, b)
    starts = [m.start() for m in bpe.pattern.finditer(a + b)] + [len(a) + len(b)]
    mine = {m.start() for m in bpe.pattern.finditer(a)} | {len(a)}
    yours = {m.start() + len(a) for m in bpe.pattern.finditer(b)} | {len(a) + len(b)}
    same = [p for p in starts if p <= len(a)]
    k = 0  # the words agree from the stretch's start up to the first start that only one of both has
    left_starts = sorted(p for p in mine if p <= len(a))
    while k + 1 < min(len(same), len(left_starts)) and same[k + 1] == left_starts[k + 1] and same[k + 1] < len(a):
        k += 1
    p = same[k]
    q = next(x for x in starts if x >= len(a) and x in yours)
    if q == len(a) and same == left_starts:
        return Encoded(left.text + right.text, left.ids + right.ids)
    one_each = not any(p < z < len(a) for z in mine) and not any(len(a) < z < q for z in yours)
    window = array("I")
    inner = [x for x in starts if p <= x <= q]
    tail_left, head_right = a[p:], b[: q - len(a)]
    for x, y in zip(inner, inner[1:]):
        word = (a + b)[x:y]
        if len(word.encode()) > LONG_WORD and x == p and y == q and p < len(a) < q and one_each:
            n_left = tokens_at_end(bpe, left.ids, len(tail_left.encode()))
            n_right = tokens_at_start(bpe, right.ids, len(head_right.encode()))
            window += grown(bpe, left.ids[len(left.ids) - n_left :], right.ids[:n_right])
        else:
            window.frombytes(bpe.word(word) if len(word) <= LONG_WORD else halves(bpe, word).tobytes())
    return spliced(bpe, left, right, window, tail_left, head_right)


def spliced(bpe, left: Encoded, right: Encoded, window: array, tail: str, head: str) -> Encoded:
    i = len(left.ids) - tokens_at_end(bpe, left.ids, len(tail.encode()))
    j = tokens_at_start(bpe, right.ids, len(head.encode()))
    return Encoded(left.text + right.text, left.ids[:i] + window + right.ids[j:])


def grown(bpe, left: array, right: array) -> array:
    """Tokens of one word from the tokens of its two parts: windows of tokens, doubled until both edges agree."""
    k = 4
    while True:
        m, n = min(k, len(left)), min(k, len(right))
        data = b"".join(bpe.bytes[t] for t in left[len(left) - m :] + right[:n])
        mid = array("I", [t.id for t in bpe.model.tokenize(data.decode("latin-1").translate(bpe.letters))])
        if (m == len(left) or mid[0] == left[-m]) and (n == len(right) or mid[-1] == right[n - 1]):
            return left[: len(left) - m] + mid + right[n:]
        k *= 2


def halves(bpe, word: str) -> array:
    """Tokens of one very long word: its bytes are halved, encoded and joined."""
    def of(data: bytes) -> array:
        if len(data) <= LONG_WORD:
            return array("I", [t.id for t in bpe.model.tokenize(data.decode("latin-1").translate(bpe.letters))])
        mid = len(data) // 2
        return grown(bpe, of(data[:mid]), of(data[mid:]))

    return of(word.encode())


def encode_long(bpe, text: str, leaf: int = LEAF) -> array:
    """The tree in one process: halves down to `leaf` characters, then joins."""
    def of(t: str) -> Encoded:
        if len(t) <= leaf:
            return Encoded(t, array("I", encode_part(bpe, t)))
        mid = len(t) // 2
        return join(bpe, of(t[:mid]), of(t[mid:]))

    return of(text).ids


def encode_part(bpe, text: str) -> bytes:
    """Ids of a part; words of any length."""
    if bpe.has_special(text):
        return bpe.encode(text)
    out = []
    for w in bpe.pattern.findall(text):
        out.append(bpe.word(w) if len(w) <= LONG_WORD else halves(bpe, w).tobytes())
    return b"".join(out)


def digest(bpe, ids: np.ndarray) -> tuple[int, str, str]:
    """Number of ids, hash of the ids as decimals, hash of the decoded text."""
    return len(ids), hashlib.sha256(bpe.decimals(ids)).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest()


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def tokens(bpe, ids: np.ndarray) -> tuple[list[int], str]:
    return ids.tolist(), bpe.decode(ids)


TOKENS = "ids array<int>, decoded string"


def encode(docs: DataFrame, vocabulary: str = pieces.VOCABULARY, output=tokens, fields: str = TOKENS, leaf: int = LEAF) -> DataFrame:
    """doc_id and `fields` of every row, as `output(bpe, ids)` makes them.

    Nulls count as empty texts, repeated rows are kept, and an empty table gives an empty result. Rows of up to
    `leaf` characters are encoded where they are. Of the longer ones every different text is halved, encoded and joined
    once; a level of the tree is one shuffle of the long texts, with at most two rows to a group.
    """
    spark, path = docs.sparkSession, public_tokenizers.path(vocabulary)
    names = [c.split()[0] for c in fields.split(", ")]
    d = docs.select("doc_id", "text")

    def whole(texts):
        bpe = pieces.load(path)
        made = [output(bpe, e) for e in pieces.encode_batch(bpe, texts)]
        return {n: [m[i] for m in made] for i, n in enumerate(names)}

    is_long = F.coalesce(F.length("text"), F.lit(0)) > leaf
    short = map_text(d.filter(~is_long), whole, fields, raw=True)
    keyed = d.filter(is_long).select("doc_id", "text", text_key().alias("k")).select("doc_id", "text", "k.a", "k.b")
    parts = materialize(encoded_parts(keyed.dropDuplicates(["a", "b"]).select("a", "b", "text"), path, leaf), "parts")
    depth = parts.agg(F.max("depth")).first()[0]
    if depth is None:
        return short

    def joined(pdf):
        pdf = pdf.sort_values("node")
        nodes = [Encoded(t, array("I", i)) for t, i in zip(pdf["text"], pdf["ids"])]
        return nodes[0] if len(nodes) == 1 else join(pieces.load(path), *nodes)

    def inner(pdf):
        one = joined(pdf)
        return pdf[["a", "b", "depth"]][:1].assign(node=[int(pdf["node"].iloc[0]) >> 1], text=[one.text], ids=[one.ids.tobytes()])

    def root(pdf):
        bpe = pieces.load(path)
        made = output(bpe, np.array(joined(pdf).ids, np.uint32))
        return pdf[["a", "b"]][:1].assign(**{n: [m] for n, m in zip(names, made)})

    level = parts
    for _ in range(depth - 1):
        level = level.groupBy("a", "b", F.shiftright("node", 1).alias("up")).applyInPandas(inner, parts.schema)
    done = level.groupBy("a", "b").applyInPandas(root, "a long, b long, " + fields)
    return short.unionByName(keyed.select("doc_id", "a", "b").join(done, ["a", "b"]).select("doc_id", *names))


def encoded_parts(texts: DataFrame, path: str, leaf: int) -> DataFrame:
    """(a, b, depth, node, text, ids): the leaves of every text's tree, dealt evenly over the tasks."""
    def split(batches):
        for batch in batches:
            for a, b, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                depth = max(0, (len(t) - 1) // leaf).bit_length()
                n = 1 << depth
                cuts = [len(t) * i // n for i in range(n + 1)]
                for i in range(0, n, 64):
                    some = [t[x:y] for x, y in zip(cuts[i : i + 64], cuts[i + 1 : i + 65])]
                    m = len(some)
                    yield pa.RecordBatch.from_pydict({"a": [a] * m, "b": [b] * m, "depth": pa.array([depth] * m, pa.int32()), "node": pa.array(range(i, i + m), pa.int64()), "text": some})

    def ids(batches):
        bpe = pieces.load(path)
        for batch in batches:
            made = pa.array([encode_part(bpe, t) for t in batch.column(4).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, "ids"])

    schema = "a long, b long, depth int, node long, text string"
    return texts.mapInArrow(split, schema).repartition("a", "b", "node").mapInArrow(ids, schema + ", ids binary")
