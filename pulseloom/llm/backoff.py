"""Word-sequence probabilities by a weighted backoff automaton, counted over all training texts.

The model is an interpolated n-gram model: one word has (c + 1) / (N + V + 1), a word after a context h has
(c(hw) + MU * p(w after the shorter context)) / (c(h) + MU). As an automaton, every context seen in training is a state, a seen n-gram
an arc with its log-probability, and each state has a failure arc to the state of the shorter context that costs
MU / (c(h) + MU): following failure arcs until an arc for the word exists gives exactly the interpolated value.

Nobody holds the whole model. Texts are cut into blocks, written once with their words numbered. A block asks for the training counts
of its own different n-grams: sorted 64-bit keys, packed per bucket of the key space; the task of a bucket adds up all blocks' counts and
answers every block in the order of its question, so answers carry no keys. With the answers a block builds the part of the automaton that
its texts can reach, and one left-to-right walk scores them. Orders are asked one after the other: an answer also says whether any other
block asked the same, and an n-gram whose first or last n - 1 words stand in one block alone needs no question.

Single words are keyed by 80 bits, longer n-grams by 64; the chance that one of them shares its key is their number over 2**80 or 2**64.
"""

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseloom.llm.common import materialize, open_input, open_output, prepare, shared_dir

ORDER = 3
#: Weight of the shorter context's probability, in occurrences.
MU = 4.0
#: Bytes of text in a block (a longer text is a block of its own), and tokens for which there is one bucket. A larger cluster takes
#: larger ones, so that a packed row still holds many keys.
BLOCK, BUCKET = 8 << 20, 4_000_000
#: Tokens of a text that one lane of the walk reads.
LANE = 256
_U64 = np.uint64
_MIX = (_U64(0x9E3779B97F4A7C15), _U64(0xBF58476D1CE4E5B9), _U64(0x94D049BB133111EB))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64 bits that name the pair (a, b), by the finaliser of splitmix64."""
    x = a * _MIX[0] + b
    x = (x ^ (x >> _U64(30))) * _MIX[1]
    x = (x ^ (x >> _U64(27))) * _MIX[2]
    return x ^ (x >> _U64(31))


def pack_counts(n: np.ndarray) -> bytes:
    """Counts as one byte each; 255 points to the list of the larger ones behind them."""
    large = n >= 255
    return np.where(large, 255, n).astype(np.uint8).tobytes() + n[large].astype("<u8").tobytes()


def unpack_counts(data: bytes, size: int) -> np.ndarray:
    n = np.frombuffer(data, np.uint8, size).astype(np.int64)
    n[n == 255] = np.frombuffer(data, "<u8", -1, size).astype(np.int64)
    return n


def pack_answer(total: np.ndarray, alone: np.ndarray) -> bytes:
    """Counts, and whether this block alone has the n-gram."""
    return np.packbits(alone).tobytes() + pack_counts(total)


def unpack_answer(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    bits = -(-size // 8)
    return unpack_counts(data[bits:], size), np.unpackbits(np.frombuffer(data, np.uint8, bits), count=size).astype(bool)


def pack_arrays(**arrays) -> bytes:
    """Arrays by name, compressed."""
    sink = pa.BufferOutputStream()
    table = pa.table({k: pa.array([np.ascontiguousarray(v).tobytes()], pa.large_binary()) for k, v in arrays.items()})
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack_arrays(data: bytes, **types) -> dict:
    row = pa.ipc.open_stream(data).read_all()
    return {k: np.frombuffer(row.column(k)[0].as_py(), t) for k, t in types.items()}


class Grams:
    """The different n-grams of a block for one order.

    `at` has their number for every position that ends one (-1 elsewhere), `head` and `tail` the numbers of the (n-1)-grams without the last
    and without the first word, `key` their key, `own` their count in this block's training texts.
    """

    def __init__(self, order: int, words: np.ndarray, place: np.ndarray, train: np.ndarray, shorter: "Grams | None", hashes: np.ndarray):
        if shorter is None:
            self.at = words
            self.size = len(hashes)
            self.head = self.tail = np.zeros(self.size, np.int64)
            self.key = hashes
        else:
            ends = np.flatnonzero(place >= order - 1)
            code = shorter.at[ends - 1] * len(hashes) + words[ends]
            seen, first, inverse = np.unique(code, return_index=True, return_inverse=True)
            self.at = np.full(len(words), -1, np.int64)
            self.at[ends] = inverse
            self.size = len(seen)
            self.head, self.tail = seen // len(hashes), shorter.at[ends[first]]
            self.key = mix(shorter.key[self.head], hashes[seen % len(hashes)])
        self.word = np.arange(self.size) if shorter is None else seen % len(hashes)
        self.own = np.bincount(self.at[(self.at >= 0) & train], minlength=self.size)[: self.size].astype(np.int64)


class Automaton:
    """States with sorted arcs and one failure arc each. State 0 is the empty context and has no failure.

    `arcs` are the keys state * words + word in ascending order, with their log10-probability and target state; `fail` and
    `penalty` are the failure target and its log10 weight. Every word has an arc at state 0.
    """

    def __init__(self, words: int, arcs: np.ndarray, weight: np.ndarray, target: np.ndarray, fail: np.ndarray, penalty: np.ndarray, order: int):
        self.words, self.arcs, self.weight, self.target, self.fail, self.penalty, self.order = words, arcs, weight, target, fail, penalty, order

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read one word in each lane: the log10-probabilities and the next states."""
        state, got = state.copy(), np.zeros(len(state))
        after = np.zeros(len(state), np.int64)
        open_ = np.arange(len(state))
        while len(open_):
            wanted = state[open_] * self.words + word[open_]
            near = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            hit = self.arcs[near] == wanted
            done = open_[hit]
            got[done] += self.weight[near[hit]]
            after[done] = self.target[near[hit]]
            open_ = open_[~hit]
            got[open_] += self.penalty[state[open_]]
            state[open_] = self.fail[state[open_]]
        return got, after

    def score(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10-probability of every text; `words` holds the texts one after the other.

        All texts are read at once, word by word from the left. A long text is read in lanes of LANE words; a lane first reads the
        order - 1 words before its own, after which it is in the state the whole text would have led to, since states hold no more.
        """
        lead = self.order - 1
        lanes = np.maximum(1, -(-lengths // LANE))
        text = np.repeat(np.arange(len(lengths)), lanes)
        begin = np.cumsum(lengths) - lengths
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        first = begin[text] + nth * LANE
        last = np.minimum(first + LANE, begin[text] + lengths[text])
        warm = np.where(nth > 0, np.minimum(lead, nth * LANE), 0)
        at, skip, size = first - warm, warm, last - first + warm
        order = np.argsort(-size, kind="stable")
        at, skip, size, text = at[order], skip[order], size[order], text[order]
        total, state = np.zeros(len(at)), np.zeros(len(at), np.int64)
        active = np.searchsorted(-size, -np.arange(1, int(size.max(initial=0)) + 1), "right")
        for t, k in enumerate(active.tolist()):
            got, state[:k] = self.step(state[:k], words[at[:k] + t])
            total[:k] += np.where(skip[:k] <= t, got, 0.0)
        return np.bincount(text, total, len(lengths))


def build_automaton(grams: list[Grams], totals: list[np.ndarray], n_train: int, n_words: int, mu: float = MU) -> Automaton:
    """The automaton of a block from the training counts of its n-grams."""
    words, order = grams[0].size, len(grams)
    base = np.cumsum([1, *(g.size for g in grams[:-1])])  # number of the first state of each order
    p = (totals[0] + 1) / (n_train + n_words + 1)
    probability = [p]
    arcs, weight, target = [np.arange(words)], [np.log10(p)], [np.where(totals[0] > 0, base[0] + np.arange(words), 0) if order > 1 else np.zeros(words, np.int64)]
    states = 1 + sum(g.size for g in grams[:-1])
    fail, penalty = np.zeros(states, np.int64), np.zeros(states)
    for k in range(1, order):
        g, c, context = grams[k], totals[k], totals[k - 1]
        held = slice(base[k - 1], base[k - 1] + grams[k - 1].size)
        fail[held] = 0 if k == 1 else base[k - 2] + grams[k - 1].tail
        penalty[held] = np.log10(mu / (context + mu))
        # p of the same word after the shorter context: the arc there, or its failure's
        lower = probability[k - 1][g.tail]
        p = (c + mu * lower) / (context[g.head] + mu)
        probability.append(p)
        live = np.flatnonzero(c > 0)
        arcs.append((base[k - 1] + g.head[live]) * words + g.word[live])
        weight.append(np.log10(p[live]))
        target.append(base[k] + live if k < order - 1 else base[k - 1] + g.tail[live])
    return Automaton(words, np.concatenate(arcs), np.concatenate(weight), np.concatenate(target), fail, penalty, order)


def _blocks(docs: DataFrame, folder: str, size: int) -> DataFrame:
    """One row per written block: block, file, tokens, train (tokens of training texts)."""
    def written(batches):
        table = pa.Table.from_batches(batches)
        held = np.array(table.column(1).to_pylist(), bool)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(table.column(2).combine_chunks(), "").cast(pa.large_string())))
        ends, values = lists.offsets.to_numpy().astype(np.int64), lists.values[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
        ends = ends - ends[0]
        real = pc.not_equal(values, "").to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(real)])
        n = np.diff(before[ends])
        coded = values.filter(pa.array(real)).dictionary_encode()
        hashes = [xxhash.xxh3_128_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()]
        lengths = n + 1
        words = np.zeros(int(lengths.sum()), np.int32)  # word 0 is the end of a text
        word = np.ones(len(words), bool)
        word[np.cumsum(lengths) - 1] = False
        words[word] = coded.indices.to_numpy() + 1
        mark = xxhash.xxh3_128_intdigest(b"")
        high = np.array([h >> 64 for h in (mark, *hashes)], _U64)
        low = np.array([h & 0xFFFF for h in (mark, *hashes)], np.uint16)
        part = TaskContext.get().partitionId()
        name = f"{folder}/{part:06d}-{uuid.uuid4().hex}"
        ids = pa.table({"doc_id": pa.chunked_array([table.column(0).combine_chunks()])})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, ids.schema) as out:
            out.write_table(ids)
        planes = words.view(np.uint8).reshape(-1, 4).T  # bytes of equal weight together
        with open_output(name) as f:
            f.write(pack_arrays(words=planes, lengths=lengths.astype(np.int64), held=held, high=high, low=low, ids=np.frombuffer(sink.getvalue(), np.uint8)))
        yield pa.RecordBatch.from_pydict({"block": [name.rsplit("/", 1)[1]], "files": [name], "tokens": [len(words)], "train": [int(lengths[~held].sum())]})

    def run(batches):
        have, used = [], 0
        for b in batches:
            for i in range(0, b.num_rows, 64):  # rows differ in length
                some = b.slice(i, 64)
                now = some.nbytes
                if have and used + now > size:
                    yield from written(have)
                    have, used = [], 0
                have.append(some)
                used += now
        if have:
            yield from written(have)

    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    held = F.crc32(digits.cast("binary")) % 7 == 2
    rows = docs.select("doc_id", held.alias("held"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "block string, files string, tokens long, train long")


class BlockTexts:
    """A written block read back: its texts, and the n-grams and training counts of the orders that are known."""

    def __init__(self, files: str):
        names = files.split("\n")
        with open_input(names[0]) as f:
            got = unpack_arrays(f.read(), words=np.uint8, lengths=np.int64, held=np.bool_, high=_U64, low=np.uint16, ids=np.uint8)
        self.words = np.ascontiguousarray(got["words"].reshape(4, -1).T).view("<i4").ravel().astype(np.int64)
        self.lengths, self.held, self.high, self.low = got["lengths"], got["held"], got["high"], got["low"]
        self.ids = pa.ipc.open_stream(got["ids"].tobytes()).read_all().column(0).combine_chunks()
        self.place = np.arange(len(self.words)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.train = np.repeat(~self.held, self.lengths)
        self.grams: list[Grams] = []
        self.totals: list[np.ndarray] = []
        self.alone: list[np.ndarray] = []
        for name in names[1:]:
            self.next_order()
            with open_input(name) as f:
                self.take(*unpack_answer(zstandard.decompress(f.read()), self.grams[-1].size))

    def take(self, total: np.ndarray, alone: np.ndarray) -> None:
        self.totals.append(total)
        self.alone.append(alone)

    def next_order(self) -> Grams:
        self.grams.append(Grams(len(self.grams) + 1, self.words, self.place, self.train, self.grams[-1] if self.grams else None, self.high))
        return self.grams[-1]

    def asked(self) -> tuple[np.ndarray, Grams]:
        """The n-grams of the last order that other blocks may have as well, sorted by key."""
        g = self.grams[-1]
        if len(self.grams) == 1:
            return np.lexsort((self.low, self.high)), g
        shared = ~self.alone[-1]
        some = np.flatnonzero(shared[g.head] & shared[g.tail])
        return some[np.argsort(g.key[some], kind="stable")], g


_QUESTION = "block string, files string, bucket int, size int, keys binary, low binary, counts binary"


def _ask(texts: BlockTexts, block: str, files: str, buckets: int):
    """The questions of the last order as rows, one per bucket that has keys; a block without any has one empty row."""
    some, g = texts.asked()
    key = g.key[some]
    part = ((key >> _U64(32)) * _U64(buckets)) >> _U64(32)
    edges = np.searchsorted(part, np.arange(buckets + 1))
    own = g.own[some]
    rows = [(int(b), int(edges[b]), int(edges[b + 1])) for b in np.flatnonzero(np.diff(edges))] or [(hash_bucket(block, buckets), 0, 0)]
    first = len(texts.grams) == 1
    low = texts.low[some] if first else np.zeros(0, np.uint16)
    for i in range(0, len(rows), 16):
        few = rows[i : i + 16]
        yield pa.RecordBatch.from_pydict({
            "block": [block] * len(few), "files": [files] * len(few), "bucket": pa.array([b for b, _, _ in few], pa.int32()),
            "size": pa.array([z - a for _, a, z in few], pa.int32()), "keys": [shrink(key[a:z]) for _, a, z in few],
            "low": [low[a:z].tobytes() if first else b"" for _, a, z in few], "counts": [pack_counts(own[a:z]) for _, a, z in few],
        })


def hash_bucket(block: str, buckets: int) -> int:
    return xxhash.xxh3_64_intdigest(block) % buckets


def shrink(key: np.ndarray) -> bytes:
    """Ascending keys as differences, bytes of equal weight together, without the leading bytes that are all zero."""
    if not len(key):
        return b""
    step = np.diff(key, prepend=_U64(0))
    step[0] = 0
    planes = step.astype("<u8").view(np.uint8).reshape(-1, 8).T
    width = 8 - int(np.argmax(planes[::-1].any(axis=1))) if planes.any() else 0
    return key[:1].astype("<u8").tobytes() + planes[:width].tobytes()


def grow(data: bytes, size: int) -> np.ndarray:
    """The keys that `shrink` packed."""
    if not size:
        return np.zeros(0, _U64)
    raw = np.frombuffer(data, np.uint8, -1, 8).reshape(-1, size)
    step = np.zeros((size, 8), np.uint8)
    step[:, : len(raw)] = raw.T
    step = step.view("<u8").ravel().astype(_U64)
    step[0] = np.frombuffer(data, "<u8", 1)[0]
    return np.cumsum(step, dtype=_U64)


_ANSWER = "block string, files string, bucket int, size int, counts binary, different long"


def _answer(rows: pa.Table) -> pa.Table:
    """Totals of one bucket, answered in the order of every block's question. `different` is the number of keys with a count, in one row."""
    sizes = rows.column("size").to_pylist()
    keys = np.concatenate([grow(d, n) for d, n in zip(rows.column("keys").to_pylist(), sizes)])
    low = [np.frombuffer(d, np.uint16) for d in rows.column("low").to_pylist()]
    low = np.concatenate(low) if sum(map(len, low)) else None
    own = np.concatenate([unpack_counts(d, n) for d, n in zip(rows.column("counts").to_pylist(), sizes)])
    order = np.argsort(keys, kind="stable") if low is None else np.lexsort((low, keys))
    new = np.ones(len(order), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    if low is not None:
        new[1:] |= low[order[1:]] != low[order[:-1]]
    run = np.cumsum(new) - 1
    sums = np.add.reduceat(own[order], np.flatnonzero(new)) if len(order) else np.zeros(0, np.int64)
    total, alone = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
    total[order], alone[order] = sums[run], np.bincount(run, minlength=1)[run] == 1
    ends = np.cumsum(sizes)
    different = [int((sums > 0).sum())] + [0] * (len(sizes) - 1)
    return pa.table({
        "block": rows.column("block"), "files": rows.column("files"), "bucket": rows.column("bucket"), "size": rows.column("size"),
        "counts": pa.array([pack_answer(total[z - n : z], alone[z - n : z]) for n, z in zip(sizes, ends.tolist())], pa.binary()), "different": pa.array(different, pa.int64()),
    })


def _settle(rows: pa.Table, folder: str | None) -> tuple[BlockTexts, str, str]:
    """A block with the answers to its last questions taken in and, if there is a folder, written; its name and its files."""
    block, files = rows.column("block")[0].as_py(), rows.column("files")[0].as_py()
    texts = BlockTexts(files)
    texts.next_order()
    some, g = texts.asked()
    total, alone = g.own.copy(), np.ones(g.size, bool)
    order = np.argsort(rows.column("bucket").to_numpy())
    sizes, counts = rows.column("size").to_pylist(), rows.column("counts").to_pylist()
    if len(some):
        got = [unpack_answer(counts[i], sizes[i]) for i in order]
        total[some], alone[some] = (np.concatenate(x) for x in zip(*got))
    texts.take(total, alone)
    if not folder:
        return texts, block, files
    name = f"{folder}/{block}-{len(texts.totals)}-{uuid.uuid4().hex}"
    with open_output(name) as f:
        f.write(zstandard.compress(pack_answer(total, alone), 3))
    return texts, block, f"{files}\n{name}"


def score(docs: DataFrame, order: int = ORDER, mu: float = MU, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row of `docs` (doc_id, text).

    Training texts are those whose crc32(doc_id as text) mod 7 is not 2 (a null id counts as the text "null"). Null texts
    count as empty: they have their end alone. Repeated rows are learned and scored as often as they stand there. An empty table gives no
    rows; without training texts every token has probability 1 / (V + 1) with V = 0. Both scores are rounded to 6 decimals.
    Only the sums of tokens and of different words come to the driver.
    """
    spark = prepare(docs.sparkSession)
    folder = shared_dir(spark, "ngram-blocks")
    blocks = materialize(_blocks(docs, folder, block), "ngram-block-list")
    sums = blocks.agg(F.sum("tokens"), F.sum("train"), F.count(F.lit(1))).first()
    n_tokens, n_train, n_blocks = sums[0] or 0, sums[1] or 0, max(1, sums[2])
    buckets = max(1, -(-n_tokens // bucket))

    def first(batches):
        for b in batches:
            for name, files in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                texts = BlockTexts(files)
                texts.next_order()
                yield from _ask(texts, name, files, buckets)

    answers, n_words = None, 0
    # a fixed number of partitions: the rows are small, but a block is much work, so tasks must not be put together by size
    asked = blocks.repartition(n_blocks, "block").mapInArrow(first, _QUESTION)
    for k in range(1, order + 1):
        answers = asked.repartitionById(buckets, F.col("bucket")).groupBy("bucket").applyInArrow(_answer, _ANSWER)
        if k == 1:
            answers = materialize(answers, "ngram-words")
            n_words = answers.agg(F.sum("different")).first()[0] or 0
        if k < order:

            def more(rows: pa.Table) -> pa.Table:
                texts, name, files = _settle(rows, folder)
                texts.next_order()
                return pa.Table.from_batches(list(_ask(texts, name, files, buckets))).select(_QUESTION_NAMES).cast(_QUESTION_ARROW)

            asked = answers.repartition(n_blocks, "block").groupBy("block").applyInArrow(more, _QUESTION)

    id_field = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    schema = T.StructType([id_field, *T.StructType.fromDDL("held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")])

    def scored(rows: pa.Table) -> pa.Table:
        texts, _, _ = _settle(rows, None)
        ends = np.cumsum(texts.lengths)
        text = np.repeat(np.arange(len(ends)), texts.lengths)
        c = texts.totals[0]
        base = np.log10((c + 1) / (n_train + n_words + 1))[texts.words]
        walk = build_automaton(texts.grams, texts.totals, n_train, n_words, mu).score(texts.words, texts.lengths)
        known = np.bincount(text, c[texts.words] > 0, len(ends)).astype(np.int64)
        return pa.table({
            "doc_id": texts.ids, "held_out": texts.held, "n_tokens": texts.lengths, "n_known": known, "train_tokens": np.full(len(ends), n_train),
            "base_score": np.round([math.fsum(base[z - n : z].tolist()) for n, z in zip(texts.lengths.tolist(), ends.tolist())], 6), "score": np.round(walk, 6),
        })

    return answers.repartition(n_blocks, "block").groupBy("block").applyInArrow(scored, schema)


_QUESTION_ARROW = pa.schema([("block", pa.string()), ("files", pa.string()), ("bucket", pa.int32()), ("size", pa.int32()), ("keys", pa.binary()),
                             ("low", pa.binary()), ("counts", pa.binary())])
_QUESTION_NAMES = _QUESTION_ARROW.names


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text in SQL, bit by bit."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return f"xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT)), lambda c, b: {byte}), 4294967295)"


def oracle_sql(order: int = ORDER, mu: float = MU) -> str:
    """The same scores in SQL: counts by grouping, probabilities by joining every n-gram with its count."""
    grams = []
    for k in range(1, order + 1):
        cols = [f"lag(w, {j}) OVER (PARTITION BY row ORDER BY i)" for j in range(k - 1, 0, -1)] + ["w"]
        grams.append(f"g{k} AS MATERIALIZED (SELECT * FROM (SELECT row, i, held, [{', '.join(cols)}] AS g FROM t) WHERE i >= {k})")
        grams.append(f"c{k} AS MATERIALIZED (SELECT g, count(*) AS c FROM g{k} WHERE NOT held GROUP BY 1)")
    p = "p1 AS MATERIALIZED (SELECT row, i, coalesce(c,0) AS c, (coalesce(c,0)+1)/CAST(N+V+1 AS DOUBLE) AS p FROM g1 LEFT JOIN c1 USING (g), size)"
    parts = [p]
    for k in range(2, order + 1):
        parts.append(f"p{k} AS MATERIALIZED (SELECT p{k - 1}.row, p{k - 1}.i, p{k - 1}.c, CASE WHEN g{k}.row IS NULL THEN p ELSE "
                     f"(coalesce(c{k}.c,0)+{mu}*p)/(coalesce(h.c,0)+{mu}) END AS p FROM p{k - 1} LEFT JOIN g{k} ON g{k}.row=p{k - 1}.row AND g{k}.i=p{k - 1}.i "
                     f"LEFT JOIN c{k} ON c{k}.g=g{k}.g LEFT JOIN c{k - 1} h ON h.g=g{k}.g[1:{k - 1}])")
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
 b AS MATERIALIZED (SELECT row, doc_id, regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words,
   {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), 'null')")} % 7 = 2 AS held FROM d),
 t AS MATERIALIZED (SELECT row, held, unnest(words || ['']) AS w, unnest(range(1, len(words)+2)) AS i FROM b),
 {', '.join(grams)},
 size AS (SELECT coalesce(sum(c),0) AS N, count(*) AS V FROM c1),
 {', '.join(parts)}
 SELECT doc_id, held AS held_out, count(*) AS n_tokens, count(*) FILTER (c>0) AS n_known, any_value(N) AS train_tokens,
  round(fsum(log10((c+1)/CAST(N+V+1 AS DOUBLE))), 6) AS base_score, round(fsum(log10(p)), 6) AS score FROM p{order} JOIN b USING (row), size GROUP BY row, doc_id, held"""
