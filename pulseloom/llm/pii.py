"""Personal data by weak supervision.

Patterns propose spans. Labelers (pattern, checksum, gazetteer, context, shape, borders) vote for, against, or not
at all on every proposed span. Expectation maximisation over the counts of vote patterns estimates how often each labeler
is right, and from that how likely a span with these votes is personal data. A logistic span classifier learns these
probabilities from features of the span and decides.

The four base kinds (email, ip, card, phone) follow fixed rules and are always kept; the classifier adds spans of
the other kinds, and of loosely written phones, that reach beyond a base span. All proposals are voted on and scored; of
overlapping ones that the classifier takes, the most probable names the stretch. An added span may overlap base spans; a mask
covers them all.
"""

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.llm.common import free, map_text, materialize

KINDS = ("email", "ip", "card", "phone", "secret", "iban", "ssn", "local_phone", "obscured_email")
BASE = KINDS[:4]
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HAS = re.compile(r"[0-9@]")
CUES = ("password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "api-key", "access_key", "private_key", "credential")
_ASSIGNED = re.compile(r"(?i)(?:password|passwd|pwd|token|secret|api[_-]?key|access_key|private_key|credential)s?[\"']?[ \t]{0,4}[:=][ \t]{0,4}[\"']?([^\s\"',;]{6,}+)")
_KEY = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{18,}+(?![A-Za-z0-9_-])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_OBSCURED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]{2,}+)+")
#: Endings of mail domains, key prefixes, countries of account numbers.
ENDINGS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu ru cn jp br in au ca ch at se no pl".split())
KEY_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "xoxb", "xoxp", "AIza", "eyJ", "glpat")
IBAN_COUNTRIES = frozenset("AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LT LU LV MT NL NO PL PT RO SE SI SK".split())
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "server", "host", "address", "login"), "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "contact"), "secret": CUES + ("key", "bearer"), "iban": ("iban", "account", "bank"),
    "ssn": ("ssn", "social", "security"), "local_phone": ("phone", "call", "tel", "mobile", "fax", "contact"), "obscured_email": ("mail", "contact", "write"),
}
AGAINST = ("version", "isbn", "commit", "sha", "md5", "checksum", "order", "section", "serial", "example")
LABELERS = ("pattern", "checksum", "gazetteer", "context", "shape", "borders")
NO, FOR, NOT = 0, 1, 2


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def in_range(address: str) -> bool:
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in address.split(".")))


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches; the name before each sign is read backwards, so long runs cost one pass."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, by start, then kind."""
    if not _HAS.search(text):
        return []
    out = [(s, 0, e) for s, e in emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if in_range(m.group())]
    for m in _CARD.finditer(text):
        d = digits_of(m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return sorted(out)


def other_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """All proposed spans of the other kinds that do not lie inside a base span; they may overlap each other and base spans."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(c in low for c in CUES):
        found += [(m.start(1), 4, m.end(1)) for m in _ASSIGNED.finditer(text)]
    if _HAS.search(text):
        found += [(m.start(), 4, m.end()) for m in _KEY.finditer(text) if sum(c.isdigit() for c in m.group()) >= 2]
        for kind, p in ((5, _IBAN), (6, _SSN), (7, _LOCAL_PHONE)):
            found += [(m.start(), kind, m.end()) for m in p.finditer(text)]
    if "at]" in low or "at)" in low:
        found += [(m.start(), 8, m.end()) for m in _OBSCURED.finditer(text)]
    edges, far = [b[0] for b in base], list(accumulate((b[2] for b in base), max))
    # of the base spans that start no later than a span, none may end with or after it
    return [(s, k, e) for s, k, e in sorted(set(found)) if not (n := bisect_right(edges, s)) or far[n - 1] < e]


def iban_ok(value: str) -> bool:
    v = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in sorted(Counter(value).values()))


def votes_and_features(text: str, span: tuple[int, int, int]) -> tuple[int, int]:
    """The labelers' votes as a number in base 3, and the span's features as a number (`FEATURES`)."""
    s, k, e = span
    value, kind = text[s:e], KINDS[k]
    d = digits_of(value)
    before, after = text[max(0, s - 40) : s].lower(), text[e : e + 20].lower()
    mixed = bool(d) and any(c.isalpha() for c in value)
    bits = entropy(value)
    pattern = FOR if k < 4 or k in (5, 6) else FOR if k == 4 and any(value.startswith(p) for p in KEY_PREFIXES) or k == 8 else NO
    checksum = NO
    if kind == "card":
        checksum = FOR if luhn(d) else NOT
    elif kind == "iban":
        checksum = FOR if iban_ok(value) else NOT
    elif kind == "ssn":
        checksum = NOT if d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000" else FOR
    elif kind == "ip":
        checksum = FOR if in_range(value) else NOT
    gazetteer = NO
    if kind in ("email", "obscured_email"):
        gazetteer = FOR if re.split(r"[^a-z]+", value.lower().rstrip(")]"))[-1] in ENDINGS else NOT
    elif kind == "iban":
        gazetteer = FOR if value[:2] in IBAN_COUNTRIES else NOT
    elif kind == "secret":
        gazetteer = FOR if value.startswith(KEY_PREFIXES) else NO
    elif "phone" in kind:
        gazetteer = NOT if d[-10:-7] in ("000", "111") or len(set(d)) < 3 else FOR
    cue, counter = any(c in before for c in CONTEXT[kind]), any(c in before for c in AGAINST)
    context = FOR if cue and not counter else NOT if counter and not cue else NO
    if kind == "secret":
        shape = FOR if mixed and bits >= 3 else NOT if not d or not mixed else NO
    else:
        shape = NOT if len(set(d)) == 1 else NO if len(d) < 4 else FOR
    glued = bool(before[-1:].isalnum() or after[:1].isalnum())
    borders = NOT if glued else FOR
    code = 0
    for v in (pattern, checksum, gazetteer, context, shape, borders):
        code = 3 * code + v
    share = len(d) / max(1, len(value))
    cells = (k, min(3, int(4 * share)), min(4, len(value) // 8), min(3, int(bits)), int(cue), int(counter), int(glued), int(mixed), int(value.startswith(KEY_PREFIXES)), 1 + int(checksum == FOR) - int(checksum == NOT))
    feature = 0
    for n, c in zip(FEATURES, cells):
        feature = feature * n + c
    return code, feature


#: Number of values of every feature: kind, share of digits, length, entropy, cue, counter-cue, glued, mixed, key prefix, checksum.
FEATURES = (len(KINDS), 4, 5, 4, 2, 2, 2, 2, 2, 3)


def cells_of(features: np.ndarray) -> np.ndarray:
    out = np.zeros((len(features), len(FEATURES)), np.int64)
    rest = features.copy()
    for i in range(len(FEATURES) - 1, -1, -1):
        out[:, i] = rest % FEATURES[i]
        rest //= FEATURES[i]
    return out


def votes_of(codes: np.ndarray) -> np.ndarray:
    n = len(LABELERS)
    return np.stack([codes // 3 ** (n - 1 - i) % 3 for i in range(n)], 1) if len(codes) else np.zeros((0, n), np.int64)


def design(features: np.ndarray) -> np.ndarray:
    """One column per value of every feature, and a constant."""
    cells = cells_of(features)
    return np.concatenate([np.eye(n)[cells[:, i]] for i, n in enumerate(FEATURES)] + [np.ones((len(features), 1))], 1)


@dataclass(frozen=True)
class SpanModel:
    """`reliability[l][y][v]`: probability that labeler l votes v on a span that is (y = 1) or is not personal data."""

    reliability: np.ndarray
    prior: np.ndarray
    weights: np.ndarray

    def probability(self, features: list[int]) -> np.ndarray:
        f = np.array(features, np.int64)
        return 1 / (1 + np.exp(-design(f) @ self.weights)) if len(f) else np.zeros(0)


def fit(kinds: np.ndarray, codes: np.ndarray, features: np.ndarray, counts: np.ndarray, rounds: int = 50) -> SpanModel:
    """Expectation maximisation over distinct (kind, votes, features), then the span classifier."""
    votes = votes_of(codes)
    score = (votes == FOR).sum(1) - (votes == NOT).sum(1)
    post = 1 / (1 + np.exp(-1.5 * score.astype(float)))
    for _ in range(rounds):
        rel = np.zeros((len(LABELERS), 2, 3))
        for y, p in ((0, 1 - post), (1, post)):
            for v in range(3):
                rel[:, y, v] = ((votes == v) * (p * counts)[:, None]).sum(0) + (4.0 if (v, y) in ((FOR, 1), (NOT, 0)) else 1.0)
        rel /= rel.sum(2, keepdims=True)
        prior = np.array([((post * counts)[kinds == k].sum() + 1) / (counts[kinds == k].sum() + 2) for k in range(len(KINDS))])
        logit = np.log(prior[kinds] / (1 - prior[kinds])) if len(kinds) else np.zeros(0)
        for i in range(len(LABELERS)):
            logit = logit + np.log(rel[i, 1, votes[:, i]] / rel[i, 0, votes[:, i]])
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if len(new) and abs(new - post).max() < 1e-6:
            break
        post = new
    x = design(features)
    w, beta = np.log1p(counts.astype(float)), np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (p - post)) + 0.05 * beta
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1]), grad)
        beta = beta - step
        if abs(step).max() < 1e-8:
            break
    return SpanModel(rel, prior, beta)


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, kinds array<int>, starts array<int>, ends array<int>, votes array<int>, features array<int>"


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def propose(texts: list[str]) -> dict[str, list]:
    """Base spans and all proposed spans (base ones first) with votes and features."""
    rows = []
    for t in texts:
        base = base_spans(t)
        spans = base + other_spans(t, base)
        seen = [votes_and_features(t, s) for s in spans]
        text = joined(base)
        rows.append((*[sum(k == i for _, k, _ in base) for i in range(4)], hashlib.sha256(text.encode()).hexdigest(), text,
                     [k for _, k, _ in spans], [s for s, _, _ in spans], [e for _, _, e in spans], [v for v, _ in seen], [f for _, f in seen]))
    names = [c.split()[0] for c in FOUND.split(", ")]
    return dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}


def fit_on(found: DataFrame) -> SpanModel:
    """The model from the proposed spans of all rows; only counts by (kind, votes, features) come to the driver."""
    spans = found.select(F.explode(F.arrays_zip("kinds", "votes", "features")).alias("s")).select("s.*")
    rows = spans.groupBy("kinds", "votes", "features").agg(F.count(F.lit(1)).alias("n")).orderBy("kinds", "votes", "features").collect()
    table = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 4)
    return fit(table[:, 0], table[:, 1], table[:, 2], table[:, 3])


def chosen(model: SpanModel, kinds, starts, ends, features, threshold: float) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and the proposed ones that the classifier takes, by start, then kind: without overlaps, and as masks.

    A stretch of overlapping proposals is settled by probability, equal ones by length; inside one of the same kind that is taken, none
    stands for itself. The mask of the most probable covers the whole stretch, so nothing that was taken stays.
    """
    p = model.probability(features)
    spans = list(zip(starts, kinds, ends))
    base = [x for x in spans if x[1] < len(BASE)]
    taken = sorted((s, -e, k, q) for (s, k, e), q in zip(spans, p) if k >= len(BASE) and q >= threshold)
    free, masks, at = [], [], 0
    while at < len(taken):
        group, end = [], taken[at][0] + 1
        while at < len(taken) and taken[at][0] < end:
            s, e, k, q = taken[at]
            group.append((q, -e - s, -s, -k))
            end, at = max(end, -e), at + 1
        outer: dict[int, int] = {}  # by start and length, so a span of a kind is inside another if one before it ends later
        alone = []
        for q, size, s, k in group:
            if outer.get(k, -1) < size - s:
                alone.append((q, size, s, k))
                outer[k] = size - s
        settled: list[tuple[int, int, int]] = []
        for _, size, s, k in sorted(alone, reverse=True):
            place = bisect_left(settled, (-s, 0, 0))
            if (not place or settled[place - 1][2] <= -s) and (place == len(settled) or settled[place][0] >= size - s):
                settled.insert(place, (-s, -k, size - s))
        free += settled
        masks.append((-group[0][2], -max(alone)[3], end))
    return sorted(base + free), sorted(base + masks)


def find(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_sha256 and `spans` (kind:start:end, comma-joined) of every row.

    Positions are code points, ends exclusive. Null texts count as empty: no spans, the hash of the empty string.
    """
    found = materialize(map_text(docs, propose, FOUND), "spans")
    model = fit_on(found)

    def fn(batches):
        import pyarrow as pa

        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            values = [col[n].to_pylist() for n in ("kinds", "starts", "ends", "features", "base")]
            spans = [base if all(k < len(BASE) for k in ks) else joined(chosen(model, ks, s, e, f, threshold)[0]) for ks, s, e, f, base in zip(*values)]
            kept = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
            yield pa.RecordBatch.from_arrays([*(col[n] for n in kept), pa.array(spans, pa.string())], names=[*kept, "spans"])

    return found.mapInArrow(fn, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans all characters go."""
    out, end = [], 0
    for s, k, e in spans:
        if s >= end:
            out += [text[end:s], f"[{KINDS[k].upper()}]"]
        end = max(end, e)
    return "".join([*out, text[end:]])


def mask(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """`docs` with all found spans masked in `text`; n_chars, where there is such a column, follows. Nulls stay null."""
    model = fit_on(map_text(docs, propose, FOUND, keep=()))

    def fn(texts):
        out = []
        for t in texts:
            base = base_spans(t)
            spans = base + other_spans(t, base)
            features = [votes_and_features(t, s)[1] for s in spans]
            picked = chosen(model, [k for _, k, _ in spans], [s for s, _, _ in spans], [e for _, _, e in spans], features, threshold)[1] if spans else []
            out.append(masked(t, picked))
        return {"masked": out}

    row, text = free("row__", docs), F.col("text")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), text)
    done = map_text(packed, fn, "masked string", keep=(row,))
    new = F.when(F.col(row)["text"].isNotNull(), F.col("masked"))
    made = {"text": new, "n_chars": F.when(F.col(row)["text"].isNotNull(), F.length("masked")).otherwise(F.col(row)["n_chars"]) if "n_chars" in docs.columns else None}
    return done.select(*[(made[c].cast(docs.schema[c].dataType) if c in made else F.col(row)[c]).alias(c) for c in docs.columns])
