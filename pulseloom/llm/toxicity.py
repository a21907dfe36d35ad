"""Toxic texts by a weighted lexicon, matched in one pass by an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters of other scripts and digits or signs that stand for letters
become one letter. Lexicon entries are word starts, so that inflected forms match. An entry inside an exception
phrase does not count. The weights of what was found are added up, divided by the length of the text and turned into
a score by a logistic curve.

The lexicon is learned from labelled texts: a word start is an entry if it stands in toxic texts after many different
words and hardly ever in other texts. Counting the words before it, and not the texts, keeps out the rest of the words of
a toxic text that was copied many times.
"""

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.llm.common import fold, labelled_sample, map_text

#: Letters that look like Latin ones (Cyrillic, Greek, full width), and signs and digits used for letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "υ": "u", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "χ": "x", "ı": "i",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "l": "i", "|": "i"}
#: Insults that are entries even where the labelled texts have none of them.
SEEDS = ("idiot", "moron", "imbecile", "scum", "worthless", "pathetic", "loser", "disgusting", "stupid")
#: Phrases in which an entry means something else.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum", "scum line", "bad loser", "good loser", "loser pays")
_TABLE = str.maketrans(HOMOGLYPHS | SUBSTITUTES | {chr(0xFF41 + i): chr(97 + i) for i in range(26)} | {"​": None, "‌": None, "‍": None, "\xad": None})
_WORD = re.compile(r"[^\W\d_]+")


def folded(text: str) -> str:
    """Lower case, look-alikes and substitutes as one letter; the letter l becomes i, since 1 stands for both."""
    return text.lower().translate(_TABLE)


@dataclass(frozen=True)
class Lexicon:
    """Weights of folded word starts, folded exception phrases, and the curve: 1 / (1 + exp(-(slope * x + shift)))."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    slope: float = 1.0
    shift: float = 0.0
    _built: dict = field(default_factory=dict, compare=False, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "slope": self.slope, "shift": self.shift, "_built": {}}

    def automaton(self):
        if "a" not in self._built:
            a = ahocorasick.Automaton()
            for w, weight in self.weights.items():
                a.add_word(w, (len(w), weight))
            for phrase in self.exceptions:
                a.add_word(phrase, (len(phrase), None))
            if len(a):
                a.make_automaton()
            self._built["a"] = a
        return self._built["a"]

    def found(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) in the folded text; of entries at one start the longest, none in an exception phrase."""
        t, a = folded(text), self.automaton()
        if not len(a):
            return []
        best: dict[int, tuple[int, float]] = {}
        excused = []
        for last, (n, weight) in a.iter(t):
            start = last + 1 - n
            if start and t[start - 1].isalpha():
                continue
            if weight is None:
                if last + 1 == len(t) or not t[last + 1].isalpha():
                    excused.append((start, last + 1))
            elif start not in best or n > best[start][0]:
                best[start] = n, weight
        out = [(s, s + n, w) for s, (n, w) in sorted(best.items())]
        if not excused:
            return out
        excused.sort()
        kept, k, far = [], 0, 0  # far: where the phrases that start before an entry end at most
        for s, e, w in out:
            while k < len(excused) and excused[k][0] <= s:
                far = max(far, excused[k][1])
                k += 1
            if e > far:
                kept.append((s, e, w))
        return kept

    def strength(self, text: str, hits: list[tuple[int, int, float]] | None = None) -> float:
        """Weights found, normalised by length: log(1 + 100 * sum / (words + 20))."""
        hits = self.found(text) if hits is None else hits
        return math.log1p(100 * sum(w for _, _, w in hits) / (len(text.split()) + 20)) if hits else 0.0

    def rated(self, text: str) -> tuple[float, int]:
        """Score, and number of entries found."""
        hits = self.found(text)
        z = self.slope * self.strength(text, hits) + self.shift
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), len(hits)

    def score(self, text: str) -> float:
        return self.rated(text)[0]


def learn(sample: list[tuple[str, int]], min_contexts: int = 12, min_texts: int = 4, min_ratio: float = 20.0, exceptions=EXCEPTIONS, seeds=SEEDS) -> Lexicon:
    """A lexicon from (text, 1 if toxic) pairs.

    A word start of 4 to 9 letters is an entry if toxic texts have it after at least `min_contexts` different words, in
    `min_texts` texts or more, and `min_ratio` times as often (in texts) as the others have it. Of nested starts with about the same support the longest is
    taken. The weight is the logarithm of the ratio. Without toxic texts only the seeds remain.
    """
    n = [max(1, sum(y == k for _, y in sample)) for k in (0, 1)]

    def starts(kind):
        """(word before, word starts) of every word of the texts of a kind."""
        for text, y in sample:
            if y == kind:
                words = _WORD.findall(folded(text))
                for before, w in zip(["", *words], words):
                    yield before, [w[:k] for k in range(4, min(9, len(w)) + 1)]

    def texts_with(kind, wanted=None):
        """In how many texts of a kind each word start stands."""
        seen: Counter = Counter()
        for text, y in sample:
            if y == kind:
                words = {w[:9] for w in _WORD.findall(folded(text))}
                seen.update({w[:k] for w in words for k in range(4, len(w) + 1) if wanted is None or w[:k] in wanted})
        return seen

    often = {t: c for t, c in texts_with(1).items() if c >= min_texts}
    other = texts_with(0, often)
    ratio = {t: (c / n[1]) / ((other[t] + 0.5) / n[0]) for t, c in often.items()}
    ratio = {t: r for t, r in ratio.items() if r >= min_ratio}
    contexts: dict[str, set[str]] = defaultdict(set)
    for before, some in starts(1):
        for t in some:
            if t in ratio:
                contexts[t].add(before)
    able = {t: len(c) for t, c in contexts.items()}
    good = {t for t, c in able.items() if c >= min_contexts}
    children: dict[str, list[str]] = defaultdict(list)
    for t in good:
        children[t[:-1]].append(t)
    weights = {folded(s): 3.0 for s in seeds}
    chosen: set[str] = set()
    for t in sorted(good, key=lambda t: (len(t), t)):
        if not any(t[:k] in chosen for k in range(4, len(t))) and not any(able[x] >= 0.9 * able[t] for x in children.get(t, ())):
            chosen.add(t)
            weights[t] = math.log(ratio[t])
    rough = Lexicon(weights, tuple(folded(e) for e in exceptions))
    x, y = np.array([rough.strength(t) for t, _ in sample]), np.array([k for _, k in sample], float)
    slope, shift = curve(x, y) if 0 < y.sum() < len(y) else (4.0, -2.0)
    return Lexicon(weights, rough.exceptions, slope, shift)


def curve(x: np.ndarray, y: np.ndarray, steps: int = 400) -> tuple[float, float]:
    """Slope and shift of a logistic curve, both classes with the same weight, by Newton's method with a small ridge."""
    w = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    beta = np.array([1.0, -0.5])
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (w * (p - y)) + 1e-3 * beta
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - step
        if abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5, text="text", keep=("doc_id",)) -> DataFrame:
    """Columns `keep`, score, predicted and the number of entries found. Null and empty texts get the score of no entry."""
    def fn(texts):
        rated = [lexicon.rated(t) for t in texts]
        return {"score": [s for s, _ in rated], "predicted": [int(s >= threshold) for s, _ in rated], "n_found": [n for _, n in rated]}

    return map_text(docs, fn, "score double, predicted int, n_found int", text, keep)


def learned_score(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = (4500, 1500), max_chars: int = 50_000) -> DataFrame:
    """doc_id, held_out, score, predicted, n_found of every row; the lexicon comes from at most `per_class`
    texts (not toxic, toxic) that are not held out and have at most `max_chars` characters."""
    lexicon = learn(labelled_sample(docs, labels, "toxic", per_class, max_chars))
    return score(docs, lexicon).withColumn("held_out", fold() == F.lit(0))
