"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer reads words and writes symbols: insult, threat, target
(second or third person), first person, copula, negation, reported speech, or
nothing. Five deterministic transducers are composed behind it and rewrite the
symbols of a clause from left to right:

* insult: an insult within three words of a copula is said of somebody;
* threat: a violent verb counts in full only within four words of "I", "we"
  ... and with "you" ... among the three words behind it; alone it is a trace;
* target: an insult within four words of "you", "they" ... is aimed;
* negation: an insult or threat within three words of a negation is weakened;
* reported speech: what follows a verb of saying is weakened.

Products of their states are made when first met. A clause that writes an
insult or threat matches, and its score is the sum of the lexical weights times
the factor of what became of each symbol. A document's score is a logistic
function of the sum, the density and the strongest of its matched clauses.

Lexical weights are log-odds of words and word beginnings between toxic and
other labelled documents, kept where the difference is beyond chance. A word
beginning needs several words of its own: one that stands for a single frequent
word says nothing of others. The longest pattern of a word decides. A fixed
seed list covers words that the labels never show. Both steps are fitted on a
sample of labelled documents whose bound is a parameter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import kept, materialise

#: Labelled documents of either class that the fit reads at most.
SAMPLE_TOXIC, SAMPLE_OTHER = 3_000, 6_000
#: Learned patterns kept at most, by significance.
PATTERNS = 4_096
THRESHOLD = 0.3
#: Words whose symbols a task keeps, and their characters, before it begins anew.
KNOWN_WORDS, KNOWN_CHARACTERS = 100_000, 4 << 20

#: A word beginning is kept if toxic documents hold it in this many words, none of them in over half.
PREFIX_WORDS = 5

# --- fixed values: word lists in English, German, French and Spanish ---------
INSULTS = ("idiot idiots moron morons stupid dumb dumbass fool loser losers scum trash garbage clown clowns pathetic "
           "worthless disgusting imbecile cretin jerk bastard bitch asshole pig vermin parasite filth").split()
THREATS = ("kill murder hurt beat destroy strangle stab shoot hang burn crush smash töten umbringen ermorden erwürgen "
           "tuer assassiner étrangler frapper matar asesinar estrangular golpear").split()
FIRST_PERSON = "i we i'll we'll i'm we're gonna ich wir je nous j'irai vais yo nosotros voy vamos".split()
SECOND_PERSON = ("you your yours u du dich dir dein deine euch ihr tu te toi ton ta vous votre tú ti usted ustedes "
                 "vosotros").split()
THIRD_PERSON = "he she they them him her these those er ihm ihn ihnen ils elles ellos ellas".split()
COPULAS = "is are am was were be you're they're he's she's bist ist sind seid es est sont êtes eres es son".split()
NEGATIONS = ("not no never neither nor without isn't aren't wasn't weren't don't doesn't didn't won't can't cannot "
             "nicht kein keine keinen nie niemals ne pas jamais aucun nunca jamás ningún").split()
REPORTS = ("said says say told claimed claims wrote writes called calls quoted quotes reported according sagt sagte "
           "behauptet schrieb dit disait affirme écrit dijo dice afirma escribió").split()
# --- end of fixed values -------------------------------------------------------
SEED_WEIGHT = 2.5

_TOKENS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n]")
_STOPS = frozenset(".!?;:\n")
_PREFIXES = range(4, 9)


def words_of(text: str | None) -> list[str]:
    """Lower-case words and clause ends, in order."""
    return _TOKENS.findall(text.lower().replace("’", "'")) if text else []


def patterns_of(word: str) -> list[str]:
    """The word itself ("=word"), then its beginnings ("word^"), longest first."""
    return ["=" + word] + [word[:n] + "^" for n in reversed(_PREFIXES) if n <= len(word)]


# Transducers: (state, symbol) -> (state, symbol). Symbols: I insult, T threat, U second person,
# Y third person, F first person, C copula, N negation, R report, "." other. Added marks tell what
# became of a symbol: "=" said of somebody, "!" meant, "+" aimed, "-" negated, "'" reported. A "U!"
# completes the threat before it.

def _insult(left: int, s: str) -> tuple[int, str]:
    if s == "C":
        return 3, s
    return max(0, left - 1), s + "=" if left and s == "I" else s


def _threat(state: tuple[int, int], s: str) -> tuple[tuple[int, int], str]:
    meant, pending = state
    after = 4 if s == "F" else max(0, meant - 1)
    if s == "T" and meant:
        return (after, 3), "T!"
    if s == "U" and pending:
        return (after, 0), "U!"
    return (after, 0 if s == "T" else max(0, pending - 1)), s


def _target(left: int, s: str) -> tuple[int, str]:
    if s[0] in "UY":
        return 4, s
    return max(0, left - 1), s + "+" if left and s[0] == "I" else s


def _negation(left: int, s: str) -> tuple[int, str]:
    if s == "N":
        return 3, s
    return max(0, left - 1), s + "-" if left and s[0] in "IT" else s


def _reported(inside: int, s: str) -> tuple[int, str]:
    return (1, s) if s == "R" else (inside, s + "'" if inside and s[0] in "IT" else s)


_STAGES = (_insult, _threat, _target, _negation, _reported)
_START = (0, (0, 0), 0, 0, 0)
#: What a mark does to the weight of its word; a threat alone or meant is a trace until its target completes it.
FACTORS = {"=": 1.2, "+": 1.5, "-": 0.1, "'": 0.2, "!": 2.0}
TRACE, COMPLETED = 0.05, 12.0


class Composition:
    """The stages one behind the other; arrows of the product are kept."""

    def __init__(self, factors: dict[str, float] = FACTORS) -> None:
        self.factors = factors
        self.arrows: dict[tuple, tuple[tuple, float, bool]] = {}

    def step(self, state: tuple, symbol: str) -> tuple[tuple, float, bool]:
        """The next state, the factor of an I or T (0 for other symbols) and
        whether the symbol completes a threat."""
        arrow = self.arrows.get((state, symbol))
        if arrow is None:
            after, s = [], symbol
            for stage, at in zip(_STAGES, state):
                at, s = stage(at, s)
                after.append(at)
            factor = math.prod(self.factors[m] for m in s[1:]) if s[0] in "IT" else 0.0
            arrow = tuple(after), factor * (TRACE if s[0] == "T" else 1.0), s[0] == "U" and "!" in s
            self.arrows[state, symbol] = arrow
        return arrow

    def total(self, symbols: list[tuple[str, float]]) -> float:
        """Score of one clause, given as symbols with their lexical weights."""
        state, score, threat = _START, 0.0, 0.0
        for s, weight in symbols:
            state, factor, completes = self.step(state, s)
            part = factor * weight
            if s == "T":
                threat = part
            score += part + (COMPLETED * threat if completes else 0.0)
        return score


@dataclass
class Grammar:
    """Learned weights of patterns and of the document score."""

    weights: dict[str, float] = field(default_factory=dict)
    coefficients: tuple[float, ...] = (-3.0, 2.0, 0.5, 0.2)

    def __post_init__(self) -> None:
        fixed = {}
        for words, symbol in ((THIRD_PERSON, "Y"), (SECOND_PERSON, "U"), (FIRST_PERSON, "F"), (COPULAS, "C"),
                              (NEGATIONS, "N"), (REPORTS, "R")):
            fixed |= {w: (symbol, 0.0) for w in words}
        fixed |= {w: ("T", SEED_WEIGHT) for w in THREATS} | {w: ("I", SEED_WEIGHT) for w in INSULTS}
        self._fixed, self._known, self._held, self._chain = fixed, {}, 0, Composition()

    def __reduce__(self):
        return Grammar, (self.weights, self.coefficients)

    def symbol(self, word: str) -> tuple[str, float]:
        """What the lexicon writes for a word: the weight of its longest learned pattern goes first."""
        found = self._known.get(word)
        if found is None:
            self._held += len(word)
            if len(self._known) >= KNOWN_WORDS or self._held > KNOWN_CHARACTERS:
                self._known.clear()
                self._held = 0
            weight = next((self.weights[p] for p in patterns_of(word) if p in self.weights), 0.0)
            kind, seed = self._fixed.get(word, (".", 0.0))
            if kind == "T":
                found = "T", max(weight, seed)
            elif kind == "I" or weight and kind == ".":
                found = "I", max(weight, seed)
            else:
                found = kind, 0.0
            self._known[word] = found
        return found

    def clauses(self, text: str | None) -> tuple[list[tuple[str, float]], int]:
        """(clause, score) of each matched clause, and the number of words."""
        tokens = words_of(text)
        symbol = self.symbol
        marks = [symbol(t) for t in tokens]
        out, done = [], -1
        for i, (kind, _) in enumerate(marks):
            if kind not in "IT" or i <= done:
                continue
            a = i
            while a and tokens[a - 1] not in _STOPS:
                a -= 1
            b = i
            while b < len(tokens) and tokens[b] not in _STOPS:
                b += 1
            out.append((" ".join(tokens[a:b]), self._chain.total(marks[a:b])))
            done = b
        return out, len(tokens)

    def features(self, text: str | None) -> tuple[float, float, float, int]:
        """log of the clauses' sum, strongest clause, sum per hundred words, matched clauses."""
        found, n = self.clauses(text)
        total = sum(s for _, s in found)
        top = max((s for _, s in found), default=0.0)
        return math.log1p(total), min(top, 20.0), min(100.0 * total / max(n, 20), 50.0), len(found)

    def score(self, features: np.ndarray) -> np.ndarray:
        c = np.array(self.coefficients)
        return 1 / (1 + np.exp(-np.clip(c[0] + features @ c[1:], -30, 30)))


def held_out(doc_id: str):
    """Rows that no fit may read."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string")) % 4 == 2, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, toxic: int, other: int) -> DataFrame:
    """doc_id, text, toxic of a bounded sample, chosen by a hash of the id."""
    known = (labels.filter("doc_id is not null and toxic in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.col("doc_id"), F.lit("toxicity"))
    some = known.filter("toxic = 1").orderBy(order).limit(toxic).union(
        known.filter("toxic = 0").orderBy(order).limit(other))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    mine = texts.join(F.broadcast(some), "doc_id")  # bounded by the sample
    # of several texts under one id the one of least hash
    return mine.groupBy("doc_id", "toxic").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("doc_id", "t.text", "toxic")


def _learned(sample: DataFrame, toxic: int, other: int) -> dict[str, float]:
    """Weights of the patterns that toxic documents hold beyond chance.

    A word beginning also needs ``PREFIX_WORDS`` words below it in toxic
    documents, none of them in more than half of its documents.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept("toxicity")
        for pdf in batches:
            for text, label in zip(pdf["text"], pdf["toxic"]):
                words = sorted(set(words_of(text)) - _STOPS)
                rows, met = [], set()
                for w in words:
                    for p in patterns_of(w):
                        rows.append((p, w, int(p not in met)))  # a document counts once for a pattern
                        met.add(p)
                yield pd.DataFrame(rows, columns=["pattern", "word", "first"]).assign(toxic=label)

    seen = sample.select("text", "toxic").mapInPandas(count, "pattern string, word string, first long, toxic int")
    by_word = seen.groupBy("pattern", "word").agg(
        F.sum("toxic").alias("held"), F.sum(F.col("first") * F.col("toxic")).alias("p"),
        F.sum(F.col("first") * (1 - F.col("toxic"))).alias("n"))
    counts = by_word.groupBy("pattern").agg(
        F.sum("p").alias("p"), F.sum("n").alias("n"), F.max("held").alias("top"),
        F.sum((F.col("held") > 0).cast("int")).alias("words"))
    whole = F.col("pattern").startswith("=")
    broad = (F.col("words") >= PREFIX_WORDS) & (2 * F.col("top") <= F.col("p"))
    counts = materialise(counts.filter((F.col("p") >= 3) & (whole | broad)).drop("top", "words"), "patterns")
    total = toxic + other
    # log-likelihood ratio of the 2 x 2 table against independence
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    inside = p + n

    def term(seen_, share, size):
        expected = size * F.lit(share / total)
        return F.when(seen_ > 0, seen_ * F.log(seen_ / expected)).otherwise(0.0)

    g = 2 * (term(p, toxic, inside) + term(n, other, inside) + term(F.lit(float(toxic)) - p, toxic, total - inside)
             + term(F.lit(float(other)) - n, other, total - inside))
    odds = F.log((p + 0.5) / (toxic + 1.0)) - F.log((n + 0.5) / (other + 1.0))
    scored = counts.select("pattern", "p", "n", g.alias("g"), odds.alias("odds"))
    enough = 2 * math.log(20.0 * max(counts.count(), 1))
    best = scored.filter((F.col("g") >= enough) & (F.col("odds") >= 1.5)).orderBy(
        F.desc("g"), "pattern").limit(PATTERNS).collect()  # bounded
    return _own_evidence([tuple(r) for r in best], toxic, other)


def _own_evidence(best: list[tuple], toxic: int, other: int) -> dict[str, float]:
    """Weights of (pattern, p, n, g, odds) rows. A word beginning stays if it is
    as telling without the documents of each longer beginning that is kept;
    otherwise it would reach further on the same evidence."""
    weights = {r[0]: min(r[4], 6.0) for r in best if r[0].startswith("=")}
    for pattern, p, n, _, odds in sorted((r for r in best if r[0].endswith("^")), key=lambda r: -len(r[0])):
        left = [(p - q, max(n - m, 0)) for longer, q, m, *_ in best
                if longer in weights and len(longer) > len(pattern) and longer.startswith(pattern[:-1])]
        if all(a >= 3 and math.log((a + 0.5) / (toxic + 1.0)) - math.log((b + 0.5) / (other + 1.0)) >= 1.5
               for a, b in left):
            weights[pattern] = min(odds, 6.0)
    return weights


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05, rounds: int = 40) -> tuple[float, ...]:
    """Ridge-penalised logistic regression by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    c = np.zeros(a.shape[1])
    ridge = penalty * np.eye(len(c))
    ridge[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ c, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ c)
        c += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in c)


def fit(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, other: int = SAMPLE_OTHER) -> Grammar:
    """Learn a grammar from labelled documents outside the held-out quarter.

    Without a labelled document of both classes the seed lists and fixed
    coefficients are the grammar.
    """
    sample = materialise(_sample(docs, labels, toxic, other), "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return Grammar()
    grammar = Grammar(_learned(sample, sizes[1], sizes[0]))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [grammar.features(t) for t in pdf["text"]]
            yield pd.DataFrame(rows, columns=["a", "b", "c", "m"]).assign(y=pdf["toxic"].to_numpy())[["a", "b", "c", "y"]]

    rows = sample.select("text", "toxic").mapInPandas(features, "a double, b double, c double, y int").collect()
    table = np.array([tuple(r) for r in rows], dtype=float)  # four numbers for each document of the sample
    grammar.coefficients = _logistic(table[:, :3], table[:, 3])
    return grammar


def score(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """docs (doc_id, text) -> doc_id, held_out, score, predicted, n_clauses.

    Null and empty texts match no clause and get the score of none. Rows come
    back as often as given; a null doc_id is not held out. Other columns are
    not read.
    """
    @F.pandas_udf("score double, n_clauses int")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kept("toxicity")
        for texts in batches:
            rows = np.array([grammar.features(t) for t in texts], dtype=float).reshape(-1, 4)
            yield pd.DataFrame({"score": grammar.score(rows[:, :3]), "n_clauses": rows[:, 3].astype(np.int32)})

    return docs.select("doc_id", held_out("doc_id").alias("held_out"), udf("text").alias("r")).select(
        "doc_id", "held_out", "r.score", (F.col("r.score") >= threshold).cast("int").alias("predicted"), "r.n_clauses")


def apply(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns kept."""
    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept("toxicity")
        for texts in batches:
            rows = np.array([grammar.features(t) for t in texts], dtype=float).reshape(-1, 4)
            yield pd.Series(grammar.score(rows[:, :3]))

    return docs.filter(udf("text") < threshold)
