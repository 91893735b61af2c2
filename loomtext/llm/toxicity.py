"""Toxicity: a lexicon trie searched with Levenshtein automata, and scores of the words around.

The lexicon is learned from labelled rows: words, and stems that open words, which separate toxic
from clean texts. A text's words are matched against it within one edit; matches between quotation
marks or beside words of reporting count as quotation. A logistic model over the text's sums gives
the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.operators.scale import written

# Most labelled rows that the lexicon and the model are fitted on; which ones, a hash of the id says.
FIT_ROWS = 12_000
# A term must separate the classes by this much (G squared) and hold this much more often.
LEAST_G2, LEAST_LOG_ODDS, STEM = 15.0, 3.5, (4, 5, 6)
# Terms are taken until every toxic text has so many; each must help a fifth of its texts. So the
# words that copies of one text share add nothing once its telling words are in.
COVER, HELPS = 4, 0.2
FUZZY_FROM, FUZZY_WEIGHT = 5, 0.6  # edits are allowed in words of so many letters
# A stem is open to edits unless clean texts hold more words than this that are one edit from it.
NEAR_STEM = 3
AROUND, QUOTED = 6, 0.25  # words on each side that are looked at; what is left of a quotation
REPORTING = frozenset("said says quote quoted quotes word term called wrote sagte dit dijo".split())
OPENING, CLOSING = "\"'“„«‘‚(", "\"'”“»’)"
WORDS_HELD = 400_000
THRESHOLD = 0.7

_CUT = re.compile(r"[^\w]+")


def held_out(doc_id: Column) -> Column:
    """The rows that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def _terms(text: str) -> set[str]:
    words = {w for w in _CUT.split(text.lower()) if w}
    return words | {w[:n] + "*" for w in words for n in STEM if len(w) >= n}


def _cuts(word: str) -> set[str]:
    """A word, and it without one of its letters; words within one edit share one of these."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


class LexiconTrie:
    """Terms in a trie; ``term*`` matches every word that it opens, within one edit if it is long.

    Terms in ``closed`` match without an edit only.
    """

    def __init__(self, terms: Iterable[str], closed: frozenset[str] = frozenset()):
        self.closed = closed
        self.root: dict = {}
        # What one edit leaves of a term: the half at one end of a word of about its length, and
        # of a stem its first half or, at most one place off, its second.
        self.starts: defaultdict[int, set[str]] = defaultdict(set)
        self.ends: defaultdict[int, set[str]] = defaultdict(set)
        self.parts: defaultdict[tuple[int, int], set[str]] = defaultdict(set)
        self.cuts: set[str] = set()
        self.openings: dict[str, bool] = {}  # remembered: whether a stem is near words that open so
        self.stem_cuts: defaultdict[int, set[str]] = defaultdict(set)  # by the stem's length
        for term in terms:
            stem = term.endswith("*")
            word = term.removesuffix("*")
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node["*" if stem else ""] = term
            if len(word) < FUZZY_FROM or term in closed:
                continue
            half = len(word) // 2
            if stem:
                self.stem_cuts[len(word)] |= _cuts(word)
                self.parts[0, half].add(word[:half])
                for at in (half - 1, half, half + 1):
                    self.parts[at, at + len(word) - half].add(word[half:])
            else:
                self.cuts |= _cuts(word)
                for n in (len(word) - 1, len(word), len(word) + 1):
                    self.starts[n].add(word[:half])
                    self.ends[n].add(word[half:])
        self.halves = {
            n: ({len(x) for x in self.starts[n]}, {len(x) for x in self.ends[n]}) for n in self.starts
        }

    def near(self, word: str) -> bool:
        """Whether half a term stands where one edit leaves it, and a cut of the word is one of a term's."""
        first = word[: STEM[-1] + 1]  # all that a stem within one edit can depend on
        near = self.openings.get(first)
        if near is None:
            if len(self.openings) > WORDS_HELD:
                self.openings.clear()
            near = any(first[a:b] in parts for (a, b), parts in self.parts.items()) and any(
                not cuts.isdisjoint(_cuts(first[:k])) for n, cuts in self.stem_cuts.items() for k in (n - 1, n, n + 1)
            )
            self.openings[first] = near
        if near:
            return True
        n = len(word)
        if n not in self.halves:
            return False
        starts, ends = self.halves[n]
        if any([word[:k] in self.starts[n] for k in starts]) or any([word[-k:] in self.ends[n] for k in ends]):
            return not self.cuts.isdisjoint(_cuts(word))
        return False

    def find(self, word: str) -> dict[str, int]:
        """Terms within reach of a word, with their edits (0 or 1).

        The automaton's state is the row of edit distances between the trie's path and every
        prefix of the word; a path is left once no entry is within one edit.
        """
        found: dict[str, int] = {}
        node = self.root
        for c in word:  # no edit: one path
            node = node.get(c)
            if node is None:
                break
            if "*" in node:
                found[node["*"]] = 0
        else:
            if "" in node:
                found[node[""]] = 0
        if self.near(word):
            self._walk(self.root, word, list(range(len(word) + 1)), 0, found)
        return found

    def _walk(self, node: dict, word: str, row: list[int], depth: int, found: dict[str, int]) -> None:
        for c, below in node.items():
            if len(c) != 1 or c == "*":
                continue
            new = [depth + 1]
            for i, w in enumerate(word, 1):
                new.append(min(row[i - 1] + (w != c), row[i] + 1, new[i - 1] + 1))
            if min(new) > 1:
                continue
            if "" in below and depth + 1 >= FUZZY_FROM and new[-1] <= 1:
                found.setdefault(below[""], new[-1])
            if "*" in below and depth + 1 >= FUZZY_FROM and below["*"] not in self.closed:  # some prefix of the word is within one edit
                found.setdefault(below["*"], min(new))
            self._walk(below, word, new, depth + 1, found)


class Matcher(dict):
    """A word's weight and term, remembered; None for words without a match.

    Words in ``closed`` are no misspellings of a term, and stems in it have none.
    """

    def __init__(self, weights: dict[str, float], closed: frozenset[str] = frozenset()):
        super().__init__()
        self.weights, self.closed, self.trie = weights, closed, LexiconTrie(weights, closed)
        # A word under a stem of the lexicon counts as that stem, so one abuse stays one term.
        self.names = {t: next((t[:n] + "*" for n in STEM if t[:n] + "*" in weights), t) for t in weights}

    def __missing__(self, word: str) -> tuple[float, str] | None:
        if len(self) > WORDS_HELD:
            self.clear()
        best = None
        for part in _CUT.split(word):
            if part:
                for term, edits in self.trie.find(part).items():
                    if edits and part in self.closed:
                        continue
                    weight = self.weights[term] * (FUZZY_WEIGHT if edits else 1.0)
                    hit = weight, self.names[term]
                    best = max(best or hit, hit)
        self[word] = best
        return best


def _quoted(words: list[str], at: int) -> bool:
    """Whether the word stands between quotation marks or beside a word of reporting."""
    before, after = words[max(0, at - AROUND) : at], words[at + 1 : at + 1 + AROUND]
    opens = words[at][0] in OPENING or any(w[0] in OPENING for w in before)
    closes = words[at].rstrip(".,;:!?")[-1:] in CLOSING or any(w.rstrip(".,;:!?")[-1:] in CLOSING for w in after)
    if opens and closes and not all(w in OPENING + CLOSING for w in (words[at],)):
        return True
    return any(_CUT.sub("", w) in REPORTING for w in (*before, *after))


FEATURES = 5


def features(text: str, matcher: Matcher) -> list[float]:
    """Abuse and quotation in a text: summed weight, strongest word, distinct terms, density, quoted."""
    words = text.lower().split()
    hits = [(n, m) for n, m in enumerate(map(matcher.__getitem__, words)) if m]
    if not hits:
        return [0.0] * FEATURES
    total = strongest = quoted = 0.0
    terms = set()
    for n, (weight, term) in hits:
        if _quoted(words, n):
            quoted += weight
            weight *= QUOTED
        else:
            terms.add(term)
        total += weight
        strongest = max(strongest, weight)
    return [math.log1p(total), strongest, math.log1p(len(terms)), math.log1p(100 * total / len(words)), math.log1p(quoted)]


def _sample(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` labelled texts that are not held out, each text once."""
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    chosen = docs.join(F.broadcast(known), "doc_id")  # at most fit_rows ids
    rows = chosen.select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
    once = rows.groupBy(F.md5("text").alias("_h")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    return written(once.select("text", "toxic"), "toxicity-sample")


def _near_words(sample: DataFrame, terms: list[str]) -> dict[str, set[str]]:
    """By term: the words of clean texts that are one edit from it."""
    trie = LexiconTrie(terms)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for w in {w for w in _CUT.split(text.lower()) if w} - known.keys():
                    known[w] = [t for t, edits in trie.find(w).items() if edits] if trie.near(w) else []
        pairs = [(t, w) for w, found in known.items() for t in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], type=pa.string()) for i in (0, 1)], names=["term", "word"]
        )

    pairs = sample.filter("toxic = 0").select("text").mapInArrow(near, "term string, word string").distinct()
    found: dict[str, set[str]] = {t: set() for t in terms}
    for r in pairs.collect():  # the sample is bounded
        found[r["term"]].add(r["word"])
    return found


def _learn_lexicon(sample: DataFrame) -> tuple[dict[str, float], frozenset[str]]:
    """Weights of the terms that separate toxic from clean texts and are not each other's shadow.

    Whole words and longer stems under a stem that is taken add no texts to it, but they can be
    found with an edit, which a short stem cannot; so they are kept beside it. The second value is
    what is closed to edits: stems that come near many words of clean texts, and the words of clean
    texts that come near the rest of those terms.
    """
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        return {}, frozenset()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                totals[toxic].update(_terms(text))
        terms = list(totals[0].keys() | totals[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, type=pa.string()), *(pa.array([t[x] for x in terms], type=pa.int64()) for t in totals)],
            names=["term", "clean", "toxic"],
        )

    counted = (
        sample.select("text", F.col("toxic").cast("int"))
        .mapInArrow(count, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))

    def part(seen: Column, size: int) -> Column:
        expected = (F.col("clean") + F.col("toxic")) * (size / (n_toxic + n_clean))
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g2 = 2 * (part(F.col("toxic"), n_toxic) + part(F.col("clean"), n_clean))
    good = counted.withColumns({"g2": g2, "odds": odds}).filter(
        (F.col("g2") >= LEAST_G2) & (F.col("odds") >= LEAST_LOG_ODDS)
    )
    # The sample is bounded, and so are its terms.
    ranked = [(r["term"], r["odds"]) for r in good.orderBy(F.desc("g2"), F.length("term"), "term").collect()]
    wanted = {t for t, _ in ranked}
    texts: dict[str, list[int]] = {t: [] for t in wanted}
    toxic_texts = [r["text"] for r in sample.filter("toxic = 1").select("text").collect()]
    for i, text in enumerate(toxic_texts):
        for t in _terms(text) & wanted:
            texts[t].append(i)
    covered = [0] * len(toxic_texts)
    lexicon: dict[str, float] = {}
    beside: dict[str, float] = {}
    for term, weight in ranked:
        if any(term[:n] + "*" in lexicon for n in STEM):
            if len(term.removesuffix("*")) >= FUZZY_FROM:
                beside[term] = weight
            continue
        if term.endswith("*") and any(taken.startswith(term.removesuffix("*")) for taken in lexicon):
            continue  # the same words as a term that is in
        short = sum(covered[i] < COVER for i in texts[term])
        if short >= max(2, HELPS * len(texts[term])):
            lexicon[term] = weight
            for i in texts[term]:
                covered[i] += 1
    judged = [t for t in (*lexicon, *beside) if t in beside or (t.endswith("*") and len(t) > FUZZY_FROM)]
    near = _near_words(sample, judged) if judged else {}
    loose = {t for t, words in near.items() if t.endswith("*") and len(words) > NEAR_STEM}
    plain = {w for t, words in near.items() if t not in loose for w in words}
    return lexicon | {t: w for t, w in beside.items() if t not in loose}, frozenset(plain | loose)


class ToxicityModel:
    """Term weights, the logistic model's over ``features`` with its constant last, what takes no edits."""

    def __init__(self, lexicon: dict[str, float], coefficients: list[float], closed: frozenset[str] = frozenset()):
        self.lexicon, self.closed, self.coefficients = lexicon, closed, np.asarray(coefficients)

    def score(self, text: str, matcher: Matcher) -> float:
        z = float(np.dot(self.coefficients[:-1], features(text, matcher)) + self.coefficients[-1])
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn a lexicon and a model from the labelled rows that are not held out.

    ``docs``: doc_id, text; ``labels``: doc_id, toxic (0 or 1; other values and null ids are
    ignored, a row labelled both ways is toxic). At most ``fit_rows`` labelled rows are used.
    Without labels of both classes every text scores 0.5 less than a thousandth, or the class seen.
    """
    sample = _sample(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), fit_rows)
    lexicon, closed = _learn_lexicon(sample)
    if not lexicon:
        share = sample.agg(F.avg("toxic")).first()[0]
        share = min(max(share if share is not None else 0.499, 1e-3), 0.999)
        return ToxicityModel({}, [0.0] * FEATURES + [math.log(share / (1 - share))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon, closed)
        for batch in batches:
            rows = [features(t, matcher) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, type=pa.list_(pa.float64())), batch.column(1)], names=["x", "label"]
            )

    seen = sample.select("text", F.col("toxic").cast("double").alias("label"))
    rows = written(seen.mapInArrow(measure, "x array<double>, label double"), "toxicity-features")
    fitted = LogisticRegression(regParam=1e-4, maxIter=50, standardization=True).fit(
        rows.select(array_to_vector("x").alias("features"), "label")
    )
    return ToxicityModel(lexicon, [*fitted.coefficients.toArray().tolist(), fitted.intercept], closed)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Every whole text scored: ``doc_id, held_out, score, predicted`` (1 from 0.7 on).

    One row per input row, in place, without a shuffle; the score sees the text alone. Null texts
    count as empty and get the score of a text without a match; a null id is not held out. Other
    columns are ignored.
    """
    marked = F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    scored = docs.select("doc_id", marked, _score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def _score(docs: DataFrame, model: ToxicityModel) -> Column:
    """The score of a row's text; only the texts go to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a bounded lexicon

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(shared.value.lexicon, shared.value.closed)
        for texts in batches:
            yield pa.array([shared.value.score(t.as_py() or "", matcher) for t in texts], type=pa.float64())

    return score(docs["text"].cast("string"))


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    return docs.filter(_score(docs, model) < THRESHOLD)
