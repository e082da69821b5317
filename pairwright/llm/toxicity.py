"""Toxicity: misspelled lexicon terms by Levenshtein automata, weighed by their context.

The lexicon is learned from labelled texts: words that occur in toxic texts and hardly
elsewhere. It forms a trie. The Levenshtein automata of all its terms, intersected with the
trie, are one automaton: its states are sets of trie nodes with the edits spent so far, and
a letter leads from set to set. States and their transitions are made when a word first
needs them and kept, up to a bound; most words leave the automaton after a few letters.

A hit inside a pair of quotation marks, opened before and closed after it within a window,
or a few words after a word of saying counts as quoted. A logistic model over the hits of a
text (exact, misspelled, quoted; by log-odds and density) gives the score.

Defined results: a missing or empty text has no hits and the score of that; equal texts
have equal scores. Of repeated or contradicting labels of one text the toxic one counts.
Ids, labels, language and source never enter a score; columns of the input other than id
and text are not used by ``score``. Without labelled texts of both kinds every text has the
score of their share. An empty table has no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import kept, whole

# Bounds of the fit: labelled texts read, and lexicon entries kept.
TRAINING_ROWS = 10_000
LEXICON_TERMS = 1_000
# A term is found in so many toxic texts at least, and in so large a share of them.
MIN_DOCUMENTS = 4
MIN_SHARE = 0.015
MIN_PRECISION = 0.9
# Words remembered, and elements of automaton states: a few megabytes each.
CACHE_WORDS = 30_000
HELD_ELEMENTS = 300_000
THRESHOLD = 0.3
QUOTE_WORDS = 6
QUOTE_CHARS = 300
_WORD = re.compile(r"[^\W_]+(?:['’@$!*0-9][^\W_]+)*")
# What stands between a pair of quotation marks, on one line and within a window.
_QUOTED = re.compile(
    "|".join(
        rf"{opened}[^{opened}{closed}\n]{{1,{QUOTE_CHARS}}}[{closed}]"
        for opened, closed in (('"', '"'), ("“", "”"), ("„", "“”"), ("«", "»"), ("»", "«"), ("‹", "›"), ("‘", "’"), ("‚", "‘’"))
    )
)
_SAYING = frozenset("said says say wrote writes called calls quote quoted quotes word term sagte schrieb dit dijo escribió".split())


def allowance(term: str) -> int:
    """Edits by which a word may differ from a term; a swap of neighbouring letters is one."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """All words within reach of a lexicon term, as a lazily made deterministic automaton.

    An element of a state is a trie node and the edits spent to get there. Reading a letter
    goes to the child of that letter, or spends an edit: stay (the letter is extra), go to
    another child (it is wrong), or wait at a grandchild for the letter that was swapped.
    Going to a child without reading (a letter is missing) closes every state. Of a node,
    the cheapest element counts; one that spent more than any term below allows is dropped.
    """

    def __init__(self, weights: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.reach = [0]
        self.ends: dict[int, tuple[int, float]] = {}
        for term, weight in weights.items():
            node = 0
            allowed = allowance(term)
            self.reach[0] = max(self.reach[0], allowed)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], allowed)
            self.ends[node] = allowed, weight
        self.letters = {letter for child in self.children for letter in child}
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[frozenset, int] = {frozenset(): 0}
        self.states: list[frozenset] = [frozenset()]
        self.steps: list[dict[str, int]] = [{}]
        self.found: list[tuple[float, int] | None] = [None]
        self.held = 0
        self.start = self._state({(0, ""): 0})

    def _state(self, elements: dict[tuple[int, str], int]) -> int:
        """Number of the state with these elements, ``{(node, letter waited for): edits}``, once closed."""
        todo = list(elements.items())
        while todo:
            (node, waits), edits = todo.pop()
            if waits or edits >= self.reach[node] or elements[node, waits] < edits:
                continue
            for child in self.children[node].values():
                if edits + 1 <= self.reach[child] and elements.get((child, ""), 9) > edits + 1:
                    elements[child, ""] = edits + 1
                    todo.append(((child, ""), edits + 1))
        state = frozenset(elements.items())
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            self.found.append(self._best(state))
            self.held += len(state) + 4
        return number

    def _best(self, state: frozenset) -> tuple[float, int] | None:
        """Weight and edits of the nearest term, the heavier one on ties."""
        hits = [
            (edits, -self.ends[node][1]) for (node, waits), edits in state
            if not waits and node in self.ends and edits <= self.ends[node][0]
        ]
        return (-min(hits)[1], min(hits)[0]) if hits else None

    def _step(self, number: int, letter: str) -> int:
        after: dict[tuple[int, str], int] = {}

        def enter(node: int, waits: str, edits: int) -> None:
            if edits <= self.reach[node] and after.get((node, waits), 9) > edits:
                after[node, waits] = edits

        for (node, waits), edits in self.states[number]:
            if waits:
                if waits == letter:
                    enter(node, "", edits)
                continue
            enter(node, "", edits + 1)
            for other, child in self.children[node].items():
                enter(child, "", edits + (other != letter))
                if other != letter and letter in self.children[child]:
                    enter(self.children[child][letter], other, edits + 1)
        return self._state(after) if after else 0

    def match(self, word: str) -> tuple[float, int] | None:
        """Weight and distance of the nearest term whose allowance the word keeps."""
        if self.held > HELD_ELEMENTS:
            self._forget()
        number, steps = self.start, self.steps
        for letter in word:
            after = steps[number].get(letter)
            if after is None:
                # Letters of no term are all alike; they are not entered one by one.
                known = letter if letter in self.letters else ""
                after = steps[number].get(known)
                if after is None:
                    after = steps[number][known] = self._step(number, known)
                    self.held += 1
            if not after:
                return None
            number = after
        return self.found[number]


FEATURES = ("exact", "misspelled", "quoted", "kinds", "density", "none")


class Scanner:
    """Finds hits in texts; remembers words across texts, up to a bound."""

    def __init__(self, weights: dict[str, float]):
        self.automaton = Automaton(weights)
        self.words: dict[str, tuple[float, int] | None] = {}

    def hits(self, text: str) -> list[tuple[int, int, str, float, int, bool]]:
        """``(start, end, word, weight, distance, quoted)`` in code points."""
        known, out = self.words, []
        lowered = text.lower()
        lowered = lowered if len(lowered) == len(text) else "".join(c.lower()[0] for c in text)
        words = _WORD.findall(lowered)
        strange = {w for w in words if w not in known}
        if len(known) + len(strange) > CACHE_WORDS:
            known.clear()
            strange = set(words)
        for word in strange:
            known[word] = self.automaton.match(word)
        if not any(map(known.get, words)):
            return out
        spans = list(_WORD.finditer(lowered))
        quotes = [m.span() for m in _QUOTED.finditer(text)]
        ends = [b for _, b in quotes]
        for place, span in enumerate(spans):
            found = known[span.group()]
            if found is not None:
                first = max(0, place - QUOTE_WORDS)
                before = {s.group() for s in spans[first:place]}
                around = bisect_right(ends, span.start())
                inside = around < len(quotes) and quotes[around][0] < span.start()
                out.append((span.start(), span.end(), span.group(), *found, inside or bool(before & _SAYING)))
        return out

    def features(self, text: str) -> list[float]:
        hits = self.hits(text)
        exact = sum(w for *_, w, d, q in hits if not d and not q)
        off = sum(w for *_, w, d, q in hits if d and not q)
        quoted = sum(w for *_, w, d, q in hits if q)
        kinds = len({h[2] for h in hits if not h[5]})
        density = sum(h[3] for h in hits if not h[5]) * 100 / (len(text) // 6 + 20)
        return [math.log1p(exact), math.log1p(off), math.log1p(quoted), math.log1p(kinds), math.log1p(density), float(not hits)]


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    coefficients: list[float] = field(default_factory=list)
    intercept: float = 0.0


def logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last coefficient is the intercept."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (labels - p) - penalty * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def learn_lexicon(texts: DataFrame) -> dict[str, float]:
    """Terms by how much likelier they are in toxic texts: log-odds of document frequencies.

    ``texts`` has ``text, label`` with distinct texts. A term must occur in a few
    toxic texts and in far fewer others.
    """
    terms = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)[^\W_]+"), F.lit(0))))
    sizes = texts.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("all")).first()
    toxic, clean = sizes.toxic or 0, sizes["all"] - (sizes.toxic or 0)
    if not toxic or not clean:
        return {}
    counted = (
        texts.select(terms.alias("term"), "label")
        .where(F.length("term") >= 3)
        .groupBy("term")
        .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
        .where(F.col("t") >= MIN_DOCUMENTS)
        .withColumn("odds", F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0)))
        .where((F.col("t") >= F.lit(MIN_SHARE * toxic)) & (F.col("t") >= F.lit(MIN_PRECISION) * (F.col("t") + F.col("c"))))
        .orderBy(F.desc(F.col("t") * F.col("odds")), "term")
        .limit(LEXICON_TERMS)
    )
    kept: dict[str, float] = {}
    for r in sorted(counted.collect(), key=lambda r: (-r.t * r.odds, r.term)):
        kept[r.term] = r.odds
    return kept


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS) -> ToxicityModel:
    """Learn lexicon and weights from at most ``max_rows`` labelled texts (the first by a hash of the id).

    Equal texts count once, so that a group of copies does not make its words a lexicon.
    """
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .select("doc_id", F.col("toxic").cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(max_rows)
    )
    chosen = materialize(chosen)
    texts = docs.where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id").select("text", "label")
    # Repeated ids may bring more texts than labels: the bound holds for texts as well.
    texts = texts.groupBy("text").agg(F.max("label").alias("label")).orderBy(F.xxhash64("text"), "text").limit(max_rows)
    texts = materialize(texts)
    lexicon = learn_lexicon(texts)
    described = texts.select("text", "label").mapInArrow(_describer(lexicon), "label int, features array<double>").collect()
    if not lexicon or len({r.label for r in described}) < 2:
        share = np.mean([r.label for r in described]) if described else 0.0
        return ToxicityModel(lexicon, [0.0] * len(FEATURES), float(np.log((share + 0.001) / (1.001 - share))))
    beta = logistic(np.array([r.features for r in described]), np.array([r.label for r in described], float), ridge=1.0)
    return ToxicityModel(lexicon, beta[:-1].tolist(), float(beta[-1]))


def _describer(lexicon: dict[str, float]):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(lexicon)
        for batch in batches:
            rows = [scanner.features(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["label", "features"])

    return describe


def _scanner(weights: dict[str, float]) -> Scanner:
    """The worker's scanner of a lexicon; it serves many tasks."""
    return kept("scanner", weights, lambda: Scanner(weights))


def score(docs: DataFrame, model: ToxicityModel, with_hits: bool = False) -> DataFrame:
    """``doc_id, score`` (and ``hits``) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    hit = "struct<start:int,end:int,word:string,weight:double,distance:int,quoted:boolean>"
    schema = "doc_id long, score double" + f", hits array<{hit}>" * with_hits
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("word", pa.string()), ("weight", pa.float64()), ("distance", pa.int32()), ("quoted", pa.bool_())])
    )

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(shared.value.weights)
        beta, intercept = np.array(shared.value.coefficients), shared.value.intercept
        for batch in batches:
            rows = np.array([scanner.features(t.as_py()) for t in batch.column(1)]).reshape(-1, len(FEATURES))
            scores = 1 / (1 + np.exp(-np.clip(rows @ beta + intercept, -30, 30)))
            arrays, names = [batch.column(0), pa.array(scores)], ["doc_id", "score"]
            if with_hits:
                found = [[dict(zip(("start", "end", "word", "weight", "distance", "quoted"), h)) for h in scanner.hits(t.as_py())] for t in batch.column(1)]
                arrays.append(pa.array(found, kind))
                names.append("hits")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", whole("text").alias("text")).mapInArrow(rate, schema)


def reject(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose text scores below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(shared.value.weights)
        beta, intercept = np.array(shared.value.coefficients), shared.value.intercept
        limit = math.log(threshold / (1 - threshold))
        for batch in batches:
            rows = np.array([scanner.features(t.as_py() or "") for t in batch.column(place)]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(rows @ beta + intercept < limit))

    return docs.mapInArrow(keep, docs.schema)


def held_out() -> Column:
    """Rows whose labels are kept from the fit: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labels that are not held out, score every document."""
    model = fit(docs, labels.where(~held_out()))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
