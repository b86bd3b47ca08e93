"""Toxic terms, misspelled or not, and the context they stand in.

A lexicon of words and stems is learned from labelled texts. Its trie is intersected with the Levenshtein
automaton of one edit (insertion, deletion, substitution, swap of neighbours); the product automaton is determinised while
words are read, so a word costs one table lookup per letter until no term can match. Terms of fewer than five letters
match exactly only. A stem matches any word that continues it.

Each hit is judged by its context window: quotation marks around it, or a reporting word before it, make
it a quoted hit. Counts of all, misspelled and quoted hits, their density and the log-odds of the best term (less for an edit) are the
inputs of a logistic model, fitted on texts that its lexicon has not seen. Words one edit away from a term that occur in clean training texts (neighbours by chance) are excluded.

Edge cases: a null or empty text has no hits and gets the intercept's score; without labelled rows, or with
one class alone, the lexicon is empty and every score is the share of toxic labels (0 without labels); repeated rows are scored once each; a null
doc_id is kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8, written
from .learn import SAMPLE, held_out, sample_labels, training_texts

STEMS = range(4, 8)
LOG_ODDS = 5.0
WINDOW = 6
FUZZY_LENGTH = 5
QUOTES = "\"“”„«»‘’‹›"
# What an edit takes from a term's log-odds.
EDIT_COST = 2.0
REPORTING = ("said", "says", "wrote", "quote", "quoted", "quotes", "called", "calling", "term", "word", "phrase", "slur", "insult")
FEATURES = ("hits", "misspelled", "quoted", "density", "distinct", "strength")
_PIECES = re.compile(r"[^\W_]+")


@dataclass
class Lexicon:
    """Terms (exact words), stems, the log-odds of both in one list, and words that neighbour a term by chance."""

    terms: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    odds: list[float] = field(default_factory=list)
    excluded: frozenset[str] = frozenset()


class Matcher:
    """Lexicon trie x Levenshtein automaton, determinised lazily.

    A position is (trie node, edits so far, letter owed by a swap). A deterministic state is a set of positions.
    `match` returns None or (term number, edits).
    """

    def __init__(self, lexicon: Lexicon, edits: int = 1, most: int = 200_000):
        self.edits, self.most = edits, most
        self.children: list[dict[str, int]] = [{}]
        self.word: list[int | None] = [None]
        self.stem: list[int | None] = [None]
        self.names = [*lexicon.terms, *lexicon.stems]
        for number, name in enumerate(self.names):
            node = 0
            for letter in name:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.word.append(None)
                    self.stem.append(None)
                node = self.children[node][letter]
            (self.stem if number >= len(lexicon.terms) else self.word)[node] = number
        self.reset()

    def reset(self) -> None:
        self.steps: dict[tuple[int, str], int] = {}
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.settled: list[bool] = []
        self.begun: list[tuple[int, int] | None] = []
        self.state(self.closed({(0, 0, "")}))  # 0: the start
        self.dead = self.state(frozenset())

    def closed(self, positions: set) -> frozenset:
        """With the letters of the trie that may be left out."""
        todo = list(positions)
        while todo:
            node, edits, owed = todo.pop()
            if not owed and edits < self.edits:
                for child in self.children[node].values():
                    new = (child, edits + 1, "")
                    if new not in positions:
                        positions.add(new)
                        todo.append(new)
        return frozenset(positions)

    def state(self, positions: frozenset) -> int:
        number = self.numbers.get(positions)
        if number is None:
            number = self.numbers[positions] = len(self.sets)
            self.sets.append(positions)
            whole, begun = [], []
            for node, edits, owed in positions:
                if owed:
                    continue
                for found, into in ((self.word[node], whole), (self.stem[node], begun)):
                    if found is not None and (not edits or len(self.names[found]) >= FUZZY_LENGTH):
                        into.append((edits, found))
            # A stem reached without an edit decides the word, whatever follows.
            sure = min(begun, default=None)
            self.settled.append(sure is not None and sure[0] == 0)
            best = min(whole + begun, default=None)
            self.accepts.append((best[1], best[0]) if best else None)
            self.begun.append(sure)
        return number

    def step(self, state: int, letter: str) -> int:
        after = set()
        for node, edits, owed in self.sets[state]:
            if owed:
                if letter == owed:
                    after.add((node, edits, ""))
                continue
            children = self.children[node]
            if letter in children:
                after.add((children[letter], edits, ""))
            if edits < self.edits:
                after.add((node, edits + 1, ""))
                for own, child in children.items():
                    if own != letter:
                        after.add((child, edits + 1, ""))
                        second = self.children[child].get(letter)
                        if second is not None:
                            after.add((second, edits + 1, own))
        return self.state(self.closed(after))

    def match(self, word: str) -> tuple[int, int] | None:
        if len(self.steps) > self.most:
            self.reset()
        state, stem = 0, None
        for letter in word:
            after = self.steps.get((state, letter))
            if after is None:
                after = self.steps[state, letter] = self.step(state, letter)
            state = after
            if self.settled[state]:
                return self.accepts[state]
            if self.begun[state] is not None and (stem is None or self.begun[state] < stem):
                stem = self.begun[state]
            if state == self.dead:
                break
        best = self.accepts[state] if state != self.dead else None
        if stem is not None and (best is None or stem[0] < best[1]):
            best = (stem[1], stem[0])
        return best


class Hits(dict):
    """Per chunk between spaces: 0, or 1 + 2 * term number + (1 if misspelled)."""

    def __init__(self, lexicon: Lexicon, most: int = 200_000):
        super().__init__()
        self.matcher, self.excluded, self.most = Matcher(lexicon), lexicon.excluded, most
        self.odds = lexicon.odds or [LOG_ODDS] * len(self.matcher.names)

    def of(self, word: str) -> int:
        found = self.matcher.match(word)
        if found is None or (found[1] and word in self.excluded):
            return 0
        return 1 + 2 * found[0] + (found[1] > 0)

    def __missing__(self, chunk: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        word = chunk.decode("utf-8", "replace").lower()
        pieces = _PIECES.findall(word)
        value = 0
        if pieces:
            whole = word[word.index(pieces[0]) : word.rindex(pieces[-1]) + len(pieces[-1])]
            value = next((v for p in dict.fromkeys([whole, *pieces]) if (v := self.of(p))), 0)
        self[chunk] = value
        return value


def quoted(chunks: list[bytes], at: int) -> bool:
    """Whether a hit is quoted: marks on both sides within the window, or a reporting word before it."""
    before = [c.decode("utf-8", "replace") for c in chunks[max(0, at - WINDOW) : at]]
    own = chunks[at].decode("utf-8", "replace")
    after = [c.decode("utf-8", "replace") for c in chunks[at + 1 : at + 1 + WINDOW]]
    opened = any(c[:1] in QUOTES for c in [*before, own] if c)
    shut = any(c.rstrip(".,;:!?")[-1:] in QUOTES for c in [own, *after] if c.rstrip(".,;:!?"))
    return (opened and shut) or any(c.strip(".,;:!?" + QUOTES).lower() in REPORTING for c in before)


def features(chunks: list[bytes], hits: Hits) -> tuple[float, ...]:
    found = [(i, v) for i, v in enumerate(map(hits.__getitem__, chunks)) if v]
    if not found:
        return (0.0,) * len(FEATURES)
    plain = misspelled = cited = 0
    terms, strength = set(), 0.0
    for at, value in found:
        if quoted(chunks, at):
            cited += 1
            continue
        term, edited = (value - 1) >> 1, (value - 1) & 1
        terms.add(term)
        strength = max(strength, hits.odds[term] - EDIT_COST * edited)
        misspelled += edited
        plain += 1 - edited
    counts = [float(np.log1p(n)) for n in (plain + misspelled, misspelled, cited)]
    return (*counts, min(1.0, 20 * (plain + misspelled) / len(chunks)), float(np.log1p(len(terms))), strength)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text, label in zip(utf8(batch, "text"), batch.column(1).to_pylist(), strict=True):
            words = {w for w in _PIECES.findall(text.decode("utf-8", "replace").lower()) if len(w) >= 3}
            counts.update((w, 0, label) for w in words)
            stems = {w[:n] for w in words for n in STEMS if len(w) > n}
            counts.update((s, len(s), label) for s in stems)
    names, kinds, labels = zip(*counts, strict=True) if counts else ((), (), ())
    numbers = list(counts.values())
    for at in range(0, len(names), 50_000):
        cut = slice(at, at + 50_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[cut], pa.string()), pa.array(kinds[cut], pa.int32()), pa.array(labels[cut], pa.int32()), pa.array(numbers[cut], pa.int64())],
            names=["term", "kind", "label", "n"],
        )


def learn_lexicon(train: DataFrame, log_odds: float = LOG_ODDS) -> Lexicon:
    """All words and stems far more frequent in toxic texts (counted by document).

    The labelled sample bounds them: each has a least support in its texts. The lexicon is sent to every task.
    """
    sizes = {r[0]: r[1] for r in train.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon()
    counts = train.select("text", "label").mapInArrow(_term_counts, "term string, kind int, label int, n long")
    counts = counts.groupBy("term", "kind").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    least = max(5, toxic // 200)
    kept = counts.withColumn("odds", odds).filter((F.col("t") >= least) & ((odds >= log_odds) | ((F.col("c") == 0) & (odds >= log_odds - 1.5))))
    rows = kept.orderBy(F.desc("t"), "term", "kind").collect()
    words = {r.term: r.t for r in rows if r.kind == 0}
    # A stem stands for at least three words, and says more than its commonest one.
    members: dict[str, list[int]] = {}
    for word, t in words.items():
        for n in STEMS:
            if len(word) > n:
                members.setdefault(word[:n], []).append(t)
    good = {r.term for r in rows if r.kind and len(members.get(r.term, ())) >= 3 and r.t >= 1.5 * max(members[r.term])}
    stems = sorted(s for s in good if not any(s[:n] in good for n in STEMS if n < len(s)))
    terms = [w for w in words if not any(w[:n] in stems for n in STEMS)]
    names = [*((w, 0) for w in terms), *((w, len(w)) for w in stems)]
    odds_of = {(r.term, r.kind): r.odds for r in rows}
    return Lexicon(terms, stems, [float(odds_of[n]) for n in names])


def _neighbours(lexicon: Lexicon):
    """Words of clean texts that match a term with an edit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, found, seen = Matcher(lexicon), set(), set()
        for batch in batches:
            for text in utf8(batch, "text"):
                for word in set(_PIECES.findall(text.decode("utf-8", "replace").lower())) - seen:
                    if (hit := matcher.match(word)) and hit[1]:
                        found.add(word)
                    if len(seen) < 500_000:
                        seen.add(word)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["word"])

    return run


def whole_lexicon(train: DataFrame) -> Lexicon:
    """The lexicon, with its chance neighbours among the clean texts."""
    lexicon = learn_lexicon(train)
    chance = train.filter("label = 0").mapInArrow(_neighbours(lexicon), "word string").distinct()
    lexicon.excluded = frozenset(r[0] for r in chance.collect())
    return lexicon


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # intercept first

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


def feature_frame(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """label and features of (text, label) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(lexicon)
        for batch in batches:
            x = [features(t.split(), hits) for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array([r[k] for r in x], pa.float64()) for k in range(len(FEATURES)))], names=["label", *FEATURES])

    return rows.select("text", "label").mapInArrow(run, "label int, " + ", ".join(f"{n} double" for n in FEATURES))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first weight is the intercept, which is not shrunk."""
    a = np.c_[np.ones(len(x)), x]
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        change = np.linalg.solve(hessian, a.T @ (y - p) - penalty * w)
        w += change
        if np.abs(change).max() < 1e-8:
            break
    return w


def train_model(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits lexicon and weights on at most `bound` labelled rows of the training fold."""
    train = written(training_texts(docs, sample_labels(labels, label, bound, id_col), id_col, text_col))
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    # The weights are fitted on texts that the lexicon was not learned from: its own texts would flatter it.
    parts = [feature_frame(train.filter(half != k), whole_lexicon(train.filter(half == k))) for k in (0, 1)]
    lexicon = whole_lexicon(train)
    # At most `bound` rows of a few numbers.
    rows = np.array([tuple(r) for part in parts for r in part.collect()], dtype=float).reshape(-1, 1 + len(FEATURES))
    share = rows[:, 0].mean() if len(rows) else 0.0
    if share in (0.0, 1.0):
        return Model(lexicon, np.r_[30.0 if share else -30.0, np.zeros(len(FEATURES))])
    return Model(lexicon, fit_logistic(rows[:, 1:], rows[:, 0]))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and the counts' features of every document, whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(model.lexicon)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array([features((t or b"").split(), hits) for t in utf8(batch, "text")])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(x)), *(pa.array(x[:, k]) for k in range(len(FEATURES)))], names=["doc_id", "score", *FEATURES]
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, score double, " + ", ".join(f"{n} double" for n in FEATURES))


def clean_rows(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that score below the threshold; rows are filtered where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(model.lexicon)
        for batch in batches:
            if batch.num_rows:
                x = np.array([features((t or b"").split(), hits) for t in utf8(batch, text_col)])
                yield batch.filter(pa.array(model.score(x) < threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted and features."""
    scored = score_documents(docs, train_model(docs, labels))
    return scored.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= threshold).cast("int")})
