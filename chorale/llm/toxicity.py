"""Toxicity by a lexicon whose terms are found misspelt too, and by what stands around them.

The lexicon is learned: whole words and stems (the first 4 to 8 letters) that stand in more
toxic than clean documents than chance explains, each with the logarithm of the odds as its
weight. Its entries form a trie. Levenshtein automata for them all run over the trie at once:
a state is a set of (node, edits), and states are made deterministic when a word first leads
to them. All different words of a slice walk the table of states together, a letter a step.
A whole word of five letters may differ by one edit, of nine by two; stems must stand as they
are. Misspellings that clean documents of the sample hold as often as toxic ones are words of
their own and don't count.

A hit counts by its weight, by half of it for each edit, and by its context: a window of
words on either side tells whether it stands in quotation marks, is reported (said, wrote,
called ...) or is aimed at somebody (you, du, tu ...). What counts is summed up for each
document and goes, with its density, the number of entries hit and the strongest hit, into a
logistic regression.

``fit`` learns from at most about ``FIT_DOCS`` labelled documents, those with the least hashes
of their ids, which bounds its work at any size of the tables; ``scored`` reads all texts whole.

Defined results for odd input: a null or empty text has no hits and gets the score of a text
without any; a null id has no label, and counts as held out by the query's rule. Of labels of
one id the largest counts, of documents with a labelled id the least text is learned from;
null labels are none. Without labels of both kinds the score is the share of toxic ones for all
documents. Rows with equal ids or texts are scored one by one. Columns other than the id are
left out; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.words import PLAIN, coded_words, slices
from chorale.session import scratch_path, ship_package

FIT_DOCS = 20_000
MAX_ENTRIES = 400
# G statistic from which a term is more than chance among some hundred thousand others.
LEAST_G = 30.0
STEMS = range(4, 9)
SHORTEST_WORD = 3
LARGEST_WEIGHT = 6.0
WINDOW = 8
SLICE_BYTES = 2 << 20
FEATURES = ["abuse", "density", "entries", "strongest", "length"]
# Signs that stand for letters in masked words are looked at as parts of them.
_MASKS = "*@$"
_FLAGS = PLAIN.copy()
_FLAGS[list(range(0x41, 0x5B))] = True
_FLAGS[list(_MASKS.encode())] = True
# Words around a hit that report it, or aim it at somebody.
_REPORTING = re.compile(
    r"\b(said|says|wrote|writes|called|calls|quoted?|quotes|word|insults?|slurs?|term|sagte?|schrieb|schreibt|nannte"
    r"|zitat|wort|beleidigung|dit|écrit|appelé|mot|insulte|cité|dijo|dice|escribió|llamó|palabra|insulto|citó)\b"
)
_AIMED = re.compile(r"\b(you|your|you're|u|ur|du|dich|dir|dein|ihr|euch|tu|toi|te|vous|tú|tus|usted|ustedes|eres)\b")
_QUOTES = "\"“”„«»‹›"
# A mark opens before a word and closes behind one; French ones keep a blank between.
_OPENED = re.compile(rf"(?:^|[\s(\[])[{_QUOTES}](?=\S)[^{_QUOTES}]*$|[«‹]\s[^{_QUOTES}]*$|[{_QUOTES}‘'`]$")
_CLOSED = re.compile(
    rf"^(?:[^{_QUOTES}]*\S)?[{_QUOTES}](?=$|[\s.,;:!?)\]])|^[^{_QUOTES}]*\s[»›](?=$|[\s.,;:!?)\]])|^[{_QUOTES}’'`]"
)
# What a hit counts by its context.
QUOTED, REPORTED, AIMED = 0.25, 0.5, 1.5

Entry = tuple[str, bool, float]
"""Term, whether it is a stem, weight."""


def edits_of(entry: Entry) -> int:
    """How many edits an entry may be away."""
    term, stem, _ = entry
    return 0 if stem or len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """Levenshtein automata of all entries, intersected with their trie."""

    def __init__(self, entries: Iterable[Entry]) -> None:
        self.entries = list(entries)
        # Nodes of the trie: letters to children, entries that end there, edits left below.
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.budget: list[int] = [0]
        for number, entry in enumerate(self.entries):
            term, is_stem, _ = entry
            node, edits = 0, edits_of(entry)
            self.budget[0] = max(self.budget[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.whole.append(-1)
                    self.stem.append(-1)
                    self.budget.append(0)
                node = self.children[node][letter]
                self.budget[node] = max(self.budget[node], edits)
            (self.stem if is_stem else self.whole)[node] = number
        letters = sorted({c for term, _, _ in self.entries for c in term})
        self.letters = np.array([ord(c) for c in letters], dtype=np.uint32)
        self.alphabet = ["", *letters]
        # State 0 is the dead one, state 1 the first.
        self.states: dict[frozenset[tuple[int, int]], int] = {frozenset(): 0}
        self.sets: list[frozenset[tuple[int, int]]] = [frozenset()]
        self.table = np.zeros((1, len(self.alphabet)), dtype=np.int32)
        self.ends: list[tuple[int, int]] = [(-1, 0)]
        self.stems: list[int] = [-1]
        self._state(self._closed({0: 0}))

    def _closed(self, held: dict[int, int]) -> frozenset[tuple[int, int]]:
        """With the nodes reached by leaving out letters of an entry; the least edits of each."""
        open_nodes = list(held)
        while open_nodes:
            node = open_nodes.pop()
            edits = held[node] + 1
            for child in self.children[node].values():
                if edits <= self.budget[child] and edits < held.get(child, 99):
                    held[child] = edits
                    open_nodes.append(child)
        return frozenset(held.items())

    def _state(self, held: frozenset[tuple[int, int]]) -> int:
        if held in self.states:
            return self.states[held]
        number = self.states[held] = len(self.sets)
        self.sets.append(held)
        row = np.full((1, len(self.alphabet)), -1, dtype=np.int32)
        self.table = np.concatenate([self.table, row])
        found = [
            (edits, -self.entries[e][2], e)
            for node, edits in held
            if (e := self.whole[node]) >= 0 and edits <= edits_of(self.entries[e])
        ]
        edits, _, entry = min(found, default=(0, 0.0, -1))
        self.ends.append((entry, edits))
        self.stems.append(max((self.stem[node] for node, edits in held if not edits), default=-1))
        return number

    def _step(self, state: int, letter: int) -> int:
        after: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.budget[node] and edits < after.get(node, 99):
                after[node] = edits

        sign = self.alphabet[letter]
        for node, edits in self.sets[state]:
            if (child := self.children[node].get(sign)) is not None and edits < after.get(child, 99):
                # Nothing is edited, so that no budget is asked but for edits made before.
                if edits == 0 or edits <= self.budget[child]:
                    after[child] = edits
            reach(node, edits + 1)
            for child in self.children[node].values():
                reach(child, edits + 1)
        return self._state(self._closed(after))

    def matches(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each word, or -1, and the edits between them.

        The entry with the least edits counts, then the heaviest; a stem counts as none.
        """
        n = len(words)
        text = "".join(words.to_pylist())
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        letters = np.searchsorted(self.letters, points)
        known = letters < len(self.letters)
        known[known] = self.letters[letters[known]] == points[known]
        letters = np.where(known, letters + 1, 0)
        lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        entry, edits = np.full(n, -1), np.zeros(n, dtype=np.int64)
        alive, state, place = np.arange(n), np.ones(n, dtype=np.int64), 0
        while len(alive):
            done = lengths[alive] == place
            if done.any():
                at, of = alive[done], state[done]
                ends = np.array([self.ends[x] for x in of.tolist()]).reshape(-1, 2)
                better = (ends[:, 0] >= 0) & ((entry[at] < 0) | (ends[:, 1] == 0))
                entry[at[better]], edits[at[better]] = ends[better, 0], ends[better, 1]
                alive, state = alive[~done], state[~done]
                if not len(alive):
                    break
            letter = letters[begins[alive] + place]
            state_after = self.table[state, letter]
            unknown = np.flatnonzero(state_after < 0)
            if len(unknown):
                width = len(self.alphabet)
                for key in np.unique(state[unknown] * width + letter[unknown]).tolist():
                    # The table grows on the way, so the step comes first.
                    target = self._step(key // width, key % width)
                    self.table[key // width, key % width] = target
                state_after = self.table[state, letter]
            state = state_after.astype(np.int64)
            live = state > 0
            alive, state = alive[live], state[live]
            stems = np.array(self.stems)[state]
            hit = stems >= 0
            entry[alive[hit]] = stems[hit]
            place += 1
        return entry, edits


@lru_cache(maxsize=4)
def _automaton(entries: tuple[Entry, ...]) -> LexiconAutomaton:
    return LexiconAutomaton(entries)


@dataclass(frozen=True)
class Lexicon:
    entries: tuple[Entry, ...]
    own_words: frozenset[str] = frozenset()
    """Words near an entry that are words of their own."""


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: tuple[float, ...]
    intercept: float


def context(left: str, right: str) -> tuple[str, float]:
    """What kind of context a hit between ``left`` and ``right`` has, and what it then counts."""
    around = f"{left} {right}".lower()
    quoted = _OPENED.search(left) is not None and _CLOSED.search(right) is not None
    reported = _REPORTING.search(around) is not None
    aimed = _AIMED.search(around) is not None
    kinds = [k for k, is_so in (("quoted", quoted), ("reported", reported), ("aimed", aimed)) if is_so]
    factor = (QUOTED if quoted else 1.0) * (REPORTED if reported else 1.0)
    return "+".join(kinds) or "plain", factor * (AIMED if aimed else 1.0)


@dataclass
class _Hits:
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word: list[str]
    entry: np.ndarray
    edits: np.ndarray
    kind: list[str]
    score: np.ndarray
    n_words: np.ndarray


def _hits(texts: pa.Array, lexicon: Lexicon) -> _Hits:
    """All hits in the texts; ``start`` and ``end`` are bytes of the hit's own text."""
    texts = texts.fill_null("")
    text, starts, ends, codes, words = coded_words(texts, _FLAGS)
    trimmed = pc.utf8_trim(words, _MASKS)
    entry, edits = _automaton(lexicon.entries).matches(trimmed)
    for k in np.flatnonzero(edits > 0).tolist():
        if trimmed[k].as_py() in lexicon.own_words:
            entry[k] = -1
    n_words = np.bincount(text, minlength=len(texts))
    hits = np.flatnonzero(entry[codes] >= 0)
    last = np.cumsum(n_words)
    low = np.maximum(hits - WINDOW, (last - n_words)[text[hits]])
    high = np.minimum(hits + WINDOW, last[text[hits]] - 1)
    offsets = np.cumsum([0, *pc.binary_length(texts).to_pylist()])
    data = b"".join(x.as_buffer().to_pybytes() for x in texts) if len(hits) else b""
    kinds, factors = [], np.ones(len(hits))
    edge = (offsets[text[hits]], offsets[text[hits] + 1])
    # The signs before the first word of the window and behind its last belong to it.
    begins = np.maximum(np.where(low > 0, ends[low - 1], 0), edge[0])
    stops = np.minimum(np.where(high + 1 < len(starts), starts[np.minimum(high + 1, len(starts) - 1)], len(data)), edge[1])
    for k, (a, b, c, d) in enumerate(zip(begins, starts[hits], ends[hits], stops, strict=True)):
        kind, factors[k] = context(data[a:b].decode(), data[c:d].decode())
        kinds.append(kind)
    weights = np.array([w for _, _, w in lexicon.entries] or [0.0])
    found, off = entry[codes[hits]], edits[codes[hits]]
    return _Hits(
        text[hits],
        starts[hits] - edge[0],
        ends[hits] - edge[0],
        words.take(pa.array(codes[hits])).to_pylist(),
        found,
        off,
        kinds,
        weights[found] * 0.5**off * factors,
        n_words,
    )


def _features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    n = len(texts)
    hits = _hits(texts, lexicon)
    abuse = np.bincount(hits.text, weights=hits.score, minlength=n)
    strongest = np.zeros(n)
    np.maximum.at(strongest, hits.text, hits.score)
    size = max(1, len(lexicon.entries))
    entries = np.bincount(np.unique(hits.text * size + hits.entry) // size, minlength=n)
    n_words = np.maximum(hits.n_words, 1)
    return np.column_stack(
        [np.log1p(abuse), np.log1p(100 * abuse / n_words), np.log1p(entries), np.log1p(strongest), np.log1p(n_words)]
    )


def _candidate_counts(part: pa.RecordBatch) -> pa.RecordBatch:
    """(term, stem, toxic, clean): how many texts of the slice have a word or a stem."""
    text, _, _, codes, words = coded_words(part.column("text"), _FLAGS)
    words = pc.utf8_trim(words, _MASKS)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
    held = np.unique(text * max(1, len(words)) + codes)
    owner, code = held // max(1, len(words)), held % max(1, len(words))
    tables = []
    for stem in (0, *STEMS):
        use = lengths[code] >= (stem or SHORTEST_WORD)
        cut = (pc.utf8_slice_codeunits(words, 0, stem) if stem else words).dictionary_encode()
        term = cut.indices.to_numpy().astype(np.int64)[code[use]]
        size = max(1, len(cut.dictionary))
        pairs = np.unique(owner[use] * size + term)
        counts = [np.bincount(pairs[x] % size, minlength=size) for x in (toxic[pairs // size], ~toxic[pairs // size])]
        there = np.flatnonzero(counts[0] + counts[1])
        tables.append(
            pa.record_batch(
                [
                    cut.dictionary.take(pa.array(there)).cast(pa.string()),
                    pa.array(np.full(len(there), stem > 0)),
                    *(pa.array(c[there].astype(np.int64)) for c in counts),
                ],
                names=["term", "stem", "toxic", "clean"],
            )
        )
    return pa.Table.from_batches(tables).combine_chunks().to_batches()[0] if tables[0].num_rows else tables[0]


def labelled(docs: DataFrame, labels: DataFrame, at_most: int = FIT_DOCS) -> DataFrame:
    """(doc_id, text, toxic) of about ``at_most`` labelled documents, those with the least hashes of ids."""
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    share = min(1.0, at_most / n) if n else 1.0
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < F.lit(int(share * (1 << 32)))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known.where(hashed), "doc_id")
    return texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _odds(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    return math.log(((toxic + 0.5) / (n_toxic + 1)) / ((clean + 0.5) / (n_clean + 1)))


def chosen(counts: list[tuple[str, bool, int, int]], n_toxic: int, n_clean: int) -> tuple[Entry, ...]:
    """The entries of the lexicon: the strongest first, none that another one already holds."""
    entries: dict[str, Entry] = {}
    stems: set[str] = set()
    prefixes: set[str] = set()

    def strength(row: tuple[str, bool, int, int]) -> float:
        _, _, toxic, clean = row
        share = (toxic + clean) / (n_toxic + n_clean)
        parts = ((toxic, share * n_toxic), (clean, share * n_clean))
        return 2 * sum(x * math.log(x / y) for x, y in parts if x)

    ranked = sorted(counts, key=lambda r: (-strength(r), r[1], -len(r[0]), r[0]))
    for term, stem, toxic, clean in ranked:
        weight = _odds(toxic, clean, n_toxic, n_clean)
        if strength((term, stem, toxic, clean)) < LEAST_G or weight <= 0 or len(entries) == MAX_ENTRIES:
            continue
        begins = {term[:k] for k in range(1, len(term) + 1)}
        if begins & stems or term in entries or (stem and term in prefixes):
            continue
        entries[term] = (term, stem, min(weight, LARGEST_WEIGHT))
        prefixes |= begins
        if stem:
            stems.add(term)
    return tuple(sorted(entries.values()))


def _lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> Lexicon:
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                yield _candidate_counts(part)

    found = sample.select("text", "toxic").mapInArrow(
        candidates, "term string, stem boolean, toxic long, clean long"
    )
    sums = found.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # What isn't in relatively more toxic than clean documents is no candidate, nor what is in few.
    likelier = F.col("toxic") * n_clean > F.col("clean") * n_toxic
    ranked = sums.where(likelier & (F.col("toxic") >= 4)).orderBy(
        (F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5) * n_clean / n_toxic) * F.col("toxic")).desc(),
        "term",
        "stem",
    )
    rows = ranked.limit(20 * MAX_ENTRIES).collect()
    entries = chosen([tuple(r) for r in rows], n_toxic, n_clean)
    lexicon = Lexicon(entries)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                hits = _hits(part.column("text"), lexicon)
                toxic = part.column("toxic").to_numpy(zero_copy_only=False)[hits.text]
                off = sorted({(w.strip(_MASKS), int(t), int(x)) for w, t, x, e in zip(hits.word, toxic, hits.text, hits.edits, strict=True) if e})
                yield pa.record_batch(
                    [pa.array([w for w, _, _ in off], pa.string()), pa.array([t for _, t, _ in off], pa.int64())],
                    names=["word", "toxic"],
                )

    seen = sample.select("text", "toxic").mapInArrow(near, "word string, toxic long")
    of_word = seen.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    own = of_word.where(F.col("toxic") * n_clean <= 2 * F.col("clean") * n_toxic).select("word")
    return Lexicon(entries, frozenset(row.word for row in own.collect()))


def fit(docs: DataFrame, labels: DataFrame, at_most: int = FIT_DOCS) -> Model:
    """Learns lexicon and weights from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    spark = docs.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "toxicity-sample")
    labelled(docs, labels, at_most).write.parquet(path)
    sample = spark.read.parquet(path)
    n, n_toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0))).first()
    if not 0 < n_toxic < n:
        share = (n_toxic + 0.5) / (n + 2)
        return Model(Lexicon(()), (0.0,) * len(FEATURES), math.log(share / (1 - share)))
    lexicon = _lexicon(sample, n_toxic, n - n_toxic)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                columns = [pa.array(x) for x in _features(part.column("text"), lexicon).T]
                label = part.column("toxic").cast(pa.float64())
                yield pa.record_batch([label, *columns], names=["label", *FEATURES])

    rows = sample.select("text", "toxic").mapInArrow(
        measure, "label double, " + ", ".join(f"{f} double" for f in FEATURES)
    )
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("label", "features")
    rows = rows.cache()
    fitted = LogisticRegression(regParam=1e-3, maxIter=50).fit(rows)
    rows.unpersist()
    return Model(lexicon, tuple(float(x) for x in fitted.coefficients), float(fitted.intercept))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    ship_package(docs.sparkSession)
    weights = np.array(model.weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sums = _features(part.column("text"), model.lexicon) @ weights + model.intercept
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(1 / (1 + np.exp(-sums)))], names=["doc_id", "score"]
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {id_type}, score double")


def hits(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, start, end, word, entry, edits, context, score) of every hit, by bytes of its text."""
    ship_package(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = _hits(part.column("text"), model.lexicon)
                terms = [model.lexicon.entries[e][0] for e in found.entry]
                columns = [found.start, found.end, found.word, terms, found.edits, found.kind, found.score]
                yield pa.record_batch(
                    [
                        part.column("doc_id").take(pa.array(found.text)),
                        *(pa.array(x, t) for x, t in zip(columns, _HIT_TYPES, strict=True)),
                    ],
                    names=["doc_id", "start", "end", "word", "entry", "edits", "context", "score"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        find,
        f"doc_id {id_type}, start long, end long, word string, entry string, edits long, context string, score double",
    )


_HIT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.float64()]


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), learned from labels of documents not held out."""

    def held_out(table: DataFrame) -> DataFrame:
        number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
        return table.withColumn("held_out", number % 5 == 0)

    model = fit(docs, held_out(labels.select("doc_id", "toxic")).where("NOT held_out"))
    rows = held_out(scored(docs, model))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
