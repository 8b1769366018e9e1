"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType

from quaestor.llm.tables import free_name, held_back, read_table
from quaestor.llm.training import fit_logistic, labelled_texts, sigmoid
from quaestor.llm.words import find_words, folded, hash_spans, hash_text, letters, pieces

LABELLED_CAP = 6000  # labelled rows of each class that are learned from
STEM_LENGTHS = range(4, 9)
STEM_DOCS = 5
STEM_ODDS = 2.5
STEMS = 2000
HOLD_PARTS = 5
REACH = 5  # words within which a negation, a report or a target governs

INSULT, THREAT, TARGET, NEGATION, REPORT = range(1, 6)
GAP, END = 6, 7
KINDS = ("plain", "targeted", "negated", "reported")

# Words that open the grammar before anything is learned, by language.
SEEDS = {
    INSULT: "idiot moron stupid scum trash loser pathetic worthless disgusting imbecile vermin dumb dummkopf trottel abschaum "
            "widerlich wertlos imbécile crétin ordure abruti idiota imbécil estúpido basura asqueroso inútil",
    THREAT: "kill murder hurt stab strangle shoot töten umbringen erschießen tuer étrangler poignarder matar apuñalar estrangular",
    TARGET: "you your yours they them he she people du dich dir ihr euch sie tu toi te vous ils elles tú ti usted ustedes ellos",
    NEGATION: "not never no nobody without nicht kein keine niemals pas jamais aucun nunca jamás ningún",
    REPORT: "said says called calls wrote quoted accused reported sagte nannte schrieb disait écrit appelé dijo llamó escribió",
}


@dataclass(frozen=True)
class Transducer:
    """Moves by (state, symbol) to (state, flag); symbols without a move keep the state, ``END`` returns to 0."""
    moves: dict[tuple[int, int], int]
    states: int

    def step(self, state: int, symbol: int) -> int:
        return 0 if symbol == END else self.moves.get((state, symbol), state)


def _scope(opener: int) -> Transducer:
    """State 1 from the opener until a long gap."""
    return Transducer({(0, opener): 1, (1, GAP): 0}, 2)


@dataclass(frozen=True)
class Grammar:
    """Product of the target, negation and report transducers; an insult or threat is put out with the state it meets."""
    states: tuple[tuple[int, int, int], ...]
    table: np.ndarray
    kinds: tuple[int, ...]

    @classmethod
    def compose(cls) -> Grammar:
        parts = [_scope(TARGET), _scope(NEGATION), _scope(REPORT)]
        states = [(a, b, c) for a in range(2) for b in range(2) for c in range(2)]
        table = np.zeros((len(states), END + 1), np.int8)
        for k, state in enumerate(states):
            for symbol in range(END + 1):
                table[k, symbol] = states.index(tuple(p.step(s, symbol) for p, s in zip(parts, state, strict=True)))
        kinds = tuple(3 if c else 2 if b else 1 if a else 0 for a, b, c in states)
        return cls(tuple(states), table, kinds)

    def clause(self, symbols: list[int], places: list[int], weights: list[float]) -> np.ndarray:
        """Weight of a clause by kind. A target behind an insult, within reach, makes it targeted as well."""
        out = np.zeros(len(KINDS))
        state, before = 0, None
        for k, symbol in enumerate(symbols):
            if before is not None and places[k] - before > REACH:
                state = self.table[state, GAP]
            before = places[k]
            state = self.table[state, symbol]
            if symbol in (INSULT, THREAT):
                kind = self.kinds[state]
                follows = any(s == TARGET and p - places[k] <= REACH for s, p in zip(symbols[k + 1:k + 4], places[k + 1:k + 4]))
                out[1 if kind == 0 and follows else kind] += weights[k]
        return out


@dataclass
class Lexicon:
    """Hashes of words and stems in order, with symbol and weight; stem entries stand for all words that begin so."""
    keys: np.ndarray
    symbols: np.ndarray
    weights: np.ndarray
    lengths: tuple[int, ...]
    stems: np.ndarray
    model: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def build(cls, stems: dict[str, float]) -> Lexicon:
        """``stems``: learned stems and their weight. Seeds are whole words with weight 1."""
        entries = {}
        for symbol, words in SEEDS.items():
            for word in words.split():
                entries[hash_text(word)] = (symbol, 1.0, False)
        for stem, weight in stems.items():
            entries[hash_text(stem)] = (INSULT, weight, True)
        keys = np.array(sorted(entries), np.uint64)
        rows = [entries[int(k)] for k in keys]
        return cls(keys, np.array([r[0] for r in rows]), np.array([r[1] for r in rows]),
                   tuple(sorted({len(s.encode()) for s in stems})), np.array([r[2] for r in rows]))

    def lookup(self, hashes: np.ndarray, stems_only: bool) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are known, and their entries."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        known = self.keys[at] == hashes
        if stems_only:
            known &= self.stems[at]
        found = np.flatnonzero(known)
        return found, at[found]


N_FEATURES = len(KINDS) + 3
PRIOR = np.array([1.0, 1.2, 0.5, 0.5, 0.3, 0.5, 0.2, -3.0])
_ENDS = np.zeros(256, np.int64)
_ENDS[[ord(c) for c in ".!?;\n"]] = 1
GRAMMAR = Grammar.compose()


def features(batch: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """Per text: matched clause weight of each kind, the strongest clause, matched clauses, and weight by length, all as log1p."""
    out = np.zeros((len(batch), N_FEATURES))
    for piece in pieces(batch):
        data = folded(piece.data)
        words = find_words(piece, letters(piece.data))
        if not len(words.start):
            continue
        symbol = np.zeros(len(words.start), np.int8)
        weight = np.zeros(len(words.start))
        found, at = lexicon.lookup(hash_spans(data, words.start, words.end), False)
        symbol[found], weight[found] = lexicon.symbols[at], lexicon.weights[at]
        for row in hash_spans(data, words.start, words.end, lexicon.lengths) if lexicon.lengths else ():
            found, at = lexicon.lookup(row, True)
            better = lexicon.weights[at] > weight[found]
            symbol[found[better]], weight[found[better]] = INSULT, lexicon.weights[at][better]
        clause = np.cumsum(_ENDS[piece.data])[words.start]
        clause = clause + words.doc * (clause[-1] + 1)  # texts don't share clauses
        hits = np.flatnonzero((symbol == INSULT) | (symbol == THREAT))
        if not len(hits):
            continue
        wanted = np.unique(clause[hits])
        some = np.flatnonzero(symbol)
        some = some[wanted[np.minimum(np.searchsorted(wanted, clause[some]), len(wanted) - 1)] == clause[some]]
        totals = np.zeros((piece.count, N_FEATURES))
        cuts = np.flatnonzero(np.diff(clause[some])) + 1
        for part in np.split(some, cuts):
            score = GRAMMAR.clause(symbol[part].tolist(), part.tolist(), weight[part].tolist())
            doc = words.doc[part[0]]
            totals[doc, :len(KINDS)] += score
            totals[doc, len(KINDS)] = max(totals[doc, len(KINDS)], score.sum())
            totals[doc, len(KINDS) + 1] += 1
        lengths = np.maximum(np.bincount(words.doc, minlength=piece.count), 1)
        totals[:, -1] = 100 * totals[:, :len(KINDS)].sum(axis=1) / lengths
        out[piece.first:piece.first + piece.count] = totals
    return np.log1p(out)


def learn_stems(sample: DataFrame) -> dict[str, float]:
    """Stems (word beginnings of 4 to 8 letters, and whole words) over-represented in toxic texts, with their log-odds.

    At most ``STEMS`` of them, those with the highest log-odds times number of texts.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(\p{L}{3,})"), F.lit(1)))
    stems = F.array_distinct(F.flatten(F.transform(words, lambda w: F.filter(F.array(
        *[F.when(F.length(w) >= k, F.substring(w, 1, k)) for k in STEM_LENGTHS],
        F.when(F.length(w) > max(STEM_LENGTHS), w)), lambda s: s.isNotNull()))))
    totals = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(totals) < 2:
        return {}
    counts = (sample.select("label", F.explode(stems).alias("stem")).groupBy("stem")
              .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).where(F.col("toxic") >= STEM_DOCS))
    odds = F.log((F.col("toxic") + 0.5) / (totals[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (totals[0] + 1.0))
    best = (counts.withColumn("odds", odds).where(F.col("odds") >= STEM_ODDS)
            .orderBy(F.desc(F.col("odds") * F.col("toxic")), "stem").limit(STEMS).collect())
    return {r["stem"]: r["odds"] for r in best}


def _feature_udf(lexicon: Lexicon):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(list(features(batch, lexicon)), pa.list_(pa.float64()))
    return arrow_udf(run, ArrayType(DoubleType()))


def train(docs: DataFrame, labels: DataFrame, cap: int = LABELLED_CAP, learn=None) -> Lexicon:
    """Lexicon and clause weights from labelled rows; at most about ``cap`` of each class are used.

    Without labels of both classes the seeds and prior weights remain.
    """
    sample = labelled_texts(docs, labels, "toxic", cap, learn)
    lexicon = Lexicon.build(learn_stems(sample))
    rows = sample.select("label", _feature_udf(lexicon)("text").alias("x")).toPandas()
    lexicon.model = PRIOR if rows["label"].nunique() < 2 else fit_logistic(
        np.array(rows["x"].tolist()), rows["label"].to_numpy(float), PRIOR, 1.0)
    return lexicon


def score(text, lexicon: Lexicon):
    """Column of probabilities that a text is toxic; a null text scores as an empty one."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(sigmoid(features(batch, lexicon) @ lexicon.model[:-1] + lexicon.model[-1]))
    return arrow_udf(run, DoubleType())(text)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; columns, order and repeated rows stay."""
    name = free_name(docs, "toxicity")
    scored = docs.withColumn(name, score(F.col("text"), train(docs, labels)))
    return scored.where(F.col(name) < 0.5).drop(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    lexicon = train(docs, labels, learn=held_back(F.col("doc_id"), HOLD_PARTS) != 0)
    scored = docs.select("doc_id", F.coalesce(held_back(F.col("doc_id"), HOLD_PARTS) == 0, F.lit(False)).alias("held_out"),
                         score(F.col("text"), lexicon).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLE: dict[str, str] = {}
