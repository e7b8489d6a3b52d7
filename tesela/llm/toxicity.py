"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer turns words into classes: insult, threat, target, negation, reported
speech.  Small transducers for these patterns read the classes of a clause, each with a weight
for what it sees; their composition is one machine that reads a clause once.  A text is judged
by its matched clauses: an insult at a target weighs more, a negated or reported one less.

The lexicon has fixed words and words and word beginnings learned from labelled texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import giving_back, materialise, text_of, whole_number

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)

#: Fixed words of the grammar, in four languages.
WORDS = {
    INSULT: "idiot moron stupid loser scum trash clown pathetic worthless disgusting dumb imbecile filth vermin "
    "dummkopf abschaum trottel versager idiota estúpido basura escoria imbécil ordure crétin abruti",
    THREAT: "kill hurt destroy beat strangle stab shoot burn töten umbringen matar destruir tuer détruire",
    TARGET: "you your yours he she they them him her du dich dir ihr euch sie tú usted ustedes te vosotros tu toi vous",
    NEGATION: "not never no neither nor nicht kein keine nie nunca jamás ni pas jamais aucun",
    REPORT: "said says say called calls wrote quoted claimed sagte nannte schrieb dijo llamó escribió disait appelé écrit",
}
#: Words that a threat may also be about, not at: their weight stays small without a target.
THREAT_ALONE, THREAT_AT_TARGET = 0.2, 3.0
SEED_WEIGHT = 3.0

WORD_OR_END = re.compile(r"[^\W\d_]+|[.!?;:\n]")

#: Learning: at most so many labelled texts are read, the first ones by a hash of their ids.
SAMPLE = 20_000
BEGINNINGS = range(3, 8)
MOST_UNITS = 2_000
#: A unit is learned if it explains so many toxic texts that better ones do not.
NEW_TEXTS = 3
#: The weight from which on a text needs no further units.
EXPLAINED = 3.5
REMEMBERED = 1_000_000


class Transducer:
    """A deterministic machine over word classes: arcs[state, class] = (next state, factor);
    classes without an arc lead on by `otherwise`."""

    def __init__(self, arcs: dict[tuple[int, int], tuple[int, float]], otherwise: dict[int, int]):
        self.arcs, self.otherwise = arcs, otherwise

    def step(self, state: int, kind: int) -> tuple[int, float]:
        found = self.arcs.get((state, kind))
        return found if found is not None else (self.otherwise.get(state, state), 1.0)


def insult_machine() -> Transducer:
    """Insults that follow each other strengthen each other."""
    return Transducer({(0, INSULT): (1, 1.0), (1, INSULT): (1, 1.25)}, {0: 0, 1: 1})


def target_machine() -> Transducer:
    """State 1: a target came before in the clause."""
    return Transducer({(0, TARGET): (1, 1.0), (1, INSULT): (1, 1.5)}, {0: 0, 1: 1})


def negation_machine(reach: int = 3) -> Transducer:
    """A negation weakens what comes in the next few words."""
    arcs = {(s, NEGATION): (reach, 1.0) for s in range(reach + 1)}
    for s in range(1, reach + 1):
        arcs[s, INSULT] = arcs[s, THREAT] = (s - 1, 0.3)
    return Transducer(arcs, {0: 0} | {s: s - 1 for s in range(1, reach + 1)})


def report_machine() -> Transducer:
    """What is reported is weakened to the end of the clause."""
    return Transducer({(0, REPORT): (1, 1.0), (1, INSULT): (1, 0.5), (1, THREAT): (1, 0.4)}, {0: 0, 1: 1})


def threat_machine(reach: int = 4) -> Transducer:
    """State s > 0: a threat came at most `reach` words ago; a target then completes it."""
    arcs = {(s, THREAT): (reach, 1.0) for s in range(reach + 1)}
    for s in range(1, reach + 1):
        arcs[s, TARGET] = (0, THREAT_AT_TARGET)
    return Transducer(arcs, {0: 0} | {s: s - 1 for s in range(1, reach + 1)})


class Grammar:
    """The composition of transducers: its states are tuples of theirs, built when first met,
    and the factor of an arc is the product of theirs."""

    def __init__(self, *machines: Transducer):
        self.machines = machines
        self.start = (0,) * len(machines)
        self.arcs: dict = {}

    def step(self, state: tuple, kind: int) -> tuple[tuple, float]:
        found = self.arcs.get((state, kind))
        if found is None:
            steps = [m.step(s, kind) for m, s in zip(self.machines, state)]
            found = self.arcs[state, kind] = tuple(s for s, _ in steps), math.prod(f for _, f in steps)
        return found

    def clause(self, kinds: bytes, weights: list[float]) -> float:
        """The weight of a clause; `weights` are those of its insults, in order."""
        state, total, at = self.start, 0.0, 0
        for kind in kinds:
            state, factor = self.step(state, kind)
            if kind == INSULT:
                total += weights[at] * factor
                at += 1
            elif kind == THREAT:
                total += THREAT_ALONE * factor
            elif kind == TARGET and factor > 1.0:
                total += factor
        return total


def toxic_grammar() -> Grammar:
    return Grammar(insult_machine(), target_machine(), negation_machine(), report_machine(), threat_machine())


@dataclass
class Model:
    """Learned insults: whole words and word beginnings with weights, and the judge of clauses."""

    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    #: Intercept and coefficients of `features`; as they are without any labels.
    judge: list[float] = field(default_factory=lambda: [-3.0, 1.0, 1.0, 1.0, 0.0])


class Reader:
    """Reads texts by a model."""

    def __init__(self, model: Model):
        self.grammar = toxic_grammar()
        self.kinds: dict[str, int] = {w: k for k, ws in WORDS.items() for w in ws.split()}
        self.weights = {w: SEED_WEIGHT for w in WORDS[INSULT].split()}
        self.words, self.beginnings = model.words, model.beginnings
        self.known: dict[str, tuple[int, float]] = {}
        self.judge = np.array(model.judge)

    def look_up(self, word: str) -> tuple[int, float]:
        """The lexicon transducer: class and weight of a word; the longest beginning counts."""
        weight = self.words.get(word, 0.0)
        if not weight:
            for n in range(min(len(word), BEGINNINGS[-1]), BEGINNINGS[0] - 1, -1):
                weight = self.beginnings.get(word[:n], 0.0)
                if weight:
                    break
        weight = max(weight, self.weights.get(word, 0.0))
        if weight > 0:
            return INSULT, weight
        return (END, 0.0) if word in ".!?;:\n" else (self.kinds.get(word, OTHER), 0.0)

    def clauses(self, text: str) -> tuple[list[float], int]:
        """The weights of the matched clauses, and how many clauses there are."""
        found = WORD_OR_END.findall(text.lower())
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(found):
            if word not in known:
                known[word] = self.look_up(word)
        kinds = bytes([known[w][0] for w in found])
        parts = kinds.split(bytes([END]))
        if INSULT not in kinds and THREAT not in kinds:
            return [], len(parts)
        weights, at, matched = [], 0, []
        for part in parts:
            if INSULT in part or THREAT in part:
                weights = [known[w][1] for w, k in zip(found[at : at + len(part)], part) if k == INSULT]
                total = self.grammar.clause(part, weights)
                if total > 0:
                    matched.append(total)
            at += len(part) + 1
        return matched, len(parts)

    def features(self, text: str) -> list[float]:
        matched, n = self.clauses(text)
        if not matched:
            return [1.0, 0.0, 0.0, 0.0, 0.0]
        return [1.0, math.log1p(sum(matched)), min(max(matched), 8.0), math.log1p(len(matched)), sum(matched) / (n + 5.0)]

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, 5)
        return 1 / (1 + np.exp(-np.clip(x @ self.judge, -30, 30)))


def _units(text: str) -> set[str]:
    """The words of a text, ending in a blank, and their beginnings."""
    words = set(re.findall(r"[^\W\d_]+", text.lower()))
    return {w + " " for w in words} | {w[:n] for w in words for n in BEGINNINGS if len(w) >= n}


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic, clean = Counter(), Counter()
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            (toxic if label else clean).update(_units(text.as_py()))
        units = list(toxic | clean)
        yield pa.RecordBatch.from_arrays(
            [pa.array(units, pa.string()), pa.array([toxic[u] for u in units], pa.int64()), pa.array([clean[u] for u in units], pa.int64())],
            names=["unit", "toxic", "clean"],
        )


def held_out(part: int, of: int, key: str = "doc_id") -> Column:
    """Rows whose labels are never read: those where crc32 of the id as text leaves `part`."""
    return F.coalesce(F.crc32(whole_number(key).cast("string")) % of == part, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, part: int, of: int, sample: int) -> DataFrame:
    """(text, label) of at most `sample` labelled texts outside the held-out part: those whose
    ids have the smallest hashes.  Equal texts count once.  The ids of the sample are what bounds
    the broadcast."""
    known = labels.select(whole_number().alias("_id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where(~held_out(part, of, "_id") & F.col("_id").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(whole_number().alias("_id"), text_of().alias("text"))
    return texts.join(F.broadcast(known), "_id").groupBy("text").agg(F.max("label").alias("label"))


def learn(docs: DataFrame, labels: DataFrame, part: int = 0, of: int = 5, sample: int = SAMPLE) -> Model:
    """Learn insults and the judge from at most `sample` labelled texts (see training_sample).

    Without toxic or without clean labels the fixed lexicon and judge are used.
    """
    rows = materialise(training_sample(docs, labels, "toxic", part, of, sample), "toxicity-sample")
    counts = rows.mapInArrow(giving_back(_count_units), "unit string, toxic long, clean long").groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not n.get(1) or not n.get(0):
        return Model()
    # Units that stand out among toxic texts: well above chance, and several times as frequent.
    expected = (F.col("toxic") + F.col("clean")) * (n[1] / (n[0] + n[1]))
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    best = (
        counts.where("toxic >= 3")
        .select("unit", odds.alias("odds"), ((F.col("toxic") - expected) / F.sqrt(expected)).alias("z"))
        .where("odds >= 1.8 and z >= 4.5")
        .orderBy(F.desc("z"), "unit")
        .limit(MOST_UNITS)
    )
    # The most significant first; of about equal ones the longest, which fits fewer other words.
    found = sorted(best.collect(), key=lambda r: (-round(20 * math.log(r["z"])), -len(r["unit"]), r["unit"]))
    of_texts = _units_of_texts(rows.where("label = 1"), [r["unit"] for r in found])
    model, explained = Model(), np.zeros(len(of_texts))
    has = [np.array([i in of_text for of_text in of_texts], bool) for i in range(len(found))]
    for (unit, odds, _), texts in zip(found, has):
        # Units of texts that are explained already add nothing.
        if (texts & (explained < EXPLAINED)).sum() >= max(NEW_TEXTS, 0.002 * len(of_texts)):
            weight = min(odds / 2.0, 4.0)
            (model.words if unit.endswith(" ") else model.beginnings)[unit.strip()] = weight
            explained += weight * texts
    model.judge = fit_judge(rows, model)
    return model


def _units_of_texts(rows: DataFrame, units: list[str]) -> list[set[int]]:
    """Which of the units each text has, by number; texts and units are those of the sample."""
    number = {u: i for i, u in enumerate(units)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(number[u] for u in _units(t.as_py()) if u in number) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["units"])

    return [set(r["units"]) for r in rows.select("text").mapInArrow(giving_back(run), "units array<int>").collect()]


def fit_judge(rows: DataFrame, model: Model) -> list[float]:
    """Logistic regression of the label on the clause features of the sample: a few Newton
    steps with a weak ridge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            x = [reader.features(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    table = rows.mapInArrow(giving_back(run), "x array<double>, label int").groupBy("x", "label").count().toPandas()  # rows of the sample at most
    x, y, n = np.array(table["x"].tolist()).reshape(-1, 5), table["label"].to_numpy(float), table["count"].to_numpy(float)
    ridge = np.diag([1e-3, 0.05, 0.05, 0.05, 0.05]) * max(1.0, n.sum() / 100)
    beta = np.zeros(5)
    beta[0] = math.log((n @ y + 1) / (n @ (1 - y) + 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + ridge, x.T @ (n * (y - p)) - ridge @ beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, score) for every row: 0 to 1, higher for likelier toxic.

    Null and empty texts have no clauses and get the score of a text without matches.  Keys may
    be null or repeated; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            scores = reader.scores([t.as_py() for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(whole_number(key).alias("doc_id"), text_of(text)).mapInArrow(giving_back(run), "doc_id bigint, score double")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, all columns, whose texts score below 0.5."""
    from pyspark.sql.functions import arrow_udf

    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(model)
        for texts in columns:
            yield pa.array(reader.scores(texts.to_pylist()), pa.float64())

    @arrow_udf("double")
    def toxic(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from giving_back(scores)(columns)

    return docs.where(toxic(text_of()) < 0.5)
