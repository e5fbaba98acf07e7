"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words map to classes: insult stems (a lexicon learned from labelled rows),
threats, targets, negations and reporting verbs.  Five small transducers read
the classes of a clause: negation opens a scope of a few words, reported speech
one that lasts to the sentence's end, a target binds the insults and threats of
its clause.  Their composition is the product automaton that ``clause_arcs``
walks; it emits one weighted arc per matched pattern.  A negated or reported
word gives its own arc only, never the plain one.  Arc weights come from a
logistic fit on the labelled sample under fixed signs (``BOUNDS``).  The plain
arc of an isolated word is free to decide alone where the labels ask for it
(README has figures).  Scores read texts only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frozen, python_ready, text_of

# Closed word classes of the four corpus languages.
TARGETS = frozenset("you your yours yourself u du dich dir dein deine euch tu te toi vous ton ta "
                    "tes usted ustedes ti tus".split())
NEGATIONS = frozenset("not never no nor isn aren wasn don doesn nicht kein keine nie pas jamais "
                      "aucun ni nunca jamás".split())
REPORTS = frozenset("said says wrote writes quoted claimed alleged called sagte schrieb "
                    "zitierte dit écrit déclaré dijo escribió".split())
THREATS = frozenset("kill murder destroy strangle stab töten ermorden umbringen tuer "
                    "assassiner égorger matar asesinar apuñalar".split())

NEGATION_SCOPE = 3
MIN_STEM, MAX_STEM = 4, 8
ARCS = ("insult", "aimed_insult", "negated_insult", "reported_insult", "threat", "density")
#: Least and greatest weight of each arc: negation and report never count against a text,
#: an aimed insult and a threat always do.
BOUNDS = ((0.0, math.inf), (0.5, math.inf), (-math.inf, 0.0), (-math.inf, 0.0), (0.5, math.inf),
          (0.0, math.inf))

#: Labelled rows that shape the lexicon and weights, at most (about; drawn by a hash of doc_id).
MAX_LABELLED = 20_000
#: Lexicon entries, at most.
MAX_STEMS = 4_000
MIN_TOXIC_DOCS = 3
MAX_CLEAN_SHARE, MIN_LOG_ODDS = 0.002, 3.0
#: Bound on the log probability that a stem's documents are toxic this often by chance, at most.
MAX_LOG_CHANCE = -10.0
CACHED_WORDS = 600_000

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")
CLAUSE = re.compile(r"[;:,]+")


def held_out() -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text is 0 mod 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


@dataclass
class Grammar:
    """Insult stems with weights, and the fitted arc weights."""

    stems: dict[str, float]
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0

    def __post_init__(self) -> None:
        self._known: dict[str, float | str] = {}

    def class_of(self, word: str) -> float | str:
        """Insult weight (above 0), a class letter, or 0.0."""
        for k in range(min(len(word), MAX_STEM), MIN_STEM - 1, -1):
            w = self.stems.get(word[:k])
            if w:
                return w
        for name, words in (("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS), ("K", THREATS)):
            if word in words:
                return name
        return 0.0

    def clause_arcs(self, classes: list[float | str], total: list[float],
                    reported: bool = False) -> bool:
        """Walk the composed transducers over one clause, adding to the arc sums;
        whether the rest of its sentence is reported."""
        aimed = "T" in classes
        negated = 0
        for c in classes:
            if c == "N":
                negated = NEGATION_SCOPE
                continue
            if c == "R":
                reported = True
            elif c == "K":
                if aimed and not negated and not reported:
                    total[4] += 1.0
            elif c.__class__ is float and c > 0:
                if reported:
                    total[3] += c
                elif negated:
                    total[2] += c
                else:
                    total[0] += c
                    if aimed:
                        total[1] += c
            if negated:
                negated -= 1
        return reported

    def arcs(self, text: str) -> list[float]:
        """Arc features of a whole text (log-scaled sums; density per 100 words)."""
        known, total = self._known, [0.0] * 5
        if len(known) > CACHED_WORDS:
            known.clear()
        low = text.lower()
        words = WORD.findall(low)
        seen = set(words)
        for w in seen:
            if w not in known:
                known[w] = self.class_of(w)
        if not any(known[w] and known[w] not in ("T", "N", "R") for w in seen):
            return [0.0] * 6
        for sentence in SENTENCE.split(low):
            reported = False
            for clause in CLAUSE.split(sentence):
                classes = [known[w] for w in WORD.findall(clause)]
                if any(classes):
                    reported = self.clause_arcs(classes, total, reported)
        density = 100.0 * total[0] / max(1, len(words))
        return [math.log1p(x) for x in (*total, density)]

    def score(self, text: str) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.weights, self.arcs(text)))
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """``(text, toxic, lang)`` of labelled, not held-out documents, about ``max_rows`` at most;
    ``lang`` is empty where ``docs`` has none.

    All labels count while they are few; beyond, a hash of the id decides, so the
    sample is the same in every run.
    """
    known = (labels.where(F.col("toxic").isNotNull()).groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")).where(F.col("doc_id").isNotNull() & ~held_out()))
    n = known.count()
    share = min(1.0, max_rows / max(1, n))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # bounded by max_rows ids
    lang = text_of("lang") if "lang" in docs.columns else F.lit("")
    return (docs.select("doc_id", text_of().alias("text"), lang.alias("lang"))
            .join(F.broadcast(drawn), "doc_id").select("text", "toxic", "lang"))


def learn_stems(sample: DataFrame, max_stems: int = MAX_STEMS) -> dict[str, float]:
    """Word prefixes whose documents are toxic far more often than others of their languages.

    The evidence is the log-likelihood ratio of a stem's toxic and clean documents
    against the toxic share of their languages (a bound on the chance of so many), so it
    grows with counts and a rare language is judged by its own documents.  Counted in
    Spark over the sample; the driver receives at most ``max_stems`` candidate rows,
    and keeps the shortest qualifying prefix of each family, lengthened as long as no
    toxic document is lost.
    """
    size = sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t"))
    total = size.agg(F.sum("n").alias("n"), F.sum("t").alias("t")).collect()[0]
    toxic, clean = int(total["t"] or 0), int((total["n"] or 0) - (total["t"] or 0))
    if not toxic:
        return {}
    overall = toxic / (toxic + clean + 1)
    # one document's worth of the overall share keeps the rate of a small language inside (0, 1)
    rates = size.select("lang", ((F.col("t") + overall) / (F.col("n") + 1)).alias("rate"))
    words = F.filter(F.array_distinct(F.regexp_extract_all(
        F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))), lambda w: F.length(w) >= MIN_STEM)

    def prefixes(of: Column) -> Column:
        return F.flatten(F.transform(of, lambda w: F.transform(
            F.sequence(F.lit(MIN_STEM), F.least(F.length(w), F.lit(MAX_STEM))),
            lambda k: F.substring(w, F.lit(1), k))))

    longest = F.array_distinct(F.transform(words, lambda w: F.substring(w, 1, MAX_STEM)))
    t, c, rate = F.col("t"), F.col("c"), F.col("rate")
    odds = F.log((t + 0.5) / (c + 0.5)) - F.log(rate / (1 - rate))
    # of differing rates their mean bounds the chance (Hoeffding)
    evidence = t * F.log(t / ((t + c) * rate)) + F.when(
        c > 0, c * F.log(c / ((t + c) * (1 - rate)))).otherwise(0.0)
    found = frozen(
        sample.join(F.broadcast(rates), "lang")
        .select("toxic", "rate", F.explode(F.array_distinct(prefixes(longest))).alias("stem"))
        .groupBy("stem")
        .agg(F.sum(F.col("toxic")).alias("t"), F.sum(1 - F.col("toxic")).alias("c"),
             F.round(F.avg("rate"), 9).alias("rate"))
        .where((t >= MIN_TOXIC_DOCS) & (c <= MAX_CLEAN_SHARE * clean))
        .withColumn("odds", odds).withColumn("evidence", evidence)
        .where(F.col("odds") >= MIN_LOG_ODDS)
        .orderBy(F.col("evidence").desc(), "stem").limit(max_stems))
    # different words of one family in one document are further evidence
    uses = (sample.where(F.col("toxic") == 1).select(F.explode(prefixes(words)).alias("stem"))
            .join(F.broadcast(found), "stem").groupBy("stem", "t", "odds", "evidence")
            .agg(F.count(F.lit(1)).alias("uses")))
    rows = uses.where(F.col("uses") / t * F.col("evidence") >= -MAX_LOG_CHANCE).collect()
    docs_with = {r["stem"]: (int(r["t"]), float(r["odds"])) for r in rows}
    chosen: dict[str, float] = {}
    for stem in sorted(docs_with, key=lambda s: (len(s), s)):
        if any(stem[:k] in docs_with for k in range(MIN_STEM, len(stem))):
            continue
        n, weight = docs_with[stem]
        while True:  # a longer prefix in just as many documents is more specific
            longer = [s for s, v in docs_with.items()
                      if len(s) == len(stem) + 1 and s.startswith(stem) and v[0] >= n]
            if not longer:
                break
            stem = longer[0]
        chosen[stem] = min(weight, 6.0)
    return chosen


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, steps: int = 100) -> tuple[list, float]:
    """Ridge logistic regression by projected Newton steps; arc weights within
    ``BOUNDS`` and bias."""
    design = np.hstack([x, np.ones((len(x), 1))])
    low, high = np.array([*BOUNDS, (-np.inf, np.inf)]).T
    penalty = np.diag([ridge] * x.shape[1] + [1e-3])

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float(np.sum(np.logaddexp(0.0, z) - y * z) + 0.5 * b @ penalty @ b)

    beta = np.clip(np.zeros(design.shape[1]), low, high)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + penalty @ beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        held = (beta <= low) & (gradient > 0) | (beta >= high) & (gradient < 0)
        free = np.flatnonzero(~held)
        step = np.zeros(len(beta))
        step[free] = np.linalg.solve(hessian[np.ix_(free, free)], gradient[free])
        now, size = loss(beta), 1.0
        moved = np.clip(beta - step, low, high)
        while size > 1e-6 and loss(moved) > now:
            size /= 2
            moved = np.clip(beta - size * step, low, high)
        done = np.abs(moved - beta).max() < 1e-8
        beta = moved
        if done:
            break
    return [float(b) for b in beta[:-1]], float(beta[-1])


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> Grammar:
    """Grammar fitted on the labelled sample.  Without any toxic label every text
    gets the same score below one half."""
    sample = frozen(labelled_sample(docs, labels, max_rows))
    grammar = Grammar(learn_stems(sample))
    schema = T.StructType([*(T.StructField(a, T.DoubleType()) for a in ARCS),
                           T.StructField("toxic", T.LongType())])

    def features(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows = [grammar.arcs(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([r[i] for r in rows], pa.float64()) for i in range(len(ARCS))),
                 b.column(1)], names=[*ARCS, "toxic"])

    rows = (python_ready(sample).select("text", F.col("toxic").cast("bigint"))
            .mapInArrow(features, schema).toPandas())  # bounded by max_rows
    y = rows["toxic"].to_numpy(dtype=float)
    if y.any() and not y.all():
        x = rows[list(ARCS)].to_numpy(dtype=float)
        order = np.lexsort([*x.T, y])  # the sum order, and so the fit, is fixed
        grammar.weights, grammar.bias = fit_weights(x[order], y[order])
    else:
        grammar.weights, grammar.bias = [0.0] * len(ARCS), -4.0
    return grammar


def toxicity_scores(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """``docs`` without its text plus ``score`` (0 to 1) and ``predicted`` (1 from one half).

    A null or empty text scores like one without a match.  Repeated rows stay;
    input columns ``score`` and ``predicted`` are replaced.
    """
    rest = [f for f in docs.schema.fields if f.name not in (text_col, "score", "predicted")]
    schema = T.StructType([*rest, T.StructField("score", T.DoubleType())])
    model = (grammar.stems, grammar.weights, grammar.bias)

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        g = Grammar(*model)
        for b in batches:
            scores = [g.score(t) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(b.num_columns - 1)), pa.array(scores, pa.float64())],
                names=[f.name for f in schema.fields])

    src = python_ready(docs).select(*[F.col(f"`{f.name}`") for f in rest],
                                    text_of(text_col).alias("__text"))
    return src.mapInArrow(work, schema).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
