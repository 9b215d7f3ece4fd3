"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The features of a text come from its whole content: densities of a seed lexicon and of a learned one,
how near their words stand to a second-person word, capitals, punctuation and obfuscation. The learned
lexicon holds the words and stems whose odds to occur in a toxic text are high with certainty. Fitting
is crossed over two halves of the labelled rows: the features of a half use the lexicon of the other
one, and the calibration uses the scores of trees grown on the other one. Scoring is one pass in which a
text leaves the JVM once.

At most ``SAMPLE_ROWS`` labelled rows are used for fitting; those with the smallest hash of the id.

Defined results
    null or empty text, or without words: scored from features that are all zero. Null labels and null
    ids are not learned from. Several labels of one id: the largest counts. Repeated rows: scored alike.
    Labels of one class only, or none: that class's share (one half without labels) for each text.
    Empty table: no rows. Other columns: kept by ``score``, which adds ``score`` or replaces it.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Stage, free_name

SAMPLE_ROWS = 20_000
FOLDS = 5
HELD_OUT = 0
LEAST_DOCUMENTS = 3
LEAST_Z = 3.0
STEM = 5  # letters that inflected and compound forms of a word share
TREES = 30
DEPTH = 3

SEEDS = frozenset(
    """
    idiot idiots stupid moron morons trash scum loser losers worthless pathetic disgusting clown clowns dumb
    fool fools garbage filth filthy vermin ugly hate kill shut liar pig freak creep bastard bitch crap damn
    dumm dummkopf idioten abschaum versager wertlos ekelhaft widerlich hässlich arschloch müll
    imbécile crétin abruti ordure minable dégoûtant stupide nul salaud connard
    idiota estúpido imbécil basura escoria perdedor asqueroso patético inútil payaso cabrón
    """.split()
)
SECOND_PERSON = frozenset(
    """
    you your yours yourself u ur du dich dir dein deine deinen ihr euch euer tu te toi ton ta tes vous votre vos
    tú ti tus usted ustedes vosotros
    """.split()
)
WORD = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"[0-9@$*]+[a-z]")
UNMASK = str.maketrans("013457@$", "oieastas")
FEATURES = [
    "seed_density", "learned_density", "learned_distinct", "learned_count", "learned_weight", "strongest", "second_person",
    "nearest_person", "mean_person", "capitals", "shouted", "exclaims", "punctuation", "masked", "unmasked_hits", "drawn_out", "length",
]


def terms(words: list[str]) -> set[str]:
    """The distinct words, and the stems of longer ones."""
    distinct = set(words)
    return distinct | {w[:STEM] + "*" for w in distinct if len(w) > STEM}


def features_of(text: str | None, learned: dict[str, float], stems: set[str], watched: set[str]) -> list[float]:
    """``stems``: those of the learned terms; ``watched``: learned words, seeds and second persons."""
    import numpy as np

    low = (text or "").lower()
    words = WORD.findall(low)
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    hits, persons = [], []
    for i, w in enumerate(words):
        if w in watched or (w[:STEM] in stems and len(w) > STEM):
            (persons if w in SECOND_PERSON else hits).append(i)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    capitals, small = counts[65:91].sum(), counts[97:123].sum()
    letter = ((raw | 32) >= 97) & ((raw | 32) <= 122)
    upper = letter & (raw < 91)
    drawn = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & letter[2:]
    weights = [max(learned.get(words[i], 0.0), learned.get(words[i][:STEM] + "*", 0.0)) for i in hits]
    near = [0.0]
    if hits and persons:
        p = np.array(persons)
        near = [1.0 / float(np.abs(p - i).min()) for i in hits]
    masked = [m for m in MASKED.finditer(low) if m.start() and low[m.start() - 1].isalpha()]
    unmasked = 0
    for m in masked:
        a, b = m.start(), m.end()
        while a and (low[a - 1].isalnum() or low[a - 1] in "@$*"):
            a -= 1
        while b < len(low) and (low[b].isalnum() or low[b] in "@$*"):
            b += 1
        whole = low[a:b].translate(UNMASK)
        unmasked += whole in learned or whole in SEEDS
    return [
        100.0 * sum(words[i] in SEEDS for i in hits) / n,
        100.0 * sum(w > 0 for w in weights) / n,
        float(len({words[i] for i in hits})),
        math.log1p(len(hits)),
        sum(weights) / n,
        max(weights, default=0.0),
        100.0 * len(persons) / n,
        max(near),
        sum(near) / len(near),
        float(capitals / max(1, capitals + small)),
        float((upper[1:] & upper[:-1]).sum() / max(1, capitals + small)),
        100.0 * float(counts[33] + counts[63]) / n,
        float((counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) / len(raw)),
        100.0 * len(masked) / n,
        100.0 * unmasked / n,
        100.0 * float(drawn.sum()) / n,
        math.log1p(n),
    ]


def features(text_col: str, learned: dict[str, float]) -> Column:
    """The features of a text as an array, in Arrow batches."""

    @F.pandas_udf("array<double>")
    def run(texts):
        import pandas as pd

        stems = {t[:-1] for t in learned if t[-1] == "*"}
        watched = SEEDS | SECOND_PERSON | learned.keys()
        return pd.Series([features_of(t, learned, stems, watched) for t in texts])

    return run(F.col(text_col))


def fold(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """``text``, ``label``, ``half`` of at most so many labelled rows outside the held-out fold."""
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != HELD_OUT))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(F.col(label_col)).cast("double").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # ``known`` has at most ``rows`` small rows, so the documents need not be shuffled.
    found = texts.join(F.broadcast(known), "id").dropDuplicates(["id"])
    half = F.crc32(F.concat(F.lit("half"), F.col("id").cast("string")).cast("binary")) % 2
    return found.select("text", "label", half.alias("half"))


def learned_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words with their log odds ratio, where it lies ``LEAST_Z`` standard errors above zero."""

    @F.pandas_udf("array<string>")
    def distinct_words(texts):
        import pandas as pd

        return pd.Series([sorted(terms(WORD.findall((t or "").lower()))) for t in texts])

    totals = sample.agg(F.sum("label"), F.count("*")).first()
    toxic, clean = totals[0] or 0.0, (totals[1] or 0) - (totals[0] or 0.0)
    words = sample.select("label", F.explode(distinct_words("text")).alias("word")).groupBy("word")
    counts = words.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).filter(F.col("toxic") >= LEAST_DOCUMENTS)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    return {r.word: r.odds for r in counts.select("word", odds.alias("odds"), error.alias("e")).filter(F.col("odds") >= LEAST_Z * F.col("e")).collect()}


class Model:
    """``score`` adds the calibrated probability as column ``score``."""

    def __init__(self, learned, trees, calibration, share: float):
        self.learned, self.trees, self.calibration, self.share = learned, trees, calibration, share

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        docs = docs.select([c for c in docs.columns if c.lower() != "score"])
        names = {n: free_name([*docs.columns, "score"], n) for n in ("features", "rawPrediction", "probability", "prediction", "raw")}
        if self.trees is None:
            return docs.withColumn("score", F.lit(self.share))
        trees = self.trees.copy()
        trees.setFeaturesCol(names["features"]).setRawPredictionCol("").setProbabilityCol(names["probability"]).setPredictionCol("")
        scored = docs.withColumn(names["features"], array_to_vector(features(text_col, self.learned)))
        scored = trees.transform(scored).withColumn(names["raw"], vector_to_array(names["probability"])[1])
        if self.calibration is None:
            return scored.withColumn("score", F.col(names["raw"])).select(*docs.columns, "score")
        steps = self.calibration.copy()
        steps.setFeaturesCol(names["raw"]).setPredictionCol(names["prediction"])
        # The raw value orders texts within a step and never moves one across 0.5.
        level = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(names["prediction"])))
        score = F.when(level >= 0.5, F.greatest(F.lit(0.5), 0.99 * level + 0.01 * F.col(names["raw"])))
        score = score.otherwise(F.least(F.lit(0.4999), 0.99 * level + 0.01 * F.col(names["raw"])))
        return steps.transform(scored).withColumn("score", score).select(*docs.columns, "score")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    stage = Stage(docs.sparkSession, "toxicity")
    sample = stage.keep("sample", labelled_sample(docs, labels, id_col, text_col, label_col, sample_rows))
    total = sample.agg(F.avg("label")).first()[0]
    halves = [sample.filter("half = 0"), sample.filter("half = 1")]
    lexica = [learned_lexicon(h) for h in halves]
    parts = [
        stage.keep("features", h.select("label", array_to_vector(features("text", other)).alias("features")).coalesce(2))
        for h, other in zip(halves, reversed(lexica))
    ]
    both = parts[0].unionByName(parts[1])
    learned = learned_lexicon(sample)
    if both.select("label").distinct().count() < 2:
        return Model(learned, None, None, 0.5 if total is None else float(total))
    booster = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1, minInstancesPerNode=3, featuresCol="features", labelCol="label")
    trees, calibration = booster.fit(both), None
    if all(x.select("label").distinct().count() == 2 for x in parts):
        crossed = [booster.fit(x).transform(y) for x, y in (parts, reversed(parts))]
        held = crossed[0].unionByName(crossed[1]).select("label", vector_to_array("probability")[1].alias("raw"))
        calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(stage.keep("held", held))
    stage.drop("features", "held", "sample")
    return Model(learned, trees, calibration, float(total))


def predicted(score_col: str = "score") -> Column:
    return (F.col(score_col) >= 0.5).cast("int")
