"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression (Spark ML).

Features are native expressions over the whole text: densities of a fixed and of a learned lexicon, lexicon words near a
second-person word, lexicon words in disguise (digits and signs for letters), capitals, exclamation marks, punctuation,
digits, length. Labels, language, source and ids are no features.

The learned lexicon and the trees come from a sample of labelled rows of at most ``most_rows`` (chosen by a hash of the key, a
documented bound on what is fitted, not on what is scored). Trees are fitted on two parts of the training rows, the isotonic
curve on the third. Every text of the input is scored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.session import staged

MOST_ROWS = 40_000
LEXICON_SIZE = 200
THRESHOLD = 0.3
NEAR = 5

# Insults and second-person words in English, French, German and Spanish.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting clown imbecile "
    "fool jerk bastard bitch shit crap hate ugly filth vermin retard freak creep liar coward disgrace imbécile crétin "
    "connard connasse salaud ordure débile abruti dummkopf arschloch trottel vollidiot abschaum hurensohn wichser "
    "schwachkopf estúpido imbécil basura asqueroso idiota payaso patético inútil escoria cabrón pendejo").split()
SECOND_PERSON = ("you your yours you're yourself u ur thou thee tu te toi ton ta tes vous votre vos du dich dir dein deine ihr "
                 "euch euer usted ustedes vosotros ti tuyo").split()
FEATURES = ("fixed", "learned", "any_fixed", "any_learned", "near", "disguised", "capitals", "shouted", "punctuation", "signs",
            "digits", "length")
DISGUISE = ("0134578@$!|+", "oleastbasiit")


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}']+"), "")


def _plain(word: Column) -> Column:
    """A word with signs read as the letters they stand for and without other signs."""
    return F.regexp_replace(F.translate(F.lower(word), *DISGUISE), r"[^\p{L}]", "")


def features(docs: DataFrame, lexicon: list[tuple[str, float]], text: str = "text") -> DataFrame:
    """The input without its text and with the feature columns. Null and empty texts have all rates 0."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rest = [c for c in docs.columns if c != text]
    learned = [w for w, _ in lexicon] or [""]
    listed = docs.select(*[F.col(f"`{c}`") for c in rest], body.alias("__body"), _tokens(body).alias("__tokens"))

    def near(tokens: Column) -> Column:
        def beside(i: Column) -> Column:  # only the words around an insult are looked at
            begin = F.greatest(i - NEAR, F.lit(0))
            return F.exists(F.slice(tokens, begin + 1, i + NEAR - begin + 1), lambda w: w.isin(SECOND_PERSON))
        insults = F.filter(F.transform(tokens, lambda w, i: F.when(w.isin(INSULTS), i)), lambda i: i.isNotNull())
        return F.size(F.filter(insults, beside))

    # runs of letters and signs with a sign behind a letter; read as letters they are an insult, and not without their ends
    odd = F.filter(F.split(F.col("__body"), r"[^\p{L}@$!|+*.0-9_-]+"), lambda w: w.rlike(r"\p{L}[@$!|+*.0-9_-]"))
    disguised = F.size(F.filter(odd, lambda w: _plain(w).isin(INSULTS)
                                & ~F.regexp_extract(F.lower(w), r"\p{L}(?:.*\p{L})?", 0).isin(INSULTS)))
    n_fixed = F.size(F.filter("__tokens", lambda w: w.isin(INSULTS)))
    counted = listed.select(
        *[F.col(f"`{c}`") for c in rest], F.size("__tokens").alias("__n"), F.length("__body").alias("__size"), n_fixed.alias("__fixed"),
        F.size(F.filter("__tokens", lambda w: w.isin(learned))).alias("__learned"),
        F.when(n_fixed > 0, near(F.col("__tokens"))).otherwise(F.lit(0)).alias("__near"),
        F.when(F.col("__body").rlike(r"\p{L}[@$!|+*.0-9_-]+\p{L}"), disguised).otherwise(F.lit(0)).alias("__disguised"),
        *[F.length(F.regexp_replace("__body", p, "")).alias(f"__{n}") for n, p in (
            ("capitals", r"\P{Lu}+"), ("shouted", r"[^!?]+"), ("punctuation", r"[^.,;:]+"), ("signs", r"[^#*$%&|<>@]+"), ("digits", "[^0-9]+"))])
    words, size = F.greatest("__n", F.lit(1)), F.greatest("__size", F.lit(1))
    rates = {"fixed": F.col("__fixed") / words, "learned": F.col("__learned") / words, "any_fixed": F.least("__fixed", F.lit(5)),
             "any_learned": F.least("__learned", F.lit(5)), "near": F.least("__near", F.lit(5)), "disguised": F.least("__disguised", F.lit(5)),
             "length": F.log1p("__n")}
    rates |= {n: F.col(f"__{n}") / size for n in ("capitals", "shouted", "punctuation", "signs", "digits")}
    return counted.select(*[F.col(f"`{c}`") for c in rest], *[rates[n].cast("double").alias(n) for n in FEATURES])


def learn_lexicon(sample: DataFrame, size: int = LEXICON_SIZE) -> list[tuple[str, float]]:
    """Words of the labelled sample that tell toxic texts best: document frequencies, smoothed log odds weighted by how often
    toxic texts have the word. Words in fewer than five toxic texts are left out. At most ``size`` words."""
    toxic = F.col("label") == 1
    total = sample.agg(F.sum(toxic.cast("long")).alias("a"), F.count("*").alias("n")).first()
    a, b = total["a"] or 0, (total["n"] or 0) - (total["a"] or 0)
    if not a or not b:
        return []
    words = sample.select("label", F.explode(F.array_distinct(_tokens(F.coalesce("text", F.lit(""))))).alias("word"))
    counts = words.groupBy("word").agg(F.sum(toxic.cast("long")).alias("t"), F.sum((~toxic).cast("long")).alias("f")).where("t >= 5")
    odds = F.log((F.col("t") / a + 0.5 / a) / (F.col("f") / b + 0.5 / b))
    best = counts.withColumn("odds", odds).where(F.col("odds") > math.log(4.0))
    rows = best.orderBy((F.col("t") * F.col("odds")).desc(), "word").limit(size).select("word", "odds").collect()
    return [(r["word"], r["odds"]) for r in rows]


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
             most_rows: int = MOST_ROWS) -> DataFrame:
    """One row per document: key, held_out, score (0 to 1, higher is likelier toxic), predicted (1 from ``THRESHOLD`` on).

    Learned from labelled rows whose crc32(key as text) mod 4 is not 2. Rows with a null key or label teach nothing; a null
    key counts as held out. A key with several labels takes the largest. If the sample does not hold both labels, the score is
    the share of lexicon words. Repeated rows are scored each. Other columns are not read.
    """
    part = F.crc32(F.col("id").cast("string").cast("binary")) % 4
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(
        F.max(F.col(label).cast("int")).alias("label"))
    known = known.where(part != 2)
    rows = known.count()
    share = min(1.0, most_rows * 0.97 / max(rows, 1))
    chosen = staged(known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)).withColumn("part", part), "labels")
    sample = staged(docs.join(F.broadcast(chosen), "id"), "sample")  # at most most_rows rows of 16 bytes
    fit = sample.where("part <> 3")
    lexicon = learn_lexicon(fit)
    every = staged(features(docs, lexicon), "features")
    held_out = F.coalesce(part == 2, F.lit(True)).alias("held_out")
    both = {r["part3"] for r in sample.groupBy((F.col("part") == 3).alias("part3")).agg(
        F.countDistinct("label").alias("n")).where("n = 2").collect()}
    if both != {True, False}:
        raw = F.least(F.lit(1.0), F.col("fixed") * 20 + F.col("learned") * 20)
        return every.select(F.col("id").alias(key), held_out, raw.alias("score"), (raw >= THRESHOLD).cast("int").alias("predicted"))

    gather = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    train = staged(gather.transform(features(sample.select("label", "part", "text"), lexicon)).select("label", "part", "features"), "train")
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxDepth=3, maxIter=25, stepSize=0.2, subsamplingRate=0.8,
                          minInstancesPerNode=10, seed=11).fit(train.where("part <> 3"))

    def raw_score(df: DataFrame) -> DataFrame:
        return trees.transform(df).withColumn("raw", vector_to_array("probability")[1])

    curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(
        raw_score(train.where("part = 3")).select("raw", F.col("label").cast("double").alias("label")))
    scored = curve.transform(raw_score(gather.transform(every)).select("id", "raw"))
    # the curve is flat in steps; a thousandth of the raw score keeps the order within a step
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.999 * F.col("calibrated") + 0.001 * F.col("raw")))
    out = scored.select("id", score.alias("score"))
    return out.select(F.col("id").alias(key), held_out, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
