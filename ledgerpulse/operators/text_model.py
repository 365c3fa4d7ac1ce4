"""Intent classifier: TF-IDF over word n-grams, balanced multinomial regression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    IndexToString,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    StringIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import materialize, spread
from .churn_model import balanced_weight

# Words: two or more letters, digits or underscores of any script in a row (fixed value).
TOKEN = r"[\p{L}\p{N}_]{2,}"


def term_stages(text: str = "text", ngrams: int = 2, stop_words: list[str] | None = None) -> PipelineModel:
    """Text to ``_terms``: words without stop words, then their n-grams up to ``ngrams``."""
    words = RegexTokenizer(inputCol=text, outputCol="_all_words", pattern=TOKEN, gaps=False, toLowercase=True)
    kept = StopWordsRemover(
        inputCol="_all_words", outputCol="_words", caseSensitive=True,
        stopWords=StopWordsRemover.loadDefaultStopWords("english") if stop_words is None else stop_words,
    )
    longer = [NGram(n=n, inputCol="_words", outputCol=f"_grams_{n}") for n in range(2, ngrams + 1)]
    parts = ", ".join(["_words", *[g.getOutputCol() for g in longer]])
    together = SQLTransformer(statement=f"SELECT *, concat({parts}) AS _terms FROM __THIS__")
    return PipelineModel([words, kept, *longer, together])


def top_terms(terms: DataFrame, n: int) -> list[str]:
    """The ``n`` most frequent terms, ties in alphabetical order, listed alphabetically.

    A plain explode would make Spark test each array for emptiness below the
    exchange, that is, tokenise every text once more just for that.
    """
    each = terms.select(F.explode_outer("_terms").alias("term"))
    counts = each.groupBy("term").agg(F.count("term").alias("n")).filter(F.col("term").isNotNull())
    return sorted(r["term"] for r in counts.orderBy(F.desc("n"), "term").limit(n).select("term").collect())


def term_counts(train: DataFrame, text: str, ngrams: int, terms: int, stop_words: list[str] | None) -> tuple[PipelineModel, DataFrame]:
    """Text to ``_terms`` and ``_counts``, and the rows of ``train`` with both.

    The vocabulary is found with one aggregate over all terms and is bounded by
    ``terms``, so it fits in the model.
    """
    to_terms = term_stages(text, ngrams, stop_words)
    split = to_terms.transform(spread(train))
    counter = CountVectorizerModel.from_vocabulary(top_terms(split, terms), inputCol="_terms", outputCol="_counts")
    return PipelineModel([to_terms, counter]), counter.transform(split)


def weight_stages(counted: DataFrame) -> list[Transformer]:
    """``_counts`` to ``_tfidf``: count times ``ln((1 + n) / (1 + df)) + 1``, rows scaled to length one."""
    idf = IDF(inputCol="_counts", outputCol="_idf").fit(counted)
    weights = ElementwiseProduct(
        scalingVec=Vectors.dense(idf.idf.toArray() + 1), inputCol="_counts", outputCol="_weighted"
    )
    return [weights, Normalizer(p=2.0, inputCol="_weighted", outputCol="_tfidf")]


def tfidf_stages(
    train: DataFrame, text: str = "text", ngrams: int = 2, terms: int = 3000, stop_words: list[str] | None = None
) -> PipelineModel:
    """Text to ``_tfidf``, fitted on ``train``."""
    counts, counted = term_counts(train.select(text), text, ngrams, terms, stop_words)
    return PipelineModel([*counts.stages, *weight_stages(counted)])


def tfidf_long(stages: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """Non-zero weights as rows: key, term, weight."""
    vocabulary = F.array(*[F.lit(t) for t in stages.stages[1].vocabulary])
    sparse = F.unwrap_udt("_tfidf")
    entries = F.arrays_zip(sparse["indices"].alias("i"), sparse["values"].alias("w"))
    return (
        stages.transform(df)
        .select(key, F.inline_outer(entries).alias("_i", "weight"))
        .filter(F.col("_i").isNotNull())
        .select(key, F.element_at(vocabulary, F.col("_i") + 1).alias("term"), "weight")
    )


def classify_terms(
    weights: DataFrame, key: str, coefficients: DataFrame, labels: list[str], intercepts: dict[str, float] | None = None
) -> DataFrame:
    """``pred`` and ``confidence`` per document from its term weights (`tfidf_long`) and a table of coefficients
    (``term``, ``label``, ``b``): the scoring of the classifier as a join and two sums.

    A document without a known term gets the intercepts alone only if it is in ``weights`` at all. Of classes that score the same the
    first in label order wins. ``coefficients`` has as many terms as the vocabulary of a model, so it goes to the weights, which stay
    where they are; a document's weights are then summed before they move.
    """
    classes = sorted(set(labels))
    per_term = coefficients.groupBy("term").agg(*[
        F.sum(F.when(F.col("label") == c, F.col("b"))).alias(f"_b{i}") for i, c in enumerate(classes)
    ])
    joined = weights.select(key, "term", "weight").join(F.broadcast(per_term), "term", "left")
    sums = joined.groupBy(key).agg(*[F.sum(F.col("weight") * F.col(f"_b{i}")).alias(f"_v{i}") for i in range(len(classes))])
    zs = [F.lit((intercepts or {}).get(c, 0.0)) + F.coalesce(F.col(f"_v{i}"), F.lit(0.0)) for i, c in enumerate(classes)]
    scored = sums.select(key, F.array(*[
        F.struct(z.alias("z"), F.lit(-i).alias("first"), F.lit(c).alias("label")) for i, (c, z) in enumerate(zip(classes, zs))
    ]).alias("zs"))
    out = scored.withColumn("best", F.array_max("zs"))
    total = F.aggregate(F.col("zs"), F.lit(0.0), lambda acc, z: acc + F.exp(z["z"] - F.col("best.z")))
    return out.select(key, F.col("best.label").alias("pred"), (1 / total).alias("confidence"))


@dataclass(frozen=True)
class IntentModel:
    stages: PipelineModel
    labels: list[str]

    def coefficients(self, spark: SparkSession) -> tuple[DataFrame, dict[str, float]]:
        """The fitted coefficients as rows ``term``, ``label``, ``b``, and the intercepts."""
        vocabulary, fit = self.stages.stages[1].vocabulary, self.stages.stages[-2]
        matrix = fit.coefficientMatrix.toArray()
        rows = [(t, c, float(b)) for c, own in zip(self.labels, matrix) for t, b in zip(vocabulary, own)]
        return spark.createDataFrame(rows, "term string, label string, b double"), dict(zip(self.labels, map(float, fit.interceptVector)))

    def classify(self, df: DataFrame) -> DataFrame:
        """Add ``pred`` and ``confidence`` (highest class probability), batch or stream."""
        return self.stages.transform(df).select(
            *df.columns, "pred", F.array_max(vector_to_array("_probability")).alias("confidence")
        )


def intent_model(
    train: DataFrame,
    text: str = "text",
    label: str = "intent_name",
    ngrams: int = 2,
    terms: int = 3000,
    stop_words: list[str] | None = None,
    l2: float = 1.0,
    max_iter: int = 2000,
    tol: float = 1e-6,
) -> IntentModel:
    """Fit vocabulary, weights and classifier on ``train`` only.

    The counts are kept on disk until the vectors are stored, in files of even size, so the text is tokenised for the
    vocabulary and for the counts only, not for the weights and not for every iteration. The loss is a weighted sum plus ``l2 / 2`` times the squared
    coefficients; balanced weights add up to the number of rows.
    """
    weight, n = balanced_weight(train, label)
    counts, counted = term_counts(train.select(text, label), text, ngrams, terms, stop_words)
    # Kept in its own partitions, so the vectors are stored in the same order as if they were made from the texts again.
    counted = counted.select(label, "_counts").persist(StorageLevel.DISK_ONLY)
    weigh = weight_stages(counted)
    weighted = PipelineModel(weigh).transform(counted.withColumn("_weight", weight))
    ready = materialize(weighted.select(label, "_weight", "_tfidf").hint("rebalance"), "tfidf")
    counted.unpersist()
    indexer = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(ready)
    regression = LogisticRegression(
        featuresCol="_tfidf", labelCol="_label", weightCol="_weight", probabilityCol="_probability",
        predictionCol="_prediction", rawPredictionCol="_raw", standardization=False, elasticNetParam=0.0,
        regParam=l2 / n, maxIter=max_iter, tol=tol,
    ).fit(indexer.transform(ready))
    back = IndexToString(inputCol="_prediction", outputCol="pred", labels=indexer.labels)
    return IntentModel(PipelineModel([*counts.stages, *weigh, regression, back]), list(indexer.labels))
