"""Named queries over classified messages and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dashboards, drift, evaluation, intents, quality, sampling, text_model
from ..sources import documents, keyed_store, schemas, tables
from ..sources import testdata as data
from ..sources.workspace import fresh_path, materialize, spread
from ..streaming import baseline, ledger, monitor
from .churn import Query, formula_scores, rounded

INTENT_TEST_SHARE = 0.25
# Left out of the TF-IDF query, which SQL repeats; the models use the default list.
STOP_WORDS = ["and", "at", "for", "he", "in", "is", "it", "of", "on", "or", "that", "the", "to", "was", "with"]
# The artificial classifier of the streaming query gets worse on this day.
DRIFT_DAY = "2024-01-22 00:00:00"
# Streams that are started twice get the rows from here on with their second load; rows before the other time can be held back.
SECOND_LOAD, HELD_BACK = "2024-01-19 00:00:00", "2024-01-11 00:00:00"


# --- inputs -----------------------------------------------------------------


def pool_counts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Classified rows and their confusion counts."""
    pool = data.classified(spark, d)
    return pool, evaluation.confusion(pool)


def pool_stats(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Classified rows and the stored batch statistics with the fixed-baseline alert."""
    pool, counts = pool_counts(spark, d)
    hard = drift.hardest_labels(known_classes(counts))
    return pool, drift.drift_fixed(materialize(drift.batch_stats(pool, hard), "batches"))


def known_classes(counts: DataFrame) -> DataFrame:
    """Classes that really occur; the artificial classifier also predicts another one."""
    return evaluation.per_class(counts).filter(F.col("support") > 0)


def fitted(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, text_model.IntentModel]:
    # A comparison with one border row per class, so there is nothing to store.
    split = sampling.split_by_class(rows, "intent_name", "doc_id", INTENT_TEST_SHARE)
    model = text_model.intent_model(split.filter(F.col("split") == "train"))
    return split.filter(F.col("split") == "test"), model


def tested(spark: SparkSession, rows: DataFrame) -> DataFrame:
    test, model = fitted(spark, rows)
    return materialize(model.classify(test).drop("text", "split"), "classified")


# --- analyses of the relational table -----------------------------------------


def batch_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return intents.batch_accuracy(data.conversations_flat(spark, d))


def intent_precision(spark: SparkSession, d: str) -> DataFrame:
    return intents.intent_precision(data.conversations_flat(spark, d))


def confusion_pairs(spark: SparkSession, d: str) -> DataFrame:
    return intents.confusion_pairs(data.conversations_flat(spark, d))


def category_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return intents.category_accuracy(data.conversations_flat(spark, d))


def handoff_failures(spark: SparkSession, d: str) -> DataFrame:
    return intents.handoff_failures(data.conversations_flat(spark, d))


# --- documents ----------------------------------------------------------------


def category_lookup(spark: SparkSession, d: str) -> DataFrame:
    return data.classified(spark, d).groupBy("intent_name", "category").agg(F.count(F.lit(1)).alias("rows"))


def shaped_documents(spark: SparkSession, d: str) -> DataFrame:
    return documents.to_documents(data.classified(spark, d), "ts", "event_id")


def document_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Documents staged as JSON lines, loaded back and typed."""
    path = fresh_path(spark, "documents")
    documents.write_documents(shaped_documents(spark, d), path)
    flat = documents.flatten_documents(tables.read_json_lines(spark, path))
    return flat.withColumn("confidence", F.col("confidence").cast("double"))


def stored_conversations(spark: SparkSession, d: str) -> DataFrame:
    """The relational table by batch, read back for late batches only."""
    path = fresh_path(spark, "conversations")
    tables.write_conversations(documents.flatten_documents(shaped_documents(spark, d)), path)
    late = spark.read.parquet(path).filter(F.col("batch") >= 6)
    return late.groupBy("batch", "category").agg(F.count(F.lit(1)).alias("rows"))


def upserted_documents(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of the keyed store that overlap, the second one twice, read back."""
    path = fresh_path(spark, "store")
    docs = materialize(shaped_documents(spark, d), "documents")
    late = docs.filter("batch >= 4").withColumn("category", F.upper("category"))
    for load in (docs.filter("batch <= 6"), late, late):
        keyed_store.upsert(load, path, "conversation_id")
    return keyed_store.read_store(spark, path, schemas.DOCUMENTS, "conversation_id")


def load_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Rows accepted and rejected, by reason, of a load in which rows break each rule of the relational table."""
    number = F.substring("conversation_id", 6, 12).try_cast("int")
    damage = F.pmod(number, F.lit(50))
    long = {c: F.when(damage == at, F.repeat(c, 15)).otherwise(F.col(c)) for c, at in (("true_intent", 13), ("predicted_intent", 17), ("category", 19))}
    rows = shaped_documents(spark, d).withColumns({
        **long,
        "confidence": F.when(damage == 29, F.lit(12.5)).otherwise(F.col("confidence")),
        "conversation_id": F.when(damage == 7, F.format_string("conv_%06d", number - 1)).when(damage == 11, F.lit(None))
        .when(damage == 23, F.concat("conversation_id", F.lit("0" * 20))).otherwise(F.col("conversation_id")),
    })
    path = fresh_path(spark, "checked")
    rules = quality.length_rules(schemas.MAX_LENGTH["conversations"]) | quality.fit_rule("confidence", schemas.CONFIDENCE)
    quality.checked_load(materialize(rows, "load"), path, "conversation_id", rules)
    kept = quality.accepted(spark, path).agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("rows"))
    broken = quality.rejects(spark, path).select(F.explode("reasons").alias("reason")).groupBy("reason")
    return kept.unionByName(broken.agg(F.count(F.lit(1)).alias("rows")))


def utterances_csv(spark: SparkSession, d: str) -> DataFrame:
    """Texts with their class as CSV, line breaks and quotes included, read back."""
    path = fresh_path(spark, "utterances.csv")
    rows = data.text_rows(spark, d).select("text", "intent_name")
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return tables.read_csv(spark, path, schemas.UTTERANCES, multi_line=True)


def classified_csv(spark: SparkSession, d: str) -> DataFrame:
    """Classified rows as CSV and read back with their declared types, per batch and prediction."""
    path = fresh_path(spark, "classified.csv")
    tables.write_csv(data.classified(spark, d).select(schemas.CLASSIFIED.names), path)
    back = tables.read_csv(spark, path, schemas.CLASSIFIED)
    return back.groupBy("batch", "category", "pred").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("correct").alias("correct"), F.sum(F.length("text")).alias("chars"),
        F.round(F.sum("confidence"), 4).alias("confidence"),
    )


def batch_stats_csv(spark: SparkSession, d: str) -> DataFrame:
    """Batch statistics as one CSV file in batch order, read back with the place of every line."""
    path = fresh_path(spark, "batches.csv")
    stats = pool_stats(spark, d)[1].select(schemas.BATCH_STATS.names)
    tables.write_csv(rounded(stats, 9, "accuracy", "avg_confidence", "hard_intent_share").orderBy("batch").coalesce(1), path)
    lines = tables.read_csv(spark, path, schemas.BATCH_STATS)
    return lines.withColumn("position", F.monotonically_increasing_id() + 1)


def low_confidence(spark: SparkSession, d: str) -> DataFrame:
    return documents.low_confidence(shaped_documents(spark, d))


def misclassified(spark: SparkSession, d: str) -> DataFrame:
    return documents.misclassified_count(data.conversations_flat(spark, d))


# --- evaluation ---------------------------------------------------------------


def accuracy(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluation.accuracy(pool_counts(spark, d)[1]), 9, "accuracy")


def macro_f1(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluation.f1_summary(pool_counts(spark, d)[1]), 9, "macro_f1")


def binary_f1(spark: SparkSession, d: str) -> DataFrame:
    """F1 of one class against all others."""
    return rounded(evaluation.binary_f1(pool_counts(spark, d)[1], "purchase"), 9, "f1")


def class_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluation.class_report(pool_counts(spark, d)[1]), 9, "precision", "recall", "f1")


def confusion(spark: SparkSession, d: str) -> DataFrame:
    return pool_counts(spark, d)[1]


def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.confusion_matrix(pool_counts(spark, d)[1], [*data.EVENT_TYPES, "other"])


def confused_pairs(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.confused_pairs(pool_counts(spark, d)[1])


def reliability(spark: SparkSession, d: str) -> DataFrame:
    curve = evaluation.reliability(data.classified(spark, d))
    return rounded(curve, 9, "mean_confidence", "observed_accuracy")


def reliability_values(spark: SparkSession, d: str) -> DataFrame:
    """The same over a score with very many distinct values."""
    scored = data.events(spark, d, "value", "event_type").select(
        (F.col("value") / (F.col("value") + 50)).alias("confidence"),
        (F.col("event_type") == "purchase").cast("int").alias("correct"),
    )
    return rounded(evaluation.reliability(scored), 9, "mean_confidence", "observed_accuracy")


def brier(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluation.brier(data.classified(spark, d)), 9, "brier")


def confidence_auc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluation.roc_auc(data.classified(spark, d), "confidence", "correct"), 9, "auc")


# --- drift --------------------------------------------------------------------


def batch_sizes(spark: SparkSession, d: str) -> DataFrame:
    events = drift.batch_assign(data.events(spark, d, "event_id", "ts"), "ts", "event_id")
    return events.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"))


def hardest_classes(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.hardest_classes(known_classes(pool_counts(spark, d)[1])), 9, "f1")


def batch_stats(spark: SparkSession, d: str) -> DataFrame:
    _, stats = pool_stats(spark, d)
    return rounded(stats.drop("baseline"), 9, "accuracy", "avg_confidence", "hard_intent_share")


def alert_summary(spark: SparkSession, d: str) -> DataFrame:
    return drift.alert_summary(pool_stats(spark, d)[1])


def resampled(spark: SparkSession, d: str) -> DataFrame:
    """Thirty draws for each late batch from the rows of the hardest classes."""
    pool, counts = pool_counts(spark, d)
    hard = pool.filter(F.col("intent_name").isin(drift.hardest_labels(known_classes(counts), 2)))
    return sampling.resample(hard.select("event_id", "intent_name"), "event_id", [6, 7, 8, 9], 30)


def shuffled(spark: SparkSession, d: str) -> DataFrame:
    """Batch of every event after a seeded shuffle."""
    events = data.events(spark, d, "event_id")
    dealt = events.withColumn("_order", sampling.seeded_order("event_id", 7))
    return drift.batch_assign(dealt, "_order", "event_id").drop("_order")


def shuffled_rows(spark: SparkSession, d: str) -> DataFrame:
    return sampling.seeded_shuffle(data.table(spark, d, "events").select("event_id", "event_type"), "event_id")


def shuffled_positions(spark: SparkSession, d: str) -> DataFrame:
    """Position of every event after a seeded shuffle."""
    return sampling.shuffled_positions(data.table(spark, d, "events").select("event_id", "event_type"), "event_id")


# --- text models --------------------------------------------------------------


def tfidf(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(data.text_rows(spark, d))
    stages = text_model.tfidf_stages(rows, stop_words=STOP_WORDS)
    return rounded(text_model.tfidf_long(stages, rows, "doc_id"), 6, "weight")


def intent_scored(spark: SparkSession, d: str) -> DataFrame:
    """Documents classified with stated coefficients: thousandths of a hash of class and term, from -1 to 1."""
    rows = spread(data.text_rows(spark, d))
    stages = text_model.tfidf_stages(rows, stop_words=STOP_WORDS)
    weights = materialize(text_model.tfidf_long(stages, rows, "doc_id"), "weights")
    labels = ["de", "en", "es", "fr"]
    digest = F.md5(F.concat("label", F.lit("-"), "term"))
    stated = weights.select("term").distinct().withColumn("label", F.explode(F.array(*[F.lit(c) for c in labels]))).withColumn(
        "b", (F.pmod(F.conv(F.substring(digest, 1, 6), 16, 10).cast("bigint"), F.lit(2001)) - 1000) / 1000
    )
    return rounded(text_model.classify_terms(weights, "doc_id", stated, labels), 6, "confidence")


def intent_split(spark: SparkSession, d: str) -> DataFrame:
    split = sampling.split_by_class(data.text_rows(spark, d), "intent_name", "doc_id", INTENT_TEST_SHARE)
    return split.select("doc_id", "intent_name", "split")


def intent_classified(spark: SparkSession, d: str) -> DataFrame:
    return rounded(tested(spark, data.text_rows(spark, d)), 4, "confidence")


def intent_report(spark: SparkSession, d: str) -> DataFrame:
    counts = evaluation.confusion(tested(spark, data.text_rows(spark, d)))
    return rounded(evaluation.class_report(counts), 6, "precision", "recall", "f1")


def quality_report(spark: SparkSession, d: str) -> DataFrame:
    counts = evaluation.confusion(tested(spark, data.quality_rows(spark, d)))
    return rounded(evaluation.class_report(counts), 6, "precision", "recall", "f1")


def intent_drift(spark: SparkSession, d: str) -> DataFrame:
    """Classified test texts in seeded order, in ten batches, against the fixed baseline."""
    scored = tested(spark, data.text_rows(spark, d)).withColumns({
        "correct": (F.col("pred") == F.col("intent_name")).cast("int"), "_order": sampling.seeded_order("doc_id", 7),
    })
    hard = drift.hardest_labels(evaluation.per_class(evaluation.confusion(scored)))
    stats = drift.batch_stats(drift.batch_assign(scored, "_order", "doc_id"), hard)
    return rounded(
        drift.drift_fixed(materialize(stats, "batches")),
        6, "accuracy", "avg_confidence", "hard_intent_share", "baseline",
    )


# --- dashboards ---------------------------------------------------------------


def monitor_kpis(spark: SparkSession, d: str) -> DataFrame:
    return rounded(dashboards.monitor_kpis(*pool_stats(spark, d)), 9, "accuracy")


def accuracy_trend(spark: SparkSession, d: str) -> DataFrame:
    return rounded(dashboards.accuracy_trend(pool_stats(spark, d)[1]), 9, "accuracy", "baseline")


def wrong_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dashboards.wrong_pairs(data.classified(spark, d))


def category_share(spark: SparkSession, d: str) -> DataFrame:
    return rounded(dashboards.category_share(data.classified(spark, d)), 9, "accuracy")


def kpi_document(spark: SparkSession, d: str) -> DataFrame:
    return dashboards.kpi_document(formula_scores(spark, d), *pool_stats(spark, d))


def kpi_values(spark: SparkSession, d: str) -> DataFrame:
    """Every figure of the KPI document."""
    values = dashboards.kpi_values(materialize(kpi_document(spark, d), "kpis"))
    places = F.when(F.col("field") == "value_at_risk", F.round("value", 2)).otherwise(F.round("value", 9))
    return values.withColumn("value", places)


# --- streams ------------------------------------------------------------------


def _run_monitor(rows: DataFrame, batch: DataFrame) -> DataFrame:
    """Run the monitor until the input is used up; all windows judged, the open ones from the same rows as a batch."""
    spark = rows.sparkSession
    table, checkpoint = fresh_path(spark, "windows"), fresh_path(spark, "stream")
    query = monitor.start_monitor(monitor.window_stats(rows, "ts"), table, checkpoint, availableNow=True)
    query.awaitTermination()
    return monitor.judged(spark, table, still_open=monitor.open_windows(batch, table, "ts"))


def stream_events(spark: SparkSession, d: str) -> DataFrame:
    """Daily accuracy of the event stream with running-baseline alerts."""
    stored = data.table(spark, d, "events")
    events = spark.readStream.schema(stored.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    drifted = F.col("ts") >= F.lit(DRIFT_DAY).cast("timestamp_ntz")
    return _run_monitor(data.classified_rows(events, drifted), data.classified_rows(stored, drifted))


def stream_documents(spark: SparkSession, d: str) -> DataFrame:
    """The same from classified documents that arrive as JSON files."""
    rows = data.classified_rows(
        data.table(spark, d, "events"), F.col("ts") >= F.lit(DRIFT_DAY).cast("timestamp_ntz")
    )
    path = fresh_path(spark, "arrivals")
    rows.select("ts", "confidence", "correct").write.json(path)
    schema = rows.select("ts", "confidence", "correct").schema
    return _run_monitor(monitor.read_documents(spark, path, schema), spark.read.schema(schema).json(path))


def _arrivals(spark: SparkSession, d: str) -> tuple[DataFrame, Column]:
    rows = data.classified_rows(data.table(spark, d, "events"), F.col("ts") >= F.lit(DRIFT_DAY).cast("timestamp_ntz"))
    rows = rows.select("event_id", "ts", "confidence", "correct")
    return rows, F.col("ts") < F.lit(SECOND_LOAD).cast("timestamp_ntz")


def stream_baseline(spark: SparkSession, d: str) -> DataFrame:
    """Daily accuracy with the running baseline from keyed state; the stream is stopped after its first files and started again."""
    rows, first = _arrivals(spark, d)
    folder, table, checkpoint = (fresh_path(spark, x) for x in ("arrivals", "windows", "stream"))
    for load in (rows.filter(first), rows.filter(~first)):
        load.write.mode("append").json(folder)
        stats = monitor.window_stats(monitor.read_documents(spark, folder, rows.schema), "ts")
        baseline.start(stats, table, checkpoint, availableNow=True).awaitTermination()
    arrived = spark.read.schema(rows.schema).json(folder)
    closed = baseline.read_sums(spark, table)
    whole = baseline.with_open(closed, monitor.open_windows(arrived, table, "ts"))
    judged = baseline.judged(whole)
    return judged.join(whole.select("window_start", "closed"), "window_start")


def stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows kept and rows too late per day, where a hundredth of the first ten days arrives with the second load."""
    rows, first = _arrivals(spark, d)
    held = (F.col("event_id") % 100 == 3) & (F.col("ts") < F.lit(HELD_BACK).cast("timestamp_ntz"))
    folder, checkpoint = fresh_path(spark, "arrivals"), fresh_path(spark, "stream")
    book = ledger.Ledger(fresh_path(spark, "ledger"), "ts")
    for load in (rows.filter(first & ~held), rows.filter(~first | held)):
        load.write.mode("append").json(folder)
        book.start(monitor.read_documents(spark, folder, rows.schema), checkpoint, availableNow=True).awaitTermination()
    late = book.late(spark).groupBy("window_start").agg(F.count(F.lit(1)).alias("late_rows"))
    return book.windows(spark).join(late, "window_start", "left").na.fill(0, ["late_rows"])


QUERIES: dict[str, Query] = {
    "nq_b1_batch_accuracy": batch_accuracy,
    "nq_b2_intent_precision": intent_precision,
    "nq_b3_confusion_pairs": confusion_pairs,
    "nq_b4_category_accuracy": category_accuracy,
    "nq_b5_handoff_failures": handoff_failures,
    "d_category_lookup": category_lookup,
    "d_shaped_documents": shaped_documents,
    "io_document_roundtrip": document_roundtrip,
    "io_stored_conversations": stored_conversations,
    "io_upserted_documents": upserted_documents,
    "io_utterances_csv": utterances_csv,
    "io_classified_csv": classified_csv,
    "io_batch_stats_csv": batch_stats_csv,
    "d_load_rejects": load_rejects,
    "io_low_confidence": low_confidence,
    "io_misclassified": misclassified,
    "ev_accuracy": accuracy,
    "ev_macro_f1": macro_f1,
    "ev_binary_f1": binary_f1,
    "ev_class_report": class_report,
    "ev_confusion": confusion,
    "ev_confusion_matrix": confusion_matrix,
    "ev_confused_pairs": confused_pairs,
    "ev_reliability": reliability,
    "ev_reliability_values": reliability_values,
    "ev_brier": brier,
    "ev_confidence_auc": confidence_auc,
    "dr_batch_sizes": batch_sizes,
    "dr_hardest_classes": hardest_classes,
    "dr_batch_stats": batch_stats,
    "dr_alert_summary": alert_summary,
    "dr_resampled": resampled,
    "dr_shuffled_batches": shuffled,
    "dr_shuffled_rows": shuffled_rows,
    "dr_shuffled_positions": shuffled_positions,
    "ml_tfidf": tfidf,
    "ml_intent_scored": intent_scored,
    "ml_intent_split": intent_split,
    "ml_intent_classified": intent_classified,
    "ml_intent_report": intent_report,
    "ml_quality_report": quality_report,
    "ml_intent_drift": intent_drift,
    "bi_monitor_kpis": monitor_kpis,
    "bi_accuracy_trend": accuracy_trend,
    "bi_wrong_pairs": wrong_pairs,
    "bi_category_share": category_share,
    "bi_kpi_document": kpi_document,
    "bi_kpi_values": kpi_values,
    "st_event_windows": stream_events,
    "st_document_windows": stream_documents,
    "st_keyed_baseline": stream_baseline,
    "st_late_rows": stream_late_rows,
}
