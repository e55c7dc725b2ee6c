"""Log features, scores, clusters and sequences over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from logharbor.operators import clusters, features, models, patterns
from logharbor.plans.fixtures import AS_OF, table, view, with_views
from logharbor.plans.registry import query
from logharbor.session import cut_lineage, scratch_dir

COLUMNS = list(features.FEATURES)
RECORD = ["level", "source", "type", "message"]

FEATURE_SQL = """features as (
  select event_id, ts, hour(ts)::double as hour, (isodow(ts) - 1)::double as day_of_week,
    (isodow(ts) >= 6)::int::double as is_weekend, (hour(ts) between 9 and 17)::int::double as is_business_hours,
    length(message)::double as message_length, len(string_split_regex(message, '\\s+'))::double as word_count,
    length(cast(to_json({'level': level, 'source': component, 'type': type, 'message': message}) as varchar))::double as log_size,
    (level = 'ERROR')::int::double as has_error_level, (level = 'WARNING')::int::double as has_warning_level,
    case level when 'ERROR' then 3.0 when 'WARNING' then 2.0 when 'INFO' then 1.0 else 0.0 end::double as level_score,
    length(component)::double as source_length, length(type)::double as type_length
  from applog)"""

SCALED_SQL = "scaled as (select event_id, ts, {} from features)".format(
    ", ".join(
        f"({c} - avg({c}) over ()) / case when stddev_pop({c}) over () > 0 then stddev_pop({c}) over () else 1.0::double end as {c}"
        for c in COLUMNS
    )
)
SCORE_SQL = "1.0::double - exp(-({}) / {}::double / 2.0::double)".format(
    " + ".join(f"{c} * {c}" for c in COLUMNS), float(len(COLUMNS))
)


def logs(spark, sf_dir):
    return view(spark, sf_dir, "applog").withColumnRenamed("component", "source")


def feature_rows(spark, sf_dir):
    return features.extract_features(
        logs(spark, sf_dir), features.default_extractors(AS_OF, RECORD), ["event_id", "ts"]
    )


def scaled_rows(spark, sf_dir):
    rows = feature_rows(spark, sf_dir)
    return features.scale(rows, COLUMNS, features.scaler_state(rows, COLUMNS))


@query("features", with_views("applog", f"with {FEATURE_SQL} select * from features"))
def _(spark, sf_dir):
    return feature_rows(spark, sf_dir)


@query(
    "embedding_stats",
    """select vec_id, round(list_avg(embedding::double[]), 6) as text_embedding_mean,
  round(list_stddev_pop(embedding::double[]), 6) as text_embedding_std from embeddings""",
)
def _(spark, sf_dir):
    stats = features.embedding_features(F.col("embedding").cast("array<double>"))
    return table(spark, sf_dir, "embeddings").select("vec_id", *[F.round(c, 6).alias(n) for n, c in stats.items()])


@query(
    "scaled_features",
    with_views(
        "applog",
        f"with {FEATURE_SQL}, {SCALED_SQL} select event_id, {', '.join(f'round({c}, 6) as {c}' for c in COLUMNS)} from scaled",
    ),
)
def _(spark, sf_dir):
    return scaled_rows(spark, sf_dir).select("event_id", *[F.round(c, 6).alias(c) for c in COLUMNS])


@query(
    "scaler_refresh",
    with_views(
        "applog",
        f"with {FEATURE_SQL} "
        + " union all ".join(
            f"select '{c}' as feature, count(*) as n, round(avg({c}), 6) as mean, round(stddev_pop({c}), 6) as deviation from features"
            for c in COLUMNS
        ),
    ),
)
def _(spark, sf_dir):
    """State of the first half of the month merged with that of the second."""
    rows = feature_rows(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    merged = features.merge_states(
        features.scaler_state(rows.where(early), COLUMNS), features.scaler_state(rows.where(~early), COLUMNS)
    )
    deviation = F.round(F.sqrt(F.col("squares") / F.col("n")), 6).alias("deviation")
    return merged.select("feature", "n", F.round("mean", 6).alias("mean"), deviation)


@query(
    "anomaly_flags",
    with_views(
        "applog",
        f"""with {FEATURE_SQL}, {SCALED_SQL}
select event_id, round({SCORE_SQL}, 6) as anomaly_score, {SCORE_SQL} > 0.6 as is_anomaly from scaled""",
    ),
)
def _(spark, sf_dir):
    flagged = features.flag_anomalies(scaled_rows(spark, sf_dir), COLUMNS, threshold=0.6)
    return flagged.select("event_id", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly")


_PAIRS = [(a, b) for a in COLUMNS for b in COLUMNS if a < b]


@query(
    "feature_correlations",
    with_views(
        "applog",
        f"with {FEATURE_SQL}, pairs as ("
        + " union all ".join(
            f"select '{a}_{b}' as pair, case when stddev_pop({a}) > 0 and stddev_pop({b}) > 0 then corr({a}, {b}) end as c from features"
            for a, b in _PAIRS
        )
        + ") select pair, round(c, 6) as correlation from pairs where abs(c) > 0.3",
    ),
)
def _(spark, sf_dir):
    found = features.strong_correlations(feature_rows(spark, sf_dir), COLUMNS, limit=0.3)
    return found.withColumn("correlation", F.round("correlation", 6))


# Features without the time and the message: few enough values for rows to be equal.
CLUSTER_COLUMNS = ["hour", "is_weekend", "word_count", "log_size", "level_score", "source_length", "type_length"]


@query(
    "log_clusters",
    with_views(
        "applog",
        f"""with {FEATURE_SQL},
sizes as (select {', '.join(CLUSTER_COLUMNS)}, count(*) as size, min((ts, event_id)) as first_row from features group by all having count(*) >= 5),
labels as (select *, row_number() over (order by first_row) - 1 as label from sizes)
select event_id, coalesce(label, -1) as cluster from features left join labels using ({', '.join(CLUSTER_COLUMNS)})""",
    ),
)
def _(spark, sf_dir):
    rows = feature_rows(spark, sf_dir).select("event_id", "ts", *CLUSTER_COLUMNS)
    return patterns.label_clusters(rows, CLUSTER_COLUMNS, "ts", "event_id").select("event_id", "cluster")


def _density_sql(radius: float, least: int) -> str:
    """Clusters by definition: core points by counting all pairs, and the least core point that each can be reached from."""
    return f"""with recursive points as (
  select event_id, cast(ts as timestamp) as ts, value / 10.0::double as a, (hour(cast(ts as timestamp)) + minute(cast(ts as timestamp)) / 60.0::double) as b from events),
near as (select p.event_id as p, q.event_id as q from points p join points q
  on (p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) <= {radius}::double * {radius}::double),
core as (select p from near group by p having count(*) >= {least}),
edges as (select p, q from near where p in (select p from core) and q in (select p from core)),
walk as (select p as node, p as seen from core union select q, seen from walk join edges on node = p),
roots as (select node, min(seen) as root from walk group by node),
firsts as (select root, min((ts, event_id)) as first from roots join points on event_id = node group by root),
numbered as (select root, row_number() over (order by first) - 1 as cluster from firsts),
labels as (select node as event_id, cluster from roots join numbered using (root)),
edged as (select p as event_id, min(cluster) as cluster from near join labels on q = labels.event_id group by p)
select event_id, coalesce(labels.cluster, edged.cluster, -1) as cluster
from points left join labels using (event_id) left join edged using (event_id)"""


@query("density_clusters", _density_sql(0.15, 6))
def _(spark, sf_dir):
    """Density clusters of two fractional features."""
    ts = F.col("ts").cast("timestamp")
    rows = table(spark, sf_dir, "events").select(
        "event_id", ts.alias("ts"), (F.col("value") / F.lit(10.0)).alias("a"), (F.hour(ts) + F.minute(ts) / F.lit(60.0)).alias("b")
    )
    return clusters.density_clusters(rows, ["a", "b"], "ts", "event_id", radius=0.15, min_size=6).select("event_id", "cluster")


@query(
    "log_cluster_table",
    with_views(
        "applog",
        f"""with {FEATURE_SQL},
sizes as (select {', '.join(CLUSTER_COLUMNS)}, count(*) as size, min((ts, event_id)) as first_row from features group by all having count(*) >= 5)
select {', '.join(CLUSTER_COLUMNS)}, size, row_number() over (order by first_row) - 1 as cluster from sizes""",
    ),
)
def _(spark, sf_dir):
    rows = feature_rows(spark, sf_dir).select("event_id", "ts", *CLUSTER_COLUMNS)
    return patterns.cluster_table(rows, CLUSTER_COLUMNS, "ts", "event_id")


# ---- sequences -----------------------------------------------------------------------------------

SEQ_SQL = """items as (
  select event_id, user_id, cast(ts as timestamp) as ts, case when event_type in ('error', 'signup') then 'bad' else 'good' end as item,
    row_number() over (partition by user_id order by ts, event_id) - 1 as idx from events),
hashed as (
  select *, case when lead(event_id, 4) over w is not null then
    md5(concat_ws(chr(31), item, lead(item, 1) over w, lead(item, 2) over w, lead(item, 3) over w, lead(item, 4) over w)) end as pattern
  from items window w as (partition by user_id order by idx)),
counted as (select *, row_number() over (partition by user_id, pattern order by idx) as frequency from hashed where pattern is not null),
found as (select * from counted where frequency > 3)"""


def item_rows(spark, sf_dir):
    bad = F.col("event_type").isin("error", "signup")
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.when(bad, "bad").otherwise("good").alias("item")
    )


def sequences(spark, sf_dir):
    rows = item_rows(spark, sf_dir)
    return patterns.repeat_sequences(rows, ["user_id"], ["ts", "event_id"], F.col("item"), repeats=3)


@query(
    "repeat_sequences",
    f"with {SEQ_SQL} select user_id, event_id, idx as start_idx, 5 as length, frequency from found",
)
def _(spark, sf_dir):
    return sequences(spark, sf_dir).select("user_id", "event_id", "start_idx", "length", "frequency")


@query(
    "frequent_patterns",
    f"""with {SEQ_SQL}
select pattern, count(*) as frequency, count(*) > 100 as significant from hashed where pattern is not null
group by 1 order by frequency desc, pattern limit 10""",
)
def _(spark, sf_dir):
    hashed = patterns.sequence_hashes(item_rows(spark, sf_dir), ["user_id"], ["ts", "event_id"], F.col("item"))
    return patterns.frequent_patterns(hashed)


@query(
    "heavy_patterns",
    f"""with {SEQ_SQL}, counts as (select pattern, count(*) as frequency from hashed where pattern is not null group by 1)
select pattern, frequency, true as within from counts where frequency >= 0.02 * (select sum(frequency) from counts)""",
)
def _(spark, sf_dir):
    """Patterns of two hundredths of all rows or more, from summaries of 40 counters a task; the bounds are checked."""
    path = scratch_dir(spark, "heavy_patterns")
    hashed = cut_lineage(patterns.sequence_hashes(item_rows(spark, sf_dir), ["user_id"], ["ts", "event_id"], F.col("item")))
    patterns.pattern_summary(hashed, counters=40).write.parquet(path)
    heavy = patterns.heavy_patterns(spark.read.parquet(path), share=0.02)
    counts = hashed.where("pattern is not null").groupBy("pattern").agg(F.count("*").alias("frequency"))
    total = counts.agg(F.sum("frequency").alias("n")).select("n").scalar()
    within = F.coalesce(F.col("frequency").between(F.col("at_least"), F.col("at_most")), F.lit(False))
    return counts.where(F.col("frequency") >= 0.02 * total).join(heavy, "pattern", "left").select("pattern", "frequency", within.alias("within"))


ATTACH_SQL = """attached as (
  select i.event_id, i.user_id, i.ts, i.idx, arg_min(f.idx, f.idx) as sequence_id, arg_min(f.frequency, f.idx) as frequency
  from items i left join found f on f.user_id = i.user_id and f.idx between i.idx - 4 and i.idx group by all)"""


def attached(spark, sf_dir):
    rows = item_rows(spark, sf_dir)
    numbered = patterns.numbered_sequences(rows, ["user_id"], ["ts", "event_id"], F.col("item"))
    return patterns.attach_sequences(numbered, ["user_id"], repeats=3)


@query(
    "sequence_attach",
    f"with {SEQ_SQL}, {ATTACH_SQL} select event_id, user_id, idx, sequence_id, frequency from attached",
)
def _(spark, sf_dir):
    return attached(spark, sf_dir).select("event_id", "user_id", "idx", "sequence_id", "frequency")


ENRICHED_SQL = f"""{SEQ_SQL}, {ATTACH_SQL}, {FEATURE_SQL}, {SCALED_SQL},
scored as (select event_id, round({SCORE_SQL}, 6) as score from scaled),
enriched as (
  select a.event_id, a.ts, coalesce(case when e.event_type <> 'view' then round(e.value / 500.0::double, 6) end, 0.5::double) as priority,
    s.score > 0.6 as is_anomaly, s.score as anomaly_score, a.sequence_id, a.frequency
  from attached a join events e using (event_id) join scored s using (event_id))"""


def enriched(spark, sf_dir):
    """Rows with a priority from their value (absent for views), the anomaly score and the sequence."""
    kept = ["event_id", "ts", "user_id", "type", "value"]
    rows = features.extract_features(logs(spark, sf_dir), features.default_extractors(AS_OF, RECORD), kept)
    flagged = features.flag_anomalies(features.scale(rows, COLUMNS, features.scaler_state(rows, COLUMNS)), COLUMNS, threshold=0.6)
    kind = F.col("type")
    rows = flagged.select(
        *kept[:3],
        F.when(kind.isin("error", "signup"), "bad").otherwise("good").alias("item"),
        F.round("anomaly_score", 6).alias("anomaly_score"),
        "is_anomaly",
        F.when(kind != "view", F.round(F.col("value") / F.lit(500.0), 6)).alias("priority_score"),
    )
    numbered = patterns.numbered_sequences(rows, ["user_id"], ["ts", "event_id"], F.col("item"))
    return patterns.enrich(patterns.attach_sequences(numbered, ["user_id"], repeats=3))


@query(
    "enriched_logs",
    with_views("applog", f"with {ENRICHED_SQL} select event_id, priority, is_anomaly, anomaly_score, sequence_id, frequency from enriched"),
)
def _(spark, sf_dir):
    return enriched(spark, sf_dir).select(
        "event_id",
        "priority",
        "is_anomaly",
        F.col("ml_insights.anomaly_score").alias("anomaly_score"),
        F.col("ml_insights.pattern_info.sequence_id").alias("sequence_id"),
        F.col("ml_insights.pattern_info.frequency").alias("frequency"),
    )


@query(
    "triage",
    with_views(
        "applog",
        f"""with {ENRICHED_SQL}
select event_id, case when is_anomaly then 'critical' when priority > 0.8 then 'high' else 'normal' end as processing_priority,
  is_anomaly as requires_review, not is_anomaly and priority > 0.8 as requires_attention from enriched""",
    ),
)
def _(spark, sf_dir):
    return patterns.triage(enriched(spark, sf_dir)).select(
        "event_id", "processing_priority", "requires_review", "requires_attention"
    )


@query(
    "priority_order",
    with_views(
        "applog",
        f"with {ENRICHED_SQL} select event_id, priority, is_anomaly, coalesce(frequency, 0) as frequency from enriched",
    ),
)
def _(spark, sf_dir):
    ordered = patterns.priority_order(enriched(spark, sf_dir), ["ts", "event_id"])
    return ordered.select("event_id", "priority", "is_anomaly", F.coalesce("frequency", F.lit(0)).alias("frequency"))


# ---- models --------------------------------------------------------------------------------------

DOC_COLUMNS = ["n_chars", "words", "lines", "digits"]


def document_features(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.trim(text), r"\s+")).cast("double").alias("words"),
        F.size(F.split(text, "\n")).cast("double").alias("lines"),
        F.regexp_count(text, F.lit(r"\d")).cast("double").alias("digits"),
    )


class LongFirst:
    """Longer documents first, up to a thousand characters."""

    def predict(self, features):
        return (features["n_chars"] / 1000.0).clip(upper=1.0)


def labelled_documents(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return document_features(spark, sf_dir).join(labels, "doc_id")


@query("priority_score")
def _(spark, sf_dir):
    model = models.fit_priority_model(labelled_documents(spark, sf_dir), DOC_COLUMNS)
    scored = models.score_priority(document_features(spark, sf_dir), model)
    return scored.select("doc_id", F.round("priority_score", 6).alias("priority_score"))


@query(
    "priority_score_own_model",
    "select doc_id, round(least(n_chars / 1000.0::double, 1.0::double), 6) as priority_score from documents",
)
def _(spark, sf_dir):
    """A model of the user's own: any object with `predict` over a table of the features."""
    scored = models.score_with(document_features(spark, sf_dir), DOC_COLUMNS, LongFirst())
    return scored.select("doc_id", F.round("priority_score", 6).alias("priority_score"))


@query("priority_score_default", "select doc_id, 1.0::double as priority_score from documents")
def _(spark, sf_dir):
    return models.score_priority(document_features(spark, sf_dir)).select("doc_id", "priority_score")


@query(
    "priority_score_facts",
    "select count(*) as documents, true as in_range, true as ranks_labels from documents",
)
def _(spark, sf_dir):
    """What holds for any solver: a score in [0, 1] per document, and good documents ahead of bad ones."""
    model = models.fit_priority_model(labelled_documents(spark, sf_dir), DOC_COLUMNS)
    scored = models.score_priority(document_features(spark, sf_dir), model)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = scored.join(labels, "doc_id", "left")
    mean = {q: F.avg(F.when(F.col("quality") == q, F.col("priority_score"))) for q in (0, 1)}
    return joined.agg(
        F.count("*").alias("documents"),
        F.bool_and(F.col("priority_score").between(0, 1)).alias("in_range"),
        (mean[1] > mean[0]).alias("ranks_labels"),
    )


@query(
    "model_refresh_facts",
    "select unnest(['digits', 'lines', 'n_chars', 'words']) as feature, true as finite, 1 as weights",
)
def _(spark, sf_dir):
    """A refreshed model has one finite weight for each feature."""
    rows = labelled_documents(spark, sf_dir)
    weights = models.model_weights(rows, models.refresh_model(rows, DOC_COLUMNS, min_rows=50), DOC_COLUMNS)
    return weights.groupBy("feature").agg(
        F.bool_and(F.abs("weight") < float("inf")).alias("finite"), F.count("*").cast("int").alias("weights")
    )


@query("model_refresh")
def _(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    model = models.refresh_model(rows, DOC_COLUMNS, min_rows=50)
    return models.model_weights(rows, model, DOC_COLUMNS)
