"""Plan properties that must hold at scale: no shuffle added to large scans,
partial aggregation before exchanges, correct joins under a hot key."""

from chirpflow.operators import features as FT
from chirpflow.operators import filters as FL
from chirpflow.plans.queries import DEMO_ROUTES, QUERIES
from chirpflow.sources.files import SPREAD_SETTING, read_table
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_only_when_asked_for(spark):
    plain = read_table(spark, SF_SMALL, "documents")
    assert "Exchange" not in _plan(plain)
    spark.conf.set(SPREAD_SETTING, "3")
    try:
        spread = read_table(spark, SF_SMALL, "documents")
    finally:
        spark.conf.unset(SPREAD_SETTING)
    assert spread.rdd.getNumPartitions() == 3
    assert sorted(r.doc_id for r in spread.select("doc_id").collect()) == \
        sorted(r.doc_id for r in plain.select("doc_id").collect())


def test_building_a_query_runs_no_job(spark):
    """Only reads of a schema, and the writes, fits and streams that a query declares."""
    eager = {"json_source", "csv_source", "table_append", "model_roundtrip", "area_under_roc", "index_labels",
             "empty_batch", "score_texts", "tree_accuracy", "random_split", "label_sort", "shuffle_rows",
             "vocabulary_topk", "vocabulary_top_1000", "json_corrupt", "csv_corrupt", "shared_fit", "tree_root_split"}
    tracker = spark.sparkContext.statusTracker()
    for name, query in QUERIES.items():
        if name in eager or name.startswith(("stream_", "nb_pred", "nb_acc", "nb_area", "nb_score", "self_", "lr_", "model_", "whitespace_nb",
                                             "whitespace_lr")):
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        query(spark, SF_SMALL)
        jobs = [j for j in tracker.getJobIdsForGroup(f"build-{name}")]
        tables = 3  # one footer read per table at most
        assert len(jobs) <= tables, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_text_scan_per_feature_query(spark):
    for name in ("idf_weights", "tfidf_terms", "nb_parameters", "nb_priors"):
        df = QUERIES[name](spark, SF_SMALL)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "text:string" in line
                 and "doc_id" in line]
        assert len(scans) <= 1, (name, plan)


def test_vocabulary_has_no_single_merge(spark):
    plan = _plan(FT.vocabulary_topk(FT.term_stats(spark.read.parquet(f"{SF_SMALL}/documents.parquet")), 100))
    assert "TakeOrderedAndProject" not in plan


def test_no_text_is_exchanged_per_token(spark):
    """Routing with keywords too many to broadcast: exchanges below the explode's
    join carry a row's key and a token; texts move once, with their rows."""
    from chirpflow.streaming.jobs import routed_frame
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = routed_frame(docs, FL.routes_frame(spark, DEMO_ROUTES))
        exchanges = []

        def walk(node):
            if node.nodeName() == "Exchange":
                names = [node.output().apply(i).name() for i in range(node.output().size())]
                exchanges.append((node.toString().splitlines()[0], names))
            for i in range(node.children().size()):
                walk(node.children().apply(i))
        walk(df._jdf.queryExecution().executedPlan().initialPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    by_token = [names for text, names in exchanges if "hashpartitioning(_token" in text]
    assert by_token and all(set(names) <= {"_row", "_token", "topic", "phrase", "need"} for names in by_token)
    with_text = [names for _, names in exchanges if {"_kept", "_text", "text"} & set(names)]
    assert len(with_text) == 1


def test_positions_move_no_row_to_one_task(spark):
    from pyspark.sql import functions as F

    from chirpflow.operators.prepare import with_position
    rows = spark.range(5000).select("id", (F.col("id") % 3 == 0).cast("int").alias("k"), F.lit(1).alias("same"))
    for order in (["same"], ["k"], ["k", F.desc("id")]):
        placed = with_position(rows.repartition(7), *order)
        plan = _plan(placed)
        got = placed.collect()
        assert sorted(r.position for r in got) == list(range(1, 5001))
        if "k" in order:
            by_place = sorted(got, key=lambda r: r.position)
            assert [r.k for r in by_place] == sorted(r.k for r in got)
        # the one exchange to a single task is that of the counts per partition
        assert plan.count("SinglePartition") <= 1 and "Window" in plan


def test_equal_keys_are_cut_between_tasks(spark):
    import glob
    import os

    from chirpflow.operators.prepare import with_position
    from chirpflow.session import local_fs_path, scratch_path
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = with_position(spark.range(5000).selectExpr("1 AS same"), "same")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.position for r in placed.collect()) == list(range(1, 5001))
    root = local_fs_path(scratch_path(spark, "positions", unique=False))
    newest = max((os.path.join(root, d) for d in os.listdir(root)), key=os.path.getmtime)
    rows = [spark.read.parquet(f).count() for f in glob.glob(newest + "/*.parquet")]
    assert len(rows) >= 4 and max(rows) < 2500


def test_term_stats_pre_aggregates_before_each_exchange(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = _plan(FT.term_stats(docs))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_count(1)" in plan and "partial_sum(tf" in plan


def test_hot_token_with_and_without_broadcast(spark):
    hot = [(i, "taliban " * 50 + f"word{i}") for i in range(100)]
    cold = [(100 + i, f"afghan refugee number {i}") for i in range(200)]
    df = spark.createDataFrame(hot + cold, "doc_id long, text string")
    routes = FL.routes_frame(spark, DEMO_ROUTES)
    first = {tuple(r) for r in FL.keyword_route(df, routes).collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined_df = FL.keyword_route(df, routes)
        joined = {tuple(r) for r in joined_df.collect()}
        assert "BroadcastHashJoin" not in _plan(joined_df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert first == joined
    assert len([1 for d, t in joined if t == "taliban_tweets"]) == 100


def test_attach_labels_does_not_force_a_broadcast(spark):
    from chirpflow.plans.queries import _labelled
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(_labelled(spark, SF_SMALL))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
