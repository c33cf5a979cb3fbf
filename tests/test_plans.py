from tessera.plans import catalog

SMALL = "/root/testdata/sf0.001"
# queries whose core work is meant to run outside the JVM (Arrow kernels)
PYTHON_OK = {
    "language_id", "keep_english", "clean_pipeline", "clean_audit", "pairwise_similarity", "knn_graph",
    "assign_nearest", "silhouette", "silhouette_sq", "hashed_embedding", "context_embedding", "index_table",
    "retrieve_batch", "retrieve_pruned", "three_level", "k_sweep", "sweep_scores", "spectral_sweep",
}
PY_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "FlatMapCoGroupsInPandas", "FlatMapGroupsInPandas", "FlatMapCoGroupsInArrow")


def test_no_cross_joins_and_python_only_where_meant(spark, monkeypatch):
    from tessera.operators import agglomerate, spectral

    # fewer rows and clusters, the same plans
    tree = agglomerate.ward(catalog._emb(spark, SMALL).limit(30), "vec_id", "embedding")
    monkeypatch.setattr(catalog, "merge_tree", lambda s, sf: tree)
    short = {
        "spectral_sweep": lambda s, sf: spectral.spectral_sweep(catalog._emb(s, sf).limit(60), "vec_id", "embedding", range(2, 4))[1],
        "three_level_spectral": lambda s, sf: spectral.three_level_spectral(catalog._emb(s, sf).limit(60), "vec_id", "embedding", (3, 2, 2)),
    }
    for key, fn in (catalog.REGISTRY | short).items():
        plan = fn(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key
        if key not in PYTHON_OK:
            assert not any(p in plan for p in PY_NODES), key
        assert "BatchEvalPython" not in plan, key  # never row-at-a-time Python UDFs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_encoders_do_not_shuffle(spark):
    for key in ("hashed_embedding", "context_embedding"):
        assert "Exchange" not in _plan(catalog.REGISTRY[key](spark, SMALL)), key


def test_language_is_one_pass_over_the_rows(spark):
    plan = _plan(catalog.REGISTRY["keep_english"](spark, SMALL))
    assert "Exchange" not in plan and plan.count("FileScan parquet") == 1


def test_retrieval_reads_the_stored_index_only(spark):
    for key in ("retrieve_two_stage", "retrieve_fine"):
        plan = _plan(catalog.REGISTRY[key](spark, SMALL))
        assert "documents.parquet" not in plan and "tessera-ind" in plan, key
    plan = _plan(catalog.REGISTRY["retrieve_batch"](spark, SMALL))
    assert "documents.parquet" not in plan and plan.count("tessera-ind") == 2


def test_rewritten_documents_get_a_new_index(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")

    def indexed():
        return {r.doc_id for r in catalog.stored_index(spark, str(tmp_path))[0].select("doc_id").collect()}

    for wanted in ("doc_id < 20", "doc_id BETWEEN 10 AND 40"):
        part = docs.where(wanted)
        part.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        assert indexed() == {r.doc_id for r in part.collect()}
    files = catalog.stored_index(spark, str(tmp_path))[0].inputFiles()
    assert catalog.stored_index(spark, str(tmp_path))[0].inputFiles() == files  # unchanged files: no new index
