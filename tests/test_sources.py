import json

import pytest
from pyspark.sql import functions as F

from tessera.sources import files, records
from tessera.streaming import ingest


def test_flatten_records_defaults(spark):
    recs = [
        json.dumps({"name": "P1", "publications": [
            {"bib": {"title": "T1", "pub_year": "2020", "author": "A"}, "num_citations": "4"},
            {"bib": {"title": "T2"}},
            {"bib": {"pub_year": "2019"}},
            {"num_citations": "1"},
        ]}),
        json.dumps({"name": "P2", "publications": []}),
        "{not json",
        json.dumps({"name": "P3", "publications": [
            {"bib": {"title": "T3", "pub_year": "2020", "author": "A"}, "num_citations": "4", "error": "timeout"},
            {"error": "timeout"},
        ]}),
    ]
    df = spark.createDataFrame([(r,) for r in recs], "value string")
    out = sorted(tuple(r) for r in records.flatten_records(df).collect())
    assert out == [("P1", "T1", "2020", "A", "4"), ("P1", "T2", "No year", "No authors", "N/A"),
                   ("P3", "No title", "No year", "No authors", "N/A"), ("P3", "T3", "No year", "No authors", "N/A")]


def test_first_match_and_merge(spark):
    papers = spark.createDataFrame([(1, "Deep Nets: a survey"), (2, "Nothing Here"), (3, "Graphs")], "id int, title string")
    cands = spark.createDataFrame(
        [("deep nets", "firsté", 2), ("Deep Nets: other", "second", 1), ("graphs", "g", 5)], "t string, a string, r int"
    )
    fm = {r["id"]: r["abstract"] for r in records.first_match(papers, "title", cands, "t", "a", "r").collect()}
    assert fm == {1: "second", 2: "N/A", 3: "g"}
    lookup = spark.createDataFrame([("Graphs", "old", 1), ("Graphs", "new", 2)], "t string, a string, s int")
    mg = {r["id"]: r["abstract"] for r in records.merge_abstracts(papers, "title", lookup, "t", "a", "s").collect()}
    assert mg == {1: None, 2: None, 3: "new"}


def test_csv_roundtrip_and_resume(spark, tmp_path):
    df = spark.createDataFrame([("Ann", "T, with comma", "2019", "A\nB", "N/A")], files.PAPERS)
    files.write_csv(df, str(tmp_path / "papers"))
    back = files.read_csv(spark, str(tmp_path / "papers"), files.PAPERS).first()
    assert back["Authors"] == "A\nB" and back["Total Citations"] is None
    keys = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    table = str(tmp_path / "done")
    assert files.resume_append(spark, keys.filter("k < 3"), "k", table) == 2
    assert files.resume_append(spark, keys, "k", table) == 1
    assert files.resume_append(spark, keys, "k", table) == 0
    assert sorted(r["k"] for r in spark.read.parquet(table).collect()) == [1, 2, 3]


def test_only_string_abstracts_count(spark):
    recs = spark.createDataFrame([(json.dumps({"name": "P", "publications": [{"bib": {"title": t}} for t in "abcd"]}),)], "value string")
    found = [("a", {"data": [{"abstract": 123}]}), ("b", {"data": [{"abstract": {"x": 1}}]}), ("c", {"data": [{"abstract": None}, {"abstract": "second"}]}), ("d", {"data": [{"abstract": "yes"}]})]
    lookups = spark.createDataFrame([(t, json.dumps(r), 1) for t, r in found], "title string, response string, seq int")
    out = {r["title"]: r["abstract"] for r in records.build_snapshot(recs, "value", lookups).collect()}
    assert out == {"a": "N/A", "b": "N/A", "c": "N/A", "d": "yes"}


def test_ties_of_rank_and_order_are_settled(spark):
    papers = spark.createDataFrame([(1, "t")], "id int, title string")
    cands = spark.createDataFrame([("t", "b", 1), ("t", "a", 1)], "t string, a string, r int")
    assert records.first_match(papers, "title", cands, "t", "a", "r").first()["abstract"] == "a"
    assert records.merge_abstracts(papers, "title", cands, "t", "a", "r").first()["abstract"] == "b"


def test_csv_missing_markers(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Name\nNA\nnan\nNULL\nNone\n\"\"\nAnn\nN/A\n")
    assert [r["Name"] for r in files.read_csv(spark, str(tmp_path / "f.csv"), files.FACULTY).collect() if r["Name"]] == ["Ann"]


def test_append_removes_repeats_and_reports_a_failed_read(spark, tmp_path):
    import pytest

    table = str(tmp_path / "t")
    assert files.resume_append(spark, spark.createDataFrame([(9,), (9,)], "k int"), "k", table) == 1
    other = str(tmp_path / "other")
    spark.createDataFrame([(1,)], "unlike int").write.parquet(other)
    with pytest.raises(Exception):
        files.resume_append(spark, spark.createDataFrame([(1,)], "k int"), "k", other)
    assert spark.read.parquet(other).count() == 1


def test_stream_ingest_is_idempotent(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    rec = {"name": "P", "publications": [{"bib": {"title": "T"}}]}
    (land / "a.json").write_text(json.dumps(rec) + "\n")
    out, ck = str(tmp_path / "pubs"), str(tmp_path / "ck")
    ingest.start(spark, str(land), out, ck).awaitTermination()
    (land / "b.json").write_text(json.dumps(rec) + "\n" + json.dumps({"name": "Q", "publications": [{"bib": {"title": "U"}}]}) + "\n")
    ingest.start(spark, str(land), out, ck).awaitTermination()
    rows = sorted((r["professor"], r["title"]) for r in spark.read.parquet(out).collect())
    assert rows == [("P", "T"), ("Q", "U")]


def test_build_snapshot_end_to_end(spark):
    recs = spark.createDataFrame(
        [(json.dumps({"name": "P", "publications": [{"bib": {"title": "Alpha: x"}}, {"bib": {"title": "Beta"}}]}),)], "value string"
    )
    lookups = spark.createDataFrame(
        [
            ("Alpha: x", json.dumps({"data": [{"title": "alpha", "abstract": "firsté one"}, {"title": "alpha", "abstract": "second"}]}), 1),
            ("Alpha: x", json.dumps({"data": [{"title": "alpha", "abstract": "newer"}]}), 2),
            ("Beta", json.dumps({"data": []}), 1),
        ],
        "title string, response string, seq int",
    )
    out = {r["title"]: r["abstract"] for r in records.build_snapshot(recs, "value", lookups).collect()}
    assert out == {"Alpha: x": "newer", "Beta": "N/A"}


def test_snapshot_partition_pruning(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3, f"t{i}") for i in range(30)], "id long, level_1 int, text string")
    path = str(tmp_path / "snap")
    files.write_snapshot(df, path, ["level_1"])
    back = files.read_snapshot(spark, path).filter(F.col("level_1") == 2)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(level_1" in plan and back.count() == 10


def test_encoder_plugin_batches(spark):
    from tessera.operators import embed

    calls = []

    def make():
        def enc(texts):
            calls.append(len(texts))
            return [[float(len(t)), 1.0] for t in texts]

        return enc

    df = spark.createDataFrame([(i, "x" * i) for i in range(10)] + [(10, None)], "id long, text string")
    out = {r["id"]: r["vec"] for r in embed.encode_with(df, "id", "text", make, 2, prefix="Query: ", batch_rows=4).collect()}
    assert out[3] == [10.0, 1.0] and out[10] == [7.0, 1.0]


@pytest.fixture
def documents(spark, tmp_path):
    rows = [(i, f"src{i % 2}", "en" if i % 4 else None, f"text {i} é", 7) for i in range(1, 127)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_registered_records_hold_whole_and_faulty_ones(spark, documents):
    from tessera.plans import catalog

    out = [tuple(r) for r in catalog.REGISTRY["flatten_records"](spark, documents).collect()]
    assert {r[1] for r in out} >= {f"text {i} é" for i in range(1, 127)}  # every whole text
    parsed = [i for i in range(1, 127) if i % 9]
    assert sum(r[1] == "No title" for r in out) == sum(i % 7 == 0 and i % 3 == 0 for i in parsed)
    assert sum(r[2] == "No year" for r in out) == sum(i % 3 == 0 or (i % 7 != 0 and i % 5 == 0) for i in parsed)
    assert not any("text 9 é" in r[1] for r in out if r[1] != "text 9 é")  # cut off: does not parse
    assert len(out) == 126 + sum(i % 3 == 0 or i % 7 != 0 for i in parsed)


def test_registered_snapshot_meets_its_lookups(spark, documents):
    from tessera.plans import catalog

    out = {r["title"]: r["abstract"] for r in catalog.REGISTRY["build_snapshot"](spark, documents).collect()}
    assert out["text 4 é"] == "text 4 " and out["src0: text 4 é"] == "N/A"  # a number is no abstract
    assert out["src1: text 1 é"] == "text 1 " and out["No title"] == "N/A"


def test_registered_csv_holds_missing_markers(spark, documents):
    from tessera.plans import catalog

    out = {r["doc_id"]: (r["text"], r["marked"]) for r in catalog.REGISTRY["csv_round_trip"](spark, documents).collect()}
    assert out == {i: (f"text {i} é", None if i % 7 == 0 else f"text {i} é") for i in range(1, 127)}
