"""The corpus pipeline: each stage's decision on small documents."""

import pytest

import __spark_entry__ as E
import corpus_pipeline as P


def test_stages_are_named_in_order():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup",
                                        "decontamination", "best_fit_packing"]
    assert "pipeline" in E.queries()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    sentence = "river {0} hill {0} wood {0} field {0} stone {0} sky {0} rain {0} wind {0} snow {0} sun {0} moon {0}"
    long = [" ".join(sentence.format(f"{k}x{j}") for j in range(4)) for k in range(8)]
    item = "this benchmark question asks which of the following four answers is the right one here"
    rows = [(1, long[0]), (2, long[1] + "\n" + long[0]), (3, "too short"), (4, None),
            (5, long[2] + " " + item), (6, long[3]), (7, long[3]), (8, long[4] + " " + "again and " * 80),
            (9, long[5].replace("x1", "y1"))]
    docs = spark.createDataFrame([(d, t, "en", f"s{d}", len(t or "")) for d, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root, dict(rows), long


def test_stage_decisions(spark, folder):
    root, texts, long = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        out = f"{root}/{name}"
        stage(spark, docs, root).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    assert set(kept["quality_rules"]) == {1, 2, 5, 6, 7, 9}
    assert set(kept["line_dedup"]) == {1, 2, 5, 6, 9}            # 7 repeats 6
    assert kept["line_dedup"][2].text == long[1] and kept["line_dedup"][2].n_chars == len(long[1])
    assert set(kept["simhash_near_dedup"]) <= {1, 2, 5, 6, 9}
    assert 5 in kept["simhash_near_dedup"] and set(kept["decontamination"]) == set(kept["simhash_near_dedup"]) - {5}
    packed = kept["best_fit_packing"]
    assert set(packed) == set(kept["decontamination"])


def test_whole_run_equals_stages(spark, folder):
    root, _, _ = folder
    rows = P.run(spark, root).collect()
    assert {r.doc_id for r in rows} <= {1, 2, 6, 9} and {1, 6} & {r.doc_id for r in rows}


def test_empty_documents(spark, folder, tmp_path):
    root, _, _ = folder
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{root}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
