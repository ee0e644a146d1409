"""The pipeline's stages on small documents, each against its operator's rule."""

import corpus_pipeline
from tests.llm.conftest import prose

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_clean_documents(spark, tmp_path):
    copies = [(i, prose(1, 120)) for i in (1, 2)]
    bench = [(0, prose(500, 40)), (1, prose(501, 60))]
    rows = [
        *copies,
        (3, prose(1, 120).replace("river", "lake", 1)),
        (4, prose(4, 90)),
        (5, prose(500, 40)),  # benchmark text
        (6, prose(6, 400) + " " + " ".join(prose(501, 60).split()[:13])),  # below a twentieth
        (7, prose(7, 30) + " " + prose(99, 60)),
        (8, prose(8, 30) + " " + prose(99, 60) + " " + prose(9, 30)),
        (9, ""),
        *((20 + i, prose(20 + i, 60)) for i in range(40)),
        *((100 + i, "Buy!! " * (40 + i)) for i in range(40)),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(i, int(i < 100), 0) for i, _ in rows]
    for name, df in (
        ("documents", docs),
        ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int")),
        ("benchmark", spark.createDataFrame(bench, "item_id long, text string")),
    ):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier",
        "line_dedup",
        "simhash_near_dedup",
        "benchmark_decontamination",
        "byte_bpe",
    ]
    kept, at = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, at, str(tmp_path))
        if k < 4:
            assert made.columns == docs.columns
        made.write.parquet(f"{tmp_path}/stage-{k}")
        at = spark.read.parquet(f"{tmp_path}/stage-{k}")
        kept[name] = {r.doc_id: r.text for r in at.collect()}
    clean = {4, 6, 7, 8, *range(20, 60)}
    assert not {i for i in kept["quality_classifier"] if i >= 100} and clean <= set(kept["quality_classifier"])
    lined = kept["line_dedup"]
    assert prose(99, 60) in lined[7] and prose(99, 60) not in lined[8] and prose(9, 30) in lined[8]
    assert lined[1] == prose(1, 120) and lined[2] == "" and lined[4] == prose(4, 90)
    near = kept["simhash_near_dedup"]
    assert sum(t == "" for t in near.values()) == 1 and clean <= set(near)
    assert 5 not in kept["benchmark_decontamination"] and clean <= set(kept["benchmark_decontamination"])
    last = at.collect()
    assert {r.doc_id for r in last} == set(kept["benchmark_decontamination"])
    assert all(len(r.ids) == r.n_tokens for r in last)


def test_run_gives_the_last_stage(spark):
    made = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(made.columns)
    assert 100 < made.count() <= 200
