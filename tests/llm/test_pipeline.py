"""The pipeline's stages, one by one and together."""

import zlib

import corpus_pipeline
from quipu.llm import langid, packing

import brute

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
PROSE = [
    "the river ran past the old mill and the children walked along its bank in the morning sun",
    "a small town on the hill had one baker who rose before dawn to light the great oven again",
    "when winter came the road was closed and letters took many weeks to reach the other valley",
    "he wrote of ships and storms though he had never once in his long life been near the sea",
]


def tables(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


def test_stages_act_in_order(spark, tmp_path):
    texts = PROSE + [PROSE[0], f"before {ITEM} after", "12 34 !!", None, "", f"{PROSE[1]} password=abcdefgh1 {PROSE[2]}"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = tables(spark, tmp_path, rows)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    left = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert made.columns == docs.columns and made.dtypes == docs.dtypes
        made.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        left.append(sorted(r.doc_id for r in docs.collect()))
    assert left[0] == [0, 1, 2, 3, 4, 5, 9]  # without letters, text or both
    assert left[1] == [0, 1, 2, 3, 5, 9]  # a copy
    assert left[2] == left[3] == [0, 1, 2, 3, 9]  # a benchmark item
    redacted = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/stage3").collect()}
    clean = f"{PROSE[1]} [SECRET] {PROSE[2]}"
    assert redacted[9].text == clean and redacted[9].n_chars == len(clean)
    assert all(redacted[i].text == PROSE[i] for i in range(4))
    from quipu.llm.tokens import encoder

    ids = {i: [*encoder()([r.text])[0].tolist(), 0] for i, r in redacted.items()}
    brute.check_packing(docs.collect(), ids)
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in again.collect()) == sorted(r.doc_id for r in docs.collect())


def test_pipeline_of_no_documents(spark, tmp_path):
    tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_held_out_rows_are_not_learned_from(spark, tmp_path):
    rows = [(i, PROSE[i % 4], "en" if zlib.crc32(str(i).encode()) % 4 != 2 else "odd", "s", 1) for i in range(40)]
    docs = tables(spark, tmp_path, rows)
    got = langid.predictions(docs).collect()
    assert {r.lang_pred for r in got} == {"en"}
    assert {r.doc_id for r in got if r.held_out} == {r[0] for r in rows if r[2] == "odd"}
    assert packing.SEQUENCE == 1024
