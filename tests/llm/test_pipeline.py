import random

import corpus_pipeline



def test_stages_on_a_small_corpus(spark, docs_of, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(60)) for _ in range(120)]
    for i in range(0, 120, 3):
        words = texts[i].split()
        for _ in range(8):
            words[rng.randrange(60)] = "grumf" + rng.choice("abcdef")
        texts[i] = " ".join(words)
    copies = [texts[1] + " ", texts[1], texts[2].replace(" ", "\n")]
    near = [" ".join(texts[4].split()[:-1] + ["other"]), texts[5] + " more"]
    docs = docs_of(texts + copies + near + [None, ""])
    sf_dir = str(tmp_path)
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(120)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, out, sf_dir)
        got.write.parquet(f"{sf_dir}/out{i}")
        out = spark.read.parquet(f"{sf_dir}/out{i}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        kept.append({r["doc_id"] for r in out.select("doc_id").distinct().collect()})
    toxic = set(range(0, 120, 3))
    assert kept[0] == set(range(127)) - toxic
    # of equal texts the longest, then the least id; empty texts are equal
    assert kept[1] == kept[0] - {1, 121, 122, 126}
    assert 120 in kept[1]
    assert kept[2] == kept[1] - {123, 124}
    assert kept[3] == kept[2]
    run = corpus_pipeline.run(spark, sf_dir)
    assert run.count() == spark.read.parquet(f"{sf_dir}/out3").count()


def test_repeated_ids_clashing_columns_and_an_empty_table(spark, docs_of, tmp_path):
    same = "one text that comes twice in a row here"
    rows = [(1, same), (1, same), (1, "another text under the same number " * 3), (2, same + " "), (None, "no number"),
            (3, None), (4, "")]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, docs in (("some", docs_of(rows, clash=True)), ("none", docs_of([]))):
        sf_dir = str(tmp_path / name)
        labels.write.parquet(f"{sf_dir}/labels.parquet")
        docs.write.parquet(f"{sf_dir}/documents.parquet")
        out = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
            stage(spark, out, sf_dir).write.parquet(f"{sf_dir}/out{i}")
            out = spark.read.parquet(f"{sf_dir}/out{i}")
            assert out.columns == docs.columns
        kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect())
        # of the equal texts the longer one stays, of the empty ones the one with the least id
        assert kept == ([] if name == "none" else [(0, "no number"), (1, rows[2][1]), (2, same + " "), (3, "")])
        packed = corpus_pipeline.STAGES[3][1](spark, out, sf_dir).collect()
        assert len({r["doc_id"] for r in packed}) == len(kept)
