"""The pipeline's stages on a small corpus with planted cases."""

import random

import corpus_pipeline


def test_stages(spark, tmp_path):
    rnd = random.Random(4)
    # letters make words of many kinds, so that unlike texts are unlike to SimHash too
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 7)))
    clean = [" ".join(word() for _ in range(150)) for _ in range(260)]
    item = " ".join(word() for _ in range(30))
    docs = [(k, t, "en", "s", len(t)) for k, t in enumerate(clean)]
    docs += [(1000 + k, clean[k] + " and more", "en", "s", len(clean[k]) + 9) for k in range(5)]  # near copies
    toxic = [" ".join(rnd.sample([*t.split()[:80], "vile", "nasty"], 82)) for t in clean[100:160]]
    docs += [(2000 + k, t, "en", "s", len(t)) for k, t in enumerate(toxic)]
    docs += [(3000, clean[200][:300] + " " + item + " " + clean[201][:300], "en", "s", 800), (3001, None, None, None, None), (3002, "", "en", "s", 0)]
    passage = " ".join(word() for _ in range(120))
    docs += [(4000 + k, f"{clean[210 + k][:500]} {passage} {clean[220 + k][:500]}", "en", "s", 1500) for k in range(2)]
    labels = [(k, 1, 0) for k in range(200)] + [(2000 + k, 1, 1) for k in range(50)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = [now.columns]
    kept = []
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r["doc_id"]: r for r in now.collect()})
        if k < 4:
            assert now.columns == seen[0]
    assert sum(2000 + k in kept[0] for k in range(60)) <= 3 and sum(k in kept[0] for k in range(260)) >= 250
    copies = [k for k in range(5) if k in kept[0] and 1000 + k in kept[0]]
    assert all((k in kept[1]) and (1000 + k not in kept[1]) for k in copies)
    assert all(passage[200:600] not in kept[2][4000 + k]["text"] for k in range(2))
    assert 3000 not in kept[3] and len(kept[3]) == len(kept[2]) - 1
    assert set(kept[4]) == set(kept[3])
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == len(kept[4])


def test_short_passages_go(spark, tmp_path):
    """51 short words that repeat are under 400 bytes and go; 50 stay."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 7)))
    passage, less = (" ".join(word() for _ in range(n)) for n in (51, 50))
    assert len(passage) < 400
    rows = [(k, " ".join([*(word() for _ in range(60)), passage if k < 3 else less, *(word() for _ in range(60))])) for k in range(6)]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.suffix_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()}
    assert all(got[k] == rows[k][1].replace(passage, "") for k in range(3))
    assert all(got[k] == rows[k][1] for k in range(3, 6))


def test_leaking_rows_without_an_id_go(spark, tmp_path):
    rnd = random.Random(5)
    item, other = (" ".join("".join(rnd.choices("abcdefghijklmnop", k=5)) for _ in range(40)) for _ in range(2))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(None, item), (None, other), (None, None), (7, item), (8, other)], "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(None, other), (None, None), (8, other)], key=str)


def test_clashing_names_and_repeated_ids_pass_all_stages(spark, tmp_path):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 7)))
    texts = [" ".join(word() for _ in range(80)) for _ in range(12)]
    names = ["score", "kept", "rid", "ranges", "n_bytes", "row", "row_0", "id", "group"]
    rows = [(k % 10, t, *[f"{n}{k}" for n in names]) for k, t in enumerate(texts)]  # ids 0 and 1 stand on two texts each
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, step) in enumerate(corpus_pipeline.STAGES[:4]):
        step(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        assert sorted(map(tuple, now.collect())) == sorted(rows), name


def test_steps_do_not_add_up_in_a_worker():
    import pyarrow as pa
    from terrafold.llm import common, cotraining, encoder

    cotraining.text_view("some words of a text")
    encoder.encoder(encoder.default_path("word_bpe_49k.json"), "words", 7)
    common.alone("encoder")
    assert not cotraining._BUCKETS and encoder._LOADED
    common.alone("views")
    assert not encoder._LOADED
    batch = pa.RecordBatch.from_pydict({"k": list(range(2_500))})
    parts = list(common.few_rows([batch.slice(0, 0), batch]))
    assert [p.num_rows for p in parts] == [1_000, 1_000, 500] and pa.Table.from_batches(parts)["k"].to_pylist() == batch["k"].to_pylist()


def test_a_worker_gives_back_what_another_step_has_freed(monkeypatch):
    from terrafold.llm import common

    back = []
    monkeypatch.setattr(common, "give_back", lambda: back.append(common._SERVED[0]))
    for step in ("one", "one", "other", "one"):
        common.alone(step)
    assert back == ["one", "other", "one"]  # without caches, too, and once a change of steps
