"""The pipeline's stages on a small corpus of planted cases."""

import re

import corpus_pipeline
from segmentflow.llm import near_dup, pii


def corpus(spark, folder):
    rng = __import__("random").Random(1)
    words = {"en": [f"th{a}{b}" for a in "aeiou" for b in "nrst"], "fr": [f"é{a}{b}u" for a in "aeiou" for b in "nrst"]}
    rows, texts = [], {}
    for i in range(200):
        lang = "en" if i % 2 else "fr"
        texts[i] = " ".join(rng.choice(words[lang]) for _ in range(60))
        rows.append((i, texts[i], lang, "s"))
    item = " ".join(rng.choice(words["en"]) for _ in range(30))
    rows += [(300, texts[3], "en", "s"), (301, texts[5] + " tail", "en", "s")]
    rows += [(302, texts[7] + " " + item + " thar", "en", "s"), (303, "%% 12 34", "en", "s"), (304, None, "en", "s")]
    rows += [(305, texts[9][::-1] + " mail a.b@c.org now", "en", "s")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {r[0]: r[1] for r in rows}


def test_stages(spark, tmp):
    texts = corpus(spark, tmp)
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tmp)
        docs.write.parquet(f"{tmp}/out-{name}")
        docs = spark.read.parquet(f"{tmp}/out-{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != "byte_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = set(range(200))
    assert clean <= set(seen["language_id"]) and not {303, 304} & set(seen["language_id"])
    assert clean <= set(seen["near_dup"]) and not {300, 301} & set(seen["near_dup"])
    assert clean <= set(seen["decontaminate"]) and 302 not in seen["decontaminate"]
    if 305 in seen["pii"]:
        assert "[EMAIL]" in seen["pii"][305].text and seen["pii"][305].n_chars == len(seen["pii"][305].text)
    for i in clean:
        assert seen["pii"][i].text == texts[i] or pii.base_mentions(texts[i]) or re.search(r"\d", texts[i])
    assert set(seen["byte_bpe"]) == set(seen["pii"])
    assert {r.doc_id for r in corpus_pipeline.run(spark, tmp).collect()} == set(seen["byte_bpe"])


def test_rows_without_an_id(spark, tmp):
    corpus(spark, tmp)
    item = spark.read.parquet(f"{tmp}/benchmark.parquet").first().text
    own = " ".join(f"word{chr(97 + k)}" for k in range(20))
    rows = [(None, "so " + item), (None, own), (None, own), (7, own + " tail"), (8, "another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_dup_stage(spark, docs, tmp)
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(0, rows[0][1]), (7, rows[3][1]), (8, rows[4][1])])
    clean = corpus_pipeline.decontamination_stage(spark, kept, tmp)
    assert clean.columns == ["doc_id", "text"] and sorted(r.doc_id for r in clean.collect()) == [7, 8]


def test_texts_of_kept_rows_are_not_shuffled(spark, tmp):
    """Before: once the dropped ids were too many to be broadcast, every
    stage that drops rows shuffled all texts to leave them out."""
    corpus(spark, tmp)
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        for stage in (corpus_pipeline.near_dup_stage, corpus_pipeline.decontamination_stage):
            plan = stage(spark, docs, tmp)._jdf.queryExecution().optimizedPlan().toString()
            assert "Union" in plan and "Join LeftAnti" in plan
            assert all("getbit" in part for part in plan.split("Join LeftAnti")[1:])
    finally:
        spark.conf.set(threshold, before)


def test_without_equals_a_plain_anti_join(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "PICK_BITS", 1)  # 128 bits, shared by many ids
    rows = [(i % 700, f"text {i}", i) for i in range(1000)] + [(None, "no id", 0), (5, None, 1)]
    df = spark.createDataFrame(rows, "k long, text string, w int")
    for ids in ([], [3], [*range(0, 700, 9), 5, 5, 9999], list(range(800))):
        gone = spark.createDataFrame([(i,) for i in ids], "k long")
        got = near_dup.without(df, "k", gone)
        assert got.columns == df.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, df.join(gone, "k", "left_anti").select(*df.columns).collect()))


def test_repeated_rows_are_one_document(spark, tmp):
    own = [" ".join(f"w{i}{chr(97 + k)}" for k in range(20)) for i in range(6)]
    rows = [(1, own[0]), (1, own[0]), (1, own[1]), (2, own[2]), (2, own[2]), (3, own[3]), (4, own[3]), (4, own[3]), (5, own[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_dup_stage(spark, docs, tmp)
    assert sorted(map(tuple, kept.collect())) == sorted([(1, own[0]), (1, own[1]), (2, own[2]), (3, own[3]), (5, own[4])])
