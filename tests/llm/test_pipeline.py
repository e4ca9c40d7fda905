"""The pipeline on a small folder of tables with planted junk, copies, leaks and secrets."""

import random

import corpus_pipeline


def test_stages(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9)))
    prose = lambda n: [word() for _ in range(n)]
    items = [(k, " ".join(prose(30))) for k in range(6)]
    docs, labels, kind = [], [], {}
    for i in range(240):
        w = prose(rng.randrange(60, 300))
        if i % 8 == 0:
            kind[i], text = "junk", " ".join(x.upper() + "!!" for x in w)
        elif i % 8 == 1 and i > 1:
            kind[i], text = "copy", docs[2][1] + " end"
        elif i % 8 == 3:
            kind[i], text = "leak", " ".join(w[:20] + [items[i % 6][1]] + w[20:]) + "."
        elif i % 8 == 5:
            kind[i], text = "secret", " ".join(w[:20]) + ' api_key = "hunter2hunter2" ' + " ".join(w[20:]) + "."
        else:
            kind[i], text = "clean", " ".join(w) + "."
        docs.append((i, text, "en", "src0", len(text)))
        labels.append((i, int(kind[i] != "junk"), 0))
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    write(docs, "doc_id long, text string, lang string, source string, n_chars long", "documents")
    write(labels, "doc_id long, quality int, toxic int", "labels")
    write(items, "item_id long, text string", "benchmark")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if k < 4:
            assert out.columns == now.columns
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        left.append({r.doc_id for r in now.select("doc_id").collect()})
    good = {i for i, k in kind.items() if k != "junk"}
    assert left[0] <= good and len(left[0]) > 0.97 * len(good)
    copies = {i for i in left[0] if kind[i] == "copy"} | {2}
    assert left[1] == left[0] - copies | {min(copies & left[0])}
    assert left[2] == {i for i in left[1] if kind[i] != "leak"}
    assert left[3] == left[2] == left[4]
    texts = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/secret_redaction").collect()}
    for i, r in texts.items():
        assert ("[SECRET]" in r.text) == (kind[i] == "secret") and r.n_chars == len(r.text) and "hunter2" not in r.text
    fill = {}
    for r in now.collect():
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 1024 and len(fill) <= -(-sum(fill.values()) // 1024) + 2
