"""The corpus pipeline against a plain Python version of its stages, one after the other."""

import re
import zlib

import corpus_pipeline
from tokenizers import Tokenizer

from cuelake.llm import packing, quality, toxicity
from cuelake.llm.queries import tokenizer

import plain
from test_llm import D, ODD


def _plain(docs, labels, spark):
    sample = [(i, docs[i], y) for i, (_, y) in labels.items() if i in docs and zlib.crc32(str(i).encode()) % 5]
    g = toxicity.train(spark.createDataFrame([(i, t) for i, t, _ in sample], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in sample], "doc_id long, toxic int"))
    docs = {i: t for i, t in docs.items() if g.score(t) < 0.5}
    sizes = [len(docs)]
    docs = {i: docs[i] for i, (b, llr) in plain.quality(docs, {i for i, (q, _) in labels.items() if q == 1}).items() if not b[-1] and llr >= quality.THRESHOLD}
    sizes.append(len(docs))
    first = {}
    for i in sorted(docs):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", docs[i]), i)
    docs = {i: docs[i] for i in first.values()}
    sizes.append(len(docs))
    low = plain.near(docs)
    docs = {i: t for i, t in docs.items() if low[i] == i}
    return docs, [*sizes, len(docs)]


def test_pipeline(spark, tmp_path):
    real = spark.read.parquet(f"{D}/documents.parquet")
    texts = {r.doc_id: r.text for r in real.collect()}
    clean = sorted((i for i, t in texts.items() if t and 150 < len(t.split()) < 400), key=lambda i: -len(set(texts[i].split())))[:4]
    planted = {50_000 + i: t for i, t in enumerate(ODD)}
    planted |= {60_000 + k: texts[i] for k, i in enumerate(clean)}
    planted |= {61_000 + k: "  " + texts[i].replace(" ", "\n", 1) for k, i in enumerate(clean)}
    planted |= {62_000 + k: texts[i].upper() + "\n" for k, i in enumerate(clean)}
    planted |= {63_000 + k: texts[i] + " and three words" for k, i in enumerate(clean)}
    extra = spark.createDataFrame([(i, t, None, None, None) for i, t in planted.items()], real.schema)
    real.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{D}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    by_id = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    want, sizes = _plain({i: t or "" for i, t in (texts | planted).items()}, by_id, spark)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0
    tk = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    plain.check_bins(got, {i: tk.encode(t, add_special_tokens=False).ids + [packing.END_ID] for i, t in want.items()}, packing.LENGTHS)


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").selectExpr("*", "1 as row_number", "'x' as score", "2.0 as kept")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, D)
        assert got.columns == docs.columns, name
        assert stage(spark, docs.where("false"), D).count() == 0, name
    assert corpus_pipeline.pack(spark, docs.where("false"), D).count() == 0


def test_null_and_repeated_ids(spark):
    """Clean rows without an id stay; of equal rows of one id the dedup stages keep one; a null text is an empty one."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    text = next(r.text for r in docs.orderBy("doc_id").collect() if r.text and 200 < len(r.text.split()) < 400)
    other = " ".join(f"w{k}" for k in range(300))
    rows = spark.createDataFrame([(None, other, None, None, None)] * 2 + [(77, text, None, None, None)] * 2 + [(78, None, None, None, None), (None, None, None, None, None)], docs.schema)
    ids = lambda df: sorted((r.doc_id or -1 for r in df.collect()))
    assert ids(corpus_pipeline.drop_toxic(spark, rows, D)) == [-1, -1, -1, 77, 77, 78]
    assert ids(corpus_pipeline.drop_copies(spark, rows, D)) == [-1, 77, 78]
    assert ids(corpus_pipeline.drop_near_copies(spark, rows, D)) == [-1, 77, 78]
    judged = corpus_pipeline.keep_quality(spark, docs.unionByName(rows), D)
    assert judged.where("doc_id is null and text is null").count() == 0 and judged.where("doc_id = 77").count() in (2, 3)
    assert [d for r in corpus_pipeline.pack(spark, rows, D).collect() for d in r.doc_ids].count(None) == 3


def test_stages_write_no_texts(spark, monkeypatch, tmp_path):
    """Rows of a table are numbered by file and place, alike however the table is split; their texts are not written again."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    docs.repartition(3).write.parquet(f"{tmp_path}/a b%20c")
    docs = spark.read.parquet(f"{tmp_path}/a b%20c")
    written, materialize = {}, corpus_pipeline.materialize
    monkeypatch.setattr(corpus_pipeline, "materialize", lambda rows, name: written.setdefault(name, materialize(rows, name)))
    rows, row = corpus_pipeline._numbered(docs)
    assert rows.columns == [*docs.columns, row] and not written
    got = {r[row]: r.doc_id for r in rows.collect()}
    assert len(got) == docs.count() and sorted(got.values()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        again = rows.where("doc_id is not null").select(row, "doc_id")
        assert again.rdd.getNumPartitions() > 3 and {r[0]: r[1] for r in again.collect()} == got
        for name, stage in corpus_pipeline.STAGES[1:-1]:
            stage(spark, docs, D).count()
        assert not written
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    other, row = corpus_pipeline._numbered(docs.unionByName(docs))
    assert "numbered" in written and other.select(row).distinct().count() == 2 * len(got)
