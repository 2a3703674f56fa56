"""Every stage against brute force on what the stage before it kept."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_simhash import brute_fingerprint, brute_groups

import corpus_pipeline
from starmill.llm import mixing, quality, queries
from starmill.session import materialise


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


@pytest.fixture(scope="module")
def kept(spark, sf_dir, documents):
    out = [documents]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], sf_dir), name.replace(" ", "-")))
    return out


def test_stages_are_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact dedup", "simhash near-dedup", "mixing", "sentencepiece"]


def test_all_but_the_last_return_documents(kept, documents):
    assert all(df.columns == documents.columns for df in kept[:-1])


def test_quality(spark, sf_dir, kept):
    ranker = queries.quality_ranker(kept[0], queries.labels(spark, sf_dir))
    good = quality.scores(kept[0], ranker).where(F.col("score") >= 0.3)
    assert ids(kept[1]) == ids(good)
    truth = {r.doc_id: r.quality for r in queries.labels(spark, sf_dir).collect()}
    have = ids(kept[1])
    assert sum(truth[i] for i in truth if i in have) >= 0.97 * sum(truth.values())


def test_exact(kept):
    last = {}
    for r in kept[1].collect():
        last[r.text or ""] = max(r.doc_id, last.get(r.text or "", -1))
    assert ids(kept[2]) == Counter(last.values())


def test_near(kept):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in kept[2].collect()]
    assert set(ids(kept[3])) == {component for _, _, component in brute_groups(rows)}


def test_mix(kept):
    want = Counter()
    for r in mixing.taken(mixing.plan(kept[3])).collect():
        want[r.doc_id] += r.copies
    assert ids(kept[4]) == +want


def test_encoding(kept):
    library = sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model())
    want = Counter()
    for r in kept[4].collect():
        own = library.encode(r.text or "", add_eos=True)
        want[(r.doc_id, len(own), hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in kept[5].collect()) == want


def test_run_gives_the_last_stage(spark, sf_dir, kept):
    assert Counter(corpus_pipeline.run(spark, sf_dir).collect()) == Counter(kept[5].collect())


def test_odd_rows_and_no_rows_pass_every_stage(spark, sf_dir, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    assert docs.count() == 0


def test_quality_stage_learns_from_every_label(spark, tmp_path):
    """The stage once judged by at most 20,000 labelled documents."""
    docs = spark.range(26_000).selectExpr("id as doc_id", "if(id % 5 = 0, concat('!!! ||| ', id), concat('plain words in line ', id)) as text", "cast(id % 5 > 0 as int) as quality")
    docs.drop("quality").write.parquet(f"{tmp_path}/documents.parquet")
    docs.select("doc_id", "quality").write.parquet(f"{tmp_path}/labels.parquet")
    read = queries.documents(spark, str(tmp_path))
    train = [r.text for r in read.where(~queries.held_out("doc_id", 5, 0)).collect()]
    assert len(train) > 20_000
    ranker = queries.quality_ranker(read, queries.labels(spark, str(tmp_path)))
    assert ranker.mean == pytest.approx(quality.features(train).mean(0), abs=1e-9)
    assert ids(corpus_pipeline.good_only(spark, read, str(tmp_path))) == ids(docs.where("quality = 1"))


def test_quality_stage_learns_from_labels_that_op7_holds_out(spark, tmp_path):
    """The stage once left out every fifth label, which only op7's contract asks for; here these are all the bad ones."""
    held = queries.held_out("doc_id", 5, 0)
    docs = spark.range(400).withColumnRenamed("id", "doc_id").withColumn("quality", (~held).cast("int"))
    docs = docs.selectExpr("doc_id", "if(quality = 0, concat('!!! ||| ', doc_id), concat('plain words in line ', doc_id)) as text", "quality")
    docs.select("doc_id", "quality").write.parquet(f"{tmp_path}/labels.parquet")
    assert 0 < docs.where("quality = 0").count() < 200
    assert ids(corpus_pipeline.good_only(spark, docs.drop("quality"), str(tmp_path))) == ids(docs.where("quality = 1"))


def test_quality_stage_judges_by_the_ranker_of_all_labels(spark, sf_dir, documents, monkeypatch):
    made = []
    keep = quality.keep_good
    monkeypatch.setattr(quality, "keep_good", lambda docs, ranker: made.append(ranker) or keep(docs, ranker))
    corpus_pipeline.good_only(spark, documents, sf_dir)
    truth = {r.doc_id: r.quality for r in queries.labels(spark, sf_dir).collect() if r.quality is not None}
    texts = {r.doc_id: r.text or "" for r in documents.collect() if r.doc_id in truth}
    assert made[0].mean == pytest.approx(quality.features(list(texts.values())).mean(0), abs=1e-9)
    bad = sum(1 for i in texts if truth[i] == 0) / len(texts)
    raw = made[0].raw(quality.features(list(texts.values())))
    assert abs((raw < made[0].threshold).mean() - bad) <= 2 / len(texts)


def test_slices_give_back_what_arrow_holds(monkeypatch):
    """Workers that idled through mixing kept it, which took an executor beyond its memory."""
    import pyarrow as pa

    from starmill.llm import common

    freed = []

    class Pool:
        release_unused = staticmethod(lambda: freed.append(True))

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_arrays([pa.array(["a"] * 1000)], ["text"])
    assert sum(part.num_rows for part in common.slices(iter([batch, batch]))) == 2000 and freed == [True]
