"""The five stages on a small corpus: what must go goes, the rest stays, tokens are exact."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(7)
    vocab = [a + b for a in "ka lo mi ru te sa no pi ve du ga he".split() for b in "ndra stel mor lin vek tas rop".split()]

    def text(n):
        return " ".join(" ".join(rng.choices(vocab, k=rng.randint(5, 12))).capitalize() + "." for _ in range(n))

    item = "Alice has 12 apples and then Bob gives 5 apples to Alice, so how many apples does Alice have in total after 3 days?"
    rows = [(i, text(12), "en", "s", 1) for i in range(300)]
    base = rows[10][1]
    words = base.split(" ")
    near = " ".join(words[:50] + ["changed"] + words[51:])
    extra = {
        1000: ("%%% $$ | ## " * 30, "quality"),
        1001: ("Kandra Kandra Kandra Kandra Kandra Kandra Kandra Kandra " * 8, "quality"),
        1002: (rows[5][1].replace(" ", "\n"), "exact"),
        1003: (near, "near"),
        1004: (text(6) + " " + item + " " + text(6), "leak"),
        1005: (text(6) + " " + item.replace("Alice", "Carol").replace("12", "31") + " " + text(6), "leak"),
        1006: ("", "stays"),
    }
    rows += [(i, t, "en", "s", 1) for i, (t, _) in extra.items()]
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(250)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, {i: t for i, t, *_ in rows}, extra


def test_stages_keep_the_columns(spark, corpus):
    d, _, _ = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, d).schema == docs.schema, name


def test_run(spark, corpus):
    d, texts, extra = corpus
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, d).collect()}
    gone = {i for i, (_, why) in extra.items() if why != "stays"}
    assert not gone & got.keys()
    assert len(set(texts) - gone - got.keys()) <= 2  # trusted texts above the 0.999 quantile
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, r in got.items():
        ids = sp.encode(texts[i])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_stages_take_empty_tables_and_nulls(spark, corpus):
    d, _, _ = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    odd = docs.limit(3).withColumns({"text": F.lit(None).cast("string"), "lang": F.lit(None).cast("string"), "doc_id": F.lit(None).cast("long")})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), d).count() == 0, name
        assert stage(spark, odd, d).count() <= 3, name
