"""The stages of the pipeline against plain versions, each on its own input."""

import pytest

import corpus_pipeline
from test_operators import _components
from vitrine.llm import decontaminate, secrets, toxicity


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    folder, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, small).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append((name, before, docs))
    return out


def test_columns_and_order(stages):
    assert [name for name, _, _ in stages] == ["toxicity", "ngram_jaccard", "decontamination", "secrets", "bpe"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_each_stage(spark, small, stages):
    (_, a, b), (_, _, c), (_, _, d), (_, _, e), (_, _, f) = stages
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    model = toxicity.train(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet"))
    texts = a.collect()
    assert ids(b) == {r["doc_id"] for r, s in zip(texts, toxicity.scores(model, [r["text"] for r in texts])) if s < 0.3}
    rows = [(r["doc_id"], r["text"]) for r in b.collect()]
    assert ids(c) == {i for i, _, least in _components(rows) if i == least}
    items = {w for r in spark.read.parquet(f"{small}/benchmark.parquet").collect() for w in decontaminate.windows_of(decontaminate.words_of(r["text"]))}
    lengths = {len(w) for w in items}

    def clean(text):
        w = decontaminate.words_of(text)
        return not any(tuple(w[i : i + n]) in items for n in lengths for i in range(len(w) - n + 1))

    assert ids(d) == {r["doc_id"] for r in c.collect() if clean(r["text"])}
    before = {r["doc_id"]: r["text"] for r in d.collect()}
    after = {r["doc_id"]: r["text"] for r in e.collect()}
    assert before.keys() == after.keys()
    for i, text in before.items():
        assert (text == after[i]) == (not secrets.spans_of(text))
    assert ids(f) == ids(e) and {r["n_tokens"] == len(r["token_ids"]) for r in f.collect()} == {True}


def test_near_copies_between_80_and_85_percent_go(spark, small):
    """A copy with a fifth of new text appended, and one with 21 of 1,000 words changed."""
    base, long = [f"a{i}" for i in range(200)], [f"b{i}" for i in range(1000)]
    changed = [f"new{i}" if i % 47 == 20 and i < 47 * 21 else w for i, w in enumerate(long)]
    texts = [base, [*base, *(f"c{i}" for i in range(40))], long, changed, [*base, *(f"d{i}" for i in range(80))]]
    sets = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    common = lambda a, b, n: len(sets(a, n) & sets(b, n)) / len(sets(a, n) | sets(b, n))
    for a, b in ((0, 1), (2, 3)):
        assert common(texts[a], texts[b], 5) >= 0.8 and common(texts[a], texts[b], 4) < 0.85
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, small).collect()} == {0, 2, 4}


def test_odd_rows_go_through(spark, small, odd, none):
    for docs in (odd, none):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, small)
        assert docs.columns == odd.columns and docs.where("text is null").count() == (2 if n else 0)
