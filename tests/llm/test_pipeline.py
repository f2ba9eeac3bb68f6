import corpus_pipeline
from reelscope.llm.queries import tokenizer_path
from tests.llm import test_decontaminate, test_ngram_join, test_packing, test_pii_bootstrap, test_repetition

PLACEHOLDER = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def redacted(text):
    out, at = "", 0
    for kind, a, b in test_pii_bootstrap.base(text):
        if a >= at:
            out += text[at:a] + PLACEHOLDER[kind]
        at = max(at, b)
    return out + text[at:]


def expected(docs, items):
    """Texts that reach packing, by brute force."""
    docs = [(i, t) for i, t in docs if test_repetition.brute(t)[6]]
    docs = [(i, t) for i, t in docs if (i, i) in {(a, c) for a, _, c in test_ngram_join.brute(docs)}]
    leaked = {r[0] for r in test_decontaminate.brute(docs, items)}
    return [(i, redacted(t)) for i, t in docs if i not in leaked]


def test_run_on_given_tables_against_brute_force(spark, smoke_dir):
    from tokenizers import Tokenizer

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{smoke_dir}/benchmark.parquet").collect()]
    want = expected(docs, items)
    assert 0 < len(want) < len(docs)
    rows = corpus_pipeline.run(spark, smoke_dir).collect()
    test_packing.check(rows, want, Tokenizer.from_file(tokenizer_path()))


def test_stages_keep_the_columns_of_documents(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").limit(60)
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, smoke_dir).schema == docs.schema
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram join", "decontamination", "personal data", "packing",
    ]


def test_empty_documents(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").where("false")
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, smoke_dir).collect() == []
