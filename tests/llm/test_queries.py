"""Registered queries against their SQL, and the pipeline against a plain version."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_rules_and_lines import plain_counts, plain_lines
from tests.llm.test_texts import plain_classes
from tests.oracle import connect
from tidemark.llm import decontam, near_dup, queries
from tidemark.llm.queries import registered

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, q in registered.items() if q.sql])
def test_against_sql(spark, name):
    query = registered[name]
    df = query.run(spark, FOLDER)
    names = sorted(df.columns)
    cur = connect(FOLDER).execute(query.sql)
    at = [[d[0] for d in cur.description].index(c) for c in names]
    assert sorted(d[0] for d in cur.description) == names
    got = sorted(tuple(r[c] for c in names) for r in df.collect())
    assert got == sorted(tuple(r[i] for i in at) for r in cur.fetchall())


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registered) == list(range(1, 14))


def test_pipeline_against_plain(spark):
    import sentencepiece
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    counted = {i: plain_counts(t) for i, t in rows}
    rows = [(i, t) for i, t in rows if counted[i][0] >= 50 and 100 * counted[i][4] <= 50 * counted[i][0]]
    rows = [(i, t) for i, t, *_ in plain_lines(rows, 10)]
    made = spark.createDataFrame(rows, "doc_id bigint, text string")
    least = {i: c for i, c, _ in plain_classes(rows, near_dup.frequent_shingles(made.select("text")), 0.8)}
    blank = {i for i, t in rows if not t.strip()}
    rows = [(i, t) for i, t in rows if least[i] == i or i in blank]
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    grams = lambda w, n: [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
    cut = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t))

    def leaks(text):
        held = cut(text)
        for item in benchmark:
            at = decontam._answer_start(item.text or "")
            shares = []
            for part, need in (((item.text or "")[:at], decontam.QUESTION_SHARE), ((item.text or "")[at:], decontam.ANSWER_SHARE)):
                w = cut(part)
                if w:
                    n = min(decontam.RUN_WORDS, len(w))
                    found, have = set(grams(w, n)), set(grams(held, n))
                    shares.append(len(found & have) / len(found) >= need)
            if shares and all(shares):
                return True
        return False

    rows = [(i, t) for i, t in rows if not leaks(t)]
    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer(queries.PIECE_MODEL))
    got = corpus_pipeline.run(spark, FOLDER)
    assert Counter((r.doc_id, r.text, tuple(r.ids)) for r in got.collect()) == Counter(
        (i, t.replace("▁", " "), tuple(library.encode(t))) for i, t in rows)


def test_stages_keep_the_columns_and_odd_rows(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", odd.doc_id.alias("n_chars"))
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name
        assert stage(spark, empty, FOLDER).count() == 0
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, FOLDER).count() == docs.count()
