"""Token output, SentencePiece, language model."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tidemark.llm import pieces, recurrent_lm, tokens
from tidemark.llm import text_bytes as tb
from tidemark.llm.queries import PIECE_MODEL, WORD_TOKENIZER, tokenizer

STRANGE = ["", "  ", " a", "a  b\n\n c ", "x" * 3000, "the" * 700, "日本語テキスト", "🙂é ẞ", "<s></s><unk><0x0A>", "a▁b", "▁",
           "a.'s it.'s x.,y!! idiot### a...b ##x$$ é.a <|endoftext|>.x don't.", "É Ⅷ 12'S it's é  x y ẞ ΑΣ İ", "\x00a\x1f"]


def some_texts():
    chance = random.Random(1)
    letters = "ab \t\n.,'éß▁ẞ漢字🙂0x<s>/theinger   "
    return STRANGE + ["".join(chance.choice(letters) for _ in range(chance.randint(0, 60))) for _ in range(1500)]


def test_word_encoder_against_library(documents):
    encoder = tokens.WordEncoder.of(tokenizer(WORD_TOKENIZER))
    texts = some_texts() + [r.text for r in documents.limit(60).collect()]
    got = [ids[a:b].tolist() for ids, f in encoder.texts(pa.array(texts), 2) for a, b in zip(f[:-1], f[1:])]
    assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_token_files(odd, spark, tmp_path):
    tokens.write_tokens(odd, f"{tmp_path}/t", tokenizer(WORD_TOKENIZER))
    got = sorted(tokens.checksums(tokens.read_tokens(spark, f"{tmp_path}/t")).collect(), key=lambda r: r.start)
    library = tokens.WordEncoder.of(tokenizer(WORD_TOKENIZER)).tokenizer
    want = Counter()
    for i, text, *_ in ODD:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert [r.doc_id or -1 for r in got] == sorted(r.doc_id or -1 for r in got)


def scanned(spark, run) -> int:
    """Rows that the ORC scans of the jobs of ``run`` gave on."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    rows = 0
    for i in range(before, store.executionsCount()):
        e = store.executionsList().apply(i)
        nodes, values = store.planGraph(e.executionId()).allNodes(), store.executionMetrics(e.executionId())
        for k in range(nodes.size()):
            node = nodes.apply(k)
            if node.name().startswith("Scan orc"):
                for j in range(node.metrics().size()):
                    m = node.metrics().apply(j)
                    if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                        rows += int(values.apply(m.accumulatorId()).replace(",", ""))
    return rows


def test_a_lookup_reads_row_groups_and_moves_no_ids(spark, tmp_path):
    docs = spark.range(8000).select((F.col("id") * 2).alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text")).coalesce(1)
    tokens.write_tokens(docs, f"{tmp_path}/t", tokenizer(WORD_TOKENIZER))
    files = tokens.read_tokens(spark, f"{tmp_path}/t")
    assert "Exchange hashpartitioning" not in files._jdf.queryExecution().toString()
    assert files.count() == 8000
    raw = spark.read.orc(f"{tmp_path}/t/{tokens.IDS}")
    largest = max(r["count"] for r in raw.groupBy(F.input_file_name()).count().collect())
    assert largest > tokens.INDEX_STRIDE / 2
    at = scanned(spark, lambda: files.where("doc_id = 5000").collect())
    assert 1 <= at <= tokens.INDEX_STRIDE and at < 8000
    assert scanned(spark, lambda: files.where("doc_id = 5001").collect()) == 0  # in the range, but the Bloom filter knows it is not there
    assert files.where("doc_id = 5000").count() == 1 and files.where("doc_id = 5001").count() == 0


def test_no_rows(none, spark, tmp_path):
    tokens.write_tokens(none, f"{tmp_path}/t", tokenizer(WORD_TOKENIZER))
    assert tokens.checksums(tokens.read_tokens(spark, f"{tmp_path}/t")).count() == 0
    assert pieces.encode_decode(none, tokenizer(PIECE_MODEL)).count() == 0
    assert recurrent_lm.score(none).count() == 0


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECE_MODEL))


def test_pieces_against_library(library, documents, spark):
    texts = some_texts() + [r.text for r in documents.limit(100).collect()] + [None]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    got = pieces.encode_decode(docs, tokenizer(PIECE_MODEL)).orderBy("doc_id").collect()
    for r, t in zip(got, texts):
        assert r.ids == library.encode(t or "") and r.n_pieces == len(r.ids)
        assert r.decoded == (t or "").replace("▁", " ")


def test_piece_ranges(library):
    model = pieces.Model.of(tokenizer(PIECE_MODEL))
    data = np.frombuffer(b" the thing\xff then in\xff", np.uint8)
    order = model.suffix_array(data)
    lo, hi = model.ranges(data, order)
    raw = data.tobytes()
    for text, a, b in zip(model.texts, lo, hi):
        where = [i for i in range(len(raw)) if raw.startswith(text, i)]
        assert sorted(order[a:b].tolist()) == where


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\0end"]


def test_lm_base_counts(documents, odd):
    docs = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = [(r.doc_id, words(r.text)) for r in docs.collect()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, ws in rows if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in rows), key=str)
    got = recurrent_lm.score(docs).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got),
                  key=str) == want
    away = [r for r in got if r.held_out]
    assert sum(r.score for r in away) > sum(r.base_score for r in away)  # the network knows more than counts


def test_gradients_against_differences():
    random_ = np.random.default_rng(3)
    net = recurrent_lm.Network(seed=5)
    net.w = {k: random_.normal(0, 0.3, x.shape) for k, x in net.w.items()}
    before, targets = random_.integers(0, 64, (6, 4)), random_.integers(0, 64, (6, 4))
    fresh = random_.random((6, 4)) < 0.2
    state = random_.normal(0, 0.5, (4, recurrent_lm.HIDDEN))

    def loss():
        s, total = state, 0.0
        for t in range(6):
            s, _ = net.step(before[t], s * ~fresh[t][:, None])
            total -= net.log_probs(s, targets[t]).sum()
        return total / targets.size

    g, _ = net.gradients(before, targets, fresh, state)
    for k, x in net.w.items():
        for _ in range(6):
            at = tuple(random_.integers(0, n) for n in x.shape) if k != "e" else (before[0, 0], random_.integers(0, x.shape[1]))
            kept = x[at]
            x[at] = kept + 1e-5
            up = loss()
            x[at] = kept - 1e-5
            down = loss()
            x[at] = kept
            assert abs((up - down) / 2e-5 - g[k][at]) < 1e-6


def test_state_is_carried_across_windows(monkeypatch):
    net = recurrent_lm.Network(seed=5)
    net.w["v"] = np.random.default_rng(1).normal(0, 0.5, net.w["v"].shape).astype(np.float32)
    lengths = [1, 150, 0, 64, 65, 700]
    classes = np.random.default_rng(2).integers(0, 64, sum(lengths))
    firsts = np.cumsum([0, *lengths])
    whole = []
    for a, b in zip(firsts[:-1], firsts[1:]):
        state, before, total = np.zeros((1, recurrent_lm.HIDDEN), np.float32), np.zeros(1, np.int64), 0.0
        for c in classes[a:b]:
            state, _ = net.step(before, state)
            total += float(net.log_probs(state, np.array([c]))[0])
            before = np.array([c])
        whole.append(total / math.log(10))
    monkeypatch.setattr(recurrent_lm, "SCORE_LANES", 4)
    assert np.allclose(net.score(classes, firsts), whole, rtol=1e-4, atol=1e-4)


def test_lm_learns_from_every_training_row(spark, none):
    """The id with the smallest hash has 1,000 rows; the words of all other rows are learned nevertheless."""
    ids = [r.id for r in spark.range(400).where(~recurrent_lm.held_out(F.col("id"))).orderBy(F.xxhash64("id")).collect()]
    away = [r.id for r in spark.range(400).where(recurrent_lm.held_out(F.col("id"))).collect()]
    rows = [(ids[0], "one hot row")] * 1000 + [(i, "left right " * 40) for i in ids[1:] + away]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [r for r in recurrent_lm.score(docs).collect() if r.held_out]
    assert len(got) == len(away) and all(r.score / r.n_tokens > -0.1 for r in got)


def test_whole_scores_against_a_plain_reading(documents, odd):
    """Every document token by token: P(class | tokens before) times the word's share of its class."""
    docs = documents.where("doc_id < 60").select("doc_id", "text").unionByName(odd.select("doc_id", "text").where("length(text) < 2000"))
    docs = docs.repartition(4, "text").cache()
    m = recurrent_lm.learn(docs)
    net, count = recurrent_lm.Network(m.weights), {np.uint64(r.vocab % 2 ** 64): r.c for r in m.counts.collect()}
    in_class = Counter()

    def told(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        starts, ends, _ = tb.words(data, np.array([0, len(data)]))
        h = np.append(tb.hashes(data, starts, ends), recurrent_lm.END)
        return h, m.classes.tell(h, np.append(recurrent_lm.endings(data, starts, ends), -1))

    rows = [(r.doc_id, *told(r.text)) for r in docs.collect()]
    for h, c in {(h, c) for _, hs, cs in rows for h, c in zip(hs.tolist(), cs.tolist()) if np.uint64(h) in count}:
        in_class[c] += count[np.uint64(h)] + 1
    want = []
    for i, hs, cs in rows:
        state, before, total = np.zeros((1, recurrent_lm.HIDDEN), np.float32), np.zeros(1, np.int64), 0.0
        for h, c in zip(hs, cs):
            state, _ = net.step(before, state)
            total += float(net.log_probs(state, np.array([c]))[0]) / math.log(10)
            total += math.log10((count.get(h, 0) + 1) / (in_class[int(c)] + 1))
            before = np.array([c])
        want.append((str(i), len(hs), round(total, 2)))
    got = [(str(r.doc_id), r.n_tokens, r.score) for r in recurrent_lm.score(docs).collect()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) <= 0.02 + 1e-4 * abs(b[2])


def test_replicas_are_averaged_by_their_documents(spark):
    net = recurrent_lm.Network(seed=1)
    rows = [(k, n, *[(net.w[name] * f).astype(np.float32).tobytes() for name in ("e", "u", "v", "b")]) for k, (n, f) in enumerate([(1, 1.0), (3, 2.0)])]
    df = spark.createDataFrame(rows, "replica bigint, n bigint, e binary, u binary, v binary, b binary")
    mean = recurrent_lm._mean(df, net.w)
    assert all(np.allclose(mean[k], net.w[k] * 1.75, atol=1e-6) for k in net.w)
    assert recurrent_lm._mean(df.where("false"), net.w) is net.w


def test_no_token_is_left_out_of_the_lanes(monkeypatch):
    seen = []
    monkeypatch.setattr(recurrent_lm.Network, "gradients", lambda self, before, targets, begins, state: (
        seen.extend(targets.ravel().tolist()), ({k: np.zeros_like(x) for k, x in self.w.items()}, state))[1])
    told = np.arange(32 * 64 + 45) % 64
    recurrent_lm.Network().train([(told, np.arange(len(told)) % 100 == 0), (np.array([5]), np.array([True]))], 0.02)
    assert sorted(seen) == sorted([*told.tolist(), 5])


def test_texts_queue_in_lanes(monkeypatch):
    """One long text and many short ones: a step has all lanes at work, instead of the long text's alone."""
    steps, forward = [], recurrent_lm.Network.forward
    monkeypatch.setattr(recurrent_lm.Network, "forward", staticmethod(lambda x, u, state, *a: (steps.append(len(state)), forward(x, u, state, *a))[1]))
    monkeypatch.setattr(recurrent_lm, "SCORE_LANES", 4)
    lengths = np.array([100, *[10] * 31])
    recurrent_lm.Network().score(np.arange(lengths.sum()) % 64, np.cumsum([0, *lengths]))
    assert sum(steps) >= lengths.sum() and len(steps) <= 112


def test_shards_carry_tokens_as_bytes(documents):
    """Spark copies the tokens of a shard as one value, not number by number."""
    m = recurrent_lm.learn(documents.where("doc_id < 40"))
    assert dict(m.shards.dtypes)["tokens"] == "binary"
    for r in m.shards.collect():
        assert np.bincount(np.frombuffer(r.tokens, np.int32), minlength=len(r.vocab)).min() > 0
        assert len(r.tokens) == 4 * r.firsts[-1] and len(r.firsts) == len(r.ids) + 1
