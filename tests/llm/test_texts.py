"""Repeated strings, near copies, decontamination, toxicity."""

import hashlib
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontam, near_dup, substrings, toxicity
from tidemark.llm.components import components


def plain_cut(texts, width):
    seen = Counter(b[i:i + width] for b in texts for i in range(len(b) - width + 1))
    out = []
    for b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = [True] * width
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("width, first, large", [(200, 32, 20000), (200, 32, 2), (24, 6, 20000), (24, 6, 3), (9, 2, 20000)])
def test_repeated_strings_against_plain(odd, documents, monkeypatch, width, first, large):
    monkeypatch.setattr(substrings, "LARGE_GROUP", large)
    docs = documents.limit(60) if width < 200 else odd
    texts = [(r.text or "").encode() for r in docs.select("text").collect() if len(r.text or "") < 20000]
    few = docs.where("text is null or length(text) < 20000")
    got = substrings.repeated_strings(few, width=width, first=first, hashed=True)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in got.collect()) == plain_cut(texts, width)


def test_long_texts_are_cut_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 1 << 12)
    monkeypatch.setattr(substrings, "_LOW", substrings._U((1 << 12) - 1))
    part = "".join(chr(97 + (i * i // 7 + i // 3) % 26) for i in range(9000))
    texts = [part + "0" * 700 + part[100:5000], "z" * 6000, part[3000:3300]]
    docs = spark.createDataFrame(enumerate(texts), "doc_id bigint, text string").coalesce(1)
    # The names of the module are read by the tasks, so the helpers are run here on the driver too.
    got = {name for f in (substrings._emit_anchors(200, 32, False),) for b in f(iter([pa.record_batch(
        {"t": pa.array([1]), "t2": pa.array([2]), "b": pa.array([texts[0].encode()])})])) for name in b.column(0).to_pylist()}
    assert got
    rows = substrings.repeated_strings(docs, hashed=True).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in rows) == plain_cut([t.encode() for t in texts], 200)


def test_no_rows(none, spark):
    assert substrings.repeated_strings(none).count() == 0
    assert near_dup.classify(none).count() == 0
    benchmark = spark.createDataFrame([(1, "some question words here")], "item_id bigint, text string")
    assert decontam.leaked_items(none, benchmark).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (102, 100), (200, 200)] + [(500, i) for i in range(501, 900)]
    got = {r.a: r.root for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, 101: 100, 102: 100, **{i: 500 for i in range(501, 900)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def plain_classes(rows, weights, threshold):
    sets = list(near_dup.weighted(pa.array([t for _, t in rows], pa.string()), weights))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i][0]) and near_dup.similarity(sets[i], sets[j]) >= threshold - 1e-12:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = lambda g: min((x for x in g if x is not None), default=None)
    return sorted(((i, least(g), len(g)) for g in groups.values() for i in g), key=str)


@pytest.mark.parametrize("large, block, rounds", [(40, 250, 8), (2, 3, 1), (2, 20, 0)])
def test_near_copies_against_plain(spark, odd, documents, monkeypatch, large, block, rounds):
    monkeypatch.setattr(near_dup, "LARGE_BUCKET", large)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "STAR_ROUNDS", rounds)
    words = [f"w{i}" for i in range(120)]
    hot = [(1000 + k, " ".join(words[:k % 100] + [f"new{k}"] + words[k % 100 + 1:])) for k in range(80)]
    made = spark.createDataFrame(hot + [(2000, " ".join(words)), (2001, "only four words here"), (2002, "Only FOUR words  here")],
                                 "doc_id bigint, text string")
    docs = documents.select("doc_id", "text").limit(80).unionByName(made).unionByName(odd.where("doc_id is null or doc_id < 7").select(
        (odd.doc_id + 5000).alias("doc_id"), "text"))
    rows = [tuple(r) for r in docs.collect()]
    weights = near_dup.frequent_shingles(docs.select("text"))
    got = near_dup.classify(docs).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in got), key=str) == plain_classes(rows, weights, 0.8)
    kept = [r for r in got if r.kept]
    blank = [r for r in got if not (r.text or "").strip()]
    assert len(kept) == len({r.class_id for r in got if r not in blank}) + len(blank)
    assert near_dup.keep_one(docs).columns == docs.columns


def test_samples_agree_as_often_as_weights_overlap():
    import numpy as np
    sampler = near_dup.Sampler(4000)
    names = near_dup.tb.mix(np.arange(1, 41, dtype=np.uint64))
    a, b = (names[:30], np.linspace(0.8, 3, 30)), (names[10:], np.linspace(1, 2, 30))
    a, b = ((n[np.argsort(n)], w[np.argsort(n)]) for n, w in (a, b))
    share = (sampler.samples(*a) == sampler.samples(*b)).mean()
    assert abs(share - near_dup.similarity(a, b)) < 0.03


def test_sketches_keep_similar_pairs(spark):
    import numpy as np
    sampler, random = near_dup.Sampler(near_dup.SAMPLES), np.random.default_rng(4)
    rows = []
    for i in range(300):
        names = np.unique(near_dup.tb.mix(random.integers(1, 1 << 62, 130).astype(np.uint64)))
        cut = (7, 40, 100)[i % 3]  # similarity 0.85, 0.4 and next to none
        a, b = names[:-cut], names[cut:]
        s = [near_dup.sketch(sampler.samples(x, np.ones(len(x)))).tolist() for x in (a, b)]
        rows.append((near_dup.similarity((a, np.ones(len(a))), (b, np.ones(len(b)))), (float(len(a)), s[0]), (float(len(b)), s[1])))
    kind = "struct<w: double, s: array<bigint>>"
    pairs = spark.createDataFrame(rows, f"j double, a {kind}, b {kind}")
    kept = [r.j for r in pairs.where(near_dup.plausible(pairs.a, pairs.b, 0.8)).collect()]
    assert sum(j >= 0.8 for j in kept) == sum(r[0] >= 0.8 for r in rows) and sum(j < 0.3 for j in kept) == 0


def test_leaks(spark, odd):
    items = [(1, "What is the colour of the sky over the northern hills at noon?\nThe answer is a very pale greenish blue."),
             (2, "Short one. Yes indeed it is."), (3, None), (4, ""), (5, "..."), (None, "An item without any id. It has words."),
             (7, "What is the colour of the sky over the northern hills at noon?\nThe answer is a very pale greenish blue.")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    filler = " ".join(f"filler{i}" for i in range(500))
    q, a = items[0][1].split("\n")
    docs = spark.createDataFrame([
        (1, f"{filler} {items[0][1].upper()} {filler}"), (2, f"{filler} {q} {filler}"), (3, f"{filler} {a}"), (4, filler),
        (5, None), (6, ""), (7, "so: short one. yes indeed it is! and more"), (8, items[5][1] + filler),
        (9, " ".join(sorted((q + " " + a).split())))], "doc_id bigint, text string").withColumn("items", F.lit(1))
    got = {r.doc_id: (r["items"], r.contaminated) for r in decontam.leaked_items(docs, benchmark).collect()}
    assert got[1] == ([1, 7], True) and got[7] == ([2], True) and got[8] == ([None], True)
    assert [got[i] for i in (2, 3, 4, 5, 6, 9)] == [([], False)] * 6
    assert decontam.keep_clean(docs, benchmark.where("false")).count() == 9
    assert {r.doc_id for r in decontam.keep_clean(docs, benchmark).collect()} == {2, 3, 4, 5, 6, 9}


@pytest.mark.parametrize("others", [[], [(2, None), (3, ""), (4, "...")]])
def test_one_item_with_words(spark, others):
    item = "What is the colour of the sky over the northern hills at noon?\nThe answer is a very pale greenish blue."
    benchmark = spark.createDataFrame([(1, item), *others], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"some words before. {item} And some after"), (2, "nothing of it")], "doc_id bigint, text string")
    got = {r.doc_id: (r["items"], r.contaminated) for r in decontam.leaked_items(docs, benchmark).collect()}
    assert got == {1: ([1], True), 2: ([], False)}
    assert [r.doc_id for r in decontam.keep_clean(docs, benchmark).collect()] == [2]


def test_groups_of_items_agree(spark, documents, monkeypatch):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = {r.doc_id: r["items"] for r in decontam.leaked_items(documents, benchmark).collect()}
    monkeypatch.setattr(decontam, "ITEMS", 7)
    parts = {r.doc_id: r["items"] for r in decontam.leaked_items(documents, benchmark).collect()}
    texts = {r.item_id: r.text for r in benchmark.collect()}
    exact = {r.doc_id: sorted(i for i, t in texts.items() if t in (r.text or "")) for r in documents.collect()}
    assert whole == parts and all(set(exact[i]) <= set(whole[i]) for i in exact) and any(exact.values())


def test_bound_never_misses(spark, documents):
    """The passages whose exact score reaches the threshold are all among the candidates."""
    import numpy as np
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    group = decontam.Group.of(decontam.impacts(benchmark).orderBy("number").collect())
    texts = [(r.text or "").encode() for r in documents.limit(80).collect()]
    for text in texts:
        h = decontam._text_hashes(text)
        found = {(int(a), i) for _, a, _, i in group.candidates(h, np.array([0, len(h)]))}
        for a in range(0, max(1, len(h)), group.block_words):
            window = h[a:a + 3 * group.block_words]
            for i, (words, s) in enumerate(group.words):
                if s[np.isin(words, window)].sum() >= decontam.THRESHOLD:
                    assert (a, i) in found


def test_slices_of_blocks_agree(spark, documents, monkeypatch):
    """A text walked in slices has the candidates it has when walked whole."""
    import numpy as np
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    group = decontam.Group.of(decontam.impacts(benchmark).orderBy("number").collect())
    hashed = [decontam._text_hashes((r.text or "").encode()) for r in documents.limit(60).collect()]
    h, firsts = np.concatenate(hashed), np.cumsum([0, *map(len, hashed)])
    whole = {tuple(map(int, c)) for c in group.candidates(h, firsts)}
    for blocks in (1, 4, 9):
        monkeypatch.setattr(decontam, "CELLS", len(group.ids) * blocks)
        assert {tuple(map(int, c)) for c in group.candidates(h, firsts)} == whole
    assert whole


def test_leaks_in_long_and_repeated_texts(spark, odd):
    """A text of three million bytes with an item near its end, every odd row, and clashing names."""
    question = "What is the colour of the sky over the northern hills at noon?\nThe answer is a very pale greenish blue."
    benchmark = spark.createDataFrame([(1, question)], "item_id bigint, text string")
    long = " ".join(f"word{i % 9973}" for i in range(330000))
    more = spark.createDataFrame([(70, f"{long} {question} end"), (71, long), (72, question), (72, question)], "doc_id bigint, text string")
    extra = [c for c in odd.columns if c not in ("doc_id", "text", "lang", "source")]
    docs = odd.unionByName(more.withColumns({c: F.lit(c) for c in extra}), allowMissingColumns=True)
    assert docs.columns == odd.columns
    out = decontam.leaked_items(docs.withColumn("contaminated", F.lit("x")), benchmark)
    assert sorted(out.columns) == sorted([*odd.columns, "items", "contaminated"])
    assert sorted(r.doc_id for r in out.where("contaminated").collect()) == [70, 72, 72]
    kept = decontam.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == odd.count() + 1


def test_folding():
    assert toxicity.fold("1d10T 1diоt ｉｄｉｏｔ id\u200biot cost $5 idiot$$$") == "idiot idiot idiot idiot cost $5 idiot$$$"
    model = toxicity.Model({"idiot ": 5.0, "vequ": 4.0, "clown ": 4.5})
    hits = toxicity.Matcher(model).hits
    assert hits("you idiot!") == [5.0] and hits("idiotic") == [] and hits("vequet xvequ") == [4.0]
    assert hits("the class clown and a clown") == [4.5]


def test_toxicity_learns(spark, odd):
    base = [f"plain words number {i} with more of them {i * 7}" for i in range(300)]
    rows = [(i, base[i] + (" blarg" if i % 4 == 0 else "") + (" zorkling" if i % 4 == 1 and i % 3 else ""), int(i % 4 == 0))
            for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows] + [(0, 1, 0), (None, 1, 1), (1, 1, None)],
                                   "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model)
    got = {r.doc_id: r.predicted for r in scored.collect()}
    assert got == {i: int(i % 4 == 0) for i in range(300)}
    odd_scores = toxicity.score(odd, model).collect()
    assert len(odd_scores) == odd.count() and all(0 <= r.score <= 1 for r in odd_scores)
    alone = toxicity.train(docs, labels.where("toxic = 0"))
    assert toxicity.Matcher(alone).hits("an idiot") == [toxicity.SEED_WEIGHT]


def test_held_out_labels_are_never_read(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = toxicity.held_out(labels.doc_id)
    changed = labels.withColumn("toxic", F.when(held, 1 - labels.toxic).otherwise(labels.toxic))
    assert toxicity.train(documents, labels) == toxicity.train(documents, changed)


def test_copies_of_a_labelled_row_teach_once(spark):
    rows = [(i, f"plain words number {i}" + (" blarg" if i % 4 == 0 else "")) for i in range(120)]
    hot = next(r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    once, often = (toxicity.train(spark.createDataFrame(x, "doc_id bigint, text string"), labels) for x in (rows, rows + [hot] * 900))
    assert once == often
