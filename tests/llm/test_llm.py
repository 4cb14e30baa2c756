"""The training-data operators against brute force, round trips and held-out accuracy on small tables."""

import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from factloom.llm import bpe, chat, decontaminate, embeddup, langid, lm, neardup, quality, tokencount, toxicity
from factloom.llm.queries import ORACLE_SQL, QUERIES, token_digests, tokenizer_path
from pyspark.sql import functions as F

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ODD = [(1, None), (2, ""), (3, " \n "), (4, "a"), (5, "One two three four five six seven."), (5, "One two three four five six seven."), (None, "x y z"), (7, "é" * 500 + " 日本 <|endoftext|> it's"), (8, "ab " * 3000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 0.5, 1) for i, t in ODD], "doc_id long, text string, score double, ids int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_scores_of_odd_rows(spark, odd, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    for op, target in ((quality, "quality"), (toxicity, "toxic")):
        for model in (op.train(docs, labels, F.lit(True), target), op.train(docs, labels, F.lit(False), target)):
            got = op.score(odd, model).collect()
            assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
            assert not op.score(odd.limit(0), model).collect()


def test_language_of_code_switched_words():
    import pyarrow as pa

    en, de = "the cat and this house with", "der hund und das haus mit"
    model = langid.fit(pa.array([" ".join([x] * 5) for _ in range(20) for x in (en, de)]), ["en", "de"] * 20)
    buf = np.frombuffer(f"{en} {de}".encode(), np.uint8)
    _, post = model.words(buf, np.array([0, len(buf)]))
    assert [model.langs[i] for i in post.argmax(1)] == ["en"] * 6 + ["de"] * 6


def test_word_labels_of_a_table(spark, docs):
    texts = [("der hund und das haus", "de"), ("the cat and this house", "en")]
    known = spark.createDataFrame([(i, *texts[i % 2]) for i in range(40)], "doc_id long, text string, lang string")
    model = langid.train(known, F.lit(True))
    odd = spark.createDataFrame([(1, "The Cat und das haus."), (2, None), (3, ""), (4, "123 !")], "doc_id long, text string")
    got = {r.doc_id: [(w.word, w.lang) for w in r.words] for r in langid.label_words(odd, model).collect()}
    assert got == {1: [("the", "en"), ("cat", "en"), ("und", "de"), ("das", "de"), ("haus", "de")], 2: [], 3: [], 4: []}
    assert all(0.5 < w.probability <= 1 for r in langid.label_words(odd, model).collect() for w in r.words)
    none = langid.train(known.limit(0), F.lit(True))
    assert {w.lang for r in langid.label_words(odd, none).collect() for w in r.words} == {"und"}


def test_one_ftrl_step_by_hand():
    # three features, two texts in one batch: z, q and w after the step, as the recursion has them
    rows, y = [np.array([0, 1]), np.array([1, 2])], np.array([1.0, 0.0])
    w, bias = toxicity.ftrl(rows, y, 3, alpha=0.5, beta=1.0, l1=0.1, l2=0.2, epochs=1, batch=2)
    start = np.log((0.5 + 1e-3) / (0.5 + 1e-3))
    p = 1 / (1 + np.exp(-start))
    g = np.array([p - 1, (p - 1) + p, p])
    root = np.sqrt(g * g)
    z = g - (root - 0) / 0.5 * 0
    want = np.where(np.abs(z) <= 0.1, 0, (np.sign(z) * 0.1 - z) / ((1.0 + root) / 0.5 + 0.2))
    assert np.allclose(w, want) and w[1] == 0 and w[0] > 0 > w[2] and np.isclose(bias, start)


def test_sparse_margins_equal_direct_sums(spark, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = toxicity.train(docs, labels, F.lit(True))
    weight = dict(zip(model.keys.tolist(), model.values.tolist()))
    rows = docs.select("doc_id", "text").limit(60)
    got = {r.doc_id: r.score for r in toxicity.score(rows, model).collect()}
    for r in rows.collect():
        raw = np.frombuffer(r.text.encode(), np.uint8)
        _, h = toxicity.features(raw, np.array([0, len(raw)]))
        margin = model.bias + sum(weight.get(k, 0.0) for k in set(h.tolist()))
        assert np.isclose(got[r.doc_id], 1 / (1 + np.exp(-margin)))


def test_additive_tables_equal_direct_sums():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)  # a pair decides, no single feature does
    model = quality.fit(x, y, bins=16, coarse=8, rounds=20, n_pairs=2, pair_rounds=40)
    fresh = rng.normal(size=(300, 3))
    for row, got in zip(fresh, model.margin(fresh)):
        want = model.base + sum(model.tables[f][sum(v >= edge for edge in model.edges[f])] for f, v in enumerate(row))
        want += sum(t[sum(row[a] >= e for e in model.coarse[a]), sum(row[b] >= e for e in model.coarse[b])] for (a, b), t in zip(model.pairs, model.pair_tables))
        assert np.isclose(got, want)
    assert ((model.score(fresh) >= 0.5) == ((fresh[:, 0] > 0) ^ (fresh[:, 1] > 0.3))).mean() > 0.9
    # the gain of a tree's first cut is the best of all cuts
    g, h = rng.normal(size=12), rng.uniform(3, 4, size=12)
    tree = quality._shallow_tree(g, h, 2, 1.0, 2.0)
    gain = [g[:m].sum() ** 2 / (h[:m].sum() + 1) + g[m:].sum() ** 2 / (h[m:].sum() + 1) for m in range(1, 12)]
    m = int(np.argmax(gain)) + 1
    assert np.allclose(tree, np.repeat([g[:m].sum() / (h[:m].sum() + 1), g[m:].sum() / (h[m:].sum() + 1)], [m, 12 - m]))


def test_forward_backward_is_exact():
    rng = np.random.default_rng(2)
    n, k = 300, 3
    scores, trans = rng.normal(size=(n, k)), rng.normal(size=(k, k))
    chain = np.repeat([0, 1, 2], [1, 200, 99])
    post, _ = langid.forward_backward(scores, chain, trans)
    for c in range(3):
        s, a = np.exp(scores[chain == c]), np.exp(trans)
        f, b = [s[0]], [np.ones(k)]
        for x in s[1:]:
            f.append((f[-1] @ a) * x / 10)
        for x in s[:0:-1]:
            b.append(a @ (x * b[-1]) / 10)
        p = np.array(f) * np.array(b[::-1])
        assert np.allclose(post[chain == c], p / p.sum(1, keepdims=True))


def test_languages_of_odd_rows(spark, odd, docs):
    got = {r.doc_id: r for r in langid.predict(odd, langid.train(docs, F.lit(True), 60)).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[5].lang_pred != "und"


def test_token_counts(spark, odd):
    pieces = tokencount.Pieces.from_sentencepiece(tokenizer_path("piece_bpe_32k.model"))
    got = Counter((r.doc_id, r.n_tokens, r.n_words) for r in tokencount.token_counts(odd, pieces).collect())
    words = [[w for w in re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode())] for _, t in ODD]
    want = Counter((i, sum(tokencount.count_plainly("▁".encode() + w, pieces) for w in ws), len(ws)) for (i, _), ws in zip(ODD, words))
    assert got == want


def test_lm_base_by_brute_force(spark, docs):
    rows = docs.limit(80).toPandas()
    got = lm.score(spark.createDataFrame(rows[["doc_id", "text"]]), F.col("doc_id") % 3 != 0, block_bytes=20_000).toPandas().set_index("doc_id")
    texts = {i: re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) + [None] for i, t in zip(rows.doc_id, rows.text)}
    count = Counter(w for i, ws in texts.items() if i % 3 for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in texts.items():
        assert got.n_tokens[i] == len(ws) and got.n_known[i] == sum(count[w] > 0 for w in ws) and got.train_tokens[i] == n
        assert np.isclose(got.base_score[i], sum(np.log10((count[w] + 1) / (n + v + 1)) for w in ws))
    assert got.score.sum() > got.base_score.sum()


def test_lm_score_and_weights_by_brute_force(spark, docs):
    rows = docs.limit(60).toPandas()
    got = lm.score(spark.createDataFrame(rows[["doc_id", "text"]]), F.col("doc_id") % 3 != 0, block_bytes=20_000).toPandas().set_index("doc_id")
    texts = {i: re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) + ["</s>"] for i, t in zip(rows.doc_id, rows.text)}
    train = {i: ws for i, ws in texts.items() if i % 3}
    grams = lambda ws: zip(["<s>", "<s>", *ws], ["<s>", *ws], ws)
    one = Counter(w for ws in train.values() for w in ws)
    three = Counter(g for ws in train.values() for g in grams(ws))
    two = Counter(g[1:] for ws in train.values() for g in grams(ws))
    first, second = one | Counter({"<s>": len(train)}), two | Counter({("<s>", "<s>"): len(train)})
    n, v = sum(one.values()), len(one)
    bucket = lambda c: c if c < 8 else 5 + c.bit_length() - 1
    share_of = lambda count, context, held: max(count - held, 0) / (context - held) if context > held else 0.0
    rough = lambda p: 2.0 ** (np.clip(np.rint(np.log2(p) * 4) + 160, 1, 160) / 4 - 40) if p > 0 else 0.0

    def em(at, estimates, start):
        weights = np.tile(start, (lm.BUCKETS, 1))
        for _ in range(60):
            share = weights[at] * estimates
            share /= share.sum(1, keepdims=True)
            weights = np.array([share[at == b].sum(0) + 0.001 for b in range(lm.BUCKETS)])
            weights /= weights.sum(1, keepdims=True)
        return weights

    held = [g for ws in train.values() for g in grams(ws)]
    low = em(np.array([bucket(first[b]) for _, b, _ in held]), np.array([[rough(share_of(two[b, w], first[b], 1)), rough(share_of(one[w], n, 1)), 1 / (v + 1)] for _, b, w in held]), [0.5, 0.4, 0.1])
    pairs = lambda b, w, out: low[bucket(first[b])] @ [share_of(two[b, w], first[b], out), share_of(one[w], n, out), 1 / (v + 1)]
    high = em(np.array([bucket(second[a, b]) for a, b, _ in held]), np.array([[rough(share_of(three[g], second[g[:2]], 1)), rough(pairs(*g[1:], 1))] for g in held]), [0.5, 0.5])
    for i, ws in texts.items():
        want = sum(np.log10(high[bucket(second[a, b])] @ [share_of(three[a, b, w], second[a, b], 0), pairs(b, w, 0)]) for a, b, w in grams(ws))
        assert np.isclose(got.score[i], want, rtol=1e-6)


def test_counts_of_any_size_survive_packing():
    n = np.array([0, 1, 254, 255, 256, 2**32, 2**40], np.int64)
    assert lm._unpack_counts(lm._pack_counts(n)).tolist() == n.tolist() and not len(lm._unpack_counts(lm._pack_counts(n[:0])))
    for k in range(len(n) + 1):
        assert lm._unpack_text(lm._pack_text(n[:k])).tolist() == n[:k].tolist()


def test_lm_of_odd_rows(spark, odd):
    assert lm.score(odd, F.lit(True)).count() == len(ODD)
    assert lm.score(odd.limit(0), F.lit(True)).count() == 0


def test_chat_by_sql(spark):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    want = db.sql(ORACLE_SQL["op6_chat_perspectives"]).df().sort_values(["conv_id", "speaker", "part"]).reset_index(drop=True)
    got = QUERIES["op6_chat_perspectives"](spark, DATA).toPandas().sort_values(["conv_id", "speaker", "part"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_decontamination(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    item = text(40)
    edited = [w if rng.random() > 0.15 else "other" for w in item]
    rows = [(1, " ".join(text(300))), (2, " ".join(text(50) + item + text(90))), (3, " ".join(text(20) + edited + text(5)).upper()), (4, None), (5, "")]
    d, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(9, " ".join(item)), (8, None), (7, "")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.matches(d, b).collect()}
    assert set(got) == {2, 3} and got[2].similarity == 1.0 and got[2].item_id == 9
    assert {r.doc_id for r in decontaminate.clean(d, b).collect()} == {1, 4, 5}
    assert decontaminate.matches(d, b.limit(0)).count() == 0 and decontaminate.matches(d.limit(0), b).count() == 0


def test_short_items_match_as_whole_runs(spark):
    d = spark.createDataFrame([(1, "one two three"), (2, "one x two three four"), (3, "say: Two, three; four!"), (4, "four"), (5, None)], "doc_id long, text string")
    b = spark.createDataFrame([(7, "two three four"), (8, "four"), (9, "..."), (None, None)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(d, b).collect()} == {(2, 7), (2, 8), (3, 7), (3, 8), (4, 8)}
    clash = d.withColumns({"matched": F.lit(1), "whole_text": F.lit("a")})
    assert [tuple(r) for r in decontaminate.clean(clash, b).orderBy("doc_id").collect()] == [(1, "one two three", 1, "a"), (5, None, 1, "a")]


def test_edited_copies_against_smith_waterman_of_all_pairs(spark):
    def similarity(a, b):
        best, row = 0.0, [0.0] * (len(b) + 1)
        for x in a:
            last, row = row, [0.0]
            for j, y in enumerate(b):
                row.append(max(0.0, last[j] + (1 if x == y else -0.5), last[j + 1] - 0.5, row[j] - 0.5))
            best = max(best, *row)
        return best / len(a)

    rng = random.Random(8)
    text = lambda n: [f"w{int(1500 * rng.random() ** 2)}" for _ in range(n)]
    items = {i: text(n) for i, n in enumerate([40, 15, 15, 23, 40, 59, 5])}
    docs = {1: text(30) + [w if j % 5 else "other" for j, w in enumerate(items[0])] + text(60)}  # the only copy of item 0
    for i, item in list(items.items())[1:]:
        for share in (0.15, 0.25, 0.35, 0.45):
            edited = [x for w in item for x in ([w] if rng.random() > share else rng.choice([[], ["other"], [w, "more"]]))]
            docs[len(docs) + 1] = text(rng.randint(0, 300)) + edited + text(rng.randint(0, 50))
        docs[len(docs) + 1] = [x for w in item for x in (w, "more")]
        docs[len(docs) + 1] = [w if j % 3 else "other" for j, w in enumerate(item, 2)]
    want = {(d, i): s for d, words in docs.items() for i, item in items.items() if (s := similarity(item, words)) >= 0.5}
    d = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.matches(d, b).collect()}
    assert (1, 0) in want and got == pytest.approx(want)
    assert {r.doc_id for r in decontaminate.clean(d, b).collect()} == set(docs) - {k for k, _ in want}


def test_bpe_equals_the_library(spark, odd):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    own, library = bpe.Encoder(open(path, "rb").read()), Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    rng = random.Random(5)
    alphabet = "aAbcdeEinthorsäÉß'’sS tTrREl 0129½Ⅷ!?#<|>\x1c\x85​﻿ Σσİı日本é한🙂\n\t"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [t or "" for _, t in ODD]
    count, ids = own.encode(texts)
    decoded, ends = own.decode(count, ids), np.cumsum(count)
    for t, n, e, d in zip(texts, count, ends, decoded):
        want = library.encode(t, add_special_tokens=False).ids
        assert ids[e - n : e].tolist() == want, t
        assert d == library.decode(want, skip_special_tokens=False)
    made = bpe.encode(odd, path, decoded=True)
    again = bpe.decode(made.drop("decoded"), path)
    assert sorted(r.decoded for r in made.collect()) == sorted(r.decoded for r in again.collect())
    assert token_digests(made).count() == len(ODD)


def test_near_duplicates_by_brute_force(spark, docs):
    rows = docs.select("doc_id", "text").limit(150).toPandas()
    got = neardup.near_duplicates(spark.createDataFrame(rows)).toPandas().set_index("doc_id")
    units = {i: Counter(tuple(w[j : j + 5]) for w in [t.lower().split()] for j in range(max(1, len(w) - 4))) for i, t in zip(rows.doc_id, rows.text)}
    top = {i: i for i in units}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in units:
        for j in units:
            if i < j and (both := sum((units[i] & units[j]).values())) >= 0.8 * sum((units[i] | units[j]).values()):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    assert all(got.class_id[i] == find(i) for i in units)


def test_near_duplicates_of_a_large_family_by_brute_force(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(400):  # two texts changed in the same places are alike (0.8 and over); all others are not
        at = rng.sample(range(0, 300, 5), 6)
        for side in range(2):
            texts.append([f"x{i}.{side}.{j}" if j in at else w for j, w in enumerate(base)])
    grams = [{tuple(t[j : j + 5]) for j in range(len(t) - 4)} for t in texts]
    number = {}
    x = np.zeros((len(texts), len(set().union(*grams))), np.float32)
    for i, g in enumerate(grams):
        x[i, [number.setdefault(k, len(number)) for k in g]] = 1
    both = x @ x.T
    near = both >= 0.8 * (x.sum(1)[:, None] + x.sum(1)[None, :] - both)
    want = np.arange(len(texts))
    while (new := np.where(near, want[None, :], len(texts)).min(1)).tolist() != want.tolist():
        want = new
    got = neardup.near_duplicates(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert len(set(want)) >= 300 and {r.doc_id: r.class_id for r in got.collect()} == dict(enumerate(want.tolist()))


def test_near_duplicates_of_odd_rows(spark, odd):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == len(ODD) and {r.class_id for r in got if r.doc_id == 1} == {1}
    assert neardup.keep_one(odd).filter("doc_id = 5").count() == 1
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


def test_texts_under_one_id_stay_apart(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    near = a.replace("a29", "z")
    rows = [(5, a, 1), (5, b, 2), (5, b, 3), (6, near, 4), (8, b, 5), (None, a, 6), (None, a, 7), (9, None, 8), (9, None, 9), (10, None, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key long")
    got = {r.text_key for r in neardup.keep_one(docs).collect()}
    assert {6, 7, 10} <= got and len(got & {8, 9}) == 1 and len(got & {2, 3}) == 1 and 5 not in got and len(got & {1, 4}) == 1
    groups = neardup.near_duplicates(docs)
    assert groups.count() == len(rows) and len({r.class_id for r in groups.filter("doc_id is not null").collect()}) == 4


def test_near_duplicates_that_tie_and_very_long_texts(spark):
    long = [f"w{i * i % 997}.{i}" for i in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-1000])), (3, " ".join(long[30_000:])), (4, "x " * 50_000), (5, "x " * 45_000), (6, "x " * 20_000)]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6}


def test_embeddings_by_brute_force(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 16))
    x[40:80] = x[0] + 0.05 * rng.normal(size=(40, 16))
    x[80] = x[1]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (None, [1.0] * 16)]
    got = {r.vec_id: r for r in embeddup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=6).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    assert len(got) == 124 and all(got[i].n_links == near[i].sum() - 1 for i in range(120))
    assert got[45].component_id == 0 and got[80].component_id == 1 and got[201].n_links == 0 and got[None].component_id is None


def linked(x):
    """(links of each row, least row that it reaches) by brute force."""
    unit = x / np.abs(x).max(1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    root = np.arange(len(x))
    while (new := np.where(near, root[None, :], len(x)).min(1)).tolist() != root.tolist():
        root = new
    return near.sum(1) - 1, root


def test_embeddings_of_any_magnitude_and_under_one_id(spark):
    x = np.array([[1e-200, 2e-200], [5, 1], [1e200, 2e200], [1, 2], [1e-200, 0], [-1, 5]])
    table = lambda rows: spark.createDataFrame([(i, [float(v) for v in r]) for i, r in rows], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddup.near_duplicates(table(enumerate(x))).collect()}
    n, root = linked(x)
    assert got == {i: (n[i], root[i]) for i in range(len(x))}
    same = embeddup.near_duplicates(table([(7, [1.0, 0.0]), (7, [0.0, 1.0]), (7, [0.0, 1.0]), (8, [0.0, 1.0])])).collect()
    assert sorted(r.n_links for r in same) == [0, 2, 2, 2] and len({r.component_id for r in same}) == 2
    assert embeddup.near_duplicates(table([])).count() == 0


def test_embeddings_refined_and_in_large_components(spark):
    rng = np.random.default_rng(11)
    pairs = rng.normal(size=(900, 24))
    chain = [rng.normal(size=24)]
    for _ in range(500):  # each is near the one before, the ends are not near each other
        step = rng.normal(size=24)
        chain.append(chain[-1] / np.linalg.norm(chain[-1]) + 0.3 * step / np.linalg.norm(step))
    cloud = rng.normal(size=24) + 0.08 * rng.normal(size=(700, 24))
    noise = rng.normal(size=(900, 24))
    x = np.concatenate([pairs, pairs + 0.38 * noise / np.linalg.norm(noise, axis=1, keepdims=True) * np.linalg.norm(pairs, axis=1, keepdims=True), chain, cloud])
    got = embeddup.near_duplicates(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")).toPandas().set_index("vec_id").sort_index()
    n, root = linked(x)
    assert (got.n_links.to_numpy() <= n).all()
    some = n > 0
    recall = (got.n_links.to_numpy()[some] / n[some]).mean()
    assert recall >= 0.96 and (got.component_id.to_numpy() >= root).all()
    if recall == 1:
        assert (got.component_id.to_numpy() == root).all()


def test_empty_tables_and_clashing_columns(spark, odd, docs):
    path = tokenizer_path("word_bpe_49k.json")
    pieces = tokencount.Pieces.from_sentencepiece(tokenizer_path("piece_bpe_32k.model"))
    model = langid.train(docs, F.lit(True), 40)
    clash = odd.select("doc_id", "text", *(F.lit(7).alias(c) for c in ("lang_pred", "score", "n_tokens", "n_words", "ids", "decoded", "words", "whole_text", "bands", "digest", "key", "node", "train", "block")))
    for op in (lambda d: langid.predict(d, model), lambda d: langid.label_words(d, model), lambda d: tokencount.token_counts(d, pieces), lambda d: bpe.encode(d, path, decoded=True), neardup.near_duplicates, neardup.keep_one, lambda d: lm.score(d, F.lit(True))):
        assert op(clash.limit(0)).count() == 0
        assert op(clash).count() >= len(ODD) - 1
    kept = tokencount.token_counts(clash, pieces).filter("doc_id = 4").first()
    assert (kept.n_words, kept.whole_text, kept.lang_pred) == (1, 7, 7)


def test_chat_of_odd_rows(spark):
    table = lambda rows: spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert chat.perspectives(table([])).count() == 0 and chat.perspectives(table([(1, 0, "system", "x")])).count() == 0
    got = {(r.conv_id, r.speaker, r.part): r for r in chat.perspectives(table([(1, 0, "a", "hi"), (1, 0, "a", "hi"), (1, 0, "b", None), (1, None, None, "n"), (None, 3, "a", "z"), (1, 256, "b", "y")])).collect()}
    assert set(got) == {(1, s, p) for s in ("a", "b", "unknown") for p in (-1, 0, 1)} | {(None, "a", 0)}
    one = got[1, "a", 0]
    assert one.n_turns == 2 and one.rendered == "<|assistant|>\nhi<|end|>\n<|user name=b|>\n<|end|>\n"
    assert [one.rendered[m.start : m.end] for m in one.mask] == ["hi<|end|>"]


def test_pipeline_by_brute_force(spark):
    """Each stage's decision again for each document: model sums, all pairs, plain alignment, the tokenizers library."""
    from hashlib import sha256

    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    left = docs.select("doc_id", "text").toPandas()
    slice_of = lambda t: (np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
    good = quality.train(docs, labels, corpus_pipeline.fold(3, 1) == False)  # noqa: E712
    left = left[[good.score(quality.features(*slice_of(t)))[0] >= 0.5 for t in left.text]]
    kept = spark.createDataFrame(left)
    toxic = toxicity.train(kept, labels, corpus_pipeline.fold(4, 2) == False)  # noqa: E712
    left = left[[1 / (1 + np.exp(-toxic.margin(*slice_of(t))[0])) < 0.3 for t in left.text]]
    units = [Counter(tuple(w[j : j + 5]) for w in [t.lower().split()] for j in range(max(1, len(w) - 4))) for t in left.text]
    root = list(range(len(left)))
    ids = left.doc_id.tolist()
    for i, a in enumerate(units):
        for j, b in enumerate(units[:i]):
            if sum((a & b).values()) >= 0.8 * sum((a | b).values()) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]), key=lambda k: ids[k])
                root = [low if r == high else r for r in root]
    left = left[[root[i] == i for i in range(len(left))]]
    items = [re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower()) for t in spark.read.parquet(f"{DATA}/benchmark.parquet").toPandas().text]

    def similarity(item, words):
        number = {w: k for k, w in enumerate(dict.fromkeys(item + words))}
        y = np.array([number[w] for w in words])
        row, best, place = np.zeros(len(y) + 1), 0.0, np.arange(len(y) + 1) / 2
        for w in item:
            new = np.maximum(row - 0.5, 0)
            new[1:] = np.maximum(new[1:], row[:-1] + np.where(y == number[w], 1.0, -0.5))
            row = np.maximum.accumulate(new + place) - place
            best = max(best, row.max())
        return best / len(item)

    clean = []
    for t in left.text:
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())
        clean.append(not words or all(similarity(i, words) < 0.5 for i in items))
    left = left[clean]
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    want = {}
    for i, t in zip(left.doc_id, left.text):
        tokens = library.encode(t, add_special_tokens=False).ids
        want[i] = (len(tokens), sha256(" ".join(map(str, tokens)).encode()).hexdigest(), sha256(library.decode(tokens, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, DATA).collect()}
    assert len(got) > 50 and got == want
