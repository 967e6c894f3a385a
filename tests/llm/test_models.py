"""Language-model scoring, language identification and quality against plain versions."""

import base64
import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from termdex.llm import langid, lm_score, quality, queries

ROWS = [
    (0, "The cat sat on the mat", "en"),
    (1, "the cat sat on the hat", "en"),
    (2, None, None),
    (3, "", "en"),
    (4, "le chat est sur le tapis", "fr"),
    (5, "le chien est sur le lit", "fr"),
    (6, "the the the the", "en"),
    (7, "Été \U0001f642 the cat\tsat\n\x0bon", "fr"),
    (8, "the cat sat on the mat", "en"),
    (8, "the cat sat on the mat", "en"),
    (None, "the dog", "en"),
    (9, "12 34 ...", "en"),
    (10, "unseen words only here " * 3000, "en"),
]


@pytest.fixture()
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    # columns whose names the operators use themselves
    return df.withColumns({c: F.lit("x") for c in ("block", "held_out", "score", "n", "data")})


def words(text):
    return (text or "").encode().lower().split() + [b" end"]


def held(doc_id, parts, k=2):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts == k


def plain_scores(rows, order, prior):
    """Scores by the recursive definition, without states."""
    counts = [collections.Counter() for _ in range(order + 1)]
    train = [words(t) for i, t, _ in rows if not held(i, 7)]
    for w in train:
        w = [b" start", *w]
        for n in range(1, order + 1):
            for k in range(len(w) - n + 1):
                if n > 1 or k:
                    counts[n][tuple(w[k : k + n])] += 1
    one = counts[1]
    total, distinct = sum(one.values()), len(one)
    once, twice = sum(c == 1 for c in one.values()), sum(c == 2 for c in one.values())
    d = (once + 1) / (once + 2 * twice + 2)
    context = lambda h: len(train) if h == (b" start",) else counts[len(h)][h]

    def p(h, w):
        if not h:
            c = one[(w,)]
            return (c - d) / total if c else (d * distinct / total if distinct else 1.0)
        return (counts[len(h) + 1][(*h, w)] + prior * p(h[1:], w)) / (context(h) + prior)

    out = []
    for i, t, _ in rows:
        w = words(t)
        s = [b" start", *w]
        score = sum(math.log10(p(tuple(s[max(0, k - order + 1) : k]), s[k])) for k in range(1, len(s)))
        base = sum(math.log10((one[(x,)] + 1) / (total + distinct + 1)) for x in w)
        out.append((-1 if i is None else i, held(i, 7), len(w), sum(one[(x,)] > 0 for x in w), total, round(base, 6), round(score, 6)))
    return sorted(out)


@pytest.mark.parametrize(("order", "block_bytes"), [(1, 1 << 20), (2, 1 << 20), (2, 200), (3, 500), (3, 1), (3, 60), (4, 1), (4, 1 << 20)])
def test_scores_match_the_definition(docs, order, block_bytes):
    got = lm_score.score(docs, order=order, prior=2.0, block_bytes=block_bytes).collect()
    got = sorted((-1 if r[0] is None else r[0], *r[1:5], round(r[5], 6), round(r[6], 6)) for r in got)
    assert got == plain_scores(ROWS, order, 2.0)


def test_registered_order_has_contexts_of_two_words(spark, tmp_path):
    rows = [(i, "a b c", "en") for i in range(3, 50) if not held(i, 7)] + [(100, "a b d", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    train = [[b" start", *words(t)] for i, t, _ in rows if not held(i, 7)]
    grams = collections.Counter(tuple(w[k : k + n]) for w in train for n in (1, 2, 3) for k in range(len(w) - n + 1))
    one = {g[0]: c for g, c in grams.items() if len(g) == 1 and g != (b" start",)}
    once, twice = sum(c == 1 for c in one.values()), sum(c == 2 for c in one.values())
    d = (once + 1) / (once + 2 * twice + 2)

    def p(h, w):
        if not h:
            return (one[w] - d) / sum(one.values())
        m = {1: 300.0, 2: 3.0}[len(h)]
        return (grams[(*h, w)] + m * p(h[1:], w)) / (grams[h] + m)

    for r in queries.op1_lm_score(spark, str(tmp_path)).collect():
        s = [b" start", *words(dict((i, t) for i, t, _ in rows)[r.doc_id])]
        assert r.score == pytest.approx(sum(math.log10(p(tuple(s[max(0, k - 2) : k]), s[k])) for k in range(1, len(s))))


def test_many_equal_rows_fill_many_blocks(spark):
    """10,000 rows without an id and with one text: no block grows beyond its bytes."""
    text = "the same line of boilerplate in every row"
    df = spark.createDataFrame([(None, text)] * 10_000 + [(1, "another line")], "doc_id long, text string")
    kind = lm_score.to_arrow_type(df.schema["doc_id"].dataType)
    rows = df.withColumn("held_out", F.lit(False)).select("doc_id", "held_out", "text")
    packed = rows.mapInArrow(lm_score._blocks(4096, kind), "docs array<long>, held binary, lengths binary, tokens binary, vocab binary")
    assert packed.agg(F.max(F.size("docs"))).first()[0] <= 4096 // len(text) + 1
    got = lm_score.score(df, block_bytes=4096)
    assert got.count() == 10_001 and got.filter("doc_id is null").select("score", "train_tokens").distinct().count() == 1
    want = lm_score.score(df, block_bytes=1 << 30).filter("doc_id = 1").first()
    assert got.filter("doc_id = 1").first() == want


def test_long_ngrams_move_only_with_their_context():
    """What a block asks for of three words: those whose two-word context another block has too."""
    import numpy as np

    texts = ["a b c d", "x y z"]
    per_text, vocab = lm_score.word_ids(texts)
    end = np.array([len(vocab)])
    tokens = np.concatenate([y for x in per_text for y in (x, end)])
    lengths = np.array([len(x) + 1 for x in per_text])
    grams = lm_score._Grams(tokens, lengths, lm_score.hashes([*vocab, lm_score.END]), 3)
    words = [*(v.decode() for v in vocab), "."]
    spelled = lambda level: [" ".join(words[tokens[k]] for k in range(max(0, at - level + 1), at + 1)) for at in grams.rep[level - 1]]
    shared = [np.ones(len(grams.uniq[0]), bool), np.array([s in ("b c", "x y") for s in spelled(2)])]
    moved = lm_score._moved(grams, shared, 3)
    assert {s for s, m in zip(spelled(3), moved.tolist(), strict=True) if m} == {"b c d", "x y z"}


def test_packed_numbers():
    import numpy as np

    for x in ([], [0], [1, 255], [256, 3], [1 << 40, 7], [(1 << 64) - 1, 0]):
        a = np.array(x, np.uint64)
        got, used = lm_score._from_planes(memoryview(lm_score._planes(a) + b"more"), len(a))
        assert got.tolist() == x and used == len(lm_score._planes(a))


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(50) if held(i, 7)]
    df = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm_score.score(df).collect()} == {(3, 0, 0, 0.0, 0.0)}
    assert lm_score.score(df.filter("false")).count() == 0


def test_model_beats_the_base_on_held_out_text(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm_score.score(df).filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert r[1] > r[0]


def plain_profile(texts):
    c = collections.Counter()
    for t in texts:
        run = "".join(x.lower() if x.isalpha() else " " for x in t).split()
        s = " " + " ".join(run) + " " if run else ""
        for n in (1, 2, 3):
            c.update(s[k : k + n] for k in range(len(s) - n + 1) if s[k : k + n] != " ")
    key = lambda g: sum(ord(x) << (21 * (len(g) - 1 - i)) for i, x in enumerate(g))
    return [g for g, _ in sorted(c.items(), key=lambda p: (-p[1], key(p[0])))[: langid.PROFILE]]


def test_languages_match_plain_rank_order(docs):
    train = collections.defaultdict(list)
    for i, t, lang in ROWS:
        if not held(i, 4) and t and lang:
            train[lang].append(t)
    profiles = {k: plain_profile(v) for k, v in train.items()}
    want = []
    for i, t, _ in ROWS:
        own = plain_profile([t or ""])
        if not own:
            want.append((-1 if i is None else i, held(i, 4), "und", 0.0))
            continue
        off = {k: sum(abs(p.index(g) - r) if g in p else langid.PROFILE for r, g in enumerate(own)) for k, p in profiles.items()}
        best = min(sorted(off), key=off.get)
        want.append((-1 if i is None else i, held(i, 4), best, round(1 - off[best] / (langid.PROFILE * len(own)), 9)))
    got = [(-1 if r[0] is None else r[0], r[1], r[2], round(r[3], 9)) for r in langid.identify(docs).collect()]
    assert sorted(got) == sorted(want)


def test_long_texts_are_counted_in_windows(monkeypatch):
    text = "Ab cé" * 40
    whole = langid.gram_counts(text, langid._table())
    monkeypatch.setattr(langid, "WINDOW_CHARS", 7)
    parts = langid.gram_counts(text, langid._table())
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_language_edges(spark, docs):
    assert langid.identify(docs.filter("false")).count() == 0
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(none).collect()} == {"und"}


def test_texts_without_a_letter_are_und(spark, docs):
    odd = ["\u26a0\ufe0f 123", "\u2764\ufe0f", "\u0301", "\U0001f642 \u20e3", "12 \u0300\u0301 34", "", None]
    df = docs.select("doc_id", "text", "lang").union(spark.createDataFrame([(100 + k, t, "en") for k, t in enumerate(odd)] + [(200, "e\u0301t\u0301", "en")], "doc_id long, text string, lang string"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df).collect()}
    assert {got[100 + k] for k in range(len(odd))} == {("und", 0.0)}
    assert got[200][0] != "und"


def test_held_out_languages(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = langid.identify(df).join(df.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert r.filter("lang = lang_pred").count() >= 0.99 * r.count()


def test_foreign_and_random_texts_are_rejected(spark):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(n))
    foreign = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
        "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền.",
        "xqzj zzxq", letters(60), letters(1500), base64.b64encode(rng.randbytes(1200)).decode(), "12 34", None,
    ]
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null")
    m = langid.learn(df)
    assert df.filter(~langid.accepted(spark, m, F.col("text"))).count() == 0
    short = df.select(F.regexp_extract("text", r"^\s*(?:\S+\s+){4}", 0).alias("text")).filter(F.col("text").rlike("(?:[a-z]+ ){3}"))
    assert short.filter(langid.accepted(spark, m, F.col("text"))).count() >= 0.99 * short.count() > 0
    planted = spark.createDataFrame([(t,) for t in foreign], "text string")
    assert [r.text for r in planted.filter(langid.accepted(spark, m, F.col("text"))).collect()] == []


def test_quality_on_held_out_labels(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality.assess(df, labels, F.col("source"), F.col("lang")).join(labels, "doc_id").filter("held_out")
    rows = got.select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_sparse_sites_shrink_to_their_parents(spark, monkeypatch):
    monkeypatch.setattr(quality, "STRENGTH", (4.0, 4.0))
    rows = [(i, "some text here", "big", "a") for i in range(20)] + [(100, "some text here", "big", "b"), (101, "some text here", "lone", None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string, p string").withColumn("score", F.lit(0))
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(20)] + [(100, 0), (5, 0), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.assess(docs, labels, F.col("h"), F.col("p"), folds=1, held_fold=1).collect()}
    assert len(got) == 23
    label = {i: float(max(int(i % 4 > 0), 0)) for i in range(20)} | {100: 0.0}
    rate = (sum(label.values()) + 0.5) / (len(label) + 1)
    own = label | {101: got_own(got[101], rate), None: got_own(got[None], rate)}
    whole = (sum(own.values()) + 0.5) / (len(own) + 1)
    host = {"big": list(range(20)) + [100], "lone": [101], None: [None]}
    path = {("big", "a"): list(range(20)), ("big", "b"): [100], ("lone", None): [101], (None, None): [None]}
    for i, r in got.items():
        h = host[r.host]
        hr = (sum(own[k] for k in h) - own[i] + 4 * whole) / (len(h) - 1 + 4)
        g = path[r.host, r.path]
        pr = (sum(own[k] for k in g) - own[i] + 4 * hr) / (len(g) - 1 + 4)
        assert r.host_rate == pytest.approx(hr, abs=1e-6) and r.path_rate == pytest.approx(pr, abs=1e-6)
        assert r.score == pytest.approx(1 / (1 + math.exp(-(math.log(pr / (1 - pr)) + r.evidence))), abs=1e-6)


def got_own(r, rate):
    return 1 / (1 + math.exp(-(r.evidence + math.log(rate / (1 - rate)))))


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "a", "h", "p"), (2, "", "h", "p")], "doc_id long, text string, h string, p string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.evidence for r in quality.assess(docs, labels, F.col("h"), F.col("p")).collect()} == {0.0}
    assert quality.assess(docs.filter("false"), labels, F.col("h"), F.col("p")).count() == 0


def test_url_levels(spark):
    urls = ["http://Www.Example.com:80/a/b?x#y", "https://u@host/", "https://host", "no url", None, "http://h/?q=/z"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(*quality.url_levels(F.col("url")))
    assert [tuple(r) for r in df.collect()] == [("www.example.com", "a"), ("host", None), ("host", None), (None, None), (None, None), ("h", None)]
