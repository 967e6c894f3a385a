"""Pieces, tiling, personal data, chats and token files against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termdex.llm import chat, decontaminate, pieces, pii, token_files

ODD = ["Hello  world\n\tfoo \U0001f642 ▁x", "", " ", "a", "  lead", "trail  ", "x\n\n y", "日本語", "ab" * 100, "é" * 60 + " z", "\0", "▁▁ ▁"]


@pytest.fixture(scope="module")
def model():
    return pieces.public_model()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=5))
def test_pieces_round_trip(texts):
    m = pieces.public_model()
    for t, ids in zip(texts + ODD, m.encoder()(texts + ODD), strict=True):
        assert m.decode(ids.tolist()) == t


def best_score(m, data):
    """Plain Viterbi over a dictionary of pieces."""
    table = {s: m.score[i] for i, s in enumerate(m.surface) if s and m.score[i] < 0}
    best = [float("-inf")] * (len(data) + 1)
    best[0] = 0.0
    for i in range(len(data)):
        if best[i] == float("-inf"):
            continue
        c = data[i]
        end = i + (1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4)
        best[end] = max(best[end], best[i] + m.worst)
        for j in range(i + 1, min(len(data), i + m.longest) + 1):
            if data[i:j] in table:
                best[j] = max(best[j], best[i] + table[data[i:j]])
    return best[-1]


def test_segmentation_is_the_best(model):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("the of and éü\n \U0001f642ing") for _ in range(rng.randint(1, 90))) for _ in range(100)]
    for t, ids in zip(texts, model.encoder()(texts), strict=True):
        if not t:
            continue
        score, at = 0.0, 0
        ids = ids.tolist()
        while at < len(ids):
            s = model.surface[ids[at]]
            if model.score[ids[at]] < 0:
                score, at = score + model.score[ids[at]], at + 1
            else:  # the bytes of one character
                score, at = score + model.worst, at + (1 if s[0] < 0x80 else 2 if s[0] < 0xE0 else 3 if s[0] < 0xF0 else 4)
        assert score == pytest.approx(best_score(model, b" " + t.encode()))


def test_piece_columns(spark, model):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, None])], "ids long, text string")
    got = df.select("text", pieces.encode(spark, model, F.col("text")).alias("p")).withColumn("back", pieces.decode(spark, model, F.col("p"))).collect()
    assert len(got) == len(ODD) + 1
    assert all(r.back == r.text for r in got) and [r.p for r in got if r.text is None] == [None]


def plain_tiles(item, text, least):
    """Greedy tiling by trying all pairs of places."""
    a, b, total = [False] * len(item), [False] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and not a[i + n] and not b[j + n] and item[i + n] == text[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return total
        a[i : i + n], b[j : j + n] = [True] * n, [True] * n
        total += n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=25), st.lists(st.integers(0, 3), max_size=40))
def test_tiles_are_greedy_and_apart(item, text):
    x, y = np.array(item, np.int64), np.array(text, np.int64)
    found = decontaminate.tiles(x, y, 3)
    used_x, used_y = set(), set()
    for n, i, j in found:
        assert n >= 3 and item[i : i + n] == text[j : j + n]
        assert not used_x & set(range(i, i + n)) and not used_y & set(range(j, j + n))
        used_x |= set(range(i, i + n))
        used_y |= set(range(j, j + n))
    # nothing of the least length is left, and the first tile is a longest run
    free = lambda n, used: [k for k in range(n - 2) if not used & {k, k + 1, k + 2}]
    left = {tuple(item[k : k + 3]) for k in free(len(item), used_x)} & {tuple(text[k : k + 3]) for k in free(len(text), used_y)}
    assert not left
    assert bool(found) == bool(plain_tiles(item, text, 3))


BENCH = [(0, "alpha beta gamma delta. epsilon zeta eta theta iota kappa lambda mu"), (1, "one two three"), (2, None), (3, ""), (4, "red orange yellow green blue indigo violet ultra")]
PAGES = {
    "exact": "x y Alpha, beta GAMMA delta epsilon zeta eta theta iota kappa lambda mu z",
    "moved": "iota kappa lambda mu and then epsilon zeta eta theta or alpha beta gamma delta",
    "third": "alpha beta gamma delta only",
    "words": "mu lambda kappa iota theta eta zeta epsilon delta gamma beta alpha",
    "both": "red orange yellow green blue indigo violet ultra / alpha beta gamma delta epsilon zeta eta theta",
    "short": "one two three",
    "none": None,
    "empty": "",
    "long": "noise " * 50_000 + "red orange yellow green blue indigo violet ultra",
}


@pytest.mark.parametrize("max_words", [10_000, 8])
def test_contaminated_pairs(spark, monkeypatch, max_words):
    monkeypatch.setattr(decontaminate, "MAX_WORDS", max_words)
    monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", ("item_id", "text", max_words))
    docs = spark.createDataFrame(list(PAGES.items()) + [("exact", PAGES["exact"])], "doc_id string, text string").withColumn("item_id", F.lit(9))
    bench = spark.createDataFrame(BENCH, "item_id long, text string").withColumn("doc_id", F.lit(9))
    got = sorted((r.doc_id, r.item_id, r.n_tiles) for r in decontaminate.contaminated(docs, bench).collect())
    assert got == [("both", 0, 1), ("both", 4, 1), ("exact", 0, 1), ("exact", 0, 1), ("long", 4, 1), ("moved", 0, 3), ("short", 1, 1)]
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {"third", "words", "none", "empty"}
    assert decontaminate.contaminated(docs, bench.filter("false")).count() == 0
    assert decontaminate.clean(docs, bench.filter("false")).count() == len(PAGES) + 1
    assert decontaminate.contaminated(docs.filter("false"), bench).count() == 0


def test_short_items_and_scripts_without_blanks():
    items = decontaminate.Items([(0, "Why is that?"), (1, "水の沸点は何度ですか"), (2, "地球是行星。"), (3, "!!!"), (4, "Yes"), (5, "กรุงเทพมหานคร"), (6, "two two two")])
    got = lambda t: [(m[0], m[1]) for m in items.match(t, 0.5)]
    assert got("And why is  THAT, then") == [(0, 1.0)] and got("why that is") == []
    # a copy with other text run on to its clauses
    assert got("問題：水の沸点は何度ですか？答えは百度。") == [(1, 1.0)] and got("水は青い") == []
    assert got("我们知道地球是行星吗") == [(2, 1.0)] and got("地球") == []
    assert got("well, yes!") == [(4, 1.0)] and got("yesterday") == []
    assert got("ที่กรุงเทพมหานครนั้น") == [(5, 1.0)]
    assert got("two two") == [] and got("two two two two") == [(6, 1.0)]
    assert got("!!!") == [] and got(None) == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    def valid(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15

    return {k: [m.span() for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in PATTERNS.items()}


HAND = [
    "a@b.c_d@e.f x", "ip 1.2.3.4.5.6.7.8 999.1.1.1 000001.2.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1111-", "5--5 4111111111111111 1",
    "+1 (017) 555-7713, +1 2 ( +49 30 1234567)) x", "\U0001f642 a@b.co \U0001f642 4012888888881881", None, "", "john at example dot com call 555-123-4567",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "x" * 10 + "@" * 5 + "a.b@c.d", " ".join(str(i % 10) for i in range(20_000)), "1." * 9000, "a." * 9000 + "@b.c",
    "+1" + " " * 20_000 + "2 +1 234 567 89 01", "+4111 1111 1111 1111 a@1.2.3.4",
]


def random_texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice("0123456789" * 2 + "4 1.-@+() aé\U0001f642") for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_base_spans_and_redaction(spark):
    texts = HAND + random_texts(1500)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"spans": F.lit(1), "row": F.lit(2)})
    model = pii.fit(docs)
    got = {r.doc_id: r for r in pii.find(docs, model).collect()}
    clean = {r.doc_id: r for r in pii.redact(docs, model).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t)
        listed = [f"{k}:{a}:{b}" for k in PATTERNS for a, b in want[k]]
        assert got[i].base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [len(v) for v in want.values()]
        every = got[i].spans.split(",") if got[i].spans else []
        assert set(listed) <= set(every) and len(every) == len(listed) + got[i].n_added
        assert (clean[i].spans, clean[i].row) == (1, 2)
        merged = []
        for a, b, k in sorted((int(s.split(":")[1]), int(s.split(":")[2]), s.split(":")[0].upper()) for s in every):
            if merged and merged[-1][1] > a:
                merged[-1] = (merged[-1][0], max(merged[-1][1], b), merged[-1][2])
            else:
                merged.append((a, b, k))
        out, at = "", 0
        for a, b, k in merged:
            out, at = out + t[at:a] + f"<{k}>", b
        assert clean[i].text == (None if t is None else out + t[at:])
    assert pii.find(docs.filter("false"), pii.fit(docs.filter("false"))).count() == 0


def test_trees_add_what_looks_like_the_base(spark):
    rng = random.Random(7)
    number = lambda: "".join(rng.choice("0123456789") for _ in range(4))
    rows = [f"call me on the phone +1 ({number()[:3]}) {number()[:3]}-{number()} today" for _ in range(600)]
    rows += [f"order {number()[:3]}.{number()[:3]}/{number()} shipped" for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    model = pii.fit(docs)
    assert model.threshold is not None
    more = spark.createDataFrame([(1, "call me on the phone +1 (555) 123-4567 now"), (2, "order 123.456/7890 shipped")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(more, model).collect()}
    assert got[1].spans == "phone:21:38" and got[2].spans == ""


@pytest.mark.parametrize("share", [0.1, 0.5])
def test_loose_forms_are_added_at_any_share(spark, share):
    rng = random.Random(11)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        body = "4" + digits(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def phone(loose):
        a, b, c = str(rng.randint(200, 989)), digits(3), digits(4)
        return rng.choice([f"{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a}.{b}.{c}"]) if loose else f"+1 ({a}) {b}-{c}"

    def email(loose):
        user, n = "user" + digits(3), digits(1)
        return f"{user} [at] mail{n} [dot] example [dot] com" if loose else f"{user}@mail{n}.example.com"

    def number(loose):
        n = card()
        return ".".join(n[i : i + 4] for i in range(0, 16, 4)) if loose else n

    rows = []
    for kind, make in (("phone", phone), ("email", email), ("card", number)):
        for _ in range(600):
            loose = rng.random() < share
            rows.append((kind if loose else "base", "word " + make(loose) + " word"))
    bad = [f"order {digits(3)}-{digits(3)}-{digits(4)} sent" for _ in range(100)]
    bad += [f"from 20{digits(2)}-0{rng.randint(1, 9)}-1{digits(1)} on" for _ in range(100)] + ["we look at example.com today"] * 100
    dotted = (number(True) for _ in range(100))
    bad += ["word " + n[:-1] + str((int(n[-1]) + 1) % 10) + " word" for n in dotted]
    rows += [("bad", t) for t in bad]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, kind string, text string")
    got = pii.find(docs, pii.fit(docs)).join(docs, "doc_id").collect()
    for r in got:
        if r.kind in ("base", "bad"):
            assert r.n_added == 0, r
        else:
            assert r.spans == f"{r.kind}:5:{len(r.text) - 5}", r


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return pii.fit(docs)


LISTS = [
    "Results 1024 2048 4096 in bytes", "Table: 12 34 56 78 90 rows", "Matrix 100 200 300 400", "Score 3-2 2-1 10-12 14-18",
    "years 1999 2004 2012 and 2020", "sizes 16 32 64 128 256 px", "at 12.30 - 14.45 or 18.00 - 19.15", "ratios 10/20/30/40 and 15/25/35/45",
]


def test_trees_learn_format_and_context(spark, learned):
    """The trees of a real corpus split on many features; number lists add nothing."""
    assert len(learned.features_used()) >= 4 and not {"fails", "against"} & set(pii.FEATURES)
    df = spark.createDataFrame(list(enumerate(LISTS)), "doc_id long, text string")
    assert {r.doc_id: r.spans for r in pii.find(df, learned).collect()} == dict.fromkeys(range(len(LISTS)), "")


def test_forms_that_were_not_taught(spark, learned):
    """Recall on loose forms of the corpus' kinds that ``_forms`` does not write."""
    rng = random.Random(21)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    ways = {
        "phone": [lambda: f"({d(3)})555.{d(4)}", lambda: f"{d(3)}-555.{d(4)}", lambda: f"({d(3)}) 555 {d(4)}", lambda: f"001 {d(3)} 555-{d(4)}"],
        "email": [lambda: f"ab{d(2)} {{at}} mail{d(1)} {{dot}} org", lambda: f"ab{d(2)} AT mail{d(1)} DOT org", lambda: f"ab{d(2)}[at]mail{d(1)}[dot]org"],
    }
    rows = [(kind, "some words " + make() + " and more") for kind, forms in ways.items() for make in forms for _ in range(100)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, kind string, text string")
    found = {}
    for r in pii.find(df, learned).join(df, "doc_id").collect():
        found.setdefault(r.kind, []).append(any(s == f"{r.kind}:11:{len(r.text) - 9}" for s in r.spans.split(",")))
    recall = {k: sum(v) / len(v) for k, v in found.items()}
    assert min(recall.values()) >= 0.9, recall


def test_a_text_of_many_spans(spark, learned):
    """16,000 spans in one text, and four times as many, in time that grows with them."""
    import time

    one = "ann@mail.org, 10.20.30.40, +1 (555) 010-2030, 4111111111111111, 555-010-2030, bob [at] mail [dot] org; "
    took = []
    for n in (500, 2700, 10_800):
        df = spark.createDataFrame([(1, one * n)], "doc_id long, text string")
        start = time.time()
        r = pii.find(df, learned).first()
        took.append(time.time() - start)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (n, n, n, n)
        want = base_spans(one * n)
        listed = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in want[k])
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    assert took[2] - took[0] < 8 * (took[1] - took[0]) + 5, took
    clean = pii.redact(spark.createDataFrame([(1, one * 2700)], "doc_id long, text string"), learned).first().text
    assert clean.count("<EMAIL>") >= 2700 and "@" not in clean and "4111" not in clean


def test_personal_data_runs_no_python(spark):
    docs = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")
    model = pii.fit(docs)
    for df in (pii.find(docs, model), pii.redact(docs, model)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_quotes_link_replies(spark):
    rows = [
        (1, 0, "user", "How do I sort a table by two columns?\nIt has a million rows."),
        (1, 1, "assistant", "Use orderBy with both names, it spills by itself."),
        (1, 2, "user", "Unrelated remark about the weather today."),
        (1, 3, "assistant", "On Monday, user wrote:\n> How do I SORT a table   by two columns?\n> It has a million rows.\n\nHere is another way to do it."),
        (1, 4, "user", "assistant wrote:\n> On Monday, user wrote:\n> > How do I sort a table by two columns?\n> Here is another way to do it.\nThanks a lot for that!"),
        (1, 5, "user", "> nobody ever said this sentence\nI only quote myself."),
        (2, 0, "user", "> How do I sort a table by two columns?\nquoting another conversation"),
        (2, 1, None, None),
        (2, 1, None, None),
        (2, None, "user", "no turn at all here"),
        (None, 0, "user", "a conversation without an id"),
        (None, 1, "user", "> a conversation without an id\nright"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"conv": F.lit(1), "key": F.lit(1), "part": F.lit(2)})
    got = chat.ordered(chat.messages(df)).orderBy("conv", "position").collect()
    links = {(r.conv, r.turn): (r.reply_to, r.thread, r.depth, r.n_quoted, r.n_linked) for r in got}
    assert links[1, 3] == (0, 0, 1, 1, 1)
    assert links[1, 4] == (3, 0, 2, 2, 2)
    assert links[1, 5] == (None, 5, 0, 1, 0)
    assert links[2, 0] == (None, 0, 0, 1, 0)
    assert links[None, 1] == (0, 0, 1, 1, 1)
    assert [r.turn for r in got if r.conv == 1] == [0, 3, 4, 1, 2, 5]
    assert [r.turn for r in got if r.conv == 2] == [None, 0, 1]
    said = {(r.conv, r.turn): r.content for r in got}
    assert said[1, 3] == "Here is another way to do it." and said[1, 4] == "Thanks a lot for that!" and said[2, 1] == ""
    whole = {(r.conv_id, r.part): r for r in chat.chats(chat.ordered(chat.messages(df)), 4).collect()}
    assert whole[1, 0].turns == [0, 3, 4, 1] and whole[1, 1].turns == [2, 5] and whole[1, 0].n_replies == 2
    assert whole[None, 0].chat == "<|user|>\na conversation without an id<|end|>\n<|user|>\nright<|end|>\n"
    assert chat.format_conversations(df.filter("false")).count() == 0


@pytest.mark.parametrize("answers", [False, True])
def test_long_conversations_are_numbered_in_ranges(spark, answers):
    """One conversation, without replies or with all messages answering its first: many tasks, none large."""
    n = 20_000
    quote = F.when((F.col("id") > 0) & F.lit(answers), "> this is the first message\n").otherwise("")
    text = F.when(F.col("id") == 0, "this is the first message").otherwise(F.concat(quote, F.lit("message number "), "id"))
    df = spark.range(n).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), text.alias("text"))
    found = chat.messages(df)
    assert found.filter("thread = 0").count() == (n if answers else 1)
    got = chat.ordered(found)
    assert got.filter("turn = position").count() == n
    sizes = [r["count"] for r in found.withColumn("head", F.substring("content", 1, chat.HEAD)).repartitionByRange(8, "conv", "thread", "turn", "role", "head").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < n / 4


def test_short_passages(spark):
    rows = [
        (0, "Why?"), (1, "It is so."), (2, "> Why?\nBecause."), (3, "ok\n\nand a longer paragraph"), (4, "> ok\nfine"),
        (5, "ok"), (6, "> ok\nagain"), (7, "好的"), (8, "> 好的\n谢谢"), (9, ">\n> \nempty quote"), (10, "> no\nnot said"), (11, "> no"), (12, "no"),
        (13, "x\nhm\ny"), (14, "> hm\n!"),
    ]
    df = spark.createDataFrame([(1, t, "u", x) for t, x in rows], "conv_id long, turn long, role string, text string")
    got = {r.turn: r.reply_to for r in chat.messages(df).collect()}
    # whole messages first; a part only where no other turn has it
    assert {t: r for t, r in got.items() if r is not None} == {2: 0, 6: 5, 8: 7, 14: 13}


def plain_chat(rows):
    """Links, threads and order of one conversation by looking at all earlier messages."""
    norm = lambda x: " ".join(x.split()).lower()
    said = {}
    for t, _, own in rows:
        said[t] = {norm(x) for x in [own, *own.split("\n")]} - {""}
    reply = {}
    for t, quotes, _ in rows:
        best = {}
        for level, lines in quotes:
            units = {norm(" ".join(lines)), *map(norm, lines)}
            for u in units:
                if len(u) >= chat.SHORT:
                    origin = min((x for x in said if u in said[x]), default=None)
                else:
                    continue
                if origin is not None and origin < t:
                    best.setdefault(level, []).append(origin)
        if best:
            reply[t] = max(best[1]) if 1 in best else max(x for v in best.values() for x in v)
    out = []
    for t, _, own in rows:
        top, depth = t, 0
        while top in reply:
            top, depth = reply[top], depth + 1
        out.append((top, t, reply.get(t), depth, own))
    return sorted(out)


def test_planted_quotes_equal_plain_chats(spark):
    rng = random.Random(12)
    table, want = [], {}
    for conv in range(40):
        rows, texts = [], []
        for t in range(rng.randint(1, 25)):
            lines = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "epsilon"], k=rng.randint(2, 4))) + f" {rng.randint(0, 30)}" for _ in range(rng.randint(1, 3))]
            own = "\n".join(lines)
            quotes = []
            if texts and rng.random() < 0.6:
                for level in rng.sample([1, 2], rng.randint(1, 2)):
                    source = rng.choice(texts).split("\n")
                    a = rng.randrange(len(source))
                    quotes.append((level, source[a : a + rng.randint(1, 3)]))
            marked = [f"{'> ' * level}{x.upper() if rng.random() < 0.3 else x}" for level, part in quotes for x in part]
            table.append((conv, t, "u", "\n".join([*marked, own])))
            rows.append((t, quotes, own))
            texts.append(own)
        want[conv] = plain_chat(rows)
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    got = {}
    for r in chat.ordered(chat.messages(df)).orderBy("conv", "position").collect():
        got.setdefault(r.conv, []).append((r.thread, r.turn, r.reply_to, r.depth, r.content))
        assert r.position == len(got[r.conv]) - 1
    assert got == want
    assert sum(x[2] is not None for v in want.values() for x in v) > 100


def test_long_chains_of_replies(spark):
    rows = [(1, 0, "u", "message number zero")] + [(1, k, "u", f"> message number {'zero' if k == 1 else k - 1}\nmessage number {k}") for k in range(1, 40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.thread, r.depth) for r in chat.messages(df).collect()}
    assert got == {k: (0, k) for k in range(40)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=300))
def test_words_round_trip(ids):
    x = np.array(ids, np.uint64)
    words, offsets = token_files.pack(x, 64)
    assert (token_files.unpack(words, offsets, len(x), 64) == x).all()
    for b in range(len(offsets)):
        assert (token_files.unpack_block(words, offsets, len(x), b, 64) == x[b * 64 : (b + 1) * 64]).all()


def test_small_numbers_share_words():
    assert len(token_files.pack(np.ones(1020, np.uint64))[0]) == 17
    assert len(token_files.pack(np.full(1024, 1 << 61, np.uint64))[0]) == 2048


def test_word_ids_are_the_librarys(spark):
    from tokenizers import Tokenizer

    t = token_files.public_tokenizer()
    library = Tokenizer.from_str(t.json)
    rng = random.Random(1)
    alphabet = [chr(c) for c in range(0x180)] + list("́̈ 　﻿\U0001f642中αΣİK") + ["<|endoftext|>", "'s", "'LL", " "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for x, got in zip(texts, t.encoder()(texts), strict=True):
        assert library.encode(x, add_special_tokens=False).ids == got.tolist(), ascii(x)


def test_token_files_hold_all_ids_in_order(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "PART_BYTES", 40_000)
    monkeypatch.setattr(token_files, "SEGMENT", 500)
    t = token_files.public_tokenizer()
    library = Tokenizer.from_str(t.json)
    rows = [(i * 7 % 101, f"text number {i} " * (i % 40)) for i in range(101)] + [(3, "again"), (3, "again"), (200, None), (201, ""), (None, "no id"), (300, "long " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit(1), "start": F.lit(1)})
    segments = token_files.write(df, t)
    assert segments.select("part").distinct().count() > 1
    got = token_files.read(segments).orderBy("start").collect()
    want = sorted(((-1 if i is None else i, x or "") for i, x in rows))
    at = 0
    for r, (i, x) in zip(got, want, strict=True):
        ids = [*library.encode(x, add_special_tokens=False).ids, token_files.END_ID]
        assert (-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids) == (i, at, len(ids), ids)
        at += len(ids)
    crc = token_files.read(segments).filter("doc_id = 300").select(token_files.ids_crc32("ids")).first()[0]
    assert crc == zlib.crc32(np.array([*library.encode("long " * 20_000, add_special_tokens=False).ids, 1], "<u4").tobytes())
    assert token_files.digests(segments).filter("doc_id = 300").first()["ids_crc32"] == crc
    empty = token_files.write(df.filter("false"), t)
    assert token_files.read(empty).count() == 0
