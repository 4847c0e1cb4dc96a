import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch, Words, mix
from candlewick.llm.pii import LED, find_personal_data, occurrence_table, redact
from candlewick.llm.quality import Model, bag, features, quality_scores
from candlewick.llm.topk import top_inner_products


def brute_topk(rows, every, k=5):
    vecs = []
    for i, v in rows:
        good = v and all(x is not None and math.isfinite(x) for x in v)
        vecs.append([math.floor(256 * x) for x in v] if good else None)
    out = []
    for a, (i, _) in enumerate(rows):
        if i is None or i % every or vecs[a] is None:
            continue
        got = [(sum(x * y for x, y in zip(vecs[a], v)), j) for b, ((j, _), v) in enumerate(zip(rows, vecs)) if b != a and v is not None and len(v) == len(vecs[a])]
        got.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        out += [(i, n, j, s) for n, (s, j) in enumerate(got[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block,query_block", [(2048, 8192), (64, 16)])
def test_top_products_equal_brute_force(spark, block, query_block):
    rnd = np.random.default_rng(block)
    rows = [(i, [float(x) for x in np.float32(rnd.normal(size=12) * rnd.choice([0.1, 1, 3]))]) for i in range(500)]
    rows += [(600 + i, rows[3][1]) for i in range(150)]
    rows += [(1000, None), (1010, [1.0] * 5), (1020, [None] * 12), (1030, [float("nan")] * 12), (1040, [0.0] * 12), (None, rows[3][1]), (10, rows[7][1]), (1050, []), (1060, [1e30] + [0.0] * 11), (1070, [float("inf")] * 12), (1080, [-1.0] * 5)][:9] + [(1070, [float("inf")] * 12), (1080, [-1.0] * 5)]
    rows = [r for r in rows if r[0] != 1060]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string").repartition(4)
    got = top_inner_products(df, every=10, block=block, query_block=query_block, head=4, sample=64)
    assert sorted(map(tuple, got.collect()), key=str) == brute_topk(rows, 10)
    assert top_inner_products(df.limit(0)).count() == 0


# ---------------------------------------------------------------- quality


def quality_rows():
    rnd = random.Random(2)
    words = ["the", "river", "und", "éà", "stone", "of", "light", "when"]
    rows, marks = [], []
    for i in range(600):
        good = i % 3 != 0
        text = " ".join(rnd.choice(words) for _ in range(rnd.randrange(5, 60)))
        if not good:
            text = rnd.choice([text.upper().replace(" ", "!! "), " ".join([rnd.choice(words)] * 30), text.replace(" ", "$$$ ")])
        rows.append((i, text, "clash"))
        marks.append((i, int(good), 0))
    return rows + [(9000, None, "n"), (9001, "", "n"), (None, "the river", "n"), (5, rows[5][1], "again"), (9002, "river " * 30000, "")], marks + [(None, 1, 0), (3, None, 0)]


def test_quality_on_held_out_rows(frame):
    rows, marks = quality_rows()
    docs, labels = frame("doc_id long, text string, score string", rows), frame("doc_id long, quality int, toxic int", marks)
    got = quality_scores(docs, labels).collect()
    assert len(got) == len(rows)
    truth, right, n = dict((i, q) for i, q, _ in marks if q is not None), 0, 0
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 4 == 2)
        if r["held_out"] and r["doc_id"] in truth:
            n += 1
            right += truth[r["doc_id"]] == r["predicted"]
    assert n > 100 and right / n > 0.95
    kept = quality_scores(docs, labels, keep_good=True)
    assert kept.columns == docs.columns
    want = Counter(r["doc_id"] for r in got if r["predicted"] == 1)
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def test_features_are_words_pairs_and_character_ngrams():
    def hashed(words):
        return (Words([w.encode() for w in words], lower=False).hashes >> np.uint64(47)).tolist()

    def pair(a, b):
        h = Words([f"{a} {b}".encode()], lower=False).hashes
        return int(mix(h[:1], h[1:])[0] >> np.uint64(47))

    texts = ["", "a b b c", "", "c", "c a", "  ", ""]
    parts = list(features(texts, 17))
    for n, text in enumerate(texts):
        words = text.split()
        got = [ids[bounds[n] : bounds[n + 1]].tolist() for ids, bounds in parts]
        assert got[0] == hashed(words)
        assert got[1] == [pair(a, b) for a, b in zip(words, words[1:])]
        assert got[2] == [0] * sum(a == b for a, b in zip(words, words[1:]))
        assert [len(g) for g in got[3:]] == [max(0, len(text) - k + 1) for k in (2, 3, 4)]
        ids, counts = bag(text, 17)
        assert Counter(dict(zip(ids.tolist(), counts.tolist()))) == Counter(i for g in got for i in g)


def brute_quality(rows, marks, bits=17, epochs=3):
    """Scores by one plain loop over all texts, without Spark's plan: the same
    training rows in the same orders, features added one at a time."""
    labels = {}
    for i, q, _ in marks:
        if i is not None and q in (0, 1):
            labels[i] = min(q, labels.get(i, 1))
    texts = {}
    for i, t, _ in rows:
        if i in labels and zlib.crc32(str(i).encode()) % 4 != 2:
            texts[i] = min(t or "", texts.get(i, t or ""))
    n = Counter(labels[i] for i in texts)
    spark = SparkSession.getActiveSession()
    orders = spark.createDataFrame([(i, e) for i in texts for e in range(epochs)], "i long, e int").withColumn("h", F.xxhash64("i"))
    orders = orders.select("i", "e", "h", F.xxhash64("h", "e").alias("o")).collect()
    model = Model(bits, tuple(sum(n.values()) / (2.0 * n[c]) for c in (0, 1)))
    bags = {i: bag(t, bits) for i, t in texts.items()}
    for r in sorted(orders, key=lambda r: (r["e"], r["o"], r["h"])):
        model.learn(*bags[r["i"]], labels[r["i"]])
    weights, prior = model.numbers()
    out = []
    for i, t, _ in rows:
        ids, counts = bag(t or "", bits)
        z = prior + sum(float(weights[k]) * c for k, c in zip(ids.tolist(), counts.tolist())) / max(1, counts.sum())
        out.append((i, 1 / (1 + math.exp(-z))))
    return out


def test_quality_scores_equal_a_plain_loop(frame):
    rows, marks = quality_rows()
    got = quality_scores(frame("doc_id long, text string, score string", rows, 5), frame("doc_id long, quality int, toxic int", marks)).collect()
    key = lambda r: (str(r[0]), r[1])
    for g, w in zip(sorted(((r["doc_id"], r["score"]) for r in got), key=key), sorted(brute_quality(rows, marks), key=key), strict=True):
        assert g[0] == w[0] and abs(g[1] - w[1]) < 1e-6


def test_training_on_long_texts_sends_the_driver_numbers_only(spark, frame):
    rnd = random.Random(7)
    rows = [(i, " ".join(f"{rnd.choice('xyz')}{rnd.randrange(10**6)}" for _ in range(8000)) if i % 2 else "noise " * 12000, "") for i in range(200)]
    marks = [(i, i % 2, 0) for i in range(200)]
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))  # many batches
    try:
        got = quality_scores(frame("doc_id long, text string, score string", rows), frame("doc_id long, quality int, toxic int", marks), bits=14).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert len(got) == 200 and all(r["predicted"] == r["doc_id"] % 2 for r in got)


def test_quality_without_labels_or_rows(frame):
    rows, marks = quality_rows()
    docs, labels = frame("doc_id long, text string, score string", rows[:20]), frame("doc_id long, quality int, toxic int", [])
    assert {r["score"] for r in quality_scores(docs, labels).collect()} == {0.5}
    assert quality_scores(docs.limit(0), frame("doc_id long, quality int, toxic int", marks)).count() == 0


# ---------------------------------------------------------------- personal data

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d)))
        return 14 <= len(d) <= 19 and total % 10 == 0
    return 10 <= len(d) <= 15 if kind == "phone" else True


def brute_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(KINDS.items()):
        out += [(m.start(), n, m.end(), kind) for m in re.finditer(pattern, text or "") if good(kind, m[0])]
    return sorted(out)


def pii_rows():
    rnd = random.Random(9)
    bits = ["a@b.c", "x.y@mail-1.example.com", "a@b.c_d@e.f", "a@b.c.d@e.f", "@b.c", "a@b", "1.2.3.4", "256.1.1.1", "001.02.3.255", "1.2.3.4.5", "12.1.2.3.4.5.6.7", "4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559", "+1 (375) 555-4393", "+1 375", "+49 30 1234567 ", "++12 3456 78901", "+1.2.3.4 5678901-", "😀", "é", " ", "  ", "\n", "word", "-", ".", "+", "7", "12", "  9"]
    rows = [(i, "".join(rnd.choice(bits) + rnd.choice(["", " ", " "]) for _ in range(rnd.randrange(12))), "c") for i in range(400)]
    return rows + [(1000, None, None), (1001, "", None), (None, "mail a@b.c", None), (3, rows[3][1], "again"), (1002, "9 " * 30000 + "a" * 50000 + "." * 20000, None), (1003, "a@" + "b." * 20000 + "c", None), (1004, "x" * 60000 + "@y", None)]


def test_base_spans_equal_the_plain_expressions(frame):
    rows = pii_rows()
    got = find_personal_data(frame("doc_id long, text string, spans string", rows, 4)).collect()
    want = []
    for i, t, _ in rows:
        spans = brute_spans(t)
        base = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
        n = Counter(k for *_, k in spans)
        want.append((i, *(n[k] for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), base))
    key = lambda r: (str(r[0]), r[5])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:6] == w[:6]
        assert set(w[6].split(",")) - {""} <= set(g[6].split(","))


def bootstrap_rows():
    rows = [(i, f"Hello there, reach me at user{i}@mail.example.com today", "") for i in range(12)]
    rows += [(100 + i, f"so then reach me at 55512{i}34x please", "") for i in range(3)]  # another shape: no @
    rows += [(200, "so then reach me at hidden@localhost please", ""), (201, "He said foo@bar to us", "")]
    rows += [(300 + i, f"Her phone number +1 (375) 555-43{10 + i} rings", "") for i in range(12)]
    rows += [(400, "Your phone number 555-123-4567 rings", ""), (401, "my version 1234567 is old", "")]
    rows += [(500 + i, f"the box 4.3.2.{i} the", "") for i in range(4)] + [(510, "the box 123456", "")]
    return rows


def test_patterns_discover_unknown_identifiers(frame):
    rows = bootstrap_rows()
    got = {r["doc_id"]: r for r in find_personal_data(frame("doc_id long, text string, spans string", rows)).collect()}
    text = {i: t for i, t, _ in rows}

    def spans(i):
        return [(k, text[i][int(a) : int(b)]) for k, a, b in (s.split(":") for s in got[i]["spans"].split(",") if s)]

    assert spans(200) == [("email", "hidden@localhost")]
    assert spans(400) == [("phone", "555-123-4567")]
    assert spans(201) == spans(401) == spans(100) == []
    assert spans(510) == []  # four seeds are fewer than the support asked for
    assert got[200]["n_email"] == 0 and got[200]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def named_spans(frame, rows, **options):
    text = {i: t for i, t, _ in rows}
    got = find_personal_data(frame("doc_id long, text string, spans string", rows), **options).collect()
    return {r["doc_id"]: [(k, text[r["doc_id"]][int(a) : int(b)]) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)] for r in got}


def test_believed_instances_work(frame):
    rows = [(i, f"please write to user{i}@mail.example.com today", "") for i in range(30)]
    # believed behind "write to", so they back "boss is", which no seed stands behind
    rows += [(100 + i, f"please write to root{i}@host today", "") for i in range(7)]
    rows += [(200 + i, f"our boss is root{i}@host now", "") for i in range(7)]
    rows += [(300, "our boss is other@host now", "")]
    # the two words before it are new, the last one is not
    rows += [(400, "or fax to some@where now", ""), (401, "or fax by some@place now", "")]
    # a seed elsewhere, here made too long for a card by the next number
    rows += [(500, "card 4111111111111111 ok", ""), (501, "ref 4111111111111111 12345 ok", "")]
    got = named_spans(frame, rows, reliable=0.7)
    assert got[103] == [("email", "root3@host")] and got[203] == [("email", "root3@host")]
    assert got[300] == [("email", "other@host")]
    assert got[400] == [("email", "some@where")] and got[401] == []
    assert got[501] == [("card", "4111111111111111")]


def test_identifiers_in_groups(frame):
    rows = [(i, f"my card number 4111 1111 1111 1111 is {i}", "") for i in range(2)]
    rows += [(10 + i, f"my card number {n} is it", "") for i, n in enumerate(["5500 0055 5555 5559", "4012 8888 8888 1881", "3782 822463 10005 0", "4222-2222-2222-2220", "6011 1111 1111 1117", "5105 1051 0510 5100", "4000 0000 0000 0002"])]
    rows += [(100, "my card number 4111 1111 1111 1112 is it", ""), (101, "my card number 12 34 is short", ""), (102, "my card number 12345 678 is one", "")]
    rows += [(200 + i, f"her phone number +1 (375) 555-43{10 + i} rings", "") for i in range(12)]
    rows += [(300, "her phone number (375) 555 4393. It rings", ""), (301, "her phone number 555 123.4567 rings", ""), (302, "the year 12 345 678 was", "")]
    rows += [(303, "7 " * 30000, ""), (304, "her phone number 12 34  567", "")]
    got = named_spans(frame, rows, reliable=0.7)
    assert got[100] == [("card", "4111 1111 1111 1112")] and got[102] == [("card", "12345 678")]
    assert got[300] == [("phone", "(375) 555 4393")] and got[301] == [("phone", "555 123.4567")]
    assert got[101] == got[302] == got[303] == got[304] == []


def test_redaction(frame):
    rows = bootstrap_rows() + pii_rows() + [(600, "a +1.2.3.4 5678901 b 1.2.3.4", None)]
    df = frame("doc_id long, text string, spans string", rows)
    found = defaultdict(list)
    for r in find_personal_data(df).collect():
        found[r["doc_id"]].append(r["spans"])
    out = redact(df)
    assert out.columns == df.columns
    got = defaultdict(list)
    for r in out.collect():
        got[r["doc_id"]].append(r["text"])
    for i, t, _ in rows:
        if len(found[i]) > 1:
            continue
        want, to = "", 0
        for s in filter(None, found[i][0].split(",")):
            k, a, b = s.split(":")
            if int(a) >= to:
                want += t[to : int(a)] + f"<{k}>"
            to = max(to, int(b))
        assert got[i] == [t if t is None else want + t[to:]]
    assert redact(df.limit(0)).count() == 0 and find_personal_data(df.limit(0)).count() == 0


def test_texts_with_many_matches(frame):
    rnd = random.Random(4)
    bits = ["é@b.c", "u{}@mail-1.ex.com", "1.2.3.{}", "4111 1111 1111 1111", "+1 (375) 555-4{:03}", "+1.2.3.4 5678{:03}", "x" * 9000, "key 1234567{}", "né", "a\nb"]
    many = " ".join(rnd.choice(bits).format(i % 200) for i in range(6000))
    rows = [(1, many, ""), (2, "a b", ""), (3, "u1@b.c " * 12000, ""), (4, "😀" * 4095 + " z@b.c " + "é" * 4090 + "7.7.7.7 end", ""), (5, "9" * 8191 + " 1.2.3.4 " + "-" * 70000, "")]
    got = {r["doc_id"]: r["spans"] for r in find_personal_data(frame("doc_id long, text string, spans string", rows)).collect()}
    clean = {r["doc_id"]: r["text"] for r in redact(frame("doc_id long, text string, spans string", rows)).collect()}
    for i, t, _ in rows:
        base = {f"{k}:{s}:{e}" for s, _, e, k in brute_spans(t)}
        assert base <= set(got[i].split(",")) | {""}
        want, to = [], 0
        for k, a, b in (s.split(":") for s in got[i].split(",") if s):
            if int(a) >= to:
                want += [t[to : int(a)], f"<{k}>"]
            to = max(to, int(b))
        assert clean[i] == "".join(want) + t[to:]
    assert got[3].count("email") == 12000


def brute_added(seen, rounds, reliable, support):
    """Spans that scoring the graph adds, by plain loops over (row, start, kind,
    end, text, context)."""
    whole, edges, totals = Counter(), Counter(), Counter()
    for _, _, kind, _, text, context in seen:
        again = kind is None and re.match(LED, text)
        whole[("@ " if "@" in text else "# ") + context, text, kind] += 0 if again else 1

    def short(pattern):
        last = pattern[2:].rpartition(" ")[2] if " " in pattern[2:] else ""
        return [pattern[0] + "~" + last] if last else []

    for (p, t, k), n in whole.items():
        for q in [p, *short(p)]:
            edges[q, t, k] += n
            totals[q] += n
    seeds = {(t, k) for _, t, k in whole if k is not None}
    waiting = {(p, t) for p, t, k in whole if k is None}
    same = {(t, k): 1.0 for t, k in seeds if t in {t for _, t in waiting}}
    beliefs = dict(same)
    for _ in range(rounds):
        votes, belief = Counter(), {}
        for (q, t, k), n in edges.items():
            for kind, b in [(k, 1.0)] if k is not None else [(x, b) for (u, x), b in beliefs.items() if u == t and n > 0]:
                votes[q, kind] += n * b
                belief[q, kind, t] = max(b, belief.get((q, kind, t), 0.0))
        backing = Counter()
        for (q, kind, _), b in belief.items():
            backing[q, kind] += b
        score = defaultdict(dict)
        for (q, kind), b in backing.items():
            if b >= support:
                score[q][kind] = votes[q, kind] / (totals[q] + 1)
        beliefs = dict(same)
        for p, t in waiting:
            heard = next((score[q] for q in [p, *short(p)] if score.get(q)), {})
            for kind, x in heard.items():
                beliefs[t, kind] = max(x, beliefs.get((t, kind), 0.0))
    best = {}
    for (t, k), b in beliefs.items():
        if b >= reliable:
            best[t] = min(best.get(t, (0, 0)), (-b, k))
    out, to = set(), {}
    for row, start, _, end, text, _ in sorted((s for s in seen if s[2] is None and s[4] in best), key=lambda s: (s[0], s[1], -s[3])):
        if start >= to.get(row, 0):
            out.add((row, list(KINDS)[best[text][1]], start, end))
        if " " in text:
            to[row] = max(end, to.get(row, 0))
    return out


@pytest.mark.parametrize("seed,reliable,support,rounds", [(1, 0.6, 3, 3), (2, 0.4, 2, 1), (3, 0.5, 4, 5)])
def test_graph_scores_equal_plain_loops(spark, frame, seed, reliable, support, rounds):
    rnd = random.Random(seed)
    values = [f"u{i}@ex.com" for i in range(12)] + [f"root{i}@host" for i in range(9)] + [f"10.0.0.{i}" for i in range(8)] + [f"55512{i}34" for i in range(6)]
    values += ["4111 1111 1111 1111", "4111 1111 1111 1112", "12345 678", "+1 (375) 555-4393", "(375) 555 4393", "10.0.0.300"]
    contexts = ["write to", "mail to", "server", "the host", "card no", "call me at", "it is", ""]
    rows = [(i, " and so ".join(f"{rnd.choice(contexts)} {rnd.choice(values[i % 3 :: 2])}" for _ in range(rnd.randrange(1, 6))), "") for i in range(250)]
    rows += bootstrap_rows()
    rows = [(n, t, "") for n, (_, t, _) in enumerate(rows)]
    df = frame("doc_id long, text string, spans string", rows)
    table = occurrence_table(df.selectExpr("doc_id as row", "doc_id", "text"), 2, 40, Scratch(spark))
    seen = [(r["row"], *(r["s"][c] for c in ("start", "kind", "end", "text", "context"))) for r in table.select("row", F.explode("seen").alias("s")).collect()]
    want = brute_added(seen, rounds, reliable, support)
    got = set()
    for r in find_personal_data(df, rounds=rounds, reliable=reliable, support=support).collect():
        base = {f"{k}:{s}:{e}" for s, _, e, k in brute_spans(rows[r["doc_id"]][1])}
        got |= {(r["doc_id"], k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s and s not in base)}
    assert got == want and len(want) > 5


@pytest.mark.parametrize("big", [1e38, 1e9])
def test_scores_beyond_a_long_are_an_error(frame, big):
    from candlewick.llm.topk import top_inner_products

    rows = [(i, [big, big / 10]) for i in range(0, 150, 50)]
    with pytest.raises(Exception, match="use a smaller scale"):
        top_inner_products(frame("vec_id long, embedding array<double>", rows), k=2, every=50).collect()
    small = top_inner_products(frame("vec_id long, embedding array<double>", rows), k=2, every=50, scale=1e-30 if big > 1e9 else 1e-3)
    assert small.count() == 6
