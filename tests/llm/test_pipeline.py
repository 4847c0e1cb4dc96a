import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from candlewick.llm.quality import quality_scores
from candlewick.llm.simhash import simhash_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rnd = random.Random(4)
    words = ["the", "river", "und", "éà", "stone", "of", "light", "when"] + [f"word{i}" for i in range(300)]
    passage = " ".join(rnd.choice(words) for _ in range(60))
    rows, marks = [], []
    for i in range(240):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randrange(40, 120)))
        if i % 6 == 0:
            text = text.upper().replace(" ", "!! ")
        elif i % 6 == 1:
            text = f"{text} {passage} {rnd.choice(words)}"
        elif i % 6 == 2:
            text = f"{text} mail a{i}@b.example or +1 (375) 555-4393 now"
        marks.append((i, int(i % 6 != 0), 0))
        rows.append((i, text, "en", "s", len(text)))
        if i % 10 == 3:
            rows += [(1000 + i, text, "en", "copy", len(text)), (2000 + i, text + " end", "en", "near", 0)]
    rows += [(5000, None, None, None, None), (5001, "", "en", "s", 0), (None, rows[5][1], None, None, None), (3, rows[3][1], "en", "again", 1)]
    return rows, marks


@pytest.fixture()
def sf_dir(spark, tmp_dir):
    rows, marks = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    return tmp_dir


def as_rows(df):
    return Counter(map(tuple, df.collect()))


def test_stages_one_by_one(spark, sf_dir, vocab_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = as_rows(docs)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "substring_dedup", "personal_data", "packing"]
    at, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf_dir)
        assert at.columns == COLUMNS
        at.write.parquet(f"{sf_dir}/{name}.parquet")
        at = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        kept[name] = as_rows(at)

    # 1: exactly the rows that the operator predicts as good
    scores = quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    good = Counter(r["doc_id"] for r in scores if r["predicted"] == 1)
    assert Counter(r[0] for r in kept["quality"].elements()) == good
    assert not kept["quality"] - given
    junk = [r for r in kept["quality"] if r[0] is not None and r[0] < 240 and r[0] % 6 == 0]
    assert len(junk) <= 2

    # 2: one row of each component, the smallest id
    read = spark.read.parquet(f"{sf_dir}/quality.parquet")
    low = {r["component_id"] for r in simhash_components(read).collect()}
    assert {r[0] for r in kept["near_dedup"].elements()} == low and sum(kept["near_dedup"].values()) == len(low)
    assert not kept["near_dedup"] - kept["quality"]

    # 3: words that go are those under a 20-word window seen earlier
    first, texts = {}, {r[0]: (r[1] or "").split() for r in kept["near_dedup"]}
    for i in sorted(texts, key=lambda i: (i is None, i)):
        for s in range(len(texts[i]) - 19):
            first.setdefault(tuple(texts[i][s : s + 20]), (i, s))
    want = {}
    for i, ws in texts.items():
        gone = set()
        for s in range(len(ws) - 19):
            if first[tuple(ws[s : s + 20])] != (i, s):
                gone |= set(range(s, s + 20))
        want[i] = [w for k, w in enumerate(ws) if k not in gone]
    assert {r[0]: (r[1] or "").split() for r in kept["substring_dedup"]} == want
    assert sum(map(len, want.values())) < sum(map(len, texts.values()))

    # 4: nothing of the personal data is left, clean texts are as they were
    for r in kept["personal_data"]:
        assert "@b.example" not in (r[1] or "") and "555-4393" not in (r[1] or "")
    clean = [r for r in kept["substring_dedup"] if "@" not in (r[1] or "") and "555" not in (r[1] or "")]
    assert len(clean) > 50 and all(kept["personal_data"][r] == kept["substring_dedup"][r] for r in clean)

    # 5: the pieces hold every id of every document once
    lib = Tokenizer.from_file(vocab_path)
    pieces = defaultdict(list)
    for p in corpus_pipeline.STAGES[-1][1](spark, at, sf_dir).collect():
        pieces[p["doc_id"]].append(p)
    for r in kept["personal_data"]:
        ids = np.array(lib.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        mine = sorted(pieces[r[0]], key=lambda p: p["start"])
        assert sum(p["length"] for p in mine) == len(ids)
        for p in mine:
            assert zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"]


def test_run_and_registration(spark, sf_dir):
    import __spark_entry__

    queries = __spark_entry__.queries()
    assert [sum(q.startswith(f"op{n}_") for q in queries) for n in range(1, 11)] == [1] * 10
    rows = queries["pipeline"](spark, sf_dir).collect()
    assert rows and set(rows[0].__fields__) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    digest = lambda rs: hashlib.sha256(repr(sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"]) for r in rs if r["length"] == 1024)).encode()).hexdigest()
    again = corpus_pipeline.run(spark, sf_dir).collect()
    assert digest(rows) == digest(again) and sum(r["length"] for r in rows) == sum(r["length"] for r in again)


def test_empty_documents(spark, tmp_dir):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0


def other_corpus(spark, n):
    rows = [(i, f"text number {i} of another corpus with some words {i * i}", "en", "s", 1) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[1:]])
def test_a_result_outlives_other_calls(spark, sf_dir, stage):
    """Lazy results of one call are read after other calls of the same stage and of ``run``."""
    work = dict(corpus_pipeline.STAGES)[stage]
    first = work(spark, other_corpus(spark, 30), sf_dir)
    second = work(spark, other_corpus(spark, 40), sf_dir)
    assert second.select("doc_id").distinct().count() == 40
    assert first.select("doc_id").distinct().count() == 30


def test_run_leaves_only_its_result(spark, sf_dir, tmp_dir, monkeypatch):
    import os

    from candlewick.llm import common

    root = os.path.join(tmp_dir, "scratch")
    monkeypatch.setattr(common, "scratch_root", lambda s: root)
    tables = {t.name for t in spark.catalog.listTables()}
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count()
    left = [d for d in os.listdir(root) if os.listdir(os.path.join(root, d))]
    assert len(left) == 1 and len(os.listdir(os.path.join(root, left[0]))) == 1
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_a_scope_ends_even_after_a_failure(spark):
    from candlewick.llm.common import Scratch, scratch_scope

    with pytest.raises(RuntimeError):
        with scratch_scope():
            scratch = Scratch(spark)
            kept = scratch.chunked(spark.range(100).toDF("x"))
            assert kept.count() == 100
            raise RuntimeError
    assert not scratch._fs.exists(scratch._path(scratch.root))
