import hashlib
import random
import zlib

import pytest

from candlewick.llm.merkle import merkle_manifest, tampered_check

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, rank int, node string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def joined(nodes, arity):
    """Root of a list of digests and, per leaf, its runs (before, after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for path, i in zip(paths, at):
            run, place = runs[i // arity], i % arity
            path.append(("".join(run[:place]), "".join(run[place + 1 :])))
        nodes, at = [sha("".join(r)) for r in runs], [i // arity for i in at]
    return nodes[0], paths


def brute(rows, arity=2):
    langs = sorted({r["lang"] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    groups, subroots = [], []
    for lang in langs:
        own = [(r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r), r) for r in rows if r["lang"] == lang]
        own.sort(key=lambda x: x[:3])
        subroot, paths = joined([x[2] for x in own], arity)
        groups.append((own, paths))
        subroots.append(subroot)
    root, tops = joined(subroots, arity)
    out = []
    for (own, paths), subroot, top in zip(groups, subroots, tops):
        for (_, _, leaf, row), path in zip(own, paths):
            path = path + top
            cur = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0 and row["n_chars"] is not None:
                cur["n_chars"] += 1
            cur = leaf_of(cur)
            for before, after in path:
                cur = sha(before + cur + after)
            out.append((row["doc_id"], leaf, subroot, root, sha("".join(b + a for b, a in path)), cur, cur == root))
    return out


def rows_of(n, langs, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        text = rnd.choice([None, "", "x", "é" * rnd.randint(1, 5), "long " * 3000, f"t{i}"])
        rows.append({"doc_id": i * 3, "text": text, "lang": rnd.choice(langs), "source": rnd.choice([None, "", "a"]), "n_chars": rnd.choice([None, 0, 7, (1 << 63) - 1]), "leaf": "c", "rank": 1, "node": "d"})
    return rows


CASES = {
    "several groups": rows_of(150, [None, "", "a", "Z", "é"]),
    "one hot group": rows_of(70, ["en"] * 30 + ["de"]),
    "one row": rows_of(1, ["x"]),
    "one group of two": rows_of(2, ["x"]),
    "repeats": rows_of(5, ["a", None]) * 6 + [{**rows_of(1, ["a"])[0], "doc_id": None, "text": t} for t in ("p", "q", "q")],
}


@pytest.mark.parametrize("arity,levels", [(2, 2), (3, 1)])
@pytest.mark.parametrize("case", sorted(CASES))
def test_manifest_equals_brute_force(frame, case, arity, levels):
    rows = CASES[case]
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    docs = frame(SCHEMA, [tuple(r[c] for c in columns) for r in rows])
    got = tampered_check(docs, arity=arity, levels=levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows, arity), key=repr)


def test_empty_table(frame):
    assert tampered_check(frame(SCHEMA, [])).count() == 0


def test_proofs_and_carried_columns(frame):
    from pyspark.sql import functions as F

    docs = frame("k int, grp string, v string", [(i, "g", f"v{i}") for i in range(9)])
    rows = merkle_manifest(docs, ("k", "v"), id_col="k", group_col="grp", levels=2, carry={"size": F.length("v")}).orderBy("k").collect()
    assert [r["size"] for r in rows] == [2] * 9 and len({r["root"] for r in rows}) == 1
    for r in rows:
        cur = r["leaf"]
        for run in r["proof"]:
            cur = sha(run["before"] + cur + run["after"])
        assert cur == r["root"] == r["subroot"] and len(r["proof"]) == 4
