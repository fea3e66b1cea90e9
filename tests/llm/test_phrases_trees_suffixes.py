"""Phrase mining, Merkle manifests and repeated byte strings against brute force, and their edge cases."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantelle.llm import collocations, merkle, suffix_dedup
from quantelle.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, phrase string, place long, key string, idx long"


def docs(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    full = [(k, t, lang, "s", None if t is None else len(t), "p", 1, "k", 2) for k, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


# ------------------------------------------------------------------- collocations

def brute_phrases(rows, least, longest, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(a, inside.get(p[i:i + k], 0))
        best = []
        for p, a in cand.items():
            if 100 * inside.get(p, 0) >= 100 * a:
                continue
            score, cut = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), c[p[:cut]], c[p[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, left, r, n[lang], -s) for i, (s, a, p, left, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


PHRASES = [
    (1, "A b c d. a B c d, a b! a a a a", "en"), (2, None, "en"), (3, "", None), (4, "x y x y x y\nx y\t x  y é É", None),
    (5, "a b c d e f " * 30, "en"), (5, "a b c d e f " * 30, "en"), (None, "*** a b *** a b", "en"), (7, " \t.;\r\x0b", "fr"),
]


@pytest.mark.parametrize("block, top", [(4_000_000, 2000), (40, 3)])
def test_phrases(spark, monkeypatch, block, top):
    monkeypatch.setattr(collocations, "BLOCK_CHARS", block)
    monkeypatch.setattr(collocations, "MAX_SENT", 0 if top == 3 else 10**6)  # by shuffles, by broadcast
    got = collocations.collocations(docs(spark, PHRASES), min_count=2, longest=5, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(PHRASES, 2, 5, top)


def test_phrases_of_long_texts_and_of_none(spark):
    long = [(1, "to be or not to be. " * 50_000, "en")]
    assert sorted(tuple(r) for r in collocations.collocations(docs(spark, long)).collect()) == brute_phrases(long, 100, 5, 2000)
    assert collocations.collocations(docs(spark, [])).collect() == []


def test_scores_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", 1, "a", 10**12), ("en", 1, "b", 10**12), ("en", 2, "a b", 10**12 - 1)], "lang string, k int, phrase string, f long")
    totals = spark.createDataFrame([("en", 10**15)], "lang string, n long")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(collocations, "frequent_phrases", lambda *_: (phrases, totals))
        got = collocations.collocations(spark.createDataFrame([], "text string, lang string"))
        assert got.first().score == 1000 * (10**12 - 1) * 10**15 // 10**24


# ------------------------------------------------------------------------- manifest

def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def tree(leaves):
    """Root of the leaves, and for each the siblings to the left and to the right by level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            run = nodes[i // 8 * 8:i // 8 * 8 + 8]
            path.append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        at = [i // 8 for i in at]
        nodes = [sha(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return (nodes[0] if nodes else None), paths


def brute_manifest(rows):
    def leaf(k, text, lang):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (k, lang, text)])

    groups = defaultdict(list)
    for k, text, lang in rows:
        changed = text.lower() if text and k is not None and zlib.crc32(str(k).encode()) % 3 == 0 else text
        groups[lang].append((k, leaf(k, text, lang), leaf(k, changed, lang)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = tree([x[1] for x in groups[g]])
    root, tops = tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        for (k, own, changed), path in zip(groups[g], trees[g][1]):
            acc = changed
            for a, b in path + top:
                acc = sha(a, acc, b)
            out.append((str(k), own, trees[g][0], root, sha(*[a + b for a, b in path + top]), acc, acc == root))
    return sorted(out)


MANY = [(i, f"Text {i}" * (i % 5), f"l{i % 3}" if i % 7 else None) for i in range(200)]
LEAVES = {
    "many": MANY, "none": [],
    "groups": [(i, "T", f"g{i % 70}") for i in range(90)],
    "odd": [(None, None, "x"), (None, "", "x"), (3, "A", "x"), (3, "A", "x"), (3, "É" * 3, "x"), (-4, "T" * 300_000, None), (5, "q", "")]
    + [(i, "T", "e") for i in range(8)] + [(i, "T", "n") for i in range(9)],
}


@pytest.mark.parametrize("case", LEAVES)
def test_manifest(spark, case):
    rows = docs(spark, LEAVES[case]).repartition(3)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower).otherwise(F.col("text"))
    got = merkle.verified(merkle.manifest(rows, "lang", "doc_id", ["doc_id", "lang", "text"], {"text": changed}), "doc_id")
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute_manifest(LEAVES[case])


def test_no_level_shuffles_a_group_to_one_task(spark):
    nodes = spark.range(1000).select((F.col("id") % 2).alias("gid"), F.col("id").alias("idx"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("h"),
                                     F.lit(1000).cast("long").alias("n"))
    plan = merkle.with_siblings(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning(gid#" in plan and "Window" not in plan


# --------------------------------------------------------------------- byte strings

def brute_cuts(rows, length):
    seen, out = set(), []
    for k, text, _ in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if b[s:s + length] in seen:
                gone[s:s + length] = True
            seen.add(b[s:s + length])
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2)
        out.append((str(k), len(b), edges.tolist(), kept))
    return sorted(out)


def cuts_of(df):
    return sorted((str(r[0]), r.n_bytes, [[s.start, s.end] for s in r.spans], bytes(r.kept)) for r in df.collect())


def crowd():
    """Copies of a passage between differing words, runs of one character, near copies, odd texts."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdé "), 9))
    passage, other = "".join(word() for _ in range(30)), "".join(word() for _ in range(12))
    rows = [(i, word() * 2 + passage[i % 7:200 + i % 11] + word() + other[:90 + i % 20] + word(), "en") for i in range(120)]
    return rows + [(200, "x" * 700, "en"), (201, "x" * 150 + "y" + "x" * 99, None), (202, "ab" * 300, "en"), (203, None, "en"), (204, "", "en"),
                   (205, "short", "en"), (206, passage[:99], "en"), (207, passage, "en"), (208, "".join(word() for _ in range(9000)), "en"), (209, passage * 3, "en")]


@pytest.mark.parametrize("length", [32, 100, 200])
@pytest.mark.parametrize("bucket", [200_000, 60])
def test_repeats(spark, monkeypatch, length, bucket):
    if bucket == 60:  # many buckets, blocks, parts and spans
        for name, value in (("BUCKET_ROWS", 60), ("BLOCK_CHARS", 3000), ("_SPAN", 777), ("PART_BYTES", 9000), ("BUCKET_BYTES", 40_000)):
            monkeypatch.setattr(suffix_dedup, name, value)
    rows = crowd()
    got = suffix_dedup.remove_repeats(docs(spark, rows).repartition(5), length)
    assert cuts_of(got) == brute_cuts(rows, length)


def test_windows_shared_over_many_buckets(spark, monkeypatch):
    """One suffix in all documents, each after another text: equal splitters deal it out."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 20)
    rng = np.random.default_rng(3)
    tail = "".join(rng.choice(list("qrstuv"), 140))
    rows = [(i, "".join(rng.choice(list("abc"), 2 + i % 60)) + tail, "en") for i in range(150)]
    asked = []
    held = suffix_dedup.splitters
    monkeypatch.setattr(suffix_dedup, "splitters", lambda *a: asked.append(held(*a)) or asked[-1])
    got = cuts_of(suffix_dedup.remove_repeats(docs(spark, rows), 100))
    assert len(asked[0]) > 2 and len(set(asked[0])) < len(asked[0]) and got == brute_cuts(rows, 100)


def test_repeated_and_null_keys(spark):
    text = "the same text of more than one hundred bytes, which occurs in each of the rows that share a key or have none at all " * 2
    got = cuts_of(suffix_dedup.remove_repeats(docs(spark, [(1, text, "en"), (1, text, "en"), (None, text, "en"), (None, "z" + text, "en")])))
    whole = [g for g in got if g[2] == []]
    assert [g[0] for g in whole] == [] and sum(len(g[3]) for g in got) == len(set(text[i:i + 100] for i in range(len(text) - 99))) + 1
    assert suffix_dedup.remove_repeats(docs(spark, [])).collect() == []
    assert cuts_of(suffix_dedup.remove_repeats(docs(spark, [(1, None, "en"), (2, "", None)]))) == [("1", 0, [], b""), ("2", 0, [], b"")]


def test_multikey_order_and_agreement():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.choice([97, 98], int(rng.integers(0, 40))).astype(np.uint8)) + b"!" for _ in range(500)]
    digits = suffix_dedup._digits(texts, 48)
    order = suffix_dedup.multikey_sort(digits)
    padded = [t.ljust(48, b"\0") for t in texts]
    assert [padded[i] for i in order] == sorted(padded)
    want = [len(os.path.commonprefix([padded[a], padded[b]])) for a, b in zip(order[:-1], order[1:])]
    assert suffix_dedup.agreement(digits[order[:-1]], digits[order[1:]]).tolist() == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not available")
def test_query_of_repeats(spark):
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in LLM_QUERIES["op13_suffix_dedup"](spark, SF).collect())
    want = [(k, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for k, n, spans, kept in brute_cuts(rows, 100)]
    assert got == want
