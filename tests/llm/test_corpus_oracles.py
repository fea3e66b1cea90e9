"""Registered corpus queries against SQL or brute force on the smallest tables."""

import base64
import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from quantelle.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not available")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(db):
    return db.execute("SELECT doc_id, coalesce(text, ''), lang, source FROM documents ORDER BY doc_id").fetchall()


def run(spark, name):
    return [r.asDict() for r in LLM_QUERIES[name](spark, SF).collect()]


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_equals_sql(spark, db, name):
    got = run(spark, name)
    cursor = db.execute(LLM_ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(map(str, ([r[c] for c in columns] for r in got))) == sorted(map(str, map(list, cursor.fetchall())))


def test_warc(spark, db):
    pages = db.execute("SELECT page_id, coalesce(html, '') FROM pages").fetchall()
    largest = {}
    for k, h in pages:
        largest[h] = max(k, largest.get(h, k))
    want = {k: (len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(),
                "response" if largest[h] == k else "revisit", None if largest[h] == k else largest[h]) for k, h in pages}
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in run(spark, "op1_warc")}
    assert got == want


def sets_of(text):
    w = text.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates(spark, documents):
    sets = {k: sets_of(t) for k, t, *_ in documents}
    up = {k: k for k in sets}

    def root(k):
        return k if up[k] == k else root(up[k])

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in run(spark, "op2_near_dup")}
    assert got == {k: (len(sets[k]), root(k), root(k) == k) for k in keys}


def test_contamination(spark, db, documents):
    items = {i: re.findall(r"\w+", t.lower()) for i, t in db.execute("SELECT item_id, text FROM benchmark").fetchall()}
    want = set()
    for k, t, *_ in documents:
        words = " " + " ".join(re.findall(r"\w+", t.lower())) + " "
        want |= {(k, i) for i, w in items.items() if w and f" {' '.join(w)} " in words}
    assert {(r["doc_id"], r["item_id"]) for r in run(spark, "op4_decontaminate")} >= want


def test_token_counts(spark, documents):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {k: (len(t.encode()), n, n > 2048) for k, t, *_ in documents for n in [len(library.encode(t, add_special_tokens=False).ids)]}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in run(spark, "op5_token_counts")} == want


def test_language_accuracy_on_held_out_rows(spark, documents):
    told = {r["doc_id"]: r for r in run(spark, "op6_language")}
    assert len(told) == len(documents)
    held = [(lang, told[k]) for k, _, lang, _ in documents if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(r["held_out"] and 0 <= r["score"] <= 1 for _, r in held)
    assert sum(lang == r["lang_pred"] for lang, r in held) >= 0.95 * len(held)


def test_mixing(spark, documents):
    got = {r["doc_id"]: r for r in run(spark, "op8_mixing")}
    assert sorted(got.items()) == sorted({r["doc_id"]: r for r in run(spark, "op8_mixing")}.items())
    taken, target, size = {}, {}, {}
    for k, t, _, source in documents:
        r = got[k]
        assert r["size"] == len(t.encode().split()) and 0 <= r["taken"] <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
        target[source], size[source] = r["target"], r["source_size"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s in target:
        assert target[s] <= 2 * size[s] and abs(taken[s] - target[s]) <= 0.03 * target[s] + 2


def test_token_files(spark, documents):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = {}, 0
    for k, t, *_ in documents:
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        want[k] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in run(spark, "op10_token_files")} == want


def test_pipeline_stages(spark, documents):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).checkpoint()
        kept.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "near_duplicates":
            left = [sets_of(r.text) for r in docs.collect()]
            assert not any(100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(left) for b in left[i + 1:] if a)
    assert kept[0] >= kept[1] > 0.98 * kept[0] and kept[1] > kept[2] > kept[3] and kept[5] == kept[4] > 0
