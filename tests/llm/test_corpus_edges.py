"""Nulls, ties, repeated rows, empty tables, clashing columns and planted cases."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quantelle.llm import bpe_count, chat, decontaminate, embed_dedup, language, line_dedup, mixing, near_dup, token_files, warc
from quantelle.llm.common import scratch
from quantelle.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, label int, tokens string, cls string"
LONG = " ".join(f"w{i % 977}" for i in range(20000))
ROWS = [(1, "one two three four five six seven", "en", "a", 1, "x", "y"), (2, "ONE two three four five six seven", "en", "a", 1, "x", "y"),
        (2, "ONE two three four five six seven", "en", "a", 1, "x", "y"), (3, None, None, None, None, None, None), (4, "", "en", None, None, None, None),
        (None, "one two three four five six seven", "de", "b", 1, "x", "y"), (5, LONG, "de", "b", 0, "x", "y"), (6, "  \t", "fr", "", 0, "x", "y"),
        (7, "kurz", "de", "b", 0, "x", "y"), (8, "KURZ", None, "b", 0, "x", "y")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_near_duplicates(docs, empty):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (None, 3, None, None),
                          (5, 977, 5, True), (6, 1, 6, True), (7, 1, 7, True), (8, 1, 7, False)], key=str)
    assert near_dup.near_duplicates(empty).count() == 0


def test_large_nodes_branch(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL", 8)
    base = [f"v{i}" for i in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        w[(i * 3) % 200] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(base[:100] + [f"z{i}_{j}" for j in range(100)])) for i in range(30)]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in range(60)) and all(got[100 + i] == 100 + i for i in range(30))


def test_rounds_reach_the_recall():
    assert [round(near_dup.recall(n), 3) for n in (3, 8, 12, 19)] == [1.0, 0.997, 0.981, 0.924]
    need = [near_dup.rounds(n) for n in range(1, near_dup.DEPTH + 1)]
    assert need == sorted(need) and need[0] == 1 < need[-1]
    assert all(1 - (1 - near_dup.recall(n))**r >= near_dup.TARGET for n, r in enumerate(need, 1))
    assert not {*near_dup.roots(0)} & {*near_dup.roots(1)} and not (near_dup.pool(0)[0] == near_dup.pool(1)[0]).any()


def test_deep_crowds_get_fresh_tokens(spark, docs, monkeypatch):
    levels, grown = {1: 20, 5: 8, 7: 6}, []

    def grow(classes, number=0):
        rows = classes.select("k", "cls", "tokens").collect()
        grown.append({r.k: np.frombuffer(r.tokens, np.uint32) for r in rows})
        deep = spark.createDataFrame([(r.cls, levels[r.k]) for r in rows if r.k in levels], "cls long, levels int")
        return spark.createDataFrame([], near_dup.MEMBER), spark.createDataFrame([], "a long, b long"), deep

    monkeypatch.setattr(near_dup, "grow_trees", grow)
    signed = near_dup.signatures(docs).where("k is not null and cls is not null").orderBy("k").dropDuplicates(["cls"]).checkpoint()
    near_dup.grow_rounds(signed, docs, "doc_id", "text")
    # 8 levels need two rounds, 20 levels three, 6 levels one
    assert [sorted(k for k in g if k in levels) for g in grown] == [[1, 5, 7], [1, 5], [1]]
    assert {*grown[1]} == {1, 5} and {*grown[2]} == {1}
    assert len({grown[n][1].tobytes() for n in range(3)}) == 3


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 60), (60, 50), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(31)}, 50: 50, 60: 50}
    assert connected_components(edges.where("false")).count() == 0


def test_lines(spark, empty):
    rows = [(2, "a b c d e\nshort\nA  b c D e", 0), (1, "x\nA B C D E", 5), (3, None, 0), (None, "a b c d e", 0), (4, "p q r s t u", 0), (4, "p q r s t u", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank long")
    got = sorted(map(tuple, line_dedup.repeated_units(docs).collect()), key=str)
    assert got == sorted([(2, 0, 0, 9, 5, 1, 2), (2, 2, 16, 26, 5, 1, 2), (None, 0, 0, 9, 5, 1, 2), (4, 0, 0, 11, 6, 4, 0)], key=str)
    ranked = {(r.doc_id, r.start, r.first_doc) for r in line_dedup.repeated_units(docs, rank="rank").collect()}
    assert (1, 2, 2) in ranked
    cut = {r.doc_id: r.text for r in line_dedup.remove_units(docs.where("doc_id in (1, 2)"), line_dedup.repeated_units(docs.where("doc_id in (1, 2)"))).collect()}
    assert cut == {1: "x\nA B C D E", 2: "\nshort\n"}
    assert line_dedup.repeated_units(empty).count() == 0
    assert line_dedup.split_units(docs, "paragraph").count() == 5


def test_sentences_in_runs(spark, empty):
    """A copied passage inside lines is found, short sentences that repeat by chance are not."""
    passage = " ".join(f"Word{i} a b c d e f g." for i in range(6))
    rows = [(1, f"Own start here. {passage} Own end.\nYes. No."), (2, f"Other. Yes.\n\n{passage.upper()} No. And more words."), (2, "Yes. No."),
            (None, passage), (4, None), (5, ""), (6, "x " * 200_000 + ". " + passage)]
    clash = spark.createDataFrame([(k, t, 1, 2, "d") for k, t in rows], "doc_id long, text string, place int, row int, digest string")
    got = {}
    for r in line_dedup.repeated_units(clash, kind="sentence", min_words=1, run_words=40).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end, r.first_doc))
    texts = {k: t for k, t in rows if k != 2} | {2: rows[1][1]}
    assert set(got) == {2, None, 6} and all(f == 1 for spans in got.values() for *_, f in spans)
    for k, spans in got.items():
        found = " ".join(texts[k][s:e] for s, e, _ in sorted(spans))
        assert passage.lower() in found.lower() and len(found) <= len(passage) + 10
    assert line_dedup.repeated_units(empty, kind="sentence", min_words=1, run_words=40).count() == 0


def test_occurrences_of_a_frequent_sentence_are_split(spark):
    rows = [(i, f"Own words number {i % 3000}. Seen all over.", None) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = line_dedup.repeated_units(docs, kind="sentence", min_words=1)
        got = sorted((r.doc_id, r.unit, r.first_doc) for r in found.collect())
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted([(i, 0, i - 3000) for i in range(3000, 6000)] + [(i, 1, 0) for i in range(1, 6000)])
    assert "skew=true" in plan.split("Initial Plan")[0]


def test_contamination(spark, empty):
    item = "How many birds sat upon the old stone bridge that day? There were seventeen grey herons on it."
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "Tiny item.")], "item_id long, text string")
    filler = " ".join(f"f{i}" for i in range(300))
    rows = [(1, f"{filler} {item} {filler}"), (2, filler + " How many birds sat upon the old stone bridge that day? " + filler), (3, None), (None, item), (5, item), (5, item),
            (6, "There were seventeen grey herons on it."), (7, "a TINY, item")]
    found = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert sorted(((r.doc_id, r.item_id) for r in found.collect()), key=str) == sorted([(1, 1), (None, 1), (5, 1), (5, 1), (7, 4)], key=str)
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench.where("false")).count() == 0


def test_contamination_of_edited_items(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    items = {i: [str(w) for w in rng.choice(words, 32, replace=False)] for i in range(20)}
    text = {i: f"{' '.join(w[:25])}. {' '.join(w[25:])}." for i, w in items.items()}
    bench = spark.createDataFrame(sorted(text.items()), "item_id long, text string")
    rows, want = [], set()
    for i, w in items.items():
        edits = [[*w[:at], "edited", *w[at + 1:]] for at in range(len(w))] + [w[:25]]
        for edit in edits:
            # from the middle of a passage and across the border of two
            for before in (10, 64 - len(w) // 2):
                rows.append((len(rows), " ".join([*(f"f{j}" for j in range(before)), *edit, *(f"g{j}" for j in range(90))])))
                want.add((len(rows) - 1, i))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and all(r.answer_overlap == 1 and r.question_overlap >= 0.75 for r in found)
    # a table with answers keeps the check of the answer on its own
    told = spark.createDataFrame([(i, " ".join(w[:25]), " ".join(w[25:])) for i, w in items.items()], "item_id long, text string, answer string")
    assert {r.doc_id % 66 // 2 for r in decontaminate.contaminated(docs, told, answer="answer").collect()} == {*range(25)}


def test_least_score_of_a_kept_item():
    rng = np.random.default_rng(6)
    for _ in range(30):
        words = [f"w{i}" for i in rng.integers(0, 15, 14)]
        weight = {w: float(x) for w, x in zip(dict.fromkeys(words), rng.random(15))}
        each = {w: weight[w] / words.count(w) for w in weight}
        starts = [tuple(words[i:i + 5]) for i in range(10)]
        distinct = sorted(set(starts))
        worst = 0.0
        for mask in range(1 << len(distinct)):
            gone = {g for i, g in enumerate(distinct) if mask >> i & 1}
            if (len(distinct) - len(gone)) / len(distinct) >= 0.75:
                left = {w for g in starts if g not in gone for w in g}
                worst = max(worst, sum(weight[w] for w in weight if w not in left))
        assert decontaminate.score_at_risk(words, each, 0.75) >= worst - 1e-9


def test_block_bounds_lose_no_match():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words, 20)), "") for i in range(60)]
    index = decontaminate.build_index(items)
    dense = np.zeros((len(index.terms), len(index.ids)))
    for t in range(len(index.terms)):
        dense[t, index.items[index.item_at[t]:index.item_at[t + 1]]] = index.weights[index.item_at[t]:index.item_at[t + 1]]
    pairs = sorted({(p, int(t)) for p in range(200) for t in rng.choice(len(index.terms), 40)})
    passage, term = (np.array(c) for c in zip(*pairs))
    score = np.zeros((200, len(index.ids)))
    np.add.at(score, passage, dense[term])
    p, i, s = decontaminate.retrieve(index, passage, term, 0.25)
    assert set(zip(p.tolist(), i.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(score >= 0.25)))) and np.allclose(s, score[p, i])


def test_token_counts_equal_the_library(spark, docs, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["", "Don't STOP, it's 12345!", "ΑΣ ΣΑΣ. İstanbul é", "a\x1cb\x1d c", "x<|endoftext|> y<|startoftext|>", "日本語 🙂🙂  end", "aaaa" * 500, "\u0085 a b", "'s't're"]
    counter = bpe_count.counter(path)
    assert [counter.count(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    got = bpe_count.count_tokens(docs, path, limit=100).collect()
    assert len(got) == len(ROWS) and {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got}[3] == (0, 0, False)
    assert bpe_count.count_tokens(empty, path).count() == 0


def test_language(spark, docs, empty):
    texts = {"en": "the quick brown fox and the lazy dog ", "de": "der schnelle braune fuchs und der faule hund "}
    labelled = spark.createDataFrame([(i, texts[x] * (i + 1), x) for i in range(4) for x in texts] + [(9, None, "en"), (9, "", "fr"), (9, "x", None)], "doc_id long, text string, lang string")
    model = spark.sparkContext.broadcast(language.train(labelled))
    assert model.value.languages == ["de", "en"]
    asked = spark.createDataFrame([(1, "the dog", "q"), (2, "der hund", "q"), (None, None, "q"), (4, "123 !?", "q"), (5, "日本", "q"), (1, "the dog", "q")], "doc_id long, text string, lang_pred string")
    got = [(r.doc_id, r.lang_pred) for r in language.predict(asked, model).collect()]
    assert got[:4] == [(1, "en"), (2, "de"), (None, "und"), (4, "und")] and got[5] == (1, "en")
    none = spark.sparkContext.broadcast(language.train(labelled.where("false")))
    assert {r.lang_pred for r in language.predict(asked, none).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0


def test_code_lengths_follow_the_definition():
    strings = language._strings(language._joined(["abab", "abac"])[0])
    data, starts = language._joined(["abab", "abac"])
    found, n = np.unique(strings[language._own(starts, len(data))], return_counts=True)
    model = language.build(["x"], {"x": (found, n.astype(float))})
    seen = dict(zip(found.tolist(), n.tolist()))

    def cost(context, byte):
        if context is None:
            return 8.0
        k = len(context)
        after = {}
        for s, c in seen.items():
            raw = s.to_bytes(4, "big")
            if k == 0 or raw[3 - k:3] == context:
                after[raw[3]] = after.get(raw[3], 0) + c
        shorter = context[1:] if k else None
        if not after:
            return cost(shorter, byte)
        total = sum(after.values()) + len(after)
        return -np.log2(after[byte] / total) if byte in after else -np.log2(len(after) / total) + cost(shorter, byte)

    for text in ("abab", "aaz", "cab"):
        raw = b"\n\n\n" + text.encode()
        want = sum(cost(raw[i - 3:i], raw[i]) for i in range(3, len(raw)))
        assert language.code_lengths(model, [text])[0, 0] == pytest.approx(want, rel=1e-5)


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = [(i, (base + rng.normal(size=16) * s).tolist(), 1) for i, s in enumerate([0, 0.01, 0.2, 0.05, 0.15, 0.1])]
    rows += [(10, base.tolist(), 1), (11, base.tolist(), 2), (12, base.tolist(), None), (13, None, 1), (14, [0.0] * 16, 1), (15, [float("nan")] * 16, 1), (None, base.tolist(), 1),
             (16, [], 1), (17, [1.0, 2.0], 1), (18, (base * 3).tolist(), 1)]
    got = {r.vec_id: r for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), tile=3).collect() if r.vec_id is not None}
    good = {k: np.array(v) for k, v, lab in rows if lab == 1 and k is not None and v and len(v) == 16 and np.isfinite(v).all() and np.any(v)}
    links = {k: {j for j in good if j != k and good[k] @ good[j] / np.linalg.norm(good[k]) / np.linalg.norm(good[j]) >= 0.98} for k in good}
    for k, r in got.items():
        reach, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        assert (r.n_links, r.component_id, r.kept) == (len(links.get(k, ())), min(reach), min(reach) == k)
    assert embed_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_quantised_bounds_hold():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(300, 24)), rng.normal(size=(200, 24))
    a[:50] = b[:50] + rng.normal(size=(50, 24)) * 0.1
    cosine = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)[None, :]
    got = {(int(i), int(j)) for p, q in embed_dedup.tile_pairs(a, b, 0.9) for i, j in zip(p, q)}
    assert got == set(zip(*(x.tolist() for x in np.nonzero(cosine >= 0.9))))


def test_apportionment():
    def slow(votes, seats, caps):
        got = [0] * len(votes)
        for _ in range(seats):
            free = [i for i in range(len(votes)) if got[i] < caps[i] and votes[i] > 0]
            if not free:
                break
            got[max(free, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
        return got

    rng = np.random.default_rng(2)
    for _ in range(50):
        votes = [float(x) for x in rng.integers(1, 1000, 7)]
        caps = [int(x) for x in rng.integers(0, 40, 7)]
        assert mixing.apportion(votes, 60, caps) == slow(votes, 60, caps)
    assert mixing.fill_targets([10, 1000], [5, 2], 300, 2) == [20, 280]


def test_mixing_edges(docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS) and all(r.taken <= 2 * r.size for r in got)
    assert {r.size for r in got if r.doc_id in (3, 4)} == {0}
    assert mixing.mix(empty).count() == 0 and mixing.mix(docs.where("doc_id in (3, 4)")).count() == 2


def test_warc_splits_and_edges(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}</p>" * (i % 50 + 1)) for i in range(200)] + [(900, None, None), (901, "a\r\nb", ""), (None, "u", "<p>only</p>"), (902, "u", "\x1f\x8b\x08" * 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    files = warc.write_archives(warc.mark_revisits(pages, min_bytes=1), scratch(spark, "warc"))
    whole = {(r.path, r.offset, r.payload_digest) for r in warc.read_archives(spark, files).collect()}
    for split in (97, 1000):
        records = warc.read_archives(spark, files, split_bytes=split).collect()
        assert len(records) == len(rows) and {(r.path, r.offset, r.payload_digest) for r in records} == whole
    texts = {k: h or "" for k, _, h in rows}
    for r in warc.read_archives(spark, files).select("*", warc.page_key("record_id").alias("k"), warc.page_key("refers_to_id").alias("to")).collect():
        assert r.payload_bytes == len(texts[r.k].encode())
        assert (r.payload.decode() if r.record_type == "response" else texts[r.to]) == texts[r.k]
        assert r.record_type == "response" or len(texts[r.k]) >= 1
    assert warc.read_archives(spark, warc.write_archives(warc.mark_revisits(pages.where("false")), scratch(spark, "warc"))).count() == 0


def test_chat_parts_round_trip(spark):
    part = chat.PART_TYPE
    rows = [(1, 0, "user", [("text", "see <turn>\\l ", None, 0), ("image", None, "s3://i", 85), ("text", "and", None, 0), ("audio", None, "a.wav", 40)]),
            (1, 1, "assistant", [("text", "a\\\\<b", None, 0), ("document", None, "d.pdf", 7), ("text", "c</turn>\n", None, 0)]),
            (2, None, None, None), (None, 3, "as\nsistant", [("text", None, None, None)]), (3, 1, "assistant", [("text", "x", None, 0)]), (3, 1, "assistant", [("text", "x", None, 0)])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {part}")
    out = chat.format_conversations(turns)
    got = {r.conv_id: r for r in out.withColumn("turns", chat.parse_turns(F.col("formatted"))).withColumn("lost", chat.loss_text(F.col("formatted"), F.col("loss"))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "see <turn>\\l <part image 0>and<part audio 1>"), ("assistant", "a\\\\<b<part document 2>c</turn>\n")]
    assert got[1].lost == "a\\\\<bc</turn>\n" and got[3].lost == "xx"
    assert [(a.number, a.kind, a.ref, a.tokens) for a in got[1].attachments] == [(0, "image", "s3://i", 85), (1, "audio", "a.wav", 40), (2, "document", "d.pdf", 7)]
    assert all(got[1].formatted[a.start:a.end] == f"<part {a.kind} {a.number}>" for a in got[1].attachments) and got[1].attachment_tokens == 132
    assert [(t.role, t.text) for t in got[None].turns] == [("as\nsistant", "")] and [(t.role, t.text) for t in got[2].turns] == [("", "")]
    assert chat.format_conversations(turns.where("false")).count() == 0


def test_token_files_edges(spark, docs, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, encode = Tokenizer.from_file(path), token_files.encoder(path)
    texts = ["", " ", "a  b", " a", "a ", "x\n\ny z", "don't. stop! 12 34", "é è  ü", "a<|endoftext|> b", "🙂 🙂.", "\t a\x1c b", "Foo.\nBar baz,", "a , b"] + [LONG]
    for t in texts:
        assert np.frombuffer(encode.encode(t), encode.dtype).tolist() == library.encode(t, add_special_tokens=False).ids, t
    manifest = token_files.write_token_files(docs, scratch(spark, "tokens"), path)
    got = token_files.read_token_files(spark, manifest, ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 2, 3, 4, 5, 6, 7, 8]
    assert [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])[:-1])).tolist()
    assert all(list(r.ids) == library.encode(t or "", add_special_tokens=False).ids + [0] for r, t in zip(got, [ROWS[5][1], *[x[1] for x in sorted((r for r in ROWS if r[0]), key=lambda r: r[0])]]))
    assert token_files.read_token_files(spark, token_files.write_token_files(empty, scratch(spark, "tokens"), path)).count() == 0
