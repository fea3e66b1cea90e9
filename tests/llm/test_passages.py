"""Repeated passages of words against a dictionary of all windows."""

import random
import re

from quantelle.llm import line_dedup, passages


def passages_by_hand(rows, words):
    """Spans of all windows that stand earlier, too; every pair of places is looked at through one dictionary."""
    seen, out = set(), []
    for k, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        found = list(re.finditer(r"[^\x20\x09-\x0D]+", t or ""))
        plain = [m.group().translate({c: c + 32 for c in range(65, 91)}) for m in found]
        gone = set()
        for i in range(len(plain) - words + 1):
            window = tuple(plain[i:i + words])
            if window in seen:
                gone.update(range(i, i + words))
            seen.add(window)
        for i in sorted(gone):
            if i - 1 not in gone:
                last = next(j for j in range(i, len(plain) + 1) if j not in gone) - 1
                out.append((k, found[i].start(), found[last].end(), last - i + 1))
    return sorted(out, key=str)


def test_passages_inside_sentences(spark):
    """Copies that begin and end inside longer sentences are found; sentences in runs miss them."""
    rng = random.Random(5)
    text = lambda n, of=4000: " ".join(f"w{rng.randrange(of)}" for _ in range(n))
    passage = text(60)
    rows = [(1, f"{text(30)} {passage} {text(30)}. End."), (2, f"É {text(9)}\n\u3000{text(9)} {passage.upper()} {text(9)}."), (3, f"{text(20)} {passage[:-1]}~ {text(9)}"),
            (4, None), (5, ""), (6, "x " * 3000), (7, passage.replace(" ", "\t\n ")), (8, " ".join(passage.split()[:49])), (9, text(400, 2)), (10, text(400, 2)),
            (None, f"{text(5)} {passage}"), (None, text(80)), (11, f"{passage} {passage}"), (12, f"\u00a0{passage}"), (12, f" {text(70)}\x1c{passage}")]
    long = [text(700) for _ in range(6)]
    for i in range(13, 60):  # cut and put together at places of all kinds
        cuts = [long[rng.randrange(6)].split()[(a := rng.randrange(600)):a + rng.randrange(40, 100)] for _ in range(rng.randrange(6))]
        rows.append((i, f"{text(20)} " + " ".join(f"{' '.join(c)} {text(rng.randrange(3))}" for c in cuts)))
    docs = spark.createDataFrame([(k, t, "d", 1) for k, t in rows], "doc_id long, text string, digest string, place int").coalesce(1)
    for words in (50, 32):
        got = sorted(map(tuple, passages.repeated_passages(docs, words).collect()), key=str)
        assert got == passages_by_hand(rows, words)
    found = {r.doc_id for r in passages.repeated_passages(docs.repartition(7)).collect()}
    assert {2, 3, 7, 6, 11, 12, None} <= found and not found & {1, 4, 5, 8}
    assert 2 not in {r.doc_id for r in line_dedup.repeated_units(docs, kind="sentence", min_words=1, run_words=40).collect()}
    cut = {r.doc_id: r.text for r in line_dedup.remove_units(docs.where("doc_id in (1, 2)"), passages.repeated_passages(docs.where("doc_id in (1, 2)"))).collect()}
    assert cut[1] == rows[0][1] and cut[2] == rows[1][1].replace(passage.upper(), "")
    assert passages.repeated_passages(docs.where("false")).count() == 0
