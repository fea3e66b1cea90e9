"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of up to three bytes with frozen counts. A byte is
coded in the longest known context; where it was never seen there, an escape is coded
and the context loses its first byte, down to a uniform code of eight bits (escape
probability: distinct bytes over distinct bytes plus occurrences; no exclusion). The
language with the shortest code for the whole text is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, ship, slices, slices_of

ORDER = 4  # bytes in the longest string: three of context and the coded one
_START = b"\n" * (ORDER - 1)
_LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"
#: Distinct strings that a task holds before it sends their counts on.
MAX_HELD = 1_000_000


@dataclass
class Model:
    """Context trees of all languages over the union of their strings.

    ``keys[k]`` holds the seen strings of ``k + 1`` bytes as sorted big-endian numbers,
    ``bits[k][:, l]`` the code length of their last byte after the others in language
    ``l``, ``escapes[k][:, l]`` the cost of an escape in the string as a context (strings
    of ``ORDER`` bytes are none).
    """

    languages: list[str]
    keys: list[np.ndarray]
    bits: list[np.ndarray]
    escapes: list[np.ndarray]
    root: np.ndarray  # cost of a byte that a language never had: escape from the empty context and eight bits


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each after start bytes, and the position of each text's first byte."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.cumsum([0] + [len(r) + len(_START) for r in raw])[:-1] + len(_START)
    return np.frombuffer(b"".join(part for r in raw for part in (_START, r)), np.uint8), starts


def _strings(data: np.ndarray) -> np.ndarray:
    """The ``ORDER`` bytes that end at each position from ``ORDER - 1`` on, as numbers."""
    out = data[:len(data) - ORDER + 1].astype(np.uint32)
    for k in range(1, ORDER):
        out = (out << np.uint32(8)) | data[k:len(data) - ORDER + 1 + k]
    return out


def _own(starts: np.ndarray, total: int) -> np.ndarray:
    """Whether the string ending at each position codes a text byte and not a start byte."""
    own = np.ones(total, bool)
    for k in range(len(_START)):
        own[starts - 1 - k] = False
    return own[ORDER - 1:]


def train(labelled: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Count strings in all labelled rows.

    Every text is counted whole on the executors, where a task adds up its strings before
    they are shuffled; the driver gets one row per language and distinct string of four
    bytes. Rows with NULL labels, texts or empty texts teach nothing; without any the
    model has no language.
    """
    rows = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).where("lang is not null and text <> ''")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for name, (found, times) in held.items():
                yield pa.RecordBatch.from_pydict({"lang": [name] * len(found), "string": pa.array(found, pa.int64()), "n": pa.array(times, pa.int64())})
            held.clear()

        for batch in batches:
            langs, sizes = batch.column("lang").to_pylist(), pc.utf8_length(batch.column("text")).to_pylist()
            for low, high in slices_of(sizes, 1_000_000):
                texts = batch.column("text").slice(low, high - low).to_pylist()
                for name in sorted(set(langs[low:high])):
                    data, starts = _joined([t for t, x in zip(texts, langs[low:high]) if x == name])
                    found, times = np.unique(_strings(data)[_own(starts, len(data))], return_counts=True)
                    if name in held:
                        found, which = np.unique(np.concatenate((held[name][0], found)), return_inverse=True)
                        sums = np.zeros(len(found), np.int64)
                        np.add.at(sums, which, np.concatenate((held[name][1], times)))
                        times = sums
                    held[name] = found, times
                if sum(len(f) for f, _ in held.values()) > MAX_HELD:
                    yield from flushed()
        yield from flushed()

    ship(labelled.sparkSession)
    counts = rows.mapInArrow(count, "lang string, string long, n long").groupBy("lang", "string").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # arrays, as an object for each row and value takes the driver some 600 bytes a row
    seen = {}
    for name in pc.unique(table["lang"]).to_pylist():
        own = table.filter(pc.equal(table["lang"], name))
        seen[name] = own["string"].to_numpy().astype(np.uint32), own["n"].to_numpy().astype(np.float64)
    return build(sorted(seen), seen)


def build(languages: list[str], seen: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Code lengths from counted strings of ``ORDER`` bytes."""
    languages = [x for x in languages if x in seen and len(seen[x][0])]
    union = np.unique(np.concatenate([seen[x][0] for x in languages])) if languages else np.empty(0, np.uint32)
    # both what is coded and the contexts before it, some of which hold start bytes only
    keys = [np.unique(np.concatenate((union, union >> np.uint32(8))) & np.uint32(2**(8 * k) - 1)) for k in range(1, ORDER)] + [union]
    bits = [np.empty((len(k), len(languages)), np.float32) for k in keys]
    escapes = [np.zeros((len(k), len(languages)), np.float32) for k in keys[:-1]]
    root = np.full(len(languages), 8.0)
    for at, name in enumerate(languages):
        strings, times = seen[name]
        below = np.empty(0)  # code lengths of the strings of one byte less
        for k in range(ORDER):
            size = len(keys[k])
            tail = strings & np.uint32(2**(8 * (k + 1)) - 1)
            n = np.bincount(np.searchsorted(keys[k], tail), times, size)
            context = (keys[k] >> np.uint32(8)) if k else np.zeros(size, np.uint32)
            groups, which = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(which, n, len(groups)), np.bincount(which, n > 0, len(groups))
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                own = -np.log2(n / (total[which] + kinds[which]))
            if k:  # where unseen: escape, then the same byte after a context without its first byte
                back = below[np.searchsorted(keys[k - 1], keys[k] & np.uint32(2**(8 * k) - 1))]
                place = np.searchsorted(keys[k - 1], groups)
                known = (place < len(keys[k - 1])) & (keys[k - 1][np.minimum(place, len(keys[k - 1]) - 1)] == groups)
                escapes[k - 1][place[known], at] = escape[known]
            else:
                back, root[at] = 8.0, 8.0 + escape[0]
            below = np.where(n > 0, own, escape[which] + back)
            bits[k][:, at] = below
    return Model(languages, keys, bits, escapes, root)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def byte_costs(model: Model, strings: np.ndarray) -> np.ndarray:
    """Code length in every language of the last byte of each string of ``ORDER`` bytes."""
    at, known = _find(model.keys[-1], strings)
    cost = model.bits[-1][at]
    rest = np.flatnonzero(~known)
    if len(rest):
        cost[rest] = 0
    for k in range(ORDER - 1, 0, -1):  # never seen: escape from the context, shorten, look again
        if not len(rest):
            break
        tail = strings[rest] & np.uint32(2**(8 * (k + 1)) - 1)
        place, there = _find(model.keys[k - 1], tail >> np.uint32(8))
        cost[rest[there]] += model.escapes[k - 1][place[there]]
        place, there = _find(model.keys[k - 1], tail & np.uint32(2**(8 * k) - 1))
        cost[rest[there]] += model.bits[k - 1][place[there]]
        rest = rest[~there]
    cost[rest] += model.root.astype(np.float32)
    return cost


def code_lengths(model: Model, texts: list[str]) -> np.ndarray:
    """Bits of every text in every language, ``len(texts)`` by languages."""
    out = np.zeros((len(texts), len(model.languages)))
    full = [i for i, t in enumerate(texts) if t]
    for low, high in slices([texts[i] for i in full], 200_000):  # some 20 MB of arrays
        part = full[low:high]
        data, starts = _joined([texts[i] for i in part])
        cost = byte_costs(model, _strings(data))
        cost[~_own(starts, len(data))] = 0
        out[part] = np.add.reduceat(cost, starts - (ORDER - 1), axis=0, dtype=np.float64)
    return out


def bits_per_byte(labelled: DataFrame, model: Broadcast, lang: str = "lang", text: str = "text") -> dict[str, float]:
    """Mean code length of a byte of all labelled rows in their own language, one for each
    language of the model. Rows are added up as whole thousandths of a bit, so that the means
    do not depend on how rows are placed."""
    rows = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).where("lang is not null and text <> ''")
    if not model.value.languages:
        return {}

    def cost(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known: Model = model.value
        langs = batch.column("lang").to_pylist()
        for low, high in slices_of(pc.utf8_length(batch.column("text")).to_pylist(), 200_000):
            rows_ = [(x, t) for x, t in zip(langs[low:high], batch.column("text").slice(low, high - low).to_pylist()) if x in known.languages]
            bits = code_lengths(known, [t for _, t in rows_])
            own = [round(1000 * float(b[known.languages.index(x)])) for (x, _), b in zip(rows_, bits)]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([x for x, _ in rows_], pa.string()), "bits": pa.array(own, pa.int64()),
                                              "n": pa.array([len(t.encode("utf-8", "surrogatepass")) for _, t in rows_], pa.int64())})

    found = in_arrow(rows, cost, "lang string, bits long, n long")
    return {r.lang: r.bits / 1000 / r.n for r in found.groupBy("lang").agg(F.sum("bits").alias("bits"), F.sum("n").alias("n")).collect()}


def familiar(text: Column, model: Broadcast, usual: dict[str, float], factor: float = 1.5, slack: float = 64.0) -> Column:
    """Whether a text has a letter and its shortest code is at most ``factor`` times as long
    as usual for its bytes in that language (``usual`` as by :func:`bits_per_byte`), plus
    ``slack`` bits. Noise and texts in languages that were not learned take longer codes.
    False for NULL, and for all texts where no language was learned.

    Only the text goes to Python, and one bit comes back.
    """
    @F.arrow_udf("boolean")
    def told(texts: pa.Array) -> pa.Array:
        known: Model = model.value
        limit = np.array([factor * usual.get(x, np.inf) for x in known.languages])
        out = np.zeros(len(texts), bool)
        for low, high in slices_of(pc.coalesce(pc.utf8_length(texts), pa.scalar(0, pa.int32())).to_pylist(), 200_000):
            some = texts[low:high].to_pylist()
            asked = [i for i, t in enumerate(some) if t and known.languages and _LETTER.search(t)]
            if asked:
                bits = code_lengths(known, [some[i] for i in asked])
                size = np.array([len(some[i].encode("utf-8", "surrogatepass")) for i in asked])
                best = bits.argmin(axis=1)
                out[low + np.array(asked)] = bits.min(axis=1) <= limit[best] * size + slack
        return pa.array(out)

    return told(text)


def predict(documents: DataFrame, model: Broadcast, text: str = "text", lang_column: str = "lang_pred", score_column: str = "score") -> DataFrame:
    """Add the predicted language and its score to every row; whole texts are coded.

    ``score`` is the probability of the language given the text, all languages equally
    likely before. A NULL text, a text without a letter, or a model without languages
    gives ``und`` with score 0. Of equal codes the language that sorts first wins.
    Other columns are kept; repeated rows get equal results.
    """
    documents = documents.drop(lang_column, score_column)  # columns of these names are replaced
    kinds = documents.schema.fields
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kinds] + [f"`{lang_column}` string", f"`{score_column}` double"])

    def code(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known: Model = model.value
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        asked = [i for i, t in enumerate(texts) if t and known.languages and _LETTER.search(t)]
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if asked:
            bits = code_lengths(known, [texts[i] for i in asked])
            best = bits.argmin(axis=1)
            chance = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0)).sum(axis=1)
            for i, b, c in zip(asked, best, chance):
                langs[i], scores[i] = known.languages[b], c
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                         names=[*batch.schema.names, lang_column, score_column])

    return in_arrow(documents, code, schema)


def fold(key: Column) -> Column:
    """Fold 0, 1 or 2 of a document; fold 1 is held out of training."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % 3
