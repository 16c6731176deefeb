"""Operator 10: language identification with spans for mixed-language text.

Every word gets a score for each learned language: naive-Bayes log probabilities of its byte
n-grams and of the word itself, in hashed tables. The scripts of a word's letters narrow its
candidates to the languages that use them. Viterbi then labels the words of a text, paying a
penalty at each switch, so spans of one language come out whole. The text's language is the one
with the most letters; the score is its share of the letters.

The tables are learned from at most ``rows_per_language`` labelled texts and ``chars_per_language``
characters a language, chosen by digest of their ids, whole texts; so what is broadcast has a fixed size.

Defined cases: a null text or one without a letter is ``und`` with score 0; rows without a label
are not learned from; with no labelled rows at all every text is ``und``; a null id counts as an
empty one. Extra columns are ignored, and none but the text is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import _bytes

UNDETERMINED = "und"
_BITS = 16
_ORDERS = (1, 2, 3, 4)

#: Unicode ranges of scripts, first and last code point. Everything else is common or Latin.
SCRIPTS = [
    (0x0370, 0x03FF, "Greek"),
    (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"),
    (0x0590, 0x05FF, "Hebrew"),
    (0x0600, 0x06FF, "Arabic"),
    (0x0900, 0x097F, "Devanagari"),
    (0x0E00, 0x0E7F, "Thai"),
    (0x10A0, 0x10FF, "Georgian"),
    (0x1100, 0x11FF, "Hangul"),
    (0x3040, 0x30FF, "Kana"),
    (0x3400, 0x9FFF, "Han"),
    (0xAC00, 0xD7AF, "Hangul"),
]
_FIRST = np.array([a for a, _, _ in SCRIPTS])
_LAST = np.array([b for _, b, _ in SCRIPTS])

# ASCII letters to lower case, other ASCII to spaces, bytes of longer characters as they are
_LETTERS = _bytes.LOWER.copy()
_LETTERS[:0x80] = np.where((_LETTERS[:0x80] >= 0x61) & (_LETTERS[:0x80] <= 0x7A), _LETTERS[:0x80], 0x20)


@dataclass
class Model:
    languages: list[str]
    grams: list[np.ndarray]  # for each order: hashed gram x language, log probability
    word: np.ndarray  # hashed word x language
    scripts: np.ndarray  # script x language: may the language use it
    penalty: float


def _framed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words one after the other, each between two marks, and where each begins."""
    sizes = ends - starts + 2
    at = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), 0x5F, dtype=np.uint8)
    inner = np.ones(len(out), dtype=bool)
    inner[at] = inner[at + sizes - 1] = False
    out[inner] = data[np.repeat(starts - (at - 2 * np.arange(len(at))), ends - starts) + np.arange(int((ends - starts).sum()))]
    return out, at


def _gram_codes(framed: np.ndarray, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed code of the gram at each byte, and whether it lies within its word."""
    n = len(framed)
    code = np.zeros(n, dtype=np.uint64)
    wide = framed.astype(np.uint64)
    for k in range(order):
        code[: n - k] = code[: n - k] * np.uint64(257) + wide[k:]
    ends = np.append(at[1:], n)
    inside = np.arange(n) + order <= np.repeat(ends, np.diff(np.append(at, n)))
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)).astype(np.int64), inside


def _word_scripts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each word the index of a script that it uses, -1 for Latin or none."""
    lead = np.flatnonzero(data >= 0xC0)
    out = np.full(len(starts), -1, dtype=np.int64)
    if not len(lead) or not len(starts):
        return out
    byte = lambda k: data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 0x3F
    b = data[lead].astype(np.int64)
    point = np.where(b < 0xE0, ((b & 0x1F) << 6) | byte(1), ((b & 0x0F) << 12) | (byte(1) << 6) | byte(2))
    point[b >= 0xF0] = 0
    k = np.searchsorted(_FIRST, point, side="right") - 1
    hit = (k >= 0) & (point <= _LAST[np.maximum(k, 0)])
    word = np.searchsorted(starts, lead[hit], side="right") - 1
    good = (word >= 0) & (lead[hit] < ends[np.maximum(word, 0)])
    np.maximum.at(out, word[good], k[hit][good])
    return out


def _lettered(chunk: _bytes.Chunk) -> _bytes.Chunk:
    return _bytes.Chunk(chunk.first, _LETTERS[chunk.data], chunk.offsets)


def fit(sample: list[tuple[str, str]], penalty: float = 6.0) -> Model:
    """Tables from (language, text) rows. Every table is smoothed by half a count."""
    languages = sorted({lang for lang, _ in sample})
    many = len(languages)
    grams = [np.full((1 << _BITS, many), 0.5, dtype=np.float64) for _ in _ORDERS]
    word = np.full((1 << _BITS, many), 0.5, dtype=np.float64)
    scripts = np.zeros((len(SCRIPTS), many))
    for i, lang in enumerate(languages):
        total = 0
        for chunk in _bytes.chunks(pa.array([t for x, t in sample if x == lang], pa.large_string())):
            low = _lettered(chunk)
            starts, ends, _ = _bytes.word_bounds(low)
            if not len(starts):
                continue
            framed, at = _framed(low.data, starts, ends)
            for table, order in zip(grams, _ORDERS, strict=True):
                code, inside = _gram_codes(framed, at, order)
                table[:, i] += np.bincount(code[inside], minlength=1 << _BITS)
            word[:, i] += np.bincount((_bytes.span_hashes(low.data, starts, ends) >> np.uint64(64 - _BITS)).astype(np.int64), minlength=1 << _BITS)
            kinds = _word_scripts(low.data, starts, ends)
            scripts[:, i] += np.bincount(kinds[kinds >= 0], minlength=len(SCRIPTS))
            total += len(starts)
        scripts[:, i] /= max(total, 1)
    logs = []
    for table in [*grams, word] if many else []:
        p = np.log(table / table.sum(axis=0))
        logs.append((p - p.mean(axis=1, keepdims=True)).astype(np.float32))
    allowed = scripts >= 0.01
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, logs[:-1], logs[-1] if many else word, allowed, penalty)


def word_scores(model: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Score of each word for each language."""
    framed, at = _framed(data, starts, ends)
    out = np.zeros((len(starts), len(model.languages)), dtype=np.float32)
    for table, order in zip(model.grams, _ORDERS, strict=True):
        code, inside = _gram_codes(framed, at, order)
        out += np.add.reduceat(table[code] * inside[:, None], at, axis=0)
    out *= 0.25
    out += model.word[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)]
    kinds = _word_scripts(data, starts, ends)
    out[kinds >= 0] -= np.where(model.scripts[kinds[kinds >= 0]], 0, 1000).astype(np.float32)
    return out


def viterbi(scores: np.ndarray, which: np.ndarray, first: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word; word k of text i is row ``which[first[i] + k]`` of ``scores``.
    All texts advance together, longest first, so that the ones still going stay in front."""
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    out = np.zeros(len(which), dtype=np.int16)
    if not len(sizes) or not sizes[0]:
        return out
    going = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    states = scores.shape[1]
    back = np.empty((len(which), states), dtype=np.int8 if states < 128 else np.int16)
    own = np.arange(states)
    best = scores[which[first[: going[0]]]].astype(np.float64)
    for t in range(1, sizes[0]):
        m = going[t]
        here = first[:m] + t
        last = best[:m]
        arg = last.argmax(axis=1)
        jump = last[np.arange(m), arg] - penalty
        stay = last >= jump[:, None]
        back[here] = np.where(stay, own, arg[:, None])
        best[:m] = np.where(stay, last, jump[:, None]) + scores[which[here]]
    label = best.argmax(axis=1)
    for t in range(sizes[0] - 1, -1, -1):
        m = going[t]
        here = first[:m] + t
        out[here] = label[:m]
        if t:
            label[:m] = back[here, label[:m]]
    return out


def label_chunk(model: Model, chunk: _bytes.Chunk):
    """Word bounds in bytes, row and label of each word, and letters by row and language."""
    low = _lettered(chunk)
    starts, ends, rows = _bytes.word_bounds(low)
    many = len(model.languages)
    letters = np.zeros((len(chunk), many))
    if not len(starts) or not many:
        return starts, ends, rows, np.zeros(len(starts), dtype=np.int16), letters
    found, first, which = _bytes.distinct(_bytes.span_hashes(low.data, starts, ends))
    scores = word_scores(model, low.data, starts[first], ends[first], found)
    edges = np.searchsorted(rows, np.arange(len(chunk) + 1), side="left")
    labels = viterbi(scores, which, edges[:-1], np.diff(edges), model.penalty)
    sums = np.concatenate(([0], np.cumsum((low.data & 0xC0) != 0x80)))  # characters, not bytes
    np.add.at(letters, (rows, labels), sums[ends] - sums[starts])
    return starts, ends, rows, labels, letters


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _predict(shared, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            column = batch.column("text")
            for chunk in _bytes.chunks(column, 1 << 20):
                best, score, (starts, ends, rows, labels) = identify(model, chunk)
                out = [batch.column("doc_id").slice(chunk.first, len(chunk)), pa.array(names[best], pa.string()), pa.array(score, pa.float64())]
                if spans:
                    out.append(_span_lists(chunk, starts, ends, rows, labels, best, model.languages))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "lang_pred", "score", "spans"][: len(out)])

    return run


def identify(model: Model, chunk: _bytes.Chunk):
    """Of each row the index of its language, -1 if undetermined, and its score; and label_chunk's words."""
    starts, ends, rows, labels, letters = label_chunk(model, chunk)
    if not letters.shape[1]:
        return np.full(len(chunk), -1), np.zeros(len(chunk)), (starts, ends, rows, labels)
    total = letters.sum(axis=1)
    best = np.where(total > 0, letters.argmax(axis=1), -1)
    plain = np.zeros(len(chunk), dtype=bool)  # rows with an ASCII letter need no closer look
    if len(starts):
        plain[rows[_LETTERS[chunk.data[starts]] < 0x80]] = True
    for row in np.flatnonzero((best >= 0) & ~plain):
        if not _has_letter(chunk.data[chunk.offsets[row] : chunk.offsets[row + 1]].tobytes().decode()):
            best[row] = -1
    score = np.where(best >= 0, letters[np.arange(len(chunk)), np.maximum(best, 0)] / np.maximum(total, 1), 0.0)
    return best, score, (starts, ends, rows, labels)


def _span_lists(chunk, starts, ends, rows, labels, best, languages) -> pa.Array:
    """Runs of words with one label as [start, end, lang], in code points of the text."""
    at = np.concatenate(([0], np.cumsum((chunk.data & 0xC0) != 0x80)))
    lists: list[list[dict]] = [[] for _ in range(len(chunk))]
    if len(starts):
        new = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (labels[1:] != labels[:-1]))))
        for a, b in zip(new, np.append(new[1:], len(starts)), strict=True):
            row = rows[a]
            if best[row] >= 0:
                base = at[chunk.offsets[row]]
                lists[row].append({"start": int(at[starts[a]] - base), "end": int(at[ends[b - 1]] - base), "lang": languages[labels[a]]})
    return pa.array(lists, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))


def crc_of(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")))


def train(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows_per_language: int = 300, chars_per_language: int = 4_000_000, penalty: float = 6.0) -> Model:
    """Fit on at most ``rows_per_language`` labelled texts a language, those of the least digests,
    and of these on the first that together hold at most ``chars_per_language`` characters."""
    named = df.select(df[key].alias("doc_id"), df[text].alias("text"), df[lang].alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    h = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    chosen = named.select("lang", "doc_id", h.alias("h"), F.length("text").alias("chars")).withColumn("nth", nth).filter(F.col("nth") <= rows_per_language)
    together = F.sum("chars").over(Window.partitionBy("lang").orderBy("nth"))
    ids = chosen.withColumn("together", together).filter((F.col("together") <= chars_per_language) | (F.col("nth") == 1)).select("lang", F.col("doc_id").alias("its"))
    sample = named.join(F.broadcast(ids), (named["doc_id"].eqNullSafe(F.col("its"))) & (named["lang"] == ids["lang"]), "left_semi")
    return fit(sorted((r["lang"], r["text"]) for r in sample.select("lang", "text").collect()), penalty)


def predict(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", spans: bool = False) -> DataFrame:
    """One row per text: doc_id, lang_pred, score and, if asked for, spans."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(df[key].alias("doc_id"), df[text].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double" + (", spans array<struct<start: int, end: int, lang: string>>" if spans else "")
    return rows.mapInArrow(_predict(shared, spans), schema)


def keep_identified(df: DataFrame, model: Model, text: str = "text", least_score: float = 0.5) -> DataFrame:
    """The rows of ``df``, unchanged, whose text has a language with at least that share of its letters."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = [np.zeros(0, dtype=bool)]
            for chunk in _bytes.chunks(batch.column(at), 1 << 20):
                best, score, _ = identify(shared.value, chunk)
                stays.append((best >= 0) & (score >= least_score))
            yield batch.filter(pa.array(np.concatenate(stays)))

    return df.mapInArrow(run, df.schema)
