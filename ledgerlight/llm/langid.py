"""Language identification (operator 7): n-gram filters with a language bitmask.

A bit-sliced Bloom filter has one bit per language in each row; an n-gram of language l sets bit l in its k rows, and the
AND of an n-gram's k rows is the set of all languages that contain it. A text's hits per language are the population
counts over its n-grams' masks. A slice that is filled to f answers by chance with probability f**k, which is taken out of
each count; the language with the largest corrected share decides.

N-grams are ``order`` characters of lower-cased letters with word ends, none across a word end, so a text of any length
can be counted piece by piece at spaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, in_chunks, table

ORDER = 4
HASHES = 3
#: Documents learned from per language at most about this many, and this many over all languages.
PER_LANGUAGE, IN_ALL = 600, 40_000
#: An n-gram belongs to a language if this many of its sample documents have it.
LEAST_DOCS = 2
MOST_ROWS = 1 << 22
UNKNOWN = "und"
PIECE = 1 << 20


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.bool_, 0x110000)


def _pieces(text: str) -> Iterator[str]:
    """The text, cut at spaces into pieces of about PIECE characters (longer where there is no space)."""
    at = 0
    while len(text) - at > PIECE:
        cut = text.find(" ", at + PIECE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def ngrams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of every n-gram, the text that each belongs to, and whether each text has a letter."""
    low = [" " + t.lower() + " " for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(t) for t in low])
    letter = _letters()[codes]
    keep = letter.copy()
    keep[:-1] |= letter[1:]  # the place before a word
    keep[1:] |= letter[:-1]  # the place after it
    first = np.flatnonzero(keep)
    code, letter, owner = np.where(letter[first], codes[first], 0).astype(np.uint64), letter[first], owner[first]
    # a place after one word and a place before the next stand side by side where more than one character parts them
    some = np.bincount(owner[letter], minlength=len(texts)) > 0
    n = len(code) - order + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), some
    valid = np.ones(n, np.bool_)
    for i in range(1, order - 1):
        valid &= letter[i : n + i]
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(order):
            h = (h ^ code[i : n + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    valid &= letter[:n] | letter[order - 1 : n + order - 1]
    return h[valid], owner[:n][valid], some


class MaskFilter:
    """Bit-sliced Bloom filter over languages."""

    def __init__(self, languages: list[str], grams: list[np.ndarray], hashes: int = HASHES, most_rows: int = MOST_ROWS):
        self.languages, self.hashes = languages, hashes
        need = 8 * max((len(g) for g in grams), default=1)
        self.rows = min(most_rows, 1 << max(10, int(need - 1).bit_length()))
        words = -(-max(1, len(languages)) // 64)
        kind = next(t for t, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 1 << 62)) if len(languages) <= bits)
        self.table = np.zeros((words, self.rows), kind)
        for i, g in enumerate(grams):
            for at in self._places(g):
                self.table[i // 64, at] |= kind(1 << (i % 64))
        fill = [np.count_nonzero(self.table[i // 64] & kind(1 << (i % 64))) / self.rows for i in range(len(languages))]
        self.chance = np.array([f**hashes for f in fill])

    def _places(self, h: np.ndarray) -> Iterator[np.ndarray]:
        step = (h >> np.uint64(33)) | np.uint64(1)
        with np.errstate(over="ignore"):
            for i in range(self.hashes):
                yield ((h + np.uint64(i) * step) & np.uint64(self.rows - 1)).astype(np.int64)

    def masks(self, h: np.ndarray) -> list[np.ndarray]:
        """Languages that contain each n-gram, as bits; one array for every 64 languages."""
        places = list(self._places(h))
        out = []
        for part in self.table:
            found = part[places[0]]
            for at in places[1:]:
                found &= part[at]
            out.append(found)
        return out

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: n-grams, hits of each language (population counts of the masks), and whether it has a letter."""
        h, owner, some = ngrams(texts)
        total = np.bincount(owner, minlength=len(texts))
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        if len(h):
            masks = self.masks(h)
            for i in range(len(self.languages)):
                kind = masks[i // 64].dtype.type
                counts[:, i] = np.bincount(owner[(masks[i // 64] & kind(1 << (i % 64))) != 0], minlength=len(texts))
        return total, counts, some

    def decide(self, total: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language with the largest corrected share (ties: the first), and that share in 0..1."""
        share = counts / np.maximum(total, 1)[:, None]
        fixed = np.clip((share - self.chance) / np.maximum(1e-9, 1 - self.chance), 0.0, 1.0)
        best = fixed.argmax(axis=1)
        return best, fixed[np.arange(len(best)), best]


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 4, is 2; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, in_all: int = IN_ALL) -> MaskFilter:
    """Filter from a bounded sample of the labelled rows that are not held out.

    The sample takes the rows of a language whose hash lies under a limit that expects ``per_language`` rows (fewer where
    ``in_all`` rows are spread over more languages), whole texts. Driver memory: that sample, one language at a time.
    """
    chosen = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = sorted((r["lang"], r["n"]) for r in chosen.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count("*").alias("n")).collect())
    share = max(20, min(per_language, in_all // max(1, len(counts))))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(7)), F.lit(1 << 20))
    grams = []
    under = F.lit(False)
    for lang, n in counts:
        under = under | ((F.col("lang") == lang) & (draw < min(1 << 20, -(-share * (1 << 20) // n))))
    seen: dict[str, dict] = {}
    sample = chosen.where(under).select("lang", "text").repartition(8)  # the iterator runs a job for each partition
    for row in sample.toLocalIterator():
        got = seen.setdefault(row["lang"], _nothing())
        parts = [np.unique(ngrams([p])[0]) for p in _pieces(row["text"])]
        got["held"].append(np.unique(np.concatenate(parts)))
        got["n"] += 1
        if len(got["held"]) >= 64:
            _merge(got)
    for lang, _ in counts:
        got = seen.get(lang, _nothing())
        _merge(got)
        grams.append(got["more"] if got["n"] >= 20 else got["once"])  # a small sample keeps what it saw once
    return MaskFilter([lang for lang, _ in counts], grams)


def _nothing() -> dict:
    return {"once": np.empty(0, np.uint64), "more": np.empty(0, np.uint64), "held": [], "n": 0}


def _merge(got: dict) -> None:
    """Fold the held documents' n-grams into those seen in one and in LEAST_DOCS or more documents."""
    if got["held"]:
        values, n = np.unique(np.concatenate([*got["held"], got["once"]]), return_counts=True)
        got["more"] = np.union1d(got["more"], values[n >= LEAST_DOCS])
        got["once"] = values
        got["held"] = []


def predict(docs: DataFrame, model: MaskFilter) -> DataFrame:
    """docs with lang_pred and score. Null text and texts without a letter: und, 0. A text with letters but no n-gram of
    any language: the first language, 0. With no language learned: und. Columns of those names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MOST_ROWS rows of one bit per language
    keep = [c for c in docs.columns if c.lower() not in {"lang_pred", "score"}]
    fields = [f for f in docs.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in in_chunks(batches, "text", PIECE):
            pieces, owner = [], []
            for i, t in enumerate(batch.column(batch.schema.get_field_index("text")).to_pylist()):
                for p in _pieces(t or ""):
                    pieces.append(p)
                    owner.append(i)
            total = np.zeros(batch.num_rows, np.int64)
            counts = np.zeros((batch.num_rows, len(model.languages)), np.int64)
            some = np.zeros(batch.num_rows, np.bool_)
            lo = 0
            while lo < len(pieces):  # slices of about a piece
                hi, size = lo + 1, len(pieces[lo])
                while hi < len(pieces) and size + len(pieces[hi]) <= PIECE:
                    size += len(pieces[hi])
                    hi += 1
                t, c, s = model.hits(pieces[lo:hi])
                np.add.at(total, owner[lo:hi], t)
                np.add.at(counts, owner[lo:hi], c)
                np.logical_or.at(some, owner[lo:hi], s)
                lo = hi
            if model.languages:
                best, score = model.decide(total, counts)
                names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), some.tolist())]
                score = np.where(some, score, 0.0)
            else:
                names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())], [*keep, "lang_pred", "score"])

    schema = type(docs.schema)(fields).add("lang_pred", "string").add("score", "double")
    return arrow_map(docs.select(*[F.col(f"`{c}`") for c in keep]), run, schema)


#: Least corrected share of known n-grams; prose of a learned language has several times as much.
LEAST_SCORE = 0.2


def keep_languages(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of docs, as they are, whose text is in a learned language with at least that score."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    inner = docs.select(F.struct(*others, F.lit(0)).alias("row"), F.col("text").cast("string").alias("text"))
    judged = predict(inner, fit(docs))
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def op7_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict(docs.select(F.col("doc_id").cast("long"), "text"), fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op7_langid": op7_langid}
ORACLE_SQL: dict[str, str] = {}
