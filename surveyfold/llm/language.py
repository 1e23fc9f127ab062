"""Language ID by error-correcting output codes.

Every language has a codeword of +1 / -1 bits: for few languages the exhaustive
code (every split of the languages in two, once), for many a seeded random code
whose rows are kept far apart. For each bit a binary classifier over hashed
character 1- to 3-grams tells the languages with +1 from those with -1: its
weight for an n-gram is the log of the ratio of the two sides' smoothed rates,
every language of a side counting alike. A text's margin for a bit is the sum
of its n-grams' weights over the root of their number. Decoding takes the
language whose codeword has the least logistic loss over all bits, so a
confident bit counts more than a doubtful one; a second codeword nearly as
close makes the text ambiguous.

The classifiers are fitted on at most about ``per_language`` rows of each
language, picked by a hash of the id; counting them is a Spark job that returns
one row per n-gram bucket and language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import bound_batches, is_held_out, tidy

BUCKETS = (1 << 11, 1 << 13, 1 << 15)         # of 1-, 2- and 3-grams
OFFSETS = (0, BUCKETS[0], BUCKETS[0] + BUCKETS[1])
WIDTH = sum(BUCKETS)
PER_LANGUAGE = 3000
SMOOTHING = 0.05
CHUNK = 1 << 18                               # characters at a time
AMBIGUOUS = 0.6                               # scores below are flagged
EXHAUSTIVE = 7                                # languages with an exhaustive code


def codewords(languages: int, seed: int = 3) -> np.ndarray:
    """(languages, bits) of +1 / -1; every row is distinct."""
    if languages <= 1:
        return np.ones((languages, 1), dtype=np.int8)
    if languages <= EXHAUSTIVE:
        splits = range(1 << (languages - 1), (1 << languages) - 1)
        return np.array([[1 if s >> k & 1 else -1 for s in splits] for k in range(languages)], dtype=np.int8)
    bits = int(np.ceil(10 * np.log2(languages)))
    best, distance = None, -1
    for k in range(50):
        code = np.random.default_rng([seed, k]).choice(np.array([-1, 1], dtype=np.int8), (languages, bits))
        both = np.abs(code.sum(axis=0)) < languages
        apart = min(((bits - code @ code.astype(int).T) // 2 + np.eye(languages, dtype=int) * bits).min(), bits)
        if both.all() and apart > distance:
            best, distance = code, apart
    return best


# --- n-grams -----------------------------------------------------------------

@functools.cache
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def letters(text: str) -> np.ndarray:
    """Lower-case code points, every run of other characters one space, spaces at both ends."""
    low = (" " + text.lower() + " ").encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(low, dtype="<u4")
    is_letter = letter_table()[points]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[0] = True
    return np.where(is_letter, points, 32)[keep].astype(np.uint64)


def grams(points: np.ndarray) -> np.ndarray:
    """Buckets of all 1-, 2- and 3-grams, (3, n): shorter rows are padded with -1."""
    k = np.uint64(0x9E3779B97F4A7C15)
    out = np.full((3, len(points)), -1, dtype=np.int64)
    h = np.zeros(len(points), dtype=np.uint64)
    for n in range(3):
        h = h[:len(points) - n] * k + points[n:] + np.uint64(1)
        mixed = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        out[n, :len(h)] = (mixed >> np.uint64(40)) % np.uint64(BUCKETS[n])
        out[n, :len(h)] += OFFSETS[n]
    return out


# --- model -------------------------------------------------------------------

class Model(NamedTuple):
    languages: list[str]
    code: np.ndarray              # (languages, bits)
    weights: np.ndarray           # (buckets + 1, bits); the last row is zero

    def margins(self, text: str) -> tuple[np.ndarray, int]:
        """Margin per bit and number of letters, over the whole text."""
        total, n, count = np.zeros(self.code.shape[1]), 0, 0
        points = letters(text)
        for at in range(0, len(points), CHUNK):
            part = points[at:at + CHUNK + 2]
            found = grams(part)[:, :CHUNK]
            found = found[found >= 0]
            total += self.weights[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        count = int((points != 32).sum())
        return total / max(1.0, n) ** 0.5, count

    def decode(self, margins: np.ndarray) -> tuple[int, float]:
        """Nearest codeword by logistic loss, and its share against the others."""
        loss = np.logaddexp(0, -self.code * margins).sum(axis=1)
        share = np.exp(loss.min() - loss)
        best = int(loss.argmin())
        return best, float(1 / share.sum())

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous); no letters, or nothing learned: und, 0, true."""
        margins, count = self.margins(text) if text else (None, 0)
        if not count or not self.languages:
            return "und", 0.0, True
        best, score = self.decode(margins)
        return self.languages[best], score, score < AMBIGUOUS


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 5) -> Model:
    """Learn from text and lang of the rows that are not held out.

    Rows with a null lang or text teach nothing. The driver gets one row per
    language and one per (n-gram bucket, language) that occurs.
    """
    bound_batches(docs.sparkSession)
    usable = docs.filter(~is_held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    languages = sorted(counts)
    code = codewords(len(languages))
    if not languages:
        return Model([], code, np.zeros((WIDTH + 1, 1), dtype=np.float32))
    rates = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, per_language / counts[k])))])
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    index = {k: i for i, k in enumerate(languages)}

    @tidy
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, np.ndarray] = {}
        for f in batches:
            for lang, text in zip(f["lang"], f["text"], strict=True):
                points = letters(text)
                sums = seen.setdefault(index[lang], np.zeros(WIDTH))
                one = np.zeros(WIDTH)
                for at in range(0, len(points), CHUNK):
                    found = grams(points[at:at + CHUNK + 2])[:, :CHUNK]
                    one += np.bincount(found[found >= 0], minlength=WIDTH)
                sums += one / max(1.0, one.sum()) ** 0.5      # a long text is not worth its whole length
        for k, sums in seen.items():
            hit = np.flatnonzero(sums)
            yield pd.DataFrame({"lang": k, "bucket": hit, "weight": sums[hit]})

    found = (usable.filter(draw < rates[F.col("lang")]).select("lang", "text")
             .mapInPandas(count, "lang int, bucket int, weight double")
             .groupBy("lang", "bucket").agg(F.sum("weight").alias("weight")).toPandas())
    table = np.zeros((len(languages), WIDTH))
    table[found.lang.to_numpy(), found.bucket.to_numpy()] = found.weight.to_numpy()
    for a, b in zip(OFFSETS, (*OFFSETS[1:], WIDTH), strict=True):      # rates among n-grams of one length
        part = table[:, a:b]
        part += SMOOTHING * (1 + part.sum(axis=1, keepdims=True)) / (b - a)
        part /= part.sum(axis=1, keepdims=True)
    weights = np.zeros((WIDTH + 1, code.shape[1]), dtype=np.float32)
    for bit in range(code.shape[1]):
        up, down = code[:, bit] > 0, code[:, bit] < 0
        if up.any() and down.any():
            weights[:-1, bit] = np.log(table[up].mean(axis=0)) - np.log(table[down].mean(axis=0))
    return Model(languages, code, weights)


# --- on Spark ----------------------------------------------------------------

def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row, from its whole text only.

    A text that is null or has no letter is ``und`` with score 0. With one
    learned language every other text is of that language; with none all are
    ``und``. Rows that repeat get the same answer; a null doc_id is not held out.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)     # a fixed number of weights per bit

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for f in batches:
            rows = [m.predict(t) for t in f["__text"]]
            yield pd.DataFrame({"__at": f["__at"], "lang_pred": [r[0] for r in rows],
                                "score": [r[1] for r in rows], "ambiguous": [r[2] for r in rows]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    at = F.to_json(F.struct("doc_id", is_held_out().alias("held_out")))
    out = docs.select(at.alias("__at"), F.coalesce("text", F.lit("")).alias("__text")).mapInPandas(
        run, "`__at` string, lang_pred string, score double, ambiguous boolean")
    back = F.from_json("__at", f"doc_id {kind}, held_out boolean").alias("at")
    return out.select(back, "lang_pred", "score", "ambiguous").select("at.*", "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose text has a letter, as they came: others have no language.

    Neither the language told nor its ambiguity drops a row, and where no
    language could be learned a lettered text stays although it is ``und``.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType(docs.schema.fields)
    at = docs.columns.index("text")

    @tidy
    def run(batches):
        import pyarrow as pa
        m = shared.value
        for b in batches:
            texts = [t.as_py() for t in b.column(at)]
            keep = [(m.predict(t)[0] != "und") if m.languages else bool(t) and bool((letters(t) != 32).any()) for t in texts]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
