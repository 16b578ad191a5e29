"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are the hashed 1- to 3-grams of lower-cased characters (what is neither
letter nor mark counts as a space), weighted 1 + log tf times idf, of unit length.  The
document frequencies come from all training documents.  The weights are fitted
on a sample bounded by ``max_train`` rows, dealt evenly over the languages, by
follow-the-regularised-leader with elastic-net penalties, which leaves most
weights at exactly 0.  A fifth of the sample is kept from the fit; on it a
temperature is found that calibrates the probabilities.

Training uses text and lang of training documents, prediction the text alone.
Nothing is shuffled but the document frequencies, summed by feature.  The model
(``languages * 2**bits`` weights) is broadcast: its size does not depend on the
corpus, but on the number of languages, of which more than ``max_labels`` are
refused with an error.

Defined cases: a missing text or one without a letter is ``und`` with score 0;
without training documents that have a language every text is; a missing doc_id
counts as the empty string for the split; ties go to the first language by
name; repeated rows count each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"
SAMPLE = "lang string, place long, ids binary, counts binary"


def held_out(divisor: int = 4, remainder: int = 2) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor == remainder


def letters() -> bytes:
    """A bit for each code point: whether it is a letter or a mark."""
    return np.packbits([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)]).tobytes()


def spaced(bits: bytes) -> np.ndarray:
    """For each code point: itself if letter or mark, else a space."""
    return np.where(np.unpackbits(np.frombuffer(bits, np.uint8)), np.arange(0x110000, dtype=np.uint32), np.uint32(32))


def counts(text: str, bits: int, own: np.ndarray) -> np.ndarray:
    """How often each hashed 1-, 2- and 3-gram occurs. own: what each code point counts as."""
    out = np.zeros(1 << bits, np.int64)
    shift = np.uint32(32 - bits)
    text = f" {text.lower()} "
    for a in range(0, len(text), 1 << 20):
        x = np.frombuffer(text[max(0, a - 2) : a + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)
        x = own[x]
        h = x * np.uint32(0x9E3779B1)
        done = 2 if a else 0  # what the piece before has counted
        for n in range(1, 4):
            if n > 1:
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + x[n - 1 :] * np.uint32(0xC2B2AE3D)
            mixed = (h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F)
            out += np.bincount(mixed[max(0, done - n + 1) :] >> shift, minlength=1 << bits)
    return out


def _frequencies(bits: int, known: bytes):
    def job(batches):
        own, out, rows = spaced(known), np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    out += counts(text.as_py(), bits, own) > 0
                    rows += 1
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], at)), pa.int32()), pa.array(np.concatenate(([rows], out[at])), pa.int64())], ["feature", "docs"])

    return job


def _sampled(bits: int, known: bytes):
    def job(batches):
        own = spaced(known)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for lang, place, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                c = counts(text, bits, own)
                at = np.flatnonzero(c)
                for o, v in zip(out, (lang, place, at.astype(np.uint32).tobytes(), c[at].tobytes()), strict=True):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, (pa.string(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["lang", "place", "ids", "counts"])

    return job


def weighted(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(c)) * idf
    return x / max(1e-12, float(np.sqrt(x @ x)))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=0))
    return e / e.sum(axis=0)


def follow_leader(rows: list[tuple[int, np.ndarray, np.ndarray]], n_labels: int, n_features: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01) -> np.ndarray:
    """Weights (labels, features + 1; the last is the bias) for rows (label, features, values), by FTRL-proximal."""
    z, n = (np.zeros((n_labels, n_features + 1)) for _ in range(2))

    def weights(zs, ns):
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for label, at, x in rows:
            at, x = np.append(at, n_features), np.append(x, 1.0)
            zs, ns = z[:, at], n[:, at]
            w = weights(zs, ns)
            p = softmax(w @ x)
            p[label] -= 1
            g = p[:, None] * x
            z[:, at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[:, at] = ns + g * g
    return weights(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The t that makes softmax(logits / t) most likely (golden-section search)."""

    def loss(s: float) -> float:
        return -float(np.log(np.maximum(softmax(logits / np.exp(s))[labels, np.arange(len(labels))], 1e-12)).sum())

    a, b, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(docs: DataFrame, bits: int = 14, max_train: int = 4000, max_labels: int = 512, known: bytes = b"") -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """(languages, idf, weights, temperature) from docs (doc_id, text, lang); rows without text or lang don't count."""
    docs = docs.filter("text IS NOT NULL AND lang IS NOT NULL")
    found = dict(docs.groupBy("lang").count().limit(max_labels + 1).collect())
    if len(found) > max_labels:
        raise ValueError(f"lang has more than {max_labels} values; max_labels allows more, at 2**{bits} weights each")
    known = known or letters()
    if not found:
        return [], np.zeros(1 << bits), np.zeros((0, (1 << bits) + 1), np.float32), 1.0
    rows = docs.select("text").mapInArrow(_frequencies(bits, known), "feature int, docs long").groupBy("feature").agg(F.sum("docs").alias("docs")).collect()
    df = np.zeros(1 << bits)
    for r in rows:
        if r["feature"] >= 0:
            df[r["feature"]] = r["docs"]
    total = next(r["docs"] for r in rows if r["feature"] < 0)
    idf = np.log((1 + total) / (1 + df)) + 1e-3
    # by a hash of id and length, the same share of a language's rows everywhere
    place = F.xxhash64("doc_id", F.octet_length("text"), F.lit(7))
    share = F.create_map(*[F.lit(x) for lang, n in found.items() for x in (lang, min(1.0, max_train / len(found) / n))])
    sample = docs.withColumn("place", place).filter(F.pmod(F.col("place"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))
    picked = sorted(sample.select("lang", "place", "text").mapInArrow(_sampled(bits, known), SAMPLE).collect(), key=lambda r: (r["place"], r["lang"], r["ids"]))
    labels = sorted(found)
    prepared = []
    for r in picked:
        at = np.frombuffer(r["ids"], np.uint32)
        prepared.append((labels.index(r["lang"]), at, weighted(np.frombuffer(r["counts"], np.int64).astype(float), idf[at]).astype(np.float32)))
    del picked
    kept, fit = prepared[::5], [x for i, x in enumerate(prepared) if i % 5]
    weights = follow_leader(fit or prepared, len(labels), 1 << bits)
    logits = np.stack([weights[:, at] @ x + weights[:, -1] for _, at, x in kept or fit], axis=1) if prepared else np.zeros((len(labels), 0))
    t = temperature(logits, np.array([y for y, _, _ in kept or fit])) if prepared else 1.0
    return labels, idf, weights.astype(np.float32), t


def _predict(model, bits: int, known: bytes, with_row: bool):
    def job(batches):
        labels, idf, weights, t = model.value
        own, letter = spaced(known), regex.compile(r"\p{L}").search
        for batch in batches:
            found, score = [], []
            for value in batch.column(2):
                text = value.as_py()
                if not labels or not text or not letter(text):
                    found.append(UNKNOWN)
                    score.append(0.0)
                    continue
                c = counts(text, bits, own)
                at = np.flatnonzero(c)
                p = softmax((weights[:, at] @ weighted(c[at], idf[at]) + weights[:, -1]) / t)
                found.append(labels[int(p.argmax())])
                score.append(float(min(1.0, p.max())))
            more = batch.schema.names[2:] if with_row else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(score, pa.float64()), *[batch.column(c) for c in more]], ["doc_id", "held_out", "lang_pred", "score", *more])

    return job


def language_id(docs: DataFrame, bits: int = 14, max_train: int = 4000, max_labels: int = 512, with_row: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of docs (doc_id, text, lang); with_row adds text and rest, a struct of the other columns."""
    known = letters()
    more = ["text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]).alias("rest")] if with_row else []
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(train(own.filter(~held_out()), bits, max_train, max_labels, known))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"), *more[1:])
    schema = RESULT + (f", text string, rest {out.schema['rest'].dataType.simpleString()}" if with_row else "")
    return out.mapInArrow(_predict(model, bits, known, with_row), schema)
