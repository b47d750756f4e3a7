"""Toxicity by compression distance: two zstandard dictionaries, and how much shorter windows get with one than with the other."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = re.compile(rb"[\x20\x09-\x0D]+")
SMALL = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
WINDOW_WORDS, WINDOW_BYTES = 8, 512
LEVEL = 3
#: Three-word hashes by which near copies among the labelled texts are told.
MARKS = 32
#: A class with fewer different texts than this is learnt from all its texts.
FEWEST = 300


@dataclass(frozen=True)
class ToxicityModel:
    """What scoring needs: both dictionaries (tens of kilobytes) and the calibrated weights."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]


def word_list(text: str) -> list[bytes]:
    return [w for w in BLANK.split(text.encode("utf-8", "replace").translate(SMALL)) if w]


def windows(words: list[bytes], size: int = WINDOW_WORDS) -> list[bytes]:
    """Runs of ``size`` words that cover the whole text; very long ones are cut by bytes."""
    found = []
    for i in range(0, len(words), size):
        run = b" " + b" ".join(words[i:i + size]) + b" "
        found.extend(run[j:j + WINDOW_BYTES] for j in range(0, len(run), WINDOW_BYTES))
    return found


def compressor(dictionary: bytes):
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False).compress


def features(text: str, plain, toxic) -> list[float]:
    """Of the bytes that each window is shorter with the toxic dictionary: largest, mean of the three
    largest, logarithms of how many windows stand out and of how many there are."""
    gains = sorted((len(plain(w)) - len(toxic(w)) for w in windows(word_list(text))), reverse=True)
    if not gains:
        return [0.0, 0.0, 0.0, 0.0]
    top = gains[:3]
    return [float(gains[0]), sum(top) / len(top), float(np.log1p(sum(g >= 4 for g in gains))), float(np.log1p(len(gains)))]


def _different(docs: list[list[bytes]]) -> list[list[bytes]]:
    """Without near copies, which would make chance words look like those of the class.

    A text's marks are its ``MARKS`` smallest three-word hashes. It is a near copy if three quarters of them, or of the
    other's if those are more, are marks of one text kept before. Where fewer than ``FEWEST`` texts
    would be left, all teach.
    """
    holders: dict[int, list[int]] = {}
    sizes: list[int] = []
    kept = []
    for words in docs:
        marks = sorted({zlib.crc32(b" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2))})[:MARKS]
        shared = Counter(k for m in marks for k in holders.get(m, ()))
        if any(4 * n >= 3 * max(len(marks), sizes[k]) for k, n in shared.items()):
            continue
        for m in marks:
            holders.setdefault(m, []).append(len(kept))
        sizes.append(len(marks))
        kept.append(words)
    return kept if len(kept) >= FEWEST else docs


def _dictionary(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """Trained content; where there is too little to train on, the samples themselves."""
    whole = b"".join(samples)
    if len(samples) >= 8 and len(whole) > 4 * size:
        try:
            return zstandard.train_dictionary(size, samples, k=k, d=d, level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            pass  # too uniform for the trainer
    return whole[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([penalty] * (len(w) - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(texts: list[str], labels: list[int], toxic_share: float,
          ordinary_bytes: int = 32768, toxic_bytes: int = 2048) -> ToxicityModel | None:
    """Dictionaries from two thirds of the sample, thresholds and weights from the last third.

    Toxic texts are mostly ordinary words, so the toxic dictionary is the ordinary one followed by
    what is trained on the words that toxic documents hold far more often; a window then differs
    only where it has such content. None if a class is missing.
    """
    known: dict[bytes, bytes] = {}  # a word is held once, not once per occurrence
    docs = [[known.setdefault(w, w) for w in word_list(t)] for t in texts]
    by_class = {c: _different([d for d, y in zip(docs, labels, strict=True) if y == c]) for c in (0, 1)}
    if min(map(len, by_class.values())) < 3:
        return None
    fit = {c: d[:len(d) * 2 // 3] for c, d in by_class.items()}
    held = {c: d[len(d) * 2 // 3:] for c, d in by_class.items()}
    counts = {c: Counter(w for d in ds for w in set(d)) for c, ds in fit.items()}
    ratio = len(fit[1]) / len(fit[0])
    least = min(8, 2 + len(fit[1]) // 50)

    def own(word: bytes, n: int) -> bool:
        expected = counts[0][word] * ratio
        return n >= least and n - expected >= 3 * (n + expected + 1) ** 0.5 and n >= 8 * (expected + 0.25)

    special = {w for w, n in counts[1].items() if own(w, n)}
    toxic_samples = [b" " + b" ".join(w for w in d if w in special) + b" " for d in fit[1]]
    toxic_samples = [s for s in toxic_samples if len(s) > 8]
    plain_samples = [w for d in fit[0] for w in windows(d, 32)]
    ordinary = _dictionary(plain_samples, ordinary_bytes, 64, 8)
    toxic = ordinary + _dictionary(toxic_samples, toxic_bytes, 16, 6)
    plain_c, toxic_c = compressor(ordinary), compressor(toxic)
    x = np.array([features(b" ".join(d).decode("utf-8", "replace"), plain_c, toxic_c) for c in (0, 1) for d in held[c]])
    y = np.array([float(c) for c in (0, 1) for _ in held[c]])
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    w = _logistic((x - centre) / scale, y)
    share = min(max(toxic_share, 1e-4), 1 - 1e-4)  # the sample is taken by class, the intercept goes back to all rows
    w[-1] += np.log(share / (1 - share)) - np.log(len(held[1]) / len(held[0]))
    return ToxicityModel(ordinary, toxic, tuple(w), tuple(centre), tuple(scale))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = 3000, sample_chars: int = 20_000,
                 id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel | None:
    """Fit on at most ``sample_docs`` labelled texts of each class, of at most ``sample_chars`` characters each.

    These two bounds are all that comes to the driver; the texts are those of the smallest hash of
    their id. Labels other than 0 and 1, and rows without text or id, teach nothing; repeated rows
    teach once. Other columns of either table play no part.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and id is not null").distinct()
    joined = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null").join(marked, "id")
    # shares too come from the given documents only: labels of other (held-out) ones teach nothing
    shares = {r["y"]: r["n"] for r in joined.select("id", "y").distinct().groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    rows = []
    for y in (0, 1):
        some = joined.where((F.col("y") == y) & (F.char_length("text") <= sample_chars)).withColumn("h", F.xxhash64(F.lit(5), "id"))
        # the hash up to which there are enough, first, so that no more texts than those are sent
        last = some.select("h").orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
        rows += some.where(F.col("h") <= F.lit(last)).select("h", "id", "y", "text").limit(sample_docs).collect() if last is not None else []
    rows.sort(key=lambda r: (r["h"], r["y"], r["text"]))
    return train([r["text"] for r in rows], [r["y"] for r in rows], shares.get(1, 0) / max(total, 1)) if rows else None


def toxicity_scores(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a probability that each whole text is toxic.

    NULL, empty and blank texts have no windows and get the model's score for that; equal texts get
    equal scores. Without a model (no labels of both classes) the score is 0. No shuffle.
    """
    if model is None:
        return docs.withColumn(score_col, F.lit(0.0))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        plain, toxic = compressor(model.ordinary), compressor(model.toxic)
        if not len(texts):
            return pd.Series([], dtype="float64")
        x = np.array([features(t or "", plain, toxic) for t in texts])
        w = np.array(model.weights)
        z = ((x - np.array(model.centre)) / np.array(model.scale)) @ w[:-1] + w[-1]
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.withColumn(score_col, score(F.col(text_col)))
