"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector over hashed character n-grams (lengths 1 to 3 of
its letters, lower-cased; everything else is one blank).  Each language has several
centroids from spherical k-means over a bounded sample of labelled texts.  A text gets
the language of its most similar centroid by cosine.  Short texts are naturally further
from every centroid, so the rejection distance depends on length: it is calibrated on
parts of the sample's texts cut to many lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, map_batches, pack_scratch, text_pieces

#: Vector size; labelled texts a language is learned from at most; centroids of a language.
BINS, PER_LANGUAGE, CENTROIDS = 1 << 13, 600, 5
#: A text is rejected under this part of the smallest usual cosine (quantile) for its length; lengths with
#: fewer examples take the next shorter length's.
REJECT_PART, REJECT_QUANTILE, REJECT_FROM = 0.4, 0.005, 200
UNKNOWN = "und"

_MUL = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))
_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Code point -> itself for letters, a blank for everything else."""
    if not _LETTER:
        t = np.full(0x110000, 32, np.uint32)
        i = np.flatnonzero(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
        t[i] = i
        _LETTER.append(t)
    return _LETTER[0]


def grams(text: str, bins: int = BINS, step: int = 1 << 20) -> tuple[np.ndarray, int]:
    """Counts of the hashed n-grams of a text, and how many letters it has."""
    counts, letters = np.zeros(bins, np.int64), 0
    shift = np.uint32(32 - int(np.log2(bins)))
    low = text.lower()
    held = np.array([32], np.uint32)  # a text starts behind a blank; later the last two characters of the step before
    for i in range(0, len(low), step):
        c = letter_table()[np.frombuffer(low[i : i + step].encode("utf-32-le", "surrogatepass"), np.uint32)]
        letters += int((c != 32).sum())
        if i + step >= len(low):
            c = np.append(c, np.uint32(32))
        c = np.concatenate([held, c])
        keep = (c[1:] != 32) | (c[:-1] != 32)  # one blank for a run of blanks
        keep[: len(held) - 1] = True
        c = c[np.r_[True, keep]]
        new = len(held)
        h = c * _MUL[0]
        h2 = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _MUL[1] + h[1:]
        h3 = (h2[:-1] ^ (h2[:-1] >> np.uint32(13))) * _MUL[2] + c[2:] * _MUL[1]
        single = np.flatnonzero(c[new:] != 32) + new
        for hashes in (h[single], h2[new - 1 :] * _MUL[2], h3[max(0, new - 2) :] * _MUL[0]):
            counts += np.bincount(hashes >> shift, minlength=bins)
        held = c[-2:]
    return counts, letters


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised TF-IDF rows (zero rows for texts without letters) and letter counts."""
    x, n = np.zeros((len(texts), len(idf)), np.float32), np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        counts, n[i] = grams(t, len(idf))
        if n[i]:
            row = np.log1p(counts.astype(np.float32)) * idf
            x[i] = row / max(float(np.sqrt(row @ row)), 1e-12)
    return x, n


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most k unit centroids of unit rows; the start is spread out (farthest first)."""
    picked = [int(np.argmax(x @ x.sum(0)))]
    near = x @ x[picked[0]]
    while len(picked) < min(k, len(x)):
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[picked[-1]])
    c = x[picked].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            s = x[own == j].sum(0)
            if (norm := np.sqrt(s @ s)) > 0:
                c[j] = s / norm
    return c


@dataclass
class Model:
    languages: list[str]
    owner: np.ndarray  # language of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray  # by log2 of the letters: the cosine under which a text is rejected

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine to its nearest centroid (0 to 1), and whether the text is too far from all."""
        langs: list[str] = []
        scores: list[float] = []
        rejected: list[bool] = []
        texts = [t or "" for t in texts]
        for i, j in text_pieces(texts):
            x, n = vectors(texts[i:j], self.idf)
            sim = x @ self.centroids.T if len(self.centroids) else np.zeros((len(x), 0), np.float32)
            for row, letters in zip(sim, n.tolist()):
                if not letters or not len(row):
                    langs.append(UNKNOWN), scores.append(0.0), rejected.append(not letters)
                    continue
                best = int(np.argmax(row))
                score = float(min(1.0, max(0.0, row[best])))
                langs.append(self.languages[self.owner[best]])
                scores.append(score)
                rejected.append(bool(score < self.floor[min(len(self.floor) - 1, letters.bit_length())]))
        return langs, scores, rejected


def sample_labelled(df: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """At most ``most`` rows of each label (more only if ids repeat), the same rows at every run.

    Rows are picked by a hash of their id.  Only ids and labels are counted and ranked, in a sample
    thinned to a small multiple of ``most`` rows a label; the limits, one number for each label, then
    filter the table where it lies, so no text is shuffled."""
    h = F.pmod(F.xxhash64(F.lit(17), id_col), F.lit(1 << 30))
    narrow = df.select(F.col(label_col).alias("label"), h.alias("h"))
    counts = narrow.groupBy("label").count().collect()
    if not counts:
        return df.limit(0)

    def limit(values: dict):
        pairs = [F.lit(x) for kv in values.items() for x in kv]
        return F.element_at(F.create_map(*pairs), F.col(label_col))

    rate = {r["label"]: int(min(1.0, 3.0 * most / r["count"]) * (1 << 30)) for r in counts}
    nth = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    near = narrow.withColumn(label_col, F.col("label")).where(F.col("h") < limit(rate)).withColumn("nth", nth).where(F.col("nth") <= most)
    found = {r["label"]: r for r in near.groupBy("label").agg(F.max("h").alias("last"), F.count(F.lit(1)).alias("n")).collect()}
    # where few ids carry a label's rows, their hashes may miss the thinned sample: then all its rows are ranked
    last = {r["label"]: found[r["label"]]["last"] if r["label"] in found and found[r["label"]]["n"] >= min(most, r["count"]) else 1 << 30 for r in counts}
    # rows with equal ids (or none) have one hash: of those as many as fit stay, whichever rows they are
    order = Window.partitionBy(label_col).orderBy(h, F.xxhash64(*df.columns))
    return df.where(h <= limit(last)).withColumn("__nth", F.row_number().over(order)).where(F.col("__nth") <= most).drop("__nth")


def fit(train: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
        per_language: int = PER_LANGUAGE, k: int = CENTROIDS, bins: int = BINS) -> Model:
    """Learn from a bounded sample (``per_language`` texts of each label).  Null texts, null labels and
    texts without a letter are left out; without any labelled text every text is ``und``, and only those
    without a letter are rejected."""
    labelled = train.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"))
    sample = pack_scratch(sample_labelled(labelled, "id", "label", per_language).dropDuplicates(["text", "label"]), "language-sample")

    def frequencies(batch):
        seen, n = np.zeros(bins, np.int64), 0
        for t in batch.column(0).to_pylist():
            counts, letters = grams(t, bins)
            seen += counts > 0
            n += letters > 0
        yield {"n": [n], "df": [seen.tolist()]}

    df, n = np.zeros(bins, np.int64), 0
    for r in map_batches(sample.select("text"), frequencies, "n bigint, df array<bigint>").toLocalIterator():
        df, n = df + np.array(r["df"]), n + r["n"]
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def cluster(key, pdf):
        x, letters = vectors(pdf["text"].tolist(), idf)
        x = x[letters > 0]
        c = spherical_kmeans(x, k) if len(x) else np.zeros((0, bins), np.float32)
        return pd.DataFrame({"label": [key[0]] * len(c), "c": list(c)})

    rows = sample.groupBy("label").applyInPandas(cluster, "label string, c array<float>").collect()
    langs = sorted({r["label"] for r in rows})
    rows.sort(key=lambda r: (r["label"], r["c"]))
    model = Model(langs, np.array([langs.index(r["label"]) for r in rows], np.int64),
                  np.array([r["c"] for r in rows], np.float32).reshape(-1, bins), idf, np.zeros(32))
    model.floor = _floors(sample, model)
    return model


def _floors(sample: DataFrame, model: Model) -> np.ndarray:
    """Rejection cosines by log2 of the letters, from the sample's texts cut to many lengths."""

    def cosines(batch):
        for t in batch.column(0).to_pylist():
            cuts = [t] + [t[at : at + (4 << s)] for s in range(0, 12) for at in (0, len(t) // 2) if (4 << s) < len(t)]
            x, n = vectors(cuts, model.idf)
            top = (x @ model.centroids.T).max(axis=1)
            ok = n > 0
            yield {"bits": [int(v).bit_length() for v in n[ok]], "cos": top[ok].astype(float).tolist()}

    floor = np.zeros(32)
    if len(model.centroids):
        got = map_batches(sample.select("text"), cosines, "bits int, cos double").groupBy("bits").agg(
            F.percentile_approx("cos", REJECT_QUANTILE, 10000).alias("q"), F.count(F.lit(1)).alias("n"))
        for r in got.collect():
            floor[r["bits"]] = REJECT_PART * r["q"] * (r["n"] >= REJECT_FROM)
        for b in range(1, 32):
            floor[b] = floor[b] or floor[b - 1]
    return floor


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score, rejected`` for each row, from the whole text alone.

    A null text or one without a letter is ``und`` with score 0 and rejected.  Null ids
    and repeated rows pass through; further columns are not read; ties between centroids
    go to the language first in alphabetical order; an empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        lang, score, rejected = shared.value.predict(batch.column(1).to_pylist())
        yield {id_col: batch.column(0), "lang_pred": lang, "score": score, "rejected": rejected}

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(id_col, text_col), run, f"`{id_col}` {kind}, lang_pred string, score double, rejected boolean")


def keep_identified(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows (all columns) whose text the model does not reject.  Null texts and texts without a letter are rejected;
    ids are not looked at, repeated rows are judged alike, columns may have any names, and an empty table stays empty."""
    import pyarrow as pa

    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)
    bounded_batches(df.sparkSession)

    def run(batches):
        for b in batches:
            rejected = shared.value.predict(b.column(at).to_pylist())[2]
            yield b.filter(pa.array([not r for r in rejected]))

    return df.mapInArrow(run, df.schema)
