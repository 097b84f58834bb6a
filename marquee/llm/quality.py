"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata, scored in linear time.

Inputs are the lower-cased words of the whole text, hashed to ``2**bits`` slots (length-normalised), statistics of
its structure and extent (repetition, word and line lengths, shares of upper case, digits, punctuation and line ends), and the one metadata
field that may enter a score: the number of characters that the document's record states. The score is
sigmoid(w0 + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)), the sum-of-squares form of all pairwise
interactions, so a document costs time in proportion to its distinct words.

Fitting uses labelled ids outside the held-out fold (crc32 of the id's text, modulo 5, is 0), at most ``sample`` of them (in
the order of a hash of the id): the documented bound. Of an id with several rows the text with the least hash stands for all, so
that repeated rows neither outgrow the bound nor push out other ids. Their sparse features are computed by Spark and fitted by seeded
AdaGrad on the driver. Scoring covers every row and all of its text in Arrow batches; the model (a few hundred KB) is broadcast.

Edge cases: null and empty texts have a score like any other; repeated or conflicting labels of one id count by their mean (at
least 0.5 is good), null ones not at all; without usable labels every score is 0.5; an empty table gives an empty table; extra
columns stay as they are, those named like a result are replaced. Labels, language, source and id never enter a score.
A stated number of characters that is null, negative or absent as a column counts as the text's own. Ties: a score equal to the
threshold is accepted. Very long texts are scored whole, 64 documents at a time, in memory of some hundred bytes a distinct word.
"""
from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE, BITS, FACTORS, EPOCHS, STEPS, BATCH, RATE, DECAY, SEED = 4000, 14, 6, 6, 300, 64, 0.08, 1e-5, 20
FOLDS, THRESHOLD = 5, 0.3
_UPPER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_PUNCT = bytes(c for c in range(33, 127) if not chr(c).isalnum())
N_STATS = 13  # the last one is metadata


def structure(text: str, words: list[str], counts: Counter) -> list[float]:
    """Statistics of a whole text, all defined for the empty one."""
    raw = text.encode("utf-8", "replace")
    n, nw, size = max(1, len(raw)), max(1, len(words)), len(raw)
    lines = raw.count(b"\n") + 1
    top = counts.most_common(1)[0][1] if counts else 0
    punct = size - len(raw.translate(None, _PUNCT))
    return [math.log1p(size), math.log1p(len(words)), math.log1p(lines), len(counts) / nw, top / nw, size / nw / 10,
            (size - len(raw.translate(None, _UPPER))) / n, (size - len(raw.translate(None, _DIGIT))) / n, punct / n,
            punct / nw, lines / nw, sum(c > 1 for c in counts.values()) / max(1, len(counts))]


def features(text: str | None, bits: int, slots: dict[str, int], stated: float | None = None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(slot, value) of the distinct words, and the statistics; stated: characters by the document's record."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    if len(slots) > 300_000:
        slots.clear()
    mask, at = (1 << bits) - 1, []
    for w in counts:
        s = slots.get(w)
        if s is None:
            s = zlib.crc32(w.lower().encode("utf-8", "replace")) & mask
            if len(w) <= 64:
                slots[w] = s
        at.append(s)
    value = np.log1p(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
    return np.array(at, dtype=np.int64), value / (math.sqrt(float(value @ value)) or 1.0), [
        *structure(text, words, counts), math.log1p(len(text) if stated is None else stated)]


@dataclass
class Model:
    bits: int
    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scaled(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -4, 4) / 4

    def raw(self, at: np.ndarray, value: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score before the sigmoid, factor sums) of rows whose entries lie one after another; every row has entries."""
        starts = np.concatenate(([0], ends[:-1]))
        vx = self.v[at] * value[:, None]
        sums = np.add.reduceat(vx, starts)
        linear = np.add.reduceat(self.w[at] * value, starts)
        squares = np.add.reduceat((vx * vx).sum(axis=1), starts)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, texts: list, slots: dict[str, int], stated: list | None = None) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        rows = [features(t, self.bits, slots, m) for t, m in zip(texts, stated or [None] * len(texts))]
        at, value, ends = stack(rows, self)
        return 1 / (1 + np.exp(-np.clip(self.raw(at, value, ends)[0], -30, 30)))


def stack(rows: list, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    stats = model.scaled(np.array([r[2] for r in rows]))
    stat_at = (1 << model.bits) + np.arange(N_STATS)
    at = np.concatenate([x for r in rows for x in (r[0], stat_at)])
    value = np.concatenate([x for r, s in zip(rows, stats) for x in (r[1], s)])
    return at, value, np.cumsum([len(r[0]) + N_STATS for r in rows])


def fit_rows(rows: list, labels: np.ndarray, bits: int = BITS) -> Model:
    """Seeded AdaGrad on logistic loss; rows as features() gives them."""
    size, rng = (1 << bits) + N_STATS, np.random.default_rng(SEED)
    if not len(rows):
        return Model(bits, 0.0, np.zeros(size), np.zeros((size, FACTORS)), np.zeros(N_STATS), np.ones(N_STATS))
    stats = np.array([r[2] for r in rows])
    share = min(0.99, max(0.01, float(labels.mean())))
    m = Model(bits, math.log(share / (1 - share)), np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)), stats.mean(axis=0),
              np.maximum(stats.std(axis=0), 1e-6))
    gw, gv, gb = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3), 1e-3
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(rows)))):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            pick = order[i:i + BATCH]
            at, value, ends = stack([rows[j] for j in pick], m)
            raw, sums = m.raw(at, value, ends)
            err = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[pick]
            row = np.repeat(np.arange(len(pick)), np.diff(ends, prepend=0))
            g = (err[row] * value)[:, None]
            gvec = g * (sums[row] - m.v[at] * value[:, None])
            used, slot = np.unique(at, return_inverse=True)
            dw = np.bincount(slot, g[:, 0]) / len(pick) + DECAY * m.w[used]
            dv = np.stack([np.bincount(slot, gvec[:, f]) for f in range(FACTORS)], axis=1) / len(pick) + DECAY * m.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            m.w[used] -= RATE * dw / np.sqrt(gw[used])
            m.v[used] -= RATE * dv / np.sqrt(gv[used])
            db = float(err.mean())
            gb += db * db
            m.bias -= RATE * db / math.sqrt(gb)
    return m


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from; a null id counts as the text of no characters."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def stated_chars(docs: DataFrame, text_col: str, meta_col: str) -> Column:
    """The metadata field as a double without nulls."""
    own = F.coalesce(F.length(text_col), F.lit(0)).cast("double")
    if meta_col not in docs.columns:
        return own
    meta = F.col(meta_col).try_cast("double")
    return F.when(meta >= 0, meta).otherwise(own)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality", meta_col: str = "n_chars") -> Model:
    """Fit on at most ``sample`` labelled ids of docs outside the held-out fold, one row of each."""
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    usable = usable.groupBy(F.col(id_col).alias("l_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    chosen = usable.orderBy(F.xxhash64("l_id"), "l_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), stated_chars(docs, text_col, meta_col).alias("meta"))
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    first = texts.join(F.broadcast(chosen), F.col("id") == F.col("l_id")).select("id", "y", F.struct(digest.alias("d"), "meta").alias("least"))
    first = first.groupBy(F.col("id").alias("l_id")).agg(F.min("y").alias("y"), F.min("least").alias("least"))  # at most ``sample`` rows
    own = (F.col("id") == F.col("l_id")) & (digest == F.col("least.d")) & (F.col("meta") == F.col("least.meta"))
    joined = texts.join(F.broadcast(first), own).select("id", "y", "text", "meta")

    def run(batches):
        slots: dict[str, int] = {}
        seen: set = set()
        for b in batches:
            b = b[~b["id"].duplicated() & ~b["id"].isin(seen)]  # what is left of an id are copies of one text
            seen.update(b["id"])
            rows = [features(t, bits, slots, m) for t, m in zip(b["text"], b["meta"])]
            yield pd.DataFrame({"id": b["id"].to_numpy(), "y": b["y"].to_numpy(), "at": [r[0] for r in rows],
                                "value": [r[1] for r in rows], "stats": [r[2] for r in rows]})

    made = joined.mapInPandas(run, "id long, y int, at array<int>, value array<double>, stats array<double>")
    made = made.dropDuplicates(["id"]).toPandas().sort_values("id")  # in a fixed order, so that reruns fit the same model
    rows = [(np.asarray(a, dtype=np.int64), np.asarray(v), list(s)) for a, v, s in zip(made["at"], made["value"], made["stats"])]
    return fit_rows(rows, made["y"].to_numpy(dtype=float), bits)


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score", meta_col: str = "n_chars") -> DataFrame:
    """docs plus the score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        slots: dict[str, int] = {}
        for texts, stated in batches:
            found = [shared.value.score(list(texts.iloc[i:i + 64]), slots, stated.iloc[i:i + 64].tolist()) for i in range(0, len(texts), 64)]
            yield pd.Series(np.concatenate(found) if found else [], dtype=float)

    return docs.withColumn(out, run(F.col(text_col), stated_chars(docs, text_col, meta_col)))


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs plus held_out, score and predicted."""
    model = fit(docs, labels, sample, id_col=id_col, text_col=text_col)
    return (with_scores(docs, model, text_col).withColumn("held_out", held_out(id_col))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
