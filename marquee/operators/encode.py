"""Batch inference of the two towers as Spark jobs.

Id embeddings are a keyed table (id -> vector) joined on the id, so they scale with the catalogue;
the dense layers are small fixed-size weights shipped with the task closure; each piece of an Arrow batch is
one numpy forward pass inside mapInPandas.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.vocab import DEFAULT_YEAR

N_GENRES = 20
#: Rows of one forward pass: bounds the layers' matrices whatever the Arrow batch.
FORWARD_ROWS = 1024


def _pieces(batches):
    """The batches' rows in pieces of at most FORWARD_ROWS."""
    for b in batches:
        for s in range(0, len(b), FORWARD_ROWS):
            yield b.iloc[s:s + FORWARD_ROWS]


WEIGHTS_SCHEMA = "part string, layer int, row int, w array<double>, b double"


def save_weights(spark, weights: dict, path: str) -> None:
    """Write tower weights as a table: one row per output of a layer."""
    rows = []
    for part in ("user_mlp", "item_mlp", "history"):
        layers = [weights[part]] if part == "history" else weights[part]
        rows += [(part, n, r, [float(x) for x in layer["w"][r]], float(layer["b"][r])) for n, layer in enumerate(layers)
                 for r in range(len(layer["w"]))]
    spark.createDataFrame(rows, WEIGHTS_SCHEMA).write.mode("overwrite").parquet(path)


def load_weights(spark, path: str) -> dict:
    """Tower weights from a table written by a trainer (or save_weights). They are fixed-size model parameters."""
    parts: dict[str, dict[int, dict[int, tuple]]] = {}
    for r in spark.read.schema(WEIGHTS_SCHEMA).parquet(path).collect():
        parts.setdefault(r["part"], {}).setdefault(r["layer"], {})[r["row"]] = (r["w"], r["b"])
    missing = {"user_mlp", "item_mlp", "history"} - set(parts)
    if missing:
        raise ValueError(f"no weights for {sorted(missing)}")

    def layers(part: str) -> list[dict]:
        return [{"w": np.array([rows[i][0] for i in sorted(rows)]), "b": np.array([rows[i][1] for i in sorted(rows)])}
                for _, rows in sorted(parts[part].items())]

    user, item = layers("user_mlp"), layers("item_mlp")
    return {"user_mlp": user, "item_mlp": item, "history": layers("history")[0], "output_dim": len(item[-1]["b"]),
            "embed_dim": item[0]["w"].shape[1] - N_GENRES - 1}


def mlp_forward(x: np.ndarray, layers: list[dict], eps: float = 1e-5) -> np.ndarray:
    """(Linear -> LayerNorm -> ReLU) per hidden layer, then a final Linear."""
    for layer in layers[:-1]:
        x = x @ layer["w"].T + layer["b"]
        mu = x.mean(axis=1, keepdims=True)
        var = x.var(axis=1, keepdims=True)
        x = np.maximum((x - mu) / np.sqrt(var + eps), 0.0)
    last = layers[-1]
    return x @ last["w"].T + last["b"]


def _embeddings(series, width: int) -> np.ndarray:
    """Id embeddings as a matrix; an absent id has zeros, a vector of another length is an error."""
    out = np.zeros((len(series), width))
    for n, v in enumerate(series):
        if v is not None:
            if len(v) != width:
                raise ValueError(f"an id embedding has {len(v)} values, the weights expect {width}")
            out[n] = v
    return out


def _slots(series) -> np.ndarray:
    """Genre vectors padded or cut to the vocabulary's slots."""
    out = np.zeros((len(series), N_GENRES))
    for n, v in enumerate(series):
        if v is not None:
            a = np.asarray(v, dtype=np.float64)[:N_GENRES]
            out[n, :len(a)] = a
    return out


def encode_items(itf: DataFrame, id_emb: DataFrame, weights: dict) -> DataFrame:
    """(movie_id, vec): concat(id embedding, multi-hot[20], year) through the item MLP.

    itf: (movie_id, genre_multihot, release_year); id_emb: (movie_id, emb) — absent ids get zeros.
    """
    e = weights["embed_dim"]
    rows = itf.select("movie_id", "genre_multihot",
                      F.coalesce(F.nullif("release_year", F.lit(0)), F.lit(DEFAULT_YEAR)).cast("double").alias("year"))
    j = rows.join(id_emb.select("movie_id", "emb"), "movie_id", "left")

    def run(batches):
        for b in _pieces(batches):
            x = np.concatenate([_embeddings(b["emb"], e), _slots(b["genre_multihot"]),
                                b["year"].to_numpy(dtype=np.float64)[:, None]], axis=1)
            y = mlp_forward(x, weights["item_mlp"])
            yield pd.DataFrame({"movie_id": b["movie_id"], "vec": list(y)})

    return j.mapInPandas(run, "movie_id int, vec array<double>")


def encode_users(uf: DataFrame, id_emb: DataFrame, weights: dict) -> DataFrame:
    """(user_id, vec): concat(id embedding, affinity[20], relu(proj(affinity)), count, mean) through the user MLP.
    Affinity is padded or cut to 20 slots."""
    e = weights["embed_dim"]
    hist = weights["history"]
    j = uf.select("user_id", "genre_affinity", "rating_count", "avg_rating").join(
        id_emb.select("user_id", "emb"), "user_id", "left")

    def run(batches):
        for b in _pieces(batches):
            ga = _slots(b["genre_affinity"])
            h = np.maximum(ga @ hist["w"].T + hist["b"], 0.0)
            x = np.concatenate([_embeddings(b["emb"], e), ga, h,
                                b["rating_count"].to_numpy(dtype=np.float64)[:, None],
                                b["avg_rating"].to_numpy(dtype=np.float64)[:, None]], axis=1)
            y = mlp_forward(x, weights["user_mlp"])
            yield pd.DataFrame({"user_id": b["user_id"], "vec": list(y)})

    return j.mapInPandas(run, "user_id int, vec array<double>")
