"""K nearest neighbours with a saved form.

The training rows are a bounded sample of the labelled rows (``max_rows``, a
parameter), so they can be broadcast and the work is in proportion to the rows
scored. Within that sample the neighbours are exact.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .evaluation import bounded_sample

NEIGHBOURS = 15
#: Labelled rows kept as the model by default; 20 numbers each.
MAX_TRAIN_ROWS = 100_000
CHUNK = 512


@dataclass
class KnnModel:
    """Standardised training rows in order of their hash, with the numbers that standardise others."""
    names: list[str]
    mean: np.ndarray
    scale: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    k: int = NEIGHBOURS

    @classmethod
    def fit(cls, train: DataFrame, names: list[str], k: int = NEIGHBOURS, max_rows: int = MAX_TRAIN_ROWS) -> KnnModel:
        """``train`` has the named columns, label, merchant_id and week_start_date."""
        kept = bounded_sample(train, max_rows)
        stats = kept.agg(*[F.avg(c).alias(f"m_{c}") for c in names], *[F.stddev_pop(c).alias(f"s_{c}") for c in names]).first()
        mean = np.array([stats[f"m_{c}"] or 0.0 for c in names])
        spread = np.array([stats[f"s_{c}"] or 0.0 for c in names])
        place = F.xxhash64("merchant_id", "week_start_date").alias("_place")
        columns = [F.coalesce(F.col(c).cast("double"), F.lit(float(m))).alias(c) for c, m in zip(names, mean, strict=True)]
        table = kept.select(place, F.col("label").cast("double").alias("label"), *columns).toPandas().sort_values("_place", kind="stable")
        scale = np.where(spread > 0, spread, 1.0)
        return cls(names, mean, scale, (table[names].to_numpy(float) - mean) / scale, table["label"].to_numpy(float), k)

    def vote(self, x: np.ndarray) -> np.ndarray:
        """Inverse-distance vote of the k nearest rows; rows at distance 0 alone decide. Ties go to the earlier row."""
        out = np.zeros(len(x))
        if not len(self.rows):
            return out
        k = min(self.k, len(self.rows))
        norms = (self.rows * self.rows).sum(axis=1)
        for a in range(0, len(x), CHUNK):
            q = x[a:a + CHUNK]
            near = np.maximum((q * q).sum(axis=1)[:, None] + norms[None, :] - 2.0 * q @ self.rows.T, 0.0)
            limit = np.partition(near, k - 1, axis=1)[:, k - 1] * (1 + 1e-9) + 1e-9
            for i in range(len(q)):
                own = np.flatnonzero(near[i] <= limit[i])
                dist = np.sqrt(((q[i] - self.rows[own]) ** 2).sum(axis=1))
                best = np.lexsort((own, dist))[:k]
                own, dist = own[best], dist[best]
                weight = (dist == 0).astype(float) if (dist == 0).any() else 1 / dist
                out[a + i] = (weight * self.labels[own]).sum() / weight.sum()
        return out

    def score(self, df: DataFrame, keep: list) -> DataFrame:
        """``keep`` columns and score of every row."""
        model = df.sparkSession.sparkContext.broadcast(self)
        vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in zip(self.names, self.mean, strict=True)])
        rows = df.select(*keep, vector.alias("_vector"))
        kept = [f for f in rows.schema.fields if f.name != "_vector"]
        columns = [f.name for f in kept]

        def run(frames):
            own = model.value
            for frame in frames:
                x = np.stack(frame["_vector"].to_numpy()) if len(frame) else np.zeros((0, len(own.names)))
                yield pd.concat([frame[columns].reset_index(drop=True), pd.DataFrame({"score": own.vote((x - own.mean) / own.scale)})], axis=1)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", score double"
        return rows.mapInPandas(run, schema)

    def save(self, spark: SparkSession, path: str) -> None:
        numbers = [(n, float(m), float(s), self.k, i) for i, (n, m, s) in enumerate(zip(self.names, self.mean, self.scale, strict=True))]
        spark.createDataFrame(numbers, "name string, mean double, scale double, k int, place int").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/scale")
        rows = [(i, float(y), x.tolist()) for i, (x, y) in enumerate(zip(self.rows, self.labels, strict=True))]
        spark.createDataFrame(rows, "place bigint, label double, vector array<double>").write.mode("overwrite").parquet(f"{path}/rows")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KnnModel:
        numbers = spark.read.parquet(f"{path}/scale").orderBy("place").collect()
        rows = spark.read.parquet(f"{path}/rows").toPandas().sort_values("place")
        return cls([r.name for r in numbers], np.array([r["mean"] for r in numbers]), np.array([r.scale for r in numbers]),
                   np.stack(rows["vector"].to_numpy()) if len(rows) else np.zeros((0, len(numbers))), rows["label"].to_numpy(float), numbers[0].k)
