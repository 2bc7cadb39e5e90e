"""Leakage-safe splits: all segments of a run share a split."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.names import SPLITS
from tessera.operators.ranges import maybe_broadcast, numbered, numbered_within, written


def stratified_runs(runs: DataFrame, strata: list[str], run: str, seed: str | None = "42", counts: tuple[int, int, int] = (4, 1, 1)) -> DataFrame:
    """runs with split: of each stratum the first runs by counts, more go to train. Order by md5(seed, run), or by run without a seed.

    A stratum of fewer runs than the counts add up to has error set.
    """
    order = [F.md5(F.concat(F.lit(seed), F.col(run).cast("string"))), F.col(run)] if seed is not None else [F.col(run)]
    w = Window.partitionBy(*strata)
    a, b, c = counts
    rows = runs.withColumns({"__n": F.row_number().over(w.orderBy(*order)), "__all": F.count("*").over(w)})
    n = F.col("__n")
    split = F.when(n <= a, "train").when(n <= a + b, "val").when(n <= a + b + c, "test").otherwise("train")
    return rows.withColumns({"split": split, "error": F.when(F.col("__all") < sum(counts), F.lit("too few runs"))}).drop("__n", "__all")


def apply_runs(segments: DataFrame, runs: DataFrame, keys: list[str]) -> DataFrame:
    return segments.join(runs.select(*keys, "split"), keys)


def score(assigned: DataFrame, tier1: str, tier2: str, tier3: str, targets: dict[str, float]) -> DataFrame:
    """One row: missing tier-1 labels, tier-2 and tier-3 coverage summed over splits, deviation from the targets, score. One row always, also for no segments."""
    cover = assigned.groupBy("split").agg(F.countDistinct(tier1).alias("t1"), F.countDistinct(tier2).alias("t2"), F.countDistinct(tier3).alias("t3"), F.count("*").alias("n"))
    all_t1 = assigned.agg(F.countDistinct(tier1).alias("all_t1"))
    want = F.coalesce(*[F.when(F.col("split") == s, F.lit(float(v))) for s, v in targets.items()])
    total = float(sum(targets.values()))
    got = cover.agg(
        F.coalesce(F.sum("t1"), F.lit(0)).alias("t1"), F.coalesce(F.sum("t2"), F.lit(0)).alias("t2"), F.coalesce(F.sum("t3"), F.lit(0)).alias("t3"),
        (F.coalesce(F.sum(F.abs(F.col("n") - want)), F.lit(0.0)) + F.lit(total) - F.coalesce(F.sum(want), F.lit(0.0))).alias("deviation"),
    )
    both = got.join(F.broadcast(all_t1))  # two aggregates of one row each
    missing = F.col("all_t1") * len(targets) - F.col("t1")
    value = F.when(missing > 0, F.lit(-1e12) - F.lit(1e9) * missing).otherwise(1000.0 * F.col("t2") + 100.0 * F.col("t3") - F.col("deviation"))
    return both.select(missing.alias("missing_t1"), F.col("t2").alias("t2_cover"), F.col("t3").alias("t3_cover"), "deviation", value.alias("score"))


def _coded(groups: DataFrame, gid: str, size: str, labels: tuple[str, str, str]) -> tuple[DataFrame, DataFrame]:
    """(groups with __pos by gid, __size and the codes of their labels a tier; tier, n: how many labels each tier has)."""
    rows = numbered(groups.select(F.col(gid), F.coalesce(F.col(size).cast("double"), F.lit(0.0)).alias("__size"), *[F.col(c).alias(f"__l{k}") for k, c in enumerate(labels)]), gid)
    each = rows.select("__pos", F.explode(F.array(*[F.struct(F.lit(k).alias("tier"), F.col(f"__l{k}").cast("array<string>").alias("labels")) for k in range(3)])).alias("t"))
    each = each.select("__pos", "t.tier", F.explode("t.labels").alias("label")).where("label is not null").distinct()
    codes = numbered_within(each.select("tier", "label").distinct(), "tier", "label")
    mine = each.join(maybe_broadcast(codes.select("tier", "label", F.col("__pos").alias("code"))), ["tier", "label"])
    lists = mine.groupBy("__pos").agg(*[F.array_sort(F.collect_list(F.when(F.col("tier") == k, F.col("code")))).alias(f"__c{k}") for k in range(3)])
    return rows.select(gid, "__size", "__pos").join(lists, "__pos", "left"), codes.groupBy("tier").agg(F.max("__n").alias("n"))


class _Block:
    """Some groups in order, as arrays: sizes, and of each tier the labels that the groups have."""

    def __init__(self, pdf: pd.DataFrame, n_labels: list[int], ratios: tuple[float, float, float]):
        self.pdf = pdf.sort_values("__pos")
        self.sizes = self.pdf["__size"].to_numpy(float)
        self.target = self.sizes.sum() * np.array(ratios)
        self.tiers = []
        for k, n in enumerate(n_labels):
            lists = [np.asarray(x if x is not None else (), np.int64) for x in self.pdf[f"__c{k}"]]
            self.tiers.append((np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate([*lists, np.zeros(0, np.int64)]), n))

    def packed(self, number: int, seed: int, trials: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(split of each group, what is left of each split's target) of some trials, that all take their next group at once."""
        n = len(self.sizes)
        rngs = [np.random.default_rng([seed, t, number] if number else [seed, t]) for t in trials]
        order = np.stack([r.permutation(n) for r in rngs])
        noise = np.stack([r.random((n, 3)) for r in rngs]) * 0.01
        left, at, rows = np.tile(self.target, (len(trials), 1)), np.zeros((len(trials), n), np.int8), np.arange(len(trials))
        for k in range(n):
            g = order[:, k]
            s = np.argmax(left + noise[:, k], axis=1)
            at[rows, g] = s
            left[rows, s] -= self.sizes[g]
        return at, left

    def covered(self, at: np.ndarray) -> list[bytes]:
        """Of each tier the bits (split by split) of the labels that the splits have."""
        out = []
        for owner, code, n in self.tiers:
            hit = np.zeros(3 * n, bool)
            hit[at[owner].astype(np.int64) * n + code] = True
            out.append(np.packbits(hit).tobytes())
        return out


def search(groups: DataFrame, gid: str, size: str, labels: tuple[str, str, str], ratios: tuple[float, float, float] = (0.7, 0.15, 0.15), trials: int = 20_000, seed: int = 100, block: int = 100_000, chunks: int | None = None) -> DataFrame:
    """split of each group, score, trial: the best of `trials` random greedy packings, by score, then the lowest trial.

    groups: gid, size and one array of labels a tier (one row a recording run). They stay in the cluster: `block` of them, in order of
    gid, are a block, which takes its share of every split's target, so blocks are packed side by side; each is sent to `chunks` tasks
    (as many as cores, unless told), which share the trials. A trial's score is of all blocks together: the labels that its splits cover
    are bits that are or-ed, what is left of the targets is added. The groups of the best trial are then packed once more. Up to
    `block` groups that is one greedy pass over all. Null sizes count 0, null labels are none; no groups give no rows.
    """
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("ratios must add up to 1")
    chunks = max(1, min(trials, chunks or groups.sparkSession.sparkContext.defaultParallelism))
    coded, counts = _coded(groups, gid, size, labels)
    found = {r["tier"]: r["n"] for r in counts.collect()}  # three numbers
    n_labels = [found.get(k, 0) for k in range(3)]
    coded = written(coded.withColumn("__block", F.floor(F.col("__pos") / block)), "split-groups")

    def tried(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        number, chunk = int(key[0]), int(key[1])
        b = _Block(pdf, n_labels, ratios)
        mine = list(range(chunk, trials, chunks))
        step = max(1, 500_000 // max(1, len(pdf)))
        out = []
        for k in range(0, len(mine), step):
            at, left = b.packed(number, seed, mine[k : k + step])
            out += [(t, left[r].tolist(), b.covered(at[r])) for r, t in enumerate(mine[k : k + step])]
        return pd.DataFrame(out, columns=["trial", "left", "cover"])

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        left = np.abs(np.sum(np.stack(pdf["left"].to_list()), axis=0)).sum()
        bits = [np.unpackbits(np.bitwise_or.reduce([np.frombuffer(c[k], np.uint8) for c in pdf["cover"]]), count=3 * n) for k, n in enumerate(n_labels)]
        n1, n2, n3 = (int(b.sum()) for b in bits)
        missing = 3 * n_labels[0] - n1
        return pd.DataFrame({"trial": [int(pdf["trial"].iloc[0])], "score": [float(-1e12 - 1e9 * missing if missing else 1000.0 * n2 + 100.0 * n3 - left)]})

    dealt = coded.drop(gid).withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    pieces = dealt.groupBy("__block", "__chunk").applyInPandas(tried, "trial long, left array<double>, cover array<binary>")
    top = pieces.groupBy("trial").applyInPandas(together, "trial long, score double").orderBy(F.desc("score"), "trial").first()
    trial, score = (top["trial"], top["score"]) if top else (0, 0.0)

    def chosen(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        b = _Block(pdf, n_labels, ratios)
        at = b.packed(int(key[0]), seed, [trial])[0][0]
        return pd.DataFrame({"__pos": b.pdf["__pos"].to_numpy(), "split": np.array(SPLITS, object)[at], "score": score, "trial": trial})

    splits = coded.drop(gid).groupBy("__block").applyInPandas(chosen, "__pos long, split string, score double, trial long")
    return coded.select(gid, "__pos").join(splits, "__pos").drop("__pos")
