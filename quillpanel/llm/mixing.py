"""Problem 9: mixing sources to target weights.

Sizes are tokens of a public tokenizer. Each source's documents fall into hash blocks; a source's quota is a number
of whole passes over its blocks plus a last pass that stops inside one block, so shares are met to within one
document. The block quotas are divided among the output shards by a splitting tree: at each node the left half
draws its blocks from the node's by the multivariate hypergeometric distribution, so every shard's counts are
exact draws without replacement and all quotas are used up. Shards take disjoint runs of the permuted blocks, and
documents are shuffled within their shard.

What comes to the driver is one row for each source and the tree's counts (sources x shards), never documents.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillpanel.session import qcol, stored

TOKENIZER_FILE = "/opt/tokenizers/byte_bpe_50k.json"
MOST_BYTES = 100_000_000


def count_tokens(df: DataFrame, keep: list[str], text: str, tokenizer_file: str = TOKENIZER_FILE) -> DataFrame:
    """``keep`` columns and n_tokens. NULL and empty texts have 0 tokens; texts are counted whole.

    The tokenizer's file is read on the driver and sent to the workers, which need not have it: a vocabulary, a ValueError
    beyond ``MOST_BYTES``."""
    if os.path.getsize(tokenizer_file) > MOST_BYTES:
        raise ValueError(f"a tokenizer file of more than {MOST_BYTES} bytes")
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", n_tokens long"

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value)
        tokenizer.encode_special_tokens = True
        for batch in batches:
            texts = batch["__text"].fillna("").tolist()
            sizes: list[int] = []
            for at in range(0, len(texts), 256):
                sizes += [len(e) for e in tokenizer.encode_batch_fast(texts[at : at + 256], add_special_tokens=False)]
            out = batch[keep].copy()
            out["n_tokens"] = np.array(sizes, dtype=np.int64)
            yield out

    return df.select(*map(qcol, keep), qcol(text).alias("__text")).mapInPandas(work, schema)


@dataclass(frozen=True)
class SourcePlan:
    """What one source gives: whole passes over its blocks, then a last pass up to ``cut_at`` tokens of block
    position ``last_blocks - 1``. Block of position p in a pass: (multiplier * p + offset) mod blocks."""

    source: str
    share: float
    max_repeats: int
    total: int
    docs: int
    blocks: int
    quota: int
    passes: int
    rest: int
    multiplier: int
    offset: int


def _permutation(blocks: int, rng: np.random.Generator) -> tuple[int, int]:
    if blocks <= 2:
        return 1, 0
    while True:
        a = int(rng.integers(1, blocks))
        if gcd(a, blocks) == 1:
            return a, int(rng.integers(0, blocks))


def plan_quotas(totals: dict[str, tuple[int, int]], targets: list[tuple[str, float, int]], wanted: int | None, block_tokens: int, seed: int) -> list[SourcePlan]:
    """totals: source to (tokens, documents). The mixture is as large as the scarcest source allows at its cap, or
    ``wanted`` tokens if that is less. Sources without tokens give nothing and don't limit the others."""
    able = [(s, share, cap) for s, share, cap in targets if totals.get(s, (0, 0))[0] > 0 and share > 0 and cap > 0]
    if not able:
        return []
    scale = sum(share for _, share, _ in able)
    size = min(totals[s][0] * cap / (share / scale) for s, share, cap in able)
    size = min(size, wanted) if wanted is not None else size
    rng, out = np.random.default_rng(seed), []
    for s, share, cap in sorted(able):
        total, docs = totals[s]
        quota = min(int(size * share / scale + 1e-6), total * cap)
        blocks = max(1, min(-(-total // block_tokens), docs))
        a, b = _permutation(blocks, rng)
        out.append(SourcePlan(s, share / scale, cap, total, docs, blocks, quota, quota // total, quota % total, a, b))
    return out


def splitting_tree(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """shards x sources block counts: rows add up to even shard sizes, columns to the quotas, exactly.

    Each node halves its shards; the left half's counts are a multivariate hypergeometric draw from the node's."""
    counts = np.zeros((shards, len(quotas)), dtype=np.int64)
    rng = np.random.default_rng(seed)
    stack = [(0, shards, np.array(quotas, dtype=np.int64))]
    while stack:
        low, high, have = stack.pop()
        if high - low == 1:
            counts[low] = have
            continue
        mid = (low + high) // 2
        whole = int(have.sum())
        take = whole * (mid - low) // (high - low)
        left = rng.multivariate_hypergeometric(have, take, method="marginals") if take and len(have) > 1 else np.array([take] + [0] * (len(have) - 1), dtype=np.int64)
        stack += [(low, mid, left), (mid, high, have - left)]
    return counts


def _bucket(key: Column, source: Column, n: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), source, key), n).cast("long")


def mix_sources(
    docs: DataFrame,
    key: str,
    source: str,
    text: str,
    targets: DataFrame,
    *,
    share: str = "target_share",
    cap: str = "max_repeats",
    wanted_tokens: int | None = None,
    shard_tokens: int = 2_000_000,
    block_tokens: int = 20_000,
    seed: int = 7,
    max_sources: int = 100_000,
    max_counts: int = 5_000_000,
    tokenizer_file: str = TOKENIZER_FILE,
) -> tuple[DataFrame, DataFrame]:
    """(mixture, report).

    mixture: key, source, copy (from 0), n_tokens, shard, place (from 1, the shuffled order within its shard).
    report: source, target_share, actual_share, n_tokens, n_docs, most_copies.
    A document is used at most ``cap`` times and at most once in each pass. NULL, blank-source and token-less
    documents and sources without a target take no part; a repeated row is a document of its own only if its key
    differs in value or it stands in the table again. The tree's counts (sources x shards) are made on the driver: a
    ValueError asks for larger shards where there would be more than ``max_counts``. Empty tables give an empty mixture and a report of zeros."""
    spark = docs.sparkSession
    goals = [(r[0], float(r[1] or 0), int(r[2] or 0)) for r in targets.select(source, share, cap).filter(qcol(source).isNotNull()).limit(max_sources + 1).collect()]
    if len(goals) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    known = targets.select(qcol(source).alias("__s")).filter(F.col("__s").isNotNull()).distinct()
    part = docs.join(known, qcol(source) == F.col("__s"), "left_semi").filter(qcol(text).isNotNull())
    sized = stored(count_tokens(part, [key, source], text, tokenizer_file).filter(F.col("n_tokens") > 0).select(qcol(key).alias("k"), qcol(source).alias("s"), "n_tokens"))
    totals = {r["s"]: (r["t"], r["n"]) for r in sized.groupBy("s").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")).collect()}
    plans = plan_quotas(totals, goals, wanted_tokens, block_tokens, seed)
    rows = [(p.source, p.blocks, p.passes, p.rest, p.multiplier, pow(p.multiplier, -1, p.blocks) if p.blocks > 1 else 0, p.offset) for p in plans]
    plan = spark.createDataFrame(rows, "s string, blocks long, passes long, rest long, mul long, inv long, off long")
    blocked = sized.join(plan, "s").withColumn("block", _bucket(F.col("k"), F.col("s"), F.col("blocks"), seed))

    # the last pass: blocks in permuted order up to the rest, by prefix sums in two levels of bounded windows
    p = F.pmod(F.pmod(F.col("block") - F.col("off"), F.col("blocks")) * F.col("inv"), F.col("blocks"))
    sums = blocked.groupBy("s", "block", "rest", "blocks", "off", "inv").agg(F.sum("n_tokens").alias("t")).withColumn("p", p).withColumn("g", F.floor(F.col("p") / 1024))
    groups = sums.groupBy("s", "g").agg(F.sum("t").alias("gt"))
    before = groups.withColumn("base", F.sum("gt").over(Window.partitionBy("s").orderBy("g")) - F.col("gt")).drop("gt")
    upto = sums.join(before, ["s", "g"]).withColumn("start", F.col("base") + F.sum("t").over(Window.partitionBy("s", "g").orderBy("p")) - F.col("t"))
    last = stored(upto.filter(F.col("start") < F.col("rest")).select("s", "block", "p", "start", (F.col("start") + F.col("t") > F.col("rest")).alias("cut"), (F.col("rest") - F.col("start")).alias("room")))
    last_blocks = {r["s"]: r["n"] for r in last.groupBy("s").agg(F.count("*").alias("n")).collect()}

    # block quotas to shards
    quotas = [q.passes * q.blocks + last_blocks.get(q.source, 0) for q in plans]
    size = sum(q.quota for q in plans)
    shards = max(1, min(-(-size // shard_tokens), max(1, sum(quotas))))
    if shards * len(plans) > max_counts:
        raise ValueError(f"{shards} shards of {len(plans)} sources: the tree's counts would be more than {max_counts}; make shard_tokens larger")
    counts = splitting_tree(quotas, shards, seed) if plans else np.zeros((0, 0), dtype=np.int64)
    ends = counts.cumsum(axis=0)
    leaves = [(q.source, j, int(ends[j, i] - counts[j, i]), int(ends[j, i])) for i, q in enumerate(plans) for j in range(shards) if counts[j, i]]
    drawn = (
        spark.createDataFrame(leaves, "s string, shard long, low long, high long")
        .select("s", "shard", F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("i"))
        .join(plan, "s")
        .select("s", "shard", F.floor(F.col("i") / F.col("blocks")).alias("copy"), F.pmod(F.pmod(F.col("i"), F.col("blocks")) * F.col("mul") + F.col("off"), F.col("blocks")).alias("block"), "passes")
    )
    # the documents of the one block in which a source's last pass ends, as many as come nearest to what is left
    edge = blocked.join(last.filter("cut").select("s", "block", "room"), ["s", "block"])
    by_chance = Window.partitionBy("s", "block").orderBy(F.xxhash64(F.lit(seed + 1), "k"), "k", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    fits = edge.withColumn("run", F.sum("n_tokens").over(by_chance)).filter(F.col("run") - F.col("n_tokens") / 2 <= F.col("room")).select("k", "s", "n_tokens", "block")
    whole = blocked.select("k", "s", "n_tokens", "block")
    cut_blocks = last.filter("cut").select("s", "block", F.lit(True).alias("is_cut"))
    marked = drawn.join(cut_blocks, ["s", "block"], "left").withColumn("partial", F.coalesce("is_cut", F.lit(False)) & (F.col("copy") == F.col("passes"))).drop("is_cut", "passes")
    placed = whole.join(marked.filter(~F.col("partial")), ["s", "block"]).unionByName(fits.join(marked.filter("partial"), ["s", "block"]))
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 2), "shard", "s", "k", "copy"), "k", "copy")
    mixture = placed.select(F.col("k").alias(key), F.col("s").alias(source), F.col("copy").cast("int").alias("copy"), "n_tokens", F.col("shard").cast("long").alias("shard"), F.row_number().over(order).cast("long").alias("place"))

    used = placed.groupBy("s").agg(F.sum("n_tokens").alias("t"), F.countDistinct("k").alias("d"), (F.max("copy") + 1).cast("int").alias("m"))
    goal_rows = spark.createDataFrame([(s, w) for s, w, _ in goals], "s string, w double")
    everything = F.sum("t").over(Window.partitionBy(F.lit(0)))  # one row for each source
    report = goal_rows.join(used, "s", "left").select(
        F.col("s").alias(source),
        F.col("w").alias("target_share"),
        F.round(F.coalesce(F.col("t") / everything, F.lit(0.0)), 6).alias("actual_share"),
        F.coalesce("t", F.lit(0)).alias("n_tokens"),
        F.coalesce("d", F.lit(0)).alias("n_docs"),
        F.coalesce("m", F.lit(0)).alias("most_copies"),
    )
    return mixture, report
