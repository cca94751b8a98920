"""Mixing sources to target weights by temperature.

1. Token shares: tokens (runs other than 0x20, 0x09 to 0x0D) summed by source. A null source is a source of its own.
2. Temperature: weights are shares to the power of an exponent, normalised. Entropy falls and repetition falls as the
   exponent rises from 0 to 1, so both bounds are bisected: the largest exponent that reaches the target entropy and
   the smallest that keeps every source's passes at or under the repetition limit; the larger holds, so the limit wins.
   A round evaluates SPLITS exponents in one aggregate over the sources; only a dozen numbers reach the driver, however
   many sources there are.
3. Budgets: a source's weight times the token budget. That is a number of whole passes and a rest. Each pass goes
   through the source's blocks (of about BLOCK_TOKENS tokens, dealt by hash) in a permutation of its own, and within a
   block through its documents in a permuted order. The rest takes whole documents in the next pass's order while they
   fit. The last one that fits is found by radix: sums by 1,024 cells of the order, then by 1,024 cells of the cell in
   which the budget ends, then by document within that, so no source's documents are gathered or sorted as a whole.

The budget is "total" (as many tokens as there are: large sources are cut, small ones repeat) or "cover" (the least at
which every document is used at least once), or a number of tokens.

Null text is the empty text. Documents without a token cost nothing; a source that has no token at all has weight 0 and
passes once. Rows are mixed by themselves: repeated rows are separate, rows of equal doc_id share a place in the order
and are taken or left together. Null ids have the place of hash(null). An empty table gives an empty result.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns, documents, fresh, texts, written

SEED = 17
BLOCK_TOKENS = 1_000_000
#: Share of the largest entropy (all sources alike) that the weights must reach.
ENTROPY_SHARE = 0.97
#: Passes over a source at most, on average.
MOST_PASSES = 4.0
SPLITS, ROUNDS = 16, 9
CELL_BITS = 10


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, n_tokens)."""
    picked = texts(df, id_col, text_col, F.col(source_col).cast("string").alias("source"))
    return picked.select("doc_id", "source", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"))


def _curve(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy, log of the sum of powers) at each exponent; shares has column lp, the log of a positive share."""
    sums = [F.sum(F.exp(F.col("lp") * a)) for a in exponents] + [F.sum(F.exp(F.col("lp") * a) * F.col("lp")) for a in exponents]
    got = shares.agg(*sums).first()
    n = len(exponents)
    return [(log(got[i]) - a * got[n + i] / got[i], log(got[i])) for i, a in enumerate(exponents)]


def temperature(shares: DataFrame, entropy_share: float, most_passes: float, budget: str | int) -> float:
    """The exponent, to 9 digits."""
    low_lp, high_lp, n, tokens = shares.agg(F.min("lp"), F.max("lp"), F.count("*"), F.sum("tokens")).first()
    if n < 2:
        return 1.0

    def passes(a: float, log_z: float) -> float:
        """Log of the passes of the source that repeats most, for a <= 1: the smallest."""
        if budget == "cover":
            return (1 - a) * (high_lp - low_lp)
        return (a - 1) * low_lp - log_z + (0.0 if budget == "total" else log(max(1, int(budget)) / tokens))

    def bisect(good) -> float:  # noqa: ANN001
        """Where good(a, entropy, log_z), true below some exponent, ends; SPLITS at a time."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * k / SPLITS for k in range(SPLITS + 1)]
            held = [good(a, *v) for a, v in zip(grid, _curve(shares, grid))]
            if all(held):
                return grid[-1]
            k = held.index(False)
            if k == 0:
                return grid[0]
            low, high = grid[k - 1], grid[k]
        return low

    by_entropy = bisect(lambda a, h, z: h >= entropy_share * log(n) - 1e-12)
    by_passes = bisect(lambda a, h, z: passes(a, z) > log(most_passes))
    return round(max(by_entropy, by_passes), 9)


def source_plan(docs: DataFrame, entropy_share: float = ENTROPY_SHARE, most_passes: float = MOST_PASSES, budget: str | int = "total", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per source: source, tokens, weight, budget, passes, rest, blocks."""
    by_source = written(docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "sources")
    total = by_source.agg(F.sum("tokens")).first()[0] or 0
    shares = by_source.where("tokens > 0").withColumn("lp", F.log(F.col("tokens") / F.lit(float(max(1, total)))))
    a = temperature(shares, entropy_share, most_passes, budget) if total else 1.0
    log_z, top = shares.agg(F.log(F.sum(F.exp(F.col("lp") * a))), F.max("lp")).first() if total else (0.0, 0.0)
    whole = F.lit(float(total)) * F.exp((1 - a) * F.lit(top) + F.lit(log_z)) if budget == "cover" else F.lit(float(total if budget == "total" else budget))
    lp = F.log(F.when(F.col("tokens") > 0, F.col("tokens") / F.lit(float(max(1, total)))))
    weight = F.coalesce(F.exp(lp * a - F.lit(log_z)), F.lit(0.0))
    sources = by_source.select("source", "tokens", weight.alias("weight"), F.floor(weight * whole + 1e-6).cast("long").alias("budget"))
    n = F.when(F.col("tokens") > 0, F.expr("budget div greatest(tokens, 1)")).otherwise(F.lit(1))
    sources = sources.withColumn("passes", n.cast("long"))
    rest = F.when(F.col("tokens") > 0, F.col("budget") - F.col("passes") * F.col("tokens")).otherwise(F.lit(0))
    return sources.withColumn("rest", rest.cast("long")).withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long"))


def _place(epoch: Column, seed: int, block: Column) -> Column:
    """62 bits of order in a pass: the block's place, then the document's."""
    block = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("source"), epoch, block), 33)
    doc = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), epoch, F.col("doc_id")), 33)
    return F.shiftleft(block, 31).bitwiseOR(doc)


def _rest(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, last): the last place of the next pass that still fits a source's rest; sources where none fits are absent."""
    left = docs.where("rest > 0").select("source", "place", "n_tokens", "rest")
    for level in (1, 2):
        cell = F.shiftright("place", 62 - CELL_BITS * level)
        cells = left.groupBy("source", cell.alias("cell")).agg(F.sum("n_tokens").alias("n"), F.min("rest").alias("rest"))
        run = F.sum("n").over(Window.partitionBy("source").orderBy("cell"))
        over = cells.withColumn("run", run).where("run > rest").groupBy("source").agg(F.min(F.struct("cell", "run", "n")).alias("m"))
        edge = over.select(F.col("source").alias("s"), F.col("m.cell").alias("edge"), (F.col("m.run") - F.col("m.n")).alias("before"))
        joined = left.join(edge, F.col("source").eqNullSafe(F.col("s")))
        left = joined.where(cell == F.col("edge")).select("source", "place", "n_tokens", (F.col("rest") - F.col("before")).alias("rest"))
    run = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("place"))  # equal places run together
    out = left.withColumn("run", run).where("run > rest").groupBy("source").agg(F.min("place").alias("stop"))
    return plan.where("rest > 0").select("source").join(out.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select("source", "stop")


def with_copies(df: DataFrame, plan: DataFrame, stops: DataFrame, seed: int = SEED, name: str = "mix") -> DataFrame:
    """df (with doc_id and source) and a struct `name`, which df lacks, of its plan's weight, budget, block, passes, in_rest,
    copies and place; one row per row.

    plan and stops have one row per source, as tables whose size Spark knows before it chooses a join.
    """
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"there is a column {name} already")
    plan_, s_ = fresh(df, "plan", "source_of_plan")
    both = plan.join(stops.select(F.col("source").alias(s_), "stop"), F.col("source").eqNullSafe(F.col(s_)), "left").drop(s_)
    named = both.select(F.struct(*(c for c in both.columns if c != "source")).alias(plan_), F.col("source").alias(s_))
    out = df.join(named, F.col("source").cast("string").eqNullSafe(F.col(s_)))
    of = F.col(plan_)
    block = F.pmod(F.xxhash64(F.lit(seed + 2), "doc_id"), of["blocks"])
    place = _place(of["passes"], seed, block)
    inside = F.coalesce((of["rest"] > 0) & (of["stop"].isNull() | (place < of["stop"])), F.lit(False))
    found = F.struct(
        *(of[c].alias(c) for c in ("weight", "budget", "passes", "rest")),
        block.alias("block"), inside.alias("in_rest"), (of["passes"] + inside.cast("long")).alias("copies"), place.alias("place"),
    )
    return out.select(*columns(df), found.alias(name))


def planned(docs: DataFrame, entropy_share: float = ENTROPY_SHARE, most_passes: float = MOST_PASSES, budget: str | int = "total", block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(plan, stops) of sized documents, one row per source each."""
    plan = written(source_plan(docs, entropy_share, most_passes, budget, block_tokens), "plan")
    none = plan.select("source", F.lit(None).cast("long").alias("stop")).limit(0)
    dealt = with_copies(docs, plan, none, seed).select("source", "n_tokens", "mix.rest", "mix.place")
    return plan, written(_rest(dealt, plan), "stops")


def mix(df: DataFrame, entropy_share: float = ENTROPY_SHARE, most_passes: float = MOST_PASSES, budget: str | int = "total", block_tokens: int = BLOCK_TOKENS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, source, n_tokens, weight, source_budget, block, passes, in_rest, copies, place."""
    docs = written(sized(df, id_col, text_col, source_col), "sized")
    plan, stops = planned(docs, entropy_share, most_passes, budget, block_tokens, seed)
    out = with_copies(docs, plan, stops, seed)
    return out.select("doc_id", "source", "n_tokens", "mix.weight", F.col("mix.budget").alias("source_budget"), *(f"mix.{c}" for c in ("block", "passes", "in_rest", "copies", "place")))


def schedule(mixed: DataFrame, seed: int = SEED) -> DataFrame:
    """mix()'s rows as what a training job reads: doc_id, source, epoch, block, place, one row for each use."""
    each = mixed.where("copies > 0").select("doc_id", "source", "block", F.explode(F.expr("sequence(0L, copies - 1)")).alias("epoch"))
    return each.withColumn("place", _place(F.col("epoch"), seed, F.col("block")))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


QUERIES = {"op1_mix_sources": op1_mix_sources}
ORACLES: dict[str, str] = {}
