"""Business rules over aggregates (V1-V10, V18). NULL means a control wasn't run; it never rejects by itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import thresholds as T
from ..functions.model import url_seconds
from .outcomes import rate


def _percent(c: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", c * 100)


def health_cause(max_unreachable: float = T.MAX_UNREACHABLE, max_dns: float = T.MAX_DNS, min_yield: float = T.MIN_YIELD) -> Column:
    """Of a summary with rates: nothing_attempted, unreachable, dns, low_yield, or NULL if healthy."""
    y = F.col("yield_rate")
    return (
        F.when(F.col("candidates") <= 0, "nothing_attempted")
        .when((F.col("unreachable_fraction") > max_unreachable) & ~F.coalesce(y >= T.HEALTHY_YIELD, F.lit(False)), "unreachable")
        .when(F.col("dns_fraction") > max_dns, "dns")
        .when(y < min_yield, "low_yield")
    )


def health(summary: DataFrame, **limits: float) -> DataFrame:
    cause = health_cause(**limits)
    y, d, u = (_percent(F.col(c)) for c in ("yield_rate", "dns_fraction", "unreachable_fraction"))
    reason = (
        F.when(cause == "nothing_attempted", "no attempt was made: 0 candidates")
        .when(cause == "unreachable", F.concat(F.lit("network unreachable for "), u, F.lit(" of attempts and the yield is only "), y))
        .when(cause == "dns", F.concat(F.lit("DNS failed for "), d, F.lit(" of attempts; the yield was "), y))
        .when(cause == "low_yield", F.concat(F.lit("yield "), y, F.lit(" with no single cause: DNS "), d, F.lit(", unreachable "), u))
    )
    return summary.withColumns({"cause": cause, "healthy": cause.isNull(), "reason": reason})


def _no(c: Column) -> Column:
    """True only where c is known to be false."""
    return F.coalesce(~c, F.lit(False))


def concurrency_verdict(runs: DataFrame, order: str = "run") -> DataFrame:
    """One row: the first run is the baseline, the first later one with other processes is scaled, with the same, repeat."""
    one = F.struct(order, "processes", "successes_per_sec", "yield_rate", "dns_fraction")
    base = runs.agg(F.min_by(one, order).alias("base"))
    later = runs.crossJoin(base).where(F.col(order) > F.col(f"base.{order}"))  # base is one row
    same = F.col("processes") == F.col("base.processes")
    seen = later.agg(
        F.min_by(F.when(~same, one), F.when(~same, F.col(order))).alias("scaled"),
        F.min_by(F.when(same, one), F.when(same, F.col(order))).alias("repeat"),
        F.bool_and(F.col("base.yield_rate") - F.col("yield_rate") <= T.MAX_YIELD_DROP).alias("yield_preserved"),
        F.bool_and(F.col("dns_fraction") - F.col("base.dns_fraction") <= T.MAX_DNS_RISE).alias("dns_stable"),
    )
    r0 = F.when(F.col("base.successes_per_sec") != 0, F.col("base.successes_per_sec"))
    out = base.crossJoin(seen).select(
        (F.col("scaled.successes_per_sec") / r0 >= T.MIN_SPEEDUP).alias("scales"),
        F.coalesce("yield_preserved", F.lit(True)).alias("yield_preserved"),
        F.coalesce("dns_stable", F.lit(True)).alias("dns_stable"),
        (F.abs(F.col("repeat.successes_per_sec") - r0) / r0).alias("baseline_drift"),
    )
    out = out.withColumn("baseline_stable", F.col("baseline_drift") <= T.MAX_DRIFT)
    return out.withColumn("rejected", _no(F.col("scales")) | ~F.col("yield_preserved") | ~F.col("dns_stable") | _no(F.col("baseline_stable")))


def distribution_verdict(runs: DataFrame, order: str = "run", min_ratio: float = T.MIN_DISTRIBUTION_RATIO) -> DataFrame:
    """One row: runs with nodes = 1 against the run with more."""
    single, multi = F.col("nodes") == 1, F.col("nodes") > 1
    s = lambda c: F.when(single, F.col(c))
    r = F.col("successes_per_sec")
    got = runs.agg(
        F.avg(F.when(single & (r != 0), r)).alias("single_node_rate"),
        F.min_by(F.when(multi, r), F.when(multi, F.col(order))).alias("multi_node_rate"),
        F.avg(s("yield_rate")).alias("y1"), F.avg(s("dns_fraction")).alias("d1"),
        F.min_by(F.when(multi, F.col("yield_rate")), F.when(multi, F.col(order))).alias("y2"),
        F.min_by(F.when(multi, F.col("dns_fraction")), F.when(multi, F.col(order))).alias("d2"),
        F.min_by(F.when(single, F.struct(r.alias("r"))), s(order)).alias("first"),
        F.max_by(F.when(single, F.struct(r.alias("r"))), s(order)).alias("last"),
        F.count_if(single).alias("n"),
    )
    first = F.when((F.col("n") >= 2) & (F.col("first.r") != 0), F.col("first.r"))
    out = got.select(
        (F.col("multi_node_rate") >= min_ratio * F.col("single_node_rate")).alias("distribution_neutral"),
        F.coalesce(F.col("y1") - F.col("y2") <= T.MAX_YIELD_DROP, F.lit(True)).alias("yield_preserved"),
        F.coalesce(F.col("d2") - F.col("d1") <= T.MAX_DNS_RISE, F.lit(True)).alias("dns_stable"),
        (F.abs(F.col("last.r") - first) / first).alias("baseline_drift"), "single_node_rate", "multi_node_rate",
    )
    out = out.withColumn("baseline_stable", F.col("baseline_drift") <= T.MAX_DRIFT)
    return out.withColumn("rejected", _no(F.col("distribution_neutral")) | ~F.col("yield_preserved") | ~F.col("dns_stable") | _no(F.col("baseline_stable")))


def complete_phases(phases: DataFrame) -> DataFrame:
    """Phases whose nodes all reported, or where nobody said how many there should be."""
    return phases.where("expected_nodes IS NULL OR nodes >= expected_nodes")


def ranked_arms(arms: DataFrame) -> DataFrame:
    """Arms with urls_per_second, successes_per_second, yield, whether each is the control, its rank and speed-up (H7)."""
    rates = arms.withColumns({"urls_per_second": rate("candidates", "wall_seconds"), "successes_per_second": rate("successes", "wall_seconds"), "yield_rate": rate("successes", "candidates")})
    control = rates.agg(F.min(F.struct("threads", (-F.col("retries")).alias("r"), "task", "successes_per_second", "yield_rate")).alias("c"))
    both = rates.crossJoin(control)  # control is one row, arms are settings
    from pyspark.sql import Window

    place = F.row_number().over(Window.orderBy(F.desc("successes_per_second"), "task"))
    return both.select(
        *rates.columns, (F.col("task") == F.col("c.task")).alias("is_control"), place.cast("long").alias("place"),
        rate("successes_per_second", "c.successes_per_second").alias("speedup"), (F.col("c.yield_rate") - F.col("yield_rate")).alias("yield_drop"),
    )


def chosen_arm(arms: DataFrame) -> DataFrame:
    """One row: arms, verdict (too_few, no_gain, trades_yield, wins), the chosen task and its node-hours for the corpus."""
    got = ranked_arms(arms).agg(
        F.count("*").alias("n_arms"),
        F.min_by(F.struct("task", "speedup", "yield_drop", "urls_per_second"), "place").alias("best"),
        F.min_by(F.struct("task", "urls_per_second"), F.when(F.col("yield_drop") <= T.ARMS_MAX_YIELD_DROP, F.col("place"))).alias("held"),
        F.min_by(F.struct("task", "urls_per_second"), F.when(F.col("is_control"), F.col("place"))).alias("control"),
    )
    speed = F.coalesce("best.speedup", F.lit(float("inf")))
    verdict = F.when(F.col("n_arms") < 2, "too_few").when(speed < T.ARMS_MIN_SPEEDUP, "no_gain").when(F.col("best.yield_drop") > T.ARMS_MAX_YIELD_DROP, "trades_yield").otherwise("wins")
    pick = F.when(verdict == "trades_yield", F.coalesce("held", "control")).when(verdict != "too_few", F.struct("best.task", "best.urls_per_second"))
    return got.select("n_arms", verdict.alias("verdict"), F.col("best.speedup").alias("speedup"), pick.getField("task").alias("task"), (F.lit(T.CORPUS_ROWS) / pick.getField("urls_per_second") / 3600).alias("node_hours"))


def arm_days(chosen: DataFrame, nodes: tuple[int, ...] = T.ARM_NODES) -> DataFrame:
    """(task, node_hours, nodes, days) of a chosen arm."""
    each = chosen.select("task", "node_hours", F.explode(F.array(*[F.lit(n).cast("long") for n in nodes])).alias("nodes"))
    return each.withColumn("days", F.col("node_hours") / F.col("nodes") / 24)


def throughput_diagnosis(summary: DataFrame, node_seconds: float, workers: int = T.PROCESSES * T.THREADS, timeout: float = T.TIMEOUT_S, retries: int = 2, success_seconds: float = 1.0) -> DataFrame:
    """Whether timeouts explain the rate of a summary's rows (V5)."""
    failure = rate(F.col("candidates") - F.col("successes"), "candidates")
    observed = rate(F.lit(workers * node_seconds), "candidates")
    out = summary.select("*", failure.alias("failure_rate"), observed.alias("observed_cost"))
    out = out.withColumn("predicted_cost", url_seconds(F.col("failure_rate"), timeout, retries, success_seconds))
    out = out.withColumn("cost_ratio", rate("observed_cost", "predicted_cost"))
    return out.withColumn("explained", F.col("cost_ratio").between(T.EXPLAINED_LOW, T.EXPLAINED_HIGH))


def alternatives(diagnosis: DataFrame, timeout: float = T.TIMEOUT_S, retries: int = 2, success_seconds: float = 1.0, workers: int = T.PROCESSES * T.THREADS) -> DataFrame:
    """What other settings would give; only where timeouts explain the rate."""
    options = F.array(*[F.struct(F.lit(float(t)).alias("timeout"), F.lit(r).alias("retries")) for t, r in T.ALTERNATIVES])
    each = diagnosis.where("explained").select("*", F.explode(options).alias("o"))
    cost = url_seconds(F.col("failure_rate"), F.col("o.timeout"), F.col("o.retries"), success_seconds)
    now = url_seconds(F.col("failure_rate"), timeout, retries, success_seconds)
    speed = F.lit(float(workers)) / cost
    return each.select(*[c for c in diagnosis.columns], F.col("o.timeout").alias("timeout"), F.col("o.retries").alias("retries"), (now / cost).alias("gain"), speed.alias("urls_per_second"), (F.lit(1e6) / speed / 3600).alias("task_hours"))


def pilot_verdict(report: DataFrame) -> DataFrame:
    """report: candidates, successes, decoded, decode_failures, caption_mismatches (V6)."""
    low = F.coalesce(rate("successes", "candidates"), F.lit(0.0)) < T.PILOT_MIN_YIELD
    broken = F.coalesce(rate("decode_failures", F.col("decoded") + F.col("decode_failures")) > T.PILOT_MAX_DECODE_FAILURE, F.lit(False))
    mixed = F.col("caption_mismatches") > 0
    return report.withColumns({"low_yield": low, "bad_images": broken, "bad_captions": mixed, "stop": low | broken | mixed})
