"""Every business constant once. They decide results."""

from __future__ import annotations

# run comparison
MIN_SPEEDUP, MAX_YIELD_DROP, MAX_DNS_RISE, MAX_DRIFT = 1.5, 0.05, 0.03, 0.20
MIN_DISTRIBUTION_RATIO, MIN_WAVES = 0.8, 3
# task health
MIN_YIELD, MAX_DNS, MAX_UNREACHABLE, HEALTHY_YIELD = 0.30, 0.20, 0.10, 0.50
# retry, pilot, recorded sizes, arms, diagnosis, pooling, resolution
KEEPABLE_SHARD_YIELD = 0.05
PILOT_MIN_YIELD, PILOT_MAX_DECODE_FAILURE = 0.30, 0.01
ARRIVED_MEDIAN_DRIFT = 0.20
ARMS_MIN_SPEEDUP, ARMS_MAX_YIELD_DROP = 1.25, 0.05
EXPLAINED_LOW, EXPLAINED_HIGH = 0.7, 1.4
POOLING_REUSE = 2.0
DEGENERATE_SIDE, DEGENERATE_SHARE = 32, 0.01
SIDE_LADDER = (32, 112, 224, 256, 512, 1024)
PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 99)
ALTERNATIVES = ((3, 0), (5, 0), (5, 1), (10, 0))
# sampling
SAMPLE_FILES, SAMPLE_IMAGES, SAMPLE_TASKS, SAMPLE_SHARDS = 40, 200, 12, 5
HOST_URLS, HOST_FILES, HOST_WINDOW = 500_000, 4, 10_000
# planning
URLS_PER_TASK = 1_000_000
PROCESSES, THREADS, SAMPLES_PER_SHARD, TIMEOUT_S, RETRIES = 32, 32, 10_000, 10, 0
RATE_PER_NODE, PLANNED_YIELD, KB_PER_IMAGE, DISTRIBUTION_EFFICIENCY = 225.3, 0.55, 85.6, 0.97
CORPUS_ROWS = 1_387_173_656
PLAN_NODES, ARM_NODES = (4, 8, 16, 32), (16, 32, 64)
STORAGE_TASKS, STORAGE_YIELD = 735, 0.645
# pool, locks, submission
POOL_HOSTS, POOL_PER_HOST, MAX_REDIRECTS = 10_000, 8, 5
LOCK_STALE_S, HEARTBEAT_S = 1800, 60
MAX_UNFINISHED, MAX_UNCAPPED = 1000, 16
RESERVED_COLUMNS = ("key", "status", "error_message", "width", "height", "original_width", "original_height")
