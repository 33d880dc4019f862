"""A selection of documents in which each source has its target share of all tokens.

Documents with the same text are one unit, which every source that has it may supply: its membership pattern. Units
are aggregated by pattern, so the problem is a small graph whatever the corpus: source of flow -> patterns (tokens) ->
sources (quota) -> sink. Min-cost flow routes token capacity; the k-th use of a pattern's tokens by a source costs k - 1,
so repetition is taken last and spread evenly. Shortest paths are looked for among the sources only, over the cheapest exchange that
any pattern allows, and all patterns that allow it at that cost serve a path at once. The flow is then turned into documents: the units of a pattern are laid on
a circle in the order of a seeded hash, and each source takes an arc of the length of its flow; a unit is used once for
each time the arc passes its start.

The total is the largest at which every source with documents can have its share (shares of sources without any are
divided among the rest in proportion), unless a smaller ``total`` is given. Where sources share texts that is found by bisection
over flows, to one part in ten thousand. A source without target is not used, nor is a
null source; null and empty texts have no tokens and are never selected. Offsets on the circle come from a histogram of
hashes, so no pattern, however large, is sorted in one task.

All patterns go to the flow, however many: at most the subsets of the sources with a target that occur.
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.encode import TOKENIZERS, VOCABULARY, token_count
from tidemark.session import cut_lineage, spread

MAX_PATTERNS = 100_000  # arcs of up to so many patterns are broadcast, of more joined by the planner; no result depends on it
BUCKETS = 1 << 16


NEVER = 1 << 40  # cost of what isn't possible


def _dealt(room: np.ndarray, n: int) -> np.ndarray:
    """``n`` from the first of ``room`` on."""
    return np.clip(n - (np.cumsum(room) - room), 0, room)


def fill(tokens: np.ndarray, holds: np.ndarray, most: np.ndarray, quota: np.ndarray, priced: bool = True) -> np.ndarray:
    """Tokens each source takes of each pattern (a row per pattern): as much of the quotas as possible, at least cost if ``priced``.

    ``holds`` says which sources have a pattern, ``most`` how often a source may use its tokens. Successive shortest paths: tokens
    that come from a pattern to one source, from where others go on to a second by another pattern, and so on to a source whose
    quota isn't met. Paths of equal cost and fewest sources come first."""
    cap = np.where(holds, tokens[:, None] * most, 0)
    out_cap = cap.max(1, initial=0)  # the texts of a pattern can be used as often as its most generous source allows
    step = tokens if priced else np.full(len(tokens), NEVER)  # tokens of one cost
    flow, out, left = np.zeros_like(cap), np.zeros_like(out_cap), quota.copy()
    sources, least = len(most), 0
    while True:
        level = flow // step[:, None]
        more_room = np.minimum((level + 1) * step[:, None], cap) - flow
        more = np.where(more_room > 0, level, NEVER)
        top = (flow - 1) // step[:, None]
        back_room = flow - top * step[:, None] * (flow > 0)
        back = np.where(flow > 0, top, -NEVER)
        out_level = out // step
        out_room = np.minimum((out_level + 1) * step, out_cap) - out
        enter = np.where(out_room > 0, out_level, NEVER)[:, None] + more
        first = enter.min(0, initial=NEVER)
        direct = np.where(left > 0, first, NEVER)
        if sources and direct.min() <= least:  # paths never get cheaper, so this is one of the next
            at = int(direct.argmin())
            new = np.where(enter[:, at] == first[at], np.minimum(out_room, more_room[:, at]), 0)
            n = min(int(left[at]), int(new.sum()))
            new = _dealt(new, n)
            out += new
            flow[:, at] += new
            left[at] -= n
            continue
        taken = [np.flatnonzero(flow[:, s]) for s in range(sources)]
        swap = np.stack([(more[t] - back[t, s][:, None]).min(0, initial=NEVER) for s, t in enumerate(taken)]) if sources else np.zeros((0, 0), np.int64)
        # cost first, then the number of sources on the way
        far = np.where(first < NEVER, first * (sources + 2) + 1, NEVER * sources)
        by = np.full(sources, -1)
        for _ in range(sources):
            through = np.where(swap < NEVER // 2, far[:, None] + swap * (sources + 2) + 1, NEVER * sources)
            nearest = through.argmin(0)
            better = through[nearest, np.arange(sources)] < far
            if not better.any():
                break
            far = np.where(better, through[nearest, np.arange(sources)], far)
            by = np.where(better, nearest, by)
        ends = np.where(left > 0, far, NEVER * sources)
        at = int(ends.argmin()) if sources else 0
        if not sources or ends[at] >= NEVER:
            return flow
        path = [at]
        while by[path[-1]] >= 0:
            path.append(int(by[path[-1]]))
        path.reverse()
        s = path[0]
        least = int(first[s]) + sum(int(swap[a, b]) for a, b in zip(path, path[1:]))
        rooms = [np.where(enter[:, s] == first[s], np.minimum(out_room, more_room[:, s]), 0)]
        for a, b in zip(path, path[1:]):
            rooms.append(np.where(more[:, b] - back[:, a] == swap[a, b], np.minimum(more_room[:, b], back_room[:, a]), 0))
        n = min(int(left[at]), *(int(r.sum()) for r in rooms))
        new = _dealt(rooms[0], n)
        out += new
        flow[:, s] += new
        for a, b, r in zip(path, path[1:], rooms[1:]):
            moved = _dealt(r, n)
            flow[:, a] -= moved
            flow[:, b] += moved
        left[at] -= n


def route(patterns: dict[tuple[str, ...], int], target: dict[str, tuple[float, int]], total: int | None = None) -> dict[tuple[tuple[str, ...], str], int]:
    """Tokens each source takes of each pattern. ``patterns``: tokens by sorted sources; ``target``: share and most uses."""
    has = {s for p in patterns for s in p if s in target and patterns[p] > 0 and target[s][0] > 0 and target[s][1] > 0}
    if not has:
        return {}
    whole = sum(target[s][0] for s in has)
    share = {s: target[s][0] / whole for s in has}
    supply = {s: target[s][1] * sum(c for p, c in patterns.items() if s in p) for s in has}
    size = min(int(supply[s] / share[s]) for s in has)
    if total is not None:
        size = min(size, total)

    names, pats = sorted(has), sorted(p for p in patterns if patterns[p] > 0 and has & set(p))
    tokens, most = np.array([patterns[p] for p in pats], np.int64), np.array([target[s][1] for s in names], np.int64)
    nth = {s: i for i, s in enumerate(names)}
    holds = np.zeros((len(pats), len(names)), bool)
    for i, p in enumerate(pats):
        holds[i, [nth[s] for s in p if s in has]] = True

    def solve(size: int, priced: bool):
        quota = np.array([round(share[s] * size) for s in names], np.int64)
        flow = fill(tokens, holds, most, quota, priced)
        return flow, min((n / q for n, q in zip(flow.sum(0).tolist(), quota.tolist()) if q), default=1.0)

    _, worst = solve(size, False)
    if worst < 1 - 1e-6:
        # feasible below some size: quotas grow with it, and what fills larger ones fills smaller ones
        low, high = 0, size
        while high - low > max(1, high // 10_000):
            mid = (low + high) // 2
            if solve(mid, False)[1] >= 1 - 1e-6:
                low = mid
            else:
                high = mid
        size = low
    got, _ = solve(size, True)
    return {(pats[i], names[j]): int(got[i, j]) for i, j in zip(*(z.tolist() for z in np.nonzero(got)))}


def select_mix(docs: DataFrame, key: str, text: str, source: str, targets: DataFrame, *, seed: int = 42, total: int | None = None, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, source, uses, tokens) of the selected documents: ``tokens`` of one use. A text that a source has in several
    documents is one unit there and is given by the least key."""
    want = {r["source"]: (float(r["target_share"] or 0), int(r["max_repeat"] or 0)) for r in targets.select("source", "target_share", "max_repeat").dropna(subset=["source"]).collect()}
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{source}`").alias("source"))
    rows = rows.filter((F.length("text") > 0) & F.col("source").isin(*want))
    counted = spread(rows).select("key", "source", F.md5("text").alias("unit"), token_count(F.col("text"), folder, vocabulary).alias("tokens"))
    per_source = counted.groupBy("unit", "source").agg(F.min("key").alias("key"), F.max("tokens").alias("tokens"))
    units = cut_lineage(
        per_source.groupBy("unit").agg(F.sort_array(F.collect_set("source")).alias("pattern"), F.max("tokens").alias("tokens"), F.map_from_entries(F.collect_list(F.struct("source", "key"))).alias("keys"))
        .withColumn("place", F.xxhash64("unit", F.lit(seed)))
    )
    sizes = units.groupBy("pattern").agg(F.sum("tokens").alias("tokens")).collect()
    patterns = {tuple(r["pattern"]): int(r["tokens"]) for r in sizes}
    taken = route(patterns, want, total)

    arcs, spot = [], {}
    for (p, s), n in sorted(taken.items()):
        arcs.append((list(p), s, spot.get(p, 0), n, patterns[p]))
        spot[p] = spot.get(p, 0) + n
    arc = docs.sparkSession.createDataFrame(arcs, "pattern array<string>, source string, start bigint, size bigint, whole bigint")
    arc = F.broadcast(arc) if len(patterns) <= MAX_PATTERNS else arc

    # where a unit starts on its pattern's circle: the tokens of the buckets before, and of its bucket before it
    bucket = F.shiftrightunsigned(F.col("place"), 48)
    placed = units.withColumn("bucket", bucket)
    sums = placed.groupBy("pattern", "bucket").agg(F.sum("tokens").alias("n"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("pattern", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("pattern", "bucket").orderBy("place", "unit").rowsBetween(Window.unboundedPreceding, -1)
    at = placed.withColumn("c", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(offsets, ["pattern", "bucket"]).withColumn("c", F.col("c") + F.col("ahead"))

    def passes(end):
        return F.floor((end - 1 - F.col("c")) / F.col("whole"))

    used = at.join(arc, "pattern").withColumn("uses", passes(F.col("start") + F.col("size")) - passes(F.col("start"))).filter("uses > 0 and tokens > 0")
    return used.select(F.element_at("keys", F.col("source")).alias(key), "source", F.col("uses").cast("int").alias("uses"), "tokens")


def shares(selected: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source named in the targets: target and actual share, tokens with repetition, documents."""
    by = selected.groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("tokens"), F.count(F.lit(1)).alias("documents"))
    whole = by.agg(F.sum("tokens").alias("whole"))
    joined = targets.select("source", "target_share", "max_repeat").join(by, "source", "left").join(F.broadcast(whole), F.lit(True), "left")
    tokens = F.coalesce("tokens", F.lit(0))
    return joined.select("source", "target_share", "max_repeat", tokens.alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce(tokens / F.col("whole"), F.lit(0.0)).alias("actual_share"))
