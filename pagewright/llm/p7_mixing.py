"""Problem 7: documents drawn from overlapping sources so that each source holds its target share of the tokens.

A text that stands in several sources can be counted for any of them. Texts are grouped by the set of sources
they stand in, their tokens added up, and the tokens routed from these patterns to the sources' quotas by
min-cost flow, where the second use of a text costs more than the first and the third more than the second.
The network has a node per pattern and source, none per document. Documents are then picked in seeded order, by one rule
at every size: the texts of a pattern are hashed into buckets of about BUCKET_TEXTS, the routes of a pattern take their
stretches of the circle of its buckets, a bucket wholly inside a stretch is taken in SQL, and a bucket in which
one begins or ends is filled text by text, passing over texts that no longer fit.
"""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import checkpointed
from .tokens import TOKENIZER, token_counts

SEED = 42
#: Texts of a pattern that share a bucket, which one task fills.
BUCKET_TEXTS = 2000
#: Most patterns of sources that the driver's network takes; more are refused, not cut.
MAX_PATTERNS = 1_000_000
MIX = "source string, doc_id long, repeats int, n_tokens long"


class MinCostFlow:
    """A network with whole capacities and small whole costs: for each distance of the sink in turn, as much as possible
    over all shortest paths at once."""

    def __init__(self) -> None:
        self.ends: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []
        self.arcs: list[list[int]] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        while len(self.arcs) <= max(a, b):
            self.arcs.append([])
        for start, end, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.arcs[start].append(len(self.ends))
            self.ends.append(end)
            self.room.append(r)
            self.cost.append(c)
        return len(self.ends) - 2

    def _distances(self, source: int) -> list[float]:
        far = [math.inf] * len(self.arcs)
        far[source] = 0
        waiting, queued = deque([source]), {source}
        while waiting:
            a = waiting.popleft()
            queued.discard(a)
            for i in self.arcs[a]:
                b = self.ends[i]
                if self.room[i] and far[a] + self.cost[i] < far[b]:
                    far[b] = far[a] + self.cost[i]
                    if b not in queued:
                        queued.add(b)
                        waiting.append(b)
        return far

    def _levels(self, source: int, far: list[float]) -> list[int]:
        level = [-1] * len(self.arcs)
        level[source] = 0
        waiting = deque([source])
        while waiting:
            a = waiting.popleft()
            for i in self.arcs[a]:
                b = self.ends[i]
                if self.room[i] and level[b] < 0 and far[a] + self.cost[i] == far[b]:
                    level[b] = level[a] + 1
                    waiting.append(b)
        return level

    def _push(self, source: int, sink: int, far: list[float], level: list[int]) -> int:
        """What can be sent over arcs of shortest paths that lead one level on, until each such path has a full arc."""
        sent, at, path = 0, [0] * len(self.arcs), []
        a = source
        while True:
            if a == sink:
                amount = min(self.room[i] for i in path)
                sent += amount
                for i in path:
                    self.room[i] -= amount
                    self.room[i ^ 1] += amount
                back = next(k for k, i in enumerate(path) if not self.room[i])
                a = self.ends[path[back] ^ 1]
                del path[back:]
                continue
            while at[a] < len(self.arcs[a]):
                i = self.arcs[a][at[a]]
                b = self.ends[i]
                if self.room[i] and level[b] == level[a] + 1 and far[a] + self.cost[i] == far[b]:
                    break
                at[a] += 1
            else:
                if not path:
                    return sent
                a = self.ends[path.pop() ^ 1]
                at[a] += 1
                continue
            path.append(i)
            a = b

    def send(self, source: int, sink: int) -> int:
        """As much as possible, at the least cost; the amount sent."""
        sent = 0
        while len(self.arcs) > max(source, sink) and math.isfinite((far := self._distances(source))[sink]):
            while (level := self._levels(source, far))[sink] >= 0:
                sent += self._push(source, sink, far, level)
        return sent

    def used(self, arc: int) -> int:
        return self.room[arc ^ 1]


def routes(patterns: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], total: float) -> dict[tuple[tuple[str, ...], str], int]:
    """Tokens that each pattern of sources gives to each source so that source s gets shares[s] x total or what
    it can, with as few repetitions as possible."""
    net, sources = MinCostFlow(), sorted(shares)
    place = {s: i + 2 for i, s in enumerate(sources)}
    out = {}
    for k, (pattern, tokens) in enumerate(sorted(patterns.items())):
        node = len(sources) + 2 + k
        for use in range(max((repeats[s] for s in pattern), default=0)):  # convex: use 0 is free, later ones dearer
            net.arc(0, node, tokens, 2 * use)
        for s in pattern:  # a source's own texts come first: those it shares are few, and whole texts fit worse
            out[pattern, s] = net.arc(node, place[s], tokens * repeats[s], int(len(pattern) > 1))
    for s in sources:
        net.arc(place[s], 1, round(shares[s] * total))
    net.send(0, 1)
    return {k: net.used(i) for k, i in out.items() if net.used(i)}


def reaches(patterns: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], total: float) -> bool:
    """Whether every source can get its share of the total, at whatever cost."""
    net, sources = MinCostFlow(), sorted(shares)
    place = {s: i + 2 for i, s in enumerate(sources)}
    for k, (pattern, tokens) in enumerate(sorted(patterns.items())):
        node = len(sources) + 2 + k
        net.arc(0, node, tokens * max((repeats[s] for s in pattern), default=0))
        for s in pattern:
            if s in place:
                net.arc(node, place[s], tokens * repeats[s])
    quotas = {s: round(shares[s] * total) for s in sources}
    for s in sources:
        net.arc(place[s], 1, quotas[s])
    return net.send(0, 1) == sum(quotas.values())


def largest_total(patterns: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int]) -> int:
    """The most tokens at which every source that has any documents still reaches its share of the total."""
    stocked = {s for pattern, tokens in patterns.items() for s in pattern if tokens > 0}
    wanted = {s: x for s, x in shares.items() if s in stocked and x > 0}
    low, high = 0, sum(t * max((repeats[s] for s in p), default=0) for p, t in patterns.items())
    high = int(high / sum(wanted.values())) + 1 if wanted else 0
    # no source has more than all of its texts give
    own = {s: sum(t * repeats[s] for p, t in patterns.items() if s in p) for s in wanted}
    high = min([high, *(int(own[s] / x) + 1 for s, x in wanted.items())])
    while low < high:
        middle = (low + high + 1) // 2
        if reaches(patterns, wanted, repeats, middle):
            low = middle
        else:
            high = middle - 1
    return low


def _texts(documents: DataFrame, sources: list[str], tokenizer: str) -> DataFrame:
    """(h, n_tokens, pattern, docs): each distinct text with the targeted sources it stands in and its least
    doc_id in each; texts without tokens are left out."""
    kept = documents.where(F.col("doc_id").isNotNull() & F.col("source").isin(sources) & F.col("text").isNotNull())
    hashed = kept.withColumn("h", F.xxhash64("text")).withColumn("size", F.length("text"))
    sized = token_counts(hashed, {"doc_id": "bigint", "source": "string", "h": "bigint", "size": "int"}, tokenizer).where("n_tokens > 0")
    firsts = sized.groupBy("h", "size", "n_tokens", "source").agg(F.min("doc_id").alias("doc_id"))
    grouped = firsts.groupBy("h", "size", "n_tokens").agg(F.sort_array(F.collect_list(F.struct("source", "doc_id"))).alias("docs"))  # at most one entry per source
    return grouped.withColumn("pattern", F.transform("docs", lambda x: x["source"]))


def mixture(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = SEED, tokenizer: str = TOKENIZER) -> DataFrame:
    """(source, doc_id, repeats, n_tokens): the chosen documents with the source they count for, how often they are
    used, and the tokens of one use.

    `total_tokens` is the size of the mixture, by default the largest at which every source that has documents
    reaches its share. Equal texts are one text, which counts for whichever of its sources needs it; no text is
    used more often than the largest max_repeats of its sources, for a source no more often than that source's.
    Sources without documents stay empty, documents of sources without target, null or empty texts and null
    doc_ids or sources are left out; targets with a null source or share, or a share of 0, count as none, a null
    max_repeats as 1; of repeated targets the larger is used. `targets` must be a table of sources, which the
    driver reads."""
    rows = targets.where("source is not null and target_share > 0").groupBy("source").agg(F.max("target_share").alias("share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("repeats")).collect()
    rows = [r for r in rows if r.repeats > 0]
    whole = sum(r.share for r in rows)
    shares, repeats = {r.source: r.share / whole for r in rows}, {r.source: int(r.repeats) for r in rows}
    spark = documents.sparkSession
    if not rows:
        return spark.createDataFrame([], MIX)
    texts = checkpointed(_texts(documents, sorted(shares), tokenizer))
    listed = texts.groupBy("pattern").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("texts")).limit(MAX_PATTERNS + 1).collect()
    if len(listed) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} combinations of sources")
    patterns = {tuple(r.pattern): r.tokens for r in listed}
    if total_tokens is None:
        total_tokens = largest_total(patterns, shares, repeats)
    flows = routes(patterns, shares, repeats, total_tokens)
    if not flows:
        return spark.createDataFrame([], MIX)
    return _drawn(texts, {tuple(r.pattern): r.texts for r in listed}, patterns, flows, repeats, seed)


def fill(sizes: list[int], needs: list[tuple[str, int, int]]) -> list[tuple[int, str, int]]:
    """(text, source, uses): for each need (source, tokens, most uses of a text) texts in their order, passing
    over those that are larger than what is still needed; no text is used for all needs together more often
    than the largest number of uses."""
    uses: dict[tuple[int, str], int] = {}
    all_uses = [0] * len(sizes)
    most = max((n[2] for n in needs), default=0)
    turn = 0
    for source, tokens, times in needs:
        for use in range(times):
            for k in range(len(sizes)):
                i = (turn + k) % len(sizes)
                if sizes[i] <= tokens and uses.get((i, source), 0) == use and all_uses[i] < most:
                    uses[i, source] = use + 1
                    all_uses[i] += 1
                    tokens -= sizes[i]
        turn += len(sizes) // max(1, len(needs))
    return [(i, source, n) for (i, source), n in sorted(uses.items())]


def _drawn(texts: DataFrame, numbers: dict, patterns: dict, flows: dict, repeats: dict[str, int], seed: int) -> DataFrame:
    """The texts that each route takes and how often: all of a pattern's texts as often as its tokens fill, and those in
    its own stretch of the circle of buckets once more."""
    spark = texts.sparkSession
    plan, begins = [], {}
    for (pattern, source), tokens in sorted(flows.items()):
        every, rest = divmod(tokens, patterns[pattern])
        begin = begins.get(pattern, 0)
        begins[pattern] = begin + rest
        plan.append((list(pattern), source, repeats[source], every, begin % patterns[pattern], begin % patterns[pattern] + rest, -(-numbers[pattern] // BUCKET_TEXTS), patterns[pattern]))
    routed = F.broadcast(spark.createDataFrame(plan, "pattern array<string>, source string, most int, every int, begin long, end long, buckets int, all long"))  # routes: at most MAX_PATTERNS times their sources
    hashed = texts.withColumn("u", F.xxhash64("h", "size", F.lit(seed)))
    counts = routed.groupBy("pattern").agg(F.max("buckets").alias("buckets"))
    ordered = hashed.join(F.broadcast(counts), "pattern").withColumn("bucket", F.pmod("u", F.col("buckets").cast("long")).cast("int")).drop("buckets")
    sums = ordered.groupBy("pattern", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("a", F.coalesce(F.sum("tokens").over(before), F.lit(0))).withColumn("b", F.col("a") + F.col("tokens"))  # a row per bucket
    common = lambda lap: F.greatest(F.lit(0), F.least(F.col("b") + lap, F.col("end")) - F.greatest(F.col("a") + lap, F.col("begin")))
    needs = placed.join(routed, "pattern").withColumn("once_more", common(F.lit(0)) + common(F.col("all")))
    needs = needs.where("every > 0 or once_more > 0").select("pattern", "bucket", F.struct("source", "most", "every", "once_more").alias("need"), F.col("once_more").isin(0, F.col("tokens")).alias("whole"))
    needs = needs.groupBy("pattern", "bucket").agg(F.sort_array(F.collect_list("need")).alias("needs"), F.min("whole").alias("whole"), F.count("*").alias("_n")).drop("_n")  # at most a pattern's sources
    each = ordered.join(needs, ["pattern", "bucket"])
    all_of = each.where("whole").select("docs", "n_tokens", F.explode("needs").alias("need")).withColumn("source", F.col("need.source"))
    taken = all_of.select("source", F.filter("docs", lambda x: x["source"] == F.col("source"))[0]["doc_id"].alias("doc_id"), (F.col("need.every") + (F.col("need.once_more") > 0).cast("int")).alias("repeats"), "n_tokens")

    def one(group):
        import pandas as pd

        group = group.sort_values(["u", "h", "size"])
        ids = [{d["source"]: d["doc_id"] for d in docs} for docs in group["docs"]]
        sizes = [int(n) for n in group["n_tokens"]]
        wanted = [(d["source"], int(d["every"]) * sum(sizes) + int(d["once_more"]), int(d["most"])) for d in group["needs"].iloc[0]]
        made = [(source, ids[i][source], n, sizes[i]) for i, source, n in fill(sizes, wanted)]
        return pd.DataFrame(made, columns=["source", "doc_id", "repeats", "n_tokens"])

    cut = each.where("not whole").withColumn("of", F.concat_ws("\x1f", "pattern"))
    return taken.unionByName(cut.groupBy("of", "bucket").applyInPandas(lambda g: one(g), MIX))


def shares_reached(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, documents, tokens, share, most_repeats) of every target, also the empty ones."""
    wanted = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"))
    used = drawn.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("repeats") * F.col("n_tokens")).alias("tokens"), F.max("repeats").alias("most_repeats"))
    total = used.agg(F.sum("tokens").alias("total"))
    out = wanted.join(used, "source", "left").crossJoin(F.broadcast(total))
    return out.select("source", "target_share", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.round(F.coalesce(F.try_divide("tokens", "total"), F.lit(0.0)), 6).alias("share"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"))
