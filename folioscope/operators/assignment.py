"""The heaviest one-to-one assignment by auction, with the bids, winners and prices of each round as tables.

Gold and predicted rows are the nodes of a group, and each node bids for one node: a candidate's other end at the candidate's weight, or itself at 0, which
leaves it unmatched. Seen this way every node gets exactly one node, both directions of a candidate are edges, and the heaviest
permutation takes the heaviest matching twice, so prices may be kept from one phase to the next. Weights are whole numbers, multiplied by the number of
nodes + 1: an auction that ends with steps of 1 is exact.

Of each node on a group's smaller side only the best candidates count, as many as that side has nodes: the others of the side take
at most all but one of them, so a heaviest assignment can do without the rest.

A group of at most ``WHOLE_EDGES`` edges that are left is settled by one task. The bidders of a larger one are dealt to blocks of ``BLOCK_EDGES``: in a round each block bids
until its own bidders are content, each node goes to the highest bid of all blocks, and who was outbid bids again. A bid made at prices that have risen since
stays a valid one, as risen prices only make the bidder's other choices worse.

Where a score falls with the distance of two values, no candidates are written down (``matches_by_distance``): shortest augmenting paths, one for each node of the
smaller side, in which a node looks no further than the nearest free node to either side, as whatever lies beyond is worse and no nearer to an end.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from .graph import saved

#: Edges of a group in one task (some 30 bytes each), and of a block; decimals of a score that count; how much smaller the steps of each phase are; the weight of a pair beside its score.
WHOLE_EDGES, BLOCK_EDGES, DIGITS, SHRINK, PAIR = 24_000_000, 200_000, 6, 40, 1000


def settle(first: np.ndarray, node: np.ndarray, value: np.ndarray, price: np.ndarray, owner: np.ndarray, held: np.ndarray, step: int) -> None:
    """Bid until each bidder holds a node. Bidder i's edges are ``first[i] : first[i + 1]``; ``owner`` is -1 for none and -2 for a bidder elsewhere."""
    waiting = deque(np.flatnonzero(held < 0).tolist())
    while waiting:
        i = waiting.popleft()
        nodes = node[first[i] : first[i + 1]]
        net = value[first[i] : first[i + 1]] - price[nodes]
        best = int(net.argmax())
        top = int(net[best])
        net[best] = np.iinfo(np.int64).min
        second = int(net.max()) if len(net) > 1 else top
        j = nodes[best]
        price[j] += top - second + step
        before = owner[j]
        if before >= 0:
            held[before] = -1
            waiting.append(int(before))
        owner[j], held[i] = i, j


def _coded(edges: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bidders, nodes, first, node, value): edges sorted by bidder and node, so that equal input gives equal bids."""
    edges = edges.sort_values(["bidder", "node"])
    bidders, first = np.unique(edges["bidder"].to_numpy(), return_index=True)
    nodes, node = np.unique(edges["node"].to_numpy(), return_inverse=True)
    return bidders, nodes, np.append(first, len(edges)), node, edges["value"].to_numpy(np.int64)


def _steps(top: int) -> list[int]:
    """The steps of the phases, down to 1."""
    out = [max(1, top // SHRINK)]
    while out[-1] > 1:
        out.append(max(1, out[-1] // SHRINK))
    return out


def _whole_group(group: str):
    def run(pairs: pa.Table) -> pa.Table:
        names, codes = {}, {}
        for side in ("gold", "predicted"):
            coded = pairs.column(side).combine_chunks().dictionary_encode()
            # nodes in their own order, so that equal input gives equal bids
            order = np.asarray(pc.sort_indices(coded.dictionary))
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            names[side], codes[side] = coded.dictionary.take(pa.array(order)), rank[np.asarray(coded.indices)]
        n, m = len(names["gold"]), len(names["predicted"])
        w = np.asarray(pairs.column("w")) * (n + m + 1)
        key = pairs.column(group)[0]
        del pairs, coded
        # each side's candidates, and itself at 0
        bidder = np.concatenate([codes["gold"], codes["predicted"] + n, np.arange(n + m, dtype=np.int32)]).astype(np.int32)
        node = np.concatenate([codes["predicted"] + n, codes["gold"], np.arange(n + m, dtype=np.int32)]).astype(np.int32)
        order = np.lexsort((node, bidder))
        first = np.searchsorted(bidder, np.arange(n + m + 1), sorter=order)
        del bidder, codes
        node, value = node[order], np.concatenate([w, w, np.zeros(n + m, np.int64)])[order]
        top = int(w.max())
        del w, order
        price, held = np.zeros(n + m, np.int64), np.full(n + m, -1)
        for step in _steps(top):
            held[:] = -1
            settle(first, node, value, price, np.full(n + m, -1), held, step)
        mine = np.flatnonzero(held[:n] >= n)
        return pa.table({group: pa.array([key.as_py()] * len(mine), key.type), "gold": names["gold"].take(pa.array(mine)), "predicted": names["predicted"].take(pa.array(held[mine] - n))})

    return run


def _block_bids(group: str, phase: int):
    def run(edges: pd.DataFrame, shown: pd.DataFrame) -> pd.DataFrame:
        bidders, nodes, first, node, value = _coded(edges)
        shown = shown.set_index("_node").reindex(nodes)
        price, who = shown["price"].to_numpy(np.int64).copy(), shown["owner"]
        mine = pd.Series(np.arange(len(bidders)), bidders)
        owner = np.where(who.isna(), -1, who.map(mine).fillna(-2)).astype(np.int64)
        held = np.full(len(bidders), -1)
        at = np.flatnonzero(owner >= 0)
        held[owner[at]] = at
        steps = _steps(int(edges["top"].iloc[0]))
        settle(first, node, value, price, owner, held, steps[min(phase, len(steps) - 1)])
        return pd.DataFrame({group: edges[group].iloc[0], "node": nodes[held], "price": price[held], "owner": bidders})

    return run


def _weight() -> Column:
    return F.round((F.lit(PAIR) + F.col("score")) * 10**DIGITS).cast("long")


def _edges(best: DataFrame, group: str, block_edges: int) -> DataFrame:
    """(group, bidder, node, value, top, block, blocks): both directions of each candidate, and each node to itself."""
    one = best.select(group, F.concat(F.lit("g"), "gold").alias("bidder"), F.concat(F.lit("p"), "predicted").alias("node"), _weight().alias("w"))
    other = one.select(group, F.col("node").alias("bidder"), F.col("bidder").alias("node"), "w")
    both = one.unionByName(other)
    every = both.unionByName(both.select(group, "bidder", F.col("bidder").alias("node"), F.lit(0).cast("long").alias("w")).distinct())
    size = every.groupBy(group).agg(F.count(F.lit(1)).alias("edges"), F.count_if(F.col("bidder") == F.col("node")).alias("nodes"), F.max("w").alias("top"))
    blocks = F.ceil(F.col("edges") / block_edges).cast("int")
    scale = F.col("nodes") + 1
    out = every.join(size, group).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("bidder"), F.col("blocks")).cast("int"))
    return out.select(group, "bidder", "node", (F.col("w") * scale).alias("value"), (F.col("top") * scale).alias("top"), "block", "blocks")


def _by_rounds(wide: DataFrame, group: str) -> DataFrame:
    """(group, node, owner) of groups that are dealt to blocks."""
    kind = dict(wide.dtypes)[group]
    asked = saved(wide.select(group, "node", "block").distinct())
    state = saved(wide.select(group, "node").distinct().select(group, "node", F.lit(0).cast("long").alias("price"), F.lit(None).cast("string").alias("owner")))
    bidders = state.count()
    for phase in range(len(_steps(wide.agg(F.max("top")).first()[0]))):
        state = state.withColumn("owner", F.lit(None).cast("string"))
        content = 0
        while content < bidders:
            shown = state.join(asked, [group, "node"]).select(F.col(group).alias("_group"), F.col("block").alias("_block"), F.col("node").alias("_node"), "price", "owner")
            bids = wide.groupBy(group, "block").cogroup(shown.groupBy("_group", "_block")).applyInPandas(_block_bids(group, phase), f"{group} {kind}, node string, price long, owner string")
            every = bids.unionByName(state.select(group, "node", "price", "owner"))
            top = F.max(F.struct("price", "owner"))
            old, state = state, saved(every.groupBy(group, "node").agg(top.alias("x")).select(group, "node", "x.price", "x.owner"))
            content = state.where("owner is not null").count()
            old.unpersist()
    return state.select(group, "node", "owner")


def _best(rows: DataFrame, group: str) -> DataFrame:
    """(group, gold, predicted, score): of repeated candidates the best, and of each node on the group's smaller side as many as that side has nodes."""
    sizes = rows.groupBy(group).agg(F.countDistinct("gold").alias("_g"), F.countDistinct("predicted").alias("_p"))
    turned = F.col("_g") < F.col("_p")
    few = rows.join(F.broadcast(sizes), group).withColumn("_few_g", F.when(turned, F.col("gold"))).withColumn("_few_p", F.when(~turned, F.col("predicted")))
    few = few.select(group, "_few_g", "_few_p", "gold", "predicted", "score", F.least("_g", "_p").alias("_most"))
    # one shuffle by the smaller side's nodes, for the best of repeats and for the ranks
    keys = [group, "_few_g", "_few_p"]
    once = few.repartition(*keys).groupBy(*keys, "gold", "predicted", "_most").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "gold", "predicted"))
    return once.withColumn("_rank", rank).where("_rank <= _most").select(group, "gold", "predicted", "score")


def optimal_matches(candidates: DataFrame, group: str, block_edges: int | None = None) -> DataFrame:
    """Most pairs first, then the highest total score: (group, gold, predicted, score) candidates, one assignment a group.

    Scores count to ``DIGITS`` decimals, within 0 and ``PAIR``. Of repeated candidates the best counts; a row with a null in any of the four columns is no candidate. Among
    assignments of equal weight, one of them. Weights times nodes stay within a long up to some 10^5 nodes a group. Groups beyond ``block_edges``, where it is given, go by blocks of that size.
    """
    kinds = dict(candidates.dtypes)
    rows = candidates.select(F.col(group), F.col("gold"), F.col("predicted"), F.col("score").cast("double").alias("score")).dropna()
    best = saved(_best(rows, group))
    wide = best.groupBy(group).agg((2 * F.count(F.lit(1)) + F.countDistinct("gold") + F.countDistinct("predicted")).alias("_edges")).where(F.col("_edges") > (block_edges or WHOLE_EDGES)).select(group)
    wide = [r[0] for r in wide.collect()]
    large = F.col(group).isin(wide) if wide else F.lit(False)
    pairs = best.where(~large).select(group, "gold", "predicted", _weight().alias("w"))
    found = pairs.groupBy(group).applyInArrow(_whole_group(group), f"{group} {kinds[group]}, gold {kinds['gold']}, predicted {kinds['predicted']}")
    out = found.join(best, [group, "gold", "predicted"]).select(group, "gold", "predicted", "score")
    if not wide:
        return out
    settled = _by_rounds(saved(_edges(best.where(large), group, block_edges or BLOCK_EDGES)), group)
    plain = lambda c: F.substring(c, 2, 1 << 30)
    taken = settled.where("owner like 'g%' and node like 'p%'").select(group, plain(F.col("owner")).alias("_gold"), plain(F.col("node")).alias("_predicted"))
    named = best.withColumn("_gold", F.col("gold").cast("string")).withColumn("_predicted", F.col("predicted").cast("string"))
    return out.unionByName(taken.join(named, [group, "_gold", "_predicted"]).select(group, "gold", "predicted", "score"))


def nearest_assignment(few: list[np.ndarray], values: np.ndarray, node: np.ndarray, score: Callable[[np.ndarray], np.ndarray], least: float) -> np.ndarray:
    """The node of each of ``few``, or -1: most pairs, then the highest total of ``score``(distance), which never rises with distance and counts from ``least``.

    ``few`` has the values of each node of the smaller side, mostly one; ``values``, in order, and ``node`` those of the other side. Memory grows with both sides, not with pairs.
    """
    n, m, none = len(few), len(values), np.iinfo(np.int64).max
    pair = max(PAIR, n + 1)  # one more pair is worth more than all scores
    order = np.argsort(node, kind="stable")
    begin = np.searchsorted(node[order], np.arange(int(node.max(initial=-1)) + 2))
    u, v, match, slot = [0] * n, np.zeros(m, np.int64), [-1] * (len(begin) - 1), [-1] * n
    key, via = np.full(m, none), np.zeros(m, np.int64)
    # the next free place at or beyond each, with one more at either end
    above, below = list(range(m + 1)), list(range(m + 1))

    def free(to: list[int], k: int) -> int:
        end = k
        while to[end] != end:
            end = to[end]
        while to[k] != end:
            to[k], k = end, to[k]
        return end

    places = [np.searchsorted(values, x).tolist() for x in few]
    for start in range(n):
        i, base, scanned, passed, lo, hi, done = start, 0, [], [], m, 0, None
        dummy, last = none, -1
        while True:
            scanned.append((i, base))
            if base - u[i] < dummy:
                dummy, last = base - u[i], i
            for x, k in zip(few[i].tolist(), places[i], strict=True):
                a, b = max(free(below, k) - 1, 0), min(free(above, k) + 1, m)
                s = score(np.abs(values[a:b] - x))
                cost = base - u[i] - np.floor((pair + s) * 10**DIGITS + 0.5).astype(np.int64) - v[a:b]
                cost[~(s >= least)] = none
                nearer = cost < key[a:b]
                if done is not None:
                    nearer &= ~done[a:b]
                key[a:b][nearer], via[a:b][nearer] = cost[nearer], i
                lo, hi = min(lo, a), max(hi, b)
            j = lo + int(key[lo:hi].argmin()) if hi > lo else -1
            end = int(key[j]) if j >= 0 else none
            if end > dummy:
                end, j = dummy, -1
                break
            if match[node[j]] < 0:
                break
            if done is None:
                done = np.zeros(m, bool)
            mine = order[begin[node[j]] : begin[node[j] + 1]]
            passed.append((mine, end, j))
            key[mine], done[mine] = none, True
            i, base = match[node[j]], end
        for i, base in scanned:
            u[i] += end - base
        for mine, base, _ in passed:
            v[mine] -= end - base
        # along the path each node takes the place it was reached for, back to the one that began
        if j >= 0:
            for k in order[begin[node[j]] : begin[node[j] + 1]].tolist():
                above[k], below[k + 1] = k + 1, k
            i = int(via[j])
        else:
            i = last
        while True:
            before, slot[i] = slot[i], j
            if j >= 0:
                match[node[j]] = i
            if i == start:
                break
            j = next(q for mine, _, q in passed if node[q] == node[before])
            i = int(via[j])
        if hi > lo:
            key[lo:hi] = none
            for mine, _, _ in passed:
                key[mine] = none
    return np.array([-1 if j < 0 else node[j] for j in slot], np.int64)


def _by_distance(group: str, score: Callable[[np.ndarray], np.ndarray], least: float, schema: pa.Schema):
    def run(golds: pa.Table, predicted: pa.Table) -> pa.Table:
        if not golds.num_rows or not predicted.num_rows:
            return schema.empty_table()
        sides = []
        for side, name in ((golds, "gold"), (predicted, "predicted")):
            side = side.sort_by([("at", "ascending"), (name, "ascending")])
            coded = side.column(name).combine_chunks().dictionary_encode()
            node, at = np.asarray(coded.indices, np.int64), np.asarray(side.column("at"))
            by = np.argsort(node, kind="stable")
            sides.append((coded.dictionary, node, at, np.split(at[by], np.searchsorted(node[by], np.arange(1, len(coded.dictionary))))))
        turned = len(sides[0][0]) > len(sides[1][0])
        small, large = sides[::-1] if turned else sides
        found = nearest_assignment(small[3], large[2], large[1], score, least)
        mine = np.flatnonzero(found >= 0)
        scores = [float(score(np.abs(small[3][i][:, None] - large[3][j][None, :])).max()) for i, j in zip(mine.tolist(), found[mine].tolist(), strict=True)]
        names = [small[0].take(pa.array(mine)), large[0].take(pa.array(found[mine]))]
        gold, other = names[::-1] if turned else names
        key = golds.column(group)[0].as_py()
        return pa.table([pa.array([key] * len(mine), schema.field(0).type), gold, other, pa.array(scores, pa.float64())], schema=schema)

    return run


def matches_by_distance(gold: DataFrame, predicted: DataFrame, group: str, score: Callable[[np.ndarray], np.ndarray], least: float) -> DataFrame:
    """As ``optimal_matches``, where a pair's score is ``score``(distance of their values ``at``), never rising with distance, and those of ``least`` or more are candidates.

    ``gold`` has (group, gold, at), ``predicted`` (group, predicted, at). Rows with a null, and values that are not finite, are no candidates; of an id with many values the best counts. A group's ids
    and values stand in one task, its pairs nowhere.
    """
    side = lambda df, name: df.select(group, name, F.col("at").cast("double").alias("at")).dropna().where("abs(at) < double('Infinity')").distinct()
    a, b = side(gold, "gold"), side(predicted, "predicted")
    kinds = dict(a.dtypes) | dict(b.dtypes)
    shape = StructType([a.schema[group], a.schema["gold"], b.schema["predicted"], StructField("score", DoubleType())])
    return a.groupBy(group).cogroup(b.groupBy(group)).applyInArrow(_by_distance(group, score, least, to_arrow_schema(shape)), f"{group} {kinds[group]}, gold {kinds['gold']}, predicted {kinds['predicted']}, score double")
