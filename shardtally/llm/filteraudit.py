"""Filter interaction audit by count-weighted decision diagrams.

Every document has a failure mask, one bit a filter. Spark counts the masks per part; of each part an
ordered diagram is made whose levels test one filter each and whose edges carry how many documents
(all, good, toxic) go that way. What filters do in an order is read off its all-pass path: the
fail edge that leaves the path at a level holds what that step removes, the pass edge what it
keeps. Another order is reached by swapping neighbouring levels, which touches the nodes of these
two levels only; all orders are visited with one swap from each to the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardtally.sources.workspace import stored

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
_BREAK = r"[\x20\x09-\x0D]+"
AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
)

#: A node is its weight (documents, good, toxic) with its pass and fail children; a leaf has none.
Weight = tuple[int, int, int]


class Node:
    __slots__ = ("weight", "passed", "failed")

    def __init__(self, weight: Weight, passed: Node | None = None, failed: Node | None = None):
        self.weight, self.passed, self.failed = weight, passed, failed


class Diagram:
    """A part's masks, tested in an order that neighbour swaps change.

    Nodes are shared: equal weights and equal children are one node. Nothing stands below an edge
    that no document takes (None).
    """

    def __init__(self, masks: dict[int, Weight], filters: int = len(FILTERS)):
        self.order = list(range(filters))
        self.unique: dict[tuple, Node] = {}
        self.root = self._built(masks, 0)

    def _node(self, weight: Weight, passed: Node | None, failed: Node | None) -> Node:
        key = (weight, passed and id(passed), failed and id(failed))
        if key not in self.unique:
            self.unique[key] = Node(weight, passed, failed)
        return self.unique[key]

    def _joined(self, passed: Node | None, failed: Node | None) -> Node | None:
        if passed is None and failed is None:
            return None
        weight = tuple(sum(x) for x in zip(*(n.weight for n in (passed, failed) if n is not None)))
        return self._node(weight, passed, failed)

    def _built(self, masks: dict[int, Weight], level: int) -> Node | None:
        if not masks:
            return None
        if level == len(self.order):
            return self._node(tuple(sum(x) for x in zip(*masks.values())), None, None)
        bit = 1 << self.order[level]
        passed, failed = ({m: w for m, w in masks.items() if bool(m & bit) == fails} for fails in (False, True))
        return self._joined(self._built(passed, level + 1), self._built(failed, level + 1))

    def swap(self, level: int) -> None:
        """Exchanges the tests of ``level`` and the next one; what lies below is kept as it is."""
        made: dict[int, Node] = {}

        def turned(node: Node | None) -> Node | None:
            if node is None:
                return None
            if id(node) not in made:
                a, b = node.passed, node.failed
                passed = self._joined(a and a.passed, b and b.passed)
                failed = self._joined(a and a.failed, b and b.failed)
                made[id(node)] = self._node(node.weight, passed, failed)
            return made[id(node)]

        def down(node: Node | None, at: int) -> Node | None:
            """Only nodes above the swapped levels have to be made again."""
            if node is None or at == level:
                return turned(node)
            return self._node(node.weight, down(node.passed, at + 1), down(node.failed, at + 1))

        self.root = down(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[Weight, Weight]]:
        """(kept, removed) of each level of the all-pass path."""
        out, node = [], self.root
        for _ in self.order:
            kept, removed = (node and node.passed), (node and node.failed)
            out.append((kept.weight if kept else (0, 0, 0), removed.weight if removed else (0, 0, 0)))
            node = kept
        return out


def neighbour_swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after the other, so that all orders of ``n`` are visited once (plain changes)."""
    places, way = list(range(n)), [-1] * n
    while True:
        mobile = -1
        for i, value in enumerate(places):
            j = i + way[value]
            if 0 <= j < n and places[j] < value and (mobile < 0 or value > places[mobile]):
                mobile = i
        if mobile < 0:
            return
        value = places[mobile]
        j = mobile + way[value]
        places[mobile], places[j] = places[j], value
        for other in range(value + 1, n):
            way[other] = -way[other]
        yield min(mobile, j)


def audit_of(masks: dict[int, Weight], filters: str = FILTERS) -> pd.DataFrame:
    """All orders and steps of one part."""
    diagram = Diagram(masks, len(filters))
    seen = {tuple(diagram.order): diagram.steps()}
    for level in neighbour_swaps(len(filters)):
        diagram.swap(level)
        seen[tuple(diagram.order)] = diagram.steps()
    fails = [sum(w[0] for m, w in masks.items() if m >> f & 1) for f in range(len(filters))]
    alone = [masks.get(1 << f, (0, 0, 0))[0] for f in range(len(filters))]
    shapley = [0] * len(filters)
    for order, steps in seen.items():
        for f, (_, removed) in zip(order, steps):
            shapley[f] += removed[0]
    rows = []
    for order in permutations(range(len(filters))):
        name = "".join(filters[f] for f in order)
        for step, (f, (kept, removed)) in enumerate(zip(order, seen[order]), 1):
            rows.append((name, step, kept[0], removed[0], fails[f] - removed[0], alone[f], removed[1], removed[2], shapley[f]))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in AUDIT.split(", ")[1:]])


def failures(text: Column) -> Column:
    """Bits of the filters A to D on a text that is not null."""
    words = F.filter(F.split(text, _BREAK), lambda w: w != "")
    n = F.size(words)
    conditions = [
        n < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * n,
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > MOST_CAPITALS * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0)).alias("_mask")


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents per part and failure mask.

    Filter E asks whether a smaller id has the same text, by its SHA-256 digest. Rows are reduced to ids,
    digests and masks before anything is shuffled, and stored, since they are read twice. Each digest's smallest id comes from a pre-aggregated
    minimum, and meets its rows by digest and id together, so a text that a third of all rows share is
    no hot key.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("_text"))
    rows = rows.select("_id", "part", F.unhex(F.sha2("_text", 256)).alias("_digest"), failures(F.col("_text")))
    rows = stored(rows.groupBy("_id", "part", "_digest", "_mask").agg(F.count("*").alias("n")), "masks")  # repeated rows as one
    smallest = rows.groupBy("_digest").agg(F.min("_id").alias("_least"))
    first = smallest.select(F.col("_digest").alias("_d"), "_least")
    rows = rows.join(first, (F.col("_digest") == F.col("_d")) & F.col("_id").eqNullSafe(F.col("_least")), "left")
    later = F.when(F.col("_d").isNull(), 1 << 4).otherwise(0)
    flags = [F.max(F.coalesce(F.col(c).cast("int") == 1, F.lit(False))).cast("long").alias(f"_{c}") for c in ("quality", "toxic")]
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_label_id")).agg(*flags)
    rows = rows.join(known, F.col("_id") == F.col("_label_id"), "left")
    sums = [F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(name) for c, name in (("_quality", "good"), ("_toxic", "toxic"))]
    return rows.groupBy("part", (F.col("_mask") + later).alias("mask")).agg(F.sum("n").alias("n"), *sums)


def _audits(frame: pd.DataFrame) -> pd.DataFrame:
    weights = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(frame["mask"], frame["n"], frame["good"], frame["toxic"])}
    out = audit_of(weights)
    out.insert(0, "part", frame["part"].iloc[0])
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, per part (``docs``: doc_id, text, source; ``labels``: doc_id, quality, toxic).

    Null texts count as empty, null sources as the part ``''``. A null id is not smaller than any other:
    such a row fails E only where some id that is not null has its text. Repeated rows are documents of
    their own with one id, so they don't fail E through one another. Of repeated labels one that says 1
    is enough; null labels say nothing. Other columns are not looked at; an empty table gives an empty result.
    """
    return masks(docs, labels).groupBy("part").applyInPandas(_audits, AUDIT)
