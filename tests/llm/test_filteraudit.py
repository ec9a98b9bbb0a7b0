"""Decision diagrams against direct counting; masks of odd rows; the whole query by brute force."""

import math
import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from shardtally.llm import filteraudit
from shardtally.llm.common import ship, table
from shardtally.llm.filteraudit import FILTERS, Diagram, audit_of, neighbour_swaps

LARGE = 2**60


def steps_of(masks, order):
    """(kept, removed) of each step by going through all masks."""
    out, left = [], dict(masks)
    for f in order:
        gone = {m: w for m, w in left.items() if m >> f & 1}
        left = {m: w for m, w in left.items() if not m >> f & 1}
        out.append(tuple(tuple(sum(w[i] for w in x.values()) for i in range(3)) for x in (left, gone)))
    return out


def some_masks(rng, filters=5):
    n = rng.randrange(0, 2**filters + 1)
    return {m: (rng.randrange(1, 50), rng.randrange(3), rng.randrange(3)) for m in rng.sample(range(2**filters), n)}


def brute_rows(masks):
    fails = [sum(w[0] for m, w in masks.items() if m >> f & 1) for f in range(5)]
    shapley = [0] * 5
    rows = []
    for order in permutations(range(5)):
        for f, (_, removed) in zip(order, steps_of(masks, order)):
            shapley[f] += removed[0]
    for order in permutations(range(5)):
        for step, (f, (kept, removed)) in enumerate(zip(order, steps_of(masks, order)), 1):
            alone = masks.get(1 << f, (0, 0, 0))[0]
            rows.append(("".join(FILTERS[g] for g in order), step, kept[0], removed[0], fails[f] - removed[0], alone, removed[1], removed[2], shapley[f]))
    return rows


def test_neighbour_swaps_visit_every_order_once():
    for n in range(1, 7):
        order, seen = list(range(n)), [tuple(range(n))]
        for level in neighbour_swaps(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.append(tuple(order))
        assert len(seen) == len(set(seen)) == math.factorial(n)


def test_swapped_diagrams_equal_built_ones():
    rng = random.Random(1)
    for _ in range(30):
        masks = some_masks(rng)
        diagram = Diagram(masks)
        for _ in range(25):
            diagram.swap(rng.randrange(4))
            assert diagram.steps() == steps_of(masks, diagram.order)


def test_a_swap_leaves_what_lies_below():
    masks = {m: (1 + m, 0, 0) for m in range(32)}
    diagram = Diagram(masks)
    before = diagram.root.passed.passed.failed
    diagram.swap(0)
    assert diagram.root.passed.passed.failed is before


def test_audit_of_random_masks():
    rng = random.Random(2)
    for masks in [{}, {0: (3, 1, 0)}, *(some_masks(rng) for _ in range(8))]:
        assert list(audit_of(masks).itertuples(index=False, name=None)) == brute_rows(masks)


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    bad = {i for i, _, t in labels if i is not None and t == 1}
    parts = {}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            text in least and (i is None or i > least[text]),
        ]
        mask = sum(1 << k for k, x in enumerate(fails) if x)
        masks = parts.setdefault(source or "", {})
        n, g, t = masks.get(mask, (0, 0, 0))
        masks[mask] = (n + 1, g + (i in good), t + (i in bad))
    return sorted((part, *row) for part, masks in parts.items() for row in brute_rows(masks))


def test_odd_rows(spark):
    ship(spark)
    prose = " ".join(f"w{i}" for i in range(60))
    docs = [(1, prose, "s"), (2, prose, None), (LARGE + 1, prose + " é", ""), (LARGE + 2, prose + " é", "s"), (None, prose, "s"), (None, "only null ids", "s")]
    docs += [(None, "only null ids", "s"), (3, None, "s"), (4, "", "t"), (5, "A" * 300_000, "t"), (6, "a b " * 200_000, "t"), (1, prose, "s"), (7, "x\x0by\x85z\xa0#", "s")]
    labels = [(1, 1, 0), (1, 0, None), (LARGE + 2, 1, 1), (LARGE + 2, 1, 1), (None, 1, 1), (5, None, 1), (99, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("part", F.lit(1)).withColumn("mask", F.lit("x"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    rows = filteraudit.audit(frame, marks)
    assert sorted(map(tuple, rows.collect())) == brute_audit(docs, labels)
    assert filteraudit.audit(frame.limit(0), marks).count() == 0
    assert filteraudit.audit(frame, marks.limit(0)).agg(F.sum("good_lost"), F.sum("kept")).first()[0] == 0


def test_whole_table(spark):
    from shardtally.llm.queries import op13_filter_audit

    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text, r.source) for r in table(spark, folder, "documents").collect()]
    labels = [tuple(r) for r in table(spark, folder, "labels").select("doc_id", "quality", "toxic").collect()]
    assert sorted(map(tuple, op13_filter_audit(spark, folder).collect())) == brute_audit(docs, labels)
