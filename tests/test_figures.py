import itertools
import random
import time

from corvane.operators import ingest


def _joined(a, b, gap, overlap):
    shared = [min(a[k + 2], b[k + 2]) - max(a[k], b[k]) for k in (0, 1)]
    enough = [max(0.0, shared[k]) >= overlap * min(a[k + 2] - a[k], b[k + 2] - b[k]) for k in (0, 1)]
    return min(shared) >= 0 or any(-shared[1 - k] <= gap and enough[k] for k in (0, 1))


def _boxes(n, most, side, r):
    at = [(r.randint(0, most), r.randint(0, most), r.randint(3, side), r.randint(3, side)) for _ in range(n)]
    return [[float(x), float(y), float(x + w), float(y + h)] for x, y, w, h in at]


def test_joined_boxes():
    """The same clusters as comparing all pairs, on sparse and crowded pages, with gaps exactly at the bound."""
    r = random.Random(3)
    for n, most, side in ((0, 10, 5), (1, 10, 5), (60, 1500, 40), (200, 3000, 60), (120, 400, 90)):
        boxes = _boxes(n, most, side, r)
        got = ingest.joined_boxes(boxes, 28, 0.18)
        label = list(range(n))
        for i, j in itertools.combinations(range(n), 2):
            if label[i] != label[j] and _joined(boxes[i], boxes[j], 28, 0.18):
                label = [label[i] if x == label[j] else x for x in label]
        assert len(set(got)) == len(set(label)) == len(set(zip(got, label, strict=True)))


def test_crowded_page():
    boxes = _boxes(20_000, 40_000, 60, random.Random(4))
    began = time.monotonic()
    assert len(ingest.joined_boxes(boxes, 28, 0.18)) == 20_000
    assert time.monotonic() - began < 20


def test_many_small_pages(spark):
    """Pages are read in batches, not handed over one by one, and one that goes over batches is whole."""
    n = 60_000
    small = spark.range(n).selectExpr("id as page_id", "10.0D as x0", "10.0D as y0", "100.0D as x1", "90.0D as y1")
    large = spark.range(25_000).selectExpr("-1L as page_id", "double(id % 500) as x0", "double(id % 700) as y0", "double(id % 500) + 10 as x1", "double(id % 700) + 10 as y1")
    rects = small.unionByName(large).selectExpr("*", "600.0D as width", "800.0D as height")
    began = time.monotonic()
    got = ingest.figure_regions(rects).filter("page_id < 3").orderBy("page_id").collect()
    assert time.monotonic() - began < 15
    assert [tuple(r) for r in got[11:]] == [(k, 2.0, 2.0, 108.0, 98.0) for k in range(3)]
    assert {r.page_id for r in got[:11]} == {-1}  # eleven diagonals


def test_few_boxes_as_many():
    """Pages of few boxes, compared one by one, give the clusters of the sweep."""
    r = random.Random(5)
    for n in (2, 4, 24):
        for most in (100, 300, 900):
            boxes = _boxes(n, most, 60, r)
            few, far = ingest.joined_boxes(boxes, 28, 0.18), [[9000.0 + 100 * k, 0.0, 9001.0 + 100 * k, 1.0] for k in range(30)]
            many = ingest.joined_boxes(boxes + far, 28, 0.18)[:n]
            assert len(set(few)) == len(set(many)) == len(set(zip(few, many, strict=True)))
