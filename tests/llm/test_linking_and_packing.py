import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from corvane.llm import graph, mixing, near_dedup, packing

BYTES = public_tokenizers.path("byte_bpe_50k.json")
LOWER = {c: c + 32 for c in range(65, 91)}
WORD = r"[^\x20\x09-\x0D]+"


def shingles(t, k):
    w = re.findall(WORD, (t or "").translate(LOWER))
    return frozenset(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset()


def components(rows, k, percent):
    """{doc: smallest doc reachable} by comparing all pairs that share a shingle."""
    sets = {}
    for d, t in rows:
        sets.setdefault(d, []).append(shingles(t, k))
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(d, s) for d, many in sets.items() for s in many if s]
    for (a, x), (b, y) in itertools.combinations(flat, 2):
        if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
            same = len(x & y)
            if 100 * same >= percent * (len(x) + len(y) - same):
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
    return {d: find(d) for d in sets}


def copies(seed, n, words=120, changed=2):
    """A text and n copies of it, each with some words of its own."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for i in range(n):
        w = list(base)
        for k in r.sample(range(words), changed):
            w[k] = f"own{seed}x{i}x{k}"
        out.append(" ".join(w))
    return out


def test_near_dedup(spark, odd_docs, small_docs, no_docs):
    texts = copies(1, 60) + copies(2, 3) + copies(3, 2, changed=30) + copies(4, 5)[:1] * 30
    planted = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for docs, k, percent in ((small_docs, 3, 85), (planted, 3, 85), (planted, 5, 80)):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        want = components(rows, k, percent)
        got = near_dedup.near_dedup(docs, k, percent).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted((d, len(shingles(t, k)), want[d], d == want[d]) for d, t in rows)
    # the copies of a common origin resemble only it, not each other
    assert len(set(components(list(enumerate(copies(5, 40, changed=3))), 3, 85).values())) < 41
    odd = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.near_dedup(odd_docs).collect()}
    assert odd[(None, 5)] == (None, True) and odd[(2, 0)] == (2, True) and odd[(8, 0)] == (8, True) and odd[(9, 1)] == (9, True)
    kept = near_dedup.keep_one(odd_docs.withColumnsRenamed({"pos": "gone", "row": "_gone"}))
    assert kept.columns == odd_docs.withColumnsRenamed({"pos": "gone", "row": "_gone"}).columns and kept.count() == odd_docs.count()
    kept = near_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert near_dedup.near_dedup(no_docs).count() == 0


def test_near_dedup_star(spark):
    """Sixty copies that reach the threshold with their origin but not with one another are one component."""
    rows = list(enumerate(copies(6, 60, words=200, changed=5)))
    want = components(rows, 3, 85)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want and set(want.values()) == {0}


def test_near_dedup_stars_of_one_family(spark):
    """Three origins that resemble each other too little, each with copies that resemble only their own origin."""
    r = random.Random(9)
    base = copies(8, 0, words=220)[0].split()
    texts = []
    for o in range(3):
        origin = list(base)
        for k in r.sample(range(220), 14):
            origin[k] = f"origin{o}x{k}"
        texts.append(" ".join(origin))
        for i in range(40):
            w = list(origin)
            for k in r.sample(range(220), 5):
                w[k] = f"copy{o}x{i}x{k}"
            texts.append(" ".join(w))
    rows = list(enumerate(texts))
    want = components(rows, 3, 85)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: x.component_id for x in got} == want and set(want.values()) == {0, 41, 82}


def bridged(n=40):
    """Two tight clusters of n, joined by one pair of which each member has closer neighbours in its own cluster."""
    r = random.Random(12)
    base = copies(11, 0, words=600)[0].split()
    other, places = list(base), list(range(1, 599, 4))
    for k in r.sample(places, 16):
        other[k] = f"other{k}"
    texts = []
    for name, origin in (("a", base), ("b", other)):
        for i in range(n):
            w = list(origin)
            k = r.choice([k for k in places if base[k] == other[k]])
            w[k] = f"own{name}{i}"
            texts.append(" ".join(w))
    return list(enumerate([*texts, " ".join(base), " ".join(other)]))


def test_near_dedup_joins_clusters_by_one_pair(spark):
    rows = bridged()
    want = components(rows, 3, 85)
    assert set(want.values()) == {0} and set(components(rows[:-1], 3, 85).values()) == {0, 40}
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_near_dedup_joins_clusters_far_apart_in_a_region(spark):
    """As before, with so many members between the two that no window holds both; neither is a hub."""
    rows = bridged(150)
    want = components(rows, 3, 85)
    assert set(want.values()) == {0} and set(components(rows[:-1], 3, 85).values()) == {0, 150}
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def family(seed, others, n=800):
    """n copies of a text, each with 5 of its 300 words replaced by one of ``others`` alternatives."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(300)]
    out = []
    for i in range(n):
        w = list(base)
        for k in r.sample(range(300), 5):
            w[k] = f"v{k}x{r.randrange(others)}"
        out.append((i, " ".join(w)))
    return out


def test_near_dedup_large_family(spark):
    """Hardly one pair in sixty of 800 members reaches the threshold, and together they are one component."""
    rows = family(3, 20)
    want = components(rows, 3, 85)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want and set(want.values()) == {0}


def test_near_dedup_outlives_the_pipeline(spark):
    """Tables of a query that is still to be read aren't another's to delete."""
    import corpus_pipeline

    got = near_dedup.near_dedup(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.count() == 200


def test_forest_roots(spark):
    """A path of 200 nodes, a star, a repeated row and a lone edge; an empty table."""
    up = {k: k - 1 for k in range(1, 200)} | {k: 1000 for k in range(1001, 1300)} | {5000: 7}
    rows = [*up.items(), (5000, 7)]
    got = {x.node: x.component for x in graph.forest_roots(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {k: 1000 if 1000 < k < 1300 else 0 for k in up}
    assert graph.forest_roots(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_block_pairs_in_parts(spark):
    """Every two blocks with one outside the largest component meet once, also where a region is joined in many parts."""
    rows = [(k, 0, k % 2, k % 3 > 0, 100) for k in range(600)] + [(1000 + k, 1, 7, True, 100) for k in range(3)] + [(2000, 0, 9, False, 100)]
    members = spark.createDataFrame(rows, "doc long, t int, region long, rest boolean, bytes long")
    got = [(r.region, i.doc, j.doc) for r in near_dedup.block_pairs(members, 4, "doc").collect() for i in r.x for j in r.y if not r.same or i.doc < j.doc]
    want = [(x[2], x[0], y[0]) for x in rows for y in rows if x[2] == y[2] and x[3] and (not y[3] or x[0] < y[0])]
    unordered = lambda pairs: sorted((r, *sorted((a, b))) for r, a, b in pairs)
    assert unordered(got) == unordered(want)


def test_connected_components(spark):
    r = random.Random(7)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1100)]
    parent = {}
    for a, b in edges:
        parent.setdefault(a, a), parent.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(parent[a], parent[b])
            changed |= parent[a] != m or parent[b] != m
            parent[a] = parent[b] = m
    got = {x.node: x.component for x in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in parent.items() if k not in alone}


def test_mixing(spark, odd_docs, small_docs, no_docs):
    for docs in (small_docs, odd_docs):
        rows = mixing.mix(docs).collect()
        sizes = Counter((r.doc_id, len(re.findall(WORD, r.text or ""))) for r in docs.collect())
        assert Counter((r.doc_id, r["size"]) for r in rows) == sizes
        assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
        assert abs(sum({(r.source_size, r.target): r.target for r in rows}.values()) - sum(r["size"] for r in rows)) < 1
        again = mixing.mix(docs).collect()
        assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)
        source = {(r.doc_id, len(re.findall(WORD, r.text or ""))): r.source for r in docs.collect()}
        taken = defaultdict(int)
        target = {}
        for r in rows:
            taken[source[(r.doc_id, r["size"])]] += r.taken
            target[source[(r.doc_id, r["size"])]] = r.target
        # whole documents: off by half of the largest unit of the source at most
        unit = defaultdict(int)
        for (d, t), n in Counter((r.doc_id, r.text) for r in docs.collect()).items():
            k = (d, len(re.findall(WORD, t or "")))
            unit[source[k]] = max(unit[source[k]], n * k[1])
        assert all(abs(taken[s] - target[s]) <= unit[s] / 2 + 1 for s in taken)
        if docs is small_docs:
            assert sum(abs(taken[s] - target[s]) for s in taken) < 0.04 * sum(target.values())  # ten documents a source
        assert all(not r["size"] or r.taken % r["size"] == 0 for r in rows)
        mixed = Counter()
        for r in mixing.mixed_documents(docs).collect():
            mixed[r.doc_id] += len(re.findall(WORD, r.text or ""))
        want = Counter()
        for r in rows:
            want[r.doc_id] += r.taken
        assert +mixed == +want
        assert {r.text for r in mixing.mixed_documents(docs).collect()} <= {r.text for r in docs.collect()}
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
    assert mixing.mix(no_docs).count() == 0


def test_mixing_against_a_plain_plan(spark, odd_docs, small_docs):
    """Targets by water-filling and what is taken, worked out in order of the hash."""
    for docs in (small_docs, odd_docs):
        h = docs.select("doc_id", "source", mixing._size().alias("size"), mixing._hash(8).alias("h")).collect()
        sources = sorted({r.source for r in h}, key=lambda s: (s is None, s))
        size = {s: sum(r["size"] for r in h if r.source == s) for s in sources}
        weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sources)}
        target, free, left = {}, set(sources), float(sum(size.values()))
        while True:
            share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            over = {s for s in free if share[s] > 3 * size[s]}
            if not over:
                target |= share
                break
            target |= {s: 3.0 * size[s] for s in over}
            left -= sum(3 * size[s] for s in over)
            free -= over
        bits = max(1, min(24, (len(h) // mixing.BUCKET_ROWS).bit_length()))
        want = []
        for s in sources:
            own = sorted((r for r in h if r.source == s), key=lambda r: r.h)
            whole = min(3, int(target[s] // size[s])) if size[s] else 0
            rest = 0 if whole == 3 else max(0, math.floor(target[s] + 0.5) - whole * size[s])
            units = {}
            for r in own:
                units[r.h] = units.get(r.h, 0) + r["size"]
            again, sofar = set(), 0
            for x in sorted(units):
                if sofar + units[x] > rest:
                    # of the rest of this bucket the nearest to what is missing
                    same = [y for y in sorted(units) if y >= x and y >> 64 - bits == x >> 64 - bits]
                    near = min(same, key=lambda y: (abs(units[y] - rest + sofar), y))
                    again |= {near} if abs(units[near] - rest + sofar) < rest - sofar else set()
                    break
                sofar += units[x]
                again.add(x)
            want += [(r.doc_id, r["size"], size[s], round(target[s], 6), r["size"] * (whole + (r.h in again))) for r in own]
        got = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(docs).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_mixing_caps(spark):
    words = {"a": 1, "b": 100, "c": 100, "d": 10, "e": 500}
    docs = spark.createDataFrame([(i, "x " * n, s) for i, (s, n) in enumerate(words.items())], "doc_id long, text string, source string")
    got = {r.doc_id: r.target for r in mixing.mix(docs).collect()}
    # a stops at 3, d at 30; 678 are left for b, c and e, which weigh 2, 1 and 2
    assert got[0] == 3 and got[3] == 30
    np.testing.assert_allclose([got[1], got[2], got[4]], [271.2, 135.6, 271.2])


def test_packing_reduction_keeps_the_optimum():
    def best(items, cap):
        items, least = sorted(items, reverse=True), len(items)

        def place(i, rooms):
            nonlocal least
            if len(rooms) >= least:
                return
            if i == len(items):
                least = len(rooms)
                return
            for r in set(rooms):
                if r >= items[i]:
                    rest = list(rooms)
                    rest.remove(r)
                    place(i + 1, [*rest, r - items[i]])
            place(i + 1, [*rooms, cap - items[i]])

        place(0, [])
        return least

    r = random.Random(11)
    for _ in range(400):
        cap = r.choice([10, 20, 30])
        items = [r.randint(1, cap) for _ in range(r.randint(1, 9))]
        fixed, left = packing.reduced(Counter(items), cap)
        rest = [x for x, n in left.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + best(rest, cap) == best(items, cap)
        total = Counter()
        for pattern, n in packing.pack(Counter(items), cap):
            assert sum(x * k for x, k in pattern) <= cap
            for x, k in pattern:
                total[x] += k * n
        assert total == Counter(items)


def test_byte_encoder():
    library, own, r = Tokenizer.from_file(BYTES), packing.ByteEncoder(BYTES, cache=50), random.Random(5)
    alphabet = "ab 'st'll 12\n\t\r é<|>!?._-’“–«\x00\x1c ²½日ſß̈ "
    for t in ["", "<|endoftext|>x", "a <|endoftext|>", *("".join(r.choice(alphabet) for _ in range(r.randint(1, 30))) for _ in range(3000))]:
        assert own.encode(t) == np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_packing(spark, odd_docs, small_docs, no_docs):
    library = Tokenizer.from_file(BYTES)
    for docs in (odd_docs, small_docs):
        want = []
        for r in docs.collect():
            ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
            cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
            for k, (a, b) in enumerate(itertools.pairwise(cuts)):
                want.append((r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
        rows = packing.best_fit_packing(docs, BYTES).collect()
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
        sequences = defaultdict(list)
        for r in rows:
            sequences[r.sequence_id].append((r.offset, r.length))
        for parts in sequences.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= 2048
        assert len(sequences) <= 1.02 * sum(r.length for r in rows) / 2048 + 1
    assert packing.best_fit_packing(no_docs, BYTES).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    from corvane.llm import line_dedup, quality_rules

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    good = quality_rules.keep_good(docs)
    lines = line_dedup.drop_lines(good)
    kept = near_dedup.keep_one(lines, 5, 80)
    assert set(good.columns) == set(lines.columns) == set(kept.columns) == set(docs.columns)
    assert lines.count() == good.count() and kept.count() <= lines.count()
    ids = {r.doc_id for r in kept.collect()}
    groups = components([(r.doc_id, r.text) for r in lines.collect()], 5, 80)
    assert ids == {d for d, g in groups.items() if d == g}
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in packed} <= ids
    # every document as often as it is mixed, whole, in pieces as the library's ids are cut
    texts, library = {r.doc_id: r.text for r in kept.collect()}, Tokenizer.from_file(BYTES)
    times = Counter(r.doc_id for r in mixing.mixed_documents(kept).collect())
    want = []
    for d, n in times.items():
        ids = [*library.encode(texts[d] or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(itertools.pairwise(cuts))] * n
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(want)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mixing", "packing"]
