"""Compare near_dedup with an exact similarity join: python tests/llm/measure_near_dedup.py FOLDER [WORDS PERCENT].

The exact join is by prefix filtering on one machine: sets with their shingles in order of rarity, candidates that share
a shingle of their prefixes, and their full sets. It links all texts of FOLDER's documents that reach the threshold.
"""

import sys
from collections import Counter, defaultdict
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

from pyspark.sql import SparkSession  # noqa: E402
from test_linking_and_packing import shingles  # noqa: E402

from corvane.llm import near_dedup  # noqa: E402


def exact(rows, words, percent):
    """{doc: smallest doc reachable}."""
    first, parent = {}, {}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for d, t in sorted(rows):
        s = shingles(t, words)
        parent[d] = first.setdefault(s, d) if s else d
    sets = {d: s for s, d in first.items() if s}
    often = Counter(x for s in sets.values() for x in s)
    held, n_links = defaultdict(list), 0
    for d, s in sorted(sets.items(), key=lambda x: len(x[1])):
        order = sorted(s, key=lambda x: (often[x], x))
        prefix = order[: len(s) - -(-percent * len(s) // 100) + 1]
        for e in {e for x in prefix for e in held[x]}:
            if 100 * len(sets[e]) >= percent * len(s):
                same = len(s & sets[e])
                if 100 * same >= percent * (len(s) + len(sets[e]) - same):
                    n_links += 1
                    a, b = find(d), find(e)
                    parent[max(a, b)] = min(a, b)
        for x in prefix:
            held[x].append(d)
    return {d: find(d) for d in parent}, n_links


def main(folder, words=3, percent=85):
    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "16").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs, words, percent).collect()}
    want, n_links = exact([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], words, percent)
    wrong = [d for d in want if got[d] != want[d]]
    sizes = Counter(want.values())
    print(f"{folder}: {len(want)} documents, {n_links} links between different texts, {sum(n > 1 for n in sizes.values())} components of several, the largest of {max(sizes.values())}; documents with another component: {len(wrong)}")


if __name__ == "__main__":
    main(sys.argv[1], *map(int, sys.argv[2:]))
