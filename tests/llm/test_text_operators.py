import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece

from corvane.llm import license_scan, line_dedup, quality_rules, token_counts

LOWER = {c: c + 32 for c in range(65, 91)}
SPACE = r"\x20\x09-\x0D"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def tuples(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def scanned(d, t):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in license_scan.BASE:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return d, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_scan(odd_docs, small_docs, no_docs):
    cols = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    for docs in (odd_docs, small_docs):
        out = license_scan.license_scan(docs)
        assert tuples(out, *cols) == sorted((scanned(r.doc_id, r.text) for r in docs.collect()), key=repr)
        for r in out.collect():
            assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    assert license_scan.license_scan(no_docs).count() == 0


def test_license_scan_fuzzy_template(spark):
    text = "Permission is granted, free of charge, to any person. Redistribution and use in source and binary forms, without change, are permitted"
    docs = spark.createDataFrame([(1, text), (2, "Licensed under the Apache License, Version 2.0.")], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.license_scan(docs).collect()}
    assert got[2].labels == "apache,apache-2.0" and got[2].score == 1.0
    assert got[1].labels == ""  # too few words at their relative places


def test_license_scan_long_templates(spark):
    """A long template is found where some of its words are missing or others, not where its key phrase is broken."""
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its documentation files"
    bsd = "Neither the name of ACME Inc nor the names of its contributors may be used to endorse or promote products derived from this software without any prior written permission."
    texts = [mit, mit.replace("hereby", "here"), "x y " + bsd, bsd.replace("promote", "sell"), "a\n" * 50 + mit.upper() + " " + bsd, " ".join(bsd.split()[6:]), "to endorse or promote products derived from this software"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.base_labels) for r in license_scan.license_scan(docs).collect()}
    assert got == {0: ("mit", ""), 1: ("", ""), 2: ("bsd-3-clause", ""), 3: ("", ""), 4: ("bsd-3-clause,mit", ""), 5: ("bsd-3-clause", ""), 6: ("", "")}


def test_license_scan_against_every_place(spark):
    """Labels and score against the templates compared at every place of random texts."""
    made = license_scan.templates()
    vocabulary = sorted({w for t in made for w in t.words})
    r = random.Random(2)
    texts = []
    for _ in range(400):
        words = []
        for _ in range(r.randint(1, 4)):
            t = list(r.choice(made).words)
            for _ in range(r.randint(0, 4)):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            words += t[r.randint(0, 2) :] + r.choices(vocabulary, k=r.randint(0, 3))
        texts.append(" ".join(words))
    df = Counter(w for t in texts for w in set(t.split()))
    idf = {w: np.log((1 + len(texts)) / (1 + df[w])) + 1 for w in vocabulary}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.labels, round(x.score, 6)) for x in license_scan.license_scan(docs).collect()}
    for d, text in enumerate(texts):
        words, labels, best = text.split(), set(), 0.0
        for t in made:
            for start in range(-len(t.words), len(words)):
                same = [0 <= start + j < len(words) and words[start + j] == w for j, w in enumerate(t.words)]
                share = sum(idf[w] for w, x in zip(t.words, same, strict=True) if x) / sum(idf[w] for w in t.words)
                if all(same[t.key_at : t.key_at + t.key_len]) and (t.base or share >= license_scan.LEAST_SHARE):
                    labels.add(t.label)
                    best = max(best, share)
        assert got[d] == (",".join(sorted(labels)), round(best, 6)), text


def test_token_counts(odd_docs, small_docs, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for docs in (odd_docs, small_docs):
        want = []
        for r in docs.collect():
            n = len(model.encode(r.text or ""))
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 4096))
        assert tuples(token_counts.token_counts(docs, PIECES), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert token_counts.token_counts(no_docs, PIECES).count() == 0


def test_token_counts_odd_texts():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = token_counts.PieceCounter(PIECES, cache=3)
    for t in ["", " ", "  ", " a", "a ", "a  b", "\ta\nb", "\n", "\n\n a", "a\n", "▁x", "a▁b", "\0a", "日本語 🤗", "<s>", "x y z w v\nq", "\n ", "a\n\n"]:
        assert counter.count(t) == len(model.encode(t)), t


def deduped(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if d is not None and len(key(x)) >= 20:
                held[key(x)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(held[key(x)]) < 3 or d == max(held[key(x)])]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return out


def test_line_dedup(odd_docs, small_docs, no_docs, spark):
    hot = spark.createDataFrame([(i, f"a line that a very great many documents hold\nown line number {i:020d}\nanother line of {i % 7} that some of them hold") for i in range(3000)], "doc_id long, text string")
    for docs in (odd_docs, small_docs, hot):
        want = deduped([(r.doc_id, r.text) for r in docs.collect()])
        assert tuples(line_dedup.line_dedup(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted((x[:4] for x in want), key=repr)
    kept = line_dedup.drop_lines(odd_docs)
    assert kept.columns == odd_docs.columns
    want = Counter((d, t) for (d, _, _, _, t) in deduped([(r.doc_id, r.text) for r in odd_docs.collect()]))
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == want
    assert line_dedup.line_dedup(no_docs).count() == 0


def measured(d, t):
    t = t or ""
    words = re.findall(f"[^{SPACE}]+", t)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(8)}
    lines = [x for x in t.split("\n") if re.search(f"[^{SPACE}]", x)]
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return d, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated), failed


def test_quality_rules_repeated_short_lines(spark):
    """Most lines repeat others in a varying order, which fails no base rule."""
    words = lambda seed, n: [f"w{seed}x{i}y" for i in range(n)]
    good = [(i, "\n".join(" ".join(words(i * 100 + j, 6)) for j in range(30)), "en", "a") for i in range(300)]
    r = random.Random(4)
    lines = [" ".join(words(10**6 + j, 5)) for j in range(40)]
    order = [*range(40), *r.sample(range(40), 40), *r.sample(range(40), 40)]
    shuffled = (1000, "\n".join(lines[j] for j in order), "en", "a")
    docs = spark.createDataFrame([*good, shuffled], "doc_id long, text string, lang string, source string")
    got = {x.doc_id: x for x in quality_rules.quality_rules(docs).collect()}
    assert all(got[d].kept for d, *_ in good)
    assert not got[1000].base_failed and not got[1000].kept


def test_quality_rules_follow_exact_quantiles(spark):
    """kept against the rule worked out on exact quantiles, which sketches of so few rows hold; cutoffs differ between groups."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = quality_rules.measured(docs.select("doc_id", "text", "lang", "source"), ["doc_id", "lang", "source"]).toPandas()
    passed = rows[~rows["base_failed"]]

    def own(x, of=None, n=0):
        out = {}
        for k, share in quality_rules.quantiles_asked():
            v = np.quantile(x[quality_rules.sketched()[k]].astype(float), share, method="inverted_cdf")
            out[k, share] = v if of is None else (v * n + of[k, share] * quality_rules.SHRINK) / (n + quality_rules.SHRINK)
        return out

    over = own(passed)
    langs = {k: own(g, over, len(g)) for k, g in passed.groupby("lang")}
    kept, limits = set(), []
    for (lang, _), g in passed.groupby(["lang", "source"]):
        q = own(g, langs[lang], len(g))
        ok = pd.Series(True, index=g.index)
        for m, (high, times, allowed, size) in quality_rules.RULES.items():
            limit = q[m, high] + times * (q[m, high] - q[m, 0.5]) + (allowed / max(1.0, q[size, 0.5]) if size else 0.0)
            limits.append((m, round(limit, 6)))
            ok &= ~(g[f"m_{m}"] > limit)
        for m, times in quality_rules.LOW.items():
            ok &= ~(g[f"m_{m}"] < q[m, 0.25] - times * (q[m, 0.5] - q[m, 0.25]))
        kept |= set(g["doc_id"][ok])
    got = {r.doc_id for r in quality_rules.quality_rules(docs).collect() if r.kept}
    assert got == kept and len(kept) < len(passed)
    assert all(len({x for k, x in limits if k == m}) > 20 for m in quality_rules.RULES)
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == kept


def test_quality_rules_spare_good_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.quality_rules(docs).join(labels.select("doc_id", "quality"), "doc_id").filter("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n.get((1, False), 0) <= 0.002 * n[1, True] and n.get((0, True), 0) <= 0.01 * n[0, False]


def test_quality_rules(odd_docs, small_docs, no_docs):
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for docs in (odd_docs, small_docs):
        out = quality_rules.quality_rules(docs)
        assert tuples(out, *cols) == sorted((measured(r.doc_id, r.text) for r in docs.collect()), key=repr)
        assert out.filter("kept and base_failed").count() == 0
    assert quality_rules.quality_rules(no_docs).count() == 0
    kept = quality_rules.keep_good(small_docs)
    assert kept.columns == small_docs.columns
    assert kept.count() == quality_rules.quality_rules(small_docs).filter("kept").count() > 0


def test_token_caches_are_bounded():
    """Long segments aren't cached, and many short ones push others out."""
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = token_counts.PieceCounter(PIECES, cache=50)
    r = random.Random(8)
    for _ in range(40):
        t = " ".join("".join(r.choice("abcé日") for _ in range(r.choice([1, 3, 9, 63, 64, 65, 300]))) for _ in range(20))
        t = t + "\n" + t.replace(" ", "")
        assert counter.count(t) == len(model.encode(t))
    assert len(counter.after_space) < 200 and max(map(len, [*counter.after_space, *counter.bare])) <= token_counts.LONGEST
    assert counter.chars <= 200 * token_counts.LONGEST


def test_quality_cutoffs_are_the_same_in_every_run(spark):
    """More rows than buckets need merging for: partitions, their number and the order of rows change nothing."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality_rules.measured(docs.select("doc_id", "text", "lang", "source"), ["doc_id", "lang", "source"]).crossJoin(spark.range(9))
    rows = rows.withColumn("m_mark_share", rows["m_mark_share"] * (1 + rows["id"] / 97)).cache()
    runs = [sorted(map(tuple, quality_rules.thresholds(r).collect()), key=repr) for r in (rows.repartition(3, "doc_id"), rows.repartition(11), rows.orderBy("word_chars"))]
    assert runs[0] == runs[1] == runs[2] and runs[0]
    rows.unpersist()


def test_quality_quantiles_are_close(spark):
    """Of buckets that hold many values a quantile is off by less than their width."""
    v = np.random.default_rng(5).lognormal(0, 2, 30_000)
    columns = {c: v if c == "m_mark_share" else np.zeros(len(v)) for c in quality_rules.sketched().values()}
    rows = spark.createDataFrame(pd.DataFrame({"lang": "en", "source": "a", "base_failed": False, **columns}))
    got = quality_rules.quantiles(quality_rules.sketches(rows), "s", "t_lang").first()
    for q in (0.5, 0.75):
        exact = np.quantile(v, q, method="inverted_cdf")
        assert exact / quality_rules.GAMMA <= got["s" + quality_rules.quantile_name("mark_share", q)] <= exact
