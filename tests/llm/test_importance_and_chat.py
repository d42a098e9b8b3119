import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from corvane.llm import chat_format, importance, queries

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def runs(text, most):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def plain_resample(docs, target, percent, least, most, buckets, seed):
    s = Counter(h % buckets for _, t in docs for h in runs(t, most))
    t_ = Counter(h % buckets for t in target for h in runs(t, most))
    n_s, n_t = sum(s.values()), sum(t_.values())
    gain = [math.floor(1000 * math.log((t_[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)]
    rows = []
    for d, t in docs:
        hs = runs(t, most)
        weight = sum(gain[h % buckets] for h in hs)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(hs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(t))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("settings", [(10, 20, 1, 10_000, 2024), (60, 3, 3, 257, 7), (100, 0, 2, 1000, 1)])
def test_resample(odd_docs, small_docs, no_docs, settings):
    percent, least, most, buckets, seed = settings
    target = small_docs.limit(20).select("text")
    aim = [r.text for r in target.collect()]
    for docs in (small_docs, odd_docs):
        got = importance.resample(docs, docs.sparkSession.createDataFrame([(t,) for t in aim], "text string"), percent, least, most, buckets, seed)
        assert sorted(map(tuple, got.collect()), key=repr) == plain_resample([(r.doc_id, r.text) for r in docs.collect()], aim, percent, least, most, buckets, seed)
    assert importance.resample(no_docs, target).count() == 0
    assert importance.resample(small_docs, target.limit(0)).count() == small_docs.count()


def test_states_advance_as_zlib(monkeypatch):
    rng = np.random.default_rng(11)
    for few in (0, 8, 10_000):
        monkeypatch.setattr(importance, "FEW", few)
        texts = ["".join(rng.choice(list("aB1é字 .\n\x7f"), size=n)) for n in (0, 1, 5, 400, 3000)] + ["x" * 5000, "", "Z"]
        raw = [t.encode() for t in texts]
        off = np.cumsum([0, *map(len, raw)])
        found, n = importance.features(np.frombuffer(b"".join(raw), np.uint8), off, 1 << 24, 3)
        assert n.tolist() == [len(words_of(t)) for t in texts]
        for size, (bucket, row) in enumerate(found, 1):
            want = [(zlib.crc32(" ".join(w[i : i + size]).encode()) % (1 << 24), k) for k, t in enumerate(texts) for w in [words_of(t)] for i in range(len(w) - size + 1)]
            assert list(zip(bucket.tolist(), row.tolist(), strict=True)) == want


def test_sample_draws_likely_documents(spark):
    docs = spark.createDataFrame([(k, ("red green blue " if k % 4 == 0 else "one two three ") * 10, k) for k in range(400)], "doc_id long, text string, rank long")
    got = importance.sample(docs, spark.createDataFrame([("red blue green",)], "text string"), percent=20)
    assert got.columns == docs.columns and got.count() == 80 and all(r.doc_id % 4 == 0 for r in got.collect())


def same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = con.sql(queries.ORACLES[name]), queries.QUERIES[name](spark, SF)
    at = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((tuple(r[k] for k in at) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["op11_importance", "op12_chat_format"])
def test_query_against_sql(spark, name):
    same_as_sql(spark, name)


# ------------------------------------------------------------------ chat formatting

CONV = "conv_id long, turn long, role string, text string, piece string, place int"


def talk(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], CONV)


def plain_digests(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest()
        whole = chat_format.render_brackets([t[2:] for t in turns])
        assert chat_format.read_brackets(whole) == [t[2:] for t in turns]
        out.append((c, len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole)))
    return sorted(out, key=repr)


ODD = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"),
    (2, 5, "assistant", None), (2, 4, None, "a\\[INST]\\\\<s>\\"), (2, 9, "tool [TEXT]\n", "<\\s> [\\/INST] [/TEXT]"), (2, 9, "system", ""),
    (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (3, 0, "assistant", "b" * 200_000), (3, None, "user", " [/INST"),
    (None, 1, "user", "q"), (None, 2, "assistant", "</s"), (4, 0, "assistant", " "), (4, 1, "assistant", "</s> x</s>"), (4, 2, "user", "\n"),
]


def test_chat_format_odd_rows(spark):
    pieces = chat_format.chat_format(talk(spark, ODD))
    got = chat_format.digests(pieces).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=repr) == plain_digests(ODD) and not any(r.rewrites for r in got)
    whole = {r.conv_id: r.formatted for r in chat_format.formatted(pieces).collect()}
    assert whole[1] == "<s>[INST] <\\/s>[\\INST] ok [\\/INST] [/INST] <\\/s>[\\INST] ok [\\/INST]</s>"
    assert chat_format.digests(chat_format.chat_format(talk(spark, []))).count() == 0


@pytest.mark.parametrize("turns", [256, 257, 384, 1000])
def test_chat_format_long_conversation(spark, turns):
    rows = [(7, k, ("user", "assistant")[k % 2], f"text {k} </s>") for k in range(turns)] + ODD
    got = chat_format.digests(chat_format.chat_format(talk(spark, rows))).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=repr) == plain_digests(rows) and not any(r.rewrites for r in got)


def test_templates_that_rewrite_history(spark):
    def last_marked(turns):
        """Marks the last turn only, and leaves out what earlier assistant turns say between angle brackets."""
        keep = [(r, x if k == len(turns) - 1 or r != "assistant" else re.sub(r"«.*?»", "", x)) for k, (r, x) in enumerate(turns)]
        return "".join(f"<{r}>{x}" for r, x in keep) + "<end>"

    forgetful = chat_format.Template(last_marked, chat_format.read_brackets, lambda x: x)
    rows = [(1, 0, "user", "aa"), (1, 1, "assistant", "«think» bb"), (1, 2, "user", "cc"), (1, 3, "assistant", "«again» dd"), (2, 0, "user", "alone")]
    got = chat_format.chat_format(talk(spark, rows), forgetful).orderBy("conv_id", "place").collect()
    assert [r.rewrites for r in got] == [True] * 4 + [False]
    assert [r.piece[r.text_start : r.text_end] for r in got] == ["aa", " bb", "cc", "«again» dd", "alone"]
    assert "".join(r.piece for r in got if r.conv_id == 1) == last_marked([r[2:] for r in rows[:4]])
    silent = chat_format.Template(lambda ts: "".join(f"<{r}>{x if r == 'user' else ''}" for r, x in ts), chat_format.read_brackets, lambda x: x)
    got = chat_format.chat_format(talk(spark, rows), silent).orderBy("conv_id", "place").collect()
    assert [r.text_start is None for r in got] == [False, True, False, True, False] and not any(r.rewrites for r in got)
