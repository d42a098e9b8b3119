import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corvane.operators import token_windows

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(BYTES)
PLAIN.encode_special_tokens = True


def count(text):
    return len(PLAIN.encode(text, add_special_tokens=False).ids)


def check(text, found, size, overlap):
    """Windows are stretches of the text in order that cover it, within the size and the overlap."""
    reached = 0
    for k, (start, window, n) in enumerate(found):
        assert text[start : start + len(window)] == window and window and n == count(window) <= size
        assert start <= reached < start + len(window)
        if k:
            assert start > found[k - 1][0] and count(text[start:reached]) <= overlap + 2
        reached = start + len(window)
    assert reached == len(text)


@pytest.mark.parametrize(("size", "overlap"), [(8, 0), (8, 7), (50, 10), (256, 32)])
def test_windows_of_odd_texts(size, overlap):
    tokenizer = token_windows._tokenizer(BYTES)
    for text in ("a", "日本語のテキスト " * 40, "🙂👩‍👩‍👧é́ " * 60, "x" * 3000, " \n\t " * 200, "<|endoftext|> it's 12345 don't" * 30, "편집 원칙" * 50):
        check(text, token_windows.windows(text, tokenizer, size, overlap), size, overlap)
    assert token_windows.windows("", tokenizer, size, overlap) == [] == token_windows.windows(None, tokenizer, size, overlap)


def test_windows_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "text as content")
    got = {}
    for r in token_windows.chunk_model_tokens(docs, BYTES, 64, 16).orderBy("doc_id", "chunk_index").collect():
        assert r.chunk_index == len(got.setdefault(r.doc_id, []))
        got[r.doc_id].append((r.start_index, r.chunk, r.n_tokens))
    for r in docs.collect():
        check(r.content or "", got.get(r.doc_id, []), 64, 16)
    with pytest.raises(ValueError, match="size must be"):
        token_windows.chunk_model_tokens(docs, BYTES, 4, 0)


def test_windows_of_one_row_group_are_cut_by_many_tasks(spark, tmp_path):
    docs = spark.range(64).selectExpr("id as doc_id", "repeat(concat('word ', id, ' '), 50) as content").coalesce(1)
    docs.write.parquet(f"{tmp_path}/docs")
    made = token_windows.chunk_model_tokens(spark.read.parquet(f"{tmp_path}/docs"), BYTES, 64, 16)
    tasks = {r[0] for r in made.selectExpr("spark_partition_id()").distinct().collect()}
    assert len(tasks) > 1
