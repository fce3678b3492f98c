import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from churnlens.llm import token_count
from churnlens.llm.token_count import count_tokens, pre_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
RUN = pre_tokenizer(PATH)


def pieces(text):
    return len(TOK.encode(text, add_special_tokens=False).ids)


def by_pre_tokens(text):
    toks, special = RUN(text)
    return special + sum(pieces(t) for t in toks)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from(
    [" ", "\n\n", "  a", "<|endoftext|>", "<|endoftext", "'s", "'ll ", "ß", "é1", "½", " ", " ", "_x", "漢字", "\x1c", "\x85"])),
    max_size=12).map("".join))
def test_sum_of_pre_tokens_is_the_library_count(text):
    assert by_pre_tokens(text) == pieces(text)


def test_every_code_point_is_cut_as_by_the_library():
    for cp in [*range(0xD800), *range(0xE000, 0x110000, 7)]:
        c = chr(cp)
        s = f"a{c}1{c}{c}!{c} {c}{c}  b{c}"
        assert RUN(s)[0] == [s[a:b] for _, (a, b) in TOK.pre_tokenizer.pre_tokenize_str(s)], cp


@pytest.mark.parametrize("block", [3, 16384])
def test_counts(spark, docs, monkeypatch, block):
    monkeypatch.setattr(token_count, "BLOCK_DOCS", block)
    more = spark.createDataFrame([(900, "a<|endoftext|>b<|endoftext|>"), (901, "漢字 ½  x")], "doc_id long, text string")
    table = docs.select("doc_id", "text").union(more)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), pieces(r.text or "")) for r in table.collect())
    got = count_tokens(table, PATH).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_equal_blocks_and_empty_table(spark, empty):
    same = spark.createDataFrame([(None, "one two")] * 8, "doc_id long, text string").repartition(4)
    assert [r.n_tokens for r in count_tokens(same, PATH).collect()] == [2] * 8
    assert count_tokens(empty, PATH).count() == 0
