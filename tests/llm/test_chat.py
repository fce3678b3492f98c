import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from churnlens.llm import chat

PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "<\\s>", "</", "s>", "<", "[", "\\", "]", "[\\\\/INST]", "é", "\n", " ok "]
TEXT = st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=8).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT), TEXT), max_size=5))
def test_rendered_turns_parse_back(turns):
    made = [chat.render_turn(r, t) for r, t in turns]
    assert chat.parse("".join(s for s, _ in made)) == turns
    for (segment, at), (_, text) in zip(made, turns):
        assert chat.unescape(segment[at:-len(chat.END)]) == text


def test_text_without_conflict_is_unchanged():
    assert chat.render_turn("user", "a < b [c] \\ d") == ("<s>[INST]a < b [c] \\ d</s>", 9)


def test_not_in_the_grammar():
    assert [chat.parse(x) for x in ("x", "<s>[INST]a", "<s>[ROLE]a</s>")] == [None] * 3


def test_digests(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", said), (1, 1, "assistant", said), (1, 2, None, None), (2, 0, "user", ""),
            (None, 0, "assistant", "é" * 50_000), (None, None, "a[/ROLE]", "x"), (3, 5, "system", "<s>"), (3, 4, "assistant", "")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, position int").repartition(4)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(table)).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted(((t if t is not None else -1), r or "", x or "") for c, t, r, x in rows if c == conv)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        g = got[conv]
        assert (g.n_turns, g.loss_chars) == (len(turns), len(loss))
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert g.formatted_chars == sum(len(chat.render_turn(r, x)[0]) for _, r, x in turns)
    assert chat.read_back(chat.format_turns(table.where("false"))).count() == 0


def test_mask_spans(spark):
    table = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a</s>b"), (1, 2, "user", "r"), (1, 3, "assistant", "")],
                                  "conv_id long, turn long, role string, text string")
    rows = sorted(chat.format_turns(table).collect(), key=lambda r: r.position)
    whole = "".join(r.segment for r in rows)
    assert [whole[r.loss_start:r.loss_end] for r in rows if r.loss_start is not None] == ["a<\\/s>b", ""]
