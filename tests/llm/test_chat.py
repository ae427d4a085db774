import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.llm import chat

MARKED = st.text(alphabet="\\#a </turn>said<U:\n é", max_size=24) | st.sampled_from(["###", "\\###", "#\\####", "</turn>", "\\\\<said>", "### User: x </turn>\n"])


@settings(max_examples=200, deadline=None)
@given(MARKED)
def test_escaping_is_reversible_and_hides_marks(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not re.search("###|</turn>|<said>", escaped)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool ###"]), MARKED), max_size=5))
def test_ids_read_back(tokenizer_path, turns):
    tokenizer = chat.load_tokenizer(tokenizer_path)
    ids, loss = chat.assemble(turns, tokenizer)
    assert len(ids) == len(loss)
    said, learned = chat.read_back(ids, loss, tokenizer)
    assert said == turns
    assert learned == "".join(t for role, t in turns if role == "assistant")
    rendered = chat.render(ids, tokenizer)
    assert rendered.count("</turn>") == len(turns)


def test_text_never_gives_reserved_ids(tokenizer_path):
    tokenizer = chat.load_tokenizer(tokenizer_path)
    base = tokenizer.get_vocab_size()
    ids, _ = chat.assemble([("user", "".join(chat.CONTROL) + "<|endoftext|>")], tokenizer)
    assert (ids >= base).sum() == 2  # header and end


def test_conversations(spark, tokenizer_path):
    rows = spark.createDataFrame(
        [(1, 1, "assistant", "b", 0), (1, 0, "user", None, 0), (None, 0, None, "x", 0), (2, 0, "tool", "### </turn>", 0), (2, 0, "tool", "### </turn>", 0), (3, None, "user", "", 0)],
        "conv_id long, turn long, role string, text string, ids int",
    )
    found = {r.conv_id: r for r in chat.format_chats(rows, tokenizer_path).collect()}
    assert {k: r.n_turns for k, r in found.items()} == {1: 2, None: 1, 2: 2, 3: 1}
    assert found[1].formatted == "### User:  </turn>\n### Assistant: b </turn>\n"
    assert found[2].formatted == "### Role tool <said> \\h## \\l/turn> </turn>\n" * 2
    assert sum(found[1].loss) == 1 and sum(found[2].loss) == 0
    assert chat.format_chats(rows.limit(0), tokenizer_path).collect() == []
