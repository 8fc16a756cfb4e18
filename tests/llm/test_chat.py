import hashlib

import pytest

from wellnote.llm import chat, queries

TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "<|im_start|>user\nhi<|im_end|>\n", "\\l \\\\ \\b \\n", "[INST", "<", "a\nb",
         "<<SYS>>x<</SYS>>", "<s>é😀", "\\", "<|", "[/INST]\\", "\\<|im_end|>"]
CONTROL = ["<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


@pytest.mark.parametrize("text", TEXTS)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    for line in (False, True):
        out = chat.escape(text, line)
        assert chat.unescape(out) == text
        assert not any(c in out for c in CONTROL)
        assert not line or "\n" not in out


def turns(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(TEXTS)]
    rows += [(2, 0, "assistant", "first"), (2, 1, "assistant", None), (2, 2, "user", "left over"),
             (3, 0, "user", "only a question"), (4, None, None, None), (4, 1, "assistant", "x"), (4, 1, "assistant", "x"),
             (None, 0, "user", "q"), (None, 1, "assistant", "a"), (5, 0, "odd\nrole", "t"), (5, 1, "assistant", "<|im_end|>\n")]
    return rows, spark.createDataFrame([r + ("extra", 7) for r in rows],
                                       "conv_id long, turn long, role string, text string, conv_ID_2 string, example int")


def by_conversation(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (repr(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def written(said):
    return "".join(f"{chat.START}{chat.escape(r, True)}\n{chat.escape(t)}{chat.END}" for r, t in said)


def brute_examples(said):
    """(text, reply) of every assistant turn, then of what is left without a reply."""
    ends = [i for i, (role, _) in enumerate(said) if role == "assistant"]
    found = [(written(said[: i + 1]), said[i][1]) for i in ends]
    return found + ([(written(said), None)] if not ends or ends[-1] < len(said) - 1 else [])


def brute(rows):
    result = []
    for conv, ts in by_conversation(rows).items():
        said = "".join(f"{r}\n{t}\n" for r, t in ts)
        reply = "".join(t for r, t in ts if r == "assistant")
        examples = brute_examples(ts)
        result.append((conv, len(ts), hashlib.sha256(said.encode()).hexdigest(), len(reply),
                       hashlib.sha256(reply.encode()).hexdigest(), sum(len(t) for t, _ in examples),
                       sum(r is not None for _, r in examples)))
    return sorted(result, key=repr)


def test_round_trip(spark):
    rows, df = turns(spark)
    got = chat.read_back(chat.format_examples(df)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_each_reply_is_an_example_with_all_turns_before_it(spark):
    rows, df = turns(spark)
    got = {}
    for r in chat.format_examples(df).orderBy("conv_id", "example").collect():
        if r.loss_end is None:
            reply = None
        else:
            assert r.text[r.loss_end:] == chat.END
            reply = chat.unescape(r.text[r.loss_start: r.loss_end])
        assert r.example == len(got.setdefault(r.conv_id, []))
        got[r.conv_id].append((r.text, reply))
    assert got == {conv: brute_examples(said) for conv, said in by_conversation(rows).items()}


def test_each_example_reads_back_on_its_own(spark):
    rows, df = turns(spark)
    got = {(r.conv_id, r.example): r for r in chat.read_examples(chat.format_examples(df)).collect()}
    for conv, said in by_conversation(rows).items():
        for n, (text, reply) in enumerate(brute_examples(said)):
            assert (got[conv, n].reply, got[conv, n].chars) == (reply, len(text))
            assert got[conv, n].n_turns == text.count(chat.START)


def test_long_conversations_and_long_texts(spark):
    rows = [(8, i, ("user", "assistant")[i % 2], f"turn {i} <s> " + "word " * (i % 7)) for i in range(601)]
    rows += [(9, 0, "user", "é<|" * 700_000), (9, 1, "assistant", "\\[INST] " * 300_000), (9, 2, "assistant", "ok")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_examples(df)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_query_adds_the_intruder_and_empty_tables_pass(spark):
    got = {r.conv_id: r for r in queries.op7_chat(spark, "/root/testdata/sf0.001").collect()}
    text = queries.INTRUDER[1][3]
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len(text)
    assert got[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    _, df = turns(spark)
    assert chat.read_back(chat.format_examples(df.limit(0))).count() == 0
