"""Layouts, template and loss mask."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import chat

HOSTILE = ["<|im_start|>", "<|im_end|>", "<\\|im_end|>", "<\\\\|x", "<", "|>", "\\", "\n", "~", "~1", "é🙂", "", "$1", "<|"]


def test_any_text_round_trips(spark):
    seen = []

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb~0<|im_end|>"]), st.lists(st.sampled_from(HOSTILE) | st.text(max_size=4), max_size=8)), max_size=5))
    def draw(turns):
        seen.append([(r, "".join(x for x in t if "\0" not in x)) for r, t in turns])

    draw()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(seen)], f"id int, turns {chat.TURNS}")
    out = chat.formatted(df).select(
        "id", "formatted", chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    for r in out.collect():
        turns = seen[r["id"]]
        assert [tuple(t) for t in r["back"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == len(turns)


def test_layouts(spark):
    lines = [
        '{"id": 1, "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}, {"role": "assistant", "content": null}]}',
        '{"id": 2, "conversations": [{"from": "human", "value": "u"}, {"from": "gpt", "value": "a"}]}',
        '{"id": 3, "prompt": "u", "completion": "a"}',
        '{"id": 4, "system": "s", "prompt": "u", "completion": "a"}',
        '{"id": 5, "instruction": "do", "input": "this", "output": "a"}',
        '{"id": 6, "instruction": "do", "input": "", "output": "a", "other": 7}',
        '{"id": 7, "question": "q", "answer": "a"}',
        '{"id": 8, "prompt": "u"}',
        '{"id": 9, "system": "s", "instruction": "do", "output": "a"}',
        '{"id": 10, "messages": []}',
    ]
    df = spark.read.json(spark.sparkContext.parallelize(lines))
    got = {r["id"]: (r["layout"], [tuple(t) for t in r["turns"]]) for r in chat.canonical(df).collect()}
    ua = [("user", "u"), ("assistant", "a")]
    assert got == {
        1: ("messages", [("system", "s"), ("user", "u"), ("assistant", "")]), 2: ("conversations", ua), 3: ("prompt", ua),
        4: ("prompt", [("system", "s"), *ua]), 5: ("instruction", [("user", "do\nthis"), ("assistant", "a")]),
        6: ("instruction", [("user", "do"), ("assistant", "a")]), 7: ("question", [("user", "q"), ("assistant", "a")]),
        8: (None, []), 9: ("instruction", [("system", "s"), ("user", "do"), ("assistant", "a")]), 10: ("messages", [])}


def test_records(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, None, "first"), (None, 0, "user", "x")]
    got = {r["conv_id"]: [tuple(m) for m in r["messages"]] for r in chat.records(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {1: [("", "first"), ("user", "hi"), ("user", "hi"), ("assistant", "")], None: [("user", "x")]}


def test_layouts_that_differ_only_inside_a_struct(spark):
    mappings = (
        chat.Mapping("pair", parts=(("user", ("data.prompt",)), ("assistant", ("data.completion",)))),
        chat.Mapping("asked", parts=(("user", ("data.q",)), ("assistant", ("data.a.text",)))),
        chat.Mapping("talk", turns=("data.talk", "role", "content")),
        chat.Mapping("said", turns=("data.talk", "who", "said")),
    )
    kind = ("id int, data struct<prompt:string,completion:string,q:string,a:struct<text:string,score:int>,"
            "talk:array<struct<role:string,content:string,who:string,said:string>>>")
    rows = [
        (1, ("u", "a", None, None, None)), (2, (None, None, "u", ("a", 1), None)), (3, ("u", None, None, None, None)),
        (4, (None, None, "u", (None, 1), None)), (5, None), (6, (None, None, None, None, [("human", "u", None, None), ("gpt", None, None, None)])),
        (7, (None, None, None, None, [(None, None, "human", "u"), (None, None, "gpt", "a")])), (8, (None, None, None, None, [])),
        (9, ("", "", None, None, None)), (10, ("u", "a", "q", ("a", 1), None))]
    out = chat.canonical(spark.createDataFrame(rows, kind), mappings)
    got = {r["id"]: (r["layout"], [tuple(t) for t in r["turns"]]) for r in out.collect()}
    ua = [("user", "u"), ("assistant", "a")]
    assert got == {
        1: ("pair", ua), 2: ("asked", ua), 3: (None, []), 4: (None, []), 5: (None, []),
        6: ("talk", [("user", "u"), ("assistant", "")]), 7: ("said", ua), 8: ("talk", []),
        9: ("pair", [("user", ""), ("assistant", "")]), 10: (None, [])}
    prints = {r["id"]: r["fingerprint"] for r in out.collect()}
    assert len({prints[i] for i in (1, 2, 3, 4, 6, 7, 8)}) == 7 and prints[1] == prints[9]
