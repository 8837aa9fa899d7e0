import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat

SCHEMA = "conv_id long, turn long, record string, place string, n long"
RECORDS = {
    "turn": {"turn": 3, "role": "user", "text": "hi"},
    "messages": {"id": 1, "messages": [{"role": "system", "content": "be kind"}, {"role": "user", "content": None}], "meta": {"x": [1, {"y": 2}]}},
    "message_parts": {"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
    "from_value": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "prompt_response": {"prompt": "p", "response": "r"},
    "prompt_completion": {"prompt": "p", "completion": 5},
    "question_answer": {"question": "q", "answer": "a"},
    "instruction_output": {"instruction": "do", "input": "this", "output": "done"},
}
TURNS = {
    "turn": [("user", "hi")],
    "messages": [("system", "be kind"), ("user", "")],
    "message_parts": [("user", "ab")],
    "from_value": [("user", "q"), ("assistant", "a")],
    "prompt_response": [("user", "p"), ("assistant", "r")],
    "prompt_completion": [("user", "p"), ("assistant", "5")],
    "question_answer": [("user", "q"), ("assistant", "a")],
    "instruction_output": [("user", "do\n\nthis"), ("assistant", "done")],
}


def run(spark, records, **more):
    frame = spark.createDataFrame([(1, k, r if r is None or isinstance(r, str) else json.dumps(r), "mine", 4) for k, r in enumerate(records)], SCHEMA)
    return [(r.layout, r.turns and [tuple(t) for t in r.turns]) for r in chat.canonical(frame, **more).orderBy("turn").collect()]


def test_every_layout(spark):
    assert run(spark, RECORDS.values()) == [(name, TURNS[name]) for name in RECORDS]


def test_optional_fields(spark):
    got = run(spark, [{"instruction": "i", "output": "o"}, {"system": "s", "instruction": "i", "input": "", "output": None}, {"system": "s", "conversations": [{"from": "x", "value": "v"}]}])
    assert got == [("instruction_output", [("user", "i"), ("assistant", "o")]), ("instruction_output", [("system", "s"), ("user", "i"), ("assistant", "")]), ("from_value", [("system", "s"), ("x", "v")])]


def test_records_of_no_layout_keep_their_rows(spark):
    odd = [None, "", "{", "[]", "null", {"messages": []}, {"prompt": "p"}, {"prompt.x": 1, "response": "r"}, "[" * 100_000, {"messages": "text"}, {"prompt": {"a": 1}, "response": "r"}]
    assert run(spark, odd) == [(None, None)] * len(odd)


def test_lone_surrogates_and_escaped_names(spark):
    assert run(spark, ['{"prompt": "\\ud800x", "response": ""}']) == [("prompt_response", [("user", "?x"), ("assistant", "")])]
    assert chat.field_paths({"a.b": [[{"c[]": 1}], []], "d": {}}) == {"a\\.b[][].c\\[]", "a\\.b[]", "d"}


def test_layouts_with_the_same_paths_are_an_error():
    with pytest.raises(ValueError):
        chat.registry([chat.Layout("x", (chat.Turn("user", ("a",)),)), chat.Layout("y", (chat.Turn("assistant", ("a",)),))])


def conversations(spark, rows):
    """rows: (conv_id, turn, role, text)."""
    told = [(c, t, json.dumps({"turn": t, "role": r, "text": x}), "mine", 1) for c, t, r, x in rows]
    return chat.canonical(spark.createDataFrame(told, SCHEMA).repartition(4))


def plain(rows, template):
    out = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        out.setdefault(c, []).append((role or "", text or ""))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    learned = {c: "".join(x for r, x in turns if r in template.learned) for c, turns in out.items()}
    return {c: (len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)), len(learned[c]), sha(learned[c])) for c, t in out.items()}


ODD = ["", None, "plain", "\\", "\\\\<|im_end|>", "<|im_end|><|im_start|>user<|im_sep|>", "<|im_<|im_end|>", "</s>[INST] ok [/INST]", "<<|im_sep|>", "a\nb", "é東\U0001f600" * 50, "<s>" * 30_000, "[\\INST]", "<\\|im_end|>"]


def test_read_back_is_what_was_said(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 0, 1, 2]), rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "assistant", None, "tool<|im_sep|>\\"]), rng.choice(ODD)) for _ in range(300)]
    rows += [(9, k, "assistant" if k % 2 else "user", f"say {k} {rng.choice(ODD[:10])}") for k in range(1500)]  # a hot conversation
    template = chat.Template()
    segments = chat.formatted(conversations(spark, rows), ["conv_id"], ["turn"], template)
    got = chat.read_back(segments, ["conv_id"], template, together=True).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == plain(rows, template)
    assert sorted(map(str, got)) == sorted(map(str, chat.read_back(segments.repartition(7), ["conv_id"], template).collect()))
    texts = {}
    for s in segments.orderBy("conv_id", "turn").collect():
        whole = texts.get(s.conv_id, "")
        assert s.start == len(whole)
        texts[s.conv_id] = whole = whole + s.segment
        if s.loss_start is not None:
            (said,) = template.read(s.segment)
            assert said[0] == "assistant" and template.plain(whole[s.loss_start : s.loss_start + s.loss_length]) == said[1]
    assert {c: len(t) for c, t in texts.items()} == {r.conv_id: r.formatted_chars for r in got}
    assert {c: len(template.read(t)) for c, t in texts.items()} == {r.conv_id: r.n_turns for r in got}


def test_overlapping_control_strings(spark):
    template = chat.Template(start="<[", middle="ab", end="bc>", others=("aba", "ca$"), escape="%")
    texts = ["abababc>", "%ab%%c>", "<[ababc>ca$%", "%", "a", "<"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", template.escaped(F.col("t")).alias("e")).collect():
        assert template.plain(r.e) == r.t and not any(c in r.e for c in template.controls)
        assert template.read(f"<[{r.e}ab{r.e}bc>") == [(r.t, r.t)]


def test_bad_templates_and_broken_texts():
    for bad in ({"escape": "<"}, {"escape": "ab"}, {"end": "<>x<"}, {"others": ("x",)}):
        with pytest.raises(ValueError):
            chat.Template(**bad)
    with pytest.raises(ValueError):
        chat.Template().read("<|im_start|>user<|im_sep|>hi<|im_end|> ")


def test_no_rows_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    turns = chat.canonical(empty)
    assert turns.columns == ["conv_id", "turn", "place", "n", "fingerprint", "layout", "turns"]
    assert chat.read_back(chat.formatted(turns, ["conv_id"], ["turn"]), ["conv_id"], together=True).count() == 0
    both = chat.formatted(conversations(spark, [(1, 0, "user", "x")]).withColumn("segment", F.col("conv_id")), ["segment"], ["turn"])
    assert both.columns == ["key_segment", "turn", "start", "segment", "loss_start", "loss_length"]
    assert chat.read_back(both.withColumn("n_turns", F.lit(8)), ["n_turns"]).columns[0] == "key_n_turns"
