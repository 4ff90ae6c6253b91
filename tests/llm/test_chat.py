from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from millwright.llm import chat
from millwright.llm.templates import Compiled, Const, Controls, Output, TemplateError, Turn, Written, fold, parse

CONTROLS = Controls(chat.CONTROLS)
MARKED = "</s>[INST] ok [/INST]"


def written(template, *turns):
    out = Written()
    for i, (role, text) in enumerate(turns):
        template.render(Turn(role, text, i == 0, i == len(turns) - 1), out)
    return "".join(out.pieces), out.generated


tricky = st.text(st.sampled_from(list("<>/s[]\\ INSTaé\n")), max_size=25) | st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "x"])).map("".join)


@settings(max_examples=500, deadline=None)
@given(tricky)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    escaped = CONTROLS.escape(text)
    assert CONTROLS.unescape(escaped) == text
    assert not any(s in escaped for s in chat.CONTROLS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "[AS]"]) | tricky, tricky), min_size=1, max_size=6))
def test_default_layout_reads_back(turns):
    text, loss = written(chat.default_template(), *turns)
    reader = chat._Reader(CONTROLS)
    reader.read(text, [{"start": a, "stop": z} for a, z in loss], len(turns))
    learned = "".join(t for r, t in turns if r == "assistant")
    assert reader.row() == (
        len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
        len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text),
    )


def test_control_strings_must_be_tellable():
    for bad in (["<"], ["<a<"], ["<s>", "[<x]"], ["<\\s>"]):
        with pytest.raises(TemplateError):
            Controls(bad)


def test_constants_are_folded():
    def folded(source, **constants):
        return fold(parse(source, constants), str)

    assert folded("a{{ 'b' ~ bos }}c{# no #}", bos="<s>") == (Output(Const("ab<s>c")),)
    assert folded("x{% if true and bos == '<s>' %}y{% else %}{{ turn.text }}{% endif %}z", bos="<s>") == (Output(Const("xyz")),)
    assert folded("{% if false %}{% generation %}{{ turn.text }}{% endgeneration %}{% endif %}") == ()
    assert folded("{{ (' A ' | trim | lower) ~ ('q' if not true else 'r') }}") == (Output(Const("ar")),)


def test_template_language():
    source = (
        "{{ bos }}{%- for turn in turns -%} {{ turn.role | upper }}:"
        "{% if turn.role == 'user' or turn.role == \"u2\" %}{{ turn.text }}"
        "{% elif turn.role != 'sys' and not loop.last %}{% generation %}{{ turn.text | trim }}{% endgeneration %}!"
        "{% else %}{{ 'last' if loop.last else loop.first }}{% endif %};{% endfor %}END"
    )
    template = Compiled(source, CONTROLS, {"bos": "B"})
    text, loss = written(template, ("sys", "s"), ("user", "hé"), ("bot", " yes "), ("bot", "no"))
    assert text == "BSYS:true;USER:hé;BOT:yes!;BOT:last;END"
    assert [text[a:z] for a, z in loss] == ["yes"]


@pytest.mark.parametrize("source", [
    "no loop", "{% for turn in turns %}", "{% for x in y %}{% endfor %}", "{{ turn.text }}{% for turn in turns %}{% endfor %}",
    "{% for turn in turns %}{{ turn.__class__ }}{% endfor %}", "{% for turn in turns %}{{ open('x') }}{% endfor %}",
    "{% for turn in turns %}{{ turn.text | eval }}{% endfor %}", "{% for turn in turns %}{% if turn.text %}{% endfor %}",
    "{% for turn in turns %}{{ 'a' {% endfor %}", "{% for turn in turns %}{{ }}{% endfor %}", "{% include 'x' %}",
    "{% for turn in turns %}{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}{% endfor %}",
    "{% for turn in turns %}" + "{% if turn.text %}" * 60 + "{% endif %}" * 60 + "{% endfor %}",
    "{% for turn in turns %}{{ " + "(" * 60 + "'a'" + ")" * 60 + " }}{% endfor %}",
    "{% for turn in turns %}{{ " + " ~ ".join(["turn.text"] * 300) + " }}{% endfor %}", "x" * (1 << 17),
])
def test_what_is_not_in_the_language_is_refused(source):
    with pytest.raises(TemplateError):
        Compiled(source, CONTROLS)


def conversations(spark, rows):
    schema = "conv_id bigint, turn int, role string, text string, part string, first string, segment string, loss string"
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema)


def expected(rows):
    template, found = chat.default_template(), []
    by_conversation = {}
    for conv, turn, role, text in rows:
        by_conversation.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in by_conversation.items():
        turns = [t[2:] for t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        found.append((
            conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(written(template, *turns)[0]),
        ))
    return sorted(found, key=repr)


def test_conversations_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT_CHARS", 300)
    rng = random.Random(2)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", None]), rng.choice([MARKED, "", None, "é" * rng.randint(0, 90), "[IN\\ST]"])))
    # One conversation holds most rows, so many tasks see a part of it; a turn of it is very long.
    rows += [(7, 100 + i, rng.choice(["user", "assistant"]), f"hot {i} {MARKED}") for i in range(500)] + [(7, 700, "user", "long " * 30_000)]
    rows += [(8, None, "user", "no number")] + [(9, 50, "user", "same")] * 5 + [(-3, 0, "[AS]", "role of control strings")]
    rng.shuffle(rows)
    segments = chat.format_conversations(conversations(spark, rows).repartition(5))
    hot = segments.filter("conv_id = 7")
    assert hot.select("part").distinct().count() > 1
    assert sorted((tuple(r) for r in chat.read_back(segments).collect()), key=repr) == expected(rows)


def test_many_tiny_parts(spark):
    rows = [(i // 2, i, "user" if i % 3 else "assistant", f"t{i}") for i in range(11)] + [(99, 0, "user", "alone")]
    for n in (1, 3, 40):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            segments = chat.format_conversations(conversations(spark, rows))
            assert sorted((tuple(r) for r in chat.read_back(segments).collect()), key=repr) == expected(rows)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_no_conversations(spark):
    assert chat.read_back(chat.format_conversations(conversations(spark, []))).collect() == []
