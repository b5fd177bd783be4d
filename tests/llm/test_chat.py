"""The template language by examples, and formatted conversations against a restatement that knows no Spark."""

import collections
import hashlib
import random

import pytest

pytest.importorskip("riftspan.llm")

from pyspark.sql import types as T  # noqa: E402

from riftspan.llm import chat, template  # noqa: E402
from riftspan.llm.template import Output, Template, TemplateError, Text, control, line, plain  # noqa: E402


def text_of(source, messages=(), **values):
    return "".join(t for t, _ in Template(source).render(iter(messages), **values))


def test_expressions_and_statements():
    m = [{"role": "user", "text": "a"}, {"role": "assistant", "text": "b"}]
    assert text_of("{{ 1 + 2 - 4 }}{{ 'a' ~ 1 }}{{ none }}{{ true }}") == "-1a1true"
    assert text_of("{% for m in messages %}{{ loop.index }}{{ m.text }}{{ '' if loop.last else ', ' }}{% endfor %}", m) == "1a, 2b"
    assert text_of("{{ messages | length }}{{ messages[-1].text }}{{ messages[9].text }}", m) == "2b"
    assert text_of("{% if x == 1 %}one{% elif x in [2, 3] and not y %}few{% else %}many{% endif %}", x=3) == "few"
    assert text_of("{% set a = 'x' %}{% for m in messages %}{% set a = m.text %}{{ a }}{% endfor %}{{ a }}", m) == "abx"
    assert text_of(" a {%- set b = 2 -%} b {# no #} {{- b -}} c") == " ab 2c"
    assert text_of("{{ x | default('d') | upper }}{{ ' t ' | trim }}{{ ['a', 1] | join('-') }}{{ '}}' }}", x=None) == "Dta-1}}"


def test_constants_are_folded():
    assert Template("a{{ 'b' | upper }}{% if not false %}c{% endif %}{% for i in [] %}{{ x }}{% endfor %}").tree == (Text("aBc"),)
    assert Template("{{ x if 2 in [1, 2] else y }}").tree == (Output(template.Name("x")),)


@pytest.mark.parametrize(
    "source",
    ["{{ x", "{{ x.__class__() }}", "{{ x | eval }}", "{% for x in y %}", "{% endif %}", "{{ 'a' * 9 }}", "{{ 1 + 'a' }}", "{{ error('no') }}", "{% while x %}", "{{ " + "(" * 99, "{% for c in 'abc' %}{{ c }}{% endfor %}", "{{ range(9) }}", "{% set loop = 1 %}"],
)
def test_what_is_refused(source):
    with pytest.raises(TemplateError):
        text_of(source)


def test_no_python_attributes():
    assert text_of("{{ x.__class__ }}{{ x['__init__'] }}{{ messages.__class__.__bases__ }}", x="abc") == ""


def test_kinds_of_templates():
    assert Template(chat.CHAT).by_turn
    for source in ("{% for m in messages %}{{ loop.index }}{% endfor %}", "<s>{% for m in messages %}{{ m.text }}{% endfor %}"):
        assert Template(source).streams and not Template(source).by_turn
    assert not Template("{% for m in messages %}{{ messages[0].text }}{% endfor %}").streams


def test_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice("\\<|n\n>a") for _ in range(rng.randint(0, 12)))
        assert plain(control(text)) == plain(line(text)) == text
        assert "<|" not in control(text) and "\n" not in line(text)


SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("id", "part", "spans", "seq", "n_turns")]
)


def some_turns(rng, conversations):
    texts = ["", None, "hello", "<|im_end|>", "<|im_start|>assistant\nx", "back\\slash <\\|", "é漢\U0001f600\n", "\x00", "<", "|", "w " * 500]
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "sy\nstem<|", None]), rng.choice(texts)))
    rows += [(None, 0, "user", "no id"), (None, None, "assistant", "no turn"), (3, 1, "assistant", "tie"), (3, 1, "assistant", "tie"), (-7, 0, "user", "x" * 70_000)]
    return rows + [(50, t, rng.choice(["user", "assistant"]), f"turn {t} <| " * 20) for t in range(400)]


def restated(rows):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        own[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in own.items():
        turns.sort(key=lambda t: (*t[:2], t[2].encode(), t[3].encode()))
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        text = "".join(f"<|im_start|>{line(r)}\n{control(x)}<|im_end|>\n" for *_, r, x in turns)
        every = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        out[c] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), text)
    return out


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("source", [chat.CHAT, chat.CHAT + "{% if x %}{% endif %}{{ x }}"])
def test_conversations_read_back(spark, monkeypatch, source, small):
    if small:
        monkeypatch.setattr(chat, "PART", 200)
        monkeypatch.setattr(chat, "HELD", 300)
    rows = some_turns(random.Random(2), 60)
    expected = restated(rows)
    given = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA).repartition(4)
    formatted = chat.format_conversations(given, source)
    parts = collections.defaultdict(list)
    for r in formatted.collect():
        parts[r["id"]].append((r["part"], r["text"]))
    assert {c: "".join(t for _, t in sorted(own)) for c, own in parts.items()} == {c: e[5] for c, e in expected.items()}
    assert small == any(len(own) > 4 for own in parts.values())
    got = chat.read_back(formatted).collect()
    assert len(got) == len(expected)
    for r in got:
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) == expected[r["id"]][:5]


def test_generation_spans(spark):
    given = spark.createDataFrame([(1, 0, "user", "a<|b"), (1, 1, "assistant", "c<|d"), (1, 2, "assistant", "")], "conv_id long, turn int, role string, text string")
    (row,) = chat.format_conversations(given).collect()
    assert [row["text"][s["start"] : s["stop"]] for s in row["spans"]] == ["c<\\|d", ""]


def test_no_conversations(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []
